"""Rolling features over a panel, counted in rows of a code.

Every window that isn't full is null: ``full`` guards an aggregate by the count of values.
All windows of a code share one partitioning and one sort.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def by_code() -> WindowSpec:
    """The rows of a code in order of date."""
    return Window.partitionBy("code").orderBy("date")


def last_n(n: int, back: int = 0) -> WindowSpec:
    """The n rows that end ``back`` rows ago."""
    return by_code().rowsBetween(-(n - 1) - back, -back)


def ahead(n: int) -> WindowSpec:
    """The n rows that follow."""
    return by_code().rowsBetween(1, n)


def full(agg: Column, x: Column, n: int, w: WindowSpec, least: int | None = None) -> Column:
    return F.when(F.count(x).over(w) >= (least or n), agg.over(w))


def mean(x: str | Column, n: int, back: int = 0) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return full(F.avg(x), x, n, last_n(n, back))


def lag(x: str, k: int = 1) -> Column:
    return F.lag(x, k).over(by_code())


def gain(k: int = 1) -> Column:
    return F.col("close") / lag("close", k) - 1


def returns(panel: DataFrame, ks=(1, 3, 5, 10, 20, 40, 60)) -> DataFrame:
    return panel.select("*", *(gain(k).alias(f"ret{k}") for k in ks), F.log(F.col("close") / lag("close")).alias("log_ret"))


def range_position(panel: DataFrame, n: int = 250, least: int = 60) -> DataFrame:
    w, c = last_n(n), F.col("close")
    return panel.select("*", (c / full(F.max(c), c, n, w, least) - 1).alias("dist_high"), (c / full(F.min(c), c, n, w, least) - 1).alias("dist_low"))


def alignment(panel: DataFrame) -> DataFrame:
    """How many of three averages stand above the next longer one, and the 20-row average's slope."""
    cents = F.round(F.col("close") * 100).cast("long")  # whole cents, so that equal averages are equal
    d = panel.select("*", *((mean(cents, k) / 100).alias(f"ma{k}") for k in (5, 10, 20, 60)))
    up = sum(((F.col(a) > F.col(b)).cast("int") for a, b in (("ma5", "ma10"), ("ma10", "ma20"), ("ma20", "ma60"))), F.lit(0))
    return d.select("*", F.when(F.col("ma60").isNotNull(), up).alias("aligned"), ((F.col("ma20") - lag("ma20", 5)) / F.col("close")).alias("slope"))


def run_length(df: DataFrame, flag: Column, name: str, cap: int | None = None) -> DataFrame:
    """Consecutive rows of a code for which ``flag`` holds, up to and with each row."""
    d = df.withColumn("_flag", F.coalesce(flag, F.lit(False))).withColumn("_island", F.sum((~F.col("_flag")).cast("int")).over(by_code().rowsBetween(Window.unboundedPreceding, 0)))
    n = F.when(F.col("_flag"), F.sum(F.col("_flag").cast("int")).over(Window.partitionBy("code", "_island").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))).otherwise(0)
    return d.withColumn(name, F.least(n, F.lit(cap)) if cap else n).drop("_flag", "_island")


def above_average(panel: DataFrame, n: int = 60, cap: int = 60) -> DataFrame:
    """Rows in a row whose close lies above its average, both in whole cents, so that a close equal to its average is never above it."""
    cents = F.round(F.col("close") * 100).cast("long")
    d = panel.withColumn("_ma", mean(cents, n))
    d = run_length(d, cents > F.col("_ma"), "days_above", cap)
    return d.withColumn("days_above", F.when(F.col("_ma").isNotNull(), F.col("days_above"))).drop("_ma")


def compression(panel: DataFrame) -> DataFrame:
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("_prev")), F.abs(F.col("low") - F.col("_prev")))
    d = panel.withColumn("_prev", lag("close")).withColumn("_amp", (F.col("high") - F.col("low")) / F.col("close")).withColumn("_tr", true_range)
    c = F.col("close")
    return d.select(
        *panel.columns,
        (mean("_amp", 5) / mean("_amp", 20)).alias("range_compress"),
        (mean("turnover", 5) / mean("turnover", 20)).alias("vol_compress"),
        (mean("_tr", 14) / mean("_tr", 60)).alias("atr_ratio"),
        (4 * full(F.stddev_samp(c), c, 20, last_n(20)) / mean("close", 20)).alias("boll_width"),
    )


def volume_block(panel: DataFrame) -> DataFrame:
    """Turnover against its means, today included; turnover, not volume, because share counts change."""
    t = F.col("turnover")
    d = panel.withColumn("_up", F.when(F.col("close") > lag("close"), t).otherwise(0.0)).withColumn("_signed", F.coalesce(F.signum(F.col("close") - lag("close")), F.lit(0.0)) * t)
    total = F.nullif(full(F.sum(t), t, 20, last_n(20)), F.lit(0.0))
    return d.select(
        *panel.columns,
        (t / F.nullif(mean("turnover", 5), F.lit(0.0))).alias("vol_ratio5"),
        (t / F.nullif(mean("turnover", 20), F.lit(0.0))).alias("vol_ratio20"),
        (full(F.stddev_samp(t), t, 20, last_n(20)) / mean("turnover", 20)).alias("turn_cv20"),
        (full(F.sum("_up"), F.col("_up"), 20, last_n(20)) / total).alias("up_vol_share20"),
        (full(F.sum("_signed"), F.col("_signed"), 20, last_n(20)) / total).alias("obv_slope20"),
        F.log1p(mean("amount", 20)).alias("amt_ma20"),
    )


def five_row(df: DataFrame, features: list[str]) -> DataFrame:
    """Last, mean and slope of each feature over five rows."""
    return df.select("*", *(e for f in features for e in (F.col(f).alias(f"{f}__last"), mean(f, 5).alias(f"{f}__mean"), ((F.col(f) - lag(f, 4)) / 4).alias(f"{f}__slope"))))


def since_flag(df: DataFrame, flag: Column, name: str, cap: int = 60) -> DataFrame:
    """Rows since the last row of the code with ``flag``, at most ``cap``."""
    d = df.withColumn("_pos", F.row_number().over(by_code())).withColumn("_at", F.when(flag, F.row_number().over(by_code())))
    at = F.last("_at", ignorenulls=True).over(by_code().rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn(name, F.least(F.coalesce(F.col("_pos") - at, F.lit(cap)), F.lit(cap))).drop("_pos", "_at")


def gaps(panel: DataFrame, market: DataFrame, n: int = 20) -> DataFrame:
    """Market days that a code missed before each row, and the most in n rows.  ``market``: date, day."""
    d = panel.join(F.broadcast(market), "date") if market.count() < 100_000 else panel.join(market, "date")
    missed = F.col("day") - lag("day") - 1
    d = d.withColumn("missed", F.coalesce(missed, F.lit(0)))
    return d.withColumn("max_missed", F.max("missed").over(last_n(n)))


def shapes(panel: DataFrame) -> DataFrame:
    """Shapes of single bars, against the open and against the bar's own range."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    span = h - l + 1e-12
    top, bottom = F.greatest(o, c), F.least(o, c)
    return panel.select("*", ((c - o) / o).alias("kmid"), ((h - l) / o).alias("klen"), ((c - o) / span).alias("kmid2"), ((h - top) / o).alias("kup"), ((h - top) / span).alias("kup2"), ((bottom - l) / o).alias("klow"), ((bottom - l) / span).alias("klow2"), ((2 * c - h - l) / o).alias("ksft"), ((2 * c - h - l) / span).alias("ksft2"), (o / c).alias("open0"), (h / c).alias("high0"), (l / c).alias("low0"))


def _running(x: Column) -> Column:
    return F.sum(x).over(by_code().rowsBetween(Window.unboundedPreceding, 0))


def _last_sum(total: str, n: int) -> Column:
    """The sum over the last n rows from a running total."""
    return F.col(total) - F.coalesce(F.lag(total, n).over(by_code()), F.lit(0))


def moments(panel: DataFrame, spans=(5, 10, 20, 30, 60)) -> DataFrame:
    """Returns, means, deviations, extremes of close and volume over several spans.

    Sums of a span are differences of running totals, so a row costs the same for every span;
    closes enter as whole cents, so that the totals are exact.
    """
    cents = F.round(F.col("close") * 100).cast("long")
    d0 = panel.withColumn("_x", cents).select("*", *(_running(x).alias(n) for n, x in (("_n", F.when(F.col("_x").isNotNull(), 1).otherwise(0)), ("_s", F.col("_x")), ("_q", F.col("_x") * F.col("_x")), ("_vn", F.when(F.col("volume").isNotNull(), 1).otherwise(0)), ("_vs", F.col("volume")), ("_vq", F.col("volume") * F.col("volume")))))
    totals = ("_n", "_s", "_q", "_vn", "_vs", "_vq")
    # Every sum of a span is one column, so that it is evaluated once.
    d0 = d0.select("*", *(_last_sum(x, d).alias(f"{x}{d}") for d in spans for x in totals), *(e for d in spans for e in (lag("close", d).alias(f"_c{d}"), F.max("high").over(last_n(d)).alias(f"_hi{d}"), F.min("low").over(last_n(d)).alias(f"_lo{d}"))))
    out, c, v = [], F.col("close"), F.col("volume")
    for d in spans:
        n, s, q, vn, vs, vq = (F.col(f"{x}{d}") for x in totals)
        spread = lambda s, q, d=d: F.sqrt(F.greatest(d * q - s * s, F.lit(0)).cast("double")) / d
        whole = lambda x, n=n, d=d: F.when(n == d, x)
        out += [(F.col(f"_c{d}") / c).alias(f"roc{d}"), (whole(s / (100.0 * d)) / c).alias(f"ma{d}"), (whole(spread(s, q) / 100) / c).alias(f"std{d}")]
        out += [(whole(F.col(f"_hi{d}")) / c).alias(f"max{d}"), (whole(F.col(f"_lo{d}")) / c).alias(f"min{d}")]
        out += [(F.when(vn == d, vs / d) / v).alias(f"vma{d}"), (F.when(vn == d, spread(vs, vq)) / v).alias(f"vstd{d}")]
    return d0.select(*panel.columns, *out)


def trend(panel: DataFrame, spans=(5, 10, 20, 30, 60)) -> DataFrame:
    """Slope, fit and last residual of the close on time, from running totals of exact cents."""
    d0 = panel.select("*", F.round(F.col("close") * 100).cast("long").alias("_x"), F.row_number().over(by_code()).cast("long").alias("_t"))
    d0 = d0.select("*", *(_running(x).alias(n) for n, x in (("_s", F.col("_x")), ("_q", F.col("_x") * F.col("_x")), ("_p", F.col("_x") * F.col("_t")))))
    y, out = F.col("close"), []
    for d in spans:
        whole = F.col("_t") >= d
        s, q = _last_sum("_s", d).cast("double"), _last_sum("_q", d)
        # Time is centred on the span: sum of (t - mean) x, doubled to stay whole.
        cross = (2 * _last_sum("_p", d) - (2 * F.col("_t") - (d - 1)) * _last_sum("_s", d)).cast("double") / 2
        txx = d * (d * d - 1) / 12.0
        yy = (d * q - _last_sum("_s", d) * _last_sum("_s", d)).cast("double") / d
        beta = cross / txx / 100
        out += [(F.when(whole, beta) / y).alias(f"beta{d}"), F.when(whole, F.when(yy == 0, 1.0).otherwise(cross * cross / txx / yy)).alias(f"rsqr{d}")]
        out += [(F.when(whole, y - (s / (100.0 * d) + beta * ((d - 1) / 2))) / y).alias(f"resi{d}")]
    return d0.select(*panel.columns, *out)


def quantiles_in_window(panel: DataFrame, spans=(10, 20)) -> DataFrame:
    out, c = [], F.col("close")
    for d in spans:
        w = last_n(d)
        values = full(F.collect_list(c), c, d, w)
        high, low = full(F.max("high"), c, d, w), full(F.min("low"), c, d, w)
        out += [(full(F.percentile(c, F.lit(0.8)), c, d, w) / c).alias(f"qtlu{d}"), (full(F.percentile(c, F.lit(0.2)), c, d, w) / c).alias(f"qtld{d}"), (F.size(F.filter(values, lambda x: x <= c)) / F.lit(float(d))).alias(f"rank{d}"), ((c - low) / (high - low + 1e-12)).alias(f"rsv{d}")]
    return panel.select("*", *out)


def extremes(panel: DataFrame, spans=(10, 20)) -> DataFrame:
    """Rows since the highest high and the lowest low, the first of equal ones, as shares of the window."""
    d0, out = panel.withColumn("_t", F.row_number().over(by_code())), []
    for d in spans:
        w = last_n(d)
        at_high = full(F.max_by("_t", F.struct(F.col("high"), -F.col("_t"))), F.col("high"), d, w)
        at_low = full(F.min_by("_t", F.struct(F.col("low"), F.col("_t"))), F.col("low"), d, w)
        out += [((F.col("_t") - at_high) / d).alias(f"imax{d}"), ((F.col("_t") - at_low) / d).alias(f"imin{d}"), ((at_low - at_high) / d).alias(f"imxd{d}")]
    return d0.select(*panel.columns, *out)


def safe_corr(x: Column, y: Column, w: WindowSpec) -> Column:
    """Correlation over a window, null where one side is constant."""
    return F.covar_pop(x, y).over(w) / F.nullif(F.stddev_pop(x).over(w) * F.stddev_pop(y).over(w), F.lit(0.0))


def correlations(panel: DataFrame, spans=(10, 20)) -> DataFrame:
    d0 = panel.select("*", F.log(F.col("volume") + 1).alias("_lv"), gain().alias("_r")).withColumn("_dv", F.col("_lv") - lag("_lv"))
    out = []
    for d in spans:
        w = last_n(d)
        out += [F.when(F.count("close").over(w) == d, safe_corr(F.col("close"), F.col("_lv"), w)).alias(f"corr{d}"), F.when(F.count("_r").over(w) == d, safe_corr(F.col("_r"), F.col("_dv"), w)).alias(f"cord{d}")]
    return d0.select(*panel.columns, *out)


def signs(panel: DataFrame, spans=(10, 20)) -> DataFrame:
    d0 = panel.select("*", (F.col("close") - lag("close")).alias("_d"), (F.col("volume") - lag("volume")).alias("_dv"))
    out, x, v = [], F.col("_d"), F.col("_dv")
    for d in spans:
        w = last_n(d)
        up, down, total = (F.sum(F.greatest(x, F.lit(0.0))).over(w), F.sum(F.greatest(-x, F.lit(0.0))).over(w), F.sum(F.abs(x)).over(w))
        ok = F.count(x).over(w) == d
        out += [F.when(ok, F.avg((x > 0).cast("double")).over(w)).alias(f"cntp{d}"), F.when(ok, F.avg((x < 0).cast("double")).over(w)).alias(f"cntn{d}"), F.when(ok, up / (total + 1e-12)).alias(f"sump{d}"), F.when(ok, down / (total + 1e-12)).alias(f"sumn{d}"), F.when(ok, F.sum(F.greatest(v, F.lit(0.0))).over(w) / (F.sum(F.abs(v)).over(w) + 1e-12)).alias(f"vsump{d}")]
    return d0.select(*panel.columns, *out)


def overnight(panel: DataFrame) -> DataFrame:
    """Sums of overnight and intraday log returns, their difference and share of positive nights."""
    d = panel.select("*", F.log(F.col("open") / lag("close")).alias("_on"), F.log(F.col("close") / F.col("open")).alias("_id"))
    on, day = F.col("_on"), F.col("_id")
    out = [e for n in (5, 20, 60) for e in (full(F.sum(on), on, n, last_n(n)).alias(f"on{n}"), full(F.sum(day), day, n, last_n(n)).alias(f"id{n}"))]
    return d.select(*panel.columns, *out, full(F.sum(on - day), on, 20, last_n(20)).alias("on_less_id20"), full(F.stddev_samp(on), on, 20, last_n(20)).alias("on_std20"), full(F.avg((on > 0).cast("double")), on, 20, last_n(20)).alias("on_pos20"))


def tails(panel: DataFrame) -> DataFrame:
    """Mean of the three largest of 20 returns, largest of 60, smallest of 20, population skewness of 60."""
    d = panel.withColumn("_r", gain())
    r = F.col("_r")
    top = F.slice(F.sort_array(F.collect_list(r).over(last_n(20)), asc=False), 1, 3)
    w = last_n(60)
    m1, m2, m3 = (F.avg(r**k).over(w) for k in (1, 2, 3))
    var = m2 - m1 * m1
    return d.select(
        *panel.columns,
        F.when(F.count(r).over(last_n(20)) == 20, (top[0] + top[1] + top[2]) / 3).alias("max3_20"),
        full(F.max(r), r, 60, w).alias("max60"),
        full(F.min(r), r, 20, last_n(20)).alias("min20"),
        F.when((F.count(r).over(w) == 60) & (var > 1e-12), (m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1) / F.pow(var, F.lit(1.5))).alias("skew60"),
    )


def turnover_block(panel: DataFrame) -> DataFrame:
    t, r = F.col("turnover"), gain()
    d = panel.withColumn("_illiq", F.abs(r) / F.col("amount") * 1e6)
    return d.select(
        *panel.columns,
        (mean("turnover", 5) / mean("turnover", 60)).alias("turn5_60"),
        (full(F.max(t), t, 20, last_n(20)) / full(F.sum(t), t, 20, last_n(20))).alias("turn_conc20"),
        ((t - mean("turnover", 60)) / full(F.stddev_samp(t), t, 60, last_n(60))).alias("turn_z60"),
        mean("_illiq", 20).alias("amihud20"),
    )


def previous_day(panel: DataFrame) -> DataFrame:
    """Shape of the day before: position in 60 rows (25 at least), highest of 20 (5 at least), amount against five rows before."""
    c = F.col("close")
    low, high = full(F.min("low"), c, 60, last_n(60, 1), 25), full(F.max("high"), c, 60, last_n(60, 1), 25)
    return panel.select("*", lag("close").alias("prev_close"), lag("amount").alias("prev_amount"), ((lag("close") - low) / F.nullif(high - low, F.lit(0.0))).alias("pos60"), full(F.max("high"), c, 20, last_n(20, 1), 5).alias("platform"), (lag("amount") / mean("amount", 5, 2)).alias("amount_ratio"))


def future_max(panel: DataFrame, n: int = 20) -> DataFrame:
    """Highest high of the next rows, at most n, and how many there are."""
    return panel.select("*", F.max("high").over(ahead(n)).alias("max_ahead"), F.count("high").over(ahead(n)).alias("n_ahead"))


def views(x: np.ndarray, n: int) -> np.ndarray:
    """The full windows of n values, one for each row from the n-th on."""
    return np.lib.stride_tricks.sliding_window_view(x, n) if len(x) >= n else np.zeros((0, n), x.dtype)


def from_nth(x: np.ndarray, n: int, rows: int) -> np.ndarray:
    """A value for each full window as a column of all rows; the first n - 1 have none."""
    out = np.full(rows, np.nan)
    out[n - 1 :] = x
    return out


def arrays_of_code(df: DataFrame, inputs: list[str], compute: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], outputs: dict[str, str]) -> DataFrame:
    """``df`` with columns ``outputs`` (name and type), worked out for each code from arrays of its ``inputs`` in order of date; null is NaN.

    For windows whose aggregates Spark works out anew for every row.  A group is one code's rows.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("date")
        out = compute({c: table[c].to_numpy().astype(float) for c in inputs})
        for name, kind in outputs.items():
            column = pa.array(out[name], pa.float64(), from_pandas=True)
            table = table.append_column(name, column.cast(pa.int32()) if kind == "int" else column)
        return table

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{n}` {t}" for n, t in outputs.items())])
    return df.groupBy("code").applyInArrow(run, schema)
