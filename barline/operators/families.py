"""Further feature families, event counters, auction snapshots and list statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.functions.scalars import clip, tent
from barline.operators.crosssection import pct_rank
from barline.operators.windows import arrays_of_code, by_code, from_nth, full, gain, lag, last_n, views
from barline.sources.roundtrips import written


def limit_flags(panel: DataFrame, limit: float = 0.045) -> DataFrame:
    """Closed at the limit, touched but not closed there, fell by it, never traded below it."""
    p = lag("close")
    up = (F.col("close") / p - 1 >= limit) & (F.col("close") >= F.col("high"))
    touched = F.col("high") / p - 1 >= limit
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return panel.select("*", flag(up).alias("lu"), flag(touched & ~up).alias("zb"), flag(F.col("close") / p - 1 <= -limit).alias("ld"), flag(F.col("low") / p - 1 >= limit).alias("one_word"))


def sentiment_days(flagged: DataFrame) -> DataFrame:
    """Per date: limit-ups, blow-ups and their share, limit-downs, and how yesterday's limit-ups did."""
    d = flagged.select("*", gain().alias("_r"), F.lag("lu").over(by_code()).alias("_lu1"))
    g = d.groupBy("date").agg(F.sum("lu").alias("n_lu"), F.sum("zb").alias("n_zb"), F.sum("ld").alias("n_ld"), F.avg(F.when(F.col("_lu1") == 1, F.col("_r"))).alias("prev_lu_ret"), F.avg(F.when(F.col("_lu1") == 1, F.col("lu").cast("double"))).alias("promoted"))
    return g.withColumn("zb_rate", F.col("n_zb") / F.nullif((F.col("n_lu") + F.col("n_zb")).cast("double"), F.lit(0.0)))


def contraction(panel: DataFrame) -> DataFrame:
    d = panel.withColumn("_r", gain())
    std = lambda n: full(F.stddev_pop("_r"), F.col("_r"), n, last_n(n))
    c = F.col("close")
    box = lambda n: full(F.max("high"), c, n, last_n(n)) / full(F.min("low"), c, n, last_n(n)) - 1
    return d.select(*panel.columns, (std(5) / F.nullif(std(60), F.lit(0.0))).alias("std5_60"), (box(20) / F.nullif(box(120), F.lit(0.0))).alias("box20_120"), (c / full(F.max("high"), c, 20, last_n(20, 1)) - 1).alias("break20"), (c / full(F.max("high"), c, 60, last_n(60, 1)) - 1).alias("break60"))


def horizons(panel: DataFrame) -> DataFrame:
    """Distance to highs and lows of two horizons, and rows since the highest high, the last of equal ones."""
    sizes = (120, 250)

    def compute(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        close, out = x["close"], {}
        high, low = np.where(np.isnan(x["high"]), -np.inf, x["high"]), np.where(np.isnan(x["low"]), np.inf, x["low"])
        for n in sizes:
            whole = ~np.isnan(views(close, n)).any(1)
            top, bottom = views(high, n).max(1), views(low, n).min(1)
            column = lambda v, ok, n=n, whole=whole: from_nth(np.where(whole & ok, v, np.nan), n, len(close))
            out[f"_high{n}"], out[f"_low{n}"] = column(top, top > -np.inf), column(bottom, bottom < np.inf)
            out[f"since_high{n}"] = column(views(high, n)[:, ::-1].argmax(1), True)
        return out

    d = arrays_of_code(panel, ["close", "high", "low"], compute, {k: t for n in sizes for k, t in ((f"_high{n}", "double"), (f"_low{n}", "double"), (f"since_high{n}", "int"))})
    c = F.col("close")
    return d.select(*panel.columns, *(e for n in sizes for e in ((c / F.col(f"_high{n}") - 1).alias(f"to_high{n}"), (c / F.col(f"_low{n}") - 1).alias(f"to_low{n}"), f"since_high{n}")))


def residual_momentum(panel: DataFrame, n: int = 60) -> DataFrame:
    """Sums of returns less beta times the market's, beta over n rows."""
    market = panel.withColumn("_r", gain()).withColumn("_m", F.avg("_r").over(Window.partitionBy("date")))
    w = last_n(n)
    beta = F.when(F.count("_r").over(w) == n, F.covar_pop("_r", "_m").over(w) / F.nullif(F.var_pop("_m").over(w), F.lit(0.0)))
    d = market.withColumn("beta", beta)
    total = lambda x: F.sum(x).over(last_n(20))
    return d.withColumn("res20", F.when(F.col("beta").isNotNull(), total("_r") - F.col("beta") * total("_m"))).drop("_r", "_m")


def industry_block(panel: DataFrame) -> DataFrame:
    """Per date and sector: size, median return, share of large gains over 5 market days, rank among sectors with five codes."""
    d = panel.withColumn("_r", gain())
    g = d.groupBy("date", "sector").agg(F.count("*").alias("n"), F.percentile("_r", F.lit(0.5)).alias("mid"), F.sum((F.col("_r") >= 0.045).cast("long")).alias("large"))
    w = Window.partitionBy("sector").orderBy("date").rowsBetween(-4, 0)
    return g.withColumn("large5", F.sum("large").over(w) / F.sum("n").over(w)).withColumn("place", pct_rank("mid", "date"))


def event_history(panel: DataFrame, flag: Column, n: int = 250, closed: int = 21) -> DataFrame:
    """Events in the n rows that end ``closed`` rows ago, and rows since the last of them, at most 600."""
    d = panel.withColumn("_f", F.coalesce(flag.cast("int"), F.lit(0))).withColumn("_t", F.row_number().over(by_code()))
    past = by_code().rowsBetween(Window.unboundedPreceding, -closed)
    last = F.max(F.when(F.col("_f") == 1, F.col("_t"))).over(past)
    return d.select(*panel.columns, F.coalesce(F.sum("_f").over(last_n(n, closed)), F.lit(0)).alias("events"), F.least(F.coalesce(F.col("_t") - last, F.lit(600)), F.lit(600)).alias("since_event"))


def interactions(df: DataFrame, pairs: list[tuple[str, int, str, int]]) -> DataFrame:
    """The smaller of two signed features for each pair."""
    return df.select("*", *(F.least(F.col(a) * sa, F.col(b) * sb).alias(f"{a}_and_{b}") for a, sa, b, sb in pairs))


def label_top(labelled: DataFrame, n: int = 60, fall: float = 0.2, open_rows: int = 20) -> DataFrame:
    """Adds ``top``: 1 on the highest high of a wave and the row before it, 0 elsewhere, null in a code's last ``open_rows`` rows.

    A wave begins on the first row of a run of positive labels y and goes on for ``n`` rows, or to the code's last one, three at
    least.  It has a top only if a later close of it lies more than ``fall`` below the high; of equal highs the first counts.
    """
    w = by_code().rowsBetween(0, n - 1)
    d = labelled.withColumn("_t", F.row_number().over(by_code())).withColumn("_last", F.count("*").over(Window.partitionBy("code")))
    begins = (F.col("y") == 1) & (F.coalesce(lag("y"), F.lit(0)) != 1)
    waves = d.withColumn("_begins", begins).withColumn("_peak", F.min_by(F.struct("_t", "high"), F.struct(-F.col("high"), F.col("_t"))).over(w)).where("_begins")
    waves = waves.select("code", F.col("_t").alias("_from"), F.least(F.col("_t") + n - 1, "_last").alias("_to"), F.col("_peak._t").alias("_top"), F.col("_peak.high").alias("_high")).where("_to - _from >= 2 AND _to > _top")
    # A wave's rows behind its top are told by their places, so each is one equal join.
    after = waves.select("code", "_top", "_high", F.explode(F.sequence(F.col("_top") + 1, F.col("_to"))).alias("_t")).join(d.select("code", "_t", "close"), ["code", "_t"])
    tops = after.where(F.col("close") < F.col("_high") * (1 - fall)).select("code", F.explode(F.array("_top", F.col("_top") - 1)).alias("_t")).distinct().withColumn("_hit", F.lit(1))
    out = d.join(tops, ["code", "_t"], "left")
    return out.select(*labelled.columns, F.when(F.col("_t") <= F.col("_last") - open_rows, F.coalesce("_hit", F.lit(0))).alias("top"))


def rolling_scale(df: DataFrame, x: str, days: int = 60, width: float = 1 / 256) -> DataFrame:
    """The median of ``x`` over all codes of the dates before, up to ``days`` calendar days, and how many values it is of.

    Values are counted by day and bucket of ``width``; running sums of days and then of buckets tell in which bucket each
    date's middle values lie, and only values of these buckets are looked at, by their rank in the bucket.
    """
    values = df.where(F.col(x).isNotNull()).select(F.col("date").alias("_d"), F.col(x).cast("double").alias("_x"), F.floor(F.col(x) / width).alias("_b"))
    counts = values.groupBy("_d", "_b").agg(F.count("*").alias("_k"))
    dates = df.select("date").distinct()
    # Days and buckets are few, whatever the number of codes.
    buckets = values.select(F.col("_b").alias("_gb")).distinct()
    grid = dates.crossJoin(F.broadcast(buckets)).join(counts, (F.col("date") == F.col("_d")) & (F.col("_gb") == F.col("_b")), "left").select("date", F.col("_gb").alias("_ab"), F.coalesce("_k", F.lit(0)).alias("_k"))
    past = Window.partitionBy("_ab").orderBy(F.datediff("date", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, -1)
    seen = grid.withColumn("_n", F.coalesce(F.sum("_k").over(past), F.lit(0))).where("_n > 0")
    by_bucket = Window.partitionBy("date").orderBy("_ab")
    seen = seen.withColumn("_below", F.sum("_n").over(by_bucket) - F.col("_n")).withColumn("n", F.sum("_n").over(Window.partitionBy("date")))
    # The middle one or two of n values have the places (n - 1) div 2 and n div 2, from 0.
    low, high = F.expr("(n - 1) DIV 2"), F.expr("n DIV 2")
    holds = lambda k: (k >= F.col("_below")) & (k < F.col("_below") + F.col("_n"))
    asked = seen.where(holds(low) | holds(high)).select("date", "_ab", "_n", "_below", "n", F.explode(F.sequence(F.date_sub("date", days), F.date_sub("date", 1))).alias("_ad"))
    near = asked.join(values, (F.col("_ad") == F.col("_d")) & (F.col("_ab") == F.col("_b")))
    ranked = near.withColumn("_at", F.col("_below") + F.row_number().over(Window.partitionBy("date", "_ab").orderBy("_x")) - 1)
    middle = ranked.where((F.col("_at") == low) | (F.col("_at") == high)).groupBy("date").agg(F.avg("_x").alias("mid"), F.first("n").alias("n"))
    return dates.join(middle, "date", "left").select("date", "mid", F.coalesce("n", F.lit(0)).alias("n"))


def rank_decay(lists: DataFrame, y: str = "y") -> DataFrame:
    """Rate by bucket of rank: 1-3, 4-10, 11-20, 21-50, beyond."""
    b = F.when(F.col("rank") <= 3, "01-03").when(F.col("rank") <= 10, "04-10").when(F.col("rank") <= 20, "11-20").when(F.col("rank") <= 50, "21-50").otherwise("51-")
    return lists.where(F.col(y).isNotNull()).groupBy(b.alias("bucket")).agg(F.count("*").alias("n"), F.avg(y).alias("rate"))


def conformal(rows: DataFrame, score: str, y: str, months_back: int = 12, gap: int = 20, rate: float = 0.1, width: float = 1 / 256) -> DataFrame:
    """Adds p, (1 + negatives that score as high) / (negatives + 1) over the ``months_back`` months before whose label had closed, and
    ``selected``, the rows that Benjamini and Hochberg's rule keeps at ``rate`` among the codes of the day; null without such negatives.

    Rows and sums are written, as each is read twice.  Negatives are summed by month and score first; those above a score come from sums of buckets of ``width`` and of the
    scores inside the bucket, so that no month's scores pass through one task.
    """
    d = rows.where(F.col(score).isNotNull() | F.col(y).isNotNull()).withColumn("_closed", F.lead("date", gap).over(by_code())).withColumn("_own", F.trunc("date", "month"))
    d = written(d.select("code", "date", score, y, "_closed", "_own"), "scores")
    past = d.where((F.col(y) == 0) & F.col(score).isNotNull() & F.col("_closed").isNotNull()).where(F.add_months(F.trunc("_closed", "month"), 1) <= F.add_months("_own", months_back))
    past = past.select(F.explode(F.expr(f"sequence(add_months(trunc(_closed, 'month'), 1), add_months(_own, {months_back}), interval 1 month)")).alias("month"), F.col(score).alias("_s"), F.lit(1).alias("_k"))
    new = d.where(F.col(score).isNotNull()).select("code", "date", F.col("_own").alias("month"), F.col(score).alias("_s"))
    sums = past.unionByName(new.select("month", "_s", F.lit(0).alias("_k"))).groupBy("month", "_s").agg(F.sum("_k").alias("_k")).withColumn("_b", F.floor(F.col("_s") / width))
    sums = written(sums, "sums")
    inside = F.sum("_k").over(Window.partitionBy("month", "_b").orderBy(F.col("_s").desc()))
    buckets = sums.groupBy("month", "_b").agg(F.sum("_k").alias("_n"))
    of_month = Window.partitionBy("month")
    buckets = buckets.select("month", "_b", (F.sum("_n").over(of_month.orderBy(F.col("_b").desc())) - F.col("_n")).alias("_above"), F.sum("_n").over(of_month).alias("_all"))
    p = F.when(F.col("_all") > 0, (1 + F.col("_above") + F.col("_inside")) / (F.col("_all") + 1))
    found = sums.withColumn("_inside", inside).join(buckets, ["month", "_b"]).select("month", "_s", p.alias("p"))
    out = new.join(found, ["month", "_s"])
    day = Window.partitionBy("date")
    place, n = F.row_number().over(day.orderBy(F.col("p").asc_nulls_last(), "code")), F.count("p").over(day)
    out = out.withColumn("_r", place).withColumn("_ok", F.col("p") <= rate * place / n)
    last = F.max(F.when(F.col("_ok"), F.col("_r"))).over(day)
    return out.select("code", "date", "p", F.when(F.col("p").isNotNull(), F.coalesce(F.col("_r") <= last, F.lit(False))).alias("selected"))


def credibility(df: DataFrame, score: str, y: str, n: int = 20, weight: float = 20.0) -> DataFrame:
    """Sum of y - score over rows of the code whose windows closed, shrunk by ``weight``."""
    w = by_code().rowsBetween(Window.unboundedPreceding, -n - 1)
    d = F.col(y) - F.col(score)
    return df.select("*", (F.coalesce(F.sum(d).over(w), F.lit(0.0)) / (F.count(d).over(w) + weight)).alias("cred"))


def softmax_excess(df: DataFrame, score: str, ret: str, temperature: float = 0.1) -> DataFrame:
    """Per date: return of the softmax-weighted portfolio less the mean return."""
    d = df.where(F.col(score).isNotNull() & F.col(ret).isNotNull()).withColumn("_e", F.exp((F.col(score) - F.max(score).over(Window.partitionBy("date"))) / temperature))
    return d.groupBy("date").agg((F.sum(F.col("_e") * F.col(ret)) / F.sum("_e") - F.avg(ret)).alias("excess"))


def event_shares(panel: DataFrame, events: DataFrame, value: str) -> DataFrame:
    """Events today, counts and value shares of the amount over 5 and 20 rows."""
    e = events.groupBy("code", "date").agg(F.count("*").alias("_n"), F.sum(value).alias("_v"))
    d = panel.join(e, ["code", "date"], "left").fillna(0, ["_n", "_v"])
    return d.select(*panel.columns, (F.col("_n") > 0).cast("int").alias("today"), *(x for n in (5, 20) for x in (F.sum("_n").over(last_n(n)).alias(f"n{n}"), (F.sum("_v").over(last_n(n)) / F.sum("amount").over(last_n(n))).alias(f"share{n}"))))


def snapshot_scores(points: DataFrame, prev: DataFrame) -> DataFrame:
    """Gap, slope and monotony of four snapshot prices against the last price before, and their curve scores."""
    d = points.join(prev, "code").where("at0 IS NOT NULL AND at12 IS NOT NULL")
    gap = F.col("at12") / F.col("prev") - 1
    slope = (F.col("at12") - F.col("at0")) / F.col("prev")
    d = d.withColumn("gap", gap).withColumn("slope", slope).withColumn("rising", ((F.col("at0") <= F.coalesce("at6", "at0")) & (F.coalesce("at6", "at0") <= F.col("at12"))).cast("int"))
    parts = 0.5 * tent(F.col("gap"), -0.05, 0.15, 0.03) + 0.3 * clip(F.col("slope") / 0.05, 0.0, 1.0) + 0.2 * F.col("rising")
    return d.withColumn("score", F.greatest(F.round(100 * parts + 1e-9, 1), F.lit(0.0)))


def amplitude(panel: DataFrame) -> DataFrame:
    """Amplitude on high against low closes (20 rows), returns of calm against wild days (120 rows), and pushes up against down.

    A window's values are sorted as pairs, so equal closes or amplitudes are ordered by the value beside them.  A
    code's pairs are sorted once; a window then sorts their places.
    """
    df = panel.select("code", "date", "open", "close", "high", "low", (F.col("high") / F.col("low") - 1).alias("amp"), gain().alias("r"), lag("close").alias("before"))

    def ends(key: np.ndarray, value: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((value, np.where(np.isnan(key), -np.inf, key)))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        places, value = np.sort(views(place, n), axis=1), value[order]
        return value[places[:, :k]].sum(1), value[places[:, -k:]].sum(1)

    def compute(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        rows = len(x["amp"])
        low, high = ends(x["close"], x["amp"], 20, 5)
        calm, wild = ends(x["amp"], x["r"], 120, 36)
        column = lambda v, name, n: from_nth(np.where(np.isnan(views(x[name], n)).any(1), np.nan, v), n, rows)

        def total(v: np.ndarray) -> np.ndarray:
            window = views(v, 20)
            return np.where(np.isnan(window).all(1), np.nan, np.nansum(window, 1))

        up, down = (np.where(np.isnan(x["before"]), np.nan, np.fmax(a - b, 0.0)) for a, b in ((x["high"], x["before"]), (x["before"], x["low"])))
        return {
            "ideal20": column((high - low) / 5, "amp", 20),
            "cut120": column(calm - wild, "r", 120),
            "push20": column(total(x["high"] - x["open"]) / (total(x["open"] - x["low"]) + 1e-9), "amp", 20),
            "range20": column(total(up) / (total(down) + 1e-9), "before", 20),
        }

    names = ["ideal20", "cut120", "push20", "range20"]
    return arrays_of_code(df, ["open", "close", "high", "low", "amp", "r", "before"], compute, dict.fromkeys(names, "double")).select("code", "date", *names)


def buyer_history(rows: DataFrame, buyer: str, day: str, y: str, lag: int = 21, prior: float = 0.08, weight: int = 10) -> DataFrame:
    """n250: the buyer's rows of the last 250 days; hit_n and hit_rate: those with an outcome known ``lag`` days ago, shrunk to the prior.

    ``day`` is a day number; rows of one day see each other in n250.
    """
    recent = Window.partitionBy(buyer).orderBy(day).rangeBetween(-249, 0)
    closed = Window.partitionBy(buyer).orderBy(day).rangeBetween(-250 - lag, -lag)
    known, hits = F.count(y).over(closed), F.coalesce(F.sum(y).over(closed), F.lit(0))
    return rows.withColumns({"n250": F.count(F.lit(1)).over(recent), "hit_n": known, "hit_rate": (hits + weight * prior) / (known + weight)})


def price_delay(rows: DataFrame, n: int = 60) -> DataFrame:
    """Adds d1, the share of explained variance that only the market's two lags explain, and lag_beta, the sum of their slopes, over ``n`` rows.

    ``rows`` has r and the market's returns m0, m1, m2 of the day and the two market days before.  Both are null in a
    window that isn't full, whose r doesn't move, or whose 3 by 3 system is singular (a determinant below 1e-9 of the variances' product).
    """
    w = last_n(n)
    names = ["r", "m0", "m1", "m2"]
    s = {a: F.sum(a).over(w) for a in names}
    pairs = [(a, b) for k, a in enumerate(names) for b in names[k:]]
    full = F.count(sum((F.col(a) for a in names), F.lit(0.0))).over(w) == n
    d = rows.select("*", full.alias("_full"), *(s[a].alias(f"_{a}") for a in names), *(F.sum(F.col(a) * F.col(b)).over(w).alias(f"_{a}{b}") for a, b in pairs))
    d = d.select(*rows.columns, "_full", *((F.col(f"_{a}{b}") - F.col(f"_{a}") * F.col(f"_{b}") / n).alias(f"c_{a}{b}") for a, b in pairs))
    c = lambda a, b: F.col(f"c_{a}{b}") if (a, b) in pairs else F.col(f"c_{b}{a}")
    m = names[1:]
    matrix = [[c(a, b) for b in m] for a in m]
    right = [c("r", a) for a in m]
    det = lambda x: x[0][0] * (x[1][1] * x[2][2] - x[1][2] * x[2][1]) - x[0][1] * (x[1][0] * x[2][2] - x[1][2] * x[2][0]) + x[0][2] * (x[1][0] * x[2][1] - x[1][1] * x[2][0])
    d = d.withColumn("_det", det(matrix))
    for k in range(3):
        d = d.withColumn(f"_b{k}", det([[right[i] if j == k else matrix[i][j] for j in range(3)] for i in range(3)]) / F.nullif(F.col("_det"), F.lit(0.0)))
    sound = F.col("_full") & (c("r", "r") > 1e-12) & (F.abs("_det") > 1e-9 * c("m0", "m0") * c("m1", "m1") * c("m2", "m2"))
    whole = sum((F.col(f"_b{k}") * right[k] for k in range(3)), F.lit(0.0)) / F.nullif(c("r", "r"), F.lit(0.0))
    alone = c("r", "m0") * c("r", "m0") / F.nullif(c("m0", "m0") * c("r", "r"), F.lit(0.0))
    return d.select(*rows.columns, F.when(sound & (whole > 0), 1 - alone / whole).alias("d1"), F.when(sound, F.col("_b1") + F.col("_b2")).alias("lag_beta"))
