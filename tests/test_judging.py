import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.operators import families, judging, labels

D0 = dt.date(2020, 1, 1)


def day(k):
    return D0 + dt.timedelta(days=k)


def test_thresholds_take_overrides_and_refuse_unknown_rules(spark):
    rows = spark.createDataFrame([("a", 1.0, 5.0), ("b", 1.0, 5.0), ("b", 3.0, None), (None, 0.0, 9.0)], "seg string, x double, y double")
    defaults = {"x": ("x", 1.0), "y": ("y", 4.0)}
    got = [r.failed for r in judging.threshold_rules(rows, defaults, {"b": {"x": 2.0}}, "seg").collect()]
    assert got == ["", "x", "y", "x"]
    with pytest.raises(ValueError, match="z"):
        judging.threshold_rules(rows, defaults, {"b": {"z": 2.0}}, "seg")


def test_matched_baseline_takes_broken_ranks(spark):
    rng = np.random.default_rng(2)
    hits = rng.integers(0, 2, (40, 6))
    chosen = rng.random((40, 6)) < 0.25
    chosen[7] = False
    rows = spark.createDataFrame([(day(d), k + 1, int(hits[d, k]), bool(chosen[d, k])) for d in range(40) for k in range(6)], "date date, rank int, hit int, chosen boolean")
    got = judging.matched_baseline(rows, F.col("chosen"), rows.select("date").distinct(), lags=2).first()
    k = chosen.sum() / 40
    share = np.clip(k - np.arange(6), 0, 1)
    base, own = (hits * share).sum(1), (hits * chosen).sum(1)
    u = own - base
    e = u - u.mean()
    lrv = (e @ e) + 2 * sum((1 - j / 3) * (e[j:] @ e[:-j]) for j in (1, 2))
    assert got.volume == chosen.sum() and got.k == pytest.approx(k) and got.precision == pytest.approx(own.sum() / chosen.sum()) and got.base == pytest.approx(base.sum() / chosen.sum())
    assert got.t == pytest.approx(u.mean() / (np.sqrt(lrv) / 40))
    none = judging.matched_baseline(rows, F.lit(False), rows.select("date").distinct(), lags=2).first()
    assert none.volume == 0 and none.precision is None


def test_tops_of_waves(spark):
    """A step that falls back has a top and the day before it marked; one still high, or too near the end, has none."""
    close = [10.0] * 10 + [20.0] * 10 + [9.0] * 40
    rows = [(1, day(k), c, c * 1.01) for k, c in enumerate(close)] + [(2, day(k), c, c * 1.01) for k, c in enumerate([10.0] * 30 + [20.0] * 30)]
    d = labels.label_up(spark.createDataFrame(rows, "code long, date date, close double, high double"))
    got = {(r.code, r.date): r.top for r in families.label_top(d).collect()}
    assert [k for k in range(60) if got[1, day(k)] == 1] == [9, 10] and all(got[1, day(k)] is None for k in range(40, 60))
    assert not any(got[2, day(k)] for k in range(60))


def test_rolling_median_matches_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(c, day(2 * k), None if (c + k) % 7 == 0 else float(np.round(rng.normal() * 0.3, 3))) for c in range(7) for k in range(50)]
    got = {r.date: (r.n, r.mid) for r in families.rolling_scale(spark.createDataFrame(rows, "code long, date date, x double"), "x", 30).collect()}
    for d in {r[1] for r in rows}:
        past = [x for _, e, x in rows if x is not None and 1 <= (d - e).days <= 30]
        assert got[d][0] == len(past) and (got[d][1] is None if not past else got[d][1] == pytest.approx(np.median(past)))


def test_conformal_p_and_selection(spark):
    rng = np.random.default_rng(9)
    rows = [(c, day(k * 3), float(rng.normal()) + (4.0 if c == 0 and k > 150 else 0), int(rng.random() < 0.1)) for c in range(12) for k in range(200)]
    got = {(r.code, r.date): (r.p, r.selected) for r in families.conformal(spark.createDataFrame(rows, "code long, date date, s double, y int"), "s", "y", gap=5).collect()}
    month = lambda d: d.year * 12 + d.month
    dates = [day(k * 3) for k in range(200)]
    closed = {(c, d): dates[k + 5] for c in range(12) for k, d in enumerate(dates[:-5])}
    for d in dates[::17]:
        start = d.replace(day=1)
        past = [s for c, e, s, y in rows if y == 0 and (c, e) in closed and closed[c, e] < start and month(d) - 12 <= month(e)]
        ps = {c: (1 + sum(x >= s for x in past)) / (len(past) + 1) for c, e, s, _ in rows if e == d} if past else {}
        order = sorted(ps, key=lambda c: (ps[c], c))
        last = max((k + 1 for k, c in enumerate(order) if ps[c] <= 0.1 * (k + 1) / len(order)), default=0)
        for c in range(12):
            assert got[c, d] == ((pytest.approx(ps[c]), order.index(c) < last) if past else (None, None))
    assert sum(bool(v[1]) for (c, _), v in got.items() if c == 0) > 10
