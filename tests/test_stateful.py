import datetime as dt

import numpy as np
import pytest

from barline.operators import costbasis, patterns
from barline.streaming import stateful

D0 = dt.date(2024, 1, 1)


def day(k):
    return D0 + dt.timedelta(days=k)


def bars(spark, n=90, codes=3):
    rng = np.random.default_rng(4)
    rows = []
    for code in range(codes):
        close = 10 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
        for k in range(n):
            if code == 1 and k % 11 == 5:
                continue
            t = 1.0 if k == 40 and code == 2 else float(rng.uniform(0, 0.4))
            rows.append((code, day(k), k, float(close[k] * 1.02), float(close[k] * 0.97), float(close[k]), None if k == 7 else t))
    return spark.createDataFrame(rows, "code long, date date, day long, high double, low double, close double, turnover double")


def by_key(df, columns):
    return {(r.code, r.date): tuple(None if r[c] is None else round(r[c], 9) for c in columns) for r in df.collect()}


def test_carried_state_equals_the_batch_also_after_a_restart(spark, tmp_path):
    """The second replay goes on from the first one's checkpoint; repeated and late bars change nothing."""
    b = bars(spark)
    early, late = b.where("day < 50"), b.where("day >= 45")
    stateful.replay(early, stateful.carried, [str(day(20))], str(tmp_path))
    out = stateful.replay(late, stateful.carried, [str(day(60)), str(day(61))], str(tmp_path))
    want = by_key(costbasis.cost_basis(b), costbasis.COLUMNS)
    got = by_key(out, costbasis.COLUMNS)
    assert out.count() == len(want) and got.keys() == want.keys()
    for k, v in want.items():
        assert all((x is None and y is None) or x == pytest.approx(y, abs=1e-8) for x, y in zip(v, got[k], strict=True)), k
    runs = {(r.code, r.date): r.run for r in out.collect()}
    assert runs[0, day(89)] == 90 and runs[1, day(4)] == 5 and runs[1, day(6)] == 1 and runs[1, day(15)] == 10


def test_profile_matches_a_plain_recursion(spark):
    """Bar by bar over a fixed grid, as the definition says."""
    cells, b = 360, bars(spark, 60, 3).where("code = 2").toPandas().sort_values("date")
    step = np.log(100) / (cells - 1)
    origin = np.log(b["close"].iloc[0]) - np.log(10)
    grid = origin + step * np.arange(-50, cells + 50)
    mass, want = np.zeros(len(grid)), []
    for r in b.itertuples():
        turn = 0.0 if np.isnan(r.turnover) else r.turnover
        h, l, c = np.log(r.high), np.log(r.low), np.log(r.close)
        tri = np.maximum(0, 1 - np.abs(grid - (h + l + c) / 3) / max((h - l) / 2, step)) * ((grid >= l - step) & (grid <= h + step))
        mass = mass * (1 - turn) + tri / tri.sum() * turn
        share, price = mass / mass.sum(), np.exp(grid)
        below = np.cumsum(share)
        want.append((price @ share, share[grid <= c].sum(), (price[np.argmax(below >= 0.95)] - price[np.argmax(below >= 0.05)]) / (price @ share), r.close / (price @ share) - 1, price[share.argmax()] / r.close - 1))
    got = costbasis.Holdings(cells).advance(*(b[x].to_numpy() for x in ("high", "low", "close", "turnover")))
    assert np.allclose(got, want, atol=1e-9)


def listings(spark, rows):
    return spark.createDataFrame([(c, day(k), k, r) for c, k, r in rows], "code long, date date, day long, rank int")


def test_pool_equals_the_batch_with_late_and_empty_days(spark, tmp_path):
    own = [(1, 0, 3), (1, 1, 2), (1, 2, 5), (1, 63, 1), (2, 5, 4), (2, 67, 4), (3, 10, 2), (4, 150, 1), (1, 150, 2), (5, 0, 1), (5, 30, 1), (5, 90, 1)]
    clock = [(0, k, None) for k in range(200)]
    stateful.replay(listings(spark, [x for x in own + clock if x[1] < 64]), stateful.pool, [str(day(3)), str(day(20)), str(day(40))], str(tmp_path))
    late = [(7, 12, 1)]  # told when the clock is at day 100 and more
    out = stateful.replay(listings(spark, [x for x in own + clock if x[1] >= 64]), stateful.pool, [str(day(100)), str(day(120)), str(day(160))], str(tmp_path))
    out = stateful.replay(listings(spark, late), stateful.pool, [], str(tmp_path))
    got = {(r.code, r.stay): (r.first, r.last, r.days, r.best, r.streak, r.expired) for r in stateful.newest(out).collect()}
    calendar = spark.createDataFrame([(day(k), k) for k in range(200)], "date date, day long")
    batch = patterns.pool_days(listings(spark, own).drop("day"), calendar)
    want = {(r.code, r.stay): (r.first, r.last, r.days, r.best, r.streak, (r.last - D0).days + 62 <= 199) for r in batch.collect()}
    assert got == want
    assert want[1, 1][:3] == (day(0), day(63), 4) and want[2, 2][0] == day(67) and want[2, 1][1] == day(5)


def test_micro_batches_are_handed_in_by_many_tasks(spark, tmp_path):
    """A range of dates is not written, nor read, by one task; empty ranges are batches too."""
    b = bars(spark).repartition(4)
    out = stateful.replay(b, stateful.carried, [str(day(30)), str(day(60)), str(day(300))], str(tmp_path))
    assert out.count() == b.count()
    sizes = [b.where(f"day >= {low} AND day < {high}").count() for low, high in ((0, 30), (30, 60), (60, 300))]
    files = list((tmp_path / "in").glob("*.parquet"))
    assert all(sizes) and len(files) > 6
