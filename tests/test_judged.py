"""Amplitude's neighbours: robust days, peers, and rules and scores judged by what followed."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.functions import titles
from barline.operators import crosssection, families, holders, peers, selection


def huber(x, w, c=1.345, steps=10):
    m, s = np.median(x), 1.4826 * np.median(np.abs(x - np.median(x)))
    for _ in range(steps):
        h = w * np.minimum(1, c * s / np.maximum(np.abs(x - m), 1e-12))
        m = (h * x).sum() / h.sum()
    return m


def test_huber_location(spark):
    rng = np.random.default_rng(3)
    x, w = rng.normal(size=41), rng.uniform(0.5, 2, 41)
    x[:3] = 50.0
    rows = [(1, float(a), float(b)) for a, b in zip(x, w)] + [(1, 1e6, 0.0), (1, None, 1.0)]
    rows += [(2, 5.0, 1.0)] + [(2, 0.0, 1.0)] * 6 + [(3, 7.0, 2.0)]
    out = {r.day: r for r in crosssection.huber_location(spark.createDataFrame(rows, "day int, x double, w double"), "x", "w", "day").collect()}
    assert out[1].n == 41 and out[1].location == pytest.approx(huber(x, w))
    assert out[2].location == 0.0 and out[3].location == 7.0
    assert crosssection.huber_location(spark.createDataFrame([], "day int, x double, w double"), "x", "w", "day").count() == 0


def test_peers_are_those_that_move_alike(spark):
    rng = np.random.default_rng(5)
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=i) for i in range(90)]
    a, c = rng.normal(size=90), rng.normal(size=90)
    series = {1: a, 2: a + 0.1 * rng.normal(size=90), 3: c, 4: -a}
    rows = [("s", d, code, float(v)) for code, values in series.items() for d, v in zip(days, values)] + [("other", d, 9, float(v)) for d, v in zip(days, a)]
    df = spark.createDataFrame(rows, "sector string, date date, code int, r double")
    best = peers.peers(df, "sector", k=1)
    got = {(r.month.month, r.code): (r.peer, r.corr) for r in best.collect()}
    assert got[3, 1][0] == 2 and got[3, 2][0] == 1 and (3, 9) not in got
    past = slice(0, 60)
    assert got[3, 1][1] == pytest.approx(np.corrcoef(series[1][past], series[2][past])[0, 1], abs=1e-8)
    seen = {(r.date, r.code): r for r in peers.peer_returns(df, best).collect()}
    assert seen[days[70], 1].peer_r == pytest.approx(series[2][70]) and (days[5], 1) not in seen


def test_peers_read_returns_once_and_keep_the_best_over_blocks(spark, monkeypatch):
    """However pairs are cut into strips, blocks and parts; returns are dear and written, and equal correlations go to the smaller peer."""
    rng = np.random.default_rng(3)
    days = [datetime.date(2019, 11, 1) + datetime.timedelta(days=i) for i in range(120)]
    moves = {code: rng.normal(size=120).round(2) for code in range(12)}
    moves |= {20 + code: moves[code] for code in (3, 4, 5)}  # copies, so that correlations tie
    rows = [("a", d, code, float(x[i])) for code, x in moves.items() for i, d in enumerate(days) if (code + i) % 4]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "sector string, date date, code long, r double")
    whole = {tuple(r) for r in peers.peers(df, "sector", k=4).collect()}
    for name, size in (("STRIP", 2), ("BLOCK", 3), ("PART", 6)):
        monkeypatch.setattr(peers, name, size)
    assert {tuple(r) for r in peers.peers(df, "sector", k=4).collect()} == whole and len(whole) > 150
    month = max(m for m, *_ in whole)
    past = [i for i, d in enumerate(days) if d < month]
    for code in (0, 3, 23):
        of = lambda p: [(moves[code][i], moves[p][i]) for i in past if (code + i) % 4 and (p + i) % 4]  # noqa: B023, E731
        want = sorted((-round(np.corrcoef(*zip(*of(p), strict=True))[0, 1], 9), p) for p in moves if p != code)[:4]
        got = sorted((-c, p) for m, own, p, c in whole if (m, own) == (month, code))
        assert [p for _, p in got] == [p for _, p in want] and [c for c, _ in got] == pytest.approx([c for c, _ in want], abs=2e-9)
    peers.beside_peers(df.mapInArrow(count, df.schema), "sector", k=4).collect()
    assert seen.value == len(rows)


def test_peers_of_many_parts_are_those_of_one_and_pairs_are_no_rows(spark, monkeypatch):
    rng = np.random.default_rng(9)
    days = [datetime.date(2019, 11, 1) + datetime.timedelta(days=i) for i in range(150)]
    rows = [("ab"[code % 2], d, code, float(np.round(rng.normal(), 1))) for code in range(14) for d in days if rng.random() < 0.7]
    rows += [("a", d, 100 + k, x) for k in (0, 1) for _, d, code, x in rows if code == 2] + [(None, days[0], 50, 1.0), ("a", days[3], 51, None)]  # copies tie
    df = spark.createDataFrame(rows, "sector string, date date, code long, r double")
    whole = {tuple(r) for r in peers.peers(df, "sector", k=3).collect()}
    monkeypatch.setattr(peers, "PART", 2)
    parts = {tuple(r) for r in peers.peers(df, "sector", k=3).collect()}
    assert whole == parts and len(whole) > 150
    months = sorted({m for m, *_ in whole})
    x = {(c, d): v for _, d, c, v in rows if v is not None}
    for month, code in {(m, c) for m, c, _, _ in whole if m == months[-1]}:
        corr = {}
        for peer in {c for s, _, c, _ in rows if s == {c: s for s, _, c, _ in rows}[code] and c != code}:
            both = [d for d in days if (code, d) in x and (peer, d) in x]
            past = [d for d in both if d < month]
            if len(past) >= 10 and any((d.year, d.month) == (month.year, month.month) for d in both):
                corr[peer] = round(float(np.corrcoef([x[code, d] for d in past], [x[peer, d] for d in past])[0, 1]), 9)
        best = sorted(corr, key=lambda p: (-corr[p], p))[:3]
        assert sorted(p for m, c, p, _ in whole if (m, c) == (month, code)) == sorted(best)
    beside = peers.beside_peers(df, "sector", k=3)
    want = {(r.code, r.date): r for r in peers.peer_returns(df, peers.peers(df, "sector", k=3)).collect()}
    got = {(r.code, r.date): r for r in beside.collect()}
    assert got.keys() == want.keys() and all(tuple(got[k][n] for n in ("n", "peer_r", "rest", "corr")) == pytest.approx(tuple(want[k][n] for n in ("n", "peer_r", "rest", "corr"))) for k in want)
    assert "SortMergeJoin" not in beside._jdf.queryExecution().executedPlan().toString()


def test_buyer_history(spark):
    rows = [(1, day, y) for day, y in [(0, 1), (0, 0), (30, None), (30, 1), (240, 0), (260, 1), (300, None)]] + [(None, 0, 1)]
    out = families.buyer_history(spark.createDataFrame(rows, "b int, d long, y int"), "b", "d", "y").where("b = 1")
    for r in out.collect():
        closed = [y for _, day, y in rows[:7] if r.d - 271 <= day <= r.d - 21 and y is not None]
        assert r.n250 == sum(r.d - 249 <= day <= r.d for _, day, _ in rows[:7])
        assert r.hit_n == len(closed) and r.hit_rate == pytest.approx((sum(closed) + 0.8) / (len(closed) + 10))


def test_conjunctions_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(*map(int, rng.integers(0, 2, 4)), int(rng.integers(0, 2)), bool(i % 2)) for i in range(300)] + [(None, 1, 1, 1, 1, False), (1, 1, 1, 1, None, True)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, y int, later boolean")
    out = {r.rule: r for r in selection.conjunctions(df, [F.col(c) == 1 for c in "abcd"], "y", F.col("later"), most=2, least=20, precision=0.5).collect()}
    assert len(out) == 10
    for rule, r in out.items():
        held = [x for x in rows if x[4] is not None and all(x[i] == 1 for i in range(4) if rule >> i & 1)]
        fit, confirm = [x[4] for x in held if not x[5]], [x[4] for x in held if x[5]]
        assert (r.n_fit, r.k_fit, r.n_confirm, r.k_confirm) == (len(fit), sum(fit), len(confirm), sum(confirm))
        assert r.kept == all(len(p) >= 20 and sum(p) >= 0.5 * len(p) for p in (fit, confirm))


def test_cumulative_precision_against_brute_force(spark):
    rng = np.random.default_rng(2)
    start = datetime.date(2020, 1, 1)
    rows = []
    for _ in range(600):
        day = start + datetime.timedelta(days=int(rng.integers(0, 150)))
        rows.append((day, float(rng.integers(-5, 6)) / 10, int(rng.integers(0, 2)), day + datetime.timedelta(days=20)))
    df = spark.createDataFrame(rows + [(start, None, 1, start)], "date date, s double, y int, closed date")
    out = selection.cumulative_precision(df, "s", "y", "closed", months=2, least=30, least_days=10).collect()
    assert out
    for r in out:
        first = r.month
        low = (first.replace(day=1) - datetime.timedelta(days=40)).replace(day=1)
        known = [x for x in rows if low <= x[0] < first and x[3] < first]
        levels = [x[1] for x in known if x[1] >= r.score]
        level = min(levels) if levels else None
        above = [x for x in known if level is not None and x[1] >= level]
        enough = len(above) >= 30 and len({x[0] for x in above}) >= 10
        assert r.p == pytest.approx(sum(x[2] for x in above) / len(above) if enough else 0.0), r


def test_future_changes(spark):
    old = spark.createDataFrame([(1, 1, 1.0), (1, 2, None), (1, 3, 3.0), (2, 1, 1.0)], "code int, date int, x double")
    new = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 1.0)], "code int, date int, x double")
    assert {tuple(r) for r in selection.future_changes(old, new, ["x"]).collect()} == {(1, 3, 1, 1), (2, 1, 0, 0)}


def test_titles(spark):
    df = spark.createDataFrame([("A: about a sale of stock notice", "x1"), ("sale and buyback", "y"), (None, "x2"), ("nothing", None)], "t string, c string")
    said = titles.announces(F.col("t"), "sale", ("buyback",), "^never")
    named = titles.classes(F.col("t"), F.col("c"), {"sale": ("", "sale", "buyback"), "x": ("x", "", "")})
    out = df.select(said.alias("said"), named.alias("named"), titles.shortened(F.col("t"), 6, "^[^:]*:", "^.*?about ").alias("short")).collect()
    assert [r.said for r in out] == [True, False, False, False]
    assert [r.named for r in out] == [["sale", "x"], [], ["x"], []]
    assert out[0].short == "a sale" and out[2].short is None


def test_top_holders(spark):
    rows = [(1, 1, "a", 5), (1, 1, "b", 3), (1, 1, "c", 3), (1, 2, "a", 6), (1, 2, "d", 2), (1, 2, "d", 2), (2, 2, "a", 1)]
    out = {(r.code, r.period): r for r in holders.top_holders(spark.createDataFrame(rows, "code int, period int, h string, s int"), "h", "s", 2).collect()}
    assert (out[1, 1].n_new, out[1, 1].ratio, out[1, 1].change) == (0, 8 / 11, None)
    assert (out[1, 2].n, out[1, 2].n_new, out[1, 2].n_up, out[1, 2].ratio) == (2, 1, 1, 1.0) and out[1, 2].change == pytest.approx(3 / 11)
    assert out[2, 2].n_new == 0


def test_huber_locations_of_many_days_are_one_shuffle(spark):
    """Every day's location from arrays, with dates as keys, nulls and weights of 0 left out; no plan of one expression per step and value."""
    rng = np.random.default_rng(9)
    days = [datetime.date(2021, 1, 1) + datetime.timedelta(days=i) for i in range(40)]
    rows = [(d, float(x), float(w)) for d in days for x, w in zip(rng.standard_t(2, 200), rng.uniform(0, 2, 200))] + [(d, None, 1.0) for d in days]
    frame = crosssection.huber_location(spark.createDataFrame(rows, "day date, x double, w double"), "x", "w", "day")
    assert "aggregate(" not in frame._jdf.queryExecution().optimizedPlan().toString()
    out = {r.day: r for r in frame.collect()}
    for d in days:
        x, w = np.array([r[1:] for r in rows if r[0] == d and r[1] is not None]).T
        assert out[d].n == 200 and out[d].location == pytest.approx(huber(x, w))


@pytest.fixture(scope="module")
def bars(spark):
    """Two codes with gaps and ties; one has fewer rows than any window."""
    rng = np.random.default_rng(12)
    rows = []
    for code, n in ((1, 300), (2, 15)):
        for i in range(n):
            o, c = (float(np.round(10 + rng.normal(), 1)) for _ in range(2))
            high, low = max(o, c) + 0.1, min(o, c) - 0.1
            rows.append((code, datetime.date(2020, 1, 1) + datetime.timedelta(days=i), None if i == 7 else o, c, None if i == 30 else high, low))
    return spark.createDataFrame(rows, "code long, date date, open double, close double, high double, low double").repartition(3), rows


def test_amplitude_against_brute_force(bars):
    frame, rows = bars
    out = families.amplitude(frame)
    assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()  # no window gathers 120 pairs for every row
    got = {(r.code, r.date): r for r in out.collect()}
    own = [r for r in rows if r[0] == 1]
    amp = [None if r[4] is None else r[4] / r[5] - 1 for r in own]
    gains = [None] + [b[3] / a[3] - 1 for a, b in zip(own, own[1:])]
    for i, (code, date, *_) in enumerate(own):
        r, last = got[code, date], range(max(i - 19, 0), i + 1)
        if i < 19 or any(amp[k] is None for k in last):
            assert r.ideal20 is None and r.push20 is None
        else:
            pairs = [v for _, v in sorted((own[k][3], amp[k]) for k in last)]
            assert r.ideal20 == pytest.approx((sum(pairs[-5:]) - sum(pairs[:5])) / 5)
            there = [k for k in last if own[k][2] is not None]
            assert r.push20 == pytest.approx(sum(own[k][4] - own[k][2] for k in there) / (sum(own[k][2] - own[k][5] for k in there) + 1e-9))
        if i < 120:
            assert r.cut120 is None
        else:
            pairs = [v for _, v in sorted((-9.0 if amp[k] is None else amp[k], gains[k]) for k in range(i - 119, i + 1))]
            assert r.cut120 == pytest.approx(sum(pairs[:36]) - sum(pairs[-36:]))
    assert all(r.ideal20 is r.cut120 is r.push20 is r.range20 is None for (c, _), r in got.items() if c == 2) and len(got) == len(rows)


def test_horizons_against_brute_force(bars):
    frame, rows = bars
    out = families.horizons(frame)
    assert "max_by" not in out._jdf.queryExecution().executedPlan().toString()  # no window compares 250 rows anew for every row
    got = {(r.code, r.date): r for r in out.collect()}
    own = [r for r in rows if r[0] == 1]
    for i, (code, date, _, close, *_) in enumerate(own):
        r = got[code, date]
        for n in (120, 250):
            if i < n - 1:
                assert r[f"to_high{n}"] is r[f"to_low{n}"] is r[f"since_high{n}"] is None
                continue
            high = [(-1.0 if own[k][4] is None else own[k][4], k) for k in range(i - n + 1, i + 1)]
            assert r[f"to_high{n}"] == pytest.approx(close / max(high)[0] - 1) and r[f"since_high{n}"] == i - max(high)[1]
            assert r[f"to_low{n}"] == pytest.approx(close / min(own[k][5] for k in range(i - n + 1, i + 1)) - 1)
    assert len(got) == len(rows) and out.columns[: len(frame.columns)] == frame.columns
