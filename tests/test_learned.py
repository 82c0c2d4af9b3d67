import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators import boosting, calibration, families, funnel, linear, resampling


def training(spark, seed=5, n=600, k=3, models=2):
    """Rows whose label leans on the first feature; the second only adds noise, the third speaks against it."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k))
    x[rng.random(n) < 0.05, 1] = np.nan
    y = (rng.random(n) < 1 / (1 + np.exp(1 - 1.5 * x[:, 0] + 0.8 * x[:, 2]))).astype(int)
    w = rng.uniform(0.5, 1.5, n)
    rows = [(int(m), int(y[i]), float(w[i]), i % 997, *(None if np.isnan(v) else float(v) for v in x[i])) for i in range(n) for m in range(models) if (i + m) % 3]
    return spark.createDataFrame(rows, "model int, y byte, w double, u int, " + ", ".join(f"f{j} double" for j in range(k))).repartition(3)


@pytest.mark.parametrize(("l1", "l2", "held"), [(0.0, 1e-3, ()), (20.0, 0.0, ()), (0.0, 1e-3, ("f0", "f1", "f2")), (5.0, 0.5, ("f2",))])
def test_linear_models_are_optimal(spark, l1, l2, held):
    """No small move of any coefficient makes the penalised loss less; signs and zeros are kept."""
    names = ["f0", "f1", "f2"]
    table = training(spark)
    got = linear.fit(table, names, 2, l1, l2, held)
    assert (got.violation <= 1e-9).all()
    for m in range(2):
        d = table.where(F.col("model") == m).toPandas()
        z = d[names].fillna(0).to_numpy()
        assert np.allclose(got.mean[m], z.mean(0)) and np.allclose(got.scale[m], z.std(0) + 1e-9)
        z = np.c_[(z - z.mean(0)) / (z.std(0) + 1e-9), np.ones(len(z))]
        w, y = d["w"] / d["w"].mean(), d["y"]

        def loss(b):
            s = z @ b
            return float((w * (np.logaddexp(0, s) - y * s)).sum()) + l1 * np.abs(b[:-1]).sum() + l2 * (b[:-1] ** 2).sum()  # noqa: B023

        least = loss(got.beta[m])
        for j, step in itertools.product(range(4), (1e-4, -1e-4, 1e-2, -1e-2)):
            moved = got.beta[m].copy()
            moved[j] += step
            if j < 3 and names[j] in held and moved[j] < 0:
                continue
            assert loss(moved) > least - 1e-9
        assert all(got.beta[m][names.index(n)] >= 0 for n in held)
    if l1 == 20.0:
        assert (got.beta[:, 1] == 0).all() and (got.beta[:, 0] > 0).all()
    scored = linear.scored(table.select("model", *names), got.predict, names).collect()
    assert all(0 < r.p < 1 for r in scored) and len(scored) == table.count()


def binned(spark, seed=2, n=900):
    rng = np.random.default_rng(seed)
    b = rng.integers(0, 5, size=(n, 3))
    y = (rng.random(n) < 0.1 + 0.15 * b[:, 0] * (b[:, 1] > 2)).astype(int)
    rows = [(m, int(y[i]), 1.0 + (i % 3), int(i * 37 % boosting.DRAWS), *map(int, b[i])) for i in range(n) for m in range(2) if i % (m + 2)]
    return spark.createDataFrame(rows, "model int, y byte, w double, u int, b0 byte, b1 byte, b2 byte").repartition(3)


def plain(d, p):
    """The same trees by exhaustive search, one model, row by row."""
    x, y, w, u = d[["b0", "b1", "b2"]].to_numpy(), d["y"].to_numpy(float), d["w"].to_numpy(), d["u"].to_numpy(np.int64)
    q = (w * y).sum() / w.sum()
    margin = np.full(len(y), np.round(np.log(q / (1 - q)), 9))
    for t in range(p.trees):
        r = 1 / (1 + np.exp(-margin))
        g, h, seen = w * (r - y), w * r * (1 - r), u * p.step(t) % boosting.DRAWS % 10 < p.rows
        node = np.ones(len(y), int)
        for level in range(p.depth):
            for k in set(node.tolist()):
                if k < 1 << level:
                    continue
                own = (node == k) & seen
                best = (0.0, None, None)
                for f in range(3):
                    for b in range(p.bins + 1):
                        left = own & (x[:, f] <= b)
                        right = own & (x[:, f] > b)
                        if p.sees(t, f) and h[left].sum() >= p.least and h[right].sum() >= p.least:
                            gain = round(sum(g[s].sum() ** 2 / (h[s].sum() + p.l2) for s in (left, right)) - g[own].sum() ** 2 / (h[own].sum() + p.l2), 7)
                            if gain > best[0]:
                                best = (gain, f, b)
                if best[1] is not None:
                    node = np.where(node == k, 2 * k + (x[:, best[1]] > best[2]), node)
        for k in set(node.tolist()):
            s = (node == k) & seen
            if s.any():
                margin[node == k] += -p.rate * g[s].sum() / (h[s].sum() + p.l2)
    return margin


@pytest.mark.parametrize("refresh", [25, 2])
def test_boosting_matches_an_exhaustive_search(spark, refresh):
    """Also when the table is written anew with its margins every other tree."""
    table, p = binned(spark), boosting.Boosting(trees=5, depth=2, bins=4, refresh=refresh)
    forest = boosting.fit(table, 2, p)
    for m in range(2):
        d = table.where(F.col("model") == m).toPandas()
        got = forest.margin(np.full(len(d), m), d[["b0", "b1", "b2"]].to_numpy(), p.depth)
        assert np.allclose(got, plain(d, p), atol=1e-9)
    scored = boosting.score(table, forest, p).toPandas()
    assert scored[scored.y == 1].margin.mean() > scored[scored.y == 0].margin.mean() + 0.2


def test_learners_of_the_same_slices_grow_in_the_same_passes(spark, monkeypatch):
    """Each as it would alone, though trees and depths differ; rows are written once and read as blocks, not as rows, by every level."""
    arms = [boosting.Boosting(trees=n, depth=d, bins=4, seed=k, refresh=2, gap=5, months_back=6) for k, (n, d) in enumerate([(4, 2), (3, 3), (5, 2)])]
    for got, p in zip(boosting.fit_arms(binned(spark), 2, arms), arms, strict=True):
        alone = boosting.fit(binned(spark), 2, p)
        assert len(got.value) == p.trees == len(alone.value)
        assert all((a == b).all() for a, b in zip(got.feature + got.cut, alone.feature + alone.cut, strict=True)) and all(np.allclose(a, b, atol=1e-9) for a, b in zip(got.value, alone.value, strict=True))
    rows = [(c, dt.date(2020, 1, 1) + dt.timedelta(days=2 * k), int((k * 7 + c) % 5 == 0), (k + c) % 5) for c in range(5) for k in range(240)]
    ready = spark.createDataFrame(rows, "code long, date date, y int, b0 byte").withColumn("_closed", F.date_add("date", 10))
    real, names = boosting.written, []
    monkeypatch.setattr(boosting, "written", lambda df, name, *by: names.append((name, df.columns)) or real(df, name, *by))
    months = [dt.date(2020, 12, 1), dt.date(2021, 1, 1)]
    scored, forests, tables = boosting.walk(ready, months, arms)
    assert [n for n, _ in names].count("training") == [n for n, _ in names].count("packed") == 1 and tables[0] is tables[2]
    for r in scored.collect():
        one = [f.margin(np.array([r.model]), np.array([[r.b0]]), p.depth)[0] for f, p in zip(forests, arms, strict=True)]
        assert r.margin == pytest.approx(np.mean(one), abs=1e-9)


def test_boosting_without_a_split_is_the_base_rate(spark):
    table = spark.createDataFrame([(0, k % 2, 1.0, 0, 3) for k in range(10)], "model int, y byte, w double, u int, b0 byte")
    forest = boosting.fit(table, 1, boosting.Boosting(trees=2, bins=4))
    assert forest.margin(np.zeros(1, int), np.array([[3]]), 3)[0] == pytest.approx(0.0)


def test_slices_are_purged_and_drawn(spark):
    rows = [(c, dt.date(2020, 1, 1) + dt.timedelta(days=3 * k), int((k + c) % 9 == 0), 1) for c in range(4) for k in range(240)]
    d = spark.createDataFrame(rows, "code long, date date, y int, b0 byte")
    p = boosting.Boosting(gap=5, per_positive=2, months_back=6)
    months = [dt.date(2021, 1, 1), dt.date(2021, 7, 1)]
    got = boosting.slices(d, months, p, keep=["code", "date", "b0"]).collect()
    for r in got:
        assert r.date + dt.timedelta(days=15) < months[r.model] and r.date >= dt.date(2020, 7, 1) and (r.model == 0 or r.date >= dt.date(2021, 1, 1))
    for m in (0, 1):
        own = [r for r in got if r.model == m]
        whole = [x for x in rows if x[2] and x[1] + dt.timedelta(days=15) < months[m] and x[1] >= (dt.date(2020, 7, 1), dt.date(2021, 1, 1))[m]]
        assert sum(r.y for r in own) == len(whole) and len(own) < 3.6 * len(whole)
        by_month = {}
        for r in own:
            by_month[r.date.month] = by_month.get(r.date.month, 0) + r.w
        assert max(by_month.values()) == pytest.approx(min(by_month.values()))


def test_isotonic_matches_the_min_max_formula(spark):
    rng = np.random.default_rng(3)
    rows = [(m, float(s) / 10, int(rng.random() < 0.02 * s)) for m in ("a", "b") for s in rng.integers(0, 40, 400)] + [("c", 1.0, 1), ("a", None, 1), ("a", 1.0, None)]
    frame = spark.createDataFrame(rows, "month string, score double, y int").repartition(5)
    steps = {}
    for r in calibration.isotonic(frame, "month", "score", "y").collect():
        steps.setdefault(r.month, []).append((r.low, r.high, r.value))
    assert steps["c"] == [(1.0, 1.0, 1.0)]
    for m in ("a", "b"):
        points = sorted({s for k, s, y in rows if k == m and s is not None and y is not None})
        mean = lambda i, j: np.mean([y for k, s, y in rows if k == m and s is not None and y is not None and points[i] <= s <= points[j]])  # noqa: B023, E731
        own = sorted(steps[m])
        assert all(a[2] < b[2] and a[1] < b[0] for a, b in zip(own, own[1:], strict=False))
        for k, s in enumerate(points):
            want = max(min(mean(i, j) for j in range(k, len(points))) for i in range(k + 1))
            assert next(v for low, high, v in own if low <= s <= high) == pytest.approx(want)


def test_calibrated_scores_lie_on_lines_and_are_clipped(spark):
    steps = spark.createDataFrame([("a", 1.0, 2.0, 0.2, 1.0), ("a", 4.0, 5.0, 0.6, 1.0)], "month string, low double, high double, value double, weight double")
    rows = spark.createDataFrame([("a", s) for s in (0.0, 1.0, 1.5, 2.0, 3.0, 4.5, 9.0)] + [("b", 1.0), ("a", None)], "month string, score double")
    got = {(r.month, r.score): r.p for r in calibration.calibrated(rows, steps, "month", "score").collect()}
    assert [got["a", s] for s in (0.0, 1.0, 1.5, 2.0, 3.0, 4.5, 9.0)] == pytest.approx([0.2, 0.2, 0.2, 0.2, 0.4, 0.6, 0.6])
    assert got["b", 1.0] is None and got["a", None] is None


def test_funnel_matches_brute_force(spark):
    """34 features: copies, noise and a weak one; ranks, months and the greedy order are worked out anew."""
    rng = np.random.default_rng(11)
    n = 1500
    base = rng.normal(size=(n, 12))
    y = (rng.random(n) < 1 / (1 + np.exp(2 - base[:, :6].sum(1) / 2))).astype(int)
    x = np.c_[base, base[:, :10] + rng.normal(size=(n, 10)) * 0.2, -base[:, :6] + rng.normal(size=(n, 6)) * 0.1, rng.normal(size=(n, 6)).round(1)]
    names = [f"x{k:02d}" for k in range(x.shape[1])]
    dates = [dt.date(2020, 1 + k % 6, 1 + k % 27) for k in range(n)]
    frame = spark.createDataFrame([(dates[i], int(y[i]), *map(float, x[i])) for i in range(n)], "date date, y int, " + ", ".join(f"{c} double" for c in names))
    got = {r.feature: (round(r.ic, 9), round(r.flips, 9), r.status) for r in funnel.funnel(frame, names).collect()}

    def rank(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])

    months = sorted({d.month for d in dates})
    where = {m: [i for i in range(n) if dates[i].month == m] for m in months}
    stats = {}
    for k, c in enumerate(names):
        ics = [np.corrcoef(rank(x[where[m], k]), rank(y[where[m]]))[0, 1] for m in months]
        stats[c] = (np.mean(ics), np.mean(np.sign(ics) != np.sign(np.mean(ics))))
    matrix, kept, want = np.abs(np.corrcoef(x.T)), [], {}
    for c in sorted(names, key=lambda c: (-round(abs(stats[c][0]), 9), c)):
        ic, flips = stats[c]
        status = "weak" if abs(ic) < 0.005 else "unstable" if flips > 0.4 else "clash" if any(matrix[names.index(c), names.index(k)] > 0.85 for k in kept) else "kept"
        kept += [c] if status == "kept" else []
        want[c] = (round(ic, 9), round(flips, 9), status)
    assert {c: v[2] for c, v in got.items()} == {c: v[2] for c, v in want.items()}
    assert all(got[c][:2] == pytest.approx(want[c][:2], abs=1e-8) for c in names)
    assert {v[2] for v in want.values()} >= {"kept", "clash", "unstable"}


def test_price_delay_matches_least_squares(spark):
    rng = np.random.default_rng(6)
    m = rng.normal(size=90)
    r = 0.5 * m + 0.3 * np.r_[0, m[:-1]] + rng.normal(size=90)
    rows = [(1, dt.date(2020, 1, 1) + dt.timedelta(days=k), float(r[k]), float(m[k]), *(float(m[k - j]) if k >= j else None for j in (1, 2))) for k in range(90)]
    rows += [(2, x[1], x[2], 0.01, 0.01, 0.01) for x in rows] + [(3, x[1], 0.0, *x[3:]) for x in rows]
    out = families.price_delay(spark.createDataFrame(rows, "code long, date date, r double, m0 double, m1 double, m2 double")).orderBy("code", "date").collect()
    own = [x for x in out if x.code == 1]
    assert all(x.d1 is None for x in own[:61]) and all(x.d1 is None and x.lag_beta is None for x in out if x.code > 1)
    for t in (61, 75, 89):
        X = np.array([[1, *x[3:]] for x in rows[t - 59 : t + 1]], float)
        y = r[t - 59 : t + 1]
        fit = lambda a: np.linalg.lstsq(a, y, rcond=None)[0]  # noqa: B023, E731
        share = lambda a: 1 - ((y - a @ fit(a)) ** 2).sum() / ((y - y.mean()) ** 2).sum()  # noqa: B023, E731
        assert own[t].d1 == pytest.approx(1 - share(X[:, :2]) / share(X)) and own[t].lag_beta == pytest.approx(fit(X)[2:].sum())


def test_normal_tail_and_threshold(spark):
    from statistics import NormalDist

    xs = [0.0, 0.3, 1.0, 1.96, 2.5, 3.3, 4.4]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(resampling.normal_cdf(F.col("x"))).collect()]
    assert got == pytest.approx([NormalDist().cdf(x) for x in xs], abs=1e-12)
    draws = spark.createDataFrame([(k, 1 + k / 500) for k in range(1000)], "rep int, t double")
    r = resampling.family_threshold(draws, 20, 5).first()
    assert r.bonferroni == pytest.approx(NormalDist().inv_cdf(1 - 0.05 / 25), abs=1e-6) and r.threshold == max(2.5, min(r.maxt, r.bonferroni))
    alone = resampling.family_threshold(draws, 0, 5).first()
    assert sum(1 + k / 500 >= alone.maxt for k in range(1000)) / 1000 <= 0.05 < sum(1 + k / 500 >= alone.maxt - 0.003 for k in range(1000)) / 1000


def test_blocks_fill_each_replicate(spark):
    """Every replicate has as many days as the series; the last block is as long as is missing."""
    n = 47
    days = spark.createDataFrame([("s", dt.date(2020, 1, 1) + dt.timedelta(days=k), float(2**k % 1009), 1.0) for k in range(n)], "series string, date date, v double, one double")
    out = resampling.resampled(resampling.numbered(days, ["series"]), ["v", "one"], 30, 10, 5, ["series"]).collect()
    values = [float(2**k % 1009) for k in range(n)]

    def drawn(rep, b):
        x = (5 * 40_692 + 12_345 + rep * resampling.A + b * 69_621) % resampling.M
        for _ in range(3):
            x = (x * x + x * resampling.A + 12_345) % resampling.M
        return x % (n - 10 + 1)

    want = {rep: sum(sum(values[drawn(rep, b) : drawn(rep, b) + min(10, n - 10 * (b - 1))]) for b in range(1, 6)) for rep in range(1, 31)}
    assert all(r.one == n for r in out) and {r.rep: r.v for r in out} == want


def test_draws_are_not_broadcast(spark):
    """Draws come from a row a series, so that Spark takes them for small; a table beyond the limit set here can't be built."""
    days = spark.createDataFrame([(s, dt.date(2020, 1, 1) + dt.timedelta(days=k), (k * 7919 % 1009 - 504) / 1e4) for s in "ab" for k in range(200)], "series string, date date, d double")
    name = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(name)
    spark.conf.set(name, "24m")  # a page of 16 MB is the least
    try:
        better = {r.series: r.better for r in resampling.day_bootstrap(days, 2000).collect()}
        sums = resampling.resampled(resampling.numbered(days, ["series"]), ["d"], 1500, 2, 5, ["series"]).collect()
    finally:
        spark.conf.set(name, before)
    values = np.array([(k * 7919 % 1009 - 504) / 1e4 for k in range(200)]).clip(-0.05, 0.05)

    def drawn(rep, b):
        x = (13 * 40_692 + 12_345 + rep * resampling.A + b * 69_621) % resampling.M
        for _ in range(3):
            x = (x * x + x * resampling.A + 12_345) % resampling.M
        return x % 200

    share = np.mean([round(sum(values[drawn(rep, b)] for b in range(1, 201)), 9) > 0 for rep in range(1, 2001)])
    assert better == pytest.approx({"a": share, "b": share}) and 0 < share < 1 and len(sums) == 3000


def test_draws_are_spread_and_unrelated(spark):
    """Sums of draws vary as sums of independent ones do."""
    d = spark.range(1, 401).select(F.col("id").alias("rep"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(25).cast("long"))).alias("k")).select("rep", "k", resampling.draw(7, F.col("rep"), F.col("k"), 1000).alias("x")).toPandas()
    assert abs(d.x.mean() - 499.5) < 10 and abs(d.x.std() - 288.7) < 8
    spread = d.groupby("rep").x.mean().std()
    assert 0.85 < spread / (288.7 / 5) < 1.15
    assert abs(np.corrcoef(d[d.k < 25].x, d[d.k > 1].x)[0, 1]) < 0.05


def test_funnel_reads_its_rows_once(spark):
    """Features are dear, so that one pass gives both rank correlations and the matrix; unknown labels and values are left out of each."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(dt.date(2021, 1 + i % 3, 1), None if i % 11 == 0 else int(i * 7 % 5 < 2), float(i * 13 % 17), None if i % 9 == 0 else float(i * 5 % 23)) for i in range(400)]
    frame = spark.createDataFrame(rows, "date date, y int, a double, b double").repartition(3)
    ics, matrix = funnel.summaries(frame.mapInArrow(count, frame.schema), ["a", "b"])
    got = {(r.feature, r.month.month): (r.n, r.ic) for r in ics.collect()}
    assert seen.value == 400
    for j, name in enumerate("ab"):
        for m in (1, 2, 3):
            own = [(r[2 + j], r[1]) for r in rows if r[0].month == m and r[1] is not None and r[2 + j] is not None]
            rank = [sum(v < x for v, _ in own) + (sum(v == x for v, _ in own) + 1) / 2 for x, _ in own]
            n, ic = got[name, m]
            assert n == len(own) and ic == pytest.approx(np.corrcoef(rank, [y for _, y in own])[0, 1], abs=1e-9)
    whole = np.array([r[2:] for r in rows if r[3] is not None])
    assert np.allclose(matrix, np.corrcoef(whole.T))


def test_bins_of_a_day_come_from_one_sort(spark):
    """Ranks with ties, nulls, zeros of both signs and NaN, as a window gives them, by one shuffle and no window."""
    rows = [(i, dt.date(1997, 1, 1 + i % 3), [None, 0.0, -0.0, float("nan"), 1.5, i / 7, -float(i)][i * 5 % 7], None if i % 3 == 1 else float(i * i % 11)) for i in range(90)]
    d = spark.createDataFrame(rows, "code long, date date, f double, g double")
    got = boosting.binned(d, ["f", "g"], 4)
    day = Window.partitionBy("date")
    place = lambda f: F.when(F.col(f).isNull(), 4).otherwise(F.floor((F.rank().over(day.orderBy(F.col(f).asc_nulls_last())) - 1) * 4 / F.count(f).over(day)))
    want = d.select("code", place("f").alias("b0"), place("g").alias("b1"))
    assert sorted(tuple(r) for r in got.select("code", "b0", "b1").collect()) == sorted(tuple(r) for r in want.collect())
    assert dict(got.dtypes)["b0"] == "tinyint" and got.columns == [*d.columns, "b0", "b1"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1


def test_learners_of_the_same_bins_and_gap_share_a_table(spark, monkeypatch):
    from barline.plans import learned

    scored = spark.createDataFrame([(c, dt.date(1997, 1, 2), dt.date(1997, 1, 1), c % 2, 0.1 * c) for c in range(5)], "code long, date date, month date, y int, margin double")
    made = []
    monkeypatch.setattr(learned, "featured", lambda s, d: None)
    monkeypatch.setattr(boosting, "prepared", lambda rows, features, p: made.append((p.bins, p.gap)) or len(made))
    monkeypatch.setattr(boosting, "walk", lambda ready, months, p: (scored.withColumn("margin", F.col("margin") + ready), None, None))
    arms = [boosting.Boosting(seed=0), boosting.Boosting(seed=1), boosting.Boosting(bins=8)]
    (row,) = learned.averaged(spark, None, arms).collect()
    assert made == [(16, 20), (8, 20)] and row["rows"] == 5 and row["picks"] == 3
    assert row["margin"] == pytest.approx(0.2 + 4 / 3, abs=1e-6)
