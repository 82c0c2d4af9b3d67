"""Queries of price delay, feature selection, nested choice, price versions and leaks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators import families, funnel, lists, versions
from barline.operators import windows as w
from barline.plans.helpers import BY, lag, rounded, rounded_sql, win
from barline.plans.panels import LABELS, RET, labelled, r6, returns
from barline.plans.resampled import ARM_ROWS, arm_days
from barline.sources import panels
from barline.sources.panels import BARS, NOTICES, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str, *parts: str):
    def register(function):
        QUERIES[name], ORACLE_SQL[name] = function, duck(*(parts or (BARS,))) + sql
        return function

    return register


_N = ["r", "m0", "m1", "m2"]
_PAIRS = [(a, b) for k, a in enumerate(_N) for b in _N[k:]]


def _det_sql(column: int | None = None) -> str:
    m = [[f"c_{min(a, b)}{max(a, b)}" for b in _N[1:]] for a in _N[1:]]
    if column is not None:
        m = [[f"c_r{_N[i + 1]}" if j == column else m[i][j] for j in range(3)] for i in range(3)]
    return f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]}) + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))"


@query(
    "e28_price_delay",
    RET + ", mk0 AS (SELECT date, AVG(r) AS m0 FROM p WHERE r IS NOT NULL GROUP BY date), mk AS (SELECT *, LAG(m0) OVER (ORDER BY date) AS m1, LAG(m0, 2) OVER (ORDER BY date) AS m2 FROM mk0), xm AS (SELECT p.code, p.date, r, m0, m1, m2 FROM p LEFT JOIN mk ON mk.date = p.date)"
    + f", cv AS (SELECT code, date, COUNT(r + m0 + m1 + m2) {win(60)} = 60 AS ok, " + ", ".join(f"SUM({a} * {b}) {win(60)} - SUM({a}) {win(60)} * SUM({b}) {win(60)} / 60 AS c_{a}{b}" for a, b in _PAIRS)+ " FROM xm)"
    + f", dt AS (SELECT *, {_det_sql()} AS det FROM cv), be AS (SELECT *, " + ", ".join(f"{_det_sql(k)} / det AS b{k}" for k in range(3)) + ", ok AND c_rr > 1e-12 AND ABS(det) > 1e-9 * c_m0m0 * c_m1m1 * c_m2m2 AS sound FROM dt), r2 AS (SELECT *, (b0 * c_rm0 + b1 * c_rm1 + b2 * c_rm2) / c_rr AS whole FROM be)"
    + rounded_sql({"d1": "CASE WHEN sound AND whole > 0 THEN 1 - c_rm0 * c_rm0 / (c_m0m0 * c_rr) / whole END", "lag_beta": "CASE WHEN sound THEN b1 + b2 END"}, "r2"),
)
def e28(s, d):
    rows = returns(s, d)
    market = rows.where("r IS NOT NULL").groupBy("date").agg(F.avg("r").alias("m0"))
    days = Window.orderBy("date")  # a row a day
    market = market.select("date", "m0", F.lag("m0").over(days).alias("m1"), F.lag("m0", 2).over(days).alias("m2"))
    x = rows.select("code", "date", "r").join(F.broadcast(market), "date", "left")
    return rounded(families.price_delay(x), ["d1", "lag_beta"])


# --- selection of features ------------------------------------------------------------------------

GAINS, MEANS, FLOWS, SPREADS = (1, 2, 3, 5, 8, 10, 15, 20, 30, 40, 60, 90, 120), (3, 5, 10, 20, 40, 60, 120), (3, 5, 10, 20), (1, 5, 20, 60)
FUNNEL_SQL = {f"gain{k}": f"close / {lag('close', k)} - 1" for k in GAINS} | {f"above{k}": f"close / AVG(close) {win(k)} - 1" for k in MEANS} | {f"flow{k}": f"AVG(volume) {win(k)} / AVG(volume) {win(4 * k)}" for k in FLOWS} | {f"spread{k}": f"AVG((high - low) / close) {win(k)}" for k in SPREADS} | {f"turn{k}": f"AVG(turnover) {win(k)}" for k in SPREADS}
FUNNEL = list(FUNNEL_SQL)


def many_features(s, d):
    """32 features of gains, distances to means, flows, spreads and turnover.

    Means of closes and volumes, whole cents and whole pieces, are differences of exact running totals, so a row costs the same for every span.
    """
    c = F.col("close")
    running = lambda x: F.sum(x).over(w.by_code().rowsBetween(Window.unboundedPreceding, 0))
    rows = labelled(s, d).select("*", running(F.round(c * 100).cast("long")).alias("_s"), running("volume").alias("_v"), F.row_number().over(w.by_code()).alias("_n"))
    mean = lambda total, k: (F.col(total) - F.coalesce(w.lag(total, k), F.lit(0))) / F.least("_n", F.lit(k))
    spans = sorted({j for k in FLOWS for j in (k, 4 * k)})
    rows = rows.select("*", *(mean("_v", k).alias(f"_v{k}") for k in spans))
    own = {f"gain{k}": w.gain(k) for k in GAINS} | {f"above{k}": c / (mean("_s", k) / 100) - 1 for k in MEANS} | {f"flow{k}": F.col(f"_v{k}") / F.col(f"_v{4 * k}") for k in FLOWS}
    own |= {f"spread{k}": F.avg((F.col("high") - F.col("low")) / c).over(w.last_n(k)) for k in SPREADS} | {f"turn{k}": F.avg("turnover").over(w.last_n(k)) for k in SPREADS}
    return rows.select("code", "date", "y", *(F.round(x.cast("double"), 9).alias(f) for f, x in own.items()))


@query(
    "k08_feature_funnel",
    RET + LABELS + f", fe AS (SELECT code, date, y, CAST(date_trunc('month', date) AS DATE) AS month, {', '.join(f'ROUND(CAST({x} AS DOUBLE), 9) AS {f}' for f, x in FUNNEL_SQL.items())} FROM u)"
    + f", st AS (SELECT month, CAST(y AS DOUBLE) AS y, feature, x FROM (SELECT month, y, {', '.join(FUNNEL)} FROM fe WHERE y IS NOT NULL) UNPIVOT (x FOR feature IN ({', '.join(FUNNEL)}))), rk AS (SELECT *, RANK() OVER (PARTITION BY feature, month ORDER BY x) + (COUNT(*) OVER (PARTITION BY feature, month, x) - 1) / 2.0 AS r FROM st)"
    + ", ic0 AS (SELECT feature, month, CASE WHEN COUNT(*) >= 30 AND STDDEV_POP(r) > 0 AND STDDEV_POP(y) > 0 THEN ROUND(COVAR_POP(r, y) / (STDDEV_POP(r) * STDDEV_POP(y)), 12) END AS ic FROM rk GROUP BY feature, month), ic1 AS (SELECT * FROM ic0 WHERE ic IS NOT NULL AND ic <> 0)"
    + ", mn AS (SELECT feature, AVG(ic) AS ic, COUNT(*) AS months FROM ic1 GROUP BY feature), fl AS (SELECT ic1.feature, AVG(CAST(SIGN(ic1.ic) <> CASE WHEN ROUND(mn.ic, 12) = 0 THEN 1 ELSE SIGN(mn.ic) END AS DOUBLE)) AS flips FROM ic1 JOIN mn ON mn.feature = ic1.feature GROUP BY ic1.feature)"
    + f", al AS (SELECT UNNEST({FUNNEL}) AS feature), sb AS (SELECT al.feature, CASE WHEN months >= 3 THEN ic ELSE 0 END AS ic, CASE WHEN months >= 3 THEN flips ELSE 1 END AS flips FROM al LEFT JOIN mn ON mn.feature = al.feature LEFT JOIN fl ON fl.feature = al.feature)"
    + ", wh AS (SELECT * FROM fe WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in FUNNEL) + "), co AS MATERIALIZED (SELECT " + ", ".join(f"ABS(CORR({a}, {b})) > 0.85 AS x{i}_{j}" for i, a in enumerate(FUNNEL) for j, b in enumerate(FUNNEL) if i < j) + " FROM wh)"
    + ", pr AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b FROM co WHERE x{min(i, j)}_{max(i, j)}" for i, a in enumerate(FUNNEL) for j, b in enumerate(FUNNEL) if i != j) + ")"
    + ", od AS MATERIALIZED (SELECT *, CASE WHEN ABS(ic) < 0.005 THEN 'weak' WHEN flips > 0.4 THEN 'unstable' END AS out, ROW_NUMBER() OVER (ORDER BY ROUND(ABS(ic), 9) DESC, feature) AS k FROM sb), cl AS MATERIALIZED (SELECT od.*, COALESCE((SELECT LIST(b) FROM pr WHERE a = od.feature), []) AS near FROM od)"
    + f", go(k, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL SELECT go.k + 1, CASE WHEN cl.out IS NULL AND NOT list_has_any(go.kept, cl.near) THEN list_append(go.kept, cl.feature) ELSE go.kept END FROM go JOIN cl ON cl.k = go.k + 1), fin AS (SELECT kept FROM go WHERE k = {len(FUNNEL)})"
    + rounded_sql({"ic": "ic", "flips": "flips"}, "od, fin", "feature, COALESCE(out, CASE WHEN list_contains(kept, feature) THEN 'kept' ELSE 'clash' END) AS status"),
)
def k08(s, d):
    """32 features: mean monthly rank correlation with the label, share of months against its sign, and which are kept."""
    return rounded(funnel.funnel(many_features(s, d), FUNNEL), ["ic", "flips"], ("feature", "status"))


ORACLE_SQL["k08_feature_funnel"] = ORACLE_SQL["k08_feature_funnel"].replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "f14_nested_choice",
    RET + LABELS + ARM_ROWS + ", ms AS (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS month FROM ar), df AS (SELECT a.arm, a.date, a.d - b.d AS d FROM ar a JOIN ar b ON b.date = a.date AND b.arm = 'r20' WHERE a.arm <> 'r20'), pa AS (SELECT month, arm, date, d FROM df JOIN ms ON date < month AND date >= month - INTERVAL 12 MONTH)"
    + ", ce AS (SELECT *, d - AVG(d) OVER (PARTITION BY month, arm) AS e FROM pa), ga AS (SELECT month, arm, d, e * e + " + " + ".join(f"{2 * (1 - k / 21)} * COALESCE(e * LAG(e, {k}) OVER (PARTITION BY month, arm ORDER BY date), 0)" for k in range(1, 21)) + " AS g FROM ce)"
    + ", tt AS (SELECT month, arm, CASE WHEN SUM(g) > 0 THEN ROUND(AVG(d) / (SQRT(SUM(g)) / COUNT(*)), 9) END AS t FROM ga GROUP BY month, arm HAVING COUNT(*) >= 40), be AS (SELECT * FROM tt WHERE t > 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY month ORDER BY t DESC, arm) = 1)"
    + ", ch AS (SELECT ms.month, COALESCE(be.arm, 'r20') AS arm, COALESCE(t, 0) AS t FROM ms LEFT JOIN be ON be.month = ms.month)"
    + f" SELECT ch.month, ch.arm, {r6('t', 't')}, COUNT(a.d) AS days, {r6('AVG(a.d)', 'hit')}, {r6('AVG(b.d)', 'base')} FROM ch JOIN ar b ON b.arm = 'r20' AND CAST(date_trunc('month', b.date) AS DATE) = ch.month LEFT JOIN ar a ON a.arm = ch.arm AND a.date = b.date GROUP BY ch.month, ch.arm, t",
)
def f14(s, d):
    """Every month by the arm whose lead over the 20-row return was surest in the twelve months before; chosen arm, its t, and what it hit beside the base."""
    return rounded(lists.nested_choice(arm_days(s, d), "r20"), ["t", "hit", "base"], ("month", "arm", "days"))


# --- price versions -------------------------------------------------------------------------------

VERSIONS = (
    ", fa0 AS (SELECT code, date, COUNT(*) AS n FROM notices WHERE kind = '1-URGENT' GROUP BY code, date), fa AS (SELECT code, date, POWER(CAST(1.02 AS DOUBLE), SUM(n) OVER (PARTITION BY code ORDER BY date)) AS q FROM fa0), la AS (SELECT code, arg_max(q, date) AS q_last FROM fa GROUP BY code)"
    + ", cd AS (SELECT c.code, COALESCE(q_last, 1) AS q_last FROM (SELECT DISTINCT code FROM panel) c LEFT JOIN la ON la.code = c.code), ri AS (SELECT *, COALESCE(LEAD(q_last) OVER (ORDER BY code), FIRST(q_last) OVER (ORDER BY code)) AS q_other FROM cd)"
    + ", kn AS (SELECT panel.code, panel.date, close, COALESCE(fa.q, 1) AS q FROM panel ASOF LEFT JOIN fa ON fa.code = panel.code AND fa.date <= panel.date)"
    + ", ve AS (SELECT kn.*, q_last, ROUND(close * q / q_last + 1e-9, 2) AS forward, close * q AS pit, ROUND(close * q / q_other + 1e-9, 2) AS control FROM kn JOIN ri ON ri.code = kn.code)"
)


def versioned(s, d):
    return versions.versions(panel(s, d), versions.factors(panels.notices(s, d).where("kind = '1-URGENT'")))


@query("l21_price_versions", VERSIONS + rounded_sql({"q": "q", "forward": "forward", "pit": "pit", "control": "control"}, "ve", digits=4), BARS, NOTICES)
def l21(s, d):
    return rounded(versioned(s, d), ["q", "forward", "pit", "control"], digits=4)


_LEAKS = ", ".join(f"{v} / {lag(v, 20)} - 1 AS f_{v}" for v in ("forward", "pit", "control"))


@query(
    "l22_leak_by_day",
    VERSIONS + f", fv AS (SELECT code, date, LN(q_last / q) AS ahead, {_LEAKS} FROM ve), fd AS (SELECT code, date, ROUND(ahead, 9) AS a, ROUND(f_forward - f_pit, 9) AS b, ROUND(f_control - f_pit, 9) AS c FROM fv), fk AS (SELECT * FROM fd WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL), rk AS (SELECT date, "
    + ", ".join(f"RANK() OVER (PARTITION BY date ORDER BY {x}) + (COUNT(*) OVER (PARTITION BY date, {x}) - 1) / 2.0 AS {x}" for x in "abc") + " FROM fk), sd AS (SELECT date, COUNT(*) AS n, " + ", ".join(f"STDDEV_POP({x}) AS s{x}" for x in "abc") + ", COVAR_POP(a, b) AS ab, COVAR_POP(a, c) AS ac FROM rk GROUP BY date HAVING COUNT(*) >= 5)"
    + rounded_sql({"leak": "CASE WHEN sa > 0 AND sb > 0 THEN ab / (sa * sb) END", "control": "CASE WHEN sa > 0 AND sc > 0 THEN ac / (sa * sc) END"}, "sd", "date, n"),
    BARS, NOTICES,
)
def l22(s, d):
    """Per day: how the difference between a feature of forward prices and of the day's own goes with the factor still to come."""
    return rounded(versions.leak(versioned(s, d), lambda v: F.col(v) / w.lag(v, 20) - 1), ["leak", "control"], ("date", "n"))
