"""Column expressions: segments, limits, curves and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def board_of(code: Column) -> Column:
    """Market segment by the prefix of a six-character code."""
    return (
        F.when(code.startswith("688"), "star")
        .when(code.startswith("3"), "chinext")
        .when(code.startswith("83") | code.startswith("87") | code.startswith("88") | code.startswith("43") | code.startswith("92") | code.startswith("920"), "bj")
        .otherwise("main")
    )


def limit_pct(board: Column, name: Column) -> Column:
    """Largest daily move in percent."""
    return F.when(board.isin("star", "chinext"), 20).when(board == "bj", 30).when(F.upper(name).startswith("S"), 5).otherwise(10)


def limit_price(prev_close: Column, pct: Column, board: Column) -> Column:
    """The price at the limit: cut to cents in one segment, rounded half up elsewhere."""
    raw = prev_close * (1 + pct / 100)
    return F.when(board == "bj", F.floor(raw * 100 + 1e-6) / 100).otherwise(F.round(raw + 1e-9, 2))


def is_flagged(name: Column, delisting: str = "OUT") -> Column:
    return F.upper(name).contains("ST") | name.contains(delisting)


def code6(code: Column) -> Column:
    return F.lpad(code.cast("string"), 6, "0")


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        x = F.greatest(x, F.lit(low))
    return F.least(x, F.lit(high)) if high is not None else x


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.nullif(b, F.lit(0.0))


def known(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the share k / n."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = k / n
    mid, spread, whole = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    return (mid - spread) / whole, (mid + spread) / whole


def tent(x: Column, low: float, high: float, peak: float) -> Column:
    """0 outside low..high, 1 at peak, straight between."""
    return F.when((x <= low) | (x >= high), 0.0).when(x <= peak, (x - low) / (peak - low)).otherwise((high - x) / (high - peak))


def score_on(quantiles: Column, p: Column) -> Column:
    """How many of the quantiles lie below p, from 0 to 100."""
    return clip(F.size(F.filter(quantiles, lambda q: q < p)).cast("double"), 0.0, 100.0)
