"""What the query modules share: rounding, and SQL for windows counted in rows of a code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
BY = "PARTITION BY code ORDER BY date"


#: Added before rounding, so that decimal ties, frequent in prices of whole cents, round alike in binary and decimal rounding; 0.0 is
#: added afterwards, so that no zero is negative.
NUDGE = 1.7e-10


def rounded(df: DataFrame, features: list[str], keys: tuple[str, ...] = ("code", "date"), digits: int = 6) -> DataFrame:
    return df.select(*keys, *((F.round(F.col(f).cast("double") + NUDGE, digits) + 0.0).alias(f) for f in features))


def rounded_sql(features: dict[str, str], source: str, keys: str = "code, date", digits: int = 6) -> str:
    return f" SELECT {keys}, " + ", ".join(f"ROUND(CAST({e} AS DOUBLE) + {NUDGE}, {digits}) + CAST(0 AS DOUBLE) AS {f}" for f, e in features.items()) + f" FROM {source}"


def win(n: int, back: int = 0) -> str:
    return f"OVER ({BY} ROWS BETWEEN {n - 1 + back} PRECEDING AND {back} PRECEDING)"


def ahead(n: int) -> str:
    return f"OVER ({BY} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"


def full(agg: str, x: str, n: int, back: int = 0, least: int | None = None) -> str:
    return f"CASE WHEN COUNT({x}) {win(n, back)} >= {least or n} THEN {agg} {win(n, back)} END"


def mean(x: str, n: int, back: int = 0) -> str:
    return f"({full(f'AVG({x})', x, n, back)})"


def lag(x: str, k: int = 1) -> str:
    return f"LAG({x}, {k}) OVER ({BY})"


def plain(query: Query, sql: str, columns: dict[str, str]) -> tuple[Query, str]:
    """A query and its SQL with some columns as doubles or strings."""
    casts = ", ".join(f'CAST("{c}" AS {"VARCHAR" if t == "string" else "DOUBLE"}) AS "{c}"' for c, t in columns.items())
    return lambda spark, sf_dir: query(spark, sf_dir).withColumns({c: F.col(c).cast(t) for c, t in columns.items()}), f"SELECT * REPLACE ({casts}) FROM ({sql})"
