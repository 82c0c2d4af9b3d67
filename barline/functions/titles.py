"""Predicates and classes of short titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def announces(title: Column, word: str, unless: tuple[str, ...] = (), never: str | None = None) -> Column:
    """The title holds ``word``, none of ``unless`` and no match of the pattern ``never``; a null title announces nothing."""
    hit = F.contains(title, F.lit(word))
    for other in unless:
        hit = hit & ~F.contains(title, F.lit(other))
    if never is not None:
        hit = hit & ~title.rlike(never)
    return F.coalesce(hit, F.lit(False))


def shortened(title: Column, most: int, *drop: str) -> Column:
    """The title without the first match of each pattern, in order, cut to ``most`` characters; patterns are anchored."""
    for pattern in drop:
        title = F.regexp_replace(title, pattern, "")
    return F.substring(title, 1, most)


def classes(title: Column, code: Column, rules: dict[str, tuple[str, str, str]]) -> Column:
    """Names of all rules that hold: the code starts with the first entry or the title matches the second, and doesn't match the third.

    An empty entry never matches.  A null title or code matches nothing.
    """

    def holds(prefix: str, wanted: str, excluded: str) -> Column:
        by_code = F.startswith(code, F.lit(prefix)) if prefix else F.lit(False)
        by_title = title.rlike(wanted) if wanted else F.lit(False)
        out = title.rlike(excluded) if excluded else F.lit(False)
        return (F.coalesce(by_code, F.lit(False)) | F.coalesce(by_title, F.lit(False))) & ~F.coalesce(out, F.lit(False))

    return F.array_compact(F.array(*(F.when(holds(*rule), F.lit(name)) for name, rule in rules.items())))
