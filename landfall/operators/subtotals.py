"""Totals and subtotals over several sets of keys, from one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.columns import named

#: Measures that can be added up from partial results.
_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_TOTAL = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All keys, all but the last, and so on down to the grand total."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Every selection of the keys."""
    return [chosen for n in range(len(keys), -1, -1) for chosen in combinations(keys, n)]


def subtotals(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: Mapping[str, tuple[str, str | None]],
    level: str = "level",
) -> DataFrame:
    """Measures for every set of keys, with the keys that a row sums over as NULL.

    `measures` maps a name to (count, sum, min, max or avg, column); a count without a column
    counts rows. `level` numbers the sets as SQL's GROUPING_ID over all keys in order of their
    first use: a bit is set for each key summed over, the last key the lowest. So a NULL key
    and a subtotal differ. An empty table gives no rows but for the set without keys.

    The rows are first counted down by all keys together, map-side first. Only these counts
    are then repeated per set, not the rows.
    """
    keys = list(dict.fromkeys(key for keys in sets for key in keys))
    parts: dict[str, tuple[str, Column]] = {}
    results: list[Column] = []
    for name, (kind, column) in measures.items():
        value = F.lit(1) if column is None else named(column)
        wanted = ("sum", "count") if kind == "avg" else (kind,)
        if unknown := [k for k in wanted if k not in _PARTIAL]:
            raise ValueError(f"unknown measure {unknown[0]!r}; use avg or one of {sorted(_PARTIAL)}")
        totals = []
        for part in wanted:
            held = f"__{part}_{name}"
            parts[held] = (part, _PARTIAL[part](value).alias(held))
            total = _TOTAL[part](held)
            totals.append(F.coalesce(total, F.lit(0)) if part == "count" else total)
        result = totals[0] if kind != "avg" else F.try_divide(totals[0], totals[1])
        results.append(result.alias(name))
    counted = df.groupBy(*[named(k) for k in keys]).agg(*[column for _, column in parts.values()])
    columns = [named(k) for k in keys]
    if not keys:
        return counted.agg(F.lit(0).cast("bigint").alias(level), *results)
    grouped = counted.groupingSets([[named(k) for k in chosen] for chosen in sets], *columns)
    return grouped.agg(F.grouping_id(*columns).alias(level), *results)
