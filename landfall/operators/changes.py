"""What differs between two loads of a table, as rows and as history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions.columns import named, type_of

_OLD, _NEW, _SIDE, _FINGER, _KEY = "__old", "__new", "__side", "__finger", "__key"

#: The kinds of change, as `changed_keys` and `row_changes` name them.
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _fingerprint(columns: Sequence[str]) -> Column:
    """128 bits of a row. NULL is set apart from every value and from its neighbours."""
    values = [part for name in columns for part in (named(name).isNull(), named(name))]
    return F.struct(F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values))


def changed_keys(
    old: DataFrame, new: DataFrame, keys: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Keys whose rows differ between two loads, with `change`: insert, update or delete.

    Keys are unique in each load; NULL is a key like any other. All other columns that both
    loads have are compared, NULL equal to NULL. `carried` columns are added as `old_...` and
    `new_...`. Rows meet as fingerprints in one aggregation, so whole rows do not move.
    """
    compared = [c for c in new.columns if c in old.columns and c not in keys]

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        held = F.struct(_fingerprint(compared).alias(_FINGER), *[named(c) for c in carried])
        return df.select(*[named(k) for k in keys], F.lit(is_new).alias(_SIDE), held.alias(_OLD))

    both = side(old, False).unionByName(side(new, True))
    met = both.groupBy(*[named(k) for k in keys]).agg(
        F.max(F.when(~F.col(_SIDE), F.col(_OLD))).alias(_OLD),
        F.max(F.when(F.col(_SIDE), F.col(_OLD))).alias(_NEW),
    )
    change = (
        F.when(F.col(_OLD).isNull(), INSERT)
        .when(F.col(_NEW).isNull(), DELETE)
        .when(F.col(_OLD)[_FINGER] != F.col(_NEW)[_FINGER], UPDATE)
    )
    shown = [F.col(held)[c].alias(f"{name}_{c}") for held, name in ((_OLD, "old"), (_NEW, "new")) for c in carried]
    return met.select(*[named(k) for k in keys], change.alias("change"), *shown).where("change IS NOT NULL")


def _matching(df: DataFrame, keys: Sequence[str], other: DataFrame, how: str) -> DataFrame:
    """A semi or anti join in which NULL keys meet."""
    marked = other.select(*[named(k).alias(f"{_KEY}_{i}") for i, k in enumerate(keys)])
    same = [named(k).eqNullSafe(F.col(f"{_KEY}_{i}")) for i, k in enumerate(keys)]
    return df.join(marked, same, how)


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows behind the changes: new rows of inserts and updates, old rows of deletes."""
    found = changed_keys(old, new, keys)
    marked = found.withColumnsRenamed({k: f"{_KEY}_{i}" for i, k in enumerate(keys)})
    same = [named(k).eqNullSafe(F.col(f"{_KEY}_{i}")) for i, k in enumerate(keys)]
    columns = [named(c) for c in new.columns]

    def rows(df: DataFrame, test: str) -> DataFrame:
        return df.join(marked.where(test), same).select(*columns, "change")

    return rows(new, f"change != '{DELETE}'").unionByName(
        rows(old.select(*columns), f"change = '{DELETE}'")
    )


def upserted(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The old rows, with those of the batch in place of rows of the same key."""
    return _matching(old, keys, batch, "left_anti").unionByName(batch)


# --- bags of rows ---------------------------------------------------------------------------


def _bag_counts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Every distinct row with the number of times it is in each bag."""
    if set(first.columns) != set(second.columns):
        raise ValueError(f"columns differ: {sorted(set(first.columns) ^ set(second.columns))}")
    both = first.withColumns({_OLD: F.lit(1), _NEW: F.lit(0)}).unionByName(
        second.withColumns({_OLD: F.lit(0), _NEW: F.lit(1)})
    )
    return both.groupBy(*[named(c) for c in first.columns]).agg(
        F.sum(_OLD).alias(_OLD), F.sum(_NEW).alias(_NEW)
    )


def bag_difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """The rows that two loads do not share, with `lost` and `surplus`.

    Rows are compared over all columns, NULL equal to NULL; `lost` counts how often a row is
    missing in the target, `surplus` how often it is there too often. One aggregation with
    signed counts, combined map-side, so a row repeated a billion times costs one row per
    task.
    """
    apart = F.col(_OLD) - F.col(_NEW)
    return (
        _bag_counts(source, target)
        .where(F.col(_OLD) != F.col(_NEW))
        .withColumns({"lost": F.greatest(apart, F.lit(0)), "surplus": F.greatest(-apart, F.lit(0))})
        .drop(_OLD, _NEW)
    )


def bag_intersection(first: DataFrame, second: DataFrame, out: str = "copies") -> DataFrame:
    """The distinct rows that both hold, with how many copies they share."""
    shared = F.least(F.col(_OLD), F.col(_NEW))
    return _bag_counts(first, second).withColumn(out, shared).where(named(out) > 0).drop(_OLD, _NEW)


# --- history --------------------------------------------------------------------------------


def start_history(load: DataFrame, day: dt.date) -> DataFrame:
    """The history of a first load: every row valid from its day on."""
    return load.withColumns({"valid_from": F.lit(day), "valid_to": F.lit(None).cast("date")})


def as_of(history: DataFrame, day: dt.date) -> DataFrame:
    """The rows that were valid on a day."""
    open_end = F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(day))
    valid = (F.col("valid_from") <= F.lit(day)) & open_end
    return history.where(valid).drop("valid_from", "valid_to")


def merge_history(
    history: DataFrame,
    load: DataFrame,
    keys: Sequence[str],
    day: dt.date,
    next_load: dt.date | None = None,
) -> DataFrame:
    """A history (rows with `valid_from` and `valid_to`, the latter open) with one more full load.

    The load says what is valid from its day until `next_load`, the day of the load that
    follows it in time, if that was merged before: a late load changes only the days up to
    then. A key that the load lacks is not valid in that time. Neighbouring intervals of equal
    rows become one, NULL equal to NULL, so loads merged in any order give one history.

    Closed intervals that do not reach these days are passed on without a shuffle; for the
    newest load that is all but the open ones.
    """
    if next_load is not None and next_load <= day:
        raise ValueError("the next load must be later")
    start, end, until = F.col("valid_from"), F.col("valid_to"), F.lit(next_load).cast("date")
    columns = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    if set(columns) != set(load.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(load.columns))}")
    first_day = F.lit(day)
    before = (end < first_day)
    after = (start > until) if next_load else F.lit(False)
    settled = F.coalesce(before, F.lit(False)) | after
    near = history.where(~settled)
    pieces = near.where(start < first_day).withColumn(
        "valid_to", F.least(F.coalesce(end, first_day), first_day)
    )
    pieces = pieces.unionByName(load.withColumns({"valid_from": first_day, "valid_to": until}))
    if next_load:
        later = near.where(F.coalesce(end > until, F.lit(True)))
        pieces = pieces.unionByName(later.withColumn("valid_from", F.greatest(start, until)))
    return history.where(settled).unionByName(_joined_up(pieces, columns, keys))


def _joined_up(pieces: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Intervals of a key that touch and hold equal rows, as one."""
    in_order = Window.partitionBy(*[named(k) for k in keys]).orderBy("valid_from")
    row = F.struct(*[named(c) for c in columns])
    goes_on = F.lag(row).over(in_order).eqNullSafe(row) & (F.lag("valid_to").over(in_order) == F.col("valid_from"))
    island = F.sum((~F.coalesce(goes_on, F.lit(False))).cast("int")).over(in_order)
    far = F.lit("9999-12-31").cast("date")
    merged = (
        pieces.withColumn(_SIDE, island)
        .groupBy(*[named(k) for k in keys], _SIDE)
        .agg(
            *[F.first(named(c)).alias(c) for c in columns if c not in keys],
            F.min("valid_from").alias("valid_from"),
            F.max(F.coalesce("valid_to", far)).alias("valid_to"),
        )
    )
    return merged.select(*[named(c) for c in columns], "valid_from", F.nullif("valid_to", far).alias("valid_to"))
