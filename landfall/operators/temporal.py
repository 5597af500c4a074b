"""Joins and counts along time: the last reading before, overlapping periods, who is present.

None of them compares all pairs or needs an inequality join, and none gives one task a whole
key or a whole calendar. Time is cut into slices; a slice is worked on by itself, and what it
needs from those before it comes from one small row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.columns import named, type_of

#: Days or other whole units, and seconds of a timestamp, that make one slice.
SLICE_UNITS, SLICE_SECONDS = 1024, 3600

_TIME, _SLICE, _FOUND, _IS_LEFT, _CARRIED = "__time", "__slice", "__found", "__is_left", "__carried"


def _position(column: Column, dtype: T.DataType) -> Column:
    """A time as a whole number: days, microseconds, or the number itself."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(column)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(dtype, T.IntegralType):
        return column
    raise TypeError(f"times must be dates, timestamps or whole numbers, not {dtype.simpleString()}")


def _unit(dtype: T.DataType) -> int:
    """What one day, second or unit is as a position."""
    return 1_000_000 if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else 1


def _slice(column: Column, dtype: T.DataType, width: int | None) -> Column:
    """The number of the slice that a time lies in."""
    unit = _unit(dtype)
    width = width or (SLICE_SECONDS if unit > 1 else SLICE_UNITS)
    return F.floor(_position(column, dtype) / (width * unit))


def _same_type(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> None:
    for a, b in pairs:
        if (one := type_of(left, a)) != (other := type_of(right, b)):
            raise TypeError(f"{a} is {one.simpleString()}, {b} is {other.simpleString()}")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    time: tuple[str, str],
    on: Sequence[tuple[str, str]] = (),
    values: Sequence[str] | None = None,
    direction: str = "backward",
    exact: bool = True,
    within: int | None = None,
    slice_width: int | None = None,
) -> DataFrame:
    """Every left row with the last right row of its key at or before its time.

    `time` and `on` name pairs of columns (left, right). `values` are the right columns to add,
    by default all but the keys; `direction="forward"` takes the first right row at or after
    the time, and `exact=False` leaves out rows of the same time. `within` is the number of
    days, seconds of a timestamp or units beyond which a right row is too far away.

    Left rows without a partner, or with a NULL key or time, stay, with NULL. Of several right
    rows of one key and time the one with the largest values counts, compared column by
    column with NULL lowest.

    What is found depends on key and time alone, so it is looked up once for each pair that
    occurs, on both sides combined map-side first, and joined back by equality. The lookup
    sorts each slice of a key's time; what no row of its own slice answers comes from the
    last right row of the slices before.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}; use 'backward' or 'forward'")
    left_time, right_time = time
    _same_type(left, right, [time, *on])
    dtype = type_of(left, left_time)
    keys = [f"__key_{i}" for i in range(len(on))]
    values = [c for c in right.columns if c not in {r for _, r in on}] if values is None else list(values)
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns of both sides: {', '.join(sorted(clash))}")

    def keyed(df: DataFrame, side: int, moment: str) -> list[Column]:
        return [*(named(pair[side]).alias(k) for pair, k in zip(on, keys)), named(moment).alias(_TIME)]

    known = [named(c).isNotNull() for c in (*keys, _TIME)]
    sought = left.select(*keyed(left, 0, left_time)).distinct()
    payload = F.struct(named(right_time).alias(_TIME), F.struct(*[named(v) for v in values]).alias("values"))
    offered = right.select(*keyed(right, 1, right_time), payload.alias(_FOUND))
    offered = offered.groupBy(*keys, _TIME).agg(F.max(_FOUND).alias(_FOUND))
    for test in known:
        sought, offered = sought.where(test), offered.where(test)

    both = sought.withColumn(_IS_LEFT, F.lit(True)).unionByName(
        offered.withColumn(_IS_LEFT, F.lit(False)), allowMissingColumns=True
    )
    both = both.withColumn(_SLICE, _slice(F.col(_TIME), dtype, slice_width))
    backward = direction == "backward"
    ahead = F.col(_IS_LEFT) if exact else ~F.col(_IS_LEFT)
    order = [F.col(_TIME), ahead] if backward else [F.col(_TIME).desc(), ahead]
    up_to_here = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # The last row of each slice has its last right row, so the same scan tells what to carry.
    scanned = both.withColumn(_FOUND, F.last(_FOUND, ignorenulls=True).over(up_to_here))
    last = F.max_by if backward else F.min_by
    ends = both.groupBy(*keys, _SLICE).agg(
        last(F.when(~F.col(_IS_LEFT), F.col(_FOUND)), F.when(~F.col(_IS_LEFT), F.col(_TIME))).alias(_CARRIED)
    )
    slices = F.col(_SLICE) if backward else F.col(_SLICE).desc()
    before = Window.partitionBy(*keys).orderBy(slices).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn(_CARRIED, F.last(_CARRIED, ignorenulls=True).over(before))
    answers = scanned.where(_IS_LEFT).join(carried, [*keys, _SLICE], "left")
    found = F.coalesce(_FOUND, _CARRIED)
    if within is not None:
        apart = F.abs(_position(F.col(_TIME), dtype) - _position(found[_TIME], dtype))
        found = F.when(apart <= within * _unit(dtype), found)
    answers = answers.select(*keys, _TIME, found["values"].alias(_FOUND))
    same = [named(l) == F.col(k) for (l, _), k in zip(on, keys)] + [named(left_time) == F.col(_TIME)]
    joined = left.join(answers, same, "left")
    added = [F.col(_FOUND)[v].alias(v) for v in values]
    return joined.select(*[named(c) for c in left.columns], *added)


# --- overlapping periods --------------------------------------------------------------------

_LEVEL, _BIN, _FROM, _TO, _OWN = "__level", "__bin", "__from", "__to", "__own"


def _with_level(df: DataFrame, start: str, end: str, mark: str) -> DataFrame:
    """Intervals as positions, with their level: the least power of two that is no shorter.

    Intervals without a start or end, and those that end before they start, match nothing.
    """
    begin, finish = (_position(named(c), type_of(df, c)).cast("bigint") for c in (start, end))
    span = F.col(mark + _TO) - F.col(mark + _FROM) + 1
    return (
        df.withColumns({mark + _FROM: begin, mark + _TO: finish})
        .where(F.col(mark + _FROM) <= F.col(mark + _TO))
        .withColumn(mark + _OWN, F.ceil(F.log2(span)).cast("int"))
    )


def _bins(df: DataFrame, mark: str, levels: Sequence[int] | None = None) -> DataFrame:
    """A row for each bin that an interval touches on its own level, or on all given levels
    that are not below it. It touches at most two bins of a level."""
    own = F.col(mark + _OWN)
    if levels is None:
        wide = df.withColumn(_LEVEL, own)
    else:
        given = F.array(*[F.lit(level) for level in levels]).cast("array<int>")
        wide = df.withColumn(_LEVEL, F.explode(F.filter(given, lambda level: level >= own)))
    first, last = (F.expr(f"shiftright(`{mark}{end}`, {_LEVEL})") for end in (_FROM, _TO))
    return wide.withColumn(_BIN, F.explode(F.sequence(first, last)))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    on: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """All pairs of rows of one key whose closed periods overlap, once each.

    A span names start and end; name one column twice for points in time, which gives the
    pairs of `point BETWEEN start AND end`. Rows with a NULL bound or key, or an end before
    the start, have no partner. Key columns of the right side are dropped.

    Each period lies in at most two bins of its own level, the power of two that covers its
    length, so a stay of years takes no more rows than one of a day. Two periods meet on the
    level of the longer one. The shorter looks up only levels that occur on the other side;
    the driver learns these from one aggregation, at most 64 numbers a side. A pair that
    shares both bins is taken in the first.
    """
    clash = {c for c in right.columns if c not in {r for _, r in on}} & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(sorted(clash))}")
    _same_type(left, right, [(a, b) for a, b in on] + [(left_span[0], right_span[0])])
    a, b = _with_level(left, *left_span, "a"), _with_level(right, *right_span, "b")
    levels_a, levels_b = _levels(a, "a"), _levels(b, "b")
    marks = {r: f"__key_{i}" for i, (_, r) in enumerate(on)}
    b = b.withColumnsRenamed(marks)
    same = [named(l) == F.col(marks[r]) for l, r in on]

    def pairs(one: DataFrame, other: DataFrame, test: Column) -> DataFrame:
        other = other.withColumnsRenamed({_LEVEL: "b" + _LEVEL, _BIN: "b" + _BIN})
        meet = [F.col(_LEVEL) == F.col("b" + _LEVEL), F.col(_BIN) == F.col("b" + _BIN)]
        overlap = (F.col("a" + _FROM) <= F.col("b" + _TO)) & (F.col("b" + _FROM) <= F.col("a" + _TO))
        first_common = F.col(_BIN) == F.expr(f"shiftright(greatest(`a{_FROM}`, `b{_FROM}`), {_LEVEL})")
        return one.join(other, [*same, *meet]).where(overlap & first_common & test)

    own_a, own_b = F.col("a" + _OWN), F.col("b" + _OWN)
    shorter_left = pairs(_bins(a, "a", levels_b), _bins(b, "b"), own_a <= own_b)
    shorter_right = pairs(_bins(a, "a"), _bins(b, "b", levels_a), own_a > own_b)
    kept = [*left.columns, *(c for c in right.columns if c not in marks)]
    return shorter_left.unionByName(shorter_right).select(*[named(c) for c in kept])


def _levels(df: DataFrame, mark: str) -> list[int]:
    return [row[0] for row in df.select(mark + _OWN).distinct().collect()]


# --- who is present -------------------------------------------------------------------------


def present_per_day(
    stays: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    day: str = "day",
    out: str = "present",
) -> DataFrame:
    """For each key and day from its first start to its last end, the stays that cover the day.

    A stay covers its first and its last day. Stays without a start or end, and those that end
    before they start, count nowhere. NULL is a key like any other.

    A sweep line: each stay adds one on its first day and takes one off after its last, summed
    map-side per key and day. The running sum is taken in two steps, within ranges of
    `SLICE_UNITS` days and over the totals of these ranges, so a hot key's calendar is no one
    task's work.
    """
    key_columns = [named(k) for k in keys]
    known = stays.where(named(start) <= named(end))
    first, after = named(start).cast("date"), F.date_add(named(end).cast("date"), 1)
    change = F.explode(
        F.array(F.struct(first.alias(_TIME), F.lit(1).alias("by")), F.struct(after.alias(_TIME), F.lit(-1).alias("by")))
    )
    changes = (
        known.select(*key_columns, change.alias("__change"))
        .groupBy(*key_columns, F.col("__change")[_TIME].alias(_TIME))
        .agg(F.sum(F.col("__change")["by"]).alias("__by"))
    )
    number = F.floor(F.unix_date(_TIME) / SLICE_UNITS)
    ranges = changes.groupBy(*key_columns, number.alias(_SLICE)).agg(
        F.sum("__by").alias("__total"), F.min(_TIME).alias("__first"), F.max(_TIME).alias("__last")
    )
    # One row per range that a key reaches, those without a change included.
    in_order = Window.partitionBy(*key_columns).orderBy(_SLICE)
    following = F.lead(_SLICE).over(in_order)
    so_far = F.sum("__total").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    ranges = ranges.withColumns({"__upto": so_far, "__next": following, "__end": F.lead("__first").over(in_order)})
    # Days from the first change in a range up to the first change of the next range, which may
    # lie several ranges on; the last day of all is the one on which the last stay is taken off.
    before = F.coalesce(F.col("__end"), F.col("__last"))
    days = ranges.where(F.col("__first") < before).select(
        *key_columns, _SLICE, (F.col("__upto") - F.col("__total")).alias("__before"),
        F.explode(F.sequence("__first", F.date_sub(before, 1))).alias(day),
    )
    moved = changes.withColumn(_SLICE, number).withColumnsRenamed({_TIME: "__on", **{k: f"__k{i}" for i, k in enumerate(keys)}})
    same = [named(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    joined = days.join(moved.drop(_SLICE), [*same, named(day) == F.col("__on")], "left")
    within = Window.partitionBy(*key_columns, _SLICE).orderBy(named(day)).rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("__before") + F.coalesce(F.sum("__by").over(within), F.lit(0))
    return joined.select(*key_columns, named(day), present.alias(out))

