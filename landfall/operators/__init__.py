"""General table operators: DataFrame in, lazy DataFrame out."""

from landfall.operators.aggregates import average_by, count_by, stay_stats, top_k
from landfall.operators.changes import (
    as_of,
    bag_difference,
    bag_intersection,
    changed_keys,
    merge_history,
    row_changes,
    start_history,
    upserted,
)
from landfall.operators.distinct import distinct_rows, one_per_key
from landfall.operators.lookups import decode, key_coverage, left_lookup, unmatched_keys
from landfall.operators.profiling import StepCounter, null_profile, profile, step_counts
from landfall.operators.quality import (
    Check,
    QualityError,
    at_least_two,
    check_columns,
    check_min_distinct,
    check_not_empty,
    check_not_null,
    check_row_count,
    check_rules,
    check_schema,
    check_unique,
    duplicate_keys,
    enforce,
    no_nulls,
    not_empty,
    rules,
    run_checks,
)
from landfall.operators.shaping import (
    align_to,
    cast_columns,
    drop_missing,
    rename,
    since,
    union_extracts,
    with_duration,
)
from landfall.operators.sketches import (
    SketchSpec,
    merge_sketches,
    overlap_estimate,
    sketch_by,
    sketch_estimates,
)
from landfall.operators.subtotals import cube_sets, rollup_sets, subtotals
from landfall.operators.temporal import asof_join, interval_join, present_per_day

__all__ = [
    "Check",
    "QualityError",
    "SketchSpec",
    "StepCounter",
    "align_to",
    "as_of",
    "asof_join",
    "at_least_two",
    "average_by",
    "bag_difference",
    "bag_intersection",
    "cast_columns",
    "changed_keys",
    "check_columns",
    "check_min_distinct",
    "check_not_empty",
    "check_not_null",
    "check_row_count",
    "check_rules",
    "check_schema",
    "check_unique",
    "count_by",
    "cube_sets",
    "decode",
    "distinct_rows",
    "drop_missing",
    "duplicate_keys",
    "enforce",
    "interval_join",
    "key_coverage",
    "left_lookup",
    "merge_history",
    "merge_sketches",
    "no_nulls",
    "not_empty",
    "null_profile",
    "one_per_key",
    "overlap_estimate",
    "present_per_day",
    "profile",
    "rename",
    "rollup_sets",
    "row_changes",
    "rules",
    "run_checks",
    "since",
    "sketch_by",
    "sketch_estimates",
    "start_history",
    "stay_stats",
    "step_counts",
    "subtotals",
    "top_k",
    "union_extracts",
    "unmatched_keys",
    "upserted",
    "with_duration",
]
