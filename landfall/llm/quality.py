"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

Measures are built-in expressions over a text; a rule is a condition on them that rejects.
On a bounded sample each rule is run alone: the share of rows it rejects is its selectivity,
the time it takes beyond a bare read is its cost. Rules then run in the order of rejections
per second, and a row leaves at the first that rejects it. The order changes what a row
costs and which rule is named, never whether it is kept, so reruns keep the same rows.

Windows repeated in a text are found by sorting their hashes within the row; texts whose
windows all differ, most of them, skip that. The cost of a text is n log n in its words.

Defined results: a NULL text has no words; its measures are 0 and it fails the base rules.
NULL ids stay; repeated rows are judged one by one; an empty table gives no rows; columns
other than those used are kept, unless a measure has the same name, which then replaces it.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import bound, stored, text_of

SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A named condition, in SQL over the measures, that rejects a document."""

    name: str
    rejects: str


BASE_RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
)
#: Beyond the base rules: symbols per word, lines that repeat, few different words in a
#: text of moderate length, odd word lengths.
MORE_RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("few_distinct_words", "n_words < 500 AND 5 * n_distinct_words < n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
)


def _repeat_words(hashes: Column, window: int) -> Column:
    """Words that lie in a window found twice or more, given the hashes of all words."""

    def starts_of(ordered: Column) -> Column:
        def shared(x: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1), F.get(ordered, k + 1)
            return F.when((before["h"] == x["h"]) | (after["h"] == x["h"]), x["i"])

        return F.sort_array(F.array_compact(F.transform(ordered, shared)))

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return F.aggregate(
            bound(ordered, starts_of),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct(
                (a["n"] + i + window - F.greatest(a["end"], i)).alias("n"),
                (i + window).alias("end"),
            ),
            lambda a: a["n"],
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - window),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]),
    )
    differ = F.size(hashes) <= window
    return F.when(differ, F.lit(0)).otherwise(
        bound(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0),
        )
    )


def measured(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add the measures. Only those that a query uses are computed."""
    text = text_of()
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def long(value: Column, name: str) -> Column:
        return value.cast("long").alias(name)

    of_words = bound(
        words,
        lambda w: bound(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.struct(
                long(F.size(w), "n_words"),
                long(F.char_length(F.array_join(w, "")), "word_chars"),
                long(F.size(F.array_distinct(h)), "n_distinct_words"),
                long(_repeat_words(h, window), "n_repeat_words"),
            ),
        ),
    )
    of_lines = bound(
        lines,
        lambda x: F.struct(
            long(F.size(x), "n_lines"), long(F.size(x) - F.size(F.array_distinct(x)), "n_dup_lines")
        ),
    )
    both = docs.withColumns({"qr_words": of_words, "qr_lines": of_lines})
    fields = {f"{c}": F.col(f"qr_words.{c}") for c in ("n_words", "word_chars", "n_distinct_words", "n_repeat_words")}
    fields |= {c: F.col(f"qr_lines.{c}") for c in ("n_lines", "n_dup_lines")}
    fields["n_symbols"] = F.regexp_count(text, F.lit(SYMBOL)).cast("long")
    return both.withColumns(fields).drop("qr_words", "qr_lines")


def rule_order(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = 2000) -> list[Rule]:
    """The rules by rejections per second, estimated on some `sample_rows` random rows."""
    rows = docs.count()
    fraction = min(1.0, sample_rows / max(rows, 1))
    sample = stored(docs.select("text").sample(fraction=fraction, seed=7), "quality_sample")

    def timed(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        rejected = measured(sample).agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - began, rejected

    timed(F.col("text").isNull())
    bare, _ = timed(F.col("text").isNull())
    scored = []
    for rule in rules:
        seconds, rejected = timed(F.expr(rule.rejects))
        scored.append((rejected / max(seconds - bare, 1e-3), rule))
    return [rule for _, rule in sorted(scored, key=lambda s: (-s[0], s[1].name))]


def cascade(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add `failed_rule`, the first in the given order that rejects, or NULL if kept.

    Measures are computed where a rule asks for them: a branch is not evaluated once an
    earlier one has decided.
    """
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.expr(rule.rejects), F.lit(rule.name)).otherwise(verdict)
    return docs.withColumn("failed_rule", verdict)
