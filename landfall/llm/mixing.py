"""Mixing sources to target weights: Sainte-Lague quotas of equal-token blocks.

A source's target is its weighted share of all words, at most `max_repeat` times what it
has; what stops there is shared out again by weight. The targets are cut into blocks of
equal size, and each block goes to the source with the highest quotient target / (2k + 1),
k being the blocks it has. A source's blocks go to its shards in the same way. Within a
shard the documents are put in a seeded order and read as one stream; the shard's quota is
whole passes over the stream and then the run of blocks at its start. So at most one
document of a shard is cut, and none is taken more than `max_repeat` times.

Only one small row per document enters the shuffle when the texts are not asked for. A shard
has a bounded number of words, so a source with a third of all rows is many shards; sources
and shards are aggregated before they are ranked.

The highest quotients are found without listing all: with divisor V / (n - S/2) every party
is sure of its rounded share, and beyond V / (n + S/2) no party gets more, where V are all
votes, n all seats and S the parties. Only the few seats between are ranked.

Defined results: a NULL text has size 0; a document of size 0 is taken 0 times; NULL is a
source of its own, the last one; equal rows are apart and interchangeable; a NULL doc_id is
a value as any other; an empty table gives no rows. Columns other than those of `documents`
are ignored, whatever their names. Reruns give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import WORD, stored, text_of

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def apportion(
    parties: DataFrame, group: Sequence[str], party: Sequence[str], votes: str, seats: str, most: str
) -> DataFrame:
    """Add `won`: seats by highest quotients votes / (2k + 1) within each group.

    `seats` is the group's total and `most` a party's limit. Ties go to the smaller party key.
    """
    whole = Window.partitionBy(*group)
    total, number = F.sum(votes).over(whole), F.count(F.lit(1)).over(whole)

    def rounded(seats: Column) -> Column:
        share = F.col(votes) * seats / F.col("ap_total")
        return F.when(F.col("ap_total") > 0, F.greatest(F.lit(0.0), F.floor(share + 0.5))).otherwise(0)

    half = F.col("ap_number") / 2
    bounds = parties.withColumns({"ap_total": total.cast("double"), "ap_number": number}).withColumns(
        {
            "ap_sure": F.least(rounded(F.col(seats) - half).cast("long"), F.col(most)),
            "ap_last": F.least(rounded(F.col(seats) + half).cast("long") + 1, F.col(most)),
        }
    )
    open_seats = F.col(seats) - F.sum("ap_sure").over(whole)
    offered = bounds.withColumn("ap_open", open_seats).withColumn(
        "ap_k", F.explode(F.sequence("ap_sure", F.greatest("ap_sure", "ap_last")))
    )
    by_quotient = whole.orderBy((F.col(votes) / (2 * F.col("ap_k") + 1)).desc(), *[F.col(p).asc_nulls_last() for p in party], "ap_k")
    wins = (F.row_number().over(by_quotient) <= F.col("ap_open")) & (F.col("ap_k") < F.col(most))
    return (
        offered.withColumn("ap_wins", (wins & (F.col(votes) > 0)).cast("long"))
        .groupBy(*parties.columns)
        .agg((F.first("ap_sure") + F.sum("ap_wins")).alias("won"))
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """(source, source_size) with the target of each source. One row per source is ranked."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumns(
        {
            "weight": F.get(cycle, (F.col("rank") - 1) % len(weights)),
            "most": (F.col("source_size") * max_repeat).cast("double"),
        }
    )
    # Sources reach their limit in the order of limit / weight; the first that stays below
    # it at the level the others leave gives the level of all that follow.
    in_order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    rest = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levelled = weighed.withColumn("level", level)
    below = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("rank", "level"))
    in_order_key = F.struct(F.col("most") / F.col("weight"), F.col("rank"))
    first = F.min_by(F.col("level"), F.when(below.isNotNull(), in_order_key)).over(everything)
    return levelled.withColumn("target", F.least(F.col("most"), F.coalesce(first, F.lit(0.0)) * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_repeat: int = 3,
    block_words: int = 32,
    shard_words: int = 1 << 19,
    seed: str = "mix-1",
) -> DataFrame:
    """Documents with size, source_size, target, copies, extra and taken.

    `copies` are whole repeats; `extra` is the number of leading words taken once more.
    """
    sized = docs.select(*[c for c in docs.columns if c in DOCUMENT]).withColumn(
        "size", word_count(text_of())
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    blocks = F.round(F.sum("target").over(Window.partitionBy("g")) / block_words).cast("long")
    seated = apportion(
        targets.withColumn("g", F.lit(0)).withColumns(
            {
                "blocks": blocks,
                "most": F.ceil(F.col("source_size") * max_repeat / block_words).cast("long"),
                "shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"),
            }
        ),
        ["g"], ["source"], "target", "blocks", "most",
    )
    # Written once: the plan below is then planned with its true, small size.
    sources = stored(
        seated.select(F.col("source").alias("of"), "source_size", "target", "shards", F.col("won").alias("source_blocks")),
        "mix_sources",
    )
    order = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    dealt = (
        sized.join(sources, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("order", order)
        .withColumn("shard", F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("shards"))
    )
    shards = (
        dealt.groupBy("of", "shard", "source_blocks")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("most", F.ceil(F.col("shard_size") * max_repeat / block_words).cast("long"))
    )
    quotas = stored(
        apportion(shards, ["of"], ["shard"], "shard_size", "source_blocks", "most").select(
            F.col("of").alias("q_of"), F.col("shard").alias("q_shard"), "shard_size",
            F.least(F.col("won") * block_words, F.col("shard_size") * max_repeat).alias("quota"),
        ),
        "mix_shards",
    )
    stream = Window.partitionBy("of", "shard").orderBy("order", "doc_id", "size", F.col("text").isNull())
    upto = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The run at the stream's start covers the first `run` words; it is empty for quotas
    # that are whole passes.
    run = F.when(F.col("shard_size") > 0, F.col("quota") % F.col("shard_size")).otherwise(0)
    copies = F.when(F.col("size") > 0, F.expr("quota div shard_size")).otherwise(0)
    placed = dealt.withColumn("upto", upto).join(
        quotas, F.col("of").eqNullSafe(F.col("q_of")) & (F.col("shard") == F.col("q_shard"))
    )
    return (
        placed.withColumns(
            {
                "copies": copies,
                "extra": F.greatest(F.lit(0), F.least(F.col("size"), run - F.col("upto") + F.col("size"))),
            }
        )
        .withColumn("taken", F.col("copies") * F.col("size") + F.col("extra"))
        .drop("of", "order", "shard", "shards", "source_blocks", "shard_size", "quota", "q_of", "q_shard", "upto")
    )


def mixed_documents(mixed: DataFrame) -> DataFrame:
    """The documents of the mix: one row per copy, and one of the leading words if any.

    The cut keeps the white space between its words; `n_chars` is that of the row's text.
    """
    ends = F.split(F.col("text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.array_join(F.slice(ends, 1, F.col("extra").cast("int")), "")
    texts = F.concat(
        F.array_repeat(F.col("text"), F.col("copies").cast("int")),
        F.when(F.col("extra") == 0, F.array()).when(F.col("extra") == F.col("size"), F.array("text")).otherwise(F.array(part)),
    )
    return mixed.select("doc_id", F.explode(texts).alias("text"), "lang", "source").select(
        "doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars")
    )
