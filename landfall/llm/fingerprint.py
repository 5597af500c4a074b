"""Homomorphic multiset hash of documents: the sum of wide vectors hashed from paragraphs.

A paragraph (a line) hashes to a vector of two parts. Eight lanes modulo 2^32 are its own
hash under four keys; their sums tell multisets of paragraphs apart. Sixty lanes of 32
bits hold one bit each of the hashes of its word triples, added up; taken as 2 * sum -
number, they are a sum of random signs, so the cosine of two sums estimates the likeness of
the texts at any length. Because a document's vector is a plain sum, order does not matter,
and a paragraph is put in or taken out by adding or subtracting its vector (`combined`).

Two 32-bit lanes travel in one 64-bit sum. A text has at most 2^31 bytes and so fewer than
2^30 triples: adding a bit to each lane neither carries into the next one nor leaves 64 bits.
The sums are ordinary partial aggregates: a document's rows are added up in the task that
reads it, and one row per document is shuffled.

Defined results: a NULL text is the empty text, one empty paragraph. Two texts without a
word are alike (1.0), one without is unlike any other (0.0). Equal texts have equal
fingerprints, repeated rows too. A NULL doc_id comes last in the order and all such rows
form one run; rows with one id are ordered by their text. An empty table gives no rows; other
columns are ignored. A single document is its own successor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import bound, stored, text_of
from landfall.llm.quality import SPACE, SPACES

#: Keys of the hash lanes; 64-bit sums, each with lanes at two places 32 bits apart.
KEYS = (11, 23, 37, 53)
SIGN_SUMS = 30
PLACES = (0, 32)
LANE_MASK = sum(1 << place for place in PLACES)
FIELD = (1 << 32) - 1


def _triples(paragraph: Column) -> Column:
    """Hashes of all runs of three words; of all words together where there are fewer."""
    trimmed = F.btrim(paragraph, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(
        bound(
            F.transform(F.split(trimmed, SPACE), lambda w: F.xxhash64(w)),
            lambda h: F.when(F.size(h) < 3, F.array(F.xxhash64(h))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.size(h) - 3),
                    lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)),
                )
            ),
        )
    )


def vectors(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per key: eight hash sums, thirty sign sums and the number of triples."""
    # A paragraph is hashed here, once. Hashes named beside the second explode would be
    # computed again for each of its triples, which is quadratic in a long line.
    paragraphs = F.transform(
        F.split(F.col(text), "\n"),
        lambda p: F.struct(
            *[F.xxhash64(F.lit(k), p).alias(f"h{i}") for i, k in enumerate(KEYS)], _triples(p).alias("triples")
        ),
    )
    hashed = texts.select(key, F.explode(paragraphs).alias("fp_paragraph")).select(
        key,
        *[F.col(f"fp_paragraph.h{i}").alias(f"fp_h{i}") for i in range(len(KEYS))],
        F.posexplode_outer("fp_paragraph.triples").alias("fp_at", "fp_triple"),
    )
    first = F.coalesce(F.col("fp_at"), F.lit(0)) == 0
    lanes = []
    for i in range(len(KEYS)):
        h = F.when(first, F.col(f"fp_h{i}"))
        low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
        lanes += [(F.sum(low) % (1 << 32)).alias(f"fp_l{2 * i}"), (F.sum(high) % (1 << 32)).alias(f"fp_l{2 * i + 1}")]
    signs = [
        F.sum(F.shiftrightunsigned("fp_triple", j).bitwiseAND(F.lit(LANE_MASK))).alias(f"fp_s{j}")
        for j in range(SIGN_SUMS)
    ]
    summed = hashed.groupBy(key).agg(*lanes, *signs, F.count("fp_triple").alias("fp_n"))
    sums = [F.coalesce(F.col(f"fp_s{j}"), F.lit(0)) for j in range(SIGN_SUMS)]
    return summed.select(
        key,
        F.array(*[F.col(f"fp_l{i}") for i in range(2 * len(KEYS))]).alias("lanes"),
        F.array(*sums).alias("signs"),
        F.col("fp_n").alias("triples"),
    )


def text_form(lanes: Column, signs: Column, triples: Column) -> Column:
    """A fingerprint as hexadecimal text of fixed width."""
    wide = F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    more = F.transform(signs, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.concat(F.array_join(wide, ""), F.array_join(more, ""), F.lpad(F.lower(F.hex(triples)), 8, "0"))


def combined(one: Column, other: Column, remove: bool = False) -> Column:
    """The fingerprint struct of a multiset with another put in, or taken out."""
    sign = -1 if remove else 1
    return F.struct(
        F.zip_with(one["lanes"], other["lanes"], lambda a, b: F.pmod(a + sign * b, F.lit(1 << 32))).alias("lanes"),
        F.zip_with(one["signs"], other["signs"], lambda a, b: a + sign * b).alias("signs"),
        (one["triples"] + sign * other["triples"]).alias("triples"),
    )


def _signed(signs: Column, n: Column) -> Column:
    """The lanes as sums of signs."""
    return F.flatten(
        F.transform(
            signs,
            lambda x: F.transform(
                F.array(*[F.lit(place) for place in PLACES]),
                lambda k: 2 * F.call_function("shiftrightunsigned", x, k).bitwiseAND(F.lit(FIELD)) - n,
            ),
        )
    )


def likeness(one: Column, other: Column) -> Column:
    """Cosine of two fingerprints' sign sums, within 0 to 1; equal ones give 1."""

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: (x * y).cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)

    same = (one["lanes"] == other["lanes"]) & (one["triples"] == other["triples"])
    cosine = bound(
        F.struct(
            _signed(one["signs"], one["triples"]).alias("a"),
            _signed(other["signs"], other["triples"]).alias("b"),
        ),
        lambda v: F.try_divide(dot(v["a"], v["b"]), F.sqrt(dot(v["a"], v["a"]) * dot(v["b"], v["b"]))),
    )
    return (
        F.when(same | ((one["triples"] == 0) & (other["triples"] == 0)), F.lit(1.0))
        .when((one["triples"] == 0) | (other["triples"] == 0), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(cosine, F.lit(0.0)))))
    )


def with_next(docs: DataFrame, run_bits: int = 9) -> DataFrame:
    """(doc_id, text, next_text, fp_run, fp_at, guest): each document and its successor.

    Documents are ordered by descending id. Runs of 2^`run_bits` ids are sorted apart, each with
    a guest, the document that follows its last one, so texts are shuffled once and no task
    sees more than a run. The runs themselves, one small row each, are chained in one task.
    """
    placed = docs.select("doc_id", text_of().alias("text")).withColumn(
        "fp_run", F.coalesce(-F.shiftright(F.col("doc_id").cast("long"), run_bits), F.lit(1 << 62))
    )
    heads = placed.groupBy("fp_run").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy("fp_run")
    back = F.coalesce(F.lag("fp_run").over(order), F.max("fp_run").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    chained = stored(heads.select(F.col("fp_run").alias("h_run"), "head", back.alias("h_back")), "runs")
    joined = placed.join(chained, F.col("fp_run") == F.col("h_run"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head"))
    stays = F.struct(F.col("fp_run").alias("fp_run"), F.lit(False).alias("guest"))
    visits = F.struct(F.col("h_back").alias("fp_run"), F.lit(True).alias("guest"))
    dealt = joined.select(
        "doc_id", "text", F.inline(F.when(is_head, F.array(stays, visits)).otherwise(F.array(stays)))
    )
    run = Window.partitionBy("fp_run").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.withColumns(
        {"next_text": F.lead("text").over(run), "fp_at": F.row_number().over(run)}
    )


def successive(docs: DataFrame) -> DataFrame:
    """Each document with its edited text and the fingerprints of both and of its successor."""
    n = F.char_length("text")
    half = F.expr("int(char_length(text) div 2)")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = (
        with_next(docs)
        .withColumns({"n_chars": n.cast("long"), "edited": F.when(~F.col("guest"), edited)})
        .withColumn(
            "fp_key",
            F.struct(
                "fp_run", "fp_at", "guest", "doc_id", "n_chars",
                F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            ),
        )
    )
    both = rows.select(
        "fp_key",
        F.posexplode(F.when(F.col("guest"), F.array("text")).otherwise(F.array("text", "edited"))).alias("kind", "fp_text"),
    ).select(F.struct("fp_key", "kind").alias("fp_key"), "fp_text")
    found = vectors(both, "fp_key", "fp_text").select(
        "fp_key.fp_key.*", F.col("fp_key.kind").alias("kind"), F.struct("lanes", "signs", "triples").alias("fp")
    )
    # A document's two vectors meet in one row; its successor's is in the next one.
    of = lambda kind: F.first(F.when(F.col("kind") == kind, F.col("fp")), ignorenulls=True)
    keys = ["fp_run", "fp_at", "guest", "doc_id", "n_chars", "edited_sha256"]
    both = found.groupBy(*keys).agg(of(0).alias("fp"), of(1).alias("edited_fp"))
    run = Window.partitionBy("fp_run").orderBy("fp_at")
    return both.withColumn("next_fp", F.lead("fp").over(run)).where(~F.col("guest")).drop("guest")
