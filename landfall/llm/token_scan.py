"""Separator scan: token counts per document from flat token streams without an index.

A stream is a flat run of 16-bit ids in which one id ends each document. It is read in
blocks that end anywhere. Each block is searched at once with numpy for the separator; what
crosses blocks is stitched by a prefix scan over one small row per block: documents ended
before the block, and the position of the last separator before it. The scan has two levels,
within runs of blocks and over runs, so one very long stream does not end up in one task.

Defined results: an empty document is a count of 0; ids behind the last separator of a
stream are one document with `terminated` false; an empty block changes nothing; a NULL
block is an empty one; an empty table gives no rows; other columns are ignored. Block
numbers of a stream have to be distinct and ascending, gaps are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import text_of
from landfall.llm.tokens import END_OF_TEXT, encoder

#: Ids in a block, and blocks in a run of the prefix scan's first level.
BLOCK_IDS = 1 << 15
RUN_BLOCKS = 1024


def token_streams(docs: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents as flat streams, one per partition: (stream, block, data, listing).

    `data` is all that a flat file would hold. `listing` names the documents that end in the
    block, by number in the stream; the scan does not read it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ordinary=True)
        stream, block, number = TaskContext.get().partitionId(), 0, 0
        parts: list[np.ndarray] = []
        held, names = 0, []
        end = np.array([END_OF_TEXT], np.uint16)

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, held, block, names
            flat = np.concatenate(parts) if parts else np.empty(0, np.uint16)
            size = held if last else held - held % block_ids
            pieces = [flat[i : min(i + block_ids, size)] for i in range(0, size, block_ids)]
            parts, held = [flat[size:]], held - size
            if pieces:
                listings = [names, *[[] for _ in pieces[1:]]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([stream] * len(pieces), pa.int64()),
                        pa.array(range(block, block + len(pieces)), pa.int64()),
                        pa.array([p.astype("<u2").tobytes() for p in pieces], pa.binary()),
                        pa.array(listings, pa.list_(pa.struct([("number", pa.int64()), ("doc_id", pa.int64())]))),
                    ],
                    names=["stream", "block", "data", "listing"],
                )
                block, names = block + len(pieces), []

        for batch in batches:
            for doc, text in zip(*batch.columns, strict=True):
                ids = encode(text.as_py()).astype(np.uint16)
                parts += [ids, end]
                held += len(ids) + 1
                names.append({"number": number, "doc_id": doc.as_py()})
                number += 1
                if held >= 16 * block_ids:
                    yield from cut(last=False)
        yield from cut(last=True)

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(
        run, "stream long, block long, data binary, listing array<struct<number:long,doc_id:long>>"
    )


def _record_ids(ids: int, most: int) -> int:
    """The largest divisor of `ids` that is at most `most`."""
    return max(d for d in range(1, min(ids, most) + 1) if ids % d == 0)


def _blocks_of(stream: str, record: int, size: int):
    """Records (number, bytes) of a split, joined into blocks cut at multiples of `size` bytes.

    A split that begins inside a block has the odd number, what comes before it the even one.
    """

    def run(records: Iterator[tuple[int, bytes]]) -> Iterator[tuple[str, int, bytearray]]:
        held, begin = bytearray(), 0
        for number, data in records:
            if not held:
                begin = number * record
            held += data
            while len(held) >= size - begin % size:
                cut = size - begin % size
                yield stream, begin // size * 2 + (begin % size > 0), held[:cut]
                held, begin = held[cut:], begin + cut
        if held:
            yield stream, begin // size * 2 + (begin % size > 0), held

    return run


def read_token_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of flat token files of any length: the stream is the file's path.

    Only paths and lengths are listed; the files are read in splits, as records of equal
    length. Records must tile their file, so their length is its largest divisor up to a block;
    where that is small, reading is slower, down to one id at a time. A file of an odd number of
    bytes is refused.
    """
    size = 2 * block_ids
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length").collect()
    parts = []
    for name, length in files:
        if length % 2:
            raise ValueError(f"{name} has an odd number of bytes")
        record = 2 * _record_ids(length // 2, block_ids)
        records = spark.sparkContext.newAPIHadoopFile(
            name,
            "org.apache.spark.input.FixedLengthBinaryInputFormat",
            "org.apache.hadoop.io.LongWritable",
            "org.apache.hadoop.io.BytesWritable",
            conf={
                "org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(record),
                # No block holds more than one border of splits.
                "mapreduce.input.fileinputformat.split.minsize": str(2 * size),
            },
        )
        parts.append(records.mapPartitions(_blocks_of(name, record, size)))
    rows = spark.sparkContext.union(parts) if parts else spark.sparkContext.emptyRDD()
    return spark.createDataFrame(rows, "stream string, block long, data binary")


def _search(separator: int):
    """Per block: ids, separators, the place of the first and last, and the gaps between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, firsts, lasts, gaps = [], [], [], []
            for data in batch.column("data"):
                ids = np.frombuffer(data.as_py() or b"", "<u2")
                at = np.flatnonzero(ids == separator)
                sizes.append(len(ids))
                firsts.append(int(at[0]) if len(at) else None)
                lasts.append(int(at[-1]) if len(at) else None)
                gaps.append((np.diff(at) - 1).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("stream"),
                    batch.column("block"),
                    pa.array(sizes, pa.int64()),
                    pa.array(firsts, pa.int64()),
                    pa.array(lasts, pa.int64()),
                    pa.array(gaps, pa.list_(pa.int64())),
                ],
                names=["stream", "block", "size", "first", "last", "gaps"],
            )

    return run


def separator_scan(
    blocks: DataFrame, separator: int = END_OF_TEXT, run_blocks: int = RUN_BLOCKS
) -> DataFrame:
    """One row per document: stream, number within it, n_tokens, terminated."""
    kind = dict(blocks.dtypes)["stream"]
    found = (
        blocks.select("stream", F.col("block").cast("long"), "data")
        .mapInArrow(
            _search(separator),
            f"stream {kind}, block long, size long, first long, last long, gaps array<long>",
        )
        .withColumn("run", F.expr(f"block div {run_blocks}"))
        .withColumn("ended", F.when(F.col("first").isNull(), 0).otherwise(F.size("gaps") + 1))
    )
    within = Window.partitionBy("stream", "run").orderBy("block")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumns(
        {
            "base": F.coalesce(F.sum("size").over(before), F.lit(0)),
            "ended_before": F.coalesce(F.sum("ended").over(before), F.lit(0)),
        }
    ).withColumn("sep_before", F.max(F.col("base") + F.col("last")).over(before))
    runs = placed.groupBy("stream", "run").agg(
        F.sum("size").alias("run_size"),
        F.sum("ended").alias("run_ended"),
        F.max(F.col("base") + F.col("last")).alias("run_sep"),
    )
    over_runs = Window.partitionBy("stream").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns(
        {
            "run_base": F.coalesce(F.sum("run_size").over(over_runs), F.lit(0)),
            "run_before": F.coalesce(F.sum("run_ended").over(over_runs), F.lit(0)),
        }
    ).withColumn("sep_runs", F.max(F.col("run_base") + F.col("run_sep")).over(over_runs))
    joined = placed.join(
        runs.select(F.col("stream").alias("s"), F.col("run").alias("r"), "run_base", "run_before", "sep_runs", "run_size", "run_sep"),
        (F.col("stream") == F.col("s")) & (F.col("run") == F.col("r")),
    )
    # The first document to end in a block began after the last separator before it.
    begin = F.coalesce(F.col("run_base") + F.col("sep_before"), F.col("sep_runs"), F.lit(-1)) + 1
    head = F.col("run_base") + F.col("base") + F.col("first") - begin
    counts = joined.where("ended > 0").select(
        "stream",
        (F.col("run_before") + F.col("ended_before")).alias("from"),
        F.posexplode(F.concat(F.array(head), F.col("gaps"))).alias("k", "n_tokens"),
    )
    ended = counts.select(
        "stream", (F.col("from") + F.col("k")).alias("number"), "n_tokens", F.lit(True).alias("terminated")
    )
    tails = (
        runs.groupBy("stream")
        .agg(
            F.sum("run_size").alias("ids"),
            F.sum("run_ended").alias("number"),
            F.coalesce(F.max(F.col("run_base") + F.col("run_sep")), F.lit(-1)).alias("sep"),
        )
        .select("stream", "number", (F.col("ids") - F.col("sep") - 1).alias("n_tokens"), F.lit(False).alias("terminated"))
        .where("n_tokens > 0")
    )
    return ended.unionByName(tails)
