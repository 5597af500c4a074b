"""Similarity join on word n-grams: pairs of texts with a Jaccard similarity of t or more.

1. Every text becomes the set of its five-word shingles, hashed to 64 bits, and 512 MinHash
   values. Texts with equal sets are one class from here on, so copies cost nothing more.
2. Candidates share one of 64 bands of eight values. A pair at similarity 0.8 shares none with
   a chance of 8 in a million, one at 0.1, such as texts that share a passage, one with less
   than 1 in a million, so that passages do not chain texts together. Pairs are not listed:
   the members of a bucket are chained to its least member, and the components of these
   chains hold all candidates.
3. Components are cut into blocks of a bounded number of sets and of shingles, and each two
   blocks (or one with itself) are compared in one task. There the first 160 values of all
   pairs are compared step by step; after each step, pairs whose posterior probability of
   reaching the threshold is below the tolerance are dropped. With an even prior that
   probability is a binomial sum.
4. What is left is verified exactly on the shingle sets.

A task returns each set's number of links and the root of its part of the link graph, never
pairs, so a group of k near copies costs k^2 comparisons in blocks, spread over tasks, but
k rows. The parts are joined by another components run.

Similarity is of whole texts as they are: words are runs of characters other than space, tab,
line feed, VT, FF and CR. Texts of one to four words have one shingle, all their words.

Defined results: a NULL text, or one without words, has no shingles: it has no links and is a
class of its own row (class_id is its own id, n_copies 1). Rows with equal texts, also
repeated rows, are copies. A NULL doc_id takes part; a class of such rows only has a NULL
class_id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored, text_of
from landfall.llm.components import components

NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class JoinSettings:
    words: int = 5
    threshold: float = 0.8
    bands: int = 64
    band_rows: int = 8
    compared: int = 160
    step: int = 16
    tolerance: float = 1e-6
    block_sets: int = 1024
    block_shingles: int = 1 << 19
    seed: int = 11

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Shingler:
    """Sets, MinHash values and fingerprints of texts; remembers a bounded number of words."""

    def __init__(self, settings: JoinSettings):
        import xxhash

        self.s, self.digest = settings, xxhash.xxh64_intdigest
        self.known: dict[bytes, int] = {}
        rng = np.random.default_rng(settings.seed)
        self.a = (rng.integers(0, 1 << 32, settings.hashes, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.b = rng.integers(0, 1 << 32, settings.hashes, dtype=np.uint64).astype(np.uint32)

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes."""
        words = text.encode("utf-8", "surrogatepass").split()
        known = self.known
        if len(known) > 400_000:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self.digest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.s.words, len(hashes))
        if not n:
            return hashes
        rolled = np.full(len(hashes) - n + 1, n, np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k]
        return np.unique(_mixed(rolled))

    def signature(self, shingles: np.ndarray, hashes: int) -> np.ndarray:
        """The first MinHash values of a set."""
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(hashes, 0xFFFFFFFF, np.uint32)
        a, b = self.a[:hashes], self.b[:hashes]
        room = np.empty((128, hashes), np.uint32)
        for at in range(0, len(low), 128):
            part = low[at : at + 128, None]
            values = np.multiply(part, a, out=room[: len(part)])
            values += b
            np.minimum(out, values.min(axis=0), out=out)
        return out

    def bands(self, signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(self.s.bands, self.s.band_rows).astype(np.uint64)
        out = np.arange(1, self.s.bands + 1, dtype=np.uint64)
        for k in range(self.s.band_rows):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
        return out.view(np.int64)

    @staticmethod
    def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
        """Two sums over the set, as signed 64-bit numbers."""
        one = _mixed(shingles + np.uint64(len(shingles))).sum(dtype=np.uint64)
        two = _mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return int(one.view(np.int64)), int(two.view(np.int64))


def _text_key() -> Column:
    return F.xxhash64("text", F.char_length("text"))


def signatures(docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """(doc_id, key, n, p1, p2, bands) of every row; the p's tell equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _Shingler(settings)
        for batch in batches:
            n, p1, p2, bands = [], [], [], []
            for text in batch.column("text"):
                found = shingler.shingles(text.as_py())
                n.append(len(found))
                one, two = shingler.fingerprint(found)
                p1.append(one)
                p2.append(two)
                bands.append(shingler.bands(shingler.signature(found, settings.hashes)) if len(found) else np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), lists],
                names=["doc_id", "key", "n", "p1", "p2", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.select("doc_id", _text_key().alias("key"), "text").mapInArrow(
        run, "doc_id long, key long, n long, p1 long, p2 long, bands array<long>"
    )


def least_matches(settings: JoinSettings) -> dict[int, int]:
    """By number of values compared: the fewest matches that keep a pair.

    With an even prior, the chance that the similarity is t or more after m matches of n is
    the chance of at most m successes in n + 1 trials that succeed with t.
    """
    bounds, t = {}, settings.threshold
    for n in range(settings.step, settings.compared + 1, settings.step):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= settings.tolerance:
                break
        bounds[n] = m
    return bounds


def surviving_pairs(a: np.ndarray, b: np.ndarray, same: bool, settings: JoinSettings):
    """Pairs of rows of two signature matrices that pass every step, as two index lists."""
    bounds, step = least_matches(settings), settings.step
    left, right = [], []
    for at in range(0, len(a), 256):
        part = a[at : at + 256]
        matches = np.zeros((len(part), len(b)), np.int16)
        for k in range(step):
            matches += part[:, k, None] == b[None, :, k]
        alive = matches >= bounds[step]
        if same:
            alive &= np.arange(at, at + len(part))[:, None] < np.arange(len(b))[None, :]
        i, j = np.nonzero(alive)
        count = matches[i, j]
        for n in range(2 * step, settings.compared + 1, step):
            for k in range(n - step, n):
                count = count + (part[i, k] == b[j, k])
            stays = count >= bounds[n]
            i, j, count = i[stays], j[stays], count[stays]
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def common_sizes(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of sets_a[i] and sets_b[j]."""
    if len(i) <= 32:
        return np.array([len(np.intersect1d(sets_a[x], sets_b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    rows, rank_a = np.unique(i, return_inverse=True)
    columns, rank_b = np.unique(j, return_inverse=True)
    flat = np.concatenate([*[sets_a[x] for x in rows], *[sets_b[y] for y in columns]])
    owner = np.repeat(np.arange(len(rows) + len(columns)), [len(sets_a[x]) for x in rows] + [len(sets_b[y]) for y in columns])
    values, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    where = number[where]
    kept = where >= 0
    owner, where = owner[kept], where[kept]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    total = np.zeros((len(rows), len(columns)), np.float32)
    for at in range(0, len(shared), 2048):
        lo, hi = np.searchsorted(where, [at, at + 2048])
        table = np.zeros((len(rows) + len(columns), 2048), np.float32)
        table[owner[lo:hi], where[lo:hi] - at] = 1
        total += table[: len(rows)] @ table[len(rows) :].T
    return total[rank_a, rank_b].astype(np.int64)


def links_of(sets_a: list, sigs_a: np.ndarray, sets_b: list, sigs_b: np.ndarray, same: bool, settings: JoinSettings):
    """Verified links between two blocks (or within one) as two index lists."""
    i, j = surviving_pairs(sigs_a, sigs_b, same, settings)
    size_a = np.array([len(s) for s in sets_a], np.int64)[i]
    size_b = np.array([len(s) for s in sets_b], np.int64)[j]
    t = round(settings.threshold * 1000)
    possible = np.minimum(size_a, size_b) * 1000 >= t * np.maximum(size_a, size_b)
    i, j, size_a, size_b = i[possible], j[possible], size_a[possible], size_b[possible]
    both = common_sizes(sets_a, sets_b, i, j)
    linked = both * 1000 >= t * (size_a + size_b - both)
    return i[linked], j[linked]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index of each node's part of the graph."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_LINKS = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("links", pa.int64()), ("root1", pa.int64()), ("root2", pa.int64())])


def _compare(settings: JoinSettings):
    """Links within the units of one batch, per set."""

    def run(table: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in _LINKS]
        table = table.sort_by([("component", "ascending"), ("p1", "ascending"), ("p2", "ascending")])
        groups = table["component"].to_numpy()
        p1, p2, block = (table[c].to_numpy() for c in ("p1", "p2", "block"))
        fresh = np.ones(len(p1), bool)
        fresh[1:] = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]) | (groups[1:] != groups[:-1])
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
        sigs = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in table["signature"]])
        edges = np.flatnonzero(np.diff(groups, prepend=groups[:1] - 1))
        for lo, hi in zip(edges, [*edges[1:], len(groups)], strict=True):
            at = np.flatnonzero(fresh[lo:hi]) + lo
            if len(at) < 2:
                continue
            if (block[at] == block[at[0]]).all():
                # One block with itself. A unit of two blocks of which one is empty has
                # nothing to compare; the blocks' numbers tell the two apart.
                if table["i"][int(lo)].as_py() != table["j"][int(lo)].as_py():
                    continue
                one = [sets[x] for x in at]
                i, j = links_of(one, sigs[at], one, sigs[at], True, settings)
                where_i, where_j = i, j
            else:
                first, second = at[block[at] == block[at].min()], at[block[at] == block[at].max()]
                i, j = links_of([sets[x] for x in first], sigs[first], [sets[x] for x in second], sigs[second], False, settings)
                where_i, where_j = np.searchsorted(at, first[i]), np.searchsorted(at, second[j])
            if not len(where_i):
                continue
            links = np.bincount(where_i, minlength=len(at)) + np.bincount(where_j, minlength=len(at))
            root = _roots(len(at), where_i, where_j)
            has = np.flatnonzero(links)
            for column, values in zip(out, (p1[at[has]], p2[at[has]], links[has], p1[at[root[has]]], p2[at[root[has]]]), strict=True):
                column.append(values)
        arrays = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(arrays, schema=_LINKS)

    return run


def _sets(settings: JoinSettings):
    """Shingles and signature of the texts that stand for a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _Shingler(settings)
        for batch in batches:
            shingles, sigs, right = [], [], []
            for text, p1, p2 in zip(batch.column("text"), batch.column("p1"), batch.column("p2"), strict=True):
                found = shingler.shingles(text.as_py())
                right.append(shingler.fingerprint(found) == (p1.as_py(), p2.as_py()))
                shingles.append(found.tobytes())
                sigs.append(shingler.signature(found, settings.compared).tobytes())
            names = ["component", "p1", "p2", "blocks", "block"]
            whole = pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(shingles, pa.binary()), pa.array(sigs, pa.binary())],
                names=[*names, "shingles", "signature"],
            )
            yield whole.filter(pa.array(right, pa.bool_()))

    return run


def joined(docs: DataFrame, settings: JoinSettings | None = None) -> DataFrame:
    """(doc_id, key, class_id, n_links, n_copies, keeps) per row.

    `class_id` is the least doc_id of all texts that are linked, directly or in turn;
    `n_links` the number of different sets at the threshold or above; `n_copies` the rows with
    an equal set; `keeps` marks one row of each class, or several if rows are repeated, which
    have equal `key`s.
    """
    s = settings or JoinSettings()
    signed = stored(signatures(docs, s), "ngram_signatures")
    with_words = signed.where("n > 0")
    first = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key")
    classes = stored(
        with_words.groupBy("p1", "p2").agg(F.min(F.struct(first.alias("first"), "bands", "n")).alias("m"), F.count(F.lit(1)).alias("n_copies"))
        .select("p1", "p2", "m.first", "m.bands", "m.n", "n_copies"),
        "ngram_classes",
    )
    banded = classes.select("p1", F.explode("bands").alias("band"))
    buckets = stored(
        banded.groupBy("band").agg(F.min("p1").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "least"),
        "ngram_buckets",
    )
    chains = banded.join(buckets, "band").select(F.col("p1").alias("a"), F.col("least").alias("b"))
    candidates = stored(components(chains), "ngram_candidates")
    nodes = candidates.join(classes.select(F.col("p1").alias("node"), "p2", "first", "n"), "node")
    needed = F.greatest(F.count(F.lit(1)) / s.block_sets, F.sum("n") / s.block_shingles)
    sizes = nodes.groupBy("component").agg(F.ceil(needed).cast("int").alias("blocks"))
    members = stored(
        nodes.join(sizes, "component").select(
            "component", F.col("node").alias("p1"), "p2", "n", "blocks",
            F.pmod(F.xxhash64("node", "p2"), F.col("blocks")).cast("int").alias("block"),
            F.col("first.id").alias("m_id"), F.col("first.key").alias("m_key"),
        ),
        "ngram_members",
    )
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text_of().alias("text"))
    texts = texts.withColumn("key", _text_key())
    # The texts are shuffled at any size: the members grow with the documents.
    picked = texts.join(
        members.hint("shuffle_hash"), (F.col("id") == F.col("m_id")) & (F.col("key") == F.col("m_key"))
    )
    sets = picked.select("component", "p1", "p2", "blocks", "block", "text").mapInArrow(
        _sets(s), "component long, p1 long, p2 long, blocks int, block int, shingles binary, signature binary"
    )
    # Components of one block share batches; two blocks of a larger one are a unit each.
    total = members.agg(F.sum("n")).first()[0] or 0
    batches = max(1, 2 * total // s.block_shingles)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = sets.withColumn("other", other).select(
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(batches))).otherwise(F.col("component")).alias("unit"),
        (F.col("blocks") > 1).alias("large"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "component", "p1", "p2", "block", "shingles", "signature",
    )
    found = stored(
        units.groupBy("unit", "large", "i", "j").applyInArrow(_compare(s), "p1 long, p2 long, links long, root1 long, root2 long"),
        "ngram_links",
    )
    node = F.struct("p1", "p2")
    parts = components(found.select(node.alias("a"), F.struct(F.col("root1").alias("p1"), F.col("root2").alias("p2")).alias("b")))
    links = found.groupBy("p1", "p2").agg(F.sum("links").alias("n_links"))
    named = (
        classes.drop("bands", "n")
        .join(links, ["p1", "p2"], "left")
        .join(parts.select("node.p1", "node.p2", "component"), ["p1", "p2"], "left")
        .withColumn("component", F.coalesce("component", node))
    )
    whole = named.groupBy("component").agg(F.min("first").alias("chief"))
    classed = stored(
        named.join(whole, "component").select("p1", "p2", "n_links", "n_copies", "chief"), "ngram_classed"
    )
    own = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key")
    in_class = (
        with_words.join(classed, ["p1", "p2"])
        .select(
            "doc_id", "key",
            F.when(F.col("chief.id") != NO_ID, F.col("chief.id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies",
            (own == F.col("chief")).alias("keeps"),
        )
    )
    alone = signed.where("n = 0").select(
        "doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("keeps"),
    )
    return in_class.unionByName(alone)


def one_per_class(docs: DataFrame, settings: JoinSettings | None = None) -> DataFrame:
    """The documents without near copies: one row of each class stays, whole."""
    kept = joined(docs, settings).where("keeps").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("rows"), F.max("n_copies"), F.min("n_links"))
    kept = stored(kept.select(F.col("doc_id").alias("k_id"), F.col("key").alias("k_key")), "ngram_kept")
    keyed = docs.withColumn("ng_key", F.xxhash64(text_of(), F.char_length(text_of())))
    found = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("ng_key") == F.col("k_key")), "left_semi")
    has_words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # Repeated rows of a class are one; rows without words are no class and all stay.
    some = found.where(has_words).dropDuplicates(["doc_id", "ng_key"])
    return some.unionByName(found.where(~F.coalesce(has_words, F.lit(False)))).drop("ng_key")
