"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5, with marks for its ends) and itself,
hashed into a fixed number of buckets that each hold a small vector, so a misspelt or
inflected form shares most vectors with the word it comes from. The vectors of a window of
eight words are averaged and go through a linear softmax over two classes; vectors and
softmax are trained together by Adagrad in numpy, on the driver, from a bounded sample.

A label says only that a text is toxic somewhere. So a text's score is that of its worst
window. Training starts with every window under its text's label, and goes on with the worst
windows of toxic texts only, against those of the others that score high and a random tenth
of the rest. N-grams of very few texts hold no vector. A last step fits the slope and offset
that turn worst windows into probabilities.

Scoring reads whole texts in one pass, without a shuffle. With two classes the softmax needs
one number per bucket, so what tasks get is the same quarter of a megabyte at any size.

Bounds of the training sample, all parameters: rows per class, and the longest text that is
used for training, in characters. The sample is drawn by a hash of the id.

Defined results: a NULL or empty text gets the score of a window without words. A NULL id is
scored, and held out as it has no remainder of 2 (`held_out` is false). Repeated rows get
equal scores. Labels with a NULL id or class are not used; ids labelled both ways count as
toxic. Without examples of both classes every score is the share of toxic examples, 0 if
there are none. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored, text_of

MARKS = "\"'`.,;:!?()[]{}<>«»“”„…-_*/\\|~^#"


@dataclass(frozen=True)
class Settings:
    """Size of the model and of its training."""

    buckets: int = 1 << 16
    width: int = 8
    window: int = 8
    min_texts: int = 3
    epochs: int = 6
    rate: float = 0.2
    batch: int = 4096
    least_steps: int = 60
    toxic_rows: int = 2000
    clean_rows: int = 3000
    longest_text: int = 20_000
    threshold: float = 0.3
    seed: int = 7


#: Characters of words whose n-grams are taken at a time when texts are scored.
LONGEST = 1 << 18


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' n-grams, one after the other, and how many each word has."""
    marked = [f"<{w}>" for w in words]
    sizes = np.array([len(w) for w in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    place = np.arange(len(codes))
    found, whose = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, 6):
        # Each step takes the next character of the n-gram that begins at a place.
        kept = max(0, len(codes) - n + 1)
        rolling[:kept] = rolling[:kept] * np.uint64(1_000_003) + codes[n - 1 :] + np.uint64(1)
        if n >= 3:
            inside = place + n <= ends[owner]
            found.append(rolling[inside] * np.uint64(31) + np.uint64(n))
            whose.append(owner[inside])
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), 1_000_033, np.uint64))
    starts = ends - sizes
    whole = codes * powers[place - starts[owner]]
    found.append(np.add.reduceat(whole, starts) if len(words) else whole)
    whose.append(np.arange(len(words)))
    hashes, owners = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(owners, kind="stable")
    return _bucket(hashes[order], buckets), np.bincount(owners, minlength=len(words))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = hashes ^ (hashes >> np.uint64(29))
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(buckets)).astype(np.int32)


def long_word_mean(word: str, values: np.ndarray, block: int = 1 << 16) -> float:
    """The mean value of a word's n-grams, taken in blocks: `subwords` takes some 240 bytes a
    character, this four."""
    codes = np.frombuffer(f"<{word}>".encode("utf-32-le", "surrogatepass"), np.uint32)
    total, count, whole = 0.0, 1, 0
    powers = np.cumprod(np.full(block, 1_000_033, np.uint64))
    for at in range(0, len(codes), block):
        part = codes[at : at + block + 4].astype(np.uint64)
        size = min(block, len(codes) - at)
        rolling = np.zeros(size, np.uint64)
        for n in range(1, 6):
            kept = max(0, min(size, len(codes) - at - n + 1))
            rolling[:kept] = rolling[:kept] * np.uint64(1_000_003) + part[n - 1 : n - 1 + kept] + np.uint64(1)
            if n >= 3:
                grams = rolling[:kept] * np.uint64(31) + np.uint64(n)
                total += float(values[_bucket(grams, len(values))].sum(dtype=np.float64))
                count += kept
        sums = int((part[:size] * powers[:size]).sum(dtype=np.uint64))
        whole = (whole + sums * pow(1_000_033, at, 1 << 64)) % (1 << 64)
    last = _bucket(np.array([whole], np.uint64), len(values))
    return (total + float(values[last[0]])) / count


def tokens(text: str) -> list[str]:
    """Words in lower case; a word repeated at once counts once."""
    found = text.lower().split()
    return found[:1] + [b for a, b in zip(found, found[1:], strict=False) if a != b]


class _Trainer:
    """The joint training of bucket vectors and softmax on windows of words."""

    def __init__(self, texts: list[str], toxic: np.ndarray, settings: Settings):
        self.s, self.toxic = settings, toxic
        index: dict[str, int] = {}
        word_ids = []
        for text in texts:
            ids = [index.setdefault(w.strip(MARKS), len(index)) for w in tokens(text)]
            word_ids.append(np.array(ids, np.int32))
        words = list(index)
        del index
        parts = [subwords(words[i : i + 10_000], settings.buckets) for i in range(0, len(words), 10_000)]
        self.subs = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32)
        self.counts = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
        del words, parts
        self.begin = np.concatenate([[0], np.cumsum(self.counts)])
        half, width = max(1, settings.window // 2), settings.window
        windows, owners = [], []
        for doc, ids in enumerate(word_ids):
            starts = np.arange(0, max(1, len(ids) - half), half)
            padded = np.concatenate([ids, np.full(width, -1, np.int32)])
            windows.append(padded[starts[:, None] + np.arange(width)])
            owners.append(np.full(len(starts), doc, np.int32))
        self.windows, self.owner = np.concatenate(windows), np.concatenate(owners)
        self.common = self._common(word_ids)
        rng = np.random.default_rng(settings.seed)
        self.rng = rng
        self.vectors = rng.uniform(-1, 1, (settings.buckets, settings.width)).astype(np.float32) / settings.width
        self.vectors[~self.common] = 0
        self.softmax = np.zeros((settings.width, 2), np.float32)
        self.bias = np.zeros(2, np.float32)
        self.sums = [np.full_like(x, 1e-4) for x in (self.vectors, self.softmax, self.bias)]

    def _common(self, word_ids: list[np.ndarray]) -> np.ndarray:
        """Buckets that occur in enough texts to say something about others."""
        texts = np.zeros(self.s.buckets, np.int64)
        for ids in word_ids:
            used = [self.subs[self.begin[i] : self.begin[i + 1]] for i in np.unique(ids)]
            if used:
                texts[np.unique(np.concatenate(used))] += 1
        return texts >= self.s.min_texts

    def _gather(self, rows: np.ndarray):
        words, where = np.unique(rows, return_inverse=True)
        where = where.reshape(rows.shape)
        real = words >= 0
        used = words[real]
        lengths = self.counts[used]
        flat = np.repeat(self.begin[used] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        subs = self.subs[flat]
        vectors = np.zeros((len(words), self.s.width), np.float32)
        if len(used):
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            vectors[real] = np.add.reduceat(self.vectors[subs], starts, axis=0) / lengths[:, None]
        return where, vectors, real, subs, lengths

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """Toxic against not, per window."""
        out = np.empty(len(rows), np.float32)
        step = self.s.batch
        for at in range(0, len(rows), step):
            where, vectors, *_ = self._gather(rows[at : at + step])
            mean = vectors[where].sum(axis=1) / self.s.window
            both = mean @ self.softmax + self.bias
            out[at : at + step] = both[:, 1] - both[:, 0]
        return out

    def _step(self, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        where, vectors, real, subs, lengths = self._gather(rows)
        mean = vectors[where].sum(axis=1) / self.s.window
        both = mean @ self.softmax + self.bias
        both -= both.max(axis=1, keepdims=True)
        share = np.exp(both)
        share /= share.sum(axis=1, keepdims=True)
        share[np.arange(len(rows)), labels] -= 1
        share *= weights[:, None]
        on_mean = (share @ self.softmax.T / self.s.window).astype(np.float32)
        on_words = np.empty_like(vectors)
        flat = where.ravel()
        spread = np.repeat(on_mean, rows.shape[1], axis=0)
        for d in range(self.s.width):
            on_words[:, d] = np.bincount(flat, spread[:, d], len(vectors))
        per_sub = np.repeat(on_words[real] / lengths[:, None], lengths, axis=0)
        on_vectors = np.empty_like(self.vectors)
        for d in range(self.s.width):
            on_vectors[:, d] = np.bincount(subs, per_sub[:, d], self.s.buckets)
        grads = (on_vectors, (mean.T @ share).astype(np.float32), share.sum(axis=0).astype(np.float32))
        for value, total, grad in zip((self.vectors, self.softmax, self.bias), self.sums, grads, strict=True):
            total += grad * grad
            value -= self.s.rate * grad / np.sqrt(total)
        self.vectors[~self.common] = 0

    def worst(self) -> np.ndarray:
        """The highest window logit of each text."""
        out = np.full(len(self.toxic), -np.inf, np.float32)
        np.maximum.at(out, self.owner, self.logits(self.windows))
        return out

    def run(self) -> None:
        self.softmax[:] = self.rng.normal(0, 0.3, self.softmax.shape)
        labels = self.toxic[self.owner]
        for epoch in range(self.s.epochs):
            chosen = np.arange(len(self.windows))
            if epoch > 1:
                scores = self.logits(self.windows)
                top = np.full(len(self.toxic), -np.inf, np.float32)
                np.maximum.at(top, self.owner, scores)
                # Of the others, those that are mistaken or nearly so, and a tenth of all.
                close = (scores > -3) | (self.rng.random(len(scores)) < 0.1)
                chosen = np.flatnonzero(np.where(labels == 1, scores >= top[self.owner], close))
            self.rng.shuffle(chosen)
            share = max(labels[chosen].mean(), 1e-6)
            # Both classes pull alike, however rare toxic windows are.
            balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - min(share, 1 - 1e-6))).astype(np.float32)
            # Small samples are cut finer, so that they get enough steps too.
            size = min(self.s.batch, max(64, len(chosen) // self.s.least_steps))
            for at in range(0, len(chosen), size):
                part = chosen[at : at + size]
                self._step(self.windows[part], labels[part], balance[part])


@dataclass(frozen=True)
class Model:
    """What tasks need: a number per bucket, and the step from logits to probabilities."""

    per_bucket: np.ndarray
    bias: float
    slope: float
    offset: float
    settings: Settings

    def scorer(self):
        """A function from texts to scores, with a bounded memory of words."""
        s = self.settings
        known: dict[str, float] = {}

        def learn(words: list[str]) -> None:
            some, size = [], 0
            for word in words:
                if len(word) > LONGEST:
                    known[word] = long_word_mean(word.strip(MARKS), self.per_bucket)
                    continue
                if size + len(word) > LONGEST:
                    learn_some(some)
                    some, size = [], 0
                some.append(word)
                size += len(word)
            if some:
                learn_some(some)

        def learn_some(words: list[str]) -> None:
            subs, counts = subwords([w.strip(MARKS) for w in words], s.buckets)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            values = np.add.reduceat(self.per_bucket[subs], starts) / counts
            known.update(zip(words, values.tolist(), strict=True))

        def score(text: str) -> float:
            found = tokens(text)
            if new := [w for w in set(found) if w not in known]:
                if len(known) > 300_000:
                    known.clear()
                    new = list(set(found))
                learn(new)
            values = np.fromiter(map(known.__getitem__, found), np.float64, len(found))
            if len(values) > s.window:
                sums = np.cumsum(values)
                sums[s.window :] -= sums[: -s.window].copy()
                top = float(sums[s.window - 1 :].max())
            else:
                top = float(values.sum())
            logit = self.slope * (top / s.window + self.bias) + self.offset
            return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))

        return score


def _calibrated(worst: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with softened labels (Platt), by Newton's method."""
    up, down = toxic.sum(), len(toxic) - toxic.sum()
    goal = np.where(toxic == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([worst.astype(float), np.ones(len(worst))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - goal) + 1e-3 * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return float(beta[0]), float(beta[1])


def fit(texts: list[str], toxic: np.ndarray, settings: Settings) -> Model:
    """Train on texts and their classes."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < share < 1:
        rest = np.zeros(settings.buckets, np.float32)
        odds = 500.0 if share else -500.0
        return Model(rest, 0.0, 0.0, odds, settings)
    trainer = _Trainer(texts, toxic, settings)
    trainer.run()
    slope, offset = _calibrated(trainer.worst(), toxic)
    turn = trainer.softmax[:, 1] - trainer.softmax[:, 0]
    return Model(
        trainer.vectors @ turn, float(trainer.bias[1] - trainer.bias[0]), slope, offset, settings
    )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Fit on the bounded sample of labelled documents that are not held out."""
    s = settings or Settings()
    usable = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .withColumn("draw", F.xxhash64("doc_id", F.lit(s.seed)))
    )
    drawn = [
        usable.where(F.col("toxic") == toxic).orderBy("draw", "doc_id").limit(rows)
        for toxic, rows in ((True, s.toxic_rows), (False, s.clean_rows))
    ]
    sample = stored(drawn[0].unionByName(drawn[1]).select("doc_id", "toxic"), "toxic_sample")
    rows = (
        docs.select("doc_id", text_of().alias("text"))
        .where(F.char_length("text") <= s.longest_text)
        .join(sample, "doc_id")
        .dropDuplicates(["doc_id", "text"])
        .orderBy("doc_id", "text")
        .limit(2 * (s.toxic_rows + s.clean_rows))
        .toArrow()
    )
    texts, toxic = rows["text"].to_pylist(), rows["toxic"].to_numpy().astype(np.int64)
    del rows
    pa.default_memory_pool().release_unused()
    return fit(texts, toxic, s)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            scores = [of(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= model.settings.threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents below the threshold, with all columns they came with."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            keep = [of(text.as_py() or "") < model.settings.threshold for text in batch.column(names.index("text"))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
