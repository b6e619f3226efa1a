"""Quality of a text from random-indexing word vectors, pooled and classified by a small network.

Vectors: a token is a run of letters and digits, or of other visible signs; it falls into one of BUCKETS by
its hash. Each token has a random index vector of a few signs, and a bucket's vector is the sum of the index
vectors of what stands next to its tokens anywhere in the corpus, scaled to length one. These sums are
whole numbers, gathered over all documents: a table of fixed size a task, added up in two shuffles. Pooling
takes the mean of a text's vectors, and with it the length of that mean, the text's size, and how many of
its tokens are distinct. A network of two layers is fitted on a bounded sample of labelled rows, and its
temperature on a part of them that it has not seen, so that scores are probabilities.

Decided cases: a null text is empty; a text without tokens has the zero vector and gets a score like any
other. Without labels, or with one kind only, every score is the smoothed share of label 1. Rows without a
doc_id are scored but never held out. Rows are scored singly, so repeated rows get equal results. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import arrow
from .hashing import BASES, BYTE_UNITS, CHUNK, Rolling, groups, mix
from .labels import SAMPLE, held_out, sample
from .workspace import ship

BUCKETS, DIMENSIONS, SIGNS, REACH = 1 << 14, 32, 2, 2
HIDDEN, TURNS, RATE, BATCH, DECAY, SEED = 32, 30, 0.003, 128, 1e-4, 42
_BLOCK_ROWS, _SALTS = 256, 16

#: 0 for blanks and controls, 1 for letters, digits and all beyond ASCII, 2 for other visible signs.
_KIND = np.full(256, 1, dtype=np.int8)
_KIND[:0x80] = [0 if c < 0x21 or c == 0x7F else 1 if chr(c).isalnum() else 2 for c in range(0x80)]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text number of each token, and each text's first token; texts end to end."""
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    kind = _KIND[data]
    change = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))
    ends = np.r_[change[1:], len(data)] if len(change) else change
    real = kind[change] > 0
    starts, ends = change[real], ends[real]
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):  # by stretches, so that no array is longer than a chunk or a token
        begin = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, begin + CHUNK, side="right")))
        rolling = Rolling(BYTE_UNITS[data[begin : int(ends[upto - 1])]], BASES[0])
        hashes[at:upto] = rolling.of(starts[at:upto] - begin, ends[at:upto] - begin)
        at = upto
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    first = np.searchsorted(starts, begins)
    return hashes, np.searchsorted(begins, starts, side="right") - 1, first


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _signs(hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The index vector of each token: places and signs."""
    out = []
    for turn in range(SIGNS):
        x = mix(hashes + np.uint64(turn + 1))
        out.append(((x % np.uint64(DIMENSIONS)).astype(np.int64), 1.0 - 2.0 * (x >> np.uint64(63)).astype(np.float64)))
    return out


def _neighbour_sums(texts: list[bytes]) -> np.ndarray:
    hashes, owner, _ = tokens(texts)
    bucket, out = _bucket(hashes), np.zeros(BUCKETS * DIMENSIONS)
    signs = _signs(hashes)
    for gap in range(1, REACH + 1):
        near = np.flatnonzero(owner[gap:] == owner[:-gap])
        for here, there in ((near, near + gap), (near + gap, near)):
            for place, sign in signs:
                out += np.bincount(bucket[here] * DIMENSIONS + place[there], weights=sign[there], minlength=len(out))
    return out


def word_vectors(documents: DataFrame) -> np.ndarray:
    """The vectors of all buckets, from the neighbours of every token of the corpus."""
    ship(documents.sparkSession)
    row = _BLOCK_ROWS * DIMENSIONS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * DIMENSIONS)
        for rows in batches:
            texts = arrow.bytes_of(rows, "text")
            for low, high in groups([len(t) for t in texts], 4 * CHUNK):
                total += _neighbour_sums(texts[low:high])
        yield _blocks({i: total[i * row : (i + 1) * row].astype(np.int64) for i in range(len(total) // row)})

    def _blocks(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())
        return arrow.batch(block=pa.array(list(sums), pa.int64()), sums=values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for block, values in zip(rows.column("block").to_pylist(), rows.column("sums").to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(values, dtype="<i8")
        yield _blocks(sums)

    schema = "block long, sums binary"
    parts = documents.select("text").mapInArrow(count, schema).withColumn("salt", F.spark_partition_id() % _SALTS)
    some = parts.repartition("block", "salt").select("block", "sums").mapInArrow(add, schema)
    added = some.repartition("block").mapInArrow(add, schema).collect()  # BUCKETS x DIMENSIONS numbers, whatever the corpus
    out = np.zeros((BUCKETS, DIMENSIONS))
    for block, sums in added:
        out[block * _BLOCK_ROWS : (block + 1) * _BLOCK_ROWS] = np.frombuffer(sums, dtype="<i8").reshape(_BLOCK_ROWS, DIMENSIONS)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """A row a text: the mean vector, its length, the log number of tokens, and the share of distinct ones."""
    hashes, owner, first = tokens(texts)
    n = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), dtype=np.int64)
    mean = np.zeros((len(texts), DIMENSIONS))
    full = np.flatnonzero(n)
    if len(full):
        mean[full] = np.add.reduceat(vectors[_bucket(hashes)], first[full], axis=0) / n[full, None]
    order = np.lexsort((hashes, owner))
    again = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeats = np.bincount(owner[order][1:][again], minlength=len(texts)) if again.any() else np.zeros(len(texts))
    distinct = 1 - repeats / np.maximum(n, 1)
    return np.column_stack([mean, np.linalg.norm(mean, axis=1), np.log1p(n), distinct])


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one logit over a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0

    @staticmethod
    def _wide(x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.ones(len(x))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(self._wide((x - self.centre) / self.scale) @ self.first)
        return self._wide(hidden) @ self.second

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the log loss; a tenth of the rows only sets the temperature."""
    width = x.shape[1] if x.ndim == 2 else DIMENSIONS + 3
    constant = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if len(set(y.tolist())) < 2:
        second = np.zeros(HIDDEN + 1)
        second[-1] = constant
        return Network(np.zeros(width), np.ones(width), np.zeros((width + 1, HIDDEN)), second)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    kept = max(1, len(y) // 10)
    aside, used = order[:kept], order[kept:]
    net = Network(
        x[used].mean(axis=0), x[used].std(axis=0) + 1e-6,
        rng.normal(0, 1 / np.sqrt(width), (width + 1, HIDDEN)), np.r_[rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), constant])
    parts = [net.first, net.second]
    speed, size, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(TURNS):
        rows = rng.permutation(used)
        for low in range(0, len(rows), BATCH):
            some = rows[low : low + BATCH]
            wide = net._wide((x[some] - net.centre) / net.scale)
            hidden = net._wide(np.tanh(wide @ net.first))
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.second, -30, 30))) - y[some]) / len(some)
            back = np.outer(error, net.second[:-1]) * (1 - hidden[:, :-1] ** 2)
            step += 1
            for i, gradient in enumerate((wide.T @ back, hidden.T @ error)):
                gradient = gradient + DECAY * parts[i]
                speed[i] = 0.9 * speed[i] + 0.1 * gradient
                size[i] = 0.999 * size[i] + 0.001 * gradient**2
                parts[i] -= RATE * speed[i] / (1 - 0.9**step) / (np.sqrt(size[i] / (1 - 0.999**step)) + 1e-8)
    logits = net.logits(x[aside])
    net.temperature = min((_loss(logits / t, y[aside]), t) for t in np.geomspace(0.25, 8, 41))[1]
    return net


def _pool(documents: DataFrame, vectors, columns: str, schema: str, finish) -> DataFrame:
    """Runs ``finish`` on the pooled vectors of each batch; ``columns``: what else it gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = arrow.bytes_of(rows, "text")
            for low, high in groups([len(t) for t in texts], 4 * CHUNK):
                yield finish(rows.slice(low, high - low), pooled(texts[low:high], vectors.value))

    return documents.select(*columns.split(), "text").mapInArrow(run, schema)


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held: int = 1, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted. ``most``: labelled rows that the network is fitted to."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vectors = spark.sparkContext.broadcast(word_vectors(docs))
    marked = docs.join(F.broadcast(sample(labels, label, folds, held, most)), "doc_id")

    def features(rows: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return arrow.batch(doc_id=rows.column("doc_id"), label=rows.column("label"), x=pa.array(list(x), pa.list_(pa.float64())))

    learned = _pool(marked, vectors, "doc_id label", "doc_id long, label int, x array<double>", features).collect()
    learned.sort(key=lambda r: (r.doc_id, r.label, r.x))
    network = train(np.array([r.x for r in learned]), np.array([r.label for r in learned], dtype=float))

    def score(rows: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return arrow.batch(doc_id=rows.column("doc_id"), score=network.scores(x))

    scored = _pool(docs, vectors, "doc_id", "doc_id long, score double", score)
    return scored.select("doc_id", held_out(folds, held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
