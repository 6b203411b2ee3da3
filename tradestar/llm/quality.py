"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Every word has a sparse random index vector; a word's own vector is the sum of
the index vectors of the words around it, over the whole corpus. Beside the
words, runs of symbols are words too, a word in capitals is the word CAPITALS
and a word that repeats the one before it is the word REPEAT, so that layout
and litter have contexts as language has. A document is the mean of its words'
unit vectors. A two-layer numpy network, trained on labelled documents, scores
the pooled vectors; a temperature, fitted on documents the training has not
seen, calibrates its probabilities.

Bounds: words are hashed into WORDS buckets of DIM numbers, so the table of
word vectors has one size for any corpus, and workers hand on partial sums of
it. The network is trained on at most ``sample`` labelled documents (those with
the smallest hash of their id, alike at every size); the word vectors count all
documents.

Rows: a null or empty text pools to the zero vector and gets the network's
score for it; repeated rows score alike; labels that are null, or not 0 or 1,
are not learnt from, and an id with two labels counts with the larger. If the
labels have one class only, every score is that class, and 0.0 without labels.
Extra columns are carried, ``quality`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.scratch import Scratch
from tradestar.llm.textblocks import SPACES, U64, Powers, RollingHash, blocks, mix, words

WORDS, DIM, NONZERO, WINDOW = 1 << 14, 64, 4, 2
SLICE = 256
SAMPLE = 12_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
THRESHOLD = 0.3
CAPITALS, REPEAT, RESERVED = 0, 1, 2

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SYMBOL = ~_LETTER & ~SPACES


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each word's nonzero entries."""
    h = mix(np.arange(WORDS * NONZERO, dtype=U64) + U64(77)).reshape(WORDS, NONZERO)
    return (h % U64(DIM)).astype(np.int64), np.where(h >> U64(63), 1.0, -1.0)


def _tokens(data: np.ndarray, off: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each word and run of symbols, in order."""
    h = RollingHash(data, powers)
    low = np.concatenate([[0], np.cumsum((data >= 97) & (data < 123))])
    cap = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    s1, e1, d1 = words(data, off, _LETTER)
    s2, e2, d2 = words(data, off, _SYMBOL)
    hashes = h.spans(s1, e1)
    word = (RESERVED + hashes % U64(WORDS - RESERVED)).astype(np.int64)
    word[(cap[e1] - cap[s1] >= 2) & (low[e1] == low[s1])] = CAPITALS
    if len(s1):
        again = np.zeros(len(s1), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (d1[1:] == d1[:-1])
        word[again] = REPEAT
    symbol = (RESERVED + mix(h.spans(s2, e2)) % U64(WORDS - RESERVED)).astype(np.int64)
    order = np.argsort(np.concatenate([s1, s2]), kind="stable")
    return np.concatenate([word, symbol])[order], np.concatenate([d1, d2])[order]


def _contexts(batches):
    """Partial sums of word vectors, as slices of SLICE words."""
    places, signs = _index_vectors()
    powers, total = Powers(), np.zeros(WORDS * DIM)
    for b in batches:
        for _, _, data, off in blocks(b.column("body")):
            word, doc = _tokens(data, off, powers)
            for d in range(1, WINDOW + 1):
                near = doc[d:] == doc[:-d]
                a, z = word[:-d][near], word[d:][near]
                for at, other in ((a, z), (z, a)):
                    for j in range(NONZERO):
                        np.add.at(total, at * DIM + places[other, j], signs[other, j])
    yield from _slices(total)


def _slices(total: np.ndarray):
    rows = total.astype("<f8").reshape(-1, SLICE * DIM)
    used = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([rows[k].tobytes() for k in used.tolist()], pa.binary())],
        names=["slice", "sums"])


def _added(batches):
    total = np.zeros((WORDS // SLICE, SLICE * DIM))
    for b in batches:
        for k, raw in zip(b.column("slice").to_pylist(), b.column("sums").to_pylist(), strict=True):
            total[k] += np.frombuffer(raw, "<f8")
    yield from _slices(total.ravel())


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors of all words, from every document."""
    parts = docs.select(F.col(text_col).alias("body")).mapInArrow(_contexts, "slice int, sums binary")
    # one row for each slice and worker; each slice is summed where it lands
    summed = parts.repartition("slice").mapInArrow(_added, "slice int, sums binary").toArrow()
    out = np.zeros((WORDS // SLICE, SLICE * DIM))
    for k, raw in zip(summed.column("slice").to_pylist(), summed.column("sums").to_pylist(), strict=True):
        out[k] += np.frombuffer(raw, "<f8")
    out = out.reshape(WORDS, DIM)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(vectors: np.ndarray, data: np.ndarray, off: np.ndarray, powers: Powers) -> np.ndarray:
    """Mean word vector of each document of a block."""
    count = len(off) - 1
    out = np.zeros((count, DIM), np.float32)
    word, doc = _tokens(data, off, powers)
    for a in range(0, len(word), 1 << 17):
        w, d = word[a:a + (1 << 17)], doc[a:a + (1 << 17)]
        head = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        np.add.at(out, d[head], np.add.reduceat(vectors[w], head, axis=0))
    return out / np.maximum(1, np.bincount(doc, minlength=count))[:, None].astype(np.float32)


def _pooled(shipped):
    @F.arrow_udf("binary")
    def run(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        powers, vectors = Powers(), shipped.value
        for body in bodies:
            out = [pool(vectors, data, off, powers) for _, _, data, off in blocks(body)]
            yield pa.array([row.tobytes() for part in out for row in part.astype("<f4")], pa.binary())
    return run


@dataclass
class Network:
    """tanh layer and logit; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    constant: float | None = field(default=None)

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -700, 700)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Adam on the cross-entropy of four fifths; the rest sets the temperature."""
    rng = np.random.default_rng(seed)
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(DIM), np.ones(DIM))
    net = Network(mean, scale, rng.normal(0, DIM ** -0.5, (DIM, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0)
    if not len(y) or y.min() == y.max():
        net.constant = float(y[0]) if len(y) else 0.0
        return net
    aside = rng.random(len(y)) < 0.2
    if len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    fit_x, fit_y = (x[~aside] - mean) / scale, y[~aside].astype(float)
    net.b2 = float(np.log(fit_y.mean() / (1 - fit_y.mean())))
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(fit_y))
        for a in range(0, len(order), BATCH):
            k = order[a:a + BATCH]
            hidden = np.tanh(fit_x[k] @ params[0] + params[1])
            wrong = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - fit_y[k]) / len(k)
            back = np.outer(wrong, params[2]) * (1 - hidden ** 2)
            grads = [fit_x[k].T @ back + DECAY * params[0], back.sum(axis=0),
                     hidden.T @ wrong + DECAY * params[2], np.array([wrong.sum()])]
            t += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    net.b2 = float(params[3][0])
    if aside.any():
        z, target = net.logits(x[aside]), y[aside]
        loss = lambda temp: np.logaddexp(0, np.where(target == 1, -z, z) / temp).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 81), key=loss))
    return net


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", learn: Column | None = None, sample: int = SAMPLE,
          carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) plus ``quality`` =
    struct(score, predicted). ``learn`` is a condition on the labels' ``id``."""
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != "quality"] if carry is None else carry
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text_col))
    src = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(id_col).alias("id"),
                      F.col(text_col).alias("body"))
    # only the text goes to Python; the rows wait for its vector in Spark
    pooled = Scratch(spark).stored(src.select("row", "id", _pooled(vectors)("body").alias("vector")), "pooled")
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "label in (0, 1) and id is not null")
    if learn is not None:
        marked = marked.filter(learn)
    chosen = (marked.groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    # an id may stand on several rows, so the sample is bounded once more; the
    # order makes the training's random numbers meet the same rows each time
    rows = (pooled.select("id", "vector").join(F.broadcast(chosen), "id")
            .orderBy(F.xxhash64("id"), "id", "vector").limit(sample).toArrow())
    x = np.frombuffer(b"".join(rows.column("vector").to_pylist()), "<f4").reshape(-1, DIM).astype(float)
    network = spark.sparkContext.broadcast(train(x, rows.column("label").to_numpy()))
    out = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    @F.arrow_udf(out)
    def scored(vector: pa.Array) -> pa.Array:
        raw = b"".join(vector.to_pylist())
        s = network.value.scores(np.frombuffer(raw, "<f4").reshape(-1, DIM).astype(float))
        return pa.StructArray.from_arrays(
            [pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["score", "predicted"])

    return pooled.select("row.*", scored("vector").alias("quality"))
