"""Toxicity by class-conditional Kneser-Ney models.

An expression is spelt out: a word's letters are predicted one after the other
from the ORDER-1 before them (no further back than the word's start). The top
order has counts of its own for each class, toxic and ordinary, from labelled
documents. All lower orders share one set of backoff counts, in which each
distinct word of a block of text counts once however often it stands there
(Kneser-Ney's counting of types); they are gathered from the whole corpus.
Rare expressions therefore get nearly the same likelihood from both models,
and only what a class has in common tells the classes apart.

A toxic document is mostly ordinary prose, so its model is a mixture: a word is
toxic with probability MIXED and ordinary else. A document's evidence is the
difference between the log-likelihoods of its distinct words under the mixture
and under the ordinary model, over the square root of their number; a logistic
curve, fitted on labelled documents that the counts have not seen, turns it
into a score.

Class counts come from all labelled documents. Only the curve is fitted on a
bounded part of them (CURVE_PART of the ``sample`` ids with the smallest hash,
alike at every size), with counts that leave that part out; the counts that
score documents hold it too.
All tables are hashed into fixed numbers of buckets (SHARED_BITS, CLASS_BITS),
so the model that tasks receive has one size for any corpus.

Rows: a null or empty text has no words and scores as the prior (the curve at
zero evidence); repeated rows score alike; labels that are null, or not 0 or 1,
are not learnt from, and an id with two labels counts with the larger. With no
label of one class every score is 0.0 (only ordinary) or 1.0 (only toxic), or
0.0 with no labels at all. Extra columns are carried, ``toxicity`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.scratch import Scratch
from tradestar.llm.textblocks import U64, Powers, RollingHash, blocks, mix, words

ORDER = 7
DISCOUNT = 0.75
SHARED_BITS = 18
CLASS_BITS = 20
SAMPLE = 16_000
MIXED = 0.01
#: Bytes of text in which a word counts as one type.
BLOCK = 4 << 20
THRESHOLD = 0.3
#: The part of the sample (by hash, of 5) that fits the curve.
CURVE_PART = 0
#: Labels of rows outside the curve's part and (plus 2) inside.
GROUPS = 4
#: Letters of distinct words that a task holds before it counts their grams.
HELD = 4_000_000
#: Bytes of text hashed, and letters spelt out, at a time: arrays of this length
#: stay in a core's cache.
PIECE = 1 << 18
SPELT = 1 << 15
#: Bits of the table of words whose evidence a task remembers.
KNOWN_BITS = 19
#: Bits of the filter that keeps texts without a label out of the shuffle.
FILTER_BITS = 1 << 26

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits and every byte of a letter beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _word_hashes(data: np.ndarray, off: np.ndarray, powers: Powers):
    """Lower-cased bytes; start, end, document and hash of each word."""
    low = _LOWER[data]
    parts, i = [], 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + PIECE, "right")) - 1)
        text = low[off[i]:off[j]]
        start, end, doc = words(text, off[i:j + 1] - off[i], _WORD)
        parts.append((start + off[i], end + off[i], doc + i, RollingHash(text, powers).spans(start, end)))
        i = j
    return low, *(np.concatenate(x) for x in zip(*parts, strict=True))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in the order of their first places, those places, and
    where each key stands among the distinct ones."""
    coded = pa.array(keys).dictionary_encode()
    of = coded.indices.to_numpy()
    first = np.flatnonzero(_heads(np.maximum.accumulate(of)))
    return coded.dictionary.to_numpy(), first, of


def _heads(a: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before; the first does."""
    return np.concatenate([[True], a[1:] != a[:-1]])


def _spelt(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words laid out as `` word word ``: bytes, place of each word's first
    letter, letters of each word with its closing space."""
    n = end - start + 1
    first = np.cumsum(n) - n + 1  # behind the leading space
    out = np.empty(int(n.sum()) + 1, np.uint8)
    np.take(low, np.repeat(start - first, n) + np.arange(1, len(out)), mode="clip", out=out[1:])
    out[0] = out[first + n - 1] = 32
    return out, first, n


class Grams:
    """Hashes of the letters up to each place, for every order."""

    def __init__(self, low, start, end, powers: Powers) -> None:
        self.text, first, self.n = _spelt(low, start, end)
        self.begin = first - 1
        self.depth = np.arange(1, len(self.text)) - np.repeat(self.begin, self.n)
        self.hash = RollingHash(self.text, powers)
        self.follower = (self.text[1:] * np.uint8(37)) & np.uint8(31)

    def __len__(self) -> int:
        return len(self.depth)

    def orders(self):
        """(k, grams of order k, what stands before the place in them). Where a
        word is shorter the gram is that of the order below; what stands before
        a place is what the order below has at the place before."""
        gram, before = None, np.zeros(len(self), U64)
        single = self.hash.grams(1)
        for k in range(1, ORDER + 1):
            if k == 1:
                here = single[1:]
            else:
                before = np.empty_like(gram)
                before[1:] = gram[:-1]
                before[self.begin] = single[0]  # the space before the word
                here = gram.copy()
                np.copyto(here[k - 2:], self.hash.grams(k), where=self.depth[k - 2:] >= k - 1)
            gram = here
            yield k, gram, before


def _spelt_out(low: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers):
    """(first word, last word, grams) of stretches of about SPELT letters."""
    upto = np.cumsum(end - start + 1)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SPELT, "right")))
        yield i, j, Grams(low, start[i:j], end[i:j], powers)
        i = j


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> U64(64 - bits)).astype(np.int64)


class Held:
    """Distinct words of several blocks: keys, letters, and how often each counts."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, key, times, group, low, start, end) -> None:
        n = end - start
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        self.parts.append((key, times, group, n, low[at]))
        self.size += len(at) + len(n)

    def merged(self) -> tuple[np.ndarray, ...]:
        """The words with their times summed; they stay held as one part."""
        key, times, group, n, low = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        if len(self.parts) > 1:
            key, one, of = _distinct(key)
            start = (np.cumsum(n) - n)[one]
            times = np.bincount(of, times).astype(np.int64)
            self.parts, self.size = [], 0
            self.add(key, times, group[one], low, start, start + n[one])
            key, times, group, n, low = self.parts[0]
        end = np.cumsum(n)
        return times, group, low, end - n, end


def _held(batches, powers: Powers, grouped: bool):
    """(times, group, bytes, start, end) of distinct words, handed on when HELD is
    reached. A word's times are the blocks that it stands in or, where the rows
    have labels, its places under each."""
    held = Held()
    for b in batches:
        label = b.column("label").to_numpy(zero_copy_only=False).astype(np.int64) if grouped else None
        for i, _, data, off in blocks(b.column("body"), BLOCK):
            low, start, end, doc, h = _word_hashes(data, off, powers)
            if not len(h):
                continue
            of = label[i + doc] if grouped else np.zeros(len(h), np.int64)
            key, one, at = _distinct(h ^ mix(of.astype(U64)) if grouped else h)
            times = np.bincount(at) if grouped else np.ones(len(key), np.int64)
            held.add(key, times, of[one], low, start[one], end[one])
            if held.size > HELD:
                out = held.merged()
                if held.size > HELD // 2:
                    yield out
                    held = Held()
    if held.parts:
        yield held.merged()


def _shared_counts(batches):
    """(table, bucket, n, mask): type counts of grams and followers of contexts."""
    powers = Powers()
    n_of = np.zeros((ORDER - 1, 1 << SHARED_BITS), np.int64)
    mask_of = np.zeros((ORDER - 1, 1 << SHARED_BITS), np.uint32)
    for times, _, low, start, end in _held(batches, powers, False):
        for i, j, g in _spelt_out(low, start, end, powers):
            n = np.repeat(times[i:j], g.n)
            bit = np.uint32(1) << g.follower.astype(np.uint32)
            for k, gram, before in g.orders():
                if k < ORDER:
                    np.add.at(n_of[k - 1], _bucket(gram, SHARED_BITS), n)
                    np.bitwise_or.at(mask_of[k - 1], _bucket(before, SHARED_BITS), bit)
    for k in range(ORDER - 1):
        at = np.flatnonzero((n_of[k] > 0) | (mask_of[k] > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at + (k << SHARED_BITS)), pa.array(n_of[k][at]), pa.array(mask_of[k][at].astype(np.int64))],
            names=["slot", "n", "mask"])


def _class_counts(batches):
    """(slot, n, mask) of the top order; slots of contexts follow those of grams,
    those of a group the ones of the group before. A group is the label, plus 2 for
    rows that fit the curve. The counts are kept sparse and summed before a task
    hands them on."""
    powers = Powers()
    for times, group, low, start, end in _held(batches, powers, True):
        grams, contexts = [], []
        for i, j, g in _spelt_out(low, start, end, powers):
            *_, (_, gram, before) = g.orders()
            base, n = np.repeat(group[i:j] * (2 << CLASS_BITS), g.n), np.repeat(times[i:j], g.n)
            grams.append(_packed(base + _bucket(gram, CLASS_BITS), n, np.zeros_like(g.follower)))
            contexts.append(_packed(base + _bucket(before, CLASS_BITS) + (1 << CLASS_BITS), n, g.follower))
        slot, n, mask = _summed(np.concatenate(grams))
        yield from _rows(slot, n, np.zeros_like(mask))
        yield from _rows(*_summed(np.concatenate(contexts)))


def _packed(slot: np.ndarray, n: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """One number of each slot (23 bits), follower (5) and count (36)."""
    return (slot.astype(U64) << U64(41)) | (follower.astype(U64) << U64(36)) | n.astype(U64)


def _summed(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots in order, with the sum of n and the mask of followers."""
    packed = np.sort(packed)
    slot = (packed >> U64(41)).astype(np.int64)
    head = np.flatnonzero(_heads(slot))
    bit = np.int64(1) << ((packed >> U64(36)) & U64(31)).astype(np.int64)
    n = (packed & U64((1 << 36) - 1)).astype(np.int64)
    return slot[head], np.add.reduceat(n, head), np.bitwise_or.reduceat(bit, head)


def _rows(slot: np.ndarray, n: np.ndarray, mask: np.ndarray):
    for i in range(0, len(slot), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[i:i + (1 << 16)]) for x in (slot, n, mask)],
                                         names=["slot", "n", "mask"])


def _interpolated(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Kneser-Ney: discounted share of the count, the rest by the lower order."""
    total = np.maximum(total, n)
    safe = np.maximum(total, 1)
    spare = np.minimum(1.0, DISCOUNT * np.maximum(kinds, 1) / safe)
    return np.where(total > 0, np.maximum(n - DISCOUNT, 0) / safe + spare * lower, lower)


class Known:
    """Evidence of words that a task has met: one word to a place of a table of
    fixed size, the last one met."""

    def __init__(self) -> None:
        self.key = np.zeros(1 << KNOWN_BITS, U64)
        self.key[0] = ~U64(0)  # a key of another place: none is known yet
        self.value = np.zeros(1 << KNOWN_BITS)

    def look_up(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each key, and whether it is known."""
        at = _bucket(key, KNOWN_BITS)
        return self.value[at], self.key[at] == key

    def keep(self, key: np.ndarray, value: np.ndarray) -> None:
        at = _bucket(key, KNOWN_BITS)
        self.key[at] = key
        self.value[at] = value


@dataclass
class Model:
    """Tables of fixed size and the curve (slope, intercept)."""

    shared_n: np.ndarray
    shared_kinds: np.ndarray
    class_n: np.ndarray
    class_kinds: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)

    def letters(self, g: Grams) -> np.ndarray:
        """log P(letter | toxic) - log P(letter | ordinary) at each place."""
        p = np.full(len(g), 1 / 256)
        for k, gram, before in g.orders():
            if k == ORDER:
                break
            ctx = _bucket(before, SHARED_BITS)
            if k == 1:
                total = np.full(len(g), self.shared_n[0].sum())
            else:  # what the order below counted at the place before
                total = np.empty_like(n)
                total[1:] = n[:-1]
                total[g.begin] = self.shared_n[k - 2][ctx[0]]
            n = self.shared_n[k - 1][_bucket(gram, SHARED_BITS)]
            p = _interpolated(n, total, self.shared_kinds[k - 1][ctx], p)
        gram, ctx = _bucket(gram, CLASS_BITS), _bucket(before, CLASS_BITS)
        ordinary, toxic = (np.log(np.maximum(1e-12, _interpolated(
            self.class_n[c][gram], self.class_n[c][ctx + (1 << CLASS_BITS)], self.class_kinds[c][ctx], p)))
            for c in (0, 1))
        return toxic - ordinary

    def of_words(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
        """Evidence of each word."""
        out = np.empty(len(start))
        for i, j, g in _spelt_out(low, start, end, powers):
            out[i:j] = np.add.reduceat(self.letters(g), g.begin)
        return np.log(1 - MIXED + MIXED * np.exp(np.minimum(out, 20.0)))

    def evidence(self, data: np.ndarray, off: np.ndarray, powers: Powers, known: Known) -> np.ndarray:
        """Length-normalised evidence of each document of a block."""
        count = len(off) - 1
        low, start, end, doc, h = _word_hashes(data, off, powers)
        if not len(h):
            return np.zeros(count)
        key, one, word = _distinct(h)
        by_word, there = known.look_up(key)
        new = one[~there]
        by_word[~there] = self.of_words(low, start[new], end[new], powers)
        known.keep(key[~there], by_word[~there])
        pairs = np.sort((doc.astype(U64) << U64(32)) | word.astype(U64))
        pairs = pairs[_heads(pairs)]
        of = (pairs >> U64(32)).astype(np.int64)
        total = np.bincount(of, by_word[(pairs & U64(0xFFFFFFFF)).astype(np.int64)], minlength=count)
        return total / np.sqrt(np.maximum(1, np.bincount(of, minlength=count)))

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * evidence + self.curve[1], -700, 700)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton's method with a weak prior on the slope."""
    if not len(y) or y.min() == y.max():
        return 0.0, (700.0 if len(y) and y[0] else -700.0)
    a = np.stack([x, np.ones(len(x))], 1)
    w = np.array([1.0, np.log(y.mean() / (1 - y.mean()))])
    prior = np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + prior, a.T @ (p - y) + prior @ w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _evidence(model, columns: tuple[str, ...], scored: bool):
    def run(batches):
        powers, known, m = Powers(), Known(), model.value
        for b in batches:
            out = [m.evidence(data, off, powers, known) for _, _, data, off in blocks(b.column("body"), BLOCK)]
            x = np.concatenate(out) if out else np.zeros(0)
            cols = [b.column(c) for c in columns]
            if scored:
                score = m.scores(x)
                tox = pa.StructArray.from_arrays(
                    [pa.array(x), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    names=["evidence", "score", "predicted"])
                yield pa.RecordBatch.from_arrays([*cols, tox], names=[*columns, "toxicity"])
            else:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(x)], names=[*columns, "x"])
    return run


def _labelled(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``docs`` joined to the labels. Texts without a label must not be shuffled
    for that: a bitmap of the labelled ids' hashes, whose size is fixed, keeps
    nearly all of them out at any ratio of labels to bits that matters, and the
    join, the same at every size, removes those that it lets through."""
    # as text: equal ids of two integer types have different hashes
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(FILTER_BITS))
    bits = marked.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.getbit(byte, (bit % 8).cast("int")) == 1
    # at most FILTER_BITS / 8 bytes
    near = docs.withColumn("bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "bucket").filter(there)
    return near.drop("bucket", "bits").join(marked.hint("merge"), "id")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", learn: Column | None = None, sample: int = SAMPLE) -> Model:
    """Counts over all of ``docs``, classes from ``labels`` (rows where
    ``learn``, a condition on the labels' id, holds)."""
    spark = docs.sparkSession
    work = Scratch(spark)
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "label in (0, 1) and id is not null")
    if learn is not None:
        marked = marked.filter(learn)
    marked = marked.groupBy("id").agg(F.max("label").alias("label"))
    body = F.col(text_col).alias("body")
    part = F.pmod(F.xxhash64(F.lit("curve"), "id"), F.lit(5)) == CURVE_PART
    # the sample's bound is the bound of what is broadcast
    chosen = F.broadcast(marked.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", part.alias("curve")))
    marked = work.stored(marked.join(chosen, "id", "left").withColumn(
        "curve", F.coalesce("curve", F.lit(False))), "marked")
    train = work.stored(_labelled(docs.select(F.col(id_col).alias("id"), body), marked)
                        .select("body", "label", "curve"), "labelled")

    def counted(rows: DataFrame, by, name: str) -> pa.Table:
        return work.stored(rows.mapInArrow(by, "slot long, n long, mask long").groupBy("slot").agg(
            F.sum("n").alias("n"), F.bit_or("mask").alias("mask")), name).toArrow()

    shared = counted(docs.select(body), _shared_counts, "shared")
    classes = counted(train.select("body", (F.col("label") + 2 * F.col("curve").cast("int")).alias("label")),
                      _class_counts, "classes")

    def filled(table: pa.Table, column: str, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        out[table.column("slot").to_numpy()] = table.column(column).to_numpy()
        return out

    def narrow(a: np.ndarray) -> np.ndarray:
        """In the smallest type that holds all values."""
        return a.astype(np.min_scalar_type(a.max()))

    size = (ORDER - 1) << SHARED_BITS
    n = filled(classes, "n", GROUPS * (2 << CLASS_BITS)).reshape(GROUPS, -1)
    mask = filled(classes, "mask", GROUPS * (2 << CLASS_BITS)).reshape(GROUPS, -1)[:, 1 << CLASS_BITS:]
    shared_n = narrow(filled(shared, "n", size).reshape(ORDER - 1, -1))
    shared_kinds = np.bitwise_count(filled(shared, "mask", size)).reshape(ORDER - 1, -1)
    outside = Model(shared_n, shared_kinds, narrow(n[:2]), np.bitwise_count(mask[:2]))
    model = Model(shared_n, shared_kinds, narrow(n[:2] + n[2:]), np.bitwise_count(mask[:2] | mask[2:]))

    def placed(rows: DataFrame, by: Model) -> tuple[np.ndarray, np.ndarray]:
        shipped = spark.sparkContext.broadcast(by)
        held = rows.mapInArrow(_evidence(shipped, ("label",), False), "label int, x double").toArrow()
        shipped.destroy()
        return held.column("x").to_numpy(), held.column("label").to_numpy()

    x, y = placed(train.filter("curve"), outside)
    if not len(y) or y.min() == y.max():  # too few rows for a part of their own
        x, y = placed(train, model)
    model.curve = _curve(x, y)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) plus ``toxicity`` =
    struct(evidence, score, predicted)."""
    keep = [c for c in docs.columns if c != "toxicity"] if carry is None else carry
    src = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).alias("body"))
    out = T.StructType([T.StructField("evidence", T.DoubleType()), T.StructField("score", T.DoubleType()),
                        T.StructField("predicted", T.IntegerType())])
    schema = T.StructType([src.schema["row"], T.StructField("toxicity", out)])
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return src.mapInArrow(_evidence(shipped, ("row",), True), schema).select("row.*", "toxicity")
