"""Held-out accuracy of the two classifiers, and their defined edge results."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tradestar.llm import queries, quality, toxicity
from tradestar.llm.textblocks import Powers

SF = "/root/testdata/sf0.1"


def area(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    p = label.sum()
    return (rank[label == 1].sum() - p * (p + 1) / 2) / (p * (len(label) - p))


@pytest.mark.parametrize("name,label,mod,part,least", [("op2_toxicity", "toxic", 4, 2, 0.95),
                                                       ("op7_quality", "quality", 5, 0, 0.99)])
def test_held_out(spark, name, label, mod, part, least):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % mod == part for i in got.doc_id]
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert area(held.score.to_numpy(), held[label].to_numpy()) > least
    assert (held.predicted == held[label]).mean() > least


def score(spark, which, docs, labels):
    if which == "toxicity":
        return toxicity.score(docs, toxicity.fit(docs, labels))
    return quality.score(docs, labels)


@pytest.mark.parametrize("which,label", [("toxicity", "toxic"), ("quality", "quality")])
def test_edges(spark, which, label):
    docs = spark.createDataFrame(
        [(1, None, 1, "x"), (2, "", 1, "x"), (3, "word " * 30000, 1, "x"), (3, "two rows", 1, "x"), (None, "no id", 1, "x")],
        f"doc_id long, text string, row int, {which} string")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    one = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 1), (3, 1), (3, 7)], f"doc_id long, {label} int")
    both = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 1)], f"doc_id long, {label} int")
    for labels, want in ((none, {0.0}), (one, {1.0}), (both, None)):
        rows = score(spark, which, docs, labels).collect()
        assert len(rows) == 5 and rows[0].asDict().keys() == {"doc_id", "text", "row", which}
        got = {round(r[which].score, 9) for r in rows}
        assert got == want if want else all(0 <= x <= 1 for x in got)
        assert len({r[which].score for r in rows if not r.text}) == 1
    assert score(spark, which, docs.limit(0), both).collect() == []


def test_toxicity_learns_from_all_labelled_rows(spark):
    """Each document has a word of its own; the sample bounds the curve only."""
    rng = random.Random(3)
    own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(14)) for _ in range(50)]
    rows = [(i, f"plain words stand here {w} {w} {w}") for i, w in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(i, int(i < 25)) for i in range(50)], "doc_id long, toxic int")
    asked = spark.createDataFrame(list(enumerate(own[:25])), "doc_id long, text string")
    rows = toxicity.score(asked, toxicity.fit(docs, labels, sample=10)).collect()
    assert [r.text for r in rows if r.toxicity.evidence < 0.3] == []


def test_word_vectors_count_neighbours_within_documents():
    """One block against a plain double loop."""
    texts = ["big red dog ran. Red red DOG", "", "cat", "sat | sat mat ** hat"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    word, doc = quality._tokens(data, off, Powers())
    places, signs = quality._index_vectors()
    want = np.zeros((quality.WORDS, quality.DIM))
    for i in range(len(word)):
        for j in range(len(word)):
            if i != j and abs(i - j) <= 2 and doc[i] == doc[j]:
                for p, s in zip(places[word[j]], signs[word[j]], strict=True):
                    want[word[i], p] += s
    got = np.zeros((quality.WORDS // quality.SLICE, quality.SLICE * quality.DIM))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["body"])
    for b in quality._contexts([batch]):
        for k, raw in zip(b.column("slice").to_pylist(), b.column("sums").to_pylist(), strict=True):
            got[k] += np.frombuffer(raw, "<f8")
    assert np.array_equal(got.reshape(want.shape), want)
    assert (word == quality.CAPITALS).sum() == 1 and (word == quality.REPEAT).sum() == 1


def test_labelled_texts_are_a_plain_join(spark):
    docs = spark.range(-3000, 3000).selectExpr("id", "cast(id as string) as body").union(
        spark.createDataFrame([(None, "x"), (7, "again")], "id long, body string"))
    marked = spark.range(0, 40_000, 3).selectExpr("cast(id as int) as id", "1 as label", "id % 2 = 0 as curve")
    got = toxicity._labelled(docs, marked).select("id", "body", "label", "curve")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.join(marked, "id").collect()))
    assert toxicity._labelled(docs, marked.limit(0)).count() == 0


def test_class_counts_do_not_depend_on_how_they_are_held(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcde ") for _ in range(200)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 4 for i in range(60)])], names=["body", "label"])

    def counted():
        out = {}
        for b in toxicity._class_counts([batch, batch]):
            for s, n, m in zip(*(b.column(c).to_pylist() for c in ("slot", "n", "mask"))):
                old = out.get(s, (0, 0))
                out[s] = (old[0] + n, old[1] | m)
        return out

    whole = counted()
    monkeypatch.setattr(toxicity, "HELD", 100)
    monkeypatch.setattr(toxicity, "BLOCK", 500)
    small = counted()
    assert set(small) == set(whole) and all(small[s][1] == whole[s][1] for s in whole)


def test_word_vectors_take_memory_by_the_block():
    """A worker's arrays follow the block, not the batch."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice(("red", "dog,", "RAN", "far")) for _ in range(2000)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["body"])
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in quality._contexts([batch])) > 0
        assert tracemalloc.get_traced_memory()[1] < 48 << 20
    finally:
        tracemalloc.stop()


def test_quality_sends_only_texts_and_vectors_to_python(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = quality.score(docs, labels)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert sorted((r.doc_id, r.text, r.lang) for r in got.collect()) == [(1, "a b", "x"), (2, "c", None)]


def _counting(monkeypatch):
    """The numbers of words that are spelt out, as they are."""
    seen, plain = [], toxicity.Grams

    class Counting(plain):
        def __init__(self, low, start, end, powers):
            seen.append(len(start))
            super().__init__(low, start, end, powers)

    monkeypatch.setattr(toxicity, "Grams", Counting)
    return seen


def _toxic_texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 12))) for _ in range(80)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(90)] + [None, "", "x" * 3000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 4 for i in range(len(texts))])],
                                       names=["body", "label"])
    distinct = {w for t in texts for w in (t or "").split()}
    return texts, batch, distinct


def _toxic_model():
    """A model of made-up counts."""
    rng = np.random.default_rng(7)
    shared, top = (toxicity.ORDER - 1, 1 << toxicity.SHARED_BITS), (2, 2 << toxicity.CLASS_BITS)
    return toxicity.Model(rng.integers(0, 50, shared), rng.integers(0, 9, shared), rng.integers(0, 50, top),
                          rng.integers(0, 9, (2, 1 << toxicity.CLASS_BITS)), (3.0, -1.0))


class _Shipped:
    def __init__(self, value):
        self.value = value


def _toxic_evidence(model, batches):
    return np.concatenate([b.column("x").to_numpy()
                           for b in toxicity._evidence(_Shipped(model), ("label",), False)(iter(batches))])


def test_words_are_spelt_out_once_in_a_task(monkeypatch):
    """However many blocks and batches they stand in."""
    _, batch, distinct = _toxic_texts()
    monkeypatch.setattr(toxicity, "BLOCK", 500)
    seen = _counting(monkeypatch)
    assert sum(b.num_rows for b in toxicity._shared_counts([batch, batch])) > 0
    assert sum(seen) == len(distinct)
    seen.clear()
    assert sum(b.num_rows for b in toxicity._class_counts([batch, batch])) > 0
    assert len(distinct) < sum(seen) <= 4 * len(distinct)
    seen.clear()
    assert len(_toxic_evidence(_toxic_model(), [batch, batch])) == 2 * batch.num_rows
    assert sum(seen) == len(distinct)


def test_toxicity_letters_are_spelt_in_short_stretches(monkeypatch):
    """A block's arrays follow the stretch, not the block."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(2000)) for _ in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["body"])
    model = _toxic_model()
    model.shared_n, model.class_n = model.shared_n.astype(np.uint32), model.class_n.astype(np.uint32)
    powers = Powers()
    powers.need(1 << 21)
    tracemalloc.start()
    try:
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        off = np.cumsum([0, *map(len, texts)])
        assert len(model.evidence(data, off, powers, toxicity.Known())) == batch.num_rows
        assert tracemalloc.get_traced_memory()[1] < 72 << 20
    finally:
        tracemalloc.stop()


def test_grams_are_the_letters_up_to_each_place():
    """Against the hash of each piece by itself, of every order."""
    from tradestar.llm.textblocks import RollingHash
    names = [b"a", b"longer-word", b"xyz", "é".encode(), b"sevenly"]
    low = np.frombuffer(b"".join(names), np.uint8)
    end = np.cumsum([len(w) for w in names])
    powers = Powers()

    def one(piece: bytes):
        data = np.frombuffer(piece, np.uint8)
        return RollingHash(data, powers).spans(np.array([0]), np.array([len(piece)]))[0]

    g = toxicity.Grams(low, end - [len(w) for w in names], end, powers)
    orders = list(g.orders())
    assert [k for k, _, _ in orders] == list(range(1, toxicity.ORDER + 1))
    for k, gram, before in orders:
        want = [(b" " + w + b" ")[max(0, p - k + 1):p + 1] for w in names for p in range(1, len(w) + 2)]
        assert gram.tolist() == [one(x) for x in want]
        short = [(b" " + w + b" ")[max(0, p - k + 1) if k > 1 else p:p] for w in names for p in range(1, len(w) + 2)]
        assert before.tolist() == [one(x) for x in short]


def test_shared_counts_are_types_by_the_block(monkeypatch):
    """Against a plain loop over blocks, words and letters, held at once or bit by bit."""
    from tradestar.llm.textblocks import blocks
    texts, batch, _ = _toxic_texts()
    monkeypatch.setattr(toxicity, "BLOCK", 700)
    n, mask = {}, {}
    for i, j, _, _ in blocks(batch.column("body"), 700):
        for word in {w for t in texts[i:j] for w in (t or "").encode().split()}:
            low = np.frombuffer(word, np.uint8)
            g = toxicity.Grams(low, np.array([0]), np.array([len(word)]), Powers())
            for k, gram, before in list(g.orders())[:-1]:
                for x, c, f in zip(gram.tolist(), before.tolist(), g.follower.tolist(), strict=True):
                    x, c = ((k - 1 << toxicity.SHARED_BITS) + (v >> 64 - toxicity.SHARED_BITS) for v in (x, c))
                    n[x] = n.get(x, 0) + 1
                    mask[c] = mask.get(c, 0) | 1 << f
    for held in (toxicity.HELD, 100, 1500):
        monkeypatch.setattr(toxicity, "HELD", held)
        got = pa.Table.from_batches(toxicity._shared_counts([batch])).to_pylist()
        assert {r["slot"]: r["n"] for r in got if r["n"]} == n
        assert {r["slot"]: r["mask"] for r in got if r["mask"]} == mask


def test_class_counts_are_sums_of_places(monkeypatch):
    texts, batch, _ = _toxic_texts()
    places = sum(len(w.encode()) + 1 for t in texts for w in (t or "").split())
    sums = []
    for held in (toxicity.HELD, 100, 1500):
        monkeypatch.setattr(toxicity, "HELD", held)
        out = {}
        for b in toxicity._class_counts([batch, batch]):
            for s, n, m in zip(*(b.column(c).to_pylist() for c in ("slot", "n", "mask")), strict=True):
                old = out.get(s, (0, 0))
                out[s] = (old[0] + n, old[1] | m)
        sums.append(out)
    assert sums[0] == sums[1] == sums[2]
    for context in (False, True):
        of = [n for s, (n, _) in sums[0].items() if (s >> toxicity.CLASS_BITS & 1) == context]
        assert sum(of) == 2 * places
    assert all((m > 0) == bool(s >> toxicity.CLASS_BITS & 1) for s, (_, m) in sums[0].items())


def test_evidence_does_not_depend_on_what_is_remembered(monkeypatch):
    """Words that share a place of the table, and blocks of any size."""
    texts, batch, _ = _toxic_texts()
    model = _toxic_model()
    alone = np.concatenate([_toxic_evidence(model, [batch.slice(i, 1)]) for i in range(batch.num_rows)])
    assert alone[texts.index("")] == alone[texts.index(None)] == 0 and len(set(alone)) > 50
    for bits, block, stretch, piece in ((19, 4 << 20, 1 << 15, 1 << 18), (2, 500, 20, 100), (5, 3000, 1, 1)):
        for name, value in (("KNOWN_BITS", bits), ("BLOCK", block), ("SPELT", stretch), ("PIECE", piece)):
            monkeypatch.setattr(toxicity, name, value)
        assert np.allclose(_toxic_evidence(model, [batch, batch]), np.tile(alone, 2), rtol=1e-9, atol=1e-12)
