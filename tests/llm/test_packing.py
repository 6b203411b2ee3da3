"""Packing: round trip of every id, fixed capacity, little padding."""

import json
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tradestar.llm import packing
from tradestar.llm.packing import WordIds, pack, piece_lengths

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    t = Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids


ODD = ["It's Ünïcode—ﬁ ½ ① İstanbul ΣΑΣ é ñ", "tab\tnew\nline\x0bvt\x0cff\rcr nbsp em\x85nel\x1cfs",
       "<|endoftext|> and <|startoftext|>x<|endoftext|>", "<|EndOfText|> a\x00b \x00 Σας ΣΑΣ", "日本語のテキスト 한국어 عربى", "́ lone mark ‍",
       "a" * 3000, "don't they'll I'd we've 's's 12345 3.14!?..", "x" * 70 + " " + "y" * 70, "", "   "]


def test_words_equal_tokenizer():
    w = WordIds(PATH)
    got = w.texts([t.encode() for t in ODD])
    assert [g.tolist() for g in got] == [plain_ids(t) for t in ODD]
    assert [g.tolist() for g in w.texts([t.encode() for t in ODD])] == [plain_ids(t) for t in ODD]


def test_special_tokens_stand_for_themselves():
    assert plain_ids("a <|endoftext|> b") == [320, 49407, 321]
    got = WordIds(PATH).texts([b"a <|endoftext|> b", b"a <|EndOfText|> b"])
    assert got[0].tolist() == [320, 49407, 321] and got[1].tolist() == plain_ids("a <|EndOfText|> b")


def test_each_token_spelt_out_comes_back_as_itself():
    """Then the lowest rank of what a pair becomes is the lowest rank of a pair."""
    with open(PATH, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    rank = {p: i for i, p in enumerate(pairs)}
    assert len({a + b for a, b in pairs}) == len(pairs)
    for a, b in pairs:
        token = a + b
        inner = token.removesuffix("</w>")
        parts = list(inner)
        if inner != token:
            parts[-1] += "</w>"
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), 1 << 30), i))
            if (parts[best], parts[best + 1]) not in rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        assert parts == [token]


def test_words_with_a_small_memory(monkeypatch):
    monkeypatch.setattr("tradestar.llm.packing.CACHED", 3)
    w = WordIds(PATH)
    for t in ODD:
        assert w.texts([t.encode(), b"and one"])[0].tolist() == plain_ids(t)


def test_piece_lengths():
    for n in range(1, 9000, 7):
        cut = piece_lengths(n)
        assert sum(cut) == n and max(cut) <= 2048 and all(x.bit_count() == 1 for x in cut[:-1])


def check(rows, docs, least_fill):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r.piece)
        by_seq[r.piece.sequence_id].append(r.piece)
    assert set(by_doc) == set(docs)
    for i, pieces in by_doc.items():
        want = plain_ids(docs[i]) + [1]
        pieces.sort(key=lambda p: p.start)
        assert [x for p in pieces for x in p.ids] == want
        assert {p.doc_tokens for p in pieces} == {len(want)}
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(want[p.start:p.start + p.length], "<u4").tobytes())
    used = padded = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        used += at
        padded += at if at.bit_count() == 1 else 2048
    assert used >= least_fill * padded


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = {r.doc_id: r.text for r in df.collect()}
    check(pack(df, PATH).collect(), docs, 0.99)


def test_edges(spark):
    rows = [(1, None, 3), (2, "", 3), (3, "word " * 5000, 3), (4, "one two", 3)] + [
        (10 + i, t, 3) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece long").repartition(3)
    got = pack(df, PATH)
    assert got.columns == ["doc_id", "piece"]
    check(got.collect(), {r[0]: r[1] for r in rows}, 0.99)
    assert pack(df.limit(0), PATH).collect() == []
    twice = pack(df.union(df), PATH).collect()
    assert sum(r.piece.length for r in twice) == 2 * sum(r.piece.length for r in got.collect())


def test_words_are_forgotten_with_the_task(monkeypatch):
    """A Python worker outlives its task; what it knew must not stay in memory."""
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", "more words"])], names=["row", "body"])
    out = list(packing._pack(PATH, 2048, 1, 64, False)([batch]))
    assert sum(b.num_rows for b in out) >= 2 and not packing._word_ids(PATH).known
