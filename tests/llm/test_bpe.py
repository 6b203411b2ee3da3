"""Byte-level BPE against tiktoken, and an exact round trip."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from tradestar.llm import bpe
from tradestar.llm.bpe import Codec, decode, encode, encode_long, encode_rows

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "\n\n", "  two  spaces \n next\n\n\nthree ", "tab\t x\t\ty  nbsp \x1c z\r\n", "It's they'LL we've",
       "日本語 한국어 عربى 🎉🎉 é", "a" * 400, "ab" * 90 + " " + "é" * 60, " \n \n x", "x \n", "1234567 3.14 #!?"]


def tik():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_tiktoken(monkeypatch):
    enc, codec = tik(), Codec(PATH, P.PATTERN)
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("etaoin shrdlu\n éß,.'0123") for _ in range(rng.randint(1, 300)))
                   for _ in range(300)]
    assert [x.tolist() for x in codec.texts(texts)] == [enc.encode_ordinary(t) for t in texts]
    assert [codec.decode(x.tolist()).decode() for x in codec.texts(texts)] == texts
    monkeypatch.setattr("tradestar.llm.bpe.CACHED", 2)
    assert [codec.texts([t])[0].tolist() for t in texts] == [enc.encode_ordinary(t) for t in texts]


def test_both_trees_agree():
    codec = Codec(PATH, P.PATTERN)
    rng = random.Random(6)
    raws = [bytes(rng.choice(b"aabcdeeinrst\xc3\xa9") for _ in range(rng.randint(2, 60))) for _ in range(400)]
    assert encode_rows(codec.v, raws) == [encode_long(codec.v, r) for r in raws]


def test_query_columns(spark):
    enc = tik()
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(90, None, 1), (91, "again", 1), (91, "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bpe long")
    got = encode(df, PATH, P.PATTERN)
    assert got.columns == ["doc_id", "text", "bpe"]
    for r in got.collect():
        ids = enc.encode_ordinary(r.text or "")
        assert list(r.bpe.ids) == ids and r.bpe.n_tokens == len(ids) and r.bpe.decoded == (r.text or "")
        assert r.bpe.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.bpe.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = decode(got.selectExpr("doc_id", "text", "bpe.ids"), PATH).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)
    assert encode(df.limit(0), PATH, P.PATTERN).collect() == []


def test_whole_table(spark):
    enc = tik()
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in encode(df, PATH, P.PATTERN).collect():
        assert list(r.bpe.ids) == enc.encode_ordinary(r.text)


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    enc, codec, calls = tik(), Codec(PATH, P.PATTERN), []
    monkeypatch.setattr(bpe, "ROW_BYTES", 1)
    monkeypatch.setattr(bpe, "encode_long", lambda v, raw: calls.append(raw) or encode_long(v, raw))
    for t in ["zxqthndre. x", "zxqthndre, y zxqthndre! zxqthndre***", "zxqthndre\tz"]:
        assert codec.texts([t])[0].tolist() == enc.encode_ordinary(t)
    assert calls.count(b"zxqthndre") == 1


def test_cuts_of_a_block_equal_a_plain_pattern():
    codec, rng = Codec(PATH, P.PATTERN), random.Random(8)
    texts = ["", *("".join(rng.choice("ab é \n\n") for _ in range(rng.randint(0, 12))) for _ in range(500)), "", " \n"]
    texts += ["two words\tand more\n x", "nbsp\xa0 y  z"]
    raws = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raws)])
    want = []
    for t, a in zip(texts, off.tolist(), strict=False):
        found = [t] * bool(t) if re.search(r"[^\S \n]", t) else re.findall(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]", t)
        for x in found:
            want.append(a)
            a += len(x.encode())
    assert codec._cuts(np.frombuffer(b"".join(raws), np.uint8), off).tolist() == want


@pytest.mark.parametrize("limit", [1, 7, 100, 1 << 20])
def test_digests_do_not_depend_on_blocks(monkeypatch, limit):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", limit)
    enc, texts = tik(), [*ODD, None, "", "x" * 300]
    rows = pa.StructArray.from_arrays([pa.array(range(len(texts)))], names=["doc_id"])
    batch = pa.RecordBatch.from_arrays([rows, pa.array(texts)], names=["row", "body"]).slice(1)
    for with_ids in (False, True):
        (out,) = bpe._code(PATH, P.PATTERN, with_ids)([batch])
        for t, r in zip(texts[1:], out.column("bpe").to_pylist(), strict=True):
            ids = enc.encode_ordinary(t or "")
            want = {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    "decoded_sha256": hashlib.sha256((t or "").encode()).hexdigest()}
            assert r == (want | {"ids": ids, "decoded": t or ""} if with_ids else want)
    (none,) = bpe._code(PATH, P.PATTERN, True)([batch.slice(0, 0)])
    assert none.num_rows == 0
