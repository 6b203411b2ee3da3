"""Suffix-array dedup against a dictionary of all substrings."""

import hashlib
from collections import Counter

import pytest

from tradestar.llm.suffix_dedup import remove_repeats

SCHEMA = "doc_id long, text string, lang string, did long, marks string"


def brute(texts: list[str | None], length: int) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p:p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows, length):
    df = spark.createDataFrame([(i, t, "en", 7, "x") for i, t in rows], SCHEMA)
    got = remove_repeats(df, length=length).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.dedup.n_bytes, r.dedup.n_removed,
                   r.dedup.n_spans, r.dedup.kept_sha256) for r in got)


def expected(rows, length):
    return sorted((i if i is not None else -1, t or "", *b)
                  for (i, t), b in zip(rows, brute([t for _, t in rows], length), strict=True))


def test_edges(spark):
    import random
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(30), prose(25)
    rows = [(1, prose(40) + passage + prose(40)), (2, passage + prose(9)), (3, prose(9) + passage),
            (4, None), (5, ""), (6, "short"), (7, "a" * 500), (8, "ab" * 300 + passage[:60]),
            (9, prose(200)), (9, prose(5) + passage[3:] + other), (None, other + passage[10:80] + "!"),
            (10, other + other), (11, passage[:39] + "x" + passage[40:100] + "y" + passage[101:])]
    rows += [(12, rows[0][1]), (13, rows[8][1]), (13, rows[8][1])]
    for length in (40, 41):
        assert run(spark, rows, length) == expected(rows, length)


def test_empty_table(spark):
    assert run(spark, [], 40) == []


def test_long_document_in_pieces(spark, monkeypatch):
    import tradestar.llm.suffix_dedup as S
    monkeypatch.setattr(S, "PIECE", 700)
    monkeypatch.setattr("tradestar.llm.textblocks.BLOCK_BYTES", 300)
    import random
    rng = random.Random(8)
    text = "".join(rng.choice("ab cd") for _ in range(3000))
    text = text + text[100:900] + "#" + text[1500:1600]
    cols = S.pa.array([text, text[800:1500]])
    whole = list(S._pieces(cols, 40))
    assert sum(len(d) for *_, d, _ in whole) >= len(text)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    assert run(spark, rows, 200) == expected(rows, 200)


def test_cut_returns_batches_by_the_block():
    """Texts of a batch are not all held twice more before they go back."""
    import pyarrow as pa

    from tradestar.llm import suffix_dedup, textblocks
    texts = ["x" * 50_000, None, "yé" * 20_000] * 20
    marks = [[{"p": 10, "n": 1}], None, None] * 20
    batch = pa.RecordBatch.from_arrays(
        [pa.array([{"id": i} for i in range(60)]), pa.array(texts),
         pa.array(marks, pa.list_(pa.struct([("p", pa.int64()), ("n", pa.int64())])))], names=["row", "body", "marks"])
    out = list(suffix_dedup._cut(40, True)([batch]))
    assert len(out) > 1 and all(b.column("dedup").field("n_bytes").to_numpy().sum() <= textblocks.BLOCK_BYTES for b in out)
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["row"]["id"] for r in rows] == list(range(60))
    assert [r["dedup"]["text"] for r in rows] == ["x" * 49_960, None, "yé" * 20_000] * 20
