"""The corpus pipeline, stage by stage, against brute force on a small table."""

import os
import re
import tempfile
from collections import Counter

import pytest

import tests_llm_path  # noqa: F401  (puts the repository on the path)
import corpus_pipeline as C
from tradestar.llm.pii import FORMATS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in C.STAGES:
        path = os.path.join(tempfile.mkdtemp(), name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
        if name != C.STAGES[-1][0]:
            assert docs.columns == C.COLUMNS
    return out


def test_names():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "pii",
                                        "packing"] and C.ORACLE_SQL is None


def test_quality_keeps_good_documents(spark, stages):
    kept = {r.doc_id for r in stages["quality_classifier"]}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    wrong = sum((r.doc_id in kept) != bool(r.quality) for r in labels)
    assert wrong <= 0.03 * len(labels)


def test_near_dedup(stages):
    from test_simhash import brute_groups, brute_print
    rows = sorted(stages["quality_classifier"], key=lambda r: r.doc_id)
    groups = brute_groups([brute_print(r.text) for r in rows], 3)
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"]) == sorted({rows[g].doc_id for g in groups})


def test_suffix_dedup(stages):
    before = {r.doc_id: r for r in stages["simhash_near_dedup"]}
    raws = {i: r.text.encode() for i, r in before.items()}
    seen = Counter(r[p:p + 200] for r in raws.values() for p in range(len(r) - 199))
    assert len(stages["suffix_array_dedup"]) == len(before)
    for r in stages["suffix_array_dedup"]:
        raw = raws[r.doc_id]
        gone = bytearray(len(raw))
        for p in range(len(raw) - 199):
            if seen[raw[p:p + 200]] > 1:
                gone[p:p + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore")
        assert r.text == kept and r.n_chars == len(kept) and r.lang == before[r.doc_id].lang


def test_pii_masked(stages):
    before = {r.doc_id: r.text for r in stages["suffix_array_dedup"]}
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert set(FORMATS) == {"email", "ip", "card", "phone"}
    for r in stages["pii"]:
        assert not mail.search(r.text) and r.n_chars == len(r.text)
        if "[" not in r.text:
            assert r.text == before[r.doc_id]
    assert any("[EMAIL]" in r.text for r in stages["pii"]) and len(before) == len(stages["pii"])


def test_packing(stages):
    from test_packing import plain_ids
    texts = {r.doc_id: r.text for r in stages["pii"]}
    pieces = {}
    for r in stages["packing"]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for i, rows in pieces.items():
        ids = [x for p in sorted(rows, key=lambda p: p.start) for x in p.ids]
        assert ids == plain_ids(texts[i]) + [1]


def test_run_equals_stages_and_odd_input(spark, stages, tmp_path):
    rows = C.run(spark, SF)
    assert sum(r.length for r in rows.collect()) == sum(r.length for r in stages["packing"])
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "w " * 60000, "en", "s", 1),
           (3, "Plain words, a few of them, in a line.", "en", "s", 1), (3, "Plain words, a few of them, in a line.", "en", "s", 1)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for name, table in (("odd", docs), ("none", docs.limit(0))):
        root = tmp_path / name
        table.write.parquet(f"{root}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{root}/labels.parquet")
        got = C.run(spark, str(root)).collect()
        assert bool(got) == (name == "odd")
