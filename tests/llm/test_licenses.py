"""License scans: base phrases by a plain loop, templates by planted copies."""

import random
import re

from tradestar.llm.licenses import PHRASES, TEMPLATES, scan
from tradestar.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, license string, words int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "l", 1) for i, t in rows], SCHEMA)


def base_of(x):
    return (x.n_words, x.n_base, x.first_word, x.last_word, list(x.base_labels))


def test_base(spark):
    rng = random.Random(1)
    parts = ["CC", "by", "cc-BY", "General", "public", "LICENSE", "all", "rights", "reserved", "é", "K", "x1", "\x00",
             ".", "|"]
    rows = [(i, rng.choice([" ", ", ", "-"]).join(rng.choice(parts) for _ in range(rng.randint(0, 40))))
            for i in range(300)]
    rows += [(900, None), (901, ""), (902, "cc"), (903, "cc by"), (904, "--- ***"), (905, "general public license " * 9000)]
    for r in scan(frame(spark, rows)).collect():
        assert base_of(r.license) == brute(dict(rows)[r.doc_id]), r.doc_id


def test_templates(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(n))
    long = max(TEMPLATES, key=lambda t: len(t[1]))
    words = long[1].split()
    moved = " ".join(words[:9] + ["newly", "put"] + words[9:16] + words[17:])
    rows = [(i, f"{prose(30)} {text.upper()} {prose(30)}") for i, (_, text) in enumerate(TEMPLATES)]
    rows += [(100, f"{prose(9)} {moved} {prose(9)}"), (101, prose(400)), (102, " ".join(words[:7]) + " " + prose(40)),
             (103, f"{moved}. {prose(5)} {moved}"), (None, moved), (None, moved)]
    got = [(r.doc_id, r.license) for r in scan(frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    for i, x in got:
        if i is not None and i < 100:
            assert TEMPLATES[i][0] in x.labels
            s = next(s for s in x.spans if s.label == TEMPLATES[i][0])
            assert s.share == 1.0 or TEMPLATES[i][0] in x.base_labels or s.first >= 29
        elif i in (100, 103, None):
            assert x.labels == [long[0]] and 0.6 <= x.score < 1 and len(x.spans) == (2 if i == 103 else 1)
        else:
            assert list(x.labels) == [] and x.score == 0.0


def test_edges(spark):
    df = frame(spark, [(1, "Released under the MIT License."), (1, "Released under the MIT License.")])
    got = scan(df)
    assert got.columns == ["doc_id", "words", "license"] and [list(r.license.labels) for r in got.collect()] == [["mit"]] * 2
    assert scan(df.limit(0)).collect() == []


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = QUERIES["op8_licenses"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word,
                r.base_labels.split(",") if r.base_labels else []) == brute(docs[r.doc_id])
        assert ("mit" in r.labels.split(",")) == ("Released under the MIT License" in docs[r.doc_id])
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def test_labels_that_differ_in_a_word_exclude_each_other(spark):
    texts = {"gpl-2.0": "Licensed under the GNU General Public License, version 2.", "gpl-3.0":
             "Licensed under the GNU General Public License, version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0",
             "cc-by-sa": "Licensed under CC BY-SA 4.0", "cc-by": "Licensed under CC BY 4.0"}
    rows = list(enumerate(texts.values()))
    for r in scan(frame(spark, rows)).collect():
        label = list(texts)[r.doc_id]
        assert set(r.license.labels) - set(r.license.base_labels) == {label} - set(r.license.base_labels)
        assert [s.label for s in r.license.spans] == [label]


def test_denials_are_no_license(spark):
    rows = [(1, "It is not released under the MIT license at all"), (2, "This isn't licensed under the MIT License"),
            (3, "Not ours. Released under the MIT License"), (4, "not released under the MIT License; released under the "
                                                                 "MIT License elsewhere")]
    got = {r.doc_id: list(r.license.labels) for r in scan(frame(spark, rows)).collect()}
    assert got == {1: [], 2: [], 3: ["mit"], 4: ["mit"]}


def test_license_statements_of_the_given_table(spark):
    """At sf0.01 every statement names version 3."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in QUERIES["op8_licenses"](spark, "/root/testdata/sf0.01").collect():
        labels = set(r.labels.split(","))
        stated = "GNU General Public License, version 3" in docs[r.doc_id]
        assert ("gpl-3.0" in labels) == stated and "gpl-2.0" not in labels
