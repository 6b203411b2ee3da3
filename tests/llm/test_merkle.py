"""Merkle fingerprints: definition of the edit, equality, likeness, location."""

import hashlib
import random

from tradestar.llm.merkle import changed_spans, edited, fingerprint, likeness, with_neighbours

SCHEMA = "doc_id long, text string, merkle string, key long"


def brute(rows):
    """(id, chars, edited sha) by one sort of everything."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        new = t[:len(t) - third] + nxt[:third]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprint(t), fingerprint(new),
                    likeness(fingerprint(t), fingerprint(new)), likeness(fingerprint(t), fingerprint(nxt))))
    return sorted(out, key=str)


def run(spark, rows, stretches=None):
    df = spark.createDataFrame([(i, t, "m", 1) for i, t in rows], SCHEMA).repartition(4)
    got = with_neighbours(df, stretches=stretches)
    assert got.columns == ["doc_id", "text", "key", "merkle"]
    return sorted(((r.doc_id, *r.merkle) for r in got.collect()), key=str)


def prose(rng, n):
    return "".join(rng.choice(["a", "bé", "cd", "efg", "hij"]) + rng.choice(" " * 9 + "\n") for _ in range(n))


def test_neighbours_equal_one_sort(spark):
    rng = random.Random(2)
    rows = [(i * 7, prose(rng, rng.choice([0, 3, 30, 400]))) for i in range(60)] + [(3, None), (None, "last one")]
    for stretches in (1, 5, 300):
        assert run(spark, rows, stretches) == brute(rows)
    assert run(spark, [(5, "only one here")]) == brute([(5, "only one here")])
    assert run(spark, []) == []


def test_repeated_rows_and_ids(spark):
    same = [(4, "same text here and there")] * 5
    got = run(spark, same + [(9, "x")])
    assert len(got) == 6 and sum(r[-1] == 1.0 for r in got) == 4


def test_fingerprints():
    rng = random.Random(3)
    a = prose(rng, 600)
    assert fingerprint(a) == fingerprint(str(a)) and likeness(fingerprint(a), fingerprint(a)) == 1.0
    assert fingerprint(a) != fingerprint(a + " ") and fingerprint("a  b") != fingerprint("a b")
    assert likeness(fingerprint(""), fingerprint(None)) == 1.0 == likeness(fingerprint(" "), fingerprint(" "))
    assert likeness(fingerprint(""), fingerprint("a")) == 0.0
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    x, y = " ".join(words[:300]), " ".join(words[300:])
    assert likeness(fingerprint(x), fingerprint(y)) < 0.05
    near = likeness(fingerprint(x), fingerprint(edited(x, y)))
    assert 0.55 < near < 0.75
    assert 0.5 < likeness(fingerprint("na " * 900), fingerprint(edited("na " * 900, y))) < 0.8


def test_changed_spans_locate_an_edit():
    rng = random.Random(4)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)) + "." for _ in range(40)]
    a = "\n".join(lines)
    lines[17] = lines[17][:70] + "EDITED" + lines[17][76:]
    b = "\n".join(lines)
    spans = changed_spans(b, a)
    at = b.index("EDITED")
    assert spans and min(s for s, _ in spans) > at - 120 and max(e for _, e in spans) < at + 120
    assert any(s <= at < e for s, e in spans) and changed_spans(a, a) == []


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(spark, rows) == brute(rows)
