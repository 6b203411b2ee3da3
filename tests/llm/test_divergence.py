"""The audit against a plain loop in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tradestar.llm import divergence
from tradestar.llm.divergence import audit, shares

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n string"


def plain(rows, least):
    groups, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        seen[lang or ""].update(set(words))
    out = []
    for lang in {k[0] for k in groups}:
        kept = sorted(t for t, k in seen[lang].items() if k >= least)
        mine = {s: c for (x, s), c in groups.items() if x == lang}

        def share(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return [1 + 10 ** 9 * (count[t] + 2) // total for t in kept]

        p, q = {s: share(c) for s, c in mine.items()}, share(sum(mine.values(), Counter()))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in mine.items():
            pairs = [(sum(map(gap, p[s], p[o])), o) for o in mine if o != s]
            terms = [(gap(a, b), t) for t, a, b in zip(kept, p[s], q) if c[t] and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, *r, "a", "b") for i, r in enumerate(rows)], SCHEMA).repartition(4)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "été", "ÉTÉ", "x1y", "don't", "日本", "zz"] + [f"w{chr(97 + k)}" for k in range(20)]
    return [(rng.choice([" ", "\n", "-", "\x00"]).join(rng.choices(words, k=rng.randint(0, 12))),
             rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None])) for _ in range(n)]


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_plain_loop(spark):
    rows = texts(1) + [(None, "en", "s9"), ("", "fr", "only"), ("one two", "it", "a"), ("one", "it", "b")]
    assert got(audit(made(spark, rows))) == plain(rows, 10)
    assert got(audit(made(spark, rows * 2), least_docs=3)) == plain(rows * 2, 3)


def test_small_shards_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 16)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    rows = texts(2)
    assert got(audit(made(spark, rows))) == plain(rows, 10)


def run(rows):
    import pyarrow as pa
    text, lang, source = (pa.array([r[k] or "" for r in rows], pa.string()) for k in range(3))
    out = Counter()
    for b in divergence._partial_counts(
            [pa.RecordBatch.from_arrays([lang, source, text], names=["lang", "source", "body"])]):
        for r in b.to_pylist():
            out[r["lang"], r["source"], r["term"]] += complex(r["n"], r["docs"])
    return out


def test_cut_texts_and_handed_counts(monkeypatch):
    rows = texts(3) + [("long Wörd " * 500 + "x" * 700, "en", "s1")]
    whole = run(rows)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 50)
    monkeypatch.setattr(divergence, "HELD", 5)
    assert run(rows) == whole
    assert whole["en", "s1", "wörd"].real >= 500 and whole["en", "s1", "x" * 700] == complex(1, 1)


def test_very_long_text(spark):
    rows = [("Ab cd " * 1_000_000, "en", "s1"), ("ab " * 10, "en", "s2")] * 5
    assert got(audit(made(spark, rows))) == plain(rows, 10)


def test_empty_table(spark):
    assert got(audit(made(spark, texts(1)).limit(0))) == []


def test_shares_are_exact():
    rng = random.Random(5)
    for _ in range(200):
        total = rng.randint(1, 10 ** 14)
        count, kept = rng.randint(0, total), rng.randint(1, 10 ** 6)
        assert shares(np.array([count]), np.int64(total), kept)[0] == 1 + 10 ** 9 * (count + 2) // (total + 2 * kept)
