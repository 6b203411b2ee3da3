"""SimHash near-dedup against all pairs."""

import random
import re

import numpy as np
import xxhash

from tradestar.llm.simhash import forest, keep_one, links, near_copies

SCHEMA = "doc_id long, text string, near string, row string, id long"


def brute_print(text: str | None, n_words: int = 3) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    k = min(n_words, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints: list[int], radius: int) -> list[int]:
    root = list(range(len(prints)))
    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def texts(n: int = 160) -> list[str | None]:
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghié") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(rng.randint(3, 300))) for _ in range(n // 4)]
    out: list[str | None] = [None, "", " \t\n", "one", "One", "two words", "one\x0btwo three four"]
    for _ in range(n):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = word()
        out.append(rng.choice([" ", "\n", "  "]).join(w))
    return out


def test_prints_and_components(spark):
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(i, t, "n", "r", 5) for i, t in rows], SCHEMA).repartition(5)
    got = {r.doc_id: (r.near.fp & (1 << 64) - 1, r.near.component_id) for r in near_copies(df).collect()}
    prints = [brute_print(t) for _, t in rows]
    groups = brute_groups(prints, 3)
    assert got == {i: (p, rows[g][0]) for (i, _), p, g in zip(rows, prints, groups, strict=True)}
    kept = sorted(r.doc_id for r in keep_one(df).collect())
    assert kept == sorted(rows[g][0] for g in set(groups))


def test_links_connect_exactly(spark):
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(25)}
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    at = {int(np.uint64(p).view(np.int64)): i for i, p in enumerate(prints)}
    root = list(range(len(prints)))
    for r in links(df, tile=7).collect():
        i, j = at[r.a], at[r.b]
        a, b = root[i], root[j]
        root = [min(a, b) if x in (a, b) else x for x in root]
    assert root == brute_groups(prints, 3)


def test_forest():
    i, j = np.nonzero(np.ones((30, 40), bool))
    a, b = forest(i, 30 + j, 70)
    assert len(a) == 69 and set(b.tolist()) == {0}


def test_repeated_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d", "n", "r", 1), (None, "a b c d", "n", "r", 1), (4, "x y z w", "n", "r", 1),
            (4, "x y z w", "n", "r", 1), (4, "quite another text here", "n", "r", 1), (9, None, "n", "r", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert len(near_copies(df).collect()) == 6
    kept = keep_one(df).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [
        (0, "a b c d"), (4, "quite another text here"), (4, "x y z w"), (9, "")]
    assert kept[0].asDict().keys() == {"doc_id", "text", "near", "row", "id"}
    assert near_copies(df.limit(0)).collect() == [] and keep_one(df.limit(0)).collect() == []
