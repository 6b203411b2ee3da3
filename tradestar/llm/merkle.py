"""Document fingerprints: a Merkle tree over sections, paragraphs and runs.

A paragraph is a line. Paragraphs form sections that end at blank lines or at
a paragraph whose digest says so, and a paragraph is cut into short runs of
words after words whose hash says so; borders depend on the text around them,
so an edit moves only the branches it touches. Digests are taken bottom up: a
paragraph's over its bytes, a section's over its paragraphs', the root's over
the sections'. Equal roots mean equal texts; where roots differ, the branches
that differ locate the edits (``changed_spans``).

The fingerprint is the tree written out: the root's digest, then the sections
(``;``), in them the paragraphs (``,``), in these the runs, four characters
each. Two fingerprints are compared branch by branch; their likeness is the
share of runs that they have in common.

Rows: a null text is an empty one (a root over no sections). Two texts without
runs are alike (1.0) if both are, else 0.0. Repeated rows have the same
fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.textblocks import SPACES, U64, Powers, RollingHash, words

#: A run ends after one word in so many, a section after one paragraph in so many.
RUN_WORDS, SECTION_PARAGRAPHS = 4, 4
#: A run has no more words than this; in a paragraph of few words each is a run.
LONGEST_RUN, FEW_WORDS = 8, 12
_WORD = ~SPACES


class Tree:
    """Runs, paragraphs and sections of one text (UTF-8 bytes)."""

    def __init__(self, raw: bytes, powers: Powers | None = None) -> None:
        data = np.frombuffer(raw, np.uint8)
        lines = raw.split(b"\n")
        ends = np.cumsum([len(x) + 1 for x in lines]) if raw else np.array([1])
        start, end, _ = words(data, np.array([0, len(data)]), _WORD)
        self.raw = raw
        h = RollingHash(data, powers or Powers())
        line = np.searchsorted(ends, start, "right")
        last = np.ones(len(start), bool)
        if len(start):
            few = np.bincount(line)[line] <= FEW_WORDS
            last[:-1] = ((h.spans(start, end) % U64(RUN_WORDS) == 0) | few)[:-1] | (line[1:] != line[:-1])
            # a run that finds no border of its own is cut at a fixed length
            at = np.flatnonzero(last)
            begin = np.concatenate([[0], at[:-1] + 1])
            inside = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
            last |= inside % LONGEST_RUN == LONGEST_RUN - 1
        stop = np.flatnonzero(last)
        first = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
        self.run_start, self.run_end = start[first], end[stop]
        self.run_hash = h.spans(self.run_start, self.run_end)
        #: Runs of each line: from cut to cut.
        self.cuts = np.searchsorted(line[first], np.arange(len(lines) + 1)).tolist()
        self.paragraphs = [hashlib.blake2b(x, digest_size=8).digest() for x in lines] if raw else []
        self.sections: list[list[int]] = []
        held: list[int] = []
        for k, digest in enumerate(self.paragraphs):
            held.append(k)
            if not lines[k].strip() or digest[0] % SECTION_PARAGRAPHS == 0:
                self.sections.append(held)
                held = []
        if held:
            self.sections.append(held)
        nodes = [hashlib.blake2b(b"".join(self.paragraphs[k] for k in s), digest_size=16).digest()
                 for s in self.sections]
        self.section_digests = nodes
        self.root = hashlib.blake2b(b"".join(nodes), digest_size=16).hexdigest()

    def fingerprint(self) -> str:
        low = self.run_hash.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3].tobytes()
        text = base64.b64encode(low).decode()
        return self.root + ":" + ";".join(
            ",".join(text[4 * self.cuts[k]:4 * self.cuts[k + 1]] for k in s) for s in self.sections)


def fingerprint(text: str | None) -> str:
    return Tree((text or "").encode()).fingerprint()


def _runs(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text.replace(";", "").replace(",", "")), np.uint8).reshape(-1, 3)
    return raw[:, 0].astype(np.int64) | raw[:, 1].astype(np.int64) << 8 | raw[:, 2].astype(np.int64) << 16


def likeness(a: str, b: str) -> float:
    """Share of runs (0 to 1) that two fingerprints have in common. Branches
    that both have are matched whole, section by section and then paragraph by
    paragraph; only runs of the branches that differ are matched singly."""
    root_a, _, tree_a = a.partition(":")
    root_b, _, tree_b = b.partition(":")
    if root_a == root_b:
        return 1.0
    size = lambda t: len(t) - t.count(";") - t.count(",")
    total = size(tree_a) + size(tree_b)
    if not total:
        return 0.0
    same = 0
    for mark in (";", ","):
        left, right = Counter(tree_a.split(mark)), Counter(tree_b.split(mark))
        both = left & right
        same += sum(size(x) * n for x, n in both.items())
        tree_a, tree_b = mark.join((left - both).elements()), mark.join((right - both).elements())
        if mark == ";":
            tree_a, tree_b = tree_a.replace(";", ","), tree_b.replace(";", ",")
    x, n = np.unique(_runs(tree_a), return_counts=True)
    y, m = np.unique(_runs(tree_b), return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    same += 4 * int(np.minimum(n[i], m[j]).sum())
    return 2 * same / total


def changed_spans(text: str | None, other: str | None) -> list[tuple[int, int]]:
    """Byte spans of ``text`` that ``other`` lacks, found by descending from the
    roots into the branches that differ."""
    a, b = Tree((text or "").encode()), Tree((other or "").encode())
    if a.root == b.root:
        return []
    known = Counter(b.section_digests)
    open_a: list[int] = []
    for s, digest in zip(a.sections, a.section_digests, strict=True):
        if known[digest]:
            known[digest] -= 1
        else:
            open_a += s
    inner = Counter(b.paragraphs)
    shut = set(range(len(a.paragraphs))) - set(open_a)
    inner.subtract(Counter(a.paragraphs[k] for k in shut))
    runs = Counter(b.run_hash.tolist())
    out: list[tuple[int, int]] = []
    for k in open_a:
        if inner[a.paragraphs[k]] > 0:
            inner[a.paragraphs[k]] -= 1
            continue
        for i in range(a.cuts[k], a.cuts[k + 1]):
            h = int(a.run_hash[i])
            if runs[h]:
                runs[h] -= 1
            else:
                out.append((int(a.run_start[i]), int(a.run_end[i])))
    return out


def edited(text: str, other: str) -> str:
    """The last third of ``text`` replaced by as much of ``other``'s beginning."""
    third = len(text) // 3
    return text[:len(text) - third] + other[:third]


_MERKLE = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
_ARROW = pa.struct([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64())])


def _neighbours(batches):
    """Rows come in order within their stretch; each is finished by the next."""
    powers = Powers()
    held = None
    for b in batches:
        stretch, ghost = b.column("stretch").to_pylist(), b.column("ghost").to_pylist()
        rows, bodies = b.column("row"), b.column("body")
        owners, out = [], []
        for k in range(b.num_rows):
            text = bodies[k].as_py() or ""
            mine = Tree(text.encode(), powers).fingerprint()
            if held is not None and held[0] == stretch[k] and not held[1]:
                _, _, row, before, print_of = held
                new = edited(before, text)
                changed = Tree(new.encode(), powers).fingerprint()
                owners.append(row)
                out.append((len(before), hashlib.sha256(new.encode()).hexdigest(), print_of, changed,
                            likeness(print_of, changed), likeness(print_of, mine)))
            held = (stretch[k], ghost[k], rows[k], text, mine)
        if out:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o.as_py() for o in owners], rows.type),
                 pa.StructArray.from_arrays(cols, fields=list(_ARROW))], names=["row", "merkle"])


def with_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: list[str] | None = None, stretches: int | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all) plus ``merkle`` =
    struct(n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), where the next document follows by descending id (null ids
    last, equal ids by a hash of the text, then any order) and the first one
    follows the last.

    The ids are cut into stretches at quantiles; each stretch is sorted on its
    own and ends with a copy of the document that begins the next one. The
    driver sees one id for each stretch.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c != "merkle"] if carry is None else carry
    least = -(1 << 63)
    docs = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"),
                     F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("key"),
                     F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("body"))
    n = stretches or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("key", [k / n for k in range(1, n + 1)], 20 * n).alias("q")).first()["q"]
    if not cuts:
        return docs.limit(0).select("row.*", F.lit(None).cast(_MERKLE).alias("merkle"))
    above = F.array(*[F.lit(int(m)) for m in sorted(set(cuts))])
    laid = docs.withColumn("stretch", F.size(F.filter(above, lambda m: m > F.col("key"))))
    heads = sorted((r["stretch"], r["head"]["key"], r["head"]["tk"]) for r in
                   laid.groupBy("stretch").agg(F.max(F.struct("key", "tk")).alias("head")).collect())
    follows = [(heads[k][0], *heads[(k + 1) % len(heads)][1:]) for k in range(len(heads))]
    ends = spark.createDataFrame(follows, "ghost_stretch int, key long, tk long")
    ghosts = (docs.filter(F.col("key").isin([f[1] for f in follows]))
              .join(F.broadcast(ends), ["key", "tk"])
              .select("row", "key", "tk", "body", F.col("ghost_stretch").alias("stretch"), F.lit(True).alias("ghost")))
    every = laid.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    ordered = (every.repartition(F.col("stretch"))
               .sortWithinPartitions("stretch", "ghost", F.desc("key"), F.desc("tk"))
               .select("row", "body", "stretch", "ghost"))
    schema = T.StructType([docs.schema["row"], T.StructField("merkle", _MERKLE)])
    return ordered.mapInArrow(_neighbours, schema).select("row.*", "merkle")
