"""SimHash near-dedup by tiled exact comparison.

Every document gets a 64-bit fingerprint of its word shingles. Fingerprints
link when at most ``radius`` bits differ; documents of one connected group are
near copies of each other.

Links are found exactly: distinct fingerprints are laid into tiles by the
population counts of their four 16-bit quarters. The counts of two
fingerprints differ, summed over the quarters, by no more than their distance,
so only tiles whose counts lie within the radius are paired; numpy compares
each pair of tiles by exclusive-or and bit count. A dense pair of tiles hands
on a spanning forest of its links, which connects the same fingerprints with at
most one row for each.

Rows: a null text is an empty one (fingerprint zero, linked like any other);
equal texts share a fingerprint; repeated rows and repeated ids stay separate
rows. A component whose ids are all null has a null id.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.components import components
from tradestar.llm.scratch import Scratch

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Fingerprints in a tile, on average at most.
TILE = 1024
_EACH_BYTE = np.uint64(0x0101010101010101)


def fingerprint(raw: bytes, n_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: majority over the bits of its shingles' XXH64."""
    words = raw.lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(n_words, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:z], SEED) for a, z in zip(starts, ends[k - 1:].tolist(), strict=True)),
                    np.uint64, len(starts))
    rows = np.zeros(-(-len(h) // 255) * 255, np.uint64)
    rows[: len(h)] = h
    rows = rows.reshape(-1, 255)
    counts = np.zeros((8, 8), np.int64)
    for bit in range(8):  # eight one-byte counters at a time
        part = ((rows >> np.uint64(bit)) & _EACH_BYTE).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = part.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    ones = (2 * counts.ravel() > len(h)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def _fingerprints(n_words: int):
    def run(batches):
        for b in batches:
            fp = [fingerprint(x.encode(), n_words) if (x := t.as_py()) else 0 for t in b.column("body")]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("id"), b.column("tk"), pa.array(np.array(fp, np.uint64).view(np.int64))],
                names=["row", "id", "tk", "fp"])
    return run


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most n-1 links that connect the same of n nodes as the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            node = np.flatnonzero(label != np.arange(n))
            return node, label[node]


def _compare(radius: int):
    def run(batches):
        for b in batches:
            left, right = b.column("left"), b.column("right")
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv = left.values.to_numpy(zero_copy_only=False).view(np.uint64)
            rv = right.values.to_numpy(zero_copy_only=False).view(np.uint64)
            out_a, out_b = [], []
            for k in range(b.num_rows):
                x, y = lv[lo[k]:lo[k + 1]], rv[ro[k]:ro[k + 1]]
                i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
                if not len(i):
                    continue
                if len(i) > len(x) + len(y):
                    node, root = forest(i, len(x) + j, len(x) + len(y))
                    both = np.concatenate([x, y])
                    a, z = both[node], both[root]
                else:
                    a, z = x[i], y[j]
                differ = a != z
                out_a.append(a[differ])
                out_b.append(z[differ])
            if out_a:
                a, z = np.concatenate(out_a), np.concatenate(out_b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(z.view(np.int64))], names=["a", "b"])
    return run


def _near_counts(radius: int) -> list[list[int]]:
    """One of each two opposite differences between the quarters' counts."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius]
    return [list(d) for d in steps if d >= (0, 0, 0, 0)]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """For distinct fingerprints (fp): links (a, b) that connect all
    fingerprints within ``radius`` of each other, and no others."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long")))
              .cast("int").alias(f"c{k}") for k in range(4)]
    laid = prints.select("fp", F.array(*counts).alias("at"))
    # at most 17^4 places, however many fingerprints there are
    room = laid.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    tiles = Scratch(prints.sparkSession).stored(laid.join(F.broadcast(room), "at")
                   .groupBy("at", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("tile"))
                   .agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = F.array(*[F.array(*[F.lit(x) for x in d]) for d in _near_counts(radius)])
    left = (tiles.select("at", F.col("tile").alias("left_tile"), F.col("fps").alias("left"),
                         F.explode(steps).alias("step"))
            .select(F.zip_with("at", "step", lambda x, d: x + d).alias("at"), "left_tile", "left",
                    (F.col("step") == F.array(*[F.lit(0)] * 4)).alias("own")))
    pairs = (left.join(tiles.select("at", "tile", F.col("fps").alias("right")), "at")
             .filter("not own or left_tile <= tile"))
    return pairs.select("left", "right").mapInArrow(_compare(radius), "a long, b long")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = SHINGLE_WORDS,
                radius: int = RADIUS, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all but the text) plus ``near`` =
    struct(tk (hash of the text), fp, root (smallest fingerprint of the
    component), component_id (its smallest id)); ``near`` replaces a column of
    that name."""
    keep = [c for c in df.columns if c not in (text_col, "near")] if carry is None else carry
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(id_col).alias("id"),
                    F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("body"))
    schema = T.StructType([src.schema["row"], src.schema["id"], T.StructField("tk", T.LongType()),
                           T.StructField("fp", T.LongType())])
    work = Scratch(df.sparkSession)
    marked = work.stored(src.mapInArrow(_fingerprints(n_words), schema), "prints")
    prints = work.stored(marked.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(links(prints.select("fp"), radius)).withColumnRenamed("a", "fp")
    rooted = (prints.join(roots, "fp", "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = work.stored(rooted.join(first, "root").select("fp", "root", "component_id"), "named")
    return marked.join(named, "fp").select("row.*", F.struct("tk", "fp", "root", "component_id").alias("near"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of near copies, with all its columns: the one
    of the smallest id (a null id only if there is no other), then of the
    smallest text hash."""
    found = near_copies(df.select(id_col, text_col), id_col, text_col, carry=[id_col], **options)
    stay = (found.groupBy("near.root")
            .agg(F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                                F.col("near.tk").alias("tk"))).alias("one"))
            .select(F.col("one.id").alias("stay_id"), F.col("one.tk").alias("stay_tk")))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(id_col).alias("id"),
                     F.xxhash64(text_col).alias("tk"))
    return (rows.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("tk") == F.col("stay_tk")),
                      "left_semi")
            .dropDuplicates(["id", "tk"]).select("row.*"))
