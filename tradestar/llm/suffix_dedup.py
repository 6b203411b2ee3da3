"""Suffix-array dedup: remove every byte that a repeated string covers.

A byte goes if some string of ``length`` bytes (200) over it also starts
anywhere else, in the same document or another. Sorting every byte position of
a corpus would shuffle many times its size, so the prefix doubling runs on the
positions that can still be repeated:

1. *Half length, sampled positions.* Each string of ``length`` bytes is
   represented by one of its inner positions, the smallest rolling hash among
   the windows of ``length/2`` bytes inside it. Equal strings choose equal
   positions, so this sampling loses nothing. The rank of a sampled position is
   the hash of its ``length/2`` bytes; Spark sorts the (rank, document) pairs
   and drops ranks that are unique.
2. *Runs.* Neighbouring positions that share a sampled position form one run.
   Runs whose whole bytes are equal elsewhere are repeated as a whole; they are
   settled without looking at their positions.
3. *Nearly full length, cells.* Where a rank has several different runs (the
   borders of a repeated passage), the starts are taken in cells of CELL and
   ranked by the bytes that a cell's strings share; unique cells drop out, and
   equal cells are settled as a whole.
4. *Full length, single positions.* Each position left gets the pair (rank at
   offset 0, rank at offset ``length/2``); Spark sorts the pairs, and pairs that
   occur once drop out. Ranks now cover ``length`` bytes: the threshold.

Ranks are 64-bit hashes (a full string is told apart by two of them), so no
step needs a global order. All groups are counted by two-phase aggregates;
members of a hot rank are never gathered in one task.

Rows: a null or empty text has no bytes and is kept; texts shorter than
``length`` keep all bytes; repeated rows are copies of each other (all their
bytes go when they are long enough). A document is known by its id and a hash
of its text, so repeated or null ids do no harm. Columns of other names,
clashing ones included, pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.scratch import Scratch
from tradestar.llm.textblocks import U64, Powers, RollingHash, blocks, mix, sliding_argmin

LENGTH = 200
#: Starts that are looked at together before single positions are.
CELL = 20
#: A document longer than this is read in overlapping pieces (positions fit 24 bits).
PIECE = 8 << 20


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Blocks as (first row, last row, byte offset in the document, bytes, offsets)."""
    for i, j, data, off in blocks(column):
        if len(data) <= PIECE:
            yield i, j, 0, data, off
            continue
        for s in range(0, len(data), PIECE):
            part = data[s:s + PIECE + length - 1]
            if len(part) >= length or s == 0:
                yield i, j, s, part, np.array([0, len(part)])


def _runs(data: np.ndarray, off: np.ndarray, length: int, powers: Powers):
    """Runs of string starts that share a sampled position: (document, first
    start, number of starts, sampled position, its rank, rolling hash)."""
    half = length // 2
    h = RollingHash(data, powers)
    grams = h.grams(half)
    at = sliding_argmin(grams, length - half + 1)
    if not len(at):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, np.empty(0, U64), h
    p = np.arange(len(at))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(at)]
    valid = p + length <= off[1:][doc]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    lo = np.flatnonzero(first)
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    n = np.flatnonzero(last) - lo + 1
    return doc[lo], lo, n, at[lo], grams[at[lo]], h


def _i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sampled_ranks(length: int):
    def run(batches):
        powers = Powers()
        for b in batches:
            did, tk = (b.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tk"))
            for i, _, _, data, off in _pieces(b.column("body"), length):
                doc, _, _, _, rank, _ = _runs(data, off, length, powers)
                if not len(doc):
                    continue
                order = np.lexsort((rank, doc))
                doc, rank = doc[order], rank[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (rank[1:] != rank[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(doc)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_i64(rank[at])), pa.array(did[i + doc[at]]), pa.array(tk[i + doc[at]]),
                     pa.array(n.astype(np.int64))], names=["rank", "did", "tk", "n"])
    return run


#: Bytes of a document around its repeated ranks, and the runs found in them.
_REGION = ("did long, tk int, start long, body binary, "
           "runs array<struct<rank:long,ctx:long,lo:int,n:int,at:int>>")


def _regions(length: int):
    run_type = pa.list_(pa.struct([("rank", pa.int64()), ("ctx", pa.int64()),
                                   ("lo", pa.int32()), ("n", pa.int32()), ("at", pa.int32())]))

    def run(batches):
        powers = Powers()
        for b in batches:
            did, tk = (b.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tk"))
            ranks = b.column("ranks")
            for i, j, base, data, off in _pieces(b.column("body"), length):
                doc, lo, n, at, rank, h = _runs(data, off, length, powers)
                wanted = ranks.slice(i, j - i)
                counts = np.diff(wanted.offsets.to_numpy())
                flat = wanted.flatten().to_numpy(zero_copy_only=False).view(U64)
                tag = mix(np.arange(j - i, dtype=U64))
                keep = np.isin(rank ^ tag[doc], flat ^ np.repeat(tag, counts))
                if not keep.any():
                    continue
                doc, lo, n, at, rank = doc[keep], lo[keep], n[keep], at[keep], rank[keep]
                end = lo + n - 1 + length
                ctx = mix(h.spans(lo, end) ^ mix((n.astype(U64) << U64(32)) | (at - lo).astype(U64)))
                new = np.ones(len(lo), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > np.maximum.accumulate(end)[:-1])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(lo))
                start = lo[head]
                stop = np.maximum.reduceat(end, head)
                group = np.repeat(np.arange(len(head)), tail - head)
                inner = pa.StructArray.from_arrays(
                    [pa.array(_i64(rank)), pa.array(_i64(ctx)),
                     pa.array((lo - start[group]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array((at - start[group]).astype(np.int32))],
                    fields=list(run_type.value_type))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(did[i + doc[head]]), pa.array(tk[i + doc[head]]),
                     pa.array(base + start - off[doc[head]]),
                     pa.array([raw[a:z] for a, z in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.append(head, len(lo)).astype(np.int32)), inner)
                     .cast(run_type)],
                    names=["did", "tk", "start", "body", "runs"])
    return run


def _open(batches, fields: tuple[str, ...]):
    """Each region's bytes with the rows of its ``open`` list: (batch, first
    row, rolling hash, offsets, row of each entry, the entries' fields)."""
    powers = Powers()
    for b in batches:
        entries = b.column("open")
        counts = np.diff(entries.offsets.to_numpy())
        flat = entries.flatten()
        values = [flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in fields]
        first = np.concatenate([[0], np.cumsum(counts)])
        for i, j, data, off in blocks(b.column("body")):
            row = np.repeat(np.arange(i, j), counts[i:j])
            if len(row):
                yield b, i, RollingHash(data, powers), off, row, [v[first[i]:first[j]] for v in values]


def _expand(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n: which entry each unit belongs to, and its number in it."""
    k = np.repeat(np.arange(len(n)), n)
    return k, np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)


def _cells(length: int):
    """Open runs in cells of CELL starts, counted from the sampled position,
    with the rank of the bytes that all strings of a cell share."""
    def run(batches):
        for b, i, h, off, row, (lo, n, at, one) in _open(batches, ("lo", "n", "at", "single")):
            far, near = (at - lo) // CELL, (at - lo - n + 1) // CELL
            k, step = _expand(far - near + 1)
            cell = near[k] + step
            shared = at[k] - cell * CELL
            begin = np.maximum(lo[k], shared - CELL + 1)
            size = np.minimum(lo[k] + n[k], shared + 1) - begin
            q = shared + off[row[k] - i]
            rank = mix(h.spans(q, q + length - CELL + 1) ^ mix(cell.astype(U64)))
            q = begin + off[row[k] - i]
            ctx = mix(h.spans(q, q + size - 1 + length) ^ mix((size.astype(U64) << U64(32)) | (at[k] - begin).astype(U64)))
            did, tk, start = (b.column(c).to_numpy(zero_copy_only=False)[row[k]] for c in ("did", "tk", "start"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_i64(rank)), pa.array(_i64(ctx)), pa.array(did), pa.array(tk), pa.array(start),
                 pa.array(begin.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(one[k].astype(bool))],
                names=["rank", "ctx", "did", "tk", "start", "lo", "n", "single"])
    return run


def _pairs(length: int):
    """Single positions of open cells with their pair of half-length ranks."""
    half = length // 2

    def run(batches):
        for b, i, h, off, row, (lo, n, one) in _open(batches, ("lo", "n", "single")):
            k, step = _expand(n)
            p = lo[k] + step
            q = p + off[row[k] - i]
            did, tk, start = (b.column(c).to_numpy(zero_copy_only=False)[row[k]] for c in ("did", "tk", "start"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_i64(h.spans(q, q + half))), pa.array(_i64(h.spans(q + half, q + length))),
                 pa.array(did), pa.array(tk), pa.array(start + p), pa.array(one[k].astype(bool))],
                names=["a", "z", "did", "tk", "p", "single"])
    return run


_DEDUP = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def _whole_characters(kept: bytes) -> str:
    """``kept`` without the bytes of characters that a removal cut in two."""
    return kept.decode("utf-8", "ignore")


def _cut(length: int, with_text: bool):
    out_type = pa.struct([
        ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept", pa.binary()), ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
        + [("text", pa.string())] * with_text)

    def run(batches):
        for b, i, j in ((b, i, j) for b in batches for i, j, _, _ in blocks(b.column("body"))):
            out = []
            bodies, marks = b.column("body"), b.column("marks")
            for k in range(i, j):
                raw = (bodies[k].as_py() or "").encode()
                spans = _merged(marks[k].values, length) if marks[k].is_valid else []
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                out.append({"n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(spans),
                            "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest(),
                            "spans": [{"start": x, "end": y} for x, y in spans]})
                if with_text:
                    out[-1]["text"] = None if not bodies[k].is_valid else _whole_characters(kept)
            yield pa.RecordBatch.from_arrays([b.column("row").slice(i, j - i), pa.array(out, out_type)],
                                             names=["row", "dedup"])
    return run


def _merged(marks: pa.StructArray, length: int) -> list[tuple[int, int]]:
    """Byte spans that the marked strings cover, in order."""
    lo = marks.field("p").to_numpy(zero_copy_only=False)
    hi = lo + marks.field("n").to_numpy(zero_copy_only=False) - 1 + length
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    head = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    return list(zip(lo[head].tolist(), hi[np.append(head[1:], len(lo)) - 1].tolist(), strict=True))


def repeated_positions(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """For frames of (did, tk, body): per document the runs of starts (p, n) of
    repeated strings, as ``marks``."""
    work = Scratch(docs.sparkSession)
    one = F.lit(1)
    sampled = work.stored(docs.mapInArrow(_sampled_ranks(length), "rank long, did long, tk int, n long"), "sampled")
    again = sampled.groupBy("rank").agg(F.sum("n").alias("total")).filter("total > 1").select("rank")
    hit = work.stored(sampled.join(again, "rank", "left_semi").groupBy("did", "tk")
                      .agg(F.collect_list("rank").alias("ranks")), "hit")
    work.drop("sampled")
    regions = work.stored(docs.join(hit, ["did", "tk"]).mapInArrow(_regions(length), _REGION), "regions")
    work.drop("hit")

    # equal runs: repeated as a whole; different runs of one rank: look closer
    runs = regions.select("did", "tk", "start", F.explode("runs").alias("r")).select("did", "tk", "start", "r.*")
    by_run = work.stored(runs.groupBy("rank", "ctx").agg(
        F.count(one).alias("copies"),
        F.min(F.struct("did", "tk", "start", "lo", "n", "at")).alias("one")), "by_run")
    whole = by_run.filter("copies > 1").select("rank", "ctx")
    marks_runs = work.stored(runs.join(whole, ["rank", "ctx"], "left_semi")
                             .select("did", "tk", (F.col("start") + F.col("lo")).alias("p"), "n"), "marks_runs")
    mixed = by_run.groupBy("rank").agg(F.count(one).alias("kinds")).filter("kinds > 1").select("rank")
    spot = ["did", "tk", "start"]
    opened = (by_run.join(mixed, "rank", "left_semi")
              .select("one.did", "one.tk", "one.start", F.struct(
                  F.col("one.lo").alias("lo"), F.col("one.n").alias("n"), F.col("one.at").alias("at"),
                  (F.col("copies") == 1).alias("single")).alias("o"))
              .groupBy(*spot).agg(F.collect_list("o").alias("open")))
    bodies = work.stored(regions.select(*spot, "body").join(opened, spot).dropDuplicates(spot), "bodies")
    work.drop("regions", "by_run")

    # the same for cells of runs
    cells = work.stored(bodies.mapInArrow(_cells(length), "rank long, ctx long, did long, tk int, start long, "
                                          "lo int, n int, single boolean"), "cells")
    by_cell = work.stored(cells.groupBy("rank", "ctx").agg(
        F.count(one).alias("copies"),
        F.min(F.struct("did", "tk", "start", "lo", "n", "single")).alias("one")), "by_cell")
    whole = by_cell.filter("copies > 1").select("rank", "ctx")
    marks_cells = work.stored(cells.filter("single").join(whole, ["rank", "ctx"], "left_semi")
                              .select("did", "tk", (F.col("start") + F.col("lo")).alias("p"), "n"), "marks_cells")
    mixed = by_cell.groupBy("rank").agg(F.count(one).alias("kinds")).filter("kinds > 1").select("rank")
    opened = (by_cell.join(mixed, "rank", "left_semi")
              .select("one.did", "one.tk", "one.start", F.struct(
                  F.col("one.lo").alias("lo"), F.col("one.n").alias("n"),
                  ((F.col("copies") == 1) & F.col("one.single")).alias("single")).alias("o"))
              .groupBy(*spot).agg(F.collect_list("o").alias("open")))

    # and for single positions
    pairs = work.stored(bodies.select(*spot, "body").join(opened, spot)
                        .mapInArrow(_pairs(length), "a long, z long, did long, tk int, p long, single boolean"),
                        "pairs")
    work.drop("bodies", "cells", "by_cell")
    twice = pairs.groupBy("a", "z").agg(F.count(one).alias("c")).filter("c > 1").select("a", "z")
    marks_pairs = (pairs.filter("single").join(twice, ["a", "z"], "left_semi")
                   .select("did", "tk", "p", one.alias("n")))
    marks = work.stored(marks_runs.unionByName(marks_cells).unionByName(marks_pairs).groupBy("did", "tk")
                        .agg(F.collect_list(F.struct("p", "n")).alias("marks")), "marks")
    work.drop("pairs", "marks_runs", "marks_cells")
    return marks


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, carry: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all) plus ``dedup`` =
    struct(n_bytes, n_removed, n_spans, kept (bytes), kept_sha256, spans), which
    replaces a column of that name. With ``with_text`` it also holds ``text``:
    what was kept, as whole characters (null for a null text)."""
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("did"),
           F.hash(F.col(text_col)).alias("tk")]
    marks = repeated_positions(df.select(*key, F.col(text_col).alias("body")), length)
    row = F.struct(*[F.col(c) for c in ([c for c in df.columns if c != "dedup"] if carry is None else carry)]).alias("row")
    full = (df.select(row, *key, F.col(text_col).alias("body")).join(marks, ["did", "tk"], "left")
            .select("row", "body", "marks"))
    dedup = T.StructType([*_DEDUP.fields, *[T.StructField("text", T.StringType())] * with_text])
    out = T.StructType([full.schema["row"], T.StructField("dedup", dedup)])
    return full.mapInArrow(_cut(length, with_text), out).select("row.*", "dedup")
