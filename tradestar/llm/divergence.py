"""How far the sources of a language diverge in their words.

Terms are runs of letters: A to Z, lower-cased, and every character beyond ASCII.
A language keeps the terms that stand in at least ``least_docs`` of its documents.
Every source of it gives each kept term a share in units of 1/UNIT, smoothed by
two, as does the language as a whole; two shares p and q differ by
floor((p - q)^2 / (p + q)). All of it is integer arithmetic.

One pass counts: inside ``mapInArrow`` each block of text goes through Arrow's
ascii_lower, split_pattern_regex, dictionary_encode and hash group_by, first by
document and term, then by source and term, and a task sums its blocks before it
hands them on. Spark adds these partial counts. The kept terms are then dealt by
hash into columnar shards, each a table of terms by sources of at most CELLS
cells (or one term); a shard is met with all sources of its language, absent
ones included, and yields its part of every pair's sum and its best terms of
every source. Sources are dealt in blocks of BLOCK as well, so no task holds
more pairs than BLOCK times the number of sources.

Rows: a null text, language or source is an empty string; repeated rows count
again; a source whose documents have no terms is a source like any other; a
language without kept terms has pairs of value 0 and no terms; an empty table
gives no rows. Ties rank by the item's UTF-8 bytes. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradestar.llm.scratch import Scratch
from tradestar.llm.textblocks import blocks

UNIT, SMOOTH = 1_000_000_000, 2
LEAST_DOCS, TOP = 10, 10
#: What stands between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text that Arrow splits at once; a longer document is cut between terms.
BLOCK_BYTES = 4 << 20
#: Rows of partial counts that a task holds before it hands them on.
HELD = 500_000
#: Cells of a shard's table, and sources whose pairs one task makes.
CELLS, BLOCK = 1 << 18, 256

_IS_BETWEEN = np.ones(256, bool)
_IS_BETWEEN[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _cut(data: np.ndarray, limit: int) -> list[bytes]:
    """A long text in parts of about ``limit`` bytes that end between terms."""
    out, a = [], 0
    while len(data) - a > limit:
        z = a + limit
        while z < len(data):
            ends = np.flatnonzero(_IS_BETWEEN[data[z:z + limit]])
            if len(ends):
                z += int(ends[0])
                break
            z = min(len(data), z + limit)
        out.append(data[a:z].tobytes())
        a = z
    return [*out, data[a:].tobytes()]


def _terms(texts: pa.Array, owner: np.ndarray) -> pa.Table:
    """(owner, term, n) of texts, each of which belongs to an owner."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    flat, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    filled = pc.not_equal(flat, "")
    coded = flat.filter(filled).dictionary_encode()
    owners = pa.array(owner).take(parent.filter(filled))
    counts = pa.table({"owner": owners, "code": coded.indices}).group_by(["owner", "code"]).aggregate(
        [([], "count_all")])
    return pa.table({"owner": counts["owner"], "term": pa.chunked_array([coded.dictionary]).take(counts["code"]),
                     "n": counts["count_all"]})


def _summed(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns({"n_sum": "n", "docs_sum": "docs"})


def _partial_counts(batches):
    """(lang, source, term, n, docs); the row with a null term stands for the
    source itself, its docs being all its documents."""
    groups: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []
    rows = 0

    def handed(table: pa.Table):
        names = list(groups)
        lang, source = (pa.array([x[i] for x in names], pa.string()) for i in (0, 1))
        out = pa.table({"lang": lang.take(table["group"].combine_chunks()),
                        "source": source.take(table["group"].combine_chunks()),
                        "term": table["term"], "n": table["n"], "docs": table["docs"]})
        yield from out.to_batches(max_chunksize=65_536)

    for b in batches:
        lang, source = b.column("lang").to_pylist(), b.column("source").to_pylist()
        group = np.array([groups.setdefault(x, len(groups)) for x in zip(lang, source, strict=True)], np.int64)
        names, docs = np.unique(group, return_counts=True)
        held.append(pa.table({"group": names, "term": pa.nulls(len(names), pa.string()),
                              "n": np.zeros(len(names), np.int64), "docs": docs.astype(np.int64)}))
        body = b.column("body")
        for i, j, data, _ in blocks(body, BLOCK_BYTES):
            if j == i + 1 and len(data) > BLOCK_BYTES:
                parts = [_terms(pa.array([t.decode()]), np.zeros(1, np.int64)) for t in _cut(data, BLOCK_BYTES)]
                by_doc = pa.concat_tables(parts).group_by(["owner", "term"]).aggregate([("n", "sum")]).rename_columns(
                    {"n_sum": "n"})
            else:
                by_doc = _terms(body.slice(i, j - i).cast(pa.string()), np.arange(j - i))
            of = group[i + by_doc["owner"].to_numpy()]
            counts = pa.table({"group": of, "term": by_doc["term"], "n": by_doc["n"]}).group_by(
                ["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
            held.append(pa.table({"group": counts["group"], "term": counts["term"], "n": counts["n_sum"],
                                  "docs": counts["n_count"]}))
            rows += len(counts)
            if rows > 2 * HELD:
                held = [_summed(held)]
                rows = len(held[0])
                if rows > HELD:
                    yield from handed(held[0])
                    held, rows = [], 0
    if held:
        yield from handed(_summed(held))


def shares(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * kept)) without
    overflow: the quotient three decimal digits at a time."""
    whole = np.broadcast_to(total + SMOOTH * kept, count.shape)
    out, rest = np.divmod(count + SMOOTH, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digits
    return out + 1


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(key: tuple[pa.Scalar, ...], cells: pa.Table, sources: pa.Table) -> pa.Table:
    """A shard's part of the sums of pairs, and its best terms of each source."""
    lang, block = key[0].as_py(), key[2].as_py()
    sources = sources.sort_by("no")
    names, total = sources["source"].to_pylist(), sources["total"].to_numpy()
    mine = range(block * BLOCK, min(len(names), (block + 1) * BLOCK))
    kept, lang_total = int(sources["kept"][0].as_py()), int(sources["lang_total"][0].as_py())
    rows: list[tuple[str, str, str, int]] = []
    terms = sorted(set(cells["term"].to_pylist()), key=str.encode)
    if terms:
        row = pc.index_in(cells["term"], pa.array(terms)).to_numpy()
        at = pc.index_in(cells["source"], pa.array(names, pa.string())).to_numpy()
        count = np.zeros((len(terms), len(names)), np.int64)
        count[row, at] = cells["n"].to_numpy()
        whole = np.zeros(len(terms), np.int64)
        whole[row] = cells["term_total"].to_numpy()
        p, q = shares(count, total, kept), shares(whole, np.int64(lang_total), kept)
    for i in mine:
        if terms:
            sums = _gap(p[:, i:i + 1], p).sum(axis=0)
            over = np.flatnonzero((count[:, i] > 0) & (p[:, i] > q))
            gap = _gap(p[over, i], q[over])
            best = np.lexsort((over, -gap))[:TOP]
            rows += [(names[i], "term", terms[over[k]], int(gap[k])) for k in best]
        else:
            sums = np.zeros(len(names), np.int64)
        rows += [(names[i], "pair", other, int(s)) for k, (other, s) in enumerate(zip(names, sums, strict=True))
                 if k != i]
    source, part, item, value = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [])
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "source": pa.array(source, pa.string()),
                     "part": pa.array(part, pa.string()), "item": pa.array(item, pa.string()),
                     "value": pa.array(value, pa.int64())})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has each other source
    of the language by the summed difference, part ``term`` the TOP kept terms
    that the source uses more than its language, by their difference."""
    work = Scratch(docs.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("body"))
    counts = work.stored(
        src.mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")

    by_term = Window.partitionBy("lang", "term")  # a row for each source
    cells = work.stored(
        counts.filter("term is not null")
        .withColumn("in_docs", F.sum("docs").over(by_term)).filter(F.col("in_docs") >= least_docs)
        .select("lang", "source", "term", "n", F.sum("n").over(by_term).alias("term_total"),
                (F.col("source") == F.min("source").over(by_term)).cast("long").alias("once")), "cells")

    by_lang = Window.partitionBy("lang")  # a row for each source
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("once").alias("once"))
    sources = work.stored(
        counts.filter("term is null").select("lang", "source").join(own, ["lang", "source"], "left")
        .fillna(0, ["total", "once"])
        .select("lang", "source", "total", F.sum("once").over(by_lang).alias("kept"),
                F.sum("total").over(by_lang).alias("lang_total"), F.count("*").over(by_lang).alias("n_sources"),
                (F.row_number().over(by_lang.orderBy("source")) - 1).alias("no")), "sources")
    work.drop("counts")

    most = sources.agg(F.max(F.col("kept") * F.col("n_sources")).alias("cells"),
                       F.max("n_sources").alias("sources")).first()
    n_shards, n_blocks = -(-(most["cells"] or 1) // CELLS) or 1, -(-(most["sources"] or 1) // BLOCK)
    block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    left = cells.select("lang", F.pmod(F.xxhash64("term"), F.lit(n_shards)).cast("int").alias("shard"), block,
                        "source", "term", "n", "term_total")
    right = sources.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).select("*", block)
    made = left.groupBy("lang", "shard", "block").cogroup(right.groupBy("lang", "shard", "block")).applyInArrow(
        _shard, "lang string, source string, part string, item string, value long")
    # a term is in one shard, so only pairs have anything to add up
    whole = made.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return whole.withColumn("rank", F.row_number().over(order)).filter(f"part = 'pair' or rank <= {TOP}").select(
        "lang", "source", "part", "item", "value", "rank")
