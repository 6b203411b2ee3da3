"""File-level decisions expressed as DataFrame jobs over tables of file names
or text lines: layout resolution, format classification, delimiter sniffing
and archive-member choice.

Lookup tables here are configuration (the layout keys, a few rules) with a
size fixed by the code, so they are literals; the file/line side is partitioned
data of any size.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradestar.layouts import (CANDIDATE_DELIMITERS, DEFAULT_DELIMITER, REGISTRY_ARCHIVES,
                               REGISTRY_EXTENSIONS, SUPPORTED_EXTENSIONS, layout_rows)

YEAR_PATTERN = r"_\d{4}"


def _stem(c):
    """File name without its last extension."""
    return F.regexp_replace(c, r"\.[^./]*$", "")


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    """Value of a literal map; null for any other key."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)


def resolve_layout(files: DataFrame, name_col: str = "arquivo") -> DataFrame:
    """Layout for each file name: exact key, else equal after removing ``_YYYY``
    (first key in declaration order), else the longest key that prefixes the
    name. The keys are a constant of the code, so each rule is a lookup in a
    literal map: one projection over the distinct names."""
    rows = sorted(layout_rows(), key=lambda r: r[2])
    exact = {key: layout for key, layout, _ in reversed(rows)}
    no_year = {re.sub(YEAR_PATTERN, "", key): layout for key, layout, _ in reversed(rows)}
    stem = _stem(F.col("arquivo"))
    by_length: dict[int, dict[str, str]] = {}
    for key, layout in exact.items():
        by_length.setdefault(len(key), {})[key] = layout
    prefix = F.coalesce(*[_lookup(by_length[n], F.substring(stem, 1, n))
                          for n in sorted(by_length, reverse=True)])
    found = files.select(F.col(name_col).alias("arquivo")).distinct().select(
        "arquivo", _lookup(exact, stem).alias("e"),
        _lookup(no_year, F.regexp_replace(stem, YEAR_PATTERN, "")).alias("s"), prefix.alias("p"))
    rule = (F.when(F.col("e").isNotNull(), "exata").when(F.col("s").isNotNull(), "sem_ano")
            .when(F.col("p").isNotNull(), "prefixo"))
    return found.select("arquivo", F.coalesce("e", "s", "p").alias("layout"), rule.alias("regra"))


def resolve_layout_by_table(tables: DataFrame, name_col: str = "pasta") -> DataFrame:
    """Layout for a table/folder name. Trade: ``_mun`` / ``exp`` / ``imp``
    substrings; registry: the folder -> entity dictionary (a literal map)."""
    n = F.lower(F.col(name_col))
    is_mun, is_exp, is_imp = n.contains("_mun"), n.contains("exp"), n.contains("imp")
    trade = (F.when(is_mun & is_exp, "EXP_2021_MUN").when(is_mun & is_imp, "IMP_2021_MUN")
             .when(~is_mun & is_exp, "EXPO_2021").when(~is_mun & is_imp, "IMP_2021"))
    pairs = [x for entity, (_, folder) in REGISTRY_ARCHIVES.items()
             for x in (F.lit(folder), F.lit(entity))]
    registry = F.create_map(*pairs)[n]
    return tables.select(
        F.col(name_col).alias("pasta"),
        F.when(registry.isNotNull(), "cnpj").when(trade.isNotNull(), "balanca").alias("dominio"),
        F.coalesce(registry, trade).alias("layout"))


def classify_files(files: DataFrame, name_col: str = "arquivo") -> DataFrame:
    """Read instructions per file from its extension: format, header,
    delimiter (null = to be sniffed), encoding, multiLine, compressed."""
    ext = F.lower(F.regexp_extract(F.col(name_col), r"(\.[^./]+)$", 1))
    registry_like = ext.isin(*REGISTRY_EXTENSIONS) | (ext.contains("csv") & (F.length(ext) > 4))
    fmt = (F.when(ext == ".zip", "zip")
           .when(registry_like | ext.isin(".csv", ".txt"), "csv")
           .when(ext == ".parquet", "parquet")
           .when(ext == ".json", "json")
           .when(ext == ".xlsx", "excel")
           .otherwise("unknown"))
    header = (F.when(registry_like, F.lit(False))
              .when(ext.isin(".csv", ".txt", ".xlsx"), F.lit(True)))
    delimiter = F.when(registry_like, F.lit(";"))
    encoding = (F.when(registry_like, "ISO-8859-1")
                .when(ext.isin(".csv", ".txt"), "UTF-8"))
    return files.select(
        F.col(name_col).alias("arquivo"), ext.alias("extensao"),
        ext.isin(*SUPPORTED_EXTENSIONS).alias("suportado"),
        fmt.alias("formato"), header.alias("header"), delimiter.alias("delimitador"),
        encoding.alias("encoding"), (ext == ".json").alias("multiline"),
        (ext == ".zip").alias("compactado"))


def sniff_delimiter(lines: DataFrame, file_col: str = "arquivo", line_no_col: str = "n_linha",
                    text_col: str = "linha", files: DataFrame | None = None,
                    sample_bytes: int | None = None) -> DataFrame:
    """Delimiter of each file from all of its lines. ``files`` names files that
    may have no line. A caller that wants a sample passes ``sample_bytes``: then
    only the lines that begin in a file's first bytes count.

    For every candidate the occurrences in each line are counted; the winner is
    the candidate whose most frequent count (> 0) covers most lines, then the
    higher count, then the candidate order. No candidate -> ','. Two two-phase
    aggregates; the counts of a file, not its lines, meet in one task.
    """
    head = lines.select(F.col(file_col).alias("arquivo"), F.col(line_no_col).alias("n"),
                        F.col(text_col).alias("linha"))
    if sample_bytes is not None:
        w = Window.partitionBy("arquivo").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(F.octet_length("linha") + 1).over(w), F.lit(0))
        head = (head.filter(F.col("n") <= sample_bytes).withColumn("_antes", before)
                .filter(F.col("_antes") < sample_bytes))
    if files is not None:
        names = files.select(F.col(file_col).alias("arquivo"), F.lit(None).cast("string").alias("linha"))
        head = head.select("arquivo", "linha").unionByName(names)
    cands = F.array(*[F.struct((-F.lit(i)).alias("o"), F.lit(d).alias("d"))
                      for i, d in enumerate(CANDIDATE_DELIMITERS)])
    per_line = head.select("arquivo", F.explode(cands).alias("c"), "linha").select(
        "arquivo", "c.o", "c.d",
        (F.length("linha") - F.length(F.replace("linha", F.col("c.d"), F.lit("")))).alias("k"))
    counted = per_line.groupBy("arquivo", "o", "d", "k").agg(F.count(F.lit(1)).alias("linhas"))
    best = counted.groupBy("arquivo").agg(
        F.max(F.when(F.col("k") > 0, F.struct("linhas", "k", "o", "d"))).alias("b"))
    return best.select("arquivo", F.coalesce("b.d", F.lit(DEFAULT_DELIMITER)).alias("delimitador"),
                       F.col("b").isNull().alias("padrao"))


def choose_member(members: DataFrame, archive_col: str = "arquivo_zip",
                  member_col: str = "membro", pos_col: str = "posicao",
                  size_col: str = "bytes") -> DataFrame:
    """Member of each archive to ingest: the first (by position) with a
    supported extension, else the largest; ``__MACOSX`` entries ignored."""
    ext = F.lower(F.regexp_extract(F.col(member_col), r"(\.[^./]+)$", 1))
    ok = members.filter(~F.col(member_col).startswith("__MACOSX")
                        & ~F.col(member_col).endswith("/"))
    ranked = ok.select(
        archive_col, member_col,
        F.struct(F.when(ext.isin(*SUPPORTED_EXTENSIONS), 0).otherwise(1).alias("s"),
                 F.when(ext.isin(*SUPPORTED_EXTENSIONS), F.col(pos_col))
                 .otherwise(-F.col(size_col)).alias("p"),
                 F.col(member_col).alias("m")).alias("r"))
    return (ranked.groupBy(archive_col).agg(F.min("r").alias("r"))
            .select(archive_col, F.col("r.m").alias(member_col)))

