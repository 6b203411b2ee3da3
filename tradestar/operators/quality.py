"""Quality and upkeep reports: referential integrity, rejects, catalogue
profile, masking, versioned lookups and the per-entity run report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.functions import keys as K
from tradestar.operators.gold import ACTIVITY_COLUMNS


def fk_orphans(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphan counts per foreign key: fact rows (and distinct keys) whose key
    has no row in its dimension.

    One pass over the fact: every row is exploded into (fk, key) pairs and
    counted per key with map-side partial aggregation, so the shuffle carries
    at most one row per distinct key per task. The anti-join then runs on key
    counts, not on fact rows. ``dims`` maps fact column -> (dimension, column).
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(fk).alias("fk"), F.col(fk).alias("k"))
                                for fk in dims]))
    key_counts = (fact.select(pairs.alias("p"))
                  .groupBy(F.col("p.fk").alias("fk"), F.col("p.k").alias("k"))
                  .agg(F.count(F.lit(1)).alias("n")))
    dim_keys = reduce(lambda a, b: a.unionByName(b), [
        dim.select(F.lit(fk).alias("fk"), F.col(col).alias("k"), F.lit(True).alias("_hit"))
        for fk, (dim, col) in dims.items()])
    # Left join + "no match" filter rather than a left-anti join: Catalyst
    # pushes anti-joins below an aggregate on their keys, which would join the
    # exploded fact rows instead of the per-key counts. Duplicate dimension
    # keys only repeat matched rows, which the filter drops.
    orphans = (key_counts.filter(F.col("k").isNotNull())
               .join(dim_keys, ["fk", "k"], "left")
               .filter(F.col("_hit").isNull()).select("fk", "k", "n"))
    totals = (orphans.groupBy("fk")
              .agg(F.sum("n").cast("bigint").alias("linhas_orfas"),
                   F.count(F.lit(1)).cast("bigint").alias("chaves_orfas")))
    all_fks = fact.sparkSession.createDataFrame([(fk,) for fk in dims], "fk string")
    return (all_fks.join(totals, "fk", "left")
            .select(F.col("fk").alias("chave_estrangeira"),
                    F.coalesce("linhas_orfas", F.lit(0).cast("bigint")).alias("linhas_orfas"),
                    F.coalesce("chaves_orfas", F.lit(0).cast("bigint")).alias("chaves_orfas")))


def _reasons(side: DataFrame) -> Column:
    return F.concat_ws(",",
                       F.when(F.col("sk_ncm").isNull(), F.lit("sk_ncm_nulo")),
                       F.when(F.col("sk_data").isNull(), F.lit("sk_data_nulo")),
                       F.when(~F.col("mes").between(1, 12), F.lit("mes_invalido")))


def fact_rejects(exp: DataFrame, imp: DataFrame) -> DataFrame:
    """Rows the fact's quality gate drops (code or month key null), plus rows
    kept with a month outside 1-12, each with its reasons. Narrow: one filter
    per direction, no shuffle."""
    def build(df, tipo, pais, uf):
        base = df.select("*", K.surrogate_key("codigo_ncm").alias("sk_ncm"),
                         K.month_key("ano", "mes").alias("sk_data"))
        motivo = _reasons(base)
        return (base.filter(F.col("sk_ncm").isNull() | F.col("sk_data").isNull()
                            | ~F.col("mes").between(1, 12))
                .select(F.lit(tipo).alias("tipo_movimentacao"), "codigo_ncm", "ano", "mes",
                        K.measure("valor_fob_usd").alias("valor_fob"), motivo.alias("motivo")))

    return build(exp, K.EXPORT, "codigo_pais_destino", "uf_origem").unionByName(
        build(imp, K.IMPORT, "codigo_pais_origem", "uf_destino"))


def profile(df: DataFrame, table: str, with_type: bool = True,
            approx_distinct: bool = False) -> DataFrame:
    """One row per column: rows, nulls (and optionally HyperLogLog distinct).
    A single aggregation pass over the table."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"__n{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(F.col(f"`{c}`")).alias(f"__d{i}"))
    agg = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for i, c in enumerate(cols):
        fields = [F.lit(table).alias("tabela"), F.lit(c).alias("coluna")]
        if with_type:
            fields.append(F.lit(types[c]).alias("tipo"))
        fields += [F.col("__rows").alias("linhas"), F.col(f"__n{i}").alias("nulos")]
        if approx_distinct:
            fields.append(F.col(f"__d{i}").alias("distintos_aprox"))
        rows.append(F.struct(*fields))
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def catalog_profile(tables: dict[str, DataFrame], with_type: bool = True,
                    approx_distinct: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [profile(df, name, with_type, approx_distinct) for name, df in tables.items()])


def run_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per entity: rows and status (OK / VAZIO). Counting uses one aggregate
    per table; in a load job the same numbers come from ``observe`` on the write."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("linhas"))
             .select(F.lit(name).alias("entidade"), "linhas") for name, df in tables.items()]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select("entidade", "linhas",
                      F.when(F.col("linhas") > 0, "OK").otherwise("VAZIO").alias("status"),
                      F.when(F.col("linhas") == 0, "entrada vazia, ignorada").alias("mensagem"))


def hash_column(c) -> Column:
    """Irreversible pseudonym: SHA-256 hex."""
    return F.sha2(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), 256)


def keep_last(c, n: int, mask: str = "*") -> Column:
    """Mask all but the last ``n`` characters."""
    col = F.col(f"`{c}`") if isinstance(c, str) else c
    return F.concat(F.repeat(F.lit(mask), F.greatest(F.length(col) - n, F.lit(0))),
                    F.right(col, F.lit(n)))


def mask_columns(df: DataFrame, hashed: list[str] = (), partial: dict[str, int] | None = None
                 ) -> DataFrame:
    """Replace sensitive columns in place (one projection)."""
    partial = partial or {}
    out = []
    for c in df.columns:
        if c in hashed:
            out.append(hash_column(c).alias(c))
        elif c in partial:
            out.append(keep_last(c, partial[c]).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def versioned_lookup(df: DataFrame, mapping: DataFrame, key: str, map_key: str,
                     version_col: str, valid_from_col: str, as_of: str,
                     value_cols: list[str]) -> DataFrame:
    """Left join to the newest mapping version valid on ``as_of``. The mapping
    is first reduced to one row per key (aggregate, not window), so the join
    cannot fan out."""
    current = (mapping.filter(F.col(valid_from_col) <= F.lit(as_of).cast("date"))
               .groupBy(map_key)
               .agg(F.max(F.struct(version_col, *value_cols)).alias("_m"))
               .select(F.col(map_key).alias(key),
                       *[F.col(f"_m.{c}").alias(c) for c in [version_col, *value_cols]]))
    return df.join(current, key, "left")


def current_activities(mapping: DataFrame, as_of: str | None = None) -> DataFrame:
    """Of a versioned mapping of products (codigo_ncm, ACTIVITY_COLUMNS, versao,
    vigente_desde) the row of each product that holds on ``as_of`` (default:
    today)."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    best = F.max(F.struct("vigente_desde", "versao", *ACTIVITY_COLUMNS)).alias("_m")
    return mapping.filter(F.col("vigente_desde") <= day).groupBy("codigo_ncm").agg(best).select(
        "codigo_ncm", *[F.col(f"_m.{c}").alias(c) for c in ACTIVITY_COLUMNS])
