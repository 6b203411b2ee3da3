"""Gold layer: star schema over the trusted trade tables.

Each builder is a pure function of its inputs (no I/O). Keyed dedup keeps a
deterministic survivor through ``min(struct(...))``. With string fields in the
struct Spark plans it as a sort-based aggregate (string buffers are not
fixed-width), still in two phases: every map task reduces each key to one row
before the shuffle, so a hot key never lands whole in one task as it would
with ``row_number()`` over a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.functions import keys as K

AUDIT_COLUMN = "data_processamento_gold"


def add_audit(df: DataFrame) -> DataFrame:
    """Audit timestamp of the gold load."""
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp())


def dedup_by_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key; the survivor is the smallest remaining row (nulls first)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def strip_sentinels(df: DataFrame, sentinels: tuple[str, ...] = ()) -> DataFrame:
    """Turn sentinel strings written by a null fill (e.g. 'N/A') back into
    nulls in every string column, so defaults, the state filter and the fact's
    quality gate see a missing value (one projection; no-op without sentinels)."""
    if not sentinels:
        return df
    strings = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(*[K.null_if_sentinel(F.col(c), sentinels).alias(c) if c in strings
                       else F.col(c) for c in df.columns])


def _months(df: DataFrame, ano: str, mes: str) -> DataFrame:
    return df.select(F.col(ano).cast("int").alias("ano"), F.col(mes).cast("int").alias("mes"))


def build_dim_date(exp: DataFrame, imp: DataFrame) -> DataFrame:
    """dim_data: distinct (ano, mes) of both directions with calendar attributes.

    One union then one distinct: partial aggregation reduces each task to at
    most a few hundred months before the single shuffle.
    """
    months = _months(exp, "ano", "mes").unionByName(_months(imp, "ano", "mes")).distinct()
    return months.select(
        K.month_key("ano", "mes").alias("sk_data"),
        K.first_of_month("ano", "mes").alias("data"),
        "ano", "mes",
        K.quarter("mes").alias("trimestre"),
        K.semester("mes").alias("semestre"),
        K.month_name("mes").alias("nome_mes"),
    )


#: What the product dimension takes from a mapping of products to activities.
ACTIVITY_COLUMNS = ["cnae", "descricao_cnae", "setor_economico"]


def build_dim_product(ncm: DataFrame, fat_agreg: DataFrame | None = None,
                      ppe: DataFrame | None = None, sentinels: tuple[str, ...] = (),
                      activities: DataFrame | None = None) -> DataFrame:
    """dim_ncm. Without lookups the factor/PPE codes are carried as they are;
    with lookups (enriched) they are replaced by their descriptions through
    left joins, so a missing lookup row leaves a null, never drops a product.
    ``activities`` (codigo_ncm and ACTIVITY_COLUMNS, one row for each product:
    ``current_activities``) adds the activity and sector of each product."""
    base = strip_sentinels(ncm, sentinels)
    fator: Column = F.col("codigo_fator_agregacao")
    ppe_col: Column = F.col("codigo_ppe_exportacao")
    extra: list[Column] = []
    if fat_agreg is not None:
        factors = fat_agreg.select("codigo_fator_agregacao", "descricao_fator_agregacao",
                                   "descricao_fator_agregacao_grupo")
        base = base.join(dedup_by_key(factors, "codigo_fator_agregacao"), "codigo_fator_agregacao", "left")
        fator = F.col("descricao_fator_agregacao")
        extra.append(F.col("descricao_fator_agregacao_grupo").alias("grupo_fator_agregado"))
    if ppe is not None:
        names = ppe.select(F.col("codigo_ppe").alias("codigo_ppe_exportacao"), "descricao_ppe")
        base = base.join(dedup_by_key(names, "codigo_ppe_exportacao"), "codigo_ppe_exportacao", "left")
        ppe_col = F.col("descricao_ppe")
    if activities is not None:
        base = base.join(dedup_by_key(activities.select("codigo_ncm", *ACTIVITY_COLUMNS), "codigo_ncm"),
                         "codigo_ncm", "left")
        extra += [F.col(c) for c in ACTIVITY_COLUMNS]
    dim = base.select(
        K.surrogate_key("codigo_ncm").alias("sk_ncm"),
        F.col("codigo_ncm"),
        F.coalesce(F.col("descricao_ncm_pt"), F.lit(K.DEFAULT_PRODUCT_NAME)).alias("nome_ncm"),
        fator.alias("fator_agregado"),
        ppe_col.alias("nomenclatura_ppe"),
        *extra,
    )
    return dedup_by_key(dim, "sk_ncm")


def build_dim_transport(via: DataFrame, sentinels: tuple[str, ...] = ()) -> DataFrame:
    """dim_via_transporte, one row per mode key."""
    dim = strip_sentinels(via, sentinels).select(
        K.surrogate_key("codigo_via_transporte").alias("sk_via_transporte"),
        F.col("codigo_via_transporte").alias("codigo_via"),
        F.coalesce(F.col("descricao_via_transporte"), F.lit(K.DEFAULT_TRANSPORT_NAME))
        .alias("nome_via"),
    )
    return dedup_by_key(dim, "sk_via_transporte")


def _blocs_per_country(pais_bloco: DataFrame, with_list: bool) -> DataFrame:
    """One row per country: the smallest bloc name (and optionally all names)."""
    aggs = [F.min("nome_bloco_pt").alias("nome_bloco")]
    if with_list:
        aggs.append(F.concat_ws(", ", F.array_sort(F.collect_set("nome_bloco_pt")))
                    .alias("blocos"))
    return pais_bloco.groupBy("codigo_pais").agg(*aggs)


def distinct_states(exp: DataFrame, imp: DataFrame) -> DataFrame:
    return (exp.select(F.col("uf_origem").alias("uf"))
            .unionByName(imp.select(F.col("uf_destino").alias("uf")))
            .filter(F.col("uf").isNotNull())
            .distinct())


def build_dim_geography(pais: DataFrame, pais_bloco: DataFrame, exp: DataFrame,
                        imp: DataFrame, uf: DataFrame | None = None,
                        sentinels: tuple[str, ...] = (),
                        unknown_member: bool = False) -> DataFrame:
    """dim_geografia: countries (PAIS) and states (UF) in one table.

    One row per key: a country in several blocs gets one of them, codes that
    give the same key ('063', '63') one row, and a state one name, so a join
    never repeats a fact. With ``uf`` (enriched) the states get their names and
    macro-regions and countries list all blocs.
    ``unknown_member`` adds the 'XX' state (key 8888) that the fact uses for a
    missing state, so that key is no longer an orphan.
    """
    enriched = uf is not None
    pais, exp, imp = (strip_sentinels(x, sentinels) for x in (pais, exp, imp))
    countries = (pais.join(_blocs_per_country(pais_bloco, enriched), "codigo_pais", "left")
                 .select(
                     K.surrogate_key("codigo_pais").alias("sk_geografia"),
                     F.col("codigo_pais").alias("codigo_referencia"),
                     F.coalesce(F.col("nome_pais_pt"), F.lit(K.DEFAULT_COUNTRY_NAME))
                     .alias("nome_geografia"),
                     F.lit(K.LEVEL_COUNTRY).alias("nivel"),
                     F.col("codigo_pais_iso3").alias("sigla"),
                     F.col("nome_bloco").alias("regiao_ou_bloco"),
                     *([F.col("blocos")] if enriched else []),
                 ))
    countries = dedup_by_key(countries, "sk_geografia").select(*countries.columns)
    states = distinct_states(exp, imp)
    if unknown_member:
        spark = exp.sparkSession
        states = states.unionByName(spark.createDataFrame([(K.UNKNOWN_STATE,)], "uf string")) \
            .distinct()
    name: Column = F.col("uf")
    region: Column = F.lit(K.HOME_COUNTRY)
    if enriched:
        names = dedup_by_key(uf.select(F.col("sigla_uf").alias("uf"), "nome_uf", "nome_regiao"), "uf")
        states = states.join(names, "uf", "left")
        name = F.coalesce(F.col("nome_uf"), F.col("uf"))
        region = F.coalesce(F.col("nome_regiao"), F.lit(K.HOME_COUNTRY))
    state_rows = states.select(
        K.state_key("uf").alias("sk_geografia"),
        F.col("uf").alias("codigo_referencia"),
        name.alias("nome_geografia"),
        F.lit(K.LEVEL_STATE).alias("nivel"),
        F.col("uf").alias("sigla"),
        region.alias("regiao_ou_bloco"),
        *([F.lit(None).cast("string").alias("blocos")] if enriched else []),
    )
    return countries.unionByName(state_rows)


FACT_KEYS = ["sk_ncm", "sk_geografia", "sk_geografia_uf", "sk_via_transporte", "sk_data"]
FACT_MEASURES = ["valor_fob", "quantidade", "kg_liquido"]


def fact_side(df: DataFrame, tipo: str, pais_col: str, uf_col: str,
              extra: dict[str, str] | None = None) -> DataFrame:
    """One direction of the fact, before the row-quality gate."""
    cols = [
        K.surrogate_key("codigo_ncm").alias("sk_ncm"),
        K.surrogate_key(pais_col).alias("sk_geografia"),
        K.state_key_or_unknown(uf_col).alias("sk_geografia_uf"),
        K.surrogate_key("codigo_via_transporte").alias("sk_via_transporte"),
        K.month_key("ano", "mes").alias("sk_data"),
        F.lit(tipo).alias("tipo_movimentacao"),
        K.measure("valor_fob_usd").alias("valor_fob"),
        K.measure("quantidade_estatistica").alias("quantidade"),
        K.measure("peso_liquido_kg").alias("kg_liquido"),
    ]
    for src, dst in (extra or {}).items():
        cols.append(K.measure(src).alias(dst))
    return df.select(*cols)


#: Why the quality gate rejects a row, and how to tell.
REJECT_REASONS = {"sk_ncm_nulo": "sk_ncm IS NULL", "sk_data_nulo": "sk_data IS NULL"}


def fact_gate(df: DataFrame) -> DataFrame:
    """Row-quality gate: a product or month key that did not cast is dropped."""
    return df.filter(F.col("sk_ncm").isNotNull()).filter(F.col("sk_data").isNotNull())


def flagged_fact(exp: DataFrame, imp: DataFrame, imp_extra: dict[str, str] | None = None,
                 sentinels: tuple[str, ...] = ()) -> DataFrame:
    """ft_balanco_comercial at source grain before the gate: exports ∪ imports by
    name (columns only one side has are null on the other), with ``rejeitada``
    and the reasons (``motivo``, null for a row that passes)."""
    e = fact_side(strip_sentinels(exp, sentinels), K.EXPORT, "codigo_pais_destino", "uf_origem")
    i = fact_side(strip_sentinels(imp, sentinels), K.IMPORT, "codigo_pais_origem", "uf_destino",
                  imp_extra)
    reasons = F.concat_ws(",", *[F.when(F.expr(test), name) for name, test in REJECT_REASONS.items()])
    rows = e.unionByName(i, allowMissingColumns=True)
    return rows.withColumns({"rejeitada": F.expr(" OR ".join(REJECT_REASONS.values())),
                             "motivo": F.nullif(reasons, F.lit(""))})


def gate_counts() -> list[Column]:
    """Aggregates over a flagged fact: rows, rows that pass, rejects by reason
    (a row with two reasons counts with both)."""
    n = lambda test, name: F.count(F.when(F.expr(test), 1)).alias(name)
    return [F.count(F.lit(1)).alias("linhas"), n("NOT rejeitada", "aceitas"),
            *[n(test, name) for name, test in REJECT_REASONS.items()]]


def build_fact(exp: DataFrame, imp: DataFrame, imp_extra: dict[str, str] | None = None,
               sentinels: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``flagged_fact`` that pass the gate."""
    return fact_gate(flagged_fact(exp, imp, imp_extra, sentinels).drop("rejeitada", "motivo"))


def clustered(fact: DataFrame, partition_by: list[str]) -> DataFrame:
    """The fact ranged and sorted by month and product, so that each file spans
    few months and a month filter skips the others. The partition columns lead:
    the writer requires that order and would otherwise sort anew."""
    order = [*partition_by, "sk_data", "sk_ncm"]
    return fact.repartitionByRange(*order).sortWithinPartitions(*order)


def fact_at_grain(fact: DataFrame) -> DataFrame:
    """The fact at its declared grain (product × country × state × mode × month
    × movement): partial sums per task, one shuffle on the grain keys."""
    return (fact.groupBy(*FACT_KEYS, "tipo_movimentacao")
            .agg(*[F.sum(m).cast("decimal(38,2)").alias(m) for m in FACT_MEASURES]))


def fact_derived_measures(fact: DataFrame) -> DataFrame:
    """Unit value, price per kg and direction flags (narrow, no shuffle)."""
    fob = F.col("valor_fob").cast("double")
    return fact.select(
        *FACT_KEYS, "tipo_movimentacao", *FACT_MEASURES,
        F.try_divide(fob, F.col("quantidade").cast("double")).alias("valor_unitario"),
        F.try_divide(fob, F.col("kg_liquido").cast("double")).alias("preco_kg"),
        F.when(F.col("tipo_movimentacao") == K.EXPORT, 1).otherwise(0).alias("flag_exportacao"),
        F.when(F.col("tipo_movimentacao") == K.IMPORT, 1).otherwise(0).alias("flag_importacao"),
    )


def union_all_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
