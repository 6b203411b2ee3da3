"""Quality, catalogue, masking, versioned-lookup and streaming queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradestar.operators import quality as Q
from tradestar.plans import q_gold as QG
from tradestar.plans.registry import register
from tradestar.session import scratch_path
from tradestar.sources import standins as S
from tradestar.streaming import ingest as ST

# Columns of the driver tables profiled by the catalogue.
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _tables(spark, d):
    return {t: S.table(spark, d, t).select(*cols) for t, cols in TABLE_COLUMNS.items()}


@register("catalog_profile", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos "
    f"FROM {t}" for t, cols in TABLE_COLUMNS.items() for c in cols), raw_sql=True)
def q_catalog_profile(spark, d):
    return Q.catalog_profile(_tables(spark, d), with_type=False)


@register("run_report", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS entidade, count(*) AS linhas, "
    f"CASE WHEN count(*) > 0 THEN 'OK' ELSE 'VAZIO' END AS status, "
    f"CASE WHEN count(*) = 0 THEN 'entrada vazia, ignorada' END AS mensagem FROM {t}"
    for t in TABLE_COLUMNS), raw_sql=True)
def q_run_report(spark, d):
    return Q.run_report(_tables(spark, d))


@register("mask_columns", """
SELECT c_custkey, sha256(c_name) AS c_name,
       repeat('*', greatest(length(lpad(CAST(c_custkey AS VARCHAR), 8, '0')) - 2, 0))
         || right(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 2) AS cnpj_basico,
       c_mktsegment
FROM customer""", raw_sql=True)
def q_mask_columns(spark, d):
    df = S.table(spark, d, "customer").select(
        "c_custkey", "c_name", F.lpad(F.col("c_custkey").cast("string"), 8, "0")
        .alias("cnpj_basico"), "c_mktsegment")
    return Q.mask_columns(df, hashed=["c_name"], partial={"cnpj_basico": 2})


# Versioned product-type -> economic sector mapping (three versions; the third
# starts after the as-of date and must not be chosen).
SECTOR_MAPPING = [
    ("ECONOMY", "AGROPECUARIA", 1, dt.date(2020, 1, 1)),
    ("LARGE", "INDUSTRIA", 1, dt.date(2020, 1, 1)),
    ("MEDIUM", "INDUSTRIA", 1, dt.date(2020, 1, 1)),
    ("PROMO", "COMERCIO", 1, dt.date(2020, 1, 1)),
    ("SMALL", "SERVICOS", 1, dt.date(2020, 1, 1)),
    ("STANDARD", "INDUSTRIA", 1, dt.date(2020, 1, 1)),
    ("ECONOMY", "AGRONEGOCIO", 2, dt.date(2023, 7, 1)),
    ("PROMO", "VAREJO", 2, dt.date(2023, 7, 1)),
    ("SMALL", "FUTURO", 3, dt.date(2030, 1, 1)),
]
AS_OF = "2024-12-31"


def _mapping_values_sql() -> str:
    return ", ".join(f"('{c}', '{s}', {v}, DATE '{d.isoformat()}')" for c, s, v, d in SECTOR_MAPPING)


@register("map_versioned_lookup", f"""
WITH m AS (SELECT * FROM (VALUES {_mapping_values_sql()}) t(codigo_ppe, setor_economico, versao,
                                                          vigente_desde)),
cur AS (SELECT codigo_ppe, versao, setor_economico FROM (
          SELECT *, row_number() OVER (PARTITION BY codigo_ppe
                                       ORDER BY versao DESC, setor_economico DESC) AS rn
          FROM m WHERE vigente_desde <= DATE '{AS_OF}') x WHERE rn = 1)
SELECT n.codigo_ncm, n.codigo_ppe_exportacao, c.versao, c.setor_economico
FROM ncm n LEFT JOIN cur c ON n.codigo_ppe_exportacao = c.codigo_ppe""")
def q_map_versioned_lookup(spark, d):
    mapping = spark.createDataFrame(
        SECTOR_MAPPING, "codigo_ppe string, setor_economico string, versao int, vigente_desde date")
    ncm = S.ncm(spark, d).select("codigo_ncm", "codigo_ppe_exportacao")
    return Q.versioned_lookup(ncm, mapping, key="codigo_ppe_exportacao", map_key="codigo_ppe",
                              version_col="versao", valid_from_col="vigente_desde",
                              as_of=AS_OF, value_cols=["setor_economico"]).select(
        "codigo_ncm", "codigo_ppe_exportacao", "versao", "setor_economico")


# --------------------------------------------------------------------------- integrity
REMOVED_COUNTRY = 0
REMOVED_STATE = "AF"


def _orphan_sql(fk: str, dim: str, col: str) -> str:
    return (f"SELECT '{fk}' AS chave_estrangeira, count(*) AS linhas_orfas, "
            f"count(DISTINCT f.{fk}) AS chaves_orfas FROM fact f WHERE f.{fk} IS NOT NULL AND "
            f"NOT EXISTS (SELECT 1 FROM {dim} x WHERE x.{col} = f.{fk})")


@register("fk_orphans", f"""
WITH geo_cut AS (SELECT * FROM dim_geo WHERE sk_geografia <> {REMOVED_COUNTRY}
                 AND NOT (nivel = 'UF' AND sigla = '{REMOVED_STATE}'))
""" + "\nUNION ALL\n".join([
    _orphan_sql("sk_ncm", "dim_ncm", "sk_ncm"),
    _orphan_sql("sk_geografia", "geo_cut", "sk_geografia"),
    _orphan_sql("sk_geografia_uf", "geo_cut", "sk_geografia"),
    _orphan_sql("sk_via_transporte", "dim_via", "sk_via_transporte"),
    _orphan_sql("sk_data", "dim_data", "sk_data")]))
def q_fk_orphans(spark, d):
    g = QG.stored(spark, d)
    geo = g["dim_geografia"].filter(
        (F.col("sk_geografia") != REMOVED_COUNTRY)
        & ~((F.col("nivel") == "UF") & (F.col("sigla") == REMOVED_STATE)))
    dims = {"sk_ncm": (g["dim_ncm"], "sk_ncm"),
            "sk_geografia": (geo, "sk_geografia"),
            "sk_geografia_uf": (geo, "sk_geografia"),
            "sk_via_transporte": (g["dim_via_transporte"], "sk_via_transporte"),
            "sk_data": (g["dim_data"], "sk_data")}
    return Q.fk_orphans(g["ft_balanco_comercial"], dims)


def _plant(df):
    alf = F.col("codigo_alfandega")
    return df.withColumns({
        "codigo_ncm": F.when(alf == "7", F.lit("N/A")).otherwise(F.col("codigo_ncm")),
        "mes": F.when(alf == "6", F.lit(13)).otherwise(F.col("mes"))})


def _plant_sql(src: str) -> str:
    return (f"SELECT * REPLACE (CASE WHEN codigo_alfandega = '7' THEN 'N/A' ELSE codigo_ncm END "
            f"AS codigo_ncm, CASE WHEN codigo_alfandega = '6' THEN 13 ELSE mes END AS mes) "
            f"FROM {src}")


def _rejects_sql(src: str, tipo: str) -> str:
    return f"""
  SELECT '{tipo}' AS tipo_movimentacao, codigo_ncm, ano, mes,
         TRY_CAST(valor_fob_usd AS DECIMAL(18,2)) AS valor_fob,
         concat_ws(',', CASE WHEN TRY_CAST(codigo_ncm AS BIGINT) IS NULL THEN 'sk_ncm_nulo' END,
                   CASE WHEN ano * 100 + mes IS NULL THEN 'sk_data_nulo' END,
                   CASE WHEN NOT (mes BETWEEN 1 AND 12) THEN 'mes_invalido' END) AS motivo
  FROM {src}
  WHERE TRY_CAST(codigo_ncm AS BIGINT) IS NULL OR ano * 100 + mes IS NULL
        OR NOT (mes BETWEEN 1 AND 12)"""


@register("fact_rejects", f"""
WITH exp_bad AS ({_plant_sql('exp')}), imp_bad AS ({_plant_sql('imp')})
{_rejects_sql('exp_bad', 'EXPORTACAO')}
UNION ALL
{_rejects_sql('imp_bad', 'IMPORTACAO')}""")
def q_fact_rejects(spark, d):
    e, i = QG.exp_imp(spark, d)
    return Q.fact_rejects(_plant(e), _plant(i))


# --------------------------------------------------------------------------- streaming
@register("stream_ingest_available_now", "SELECT * FROM events", raw_sql=True)
def q_stream_ingest_available_now(spark, d):
    """File stream -> parquet sink, run to completion twice (the second run
    finds nothing new), then the sink is read back."""
    sink = scratch_path(spark, "stream", "events")
    schema = S.table(spark, d, "events").schema
    for _ in range(2):
        ST.run_available_now(ST.file_stream(spark, d, schema, "parquet", "events.parquet"),
                             sink + "/data", sink + "/_checkpoint")
    return spark.read.parquet(sink + "/data")


def daily_event_counts(df):
    return (df.groupBy(F.to_date("ts").alias("dia"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col("value").cast("decimal(18,2)")).alias("valor")))


@register("stream_foreach_batch", """
SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS valor
FROM events GROUP BY CAST(ts AS DATE), event_type""", raw_sql=True)
def q_stream_foreach_batch(spark, d):
    """Per micro-batch callback writing an idempotent ``batch_id`` partition;
    the read-back folds the batches together."""
    out = scratch_path(spark, "stream", "events_daily")
    schema = S.table(spark, d, "events").schema
    ST.run_foreach_batch(ST.file_stream(spark, d, schema, "parquet", "events.parquet"),
                         out + "/_checkpoint",
                         ST.idempotent_batch_writer(out + "/data", daily_event_counts))
    back = spark.read.parquet(out + "/data")
    return (back.groupBy("dia", "event_type")
            .agg(F.sum("n").cast("bigint").alias("n"),
                 F.sum("valor").cast("decimal(38,2)").alias("valor")))


