"""Silver-layer queries: name rules, string cleaning, dedup, null policy,
typing and validation, each on a dirty projection of a driver table that the
SQL twin plants identically."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.names import names_by_position
from tradestar.layouts import REGISTRY_LAYOUTS, TRADE_LAYOUTS
from tradestar.operators import silver as SV
from tradestar.plans.registry import register
from tradestar.sources import files as FS
from tradestar.sources import standins as S


# --------------------------------------------------------------------------- names
@register("normalize_headers", """
SELECT c_custkey AS codigo_cliente, c_name AS nome_do_cliente,
       c_mktsegment AS segmento_mercado, c_acctbal AS saldo_conta FROM customer""", raw_sql=True)
def q_normalize_headers(spark, d):
    df = S.table(spark, d, "customer").select(
        F.col("c_custkey").alias("Código Cliente"), F.col("c_name").alias("Nome do Cliente"),
        F.col("c_mktsegment").alias(" Segmento-Mercado "), F.col("c_acctbal").alias("Saldo Conta"))
    return SV.normalize_headers(df)


SUPPLIER_MAPPING = {"s_suppkey": "codigo_fornecedor", "s_name": "nome_fornecedor",
                    "s_phone": "telefone"}


@register("rename_by_mapping", """
SELECT s_suppkey AS codigo_fornecedor, s_name AS nome_fornecedor, s_nationkey, s_acctbal
FROM supplier""", raw_sql=True)
def q_rename_by_mapping(spark, d):
    return SV.rename_by_mapping(S.table(spark, d, "supplier"), SUPPLIER_MAPPING)


@register("rename_positional", """
SELECT s_suppkey AS codigo, s_name AS nome, s_nationkey, s_acctbal FROM supplier""", raw_sql=True)
def q_rename_positional(spark, d):
    return SV.rename_positional(S.table(spark, d, "supplier"), ["codigo", "nome"])


@register("positional_names", """
SELECT s_suppkey AS cnae, s_name AS descricao, s_nationkey AS _c2, s_acctbal AS _c3
FROM supplier""", raw_sql=True)
def q_positional_names(spark, d):
    df = S.table(spark, d, "supplier")
    return df.toDF(*names_by_position(REGISTRY_LAYOUTS["CNAECSV"], len(df.columns))[0])


@register("drop_foreign_columns", """
SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS codigo_ncm, p_name AS descricao_ncm_pt,
       p_size AS tamanho FROM part""", raw_sql=True)
def q_drop_foreign_columns(spark, d):
    df = S.table(spark, d, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("codigo_ncm"),
        F.col("p_name").alias("descricao_ncm_pt"),
        F.upper("p_name").alias("descricao_ncm_en"),
        F.lower("p_name").alias("descricao_ncm_es"),
        F.col("p_brand").alias("nome_ing"),
        F.col("p_type").alias("tipo_esp"),
        F.col("p_size").alias("tamanho"))
    return SV.drop_foreign_columns(df)


@register("project_by_mapping", """
SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS codigo_ncm,
       p_brand AS codigo_fator_agregacao, p_name AS descricao_ncm_pt,
       upper(p_name) AS descricao_ncm_en FROM part""", raw_sql=True)
def q_project_by_mapping(spark, d):
    df = S.table(spark, d, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("CO_NCM"),
        F.col("p_name").alias("NO_NCM_POR"),
        F.upper("p_name").alias("NO_NCM_ING"),
        F.col("p_brand").alias("CO_FAT_AGREG"),
        F.col("p_size").alias("TAMANHO"))
    return FS.project_by_mapping(df, TRADE_LAYOUTS["NCM"])


@register("rename_fallback", """
SELECT p_partkey AS "ncm_código", p_name AS "descrição_itn", p_type AS tipo FROM part""",
          raw_sql=True)
def q_rename_fallback(spark, d):
    df = S.table(spark, d, "part").select(
        F.col("p_partkey").alias("NCM Código"), F.col("p_name").alias("Descrição ITN"),
        F.col("p_type").alias("Tipo"))
    return SV.rename_fallback(df)


# --------------------------------------------------------------------------- values
def dirty_customer(spark, d):
    seg = F.col("c_mktsegment")
    return S.table(spark, d, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower(seg), F.lit(" ")).alias("segmento"),
        F.when(seg == "HOUSEHOLD", F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("c_name")))
        .alias("nome"),
        F.when(seg == "FURNITURE", F.lit(None)).otherwise(F.col("c_acctbal")).alias("saldo"),
        F.when(seg == "BUILDING", F.lit(None)).otherwise(F.col("c_nationkey")).alias("nacao"))


DIRTY_CUSTOMER_SQL = """
  SELECT c_custkey, '  ' || lower(c_mktsegment) || ' ' AS segmento,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE ' ' || c_name END AS nome,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS saldo,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS nacao
  FROM customer"""


@register("trim_strings", f"""
WITH dc AS ({DIRTY_CUSTOMER_SQL})
SELECT c_custkey, trim(segmento) AS segmento, trim(nome) AS nome, saldo, nacao FROM dc""",
          raw_sql=True)
def q_trim_strings(spark, d):
    return SV.trim_strings(dirty_customer(spark, d))


@register("upper_strings", f"""
WITH dc AS ({DIRTY_CUSTOMER_SQL})
SELECT c_custkey, upper(segmento) AS segmento, upper(nome) AS nome, saldo, nacao FROM dc""",
          raw_sql=True)
def q_upper_strings(spark, d):
    return SV.upper_strings(dirty_customer(spark, d))


@register("treat_nulls", f"""
WITH dc AS ({DIRTY_CUSTOMER_SQL})
SELECT c_custkey, coalesce(segmento, 'N/A') AS segmento, coalesce(nome, 'N/A') AS nome,
       coalesce(saldo, 0.0) AS saldo, coalesce(nacao, 0) AS nacao FROM dc""", raw_sql=True)
def q_treat_nulls(spark, d):
    return SV.treat_nulls(dirty_customer(spark, d))


def order_profile(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(F.col("o_orderstatus").alias("status"),
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prioridade"),
                    F.year("o_orderdate").alias("ano"))


@register("dedup_rows", """
SELECT DISTINCT o_orderstatus AS status, nullif(o_orderpriority, '5-LOW') AS prioridade,
       CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders""", raw_sql=True)
def q_dedup_rows(spark, d):
    return SV.dedup_rows(order_profile(spark, d))


def dirty_orders(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(
        F.concat(F.lit("  "), F.lower("o_orderstatus"), F.lit(" ")).alias("Situação"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("Prioridade"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.year("o_orderdate")).alias("Ano Pedido"))


@register("silver_clean", """
SELECT coalesce(situacao, 'N/A') AS situacao, coalesce(prioridade, 'N/A') AS prioridade,
       coalesce(ano_pedido, 0) AS ano_pedido
FROM (SELECT DISTINCT upper(trim('  ' || lower(o_orderstatus) || ' ')) AS situacao,
             upper(trim(nullif(o_orderpriority, '5-LOW'))) AS prioridade,
             CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                  ELSE CAST(year(o_orderdate) AS INTEGER) END AS ano_pedido
      FROM orders) t""", raw_sql=True)
def q_silver_clean(spark, d):
    return SV.silver_clean(dirty_orders(spark, d))


LOADS = (("2024-01-01 00:00:00", "Estabelecimentos0.zip"),
         ("2024-02-01 00:00:00", "Estabelecimentos1.zip"))
RELOADED_SEGMENTS = ("BUILDING", "MACHINERY")


def registry_loads(spark, d):
    est = S.estabelecimentos(spark, d).withColumn(
        "nome_fantasia", F.concat(F.lit(" "), F.lower("nome_fantasia"), F.lit(" ")))

    def stamp(df, ts, name):
        return df.select("*", F.lit(ts).cast("timestamp_ntz").alias("ingestion_timestamp"),
                         F.lit(name).alias("file_source"))

    first = stamp(est, *LOADS[0])
    again = stamp(est.filter(F.col("cnae_principal").isin(*RELOADED_SEGMENTS)), *LOADS[1])
    return first.unionByName(again)


@register("silver_clean_registry", f"""
WITH loads AS (
  SELECT *, TIMESTAMP '{LOADS[0][0]}' AS ingestion_timestamp, '{LOADS[0][1]}' AS file_source
  FROM estab
  UNION ALL
  SELECT *, TIMESTAMP '{LOADS[1][0]}', '{LOADS[1][1]}' FROM estab
  WHERE cnae_principal IN {RELOADED_SEGMENTS}
), clean AS (
  SELECT upper(trim(cnpj_basico)) AS cnpj_basico, upper(trim(cnpj_ordem)) AS cnpj_ordem,
         upper(trim(' ' || lower(nome_fantasia) || ' ')) AS nome_fantasia,
         upper(trim(situacao_cadastral)) AS situacao_cadastral,
         upper(trim(cnae_principal)) AS cnae_principal, upper(trim(uf)) AS uf,
         ingestion_timestamp, upper(trim(file_source)) AS file_source
  FROM loads
)
SELECT cnpj_basico, cnpj_ordem, coalesce(nome_fantasia, 'N/A') AS nome_fantasia,
       coalesce(situacao_cadastral, 'N/A') AS situacao_cadastral, cnae_principal, uf,
       ingestion_timestamp, file_source
FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_basico, cnpj_ordem, nome_fantasia,
             situacao_cadastral, cnae_principal, uf
             ORDER BY ingestion_timestamp DESC, file_source DESC) AS rn FROM clean) x
WHERE rn = 1""")
def q_silver_clean_registry(spark, d):
    return SV.silver_clean_registry(registry_loads(spark, d))


# --------------------------------------------------------------------------- typing
BAD_QUANTITY = "abc"


def lineitem_as_text(spark, d):
    li = S.table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit(BAD_QUANTITY))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("l_extendedprice"),
        F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"),
        F.col("l_returnflag"))


LINEITEM_TEXT_SQL = f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN '{BAD_QUANTITY}'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS l_quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS l_extendedprice,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_returnflag
  FROM lineitem"""

LINEITEM_TYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "decimal(18,2)",
                  "l_extendedprice": "decimal(18,2)", "l_shipdate": "date"}
_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "decimal(18,2)": "DECIMAL(18,2)", "date": "DATE"}


def _fail_sql(c: str, t: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {_DUCK[t]}) IS NULL THEN '{c}' END"


@register("typed_columns", f"""
WITH lt AS ({LINEITEM_TEXT_SQL})
SELECT {", ".join(f"TRY_CAST({c} AS {_DUCK[t]}) AS {c}" for c, t in LINEITEM_TYPES.items())},
       l_returnflag,
       nullif(concat_ws(',', {", ".join(_fail_sql(c, t) for c, t in LINEITEM_TYPES.items())}), '')
         AS erro_tipagem
FROM lt""", raw_sql=True)
def q_typed_columns(spark, d):
    return SV.typed_columns(lineitem_as_text(spark, d), LINEITEM_TYPES)


EXPECTED_LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DecimalType(18, 2)),
    T.StructField("l_extendedprice", T.DecimalType(18, 2)),
    T.StructField("l_shipdate", T.DateType()),
])


@register("validate_schema", f"""
WITH lt AS ({LINEITEM_TEXT_SQL})
SELECT 'l_linenumber' AS coluna, 'missing' AS problema, 'int' AS esperado,
       CAST(NULL AS VARCHAR) AS encontrado, CAST(NULL AS BIGINT) AS n_linhas
UNION ALL SELECT 'l_returnflag', 'unexpected', NULL, 'string', NULL
UNION ALL
SELECT * FROM (
  SELECT 'l_orderkey', 'invalid_values', 'bigint', 'string',
         count(CASE WHEN l_orderkey IS NOT NULL AND TRY_CAST(l_orderkey AS BIGINT) IS NULL THEN 1 END)
  FROM lt
  UNION ALL
  SELECT 'l_quantity', 'invalid_values', 'decimal(18,2)', 'string',
         count(CASE WHEN l_quantity IS NOT NULL AND TRY_CAST(l_quantity AS DECIMAL(18,2)) IS NULL
                    THEN 1 END) FROM lt
  UNION ALL
  SELECT 'l_extendedprice', 'invalid_values', 'decimal(18,2)', 'string',
         count(CASE WHEN l_extendedprice IS NOT NULL
                     AND TRY_CAST(l_extendedprice AS DECIMAL(18,2)) IS NULL THEN 1 END) FROM lt
  UNION ALL
  SELECT 'l_shipdate', 'invalid_values', 'date', 'string',
         count(CASE WHEN l_shipdate IS NOT NULL AND TRY_CAST(l_shipdate AS DATE) IS NULL THEN 1 END)
  FROM lt) v(coluna, problema, esperado, encontrado, n_linhas)
WHERE n_linhas > 0""", raw_sql=True)
def q_validate_schema(spark, d):
    return SV.validate_schema(lineitem_as_text(spark, d).drop("l_linenumber"), EXPECTED_LINEITEM)
