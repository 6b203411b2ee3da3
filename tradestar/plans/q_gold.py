"""Gold-layer and mart queries on the driver's tables.

Callables take ``(spark, sf_dir)`` and return a lazy DataFrame over the whole
tables; nothing is collected. Gold keys build the star from the stored trusted
tables; marts read the stored gold star (``plans.trusted``). Report parameters
(years, state, top-k) are fixed here because the test data spans 1995-2001 and
uses region codes as states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.functions import keys as K
from tradestar.operators import gold as G
from tradestar.operators import marts as M
from tradestar.plans import trusted
from tradestar.plans.registry import register
from tradestar.session import scratch_path
from tradestar.sources import sinks as SK
from tradestar.sources import standins as S

# Report parameters.
MIN_YEAR = 1998
TOP_FROM, TOP_TO = 199801, 199812
VOCATION_STATE = "AM"
TOP_K = 10


# --------------------------------------------------------------------------- gold inputs
def exp_imp(spark, d):
    """Trusted exp/imp, stored once per application (see ``plans.trusted``)."""
    return trusted.exp_imp(spark, d)


def fact_of(spark, d) -> DataFrame:
    e, i = exp_imp(spark, d)
    return G.build_fact(e, i)


def dim_date_of(spark, d) -> DataFrame:
    e, i = exp_imp(spark, d)
    return G.build_dim_date(e, i)


def dim_product_of(spark, d, enriched: bool = False) -> DataFrame:
    if enriched:
        return G.build_dim_product(S.ncm(spark, d), S.ncm_fat_agreg(spark, d), S.ncm_ppe(spark, d))
    return G.build_dim_product(S.ncm(spark, d))


def dim_geo_of(spark, d, enriched: bool = False) -> DataFrame:
    e, i = exp_imp(spark, d)
    return G.build_dim_geography(S.pais(spark, d), S.pais_bloco(spark, d), e, i,
                                 S.uf(spark, d) if enriched else None)


def dim_transport_of(spark, d) -> DataFrame:
    return G.build_dim_transport(S.via(spark, d))


def distribution_of(spark, d) -> DataFrame:
    return M.establishment_distribution(S.estabelecimentos(spark, d), S.empresas(spark, d),
                                        S.cnaes(spark, d), S.ACTIVE_STATUS)


def stored(spark, d) -> dict[str, DataFrame]:
    """The stored gold star (marts read it, as they read gold in the pipeline)."""
    return trusted.gold_tables(spark, d)


# --------------------------------------------------------------------------- M0/M1 gold
@register("dim_date", "SELECT * FROM dim_data")
def q_dim_date(spark, d):
    return dim_date_of(spark, d)


@register("fact_unified", "SELECT * FROM fact")
def q_fact_unified(spark, d):
    return fact_of(spark, d)


@register("dim_product", "SELECT * FROM dim_ncm")
def q_dim_product(spark, d):
    return dim_product_of(spark, d)


@register("dim_product_enriched", "SELECT * FROM dim_ncm_enriched")
def q_dim_product_enriched(spark, d):
    return dim_product_of(spark, d, enriched=True)


@register("dim_transport", "SELECT * FROM dim_via")
def q_dim_transport(spark, d):
    return dim_transport_of(spark, d)


@register("dim_geography", "SELECT * FROM dim_geo")
def q_dim_geography(spark, d):
    return dim_geo_of(spark, d)


@register("dim_geography_enriched", "SELECT * FROM dim_geo_enriched")
def q_dim_geography_enriched(spark, d):
    return dim_geo_of(spark, d, enriched=True)


@register("fact_at_grain", """
SELECT sk_ncm, sk_geografia, sk_geografia_uf, sk_via_transporte, sk_data, tipo_movimentacao,
       CAST(sum(valor_fob) AS DECIMAL(38,2)) AS valor_fob,
       CAST(sum(quantidade) AS DECIMAL(38,2)) AS quantidade,
       CAST(sum(kg_liquido) AS DECIMAL(38,2)) AS kg_liquido
FROM fact
GROUP BY sk_ncm, sk_geografia, sk_geografia_uf, sk_via_transporte, sk_data, tipo_movimentacao""")
def q_fact_at_grain(spark, d):
    return G.fact_at_grain(fact_of(spark, d))


@register("fact_derived_measures", """
SELECT sk_ncm, sk_geografia, sk_geografia_uf, sk_via_transporte, sk_data, tipo_movimentacao,
       valor_fob, quantidade, kg_liquido,
       CAST(valor_fob AS DOUBLE) / NULLIF(CAST(quantidade AS DOUBLE), 0) AS valor_unitario,
       CAST(valor_fob AS DOUBLE) / NULLIF(CAST(kg_liquido AS DOUBLE), 0) AS preco_kg,
       CASE WHEN tipo_movimentacao = 'EXPORTACAO' THEN 1 ELSE 0 END AS flag_exportacao,
       CASE WHEN tipo_movimentacao = 'IMPORTACAO' THEN 1 ELSE 0 END AS flag_importacao
FROM fact""")
def q_fact_derived_measures(spark, d):
    return G.fact_derived_measures(fact_of(spark, d))


@register("surrogate_keys", """
SELECT codigo, TRY_CAST(codigo AS BIGINT) AS sk
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'N/A'
                  ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS codigo FROM orders) t""")
def q_surrogate_keys(spark, d):
    codes = S.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A"))
        .otherwise(F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("codigo"))
    return codes.select("codigo", K.surrogate_key("codigo").alias("sk"))


# --------------------------------------------------------------------------- M2 marts
# The reports' oracles read the given tables, not the star: a line item is an
# export when its status is 'O', its month is its ship date's, its value the
# extended price, its weight quantity times the part's size.
_VALUE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_WEIGHT = "CAST(CAST(l_quantity AS DECIMAL(18,2)) * p_size AS DECIMAL(18,2))"
_MONTHS = ", ".join(f"({k}, '{v}')" for k, v in K.MONTH_NAMES_PT.items())
# country 7 has a twin in the country table; its smaller code names it
_COUNTRY = f"CASE WHEN n_nationkey = {int(S.TWIN_COUNTRY[0])} THEN '{S.TWIN_COUNTRY[2]}' ELSE n_name END"
_LINES = """
  lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey"""


def _money(expr: str) -> str:
    return f"CAST(sum({expr}) AS DECIMAL(38,2))"


BALANCE_SQL = f"""
SELECT year(l_shipdate)::INTEGER AS ano, month(l_shipdate)::INTEGER AS mes, m.nome AS nome_mes,
       {_money(f"CASE l_linestatus WHEN 'O' THEN {_VALUE} ELSE 0 END")} AS total_exportacao,
       {_money(f"CASE l_linestatus WHEN 'F' THEN {_VALUE} ELSE 0 END")} AS total_importacao,
       {_money(f"CASE l_linestatus WHEN 'O' THEN {_VALUE} ELSE -{_VALUE} END")} AS saldo_comercial
FROM {_LINES} JOIN (VALUES {_MONTHS}) m(numero, nome) ON m.numero = month(l_shipdate)
WHERE year(l_shipdate) >= {MIN_YEAR} GROUP BY ALL"""

QUARTERS_SQL = f"""
SELECT year(l_shipdate)::INTEGER AS ano, quarter(l_shipdate)::INTEGER AS trimestre,
       {_money(_VALUE)} AS total_exportado
FROM {_LINES} WHERE l_linestatus = 'O' GROUP BY ALL"""

PRODUCTS_SQL = f"""
SELECT lpad(p_partkey::VARCHAR, 8, '0') AS codigo_ncm, p_name AS nome_ncm, p_type AS nomenclatura_ppe,
       {_money(_VALUE)} AS valor_total_exportado, {_money(_WEIGHT)} AS peso_liquido_total
FROM {_LINES}
WHERE l_linestatus = 'O' AND year(l_shipdate) * 100 + month(l_shipdate) BETWEEN {TOP_FROM} AND {TOP_TO}
GROUP BY ALL ORDER BY valor_total_exportado DESC, codigo_ncm LIMIT {TOP_K}"""

PARTNERS_SQL = f"""
SELECT {_COUNTRY} AS nome_geografia, 'PAIS' AS nivel, {_money(_VALUE)} AS valor_total
FROM {_LINES} JOIN nation ON n_nationkey = s_nationkey WHERE l_linestatus = 'F' GROUP BY ALL"""

PARTNER_STATE_SQL = f"""
SELECT {_COUNTRY.replace("n_", "t.n_")} AS pais, r_name[1:2] AS uf,
       CASE l_linestatus WHEN 'O' THEN 'EXPORTACAO' ELSE 'IMPORTACAO' END AS tipo_movimentacao,
       {_money(_VALUE)} AS valor_total
FROM {_LINES} JOIN nation t ON t.n_nationkey = s_nationkey
JOIN nation h ON h.n_nationkey = c_nationkey JOIN region ON r_regionkey = h.n_regionkey GROUP BY ALL"""

TRANSPORT_SQL = f"""
SELECT o_orderpriority[3:] AS nome_via,
       CASE l_linestatus WHEN 'O' THEN 'EXPORTACAO' ELSE 'IMPORTACAO' END AS tipo_movimentacao,
       {_money(_VALUE)} AS valor_total, {_money(_WEIGHT)} AS peso_total_kg
FROM {_LINES} GROUP BY ALL"""

_ACTIVITY = "lower(c_mktsegment)"
VOCATION_SQL = f"""
SELECT r_name[1:2] AS uf, {_ACTIVITY} AS atividade_economica, count(*) AS total_estabelecimentos
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE c_acctbal > 0 AND r_name[1:2] = '{VOCATION_STATE}'
GROUP BY ALL ORDER BY total_estabelecimentos DESC, atividade_economica LIMIT {TOP_K}"""


@register("mart_monthly_balance", BALANCE_SQL, raw_sql=True)
def q_mart_monthly_balance(spark, d):
    g = stored(spark, d)
    return M.mart_monthly_balance(g["ft_balanco_comercial"], g["dim_data"], MIN_YEAR)


@register("mart_quarterly_exports", QUARTERS_SQL, raw_sql=True)
def q_mart_quarterly_exports(spark, d):
    g = stored(spark, d)
    return M.mart_quarterly_exports(g["ft_balanco_comercial"], g["dim_data"])


@register("mart_top_products", PRODUCTS_SQL, raw_sql=True)
def q_mart_top_products(spark, d):
    g = stored(spark, d)
    return M.mart_top_products(g["ft_balanco_comercial"], g["dim_ncm"], TOP_FROM, TOP_TO, TOP_K)


@register("mart_partners", PARTNERS_SQL, raw_sql=True)
def q_mart_partners(spark, d):
    g = stored(spark, d)
    return M.mart_partners(g["ft_balanco_comercial"], g["dim_geografia"], K.IMPORT)


@register("mart_partner_state", PARTNER_STATE_SQL, raw_sql=True)
def q_mart_partner_state(spark, d):
    g = stored(spark, d)
    return M.mart_partner_state(g["ft_balanco_comercial"], g["dim_geografia"])


@register("mart_transport", TRANSPORT_SQL, raw_sql=True)
def q_mart_transport(spark, d):
    g = stored(spark, d)
    return M.mart_transport(g["ft_balanco_comercial"], g["dim_via_transporte"])


@register("kpi_monthly", "SELECT * FROM kpi")
def q_kpi_monthly(spark, d):
    g = stored(spark, d)
    return M.kpi_monthly(g["ft_balanco_comercial"], g["dim_data"])


def _pct(c: str, p: str) -> str:
    return f"CAST({c} - {p} AS DOUBLE) / CAST(NULLIF({p}, 0) AS DOUBLE)"


@register("kpi_mom_yoy", "SELECT k.sk_data, k.ano, k.mes, k.exportacao, k.importacao, k.saldo, "
          "k.corrente, " + ", ".join(
              f"{_pct('k.' + c, 'm.' + c)} AS {c}_mom, {_pct('k.' + c, 'y.' + c)} AS {c}_yoy"
              for c in M.KPI_COLUMNS) + """
FROM kpi k
LEFT JOIN kpi m ON k.ano * 12 + k.mes = m.ano * 12 + m.mes + 1
LEFT JOIN kpi y ON k.ano * 12 + k.mes = y.ano * 12 + y.mes + 12""")
def q_kpi_mom_yoy(spark, d):
    g = stored(spark, d)
    return M.kpi_mom_yoy(M.kpi_monthly(g["ft_balanco_comercial"], g["dim_data"]))


@register("agg_monthly_snapshot", """
SELECT sk_data, tipo_movimentacao, sk_geografia,
       CAST(sum(valor_fob) AS DECIMAL(38,2)) AS valor_fob,
       CAST(sum(kg_liquido) AS DECIMAL(38,2)) AS kg_liquido,
       CAST(sum(quantidade) AS DECIMAL(38,2)) AS quantidade,
       count(*) AS n_registros
FROM fact GROUP BY sk_data, tipo_movimentacao, sk_geografia""")
def q_agg_monthly_snapshot(spark, d):
    """Written by month with dynamic overwrite, twice: a second load of the later
    months replaces theirs and leaves the others; then read back."""
    path = scratch_path(spark, "tables", "agregado_mensal")
    snapshot = M.agg_monthly_snapshot(stored(spark, d)["ft_balanco_comercial"])
    SK.write_snapshot(snapshot, path, ["sk_data"])
    SK.write_snapshot(snapshot.filter(F.col("sk_data") >= MIN_YEAR * 100), path, ["sk_data"])
    return spark.read.parquet(path).select(*snapshot.columns).withColumn("sk_data", F.col("sk_data").cast("bigint"))


# --------------------------------------------------------------------------- M6 registry marts
@register("establishment_distribution", "SELECT * FROM distribuicao")
def q_establishment_distribution(spark, d):
    return distribution_of(spark, d)


@register("mart_state_vocation", VOCATION_SQL, raw_sql=True)
def q_mart_state_vocation(spark, d):
    """From the stored distribution, of which only the state's folder is read."""
    return M.mart_state_vocation(stored(spark, d)["dim_distribuicao_estabelecimentos"], VOCATION_STATE, TOP_K)


@register("union_missing_columns", "SELECT * FROM (" + """
    SELECT * FROM fact_raw_extra) u WHERE sk_ncm IS NOT NULL AND sk_data IS NOT NULL""")
def q_union_missing_columns(spark, d):
    e, i = exp_imp(spark, d)
    return G.build_fact(e, i, imp_extra={"valor_frete_usd": "valor_frete",
                                         "valor_seguro_usd": "valor_seguro"})


@register("audit_column", """
SELECT sk_via_transporte, codigo_via, nome_via, TRUE AS tem_auditoria FROM dim_via""")
def q_audit_column(spark, d):
    dim = G.add_audit(dim_transport_of(spark, d))
    return dim.select("sk_via_transporte", "codigo_via", "nome_via",
                      F.col(G.AUDIT_COLUMN).isNotNull().alias("tem_auditoria"))
