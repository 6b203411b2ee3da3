"""Reports in Spark SQL over the stored gold star.

Consumers of the lake send SQL; the star is handed to ``spark.sql`` as named
tables, so nothing is registered and no text is rewritten. Each report is
checked against the given tables (the oracles of the marts), not against itself.
"""

from __future__ import annotations

from tradestar.plans import q_gold as QG
from tradestar.plans.registry import register

EXPORT_VALUE = "sum(valor_fob) FILTER (WHERE tipo_movimentacao = 'EXPORTACAO')"
IMPORT_VALUE = "sum(valor_fob) FILTER (WHERE tipo_movimentacao = 'IMPORTACAO')"

BALANCE = f"""
SELECT ano, mes, nome_mes, CAST(e AS DECIMAL(38,2)) AS total_exportacao,
       CAST(i AS DECIMAL(38,2)) AS total_importacao, CAST(e - i AS DECIMAL(38,2)) AS saldo_comercial
FROM (SELECT sk_data, coalesce({EXPORT_VALUE}, 0) AS e, coalesce({IMPORT_VALUE}, 0) AS i
      FROM {{fato}} GROUP BY sk_data)
JOIN {{calendario}} USING (sk_data) WHERE ano >= {QG.MIN_YEAR}"""

QUARTERS = """
SELECT ano, trimestre, CAST(sum(v) AS DECIMAL(38,2)) AS total_exportado
FROM (SELECT sk_data, sum(valor_fob) AS v FROM {fato} WHERE tipo_movimentacao = 'EXPORTACAO' GROUP BY sk_data)
JOIN {calendario} USING (sk_data) GROUP BY ano, trimestre"""

PRODUCTS = f"""
SELECT codigo_ncm, nome_ncm, nomenclatura_ppe, CAST(v AS DECIMAL(38,2)) AS valor_total_exportado,
       CAST(kg AS DECIMAL(38,2)) AS peso_liquido_total
FROM (SELECT sk_ncm, sum(valor_fob) AS v, sum(kg_liquido) AS kg FROM {{fato}}
      WHERE tipo_movimentacao = 'EXPORTACAO' AND sk_data BETWEEN {QG.TOP_FROM} AND {QG.TOP_TO} GROUP BY sk_ncm)
JOIN {{produto}} USING (sk_ncm) ORDER BY v DESC, codigo_ncm LIMIT {QG.TOP_K}"""

PARTNERS = """
SELECT nome_geografia, nivel, CAST(sum(v) AS DECIMAL(38,2)) AS valor_total
FROM (SELECT sk_geografia, sum(valor_fob) AS v FROM {fato} WHERE tipo_movimentacao = 'IMPORTACAO'
      GROUP BY sk_geografia)
JOIN {geografia} USING (sk_geografia) GROUP BY nome_geografia, nivel"""

TRANSPORT = """
SELECT nome_via, tipo_movimentacao, CAST(sum(v) AS DECIMAL(38,2)) AS valor_total,
       CAST(sum(kg) AS DECIMAL(38,2)) AS peso_total_kg
FROM (SELECT sk_via_transporte, tipo_movimentacao, sum(valor_fob) AS v, sum(kg_liquido) AS kg
      FROM {fato} GROUP BY sk_via_transporte, tipo_movimentacao)
JOIN {via} USING (sk_via_transporte) GROUP BY nome_via, tipo_movimentacao"""

VOCATION = f"""
SELECT uf, descricao AS atividade_economica, CAST(sum(Total_empresas) AS BIGINT) AS total_estabelecimentos
FROM {{distribuicao}} WHERE uf = '{QG.VOCATION_STATE}' GROUP BY uf, descricao
ORDER BY total_estabelecimentos DESC, atividade_economica LIMIT {QG.TOP_K}"""


def report(spark, d, text: str):
    """Run a report over this folder's stored star."""
    star = QG.stored(spark, d)
    tables = {"fato": star["ft_balanco_comercial"], "calendario": star["dim_data"], "produto": star["dim_ncm"],
              "geografia": star["dim_geografia"], "via": star["dim_via_transporte"]}
    if "{distribuicao}" in text:
        tables["distribuicao"] = QG.distribution_of(spark, d)
    return spark.sql(text, **{k: v for k, v in tables.items() if "{" + k + "}" in text})


def _bind(key: str, text: str, oracle: str) -> None:
    register(key, oracle, raw_sql=True)(lambda spark, d: report(spark, d, text))


_bind("sql_monthly_balance", BALANCE, QG.BALANCE_SQL)
_bind("sql_quarterly_exports", QUARTERS, QG.QUARTERS_SQL)
_bind("sql_top_products", PRODUCTS, QG.PRODUCTS_SQL)
_bind("sql_partners", PARTNERS, QG.PARTNERS_SQL)
_bind("sql_transport", TRANSPORT, QG.TRANSPORT_SQL)
_bind("sql_state_vocation", VOCATION, QG.VOCATION_SQL)
