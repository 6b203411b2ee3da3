"""ANSI SQL twins of the stand-ins and gold objects, for the DuckDB oracle.

Every CTE mirrors one DataFrame builder; a query's oracle is
``WITH <all CTEs> SELECT ...``. Unused CTEs are never evaluated.
"""

from __future__ import annotations

from tradestar.functions.keys import MONTH_NAMES_PT
from tradestar.sources import standins as S

_MONTH_CASE = "CASE mes " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in MONTH_NAMES_PT.items()) + " END"


def state_key_sql(expr: str) -> str:
    return (f"CAST(ascii(substring({expr}, 1, 1)) * 100 + "
            f"ascii(substring({expr}, 2, 1)) AS BIGINT)")


def first_of_month_sql(ano: str = "ano", mes: str = "mes") -> str:
    return (f"CASE WHEN {ano} IS NOT NULL AND {mes} IS NOT NULL THEN CAST(try_strptime("
            f"lpad(CAST({ano} AS VARCHAR), 4, '0') || '-' || lpad(CAST({mes} AS VARCHAR), 2, '0')"
            f" || '-01', '%Y-%m-%d') AS DATE) END")


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


CTES: dict[str, str] = {}

CTES["cust_uf"] = """
  SELECT c.c_custkey, substring(r.r_name, 1, 2) AS uf
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["trade"] = f"""
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano, CAST(month(l.l_shipdate) AS INTEGER) AS mes,
         lpad(CAST(l.l_partkey AS VARCHAR), 8, '0') AS codigo_ncm,
         l.l_returnflag AS unidade_estatistica,
         CAST(s.s_nationkey AS VARCHAR) AS codigo_pais, cu.uf AS uf,
         substring(o.o_orderpriority, 1, 1) AS codigo_via_transporte,
         CAST(l.l_linenumber AS VARCHAR) AS codigo_alfandega,
         l.l_linestatus AS fluxo,
         {dec('l.l_quantity')} AS quantidade_estatistica,
         {dec(dec('l.l_quantity') + ' * p.p_size')} AS peso_liquido_kg,
         {dec('l.l_extendedprice')} AS valor_fob_usd,
         {dec(dec('l.l_extendedprice') + ' * ' + dec('l.l_tax'))} AS valor_frete_usd,
         {dec(dec('l.l_extendedprice') + ' * ' + dec('l.l_discount'))} AS valor_seguro_usd
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN cust_uf cu ON o.o_custkey = cu.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey"""

CTES["exp"] = """
  SELECT ano, mes, codigo_ncm, unidade_estatistica, codigo_pais AS codigo_pais_destino,
         uf AS uf_origem, codigo_via_transporte, codigo_alfandega, quantidade_estatistica,
         peso_liquido_kg, valor_fob_usd
  FROM trade WHERE fluxo = 'O'"""

CTES["imp"] = """
  SELECT ano, mes, codigo_ncm, unidade_estatistica, codigo_pais AS codigo_pais_origem,
         uf AS uf_destino, codigo_via_transporte, codigo_alfandega, quantidade_estatistica,
         peso_liquido_kg, valor_fob_usd, valor_frete_usd, valor_seguro_usd
  FROM trade WHERE fluxo = 'F'"""

CTES["ncm"] = """
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS codigo_ncm, p_name AS descricao_ncm_pt,
         p_brand AS codigo_fator_agregacao, p_type AS codigo_ppe_exportacao
  FROM part"""

CTES["ncm_fat_agreg"] = f"""
  SELECT p_brand AS codigo_fator_agregacao, 'FATOR ' || p_brand AS descricao_fator_agregacao,
         upper(substring(p_brand, 1, 5)) AS descricao_fator_agregacao_grupo
  FROM (SELECT DISTINCT p_brand FROM part) b WHERE p_brand <> '{S.MISSING_FACTOR}'"""

CTES["ncm_ppe"] = """
  SELECT p_type AS codigo_ppe, 'PPE ' || p_type AS descricao_ppe
  FROM (SELECT DISTINCT p_type FROM part) t"""

CTES["via"] = """
  SELECT substring(o_orderpriority, 1, 1) AS codigo_via_transporte,
         substring(o_orderpriority, 3) AS descricao_via_transporte
  FROM (SELECT DISTINCT o_orderpriority FROM orders) p"""

CTES["pais"] = f"""
  SELECT CAST(n_nationkey AS VARCHAR) AS codigo_pais,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo_pais_iso3,
         n_name AS nome_pais_pt
  FROM nation UNION ALL SELECT {', '.join(f"'{x}'" for x in S.TWIN_COUNTRY)}"""

CTES["pais_bloco"] = f"""
  SELECT CAST(n.n_nationkey AS VARCHAR) AS codigo_pais,
         CAST(r.r_regionkey AS VARCHAR) AS codigo_bloco_economico, r.r_name AS nome_bloco_pt
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT '{S.EXTRA_BLOC[0]}', '{S.EXTRA_BLOC[1]}', '{S.EXTRA_BLOC[2]}'"""

CTES["uf_tab"] = f"""
  SELECT CAST(r_regionkey AS VARCHAR) AS codigo_uf, substring(r_name, 1, 2) AS sigla_uf,
         upper(substring(r_name, 1, 1)) || lower(substring(r_name, 2)) AS nome_uf_raw,
         'REGIAO ' || CAST(r_regionkey AS VARCHAR) AS nome_regiao
  FROM region UNION ALL SELECT {', '.join(f"'{x}'" for x in S.TWIN_STATE)}"""

CTES["dim_data"] = f"""
  SELECT CAST(ano * 100 + mes AS BIGINT) AS sk_data, {first_of_month_sql()} AS data, ano, mes,
         CAST(ceil(mes / 3) AS INTEGER) AS trimestre, CAST(ceil(mes / 6) AS INTEGER) AS semestre,
         coalesce({_MONTH_CASE}, 'Desconhecido') AS nome_mes
  FROM (SELECT ano, mes FROM exp UNION SELECT ano, mes FROM imp) m"""

CTES["dim_ncm"] = """
  SELECT sk_ncm, codigo_ncm, nome_ncm, fator_agregado, nomenclatura_ppe FROM (
    SELECT *, row_number() OVER (PARTITION BY sk_ncm ORDER BY codigo_ncm NULLS FIRST,
           nome_ncm NULLS FIRST, fator_agregado NULLS FIRST, nomenclatura_ppe NULLS FIRST) AS rn
    FROM (SELECT TRY_CAST(codigo_ncm AS BIGINT) AS sk_ncm, codigo_ncm,
                 coalesce(descricao_ncm_pt, 'Descrição não disponível') AS nome_ncm,
                 codigo_fator_agregacao AS fator_agregado,
                 codigo_ppe_exportacao AS nomenclatura_ppe FROM ncm) x) y
  WHERE rn = 1"""

CTES["dim_ncm_enriched"] = """
  SELECT sk_ncm, codigo_ncm, nome_ncm, fator_agregado, nomenclatura_ppe, grupo_fator_agregado FROM (
    SELECT *, row_number() OVER (PARTITION BY sk_ncm ORDER BY codigo_ncm NULLS FIRST,
           nome_ncm NULLS FIRST, fator_agregado NULLS FIRST, nomenclatura_ppe NULLS FIRST,
           grupo_fator_agregado NULLS FIRST) AS rn
    FROM (SELECT TRY_CAST(n.codigo_ncm AS BIGINT) AS sk_ncm, n.codigo_ncm,
                 coalesce(n.descricao_ncm_pt, 'Descrição não disponível') AS nome_ncm,
                 f.descricao_fator_agregacao AS fator_agregado,
                 p.descricao_ppe AS nomenclatura_ppe,
                 f.descricao_fator_agregacao_grupo AS grupo_fator_agregado
          FROM ncm n
          LEFT JOIN ncm_fat_agreg f ON n.codigo_fator_agregacao = f.codigo_fator_agregacao
          LEFT JOIN ncm_ppe p ON n.codigo_ppe_exportacao = p.codigo_ppe) x) y
  WHERE rn = 1"""

CTES["dim_via"] = """
  SELECT sk_via_transporte, codigo_via, nome_via FROM (
    SELECT *, row_number() OVER (PARTITION BY sk_via_transporte
           ORDER BY codigo_via NULLS FIRST, nome_via NULLS FIRST) AS rn
    FROM (SELECT TRY_CAST(codigo_via_transporte AS BIGINT) AS sk_via_transporte,
                 codigo_via_transporte AS codigo_via,
                 coalesce(descricao_via_transporte, 'Via não informada') AS nome_via FROM via) x) y
  WHERE rn = 1"""

CTES["states"] = """
  SELECT DISTINCT uf FROM (SELECT uf_origem AS uf FROM exp UNION ALL
                           SELECT uf_destino AS uf FROM imp) s
  WHERE uf IS NOT NULL"""

def _countries(blocs: str, extra: str) -> str:
    """Countries with the bloc columns of ``blocs``, one row per numeric code."""
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sk_geografia ORDER BY codigo_referencia NULLS FIRST,
           nome_geografia NULLS FIRST, sigla NULLS FIRST, regiao_ou_bloco NULLS FIRST) AS rn
    FROM (SELECT TRY_CAST(p.codigo_pais AS BIGINT) AS sk_geografia, p.codigo_pais AS codigo_referencia,
                 coalesce(p.nome_pais_pt, 'País Desconhecido') AS nome_geografia, 'PAIS' AS nivel,
                 p.codigo_pais_iso3 AS sigla, b.nome_bloco AS regiao_ou_bloco{extra}
          FROM pais p LEFT JOIN (SELECT codigo_pais, {blocs} FROM pais_bloco GROUP BY codigo_pais) b
            ON p.codigo_pais = b.codigo_pais) c) d WHERE rn = 1"""


CTES["dim_geo"] = _countries("min(nome_bloco_pt) AS nome_bloco", "") + f"""
  UNION ALL
  SELECT {state_key_sql('uf')}, uf, uf, 'UF', uf, 'Brasil' FROM states"""

CTES["dim_geo_enriched"] = _countries(
    "min(nome_bloco_pt) AS nome_bloco, "
    "array_to_string(list_sort(list_distinct(list(nome_bloco_pt))), ', ') AS blocos",
    ", b.blocos AS blocos") + f"""
  UNION ALL
  SELECT {state_key_sql('s.uf')}, s.uf, coalesce(u.nome_uf_raw, s.uf), 'UF', s.uf,
         coalesce(u.nome_regiao, 'Brasil'), CAST(NULL AS VARCHAR)
  FROM states s LEFT JOIN (
    SELECT sigla_uf, nome_uf_raw, nome_regiao FROM (
      SELECT *, row_number() OVER (PARTITION BY sigla_uf ORDER BY nome_uf_raw, nome_regiao) AS rn
      FROM uf_tab) x WHERE rn = 1) u ON s.uf = u.sigla_uf"""


def fact_side_sql(src: str, tipo: str, pais: str, uf: str, extra: str = "") -> str:
    return f"""
    SELECT TRY_CAST(codigo_ncm AS BIGINT) AS sk_ncm, TRY_CAST({pais} AS BIGINT) AS sk_geografia,
           {state_key_sql(f"coalesce({uf}, 'XX')")} AS sk_geografia_uf,
           TRY_CAST(codigo_via_transporte AS BIGINT) AS sk_via_transporte,
           CAST(ano * 100 + mes AS BIGINT) AS sk_data, '{tipo}' AS tipo_movimentacao,
           TRY_CAST(valor_fob_usd AS DECIMAL(18,2)) AS valor_fob,
           TRY_CAST(quantidade_estatistica AS DECIMAL(18,2)) AS quantidade,
           TRY_CAST(peso_liquido_kg AS DECIMAL(18,2)) AS kg_liquido{extra}
    FROM {src}"""


CTES["fact_raw"] = (fact_side_sql("exp", "EXPORTACAO", "codigo_pais_destino", "uf_origem")
                    + "\n    UNION ALL BY NAME"
                    + fact_side_sql("imp", "IMPORTACAO", "codigo_pais_origem", "uf_destino"))

CTES["fact_raw_extra"] = (
    fact_side_sql("exp", "EXPORTACAO", "codigo_pais_destino", "uf_origem")
    + "\n    UNION ALL BY NAME"
    + fact_side_sql("imp", "IMPORTACAO", "codigo_pais_origem", "uf_destino",
                    ",\n           TRY_CAST(valor_frete_usd AS DECIMAL(18,2)) AS valor_frete,"
                    "\n           TRY_CAST(valor_seguro_usd AS DECIMAL(18,2)) AS valor_seguro"))

CTES["fact"] = """
  SELECT * FROM fact_raw WHERE sk_ncm IS NOT NULL AND sk_data IS NOT NULL"""

CTES["monthly_flows"] = """
  SELECT sk_data,
         CAST(sum(CASE WHEN tipo_movimentacao = 'EXPORTACAO' THEN valor_fob ELSE 0 END)
              AS DECIMAL(38,2)) AS exportacao,
         CAST(sum(CASE WHEN tipo_movimentacao = 'IMPORTACAO' THEN valor_fob ELSE 0 END)
              AS DECIMAL(38,2)) AS importacao
  FROM fact GROUP BY sk_data"""

CTES["kpi"] = """
  SELECT d.sk_data, d.ano, d.mes,
         CAST(sum(f.exportacao) AS DECIMAL(38,2)) AS exportacao,
         CAST(sum(f.importacao) AS DECIMAL(38,2)) AS importacao,
         CAST(sum(f.exportacao) - sum(f.importacao) AS DECIMAL(38,2)) AS saldo,
         CAST(sum(f.exportacao) + sum(f.importacao) AS DECIMAL(38,2)) AS corrente
  FROM monthly_flows f JOIN dim_data d ON f.sk_data = d.sk_data
  GROUP BY d.sk_data, d.ano, d.mes"""

CTES["estab"] = f"""
  SELECT lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, '0001' AS cnpj_ordem,
         c.c_name AS nome_fantasia,
         CASE WHEN c.c_acctbal > 0 THEN '{S.ACTIVE_STATUS}' ELSE '{S.INACTIVE_STATUS}' END
           AS situacao_cadastral,
         c.c_mktsegment AS cnae_principal, cu.uf AS uf
  FROM customer c JOIN cust_uf cu ON c.c_custkey = cu.c_custkey"""

CTES["empresas"] = """
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social,
         CASE WHEN c_acctbal < 2500 THEN '01' WHEN c_acctbal < 7500 THEN '03' ELSE '05' END AS porte
  FROM customer"""

CTES["cnaes"] = f"""
  SELECT c_mktsegment AS cnae, lower(c_mktsegment) AS descricao
  FROM (SELECT DISTINCT c_mktsegment FROM customer) s
  UNION ALL SELECT {', '.join(f"'{x}'" for x in S.TWIN_ACTIVITY)}"""


def porte_sql(expr: str) -> str:
    from tradestar.operators.marts import COMPANY_SIZE
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COMPANY_SIZE.items())
    return f"coalesce(CASE {expr} {whens} END, {expr})"


CTES["distribuicao"] = f"""
  SELECT e.cnae_principal AS cnae_fiscal_principal, c.descricao,
         {porte_sql('m.porte')} AS porte_empresa, e.uf,
         CAST(count(*) AS BIGINT) AS Total_empresas
  FROM estab e JOIN empresas m ON e.cnpj_basico = m.cnpj_basico
  LEFT JOIN (SELECT cnae, min(descricao) AS descricao FROM cnaes GROUP BY cnae) c
    ON e.cnae_principal = c.cnae
  WHERE e.situacao_cadastral = '{S.ACTIVE_STATUS}'
  GROUP BY e.cnae_principal, c.descricao, {porte_sql('m.porte')}, e.uf"""


def with_ctes(body: str) -> str:
    """Prefix a query body with every CTE (DuckDB evaluates only those used)."""
    parts = [f"{name} AS ({sql}\n)" for name, sql in CTES.items()]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
