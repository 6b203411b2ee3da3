"""Upkeep of the lake: publication, rejects of the fact, the catalogue, activities
that change over time, subtotals and their refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.operators import catalogue as C
from tradestar.operators import gold as G
from tradestar.operators import marts as M
from tradestar.operators import quality as Q
from tradestar.plans import pipeline as P
from tradestar.plans import q_gold as QG
from tradestar.plans import q_quality as QQ
from tradestar.plans.registry import register
from tradestar.session import scratch_path, sized_for
from tradestar.sources import publish as PB
from tradestar.sources import sinks as SK
from tradestar.sources import standins as S

# --------------------------------------------------------------------------- publication
#: What is published at each step: all suppliers with a balance above it.
BALANCES = (5000, 0, -100_000)


def _suppliers(spark, d, balance: int) -> DataFrame:
    return S.table(spark, d, "supplier").filter(F.col("s_acctbal") > balance).select(
        F.col("s_nationkey").alias("pais"), F.col("s_suppkey").alias("chave"), "s_name")


@register("published_overwrite", "\nUNION ALL\n".join(
    f"SELECT '{step}' AS leitura, s_nationkey AS pais, count(*) AS linhas, "
    f"CAST(sum(s_suppkey) AS BIGINT) AS soma FROM supplier WHERE s_acctbal > {BALANCES[k]} GROUP BY s_nationkey"
    for step, k in (("aberta antes", 0), ("depois", 1), ("depois da falha", 1), ("compactada", 2))), raw_sql=True)
def q_published_overwrite(spark, d):
    """A table published three times. A reader that planned before the second
    publication still reads the first; one that comes later reads the second,
    also after a write that failed; compaction changes files, not rows."""
    root = scratch_path(spark, "published")
    database = f"pub_{root.rsplit('/', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    name = f"{database}.fornecedores"
    publish = lambda df: PB.publish(df, name, f"{root}/data", ["pais"], ["chave"], keep=4)
    read = lambda step: spark.table(name).groupBy("pais").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("chave").alias("soma")).select(F.lit(step).alias("leitura"), "*")
    publish(_suppliers(spark, d, BALANCES[0]))
    before = read("aberta antes")
    publish(_suppliers(spark, d, BALANCES[1]))
    after = read("depois")
    failing = _suppliers(spark, d, BALANCES[2]).withColumn("s_name", F.raise_error(F.lit("falha planejada")))
    try:
        publish(failing)
    except Exception as exc:
        if "falha planejada" not in str(exc):
            raise
    failed = read("depois da falha")
    publish(_suppliers(spark, d, BALANCES[2]).repartition(6))
    PB.compact(spark, name, keep=4)
    return before.union(after).union(failed).union(read("compactada"))


# --------------------------------------------------------------------------- rejects
def _flagged_sql() -> str:
    return f"""
WITH exp_bad AS ({QQ._plant_sql('exp')}), imp_bad AS ({QQ._plant_sql('imp')}),
todas AS (SELECT 'EXPORTACAO' AS tipo, TRY_CAST(codigo_ncm AS BIGINT) AS sk_ncm, ano * 100 + mes AS sk_data,
                 TRY_CAST(valor_fob_usd AS DECIMAL(18,2)) AS v FROM exp_bad
          UNION ALL SELECT 'IMPORTACAO', TRY_CAST(codigo_ncm AS BIGINT), ano * 100 + mes,
                 TRY_CAST(valor_fob_usd AS DECIMAL(18,2)) FROM imp_bad),
marcadas AS (SELECT *, nullif(concat_ws(',', CASE WHEN sk_ncm IS NULL THEN 'sk_ncm_nulo' END,
                                        CASE WHEN sk_data IS NULL THEN 'sk_data_nulo' END), '') AS motivo FROM todas)
SELECT CASE WHEN motivo IS NULL THEN 'fato' ELSE 'rejeitos' END AS destino, tipo AS tipo_movimentacao, motivo,
       count(*) AS linhas, CAST(sum(v) AS DECIMAL(38,2)) AS valor_fob FROM marcadas GROUP BY ALL
UNION ALL SELECT 'relatorio', 'ft_balanco_comercial', NULL, count(*), NULL FROM marcadas WHERE motivo IS NULL
UNION ALL SELECT 'relatorio', 'ft_balanco_comercial_rejeitos', 'sk_ncm_nulo: ' || count(*), count(*), NULL
FROM marcadas WHERE motivo IS NOT NULL"""


@register("fact_with_rejects", _flagged_sql())
def q_fact_with_rejects(spark, d):
    """The job's gold fact of damaged inputs: both sides of the gate as they were
    written by one pass, and the job's own report."""
    lake = P.Lake(scratch_path(spark, "rejects"))
    exp, imp = QG.exp_imp(spark, d)
    by = ["rejeitada", "tipo_movimentacao"]
    flagged = G.clustered(G.flagged_fact(QQ._plant(exp), QQ._plant(imp)), by)
    with sized_for(spark, exp.count() + imp.count()):
        P._write_fact(spark, lake, flagged, lake.path("refined", "gold", P.FACT), by)
    fact = P.gold_table(spark, lake, P.FACT).withColumn("motivo", F.lit(None).cast("string"))
    counted = lambda df, side: df.groupBy("tipo_movimentacao", "motivo").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("valor_fob").cast("decimal(38,2)").alias("valor_fob")).select(
        F.lit(side).alias("destino"), "*")
    report = lake.report(spark).select(
        F.lit("relatorio").alias("destino"), F.col("entidade").alias("tipo_movimentacao"),
        F.col("mensagem").alias("motivo"), "linhas", F.lit(None).cast("decimal(38,2)").alias("valor_fob"))
    return counted(fact, "fato").unionByName(counted(P.gold_rejects(spark, lake), "rejeitos")).unionByName(report)


# --------------------------------------------------------------------------- catalogue
#: Partition of the tables that grow by month.
MONTHS = {"lineitem": "l_shipdate", "orders": "o_orderdate"}
LAST_MONTH = "1998-06"

_BOUND = {"DOUBLE": "CAST(CAST({0}({1}) AS DECIMAL(38,6)) AS VARCHAR)",
          "TIMESTAMP": "CAST(epoch_us({0}({1})) AS VARCHAR)", "FLOAT[]": "CAST(NULL AS VARCHAR)"}
_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
          "FLOAT[]": "array<float>"}
#: Columns of the given tables that are neither text nor named below.
_COLUMN_TYPES = {
    "INTEGER": "r_regionkey n_nationkey n_regionkey c_nationkey p_size l_linenumber label quality toxic",
    "DOUBLE": "c_acctbal s_acctbal p_retailprice o_totalprice l_quantity l_extendedprice l_discount l_tax value",
    "TIMESTAMP": "o_orderdate l_shipdate ts", "FLOAT[]": "embedding",
    "BIGINT": "c_custkey s_suppkey p_partkey o_orderkey o_custkey l_orderkey l_partkey l_suppkey event_id user_id "
              "doc_id n_chars vec_id page_id item_id conv_id turn"}


def _stats_sql() -> str:
    kind_of = {c: kind for kind, names in _COLUMN_TYPES.items() for c in names.split()}
    kind_of |= {(t, "s_nationkey"): "INTEGER" for t in ("supplier",)}
    out = []
    for t, cols in QQ.TABLE_COLUMNS.items():
        for c in cols:
            kind = kind_of.get((t, c), kind_of.get(c, "VARCHAR"))
            low, high = (_BOUND.get(kind, "CAST({0}({1}) AS VARCHAR)").format(f, c) for f in ("min", "max"))
            out.append(f"SELECT '{t}' AS tabela, '{c}' AS coluna, '{_TYPES[kind]}' AS tipo, count(*) AS linhas, "
                       f"count(*) - count({c}) AS nulos, {low} AS minimo, {high} AS maximo FROM {t}")
    return "\nUNION ALL\n".join(out)


def stored_catalogue(spark, d) -> DataFrame:
    """The catalogue of all tables; those that grow by month are stored in two
    loads, the second of the months from LAST_MONTH on."""
    path = scratch_path(spark, "catalogue")
    for name, df in QQ._tables(spark, d).items():
        if name not in MONTHS:
            C.update(path, df, name)
            continue
        month = F.date_format(MONTHS[name], "yyyy-MM")
        C.update(path, df.filter(month < LAST_MONTH), name, month)
        C.update(path, df.filter((month >= LAST_MONTH) | month.isNull()), name, month)
    return C.catalogue(spark, path)


@register("catalog_stats", _stats_sql(), raw_sql=True)
def q_catalog_stats(spark, d):
    """The exact columns of the catalogue; tests hold the estimates against their
    error."""
    return stored_catalogue(spark, d).drop("distintos_aprox")


# --------------------------------------------------------------------------- activities
#: Every product has an activity from 1995 on; those whose key is a multiple of
#: three have another one from the middle of the reported year, and some a third
#: that is not valid yet when the dimension is built.
CHANGED, FUTURE, AS_OF = "1998-07-01", "2030-01-15", "2024-12-31"


def activities(spark, d) -> DataFrame:
    part = S.table(spark, d, "part").select(F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("codigo_ncm"),
                                            "p_partkey", "p_brand", "p_type")
    row = lambda df, cnae, sector, version, day: df.select(
        "codigo_ncm", cnae.alias("cnae"), F.concat(F.lit("Atividade "), cnae).alias("descricao_cnae"),
        sector.alias("setor_economico"), F.lit(version).alias("versao"), F.lit(day).cast("date").alias("vigente_desde"))
    first = row(part, F.col("p_brand"), F.col("p_type"), 1, "1995-01-01")
    second = row(part.filter("p_partkey % 3 = 0"), F.concat("p_brand", F.lit("-B")),
                 F.concat(F.lit("NOVO "), F.col("p_type")), 2, CHANGED)
    third = row(part.filter("p_partkey % 5 = 0"), F.lit("futuro"), F.lit("FUTURO"), 3, FUTURE)
    return first.unionByName(second).unionByName(third)


_ACTIVITIES = f"""
atividades AS (
  SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS codigo_ncm, p_brand AS cnae, p_type AS setor,
         DATE '1995-01-01' AS desde,
         CASE WHEN p_partkey % 3 = 0 THEN DATE '{CHANGED}' WHEN p_partkey % 5 = 0 THEN DATE '{FUTURE}' END AS ate
  FROM part
  UNION ALL
  SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 8, '0'), p_brand || '-B', 'NOVO ' || p_type, DATE '{CHANGED}',
         CASE WHEN p_partkey % 5 = 0 THEN DATE '{FUTURE}' END
  FROM part WHERE p_partkey % 3 = 0)"""


@register("dim_product_activity", f"""
SELECT n.sk_ncm, n.codigo_ncm, n.nome_ncm, n.fator_agregado, n.nomenclatura_ppe, a.cnae,
       'Atividade ' || a.cnae AS descricao_cnae, a.setor AS setor_economico
FROM dim_ncm n LEFT JOIN (WITH {_ACTIVITIES} SELECT * FROM atividades
     WHERE desde <= DATE '{AS_OF}' AND (ate IS NULL OR ate > DATE '{AS_OF}')) a USING (codigo_ncm)""")
def q_dim_product_activity(spark, d):
    """The product dimension with activity and sector as of a day."""
    return G.build_dim_product(S.ncm(spark, d), activities=Q.current_activities(activities(spark, d), AS_OF))


_DATED = f"""
(WITH {_ACTIVITIES}
 SELECT f.*, a.setor AS setor_economico, a.cnae, a.codigo_ncm
 FROM fact f JOIN dim_ncm n USING (sk_ncm) LEFT JOIN atividades a
   ON a.codigo_ncm = n.codigo_ncm AND a.desde <= make_date(f.sk_data // 100, f.sk_data % 100, 1)
  AND (a.ate IS NULL OR a.ate > make_date(f.sk_data // 100, f.sk_data % 100, 1))
 WHERE f.tipo_movimentacao = 'EXPORTACAO' AND f.sk_data BETWEEN {QG.TOP_FROM} AND {QG.TOP_TO})"""


@register("mart_top_products_sector", f"""
SELECT x.codigo_ncm, n.nome_ncm, x.setor_economico, CAST(sum(x.valor_fob) AS DECIMAL(38,2)) AS valor_total_exportado,
       CAST(sum(x.kg_liquido) AS DECIMAL(38,2)) AS peso_liquido_total
FROM {_DATED} x JOIN dim_ncm n ON n.sk_ncm = x.sk_ncm GROUP BY ALL
ORDER BY valor_total_exportado DESC, x.codigo_ncm, x.setor_economico LIMIT {QG.TOP_K}""")
def q_mart_top_products_sector(spark, d):
    g = QG.stored(spark, d)
    return M.mart_top_products_by_sector(g["ft_balanco_comercial"], g["dim_ncm"], activities(spark, d),
                                         QG.TOP_FROM, QG.TOP_TO, QG.TOP_K)


@register("mart_sectors", f"""
SELECT sk_data, setor_economico, CAST(sum(valor_fob) AS DECIMAL(38,2)) AS valor_total_exportado,
       count(DISTINCT cnae) AS atividades
FROM {_DATED} x GROUP BY ALL""")
def q_mart_sectors(spark, d):
    """Exports by month and sector over a range in which sectors change."""
    g = QG.stored(spark, d)
    return M.mart_sectors(g["ft_balanco_comercial"], g["dim_ncm"], activities(spark, d), QG.TOP_FROM, QG.TOP_TO)


# --------------------------------------------------------------------------- subtotals
_LEVELS = {"total": "NULL", "produto": "sk_ncm", "parceiro": "sk_geografia", "estado": "sk_geografia_uf"}


@register("trade_subtotals", "\nUNION ALL\n".join(f"""
SELECT sk_data, tipo_movimentacao, '{name}' AS nivel, CAST({key} AS BIGINT) AS chave,
       CAST(sum(valor_fob) AS DECIMAL(38,2)) AS valor_total, CAST(sum(kg_liquido) AS DECIMAL(38,2)) AS peso_total,
       count(*) AS registros
FROM fact GROUP BY ALL""" for name, key in _LEVELS.items()))
def q_trade_subtotals(spark, d):
    """Subtotals of all months, stored without one direction in the reported
    year, then refreshed in that year's months alone."""
    fact = QG.stored(spark, d)["ft_balanco_comercial"]
    path = scratch_path(spark, "subtotals")
    changed = F.col("sk_data").between(QG.TOP_FROM, QG.TOP_TO)
    late = changed & (F.col("tipo_movimentacao") == "IMPORTACAO")
    for rows in (fact.filter(~late), fact.filter(changed)):
        SK.write_snapshot(M.trade_subtotals(rows), path, ["sk_data"], "parquet")
    return spark.read.parquet(path).withColumn("sk_data", F.col("sk_data").cast("long"))


# --------------------------------------------------------------------------- layouts that joins use
@register("mart_years_pruned", f"""
SELECT ano, trimestre, tipo_movimentacao, CAST(sum(valor_fob) AS DECIMAL(38,2)) AS valor_total
FROM fact JOIN dim_data USING (sk_data) WHERE ano BETWEEN {QG.MIN_YEAR} AND {QG.MIN_YEAR + 1} GROUP BY ALL""")
def q_mart_years_pruned(spark, d):
    """A report of two years over a fact stored by year: the years are named on
    the date dimension, and only their folders are read."""
    g = QG.stored(spark, d)
    return M.mart_years(fact_by_year(spark, g["ft_balanco_comercial"]), g["dim_data"], QG.MIN_YEAR, QG.MIN_YEAR + 1)


def fact_by_year(spark, fact: DataFrame) -> DataFrame:
    path = scratch_path(spark, "by_year")
    year = F.floor(F.col("sk_data") / 100).cast("int")
    SK.overwrite_table(fact.withColumn("ano_ref", year).hint("rebalance", "ano_ref"), path, ["ano_ref"], "parquet")
    return spark.read.parquet(path)


REGISTRY_BUCKETS = 8


def bucketed_registry(spark, d) -> tuple[DataFrame, DataFrame]:
    """Establishments and companies published in buckets by company key."""
    root = scratch_path(spark, "registry")
    database = f"reg_{root.rsplit('/', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    for name, df in (("estabelecimentos", S.estabelecimentos(spark, d)), ("empresas", S.empresas(spark, d))):
        PB.publish(df, f"{database}.{name}", f"{root}/data", buckets=REGISTRY_BUCKETS, bucket_by=["cnpj_basico"])
    return spark.table(f"{database}.estabelecimentos"), spark.table(f"{database}.empresas")


@register("registry_bucketed", "SELECT * FROM distribuicao")
def q_registry_bucketed(spark, d):
    """The distribution from bucketed tables: no shuffle below the join."""
    places, firms = bucketed_registry(spark, d)
    return M.establishment_distribution(places, firms, S.cnaes(spark, d), S.ACTIVE_STATUS)
