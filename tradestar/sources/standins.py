"""Binding of the driver's TPC-H-like tables to the trade and registry entities.

The test tables stand in for the *trusted* (silver) layer: they are already
typed and clean, so the gold builders run on them directly. One lineitem row is
one trade record: ``l_linestatus`` 'O' is an export, 'F' an import.

Join plan for the trade records (the only large join in the binding):
orders is first enriched with the customer's region (orders-sized work), then
lineitem joins it on the order key, then supplier and part. No side is hinted:
Catalyst and AQE broadcast what measures small and fall back to a sort-merge
join beyond the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c) -> F.Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> two-letter region code (stands in for the state 'uf')."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", F.substring("r_name", 1, 2).alias("uf")))


def trade_records(spark: SparkSession, sf_dir: str, fluxo: str | None = None) -> DataFrame:
    """One row per lineitem with trade semantics (all layout columns of both
    directions). ``fluxo`` filters on ``l_linestatus`` at the scan."""
    li = table(spark, sf_dir, "lineitem")
    if fluxo is not None:
        li = li.filter(F.col("l_linestatus") == fluxo)
    orders = (table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderpriority")
              .join(customer_region(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderpriority", "uf"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    price = _dec("l_extendedprice")
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.year("l_shipdate").alias("ano"),
                F.month("l_shipdate").alias("mes"),
                F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("codigo_ncm"),
                F.col("l_returnflag").alias("unidade_estatistica"),
                F.col("s_nationkey").cast("string").alias("codigo_pais"),
                F.col("uf"),
                F.substring("o_orderpriority", 1, 1).alias("codigo_via_transporte"),
                F.col("l_linenumber").cast("string").alias("codigo_alfandega"),
                F.col("l_linestatus").alias("fluxo"),
                _dec("l_quantity").alias("quantidade_estatistica"),
                _dec(_dec("l_quantity") * F.col("p_size")).alias("peso_liquido_kg"),
                price.alias("valor_fob_usd"),
                _dec(price * _dec("l_tax")).alias("valor_frete_usd"),
                _dec(price * _dec("l_discount")).alias("valor_seguro_usd"),
            ))


EXP_COLUMNS = ["ano", "mes", "codigo_ncm", "unidade_estatistica", "codigo_pais_destino",
               "uf_origem", "codigo_via_transporte", "codigo_alfandega",
               "quantidade_estatistica", "peso_liquido_kg", "valor_fob_usd"]
IMP_COLUMNS = ["ano", "mes", "codigo_ncm", "unidade_estatistica", "codigo_pais_origem",
               "uf_destino", "codigo_via_transporte", "codigo_alfandega",
               "quantidade_estatistica", "peso_liquido_kg", "valor_fob_usd",
               "valor_frete_usd", "valor_seguro_usd"]


def exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``exp`` in the EXPO_2021 layout."""
    return (trade_records(spark, sf_dir, "O")
            .withColumnsRenamed({"codigo_pais": "codigo_pais_destino", "uf": "uf_origem"})
            .select(*EXP_COLUMNS))


def imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``imp`` in the IMP_2021 layout (with freight and insurance)."""
    return (trade_records(spark, sf_dir, "F")
            .withColumnsRenamed({"codigo_pais": "codigo_pais_origem", "uf": "uf_destino"})
            .select(*IMP_COLUMNS))


def ncm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``ncm``: part as the product catalogue."""
    return table(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("codigo_ncm"),
        F.col("p_name").alias("descricao_ncm_pt"),
        F.col("p_brand").alias("codigo_fator_agregacao"),
        F.col("p_type").alias("codigo_ppe_exportacao"),
    )


# A factor code left out of the factor lookup, so the product join has a null side.
MISSING_FACTOR = "Brand#1"


def ncm_fat_agreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``ncm_fat_agreg``: one row per brand, one brand missing."""
    return (table(spark, sf_dir, "part").select("p_brand").distinct()
            .filter(F.col("p_brand") != MISSING_FACTOR)
            .select(F.col("p_brand").alias("codigo_fator_agregacao"),
                    F.concat(F.lit("FATOR "), F.col("p_brand")).alias("descricao_fator_agregacao"),
                    F.upper(F.substring("p_brand", 1, 5)).alias("descricao_fator_agregacao_grupo")))


def ncm_ppe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``ncm_ppe``: one row per part type."""
    return (table(spark, sf_dir, "part").select("p_type").distinct()
            .select(F.col("p_type").alias("codigo_ppe"),
                    F.concat(F.lit("PPE "), F.col("p_type")).alias("descricao_ppe")))


def via(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``via``: order priorities as transport modes ('1-URGENT' -> 1, URGENT)."""
    return (table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
            .select(F.substring("o_orderpriority", 1, 1).alias("codigo_via_transporte"),
                    F.expr("substring(o_orderpriority, 3)").alias("descricao_via_transporte")))


# Rows planted beside those of a table, to repeat a key: country 7 under another
# spelling of its code, a state and an activity with a second name.
TWIN_COUNTRY = ("07", "X07", "OUTRO NOME")
TWIN_STATE = ("9", "AF", "Zona Repetida", "REGIAO 9")
TWIN_ACTIVITY = ("BUILDING", "zz repetida")


def pais(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``pais``: nations as countries, one of them twice."""
    base = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("codigo_pais"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        .alias("codigo_pais_iso3"),
        F.col("n_name").alias("nome_pais_pt"),
    )
    return base.unionByName(spark.createDataFrame([TWIN_COUNTRY], base.schema))


# A second bloc planted for one country, so that one country has two blocs.
EXTRA_BLOC = ("7", "99", "MERCOSUL")


def pais_bloco(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``pais_bloco``: the nation's region is its bloc; country 7 also
    belongs to a second bloc."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    base = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("codigo_pais"),
        F.col("r_regionkey").cast("string").alias("codigo_bloco_economico"),
        F.col("r_name").alias("nome_bloco_pt"),
    )
    extra = spark.createDataFrame([EXTRA_BLOC], base.schema)
    return base.unionByName(extra)


def uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``uf``: regions as states (code, name, macro-region), one twice."""
    base = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("codigo_uf"),
        F.substring("r_name", 1, 2).alias("sigla_uf"),
        F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.expr("substring(r_name, 2)")))
        .alias("nome_uf"),
        F.concat(F.lit("REGIAO "), F.col("r_regionkey").cast("string")).alias("nome_regiao"),
    )
    return base.unionByName(spark.createDataFrame([TWIN_STATE], base.schema))


# ---------------------------------------------------------------------------
# Registry: customer as establishment and company, segment as activity code.
# ---------------------------------------------------------------------------
ACTIVE_STATUS = "02"
INACTIVE_STATUS = "08"


def estabelecimentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``estabelecimentos`` (subset of the ESTABELE layout)."""
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                   "c_mktsegment", "c_name")
            .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cnpj_basico"),
                F.lit("0001").alias("cnpj_ordem"),
                F.col("c_name").alias("nome_fantasia"),
                F.when(F.col("c_acctbal") > 0, F.lit(ACTIVE_STATUS))
                .otherwise(F.lit(INACTIVE_STATUS)).alias("situacao_cadastral"),
                F.col("c_mktsegment").alias("cnae_principal"),
                F.substring("r_name", 1, 2).alias("uf"),
            ))


def empresas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``empresas``: size code by balance bucket."""
    bal = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cnpj_basico"),
        F.col("c_name").alias("razao_social"),
        F.when(bal < 2500, F.lit("01")).when(bal < 7500, F.lit("03"))
        .otherwise(F.lit("05")).alias("porte"),
    )


def cnaes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted ``cnaes``: one row per segment, and one twice."""
    base = (table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
            .select(F.col("c_mktsegment").alias("cnae"),
                    F.lower("c_mktsegment").alias("descricao")))
    return base.unionByName(spark.createDataFrame([TWIN_ACTIVITY], base.schema))
