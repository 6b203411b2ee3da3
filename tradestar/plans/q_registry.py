"""The registry path on ZIP files that executors write from the given tables.

Customers are dealt to archives of a bounded number of rows, keyed by nation and
a range of customer keys; each archive is a ZIP of header-less ``;`` ISO-8859-1
records with quoted fields, as the registry publishes them. One more archive,
beside those of the last nation, is broken on purpose.
"""

from __future__ import annotations

import io
import zipfile
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.operators import marts as M
from tradestar.operators import resolve as R
from tradestar.operators import silver as SV
from tradestar.plans import pipeline as P
from tradestar.plans.registry import register
from tradestar.session import scratch_path
from tradestar.sources import archives as A
from tradestar.sources import files as FS
from tradestar.sources import standins as S

BROKEN_NATION, BROKEN = 24, "Arquivo24_quebrado.zip"
#: Customer keys of one range; an archive holds those of one nation in it.
KEYS = 5_000


def _written(path: str, content: bytes) -> None:
    """A file of the store; a repeated task writes the same bytes again."""
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    store.create_dir(name.rsplit("/", 1)[0])
    with store.open_output_stream(name) as out:
        out.write(content)


def _archives(lines: DataFrame, extension: str, members: int = 1, prefix: str = "Arquivo",
              folder: str | None = None) -> DataFrame:
    """The listing of ZIP files made of (nation, n, line), one for each nation
    and range of n, whose lines are dealt to ``members`` members by n."""
    folder = folder or scratch_path(lines.sparkSession, "archives")

    def zipped(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        nation, block = int(key[0]), int(key[1])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("__MACOSX/._x", "x")
            z.writestr("leia.me", "x")
            for part, rows in pdf.sort_values("n").groupby(pdf["n"] % members):
                z.writestr(f"K{nation}_{block}_{part}.{extension}",
                           ("\n".join(rows["line"]) + "\n").encode("ISO-8859-1"))
        _written(f"{folder}/{prefix}{nation}_{block}.zip", buf.getvalue())
        if (nation, block) == (BROKEN_NATION, 0):
            _written(f"{folder}/{BROKEN.replace('Arquivo', prefix)}", b"not a zip")
        return pd.DataFrame({"rows": [len(pdf)]})

    block = F.floor(F.col("n") / KEYS).alias("block")
    lines.select("*", block).groupBy("nation", "block").applyInPandas(zipped, "rows long").agg(F.sum("rows")).first()
    return A.read_archives(lines.sparkSession, folder, "*.zip")


def _quoted(*cols):
    return F.concat(F.lit('"'), F.concat_ws('";"', *cols), F.lit('"'))


def customer_archives(spark, d) -> DataFrame:
    """Records of (key, name with a quoted ';' and line break, segment or empty,
    status), half of an archive's in each of two members."""
    c = S.table(spark, d, "customer")
    return _archives(c.select(
        F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("n"),
        _quoted(F.col("c_custkey").cast("string"), F.concat("c_name", F.lit("; São\nPaulo")),
                F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(""), F.lit("02")).alias("line")),
        "ESTABELE", members=2)


_ARCHIVE = f"c_nationkey || '_' || c_custkey // {KEYS}"


@register("unzip_members", f"""
SELECT 'Arquivo' || {_ARCHIVE} || '.zip' AS arquivo_zip,
       'K' || {_ARCHIVE} || '_' || c_custkey % 2 || '.ESTABELE' AS membro,
       CAST(row_number() OVER (PARTITION BY {_ARCHIVE}, c_custkey % 2 ORDER BY c_custkey) AS BIGINT) AS n_linha,
       CAST(c_custkey AS VARCHAR) AS chave, c_name || '; São' || chr(10) || 'Paulo' AS nome,
       CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segmento, CAST(NULL AS VARCHAR) AS erro
FROM customer
UNION ALL
SELECT '{BROKEN}', NULL, NULL, NULL, NULL, NULL, 'BadZipFile(''File is not a zip file'')'""", raw_sql=True)
def q_unzip_members(spark, d):
    """Every record of every archive; the broken one gives its error."""
    records = A.unzip_members(customer_archives(spark, d)).filter("membro is null or membro <> 'leia.me'")
    fields = F.from_csv("registro", "chave string, nome string, segmento string", {"sep": ";", "escape": '"'})
    return records.select("arquivo_zip", "membro", "n_linha", fields.alias("c"), "erro").select(
        "arquivo_zip", "membro", "n_linha", "c.*", "erro")


@register("archive_member_choice", f"""
SELECT 'Arquivo' || a || '.zip' AS arquivo_zip, 'K' || a || '_' || min(parte) || '.ESTABELE' AS membro
FROM (SELECT {_ARCHIVE} AS a, c_custkey % 2 AS parte FROM customer) GROUP BY a""", raw_sql=True)
def q_archive_member_choice(spark, d):
    return R.choose_member(A.list_members(customer_archives(spark, d)).filter("erro is null"))


def _registry_rows(spark, d, layout: list[str], columns: dict) -> DataFrame:
    """Named bronze rows of the chosen members of archives with the layout's columns."""
    base = S.customer_region(spark, d).select("c_custkey", "uf").join(S.table(spark, d, "customer"), "c_custkey")
    line = _quoted(*[F.coalesce(columns.get(c, F.lit("")), F.lit("")) for c in layout])
    files = _archives(base.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("n"),
                                  line.alias("line")), "CSV")
    members = A.chosen_members(A.list_members(files))
    return A.with_provenance(A.name_fields(A.read_members(members), layout, len(layout)))


ESTAB_LAYOUT = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "situacao_cadastral", "cnae_principal", "uf"]
FIRM_LAYOUT = ["cnpj_basico", "razao_social", "porte"]


@register("registry_job", """
SELECT c_mktsegment AS cnae_fiscal_principal, min(a.descricao) AS descricao, 'DEMAIS' AS porte_empresa,
       r_name[1:2] AS uf, count(DISTINCT c_custkey) AS Total_empresas
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT DISTINCT c_mktsegment AS cnae, lower(c_mktsegment) AS descricao FROM customer) a
  ON a.cnae = c_mktsegment
WHERE c_acctbal > 0 AND c_custkey % 10 <> 3 GROUP BY ALL""", raw_sql=True)
def q_registry_job(spark, d):
    """Archives -> bronze -> silver -> newest row of each key -> distribution.
    Each company comes twice, the later row with another size; one establishment
    in ten has no company key."""
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    places = _registry_rows(spark, d, ESTAB_LAYOUT, {
        "cnpj_basico": F.when(F.col("c_custkey") % 10 != 3, key), "cnpj_ordem": F.lit("0001"), "cnpj_dv": F.lit("12"),
        "situacao_cadastral": F.when(F.col("c_acctbal") > 0, "02").otherwise("08"),
        "cnae_principal": F.col("c_mktsegment"), "uf": F.col("uf")})
    load = lambda size, day: _registry_rows(spark, d, FIRM_LAYOUT, {
        "cnpj_basico": key, "razao_social": F.col("c_name"), "porte": F.lit(size)}).withColumn(
        "ingestion_timestamp", F.to_timestamp(F.lit(day)))
    firms = load("01", "2024-01-01").unionByName(load("05", "2024-02-01"))
    latest = ["ingestion_timestamp", "file_source"]
    place = SV.dedup_latest(SV.silver_clean_registry(places).filter("cnpj_basico is not null"),
                            ["cnpj_basico", "cnpj_ordem", "cnpj_dv"], latest)
    firm = SV.dedup_latest(SV.silver_clean_registry(firms).filter("cnpj_basico is not null"), ["cnpj_basico"], latest)
    cnaes = S.table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("cnae"), F.lower("c_mktsegment").alias("descricao")).distinct()
    return M.establishment_distribution(place, firm, cnaes, S.ACTIVE_STATUS)


@register("registry_stream", f"""
SELECT 'trusted' AS tabela, CAST(c_custkey AS VARCHAR) AS codigo_motivo, upper(c_name) AS descricao,
       upper('Motivos' || {_ARCHIVE} || '.zip') AS file_source FROM customer
UNION ALL SELECT 'rejeitos', NULL, 'BadZipFile(''File is not a zip file'')', '{BROKEN.replace('Arquivo', 'Motivos')}'
UNION ALL SELECT 'relatorio', CAST(count(*) AS VARCHAR), 'OK', 'bronze/motivos' FROM customer
UNION ALL SELECT 'relatorio', '0', 'SEM_NOVOS', 'bronze/motivos'
UNION ALL SELECT 'relatorio', '1', 'ERRO', 'bronze/motivos/lote_1/arquivos'""", raw_sql=True)
def q_registry_stream(spark, d):
    """The job's archive stream over two arrivals and a third run without one:
    members chosen, named by layout, cleaned; the broken archive listed; the
    run report of the job."""
    root = scratch_path(spark, "registry_stream")
    lake = P.Lake(f"{root}/lake")
    c = S.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("n"),
        _quoted(F.col("c_custkey").cast("string"), F.col("c_name")).alias("line"))
    for arrival in (F.col("nation") < 12, F.col("nation") >= 12, None):
        if arrival is not None:
            _archives(c.filter(arrival), "MOTIVOS", prefix="Motivos", folder=f"{root}/landing").count()
        P.bronze_registry(spark, f"{root}/landing", lake, ["MOTIVOS"])
    P.silver_registry(spark, lake, ["MOTIVOS"])
    trusted = FS.read_table(spark, lake.path("trusted", P.REGISTRY, "motivos")).select(
        F.lit("trusted").alias("tabela"), "codigo_motivo", "descricao", "file_source")
    bad = FS.read_table(spark, lake.path("raw", P.REGISTRY, "_rejeitos/motivos")).select(
        F.lit("rejeitos").alias("tabela"), F.lit(None).cast("string").alias("codigo_motivo"),
        F.col("erro").alias("descricao"), F.col("arquivo_zip").alias("file_source"))
    report = lake.report(spark).filter("camada = 'bronze'")
    whole = report.filter("entidade = 'motivos'").groupBy("status").agg(F.sum("linhas").alias("linhas"))
    lines = whole.select("linhas", "status", F.lit("motivos").alias("entidade")).unionByName(
        report.filter("entidade <> 'motivos'").select("linhas", "status", "entidade"))
    return trusted.unionByName(bad).unionByName(lines.select(
        F.lit("relatorio").alias("tabela"), F.col("linhas").cast("string").alias("codigo_motivo"),
        F.col("status").alias("descricao"), F.concat(F.lit("bronze/"), "entidade").alias("file_source")))
