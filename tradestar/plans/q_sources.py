"""Source/sink queries: CSV landing scans, table reads and writes, file
decisions (layout, format, delimiter) and file inventories.

Queries that exercise a sink write to a fresh folder below the session's
checkpoint directory (``spark.checkpoint.dir``), then return the read-back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.layouts import COMPACTION_TARGET_BYTES, TRADE_LAYOUTS, layout_rows
from tradestar.operators import resolve as R
from tradestar.plans import trusted
from tradestar.plans.registry import register
from tradestar.session import scratch_path
from tradestar.sources import files as FS
from tradestar.sources import sinks as SK
from tradestar.sources import standins as S
from tradestar.sources.archives import with_provenance


# --------------------------------------------------------------------------- scans and sinks
@register("scan_csv_entity", "SELECT * FROM exp")
def q_scan_csv_entity(spark, d):
    """Exports written as a landing file (source headers, ';', ISO-8859-1),
    scanned back with the layout's explicit schema and header check."""
    landing = scratch_path(spark, "landing", "exp")
    layout = TRADE_LAYOUTS["EXPO_2021"]
    src = trusted.exp_imp(spark, d)[0].select(*[F.col(dst).alias(s) for s, dst in layout.items()])
    src.write.options(**FS.LANDING_OPTIONS).csv(landing)
    return FS.scan_csv_entity(spark, landing, "exp", glob="*.csv")


@register("provenance_columns", """
SELECT o_orderkey, 'orders.parquet' AS file_source, TRUE AS tem_carga FROM orders""",
          raw_sql=True)
def q_provenance_columns(spark, d):
    df = with_provenance(S.table(spark, d, "orders").select("o_orderkey"))
    return df.select("o_orderkey", "file_source",
                     F.col("ingestion_timestamp").isNotNull().alias("tem_carga"))


@register("read_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders""", raw_sql=True)
def q_read_table(spark, d):
    """A table partitioned in folders (one per status) read back; the folder
    names come back as the partition column."""
    path = scratch_path(spark, "tables", "orders")
    S.table(spark, d, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return FS.read_table(spark, path, fmt="parquet")


@register("append_merge_schema", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders""", raw_sql=True)
def q_append_merge_schema(spark, d):
    """Two appends, the second with one more column; read with schema merge."""
    path = scratch_path(spark, "tables", "orders_append")
    o = S.table(spark, d, "orders")
    SK.append_merge_schema(o.filter(F.col("o_orderstatus") == "F")
                           .select("o_orderkey", "o_custkey", "o_orderstatus"), path)
    SK.append_merge_schema(o.filter(F.col("o_orderstatus") != "F")
                           .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
                           path)
    return SK.read_merged(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice")


@register("overwrite_partitioned", """
SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS ano,
       CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders""", raw_sql=True)
def q_overwrite_partitioned(spark, d):
    """Partitioned by the picked (ano, mes) columns; written twice, the second
    overwrite replaces the first (no duplicates)."""
    path = scratch_path(spark, "tables", "orders_by_month")
    df = S.table(spark, d, "orders").select("o_orderkey", "o_orderstatus",
                                            F.year("o_orderdate").alias("ano"),
                                            F.month("o_orderdate").alias("mes"))
    SK.overwrite_partitioned(df, path)
    SK.overwrite_partitioned(df, path)
    back = spark.read.parquet(path)
    return back.select("o_orderkey", "o_orderstatus", F.col("ano").cast("int"),
                       F.col("mes").cast("int"))


# --------------------------------------------------------------------------- file decisions
def _layout_values_sql() -> str:
    return ", ".join(f"('{k}', '{v}', {i})" for k, v, i in layout_rows())


ORDER_FILE_SQL = """
  CASE o_orderstatus WHEN 'F' THEN 'EXP' WHEN 'O' THEN 'IMP' ELSE 'NCM_SH' END
  || CASE WHEN o_orderpriority = '3-MEDIUM' THEN ''
          ELSE '_' || CAST(year(o_orderdate) AS VARCHAR) END
  || CASE o_orderpriority WHEN '1-URGENT' THEN '_MUN' WHEN '2-HIGH' THEN '_X' ELSE '' END
  || '.csv'"""


def order_file_names(spark, d):
    o = S.table(spark, d, "orders")
    prefix = (F.when(F.col("o_orderstatus") == "F", "EXP")
              .when(F.col("o_orderstatus") == "O", "IMP").otherwise("NCM_SH"))
    year = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("")).otherwise(
        F.concat(F.lit("_"), F.year("o_orderdate").cast("string")))
    suffix = (F.when(F.col("o_orderpriority") == "1-URGENT", "_MUN")
              .when(F.col("o_orderpriority") == "2-HIGH", "_X").otherwise(""))
    return o.select(F.concat(prefix, year, suffix, F.lit(".csv")).alias("arquivo"))


@register("resolve_layout", f"""
WITH k AS (SELECT chave, layout, ordem, regexp_replace(chave, '_\\d{{4}}', '', 'g') AS chave_sem_ano,
                  length(chave) AS tamanho
           FROM (VALUES {_layout_values_sql()}) t(chave, layout, ordem)),
n AS (SELECT arquivo, stem, regexp_replace(stem, '_\\d{{4}}', '', 'g') AS stem_sem_ano
      FROM (SELECT arquivo, regexp_replace(arquivo, '\\.[^./]*$', '') AS stem
            FROM (SELECT DISTINCT {ORDER_FILE_SQL} AS arquivo FROM orders) a) b),
cand AS (
  SELECT n.arquivo, 1 AS rnk, 0 AS tie, k.ordem, k.layout FROM n JOIN k ON n.stem = k.chave
  UNION ALL
  SELECT n.arquivo, 2, 0, k.ordem, k.layout FROM n JOIN k ON n.stem_sem_ano = k.chave_sem_ano
  UNION ALL
  SELECT n.arquivo, 3, -k.tamanho, k.ordem, k.layout FROM n JOIN k ON starts_with(n.stem, k.chave)
),
best AS (SELECT arquivo, rnk, layout FROM (
  SELECT *, row_number() OVER (PARTITION BY arquivo ORDER BY rnk, tie, ordem, layout) AS rn
  FROM cand) c WHERE rn = 1)
SELECT n.arquivo, b.layout,
       CASE b.rnk WHEN 1 THEN 'exata' WHEN 2 THEN 'sem_ano' WHEN 3 THEN 'prefixo' END AS regra
FROM n LEFT JOIN best b ON n.arquivo = b.arquivo""", raw_sql=True)
def q_resolve_layout(spark, d):
    return R.resolve_layout(order_file_names(spark, d))


ORDER_FOLDER_SQL = """
  CASE o_orderstatus WHEN 'F' THEN 'exp' WHEN 'O' THEN 'imp' ELSE 'estabelecimentos' END
  || CASE o_orderpriority WHEN '1-URGENT' THEN '_mun'
                          WHEN '2-HIGH' THEN '_' || CAST(year(o_orderdate) AS VARCHAR)
                          ELSE '' END"""


def _registry_case_sql(expr: str) -> str:
    from tradestar.layouts import REGISTRY_ARCHIVES
    whens = " ".join(f"WHEN '{folder}' THEN '{entity}'"
                     for entity, (_, folder) in REGISTRY_ARCHIVES.items())
    return f"CASE {expr} {whens} END"


@register("resolve_layout_by_table", f"""
WITH p AS (SELECT DISTINCT {ORDER_FOLDER_SQL} AS pasta FROM orders),
r AS (SELECT pasta, {_registry_case_sql('lower(pasta)')} AS reg,
             CASE WHEN contains(lower(pasta), '_mun') AND contains(lower(pasta), 'exp')
                    THEN 'EXP_2021_MUN'
                  WHEN contains(lower(pasta), '_mun') AND contains(lower(pasta), 'imp')
                    THEN 'IMP_2021_MUN'
                  WHEN NOT contains(lower(pasta), '_mun') AND contains(lower(pasta), 'exp')
                    THEN 'EXPO_2021'
                  WHEN NOT contains(lower(pasta), '_mun') AND contains(lower(pasta), 'imp')
                    THEN 'IMP_2021' END AS trade
      FROM p)
SELECT pasta, CASE WHEN reg IS NOT NULL THEN 'cnpj' WHEN trade IS NOT NULL THEN 'balanca' END
         AS dominio, coalesce(reg, trade) AS layout
FROM r""", raw_sql=True)
def q_resolve_layout_by_table(spark, d):
    o = S.table(spark, d, "orders")
    base = (F.when(F.col("o_orderstatus") == "F", "exp")
            .when(F.col("o_orderstatus") == "O", "imp").otherwise("estabelecimentos"))
    suffix = (F.when(F.col("o_orderpriority") == "1-URGENT", "_mun")
              .when(F.col("o_orderpriority") == "2-HIGH",
                    F.concat(F.lit("_"), F.year("o_orderdate").cast("string")))
              .otherwise(""))
    folders = o.select(F.concat(base, suffix).alias("pasta")).distinct()
    return R.resolve_layout_by_table(folders)


PAGE_FILE_SQL = """
  regexp_extract(url, '//([^./]+)', 1) || '_' || CAST(page_id AS VARCHAR) ||
  CASE WHEN contains(url, '#') THEN '.K3241.EMPRECSV'
       WHEN contains(url, '?') THEN '.json'
       WHEN contains(url, '.org/') THEN '.zip'
       WHEN contains(url, '/en/') THEN '.csv'
       WHEN contains(url, '/fr/') THEN '.parquet'
       WHEN contains(url, '/de/') THEN '.xlsx'
       WHEN contains(url, '/es/') THEN '.txt'
       ELSE '.dat' END"""


def page_file_names(spark, d):
    url = F.col("url")
    ext = (F.when(url.contains("#"), ".K3241.EMPRECSV").when(url.contains("?"), ".json")
           .when(url.contains(".org/"), ".zip").when(url.contains("/en/"), ".csv")
           .when(url.contains("/fr/"), ".parquet").when(url.contains("/de/"), ".xlsx")
           .when(url.contains("/es/"), ".txt").otherwise(".dat"))
    return S.table(spark, d, "pages").select(
        F.concat(F.regexp_extract(url, r"//([^./]+)", 1), F.lit("_"),
                 F.col("page_id").cast("string"), ext).alias("arquivo"))


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _classify_sql() -> str:
    from tradestar.layouts import REGISTRY_EXTENSIONS, SUPPORTED_EXTENSIONS
    reg = f"(ext IN {_in(REGISTRY_EXTENSIONS)} OR (contains(ext, 'csv') AND length(ext) > 4))"
    return f"""
WITH f AS (SELECT {PAGE_FILE_SQL} AS arquivo FROM pages),
e AS (SELECT arquivo, lower(regexp_extract(arquivo, '(\\.[^./]+)$', 1)) AS ext FROM f)
SELECT arquivo, ext AS extensao, ext IN {_in(SUPPORTED_EXTENSIONS)} AS suportado,
       CASE WHEN ext = '.zip' THEN 'zip'
            WHEN {reg} OR ext IN ('.csv', '.txt') THEN 'csv'
            WHEN ext = '.parquet' THEN 'parquet' WHEN ext = '.json' THEN 'json'
            WHEN ext = '.xlsx' THEN 'excel' ELSE 'unknown' END AS formato,
       CASE WHEN {reg} THEN FALSE WHEN ext IN ('.csv', '.txt', '.xlsx') THEN TRUE END AS header,
       CASE WHEN {reg} THEN ';' END AS delimitador,
       CASE WHEN {reg} THEN 'ISO-8859-1' WHEN ext IN ('.csv', '.txt') THEN 'UTF-8' END AS encoding,
       ext = '.json' AS multiline, ext = '.zip' AS compactado
FROM e"""


@register("classify_files", _classify_sql(), raw_sql=True)
def q_classify_files(spark, d):
    return R.classify_files(page_file_names(spark, d))


def _dec_text(c):
    return F.col(c).cast("decimal(18,2)").cast("string")


def text_lines(spark, d):
    """Delimited text lines of four 'files' built from the tables."""
    s = S.table(spark, d, "supplier").select(
        F.lit("fornecedores.txt").alias("arquivo"), (F.col("s_suppkey") + 1).alias("n_linha"),
        F.concat_ws(";", F.col("s_suppkey").cast("string"), "s_name",
                    F.col("s_nationkey").cast("string"), _dec_text("s_acctbal")).alias("linha"))
    p = S.table(spark, d, "part").select(
        F.lit("produtos.txt").alias("arquivo"), (F.col("p_partkey") + 1).alias("n_linha"),
        F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type",
                    F.col("p_size").cast("string")).alias("linha"))
    c = S.table(spark, d, "customer").select(
        F.lit("clientes.csv").alias("arquivo"), (F.col("c_custkey") + 1).alias("n_linha"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment",
                    _dec_text("c_acctbal")).alias("linha"))
    e = S.table(spark, d, "events").select(
        F.lit("eventos.tsv").alias("arquivo"), (F.col("event_id") + 1).alias("n_linha"),
        F.concat_ws("\t", F.col("event_id").cast("string"), "event_type", "props").alias("linha"))
    return s.unionByName(p).unionByName(c).unionByName(e)


SNIFF_SQL = """
WITH lines AS (
  SELECT 'fornecedores.txt' AS arquivo, s_suppkey + 1 AS n,
         concat_ws(';', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
                   CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR)) AS linha FROM supplier
  UNION ALL
  SELECT 'produtos.txt', p_partkey + 1,
         concat_ws('|', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type,
                   CAST(p_size AS VARCHAR)) FROM part
  UNION ALL
  SELECT 'clientes.csv', c_custkey + 1,
         concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment,
                   CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)) FROM customer
  UNION ALL
  SELECT 'eventos.tsv', event_id + 1,
         concat_ws(chr(9), CAST(event_id AS VARCHAR), event_type, props) FROM events
),
cands AS (SELECT * FROM (VALUES (0, ','), (1, ';'), (2, chr(9)), (3, '|')) c(ordem, d)),
per_line AS (SELECT s.arquivo, c.ordem, c.d,
                    length(s.linha) - length(replace(s.linha, c.d, '')) AS k
             FROM lines s CROSS JOIN cands c),
modes AS (SELECT arquivo, ordem, d, k, count(*) AS linhas FROM per_line WHERE k > 0
          GROUP BY arquivo, ordem, d, k),
best AS (SELECT arquivo, d FROM (SELECT *, row_number() OVER (PARTITION BY arquivo
           ORDER BY linhas DESC, k DESC, ordem ASC) AS rn FROM modes) m WHERE rn = 1),
files AS (SELECT DISTINCT arquivo FROM lines UNION SELECT 'vazio.csv')
SELECT f.arquivo, coalesce(b.d, ',') AS delimitador, b.d IS NULL AS padrao
FROM files f LEFT JOIN best b ON f.arquivo = b.arquivo"""


@register("sniff_delimiter", SNIFF_SQL, raw_sql=True)
def q_sniff_delimiter(spark, d):
    lines = text_lines(spark, d)
    files = lines.select("arquivo").unionByName(
        spark.createDataFrame([("vazio.csv",)], "arquivo string"))
    return R.sniff_delimiter(lines, files=files)


# --------------------------------------------------------------------------- inventories
LISTING_SQL = """
  SELECT regexp_extract(url, '//([^./]+)', 1) AS pasta, CAST(page_id AS VARCHAR) || '.html' AS arquivo,
         CAST(strlen(html) AS BIGINT) AS bytes FROM pages"""


def page_listing(spark, d):
    """The stored pages as a listing of files: folder, name, size."""
    return S.table(spark, d, "pages").select(
        F.regexp_extract("url", r"//([^./]+)", 1).alias("pasta"),
        F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("arquivo"),
        F.octet_length("html").cast("bigint").alias("bytes"))


EXPECTED = ["www", "site0", "estabelecimentos", "empresas"]


@register("file_inventory", f"""
SELECT pasta AS container, count(*) AS n_arquivos, round(sum(bytes) / 1024.0, 2) AS total_kb,
       sum(bytes) = 0 AS vazio
FROM ({LISTING_SQL}) f GROUP BY pasta""", raw_sql=True)
def q_file_inventory(spark, d):
    """Per container: file count, KB and an empty flag."""
    return FS.inventory_of(page_listing(spark, d))


@register("expected_folders_status", f"""
SELECT e.nome, CASE WHEN EXISTS (SELECT 1 FROM ({LISTING_SQL}) f WHERE f.pasta = e.nome)
                    THEN 'exists' ELSE 'pending' END AS status
FROM (VALUES {", ".join(f"('{e}')" for e in EXPECTED)}) e(nome)""", raw_sql=True)
def q_expected_folders_status(spark, d):
    return FS.presence_of(page_listing(spark, d), EXPECTED)


@register("list_entities", f"""
SELECT DISTINCT pasta AS entidade FROM ({LISTING_SQL}) f ORDER BY entidade""", raw_sql=True)
def q_list_entities(spark, d):
    return FS.entities_of(page_listing(spark, d))


@register("list_known_entities", f"""
SELECT DISTINCT pasta AS entidade FROM ({LISTING_SQL}) f WHERE pasta IN ('{"', '".join(EXPECTED)}')
ORDER BY entidade""", raw_sql=True)
def q_list_known_entities(spark, d):
    """Folders of the listing that are entities by name."""
    return FS.entities_of(page_listing(spark, d), EXPECTED)


#: Files of one table in the formats that classification knows, with the
#: delimiter that was sniffed for the text ones.
CLASSIFIED = {"a.parquet": None, "b.json": None, "c.csv": ",", "d.txt": "|", "e.EMPRECSV": ";"}


@register("read_by_classification", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS arquivo, CAST(o_orderkey AS VARCHAR) AS chave, o_orderpriority AS prioridade, "
    f"{'NULL' if sep is None else chr(39) + sep + chr(39)} AS delimitador FROM orders"
    for name, sep in CLASSIFIED.items()), raw_sql=True)
def q_read_by_classification(spark, d):
    """Orders written in five formats, each read back by the instructions that
    classification derives from its name."""
    root = scratch_path(spark, "classified")
    rows = S.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("chave"),
                                              F.col("o_orderpriority").alias("prioridade"))
    rows.write.parquet(f"{root}/a.parquet")
    rows.write.json(f"{root}/b.json")
    for name, sep in CLASSIFIED.items():
        if sep:
            rows.write.csv(f"{root}/{name}", sep=sep, header=not name.endswith("EMPRECSV"), encoding="UTF-8")
    names = spark.createDataFrame([(n,) for n in CLASSIFIED], "arquivo string")
    parts = []
    for i in sorted(R.classify_files(names).collect(), key=lambda r: r["arquivo"]):
        sep = i["delimitador"] or CLASSIFIED[i["arquivo"]]
        # a folder of Spark's JSON files holds one object to a line
        df = FS.read_classified(spark, f"{root}/{i['arquivo']}", i["formato"], i["header"], sep, i["encoding"])
        if not i["header"] and i["formato"] == "csv":
            df = df.toDF("chave", "prioridade")
        parts.append(df.select(F.lit(i["arquivo"]).alias("arquivo"), "chave", "prioridade",
                               F.lit(sep).cast("string").alias("delimitador")))
    return reduce(DataFrame.unionByName, parts)


@register("compaction_plan", f"""
SELECT pasta AS tabela, count(*) AS n_arquivos, CAST(sum(bytes) AS BIGINT) AS bytes,
       CAST(greatest(1, ceil(sum(bytes) / {COMPACTION_TARGET_BYTES})) AS INTEGER) AS n_alvo,
       count(*) > greatest(1, ceil(sum(bytes) / {COMPACTION_TARGET_BYTES})) AS compactar
FROM ({LISTING_SQL}) f GROUP BY pasta""", raw_sql=True)
def q_compaction_plan(spark, d):
    return SK.compaction_of(page_listing(spark, d))
