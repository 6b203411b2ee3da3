"""Fixture tests for what SQL cannot express: landing CSVs, ZIP archives,
delimiter sniffing, layout resolution and file inventories."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tradestar.layouts import source_schema
from tradestar.operators import resolve as R
from tradestar.operators import silver as SV
from tradestar.sources import archives as A
from tradestar.sources import files as FS
from tradestar.sources import sinks as SK

EXP_HEADER = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"
MUN_HEADER = "CO_ANO;CO_MES;SH4;CO_PAIS;SG_UF_MUN;CO_MUN;KG_LIQUIDO;VL_FOB"
IMP_HEADER = EXP_HEADER + ";VL_FRETE;VL_SEGURO"


def _write(path, text, enc="ISO-8859-1"):
    with open(path, "wb") as fh:
        fh.write(text.encode(enc))


@pytest.fixture()
def landing(tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    _write(d / "EXP_2021.csv", "\n".join([
        EXP_HEADER,
        "2021;1;01012100;10;063;SP;1;0817600;10;120.5;1500.50",
        "2021;2;01012100;10;063;;1;0817600;5;60;",
        "2021;2;01012100;10;063;;1;0817600;5;60;",
    ]) + "\n")
    _write(d / "EXP_2021_MUN.csv", MUN_HEADER + "\n2021;1;0101;063;SP;3550308;10;100\n")
    _write(d / "IMP_2021.csv", "\n".join([
        IMP_HEADER,
        "2021;3;N/A;10;160;RJ;4;0717700;1;2;30;4.5;0.5",
        "2021;3;02011000;10;160;RJ;4;0717700;1;2;30;4.5;0.5",
    ]) + "\n")
    return str(d)


def test_scan_entity_exact_year_glob_skips_municipal_file(spark, landing):
    exp = FS.scan_csv_entity(spark, landing, "exp")
    rows = exp.orderBy("mes").collect()
    assert len(rows) == 3                       # the _MUN decoy is not read
    assert rows[0]["codigo_ncm"] == "01012100"  # leading zero kept (string)
    assert rows[0]["codigo_pais_destino"] == "063"
    assert str(rows[0]["valor_fob_usd"]) == "1500.50"
    assert rows[1]["uf_origem"] is None and rows[1]["valor_fob_usd"] is None
    mun = FS.scan_csv_entity(spark, landing, "exp_mun")
    assert mun.columns[:3] == ["ano", "mes", "codigo_sh4"] and mun.count() == 1


def test_header_check_rejects_other_layout(spark, landing):
    df = FS.scan_csv(spark, landing, source_schema("EXPO_2021"), glob="EXP_2021_MUN.csv")
    with pytest.raises(Exception):
        df.collect()


def test_import_code_na_is_rejected_by_fact_gate(spark, landing):
    from tradestar.operators import gold as G
    imp = FS.scan_csv_entity(spark, landing, "imp")
    exp = FS.scan_csv_entity(spark, landing, "exp")
    fact = G.build_fact(exp, imp, imp_extra={"valor_frete_usd": "valor_frete"})
    rows = fact.filter(F.col("tipo_movimentacao") == "IMPORTACAO").collect()
    assert len(rows) == 1 and rows[0]["sk_ncm"] == 2011000
    assert str(rows[0]["valor_frete"]) == "4.50"
    exp_rows = fact.filter(F.col("tipo_movimentacao") == "EXPORTACAO").collect()
    assert all(r["valor_frete"] is None for r in exp_rows)
    assert {r["sk_geografia_uf"] for r in exp_rows} == {8380, 8888}


def test_silver_chain_dedups_and_fills(spark, landing):
    exp = FS.scan_csv_entity(spark, landing, "exp")
    clean = SV.silver_clean(exp, protect=SV.key_columns(exp.columns))
    rows = clean.orderBy("mes").collect()
    assert len(rows) == 2                        # the exact duplicate collapsed
    assert rows[1]["uf_origem"] is None          # key columns keep their nulls
    assert float(rows[1]["valor_fob_usd"]) == 0.0  # measures are filled
    again = SV.silver_clean(clean, protect=SV.key_columns(exp.columns), fill_first=True)
    assert again.count() == clean.count()


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, text in members:
            zf.writestr(name, text.encode("ISO-8859-1"))


def test_zip_members_latin1_quoted_and_overflow(spark, tmp_path):
    z = tmp_path / "zips"
    z.mkdir()
    _zip(z / "Cnaes0.zip", [("F.K03200$Z.D40113.CNAECSV",
                             '"0111301";"Cultivo de arroz ç"\n"0111302";"Milho; doce"\n')])
    _zip(z / "Empresas0.zip", [
        ("a.EMPRECSV", ";".join(f'"{i}"' for i in range(12)) + "\n"),
        ("b.EMPRECSV", ";".join(f'"{i}"' for i in range(6)) + "\n"),
    ])
    cnae = A.ingest_registry_batch(A.read_archives(spark, str(z), "Cnaes*.zip"), "CNAECSV")
    rows = {r["cnae"]: r["descricao"] for r in cnae.collect()}
    assert rows == {"0111301": "Cultivo de arroz ç", "0111302": "Milho; doce"}
    assert set(cnae.columns) >= {"file_source", "ingestion_timestamp"}
    emp = A.ingest_registry_batch(A.read_archives(spark, str(z), "Empresas*.zip"), "EMPRECSV")
    assert emp.columns[10:12] == ["_c10", "_c11"]
    short = emp.filter(F.col("razao_social") == "1").filter(F.col("_c10").isNull())
    assert short.count() == 1 and short.first()["natureza_juridica"] is None


def test_choose_member_skips_macosx(spark, tmp_path):
    z = tmp_path / "multi"
    z.mkdir()
    _zip(z / "Multi.zip", [("__MACOSX/x", "junk\n"), ("readme.md", "hello\n" * 50),
                           ("a.ESTABELE", '"1";"2"\n')])
    members = A.list_members(A.read_archives(spark, str(z)))
    chosen = R.choose_member(members)
    assert [r["membro"] for r in chosen.collect()] == ["a.ESTABELE"]
    _zip(z / "NoExt.zip", [("small.bin", "x\n"), ("big.bin", "y\n" * 100)])
    chosen = R.choose_member(A.list_members(A.read_archives(spark, str(z), "NoExt.zip")))
    assert [r["membro"] for r in chosen.collect()] == ["big.bin"]


def test_sniff_delimiter_cases(spark):
    lines = []
    for name, sep in (("a.txt", "\t"), ("b.csv", "|"), ("c.txt", ",")):
        for i in range(20):
            lines.append((name, i + 1, sep.join(["x", str(i), "y z"])))
    df = spark.createDataFrame(lines, "arquivo string, n_linha long, linha string")
    files = spark.createDataFrame([("a.txt",), ("b.csv",), ("c.txt",), ("empty.csv",)],
                                  "arquivo string")
    out = {r["arquivo"]: (r["delimitador"], r["padrao"])
           for r in R.sniff_delimiter(df, files=files).collect()}
    assert out == {"a.txt": ("\t", False), "b.csv": ("|", False), "c.txt": (",", False),
                   "empty.csv": (",", True)}
    # a caller may ask for a sample: then a later majority does not count
    late = spark.createDataFrame([("x", 1, "a;b"), ("x", 2, "c;d")] + [("x", 3 + i, "1,2") for i in range(9)],
                                 "arquivo string, n_linha long, linha string")
    assert R.sniff_delimiter(late).first()["delimitador"] == ","
    assert R.sniff_delimiter(late, sample_bytes=8).first()["delimitador"] == ";"


def test_resolve_layout_rules(spark):
    names = ["EXP_2022.csv", "IMP_2020.csv", "EXP_2021_MUN.csv", "NCM.csv", "NCM_SH_X.csv",
             "XYZ.csv", "PAIS_BLOCO.csv"]
    df = spark.createDataFrame([(n,) for n in names], "arquivo string")
    out = {r["arquivo"]: (r["layout"], r["regra"]) for r in R.resolve_layout(df).collect()}
    assert out["EXP_2022.csv"] == ("EXPO_2021", "sem_ano")   # through the EXP alias
    assert out["IMP_2020.csv"] == ("IMP_2021", "sem_ano")
    assert out["EXP_2021_MUN.csv"] == ("EXP_2021_MUN", "exata")
    assert out["NCM.csv"] == ("NCM", "exata")
    assert out["NCM_SH_X.csv"] == ("NCM_SH", "prefixo")      # longest prefix wins
    assert out["XYZ.csv"] == (None, None)
    assert out["PAIS_BLOCO.csv"] == ("PAIS_BLOCO", "exata")


def test_classify_files(spark):
    names = ["a.csv", "b.K3241.EMPRECSV", "c.zip", "d.parquet", "e.json", "f.xlsx", "g.bin",
             "h.ESTABELE"]
    df = spark.createDataFrame([(n,) for n in names], "arquivo string")
    out = {r["arquivo"]: r for r in R.classify_files(df).collect()}
    assert out["a.csv"]["formato"] == "csv" and out["a.csv"]["header"] is True
    assert out["b.K3241.EMPRECSV"]["delimitador"] == ";"
    assert out["h.ESTABELE"]["encoding"] == "ISO-8859-1"
    assert out["c.zip"]["compactado"] is True
    assert out["e.json"]["multiline"] is True
    assert out["g.bin"]["formato"] == "unknown"


def test_inventory_and_compaction(spark, tmp_path):
    root = tmp_path / "small"
    spark.range(4000).repartition(40).write.parquet(str(root / "t1"))
    inv = {r["container"]: r for r in FS.file_inventory(spark, str(root)).collect()}
    assert inv["t1"]["n_arquivos"] >= 40
    plan = SK.compaction_plan(spark, str(root)).collect()
    assert plan[0]["n_alvo"] == 1 and plan[0]["compactar"] is True
    n = SK.compact(spark, str(root / "t1"), str(tmp_path / "t1c"), plan[0]["bytes"])
    assert n == 1 and spark.read.parquet(str(tmp_path / "t1c")).count() == 4000
    by_month = str(tmp_path / "by_month")
    spark.range(900).selectExpr("id % 3 AS mes", "id").write.partitionBy("mes").parquet(by_month)
    SK.compact(spark, by_month, str(tmp_path / "m2"), 10, partition_by=("mes",), sort_by=("id",))
    back = spark.read.parquet(str(tmp_path / "m2"))
    assert (tmp_path / "m2" / "mes=1").is_dir() and back.count() == 900
    for f in (tmp_path / "m2" / "mes=1").glob("*.parquet"):
        ids = [r["id"] for r in spark.read.parquet(str(f)).collect()]
        assert ids == sorted(ids)
    status = {r["nome"]: r["status"] for r in
              FS.expected_folders_status(spark, str(root), ["t1", "t2"]).collect()}
    assert status == {"t1": "exists", "t2": "pending"}


def test_overwrite_replaces_and_snapshot_is_dynamic(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2020, 1, "a"), (2021, 2, "b")], "ano int, mes int, v string")
    assert SK.overwrite_partitioned(df, path) == ["ano", "mes"]
    SK.overwrite_partitioned(df.filter("ano = 2021"), path)
    assert spark.read.parquet(path).count() == 1          # full replace
    snap = str(tmp_path / "s")
    SK.write_snapshot(df, snap, ["ano"])
    SK.write_snapshot(df.filter("ano = 2021").withColumn("v", F.lit("c")), snap, ["ano"])
    got = {r["ano"]: r["v"] for r in spark.read.parquet(snap).collect()}
    assert got == {2020: "a", 2021: "c"}                   # other months untouched


def test_read_table_recursive(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.range(10).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(path)
    assert FS.read_table(spark, path).count() == 10
    assert "p" in FS.read_table(spark, path).columns
    assert "p" not in FS.read_table(spark, path, recursive=True).columns
    assert os.path.isdir(path)


def test_project_by_mapping_skips_missing_and_drops_unmapped(spark):
    df = spark.createDataFrame([("1", "x", "z")], "CO_PAIS string, NO_PAIS string, XYZ string")
    out = FS.project_by_mapping(df, {"CO_PAIS": "codigo_pais", "NO_PAIS": "nome_pais_pt",
                                     "NO_PAIS_ING": "nome_pais_en"})
    assert out.columns == ["codigo_pais", "nome_pais_pt"]


def test_zip_stream_source_needs_schema(spark, tmp_path):
    z = tmp_path / "zs"
    z.mkdir()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("m.MOTIVOS", '"01";"EXTINCAO"\n')
    (z / "Motivos0.zip").write_bytes(buf.getvalue())
    stream = A.stream_archives(spark, str(z), "Motivos*.zip")
    assert stream.isStreaming and "content" in stream.columns


def test_read_classified_json_multiline_and_csv(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"k": 1},\n {"k": 2}\n]\n')
    (tmp_path / "b.txt").write_text("x|y\n1|2\n")
    names = spark.createDataFrame([("a.json",), ("b.txt",)], "arquivo string")
    info = {r["arquivo"]: r for r in R.classify_files(names).collect()}
    j = info["a.json"]
    df = FS.read_classified(spark, str(tmp_path / "a.json"), j["formato"],
                            multiline=j["multiline"])
    assert sorted(r["k"] for r in df.collect()) == [1, 2]
    t = info["b.txt"]
    df = FS.read_classified(spark, str(tmp_path / "b.txt"), t["formato"], t["header"], "|",
                            t["encoding"])
    assert df.columns == ["x", "y"] and df.count() == 1


def test_optimize_table_rewrites_small_files(spark, tmp_path):
    src = str(tmp_path / "many")
    spark.range(2000).repartition(20).write.parquet(src)
    n = SK.optimize_table(spark, src, str(tmp_path / "few"))
    assert n == 1 and spark.read.parquet(str(tmp_path / "few")).count() == 2000
    assert SK.optimize_table(spark, str(tmp_path / "few"), str(tmp_path / "again")) is None


def test_treat_nulls_fills_nan_and_keeps_protected(spark):
    df = spark.createDataFrame([(float("nan"), None, None, "x")],
                               "d double, i int, s string, k string")
    row = SV.treat_nulls(df.withColumn("k", F.lit(None).cast("string")), protect=["k"]).first()
    assert row["d"] == 0.0 and row["i"] == 0 and row["s"] == "N/A" and row["k"] is None


def test_dedup_latest_keeps_newest_then_largest_source(spark):
    import datetime as dt
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([("a", t1, "f0"), ("a", t2, "f1"), ("a", t2, "f2"), ("b", t1, "f0")],
                               "k string, ingestion_timestamp timestamp_ntz, file_source string")
    out = {r["k"]: (r["ingestion_timestamp"], r["file_source"])
           for r in SV.dedup_latest(df, ["k"], ["ingestion_timestamp", "file_source"]).collect()}
    assert out == {"a": (t2, "f2"), "b": (t1, "f0")}


def test_validate_schema_reports_wrong_type(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    want = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType())])
    rows = {(r["coluna"], r["problema"]): r["n_linhas"]
            for r in SV.validate_schema(df, want).collect()}
    assert rows == {("a", "wrong_type"): None, ("b", "invalid_values"): 1}


def test_register_tables_run_sql_over_the_lake(spark, tmp_path):
    from tradestar.sources.tables import register_tables
    fact, dim = str(tmp_path / "f"), str(tmp_path / "d")
    spark.createDataFrame([(1, "EXPORTACAO", 10), (2, "IMPORTACAO", 5)],
                          "k int, tipo_movimentacao string, v int") \
        .write.partitionBy("tipo_movimentacao").parquet(fact)
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, nome string").write.parquet(dim)
    sql = ("SELECT d.nome, SUM(f.v) AS v FROM gold.fato f JOIN gold.dim d ON f.k = d.k "
           "WHERE f.tipo_movimentacao = 'EXPORTACAO' GROUP BY d.nome")
    register_tables(spark, {"fato": fact, "dim": dim}, location=str(tmp_path / "gold.db"))
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("a", 10)]
