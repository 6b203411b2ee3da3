"""End-to-end medallion job on a small landing folder (trade CSVs and
registry ZIPs), including an incremental rerun."""

import zipfile
from decimal import Decimal

from pyspark.sql import functions as F

from tradestar.plans import pipeline as P

EXP_H = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"
IMP_H = EXP_H + ";VL_FRETE;VL_SEGURO"


def _csv(path, lines):
    path.write_bytes(("\n".join(lines) + "\n").encode("ISO-8859-1"))


def _zip(path, member, lines):
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr(member, ("\n".join(lines) + "\n").encode("ISO-8859-1"))


def make_landing(d):
    _csv(d / "EXP_2021.csv", [EXP_H,
                              "2021;1;01012100;10;063;SP;1;0817600;10;120.5;1500.50",
                              "2021;1;01012100;10;063;SP;1;0817600;10;120.5;1500.50",
                              "2021;2;02011000;10;249; rj ;4;0817600;5;60;300"])
    _csv(d / "IMP_2021.csv", [IMP_H,
                              "2021;1;N/A;10;160;RJ;4;0717700;1;2;30;4.5;0.5",
                              "2021;2;01012100;10;160;;1;0717700;2;3;200;1;1",
                              "2021;2;01012100;10;160;;1;0717700;2;3;abc;1;1"])
    _csv(d / "EXP_2021_MUN.csv", ["CO_ANO;CO_MES;SH4;CO_PAIS;SG_UF_MUN;CO_MUN;KG_LIQUIDO;VL_FOB",
                                  "2021;1;0101;063;SP;3550308;10;100"])
    _csv(d / "NCM.csv", ["CO_NCM;CO_UNID;CO_FAT_AGREG;CO_PPE;NO_NCM_POR;NO_NCM_ING",
                         "01012100;10;01;1001;Cavalos reprodutores;Horses",
                         "02011000;10;02;;Carnes;Meat"])
    _csv(d / "NCM_FAT_AGREG.csv", ["CO_FAT_AGREG;NO_FAT_AGREG;NO_FAT_AGREG_GP",
                                   "01;PRODUTOS BASICOS;BASICOS"])
    _csv(d / "NCM_PPE.csv", ["CO_PPE;NO_PPE;NO_PPE_MIN;NO_PPE_ING", "1001;Cavalos;Cav;Horses"])
    _csv(d / "VIA.csv", ["CO_VIA;NO_VIA", "1;MARITIMA", "4;AEREA", "4;AEREA 2"])
    _csv(d / "PAIS.csv", ["CO_PAIS;CO_PAIS_ISON3;CO_PAIS_ISOA3;NO_PAIS;NO_PAIS_ING;NO_PAIS_ESP",
                          "063;032;ARG;Argentina;Argentina;Argentina",
                          "160;156;CHN;China;China;China",
                          "249;840;USA;Estados Unidos;United States;Estados Unidos"])
    _csv(d / "PAIS_BLOCO.csv", ["CO_PAIS;CO_BLOCO;NO_BLOCO;NO_BLOCO_ING;NO_BLOCO_ESP",
                                "063;111;Mercosul;Mercosur;Mercosur",
                                "063;22;América do Sul;South America;America del Sur"])
    _csv(d / "UF.csv", ["CO_UF;SG_UF;NO_UF;NO_REGIAO", "35;SP;São Paulo;Sudeste",
                        "33;RJ;Rio de Janeiro;Sudeste"])
    _zip(d / "Estabelecimentos0.zip", "K.ESTABELE",
         ['"00000001";"0001";"12";"1";"LOJA";"02";"";"";"";"";"";"6204000"' + ';""' * 7
          + ';"SP"' + ';""' * 10,
          '"00000002";"0001";"12";"1";"OUTRA";"08";"";"";"";"";"";"6204000"' + ';""' * 7
          + ';"SP"' + ';""' * 10])
    _zip(d / "Empresas0.zip", "K.EMPRECSV", ['"00000001";"ACME";"";"1000,00";"03";"";"";"";"";""',
                                             '"00000002";"BETA";"";"10,00";"01";"";"";"";"";""'])
    _zip(d / "Cnaes0.zip", "K.CNAECSV", ['"6204000";"Consultoria em TI"'])
    _zip(d / "Motivos0.zip", "K.MOTIVOS", ['"01";"EXTINCAO";"EXTRA"'])


def test_medallion_job_end_to_end(spark, tmp_path):
    landing, root = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    make_landing(landing)
    report = {(r["camada"], r["entidade"]): r for r in P.run(spark, str(landing), str(root),
                                                              min_year=2021).collect()}
    assert report[("bronze", "exp")]["linhas"] == 3
    assert report[("bronze", "exp_mun")]["linhas"] == 1
    assert report[("bronze", "ncm_cgce")]["status"] in ("SEM_ARQUIVOS", "ERRO", "SEM_NOVOS")
    assert report[("bronze", "estabelecimentos")]["status"] == "OK"
    assert report[("bronze", "estabelecimentos")]["linhas"] == 2       # rows, not archives
    assert report[("bronze", "motivos/lote_0")]["status"] == "AVISO"   # 3 columns, layout has 2
    assert report[("gold", "ft_balanco_comercial")]["status"] == "OK"
    assert report[("silver", "exp")]["linhas"] == 2            # duplicate collapsed
    assert report[("silver", "imp")]["mensagem"] == "1 linhas rejeitadas na tipagem"
    rej = P.FS.read_table(spark, P.Lake(str(root)).path("trusted", P.TRADE, "_rejeitos/imp"))
    assert [r["erro_tipagem"] for r in rej.collect()] == ["valor_fob_usd"]

    lake = P.Lake(str(root))
    fact = P.gold_table(spark, lake, "ft_balanco_comercial")
    # exports: duplicate collapsed in silver; imports: the 'N/A' code is rejected
    counts = {r["tipo_movimentacao"]: r["count"] for r in
              fact.groupBy("tipo_movimentacao").count().collect()}
    assert counts == {"EXPORTACAO": 2, "IMPORTACAO": 1}
    states = {r["sk_geografia_uf"] for r in fact.collect()}
    assert 8380 in states and 8274 in states           # SP, and ' rj ' cleaned to RJ
    via = P.gold_table(spark, lake, "dim_via_transporte")
    assert via.filter(F.col("sk_via_transporte") == 4).first()["nome_via"] == "AEREA"
    geo = P.gold_table(spark, lake, "dim_geografia")
    arg = geo.filter(F.col("sk_geografia") == 63).collect()
    assert len(arg) == 1 and arg[0]["regiao_ou_bloco"] == "AMÉRICA DO SUL"   # silver upper-cases
    assert "MERCOSUL" in arg[0]["blocos"]
    sp = geo.filter(F.col("sigla") == "SP").first()
    assert sp["nome_geografia"] == "SÃO PAULO" and sp["regiao_ou_bloco"] == "SUDESTE"
    ncm = {r["sk_ncm"]: r for r in P.gold_table(spark, lake, "dim_ncm").collect()}
    assert ncm[1012100]["fator_agregado"] == "PRODUTOS BASICOS"
    assert ncm[2011000]["fator_agregado"] is None

    marts = P.marts(spark, lake, 2021)
    bal = {(r["ano"], r["mes"]): r for r in marts["balanca_mensal"].collect()}
    assert bal[(2021, 1)]["total_exportacao"] == Decimal("1500.50")
    assert bal[(2021, 2)]["total_importacao"] == Decimal("200.00")
    assert bal[(2021, 2)]["saldo_comercial"] == Decimal("100.00")
    dist = P.gold_table(spark, lake, "dim_distribuicao_estabelecimentos").collect()
    assert [(r["descricao"], r["porte_empresa"], r["Total_empresas"]) for r in dist] == [
        ("CONSULTORIA EM TI", "EMPRESA DE PEQUENO PORTE", 1)]

    # incremental rerun: no new files, nothing new in bronze, same gold
    again = {(r["camada"], r["entidade"]): r for r in
             P.run(spark, str(landing), str(root), min_year=2021).collect()}
    assert again[("bronze", "exp")]["linhas"] == 0
    assert P.gold_table(spark, lake, "ft_balanco_comercial").count() == 3


def test_job_with_exports_only_and_empty_landing(spark, tmp_path):
    landing, root = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    _csv(landing / "EXP_2020.csv", [EXP_H, "2020;5;01012100;10;063;SP;1;0817600;1;2;10"])
    report = {(r["camada"], r["entidade"]): r for r in
              P.run(spark, str(landing), str(root), min_year=2020, allow_absent=("imp",)).collect()}
    assert report[("gold", "ft_balanco_comercial")]["status"] == "OK"
    assert report[("gold", "ft_balanco_comercial")]["linhas"] == 1
    assert report[("gold", "entrada/imp")]["status"] == "AUSENTE"
    assert report[("gold", "dim_ncm")]["status"] == "SEM_DADOS"
    fact = P.gold_table(spark, P.Lake(str(root)), "ft_balanco_comercial")
    assert fact.count() == 1
    empty, root2 = tmp_path / "empty", tmp_path / "lake2"
    empty.mkdir()
    report = {(r["camada"], r["entidade"]): r["status"] for r in
              P.run(spark, str(empty), str(root2)).collect()}
    assert report[("gold", "ft_balanco_comercial")] == "SEM_DADOS"
    assert report[("bronze", "exp")] == "SEM_ARQUIVOS"


def test_an_unreadable_input_is_never_published(spark, tmp_path):
    """A complete fact stays as it is when one of its inputs cannot be read."""
    landing, root = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    make_landing(landing)
    P.run(spark, str(landing), str(root), min_year=2021)
    lake = P.Lake(str(root))
    before = P.gold_table(spark, lake, "ft_balanco_comercial").count()
    for f in (root / "trusted" / P.TRADE / "exp").rglob("*.parquet"):
        f.write_bytes(b"not a table")
    for f in (root / "trusted" / P.TRADE / "exp").rglob(".*.crc"):
        f.unlink()
    P.gold(spark, lake)
    report = {(r["camada"], r["entidade"]): r["status"] for r in lake.report(spark).collect()}
    assert report[("gold", "ft_balanco_comercial")] == "ERRO" and report[("gold", "dim_ncm")] == "OK"
    assert P.gold_table(spark, lake, "ft_balanco_comercial").count() == before


def test_archives_of_two_widths_keep_every_column(spark, tmp_path):
    for order in ((0, 1), (1, 0)):
        landing, root = tmp_path / f"l{order[0]}", tmp_path / f"r{order[0]}"
        landing.mkdir()
        lines = ['"01";"EXTINCAO"', '"02";"OUTRA";"A MAIS"']
        lake = P.Lake(str(root))
        for k in order:
            _zip(landing / f"Motivos{k}.zip", "K.MOTIVOS", [lines[k]])
            P.bronze_registry(spark, str(landing), lake, ["MOTIVOS"])
        P.silver_registry(spark, lake, ["MOTIVOS"])
        rows = {r["codigo_motivo"]: r["_c2"] for r in
                P.FS.read_table(spark, lake.path("trusted", P.REGISTRY, "motivos")).collect()}
        assert rows == {"01": "N/A", "02": "A MAIS"}


def test_a_changed_company_counts_once(spark, tmp_path):
    """Two loads of a company, a row without key: one establishment, newest size."""
    landing, root = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    lake = P.Lake(str(root))
    place = '"%s";"0001";"12";"1";"LOJA";"02";"";"";"";"";"";"6204000"' + ';""' * 7 + ';"SP"' + ';""' * 10
    firm = '"%s";"ACME";"";"1000,00";"%s";"";"";"";"";""'
    _zip(landing / "Estabelecimentos0.zip", "K.ESTABELE", [place % "00000001", place % "00000001"])
    _zip(landing / "Empresas0.zip", "K.EMPRECSV", [firm % ("00000001", "01")])
    _zip(landing / "Cnaes0.zip", "K.CNAECSV", ['"6204000";"TI"', '"6204000";"TI OUTRA"'])
    P.bronze_registry(spark, str(landing), lake)
    _zip(landing / "Empresas1.zip", "K.EMPRECSV", [firm % ("00000001", "05")])
    P.bronze_registry(spark, str(landing), lake)
    P.silver_registry(spark, lake)
    P.gold(spark, lake)
    rows = P.gold_table(spark, lake, "dim_distribuicao_estabelecimentos").collect()
    assert [(r["porte_empresa"], r["Total_empresas"], r["descricao"]) for r in rows] == [("DEMAIS", 1, "TI")]


def test_the_job_keeps_the_session_it_is_given(spark, tmp_path):
    (tmp_path / "none").mkdir()
    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    P.run(spark, str(tmp_path / "none"), str(tmp_path / "lake"))
    assert before == (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))


def test_changed_input_is_seen(spark, tmp_path):
    import shutil

    from conftest import SF_SMALL
    from tradestar.plans import trusted
    d = tmp_path / "sf"
    shutil.copytree(SF_SMALL, d)
    d.chmod(0o755)
    first = trusted.exp_imp(spark, str(d))[0].count()
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter("l_linestatus = 'O'").limit(7).coalesce(1)
    lines.write.parquet(str(tmp_path / "few"))
    part = next((tmp_path / "few").glob("*.parquet"))
    (d / "lineitem.parquet").unlink()
    (d / "lineitem.parquet").write_bytes(part.read_bytes())
    assert first > 7 and trusted.exp_imp(spark, str(d))[0].count() == 7


def test_a_bad_archive_does_not_stop_the_others(spark, tmp_path):
    landing, root = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    _zip(landing / "Motivos0.zip", "K.MOTIVOS", ['"01";"EXTINCAO"', '"02";""'])
    (landing / "Motivos1.zip").write_bytes(b"broken")
    lake = P.Lake(str(root))
    P.bronze_registry(spark, str(landing), lake, ["MOTIVOS"])
    P.silver_registry(spark, lake, ["MOTIVOS"])
    report = {r["entidade"]: (r["linhas"], r["status"]) for r in lake.report(spark).collect()
              if r["camada"] == "bronze"}
    assert report == {"motivos": (2, "OK"), "motivos/lote_0/arquivos": (1, "ERRO")}
    rows = {r["codigo_motivo"]: r["descricao"] for r in
            P.FS.read_table(spark, lake.path("trusted", P.REGISTRY, "motivos")).collect()}
    assert rows == {"01": "EXTINCAO", "02": "N/A"}      # an empty field is a missing value
    bad = spark.read.parquet(lake.path("raw", P.REGISTRY, "_rejeitos/motivos")).collect()
    assert [r["arquivo_zip"] for r in bad] == ["Motivos1.zip"]
