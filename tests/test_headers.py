"""Files of different headers under one glob."""

import pytest

from tradestar.layouts import TRADE_LAYOUTS
from tradestar.plans import pipeline as P
from tradestar.sources import headers as H
from tradestar.sources import sinks as SK

MAPPING = TRADE_LAYOUTS["PAIS_BLOCO"]
CODE, NAME = (s for s, t in MAPPING.items() if t in ("codigo_pais", "nome_bloco_pt"))
FILES = {
    "B_1.csv": f"{CODE};{NAME}\n001;Ação\n002;\"x;y\"\n",
    "B_2.csv": f"EXTRA;{NAME};{CODE};MAIS\ne;reordenado;003;m\n",
    "B_3.csv": f"{CODE}\r\n004\r\n",
    "B_4.csv": "\n1;2\n",
    "B_5.csv": f"{CODE};{CODE.lower()}\n1;2\n",
    "B_6.csv": "A;B\n1;2\n",
    "B_7.csv": f"\"{CODE}\";\"{NAME}\"",
}


def put(folder, names):
    folder.mkdir(exist_ok=True)
    for n in names:
        (folder / n).write_bytes(FILES[n].encode("ISO-8859-1"))


def load(spark, tmp_path, lake):
    P.bronze_trade(spark, None, lake, sources={"b": (str(tmp_path / "in"), "B_*.csv", "PAIS_BLOCO")})


def rows(spark, lake):
    got = SK.read_merged(spark, lake.path("raw", P.TRADE, "b"))
    return sorted((r["codigo_pais"], r["nome_bloco_pt"] if "nome_bloco_pt" in got.columns else None)
                  for r in got.collect())


WANT = [("001", "Ação"), ("002", "x;y"), ("003", "reordenado"), ("004", None)]


@pytest.mark.parametrize("order", [["B_3.csv", "B_2.csv", "B_1.csv"], ["B_2.csv", "B_1.csv", "B_3.csv"]])
def test_any_order_of_arrival(spark, tmp_path, order):
    lake = P.Lake(str(tmp_path / "lake"))
    for name in order:  # a restart for each file
        put(tmp_path / "in", [name])
        load(spark, tmp_path, lake)
    load(spark, tmp_path, lake)
    assert rows(spark, lake) == WANT
    assert [r["status"] for r in lake.report(spark).filter("entidade = 'b'").collect()] == ["OK"] * 3 + ["SEM_NOVOS"]


def test_all_at_once_and_unfit_files(spark, tmp_path):
    lake = P.Lake(str(tmp_path / "lake"))
    put(tmp_path / "in", FILES)
    load(spark, tmp_path, lake)
    assert rows(spark, lake) == WANT
    bad = SK.read_merged(spark, lake.path("raw", P.TRADE, "_rejeitos/b")).collect()
    assert {r["path"].rsplit("/", 1)[-1]: r["problema"] for r in bad} == {
        "B_4.csv": H.EMPTY, "B_5.csv": H.REPEATED, "B_6.csv": H.FOREIGN}
    report = {r["entidade"]: r for r in lake.report(spark).collect()}
    assert report["b"]["linhas"] == 4 and report["b/lote_0/arquivos"]["linhas"] == 3


def test_no_files_and_no_layout(spark, tmp_path):
    lake = P.Lake(str(tmp_path / "lake"))
    (tmp_path / "in").mkdir()
    load(spark, tmp_path, lake)
    assert [r["status"] for r in lake.report(spark).collect()] == ["SEM_ARQUIVOS"]
    (tmp_path / "in" / "X.csv").write_text("Código A;B b\n1;2\n", encoding="ISO-8859-1")
    P.bronze_trade(spark, None, lake, sources={"x": (str(tmp_path / "in"), "X.csv", None)})
    got = SK.read_merged(spark, lake.path("raw", P.TRADE, "x"))
    assert got.drop("batch_id").columns == ["código_a", "b_b"] and got.first()["b_b"] == "2"
