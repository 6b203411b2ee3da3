"""Archives by position: record borders against the csv module, members side by
side, damaged files."""

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tradestar.sources import archives as A


def cut(text, block, sep=";"):
    out = []
    for lines in A._records(io.BytesIO(text.encode("ISO-8859-1")), "ISO-8859-1", sep, block):
        out += lines.to_pylist()
    return out


@pytest.mark.parametrize("block", [1, 3, 7, 64, 1 << 20])
def test_records_as_the_csv_module(block):
    rng = random.Random(7)
    for _ in range(60):
        rows = [[rng.choice(["", "a", "ção", "x;y", 'say "hi"', "two\nlines", "r\r\nn", ";", '"']) for _ in range(4)]
                for _ in range(rng.randint(0, 12))]
        buf = io.StringIO(newline="")
        csv.writer(buf, delimiter=";", quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]),
                   lineterminator=rng.choice(["\n", "\r\n"])).writerows(rows)
        text = buf.getvalue()
        if rng.random() < 0.5:
            text = text.rstrip("\r\n")
        got = [next(csv.reader(io.StringIO(r, newline=""), delimiter=";")) for r in cut(text, block)]
        want = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r]
        assert got == want


def test_quotes_within_plain_fields():
    text = '12;TUBO 5" ACO;x\n13;6" e 7";"a;""b""\nc"\n14;"";y\n'
    assert cut(text, 1 << 20) == ['12;TUBO 5" ACO;x', '13;6" e 7";"a;""b""\nc"', '14;"";y']


def test_a_quote_that_never_closes(monkeypatch):
    monkeypatch.setattr(A, "MAX_RECORD", 100)
    with pytest.raises(csv.Error):
        cut('a;"' + "line\n" * 100, 16)


def zipped(path, members, compression=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", compression) as z:
        for name, text in members:
            z.writestr(name, text.encode("ISO-8859-1"))


def test_members_of_one_archive_are_read_by_several_tasks(spark, tmp_path):
    zipped(tmp_path / "a.zip", [(f"m{k}.ESTABELE", "".join(f'"{k}";"{i}\nç"\n' for i in range(2000))) for k in range(6)])
    members = A.list_members(A.read_archives(spark, str(tmp_path), "*.zip"))
    rows = A.read_members(members, tasks=6).withColumn("task", F.spark_partition_id())
    by = rows.groupBy("membro").agg(F.min("task"), F.max("task"), F.max("n_linha").alias("n")).collect()
    assert len(by) == 6 and {r["n"] for r in by} == {2000}
    assert rows.select("task").distinct().count() > 2
    named = A.name_fields(rows, ["k", "i"], 2)
    assert named.filter("k = '3' and i = '7\nç'").count() == 1


def test_listing_reads_sizes_and_widths(spark, tmp_path):
    zipped(tmp_path / "a.zip", [("dir/", ""), ("__MACOSX/x", "x"), ("big.CSV", '"a\nb";c;d\n' * 50_000), ("none.CSV", "")])
    (tmp_path / "bad.zip").write_bytes(b"PK\x03\x04 not really")
    rows = {r.membro: r for r in A.list_members(A.read_archives(spark, str(tmp_path), "*.zip")).collect()}
    assert set(rows) == {"big.CSV", "none.CSV", None}
    assert (rows["big.CSV"].largura, rows["big.CSV"].bytes) == (3, 500_000)
    assert rows["none.CSV"].largura == 0 and "BadZipFile" in rows[None].erro


def test_damaged_member_gives_its_error(spark, tmp_path):
    zipped(tmp_path / "a.zip", [("x.CSV", "".join(f"{i};{i * 7919 % 1000}\n" for i in range(200_000))), ("y.CSV", "1;2\n")])
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[len(raw) // 2:len(raw) // 2 + 40] = b"\0" * 40
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    rows = A.unzip_members(A.read_archives(spark, str(tmp_path), "*.zip"))
    by = {r["membro"]: r for r in rows.groupBy("membro").agg(
        F.count("registro").alias("n"), F.max("erro").alias("erro")).collect()}
    assert by["y.CSV"]["n"] == 1 and by["y.CSV"]["erro"] is None
    assert by["x.CSV"]["erro"] and by["x.CSV"]["n"] < 200_000


def test_chosen_members(spark, tmp_path):
    zipped(tmp_path / "a.zip", [("leia.me", "x\n" * 99), ("b.ESTABELE", "1\n"), ("c.ESTABELE", "1\n2\n")])
    zipped(tmp_path / "n.zip", [("small", "x\n"), ("big", "x\n" * 99)])
    (tmp_path / "bad.zip").write_bytes(b"no")
    members = A.chosen_members(A.list_members(A.read_archives(spark, str(tmp_path), "*.zip")))
    assert {(r.arquivo_zip, r.membro) for r in members.collect()} == {
        ("a.zip", "b.ESTABELE"), ("n.zip", "big"), ("bad.zip", None)}
    assert A.list_members(A.read_archives(spark, str(tmp_path), "*.zip").limit(0)).collect() == []
