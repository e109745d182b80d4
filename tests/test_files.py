"""Charsets found by bytes, broken rows with file and line, and order that survives the sink."""

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from recaudo.session import scratch_path
from recaudo.sources import delimited, quarantine


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_charset_is_found_a_file(spark):
    base = scratch_path(spark, "charset test")                       # with a blank in the path
    texts = {"a.csv": ("año;v\nMuñoz;1\n", "utf-8"), "b.csv": ("v;año\n2;Núñez\n", "latin-1"), "c.csv": ("v;año\n" + "3;plain\n" * 5000 + "4;Peña\n", "latin-1"),
             "d.csv": ("v\n5\n", "ascii"), "e.csv": ("año;v\n€;6\n", "utf-8-sig")}
    for name, (text, charset) in texts.items():
        put(f"{base}/{name}", text.encode(charset))
    files = delimited.list_files(spark, base)
    found = {os.path.basename(unquote(f)): c for f, c in delimited.charsets(spark, files).items()}
    assert found == {"a.csv": "UTF-8", "b.csv": "ISO-8859-1", "c.csv": "ISO-8859-1", "d.csv": "UTF-8", "e.csv": "UTF-8"}
    df = delimited.read_by_header(spark, files, encoding=delimited.DETECT)
    assert sorted(df.columns) == ["año", "v"]
    got = {r.v: r["año"] for r in df.collect()}
    assert got == {"1": "Muñoz", "2": "Núñez", "3": "plain", "4": "Peña", "5": None, "6": "€"}
    assert delimited.charsets(spark, []) == {}


def test_broken_rows_have_file_and_line_over_splits(spark):
    base = scratch_path(spark, "quarantine-test")
    broken = {17, 18, 2500, 4999}
    text = "a;b;c\n" + "".join("x;y\n" if k in broken else f"{k};\"q;{k}\";z\n" for k in range(2, 5001)) + "\n  \n1;2;3;4\n"
    put(f"{base}/big.csv", text.encode())
    put(f"{base}/other.csv", "c,a\n1\n2,3\n".encode())
    put(f"{base}/none.csv", b"")
    files = delimited.list_files(spark, base)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")      # many splits
    try:
        out = quarantine.read_sorted(spark, files)
        bad = sorted((os.path.basename(r.file), r.line, r.record) for r in out.bad.collect())
        assert bad == sorted([("big.csv", k, "x;y") for k in broken] + [("big.csv", 5003, "1;2;3;4"), ("other.csv", 2, "1")])
        assert out.good.count() == 4999 - len(broken) + 1
        assert out.good.select("b").where("b is not null").count() == 4999 - len(broken)      # whatever is selected
        assert [os.path.basename(f) for f in out.skipped] == ["none.csv"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert quarantine.write_quarantine(out.bad, f"{base}/bad") is True
    assert delimited.read_delimited(spark, f"{base}/bad", quarantine.BAD, suffix=None).count() == 6
    assert quarantine.write_quarantine(out.bad.limit(0), f"{base}/bad") is False


def test_broken_rows_of_a_latin_file(spark):
    base = scratch_path(spark, "quarantine-latin")
    put(f"{base}/l.csv", "año;v\nMuñoz;1\nPeña\n".encode("latin-1"))
    out = quarantine.read_sorted(spark, delimited.list_files(spark, base), encoding=delimited.DETECT)
    assert [(r.line, r.record) for r in out.bad.collect()] == [(3, "Peña")] and [tuple(r) for r in out.good.collect()] == [("Muñoz", "1")]
    with pytest.raises(ValueError, match="no header"):
        quarantine.read_sorted(spark, [])


def lines_in_name_order(path):
    out = []
    for name in sorted(n for n in os.listdir(path) if n.endswith(".csv")):
        with open(f"{path}/{name}", encoding="utf-8") as f:
            out += f.read().split("\n")[1:-1]
    return out


def test_files_in_name_order_are_the_sorted_table(spark):
    path = scratch_path(spark, "ordered-test")
    df = spark.range(0, 6000, numPartitions=6).select((F.col("id") * 7919 % 6000).alias("k"), F.when(F.col("id") % 3 > 0, "often").otherwise(F.col("id").cast("string")).alias("v"))
    assert delimited.write_delimited(df, path, order_by=["v", F.desc("k")], max_records_per_file=700)
    got = [line.split(";") for line in lines_in_name_order(path)]
    assert [(v, int(k)) for k, v in got] == sorted(((v, int(k)) for k, v in got), key=lambda x: (x[0], -x[1])) and len(got) == 6000
    assert len([n for n in os.listdir(path) if n.endswith(".csv")]) > 6
    with pytest.raises(ValueError, match="whole table"):
        delimited.write_delimited(df, path, order_by=["k"], partition_by=["v"])


def test_contact_table_keeps_its_slot_order(spark):
    from recaudo.__main__ import main
    base = scratch_path(spark, "slot-order")
    rows = "".join(f"D{k};{k};{'6015551234' if k % 3 == 0 else '3001234567' if k % 3 == 1 else 'x@y.co'}\n" for k in range(300))
    put(f"{base}/c.csv", ("identificacion;cuenta;dato\n" + rows).encode())
    assert main(["contacts", "--input", f"{base}/c.csv", "--month", "3", "--year", "2025", "--out", f"{base}/out", "--by-slot-code"]) == 0
    kinds = [line.split(";")[5] for line in lines_in_name_order(f"{base}/out")]
    header = open(f"{base}/out/{min(n for n in os.listdir(f'{base}/out') if n.endswith('.csv'))}", encoding="utf-8").readline().strip().split(";")
    at = header.index("phone1")
    first = ["mobile" if p.startswith("3") else "landline" if p.startswith("6") else "none" for p in (line.split(";")[at].strip('"') for line in lines_in_name_order(f"{base}/out"))]
    assert first == ["mobile"] * 100 + ["landline"] * 100 + ["none"] * 100 and len(kinds) == 300
