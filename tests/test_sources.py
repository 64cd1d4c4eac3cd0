"""Files: keys as text, encodings, result round trip, fingerprints."""

import tempfile

import pytest

from pyspark.sql import functions as F

from risklens.sources import results as RS, tables as T


def test_csv_keeps_leading_zeros_in_any_encoding(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    text = "客户编号,规模,x\n001,大型,1.5\n010,小型,2\n"
    for name, enc in (("a", "utf-8-sig"), ("b", "gbk"), ("c", "utf-8")):
        path = f"{folder}/{name}.csv"
        with open(path, "w", encoding=enc) as f:
            f.write(text)
        rows = T.read_csv(spark, path, keys=("客户编号",)).orderBy("客户编号").collect()
        assert [(r["客户编号"], r["规模"], r["x"]) for r in rows] == [("001", "大型", 1.5), ("010", "小型", 2.0)]


def test_optional_tables_and_prepared_contract(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    T.write_prepared(spark.createDataFrame([(7, 1)], "id int, y int"), f"{folder}/p.parquet", "id")
    got = T.load_tables(spark, {"p": f"{folder}/p.parquet", "q": f"{folder}/none.parquet"}, required=("p",))
    assert list(got) == ["p"] and T.read_prepared(spark, f"{folder}/p.parquet", "id").first().id == "7"


def test_results_round_trip_with_old_names(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    old = spark.createDataFrame([("d", "s", "f", 0.2)], "`分群维度` string, `分群名称` string, `特征` string, `IV值` double")
    assert RS.export_results({"iv_old": old, "none": None}, folder) == ["iv_old"]
    got = RS.load_results(spark, folder, ["iv", "corr"], {"iv": ["iv_old"]})
    assert list(got) == ["iv"] and got["iv"].columns == ["segment_dim", "segment_name", "feature", "iv"]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    a = spark.range(100).withColumn("x", F.col("id") * 2)
    same = a.orderBy(F.desc("id")).select("x", "id")
    assert T.fingerprint(a).first() == T.fingerprint(same).first()
    assert T.fingerprint(a).first() != T.fingerprint(a.withColumn("x", F.col("x") + (F.col("id") == 5).cast("int"))).first()


def test_late_bytes_decide_the_encoding(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    plain = "id,name\n" + "".join(f"{i:05d},plain\n" for i in range(2500))
    with open(f"{folder}/late.csv", "w", encoding="gbk") as f:
        f.write(plain + "99999,大型\n")
    assert T.detect_encoding(spark, f"{folder}/late.csv") == "gbk"
    legacy = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    rows = T.read_csv(spark, f"{folder}/late.csv", keys=("id",))
    assert rows.count() == 2501 and rows.where("id = '99999'").first().name == "大型"
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == legacy


def test_all_files_of_a_folder_decide_the_encoding(spark):
    import os
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/two"
    os.mkdir(folder)
    for name, text, enc in (("a", "id,name\n1,plain\n", "utf-8"), ("b", "id,name\n2,大型\n", "gbk")):
        with open(f"{folder}/{name}.csv", "w", encoding=enc) as f:
            f.write(text)
    assert T.detect_encoding(spark, folder) == "gbk"
    assert {r.name for r in T.read_csv(spark, folder).collect()} == {"plain", "大型"}


def test_bytes_that_nothing_decodes_are_read(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/odd.csv", "wb") as f:
        f.write(b"id,name\n1,\x81\xff\x00x\n2,caf\xe9\n")
    assert T.detect_encoding(spark, f"{folder}/odd.csv") == "iso-8859-1"
    assert T.read_csv(spark, f"{folder}/odd.csv").count() == 2
    assert T.read_csv(spark, f"{folder}/odd.csv", encoding="utf-8").count() == 2


def csv_rows(n):
    """Header and rows with quoted commas, doubled quotes, line breaks and quotes inside unquoted fields."""
    notes = ['plain', 'a, b', 'say "hi"', 'two\nlines', '大型\n"客户"\n\n末', '5" pipe', '', '\n', '"', 'x' * 90]
    return ["id", "note", "v"], [(f"{i:04d}", notes[i % len(notes)], i) for i in range(n)]


def write_csv(path, rows, encoding, quote_all=False):
    import csv
    with open(path, "w", encoding=encoding, newline="") as f:
        w = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
        w.writerow(rows[0])
        w.writerows(rows[1])


@pytest.mark.parametrize("encoding,part", [("gbk", None), ("gbk", "23b"), ("utf-8", "64b"), ("utf-8-sig", "64b")])
def test_quoted_line_breaks_in_parts(spark, encoding, part):
    """Every size of the parts, also those smaller than a record, gives the rows that the csv module reads."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = csv_rows(12)
    for name in ("a", "b"):
        write_csv(f"{folder}/{name}.csv", rows, encoding, quote_all=name == "b")
    if part:
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        for path, times in ((f"{folder}/a.csv", 1), (folder, 2)):
            got = T.read_csv(spark, path, keys=("id",)).select("id", "note", "v").collect()
            wanted = sorted([(i, n or None, v) for i, n, v in rows[1]] * times)
            assert sorted(((r.id, r.note, r.v) for r in got)) == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unquoted_files_stay_with_the_reader(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write_csv(f"{folder}/a.csv", (["id", "note"], [("1", 'a "b"'), ("2", "c")]), "utf-8")
    assert "ArrowEval" not in T.read_csv(spark, f"{folder}/a.csv")._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in T.read_csv(spark, f"{folder}/a.csv").collect()) == [(1, 'a "b"'), (2, "c")]


@pytest.mark.parametrize("line,start,end", [(b"a,b", False, False), (b'a,"b', False, True), (b'b",c', True, False), (b'5" x,"y', False, True),
                                            (b'""', True, True), (b'"', True, False), (b'"""', False, True), (b'"a""b",c', False, False),
                                            (b'x","y', True, True), (b"", True, True), (b'a "b', False, False)])
def test_states_of_lines(line, start, end):
    assert T._ends_open(line, start) == end
