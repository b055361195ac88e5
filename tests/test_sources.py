import datetime
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace import storage
from millrace.sources import delimited, inline, sinks, text


def put(tmp_path, name, data, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(data.encode(encoding))
    return str(path)


@pytest.mark.parametrize("sep", ["\t", ",", "|", "::"])
def test_typed_reader_separators(spark, tmp_path, sep):
    path = put(tmp_path, "r.txt", sep.join(["1", "2", "3", "881250949"]) + "\n" + sep.join(["4", "5", "1", "891717742"]) + "\n")
    df = delimited.read_typed(spark, path, "u int, m int, r int, ts bigint", sep=sep)
    assert rows(df) == [(1, 2, 3, 881250949), (4, 5, 1, 891717742)]


def test_inferred_and_string_readers(spark, tmp_path):
    path = put(tmp_path, "f.csv", "id,name,age\n0,Ada,33\n1,Anna-Lee,26\n")
    assert delimited.read_inferred(spark, path).dtypes == [("id", "int"), ("name", "string"), ("age", "int")]
    strings = delimited.read_strings(spark, path)
    assert {t for _, t in strings.dtypes} == {"string"}
    assert rows(delimited.cast_all(strings)) == [(0.0, None, 33.0), (1.0, None, 26.0)]


def test_positional_trimmed_and_charset(spark, tmp_path):
    path = put(tmp_path, "p.csv", "1,2.5\n2,x\n")
    assert rows(delimited.read_positional(spark, path, ["a", "b"], ["int", "double"])) == [(1, 2.5), (2, None)]
    path = put(tmp_path, "c.csv", "73,  not known yet,   0\n")
    assert rows(delimited.read_trimmed(spark, path, "age int, worker string, code int")) == [(73, "not known yet", 0)]
    path = put(tmp_path, "l.txt", "1|Café au lait\n", "latin-1")
    assert rows(delimited.read_charset(spark, path, "id int, title string")) == [(1, "Café au lait")]


def test_malformed_lines_go_to_rejects(spark, tmp_path):
    path = put(tmp_path, "r.csv", "i1,u1,5.0,100\ni2,u2,4.0\ni3,u3,x,7\ni4,u4,,9\n")
    fields = [("item", "string"), ("user", "string"), ("rating", "float"), ("ts", "int")]
    good, bad = text.parse_records(text.read_lines(spark, path), fields)
    assert rows(good) == [("i1", "u1", 5.0, 100), ("i4", "u4", None, 9)]
    assert rows(bad) == [("i2,u2,4.0",), ("i3,u3,x,7",)]


def test_quoted_names(spark, tmp_path):
    path = put(tmp_path, "n.txt", '1 "AMBER/FOX"\n2 bare\n7000 "LEDGER"\n')
    lines = text.read_lines(spark, path)
    assert rows(text.parse_quoted(lines)) == [(1, "AMBER/FOX"), (7000, "LEDGER")]
    assert rows(text.parse_quoted(lines, below=6487)) == [(1, "AMBER/FOX")]


def test_inline_rows(spark):
    df = inline.inline_rows(spark, [(1, "apple", 10), (2, "pear", 20)], "id int, fruit string, value int")
    assert df.agg(F.sum("value")).first()[0] == 30


def test_sinks_overwrite_and_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(1, 'a "q", b'), (2, None)], "id int, s string")
    sinks.write_csv(first, path, escape='"')
    sinks.write_csv(first.filter("id = 1"), path, escape='"')
    assert rows(delimited.read_typed(spark, path, first.schema, escape='"')) == [(1, 'a "q", b')]
    lines = sinks.write_lines(first, str(tmp_path / "lines"), ["id", "s"], single=True)
    assert len([f for f in os.listdir(lines) if f.startswith("part-")]) == 1
    assert rows(text.read_lines(spark, lines)) == [('1;a "q", b',), ("2;",)]
    book = sinks.write_dictionary(spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "k string, c int"), str(tmp_path / "d"), "k", "c")
    assert rows(delimited.read_typed(spark, book, "k string, c int")) == [("x", 1), ("y", 2)]


def test_materialize_uses_the_session_folder(spark):
    df = storage.materialize(spark.range(5).withColumn("t", F.lit(datetime.date(2020, 1, 1))))
    assert df.count() == 5
    assert all(storage.shared_root(spark) in f for f in df.inputFiles())


def test_broadcast_only_below_the_bounds(spark):
    small = spark.range(10)
    hinted = storage.broadcast_if_small(small)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    for bounds in ({"max_rows": 5}, {"max_bytes": 20}):
        plain = storage.broadcast_if_small(small, **bounds)
        assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()
