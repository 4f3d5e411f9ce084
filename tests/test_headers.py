"""CSV files are read by their own headers, or refused by name."""

import random

import pytest
from pyspark.sql.types import IntegerType, StringType, StructType

from obsforge.sources import headers, tables
from obsforge.streaming import arrivals

SCHEMA = StructType().add("a", IntegerType()).add("b", StringType()).add("c", StringType())


def write(folder, files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def rows(df):
    return sorted((r["a"], r["b"], r["c"]) for r in df.collect())


TWO = {
    "1.csv": "a,b,c\n1,x,y\n2,x2,y2\n",
    "2.csv": 'c,"a",b\ny3,3,"x, 3"\n\n',
    "3 with blank.csv": '"b","c","a"\n"x4","y4","4"\n',
    "4.csv": "﻿a,b,c\n5,x5,y5\n",
    "5.csv": "\nb , c, a\nx6,y6,6\n",
    "6.csv": "",
    "7.csv": "c,b,a\n",
}
EXPECTED = [(1, "x", "y"), (2, "x2", "y2"), (3, "x, 3", "y3"), (4, "x4", "y4"), (5, "x5", "y5"), (6, "x6", "y6")]


@pytest.mark.parametrize("most", [50_000, 0])
def test_each_file_by_its_own_header(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(headers, "BROADCAST_FILES", most)
    path = write(tmp_path / "in", TWO)
    for strict in (True, False):
        assert rows(tables.read_history(spark, path, SCHEMA, strict=strict)) == EXPECTED
    assert tables.read_rejects(spark, path, SCHEMA).isEmpty()


def test_equal_headers_need_no_join(spark, tmp_path):
    path = write(tmp_path / "in", {f"{i}.csv": f"c,b,a\ny,x,{i}\n" for i in range(5)})
    df = tables.read_history(spark, path, SCHEMA)
    assert rows(df) == [(i, "x", "y") for i in range(5)]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_header_with_other_names_is_refused_by_file(spark, tmp_path):
    for text in ("a,b\n1,x\n", "a,b,d\n1,x,y\n", "a,b,c,d\n1,x,y,z\n", "1,x,y\n2,x,y\n", "a,a,b\n1,1,x\n", 'a,b,"c\n1,x,y\n'):
        path = write(tmp_path / str(abs(hash(text))), {"good.csv": "a,b,c\n1,x,y\n", "bad one.csv": text})
        with pytest.raises(ValueError, match="columns differ from the schema.*bad") as error:
            tables.read_history(spark, path, SCHEMA)
        assert "good.csv" not in str(error.value)


def test_malformed_lines_of_permuted_files(spark, tmp_path):
    path = write(tmp_path / "in", {"1.csv": "a,b,c\n1,x,y\n2,x\n", "2.csv": 'b,a,c\nx,3,y\nx,4,y,z\nx,"5,y\nx,no,y\n'})
    assert rows(tables.read_history(spark, path, SCHEMA, strict=False).where("a is not null")) == [(1, "x", "y"), (3, "x", "y")]
    got = sorted((r["reason"], r["line"]) for r in tables.read_rejects(spark, path, SCHEMA).collect())
    assert got == [("cells", "2,x"), ("cells", 'x,"5,y'), ("cells", "x,4,y,z"), ("type", "no,x,y")]


def test_cells_with_line_breaks_in_two_orders(spark, tmp_path):
    path = write(tmp_path / "in", {"1.csv": 'a,b,c\n1,"x\nx",y\n', "2 2.csv": 'c,a,b\n"y\ny",2,x\n'})
    assert rows(tables.read_history(spark, path, SCHEMA, multi_line=True)) == [(1, "x\nx", "y"), (2, "x", "y\ny")]


def test_first_line_of_files_of_many_parts(spark, tmp_path):
    """A file that is read in several parts has one header, that of its beginning."""
    rng = random.Random(1)
    texts = {f"{i}.csv": "\n".join([",".join(order)] + [",".join({"a": str(k), "b": f"x{i}", "c": "y" * rng.randrange(40)}[n] for n in order) for k in range(400)]) for i, order in enumerate(["abc", "bca", "cab"])}
    path = write(tmp_path / "in", texts)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        df = tables.read_history(spark, path, SCHEMA)
        assert df.rdd.getNumPartitions() > 3
        assert sorted((r["a"], r["b"]) for r in df.collect()) == sorted((k, f"x{i}") for i in range(3) for k in range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def stream(spark, tmp_path, folder):
    lines = arrivals.read_arriving_lines(spark, folder, files_per_batch=2)
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    arrivals.run_stream(lines, target, state, ["a"], schema=SCHEMA).awaitTermination()
    return arrivals.arrivals_table(spark, target)


def test_stream_of_files_of_any_order(spark, tmp_path):
    folder = write(tmp_path / "in", {k: v for k, v in TWO.items() if k < "4"})
    assert rows(stream(spark, tmp_path, folder)) == EXPECTED[:4]
    write(tmp_path / "in", {k: v for k, v in TWO.items() if k >= "4"} | {"8.csv": "c,b,a\ny7,x7,7\nother,other,1\n"})
    assert rows(stream(spark, tmp_path, folder)) == [*EXPECTED, (7, "x7", "y7")]


def test_stream_refuses_a_file_by_name(spark, tmp_path):
    folder = write(tmp_path / "in", {"1.csv": "a,b,c\n1,x,y\n"})
    stream(spark, tmp_path, folder)
    write(tmp_path / "in", {"strange.csv": "a,b,d\n2,x,y\n"})
    with pytest.raises(Exception, match="strange.csv"):
        stream(spark, tmp_path, folder)
    assert rows(arrivals.arrivals_table(spark, str(tmp_path / "out"))) == [(1, "x", "y")]


def test_typed_stream_fails_on_another_order(spark, tmp_path):
    folder = write(tmp_path / "in", {"1.csv": "b,a,c\nx,1,y\n"})
    text = StructType().add("a", StringType()).add("b", StringType()).add("c", StringType())
    with pytest.raises(Exception, match="malformed line: b,a,c"):
        arrivals.run_stream(arrivals.read_arrivals(spark, folder, text), str(tmp_path / "out"), str(tmp_path / "state"), ["a"]).awaitTermination()
