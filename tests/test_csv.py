"""The splittable CSV reader against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from coinfold.sources.csv import CSV, _lines, _records, _splits, read_csv


def whole(spark, path):
    return spark.read.options(**CSV, multiLine="true").csv(path).fillna("")


def same(spark, path, ordered=False):
    ours, theirs = read_csv(spark, path), whole(spark, path)
    assert ours.columns == theirs.columns
    rows = list(map(tuple, ours.collect()))
    assert sorted(rows) == sorted(map(tuple, theirs.collect()))
    if ordered:
        assert rows == list(map(tuple, theirs.collect()))
    return ours


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def text_of(rnd, rows, breaks, ending="\n"):
    def field():
        inner = "".join(rnd.choice(['a', 'b ', '""', ",", "é", *breaks]) for _ in range(rnd.randrange(12)))
        return rnd.choice([f'"{inner}"', "plain", "", '""', " x "])

    return ending.join(["k,a,b", *(f"{i},{field()},{field()}" for i in range(rows))])


@pytest.mark.parametrize("breaks, ending", [(["\n"], "\n"), (["\r\n", "\n"], "\n"), (["\r\n"], "\r\n"), ([], "\n"), (["\n"] * 12, "\n")])
def test_splits_find_the_records_of_a_whole_reading(spark, tmp_path, small_splits, breaks, ending):
    rnd = random.Random(len(breaks))
    for name in ("one.csv", "two.csv"):
        (tmp_path / name).write_bytes((text_of(rnd, 120, breaks, ending) + ending * rnd.randrange(3)).encode())
    rows = same(spark, str(tmp_path))
    assert rows.count() == 240


def test_a_record_longer_than_a_split(spark, tmp_path, small_splits):
    long_ = "\n".join(["line", '""quoted""', ""] * 200)
    (tmp_path / "x.csv").write_text(f'a,b\n1,"{long_}"\n2,x\n3,"y\nz"\n4,"{long_}')
    rows = read_csv(spark, str(tmp_path)).where("a < 4")
    assert {r.a: r.b for r in rows.collect()} == {"1": long_.replace('""', '"'), "2": "x", "3": "y\nz"}


def test_one_file_of_line_breaks_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text("a,b\n" + "".join(f'{i},"one\ntwo {i}"\n' for i in range(800)))
    lines = _lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10 and whole(spark, str(tmp_path)).rdd.getNumPartitions() == 1
    records = _records(lines, _splits(lines))
    assert records.where("heads").count() == 1 and records.count() == 801
    plan = same(spark, str(tmp_path), ordered=True)._jdf.queryExecution().executedPlan().toString()
    assert "from_csv" in plan


def test_odd_files(spark, tmp_path):
    for name, text in {
        "stray": 'a,b\nx"y,1\n"p\nq",2\n', "blank": '\n\na,b\n\n1,"x\n\ny"\n\n', "header": '"a\nb",c\n1,2\n',
        "short": 'a,b,c\n1\n1,2,3,4\n"x\ny",2\n', "only": "a,b\n", "open": 'a,b\n1,"never closed\n2,3\n',
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(text)
        same(spark, str(tmp_path / name))
    assert same(spark, str(tmp_path / "blank")).select(F.col("b")).first().b == "x\n\ny"
