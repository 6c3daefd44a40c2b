"""Multi-step jobs (M1-M4) and the user-function surface."""

from pyspark.sql import functions as F

from quarry.functions import udfs
from quarry.plans import jobs
from quarry.sources import readers
from tests.conftest import executed_plan, rows
from tests.test_stocks import DIVIDENDS, STOCKS


def _frames(spark, tmp_path):
    (tmp_path / "s.csv").write_text(STOCKS)
    (tmp_path / "d.csv").write_text(DIVIDENDS)
    return (readers.read_delimited(spark, str(tmp_path / "s.csv"), readers.STOCK_SCHEMA),
            readers.read_delimited(spark, str(tmp_path / "d.csv"), readers.DIVIDEND_SCHEMA))


def test_stock_analysis(spark, tmp_path):
    stocks, divs = _frames(spark, tmp_path)
    assert rows(jobs.stock_analysis(stocks, divs)) == [
        ("AA", "2009", 12.6, 9.5, 0.17), ("AA", "2010", 14.0, 12.8, 0.03), ("AB", "2009", 5.5, 4.5, 0.0)]
    assert rows(jobs.stock_analysis(stocks, divs.unionByName(divs), per_year=False, dividends_smaller=True)) == [
        ("AA", 14.0, 9.5, 0.17), ("AB", 5.5, 4.5, 0.0)]


def test_bloom_filter_job(spark, tmp_path):
    stocks, divs = _frames(spark, tmp_path)
    out = jobs.bloom_filter_job(stocks, divs, "AA", out_path=str(tmp_path / "out"))
    assert rows(out) == [("AA,2009-01-02", 12.0), ("AA,2009-01-05", 11.5), ("AA,2010-03-01", 13.9)]
    assert spark.read.option("sep", "\t").csv(str(tmp_path / "out")).count() == 3


def test_group_sort(spark):
    lines = spark.createDataFrame([("b a\tb",), ("c b",)], "value string")
    assert [tuple(r) for r in jobs.group_sort(lines).collect()] == [(1, "a"), (1, "c"), (3, "b")]


def test_tfidf_job(spark):
    packed = spark.createDataFrame([("d1", bytearray(b"Cat cat dog the")), ("d2", bytearray(b"dog"))],
                                   "filename string, contents binary")
    got = {(r["word"], r["doc"]) for r in jobs.tfidf_job(packed).collect()}
    assert got == {("cat", "d1"), ("dog", "d1"), ("dog", "d2")}


def test_external_process_and_registered(spark):
    df = spark.createDataFrame([(" a  b ",), (None,), ("x\ty\\N",)], "sentence string")
    assert sorted(r[0] for r in udfs.pipe_lines(df, "sentence").collect()) == ["", "", "", "", "a", "b", "x\ty\\N"]
    assert "Python" not in executed_plan(udfs.pipe_lines(df, "sentence"))
    names = udfs.register_functions(spark)
    assert spark.sql("SELECT quarry_stem('running') AS s, quarry_java_trim('\t x ') AS t").first()[:] == (
        "run", "x")
    assert set(names) == {"quarry_stem", "quarry_java_trim"}
    words = spark.createDataFrame([("ponies",)], "w string").selectExpr("quarry_stem(w)")
    assert words.first()[0] == "poni" and "Python" not in executed_plan(words)
    assert F is not None
