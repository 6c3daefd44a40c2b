"""Stock fixtures (FIXTURES A1, A2): joins, extremes, value changes, windows."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.columns import coerce_double, reformat_date
from quarry.operators import aggregate, joins, series
from quarry.sources import readers
from tests.conftest import executed_plan, rows

STOCKS = """exchange,stock_symbol,date,stock_price_open,stock_price_high,stock_price_low,stock_price_close,stock_volume,stock_price_adj_close
NYSE,AA,2009-01-02,10.0,12.5,9.5,12.0,1000,12.0
NYSE,AA,2009-01-05,12.0,12.6,11.0,11.5,900,11.5
NYSE,AA,2010-03-01,13.0,14.0,12.8,13.9,700,13.9
NYSE,AB,2009-01-02,5.0,5.5,4.5,5.1,300,5.1
"""

DIVIDENDS = """exchange,stock_symbol,date,dividends
NYSE,AA,2009-01-02,0.17
NYSE,AA,2009-01-05,0.17
NYSE,AA,2010-03-01,0.03
NYSE,AC,2009-01-02,0.05
"""


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("stocks")
    (d / "stocks.csv").write_text(STOCKS)
    (d / "dividends.csv").write_text(DIVIDENDS)
    stocks = readers.read_delimited(spark, str(d / "stocks.csv"), readers.STOCK_SCHEMA)
    divs = readers.read_delimited(spark, str(d / "dividends.csv"), readers.DIVIDEND_SCHEMA)
    return stocks, divs


def _analysis(stocks, divs, declared_smaller=False):
    lhs = stocks.select("stock_symbol", "date", "stock_price_high", "stock_price_low")
    rhs = divs.select("stock_symbol", "date", "dividends")
    joined = joins.left_join(lhs, rhs, ["stock_symbol", "date"], declared_smaller=declared_smaller)
    return joined.select("stock_symbol", reformat_date("date").alias("year"), "stock_price_high",
                         "stock_price_low", coerce_double("dividends").alias("dividends"))


def test_year_extremes(frames):
    stocks, divs = frames
    out = aggregate.extremes(_analysis(stocks, divs), ["stock_symbol", "year"], "stock_price_high",
                             "stock_price_low", "dividends")
    assert rows(out) == [("AA", "2009", 12.6, 9.5, 0.17), ("AA", "2010", 14.0, 12.8, 0.03),
                         ("AB", "2009", 5.5, 4.5, 0.0)]


def test_symbol_extremes_broadcast(frames):
    stocks, divs = frames
    out = aggregate.extremes(_analysis(stocks, divs, True), ["stock_symbol"], "stock_price_high",
                             "stock_price_low", "dividends")
    assert rows(out) == [("AA", 14.0, 9.5, 0.17), ("AB", 5.5, 4.5, 0.0)]


def test_map_side_join_plan_and_rows(frames):
    stocks, divs = frames
    out = joins.map_side_join(stocks.select("stock_symbol", "date", "stock_price_close"),
                              divs.select("stock_symbol", "date", "dividends"), ["stock_symbol", "date"])
    assert "BroadcastHashJoin" in executed_plan(out)
    assert rows(out, "stock_symbol", "date", "dividends", "stock_price_close") == [
        ("AA", "2009-01-02", 0.17, 12.0), ("AA", "2009-01-05", 0.17, 11.5), ("AA", "2010-03-01", 0.03, 13.9)]


def test_broadcast_refused_when_too_large(spark):
    big = spark.range(1000)
    assert not joins.fits_broadcast(big, max_bytes=100)
    assert joins.fits_broadcast(big, max_bytes=10**6)


def test_semi_join_one_row_per_stock(frames, spark):
    stocks, divs = frames
    aa = stocks.where(F.col("stock_symbol") == "AA")
    dup_divs = divs.unionByName(divs)  # two dividends per key must not duplicate
    out = joins.semi_join(aa, dup_divs.select("stock_symbol", "date"), ["stock_symbol", "date"])
    assert rows(out, "stock_price_close") == [(11.5,), (12.0,), (13.9,)]
    assert joins.anti_count(stocks, divs.select("stock_symbol", "date"), ["stock_symbol", "date"]).first()[0] == 1


def test_dividend_changes_fixture(frames):
    _, divs = frames
    out = series.dividend_changes(divs, "stock_symbol", ["date"], "dividends")
    got = sorted((r["stock_symbol"], r["date"], round(r["change"], 9)) for r in out.collect())
    assert got == [("AA", "2009-01-02", 0.17), ("AA", "2010-03-01", -0.14), ("AC", "2009-01-02", 0.05)]


def test_dividend_changes_drift(spark):
    # steps of 6e-7 add up past 1e-6: the fold emits where lag would not
    vals = [0.1, 0.1000006, 0.1000012, 0.1000018, 0.0]
    df = spark.createDataFrame([("X", f"d{i}", v) for i, v in enumerate(vals)], "k string, d string, v double")
    out = series.dividend_changes(df, "k", ["d"], "v")
    got = sorted((r["d"], round(r["change"], 9)) for r in out.collect())
    assert got == [("d0", 0.1), ("d2", 0.0000012), ("d4", -0.1000012)]


def test_moving_average_and_best_window(spark):
    data = [("A", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 10, 1, 1, 1, 1])] + [("B", 0, 5.0)]
    df = spark.createDataFrame(data, "k string, t int, v double")
    ma = {(r["k"], r["t"]): r["moving_avg"] for r in series.moving_average(df, "k", ["t"], "v", 4).collect()}
    assert ma[("A", 0)] == 1.0 and ma[("A", 1)] == 1.5 and ma[("A", 3)] == 2.5 and ma[("A", 4)] == 4.75
    assert ma[("B", 0)] == 5.0
    best = rows(series.best_window(df, "k", ["t"], "v", 4))
    assert best == [("A", 4, 4.75)]  # B has no full window
    ties = spark.createDataFrame([("C", i, 1.0) for i in range(6)], "k string, t int, v double")
    assert rows(series.best_window(ties, "k", ["t"], "v", 4)) == [("C", 3, 1.0)]  # first wins


def test_max_with_date_tie_earliest(spark):
    df = spark.createDataFrame([("AA", "2009-01-02", 12.0), ("AA", "2009-01-01", 12.0), ("AA", "2009-01-03", 11.0)],
                               "symbol string, date string, close double")
    assert rows(aggregate.max_with_date(df, "symbol", "close", "date")) == [("AA", 12.0, "2009-01-01")]


def test_price_series_order(frames):
    stocks, _ = frames
    out = series.price_series(stocks, "stock_symbol", "date", "stock_price_close").collect()
    assert [(r[0], r[1]) for r in out] == sorted((r[0], r[1]) for r in out)


def test_broadcast_check_refuses_many_splits_unread(spark):
    wide = spark.range(0, 100, 1, numPartitions=300)
    assert not joins.fits_broadcast(wide, max_bytes=10**9)          # refused by split count
    assert joins.fits_broadcast(wide.coalesce(4), max_bytes=10**9)   # few splits: counted


def test_checked_broadcast_leaves_shuffled_side_to_aqe(spark):
    agg = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert joins.checked_broadcast(agg) is agg                 # not counted, not hinted
    scan = spark.range(10)
    assert joins.checked_broadcast(scan) is not scan           # small plain side: hinted
