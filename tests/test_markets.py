from datetime import date, datetime, timedelta
import random

import pytest
from pyspark.sql import functions as F

from daybook.functions.dates import calendar_labels
from daybook.operators import price_index, prices, valuation


def test_eod_prices(table):
    old = table("date date, product_code string, product_name string, price double",
                (date(2024, 1, 1), "A", "Apple", 500.0), (date(2024, 1, 2), "A", "Apple", 700.0))
    new = table("date date, product_code string, price double", (date(2024, 1, 2), "a", 9.0), (date(2024, 1, 3), "a", 0.0))
    meta = table("code string, product_code string, product_name string", ("a", "A", "Apple"))
    fill = lambda how: [r.product_eod_price for r in prices.eod_prices(
        old, new, meta, "2023-12-31", "2024-01-05", how).orderBy("date").collect()]
    assert fill("previous_day") == [None, 5.0, 9.0, 9.0, None, None]
    assert fill("forward") == [None, 5.0, 9.0, 9.0, 9.0, 9.0]


def test_range_falls_back_to_closing_and_opening(table):
    eod = table("date date, day_of_month int, day_of_quarter int, day_of_year int, product_code string, product_name string, product_eod_price double",
                *[(date(2024, 1, i), i, i, i, "A", "Apple", p) for i, p in ((1, 5.0), (2, 4.0), (3, 6.0))])
    trades = table("date date, product string, price double, volume_per_unit double",
                   (date(2024, 1, 2), "Apple", 30.0, 3.0), (date(2024, 1, 2), "Apple", 8.0, 4.0), (date(2024, 1, 2), "Apple", 8.0, 0.0))
    rows = prices.daily_price_range(eod, trades).orderBy("date").collect()
    assert [(r.max_price_kg, r.min_price_kg) for r in rows] == [(None, None), (10.0, 2.0), (6.0, 4.0)]


def test_changes_start_with_first_priced_day(table):
    days = [(date(2023, 1, 1) + timedelta(n), "A", None if n < 3 else float(n)) for n in range(60)]
    df = table("date date, product string, eod_price double", *days)
    df = df.withColumns({"sod_price": F.lit(2.0), "day_of_month": F.dayofmonth("date"), "day_of_quarter": F.dayofyear("date")})
    got = {r.date: r for r in prices.price_changes(calendar_labels(df, "date", "product")).collect()}
    assert got[date(2023, 1, 3)].year_start_price is None
    assert got[date(2023, 2, 1)].year_start_price == 3.0
    assert got[date(2023, 2, 1)].previous_month_end_price == 30.0
    assert got[date(2023, 2, 1)].mom_price_change is None
    assert got[date(2023, 2, 4)].mom_price_change == pytest.approx(34 / 3 - 1)
    assert got[date(2023, 2, 10)].wow_price_change == pytest.approx(40 / 33 - 1)


def test_index_is_100_on_first_day_and_weights_sum_to_one(table):
    start = date(2024, 10, 1)
    trades = table("trade_date date, product string, product_code string, total_weight_kg double",
                   (date(2023, 5, 1), "A", "a", 3000.0), (date(2023, 6, 1), "B", "b", 1000.0))
    national = table("effective_date date, product_code string, volume double", (start, "a", 1.0), (start, "b", 1.0))
    price = table("date date, product_code string, price_kg double",
                  *[(start + timedelta(n), c, p) for n in range(3) for c, p in (("a", 1.0 + n), ("b", 2.0))])
    volumes = price_index.product_volumes(trades, price, national, "2024-10-01", "2024-10-04")
    weights = price_index.seasonal_weights(volumes)
    per_day = weights.groupBy("date").agg(F.sum("product_weight").alias("w")).collect()
    assert all(r.w == pytest.approx(1.0) for r in per_day)
    one = {(r.product, r.date): r for r in price_index.weighted_index(weights, "2024-10-01", "2024-12-31").collect()}
    assert one[("A", start)]["index"] == pytest.approx(100) and one[("A", start)].sub_index == pytest.approx(100)
    assert one[("A", start)].product_weight == pytest.approx(0.5 * 0.75 + 0.5 * 0.5)
    assert one[("A", start + timedelta(3))]["index"] is None  # nothing priced that day
    report = price_index.index_period_report(price_index.weighted_index(weights, "2024-10-01", "2024-12-31"))
    assert report.groupBy("product").count().collect() and report.where("product = 'Index'").count() == 4


def test_band_keeps_single_and_equal_rows(table):
    df = table("m string, id int, p double", ("one", 1, 5.0), ("same", 1, 0.1), ("same", 2, 0.1), ("same", 3, 0.1),
               ("edge", 1, 1.0), ("edge", 2, 2.0), ("edge", 3, 3.0), *[("out", i, 1.0) for i in range(9)], ("out", 9, 50.0))
    got = sorted((r.m, r.id) for r in valuation.within_band(df, ["m"], "p").collect())
    assert got == sorted([("one", 1)] + [(m, i) for m in ("same", "edge") for i in (1, 2, 3)] + [("out", i) for i in range(9)])


def simulate(market_prices, start, max_stale=5):
    """The chain day by day and market by market."""
    out, state = {}, {}
    days = sorted({r["date"] for r in market_prices})
    for product in sorted({r["product_code"] for r in market_prices}):
        yesterday, idle = None, {}
        for n, day in enumerate(days):
            total, weights, terms = 0.0, 0.0, 0
            for r in (r for r in market_prices if r["product_code"] == product and r["date"] == day):
                price, market = r["final_market_price"], r["market_code"]
                idle[market] = 0 if price is not None else idle.get(market, 0) + 1
                if n == 0 and r["market_price"] is None and product in start:
                    price = start[product]
                w = r["fixed_market_weight"]
                if price is None and idle[market] > max_stale and n > 0:
                    price, w = 0.0, 0.0
                elif price is None and n > 0:
                    price = yesterday
                weights += w
                if price is not None:
                    total, terms = total + price * w, terms + 1
            yesterday = total / (weights or 1.0) if terms else None
            out[(product, day)] = yesterday
    return out


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 512), (1, 7), (2, 1)])
def test_chain_equals_simulation(spark, seed, block):
    rng = random.Random(seed)
    rows = []
    for product, markets in {"A": ["FoA", "FuA", "OpA"], "B": ["INVB"], "C": ["OpC", "FuC"]}.items():
        for market in markets:
            price = None
            for n in range(60):
                traded = rng.random() < (0.12 if market != "OpC" else 0.02)
                price = rng.uniform(1, 9) if traded else None
                rows.append({"date": date(2024, 1, 1) + timedelta(n), "product_code": product, "market_code": market,
                             "market_price": price, "final_market_price": price,
                             "fixed_market_weight": valuation.MARKET_WEIGHTS[market[:-1].upper()]})
    schema = "date date, product_code string, market_code string, market_price double, final_market_price double, fixed_market_weight double"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    start = spark.createDataFrame([("A", 4.0)], "product_code string, price double")
    got = {(r.product_code, r.date): r.product_acp for r in valuation.closing_price_chain(df, start, block=block).collect()}
    want = simulate(rows, {"A": 4.0})
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (value if value is None else pytest.approx(value)), key


def test_first_day_may_stay_undivided(table):
    df = table("date date, product_code string, market_code string, market_price double, final_market_price double, fixed_market_weight double",
               (date(2024, 1, 1), "A", "FuA", 10.0, 10.0, 0.1), (date(2024, 1, 2), "A", "FuA", 10.0, 10.0, 0.1))
    values = lambda **k: [r.product_acp for r in valuation.closing_price_chain(df, **k).orderBy("date").collect()]
    assert values() == [pytest.approx(10.0)] * 2
    assert values(anchor_normalised=False) == [pytest.approx(1.0), pytest.approx(10.0)]


def test_asset_price_less_transport(table):
    product = table("date date, product_code string, product_acp double", (date(2024, 1, 1), "COF1", 10.0))
    assets = table("asset_code string, asset_type string, location string", ("FCOF1", "Futures", "Town"), ("OCOF1", "Options", "Town"),
                   ("FXXX", "Futures", "Town"))
    geo = table("name string, state string", ("Town", "State"))
    costs = table("product_label string, destination_region string, cost_adjustment_per_kg double", ("Coffee", "State", 1.5))
    rows = valuation.asset_prices(product, assets, geo, costs, {"COF": "Coffee"}, "2024-01-01", "2024-01-02").collect()
    got = {(r.asset_code, r.date.day): (r.location, r.asset_acp) for r in rows}
    assert got == {("FCOF1", 1): ("Town", 8.5), ("FCOF1", 2): ("Town", None), ("OCOF1", 1): ("n/a", 10.0), ("OCOF1", 2): ("n/a", None)}


def test_trade_lines_are_joined_once(spark, table):
    from types import SimpleNamespace

    from daybook.plans import valuation_queries as v

    line = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp")
    day = datetime(1996, 5, 6)
    t = SimpleNamespace(
        spark=spark, lineitem=table(line, (1, 1, 7, 3, 2.0, 20.0, 0.0, "N", "O", day), (1, 1, 7, 3, 2.0, 20.0, 0.0, "N", "O", day), (2, 1, 9, 3, 1.0, 5.0, 0.0, "N", "O", day)),
        part=table("p_partkey long, p_type string", (7, "PROMO TIN")), supplier=table("s_suppkey long, s_nationkey int", (3, 1)),
        nation=table("n_nationkey int, n_name string", (1, "CHAD")),
    )
    assert [(r.record_id, r.adjusted_price) for r in v.executed(t).collect()] == [("1-1-7-3-2", 16.0)]
    trades, costs = (set(d.inputFiles()) for d in (v.trades(t), v.transport(t)))
    assert trades and trades == costs
