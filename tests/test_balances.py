import random
from datetime import date, datetime, timedelta

import pytest

from daybook.operators import balances, inventory, portfolio
from daybook.plans.balance_queries import ACCOUNT  # noqa: F401  the plan must import on its own

EVENTS = [
    ("a", datetime(2024, 1, 1, 9), 1, 10.0, "ok"), ("a", datetime(2024, 1, 1, 9), 2, 11.0, "ok"),
    ("a", datetime(2024, 1, 4, 8), 3, 12.0, "ok"), ("a", datetime(2024, 1, 4, 9), 4, 99.0, "Declined"),
    ("b", datetime(2023, 12, 20), 5, 5.0, "ok"), ("c", datetime(2024, 1, 5), 6, 7.0, "Declined"), ("d", datetime(2024, 1, 6), 7, None, "ok"),
]
LOG = {"keys": ["k"], "ts": "ts", "values": {"balance": "amount"}, "tiebreak": ["id"], "status": "status", "excluded": ["Declined"]}


@pytest.fixture
def events(table):
    return table("k string, ts timestamp, id int, amount double, status string", *EVENTS)


def brute(start, through):
    """Day by day over all events, as a loop."""
    out = {}
    for k in "abcd":
        log = sorted((e for e in EVENTS if e[0] == k and e[4] != "Declined"), key=lambda e: (e[1], e[2]))
        day = log[0][1].date() if log else None
        while day and day <= through:
            last = [e for e in log if e[1].date() <= day][-1]
            if day >= start:
                out[(k, day)] = (last[3], last[1])
            day += timedelta(days=1)
    return out


@pytest.mark.parametrize("start", [None, date(2024, 1, 2)])
def test_daily_balance_equals_loop(events, start):
    got = balances.daily_balance(events, through="2024-01-07", start=start and str(start), **LOG).collect()
    assert {(r.k, r.date): (r.balance, r.latest_trans_at) for r in got} == brute(start or date(1, 1, 1), date(2024, 1, 7))
    assert len(got) == len({(r.k, r.date) for r in got})


def test_incremental_extends_backfill(events):
    """Backfill through a day equals backfill through the day before plus that day's increment."""
    dense = {(r.k, r.date): r.balance for r in balances.daily_balance(events, through="2024-01-07", **LOG).collect()}
    step = balances.daily_balance_incremental(events, as_of="2024-01-08", **LOG).collect()
    assert {(r.k, r.date): r.balance for r in step} == {k: v for k, v in dense.items() if k[1] == date(2024, 1, 7)}


def test_as_of_sees_nothing_later(events):
    got = {r.k: r.balance for r in balances.balance_as_of(events, day="2024-01-03", **LOG).collect()}
    assert got == {"a": 11.0, "b": 5.0}


def portfolio_tables(table):
    log = table(
        """transaction_id int, client_id string, product_id int, location_id int, created timestamp, units double,
        total_units_before double, total_units_after double, location_breakdown string, location_breakdown_before string,
        location_breakdown_after string""",
        (1, "c", 1, 1, datetime(2024, 1, 1), 5.0, 0.0, 5.0, '[{"volume":"5","location_code":"L1"}]', None,
         '[{"volume":"5","location_code":"L1"},{"volume":"7","location_code":"L2"}]'),
        (2, "c", 1, 1, datetime(2024, 1, 3), 2.0, 5.0, 3.0, None, '[{"volume":"5","location_code":"L1"}]', "[]"),
        (3, "c", 2, 2, datetime(2024, 1, 2), 4.0, 1.0, 5.0, None, None, None),
        (4, "c", 2, None, datetime(2024, 1, 2), 4.0, 1.0, 5.0, None, None, None),
        (5, "c", 3, 2, datetime(2024, 2, 10), 1.0, 0.0, 1.0, None, None, None),
        (6, "c", 1, 1, datetime(2021, 1, 3), 2.0, 5.0, 3.0, None, None, None),
    )
    products = table("id int, product_type string, product_code string, maturity_date date",
                     (1, "Plain", "P1", date(2024, 1, 31)), (2, "Special", "P2", None), (3, "Plain", "P3", date(2024, 1, 31)))
    places = table("id int, code string, name string, state string", (1, "L1", "One", "S1"), (2, "L2", "Two", "S2"))
    return log, products, places


def test_breakdown_expansion(table):
    log, products, places = portfolio_tables(table)
    described = portfolio.describe_log(log, products, places, "2022-08-28", "Special")
    rows = portfolio.expand_location_breakdown(described).collect()
    got = {(r.transaction_id, r.position): (r.total_volume_before, r.location_code_before, r.total_volume_after, r.location_code_after)
           for r in rows}
    assert got == {
        (1, 0): (0.0, "L1", 5.0, "L1"), (1, 1): (None, None, 7.0, "L2"),
        (2, 0): (5.0, "L1", None, None),
        (3, 0): (1000.0, "L2", 5000.0, "L2"), (5, 0): (0.0, "L2", 1.0, "L2"),
    }


def test_moved_volume_falls_back_to_units(table):
    rows = portfolio.portfolio_transactions(*portfolio_tables(table), "2022-08-28", "Special").collect()
    got = {(r.transaction_id, r.position): (r.volume, r.actual_location_code) for r in rows}
    assert got[(1, 0)] == (5.0, "L1") and got[(1, 1)] == (5.0, "L1") and got[(3, 0)] == (4000.0, "L2")


def test_portfolio_horizon(table):
    log, products, places = portfolio_tables(table)
    transactions = portfolio.portfolio_transactions(log, products, places, "2022-08-28", "Special")
    rows = portfolio.portfolio_daily_balance(transactions, places, "2024-06-30").collect()
    span = {}
    for r in rows:
        key = (r.product_code, r.location)
        span[key] = max(span.get(key, date(1, 1, 1)), r.portfolio_date)
    assert span[("P1", "One")] == date(2024, 2, 29)  # matures 31 January, last move before
    assert span[("P2", "Two")] == date(2024, 6, 30)  # never matures
    assert span[("P3", "Two")] == date(2024, 3, 10)  # moved after maturity
    late = portfolio.portfolio_incremental(transactions, places, "2024-03-05").collect()
    assert {(r.product_code, r.portfolio_date) for r in late} == {("P2", date(2024, 3, 4)), ("P3", date(2024, 3, 4))}


def test_inventory_drops_deleted_rows(table):
    moves = table(
        """store_inventory_account_id string, client_id string, created timestamp, is_deleted boolean, reserved_units_after int,
        units_after int, total_units_after int, reserved_volume_after double, volume_after double, total_volume_after double, id int""",
        ("x", "c", datetime(2024, 1, 1, 5), False, 1, 2, 3, 1.0, 2.0, 3.0, 1),
        ("x", "c", datetime(2024, 1, 1, 6), True, 9, 9, 9, 9.0, 9.0, 9.0, 2),
        ("x", "d", datetime(2024, 1, 3), False, 4, 5, 9, 4.0, 5.0, 9.0, 3),
    )
    accounts = table("id string, store_id int, product_id int, quality_level string", ("x", 1, 1, "A"))
    stores = table("id int, name string", (1, "Main"))
    products = table("id int, name string, code string, category_type string", (1, "Rice", "R", "food"))
    rows = inventory.inventory_daily_balance(moves, accounts, stores, products, "2024-01-04", ["id"]).orderBy("inventory_date").collect()
    assert [(r.inventory_date.day, r.client_id, r.current_total_units) for r in rows] == [(1, "c", 3), (2, "c", 3), (3, "d", 9), (4, "d", 9)]
    last = inventory.inventory_incremental(moves, accounts, stores, products, "2024-01-05", ["id"]).collect()
    assert [(r.inventory_date, r.current_available_volume, r.store_name) for r in last] == [(date(2024, 1, 4), 5.0, "Main")]


def test_balances_at_many_days(spark):
    rng = random.Random(5)
    events = [(rng.choice([1, 2, None]), datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 900)), float(n), n, rng.choice(["ok", "bad"])) for n in range(120)]
    probes = [(k, date(2023, 12, 30) + timedelta(d)) for k in (1, 2, 3, None) for d in range(0, 45)] * 2
    df = spark.createDataFrame(events, "k int, ts timestamp, v double, n int, s string")
    asked = spark.createDataFrame(probes, "k int, date date")
    found = balances.balances_as_of(df, asked, ["k"], "ts", {"balance": "v"}, tiebreak=["n"], status="s", excluded=["bad"]).collect()
    want = {}
    for k, day in probes:
        past = [(ts, n, v) for key, ts, v, n, s in events if key == k and s != "bad" and ts.date() <= day]
        if past:
            ts, _, v = max(past)
            want[day, k] = (v, ts)
    assert len(found) == len(want) and {(r.date, r.k): (r.balance, r.latest_trans_at) for r in found} == want
    assert balances.balances_as_of(df.limit(0), asked, ["k"], "ts", {"balance": "v"}).collect() == []


def test_days_are_written_out_in_many_tasks(events):
    dense = balances.daily_balance(events, through="2024-01-07", **LOG)
    assert dense.rdd.getNumPartitions() >= 256


def test_probes_meet_events_in_many_tasks(events):
    found = balances.balances_as_of(events, events.select("k", "ts"), ["k"], "ts", {"balance": "amount"}, day="ts")
    assert found.rdd.getNumPartitions() >= 256
