from datetime import date, datetime

import pytest

from daybook.operators import activity, history

FILMS = [
    ("a", 2000, "f1", 10, 8.5, "i1"), ("a", 2000, "f2", 10, 8.4, "i2"), ("a", 2003, "f3", 1, 6.5, "i3"),
    ("b", 2001, "g1", 1, 5.0, "j1"), ("b", 2001, "g2", 1, None, "j2"), ("c", 2002, "h1", 1, None, "k1"),
]
COLUMNS = ["year", "film", "votes", "rating", "filmid"]


@pytest.fixture
def films(table):
    return table("actor string, year int, film string, votes int, rating double, filmid string", *FILMS)


def test_cumulative_history(films):
    rows = history.cumulative_history(films, ["actor"], "year", COLUMNS, "filmid", "rating", 2004).collect()
    got = {(r.actor, r.year): (r.quality_class, r.years_since_last_active, r.is_active, [f.filmid for f in r.films]) for r in rows}
    assert got[("a", 2000)] == ("Star", 0, True, ["i1", "i2"])  # 8.45 rounds to 8.5
    assert got[("a", 2002)] == ("Star", 2, False, ["i1", "i2"])
    assert got[("a", 2004)] == ("Average", 1, False, ["i1", "i2", "i3"])
    assert got[("c", 2004)][0] == "Bad"
    assert len(rows) == 5 + 4 + 3
    assert rows[0].films[0].asDict().keys() == set(COLUMNS)


def test_large_entity_keeps_one_row_per_period(spark):
    rows = [("hot", 2000 + i % 3, f"f{i}", 1, 7.5, f"i{i:06d}") for i in range(120_000)] + FILMS
    df = spark.createDataFrame(rows, "actor string, year int, film string, votes int, rating double, filmid string")
    grown = history.cumulative_history(df, ["actor"], "year", COLUMNS, "filmid", "rating", 2004)
    sizes = {(r.actor, r.year): r.n for r in grown.selectExpr("actor", "year", "size(films) n").collect()}
    assert grown.count() == len(sizes)
    assert [sizes["hot", y] for y in range(2000, 2005)] == [40_000, 80_000, 120_000, 120_000, 120_000]


def periods(table, *rows):
    return table("id string, year int, grade string, active boolean", *rows)


def test_scd2_backfill_equals_increments(table):
    rows = [(k, y, g, a) for k, years in {
        "same": [("x", True)] * 4, "change": [("x", True), ("x", True), ("y", True), ("y", False)],
        "back": [("x", True), ("y", True), ("x", True), (None, True)],
    }.items() for y, (g, a) in enumerate(years, 2000)] + [("new", 2003, "x", True), ("gone", 2000, "x", True), ("gone", 2001, "x", True)]
    df = periods(table, *rows)
    tracked = ["grade", "active"]
    step = history.scd2_backfill(df, ["id"], "year", tracked, 2000)
    for year in (2001, 2002, 2003):
        step = history.scd2_incremental(step, df, ["id"], "year", tracked, year)
    whole = history.scd2_backfill(df, ["id"], "year", tracked, 2003)
    key = lambda r: (r.id, r.grade, r.active, r.streak_identifier, r.start_date, r.end_date, r.current_year)
    assert sorted(map(str, map(key, step.collect()))) == sorted(map(str, map(key, whole.collect())))
    covered = {}
    for r in whole.collect():
        covered.setdefault(r.id, []).extend(range(r.start_date, r.end_date + 1))
    assert all(len(v) == len(set(v)) for v in covered.values())


EVENTS = [
    ("u", "d", datetime(2023, 1, 2, 5)), ("u", "d", datetime(2023, 1, 2, 9)), ("u", "d", datetime(2023, 1, 4)),
    (None, "d", datetime(2023, 1, 1)), ("u", "lost", datetime(2023, 1, 1)), ("v", "d", datetime(2022, 12, 30)), ("v", "d", datetime(2023, 1, 5)),
]


def test_device_activity(table):
    events = table("user string, device string, ts timestamp", *EVENTS)
    devices = table("device string, browser string, version int", ("d", "Fox", 2), ("d", "Fox", 1))
    rows = activity.device_activity(events, devices, "user", "device", "browser", "ts", "2023-01-01", "2023-01-05").collect()
    got = {(r.user, r.date.day): [d.day for d in r.device_activity_datelist] for r in rows}
    assert got == {("u", 2): [2], ("u", 3): [2], ("u", 4): [2, 4], ("u", 5): [2, 4],
                   ("v", 1): [], ("v", 2): [], ("v", 3): [], ("v", 4): [], ("v", 5): [5]}


def test_bitmask(table):
    days = [date(2023, 1, 31), date(2023, 1, 30), date(2022, 12, 31), date(2022, 12, 30), date(2023, 2, 1)]
    row = activity.datelist_to_bitmask(table("k int, l array<date>", (1, days)), ["k"], "l", "2023-01-31").first()
    assert row.datelist_int == (1 << 31) + (1 << 30) + 1 and row.active_days == 3
    assert row.datelist_bits == format(row.datelist_int, "032b")


def test_monthly_arrays(table):
    events = table("host string, user string, ts timestamp", ("h", "u", datetime(2023, 1, 30, 1)), ("h", "u", datetime(2023, 1, 30, 1)),
                   ("h", "u", datetime(2023, 1, 30, 2)), ("h", "w", datetime(2023, 1, 30, 2)), ("h", None, datetime(2023, 1, 29)),
                   ("h", "u", datetime(2023, 2, 1)))
    row = activity.monthly_activity_arrays(events, ["host"], "user", "ts", "2023-01-15").collect()
    assert [(r.month, r.month_name, r.hit_array, r.unique_visitors_array) for r in row] == [("2023-01", "Jan", [3, 0], [2, 0])]


def test_scd2_incremental_keeps_carried_columns(table):
    rows = table("id int, name string, year int, grade string", (1, "a", 1, "x"), (1, "a", 2, "x"), (1, "a", 3, "y"), (2, "b", 2, None),
                 (2, "b", 3, None), (3, "c", 3, "z"), (4, "d", 1, "x"))
    before = history.scd2_backfill(rows, ["id"], "year", ["grade"], 2, ["name"])
    after = history.scd2_incremental(before, rows, ["id"], "year", ["grade"], 3, ["name"])
    whole = history.scd2_backfill(rows, ["id"], "year", ["grade"], 3, ["name"])
    assert after.columns == whole.columns
    assert sorted(map(str, after.collect())) == sorted(map(str, whole.collect()))
