import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from daybook.functions import ordered
from daybook.operators import profile, quality as q


def result(df, rule):
    r = q.run_suite(df, [rule]).first()
    return r.success, r.evaluated, r.failing


def test_row_rules(table):
    df = table("id int, v double, s string", (1, 1.0, "ab"), (2, None, "abc"), (3, 5.0, None), (4, 9.0, "x"))
    assert result(df, q.not_null("v")) == (False, 4, 1)
    assert result(df, q.not_null("v", mostly=0.75)) == (True, 4, 1)
    assert result(df, q.not_null("v", where=F.col("id") > 2)) == (True, 2, 0)
    assert result(df, q.between("v", 1, 9)) == (True, 3, 0)
    assert result(df, q.between("v", 1, 9, strict_min=True, strict_max=True)) == (False, 3, 2)
    assert result(df, q.length_between("s", 2, 3)) == (False, 3, 1)
    assert result(df, q.in_set("s", ["ab", "abc"])) == (False, 3, 1)
    assert result(df, q.matches_regex("s", "^[a-c]+$")) == (False, 3, 1)
    assert result(df, q.custom_rule("twice", ["id", "v"], lambda i, v: v >= i)) == (True, 3, 0)
    assert [r.id for r in q.failing_rows(df, q.between("v", 2, None)).collect()] == [1]


def test_empty_table(table):
    df = table("v double")
    got = q.run_suite(df, [q.not_null("v"), q.unique("v"), q.row_count_between(1, 5), q.recent_data("v", "day", 1, "2024-01-01")])
    assert {r.rule: r.success for r in got.collect()} == {"not_null": True, "unique": True, "row_count_between": False, "recent_data": False}


def test_unique_and_relationships(table):
    df = table("k int", (1,), (1,), (2,), (None,), (None,))
    parent = table("p int", (1,), (1,), (None,))
    assert result(df, q.unique("k")) == (False, 3, 2)
    assert result(df, q.relationships("k", parent, "p")) == (False, 3, 1)


@pytest.mark.parametrize("values, failing", [([22, 24, 23, 21, 25], []), ([12, 15, 14, 13, 98], [98]), ([20, 4, 2, 7, 6], [20])])
def test_quartile_limits(table, values, failing):
    df = table("v int", *[(v,) for v in values])
    assert [r.v for r in q.failing_rows(df, q.within_quartile_limits("v")).collect()] == failing


@pytest.mark.parametrize("a, b, failing", [
    ([15, 20, 25, 30, 35], [40, 42, 45, 48, 50], []), ([20, 4, 2, 7, 6], [22, 24, 23, 21, 25], [20]),
    ([12, 15, 14, 13, 98], [22, 24, 100, 21, 25], [98, 100]),
])
def test_quartile_limits_by_category(table, a, b, failing):
    df = table("c string, v int", *[("a", v) for v in a], *[("b", v) for v in b])
    got = sorted(r.v for r in q.failing_rows(df, q.within_quartile_limits_by("v", "c")).collect())
    assert got == failing


def test_phones(table):
    good = [("+234 803 123 4567", "NG"), ("8031234567", "NG"), ("07031234567", "NG"), ("+12125550123", "US"), ("12125550123", "US"),
            ("(212) 555-0123", "US"), ("+447911123456", "UK"), ("07911 123456", "GB")]
    bad = [("+4479111234567", "UK"), ("+234203123456", "NG"), ("803123", "NG"), ("+12125550123", "NG"), ("word", "US"), ("2125550123", "XX")]
    df = table("p string, c string, ok boolean", *[(*g, True) for g in good], *[(*b, False) for b in bad])
    rows = df.select("p", "ok", q.phone_is_valid(F.col("p"), F.col("c")).alias("v")).collect()
    assert [(r.p, r.v) for r in rows] == [(r.p, r.ok) for r in rows]


def test_series_rules(table):
    rows = [("s", date(2024, 1, d), 100.0 + d % 2) for d in range(1, 31)] + [("s", date(2024, 2, 1), 500.0), ("t", date(2024, 1, 1), 1.0)]
    df = table("k string, d date, v double", *rows)
    assert [r.v for r in q.failing_rows(df, q.suspicious_volume("v", "d", ["k"])).collect()] == [500.0]
    assert [r.v for r in q.failing_rows(df, q.reasonable_movement("v", "d", ["k"], 20)).collect()] == [500.0]


def test_balance_rules(table):
    df = table("d date, side string, v double", (date(2024, 1, 1), "BUY", 100.0), (date(2024, 1, 1), "SELL", 95.0),
               (date(2024, 1, 2), "BUY", 100.0), (date(2024, 1, 2), "SELL", 50.0), (date(2024, 1, 3), "X", 5.0))
    bad = q.failing_rows(df, q.balanced_daily_volumes("v", "v", "d", "side")).collect()
    assert [r.d.day for r in bad] == [2]


def test_suite_summary_and_history(spark, table, tmp_path):
    df = table("id int, email string", (1, "a@b.c"), (2, "no mail"))
    rules = [q.not_null("id"), q.unique("id"), q.matches_regex("email", "@"), q.columns_match_set(["id", "email"]), q.column_type("id", "TEXT")]
    run = q.Run("people", "people_suite", "2024-01-01 00:00:00", regex_columns=["email"])
    results = q.run_suite(df, rules)
    row = q.suite_summary(results, run).first()
    assert (row.success_percent, row.evaluated_expectations, row.successful_expectations, row.success) == (60.0, 5, 3, False)
    assert (row.expectation_email, row.expectation_email_true, row.expectation_unique_true) == (1, 0, 1)
    for _ in range(2):
        q.store_run(results, run, str(tmp_path / "history"), str(tmp_path / "json"))
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2
    assert spark.read.json(str(tmp_path / "json")).count() == 5


def test_profile_and_suggestions(table):
    df = table("id int, v double, s string", (1, 1.0, "x"), (2, None, "y"), (3, 3.0, None), (4, 5.0, "x"))
    p = {r.column: r for r in profile.profile(df).collect()}
    assert (p["v"].n_nulls, p["v"].n_distinct, p["v"].median, p["s"].min_text, p["s"].n_distinct) == (1, 3, 3.0, "x", 2)
    drafts = {(r.column, r.rule): r for r in profile.suggest_rules(df, max_set=2).collect()}
    assert set(drafts) == {("id", "not_null"), ("id", "unique"), ("id", "between"), ("v", "between"), ("s", "in_set")}
    assert drafts[("s", "in_set")]["values"] == "x,y"


@pytest.mark.parametrize("rows,size,range_rows", [(0, 3, 10), (1, 1, 10), (200, 1, 7), (200, 30, 4), (200, 500, 20), (50, 3, 1)])
def test_one_series_over_many_ranges(spark, rows, size, range_rows):
    rng = random.Random(rows + size)
    data = [(k, rng.choice([None, rng.randint(1, 9)]), rng.choice(["x", None])) for k in range(rows)]
    day = lambda k: None if k < 3 else k // 50  # noqa: E731  long ties, and nulls first
    rng.shuffle(data)
    df = spark.createDataFrame([(day(k), k, v, s) for k, v, s in data], "day int, id int, v int, _nth string")
    columns = {"total": lambda w: F.sum("v").over(w), "last": ordered.last_value("v"), "n": lambda w: F.count("*").over(w)}
    found = ordered.rows_before(df, ["day", "id"], size, columns, range_rows).collect()
    assert len(found) == rows
    values = [v for _, v, _ in sorted(data, key=lambda r: r[0])]
    for r in found:
        own = values[max(0, r.id - size) : r.id]
        known = [v for v in own if v is not None]
        assert (r.total, r["last"], r.n) == (sum(known) if known else None, own[-1] if own else None, len(own))


def test_rules_without_a_partition(spark):
    df = spark.createDataFrame([(k, float(v)) for k, v in enumerate([10, 11, 9, 30, 31, 30, 100])], "day int, v double")
    moved = q.failing_rows(df, q.reasonable_movement("v", "day", max_pct=50)).collect()
    assert sorted((r.day, r.previous_value) for r in moved) == [(3, 9.0), (6, 30.0)]
    high = q.failing_rows(df, q.suspicious_volume("v", ["day"], window=3)).collect()
    assert sorted(r.day for r in high) == [3, 6]
    result = q.run_suite(df, [q.suspicious_volume("v", "day", window=3)]).first()
    assert (result.evaluated, result.failing, result.success) == (7, 2, False)


def test_profiles_merge(spark):
    df = spark.range(20_000).selectExpr("id % 7 as part", "if(id % 10 = 0, null, id % 3000) as v", "concat('s', id % 50) as s", "cast(null as double) as none")
    parts = profile.profile_parts(df, "part")
    merged = {r["column"]: r for r in profile.profile_of_parts(parts).collect()}
    exact = {r["column"]: r for r in profile.profile(df.drop("part")).collect()}
    assert merged.keys() == exact.keys()
    for c, e in exact.items():
        m = merged[c]
        assert (m.n_rows, m.n_nulls, m.min, m.max, m.min_text, m.max_text) == (e.n_rows, e.n_nulls, e.min, e.max, e.min_text, e.max_text)
        assert m.n_distinct == pytest.approx(e.n_distinct, rel=0.05)
    assert merged["v"].mean == pytest.approx(exact["v"].mean)
    assert merged["v"].median == pytest.approx(exact["v"].median, abs=0.03 * 3000)
    assert merged["none"].median is None
    # the merged sketch is the sketch of all rows, whichever way they are dealt into parts
    again = profile.profile_of_parts(profile.profile_parts(df.withColumn("part", F.col("part") % 2), "part")).where("column = 'v'").first()
    assert again.n_distinct == merged["v"].n_distinct
    assert profile.profile_of_parts(parts.limit(0)).collect() == []
