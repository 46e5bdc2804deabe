import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.functions import crypto, dates, latest, quantiles, ranks, recurrence, skew, text


def test_age_months_counts_whole_months(table):
    rows = [
        (datetime(2024, 2, 29), datetime(2024, 1, 31), 0), (datetime(2024, 3, 31), datetime(2024, 2, 29), 1),
        (datetime(2024, 3, 1), datetime(2023, 3, 1), 12), (datetime(2024, 3, 1), datetime(2023, 3, 1, 8), 11),
        (datetime(2023, 3, 1), datetime(2024, 3, 1), -12), (datetime(2001, 1, 1), datetime(2001, 3, 15), -2),
    ]
    df = table("e timestamp, s timestamp, want int", *rows)
    got = df.select(dates.age_months(F.col("e"), F.col("s")).alias("m"), "want").collect()
    assert [r.m for r in got] == [r.want for r in got]


def test_labels(table):
    df = table("d date, want string", (date(2021, 12, 1), "2021/2022"), (date(2021, 11, 30), "2020/2021"),
               (date(2022, 10, 1), "2022/2023"), (date(2022, 9, 30), "2021/2022"))
    got = df.select(dates.season_label(F.col("d")).alias("s"), "want").collect()
    assert all(r.s == r.want for r in got)
    one = table("d date", (date(2024, 12, 30),)).select(
        dates.week_label(F.col("d")).alias("w"), dates.quarter_label(F.col("d")).alias("q"),
        dates.month_label(F.col("d")).alias("m")).first()
    assert (one.w, one.q, one.m) == ("2024_1", "Q4 2024", "12_2024")


def test_weekend_belongs_to_next_week(table):
    days = [(date(2024, 3, d), "a") for d in range(8, 13)]  # Friday to Tuesday
    got = {r.date.day: r.adj_woy for r in dates.calendar_labels(table("date date, k string", *days), "date", "k").collect()}
    assert got == {8: "2024_10", 9: "2024_11", 10: "2024_11", 11: "2024_11", 12: "2024_11"}


def test_trading_date_cutoff(table):
    df = table("t timestamp_ntz", (datetime(2024, 1, 1, 13, 59),), (datetime(2024, 1, 1, 14, 0),), (datetime(2024, 1, 31, 23, 30),))
    got = [r.d for r in df.select(dates.trading_date(F.col("t")).alias("d")).collect()]
    assert got == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 1)]


def test_latest_row_uses_tiebreak(table):
    df = table("k string, t int, id int, v string", ("a", 1, 1, "x"), ("a", 2, 2, "y"), ("a", 2, 3, "z"), (None, 1, 4, "n"))
    got = {r.k: r.v for r in latest.latest_row(df, ["k"], ["t", "id"]).collect()}
    assert got == {"a": "z", None: "n"}


@pytest.mark.parametrize("few_keys", [False, True])
def test_quantiles_match_numpy_with_hot_key(spark, few_keys):
    rng = random.Random(7)
    rows = [("hot", float(rng.randint(0, 50))) for _ in range(4000)] + [("n%d" % (i % 300), rng.random()) for i in range(4000)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 2.0), ("null", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.k: r.quantiles for r in quantiles.exact_quantiles(df, ["k"], "v", probabilities, few_keys=few_keys).collect()}
    want = {}
    for k, v in rows:
        if v is not None:
            want.setdefault(k, []).append(v)
    assert set(got) == set(want)
    for k, values in want.items():
        assert np.allclose(got[k], np.quantile(values, probabilities), atol=1e-9), k


def test_quantiles_beyond_sketch_accuracy(spark):
    df = spark.range(0, 400_000, 1, 8).select((F.pmod(F.col("id") * 7919, F.lit(400_000)) * 1.0).alias("v"))
    got = quantiles.exact_quantiles(df, [], "v", [0.25, 0.3333, 0.75]).first().quantiles
    assert np.allclose(got, np.quantile(np.arange(400_000.0), [0.25, 0.3333, 0.75]), atol=1e-6)


def test_group_stats_with_hot_and_null_keys(spark):
    rows = [("hot", i % 10, i) for i in range(3000)] + [("k%d" % (i % 100), 1, i) for i in range(2000)] + [(None, 3, 1)] * 5
    df = spark.createDataFrame(rows, "k string, v int, id int")
    got = skew.with_group_stats(df, ["k"], {"n": F.count("*"), "s": F.sum("v")})
    assert got.count() == len(rows)
    per = {r.k: (r.n, r.s) for r in got.select("k", "n", "s").distinct().collect()}
    assert per["hot"] == (3000, 13500) and per[None] == (5, 15) and per["k7"] == (20, 20)


def test_hot_keys_are_found(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hashes = df.limit(1).select(skew.hot_key_hashes(df, ["k"]).alias("h"), F.xxhash64(F.lit(-1).cast("long")).alias("x")).first()
    assert hashes.h == [hashes.x]


def test_codes_follow_sorted_order(table):
    words = ["b", "abcdz", "abcda", "abcd", "a", "Z", "é", None, "b"]
    df = table("g string, v string", *[("x", w) for w in words])
    got = {r.v: r.code for r in ranks.ordered_codes(df, "g", "v").collect()}
    assert got == {w: i for i, w in enumerate(sorted({w for w in words if w}, key=lambda s: s.encode()))}


def test_codes_of_many_values_with_a_common_start(spark):
    df = spark.range(100_000).select(F.lit("x").alias("g"), F.format_string("http://%07d", (F.col("id") * 7919) % 100_000).alias("v"))
    coded = ranks.ordered_codes(df, "g", "v")
    assert coded.where(F.substring("v", 8, 7).cast("long") != F.col("code")).count() == 0
    assert coded.count() == 100_000


def test_mode_prefers_smallest_on_tie(table):
    df = table("c string, v string", ("x", "b"), ("x", "a"), ("x", "b"), ("x", "a"), ("x", None), ("y", "q"))
    assert {r.c: r.mode for r in quantiles.most_frequent(df, ["c"], "v").collect()} == {"x": "a", "y": "q"}


def test_decrypt_keeps_what_it_cannot_read(table):
    key, iv = b"k" * 16, b"i" * 16
    df = table("id int, v string", (1, "plain é"), (2, ""), (3, None))
    hidden = df.withColumn("v", crypto.encrypted("v", key, iv)).unionByName(
        table("id int, v string", (4, "not base64!"), (5, "QUJD"), (6, "x" * 40)))
    got = {r.id: r.v for r in crypto.decrypt_columns(hidden, key, iv).collect()}
    assert got == {1: "plain é", 2: "", 3: None, 4: "not base64!", 5: "QUJD", 6: "x" * 40}
    wrong = {r.id: r.v for r in crypto.decrypt_columns(hidden.where("id = 1"), b"w" * 16, iv).collect()}
    assert wrong[1] == hidden.where("id = 1").first().v


def test_html_text(table):
    html = "<html><style>p{}</style><script>var t='</p>';</script><!-- no --><p>A &amp; B</p>\n<b>c&lt;d</b></html>"
    assert table("h string", (html,)).select(text.html_text(F.col("h")).alias("t")).first().t == "A & B c<d"


def test_unreadable_document_names_file(table):
    df = table("n string, c binary", ("a.pdf", bytearray(b"%PDF")), ("b.txt", bytearray(b"ok")), ("c.txt", bytearray(b"\xff\xfe")))
    got = [r.t for r in df.select(text.document_text(F.col("n"), F.col("c")).alias("t")).collect()]
    assert got == ["No Text In CV With Filename: a.pdf", "ok", "No Text In CV With Filename: c.txt"]


def test_fill_calendar(table):
    df = table("k string, d date, v int", ("a", date(2023, 12, 25), 1), ("a", date(2024, 1, 2), 2), ("b", date(2023, 1, 1), 3),
               ("b", date(2023, 12, 31), 4), ("c", date(2024, 2, 1), 5), ("e", date(2024, 1, 3), None))
    rows = dates.fill_calendar(df, ["k"], "d", dates.as_date("2024-01-01"), dates.as_date("2024-01-03"), ["v"]).collect()
    assert len(rows) == 12 and len({(r.k, r.d) for r in rows}) == 12
    assert [(r.k, r.d.day, r.v) for r in rows if r.v is not None] == [("a", 2, 2)]


@pytest.mark.parametrize("block", [1, 3, 512])
def test_chained_steps(spark, block):
    rng = random.Random(block)
    maybe = lambda p: rng.uniform(-2, 2) if rng.random() < p else None
    rows = []
    for series, size in (("a", 40), ("b", 1), (None, 25), ("c", 17)):
        for at in sorted(rng.sample(range(-30, 60), size)):
            add = maybe(0.8)
            rows.append((series, at, maybe(0.4), add, None if add is None else rng.uniform(-1, 1)))
    steps = spark.createDataFrame(rows, "series string, at int, start double, add double, factor double")
    want, value = {}, {}
    for series, at, start, add, factor in rows:
        before = value.get(series)
        value[series] = want[series, at] = start if before is None else None if add is None else add + factor * before
    got = {(r.series, r.at): r.value for r in recurrence.chained(steps.orderBy("add"), ["series"], "at", block).collect()}
    assert got.keys() == want.keys()
    for key, v in want.items():
        assert got[key] == (v if v is None else pytest.approx(v)), key


@pytest.mark.parametrize("block", [1, 4, 512])
def test_last_marked_position(spark, block):
    rng = random.Random(block)
    rows = [(s, at, rng.random() < 0.2) for s in ("a", "b", None) for at in rng.sample(range(-40, 80), 50)]
    found = recurrence.last_before(spark.createDataFrame(rows, "s string, at int, on boolean"), ["s"], "at", F.col("on"), block).collect()
    assert len(found) == len(rows)
    for r in found:
        own = [(at, on) for s, at, on in rows if s == r.s]
        assert r.first_position == min(at for at, _ in own)
        assert r.last_marked == max((at for at, on in own if on and at <= r.at), default=None)


def test_a_long_series_is_many_blocks(spark):
    days = 1_000_000
    steps = spark.range(days).selectExpr("'a' as s", "id as at", "1D as start", "1D as add", "if(id = 777777, 0D, 0.5D) as factor")
    found = recurrence.chained(steps, ["s"], "at")
    ends = found.where("at in (0, 1, 777776, 777777, 777778, 999999)").orderBy("at").collect()
    assert [r.value for r in ends] == pytest.approx([1, 1.5, 2, 1, 1.5, 2])
    assert found.count() == days
    # no task folds more than a block of positions or one row per block
    assert steps.groupBy(recurrence.block_of(F.col("at"), recurrence.BLOCK)).count().agg({"count": "max"}).first()[0] <= recurrence.BLOCK
