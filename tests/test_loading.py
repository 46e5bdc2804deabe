import json
import os
import random
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from daybook.functions.latest import latest_row
from daybook.operators import inventory, portfolio
from daybook.session import fresh_path, shared_folder
from daybook.sources import documents, landed, tables
from daybook.sources.buckets import BucketedTable
from daybook.streaming import incremental as inc


def test_landed_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": [{"id": 1, "v": True}, {"id": 2, "w": 1.5}]}) + "\n" + json.dumps({"data": []}))
    rows = landed.read_landed_records(spark, str(tmp_path)).orderBy("id").collect()
    assert [r.asDict() for r in rows] == [{"id": "1", "v": "true", "w": None}, {"id": "2", "v": None, "w": "1.5"}]
    assert landed.read_landed_records(spark, str(tmp_path), ["id"]).columns == ["id"]


def land(folder, name, *ids):
    (folder / name).write_text(json.dumps({"data": [{"id": i, "v": f"v{i}"} for i in ids]}))


def test_pages_after_the_last_one_read(spark, tmp_path):
    for page, ids in enumerate([(1, 2), (3,), (), (4, 5)]):
        land(tmp_path, f"page-{page:04}.json", *ids)
    new = landed.read_landed_records(spark, str(tmp_path), ["id"], after="page-0001.json")
    assert sorted(r.id for r in new.collect()) == ["4", "5"]
    assert landed.read_landed_records(spark, str(tmp_path), ["id"], after="page-0003.json").count() == 0
    (tmp_path / "page-0000.json").write_text("no envelope")  # an older page is not opened again
    strict = spark.read.schema("data array<struct<id: string>>").option("mode", "FAILFAST").json(str(tmp_path))
    assert strict.where("_metadata.file_name > 'page-0001.json'").count() == 2


def test_landed_stream_goes_on_where_it_stopped(spark, tmp_path):
    pages, out, checkpoint = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    pages.mkdir()
    batches = []

    def run():
        def each(rows, batch):
            batches.append(sorted(r.id for r in rows.collect()))
            rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

        inc.run_available(landed.stream_landed_records(spark, str(pages), ["id", "v", "w"], pages_per_batch=1), each, checkpoint)

    land(pages, "a.json", 1, 2)
    land(pages, "b.json", 3)
    run()
    assert sorted(batches) == [["1", "2"], ["3"]]
    land(pages, "c.json", 4)
    land(pages, "d.json")
    run()
    run()
    assert sorted(map(str, batches[2:])) == ["['4']", "[]"]
    rows = spark.read.parquet(out).orderBy("id").collect()
    assert [(r.id, r.v, r.w) for r in rows] == [(str(i), f"v{i}", None) for i in range(1, 5)]


def test_upsert_takes_last_update(table):
    target = table("k int, v string", (1, "a"), (2, "b"), (None, "n"))
    updates = table("k int, v string", (2, "x"), (2, "y"), (3, "z"), (None, "m"))
    got = {r.k: r.v for r in tables.upsert(target, updates, ["k"], ["v"]).collect()}
    assert got == {1: "a", 2: "y", 3: "z", None: "m"}


def test_upsert_table_never_overwrites_its_source(table, tmp_path):
    with pytest.raises(ValueError):
        tables.upsert_table(table("k int", (1,)), str(tmp_path), str(tmp_path) + "/", ["k"])


def test_replace_partitions_is_rerun_safe(spark, table, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(table("d string, v int", ("1", 1), ("2", 2)), path, "d")
    for _ in range(2):
        tables.replace_partitions(table("d string, v int", ("2", 3), ("2", 4)), path, "d")
    assert sorted((str(r.d), r.v) for r in spark.read.parquet(path).collect()) == [("1", 1), ("2", 3), ("2", 4)]


def test_document_folder(spark, table, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.html").write_text("<p>Hello</p>")
    (folder / "b.html").write_text("<p>Hello</p>")
    (folder / "c.txt").write_text("plain")
    listed = documents.list_documents(spark, str(folder))
    stored = listed.where("document_name = 'c.txt'").select("file_hash")
    new = documents.ingest_new_documents(listed, stored).collect()
    assert [(r.document_text) for r in new] == ["Hello"]
    assert documents.ingest_new_documents(listed, listed.select("file_hash")).count() == 0


def test_latest_rows(table):
    df = table("t timestamp, n string", *[(datetime(2024, 1, d), str(d)) for d in range(1, 9)])
    assert [r.n for r in tables.latest_rows(df, "t", 3).collect()] == ["8", "7", "6"]


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x", query="select 1")
    assert plain["query"] == "select 1" and plain["fetchsize"] == "10000"
    split = tables.jdbc_options("jdbc:x", query="select 1", partition_column="id", bounds=("0", "9"), partitions=4)
    assert split["dbtable"] == "(select 1) AS q" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert shared_folder(spark) == shared_folder(spark)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    cluster = SimpleNamespace(conf={"spark.checkpoint.dir": str(tmp_path)}, sparkContext=SimpleNamespace(master="yarn"))
    assert fresh_path(cluster, "x").startswith(str(tmp_path))
    unset = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        fresh_path(unset, "x")


def test_stream_replay_gives_the_same_table(spark, table, tmp_path):
    rows = table("k int, ts timestamp, v double", (1, datetime(2024, 1, 1), 1.0), (1, datetime(2024, 1, 2), 2.0), (2, datetime(2024, 1, 1), 3.0))
    folder = str(tmp_path / "in")
    rows.where("v >= 2").coalesce(1).write.parquet(folder)
    rows.where("v < 2").coalesce(1).write.mode("append").parquet(folder)  # the older event arrives late

    def load(state):
        table_ = inc.VersionedTable(spark, str(tmp_path / state))
        inc.stream_latest_balances(
            inc.read_files(spark, folder, rows.schema, 1), table_, str(tmp_path / "snap"), ["k"], "ts", {"balance": "v"},
            "2024-01-05", str(tmp_path / f"checkpoint-{state}"))
        return table_

    state = load("s1")
    load("s2")  # a second run over the same files replaces the same snapshot
    got = sorted((r.k, r.balance, str(r.date)) for r in spark.read.parquet(str(tmp_path / "snap")).collect())
    assert got == [(1, 2.0, "2024-01-04"), (2, 3.0, "2024-01-04")]
    assert state.versions() == [0, 1]
    with pytest.raises(Exception, match="do not belong"):  # a new checkpoint must not start over a table that has versions
        state.before(0, rows.schema)
    assert state.latest().count() == latest_row(rows, ["k"], ["ts"]).count()


def test_stream_partitions_keeps_a_partition_split_over_batches(spark, table, tmp_path, monkeypatch):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    schema = table("d string, n int", ("d1", 1)).schema

    def arrive(*rows):
        table("d string, n int", *rows).coalesce(1).write.mode("append").parquet(folder)

    def load():
        inc.stream_partitions(inc.read_files(spark, folder, schema, 1), path, "d", checkpoint)
        return sorted((r.d, r.n) for r in spark.read.schema(schema).parquet(path).collect())

    arrive(("d1", 1), ("d2", 1))
    arrive(("d1", 2))
    assert load() == [("d1", 1), ("d1", 2), ("d2", 1)]
    assert load() == [("d1", 1), ("d1", 2), ("d2", 1)]  # nothing has arrived
    arrive(("d1", 3))
    assert load() == [("d1", 3), ("d2", 1)]  # a later load replaces the partition
    arrive(("d1", 4))
    arrive(("d1", 5))
    replace = inc.replace_partitions

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(inc, "replace_partitions", lost)
    with pytest.raises(RuntimeError):
        load()
    monkeypatch.setattr(inc, "replace_partitions", replace)
    arrive(("d2", 6))
    assert load() == [("d1", 4), ("d1", 5), ("d2", 6)]


def test_csv(spark, table, tmp_path):
    df = table("k int, s string", (1, 'a,"b"'), (2, None))
    tables.write_table(df, str(tmp_path / "c"), "csv", "overwrite")
    back = tables.read_table(spark, str(tmp_path / "c"), "csv", df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, 'a,"b"'), (2, None)]
    assert back.select(F.max("k")).first()[0] == 2


def stored(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.startswith("part-")}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "table")
    table_ = BucketedTable(spark, root, ["a", "b"], buckets=64)
    keys = F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("a"), F.col("id").alias("b")  # a null in a key
    base = spark.range(20_000).select(*keys, (F.col("id") * 2).alias("v"))
    table_.upsert(base)
    first = stored(root)
    few = base.where("b % 1000 = 3").withColumn("v", F.lit(-1).cast("long"))
    more = spark.createDataFrame([(None, 10, 7), (9, 99_999, 8), (9, 99_999, 6)], "a long, b long, v long")
    assert table_.upsert(few.unionByName(more)) == 1
    rewritten = stored(root) - first
    assert len(rewritten) <= 22 and first <= stored(root)  # a thousandth of the keys, and the version before stays
    want = {(None if k % 5 == 0 else k % 5, k): 2 * k if k % 1000 != 3 else -1 for k in range(20_000)} | {(None, 10): 7, (9, 99_999): 8}
    assert {(r.a, r.b): r.v for r in table_.latest().collect()} == want
    assert table_.upsert(spark.createDataFrame([], base.schema)) == 2
    assert table_.latest().count() == len(want)
    # the files that only the first version had are gone
    assert len(stored(root)) == len(first)


def test_merge_is_whole_or_not_there(spark, tmp_path):
    table_ = BucketedTable(spark, str(tmp_path / "table"), ["k"], buckets=4)
    rows = spark.createDataFrame([(k, k) for k in range(50)], "k int, v int")
    table_.upsert(rows)

    def fails(old, new):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        table_.merge(rows.withColumn("v", F.lit(0)), 1, fails)
    assert table_.versions() == [0] and table_.latest().where("v = k").count() == 50
    for _ in range(2):  # a repeated merge gives the same version
        table_.merge(rows.where("k < 3").withColumn("v", F.lit(0)), 1, lambda old, new: tables.upsert(old, new, ["k"]))
        assert table_.latest().where("v = 0").count() == 3 and table_.latest().count() == 50
    with pytest.raises(ValueError):
        table_.merge(rows, 5, fails)
    empty = BucketedTable(spark, str(tmp_path / "empty"), ["k"], buckets=4)
    empty.upsert(rows.where("k < 0"))
    assert empty.latest(rows.schema).count() == 0


def test_stream_portfolio_over_batches_and_a_restart(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    rows = [(f"c{rng.randint(1, 3)}", f"p{rng.randint(1, 3)}", rng.choice(["l1", "l2", None]), datetime.combine(day(rng.randint(0, 150)), datetime.min.time()),
             rng.choice([None, day(rng.randint(0, 150))]), rng.choice([1.0, 2.0, None]), float(n), n, 0) for n in range(160)]
    schema = ("client_id string, product_code string, location_code_after string, created timestamp, product_maturity_date date, volume double, "
              "total_volume_after double, transaction_id long, position int")
    places = spark.createDataFrame([("l1", "One", "S"), ("l2", "Two", "S")], "code string, name string, state string")
    folder, snapshots, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    state = BucketedTable(spark, str(tmp_path / "state"), portfolio.KEYS, buckets=4)

    def load(as_of):
        inc.stream_portfolio(inc.read_files(spark, folder, schema, 1), state, snapshots, places, as_of, checkpoint)

    def agrees(arrived, as_of):
        want = portfolio.portfolio_incremental(spark.createDataFrame(arrived, schema), places, as_of)
        found = spark.read.schema(want.schema).parquet(snapshots).where(F.col("portfolio_date") == F.date_sub(F.lit(as_of).cast("date"), 1))
        assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert found.count() > 0

    for part in (rows[:40], rows[40:80], rows[80:100]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    whole, calls = BucketedTable.merge, []

    def interrupted(self, *args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        whole(self, *args)

    monkeypatch.setattr(BucketedTable, "merge", interrupted)
    with pytest.raises(Exception):
        load("2024-04-01")
    load("2024-04-01")
    agrees(rows[:100], "2024-04-01")
    spark.createDataFrame(rows[100:], schema).coalesce(1).write.mode("append").parquet(folder)
    load("2024-05-15")
    agrees(rows, "2024-05-15")
    load("2024-06-20")  # nothing arrives, but horizons end
    agrees(rows, "2024-06-20")


def test_stream_inventory_over_batches(spark, tmp_path):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [(f"a{rng.randint(1, 6)}", "c", start + timedelta(hours=rng.randint(0, 60)), rng.random() < 0.3, *[rng.randint(0, 9) for _ in range(6)], n) for n in range(90)]
    schema = ("store_inventory_account_id string, client_id string, created timestamp, is_deleted boolean, reserved_units_after int, units_after int, "
              "total_units_after int, reserved_volume_after int, volume_after int, total_volume_after int, n int")
    accounts = spark.createDataFrame([(f"a{k}", f"s{k % 2}", f"p{k % 3}", "q") for k in range(1, 6)], "id string, store_id string, product_id string, quality_level string")
    stores = spark.createDataFrame([("s0", "Zero")], "id string, name string")
    products = spark.createDataFrame([("p0", "Nought", "P0", "goods")], "id string, name string, code string, category_type string")
    folder, snapshots = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(0, 90, 30):
        spark.createDataFrame(rows[k : k + 30], schema).coalesce(1).write.mode("append").parquet(folder)
    state = BucketedTable(spark, str(tmp_path / "state"), inventory.KEYS, buckets=4)
    inc.stream_inventory(inc.read_files(spark, folder, schema, 1), state, snapshots, accounts, stores, products, "2024-02-01", ["n"], str(tmp_path / "checkpoint"))
    want = inventory.inventory_incremental(spark.createDataFrame(rows, schema), accounts, stores, products, "2024-02-01", ["n"])
    found = spark.read.schema(want.schema).parquet(snapshots)
    assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_arriving_table_is_computed_once(spark):
    from types import SimpleNamespace

    from daybook.plans.stream_queries import arriving

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = spark.range(0, 90, 1, 6).mapInArrow(counted, "id long").groupBy("id").count()
    stream = arriving(SimpleNamespace(spark=spark), table)
    assert stream.isStreaming and seen.value == 90
