"""Sources, sinks, load steps and set operations."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmarts import storage
from tillmarts.operators import aggregates as G
from tillmarts.operators import filters, joins, loads, sets
from tillmarts.sources import readers as R
from tillmarts.sources import writers as W
from tillmarts.storage import fresh_path, materialize


def test_seed_with_a_stray_blank_in_the_header(spark, tmp_path, rows):
    (tmp_path / "seed.csv").write_text("color ,sku\nArena,2249AREN00S\nAzul Marino,2249AZMA00M\n")
    assert rows(R.read_seed_csv(spark, str(tmp_path))) == [("Arena", "2249AREN00S"), ("Azul Marino", "2249AZMA00M")]


@pytest.mark.parametrize("multi_line", [False, True])
def test_pages(spark, tmp_path, rows, multi_line):
    gap = "\n" if multi_line else " "
    (tmp_path / "a.json").write_text('{"orders":' + gap + '[{"id": 1}, {"id": 2}]}')
    (tmp_path / "b.json").write_text('{"orders":' + gap + "[]}")
    item = T.StructType.fromDDL("id bigint")
    assert rows(R.read_json_pages(spark, str(tmp_path), item, "orders", multi_line)) == [(1,), (2,)]


def test_malformed_pages_are_an_error_or_set_apart(spark, tmp_path, rows):
    pages = ['{"items": [{"id": 1}]}', '{"items": [{"id": 2}', '{"items": [{"id": 3}]}', '{"items": 5}', "{}"]
    (tmp_path / "a.json").write_text("\n".join(pages))
    item = T.StructType.fromDDL("id bigint")
    with pytest.raises(Exception):
        R.read_json_pages(spark, str(tmp_path), item).collect()
    good, bad = R.split_json_pages(spark, str(tmp_path), item)
    assert rows(good) == [(1,), (3,)]
    assert rows(bad) == sorted([(pages[1],), (pages[3],)])


def test_shared_folder_must_be_named_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session())


def test_a_reader_sees_new_columns(spark, tmp_path):
    for n in (1, 2):
        spark.range(3).selectExpr(*["id AS c%d" % i for i in range(n)]).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
        assert len(R.scan_table(spark, str(tmp_path), "t").columns) == n


def test_series(spark):
    assert R.date_series(spark, "2024-02-28", "2024-03-01").count() == 3


BASE = "id string, day string, n int"


@pytest.mark.parametrize("partition", [None, "day"])
def test_upsert(spark, rows, partition):
    path = fresh_path(spark, "test-upsert")
    first = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("c", "3", 3)], BASE)
    W.sink_upsert(path, first, "id", ["n"], partition)
    batch = spark.createDataFrame([("b", "2", 9), ("b", "2", 8), ("d", "2", 4), ("e", "4", 5)], BASE)
    expected = [("a", "1", 1), ("b", "2", 8), ("c", "3", 3), ("d", "2", 4), ("e", "4", 5)]
    for _ in range(2):  # the second run changes nothing
        W.sink_upsert(path, batch, "id", ["n"], partition)
        stored = spark.read.schema(BASE).parquet(path)
        assert rows(stored, "id", "day", "n") == expected


def test_upsert_reads_and_replaces_touched_partitions_only(spark, rows):
    path = fresh_path(spark, "test-partitions")
    start = [("a", "1", 1), ("b", "2", 2), ("n", None, 3)]
    W.sink_upsert(path, spark.createDataFrame(start, BASE), "id", ["n"], "day")
    stored = spark.read.schema(BASE).parquet(path)
    untouched = {f for f in stored.inputFiles() if "day=1" in f}
    batch = spark.createDataFrame([("m", None, 4), ("b", "2", 5)], BASE)
    values = materialize(batch.select("day").distinct(), "test-values")
    text = W.touched_partitions(stored, values, "day")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and "Exchange hashpartitioning" not in text
    W.sink_upsert(path, batch, "id", ["n"], "day")
    stored = spark.read.schema(BASE).parquet(path)
    assert rows(stored, "id", "day", "n") == [("a", "1", 1), ("b", "2", 5), ("m", None, 4), ("n", None, 3)]
    assert untouched <= set(stored.inputFiles())


@pytest.mark.parametrize("partition", [None, "day"])
def test_a_failed_upsert_leaves_the_table_and_can_be_repeated(spark, rows, monkeypatch, partition):
    path = fresh_path(spark, "test-failure")
    W.sink_upsert(path, spark.createDataFrame([("a", "1", 1), ("b", "1", 2)], BASE), "id", ["n"], partition)
    batch = spark.createDataFrame([("b", "1", 5), ("c", "1", 3)], BASE)
    right = W.upsert
    with monkeypatch.context() as m:
        fault = F.when(F.col("id") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("int")
        m.setattr(W, "upsert", lambda *args: right(*args).withColumn("n", fault))
        with pytest.raises(Exception, match="lost"):
            W.sink_upsert(path, batch, "id", ["n"], partition)
    stored = W.read_upserted(spark, path).select("id", "n")
    assert rows(stored) == [("a", 1), ("b", 2)]
    W.sink_upsert(path, batch, "id", ["n"], partition)
    assert rows(W.read_upserted(spark, path).select("id", "n")) == [("a", 1), ("b", 5), ("c", 3)]


def test_empty_text_is_the_null_partition(spark, rows):
    path = fresh_path(spark, "test-empty-text")
    W.sink_upsert(path, spark.createDataFrame([("a", None, 1), ("d", "1", 2)], BASE), "id", ["n"], "day")
    W.sink_upsert(path, spark.createDataFrame([("b", "", 3), ("c", "", 4)], BASE), "id", ["n"], "day")
    stored = spark.read.schema(BASE).parquet(path)
    assert rows(stored, "id", "day", "n") == [("a", None, 1), ("b", None, 3), ("c", None, 4), ("d", "1", 2)]


def test_a_key_may_not_move(spark, rows):
    path = fresh_path(spark, "test-moved")
    W.sink_upsert(path, spark.createDataFrame([("a", "1", 1), ("b", None, 1)], BASE), "id", ["n"], "day")
    for moved in ([("a", "2", 9)], [("b", "2", 9)], [("x", "1", 9), ("x", "2", 9)]):
        with pytest.raises(ValueError, match="two partitions"):
            W.sink_upsert(path, spark.createDataFrame(moved, BASE), "id", ["n"], "day")
    assert rows(spark.read.schema(BASE).parquet(path), "id", "day", "n") == [("a", "1", 1), ("b", None, 1)]


def test_rows_without_a_key_are_added_by_every_run(spark):
    path = fresh_path(spark, "test-null-keys")
    for n in (1, 2, 3):
        W.sink_upsert(path, spark.createDataFrame([(None, "1", 1)], BASE), "id", ["n"], "day")
        assert spark.read.parquet(path).count() == n


def test_buckets(spark, rows):
    path = fresh_path(spark, "test-buckets")
    first = spark.createDataFrame([(str(i), "1", i) for i in range(50)], BASE)
    W.sink_upsert(path, first, "id", ["n"], buckets=8)
    W.sink_upsert(path, first.filter("n = 7").withColumn("n", F.lit(70)), "id", ["n"], buckets=8)
    stored = W.read_upserted(spark, path)
    assert stored.columns == ["id", "day", "n"]
    assert rows(stored, "n") == sorted((i if i != 7 else 70,) for i in range(50))


def test_an_unreadable_table_is_not_an_absent_one(spark, tmp_path):
    assert not W.table_exists(spark, str(tmp_path / "none"))
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        W.table_exists(spark, str(tmp_path))
    (tmp_path / "emptied").mkdir()
    with pytest.raises(Exception):
        W.table_exists(spark, str(tmp_path / "emptied"))


def test_upsert_adds_rows_without_a_key(spark, rows):
    base = spark.createDataFrame([(None, "1", 1), ("a", "1", 2)], BASE)
    batch = spark.createDataFrame([(None, "1", 3), (None, "1", 3)], BASE)
    assert len(rows(W.upsert(base, batch, "id", ["n"]))) == 4


def test_appended_columns_are_the_tables_or_refused_or_widen_it(spark, rows):
    from tillmarts.sources.columns import ColumnsDiffer

    path = fresh_path(spark, "test-append-columns")
    W.sink_append(spark.createDataFrame([(1, "x", "2024")], "a bigint, b string, y string"), path, ["y"])
    W.sink_append(spark.createDataFrame([("z", "2025", 2)], "b string, y string, a int"), path, ["y"])
    more = spark.createDataFrame([(3, "w", "2025", 1.5)], "a bigint, b string, y string, c double")
    for wrong in (more, more.drop("b", "c"), spark.createDataFrame([(3, 5, "2025")], "a bigint, b bigint, y string")):
        with pytest.raises(ColumnsDiffer):
            W.sink_append(wrong, path, ["y"])
    assert W.read_appended(spark, path).count() == 2
    W.sink_append(more, path, ["y"], columns="widen")
    W.sink_append(spark.createDataFrame([(4, "2025")], "a bigint, y string"), path, ["y"], columns="widen")
    got = rows(W.read_appended(spark, path), "a", "b", "c")
    assert got == [(1, "x", None), (2, "z", None), (3, "w", 1.5), (4, None, None)]


def test_sinks(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    path = fresh_path(spark, "test-sink")
    W.sink_empty_like(df, path)
    assert spark.read.parquet(path).count() == 0
    W.sink_append(df, path)
    W.sink_append(df, path)
    W.sink_empty_like(df, path)  # an existing table is left alone
    assert spark.read.parquet(path).count() == 4
    W.sink_overwrite(df, path)
    assert rows(spark.read.parquet(path)) == rows(df)
    json_path = fresh_path(spark, "test-json")
    W.sink_json(df, json_path)
    assert rows(spark.read.schema(df.schema).json(json_path)) == rows(df)
    assert '"b":null' in " ".join(r.value for r in spark.read.text(json_path).collect())
    table = W.sink_model(df, "t_model", "table", fresh_path(spark, "test-model"), ["b"])
    assert table.count() == spark.table("t_model").count() == 2


DOCS = "id bigint, emissionDate bigint, body string"


def test_incremental_load(spark, rows):
    path = fresh_path(spark, "test-incremental")
    now = int(dt.datetime(2024, 1, 15, 15, tzinfo=dt.timezone.utc).timestamp())  # noon in Santiago
    source = spark.createDataFrame(
        [(1, now, "a"), (1, now, "a"), (2, now - 86_400, "b"), (3, now - 90 * 86_400, "old"), (4, now + 1, "later")],
        DOCS,
    )
    arguments = dict(now="2024-01-15 12:00:00", days_back=3, shape=lambda df: df)
    loads.incremental_load(source, path, **arguments)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,)]
    more = source.unionByName(spark.createDataFrame([(5, now, "new"), (2, now, "changed")], DOCS))
    loads.incremental_load(more, path, **arguments)
    assert rows(spark.read.parquet(path), "id", "body") == [(1, "a"), (2, "b"), (5, "new")]


def test_increment_sets_bad_records_apart(spark, rows):
    path, rejects = fresh_path(spark, "test-increment"), fresh_path(spark, "test-rejects")
    source = spark.createDataFrame([(1, 1, "5"), (2, 1, "x"), (3, 1, None)], DOCS)
    loads.append_new(source, path, lambda df: df, "id", casts={"body": "bigint"}, rejects=rejects)
    assert rows(spark.read.parquet(path), "id", "body") == [(1, 5), (3, None)]
    assert rows(spark.read.parquet(rejects)) == [(2, 1, "x")]


def test_an_emptied_target_stops_the_increment(spark, tmp_path):
    source = spark.createDataFrame([(1, 1, "5")], DOCS)
    with pytest.raises(Exception):
        loads.append_new(source, str(tmp_path), lambda df: df, "id")


def test_the_target_of_an_increment_is_not_shuffled(spark):
    target = spark.range(2_000_000).select(F.col("id"), F.lit("x").alias("body"))
    path = fresh_path(spark, "test-target")
    target.write.parquet(path)
    batch = spark.range(1_999_990, 2_000_010).select("id")
    out = joins.anti_join_existing(batch, spark.read.parquet(path), "id")
    assert out.count() == 10
    plan = out._jdf.queryExecution().optimizedPlan()  # the keys of the batch are a written table
    text = out._jdf.queryExecution().executedPlan().toString()
    semi = text[text.index("LeftSemi") :]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in semi, plan


def test_gap_repair_takes_one_record_per_id(spark, rows):
    second = spark.createDataFrame([(2, "b"), (2, "a"), (3, "c")], "id bigint, body string")
    loaded = spark.createDataFrame([(1, "x"), (4, "y")], "id bigint, body string")
    out = loads.gap_repair(loaded, second, ids(spark, [1, 5]), order_by=["body"])
    assert rows(out) == [(1, "x"), (2, "a"), (3, "c"), (4, "y")]


def test_a_wide_interval_is_cut_in_levels(spark):
    wide = spark.createDataFrame([(0, 10**12)], "first_id bigint, last_id bigint")
    spans = sets.cut_interval(wide, F.col("first_id"), F.col("last_id"), 10**8, "_span")
    assert spans.count() == 10**4 + 1


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_intervals_of_few_cursors(spark, rows):
    assert rows(sets.interval_pairs(ids(spark, [10, 1, 5, 5]))) == [(1, 4), (5, 9)]
    assert rows(sets.interval_pairs(ids(spark, [7]))) == []
    assert rows(sets.interval_pairs(ids(spark, []))) == []


def test_intervals_and_gaps_against_plain_python(spark, rows):
    rng = random.Random(5)
    cursors = sorted({rng.randint(0, 10**12) for _ in range(500)} | set(range(100)))
    pairs = list(zip(cursors, [c - 1 for c in cursors[1:]]))
    assert rows(sets.interval_pairs(ids(spark, cursors))) == pairs
    short = [(0, 40), (41, 60), (100, 105)]
    have = [i for i in range(130) if i % 3]
    intervals = spark.createDataFrame(short, "first_id bigint, last_id bigint")
    expected = sorted((a, b, i) for a, b in short for i in range(a, b + 1) if i not in have)
    for run in (1, 7, 10_000):
        assert rows(sets.missing_ids(intervals, ids(spark, have + have), run=run)) == expected


def test_rows_by_interval(spark, rows):
    intervals = spark.createDataFrame([(0, 9), (10, 40)], "first_id bigint, last_id bigint")
    out = filters.filter_id_intervals(ids(spark, [0, 9, 10, 40, 41]), intervals, "id", width=8)
    assert rows(out, "first_id", "id") == [(0, 0), (0, 9), (10, 10), (10, 40)]
    assert rows(filters.filter_id_range(ids(spark, [1, 2, 3]), "id", 2, 3)) == [(2,), (3,)]


def test_intervals_of_any_length_against_plain_python(spark, rows):
    rng = random.Random(8)
    pairs = [(-50, -50), (-7, 12), (5, 4), (0, 0), (1, 10**12), (-(10**15), 10**15), (2**61, 2**61 + 3)]
    for _ in range(60):
        a = rng.randint(-200, 400)
        pairs.append((a, a + rng.choice([0, 1, 7, 63, 64, 65, 500])))
    values = [*range(-60, 300, 3), 10**12, 10**12 + 1, 10**15, 10**15 + 1, 2**61 + 2, -(10**15) - 1, None]
    intervals = spark.createDataFrame(pairs, "first_id bigint, last_id bigint")
    want = sorted((i, a, b) for a, b in pairs for i in values if i is not None and a <= i <= b)
    for width in (2, 3, 16, 1000):
        got = filters.filter_id_intervals(ids(spark, values), intervals, "id", width=width)
        assert sorted(rows(got, "id", "first_id", "last_id")) == want
    assert filters.filter_id_intervals(ids(spark, values), intervals.limit(0), "id").count() == 0


def test_a_very_wide_interval_has_few_blocks(spark):
    wide = spark.createDataFrame([(1, 10**12)], "first_id bigint, last_id bigint")
    assert filters.cover_blocks(wide, "first_id", "last_id", 16).count() < 2 * 16 * 11
    big = spark.range(0, 10**6).select((F.col("id") * 1_000_003).alias("id"))
    assert filters.filter_id_intervals(big, wide, "id").count() == 10**12 // 1_000_003


def test_gaps_grow_with_what_is_fetched_not_with_what_is_missing(spark, rows):
    interval = spark.createDataFrame([(1, 10**9)], "first_id bigint, last_id bigint")
    have = ids(spark, [1, 2, 3, 5 * 10**8, 10**9, 10**9 + 7, -4])
    got = sets.missing_ranges(interval, have)
    assert rows(got) == [(1, 10**9, 4, 5 * 10**8 - 1), (1, 10**9, 5 * 10**8 + 1, 10**9 - 1)]
    assert rows(sets.missing_ranges(interval, have.filter("id < 0"))) == [(1, 10**9, 1, 10**9)]
    dense = spark.range(1, 2_000_001).filter("id NOT IN (77, 78, 1000000, 1999999)")
    some = spark.createDataFrame([(1, 2_000_000)], "first_id bigint, last_id bigint")
    assert rows(sets.missing_ids(some, dense)) == [(1, 2_000_000, i) for i in (77, 78, 1_000_000, 1_999_999)]
    plan = sets.missing_ranges(some, dense)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(gap" not in plan


def test_gaps_of_overlapping_intervals_against_plain_python(spark, rows):
    rng = random.Random(9)
    pairs = {(a, a + rng.choice([-1, 0, 5, 40, 90])) for a in (rng.randint(-100, 200) for _ in range(40))}
    have = [i for i in range(-120, 320) if rng.random() < 0.6]
    intervals = spark.createDataFrame(sorted(pairs), "first_id bigint, last_id bigint")
    want = sorted((a, b, i) for a, b in pairs for i in range(a, b + 1) if i not in set(have))
    assert rows(sets.missing_ids(intervals, ids(spark, have + have), run=7)) == want
    assert rows(sets.missing_ids(intervals.limit(0), ids(spark, have))) == []


def test_gap_repair_generates_no_ids(spark, rows):
    """A gap of 1e15 ids, closed by the two records there are."""
    loaded = spark.createDataFrame([(1, "x"), (10**15, "y")], "id bigint, body string")
    second = spark.createDataFrame([(7, "b"), (10**14, "c"), (10**15, "never"), (5 * 10**15, "outside")], "id bigint, body string")
    out = loads.gap_repair(loaded, second, ids(spark, [1, 10**15 + 1]), order_by=["body"])
    assert rows(out) == [(1, "x"), (7, "b"), (10**14, "c"), (10**15, "y")]


def test_gap_repair(spark, rows):
    full = ids(spark, range(1, 21))
    loaded = full.filter("id NOT IN (3, 8, 20)")
    cursors = ids(spark, [1, 6, 11, 20])  # 20 only closes the last interval
    out = loads.gap_repair(loaded, full, cursors)
    assert rows(out) == [(i,) for i in range(1, 20)]


def test_paged_details(spark, rows):
    kind = "id bigint, page int, items array<struct<n:int>>"
    first = spark.createDataFrame([(1, 0, [(1,), (2,)]), (2, 0, []), (3, 0, None)], kind)
    later = spark.createDataFrame([(1, 1, [(3,)]), (2, 1, [(9,)])], kind)
    assert rows(loads.merge_paged_details(first, later, "id", "items")) == [
        (1, 0, 0, 1), (1, 0, 1, 2), (1, 1, 0, 3), (2, 1, 0, 9),
    ]


def test_first_row_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n")], "k string, o int, v string")
    assert rows(G.distinct_by_key(df, ["k"], ["o"])) == [(None, 5, "n"), ("a", 1, "y")]
    assert rows(G.distinct_by_key(df, ["k"], ["o"], last=True)) == [(None, 5, "n"), ("a", 2, "x")]
    assert rows(G.distinct_by_key(df.select("k"), ["k"], [])) == [(None,), ("a",)]


def test_bad_rows_are_set_apart(spark, rows):
    df = spark.createDataFrame([(1, "5", "2024-01-01"), (2, "x", "2024-01-01"), (3, None, "bad"), (4, None, None)], "i int, n string, d string")
    good, bad = filters.split_bad_rows(df, {"n": "bigint", "d": "date"})
    assert rows(good) == [(1, 5, dt.date(2024, 1, 1)), (4, None, None)]
    assert rows(bad, "i") == [(2,), (3,)]


def test_anti_join(spark, rows):
    batch = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string")
    assert rows(joins.anti_join_existing(batch, ids(spark, [2, 3, 2]), "id", as_text=True)) == [(None,), ("1",)]


def test_update_overrides_with_null(spark, rows):
    left = spark.createDataFrame([(1, "a", "k"), (2, "b", "k")], "id int, body string, keep string")
    right = spark.createDataFrame([(1, None, "l")], "id int, body string, link string")
    out = joins.coalesce_update(left, right, "id", ["body", "link"])
    assert rows(out, "id", "body", "keep", "link") == [(1, None, "k", "l"), (2, "b", "k", None)]


def test_lookup_default(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "ad_id string")
    ads = spark.createDataFrame([("a", None, "ON")], "id string, status string, effective_status string")
    assert rows(joins.status_lookup(df, ads)) == [
        (None, "unknown", "unknown"), ("a", "unknown", "ON"), ("b", "unknown", "unknown"),
    ]


def test_dictionaries_hold_one_entry_per_key(spark, rows):
    df = spark.createDataFrame([("a",), ("b",)], "ad_id string")
    ads = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "x", 1), ("b", "y", 1)], "id string, v string, at int")
    got = joins.lookup_default(df, ads, "ad_id", "id", {"v": "v"}, order_by=["at"])
    assert rows(got) == [("a", "new"), ("b", "y")]
    right = ads.withColumnRenamed("id", "ad_id")
    assert rows(joins.coalesce_update(df, right, "ad_id", ["v"], ["at"])) == [("a", "new"), ("b", "y")]


def test_children_and_unnest(spark, rows):
    df = spark.createDataFrame([(1, [(5,)]), (2, []), (3, None)], "id int, refs array<struct<n:int>>")
    assert rows(joins.explode_children(df, "id", "refs", "document_id")) == [(1, 5)]
    assert joins.unnest(df, F.col("refs"), "r").count() == 1


def test_sums_neither_round_nor_abort(spark, rows):
    small = spark.range(100_000).select(F.lit("k").alias("k"), F.lit(0.00004).alias("v"))
    large = spark.createDataFrame([("l", 1e15), ("l", 2e14), ("l", 0.5)], "k string, v double")
    out = G.sum_by_key(small.unionByName(large), ["k"], {"v": "v"})
    assert rows(out) == [("k", 4.0), ("l", 1.2e15 + 0.5)]


def test_conditional_sums_and_counts(spark, rows):
    df = spark.createDataFrame([("k", "a", "1"), ("k", "b", "2"), ("k", "a", "4"), ("l", "c", "8")], "k string, t string, v string")
    out = G.conditional_sums(df, ["k"], "t", F.col("v"), {"a": "a", "b": "b"}, "bigint")
    assert rows(out) == [("k", 5, 2), ("l", 0, 0)]
    nulls = spark.createDataFrame([("k", 1), ("k", None), ("k", 1), ("l", None)], "k string, x int")
    assert rows(G.count_distinct(nulls, ["k"], "x", "n")) == [("k", 1), ("l", 0)]
    assert rows(G.count_nonnull(nulls, ["k"], "x", "n")) == [("k", 2), ("l", 0)]


def test_date_filters(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01T10:00:00-03:00"), (2, "2024-01-01T09:00:00-03:00"), (3, "junk"), (4, None)], "i int, t string"
    )
    # Noon UTC of the 4th less three days is noon UTC of the 1st, nine o'clock three hours behind.
    assert rows(filters.filter_since(df, "t", "2024-01-04T12:00:00Z", 3), "i") == [(1,), (2,)]
    assert rows(filters.filter_since(df, "t", "2024-01-04T12:30:00Z", 3), "i") == [(1,)]
    days = spark.createDataFrame([(d,) for d in (1, 2, 3, 4)], "d int").selectExpr("make_date(2024, 1, d) AS d")
    assert filters.filter_between_dates(days, "d", "2024-01-02", "2024-01-03").count() == 2


def test_documents_and_stock_from_pages(spark):
    from tillmarts.plans.sales import document_rows
    from tillmarts.plans.stock import stock_rows

    doc = document_rows(spark.sql("SELECT 1 AS id, named_struct('id', 9) AS document_type, 5 AS extra")).first()
    assert len(doc) == 18 and (doc.document_type, doc.client, doc.details) == ('{"id":9}', "{}", "[]")
    held = stock_rows(spark.sql("SELECT 1 AS id, 2 AS quantity, named_struct('id', 7) AS variant")).first()
    assert held.asDict() == {
        "id": 1, "quantity": 2.0, "quantityReserved": None, "quantityAvailable": None,
        "variant": '{"id":7}', "office": "{}",
    }
