import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bondscope.operators import relational
from bondscope.operators.relational import assert_unique, detail_and_total, latest_per, lookup_join, running_max, top_ranked
from bondscope.sources.tables import literal_table, sample_rows, to_long
from tests.golden import rows_of


def test_latest_per(spark):
    frame = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k int, n int, v string")
    assert sorted(rows_of(latest_per(frame, ["k"], "n"))) == [(1, 7, "b"), (2, 1, "c")]


def test_lookup_join_keeps_every_row_once(spark):
    frame = spark.range(1000).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as k")
    lookup = spark.createDataFrame([(7, "hot"), (2, "two"), (None, "never")], "code long, title string")
    for broadcast in ("10MB", "-1"):  # with and without Spark's own broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            got = lookup_join(frame, lookup, [("k", "code")])
            rows = rows_of(got)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got.columns == ["id", "k", "title"]
        assert sorted(r[0] for r in rows) == list(range(1000))
        assert all(t == {7: "hot", 2: "two"}.get(k) for _, k, t in rows)


def test_lookup_join_on_two_keys_and_repeated_lookup_rows(spark):
    frame = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, None, 1)], "id int, s string, n int")
    lookup = spark.createDataFrame([("a", 1, 10), ("a", 1, 11), ("b", 1, 12)], "ls string, ln int, v int")
    got = lookup_join(frame, lookup, [("s", "ls"), ("n", "ln")])
    assert sorted(rows_of(got, "id", "v"), key=str) == [(1, 10), (1, 11), (2, None), (3, None)]


def test_top_ranked(spark):
    frame = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, 1)], "id int, v int")
    got = top_ranked(frame, [F.desc("v"), F.asc("id")], 3, "rank")
    assert sorted(rows_of(got, "rank", "id")) == [(1, 2), (2, 3), (3, 1)]


def test_detail_and_total_tells_a_null_group_from_the_total(spark):
    frame = spark.createDataFrame([(1, None, 2.0), (1, "x", 4.0), (2, None, 8.0)], "Date int, g string, v double")
    got = detail_and_total(frame, "g", {"s": F.sum("v")}, {"s": F.col("s")}, "All")
    assert sorted(rows_of(got, "Ord", "Date", "g", "s"), key=str) == [
        (0, 1, "All", 6.0),
        (0, 2, "All", 8.0),
        (1, 1, "x", 4.0),
        (1, 1, None, 2.0),
        (1, 2, None, 8.0),
    ]


def test_running_max_of_a_short_sequence(spark):
    rows = list(enumerate([9, 41, 12, 3, 74, 15]))
    frame = literal_table(spark, rows, "n int, v int")
    got = running_max(frame, "v", ["n"])
    assert rows_of(got.orderBy("n"), "RunningMax") == [(9,), (41,), (41,), (41,), (74,), (74,)]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_max_agrees_with_a_loop(spark, keys):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [
        (i, rng.choice([None, "a", "a", "b"]), start + timedelta(minutes=rng.randrange(6000)), rng.choice([None, *range(-9, 99)]))
        for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "id int, k string, t timestamp_ntz, v int")
    got = running_max(frame, "v", ["t", "id"], keys)
    expected = {}
    ordered = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or "") if keys else 0, r[2], r[0]))
    for _, group in itertools.groupby(ordered, key=lambda r: r[1] if keys else 0):
        best = -1
        for i, _, _, v in group:
            best = max(best, v) if v is not None else best
            expected[i] = best
    assert dict(rows_of(got, "id", "RunningMax")) == expected


def test_running_max_splits_a_hot_hour(spark):
    frame = spark.range(20_000).selectExpr("id", "timestamp_ntz '2024-01-01 10:00:00' as t", "id % 977 as v")
    got = running_max(frame, "v", ["t", "id"])
    rows = dict(rows_of(got, "id", "RunningMax"))
    assert rows[0] == 0 and rows[500] == 500 and rows[19_999] == 976
    blocks = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_at" in blocks
    cuts = [r[0] for r in got.select("id").collect()]
    assert len(cuts) == 20_000


def test_running_max_parts_rows_of_one_time(spark, monkeypatch):
    hot = "timestamp_ntz '2024-01-01 10:00:00'"
    frame = spark.range(12_000).selectExpr("id", f"if(id % 3 = 0, {hot}, timestampadd(second, id, {hot})) as t", "id % 977 as v")
    seen, cut = [], relational._range_cuts
    monkeypatch.setattr(relational, "_range_cuts", lambda *given: seen.append(cut(*given)) or seen[0])
    got = running_max(frame, "v", ["t"]).cache()
    assert got.columns == ["id", "t", "v", "RunningMax"] and got.count() == 12_000
    place = F.struct("t", F.xxhash64("id", "t", "v").alias("_tie"))
    block = relational._cuts_below(seen[0], place, frame.select(place).schema[0].dataType)
    sizes = [r["count"] for r in frame.groupBy(block.alias("block")).count().collect()]
    assert len(sizes) == len(seen[0]) + 1 and max(sizes) < 2 * 12_000 / len(sizes)
    at_hot = got.where(f"t = {hot}")
    assert at_hot.where("RunningMax < v").count() == 0 and at_hot.agg(F.max("RunningMax")).first()[0] == 976
    assert got.where(f"t > {hot} and RunningMax != 976").count() == 0
    got.unpersist()


def test_repeated_keys_fail(spark):
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert assert_unique(lookup, ["k"], "title").count() == 2
    twice = lookup.unionByName(lookup.limit(1))
    with pytest.raises(Exception, match="repeated title: 1"):
        assert_unique(twice, ["k"], "title").collect()


def test_to_long_keeps_missing_values(spark):
    frame = spark.createDataFrame([("d", 4, None), ("e", 1, 2)], "id string, A int, B int")
    assert sorted(rows_of(to_long(frame, ["id"], ["A", "B"])), key=str) == [
        ("d", "A", 4),
        ("d", "B", None),
        ("e", "A", 1),
        ("e", "B", 2),
    ]


def test_sample_rows(spark):
    assert sample_rows(spark.range(1000), 500).count() == 500
    assert sample_rows(spark.range(3), 500).count() == 3
