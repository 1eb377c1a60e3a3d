"""Ranks, totals and ids against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import rows
from voltdrift.operators import sequence as seq

N = 900


@pytest.fixture(scope="module")
def data():
    """Rows (key, time, id, value); one key holds a third, times repeat and lack."""
    r = random.Random(7)
    out = []
    for i in range(N):
        key = "hot" if i % 3 == 0 else f"k{r.randrange(60)}"
        out.append((key, r.choice([None, *range(20)]), i, r.randrange(-5, 50)))
    r.shuffle(out)
    return out


@pytest.fixture
def frame(spark, data):
    return spark.createDataFrame(data, "key string, t int, id int, v long").repartition(5)


def brute_force(data):
    by_key = {}
    for row in sorted(data, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2])):
        by_key.setdefault(row[0], []).append(row)
    expected = {}
    for group in by_key.values():
        total = 0
        for n, row in enumerate(group, start=1):
            total += row[3]
            expected[row[2]] = (n, total)
    return expected


# coarse, fine, and one bucket for all
BUCKETS = {
    "late": "struct(t IS NULL AS late, floor(t / 5) AS part)",
    "each": "struct(t IS NULL AS late, t AS part)",
    "one": "0",
}


@pytest.mark.parametrize("bucket", list(BUCKETS))
def test_rank_matches_brute_force(frame, data, bucket):
    ranked = seq.with_rank(frame, "key", ["t", "id"], "rn", F.expr(BUCKETS[bucket]))
    expected = {i: n for i, (n, _) in brute_force(data).items()}
    assert dict(rows(ranked, "id", "rn")) == expected
    assert ranked.columns == [*frame.columns, "rn"] and ranked.count() == N


@pytest.mark.parametrize("bucket", list(BUCKETS))
def test_running_total_matches_brute_force(frame, data, bucket):
    totals = seq.with_running_total(frame, "key", ["t", "id"], "v", "sum", "n", F.expr(BUCKETS[bucket]))
    assert {i: (n, s) for i, n, s in rows(totals, "id", "n", "sum")} == brute_force(data)


@pytest.mark.parametrize("width", [100, 3, 1])
def test_running_total_skips_missing_values(spark, width):
    values = [None, None, 2, None, None, None, None, 5, None]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "key string, id int, v long")
    totals = seq.with_running_total(df, "key", ["id"], "v", "sum", "n", F.floor(F.col("id") / width))
    found = [r[1] for r in sorted(rows(totals, "id", "sum"), key=lambda r: r[0])]
    assert found == [None, None, 2, 2, 2, 2, 2, 7, 7]


def test_missing_key_keeps_its_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 2)], "key string, id int")
    ranked = seq.with_rank(df, "key", ["id"], "rn", F.col("id"))
    assert sorted(rows(ranked, "id", "rn")) == [(1, 1), (1, 1), (2, 2), (2, 2)]


def test_time_buckets_rise_with_the_order(spark):
    df = spark.sql(
        """SELECT id, if(id % 5 = 0, NULL, timestamp_ntz'2018-01-15 08:00:00' + make_interval(0, 0, 0, 0, 0, id * 7 % 600)) AS t
        FROM range(900)"""
    )
    found = df.select("id", "t", seq.time_buckets("t", "id", ids=50).alias("b")).collect()
    in_order = [r.b for r in sorted(found, key=lambda r: (r.t is None, r.t or 0, r.id))]
    ranks = [(b.late, b.part) for b in in_order]
    assert ranks == sorted(ranks) and len(set(ranks)) > 20


def test_crowded_key_is_spread(spark, tmp_path):
    """A third of a million rows in one key, some of it without a time, and as many without a key."""
    df = spark.sql(
        """SELECT id, CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE string(id % 5000) END AS key,
            if(id % 10 = 0, NULL, timestamp_ntz'2018-01-15 08:00:00' + make_interval(0, 0, 0, 0, 0, id % 50000)) AS t
        FROM range(1000000)"""
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = seq.with_rank(df, "key", ["t", "id"], "rn", seq.time_buckets("t", "id"))
        assert ranked.rdd.getNumPartitions() > 1
        tasks = ranked.withColumn("task", F.spark_partition_id()).groupBy("key", "task").count()
        most = {r[0]: r[1] for r in rows(tasks.groupBy("key").agg(F.max("count")))}
        assert most["hot"] < 1_000_000 / 3 / 8 and most[None] < 1_000_000 / 3 / 8
        plain = df.where("key = 'hot'").selectExpr("id", "row_number() OVER (ORDER BY t NULLS LAST, id) AS rn")
        assert ranked.where("key = 'hot'").select("id", "rn").exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("after", [0, 41])
def test_ids_are_dense_and_follow_the_order(frame, data, after, tmp_path):
    numbered = rows(seq.number_rows(frame, "n", ["key", "id"], str(tmp_path), after), "key", "id", "n")
    in_order = sorted(numbered, key=lambda r: (r[0], r[1]))
    assert [r[2] for r in in_order] == list(range(after + 1, after + 1 + N))


def test_ids_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "key string, id int")
    assert seq.number_rows(empty, "n", ["key"], str(tmp_path)).count() == 0


def test_first_per_key(frame, data):
    first = seq.first_per_key(frame, ["key"], ["t", "id"], 2)
    expected = {(i, n) for i, (n, _) in brute_force(data).items() if n <= 2}
    assert set(rows(first, "id", "rn")) == expected


def test_buckets(spark):
    ranks = spark.range(1, 8).select(seq.bucket_of(F.col("id"), 3).alias("b"))
    assert [r[0] for r in rows(ranks)] == [0, 0, 0, 1, 1, 1, 2]
    assert ranks.schema["b"].dataType.simpleString() == "bigint"
