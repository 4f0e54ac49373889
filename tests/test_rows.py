import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators.keys import assign_keys
from tallyhouse.operators.rows import (
    check_unique,
    join_side,
    keep_latest,
    next_in_group,
    number_in_group,
    pieces,
    require_unique,
)


def hot_rows(count, seed, distinct_days=9):
    """Rows of which one key holds more than a third, with ties, NULLs and copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        key = "hot" if rng.random() < 0.4 else rng.choice([None, *"abcdefgh"])
        day = rng.choice([None] + [dt.date(2020, 1, d + 1) for d in range(distinct_days)])
        rows.append((key, day, rng.randrange(count // 2)))
    return rows + rows[: count // 10]


def test_keep_latest_one_row_per_key(spark):
    rows = [r for r in hot_rows(400, 1) if r[0]]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(7)
    best = {}
    for r in rows:
        rank = (r[1] is not None, r[1] or dt.date.min, r[2])
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = (rank, r)
    got = {r.k: tuple(r) for r in keep_latest(df, ["k"], "d").collect()}
    assert got == {k: r for k, (_, r) in best.items()}


def test_latest_row_is_picked_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS d", "id AS v")
    plan = keep_latest(df, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("seed", range(3))
def test_next_in_group_matches_a_plain_window(spark, seed):
    rows = hot_rows(600, seed)
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(5)
    got = Counter(tuple(r)[:2] + (r.n,) for r in next_in_group(df, ["k"], "d", "n").collect())

    groups = defaultdict(list)
    for k, d, _ in rows:
        groups[k].append(d)
    want = Counter()
    for k, days in groups.items():
        days.sort(key=lambda d: (d is not None, d or dt.date.min))
        want.update((k, d, n) for d, n in zip(days, days[1:] + [None]))
    assert got == want


def test_a_key_of_a_million_dates_is_dealt_into_even_pieces(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = F.col("id")
        days = spark.range(1_000_000).select(
            F.when(n % 10 == 0, F.concat(F.lit("k"), n % 1000)).otherwise("hot").alias("k"), (n * 7 % 1_000_003).alias("d")
        )
        sizes = sorted(r["count"] for r in pieces(days, ["k"], ["d"]).groupBy("_piece._range").count().collect())
        assert len(sizes) == 3 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        found = next_in_group(days, ["k"], "d", "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    plain = days.withColumn("n", F.lead("d").over(Window.partitionBy("k").orderBy("d")))
    assert found.exceptAll(plain).isEmpty() and found.count() == 1_000_000


def test_the_window_over_the_bare_key_sees_one_row_a_piece(spark):
    df = spark.createDataFrame([("a", 1, 1)], "k string, d int, v int")
    plan = next_in_group(df, ["k"], "d", "n")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [lead" in line]
    assert len(windows) == 2 and "Aggregate" in plan


@pytest.mark.parametrize("seed", range(2))
def test_number_in_group_matches_sorting(spark, seed):
    rows = hot_rows(600, seed) + [("once", None, 1), (None, dt.date(2021, 1, 1), 5)]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(5)
    got = number_in_group(df, ["k"], ["d", "v"], "nth")
    assert got.columns == ["k", "d", "v", "nth"]
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    want = Counter()
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1] or dt.date.min, r[2]))
        want.update((*row, nth) for nth, row in enumerate(group, 1))
    assert Counter(map(tuple, got.collect())) == want


def test_rows_of_single_keys_are_numbered_without_a_shuffle_of_rows(spark):
    df = spark.range(1000).select((F.col("id") % 990).alias("k"), F.col("id").alias("v"))
    numbered = number_in_group(df, ["k"], ["v"], "nth")
    assert numbered.where("nth = 2").count() == 10
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin [_key" not in plan


def test_check_unique(spark):
    kind = "a string, b string"
    check_unique(spark.createDataFrame([("x", "y"), ("y", "x"), ("x", "x")], kind), ["a", "b"], "test")
    for rows in ([("x", "y"), ("x", "y")], [("x", None), ("y", "z")], [(None, "x")]):
        with pytest.raises(ValueError, match="test: repeated or missing key"):
            check_unique(spark.createDataFrame(rows, kind), ["a", "b"], "test")


def test_require_unique(spark):
    good = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    assert require_unique(good, ["k"], "test").count() == 2
    for rows in ([(1, "a"), (1, "b")], [(None, "a")]):
        bad = spark.createDataFrame(rows, "k int, v string")
        with pytest.raises(Exception, match="test: repeated or missing key"):
            require_unique(bad, ["k"], "test").collect()


def test_keys_are_dense_unique_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("k"))
    first = {r.k: r.key for r in assign_keys(df.repartition(3), "key", ["k"], 10).collect()}
    again = {r.k: r.key for r in assign_keys(df.repartition(11), "key", ["k"], 10).collect()}
    assert sorted(first.values()) == list(range(11, 5011))
    assert first == again
    assert assign_keys(df.limit(0), "key", ["k"], 10).count() == 0


def test_a_side_that_packs_well_is_broadcast_by_its_rows_only(spark, tmp_path):
    """800,000 rows in files far below Spark's limit are shuffled; a few rows may be broadcast."""
    spark.range(800_000).selectExpr("id", "'x' AS v").write.option("compression", "zstd").parquet(str(tmp_path / "many"))
    spark.range(10).selectExpr("id", "'x' AS v").write.parquet(str(tmp_path / "few"))
    many, few = spark.read.parquet(str(tmp_path / "many")), spark.read.parquet(str(tmp_path / "few"))
    left = spark.range(1000)

    def joins(right, how="left"):
        return left.join(right, "id", how)._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in joins(many)  # what Spark does with it
    assert "BroadcastHashJoin" not in joins(join_side(many)) and "SortMergeJoin" in joins(join_side(many))
    assert "BroadcastHashJoin" not in joins(join_side(many.select("id")).where("id > 5"), "left_anti")
    assert "BroadcastHashJoin" in joins(join_side(few)) and "BroadcastHashJoin" in joins(join_side(many, rows=10))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        assert "BroadcastHashJoin" in joins(join_side(many))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
