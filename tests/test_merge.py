import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import merge
from tallyhouse.operators.merge import insert_missing, merge_delta, upsert

COLUMNS = "k string, p int, amount int, note string, stamp int"
TARGET = [("a", 1, 10, "old", 1), ("a", 2, 20, "old", 1), ("b", 1, None, "old", 1), ("z", 9, 9, "old", 1)]
SOURCE = [
    ("a", 1, 10, "new", 2),  # only the note differs: stays as it is
    ("a", 2, 21, "new", 2),  # amount differs
    ("b", 1, 5, "new", 2),  # amount was missing
    ("c", 1, 7, "new", 2),  # new key
]
ARGS = (["k", "p"], ["amount"], ["amount", "note"])


def frames(spark):
    return spark.createDataFrame(TARGET, COLUMNS), spark.createDataFrame(SOURCE, COLUMNS)


def test_upsert(spark, tuples):
    merged = upsert(*frames(spark), *ARGS)
    assert tuples(merged) == [
        ("a", 1, 10, "old", 1, "keep"),
        ("a", 2, 21, "new", 1, "update"),
        ("b", 1, 5, "new", 1, "update"),
        ("c", 1, 7, "new", 2, "insert"),
        ("z", 9, 9, "old", 1, "keep"),
    ]


def test_a_second_merge_changes_nothing(spark):
    target, source = frames(spark)
    merged = upsert(target, source, *ARGS).drop(merge.ACTION)
    again = upsert(merged, source, *ARGS)
    assert {r[merge.ACTION] for r in again.collect()} == {"keep"}
    assert merge_delta(merged, source, *ARGS, {}).count() == 0


def test_delta_holds_only_what_moves(spark, tuples):
    target, source = frames(spark)
    delta = merge_delta(target, source, *ARGS, {"old_note": F.col("note")})
    assert tuples(delta.select("k", "p", "amount", "note", "stamp", "old_note", merge.ACTION)) == [
        ("a", 2, 21, "new", 1, "old", "update"),
        ("b", 1, 5, "new", 1, "old", "update"),
        ("c", 1, 7, "new", 2, None, "insert"),
    ]


def test_repeated_source_key_fails(spark):
    target, source = frames(spark)
    with pytest.raises(Exception, match="merge source: repeated or missing key"):
        upsert(target, source.unionByName(source), *ARGS).collect()


def test_insert_missing(spark, tuples):
    target, source = frames(spark)
    assert tuples(insert_missing(target, source, ["k", "p"]).select("k", "p", "note")) == [
        ("a", 1, "old"),
        ("a", 2, "old"),
        ("b", 1, "old"),
        ("c", 1, "new"),
        ("z", 9, "old"),
    ]
