import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.scratch import materialize, scratch_dir
from tallyhouse.sources.snapshots import SnapshotTable

SCHEMA = T.StructType(
    [T.StructField("k", T.IntegerType()), T.StructField("y", T.IntegerType())]
)


def table(spark, folder, parted=True):
    part = F.col("y").cast("string") if parted else None
    return SnapshotTable(spark, str(folder), SCHEMA, part, parted)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def make(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def test_replace_append_rewrite(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.version() == 0 and rows(t.read()) == []
    assert t.replace(make(spark, (1, 2001), (2, 2002))) == {"2001": 1, "2002": 1}
    assert t.append(make(spark, (3, 2002))) == {"2002": 1}
    assert rows(t.read()) == [(1, 2001), (2, 2002), (3, 2002)]
    assert rows(t.read(["2001"])) == [(1, 2001)]
    # a part may be swapped out, and rows filed under another one
    t.rewrite(make(spark, (1, 2003), (9, 2002)), ["2001"])
    assert rows(t.read()) == [(1, 2003), (2, 2002), (3, 2002), (9, 2002)]
    assert t.version() == 3
    t.replace(make(spark))
    assert rows(t.read()) == [] and t.version() == 4


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    t = table(spark, tmp_path / "t", parted=False)
    t.replace(make(spark, (1, 1), (2, 2)))
    t.replace(t.read().filter("k = 2"))
    assert rows(t.read()) == [(2, 2)]


def test_failed_writes_show_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.replace(make(spark, (1, 2001)))
    broken = make(spark, (2, 2001), (3, 2002)).withColumn(
        "k", F.when(F.col("k") == 3, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("k"))
    )
    with pytest.raises(Exception, match="boom"):
        t.append(broken)

    def refuse(written):
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        t.replace(make(spark, (7, 2001)), refuse)
    assert rows(t.read()) == [(1, 2001)] and t.version() == 1


def test_readers_list_only_the_parts_they_ask_for(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.replace(make(spark, *[(i, 2000 + i % 5) for i in range(50)]))
    assert all("part=2003" in f for f in t.read(["2003"]).inputFiles())


def test_materialize_uses_the_shared_folder(spark):
    shared = scratch_dir(spark).rsplit("/", 1)[0]
    kept = materialize(make(spark, (1, 1)))
    assert rows(kept) == [(1, 1)]
    assert all(shared in f for f in kept.inputFiles())
