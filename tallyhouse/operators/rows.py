"""Row operators: keep the latest row, next value and number in a group, unique-key guard, sides of joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize

def keep_latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest `order` per key; ties fall to the greatest full row.

    Spark keeps one row per key in every map task before it shuffles, so a key
    that holds most of the table costs no more than any other.
    """
    ties = [F.col(c).desc() for c in df.columns if c not in (*keys, order)]
    latest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc(), *ties)
    numbered = df.withColumn("_nth", F.row_number().over(latest_first))
    return numbered.filter("_nth = 1").drop("_nth")


def pieces(df: DataFrame, keys: list[str], order: list[str], name: str = "_piece") -> DataFrame:
    """Deal `df` into ranges of (keys, order) and add `name`, the struct of the keys and the range.

    A key with many rows lies in many pieces, each no larger than a task, and the
    pieces of a key follow each other in `order`. Rows that tie in it are spread by a
    hash of the rest. The result is written once, as its ranges must not change
    between readers. The keys are in a struct, as they may be NULL and still match.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    tie = F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")
    ranged = df.withColumn("_tie", tie).repartitionByRange(*keys, *order, "_tie")
    dealt = ranged.withColumn(name, F.struct(*keys, F.spark_partition_id().alias("_range")))
    return materialize(dealt)


def next_in_group(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Add `name`: the `order` value of the following row of the same key.

    A key may hold any share of the rows, so no window ever spans a whole key. Rows
    are windowed within a piece, and only the first `order` value of each piece is
    put in sequence per key: as many rows as the key has pieces, however many
    distinct values it has. The two meet on the partitioning of the first window.
    """
    dealt = pieces(df, keys, [order])
    rest = [c for c in df.columns if c not in (*keys, order)]
    inside = Window.partitionBy("_piece").orderBy(order, "_tie", *rest)
    marked = dealt.withColumns({"_near": F.lead(order).over(inside), "_more": F.lead(F.lit(True)).over(inside)})

    along = Window.partitionBy(*[f"_piece.{k}" for k in keys]).orderBy("_piece._range")
    firsts = dealt.groupBy("_piece").agg(
        F.min(order).alias("_first"), F.count_if(F.col(order).isNull()).alias("_nulls")
    )
    # NULL sorts first, so a piece that holds one starts with it
    firsts = firsts.withColumn("_first", F.when(F.col("_nulls") == 0, F.col("_first")))
    carried = firsts.select("_piece", F.lead("_first").over(along).alias("_far"))

    following = F.when(F.col("_more"), F.col("_near")).otherwise(F.col("_far")).alias(name)
    return marked.join(carried, "_piece", "left").select(*df.columns, following)


def number_in_group(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add `name`: 1, 2, … along `order` (NULL first) among the rows of a key.

    Most keys have one row: only rows whose key hash comes twice are dealt into pieces,
    numbered inside each and moved on by the rows of the pieces before it. Hashes alone
    are shuffled to find these; a key that shares its hash with another gets its 1 there.
    `df` is read three times.
    """
    held, repeated = with_repeated_hashes(df, keys)
    alone = held.join(repeated, "_key", "left_anti").select(*df.columns, F.lit(1).cast("int").alias(name))
    dealt = pieces(held.join(repeated, "_key", "left_semi").select(*df.columns), keys, order)
    inside = Window.partitionBy("_piece").orderBy(*order, "_tie")
    before = Window.partitionBy(*[f"_piece.{k}" for k in keys]).orderBy("_piece._range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = dealt.groupBy("_piece").agg(F.count("*").alias("_rows")).select(
        "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    numbered = dealt.withColumn("_nth", F.row_number().over(inside)).join(starts, "_piece")
    number = (F.col("_start") + F.col("_nth")).cast("int").alias(name)
    return alone.unionByName(numbered.select(*df.columns, number))


def with_repeated_hashes(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """df with `_key`, the hash of the keys, and the table of hashes that more than one row has.

    The table is written, so the joins with it know its size before rows are shuffled.
    """
    held = df.withColumn("_key", F.xxhash64(*keys))
    counts = held.groupBy("_key").agg(F.count("*").alias("_rows"))
    return held, materialize(counts.where("_rows > 1").select("_key"))


def check_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Fail on a repeated key or a NULL in it, as `require_unique` does, for rows that need no join by keys.

    Only hashes are shuffled; rows whose hash comes twice are then told apart.
    """
    held, repeated = with_repeated_hashes(df.select(*keys), keys)
    twice = held.join(repeated, "_key", "left_semi").groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    null_key: Column = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    found = twice.select(*keys).unionByName(df.select(*keys).where(null_key)).first()
    if found is not None:
        key = ", ".join("NULL" if value is None else str(value) for value in found)
        raise ValueError(f"{what}: repeated or missing key ({key})")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Pass rows through, failing the job on a repeated key or a NULL in it.

    The check rides on a partitioning and order by `keys`, which the join that
    follows needs anyway, and holds one row at a time.
    """
    by_key = Window.partitionBy(*keys).orderBy(*keys)
    null_key: Column = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    broken = (F.col("_nth") > 1) | null_key
    message = F.concat(
        F.lit(f"{what}: repeated or missing key ("),
        F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]),
        F.lit(")"),
    )
    checked = df.withColumn("_nth", F.row_number().over(by_key)).withColumn(
        "_ok", F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )
    return checked.filter("_ok").drop("_nth", "_ok")


def join_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """`df` as a side of a join that Spark broadcasts only where its rows fit Spark's own limit.

    Spark goes by the size of the files, and files that pack well hold many times that: the driver would
    build a table of millions of rows from a few MB. `rows` is how many `df` has, or a bound; without it they
    are counted, which takes the footers alone for columns of a table. Larger sides are shuffled.
    """
    limit = _broadcast_limit(df.sparkSession)
    if limit < 0:
        return df
    known = df.count() if rows is None else rows
    return df.hint("merge") if known * _row_bytes(df.schema) > limit else df


def _broadcast_limit(spark: SparkSession) -> int:
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def _row_bytes(schema: T.StructType) -> int:
    """What Spark's binary row takes: a word for the NULLs, one a column, three more for a text or the like."""
    words = [1 if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)) else 4 for f in schema.fields]
    return 8 * (1 + sum(words))
