"""Mixing sources to target weights by capped water-filling (operator 2).

Targets come from one row per source: the level that fills all sources in
proportion to their weights, each up to its cap, is found over the running sums of
the caps. A source is then repeated whole times and once more in part: documents
are taken in the order of a seeded hash until the rest of the target is reached.
The place where that order stops is found from sums over buckets of the hash, so
no source is sorted as a whole: one bucket of each is, and a table of N rows has
about sqrt(N) buckets of sqrt(N) rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.quality_rules import words_of
from tallyhouse.sources.scratch import materialize

#: Weights of the sources in order, repeating; total as a part of all sizes; most repetitions.
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
SEED = 2
ADDED = ["size", "source_size", "target", "copies", "taken"]
INNER = ["_u", "_bucket", "_upto", "_more", "_source", "whole", "part", "stop", "begun"]


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """sources (source, source_size) with weight and target.

    The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("weight", F.get(listed, F.pmod(place, F.lit(len(weights))))).withColumn(
        "cap", F.lit(float(most)) * F.col("source_size")
    )
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    onward = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy(F.lit(1))
    total = F.lit(float(share)) * F.sum("source_size").over(everyone)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = ranked.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    water = F.max(F.when(~F.col("full"), F.col("level"))).over(everyone)
    return leveled.withColumn(
        "target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * water)
    ).select("source", "source_size", "weight", "target")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """docs (doc_id, source, text, ...) with size, source_size, target, copies and taken.

    `size` counts the words of the text (NULL: 0), `copies` how often the mix has the
    row, `taken` = copies * size. The words taken of a source differ from its target
    by at most half of one document's size. A NULL source is a source of its own,
    last in order. The draw depends on seed, id and text alone, so reruns agree;
    repeated rows are drawn one by one. Sources without words have target 0, and
    their rows and other rows without words are taken as their place in the draw
    says. Added names replace equal ones; an empty table gives no rows.
    """
    docs, back = set_aside(docs.drop(*ADDED), INNER)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    drawn = F.xxhash64(F.lit(seed), "doc_id", text)
    size = F.size(words_of(text)).cast("long")
    sized = materialize(docs.select(F.col("source").cast("string").alias("source"), size.alias("size"), drawn.alias("u")))
    buckets = max(16, math.isqrt(sized.count()))
    bucket = F.pmod(F.shiftright("u", 20), F.lit(buckets))
    summed = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    by_source = summed.groupBy("source").agg(F.sum("words").alias("source_size"))
    wanted = targets(by_source, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = wanted.withColumn("whole", F.floor(rate)).withColumn(
        "part", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))
    )
    order = Window.partitionBy("source").orderBy("bucket")
    running = summed.withColumn("upto", F.sum("words").over(order))
    joined = running.join(
        wanted.select(F.col("source").alias("_s"), "part"), F.col("source").eqNullSafe(F.col("_s"))
    )
    stops = (
        joined.where(F.col("upto") >= F.col("part"))
        .groupBy("source")
        .agg(F.min("bucket").alias("stop"), F.min_by(F.col("upto") - F.col("words"), "bucket").alias("begun"))
        .withColumnRenamed("source", "_t")
    )
    plan = materialize(
        wanted.join(stops, F.col("source").eqNullSafe(F.col("_t")), "left").select(
            F.col("source").alias("_source"), "source_size", "target", "whole", "part", "stop", "begun"
        )
    )
    rows = docs.withColumns({"size": size, "_u": drawn}).withColumn(
        "_bucket", F.pmod(F.shiftright("_u", 20), F.lit(buckets))
    )
    rows = rows.join(plan, F.col("source").cast("string").eqNullSafe(F.col("_source")))
    at_stop = Window.partitionBy("source").orderBy("_u", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = (
        rows.where(F.col("_bucket") == F.col("stop"))
        .withColumn("_upto", F.col("begun") + F.sum("size").over(at_stop))
        .withColumn("_more", (F.col("_upto") - F.col("size") / 2 <= F.col("part")) & (F.col("part") > 0))
        .drop("_upto")
    )
    outside = rows.where(F.coalesce(F.col("_bucket") != F.col("stop"), F.lit(True))).withColumn(
        "_more", F.coalesce((F.col("_bucket") < F.col("stop")) & (F.col("part") > 0), F.lit(False))
    )
    both = outside.unionByName(inside).withColumn("copies", F.col("whole") + F.col("_more").cast("long"))
    return both.withColumn("taken", F.col("copies") * F.col("size")).select(*back, *ADDED)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source")
