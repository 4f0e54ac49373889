"""Quality rules: hashed n-gram log-likelihood ratio beside plain text rules (operator 10).

Word unigrams and bigrams are hashed into `buckets` cells. Two multinomials over
the cells are counted, one from trusted documents and one from all documents; a
document's score is the mean log ratio of its n-grams, so length does not count.
All columns are built-in functions. With `distinct_texts`, as the query and the
pipeline ask for, equal texts count once in both multinomials, so copies do not
move the ratios: texts are shuffled once for that, copies of one task as one row.
What leaves the counting tasks is one row per cell, summed before the shuffle; the
ratios come back as one array of `buckets` numbers. The cells grow with the
documents, up to an array of 2 MB. Where rejected documents are named too, the
threshold is set between the scores of labelled documents that the target
multinomial has not seen; else it is fixed. All labelled documents count, in the one
or in the other: ids meet hashes of the texts, so texts never travel for a label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.sources.scratch import materialize

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Cells of the hashed multinomials, which are the length of the broadcast array: the
#: least power of two from a quarter of the documents on, within these bounds.
LEAST_BUCKETS, MOST_BUCKETS = 1 << 14, 1 << 18
SEED = 20
#: One in so many of the trusted is left out of the target multinomial and sets the threshold.
HELD_PART = 5
#: Bits of the filter, of fixed size, that spares most unlabelled documents a score; ids decide after it.
FILTER_BITS = 1 << 23
#: What the share of trusted documents lost weighs against the share of rejected ones kept.
LOSS_WEIGHT = 10
#: Mean log ratio (natural, per n-gram) below which a document is rejected where labels set no threshold.
THRESHOLD = -0.08
WINDOW = 8


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def made_once(df: DataFrame, name: str) -> DataFrame:
    """df with the column `name` behind a generator: the optimizer does not copy what makes it into filters on it."""
    return df.withColumn(name, F.explode(F.array(name)))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def ngram_cells(words: Column, buckets: int) -> Column:
    """Cells of all word unigrams and bigrams."""
    return let(hashes_of(words), lambda h: hashed_cells(h, buckets))


def hashed_cells(h: Column, buckets: int) -> Column:
    """The same from the hashes of the words."""
    n = F.size(h)
    pairs = F.zip_with(
        F.slice(h, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(h, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"),
    )
    return F.concat(F.transform(h, lambda a: F.pmod(a, F.lit(buckets)).cast("int")), pairs)


def repeated_words(h: Column, window: int = WINDOW) -> Column:
    """Words inside windows of `window` words that a text holds twice or more, from the hashes of the words."""

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window))).cast("long")
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def twice(pairs: Column) -> Column:
        same = F.filter(
            pairs,
            lambda p, j: F.coalesce(F.get(pairs, j - 1)["h"] == p["h"], F.lit(False))
            | F.coalesce(F.get(pairs, j + 1)["h"] == p["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(same, lambda p: p["at"])), covered)

    def count(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(
            let(pairs, twice)
        )

    starts = F.sequence(F.lit(1), F.size(h) - (window - 1))
    return F.when(F.size(h) < window, F.lit(0).cast("long")).otherwise(
        let(F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, window))), count)
    )


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(filled, lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def cells_for(documents: int) -> int:
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, 1 << (max(documents - 1, 0) // 4).bit_length()))


def text_key(text: Column) -> Column:
    """16 bytes that name a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def known_ids(ids: DataFrame) -> DataFrame:
    return ids.where("doc_id IS NOT NULL").select("doc_id").distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int, distinct_texts: bool = False) -> DataFrame:
    """One row, one array: the log ratio of trusted to raw frequency of each cell."""
    chosen = known_ids(trusted)
    if distinct_texts:
        keyed = docs.withColumn("key", text_key(F.col("text")))
        # trusted where one of its copies is; the join rides on the shuffle of the texts
        marks = keyed.select("doc_id", "key").join(chosen, "doc_id").groupBy("key").agg(F.lit(1).alias("trusted"))
        marked = keyed.groupBy("key").agg(F.first("text").alias("text")).join(marks, "key", "left")
    else:
        marked = docs.join(chosen.withColumn("trusted", F.lit(1)), "doc_id", "left")
    cells = marked.select("trusted", F.explode(ngram_cells(words_of(F.col("text")), buckets)).alias("cell"))
    counts = cells.groupBy("cell").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    spark = docs.sparkSession
    full = spark.range(buckets).select(F.col("id").cast("int").alias("cell")).join(counts, "cell", "left")
    full = full.select("cell", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    # one row per cell: a bounded list
    rows = full.agg(
        F.sort_array(F.collect_list(F.struct("cell", "raw", "target"))).alias("cells"),
        F.sum("raw").alias("raws"),
        F.sum("target").alias("targets"),
    )
    ratio = F.transform(
        "cells",
        lambda c: F.log((c["target"] + 1) / (F.col("targets") + buckets)) - F.log((c["raw"] + 1) / (F.col("raws") + buckets)),
    )
    none = F.transform("cells", lambda c: F.lit(0.0))
    return rows.select(F.when(F.col("targets") > 0, ratio).otherwise(none).alias("ratios"))


def perhaps_among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id may be in `ids`: all that are, and some that are not."""

    def bit(doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED + 2), doc_id), F.lit(FILTER_BITS))

    bits = ids.select(bit(F.col("doc_id").cast("string")).alias("bit"))
    one = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    full = docs.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("word")).join(words, "word", "left")
    # one row per 64 bits: a list of fixed length
    listed = full.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("all"))
    packed = listed.select(F.col("all.bits").alias("bits"))
    found = let(
        bit(F.col("doc_id").cast("string")),
        lambda b: F.call_function(
            "getbit", F.get("_bits", F.shiftright(b, 6).cast("int")), b.bitwiseAND(F.lit(63)).cast("int")
        ),
    )
    return docs.withColumn("_bits", packed.scalar()).where(found == 1).drop("_bits")


def mean_ratio(h: Column, buckets: int) -> Column:
    """The mean ratio of the n-grams of a text, from the hashes of its words and `_ratios`; 0 without words."""
    return let(
        hashed_cells(h, buckets),
        lambda c: F.when(F.size(c) == 0, F.lit(0.0)).otherwise(
            F.aggregate(c, F.lit(0.0), lambda acc, f: acc + F.get("_ratios", f)) / F.size(c)
        ),
    )


def with_ratio(docs: DataFrame, text: Column, ratios: DataFrame, buckets: int, name: str) -> DataFrame:
    """docs with the mean ratio of the n-grams of a text.

    `_ratios` is read in one place only, so the optimizer puts the array there; kept
    as a column, it would be copied for every row.
    """
    mean = let(hashes_of(words_of(text)), lambda h: mean_ratio(h, buckets))
    return docs.withColumn("_ratios", ratios.scalar()).withColumn(name, mean).drop("_ratios")


def word_rules(text: Column, *more) -> Column:
    """A struct of the rules on words, and of what functions in `more` make of the hashes of the words."""
    return let(
        words_of(text),
        lambda w: let(
            hashes_of(w),
            lambda h: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(h).alias("n_repeat_words"),
                *[made(h) for made in more],
            ),
        ),
    )


def fails_base(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def fitted_threshold(docs: DataFrame, ratios: DataFrame, buckets: int, held: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row, one number: the threshold between the scores of labelled documents.

    Documents of `held` (trusted, but not in the target multinomial) and of `rejected`
    that pass the plain rules, each distinct text once. Of the middles between
    neighbouring scores, the one where `LOSS_WEIGHT` times the share of trusted lost and
    the share of rejected kept add up to least, the lowest of equals. NULL where either
    kind is missing. Scores are dealt into ranges and counted there; a range starts
    where the counts of those before it end.
    """
    ids = known_ids(held).withColumn("good", F.lit(1)).unionByName(known_ids(rejected).withColumn("good", F.lit(0)))
    ids = ids.groupBy("doc_id").agg(F.min("good").alias("good"))
    near = perhaps_among(docs, ids)
    fit = made_once(near.withColumn("_rules", word_rules(F.col("text"))), "_rules").where(
        ~fails_base(F.col("_rules.n_words"), F.col("_rules.n_repeat_words"))
    )
    # scored where they lie: only ids, hashes and scores are written, and meet the labels
    scored = materialize(
        with_ratio(fit, F.col("text"), ratios, buckets, "score").select("doc_id", text_key(F.col("text")).alias("key"), "score")
    )
    texts = scored.join(ids, "doc_id").groupBy("key").agg(F.min("good").alias("good"), F.min("score").alias("score"))
    scores = texts.groupBy("score").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("poor"))
    # written, as ranges must not change between readers
    dealt = materialize(scores.repartitionByRange("score").withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # one row per range
    starts = (
        dealt.groupBy("_range")
        .agg(F.sum("good").alias("_good"), F.sum("poor").alias("_poor"), F.max("score").alias("_last"))
        .select(
            "_range",
            F.sum("_good").over(before).alias("_good"),
            F.sum("_poor").over(before).alias("_poor"),
            F.max("_last").over(before).alias("_last"),
            F.sum("_good").over(every).alias("goods"),
            F.sum("_poor").over(every).alias("poors"),
        )
    )
    up = Window.partitionBy("_range").orderBy("score")
    below = up.rowsBetween(Window.unboundedPreceding, -1)

    def share(start: str, count: str, total: str) -> Column:
        under = F.coalesce(start, F.lit(0)) + F.coalesce(F.sum(count).over(below), F.lit(0))
        return under / F.nullif(total, F.lit(0))

    ways = (
        dealt.join(F.broadcast(starts), "_range")
        .select(
            ((F.col("score") + F.coalesce(F.lag("score").over(up), F.col("_last"))) / 2).alias("middle"),
            share("_good", "good", "goods").alias("lost"),
            (F.lit(1) - share("_poor", "poor", "poors")).alias("kept"),
        )
        .where("middle IS NOT NULL AND lost IS NOT NULL AND kept IS NOT NULL")
    )
    return ways.agg(F.min(F.struct((LOSS_WEIGHT * F.col("lost") + F.col("kept")).alias("loss"), "middle"))["middle"].alias("threshold"))


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int | None = None,
    threshold: float | None = None,
    distinct_texts: bool = False,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """docs with the rule columns, the log ratio `llr` and the verdict `kept`.

    `trusted` lists doc_id values of trusted documents; where none of them is in
    docs, every ratio is 0 and the plain rules decide alone. NULL and empty texts
    have no words: `base_failed`. Equal texts get equal verdicts, repeated rows stay
    repeated, other columns pass through (the added names replace equal ones), and
    an empty table gives no rows. `base_failed`: under 20 words, or over 30 percent
    of the words inside 8-word windows that repeat within the text. `distinct_texts`
    counts equal texts once in the ratios, trusted where one of the copies is; without
    it every row counts, and a text with very many copies scores low for them.

    `buckets` follow the number of documents where none are given (`cells_for`). A
    document is kept from `threshold` on. Where that is None, `rejected` lists
    doc_id values of poor documents: a fifth of the trusted is then left out of the
    target multinomial, and all of it and of the rejected set the threshold. Without them nothing is left out and the threshold is `THRESHOLD`, as it
    is where one kind has no document that passes the plain rules.
    """
    docs, back = set_aside(docs.drop(*RULE_COLUMNS), ["_ratios", "_rules"])
    read = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = buckets or cells_for(docs.count())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    if threshold is None and rejected is not None and not rejected.where("doc_id IS NOT NULL").isEmpty():
        own = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(HELD_PART)) == 0
        ratios = materialize(log_ratios(read, trusted.where(~own), buckets, distinct_texts))
        least = F.coalesce(
            fitted_threshold(read, ratios, buckets, trusted.where(own), rejected).scalar(), F.lit(THRESHOLD)
        )
    else:
        ratios = log_ratios(read, trusted, buckets, distinct_texts)
        least = F.lit(THRESHOLD if threshold is None else threshold)
    # split and hashed once for the rules and the ratio; `_ratios` as in `with_ratio`
    rules = word_rules(text, lambda h: mean_ratio(h, buckets).alias("llr"))
    out = made_once(docs.withColumn("_ratios", ratios.scalar()).withColumn("_rules", rules).drop("_ratios"), "_rules").withColumns(
        {
            "llr": F.col("_rules.llr"),
            "n_words": F.col("_rules.n_words"),
            "word_chars": F.col("_rules.word_chars"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": repeated_lines(text),
            "n_repeat_words": F.col("_rules.n_repeat_words"),
        }
    )
    out = out.withColumn("base_failed", fails_base(F.col("n_words"), F.col("n_repeat_words")))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= least))
    return out.select(*back, *RULE_COLUMNS)


def trusted_ids(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")


def rejected_ids(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0").select("doc_id")


RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"]


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = quality_rules(docs, trusted_ids(spark, sf_dir), distinct_texts=True, rejected=rejected_ids(spark, sf_dir))
    return judged.select("doc_id", *RULE_COLUMNS)
