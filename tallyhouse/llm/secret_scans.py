"""Secret scans with corpus-wide ownership frequency (operator 1).

Fixed patterns find assigned secrets, access keys and hex runs. Wider candidates
(long mixed tokens) only count as secrets when the corpus says they belong to
someone: every value's hash is aggregated by distinct repositories and owners, and
a value that `copied_from` owners or `copied_in` repositories hold is an example
that went around, while any other is a live-looking credential. Equal texts are one
repository, or copies of a document would make its own secrets examples. The text
is read once and in place; only hashes and offsets of candidates are shuffled,
summed by (value, owner, text) first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.quality_rules import let
from tallyhouse.sources.scratch import materialize

# Kind, pattern, group that holds the value, least length of that group.
KINDS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
#: Long tokens; whether they look like a credential is asked of the parts below.
WIDE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ADDED = "owned"
LEAST_DISTINCT = 10
#: Owners from which on a value counts as an example that was copied around.
COPIED_FROM = 3
#: Repositories from which on it does, whoever owns them.
COPIED_IN = 5
BLOCK = 256


def running_sums(values: Column) -> Column:
    """Inclusive running sums, in blocks so that long arrays stay cheap."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def with_values(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")

        def with_blocks(blocks: Column) -> Column:
            before = F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b)))
            return let(
                before,
                lambda s: F.transform(
                    v,
                    lambda _, i: F.get(s, F.floor(i / BLOCK).cast("int"))
                    + total(F.slice(v, (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), (i % BLOCK + 1).cast("int"))),
                ),
            )

        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: total(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        return let(blocks, with_blocks)

    return let(values, with_values)


def located(text: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    """Matches of a pattern as structs by position; those with a short value are dropped.

    The pieces between the matches and the matches themselves add up to the offsets.
    """
    # a run of one class is as long as its longest match: shorter ones need no row
    shape = pattern[:-1] + "{%d,}" % least if kind == "hex" else pattern

    def spans(whole: Column) -> Column:
        pieces = F.split(text, shape, -1)
        steps = F.zip_with(
            F.slice(pieces, F.lit(1), F.size(whole)), whole, lambda a, b: (F.length(a) + F.length(b)).cast("long")
        )
        values = F.regexp_extract_all(text, F.lit(shape), F.lit(group)) if group else whole
        rows = F.zip_with(
            F.arrays_zip(whole.alias("m"), values.alias("v")),
            running_sums(steps),
            lambda x, end: F.struct(
                (end - F.length(x["m"])).alias("start"),
                F.lit(order).alias("order"),
                end.alias("end"),
                F.lit(kind).alias("kind"),
                x["v"].alias("value"),
            ),
        )
        return F.filter(rows, lambda r: F.length(r["value"]) >= least)

    found = F.regexp_extract_all(text, F.lit(shape), F.lit(0))
    kind_of = "array<struct<start:bigint,order:int,end:bigint,kind:string,value:string>>"
    return F.when(text.rlike(shape), let(found, spans).cast(kind_of)).otherwise(F.array().cast(kind_of))


def credential_like(value: Column) -> Column:
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT)
    )


def marks_before(points: Column, marks: Column, touching: bool) -> Column:
    """For each of the rising `points`, how many `marks` lie below it, or on it where `touching`.

    Both are sorted as one array; a point's place there, less the points before it, is the count.
    """
    point = 1 if touching else 0
    events = F.sort_array(
        F.concat(
            F.transform(marks, lambda m: F.struct(m.alias("at"), F.lit(1 - point).alias("sort"))),
            F.transform(points, lambda p: F.struct(p.alias("at"), F.lit(point).alias("sort"))),
        )
    )
    places = F.filter(F.transform(events, lambda e, i: F.when(e["sort"] == point, i)), lambda i: i.isNotNull())
    return F.transform(places, lambda i, earlier: i - earlier)


def outside_of(spans: Column, others: Column) -> Column:
    """Of rising spans that overlap none of their own, those that overlap none of the others.

    As many of the others have ended where such a span starts as have started before it ends.
    """
    started = marks_before(F.transform(spans, lambda s: s["end"]), F.transform(others, lambda b: b["start"]), False)
    ended = marks_before(F.transform(spans, lambda s: s["start"]), F.transform(others, lambda b: b["end"]), True)
    free = let(
        F.struct(started.alias("started"), ended.alias("ended")),
        lambda n: F.filter(spans, lambda _, i: F.get(n["started"], i) == F.get(n["ended"], i)),
    )
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(free)


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    texts = F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(texts, ",")


def secret_scan(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    copied_from: int = COPIED_FROM,
    copied_in: int = COPIED_IN,
) -> DataFrame:
    """One row per row of docs: doc_id, `base` and `added` spans, copied and live counts.

    Spans are structs (start, order, end, kind, hash) in code points, end exclusive;
    values leave as SHA-256 only. `base` holds leftmost matches of the fixed
    patterns, none overlapping another of its kind. `added` holds credential-like
    tokens outside all base spans whose value fewer than `copied_from` owners and
    fewer than `copied_in` repositories have, where a repository counts by the
    distinct texts it adds: the lesser of distinct repositories and distinct texts.
    `n_copied` and `n_live` count the values of a row by that rule, base spans
    included. NULL text is empty; NULL owners and repositories count as one each;
    equal rows get equal results; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(*[located(text, kind, k, p, g, n) for k, (kind, p, g, n) in enumerate(KINDS)])
    wide = located(text, ADDED, len(KINDS), WIDE, 0, 20)
    read = docs.select(
        "doc_id",
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        F.xxhash64(text).alias("text_hash"),
        base.alias("base"),
        wide.alias("wide"),
    )

    def hashed(spans: str) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(s["start"], s["order"], s["end"], s["kind"], F.sha2(s["value"], 256).alias("hash")),
        )

    outside = outside_of(F.filter("wide", lambda w: credential_like(w["value"])), F.col("base"))
    found = materialize(
        read.withColumn("wide", outside).withColumns({"base": hashed("base"), "wide": hashed("wide")})
    )
    each = found.where("size(base) + size(wide) > 0").select(
        "doc_id", "owner", "repository", "text_hash", F.explode(F.concat("base", "wide")).alias("span")
    )
    held = F.col("span.hash").alias("hash")

    def holders(column: str, name: str) -> DataFrame:
        return each.select(held, column).distinct().groupBy("hash").agg(F.count("*").alias(name))

    # copies of a text do not make a value widely copied, nor do many texts of one repository
    owned = holders("owner", "owners").join(holders("repository", "in_repositories"), "hash").join(
        holders("text_hash", "in_texts"), "hash"
    ).withColumn("repositories", F.least("in_repositories", "in_texts"))
    judged = (
        each.withColumn("hash", F.col("span.hash"))
        .join(owned, "hash")
        .withColumn("live", (F.col("owners") < copied_from) & (F.col("repositories") < copied_in))
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set(F.when(F.col("live") & (F.col("span.kind") == ADDED), F.col("span"))).alias("added"),
            F.count_if("live").alias("lives"),
            F.count("*").alias("all"),
            F.count_distinct("span").alias("once"),
        )
        .select(
            F.col("doc_id").alias("_id"),
            F.col("text_hash").alias("_hash"),
            "added",
            # equal rows share a group: each has its part of the counts
            (F.col("lives") * F.col("once") / F.col("all")).cast("long").alias("n_live"),
            F.col("once").alias("_spans"),
        )
    )
    out = found.join(judged, found["doc_id"].eqNullSafe(judged["_id"]) & (found["text_hash"] == judged["_hash"]), "left")
    none = F.array().cast(found.schema["base"].dataType)
    return out.select(
        found["doc_id"],
        "base",
        F.coalesce("added", none).alias("added"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        (F.coalesce("_spans", F.lit(0)) - F.coalesce("n_live", F.lit(0))).alias("n_copied"),
    )


def op1_secret_scans(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    scanned = secret_scan(docs)

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        *[number(kind) for kind, *_ in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        "n_live",
        "n_copied",
    )
