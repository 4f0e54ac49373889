"""URL filters: allow and block rules, and link-graph propagation for the rest (operator 4).

Trust starts at hosts with allowed pages and follows links between hosts by
personalised PageRank; distrust starts at hosts with blocked pages and follows the
links backwards, to those who link there. A host whose distrust outweighs its trust
is blocked. Scores are whole numbers of a fixed-point unit, so sums do not depend
on their order. Pages are summed to hosts and host pairs before any shuffle, and a
host with very many links is split by Spark's skew handling of the joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import materialize

# Action, host, path of the rules that the registered query applies.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hosts in a page: what follows `//` up to the end of a link's host, and dotted names without a scheme.
LINKED = r"""//([^/?#\x00-\x20"'<>\\]+)"""
NAMED = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Steps go on until four of them add less than `MOVED` of all seeds' score, which 0.85 a step reaches in the given number.
DAMPING, STEPS, WRITTEN_EVERY, MOVED = 0.85, 100, 4, 1e-6
#: Score of all seeds of one kind together.
UNIT = 10**15
#: Distrust beyond this multiple of the trust blocks a host.
RATIO = 1.0


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, action) of the longest fitting rule; block before allow where two are as long."""
    kind = "struct<rule:string,action:string>"
    out = F.lit(None).cast(kind)
    for action, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def propagated(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(kind, host, score) from seeds (kind, host, score) over edges (kind, host, to, part).

    Scores only rise from the seeds' own, so what some steps moved is what they add to
    the sum of all scores: the loop ends where that is next to nothing, after `steps` at most.
    """
    kept = materialize(edges)
    base = materialize(seeds.withColumn("score", F.floor(F.col("score") * (1 - damping)).cast("long")))
    ranks, reached = base, None
    for step in range(1, steps + 1):
        moved = ranks.join(kept, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), F.floor(F.col("score") * F.col("part") * damping).cast("long").alias("score")
        )
        ranks = moved.unionByName(base).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % WRITTEN_EVERY == 0 or step == steps:
            ranks = materialize(ranks)
            before, reached = reached, ranks.agg(F.sum("score")).first()[0] or 0
            if before is not None and reached - before <= MOVED * UNIT:
                break
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    damping: float = DAMPING,
    steps: int = STEPS,
    ratio: float = RATIO,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row of pages.

    The longest fitting rule decides; without one, the page's host does: blocked
    where distrust > ratio * trust, allowed else, so hosts that no seed reaches are
    allowed. Edges join the hosts of the table: a page links to the known hosts its
    html names, each counted once a page; after `//` a host is read as in a url, with
    ports and any letters, and elsewhere by its dotted name. Scores that reach a host
    without links end there. NULL urls and urls without `://` have
    empty host and path. NULL html names nothing. Repeated rows stay repeated and
    count in the weights; an empty table gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    parsed = pages.select(
        "page_id", host.alias("host"), path.alias("path"), longest_rule(host, path, rules).alias("hit")
    )
    read = pages.select(
        host.alias("host"),
        longest_rule(host, path, rules)["action"].alias("action"),
        F.array_distinct(
            F.transform(
                F.concat(F.regexp_extract_all(html, F.lit(LINKED), F.lit(1)), F.regexp_extract_all(html, F.lit(NAMED), F.lit(0))),
                lambda h: F.translate(h, UPPER, LOWER),
            )
        ).alias("named"),
    )
    by_host = materialize(
        read.groupBy("host").agg(
            F.count_if(F.col("action") == "allow").alias("allowed"),
            F.count_if(F.col("action") == "block").alias("blocked"),
        )
    )
    pairs = (
        read.select("host", F.explode("named").alias("to"))
        .where("host != to")
        .groupBy("host", "to")
        .agg(F.count("*").alias("pages"))
    )
    known = by_host.where("host != ''").select(F.col("host").alias("to"))
    links = materialize(pairs.join(known, "to", "left_semi"))
    outgoing = links.groupBy("host").agg(F.sum("pages").alias("all"))
    incoming = links.groupBy("to").agg(F.sum("pages").alias("all"))
    edges = (
        links.join(outgoing, "host")
        .select(F.lit("trust").alias("kind"), "host", "to", (F.col("pages") / F.col("all")).alias("part"))
        .unionByName(
            links.join(incoming, "to").select(
                F.lit("distrust").alias("kind"),
                F.col("to").alias("host"),
                F.col("host").alias("to"),
                (F.col("pages") / F.col("all")).alias("part"),
            )
        )
    )
    totals = by_host.agg(F.sum("allowed").alias("allows"), F.sum("blocked").alias("blocks")).first()
    seeds = [
        by_host.where(F.col(column) > 0).select(
            F.lit(kind).alias("kind"), "host", F.floor(F.col(column) * (UNIT / total)).cast("long").alias("score")
        )
        for kind, column, total in (("trust", "allowed", totals.allows), ("distrust", "blocked", totals.blocks))
        if total
    ]
    if seeds:
        start = seeds[0] if len(seeds) == 1 else seeds[0].unionByName(seeds[1])
        scores = (
            propagated(start, edges, damping, steps)
            .groupBy("host")
            .agg(
                F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0)).alias("trust"),
                F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0)).alias("distrust"),
            )
        )
    else:
        scores = by_host.where("false").select("host", F.lit(0).alias("trust"), F.lit(0).alias("distrust"))
    judged = parsed.join(scores, "host", "left").withColumns(
        {name: F.coalesce(name, F.lit(0)).cast("long") for name in ("trust", "distrust")}
    )
    by_graph = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", by_graph).alias("verdict"),
        "trust",
        "distrust",
    )


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
