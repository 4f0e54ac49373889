"""Exact n-gram Jaccard self-join in the Jaccard metric space (operator 8).

Jaccard distance d = 1 - |x & y| / |x | y| is a metric, and two texts link when
d <= eps. The join runs in three nested levels.

1. Spark regions. In any fixed order of all shingles, two linked texts share one
   of their first floor(eps * n) + 1 shingles. So each such shingle makes a block,
   the block's least text is its pivot document, and every member of the block is
   replicated to the pivot's region: both ends of each link meet in a region.
   Frequent shingles come last in the order, so passages that many texts share
   rarely make blocks. Exact copies count once. Before any text moves, members
   that no other member can link with leave the region: counts of hash groups,
   a 1-Lipschitz image of the sets, bound the distance from below.
2. Cells. A region above `cell_docs` is dealt into chunks, each joined on its own
   and with the pivot. Members which that leaves outside the pivot's component
   meet the other chunks in a second step. No task holds more than two chunks.
3. Inside a cell, pivots make Voronoi regions; a text joins its home region and,
   by the triangle inequality, every region whose pivot is at most 2 eps farther
   than the home pivot. Regions recurse until small, then all pairs that are not
   known to be connected are compared by exact intersection counts.

Documents as pivots cannot part texts that have nothing in common (all their
distances are 1); level 1 therefore takes pivots from shared shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.components import components
from tallyhouse.llm.textops import WordHashes, as_long, lowered_words, runs, set_key, shingle_sets
from tallyhouse.sources.scratch import materialize

#: Most frequent shingles that come last in the order (one MB); any order is exact.
HOT_SHINGLES = 131_072
#: Shingles counted together in a task, and the count from which one is reported.
COUNT_BUFFER, REPORTED = 2_000_000, 3
#: Documents that a task holds as sets at a time.
AT_ONCE = 1_000
#: Documents of one chunk of a region.
CELL_DOCS = 1_500
#: Pivots of a Voronoi step and members below which a region is compared directly.
PIVOTS, DIRECT = 12, 384
#: Columns of the shingle matrix multiplied at once.
SLICE = 8_192


def _meets(inter: np.ndarray, union: np.ndarray, percent: int) -> np.ndarray:
    return (100 * inter >= percent * union) & (union > 0)


class Links:
    """Union-find over the members of a cell."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def roots(self, members: np.ndarray) -> np.ndarray:
        return np.fromiter((self.root(int(i)) for i in members), dtype=np.int64, count=len(members))


class Cell:
    """Exact links among the sets of one cell, as connected components."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.eps = percent, 1 - percent / 100
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        values, ids, seen = np.unique(flat, return_inverse=True, return_counts=True)
        # a shingle that only one member has counts in sizes alone
        self.number = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        ids = self.number[ids]
        self.owner, self.ids = owner[ids >= 0], ids[ids >= 0]
        self.width = int((seen > 1).sum())
        self.starts = np.searchsorted(self.owner, np.arange(len(sets) + 1))
        self.links = Links(len(sets))

    def of(self, i: int) -> np.ndarray:
        return self.ids[self.starts[i] : self.starts[i + 1]]

    def to_pivot(self, pivot: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shared and united sizes of the pivot with each member."""
        mark = np.zeros(self.width + 1, dtype=np.int64)
        mark[self.of(pivot)] = 1
        total = np.concatenate([[0], np.cumsum(mark[self.ids])])
        inter = total[self.starts[members + 1]] - total[self.starts[members]]
        return inter, self.sizes[members] + self.sizes[pivot] - inter

    def matrix(self, members: np.ndarray, lo: int, hi: int) -> np.ndarray:
        out = np.zeros((len(members), hi - lo), dtype=np.float32)
        for row, i in enumerate(members):
            x = self.of(int(i))
            x = x[(x >= lo) & (x < hi)]
            out[row, x - lo] = 1
        return out

    def compare(self, left: np.ndarray, right: np.ndarray) -> None:
        """Link all pairs of two member lists by exact counts, in blocks."""
        for a in range(0, len(left), DIRECT):
            rows = left[a : a + DIRECT]
            for b in range(0, len(right), DIRECT):
                cols = right[b : b + DIRECT]
                r, c = self.links.roots(rows), self.links.roots(cols)
                if len(np.unique(np.concatenate([r, c]))) == 1:
                    continue
                used = np.unique(np.concatenate([self.of(int(i)) for i in rows]))
                inter = np.zeros((len(rows), len(cols)), dtype=np.int64)
                for lo in range(0, self.width, SLICE):
                    hi = min(lo + SLICE, self.width)
                    if np.searchsorted(used, lo) != np.searchsorted(used, hi):
                        inter += np.rint(self.matrix(rows, lo, hi) @ self.matrix(cols, lo, hi).T).astype(np.int64)
                union = self.sizes[rows][:, None] + self.sizes[cols][None, :] - inter
                for i, j in zip(*np.nonzero(_meets(inter, union, self.percent) & (r[:, None] != c[None, :]))):
                    self.links.join(int(rows[i]), int(cols[j]))

    def solve(self, home: np.ndarray, window: np.ndarray) -> None:
        """Link home with home and home with window."""
        members = np.concatenate([home, window])
        if len(home) < 2 and not len(window) or not len(home):
            return
        if len(members) <= DIRECT:
            self.compare(home, members)
            return
        # the most frequent roots stand for dense spots: take pivots evenly from home
        pivots = home[np.unique(np.linspace(0, len(home) - 1, PIVOTS).astype(np.int64))]
        far = np.empty((len(pivots), len(members)))
        for k, p in enumerate(pivots):
            inter, union = self.to_pivot(int(p), members)
            far[k] = 1 - inter / np.maximum(union, 1)
            for i in np.flatnonzero(_meets(inter, union, self.percent)):
                self.links.join(int(p), int(members[i]))
        near = far.argmin(axis=0)
        reach = far.min(axis=0) + 2 * self.eps + 1e-9
        at_home = np.arange(len(members)) < len(home)
        for k in range(len(pivots)):
            mine = at_home & (near == k)
            if not mine.any():
                continue
            # within the parent's home, a pair of two regions is seen from both sides
            edge = (far[k] <= reach) & ~mine
            # a text whose every neighbour is connected to it needs no more
            inside, outside = members[mine], members[edge]
            if len(inside) + len(outside) > 0.8 * len(members):
                self.compare(inside, np.concatenate([inside, outside]))
            else:
                self.solve(inside, outside)


def _sets(texts, hashes: WordHashes, width: int) -> Iterator[np.ndarray]:
    return shingle_sets([hashes.of(lowered_words(t)) for t in texts], width)


def sketch_of(shingle_set: np.ndarray) -> bytes:
    """Shingle counts of hash groups, about one group for 8 shingles, as bytes."""
    groups = 64
    while groups * 8 < len(shingle_set):
        groups *= 2
    counts = np.bincount((shingle_set & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _folded(sketch: np.ndarray, groups: int) -> np.ndarray:
    return sketch.reshape(-1, groups).sum(axis=0)


def with_partner(sizes: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """Members that may link with another one by what the sketches allow.

    Counts of hash groups move by at most one for each shingle that only one of two
    sets has, so the L1 distance of the counts is a lower bound of the difference.
    """
    n = len(sizes)
    ok = np.zeros(n, dtype=bool)
    raw = [np.frombuffer(b, dtype=np.uint8).astype(np.int32) for b in sketches]
    width = np.array([len(b) for b in sketches])
    for groups in np.unique(width):
        wide = np.flatnonzero(width >= groups)
        wide = wide[np.argsort(sizes[wide], kind="stable")]
        table = np.stack([_folded(raw[i], groups) for i in wide])
        size = sizes[wide]
        until = np.searchsorted(size * percent, size * 100, side="right")
        for at in range(len(wide)):
            if width[wide[at]] != groups or until[at] == at + 1:
                continue
            apart = np.abs(table[at + 1 : until[at]] - table[at]).sum(axis=1)
            fits = apart * (100 + percent) <= (size[at + 1 : until[at]] + size[at]) * (100 - percent)
            if fits.any():
                ok[wide[at]] = True
                ok[wide[at + 1 : until[at]][fits]] = True
    return ok


def _sifting(percent: int):
    """(p, k) of the members of small regions that may link with another member."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["p"]):
            group = group.drop_duplicates("k")
            ok = with_partner(group["n"].to_numpy(), group["sketch"].tolist(), percent)
            if ok.any():
                yield group.loc[ok, ["p", "k"]]

    return run


def _counting(width: int):
    """(shingle, n): shingles that one stretch of a task's documents repeats."""

    def report(buffer: list[np.ndarray]) -> pd.DataFrame:
        values, n = np.unique(np.concatenate(buffer), return_counts=True)
        often = n >= REPORTED
        return pd.DataFrame({"shingle": values[often].view(np.int64), "n": n[often]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, buffer, held, seen = WordHashes(), [], 0, set()
        for batch in batches:
            parts = (batch["text"][at : at + AT_ONCE] for at in range(0, len(batch), AT_ONCE))
            for s in chain.from_iterable(_sets(part.tolist(), hashes, width) for part in parts):
                key = set_key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                buffer.append(s)
                held += len(s)
                if held >= COUNT_BUFFER:
                    yield report(buffer)
                    buffer, held, seen = [], 0, set()
        if buffer:
            yield report(buffer)

    return run


SIGNED = (
    "doc_id long, n long, sid binary, k long, cold array<long>, hot array<long>, sketch binary, packed binary, text_key binary"
)


def text_key(text: str | None) -> bytes | None:
    """128 bits that name a text, as `unhex(md5(text))` does; NULL where the text is."""
    return None if text is None else hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def _signing(width: int, percent: int, hot_sorted: np.ndarray, hot_rank: np.ndarray):
    """One row per document; its compressed text and prefix where the task sees the set first."""
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        pack = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for start in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(start, AT_ONCE)
                texts, rows = batch.column("text").to_pylist(), []
                for text, s in zip(texts, _sets(texts, hashes, width)):
                    n, key = len(s), set_key(s)
                    row = [n, key, as_long(key), None, None, None, None, text_key(text)]
                    if n and key not in seen:
                        seen.add(key)
                        take = n - (percent * n + 99) // 100 + 1
                        at = np.searchsorted(hot_sorted, s)
                        at[at == len(hot_sorted)] = 0
                        is_hot = hot_sorted[at] == s if len(hot_sorted) else np.zeros(n, dtype=bool)
                        cold = s[~is_hot][:take]
                        hot = s[is_hot][np.argsort(hot_rank[at[is_hot]], kind="stable")][: take - len(cold)]
                        packed = pack(text.encode("utf-8", "surrogatepass"))
                        row[3:7] = [cold.view(np.int64), hot.view(np.int64), sketch_of(s), packed]
                    rows.append(row)
                kinds = [pa.int64(), pa.binary(), pa.int64(), longs, longs, pa.binary(), pa.binary(), pa.binary()]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns], names=[c.split()[0] for c in SIGNED.split(", ")]
                )

    return run


def _unpacked(packed) -> list[str]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(p).decode("utf-8", "surrogatepass") for p in packed]


def _pivoting(percent: int):
    """(p, k): members of each block beside the block's least text.

    Rows come sorted by block, set size and text. A block ends where the next size
    is too large for a link. `rest` counts a set's shingles from this one on in the
    order: at the first shingle that two linked texts share, it bounds their
    intersection, so a member with too small a rest finds no partner here.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_s, last_n, run_n, pivot = None, 0, 0, None
        for batch in batches:
            s, n, rest, k = (batch[c].to_numpy() for c in ("s", "n", "rest", "k"))
            if not len(s):
                continue
            before_s = np.concatenate([[s[0] if last_s is None else last_s], s[:-1]])
            before_n = np.concatenate([[last_n], n[:-1]])
            new = (s != before_s) | (100 * before_n < percent * n)
            new[0] |= last_s is None
            block = np.cumsum(new)
            starts = np.flatnonzero(new)
            least = np.concatenate([[run_n], n[starts]])[block]
            partner = np.maximum(least, -(-percent * n // 100))
            ok = (100 + percent) * rest >= percent * (n + partner)
            kept_block, kept_k = block[ok], k[ok]
            last_s, last_n, run_n = s[-1], n[-1], least[-1]
            if not len(kept_k):
                pivot = pivot if block[-1] == 0 else None
                continue
            first = np.concatenate([[True], kept_block[1:] != kept_block[:-1]])
            p = kept_k[np.maximum.accumulate(np.where(first, np.arange(len(kept_k)), 0))]
            if pivot is not None:
                p = np.where(kept_block == 0, pivot, p)
            apart = p != kept_k
            yield pd.DataFrame({"p": p[apart], "k": kept_k[apart]})
            pivot = p[-1] if kept_block[-1] == block[-1] else None

    return run


def _edges(sids: list[bytes], cell: Cell) -> pd.DataFrame:
    root = cell.links.roots(np.arange(len(sids)))
    least: dict[int, bytes] = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, sids[i]), sids[i])
    rows = [(sid, least[r]) for sid, r in zip(sids, root) if sid != least[r]]
    return pd.DataFrame(rows, columns=["a", "b"])


def _first_step(width: int, percent: int):
    """Links of each chunk with itself and the pivot; members left outside the pivot's component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for group in runs(batches, ["p", "chunk"]):
            group = group.drop_duplicates("sid")
            if len(group) < 2:
                continue
            sids = group["sid"].tolist()
            cell = Cell(list(_sets(_unpacked(group["packed"]), hashes, width)), percent)
            pivot = np.flatnonzero((group["k"] == group["p"]).to_numpy())
            everyone = np.arange(len(sids))
            for p in pivot:
                inter, union = cell.to_pivot(int(p), everyone)
                for i in np.flatnonzero(_meets(inter, union, percent)):
                    cell.links.join(int(p), int(i))
            cell.solve(everyone, everyone[:0])
            out = _edges(sids, cell)
            out["p"], out["k"] = None, None
            yield out
            if group["chunks"].iloc[0] > 1:
                root = cell.links.roots(everyone)
                at = set(root[pivot].tolist())
                apart = [i for i in everyone if root[i] not in at]
                left = group.iloc[apart]
                yield pd.DataFrame({"a": None, "b": None, "p": left["p"].to_numpy(), "k": left["k"].to_numpy()})

    return run


def _second_step(width: int, percent: int):
    """Links between the members of a chunk and members left over of another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for group in runs(batches, ["p", "chunk", "other"]):
            apart = group["apart"].to_numpy(dtype=bool)
            if apart.all() or not apart.any():
                continue
            sids = group["sid"].tolist()
            cell = Cell(list(_sets(_unpacked(group["packed"]), hashes, width)), percent)
            where = np.arange(len(sids))
            cell.solve(where[apart], where[~apart])
            yield _edges(sids, cell)

    return run


def jaccard_sets(
    docs: DataFrame, width: int = 4, percent: int = 85, cell_docs: int = CELL_DOCS
) -> DataFrame:
    """(doc_id, n_shingles, sid, component_id) for every row of docs (doc_id, text).

    Words are lower-cased (A-Z) and split at ASCII white space; a text's set holds
    its `width`-word shingles, all its words as one where it has fewer. Texts link
    when 100 * intersection >= percent * union; `component_id` is the least doc_id
    reachable by links and `sid` names the set; `root` names the linked group (NULL
    without words) and `text_key` the text. Texts without words (or NULL) have
    an empty set, link with nothing and keep their own id. Repeated rows stay
    repeated; a NULL doc_id gets its component's least id, NULL if none has one.
    Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.select("text").mapInPandas(_counting(width), "shingle long, n long")
    top = (
        counted.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(HOT_SHINGLES)
    ).collect()
    hot = np.array([r.shingle for r in top], dtype=np.int64).view(np.uint64)
    by_value = np.argsort(hot)
    # the most frequent shingle has the last place
    ranks = (len(hot) - 1 - np.arange(len(hot)))[by_value] if len(hot) else np.zeros(0, dtype=np.int64)
    signed = materialize(docs.mapInArrow(_signing(width, percent, hot[by_value], ranks), SIGNED))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.col("n").cast("int").alias("n")
    blocks = signed.select("k", size, F.posexplode("cold").alias("at", "s"))
    cold = (
        blocks.select("s", "n", (F.col("n") - F.col("at")).alias("rest"), "k")
        .repartition(parts, "s")
        .sortWithinPartitions("s", "n", "k")
        .mapInPandas(_pivoting(percent), "p long, k long")
    )
    hot_blocks = signed.select("k", size, F.explode("hot").alias("s"))
    # at most HOT_SHINGLES rows
    hot_pivots = hot_blocks.groupBy("s").agg(F.min_by("k", F.struct("n", "k")).alias("p"))
    frequent = (
        hot_blocks.join(F.broadcast(hot_pivots), "s").where(F.col("p") != F.col("k")).select("p", "k")
    )
    links = materialize(cold.unionByName(frequent).distinct())
    members = links.unionByName(links.select("p", F.col("p").alias("k")).distinct())
    sizes = links.groupBy("p").agg((F.count("*") + 1).alias("size"))
    sketches = signed.where(F.col("sketch").isNotNull()).select("k", "n", "sketch")
    # a set has one row for each task that saw it first
    small = (
        members.join(sizes.where(F.col("size") <= cell_docs), "p", "left_semi")
        .join(sketches, "k")
        .repartition(parts, "p")
        .sortWithinPartitions("p", "k")
        .mapInPandas(_sifting(percent), "p long, k long")
    )
    # one text for each set and task that saw it
    texts = signed.where(F.col("packed").isNotNull()).select("k", "sid", "packed").hint("merge")
    large = (
        members.join(sizes.where(F.col("size") > cell_docs), "p")
        .withColumn("chunks", F.ceil(F.col("size") / cell_docs).cast("int"))
        .withColumn(
            "chunk",
            F.when(F.col("k") == F.col("p"), F.expr("sequence(0, chunks - 1)")).otherwise(
                F.array(F.expr("pmod(xxhash64(k), chunks)").cast("int"))
            ),
        )
        .select("p", "k", "chunks", F.explode("chunk").alias("chunk"))
    )
    dealt = materialize(small.select("p", "k", F.lit(1).alias("chunks"), F.lit(0).alias("chunk")).unionByName(large))
    cells = dealt.join(texts, "k")
    first = materialize(
        cells.repartition(parts, "p", "chunk")
        .sortWithinPartitions("p", "chunk", "sid")
        .mapInPandas(_first_step(width, percent), "a binary, b binary, p long, k long")
    )
    edges = first.where(F.col("a").isNotNull()).select("a", "b")
    apart = first.where(F.col("a").isNull()).select("p", "k").distinct()
    if not apart.isEmpty():
        chunks = dealt.where("chunks > 1").select("p", "chunks").distinct()
        apart = apart.join(chunks, "p").withColumn(
            "other", F.expr("pmod(xxhash64(k), chunks)").cast("int")
        )
        others = apart.select("p", "other").distinct()
        big = dealt.where(F.col("chunks") > 1).where(F.col("k") != F.col("p"))
        pairs = (
            apart.select("p", "k", "chunks", "other", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"))
            .where("chunk != other")
            .select("p", "k", "chunk", "other", F.lit(True).alias("apart"))
        ).unionByName(
            big.join(others, "p").where("chunk != other").select("p", "k", "chunk", "other", F.lit(False).alias("apart"))
        )
        second = (
            pairs.join(texts, "k")
            .repartition(parts, "p", "chunk", "other")
            .sortWithinPartitions("p", "chunk", "other", "sid")
            .mapInPandas(_second_step(width, percent), "a binary, b binary")
        )
        edges = edges.unionByName(second)
    labels = components(edges)
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "sid", "text_key")
    classes = rows.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(labels, classes["sid"] == labels["node"], "left").select(
        "sid", F.coalesce("root", "sid").alias("root"), "least"
    )
    named = rooted.select("sid", "root").join(
        rooted.groupBy("root").agg(F.min("least").alias("component")), "root"
    )
    return rows.join(named.select("sid", "root", "component"), "sid", "left").select(
        "doc_id",
        "n_shingles",
        "sid",
        "text_key",
        "root",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay when each linked group keeps one of its rows.

    It keeps the least doc_id, rows without one last, and of one id the text with the
    least md5; where rows are equal in both, any one of them. Only rows of one group
    replace each other, so different texts with one id both stay. Texts without words
    are no copies of each other and all stay.
    """
    joined = jaccard_sets(docs.select("doc_id", "text"), width, percent).where("root IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("first")
    stays = joined.groupBy("root").agg(first).select(F.struct("first.doc_id", "first.text_key").alias("_place"))
    docs, back = set_aside(docs, ["_place"])
    text = F.col("text").cast("string")
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # a struct, as an id may be NULL and still has to match; the join and the choice share its shuffle
    place = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"))
    named = docs.where(~wordless).withColumn("_place", place).join(stays, "_place", "left_semi").dropDuplicates(["_place"])
    return named.select(*back).unionByName(docs.where(wordless).select(*back))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_sets(docs).select("doc_id", "n_shingles", "component_id")
