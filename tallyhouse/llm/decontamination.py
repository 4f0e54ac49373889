"""Benchmark decontamination under edit distance (operator 6).

An item leaks where a window of its own size in a document is within
floor(rate * words) word edits of it. The CGK random walk maps word sequences to
strings in which edit distance becomes Hamming distance: it copies the current
word at each step and moves on by a random bit of (step, word), so two walks meet
again after an edit. Sampling a few places of the walk gives LSH keys; walks repeat
until a pair at the largest allowed distance is found with the target recall, by a
match rate measured on mutated items. Exact edit distance decides.

Only windows that could pass the exact test at all are walked. Each word that no
item has costs one edit. And of any floor(rate * words) + 1 words of an item, one
is left in place by as many edits, moved by no more: so a window has one of its
item's rarest words where that puts it. Both lose nothing. Documents are scanned whole and in place, without a
shuffle. Items go to the tasks in blocks of a bounded number and length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.textops import PRIME, mixed

RATE, RECALL, SAMPLED, SEED = 0.2, 0.98, 3, 6
#: Walks after which one place less is sampled.
STEP = 100
#: Independent sets of places that one walk is sampled at.
SETS = 4
#: Items of one block, which is what a task holds of the benchmark.
BLOCK_ITEMS = 20_000
#: Windows walked at once.
AT_ONCE = 1 << 16
LEAKS = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int64())])
)
PUNCTUATION = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    if not text:
        return []
    return text.lower().encode("utf-8", "surrogatepass").translate(None, PUNCTUATION).split()


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Word edits between two sequences; anything above `most` counts as most + 1."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    row = np.arange(m + 1)
    steps = np.arange(m + 1)
    for i in range(1, n + 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (b != a[i - 1]))
        line = np.concatenate([[i], step])
        # insertions run along the row
        row = np.minimum.accumulate(line - steps) + steps
        if row.min() > most:
            return most + 1
    return int(min(row[-1], most + 1))


class Walk:
    """One CGK walk for sequences of one length, and the sets of places sampled from it."""

    def __init__(self, length: int, sampled: int, seed: int):
        rng = np.random.default_rng([seed, length, SEED])
        reach = max(1, 2 * length)
        self.places = [set(rng.choice(reach, size=min(sampled, reach), replace=False).tolist()) for _ in range(SETS)]
        self.bits = rng.integers(0, 2**63, size=reach, dtype=np.uint64)

    def keys(self, windows: np.ndarray) -> list[np.ndarray]:
        """For each set of places, the keys of the rows of a matrix of word numbers."""
        n, length = windows.shape
        flat = np.concatenate([windows, np.zeros((n, 1), windows.dtype)], axis=1).ravel().astype(np.uint64)
        base, at = np.arange(n) * (length + 1), np.zeros(n, dtype=np.int64)
        out = [np.zeros(n, dtype=np.uint64) for _ in self.places]
        with np.errstate(over="ignore"):
            for step in range(max(map(max, self.places)) + 1):
                word = flat[base + at]
                for k, places in enumerate(self.places):
                    if step in places:
                        out[k] = mixed(out[k] * np.uint64(31) + word + np.uint64(step))
                at += ((word ^ self.bits[step]) * PRIME >> np.uint64(63)).astype(np.int64)
                np.minimum(at, length, out=at)
        return out


class Index:
    """LSH tables of a block of items, with all that a task needs to search a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float, recall: float, sampled: int):
        self.number: dict[bytes, int] = {}
        self.items: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in plain_words(text)]
            if words:
                self.items.setdefault(len(words), []).append((item_id, np.array(words)))
        self.most = {n: math.floor(rate * n) for n in self.items}
        self.anchored()
        self.walks: dict[int, list[tuple[Walk, list[tuple[np.ndarray, np.ndarray]]]]] = {}
        for n, group in self.items.items():
            self.walks[n] = self.tables(n, np.stack([w for _, w in group]), recall, sampled)

    def anchored(self) -> None:
        """The rarest words of each item, one more than it may lose, by word: size and place."""
        used = np.zeros(len(self.number) + 1, dtype=np.int64)
        for group in self.items.values():
            for _, words in group:
                used[np.unique(words)] += 1
        length = np.zeros(len(self.number) + 1, dtype=np.int64)
        length[list(self.number.values())] = [len(w) for w in self.number]
        rows = set()
        for n, group in self.items.items():
            for _, words in group:
                # few items and many letters: rare in documents too, most likely
                rare = np.lexsort((-length[words], used[words]))[: self.most[n] + 1]
                rows.update((int(words[j]), n, int(j)) for j in rare)
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
        self.anchor_size, self.anchor_place = table[:, 1], table[:, 2]
        self.anchor_from = np.searchsorted(table[:, 0], np.arange(len(used)))
        self.anchor_to = np.searchsorted(table[:, 0], np.arange(len(used)), side="right")

    def possible(self, flat: np.ndarray) -> dict[int, np.ndarray]:
        """By size, the starts of windows that have a rare word of an item in its place."""
        count = (self.anchor_to - self.anchor_from)[flat]
        at = np.flatnonzero(count)
        times = count[at]
        first = np.repeat(self.anchor_from[flat[at]], times)
        row = first + np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times)
        begin, size = np.repeat(at, times) - self.anchor_place[row], self.anchor_size[row]
        order = np.argsort(size, kind="stable")
        begin, size = begin[order], size[order]
        cuts = np.flatnonzero(np.diff(size)) + 1
        out = {}
        for starts, sizes in zip(np.split(begin, cuts), np.split(size, cuts)):
            if len(sizes):
                most = self.most[int(sizes[0])]
                near = np.unique(starts)[:, None] + np.arange(-most, most + 1)
                out[int(sizes[0])] = np.unique(near)
        return out

    def tables(self, n: int, words: np.ndarray, recall: float, sampled: int):
        """Enough walks for the target recall at the largest allowed distance.

        Every hundred walks sample one place less, which lets more pairs meet; at one
        place a walk cannot fail for long, so the target is reached at any size.
        """
        rng = np.random.default_rng([n, SEED])
        base = words[rng.integers(0, len(words), size=256)]
        changed = np.stack([self.mutated(w, self.most[n], rng) for w in base])
        met = np.zeros(len(base), dtype=bool)
        tables = []
        while met.mean() < recall:
            walk = Walk(n, max(1, sampled - len(tables) // STEP), len(tables))
            for a, b in zip(walk.keys(base), walk.keys(changed)):
                met |= a == b
            sides = []
            for keys in walk.keys(words):
                order = np.argsort(keys, kind="stable")
                sides.append((keys[order], order))
            tables.append((walk, sides))
        return tables

    def mutated(self, words: np.ndarray, edits: int, rng) -> np.ndarray:
        out = words.tolist()
        for _ in range(edits):
            at, kind = int(rng.integers(0, max(len(out), 1))), rng.integers(0, 3)
            if kind == 0 and out:
                out[at] = -int(rng.integers(1, 1 << 30))
            elif kind == 1 and out:
                del out[at]
            else:
                out.insert(at, -int(rng.integers(1, 1 << 30)))
        out = (out + [-1] * len(words))[: len(words)]
        return np.array(out)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, distance): the best window of each item in each text."""
        get = self.number.get
        # windows may reach past the ends by as many words as an item may lose
        pad = [0] * max(self.most.values(), default=0)
        ids = [[*pad, *(get(w, 0) for w in plain_words(t)), *pad] for t in texts]
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(lengths.sum()))
        ends = np.cumsum(lengths)
        unknown = np.concatenate([[0], np.cumsum(flat == 0)])
        until = np.repeat(ends, lengths)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, starts in self.possible(flat).items():
            group = self.items[n]
            starts = starts[(starts >= 0) & (starts + n <= len(flat))]
            starts = starts[starts + n <= until[starts]]
            starts = starts[unknown[starts + n] - unknown[starts] <= self.most[n]]
            for lo in range(0, len(starts), AT_ONCE):
                self.walked(n, group, flat, starts[lo : lo + AT_ONCE], ends, lengths, len(pad), best)
        return [(t, item, start, end, d) for (t, item), (d, start, end) in sorted(best.items())]

    def walked(self, n, group, flat, starts, ends, lengths, pad, best) -> None:
        if not len(starts):
            return
        windows = flat[starts[:, None] + np.arange(n)]
        pairs = set()
        for walk, sides in self.walks[n]:
            for found, (keys, order) in zip(walk.keys(windows), sides):
                lo, hi = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
                for k in np.flatnonzero(hi > lo):
                    pairs.update((int(k), int(j)) for j in order[lo[k] : hi[k]])
        for k, j in sorted(pairs):
            item_id, words = group[j]
            text = int(np.searchsorted(ends, starts[k], side="right"))
            at = int(starts[k] - (ends[text] - lengths[text])) - pad
            start, end = max(at, 0), min(at + n, int(lengths[text]) - 2 * pad)
            known = best.get((text, item_id))
            if known is not None and known[0] == 0:
                continue
            d = edit_distance(words, windows[k][start - at : end - at], self.most[n])
            if d <= self.most[n] and (known is None or (d, start) < known[:2]):
                best[text, item_id] = (d, start, end)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = RATE,
    recall: float = RECALL,
    sampled: int = SAMPLED,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """docs with `leaks`: array<struct<item_id, start, end, distance>> of the items that each holds.

    For each item, the best window: start and end in words (lower case, ASCII
    punctuation removed), the least distance, then the first place. NULL and empty
    texts hold nothing, and items without words are in no text; NULL item ids are
    kept as NULL. At the ends of a text, where a window would reach beyond, the words
    that are there count, so a text that is an item less a few words holds it.
    Repeated rows get equal results, other columns pass through (`leaks` replaces an
    equal name), and an empty benchmark or table gives empty arrays or no rows.
    """
    listed = "array<struct<item_id:long,start:long,end:long,distance:long>>"
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).distinct()
    blocks = max(1, math.ceil(items.count() / block_items))
    docs, back = set_aside(docs.drop("leaks"), ["_found"])
    out = docs.withColumns({"text": F.col("text").cast("string"), "leaks": F.array().cast(listed)})
    names = out.columns
    for block in range(blocks):
        # at most about `block_items` rows
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = docs.sparkSession.sparkContext.broadcast(
            Index([(r.item_id, r.text) for r in sorted(rows, key=repr)], rate, recall, sampled)
        )

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").cast(pa.string()).to_pylist()
                # a few megabytes of text at a time
                part = np.cumsum([len(t or "") for t in texts]) // 4_000_000
                found: list[list[dict]] = [[] for _ in texts]
                for p in np.unique(part):
                    at = np.flatnonzero(part == p)
                    for text, item, start, end, d in index.value.search([texts[k] for k in at]):
                        found[at[text]].append({"item_id": item, "start": start, "end": end, "distance": d})
                yield batch.append_column("_found", pa.array(found, LEAKS))

        schema = T.StructType([*out.schema.fields, T.StructField("_found", out.schema["leaks"].dataType)])
        out = out.mapInArrow(scan, schema).withColumn("leaks", F.concat("leaks", "_found")).select(*names)
    return out.select(*back, "leaks")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item."""
    docs, back = set_aside(docs, ["leaks"])
    return leaks(docs, benchmark).where("size(leaks) = 0").select(*back)


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
