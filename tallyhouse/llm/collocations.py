"""Phrase collocations counted in HAT-tries (operator 12).

Phrases are counted by length. A phrase can only be frequent if both phrases one word
shorter inside it are, so the tasks of a length look up the frequent shorter ones in a
bitmap of fixed size and count what passes; a bitmap lets some rare phrases through and
loses none. A task counts in a trie on word ids: a first word has one hash container of
the rest, which bursts into a container per second word when it is full. When the trie
is full, its largest subtrees are spilled whole, as sorted runs. The runs of a first
word meet in one prefix partition and are merged there; first words that hold a large
share of all are dealt into several by the hash of the rest.
"""

from __future__ import annotations

import gc
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.textops import PRIME, mixed
from tallyhouse.sources.scratch import materialize

#: Entries of a container before it bursts, of a trie before it spills; bytes of text a task cuts at once.
BURST, FULL, AT_ONCE = 8192, 1_200_000, 1 << 22
#: Words whose ids a task remembers before it spills and starts over.
VOCABULARY = 400_000
#: Bits of a bitmap of frequent phrases (8 MB); they only decide how many rare ones are counted.
BITS = 1 << 26
#: A first word with 1/HOT of all words is dealt into several partitions; so at most HOT words are.
HOT = 2048
LONGEST, LEAST, TOP = 5, 100, 2000
NO_LANG = "und"
BREAK, RARE, PAD = -1, -2, -3
#: Piece ends become line feeds and tabs spaces; A-Z are lower-cased.
CLEAN = bytes.maketrans(
    b".,;:!?\n\v\f\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 10 + b" abcdefghijklmnopqrstuvwxyz"
)
RUNS = "bucket int, lang string, phrases string, counts array<long>"
#: Entries of the runs that are sorted together; rows of a batch of words.
RUN, ROWS = 400_000, 1 << 16


# -- counting in a task ---------------------------------------------------


class HatTrie:
    """Counts of (head id, tail) where a tail is the bytes of the other word ids (4 each)."""

    def __init__(self, burst: int = BURST):
        self.heads: dict[int, Counter | dict[bytes, Counter]] = {}
        self.sizes: Counter = Counter()
        self.burst, self.entries = burst, 0

    def add(self, heads: np.ndarray, tails: np.ndarray) -> None:
        """Count phrases given as head ids and a row of tail ids each."""
        if len(heads) == 0:
            return
        order = np.argsort(heads, kind="stable")
        heads = heads[order]
        flat = np.ascontiguousarray(tails[order], dtype=np.int32)
        keys = flat.view(f"V{4 * flat.shape[1]}").ravel().tolist()
        starts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
        for head, a, b in zip(heads[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            self._insert(head, keys[a:b])

    def _insert(self, head: int, tails: list[bytes]) -> None:
        node = self.heads.get(head)
        if node is None:
            node = self.heads[head] = Counter()
        if isinstance(node, Counter):
            before = len(node)
            node.update(tails)
            grown = len(node) - before
            if len(node) > self.burst and len(tails[0]) > 4:
                children: dict[bytes, Counter] = {}
                for tail, n in node.items():
                    children.setdefault(tail[:4], Counter())[tail[4:]] = n
                self.heads[head] = children
        else:
            grown = 0
            for tail in tails:
                child = node.get(tail[:4])
                if child is None:
                    child = node[tail[:4]] = Counter()
                grown += tail[4:] not in child
                child[tail[4:]] += 1
        self.sizes[head] += grown
        self.entries += grown

    def spill(self, down_to: int) -> Iterator[tuple[int, list[tuple[bytes, int]]]]:
        """Take out the largest subtrees until at most `down_to` entries stay."""
        for head, size in self.sizes.most_common():
            if self.entries <= down_to:
                return
            node = self.heads.pop(head)
            del self.sizes[head]
            self.entries -= size
            if isinstance(node, Counter):
                yield head, list(node.items())
            else:
                yield head, [(first + rest, n) for first, child in node.items() for rest, n in child.items()]


class Vocabulary(dict):
    """Ids of the words that may be part of a frequent phrase; others are RARE, nothing is PAD."""

    def __init__(self, lang: str, allowed: np.ndarray | None):
        super().__init__({b"": PAD, b"\n": BREAK})
        self.names: list[bytes] = []
        self.hashes: list[int] = []
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
        # one byte of a view is read faster than one of an array
        self.allowed = None if allowed is None else memoryview(allowed)

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        if self.allowed is not None:
            cell = h % (8 * len(self.allowed))
            if not self.allowed[cell >> 3] >> (cell & 7) & 1:
                self[word] = RARE
                return RARE
        self.names.append(word)
        self.hashes.append(h)
        self[word] = value = len(self.names) - 1
        return value


def phrase_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of `length` words, from the hashes of the words."""
    count = len(hashes) - length + 1
    out = hashes[:count].copy()
    with np.errstate(over="ignore"):
        for k in range(1, length):
            out = mixed(out * PRIME + hashes[k : k + count])
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the cells of hashes are set."""
    cell = hashes % np.uint64(8 * len(bitmap))
    return (bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Counting:
    """Phrases of some lengths in one language within a task.

    `shorter` holds the frequent phrases one word shorter than the first of `lengths`.
    """

    def __init__(self, lang: str, lengths: list[int], allowed, shorter, full: int, burst: int):
        self.lang, self.lengths, self.shorter, self.full = lang, lengths, shorter, full
        self.allowed, self.burst = allowed, burst
        self.words, self.trie = Vocabulary(lang, allowed), HatTrie(burst)

    def add(self, texts: list[str]) -> Iterator[tuple]:
        carried = np.zeros(0, dtype=np.int64)
        for raw in stretches(texts):
            tokens = raw.split(b" ")
            row = np.fromiter(map(self.words.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            row = np.concatenate([carried, row[row != PAD]])
            yield from self._count(row, len(carried))
            carried = row[-(self.lengths[-1] - 1) :]
            if len(self.words) > VOCABULARY:
                yield from self.spilled(0)
                # the ids of the words carried over are those of the new vocabulary
                known = self.words.names
                self.words = Vocabulary(self.lang, self.allowed)
                carried = np.array([self.words[known[k]] if k >= 0 else k for k in carried.tolist()], dtype=np.int64)

    def _count(self, row: np.ndarray, carried: int) -> Iterator[tuple]:
        """Count the windows of `row` that reach beyond its first `carried` words."""
        if len(row) < self.lengths[0]:
            return
        if self.lengths[0] > 2:
            known = np.array([*self.words.hashes, 0], dtype=np.uint64)
            width = self.lengths[0] - 1
            frequent = in_bitmap(self.shorter, phrase_hashes(known[np.maximum(row, -1)], width))
        for length in self.lengths:
            if len(row) < length:
                break
            windows = np.lib.stride_tricks.sliding_window_view(row, length)
            good = (windows >= 0).all(axis=1)
            good[: max(0, carried - length + 1)] = False
            if self.lengths[0] > 2:
                for k in range(length - width + 1):
                    good &= frequent[k : k + len(good)]
            at = np.flatnonzero(good)
            self.trie.add(row[at], windows[at, 1:])
        if self.trie.entries > self.full:
            yield from self.spilled(self.full // 2)

    def spilled(self, down_to: int) -> Iterator[tuple]:
        """(lang, head, [(tail, n)]) of the subtrees that go."""
        names = self.words.names
        for head, items in self.trie.spill(down_to):
            by_size: dict[int, list] = {}
            if len(self.lengths) == 1:
                by_size[0] = items
            else:
                for item in items:
                    by_size.setdefault(len(item[0]), []).append(item)
            for some in by_size.values():
                ids = np.frombuffer(b"".join(t for t, _ in some), dtype=np.int32).reshape(len(some), -1)
                columns = [[names[k] for k in ids[:, c].tolist()] for c in range(ids.shape[1])]
                tails = columns[0] if len(columns) == 1 else list(map(b" ".join, zip(*columns)))
                yield self.lang, names[head], list(zip(tails, (n for _, n in some)))


def stretches(texts: list[str]) -> Iterator[bytes]:
    """Lower-cased texts with single separators, in stretches of about AT_ONCE bytes that end between words."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass").translate(CLEAN).replace(b"\n ", b"\n").replace(b"\n", b" \n ")
        a = 0
        while len(raw) - a > AT_ONCE:
            b = raw.find(b" ", a + AT_ONCE)
            if b < 0:
                break
            held.append(raw[a:b])
            yield b" ".join(held)
            held, size, a = [], 0, b + 1
        held += [raw[a:], b"\n"]
        size += len(raw) - a
        if size > AT_ONCE:
            yield b" ".join(held)
            held, size = [], 0
    if held:
        yield b" ".join(held)


def _rows(runs: Iterator[tuple], hot: dict[tuple[str, bytes], int], buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs by prefix partition: that of the first word, of a hot one also by the hash of the tail."""
    kinds = {"bucket": pa.int32(), "lang": pa.string(), "phrases": pa.string(), "counts": pa.list_(pa.int64())}
    parts: dict[tuple[int, str], list[tuple[bytes, int]]] = {}
    held = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        for (bucket, lang), items in parts.items():
            items.sort()
            phrases, counts = zip(*items)
            row = (bucket, lang, b"\n".join(phrases).decode(errors="surrogatepass"), counts)
            yield pa.RecordBatch.from_arrays([pa.array([v], type=k) for v, k in zip(row, kinds.values())], names=list(kinds))
        parts.clear()

    for lang, head, items in runs:
        salts, first = hot.get((lang, head), 1), zlib.crc32(head)
        if salts == 1:
            parts.setdefault((first % buckets, lang), []).extend((head + b" " + tail, n) for tail, n in items)
        else:
            for tail, n in items:
                bucket = (first + zlib.crc32(tail) % salts) % buckets
                parts.setdefault((bucket, lang), []).append((head + b" " + tail, n))
        held += len(items)
        if held > RUN:
            yield from flushed()
            held = 0
    yield from flushed()


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    for batch in batches:
        groups: dict[str, list[str]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            groups.setdefault(lang, []).append(text)
        yield from groups.items()


def _counting(lengths: list[int], allowed, shorter, hot, buckets: int, full: int, burst: int):
    """Count phrases; `allowed` and `shorter` are broadcast bitmaps of words and of shorter phrases."""

    def runs(batches) -> Iterator[tuple]:
        bitmap = allowed.value
        below = shorter.value if shorter is not None else None
        langs: dict[str, Counting] = {}
        for lang, texts in _by_lang(batches):
            if lang not in langs:
                langs[lang] = Counting(lang, lengths, bitmap, below, full, burst)
            yield from langs[lang].add(texts)
            # all languages of a task share the room
            while sum(c.trie.entries for c in langs.values()) > full:
                yield from max(langs.values(), key=lambda c: c.trie.entries).spilled(full // 4)
            if sum(len(c.words) for c in langs.values()) > 2 * VOCABULARY:
                for held in langs.values():
                    yield from held.spilled(0)
                langs.clear()
        for held in langs.values():
            yield from held.spilled(0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a trie has no cycles, and to look for some among its entries takes long
        gc.disable()
        try:
            yield from _rows(runs(batches), hot, buckets)
        finally:
            gc.enable()

    return work


def _word_counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of single words."""

    def batch(lang: str, counts: Counter) -> Iterator[pa.RecordBatch]:
        counts.pop(b"", None)
        for a in range(0, len(names := list(counts)), ROWS):
            some = names[a : a + ROWS]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(some), type=pa.string()),
                    pa.array([w.decode(errors="surrogatepass") for w in some], type=pa.string()),
                    pa.array([counts[w] for w in some], type=pa.int64()),
                ],
                names=["lang", "phrase", "n"],
            )
        counts.clear()

    langs: dict[str, Counter] = {}
    for lang, texts in _by_lang(batches):
        counts = langs.setdefault(lang, Counter())
        for text in texts:
            counts.update(text.encode("utf-8", "surrogatepass").translate(CLEAN).replace(b"\n", b" ").split(b" "))
        if sum(map(len, langs.values())) > VOCABULARY:
            for key, held in langs.items():
                yield from batch(key, held)
            langs.clear()
    for key, held in langs.items():
        yield from batch(key, held)


# -- over all tasks -------------------------------------------------------


def _cells(bits: int):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist()):
                seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
                words = phrase.encode("utf-8", "surrogatepass").split(b" ")
                hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)
                out.append(int(phrase_hashes(hashes, len(words))[0]) % bits)
            yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.int64())], names=["cell"])

    return cells


def bitmap_of(phrases: DataFrame, bits: int = BITS):
    """A broadcast bitmap of `bits` bits over the hashes of phrases (lang, phrase), put together in Spark."""
    cells = phrases.select("lang", "phrase").mapInArrow(_cells(bits), "cell long")
    # blocks of 32,768 bits, counted from 1, over numbers from 1
    blocks = cells.select((F.col("cell") + 1).alias("cell")).groupBy(
        F.bitmap_bucket_number("cell").alias("block")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    out = np.zeros(max(bits // 8, 4096), dtype=np.uint8)
    for row in blocks.toLocalIterator():
        out[(row.block - 1) * 4096 : row.block * 4096] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(out[: bits // 8])


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS, full: int = FULL, burst: int = BURST
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of phrases with f >= least, (lang, n) of all words) of docs (lang, text)."""
    words = materialize(
        docs.mapInArrow(_word_counting, "lang string, phrase string, n long")
        .groupBy("lang", "phrase")
        .agg(F.sum("n").alias("f"))
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = [words.where(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("words"), "f")]
    overall = words.agg(F.sum("f")).first()[0]
    if not overall:
        return found[0], totals
    # at most HOT rows, as each stands for 1/HOT of all words
    hot = {
        (r.lang, r.phrase.encode("utf-8", "surrogatepass")): -(-r.f * HOT // overall)
        for r in words.where(F.col("f") * HOT >= overall).collect()
    }
    allowed = bitmap_of(found[0], bits)
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shorter = None
    # few phrases are left once three words in a row come often, so the rest take one pass
    for lengths in ([2], [3], list(range(4, longest + 1))):
        if not lengths or lengths[0] > longest:
            break
        runs = docs.mapInArrow(_counting(lengths, allowed, shorter, hot, buckets, full, burst), RUNS)
        entries = runs.repartition("bucket").select(
            "bucket", "lang", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("counts").alias("c")))
        )
        merged = entries.groupBy("bucket", "lang", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
        level = materialize(merged.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f"))
        if level.isEmpty():
            break
        found.append(level)
        if lengths[-1] < longest:
            shorter = bitmap_of(level, bits)
    return reduce(DataFrame.unionByName, found), totals


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
    bits: int = BITS, full: int = FULL, burst: int = BURST,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` collocations.

    Texts are lower-cased (A-Z), split at `.,;:!?` and U+000A..U+000D into pieces and
    these at spaces and tabs into words. Per language, n counts all words and f(phrase)
    its occurrences within pieces. Phrases of 2 to `longest` words with a = f(phrase) >=
    `least` are candidates; a cut after k words gives l and r, the f of its parts, and
    floor(1000 * a * n / (l * r)); the lowest-scoring cut counts, ties to the smallest k.
    Candidates inside a longer one that comes as often are dropped. The order is score
    and a descending, then phrase by bytes. A NULL language is `und`, a NULL text empty;
    repeated rows count again, other columns are not read, an empty table gives no rows.
    Arithmetic is in 38-digit decimals: exact while 1000 * a * n stays below 10**38.
    """
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    phrases, totals = frequent_phrases(docs, least, longest, bits, full, burst)
    phrases = materialize(phrases)
    candidates = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    # a phrase inside a longer one as frequent lies inside one that is a word longer, too
    part = F.split("phrase", " ")
    inner = candidates.where("words >= 3").select(
        "lang",
        "a",
        F.explode(F.array(F.array_join(F.slice(part, 1, F.col("words") - 1), " "), F.array_join(F.slice(part, 2, F.col("words") - 1), " "))).alias("phrase"),
    )
    kept = candidates.join(inner, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(part, 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    firsts = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = T.DecimalType(38, 0)
    exact = "CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))"
    scored = (
        cuts.join(firsts, ["lang", "first"])
        .join(rests, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("product", F.expr(exact).cast(wide))
        .withColumn("parts", F.expr("CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))").cast(wide))
        .withColumn("score", F.expr("product div parts"))
    )
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    flat = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return top_per_lang(flat, top)


def top_per_lang(scored: DataFrame, top: int) -> DataFrame:
    """Ranks from 1; tasks drop what cannot be among the first before the languages meet."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
