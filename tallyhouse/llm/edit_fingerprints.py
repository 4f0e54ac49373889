"""Document fingerprints by a randomised edit embedding (operator 11).

A walk over a text stands on one character per step and moves on or stays by a random
bit that depends on the step and the character alone, the same for all texts. Where two
texts differ by few edits their walks fall back in step, so edit distance becomes Hamming
distance of the walks. The fingerprint keeps the characters at sampled steps: 64 of the
first 64 steps and of every doubling after, so a sample of a later stretch stands for more
steps. Bands of sampled characters find texts with like fingerprints; the whole
fingerprints of all texts of a band are then compared, unless links join them already.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.components import components
from tallyhouse.llm.textops import REMEMBERED, mixed
from tallyhouse.sources.scratch import materialize, scratch_dir

#: Sampled steps per doubling; seed of the walk.
SAMPLES, SEED = 64, 0x5EED
#: Characters are told apart by 63 classes; the last symbol ends a text.
SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-."
END = 63
#: Characters walked at once in a task; steps whose random bits are made at once.
AT_ONCE, BLOCK = 1 << 25, 4096
#: Bands of a fingerprint at each of two scales, sampled characters in each, likeness that links two texts.
BANDS, ROWS, LIKENESS = 12, 6, 0.8
#: Texts up to which a band has ROWS characters, one more for each MORE times as many; likeness at a scale down to
#: which longer bands find as much: texts as like as LIKENESS can be less so in the part that a scale covers.
FEW, MORE, LEAST_ALIKE = 16_000, 6, 0.7
#: Fingerprints up to this length are banded so that no two like ones miss each other; texts of a band compared at once.
SHORT, CHUNK = 2 * SAMPLES, 1000
#: Sampled documents that cut the order of documents into ranges; they only decide how even these are.
SAMPLE = 50_000
PACKED = "bucket int, guest boolean, id long, tie long, copies long, n_chars long, text binary"
RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("text_sha256", T.StringType()),
    ]
)


# -- walks ----------------------------------------------------------------


@cache
def sample_steps(limit: int) -> np.ndarray:
    """The sampled steps below `limit`, in order: every one of the first 64, then 64 per doubling."""
    out = [np.arange(SAMPLES)]
    low = SAMPLES
    while low < limit:
        draws = mixed(np.arange(SAMPLES, dtype=np.uint64) + np.uint64(low * SAMPLES + SEED))
        # one in each of 64 equal parts
        width = low // SAMPLES
        out.append(low + np.arange(SAMPLES) * width + (draws % np.uint64(width)).astype(np.int64))
        low *= 2
    steps = np.concatenate(out)
    return steps[steps < limit]


@cache
def weights(count: int) -> np.ndarray:
    """Steps that each of the first `count` samples stands for."""
    place = np.arange(count) // SAMPLES
    return np.where(place == 0, 1.0, 2.0 ** (place - 1))


def classes(text: str) -> np.ndarray:
    """The class of each character, then END."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.empty(len(points) + 1, dtype=np.uint8)
    small = points < len(_TABLE)
    out[:-1] = _TABLE[np.where(small, points, 0)]
    if not small.all():
        out[:-1][~small] = _classes_of(points[~small].astype(np.uint64))
    out[-1] = END
    return out


def _classes_of(points: np.ndarray) -> np.ndarray:
    return (mixed(points + np.uint64(SEED)) % np.uint64(END)).astype(np.uint8)


_TABLE = _classes_of(np.arange(1 << 11, dtype=np.uint64))


def moves(first: int) -> np.ndarray:
    """Whether a walk moves on, for BLOCK steps from `first` and every class; never at the end."""
    keys = (np.arange(first, first + BLOCK, dtype=np.uint64)[:, None] << np.uint64(6)) + np.arange(64, dtype=np.uint64)
    out = (mixed(keys ^ np.uint64(SEED << 40)) & np.uint64(1)).astype(np.int64)
    out[:, END] = 0
    return out


def walks(texts: list[np.ndarray]) -> list[str]:
    """Fingerprints of texts given as `classes`. Walks end with the text, at three steps a character at most."""
    if not texts:
        return []
    sizes = np.array([len(t) - 1 for t in texts])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([texts[k] for k in order])
    at = np.concatenate([[0], np.cumsum(sizes[order][:-1] + 1)]).astype(np.int64)
    limits = 3 * sizes[order]
    steps = sample_steps(1 << max(6, int(limits.max(initial=0)).bit_length()))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    alive = np.arange(len(texts))
    sample = 0
    now = np.empty(len(texts), dtype=np.uint8)
    move = np.empty(len(texts), dtype=np.int64)
    step = 0
    while len(alive):
        if step % BLOCK == 0:
            bits = moves(step)
        count = len(alive)
        np.take(flat, at, out=now[:count], mode="clip")
        if sample < len(steps) and steps[sample] == step:
            found.append((alive, now[:count].copy()))
            sample += 1
        np.take(bits[step % BLOCK], now[:count], out=move[:count], mode="clip")
        at += move[:count]
        step += 1
        if step % 64 == 0 or count < 64:
            go = (flat[at] != END) & (limits[alive] > step)
            if not go.all():
                alive, at = alive[go], at[go]
    matrix = np.full((len(texts), len(found)), END, dtype=np.uint8)
    for k, (rows, symbols) in enumerate(found):
        matrix[rows, k] = symbols
    # beyond three steps a character nothing counts
    beyond = steps[None, : len(found)] >= limits[:, None] if len(found) else np.zeros(matrix.shape, dtype=bool)
    matrix[beyond] = END
    lengths = (matrix != END).sum(axis=1)
    text = np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)[matrix]
    out = [""] * len(texts)
    for k, place in enumerate(order.tolist()):
        out[place] = text[k, : lengths[k]].tobytes().decode()
    return out


def fingerprint(text: str) -> str:
    return walks([classes(text)])[0]


def likeness(a: str, b: str) -> float:
    """Share of walk steps with like characters, by the samples; 1 for two empty fingerprints."""
    size, common = max(len(a), len(b)), min(len(a), len(b))
    if size == 0:
        return 1.0
    weight = weights(size)
    same = np.frombuffer(a[:common].encode(), dtype=np.uint8) == np.frombuffer(b[:common].encode(), dtype=np.uint8)
    return float(weight[:common][same].sum() / weight.sum())


# -- a document and the next one ------------------------------------------


def edited(text: str, following: str) -> str:
    """`text` with its last half, rounded down, replaced by as much of the start of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _tie(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _keys(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes, str]]:
    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
        text = text or ""
        yield doc_id, text.encode("utf-8", "surrogatepass"), text


def _order(doc_id: int | None, tie: int) -> tuple:
    return (doc_id is not None, doc_id or 0, tie)


def _sampling(share: int):
    """(id, tie) of the rows whose hash is below a share of 2**64, and the number of all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = [], []
            for doc_id, raw, _ in _keys(batch):
                tie = _tie(raw)
                if xxhash.xxh3_64_intdigest(f"{doc_id}:{tie}".encode()) < share:
                    ids.append(doc_id)
                    ties.append(tie)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ties, pa.int64())], names=["id", "tie"])

    return work


def _least(cuts: list[tuple]):
    """The first document of each range that a task sees: (bucket, known, id, tie)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple] = {}
        for batch in batches:
            for doc_id, raw, _ in _keys(batch):
                key = _order(doc_id, _tie(raw))
                bucket = bisect_right(cuts, key)
                if bucket not in least or key < least[bucket]:
                    least[bucket] = key
        rows = [(b, *key) for b, key in least.items()]
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "known", "id", "tie"])

    return work


def _packing(cuts: list[tuple], firsts: dict[tuple, int]):
    """Texts by range; the first of a range is also a guest of the range before it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=5)
        names = ["bucket", "guest", "id", "tie", "copies", "n_chars", "text"]
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            rows: dict[tuple, list] = {}
            for doc_id, raw, text in _keys(batch):
                tie = _tie(raw)
                held = rows.setdefault((doc_id, raw), [bisect_right(cuts, _order(doc_id, tie)), False, doc_id, tie, 0, len(text), None])
                held[4] += 1
                if held[6] is None:
                    held[6] = packer.compress(raw)
            out = list(rows.values())
            for row in rows.values():
                before = firsts.get(_order(row[2], row[3]))
                if before is not None:
                    out.append([before, True, *row[2:]])
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return work


def _judging(at_once: int):
    """Per range, sorted by guest, id and text: each document against the one after it."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in zip(*(batch[name].to_pylist() for name in ("bucket", "guest", "id", "copies", "text"))):
                yield *row[:4], unpacker.decompress(row[4])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        """Rows of one document as one, with their number; a guest comes once."""
        last = None
        for bucket, guest, doc_id, copies, raw in documents(batches):
            if last is not None and last[:3] == [bucket, guest, doc_id] and last[4] == raw:
                last[3] += copies
                continue
            if last is not None:
                yield last
            last = [bucket, guest, doc_id, copies, raw]
        if last is not None:
            yield last

    def judged(held: list[list]) -> Iterator[pa.RecordBatch]:
        texts = [row[4].decode("utf-8", "surrogatepass") for row in held]
        pairs = [k for k, row in enumerate(held) if not row[1]]
        # a range is followed by its guest, so the next row is the next document
        changed = [edited(texts[k], texts[k + 1]) for k in pairs]
        prints = walks([classes(t) for t in [*texts, *changed]])
        own, other = prints[: len(texts)], prints[len(texts) :]
        rows = []
        for k, text, mark in zip(pairs, changed, other):
            _, _, doc_id, copies, raw = held[k]
            row = (
                doc_id,
                len(texts[k]),
                hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                own[k],
                mark,
                likeness(own[k], mark),
                likeness(own[k], own[k + 1]),
                hashlib.sha256(raw).hexdigest(),
            )
            rows += [row] * copies
        for a in range(0, len(rows), 1 << 14):
            columns = zip(*rows[a : a + (1 << 14)])
            fields = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, fields[f.dataType.simpleString()]) for c, f in zip(columns, RESULT.fields)], names=RESULT.names
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        size = 0
        for row in merged(batches):
            held.append(row)
            size += len(row[4])
            # a stretch ends with the document that its last one is compared with
            if size > at_once and len(held) > 1:
                yield from judged([*held[:-1], [*held[-1][:1], True, *held[-1][2:]]])
                held, size = ([] if row[1] else [row]), (0 if row[1] else len(row[4]))
        if any(not row[1] for row in held):
            yield from judged(held)

    return work


def _cuts(docs: DataFrame, ranges: int, sample: int) -> list[tuple]:
    """Places in the order of documents that part it into about even ranges, from at most about `sample` of them."""
    total = docs.count()
    if total == 0:
        return []
    share = min(1 << 64, (1 << 64) * sample // total)
    drawn = docs.mapInArrow(_sampling(share), "id long, tie long").distinct().collect()
    keys = sorted(_order(r.id, r.tie) for r in drawn)
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def edit_fingerprints(
    docs: DataFrame, ranges: int | None = None, sample: int = SAMPLE, at_once: int = AT_ONCE
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, text_sha256).

    For every row of docs (doc_id, text). The edited text has the last floor(n_chars / 2)
    code points replaced by the first as many (or all) of the next document: by ascending
    doc_id, NULL first, texts of one id in the order of a hash; after the last comes the
    first. Rows equal in id and text are one document, and each gets its result. A NULL
    text is empty; an empty text has the fingerprint '' and likeness 1 to another such,
    else 0. Equal texts have equal fingerprints. A single document follows itself. Other
    columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(docs, ranges or 4 * parts, sample)
    # one row per range, so the list has a fixed bound
    least = (
        docs.mapInArrow(_least(cuts), "bucket int, known boolean, id long, tie long")
        .groupBy("bucket")
        .agg(F.min(F.struct("known", "id", "tie")).alias("key"))
        .orderBy("bucket")
        .collect()
    )
    firsts = {
        (r.key.known, r.key.id, r.key.tie): least[k - 1].bucket for k, r in enumerate(least)
    }  # the first range is followed around the end
    packed = docs.mapInArrow(_packing(cuts, firsts), PACKED)
    return (
        packed.repartition("bucket")
        .sortWithinPartitions("bucket", "guest", "id", "tie", "text")
        .mapInArrow(_judging(at_once), RESULT)
    )


# -- like fingerprints ----------------------------------------------------


def rows_for(texts: int) -> int:
    """Sampled characters in a band. Unlike texts that share one by chance grow with the square of the texts otherwise."""
    return ROWS + max(0, math.ceil(math.log(max(texts, 1) / FEW, MORE)))


def bands_for(rows: int) -> int:
    """Bands at a scale with which texts as like as LEAST_ALIKE miss each other no more often than with BANDS of ROWS."""
    return math.ceil(BANDS * math.log1p(-(LEAST_ALIKE**ROWS)) / math.log1p(-(LEAST_ALIKE**rows)) - 1e-9)


@cache
def band_places(scale: int, rows: int = ROWS) -> np.ndarray:
    """Bands of `rows` samples below step 64 * 2**scale; a sample is as likely as the steps it stands for."""
    count = bands_for(rows)
    weight = weights(SAMPLES * (scale + 1))
    total = np.cumsum(weight)
    draws = mixed(np.arange(count * rows, dtype=np.uint64) + np.uint64((scale + 1) << 32)) >> np.uint64(11)
    return np.searchsorted(total, draws / 2.0**53 * total[-1], side="right").reshape(count, rows)


def short_places(upper: int, least: float) -> list[slice]:
    """Places below `upper` dealt into more parts than like fingerprints up to that length have differences."""
    parts = int(upper * (1 - least) + 1e-9) + 1
    return [slice(k, upper, parts) for k in range(parts)]


def bands(print_: str, least: float = LIKENESS, rows: int = ROWS) -> list[int]:
    """Hashes of the bands at the widest scale that a fingerprint fills and at the next narrower one.

    Texts whose walks differ by less than a factor of two share a scale. Samples up to
    SHORT weigh the same, so of two like fingerprints of at most that length one part
    of `short_places` is the same; a fingerprint is dealt for the power of two above its
    length and for that above the greatest length of one like it.
    """
    if not print_:
        return []
    symbols = np.frombuffer(print_.encode(), dtype=np.uint8)
    out = []
    longest = int(len(print_) / least + 1e-9) if least > 0 else SHORT + 1
    for upper in sorted({1 << (n - 1).bit_length() for n in (len(print_), longest)}):
        if upper <= SHORT:
            padded = np.zeros(upper, dtype=np.uint8)
            padded[: len(symbols)] = symbols
            for number, places in enumerate(short_places(upper, least)):
                out.append(_tie(b"short %d %d " % (upper, number) + padded[places].tobytes()))
    widest = len(print_) // SAMPLES - 1
    if longest > SHORT and widest >= 0:
        for scale in {widest, max(widest - 1, 0)}:
            for number, places in enumerate(band_places(scale, rows)):
                out.append(_tie(b"%d %d " % (scale, number) + symbols[places].tobytes()))
    return out


def _banding(least: float, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies have the same bands; forgetting some only repeats them
        for batch in batches:
            keys, found = [], []
            for key, print_ in zip(batch["key"].to_pylist(), batch["fingerprint"].to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                some = bands(print_, least, rows)
                keys += [key] * len(some)
                found += some
            if len(seen) > REMEMBERED:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.int64())], names=["key", "band"])

    return work


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, key, pivot) of sorted (band, key): each text but the least of its band, once. No band is held."""
    last_band = last_key = pivot = None
    for batch in batches:
        band, keys = batch["band"].to_numpy(), batch["key"]
        if len(band) == 0:
            continue
        first, again = np.ones(len(band), dtype=bool), np.zeros(len(band), dtype=bool)
        first[0] = last_band is None or band[0] != last_band
        first[1:] = band[1:] != band[:-1]
        again[0] = keys[0].as_py() == last_key
        again[1:] = pc.equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        # place of the least text, after the one that an earlier batch began with
        start = np.maximum.accumulate(np.where(first, np.arange(len(band)) + 1, 0))
        at = np.flatnonzero(~first & ~again)
        pivots = pa.concat_arrays([pa.array([pivot], pa.binary()), keys])
        found = [pa.array(band[at]), keys.take(pa.array(at)), pivots.take(pa.array(start[at]))]
        last_band, last_key, pivot = band[-1], keys[-1].as_py(), pivots[int(start[-1])].as_py()
        yield pa.RecordBatch.from_arrays(found, names=["band", "key", "pivot"])


def _verifying(least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[name].to_pylist() for name in ("a", "b", "fa", "fb")))
            good = [(a, b) for a, b, fa, fb in rows if likeness(fa, fb) >= least]
            columns = zip(*good) if good else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

    return work


def new_links(left: list[tuple], right: list[tuple] | None, least: float) -> list[tuple]:
    """Links (root, root) between (root, fingerprint) of different roots; of `left` with itself without `right`.

    Roots that a link has joined count as one from there on.
    """
    others = left if right is None else right
    numbers = {root: n for n, root in enumerate(dict.fromkeys(root for root, _ in [*left, *others]))}
    names = list(numbers)
    sizes = np.array([len(p) for _, p in others])
    matrix = np.zeros((len(others), int(sizes.max(initial=0))), dtype=np.uint8)
    for k, (_, print_) in enumerate(others):
        matrix[k, : len(print_)] = np.frombuffer(print_.encode(), dtype=np.uint8)
    weight = weights(max([matrix.shape[1], *[len(p) for _, p in left]]))
    total = np.cumsum(weight)
    joined = np.arange(len(names))
    theirs = np.array([numbers[root] for root, _ in others])
    out = []
    for k, (root, print_) in enumerate(left):
        own = numbers[root]
        at = np.flatnonzero(joined[theirs] != joined[own])
        if right is None:
            at = at[at > k]
        if len(at) == 0 or len(print_) == 0:
            continue
        common = min(len(print_), matrix.shape[1])
        symbols = np.frombuffer(print_[:common].encode(), dtype=np.uint8)
        same = (matrix[at, :common] == symbols) @ weight[:common]
        for other in theirs[at[same / total[np.maximum(sizes[at], len(print_)) - 1] >= least]].tolist():
            if joined[other] != joined[own]:
                out.append((names[own], names[other]))
                joined[joined == joined[other]] = joined[own]
    return out


def _comparing(least: float):
    """Per cell of a band, in order, the links between texts of its two sides that nothing joins yet."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sides = None, ([], [])

        def links() -> pa.RecordBatch:
            found = new_links(sides[0], sides[1] if last[1] != last[2] else None, least)
            columns = zip(*found) if found else [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

        for batch in batches:
            for band, i, j, chunk, root, print_ in zip(*(batch[n].to_pylist() for n in ("band", "i", "j", "chunk", "root", "fingerprint"))):
                if last is not None and last != (band, i, j):
                    yield links()
                    sides = ([], [])
                last = (band, i, j)
                sides[chunk != i].append((root, print_))
        if last is not None:
            yield links()

    return work


def like_texts(prints: DataFrame, least: float = LIKENESS, chunk: int = CHUNK) -> DataFrame:
    """(node, root) for the texts of (key, fingerprint) linked with another; `key` names a text.

    Two texts that share a band are linked where their whole fingerprints are as like as
    `least`. First the texts of a band are compared with the least key in it, one
    comparison a text. Where links do not join all texts of a band by then, those that
    they leave apart are compared with each other, in cells of two chunks of the band; so
    no task holds a whole band. Only the fingerprints of texts that share a band travel.
    Bands grow with the logarithm of the number of texts, so that few share one by chance.
    """
    # dealt once; a band has narrow rows only, at most one a text, and is read as a stream
    rows = prints.mapInArrow(_banding(least, rows_for(prints.count())), "key binary, band long")
    met = materialize(
        rows.repartition("band")
        .sortWithinPartitions("band", "key")
        .mapInArrow(_meeting, "band long, key binary, pivot binary")
    )
    pairs = materialize(met.select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct())
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    marks = materialize(
        prints.join(needed, "key", "left_semi").groupBy("key").agg(F.first("fingerprint").alias("fingerprint"))
    )
    both = pairs.join(marks.select(F.col("key").alias("a"), F.col("fingerprint").alias("fa")), "a").join(
        marks.select(F.col("key").alias("b"), F.col("fingerprint").alias("fb")), "b"
    )
    linked = materialize(components(both.select("a", "b", "fa", "fb").mapInArrow(_verifying(least), "a binary, b binary")))

    # the pivot has met all others of its band
    rooted = met.select("band", "key").join(linked.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "key", F.coalesce("root", "key").alias("root")
    )
    parted = rooted.groupBy("band").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks")
    )
    parted = parted.where("low <> high").select("band", "chunks")
    apart = rooted.join(parted, "band").withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks").cast("int"))
    cells = apart.join(marks, "key").select(
        "band", "root", "fingerprint", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    )
    cells = cells.select(
        "band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "root", "fingerprint"
    )
    more = materialize(
        cells.repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
        .mapInArrow(_comparing(least), "a binary, b binary")
        .distinct()
    )
    if more.isEmpty():
        return linked
    return components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def fingerprint_classes(docs: DataFrame, least: float = LIKENESS, **options) -> DataFrame:
    """`edit_fingerprints` with `class_id`: the least doc_id of the texts that are linked with this one.

    Links join texts that share a band and are as like as `least`; equal texts are one
    text. Empty texts have no links and keep their own id. Like fingerprints of up to
    SHORT samples always share a band, longer ones all but surely.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark)
    # sampled characters are dense: entropy coding halves them
    edit_fingerprints(docs, **options).write.option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(RESULT).parquet(folder).withColumn("key", F.unhex(F.substring("text_sha256", 1, 32)))
    filled = rows.where("n_chars > 0")
    linked = like_texts(filled.select("key", "fingerprint"), least)
    texts = filled.groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = texts.select("key", "least").join(linked, F.col("key") == F.col("node"), "left").select(
        "key", F.coalesce("root", "key").alias("root"), "least"
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("class_id")), "root").select("key", "class_id")
    joined = rows.join(named, "key", "left")
    kept = F.when(F.col("n_chars") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    return joined.select(*RESULT.names[:-1], kept.alias("class_id"))


def op11_edit_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
