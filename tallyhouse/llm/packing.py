"""Packed token rows by best-fit-decreasing with a segment tree (operator 9).

Documents become token ids in the tasks that read them, an end token after each,
and are cut into segments of at most one row's capacity, without loss. A hash deals
the segments into shards whose number follows the bytes of the input; each shard is
packed on its own: longest segment first, into the fullest row that still takes it,
found in a segment tree over the rows' free capacities. Ids travel as binary.
"""

from __future__ import annotations

import base64
import math
import sys
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.token_counts import LOOSE, REMEMBERED, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
CAPACITY, END = 2048, 50256
#: Text bytes that a shard holds on average; bounds a task's memory.
SHARD_BYTES = 8_000_000


class RankEncoder(dict):
    """Token ids as bytes from a rank file; special strings are ordinary text.

    A piece never joins a visible character with white space after it, so words with
    the space before them are encoded on their own and remembered.
    """

    def __init__(self, path: str, width: int):
        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        coding = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode, self.kind = coding.encode_ordinary, np.dtype(f"<u{width}")
        self.code = {2: "H", 4: "I"}[width]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = self.direct(" " + word)
        return value

    def direct(self, text: str) -> bytes:
        ids = array(self.code, self.encode(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def ids(self, text: str) -> bytes:
        if LOOSE.search(text):
            return self.direct(text)
        first, *rest = text.split(" ")
        return b"".join([self.direct(first), *map(self.__getitem__, rest)])


@cache
def rank_encoder(vocabulary: str, width: int) -> RankEncoder:
    """The encoder of a Python worker: its remembered words serve all of the worker's tasks."""
    return RankEncoder(vocabulary_path(vocabulary), width)


class FreeSpace:
    """Rows by free capacity; the tree says which capacities have a row."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.rows: defaultdict[int, list[int]] = defaultdict(list)

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        at = free + self.leaves
        while at:
            self.count[at] += 1
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least free capacity of `need` or more, and that capacity."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at % 2 or not self.count[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.leaves
        row = self.rows[free].pop()
        while at:
            self.count[at] -= 1
            at //= 2
        return row, free


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of segment numbers; lengths come in falling order and fit one row each."""
    space, rows = FreeSpace(capacity), []
    for k, n in enumerate(lengths):
        hit = space.take(n)
        if hit is None:
            rows.append([k])
            space.add(capacity - n, len(rows) - 1)
        else:
            row, free = hit
            rows[row].append(k)
            space.add(free - n, row)
    return rows


SEGMENTS = "shard long, doc_id string, segment int, n int, ids binary"
PACKED = (
    "shard long, row long, n_tokens int, doc_ids array<string>, segments array<int>, "
    "cu_seqlens array<int>, input_ids binary, position_ids binary"
)


def _segmenting(vocabulary: str, capacity: int, end: int, width: int, shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = rank_encoder(vocabulary, width)
        stop = np.array([end], dtype=encoder.kind).tobytes()
        step = capacity * encoder.kind.itemsize
        seen: defaultdict[int, int] = defaultdict(int)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.ids(text) + stop
                name = xxhash.xxh64_intdigest(ids, seed=xxhash.xxh32_intdigest(doc_id or ""))
                # equal rows spread out too; which of them is which makes no difference
                again = seen[name]
                seen[name] += 1
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    shard = xxhash.xxh64_intdigest(b"%d %d %d" % (name, again, k)) % shards
                    out.append((shard, doc_id, k, len(part) // encoder.kind.itemsize, part))
                if len(out) >= 4096:
                    yield pd.DataFrame(out, columns=["shard", "doc_id", "segment", "n", "ids"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["shard", "doc_id", "segment", "n", "ids"])

    return run


def _packing(capacity: int, end: int, width: int):
    kind = np.dtype(f"<u{width}")

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        # NULL ids first; equal rows may change places
        shard = shard.assign(_id=shard["doc_id"].fillna(""))
        shard = shard.sort_values(
            ["n", "_id", "segment", "ids"], ascending=[False, True, True, True], kind="stable"
        )
        ids, n = shard["ids"].tolist(), shard["n"].tolist()
        names = shard["doc_id"].tolist()
        parts = shard["segment"].tolist()
        out = []
        count = np.arange(capacity, dtype=kind)
        for number, members in enumerate(best_fit(n, capacity)):
            lengths = [n[m] for m in members]
            used = sum(lengths)
            padding = np.full(capacity - used, end, dtype=kind).tobytes()
            places = [count[:x].tobytes() for x in lengths] + [np.zeros(capacity - used, dtype=kind).tobytes()]
            out.append(
                (
                    int(shard["shard"].iloc[0]),
                    number,
                    used,
                    [names[m] for m in members],
                    [parts[m] for m in members],
                    np.concatenate([[0], np.cumsum(lengths)]).tolist(),
                    b"".join([ids[m] for m in members] + [padding]),
                    b"".join(places),
                )
            )
        return pd.DataFrame(out, columns=[c.split()[0] for c in PACKED.split(", ")])

    return run


def pack_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    end: int = END,
    width: int = 2,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Rows of a packed id matrix for docs (doc_id, text).

    `input_ids` holds `capacity` little-endian unsigned numbers of `width` bytes, the
    end token as padding; `cu_seqlens` the running segment lengths from 0, and
    `position_ids` positions that start again at 0 with each segment. Every token of
    every row, plus its end token, is in exactly one segment; (doc_ids, segments)
    name them, a document's segments in order give it back. Special strings in texts
    are ordinary text. NULL and empty texts are one end token; NULL ids stay NULL;
    repeated rows are packed as often as they come; an empty table gives no rows.
    """
    read = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),  # numbers with NULLs would turn into floats
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = read.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    segments = read.mapInPandas(_segmenting(vocabulary, capacity, end, width, shards), SEGMENTS)
    packed = segments.groupBy("shard").applyInPandas(_packing(capacity, end, width), PACKED)
    return packed.withColumn("doc_ids", F.col("doc_ids").cast("array<long>"))


def write_packed(packed: DataFrame, path: str) -> None:
    """The matrix as parquet files of binary rows, one folder, readable in any order."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def op9_token_packing(spark, sf_dir: str) -> DataFrame:
    return pack_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
