"""Words, hashes and sorted-partition helpers for code that runs inside tasks.

A word is a run of characters other than space and U+0009..U+000D, which is what
`bytes.split` separates by; `bytes.lower` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

#: Entries that a task remembers before it starts over; bounds its memory only.
REMEMBERED = 400_000
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose outputs look random."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lowered_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered within a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, items: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, items), dtype=np.uint64, count=len(items))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word windows; of all words as one where they are fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    span = min(width, n)
    out = np.full(n - span + 1, span, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(span):
            out = mixed(out * PRIME + hashes[k : n - span + 1 + k])
    return np.unique(out)


def shingle_sets(texts: list[np.ndarray], width: int, at_once: int = 1 << 20) -> Iterator[np.ndarray]:
    """`shingles` of many texts, hashed together in stretches of about `at_once` words."""
    first = 0
    while first < len(texts):
        last, held = first, 0
        while last < len(texts) and (held == 0 or held + len(texts[last]) <= at_once):
            held += len(texts[last])
            last += 1
        flat = np.concatenate(texts[first:last])
        out = np.full(max(len(flat) - width + 1, 0), width, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                out = mixed(out * PRIME + flat[k : len(flat) - width + 1 + k]) if len(out) else out
        at = 0
        for text in texts[first:last]:
            yield np.unique(out[at : at + len(text) - width + 1]) if len(text) >= width else shingles(text, width)
            at += len(text)
        first = last


def set_key(shingle_set: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return xxhash.xxh3_128_digest(shingle_set.tobytes())


def as_long(key: bytes) -> int:
    return int.from_bytes(key[:8], "big", signed=True)


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition sorted by `keys`, one at a time, across batches."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if batch.empty:
            continue
        cols = [batch[k] for k in keys]
        change = np.zeros(len(batch), dtype=bool)
        for c in cols:
            before = c.shift()
            change |= ~((c == before) | (c.isna() & before.isna())).to_numpy(dtype=bool)
        change[0] = False
        starts = [0, *np.flatnonzero(change).tolist(), len(batch)]
        for a, b in zip(starts, starts[1:]):
            part = batch.iloc[a:b]
            key = tuple(None if pd.isna(v) else v for v in (c.iloc[a] for c in cols))
            if held and key != last:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
            last = key
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
