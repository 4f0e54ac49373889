"""Spelling variants by k-d trees over letter counts (operator 13).

One inserted, deleted or replaced letter moves a word's letter counts by at most two
in L1 distance. Words are dealt into cells by a shallow tree of count thresholds per
word length; a word asks its own length (one letter up, one down) and the next longer
one (one letter up), and goes to every cell whose box such a move can reach. A task
builds a k-d tree over the words of its cell, prunes by the boxes of the points and
compares the letter order of what is left. No pairs leave a task: each word gets the
number of its near words there and the best of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.textops import runs
from tallyhouse.sources.scratch import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters a cell is meant to hold; words whose counts place the cells (they only decide the cost).
CELL_LETTERS, SAMPLE = 1 << 17, 50_000
#: Points of a leaf; differences computed at once.
LEAF, AT_ONCE = 24, 1 << 23
#: Counted letters: a to z, then U+00C0 to U+00FF.
LETTERS = 26 + 64
PARTIAL = "word string, n_near long, best_n long, best string"


# -- words ----------------------------------------------------------------


def counted_words(docs: DataFrame, shortest: int = 6, least: int = 5, one_in: int = 199) -> DataFrame:
    """(word, n) of docs (doc_id, text): words of at least `shortest` letters that come `least` times.

    Words are maximal runs of A-Z, a-z and U+00C0..U+00FF, A-Z lower-cased. Where the
    crc32 of `<doc_id>:<run>` is a multiple of `one_in`, its code point at that number
    modulo the length is deleted first. A run shorter than `shortest` cannot grow, so
    it is not looked at. A NULL doc_id counts as empty, a NULL text has no words.
    """
    found = F.regexp_extract_all("text", F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{shortest},}}"), 0)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")
    ).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    rows = rows.select("run", h.alias("h"), F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + F.lit(2), F.col("size").cast("int"))
    )
    word = F.when(F.col("h") % one_in == 0, shorter).otherwise(F.col("run"))
    return (
        rows.select(word.alias("word"))
        .where(F.char_length("word") >= shortest)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
    )


# -- vectors and cells ----------------------------------------------------


def codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """Counts of the letters of code point rows."""
    n, size = points.shape
    at = np.where(points < 0xC0, points.astype(np.int64) - 97, points.astype(np.int64) - 0xC0 + 26)
    flat = np.bincount((np.arange(n)[:, None] * LETTERS + at).ravel(), minlength=n * LETTERS)
    return flat.reshape(n, LETTERS).astype(np.int16 if size < 1 << 14 else np.int32)


def widest_split(counts: np.ndarray) -> tuple[int, int] | None:
    """(letter, most): the letter of greatest spread and the count that halves the rows best."""
    spread = counts.var(axis=0)
    letter = int(spread.argmax())
    if spread[letter] == 0:
        return None
    values, sizes = np.unique(counts[:, letter], return_counts=True)
    below = np.cumsum(sizes)[:-1]
    return letter, int(values[np.abs(below - len(counts) / 2).argmin()])


def cell_tree(counts: np.ndarray, cells: int):
    """Thresholds that deal rows into about `cells` boxes: (letter, most, below, above) or None for one box."""
    split = widest_split(counts) if cells > 1 and len(counts) > 1 else None
    if split is None:
        return None
    low = counts[:, split[0]] <= split[1]
    half = cells // 2
    return (*split, cell_tree(counts[low], half), cell_tree(counts[~low], cells - half))


def reached(tree, counts: np.ndarray, ups: int, downs: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows): the cells that rows reach with so many letters more and so many fewer.

    A step over a threshold takes letters of one kind. The count that a path has taken
    is kept by letter, as a letter can be split on twice.
    """
    state = np.zeros((len(counts), 2), dtype=np.int64) + (ups, downs)
    stack = [(tree, 1, np.arange(len(counts)), counts.astype(np.int64), state)]
    while stack:
        node, cell, rows, at, left = stack.pop()
        if node is None:
            yield cell, rows
            continue
        letter, most, below, above = node
        for side, child in ((0, below), (1, above)):
            now = at[:, letter]
            move = np.maximum(now - most, 0) if side == 0 else np.maximum(most + 1 - now, 0)
            budget = left[:, 1 - side]  # fewer letters to get below, more to get above
            go = move <= budget
            if go.any():
                there, rest, step = at[go].copy(), left[go].copy(), move[go]
                there[:, letter] += -step if side == 0 else step
                rest[:, 1 - side] -= step
                stack.append((child, 2 * cell + side, rows[go], there, rest))


def _routing(trees: dict):
    """Rows (size, cell, role, word, n): 0 a point, 1 asks its own length, 2 asks the longer words."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["word"].str.len()):
                size = int(size)
                words, ns = part["word"].to_numpy(), part["n"].to_numpy()
                counts = letter_counts(codes(list(words)))
                asks = ((size, 0, 0, 0), (size, 1, 1, 1), (size + 1, 2, 1, 0))
                for at, role, ups, downs in asks:
                    for cell, rows in reached(trees.get(at), counts, ups, downs):
                        yield pd.DataFrame({"size": at, "cell": cell, "role": role, "word": words[rows], "n": ns[rows]})

    return route


# -- search in a cell -----------------------------------------------------


def close_pairs(
    points: np.ndarray, asking: np.ndarray, point_codes: np.ndarray, asking_codes: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asking row, point row) at one edit; askers are as long as the points or one letter shorter."""
    shorter = asking_codes.shape[1] < point_codes.shape[1]
    radius = 1 if shorter else 2
    stack = [(np.arange(len(points)), np.arange(len(asking)))]
    while stack:
        ps, qs = stack.pop()
        low, high = points[ps].min(axis=0), points[ps].max(axis=0)
        kept = []
        for a in range(0, len(qs), step := max(1, AT_ONCE // LETTERS)):
            some = qs[a : a + step]
            q = asking[some]
            away = (np.maximum(low - q, 0) + np.maximum(q - high, 0)).sum(axis=1)
            kept.append(some[away <= radius])
        qs = np.concatenate(kept) if kept else qs
        if len(qs) == 0:
            continue
        split = widest_split(points[ps]) if len(ps) > LEAF else None
        if split is not None:
            below = points[ps, split[0]] <= split[1]
            stack += [(ps[below], qs), (ps[~below], qs)]
            continue
        # a leaf, or words with equal counts
        step_q = max(1, AT_ONCE // (LETTERS * min(len(ps), 4096)))
        for b in range(0, len(ps), 4096):
            p = ps[b : b + 4096]
            for a in range(0, len(qs), step_q):
                q = qs[a : a + step_q]
                far = np.abs(asking[q][:, None, :] - points[p][None, :, :]).sum(axis=2)
                i, j = np.nonzero(far == radius)
                if len(i):
                    right = one_edit(asking_codes[q[i]], point_codes[p[j]])
                    yield q[i][right], p[j][right]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows are one edit apart; rows of `a` have the length of `b` or one less."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.cumprod(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def _searching():
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in runs(batches, ["size", "cell"]):
            points = cell[cell["role"] == 0]
            if points.empty:
                continue
            names, ns = points["word"].to_numpy(), points["n"].to_numpy()
            point_codes = codes(list(names))
            counts = letter_counts(point_codes)
            for role, both in ((1, False), (2, True)):
                asking = cell[cell["role"] == role]
                if asking.empty:
                    continue
                ask_names, ask_ns = asking["word"].to_numpy(), asking["n"].to_numpy()
                ask_codes = codes(list(ask_names))
                found = list(close_pairs(counts, letter_counts(ask_codes), point_codes, ask_codes))
                if not found:
                    continue
                i, j = (np.concatenate(x) for x in zip(*found))
                yield _best(ask_names, i, names, ns, j)
                if both:  # the longer words learn of the shorter ones
                    yield _best(names, j, ask_names, ask_ns, i)

    return search


def _best(names, i, others, ns, j) -> pd.DataFrame:
    """Per word of `i`: number of its partners `j`, the commonest of them (ties: the least)."""
    order = np.lexsort((others.astype(str), -ns))  # numpy compares code points
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    best = np.full(len(names), len(order), dtype=np.int64)
    np.minimum.at(best, i, place[j])
    has = np.flatnonzero(best < len(order))
    first = order[best[has]]
    number = np.bincount(i, minlength=len(names))[has]
    return pd.DataFrame({"word": names[has], "n_near": number, "best_n": ns[first], "best": others[first]})


# -- forms and roots ------------------------------------------------------


def near_words(words: DataFrame, cell_letters: int = CELL_LETTERS, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, best_n, best) for the words of (word, n) that have a word one edit away."""
    size = F.char_length("word").alias("size")
    # lengths whose words fill more than a cell; each stands for at least a cell of words
    sizes = words.groupBy(size).agg(F.count("*").alias("words")).where(F.col("words") * F.col("size") > cell_letters)
    crowded = {r["size"]: -(-r["words"] * r["size"] // cell_letters) for r in sizes.collect()}
    trees = {}
    if crowded:
        total = words.count()
        # by hash, so that tasks send the driver no more than it keeps
        share = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1, sample / total)))
        some = words.where(size.isin(list(crowded)) & share).select("word").limit(2 * sample)
        drawn = pd.Series([r.word for r in some.collect()])
        for length, part in drawn.groupby(drawn.str.len()):
            trees[int(length)] = cell_tree(letter_counts(codes(list(part))), crowded[int(length)])
    dealt = words.mapInPandas(_routing(trees), "size int, cell long, role int, word string, n long")
    partial = (
        dealt.repartition("size", "cell").sortWithinPartitions("size", "cell").mapInPandas(_searching(), PARTIAL)
    )
    return (
        partial.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
        .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain, its length halved in every step.

    A form is at least five times as frequent as its word, so chains have no cycles.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        ahead = now.join(on, F.col("root") == F.col("at"), "left")
        step = ahead.select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("moved"))
        now = materialize(step)
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_variants(
    docs: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5, one_in: int = 199,
    cell_letters: int = CELL_LETTERS, sample: int = SAMPLE,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of docs (doc_id, text), see `counted_words`.

    Near words differ by one inserted, deleted or replaced code point. `form` is the
    near word of largest n (ties: least in code-point order) if it comes at least
    `ratio` times as often, else NULL, as is `form_n`; `root` follows forms to the
    last, and is the word itself where it has none. Repeated rows count again, empty
    tables and texts without such words give no rows, other columns are not read.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    words = materialize(counted_words(docs, shortest, least, one_in))
    near = near_words(words, cell_letters, sample)
    has_form = F.col("best_n") >= ratio * F.col("n")
    judged = materialize(
        words.join(near, "word", "left").select(
            "word",
            F.when(has_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        )
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
