"""Spelling variants against pairwise comparison in plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import spelling

UPPER = str.maketrans(spelling.UPPER, spelling.LOWER)


def plain_words(rows, one_in=199):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 5 and len(w) >= 6}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(short == long[:k] + long[k + 1 :] for k in range(len(long)))


def expected(words):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def misspelt(rng, word):
    k = rng.randrange(len(word))
    return rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("aeé÷ÿz") + word[k:], word[:k] + "o" + word[k + 1 :]])


@pytest.fixture
def rows(odd_rows):
    """Words with variants of variants, anagrams and accents."""
    rng = random.Random(5)
    out = []
    for word in ["connection", "Ñandúes", "banana", "abcdef", "fedcba", "straße×x", "aaaaaaa"] + [
        "".join(rng.choices("abdeiou", k=rng.randint(6, 8))) for _ in range(150)
    ]:
        heard = [word] * rng.choice([130, 30, 6])
        for _ in range(4):
            once = misspelt(rng, word)
            heard += [once] * rng.choice([25, 6, 5, 4]) + [misspelt(rng, once)] * 5
        rng.shuffle(heard)
        out += [(len(out) + 100 + k, " ".join(heard[k::7]) + "!") for k in range(7)]
    out.append((5000, ("x" * 30_000 + "1") * 5 + ("x" * 29_999 + "2") * 30))
    return out + odd_rows


@pytest.mark.parametrize("cell_letters", [1 << 17, 200])
def test_equals_all_pairs(table, rows, cell_letters):
    got = spelling.spelling_variants(table(rows), cell_letters=cell_letters, sample=300)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = expected(plain_words(rows))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of two


def test_deletions_follow_the_hash(table):
    rows = [(k, "Wonderful wonderful") for k in range(200)]
    got = spelling.counted_words(table(rows), one_in=3).collect()
    assert {r.word: r.n for r in got} == plain_words(rows, 3) and len(got) == 4  # 3 divides 9


def test_no_words(table):
    assert spelling.spelling_variants(table([])).collect() == []
    assert spelling.spelling_variants(table([(1, None), (None, ""), (3, "short words only")])).collect() == []


def test_tree_reaches_every_cell_that_a_move_can_reach():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (400, spelling.LETTERS)).astype(np.int16)
    tree = spelling.cell_tree(counts, 16)
    home = {int(r): c for c, rows in spelling.reached(tree, counts, 0, 0) for r in rows}
    assert sorted(home) == list(range(400)) and len(set(home.values())) >= 12
    cells = {}
    for c, rows in spelling.reached(tree, counts, 1, 1):
        for r in rows:
            assert c not in cells.setdefault(int(r), set())
            cells[int(r)].add(c)
    for r in range(0, 400, 40):
        for up in range(spelling.LETTERS):
            down = int(rng.integers(spelling.LETTERS))
            moved = counts[r].copy()
            moved[up] += 1
            moved[down] -= 1
            [cell] = [c for c, rows in spelling.reached(tree, moved[None, :], 0, 0) if len(rows)]
            assert cell in cells[r]
