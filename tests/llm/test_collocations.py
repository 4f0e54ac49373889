"""Collocations against plain counting with Python's whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import collocations as c


def expected(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        inside = {(p[i:j], a) for p, a in often.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p)}
        scored = []
        for p, a in often.items():
            if len(p) > 1 and (p, a) not in inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture
def rows(prose):
    rng = random.Random(2)
    words = ["the", "New", "york", "É", "ÉCOLE", "a\x1cb", "stock", "exchange", "x y", "of", "z"]
    out = [(None, None), ("en", ""), ("en", " \t.,\n"), (None, "Solo"), ("fr", "a a a a a a a a a a")]
    for k in range(150):
        parts = [" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(1, 6))) for _ in range(rng.randint(1, 12))]
        parts += ["New  York\tstock exchange of the"] * (k % 3)
        out.append((rng.choice(["en", "en", "fr", None]), "".join(p + rng.choice(" .,;:!?\n\x0b\x0c\r") for p in parts)))
    return out + [out[-1]] * 3 + [("en", prose(20_000))]


def frame(table, rows):
    langs = [r[0] for r in rows]
    docs = table([(k, r[1]) for k, r in enumerate(rows)])
    return docs.withColumn("lang", F.element_at(F.array(*map(F.lit, langs)), (F.col("doc_id") + 1).cast("int")))


@pytest.mark.parametrize("room", [{}, {"full": 40, "burst": 5, "bits": 1 << 12}])
def test_equals_plain_counting(table, rows, room):
    got = c.collocations(frame(table, rows), least=4, longest=5, top=40, **room)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = expected(rows, 4, 5, 40)
    assert sorted(map(tuple, got.collect())) == want and len({w[0] for w in want}) == 3


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    sql = "CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))"
    row = spark.createDataFrame([(big - 7, big * 3 + 1, big - 7, big - 9)], "a long, n long, l long, r long")
    got = row.selectExpr(f"({sql}) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS score").first().score
    assert got == 1000 * (big - 7) * (big * 3 + 1) // ((big - 7) * (big - 9))


def test_nothing_to_count(table):
    assert c.collocations(table([])).collect() == []
    assert c.collocations(table([(1, None), (2, " , "), (3, "one two")]), least=1).count() == 1


def test_windows_of_a_text_in_stretches(monkeypatch):
    monkeypatch.setattr(c, "AT_ONCE", 7)
    rng = random.Random(4)
    words = [rng.choice(["a", "b", "c", ","]) for _ in range(500)]
    whole = np.full(1 << 12, 255, dtype=np.uint8)
    counting = c.Counting("en", [3, 4], whole, whole, 20, 4)
    runs = list(counting.add([" ".join(words), "b a"])) + list(counting.spilled(0))
    got = Counter()
    for _, head, items in runs:
        for tail, n in items:
            got[(head + b" " + tail).decode()] += n
    pieces = [p.split() for p in " ".join(words).split(",")]
    assert got == Counter(" ".join(p[i : i + k]) for k in (3, 4) for p in pieces for i in range(len(p) - k + 1))


def test_a_hot_first_word_goes_to_several_partitions():
    items = [(b"t%d" % k, k + 1) for k in range(500)]
    runs = [("en", b"the", items), ("en", b"of", items)]
    rows = [r for b in c._rows(iter(runs), {("en", b"the"): 8}, 16) for r in b.to_pylist()]
    back, where = {}, {}
    for r in rows:
        assert r["phrases"].split("\n") == sorted(r["phrases"].split("\n"))
        for phrase, n in zip(r["phrases"].split("\n"), r["counts"]):
            assert phrase not in back
            back[phrase] = n
            where.setdefault(phrase.split()[0], set()).add(r["bucket"])
    assert back == {f"{h} t{k}": k + 1 for h in ("the", "of") for k in range(500)}
    assert len(where["the"]) == 8 and len(where["of"]) == 1


def test_a_forgotten_vocabulary_loses_nothing(monkeypatch):
    monkeypatch.setattr(c, "VOCABULARY", 4)
    monkeypatch.setattr(c, "AT_ONCE", 9)
    whole = np.full(1 << 12, 255, dtype=np.uint8)
    words = [random.Random(6).choice("abcdefgh") for _ in range(1)] + [random.Random(k).choice("abcdefgh") for k in range(300)]
    counting = c.Counting("en", [2], whole, None, 20, 4)
    got = Counter()
    for _, head, items in [*counting.add([" ".join(words)]), *counting.spilled(0)]:
        for tail, n in items:
            got[(head + b" " + tail).decode()] += n
    assert got == Counter(map(" ".join, zip(words, words[1:])))
