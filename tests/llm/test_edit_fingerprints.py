"""Edit fingerprints against a walk in plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import edit_fingerprints as e


def plain_print(text):
    """One step at a time."""
    out, at, step = [], 0, 0
    steps = set(e.sample_steps(1 << 20).tolist())
    marks = e.classes(text)
    while at < len(text) and step < 3 * len(text):
        if step % e.BLOCK == 0:
            bits = e.moves(step)
        if step in steps:
            out.append(e.SYMBOLS[marks[at]])
        at += int(bits[step % e.BLOCK, marks[at]])
        step += 1
    return "".join(out)


def test_walks_equal_single_steps(prose):
    rng = random.Random(3)
    texts = ["", "a", "é🙂\U0010ffff", "x" * 200, prose(900), prose(40), prose(3)] + [prose(rng.randint(1, 60)) for _ in range(30)]
    assert e.walks([e.classes(t) for t in texts]) == [plain_print(t) for t in texts]
    assert [e.fingerprint(t) for t in texts] == [plain_print(t) for t in texts]


def test_likeness_follows_edits(prose):
    rng = random.Random(8)
    means = []
    for edits in (0, 2, 12, 80):
        found = []
        for _ in range(25):
            text = prose(200)
            other = list(text)
            for _ in range(edits):
                k = rng.randrange(len(other))
                other[k : k + rng.randint(0, 1)] = rng.choice(["", "q", "qq"])
            found.append(e.likeness(e.fingerprint(text), e.fingerprint("".join(other))))
        means.append(float(np.mean(found)))
    assert means[0] == 1 and means[1] > 0.85 and means == sorted(means, reverse=True)
    apart = [e.likeness(e.fingerprint(prose(200)), e.fingerprint(prose(200))) for _ in range(20)]
    assert max(apart) < 0.35 < means[2]
    assert e.likeness("", "") == 1 and e.likeness("", "a") == 0


def order(row):
    doc_id, text = row
    return (doc_id is not None, doc_id or 0, e._tie((text or "").encode()))


@pytest.mark.parametrize("room", [{}, {"ranges": 1}, {"ranges": 40, "at_once": 300}])
def test_edited_text_of_the_next_document(table, odd_rows, prose, room):
    rows = [(k * 7 % 101 + 20, prose(k % 9)) for k in range(60)] + odd_rows + [(50, None), (50, prose(4)), (50, prose(5))]
    distinct = sorted({(i, t or "") for i, t in rows}, key=order)
    after = dict(zip(distinct, distinct[1:] + distinct[:1]))
    want = []
    for doc_id, text in rows:
        text = text or ""
        following = after[doc_id, text][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, ahead = e.fingerprint(text), e.fingerprint(changed), e.fingerprint(following)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        want.append((doc_id, len(text), digest, own, other, e.likeness(own, other), e.likeness(own, ahead)))
    got = e.edit_fingerprints(table(rows), **room).drop("text_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_one_document_and_none(table):
    [row] = e.fingerprint_classes(table([(4, "abcd")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1 and row.class_id == 4
    assert e.fingerprint_classes(table([])).collect() == []


def plain_classes(rows):
    """Least text of each band, whole fingerprints compared, links followed."""
    texts = {hashlib.sha256(t.encode()).digest()[:16]: e.fingerprint(t) for _, t in rows if t}
    met = {}
    for key, mark in texts.items():
        for band in e.bands(mark):
            met.setdefault(band, []).append(key)
    group = {k: {k} for k in texts}
    for keys in met.values():
        for key in keys:
            if e.likeness(texts[key], texts[min(keys)]) >= e.LIKENESS and group[key] is not group[min(keys)]:
                both = group[key] | group[min(keys)]
                for k in both:
                    group[k] = both
    ids = {}
    for doc_id, text in rows:
        if text and doc_id is not None:
            ids.setdefault(hashlib.sha256(text.encode()).digest()[:16], []).append(doc_id)
    out = []
    for doc_id, text in rows:
        key = hashlib.sha256((text or "").encode()).digest()[:16]
        members = [i for k in group[key] for i in ids.get(k, [])] if text else [doc_id]
        out.append((doc_id, min(members, default=None)))
    return out


def test_classes_of_copies(table, prose, odd_rows):
    rng = random.Random(12)
    rows = list(odd_rows)
    planted = []
    for k in range(12):
        text = prose(300)
        first = 100 + 20 * k
        rows += [(first, text), (first + 1, text)]
        for n in range(2, 5):
            other = list(text)
            for _ in range(n):
                other[rng.randrange(len(other))] = "q"
            rows.append((first + n, "".join(other)))
            planted.append((first + n, first))
    rows += [(1000 + k, prose(250)) for k in range(40)]
    got = [(r.doc_id, r.class_id) for r in e.fingerprint_classes(table(rows)).select("doc_id", "class_id").collect()]
    assert sorted(got, key=repr) == sorted(plain_classes(rows), key=repr)
    found = dict(got)
    assert sum(found[a] == b for a, b in planted) >= 0.9 * len(planted)
    assert all(found[1000 + k] == 1000 + k for k in range(40))


def linked(spark, prints, **options):
    """Groups of linked places in a list of fingerprints."""
    keys = [b"%08d" % k for k in range(len(prints))]
    rows = spark.createDataFrame(list(zip(map(bytearray, keys), prints)), "key binary, fingerprint string")
    root = {bytes(r.node): bytes(r.root) for r in e.like_texts(rows, **options).collect()}
    groups = {}
    for k, key in enumerate(keys):
        groups.setdefault(root.get(key, key), set()).add(k)
    return sorted(map(sorted, groups.values()))


def all_linked(prints):
    """The same by comparing all pairs."""
    group = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if e.likeness(prints[a], prints[b]) >= e.LIKENESS:
                group = [group[b] if g == group[a] else g for g in group]
    groups = {}
    for k, g in enumerate(group):
        groups.setdefault(g, set()).add(k)
    return sorted(map(sorted, groups.values()))


def changed_print(rng, print_, share):
    out = [rng.choice("xyz") if rng.random() < share else c for c in print_]
    return "".join(out)[: len(out) - rng.randint(0, 3)]


@pytest.mark.parametrize("chunk", [e.CHUNK, 2])
def test_links_beside_the_least_text_of_a_band(spark, chunk):
    rng = random.Random(5)
    first = "".join(rng.choice("abcdefgh") for _ in range(5 * e.SAMPLES))
    second = "".join("z" if k % 10 == 9 else c for k, c in enumerate(first))
    # each band that the two share has a least text that is like neither
    pivots = []
    for scale in (4, 3):
        for places in e.band_places(scale):
            pivot = [rng.choice("ABCDEFGH") for _ in first]
            for k in places:
                pivot[k] = first[k]
            pivots.append("".join(pivot))
    prints = [*pivots, first, second]
    want = all_linked(prints)
    assert want == [[k] for k in range(len(pivots))] + [[len(pivots), len(pivots) + 1]]
    assert linked(spark, prints, chunk=chunk) == want


def test_no_link_between_short_texts_is_lost(spark):
    rng = random.Random(9)
    prints = []
    for _ in range(60):
        base = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, e.SHORT)))
        prints += [base, *(changed_print(rng, base, rng.choice([0.1, 0.2, 0.25])) for _ in range(3))]
    prints = list(dict.fromkeys(p for p in prints if p))
    assert linked(spark, prints) == all_linked(prints)


def test_chance_meetings_do_not_grow_with_the_square(monkeypatch):
    monkeypatch.setattr(e, "FEW", 400)
    rng = random.Random(4)
    per_text = []
    for count in (2000, 10_000):
        rows, met = e.rows_for(count), {}
        for k in range(count):
            print_ = "".join(rng.choices("abcdefg", k=3 * e.SAMPLES))
            for band in e.bands(print_, rows=rows):
                met.setdefault(band, []).append(k)
        per_text.append(sum(len(texts) - 1 for texts in met.values()) / count)
    # five times as many texts
    assert per_text[1] < 2 * per_text[0]


def test_longer_bands_miss_no_more():
    assert (e.rows_for(0), e.rows_for(e.FEW), e.bands_for(e.ROWS)) == (e.ROWS, e.ROWS, e.BANDS)
    for alike in (e.LEAST_ALIKE, e.LIKENESS, 0.9):
        missed = [(1 - alike**rows) ** e.bands_for(rows) for rows in range(e.ROWS, e.ROWS + 8)]
        assert max(missed) <= missed[0]
    assert e.rows_for(1 << 24) > e.rows_for(1 << 18) > e.ROWS


def test_texts_of_a_band_over_several_batches():
    rng = random.Random(6)
    rows = sorted((rng.randint(0, 30), b"%04d" % rng.randint(0, 40)) for _ in range(300))
    want = []
    for band in sorted({b for b, _ in rows}):
        keys = sorted({k for b, k in rows if b == band})
        want += [(band, key, keys[0]) for key in keys[1:]]
    for size in (1, 2, 7, 300):
        parts = [rows[a : a + size] for a in range(0, len(rows), size)]
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), (pa.int64(), pa.binary()))], names=["band", "key"])
            for part in parts
        ]
        found = [tuple(r.values()) for batch in e._meeting(iter(batches)) for r in batch.to_pylist()]
        assert found == want
