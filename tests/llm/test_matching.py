"""Jaccard join, decontamination and URL rules against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm.components import components
from tallyhouse.llm.decontamination import Index, decontaminated, edit_distance, leaks, plain_words
from tallyhouse.llm.jaccard_join import jaccard_sets, one_per_group
from tallyhouse.llm.url_filters import RULES, UNIT, judge_urls


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[k:] for k in range(width))))


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return Counter(
        (doc_id, len(sets[i]), (min(least[root(i)]) if least[root(i)] else None) if sets[i] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    )


def family(rng, base, n, edits):
    """Copies of a text with up to `edits` words changed."""
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("cell_docs", [1_500, 5])
@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(table, prose, odd_rows, width, percent, cell_docs):
    rng = random.Random(width)
    passage = prose(60)
    texts = [prose(rng.randint(1, 120)) for _ in range(40)]
    texts += family(rng, prose(90), 45, 3) + family(rng, prose(200), 30, 12) + family(rng, prose(30), 12, 1)
    texts += [passage + " " + prose(rng.randint(5, 40)) for _ in range(30)] + ["SAME words Here ok", "same WORDS here ok", "a b c", "a b"]
    rows = [(1000 + k, t) for k, t in enumerate(texts)] + [r for r in odd_rows if len(r[1] or "") < 5_000]
    rng.shuffle(rows)
    got = jaccard_sets(table(rows, parts=4), width, percent, cell_docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, width, percent)


def test_large_cells_recurse_without_losing_links(spark, table, prose):
    rng = random.Random(5)
    texts = [t for _ in range(6) for t in family(rng, prose(60), 110, 5)]
    rows = list(enumerate(texts))
    got = jaccard_sets(table(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4, 85)


def test_one_per_group(table, prose, odd_rows):
    base = prose(100)
    rows = [(10, base), (11, base), (12, base + " end"), (13, prose(50)), *odd_rows]
    kept = Counter(r.doc_id for r in one_per_group(table(rows)).collect())
    assert kept == Counter({None: 1, 1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 7: 1, 10: 1, 13: 1})
    assert one_per_group(table([])).collect() == []
    assert one_per_group(table(rows)).columns == table(rows).columns


def test_one_per_group_chooses_between_rows(table, prose):
    a, b = prose(60), prose(60)
    kept = one_per_group(table([(1, a), (4, a), (4, b), (4, b), (None, b), (None, a), (None, a + " x"), (7, None), (7, None), (None, prose(30))]))
    rows = Counter((r.doc_id, r.text) for r in kept.collect())
    assert rows[1, a] == rows[4, b] == 1 and rows[7, None] == 2
    assert sum(rows.values()) == 5 and sum(n for (i, _), n in rows.items() if i is None) == 1
    assert [r.part for r in kept.collect()] == ["part"] * 5


def test_a_text_that_is_less_than_an_item(prose):
    words = prose(20).split()
    index = Index([(7, " ".join(words))], 0.2, 0.999, 3)
    for cut, place in ((words[:-1], (0, 19, 1)), (words[1:], (0, 19, 1)), (words[2:-1], (0, 17, 3)), (words, (0, 20, 0))):
        [(_, item, start, end, d)] = index.search([" ".join(cut)])
        assert (item, start, end, d) == (7, *place)
    assert index.search([" ".join(words[:15]), "", words[0]]) == []


def test_long_items_reach_the_target_recall(monkeypatch, prose):
    from tallyhouse.llm import decontamination

    monkeypatch.setattr(decontamination, "STEP", 5)
    index = Index([(1, prose(300))], 0.2, 0.98, 3)
    walks = index.walks[300]
    assert len(walks) > 10 and len(walks[0][0].keys(np.zeros((1, 300), dtype=np.int64))) > 0


def test_other_columns_keep_their_values(spark, table, prose, clashing):
    rows = [(k, prose(40)) for k in range(6)]
    items = spark.createDataFrame([(1, prose(20))], "item_id long, text string")
    for out in (decontaminated(table(rows), items), leaks(table(rows), items)):
        for r in out.collect():
            assert all(r[name] == name for name in clashing)
    assert [r.leaks for r in decontaminated(table(rows), items).collect()] == ["b"] * 6


def test_components(spark):
    edges = [(f"{a:03}", f"{b:03}") for a, b in [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (100, 102), (7, 7)]]
    got = components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {(r.node, r.root) for r in got} == {(f"{k:03}", "000") for k in range(61)} | {(f"{k}", "100") for k in (100, 101, 102)}
    assert len(got) == 64


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = rng.integers(0, 4, rng.integers(0, 12)), rng.integers(0, 4, rng.integers(0, 12))
        most = int(rng.integers(0, 8))
        assert edit_distance(a, b, most) == min(levenshtein(a.tolist(), b.tolist()), most + 1)


def test_leaks_are_found_up_to_the_distance(spark, table, prose, odd_rows):
    rng = random.Random(4)
    items = [(k, prose(rng.randint(14, 50))) for k in range(40)] + [(90, None), (91, ""), (92, "  "), (None, prose(20))]
    rows, planted = list(odd_rows), {}
    for k in range(200):
        item_id, text = items[rng.randrange(40)]
        w = text.split()
        for _ in range(rng.randint(0, int(0.2 * len(w)) // 2)):
            w[rng.randrange(len(w))] = "other"
        rows.append((1000 + k, prose(30) + " " + " ".join(w).upper() + ". " + prose(30)))
        planted[1000 + k] = item_id
    rows += [(5000 + k, prose(150)) for k in range(100)]
    got = {r.doc_id: r.leaks for r in leaks(table(rows), spark.createDataFrame(items, "item_id long, text string"), block_items=15).collect()}
    found = sum(any(x.item_id == item for x in got[doc]) for doc, item in planted.items())
    assert found >= 0.98 * len(planted)
    assert not any(got[5000 + k] for k in range(100))
    words = {i: plain_words(t) for i, t in items}
    texts = {i: plain_words(t) for i, t in rows}
    for doc, hits in got.items():
        for x in hits:
            window = texts[doc][x.start : x.end]
            assert len(window) == len(words[x.item_id])
            assert levenshtein(window, words[x.item_id]) == x.distance <= 0.2 * len(window)
    clean = decontaminated(table(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in clean.collect()} == {d for d, hits in got.items() if not hits}
    assert clean.columns == table(rows).columns


def test_index_misses_nothing_that_windows_allow(prose):
    items = [(k, prose(20)) for k in range(30)]
    index = Index(items, 0.2, 0.98, 3)
    rng = random.Random(9)
    met = 0
    for _ in range(200):
        k = rng.randrange(30)
        w = items[k][1].split()
        for _ in range(4):
            w[rng.randrange(20)] = "zz"
        met += any(i == k for _, i, *_ in index.search([" ".join(w)]))
    assert met >= 190


def test_empty_benchmark_and_table(spark, table):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.leaks for r in leaks(table([(1, "a b")]), none).collect()] == [[]]
    assert leaks(table([]), none).collect() == []


def plain_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://a.org/x", "HTTP://A.Org?x=1", "https://m.example.org/es/1?q#f", "x://example.org/en/12", "http://b.com/fr/", "http://B.COM/de/x#y",
    "http://c.net", "no scheme", "", None, "http://É.org/p", "a://b://c.org/d", "http://evil.net/1", "http://friend.net/", "http://notorg/",
]


def test_urls_and_rules(spark):
    rows = [(k, u, None) for k, u in enumerate([*URLS, "http://a.org/x"])] + [(None, "http://a.org/x", "<p>")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"))
    want = []
    for page, url, _ in rows:
        host, path = plain_url(url)
        want.append((page, host, path, plain_rule(host, path)[0]))
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_distrust_runs_against_links_and_trust_along_them(spark):
    rows = [
        (1, "http://bad.com/de/", ""),
        (2, "http://farm.net/1", '<a href="http://bad.com/x">x</a>'),
        (3, "http://good.org/", '<a href="//friend.net/">y</a>'),
        (4, "http://friend.net/a", None),
        (5, "http://alone.net/a", "unknown.net"),
    ]
    pages = spark.createDataFrame(rows * 3, "page_id long, url string, html string")
    got = {r.page_id: r for r in judge_urls(pages).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}
    assert got[2].distrust > 0 and got[4].trust > 0 and got[5].trust == got[5].distrust == 0
    assert judge_urls(pages.limit(0)).collect() == []


def plain_ranks(n, links, seeds, damping=0.85):
    """Personalised PageRank by plain power iteration over weighted links."""
    move = np.zeros((n, n))
    for (a, b), weight in links.items():
        move[a, b] = weight
    out = move.sum(axis=1, keepdims=True)
    move = np.divide(move, out, out=np.zeros_like(move), where=out > 0)
    start = (1 - damping) * seeds / max(seeds.sum(), 1)
    ranks = start
    for _ in range(300):
        ranks = start + damping * ranks @ move
    return ranks


def test_scores_equal_power_iteration(spark):
    rng = random.Random(6)
    hosts = [f"h{k}.{'org' if k % 7 == 0 else 'com' if k % 5 == 0 else 'net'}" for k in range(40)]
    rows, links, trust, distrust = [], Counter(), np.zeros(40), np.zeros(40)
    for page in range(160):
        a = rng.randrange(40)
        path = rng.choice(["/de/x", "/fr/x", "/x"])
        # one host takes part in a third of all links
        named = {0 if rng.random() < 0.3 else rng.randrange(40) for _ in range(rng.randint(0, 4))}
        rows.append((page, f"http://{hosts[a]}{path}", " ".join(f'<a href="//{hosts[b]}/y">' for b in named)))
        links.update((a, b) for b in named if a != b)
        action = plain_rule(hosts[a], path)[1]
        trust[a] += action == "allow"
        distrust[a] += action == "block"
    known = {plain_url(r[1])[0] for r in rows}
    links = Counter({(a, b): n for (a, b), n in links.items() if hosts[b] in known})
    good, bad = plain_ranks(40, links, trust), plain_ranks(40, {(b, a): n for (a, b), n in links.items()}, distrust)
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and (good > 0).sum() > 20 and (bad > 0).sum() > 20
    for r in got:
        k = hosts.index(r.host)
        assert abs(r.trust / UNIT - good[k]) < 1e-5 and abs(r.distrust / UNIT - bad[k]) < 1e-5
        if r.rule is None and abs(good[k] - bad[k]) > 2e-5:
            assert r.verdict == ("block" if bad[k] > good[k] else "allow")


def test_links_name_hosts_as_urls_do(spark):
    rows = [(1, "http://bad.com/de/", ""), (2, "http://open.com:8080/de/", "bad.com")]
    rows += [(3, "http://one.net/", "see http://OPEN.com:8080/x"), (4, "http://two_a.net/", "bad.com."), (5, "http://three.net/", "<a href='//two_a.net?q'>")]
    rows += [(6, "http://é.net/", "http://three.net#x"), (7, "http://four/", '"//é.net/"'), (8, "http://five.net", "x//four\\n")]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(r.distrust > 0 for r in got.values()), got
    assert {r.verdict for r in got.values()} == {"block"}
