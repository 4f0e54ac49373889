"""Token counts, packing, chat roles and PII surrogates."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm.chat_format import FEATURES, LINE_SPAN, ROLES, STATES, Model, features, fit, format_chats, raw_transcripts, recovered_lines
from tallyhouse.llm.packing import best_fit, pack_tokens
from tallyhouse.llm.pii import replace_pii, surrogates
from tallyhouse.llm.token_counts import Encoder, token_counts, vocabulary_path

PIECES = [
    "the ", " word", "<|endoftext|>", "  ", "\n", "\n\n  ", "don't", "é", "\u00a0", "\u3000 ", "   ", "1234", "!!!", "日本語", "a" * 40, "\t", "x", "🙂", "<|endof", "text|>", "\x1c", "\x85 ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.mark.parametrize(("chunk", "overlap"), [(65_536, 256), (90, 8), (200, 150)])
def test_spliced_ids_equal_the_library(library, chunk, overlap):
    rng = random.Random(chunk)
    encoder = Encoder(vocabulary_path(), chunk=chunk, overlap=overlap)
    for _ in range(400):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 150)))
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == want
    for text in ["b" * 3_000, " " * 2_000 + "x", "ab " * 900, "<|endoftext|>" * 60, "-" * 70_000, "word " * 30_000]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == want


def test_counts(library, table, odd_rows):
    rows = [*odd_rows, (2**60 + 1, "big id <|endoftext|>")]
    got = token_counts(table(rows), limit=5).collect()
    want = Counter()
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[doc_id, len((text or "").encode()), n, n > 5] += 1
    assert Counter(map(tuple, got)) == want
    assert token_counts(table([])).collect() == []


def test_best_fit_takes_the_fullest_row():
    rng = random.Random(0)
    for _ in range(50):
        lengths = sorted((rng.randint(1, 20) for _ in range(60)), reverse=True)
        free, want = [], []
        for n in lengths:
            fits = [f for f in free if f >= n]
            want.append(min(fits) if fits else None)
            if fits:
                free.remove(min(fits))
            free.append((min(fits) if fits else 20) - n)
        rows = best_fit(lengths, 20)
        assert sorted(20 - sum(lengths[k] for k in r) for r in rows) == sorted(free)
        assert sorted(k for r in rows for k in r) == list(range(60))


def test_packing_gives_every_document_back(library, table, odd_rows, prose):
    rows = [*odd_rows, *((100 + k, prose(k * 3)) for k in range(60)), (2**60 + 1, "x <|endoftext|> y")]
    packed = pack_tokens(table(rows), capacity=64, shard_bytes=20_000).collect()
    parts = defaultdict(list)
    for r in packed:
        ids, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert (ids[r.n_tokens :] == 50256).all()
        for doc, segment, a, b in zip(r.doc_ids, r.segments, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            parts[doc, segment].append(ids[a:b].tolist())
    library.encode_special_tokens = True
    want = defaultdict(list)
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 50256]
        for k in range(0, len(ids), 64):
            want[doc, k // 64].append(ids[k : k + 64])
    library.encode_special_tokens = False
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    again = pack_tokens(table(rows, parts=5), capacity=64, shard_bytes=20_000).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, packed))
    assert pack_tokens(table([])).collect() == []


def test_roles_of_held_out_conversations(spark, sf_dir):
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    fold = F.pmod(F.xxhash64("conv_id"), F.lit(2)) == 0
    model = fit(raw_transcripts(told.where(fold)))
    lines = raw_transcripts(told.where(~fold))
    truth = {(str(r.conv_id), r.line_no): r.role for r in lines.collect()}
    got = recovered_lines(lines, model).collect()
    assert len(got) == len(truth)
    assert sum(truth[r.conv, r.line_no] == r.role for r in got) > 0.9 * len(got)


def test_segments_change_nothing(spark, sf_dir):
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    one = told.withColumn("turn", F.col("conv_id") * 50 + F.col("turn")).withColumn("conv_id", F.lit(1).cast("long"))
    lines = raw_transcripts(told.unionByName(one))
    model = fit(lines)
    whole, parts = format_chats(lines, model, LINE_SPAN * 10**9), format_chats(lines, model, LINE_SPAN * 3)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, parts.collect()))


def test_roles_equal_the_best_of_all_paths(spark):
    """Every sequence of states of short chats, scored one by one; segments of one, two and all lines."""
    draw = np.random.default_rng(2)
    size = len(STATES)
    table = {n: np.log(draw.dirichlet(np.ones(k), size)) for n, k in FEATURES.items()}
    model = Model(np.log(draw.dirichlet(np.ones(size))), np.log(draw.dirichlet(np.ones(size), size)), table)
    said = ["User: what?", "Assistant: it is.", "and so on", "", "[system] Be brief.", "Why?", "1 2 3"]
    rows = [(c, k, random.Random(c * 10 + k).choice(said)) for c in range(12) for k in range(1 + c % 5)]
    lines = spark.createDataFrame(rows, "conv_id long, line_no long, line string")
    shown = {(r.conv_id, r.line_no): r for r in lines.select("*", *[v.alias(n) for n, v in features(F.col("line")).items()]).collect()}
    want = {}
    for c in range(12):
        chat = [shown[c, k] for k in range(1 + c % 5)]

        def score(path):
            total = model.first[path[0]] + sum(model.step[a, b] for a, b in zip(path, path[1:]))
            return total + sum(table[n][s, r[n]] for s, r in zip(path, chat) for n in FEATURES)

        best = max(itertools.product(range(size), repeat=len(chat)), key=score)
        want |= {(str(c), k): STATES[s][0] for k, s in enumerate(best)}
    for span in (1, 2, 1000):
        got = {(r.conv, r.line_no): r.role for r in recovered_lines(lines, model, span).collect()}
        assert got == want and set(want.values()) == set(ROLES)


def test_odd_chats(spark):
    kind = "conv_id long, turn long, role string, text string, line string"
    rows = [(1, 0, "user", "hi?", "x"), (1, 0, "user", "hi?", "x"), (1, None, None, None, None), (None, 0, "assistant", "", "y"), (2, 1, "other", "a\n\nb", "z")]
    lines = raw_transcripts(spark.createDataFrame(rows, kind))
    model = fit(lines)
    got = format_chats(lines, model).collect()
    assert sum(r.n_lines for r in got) == lines.count() and all(r.rendered.endswith("<|end|>") for r in got)
    assert {r.conv_id for r in got} == {1, 2, None}
    assert format_chats(lines.limit(0), fit(lines.limit(0))).collect() == []


def test_markers_decide_and_go(spark):
    lines = [(5, k, t) for k, t in enumerate(["User: what is it?", "more", "Assistant: this.", "and that.", "[user] ok", "**Assistant:** bye."])]
    said = ["What is it?\nmore", "this.\nand that.", "ok", "Line of it.\nMore of it.", "why?", "so it is.\nMore"]
    told = [(c, t, r, said[(c + t) % 6]) for c in range(60) for t, r in enumerate(["user", "assistant"] * 3)]
    model = fit(raw_transcripts(spark.createDataFrame(told, "conv_id long, turn long, role string, text string")))
    got = format_chats(spark.createDataFrame(lines, "conv_id long, line_no long, line string"), model, 1000).orderBy("first_line").collect()
    assert [r.role for r in got] == ["user", "assistant", "user", "assistant"]
    assert got[0].rendered == "<|user|>\nwhat is it?\nmore\n<|end|>" and got[3].rendered == "<|assistant|>\nbye.\n<|end|>"


PII = (
    "Mail Bob@X.example.com or bob@x.example.com from 10.0.0.255 with 4111 1111 1111 1111 or 4111111111111111. "
    "Call +1 (017) 555-7713, Mr. John Smith, Frau Anna Weber, г-н Иван Петров. IBAN DE89 3704 0044 0532 0130 00 end."
)


def test_surrogates_keep_type_format_and_coreference(table, odd_rows):
    rows = [*odd_rows, (50, PII), (51, PII), (52, "again bob@x.example.com. amy@x.example.com")]
    got = replace_pii(table(rows), "key").select("doc_id", "text", "n_entities").collect()
    texts = {r.doc_id: r.text for r in got if r.doc_id is not None}
    new = texts[50]
    assert new == texts[51] and len(got) == len(rows)
    for real in ["bob@", "Bob@", "10.0.0.255", "4111 1111", "555-7713", "Smith", "Anna", "Петров", "DE89 3704"]:
        assert real not in new
    pattern = (
        r"Mail (\S+@\S+\.com) or (\S+@\S+\.com) from (\d+\.\d+\.\d+\.\d+) with (4\d{3} \d{4} \d{4} \d{4}) or (4\d{15})\. "
        r"Call \+1 \(\d{3}\) \d{3}-\d{4}, Mr\. [A-Z][a-z]+ [A-Z][a-z]+, Frau [A-Z][a-z]+ [A-Z][a-z]+, г-н [А-Я][а-я]+ [А-Я][а-я]+\. "
        r"IBAN DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d end\."
    )
    m = re.fullmatch(pattern, new)
    assert m and m[1] == m[2] and m[4].replace(" ", "") == m[5] and all(int(x) < 256 for x in m[3].split("."))
    a, b = re.findall(r"\S+@[a-z.]+\w", texts[52])
    assert a == m[2] and b != a and a.split("@")[1] == b.split("@")[1]
    unchanged = Counter((r[0], r[1]) for r in odd_rows)
    assert Counter((r.doc_id, r.text) for r in got if r.n_entities == 0) == unchanged
    other = {r.doc_id: r.text for r in replace_pii(table(rows), "other").collect()}
    assert other[50] != new
    assert replace_pii(table([]), "key").collect() == []


def test_surrogates_are_distinct_and_nobodys(spark):
    # 3-digit numbers of one first digit: a hundred values for forty entities
    rows = [("phone", f"7{k:02}") for k in range(40)]
    got = surrogates(spark.createDataFrame(rows, "kind string, value string"), "k").collect()
    assert len({r.surrogate for r in got}) == 40
    assert not {r.surrogate for r in got} & {v for _, v in rows}


@pytest.mark.parametrize("count", [60, 99, 100])
def test_a_crowded_format_still_gets_distinct_surrogates(spark, count):
    rows = [("phone", f"7{k:02}") for k in range(count)] + [("phone", "55512345")]
    got = surrogates(spark.createDataFrame(rows, "kind string, value string"), "k", draws=6).collect()
    assert len(got) == len({r.surrogate for r in got}) == count + 1
    assert all(r.surrogate != r.value and len(r.surrogate) == len(r.value) for r in got)


def test_scripts_are_kept(table):
    text = "Frau Ёлка Королёва, Mr. Γιώργος Παπάς, г-н Пётр Королёв"
    new = replace_pii(table([(1, text)]), "key").first().text
    assert re.fullmatch(r"Frau [А-Я][а-я]+ [А-Я][а-я]+, Mr\. \w+ [Α-Ω][α-ω]+, г-н [А-Я][а-я]+ [А-Я][а-я]+", new), new


def test_other_columns_stay_beside_surrogates(table, clashing):
    out = replace_pii(table([(1, "mail a@b.example.com"), (2, "none")]), "key")
    assert all(r[name] == name for r in out.collect() for name in clashing)
