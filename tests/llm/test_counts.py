"""Token counts, periodic runs and collocations against the libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from passagework.llm import collocations, periodic_runs, queries, token_counts

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CLASH = ("n", "w1", "w2", "w3", "f", "a", "words", "start", "counts", "runs", "collapsed", "rank", "_bucket")


def sha(body):
    return hashlib.sha256(body if isinstance(body, bytes) else body.encode()).hexdigest()


def clashing(df):
    return df.withColumns({n: F.lit(f"own {n}") for n in CLASH})


# token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(token_counts.read_vocabulary(VOCABULARY))


def prefixes(tokenizer, text):
    return [len(e.ids) for e in tokenizer.encode_batch([text[:i + 1] for i in range(len(text))], add_special_tokens=False)]


PARTS = [*"abcdelstrv '\n\t.,!?-=0159éüß中日😀\x1c\x85\xa0", "  ", "    ", "'s", "'re", "'ve", "'ll", "'d", "<|endoftext|>", " <|endof", "====", "the", " of"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_counts_of_all_prefixes(tokenizer, counter, text):
    assert counter.counts(text) == prefixes(tokenizer, text)


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=30))
def test_counts_of_any_text(tokenizer, counter, text):
    assert counter.counts(text) == prefixes(tokenizer, text)


def test_prefix_counts(spark, tokenizer):
    texts = [None, "", " ", "a", "It's  we'll\n\n they've", "x" * 5000, "one<|endoftext|>two <|endoftext|>", "中文 text " * 400, " " * 300 + "a"] * 2
    df = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    found = token_counts.prefix_counts(df, VOCABULARY)
    assert set(found.columns) == set(df.columns)
    for r in found.select("text", "counts", "n").collect():
        assert r["counts"] == prefixes(tokenizer, r["text"] or "") and r["n"] == "own n"
    assert token_counts.prefix_counts(df.limit(0), VOCABULARY).count() == 0


def test_answers_without_encoding(spark, tokenizer):
    text = "It's what we'll do:  they’ve counted 1234567 tokens,\n\n and 中文 too. " * 4
    df = token_counts.prefix_counts(spark.createDataFrame([(text,), (None,)], "text string"), VOCABULARY)
    counts = prefixes(tokenizer, text)
    for k in (0, 1, 7, 40, 10_000):
        row = df.filter("text IS NOT NULL").select(
            token_counts.tokens_of_first(F.col("counts"), k).alias("tokens"),
            token_counts.longest_within(F.col("counts"), k).alias("characters"),
            token_counts.budget_cuts(F.col("counts"), max(k, 1)).alias("cuts"),
            token_counts.total_tokens(F.col("counts")).alias("total")).first()
        assert row["tokens"] == ([0, *counts][min(k, len(counts))])
        assert row["characters"] == max((i + 1 for i, n in enumerate(counts) if n <= k), default=0)
        assert row["cuts"][-1] == len(text) and row["cuts"] == sorted(set(row["cuts"])) and row["total"] == counts[-1]
        edges = [0, *row["cuts"]]
        whole = [0, *counts]
        for a, b in zip(edges, edges[1:]):
            assert b == a + 1 or all(whole[i] - whole[a] <= max(k, 1) for i in range(a, b + 1))
    empty = df.filter("text IS NULL").select(
        token_counts.longest_within(F.col("counts"), 5), token_counts.budget_cuts(F.col("counts"), 5),
        token_counts.total_tokens(F.col("counts"))).first()
    assert tuple(empty) == (0, [], 0)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_op11(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op11_token_counts(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert tuple(r) == (r["doc_id"], len(texts[r["doc_id"]].encode()), n, n > 512)


# periodic runs


def runs_by_hand(words, least=12):
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, 2 * q) and not any(
                    all(words[k] == words[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                found.append((i, size, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(0, 6), st.integers(2, 13))
def test_runs(head, root, times, least):
    symbols = head[:len(head) // 2] + root * times + head[len(head) // 2:]
    assert [tuple(r) for r in periodic_runs.runs_of(symbols, least).tolist()] == runs_by_hand(symbols, least)


def collapsed_by_hand(words, runs):
    gone = {i for start, size, q in runs for i in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_find_runs(spark):
    rnd = random.Random(4)
    texts = [None, "", " \n", "one", "a " * 12, "a " * 11, "no break x " * 9, "A a " * 6, "ü " * 400 + "b " * 500]
    for _ in range(60):
        words = [f"w{rnd.randrange(rnd.choice((2, 30)))}" for _ in range(rnd.randrange(60))]
        at = rnd.randrange(len(words) + 1)
        words[at:at] = [f"x{rnd.randrange(3)}" for _ in range(rnd.randrange(1, 9))] * rnd.randrange(1, 7)
        texts.append(rnd.choice(("", "\t")) + "\n ".join(words) + rnd.choice(("", " ")))
    long = [f"v{i}" for i in range(700)]
    texts += [" ".join(long * 5 + long[:3] + ["end"] + long)] * 2
    df = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    found = periodic_runs.find_runs(df)
    assert set(found.columns) == set(df.columns)
    for r in found.select("text", "runs", "collapsed").collect():
        words = re.findall(r"[^\x20\x09-\x0d]+", r["text"] or "")
        runs = runs_by_hand(words)
        assert [tuple(x) for x in r["runs"]] == runs
        assert r["collapsed"] == collapsed_by_hand(words, runs)
    assert periodic_runs.find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df, least=1)


def op12_expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_by_hand(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    numbers = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *numbers, sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(collapsed_by_hand(words, runs)))


def test_op12(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    # brute force takes texts of some hundred words; ids are chosen so that many texts become periodic
    short = [(r["doc_id"], r["text"]) for r in docs.filter("length(text) < 2500").collect()]
    ids = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = short + [(ids[k], t) for k, (_, t) in enumerate(short[:60])] + [(ids[70], None), (ids[71], ""), (ids[72], "one"), (None, "a " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    expected = [op12_expected(*r) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sum(r[1] > 0 for r in found) > 50


# collocations


def collocations_by_hand(rows, least=10, percent=50, top=2000):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in (1, 2, 3):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i:i + m])] += 1
    out = []
    for lang in total:
        own = {p: f for (x, p), f in counts.items() if x == lang}
        wide = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        found = []
        for p, a in wide.items():
            if any(len(q) > len(p) and 100 * f >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, f in wide.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        found.sort()
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


def collocation_rows(seed=6):
    rnd = random.Random(seed)
    words = ["New", "york", "City", "the", "of", "É", "é", "x y", "a-b", "<w>", "''", "und"]
    rows = [(None, "en"), ("", None), ("...", "en"), (" \t ", "xx"), ("new york city", "")]
    for _ in range(300):
        text = "".join(rnd.choice(words) + rnd.choice((" ", " ", " ", "\t", "  ", ", ", ".", "\n", "; ")) for _ in range(rnd.randrange(40)))
        rows.append((text + rnd.choice(("", " New York City")), rnd.choice(("en", "en", "de", None, "und"))))
    return rows + [("tick tock " * 3000, "en")] * 3


@pytest.mark.parametrize("limits", [{}, {"top": 7}, {"least": 3, "percent": 90}, {"most_codes": 4}, {"most_codes": 0}])
def test_collocations(spark, limits):
    rows = collocation_rows()
    df = clashing(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    found = collocations.find_collocations(df, **limits)
    assert sorted(tuple(r) for r in found.collect()) == collocations_by_hand(rows, **{k: v for k, v in limits.items() if k != "most_codes"})
    assert collocations.find_collocations(df.limit(0)).count() == 0


@pytest.mark.parametrize("most_codes", [collocations.MOST_CODES, 3])
def test_hot_pairs_are_spread(spark, most_codes):
    """A pair before hundreds of different words, each often enough: it is found to be hot, and the counts stay right."""
    rows = [(f"hot pair w{i % 300} end.", "en") for i in range(3600)] + [("other words here", "de")] * 12
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    codes = collocations.make_codes(collocations.frequent_words(df, "text", "lang", 10), df)
    assert len(collocations.hot_pairs(df, codes, "text", "lang")) == 1
    found = collocations.find_collocations(df, top=400, most_codes=most_codes)
    assert sorted(tuple(r) for r in found.collect()) == collocations_by_hand(rows, top=400)


def test_products_beyond_64_bits(spark):
    n = 10**15
    rows = spark.createDataFrame([(n - 1, n, n + 1)], "a long, l long, r long")
    assert rows.select(collocations._score("l", "r")).first()[0] == 10**6 * (n - 1) ** 2 // (n * (n + 1))


def test_windows(spark):
    """Windows end at pieces and, if all frequent words have a character, before rare words."""
    df = spark.createDataFrame([("a b c. a b c a", "en"), ("x", "en")], "text string, lang string")
    words = spark.createDataFrame([("a", 3), ("b", 2)], "word string, f long")
    a = collocations._character(0)
    codes = collocations.make_codes(words, df, 5)
    assert codes.langs == ["en"]
    for hot in ([], [1 << collocations.BITS | 2]):
        counted, dealt = collocations.count_windows(df.coalesce(1), codes, hot)
        assert dealt == ["p", "part"][:1 + bool(hot)]
        rows = collocations._named(counted, codes).select("lang", "w1", "w2", "w3", "c").collect()
        assert sorted(tuple(r) for r in rows) == [(0, 0, 0, 0, 3), (0, 1, 0, 0, 1), (0, 1, 2, 0, 2), (0, 2, 0, 0, 2)]
    codes = collocations.make_codes(words, df, 1)
    assert codes.langs is None
    counted, _ = collocations.count_windows(df.coalesce(1), codes, [f"{a}\n b\nen"])
    assert sorted(tuple(r) for r in counted.select("lang", "w1", "w2", "w3", "c", F.col("part") >= 0).collect()) == sorted([
        ("en", " c", "", "", 1, False), ("en", " c", a, "", 1, False), ("en", " x", "", "", 1, False), ("en", a, "", "", 1, False),
        ("en", a, " b", " c", 2, True), ("en", " b", " c", "", 1, False), ("en", " b", " c", a, 1, False)])
    found = collocations.phrase_counts(df, least=2)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        ("en", 0, None, None, None, 8), ("en", 1, "a", None, None, 3), ("en", 1, "b", None, None, 2), ("en", 1, "c", None, None, 2),
        ("en", 2, "a", "b", None, 2), ("en", 2, "b", "c", None, 2), ("en", 3, "a", "b", "c", 2)], key=str)
    plan = collocations.phrase_counts(df, least=2)._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan and plan.count("Expand [") == 1 and plan.count("Exchange hash") == 3


def test_characters():
    codes = [0, 1, 0xD6FF, 0xD700, 0xD701, collocations.MOST_CODES - 1]
    assert [collocations._code(collocations._character(c)) for c in codes] == codes
    assert all(collocations._character(c).encode() for c in codes)
