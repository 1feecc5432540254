"""Chat formatting, embeddings, components and the pipeline against brute force."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from passagework.llm import chat_format, embedding_dedup, quality, queries
from passagework.llm.graph import connected_components
from passagework.session import write_once

FOLDER = "/root/testdata/sf0.001"


def components(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(7, 7), (900, 900)]
    df = spark.createDataFrame(edges + [(None, 4)], "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == components(edges)
    assert connected_components(df.limit(0)).count() == 0


# chat


def test_chat_parts_and_masks(spark):
    rows = [(1, i, f"s{i % 3}", f"text é {i}") for i in range(300)] + [(1, 5, "s2", "text é 5")] * 3
    rows += [(2, 0, "system", "be kind"), (2, 1, "a", None), (2, 1, "a", ""), (2, None, None, "first <|im_end|>"), (2, 2, "", "x")]
    rows += [(3, 0, "system", "alone"), (None, 0, "a", "no id"), (4, 0, "b", "long " * 30_000)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumns(
        {n: F.lit(1) for n in ("conv", "part", "number", "view")})
    found = chat_format.rotate_perspectives(df).orderBy("conv_id", "speaker", "part").collect()
    whole = {}
    for r in found:
        assert r["n_messages"] <= 64
        whole.setdefault((r["conv_id"], r["speaker"]), []).append(r)
    expected = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, s or "unknown", x or "") for c, t, s, x in rows if c == conv))
        for view in {m[2] for m in mine} - {"system"}:
            text, own = "", []
            for _, _, s, x in mine:
                who = "system" if s == "system" else "assistant" if s == view else f"user name={s}"
                text += f"<|im_start|>{who}\n{x}<|im_end|>\n"
                own += [x + "<|im_end|>"] if s == view else []
            expected[conv, view] = (text, own)
    assert set(whole) == set(expected)
    for key, parts in whole.items():
        assert "".join(p["rendered"] for p in parts) == expected[key][0]
        assert [p["rendered"][m["start"]:m["end"]] for p in parts for m in p["mask"]] == expected[key][1]
    assert chat_format.rotate_perspectives(df.limit(0)).count() == 0


# embeddings


def near_vectors(seed=2):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (0, 1, None):
        for k in (1, 1, 1, 2, 3, 40, 150):
            base = rng.normal(size=16)
            for _ in range(k):
                rows.append((at, [float(x) for x in base + rng.normal(size=16) * 0.06 * (k > 1)], label))
                at += 1
    same = [1.0] + [0.0] * 15
    rows += [(at, same, 0), (at + 1, same, 0), (at + 2, [2.0] + [0.0] * 15, 0), (at + 3, same, 1), (at + 3, same, 1),
             (at + 4, [0.0] * 16, 0), (at + 5, None, 0), (at + 6, [None] + [1.0] * 15, 0), (at + 7, [float("nan")] * 16, 0),
             (at + 8, [float("inf")] * 16, 0), (at + 9, [], 0), (None, same, 0), (at + 10, [1.0, 0.0], 0), (at + 11, [1.0, 0.0], 0),
             (at + 12, [1e300] + [0.0] * 15, 0)]
    return rows


def links_of(rows):
    good = [(i, np.array(v, dtype=float) / max(map(abs, v)), g) for i, (k, v, g) in enumerate(rows)
            if g is not None and k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = set()
    for i, a, g in good:
        for j, b, h in good:
            if i != j and g == h and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                out.add((i, j))
    return out


@pytest.mark.parametrize("limits", [{}, {"shard": 40, "max_shard": 64, "probes": 2}])
def test_embedding_dedup(spark, limits):
    rows = near_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4).withColumn("node", F.lit(1))
    found = sorted((tuple(r)[:5] for r in embedding_dedup.link_vectors(df, **limits).collect()), key=str)
    assert found[0][4] >= 0.9
    links = links_of(rows)
    have = sum(r[1] for r in found)
    assert 0.97 * len(links) <= have <= len(links)
    assert all(kept == (v == c) for v, _, c, kept, _ in found)
    if not limits:
        root = components([(r[0], r[0]) for r in rows if r[0] is not None] + [(rows[i][0], rows[j][0]) for i, j in links])
        count = {i: 0 for i in range(len(rows))}
        for i, _ in links:
            count[i] += 1
        expected = sorted(((r[0], count[i], root.get(r[0])) for i, r in enumerate(rows)), key=str)
        assert sorted((r[:3] for r in found), key=str) == expected
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def test_low_recall_is_an_error(spark, monkeypatch):
    rows = near_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *_: (10, 100))
    with pytest.raises(RuntimeError, match="all shards"):
        embedding_dedup.link_vectors(df)


# pipeline


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").unionByName(spark.createDataFrame(
        [(None, "A text without an id, which is kept.", "en", "s", 36), (9_001, None, None, None, None), (9_002, "", "en", "s", 0),
         (3, "one two three", "en", "s", 13), (9_003, "write to me@mail.example.com or +1 (375) 555-4393 now", "en", "s", 53)],
        "doc_id long, text string, lang string, source string, n_chars long"))
    docs = write_once(docs.withColumns({n: F.lit(n) for n in ("score", "n_words", "items", "spans", "base", "node", "a.b")}))
    tables = [("", docs)]
    for name, stage in corpus_pipeline.STAGES:
        tables.append((name, write_once(stage(spark, tables[-1][1], FOLDER))))
    return tables


def test_stages_keep_columns(stages):
    for name, df in stages[1:-1]:
        assert df.schema.names == stages[0][1].schema.names, name
        assert df.select("score", "items", "`a.b`").distinct().collect() == [("score", "items", "a.b")]


def planted():
    """Documents whose fate after each stage is known: near and exact copies, benchmark passages, personal data, clean ones."""
    docs = [r for r in SMALL if r[1]]
    base = [t for _, t in docs if 400 < len(t) < 3000 and t.isprintable()][:12]
    item = max((t for _, t in ITEMS if t), key=len).split()
    rows, near, leaks = [], {}, {}
    for i, text in enumerate(base):
        words = text.split()
        rows.append((10_000 + 10 * i, text))
        rows.append((10_001 + 10 * i, text))  # exact copy
        rows.append((10_002 + 10 * i, " ".join(words[:-1])))  # near copy
        near[i] = 10_000 + 10 * i
    for i, text in enumerate(base[:6]):
        words = [f"{w}x{i}" for w in text.split()]
        leaks[20_000 + i] = i % 2 == 0
        part = item[:10] if i % 2 == 0 else item[:9]
        rows.append((20_000 + i, " ".join(words[:30] + part + words[30:])))
    rows.append((30_000, "write to me@mail.example.com or +1 (375) 555-4393 now"))
    return rows, near, leaks


def brute_links(rows):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    return [(d, e) for i, (d, a) in enumerate(sets) for e, b in sets[i:] if a and b and (d == e or 100 * len(a & b) >= 80 * len(a | b))]


def hit_by_benchmark(rows, items, size=10):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    windows = {}
    for _, text in items:
        w = words(text)
        m = min(size, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(m, set()).add(tuple(w[i:i + m]))
    return {d for d, t in rows for w in [words(t)] if any(tuple(w[i:i + m]) in found for m, found in windows.items() for i in range(len(w) - m + 1))}


SMALL = [tuple(r) for r in duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()]
ITEMS = [tuple(r) for r in duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()]


def as_documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_near_duplicate_stage_against_brute_force(spark):
    rows, near, _ = planted()
    rows = rows + SMALL[:120] + [(None, "no id"), (None, "no id"), (7, rows[0][1])]
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, as_documents(spark, rows), FOLDER).collect()]
    least = components(brute_links(rows))
    expected = {d for d, t in rows if d is not None and least.get(d, d) == d}
    assert {k for k in kept if k is not None} == expected and kept.count(None) == 2
    assert all((first in expected) or least[first] < first for first in near.values())
    assert not any(first + 1 in expected or first + 2 in expected for first in near.values())


def test_decontamination_stage_against_brute_force(spark):
    rows, _, leaks = planted()
    rows = rows + SMALL + [(None, None), (8_000, "")]
    kept = {r["doc_id"] for r in corpus_pipeline.decontamination_stage(spark, as_documents(spark, rows), FOLDER).collect()}
    gone = hit_by_benchmark(rows, ITEMS)
    assert kept == {d for d, _ in rows} - gone
    assert {d for d, leaked in leaks.items() if leaked} <= gone and 30_000 in kept


def test_pii_stage_against_rules(spark):
    rows = planted()[0] + SMALL[:80] + [(None, None), (8_000, "")]
    found = {(r["doc_id"], r["n_chars"]): r["text"] for r in corpus_pipeline.pii_stage(spark, as_documents(spark, rows), FOLDER).collect()}
    assert found[30_000, 31] == "write to [EMAIL] or [PHONE] now"
    texts = {d: t for d, t in rows}
    for (doc_id, n_chars), text in found.items():
        assert (n_chars is None) == (text is None) and (text is None or n_chars == len(text))
        for kind, pattern in (("EMAIL", EMAIL), ("IP", IP)):
            passing = [m for m in re.finditer(pattern, texts[doc_id] or "") if kind == "EMAIL" or max(map(int, m.group().split("."))) < 256]
            assert not passing or f"[{kind}]" in text
        if not re.search(r"[0-9@]|[(\[]at[)\]]", texts[doc_id] or ""):
            assert text == texts[doc_id]


EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"


def test_quality_stage_decides_by_its_scores(spark, stages):
    good = {r["doc_id"] for r in queries.op7_quality(spark, FOLDER).collect() if r["predicted"]}
    kept = {r["doc_id"] for r in dict(stages)["quality"].select("doc_id").collect()}
    assert len(good & kept) > 0.97 * len(good)


def test_token_stage_round_trip(stages):
    tables = dict(stages)
    assert tables["tokens"].count() == tables["pii"].count() == tables["decontamination"].count()
    assert tables["tokens"].filter("NOT exact OR n_tokens <> size(ids)").count() == 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = write_once(stage(spark, docs, FOLDER))
        assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r["exact"] for r in rows)


def test_quality_names():
    assert len(quality.STATS) == len(set(quality.STATS))
