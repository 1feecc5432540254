import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagework.operators.keyword_index import build_keyword_index, indexed_search, share_read
from passagework.operators.search import (
    CentreTree, CosineScorer, approximate_search, assign_lists, clustered_search, keyword_search, list_bounds, probe_lists,
    refine_centres, similarity_search, train_lists,
)
from passagework.plans.retrieval import expression_embedding, nearest_chunks
from passagework.functions.vectors import digit_embedding


def brute(index, queries, k, allowed=lambda i, q: True):
    out = set()
    for qid, qv, *qm in queries:
        hits = []
        for iid, iv, *im in index:
            n = np.linalg.norm(qv) * np.linalg.norm(iv)
            if n > 0 and allowed(im, qm):
                hits.append((-round(float(np.dot(qv, iv) / n), 6), iid))
        best = {}
        for s, i in sorted(hits):
            best.setdefault(i, s)
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k], 1):
            out.add((qid, rank, i, -s + 0.0))
    return out


def as_set(df):
    return {(r["query_id"], r["rank"], r["id"], r["score"] + 0.0) for r in df.collect()}


@pytest.fixture(scope="module")
def vectors():
    """A third of the index are copies of one vector with the same label; one vector is zero, one NULL."""
    rng = np.random.default_rng(3)
    index = [(i, rng.integers(-3, 4, 6).astype(float).tolist(), int(rng.integers(0, 5))) for i in range(600)]
    index = [(i, index[0][1], 0) if i % 3 == 0 else (i, v, m) for i, v, m in index]
    index[7] = (7, [0.0] * 6, 1)
    queries = [(1000 + i, rng.integers(-3, 4, 6).astype(float).tolist(), int(rng.integers(0, 6))) for i in range(90)]
    queries[3] = (1003, [0.0] * 6, 1)
    return index, queries


def frames(spark, vectors):
    index, queries = vectors
    return (
        spark.createDataFrame(index + [(9999, None, 1)], "id bigint, embedding array<float>, label int").repartition(5),
        spark.createDataFrame(queries + [(9998, None, 1)], "query_id bigint, embedding array<float>, allowed int"),
    )


@pytest.mark.parametrize("block_bytes", [64 << 20, 1500])
def test_exact_search(spark, vectors, block_bytes):
    index, queries = frames(spark, vectors)
    got = similarity_search(index, queries, 4, block_bytes=block_bytes)
    assert as_set(got) == brute([v[:2] for v in vectors[0]], [q[:2] for q in vectors[1]], 4)


@pytest.mark.parametrize("block_bytes", [64 << 20, 1500])
def test_search_with_permissions(spark, vectors, block_bytes):
    index, queries = frames(spark, vectors)
    got = similarity_search(index, queries, 3, match=("label", "allowed"), block_bytes=block_bytes)
    assert as_set(got) == brute(*vectors, 3, lambda i, q: i == q)


def test_a_query_with_several_permissions(spark, vectors):
    index, queries = frames(spark, vectors)
    both = queries.withColumn("allowed", F.explode(F.array(F.lit(1), F.lit(2))))
    got = similarity_search(index, both, 3, match=("label", "allowed"))
    assert as_set(got) == brute(*vectors, 3, lambda i, q: i[0] in (1, 2))


def test_filter_reaches_the_scan_and_columns_are_fetched(spark, vectors, tmp_path):
    index, queries = frames(spark, vectors)
    index.write.parquet(str(tmp_path / "i"))
    got = similarity_search(spark.read.parquet(str(tmp_path / "i")), queries, 2, ["label"], where="label = 2")
    assert {r["label"] for r in got.collect()} == {2}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(label,2)" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_hits_are_joined_by_key(spark, vectors, monkeypatch):
    from passagework.operators import search

    index, queries = frames(spark, vectors)
    want = {tuple(r) for r in similarity_search(index, queries, 3, ["label"]).collect()}
    monkeypatch.setattr(search, "SMALL_TABLE_ROWS", 10)
    assert {tuple(r) for r in similarity_search(index, queries, 3, ["label"]).collect()} == want


def test_text_keys_rank_as_texts(spark):
    index = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("ab", [1.0, 1.0])], "id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    assert [r["id"] for r in similarity_search(index, queries, 3).orderBy("rank").collect()] == ["a", "b", "ab"]
    assert similarity_search(index.limit(0), queries, 3).isEmpty()


def test_vectors_of_other_length_fail(spark):
    index = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id bigint, embedding array<float>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="different lengths"):
        similarity_search(index, queries, 1).collect()
    with pytest.raises(Exception, match="dimensions"):
        similarity_search(index.filter("id = 2"), queries, 1).collect()


def test_more_hits_wanted_than_rows(spark):
    index = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id bigint, embedding array<float>")
    got = similarity_search(index, index.withColumnRenamed("id", "query_id"), 5)
    assert as_set(got) == {(1, 1, 1, 1.0), (1, 2, 2, 0.0), (2, 1, 2, 1.0), (2, 2, 1, 0.0)}
    assert similarity_search(index.filter("id < 0"), index.withColumnRenamed("id", "query_id"), 5).isEmpty()
    with pytest.raises(ValueError):
        similarity_search(index, index, 0, query_id_col="id")


def test_approximate_hits_have_exact_scores(spark, vectors):
    index, queries = frames(spark, vectors)
    model = train_lists(index, 5)
    listed = assign_lists(index, model)
    assert listed.count() == 599
    exact = brute([v[:2] for v in vectors[0]], [q[:2] for q in vectors[1]], 600)
    score = {(q, i): s for q, _, i, s in exact}
    for n_probe, block in [(2, 64 << 20), (2, 1500)]:
        hits = as_set(approximate_search(listed, model, queries, 3, n_probe, block_bytes=block))
        assert hits and all(score[q, i] == s for q, _, i, s in hits)
    probes = probe_lists(queries, model, 2)
    assert probes.count() == 2 * 89
    one = approximate_search(listed, model, queries.limit(1), 3, 1)
    assert re.search(r"PartitionFilters: \[[^]]*list_id", one._jdf.queryExecution().executedPlan().toString())
    assert "dynamicpruning" in one._jdf.queryExecution().executedPlan().toString().lower()
    every = approximate_search(listed, model, queries, 3, 5)
    assert as_set(every) == brute([v[:2] for v in vectors[0]], [q[:2] for q in vectors[1]], 3)


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_keyword_search(spark, block_bytes):
    rng = np.random.default_rng(5)
    words = ["the"] + [f"w{i}" for i in range(40)]

    def text():
        return "The, the " + " ".join(rng.choice(words, int(rng.integers(0, 12))))

    index = [(i, text()) for i in range(200)] + [(500, ""), (501, None), (502, "zzz")]
    queries = [(i, text()) for i in range(30)] + [(77, ""), (78, None), (79, "unknown")]
    want = set()
    for q, qt in queries:
        tokens = set((qt or "").lower().split()) - {""}
        hits = sorted((-len(tokens & set((t or "").lower().split())), i) for i, t in index)
        want |= {(q, rank, i, float(-n)) for rank, (n, i) in enumerate([h for h in hits if h[0] < 0][:4], 1)}
    got = keyword_search(
        spark.createDataFrame(index, "id bigint, content string").repartition(3),
        spark.createDataFrame(queries, "query_id bigint, query_text string"), 4, block_bytes=block_bytes,
    )
    assert as_set(got) == want


def test_nearest_chunks(spark):
    chunks = spark.createDataFrame([(1, "red fox"), (2, "blue sky")], "id bigint, content string")
    chunks = chunks.withColumn("embedding", digit_embedding(F.col("content")))
    queries = spark.createDataFrame([(5, "Red  FOX")], "q bigint, t string")
    row = nearest_chunks(chunks, queries, "q", "t", expression_embedding(digit_embedding), 1, ["content"]).first()
    assert (row["query_id"], row["id"], row["content"], row["score"]) == (5, 1, "red fox", 1.0)


@pytest.mark.parametrize("n_probe", [1, 3])
def test_clustered_search_is_exact(spark, vectors, n_probe):
    index, queries = frames(spark, vectors)
    centres = refine_centres(index, np.random.default_rng(1).normal(size=(12, 6)), 2)
    listed = assign_lists(index, centres)
    found, pairs = clustered_search(listed, centres, list_bounds(listed, centres), queries, 4, n_probe=n_probe)
    assert as_set(found) == brute([v[:2] for v in vectors[0]], [q[:2] for q in vectors[1]], 4)
    assert pairs.count() <= 12 * 90
    # more hits wanted than there are vectors
    few, _ = clustered_search(listed, centres, list_bounds(listed, centres), queries.limit(3), 700, ["label"])
    assert few.groupBy("query_id").count().filter("count <> 599").isEmpty() and "label" in few.columns


def test_clustered_search_skips_lists(spark):
    rng = np.random.default_rng(5)
    seeds = rng.normal(size=(20, 16))
    rows = [(i, (seeds[i % 20] * 10 + rng.normal(size=16)).tolist()) for i in range(2000)]
    index = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    listed = assign_lists(index, seeds)
    queries = index.filter("id < 40").withColumnRenamed("id", "query_id")
    found, pairs = clustered_search(listed, seeds, list_bounds(listed, seeds), queries, 3)
    assert as_set(found) == as_set(similarity_search(index, queries, 3))
    assert pairs.count() < 0.2 * 40 * 20


def test_refined_centres(spark):
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(300, 5))
    start = rng.normal(size=(6, 5))
    df = spark.createDataFrame([(r.tolist(),) for r in rows] + [(None,), ([0.0] * 5,)], "embedding array<double>").repartition(4)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    want = start.copy()
    for _ in range(3):
        of = np.round(unit @ (want / np.linalg.norm(want, axis=1)[:, None]).T, 6).argmax(axis=1)
        want = np.array([unit[of == c].mean(axis=0) if (of == c).any() else want[c] for c in range(6)])
    assert np.allclose(refine_centres(df, start, 3), want)


def test_centre_tree():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(90, 8))
    rows = CosineScorer().unit(rng.normal(size=(400, 8)))[0]
    exact = np.argsort(-np.round(rows @ CosineScorer().unit(centres)[0].T, 6), axis=1, kind="stable")
    assert (CentreTree(centres, beam=90).nearest(rows, 5) == exact[:, :5]).all()
    near = CentreTree(centres, beam=4, rounds=3)
    assert len(near.tops) == 9 and sorted(np.concatenate(near.below).tolist()) == list(range(90))
    assert (near.nearest(rows, 1)[:, 0] == exact[:, 0]).mean() > 0.85
    assert (CentreTree(centres[:2]).nearest(rows, 3)[:, 2] == -1).all()


def keyword_rows(seed=9):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    def text(n):
        return " ".join(words[min(59, int(x))] for x in rng.exponential(9, n))
    rows = [(i, text(int(rng.integers(0, 40))), f"s{i % 4}") for i in range(500)] + [(500 + i, "w0 w1 W2. w3", "copy") for i in range(90)]
    rows += [(900, None, "s"), (901, "", "s"), (902, "  \n", None)]
    queries = [(i, text(int(rng.integers(1, 25)))) for i in range(40)] + [(100, None), (101, ""), (102, "unknown words"), (103, "w0 w1 w2 w3 w0")]
    return rows, queries


@pytest.mark.parametrize("block_ids, first_ids, k", [(4096, 20_000, 3), (8, 30, 3), (8, 0, 1), (50, 100, 700)])
def test_keyword_index(spark, tmp_path, block_ids, first_ids, k):
    rows, queries = keyword_rows()
    docs = spark.createDataFrame(rows, "key bigint, body string, source string").repartition(4)
    asked = spark.createDataFrame(queries, "q bigint, t string")
    path = str(tmp_path / "keywords")
    build_keyword_index(docs, path, "key", "body", ("source",), block_ids)
    found = indexed_search(spark, path, asked, k, "q", "t", first_ids)
    assert found.columns == ["query_id", "rank", "id", "source", "score"]
    def tokens(text):
        return set((text or "").lower().split())
    want = set()
    for q, t in queries:
        hits = sorted((-len(tokens(t) & tokens(body)), key, source) for key, body, source in rows if tokens(t) & tokens(body))
        want |= {(q, rank, key, source, float(-n)) for rank, (n, key, source) in enumerate(hits[:k], 1)}
    assert {tuple(r) for r in found.collect()} == want
    with pytest.raises(ValueError):
        indexed_search(spark, path, asked, 0, "q", "t")


def test_keyword_index_reads_few_postings(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"c{x}" for x in rng.integers(0, 30, 60)) + " " + " ".join(f"r{x}" for x in rng.integers(0, 3000, 12))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "id bigint, content string")
    path = str(tmp_path / "keywords")
    build_keyword_index(docs, path)
    asked = docs.filter("id % 300 = 0").selectExpr("id AS query_id", "content AS query_text")
    for r in share_read(spark, path, asked, 3, first_ids=500).collect():
        assert r["n_candidates"] < 0.1 * r["n_postings"]
    best = indexed_search(spark, path, asked, 3, first_ids=500).filter("rank = 1 AND id = query_id").count()
    assert best == 10
    # the tables of the index are all that a search reads
    files = indexed_search(spark, path, asked, 3).inputFiles()
    assert files and all("/keywords/" in f or "passagework-" in f for f in files)


def test_empty_keyword_index(spark, tmp_path):
    none = spark.createDataFrame([], "id bigint, content string")
    build_keyword_index(none, str(tmp_path / "keywords"))
    asked = spark.createDataFrame([(1, "a")], "query_id bigint, query_text string")
    assert indexed_search(spark, str(tmp_path / "keywords"), asked, 3).count() == 0


def test_queries_beyond_a_block_do_not_pass_through_the_driver(spark, vectors, monkeypatch):
    from pyspark.sql import DataFrame

    index, queries = frames(spark, vectors)
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: pytest.fail("queries on the driver"))
    got = similarity_search(index, queries, 3, match=("label", "allowed"), block_bytes=1500)
    assert as_set(got) == brute(*vectors, 3, lambda i, q: i == q)


def test_cells_of_small_parts(spark, vectors):
    from passagework.operators import ranking

    index, queries = frames(spark, vectors)
    rows = index.select("id", F.col("embedding").alias("feature"), F.col("label").cast("long").alias("match"))
    asked = queries.select("query_id", F.col("embedding").alias("feature"), F.col("allowed").alias("match"))
    got, _ = ranking.best_matches(rows, asked, 3, CosineScorer(), F.size("feature") * 8, 500, 4000)
    assert as_set(got) == brute(*vectors, 3, lambda i, q: i == q)
    got, _ = ranking.best_matches(rows.drop("match"), asked.drop("match"), 3, CosineScorer(), F.size("feature") * 8, 500, 4000)
    assert as_set(got) == brute([v[:2] for v in vectors[0]], [q[:2] for q in vectors[1]], 3)


def test_index_rows_are_prepared_in_bounded_slices(monkeypatch):
    import pyarrow as pa

    from passagework.operators import ranking
    from passagework.operators.search import SharedTokenScorer

    class Noted(SharedTokenScorer):
        most = 0

        def rows(self, features):
            self.most = max(self.most, len(features))
            return super().rows(features)

    monkeypatch.setattr(ranking, "SLICE_BYTES", 2000, raising=False)
    scorer = Noted()
    block = ranking._Block(pa.table({"query_id": [1], "feature": ["a b c"]}), scorer, 2)
    texts = ["a x " * 10, "b a c", "q"] * 100
    block.add(pa.RecordBatch.from_pydict({"id": list(range(300)), "feature": texts}))
    assert scorer.most <= 110
    assert block.best.table(block.ids).to_pydict() == {"query_id": [1, 1], "id": [1, 4], "score": [3.0, 3.0]}


def test_rough_scores_lose_no_close_hit():
    import pyarrow as pa

    from passagework.operators import ranking

    rng = np.random.default_rng(5)
    base = rng.normal(size=40)
    rows = base + rng.normal(size=(3000, 40)) * 3e-4
    queries = base + rng.normal(size=(7, 40)) * 3e-4
    arrays = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in (rows, queries)]
    block = ranking._Block(pa.table({"query_id": list(range(7)), "feature": arrays[1]}), CosineScorer(), 5)
    assert block.scorer.rough(block.scorer.rows(arrays[0]), np.arange(9), block.features, np.arange(7))[0].dtype == np.float32
    block.add(pa.RecordBatch.from_pydict({"id": list(range(3000)), "feature": arrays[0]}))
    got = {(q, i, s) for q, i, s in zip(*block.best.table(block.ids).to_pydict().values())}
    want = brute([(i, r) for i, r in enumerate(rows)], [(i, q) for i, q in enumerate(queries)], 5)
    assert got == {(q, i, s) for q, _, i, s in want}
