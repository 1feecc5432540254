import re

import pytest
from pyspark.sql import functions as F

from passagework.functions.text import clean_text, word_count
from passagework.catalog.common import load_word_encoder
from passagework.operators.chunking import chunk_rows, chunk_text, encoder_splitter, token_windows, tokenizer_splitter
from test_text import clean_with_re

FOLDER = "/root/testdata/sf0.001"


def chunk_plainly(text, size, overlap):
    limit = size - overlap
    pieces = []
    for page in text.split("\f"):
        for sentence in re.split(r"(?<=[.!?]) ", clean_with_re(page)):
            ws = sentence.split(" ") if sentence else []
            pieces += [ws[i:i + limit] for i in range(0, len(ws), limit)]
    packed = []
    for piece in pieces:
        if not packed or len(packed[-1]) + len(piece) > limit:
            packed.append([])
        packed[-1] = packed[-1] + piece
    tails = [[]] + [p[-overlap:] if overlap else [] for p in packed[:-1]]
    return [" ".join(t + p) for t, p in zip(tails, packed)]


@pytest.mark.parametrize("size,overlap", [(500, 10), (20, 5), (7, 0), (2, 1)])
def test_chunks_equal_plain_python(spark, size, overlap):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = F.replace("text", F.lit("\n"), F.lit("\f"))
    rows = documents.select(text.alias("t"), chunk_text(text, size, overlap).alias("chunks")).collect()
    for row in rows:
        assert row["chunks"] == chunk_plainly(row["t"], size, overlap)
        assert all(len(c.split(" ")) <= size for c in row["chunks"])


def test_empty_and_null_texts_give_no_rows(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, " \n "), (4, "one")], "k bigint, t string")
    for splitter in (chunk_text, token_windows):
        assert [(r["k"], r["content"]) for r in chunk_rows(df, "t", "k", splitter).collect()] == [(4, "one")]


def test_chunks_without_overlap_give_the_text_back(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = documents.select(
        clean_text(F.col("text")).alias("c"), F.array_join(chunk_text(F.col("text"), 30, 0), " ").alias("j")
    )
    assert rows.filter("c <> j").isEmpty()


def test_ids_are_unique(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    chunks = chunk_rows(documents, "text", "doc_id")
    assert chunks.count() == chunks.select("id").distinct().count()
    assert {"lang", "source", "n_chars"} <= set(chunks.columns)


def test_the_text_is_split_once(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = chunk_rows(documents.select("doc_id", "text"), "text", "doc_id")._jdf.queryExecution().executedPlan()
    # one occurrence of the sentence pattern: no filter repeats the splitter
    assert plan.toString().count("(?<=[.!?])") == 1


def test_windows(spark):
    df = spark.createDataFrame([(1, " ".join(str(i) for i in range(11)))], "k bigint, t string")
    got = [r["content"] for r in chunk_rows(df, "t", "k", lambda c: token_windows(c, 5, 2)).collect()]
    assert got == ["0 1 2 3 4", "3 4 5 6 7", "6 7 8 9 10"]


def test_tokenizer_of_the_caller(spark):
    def load():
        return lambda text: len(text.replace(" ", ""))

    df = spark.createDataFrame([(1, "aa bb. cc dd. eeeee. f " + "g" * 9 + " hh.")], "k bigint, t string")
    splitter = tokenizer_splitter(load, 8, 2)
    got = [r["content"] for r in chunk_rows(df, "t", "k", splitter).orderBy("chunk_pos").collect()]
    assert got == ["aa bb.", "cc dd.", "eeeee.", "f ggggg", "gggg", "hh."]
    # any word and every chunk with its overlap stay within the limit, by a counter that counts blanks, too
    hard = spark.createDataFrame([(1, "a bb ccc. " * 30 + "x" * 50 + " dd. " + "é" * 33)], "k bigint, t string")
    found = [r["content"] for r in chunk_rows(hard, "t", "k", tokenizer_splitter(lambda: len, 10, 4)).collect()]
    assert max(map(len, found)) <= 10 and sum(c.count("x") for c in found) >= 50


def test_tokenizer_that_counts_words_equals_native(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    splitter = tokenizer_splitter(lambda: lambda text: len(text.split(" ")), 40, 6)
    got = chunk_rows(documents, "text", "doc_id", splitter)
    want = chunk_rows(documents, "text", "doc_id", lambda c: chunk_text(c, 40, 6))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("size, overlap", [(40, 6), (7, 0), (12, 11)])
def test_encoder_of_words_equals_native(spark, size, overlap):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = chunk_rows(documents, "text", "doc_id", encoder_splitter(load_word_encoder, size, overlap))
    want = chunk_rows(documents, "text", "doc_id", lambda c: chunk_text(c, size, overlap))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_encoder_is_called_in_proportion_to_the_text(spark, tmp_path):
    """A byte-level tokenizer: no chunk exceeds the limit, no word is lost, and few texts are encoded more than twice."""
    import public_tokenizers

    path, folder = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path)

    def load():
        import uuid

        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)

        def encode(texts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{len(texts)} {sum(map(len, texts))}")
            return [e.offsets for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]
        return encode

    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(
        [(-1, "x" * 3000 + " end"), (-2, "日本語" * 200 + ". one two."), (-3, ""), (-4, None), (-5, "\U0001F600" * 90)], "id long, t string"))
    size, overlap = 60, 8
    found = chunk_rows(rows, "text", "doc_id", encoder_splitter(load, size, overlap)).collect()
    found.sort(key=lambda r: (r["doc_id"], r["chunk_pos"]))
    calls = [tuple(map(int, p.read_text().split())) for p in tmp_path.iterdir()]
    letters = sum(len(r["text"] or "") for r in rows.collect())
    assert sum(n for _, n in calls) < 3 * letters and len(calls) < 100
    assert max(map(len, load()([r["content"] for r in found]))) <= size
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r["content"])
    for doc_id, text in rows.collect():
        words = set((text or "").replace("- ", "").split())
        chunks = " ".join(by.get(doc_id, []))
        assert doc_id in by or not words
        if doc_id >= 0:
            assert len(set(chunks.split()) & words) >= 0.9 * len(words)
    assert "".join(by[-1]).count("x") >= 3000


def test_encoder_gets_a_bounded_part_of_a_batch(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import uuid

        encode = load_word_encoder()

        def noted(texts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(sum(map(len, texts))))
            return encode(texts)
        return noted

    rows = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w "), "id", F.lit(". ")), 700).alias("text"))
    got = chunk_rows(rows, "text", "doc_id", encoder_splitter(load))
    want = chunk_rows(rows, "text", "doc_id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(sizes) > 1_500_000 and max(sizes) < 700_000


def test_parameters_are_checked():
    for size, overlap in [(10, 10), (5, -1), (0, 0)]:
        with pytest.raises(ValueError):
            chunk_text(None, size, overlap)


def test_word_count(spark):
    df = spark.createDataFrame([("",), ("a",), ("a b c",)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [0, 1, 3]
