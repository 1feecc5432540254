import pytest
from pyspark.sql import functions as F

from passagework.functions.vectors import digit_embedding, load_digit_embedder
from passagework.operators.chat import (
    context_check, final_messages, fold, format_context, formatted_history_of, formatted_history_rows, history_of,
    history_rows, last_questions, question_of, rewrite_prompt, with_memory,
)
from passagework.plans.chat_chain import index_search, run_chain
from passagework.schemas import ChainConfig, GeneratorConfig, RetrieverConfig, SchemaMismatch

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hello there"), (1, 2, "assistant", "hi"), (1, 3, "user", "why?"),
    (2, 0, "user", "single"),
    (3, 0, "system", "rules"), (3, 1, "user", "then what"),
    (4, 0, "user", "a b c"), (4, 5, "tool", "d e"), (4, 9, "assistant", ""),
    (5, 0, "system", None),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_questions(messages):
    assert pairs(last_questions(messages), "conv_id", "question") == {
        (1, "why?"), (2, "single"), (3, "then what"), (4, ""), (5, None)}
    assert pairs(last_questions(messages, "last_user"), "conv_id", "question") == {
        (1, "why?"), (2, "single"), (3, "then what"), (4, "a b c")}


def test_history(messages):
    assert pairs(history_rows(messages), "conv_id", "turn") == {(1, 0), (1, 1), (1, 2), (3, 0), (4, 0), (4, 5)}
    assert pairs(formatted_history_rows(messages), "conv_id", "turn", "tag") == {
        (1, 1, "human"), (1, 2, "ai"), (4, 0, "human")}


def test_fold_keeps_long_conversations(spark, messages):
    assert pairs(fold(messages).withColumn("n", F.size("messages")), "conv_id", "n_tokens", "n") == {
        (1, 6, 4), (2, 1, 1), (3, 3, 2), (4, 6, 3), (5, 1, 1)}
    long = spark.range(3000).select(
        F.lit(7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("word " * 9), F.col("id").cast("string")).alias("text")).repartition(5)
    row = fold(long).first()
    assert (row["n_messages"], row["n_tokens"]) == (3000, 30_000)
    assert [m["turn"] for m in row["messages"]] == list(range(3000))
    assert last_questions(long).first()["question"].endswith("2999")


def test_folded_columns(messages):
    folded = fold(messages)
    m = F.col("messages")
    history = history_of(m)
    out = folded.select(
        "conv_id", question_of(m).alias("q"), question_of(m, "last_user").alias("u"), F.size(history).alias("n"),
        F.to_json(formatted_history_of(m)).alias("f"),
        rewrite_prompt(history, question_of(m), "{chat_history}>{question}").alias("r"),
    )
    got = {r["conv_id"]: r for r in out.collect()}
    assert (got[1]["q"], got[1]["n"]) == ("why?", 3)
    assert got[1]["f"] == '[{"role":"user","text":"hello there"},{"role":"assistant","text":"hi"}]'
    assert got[2]["r"] is None and got[2]["n"] == 0
    # a lone system message is history, although it is not part of the formatted history
    assert got[3]["r"] == '[{"role":"system","text":"rules"}]>then what' and got[3]["f"] == "[]"
    assert (got[4]["q"], got[4]["u"]) == ("", "a b c")
    assert got[5]["q"] is None and got[5]["u"] is None


def test_context_format_keeps_rank_order(spark):
    hits = spark.createDataFrame(
        [(1, 2, "b{document_uri}", "u2"), (1, 1, "a", "u1"), (2, 1, "c", None)], "c int, rank int, t string, u string")
    out = format_context(hits, "c", "t", "u", "[{chunk_text}@{document_uri}]")
    assert pairs(out, "c", "context") == {(1, "[a@u1][b{document_uri}@u2]"), (2, "[c@]")}


def test_context_check(messages):
    got = pairs(context_check(messages, 2, 8), "conv_id", "fits")
    assert got == {(1, True), (2, True), (3, True), (4, True), (5, True)}
    assert (4, False) in pairs(context_check(messages, 3, 8), "conv_id", "fits")


def test_memory(messages):
    got = {(r["conv_id"], r["turn"]): r for r in with_memory(
        messages, lambda earlier, m: F.concat(F.to_json(F.transform(earlier, lambda e: e["turn"])), F.coalesce(m["text"], F.lit("-")))
    ).collect()}
    assert set(got) == {row[:2] for row in ROWS}
    for conv, turn, _, text in ROWS:
        earlier = [r[1] for r in ROWS if r[0] == conv and r[1] < turn]
        assert got[conv, turn]["n_earlier"] == len(earlier)
        assert got[conv, turn]["prompt"] == "[" + ",".join(map(str, earlier)) + "]" + (text if text is not None else "-")


def test_memory_over_pages(spark):
    """Conversations of several pages, turns with gaps, next to short ones and one without an id."""
    rows = [(c, t * step, "user" if t % 2 else "assistant", f"m{c}-{t}") for c, n, step in ((1, 900, 1), (2, 3, 1), (3, 40, 100), (4, 256, 1))
            for t in range(n)] + [(None, t, "user", f"n{t}") for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = with_memory(df, lambda earlier, m: F.concat(F.array_join(F.transform(earlier, lambda e: e["text"]), ","), F.lit("|"), m["text"]))
    found = {(r["conv_id"], r["turn"]): (r["n_earlier"], r["prompt"]) for r in got.collect()}
    assert len(found) == len(rows)
    texts = {}
    for conv, turn, _, text in rows:
        earlier = texts.setdefault(conv, [])
        assert found[conv, turn] == (len(earlier), ",".join(earlier) + "|" + text)
        earlier.append(text)
    assert with_memory(df.limit(0), lambda earlier, m: m["text"]).count() == 0


def test_final_messages(messages):
    out = fold(messages).filter("conv_id = 1").select(
        F.to_json(final_messages(F.lit("sys"), formatted_history_of(F.col("messages")), F.lit("q"))))
    assert out.first()[0] == (
        '[{"role":"system","text":"sys"},{"role":"user","text":"hello there"},{"role":"assistant","text":"hi"},'
        '{"role":"user","text":"q"}]')


def test_chain(spark, messages):
    index = spark.createDataFrame([(1, "u1", "hello there"), (2, "u2", "single"), (3, "u3", "then what")],
                                  "id bigint, url string, content string")
    index = index.withColumn("embedding", digit_embedding(F.col("content")))
    config = ChainConfig.from_dict({
        "retriever": {"k": 1, "passage_template": "<{chunk_text}>"},
        "generator": {"system_template": "S {context}", "rewrite_template": "{chat_history}|{question}",
                      "context_tokens": 9, "max_new_tokens": 3},
    })

    def load():
        return lambda requests: [r["prompt"].split("|")[-1] for r in requests]

    done, hits = run_chain(messages, index_search(index, config), load_digit_embedder, load, config)
    got = {r["conv_id"]: r for r in done.collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[2]["answer"] == '[{"role":"system","text":"S <single>"},{"role":"user","text":"single"}]'
    assert got[3]["search_text"] == "then what" and "<then what>" in got[3]["answer"]
    assert got[1]["overflow"] and "why?" in got[1]["answer"] and got[1]["n_tokens"] > 6
    assert pairs(hits, "conv_id", "rank", "url") >= {(2, 1, "u2"), (3, 1, "u3")}


def test_config_is_checked(spark, messages):
    for bad in (lambda: RetrieverConfig(k=0), lambda: RetrieverConfig(query_type="x"),
                lambda: GeneratorConfig(max_new_tokens=5000), lambda: ChainConfig(question_rule="first")):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(SchemaMismatch):
        run_chain(messages.drop("role"), None, None, None)


def test_chain_search_types(spark, messages):
    from passagework.operators.search import assign_lists, train_lists
    from passagework.plans.chat_chain import retrieve
    from passagework.plans.retrieval import expression_embedding

    index = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(["a b", "c d e", "f", "g h i j"])],
                                  "id bigint, url string, content string")
    index = index.withColumn("embedding", digit_embedding(F.col("content")))
    ann = ChainConfig(retriever=RetrieverConfig(k=2, query_type="ann"))
    with pytest.raises(ValueError):
        index_search(index, ann)
    model = train_lists(index, 2)
    search = index_search(assign_lists(index, model), ann, model, n_probe=2)
    texts = spark.createDataFrame([(1, "a b"), (2, None)], "conv_id bigint, search_text string")
    got = retrieve(texts, search, expression_embedding(digit_embedding), ann)
    assert [(r["conv_id"], r["rank"]) for r in got.orderBy("rank").collect()] == [(1, 1), (1, 2)]
    assert got.filter("rank = 1").first()["url"] == "u0"
