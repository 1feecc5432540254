"""Embedding, generation and composition with models of the caller."""

import pytest
from pyspark.sql import functions as F

from passagework.functions.vectors import digit_embedding, load_digit_embedder
from passagework.operators.compose import classify_and_answer, fan_out, normalise_label, parallel, prompt_step, route
from passagework.operators.embedding import embed, embed_distinct, request_payloads
from passagework.operators.generation import generate, predict, with_defaults
from passagework.schemas import SchemaMismatch
from passagework.session import arrow_batches


def texts(spark, n, parts=2):
    return spark.range(n, numPartitions=parts).select("id", F.concat(F.lit("t"), F.col("id")).alias("t"))


def test_embedder_gets_at_most_max_call_texts(spark):
    def load():
        def model(batch):
            assert len(batch) <= 7
            return [[float(len(batch)), float(b[1:])] for b in batch]
        return model

    rows = embed(texts(spark, 100), "t", load, max_call=7).collect()
    assert all(r["embedding"][1] == r["id"] for r in rows)
    assert sum(1 / r["embedding"][0] for r in rows) == pytest.approx(16)


def test_model_is_loaded_once_per_task(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid
        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda batch: [[1.0] for _ in batch]

    with arrow_batches(spark, 10, 64 << 20):
        assert embed(texts(spark, 400, 2), "t", load).filter("embedding[0] = 1").count() == 400
    assert len(list(tmp_path.iterdir())) == 2


def test_equal_texts_are_embedded_once(spark, tmp_path):
    sent = tmp_path / "sent"
    sent.mkdir()
    folder, store = str(sent), str(tmp_path / "store")

    def load():
        import uuid

        def model(batch):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(batch))
            return [[float(len(t))] for t in batch]
        return model

    def inputs():
        return sorted(t for p in sent.iterdir() for t in p.read_text().split("\n"))

    rows = [(i, ["a", "bb", "ccc", None][i % 4]) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, t string").repartition(5)
    for extra in ([], [], [(100, "dddd"), (101, "a"), (102, "dddd")]):
        now = df.unionByName(spark.createDataFrame(extra, "id int, t string"))
        found = {r["id"]: r["embedding"] for r in embed_distinct(now, "t", load, store).collect()}
        assert found == {i: None if t is None else [float(len(t))] for i, t in rows + extra}
    assert inputs() == ["a", "bb", "ccc", "dddd"]
    assert embed_distinct(df.limit(0), "t", load).count() == 0
    assert embed_distinct(df.withColumn("embedding", F.lit("old")), "t", load, store).columns == ["id", "t", "embedding"]


def test_wrong_number_of_vectors_fails(spark):
    with pytest.raises(Exception, match="returned 1 vectors for 5 texts"):
        embed(texts(spark, 5, 1), "t", lambda: lambda batch: [[1.0]]).collect()


def test_failing_call(spark):
    def load():
        def model(batch):
            if "t3" in batch:
                raise RuntimeError("no answer")
            return [[1.0] for _ in batch]
        return model

    df = texts(spark, 10, 1)
    with pytest.raises(Exception, match="no answer"):
        embed(df, "t", load, max_call=2).collect()
    kept = embed(df, "t", load, max_call=2, on_error="null").filter("embedding IS NULL")
    assert sorted(r["id"] for r in kept.collect()) == [2, 3]
    with pytest.raises(ValueError):
        embed(df, "t", load, on_error="skip")


def test_null_texts_are_not_sent(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, t string").coalesce(1)
    rows = embed(df, "t", lambda: lambda batch: [[1.0] for b in batch if b is not None]).collect()
    assert [r["embedding"] for r in rows] == [None, [1.0]]


def test_both_forms_of_the_stand_in_agree(spark):
    df = spark.createDataFrame([(1, "Ab ab  c-d\n e. "), (2, ""), (3, "É é x y")], "id int, t string")
    both = embed(df.withColumn("n", digit_embedding(F.col("t"))), "t", load_digit_embedder)
    assert both.filter("n <> embedding").isEmpty()


def test_payloads_hold_every_row_once(spark):
    got = request_payloads(texts(spark, 5000), "id", "t", 150)
    assert got.agg(F.sum("n_rows")).first()[0] == 5000
    assert got.agg(F.max("n_rows")).first()[0] <= 150
    rows = got.select(F.expr("from_json(payload, 'columns array<string>, index array<bigint>, data array<array<string>>') p"))
    flat = rows.select(F.explode(F.arrays_zip("p.index", "p.data")).alias("z")).select("z.index", "z.data")
    assert flat.count() == 5000
    assert flat.filter("data[0] <> concat('t', index)").isEmpty()


def test_generate(spark):
    def load():
        return lambda rs: [f"{r['prompt']}/{r['system_prompt']}/{r['temperature']}/{r['max_new_tokens']}" for r in rs]

    df = spark.createDataFrame(
        [(1, "a", "s", 0.1, 5), (2, "b", "s", None, None), (3, None, "s", None, None)],
        "i int, prompt string, system_prompt string, temperature double, max_new_tokens bigint")
    assert [r["completion"] for r in generate(df, load).orderBy("i").collect()] == ["a/s/0.1/5", "b/s/1.0/100", None]
    bare = df.select("i", "prompt", "system_prompt")
    assert generate(bare, load).columns == ["i", "prompt", "system_prompt", "completion"]
    assert generate(bare, load).filter("i = 1").first()["completion"] == "a/s/1.0/100"
    assert with_defaults(bare, 0.5, 7).first()["max_new_tokens"] == 7
    with pytest.raises(SchemaMismatch, match="prompt is missing"):
        generate(df.drop("prompt"), load)
    with pytest.raises(SchemaMismatch, match="max_new_tokens"):
        generate(df.withColumn("max_new_tokens", F.lit("x")), load)
    with pytest.raises(Exception, match="returned 0 texts"):
        generate(df, lambda: lambda rs: []).collect()


def test_predict_strips_the_echo(spark):
    df = spark.createDataFrame([("ask", "sys"), (None, "sys")], "prompt string, system_prompt string")
    got = predict(df, lambda: lambda rs: [r["prompt"] + "reply" for r in rs]).collect()
    assert [(r["prompt"], r["completion"]) for r in got] == [("ask", "reply"), (None, None)]


@pytest.fixture
def upper():
    return lambda: lambda rs: [r["prompt"].upper() for r in rs]


def test_chain_of_two_steps(spark, upper):
    df = spark.createDataFrame([("ada", "spanish")], "person string, language string")
    one = prompt_step(df, "city of {person}?", upper, "city")
    two = prompt_step(one, "country of {city} in {language}", upper, "country")
    assert two.first()["country"] == "COUNTRY OF CITY OF ADA? IN SPANISH"
    with pytest.raises(KeyError):
        prompt_step(df, "{nobody}", upper, "x")


def test_fan_out_is_one_pass(spark, upper):
    df = spark.createDataFrame([("bear",), ("cat",)], "topic string")
    got = fan_out(df, {"joke": "joke {topic}", "poem": "poem {topic}"}, upper)
    assert {tuple(r) for r in got.collect()} == {("bear", "JOKE BEAR", "POEM BEAR"), ("cat", "JOKE CAT", "POEM CAT")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_parallel(spark):
    df = spark.createDataFrame([(1,)], "num int")
    row = parallel(df, passed={}, extra={"mult": F.col("num") * 3}, modified=F.col("num") + 1).first()
    assert row.asDict(True) == {"passed": {"num": 1}, "extra": {"num": 1, "mult": 3}, "modified": 2}


def test_route_takes_the_first_branch(spark):
    df = spark.createDataFrame([(" Cooking\n",), ("sailing and cooking",), ("x",), (None,)], "l string")
    out = df.select(route(F.col("l"), {"sailing": F.lit(1), "cooking": F.lit(2)}, F.lit(3)))
    assert [r[0] for r in out.collect()] == [2, 1, 3, 3]
    assert df.select(normalise_label(F.col("l"))).first()[0] == "cooking"


def test_classify_and_answer(spark):
    def load():
        return lambda rs: [("Cooking" if "meat" in r["prompt"] else "Other") if r["prompt"].startswith("Label")
                           else r["prompt"] for r in rs]

    df = spark.createDataFrame([("meat pie",), ("drain",)], "question string")
    got = classify_and_answer(df, "Label {question}", {"cooking": "Chef: {question}"}, "General: {question}", load)
    assert {tuple(r) for r in got.collect()} == {
        ("meat pie", "Cooking", "Chef: meat pie"), ("drain", "Other", "General: drain")}
