"""Files, tables, streams, changes, index versions and session helpers."""

import random

import pytest
from pyspark.sql import functions as F

from passagework.functions.vectors import load_digit_embedder
from passagework.operators.changes import (
    latest_rows, latest_version, snapshot_changes, state_changes, touched_buckets, write_state,
)
from passagework.operators.chunking import chunk_rows
from passagework.operators.extract import chunk_files
from passagework.operators.index import build_index, compact_index, read_index, refresh_index, versions, without_changed
from passagework.schemas import CHUNKS, RAW_FILES, SYNC_TABLE, check_columns
from passagework.session import arrow_batches, is_small, scratch_dir, write_once
from passagework.sources.files import scan_files
from passagework.sources.tables import append_table, create_schema, create_table, overwrite_table, spread
from passagework.streaming.embed_sync import read_sync_table, sync_embeddings
from passagework.streaming.ingest import append_stream, ingest_files


@pytest.fixture
def folder(tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    (files / "a.txt").write_text("One. Two.")
    (files / "b.txt").write_bytes(b"\xff\xfe\x00")
    (files / "NOTICE.txt").write_text("no")
    (files / "c.md").write_text("other")
    return files


def test_scan(spark, folder):
    found = scan_files(spark, str(folder), "*.txt", excluded="NOTICE")
    check_columns(found, RAW_FILES)
    assert {r["path"].split("/")[-1] for r in found.collect()} == {"a.txt", "b.txt"}
    assert scan_files(spark, str(folder)).count() == 4
    assert [r["content"] for r in chunk_files(found, "utf8").collect()] == ["One. Two."]


def test_ingest_takes_each_file_once(spark, folder, tmp_path):
    def run():
        ingest_files(spark, str(folder), str(tmp_path / "cp"), "*.txt", "NOTICE", path=str(tmp_path / "raw"),
                     files_per_batch=1)
        return spark.read.parquet(str(tmp_path / "raw")).count()

    assert run() == 2
    (folder / "d.txt").write_text("Three.")
    assert run() == 3
    (folder / "a.txt").write_text("One. Two. Changed.")
    assert run() == 3


def test_tables(spark):
    create_schema(spark, "lib")
    create_table(spark, "lib.sync", SYNC_TABLE)
    create_table(spark, "lib.sync", SYNC_TABLE)
    check_columns(spark.table("lib.sync"), SYNC_TABLE)
    overwrite_table(spark.range(3), "lib.numbers")
    overwrite_table(spark.range(4), "lib.numbers")
    append_table(spark.range(2), "lib.numbers")
    assert spark.table("lib.numbers").count() == 6
    cp = scratch_dir(spark)
    for _ in range(2):
        append_stream(spark.readStream.table("lib.numbers"), cp, table="lib.copied")
    assert spark.table("lib.copied").count() == 6
    with pytest.raises(ValueError):
        append_stream(spark.readStream.table("lib.numbers"), cp)


def test_rewritten_chunks_are_embedded_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def load():
        import uuid
        model = load_digit_embedder()

        def counted(batch):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(batch)))
            return model(batch)
        return counted

    def chunks(*texts):
        df = spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "path string, t string")
        return chunk_rows(df, "t", "path")

    path = str(tmp_path / "chunks")

    def run(df, mode):
        df.write.mode(mode).parquet(path)
        stream = spark.readStream.schema(df.schema).parquet(path)
        sync_embeddings(stream, str(tmp_path / "sync"), str(tmp_path / "cp"), load)
        table = read_sync_table(spark, str(tmp_path / "sync"))
        check_columns(table, SYNC_TABLE)
        return table.count(), sum(int(p.read_text()) for p in calls.iterdir())

    assert run(chunks("a", "b", "c"), "append") == (3, 3)
    assert run(chunks("a", "b", "c"), "overwrite") == (3, 3)
    assert run(chunks("a", "b", "c", "d"), "overwrite") == (4, 4)
    # other content under a known key is embedded and shown
    assert run(chunks("a", "B new", "c", "d"), "overwrite") == (4, 5)
    shown = {r["url"]: (r["content"], sum(r["embedding"])) for r in read_sync_table(spark, str(tmp_path / "sync")).collect()}
    assert shown["u1"] == ("B new", 2.0)

    # a second source, and a checkpoint that is started anew, replace no rows of others
    other = chunk_rows(spark.createDataFrame([("x", "other")], "path string, t string"), "t", "path")
    other.write.parquet(str(tmp_path / "other"))
    for checkpoint in ("cp2", "cp3"):
        stream = spark.readStream.schema(other.schema).parquet(str(tmp_path / "other"))
        sync_embeddings(stream, str(tmp_path / "sync"), str(tmp_path / checkpoint), load)
    assert {r["url"] for r in read_sync_table(spark, str(tmp_path / "sync")).collect()} == {"u0", "u1", "u2", "u3", "x"}
    # back to an earlier content
    assert run(chunks("a", "b", "c", "d"), "overwrite")[0] == 5
    assert {r["content"] for r in read_sync_table(spark, str(tmp_path / "sync")).collect()} == {"a", "b", "c", "d", "other"}


def test_newest_of_several_contents_in_a_batch(spark, tmp_path):
    """Keys of the first run are stored with their old text, the others are not; either text may have the greater hash."""
    import os

    schema = "path string, chunk_pos int, content string, edition int"
    sources = {"times": None, "editions": "edition"}

    def run(name):
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / name))
        sync_embeddings(stream, str(tmp_path / f"sync-{name}"), str(tmp_path / f"cp-{name}"), load_digit_embedder,
                        order_col=sources[name])
        rows = read_sync_table(spark, str(tmp_path / f"sync-{name}")).collect()
        return {r["url"]: r["content"] for r in rows}, len(rows)

    def write(name, edition, keys):
        known = set((tmp_path / name).glob("*.parquet"))
        rows = [(f"u{i}", 0, f"text {i} of {edition}", edition) for i in keys]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / name))
        # the file times of the second source say the contrary of its editions
        at = 1_700_000_000 + (edition if sources[name] is None else -edition)
        for file in set((tmp_path / name).glob("*.parquet")) - known:
            os.utime(file, (at, at))

    for name in sources:
        write(name, 1, range(20))
        assert run(name)[0] == {f"u{i}": f"text {i} of 1" for i in range(20)}
        write(name, 3, range(40))
        write(name, 1, range(40))
        write(name, 2, range(40))
        assert run(name) == ({f"u{i}": f"text {i} of 3" for i in range(40)}, 40)
    with pytest.raises(ValueError):
        rows = spark.readStream.format("rate").load().selectExpr("'u' AS path", "0 AS chunk_pos", "'c' AS content")
        sync_embeddings(rows, str(tmp_path / "none"), str(tmp_path / "cp-none"), load_digit_embedder)


def test_index_refresh_embeds_only_changes(spark, tmp_path):
    sent = tmp_path / "sent"
    sent.mkdir()
    folder = str(sent)

    def load():
        import uuid
        model = load_digit_embedder()

        def noted(batch):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(batch))
            return model(batch)
        return noted

    def source(rows):
        return spark.createDataFrame(rows, "id bigint, url string, content string")

    path = str(tmp_path / "index")
    build_index(source([(1, "u", "a"), (2, "u", "b"), (3, "u", "c")]), path, load_embedder=load)
    after = source([(1, "u", "a"), (2, "u", "B b"), (4, "u", "d")])
    changes = refresh_index(after, path, load_embedder=load)
    assert {tuple(r) for r in changes.collect()} == {(2, "update"), (3, "delete"), (4, "insert")}
    assert {(r["id"], r["content"], sum(r["embedding"])) for r in read_index(spark, path).collect()} == {
        (1, "a", 1.0), (2, "B b", 2.0), (4, "d", 1.0)}
    texts = [t for p in sent.iterdir() for t in p.read_text().split("\n")]
    assert sorted(texts) == ["B b", "a", "b", "c", "d"]
    # the second version has the changes alone, the files of the first are as they were
    assert spark.read.parquet(f"{path}/rows/version=2").count() == 3
    assert spark.read.parquet(f"{path}/rows/version=1").count() == 3
    assert refresh_index(after, path, load_embedder=load).isEmpty()
    assert versions(spark, path) == [1, 2]
    # a version whose write did not end is not read, and replaced by the next refresh
    spark.read.parquet(f"{path}/rows/version=1").write.parquet(f"{path}/rows/version=3")
    assert versions(spark, path) == [1, 2]
    assert read_index(spark, path).count() == 3
    refresh_index(source([(1, "u", "a"), (2, "u", "B b"), (3, "u", "c again"), (4, "u", "d")]), path, load_embedder=load)
    shown = {(1, "a"), (2, "B b"), (3, "c again"), (4, "d")}
    assert {tuple(r) for r in read_index(spark, path).select("id", "content").collect()} == shown
    compact_index(spark, path)
    assert versions(spark, path) == [4]
    assert {tuple(r) for r in read_index(spark, path).select("id", "content").collect()} == shown
    refresh_index(source([(1, "u", "a"), (2, "u", "B b"), (3, "u", "c again")]), path, load_embedder=load)
    assert {tuple(r) for r in read_index(spark, path).select("id", "content").collect()} == shown - {(4, "d")}
    with pytest.raises(FileExistsError):
        build_index(after, path, load_embedder=load)
    with pytest.raises(ValueError):
        refresh_index(source([(1, "u", "z")]), path)
    with pytest.raises(FileNotFoundError):
        read_index(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("limits", [{}, {"max_broadcast": 0}, {"max_broadcast": 0, "max_bitmap": 0}])
def test_merge_on_read(spark, tmp_path, limits):
    """Twelve versions that insert, change and delete keys at random, also keys with negative hashes and none changed at all."""
    rnd, path, rows = random.Random(8), str(tmp_path / "index"), {}

    def source():
        return spark.createDataFrame([(k, "u", v) for k, v in rows.items()], "id bigint, url string, content string").withColumn(
            "embedding", F.array(F.length("content").cast("float")))

    for number in range(12):
        for _ in range(40 if not number else 6):
            key = rnd.randrange(60)
            if rnd.random() < 0.3 and len(rows) > 5:
                rows.pop(key, None)
            else:
                rows[key] = f"content {rnd.randrange(1000)} of {number}"
        if number:
            refresh_index(source(), path, embedding_col="embedding")
        else:
            build_index(source(), path, embedding_col="embedding")
        if number in (0, 1, 11):
            found = read_index(spark, path, **limits)
            assert {(r["id"], r["content"]) for r in found.collect()} == set(rows.items())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") >= 2 and "embedding" not in "".join(x for x in plan.splitlines() if "HashAggregate" in x)


def test_rows_without_changes_are_not_shuffled(spark):
    """With a bitmap, only rows whose bit is set meet the changed keys in a shuffle."""
    rows = spark.range(50_000).withColumn("version", F.lit(1))
    changed = spark.range(0, 50_000, 97).withColumn("last", F.lit(2))
    found = without_changed(rows, changed, 516, max_broadcast=0)
    assert found.count() == 50_000 - 516 and found.filter("id % 97 = 0").isEmpty()


def test_latest_rows_without_sorting_rows(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 5, "b"), (1, None, "z"), (2, None, "c"), (None, 1, "d"), (None, 1, "d")],
                               "k int, t int, x string")
    found = latest_rows(df, "k", ["t"])
    rows = sorted(map(tuple, found.collect()), key=str)
    assert [r[0] for r in rows] == [1, 2, None] and rows[1:] == [(2, None, "c"), (None, 1, "d")] and rows[0][2] in "ab"
    assert sorted(map(tuple, latest_rows(df.repartition(3), "k", ["t"]).collect()), key=str) == rows
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_older_contents_that_arrive_late_are_left_out(spark, tmp_path):
    schema = "path string, chunk_pos int, content string, edition int"
    sent = tmp_path / "sent"
    sent.mkdir()
    folder = str(sent)

    def load():
        import uuid
        model = load_digit_embedder()

        def noted(batch):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(batch))
            return model(batch)
        return noted

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        sync_embeddings(stream, str(tmp_path / "sync"), str(tmp_path / "cp"), load, order_col="edition")
        found = read_sync_table(spark, str(tmp_path / "sync")).collect()
        return {r["url"]: r["content"] for r in found}, len(found)

    assert run([("a", 0, "two", 2), ("b", 0, "x", None), ("c", 0, None, 1)]) == ({"a": "two", "b": "x", "c": None}, 3)
    # older, newer than none, the same content under a newer order, and a tie that arrives later
    assert run([("a", 0, "one", 1), ("b", 0, "y", 0), ("c", 0, None, 9)]) == ({"a": "two", "b": "y", "c": None}, 3)
    assert run([("c", 0, "old", 8), ("a", 0, "two again", 2)]) == ({"a": "two again", "b": "y", "c": None}, 3)
    assert sorted(t for p in sent.iterdir() for t in p.read_text().split("\n")) == ["two", "two again", "x", "y"]
    with pytest.raises(ValueError):
        rows = spark.readStream.schema("path string, chunk_pos int, content string, edition string").parquet(str(tmp_path / "in"))
        sync_embeddings(rows, str(tmp_path / "sync"), str(tmp_path / "cp4"), load, order_col="edition")


def test_a_call_keeps_the_state_of_many_keys():
    import pandas as pd

    from passagework.streaming import embed_sync

    class State:
        exists = False

        def update(self, value):
            self.exists, self.get = True, value

    def run(*rows):
        frames = [pd.DataFrame([r], columns=["id", "url", "content", "content_hash", "order"]) for r in rows]
        return {tuple(r[:3]) for f in embed_sync._changed((3,), iter(frames), state) for r in f.values.tolist()}

    state = State()
    assert run(("a", "u", "1", "h1", 1), ("b", "v", None, "h0", 5), ("a", "u", "2", "h2", 1)) == {("a", "u", "2"), ("b", "v", None)}
    # the same content under a newer order, an older one, a new key
    assert run(("a", "u", "2", "h2", 7), ("b", "v", "old", "h3", 4), ("c", "w", "x", "h4", 0)) == {("c", "w", "x")}
    assert run(("a", "u", "3", "h5", 6)) == set()
    assert run(("a", "u", "3", "h5", 7)) == {("a", "u", "3")}


def test_changes_see_nulls(spark):
    before = spark.createDataFrame([(1, None), (2, ""), (3, None), (4, "x")], "id int, t string")
    after = spark.createDataFrame([(1, ""), (2, ""), (3, None), (5, "x")], "id int, t string")
    got = snapshot_changes(before, after, "id", ["t"])
    assert {tuple(r) for r in got.collect()} == {(1, "update"), (4, "delete"), (5, "insert")}


def test_state_changes_open_touched_buckets_only(spark, tmp_path):
    schema = "id bigint, t string, other string"
    before = {i: (f"t{i}", "x") for i in range(500)} | {500: (None, None)}
    after = {i: (f"t{i}", "y") for i in range(500) if i not in (7, 8)} | {500: ("", None), 3: ("changed", "x"), 900: ("new", None)}
    for name, rows in (("before", before), ("after", after), ("none", {})):
        write_state(spark.createDataFrame([(k, *v) for k, v in rows.items()], schema), str(tmp_path / name), "id", ["t"], 64)
    paths = [str(tmp_path / "before"), str(tmp_path / "after")]
    found = state_changes(spark, *paths, "id")
    assert found.columns == ["id", "change", "t", "other"]
    assert {tuple(r) for r in found.collect()} == {
        (7, "delete", None, None), (8, "delete", None, None), (500, "update", "", None), (3, "update", "changed", "x"),
        (900, "insert", "new", None)}
    touched = touched_buckets(spark, *paths)
    assert 1 <= len(touched) <= 5
    read = {r[0] for path in paths for r in spark.read.parquet(f"{path}/rows").filter(
        F.col("_bucket").isin(touched)).select(F.input_file_name()).distinct().collect()}
    every = {f for path in paths for f in spark.read.parquet(f"{path}/rows").inputFiles()}
    assert 0 < len(read) < 0.2 * len(every)
    plan = state_changes(spark, *paths, "id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(", "")
    assert state_changes(spark, paths[1], paths[1], "id").count() == 0
    assert touched_buckets(spark, str(tmp_path / "none"), paths[0]) == sorted(
        r[0] for r in spark.read.parquet(f"{paths[0]}/digests").select("_bucket").collect())
    assert state_changes(spark, str(tmp_path / "none"), paths[0], "id").groupBy("change").count().collect() == [("insert", 501)]
    write_state(spark.createDataFrame([(1, "a", "b")], schema), str(tmp_path / "few"), "id", ["t"], 8)
    with pytest.raises(ValueError):
        touched_buckets(spark, paths[0], str(tmp_path / "few"))


def test_latest(spark):
    df = spark.createDataFrame([("m", "9", 1), ("m", "10", 2), ("m", "x", 3), ("n", "2", 4)], "k string, v string, t int")
    assert {tuple(r) for r in latest_version(df, "k", "v").collect()} == {("m", 10), ("n", 2)}
    assert {tuple(r) for r in latest_rows(df, "k", ["t"]).collect()} == {("m", "x", 3), ("n", "2", 4)}
    tied = df.withColumn("t", F.lit(1))
    assert {tuple(r) for r in latest_rows(tied, "k", ["t", "v"]).collect()} == {("m", "x", 1), ("n", "2", 1)}


def test_session_helpers(spark, tmp_path):
    assert is_small(spark.range(5), 5) and not is_small(spark.range(6), 5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with arrow_batches(spark, 3, 1000):
            assert spark.conf.get(key) == "3"
            assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1000"
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert write_once(spark.range(7)).count() == 7
    assert spread(spark.range(100, numPartitions=64), "id").rdd.getNumPartitions() == 64
    assert spread(spark.range(100, numPartitions=1), "id").rdd.getNumPartitions() == 32


def test_chunk_schema(spark):
    df = spark.createDataFrame([("u", "a. b.")], "url string, t string")
    check_columns(chunk_rows(df, "t", "url"), CHUNKS)
