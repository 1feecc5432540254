"""Sources, projections, changes and versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.catalog.common import plain, sql_clean, table
from passagework.functions.text import clean_text
from passagework.operators.changes import latest_rows, latest_version, snapshot_changes, state_changes, write_state
from passagework.operators.extract import extract
from passagework.session import scratch_dir
from passagework.sources.files import scan_files, without_name
from passagework.sources.tables import append_table, create_schema, create_table, overwrite_table
from passagework.streaming.ingest import append_stream, ingest_files


def _document_files(spark: SparkSession, folder: str) -> str:
    """Write the documents to text files, one page per document, many pages per file."""
    path = f"{scratch_dir(spark)}/files"
    texts = table(spark, folder, "documents").select("text")
    texts.write.option("lineSep", "\f").option("maxRecordsPerFile", 200).text(path)
    return path


def binary_scan(spark: SparkSession, folder: str) -> DataFrame:
    files = scan_files(spark, _document_files(spark, folder), "*.txt")
    pages = extract(files, "utf8").select(F.explode("pages").alias("page")).filter(F.col("page") != "")
    return pages.groupBy(F.md5(clean_text(F.col("page"))).alias("page_md5")).agg(F.count("*").alias("n"))


def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = _document_files(spark, folder)
    work = scratch_dir(spark)
    for _ in range(2):
        ingest_files(spark, path, f"{work}/checkpoint", "*.txt", path=f"{work}/raw")
    raw = spark.read.parquet(f"{work}/raw")
    return raw.agg(
        F.sum("length").alias("n_bytes"),
        F.sum(F.regexp_count(F.col("content").cast("string"), F.lit("\f"))).cast("bigint").alias("n_pages"),
        (F.count("*") - F.count_distinct("path")).alias("n_repeated"),
    )


def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    work = scratch_dir(spark)
    schema = table(spark, folder, "events").schema
    for _ in range(2):
        rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
        append_stream(rows.select("event_id", "event_type"), f"{work}/checkpoint", path=f"{work}/events")
    return spark.read.parquet(f"{work}/events")


def _states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the documents: German ones arrive, Spanish ones go, French ones change."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "text")
    before = documents.filter("lang <> 'de'")
    text = F.when(F.col("lang") == "fr", F.concat(F.col("text"), F.lit(" fin"))).otherwise(F.col("text"))
    return before, documents.filter("lang <> 'es'").withColumn("text", text)


def changes(spark: SparkSession, folder: str) -> DataFrame:
    before, after = _states(spark, folder)
    return snapshot_changes(before, after, "doc_id", ["text"])


def touched(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of which about one in a hundred changes, compared by the digests of their buckets."""
    work, documents = scratch_dir(spark), table(spark, folder, "documents").select("doc_id", "lang", "text")
    text = F.when(F.col("doc_id") % 97 == 5, F.concat(F.col("text"), F.lit(" fin"))).otherwise(F.col("text"))
    for name, state in (("before", documents), ("after", documents.withColumn("text", text))):
        write_state(state, f"{work}/{name}", "doc_id", ["text"])
    found = state_changes(spark, f"{work}/before", f"{work}/after", "doc_id")
    return found.select("doc_id", "change", F.md5("text").alias("text_md5"))


def append_history(spark: SparkSession, folder: str) -> DataFrame:
    """Both states appended to one table; the current view is the last one of each document."""
    path = f"{scratch_dir(spark)}/history"
    for number, state in enumerate(_states(spark, folder), 1):
        state.withColumn("ingest", F.lit(number)).write.mode("append").parquet(path)
    current = latest_rows(spark.read.parquet(path), "doc_id", ["ingest"])
    return plain(current.select("doc_id", "ingest", F.md5("text").alias("text_md5")))


def _schema(spark: SparkSession) -> str:
    """A new schema whose tables lie in the scratch folder."""
    name = f"catalog_{uuid.uuid4().hex}"
    create_schema(spark, name, scratch_dir(spark))
    return name


def overwritten(spark: SparkSession, folder: str) -> DataFrame:
    """Two states of the documents in one table: the second replaces the first."""
    name = f"{_schema(spark)}.documents"
    for state in _states(spark, folder):
        overwrite_table(state, name)
    return spark.table(name).select("doc_id", F.md5("text").alias("text_md5"))


def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Events appended in two parts to a table and read with a filter."""
    name, events = f"{_schema(spark)}.events", table(spark, folder, "events").select("event_id", "event_type", "value")
    for part in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")):
        append_table(part, name)
    return spark.table(name).filter("event_type = 'click'").select("event_id", "value")


def streamed_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table read as a stream into another one, in two runs over a growing table."""
    schema, work = _schema(spark), scratch_dir(spark)
    events = table(spark, folder, "events").select("event_id", "event_type")
    for part in (events.filter("event_type = 'click'"), events.filter("event_type <> 'click'")):
        append_table(part, f"{schema}.events")
        append_stream(spark.readStream.table(f"{schema}.events"), f"{work}/checkpoint", table=f"{schema}.copied")
    return spark.table(f"{schema}.copied")


def created_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table declared first, filled with rows of the declared columns."""
    name = f"{_schema(spark)}.parts"
    declared = table(spark, folder, "part").select("p_partkey", "p_name").schema
    for _ in range(2):
        create_table(spark, name, declared)
    append_table(table(spark, folder, "part").select("p_partkey", "p_name"), name)
    return spark.table(name)


QUERIES = {
    "s5_overwrite_table": overwritten,
    "s7_table_scan": table_scan,
    "s8_stream_table_scan": streamed_table,
    "s9_create_table": created_table,
    "s1_binary_scan": binary_scan,
    "s2_incremental_ingest": incremental_ingest,
    "s3_exclude_by_name": lambda s, d: table(s, d, "documents")
    .filter(without_name(F.col("source"), "src1")).select("doc_id", "source"),
    "s4_stream_append": stream_append,
    "s6_latest_rows": lambda s, d: latest_rows(
        table(s, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), "user_id", ["ts", "event_id"]
    ).select("user_id", "event_id", "event_type", "value"),
    "s6_append_history": append_history,
    "s10_changes": changes,
    "s10_touched_buckets": touched,
    "p1_preview": lambda s, d: s.read.parquet(f"{d}/documents.parquet")
    .select("doc_id", "lang", "source").orderBy("doc_id").limit(10),
    "p2_suffix_filter": lambda s, d: table(s, d, "pages")
    .filter(F.endswith("url", F.lit(".html"))).select("page_id", "url"),
    "p3_select_rename": lambda s, d: table(s, d, "pages").selectExpr("page_id AS id", "url AS address"),
    "p4_replace_column": lambda s, d: table(s, d, "documents")
    .withColumn("source", F.concat_ws("/", "source", "lang")).select("doc_id", "source", "n_chars"),
    "a1_latest_version": lambda s, d: latest_version(
        table(s, d, "events").select("user_id", F.get_json_object("props", "$.k").alias("version")),
        "user_id", "version"),
}

_BEFORE = "SELECT doc_id, text FROM documents WHERE lang <> 'de'"
_AFTER = """SELECT doc_id, CASE WHEN lang = 'fr' THEN text || ' fin' ELSE text END AS text
  FROM documents WHERE lang <> 'es'"""

ORACLES = {
    "s5_overwrite_table": f"SELECT doc_id, md5(text) AS text_md5 FROM ({_AFTER})",
    "s7_table_scan": "SELECT event_id, value FROM events WHERE event_type = 'click'",
    "s8_stream_table_scan": "SELECT event_id, event_type FROM events",
    "s9_create_table": "SELECT p_partkey, p_name FROM part",
    "s1_binary_scan": f"SELECT md5({sql_clean('text')}) AS page_md5, count(*) AS n FROM documents GROUP BY 1",
    "s2_incremental_ingest": """SELECT sum(strlen(text) + 1)::BIGINT AS n_bytes, count(*) AS n_pages,
      0::BIGINT AS n_repeated FROM documents""",
    "s3_exclude_by_name": "SELECT doc_id, source FROM documents WHERE source NOT LIKE '%src1%'",
    "s4_stream_append": "SELECT event_id, event_type FROM events",
    "s6_latest_rows": """SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
      WHERE rn = 1""",
    "s6_append_history": f"""WITH b AS ({_BEFORE}), a AS ({_AFTER})
      SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 1 ELSE 2 END::BIGINT AS ingest,
        md5(CASE WHEN a.doc_id IS NULL THEN b.text ELSE a.text END) AS text_md5
      FROM b FULL JOIN a ON a.doc_id = b.doc_id""",
    "s10_changes": f"""WITH b AS ({_BEFORE}), a AS ({_AFTER})
      SELECT coalesce(b.doc_id, a.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'insert'
        WHEN a.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
      FROM b FULL JOIN a ON a.doc_id = b.doc_id WHERE a.text IS DISTINCT FROM b.text""",
    "s10_touched_buckets": """SELECT doc_id, 'update' AS change, md5(text || ' fin') AS text_md5 FROM documents
      WHERE doc_id % 97 = 5""",
    "p1_preview": "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 10",
    "p2_suffix_filter": "SELECT page_id, url FROM pages WHERE url LIKE '%.html'",
    "p3_select_rename": "SELECT page_id AS id, url AS address FROM pages",
    "p4_replace_column": "SELECT doc_id, source || '/' || lang AS source, n_chars FROM documents",
    "a1_latest_version": """SELECT user_id, max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS latest_version
      FROM events GROUP BY 1""",
}
