"""Tables as streams: what each micro-batch reads."""

from pyspark.sql import functions as F
from rows import tuples

from millrace.catalog import tables as t
from millrace.plans import panes
from millrace.streaming import runs

MEGABYTE = 1024 * 1024


def documents(spark, folder, rows):
    """(doc_id, size of its text) pairs as a table; the texts do not compress well."""
    table = spark.createDataFrame(rows, "doc_id BIGINT, size INT")
    count = (F.col("size") / 64).cast("int")
    digest = lambda i: F.sha2(F.concat_ws("-", i.cast("string"), F.col("doc_id").cast("string")), 256)
    text = F.array_join(F.transform(F.sequence(F.lit(1), count), digest), "").alias("text")
    table.select("doc_id", text).write.parquet(f"{folder}/documents.parquet")
    return folder


def shown(spark, stream):
    rows = stream.select("doc_id", F.octet_length("text").alias("size"), F.input_file_name().alias("file"))
    return runs.emitted(rows).cache()


def test_files_of_a_batch_follow_its_bytes(spark, tmp_path):
    folder = documents(spark, str(tmp_path), [(i, MEGABYTE // 4) for i in range(160)])
    rows = shown(spark, t.table_stream(spark, folder, "documents", F.col("doc_id")))
    per_batch = rows.groupBy(runs.BATCH).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")
    )
    assert tuples(per_batch, runs.BATCH, "low", "high", "n") == [
        (i, 40 * i, 40 * i + 39, 40) for i in range(4)
    ]
    per_file = rows.groupBy("file").agg(F.sum("size").alias("size"))
    assert per_file.agg(F.max("size")).head()[0] <= t.FILE_BYTES + MEGABYTE


def test_uneven_batches_stay_apart(spark, tmp_path):
    """The first batch has one row, the second none, the third twenty large ones."""
    large = [(i, MEGABYTE) for i in range(50, 70)]
    folder = documents(spark, str(tmp_path), [(0, 64), *large, (99, 64)])
    closing = ("doc_id", lambda last: F.lit(last + 1000))
    rows = shown(spark, t.table_stream(spark, folder, "documents", F.col("doc_id"), closing))
    assert tuples(rows, "doc_id", runs.BATCH) == sorted(
        [(0, 0), *[(i, 2) for i, _ in large], (99, 3), (1099, 4)]
    )


def test_larger_tables_have_more_batches_where_asked(spark, tmp_path):
    folder = documents(spark, str(tmp_path), [(i, MEGABYTE // 8) for i in range(64)])
    stream = t.table_stream(spark, folder, "documents", F.col("doc_id"), None, MEGABYTE)
    rows = shown(spark, stream)
    per_batch = rows.groupBy(runs.BATCH).agg(F.min("doc_id").alias("low"), F.sum("size").alias("size"))
    assert per_batch.agg(F.max("size")).head()[0] <= MEGABYTE
    lows = [low for _, low in tuples(per_batch, runs.BATCH, "low")]
    assert len(lows) > 4 and lows == sorted(lows)


def test_sums_are_made_before_rows_are_copied(spark, tmp_path):
    folder = documents(spark, str(tmp_path), [(i, 64) for i in range(4)])
    lines = t.as_lines(t.table_stream(spark, folder, "documents", F.col("doc_id")))
    counted = {"n": F.size(F.split("text", "a")).cast("bigint")}
    sums = panes.sliding_sums(lines, "ts", 10 * panes.SECOND, 2 * panes.SECOND, counted)
    plan = sums._jdf.queryExecution().analyzed().toString()
    assert plan.index("Expand") < plan.index("split(")
