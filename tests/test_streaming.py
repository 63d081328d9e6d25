"""Streams end where the batch twins do."""

from pyspark.sql import functions as F

from gleanery.plans.registry import QUERIES
from gleanery.sources.tables import runs
from gleanery.streaming.keyed import block_cache, blocked_stream, windowed_counts


def test_blocked_stream_is_the_replay(spark, sf_dir, tmp_path):
    log = runs(spark, sf_dir).select("source", "event_id", "status")
    log.orderBy("event_id").repartitionByRange(3, "event_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in"))
    q = blocked_stream(stream).writeStream.outputMode("update").format("memory").queryName("blocked").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.source, r.streak, r.blocked) for r in spark.sql("select * from blocked").collect()}
    assert got == {(r.source, r.streak, r.blocked) for r in QUERIES["blocked_replay"](spark, sf_dir).collect()}


def test_windows_and_cache(spark, sf_dir, tmp_path):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    (tmp_path / "ev").mkdir()
    spark.read.parquet(f"{sf_dir}/events.parquet").coalesce(1).write.parquet(str(tmp_path / "ev/all"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "ev/all"))
    q = windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) from hours").first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("a", 100), ("b", 2)], "hash string, day long")
    rows.write.parquet(str(tmp_path / "blocks"))
    q = block_cache(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "blocks"))).writeStream.outputMode("append").format("memory").queryName("cache").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.table("cache").select("hash", "day", "hit", F.col("first_day")).collect()) == [("a", 1, False, 1), ("a", 5, True, 1), ("a", 100, False, 100), ("b", 2, False, 2)]
