from pyspark.sql import functions as F

from sparkloom.streaming.windows import covered_bins, windowed_counts


def test_stream_gives_what_the_batch_gives(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", (F.col("value") * 3600).alias("seconds"), "value")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    for name, frame, batch in (
        ("counts", windowed_counts(stream, "event_type", "ts", "value", "1 hour"), windowed_counts(events, "event_type", "ts", "value", "1 hour")),
        ("bins", covered_bins(stream, "user_id", "ts", "seconds", 3600), covered_bins(events, "user_id", "ts", "seconds", 3600)),
    ):
        run = frame.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
        run.awaitTermination(120)
        got = {tuple(r)[:3] for r in spark.table(name).collect()}
        assert got == {tuple(r)[:3] for r in batch.collect()} and got
