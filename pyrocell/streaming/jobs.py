"""Monitoring as Structured Streaming: each function turns a stream of hotspots or detections into another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrocell.sources import commits
from pyrocell.streaming.exclusion import FirstAlerts


def windowed_counts(hotspots: DataFrame, by: list[str], size: str = "30 days", slide: str | None = None, late: str = "7 days") -> DataFrame:
    """Detections by window and territory; windows tumble, or slide for alerts. In append mode a window is given once,
    when the watermark has passed its end, and its state goes then."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return hotspots.withWatermark("ts", late).groupBy(window, *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


#: Buckets of pixels whose state is kept together; and what stands for a void pixel there.
BUCKETS, VOID = 4096, -(1 << 63)


def first_alerts(hotspots: DataFrame, days: float = 30, late: str = "1 day") -> DataFrame:
    """One alert (pixel_id, event_id, ts) of a pixel in each exclusion period of ``days``.

    A pixel's first hotspot is an alert, and so is the first one at or after the end of the period that the last alert
    began (ties: the least event_id). Hotspots wait in the pixel's state until the watermark has passed them and are then
    judged in the order of their times, so alerts don't depend on how the stream is cut into batches; what the watermark
    hasn't passed isn't judged yet. A pixel's state goes when its period ends with nothing waiting; the state of a bucket of
    pixels is one value, so calls to the store grow with buckets, not with pixels.

    The session's new streams keep their state in RocksDB from then on, which timers need.
    """
    hotspots.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    pixel = F.coalesce(F.col("pixel_id").cast("long"), F.lit(VOID))
    rows = hotspots.select(pixel.alias("pixel_id"), "event_id", "ts").withColumn("bucket", F.pmod(F.xxhash64("pixel_id"), F.lit(BUCKETS))).withWatermark("ts", late)
    processor = FirstAlerts(int(days * 86_400_000_000))
    out = rows.groupBy("bucket").transformWithStateInPandas(statefulProcessor=processor, outputStructType="pixel_id long, event_id long, ts timestamp", outputMode="Append", timeMode="EventTime")
    return out.withColumn("pixel_id", F.nullif("pixel_id", F.lit(VOID)))


def split_late(stream: DataFrame, path: str, checkpoint: str, late: str = "1 day", time: str = "ts"):
    """Writes each batch's rows that are on time below ``path``/on_time and the others below ``path``/late.

    A row is late when its time is more than ``late`` before the latest time of the batches before its own. What reads
    ``on_time`` with the same watermark, in whole batches and in their order, drops no row. Each batch replaces its own
    parts only, so a replay leaves the same tables.
    """

    def put(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        top = batch.agg(F.max(time).alias("top"))
        if n:
            before = spark.read.schema("top timestamp").parquet(f"{path}/top/batch={n - 1}")
            top, edge = top.unionByName(before).agg(F.max("top").alias("top")), F.broadcast(before.select((F.col("top") - F.expr(f"INTERVAL {late}")).alias("__edge")))
        else:
            edge = F.broadcast(spark.range(1).select(F.lit(None).cast("timestamp").alias("__edge")))
        marked = batch.join(edge).withColumn("__late", F.coalesce(F.col(time) < F.col("__edge"), F.lit(False)))
        marked.where("NOT __late").select(*batch.columns).write.mode("overwrite").parquet(f"{path}/on_time/batch={n}")
        marked.where("__late").select(*batch.columns).write.mode("overwrite").parquet(f"{path}/late/batch={n}")
        top.coalesce(1).write.mode("overwrite").parquet(f"{path}/top/batch={n}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def not_yet_burned(detections: DataFrame, burned: DataFrame) -> DataFrame:
    """Arriving detections of pixels that a batch table of earlier months doesn't hold."""
    return detections.join(burned.select("pixel_id").distinct(), "pixel_id", "left_anti")


def near_hotspots(observations: DataFrame, hotspots: DataFrame, days: int = 30, late: str = "2 days") -> DataFrame:
    """Arriving observations with a hotspot of their pixel in the ``days`` before them; both sides are streams whose
    state is let go by watermark and interval."""
    o = observations.withWatermark("acq_ts", late)
    h = hotspots.withWatermark("ts", late).select(F.col("pixel_id").alias("spot_pixel"), F.col("ts").alias("spot_ts"))
    return o.join(h, F.expr(f"pixel_id = spot_pixel AND acq_ts >= spot_ts AND acq_ts <= spot_ts + INTERVAL {days} DAYS"))


def episodes(hotspots: DataFrame, gap: str = "3 days", late: str = "1 day") -> DataFrame:
    """Hotspots of a pixel closer than ``gap`` as one episode."""
    out = hotspots.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "pixel_id").agg(F.count("*").alias("n"))
    return out.select("pixel_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def upsert_months(stream: DataFrame, path: str, checkpoint: str):
    """Adds each batch's (pixel_id, year, month) to the table at ``path``, as a part of its own.

    A part is named by the query (its checkpoint) and the batch, and counts from its commit on (see ``commits``). A batch
    run again replaces its own part only, or changes nothing where that has been folded; so batches add to months that
    are already there, and a replay leaves the same table. ``months`` reads the table, ``compacted`` folds its parts.
    """
    writer = commits.writer_of(checkpoint)

    def put(batch: DataFrame, n: int) -> None:
        commits.add(batch.select("pixel_id", "year", "month").distinct(), path, writer, n, ["year", "month"])

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


MONTHS = "pixel_id long, year int, month int"


def months(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``upsert_months`` keeps: (pixel_id, year, month) without repeats, whatever batches they came in.
    One snapshot: batches and folding that happen later aren't seen."""
    return commits.snapshot(spark, path, MONTHS).distinct()


def compacted(spark: SparkSession, path: str, to: str | None = None) -> None:
    """Folds all parts into one, while readers and writers go on; with ``to``, as a table of its own elsewhere."""
    if to:
        commits.add(months(spark, path).repartition("year", "month"), to, "compacted", 0, ["year", "month"])
    else:
        commits.fold(spark, path, MONTHS, ["year", "month"], lambda df: df.distinct())
