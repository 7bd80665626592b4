"""Streaming jobs (R) run to the end of what is there, and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrocell.plans.registry import query
from pyrocell.plans.views import HOTSPOTS
from pyrocell.sources.shared import new_path
from pyrocell.streaming import jobs


def stream(v) -> DataFrame:
    """The events table as a stream of hotspots; a folder or a single file is read through a pattern."""
    schema = v.table("events").schema
    return v.spark.readStream.schema(schema).parquet(f"{v.sf_dir}/event[s].parquet").where("event_type = 'error'").withColumn("ts", F.col("ts").cast("timestamp")).selectExpr(*v._of(HOTSPOTS))


def drained(df: DataFrame, mode: str = "append") -> DataFrame:
    """What the stream gives, as a table written in the shared folder."""
    spark, folder = df.sparkSession, new_path(df.sparkSession)

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")

    q = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{folder}/out")
    if mode != "append":
        out = out.join(F.broadcast(out.agg(F.max("batch").alias("batch"))), "batch", "left_semi")
    times = [f.name for f in df.schema if f.dataType == T.TimestampType()]
    return out.drop("batch").withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query("SELECT time_bucket(INTERVAL 1 DAY, ts)::TIMESTAMP AS start, x, count(*) AS n FROM hotspots GROUP BY 1, 2")
def r1_windowed_counts(v) -> DataFrame:
    return drained(jobs.windowed_counts(stream(v), ["x"], "1 day"), "complete")


@query("SELECT start, x, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 DAY, ts)::TIMESTAMP - k * INTERVAL 1 DAY AS start, x FROM hotspots, range(0, 3) r(k)) GROUP BY 1, 2")
def r1_sliding_counts(v) -> DataFrame:
    return drained(jobs.windowed_counts(stream(v), ["x"], "3 days", "1 day"), "complete")


#: Hotspots in four arrivals of eight days each; every tenth comes with the arrival after its own.
ARRIVAL = "CAST(least(3, floor(datediff('day', TIMESTAMP '2024-01-01', ts) / 8) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS INT)"
ON_TIME = f"""WITH h AS (SELECT event_id, ts, pixel_id, x, {ARRIVAL} AS arrival FROM hotspots), tops AS (SELECT arrival, max(ts) AS top FROM h GROUP BY 1),
judged AS (SELECT h.*, coalesce(ts < (SELECT max(top) FROM tops WHERE tops.arrival < h.arrival) - INTERVAL 1 DAY, FALSE) AS late FROM h),
o AS (SELECT * FROM judged WHERE NOT late), mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS w FROM o)"""


def arrived(v) -> str:
    """Where the hotspots are as they come, one file an arrival, parted into those on time and the late ones."""
    path = new_path(v.spark)
    rows = v.hotspots.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "pixel_id", "x")
    rows = rows.withColumn("arrival", F.least(F.lit(3), F.floor(F.datediff("ts", F.lit("2024-01-01")) / 8) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)))
    for k in range(4):
        rows.where(F.col("arrival") == k).drop("arrival").coalesce(1).write.mode("append").parquet(f"{path}/in")
    files = v.spark.readStream.schema(rows.drop("arrival").schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    jobs.split_late(files, path, f"{path}/checkpoint").awaitTermination()
    return path


def on_time(v) -> DataFrame:
    """The hotspots on time as a stream, an arrival a batch."""
    return v.spark.readStream.schema("event_id long, ts timestamp, pixel_id long, x int, batch int").option("maxFilesPerTrigger", 1).parquet(f"{arrived(v)}/on_time").drop("batch")


@query(f"{ON_TIME} SELECT event_id, ts, pixel_id FROM judged WHERE late")
def r1_late_rows(v) -> DataFrame:
    late = v.spark.read.schema("event_id long, ts timestamp, pixel_id long, x int, batch int").parquet(f"{arrived(v)}/late")
    return late.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "pixel_id")


@query(f"{ON_TIME} SELECT time_bucket(INTERVAL 1 DAY, ts)::TIMESTAMP AS start, x, count(*) AS n FROM o, mark GROUP BY 1, 2, w HAVING start + INTERVAL 1 DAY <= w")
def r1_closed_windows(v) -> DataFrame:
    """Append mode over four batches: each window once, when the watermark has passed it; late rows count nowhere."""
    return drained(jobs.windowed_counts(on_time(v), ["x"], "1 day", late="1 day"))


@query(f"""{ON_TIME}, s AS (SELECT *, sum(new) OVER (PARTITION BY pixel_id ORDER BY ts, event_id) AS episode FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY pixel_id ORDER BY ts, event_id) + INTERVAL 1 DAY THEN 0 ELSE 1 END AS new FROM o))
SELECT pixel_id, min(ts) AS start, max(ts) + INTERVAL 1 DAY AS "end", count(*) AS n FROM s, mark GROUP BY pixel_id, episode, w HAVING max(ts) + INTERVAL 1 DAY <= w""")
def r5_closed_episodes(v) -> DataFrame:
    """Append mode over four batches: each episode once, when nothing on time can join it any more."""
    return drained(jobs.episodes(on_time(v), "1 day"))


@query(f"""{ON_TIME.replace('WITH h', 'WITH RECURSIVE h')}, following AS (SELECT a.event_id, arg_min(b.event_id, b.ts) AS next_id FROM o a JOIN o b ON a.pixel_id = b.pixel_id AND a.ts + INTERVAL 2 DAY <= b.ts GROUP BY 1),
alerts AS (SELECT pixel_id, arg_min(event_id, ts) AS event_id FROM o GROUP BY 1 UNION ALL SELECT a.pixel_id, f.next_id FROM alerts a JOIN following f ON f.event_id = a.event_id)
SELECT a.pixel_id, a.event_id, o.ts FROM alerts a JOIN o ON o.event_id = a.event_id, mark WHERE o.ts <= w""")
def r2_first_alerts(v) -> DataFrame:
    """One alert of a pixel in each two days, of all that the watermark has passed after four batches with late rows."""
    return drained(jobs.first_alerts(on_time(v), 2))


@query("SELECT event_id, pixel_id, ts FROM hotspots WHERE pixel_id NOT IN (SELECT pixel_id FROM fire)")
def r3_not_yet_burned(v) -> DataFrame:
    return drained(jobs.not_yet_burned(stream(v).select("event_id", "pixel_id", "ts"), v.fire))


@query("SELECT a.event_id, h.ts AS spot_ts FROM hotspots a JOIN hotspots h ON a.pixel_id = h.pixel_id AND a.ts >= h.ts AND a.ts <= h.ts + INTERVAL 2 DAY")
def r4_near_hotspots(v) -> DataFrame:
    seen = stream(v).select("event_id", "pixel_id", F.col("ts").alias("acq_ts"))
    return drained(jobs.near_hotspots(seen, stream(v).select("pixel_id", "ts"), 2).select("event_id", "spot_ts"))


@query("""SELECT pixel_id, min(ts) AS start, max(ts) + INTERVAL 1 DAY AS "end", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY pixel_id ORDER BY ts, event_id) AS episode FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY pixel_id ORDER BY ts, event_id) + INTERVAL 1 DAY THEN 0 ELSE 1 END AS new FROM hotspots)) GROUP BY pixel_id, episode""")
def r5_episodes(v) -> DataFrame:
    return drained(jobs.episodes(stream(v), "1 day"), "complete")


@query("SELECT DISTINCT pixel_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM hotspots")
def r6_upsert_months(v) -> DataFrame:
    """The events arrive in four files, one a batch, all of the same months; then once more, by another query, after the
    parts of the first have been folded."""
    path = new_path(v.spark)
    v.table("events").repartition(4, "event_id").write.parquet(f"{path}-arrived")
    for k in range(2):
        arriving = v.spark.readStream.schema(v.table("events").schema).option("maxFilesPerTrigger", 1).parquet(f"{path}-arrived").where("event_type = 'error'").selectExpr(*v._of(HOTSPOTS))
        jobs.upsert_months(arriving.select("pixel_id", F.year("ts").alias("year"), F.month("ts").alias("month")), path, f"{path}-checkpoint-{k}").awaitTermination()
        if not k:
            jobs.compacted(v.spark, path)
    return jobs.months(v.spark, path)
