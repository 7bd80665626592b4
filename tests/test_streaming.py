"""Streams over several batches, with late rows; and tables with a log of commits."""

import random
from datetime import datetime, timedelta

import pytest

from pyrocell.sources import commits
from pyrocell.streaming import jobs
from pyrocell.streaming.exclusion import judged

HOTSPOT = "event_id long, pixel_id long, ts timestamp"
START = datetime(2024, 1, 1)


def hotspots(rnd, n, pixels, days):
    out = [(k, rnd.randrange(pixels), START + timedelta(seconds=rnd.randrange(days * 86400))) for k in range(n)]
    return out + [(n + k, 1, out[0][2]) for k in range(3)]  # ties, of one pixel


def brute_alerts(rows, days, until):
    last, out = {}, set()
    for event, pixel, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        if ts <= until and (pixel not in last or ts >= last[pixel] + timedelta(days=days)):
            last[pixel] = ts
            out.add((pixel, event, ts))
    return out


def run(stream, folder):
    """All rows that a stream gives, and its progress."""
    out = str(folder / "out")
    q = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", str(folder / "checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out).collect(), q.recentProgress


def files_of(spark, rows, parts, folder):
    """Rows in order of time, as so many files written one after another."""
    rows = sorted(rows, key=lambda r: r[2])
    size = -(-len(rows) // parts)
    for k in range(0, len(rows), size):
        spark.createDataFrame(rows[k : k + size], HOTSPOT).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(HOTSPOT).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_due_times():
    assert judged([5, 6, 14, 15, 15, 40], None, 10) == ([0, 3, 5], 50)
    assert judged([5, 6, 14], 14, 10) == ([2], 24)
    assert judged([], 3, 10) == ([], 3)


def test_pixels_of_a_bucket_share_its_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "BUCKETS", 3)
    rows = [(e, p if p else None, t) for e, p, t in hotspots(random.Random(5), 400, 60, 30)]
    got, _ = run(jobs.first_alerts(files_of(spark, rows, 4, tmp_path / "in"), 2, "1 day"), tmp_path)
    assert {(r["pixel_id"], r["event_id"], r["ts"]) for r in got} == brute_alerts(rows, 2, max(r[2] for r in rows) - timedelta(days=1))


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_alerts_do_not_depend_on_batches(spark, tmp_path, parts):
    rows = hotspots(random.Random(1), 400, 12, 30)
    top = max(r[2] for r in rows)
    got, progress = run(jobs.first_alerts(files_of(spark, rows, parts, tmp_path / "in"), 2, "1 day"), tmp_path)
    assert {(r["pixel_id"], r["event_id"], r["ts"]) for r in got} == brute_alerts(rows, 2, top - timedelta(days=1))
    assert len(got) > 100 and len(progress) >= parts


def test_late_rows_are_parted_and_windows_close_once(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(k, rnd.randrange(5), START + timedelta(hours=k)) for k in range(24 * 12)]
    late = [(1000 + k, 9, START + timedelta(hours=k)) for k in range(10)]
    batches = [rows[:96], rows[96:192] + late[:5], rows[192:] + late[5:] + [(2000, 9, START + timedelta(hours=24 * 7))]]
    for b in batches:
        spark.createDataFrame(b, HOTSPOT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    path = str(tmp_path / "split")
    for _ in range(2):  # the second time there is nothing to do
        jobs.split_late(spark.readStream.schema(HOTSPOT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), path, str(tmp_path / "c")).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{path}/late").collect()) == [*range(1000, 1010)]
    assert spark.read.parquet(f"{path}/on_time").count() == len(rows) + 1
    stream = spark.readStream.schema(f"{HOTSPOT}, batch int").option("maxFilesPerTrigger", 1).parquet(f"{path}/on_time").drop("batch")
    got, progress = run(jobs.windowed_counts(stream, ["pixel_id"], "1 day", late="1 day"), tmp_path)
    want = {}
    for e, p, ts in [*rows, (2000, 9, START + timedelta(hours=24 * 7))]:
        want[datetime(ts.year, ts.month, ts.day), p] = want.get((datetime(ts.year, ts.month, ts.day), p), 0) + 1
    closed = max(r[2] for r in rows) - timedelta(days=1)
    assert {(r["start"], r["pixel_id"]): r["n"] for r in got} == {k: n for k, n in want.items() if k[0] + timedelta(days=1) <= closed}
    kept = [p.stateOperators[0].numRowsTotal for p in progress if p.stateOperators]
    assert kept[-1] < max(kept) and sum(p.stateOperators[0].numRowsDroppedByWatermark for p in progress if p.stateOperators) == 0


def test_readers_keep_their_snapshot_while_parts_are_folded(spark, tmp_path):
    path, schema = str(tmp_path / "table"), jobs.MONTHS
    put = lambda rows, writer, n: commits.add(spark.createDataFrame(rows, schema), path, writer, n, ["year", "month"])
    read = lambda df: sorted(map(tuple, df.collect()))
    assert read(commits.snapshot(spark, path, schema)) == []
    put([(1, 2024, 1), (2, 2024, 1)], "a", 0)
    put([(3, 2024, 2)], "a", 1)
    put([(2, 2024, 1)], "b", 0)
    want = [(1, 2024, 1), (2, 2024, 1), (3, 2024, 2)]
    opened = commits.snapshot(spark, path, schema)
    jobs.compacted(spark, path)
    assert read(jobs.months(spark, path)) == want == read(opened.distinct())
    assert len(commits._counting(spark, path)) == 1
    put([(3, 2024, 2)], "a", 1)  # a replay, and one whose commit has gone
    assert commits.vacuum(spark, path) == 3
    put([(99, 2024, 2)], "a", 1)
    assert read(jobs.months(spark, path)) == want and len(commits._counting(spark, path)) == 1
    put([(4, 2024, 3)], "a", 2)
    jobs.compacted(spark, path)
    put([(99, 2024, 2)], "a", 0)
    put([(99, 2024, 2)], "b", 0)
    assert read(jobs.months(spark, path)) == [*want, (4, 2024, 3)]
    (tmp_path / "table" / "parts" / "c-0" / "year=2024" / "month=9").mkdir(parents=True)  # a part that was never committed
    spark.createDataFrame([(7,)], "pixel_id long").write.mode("overwrite").parquet(f"{path}/parts/c-0/year=2024/month=9")
    assert read(jobs.months(spark, path)) == [*want, (4, 2024, 3)]
