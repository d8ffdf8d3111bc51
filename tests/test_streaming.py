import datetime as dt

from mobility.operators import peak_demand, rideshare_groups_window
from mobility.streaming import read_trip_stream, stream_peak_demand, stream_rideshare_groups, write_stream
from tests.conftest import TRIP_SCHEMA, make_trips, trip


def _to_memory(df, name, checkpoint):
    """Test sink: rows of an append-mode stream in a session table."""
    return (
        df.writeStream.outputMode("append")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def _rows():
    # trips over ten hours; the last one moves the watermark past the others
    return [trip(s, pu=z) for s in range(0, 36000, 450) for z in (237, 161, 999)] + [trip(86400)]


def test_streaming_windows_match_batch(spark, zones, tmp_path):
    src = str(tmp_path / "in")
    batch = make_trips(spark, _rows())
    batch.write.parquet(src)
    stream = read_trip_stream(spark, src, TRIP_SCHEMA, max_files_per_trigger=1)

    ckpt = str(tmp_path / "ckpt")
    q = _to_memory(stream_peak_demand(stream, zones, "2 hours"), "peak_stream", ckpt + "/a")
    q.processAllAvailable()
    q.stop()
    got = {(r["peak-range-start"], r.PULocationID, r.total_trips) for r in spark.table("peak_stream").collect()}
    want = {
        (r["peak-range-start"], r.PULocationID, r.total_trips)
        for r in peak_demand(batch, zones, "2 hours").collect()
        if r["peak-range-start"] < dt.datetime(2018, 1, 26, 18, 0)
    }
    assert got == want and len(got) == 10

    q = _to_memory(stream_rideshare_groups(stream, zones), "groups_stream", ckpt + "/b")
    q.processAllAvailable()
    q.stop()
    got = {(r["window-start"], r.PULocationID, r.total_trips) for r in spark.table("groups_stream").collect()}
    want = {
        (r["window-start"], r.PULocationID, r.total_trips)
        for r in rideshare_groups_window(batch, zones).collect()
        if r["window-start"] < dt.datetime(2018, 1, 26, 18, 0)
    }
    assert got == want and len(got) == 160


def test_incremental_parquet_sink_resumes(spark, zones, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    day1 = [trip(s, pu=237) for s in range(0, 7200 * 3, 600)]
    make_trips(spark, day1).write.parquet(src)

    def run_once():
        stream = read_trip_stream(spark, src, TRIP_SCHEMA)
        q = write_stream(
            stream_peak_demand(stream, zones, "2 hours", watermark="0 seconds"),
            "peak_files",
            path=out,
            checkpoint_location=ckpt,
            trigger_available_now=True,
        )
        q.awaitTermination()

    run_once()
    first = spark.read.parquet(out).count()
    # new files arrive; a restart from the checkpoint reads only those
    make_trips(spark, [trip(86400 + s, pu=237) for s in range(0, 7200, 600)]).write.mode("append").parquet(src)
    run_once()
    rows = spark.read.parquet(out).collect()
    assert first == 2  # the last window of day 1 waits for the watermark
    assert len(rows) == 3
    assert sorted(r.total_trips for r in rows) == [12, 12, 12]
    assert len({r["peak-range-start"] for r in rows}) == 3


def test_streaming_nearest_groups_match_batch(spark, zones, tmp_path):
    from mobility.operators import rideshare_groups_nearest
    from mobility.streaming import stream_rideshare_groups_nearest

    src = str(tmp_path / "in")
    # times on, just before and just after half marks, plus a late closer
    rows = [trip(s + d, pu=z) for s in range(0, 3600, 300) for d in (0, 149, 150, 299) for z in (237, 999)]
    rows += [trip(86400)]
    batch = make_trips(spark, rows)
    batch.write.parquet(src)
    stream = read_trip_stream(spark, src, TRIP_SCHEMA)
    q = _to_memory(stream_rideshare_groups_nearest(stream, zones), "nearest_stream", str(tmp_path / "ckpt"))
    q.processAllAvailable()
    q.stop()
    got = {(r.approximate_datetime, r.PULocationID, r.total_trips) for r in spark.table("nearest_stream").collect()}
    want = {
        (r.approximate_datetime, r.PULocationID, r.total_trips)
        for r in rideshare_groups_nearest(batch, zones).collect()
        if r.approximate_datetime < "2018-01-26"
    }
    assert got == want and len(got) == 13
