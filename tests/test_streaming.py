import math

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wattle.sources.standins import electricity_readings
from wattle.streaming.incremental import daily_resample_stream, read_readings_stream, start


def test_streaming_daily_resample_equals_batch(spark, tmp_path):
    readings = electricity_readings(spark, SF_SMALL)
    src = str(tmp_path / "in")
    # several files, as arriving batches
    readings.repartition(4).write.parquet(src)
    stream = daily_resample_stream(read_readings_stream(spark, src, max_files_per_trigger=1),
                                   ["price_exaa_raw", "price_mc_raw"])
    q = start(stream, str(tmp_path / "ckpt"), query_name="daily_stream", output_mode="complete")
    q.processAllAvailable()
    q.stop()
    got = {r.date: r for r in spark.table("daily_stream").collect()}
    batch = (readings.groupBy(F.to_date("timestamp").alias("d"))
             .agg(F.avg("price_exaa_raw").alias("m"), F.count("price_exaa_raw").alias("n")).collect())
    assert len(got) == len(batch)
    for r in batch:
        g = got[r.d]
        assert g.price_exaa_raw_count == r.n
        assert (g.price_exaa_raw_mean is None and r.m is None) or math.isclose(g.price_exaa_raw_mean, r.m, rel_tol=1e-12)


def test_append_mode_emits_only_closed_days(spark, tmp_path):
    readings = electricity_readings(spark, SF_SMALL)
    src = str(tmp_path / "in")
    readings.repartition(3).write.parquet(src)
    stream = daily_resample_stream(read_readings_stream(spark, src), ["price_exaa_raw", "price_mc_raw"],
                                   lateness="1 day")
    out = str(tmp_path / "out")
    q = start(stream, str(tmp_path / "ckpt"), sink_path=out, output_mode="append", trigger_once=True)
    q.awaitTermination(300)
    got = {r.date: r for r in spark.read.parquet(out).collect()}
    last = readings.agg(F.max("timestamp").alias("m")).first().m.date()
    batch = {r.d: r.n for r in readings.groupBy(F.to_date("timestamp").alias("d"))
             .agg(F.count("price_exaa_raw").alias("n")).collect()}
    # days closed by the watermark (max event time - 1 day) are final and complete
    assert got and max(got) < last
    for d, r in got.items():
        assert r.price_exaa_raw_count == batch[d]
