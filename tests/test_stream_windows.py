"""Late rows, closed windows and drift by column in streams."""

from datetime import datetime

from pyspark.sql import functions as F

from riskframe.operators import quality
from riskframe.streaming import scoring as streams

SCHEMA = "request_id bigint, ts timestamp, probability double, prediction int, risk_category string"


def at(day, hour=12):
    return datetime(2024, 1, day, hour)


def rows_of(*times, start=0):
    return [(start + i, t, 0.25, 0, "Low Risk") for i, t in enumerate(times)]


def test_read_is_on_time_plus_late(spark, tmp_path):
    root = str(tmp_path)
    parts = [rows_of(at(1), at(5), at(9)), rows_of(at(1), at(2), at(8), None, at(9), start=10), rows_of(at(20), at(9), start=20), []]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(f"{root}/landing")
        arriving = streams.read_stream(spark, f"{root}/landing", spark.createDataFrame([], SCHEMA).schema)
        streams.finish(streams.run_late_split(arriving, root, f"{root}/checkpoint", every="24 hours", lateness="3 days"))
        marked = spark.createDataFrame([], SCHEMA + ", late boolean").schema
        on_time = streams.read_stream(spark, f"{root}/marked", marked).where("NOT late")
        streams.finish(streams.run_closed_windows(on_time, f"{root}/closed", f"{root}/checkpoint-closed", every="24 hours", lateness="3 days"))
    marked = spark.read.parquet(f"{root}/marked")
    # the watermark after the first part is the 6th: rows of the 1st and 2nd are late, so is the one without a time
    assert sorted(r.request_id for r in marked.where("late").collect()) == [10, 11, 13]
    assert marked.count() == sum(map(len, parts))
    closed = spark.read.parquet(f"{root}/closed")
    # the last watermark, the 17th, closes all windows but the last; each is written once
    assert closed.agg(F.sum("n")).first()[0] == 6 + 1 - 1
    assert closed.select("window").distinct().count() == closed.count()


def test_replayed_batch_decides_as_before(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(5_000_000, )], "mark_us bigint").write.parquet(f"{root}/marks/batch_id=0")
    spark.createDataFrame([(9_000_000, )], "mark_us bigint").write.parquet(f"{root}/marks/batch_id=1")
    assert streams.noted_mark(spark, root, 0) is None
    assert streams.noted_mark(spark, root, 1) == 5_000_000
    assert streams.noted_mark(spark, root, 2) == 9_000_000


def test_column_drift_of_windows(spark):
    baseline = quality.moment_profile(spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "a double, b double"), ["a", "b"])
    day = spark.createDataFrame([(at(1), 1.0, 1.0), (at(1), 1.0, 1.0), (at(2), 4.0, 2.0), (at(3), None, 1.0)], "ts timestamp, a double, b double")
    found = streams.column_drift(streams.windowed_profile(day, ["a", "b"], every="24 hours"), baseline)
    got = {(r["window"].start.day, r["column"]): (r["n"], r["score"], r["drifted"]) for r in found.collect()}
    days = sorted({d for d, _ in got})
    assert got[days[0], "a"] == (2, 0.0, False)
    assert got[days[1], "a"][2] and abs(got[days[1], "a"][1] - 3 / 2 ** 0.5) < 1e-12
    assert got[days[1], "b"] == (1, float("inf"), True) and got[days[2], "b"] == (1, 0.0, False)
    assert got[days[2], "a"] == (0, None, False)
