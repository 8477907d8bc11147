"""Structured Streaming: record scoring, windowed monitoring, drift and the audit trail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import SERVING_CONTRACT, Contract
from riskframe.functions.bounded import join_lookup
from riskframe.operators.contract import with_violations
from riskframe.operators.quality import drift, moment_profile
from riskframe.operators.score import Scorecard, score


def as_instant(col: Column | str, dtype: T.DataType) -> Column:
    """A zone-less timestamp read as UTC, whatever the session time zone; watermarks need it."""
    col = F.col(col) if isinstance(col, str) else col
    if not isinstance(dtype, T.TimestampNTZType):
        return col
    since_epoch = col - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.expr("timestamp'1970-01-01 00:00:00Z'") + since_epoch


def utc_day(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / 86_400_000_000).cast("int"))


def read_stream(spark, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


SCORED, UNKNOWN = "scored", "unknown account"


def with_accounts(requests: DataFrame, accounts: DataFrame, key: str) -> DataFrame:
    """The account's columns and a ``status`` for each request of a batch; an unknown account leaves them null.

    The accounts are first reduced to the keys of the batch, so a batch never moves the whole account table when its own
    keys are few, and a small rest is broadcast, which leaves the requests of a busy account where they are.
    """
    keys = requests.select(key).where(F.col(key).isNotNull()).distinct()
    known = join_lookup(accounts, keys, key, "left_semi").withColumn("found", F.lit(True))
    joined = join_lookup(requests, known, key, "left")
    return joined.withColumn("status", F.when(F.col("found"), SCORED).otherwise(UNKNOWN)).drop("found")


def run_lookup(requests: DataFrame, accounts: DataFrame, key: str, out_path: str, checkpoint: str, trigger: dict | None = None):
    """Write every request with its account's columns; the monitor and the audit trail read this table as a stream.

    A batch replayed after a failure replaces its earlier folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # read for its keys and for the join
        try:
            with_accounts(kept, accounts, key).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    return (requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def checked_and_scored(records: DataFrame, card: Scorecard, contract: Contract = SERVING_CONTRACT) -> DataFrame:
    """Every record with its violations and scores; stateless, so any stream mode accepts it."""
    return score(with_violations(records, contract), card)


def run_scoring(records: DataFrame, card: Scorecard, scored_path: str, quarantine_path: str,
                checkpoint: str, contract: Contract = SERVING_CONTRACT, trigger: dict | None = None):
    """Stream records into a scored and a quarantine table.

    Each micro-batch goes to its own sub-folder that is overwritten, so a batch replayed
    after a failure replaces its earlier output instead of doubling it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        checked = checked_and_scored(batch, card, contract).persist()
        try:
            bad = F.size("violations") > 0
            (checked.where(~bad).drop("violations", "first_violation")
             .write.mode("overwrite").parquet(f"{scored_path}/batch_id={batch_id}"))
            (checked.where(bad).select(*records.columns, "violations", "first_violation")
             .write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}"))
        finally:
            checked.unpersist()

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def windowed_monitor(scored: DataFrame, time_col: str = "ts", every: str = "1 day",
                     lateness: str = "1 day") -> DataFrame:
    """Volume, score moments, band counts and requests without an account per time window; late rows past the watermark drop."""
    band = lambda label: F.expr(f"count_if(risk_category = '{label}')")
    watched = scored.withWatermark(time_col, lateness) if scored.isStreaming else scored
    return watched.groupBy(F.window(time_col, every).alias("window")).agg(
        F.count("*").alias("n"),
        F.avg("probability").alias("mean_probability"),
        F.expr("count_if(prediction = 1) AS default_predictions"),
        band("High Risk").alias("high_risk_count"),
        band("Medium Risk").alias("medium_risk_count"),
        band("Low Risk").alias("low_risk_count"),
        F.expr("count_if(probability IS NULL) AS unknown_accounts"),
    )


def run_monitor(scored: DataFrame, out_path: str, checkpoint: str, time_col: str = "ts", every: str = "1 day",
                lateness: str = "1 day", trigger: dict | None = None):
    """Keep the monitor up to date: each micro-batch writes the windows it changed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return (windowed_monitor(scored, time_col, every, lateness).writeStream.outputMode("update")
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def latest_windows(updates: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The newest version of each window, or of each window and the columns ``within`` it, out of the update batches."""
    groups = ["window", *within]
    values = [c for c in updates.columns if c not in (*groups, "batch_id")]
    newest = F.max_by(F.struct(*values), F.col("batch_id")).alias("v")
    return updates.groupBy(*groups).agg(newest).select(*groups, "v.*")


def window_drift(windows: DataFrame, baseline_mean: float, baseline_std: float,
                 threshold: float = 0.1) -> DataFrame:
    """Shift of each window's mean probability against the training baseline, in deviations."""
    shift = F.abs(F.col("mean_probability") - F.lit(baseline_mean))
    value = shift / F.lit(baseline_std) if baseline_std else F.when(shift == 0, 0.0).otherwise(float("inf"))
    return windows.withColumn("score", value).withColumn("drifted", F.col("score") > threshold)


def windowed_profile(records: DataFrame, columns: Sequence[str], time_col: str = "ts", every: str = "1 day",
                     lateness: str = "1 day") -> DataFrame:
    """Rows, mean, deviation and extremes of every column per time window: one aggregate, one state row for each window."""
    watched = records.withWatermark(time_col, lateness) if records.isStreaming else records
    return moment_profile(watched.withColumn("window", F.window(time_col, every)), columns, by="window")


def run_profile(records: DataFrame, columns: Sequence[str], out_path: str, checkpoint: str, time_col: str = "ts", every: str = "1 day",
                lateness: str = "1 day", trigger: dict | None = None):
    """Keep the profile of each window up to date: every micro-batch writes the windows it changed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return (windowed_profile(records, columns, time_col, every, lateness).writeStream.outputMode("update")
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def column_drift(profiles: DataFrame, baseline: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Shift of every column in every window against the stored profile of that column, in baseline deviations.

    ``profiles`` has one row for each window and column, ``baseline`` one for each column. A window without a present value of a
    column has a null score and no drift there.
    """
    return drift(baseline, profiles, threshold, keep=["window", "n"])


MARK = "mark_us bigint"


def noted_mark(spark, root: str, batch_id: int) -> int | None:
    """The watermark (microseconds) that held when a batch began: the furthest one noted before it, None at the begin."""
    try:
        noted = spark.read.schema(f"{MARK}, batch_id bigint").parquet(f"{root}/marks")
    except AnalysisException:
        return None
    return noted.where(F.col("batch_id") < batch_id).agg(F.max("mark_us")).first()[0]


def with_lateness(rows: DataFrame, mark_us: int | None, time_col: str, every: str) -> DataFrame:
    """Rows with ``late``: their window ends at or before the watermark, or they have no time and so no window."""
    if mark_us is None:
        return rows.withColumn("late", F.col(time_col).isNull())
    timed = rows.where(F.col(time_col).isNotNull()).withColumn("late", F.window(time_col, every))
    marked = timed.withColumn("late", F.unix_micros(F.col("late")["end"]) <= mark_us)
    return marked.unionByName(rows.where(F.col(time_col).isNull()).withColumn("late", F.lit(True)))


def run_late_split(requests: DataFrame, out_path: str, checkpoint: str, time_col: str = "ts", every: str = "1 day",
                   lateness: str = "1 day", trigger: dict | None = None):
    """Mark the requests that come when their window is closed and lose none: read = on time + late, in ``out_path/marked``.

    The watermark of a batch is the latest time of all batches before it less ``lateness``: an append aggregation over the rows
    on time closes its windows by the same watermark, so it drops no row that is not counted as late here. Marks are noted by
    batch; a batch replayed after a failure decides as before and replaces its folders. One row a batch reaches the driver.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = f"{out_path}/marked/batch_id={batch_id}"
        with_lateness(batch, noted_mark(spark, out_path, batch_id), time_col, every).write.mode("overwrite").parquet(marked)
        reached = F.unix_micros(F.max(time_col) - F.expr(f"INTERVAL {lateness}")).alias("mark_us")
        (spark.read.schema(batch.schema).parquet(marked).agg(reached).coalesce(1)
         .write.mode("overwrite").parquet(f"{out_path}/marks/batch_id={batch_id}"))

    return (requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_closed_windows(on_time: DataFrame, out_path: str, checkpoint: str, time_col: str = "ts", every: str = "1 day",
                       lateness: str = "1 day", trigger: dict | None = None):
    """Append each window of the monitor once, when the watermark has passed its end; the file sink makes it exactly-once."""
    return (windowed_monitor(on_time, time_col, every, lateness).writeStream.outputMode("append").format("parquet")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def baseline_of(scored: DataFrame) -> tuple[float, float]:
    row = scored.agg(F.avg("probability"), F.stddev_samp("probability")).first()
    return row[0], row[1]


def audit_records(scored: DataFrame, request_id: str, time_col: str, model_version: str,
                  lateness: str = "1 day") -> DataFrame:
    """Scored requests with model version and day, each request once within the watermark."""
    out = scored.withColumn("model_version", F.lit(model_version)).withColumn("day", utc_day(F.col(time_col)))
    if scored.isStreaming:
        return out.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark([request_id])
    return out.dropDuplicates([request_id])


def run_audit(scored: DataFrame, out_path: str, checkpoint: str, request_id: str, time_col: str,
              model_version: str, lateness: str = "1 day", trigger: dict | None = None):
    """Append-only audit trail partitioned by day; the file sink makes it exactly-once."""
    records = audit_records(scored, request_id, time_col, model_version, lateness)
    return (records.writeStream.outputMode("append").format("parquet").partitionBy("day")
            .option("path", out_path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def finish(query) -> None:
    """Wait for an ``availableNow`` query and surface its error."""
    query.awaitTermination()
