"""Scoring files as they arrive and watching the score distribution of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ebbtide.operators.monitoring import arrived_bins, prediction_windows
from ebbtide.plans.scoring import score
from ebbtide.sources.writers import flat

#: Names of what a scoring stream counts.
_READ, _SCORED = "rows_read", "rows_scored"


def arriving_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv",
                   files_per_trigger: int | None = None, name_filter: str | None = None) -> DataFrame:
    """Files of a folder as a stream; each is read once, also across restarts."""
    reader = spark.readStream.schema(schema).format(fmt).option("header", True)
    if fmt == "csv":
        reader = reader.option("enforceSchema", False)  # a file with another header is an error
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(folder)


def _drain(df: DataFrame, target: str, checkpoint: str, fmt: str, once: bool, interval: str) -> StreamingQuery:
    writer = (
        df.writeStream.format(fmt)
        .option("header", True)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def score_stream(source: DataFrame, model, target: str, checkpoint: str, keep=None, fmt: str = "parquet",
                 once: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Append scored rows to a file table, exactly once; ``once`` stops when all present files are done.

    Rows read, scored and taken for churn are counted as they pass; ``stream_totals`` has their sums.
    """
    n = F.count(F.lit(1)).alias("n")
    scored = score(source.observe(_READ, n), model, keep)
    scored = scored.observe(_SCORED, n, F.count_if(F.col("prediction") == 1).alias("churned"))
    return _drain(flat(scored, nested=fmt != "csv"), target, checkpoint, fmt, once, interval)


def stream_totals(query: StreamingQuery, poll: float = 1.0) -> dict[str, float | int | None]:
    """Waits for a stream's end and gives the totals of its batches, from their progress alone.

    ``batches``, ``input_rows`` and ``late_groups`` are of any stream; a scoring one has
    ``total_processed``, ``total_churn_predicted``, ``churn_rate`` and ``dropped_rows`` (skipped by the
    model for missing features) as well. ``late_groups`` are the rows a window's state refused because
    the watermark had passed them; Spark aggregates within a task first, so one of them stands for the
    late rows of a window in a task: 0 means no late row, more is a lower bound of them. A batch done
    again after a restart counts in the run that ended it. Progress is read every ``poll`` seconds;
    Spark keeps the last 100 batches (``spark.sql.streaming.numRecentProgressUpdates``), and a
    batch missed between two readings is an error.
    """
    seen: dict[int, tuple] = {}
    while True:
        over = query.awaitTermination(poll)
        for p in query.recentProgress:
            observed = p.observedMetrics
            read, scored = (observed[name].asDict() if name in observed else {} for name in (_READ, _SCORED))
            late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            seen[p.batchId] = (p.numInputRows, late, read.get("n", 0), scored.get("n", 0), scored.get("churned", 0), bool(scored))
        if over:
            break
    if seen and len(seen) <= max(seen) - min(seen):
        raise RuntimeError(f"progress of {max(seen) - min(seen) + 1 - len(seen)} batches is lost, read it more often")
    rows, late, read, scored, churned = (sum(b[i] for b in seen.values()) for i in range(5))
    totals = {"batches": len(seen), "input_rows": rows, "late_groups": late}
    if any(b[5] for b in seen.values()):
        rate = churned / scored if scored else None
        totals |= {"total_processed": read, "total_churn_predicted": churned, "churn_rate": rate, "dropped_rows": read - scored}
    return totals


def monitor_stream(scored: DataFrame, ts: str, target: str, checkpoint: str, width: str = "1 day",
                   delay: str = "1 hour", once: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Append each window's figures once the watermark has passed its end; later rows are left out."""
    return _drain(prediction_windows(scored, ts, width, delay), target, checkpoint, "parquet", once, interval)


def drift_stream(source: DataFrame, stored: DataFrame, target: str, checkpoint: str, once: bool = True,
                 interval: str = "1 minute") -> StreamingQuery:
    """Count arriving rows by the bins of a stored reference (``monitoring.reference_bins``).

    Each batch writes its few counts under its own number, so that a batch done twice counts once.
    ``monitoring.stability_of_arrived`` reads the index off the counts at any time.
    """

    def count(batch: DataFrame, number: int) -> None:
        arrived_bins(batch, stored).write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = source.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
