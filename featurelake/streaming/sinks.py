"""Stream writers: files, console, memory, per-batch functions, validation, idempotent upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import as_list
from ..operators import quality
from ..session import checkpoint_dir


def stream_checkpoint(spark: SparkSession, query_name: str, root: str | None = None) -> str:
    """Checkpoint folder of a query, below the given or the cluster's shared folder."""
    return f"{(root or checkpoint_dir(spark)).rstrip('/')}/streams/{query_name}"


def start_stream(
    df: DataFrame,
    query_name: str,
    output_path: str | None = None,
    output_mode: str = "append",
    trigger_interval: str = "30 seconds",
    format_type: str = "parquet",
    partition_columns=None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    checkpoint_root: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query with its own checkpoint, so that a restart goes on where it stopped.

    ``available_now`` works off what is there and ends. Memory and console sinks only show data.
    """
    writer = df.writeStream.queryName(query_name).outputMode(output_mode)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    # A memory or console sink keeps nothing, so there is nothing to go on from in complete-less modes.
    if format_type not in ("memory", "console") or foreach_batch:
        writer = writer.option("checkpointLocation", stream_checkpoint(df.sparkSession, query_name, checkpoint_root))
    if foreach_batch is not None:
        return writer.foreachBatch(foreach_batch).start()
    if format_type in ("memory", "console"):
        return writer.format(format_type).start()
    if output_path is None:
        raise ValueError(f"format {format_type} needs output_path")
    if partition_columns:
        writer = writer.partitionBy(*as_list(partition_columns))
    return writer.format(format_type).start(output_path)


def validating_batch(
    constraints: dict, good_path: str, bad_path: str, rules=(), report_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Per-batch function: valid rows to one folder, the rest with reasons to another.

    Each batch writes below its own number and replaces it, so a repeated batch leaves no copies.
    Rules, if given, are reported per batch.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        marked = quality.with_reasons(batch, constraints).persist()
        try:
            marked.filter("size(reasons) = 0").drop("reasons").write.mode("overwrite").parquet(
                f"{good_path}/epoch={epoch_id}"
            )
            marked.filter("size(reasons) > 0").write.mode("overwrite").parquet(f"{bad_path}/epoch={epoch_id}")
            if rules and report_path:
                quality.report(marked.drop("reasons"), list(rules)).coalesce(1).write.mode("overwrite").parquet(
                    f"{report_path}/epoch={epoch_id}"
                )
        finally:
            marked.unpersist()

    return write


def upserting_batch(store, group: str, partition_columns=None, order_by=(), count: bool = False) -> Callable[[DataFrame, int], None]:
    """Per-batch function that upserts into a feature group; a batch seen before is skipped.

    Of rows of a batch that repeat a key the last in ``order_by`` order wins (an offset, a version). A batch writes its
    own rows only and does not look at the group's, so its cost does not grow with the group; ``count`` keeps the
    version's row count, which does.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        if not store.has_epoch(group, epoch_id):
            store.upsert(batch, group, partition_columns, epoch_id, order_by=list(as_list(order_by)), count=count)

    return write
