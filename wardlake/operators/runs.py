"""Run history from an append-only ledger: one event opens a run, later ones close it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_states(events: DataFrame) -> DataFrame:
    """Current state per run. A closing event outranks the opening one; the latest wins.

    Events are small and combine before the shuffle, also for a run with very many of them.
    """
    closing = F.col("status") != "running"
    fields = ["status", "records_processed", "records_rejected", "images_processed", "error_message"]
    return (
        events.groupBy("run_id")
        .agg(
            F.max(F.struct(closing.alias("closing"), "event_at", *fields)).alias("_last"),
            F.min("event_at").alias("started_at"),
            F.max("trigger_type").alias("trigger_type"),
        )
        .select(
            "run_id",
            "trigger_type",
            "started_at",
            F.when(F.col("_last.closing"), F.col("_last.event_at")).alias("finished_at"),
            *[f"_last.{f}" for f in fields],
        )
    )
