"""Unfinished uploads given up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.operators.locations import STORE, classify_locations
from partwise.operators.rejects import with_exit_code
from partwise.operators.uploads import check_cancel_targets, select_cancellable
from partwise.plans.store import CANCELLED, Store
from partwise.sources.scratch import materialise


def run_cancel(store: Store, targets: DataFrame, allow_prefix: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cancelled uploads, refused targets with error_class and exit_code).

    targets: dst_url. Where nothing is unfinished, nothing happens. The bytes stay on disk until
    Store.reclaim collects what no upload and no object names.
    """
    named = classify_locations(targets, "dst_url", STORE).select(
        "dst_url", F.col("authority").alias("bucket"), F.expr("substring(path, 2)").alias("key"),
        F.col("reject_reason").alias("_url_reject"),
    )
    checked = check_cancel_targets(named, allow_prefix).withColumn(
        "error_class", F.coalesce("_url_reject", "reject_reason")
    )
    good = checked.filter("error_class is null")
    cancelled = materialise(select_cancellable(store.pending(), good, allow_prefix), "cancelled")
    store.close(cancelled, CANCELLED)
    refused = with_exit_code(checked.filter("error_class is not null").select("dst_url", "error_class"))
    return cancelled, refused
