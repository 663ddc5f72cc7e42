"""Session settings the layers rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    # hour(), unix_timestamp() and window() all read the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split feeds one map-side aggregate; larger splits combine more rows
    # before anything is shuffled.
    "spark.sql.files.maxPartitionBytes": "256m",
    # A task holds few months: writing them side by side saves sorting its rows.
    # A task with more months than writers sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Window state outside the heap, saved as deltas rather than whole snapshots.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_CLUSTER_SETTINGS = {
    # Shuffles start this wide and are merged to their size at run time.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    # Also the size of the files a rebalanced write makes, before encoding.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

_DELTA_SETTINGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app_name: str = "tripflow",
    master: str | None = None,
    delta: bool = False,
    **settings: str,
) -> SparkSession:
    """A session with the settings above; ``settings`` (dots as ``__``) override them.

    ``delta=True`` needs the Delta package on the class path; every writer then
    takes ``fmt="delta"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = dict(_SETTINGS)
    if not (master or "").startswith("local"):
        chosen |= _CLUSTER_SETTINGS
    if delta:
        chosen |= _DELTA_SETTINGS
    chosen |= {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
