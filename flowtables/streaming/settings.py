"""Session settings the stateful operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Sessions of a busy key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> None:
    """Keep state on disk with RocksDB and merge sessions early, unless the session says otherwise."""
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) in (None, "false") or name.endswith("providerClass"):
            spark.conf.set(name, value)
