"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="flowtables-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new directory below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a temporary folder.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
