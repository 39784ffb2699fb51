"""Session settings the library is tested with."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Results do not depend on these, apart from the time zone for sources with zoned timestamps. On a cluster,
# set `spark.sql.shuffle.partitions` to a small multiple of the cores: adaptive execution merges
# partitions that turn out small, but does not add any.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def spark_session(name: str = "aduana", master: str | None = None, **settings: str) -> SparkSession:
    """Session with `SETTINGS`; keyword arguments add settings with `__` for a dot."""
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, `spark.checkpoint.dir`. Where it is unset, a local session gets a
    folder of its own; a cluster does not, as each machine would write to its own disk."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = getattr(context, "_aduana_folder", None) or tempfile.mkdtemp(prefix="aduana-")
        context._aduana_folder = folder
    return folder.rstrip("/")
