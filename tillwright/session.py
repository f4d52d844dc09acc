"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; anything about cluster size is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # An unparseable timestamp is a null, not an error that stops the stream.
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small results that are persisted are merged into few partitions too.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # Exact distinct counts take some 20 bytes of memory for a byte of shuffle.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Shuffles start with so many partitions at least, which adaptive execution merges again up to its advisory
# size. So what one task sorts or aggregates does not grow with the input where the cluster's number is small.
FIRST_PARTITIONS = 1000
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session, in place. A larger number of partitions of the cluster is kept."""
    first = max(FIRST_PARTITIONS, *[int(spark.conf.get(name, None) or 0) for name in (_FIRST, "spark.sql.shuffle.partitions")])
    for name, value in {**SETTINGS, _FIRST: str(first)}.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


_own_folder: str | None = None


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Where that is unset, a
    local session uses a temporary folder of this machine; a cluster has none that all executors
    share, so there it is an error.
    """
    global _own_folder
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own_folder = _own_folder or tempfile.mkdtemp(prefix="tillwright-")
        shared = _own_folder
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
