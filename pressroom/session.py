"""Session helpers.

Library functions never create a session; they take the one they are given.
``local_session`` is for tests, the bench and the examples only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings of the local session (tests, bench). On a cluster they belong in
# the cluster profile; no library function sets them on a session it is given.
JOB_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole-text pandas UDFs (classifier, HTML rules, enrichment): keep an
    # Arrow batch to ~1000 rows so a batch of long documents stays small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Static setting: PySpark otherwise records a Python call-site context for
    # every Column operation (for error messages), which makes building the
    # plans of wide projections several times slower on the driver.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pressroom", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**JOB_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Scratch folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is; without
    it there is no folder that all executors see, so that is an error. Only a
    local master may do without: it gets a scratch folder, one per session.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(spark.sparkContext.applicationId)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="pressroom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        _LOCAL[spark.sparkContext.applicationId] = current
    return current
