"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_test_scratch: str | None = None


def shuffle_partitions(input_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Shuffle partitions to begin with, so that one fits in memory; AQE merges small ones."""
    return max(200, input_bytes // target_bytes)


def build_session(
    app: str = "adlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with the engine's defaults; ``conf`` wins over them.

    State ``input_bytes`` (an upper bound of what one job shuffles) for large
    runs: the default number of shuffle partitions is far too small for them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_bytes:
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            shuffle_partitions(input_bytes)
        )
    for key, value in {**RUNTIME_DEFAULTS, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Set the runtime SQL defaults on a session somebody else created.

    ``input_bytes`` sizes its shuffles as in ``build_session``.
    """
    if input_bytes:
        number = str(shuffle_partitions(input_bytes))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", number)
    for key, value in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder is invisible to the other executors.
    """
    global _test_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if _test_scratch is None:
            _test_scratch = tempfile.mkdtemp(prefix="adlake-")
        base = _test_scratch
    return f"{base.rstrip('/')}/adlake/{label}-{uuid.uuid4().hex}"
