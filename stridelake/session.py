"""Session defaults and the shared scratch folder.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``.  Only when nothing is configured (local tests) do we
create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "stridelake",
    driver_memory: str = "8g",
) -> SparkSession:
    """A session with the settings the library is tuned for.

    AQE re-plans joins from runtime sizes and splits skewed shuffle partitions;
    ANSI mode stays on (the library never relies on silent cast failures).
    ``hugeMethodLimit`` 8000 keeps every generated method small enough for
    HotSpot's JIT (larger methods would run interpreted); see
    :data:`RECOMMENDED_CONF` for cluster settings.
    """
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


# Settings for a cluster deployment of the pipeline (passed with --conf).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Generated code stays JIT-compilable (HotSpot skips methods > 8000 bytes).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The cleaning step is CPU-bound (regex parsing): 128 MB splits keep
    # tasks in the minute range; lower it for more, shorter tasks.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # AQE coalesces shuffle partitions toward this size; set
    # spark.sql.shuffle.partitions for each job with shuffle_partitions().
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # A key holding a large share of a join side is split into several tasks.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
}  # spark.checkpoint.dir has no default: name the cluster's shared folder.


def shuffle_partitions(shuffle_bytes: int, cores: int, target: int = 256 * 1024 * 1024) -> int:
    """Partitions for a job that shuffles so many bytes: ~256 MB each, all cores busy,
    and no more than 20,000, since map tasks times partitions is what the driver tracks."""
    return max(cores, min(20_000, -(-shuffle_bytes // target)))


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Within the block, the session has these settings; the previous ones are restored."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def jit_sized_codegen(spark: SparkSession) -> Iterator[None]:
    """Within the block, generated methods stay below HotSpot's JIT limit.

    The cleaning step fuses many string expressions into one stage; above
    8000 bytecode bytes a generated method is never JIT-compiled and runs
    interpreted.  Performance only; the previous value is restored.
    """
    with settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"}):
        yield


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, stream checkpoints and landing files.

    It is the cluster's ``spark.checkpoint.dir``.  Where that is unset, a local
    master gets a temporary folder of its own; any other master is an error,
    since executors do not see each other's disks.
    """
    configured = _configured_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="stridelake-scratch-")
    return _LOCAL_SCRATCH[app]


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused sub-folder of the scratch root for one run."""
    return f"{scratch_root(spark)}/stridelake/{purpose}-{uuid.uuid4().hex[:12]}"
