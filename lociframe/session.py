"""Spark session defaults and the shared checkpoint folder.

On a cluster the session comes from the caller (spark-submit, notebooks);
``get_spark`` only fills in settings that are still unset, so a cluster's
own configuration always wins.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the variant plans: AQE for runtime re-planning
# (coalescing tiny shuffles, splitting skewed join partitions, converting
# sort-merge joins whose measured side is small into broadcast joins).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tables bucketed by (contig, position) join and group on longer keys in place
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a lookup table is broadcast only when Spark's own size estimate (static
    # or measured by AQE) is under this bound; beyond it the join shuffles
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "lociframe") -> SparkSession:
    existing = SparkSession.getActiveSession()
    if existing is not None:
        # a session made by the caller / cluster keeps its own settings
        ensure_checkpoint_dir(existing)
        return existing
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets this to a shared file system path; we only invent a
    folder when it is unset *and* Spark runs in local mode (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lociframe-ckpt-")
        # this process made the folder for itself: it goes with the process
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


IN_PLACE = "spark.sql.requireAllClusterKeysForCoPartition"
_IN_PLACE: set[str] = set()


def join_in_place(spark: SparkSession) -> None:
    """Let rows dealt by some of a join's keys be joined where they are.  A
    cluster's own setting wins."""
    if spark.conf.get(IN_PLACE, None) is None:
        spark.conf.set(IN_PLACE, "false")
        _IN_PLACE.add(spark.sparkContext.applicationId)


def join_anew(spark: SparkSession) -> None:
    """End what ``join_in_place`` set."""
    if spark.sparkContext.applicationId in _IN_PLACE:
        _IN_PLACE.discard(spark.sparkContext.applicationId)
        spark.conf.unset(IN_PLACE)


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INPUT_BYTES = 8 << 20    # bytes of input files for each partition that a shuffle begins with
MAX_INITIAL = 20_000
_SPREAD: dict[tuple[str, str], int] = {}


def spread_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles begin with partitions in proportion to the input, so that what a
    task sorts or groups stays as large whatever the input's size and need not
    spill; AQE joins small ones.  A cluster's own number wins, and small inputs
    keep ``spark.sql.shuffle.partitions``."""
    own = _SPREAD.get((spark.sparkContext.applicationId, "n"))
    current = spark.conf.get(INITIAL, None)
    if current is not None and current != str(own):
        return
    n = min(MAX_INITIAL, -(-input_bytes // INPUT_BYTES))
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(n))
        _SPREAD[(spark.sparkContext.applicationId, "n")] = n
    elif current is not None:
        spark.conf.unset(INITIAL)
