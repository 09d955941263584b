"""Session settings and the folder that every node can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Plans are left to adaptive execution: it sizes shuffles from measured output, splits
# skewed join partitions and switches to a broadcast when a side turns out small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# What a piece of a shuffle should hold at most, if all that is scanned were shuffled; and a limit to the
# pieces, as every map task keeps a size for each of them.
PIECE_BYTES = 128 * 1024 * 1024
MOST_PIECES = 200_000

_scratch: dict[str, str] = {}
# Per application: the width that this module set. Any other was fixed by the submitter.
_width: dict[str, str] = {}


def open_session(name: str = "ontime", settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's settings. Memory, cores and master stay with the submitter."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Shuffles start with several pieces per core; adaptive execution merges the small ones.
    if spark.conf.get(INITIAL_PARTITIONS, None) is None:
        _set_width(spark, shuffle_width(0, spark.sparkContext.defaultParallelism))
    return spark


def shuffle_width(scanned: int, cores: int, piece: int = PIECE_BYTES) -> int:
    """Pieces that a shuffle starts with: several per core, and as many as keep a piece small."""
    return max(4 * cores, min(MOST_PIECES, -(-scanned // piece)))


def scanned_bytes(*frames: DataFrame) -> int:
    """Bytes of all files and tables that the frames' plans read, as the sources report them. Runs no job."""
    total = 0
    for frame in frames:
        unknown = int(frame.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total += sum(size for size in sizes if size < unknown)
    return total


def _set_width(spark: SparkSession, width: int) -> None:
    spark.conf.set(INITIAL_PARTITIONS, str(width))
    _width[spark.sparkContext.applicationId] = str(width)


def plan_shuffles(spark: SparkSession, *frames: DataFrame) -> int:
    """Widen the session's shuffles to what the frames read, and return their width.

    A width that the submitter fixed stays, and so does a wider one. Adaptive execution merges what
    turns out small, so too wide costs little; too narrow would leave gigabytes to a piece.
    """
    fixed = spark.conf.get(INITIAL_PARTITIONS, None)
    now = int(fixed or spark.conf.get("spark.sql.shuffle.partitions"))
    if fixed is not None and fixed != _width.get(spark.sparkContext.applicationId):
        return now
    needed = -(-scanned_bytes(*frames) // PIECE_BYTES)
    if needed <= now:
        return now
    _set_width(spark, shuffle_width(needed * PIECE_BYTES, spark.sparkContext.defaultParallelism))
    return int(spark.conf.get(INITIAL_PARTITIONS))


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets a fresh temporary folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
            root = tempfile.mkdtemp(prefix="ontime-")
        _scratch[app] = f"{root.rstrip('/')}/ontime-{app}-{uuid.uuid4().hex[:8]}"
    return _scratch[app]


def forget_shared_folder(spark: SparkSession) -> str | None:
    """The application's folder, if it has one; the next call of :func:`shared_folder` makes another."""
    return _scratch.pop(spark.sparkContext.applicationId, None)


def enable_checkpoints(spark: SparkSession) -> None:
    """Give iterative training a reliable place to cut its lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
