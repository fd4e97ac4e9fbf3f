"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Run-time settings every job relies on; a value the cluster already set is kept.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key on the probe side of a left join is split even when the next
    # step groups by the same key: one more shuffle beats one endless task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Also set where wide rows are shuffled. What a task sorts is bounded by the size of a partition (spark.sql.adaptive.advisoryPartitionSizeInBytes)
# only where the data are dealt out finely enough; into few partitions it grows with the tables, until tasks spill.
# As many as a map task writes without sorting or holding its rows (spark.shuffle.sort.bypassMergeThreshold).
WIDE_ROWS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200"}

# And there, too: shuffle files go when the job that wrote them ends, not when the driver happens to collect its garbage. A run settles what it
# shares in one job after another, so it needs disk for the largest of their shuffles, not for the sum. A frame that is collected
# a second time makes its shuffles again.
SHORT_LIVED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# clusters set the same in spark.executor.extraJavaOptions
LONG_METHODS = "-XX:-DontCompileHugeMethods"


def tune(spark: SparkSession, wide_rows: bool = False) -> SparkSession:
    """Set the defaults above where the session has no explicit value of its own, set at launch or at run time."""
    held = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(spark.conf.getAll)
    for key, value in {**RUNTIME_DEFAULTS, **(WIDE_ROWS | SHORT_LIVED if wide_rows else {})}.items():
        if key not in held:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "returnsmith", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and benches. Clusters bring their own."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.driver.memory", memory)
             # wide rows through many joins make long generated methods; let the JVM compile them too
             .config("spark.driver.extraJavaOptions", LONG_METHODS)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="run-"))
             .getOrCreate())
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a temporary folder of its own; a
    cluster session is refused, since a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


# the folder of the run that is under way in this thread or task, which owns all scratch made meanwhile
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the run's folder, or below the shared folder outside of runs."""
    return f"{_RUN.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a shared intermediate once and read it back: lineage ends in a file
    that outlives any executor, and every consumer scans only its own columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_settled(df: DataFrame) -> None:
    """Drop the files of a settled frame that nothing reads any more, neither itself nor what was made of it without being written."""
    for place in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


# more than any frame has
MANY_PARTITIONS = 1 << 20


def in_two_methods(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions: asked for more partitions than there are, ``coalesce`` leaves them as they are, and Spark ends
    its generated method there and begins another. For long chains of row work, which in one method pass the 8000 bytes above
    which the JVM compiles none; nothing is shuffled."""
    return df.coalesce(MANY_PARTITIONS)


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A run that owns its scratch: whatever is settled before it ends, by whichever function, goes with it. Results must
    be written by then. Gives ``settle``; a run within a run has a folder of its own below the outer one."""
    root = scratch_path(spark, "run")
    outer = _RUN.set(root)
    try:
        yield settle
    finally:
        _RUN.reset(outer)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
