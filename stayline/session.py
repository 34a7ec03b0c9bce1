"""Session helpers: a local session for tests and benches, and the checkpoint folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "stayline") -> SparkSession:
    """A session for one machine. On a cluster, use the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with the machine, so a missing setting is
    an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stayline-checkpoint-")
    context.setCheckpointDir(folder)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """A folder of its own, beside the session's, for the checkpoints of a job; it is deleted when the job ends.

    Tables that are read after that must have been written elsewhere.
    """
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    base = context.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    folder = f"{base}/job-{uuid.uuid4().hex}"
    context.setCheckpointDir(folder)
    try:
        yield folder
    finally:
        context.setCheckpointDir(base)
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def leaves_results_only(job: Callable) -> Callable:
    """Run a job, whose first argument is the session, with ``intermediates``."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with intermediates(spark):
            return job(spark, *args, **kwargs)

    return run
