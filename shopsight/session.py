"""Session helpers: a tuned builder and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "shopsight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; cluster settings win over these defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; pick a temporary one only for a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shopsight-checkpoint-"))
    else:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise reliably, so that a lost executor does not replay a whole iteration."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for tables written to be read again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def together(spark: SparkSession, work: Callable, items: Iterable, threads: int = 4) -> list:
    """Independent fits or evaluations, submitted as concurrent jobs."""
    items = list(items)
    target = inheritable_thread_target(spark)(work)
    with ThreadPool(max(1, min(threads, len(items)))) as pool:
        return pool.map(target, items)


def drop_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
