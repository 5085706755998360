"""Session builder and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN_FOLDERS: dict[str, str] = {}
_SCRATCH: list[str] = []

BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
BATCH_BYTES = 4 << 20


def build_session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI casts, adaptive execution, skew-join splitting and UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Batches between Spark and its workers by size of text, not by 10,000 rows however long; a setting of the caller stays."""
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below ``spark.checkpoint.dir``.

    The folder must be one that every executor sees, so only a local master may
    fall back to a temporary directory of the machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _RUN_FOLDERS:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            root = tempfile.mkdtemp(prefix="tessera-")
        _RUN_FOLDERS[app] = f"{root.rstrip('/')}/tessera-{app}-{uuid.uuid4().hex[:8]}"
    return _RUN_FOLDERS[app]


def clear_run_folder(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder; frames read from there end with it."""
    root = _RUN_FOLDERS.pop(spark.sparkContext.applicationId, None)
    drop_paths(spark, [root] if root else [])


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the run folder; nothing is created."""
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    _SCRATCH.append(path)
    return path


def scratch_since(mark: int) -> list[str]:
    """Scratch paths handed out after the first ``mark`` ones."""
    return _SCRATCH[mark:]


def scratch_mark() -> int:
    return len(_SCRATCH)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts lineage in a way that outlives a lost executor, evaluates the plan exactly
    once, and gives Spark the real size of the result: a settled table is broadcast
    only when its files are below ``spark.sql.autoBroadcastJoinThreshold``, and is
    shuffled otherwise. Runs one job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
