"""Session settings and the shared folder used for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The JVM never compiles methods above 8000 bytes; wide feature tables run much faster
#: as several smaller methods.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"
#: What Spark takes where nobody set it.
DEFAULT_BYTES = "65535"


def build_session(app: str = "claimflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster the master, memory and shuffle width come from spark-submit;
    ``conf`` only adds to them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        METHOD_LIMIT: COMPILED_BYTES,
        # the state of streams grows with the number of claims; keep it out of the heap
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_compiled(spark: SparkSession) -> None:
    """Have wide stages of a session built elsewhere compiled too; a limit of its own stays."""
    if spark.conf.get(METHOD_LIMIT, DEFAULT_BYTES) == DEFAULT_BYTES:
        spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A folder of this machine is used only where the cluster names none, as in
    tests; every executor must be able to reach the folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="claimflow-")
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip(os.sep)


def materialise(df: DataFrame) -> DataFrame:
    """Compute a table once and read it back from the shared folder.

    Used where a result is needed several times. The written table cuts the
    lineage, survives the loss of any executor, and is read column by column. It is
    deleted when the driver ends.
    """
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = df.sparkSession.sparkContext._jvm
    written = jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(written)
    return df.sparkSession.read.schema(df.schema).parquet(path)
