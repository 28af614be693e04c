"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Above this size the JVM does not compile a generated method; Spark then does
# better with several smaller ones, which very wide masked tables can need.
COMPILED_METHOD_BYTES = "8000"

# Runtime settings every job relies on. Shuffle widths are left to adaptive
# execution, which also splits partitions that one hot key has blown up.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": COMPILED_METHOD_BYTES,
}

# Settings that count only when a session starts. The second spares a look at
# the Python stack for every expression of a wide projection.
START_CONF = {
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "veilmark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; `conf` overrides any of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, **START_CONF, **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """A session of its own with the runtime settings, beside the caller's.

    It has the caller's settings otherwise, and shares tables and executors with it.
    The caller's session, its temporary functions and variables stay as they are.
    """
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **RUNTIME_CONF}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; every executor can reach it.

    A temporary folder is used only where the setting is missing and the
    session is a local one, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="veilmark-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read back, so that lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
