"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Bounds the batches handed to a user's scorer, whatever the length of the texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "noticeworks", **settings: str) -> SparkSession:
    """A session with adaptive execution on; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a session on one machine (local mode) without that setting, as in tests, gets a local
    folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="noticeworks-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of written data; one that is not there is no error."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def newest_note(spark: SparkSession, folder: str) -> Row | None:
    """``v`` and ``body`` of the highest note in a folder of notes; None without one."""
    try:
        notes = spark.read.schema("body string, v long").json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return notes.orderBy(F.desc("v")).first()


def write_note(spark: SparkSession, folder: str, v: int, body: str) -> None:
    """Writes a text as note ``v``: one file, which is there whole or not at all."""
    note = spark.range(1, numPartitions=1).select(F.lit(body).alias("body"))
    note.write.mode("overwrite").json(f"{folder}/v={v}")
