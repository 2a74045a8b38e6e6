"""Helpers shared by the operators: stored intermediate tables and text columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session sets no ``spark.checkpoint.dir`` and Spark runs in one process.
LOCAL_FOLDER = "/tmp/checkpoints"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = LOCAL_FOLDER
    return base.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and read it back.

    What is read later is the same for every reader and every retry, and lost executors cost
    no recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes that go to a Python worker at once. Spark's own 64 MB stand several times in the JVM's
#: buffers and in the worker, for each task of an executor.
BATCH_BYTES = "4m"


def bounded_batches(df: DataFrame) -> None:
    """Have whole texts and packed arrays go to Python in small batches, unless the session
    has a limit of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) == "67108864b":  # the default
        conf.set(name, BATCH_BYTES)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words_in(text) -> F.Column:
    """Number of words: runs of anything but the six ASCII white-space characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def signed(unsigned: int) -> int:
    """A 64-bit value as the long that has the same bits."""
    return unsigned - (1 << 64) if unsigned >= 1 << 63 else unsigned
