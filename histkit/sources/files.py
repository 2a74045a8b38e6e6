"""Reading and writing tables, hour-partitioned parquet, delimited text and snapshots."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.functions.times import as_datetime
from histkit.operators.events import union_all


#: Used only where the session sets no ``spark.checkpoint.dir`` and Spark runs in one process.
LOCAL_FOLDER = "/tmp/checkpoints"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system: a read that fails would reach every query listener of the session."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder of ``spark.checkpoint.dir``, which a cluster must set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = LOCAL_FOLDER
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the plan where a result feeds several later steps. The files are columnar, so each
    step reads only its columns, and they survive the loss of executors.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """Inside, tables are written with zstd, and the shuffle files of a write are removed when it ends, not when the
    driver happens to collect its garbage. For jobs of many steps, each of which is stored; tables stay readable."""
    lean = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {k: spark.conf.get(k, None) for k in lean}
    try:
        for k, v in lean.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def stored_for_now(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`materialize`, for a result that nothing reads after the block: its files are removed then."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet folder when the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_tables(
    spark: SparkSession, tables: Mapping[str, Sequence[str]] | Sequence[str], name: str | None = None, each=None
) -> DataFrame:
    """Read the tables listed under a logical name, transform each, and union them by name."""
    listed = tables[name] if isinstance(tables, Mapping) else tables
    frames = [read_table(spark, t) for t in listed]
    return union_all([each(df) if each else df for df in frames])


def hour_path(base: str, ts: datetime | str) -> str:
    """``<base>/YYYY-MM-DD/HH/`` of a run."""
    t = as_datetime(ts)
    return f"{base.rstrip('/')}/{t:%Y-%m-%d}/{t:%H}/"


def read_hour(spark: SparkSession, base: str, ts: datetime | str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(hour_path(base, ts))


def write_hour_partitions(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """Write events partitioned by date and zero-padded hour, the layout incremental reads prune on.

    Rows are brought together by hour to avoid one small file per task and hour; the
    rebalance hint lets Spark split an hour that is too big for one file.
    """
    rows = df.withColumns({"date": F.to_date(ts), "hour": F.date_format(ts, "HH")})
    rows.hint("rebalance", "date", "hour").write.mode(mode).partitionBy("date", "hour").parquet(path)


def read_hour_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Read that layout; the hour stays text."""
    df = spark.read.parquet(path)
    return df.withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = "|",
    header: bool = True,
    quote: str = '"',
    date_format: str = "dd-MM-yyyy",
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
) -> DataFrame:
    """Delimited text with a header to skip; empty fields are null. The schema is given, never inferred."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("quote", quote)
        .option("escape", quote)
        .option("nullValue", "")
        .option("dateFormat", date_format)
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "|",
    header: bool = True,
    single_file: bool = False,
    date_format: str = "dd-MM-yyyy",
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
) -> None:
    """Overwrite a folder of delimited text. Parallel by default; one file only on request."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("sep", sep)
        .option("header", header)
        .option("escape", '"')
        .option("dateFormat", date_format)
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )


def write_target(df: DataFrame, target: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Overwrite (truncate and load) or append, to a table or a parquet folder.

    Appending selects the existing columns by name. A folder must not be overwritten while
    the plan still reads it: use :func:`write_snapshot` for that.
    """
    spark = df.sparkSession
    if "/" in target:
        df.write.mode(mode).partitionBy(*partition_by).parquet(target)
    elif mode == "append" and spark.catalog.tableExists(target):
        df.select(*spark.table(target).columns).write.insertInto(target)
    else:
        writer = df.write.mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(target)


# A versioned table is a folder of parts and a folder of manifests. A version is committed by one
# small manifest file, written last; it names every part that is live. Parts are never changed.
# Inside a part, open and closed rows lie apart, and the rows of each hash bucket of the key too.
_MANIFEST = "version int, attempt int, schema string, buckets int, parts array<struct<name: string, closed: boolean>>"
_OPEN, _BUCKET = "_open", "_bucket"


def _manifest(spark: SparkSession, base: str, before: int | None = None):
    """The newest manifest (of a version below ``before``), or None."""
    path = f"{base.rstrip('/')}/manifest"
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(_MANIFEST).parquet(path)
    if before is not None:
        rows = rows.where(F.col("version") < before)
    return rows.orderBy(F.desc("version"), F.desc("attempt")).first()


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int") if keys else F.lit(0)


def _write_part(df: DataFrame, base: str, version: int, open_rows: Column | None, keys: Sequence[str] = (), buckets: int = 1) -> str:
    name = f"v{int(version)}-{uuid.uuid4().hex}"
    is_open = F.lit(True) if open_rows is None else F.coalesce(open_rows, F.lit(False))
    rows = df.withColumns({_OPEN: is_open, _BUCKET: _bucket_of(keys, buckets)})
    if keys:
        rows = rows.hint("rebalance", _OPEN, _BUCKET)  # not one file per task and bucket
    rows.write.partitionBy(_OPEN, _BUCKET).parquet(f"{base.rstrip('/')}/part={name}")
    return name


def _commit(spark: SparkSession, base: str, version: int, schema: T.StructType, parts: list[tuple[str, bool]], buckets: int = 1) -> None:
    """``parts``: name and whether only its closed rows are live. Concurrent readers see the manifest before or this one."""
    last = _manifest(spark, base, int(version) + 1)
    attempt = last.attempt + 1 if last is not None and last.version == int(version) else 1
    row = spark.createDataFrame([(int(version), attempt, schema.json(), buckets, parts)], _MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/manifest")


def _live(spark: SparkSession, base: str, manifest) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest.schema))
    base = base.rstrip("/")
    paths = [f"{base}/part={p.name}" for p in manifest.parts]
    own = [T.StructField("part", T.StringType()), T.StructField(_OPEN, T.BooleanType()), T.StructField(_BUCKET, T.IntegerType())]
    rows = spark.read.schema(T.StructType([*schema.fields, *own])).option("basePath", base).parquet(*paths)
    whole = [p.name for p in manifest.parts if not p.closed]
    return rows.where(~F.col(_OPEN) | F.col("part").isin(whole))


def write_snapshot(df: DataFrame, base: str, version: int) -> None:
    """Write a new version of a whole table next to the ones being read."""
    part = _write_part(df, base, version, None)
    _commit(df.sparkSession, base, version, df.schema, [(part, False)])


def write_history(df: DataFrame, base: str, version: int, is_open: Column, keys: Sequence[str] = (), buckets: int = 1) -> None:
    """Write the first version of a history, its open and closed rows apart, in buckets of the keys."""
    part = _write_part(df, base, version, is_open, keys, buckets)
    _commit(df.sparkSession, base, version, df.schema, [(part, False)], buckets)


def append_history(df: DataFrame, base: str, version: int, is_open: Column, keys: Sequence[str] = ()) -> None:
    """A version whose open rows and newly closed rows are ``df``; the rows closed before stay
    where they are. A repeated run builds on the version before it, as the first run did."""
    before = _manifest(df.sparkSession, base, version)
    part = _write_part(df, base, version, is_open, keys, before.buckets)
    _commit(df.sparkSession, base, version, df.schema, [*[(p.name, True) for p in before.parts], (part, False)], before.buckets)


def read_snapshot(spark: SparkSession, base: str, before: int | None = None) -> DataFrame:
    """The newest committed version (older than ``before``). Unfinished writes are invisible."""
    manifest = _manifest(spark, base, before)
    if manifest is None:
        raise LookupError(f"no committed version at {base}")
    return _live(spark, base, manifest).drop("part", _OPEN, _BUCKET)


def read_open(spark: SparkSession, base: str, before: int | None = None) -> DataFrame:
    """Only the open rows of that version: the folders of closed rows are not read."""
    return _live(spark, base, _manifest(spark, base, before)).where(F.col(_OPEN)).drop("part", _OPEN, _BUCKET)


def read_buckets_of(batch: DataFrame, base: str, keys: Sequence[str], before: int | None = None) -> DataFrame:
    """The rows of that version in the buckets that the batch's keys fall into; no other folder is
    read. The numbers of these buckets come to the driver, at most as many as the table has."""
    spark = batch.sparkSession
    manifest = _manifest(spark, base, before)
    if manifest is None:
        raise LookupError(f"no committed version at {base}")
    touched = batch.select(_bucket_of(keys, manifest.buckets).alias("b")).distinct().collect()
    return _live(spark, base, manifest).where(F.col(_BUCKET).isin([r.b for r in touched])).drop("part", _OPEN, _BUCKET)


def compact_history(spark: SparkSession, base: str, keys: Sequence[str], is_open: Column, most_parts: int = 50) -> bool:
    """Write the newest version's rows as one part once more than ``most_parts`` hold them.

    The version keeps its number and gets a new manifest, written last, so readers see the many parts or
    the one; a run that breaks off leaves the version as it was. Files are freed by :func:`remove_unused_parts`.
    """
    manifest = _manifest(spark, base)
    if manifest is None or len(manifest.parts) <= most_parts:
        return False
    rows = _live(spark, base, manifest).drop("part", _OPEN, _BUCKET)
    part = _write_part(rows, base, manifest.version, is_open, keys, manifest.buckets)
    _commit(spark, base, manifest.version, rows.schema, [(part, False)], manifest.buckets)
    return True


def remove_unused_parts(spark: SparkSession, base: str, keep_versions: int = 2) -> list[str]:
    """Delete part folders that none of the newest ``keep_versions`` versions names; returns their names.

    Run it when nobody reads older versions and no load is writing: a part is written before the manifest that
    names it.
    """
    if keep_versions < 1:
        raise ValueError("at least the newest version must stay")
    base = base.rstrip("/")
    manifests = spark.read.schema(_MANIFEST).parquet(f"{base}/manifest")
    newest = manifests.groupBy("version").agg(F.max_by("parts", "attempt").alias("parts")).orderBy(F.desc("version")).limit(keep_versions)
    named = {p.name for r in newest.collect() for p in r.parts}
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("part=") and name.removeprefix("part=") not in named:
            system.delete(status.getPath(), True)
            gone.append(name.removeprefix("part="))
    return sorted(gone)
