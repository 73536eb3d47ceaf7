"""Report sinks: the KPI sheet written as a table (parquet or CSV), or kept by versions.

Column names must be unique for a file format; the report functions already
prefix clashing participant-side names.  ``partition_by`` (for example
``year``) lets a later run overwrite one period without rewriting the rest
(dynamic partition overwrite), though a reader can then meet half a sheet.

``refresh_report`` keeps a sheet that is safe to read at any time.  Each period has a
fingerprint of its rows; a refresh writes the periods whose fingerprint changed into folders
of a new version, lists the folders of all periods in that version's manifest, and swaps the
pointer ``current.txt`` last, by one rename over it.  Readers follow the pointer once and hold files that
no refresh touches; a refresh that dies before the swap leaves the old version in place.
One writer at a time.  Old versions stay: whoever runs the refresh decides when no reader has them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    dupes = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if dupes:
        raise ValueError(f"duplicate output columns: {dupes}")
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


#: Rows without a period.
NO_PERIOD = "none"
_MANIFEST = "period string, rows long, fingerprint string, folder string"


def _files(spark: SparkSession, path: str):
    """Hadoop's Path class and the file system of ``path``."""
    cls = spark._jvm.org.apache.hadoop.fs.Path
    return cls, cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    cls, fs = _files(spark, path)
    if not fs.exists(cls(f"{path}/current.txt")):
        return None
    return spark.read.text(f"{path}/current.txt").first()[0]


def _manifest(spark: SparkSession, path: str, version: str | None) -> dict:
    if version is None:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/versions/{version}").collect()
    return {r.period: r for r in rows}


def fingerprints(df: DataFrame, period: str) -> DataFrame:
    """(period, rows, fingerprint): order-free sums of two row hashes, NULLs in their places."""
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return df.groupBy(F.coalesce(F.col(period).cast("string"), F.lit(NO_PERIOD)).alias("period")).agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws("/", *sums).alias("fingerprint"))


def refresh_report(df: DataFrame, path: str, period: str) -> list[str]:
    """Bring the sheet at ``path`` to the rows of ``df`` (a written table: it is read twice);
    returns the periods written.  The driver holds one row per period."""
    if len(set(df.columns)) < len(df.columns):
        raise ValueError("duplicate output columns")
    spark, version = df.sparkSession, uuid.uuid4().hex
    old = _manifest(spark, path, current_version(spark, path))
    new = {r.period: r for r in fingerprints(df, period).collect()}
    changed = sorted(p for p, r in new.items() if p not in old or (old[p].rows, old[p].fingerprint) != (r.rows, r.fingerprint))
    if not changed and set(old) == set(new) and old:
        return []
    numbers = {p: i for i, p in enumerate(changed)}      # folders are numbered: a period may hold any characters
    if changed:
        of = spark.createDataFrame(list(numbers.items()), "_period string, number int")
        rows = df.withColumn("_period", F.coalesce(F.col(period).cast("string"), F.lit(NO_PERIOD)))
        (rows.join(F.broadcast(of), "_period").drop("_period").withColumnRenamed("number", "_number")
         .write.partitionBy("_number").parquet(f"{path}/data/{version}"))
    listed = [(p, r.rows, r.fingerprint, f"data/{version}/_number={numbers[p]}" if p in numbers else old[p].folder) for p, r in new.items()]
    spark.createDataFrame(listed, _MANIFEST).coalesce(1).write.parquet(f"{path}/versions/{version}")
    if not old:      # the columns, for sheets without any rows
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/columns")
    _swap(spark, path, version)
    return changed


def _swap(spark: SparkSession, path: str, version: str) -> None:
    """Point ``current.txt`` at a version: written beside it, then renamed over it."""
    cls, fs = _files(spark, path)
    out = fs.create(cls(f"{path}/next-{version}.txt"))
    out.writeBytes(version)
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(cls(f"{path}/next-{version}.txt")), fs.makeQualified(cls(f"{path}/current.txt")), options)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The sheet as of now: the files that the current version lists."""
    folders = [f"{path}/{r.folder}" for r in _manifest(spark, path, current_version(spark, path)).values()]
    schema = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
