"""Sources: billing exports, metric records, landed responses, views."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators.latest import latest_per
from tallyfold.operators.reshape import fit_types
from tallyfold.schemas import METRIC_BATCH, METRIC_GENERATION, METRIC_PARTITIONS, METRIC_RECORD, METRIC_SCHEMA, as_text


def named_folders(spark: SparkSession, path: str, wanted: Sequence[dict[str, object]]) -> list[str]:
    """Partition folders below ``path`` that exist, each named by its values from the outermost level on."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folders = dict.fromkeys(
        "/".join([path.rstrip("/"), *[f"{name}={escape(str(value))}" for name, value in values.items()]]) for values in wanted
    )
    system = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(hadoop)
    return [folder for folder in folders if system.exists(jvm.org.apache.hadoop.fs.Path(folder))]


def read_folders(
    spark: SparkSession, path: str, wanted: Sequence[dict[str, object]], schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the named partition folders of a Parquet table, with all its partition columns.

    Only these folders are listed, however large the tree is. Folders that do not
    exist have no rows. Without ``schema``, and if none exists, the tree is listed
    once for the columns.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    found = named_folders(spark, path, wanted)
    if not found:
        return reader.parquet(path).limit(0)
    # Paths are globs to the reader.
    literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", folder) for folder in found]
    return reader.option("basePath", path).parquet(*literal)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None, **partition) -> DataFrame:
    """A Parquet table limited to the given partition values, outermost level first.

    The folder they name is read without listing the rest. Where there is no
    such folder (levels left out, or values written in another way) they become
    a predicate on partition columns, for which Spark lists the whole tree.
    """
    if partition and named_folders(spark, path, [partition]):
        return read_folders(spark, path, [partition], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    for name, value in partition.items():
        df = df.where(F.col(name) == value)
    return df


def read_billing_month(spark: SparkSession, path: str, year: int, month: int, schema: T.StructType | None = None) -> DataFrame:
    """One month of billing lines, with ``year`` and ``month`` columns."""
    return read_partitioned(spark, path, schema, year=int(year), month=int(month))


def one_generation(rows: DataFrame) -> DataFrame:
    """Each record of a metric table once, as its newest generation has it.

    A batch holds a record once, so only hours that several batches wrote are
    compared. Which hours those are is read from the folders' names; the others
    pass without a shuffle.
    """
    hours = list(METRIC_PARTITIONS)
    batches = rows.select(*hours, METRIC_BATCH).distinct()
    shared = batches.groupBy(*hours).agg(F.count("*").alias("_batches")).where("_batches > 1").select(*hours)
    compared = latest_per(
        rows.join(shared, hours, "left_semi"),
        [c for c in METRIC_RECORD if c in rows.columns],
        [F.col(METRIC_GENERATION).desc(), F.col(METRIC_BATCH).desc()],
    )
    alone = rows.join(shared, hours, "left_anti")
    return alone.unionByName(compared).drop(METRIC_BATCH, METRIC_GENERATION)


def read_metrics(spark: SparkSession, path: str, namespace: str, year: int, month: int, day: int) -> DataFrame:
    """One namespace and day of ingested metric records, each once."""
    return read_metric_days(spark, path, namespace, [dt.date(int(year), int(month), int(day))])


def read_metric_days(spark: SparkSession, path: str, namespace: str, days: Iterable[dt.date]) -> DataFrame:
    """One namespace's records of some days, each once; only their folders are listed."""
    wanted = [{"namespace": namespace, "year": d.year, "month": d.month, "day": d.day} for d in days]
    return one_generation(read_folders(spark, path, wanted))


def read_metric_table(spark: SparkSession, path: str) -> DataFrame:
    """All ingested metric records, each once, whichever batches brought it."""
    return one_generation(spark.read.parquet(path))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose files differ in columns; absent ones are null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_metric_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    exclude: Sequence[str] = (),
    schema: T.StructType = METRIC_SCHEMA,
    misfits: str | None = None,
) -> DataFrame:
    """Metric records below ``paths``, at any depth, compressed or not.

    Small files are packed into tasks by ``spark.sql.files.maxPartitionBytes``
    and ``openCostInBytes``. ``exclude`` holds path globs (``*`` within one
    level, ``**`` across levels). Naming the wanted day folders in ``paths``
    is cheaper: excluded files are still listed. Values are read as text and
    then typed, so a number written as text counts; ``misfits`` names a column
    for values that fit no other way.
    """
    df = spark.read.schema(as_text(schema)).option("recursiveFileLookup", True).json(paths if isinstance(paths, str) else list(paths))
    if exclude:
        pattern = "|".join(glob_pattern(g) for g in exclude)
        df = df.where(~F.col("_metadata.file_path").rlike(pattern))
    return fit_types(df, schema, misfits=misfits)


def glob_pattern(glob: str) -> str:
    """Regular expression matching paths that end in ``glob``."""
    parts = re.split(r"(\*\*|\*)", glob)
    text = "".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts)
    return f"(^|/){text}$"


def read_landed_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Landed API responses, one JSON document per line."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
