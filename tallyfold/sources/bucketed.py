"""Target tables bucketed by their key, so that an upsert moves the staged rows only."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyfold.session import delete_folder, shared_work_dir
from tallyfold.sources.bookmarks import with_partitions


@dataclasses.dataclass(frozen=True)
class BucketedTable:
    """A Parquet table of the catalog, bucketed and sorted by ``keys``, its files below ``root``.

    ``partitions`` follow from the key (a day column): an upsert then reads and
    rewrites the staged partitions alone.
    """

    name: str
    keys: tuple[str, ...]
    buckets: int
    root: str
    partitions: tuple[str, ...] = ()

    def _write(self, df: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
        # One task per bucket, so a bucket is one file (of each partition) and stays sorted.
        rows = df.repartition(self.buckets, *self.keys)
        self._written(rows, mode, path).saveAsTable(name)

    def _written(self, df: DataFrame, mode: str, path: str):
        writer = df.write.mode(mode).format("parquet").option("path", path)
        writer = writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        return writer.partitionBy(*self.partitions) if self.partitions else writer

    def create(self, df: DataFrame) -> None:
        """Make the table anew from the rows of ``df``, which must not read it."""
        self._write(df, self.name, f"{self.root.rstrip('/')}/{self.name}-{uuid.uuid4().hex}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def missing(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the table lacks; only they are shuffled, to its buckets."""
        dealt = rows.repartition(self.buckets, *self.keys)
        return dealt.join(self.read(rows.sparkSession).select(*self.keys), list(self.keys), "left_anti").select(*rows.columns)

    def kept(self, stage: DataFrame) -> DataFrame:
        """Target rows whose key is not staged, of the staged partitions.

        The target comes from its files by bucket, without an exchange. As in
        ``upsert``, a null in the key matches nothing.
        """
        spark = stage.sparkSession
        target = self.read(spark)
        if self.partitions:
            # As many values as the stage has partitions.
            wanted = [row.asDict() for row in stage.select(*self.partitions).distinct().collect()]
            target = with_partitions(target, wanted)
        keys = stage.select(*self.keys).repartition(self.buckets, *self.keys).distinct()
        return target.join(keys, list(self.keys), "left_anti").select(*target.columns)

    def _replace_partitions(self, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` have. An insert into a table of the catalog
        takes no write options, so the session's mode is set for it and put back."""
        conf, mode = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            conf.set(mode, before)

    def upsert(self, stage: DataFrame) -> None:
        """Replace the staged keys. The stage is computed once, into the work folder.

        What stays and what is staged go to a bucketed table of their own first,
        because a table cannot be overwritten while it is read. The last step
        replaces partitions from it, bucket by bucket, and can be repeated.
        """
        spark = stage.sparkSession
        staged = shared_work_dir(spark, "upsert-stage")
        stage.write.parquet(staged)
        rows = spark.read.schema(stage.schema).parquet(staged)
        merged, folder = f"{self.name}_{uuid.uuid4().hex}", shared_work_dir(spark, "upsert")
        columns = self.read(spark).columns
        self._written(self.kept(rows), "overwrite", folder).saveAsTable(merged)
        self._write(rows.select(*columns), merged, folder, mode="append")
        if self.partitions:
            self._replace_partitions(spark.table(merged).select(*columns))
        else:
            self.create(spark.table(merged).select(*columns))
        spark.sql(f"DROP TABLE {merged}")
        for path in (staged, folder):
            delete_folder(spark, path)
