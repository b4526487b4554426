"""Which files of a partitioned table a job has read."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import delete_folder, shared_work_dir
from tallyfold.sources.writers import replace_table

FILE = ("path", "modificationTime", "length")


class Bookmark:
    """The files of ``source`` that were there when a job last finished.

    ``changed`` lists the partitions with files that are new, rewritten or gone
    since then; ``commit`` makes that listing the remembered one. Commit after
    the work: a job that fails in between does the same partitions again, and
    files that arrive in between count as changed the next time.
    """

    def __init__(self, spark: SparkSession, source: str, path: str, partitions: Sequence[str] = ("year", "month")):
        self.spark, self.source, self.path, self.partitions = spark, source, path, list(partitions)
        self.listed: str | None = None

    def _remembered(self) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/_SUCCESS")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return self.spark.read.parquet(self.path)

    def changed(self) -> list[dict[str, object]]:
        """Partition values, as many as there are changed partitions. Files are listed, not opened."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.source)
        self.listed = shared_work_dir(self.spark, "files")
        files.select(*FILE, *self.partitions).write.parquet(self.listed)
        now, before = self.spark.read.parquet(self.listed), self._remembered()
        differing = now
        if before is not None:
            same = list(FILE)
            differing = now.join(before, same, "left_anti").unionByName(before.join(now, same, "left_anti"))
        rows = differing.select(*self.partitions).distinct().orderBy(*self.partitions).collect()
        return [row.asDict() for row in rows]

    def commit(self) -> None:
        if self.listed is None:
            raise RuntimeError("nothing was listed: call changed() first")
        replace_table(self.spark.read.parquet(self.listed), self.path)
        delete_folder(self.spark, self.listed)
        self.listed = None


def with_partitions(df: DataFrame, wanted: Sequence[dict[str, object]]) -> DataFrame:
    """Rows of the wanted partitions, by a predicate on partition columns that prunes the scan."""
    if not wanted:
        return df.limit(0)
    columns = list(wanted[0])
    if len(columns) == 1:
        return df.where(F.col(columns[0]).isin(*[w[columns[0]] for w in wanted]))
    pairs = [F.struct(*[F.lit(w[c]).alias(c) for c in columns]) for w in wanted]
    # The single columns prune folders; the pairs then decide.
    rough = reduce(and_, [F.col(c).isin(*sorted({w[c] for w in wanted})) for c in columns])
    return df.where(rough & F.struct(*columns).isin(*pairs))


def run_changed(
    bookmarks: Sequence[Bookmark], run: Callable[[list[dict[str, object]]], None]
) -> list[dict[str, object]]:
    """Run a job on the partitions that changed in any source, then commit; returns them.

    A partition that changed in one source is done for all, because the job's
    output partition holds rows of all.
    """
    found = {tuple(w.items()): w for bookmark in bookmarks for w in bookmark.changed()}
    wanted = [found[key] for key in sorted(found, key=str)]
    if wanted:
        run(wanted)
    for bookmark in bookmarks:
        bookmark.commit()
    return wanted
