"""The batch jobs: each builds one table and writes it.

Order of a run: dimensions, cost fact, data transfer; metric ingest
(``streaming.ingest``), tag bridge, usage facts; then the loads. Every job may
be repeated: it replaces the partitions or keys it produces.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tallyfold.functions.keys import PRODUCT_COLUMNS, tag_columns
from tallyfold.operators.cost_fact import cost_fact, fact_lines, product_lines
from tallyfold.operators.data_transfer import data_transfer_cost
from tallyfold.operators.dimensions import account_dim, date_dim, hashed_dim
from tallyfold.operators.latest import latest_tags
from tallyfold.operators.summary import summary
from tallyfold.operators.upsert import COMMITMENT_KEYS, COST_KEYS, TRANSFER_KEYS, USAGE_KEYS
from tallyfold.operators.usage import MetricSpec, daily_usage
from tallyfold.plans.star import PRODUCT_KEY, TAG_KEY, Source, source_fact_lines
from tallyfold.session import many_small_files
from tallyfold.sources.bookmarks import Bookmark, run_changed, with_partitions
from tallyfold.sources.readers import read_merged
from tallyfold.sources.writers import (
    day_partitions,
    load,
    overwrite_partitions,
    swap_table,
    upsert_partitions,
    upsert_table,
    write_if_any,
)

MONTHS = ("year", "month")
DAYS = ("year", "month", "day")


@dataclasses.dataclass(frozen=True)
class StoredSource:
    """One payer export, stored by billing year and month."""

    path: str
    has_reservations: bool = True


def _limited(sources: Sequence[Source], only: Sequence[dict[str, object]] | None) -> list[Source]:
    """The sources' lines of some billing months, or all."""
    if only is None:
        return list(sources)
    return [dataclasses.replace(s, lines=with_partitions(s.lines, only)) for s in sources]


def refresh_changed_months(
    spark: SparkSession, sources: Sequence[StoredSource], root: str, *, directories: Sequence[DataFrame] = ()
) -> list[dict[str, object]]:
    """Bring fact, summaries and dimensions below ``root`` up to date with the stored exports.

    Only months whose files changed since the last run are read: their fact and
    summary partitions are replaced, and the dimensions get the rows that are
    new in them. Returns the months done; without changes nothing is read.
    """
    bookmarks = [Bookmark(spark, s.path, f"{root}/bookmark-{i}") for i, s in enumerate(sources)]

    def redo(months: list[dict[str, object]]) -> None:
        opened = [Source(read_merged(spark, s.path), s.has_reservations) for s in sources]
        cost_fact_job(opened, f"{root}/fact", only=months, stored=True)
        for i, source in enumerate(_limited(opened, months)):
            rows = summary(source.lines, months=None, has_reservations=source.has_reservations, by_month=True)
            with many_small_files(spark):  # a month's part lies in one task, however many tasks there are
                overwrite_partitions(rows, f"{root}/summary-{i}", MONTHS, expected=months, dealt=True)
        known = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/tag/_SUCCESS")
        there = known.getFileSystem(spark._jsc.hadoopConfiguration()).exists(known)
        limited = opened if not there else _limited(opened, months)
        dimension_jobs(spark, limited, directories, root, mode="delta" if there else "full")

    return run_changed(bookmarks, redo)


def summary_job(source: Source, path: str, *, as_of, months: int | None = 7, open_month_rule: bool = False) -> None:
    """Store the summary of one source by month."""
    rows = summary(
        source.lines,
        as_of=as_of,
        months=months,
        has_reservations=source.has_reservations,
        open_month_rule=open_month_rule,
    )
    overwrite_partitions(rows, path, MONTHS)


def cost_fact_job(
    sources: Sequence[Source],
    path: str,
    *,
    as_of=None,
    months: int | None = None,
    period: tuple[int, int] | None = None,
    only: Sequence[dict[str, object]] | None = None,
    open_month_rule: bool = False,
    stored: bool = False,
) -> None:
    """Cost fact of all sources: one month, a look-back, the months of ``only``
    (those that come out empty lose their rows), or everything.

    ``stored`` says that the lines can be scanned twice, for one shuffle less."""
    tags = tag_columns(*[s.lines for s in sources])
    rows = source_fact_lines(_limited(sources, only), tags, as_of=as_of, months=months, open_month_rule=open_month_rule)
    fact = cost_fact(rows, tag_cols=tags, period=period, by_month=stored)
    spark = sources[0].lines.sparkSession
    with many_small_files(spark) if stored else contextlib.nullcontext():
        overwrite_partitions(fact, path, MONTHS, sort_by=("date_dim_id",), expected=only or (), dealt=stored)


def data_transfer_job(source: Source, path: str) -> None:
    rows = fact_lines(source.lines, has_reservations=source.has_reservations, resolve_names=False)
    overwrite_partitions(data_transfer_cost(rows), path, MONTHS)


def dimension_columns(lines: DataFrame) -> list[str]:
    """The columns of billing lines that ``dimension_jobs`` reads."""
    named = ["year", "month", "bill_payer_account_id", "line_item_usage_account_id", "line_item_usage_start_date"]
    naming = ["line_item_line_item_type", "bill_billing_entity", "product_product_name"]
    return [*named, *naming, *PRODUCT_COLUMNS, *tag_columns(lines)]


def dimension_jobs(
    spark: SparkSession,
    sources: Sequence[Source],
    directories: Sequence[DataFrame],
    root: str,
    *,
    mode: str = "full",
    period: tuple[int, int] | None = None,
    tag_table: str | None = None,
) -> None:
    """Account, tag and product dimensions in one mode; dates when ``full``.

    ``delta`` reads what is stored below ``root`` and adds what is new;
    ``month`` adds a month's rows, known or not. ``tag_table`` names a table
    of the catalog that a full load points at a new version of the tag
    dimension, whose columns may have changed.
    """
    frames = [s.lines for s in sources]
    tags = tag_columns(*frames)

    def stored(name: str) -> DataFrame | None:
        known = mode == "delta" and not (name == "tag" and tag_table is not None)
        return spark.read.parquet(f"{root}/{name}") if known else None

    def add(name: str, rows: DataFrame) -> None:
        load(rows, f"{root}/{name}", mode)

    resolved = [product_lines(s.lines) for s in sources]
    add("account", account_dim(frames, directories, mode=mode, existing=stored("account"), period=period))
    if tag_table is not None and mode == "full":
        swap_table(hashed_dim(frames, tags, TAG_KEY), tag_table, root)
    else:
        existing = spark.table(tag_table) if tag_table is not None and mode == "delta" else stored("tag")
        new_tags = hashed_dim(frames, tags, TAG_KEY, mode=mode, existing=existing, period=period)
        if tag_table is None:
            add("tag", new_tags)
        else:
            write_if_any(new_tags, lambda rows: rows.write.mode("append").insertInto(tag_table))
    add("product", hashed_dim(resolved, PRODUCT_COLUMNS, PRODUCT_KEY, mode=mode, existing=stored("product"), period=period))
    if mode == "full":
        starts = frames[0].select("line_item_usage_start_date")
        for other in frames[1:]:
            starts = starts.unionByName(other.select("line_item_usage_start_date"))
        add("date", date_dim(starts))


def tag_bridge_job(
    source: Source, path: str, *, tie_break: Sequence[Column], period: tuple[int, int] | None = None
) -> None:
    rows = latest_tags(source.lines, tag_columns(source.lines), tie_break=tie_break, period=period)
    overwrite_partitions(rows, path, DAYS)


def usage_job(
    metrics: DataFrame, spec: MetricSpec, tag_map: DataFrame, path: str, *, days: Iterable[dt.date] | None = None
) -> None:
    """One day, or a backfill over many: one plan, each day replaced."""
    days = None if days is None else list(days)
    usage = daily_usage(metrics, spec, tag_map, days=days)
    overwrite_partitions(usage, path, DAYS, expected=day_partitions(days or ()))


def load_usage(spark: SparkSession, stage: DataFrame, path: str) -> None:
    """Upsert staged usage rows into the loaded fact."""
    upsert_partitions(spark, path, stage, USAGE_KEYS, DAYS)


def load_data_transfer(spark: SparkSession, stage: DataFrame, path: str) -> None:
    upsert_partitions(spark, path, stage, TRANSFER_KEYS, MONTHS)


def load_cost_fact(spark: SparkSession, stage: DataFrame, path: str, *, dealt: bool = False) -> None:
    """Upsert staged cost rows; a stage holds whole billing months.

    ``dealt`` says that a month's staged rows lie in few tasks."""
    upsert_partitions(spark, path, stage, COST_KEYS, MONTHS, dealt=dealt)


def load_commitments(spark: SparkSession, stage: DataFrame, path: str) -> None:
    """Upsert days of one commitment series (utilization or coverage)."""
    upsert_table(spark, path, stage, COMMITMENT_KEYS)
