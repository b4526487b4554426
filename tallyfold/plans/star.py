"""The star schema from billing sources."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.keys import PRODUCT_COLUMNS, tag_columns
from tallyfold.operators.cost_fact import cost_fact, cost_fact_view, fact_lines, fact_of_base, star_base
from tallyfold.operators.dimensions import account_dim, date_dim, hashed_dim
from tallyfold.session import materialize
from tallyfold.sources.writers import overwrite_partitions, replace_table

TAG_KEY = "tag_dim_id"
PRODUCT_KEY = "aws_product_dim_id"


@dataclasses.dataclass(frozen=True)
class Source:
    """One payer export."""

    lines: DataFrame
    has_reservations: bool = True


@dataclasses.dataclass(frozen=True)
class Star:
    fact: DataFrame
    date: DataFrame
    account: DataFrame
    tag: DataFrame
    product: DataFrame

    def register(self, prefix: str = "") -> None:
        """Temp views, for reports written as SQL."""
        names = {
            "cost_insights_fact": self.fact,
            "date_dim": self.date,
            "account_dim": self.account,
            "tag_dim": self.tag,
            "resource_dim": self.product,
        }
        for name, df in names.items():
            df.createOrReplaceTempView(prefix + name)


def source_fact_lines(
    sources: Sequence[Source], tags: Sequence[str], *, as_of=None, months: int | None = None, open_month_rule: bool = False
) -> list[DataFrame]:
    return [
        fact_lines(
            s.lines,
            as_of=as_of,
            months=months,
            has_reservations=s.has_reservations,
            open_month_rule=open_month_rule,
            tag_cols=tags,
        )
        for s in sources
    ]


def build_star(
    sources: Sequence[Source],
    directories: Sequence[DataFrame],
    *,
    as_of=None,
    months: int | None = None,
    open_month_rule: bool = False,
    period: tuple[int, int] | None = None,
    rollup: bool = True,
) -> Star:
    """Fact and dimensions of the sources as lazy frames.

    The fact comes straight from the lines in one shuffle per source. For
    tables that are queried often, write each frame (``sources.writers``) and
    build a ``Star`` over the written tables. To report on lines that are not
    stored as a fact, ``rollup=False`` leaves adding up to the report.
    """
    frames = [s.lines for s in sources]
    tags = tag_columns(*frames)
    resolved = source_fact_lines(sources, tags, as_of=as_of, months=months, open_month_rule=open_month_rule)
    lines = frames[0].select("line_item_usage_start_date")
    for other in frames[1:]:
        lines = lines.unionByName(other.select("line_item_usage_start_date"))
    return Star(
        fact=(cost_fact if rollup else cost_fact_view)(resolved, tag_cols=tags, period=period),
        date=date_dim(lines),
        account=account_dim(frames, directories),
        tag=hashed_dim(frames, tags, TAG_KEY),
        product=hashed_dim(resolved, PRODUCT_COLUMNS, PRODUCT_KEY),
    )


DIMENSIONS = ("date", "account", "tag", "product")
FACT_PARTITIONS = ("year", "month")
USAGE_MONTH = "usage_month"


def store_star(star: Star, root: str, *, dealt: bool = False) -> Star:
    """Write fact and dimensions below ``root`` and return the stored star.

    The fact replaces the months it contains and is sorted by day within its
    files; dimensions are replaced whole. Bills of a month hold usage of others
    too, so the stored fact is also partitioned by the month of usage, which is
    what reports ask for. ``dealt`` says that the fact's rows already lie by month.
    """
    spark = star.fact.sparkSession
    fact = star.fact.withColumn(USAGE_MONTH, F.substring("date_dim_id", 1, 6).cast("int"))
    overwrite_partitions(fact, f"{root}/fact", (*FACT_PARTITIONS, USAGE_MONTH), sort_by=("date_dim_id",), dealt=dealt)
    for name in DIMENSIONS:
        replace_table(getattr(star, name), f"{root}/{name}")
    return Star(**{name: spark.read.parquet(f"{root}/{name}") for name in ("fact", *DIMENSIONS)})


def star_of_base(base: DataFrame, directories: Sequence[DataFrame], tag_cols: Sequence[str]) -> Star:
    """Fact and dimensions from one stored ``star_base``; each reads the columns it needs of it."""
    lines = base.select(
        F.col("payer_account_id").alias("bill_payer_account_id"),
        F.col("aws_account_dim_id").alias("line_item_usage_account_id"),
        F.col("usage_day").alias("line_item_usage_start_date"),
    )
    return Star(
        fact=fact_of_base(base, tag_cols),
        date=date_dim(lines),
        account=account_dim([lines], directories),
        tag=hashed_dim([base], tag_cols, TAG_KEY),
        product=hashed_dim([base], PRODUCT_COLUMNS, PRODUCT_KEY),
    )


def load_star(
    sources: Sequence[Source],
    directories: Sequence[DataFrame],
    root: str,
    *,
    as_of=None,
    months: int | None = None,
    open_month_rule: bool = False,
    period: tuple[int, int] | None = None,
) -> Star:
    """Build and store the star in one pass over each source.

    The lines are added up once, at the fact's grain and by payer, into the work
    folder. Fact and all dimensions are read from there, so a look-back or a
    period holds for all of them alike: a dimension has the keys that the fact has.
    """
    tags = tag_columns(*[s.lines for s in sources])
    lines = source_fact_lines(sources, tags, as_of=as_of, months=months, open_month_rule=open_month_rule)
    base = materialize(star_base(lines, tag_cols=tags, period=period), "star-base")
    return store_star(star_of_base(base, directories, tags), root, dealt=True)
