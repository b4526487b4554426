"""Registered queries by name: ``(spark, sf_dir) -> DataFrame``.

Money is rounded to 4 decimals and measures to 8, because engines add doubles
in different orders. All inputs have 2 decimals and factors at most 2 more, so
4 decimals lose nothing.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import inputs as I
from tallyfold.functions import cost_rules as R
from tallyfold.functions.calendar import business_date, date_dim_id, reporting_period
from tallyfold.functions.keys import PRODUCT_COLUMNS, containing_columns, tag_columns
from tallyfold.operators import commitments as C
from tallyfold.operators.cost_fact import FACT_MEASURES, cost_fact, fact_lines
from tallyfold.operators.data_transfer import data_transfer_cost
from tallyfold.operators.dimensions import account_dim, date_dim, date_dim_add, hashed_dim
from tallyfold.operators.latest import RESOURCE, current_tag_map
from tallyfold.operators.masking import MASKED_COLUMNS, mask_costs
from tallyfold.operators.percentiles import exact_percentiles
from tallyfold.operators.reshape import apply_mapping, choice_struct, drop_null_columns, flatten
from tallyfold.operators.service_names import resolve_service_name
from tallyfold.operators.summary import MEASURES, SKETCH_RSD, resource_counts, summary
from tallyfold.operators.upsert import COMMITMENT_KEYS, COST_KEYS, TRANSFER_KEYS, USAGE_KEYS, upsert
from tallyfold.operators import usage as U
from tallyfold.plans import jobs
from tallyfold.plans import line_reports as L
from tallyfold.plans import reports as P
from tallyfold.plans.checksums import day_checksums, differing_days, reconcile_days
from tallyfold.plans.star import FACT_PARTITIONS, PRODUCT_KEY, TAG_KEY, USAGE_MONTH, Star, build_star, load_star, source_fact_lines
from tallyfold.schemas import METRIC_ID, billing_schema
from tallyfold.session import materialize, shared_work_dir
from tallyfold.sources import readers, writers
from tallyfold.sources.bucketed import BucketedTable
from tallyfold.streaming import ingest
from tallyfold.streaming.late_records import changes_path, refresh_by_changes, write_with_changes
from tallyfold.streaming.bridge import read_bridge, refresh_bridge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, columns: Iterable[str] = (P.COST,), digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def as_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_date(c) for c in columns})


# --- cost rules -----------------------------------------------------------


@query
def charge_classification(spark, sf):
    lines = I.billing_lines(spark, sf)
    return lines.groupBy(
        F.col(R.CHARGE).alias("charge_type"),
        R.charge_category().alias("charge_category"),
        R.purchase_option().alias("purchase_option"),
        R.purchase_option(False).alias("purchase_option_second"),
        R.commitment_arn().alias("ri_sp_arn"),
        R.service().alias("service"),
    ).agg(F.count("*").alias("lines"))


@query
def amortized_cost_by_type(spark, sf):
    lines = I.billing_lines(spark, sf)
    by_type = lines.groupBy(F.col(R.CHARGE).alias("charge_type")).agg(
        F.sum(R.amortized_cost()).alias("amortized_cost"),
        F.sum(R.amortized_cost(False)).alias("amortized_cost_second"),
    )
    return rounded(by_type, ["amortized_cost", "amortized_cost_second"])


@query
def amortized_cost_open_month(spark, sf):
    lines = I.billing_lines(spark, sf)
    by_month = lines.groupBy("year", "month", F.col(R.CHARGE).alias("charge_type")).agg(
        F.sum(R.amortized_cost(open_month=I.AS_OF)).alias("amortized_cost"),
        F.sum(R.amortized_cost(False, open_month=I.AS_OF)).alias("amortized_cost_second"),
    )
    return rounded(by_month, ["amortized_cost", "amortized_cost_second"])


@query
def cost_measures(spark, sf):
    lines = I.billing_lines(spark, sf)
    names = ["usage_quantity", "unblended_cost", "ri_sp_trueup", "ri_sp_upfront_fees", "public_cost"]
    measures = R.line_measures()
    second = R.commitment_upfront_fees(False)
    by_type = lines.groupBy(F.col(R.CHARGE).alias("charge_type")).agg(
        *[F.sum(measures[n]).alias(n) for n in names], F.sum(second).alias("ri_sp_upfront_fees_second")
    )
    return rounded(by_type, [*names, "ri_sp_upfront_fees_second"])


@query
def service_name_resolution(spark, sf):
    resolved = resolve_service_name(I.billing_lines(spark, sf), "resolved_servicename")
    return resolved.groupBy(
        "product_servicename", "line_item_product_code", "bill_billing_entity", "resolved_servicename"
    ).agg(F.count("*").alias("lines"))


@query
def spot_detail(spark, sf):
    details = R.spot_detail()
    return I.billing_lines(spark, sf).groupBy(
        "line_item_product_code", *[c.alias(n) for n, c in details.items()]
    ).agg(F.count("*").alias("lines"))


@query
def mask_sensitive_costs(spark, sf):
    masked = mask_costs(I.billing_lines(spark, sf)).select(
        *I.TIE_BREAK, "line_item_line_item_type", "line_item_usage_type", *MASKED_COLUMNS
    )
    return rounded(masked, ["line_item_unblended_cost", "line_item_blended_cost"])


# --- summary and fact -----------------------------------------------------


def _summary_rows(df: DataFrame) -> DataFrame:
    return as_dates(rounded(df, MEASURES), "billing_period", "usage_date")


@query
def cost_summary(spark, sf):
    return _summary_rows(summary(I.billing_lines(spark, sf, I.GRAIN), months=None, resource_count="exact"))


@query
def cost_summary_coarse(spark, sf):
    """Many lines per group, at any hour, with the default estimate left out."""
    return _summary_rows(summary(I.coarse_lines(spark, sf), months=None, resource_count="exact"))


@query
def cost_fact_coarse(spark, sf):
    return rounded(cost_fact([fact_lines(I.coarse_lines(spark, sf))], tag_cols=I.TAGS_ONE), FACT_MEASURES)


@query
def cost_summary_lookback(spark, sf):
    return _summary_rows(summary(I.billing_lines(spark, sf, I.GRAIN), as_of=I.AS_OF, open_month_rule=True, resource_count="exact"))


@query
def cost_summary_source2(spark, sf):
    lines = I.as_source_two(I.billing_lines(spark, sf, I.GRAIN))
    return _summary_rows(summary(lines, months=None, has_reservations=False, resource_count="exact"))


@query
def exact_resource_count(spark, sf):
    lines = I.billing_lines(spark, sf)
    return lines.groupBy("line_item_usage_account_id", "line_item_product_code").agg(
        F.count_distinct("line_item_resource_id").alias("resource_id_count")
    )


@query
def approx_resource_count(spark, sf):
    """The exact count, and whether the estimate is within five of its errors."""
    lines = I.billing_lines(spark, sf)
    counted = lines.groupBy("line_item_usage_account_id", "line_item_product_code").agg(
        F.count_distinct("line_item_resource_id").alias("resource_id_count"),
        F.approx_count_distinct("line_item_resource_id", 0.023).alias("estimate"),
    )
    near = F.abs(F.col("estimate") - F.col("resource_id_count")) <= 1 + 5 * 0.023 * F.col("resource_id_count")
    return counted.withColumn("within", near).drop("estimate")


@query
def resource_count_by_month(spark, sf):
    """Resources by month from sketches stored by day and source, beside the exact count of the lines."""
    root, sources = shared_work_dir(spark, "summaries"), I.two_sources(spark, sf)
    for i, source in enumerate(I.two_sources(spark, sf, I.MONTH_GRAIN)):
        rows = summary(source.lines, months=None, has_reservations=source.has_reservations, resource_count="sketch")
        writers.overwrite_partitions(rows, f"{root}/{i}", ["year", "month"], dealt=True)
    keys = ["year", "month", "linked_account_id"]
    stored = [spark.read.parquet(f"{root}/{i}") for i in range(len(sources))]
    estimated = resource_counts(stored, keys)
    lines = [s.lines.withColumnRenamed("line_item_usage_account_id", "linked_account_id") for s in sources]
    columns = [*keys, "line_item_resource_id"]
    lines = lines[0].select(*columns).unionByName(lines[1].select(*columns))
    exact = lines.groupBy(*keys).agg(F.count_distinct("line_item_resource_id").alias("resource_id_count"))
    near = F.abs(F.col("estimate") - F.col("resource_id_count")) <= 1 + 5 * SKETCH_RSD * F.col("resource_id_count")
    found = exact.join(estimated.withColumnRenamed("resource_id_count", "estimate"), keys)
    return found.withColumn("within", near).drop("estimate")


@query
def cost_fact_one_source(spark, sf):
    lines = I.billing_lines(spark, sf, I.GRAIN)
    return rounded(cost_fact([fact_lines(lines)], tag_cols=I.TAGS_ONE), FACT_MEASURES)


@query
def cost_fact_from_summary(spark, sf):
    rows = summary(I.billing_lines(spark, sf, I.GRAIN), months=None, resource_count=None)
    return rounded(cost_fact([rows], tag_cols=I.TAGS_ONE), FACT_MEASURES)


@query
def cost_fact_two_sources(spark, sf):
    sources = I.two_sources(spark, sf, I.GRAIN)
    tags = tag_columns(*[s.lines for s in sources])
    return rounded(cost_fact(source_fact_lines(sources, tags), tag_cols=tags), FACT_MEASURES)


@query
def cost_fact_month(spark, sf):
    sources = I.two_sources(spark, sf, I.GRAIN)
    tags = tag_columns(*[s.lines for s in sources])
    return rounded(cost_fact(source_fact_lines(sources, tags), tag_cols=tags, period=(1998, 4)), FACT_MEASURES)


def _transfer(spark, sf):
    return data_transfer_cost(fact_lines(I.billing_lines(spark, sf), resolve_names=False))


@query
def data_transfer(spark, sf):
    return rounded(_transfer(spark, sf), ["DT_cost"])


# --- dimensions -----------------------------------------------------------


def _known(lines: DataFrame, before: str) -> DataFrame:
    return lines.where(F.col("line_item_usage_start_date") < F.lit(before).cast("timestamp"))


def _both(spark, sf) -> list[DataFrame]:
    return [s.lines for s in I.two_sources(spark, sf)]


@query
def tag_dim(spark, sf):
    return hashed_dim([I.billing_lines(spark, sf)], I.TAGS_ONE, TAG_KEY)


@query
def tag_dim_two_sources(spark, sf):
    frames = _both(spark, sf)
    return hashed_dim(frames, tag_columns(*frames), TAG_KEY)


@query
def tag_dim_month(spark, sf):
    return hashed_dim([I.billing_lines(spark, sf)], I.TAGS_ONE, TAG_KEY, mode="month", period=(1998, 4))


@query
def tag_dim_delta(spark, sf):
    lines = I.billing_lines(spark, sf)
    known = hashed_dim([_known(lines, "1995-01-08")], I.TAGS_ONE, TAG_KEY)
    return hashed_dim([lines], I.TAGS_ONE, TAG_KEY, mode="delta", existing=known)


@query
def product_dim(spark, sf):
    sources = I.two_sources(spark, sf)
    return hashed_dim(source_fact_lines(sources, []), PRODUCT_COLUMNS, PRODUCT_KEY)


@query
def product_dim_delta(spark, sf):
    lines = I.billing_lines(spark, sf)
    known = hashed_dim([fact_lines(_known(lines, "2001-01-01"))], PRODUCT_COLUMNS, PRODUCT_KEY)
    return hashed_dim([fact_lines(lines)], PRODUCT_COLUMNS, PRODUCT_KEY, mode="delta", existing=known)


@query
def product_dim_month(spark, sf):
    rows = [fact_lines(I.billing_lines(spark, sf))]
    return hashed_dim(rows, PRODUCT_COLUMNS, PRODUCT_KEY, mode="month", period=(1998, 4))


@query
def account_dimension(spark, sf):
    return account_dim(_both(spark, sf), I.account_directories(spark, sf))


@query
def account_dim_month(spark, sf):
    return account_dim(_both(spark, sf), I.account_directories(spark, sf), mode="month", period=(1998, 4))


@query
def account_dim_delta(spark, sf):
    frames, names = _both(spark, sf), I.account_directories(spark, sf)
    known = account_dim([_known(f, "1995-01-03") for f in frames], names)
    return account_dim(frames, names, mode="delta", existing=known)


@query
def date_dimension(spark, sf):
    return date_dim(I.billing_lines(spark, sf))


@query
def date_dim_daily(spark, sf):
    dim = date_dim(I.billing_lines(spark, sf))
    with_new = dim.unionByName(date_dim_add(dim, F.lit("2002-02-03")))
    return with_new.unionByName(date_dim_add(dim, F.lit("1998-04-05")))


@query
def date_dim_today(spark, sf):
    """The dimension with the business date, which is added once."""
    dim = date_dim(I.billing_lines(spark, sf))
    for _ in range(2):
        dim = dim.unionByName(date_dim_add(dim, business_date()))
    today = F.max(F.col("date_dim_id") == date_dim_id(business_date()))
    return dim.agg(F.count("*").alias("days"), today.alias("has_today"))


@query
def tag_dim_by_part_of_name(spark, sf):
    lines = I.billing_lines(spark, sf)
    return hashed_dim([lines], containing_columns(lines, "_user_"), TAG_KEY)


# --- latest rows ----------------------------------------------------------


@query
def latest_tags_per_resource(spark, sf):
    return as_dates(I.tag_bridge(spark, sf), "line_item_usage_start_date")


@query
def latest_tags_in_month(spark, sf):
    return as_dates(I.tag_bridge(spark, sf, period=(2001, 10)), "line_item_usage_start_date")


@query
def current_tags(spark, sf):
    return current_tag_map(I.tag_bridge(spark, sf))


@query
def tag_bridge_incremental(spark, sf):
    """The bridge by three batches of lines, not in order of time and with lines sent twice."""
    lines, landed = I.billing_lines(spark, sf), shared_work_dir(spark, "lines")
    columns = [RESOURCE, "line_item_usage_start_date", "line_item_usage_account_id", *I.TAGS_ONE, "year", "month", *I.TIE_BREAK]
    lines = lines.select(*columns)
    state, run = shared_work_dir(spark, "bridge"), shared_work_dir(spark, "run")
    part = F.col("l_orderkey") % 3
    for sent in (part == 1, part != 1, part == 0):
        lines.where(sent).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(lines.schema).parquet(landed)
        refresh_bridge(stream, I.TAGS_ONE, state, run, tie_break=[F.col(c) for c in I.TIE_BREAK]).awaitTermination()
    return as_dates(read_bridge(spark, state, I.TAGS_ONE), "line_item_usage_start_date")


@query
def changed_months_only(spark, sf):
    """A fact kept by bookmarks: a second run, after one month's file lost lines, does that month alone."""
    root, stored = shared_work_dir(spark, "root"), shared_work_dir(spark, "lines")
    lines = I.billing_lines(spark, sf, by_month=True)
    writers.overwrite_partitions(lines, stored, ["year", "month"], dealt=True)
    source = [jobs.StoredSource(stored)]
    jobs.refresh_changed_months(spark, source, root)
    month = lines.where("year = 1998 AND month = 4 AND l_linenumber <= 3")
    writers.overwrite_partitions(month, stored, ["year", "month"])
    done = jobs.refresh_changed_months(spark, source, root)
    done += jobs.refresh_changed_months(spark, source, root)  # nothing changed
    names = ",".join(f"{m['year']}-{m['month']}" for m in done)
    return rounded(spark.read.parquet(f"{root}/fact"), FACT_MEASURES).withColumn("done_again", F.lit(names))


# --- usage ----------------------------------------------------------------


def _usage(spark, sf, spec: U.MetricSpec, **options) -> DataFrame:
    return U.daily_usage(I.metric_records(spark, sf, spec), spec, I.tag_bridge(spark, sf), **options)


def _usage_rows(df: DataFrame, spec: U.MetricSpec) -> DataFrame:
    return rounded(df, [m.name for m in spec.measures], 8)


def _usage_query(name: str, spec: U.MetricSpec, **options) -> None:
    QUERIES[name] = lambda spark, sf: _usage_rows(_usage(spark, sf, spec, **options), spec)


for _spec in U.SPECS.values():
    _usage_query(f"usage_{_spec.service}", _spec)

RDS_MAX = U.RDS.with_how("database_connections", "max")
ALB_SUM = (
    U.ALB.with_how("healthy_host_count", "sum", "value_sum")
    .with_how("request_count", "sum", "value_sum")
    .with_how("consumed_lcus", "sum", "value_sum")
)
EC2_BACKFILL = U.EC2.without("p90_cpu", "p50_cpu", "max_p99")
_usage_query("usage_variant_max", RDS_MAX)
_usage_query("usage_variant_alb_sum", ALB_SUM)
_usage_query("usage_variant_ec2_backfill", EC2_BACKFILL)
_usage_query("usage_variant_sums_as_max", U.EBS.sums_as_max())
_usage_query("usage_one_account", RDS_MAX, account="A7")
_usage_query("metric_backfill", U.S3, days=I.day_range("2024-01-01", "2024-01-28"))
# Percentiles ranked over all tasks, for groups without a bound.
_usage_query("usage_ec2_hot_groups", U.EC2, spread=True)


@query
def percentiles_of_costs(spark, sf):
    """Exact percentiles of few, large groups."""
    lines = I.billing_lines(spark, sf).withColumn("cost", R.unblended_cost())
    found = exact_percentiles(lines, ["line_item_line_item_type"], "cost", [0.5, 0.9, 0.99])
    columns = {f"p{p}": F.round(F.element_at("percentiles", i + 1), 6) for i, p in enumerate((50, 90, 99))}
    return found.select("line_item_line_item_type", *[c.alias(n) for n, c in columns.items()])


@query
def percentiles_with_null_keys(spark, sf):
    """A key that is null for some lines is a group like any other."""
    lines = I.billing_lines(spark, sf).withColumn("cost", R.unblended_cost())
    found = exact_percentiles(lines, ["resource_tags_user_component"], "cost", [0.5, 0.9])
    columns = {f"p{p}": F.round(F.element_at("percentiles", i + 1), 6) for i, p in enumerate((50, 90))}
    return found.select("resource_tags_user_component", *[c.alias(n) for n, c in columns.items()])


# --- ingest ---------------------------------------------------------------


def _flat_metrics(df: DataFrame) -> DataFrame:
    flat = U.flatten_value(df).drop(METRIC_ID)
    return rounded(flat, ["value_min", "value_max", "value_sum", "value_count"], 6)


@query
def metric_ingest(spark, sf):
    return _flat_metrics(I.metric_records(spark, sf, U.EC2))


def _land_metrics(spark, sf, spec) -> str:
    """Raw records as JSON files; ``dimensions`` is written as an object."""
    raw = I.raw_metrics(spark, sf, spec)
    path = shared_work_dir(spark, "landed")
    dimensions = F.from_json("dimensions", f"struct<{spec.json_key}: string>")
    raw.withColumn("dimensions", dimensions).write.option("compression", "gzip").json(path)
    return path


@query
def metric_json_scan(spark, sf):
    landed = _land_metrics(spark, sf, U.EC2)
    I.raw_metrics(spark, sf, U.EC2).write.json(f"{landed}/absent/copy")  # excluded below
    return _flat_metrics(U.normalize_metrics(readers.read_metric_json(spark, landed, exclude=["**/absent/**"])))


@query
def metric_ingest_stream(spark, sf):
    landed, out = _land_metrics(spark, sf, U.EC2), shared_work_dir(spark, "metrics")
    run = shared_work_dir(spark, "ingest")
    for _ in range(2):  # the second run finds no new files
        ingest.ingest_metrics(ingest.metric_stream(spark, landed), out, run).awaitTermination()
    return _flat_metrics(readers.read_metric_table(spark, out))


@query
def metric_stream_then_backfill(spark, sf):
    """Half of the accounts by stream, the others by replay, into one table."""
    raw, landed = I.raw_metrics(spark, sf, U.EC2), shared_work_dir(spark, "landed")
    out, run = shared_work_dir(spark, "metrics"), shared_work_dir(spark, "ingest")
    streamed = F.col("account_id").rlike("[02468]$")
    raw.where(streamed).write.json(landed)
    for _ in range(2):  # repeating either changes nothing
        ingest.ingest_metrics(ingest.metric_stream(spark, landed), out, run).awaitTermination()
        writers.write_metrics(U.normalize_metrics(raw.where(~streamed)), out)
    return _flat_metrics(readers.read_metric_table(spark, out))


@query
def metric_replay_overlap(spark, sf):
    """All records by stream, half of them again by two replays: each counts once."""
    raw, landed = I.raw_metrics(spark, sf, U.EC2), shared_work_dir(spark, "landed")
    out, run = shared_work_dir(spark, "metrics"), shared_work_dir(spark, "ingest")
    raw.write.json(landed)
    ingest.ingest_metrics(ingest.metric_stream(spark, landed), out, run).awaitTermination()
    again = U.normalize_metrics(raw.where(F.col("account_id").rlike("[02468]$")))
    wrong = again.withColumn("value", F.col("value").withField("sum", F.lit(-1.0)))
    writers.write_metrics(wrong, out, batch="replay-1", generation=writers.REPLAY_GENERATION)
    # A later replay corrects the first one and delivers every record twice.
    writers.write_metrics(again.unionAll(again), out, batch="replay-2", generation=writers.REPLAY_GENERATION + 1)
    return _flat_metrics(readers.read_metric_table(spark, out))


@query
def metric_stream_misfits(spark, sf):
    """A stream with numbers as text, texts that are no numbers, and times that are none.

    Every record is there once, in the table or in quarantine; the counts of
    the run stand beside each.
    """
    raw, landed = I.raw_metrics(spark, sf, U.EC2), shared_work_dir(spark, "landed")
    out, run = shared_work_dir(spark, "metrics"), shared_work_dir(spark, "ingest")
    account = F.col("account_id")
    value = F.when(account == "A3", "n/a").otherwise(F.col("value.sum").cast("string"))
    text = raw.where(account.isin("A3", "A5", "A7")).withColumn("value", F.col("value").withField("sum", value))
    stamp = F.when(account == "A5", "n/a").otherwise(F.col("timestamp").cast("string"))
    text = text.withColumn("timestamp", stamp)
    for part in (raw.where(~account.isin("A3", "A5", "A7")), text):
        part.write.mode("append").json(landed)
    counts = []
    stream = ingest.metric_stream(spark, landed, files_per_batch=4)
    ingest.ingest_metrics(stream, out, run, seen=counts.append).awaitTermination()
    kept = ingest.read_quarantine(spark, out)
    misfit = lambda path: F.col(ingest.MISFITS)[path]["string"].alias(f"sent_{path.split('.')[-1]}")
    kept = kept.select("*", misfit("value.sum"), misfit("timestamp")).drop(ingest.MISFITS, "batch")
    table = readers.read_metric_table(spark, out)
    none = F.lit(None).cast("string")
    table = table.select("*", none.alias("sent_sum"), none.alias("sent_timestamp"))
    total = sum(c["records"] for c in counts)
    return _flat_metrics(table.unionByName(kept)).withColumns(
        {"records": F.lit(total).cast("bigint"), "quarantined": F.lit(sum(c["quarantined"] for c in counts)).cast("bigint")}
    )


@query
def metric_ingest_mixed_types(spark, sf):
    """Numbers, numbers as text, and a text that is no number; no unit at all."""
    raw, landed = I.raw_metrics(spark, sf, U.EC2), shared_work_dir(spark, "landed")
    odd = F.col("account_id").isin("A3", "A5")
    as_words = F.when(F.col("account_id") == "A3", "n/a").otherwise(F.col("value.sum").cast("string"))
    text = raw.where(odd).withColumn("value", F.col("value").withField("sum", as_words))
    text = text.withColumn("timestamp", F.col("timestamp").cast("string"))
    for part in (raw.where(~odd), text):
        part.drop("unit").write.mode("append").json(landed)
    read = readers.read_metric_json(spark, landed, misfits="misfits")
    rows = _flat_metrics(drop_null_columns(U.normalize_metrics(read)))
    return rows.withColumn("misfit", F.col("misfits")["value.sum"]["string"]).drop("misfits")


@query
def usage_refresh_stream(spark, sf):
    metrics_path, out = shared_work_dir(spark, "metrics"), shared_work_dir(spark, "usage")
    records, bridge = I.metric_records(spark, sf, U.S3), I.tag_bridge(spark, sf)
    writers.write_metrics(records, metrics_path)
    stream = spark.readStream.schema(spark.read.parquet(metrics_path).schema).parquet(metrics_path)
    ingest.refresh_usage(
        stream, metrics_path, U.S3, bridge, out, shared_work_dir(spark, "refresh")
    ).awaitTermination()
    return _usage_rows(spark.read.parquet(out), U.S3)


@query
def usage_late_records(spark, sf):
    """Usage by counts: a first batch, then late records, then a replay that brings half of all again."""
    raw, out = U.normalize_metrics(I.raw_metrics(spark, sf, U.EC2)), shared_work_dir(spark, "metrics")
    state, usage, run = (shared_work_dir(spark, name) for name in ("counts", "usage", "run"))
    bridge = materialize(I.tag_bridge(spark, sf), "bridge")
    late = F.pmod(F.xxhash64("timestamp"), F.lit(7)) == 0
    wrong = raw.where(~late).withColumn("value", F.when(F.col("account_id") == "A2", F.col("value").withField("sum", F.lit(1e6))).otherwise(F.col("value")))
    again = raw.where(F.col("account_id").rlike("[02468]$"))
    for number, batch in enumerate((wrong, raw.where(late), again)):
        write_with_changes(batch, out, f"batch-{number}", number)
        path = changes_path(out)
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        refresh_by_changes(stream, U.EC2, bridge, state, usage, run).awaitTermination()
    return _usage_rows(spark.read.parquet(usage), U.EC2)


@query
def metrics_of_one_day(spark, sf):
    path = shared_work_dir(spark, "metrics")
    writers.write_metrics(I.metric_records(spark, sf, U.EC2), path)
    return _flat_metrics(readers.read_metrics(spark, path, "AWSEC2", 2024, 1, 9))


# --- writes ---------------------------------------------------------------


def _usage_halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Usage up to day 20, and from day 15 with doubled measures."""
    usage = _usage(spark, sf, U.S3)
    names = [m.name for m in U.S3.measures]
    stage = usage.where("day >= 15").withColumns({n: F.col(n) * 2 for n in names})
    return usage.where("day <= 20"), stage


@query
def upsert_usage(spark, sf):
    target, stage = _usage_halves(spark, sf)
    return _usage_rows(upsert(target, stage, USAGE_KEYS), U.S3)


@query
def upsert_usage_table(spark, sf):
    target, stage = _usage_halves(spark, sf)
    path = shared_work_dir(spark, "fact")
    days = list(ingest.DAY_PARTITIONS)
    writers.overwrite_partitions(target, path, days)
    for _ in range(2):  # the same stage twice changes nothing
        writers.upsert_partitions(spark, path, stage, USAGE_KEYS, days)
    return _usage_rows(spark.read.parquet(path), U.S3)


@query
def upsert_bucketed(spark, sf):
    """The same upsert into a table bucketed by the key: the target is not shuffled."""
    target, stage = _usage_halves(spark, sf)
    root = shared_work_dir(spark, "bucketed")
    table = BucketedTable("usage_" + root[-12:], USAGE_KEYS, 8, root, ingest.DAY_PARTITIONS)
    table.create(target)
    for _ in range(2):  # the same stage twice changes nothing
        table.upsert(stage)
    return _usage_rows(table.read(spark), U.S3)


@query
def appended_days(spark, sf):
    """Usage of the first and then of the other days, each added once."""
    usage, path = _usage(spark, sf, U.S3), shared_work_dir(spark, "usage")
    for days in ("day <= 15", "day > 15"):
        writers.append_partitions(usage.where(days), path, ingest.DAY_PARTITIONS)
    return _usage_rows(spark.read.parquet(path), U.S3)


@query
def upsert_transfer(spark, sf):
    rows = _transfer(spark, sf)
    stage = rows.where("year >= 2000").withColumn("DT_cost", F.col("DT_cost") + 1)
    return rounded(upsert(rows.where("year <= 2000"), stage, TRANSFER_KEYS), ["DT_cost"])


@query
def upsert_cost_fact(spark, sf):
    # Stored first: target, staged keys and staged rows all read it.
    fact = materialize(cost_fact([fact_lines(I.billing_lines(spark, sf, I.GRAIN))], tag_cols=I.TAGS_ONE), "fact")
    stage = fact.where("year >= 2000").withColumn("amortized_cost", F.col("amortized_cost") + 1)
    return rounded(upsert(fact.where("year <= 2000"), stage, COST_KEYS, day="date_dim_id"), FACT_MEASURES)


@query
def cost_fact_load(spark, sf):
    """The load job: staged months of a stored fact, twice."""
    # Stored first, as a write by month needs it: the target and both loads read it.
    fact = materialize(cost_fact([fact_lines(I.billing_lines(spark, sf, I.MONTH_GRAIN))], tag_cols=I.TAGS_ONE), "fact")
    path = shared_work_dir(spark, "fact")
    writers.overwrite_partitions(fact.where("year <= 2000"), path, ["year", "month"], dealt=True)
    stage = fact.where("year >= 2000").withColumn("amortized_cost", F.col("amortized_cost") + 1)
    for _ in range(2):
        jobs.load_cost_fact(spark, stage, path, dealt=True)
    return rounded(spark.read.parquet(path), FACT_MEASURES)


@query
def replace_table(spark, sf):
    path = shared_work_dir(spark, "account_dim")
    dim = account_dim(_both(spark, sf), I.account_directories(spark, sf))
    for _ in range(2):
        writers.load(dim, path, "full")
    delta = account_dim(
        _both(spark, sf), I.account_directories(spark, sf), mode="delta", existing=spark.read.parquet(path)
    )
    writers.load(delta, path, "delta")  # no new account: nothing is written
    return readers.read_parquet(spark, path)


@query
def dimension_load(spark, sf):
    """The dimension jobs: a full load that swaps the tag table, then a delta that finds nothing new."""
    root = shared_work_dir(spark, "dimensions")
    name = "tags_" + root[-12:]
    # Stored first, by the columns dimensions read: both loads read them for every table.
    sources = [
        dataclasses.replace(s, lines=materialize(s.lines.select(*jobs.dimension_columns(s.lines)), "lines"))
        for s in I.two_sources(spark, sf)
    ]
    for mode in ("full", "delta"):
        jobs.dimension_jobs(spark, sources, I.account_directories(spark, sf), root, mode=mode, tag_table=name)
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in ("account", "product", "date")}
    return writers.row_counts(**tables, tag=readers.read_view(spark, name))


@query
def summary_view(spark, sf):
    """A view from a query over the star's tables, and a report that reads it."""
    prefix = f"star_{uuid.uuid4().hex[:8]}_"
    I.stored_star(spark, sf).register(prefix)
    writers.create_view(
        spark,
        f"{prefix}monthly",
        f"""SELECT d.year_attr, d.month_attr, a.account_name, sum(f.amortized_cost) AS amortized_cost
        FROM {prefix}cost_insights_fact f JOIN {prefix}date_dim d USING (date_dim_id)
        JOIN (SELECT DISTINCT aws_account_dim_id, account_name FROM {prefix}account_dim) a USING (aws_account_dim_id)
        GROUP BY ALL""",
    )
    return rounded(readers.read_view(spark, f"{prefix}monthly").where("year_attr = '1998'"))


@query
def declared_schema_scan(spark, sf):
    """A month of the export by its declared columns; those its files lack are null."""
    path = shared_work_dir(spark, "lines")
    lines = I.billing_lines(spark, sf, by_month=True).drop("line_item_operation")
    writers.overwrite_partitions(lines, path, ["year", "month"], dealt=True)
    rows = readers.read_billing_month(spark, path, 1998, 4, billing_schema(I.TAGS_ONE))
    columns = ["line_item_usage_account_id", "line_item_resource_id", "line_item_operation", *I.TAGS_ONE, "year", "month"]
    return rounded(rows.select(*columns, "line_item_unblended_cost"), ["line_item_unblended_cost"])


@query
def swap_table(spark, sf):
    root = shared_work_dir(spark, "tables")
    name = "tag_dim_" + root[-12:]
    lines = I.billing_lines(spark, sf)
    writers.swap_table(hashed_dim([lines], I.TAGS_ONE[:2], TAG_KEY), name, root)
    writers.swap_table(hashed_dim([lines], I.TAGS_ONE, TAG_KEY), name, root)
    return readers.read_view(spark, name)


@query
def partition_overwrite(spark, sf):
    path = shared_work_dir(spark, "cost_fact")
    fact = cost_fact([fact_lines(I.billing_lines(spark, sf, I.MONTH_GRAIN))], tag_cols=I.TAGS_ONE)
    writers.overwrite_partitions(fact, path, ["year", "month"], dealt=True)
    month = fact.where("year = 1998 and month = 4").withColumn("public_cost", F.lit(0.0))
    writers.overwrite_partitions(month, path, ["year", "month"], dealt=True)
    return rounded(spark.read.parquet(path), FACT_MEASURES)


@query
def overwrite_with_empty_day(spark, sf):
    """Two months recomputed, of which one comes out empty: its old rows go."""
    path = shared_work_dir(spark, "cost_fact")
    fact = cost_fact([fact_lines(I.billing_lines(spark, sf, I.MONTH_GRAIN))], tag_cols=I.TAGS_ONE)
    writers.overwrite_partitions(fact, path, ["year", "month"], dealt=True)
    again = fact.where("year = 1998 and month = 4")
    expected = [{"year": 1998, "month": m} for m in (4, 5)]
    writers.overwrite_partitions(again, path, ["year", "month"], expected=expected, dealt=True)
    return rounded(spark.read.parquet(path), FACT_MEASURES)


@query
def masked_month(spark, sf):
    """Write the export by month, then read, mask and replace one month."""
    path = shared_work_dir(spark, "lines")
    columns = [*I.TIE_BREAK, "line_item_line_item_type", "line_item_usage_type", "product_product_name", *MASKED_COLUMNS]
    lines = I.billing_lines(spark, sf, by_month=True).select(*columns, "year", "month")
    writers.overwrite_partitions(lines, path, ["year", "month"], dealt=True)
    month = mask_costs(readers.read_billing_month(spark, path, 1998, 4))
    out = shared_work_dir(spark, "masked")
    writers.overwrite_partitions(month, out, ["year", "month"])
    return rounded(spark.read.parquet(out), ["line_item_unblended_cost", "line_item_blended_cost"])


@query
def merged_schema_scan(spark, sf):
    """Two exports with different tag columns in one folder."""
    path = shared_work_dir(spark, "exports")
    for source in I.two_sources(spark, sf):
        tags = [c for c in source.lines.columns if c.startswith("resource_tags_user_")]
        source.lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *tags).write.mode("append").parquet(path)
    return readers.read_merged(spark, path)


@query
def row_counts(spark, sf):
    first, second = I.two_sources(spark, sf)
    both = first.lines.unionByName(second.lines, allowMissingColumns=True)
    return writers.row_counts(first=first.lines, second=second.lines, both=both)


# --- reshaping and commitments --------------------------------------------


@query
def declared_mapping(spark, sf):
    events = I.table(spark, sf, "events")
    return apply_mapping(
        events,
        [("event_id", "id", "string"), ("event_type", "number", "long"), ("value", "whole", "long"), ("props", "props", "string")],
    )


@query
def mixed_type_choice(spark, sf):
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.col("user_id").cast("string"))
        .when(kind == 1, F.concat(F.col("user_id").cast("string"), F.lit(".5")))
        .otherwise(F.col("event_type"))
    )
    chosen = I.table(spark, sf, "events").select("event_id", choice_struct(text).alias("choice"))
    return flatten(chosen)


def _ri_utilization(spark, sf):
    landed = I.commitment_responses(spark, sf, C.RI_UTILIZATION, coverage=False)
    return C.ri_utilization({s: C.landed_series(r, C.RI_UTILIZATION) for s, r in landed.items()})


def _ri_coverage(spark, sf):
    landed = I.commitment_responses(spark, sf, C.RI_COVERAGE, coverage=True)
    return C.ri_coverage({s: C.landed_series(r, C.RI_COVERAGE) for s, r in landed.items()})


def _savings_coverage(spark, sf):
    landed = I.commitment_responses(spark, sf, C.SAVINGS_COVERAGE, coverage=True)
    return C.savings_coverage({s: C.landed_series(r, C.SAVINGS_COVERAGE) for s, r in landed.items()})


def _savings_utilization(spark, sf):
    landed = I.account_wide_response(spark, sf, C.SAVINGS_UTILIZATION)
    return C.savings_utilization(C.landed_series(landed, C.SAVINGS_UTILIZATION))


@query
def commitments_ri_utilization(spark, sf):
    return _ri_utilization(spark, sf)


@query
def commitments_ri_coverage(spark, sf):
    return _ri_coverage(spark, sf)


@query
def commitments_savings_coverage(spark, sf):
    return _savings_coverage(spark, sf)


@query
def commitments_savings_utilization(spark, sf):
    return _savings_utilization(spark, sf)


@query
def commitments_of_a_day(spark, sf):
    """The daily run: one reporting day."""
    landed = I.commitment_responses(spark, sf, C.RI_COVERAGE, coverage=True)
    period = reporting_period(dt.date(2024, 1, 16))
    return C.ri_coverage({s: C.landed_series(r, C.RI_COVERAGE, period) for s, r in landed.items()})


@query
def flatten_commitments(spark, sf):
    """Through landed JSON files, as the responses arrive."""
    series = {}
    for service, response in I.commitment_responses(spark, sf, C.RI_UTILIZATION, coverage=False).items():
        path = shared_work_dir(spark, "responses")
        response.write.json(path)
        series[service] = C.landed_series(readers.read_landed_json(spark, path, response.schema), C.RI_UTILIZATION)
    return C.ri_utilization(series)


@query
def commitments_upsert(spark, sf):
    rows = _ri_utilization(spark, sf)
    stage = rows.where(F.col("date_dim_id") >= "20240115").withColumn("UsedHours", F.lit("0"))
    return upsert(rows.where(F.col("date_dim_id") <= "20240120"), stage, COMMITMENT_KEYS)


def _commitment_load(name: str, build: Callable[[SparkSession, str], DataFrame], changed: str) -> None:
    """Twice the same stage into a stored commitment table."""

    def run(spark, sf):
        rows, path = build(spark, sf), shared_work_dir(spark, "commitments")
        writers.replace_table(rows.where(F.col("date_dim_id") <= "20240120"), path)
        stage = rows.where(F.col("date_dim_id") >= "20240115").withColumn(changed, F.lit("0"))
        for _ in range(2):
            jobs.load_commitments(spark, stage, path)
        return spark.read.parquet(path)

    QUERIES[name] = run


_commitment_load("commitments_load_ri_utilization", _ri_utilization, "UsedHours")
_commitment_load("commitments_load_ri_coverage", _ri_coverage, "CoverageHours_OnDemandHours")
_commitment_load("commitments_load_savings_coverage", _savings_coverage, "Total_CoverageHours_OnDemandHours")
_commitment_load("commitments_load_savings_utilization", _savings_utilization, "Total_UsedHours")


# --- reports --------------------------------------------------------------

RDS_NAME = "Amazon Relational Database Service"
CACHE_NAME, CACHE_ACCOUNT = "Amazon ElastiCache", "NATION_18"
NAME, ACCOUNT, PAYER = "NATION_3", "A3", "P3"
FIRST_HALF = P.day_ids(dt.date(1998, 4, 1), dt.date(1998, 4, 15))
TWENTY_DAYS = P.day_ids(dt.date(1998, 5, 1), dt.date(1998, 5, 20))


def _report(name: str, run: Callable[[Star], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: rounded(run(I.stored_star(spark, sf)))


def _table_sizes(star: Star) -> DataFrame:
    return writers.row_counts(**{name: getattr(star, name) for name in ("fact", "date", "account", "tag", "product")})


@query
def star_load(spark, sf):
    """Build and store fact and dimensions; rows per table."""
    sources, directories = I.two_sources(spark, sf, I.GRAIN), I.account_directories(spark, sf)
    return _table_sizes(load_star(sources, directories, shared_work_dir(spark, "star")))


@query
def star_load_month(spark, sf):
    """The star of one billing month: every table, not the fact alone, holds that month's rows."""
    sources, directories = I.two_sources(spark, sf, I.GRAIN), I.account_directories(spark, sf)
    return _table_sizes(load_star(sources, directories, shared_work_dir(spark, "star"), period=(1998, 4)))


@query
def report_r01_from_lines(spark, sf):
    """R1 without a stored fact: from billing lines to the report in one plan."""
    star = build_star(I.two_sources(spark, sf), I.account_directories(spark, sf), rollup=False)
    return rounded(P.by_account(star))


_report("report_r01", P.by_account)
_report("report_r02", lambda s: P.by_account_day_service(s, service=CACHE_NAME, account_name=CACHE_ACCOUNT, days=FIRST_HALF))
_report("report_r03", lambda s: P.by_account_day_service(s, service=CACHE_NAME, account_name=CACHE_ACCOUNT, day_prefix="199804"))
_report("report_r04", lambda s: P.by_day_and_tag(s, "resource_tags_user_squad", account=ACCOUNT, year="1998", month="04", value="BUILDING"))
_report("report_r04_all_values", lambda s: P.by_day_and_tag(s, "resource_tags_user_component", account=ACCOUNT, year="1998", month="04"))
_report("report_r05", lambda s: P.by_month_and_service(s, service=RDS_NAME))
_report("report_r05_without_tax", lambda s: P.by_month_and_service(s, service=RDS_NAME, year="1998", month="03", excluded=("Tax",)))
_report("report_r06", lambda s: P.by_account_day(s, days=FIRST_HALF, account=ACCOUNT))
_report("report_r06_named", lambda s: P.by_account_day(s, days=TWENTY_DAYS, account_name=NAME))
_report("report_r07", lambda s: P.by_account_and_service(s, service=CACHE_NAME, account_name=CACHE_ACCOUNT, days=FIRST_HALF))
_report("report_r08_days", lambda s: P.account_total(s, account_name=NAME, days=FIRST_HALF))
_report("report_r08_month", lambda s: P.account_total(s, account_name=NAME, day_prefix="199804"))
_report("report_r08_all", lambda s: P.account_total(s, day_prefix="199805", with_id=True))
_report("report_r09", lambda s: P.by_service_and_charge(s, service_prefix="AWS Marketplace", account_name=NAME, day_prefix="1998"))
_report("report_r09_daily", lambda s: P.by_service_and_charge(s, service_prefix="AWS Mar", account=ACCOUNT, with_day=True))
_report("report_r10", lambda s: P.by_service_and_charge_or_prefix(s, account_name=NAME, day_prefix="1998", service_prefix="AWS Marketplace", or_prefix="OCB"))
_report("report_r11", lambda s: P.by_purchase_option(s, account=ACCOUNT, year="1998", month="04", not_service=RDS_NAME))
_report("report_r12", lambda s: P.purchase_option_total(s, account=ACCOUNT, year="1998", month="04", option="OnDemand"))
_report("report_r13_squad", lambda s: P.period_total(s, account=ACCOUNT, year="1998", month="05", days=TWENTY_DAYS, squad="BUILDING"))
_report("report_r13_payer", lambda s: P.period_total(s, account=ACCOUNT, year="1998", month="05", days=TWENTY_DAYS, payer=PAYER))
_report("report_r13_payer_daily", lambda s: P.period_total(s, account=ACCOUNT, year="1998", month="05", days=TWENTY_DAYS, payer=PAYER, by_day=True))


@query
def report_r14(spark, sf):
    series = _savings_coverage(spark, sf)
    return rounded(P.average_coverage(series, "Total_CoverageHours_CoverageHoursPercentage", "202401"), ["average_coverage"], 6)


@query
def report_r15(spark, sf):
    return _usage_rows(P.resource_history(_usage(spark, sf, U.RDS), "i-7", "202401"), U.RDS)


@query
def report_r16(spark, sf):
    events = I.table(spark, sf, "events")
    start = F.col("ts").cast("timestamp")
    log = events.select(
        "user_id",
        F.lit("warehouse").alias("database"),
        F.col("event_type").alias("query"),
        start.alias("start_time"),
        (start + F.expr("INTERVAL 5 MINUTES")).alias("end_time"),
        (F.col("event_type") == "error").cast("int").alias("aborted"),
    )
    users = events.select("user_id", F.concat(F.lit("user-"), "user_id").alias("username")).distinct()
    rows = P.activity_log(log, users, as_of="2024-01-15 12:00:00")
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_time", "end_time")})


@query
def report_r17(spark, sf):
    lines = L.usage_lines(I.billing_lines(spark, sf), year=1998, month=4, days=FIRST_HALF)
    return rounded(L.by_account_and_day(lines))


@query
def report_r18(spark, sf):
    test = L.service_or_code(RDS_NAME, "AmazonRDS")
    return rounded(L.by_day(L.usage_lines(I.billing_lines(spark, sf), test, year=1998, month=4, days=FIRST_HALF)))


@query
def report_r19(spark, sf):
    code = F.col("line_item_product_code") == "AmazonRDS"
    lines = L.usage_lines(I.billing_lines(spark, sf), code, account=ACCOUNT, year=1998)
    return rounded(L.by_usage_type_and_operation(lines), [P.COST, "reservation_cost"])


@query
def report_r20_service(spark, sf):
    return rounded(L.by_columns(L.usage_lines(I.billing_lines(spark, sf), account=ACCOUNT), "product_servicename"))


@query
def report_r20_code(spark, sf):
    transfer = F.col("product_servicename") == "AWS Data Transfer"
    lines = L.usage_lines(I.billing_lines(spark, sf), transfer)
    return rounded(L.by_columns(lines, "product_servicename", "line_item_product_code"))


@query
def report_r20_tags(spark, sf):
    lines = L.usage_lines(I.billing_lines(spark, sf), account=ACCOUNT, year=1998)
    return rounded(L.by_columns(lines, "resource_tags_user_squad", "resource_tags_user_component"))


@query
def report_r21(spark, sf):
    lines = I.billing_lines(spark, sf)
    tests = [F.col("resource_tags_user_component") == "", F.col("line_item_usage_account_id") == ACCOUNT]
    return L.distinct_values(lines, "line_item_operation", *tests, limit=10)


@query
def report_r21_never_equal(spark, sf):
    """A comparison with null is never true, so only '' qualifies."""
    tag = F.col("resource_tags_user_component")
    test = (tag == "") | (tag == F.lit(None).cast("string"))
    return L.distinct_values(I.billing_lines(spark, sf), "line_item_usage_type", test)


@query
def report_r22_marketplace(spark, sf):
    columns = [
        "line_item_usage_account_id", "product_servicename", "line_item_product_code",
        "bill_billing_entity", "line_item_usage_start_date", "line_item_blended_cost",
    ]
    test = F.col("bill_billing_entity") == "AWS Marketplace"
    found = L.find_lines(I.billing_lines(spark, sf), test, F.col("product_servicename") == "", columns=columns)
    return as_dates(rounded(found, ["line_item_blended_cost"]), "line_item_usage_start_date")


@query
def report_r22_ids(spark, sf):
    ids = ["5979-6-1616-79", "7124-7-756-22", "11631-5-1148-98"]
    test = F.col("identity_line_item_id").isin(*ids)
    columns = ["identity_line_item_id", "line_item_usage_account_id", "line_item_unblended_cost"]
    return L.find_lines(I.billing_lines(spark, sf), test, columns=columns)


@query
def report_r22_code(spark, sf):
    code = F.col("line_item_product_code")
    tests = [code.contains("OCB"), code != "OCBPremiumSupport", F.col(R.CHARGE) == "Fee"]
    columns = ["identity_line_item_id", "line_item_product_code", "line_item_unblended_cost"]
    return L.find_lines(I.billing_lines(spark, sf), *tests, columns=columns)


@query
def report_r22_tag(spark, sf):
    tests = [F.col("resource_tags_user_name") == "svc-7", F.col("resource_tags_user_component") == "1-URGENT"]
    columns = ["resource_tags_user_component", "line_item_usage_start_date", "identity_line_item_id"]
    found = L.find_lines(I.billing_lines(spark, sf), *tests, columns=columns)
    return as_dates(found, "line_item_usage_start_date")


@query
def report_r22_summary(spark, sf):
    rows = summary(I.billing_lines(spark, sf, I.GRAIN), months=None, resource_count=None)
    tests = [F.col("line_item_product_code") == "AmazonGlacier", F.col("year") == 1998]
    columns = ["usage_date", "linked_account_id", "service", "amortized_cost"]
    order = ["usage_date", "linked_account_id", "service", "amortized_cost"]
    return as_dates(rounded(L.find_lines(rows, *tests, columns=columns, order=order, limit=10)), "usage_date")


@query
def report_r23(spark, sf):
    metrics = I.metric_records(spark, sf, U.RDS)
    nested = metrics.withColumn("dimensions", F.from_json("dimensions", "struct<DBInstanceIdentifier: string>"))
    tests = [
        F.col("namespace") == "AWSRDS",
        F.col("dimensions.dbinstanceidentifier") == "i-7",
        F.col("metric_name") == "DatabaseConnections",
    ]
    return L.distinct_values(nested, "day", *tests, descending=True)


@query
def reconcile_totals(spark, sf):
    rows = L.reconcile(I.billing_lines(spark, sf), I.stored_star(spark, sf), service=RDS_NAME, code="AmazonRDS")
    return rounded(rows, ["from_lines", "from_fact", "difference"])


@query
def reconcile_by_checksums(spark, sf):
    """Two stored facts that differ on two days: checksums find the days, and only those are compared."""
    root, first = shared_work_dir(spark, "facts"), I.stored_star(spark, sf).fact
    changed = F.col("date_dim_id").isin("19980401", "19980502") & (F.col("aws_account_dim_id") == "A3")
    cost = F.when(changed, F.col("amortized_cost") + 1).otherwise(F.col("amortized_cost"))
    keys = [*FACT_PARTITIONS, USAGE_MONTH]
    # The stored fact is read by its files, which lie by these keys.
    writers.overwrite_partitions(first.withColumn("amortized_cost", cost), f"{root}/second", keys, dealt=True)
    second = spark.read.parquet(f"{root}/second")
    sums = []
    for name, fact in (("first", first), ("second", second)):
        writers.replace_table(day_checksums(fact), f"{root}/{name}-sums")
        sums.append(spark.read.parquet(f"{root}/{name}-sums"))
    days = differing_days(*sums)
    return reconcile_days(first, second, days, ["date_dim_id", "aws_account_dim_id"], "amortized_cost")
