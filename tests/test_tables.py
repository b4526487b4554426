"""Whole tables: conservation, keys, writes, readers and streaming."""

import dataclasses
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from frames import assert_close, rows
from registry import inputs as I
from registry.queries import QUERIES
from tallyfold.functions.keys import PRODUCT_COLUMNS, tag_columns
from tallyfold.operators import usage as U
from tallyfold.operators.cost_fact import FACT_MEASURES, cost_fact, cost_fact_view, fact_lines, fact_of_base, star_base
from tallyfold.operators.dimensions import hashed_dim, unknown_keys
from tallyfold.operators.summary import SUMMARY_KEYS, summary
from tallyfold.plans import jobs
from tallyfold.plans import reports as P
from tallyfold.plans.star import PRODUCT_KEY, TAG_KEY, build_star, load_star, source_fact_lines
from tallyfold.schemas import METRIC_SCHEMA, billing_schema
from tallyfold.session import materialize, shared_work_dir
from tallyfold.sources import readers, writers
from tallyfold.streaming import ingest


def totals(df, *names):
    return [round(v, 2) for v in df.agg(*[F.sum(n) for n in names]).first()]


def test_declared_schema_has_every_column():
    schema = billing_schema(extra=False)
    # 81 declared entries, one of which repeats line_item_usage_type
    assert len(schema) == 80
    kinds = [f.dataType.simpleString() for f in schema.fields]
    assert (kinds.count("double"), kinds.count("timestamp")) == (21, 4)


def test_sums_survive_every_step(spark, sf):
    lines = I.billing_lines(spark, sf).cache()
    direct = fact_lines(lines)
    by_summary = summary(lines, months=None, resource_count=None)
    fact = cost_fact([by_summary], tag_cols=I.TAGS_ONE)
    assert totals(direct, *FACT_MEASURES) == totals(by_summary, *FACT_MEASURES) == totals(fact, *FACT_MEASURES)
    view = cost_fact_view([direct], tag_cols=I.TAGS_ONE)
    assert view.count() == lines.count()
    assert totals(view, *FACT_MEASURES) == totals(fact, *FACT_MEASURES)
    lines.unpersist()


def test_summary_groups_by_unresolved_name_and_tags(spark, sf):
    first = I.billing_lines(spark, sf).limit(1)
    values = {"l_orderkey": F.lit(1), "product_servicename": F.lit("AWS Data Transfer"), "line_item_product_code": F.lit("AmazonRDS")}
    named = first.withColumns(values)
    plain = named.withColumn("product_servicename", F.lit("Amazon Relational Database Service"))
    tagged = plain.withColumn("resource_tags_user_component", F.lit(""))
    untagged = plain.withColumn("resource_tags_user_component", F.lit(None).cast("string"))
    both = summary(named.unionByName(plain).unionByName(tagged).unionByName(untagged), months=None)
    assert both.select("product_servicename").distinct().count() == 1
    assert both.count() >= 3
    fact = cost_fact([both.withColumn("resource_tags_user_component", F.lit("c"))], tag_cols=I.TAGS_ONE)
    assert fact.count() == 1


def test_summary_options(spark, sf):
    lines = I.billing_lines(spark, sf)
    with pytest.raises(ValueError):
        summary(lines)
    recent = summary(lines, as_of=I.AS_OF, open_month_rule=True)
    assert recent.columns[: len(SUMMARY_KEYS)] == list(SUMMARY_KEYS)
    assert recent.agg(F.min("billing_period").cast("date")).first()[0] >= dt.date(2001, 1, 1)
    exact = summary(lines, months=None, resource_count="exact").agg(F.sum("resource_id_count")).first()[0]
    approx = summary(lines, months=None).agg(F.sum("resource_id_count")).first()[0]
    assert abs(exact - approx) <= 0.05 * exact


def test_every_fact_key_is_in_its_dimension(spark, sf):
    star = build_star(I.two_sources(spark, sf), I.account_directories(spark, sf))
    for dim, key in ((star.tag, TAG_KEY), (star.product, PRODUCT_KEY), (star.date, "date_dim_id"), (star.account, "aws_account_dim_id")):
        assert unknown_keys(star.fact, dim, key).count() == 0
        assert dim.groupBy(key).count().where("count > 1").count() == 0
    star.register()
    by_sql = spark.sql(
        """SELECT sum(amortized_cost) AS c FROM cost_insights_fact f
        JOIN account_dim USING (aws_account_dim_id) JOIN tag_dim USING (tag_dim_id)
        JOIN resource_dim USING (aws_product_dim_id) JOIN date_dim USING (date_dim_id)"""
    )
    assert round(by_sql.first()[0], 2) == totals(star.fact, "amortized_cost")[0]


def test_equal_tags_of_two_sources_share_a_key(spark, sf):
    sources = I.two_sources(spark, sf)
    tags = tag_columns(*[s.lines for s in sources])
    assert tags == sorted(set(I.TAGS_ONE) | set(I.TAGS_TWO))
    parts = source_fact_lines(sources, tags)
    assert all(set(tags) <= set(p.columns) for p in parts)
    dim = hashed_dim([s.lines for s in sources], tags, TAG_KEY)
    assert unknown_keys(cost_fact(parts, tag_cols=tags), dim, TAG_KEY).count() == 0
    assert hashed_dim(parts, PRODUCT_COLUMNS, PRODUCT_KEY).where("product_region is null").count() == 0


def test_usage_needs_every_metric_and_keeps_accounts_apart(spark):
    schema = "account_id string, namespace string, metric_name string, dimensions string, timestamp long, value_min double, value_max double, value_sum double, value_count double, year int, month int, day int"
    stamp = int(dt.datetime(2024, 1, 5, 3, tzinfo=dt.timezone.utc).timestamp() * 1000)

    def record(account, metric, value, bucket="b", count=1.0):
        return (account, "AWSS3", metric, f'{{"BucketName":"{bucket}"}}', stamp, value, value, value, count, 2024, 1, 5)

    metrics = spark.createDataFrame(
        [
            record("a", "GetRequests", 1.0), record("a", "GetRequests", 2.0), record("a", "PutRequests", 3.0),
            record("z", "GetRequests", 50.0), record("z", "PutRequests", 60.0),
            record("a", "GetRequests", 9.0, "half"), record("a", "Other", 9.0), record("a", "PutRequests", 9.0, "untagged"),
            record("a", "GetRequests", 9.0, "untagged"),
        ],
        schema,
    )
    bridge = spark.createDataFrame(
        [("b", "a", "t1", "2024-01-01"), ("b", "z", "t2", "2023-01-01"), ("half", "a", "t3", "2024-01-01")],
        "line_item_resource_id string, line_item_usage_account_id string, tag_dim_id string, d string",
    ).withColumn("line_item_usage_start_date", F.col("d").cast("timestamp"))
    found = U.daily_usage(metrics, U.S3, bridge)
    assert [r.asDict() for r in found.collect()] == [
        {
            "resource": "b", "aws_account_dim_id": "a", "get_requests": 3.0, "put_requests": 3.0,
            "date_dim_id": "20240105", "tag_dim_id": "t1", "year": 2024, "month": 1, "day": 5,
        }
    ]
    assert U.daily_usage(metrics, U.S3, bridge, account="z").first()["get_requests"] == 50.0
    assert U.daily_usage(metrics, U.S3, bridge, days=[dt.date(2024, 1, 6)]).count() == 0


def test_zero_counts_do_not_raise(spark, sf):
    records = I.metric_records(spark, sf, U.EC2)
    assert records.where("value.count = 0").count() > 0
    plain = U.daily_usage(records, U.EC2, I.tag_bridge(spark, sf))
    ranked = U.daily_usage(records, U.EC2, I.tag_bridge(spark, sf), spread=True)
    names = [m.name for m in U.EC2.measures]
    as_rounded = lambda df: rows(df.select("resource", "date_dim_id", *[F.round(n, 9) for n in names]))
    assert as_rounded(plain) == as_rounded(ranked)


def test_partition_filter_reaches_the_scan(spark, sf):
    path = shared_work_dir(spark, "metrics")
    writers.write_metrics(I.metric_records(spark, sf, U.S3), path)
    day = U.daily_usage(spark.read.parquet(path), U.S3, I.tag_bridge(spark, sf), days=[dt.date(2024, 1, 9)])
    plan = day._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "metric_name" in line)
    filters = scan[scan.index("PartitionFilters"):]
    assert "namespace" in filters and "day" in filters
    assert "In(metric_name" in filters
    assert "value:struct<sum:" in scan and "value:struct<min" not in scan
    assert readers.read_metrics(spark, path, "AWSS3", 2024, 1, 9).count() == spark.read.parquet(path).where("day = 9").count()


def test_partition_writes(spark):
    path = shared_work_dir(spark, "table")
    df = spark.createDataFrame([(1, 2022, 1), (2, 2022, 2)], "v int, year int, month int")
    writers.overwrite_partitions(df, path, ["year", "month"])
    writers.overwrite_partitions(spark.createDataFrame([(5, 2022, 2)], df.schema), path, ["year", "month"])
    assert rows(spark.read.parquet(path).select("v", "month")) == [(1, 1), (5, 2)]
    writers.append_partitions(df.where("v = 1"), path, ["year", "month"])
    assert spark.read.parquet(path).count() == 3
    assert readers.read_billing_month(spark, path, 2022, 2).select("v").first()[0] == 5
    plan = writers.spread(df, ["year"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan


def test_upsert_table_touches_staged_days_only(spark):
    path = shared_work_dir(spark, "fact")
    schema = "date_dim_id string, k string, v int, year int, month int, day int"
    target = spark.createDataFrame([("20240101", "a", 1, 2024, 1, 1), ("20240102", "a", 2, 2024, 1, 2), ("20240102", None, 3, 2024, 1, 2)], schema)
    stage = spark.createDataFrame([("20240102", "a", 20, 2024, 1, 2), ("20240103", "a", 30, 2024, 1, 3)], schema)
    days = ["year", "month", "day"]
    writers.overwrite_partitions(target, path, days)
    for _ in range(2):
        writers.upsert_partitions(spark, path, stage, ["date_dim_id", "k"], days)
        got = rows(spark.read.parquet(path).select("date_dim_id", "k", "v"))
        assert got == sorted([("20240101", "a", 1), ("20240102", "a", 20), ("20240102", None, 3), ("20240103", "a", 30)], key=repr)
    writers.upsert_partitions(spark, path, stage.limit(0), ["date_dim_id", "k"], days)
    assert spark.read.parquet(path).count() == 4


def test_upsert_of_dealt_rows_moves_only_what_stays(spark, monkeypatch):
    days = ["year", "month"]
    day = (F.col("id") % 40).cast("string")
    frame = spark.range(4000).select(day.alias("date_dim_id"), F.col("id").cast("string").alias("k"), "id", F.lit(2024).alias("year"), (F.col("id") % 3).alias("month"))
    stage = frame.where("month > 0 AND id % 10 < 7").withColumn("id", -F.col("id"))
    found, whole = [], []
    for dealt in (False, True):
        path = shared_work_dir(spark, "fact")
        writers.overwrite_partitions(frame, path, days)
        put = writers.overwrite_partitions
        monkeypatch.setattr(writers, "overwrite_partitions", lambda df, *a, **b: (whole.append((df, b.get("dealt"))), put(df, *a, **b)))
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        before = disk.getAllFiles().size()
        writers.upsert_partitions(spark, path, stage.repartition(3, *days), ["date_dim_id", "k"], days, dealt=dealt)
        monkeypatch.undo()
        assert disk.getAllFiles().size() <= before
        found.append(rows(spark.read.parquet(path).select(frame.columns)))
        df, said = whole.pop()
        assert said == dealt and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    kept = frame.join(stage.select("k"), "k", "left_anti").select(frame.columns)
    assert found[0] == found[1] == rows(kept.unionByName(stage))


def test_load_modes_and_swap(spark):
    path = shared_work_dir(spark, "dim")
    df = spark.createDataFrame([("a",)], "k string")
    assert writers.load(df, path, "full")
    assert not writers.load(df.limit(0), path, "delta")
    assert writers.load(df, path, "month")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        writers.load(df, path, "other")
    root, name = shared_work_dir(spark, "swap"), "swap_test"
    first = writers.swap_table(df, name, root)
    second = writers.swap_table(df.withColumn("extra", F.lit(1)), name, root)
    assert first != second and readers.read_view(spark, name).columns == ["k", "extra"]


def test_glob_exclusion(spark):
    root = shared_work_dir(spark, "json")
    for day in ("01", "02"):
        spark.createDataFrame([(f"m{day}",)], "metric_name string").write.option("compression", "gzip").json(f"{root}/2022/02/{day}/deep")
    all_days = readers.read_metric_json(spark, root)
    assert all_days.count() == 2 and all_days.schema == METRIC_SCHEMA
    assert [r["metric_name"] for r in readers.read_metric_json(spark, root, exclude=["2022/02/01/**"]).collect()] == ["m02"]
    assert readers.read_metric_json(spark, [f"{root}/2022/02/02"]).count() == 1


def _land(spark, root, name, stamp, value):
    text = f'{{"metric_stream_name":"s","account_id":"a","region":"r","namespace":"AWS/S3","metric_name":"{name}","dimensions":{{"BucketName":"b"}},"timestamp":{stamp},"value":{{"min":1,"max":2,"sum":{value},"count":1}},"unit":"U"}}'
    spark.createDataFrame([(text,)], "value string").write.mode("append").text(root)


def test_stream_reads_each_file_once_and_refreshes_touched_days(spark):
    landed, table = shared_work_dir(spark, "landed"), shared_work_dir(spark, "metrics")
    usage, runs = shared_work_dir(spark, "usage"), [shared_work_dir(spark, "run") for _ in range(2)]
    bridge = spark.createDataFrame(
        [("b", "a", "t")], "line_item_resource_id string, line_item_usage_account_id string, tag_dim_id string"
    ).withColumn("line_item_usage_start_date", F.lit("2024-01-01").cast("timestamp"))

    def run():
        ingest.ingest_metrics(ingest.metric_stream(spark, landed), table, runs[0]).awaitTermination()
        stream = spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)
        ingest.refresh_usage(stream, table, U.S3, bridge, usage, runs[1]).awaitTermination()
        return rows(spark.read.parquet(usage).select("date_dim_id", "get_requests", "put_requests"))

    first, second = 1704423600000, 1704510000000  # 5 and 6 January 2024, 03:00
    for stamp in (first, second):
        _land(spark, landed, "GetRequests", stamp, 1)
        _land(spark, landed, "PutRequests", stamp, 2)
    assert run() == [("20240105", 1.0, 2.0), ("20240106", 1.0, 2.0)]
    assert run() == [("20240105", 1.0, 2.0), ("20240106", 1.0, 2.0)]
    _land(spark, landed, "GetRequests", first + 60_000, 10)  # late, for the first day
    assert run() == [("20240105", 11.0, 2.0), ("20240106", 1.0, 2.0)]
    assert spark.read.parquet(table).count() == 5
    hours = spark.read.parquet(table).select("namespace", "year", "month", "day", "hour").distinct()
    assert rows(hours) == [("AWSS3", 2024, 1, 5, 3), ("AWSS3", 2024, 1, 6, 3)]


def test_reports_prune_the_stored_fact(spark, sf):
    star = I.stored_star(spark, sf)
    days = P.day_ids(dt.date(1998, 4, 1), dt.date(1998, 4, 15))
    month = {"account": "A3", "year": "1998", "month": "04"}
    reports = {
        "r02": P.by_account_day_service(star, service="s", account_name="NATION_3", days=days),
        "r03": P.by_account_day_service(star, service="s", account_name="NATION_3", day_prefix="199804"),
        "r04": P.by_day_and_tag(star, "resource_tags_user_squad", **month),
        "r05": P.by_month_and_service(star, year="1998", month="03"),
        "r06": P.by_account_day(star, days=days),
        "r07": P.by_account_and_service(star, service="s", account_name="NATION_3", days=days),
        "r08": P.account_total(star, day_prefix="199804"),
        "r09": P.by_service_and_charge(star, service_prefix="A", day_prefix="1998"),
        "r11": P.by_purchase_option(star, not_service="s", **month),
        "r12": P.purchase_option_total(star, option="OnDemand", **month),
        "r13": P.period_total(star, days=days, payer="P3", **month),
    }
    for name, df in reports.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*usage_month", plan), name


def test_an_account_with_two_payers_counts_once(spark, sf):
    star = build_star(I.two_sources(spark, sf), I.account_directories(spark, sf))
    other = star.account.withColumn("bill_payer_account_id", F.lit("P-other"))
    twice = dataclasses.replace(star, account=star.account.unionByName(other))
    assert_close(P.by_account(twice), P.by_account(star))
    total = {"account": "A3", "year": "1998", "month": "04", "days": P.day_ids(dt.date(1998, 4, 1), dt.date(1998, 4, 30))}
    assert_close(P.period_total(twice, payer="P-other", **total), P.period_total(star, **total))


def test_a_recomputed_day_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "days")
    frame = spark.createDataFrame([(1, 2024, 1, 1), (2, 2024, 1, 2)], "v int, year int, month int, day int")
    keys = ["year", "month", "day"]
    writers.overwrite_partitions(frame, path, keys)
    days = writers.day_partitions([dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    for _ in range(2):
        writers.overwrite_partitions(frame.where("day = 1").withColumn("v", F.lit(5)), path, keys, expected=days)
        assert rows(spark.read.parquet(path)) == [(5, 2024, 1, 1)]


def test_fact_rows_travel_with_the_product_key_alone(spark, sf):
    fact = cost_fact([fact_lines(I.billing_lines(spark, sf))], tag_cols=I.TAGS_ONE)
    text = fact._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "hashpartitioning" in line and "charge_type" in line]
    assert exchanges and all("aws_product_dim_id" in line and "servicename" not in line for line in exchanges), text


def test_tasks_are_bounded_by_rows(spark, sf, monkeypatch):
    lines = I.table(spark, sf, "lineitem")
    monkeypatch.setattr(I, "TASK_ROWS", 100)
    dealt = I.spread_out(lines, "l_orderkey")
    assert dealt.rdd.getNumPartitions() == -(-lines.count() // 100) and dealt.count() == lines.count()


def test_coarse_lines_meet_in_groups(spark, sf):
    lines = I.coarse_lines(spark, sf).cache()
    n = lines.count()
    fact = cost_fact([fact_lines(lines)], tag_cols=I.TAGS_ONE)
    assert 2 * fact.count() <= n
    assert totals(fact, *FACT_MEASURES) == totals(fact_lines(lines), *FACT_MEASURES)
    counted = summary(lines, months=None, resource_count="exact")
    assert 4 * counted.count() <= 3 * n and counted.where("resource_id_count > 1").count() > 0
    assert lines.where("hour(line_item_usage_start_date) > 0").count() > 0
    payers = lines.groupBy("line_item_usage_account_id").agg(F.count_distinct("bill_payer_account_id").alias("n"))
    assert payers.where("n > 1").count() > 0


def test_dealt_lines_are_added_up_without_moving(spark, sf):
    lines = I.billing_lines(spark, sf, I.GRAIN)
    plain = I.billing_lines(spark, sf)
    for build in (
        lambda rows: summary(rows, months=None, resource_count="exact"),
        lambda rows: cost_fact([fact_lines(rows)], tag_cols=I.TAGS_ONE),
    ):
        text = build(lines)._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in text.splitlines() if "hashpartitioning" in line and "year#" in line]
        assert not moved, text
        assert build(lines).count() == build(plain).count()


def test_customers_join_orders_before_lines(spark, sf):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = I.billing_lines(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert text.index("hashpartitioning(o_orderkey") < text.index("hashpartitioning(o_custkey"), text


def test_lines_dealt_by_month_are_written_without_moving(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "MONTH_PART_LINES", 2000)
    lines, path = I.billing_lines(spark, sf, by_month=True).select("l_orderkey", "l_linenumber", "year", "month"), str(tmp_path / "lines")
    writers.overwrite_partitions(lines, path, ["year", "month"], dealt=True)
    stored = spark.read.parquet(path)
    files = stored.withColumn("file", F.input_file_name()).groupBy("year", "month").agg(F.count_distinct("file").alias("files"))
    assert files.agg(F.max("files")).first()[0] <= -(-lines.count() // 2000)
    assert stored.exceptAll(lines.select(stored.columns)).isEmpty() and stored.count() == lines.count()


def test_stored_steps_give_their_shuffle_files_back(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = disk.getAllFiles().size()
    frame = spark.range(1000).groupBy((F.col("id") % 100).alias("year")).agg(F.sum("id").alias("v"))
    writers.overwrite_partitions(frame, str(tmp_path / "sums"), ["year"])
    assert disk.getAllFiles().size() <= before
    assert spark.read.parquet(str(tmp_path / "sums")).count() == 100


def test_summaries_dealt_by_month_are_added_up_without_moving(spark, sf):
    source = I.two_sources(spark, sf, I.MONTH_GRAIN)[0]
    rows = summary(source.lines, months=None, resource_count="sketch")
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in text.splitlines() if "hashpartitioning" in line and "year#" in line], text


def test_dimensions_need_their_columns_alone(spark, sf, tmp_path):
    sources = I.two_sources(spark, sf)
    narrow = [dataclasses.replace(s, lines=s.lines.select(*jobs.dimension_columns(s.lines))) for s in sources]
    assert len(narrow[0].lines.columns) < 20
    jobs.dimension_jobs(spark, narrow, I.account_directories(spark, sf), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/product").count() == hashed_dim(source_fact_lines(sources, []), PRODUCT_COLUMNS, PRODUCT_KEY).count()


def test_stored_fact_moves_once_for_sums_and_write(spark, sf, tmp_path, monkeypatch):
    sources = I.two_sources(spark, sf, I.GRAIN)
    tags = tag_columns(*[s.lines for s in sources])
    lines = source_fact_lines(sources, tags)
    base = materialize(star_base(lines, tag_cols=tags), "star-base")
    text = fact_of_base(base, tags)._jdf.queryExecution().executedPlan().toString()
    moved = [re.sub(r"#\d+", "", line) for line in text.splitlines() if "hashpartitioning" in line]
    assert len(moved) == 1 and "hashpartitioning(year, month, charge_type," in moved[0], text

    def spread(df, columns):
        raise AssertionError("rows are moved for the write")

    monkeypatch.setattr(writers, "spread", spread)
    star = load_star(sources, I.account_directories(spark, sf), str(tmp_path))
    plain = cost_fact(lines, tag_cols=tags)
    assert_close(star.fact.select(*plain.columns), plain)


@pytest.mark.parametrize("name", ["partition_overwrite", "overwrite_with_empty_day", "reconcile_by_checksums"])
def test_facts_are_written_where_they_lie(spark, sf, monkeypatch, name):
    def spread(df, columns):
        raise AssertionError("rows are moved for the write")

    monkeypatch.setattr(writers, "spread", spread)
    assert QUERIES[name](spark, sf).count() > 0 or name == "reconcile_by_checksums"  # which finds nothing here


def test_nations_join_rows_that_move_no_more(spark, sf):
    lines = I.billing_lines(spark, sf, I.GRAIN)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: re.search(r"\w", line).start()
    at = next(i for i, line in enumerate(lines) if "hashpartitioning(year(" in line)
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    assert end > at + 1 and not any("n_name" in line for line in lines[at:end])


def test_small_writes_into_many_folders_use_all_cores(spark, tmp_path):
    setting = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(setting)
    frame = spark.range(20000).select(F.col("id"), (F.col("id") % 64).alias("k"))
    writers.overwrite_partitions(frame, str(tmp_path / "out"), ["k"])
    files = [f.name for f in (tmp_path / "out").glob("k=*/part-*.parquet")]
    assert len(files) == 64 and len({name.split("-")[1] for name in files}) > 1
    assert spark.conf.get(setting) == before and spark.read.parquet(str(tmp_path / "out")).count() == 20000
