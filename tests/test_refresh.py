"""Tables kept current: replays, quarantine, bookmarks, merged state, bucketed targets."""

import dataclasses
import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from frames import assert_close, rows
from registry import inputs as I
from tallyfold.functions.keys import tag_columns
from tallyfold.operators import usage as U
from tallyfold.operators.cost_fact import star_base
from tallyfold.operators.latest import latest_tags
from tallyfold.operators.percentiles import exact_percentiles
from tallyfold.operators.summary import resource_counts, summary
from tallyfold.plans import jobs
from tallyfold.plans.checksums import day_checksums, differing_days, reconcile_days
from tallyfold.plans.star import load_star, source_fact_lines
from tallyfold.session import shared_work_dir
from tallyfold.sources import readers, writers
from tallyfold.sources.bookmarks import Bookmark, with_partitions
from tallyfold.sources.bucketed import BucketedTable
from tallyfold.streaming import ingest
from tallyfold.streaming.bridge import read_bridge, refresh_bridge
from tallyfold.streaming.late_records import changes_path, refresh_by_changes, write_with_changes

NOON = 1704456000000  # 5 January 2024, 12:00


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def record(name, stamp, total, account="a", namespace="AWS/S3"):
    text = lambda v: "null" if v is None else f'"{v}"' if isinstance(v, str) else str(v)
    return (
        f'{{"metric_stream_name":"s","account_id":"{account}","region":"r","namespace":{text(namespace)},'
        f'"metric_name":"{name}","dimensions":{{"BucketName":"b"}},"timestamp":{text(stamp)},'
        f'"value":{{"min":1,"max":2,"sum":{text(total)},"count":1}},"unit":"U"}}'
    )


def land(spark, folder, *records):
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.mode("append").text(folder)


def metric_rows(spark, *records):
    folder = shared_work_dir(spark, "landed")
    land(spark, folder, *records)
    return U.normalize_metrics(readers.read_metric_json(spark, folder))


def sums(df):
    return rows(df.select("metric_name", "timestamp", "value.sum"))


def test_a_record_counts_once_whoever_brings_it(spark):
    table = shared_work_dir(spark, "metrics")
    both = [record("Get", NOON, 1), record("Get", NOON + 60_000, 2)]
    writers.write_metrics(metric_rows(spark, *both, both[0]), table, batch="s-00000000", generation=0)
    assert sums(readers.read_metric_table(spark, table)) == [("Get", NOON, 1.0), ("Get", NOON + 60_000, 2.0)]
    # A later batch brings one of them again, corrected, and a record of another hour.
    later = metric_rows(spark, record("Get", NOON, 5), record("Get", NOON + 3_600_000, 7))
    writers.write_metrics(later, table, batch="s-00000001", generation=1)
    expected = [("Get", NOON, 5.0), ("Get", NOON + 60_000, 2.0), ("Get", NOON + 3_600_000, 7.0)]
    assert sums(readers.read_metric_table(spark, table)) == expected
    # An older generation changes nothing; a replay beats every batch, and may be repeated.
    writers.write_metrics(metric_rows(spark, record("Get", NOON, 9)), table, batch="old", generation=-1)
    assert sums(readers.read_metric_table(spark, table)) == expected
    for _ in range(2):
        writers.write_metrics(metric_rows(spark, record("Get", NOON, 6)), table)
    day = readers.read_metrics(spark, table, "AWSS3", 2024, 1, 5)
    assert sums(day) == [("Get", NOON, 6.0), *expected[1:]]
    assert "generation" not in day.columns and "batch" not in day.columns


def test_records_of_one_millisecond_are_told_apart_by_their_ids(spark):
    table = shared_work_dir(spark, "metrics")
    sent = lambda i, total: record("Get", NOON, total)[:-1] + f',"record_id":"{i}"}}'
    # Equal in all but the id; one of them is delivered twice.
    write_with_changes(metric_rows(spark, sent(1, 5), sent(2, 5), sent(2, 5)), table, "a", 0)
    assert sums(readers.read_metric_table(spark, table)) == [("Get", NOON, 5.0)] * 2
    # A later batch brings one of them again, corrected, and a third.
    write_with_changes(metric_rows(spark, sent(2, 7), sent(3, 5)), table, "b", 1)
    assert sums(readers.read_metric_table(spark, table)) == [("Get", NOON, 5.0), ("Get", NOON, 5.0), ("Get", NOON, 7.0)]
    changes = spark.read.parquet(changes_path(table)).where("batch = 'b'")
    assert rows(changes.select("record_id", "value.sum", "sign")) == [("2", 5.0, -1), ("2", 7.0, 1), ("3", 5.0, 1)]


def test_null_fields_tell_records_apart_like_others(spark):
    table = shared_work_dir(spark, "metrics")
    one = metric_rows(spark, record("Get", NOON, 1)).withColumn("unit", F.lit(None).cast("string"))
    writers.write_metrics(one.unionByName(one), table, batch="a", generation=0)
    writers.write_metrics(one, table, batch="b", generation=1)
    assert readers.read_metric_table(spark, table).count() == 1


def test_misfits_go_to_quarantine_and_are_counted(spark):
    landed, table = shared_work_dir(spark, "landed"), shared_work_dir(spark, "metrics")
    run, counts = shared_work_dir(spark, "run"), []
    land(
        spark, landed, record("Get", NOON, 1), record("Get", NOON, "n/a", account="b"), record("Get", "n/a", 2),
        record("Get", None, 3), record("Get", NOON, 4, namespace=None), record("Get", str(NOON), "5", account="c"),
    )
    for _ in range(2):  # a second run finds nothing
        ingest.ingest_metrics(ingest.metric_stream(spark, landed), table, run, seen=counts.append).awaitTermination()
    assert [(c["records"], c["quarantined"]) for c in counts] == [(6, 4)]
    stored = readers.read_metric_table(spark, table)
    assert rows(stored.select("account_id", "value.sum")) == [("a", 1.0), ("c", 5.0)]
    assert stored.where("year IS NULL OR namespace IS NULL").count() == 0
    kept = ingest.read_quarantine(spark, table)
    sent = kept.select("misfits.`value.sum`.string", "misfits.timestamp.string", "value.sum")
    assert rows(sent) == sorted([("n/a", None, None), (None, "n/a", 2.0), (None, None, 3.0), (None, None, 4.0)], key=repr)


def test_named_folders_are_all_that_is_listed(spark):
    table = shared_work_dir(spark, "metrics")
    hours = [record("Get", NOON + h * 3_600_000, h) for h in range(60)]
    writers.write_metrics(metric_rows(spark, *hours), table)
    found = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = found.getCount()
    day = readers.read_metrics(spark, table, "AWSS3", 2024, 1, 6)
    assert day.count() == 24 and found.getCount() - before == 24
    assert {"namespace", "year", "month", "day", "hour"} <= set(day.columns)
    assert readers.read_metrics(spark, table, "AWSS3", 2024, 2, 1).count() == 0
    assert readers.read_metrics(spark, table, "absent", 2024, 1, 6).count() == 0


def test_folders_with_special_names(spark):
    path = shared_work_dir(spark, "odd")
    names = ["a b", "x=y", "50%", "[z]*", "q:1"]
    spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, v int").write.partitionBy("name").parquet(path)
    for i, name in enumerate(names):
        assert rows(readers.read_partitioned(spark, path, name=name).select("v")) == [(i,)], name


LINE = "line_item_resource_id string, line_item_usage_start_date timestamp, line_item_usage_account_id string, resource_tags_user_x string, year int, month int, n int"


def test_bridge_merges_batches_without_reading_old_lines(spark):
    moment = lambda month, day: dt.datetime(2022, month, day)
    batches = [
        [("arn:x/i-1", moment(2, 1), "a", "tie", 2022, 2, 2), ("arn:x/i-2", moment(1, 5), "b", None, 2022, 1, 1), (None, moment(1, 6), "b", "none", 2022, 1, 1)],
        # Older than what is stored, equal but first by the tie-break, and new.
        [("arn:x/i-2", moment(1, 1), "b", "old", 2022, 1, 1), ("arn:x/i-1", moment(2, 1), "a", "new", 2022, 2, 1), ("arn:x/i-3", moment(3, 1), "a", "x", 2022, 3, 1)],
        [("arn:x/i-1", moment(2, 1), "a", "new", 2022, 2, 1)],  # sent again
    ]
    landed, state, run = (shared_work_dir(spark, name) for name in ("lines", "state", "run"))
    tags, seen = ["resource_tags_user_x"], []
    for number, batch in enumerate(batches, 1):
        spark.createDataFrame(batch, LINE).coalesce(1).write.mode("append").parquet(landed)
        lines = spark.readStream.schema(LINE).parquet(landed)
        query = refresh_bridge(lines, tags, state, run, tie_break=[F.col("n")])
        query.awaitTermination()
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))
        sent = spark.createDataFrame([row for part in batches[:number] for row in part], LINE)
        assert rows(read_bridge(spark, state, tags)) == rows(latest_tags(sent, tags, tie_break=[F.col("n")]))
    assert seen == [len(b) for b in batches]
    january = read_bridge(spark, state, tags, period=(2022, 1))
    assert rows(january.select("line_item_resource_id")) == [("",), ("i-2",)]


def _modified(path):
    return {p: os.path.getmtime(os.path.join(path, p)) for p in _folders(path)}


def _folders(path):
    return [os.path.relpath(d, path) for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)]


def test_only_months_with_changed_files_are_done_again(spark):
    source, mark, out = (shared_work_dir(spark, name) for name in ("source", "mark", "out"))
    table = spark.createDataFrame([(2022, m, m) for m in (1, 2, 3)], "year int, month int, v int")
    writers.overwrite_partitions(table, source, ["year", "month"])
    done = []

    def run(months):
        done.append([m["month"] for m in months])
        chosen = with_partitions(spark.read.parquet(source), months)
        writers.overwrite_partitions(chosen, out, ["year", "month"], expected=months)

    def go():
        bookmark = Bookmark(spark, source, mark)
        months = bookmark.changed()
        if months:
            run(months)
        bookmark.commit()

    go()
    first = _modified(out)
    go()
    writers.overwrite_partitions(table.where("month = 2").withColumn("v", F.lit(20)), source, ["year", "month"])
    go()
    assert done == [[1, 2, 3], [2]]
    second = _modified(out)
    assert {p for p in second if second[p] != first[p]} == {"year=2022/month=2"}
    assert rows(spark.read.parquet(out).select("v")) == [(1,), (20,), (3,)]
    # A month whose files are gone is done again too, and loses its rows.
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/year=2022/month=3")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    go()
    assert done[-1] == [3] and rows(spark.read.parquet(out).select("v")) == [(1,), (20,)]


def test_a_job_that_fails_is_done_again(spark):
    source, mark = shared_work_dir(spark, "source"), shared_work_dir(spark, "mark")
    writers.overwrite_partitions(spark.createDataFrame([(2022, 1)], "year int, month int").withColumn("v", F.lit(1)), source, ["year", "month"])
    assert Bookmark(spark, source, mark).changed() == Bookmark(spark, source, mark).changed() == [{"year": 2022, "month": 1}]
    with pytest.raises(RuntimeError):
        Bookmark(spark, source, mark).commit()


def test_star_reads_each_source_once_and_a_period_holds_for_all_tables(spark, sf):
    sources = I.two_sources(spark, sf)
    tags = tag_columns(*[s.lines for s in sources])
    base = star_base(source_fact_lines(sources, tags), tag_cols=tags)
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem", plan(base))) == len(sources)
    month = load_star(sources, I.account_directories(spark, sf), shared_work_dir(spark, "star"), period=(1998, 4))
    whole = I.stored_star(spark, sf)
    assert_close(month.fact.drop("usage_month"), whole.fact.where("year = 1998 AND month = 4").drop("usage_month"))
    for table, key in (("tag", "tag_dim_id"), ("product", "aws_product_dim_id"), ("account", "aws_account_dim_id")):
        known, used = getattr(month, table).select(key).distinct(), month.fact.select(key).distinct()
        assert rows(known) == rows(used), table
    assert month.date.count() < whole.date.count()


def test_sketches_add_up_over_days_and_sources(spark, sf):
    lines = I.billing_lines(spark, sf)
    halves = [lines.where(F.col("l_linenumber") % 2 == i) for i in range(2)]
    stored = [summary(half, months=None, resource_count="sketch") for half in halves]
    estimate = resource_counts(stored, ["year"]).collect()
    exact = {r[0]: r[1] for r in lines.groupBy("year").agg(F.count_distinct("line_item_resource_id")).collect()}
    for row in estimate:
        assert abs(row[1] - exact[row[0]]) <= 1 + 0.08 * exact[row[0]]
    # Adding the halves' estimates up would count resources of both twice.
    apart = [{r[0]: r[1] for r in resource_counts([part], ["year"]).collect()} for part in stored]
    assert any(apart[0][y] + apart[1][y] > 1.2 * exact[y] for y in exact)


def test_bucketed_target_is_not_shuffled(spark):
    root = shared_work_dir(spark, "bucketed")
    table = BucketedTable("target_" + root[-12:], ("k",), 4, root, ("day",))
    target = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("day"), F.lit("old").alias("v"))
    table.create(target)
    stage = spark.range(990, 1010).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("day"), F.lit("new").alias("v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = table.kept(stage)
        kept.collect()
        text = plan(kept)
        final = text.split("== Initial Plan ==")[0]
        target_side = final[final.index("SortMergeJoin") : final.index("FileScan")]
        assert "Bucketed: true" in final and "Exchange" not in target_side, text
        for _ in range(2):
            table.upsert(stage)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    found = {(r["k"], r["day"]): r["v"] for r in table.read(spark).collect()}
    # Day 1 loses its old rows of the staged keys; other days keep theirs.
    assert all(found[k, 1] == "new" for k in range(990, 1010)) and found[991, 1] == "new"
    assert found[990, 0] == "old" and found[1, 1] == "old" and len(found) == 1000 + 20 - 3
    assert table.missing(stage.withColumn("k", F.col("k") + 15)).count() == 15


def test_bucketed_upsert_keeps_other_partitions_in_any_session(spark):
    root, mode = shared_work_dir(spark, "bucketed"), "spark.sql.sources.partitionOverwriteMode"
    table = BucketedTable("target_" + root[-12:], ("k",), 2, root, ("day",))
    rows_of = lambda *ids: spark.createDataFrame([(i, i % 3, f"v{i}") for i in ids], "k long, day long, v string")
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")  # Spark's default
    try:
        table.create(rows_of(0, 1, 2))
        table.upsert(rows_of(4))
        assert spark.conf.get(mode) == "static"
    finally:
        spark.conf.set(mode, before)
    assert rows(table.read(spark).select("k")) == [(0,), (1,), (2,), (4,)]


def test_checksums_name_the_days_that_differ(spark, sf):
    root, first = shared_work_dir(spark, "facts"), I.stored_star(spark, sf).fact
    some = first.where("date_dim_id LIKE '199804%'").select("date_dim_id").distinct().orderBy("date_dim_id").first()[0]
    # The sums agree; the rows do not.
    one = F.when(F.col("date_dim_id") == some, F.lit("moved")).otherwise(F.col("charge_type"))
    second = first.withColumn("charge_type", one)
    days = differing_days(day_checksums(first), day_checksums(second))
    assert [d["date_dim_id"] for d in days] == [some]
    assert differing_days(day_checksums(first), day_checksums(first)) == []
    compared = reconcile_days(first, second, days, ["date_dim_id", "charge_type"], "amortized_cost")
    assert re.search(r"PartitionFilters: \[[^\]]*usage_month", plan(compared))
    assert "PushedFilters: [In(date_dim_id" in plan(compared) or "EqualTo(date_dim_id" in plan(compared)
    gone = differing_days(day_checksums(first), day_checksums(first.where(F.col("date_dim_id") != some)))
    assert [d["date_dim_id"] for d in gone] == [some]
    assert root


def test_percentiles_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, v double")
    found = {r["k"]: r["percentiles"] for r in exact_percentiles(df, ["k"], "v", [0.5]).collect()}
    assert found == {None: [2.0], "a": [2.0]}


def test_changed_months_refresh_fact_summary_and_dimensions(spark, sf):
    root, stored = shared_work_dir(spark, "root"), shared_work_dir(spark, "lines")
    lines = I.billing_lines(spark, sf).where("year = 1998 AND month <= 2")
    writers.overwrite_partitions(lines, stored, ["year", "month"])
    source = [dataclasses.replace(jobs.StoredSource(stored))]
    names = I.account_directories(spark, sf)
    assert [m["month"] for m in jobs.refresh_changed_months(spark, source, root, directories=names)] == [1, 2]
    before = _modified(f"{root}/fact")
    changed = lines.where("month = 2").withColumn("resource_tags_user_squad", F.lit("new squad"))
    writers.overwrite_partitions(changed, stored, ["year", "month"])
    assert [m["month"] for m in jobs.refresh_changed_months(spark, source, root, directories=names)] == [2]
    after = _modified(f"{root}/fact")
    assert {p for p in after if after[p] != before[p]} == {"year=1998/month=2"}
    assert spark.read.parquet(f"{root}/tag").where("resource_tags_user_squad = 'new squad'").count() > 0
    assert spark.read.parquet(f"{root}/summary-0").where("resource_tags_user_squad = 'new squad'").select("month").distinct().count() == 1
    assert jobs.refresh_changed_months(spark, source, root, directories=names) == []


SPEC = U.MetricSpec(
    "s3", "AWSS3", "BucketName",
    (
        U.Measure("total", "Get", "sum"), U.Measure("mean", "Get", "avg"), U.Measure("most", "Put", "max"),
        U.Measure("p90", "Get", "percentile", p=0.9), U.Measure("busiest", "Get", "max_hourly_percentile", p=0.5),
    ),
)
HOUR = 3_600_000


def test_counts_take_up_late_corrected_and_repeated_records(spark):
    table, state, usage, run = (shared_work_dir(spark, n) for n in ("metrics", "counts", "usage", "run"))
    bridge = spark.createDataFrame(
        [("b", "a", "t"), ("b", "c", "t")], "line_item_resource_id string, line_item_usage_account_id string, tag_dim_id string"
    ).withColumn("line_item_usage_start_date", F.lit("2024-01-01").cast("timestamp"))
    first = [record("Get", NOON + i * 60_000, float(i % 4)) for i in range(12)] + [record("Put", NOON, 3)]
    first += [record("Get", NOON + 24 * HOUR, 5), record("Put", NOON + 24 * HOUR, 6)]
    batches = [
        first,
        # Late: another hour of the first day, and an hour that is known.
        [record("Get", NOON + HOUR + i, 10.0 * i) for i in range(5)] + [record("Get", NOON + 59 * 60_000, 100)],
        # The same again with one corrected, and the only record of a metric withdrawn to null.
        [record("Get", NOON, 50), first[1], record("Put", NOON + 24 * HOUR, None)],
    ]
    for number, sent in enumerate(batches):
        for _ in range(2 if number == 1 else 1):  # a batch written twice
            write_with_changes(metric_rows(spark, *sent), table, f"b-{number}", number)
        stream = spark.readStream.schema(spark.read.parquet(changes_path(table)).schema).parquet(changes_path(table))
        refresh_by_changes(stream, SPEC, bridge, state, usage, run).awaitTermination()
        whole = U.daily_usage(readers.read_metric_table(spark, table), SPEC, bridge)
        columns = sorted(whole.columns)
        assert_close(spark.read.parquet(usage).select(*columns), whole.select(*columns))
    # The changes of the last batch are two corrections; what came again unchanged cancels out.
    changes = spark.read.parquet(changes_path(table)).where("batch = 'b-2'")
    assert changes.groupBy("metric_name", "timestamp", "value").agg(F.sum("sign").alias("n")).where("n <> 0").count() == 4
    # A batch that the counts include already is not added again.
    again = shared_work_dir(spark, "run")
    stream = spark.readStream.schema(spark.read.parquet(changes_path(table)).schema).parquet(changes_path(table))
    before = rows(spark.read.parquet(usage))
    refresh_by_changes(stream, SPEC, bridge, state, usage, again).awaitTermination()
    assert rows(spark.read.parquet(usage)) == before
