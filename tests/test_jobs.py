"""The batch jobs end to end, run twice."""

import datetime as dt

from pyspark.sql import functions as F

from frames import rows
from registry import inputs as I
from tallyfold.functions.calendar import business_date
from tallyfold.operators import usage as U
from tallyfold.plans import jobs
from tallyfold.session import shared_work_dir


def test_jobs_can_be_repeated(spark, sf):
    root = shared_work_dir(spark, "jobs")
    sources, names = I.two_sources(spark, sf), I.account_directories(spark, sf)
    read = lambda name: spark.read.parquet(f"{root}/{name}")

    jobs.dimension_jobs(spark, sources, names, root)
    sizes = {n: read(n).count() for n in ("account", "tag", "product", "date")}
    jobs.dimension_jobs(spark, sources, names, root, mode="delta", period=(1998, 4))
    assert sizes == {n: read(n).count() for n in sizes}

    jobs.cost_fact_job(sources, f"{root}/fact")
    before = read("fact").agg(F.count("*"), F.round(F.sum("amortized_cost"), 2)).first()
    jobs.cost_fact_job(sources, f"{root}/fact", period=(1998, 4))
    assert read("fact").agg(F.count("*"), F.round(F.sum("amortized_cost"), 2)).first() == before
    assert read("fact").where("year = 1998 and month = 4").count() > 0

    jobs.summary_job(sources[0], f"{root}/summary", as_of=I.AS_OF)
    assert read("summary").select("year").distinct().count() == 1

    jobs.data_transfer_job(sources[0], f"{root}/transfer")
    stage = read("transfer").where("year = 2000").withColumn("DT_cost", F.col("DT_cost") + 1)
    total = read("transfer").count()
    jobs.load_data_transfer(spark, stage.select(*read("transfer").columns), f"{root}/transfer")
    assert read("transfer").count() == total

    ties = [F.col(c) for c in I.TIE_BREAK]
    jobs.tag_bridge_job(sources[0], f"{root}/bridge", tie_break=ties)
    metrics = I.metric_records(spark, sf, U.S3)
    for days in (None, [dt.date(2024, 1, d) for d in (3, 4)]):
        jobs.usage_job(metrics, U.S3, read("bridge"), f"{root}/usage", days=days)
    whole = U.daily_usage(metrics, U.S3, read("bridge"))
    assert rows(read("usage").select("resource", "date_dim_id")) == rows(whole.select("resource", "date_dim_id"))
    jobs.load_usage(spark, whole.where("day = 3"), f"{root}/usage")
    assert read("usage").count() == whole.count()


def test_sums_lie_by_month_after_one_shuffle(spark):
    from tallyfold.operators.cost_fact import cost_fact, fact_lines
    from tallyfold.operators.summary import summary
    from tallyfold.session import materialize

    sf = "/root/testdata/sf0.01"
    for lines, fine in ((I.billing_lines(spark, sf), True), (I.coarse_lines(spark, sf), False)):
        lines = materialize(lines, "lines")
        of = {
            "summary": lambda by_month, lines=lines: summary(lines, months=None, by_month=by_month),
            "fact": lambda by_month, lines=lines: cost_fact([fact_lines(lines)], tag_cols=I.TAGS_ONE, by_month=by_month),
        }
        for build in of.values():
            plain, found = build(False), build(True)
            assert found.columns == plain.columns
            rounded = [F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
            assert rows(found.select(*rounded)) == rows(plain.select(*rounded))
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert ("RepartitionByExpression" in plan) == fine and ("RebalancePartitions" in plan) != fine
            shuffles = found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
            assert shuffles == (1 if fine else 2)


def test_business_date_is_ahead_of_utc_or_equal(spark):
    row = spark.range(1).select(
        business_date().alias("today"), business_date(days_back=1).alias("yesterday"), F.current_date().alias("utc")
    ).first()
    assert row["today"] - row["yesterday"] == dt.timedelta(days=1)
    assert row["today"] - row["utc"] in (dt.timedelta(0), dt.timedelta(days=1))


def test_a_local_session_without_a_shared_folder(spark, sf, monkeypatch):
    from registry.queries import QUERIES
    from tallyfold import session

    conf, get = type(spark.conf), type(spark.conf).get
    unset = lambda self, key, *default: default[0] if key == "spark.checkpoint.dir" else get(self, key, *default)
    monkeypatch.setattr(conf, "get", unset)
    first, second = session.shared_work_dir(spark, "a"), session.shared_work_dir(spark, "b")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] and first != second
    assert QUERIES["upsert_transfer"](spark, sf).count() > 0
