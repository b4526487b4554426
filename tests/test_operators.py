"""Keys, dimensions, latest rows, percentiles, upsert and reshaping."""

import datetime as dt
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import rows
from tallyfold.functions.calendar import in_lookback, in_time_range, reporting_period
from tallyfold.functions.keys import surrogate_key, tag_columns
from tallyfold.functions.text import last_segment
from tallyfold.operators import commitments as C
from tallyfold.operators.dimensions import account_dim, date_dim, date_dim_add, hashed_dim
from tallyfold.operators.latest import current_tag_map, latest_per, latest_tags
from tallyfold.operators.percentiles import exact_percentiles, percentile_array
from tallyfold.operators.reshape import apply_mapping, choice_struct, drop_null_columns, flatten
from tallyfold.operators.upsert import upsert
from tallyfold.session import materialize


def test_surrogate_key_sorts_names_and_fills_nulls(spark):
    df = spark.createDataFrame([("y", None, "x")], "b string, c string, a string")
    expected = hashlib.sha256("x||y||".encode()).hexdigest()
    assert df.select(surrogate_key(["b", "c", "a"])).first()[0] == expected
    filled = df.na.fill("")
    assert filled.select(surrogate_key(["c", "a", "b"])).first()[0] == expected


def test_fact_and_dimension_keys_agree_across_sources(spark):
    one = spark.createDataFrame([("s", None), ("s", "")], "resource_tags_user_squad string, resource_tags_user_name string")
    two = spark.createDataFrame([("s", "")], "resource_tags_user_squad string, resource_tags_user_owner string")
    tags = tag_columns(one, two)
    dim = hashed_dim([one, two], tags, "tag_dim_id")
    assert dim.count() == 1 and dim.columns == [*tags, "tag_dim_id"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("a/b:c", "c"), ("a:b/c", "c"), ("plain", "plain"), ("end/", ""), ("", ""), (None, None), ("arn:aws:x:y/z\nw", "z\nw")],
)
def test_last_segment(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(last_segment(F.col("t"))).first()[0] == expected


def test_lookback_starts_at_a_month(spark):
    data = [(2021, 9, "2021-09-01"), (2021, 8, "2021-08-31"), (2021, 8, "2021-09-01"), (2021, 9, "2021-08-31")]
    df = spark.createDataFrame(data, "year int, month int, d string")
    df = df.withColumn("bill_billing_period_start_date", F.col("d").cast("timestamp"))
    assert rows(df.where(in_lookback("2022-04-15", 7)).select("d")) == [("2021-09-01",)]


def test_time_range_is_open(spark):
    df = spark.createDataFrame([(f"2024-01-15 {h:02d}:00:00",) for h in range(13)], "t string")
    stamp = F.col("t").cast("timestamp")
    kept = df.where(in_time_range(stamp, "2024-01-15 12:00:00", older_than_hours=6, newer_than_hours=12)).count()
    assert kept == 5


def test_reporting_period():
    day = dt.date(2024, 2, 29)
    assert reporting_period(day) == (dt.date(2024, 2, 28), day)
    assert reporting_period(day, history=True) == (dt.date(2023, 2, 28), day)


def test_date_dim_has_one_day_more(spark):
    lines = spark.createDataFrame([("2022-02-27 10:00:00",), ("2022-03-01 01:00:00",)], "t string").select(
        F.col("t").cast("timestamp").alias("line_item_usage_start_date")
    )
    dim = date_dim(lines)
    assert [r[0] for r in rows(dim)] == ["20220227", "20220228", "20220301", "20220302"]
    assert rows(dim)[0] == ("20220227", "27", "02", "2022")
    assert date_dim_add(dim, F.lit("2022-03-02")).count() == 0
    assert rows(date_dim_add(dim, F.lit("2022-04-05"))) == [("20220405", "05", "04", "2022")]
    assert date_dim(lines.limit(0)).count() == 0


def _accounts(spark):
    schema = "bill_payer_account_id string, line_item_usage_account_id string, year int, month int"
    one = spark.createDataFrame([("p", "a", 2022, 1), ("p", "a", 2022, 1), ("p", "b", 2022, 2)], schema)
    two = spark.createDataFrame([("q", "c", 2022, 1), ("p", "a", 2022, 1)], schema)
    first = spark.createDataFrame([("a", "Alpha"), ("b", "")], "account_id string, account_name string")
    second = spark.createDataFrame([("a", "Other"), ("b", "Beta")], "account_id string, account_name string")
    return [one, two], [first, second]


def test_account_dim_modes(spark):
    sources, names = _accounts(spark)
    full = account_dim(sources, names)
    assert rows(full) == [("p", "a", "a", "Alpha"), ("p", "b", "b", "Beta"), ("q", "c", "c", "")]
    assert rows(account_dim(sources, names, mode="month", period=(2022, 2))) == [("p", "b", "b", "Beta")]
    known = full.where("line_item_usage_account_id = 'a'")
    assert [r[1] for r in rows(account_dim(sources, names, mode="delta", existing=known))] == ["b", "c"]
    assert account_dim(sources, names, mode="delta", existing=full).count() == 0
    with pytest.raises(ValueError):
        account_dim(sources, names, mode="delta")


def test_hashed_dim_delta_ids_equal_full_ids(spark):
    df = spark.createDataFrame([("x", 2022, 1), ("y", 2022, 2), (None, 2022, 2)], "t string, year int, month int")
    full = hashed_dim([df], ["t"], "k")
    known = hashed_dim([df], ["t"], "k", mode="month", period=(2022, 1))
    delta = hashed_dim([df], ["t"], "k", mode="delta", existing=known)
    assert rows(known.unionByName(delta)) == rows(full)
    assert hashed_dim([df], ["t"], "k", mode="delta", existing=full).count() == 0


def _lines(spark, data):
    schema = "line_item_resource_id string, d string, line_item_usage_account_id string, resource_tags_user_x string, n int"
    df = spark.createDataFrame(data, schema).withColumn("line_item_usage_start_date", F.col("d").cast("timestamp"))
    return df.withColumns({"year": F.year("line_item_usage_start_date"), "month": F.month("line_item_usage_start_date")})


def test_latest_tags(spark):
    lines = _lines(
        spark,
        [
            ("arn:x/i-1", "2022-01-01", "a", "old", 1),
            ("arn:x/i-1", "2022-02-01", "a", "tie", 2),
            ("arn:x/i-1", "2022-02-01", "a", "new", 1),
            ("arn:x/i-2", "2022-01-05", "b", None, 1),
            ("", "2022-01-05", "b", "blank", 1),
            (None, "2022-01-06", "b", "blank", 1),
        ],
    )
    found = latest_tags(lines, ["resource_tags_user_x"], tie_break=[F.col("n")])
    key = hashlib.sha256(b"new").hexdigest()
    assert [(r["line_item_resource_id"], r["month"]) for r in found.orderBy("line_item_resource_id", "day").collect()] == [
        ("", 1), ("", 1), ("i-1", 2), ("i-2", 1),
    ]
    assert found.where("line_item_resource_id = 'i-1'").first()["tag_dim_id"] == key
    january = latest_tags(lines, ["resource_tags_user_x"], tie_break=[F.col("n")], period=(2022, 1))
    assert "i-1" not in [r[0] for r in rows(january)]
    assert current_tag_map(found).where("line_item_resource_id = ''").count() == 1


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(latest_per(df, ["k"], [F.col("id").desc()])) == [(0, 999), (1, 997), (2, 998)]


def _samples():
    generator = random.Random(7)
    yield "smooth", [generator.gauss(0, 50) for _ in range(4000)]
    yield "outlier", [generator.random() for _ in range(3000)] + [1e300, -1e300]
    yield "repeats", [float(generator.randrange(5)) for _ in range(5000)]
    yield "constant", [4.25] * 2500
    yield "narrow", [1.0 + generator.random() * 1e-12 for _ in range(2500)]
    yield "small", [3.0, 1.0, 2.0]
    yield "single", [9.0]


def test_percentiles_match_numpy(spark):
    samples = dict(_samples())
    df = spark.createDataFrame([(k, v) for k, vs in samples.items() for v in vs] + [("smooth", None)], "k string, v double")
    probabilities = [0.0, 0.5, 0.9, 0.95, 0.99, 1.0]
    found = {r["k"]: r["percentiles"] for r in exact_percentiles(df, ["k"], "v", probabilities).collect()}
    assert set(found) == set(samples)
    for name, values in samples.items():
        expected = np.percentile(np.array(values), [p * 100 for p in probabilities])
        assert np.allclose(found[name], expected, rtol=1e-12, atol=1e-12), name


def test_percentiles_of_odd_values_equal_the_aggregate(spark):
    inf, nan = float("inf"), float("nan")
    generator = random.Random(4)
    groups = {
        "infinite": [1.0, 2.0, inf, inf, -inf],
        "all_inf": [inf] * 4,
        "nan": [1.0, nan, 3.0],
        "zeros": [-0.0, 0.0, -0.0, 1.0],
        "one_value": [7.0] * 3000,
        "decades": [10.0 ** generator.uniform(-150, 150) for _ in range(3000)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    probabilities = [0.0, 0.3, 0.5, 0.75, 0.99, 1.0]
    found = dict(exact_percentiles(df, ["k"], "v", probabilities).collect())
    expected = dict(df.groupBy("k").agg(F.percentile("v", percentile_array(probabilities))).collect())
    assert {k: [str(x + 0.0) for x in v] for k, v in found.items()} == {
        k: [str(x + 0.0) for x in v] for k, v in expected.items()
    }


def test_upsert_nulls_duplicates_and_repetition(spark):
    schema = "k string, v int, w string"
    target = spark.createDataFrame([("a", 1, "t"), ("b", 2, "t"), (None, 3, "t")], schema)
    stage = spark.createDataFrame([("s", "a", 10), ("s", "a", 11), ("s", "c", 12), ("s", None, 13)], "w string, k string, v int")
    once = upsert(target, stage, ["k"])
    assert rows(once) == sorted(
        [("a", 10, "s"), ("a", 11, "s"), ("b", 2, "t"), ("c", 12, "s"), (None, 3, "t"), (None, 13, "s")], key=repr
    )
    keyed = stage.where("k is not null")
    again = upsert(upsert(target, keyed, ["k"]), keyed, ["k"])
    assert rows(again) == rows(upsert(target, keyed, ["k"]))


def test_upsert_by_day_moves_staged_days_only(spark):
    schema = "day string, k string, v int"
    target = spark.createDataFrame(
        [("d1", "a", 1), ("d2", "a", 2), ("d2", "b", 3), ("d2", None, 4), (None, "a", 5), ("d3", "a", 6)], schema
    )
    stage = spark.createDataFrame([("d2", "a", 10), ("d2", "a", 11), ("d2", None, 12), (None, "a", 13), ("d4", "c", 14)], schema)
    for staged in (stage, stage.limit(0)):
        assert rows(upsert(target, staged, ["day", "k"], day="day")) == rows(upsert(target, staged, ["day", "k"]))
    stored, spread = materialize(target, "target"), materialize(stage, "stage")
    result = upsert(stored, spread, ["day", "k"], day="day")
    assert len(result.collect()) == 10
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin [day") >= 2


def test_mapping_choice_and_null_columns(spark):
    df = spark.createDataFrame([("12", "x", None), ("ab", "y", None)], "n string, s string, gone string")
    mapped = apply_mapping(df, [("n", "number", "long"), ("s", "text", "string")])
    assert rows(mapped) == sorted([(12, "x"), (None, "y")], key=repr)
    assert drop_null_columns(df).columns == ["n", "s"]
    texts = spark.createDataFrame([("1",), ("1.5",), ("q",), (None,)], "t string").select(choice_struct(F.col("t")).alias("c"))
    assert [tuple(r["c"]) if r["c"] else None for r in texts.collect()] == [
        (1, None, None), (None, 1.5, None), (None, None, "q"), None,
    ]
    nested = spark.createDataFrame([((1, ("z",)),)], "a struct<b: int, c: struct<d: string>>")
    assert flatten(nested).columns == ["a_b", "a_c_d"]
    as_json = apply_mapping(nested, [("a", "a", "string")]).first()["a"]
    assert as_json == '{"b":1,"c":{"d":"z"}}'


def test_commitments_flatten_and_union(spark):
    a = spark.sql("select named_struct('Start','2024-01-05','End','2024-01-06') as TimePeriod, named_struct('Hours','5','Deep',named_struct('Pct','1.5')) as Total")
    b = spark.sql("select named_struct('Start','2024-01-06','End','2024-01-07') as TimePeriod, named_struct('Hours','6') as Total, 3 as Extra")
    landed = b.select(F.array(F.struct("TimePeriod", "Total", "Extra")).alias("UtilizationsByTime"))
    found = C.ri_utilization({"ONE": a, "TWO": C.landed_series(landed, C.RI_UTILIZATION)})
    assert set(found.columns) == {"service_name", "date_dim_id", "Hours", "Deep_Pct", "Extra"}
    assert all(t == "string" for _, t in found.dtypes)
    got = {r["service_name"]: r.asDict() for r in found.collect()}
    assert got["ONE"] == {"service_name": "ONE", "date_dim_id": "20240105", "Hours": "5", "Deep_Pct": "1.5", "Extra": None}
    assert got["TWO"]["Extra"] == "3"
    assert set(C.savings_utilization(a).columns) == {"date_dim_id", "Total_Hours", "Total_Deep_Pct"}
