from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from faremeter.functions import calendar as cal
from faremeter.functions import scalars as S
from faremeter.functions.predicates import all_of, any_of, compare, is_number_ge, like, within


def values(df, col):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is not None, v))


@pytest.fixture(scope="module")
def abc(spark):
    return spark.createDataFrame([(1, 2, 3), (1, 2, 4), (5, 2, 1), (None, 1, 1), (2, 9, 1)], "a int, b int, c int")


def test_distance_filter_keeps_real_non_negative_numbers(spark):
    df = spark.createDataFrame([(1.5,), (0.0,), (-1.0,), (None,), (math.nan,)], "trip_distance double")
    assert values(df.filter(is_number_ge("trip_distance", 0)), "trip_distance") == [0.0, 1.5]


def test_not_equal_in_both_readings(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    assert values(df.filter(compare("a", "!=", 1, null_safe=True)), "a") == [None, 2]
    assert values(df.filter(compare("a", "!=", 1)), "a") == [2]
    assert values(df.filter(compare("a", "=", None, null_safe=True)), "a") == [None]


def test_all_conjuncts_apply(abc):
    kept = abc.filter(all_of(compare("a", "=", 1), compare("b", "=", 2), compare("c", "=", 3)))
    assert [tuple(r) for r in kept.collect()] == [(1, 2, 3)]
    assert abc.filter(all_of()).count() == 5 and abc.filter(any_of()).count() == 0


def test_nested_logic(abc):
    kept = abc.filter(any_of(compare("a", "=", 1), compare("b", "=", 2)) & compare("c", "=", 1))
    assert [tuple(r) for r in kept.collect()] == [(5, 2, 1)]


@pytest.mark.parametrize("op, want", [("<", [1, 1]), ("<=", [1, 1, 2]), (">", [5]), (">=", [2, 5]), ("=", [2])])
def test_comparisons(abc, op, want):
    assert values(abc.filter(compare("a", op, 2)), "a") == want


def test_unknown_comparison_is_refused():
    with pytest.raises(ValueError):
        compare("a", "~", 1)


def test_like_and_range(spark):
    df = spark.createDataFrame([("xabcx", 1), ("b", 7)], "c string, n int")
    assert values(df.filter(like("c", "%abc%")), "n") == [1]
    assert values(df.filter(within("n", 2, 7)), "n") == [7]


def test_day_of_week_starts_on_monday(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 08:45:30' ts union all select timestamp_ntz'2024-01-07 23:00:00'")
    rows = cal.calendar_features(df, "ts").orderBy("ts").collect()
    assert [(r.dow, r.dom, r.month, r.hour, r.minute) for r in rows] == [(1, 1, 1, 8, 45), (7, 7, 1, 23, 0)]
    parts = df.select(cal.second_of_hour(F.col("ts")).alias("s"), cal.three_hour_bucket(F.col("ts")).alias("b"))
    assert sorted(tuple(r) for r in parts.collect()) == [(0, 7), (2730, 2)]


def test_text_time_and_dates(spark):
    df = spark.createDataFrame([("08:45", "2020-06-30"), ("junk", "2020-13-01")], "t string, d string")
    hour, minute = cal.clock_parts(F.col("t"))
    rows = df.select(hour.alias("h"), minute.alias("m"), cal.parse_date(F.col("d")).cast("string").alias("d")).collect()
    assert tuple(rows[0]) == (8, 45, "2020-06-30")
    assert tuple(rows[1]) == (None, None, None)


def test_strip_quotes(spark):
    df = spark.createDataFrame([("'it''s'",), ("plain",)], "s string")
    assert values(df.select(S.strip_quotes(F.col("s")).alias("s")), "s") == ["it''s", "plain"]


@pytest.mark.parametrize("near", [0, 1])
@pytest.mark.parametrize("weight", [0.8, 0.9, 1.0])
@pytest.mark.parametrize("dist", [0.0, 2.7, 3.0, 3.4, 20.0])
def test_acceptance_formula(spark, near, weight, dist):
    want = 0.2 * math.sqrt(250) / math.sqrt(600) + (0.8 if near else 0.5) * weight ** math.exp(-(((dist - 3) / 0.5) ** 2))
    args = (F.lit(250.0), F.lit(dist), near, F.lit(weight))
    got = spark.range(1).select(S.acceptance(*args).alias("p")).first().p
    assert got == pytest.approx(want, abs=1e-12)


def test_draws_are_repeatable_and_weights_fixed(spark):
    df = spark.range(300).select(S.draw(F.col("id"), 7).alias("a"), S.draw(F.col("id") + 0, 7).alias("b"))
    assert df.filter("a <> b").count() == 0
    assert {r.a for r in df.collect()} == {0, 1, 2}
    grid = spark.range(9).select((F.col("id") % 3).alias("t"), F.floor(F.col("id") / 3).alias("c"))
    weights = [r.w for r in grid.select(S.draw_weight(F.col("t"), F.col("c")).alias("w")).collect()]
    assert sorted(weights) == [0.8] * 3 + [0.9] * 3 + [1.0] * 3


def test_certain_answer_and_missing_p(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "p double")
    total = df.agg(F.sum(S.log_refusal(F.col("p"))).alias("s")).first().s
    assert 1 - math.exp(total) == 1.0
    none = df.filter("p is null").agg(F.sum(S.log_refusal(F.col("p"))).alias("s")).first().s
    assert none is None


def test_no_session_zone_in_texts(spark):
    """02:30 does not exist on that day in New York; without a zone it is a time like any other."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-02-30 00:00:00",), ("2024-3-1 1:2:3",), (None,)], "s string")
        at = cal.parse_timestamp(F.col("s"))
        rows = df.select(cal.timestamp_text(at).alias("t"), cal.clock_text(at).alias("c"), cal.month_label(at).alias("m"), cal.date_text(at).alias("d")).collect()
        assert tuple(rows[0]) == ("2024-03-10 02:30:00", "02:30", "2024-03", "2024-03-10")
        assert [tuple(r) for r in rows[1:]] == [(None,) * 4] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_money_is_exact_beyond_doubles(spark):
    from faremeter.plans.dashboards import _total_price

    # 2**53 cents and one more: a double sum of cents would lose it
    df = spark.createDataFrame([(90071992547409.92,), (0.01,), (0.01,), (0.01,)], "price double")
    cents = df.agg((_total_price() * 100).alias("c"), F.sum(F.rint(F.col("price") * 100).cast("decimal(18,0)")).alias("exact")).first()
    assert int(cents.exact) == 2**53 + 3


def test_hosts_without_orders_stay(spark, tmp_path):
    from faremeter.plans import views

    d = str(tmp_path)
    spark.createDataFrame([(1, "a", 0, 9000.0), (2, "b", 0, 1.0)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{d}/nation.parquet")
    orders = spark.createDataFrame([(5, 1, "F")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    orders.withColumn("o_orderdate", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(f"{d}/orders.parquet")
    got = {r.host_id: (r.total_listings_count, r.response_rate, r.superhost) for r in views.hosts(spark, d).collect()}
    assert got == {1: (1, 1.0, 1), 2: (0, None, 0)}
