from datetime import date

import pytest
from conftest import SALES, frame
from pyspark.sql import functions as F

from demandloom.functions.columns import (
    as_double,
    as_integer,
    checked_broadcast,
    first_valid,
    logged_metric,
    non_negative,
)
from demandloom.operators import calendar, features, profile, series, shares, split
from demandloom.schemas import INSTANCE_COLS, PAIR

OIL = "date date, dcoilwtico double"
HOL = "date date, type string, transferred boolean"


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def day(n):
    return date(2017, 8, n)


def test_daily_totals(sales):
    assert by(features.daily_totals(sales), "date", "total_cashflow") == {
        day(1): 70.0, day(2): 80.0, day(3): 74.0,
    }


def test_daily_total_of_unknown_sales_is_zero_and_null_days_go(spark):
    rows = [(1, "2017-08-01", 1, "A", None, 1), (2, None, 1, "A", 5.0, 1)]
    assert by(features.daily_totals(frame(spark, SALES, rows)), "date", "total_cashflow") == {
        day(1): 0.0
    }


def test_oil_forward_then_backward_fill(spark, oil):
    assert by(calendar.clean_oil(oil), "date", "oil_price")[day(2)] == 50.0
    gaps = frame(
        spark, OIL, [("2017-08-01", None), ("2017-08-02", None), ("2017-08-03", 7.0), ("2017-08-04", None)]
    )
    assert set(by(calendar.clean_oil(gaps), "date", "oil_price").values()) == {7.0}


def test_holidays_drop_moved_and_work_days_but_keep_untyped(spark, holidays):
    extra = frame(
        spark, HOL,
        [("2017-08-04", None, False), ("2017-08-05", "Event", None), ("2017-08-01", "Event", False)],
    )
    flags = calendar.holiday_flags(holidays.unionByName(extra))
    assert sorted(by(flags, "date", "is_holiday")) == [day(1), day(4)]


def test_fill_sees_joined_days_only(spark, sales, holidays):
    """A quote on a day without sales is never used, and a leading gap fills backwards."""
    quotes = frame(
        spark, OIL, [("2017-07-31", 99.0), ("2017-08-02", 60.0), ("2017-08-05", 61.0)]
    )
    out = features.total_features(sales, quotes, holidays)
    assert by(out, "date", "oil_price") == {day(1): 60.0, day(2): 60.0, day(3): 60.0}
    assert by(out, "date", "is_holiday") == {day(1): 1.0, day(2): 0.0, day(3): 0.0}
    assert by(out, "date", "day_of_week")[day(1)] == 1  # a Tuesday, Monday is 0


def test_lowest_of_duplicate_quotes_counts(spark, sales, holidays):
    quotes = frame(spark, OIL, [("2017-08-01", 2.0), ("2017-08-01", 1.0), ("2017-08-02", 3.0)])
    total = features.total_features(sales, quotes, holidays)
    assert total.count() == 3 and by(total, "date", "oil_price")[day(1)] == 1.0
    assert features.pair_features(sales, quotes, holidays).count() == 12


def test_pair_features_fill_within_pair(spark, oil, holidays):
    rows = [
        (1, "2017-08-01", 1, "A", 1.0, 0),
        (2, "2017-08-03", 1, "A", 2.0, 0),
        (3, "2017-08-04", 1, "A", None, 0),
        (4, "2017-08-04", 1, "B", 4.0, 0),
    ]
    out = features.pair_features(frame(spark, SALES, rows), oil, holidays)
    assert by(out, "id", "oil_price") == {1: 50.0, 2: 52.0, 3: 52.0, 4: None}
    assert by(out, "id", "sales")[3] is None


def test_target_series(sales):
    assert features.target_series(sales, 1, "BEVERAGES").count() == 3


def test_holdout_is_by_calendar(spark, sales):
    tagged = split.tag_holdout(features.daily_totals(sales), 1)
    assert [r.date for r in split.validation_rows(tagged).collect()] == [day(3)]
    assert split.train_rows(tagged).count() == 2
    gappy = frame(spark, "date date, k int", [("2017-08-01", 1), ("2017-08-03", 1), ("2017-08-09", 1)])
    assert split.validation_rows(split.tag_holdout(gappy, 7, ["k"])).count() == 2


def test_shares(spark, sales):
    props = shares.trailing_shares(sales)
    check = shares.share_check(props).first()
    assert (check.pairs, check.share_sum) == (4, 1.0)
    assert by(props.where("store_nbr = 1"), "family", "proportion")["AUTOMOTIVE"] == 33 / 224


def test_share_window_has_31_days(spark):
    rows = [(i, f"2017-0{7 if i < 31 else 8}-{(i % 31) + 1:02d}", 1, "A", 1.0, 0) for i in range(62)]
    window = shares.trailing_window(frame(spark, SALES, rows))
    assert window.select("date").distinct().count() == 31


def test_uniform_shares_use_pairs_of_all_history(spark):
    rows = [(1, "2017-01-01", 1, "OLD", 9.0, 0), (2, "2017-08-01", 1, "A", 0.0, 0), (3, "2017-08-01", 2, "A", 0.0, 0)]
    props = shares.trailing_shares(frame(spark, SALES, rows))
    assert [round(r.proportion, 6) for r in props.collect()] == [0.333333] * 3


def test_disaggregate(spark):
    keys = [(1, "A"), (1, "B"), (2, "A"), (2, "B")]
    props = spark.createDataFrame(
        [(*k, p) for k, p in zip(keys, (0.15, 0.35, 0.20, 0.30))],
        "store_nbr int, family string, proportion double",
    )
    days = ["2017-08-16", "2017-08-17"]
    rows = [(4 * d + i, days[d], *keys[i]) for d in range(2) for i in range(4)]
    rows += [(8, days[0], 9, "X"), (9, "2017-08-30", 1, "A")]
    inst = frame(spark, "id bigint, date date, store_nbr int, family string", rows)
    totals = frame(spark, "date date, predicted_total double", [(days[0], 1000.0), (days[1], 1200.0)])
    out = by(shares.disaggregate(inst, totals, props), "id", "sales")
    assert len(out) == 10
    assert (out[0], out[1], out[4]) == (150.0, 350.0, 180.0)
    assert out[8] == 0.0 and out[9] == 0.0  # unknown pair, day without a forecast
    assert sum(out[i] for i in range(4)) == pytest.approx(1000.0)


def test_clamp(spark):
    values = [100.0, -5.0, 0.0, 200.0, -50.0, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    out = by(df.select("i", non_negative(F.col("v")).alias("v")), "i", "v")
    assert list(out.values()) == [100.0, 0.0, 0.0, 200.0, 0.0, 0.0, 0.0]


def test_logged_metric(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("-inf")), (3, 2.5)], "i int, v double")
    assert by(df.select("i", logged_metric(F.col("v")).alias("v")), "i", "v") == {1: -1.0, 2: -1.0, 3: 2.5}


def test_text_to_numbers(spark):
    df = spark.createDataFrame([("1.0",), ("x",), (None,)], "t string")
    rows = df.select(as_integer(F.col("t")).alias("i"), as_double(F.col("t")).alias("d")).collect()
    assert [r.i for r in rows] == [1, None, None]
    assert rows[0].d == 1.0 and rows[1].d != rows[1].d and rows[2].d is None


def test_first_valid(spark):
    df = spark.createDataFrame([(3, 30.0), (1, None), (2, 20.0)], "id int, v double")
    assert df.agg(first_valid(F.col("v"), F.col("id"))).first()[0] == 20.0


def test_request_instances(sales, request_rows, oil, holidays):
    out = features.request_instances(request_rows, oil, holidays)
    assert out.columns == INSTANCE_COLS
    rows = out.collect()
    assert len(rows) == 4 and all(r.day_of_week == 2 for r in rows)  # a Wednesday
    assert features.instances_text(out).first().date == "2017-08-16"


def test_request_prices_come_from_request_days_only(spark, holidays):
    rows = [(1, "2017-08-16", 1, "A", 1), (2, "2017-08-17", 1, "A", 2), (3, "2017-08-17", 1, "B", 3)]
    request = frame(spark, "id bigint, date date, store_nbr int, family string, onpromotion bigint", rows)
    quotes = frame(spark, OIL, [("2017-08-15", 1.0), ("2017-08-17", 5.0)])
    whole = features.request_instances(request, quotes, holidays)
    assert by(whole, "id", "oil_price") == {1: 5.0, 2: 5.0, 3: 5.0}
    daily = by(features.request_daily_exog(whole), "date", "onpromotion")
    assert daily == {day(16): 1.0, day(17): 5.0}
    pairs = features.pair_request_instances(request.where("id != 2"), quotes, holidays)
    assert by(pairs, "id", "oil_price") == {1: None, 3: 5.0}


def test_future_calendar(spark, sales, oil, holidays):
    days = features.total_features(sales, oil, holidays, with_dow=False)
    quotes = oil.unionByName(frame(spark, OIL, [("2017-08-05", 60.0)]))
    free = holidays.unionByName(frame(spark, HOL, [("2017-08-06", "Holiday", False)]))
    out = calendar.future_calendar(days, quotes, free, 15)
    assert out.columns == ["date", "oil_price", "is_holiday", "onpromotion"]
    prices, flags = by(out, "date", "oil_price"), by(out, "date", "is_holiday")
    assert sorted(prices) == [day(n) for n in range(4, 19)]
    assert prices[day(4)] == 52.0 and prices[day(5)] == 60.0 and prices[day(6)] == 52.0
    assert flags[day(6)] == 1.0 and sum(flags.values()) == 1.0


def test_seasonal_lag_repeats_the_last_week(spark):
    history = frame(spark, "date date, y double", [(f"2017-08-{n:02d}", float(n)) for n in range(1, 11)])
    asked = frame(spark, "date date", [(f"2017-08-{n:02d}",) for n in range(11, 21)])
    out = by(series.seasonal_lag_forecast(history, asked, "y"), "step", "forecast")
    assert [out[k] for k in range(1, 11)] == [4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 4.0, 5.0, 6.0]


def test_profile(sales, oil):
    row = profile.profile(oil, "dcoilwtico").first()
    assert (row.rows, row.columns, row.nulls_dcoilwtico, row["mean"], row["max"]) == (3, 2, 1, 51.0, 52.0)
    assert row["std"] == pytest.approx(2**0.5)
    assert profile.date_range(sales).first().last_date == day(3)
    assert [r.date for r in profile.preview(features.daily_totals(sales), 2).collect()] == [day(3), day(2)]


def test_fraction_split(spark):
    parts = by(
        split.fraction_split(spark.range(5000), "id").groupBy("split").count(), "split", "count"
    )
    assert abs(parts["train"] - 4000) < 150 and abs(parts["test"] - 500) < 100


def test_broadcast_only_small_sides(spark):
    big, small = spark.range(100).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    plan = lambda side: spark.range(9).withColumnRenamed("id", "k").join(side, "k")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(checked_broadcast(small, 10)).lower()
    assert "broadcast" not in plan(checked_broadcast(big, 10)).lower()


def test_pair_rows_are_not_shuffled_for_the_calendar(spark, sales, oil, holidays):
    """One shuffle to days, one to pairs; both calendar joins are broadcast."""
    out = features.pair_features(sales, oil, holidays)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning(store_nbr") == 2


def test_pair_key_names():
    assert PAIR == ["store_nbr", "family"]
