"""Hot keys, whole results and plan shapes."""

from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from demandloom.operators import features, runs, series, shares, split, tuning
from demandloom.schemas import PAIR
from demandloom.sources import rollup, star

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows, a third of them one pair, many per day."""
    hot = F.col("id") % 3 == 0
    mixed = F.pmod(F.xxhash64("id"), F.lit(400))
    return spark.range(30_000).select(
        "id",
        F.date_add(F.lit("2017-01-01").cast("date"), (mixed % 200).cast("int")).alias("date"),
        F.when(hot, 1).otherwise(mixed % 40).cast("int").alias("store_nbr"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("F"), F.col("id") % 7)).alias("family"),
        (F.col("id") % 11).cast("decimal(18,4)").alias("sales"),
        (F.col("id") % 2).alias("onpromotion"),
    ).persist()


@pytest.fixture(scope="module")
def calendars(spark):
    days = spark.range(200).select(
        F.date_add(F.lit("2017-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id"
    )
    oil = days.where("id % 5 < 3").select(
        "date", F.when(F.col("id") % 4 != 0, F.col("id").cast("double")).alias("dcoilwtico")
    )
    free = days.where("id % 30 = 0").select(
        "date", F.lit("Holiday").alias("type"), F.lit(False).alias("transferred")
    )
    return oil, free


def pandas_pair_features(sales, oil, free):
    oil = oil.sort_values("date").rename(columns={"dcoilwtico": "oil_price"})
    oil["oil_price"] = oil["oil_price"].ffill().bfill()
    rows = sales.groupby([*PAIR, "date"], as_index=False).agg(
        id=("id", "min"), sales=("sales", "sum"), onpromotion=("onpromotion", "sum")
    )
    rows = rows.merge(oil, on="date", how="left").sort_values([*PAIR, "date"])
    rows["is_holiday"] = rows["date"].isin(free["date"]).astype(float)
    rows["oil_price"] = rows.groupby(PAIR)["oil_price"].transform(lambda c: c.ffill().bfill())
    rows["day_of_week"] = pd.to_datetime(rows["date"]).dt.dayofweek
    return rows


def test_hot_pair_features_equal_pandas(skewed, calendars):
    oil, free = calendars
    got = features.pair_features(skewed, oil, free).toPandas()
    sales = skewed.toPandas().astype({"sales": float})
    want = pandas_pair_features(sales, oil.toPandas(), free.toPandas())
    order = [*PAIR, "date"]
    got = got.sort_values(order).reset_index(drop=True)
    want = want[got.columns].sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_hot_pair_is_a_calendar_long(skewed, calendars):
    packed = series.pack_series(
        split.tag_holdout(features.pair_features(skewed, *calendars), 15, PAIR), PAIR, "sales", ["oil_price"]
    )
    longest = packed.agg(F.max(F.size("y"))).first()[0]
    assert longest <= 200 < skewed.where("family = 'HOT'").count()
    whole = packed.agg(F.sum(F.aggregate("y", F.lit(0.0), lambda a, b: a + b))).first()[0]
    assert whole == pytest.approx(float(skewed.agg(F.sum("sales")).first()[0]))


def test_hot_pair_request_keeps_every_row(skewed, calendars):
    request = skewed.drop("sales")
    inst = features.request_instances(request, *calendars)
    pairs = features.pair_request_instances(request, *calendars)
    totals = features.daily_totals(skewed).select("date", F.col("total_cashflow").alias("predicted_total"))
    split_up = shares.disaggregate(inst, totals, shares.trailing_shares(skewed))
    assert inst.count() == pairs.count() == split_up.count() == 30_000
    assert split_up.select("id").distinct().count() == 30_000


def test_positions_with_a_hot_first_key(skewed):
    rows = runs.with_position(skewed.select("store_nbr", "id"), ["store_nbr", "id"])
    want = skewed.toPandas().sort_values(["store_nbr", "id"])["id"].tolist()
    assert [r.id for r in rows.orderBy("position").collect()] == want


def test_task_count_follows_the_series(spark):
    cores = spark.sparkContext.defaultParallelism
    assert tuning.task_count(spark.range(3)) == cores
    assert tuning.task_count(spark.range(64 * 40), blocks=2) == 80


@pytest.mark.parametrize(
    "name",
    ["features_pair", "disaggregate", "future_calendar", "seasonal_lag_forecast", "trial_plan",
     "submission_by_position", "reconcile", "batch_input_pair", "evaluate_metrics"],
)
def test_no_cross_joins(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_days_are_cut_at_the_scan(spark):
    past, asked = star.history_and_request(spark, SF)
    for frame in (past, asked, star.recent_days(spark, SF), star.recent_days(spark, SF, h=15)):
        pushed = [x for x in _plan(frame).split("PushedFilters") if "l_shipdate" in x]
        assert pushed and any("ThanOrEqual(l_shipdate" in x or "LessThan(l_shipdate" in x for x in pushed)


@pytest.mark.parametrize("name", ["disaggregate", "proportions", "batch_input", "reconcile"])
def test_flows_read_the_facts_once(spark, name, monkeypatch):
    """The rollup is all that reads line items; parts of it read their months."""
    made, parts, write, cut = [], [], rollup.write_rollup, rollup.between

    def between(rolled, after=None, until=None):
        part = cut(rolled, after, until)
        parts.extend([part] if after or until else [])
        return part

    monkeypatch.setattr(rollup, "write_rollup", lambda panel: made.append(panel) or write(panel))
    monkeypatch.setattr(rollup, "between", between)
    plan = _plan(contract.queries()[name](spark, SF))
    assert len(made) == 1 and "l_shipdate" in _plan(made[0]) and "l_shipdate" not in plan
    assert parts and all("PartitionFilters: [isnotnull(month_number" in _plan(part) for part in parts)


def test_parts_of_a_rollup(spark, tmp_path):
    first = date(2020, 1, 30)
    rows = [(first + timedelta(k), k) for k in range(40)] + [(None, -1)]
    panel = spark.createDataFrame(rows, "date date, n int")
    rolled = rollup.write_rollup(panel, str(tmp_path / "days"))
    assert sorted(r.n for r in rollup.between(rolled).collect()) == [-1, *range(40)]
    assert sorted(r.n for r in rollup.between(rolled, after=first, until=first + timedelta(3)).collect()) == [1, 2, 3]
    assert rollup.newest_day(rolled) == first + timedelta(39)
    assert rollup.newest_day(rolled, before=date(2020, 3, 1)) == date(2020, 2, 29)
    assert rollup.newest_day(rolled, before=first) is None
    none = rollup.write_rollup(panel.limit(0), str(tmp_path / "none"))
    assert rollup.newest_day(none) is None and rollup.between(none, after=first).count() == 0


def test_lines_without_a_part_do_not_move_the_newest_day(spark, tmp_path):
    for name in ("part", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    line = spark.read.parquet(f"{SF}/lineitem.parquet")
    late = line.limit(1).withColumns({"l_partkey": F.lit(-5).cast("long"), "l_shipdate": F.col("l_shipdate") + F.expr("interval 20 years")})
    line.unionByName(late).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert star.newest_day(spark, str(tmp_path)) == star.newest_day(spark, SF)


def test_scans_read_only_what_they_need(spark):
    plan = contract.queries()["daily_totals"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "p_name" not in plan and "s_acctbal" not in plan
