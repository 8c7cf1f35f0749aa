"""Every operator as a query over the star-schema tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators import (
    calendar,
    classify,
    diagnostics,
    evaluate,
    features,
    forecast,
    linear,
    predictions,
    profile,
    runs,
    series,
    shares,
    split,
    tuning,
)
from demandloom.plans import pairs, results, topdown, total
from demandloom.schemas import EXOG, HORIZON, PAIR
from demandloom.sources import requests, rollup, sinks, star

TARGET = (1, "PROMO")

def _tables(spark, sf):
    return [f(spark, sf) for f in (star.sales_panel, star.oil, star.holidays)]


def _past(spark, sf):
    return [f(spark, sf) for f in (star.history, star.oil, star.holidays)]


def _asked(spark, sf, rolled=None):
    """History, request and calendars, all days from one written rollup of the facts."""
    rolled = star.rolled_panel(spark, sf) if rolled is None else rolled
    return [*star.history_and_request(spark, sf, rolled=rolled), star.oil(spark, sf), star.holidays(spark, sf)]


# --- calendars and features ---------------------------------------------------------------


def daily_totals(spark, sf):
    return features.daily_totals(star.sales_panel(spark, sf))


def oil_filled(spark, sf):
    return calendar.clean_oil(star.oil(spark, sf))


def holiday_flags(spark, sf):
    return calendar.holiday_flags(star.holidays(spark, sf))


def features_total(spark, sf):
    return features.total_features(*_tables(spark, sf))


def features_calendar(spark, sf):
    return features.total_features(*_tables(spark, sf), with_dow=False)


def features_pair(spark, sf):
    return features.pair_features(*_tables(spark, sf))


def target_series(spark, sf):
    sales, oil, holidays = _tables(spark, sf)
    return features.pair_features(features.target_series(sales, *TARGET), oil, holidays)


def holdout_split(spark, sf):
    return split.tag_holdout(features.total_features(*_tables(spark, sf)), HORIZON)


def holdout_split_pair(spark, sf):
    days = features.pair_days(star.sales_panel(spark, sf))
    return split.tag_holdout(days.select(*PAIR, "date", "sales"), HORIZON, PAIR)


def future_calendar(spark, sf):
    sales, oil, holidays = _past(spark, sf)
    days = features.total_features(sales, oil, holidays, with_dow=False)
    return calendar.future_calendar(days, oil, holidays, HORIZON)


def differenced_series(spark, sf):
    days = features.pair_days(star.sales_panel(spark, sf)).select(*PAIR, "date", "sales")
    out = series.difference(days, PAIR, "sales", [1, 7])
    return out.withColumn("sales", F.round("sales", 4))


def latest_days(spark, sf):
    return profile.preview(features.total_features(*_tables(spark, sf)), 15)


# --- requests -----------------------------------------------------------------------------


def batch_input(spark, sf):
    _, request, oil, holidays = _asked(spark, sf)
    return features.instances_text(features.request_instances(request, oil, holidays))


def batch_input_pair(spark, sf):
    _, request, oil, holidays = _asked(spark, sf)
    return features.pair_request_instances(request, oil, holidays)


def request_daily_exog(spark, sf):
    _, request, oil, holidays = _asked(spark, sf)
    return features.request_daily_exog(features.request_instances(request, oil, holidays))


def _bodies(spark, sf) -> DataFrame:
    """A scoring request per panel row, by name or by place in turn, numbers as text."""
    rows = star.sales_panel(spark, sf).select(
        F.col("id"),
        F.array(
            F.col("id").cast("string"),
            F.col("date").cast("string"),
            F.concat(F.col("store_nbr").cast("string"), F.lit(".0")),
            F.col("family"),
            F.col("onpromotion").cast("string"),
            F.col("sales").cast("string"),
            F.lit("0.0"),
            F.weekday("date").cast("string"),
        ).alias("v"),
    )
    names = [F.lit(c) for c in features.INSTANCE_COLS]
    by_name = F.to_json(F.map_from_arrays(F.array(*names), F.col("v")))
    text = F.when(F.col("id").bitwiseAND(F.lit(1)) == 0, by_name).otherwise(F.to_json("v"))
    return rows.select("id", F.concat(F.lit('{"instances": ['), text, F.lit("]}")).alias("body"))


def request_parse(spark, sf):
    return requests.parse_instances(_bodies(spark, sf))


def request_rejects(spark, sf):
    """One body per panel row, four of five broken in some way."""
    rows = star.sales_panel(spark, sf)
    number = F.col("id").cast("string")
    item = F.concat(
        F.lit('{"instances": [{"id": '), number, F.lit(', "date": "2020-01-02", "store_nbr": 1, "family": "A", "day_of_week": 2}')
    )
    kind = F.pmod(F.col("id"), F.lit(6))
    body = (
        F.when(kind == 0, F.concat(item, F.lit("]}")))
        .when(kind == 1, item)
        .when(kind == 2, F.lit("not JSON"))
        .when(kind == 3, F.lit('{"other": []}'))
        .when(kind == 4, F.lit('{"instances": [{"id": "x", "date": "2020-01-02", "store_nbr": 1}]}'))
        .otherwise(F.lit('{"instances": [[5, "2020-13-41", 1, "A"], 7]}'))
    )
    made = rows.select(F.col("id").alias("line"), body.alias("body"))
    return requests.rejected_instances(made).select("line", "pos", "reason")


def request_lists(spark, sf):
    days = features.pair_days(star.sales_panel(spark, sf))
    step = F.array(
        F.col("onpromotion").cast("double"), F.col("sales"), F.lit(0.0), F.weekday("date").cast("double")
    )
    bodies = days.groupBy(*PAIR, F.trunc("date", "month").alias("month")).agg(
        F.to_json(
            F.struct(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("date", step.alias("v")))), lambda r: r["v"]
                ).alias("instances")
            )
        ).alias("body")
    )
    return requests.parse_exog_lists(bodies)


# --- shares and the split -----------------------------------------------------------------


def proportions(spark, sf):
    rolled = star.rolled_panel(spark, sf)
    return shares.trailing_shares(rollup.between(rolled), recent=star.recent_days(spark, sf, rolled=rolled))


def proportions_uniform(spark, sf):
    idle = star.sales_panel(spark, sf).withColumn("sales", F.lit(0.0))
    return shares.trailing_shares(idle)


def share_check(spark, sf):
    return shares.share_check(proportions(spark, sf))


def seasonal_lag_forecast(spark, sf):
    history, request, _, _ = _asked(spark, sf)
    return series.seasonal_lag_forecast(
        features.daily_totals(history), request, "total_cashflow"
    )


def _disaggregated(spark, sf, rolled) -> DataFrame:
    recent = star.recent_days(spark, sf, h=HORIZON, rolled=rolled)
    return topdown.seasonal_top_down(*_asked(spark, sf, rolled), recent=recent)


def disaggregate(spark, sf):
    return _disaggregated(spark, sf, star.rolled_panel(spark, sf))


def submission(spark, sf):
    return predictions.submission(disaggregate(spark, sf))


def reconcile(spark, sf):
    """Counts where every seventh id has no prediction, every fifth a null one, and every
    eleventh prediction is for an id nobody asked for."""
    number = F.col("id")
    rolled = star.rolled_panel(spark, sf)
    made = _disaggregated(spark, sf, rolled).where(number % 7 != 0)
    made = made.withColumn("sales", F.when(number % 5 != 0, F.col("sales")))
    made = made.withColumn("id", F.when(number % 11 == 0, -number).otherwise(number))
    return predictions.reconcile(star.request(spark, sf, rolled=rolled), made)


# --- models with a closed form ------------------------------------------------------------


def ols_exog_fit(spark, sf):
    fit = linear.fit_linear(features.pair_days(star.sales_panel(spark, sf)), PAIR, exog=["onpromotion"])
    return fit.select(
        *PAIR,
        F.col("n_obs").cast("int").alias("n_obs"),
        F.round(F.get("params", F.lit(0)), 3).alias("beta"),
        F.round("aic", 4).alias("aic"),
        F.round("bic", 4).alias("bic"),
    )


def ar1_fit(spark, sf):
    fit = linear.fit_linear(features.pair_days(star.sales_panel(spark, sf)), PAIR, p=1)
    return fit.select(
        *PAIR, F.round(F.get("params", F.lit(0)), 6).alias("phi"), F.round("aic", 4).alias("aic")
    )


def _fixed_forecast(spark, sf, **order):
    tagged = split.tag_holdout(features.pair_days(star.sales_panel(spark, sf)), HORIZON, PAIR)
    packed = runs.checkpointed(series.pack_series(tagged, PAIR, "sales", []))
    model = linear.fit_linear(split.train_rows(tagged), PAIR, **order)
    return forecast.forecast_holdout(model, packed, PAIR, 0)


def last_week_model(spark, sf):
    ahead = _fixed_forecast(spark, sf, seasonal_d=1)
    return ahead.drop("actual").withColumn("forecast", F.round("forecast", 4))


def _naive_metrics(spark, sf):
    ahead = _fixed_forecast(spark, sf, d=1)
    return evaluate.error_metrics(ahead.where(F.col("step") <= HORIZON), PAIR)


def evaluate_metrics(spark, sf):
    rounded = [F.round(c, 3).alias(c) for c in ("mae", "rmse", "mape")]
    return _naive_metrics(spark, sf).select(*PAIR, "val_rows", *rounded)


def seasonal_lag_metrics(spark, sf):
    """Day totals of the holdout against the last training week repeated."""
    tagged = split.tag_holdout(features.daily_totals(star.sales_panel(spark, sf)), HORIZON)
    train, val = split.train_rows(tagged), split.validation_rows(tagged)
    ahead = series.seasonal_lag_forecast(train, val, "total_cashflow")
    paired = evaluate.pair_with_actuals(ahead, val, "total_cashflow", [])
    rounded = [F.round(c, 3).alias(c) for c in ("mae", "rmse", "mape")]
    return evaluate.error_metrics(paired).select("val_rows", *rounded)


def run_leaderboard(spark, sf):
    logged = runs.evaluation_runs(_naive_metrics(spark, sf), PAIR, "pairs", HORIZON)
    board = runs.compare_runs(logged, "val_rmse", "evaluation")
    return board.select("run_id", "stage", F.round("val_rmse", 3).alias("val_rmse"))


# --- order search -------------------------------------------------------------------------


def trial_plan(spark, sf):
    pairs_known = star.sales_panel(spark, sf).select(*PAIR).distinct()
    return tuning.plan_trials(pairs_known)


def _made_trials(spark, sf) -> DataFrame:
    """Trial scores derived from line items, with ties, failures, NaN and infinities."""
    line = star.table(spark, sf, "lineitem")
    supplier = star.table(spark, sf, "supplier")
    part = star.table(spark, sf, "part")
    number = F.col("trial_id")
    score = F.floor(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")) / 100000).cast("double")
    return (
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("s_nationkey").cast("int").alias("store_nbr"),
            F.col("p_type").alias("family"),
            (F.col("l_linenumber") * 19).alias("trial_id"),
        )
        .agg(score.alias("score"), F.count(F.lit(1)).cast("int").alias("n_obs"))
        .withColumn(
            "aic",
            F.when(number == 38, None)
            .when((number == 57) | (F.col("store_nbr") == 24), F.lit(float("nan")))
            .when(number == 95, F.lit(float("-inf")))
            .otherwise(F.col("score")),
        )
        .withColumn("bic", F.col("aic") + 10)
        .withColumn("converged", number != 38)
        .select("*", *tuning.order_columns(number))
        .withColumn("intercept", F.lit(0))
        .withColumn("sigma2", F.lit(1.0))
        .withColumn("params", F.array(F.lit(0.5)))
    )


def trial_selection(spark, sf):
    best = tuning.best_trials(_made_trials(spark, sf), PAIR)
    return best.select(
        *PAIR, "trial_id", *tuning.ORDER_COLS, "aic", "converged", "total_trials",
        "successful_trials",
    )


def run_log(spark, sf):
    logged = runs.trial_runs(_made_trials(spark, sf), PAIR, "grid")
    return logged.select(
        "run_id",
        "stage",
        F.try_element_at("params", F.lit("training_rows")).alias("training_rows"),
        F.try_element_at("metrics", F.lit("aic")).alias("aic"),
        F.try_element_at("metrics", F.lit("bic")).alias("bic"),
    )


def run_summary(spark, sf):
    best = tuning.best_trials(_made_trials(spark, sf), PAIR)
    logged = runs.summary_runs(best, PAIR, "grid")
    return logged.select(
        "run_id",
        F.try_element_at("params", F.lit("best_p")).alias("best_p"),
        F.try_element_at("params", F.lit("successful_fits")).alias("successful_fits"),
        F.try_element_at("metrics", F.lit("best_aic")).alias("best_aic"),
    )


def orders_round_trip(spark, sf):
    """Chosen orders as JSON text and back."""
    best = tuning.best_trials(_made_trials(spark, sf), PAIR)
    return sinks.orders_from_json(sinks.orders_json(best, PAIR), PAIR).drop("bic")


def grid_total(spark, sf):
    """All 144 orders on the day totals."""
    days = total.keyed(features.total_features(*_past(spark, sf)))
    train = split.train_rows(split.tag_holdout(days, HORIZON))
    packed = runs.checkpointed(series.pack_series(train, total.KEY, "total_cashflow", EXOG))
    cores = spark.sparkContext.defaultParallelism
    return tuning.grid_search(packed, total.KEY, len(EXOG), blocks=cores).drop("params")


def grid_best(spark, sf):
    """Best of all 144 orders for every pair."""
    tagged = split.tag_holdout(features.pair_features(*_past(spark, sf)), HORIZON, PAIR)
    packed = runs.checkpointed(series.pack_series(split.train_rows(tagged), PAIR, "sales", EXOG))
    trials = tuning.grid_search(packed, PAIR, len(EXOG))
    return tuning.best_trials(trials, PAIR).drop("params")


def pair_fit(spark, sf):
    """One given order with all regressors for every pair."""
    days = features.pair_features(*_past(spark, sf))
    packed = runs.checkpointed(series.pack_series(days, PAIR, "sales", EXOG))
    order = {"p": 1, "q": 1, "seasonal_d": 1, "seasonal_q": 1}
    return tuning.fit_orders(packed, order, PAIR, len(EXOG)).drop("params")


def pair_forecast(spark, sf):
    return pairs.pair_forecasts(*_asked(spark, sf))["forecast"]


def pair_forecast_train_history(spark, sf):
    return pairs.pair_forecasts(*_asked(spark, sf), history="train")["forecast"]


def pair_evaluation(spark, sf):
    return pairs.pair_forecasts(*_asked(spark, sf))["metrics"]


def tuned_submission(spark, sf):
    rolled = star.rolled_panel(spark, sf)
    recent = star.recent_days(spark, sf, h=HORIZON, rolled=rolled)
    return topdown.top_down(*_asked(spark, sf, rolled), recent=recent)["submission"]


def auto_order(spark, sf):
    days = total.keyed(features.total_features(*_past(spark, sf), with_dow=False))
    train = split.train_rows(split.tag_holdout(days, HORIZON))
    packed = series.pack_series(train, total.KEY, "total_cashflow", total.CALENDAR_EXOG)
    cores = spark.sparkContext.defaultParallelism
    trials = tuning.stepwise_search(
        packed, total.KEY, len(total.CALENDAR_EXOG), blocks=cores, differences=diagnostics.differences(packed, total.KEY)
    )
    best = tuning.best_trials(trials, total.KEY)
    return best.withColumn("n_params", F.size("params")).drop("params")


def forecast_given_model(spark, sf):
    """Fifteen days ahead of every pair with one given seasonal ARMA model."""
    days = features.pair_days(star.sales_panel(spark, sf))
    packed = runs.checkpointed(series.pack_series(days, PAIR, "sales", []))
    orders = {"p": 1, "q": 1, "seasonal_q": 1}
    model = packed.select(
        *PAIR, *[F.lit(orders.get(c, 0)).alias(c) for c in (*tuning.ORDER_COLS, "intercept")],
        F.array(F.lit(0.5), F.lit(0.3), F.lit(0.2)).alias("params"),
    )
    last = F.array_max("dates")
    ahead = F.sequence(F.date_add(last, 1), F.date_add(last, HORIZON))
    asked = packed.select(*PAIR, ahead.alias("dates"), F.array().cast("array<array<double>>").alias("x"))
    out = forecast.forecast_series(model, packed, asked, PAIR, 0)
    return out.select(*PAIR, "step", F.round("forecast", 4).alias("forecast"))


def pair_submission_complete(spark, sf):
    """What the sales of a request rest on, where some pairs have a short history or none, and
    some no price on any day they ask for."""
    history, request, oil, holidays = _asked(spark, sf)
    kind = F.pmod("store_nbr", F.lit(5))
    cutoff = F.lit(history.agg(F.max("date")).first()[0])
    cut = history.where((kind > 1) | ((kind == 0) & (F.col("date") > F.date_sub(cutoff, 25))))
    space = dict.fromkeys(tuning.ORDER_COLS, [0]) | {"seasonal_d": [1]}
    out = pairs.pair_forecasts(cut, request, oil, holidays, space=space)["forecast"]
    return out.groupBy("basis").agg(
        F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.count("sales").alias("answered")
    )


AVERAGE_ORDER = ("p", "q", "seasonal_p", "seasonal_q")


def _linear_trials(spark, sf) -> DataFrame:
    return linear.linear_trials(features.pair_days(star.sales_panel(spark, sf)), PAIR)


def linear_grid(spark, sf):
    """All orders without moving averages for every pair, by Spark alone."""
    trials = _linear_trials(spark, sf)
    first = F.round(F.get("params", F.lit(0)), 6).alias("first")
    order = ["p", "d", "seasonal_p", "seasonal_d"]
    return trials.select(*PAIR, *order, "n_obs", first, F.round("aic", 4).alias("aic"))


def linear_best(spark, sf):
    return linear.linear_best(_linear_trials(spark, sf), PAIR).drop("aic")


def _two_stage_trials(spark, sf) -> DataFrame:
    return linear.two_stage_trials(features.pair_days(star.sales_panel(spark, sf)), PAIR, d=1)


def ma_two_stage(spark, sf):
    """Moving averages of every pair's first difference in two regressions: the last coefficient and the AIC of each order."""
    trials = _two_stage_trials(spark, sf)
    last = F.when(F.col("aic").isNotNull(), F.round(F.try_element_at("params", F.lit(-1)), 5)).alias("last")
    return trials.select(*PAIR, *AVERAGE_ORDER, "n_obs", last, F.round("aic", 4).alias("aic"))


def ma_two_stage_best(spark, sf):
    return linear.linear_best(_two_stage_trials(spark, sf), PAIR, AVERAGE_ORDER).drop("aic")


def _packed_pairs(spark, sf) -> DataFrame:
    return series.pack_series(features.pair_days(star.sales_panel(spark, sf)), PAIR, "sales", [])


def kpss_level(spark, sf):
    """The level test of every pair's series and of its first difference, and the differences that follow."""
    found = diagnostics.level_differences(_packed_pairs(spark, sf), PAIR)
    rounded = [F.round(c, 6).alias(c) for c in ("kpss", "kpss_1")]
    return found.select(*PAIR, "n_obs", *rounded, "d")


def seasonal_strength(spark, sf):
    found = diagnostics.season_differences(_packed_pairs(spark, sf), PAIR)
    return found.select(*PAIR, F.round("strength", 6).alias("strength"), "seasonal_d")


def linear_exog_fit(spark, sf):
    """The same orders with the four regressors: the last coefficient of each regression, and its AIC."""
    trials = linear.linear_trials(features.pair_features(*_tables(spark, sf)), PAIR, exog=EXOG)
    last = F.round(F.try_element_at("params", F.lit(-1)), 5).alias("last")
    order = ["p", "d", "seasonal_p", "seasonal_d"]
    return trials.select(*PAIR, *order, "n_obs", last, F.round("aic", 4).alias("aic"))


def total_forecast(spark, sf):
    return total.total_forecast(*_past(spark, sf))["forecast"]


# --- results, runs, registry --------------------------------------------------------------


def _result_lines(spark, sf) -> DataFrame:
    """A result line per panel row, in the five shapes a result file can have."""
    rows = star.sales_panel(spark, sf)
    sales, number = F.col("sales").cast("string"), F.col("id").cast("string")
    item = F.concat(F.lit('{"id": '), number, F.lit(', "sales": '), sales, F.lit("}"))
    shape = F.pmod(F.col("id"), F.lit(5))
    text = (
        F.when(shape == 0, F.concat(F.lit('{"instance": [1, 2], "prediction": '), sales, F.lit("}")))
        .when(shape == 1, F.concat(F.lit('{"predictions": ['), sales, F.lit(", null, 7]}")))
        .when(shape == 2, F.concat(F.lit('{"prediction": '), item, F.lit("}")))
        .when(shape == 3, F.lit('{"prediction": null, "predictions": [1, 2]}'))
        .otherwise(F.concat(F.lit('{"prediction": ['), item, F.lit(", "), item, F.lit("]}")))
    )
    return rows.select(F.col("id").alias("line"), text.alias("value"))


def jsonl_flatten(spark, sf):
    return requests.flatten_results(_result_lines(spark, sf))


def quarantined(spark, sf):
    return predictions.quarantine(jsonl_flatten(spark, sf)).select("line")


def submission_by_position(spark, sf):
    values = star.sales_panel(spark, sf).select(
        F.col("id").alias("line"), F.col("sales").cast("double").alias("sales")
    )
    ids = star.sales_panel(spark, sf).where(F.col("id") % 3 != 0).select((F.col("id") + 1).alias("id"))
    matched = predictions.match_by_position(values, ["line"], ids, ["id"])
    return predictions.submission(matched)


def results_submission(spark, sf):
    """Result lines of all shapes written to files and read again; predictions take the ids of a request in file order."""
    folder = f"{runs.shared_folder(spark)}/results-{uuid4().hex}"
    _result_lines(spark, sf).sort("line").select("value").write.text(folder)
    ids = star.sales_panel(spark, sf).where(F.col("id") % 3 != 0).select((F.col("id") + 1).alias("id"))
    return results.results_to_submission(spark, folder, ids, ["id"], with_ids=False, files="part-*")["submission"]


def data_profile(spark, sf):
    number = F.col("id")
    gaps = star.sales_panel(spark, sf).withColumns(
        {
            "sales": F.when(number % 7 != 0, F.col("sales")),
            "family": F.when(number % 11 != 0, F.col("family")),
        }
    )
    out = profile.profile(gaps, "sales")
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std")]
    return out.select(*[c for c in out.columns if c not in ("mean", "std")], *rounded)


def oil_profile(spark, sf):
    out = profile.profile(star.oil(spark, sf), "dcoilwtico")
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std")]
    return out.select(*[c for c in out.columns if c not in ("mean", "std")], *rounded)


def date_range(spark, sf):
    return profile.date_range(star.sales_panel(spark, sf))


def negatives_floored(spark, sf):
    days = features.pair_days(star.sales_panel(spark, sf)).select(*PAIR, "date", "sales")
    return forecast.floored_count(series.difference(days, PAIR, "sales", [1]), "sales")


def _registry(spark, sf) -> DataFrame:
    return star.table(spark, sf, "orders").select(
        F.concat(F.lit("model-"), F.col("o_custkey").cast("string")).alias("display_name"),
        F.col("o_orderkey").alias("version"),
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("artifact"),
        F.col("o_orderdate").cast("date").alias("create_time"),
    )


def latest_model(spark, sf):
    return runs.latest_versions(_registry(spark, sf))


def next_version(spark, sf):
    return runs.next_versions(_registry(spark, sf))


def registration_log(spark, sf):
    logged = runs.registration_runs(_registry(spark, sf), "registry")
    return logged.select(
        "run_id", "stage", F.try_element_at("params", F.lit("artifact_uri")).alias("artifact")
    )


def batch_log(spark, sf):
    logged = runs.batch_runs(reconcile(spark, sf), "batch", "total", 2)
    counts = [F.try_element_at("metrics", F.lit(c)).alias(c) for c in ("input_rows", "output_rows")]
    return logged.select("run_id", "stage", *counts)


def log_fetch(spark, sf):
    events = star.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    found = runs.fetch_log(events, {"event_type": "error"}, ["ts", "event_id"])
    return found.select("event_id", "user_id", "event_type", "value")


# --- classifier ---------------------------------------------------------------------------


def hash_split(spark, sf):
    rows = split.fraction_split(star.table(spark, sf, "embeddings"), "vec_id")
    return rows.select("vec_id", "label", "bucket", "split")


def tree_scores(spark, sf):
    rows = split.fraction_split(star.table(spark, sf, "embeddings"), "vec_id")
    rows = classify.features_from_array(rows, "embedding")
    model = classify.fit_tree(rows.where(F.col("split") == "train"), "label")
    scored = classify.score_tree(model, rows.where(F.col("split") == "test"))
    return scored.select("vec_id", F.col("label").cast("string").alias("label"), "predicted_label")


def _stump_scores(spark, sf):
    line = star.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("int").alias("number"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.when(F.col("l_linenumber") * 3 + F.col("l_quantity") > 30, "large").otherwise("small").alias("label"),
    )
    rows = classify.features_from_columns(line, ["number", "discount"])
    return classify.score_tree(classify.fit_tree(rows, "label", depth=1), rows)


def tree_stump(spark, sf):
    """A tree of one split, where every split can be tried."""
    return _stump_scores(spark, sf).select("number", "discount", "predicted_label").distinct()


def stump_accuracy(spark, sf):
    return evaluate.accuracy(_stump_scores(spark, sf), "label", "predicted_label")


def tree_accuracy(spark, sf):
    return evaluate.accuracy(tree_scores(spark, sf), "label", "predicted_label")


QUERIES = {
    f.__name__: f
    for f in (
        daily_totals, oil_filled, holiday_flags, features_total, features_calendar, features_pair,
        target_series, holdout_split, holdout_split_pair, future_calendar, differenced_series,
        latest_days, batch_input, batch_input_pair, request_daily_exog, request_parse,
        request_lists, request_rejects, proportions, proportions_uniform, share_check, seasonal_lag_forecast,
        disaggregate, submission, reconcile, ols_exog_fit, ar1_fit, last_week_model,
        evaluate_metrics, seasonal_lag_metrics, run_leaderboard, trial_plan, trial_selection, run_log, run_summary,
        grid_total, grid_best, pair_fit, pair_forecast, pair_forecast_train_history,
        pair_evaluation, tuned_submission, auto_order, total_forecast, jsonl_flatten,
        quarantined, submission_by_position, data_profile, oil_profile, date_range,
        negatives_floored, latest_model, log_fetch, hash_split, tree_scores, tree_accuracy,
        orders_round_trip, forecast_given_model, pair_submission_complete, next_version,
        registration_log, batch_log, tree_stump, stump_accuracy, linear_grid, linear_best, linear_exog_fit, kpss_level, seasonal_strength,
        ma_two_stage, ma_two_stage_best, results_submission,
    )
}
