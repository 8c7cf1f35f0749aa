import csv
import io
import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from conftest import SALES, frame
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from demandloom.operators import classify, evaluate, features, predictions, runs
from demandloom.plans import results
from demandloom.schemas import BEAN_FEATURES, EXOG, INSTANCE_COLS, PAIR
from demandloom.sources import requests, sinks, tables


def write_csv(path, text):
    path.write_text(text)
    return str(path)


def test_csv_sources(spark, tmp_path):
    sales = tables.read_sales(
        spark,
        write_csv(
            tmp_path / "train.csv",
            "id,date,store_nbr,family,sales,onpromotion\n0,2017-08-01,1,AUTOMOTIVE,10.0,0\n1,2017-08-02,1,\"A, B\",,5\n",
        ),
    )
    rows = sales.collect()
    assert rows[0].date == date(2017, 8, 1) and rows[1].sales is None and rows[1].family == "A, B"
    oil = tables.read_oil(spark, write_csv(tmp_path / "oil.csv", "date,dcoilwtico\n2017-08-01,\n2017-08-02,50.5\n"))
    assert [r.dcoilwtico for r in oil.collect()] == [None, 50.5]
    free = tables.read_holidays(
        spark,
        write_csv(
            tmp_path / "h.csv",
            "date,type,locale,locale_name,description,transferred\n2017-08-01,Holiday,National,X,Y,False\n2017-08-02,Event,National,X,Y,True\n",
        ),
    )
    assert [r.transferred for r in free.collect()] == [False, True]


def test_parquet_round_trip_prunes_and_pushes(spark, sales, tmp_path):
    sinks.write_dataset(sales, str(tmp_path / "p"))
    back = tables.read_sales(spark, str(tmp_path / "p"), "parquet")
    plan = features.target_series(back, 1, "BEVERAGES").select("sales")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(store_nbr,1)" in text and "EqualTo(family,BEVERAGES)" in text
    assert "onpromotion" not in text
    assert plan.count() == 3
    sinks.write_dataset(sales, str(tmp_path / "c"), "csv")
    assert tables.read_sales(spark, str(tmp_path / "c")).count() == 12


def test_table_source(spark, sales):
    sales.createOrReplaceTempView("sales_view")
    assert tables.read_table(spark, "bq://sales_view").count() == 12


def test_forecast_and_submission_files(spark, tmp_path):
    out = frame(spark, "date date, predicted_cashflow double", [("2017-08-02", 2.0), ("2017-08-01", 1.0)])
    sinks.write_latest_forecast(out, str(tmp_path / "f"))
    sinks.write_latest_forecast(out, str(tmp_path / "f"))
    parts = list((tmp_path / "f").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[1].startswith("2017-08-01")
    sub = spark.createDataFrame([(1, "x", 2.5)], "id bigint, other string, sales double")
    sinks.write_submission(sub, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).columns == ["id", "sales"]


def test_instance_files(spark, request_rows, oil, holidays, tmp_path):
    inst = features.request_instances(request_rows, oil, holidays).fillna(1.0, ["oil_price"])
    sinks.write_instances(inst, str(tmp_path / "i"))
    text = "".join(part.read_text() for part in (tmp_path / "i").glob("part-*.csv"))
    assert text.splitlines()[0].replace('"', "") == ",".join(INSTANCE_COLS) and '"2017-08-16"' in text
    back = spark.read.schema(inst.schema).option("header", True).csv(str(tmp_path / "i"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, inst.collect()))
    sinks.write_exog_only(inst, str(tmp_path / "e"))
    assert spark.read.option("header", True).csv(str(tmp_path / "e")).columns == EXOG


def test_only_texts_are_quoted(spark, tmp_path):
    """Byte for byte what Python's writer gives with QUOTE_NONNUMERIC."""
    rows = [
        (1, "plain", 2.5, "2017-08-16"), (2, 'has "quotes", commas', -0.0, None), (-3, "", 12345678.0, "2017-08-17"),
        (4, " blanks kept ", 0.001, "x"), (5, "\\ back\\slash", 1e15, "ü"),
    ]
    kinds = "id bigint, `a \"name\"` string, value double, date string"
    sinks._write_lines(sinks.csv_lines(spark.createDataFrame(rows, kinds).coalesce(1)), str(tmp_path / "q"))
    want = io.StringIO()
    out = csv.writer(want, quoting=csv.QUOTE_NONNUMERIC, lineterminator="\n")
    out.writerows([("id", 'a "name"', "value", "date"), *rows])
    assert next((tmp_path / "q").glob("part-*.csv")).read_bytes().decode() == want.getvalue()


def test_ids_come_back_by_line(spark, tmp_path):
    rows = [(900 - k, f"2017-08-{10 + k % 7}", *[float(k + 10 * j) for j in range(3)], k % 7) for k in range(50)]
    kinds = "id bigint, date string, onpromotion double, oil_price double, is_holiday double, day_of_week int"
    sinks.write_exog_only(spark.createDataFrame(rows, kinds).repartition(4), str(tmp_path / "e"), str(tmp_path / "ids"))
    lines = [l for part in sorted((tmp_path / "e").glob("part-*.csv")) for l in part.read_text().splitlines()[1:]]
    answers = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "position long, line string")
    got = {r.id: float(r.line.split(",")[0]) for r in sinks.with_ids(answers, str(tmp_path / "ids")).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_version_tables(spark, tmp_path):
    props = spark.createDataFrame([(1, "A", 1.0)], "store_nbr int, family string, proportion double")
    sinks.write_version_table(props, str(tmp_path), "total", 3)
    assert sinks.read_version_table(spark, str(tmp_path), "total", 3).first().proportion == 1.0
    props.write.parquet(str(tmp_path / "plain"))
    assert tables.read_shares(spark, str(tmp_path / "plain")).count() == 1


def test_request_parsing(spark):
    by_name = {
        "id": "7", "date": "2017-08-16", "store_nbr": "1.0", "family": "A", "onpromotion": "2",
        "oil_price": "n/a", "is_holiday": "0", "day_of_week": "2",
    }
    by_place = [8, "2017-08-17", 2, "B", 1, 50.5, 1.0, 3]
    body = json.dumps({"instances": [by_name, by_place]})
    out = {r.id: r for r in requests.parse_instances(spark.createDataFrame([(body,)], "body string")).collect()}
    assert out[7].store_nbr == 1 and out[7].onpromotion == 2.0 and out[7].oil_price != out[7].oil_price
    assert tuple(out[8]) == (8, date(2017, 8, 17), 2, "B", 1.0, 50.5, 1.0, 3)
    broken = json.dumps({"instances": [by_name | {"id": "x"}]})
    bodies = [(k, b) for k, b in enumerate([broken, body[:-5], "no JSON", "{}", body, None])]
    mixed = spark.createDataFrame(bodies, "line int, body string")
    assert sorted(r.id for r in requests.parse_instances(mixed).collect()) == [7, 8]
    bad = {(r.line, r.pos): r.reason for r in requests.rejected_instances(mixed).collect()}
    missing = "body has no list of instances"
    assert bad == {(0, 0): "id is not a number"} | {(k, None): missing for k in (1, 2, 3, 5)}
    lists = json.dumps({"instances": [[0, 50.0, 0, 1], [3, 51.0, 1, 2]]})
    odd = spark.createDataFrame([('{"instances": [[1, "x", 0, 2], [4, 5, 6, 7]]}',), ("[",)], "body string")
    assert [r.oil_price == r.oil_price for r in requests.parse_exog_lists(odd).collect()] == [False, True]
    assert [r.body for r in requests.rejected_bodies(odd).collect()] == ["["]
    steps = requests.parse_exog_lists(spark.createDataFrame([(lists,)], "body string")).collect()
    assert [tuple(r) for r in steps] == [(1, 0.0, 50.0, 0.0, 1.0), (2, 3.0, 51.0, 1.0, 2.0)]


def test_result_files(spark, tmp_path):
    a = [
        {"instance": [1], "prediction": 1.5},
        {"predictions": [2.5, None]},
        {"prediction": {"id": 7, "sales": -3.0, "family": "A"}},
    ]
    b = [
        {"prediction": None, "predictions": [9]},
        {"prediction": [{"id": 8, "sales": 4.0}, {"id": 9, "sales": 5.0}]},
        {"other": 1},
    ]
    (tmp_path / "sub").mkdir()
    (tmp_path / "prediction.results-00000-of-00002").write_text("\n".join(map(json.dumps, a)) + "\n\n")
    (tmp_path / "sub" / "prediction.results-00001-of-00002").write_text("\n".join(map(json.dumps, b)))
    (tmp_path / "prediction.errors_stats-0").write_text(json.dumps({"prediction": 99}))
    out = requests.flatten_results(requests.read_result_lines(spark, str(tmp_path)))
    rows = out.orderBy("file_path", "file_block_start", "line", "place").collect()
    assert [(r.id, r.sales) for r in rows] == [
        (None, 1.5), (None, 2.5), (None, None), (7, -3.0), (None, None), (8, 4.0), (9, 5.0), (None, None),
    ]
    sub = {r.id: r.sales for r in predictions.submission(out.where("id IS NOT NULL")).collect()}
    assert sub == {7: 0.0, 8: 4.0, 9: 5.0}
    assert predictions.quarantine(out).count() == 3


def test_ids_by_position(spark, tmp_path):
    for part in range(3):
        lines = [json.dumps({"prediction": float(10 * part + k)}) for k in range(10)]
        (tmp_path / f"prediction.results-0000{part}-of-00003").write_text("\n".join(lines))
    flat = requests.flatten_results(requests.read_result_lines(spark, str(tmp_path)))
    ids = spark.range(25).select((F.col("id") + 100).alias("id"))
    order = ["file_path", "file_block_start", "line", "place"]
    got = {r.id: r.sales for r in predictions.match_by_position(flat, order, ids, ["id"]).collect()}
    assert got == {100 + k: float(k) for k in range(25)}


def test_results_to_submission(spark, tmp_path):
    lines = [{"prediction": 5.0}, {"prediction": None}, {"predictions": [-1.0, 2.0]}]
    (tmp_path / "prediction.results-00000-of-00001").write_text("\n".join(map(json.dumps, lines)))
    ids = spark.createDataFrame([(10,), (11,), (12,), (13,), (14,)], "id bigint")
    out = results.results_to_submission(spark, str(tmp_path), ids, ["id"], with_ids=False)
    assert {r.id: r.sales for r in out["submission"].collect()} == {10: 5.0, 12: 0.0, 13: 2.0}
    assert [r.id for r in out["quarantine"].collect()] == [11]
    counts = out["counts"].first()
    assert (counts.input_rows, counts.prediction_count, counts.output_rows) == (5, 4, 3)
    assert (counts.ids_without_output, counts.unexpected_ids) == (2, 0)
    logged = runs.batch_runs(out["counts"], "batch", "total", 2).first()
    assert logged.metrics == {"input_rows": 5.0, "output_rows": 3.0, "prediction_count": 4.0}


def test_position_is_global(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("k"))
    rows = runs.with_position(df, ["k"]).orderBy("k").collect()
    assert [r.position for r in rows] == list(range(1000))


def test_file_positions_need_no_sort(spark, tmp_path):
    """Small splits, so that files have many and a task reads several; blank lines and long lines among them."""
    want = []
    for k in range(4):
        lines = [f"{k}-{i}-" + "x" * (i % 90) if i % 7 else "" for i in range(300 - 70 * k)]
        (tmp_path / f"prediction.results-{k}").write_text("\n".join(lines) + "\n")
        want += lines
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = requests.read_result_lines(spark, str(tmp_path))
        assert lines.select("file_path", "file_block_start").distinct().count() > 20
        placed = runs.with_file_position(lines, results.FILE_BLOCK)
        plan = placed._jdf.queryExecution().sparkPlan().toString()
        got = placed.orderBy("position").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r.position for r in got] == list(range(len(want))) and [r.value for r in got] == want
    assert "Sort" not in plan and "BroadcastHashJoin" in plan
    assert runs.with_file_position(lines.limit(0), results.FILE_BLOCK).count() == 0


def test_reconcile(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    made = spark.createDataFrame([(1, 1.0), (2, None), (9, 2.0)], "id bigint, sales double")
    row = predictions.reconcile(asked, made).first()
    assert tuple(row) == (3, 3, 2, 2, 1)


def test_runs_and_registry(spark, tmp_path):
    metrics = spark.createDataFrame(
        [(1, "A", 15, 2.0, 3.0, float("nan")), (1, "B", 15, 1.0, 1.5, 10.0)],
        "store_nbr int, family string, val_rows int, mae double, rmse double, mape double",
    )
    log = str(tmp_path / "runs")
    runs.append_rows(runs.evaluation_runs(metrics, PAIR, "pairs", 15), log)
    runs.append_rows(runs.evaluation_runs(metrics, PAIR, "again", 15), log)
    board = runs.compare_runs(spark.read.parquet(log), "val_rmse", "evaluation").collect()
    assert [r.val_rmse for r in board] == [1.5, 1.5, 3.0, 3.0]
    assert board[2].metrics["val_mape"] == -1.0 and board[0].params["forecast_horizon"] == "15"
    assert {r.experiment for r in board} == {"pairs", "again"}

    path = str(tmp_path / "registry")
    assert [runs.register_version(spark, path, "total", f"m/{k}") for k in range(2)] == [1, 2]
    assert runs.register_version(spark, path, "other", "m/x") == 1
    registry = spark.read.schema(runs.REGISTRY).parquet(path)
    newest = runs.latest_version(registry, "total")
    assert newest["version"] == 2 and newest["artifact"] == "m/1"
    logged = runs.registration_runs(registry.where("version = 2"), "models").first()
    assert logged.params["artifact_uri"] == "m/1" and logged.metrics == {}
    with pytest.raises(ValueError, match="missing"):
        runs.latest_version(registry, "missing")


def test_latest_goes_by_time_then_version(spark):
    t = datetime(2017, 1, 1)
    rows = [("m", 3, "a", "", t), ("m", 4, "b", "", t), ("m", 9, "c", "", datetime(2016, 1, 1))]
    registry = spark.createDataFrame(rows, runs.REGISTRY)
    assert runs.latest_version(registry, "m")["version"] == 4


def test_log_fetch(spark):
    rows = [("job", "7" if k % 2 else "8", k) for k in range(200)]
    events = spark.createDataFrame(rows, "resource_type string, job_id string, at int")
    got = runs.fetch_log(events, {"resource_type": "job", "job_id": "7"}, ["at"]).collect()
    assert [r.at for r in got] == list(range(1, 100, 2))


def test_beans(spark, tmp_path):
    train = spark.range(300).select(
        *[(F.col("id") % 3 * 10 + F.hash(F.lit(c), "id") % 3).cast("double").alias(c) for c in BEAN_FEATURES],
        F.concat(F.lit("CLASS"), F.col("id") % 3).alias("Class"),
    )
    model = classify.fit_tree(classify.features_from_columns(train))
    head = ",".join(BEAN_FEATURES)
    text = "\n".join([head, ",".join(["0.5"] * 16), ",".join(["20.5"] * 16)])
    asked = tables.read_bean_examples(spark, write_csv(tmp_path / "b.csv", text))
    scored = classify.score_tree(model, classify.features_from_columns(asked))
    assert [r.predicted_label for r in scored.collect()] == ["CLASS0", "CLASS2"]
    on_train = classify.score_tree(model, classify.features_from_columns(train))
    assert evaluate.accuracy(on_train, "Class", "predicted_label").first().accuracy == 1.0


@pytest.mark.parametrize("leaf_rows", [100_000, 40])
def test_subtrees_are_those_of_spark_ml(spark, monkeypatch, leaf_rows):
    """Labels without any rule, ties and doubled rows: the tree goes deep. Small leaves make the top grow further."""
    monkeypatch.setattr(classify, "LEAF_ROWS", leaf_rows)
    numbers = [F.pmod(F.hash(F.lit(c), F.col("id") % 400), F.lit(m)) for c, m in enumerate((5, 40, 300))]
    rows = spark.range(900).select(
        "id", F.array(*numbers, -numbers[2] / 7.0, F.lit(0.0)).cast("array<double>").alias("x"),
        F.pmod(F.hash(F.lit("label"), F.col("id") % 700), F.lit(4)).alias("label"),
    )
    rows = classify.features_from_array(rows, "x").coalesce(2).cache()
    model = classify.fit_tree(rows, "label")
    indexer = StringIndexer(inputCol="label_text", outputCol="label_index")
    text = rows.withColumn("label_text", F.col("label").cast("string"))
    whole = DecisionTreeClassifier(labelCol="label_index", maxDepth=30, maxBins=128, seed=0)
    known = indexer.fit(text)
    tree = whole.fit(known.transform(text))
    asked = rows.union(rows.withColumn("features", array_to_vector(F.transform("x", lambda v: v * 1.03 - 0.4))))
    expected = [known.labels[int(r.prediction)] for r in tree.transform(asked).select("prediction").collect()]
    got = [r.predicted_label for r in classify.score_tree(model, asked).select("predicted_label").collect()]
    assert got == expected and tree.depth > 12
    assert len(model.roots) > 5 and model.top.depth <= (8 if leaf_rows > 40 else 16) < tree.depth + 5


def test_null_ids_are_not_lost_from_sales(spark):
    rows = [(None, "2017-08-01", 1, "A", 1.0, 0)]
    assert features.daily_totals(frame(spark, SALES, rows)).count() == 1


def test_writers_beside_each_other_lose_and_double_no_version(spark, tmp_path):
    path = str(tmp_path / "registry")

    def add(writer):
        return [runs.register_version(spark, path, "total", f"m/{writer}/{k}") for k in range(4)]

    with ThreadPoolExecutor(4) as pool:
        given = [v for versions in pool.map(add, range(4)) for v in versions]
    assert sorted(given) == list(range(1, 17))
    rows = spark.read.parquet(path).collect()
    assert sorted(r.version for r in rows) == list(range(1, 17)) and len({r.artifact for r in rows}) == 16
    assert runs.register_version(spark, path, "other", "m/x") == 1
