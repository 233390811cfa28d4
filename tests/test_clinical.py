"""Clinical sources, intakes, regions, classifiers, storage and streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from casecurve.functions.geo import map_x, map_y, marker_radius
from casecurve.functions.text import repaired_gender, skin_flag, terminal_gender
from casecurve.operators import classify, intake, regions
from casecurve.plans import screening
from casecurve.sources import models, readers, stores
from casecurve.streaming import alerts as alert_stream
from casecurve.streaming.screening import start_screening


def test_gender_and_skin_answers(spark):
    df = spark.createDataFrame([("  male ",), ("M",), ("Other",), ("female",), (None,)], "g string")
    assert [r[0] for r in df.select(repaired_gender(F.col("g"))).collect()] == ["Male", "Male", "Female", "Female", "Female"]
    assert [r[0] for r in df.select(terminal_gender(F.col("g"))).collect()] == ["Male", "Male", "Male", "Female", "Male"]
    answers = spark.createDataFrame([("Yes",), ("rash",), ("no",), ("",), (None,)], "s string")
    assert [r[0] for r in answers.select(skin_flag(F.col("s"))).collect()] == [1, 1, 0, 0, 0]
    numbers = spark.createDataFrame([(1.0,), (0.5,), (0.0,)], "n double")
    assert [r[0] for r in numbers.select(skin_flag(F.col("n"), "number")).collect()] == [1, 1, 0]


def raw_sources(spark):
    first = spark.createDataFrame(
        [("34", " male", "1", "4", "Yes", "150", "4.5"), ("old", "FEMALE", "1", "3", "?", "bad", "6")],
        "Age string, Gender string, Fever string, Fever_Duration string, Rash string, PLT string, WBC string",
    )
    second = spark.createDataFrame(
        [
            ("50", "Female", "12", "no", "210000", "7000", "Acute Typhoid Fever"),
            ("20", "Male", "", "no", "220000", "7100", "Relapsing Typhoid"),
            ("60", "Male", "9", "no", "1", "1", "Suspected"),
        ],
        "Age string, Gender string, `Fever Duration (Days)` string, `Skin Manifestations` string, `Platelet Count` string, "
        "`White Blood Cell Count` string, `Typhoid Status` string",
    )
    return first, second


def test_two_sources_one_shape(spark):
    first, second = raw_sources(spark)
    rows = intake.unified_records(intake.dengue_records(first), intake.typhoid_records(second), impute=False)
    out = {(r.disease, r.gender): r for r in rows.collect()}
    assert len(out) == 4
    assert out["Dengue", "Male"].platelet_count == 150000.0 and out["Dengue", "Male"].wbc == 4500.0
    assert out["Dengue", "Female"].age is None and out["Dengue", "Female"].skin_manifestation is None
    assert out["Typhoid", "Male"].fever == 0.0 and out["Typhoid", "Male"].fever_duration is None
    filled = intake.unified_records(intake.dengue_records(first), intake.typhoid_records(second))
    assert filled.where("age is null or fever_duration is null or platelet_count is null").count() == 0
    assert filled.where("disease = 'Dengue' and gender = 'Female'").first().age == 34.0
    assert intake.dengue_records(first, scale_labs=False).first().wbc == 4.5


INTAKE = "patient_code string, age int, gender string, fever_duration_days int, skin_manifestation boolean"


def test_rejected_intakes_carry_a_reason(spark):
    df = spark.createDataFrame(
        [("P1", 30, "Male", 4, True), ("P2", 121, "Male", 4, True), ("P3", 3, "x", 4, True), ("P4", 3, "Other", 0, True), ("P5", 3, "Female", 2, None), ("", 3, "Male", 2, True)],
        INTAKE,
    )
    reasons = [r.reason for r in intake.checked_intakes(df).collect()]
    assert reasons[0] is None and all(reasons[1:]) and len(set(reasons[1:])) == 5
    assert intake.valid_intakes(df).count() == 1


def test_region_operators(spark):
    rows = [
        (1, "North", "Alpha", "Dengue", "Critical", 100, "Aedes", ["City Hospital"], 1.25),
        (2, "South", "Beta", "Typhoid", "Normal", 0, None, None, 0.5),
        (3, "West", "Alphaville", "Dengue", "Alert", 10, "Water", ["Mission"], None),
    ]
    df = spark.createDataFrame(
        rows, "id int, name string, province string, primary_disease string, risk_level string, projected_cases int, dominant_vector string, "
        "sentinel_hospitals array<string>, population_at_risk_millions double",
    )
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(regions.filter_regions(df, disease="dengue ", province="ALPHA")) == [1, 3]
    assert ids(regions.filter_regions(df, province="Alpha", exact_province=True)) == [1]
    assert ids(regions.search_regions(df, "MISSION")) == [3]
    assert ids(regions.search_regions(df, "  ")) == [1, 2, 3]
    total = regions.region_rollup(df, regions.region_condition(risk_level="alert")).first()
    assert (total.total_regions, total.filtered_count, total.first_disease_cases, total.population_at_risk_millions) == (3, 1, 110, 1.8)
    pick = lambda s, c: regions.active_region(df, s, c).first().id
    assert pick("2", F.lit(True)) == 2 and pick("9", F.col("id") == 3) == 3 and pick(None, F.lit(False)) == 1
    place = df.select(map_x(F.lit(60.5)).alias("x"), map_y(F.lit(37.4)).alias("y"), marker_radius(F.col("risk_level"), F.col("projected_cases")).alias("r")).collect()
    assert (place[0].x, place[0].y) == (40.0, 35.0)
    assert [round(p.r, 6) for p in place] == [21.0, 12.0, 15.0]
    assert json.loads(regions.as_records(df, ("name", "risk_level")).where("id = 2").first().record) == {"name": "South", "risk_level": "Normal"}
    record = json.loads(regions.rollup_record(regions.region_rollup(df)).first().record)
    assert record["total_regions"] == 3 and record["summary_metrics"]["critical_hotspots"] == 1


@pytest.fixture(scope="module")
def labelled(spark):
    """Short fevers with a rash are Dengue, long ones without are Typhoid; a tenth is noise."""
    i = F.col("id")
    dengue = i % 4 == 0
    noisy = i % 10 == 3
    return spark.range(400).select(
        "id",
        F.when(dengue, "Dengue").otherwise("Typhoid").alias("disease"),
        (20 + i % 50).cast("double").alias("age"),
        F.when(i % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(dengue != noisy, 2 + i % 4).otherwise(9 + i % 7).cast("double").alias("fever_duration"),
        F.when(i % 37 == 0, None).when(dengue != noisy, 1.0).otherwise(0.0).alias("skin_manifestation"),
    )


NUMERIC, CATEGORICAL = ["age", "fever_duration", "skin_manifestation"], ["gender"]


@pytest.mark.parametrize("kind", ["forest", "logistic", "svm", "tree", "bayes"])
def test_every_classifier_learns_the_rule(spark, labelled, kind):
    fitted = classify.train_classifier(labelled, "disease", NUMERIC, CATEGORICAL, kind, "Dengue")
    out = classify.scored(labelled, fitted)
    assert out.where("disease = prediction").count() > 340
    means = {r.disease: r.m for r in out.groupBy("disease").agg(F.avg("score").alias("m")).collect()}
    assert means["Dengue"] > means["Typhoid"]
    first = out.first()
    assert set(first.probabilities) == {"Dengue", "Typhoid"}
    if kind == "svm":
        assert first.probabilities["Dengue"] == 0.5


def test_training_run_saving_and_loading(spark, labelled, tmp_path):
    fitted = classify.train_with_threshold(labelled, "id", "disease", "Dengue", NUMERIC, CATEGORICAL, "logistic")
    assert 0 < fitted.threshold < 1 and fitted.metrics["roc_auc"] > 0.8
    path = str(tmp_path / "model")
    models.save_classifier(spark, fitted, path)
    loaded = models.load_or_train(spark, [str(tmp_path / "missing"), path], lambda: pytest.fail("must not train"))
    assert (loaded.threshold, loaded.classes, loaded.positive) == (fitted.threshold, fitted.classes, "Dengue")
    a = classify.scored(labelled, fitted).select("id", "score", "prediction")
    assert a.exceptAll(classify.scored(labelled, loaded).select("id", "score", "prediction")).count() == 0
    fresh = models.load_or_train(spark, [str(tmp_path / "none")], lambda: fitted)
    assert fresh is fitted and models.load_classifier(spark, str(tmp_path / "none")).kind == "logistic"


def test_threshold_decides_two_classes(spark, labelled):
    fitted = classify.train_classifier(labelled, "disease", NUMERIC, CATEGORICAL, "logistic", "Dengue")
    fitted.threshold = 0.0
    assert classify.scored(labelled, fitted).where("prediction <> 'Dengue'").count() == 0
    fitted.threshold = 1.1
    out = classify.with_probability_columns(classify.scored(labelled, fitted), fitted)
    assert out.where("predicted_disease <> 'Typhoid'").count() == 0 and "prob_Dengue" in out.columns


def status(spark):
    rows = [("Dengue", dt.date(2024, 5, 1), 90.0, 40.0, 10.0, 5.0, "Critical", True), ("Typhoid", dt.date(2024, 5, 1), 40.0, 40.0, 10.0, 0.0, "Normal", False)]
    return spark.createDataFrame(
        rows, "series_id string, ds date, cases double, baseline_mean double, baseline_std double, z_score double, risk_level string, is_anomaly boolean"
    )


def intakes(spark):
    rows = [("P1", 28, "Male", 4, True), ("P2", 45, "Other", 14, False), ("P1", 28, "Male", 4, True), ("P3", 200, "Male", 4, True)]
    return spark.createDataFrame(rows, INTAKE)


def test_screening_with_context(spark, labelled):
    fitted = classify.train_classifier(labelled, "disease", NUMERIC, CATEGORICAL, "logistic", "Dengue")
    out = screening.screen(intake.valid_intakes(intakes(spark)), fitted, status(spark)).collect()
    assert len(out) == 3
    by_code = {r.patient_code: r for r in out}
    assert by_code["P1"].predicted_disease == "Dengue" and by_code["P1"].current_outbreak_risk == "Critical"
    assert by_code["P2"].predicted_disease == "Typhoid" and by_code["P2"].confidence >= 0.5
    assert by_code["P1"].details.startswith("Diagnosed Dengue with") and "'Critical' (Z=5.0)" in by_code["P1"].details


def test_streamed_screening_equals_the_batch(spark, labelled, tmp_path):
    fitted = classify.train_classifier(labelled, "disease", NUMERIC, CATEGORICAL, "logistic", "Dengue")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    intakes(spark).write.parquet(source)
    stream = spark.readStream.schema(INTAKE).parquet(source)
    start_screening(stream, fitted, status(spark), out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = screening.screen(intake.valid_intakes(intakes(spark)), fitted, status(spark))
    columns = ["patient_code", "predicted_disease", "confidence", "current_outbreak_risk"]
    assert streamed.count() == 3  # repeated patient codes are kept
    assert streamed.select(*columns).exceptAll(batch.select(*columns)).count() == 0


def test_repeated_requests_are_dropped(spark, labelled, tmp_path):
    fitted = classify.train_classifier(labelled, "disease", NUMERIC, CATEGORICAL, "logistic", "Dengue")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    now = dt.datetime(2024, 1, 1)
    rows = [("r1", now, "P1", 28, "Male", 4, True), ("r1", now, "P1", 28, "Male", 4, True), ("r2", now, "P1", 28, "Male", 4, True)]
    schema = "request string, at timestamp, " + INTAKE
    spark.createDataFrame(rows, schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source).withWatermark("at", "1 hour")
    start_screening(stream, fitted, status(spark), out, str(tmp_path / "cp"), "request", available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def event_files(spark, folder, batches):
    for i, days in enumerate(batches):
        rows = [(s, dt.datetime.fromisoformat(d)) for s, d in days]
        spark.createDataFrame(rows, "series_id string, event_ts timestamp").coalesce(1).write.parquet(f"{folder}/part={i}")


def test_streamed_alerts_follow_the_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    event_files(spark, source, [[("a", "2024-01-01 10:00")] * 6 + [("a", "2024-01-02 08:00")], [("a", "2024-01-02 09:00"), ("b", "2024-01-05 00:00")]])
    stream = spark.readStream.schema("series_id string, event_ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    baseline = spark.createDataFrame([("a", 2.0, 1.0)], "series_id string, mean double, std double")
    out = str(tmp_path / "out")
    alert_stream.start_alerting(stream, baseline, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    rows = {(r.series_id, r.window_start.day): r for r in alert_stream.current_windows(spark, out).collect()}
    assert {k: v.y for k, v in rows.items()} == {("a", 1): 6, ("a", 2): 2, ("b", 5): 1}
    assert rows["a", 1].risk_level == "Critical" and rows["a", 2].risk_level == "Normal"
    assert rows["b", 5].risk_level is None and not rows["b", 5].is_anomaly


def test_late_events_do_not_reopen_a_closed_window(spark, tmp_path):
    source = str(tmp_path / "in")
    event_files(spark, source, [[("a", "2024-01-01 10:00")] * 3 + [("a", "2024-01-09 10:00")]])
    stream = spark.readStream.schema("series_id string, event_ts timestamp").parquet(f"{source}/*")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    alert_stream.start_closed_windows(stream, out, checkpoint, available_now=True).awaitTermination()
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 11))], "series_id string, event_ts timestamp").write.parquet(f"{source}/part=9")
    alert_stream.start_closed_windows(stream, out, checkpoint, available_now=True).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert [(r.window_start.day, r.y) for r in rows] == [(1, 3)]


def test_stores(spark, tmp_path):
    path = str(tmp_path / "alerts")
    rows = spark.createDataFrame([("Dengue", "North", "Alert", 2.3456, "m", False)], "disease string, region string, risk_level string, z_score double, alert_message string, is_resolved boolean")
    stores.append(rows, path, stores.ALERTS_SCHEMA)
    stores.append(rows.withColumn("disease", F.lit("Typhoid")), path, stores.ALERTS_SCHEMA)
    stored = stores.read_store(spark, path, stores.ALERTS_SCHEMA)
    assert stored.where("created_at is not null").count() == 2
    assert stores.latest(stored, 1, "created_at", "disease").first().disease == "Typhoid"
    with pytest.raises(ValueError):
        stores.latest(stored, 51)


@pytest.mark.parametrize("fmt", readers.FORMATS)
def test_series_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    raw = spark.createDataFrame([("2024-02-01", "5"), ("2024-01-01", "x"), ("2024-03-01", "7.5")], "ds string, y string")
    raw.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)
    out = readers.read_series(spark, path, "a", fmt).orderBy("ds").collect()
    assert [(r.ds.month, r.y) for r in out] == [(2, 5.0), (3, 7.5)]


def test_line_list_with_more_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    rows = [("7", "2024-01-03", "x", "Confirmed"), ("8", "2024-02-03", "y", "suspected")]
    spark.createDataFrame(rows, "id string, Screening_Date string, note string, Case_Status string").write.option("header", True).csv(path)
    out = readers.read_line_list(spark, path, "t").orderBy("event_ts").collect()
    assert [(r.event_ts.month, r.status) for r in out] == [(1, "Confirmed"), (2, "suspected")]


def test_line_list_dates_strict_or_lenient(spark, tmp_path):
    path = str(tmp_path / "cases")
    rows = [("2024-01-03", "Confirmed"), ("not a date", "confirmed"), (None, "confirmed")]
    spark.createDataFrame(rows, "Screening_Date string, Case_Status string").write.option("header", True).csv(path)
    assert readers.read_line_list(spark, path, "t", strict=False).count() == 1
    with pytest.raises(Exception):
        readers.read_line_list(spark, path, "t").collect()


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`d.id` int, `d.days` int")
    assert readers.renamed(df, {"d.id": "id"}).columns == ["id"]
    assert readers.dropped(df, ["d.id"]).columns == ["d.days"]
