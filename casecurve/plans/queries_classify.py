"""Named queries: clinical harmonisation, intakes, classifiers, screening, storage and streams."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from casecurve.functions import dates, numbers
from casecurve.functions.text import percent_text, repaired_gender, risk_label, skin_flag, terminal_gender, yes_no_flag
from casecurve.operators import arima, bayes, classify, intake, joins, knn, logistic_folds, metrics, splits
from casecurve.operators.baseline import global_baseline
from casecurve.operators.series import case_series
from casecurve.plans import screening, surveillance
from casecurve.plans.queries_series import (
    ALERT_SOURCE,
    ASSESSED,
    EVALUATE,
    MIXED_FORECAST,
    MIXED_NAME,
    SEASONAL_FORECAST,
    mixed_forecast,
    orders_monthly,
    peak_alerts,
)
from casecurve.plans.registry import GLOBAL, GRADE, ORACLES, ORDERS, query, seasonal_cte, series_ctes
from casecurve.plans.retrain import retrain
from casecurve.session import saved_table, scratch_path
from casecurve.sources import snapshots, stores
from casecurve.sources.tables import (
    clinical,
    customer_records,
    disease_cases,
    event_cases,
    event_intakes,
    event_stream,
    intakes_of,
    nth_text,
    supplier_records,
    table,
)
from casecurve.streaming.alerts import current_windows, start_alerting, start_closed_windows, window_alerts
from casecurve.streaming.complete import start_complete_windows
from casecurve.streaming.screening import STORED, start_screening, start_storing


# -- two clinical sources -----------------------------------------------------------------------

_GENDER = "CASE {k} % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Male' ELSE 'Female' END"
RECORDS = f"""
    records AS (
      SELECT 'A-' || s_suppkey AS record_id, CASE WHEN s_suppkey % 17 <> 0 THEN CAST(s_suppkey % 60 AS DOUBLE) END AS age,
             {_GENDER.format(k='s_suppkey')} AS gender, 1.0::double AS fever, CAST(1 + s_nationkey % 7 AS DOUBLE) AS fever_duration,
             CASE s_suppkey % 4 WHEN 0 THEN 0.0::double WHEN 1 THEN 1.0::double WHEN 2 THEN 1.0::double END AS skin_manifestation,
             CAST((60 + s_suppkey % 90) * 1000 AS DOUBLE) AS platelet_count, CAST((2 + s_suppkey % 5) * 1000 AS DOUBLE) AS wbc, 'Dengue' AS disease
      FROM supplier
      UNION ALL
      SELECT 'B-' || c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_custkey % 85 AS DOUBLE) END,
             {_GENDER.format(k='c_custkey')}, CASE WHEN c_custkey % 11 <> 0 THEN 1.0::double ELSE 0.0::double END,
             CASE WHEN c_custkey % 11 <> 0 THEN CAST(5 + c_nationkey % 14 AS DOUBLE) END,
             CASE c_custkey % 5 WHEN 0 THEN 1.0::double WHEN 4 THEN NULL ELSE 0.0::double END,
             CAST(100000 + c_custkey % 900 * 100 AS DOUBLE), CAST(3000 + c_custkey % 70 * 100 AS DOUBLE), 'Typhoid'
      FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'))"""


def _records(spark, folder, impute=True):
    dengue = intake.dengue_records(supplier_records(spark, folder), extra=("record_id",))
    typhoid = intake.typhoid_records(customer_records(spark, folder), extra=("record_id",))
    return intake.unified_records(dengue, typhoid, impute)


@query(f"WITH {RECORDS} SELECT * FROM records")
def harmonise_union(spark, folder):
    return _records(spark, folder, impute=False)


@query(f"""WITH {RECORDS}, m AS (SELECT median(age) AS a, median(fever_duration) AS f, median(skin_manifestation) AS s,
  median(platelet_count) AS p, median(wbc) AS w FROM records)
SELECT record_id, coalesce(age, a) AS age, gender, fever, coalesce(fever_duration, f) AS fever_duration,
  coalesce(skin_manifestation, s) AS skin_manifestation, coalesce(platelet_count, p) AS platelet_count, coalesce(wbc, w) AS wbc, disease
FROM records, m""")
def harmonise_imputed(spark, folder):
    return _records(spark, folder)


@query("""SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN 'Male' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' WHEN 3 THEN 'Female' WHEN 4 THEN 'Male' ELSE 'Female' END AS gender,
  CASE event_id % 7 WHEN 3 THEN 'Female' ELSE 'Male' END AS terminal_gender,
  CAST(event_id % 7 IN (0, 1, 4, 5) AS INTEGER) AS skin_text, CAST(value > 50 AS INTEGER) AS skin_number,
  CAST(event_type = 'click' AS INTEGER) AS skin_boolean FROM events""")
def clean_gender_flags(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id",
        nth_text("event_id", ["  male ", "M", "Other", "FEMALE", "mAN", "x", None]).alias("g"),
        nth_text("event_id", ["Yes", " rash", "no", "", "1", "TRUE", "0"]).alias("s"),
        (F.col("value") - 50).alias("v"),
        (F.col("event_type") == "click").alias("b"),
    )
    return raw.select(
        "event_id",
        repaired_gender(F.col("g")).alias("gender"),
        terminal_gender(F.col("g")).alias("terminal_gender"),
        skin_flag(F.col("s")).alias("skin_text"),
        skin_flag(F.col("v"), "number").alias("skin_number"),
        skin_flag(F.col("b"), "boolean").alias("skin_boolean"),
    )


INTAKES = """
    intakes AS (
      SELECT event_id, 'P-' || user_id AS patient_code, CAST(json_extract_string(props, '$.k') AS INTEGER) + event_id % 40 AS age,
             CASE event_id % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' WHEN 3 THEN 'Male' ELSE 'unstated' END AS gender,
             CAST(floor(value / 3) AS INTEGER) AS fever_duration_days,
             CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN NULL ELSE event_type IN ('click', 'view') END AS skin_manifestation
      FROM events),
    checked AS (
      SELECT *, CASE WHEN age IS NULL OR age NOT BETWEEN 0 AND 120 THEN 'age out of range'
        WHEN gender NOT IN ('Male', 'Female', 'Other') THEN 'gender unknown'
        WHEN fever_duration_days IS NULL OR fever_duration_days NOT BETWEEN 1 AND 120 THEN 'fever duration out of range'
        WHEN skin_manifestation IS NULL THEN 'skin manifestation missing' END AS reason FROM intakes)"""


@query(f"WITH {INTAKES} SELECT event_id, reason FROM checked")
def intake_validation(spark, folder):
    return intake.checked_intakes(event_intakes(spark, folder)).select("event_id", "reason")


@query(f"""WITH {INTAKES} SELECT event_id, CAST(age AS DOUBLE) AS age, CASE gender WHEN 'Other' THEN 'Female' ELSE gender END AS gender,
  CAST(fever_duration_days AS DOUBLE) AS fever_duration, CAST(skin_manifestation AS DOUBLE) AS skin_manifestation FROM checked WHERE reason IS NULL""")
def screening_features(spark, folder):
    valid = intake.valid_intakes(event_intakes(spark, folder))
    return intake.screening_features(valid).select("event_id", "age", "gender", "fever_duration", "skin_manifestation")


# -- models whose results SQL can give ------------------------------------------------------------


def _dims(n=64):
    return [F.element_at("embedding", i + 1).cast("double") for i in range(n)]


@query("""WITH x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings),
p AS (SELECT label, d, avg(v) AS m, var_pop(v) AS s FROM x GROUP BY 1, 2),
e AS (SELECT 1e-9::double * max(s) AS e FROM (SELECT var_pop(v) AS s FROM x GROUP BY d)),
prior AS (SELECT label, ln(count(*) / (SELECT count(*) FROM embeddings)) AS lp FROM embeddings GROUP BY 1),
j AS (SELECT x.vec_id, p.label, any_value(lp) - 0.5::double * sum(ln(2 * pi() * (s + e)) + (v - m) ** 2 / (s + e)) AS lj
  FROM x JOIN p USING (d) JOIN prior ON prior.label = p.label, e GROUP BY 1, 2)
SELECT vec_id, max_by(label, lj) AS prediction, round_even(max(lj), 3) AS log_joint FROM j GROUP BY 1""")
def gaussian_nb(spark, folder):
    rows = table(spark, folder, "embeddings")
    params = saved_table(bayes.fit_gaussian_nb(rows, _dims()), "bayes")
    scored = bayes.score_gaussian_nb(rows, params, _dims())
    return scored.select("vec_id", "prediction", F.bround("log_joint", 3).alias("log_joint"))


KNN = """WITH s AS (SELECT *, ('0x' || substr(md5(vec_id::VARCHAR || '|42'), 1, 8))::BIGINT / 4294967296.0::double < 0.2::double AS test FROM embeddings),
d AS (SELECT q.vec_id AS query_id, t.vec_id, t.label, list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]) AS distance
  FROM s q, s t WHERE q.test AND NOT t.test),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS p FROM d),
v AS (SELECT query_id, label, count(*) AS n FROM r WHERE p <= 13 GROUP BY 1, 2),
best AS (SELECT query_id, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1)
SELECT query_id, prediction, round_even(avg(distance), 6) AS mean_distance FROM best JOIN r USING (query_id) WHERE p <= 13 GROUP BY 1, 2"""


def _knn(spark, folder, **options):
    rows = splits.hash_split(table(spark, folder, "embeddings"), "vec_id")
    voted = knn.knn_classify(rows.where("part = 'test'"), rows.where("part = 'train'"), 13, **options)
    return voted.withColumn("mean_distance", F.bround("mean_distance", 6))


@query(KNN)
def knn_vote(spark, folder):
    return _knn(spark, folder)


@query(KNN)
def knn_vote_cells(spark, folder):
    """The same vote through the cell join that serves training sides too large to send around."""
    return _knn(spark, folder, small_values=0, block_rows=512)


@query("""WITH f AS (SELECT *, CAST(((row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '|0')) - 1) * 10) // count(*) OVER () AS INTEGER) AS fold FROM embeddings),
x AS (SELECT vec_id, label, fold, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(1, len(embedding) + 1)) AS d FROM f),
k AS (SELECT unnest(range(10)) AS test),
p AS (SELECT test, label, d, avg(v) AS m, var_pop(v) AS s FROM x JOIN k ON fold <> test GROUP BY 1, 2, 3),
e AS (SELECT test, 1e-9::double * max(s) AS e FROM (SELECT test, var_pop(v) AS s FROM x JOIN k ON fold <> test GROUP BY test, d) GROUP BY 1),
c AS (SELECT test, label, count(*) AS n FROM f JOIN k ON fold <> test GROUP BY 1, 2),
prior AS (SELECT test, label, ln(n / sum(n) OVER (PARTITION BY test)) AS lp FROM c),
j AS (SELECT x.vec_id, x.fold, x.label AS actual, p.label, any_value(lp) - 0.5::double * sum(ln(2 * pi() * (s + e)) + (v - m) ** 2 / (s + e)) AS lj
  FROM x JOIN p ON p.test = x.fold AND p.d = x.d JOIN prior ON prior.test = p.test AND prior.label = p.label JOIN e ON e.test = p.test GROUP BY 1, 2, 3, 4),
b AS (SELECT vec_id, fold, actual, max_by(label, lj) AS prediction FROM j GROUP BY 1, 2, 3),
a AS (SELECT fold, avg(CAST(actual = prediction AS DOUBLE)) AS a FROM b GROUP BY 1)
SELECT count(*) AS n_folds, round_even(avg(a) * 100.0::double, 2) AS accuracy FROM a""")
def bayes_cross_validation(spark, folder):
    folded = saved_table(splits.assign_folds(table(spark, folder, "embeddings"), "vec_id", k=10, seed=0), "folds")
    return classify.fold_accuracy(bayes.cross_validated_nb(folded, _dims(), "label"), "label")


@query("""WITH f AS (SELECT *, ((row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '|0')) - 1) * 10) // count(*) OVER () AS fold FROM embeddings),
d AS (SELECT q.vec_id AS query_id, q.fold, q.label AS actual, t.vec_id, t.label, list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]) AS distance
  FROM f q JOIN f t ON q.fold <> t.fold),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS p FROM d),
v AS (SELECT query_id, fold, actual, label, count(*) AS n FROM r WHERE p <= 13 GROUP BY 1, 2, 3, 4),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1),
a AS (SELECT fold, avg(CAST(actual = label AS DOUBLE)) AS a FROM b GROUP BY 1)
SELECT count(*) AS n_folds, round_even(avg(a) * 100.0::double, 2) AS accuracy FROM a""")
def knn_cross_validation(spark, folder):
    folded = saved_table(splits.assign_folds(table(spark, folder, "embeddings"), "vec_id", k=10, seed=0), "folds")
    return classify.fold_accuracy(knn.cross_validated_knn(folded), "label")


# -- trained classifiers --------------------------------------------------------------------------

NUMERIC = ["age", "fever_duration", "skin_manifestation"]
CATEGORICAL = ["gender"]


def _trained(spark, folder, kind, positive="Dengue"):
    return classify.train_classifier(_records(spark, folder), "disease", NUMERIC, CATEGORICAL, kind, positive)


def _batch(spark, folder, kind):
    fitted = _trained(spark, folder, kind)
    valid = intake.screening_features(intake.valid_intakes(event_intakes(spark, folder)))
    out = classify.scored(valid, fitted)
    return classify.with_probability_columns(out, fitted).select("event_id", "predicted_disease", "prob_Dengue", "prob_Typhoid")


@query()
def rf_batch_score(spark, folder):
    return _batch(spark, folder, "forest")


@query()
def logreg_score(spark, folder):
    return _batch(spark, folder, "logistic")


@query()
def svm_rff_score(spark, folder):
    fitted = _trained(spark, folder, "svm")
    valid = intake.screening_features(intake.valid_intakes(event_intakes(spark, folder)))
    return classify.scored(valid, fitted).select("event_id", F.bround("score", 4).alias("score"), "prediction")


@query()
def forest_min_instances(spark, folder):
    """A forest whose splits leave at least five rows on each side."""
    fitted = classify.train_classifier(_records(spark, folder), "disease", NUMERIC, CATEGORICAL, "forest", "Dengue", min_instances=5)
    return classify.scored(_valid_features(spark, folder), fitted).select("event_id", F.bround("score", 4).alias("score"), "prediction")


@query()
def svm_rbf_score(spark, folder):
    """Decisions of the kernel machine on 64 landmarks, for the named class."""
    fitted = classify.train_classifier(_records(spark, folder), "disease", NUMERIC, CATEGORICAL, "svm_rbf", "Dengue", landmarks=64)
    return classify.scored(_valid_features(spark, folder), fitted).select("event_id", F.bround("score", 3).alias("score"), "prediction")


@query()
def svm_rbf_multiclass(spark, folder):
    """Ten classes, each against the rest, in the same passes."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("label"), *[c.alias(f"e{i}") for i, c in enumerate(_dims())]
    )
    fitted = classify.train_classifier(rows, "label", [f"e{i}" for i in range(64)], [], "svm_rbf", landmarks=64)
    return classify.scored(rows, fitted).select("vec_id", "prediction")


@query()
def tuned_forest_metrics(spark, folder):
    """Threshold from out-of-fold scores, then test metrics, as one row."""
    fitted = classify.train_with_threshold(_records(spark, folder), "record_id", "disease", "Dengue", NUMERIC, CATEGORICAL)
    values = {"threshold": round(fitted.threshold, 4), **fitted.metrics}
    return spark.range(1).select(*[F.lit(float(v)).alias(k) for k, v in values.items()])


@query()
def logistic_cross_validation(spark, folder):
    """Coefficients of all ten folds' models and of all rows, from one job per Newton step."""
    folded = saved_table(splits.assign_folds(clinical(spark, folder), "doc_id", "label", 10, 0), "folds")
    fitted = logistic_folds.fit_logistic_folds(folded, "label", ["n_chars", "toxic"], ["lang"], saved=True)
    return logistic_folds.fold_coefficients(folded, fitted).withColumn("coefficient", F.bround("coefficient", 5))


@query()
def logistic_out_of_fold(spark, folder):
    """Every record's score by the model that has not seen it."""
    out = classify.out_of_fold(_records(spark, folder), "record_id", "disease", NUMERIC, CATEGORICAL, "logistic", 5, "Dengue")
    return out.withColumn("score", F.bround("score", 5))


@query()
def cv_accuracy(spark, folder):
    """Ten-fold accuracy of five classifiers on the labelled documents."""
    rows = saved_table(clinical(spark, folder), "clinical")
    out = None
    for kind in ("logistic", "bayes", "tree", "forest_climate", "svm"):
        held_out = classify.out_of_fold(rows, "doc_id", "label", ["n_chars", "toxic"], ["lang"], kind, 10, seed=0, stratified=False)
        line = classify.fold_accuracy(held_out, "label").withColumn("model", F.lit(kind))
        out = line if out is None else out.unionByName(line)
    return out


@query()
def model_compare(spark, folder):
    return classify.compare_models(_records(spark, folder), "record_id", "disease", "Dengue", NUMERIC, CATEGORICAL)


@query()
def svm_multiclass(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("label"), *[c.alias(f"e{i}") for i, c in enumerate(_dims())]
    )
    fitted = classify.train_classifier(rows, "label", [f"e{i}" for i in range(64)], [], "svm_multiclass")
    return classify.scored(rows, fitted).select("vec_id", "prediction")


def _disease_status(spark, folder):
    return surveillance.current_status(case_series(disease_cases(spark, folder), word="f"))


@query("WITH " + series_ctes("lineitem", "CASE l_returnflag WHEN 'R' THEN 'Dengue' ELSE 'Typhoid' END", "l_shipdate",
                             "lower(l_linestatus) = 'f' AND l_returnflag IN ('R', 'A')") + f""", {GLOBAL}, {EVALUATE}, {INTAKES},
judged AS (SELECT event_id, CASE WHEN skin_manifestation AND fever_duration_days <= 20 THEN 'Dengue' ELSE 'Typhoid' END AS predicted_disease,
  0.5::double + age / 256.0::double AS confidence FROM checked WHERE reason IS NULL),
context AS (SELECT *, round_even(z, 2) AS z_score, {GRADE.format(z='z')} AS risk_level FROM status)
SELECT event_id, predicted_disease, confidence, printf('%.1f%%', confidence * 100) AS confidence_percentage, cases AS latest_observed_cases,
  baseline_mean AS historical_mean, z_score AS current_z_score, risk_level AS current_outbreak_risk, coalesce(z >= 2, false) AS is_outbreak_active
FROM judged JOIN context ON series_id = predicted_disease""")
def screening_context(spark, folder):
    """Intakes judged by a rule, with the current risk of the disease they were judged to be."""
    valid = intake.valid_intakes(event_intakes(spark, folder))
    short_with_rash = F.col("skin_manifestation") & (F.col("fever_duration_days") <= 20)
    judged = valid.select(
        "event_id",
        F.when(short_with_rash, "Dengue").otherwise("Typhoid").alias("predicted_disease"),
        (0.5 + F.col("age") / 256.0).alias("confidence"),
    )
    out = screening.with_context(judged, saved_table(_disease_status(spark, folder), "status"))
    return out.drop("details")


@query()
def screen_with_context(spark, folder):
    fitted = _trained(spark, folder, "forest")
    out = screening.screen(intake.valid_intakes(event_intakes(spark, folder)), fitted, _disease_status(spark, folder))
    return out.select(
        "event_id", "patient_code", "predicted_disease", "confidence", "confidence_percentage", "latest_observed_cases",
        "historical_mean", "current_z_score", "current_outbreak_risk", "is_outbreak_active", "details",
    )


@query()
def confirmed_agreement(spark, folder):
    """Prediction beside a confirmed disease: how often they agree."""
    fitted = _trained(spark, folder, "logistic")
    out = classify.scored(_records(spark, folder), fitted).select(
        F.col("prediction").alias("predicted_disease"), F.col("disease").alias("doctor_confirmed_disease")
    )
    return joins.agreement(out).groupBy("doctor_confirmed_disease", "agrees").agg(F.count(F.lit(1)).alias("n"))


# -- a model of given coefficients, which SQL can follow --------------------------------------------

FIXED_MODEL = classify.Classifier(
    classify.FixedLogistic({"age": 0.015, "fever_duration": -0.03, "skin_manifestation": 1.25}, -0.5),
    ["Dengue", "Typhoid"], NUMERIC, [], "logistic", "Dengue",
)
FIXED = f"""{INTAKES},
fixed_p AS (
  SELECT event_id, patient_code, CAST(age AS DOUBLE) AS age, gender, fever_duration_days,
    CASE WHEN skin_manifestation THEN 1.0::double ELSE 0.0::double END AS skin_manifestation,
    1.0::double / (1.0::double + exp(-(-0.5::double + 0.015::double * age + -0.03::double * fever_duration_days
      + 1.25::double * CASE WHEN skin_manifestation THEN 1.0::double ELSE 0.0::double END))) AS p
  FROM checked WHERE reason IS NULL),
fixed AS (
  SELECT *, CASE WHEN p >= 0.5 THEN 'Dengue' ELSE 'Typhoid' END AS predicted_disease, round_even(p, 4) AS prob_Dengue,
    round_even(1.0::double - p, 4) AS prob_Typhoid, CASE WHEN p >= 0.5 THEN round_even(p, 4) ELSE round_even(1.0::double - p, 4) END AS confidence
  FROM fixed_p)"""
# Half to even on the decimal digits of the double, as the sentence rounds; DuckDB's own rounding is binary.
_TENTHS = "CAST(CAST(confidence * 100.0::double AS VARCHAR) AS DECIMAL(30, 15)) * 10"
PERCENT = f"""(floor({_TENTHS}) + CASE WHEN {_TENTHS} - floor({_TENTHS}) > 0.5 OR
    {_TENTHS} - floor({_TENTHS}) = 0.5 AND CAST(floor({_TENTHS}) AS BIGINT) % 2 = 1 THEN 1 ELSE 0 END)::double / 10.0::double"""
FIXED_CONTEXT = "WITH " + series_ctes(
    "lineitem", "CASE l_returnflag WHEN 'R' THEN 'Dengue' ELSE 'Typhoid' END", "l_shipdate",
    "lower(l_linestatus) = 'f' AND l_returnflag IN ('R', 'A')",
) + f""", {GLOBAL}, {EVALUATE}, {FIXED},
context AS (SELECT *, round_even(z, 2) AS z_score, {GRADE.format(z='z')} AS risk_level FROM status)
SELECT patient_code, CAST(age AS DOUBLE) AS age, fever_duration_days, skin_manifestation, predicted_disease, confidence,
  cases AS latest_observed_cases, z_score AS current_z_score, risk_level AS current_outbreak_risk, coalesce(z >= 2, false) AS is_outbreak_active,
  printf('Diagnosed %s with %.1f%% confidence. Community %s surveillance status is currently ''%s'' (Z=%s).',
    predicted_disease, {PERCENT}, predicted_disease, risk_level, CAST(z_score AS VARCHAR)) AS details
FROM fixed JOIN context ON series_id = predicted_disease"""


@query(f"WITH {FIXED} SELECT event_id, predicted_disease, prob_Dengue, prob_Typhoid FROM fixed")
def fixed_batch_score(spark, folder):
    """Batch scoring through the same steps as a fitted model."""
    valid = intake.screening_features(intake.valid_intakes(event_intakes(spark, folder)))
    out = classify.with_probability_columns(classify.scored(valid, FIXED_MODEL), FIXED_MODEL)
    return out.select("event_id", "predicted_disease", "prob_Dengue", "prob_Typhoid")


@query(FIXED_CONTEXT)
def fixed_screening(spark, folder):
    """Screened intakes with the risk of their disease and the sentence that tells it."""
    out = screening.screen(intake.valid_intakes(event_intakes(spark, folder)), FIXED_MODEL, _disease_status(spark, folder))
    return out.select(*[c for c in STORED if c != "gender"])


@query(FIXED_CONTEXT)
def stream_fixed_screening(spark, folder):
    """The same from a stream."""
    out, checkpoint = scratch_path(spark, "screened"), scratch_path(spark, "progress")
    status = saved_table(_disease_status(spark, folder), "status")
    start_screening(intakes_of(event_stream(spark, folder)), FIXED_MODEL, status, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out).drop("gender")


def _valid_features(spark, folder):
    return intake.screening_features(intake.valid_intakes(event_intakes(spark, folder)))


@query(f"""WITH {RECORDS},
middle AS (SELECT median(age) AS a, median(fever_duration) AS f, median(platelet_count) AS p FROM records),
usual AS (SELECT gender AS g FROM records WHERE gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, gender LIMIT 1),
filled AS (SELECT record_id, coalesce(age, a) AS age, coalesce(fever_duration, f) AS fever, coalesce(platelet_count, p) AS platelets,
  coalesce(gender, g) AS gender FROM records, middle, usual),
stats AS (SELECT avg(age) AS am, stddev_pop(age) AS asd, avg(fever) AS fm, stddev_pop(fever) AS fsd, avg(platelets) AS pm, stddev_pop(platelets) AS psd FROM filled)
SELECT record_id, round_even((age - am) / asd, 6) AS age_scaled, round_even((fever - fm) / fsd, 6) AS fever_duration_scaled,
  round_even((platelets - pm) / psd, 6) AS platelet_count_scaled, CASE WHEN gender = 'Male' THEN 1.0::double ELSE 0.0::double END AS "gender_Male" FROM filled, stats""")
def preprocessed_features(spark, folder):
    """Medians, population scaling, most frequent category and flags, as every classifier gets them."""
    out = classify.preprocessed(_records(spark, folder, impute=False), ["record_id"], ["age", "fever_duration", "platelet_count"], ["gender"])
    return out.withColumns({c: F.bround(c, 6) for c in out.columns if c.endswith("_scaled")})


@query(f"""WITH {FIXED}
SELECT event_id, 'Dengue' AS positive, round_even(p, 6) AS score, predicted_disease AS prediction FROM fixed
UNION ALL SELECT event_id, 'Typhoid', round_even(1.0::double - p, 6), CASE WHEN 1.0::double - p >= 0.5 THEN 'Typhoid' ELSE 'Dengue' END FROM fixed""")
def fixed_class_scores(spark, folder):
    """The score points at the class that is named, whichever comes first in the model; one half is enough for it."""
    valid, out = _valid_features(spark, folder), None
    for positive in FIXED_MODEL.classes:
        named = classify.scored(valid, replace(FIXED_MODEL, positive=positive))
        line = named.select("event_id", F.lit(positive).alias("positive"), F.bround("score", 6).alias("score"), "prediction")
        out = line if out is None else out.unionByName(line)
    return out


@query(f"""WITH {FIXED} SELECT event_id, 'Dengue' AS class, prob_Dengue AS probability FROM fixed
UNION ALL SELECT event_id, 'Typhoid', prob_Typhoid FROM fixed""")
def fixed_probability_map(spark, folder):
    out = classify.scored(_valid_features(spark, folder), FIXED_MODEL)
    return out.select("event_id", F.explode("probabilities").alias("class", "probability"))


@query(f"""WITH {FIXED} SELECT event_id, predicted_disease, 0.5::double AS prob_Dengue, 0.5::double AS prob_Typhoid FROM fixed""")
def label_without_probability(spark, folder):
    """A model that gives labels only reports one half for each class."""
    plain = replace(FIXED_MODEL, kind="svm_labels")
    out = classify.with_probability_columns(classify.scored(_valid_features(spark, folder), plain), plain)
    return out.select("event_id", "predicted_disease", "prob_Dengue", "prob_Typhoid")


@query(f"WITH {FIXED} SELECT event_id, predicted_disease FROM fixed")
def fixed_submission(spark, folder):
    """Predictions written as a submission file and read back."""
    path = scratch_path(spark, "submission")
    out = classify.with_probability_columns(classify.scored(_valid_features(spark, folder), FIXED_MODEL), FIXED_MODEL)
    stores.write_csv(out.select("event_id", "predicted_disease"), path)
    return stores.read_csv(spark, path, "event_id bigint, predicted_disease string")


@query(f"""WITH {RECORDS},
m AS (SELECT median(age) AS a, median(fever_duration) AS f, median(skin_manifestation) AS s FROM records),
whole AS (SELECT disease, coalesce(age, a) AS age, coalesce(fever_duration, f) AS fever, coalesce(skin_manifestation, s) AS skin FROM records, m),
judged AS (
  SELECT 'logistic' AS model, disease, CASE WHEN 1.0::double / (1.0::double + exp(-(-0.5::double + 0.015::double * age
    + -0.03::double * fever + 1.25::double * skin))) >= 0.5 THEN 'Dengue' ELSE 'Typhoid' END AS prediction FROM whole
  UNION ALL SELECT 'rash', disease, CASE WHEN skin = 1 THEN 'Dengue' ELSE 'Typhoid' END FROM whole
  UNION ALL SELECT 'short fever', disease, CASE WHEN fever <= 7 THEN 'Dengue' ELSE 'Typhoid' END FROM whole),
classes AS (
  SELECT model, c, count(*) FILTER (disease = c) AS s, count(*) FILTER (prediction = c) AS p, count(*) FILTER (disease = c AND prediction = c) AS h
  FROM judged, (VALUES ('Dengue'), ('Typhoid')) v(c) GROUP BY 1, 2),
rates AS (SELECT *, CASE WHEN p > 0 THEN h / p ELSE 0 END AS pr, CASE WHEN s > 0 THEN h / s ELSE 0 END AS re, CASE WHEN s + p > 0 THEN 2.0::double * h / (s + p) ELSE 0 END AS f FROM classes)
SELECT model, round_even(sum(h) / sum(s), 4) AS accuracy, round_even(avg(re) FILTER (s > 0), 4) AS balanced_accuracy, round_even(avg(f), 4) AS macro_f1,
  round_even(max(pr) FILTER (c = 'Dengue'), 4) AS positive_precision, round_even(max(re) FILTER (c = 'Dengue'), 4) AS positive_recall,
  round_even(max(f) FILTER (c = 'Dengue'), 4) AS positive_f1 FROM rates GROUP BY model""")
def compare_closed_form(spark, folder):
    """Six measures of three classifiers that SQL can follow, side by side."""
    records = saved_table(_records(spark, folder), "records")
    skin, fever = F.col("skin_manifestation") == 1, F.col("fever_duration") <= 7
    lines = [classify.scored(records, FIXED_MODEL).select(F.lit("logistic").alias("model"), "disease", "prediction")]
    for name, rule in (("rash", skin), ("short fever", fever)):
        lines.append(records.select(F.lit(name).alias("model"), "disease", F.when(rule, "Dengue").otherwise("Typhoid").alias("prediction")))
    judged = lines[0].unionByName(lines[1]).unionByName(lines[2])
    return metrics.overall_scores(judged, "disease", "prediction", "Dengue", groups=["model"])


# -- storage --------------------------------------------------------------------------------------


@query(f"""WITH {INTAKES} SELECT patient_code, CAST(age AS INTEGER) AS age, gender, fever_duration_days, skin_manifestation,
  'Dengue' AS predicted_disease, 0.1235::double AS confidence_score, CAST(NULL AS VARCHAR) AS doctor_confirmed_disease
FROM checked WHERE reason IS NULL""")
def intake_log(spark, folder):
    path = scratch_path(spark, "patient_intakes")
    valid = intake.valid_intakes(event_intakes(spark, folder)).withColumn("predicted_disease", F.lit("Dengue"))
    records = stores.intake_records(valid.withColumn("confidence", F.lit(0.12345678)))
    stores.append(records, path, stores.INTAKES_SCHEMA)
    return stores.read_store(spark, path, stores.INTAKES_SCHEMA).drop("created_at", "center_id")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {SEASONAL_FORECAST}, {ASSESSED}
SELECT series_id AS disease, ds AS forecast_month, predicted_cases, z_score, risk_level, baseline_mean, baseline_std, 'seasonal_mean' AS model_name
FROM assessed ORDER BY forecast_month DESC, disease LIMIT 10""")
def stored_forecasts(spark, folder):
    path = scratch_path(spark, "surveillance_forecasts")
    graded = surveillance.graded_forecast(orders_monthly(spark, folder), "seasonal_mean")
    stores.append(surveillance.forecast_records(graded, "seasonal_mean"), path, stores.FORECASTS_SCHEMA)
    return stores.latest(stores.read_store(spark, path, stores.FORECASTS_SCHEMA), 10, "forecast_month", "disease")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {MIXED_FORECAST}, {ASSESSED}
SELECT series_id AS disease, ds AS forecast_month, predicted_cases, z_score, risk_level, {MIXED_NAME} AS model_name FROM assessed""")
def stored_forecasts_mixed(spark, folder):
    path = scratch_path(spark, "surveillance_forecasts")
    stores.append(surveillance.forecast_records(mixed_forecast(spark, folder)), path, stores.FORECASTS_SCHEMA)
    return stores.read_store(spark, path, stores.FORECASTS_SCHEMA).drop("baseline_mean", "baseline_std")


# Confirmed later: every third case, as the opposite where the fever lasted over 30 days.
SCREENED = """
screened AS (SELECT event_id, patient_code, CAST(age AS INTEGER) AS age, gender, fever_duration_days, skin_manifestation,
  CASE WHEN skin_manifestation AND fever_duration_days <= 20 THEN 'Dengue' ELSE 'Typhoid' END AS predicted_disease,
  round_even(0.5::double + age / 256.0::double, 4) AS confidence_score, 'C-' || (event_id % 7) AS center_id,
  CASE WHEN event_id % 3 = 0 THEN CASE WHEN fever_duration_days > 30 THEN 'Dengue' ELSE 'Typhoid' END END AS doctor_confirmed_disease
FROM checked WHERE reason IS NULL)"""


def _screened(spark, folder, intakes):
    """Valid intakes judged by a rule, with the centre that saw them and the disease confirmed later."""
    status = saved_table(_disease_status(spark, folder), "status")
    rash = F.col("skin_manifestation") & (F.col("fever_duration_days") <= 20)
    judged = intake.valid_intakes(intakes).withColumns(
        {
            "predicted_disease": F.when(rash, "Dengue").otherwise("Typhoid"),
            "confidence": 0.5 + F.col("age") / 256.0,
            "center_id": F.concat(F.lit("C-"), (F.col("event_id") % 7).cast("string")),
            "doctor_confirmed_disease": F.when(
                F.col("event_id") % 3 == 0, F.when(F.col("fever_duration_days") > 30, "Dengue").otherwise("Typhoid")
            ),
        }
    )
    return screening.with_context(judged, status)


@query(f"""WITH {INTAKES}, {SCREENED} SELECT * EXCLUDE (event_id) FROM screened""")
def stored_screenings(spark, folder):
    """Screen, then store: each row with its own disease, confidence, centre and confirmed disease."""
    path = scratch_path(spark, "patient_intakes")
    screening.store_screened(_screened(spark, folder, event_intakes(spark, folder)), path)
    return stores.read_store(spark, path, stores.INTAKES_SCHEMA).drop("created_at")


@query(f"""WITH {INTAKES}, {SCREENED} SELECT * EXCLUDE (event_id) FROM screened""")
def stream_stored_screenings(spark, folder):
    """The same from a stream of intakes."""
    out, checkpoint = scratch_path(spark, "patient_intakes"), scratch_path(spark, "progress")
    screened = _screened(spark, folder, intakes_of(event_stream(spark, folder)))
    start_storing(screened, out, checkpoint, available_now=True).awaitTermination()
    return stores.read_store(spark, out, stores.INTAKES_SCHEMA).drop("created_at")


@query(f"""WITH {INTAKES}, {SCREENED}
SELECT predicted_disease, doctor_confirmed_disease, predicted_disease = doctor_confirmed_disease AS agrees, count(*) AS n
FROM screened GROUP BY 1, 2""")
def screening_agreement(spark, folder):
    """Predicted beside confirmed disease of screened intakes; open while unconfirmed."""
    rows = joins.agreement(_screened(spark, folder, event_intakes(spark, folder)))
    return rows.groupBy("predicted_disease", "doctor_confirmed_disease", "agrees").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_round_trip(spark, folder):
    path = scratch_path(spark, "suppliers")
    rows = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    stores.write_csv(rows, path)
    return stores.read_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


@query("""SELECT event_id, 'P-' || user_id AS patient_code FROM events ORDER BY ts DESC, event_id LIMIT 10""")
def recent_intakes(spark, folder):
    return stores.latest(event_intakes(spark, folder), 10, "created_at", "event_id").select("event_id", "patient_code")


# -- streams --------------------------------------------------------------------------------------

COMPLETE_SCHEMA = (
    "series_id string, window_start timestamp, y bigint, n_before bigint, mean double, std double, "
    "z_score double, risk_level string, is_anomaly boolean"
)

DAILY = series_ctes("events", "event_type", "ts", period="day")
WINDOWS = """
    windows AS (
      SELECT event_type AS series_id, date_trunc('day', ts) AS day, count(*) AS y FROM events GROUP BY 1, 2)"""


def _event_stream_cases(spark, folder):
    return event_stream(spark, folder).select(F.col("event_type").alias("series_id"), F.col("ts").cast("timestamp").alias("event_ts"))


@query(f"""WITH {WINDOWS} SELECT series_id, CAST(day AS DATE) AS day, y FROM windows
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def stream_closed_windows(spark, folder):
    out, checkpoint = scratch_path(spark, "windows"), scratch_path(spark, "progress")
    start_closed_windows(_event_stream_cases(spark, folder), out, checkpoint, available_now=True).awaitTermination()
    rows = spark.read.schema("series_id string, window_start timestamp, window_end timestamp, y bigint").parquet(out)
    return rows.select("series_id", F.col("window_start").cast("date").alias("day"), "y")


RARE = "event_id % 7 = 0"


@query(f"""WITH {series_ctes("events", "event_type", "ts", RARE, "day")},
closed AS (SELECT max(ts) - INTERVAL 1 DAY AS upto FROM events WHERE {RARE}),
firsts AS (SELECT series_id, min(ds) AS lo FROM series GROUP BY 1),
days AS (
  SELECT series_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), upto - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM firsts, closed),
filled AS (SELECT d.series_id, d.day, coalesce(s.y, 0) AS y FROM days d LEFT JOIN series s ON s.series_id = d.series_id AND s.ds = d.day),
past AS (
  SELECT *, count(*) OVER w AS n_before, avg(y) OVER w AS mean, stddev_samp(y) OVER w AS std FROM filled
  WINDOW w AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN n_before > 1 THEN round_even((y - mean) / CASE WHEN std > 1e-6::double THEN std ELSE 1.0::double END, 2) END AS z_score FROM past)
SELECT series_id, day, y, n_before, round_even(mean, 4) AS mean, round_even(std, 4) AS std, z_score, {GRADE.format(z="z_score")} AS risk_level,
  coalesce(({GRADE.format(z="z_score")}) IN ('Alert', 'Critical'), false) AS is_anomaly FROM z""")
def stream_complete_windows(spark, folder):
    """Rare events per day, days without any as 0, each graded against the days before it."""
    out, checkpoint = scratch_path(spark, "complete"), scratch_path(spark, "progress")
    rare = event_stream(spark, folder).where(RARE).select(F.col("event_type").alias("series_id"), F.col("ts").cast("timestamp").alias("event_ts"))
    start_complete_windows(rare, out, checkpoint, available_now=True).awaitTermination()
    rows = spark.read.schema(COMPLETE_SCHEMA).parquet(out)
    rounded = {"mean": F.bround("mean", 4), "std": F.bround("std", 4), "day": F.col("window_start").cast("date")}
    return rows.withColumns(rounded).drop("window_start")


@query(f"""WITH {DAILY}, {WINDOWS},
b AS (SELECT series_id, round_even(avg(y), 1) AS mean, round_even(stddev_samp(y), 1) AS std FROM series GROUP BY 1)
SELECT w.series_id, CAST(w.day AS DATE) AS day, w.y, round_even((w.y - mean) / std, 2) AS z_score,
  CASE WHEN round_even((w.y - mean) / std, 2) < 2 THEN 'Normal' WHEN round_even((w.y - mean) / std, 2) < 3 THEN 'Alert' ELSE 'Critical' END AS risk_level,
  round_even((w.y - mean) / std, 2) >= 2 AS is_anomaly
FROM windows w JOIN b USING (series_id)""")
def stream_alerts(spark, folder):
    out, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "progress")
    daily = case_series(event_cases(spark, folder), period="day", status=None)
    baseline = saved_table(global_baseline(daily), "baseline")
    start_alerting(_event_stream_cases(spark, folder), baseline, out, checkpoint, available_now=True).awaitTermination()
    rows = current_windows(spark, out)
    return rows.select("series_id", F.col("window_start").cast("date").alias("day"), "y", "z_score", "risk_level", "is_anomaly")


@query(f"""WITH {DAILY}, {WINDOWS},
b AS (SELECT series_id, round_even(avg(y), 1) AS mean, round_even(stddev_samp(y), 1) AS std FROM series GROUP BY 1),
g AS (SELECT w.series_id, CAST(w.day AS DATE) AS day, w.y, round_even((w.y - mean) / std, 2) AS z FROM windows w JOIN b USING (series_id))
SELECT series_id AS disease, day, 'All regions' AS region, CASE WHEN z < 3 THEN 'Alert' ELSE 'Critical' END AS risk_level, z AS z_score,
  printf('%s outbreak alert for %s: %d cases (Z=%.2f).', series_id, strftime(day, '%Y-%m-%d'), y, z) AS alert_message, false AS is_resolved
FROM g WHERE z >= 2""")
def stream_alert_rows(spark, folder):
    """Alert records from the stream, one for each anomalous window."""
    out, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "progress")
    daily = case_series(event_cases(spark, folder), period="day", status=None)
    baseline = saved_table(global_baseline(daily), "baseline")
    start_alerting(_event_stream_cases(spark, folder), baseline, out, checkpoint, available_now=True).awaitTermination()
    rows = window_alerts(current_windows(spark, out), "All regions")
    return rows.select("disease", F.col("window_start").cast("date").alias("day"), "region", "risk_level", "z_score", "alert_message", "is_resolved")


@query()
def stream_screening(spark, folder):
    out, checkpoint = scratch_path(spark, "screened"), scratch_path(spark, "progress")
    fitted = _trained(spark, folder, "logistic")
    status = saved_table(_disease_status(spark, folder), "status")
    start_screening(intakes_of(event_stream(spark, folder)), fitted, status, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out)


# -- further composites ---------------------------------------------------------------------------


@query("""WITH s AS (SELECT o_totalprice AS score, o_orderstatus = 'F' AS pos FROM orders),
c AS (SELECT score, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n FROM s GROUP BY 1),
u AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM c WINDOW w AS (ORDER BY score DESC)),
f AS (SELECT score, tp / (tp + fp) AS pr, tp / (SELECT sum(p) FROM c) AS rc FROM u),
t AS (SELECT score AS threshold FROM f ORDER BY 2 * pr * rc / (pr + rc + 1e-10::double) DESC, score LIMIT 1)
SELECT o_orderkey, CASE WHEN o_totalprice >= threshold THEN 'F' ELSE 'other' END AS prediction FROM orders, t""")
def threshold_decision(spark, folder):
    """Rows decided by the threshold with the best F1 on them."""
    rows = table(spark, folder, "orders")
    threshold = metrics.best_threshold(rows, "o_totalprice", F.col("o_orderstatus") == "F").select("threshold").scalar()
    return rows.select("o_orderkey", F.when(F.col("o_totalprice") >= threshold, "F").otherwise("other").alias("prediction"))


@query()
def submission(spark, folder):
    """A multiclass model trained on one part predicts the other; the result is a CSV file."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("label"), *[c.alias(f"e{i}") for i, c in enumerate(_dims())]
    )
    split = splits.hash_split(rows, "vec_id")
    fitted = classify.train_classifier(
        split.where("part = 'train'"), "label", [f"e{i}" for i in range(64)], [], "forest_climate"
    )
    path = scratch_path(spark, "submission")
    stores.write_csv(classify.scored(split.where("part = 'test'"), fitted).select("vec_id", "prediction"), path)
    return stores.read_csv(spark, path, "vec_id bigint, prediction string")


@query()
def forest_study(spark, folder):
    """The larger, nearly unbounded forest on the records with laboratory values."""
    fitted = classify.train_classifier(
        _records(spark, folder), "disease", [*NUMERIC, "platelet_count", "wbc"], CATEGORICAL, "forest_study", "Dengue"
    )
    scored = classify.scored(_records(spark, folder), fitted)
    return metrics.confusion_matrix(scored, ["Dengue", "Typhoid"], "disease")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {ALERT_SOURCE}, {ASSESSED}
SELECT series_id AS disease, 'National Surveillance' AS region, risk_level, z_score,
  printf('%s outbreak alert for %s: %d projected cases (Z=%.2f).', series_id, strftime(ds, '%Y-%m-%d'), predicted_cases, z_score) AS alert_message,
  false AS is_resolved
FROM assessed WHERE is_anomaly ORDER BY alert_message LIMIT 50""")
def stored_alerts(spark, folder):
    path = scratch_path(spark, "outbreak_alerts")
    alerts = surveillance.alert_rows(peak_alerts(spark, folder), "National Surveillance", "forecast")
    stores.append(alerts, path, stores.ALERTS_SCHEMA)
    return stores.latest(stores.read_store(spark, path, stores.ALERTS_SCHEMA), 50, "created_at", "alert_message").drop("created_at")


@query(ORACLES["stored_alerts"])
def stored_alerts_once(spark, folder):
    """The same through a store of batches: the alerts are written twice and count once."""
    path = scratch_path(spark, "outbreak_alerts")
    alerts = stores.shaped(surveillance.alert_rows(peak_alerts(spark, folder), "National Surveillance", "forecast"), stores.ALERTS_SCHEMA)
    for _ in range(2):
        snapshots.write_batch(alerts, path, "2001-08")
    return stores.latest(snapshots.read_snapshot(spark, path, stores.ALERTS_SCHEMA), 50, "created_at", "alert_message").drop("created_at")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, n_name AS city, r_name AS district,
  23.4::double + n_nationkey * 0.5::double AS latitude, 60.5::double + n_nationkey * 0.7::double AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def stored_centers(spark, folder):
    path = scratch_path(spark, "healthcare_centers")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    centers = (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("city"),
            F.col("r_name").alias("district"), (23.4 + F.col("n_nationkey") * 0.5).alias("latitude"),
            (60.5 + F.col("n_nationkey") * 0.7).alias("longitude"),
        )
    )
    stores.append(centers, path, stores.CENTERS_SCHEMA)
    return stores.read_store(spark, path, stores.CENTERS_SCHEMA)


@query()
def sarima_parameters(spark, folder):
    fitted = arima.fit_sarima(orders_monthly(spark, folder))
    return fitted.select("series_id", *[F.bround(c, 3).alias(c) for c in ("ar", "sar", "ma", "sma", "sse", "aic")])


@query()
def retrain_all(spark, folder):
    """Hold-out scores of both forecast models after a full retraining run."""
    out = retrain(
        orders_monthly(spark, folder), _records(spark, folder), scratch_path(spark, "models"), "record_id", "disease", "Dengue",
        NUMERIC, CATEGORICAL,
    )
    return out.holdout


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 50 AS DOUBLE) END AS number,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) END AS day,
  CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS flag, CAST((c_custkey % 50) * 1000 AS DOUBLE) AS scaled,
  CAST(c_custkey % 50 > 20 AS INTEGER) AS above, CAST(round_even(greatest(c_acctbal / 100, 0.0::double), 0) AS BIGINT) AS whole,
  CASE c_custkey % 5 WHEN 3 THEN 'critical' WHEN 4 THEN 'alert' ELSE 'normal' END AS risk,
  strftime(DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER), '%Y-%m-%d') AS day_text,
  printf('%.1f%%', (c_custkey % 50) / 64.0::double * 100) AS percent FROM customer""")
def lenient_cleaning(spark, folder):
    """Cells of mixed quality through every scalar cleaning expression."""
    key = F.col("c_custkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 300).cast("int"))
    raw = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 3 == 0, "n/a").otherwise((key % 50).cast("string")).alias("n"),
        (key % 50).cast("string").alias("clean"),
        F.when(key % 4 == 0, "not a day").otherwise(day.cast("string")).alias("d"),
        nth_text("c_custkey", ["Yes", "no ", " YES", "CRITICAL", "Alert"]).alias("t"),
        "c_acctbal",
        day.alias("day"),
    )
    return raw.select(
        "c_custkey",
        numbers.lenient_double(F.col("n")).alias("number"),
        dates.parsed_time(F.col("d"), strict=False).cast("date").alias("day"),
        yes_no_flag(F.col("t")).alias("flag"),
        numbers.per_thousand_to_count(F.col("clean")).alias("scaled"),
        numbers.positive_flag(numbers.lenient_double(F.col("clean")) - 20).alias("above"),
        numbers.whole_cases(F.col("c_acctbal") / 100).alias("whole"),
        risk_label(F.col("t")).alias("risk"),
        dates.day_text(F.col("day")).alias("day_text"),
        percent_text(numbers.lenient_double(F.col("clean")) / 64.0).alias("percent"),
    )
