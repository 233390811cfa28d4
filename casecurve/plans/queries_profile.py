"""Named queries: data profile, imputation, splits, features and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from casecurve.operators import features, impute, joins, metrics, profile, splits
from casecurve.operators.running import numbered
from casecurve.plans.registry import query
from casecurve.session import saved_table
from casecurve.sources.tables import clinical, table

CLINICAL = """
    clinical AS (
      SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, CAST(toxic AS DOUBLE) AS toxic,
             CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS label
      FROM documents JOIN labels USING (doc_id))"""


@query("SELECT source AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def value_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "documents"), "source", 15)


@query("SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1")
def value_counts_all(spark, folder):
    return profile.value_counts(table(spark, folder, "part"), "p_type")


@query("""SELECT l_linestatus || l_returnflag AS value, round_even(count(*) * 100.0::double / (SELECT count(*) FROM lineitem), 2) AS percent
FROM lineitem GROUP BY 1""")
def class_percent(spark, folder):
    rows = table(spark, folder, "lineitem").select(F.concat("l_linestatus", "l_returnflag").alias("kind"))
    return profile.class_shares(rows, "kind")


@query("""WITH j AS (SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))
SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS "column",
  unnest([count(*) FILTER (doc_id IS NULL), count(*) FILTER (lang IS NULL), count(*) FILTER (quality IS NULL), count(*) FILTER (toxic IS NULL)]) AS n_missing
FROM j""")
def null_counts(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    return profile.null_counts(documents.join(table(spark, folder, "labels"), "doc_id", "left"))


@query("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity, l_discount)""")
def duplicate_count(spark, folder):
    return profile.duplicate_count(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"])


@query("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY text)""")
def duplicate_texts(spark, folder):
    return profile.duplicate_count(table(spark, folder, "documents"), ["text"], digest=True)


@query("SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY 1")
def distinct_values(spark, folder):
    return profile.distinct_sorted(table(spark, folder, "part"), "p_brand")


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS "column", count({c}) AS count, round_even(avg({c}), 2) AS mean,
  round_even(stddev_samp({c}), 2) AS std, round_even(min({c}), 2) AS min, round_even(max({c}), 2) AS max,
  round_even(quantile_cont({c}, 0.25), 2) AS q25, round_even(quantile_cont({c}, 0.5), 2) AS q50,
  round_even(quantile_cont({c}, 0.75), 2) AS q75 FROM lineitem GROUP BY 1"""
    for c in ("l_quantity", "l_extendedprice")
)


@query(_DESCRIBE)
def describe_by_class(spark, folder):
    return profile.describe_by_class(table(spark, folder, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"])


@query("""SELECT l_returnflag, min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max,
  min(l_discount) AS l_discount_min, max(l_discount) AS l_discount_max FROM lineitem GROUP BY 1""")
def range_by_class(spark, folder):
    return profile.range_by_class(table(spark, folder, "lineitem"), "l_returnflag", ["l_quantity", "l_discount"])


@query("""SELECT l_returnflag, count(*) AS n, round_even(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round_even(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round_even(regr_r2(l_extendedprice, l_quantity), 4) AS r2 FROM lineitem GROUP BY 1""")
def linear_fit_by_group(spark, folder):
    return profile.linear_fit(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])


_COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def table_counts(spark, folder):
    return profile.table_counts({t: table(spark, folder, t) for t in _COUNTED})


@query("""SELECT (SELECT count(*) FROM orders) AS n_rows, CAST(t.i AS INTEGER) AS position, t.c AS "column", t.d AS dtype
FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'),
 (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string')) t(i, c, d)""")
def table_shape(spark, folder):
    return profile.shape(table(spark, folder, "orders"))


_HEAD = "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders"


@query(f"({_HEAD} ORDER BY o_orderkey LIMIT 5) UNION ALL ({_HEAD} ORDER BY o_orderkey DESC LIMIT 5)")
def head_and_tail(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    return profile.first_rows(rows, ["o_orderkey"]).unionByName(profile.final_rows(rows, ["o_orderkey"]))


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey::VARCHAR || '|42'), c_custkey LIMIT 5")
def sample_rows(spark, folder):
    return profile.sample_rows(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", 5)


# -- joins and imputation -----------------------------------------------------------------------


@query("SELECT doc_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)")
def natural_join(spark, folder):
    return joins.natural_join(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), table(spark, folder, "labels"))


_GAPPY = """
    gappy AS (
      SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_quantity <= 40 THEN l_quantity END AS quantity,
             CASE WHEN l_discount > 0.02::double THEN l_discount END AS discount, l_shipdate FROM lineitem)"""


def _gappy(spark, folder):
    """Line items with two columns made incomplete by rule."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_quantity") <= 40, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("discount"),
        "l_shipdate",
    )


@query(f"""WITH {_GAPPY}, m AS (SELECT median(quantity) AS mq, median(discount) AS md FROM gappy)
SELECT l_orderkey, l_linenumber, l_returnflag, coalesce(quantity, mq) AS quantity, coalesce(discount, md) AS discount FROM gappy, m""")
def impute_median(spark, folder):
    return impute.fill_median(_gappy(spark, folder).drop("l_shipdate"), ["quantity", "discount"])


@query(f"""WITH {_GAPPY}, m AS (SELECT avg(quantity) AS mq, avg(discount) AS md FROM gappy WHERE l_shipdate < TIMESTAMP '2000-01-01')
SELECT l_orderkey, l_linenumber, l_returnflag, round_even(coalesce(quantity, mq), 6) AS quantity, round_even(coalesce(discount, md), 6) AS discount
FROM gappy, m WHERE l_shipdate >= TIMESTAMP '2000-01-01'""")
def impute_mean_from_train(spark, folder):
    rows = _gappy(spark, folder)
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    train, test = rows.where(F.col("l_shipdate") < cut), rows.where(F.col("l_shipdate") >= cut).drop("l_shipdate")
    filled = impute.fill_mean(test, ["quantity", "discount"], statistics_from=train)
    return filled.withColumns({c: F.bround(c, 6) for c in ("quantity", "discount")})


@query("""WITH g AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer),
m AS (SELECT segment AS top FROM g WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT c_custkey, coalesce(segment, top) AS segment FROM g, m""")
def impute_mode(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    return impute.fill_mode(rows, "segment")


# -- splits -------------------------------------------------------------------------------------


@query(f"""WITH {CLINICAL}, r AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id::VARCHAR || '|42')) AS p,
         count(*) OVER (PARTITION BY label) AS n FROM clinical)
SELECT doc_id, label, CASE WHEN p <= (n * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS part FROM r""")
def stratified_split(spark, folder):
    return splits.stratified_split(saved_table(clinical(spark, folder).select("doc_id", "label"), "labels"), "doc_id", "label")


@query("""WITH r AS (
  SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR || '|42')) AS p,
         count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, o_orderpriority, CASE WHEN p <= (n * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS part FROM r""")
def stratified_split_orders(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return splits.stratified_split(rows, "o_orderkey", "o_orderpriority")


@query(f"""WITH {CLINICAL}, r AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id::VARCHAR || '|42')) - 1 AS p,
         count(*) OVER (PARTITION BY label) AS n FROM clinical)
SELECT doc_id, label, CAST((p * 5) // n AS INTEGER) AS fold FROM r""")
def kfold_stratified(spark, folder):
    return splits.assign_folds(saved_table(clinical(spark, folder).select("doc_id", "label"), "labels"), "doc_id", "label", k=5)


@query("""WITH r AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR || '|0')) - 1 AS p, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST((p * 10) // n AS INTEGER) AS fold FROM r""")
def kfold_shuffled(spark, folder):
    return splits.assign_folds(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", k=10, seed=0)


@query("""SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR || '|42'), 1, 8))::BIGINT / 4294967296.0::double < 0.2::double
  THEN 'test' ELSE 'train' END AS part FROM orders""")
def hash_split(spark, folder):
    return splits.hash_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders")
def numbered_rows(spark, folder):
    return numbered(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


# -- features -----------------------------------------------------------------------------------


@query("""WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT sum(n) AS n, count(*) AS k FROM c)
SELECT o_orderkey, o_orderstatus, round_even(t.n / (t.k * c.n), 6) AS weight FROM orders JOIN c USING (o_orderstatus), t""")
def class_weights(spark, folder):
    rows = features.with_class_weight(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")
    return rows.withColumn("weight", F.bround("weight", 6))


@query("""WITH s AS (SELECT avg(o_totalprice) AS mu, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round_even((o_totalprice - mu) / sd, 6) AS o_totalprice FROM orders, s""")
def standardise(spark, folder):
    rows = features.standardised(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])
    return rows.withColumn("o_totalprice", F.bround("o_totalprice", 6))


@query("""SELECT o_orderkey, o_orderstatus, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F",
  CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""")
def one_hot(spark, folder):
    return features.one_hot(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query("""SELECT l_orderkey, l_linenumber, l_linestatus, CAST(l_linestatus = 'O' AS INTEGER) AS "l_linestatus_O" FROM lineitem""")
def one_hot_binary(spark, folder):
    return features.one_hot(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus"), "l_linestatus")


# -- metrics over a given score -----------------------------------------------------------------

# Score and prediction by rule: longer documents are taken as better ones.
SCORED = f"""{CLINICAL},
    scored AS (
      SELECT doc_id, label, n_chars / (n_chars + 1500.0::double) AS score, CASE WHEN n_chars >= 900 THEN 'good' ELSE 'poor' END AS prediction
      FROM clinical),
    by_score AS (
      SELECT score, count(*) FILTER (label = 'good') AS pos, count(*) FILTER (label <> 'good') AS neg FROM scored GROUP BY 1),
    curve AS (
      SELECT score, pos, neg, sum(pos) OVER w AS pos_upto, sum(neg) OVER w AS neg_upto
      FROM by_score WINDOW w AS (ORDER BY score DESC))"""

ORDER_SCORED = """
    by_score AS (
      SELECT o_totalprice AS score, count(*) FILTER (o_orderstatus = 'F') AS pos, count(*) FILTER (o_orderstatus <> 'F') AS neg
      FROM orders GROUP BY 1),
    curve AS (
      SELECT score, pos, neg, sum(pos) OVER w AS pos_upto, sum(neg) OVER w AS neg_upto
      FROM by_score WINDOW w AS (ORDER BY score DESC))"""


def _scored(spark, folder):
    n = F.col("n_chars")
    return clinical(spark, folder).select(
        "doc_id", "label", (n / (n + 1500.0)).alias("score"), F.when(n >= 900, "good").otherwise("poor").alias("prediction")
    )


_CURVE_F1 = """
    pr AS (
      SELECT score AS threshold, pos_upto / (pos_upto + neg_upto) AS precision, pos_upto / (SELECT sum(pos) FROM by_score) AS recall FROM curve),
    f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10::double) AS f1 FROM pr)"""


@query(f"""WITH {SCORED}, {_CURVE_F1}
SELECT round_even(threshold, 6) AS threshold, round_even(precision, 6) AS precision, round_even(recall, 6) AS recall, round_even(f1, 6) AS f1 FROM f""")
def pr_curve(spark, folder):
    curve = metrics.precision_recall_curve(_scored(spark, folder), "score", F.col("label") == "good")
    return curve.select(*[F.bround(c, 6).alias(c) for c in curve.columns])


@query(f"""WITH {ORDER_SCORED}, {_CURVE_F1}
SELECT threshold, round_even(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, threshold LIMIT 1""")
def pr_threshold(spark, folder):
    best = metrics.best_threshold(table(spark, folder, "orders"), "o_totalprice", F.col("o_orderstatus") == "F")
    return best.withColumn("f1", F.bround("f1", 6))


_AREAS = """SELECT round_even(1.0::double - sum(pos * (neg_upto - neg / 2.0::double)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 4) AS roc_auc,
  round_even(sum(pos * pos_upto / (pos_upto + neg_upto)) / sum(pos), 4) AS average_precision,
  CAST(sum(pos) AS BIGINT) AS n_positive, CAST(sum(neg) AS BIGINT) AS n_negative FROM curve"""


@query(f"WITH {ORDER_SCORED} {_AREAS}")
def roc_auc(spark, folder):
    return metrics.score_areas(table(spark, folder, "orders"), "o_totalprice", F.col("o_orderstatus") == "F")


@query(f"WITH {SCORED} {_AREAS}")
def average_precision(spark, folder):
    return metrics.score_areas(_scored(spark, folder), "score", F.col("label") == "good")


@query(f"""WITH {SCORED}, l(position, actual) AS (VALUES (0, 'poor'), (1, 'good'), (2, 'other'))
SELECT CAST(position AS INTEGER) AS position, actual, count(*) FILTER (label = actual AND prediction = 'poor') AS predicted_poor,
  count(*) FILTER (label = actual AND prediction = 'good') AS predicted_good,
  count(*) FILTER (label = actual AND prediction = 'other') AS predicted_other
FROM l, scored GROUP BY 1, 2""")
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_scored(spark, folder), ["poor", "good", "other"])


SCORES_SQL = """
    pairs AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2),
    roles AS (
      SELECT label AS class, n AS s, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM pairs
      UNION ALL SELECT prediction, 0, n, 0 FROM pairs),
    sums AS (SELECT class, CAST(sum(s) AS BIGINT) AS support, sum(p) AS predicted, sum(h) AS hits FROM roles GROUP BY 1),
    scores AS (
      SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
             CASE WHEN support + predicted > 0 THEN 2 * hits / (support + predicted) ELSE 0 END AS f1 FROM sums)"""


@query(f"""WITH {SCORED}, {SCORES_SQL}, total AS (SELECT CAST(sum(support) AS BIGINT) AS n, sum(hits) / sum(support) AS acc FROM scores)
SELECT class, round_even(precision, 4) AS precision, round_even(recall, 4) AS recall, round_even(f1, 4) AS f1, support FROM scores
UNION ALL SELECT 'accuracy', round_even(acc, 4), round_even(acc, 4), round_even(acc, 4), n FROM total
UNION ALL SELECT 'macro avg', round_even(avg(precision), 4), round_even(avg(recall), 4), round_even(avg(f1), 4), any_value(n) FROM scores, total
UNION ALL SELECT 'weighted avg', round_even(sum(precision * support) / any_value(n), 4), round_even(sum(recall * support) / any_value(n), 4),
  round_even(sum(f1 * support) / any_value(n), 4), any_value(n) FROM scores, total""")
def class_report(spark, folder):
    return metrics.class_report(_scored(spark, folder))


@query(f"""WITH {SCORED}, {SCORES_SQL}
SELECT round_even(sum(hits) / sum(support), 4) AS accuracy, round_even(avg(recall) FILTER (support > 0), 4) AS balanced_accuracy,
  round_even(avg(f1), 4) AS macro_f1, round_even(max(precision) FILTER (class = 'poor'), 4) AS positive_precision,
  round_even(max(recall) FILTER (class = 'poor'), 4) AS positive_recall, round_even(max(f1) FILTER (class = 'poor'), 4) AS positive_f1
FROM scores""")
def overall_scores(spark, folder):
    return metrics.overall_scores(_scored(spark, folder), positive="poor")


@query("""SELECT c_custkey, s_suppkey AS center_id FROM customer JOIN (
  SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS slot, count(*) OVER () AS n FROM supplier) s ON c_custkey % s.n = s.slot""")
def assign_centers(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey")
    return joins.assign_round_robin(rows, table(spark, folder, "supplier"), "c_custkey", "s_suppkey", "center_id")
