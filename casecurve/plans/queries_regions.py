"""Named queries: the region registry, its filters, roll-up and map."""

from __future__ import annotations

from pyspark.sql import functions as F

from casecurve.operators import regions
from casecurve.plans.regions import registry
from casecurve.plans.registry import query, scan_cte
from casecurve.session import saved_table, scratch_path
from casecurve.sources.stores import latest
from casecurve.sources.tables import event_intakes, table

REGISTRY = f"""
    cases AS (
      SELECT c_nationkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS ds, o_orderpriority AS priority, count(*) AS y
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE lower(o_orderstatus) = 'f' GROUP BY 1, 2, 3),
    spine AS (
      SELECT id, CAST(unnest(generate_series(CAST(min(ds) AS TIMESTAMP), CAST(max(ds) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS ds
      FROM cases GROUP BY id),
    totals AS (SELECT id, ds, sum(y) AS y FROM cases GROUP BY 1, 2),
    series AS (
      SELECT s.id AS series_id, s.ds, CAST(coalesce(t.y, 0) AS BIGINT) AS y
      FROM spine s LEFT JOIN totals t ON t.id = s.id AND t.ds = s.ds),
    {scan_cte()},
    with_before AS (SELECT *, lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS b FROM scan),
    status AS (
      SELECT series_id AS id, max_by(risk_level, ds) AS risk_level, max_by(z_score, ds) AS z_score, max_by(y, ds) AS projected_cases,
             round_even((max_by(y, ds) - arg_max_null(b, ds)) * 100.0::double / greatest(arg_max_null(b, ds), 1), 1) AS case_change_pct
      FROM with_before GROUP BY 1),
    disease AS (
      SELECT id, CASE WHEN coalesce(sum(y) FILTER (priority IN ('1-URGENT', '2-HIGH')), 0)
        >= coalesce(sum(y) FILTER (priority IN ('3-MEDIUM', '4-NOT SPECIFIED')), 0) THEN 'Dengue' ELSE 'Typhoid' END AS primary_disease
      FROM cases GROUP BY 1),
    segments AS (
      SELECT c_nationkey AS id, c_mktsegment AS s, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS r
      FROM customer GROUP BY 1, 2),
    people AS (SELECT c_nationkey AS id, sum(c_acctbal) / 1e6::double AS population_at_risk_millions FROM customer GROUP BY 1),
    sites AS (
      SELECT s_nationkey AS id, list(s_name ORDER BY r) AS sentinel_hospitals FROM (
        SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS r FROM supplier) WHERE r <= 3 GROUP BY 1),
    regions AS (
      SELECT n_nationkey AS id, n_name AS name, r_name AS province, risk_level, z_score, projected_cases, case_change_pct,
             primary_disease, s AS dominant_vector, population_at_risk_millions, sentinel_hospitals,
             23.4::double + n_nationkey * 0.5::double AS latitude, 60.5::double + n_nationkey * 0.7::double AS longitude
      FROM nation JOIN region ON n_regionkey = r_regionkey JOIN status ON status.id = n_nationkey
      JOIN disease ON disease.id = n_nationkey LEFT JOIN segments ON segments.id = n_nationkey AND segments.r = 1
      LEFT JOIN people ON people.id = n_nationkey LEFT JOIN sites ON sites.id = n_nationkey)"""

_PLAIN = "id, name, province, risk_level, z_score, projected_cases, case_change_pct, primary_disease, dominant_vector"


def _plain(df):
    return df.select(*[c.strip() for c in _PLAIN.split(",")])


@query(f"WITH {REGISTRY} SELECT {_PLAIN}, round_even(population_at_risk_millions, 4) AS population_at_risk_millions FROM regions")
def region_registry(spark, folder):
    rows = registry(spark, folder).withColumn("population_at_risk_millions", F.bround("population_at_risk_millions", 4))
    return rows.drop("sentinel_hospitals", "latitude", "longitude")


@query(f"WITH {REGISTRY} SELECT {_PLAIN} FROM regions WHERE lower(primary_disease) = 'dengue' AND contains(lower(province), 'a')")
def region_filter(spark, folder):
    return _plain(regions.filter_regions(registry(spark, folder), disease=" Dengue ", province="A"))


@query(f"WITH {REGISTRY} SELECT {_PLAIN} FROM regions WHERE lower(risk_level) = 'normal' AND province = 'ASIA'")
def region_filter_exact(spark, folder):
    return _plain(regions.filter_regions(registry(spark, folder), risk_level="NORMAL", province="ASIA", exact_province=True))


@query(f"""WITH {REGISTRY} SELECT {_PLAIN} FROM regions WHERE contains(lower(name), '7') OR contains(lower(province), '7')
  OR contains(lower(dominant_vector), '7') OR len(list_filter(sentinel_hospitals, lambda h: contains(lower(h), '7'))) > 0""")
def region_search(spark, folder):
    return _plain(regions.search_regions(registry(spark, folder), "7"))


@query(f"""WITH {REGISTRY} SELECT count(*) AS total_regions, count(*) FILTER (province = 'ASIA') AS filtered_count,
  count(*) FILTER (risk_level = 'Critical') AS critical_hotspots, count(*) FILTER (risk_level = 'Alert') AS alert_zones,
  count(*) FILTER (risk_level = 'Normal') AS stable_districts, CAST(sum(projected_cases) AS BIGINT) AS total_projected_cases,
  CAST(coalesce(sum(projected_cases) FILTER (primary_disease = 'Dengue'), 0) AS BIGINT) AS first_disease_cases,
  CAST(coalesce(sum(projected_cases) FILTER (primary_disease = 'Typhoid'), 0) AS BIGINT) AS second_disease_cases,
  count(*) FILTER (primary_disease = 'Dengue') AS first_disease_regions, count(*) FILTER (primary_disease = 'Typhoid') AS second_disease_regions,
  round_even(sum(population_at_risk_millions), 1) AS population_at_risk_millions FROM regions""")
def region_rollup(spark, folder):
    return regions.region_rollup(registry(spark, folder), regions.region_condition(province="ASIA", exact_province=True))


@query(f"""WITH {REGISTRY}, api AS (SELECT id, name, primary_disease FROM regions WHERE primary_disease = 'Dengue'),
known AS (SELECT n_nationkey AS id, n_name AS name, 'unknown' AS primary_disease FROM nation)
SELECT * FROM api UNION ALL SELECT * FROM known WHERE id NOT IN (SELECT id FROM api)""")
def region_anti_union(spark, folder):
    current = registry(spark, folder).where("primary_disease = 'Dengue'").select("id", "name", "primary_disease")
    known = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("unknown").alias("primary_disease")
    )
    return regions.complete_regions(current, known)


@query(f"""WITH {REGISTRY} SELECT id, floor((40 + (longitude - 60.5::double) / 17.299999999999997::double * 820) * 10.0::double + 0.5::double) / 10.0::double AS x,
  floor((35 + (37.4::double - latitude) / 14.0::double * 730) * 10.0::double + 0.5::double) / 10.0::double AS y,
  round_even(CASE risk_level WHEN 'Critical' THEN 15 WHEN 'Alert' THEN 12 ELSE 9 END
    + least(8.0::double, greatest(0.0::double, log10(CASE WHEN projected_cases = 0 THEN 10 ELSE projected_cases END) * 3.0::double)), 4) AS radius FROM regions""")
def region_geo(spark, folder):
    placed = regions.placed_on_map(registry(spark, folder))
    return placed.select("id", "x", "y", F.bround("radius", 4).alias("radius"))


@query(f"WITH {REGISTRY} SELECT id, name, unnest(sentinel_hospitals) AS hospital FROM regions")
def region_hospitals(spark, folder):
    return regions.hospitals(registry(spark, folder))


@query(f"WITH {REGISTRY} SELECT DISTINCT province FROM regions ORDER BY 1")
def region_provinces(spark, folder):
    return regions.provinces(registry(spark, folder))


@query(f"""WITH {REGISTRY} SELECT id, name FROM regions
ORDER BY CASE WHEN id::VARCHAR = '999' THEN 0 WHEN province = 'EUROPE' THEN 1 ELSE 2 END, id LIMIT 1""")
def region_active(spark, folder):
    rows = registry(spark, folder).select("id", "name", "province", "primary_disease", "risk_level")
    chosen = regions.active_region(rows, "999", regions.region_condition(province="EUROPE", exact_province=True))
    return chosen.select("id", "name")


@query(f"""WITH {REGISTRY} SELECT id, CAST(to_json({{'name': name, 'risk_level': risk_level, 'sentinel_hospitals': sentinel_hospitals}}) AS VARCHAR) AS record
FROM regions""")
def region_records(spark, folder):
    return regions.as_records(registry(spark, folder), ("name", "risk_level", "sentinel_hospitals"))


@query(f"""WITH {REGISTRY} SELECT CAST(to_json({{'total_regions': count(*), 'filtered_count': count(*) FILTER (risk_level = 'Normal'),
  'summary_metrics': {{'critical_hotspots': count(*) FILTER (risk_level = 'Critical'), 'alert_zones': count(*) FILTER (risk_level = 'Alert')}}}}) AS VARCHAR) AS record
FROM regions""")
def region_rollup_record(spark, folder):
    rollup = regions.region_rollup(registry(spark, folder), regions.region_condition(risk_level="normal"))
    return regions.rollup_record(rollup.select("total_regions", "filtered_count", "critical_hotspots", "alert_zones"))


@query("SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def recent_records(spark, folder):
    rows = latest(table(spark, folder, "orders"), 10, "o_orderdate", "o_orderkey")
    return rows.select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))


@query("SELECT event_id, 'P-' || user_id AS patient_code FROM events WHERE contains(lower('P-' || user_id), 'p-1')")
def patient_search(spark, folder):
    return regions.search_patients(event_intakes(spark, folder), "p-1").select("event_id", "patient_code")


@query(f"""WITH {REGISTRY} SELECT {_PLAIN} FROM regions WHERE contains(lower(name), 'ani') OR contains(lower(province), 'ani')
  OR contains(lower(dominant_vector), 'ani') OR len(list_filter(sentinel_hospitals, lambda h: contains(lower(h), 'ani'))) > 0""")
def region_search_indexed(spark, folder):
    """Free-text search through the trigram index."""
    known = saved_table(registry(spark, folder), "regions")
    index = regions.index_regions(known, scratch_path(spark, "index"))
    return _plain(regions.search_regions(known, "ANI", index))


@query("SELECT event_id, 'P-' || user_id AS patient_code FROM events WHERE contains(lower('P-' || user_id), 'p-12')")
def patient_search_indexed(spark, folder):
    intakes = event_intakes(spark, folder)
    index = regions.index_patients(intakes, scratch_path(spark, "index"))
    return regions.search_patients(intakes, "p-12", index).select("event_id", "patient_code")
