"""Region registry: filters, search, roll-up and map placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.functions.geo import map_x, map_y, marker_radius
from casecurve.operators.joins import prefer_first
from casecurve.operators.trigrams import Index, build_index, search


def _same(column: str, wanted: str | None) -> Column:
    return F.lit(True) if not wanted else F.lower(column) == wanted.strip().lower()


def region_condition(
    disease: str | None = None, risk_level: str | None = None, province: str | None = None, exact_province: bool = False
) -> Column:
    """Optional filters: disease and grade by equality, province by part of its name or exactly."""
    condition = _same("primary_disease", disease) & _same("risk_level", risk_level)
    if province:
        if exact_province:
            condition = condition & (F.col("province") == province)
        else:
            condition = condition & F.lower("province").contains(province.strip().lower())
    return condition


def filter_regions(regions: DataFrame, **filters) -> DataFrame:
    return regions.where(region_condition(**filters))


def _mentions(needle: str) -> Column:
    found = F.lit(False)
    for column in ("name", "province", "dominant_vector"):
        found = found | F.coalesce(F.lower(column).contains(needle), F.lit(False))
    return found | F.coalesce(F.exists("sentinel_hospitals", lambda h: F.lower(h).contains(needle)), F.lit(False))


def index_regions(regions: DataFrame, path: str, key: str = "id") -> Index:
    """A trigram index of the texts that ``search_regions`` looks into."""
    texts = [F.col(c) for c in ("name", "province", "dominant_vector", "sentinel_hospitals")]
    return build_index(regions, key, texts, path)


def search_regions(regions: DataFrame, text: str, index: Index | None = None, key: str = "id") -> DataFrame:
    """Regions whose name, province, vector or any hospital contains ``text``, in any casing; with an index, the same from fewer rows."""
    if not text.strip():
        return regions
    found = _mentions(text.lower())
    return regions.where(found) if index is None else search(regions, index, key, text, found)


def index_patients(intakes: DataFrame, path: str, key: str = "event_id") -> Index:
    return build_index(intakes, key, [F.col("patient_code")], path)


def search_patients(intakes: DataFrame, text: str, index: Index | None = None, key: str = "event_id") -> DataFrame:
    found = F.lower(F.coalesce("patient_code", F.lit(""))).contains(text.lower())
    return intakes.where(found) if index is None else search(intakes, index, key, text, found)


def region_rollup(regions: DataFrame, condition: Column | None = None, first: str = "Dengue", second: str = "Typhoid") -> DataFrame:
    """Totals over all regions, with the number that pass ``condition``, in one pass."""
    cases = F.coalesce("projected_cases", F.lit(0))

    def of(disease: str) -> Column:
        return F.col("primary_disease") == disease

    return regions.agg(
        F.count(F.lit(1)).alias("total_regions"),
        F.count_if(condition if condition is not None else F.lit(True)).alias("filtered_count"),
        F.count_if(F.col("risk_level") == "Critical").alias("critical_hotspots"),
        F.count_if(F.col("risk_level") == "Alert").alias("alert_zones"),
        F.count_if(F.col("risk_level") == "Normal").alias("stable_districts"),
        F.coalesce(F.sum(cases), F.lit(0)).alias("total_projected_cases"),
        F.coalesce(F.sum(F.when(of(first), cases)), F.lit(0)).alias("first_disease_cases"),
        F.coalesce(F.sum(F.when(of(second), cases)), F.lit(0)).alias("second_disease_cases"),
        F.count_if(of(first)).alias("first_disease_regions"),
        F.count_if(of(second)).alias("second_disease_regions"),
        F.bround(F.coalesce(F.sum("population_at_risk_millions"), F.lit(0.0)), 1).alias("population_at_risk_millions"),
    )


def complete_regions(current: DataFrame, known: DataFrame) -> DataFrame:
    """The current registry plus known regions it lacks."""
    return prefer_first(current, known, ["id"])


def active_region(regions: DataFrame, selected: str | None, condition: Column, order: str = "id") -> DataFrame:
    """The selected region, else the first that passes the filter, else the first of all."""
    chosen = F.col("id").cast("string") == selected if selected is not None else F.lit(False)
    rank = F.when(chosen, 0).when(condition, 1).otherwise(2)
    return regions.orderBy(rank, order).limit(1)


def provinces(regions: DataFrame) -> DataFrame:
    return regions.where(F.length(F.coalesce("province", F.lit(""))) > 0).select("province").distinct().orderBy("province")


def placed_on_map(regions: DataFrame) -> DataFrame:
    """Adds map coordinates and marker radius."""
    return regions.select(
        "*",
        map_x(F.col("longitude")).alias("x"),
        map_y(F.col("latitude")).alias("y"),
        marker_radius(F.col("risk_level"), F.col("projected_cases")).alias("radius"),
    )


def hospitals(regions: DataFrame) -> DataFrame:
    return regions.select("id", "name", F.explode("sentinel_hospitals").alias("hospital"))


def as_records(df: DataFrame, columns: tuple[str, ...], key: str = "id") -> DataFrame:
    """Every row as one JSON record beside its key; rows are not gathered, missing values stay as null."""
    return df.select(key, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("record"))


def rollup_record(rollup: DataFrame) -> DataFrame:
    """The one-row roll-up as a nested JSON record: counts at the top, metrics inside."""
    top = ["total_regions", "filtered_count"]
    metrics = F.struct(*[c for c in rollup.columns if c not in top]).alias("summary_metrics")
    return rollup.select(F.to_json(F.struct(*top, metrics), {"ignoreNullFields": "false"}).alias("record"))
