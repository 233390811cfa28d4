"""Substring search with the trigram index against reading every row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from casecurve.operators import regions, trigrams

SCHEMA = "id int, name string, province string, dominant_vector string, sentinel_hospitals array<string>"


def region_rows(seed=1, n=400):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choice(["an", "IA", "b", "é", " ", "St. ", "港", "x"]) for _ in range(rng.randint(0, 6)))

    rows = [(i, text(), rng.choice([None, text()]), text(), rng.choice([None, [], [text(), None, text()]])) for i in range(n)]
    return rows + [(None, "no id, Anian", None, None, None), (3, "a second row of id 3: aniax", None, None, None)]


@pytest.mark.parametrize("needle", ["ani", "ANIA", "a", "éx", "", "  ", "St. ", "t. b", "港an", "nothing like it", "anianian", "%a_"])
def test_same_rows_as_without_an_index(spark, tmp_path, needle):
    df = spark.createDataFrame(region_rows(), SCHEMA)
    index = regions.index_regions(df, str(tmp_path / "i"))
    want = sorted(map(str, regions.search_regions(df, needle).collect()))
    assert sorted(map(str, regions.search_regions(df, needle, index).collect())) == want
    codes = df.select("id", F.col("name").alias("patient_code"))
    by_code = regions.index_patients(codes, str(tmp_path / "p"), "id")
    want = sorted(map(str, regions.search_patients(codes, needle).collect()))
    assert sorted(map(str, regions.search_patients(codes, needle, by_code, "id").collect())) == want


def test_few_rows_are_read(spark, tmp_path):
    codes = spark.range(30_000).select("id", F.concat(F.lit("P-"), F.format_string("%05d", "id")).alias("patient_code"))
    index = regions.index_patients(codes, str(tmp_path / "i"), "id")
    sought = trigrams.wanted_grams(spark, index, "P-1234")
    assert len(sought) <= trigrams.MOST_GRAMS
    near = trigrams.candidates(spark, index, sought)
    hits = regions.search_patients(codes, "P-1234", index, "id")
    assert hits.count() == 10 and 10 <= near.count() <= 60
    # Postings lie in order of their trigrams: the lookup's filter reaches the scan.
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan
    assert trigrams.wanted_grams(spark, index, "Q-1") is None


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    index = regions.index_regions(none, str(tmp_path / "i"))
    assert regions.search_regions(none, "abc", index).collect() == []
