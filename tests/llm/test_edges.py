"""Every operator over odd rows and over an empty table."""

import pytest
from pyspark.sql import functions as F

from sieveline.llm import boilerplate, leakage, level, markup, packing, pii, quality, repeated, residue, visual


def operators(spark, model):
    items = spark.createDataFrame([(1, "stir the soup then wait stir the soup then wait stir the soup"), (2, None), (3, ""), (4, "?!")], "item_id bigint, text string")
    capacities = spark.createDataFrame([(1, 7), (2, 64)], "capacity_id int, max_tokens int")
    trained = level.LevelModel(level.Trees(0).fit(__import__("numpy").zeros((1, 1)), __import__("numpy").array([2.0])), (1.5, 2.5), 0.0, 0)
    return {
        "markup": lambda d: markup.markup(d, "rec_no", "content"), "pii": lambda d: pii.masked(d, "rec_no", "content", model), "pii_found": lambda d: pii.found(d, "rec_no", "content", model), "pii_url": lambda d: pii.found(d, "rec_no", "content", model, url="url"),
        "body": lambda d: boilerplate.main_content(d, "rec_no", "content", "url"), "furniture": lambda d: boilerplate.furniture_lines(d, "rec_no", "content", "url"),
        "excess": lambda d: repeated.excess_lines(d, "content", "url"), "occurrences": lambda d: repeated.excess_occurrences(d, "rec_no", "content", "url"), "removed": lambda d: repeated.remove_excess(d, "rec_no", "content", "url"),
        "stats": lambda d: quality.text_statistics(d, "rec_no", "content", "url"), "shape": lambda d: quality.not_prose(d, "rec_no", "content", "url"),
        "canonical": lambda d: visual.canonical(d, "rec_no", "content"), "pairs": lambda d: visual.lookalike_pairs(d, "rec_no", "content"), "classes": lambda d: visual.lookalike_classes(d, "rec_no", "content"),
        "residue": lambda d: residue.residue(d, "rec_no", "content", "url"), "kept": lambda d: residue.without_residue(d, "rec_no", "content", "url"),
        "pack": lambda d: packing.pack(packing.token_sizes(d, "rec_no", "content"), "rec_no", "n_tokens", capacities), "leaks": lambda d: leakage.leaks(d, "rec_no", "content", items, "item_id", "text"), "near": lambda d: leakage.leaks(d, "rec_no", "content", items, "item_id", "text", errors=2),
        "levels": lambda d: level.levels(d, "rec_no", "content", trained),
    }


NAMES = ["markup", "pii", "pii_found", "pii_url", "body", "furniture", "excess", "occurrences", "removed", "stats", "shape", "canonical", "pairs", "classes", "residue", "kept", "pack", "leaks", "near", "levels"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, model, name):
    rows = operators(spark, model)[name](odd).collect()
    if name in ("markup", "pii", "body", "removed", "stats", "canonical", "levels"):
        assert len(rows) == odd.count()  # one row for each row, repeated and null keys too
    if name in ("markup", "pii", "body", "removed", "canonical"):
        by = {r["rec_no"]: r["clean"] for r in rows}
        assert by[1] is None and by[2] == "" and len(by[3]) > 400_000 and len(by[6]) == 300_000
    if name == "stats":
        by = {r["rec_no"]: r for r in rows}
        assert by[1]["shape"] is None and (by[2]["words"], by[2]["shape"]) == (0, "prose") and by[5]["words"] == 0
    if name == "pack":
        assert {r["rec_no"] for r in rows} == {1, 2, 3, None, 5, 6}
    if name == "leaks":
        assert [(r["rec_no"], r["item_id"], r["distance"]) for r in rows] == [(3, 1, 0)]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, odd, model, name):
    assert operators(spark, model)[name](odd.limit(0)).count() == 0


def test_all_null(spark, odd, model):
    nulls = odd.limit(2).select(F.lit(None).cast("bigint").alias("rec_no"), F.lit(None).cast("string").alias("content"), F.lit(None).cast("string").alias("url"))
    for name in NAMES:
        operators(spark, model)[name](nulls).collect()
