import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sieveline.functions.text import plines, pstrip
from sieveline.operators import clean, normalize
from sieveline.operators.extract import strip_ui_headers
from sieveline.plans.oracles import ORACLES


def col_values(spark, values, make):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def strings(n, seed):
    r = random.Random(seed)
    parts = ["a", "share", " ", "\n", "\n\n", "•", "- ", "*", "<b>", "&amp;", "《", "》", "×", "…", "½", "é", "中", "😀", "☀", "(", "faqs", ")", ".", "-", "　", "\xa0", "\x1c", "\x85", "read  more", "\t", "Pin it", "_", "7", "–", "'", "\r\n"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_strip_and_lines_are_pythons(spark):
    values = strings(1500, 1)
    assert col_values(spark, values, pstrip) == [v.strip() for v in values]
    assert col_values(spark, values, plines) == [v.splitlines() for v in values]


def by_sql(query, values):
    """The query's SQL over texts of our own."""
    con = duckdb.connect()
    con.register("texts", pd.DataFrame({"rec_no": range(len(values)), "x": pd.Series(values, dtype=object)}))
    con.execute("CREATE VIEW example_clean AS SELECT rec_no, {'data_info': {'content': x, 'url': 'u'}} AS meta FROM texts")
    return [r[0] for r in con.execute(f"SELECT clean FROM ({ORACLES[query]}) ORDER BY rec_no").fetchall()]


@pytest.mark.parametrize(("query", "step"), [("clean_lines", clean.tidy_lines), ("clean_noise", clean.drop_noise), ("clean_full", clean.clean_text)])
def test_cleaner_equals_sql_on_random_texts(spark, query, step):
    values = [*strings(2500, 2), ""]
    once = col_values(spark, values, step)
    assert once == by_sql(query, values)
    assert col_values(spark, once, step) == by_sql(query, once)


@pytest.mark.parametrize(
    ("text", "cleaned"),
    [
        ("Mix《salt》，stir。", "Mix,stir."), ("a < b, c > d", "a  d"), ("Tom &amp; Jerry &#39;x", "Tom   Jerry  x"), ("350° ± 5 × 2 − 1 … ≠", "350° +/- 5 x 2 - 1 ... ≠"),
        ("中文 hello ☀ 😀 ■ ok", "hello    ok"), ("Share this: add salt", "this: add salt"), ("(answers many FAQs) go", "(answers many ) go"), ("- - a\n* b\n...\n\n\nc", "a\nb\nc"),
        ("•no space\n• space", "•no space\nspace"), ("mid • bullet · dot", "mid • bullet · dot"), ("a\n  \nb", "a\n  \nb"), ("[Image: https://images.amazon.com/a.jpg]", "[Image: https://images..com/a.jpg]"),
        ("–20 degrees", "20 degrees"), ("½share", "½share"),
    ],
)
def test_clean_text_goldens(spark, text, cleaned):
    assert col_values(spark, [text], clean.clean_text) == [cleaned]


@pytest.mark.parametrize(
    ("line", "normal"),
    [("-5 g", "5 g"), ("— dash … 《x》 a·b", "dash - .x. a<b"), ("## Head", "# Head"), ("| a | b |", ""), ("see ![i](u)", ""), ("350°F", "350 degrees F"), ("∑ x ≤ 2", " x <= 2"), ("*  Note   that", "Note that"), (None, None)],
)
def test_norm_line_goldens(spark, line, normal):
    assert col_values(spark, [line], normalize.norm_line) == [normal]


@pytest.mark.parametrize(
    ("text", "masked"),
    [("mail a.b@c.io now", "mail xxx now"), ("4111 1111 1111 1111", "xxx"), ("call +1 (743) 555-3824", "call +xxx"), ("10-12 minutes, 1/2 cup", "10-12 minutes, 1/2 cup"), ("id 1234567890123456789012", "id 1234567890123456789012")],
)
def test_mask_goldens(spark, text, masked):
    assert col_values(spark, [text], normalize.mask_pii) == [masked]


@pytest.mark.parametrize(
    ("text", "left"),
    [("Ingredients\n1 egg", "1 egg"), ("a\n\nNotes about storage: cold\nb", "a\n\nb"), ("Noteworthy\nInstructions: mix", "Noteworthy"), ("INGREDIENTS & SUBSTITUTES list\nx", "x")],
)
def test_ui_headers(spark, text, left):
    assert col_values(spark, [text], strip_ui_headers) == [left]


def test_gates(spark):
    df = spark.createDataFrame([("[Image: https://x/y.jpg]", "t" * 900, None), ("body", "x" * 219, None), ("body", "x" * 219 + "😀", None), ("body", "x" * 300, "RuntimeError"), (None, None, None)], "content string, text string, error string")
    got = [r.r for r in df.select(clean.reject_reason(F.col("content"), F.col("text"), F.col("error")).alias("r")).collect()]
    assert got == ["image_only", "too_short", None, "exception:RuntimeError", "too_short"]
    ok, rejected = clean.split_by_reason(df.withColumn("reason", clean.reject_reason(F.col("content"), F.col("text"), F.col("error"))))
    assert ok.count() + rejected.count() == df.count()


def test_assembly(spark):
    df = spark.createDataFrame([("http://c/i.jpg", "1 egg\n\nshare this", "beat\n\nbake", "  ", ["http://s/1.jpg", "/no.jpg"]), (None, None, None, None, None)], "c string, i string, s string, n string, u array<string>")
    got = df.select(normalize.assemble(F.col("c"), F.col("i"), F.col("s"), F.col("n"), F.col("u")).alias("a")).select("a.*").collect()
    assert got[0].content == "[Image: http://c/i.jpg]\nIngredients\n1 egg\n\nInstructions\nbeat\nbake\n\nNotes\n[Image: http://s/1.jpg]"
    assert (got[0].missing_notes, got[0].images_count) == (True, 1)
    assert (got[1].content, got[1].missing_notes, got[1].images_count) == ("", True, 0)
