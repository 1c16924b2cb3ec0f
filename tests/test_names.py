import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from firmloom.functions import names
from firmloom.functions.text import blank_na


def column(spark, values, function):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r[0] for r in df.orderBy("i").select(function("c")).collect()]


@pytest.mark.parametrize(
    "text, clean",
    [
        (None, ""), ("", ""), ("Inc", "inc"), ("pt pt x", "x"), ("pt", "pt"),
        ("X Co. Ltd", "x"), ("Y S.A.", "y"), ("Z S.p.A. S.A.", "z"), ("Øre ½", "re 1 2"),
        ("＆z", "and z"), ("株式会社", ""), ("Corp corporate company corpx", "corp corporate company corpx"),
        ("Zürich Rück & Söhne AG", "zurich ruck and sohne"), ("  a \tb ", "a b"), ("ﬁn 𝐀b ㎏", "fin ab kg"),
    ],
)
def test_clean_name(spark, text, clean):
    assert column(spark, [text], names.clean_name) == [clean]


def test_long_runs_of_legal_forms(spark):
    got = column(spark, ["pt " * 20000 + "x" + " inc" * 20000, "a " + "s p a " * 9000], names.clean_name)
    assert got == ["x", "a"]


def test_normalize_equals_full_unicode_folding(spark):
    """Every code point with a decomposition, inside a name."""
    chars = [
        c for c in map(chr, range(0x80, 0x110000))
        if not 0xD800 <= ord(c) <= 0xDFFF
        and (unicodedata.combining(c) or unicodedata.normalize("NFKD", c) != c)
    ]
    texts = ["a" + c + "b" for c in chars]

    def folded(text):
        kept = (c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
        return re.sub("[^a-z0-9]+", " ", "".join(kept).lower().replace("&", " and ")).strip()

    assert column(spark, texts, names.normalize_name) == [folded(t) for t in texts]


def test_parse_year(spark):
    dates = ["2017-01-01", " 1999", "99", "None", "20x7", None, "", "\t2020-05", "nan", "<NA>"]
    assert column(spark, dates, names.parse_year) == [2017, 1999, None, None, None, None, None, 2020, None, None]


def test_blank_na(spark):
    cells = ["NA", None, " x ", "null", "na", " NA"]
    assert column(spark, cells, blank_na) == ["", "", "x", "", "na", "NA"]


def test_entity_country(spark):
    df = spark.createDataFrame([("US", "DE"), (None, "DE"), (None, None)], "hq string, legal string")
    got = [r[0] for r in df.select(names.entity_country("hq", "legal")).collect()]
    assert got == ["US", "DE", None]


def test_clean_name_is_planned_once(spark):
    df = spark.createDataFrame([("a",)], "c string").select(names.clean_name("c").alias("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2
    assert df.where(F.col("n") == "a").count() == 1


def test_expanding_characters(spark):
    rows = spark.createDataFrame([("ﬁrm ½ ㎏",), ("Общество Ltd",), ("株式会社 ABC",), ("Ǆungla é",)], "t string")
    found = [r[0] for r in rows.select(names.normalize_name("t")).collect()]
    assert found == ["firm 1 2 kg", "ltd", "abc", "dzungla e"]
