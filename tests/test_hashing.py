import random

import pytest

from evenkeel.functions import hashing

SCHEMA = "a string, n int, b string, x double, t timestamp_ntz, c array<string>"


def digests(df, columns, plain):
    one, two = hashing.row_digest(df, columns, plain)
    text = hashing._joined(columns, hashing.NULL_VALUE)
    return df.selectExpr(f"struct({one} as one, {two} as two) as digest", f"{text} as text")


@pytest.mark.parametrize("typed", [True, False])
def test_digests_agree_exactly_where_texts_do(spark, typed):
    """Also when separators inside texts move the borders between columns, and with nulls anywhere."""
    rng = random.Random(7)
    texts = [None, "NULL", "", "|", "a", "a|", "|a", "a|1", "1", "1|a", "NULL|1", "1|NULL"]
    rows = [
        (rng.choice(texts), rng.choice([None, 1]), rng.choice(texts), rng.choice([None, 0.0, -0.0, 1.0]), None,
         rng.choice([None, [], ["a"], ["a|1"], [None]]))
        for _ in range(20_000)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = hashing.plain_columns(df, df, df.columns) if typed else set()
    assert plain == ({"n", "x", "t"} if typed else set())
    found = digests(df, df.columns, plain)
    pairs = found.distinct().count()
    assert pairs == found.select("text").distinct().count() == found.select("digest").distinct().count() > 1000


def test_single_column(spark):
    df = spark.createDataFrame([(v,) for v in (None, "NULL", "a|b", "a", "")], "a string")
    found = digests(df, ["a"], set())
    assert found.select("digest").distinct().count() == 4


def test_types_that_differ_are_compared_as_text(spark):
    narrow, wide = spark.sql("select 5 as a, 'x' as b"), spark.sql("select 5L as a, 'x' as b")
    plain = hashing.plain_columns(narrow, wide, ["a", "b"])
    assert plain == set()
    one, two = (digests(df, ["a", "b"], plain).collect()[0] for df in (narrow, wide))
    assert one == two


def test_value_digest_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("NULL", "a"), ("a", "a"), (None, None)], "a string, b string")
    one, two = hashing.value_digest(df, ["a", "b"])
    assert df.selectExpr(one, two).distinct().count() == 5
