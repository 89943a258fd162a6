import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewise.functions import (
    epoch_to_iso,
    exact_round,
    fixed_text,
    iso_to_time,
    split_bucket,
    user_bucket,
)


def test_exact_round_is_python_round(spark):
    values = [m / n for n in (1, 3, 7, 8, 24, 32, 40, 160, 200) for m in range(n, 5 * n)]
    values += [4.625, 4.565, 1.005, 1.015, 0.00625, 2.5, 1e-9, 0.0, -1.125, -2.675]
    rows = (
        spark.createDataFrame([(v,) for v in values], "x double")
        .select(
            "x",
            exact_round(F.col("x"), 2).alias("two"),
            exact_round(F.col("x"), 4).alias("four"),
            fixed_text(F.col("x")).alias("text"),
        )
        .collect()
    )
    assert len(rows) == len(values)
    for row in rows:
        assert row["two"] == round(row["x"], 2), row
        assert row["four"] == round(row["x"], 4), row
        assert row["text"].lstrip("-") == f"{row['x']:.2f}".lstrip("-"), row


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1000, allow_nan=False), min_size=50, max_size=200))
def test_exact_round_on_any_double(spark, values):
    rows = (
        spark.createDataFrame([(v,) for v in values], "x double")
        .select("x", exact_round(F.col("x"), 4).alias("r"))
        .collect()
    )
    assert all(row["r"] == round(row["x"], 4) for row in rows)


def test_exact_round_of_large_values_rounds_their_text(spark):
    df = spark.createDataFrame([(x,) for x in (5_000_000.125, -5_000_000.375, 1e300)], "x double")
    got = [r[0] for r in df.select(exact_round(F.col("x"), 2)).collect()]
    assert got == [5_000_000.12, -5_000_000.38, 1e300]


def test_exact_round_of_null_is_null(spark):
    df = spark.range(1).select(exact_round(F.lit(None).cast("double"), 2).alias("r"))
    assert df.first()["r"] is None


def test_times(spark):
    df = spark.createDataFrame(
        [("2000-12-31T22:12:40",), ("2000",), ("2000-12-31 18:22:40",), ("x",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(iso_to_time(F.col("t")).cast("string")).collect()]
    assert got == ["2000-12-31 22:12:40", None, None, None, None]
    back = spark.range(1).select(epoch_to_iso(F.lit(978300760))).first()[0]
    assert back == "2000-12-31T22:12:40"


def test_split_bucket_is_the_md5_prefix(spark):
    pairs = [(u, m) for u in range(1, 30) for m in (1, 7, 99)]
    df = spark.createDataFrame(pairs, "u int, m int")
    for row in df.select("u", "m", split_bucket(F.col("u"), F.col("m")).alias("b")).collect():
        digest = hashlib.md5(f"{row['u']}:{row['m']}".encode()).hexdigest()
        assert row["b"] == int(digest[:8], 16) % 100


def test_user_bucket_is_in_range(spark):
    df = spark.range(-50, 50).select(user_bucket(F.col("id").cast("int"), 7).alias("b"))
    assert {r["b"] for r in df.distinct().collect()} == set(range(7))
