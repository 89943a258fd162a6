"""Schemas of the files, events and tables. Item ids are called ``movie_id`` in
rating files and ``item_id`` in events; both names are public."""

from __future__ import annotations

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("movie_id", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField("movie_id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# What a broker record or a replay file carries.
RECORDS = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
    ]
)

SERVED = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("movie_id", T.IntegerType()),
                        T.StructField("title", T.StringType()),
                        T.StructField("predicted_rating", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)

EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
ALERT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
