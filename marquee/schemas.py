"""Fixed record schemas of the recommender and the log records."""

from __future__ import annotations

from pyspark.sql import types as T

MOVIE_FIELDS = [
    "mid", "name", "descri", "timelong", "issue", "shoot",
    "language", "genres", "actors", "direstors",
]

MOVIE = T.StructType(
    [T.StructField("mid", T.IntegerType())]
    + [T.StructField(f, T.StringType()) for f in MOVIE_FIELDS[1:]]
)

RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.IntegerType()),
])

REC_ITEM = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

# Field lists of the two typed log record kinds, in order.
LOG_RECORD_FIELDS = {
    "wechat": [
        "imei", "imsi", "longitude", "latitude", "phone_mac", "device_mac",
        "device_number", "collect_time", "username", "phone",
        "object_username", "send_message", "accept_message", "message_time",
    ],
    "mail": [
        "imei", "imsi", "longitude", "latitude", "phone_mac", "device_mac",
        "device_number", "collect_time", "send_mail", "send_time",
        "accept_mail", "accept_time", "mail_content", "mail_type",
    ],
}


def log_record_schema(kind: str) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in LOG_RECORD_FIELDS[kind]])
