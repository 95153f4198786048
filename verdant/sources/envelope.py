"""The bus message: nested JSON envelope, bus record, decode and encode.

``{messageType, timestamp, fields: {event, topic, key, fields: {...}}}``.
Decoding is one ``from_json`` with a fixed schema; unknown fields are
dropped, malformed text gives a struct of nulls, and a field of the wrong
type is null on its own. Rows whose ``fields.key`` is null are the
quarantine output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions import scalars as S

MESSAGE_TYPE = "Kafka"
# The event name logged for each bus key.
EVENT_BY_KEY = {
    "login": "UserLogin",
    "logout": "UserLogout",
    "menuclick": "UserClickMenu",
    "1": "UserUsedEcopoint1",
    "2": "UserUsedEcopoint2",
    "search": "UserSearchProduct",
    "click": "UserClickProduct",
    "lesswaste": "UserSearchLesswaste",
}
WALL_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

PAYLOAD_FIELDS = [
    ("member_id", T.StringType()),
    ("user_gender", T.StringType()),
    ("user_age", T.StringType()),
    ("user_region", T.StringType()),
    ("save_point", T.IntegerType()),
    ("login_time", T.StringType()),
    ("logout_time", T.StringType()),
    ("searchclick_location", T.StringType()),
    ("searchclick_time", T.StringType()),
    ("selected_menu", T.StringType()),
    ("search_word", T.StringType()),
    ("product_name", T.StringType()),
    ("product_volume", T.StringType()),
    ("product_unitprice", T.StringType()),
    ("productclick_time", T.TimestampType()),
]


def envelope_schema(timestamp_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Union of the three schemas the jobs declare. With ``StringType`` the
    envelope time is kept as text and parsed as wall time (zone-independent)."""
    return T.StructType([
        T.StructField("messageType", T.StringType()),
        T.StructField("timestamp", timestamp_type),
        T.StructField("fields", T.StructType([
            T.StructField("event", T.StringType()),
            T.StructField("topic", T.StringType()),
            T.StructField("key", T.StringType()),
            T.StructField("fields", T.StructType(
                [T.StructField(n, t) for n, t in PAYLOAD_FIELDS])),
        ])),
    ])


ENVELOPE_SCHEMA = envelope_schema()
BUS_COLUMNS = ["key", "value", "topic", "partition", "timestamp"]


def event_name(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    expr = None
    for name, ev in EVENT_BY_KEY.items():
        expr = F.when(k == name, ev) if expr is None else expr.when(k == name, ev)
    return expr


# ---------------------------------------------------------------------------
# Encode (producer side, S7 + P23)
# ---------------------------------------------------------------------------
ENCODED_PAYLOAD = ["member_id", "user_gender", "user_age", "user_region", "save_point",
                   "selected_menu", "search_word", "product_name", "product_volume",
                   "product_unitprice"]


def envelope_value(logs: DataFrame, time_col: str = "ts", offset_hours: int = 0) -> Column:
    """JSON text of the envelope. ``offset_hours`` shifts the time before it is
    written (the producer writes epoch time + 9 h labelled ``Z``); the fixture's
    ``ts`` already is wall time, so its default is 0."""
    ts = F.col(time_col)
    if offset_hours:
        ts = ts + F.make_dt_interval(hours=F.lit(offset_hours))
    inner = F.struct(*[F.col(c) for c in ENCODED_PAYLOAD])
    env = F.struct(
        F.lit(MESSAGE_TYPE).alias("messageType"),
        F.date_format(ts, WALL_TIME_FORMAT).alias("timestamp"),
        F.struct(event_name("key").alias("event"), S.route_topic("key").alias("topic"),
                 F.col("key"), inner.alias("fields")).alias("fields"))
    return F.to_json(env, {"ignoreNullFields": "false"})


def encode_envelope(logs: DataFrame, time_col: str = "ts", offset_hours: int = 0,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Bus records (key, value, topic, partition, timestamp) for log rows."""
    return logs.select(
        *keep,
        F.col("key"),
        envelope_value(logs, time_col, offset_hours).alias("value"),
        S.route_topic("key").alias("topic"),
        S.route_partition("key").alias("partition"),
        F.col(time_col).alias("timestamp"))


def to_binary_record(records: DataFrame) -> DataFrame:
    """Key and value as bytes, the way a bus connector delivers them."""
    return records.withColumn("key", F.col("key").cast("binary")) \
                  .withColumn("value", F.col("value").cast("binary"))


# ---------------------------------------------------------------------------
# Decode (consumer side, S5 + S6 + P1)
# ---------------------------------------------------------------------------
def decode(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S5 + S6: bytes (or text) to the envelope struct ``env``."""
    schema = envelope_schema(T.StringType())
    return records.select(
        *keep,
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("env"),
        *[c for c in ("topic", "partition", "timestamp") if c in records.columns])


def flatten_envelope(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The envelope's payload as flat log columns; event time as wall time."""
    f = "env.fields.fields."
    return decoded.select(
        *keep,
        F.to_timestamp_ntz(F.col("env.timestamp"), F.lit(WALL_TIME_FORMAT)).alias("ts"),
        F.col("env.fields.key").alias("key"),
        F.col("env.fields.topic").alias("topic"),
        F.col("env.fields.event").alias("event"),
        *[F.col(f + c).alias(c) for c in ENCODED_PAYLOAD])


def quarantine(decoded: DataFrame) -> DataFrame:
    """Rows the decoder could not place: not JSON, or no ``fields.key``."""
    return decoded.filter(F.col("env.fields.key").isNull())


def decoded_only(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("env.fields.key").isNotNull())


def payload_fields(df: DataFrame, payload: str, keep: tuple[str, ...] = (),
                   skip=S.PAYLOAD_SKIP_FIELDS) -> DataFrame:
    """P24 in long form: one row per (field, value) of a payload map, reserved
    and secret fields dropped. A plain ``isin`` after the explode stays in
    generated code (``redact`` is the map-to-map form)."""
    long = df.select(*keep, F.explode(payload).alias("field", "value"))
    return long.filter(~F.col("field").isin(list(dict.fromkeys(skip))))


SIMPLE_TYPES = (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType,
                T.NullType, T.ArrayType, T.MapType, T.StructType)


def simple_values(df: DataFrame) -> DataFrame:
    """P25: payload columns as a JSON record can hold them. Texts, truth values,
    numbers, lists, maps and records stay; every other type (dates, times,
    decimals, bytes) becomes its text, null stays null."""
    return df.select(*[F.col(f.name) if isinstance(f.dataType, SIMPLE_TYPES)
                       else F.col(f.name).cast("string").alias(f.name) for f in df.schema.fields])


def click_payload(df: DataFrame) -> DataFrame:
    """Each row as one JSON text column ``value`` (nulls written as null)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
                     .alias("value"))
