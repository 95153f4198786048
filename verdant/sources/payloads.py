"""S7/S6 with every event's own payload, carried as VARIANT.

Each event writes other fields (a login its time, a logout its method, a shop
search its radius and place). A struct of all of them would give every record
the fields of every event; a VARIANT value holds exactly the fields of its
event, nulls included, and reading takes them out by path without a schema of
the whole record. Malformed text becomes a null VARIANT and goes to the
quarantine. All of it is column expressions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.sources import envelope as env

MEMBER_FIELDS = ["member_id", "user_gender", "user_age", "user_region"]
# The fields that each event writes besides the member's, by bus key.
EVENT_FIELDS = {
    "login": ["login_time"],
    "logout": ["logout_method", "logout_time"],
    "menuclick": ["selected_menu", "menuclick_page", "menuclick_time"],
    "1": ["save_point", "photo_id", "eco1upload_time", "fail_msg"],
    "2": ["save_point", "eco2upload_time", "fail_msg"],
    "search": ["search_word", "searchclick_time"],
    "click": ["product_name", "product_volume", "product_unitprice", "productclick_time"],
    "lesswaste": ["radius_km", "searchclick_location", "searchclick_time"],
}
FIELD_TYPES = {"save_point": "int", "radius_km": "int", "searchclick_location": "array<double>"}
#: Every payload field once, in the order of the events.
ALL_FIELDS = list(dict.fromkeys([*MEMBER_FIELDS, *(f for fs in EVENT_FIELDS.values() for f in fs)]))


def payload_variant(key: str = "key") -> Column:
    """The payload of a row's event as a VARIANT object; null for an unknown event."""
    out = None
    for name, fields in EVENT_FIELDS.items():
        value = F.to_variant_object(F.struct(*MEMBER_FIELDS, *fields))
        out = F.when(F.col(key) == name, value) if out is None else out.when(F.col(key) == name, value)
    return out


def encode_payloads(events: DataFrame, time_col: str = "ts", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bus records (key, value, topic, partition, timestamp) of event rows."""
    record = F.struct(
        F.lit(env.MESSAGE_TYPE).alias("messageType"),
        F.date_format(time_col, env.WALL_TIME_FORMAT).alias("timestamp"),
        F.struct(env.event_name("key").alias("event"), S.route_topic("key").alias("topic"), F.col("key"),
                 payload_variant().alias("fields")).alias("fields"))
    return events.select(*keep, "key", F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
                         S.route_topic("key").alias("topic"), S.route_partition("key").alias("partition"),
                         F.col(time_col).alias("timestamp"))


def parse_records(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bytes or text of each record as VARIANT ``record`` (null where malformed)."""
    return records.select(*keep, F.try_parse_json(F.col("value").cast("string")).alias("record"))


def _key() -> Column:
    return F.try_variant_get("record", "$.fields.key", "string")


def unplaced(parsed: DataFrame) -> DataFrame:
    """Quarantine: not JSON, or without ``fields.key``."""
    return parsed.filter(_key().isNull())


def payload_columns(parsed: DataFrame, keep: tuple[str, ...] = (), fields: list[str] | None = None) -> DataFrame:
    """The placed records with every payload field as a column: null where the
    record has no such field, or holds it in another type."""
    return parsed.filter(_key().isNotNull()).select(
        *keep,
        F.to_timestamp_ntz(F.try_variant_get("record", "$.timestamp", "string"), F.lit(env.WALL_TIME_FORMAT)).alias("ts"),
        _key().alias("key"), F.try_variant_get("record", "$.fields.topic", "string").alias("topic"),
        F.try_variant_get("record", "$.fields.event", "string").alias("event"),
        *[F.try_variant_get("record", f"$.fields.fields.{f}", FIELD_TYPES.get(f, "string")).alias(f)
          for f in (fields or ALL_FIELDS)])
