"""Adapters that give the driver's tables the shapes the jobs consume.

The reference reads nested JSON events from a message bus, a member table,
an upload stream and a few document collections. None of these exist in
the test data, so each adapter below derives one of those shapes from the
given tables with plain DataFrame operations (rules in FIXTURES.md §2).
They are pure functions of the tables, so their work grows with the data.

Join strategy: dimension joins are written without hints. Catalyst
broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with runtime
sizes; above that the join shuffles, with AQE splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.sources.tables import fact_table, table

# Fixed adapter parameters (FIXTURES.md §2).
LOGS_AS_OF = "2024-01-16 05:00:00"   # click lookback ends 5 h before this
DASHBOARD_DAY = "20240115"
LEDGER_AS_OF = "2001-08-01"          # month for the ledger views
RECEIPT_FIXTURE_KEYWORDS = ("onen", "eaux")


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


# ---------------------------------------------------------------------------
# members: customer -> nation -> region
# ---------------------------------------------------------------------------
def members(spark: SparkSession, data_dir: str) -> DataFrame:
    c = table(spark, data_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, data_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, data_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    m = c.join(geo, c.c_nationkey == geo.n_nationkey)
    age = (F.lit(15) + (F.col("c_custkey") * 7) % 60).cast("int")
    return m.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_custkey").cast("string").alias("member_id"),
        F.when(F.col("c_custkey") % 2 == 0, "W").otherwise("M").alias("gender_kb"),
        age.alias("age"),
        F.col("r_name").alias("region_kb"),
        F.concat((F.lit(2024) - age + 1).cast("string"), F.lit("-01-01")).alias("birth_dt"),
    )


# ---------------------------------------------------------------------------
# logs: flattened events with member attributes and payload fields
# ---------------------------------------------------------------------------
LOG_COLUMNS = ["event_id", "ts", "k", "member_id", "user_gender", "user_age",
               "user_region", "key", "selected_menu", "save_point", "search_word",
               "product_name", "product_volume", "product_unitprice", "topic",
               "partition"]


PART_COLUMNS = ("search_word", "product_name", "product_volume", "product_unitprice")
MEMBER_COLUMNS = ("member_id", "user_gender", "user_age", "user_region")


#: Parts that events name are broadcast up to this many; beyond, both sides are merged.
FEW_PARTS = 10_000


def _named_parts(ev: DataFrame, part: DataFrame) -> DataFrame:
    """The side of ``part`` that events are joined to.

    A ``part`` within Catalyst's broadcast bound stays as it is. Beyond it, events
    would be shuffled by ``k``, of which few values hold all events; so the
    distinct ``k`` are read first and the counted rows of those parts are
    broadcast. Where they are too many, the join is left to Catalyst."""
    spark = part.sparkSession
    bound = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(str(part._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= bound:
        return part
    keys = [r.k for r in ev.select("k").filter("k IS NOT NULL").distinct().limit(FEW_PARTS + 1).collect()]
    if len(keys) > FEW_PARTS:
        return part
    named = part.filter(F.col("p_partkey").isin(keys))
    return F.broadcast(named) if named.limit(FEW_PARTS + 1).count() <= FEW_PARTS else part


def logs(spark: SparkSession, data_dir: str, members: bool = True, parts: bool = True,
         types: tuple[str, ...] = ()) -> DataFrame:
    """Flattened events. ``members`` and ``parts`` ask for the columns of those
    dimensions, and only what is asked for is joined. ``types`` names the event
    types a caller needs; the filter reaches the scan. A visitor's and an
    unknown member's attributes are ``none``."""
    ev = fact_table(spark, data_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    if types:
        ev = ev.filter(F.col("event_type").isin(*types))
    ev = ev.select("event_id", "ts", "user_id", "event_type", _k(F.col("props")).alias("k"))
    # Joined to the raw dimension scans (not to the derived member table), so
    # Catalyst sizes each side from its files: small sides are broadcast,
    # a large customer table is sort-merge joined with AQE skew splitting.
    # A large part table is first cut to the parts that the events name.
    c = table(spark, data_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, data_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, data_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, data_dir, "part").select("p_partkey", "p_name", "p_size",
                                                 "p_retailprice")
    j = ev
    if parts:
        j = j.join(_named_parts(ev, part), F.col("k") == F.col("p_partkey"), "left")
    if members:
        j = (j.join(c, ev.user_id == c.c_custkey, "left")
              .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
              .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    # A member exists when the customer -> nation -> region chain is complete
    # (the inner joins of ``members``).
    found = F.col("r_regionkey").isNotNull()
    age = (F.lit(15) + (F.col("c_custkey") * 7) % 60).cast("int")
    if members:
        j = j.select("*",
                 F.when(found, F.col("c_custkey").cast("string")).alias("member_id"),
                 F.when(found, F.when(F.col("c_custkey") % 2 == 0, "W").otherwise("M")).alias("gender_kb"),
                 F.when(found, age).alias("age"),
                 F.when(found, F.col("r_name")).alias("region_kb"))
    k, et = F.col("k"), F.col("event_type")
    even = (k % 2 == 0)
    key = (F.when(et == "signup", "login")
           .when((et == "error") & even, "logout")
           .when(et == "error", "lesswaste")
           .when((et == "view") & even, "menuclick")
           .when(et == "view", "search")
           .when(et == "click", "click")
           .when((et == "purchase") & even, "1")
           .when(et == "purchase", "2"))
    visitor = (F.col("user_id") % 10 == 0)

    def member_field(c: Column) -> Column:
        return F.when(visitor, F.lit(S.VISITOR)).otherwise(F.coalesce(c, F.lit(S.VISITOR)))

    menu = (F.when(k % 8 == 0, "nolabel").when(k % 8 == 2, "ecopoint1")
            .when(k % 8 == 4, "ecopoint2").when(k % 8 == 6, "lesswaste"))
    is_click = et == "click"
    price = F.when(k % 10 == 7, F.lit("1,200")) \
        .otherwise(F.floor(F.col("p_retailprice")).cast("bigint").cast("string"))
    columns = ["event_id", "ts", "k"]
    if members:
        columns += [member_field(F.col("member_id")).alias("member_id"),
                    member_field(F.col("gender_kb")).alias("user_gender"),
                    member_field(F.col("age").cast("string")).alias("user_age"),
                    member_field(F.col("region_kb")).alias("user_region")]
    columns += [key.alias("key"), F.when((et == "view") & even, menu).alias("selected_menu"),
                F.when(et == "purchase", (F.lit(10) * (k % 6)).cast("int")).alias("save_point")]
    if parts:
        columns += [
            F.when((et == "view") & ~even, F.col("p_name")).alias("search_word"),
            F.when(is_click, F.col("p_name")).alias("product_name"),
            F.when(is_click, F.concat(F.col("p_size").cast("string"), F.lit("ml"))).alias("product_volume"),
            F.when(is_click, price).alias("product_unitprice")]
    out = j.select(*columns)
    return out.withColumn("topic", S.route_topic("key")) \
              .withColumn("partition", S.route_partition("key"))


def payload_logs(spark: SparkSession, data_dir: str) -> DataFrame:
    """``logs`` with the fields that each event alone writes (rules in FIXTURES.md)."""
    k, text = F.col("k"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    failed = F.coalesce(F.col("save_point") == 0, F.lit(True))
    at = F.when(F.col("key") == "lesswaste", F.array(F.lit(37.0) + (k % 8) / F.lit(8.0), F.lit(126.5) + (k % 4) / F.lit(4.0)))
    return logs(spark, data_dir).select(
        "*",
        *[text.alias(c) for c in ("login_time", "logout_time", "menuclick_time", "eco1upload_time", "eco2upload_time",
                                  "searchclick_time", "productclick_time")],
        F.when(k % 3 == 0, "ButtonClicked").when(k % 3 == 1, "BrowserClosed").otherwise("SessionExpired").alias("logout_method"),
        F.when(k % 5 != 0, F.concat(F.lit("/page/"), k.cast("string"))).alias("menuclick_page"),
        F.when(failed, "").otherwise(F.concat(F.lit("photo-"), F.col("event_id").cast("string"))).alias("photo_id"),
        F.when(failed, "OverCount").otherwise("").alias("fail_msg"),
        (k % 5 + 1).cast("int").alias("radius_km"), at.alias("searchclick_location"))


# ---------------------------------------------------------------------------
# uploads (eco-point service 1) and receipts (service 2)
# ---------------------------------------------------------------------------
def uploads(spark: SparkSession, data_dir: str) -> DataFrame:
    ev = fact_table(spark, data_dir, "events", "event_id", "ts", "user_id", "event_type",
                    "props").select("event_id", "ts", "user_id", "event_type",
                                    _k(F.col("props")).alias("k"))
    k = F.col("k")
    day_start = F.date_trunc("day", F.col("ts"))
    pic_time = (F.when(k % 7 == 0, F.lit(None))
                .when(k % 7 == 1, day_start - F.expr("INTERVAL 1 DAY"))
                .otherwise(day_start + F.make_dt_interval(hours=(k % 3 + 1).cast("int"))))
    return ev.filter((F.col("event_type") == "purchase") & (k % 2 == 0)).select(
        "event_id",
        (F.col("user_id") % 10).alias("member_id"),
        F.lit(1).alias("service"),
        "ts",
        F.to_date("ts").alias("day"),
        F.when(k % 16 == 0, F.lit(20000000)).otherwise(F.lit(1000000)).cast("bigint").alias("size_bytes"),
        pic_time.cast("timestamp_ntz").alias("pic_time"),
        (k % 22 != 0).alias("model_ok"),
        (k % 5).cast("int").alias("plastic_n"),
        F.when(k % 9 <= 1, 1).otherwise(0).cast("int").alias("label_n"),
    )


def receipts(spark: SparkSession, data_dir: str, documents: bool = True,
             keywords: tuple[str, ...] = ()) -> DataFrame:
    """Receipts with the text read from each (``ocr_text``). With ``keywords``
    every document is tested once and the receipts carry the answer
    (``matched``) in place of the text; without ``documents`` they carry
    neither and no join is made."""
    ev = fact_table(spark, data_dir, "events", "event_id", "ts", "user_id", "event_type",
                    "props").select("event_id", "ts", "user_id", "event_type",
                                    _k(F.col("props")).alias("k"))
    j = ev.filter((F.col("event_type") == "purchase") & (F.col("k") % 2 == 1))
    read = []
    if documents:
        # Ten events a document, so the documents reached grow with the tables.
        read = ["matched"] if keywords else ["ocr_text"]
        content = S.contains_any("text", keywords) if keywords else F.col("text")
        docs = table(spark, data_dir, "documents").select("doc_id", content.alias(read[0]))
        j = j.join(docs, F.floor(j.event_id / 10) == docs.doc_id, "left")
    return j.select(
        "event_id",
        (F.col("user_id") % 10).alias("member_id"),
        F.lit(2).alias("service"),
        "ts",
        F.to_date("ts").alias("day"),
        *read,
        (F.col("k") % 22 != 1).alias("model_ok"),
    )


def results(spark: SparkSession, data_dir: str) -> DataFrame:
    """Model-result side of the retraining join: one row per (member, pic_time)."""
    u = uploads(spark, data_dir).filter(F.col("pic_time").isNotNull() & F.col("model_ok"))
    return u.groupBy("member_id", "pic_time").agg(
        F.min("event_id").alias("result_id"))


# ---------------------------------------------------------------------------
# ledger, photos, places, products
# ---------------------------------------------------------------------------
def ledger(spark: SparkSession, data_dir: str) -> DataFrame:
    o = fact_table(spark, data_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.groupBy(
        F.col("o_custkey").alias("member_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month_kb"),
    ).agg(F.sum(F.lit(10) * (F.lit(1) + F.col("o_orderkey") % 5)).cast("bigint").alias("point_amt"))


def photos(spark: SparkSession, data_dir: str) -> DataFrame:
    """One detection per lineitem; a photo is an order. Returned long (one row
    per detection); ``photo_points`` aggregates it without collecting arrays."""
    li = fact_table(spark, data_dir, "lineitem", "l_orderkey", "l_linenumber",
                    "l_returnflag", "l_quantity")
    name = F.when(F.col("l_returnflag") == "A", "plastic") \
        .when(F.col("l_returnflag") == "R", "label").otherwise("other")
    return li.select(F.col("l_orderkey").alias("photo_id"), "l_linenumber",
                     name.alias("name"), (F.col("l_quantity") / 50.0).alias("confidence"))


def places(spark: SparkSession, data_dir: str) -> DataFrame:
    def coords(key: Column):
        return ((F.lit(37.2) + ((key * 7) % 60) * 0.01).alias("lat"),
                (F.lit(126.5) + (key % 100) * 0.01).alias("lng"))

    s = table(spark, data_dir, "supplier").select("s_suppkey", "s_name")
    c = table(spark, data_dir, "customer").select("c_custkey", "c_name")
    shops = s.select(F.col("s_suppkey").alias("place_id"), F.col("s_name").alias("title"),
                     *coords(F.col("s_suppkey")), F.lit("zerowasteshop").alias("kind"))
    boxes = c.select(F.col("c_custkey").alias("place_id"), F.col("c_name").alias("title"),
                     *coords(F.col("c_custkey")), F.lit("recyclebox").alias("kind"))
    return shops.unionByName(boxes)


def products(spark: SparkSession, data_dir: str) -> DataFrame:
    p = table(spark, data_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return p.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("title"),
                    F.col("p_type").alias("volume"),
                    F.col("p_retailprice").alias("price_unit"))


def docs(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "documents").select("doc_id", "text")
