"""The fixture adapters written as ANSI SQL views (DuckDB dialect).

Used by ``oracle_sql()``: each oracle query is the adapter views it needs
followed by the query body. Only string assembly happens here.
"""

from __future__ import annotations

VISITOR_COND = "e.user_id % 10 = 0"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "members": ((), """
  SELECT c.c_custkey AS user_id, CAST(c.c_custkey AS VARCHAR) AS member_id,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'W' ELSE 'M' END AS gender_kb,
         CAST(15 + (c.c_custkey * 7) % 60 AS INTEGER) AS age,
         r.r_name AS region_kb,
         CAST(2024 - (15 + (c.c_custkey * 7) % 60) + 1 AS VARCHAR) || '-01-01' AS birth_dt
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "ev": ((), """
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events"""),
    "logs0": (("members", "ev"), f"""
  SELECT e.event_id, e.ts, e.k,
    CASE WHEN {VISITOR_COND} THEN 'none' ELSE coalesce(m.member_id, 'none') END AS member_id,
    CASE WHEN {VISITOR_COND} THEN 'none' ELSE coalesce(m.gender_kb, 'none') END AS user_gender,
    CASE WHEN {VISITOR_COND} THEN 'none' ELSE coalesce(CAST(m.age AS VARCHAR), 'none') END AS user_age,
    CASE WHEN {VISITOR_COND} THEN 'none' ELSE coalesce(m.region_kb, 'none') END AS user_region,
    CASE WHEN e.event_type = 'signup' THEN 'login'
         WHEN e.event_type = 'error' AND e.k % 2 = 0 THEN 'logout'
         WHEN e.event_type = 'error' THEN 'lesswaste'
         WHEN e.event_type = 'view' AND e.k % 2 = 0 THEN 'menuclick'
         WHEN e.event_type = 'view' THEN 'search'
         WHEN e.event_type = 'click' THEN 'click'
         WHEN e.event_type = 'purchase' AND e.k % 2 = 0 THEN '1'
         WHEN e.event_type = 'purchase' THEN '2' END AS key,
    CASE WHEN e.event_type = 'view' AND e.k % 2 = 0 THEN
         CASE e.k % 8 WHEN 0 THEN 'nolabel' WHEN 2 THEN 'ecopoint1'
                      WHEN 4 THEN 'ecopoint2' WHEN 6 THEN 'lesswaste' END END AS selected_menu,
    CASE WHEN e.event_type = 'purchase' THEN CAST(10 * (e.k % 6) AS INTEGER) END AS save_point,
    CASE WHEN e.event_type = 'view' AND e.k % 2 <> 0 THEN p.p_name END AS search_word,
    CASE WHEN e.event_type = 'click' THEN p.p_name END AS product_name,
    CASE WHEN e.event_type = 'click' THEN CAST(p.p_size AS VARCHAR) || 'ml' END AS product_volume,
    CASE WHEN e.event_type = 'click' THEN
         CASE WHEN e.k % 10 = 7 THEN '1,200'
              ELSE CAST(CAST(floor(p.p_retailprice) AS BIGINT) AS VARCHAR) END END AS product_unitprice
  FROM ev e
  LEFT JOIN members m ON e.user_id = m.user_id
  LEFT JOIN part p ON e.k = p.p_partkey"""),
    "logs": (("logs0",), """
  SELECT *,
    CASE key WHEN 'login' THEN 'log_inout' WHEN 'logout' THEN 'log_inout'
             WHEN 'menuclick' THEN 'log_menuclick' WHEN '1' THEN 'log_ecopoint'
             WHEN '2' THEN 'log_ecopoint' WHEN 'search' THEN 'log_nolabel'
             WHEN 'click' THEN 'log_nolabel' WHEN 'lesswaste' THEN 'log_lesswaste'
             WHEN 'error' THEN 'log_error' END AS topic,
    CAST(CASE WHEN key IN ('logout', '2', 'click') THEN 1 ELSE 0 END AS INTEGER) AS partition
  FROM logs0"""),
    "plogs": (("logs",), """
  SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS login_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS logout_time,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS menuclick_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS eco1upload_time,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS eco2upload_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS searchclick_time,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS productclick_time,
    CASE k % 3 WHEN 0 THEN 'ButtonClicked' WHEN 1 THEN 'BrowserClosed' ELSE 'SessionExpired' END AS logout_method,
    CASE WHEN k % 5 <> 0 THEN '/page/' || CAST(k AS VARCHAR) END AS menuclick_page,
    CASE WHEN coalesce(save_point = 0, true) THEN '' ELSE 'photo-' || CAST(event_id AS VARCHAR) END AS photo_id,
    CASE WHEN coalesce(save_point = 0, true) THEN 'OverCount' ELSE '' END AS fail_msg,
    CAST(k % 5 + 1 AS INTEGER) AS radius_km,
    CASE WHEN key = 'lesswaste' THEN [37.0::DOUBLE + (k % 8) / 8.0::DOUBLE, 126.5::DOUBLE + (k % 4) / 4.0::DOUBLE] END
      AS searchclick_location
  FROM logs"""),
    "uploads": (("ev",), """
  SELECT event_id, user_id % 10 AS member_id, 1 AS service, ts, CAST(ts AS DATE) AS day,
    CAST(CASE WHEN k % 16 = 0 THEN 20000000 ELSE 1000000 END AS BIGINT) AS size_bytes,
    CASE WHEN k % 7 = 0 THEN NULL
         WHEN k % 7 = 1 THEN date_trunc('day', ts) - INTERVAL 1 DAY
         ELSE date_trunc('day', ts) + to_hours(CAST(k % 3 + 1 AS BIGINT)) END AS pic_time,
    k % 22 <> 0 AS model_ok,
    CAST(k % 5 AS INTEGER) AS plastic_n,
    CAST(CASE WHEN k % 9 <= 1 THEN 1 ELSE 0 END AS INTEGER) AS label_n
  FROM ev WHERE event_type = 'purchase' AND k % 2 = 0"""),
    "receipts": (("ev",), """
  SELECT e.event_id, e.user_id % 10 AS member_id, 2 AS service, e.ts, CAST(e.ts AS DATE) AS day,
    d.text AS ocr_text, e.k % 22 <> 1 AS model_ok
  FROM ev e LEFT JOIN documents d ON e.event_id // 10 = d.doc_id
  WHERE e.event_type = 'purchase' AND e.k % 2 = 1"""),
    "results": (("uploads",), """
  SELECT member_id, pic_time, min(event_id) AS result_id
  FROM uploads WHERE pic_time IS NOT NULL AND model_ok
  GROUP BY member_id, pic_time"""),
    "ledger": ((), """
  SELECT o_custkey AS member_id, strftime(o_orderdate, '%Y-%m') AS month_kb,
         CAST(sum(10 * (1 + o_orderkey % 5)) AS BIGINT) AS point_amt
  FROM orders GROUP BY 1, 2"""),
    "photos": ((), """
  SELECT l_orderkey AS photo_id, l_linenumber,
    CASE l_returnflag WHEN 'A' THEN 'plastic' WHEN 'R' THEN 'label' ELSE 'other' END AS name,
    l_quantity / 50.0 AS confidence
  FROM lineitem"""),
    "places": ((), """
  SELECT s_suppkey AS place_id, s_name AS title,
         37.2::DOUBLE + ((s_suppkey * 7) % 60) * 0.01::DOUBLE AS lat,
         126.5::DOUBLE + (s_suppkey % 100) * 0.01::DOUBLE AS lng,
         'zerowasteshop' AS kind FROM supplier
  UNION ALL
  SELECT c_custkey, c_name, 37.2::DOUBLE + ((c_custkey * 7) % 60) * 0.01::DOUBLE,
         126.5::DOUBLE + (c_custkey % 100) * 0.01::DOUBLE, 'recyclebox' FROM customer"""),
    "products": ((), """
  SELECT p_partkey AS doc_id, p_name AS title, p_type AS volume, p_retailprice AS price_unit
  FROM part"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named adapter views (and their inputs) and
    any extra named sub-queries, followed by ``body``."""
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in _order(views)]
    parts += [f"{n} AS ({q}\n)" for n, q in (extra or {}).items()]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


# Age bands in SQL, same rules as verdant.functions.scalars.
def band_sql(age: str) -> str:
    return f"CAST(CASE WHEN {age} >= 60 THEN 60 ELSE 10 * floor({age} / 10) END AS BIGINT)"


def age_hourly_sql(text: str) -> str:
    a = f"(CASE WHEN {text} = 'none' THEN -1 ELSE TRY_CAST({text} AS INTEGER) END)"
    return band_sql(a)


def age_search_sql(text: str) -> str:
    return f"CAST(CASE WHEN {text} = 'none' THEN 99 ELSE {band_sql(f'TRY_CAST({text} AS INTEGER)')} END AS BIGINT)"


def age_click_sql(text: str) -> str:
    return f"CAST(coalesce({band_sql(f'TRY_CAST({text} AS INTEGER)')}, 99) AS BIGINT)"
