"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is plain SQL over the pre-registered test tables. Shared steps (the bronze binding of
``events``, the catalogue from ``part``, silver, enrichment) are common table expressions; ``build``
prepends only the ones a query needs, in dependency order.
"""

from __future__ import annotations

from .schemas import FUNNEL_EVENT_TYPES

# Fixed literals shared with the Spark side.
AS_OF = "2024-02-01 00:00:00"
RUN_STARTED_AT = "2024-01-15 12:00:00"
INVOCATION_ID = "run-0001"
HEALTH_AS_OF = "2024-01-15 12:00:00"

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (sql.strip(), deps)


def build(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return body.strip()
    parts = [f"{n} AS (\n{_CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# --------------------------------------------------------------------------------------------------------
# Binding of the test tables
# --------------------------------------------------------------------------------------------------------
cte(
    "ev_copies",
    """
SELECT e.event_id AS eid, e.user_id AS uid, e.event_type AS et, e.ts, e.value,
       CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 10 AS k, c.copy
FROM events e CROSS JOIN (VALUES (0), (1)) AS c(copy)
WHERE c.copy = 0 OR e.event_id % 10 = 0
""",
)

cte(
    "bronze",
    """
SELECT
  'evt_' || lpad(CAST(eid AS VARCHAR), 8, '0') AS event_id,
  CASE WHEN eid % 97 = 0 THEN NULL ELSE 'user_' || lpad(CAST(uid AS VARCHAR), 6, '0') END AS user_id,
  'sess_' || CAST(uid AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
  CASE et WHEN 'click' THEN 'page_view' WHEN 'view' THEN 'view_item' WHEN 'signup' THEN 'add_to_cart'
          WHEN 'purchase' THEN 'purchase' ELSE et END AS event_type,
  ts AS event_timestamp,
  ts + to_seconds(CAST(eid % 120 + copy * 3600 AS BIGINT)) AS processing_timestamp,
  CASE WHEN et IN ('view', 'signup', 'purchase') THEN 'prod_' || lpad(CAST(k AS VARCHAR), 8, '0') END AS product_id,
  CASE WHEN et IN ('view', 'signup', 'purchase') AND eid % 3 <> 0 THEN 'cat_' || CAST(k % 3 AS VARCHAR) END AS category_id,
  CASE WHEN et IN ('view', 'signup', 'purchase') AND eid % 3 <> 0 THEN 'Category ' || CAST(k % 3 AS VARCHAR) END AS category_name,
  CASE WHEN et IN ('view', 'signup', 'purchase') AND eid % 4 <> 0 THEN 'EventBrand' END AS brand,
  CASE WHEN et IN ('view', 'signup', 'purchase') AND eid % 7 <> 0
       THEN CASE WHEN eid % 89 = 0 THEN 0.0::DOUBLE ELSE value + copy END END AS price,
  CASE WHEN eid % 11 = 0 THEN NULL ELSE 'BRL' END AS currency,
  CASE WHEN et = 'click' THEN 'https://shop.example/p/' || CAST(k AS VARCHAR) END AS page_url,
  CASE WHEN eid % 3 = 0 THEN 'https://ref.example/' END AS referrer_url,
  'ua_' || CAST(uid % 3 AS VARCHAR) AS user_agent,
  'BR' AS ip_country,
  CASE uid % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
  'os_' || CAST(uid % 3 AS VARCHAR) AS os,
  'browser_' || CAST(uid % 2 AS VARCHAR) AS browser
FROM ev_copies
""",
    "ev_copies",
)

cte(
    "products",
    """
SELECT
  'prod_' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS product_id,
  'cat_' || lower(p_type) AS category_id,
  p_type AS category_name,
  p_brand AS brand,
  p_retailprice AS price,
  'USD' AS currency,
  p_partkey % 10 <> 9 AS is_active,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at,
  TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM part
""",
)

cte("stg_products", "SELECT * FROM products WHERE is_active = true", "products")

# The newest copy of an event is the greatest row by (processing time, event time).
cte(
    "deduped",
    """
SELECT unnest(newest) FROM (
  SELECT arg_max(b, {'processed': b.processing_timestamp, 'happened': b.event_timestamp}) AS newest
  FROM bronze b WHERE b.event_id IS NOT NULL GROUP BY b.event_id
)
""",
    "bronze",
)

cte(
    "silver",
    f"""
FROM deduped SEMI JOIN (SELECT unnest({FUNNEL_EVENT_TYPES}) AS event_type) USING (event_type)
WHERE (user_id IS NULL OR event_timestamp IS NULL) = false
""",
    "deduped",
)

# What the catalogue fills where the event says nothing.
FILLED = ("category_id", "category_name", "brand", "price", "currency")
cte(
    "enriched",
    f"""
SELECT s.* REPLACE ({", ".join(f"ifnull(s.{c}, k.{c}) AS {c}" for c in FILLED)})
FROM silver s LEFT JOIN stg_products k USING (product_id)
""",
    "silver",
    "stg_products",
)

# A cart is an add-to-cart row with a product and a category. Its partners are the purchases of the same user and
# product less than a day later, the cart's own instant included.
cte(
    "cart_matches",
    """
SELECT x.event_id, x.event_timestamp::DATE AS analysis_date, x.category_id, x.category_name, x.user_id, x.product_id,
       x.event_timestamp AS cart_at, x.price,
       count(b.event_id) AS n_purchases, min(b.event_timestamp) AS first_purchase_at
FROM (FROM enriched WHERE event_type = 'add_to_cart' AND category_id IS NOT NULL AND product_id IS NOT NULL) x
LEFT JOIN (FROM enriched WHERE event_type = 'purchase') b
  ON (b.user_id, b.product_id) = (x.user_id, x.product_id)
 AND epoch_us(b.event_timestamp) - epoch_us(x.event_timestamp) BETWEEN 0 AND 86399999999
GROUP BY ALL
""",
    "enriched",
)

# Everything the cart marts need in one aggregate over the matched carts. ``pairs`` counts every partner, ``bought``
# counts a cart with partners once.
cte(
    "cart_days",
    """
SELECT analysis_date, category_id, category_name, count(*) AS carts, sum(amount) AS carted,
       CAST(sum(n_purchases) AS BIGINT) AS pairs,
       sum(amount * CAST(n_purchases AS INTEGER)) FILTER (WHERE n_purchases > 0) AS pairs_amount,
       count(*) FILTER (WHERE n_purchases > 0) AS bought,
       sum(amount) FILTER (WHERE n_purchases > 0) AS bought_amount
FROM (SELECT *, CAST(price AS DECIMAL(28,9)) AS amount FROM cart_matches)
GROUP BY ALL
""",
    "cart_matches",
)


def _abandonment_sql(completed: str, amount: str) -> str:
    """Rows of the abandonment mart; purchases count for the whole category id, whatever its names."""
    return f"""
SELECT analysis_date, category_id, category_name, carts AS cart_additions, done AS completed_purchases,
       carts - done AS abandoned_carts,
       round(CAST(carted AS DOUBLE), 6) AS cart_value,
       round(CAST(realized AS DOUBLE), 6) AS revenue_realized,
       round(CAST(carted - realized AS DOUBLE), 6) AS revenue_lost,
       (carts - done) / carts * 100 AS abandonment_rate,
       TIMESTAMP '{AS_OF}' AS updated_at
FROM (SELECT *, CAST(sum({completed}) OVER one_id AS BIGINT) AS done, coalesce(sum({amount}) OVER one_id, 0) AS realized
      FROM cart_days WINDOW one_id AS (PARTITION BY analysis_date, category_id))
"""


cte(
    "fct_daily_revenue",
    f"""
SELECT CAST(event_timestamp AS DATE) AS revenue_date,
       round(CAST(sum(CAST(price AS DECIMAL(28,9))) AS DOUBLE), 6) AS gross_revenue,
       count(DISTINCT event_id) AS orders_count,
       count(DISTINCT user_id) AS unique_buyers,
       round(CAST(sum(CAST(price AS DECIMAL(28,9))) AS DOUBLE) / nullif(count(DISTINCT event_id), 0), 6) AS avg_order_value,
       TIMESTAMP '{AS_OF}' AS updated_at
FROM enriched
WHERE event_type = 'purchase' AND price IS NOT NULL AND price > 0
GROUP BY 1
""",
    "enriched",
)

# Silver holds the four funnel steps only, so every enriched row is one of them.
cte(
    "daily_event_counts",
    """
SELECT event_timestamp::DATE AS funnel_date, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users
FROM enriched GROUP BY ALL
""",
    "enriched",
)


def _funnel_pivot_sql() -> str:
    """Events and users of each step, counted on the enriched rows themselves."""
    steps = {
        "page_view": ("page_views", "unique_page_viewers"),
        "view_item": ("view_items", "unique_viewers"),
        "add_to_cart": ("add_to_carts", "unique_cart_adders"),
        "purchase": ("purchases", "unique_buyers"),
    }
    counted = [
        f"{what} FILTER (WHERE event_type = '{step}') AS {name}"
        for step, names in steps.items()
        for what, name in zip(("count(*)", "count(DISTINCT user_id)"), names, strict=True)
    ]
    return "SELECT event_timestamp::DATE AS funnel_date, " + ", ".join(counted) + " FROM enriched GROUP BY ALL"


def _rate(reached: str, base: str, name: str) -> str:
    return f"CASE WHEN {base} > 0 THEN {reached} / {base} * 100 END AS {name}"


cte("funnel_pivot", _funnel_pivot_sql(), "enriched")

cte(
    "fct_conversion_funnel",
    "SELECT * EXCLUDE (unique_page_viewers, unique_viewers, unique_cart_adders, unique_buyers), "
    + ", ".join(
        [
            _rate("unique_viewers", "unique_page_viewers", "conversion_rate_view"),
            _rate("unique_cart_adders", "unique_viewers", "conversion_rate_cart"),
            _rate("unique_buyers", "unique_cart_adders", "conversion_rate_purchase"),
            _rate("unique_buyers", "unique_page_viewers", "overall_conversion_rate"),
        ]
    )
    + f", TIMESTAMP '{AS_OF}' AS updated_at FROM funnel_pivot",
    "funnel_pivot",
)

cte("fct_cart_abandonment", _abandonment_sql("pairs", "pairs_amount"), "cart_days")


# --------------------------------------------------------------------------------------------------------
# Ingest: envelope built from bronze, then parsed back
# --------------------------------------------------------------------------------------------------------
def _json_field(name: str, expr: str, quoted: bool = True) -> str:
    text = f"CAST(to_json({expr}) AS VARCHAR)" if quoted else expr
    return f"""CASE WHEN {expr} IS NOT NULL THEN '"{name}":' || {text} END"""


_ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

def _envelope_sql() -> str:
    from .schemas import BRONZE_COLUMNS

    iso = f"strftime(event_timestamp, {_ISO})"
    made = {
        "event_id": "CASE WHEN num % 50 <> 0 THEN event_id END",
        "user_id": "CASE WHEN num % 139 = 0 THEN '' ELSE user_id END",
        "event_type": "CASE WHEN num % 131 <> 0 THEN event_type END",
        "event_timestamp": f"CASE WHEN num % 107 = 0 THEN {iso} || '-03:00' WHEN num % 109 = 0 THEN 'no time' "
        f"WHEN num % 137 <> 0 THEN {iso} END",
    }
    number = "CAST(price AS VARCHAR)"
    price = f"""CASE WHEN price IS NOT NULL THEN '"price":' || CASE WHEN num % 113 = 0 THEN '"' || {number} || '"'
      WHEN num % 127 = 0 THEN '"free"' ELSE {number} END END"""
    fields = [
        price if c == "price" else _json_field(c, made.get(c, c)) for c in BRONZE_COLUMNS if c != "processing_timestamp"
    ]
    return (
        "SELECT user_id AS kafka_key, CASE WHEN num % 101 = 0 THEN '{bad' ELSE '{' || concat_ws(',', "
        + ",\n    ".join(fields)
        + """) || '}' || CASE WHEN num % 103 = 0 THEN ' trailing' ELSE '' END END AS raw_value,
  'ecommerce-events' AS topic,
  CAST(CAST(regexp_extract(session_id, '^sess_(\\d+)_', 1) AS BIGINT) % 3 AS INTEGER) AS "partition",
  num AS "offset",
  processing_timestamp AS broker_ts
FROM (SELECT *, CAST(regexp_extract(event_id, '(\\d+)$', 1) AS BIGINT) AS num FROM bronze)"""
    )


cte("envelope", _envelope_sql(), "bronze")


def _parsed_sql() -> str:
    """What a consumer makes of a record, in steps: the JSON object, its texts, typed values, the reason to refuse it."""
    from .schemas import BRONZE_COLUMNS

    texts = [c for c in BRONZE_COLUMNS if c != "processing_timestamp"]
    as_text = ", ".join(f"json_extract_string(obj, '$.{c}') AS {c}_text" for c in texts)
    typed = {
        "event_id": "CASE WHEN obj IS NULL THEN NULL WHEN list_contains(json_keys(obj), 'event_id') THEN event_id_text "
        "ELSE concat_ws('-', 'kafka', topic, \"partition\", \"offset\") END",
        # a time with an offset is moved to UTC by hand
        "event_timestamp": """CASE WHEN regexp_matches(event_timestamp_text, '[+-][0-9]{2}:[0-9]{2}$')
      THEN TRY_CAST(left(event_timestamp_text, length(event_timestamp_text) - 6) AS TIMESTAMP)
           - to_minutes(CAST(left(right(event_timestamp_text, 6), 1) || '1' AS BIGINT)
                        * (60 * CAST(left(right(event_timestamp_text, 5), 2) AS BIGINT)
                           + CAST(right(event_timestamp_text, 2) AS BIGINT)))
      ELSE TRY_CAST(event_timestamp_text AS TIMESTAMP) END""",
        "processing_timestamp": "broker_ts",
        "price": "TRY_CAST(price_text AS DOUBLE)",
    }
    columns = ",\n  ".join(f"{typed.get(c, f'{c}_text')} AS {c}" for c in BRONZE_COLUMNS)
    required = "\n    ".join(
        f"WHEN NOT list_contains(json_keys(obj), '{c}') THEN 'missing_{c}'"
        for c in ("user_id", "event_type", "event_timestamp")
    )
    return f"""
SELECT topic, "partition", "offset", kafka_key, raw_value, {", ".join(BRONZE_COLUMNS)},
  CASE WHEN obj IS NULL THEN 'malformed_json'
    {required}
    WHEN event_type IS NULL OR event_type NOT IN ('page_view', 'view_item', 'add_to_cart', 'purchase')
      THEN 'invalid_event_type'
    WHEN user_id IS NULL OR user_id = '' THEN 'empty_user_id'
    WHEN event_timestamp_text IS NOT NULL AND event_timestamp IS NULL THEN 'invalid_event_timestamp'
    WHEN price_text IS NOT NULL AND price IS NULL THEN 'invalid_price' END AS reject_reason
FROM (SELECT topic, "partition", "offset", kafka_key, raw_value, obj, event_timestamp_text, price_text,
  {columns}
FROM (SELECT *, {as_text}
FROM (SELECT *, CASE WHEN json_valid(raw_value) THEN CASE WHEN json_type(raw_value) = 'OBJECT'
                THEN CAST(raw_value AS JSON) END END AS obj FROM envelope)))"""


cte("parsed", _parsed_sql(), "envelope")


# --------------------------------------------------------------------------------------------------------
# Query texts
# --------------------------------------------------------------------------------------------------------
BRONZE_COLS = (
    "event_id, user_id, session_id, event_type, event_timestamp, processing_timestamp, product_id, category_id, "
    "category_name, brand, price, currency, page_url, referrer_url, user_agent, ip_country, device_type, os, browser"
)


def queries() -> dict[str, str]:
    q: dict[str, str] = dict(quality_queries())
    q["bronze_scan"] = build("SELECT * FROM bronze", "bronze")
    q["dedup_latest"] = build("SELECT * FROM deduped", "deduped")
    q["silver_validated"] = build("SELECT * FROM silver", "silver")
    q["stg_products"] = build("SELECT * FROM stg_products", "stg_products")
    q["enriched_clickstream"] = build("SELECT * FROM enriched", "enriched")
    q["cart_to_purchase"] = build("SELECT * FROM cart_matches", "cart_matches")
    q["cart_agg"] = build(
        """SELECT analysis_date, category_id, category_name, carts AS cart_additions,
                  round(CAST(carted AS DOUBLE), 6) AS cart_value FROM cart_days""",
        "cart_days",
    )
    q["purchase_agg"] = build(
        """SELECT analysis_date, category_id, CAST(sum(pairs) AS BIGINT) AS completed_purchases,
                  round(CAST(sum(pairs_amount) AS DOUBLE), 6) AS purchased_value
           FROM cart_days GROUP BY ALL HAVING sum(pairs) > 0""",
        "cart_days",
    )
    q["fct_daily_revenue"] = build("SELECT * FROM fct_daily_revenue", "fct_daily_revenue")
    q["daily_event_counts"] = build("SELECT * FROM daily_event_counts", "daily_event_counts")
    q["funnel_pivot"] = build("SELECT * FROM funnel_pivot", "funnel_pivot")
    q["fct_conversion_funnel"] = build("SELECT * FROM fct_conversion_funnel", "fct_conversion_funnel")
    q["fct_cart_abandonment"] = build("SELECT * FROM fct_cart_abandonment", "fct_cart_abandonment")
    q["cart_abandonment_first"] = build(_abandonment_sql("bought", "bought_amount"), "cart_days")
    q["lookback_window"] = build(
        f"""SELECT * FROM bronze
            WHERE event_timestamp >= TIMESTAMP '{RUN_STARTED_AT}' - INTERVAL 90 MINUTE
              AND event_timestamp <  TIMESTAMP '{RUN_STARTED_AT}' - INTERVAL 30 MINUTE""",
        "bronze",
    )
    q["lookback_macro"] = build(
        f"""SELECT * FROM bronze
            WHERE event_timestamp >= TIMESTAMP '{RUN_STARTED_AT}' - INTERVAL 2 HOUR
              AND event_timestamp <  TIMESTAMP '{RUN_STARTED_AT}' - INTERVAL 30 MINUTE""",
        "bronze",
    )
    q["typed_projection"] = build(f"SELECT {BRONZE_COLS} FROM bronze", "bronze")
    q["audit_columns"] = build(
        f"""SELECT *, TIMESTAMP '{AS_OF}' AS dbt_processed_at, '{INVOCATION_ID}' AS dbt_invocation_id
            FROM silver""",
        "silver",
    )
    q["minute_revenue"] = build(
        """
SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end,
       round(CAST(sum(CAST(price AS DECIMAL(28,9))) AS DOUBLE), 6) AS revenue,
       count(*) AS orders_count
FROM enriched WHERE event_type = 'purchase' AND price IS NOT NULL AND price > 0
GROUP BY 1, 2
""",
        "enriched",
    )
    q["parse_events"] = build("SELECT * FROM parsed", "parsed")
    q["validate_events"] = build(f"SELECT {BRONZE_COLS} FROM parsed WHERE reject_reason IS NULL", "parsed")
    q["dead_letter"] = build(
        """SELECT topic, "partition", "offset", kafka_key, raw_value, reject_reason
           FROM parsed WHERE reject_reason IS NOT NULL""",
        "parsed",
    )
    q["required_fields"] = build(
        """SELECT topic, "partition", "offset", reject_reason FROM parsed WHERE reject_reason LIKE 'missing_%'""",
        "parsed",
    )
    q["synth_event_id"] = build(
        """SELECT topic, "partition", "offset", event_id FROM parsed
           WHERE reject_reason IS NULL OR reject_reason <> 'malformed_json'""",
        "parsed",
    )
    q["ingest_stats"] = build(
        """SELECT rows_ok, rows_failed, rows_ok / greatest(rows_ok + rows_failed, 1) AS success_rate
           FROM (SELECT count(*) FILTER (WHERE reject_reason IS NULL) AS rows_ok,
                        count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rows_failed FROM parsed)""",
        "parsed",
    )
    q["sink_row_prep"] = build(
        "SELECT * REPLACE (strftime(event_timestamp, "
        + _ISO
        + ") AS event_timestamp, strftime(processing_timestamp, "
        + _ISO
        + ") AS processing_timestamp, CAST(price AS DOUBLE) AS price) FROM bronze",
        "bronze",
    )
    from .schemas import BRONZE_COLUMNS

    fields = []
    for c in BRONZE_COLUMNS:
        if c in ("event_timestamp", "processing_timestamp"):
            fields.append(_json_field(c, f"strftime({c}, {_ISO})"))
        elif c == "price":
            fields.append(_json_field(c, "CAST(price AS VARCHAR)", quoted=False))
        else:
            fields.append(_json_field(c, c))
    q["publish_envelope"] = build(
        "SELECT user_id AS key, '{' || concat_ws(',', "
        + ", ".join(fields)
        + ") || '}' AS value, 'ecommerce-events' AS topic FROM bronze",
        "bronze",
    )
    return q


# --------------------------------------------------------------------------------------------------------
# Quality checks: SQL of each check kind (same definitions as quality.checks, written as SQL)
# --------------------------------------------------------------------------------------------------------
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def check_sql(chk, table_cte: str, table_name: str, as_of: str | None = None) -> str:
    col = chk.column
    k = chk.kind
    if k == "missing_count":
        m = f"(SELECT count(*) FILTER (WHERE {col} IS NULL) FROM {table_cte})"
    elif k == "invalid_count":
        vals = ", ".join(_q(v) for v in chk.values)
        m = f"(SELECT count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})) FROM {table_cte})"
    elif k == "between":
        conds = []
        if chk.low is not None:
            conds.append(f"{col} >= {chk.low}")
        if chk.high is not None:
            conds.append(f"{col} <= {chk.high}")
        ok = " AND ".join(conds) or "true"
        m = f"(SELECT count(*) FILTER (WHERE {col} IS NOT NULL AND NOT ({ok})) FROM {table_cte})"
    elif k == "min_at_least":
        m = f"(SELECT min({col}) FROM {table_cte})"
    elif k == "max_at_most":
        m = f"(SELECT max({col}) FROM {table_cte})"
    elif k == "row_predicate":
        m = f"(SELECT count(*) FILTER (WHERE NOT coalesce({chk.expr}, true)) FROM {table_cte})"
    elif k == "failed_rows":
        m = f"(SELECT count(*) FILTER (WHERE coalesce({chk.expr}, false)) FROM {table_cte})"
    elif k == "row_count_above":
        m = f"(SELECT count(*) FROM {table_cte})"
    elif k == "freshness":
        m = f"(SELECT date_sub('second', max({col}), TIMESTAMP '{as_of}') FROM {table_cte})"
    elif k == "duplicate_count":
        m = (
            f"(SELECT count(*) FROM (SELECT {col} FROM {table_cte} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1))"
        )
    else:
        raise ValueError(k)
    thr = float(chk.threshold)
    if k == "min_at_least":
        outcome = f"CASE WHEN coalesce(m < {thr}, false) THEN 'fail' ELSE 'pass' END"
    elif k == "row_count_above":
        outcome = f"CASE WHEN coalesce(m <= {thr}, false) THEN 'fail' ELSE 'pass' END"
    elif k == "freshness":
        warn = f"m >= {float(chk.warn_threshold)}" if chk.warn_threshold is not None else "false"
        outcome = f"CASE WHEN m IS NULL OR m >= {thr} THEN 'fail' WHEN {warn} THEN 'warn' ELSE 'pass' END"
    else:
        outcome = f"CASE WHEN coalesce(m > {thr}, false) THEN 'fail' ELSE 'pass' END"
    column = _q(col) if col else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT {_q(chk.suite)} AS suite, {_q(table_name)} AS table_name, {_q(chk.check_name)} AS check_name, "
        f"{column} AS column_name, m AS measured, {thr} AS threshold, {outcome} AS outcome "
        f"FROM (SELECT CAST({m} AS DOUBLE) AS m)"
    )


def checks_sql(checks, table_cte: str, table_name: str, as_of: str | None = None) -> str:
    return "\nUNION ALL\n".join(check_sql(c, table_cte, table_name, as_of) for c in checks)


def ewma_sql(table_cte: str, date_col: str, value_col: str, series_cols=(), seasonality: int = 7,
             sensitivity: float = 3.0, history_days: int = 21, min_history: int = 7) -> str:
    alpha = 2.0 / (seasonality + 1)
    keys = list(series_cols)
    ksel = "".join(f"{k}, " for k in keys)
    kjoin = "".join(f"a.{k} = b.{k} AND " for k in keys)
    hjoin = "".join(f"p.{k} = c.{k} AND " for k in keys)
    ccols = "".join(f"c.{k}, " for k in keys)
    return f"""
SELECT {ksel}metric_date, value, round(residual, 6) AS residual, round(mu, 6) AS mu, round(sigma, 6) AS sigma,
       n_history,
       CASE WHEN residual IS NULL THEN 'no_residual'
            WHEN n_history < {min_history} THEN 'insufficient'
            WHEN abs(residual - mu) > {sensitivity} * sigma THEN 'anomalous'
            ELSE 'normal' END AS status
FROM (
  SELECT *, sqrt(greatest(swr2 / nullif(sw, 0) - mu * mu, 0)) AS sigma
  FROM (
    SELECT {ccols}c.metric_date, c.value, c.residual,
           count(p.residual) AS n_history,
           coalesce(sum({alpha} * pow({1 - alpha}, date_diff('day', p.metric_date, c.metric_date) - 1)), 0) AS sw,
           coalesce(sum({alpha} * pow({1 - alpha}, date_diff('day', p.metric_date, c.metric_date) - 1) * p.residual), 0)
             AS swr,
           coalesce(sum({alpha} * pow({1 - alpha}, date_diff('day', p.metric_date, c.metric_date) - 1)
                        * p.residual * p.residual), 0) AS swr2,
           coalesce(sum({alpha} * pow({1 - alpha}, date_diff('day', p.metric_date, c.metric_date) - 1) * p.residual), 0)
             / nullif(coalesce(sum({alpha} * pow({1 - alpha}, date_diff('day', p.metric_date, c.metric_date) - 1)), 0), 0)
             AS mu
    FROM r_{table_cte} c LEFT JOIN r_{table_cte} p
      ON {hjoin}p.residual IS NOT NULL
     AND p.metric_date >= c.metric_date - {history_days} AND p.metric_date <= c.metric_date - 1
    GROUP BY ALL
  )
)"""


def ewma_residuals_cte(table_cte: str, date_col: str, value_col: str, series_cols=(), seasonality: int = 7) -> str:
    keys = list(series_cols)
    ksel = "".join(f"{k}, " for k in keys)
    kjoin = "".join(f"a.{k} = b.{k} AND " for k in keys)
    akeys = "".join(f"a.{k}, " for k in keys)
    return f"""
SELECT {akeys}a.metric_date, a.value, a.value - b.value AS residual
FROM (SELECT {ksel}CAST({date_col} AS DATE) AS metric_date, CAST({value_col} AS DOUBLE) AS value FROM {table_cte}) a
LEFT JOIN (SELECT {ksel}CAST({date_col} AS DATE) AS metric_date, CAST({value_col} AS DOUBLE) AS value FROM {table_cte}) b
  ON {kjoin}b.metric_date = a.metric_date - {seasonality}"""


cte(
    "bronze_typed",
    f"SELECT {BRONZE_COLS} FROM bronze",
    "bronze",
)
cte("r_fct_daily_revenue", ewma_residuals_cte("fct_daily_revenue", "revenue_date", "gross_revenue"), "fct_daily_revenue")
cte(
    "r_fct_conversion_funnel",
    ewma_residuals_cte("fct_conversion_funnel", "funnel_date", "overall_conversion_rate"),
    "fct_conversion_funnel",
)
cte(
    "r_fct_cart_abandonment",
    ewma_residuals_cte("fct_cart_abandonment", "analysis_date", "abandonment_rate", ("category_id", "category_name")),
    "fct_cart_abandonment",
)
cte(
    "lookback_slice",
    f"""SELECT * FROM bronze
        WHERE event_timestamp >= TIMESTAMP '{RUN_STARTED_AT}' - INTERVAL 90 MINUTE
          AND event_timestamp <  TIMESTAMP '{RUN_STARTED_AT}' - INTERVAL 30 MINUTE""",
    "bronze",
)
cte(
    "sessionized",
    """
SELECT * EXCLUDE (st), st = 1 AS is_session_start,
       CAST(sum(st) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS session_seq
FROM (
  SELECT *, CASE WHEN lag(event_timestamp) OVER w IS NULL
                   OR date_sub('microsecond', lag(event_timestamp) OVER w, event_timestamp) >= 1800000000
                 THEN 1 ELSE 0 END AS st
  FROM silver WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)
)""",
    "silver",
)
cte(
    "sessions",
    """
SELECT user_id, session_seq, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
       count(*) AS events,
       coalesce(max(CASE event_type WHEN 'page_view' THEN 1 WHEN 'view_item' THEN 2 WHEN 'add_to_cart' THEN 3
                                    WHEN 'purchase' THEN 4 END), 0) AS funnel_depth
FROM sessionized GROUP BY user_id, session_seq""",
    "sessionized",
)
cte(
    "recent_bronze",
    f"SELECT * FROM bronze WHERE event_timestamp >= TIMESTAMP '{HEALTH_AS_OF}' - INTERVAL 1 HOUR",
    "bronze",
)
cte(
    "bronze_health",
    """
SELECT count(*) AS events_last_hour, count(DISTINCT user_id) AS unique_users,
       avg(date_sub('second', event_timestamp, processing_timestamp)) AS avg_latency_seconds,
       max(event_timestamp) AS latest_event, min(event_timestamp) AS earliest_event
FROM recent_bronze""",
    "recent_bronze",
)
cte(
    "bronze_event_counts",
    "SELECT event_type, count(*) AS count FROM recent_bronze GROUP BY event_type",
    "recent_bronze",
)


def quality_queries() -> dict[str, str]:
    from .quality import checks as C
    from .quality import contracts as K
    from .schemas import CURRENCIES, DEVICE_TYPES, FUNNEL_EVENT_TYPES
    from .plans import quality_keys as QK

    q: dict[str, str] = {}
    q["dq_missing"] = build(checks_sql(QK.MISSING, "bronze_typed", "bronze"), "bronze_typed")
    q["dq_duplicates"] = build(checks_sql(QK.DUPLICATES, "bronze_typed", "bronze"), "bronze_typed")
    q["dq_accepted_values"] = build(checks_sql(QK.ACCEPTED, "bronze_typed", "bronze"), "bronze_typed")
    q["dq_between"] = build(checks_sql(QK.BETWEEN, "bronze_typed", "bronze"), "bronze_typed")
    q["dq_min"] = build(checks_sql(QK.MINS, "bronze_typed", "bronze"), "bronze_typed")
    q["dq_row_predicate"] = build(
        checks_sql(QK.ROW_PREDICATES, "fct_conversion_funnel", "fct_conversion_funnel"), "fct_conversion_funnel"
    )
    q["dq_cross_column"] = build(
        checks_sql(QK.CROSS_FUNNEL, "fct_conversion_funnel", "fct_conversion_funnel")
        + "\nUNION ALL\n"
        + checks_sql(QK.CROSS_ABANDON, "fct_cart_abandonment", "fct_cart_abandonment"),
        "fct_conversion_funnel",
        "fct_cart_abandonment",
    )
    q["dq_freshness"] = build(checks_sql(QK.FRESHNESS, "silver", "stg_clickstream", AS_OF), "silver")
    q["dq_row_count"] = build(
        checks_sql(QK.ROW_COUNT, "silver", "stg_clickstream")
        + "\nUNION ALL\n"
        + checks_sql(QK.ROW_COUNT, "lookback_slice", "lookback_slice"),
        "silver",
        "lookback_slice",
    )
    q["dq_valid_event_type"] = build(
        "SELECT event_id, event_type FROM bronze WHERE event_type NOT IN ('page_view', 'view_item', 'add_to_cart', "
        "'purchase')",
        "bronze",
    )
    q["dq_positive_price"] = build(
        "SELECT event_id, price FROM bronze WHERE price IS NOT NULL AND price <= 0", "bronze"
    )
    q["dq_failed_rows"] = build(
        "SELECT analysis_date, category_id, category_name, abandonment_rate FROM fct_cart_abandonment "
        "WHERE abandonment_rate > 90",
        "fct_cart_abandonment",
    )
    q["dq_session_consistency"] = build(
        """
SELECT 'session_consistency_literal' AS check_name,
       (SELECT count(*) FROM (SELECT user_id, session_id FROM silver GROUP BY user_id, session_id
                              HAVING count(DISTINCT session_id) > 1)) AS violations
UNION ALL
SELECT 'shared_session', (SELECT count(*) FROM (SELECT session_id FROM silver WHERE session_id IS NOT NULL
                                                 GROUP BY session_id HAVING count(DISTINCT user_id) > 1))
UNION ALL
SELECT 'interleaved', (SELECT count(*) FROM (
    SELECT *, max(last_ts) OVER (PARTITION BY user_id ORDER BY first_ts, session_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
    FROM (SELECT user_id, session_id, min(event_timestamp) AS first_ts, max(event_timestamp) AS last_ts
          FROM silver WHERE session_id IS NOT NULL AND user_id IS NOT NULL GROUP BY user_id, session_id))
  WHERE prev_max > first_ts)""",
        "silver",
    )
    q["dq_ewma_anomaly"] = build(
        ewma_sql("fct_daily_revenue", "revenue_date", "gross_revenue"), "r_fct_daily_revenue"
    )
    q["dq_ewma_anomaly_by_category"] = build(
        ewma_sql("fct_cart_abandonment", "analysis_date", "abandonment_rate", ("category_id", "category_name")),
        "r_fct_cart_abandonment",
    )
    # full scan of every declared contract; a schema check that holds gives three rows of zeros
    parts, needed = [], []
    tables = {
        "stg_clickstream": "silver",
        "stg_products": "stg_products",
        "fct_daily_revenue": "fct_daily_revenue",
        "fct_conversion_funnel": "fct_conversion_funnel",
        "fct_cart_abandonment": "fct_cart_abandonment",
    }
    for tname, cte_name in tables.items():
        needed.append(cte_name)
        plain = [c for c in K.CONTRACTS[tname] if isinstance(c, C.Check)]
        parts.append(checks_sql(plain, cte_name, tname, AS_OF))
        for c in K.CONTRACTS[tname]:
            if isinstance(c, K.SchemaCheck):
                parts += [
                    f"SELECT {_q(c.suite)}, {_q(tname)}, {_q(check)}, NULL, 0.0, 0.0, 'pass'"
                    for check in ("schema(required columns)", "schema(column types)", "schema(forbidden columns)")
                ]
            if isinstance(c, K.AnomalyCheck):
                needed.append(f"r_{cte_name}")
                parts.append(
                    f"SELECT {_q(c.suite)} AS suite, {_q(tname)} AS table_name, {_q(c.check_name)} AS check_name, "
                    f"{_q(c.metric)} AS column_name, CAST(n AS DOUBLE) AS measured, 0.0 AS threshold, "
                    f"CASE WHEN n > 0 THEN 'warn' ELSE 'pass' END AS outcome FROM (SELECT count(*) FILTER "
                    f"(WHERE status = 'anomalous') AS n FROM ("
                    + ewma_sql(cte_name, c.date_col, c.metric, c.series_cols)
                    + "))"
                )
    q["dq_scan"] = build("\nUNION ALL\n".join(parts), *needed)
    # the worst outcome of each suite on silver
    silver_checks = [c for c in K.CONTRACTS["stg_clickstream"] if isinstance(c, C.Check)]
    q["gate_outcome"] = build(
        "SELECT suite, CASE max(CASE outcome WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' "
        "WHEN 1 THEN 'warn' ELSE 'pass' END AS outcome, count(*) + CASE suite WHEN "
        f"{_q(K.R)} THEN 3 ELSE 0 END AS checks FROM (\n"
        + checks_sql(silver_checks, "silver", "stg_clickstream", AS_OF)
        + "\n) GROUP BY suite",
        "silver",
    )
    q["daily_unique_users"] = build(
        "SELECT CAST(event_timestamp AS DATE) AS day, event_type, count(DISTINCT user_id) AS unique_users FROM enriched GROUP BY ALL",
        "enriched",
    )
    # monitoring
    q["bronze_health"] = build("SELECT * FROM bronze_health", "bronze_health")
    q["bronze_health_warnings"] = build(
        f"""
SELECT * FROM (
  SELECT 'low_volume' AS warning, CAST(events_last_hour AS DOUBLE) AS measured, 100.0 AS threshold
  FROM bronze_health WHERE events_last_hour < 100
  UNION ALL
  SELECT 'high_latency', coalesce(avg_latency_seconds, 0.0), 60.0
  FROM bronze_health WHERE coalesce(avg_latency_seconds, 0.0) > 60
  UNION ALL
  SELECT 'stream_silent', CAST(date_sub('second', latest_event, TIMESTAMP '{HEALTH_AS_OF}') AS DOUBLE), 300.0
  FROM bronze_health WHERE coalesce(date_sub('second', latest_event, TIMESTAMP '{HEALTH_AS_OF}') > 300, false)
)""",
        "bronze_health",
    )
    q["bronze_event_counts"] = build("SELECT * FROM bronze_event_counts", "bronze_event_counts")
    q["funnel_ratios"] = build(
        """
SELECT CASE WHEN pv = 0 THEN 0.0 ELSE round_even(vi / pv * 100, 2) END AS page_view_to_view_item,
       CASE WHEN vi = 0 THEN 0.0 ELSE round_even(atc / vi * 100, 2) END AS view_item_to_add_to_cart,
       CASE WHEN atc = 0 THEN 0.0 ELSE round_even(pur / atc * 100, 2) END AS add_to_cart_to_purchase
FROM (SELECT coalesce(sum(CASE WHEN event_type = 'page_view' THEN count END), 0) AS pv,
             coalesce(sum(CASE WHEN event_type = 'view_item' THEN count END), 0) AS vi,
             coalesce(sum(CASE WHEN event_type = 'add_to_cart' THEN count END), 0) AS atc,
             coalesce(sum(CASE WHEN event_type = 'purchase' THEN count END), 0) AS pur
      FROM bronze_event_counts)""",
        "bronze_event_counts",
    )
    q["bronze_freshness"] = build(
        f"""
SELECT last_event, date_sub('minute', last_event, TIMESTAMP '{AS_OF}') AS minutes_stale, events_last_hour,
       coalesce(date_sub('minute', last_event, TIMESTAMP '{AS_OF}') > 30, true) AS is_stale
FROM (SELECT max(event_timestamp) AS last_event,
             count(*) FILTER (WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR) AS events_last_hour
      FROM bronze)""",
        "bronze",
    )
    q["new_data_since"] = build(
        f"""
SELECT last_event, coalesce(last_event > TIMESTAMP '{QK.SENSOR_CURSOR}', false) AS should_run,
       CASE WHEN last_event IS NOT NULL THEN 'bronze_fresh_' || strftime(last_event, {_ISO}) END AS run_key,
       coalesce(last_event < TIMESTAMP '{HEALTH_AS_OF}' - INTERVAL 10 MINUTE, false) AS stale_warning
FROM (SELECT max(event_timestamp) AS last_event FROM bronze
      WHERE event_timestamp >= TIMESTAMP '{HEALTH_AS_OF}' - INTERVAL 2 HOUR)""",
        "bronze",
    )
    # sessions
    q["sessionize"] = build(
        "SELECT user_id, event_id, event_timestamp, is_session_start, session_seq FROM sessionized", "sessionized"
    )
    q["session_progress"] = build(
        """SELECT user_id, event_id, session_seq,
                  max(CASE event_type WHEN 'page_view' THEN 1 WHEN 'view_item' THEN 2 WHEN 'add_to_cart' THEN 3
                                      WHEN 'purchase' THEN 4 ELSE 0 END)
                    OVER (PARTITION BY user_id, session_seq ORDER BY event_timestamp, event_id
                          ROWS UNBOUNDED PRECEDING) AS current_step
           FROM sessionized""",
        "sessionized",
    )
    q["session_funnel_depth"] = build(
        """SELECT user_id, session_seq, session_start, events, funnel_depth, funnel_depth >= 2 AS reached_view_item,
                  funnel_depth >= 3 AS reached_cart, funnel_depth >= 4 AS reached_purchase FROM sessions""",
        "sessions",
    )
    return q
