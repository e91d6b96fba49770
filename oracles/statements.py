"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracles import prelude as p

_COMPLETE_P_COLUMNS = "order_id, customer_id, product_id, order_date, quantity, order_amount, order_status, channel, payment_method"

ORACLES: dict[str, str] = {}


def _add(head: str, **statements: str) -> None:
    for name, body in statements.items():
        ORACLES[name] = f"{head}\n{body}"


# --- quality ----------------------------------------------------------------------
def _rule(dataset: str, table: str, rule: str, predicate: str, action: str = "keep") -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{action}' AS action, count(*) AS rows_checked, "
        f"count(*) FILTER (NOT coalesce({predicate}, FALSE)) AS violations FROM {table}"
    )


_add(
    p.RAW_DIRTY,
    dq_expectation_report=" UNION ALL ".join(
        [
            _rule("products", "bronze_products", "valid_product_id", "product_id IS NOT NULL"),
            _rule("products", "bronze_products", "valid_price", "price >= 0"),
            _rule("customers", "bronze_customers", "valid_customer_id", "customer_id IS NOT NULL", "drop"),
            _rule("customers", "bronze_customers", "valid_email", "email IS NOT NULL AND email LIKE '%@%'"),
            _rule("loyalty", "dirty_loyalty", "valid_customer_id", "customer_id IS NOT NULL"),
            _rule("loyalty", "dirty_loyalty", "valid_tier",
                  "lower(trim(loyalty_tier)) IN ('bronze', 'silver', 'gold', 'platinum')"),
            _rule("orders", "dirty_orders", "valid_order_id", "order_id IS NOT NULL", "drop"),
            _rule("orders", "dirty_orders", "valid_amount", "order_amount >= 0"),
            _rule("orders", "dirty_orders", "valid_quantity", "quantity > 0"),
            _rule("pos", "bronze_pos", "valid_transaction_id", "transaction_id IS NOT NULL", "drop"),
            _rule("pos", "bronze_pos", "valid_amount", "transaction_amount >= 0"),
            _rule("pos", "bronze_pos", "valid_quantity", "quantity > 0"),
        ]
    ),
    dq_expect_or_drop=f"SELECT {_COMPLETE_P_COLUMNS} FROM dirty_orders WHERE order_id IS NOT NULL",
    dq_quarantine=f"""
SELECT {_COMPLETE_P_COLUMNS},
  concat_ws(',', CASE WHEN order_id IS NULL THEN 'valid_order_id' END,
                 CASE WHEN NOT order_amount >= 0 THEN 'valid_amount' END,
                 CASE WHEN NOT quantity > 0 THEN 'valid_quantity' END) AS violations
FROM dirty_orders WHERE order_id IS NULL OR NOT order_amount >= 0 OR NOT quantity > 0""",
)

_add(
    p.SILVERS_N,
    dq_validity_summary="""
SELECT count(*) AS total_rows, count(*) FILTER (is_customer_record_valid) AS valid_rows,
  count(*) FILTER (NOT is_customer_record_valid) AS invalid_rows,
  count(*) FILTER (is_customer_record_valid) * 100.0 / count(*) AS valid_pct FROM silver_customers""",
    dq_numeric_stats="""
SELECT 'points_balance' AS column_name, CAST(min(points_balance) AS DOUBLE) AS min_value,
  CAST(sum(points_balance) AS DOUBLE) / count(*) AS avg_value, CAST(max(points_balance) AS DOUBLE) AS max_value
FROM silver_loyalty
UNION ALL
SELECT 'price', min(price), CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*), max(price) FROM silver_products""",
    table_row_counts=" UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {table}"
        for label, table in [
            ("bronze_products", "bronze_products"),
            ("bronze_customers", "bronze_customers"),
            ("bronze_loyalty_profiles", "bronze_loyalty"),
            ("bronze_ecommerce_orders", "bronze_orders"),
            ("bronze_pos_transactions", "bronze_pos"),
            ("silver_transactions_unified", "transactions"),
            ("silver_customers", "silver_customers"),
            ("silver_products", "silver_products"),
        ]
    ),
    mask_pii="""
SELECT customer_id, '***' || right(email, 4) AS email, '***' || right(phone, 4) AS phone FROM silver_customers""",
    silver_customers="SELECT * FROM silver_customers",
    silver_loyalty="SELECT * FROM silver_loyalty",
    silver_products="SELECT * FROM silver_products",
    silver_transactions_unified="SELECT * FROM transactions",
    silver_customer_identity="SELECT * FROM identity",
    customer_segment="SELECT customer_id, loyalty_tier, customer_tenure_days, customer_segment FROM identity",
    customer_tenure="SELECT customer_id, registration_date, customer_tenure_days FROM silver_customers",
    transactions_profile="""
SELECT *, completed_rows * 100.0 / total_rows AS completed_pct, identified_rows * 100.0 / total_rows AS identified_pct
FROM (SELECT count(*) AS total_rows, count(*) FILTER (channel = 'Ecommerce') AS ecommerce_rows,
  count(*) FILTER (channel = 'In-Store') AS instore_rows, count(*) FILTER (is_completed_transaction) AS completed_rows,
  count(*) FILTER (is_customer_identified) AS identified_rows FROM transactions)""",
    segment_distribution="SELECT customer_segment, count(*) AS row_count FROM identity GROUP BY 1",
    tier_distribution="SELECT loyalty_tier, count(*) AS row_count FROM silver_loyalty GROUP BY 1",
    category_distribution="SELECT category, count(*) AS row_count FROM silver_products GROUP BY 1",
    top_members_by_points="""
SELECT customer_id, full_name, loyalty_tier, points_balance, customer_segment FROM identity
WHERE customer_segment IN ('VIP', 'High-Value') ORDER BY points_balance DESC, customer_id LIMIT 10""",
    longest_tenure="""
SELECT customer_id, full_name, customer_tenure_days FROM silver_customers
ORDER BY customer_tenure_days DESC, customer_id LIMIT 10""",
    latest_transactions="""
SELECT transaction_id, customer_id, channel, transaction_timestamp, gross_amount FROM transactions
ORDER BY transaction_timestamp DESC, transaction_id LIMIT 10""",
    loyalty_penetration="""
SELECT customers, members, customers - members AS non_members, members * 100.0 / customers AS member_pct,
  (customers - members) * 100.0 / customers AS non_member_pct
FROM (SELECT count(*) AS customers, count(*) FILTER (is_loyalty_member) AS members FROM identity)""",
)

_add(
    p.RAW,
    dedup_latest_customers="""
SELECT * FROM bronze_customers
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY registration_date DESC, phone) = 1""",
    dedup_latest_loyalty="""
SELECT * FROM bronze_loyalty
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY member_since DESC, loyalty_tier) = 1""",
    dedup_first_products="""
SELECT * FROM bronze_products
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_name, category, brand, price) = 1""",
    completed_revenue="""
SELECT 'ecommerce' AS source, CAST(coalesce(sum(CAST(order_amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS completed_revenue
FROM bronze_orders WHERE order_status = 'Completed'
UNION ALL
SELECT 'pos', CAST(coalesce(sum(CAST(transaction_amount AS DECIMAL(18,2))), 0) AS DOUBLE)
FROM bronze_pos WHERE transaction_status = 'Completed'""",
)

_add(
    p.SILVERS_P,
    silver_products_p="SELECT * FROM p_products",
    silver_customers_p="SELECT * FROM p_customers",
    silver_loyalty_p="SELECT * FROM p_loyalty",
    silver_orders_p="SELECT * FROM p_orders",
    silver_pos_p="SELECT * FROM p_pos",
)

# --- customer 360, features, scores, variant P -----------------------------------------
_ACTIVITY = "customer_id, transactions_last_30d, revenue_last_30d, transactions_last_90d, revenue_last_90d"

_add(
    p.P,
    ecom_metrics="SELECT customer_id, ecom_orders, CAST(ecom_revenue AS DOUBLE) AS ecom_revenue FROM p_ecom",
    pos_metrics="SELECT customer_id, pos_orders, CAST(pos_revenue AS DOUBLE) AS pos_revenue FROM p_store",
    refund_counts="SELECT * FROM p_refunds",
    purchase_dates="SELECT * EXCLUDE (last_counted_date) FROM p_dates",
    favorite_category_p="SELECT * FROM p_category",
    preferred_channel_p="SELECT * FROM p_channel",
    gold_customer_360_p="SELECT * FROM p_360",
    recent_activity_p=f"SELECT {_ACTIVITY} FROM p_features",
    churn_features_p="SELECT * EXCLUDE (base_label) FROM p_features",
    churn_label_noisy="SELECT customer_id, base_label, churn_label_proxy FROM p_features",
    churn_scores_p="SELECT * FROM p_scores",
)
_add(p.P_ACTIONS, next_best_actions_p="SELECT * FROM p_actions")

# --- customer 360, features, scores, variant N --------------------------------------------
_add(
    p.N,
    dq_null_counts="""
SELECT count(*) AS total_rows, count(*) FILTER (customer_id IS NULL) AS null_customer_id,
  count(*) FILTER (total_revenue IS NULL) AS null_total_revenue, count(*) FILTER (email IS NULL) AS null_email,
  count(*) FILTER (loyalty_tier IS NULL) AS null_loyalty_tier FROM n_360""",
    favorite_category_n="""
SELECT customer_id, favorite_category FROM n_metrics LEFT JOIN n_category USING (customer_id)""",
    preferred_channel_n="SELECT * FROM n_channel",
    transaction_metrics_n=f"""
SELECT * EXCLUDE (last_counted_date),
  CAST(coalesce(date_diff('day', last_counted_date, {p.AS_OF}), 9999) AS INTEGER) AS days_since_last_purchase FROM n_metrics""",
    gold_customer_360_n="SELECT * FROM n_360",
    recent_activity_n=f"SELECT {_ACTIVITY} FROM n_activity",
    churn_features_n="SELECT * FROM n_features",
    churn_label_n="SELECT customer_id, churn_label_proxy FROM n_features",
    churn_scorecard_n="""
SELECT customer_id, recency_score, frequency_score, refund_score, loyalty_score, churn_score FROM n_card""",
    churn_scores_n="SELECT * FROM n_scores",
    label_distribution="""
SELECT churn_label_proxy, count(*) AS customer_count,
  CAST(sum(days_since_last_purchase) AS DOUBLE) / count(*) AS avg_days_since_last_purchase,
  CAST(sum(transactions_last_90d) AS DOUBLE) / count(*) AS avg_transactions_90d FROM n_features GROUP BY 1""",
    risk_band_distribution="""
SELECT churn_risk_band, count(*) AS customer_count, CAST(sum(churn_score) AS DOUBLE) / count(*) AS avg_churn_score,
  min(churn_score) AS min_score, max(churn_score) AS max_score FROM n_scores GROUP BY 1""",
    top_risk_customers="SELECT * FROM n_scores ORDER BY churn_score DESC, customer_id LIMIT 10",
)

_add(
    p.N_ACTIONS,
    next_best_actions_n="SELECT * FROM n_actions",
    campaign_volume="""
SELECT churn_risk_band, loyalty_tier, count(*) AS customer_count,
  CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_revenue FROM n_actions GROUP BY 1, 2""",
    high_risk_sample="""
SELECT customer_id, full_name, churn_risk_band, customer_summary, personalized_offer, recommended_message
FROM n_actions WHERE churn_risk_band = 'High' ORDER BY customer_id LIMIT 5""",
)

# --- KPIs -------------------------------------------------------------------------------------
_add(
    p.N_KPIS,
    executive_kpis="SELECT * FROM kpis",
    kpi_channel_summary="""
SELECT k.*, total_revenue / total_transactions AS weighted_order_value,
  CAST(refunds AS DOUBLE) / total_transactions AS weighted_refund_rate
FROM (SELECT channel, count(DISTINCT metric_date) AS date_count,
        CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
        CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
        round(avg(avg_order_value), 6) AS avg_order_value, round(avg(refund_return_rate), 6) AS avg_refund_rate
      FROM kpis GROUP BY 1) k
JOIN (SELECT channel, count(*) FILTER (is_refund_or_return) AS refunds FROM transactions GROUP BY 1) USING (channel)""",
    kpi_overall="""
SELECT CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_business_revenue,
  CAST(sum(total_transactions) AS BIGINT) AS total_business_transactions,
  count(DISTINCT metric_date) AS days_of_data, CAST(sum(unique_customers) AS BIGINT) AS customer_days,
  (SELECT count(DISTINCT customer_id) FROM transactions) AS distinct_customers FROM kpis""",
    kpi_distinct_customers="""
SELECT channel, CAST(date_trunc('month', transaction_timestamp) AS DATE) AS month, count(DISTINCT customer_id) AS distinct_customers
FROM transactions GROUP BY 1, 2""",
    latest_kpis="SELECT * FROM kpis ORDER BY metric_date DESC, channel LIMIT 10",
)

# --- change feed and sync ------------------------------------------------------------------------
EARLIER = "DATE '2001-07-02'"


def _two_days(head: str, table: str) -> str:
    """CTEs old_rows and new_rows: one gold table on two days."""
    then = head.replace(p.AS_OF, EARLIER).replace(p.UNTIL, EARLIER)
    return f"WITH old_rows AS ({then} SELECT * FROM {table}), new_rows AS ({head} SELECT * FROM {table})"


def _changes() -> str:
    return """
paired AS (
  SELECT o, n, o.customer_id IS NOT NULL AS had, n.customer_id IS NOT NULL AS has
  FROM old_rows o FULL JOIN new_rows n ON o.customer_id = n.customer_id
),
feed AS (
  SELECT unnest(n), 'insert' AS _change_type FROM paired WHERE NOT had
  UNION ALL SELECT unnest(o), 'delete' FROM paired WHERE NOT has
  UNION ALL SELECT unnest(o), 'update_preimage' FROM paired WHERE had AND has AND o IS DISTINCT FROM n
  UNION ALL SELECT unnest(n), 'update_postimage' FROM paired WHERE had AND has AND o IS DISTINCT FROM n
)"""


_SCORES_TWICE = _two_days(p.N, "n_scores")
ORACLES["cdc_snapshot_diff"] = f"{_SCORES_TWICE}, {_changes()} SELECT * FROM feed"
ORACLES["sync_upsert_merge"] = f"{p.N} SELECT * FROM n_scores"


def _check(label: str, head: str, table: str, in_step: bool = False) -> str:
    rows = f"WITH new_rows AS ({head} SELECT * FROM {table})"
    rows += ", old_rows AS (SELECT * FROM new_rows)" if in_step else (
        f", old_rows AS ({head.replace(p.AS_OF, EARLIER).replace(p.UNTIL, EARLIER)} SELECT * FROM {table})"
    )
    return f"""
SELECT *, missing_rows + extra_rows + different_rows = 0 AS in_sync FROM ({rows}
SELECT '{label}' AS table_name, count(s.customer_id) AS source_rows, count(t.customer_id) AS target_rows,
  count(*) FILTER (t.customer_id IS NULL) AS missing_rows, count(*) FILTER (s.customer_id IS NULL) AS extra_rows,
  count(*) FILTER (s.customer_id IS NOT NULL AND t.customer_id IS NOT NULL AND s IS DISTINCT FROM t) AS different_rows
FROM new_rows s FULL JOIN old_rows t ON s.customer_id = t.customer_id)"""


ORACLES["sync_verify"] = " UNION ALL ".join(
    [
        _check("gold_customer_churn_scores", p.N, "n_scores"),
        _check("gold_next_best_actions", p.N_ACTIONS, "n_actions"),
        _check("gold_customer_360", p.N, "n_360"),
        _check("gold_customer_churn_scores after sync", p.N, "n_scores", in_step=True),
    ]
)

_ML_SCORES = """
SELECT customer_id, CAST(round_even(probability * 100, 0) AS INTEGER) AS churn_score, churn_risk_band,
  top_reason_1, top_reason_2,
  CASE churn_risk_band WHEN 'High' THEN 'Send re-engagement campaign with 15% discount'
    WHEN 'Medium' THEN 'Send personalized product recommendations'
    ELSE 'Continue loyalty rewards program' END AS recommended_action
FROM (
  SELECT *, CASE WHEN probability >= 0.6 THEN 'High' WHEN probability >= 0.3 THEN 'Medium' ELSE 'Low' END AS churn_risk_band
  FROM (
    SELECT *, CAST(greatest(days_since_last_purchase, 0) AS DOUBLE) / (CAST(greatest(days_since_last_purchase, 0) AS DOUBLE) + 90.0) AS probability,
      CASE WHEN days_since_last_purchase > 180 THEN 'Extended purchase gap (180+ days)'
           WHEN days_since_last_purchase > 90 THEN 'No recent engagement (90+ days)'
           ELSE 'Declining engagement' END AS top_reason_1,
      CASE WHEN transactions_last_90d < 3 THEN 'Low purchase frequency'
           WHEN revenue_last_90d < 200 THEN 'Low revenue decline'
           WHEN refund_return_rate > 0.1 THEN 'High refund rate'
           ELSE 'Limited engagement' END AS top_reason_2
    FROM n_features))"""

_add(
    p.N,
    deploy_scores=_ML_SCORES,
    deploy_reasons=f"SELECT customer_id, top_reason_1, top_reason_2 FROM ({_ML_SCORES})",
    deploy_summary=f"""
SELECT churn_risk_band, count(*) AS customer_count, CAST(sum(churn_score) AS DOUBLE) / count(*) AS avg_churn_score,
  min(churn_score) AS min_score, max(churn_score) AS max_score FROM ({_ML_SCORES}) GROUP BY 1""",
    current_scores=f"""
SELECT m.*, 'model' AS score_source FROM ({_ML_SCORES}) m
JOIN n_features f ON m.customer_id = f.customer_id AND f.days_since_last_purchase < 9999
UNION ALL
SELECT s.*, 'rule' FROM n_scores s
JOIN n_features f ON s.customer_id = f.customer_id AND f.days_since_last_purchase >= 9999""",
)

# --- stored tables ---------------------------------------------------------------------------------
_C360_TYPES = (
    "customer_id bigint, full_name string, email string, city string, state string, loyalty_tier string, "
    "points_balance bigint, is_loyalty_member boolean, total_transactions bigint, completed_transactions bigint, "
    "total_revenue double, ecommerce_revenue double, instore_revenue double, avg_order_value double, "
    "first_purchase_date date, last_purchase_date date, days_since_last_purchase int, favorite_category string, "
    "preferred_channel string, refund_return_count bigint, customer_lifetime_value_proxy double"
)
ORACLES["describe_table"] = f"{p.N} " + " UNION ALL ".join(
    f"SELECT 'gold_customer_360' AS table_name, CAST({position} AS INTEGER) AS position, '{column.split()[0]}' AS column_name, "
    f"'{column.split()[1]}' AS data_type, true AS is_nullable, count(*) - count({column.split()[0]}) AS null_values FROM n_360"
    for position, column in enumerate(_C360_TYPES.split(", "))
)
# a block of the daily partials holds 32 768 customer ids, the first of them 1
_BLOCK = "CASE WHEN customer_id > 0 THEN 1 + (customer_id - 1) // 32768 ELSE customer_id // 32768 END"
_CUSTOMERS = "(SELECT count(*) FROM n_360)"
_PUBLISHED = (
    ("customer_profile", "One wide row per customer behind the gold tables", 37, _CUSTOMERS),
    ("gold_customer_360", "Customer profile, loyalty, channel revenue and recency", 21, _CUSTOMERS),
    ("gold_customer_churn_features", "Model-ready churn features", 14, _CUSTOMERS),
    ("gold_customer_churn_scores", "Rule-based churn scores, bands and reasons", 6, _CUSTOMERS),
    ("gold_daily_partials", "Mergeable daily figures per channel, with the buyers", 8,
     f"(SELECT count(*) FROM (SELECT DISTINCT CAST(transaction_timestamp AS DATE), channel, {_BLOCK} FROM transactions))"),
    ("gold_executive_kpis", "Daily KPIs per channel", 7,
     "(SELECT count(*) FROM (SELECT DISTINCT CAST(transaction_timestamp AS DATE), channel FROM transactions))"),
    ("gold_next_best_actions", "Offer, action and message per customer", 12, _CUSTOMERS),
)
ORACLES["table_manifest"] = f"{p.N} " + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{comment}' AS comment, CAST({columns} AS INTEGER) AS column_count, {count} AS row_count"
    for name, comment, columns, count in _PUBLISHED
)
ORACLES["write_roundtrip_overwrite"] = f"{p.N_KPIS} SELECT * FROM kpis WHERE channel = 'Ecommerce'"
ORACLES["write_schema_replace"] = (
    f"{p.N} SELECT customer_id, CAST(churn_score AS DOUBLE) AS churn_score, churn_risk_band FROM n_scores"
)
_add(
    p.with_(p.BRONZE, p.SILVER_N, p.GOLD_N, p.ACTIONS_N, p.KPIS),
    discover_tables="""
SELECT 'gold_customer_360' AS table_name, count(*) AS row_count FROM n_360
UNION ALL SELECT 'gold_customer_churn_features', count(*) FROM n_features
UNION ALL SELECT 'gold_customer_churn_scores', count(*) FROM n_scores
UNION ALL SELECT 'gold_next_best_actions', count(*) FROM n_actions""",
)

# --- serving ------------------------------------------------------------------------------------------
_add(
    p.N_ACTIONS,
    serve_risk_distribution="""
SELECT total_customers, churn_risk_band, count(customer_id) AS customer_count,
  count(customer_id) * 100.0 / total_customers AS pct
FROM (VALUES ('High'), ('Medium'), ('Low')) b(churn_risk_band)
LEFT JOIN n_scores USING (churn_risk_band), (SELECT count(*) AS total_customers FROM n_scores) GROUP BY 1, 2""",
    serve_loyalty_distribution="""
SELECT coalesce(loyalty_tier, 'Non-Member') AS tier, count(*) AS customer_count,
  count(*) * 100.0 / (SELECT count(*) FROM n_360) AS pct FROM n_360 GROUP BY 1""",
    serve_top_high_risk="""
SELECT customer_id, churn_score, top_reason_1, top_reason_2, recommended_action FROM n_scores
WHERE churn_risk_band = 'High' ORDER BY churn_score DESC, customer_id LIMIT 10""",
    serve_customer_search="""
SELECT s.customer_id, full_name, churn_risk_band, churn_score, top_reason_1
FROM n_scores s LEFT JOIN n_360 z ON s.customer_id = z.customer_id
WHERE CAST(s.customer_id AS VARCHAR) ILIKE '%12%' ORDER BY s.customer_id LIMIT 20""",
    serve_customer_detail="""
SELECT s.customer_id, s.churn_score, s.churn_risk_band, top_reason_1, top_reason_2, z.full_name, z.loyalty_tier,
  z.total_revenue, total_transactions, days_since_last_purchase, z.preferred_channel, customer_summary
FROM n_scores s LEFT JOIN n_360 z ON s.customer_id = z.customer_id
LEFT JOIN n_actions a ON s.customer_id = a.customer_id WHERE s.customer_id = 42""",
    serve_nba_sample="SELECT customer_id, customer_summary FROM n_actions ORDER BY customer_id LIMIT 5",
)

# --- streams: the same rows as in batch -------------------------------------------------------------------
ORACLES["ingest_stream_products"] = ORACLES["silver_products_p"]
ORACLES["ingest_stream_transactions"] = ORACLES["silver_transactions_unified"]
ORACLES["streamed_gold_360_p"] = ORACLES["gold_customer_360_p"]
ORACLES["incremental_gold_360_p"] = ORACLES["gold_customer_360_p"]
ORACLES["stream_silver_orders"] = ORACLES["dq_expect_or_drop"]
_add(
    p.RAW_DIRTY,
)


ORACLES["stream_quality_report"] = ORACLES["dq_expectation_report"]
ORACLES["stream_unique_orders"] = f"{p.with_(p.BRONZE)} SELECT * FROM bronze_orders"
ORACLES["stream_landing_report"] = f"""{p.with_(p.BRONZE)}
SELECT count(customer_id) AS rows_with_text_id, count(*) AS rows,
  count(*) FILTER (CAST(split_part(order_id, '-', 1) AS BIGINT) % 29 = 0) AS rescued
FROM bronze_orders"""


# --- generated rows ------------------------------------------------------------------------------------------
def _u(key: str, stream: str) -> str:
    return f"(CAST('0x' || substr(md5({key} || '|{stream}|42'), 1, 12) AS BIGINT) / 281474976710656.0e0)"


def _whole(draw: str, low: int, high: int) -> str:
    return f"CAST(floor({draw} * {high - low + 1}) + {low} AS INTEGER)"


def _real(draw: str, low: float, high: float) -> str:
    return f"({draw} * {high - low!r}e0 + {low!r}e0)"


def _pick(draw: str, values) -> str:
    names = ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v!r}e0" for v in values)
    return f"([{names}])[{_whole(draw, 1, len(values))}]"


def _weighted(draw: str, weighted) -> str:
    total, running, steps = float(sum(w for _, w in weighted)), 0.0, []
    for value, weight in weighted:
        running += weight
        shown = f"'{value}'" if isinstance(value, str) else str(value)
        steps.append(f"WHEN {draw} < {running / total!r}e0 THEN {shown}")
    steps[-1] = "ELSE " + steps[-1].split(" THEN ")[1]
    return "CASE " + " ".join(steps) + " END"


def _code(prefix: str, digits: int, number: str) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest({digits}, length({text})) AS INTEGER), '0')"


def _generated() -> None:
    from keepwell.sources import generate as g  # vocabularies and weights only

    k = "p_partkey"
    price = "CASE category " + " ".join(
        f"WHEN '{name}' THEN {_real(_u(k, 'price'), *span)}" for name, span in g.PRICE_RANGES.items()
    ) + f" ELSE {_real(_u(k, 'price'), *g.OTHER_PRICES)} END"
    ORACLES["gen_products"] = f"""
SELECT {_code('SKU', 5, k)} AS product_id,
  {_pick(_u(k, 'name'), g.BRANDS)} || ' ' || category || ' Item ' || {k} AS product_name, category,
  {_pick(_u(k, 'brand'), g.BRANDS)} AS brand, round({price}, 2) AS price
FROM (SELECT {k}, {_pick(_u(k, 'category'), g.CATEGORIES)} AS category FROM part)"""

    k = "c_custkey"
    start = f"({p.AS_OF} - {g.HISTORY_DAYS})"
    ORACLES["gen_customers"] = f"""
SELECT {_code('CUST', 6, k)} AS customer_id, first_name, last_name,
  lower(first_name) || '.' || lower(last_name) || {_whole(_u(k, 'mail'), 1, 999)} || '@'
    || {_pick(_u(k, 'domain'), g.MAIL_DOMAINS)} AS email,
  '+1-' || {_whole(_u(k, 'area'), 200, 999)} || '-' || {_whole(_u(k, 'exchange'), 100, 999)} || '-'
    || {_whole(_u(k, 'line'), 1000, 9999)} AS phone,
  {start} + {_whole(_u(k, 'registered'), 0, g.HISTORY_DAYS)} AS registration_date,
  {_pick(_u(k, 'city'), [c for c, _ in g.CITY_STATES])} AS city,
  {_pick(_u(k, 'city'), [s for _, s in g.CITY_STATES])} AS state, 'USA' AS country
FROM (SELECT {k}, {_pick(_u(k, 'first'), g.FIRST_NAMES)} AS first_name,
        {_pick(_u(k, 'last'), g.LAST_NAMES)} AS last_name FROM customer)"""

    age = f"({k} / CAST((SELECT count(*) FROM customer) AS DOUBLE) * {float(g.HISTORY_DAYS)!r}e0)"
    tier = "CASE " + " ".join(
        f"WHEN {age} > {days} THEN {_weighted(_u(k, 'tier'), weights)}" for days, weights in g.TIER_WEIGHTS
    ) + " END"
    points = "CASE loyalty_tier " + " ".join(
        f"WHEN '{name}' THEN {_whole(_u(k, 'points'), *span)}" for name, span in g.POINT_RANGES.items()
    ) + " END"
    ORACLES["gen_loyalty"] = f"""
SELECT {_code('CUST', 6, k)} AS customer_id, loyalty_tier, CAST({points} AS BIGINT) AS points_balance,
  {start} + CAST(floor({age}) AS INTEGER) + {_whole(_u(k, 'joined'), 30, 180)} AS member_since, 'Active' AS status
FROM (SELECT {k}, {tier} AS loyalty_tier FROM customer
      QUALIFY row_number() OVER (ORDER BY md5({k} || '|loyalty|42')) - 1 < round(count(*) OVER () * 0.7e0))"""

    k, customers, parts = "o_orderkey", "(SELECT count(*) FROM customer)", "(SELECT count(*) FROM part)"

    def spread(draw: str, count: str, first: str = "1") -> str:
        return f"(CAST(floor({draw} * CAST({count} AS DOUBLE)) AS BIGINT) + {first})"

    def amount(stream: str, unit, share: float, discounts) -> str:
        base = f"({_real(_u(k, stream + '-unit'), *unit)} * quantity)"
        cut = f"CAST({_pick(_u(k, stream + '-cut'), discounts)} AS DOUBLE)"
        return f"round(CASE WHEN {_u(k, stream + '-discounted')} < {share} THEN {base} * (1 - {cut}) ELSE {base} END, 2)"

    busy = f"round({customers} * 0.2e0)"
    draw = _u(k, "order-customer")
    ORACLES["gen_orders"] = f"""
SELECT {_code('EC', 8, k)} AS order_id,
  {_code('CUST', 6, f"CASE WHEN {_u(k, 'order-busy')} < 0.8 THEN {spread(draw, busy)} ELSE CAST({spread(draw, f'({customers} - {busy})', f'{busy} + 1')} AS BIGINT) END")} AS customer_id,
  {_code('SKU', 5, spread(_u(k, 'order-product'), parts))} AS product_id,
  CAST({p.AS_OF} - CAST(least(floor(-ln(1 - {_u(k, 'order-recency')}) * {g.MEAN_RECENCY_DAYS}), {g.SALES_DAYS}) AS INTEGER) AS TIMESTAMP) AS order_date,
  CAST(quantity AS BIGINT) AS quantity,
  {amount('order', g.ORDER_UNIT_PRICE, g.ORDER_DISCOUNT_SHARE, g.ORDER_DISCOUNTS)} AS order_amount,
  {_weighted(_u(k, 'order-status'), g.ORDER_STATUSES)} AS order_status, 'Ecommerce' AS channel,
  {_pick(_u(k, 'order-payment'), g.ORDER_PAYMENTS)} AS payment_method
FROM (SELECT {k}, {_weighted(_u(k, 'order-quantity'), g.ORDER_QUANTITIES)} AS quantity FROM orders)"""

    stores = ", ".join(
        f"{_pick(_u(k, 'pos-store'), [row[i] for row in g.STORES])} AS {name}"
        for i, name in enumerate(("store_id", "store_name", "store_city", "store_state"))
    )
    ORACLES["gen_pos"] = f"""
SELECT {_code('POS', 8, k)} AS transaction_id,
  CASE WHEN {_u(k, 'pos-known')} >= 0.4 THEN {_code('CUST', 6, spread(_u(k, 'pos-customer'), customers))} END AS customer_id,
  {_code('SKU', 5, spread(_u(k, 'pos-product'), parts))} AS product_id,
  CAST({p.AS_OF} - {_whole(_u(k, 'pos-day'), 0, g.SALES_DAYS)} AS TIMESTAMP) AS transaction_date,
  CAST(quantity AS BIGINT) AS quantity,
  {amount('pos', g.POS_UNIT_PRICE, g.POS_DISCOUNT_SHARE, g.POS_DISCOUNTS)} AS transaction_amount,
  {_weighted(_u(k, 'pos-status'), g.POS_STATUSES)} AS transaction_status, 'In-Store' AS channel, {stores},
  {_pick(_u(k, 'pos-payment'), g.POS_PAYMENTS)} AS payment_method
FROM (SELECT {k}, {_weighted(_u(k, 'pos-quantity'), g.POS_QUANTITIES)} AS quantity FROM orders)"""


_generated()

# --- features and models ------------------------------------------------------------------------------------------
_NUMERIC = [
    "points_balance", "customer_tenure_days", "days_since_last_purchase", "transactions_last_30d",
    "transactions_last_90d", "revenue_last_30d", "revenue_last_90d", "avg_order_value", "refund_return_rate",
]
_WITH_LABEL = [*_NUMERIC, "churn_label_proxy"]


def _long(columns: list[str], measures: dict[str, str], table: str, extra: str = "") -> str:
    """One row per column from a single aggregate row; {c} stands for the column."""
    names = {(m, c): f"m{j}_{i}" for i, c in enumerate(columns) for j, m in enumerate(measures)}
    computed = ", ".join(f"{measures[m].replace('{c}', c)} AS {n}" for (m, c), n in names.items())
    rows = ", ".join(
        "{'feature': '" + c + "', " + ", ".join(f"'{m}': {names[m, c]}" for m in measures) + "}" for c in columns
    )
    group = f" GROUP BY {extra}" if extra else ""
    head = f"{extra}, " if extra else ""
    return f"SELECT {head}unnest([{rows}], recursive := true) FROM (SELECT {head}{computed} FROM {table}{group})"


_ROUND = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_pairs = [(a, b) for i, a in enumerate(_WITH_LABEL) for b in _WITH_LABEL[i + 1 :]]
_SPLIT = """
split_rows AS (
  SELECT *, CASE WHEN place < whole * 0.7e0 THEN 'train' WHEN place < whole * 0.85e0 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY churn_label_proxy ORDER BY md5(customer_id || '|split|42')) - 1 AS place,
          count(*) OVER (PARTITION BY churn_label_proxy) AS whole FROM n_features)
)"""
_train = "(SELECT * FROM split_rows WHERE split = 'train')"


def _levels(column: str, names: list[str]) -> str:
    return ", ".join(f"CAST({column} = '{n}' AS INTEGER) AS \"{column}_{n}\"" for n in names)


_add(
    p.N,
    profile_features=_long(
        _WITH_LABEL,
        {
            "row_count": "count(*)",
            "missing": "count(*) - count({c})",
            "mean": "round(avg({c}), 6)",
            "stddev": "round(stddev_samp({c}), 6)",
            "min": "CAST(min({c}) AS DOUBLE)",
            "max": "CAST(max({c}) AS DOUBLE)",
            **{n: f"round(quantile_cont(CAST({{c}} AS DOUBLE), {q}), 6)" for n, q in _ROUND.items()},
        },
        "n_features",
    ),
    feature_correlations=(
        "SELECT unnest(["
        + ", ".join(f"{{'feature_a': '{a}', 'feature_b': '{b}', 'correlation': c{i}}}" for i, (a, b) in enumerate(_pairs))
        + "], recursive := true) FROM (SELECT "
        + ", ".join(f"round(corr({a}, {b}), 6) AS c{i}" for i, (a, b) in enumerate(_pairs))
        + " FROM n_features)"
    ),
    feature_quantiles_by_label=_long(
        ["days_since_last_purchase", "transactions_last_90d", "revenue_last_90d", "refund_return_rate"],
        {
            n: f"round(quantile_cont(CAST({{c}} AS DOUBLE), {q}), 6)"
            for n, q in {"min": 0, **_ROUND, "max": 1}.items()
        },
        "n_features",
        "churn_label_proxy",
    ),
    ml_prepared="""
SELECT * REPLACE (coalesce(loyalty_tier, 'Unknown') AS loyalty_tier, coalesce(preferred_channel, 'Unknown') AS preferred_channel,
  coalesce(favorite_category, 'Unknown') AS favorite_category) FROM n_features""",
    one_hot_features=f"""
SELECT customer_id, {_levels('loyalty_tier', ['Gold', 'Platinum', 'Silver', 'Unknown'])},
  {_levels('preferred_channel', ['In-Store', 'Unknown'])},
  {_levels('favorite_category', ['Large', 'Medium', 'Promo', 'Small', 'Standard', 'Unknown'])}
FROM (SELECT customer_id, coalesce(loyalty_tier, 'Unknown') AS loyalty_tier,
  coalesce(preferred_channel, 'Unknown') AS preferred_channel, coalesce(favorite_category, 'Unknown') AS favorite_category
  FROM n_features)""",
)
_add(
    p.with_(p.BRONZE, p.SILVER_N, p.GOLD_N, _SPLIT),
    stratified_split="SELECT customer_id, churn_label_proxy, split FROM split_rows",
    imputed_features="SELECT customer_id, split, "
    + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {_train})) AS {c}"
        for c in _NUMERIC
    )
    + " FROM split_rows",
    scaled_features="SELECT customer_id, split, "
    + ", ".join(f"round(({c} - mean_{c}) / dev_{c}, 6) AS {c}" for c in _NUMERIC)
    + " FROM split_rows, (SELECT "
    + ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS dev_{c}" for c in _NUMERIC)
    + f" FROM {_train})",
)

_PREDICTIONS = """
predictions AS (
  SELECT f.customer_id, churn_label_proxy, churn_score, churn_risk_band,
    CAST(churn_risk_band = 'High' AS INTEGER) AS rule_prediction,
    CAST(greatest(days_since_last_purchase, 0) AS DOUBLE) / (CAST(greatest(days_since_last_purchase, 0) AS DOUBLE) + 90.0) AS ml_churn_probability,
    CAST(CAST(greatest(days_since_last_purchase, 0) AS DOUBLE) / (CAST(greatest(days_since_last_purchase, 0) AS DOUBLE) + 90.0) >= 0.5 AS INTEGER) AS ml_prediction
  FROM p_features f JOIN p_scores s ON f.customer_id = s.customer_id
)"""


def _counts(prediction: str) -> str:
    said = f"{prediction} = 1"
    return ", ".join(
        f"count(*) FILTER ({label} AND {claim}) AS {name}"
        for name, label, claim in [
            ("tp", "churn_label_proxy = 1", said),
            ("fp", "churn_label_proxy = 0", said),
            ("fn", "churn_label_proxy = 1", f"NOT {said}"),
            ("tn", "churn_label_proxy = 0", f"NOT {said}"),
        ]
    )


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) ELSE 0.0 END"


_RATES = f"""{_share('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_share('tp * 2', 'tp * 2 + fp + fn')} AS f1"""

_add(
    p.P,
    class_balance="""
SELECT churn_label_proxy, n AS customer_count, n * 100.0 / total AS pct,
  CAST(total AS DOUBLE) / (classes * n) AS class_weight, CAST(largest AS DOUBLE) / smallest AS imbalance_ratio
FROM (SELECT churn_label_proxy, count(*) AS n FROM p_features GROUP BY 1),
  (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS classes, max(n) AS largest, min(n) AS smallest
   FROM (SELECT count(*) AS n FROM p_features GROUP BY churn_label_proxy))""",
    class_weights="""
SELECT churn_label_proxy, CAST(total AS DOUBLE) / (2 * n) AS class_weight
FROM (SELECT churn_label_proxy, count(*) AS n FROM p_features GROUP BY 1), (SELECT count(*) AS total FROM p_features)""",
    label_feature_ranking=_long(
        _NUMERIC, {"abs_correlation": "round(abs(corr({c}, churn_label_proxy)), 6)"}, "p_features"
    ),
)
_add(
    p.with_(p.BRONZE, p.SILVER_P, p.GOLD_P, _PREDICTIONS),
    binary_metrics=f"""
SELECT *, {_share('tp', 'tp + fp')} AS precision, {_share('tp', 'tp + fn')} AS recall, {_RATES}
FROM (SELECT {_counts('rule_prediction')} FROM predictions)""",
    roc_auc_rank="""
SELECT positives, negatives,
  round((rank_sum - positives * (positives + 1) / 2.0e0) / (CAST(positives AS DOUBLE) * negatives), 6) AS roc_auc
FROM (SELECT count(*) FILTER (churn_label_proxy = 1) AS positives, count(*) FILTER (churn_label_proxy = 0) AS negatives,
        sum(CAST(mean_rank AS DOUBLE)) FILTER (churn_label_proxy = 1) AS rank_sum
      FROM (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY ml_churn_probability) - 1) / 2.0e0 AS mean_rank
            FROM predictions WINDOW w AS (ORDER BY ml_churn_probability)))""",
    ml_vs_rules=f"""
SELECT customers, agreements, model_high_only, rule_high_only, m.f1 AS model_f1, m.accuracy AS model_accuracy,
  r.f1 AS rule_f1, r.accuracy AS rule_accuracy, {_share('agreements', 'customers')} AS agreement_rate,
  CASE WHEN r.f1 > 0 THEN (m.f1 - r.f1) * 100 / r.f1 ELSE 0.0 END AS f1_gain_pct
FROM (SELECT count(*) AS customers, count(*) FILTER (ml_prediction = rule_prediction) AS agreements,
        count(*) FILTER (ml_prediction = 1 AND rule_prediction = 0) AS model_high_only,
        count(*) FILTER (ml_prediction = 0 AND rule_prediction = 1) AS rule_high_only FROM predictions),
  (SELECT {_RATES} FROM (SELECT {_counts('ml_prediction')} FROM predictions)) m,
  (SELECT {_RATES} FROM (SELECT {_counts('rule_prediction')} FROM predictions)) r""",
    ml_vs_rules_disagreements="""
SELECT customer_id, churn_label_proxy, ml_churn_probability, churn_score, churn_risk_band FROM predictions
WHERE ml_prediction <> rule_prediction ORDER BY ml_churn_probability DESC, customer_id LIMIT 10""",
)
