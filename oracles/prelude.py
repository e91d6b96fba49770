"""CTEs that derive the retail source tables from the supplied star schema."""

AS_OF = "DATE '2001-08-01'"
# The last day of the rows that take part; earlier states replace it.
UNTIL = "DATE '9999-12-31'"

BRONZE = f"""
bronze_products AS (
  SELECT p_partkey AS product_id,
         '  ' || p_name || ' ' AS product_name,
         p_type AS category,
         p_brand AS brand,
         CASE WHEN p_partkey % 97 = 0 THEN 0.0
              WHEN p_partkey % 89 = 0 THEN NULL
              ELSE p_retailprice END AS price
  FROM part
  UNION ALL
  SELECT p_partkey, '  ' || p_name || '  v2', p_type, p_brand,
         CASE WHEN p_partkey % 97 = 0 THEN 0.0
              WHEN p_partkey % 89 = 0 THEN NULL
              ELSE p_retailprice END
  FROM part WHERE p_partkey % 10 = 0
),
customer_base AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
         CASE WHEN c_custkey % 50 = 0 THEN NULL
              WHEN c_custkey % 51 = 0 THEN 'bad-address'
              ELSE '  ' || upper(c_mktsegment) || c_custkey || '@MAIL.COM' END AS email,
         '+1-555-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
         DATE '1998-08-02' + CAST(c_custkey * 7 % 1095 AS INTEGER) AS registration_date,
         n_name AS city, n_name AS state, r_name AS country
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
bronze_customers AS (
  SELECT * FROM (
  SELECT * FROM customer_base
  UNION ALL
  SELECT customer_id, first_name, last_name, email,
         '+1-444-' || lpad(CAST(customer_id AS VARCHAR), 7, '0'),
         registration_date - 100, city, state, country
  FROM customer_base WHERE customer_id % 20 = 0)
  WHERE registration_date <= {UNTIL}
),
bronze_loyalty AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey * 7 % 100 < 60 THEN ' bronze'
              WHEN c_custkey * 7 % 100 < 85 THEN 'SILVER '
              WHEN c_custkey * 7 % 100 < 97 THEN 'Gold'
              ELSE 'platinum' END AS loyalty_tier,
         CAST(floor(c_acctbal * 10) AS BIGINT) AS points_balance,
         DATE '1998-08-02' + CAST(c_custkey * 7 % 1095 AS INTEGER) + 30
           + CAST(c_custkey % 151 AS INTEGER) AS member_since,
         ' active' AS status
  FROM customer WHERE c_custkey % 10 < 7
),
single_lines AS (
  SELECT * FROM lineitem WHERE l_shipdate <= {UNTIL}
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1
),
line_base AS (
  SELECT l.*, o_orderpriority,
         CASE WHEN o_custkey % 25 = 0 THEN NULL ELSE o_custkey END AS buyer
  FROM single_lines l JOIN orders ON l_orderkey = o_orderkey
),
bronze_orders AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id,
         buyer AS customer_id, l_partkey AS product_id,
         l_shipdate AS order_date,
         CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS order_amount,
         CASE WHEN l_returnflag = 'R' THEN 'Returned'
              WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'Cancelled'
              ELSE 'Completed' END AS order_status,
         'Ecommerce' AS channel,
         o_orderpriority AS payment_method
  FROM line_base WHERE l_linestatus = 'O'
),
bronze_pos AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
         CASE WHEN l_suppkey % 5 < 2 THEN NULL ELSE buyer END AS customer_id,
         l_partkey AS product_id,
         l_shipdate AS transaction_date,
         CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS transaction_amount,
         CASE WHEN l_returnflag = 'R' THEN 'Refunded'
              WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'Cancelled'
              ELSE 'Completed' END AS transaction_status,
         'In-Store' AS channel,
         'ST' || lpad(CAST(l_suppkey % 8 + 1 AS VARCHAR), 3, '0') AS store_id,
         'Store ' || (l_suppkey % 8 + 1) AS store_name,
         'City ' || (l_suppkey % 8 + 1) AS store_city,
         'S' || (l_suppkey % 8 + 1) AS store_state,
         o_orderpriority AS payment_method
  FROM line_base WHERE l_linestatus = 'F'
)"""

# Copies with planted faults, for the quality rules.
DIRTY = """
dirty_orders AS (
  SELECT CASE WHEN CAST(split_part(order_id, '-', 1) AS BIGINT) % 101 = 0 THEN NULL ELSE order_id END AS order_id,
         customer_id, product_id, order_date,
         CASE WHEN product_id % 107 = 0 THEN 0 ELSE quantity END AS quantity,
         CASE WHEN product_id % 103 = 0 THEN -order_amount ELSE order_amount END AS order_amount,
         order_status, channel, payment_method
  FROM bronze_orders
),
dirty_loyalty AS (
  SELECT customer_id,
         CASE WHEN customer_id % 61 = 0 THEN 'Diamond' ELSE loyalty_tier END AS loyalty_tier,
         points_balance, member_since, status
  FROM bronze_loyalty
)"""

# The source's own name casing: first letter of each word up, the rest down.
def initcap(expr: str) -> str:
    return (
        f"list_aggregate(list_transform(string_split({expr}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"
    )


SILVER_N = f"""
silver_customers AS (
  SELECT customer_id, concat_ws(' ', first_name, last_name) AS full_name,
         lower(trim(email)) AS email, phone, registration_date, city, state, country,
         CAST(date_diff('day', registration_date, {AS_OF}) AS INTEGER) AS customer_tenure_days,
         (customer_id IS NOT NULL AND email IS NOT NULL AND registration_date IS NOT NULL)
           AS is_customer_record_valid
  FROM bronze_customers
  QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY registration_date DESC, phone) = 1
),
silver_loyalty AS (
  SELECT customer_id, {initcap('trim(loyalty_tier)')} AS loyalty_tier,
         CASE WHEN points_balance < 0 THEN 0 ELSE points_balance END AS points_balance,
         member_since, {initcap('trim(status)')} AS status, TRUE AS is_loyalty_member
  FROM bronze_loyalty
  QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY member_since DESC, loyalty_tier, points_balance, status) = 1
),
silver_products AS (
  SELECT * FROM (
    SELECT product_id, trim(product_name) AS product_name,
           {initcap('trim(category)')} AS category, {initcap('trim(brand)')} AS brand, price
    FROM bronze_products
    QUALIFY row_number() OVER (PARTITION BY product_id
      ORDER BY product_name, category, brand, price) = 1)
  WHERE price > 0
),
transactions AS (
  SELECT *,
         coalesce(transaction_status = 'Completed', FALSE) AS is_completed_transaction,
         coalesce(transaction_status IN ('Refunded', 'Returned', 'Cancelled'), FALSE) AS is_refund_or_return,
         customer_id IS NOT NULL AS is_customer_identified
  FROM (
    SELECT order_id AS transaction_id, customer_id, product_id, order_date AS transaction_timestamp,
           quantity, order_amount AS gross_amount, order_status AS transaction_status, channel,
           payment_method, CAST(NULL AS VARCHAR) AS store_id, CAST(NULL AS VARCHAR) AS store_name,
           CAST(NULL AS VARCHAR) AS store_city, CAST(NULL AS VARCHAR) AS store_state,
           'Postgres Ecommerce' AS source_system
    FROM bronze_orders
    UNION ALL
    SELECT transaction_id, customer_id, product_id, transaction_date, quantity, transaction_amount,
           transaction_status, channel, payment_method, store_id, store_name, store_city, store_state, 'POS'
    FROM bronze_pos)
  WHERE product_id IS NOT NULL AND quantity > 0 AND gross_amount > 0
),
identity AS (
  SELECT *,
    CASE WHEN loyalty_tier = 'Platinum' THEN 'VIP'
         WHEN loyalty_tier = 'Gold' THEN 'High-Value'
         WHEN loyalty_tier = 'Silver' THEN 'Growing'
         WHEN loyalty_tier = 'Bronze' THEN 'Standard'
         WHEN loyalty_tier = 'Non-Member' AND customer_tenure_days > 365 THEN 'At-Risk Non-Member'
         WHEN loyalty_tier = 'Non-Member' AND customer_tenure_days <= 365 THEN 'New Non-Member'
         ELSE 'Unknown' END AS customer_segment
  FROM (
    SELECT c.customer_id, full_name, email, phone, registration_date, city, state, country,
           customer_tenure_days, coalesce(loyalty_tier, 'Non-Member') AS loyalty_tier,
           coalesce(points_balance, 0) AS points_balance, member_since,
           coalesce(status, 'Non-Member') AS loyalty_status,
           coalesce(is_loyalty_member, FALSE) AS is_loyalty_member, is_customer_record_valid
    FROM silver_customers c LEFT JOIN silver_loyalty l ON c.customer_id = l.customer_id)
)"""

GOLD_N = f"""
n_category AS (
  SELECT customer_id, category AS favorite_category FROM (
    SELECT t.customer_id, p.category, count(*) AS n
    FROM transactions t JOIN silver_products p ON t.product_id = p.product_id
    WHERE t.customer_id IS NOT NULL AND p.category IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, category) = 1
),
n_channel AS (
  SELECT customer_id, channel AS preferred_channel FROM (
    SELECT customer_id, channel, count(*) AS n FROM transactions
    WHERE customer_id IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, channel) = 1
),
n_metrics AS (
  SELECT customer_id, count(*) AS total_transactions,
         count(*) FILTER (is_completed_transaction) AS completed_transactions,
         CAST(sum(CAST(gross_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         CAST(sum(CASE WHEN channel = 'Ecommerce' THEN CAST(gross_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS ecommerce_revenue,
         CAST(sum(CASE WHEN channel = 'In-Store' THEN CAST(gross_amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS instore_revenue,
         CAST(sum(CAST(gross_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value,
         CAST(min(transaction_timestamp) AS DATE) AS first_purchase_date,
         CAST(max(transaction_timestamp) AS DATE) AS last_purchase_date,
         max(CAST(transaction_timestamp AS DATE)) FILTER (CAST(transaction_timestamp AS DATE) <= {AS_OF}) AS last_counted_date,
         count(*) FILTER (is_refund_or_return) AS refund_return_count
  FROM transactions WHERE customer_id IS NOT NULL GROUP BY 1
),
n_360 AS (
  SELECT c.customer_id, full_name, email, city, state, loyalty_tier, points_balance, is_loyalty_member,
         coalesce(total_transactions, 0) AS total_transactions,
         coalesce(completed_transactions, 0) AS completed_transactions,
         coalesce(total_revenue, 0.0) AS total_revenue,
         coalesce(ecommerce_revenue, 0.0) AS ecommerce_revenue,
         coalesce(instore_revenue, 0.0) AS instore_revenue,
         coalesce(avg_order_value, 0.0) AS avg_order_value,
         first_purchase_date, last_purchase_date,
         CAST(coalesce(date_diff('day', last_counted_date, {AS_OF}), 9999) AS INTEGER) AS days_since_last_purchase,
         favorite_category, preferred_channel,
         coalesce(refund_return_count, 0) AS refund_return_count,
         coalesce(total_revenue, 0.0) AS customer_lifetime_value_proxy
  FROM silver_customers c
  LEFT JOIN silver_loyalty l ON c.customer_id = l.customer_id
  LEFT JOIN n_metrics m ON c.customer_id = m.customer_id
  LEFT JOIN n_category g ON c.customer_id = g.customer_id
  LEFT JOIN n_channel h ON c.customer_id = h.customer_id
),
n_activity AS (
  SELECT customer_id,
         count(*) FILTER (age BETWEEN 0 AND 30) AS transactions_last_30d,
         CAST(sum(CASE WHEN age BETWEEN 0 AND 30 THEN amt ELSE 0 END) AS DOUBLE) AS revenue_last_30d,
         count(*) FILTER (age BETWEEN 0 AND 90) AS transactions_last_90d,
         CAST(sum(CASE WHEN age BETWEEN 0 AND 90 THEN amt ELSE 0 END) AS DOUBLE) AS revenue_last_90d
  FROM (SELECT customer_id, CAST(gross_amount AS DECIMAL(18,2)) AS amt,
               date_diff('day', CAST(transaction_timestamp AS DATE), {AS_OF}) AS age
        FROM transactions WHERE customer_id IS NOT NULL)
  GROUP BY 1
),
n_features AS (
  SELECT z.customer_id, loyalty_tier, points_balance,
         coalesce(customer_tenure_days, 0) AS customer_tenure_days, days_since_last_purchase,
         coalesce(transactions_last_30d, 0) AS transactions_last_30d,
         coalesce(transactions_last_90d, 0) AS transactions_last_90d,
         coalesce(revenue_last_30d, 0.0) AS revenue_last_30d,
         coalesce(revenue_last_90d, 0.0) AS revenue_last_90d,
         avg_order_value, preferred_channel,
         CASE WHEN total_transactions > 0
              THEN CAST(refund_return_count AS DOUBLE) / CAST(total_transactions AS DOUBLE) ELSE 0.0 END AS refund_return_rate,
         favorite_category,
         CASE WHEN days_since_last_purchase > 90 OR coalesce(transactions_last_90d, 0) = 0 THEN 1 ELSE 0 END AS churn_label_proxy
  FROM n_360 z
  LEFT JOIN silver_customers c ON z.customer_id = c.customer_id
  LEFT JOIN n_activity a ON z.customer_id = a.customer_id
),
n_card AS (
  SELECT *, recency_score + frequency_score + refund_score + loyalty_score AS churn_score
  FROM (
    SELECT *,
      CASE WHEN days_since_last_purchase > 180 THEN 40 WHEN days_since_last_purchase > 90 THEN 25
           WHEN days_since_last_purchase > 60 THEN 15 WHEN days_since_last_purchase > 30 THEN 5 ELSE 0 END AS recency_score,
      CASE WHEN transactions_last_90d = 0 THEN 30 WHEN transactions_last_90d <= 1 THEN 20
           WHEN transactions_last_90d <= 3 THEN 10 ELSE 0 END AS frequency_score,
      CASE WHEN refund_return_rate > 0.3 THEN 20 WHEN refund_return_rate > 0.15 THEN 10 ELSE 0 END AS refund_score,
      CASE WHEN loyalty_tier = 'Bronze' THEN 10 WHEN loyalty_tier = 'Silver' THEN 5 ELSE 0 END AS loyalty_score
    FROM n_features)
),
n_scores AS (
  SELECT customer_id, churn_score, churn_risk_band,
    CASE WHEN recency_score >= 25 THEN 'Long time since last purchase'
         WHEN frequency_score >= 20 THEN 'Low purchase frequency'
         WHEN refund_score >= 10 THEN 'High refund/return rate'
         ELSE 'Low engagement signals' END AS top_reason_1,
    CASE WHEN frequency_score >= 10 AND recency_score < 25 THEN 'Declining transaction frequency'
         WHEN refund_score >= 10 AND recency_score < 25 THEN 'Quality or satisfaction concerns'
         WHEN loyalty_tier = 'Bronze' THEN 'Low loyalty tier'
         ELSE 'Needs re-engagement' END AS top_reason_2,
    CASE churn_risk_band WHEN 'High' THEN 'Immediate intervention: personalized retention offer'
         WHEN 'Medium' THEN 'Proactive outreach: re-engagement campaign'
         ELSE 'Monitor and maintain: loyalty rewards' END AS recommended_action
  FROM (SELECT *, CASE WHEN churn_score >= 60 THEN 'High' WHEN churn_score >= 30 THEN 'Medium' ELSE 'Low' END AS churn_risk_band
        FROM n_card)
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


N = with_(BRONZE, SILVER_N, GOLD_N)

SILVER_P = """
p_products AS (
  SELECT product_id, trim(product_name) AS product_name, INITCAP_CATEGORY AS category,
         trim(brand) AS brand, price
  FROM bronze_products
),
p_customers AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
         lower(trim(email)) AS email, phone, registration_date,
         trim(city) AS city, trim(state) AS state, trim(country) AS country
  FROM bronze_customers WHERE customer_id IS NOT NULL
),
p_loyalty AS (
  SELECT customer_id, loyalty_tier, points_balance, member_since, status FROM bronze_loyalty
),
p_orders AS (SELECT * FROM bronze_orders WHERE order_id IS NOT NULL),
p_pos AS (SELECT * FROM bronze_pos WHERE transaction_id IS NOT NULL),
single_customers_p AS (
  SELECT * FROM p_customers
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY registration_date DESC, phone) = 1
),
single_products_p AS (
  SELECT * FROM p_products
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_name, category, brand, price) = 1
)""".replace("INITCAP_CATEGORY", initcap("category"))

GOLD_P = f"""
p_ecom AS (
  SELECT customer_id, count(*) AS ecom_orders, sum(CAST(order_amount AS DECIMAL(18,2))) AS ecom_revenue
  FROM p_orders WHERE order_status = 'Completed' AND customer_id IS NOT NULL GROUP BY 1
),
p_store AS (
  SELECT customer_id, count(*) AS pos_orders, sum(CAST(transaction_amount AS DECIMAL(18,2))) AS pos_revenue
  FROM p_pos WHERE transaction_status = 'Completed' AND customer_id IS NOT NULL GROUP BY 1
),
p_refunds AS (
  SELECT customer_id, count(*) AS refund_return_count FROM p_orders
  WHERE order_status IN ('Refunded', 'Returned') AND customer_id IS NOT NULL GROUP BY 1
),
p_dates AS (
  SELECT customer_id, min(order_date) AS first_purchase_date, max(order_date) AS last_purchase_date,
         max(order_date) FILTER (CAST(order_date AS DATE) <= {AS_OF}) AS last_counted_date
  FROM p_orders WHERE order_status = 'Completed' AND customer_id IS NOT NULL GROUP BY 1
),
p_category AS (
  SELECT customer_id, category AS favorite_category FROM (
    SELECT o.customer_id, p.category, count(*) AS n
    FROM p_orders o JOIN single_products_p p ON o.product_id = p.product_id
    WHERE order_status = 'Completed' AND customer_id IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, category NULLS FIRST) = 1
),
p_channel AS (
  SELECT customer_id, channel AS preferred_channel FROM (
    SELECT customer_id, channel, count(*) AS n FROM p_orders
    WHERE order_status = 'Completed' AND customer_id IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, channel NULLS FIRST) = 1
),
p_360 AS (
  SELECT c.customer_id, concat_ws(' ', first_name, last_name) AS full_name, email, phone, city, state,
         l.loyalty_tier, coalesce(l.points_balance, 0) AS points_balance,
         l.loyalty_tier IS NOT NULL AS is_loyalty_member,
         coalesce(ecom_orders, 0) + coalesce(pos_orders, 0) AS total_transactions,
         coalesce(ecom_orders, 0) AS completed_transactions,
         CAST(coalesce(ecom_revenue, 0) + coalesce(pos_revenue, 0) AS DOUBLE) AS total_revenue,
         CAST(coalesce(ecom_revenue, 0) AS DOUBLE) AS ecommerce_revenue,
         CAST(coalesce(pos_revenue, 0) AS DOUBLE) AS instore_revenue,
         CASE WHEN coalesce(ecom_orders, 0) + coalesce(pos_orders, 0) > 0
              THEN CAST(coalesce(ecom_revenue, 0) + coalesce(pos_revenue, 0) AS DOUBLE)
                   / (coalesce(ecom_orders, 0) + coalesce(pos_orders, 0)) ELSE 0.0 END AS avg_order_value,
         first_purchase_date, last_purchase_date,
         CAST(coalesce(date_diff('day', CAST(last_counted_date AS DATE), {AS_OF}), 9999) AS INTEGER) AS days_since_last_purchase,
         favorite_category, preferred_channel,
         coalesce(refund_return_count, 0) AS refund_return_count,
         CAST(coalesce(ecom_revenue, 0) + coalesce(pos_revenue, 0) AS DOUBLE) AS customer_lifetime_value_proxy
  FROM single_customers_p c
  LEFT JOIN p_loyalty l ON c.customer_id = l.customer_id
  LEFT JOIN p_ecom e ON c.customer_id = e.customer_id
  LEFT JOIN p_store s ON c.customer_id = s.customer_id
  LEFT JOIN p_refunds r ON c.customer_id = r.customer_id
  LEFT JOIN p_dates d ON c.customer_id = d.customer_id
  LEFT JOIN p_category g ON c.customer_id = g.customer_id
  LEFT JOIN p_channel h ON c.customer_id = h.customer_id
),
p_recent AS (
  SELECT customer_id,
         count(*) FILTER (bought >= {AS_OF} - 30 AND CAST(bought AS DATE) <= {AS_OF}) AS transactions_last_30d,
         CAST(sum(CASE WHEN bought >= {AS_OF} - 30 AND CAST(bought AS DATE) <= {AS_OF} THEN amt ELSE 0 END) AS DOUBLE) AS revenue_last_30d,
         count(*) FILTER (bought >= {AS_OF} - 90 AND CAST(bought AS DATE) <= {AS_OF}) AS transactions_last_90d,
         CAST(sum(CASE WHEN bought >= {AS_OF} - 90 AND CAST(bought AS DATE) <= {AS_OF} THEN amt ELSE 0 END) AS DOUBLE) AS revenue_last_90d
  FROM (
    SELECT customer_id, order_date AS bought, CAST(order_amount AS DECIMAL(18,2)) AS amt
    FROM p_orders WHERE order_status = 'Completed'
    UNION ALL
    SELECT customer_id, transaction_date, CAST(transaction_amount AS DECIMAL(18,2))
    FROM p_pos WHERE transaction_status = 'Completed')
  WHERE customer_id IS NOT NULL GROUP BY 1
),
p_features AS (
  SELECT z.customer_id, loyalty_tier, points_balance,
         CAST(coalesce(date_diff('day', registration_date, {AS_OF}), 0) AS INTEGER) AS customer_tenure_days,
         days_since_last_purchase,
         coalesce(transactions_last_30d, 0) AS transactions_last_30d,
         coalesce(transactions_last_90d, 0) AS transactions_last_90d,
         coalesce(revenue_last_30d, 0.0) AS revenue_last_30d,
         coalesce(revenue_last_90d, 0.0) AS revenue_last_90d,
         avg_order_value, preferred_channel,
         CASE WHEN total_transactions > 0
              THEN CAST(refund_return_count AS DOUBLE) / CAST(total_transactions AS DOUBLE) ELSE 0.0 END AS refund_return_rate,
         favorite_category,
         CASE WHEN days_since_last_purchase > 90 THEN 1 ELSE 0 END AS base_label,
         CASE WHEN CAST('0x' || substr(md5(z.customer_id || '|label-noise|42'), 1, 12) AS BIGINT)
                   / 281474976710656.0 < 0.12
              THEN 1 - CASE WHEN days_since_last_purchase > 90 THEN 1 ELSE 0 END
              ELSE CASE WHEN days_since_last_purchase > 90 THEN 1 ELSE 0 END END AS churn_label_proxy
  FROM p_360 z
  LEFT JOIN single_customers_p c ON z.customer_id = c.customer_id
  LEFT JOIN p_recent a ON z.customer_id = a.customer_id
),
p_scores AS (
  SELECT customer_id,
    CAST(least(100, CASE WHEN days_since_last_purchase > 180 THEN 40 ELSE 0 END
      + CASE WHEN days_since_last_purchase > 90 THEN 20 ELSE 0 END
      + CASE WHEN total_transactions < 5 THEN 15 ELSE 0 END
      + CASE WHEN total_revenue < 500 THEN 15 ELSE 0 END
      + CASE WHEN refund_return_count > 3 THEN 10 ELSE 0 END) AS INTEGER) AS churn_score,
    churn_risk_band,
    CASE WHEN days_since_last_purchase > 180 THEN 'Extended purchase gap (180+ days)'
         ELSE 'No recent engagement' END AS top_reason_1,
    CASE WHEN total_transactions < 5 THEN 'Low purchase frequency'
         WHEN total_revenue < 500 THEN 'Low customer lifetime value'
         WHEN refund_return_count > 3 THEN 'High return rate'
         ELSE 'Limited engagement' END AS top_reason_2,
    CASE churn_risk_band WHEN 'High' THEN 'Send re-engagement campaign with 15% discount'
         WHEN 'Medium' THEN 'Send personalized product recommendations'
         ELSE 'Continue loyalty rewards program' END AS recommended_action
  FROM (SELECT *, CASE WHEN days_since_last_purchase > 180 OR total_revenue < 100 THEN 'High'
                       WHEN days_since_last_purchase > 90 OR total_revenue < 500 THEN 'Medium'
                       ELSE 'Low' END AS churn_risk_band FROM p_360)
)"""

ACTIONS_N = """
n_actions AS (
  SELECT z.customer_id, full_name, loyalty_tier, total_revenue, favorite_category, preferred_channel,
    churn_score, churn_risk_band,
    coalesce(loyalty_tier, 'Standard') || ' tier customer with $' || CAST(CAST(total_revenue AS DECIMAL(18,2)) AS VARCHAR)
      || ' lifetime value. Prefers ' || coalesce(preferred_channel, 'mixed channels') || ' shopping in '
      || coalesce(favorite_category, 'various categories') || '. Last purchase: ' || days_since_last_purchase
      || ' days ago.' AS customer_summary,
    CASE churn_risk_band
      WHEN 'High' THEN 'URGENT: Win-back campaign. Customer showing high churn risk. Recommend immediate personalized outreach with exclusive offer in '
        || coalesce(favorite_category, 'preferred category') || '. Assign to retention specialist.'
      WHEN 'Medium' THEN 'Re-engagement needed. Send targeted email campaign featuring '
        || coalesce(favorite_category, 'best-selling items') || ' with loyalty points incentive via '
        || coalesce(preferred_channel, 'preferred channel') || '.'
      ELSE 'Maintain engagement. Continue personalized recommendations in ' || coalesce(favorite_category, 'favorite category')
        || '. Celebrate loyalty milestones and offer early access to new arrivals.' END AS next_best_action,
    CASE WHEN churn_risk_band = 'High' AND loyalty_tier IN ('Gold', 'Platinum')
           THEN '30% off + 2x points on next purchase in ' || coalesce(favorite_category, 'any category')
         WHEN churn_risk_band = 'High' THEN '20% off + free shipping in ' || coalesce(favorite_category, 'any category')
         WHEN churn_risk_band = 'Medium' THEN '15% off + bonus loyalty points in ' || coalesce(favorite_category, 'selected categories')
         ELSE 'Early access to new arrivals in ' || coalesce(favorite_category, 'your favorite category') || ' + 500 bonus points' END AS personalized_offer,
    CASE churn_risk_band
      WHEN 'High' THEN 'Hi ' || full_name || ', we miss you! As a valued ' || coalesce(loyalty_tier, 'customer')
        || ' member, here''s an exclusive offer just for you.'
      WHEN 'Medium' THEN 'Hello ' || full_name || ', we have new arrivals in ' || coalesce(favorite_category, 'categories you love')
        || '! Check them out with your special discount.'
      ELSE 'Hi ' || full_name || ', thank you for being a loyal customer! Enjoy exclusive early access and bonus rewards.' END AS recommended_message
  FROM n_360 z JOIN n_scores s ON z.customer_id = s.customer_id
)"""

ACTIONS_P = """
p_actions AS (
  SELECT z.customer_id, full_name, loyalty_tier, total_revenue, favorite_category, preferred_channel,
    churn_score, churn_risk_band,
    concat_ws(' ', full_name, 'is a', loyalty_tier, 'member with $', CAST(CAST(total_revenue AS DECIMAL(18,2)) AS VARCHAR),
      'in lifetime revenue.') AS customer_summary,
    CASE churn_risk_band WHEN 'High' THEN 'Immediate re-engagement: Send 15% discount via preferred channel'
      WHEN 'Medium' THEN 'Nurture: Send category recommendations and loyalty perk'
      ELSE 'Maintain: Continue rewards and early access to new products' END AS next_best_action,
    CASE churn_risk_band WHEN 'High' THEN '15% off your next ' || coalesce(favorite_category, 'store') || ' purchase'
      WHEN 'Medium' THEN 'Free shipping on next order + 2x loyalty points'
      ELSE 'VIP early access to new arrivals' END AS personalized_offer,
    CASE churn_risk_band
      WHEN 'High' THEN concat_ws(' ', 'Hi', full_name, '- we miss you! Here''s 15% off to welcome you back.')
      WHEN 'Medium' THEN concat_ws(' ', 'Hi', full_name, '- check out our latest', favorite_category, 'selections.')
      ELSE concat_ws(' ', 'Hi', full_name, '- as a valued', loyalty_tier, 'member, enjoy early access.') END AS recommended_message
  FROM p_360 z JOIN p_scores s ON z.customer_id = s.customer_id
)"""

KPIS = """
kpis AS (
  SELECT CAST(transaction_timestamp AS DATE) AS metric_date, channel,
         CAST(sum(CAST(gross_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         count(*) AS total_transactions,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(sum(CAST(gross_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value,
         CAST(count(*) FILTER (is_refund_or_return) AS DOUBLE) / count(*) AS refund_return_rate
  FROM transactions GROUP BY 1, 2
)"""

N_ACTIONS = with_(BRONZE, SILVER_N, GOLD_N, ACTIONS_N)
P = with_(BRONZE, SILVER_P, GOLD_P)
P_ACTIONS = with_(BRONZE, SILVER_P, GOLD_P, ACTIONS_P)
N_KPIS = with_(BRONZE, SILVER_N, KPIS)
SILVERS_N = with_(BRONZE, SILVER_N)
SILVERS_P = with_(BRONZE, SILVER_P)
RAW = with_(BRONZE)
RAW_DIRTY = with_(BRONZE, DIRTY)
