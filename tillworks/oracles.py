"""DuckDB statements equal to the catalogue queries, written over the same parquet tables.

Every statement starts from one shared prefix that maps the tables to the sales schema. Quotients of
amounts are rounded half up in whole cents (``//`` on integers), so that neither side depends on how
binary fractions fall.
"""

from __future__ import annotations

from tillworks.plans.campaign import TABLES_1997 as W

LINE_CONTENT = "concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')"
    for c in [
        *"l_linenumber l_partkey l_suppkey l_shipdate".split(),
        *(f"CAST(floor({c} * 100 + 0.5) AS BIGINT)" for c in "l_quantity l_extendedprice l_discount l_tax".split()),
        *"l_returnflag l_linestatus".split(),
    ]
) + ")"

PREFIX = f"""
WITH RECURSIVE
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_mktsegment) AS segment, n_name AS city
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
products AS (
  SELECT p_partkey AS product_id, concat(p_name, ' #', CAST(p_partkey AS VARCHAR)) AS product_name,
         lower(p_type) AS category, p_retailprice AS unit_price
  FROM part),
stores AS (
  SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS store_name, lower(r_name) AS region
  FROM nation JOIN region ON r_regionkey = n_regionkey),
transactions AS (
  SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date,
         o_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS store_id, o_orderpriority AS payment_method
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
raw_items AS (
  SELECT concat_ws('-', l_orderkey, md5({LINE_CONTENT}), row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
                        l_discount, l_tax, l_returnflag, l_linestatus)) AS sales_item_id,
         l_orderkey AS transaction_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
         CAST(round(l_discount * 100) AS INT) AS discount_pct,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS gross_cents,
         CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem),
sales_items AS (
  SELECT sales_item_id, transaction_id, product_id, quantity,
         CAST(CAST((2 * gross_cents + quantity) // (2 * quantity) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2))
           AS unit_price,
         discount_pct, gross_amount,
         CAST(round(gross_amount * discount_pct * 0.01, 2) AS DECIMAL(12,2)) AS discount_amount,
         CAST(gross_amount - CAST(round(gross_amount * discount_pct * 0.01, 2) AS DECIMAL(12,2)) AS DECIMAL(12,2))
           AS net_amount,
         ship_date
  FROM raw_items),
fct_sales AS (
  SELECT si.sales_item_id, t.transaction_id, t.transaction_date, t.customer_id, t.store_id,
         lower(t.payment_method) AS payment_method, si.product_id, si.quantity, si.unit_price,
         si.discount_pct, si.gross_amount, si.discount_amount, si.net_amount, si.ship_date
  FROM sales_items si JOIN transactions t ON t.transaction_id = si.transaction_id)
"""


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded half away from zero to a whole number; NULL for a zero denominator."""
    n, d = f"({numerator})", f"({denominator})"
    return f"CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) END"


def money_mean(total: str, count: str) -> str:
    return f"CAST({half_up(cents(total), f'CAST({count} AS HUGEINT)')} AS DOUBLE) / 100"


def pct(part: str, whole: str) -> str:
    """Percentage of two amounts with two decimals."""
    return f"CAST({half_up(f'{cents(part)} * 10000', cents(whole))} AS DOUBLE) / 100"


def pct_of_counts(part: str, whole: str) -> str:
    return f"CAST({half_up(f'CAST({part} AS HUGEINT) * 10000', f'CAST({whole} AS HUGEINT)')} AS DOUBLE) / 100"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def between(window: tuple) -> str:
    return f"transaction_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}'"


BASE, CAMP = between(W.baseline), between(W.campaign)
EVENT = f"transaction_date = DATE '{W.event_day}'"
OPEN = f"transaction_date >= DATE '{W.open_start}'"

MODELS = {
    "fct_sales": f"""SELECT sales_item_id, transaction_id, transaction_date, customer_id, store_id, payment_method,
        product_id, quantity, {dbl('unit_price')} AS unit_price, discount_pct, {dbl('gross_amount')} AS gross_amount,
        {dbl('discount_amount')} AS discount_amount, {dbl('net_amount')} AS net_amount FROM fct_sales""",
    "stg_transactions": """SELECT transaction_id, transaction_date, customer_id, store_id,
        lower(payment_method) AS payment_method FROM transactions""",
    "stg_sales_items": f"""SELECT sales_item_id, transaction_id, product_id, quantity,
        {dbl('unit_price')} AS unit_price, discount_pct, {dbl('gross_amount')} AS gross_amount,
        {dbl('discount_amount')} AS discount_amount, {dbl('net_amount')} AS net_amount FROM sales_items""",
    "dim_products": "SELECT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price FROM products",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS full_date,
        CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name, CAST(month(d) AS INT) AS month_num,
        monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year_num,
        CASE WHEN dayofweek(d) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend, 'N' AS is_holiday
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(transaction_date) AS lo, max(transaction_date) AS hi FROM transactions) span) days""",
    "flat_sales": f""", product_side AS (SELECT product_id, category, product_name FROM products),
        buyer_side AS (SELECT customer_id, segment AS customer_segment, city AS customer_city FROM customers),
        place_side AS (SELECT store_id, region AS store_region FROM stores)
        SELECT transaction_id, transaction_date, customer_id, store_id, product_id, quantity,
        {dbl('unit_price')} AS unit_price, discount_pct, {dbl('gross_amount')} AS gross_amount,
        {dbl('net_amount')} AS net_amount, payment_method, category, product_name, customer_segment, customer_city,
        store_region
        FROM place_side JOIN (buyer_side JOIN (product_side JOIN fct_sales USING (product_id)) USING (customer_id))
          USING (store_id)""",
}

MONTHS = """, monthly AS (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month_date, sum(net_amount) AS revenue
  FROM fct_sales GROUP BY 1)
"""
BY_NAME = """, by_name AS (
  SELECT p.product_name, p.category, sum(f.net_amount) AS net, sum(f.quantity) AS units
  FROM fct_sales f JOIN products p ON p.product_id = f.product_id GROUP BY 1, 2)
"""

REVENUE = {
    "monthly_store_revenue": f""", by_id AS (
        SELECT store_id, year(transaction_date) AS y, month(transaction_date) AS m, sum(net_amount) AS net
        FROM fct_sales GROUP BY ALL)
        SELECT format('{{:04d}}-{{:02d}}', y, m) AS year_month, store_name, {dbl('sum(net)')} AS revenue
        FROM by_id JOIN stores USING (store_id) GROUP BY y, m, store_name""",
    "top_products": f"""{BY_NAME} SELECT product_name, category, {dbl('net')} AS revenue,
        CAST(units AS BIGINT) AS units_sold FROM by_name ORDER BY net DESC, product_name LIMIT 10""",
    "avg_ticket_by_segment": f""", per_buyer AS (
        SELECT customer_id, sum(net_amount) AS spent, count(DISTINCT transaction_id) AS visits FROM fct_sales GROUP BY ALL)
        SELECT segment, {money_mean('sum(spent)', 'sum(visits)')} AS avg_ticket
        FROM customers JOIN per_buyer USING (customer_id) GROUP BY segment""",
    "monthly_revenue_mom": f"""{MONTHS}, changes AS (
        SELECT month_date, revenue, lag(revenue) OVER (ORDER BY month_date) AS prev FROM monthly)
        SELECT month_date, {dbl('revenue')} AS revenue, {dbl('revenue - prev')} AS delta_prev_month,
        {pct('revenue - prev', 'prev')} AS pct_change FROM changes ORDER BY month_date""",
    "product_rank_in_category": f"""{BY_NAME} SELECT category, product_name, {dbl('net')} AS revenue,
        CAST(rank() OVER (PARTITION BY category ORDER BY net DESC) AS INT) AS category_rank
        FROM by_name QUALIFY category_rank <= 5 ORDER BY category, category_rank""",
    "headline_kpis": f"""SELECT count(DISTINCT transaction_id) AS total_transactions,
        {dbl('sum(net_amount)')} AS total_revenue, {money_mean('sum(net_amount)', 'count(*)')} AS avg_line_amount
        FROM fct_sales""",
    "monthly_revenue": f"{MONTHS} SELECT month_date, {dbl('revenue')} AS revenue FROM monthly ORDER BY 1",
    "category_revenue": f"""{BY_NAME} SELECT category, {dbl('sum(net)')} AS revenue,
        CAST(sum(units) AS BIGINT) AS units_sold FROM by_name GROUP BY 1 ORDER BY 2 DESC""",
    "daily_revenue": f"""SELECT transaction_date, {dbl('sum(net_amount)')} AS revenue,
        {dbl('sum(discount_amount)')} AS discount_amount,
        {pct('sum(discount_amount)', 'sum(gross_amount)')} AS discount_ratio_pct
        FROM fct_sales GROUP BY 1 ORDER BY 1""",
    "ytd_and_mom": f""", per_month AS (
        SELECT year(transaction_date) AS y, month(transaction_date) AS m, monthname(min(transaction_date)) AS n,
               sum(net_amount) AS net FROM fct_sales GROUP BY 1, 2),
        running AS (
        SELECT y, m, n, net, lag(net, 1) OVER (PARTITION BY y ORDER BY m) AS prev,
               sum(net) OVER (PARTITION BY y ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd
        FROM per_month)
        SELECT CAST(y AS INT) AS year_num, CAST(m AS INT) AS month_num, n AS month_name,
        {dbl('net')} AS monthly_revenue, {dbl('ytd')} AS ytd_revenue, {dbl('prev')} AS prev_month_revenue,
        {pct('net - prev', 'prev')} AS mom_growth_pct FROM running ORDER BY 1, 2""",
    "store_matrix": f"""SELECT store_id, {dbl('sum(net_amount)')} AS total_revenue,
        count(DISTINCT transaction_id) AS total_transactions,
        {money_mean('sum(net_amount)', 'count(*)')} AS avg_ticket,
        {pct('sum(CASE WHEN discount_pct > 0 THEN net_amount END)', 'sum(net_amount)')} AS discounted_revenue_pct,
        CAST(rank() OVER (ORDER BY sum(net_amount) DESC) AS INT) AS revenue_rank,
        CAST(dense_rank() OVER (ORDER BY count(DISTINCT transaction_id) DESC) AS INT) AS volume_rank
        FROM fct_sales GROUP BY store_id ORDER BY revenue_rank""",
    "mv_monthly_store_revenue": f"""SELECT CAST(year(transaction_date) AS INT) AS year_num,
        CAST(month(transaction_date) AS INT) AS month_num, store_id, {dbl('sum(net_amount)')} AS revenue,
        count(DISTINCT transaction_id) AS transactions, count(DISTINCT customer_id) AS unique_customers
        FROM fct_sales GROUP BY 1, 2, 3""",
    "store_revenue": f"""SELECT s.store_id, {dbl('coalesce(sum(f.net_amount), 0)')} AS revenue
        FROM stores s LEFT JOIN fct_sales f ON f.store_id = s.store_id GROUP BY 1""",
    "units_by_product": """SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold
        FROM sales_items GROUP BY 1 ORDER BY 2 DESC""",
    "gross_revenue_by_store": f"""SELECT t.store_id, {dbl('sum(si.quantity * si.unit_price)')} AS total_revenue
        FROM transactions t JOIN sales_items si ON si.transaction_id = t.transaction_id GROUP BY 1 ORDER BY 2 DESC""",
    "top2_customers_per_store": f""", spent AS (
        SELECT t.store_id, t.customer_id, sum(si.quantity * si.unit_price) AS total
        FROM transactions t JOIN sales_items si ON si.transaction_id = t.transaction_id GROUP BY 1, 2),
        placed AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY total DESC, customer_id) AS rn FROM spent)
        SELECT store_id, customer_id, {dbl('total')} AS total_spent, CAST(rn AS INT) AS rn FROM placed WHERE rn <= 2""",
    "daily_store_running_total": f""", daily AS (
        SELECT t.store_id, t.transaction_date, sum(si.quantity * si.unit_price) AS total
        FROM transactions t JOIN sales_items si ON si.transaction_id = t.transaction_id GROUP BY 1, 2)
        SELECT store_id, transaction_date, {dbl('total')} AS daily_revenue,
        {dbl('sum(total) OVER (PARTITION BY store_id ORDER BY transaction_date)')} AS cumulative_revenue FROM daily""",
    "table_counts": """SELECT 'customers' AS table_name, count(*) AS row_count FROM customers
        UNION ALL SELECT 'products', count(*) FROM products UNION ALL SELECT 'stores', count(*) FROM stores
        UNION ALL SELECT 'transactions', count(*) FROM transactions
        UNION ALL SELECT 'sales_items', count(*) FROM sales_items""",
}

SCORES = """, base AS (
  SELECT customer_id, max(transaction_date) AS last_purchase, count(DISTINCT transaction_id) AS frequency,
         sum(net_amount) AS monetary FROM fct_sales GROUP BY 1),
as_of AS (SELECT max(transaction_date) + 1 AS d FROM transactions),
scored AS (
  SELECT customer_id, CAST(d - last_purchase AS INT) AS recency_days, frequency, monetary, d,
         CAST(ntile(5) OVER (ORDER BY d - last_purchase, customer_id) AS INT) AS r_score,
         CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INT) AS f_score,
         CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INT) AS m_score
  FROM base JOIN as_of ON true),
labelled AS (
  SELECT customer_id, r_score, f_score, m_score, d,
         CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champion' ELSE 'Other' END AS label
  FROM scored)
"""

CUSTOMERS = {
    "rfm_scores": f"""{SCORES} SELECT customer_id, recency_days, frequency, {dbl('monetary')} AS monetary, r_score,
        f_score, m_score, r_score + f_score + m_score AS rfm_total,
        CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champion' WHEN r_score + f_score + m_score >= 10 THEN 'Loyal'
             WHEN r_score + f_score + m_score >= 7 THEN 'Potential' WHEN r_score <= 2 THEN 'At Risk'
             ELSE 'Need Attention' END AS customer_label FROM scored""",
    "rfm_refresh": f"""{SCORES} SELECT customer_id, r_score, f_score, m_score, label,
        CAST(d AS TIMESTAMP) AS refreshed_at FROM labelled""",
    "customer_label": f"""{SCORES} SELECT c.customer_id, coalesce(l.label, 'Unknown') AS label
        FROM customers c LEFT JOIN labelled l ON l.customer_id = c.customer_id""",
    "customer_ltv": f"""SELECT c.customer_id, {dbl('coalesce(sum(f.net_amount), 0)')} AS lifetime_value
        FROM customers c LEFT JOIN fct_sales f ON f.customer_id = c.customer_id GROUP BY 1""",
    "customer_clv": f""", active AS (
        SELECT c.customer_id, sum(f.net_amount) AS net,
               count(DISTINCT year(transaction_date) * 12 + month(transaction_date)) AS months
        FROM customers c LEFT JOIN fct_sales f ON f.customer_id = c.customer_id GROUP BY 1)
        SELECT customer_id, months AS active_months, coalesce({money_mean('net * 12', 'months')}, 0) AS clv
        FROM active""",
    "customer_transaction_count": """SELECT c.customer_id, count(t.transaction_id) AS transaction_count
        FROM customers c LEFT JOIN transactions t ON t.customer_id = c.customer_id GROUP BY 1""",
    "abc_pareto": f""", revenue AS (SELECT product_id, sum(net_amount) AS revenue FROM fct_sales GROUP BY 1),
        pareto AS (SELECT product_id, revenue, sum(revenue) OVER () AS total,
          sum(revenue) OVER (ORDER BY revenue DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
          FROM revenue)
        SELECT product_id, {dbl('revenue')} AS revenue, {pct('revenue', 'total')} AS pct_of_total,
        {pct('upto', 'total')} AS cumulative_pct,
        CASE WHEN upto * 100 <= total * 80 THEN 'A' WHEN upto * 100 <= total * 95 THEN 'B' ELSE 'C' END AS abc_class
        FROM pareto""",
}

DAILY = """, daily AS (
  SELECT transaction_date, sum(net_amount) AS net, sum(discount_amount) AS discount, sum(gross_amount) AS gross
  FROM fct_sales GROUP BY 1)
"""


def _mean_ratio(window: str) -> str:
    return f"avg(CASE WHEN {window} THEN CAST(discount AS DOUBLE) / nullif(CAST(gross AS DOUBLE), 0) END)"


def _payment_mix(second: str, window: str) -> str:
    named = f"SELECT 'baseline' AS period, * FROM sold WHERE {BASE} UNION ALL SELECT '{second}', * FROM sold WHERE {window}"
    share = pct_of_counts("count(*)", "sum(count(*)) OVER (PARTITION BY period)")
    return f""", sold AS (SELECT DISTINCT transaction_id, transaction_date, payment_method FROM fct_sales),
        in_window AS ({named})
        SELECT period, payment_method, count(*) AS tx_count, {share} AS share_pct
        FROM in_window GROUP BY period, payment_method"""


UPLIFT = f""", sums AS (
  SELECT sum(CASE WHEN {BASE} THEN net_amount END) AS base, sum(CASE WHEN {EVENT} THEN net_amount END) AS bf
  FROM fct_sales),
uplift AS (SELECT base, bf, {half_up(cents('base'), str(W.baseline_days))} AS daily_cents FROM sums)
"""
WIDE = f""", wide AS (
  SELECT p.category, sum(CASE WHEN {EVENT} THEN f.net_amount ELSE 0 END) AS bf,
         sum(CASE WHEN {BASE} THEN f.net_amount ELSE 0 END) AS base
  FROM fct_sales f JOIN products p ON p.product_id = f.product_id GROUP BY 1)
"""
UPLIFT_PCT = (
    "CAST("
    + half_up(f"({cents('bf')} - daily_cents) * 10000", "daily_cents")
    + " AS DOUBLE) / 100"
)
PROMOTED = "(" + ", ".join(f"'{c}'" for c in W.promoted) + ")"

CAMPAIGN = {
    "campaign_uplift": f"""{UPLIFT} SELECT {dbl('base')} AS baseline_revenue,
        CAST(daily_cents AS DOUBLE) / 100 AS baseline_daily, {dbl('bf')} AS bf_revenue, {UPLIFT_PCT} AS uplift_pct
        FROM uplift""",
    "discount_ratio_by_period": f"""{DAILY} SELECT round(100 * {_mean_ratio(BASE)}, 2) AS baseline_discount_pct,
        round(100 * {_mean_ratio(CAMP)}, 2) AS campaign_discount_pct FROM daily""",
    "payment_mix_open": _payment_mix("campaign_plus", OPEN),
    "payment_mix_closed": _payment_mix("campaign", CAMP),
    "category_mix_wide": f"""{WIDE} SELECT category, {dbl('bf')} AS bf_revenue, {dbl('base')} AS baseline_revenue
        FROM wide""",
    "category_mix_long": f"""SELECT p.category, CASE WHEN {BASE} THEN 'baseline' ELSE 'campaign' END AS period,
        {dbl('sum(f.net_amount)')} AS revenue FROM fct_sales f JOIN products p ON p.product_id = f.product_id
        WHERE ({BASE}) OR ({CAMP}) GROUP BY 1, 2""",
    "campaign_kpis": f"""{DAILY}, stats AS (
        SELECT sum(CASE WHEN {BASE} THEN net END) AS bs, count(CASE WHEN {BASE} THEN 1 END) AS bn,
               sum(CASE WHEN {CAMP} THEN net END) AS cs, count(CASE WHEN {CAMP} THEN 1 END) AS cn,
               {_mean_ratio(BASE)} AS br, {_mean_ratio(CAMP)} AS cr FROM daily),
        counts AS (
        SELECT count(CASE WHEN {BASE} AND lower(payment_method) = '{W.mobile_method}' THEN 1 END) AS bm,
               count(CASE WHEN {BASE} THEN 1 END) AS ba,
               count(CASE WHEN {CAMP} AND lower(payment_method) = '{W.mobile_method}' THEN 1 END) AS cm,
               count(CASE WHEN {CAMP} THEN 1 END) AS ca FROM transactions)
        SELECT {money_mean('bs', 'bn')} AS baseline_daily_avg, {money_mean('cs', 'cn')} AS campaign_daily_avg,
        round((({dbl('cs')} / nullif(cn, 0)) / nullif({dbl('bs')} / nullif(bn, 0), 0) - 1) * 100, 2)
          AS campaign_uplift_pct,
        round(br * 100, 2) AS baseline_discount_ratio_pct, round(cr * 100, 2) AS campaign_discount_ratio_pct,
        {pct_of_counts('bm', 'ba')} AS baseline_mobile_share_pct,
        {pct_of_counts('cm', 'ca')} AS campaign_mobile_share_pct FROM stats JOIN counts ON true""",
    "campaign_signals": f"""{UPLIFT} {WIDE} {DAILY}, shares AS (
        SELECT {pct_of_counts(f"count(DISTINCT CASE WHEN {BASE} AND payment_method = '{W.mobile_method}' THEN transaction_id END)", f"count(DISTINCT CASE WHEN {BASE} THEN transaction_id END)")} AS b,
               {pct_of_counts(f"count(DISTINCT CASE WHEN {OPEN} AND payment_method = '{W.mobile_method}' THEN transaction_id END)", f"count(DISTINCT CASE WHEN {OPEN} THEN transaction_id END)")} AS c
        FROM fct_sales),
        signals AS (
        SELECT 'bf_revenue_spike' AS signal, 'up' AS direction, CAST(daily_cents AS DOUBLE) / 100 AS baseline_value,
               {dbl('bf')} AS campaign_value FROM uplift
        UNION ALL SELECT 'discount_ratio_up', 'up', round(100 * {_mean_ratio(BASE)}, 2),
               round(100 * {_mean_ratio(CAMP)}, 2) FROM daily
        UNION ALL SELECT 'mobile_payment_share_up', 'up', b, c FROM shares
        UNION ALL SELECT 'category_mix_shift', '{"_and_".join(W.promoted)}_up',
               {money_mean('sum(base)', str(W.baseline_days))}, {dbl('sum(bf)')} FROM wide
               WHERE category IN {PROMOTED})
        SELECT signal, direction, baseline_value, campaign_value, coalesce(campaign_value > baseline_value, false) AS ok
        FROM signals""",
}


def _load(days: str) -> str:
    return f""", fresh AS (
        SELECT f.* FROM fct_sales f WHERE {days} AND NOT EXISTS (
          SELECT 1 FROM fct_sales old WHERE old.ship_date <= old.transaction_date
            AND old.transaction_id = f.transaction_id AND old.product_id = f.product_id))
        SELECT sales_item_id AS sales_key, CAST(strftime(transaction_date, '%Y%m%d') AS INT) AS date_id, customer_id,
        store_id, product_id, transaction_id, quantity, {dbl('unit_price')} AS unit_price,
        {dbl('discount_pct')} AS discount_pct, {dbl('quantity * unit_price')} AS gross_amount,
        CAST({half_up(f"{cents('quantity * unit_price')} * (100 - discount_pct)", '100')} AS DOUBLE) / 100 AS net_amount,
        payment_method FROM fresh"""


def _rules(table: str, source: str, not_null: str = "", checks: tuple = (), non_empty: bool = False) -> list[str]:
    found = [(c, "not_null", f"{c} IS NULL") for c in not_null.split()]
    found += [(column, rule, f"NOT ({good})") for rule, column, good in checks]
    parts = [
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name,"
        f" count(CASE WHEN {bad} THEN 1 END) AS failures FROM {source}"
        for column, rule, bad in found
    ]
    if non_empty:
        parts.append(f"SELECT '{table}', 'non_empty', '*', CAST(count(*) = 0 AS BIGINT) FROM {source}")
    return parts


def _unique(table: str, source: str, key: str) -> str:
    return (
        f"SELECT '{table}', 'unique', '{key}', count(*) FROM"
        f" (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    )


def _parent(table: str, source: str, key: str, parent: str) -> str:
    return (
        f"SELECT '{table}', 'relationship', '{key}', count(*) FROM {source} child WHERE {key} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = child.{key})"
    )


ITEM_COLUMNS = (
    "sales_item_id transaction_id product_id quantity unit_price discount_pct gross_amount discount_amount net_amount"
)
QUALITY = [
    *_rules(
        "customers",
        "customers",
        "customer_id customer_name segment city",
        (
            (
                "accepted_values",
                "segment",
                "segment IN ('automobile', 'building', 'furniture', 'household', 'machinery')",
            ),
        ),
    ),
    _unique("customers", "customers", "customer_id"),
    *_rules("products", "products", "product_id product_name category unit_price"),
    _unique("products", "products", "product_id"),
    *_rules("stores", "stores", "store_id store_name region"),
    _unique("stores", "stores", "store_id"),
    *_rules(
        "stg_transactions",
        "transactions",
        "transaction_id transaction_date customer_id store_id payment_method",
        (
            (
                "accepted_values",
                "payment_method",
                "lower(payment_method) IN ('1-urgent', '2-high', '3-medium', '4-not specified', '5-low')",
            ),
        ),
    ),
    _unique("stg_transactions", "transactions", "transaction_id"),
    _parent("stg_transactions", "transactions", "customer_id", "customers"),
    _parent("stg_transactions", "transactions", "store_id", "stores"),
    *_rules(
        "stg_sales_items",
        "sales_items",
        ITEM_COLUMNS,
        (
            ("positive_quantity", "quantity", "quantity > 0"),
            ("positive_price", "unit_price", "unit_price > 0"),
            ("discount_range", "discount_pct", "discount_pct BETWEEN 0 AND 100"),
            ("amounts_add_up", "net_amount", "gross_amount - discount_amount = net_amount"),
        ),
    ),
    _unique("stg_sales_items", "sales_items", "sales_item_id"),
    _parent("stg_sales_items", "sales_items", "transaction_id", "transactions"),
    _parent("stg_sales_items", "sales_items", "product_id", "products"),
    *_rules("fct_sales", "fct_sales", "sales_item_id transaction_id product_id net_amount", non_empty=True),
    _unique("fct_sales", "fct_sales", "sales_item_id"),
    _parent("fct_sales", "fct_sales", "transaction_id", "transactions"),
]

OPERATIONS = {
    "dim_date_upsert": """SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS full_date,
        CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name, CAST(month(d) AS INT) AS month_num,
        monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year_num,
        CASE WHEN dayofweek(d) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend, 'N' AS is_holiday
        FROM (SELECT transaction_date AS d FROM transactions) days WHERE d BETWEEN DATE '1997-11-15' AND DATE '1997-11-30'""",
    "partitioned_fact": f"""SELECT CAST(1997 AS INT) AS year, CAST(4 AS INT) AS quarter, store_id,
        {dbl('sum(net_amount)')} AS revenue, count(*) AS line_count FROM fct_sales
        WHERE transaction_date BETWEEN DATE '1997-10-01' AND DATE '1997-12-31' GROUP BY 3""",
    "mv_after_loads": f"""SELECT CAST(year(transaction_date) AS INT) AS year_num,
        CAST(month(transaction_date) AS INT) AS month_num, store_id, CAST(date_trunc('month', min(transaction_date)) AS DATE) AS month_start,
        {dbl('sum(net_amount)')} AS revenue, count(DISTINCT transaction_id) AS transactions,
        count(DISTINCT customer_id) AS unique_customers
        FROM fct_sales WHERE transaction_date <= DATE '1998-12-31' GROUP BY 1, 2, 3""",
    "sales_keys": """, loads AS (
        SELECT sales_item_id, transaction_id, CAST(transaction_date > DATE '1996-06-30' AS INT) AS load
        FROM sales_items JOIN transactions USING (transaction_id))
        SELECT row_number() OVER (ORDER BY load, sales_item_id) AS sales_key, sales_item_id, transaction_id FROM loads""",
    "quality_report": " UNION ALL ".join(QUALITY),
    "etl_load_day": _load("transaction_date = DATE '1997-11-28'"),
    "etl_load_month": _load("transaction_date BETWEEN DATE '1997-11-01' AND DATE '1997-11-30'"),
}

CODES = """, flat AS (
  SELECT f.*, p.category, c.segment, c.city, s.region
  FROM fct_sales f JOIN products p ON p.product_id = f.product_id
  JOIN customers c ON c.customer_id = f.customer_id JOIN stores s ON s.store_id = f.store_id),
coded AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INT) AS category_code,
         CAST(dense_rank() OVER (ORDER BY city) - 1 AS INT) AS city_code,
         CAST(dense_rank() OVER (ORDER BY region) - 1 AS INT) AS region_code,
         CAST(dense_rank() OVER (ORDER BY payment_method) - 1 AS INT) AS payment_code,
         CAST(dense_rank() OVER (ORDER BY segment) - 1 AS INT) AS segment_code
  FROM flat)
"""
VALUES = """, customer_values AS (
  SELECT customer_id, CAST(sum(net_amount) AS DOUBLE) AS total_spent,
         CAST(sum(net_amount) AS DOUBLE) / count(*) AS avg_basket,
         count(DISTINCT transaction_id) AS num_transactions,
         CAST(sum(quantity) AS DOUBLE) / count(*) AS avg_quantity,
         CAST(sum(discount_pct) AS DOUBLE) / count(*) AS avg_discount
  FROM fct_sales GROUP BY 1)
"""
VALUE_COLUMNS = "total_spent avg_basket num_transactions avg_quantity avg_discount".split()
SCALED = (
    VALUES
    + ", scaled AS (SELECT customer_id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in VALUE_COLUMNS)
    + " FROM customer_values)"
)
DISTANCE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in VALUE_COLUMNS)
DENSITY = f"""{SCALED}, near AS MATERIALIZED (
  SELECT a.customer_id AS u, b.customer_id AS v FROM scaled a JOIN scaled b ON {DISTANCE} <= 0.8 * 0.8),
core AS MATERIALIZED (SELECT u FROM near GROUP BY 1 HAVING count(*) >= 5),
links AS MATERIALIZED (SELECT near.u, near.v FROM near JOIN core a ON a.u = near.u JOIN core b ON b.u = near.v),
reach AS (
  SELECT u AS root, u AS node FROM core
  UNION
  SELECT reach.root, links.v FROM reach JOIN links ON links.u = reach.node WHERE reach.root <= links.v),
component AS (SELECT node, min(root) AS root FROM reach GROUP BY 1),
clusters AS (SELECT node, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INT) AS cluster FROM component),
labels AS (
  SELECT s.customer_id, coalesce(own.cluster, min(other.cluster), -1) AS dbscan_cluster
  FROM scaled s LEFT JOIN clusters own ON own.node = s.customer_id
  LEFT JOIN near ON near.u = s.customer_id LEFT JOIN clusters other ON other.node = near.v
  GROUP BY s.customer_id, own.cluster)
"""


def _power_iteration(component: int) -> str:
    """The component's direction and eigenvalue from the matrix that the components before it have left."""
    k = component
    return f"""walk{k} AS (
  SELECT 0 AS i, m, [1.0, 0.8, 0.6, 0.7, 0.9]::DOUBLE[] AS v FROM left{k}
  UNION ALL
  SELECT i + 1, m, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT i, m, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM walk{k} WHERE i < 3000)),
found{k} AS (
  SELECT m, v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS value
  FROM walk{k} WHERE i = 3000),
left{k + 1} AS (
  SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - value * v[i] * v[j])) AS m FROM found{k})"""


CORRELATION = "[" + ", ".join(
    "[" + ", ".join(f"sum({a} * {b}) / count(*)" for b in VALUE_COLUMNS) + "]" for a in VALUE_COLUMNS
) + "]"
COMPONENTS = (
    f"{SCALED}, left1 AS (SELECT {CORRELATION} AS m FROM scaled), "
    + ", ".join(_power_iteration(k) for k in range(1, len(VALUE_COLUMNS) + 1))
    + ", components AS ("
    + " UNION ALL ".join(f"SELECT {k} AS component, v, value FROM found{k}" for k in range(1, len(VALUE_COLUMNS) + 1))
    + """), signed AS (
  SELECT component, value, list_transform(v, lambda x: x * sign(list_max(v) + list_min(v))) AS v FROM components)
"""
)
PROJECTED = ", ".join(
    f"round(list_dot_product([{', '.join(VALUE_COLUMNS)}], (SELECT v FROM signed WHERE component = {k})), 6) AS pc{k}"
    for k in (1, 2)
)
# Silhouette with squared distances: the mean distance of a point to a cluster of n points with sum s and squared sum q
# is |x|^2 + q / n - 2 x s / n.
SILHOUETTE = f"""{DENSITY}, member AS (
  SELECT s.customer_id, dbscan_cluster AS c, [{", ".join(VALUE_COLUMNS)}] AS x FROM scaled s JOIN labels USING (customer_id)
  WHERE dbscan_cluster <> -1),
cluster AS (
  SELECT c, count(*) AS n, sum(list_dot_product(x, x)) AS q, [{", ".join(f"sum(x[{i}])" for i in range(1, 6))}] AS s
  FROM member GROUP BY c),
distance AS (
  SELECT customer_id, m.c AS own, k.c AS other, k.n,
         list_dot_product(x, x) + q / k.n - 2 * list_dot_product(x, s) / k.n AS d FROM member m JOIN cluster k ON true),
sides AS (
  SELECT customer_id, max(CASE WHEN own = other THEN n END) AS n,
         max(CASE WHEN own = other THEN d * n / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN d END) AS b
  FROM distance GROUP BY customer_id)
"""


def hash_number(key: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


LINE_X = "quantity unit_price discount_pct has_discount day_of_week month is_weekend category_encoded".split()
LINE_X += "customer_city_encoded store_region_encoded payment_method_encoded".split()
CUSTOMER_X = [*VALUE_COLUMNS, "favourite_category", "preferred_payment", "store_region"]
LINE_ROWS = """, line_rows AS MATERIALIZED (
  SELECT [CAST(quantity AS DOUBLE), CAST(unit_price AS DOUBLE), discount_pct, CAST(discount_pct > 0 AS INT),
          isodow(transaction_date) - 1, month(transaction_date), CAST(isodow(transaction_date) >= 6 AS INT), category_code,
          city_code, region_code, payment_code] AS x, CAST(net_amount * 100 AS BIGINT) AS cents, sales_item_id FROM coded),
train AS MATERIALIZED (SELECT x, cents AS label, [cents] AS m FROM line_rows WHERE {hash} % 100 >= 20),
test AS MATERIALIZED (SELECT x, cents AS label FROM line_rows WHERE {hash} % 100 < 20)
"""
CUSTOMER_ROWS = """, buyers AS MATERIALIZED ({features}),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY segment_encoded ORDER BY {hash}, customer_id) AS place,
         count(*) OVER (PARTITION BY segment_encoded) AS size FROM buyers),
parted AS MATERIALIZED (
  SELECT [total_spent, avg_basket, num_transactions, avg_quantity, avg_discount, favourite_category, preferred_payment,
          store_region] AS x, segment_encoded AS label, place * 200 <= size * 40 + 100 AS in_test FROM drawn),
train AS MATERIALIZED (
  SELECT x, label, list_transform(range((SELECT max(label) + 1 FROM parted)), lambda c: CAST(c = label AS BIGINT)) AS m
  FROM parted WHERE NOT in_test),
test AS MATERIALIZED (SELECT x, label FROM parted WHERE in_test)
"""


def _tree(measures: int, features: int, depth: int) -> str:
    """A tree over ``train`` (x, label, m): for each level its rows, the counts per value, running sums and the best split."""
    sums = [f"sum(m[{i + 1}])" for i in range(measures)]
    parts = [", level0 AS MATERIALIZED (SELECT 1 AS node, x, label, m FROM train)"]
    for k in range(depth):
        named = ", ".join(f"{s} AS m{i}" for i, s in enumerate(sums))
        totals = ", ".join(f"{s} AS t{i}" for i, s in enumerate(sums))
        running = ", ".join(f"sum(m{i}) OVER w AS l{i}" for i in range(measures))
        left = " + ".join(f"CAST(l{i} AS DOUBLE) * CAST(l{i} AS DOUBLE)" for i in range(measures))
        right = " + ".join(f"CAST(t{i} - l{i} AS DOUBLE) * CAST(t{i} - l{i} AS DOUBLE)" for i in range(measures))
        parts.append(f"""open{k} AS (
  SELECT node, count(*) AS n, {totals} FROM level{k} GROUP BY node HAVING min(label) <> max(label)),
long{k} AS (SELECT node, unnest(range({features})) AS f, unnest(x) AS v, m FROM level{k} SEMI JOIN open{k} USING (node)),
counted{k} AS MATERIALIZED (SELECT node, f, v, count(*) AS c, {named} FROM long{k} GROUP BY node, f, v),
running{k} AS (
  SELECT node, f, v, lead(v) OVER w AS next, sum(c) OVER w AS l, {running} FROM counted{k}
  WINDOW w AS (PARTITION BY node, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
scored{k} AS (
  SELECT node, f, v, next, ({left}) / l + ({right}) / (n - l) AS score FROM running{k} JOIN open{k} USING (node) WHERE l < n),
best{k} AS MATERIALIZED (
  SELECT node, f, (v + next) / 2 AS threshold FROM scored{k}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, f, v) = 1),
level{k + 1} AS MATERIALIZED (
  SELECT CASE WHEN x[f + 1] <= threshold THEN 2 * node ELSE 2 * node + 1 END AS node, x, label, m
  FROM level{k} JOIN best{k} USING (node))""")
    placed = "SELECT x, label, 1 AS node FROM test"
    for k in range(depth):
        placed = f"""SELECT x, label, CASE WHEN f IS NULL THEN node WHEN x[f + 1] <= threshold THEN 2 * node
          ELSE 2 * node + 1 END AS node FROM ({placed}) p{k} LEFT JOIN best{k} USING (node)"""
    levels = " UNION ALL ".join(f"SELECT * FROM level{k}" for k in range(depth + 1))
    totals = ", ".join(f"{s} AS m{i}" for i, s in enumerate(sums))
    splits = " UNION ALL ".join(f"SELECT * FROM best{k}" for k in range(depth))
    parts.append(f"nodes AS (SELECT node, count(*) AS n, {totals} FROM ({levels}) every_level GROUP BY node)")
    parts.append(f"splits AS ({splits}), placed AS MATERIALIZED ({placed})")
    return ", ".join(parts)


def _main_class(classes: int) -> str:
    most = f"greatest({', '.join(f'm{i}' for i in range(classes))})"
    return "CASE " + " ".join(f"WHEN m{i} = {most} THEN {i}" for i in range(classes)) + " END"


def _tree_nodes(names: list[str], value: str) -> str:
    listed = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return f"""SELECT CAST(node AS BIGINT) AS node, {listed}[f + 1] AS feature, threshold, n AS row_count,
        CAST({value} AS DOUBLE) AS value FROM nodes LEFT JOIN splits USING (node)"""


# The five segments of the tables.
SEGMENT_CLASSES = 5
ERRORS = """SELECT 'regression' AS task, '{model}' AS model, metric, round(value, 4) AS value FROM (
  SELECT unnest(['MAE', 'RMSE', 'R2']) AS metric, unnest([avg(abs(y - p)), sqrt(avg((y - p) * (y - p))),
         1 - avg((y - p) * (y - p)) / nullif(var_pop(y), 0)]) AS value FROM judged) errors"""
REPORT = """, judged AS ({judged}), classes AS (
  SELECT class, count(*) FILTER (truth = class) AS support, count(*) FILTER (guess = class) AS guesses,
         count(*) FILTER (truth = class AND guess = class) AS hits
  FROM judged, (SELECT DISTINCT truth AS class FROM judged) seen GROUP BY class),
figures AS (
  SELECT class, support, coalesce(hits / nullif(guesses, 0), 0) AS p, hits / support AS r FROM classes),
told AS (
  SELECT concat(name, '_class_', CAST(class AS VARCHAR)) AS metric, value FROM (
    SELECT class, unnest(['precision', 'recall', 'f1', 'support']) AS name,
           unnest([p, r, coalesce(2 * p * r / nullif(p + r, 0), 0), CAST(support AS DOUBLE)]) AS value FROM figures) listed
  UNION ALL SELECT 'Accuracy', avg(CAST(truth = guess AS INT)) FROM judged)
SELECT 'classification' AS task, '{model}' AS model, metric, round(value, 4) AS value FROM told"""


# Gauss-Jordan elimination of the normal equations: one column per step of the recursion.
WHOLE_TERMS = ["intercept", "quantity", "unit_cents", *LINE_X[2:]]
_TERMS = range(1, len(WHOLE_TERMS) + 1)
EQUATIONS = CODES + LINE_ROWS.format(hash=hash_number("sales_item_id")) + """, whole AS (
  SELECT list_concat([CAST(1 AS DOUBLE), x[1], CAST(round(x[2] * 100) AS DOUBLE)], x[3:]) AS x, CAST(label AS DOUBLE) AS y FROM {part}),
""".format(part="train") + "gram AS (SELECT [" + ", ".join(
    "[" + ", ".join([*(f"sum(x[{i}] * x[{j}])" for j in _TERMS), f"sum(x[{i}] * y)"]) + "]" for i in _TERMS
) + f"""] AS m FROM whole),
eliminated AS (
  SELECT 1 AS k, m FROM gram
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
    ELSE list_transform(r, lambda v, j: v - m[i][k] * m[k][j] / m[k][k]) END)
  FROM eliminated WHERE k <= {len(WHOLE_TERMS)}),
weights AS MATERIALIZED (
  SELECT list_transform(m, lambda r: r[{len(WHOLE_TERMS) + 1}]) AS w FROM eliminated WHERE k = {len(WHOLE_TERMS) + 1})
"""
MOST_CLUSTERS, LLOYD_ROUNDS = 8, 15


def _from_centre(c: str) -> str:
    return " + ".join(f"(x[{i}] - {c}[{i}]) * (x[{i}] - {c}[{i}])" for i in range(1, len(VALUE_COLUMNS) + 1))


def _lloyd() -> str:
    """Seeds by farthest point, then rounds for every k; ``owned`` names each point's nearest centre."""
    whole = ", ".join(f"CAST(round({c} * 1000000) AS BIGINT)" for c in VALUE_COLUMNS)
    parts = [f"{SCALED}, point AS MATERIALIZED (SELECT customer_id AS key, [{whole}] AS x FROM scaled)"]
    parts.append("seed1 AS MATERIALIZED (SELECT 1 AS j, CAST(x AS DOUBLE[]) AS c FROM point ORDER BY key LIMIT 1)")
    for j in range(2, MOST_CLUSTERS + 1):
        parts.append(f"""seed{j} AS MATERIALIZED (
  SELECT * FROM seed{j - 1} UNION ALL (
    SELECT {j}, CAST(any_value(x) AS DOUBLE[]) FROM point, seed{j - 1} GROUP BY key
    ORDER BY min({_from_centre('c')}) DESC, key LIMIT 1))""")
    parts.append(f"centre0 AS MATERIALIZED (SELECT k, j, c FROM seed{MOST_CLUSTERS}, range(2, {MOST_CLUSTERS + 1}) ks(k) WHERE j <= k)")
    means = ", ".join(f"CAST(sum(x[{i}]) AS DOUBLE) / count(*)" for i in range(1, len(VALUE_COLUMNS) + 1))
    for r in range(LLOYD_ROUNDS + 1):
        parts.append(f"""owned{r} AS MATERIALIZED (
  SELECT key, k, x, arg_min(j, d) AS j, min(d) AS d FROM (
    SELECT key, k, j, x, struct_pack(d := {_from_centre('c')}, j := j) AS d FROM point, centre{r}) each_centre GROUP BY key, k, x)""")
        parts.append(f"""centre{r + 1} AS MATERIALIZED (
  SELECT k, j, coalesce(o.c, was.c) AS c FROM centre{r} was
  LEFT JOIN (SELECT k, j, [{means}] AS c FROM owned{r} GROUP BY k, j) o USING (k, j))""")
    return ", ".join(parts)


LEARNING = {
    "linear_coefficients": EQUATIONS + f"""SELECT CAST(i - 1 AS INT) AS place, {WHOLE_TERMS}[i] AS term, round(w[i], 6) AS coefficient
        FROM weights, range(1, {len(WHOLE_TERMS) + 1}) terms(i)""",
    "linear_metrics": EQUATIONS + f""", judged AS (
        SELECT CAST(label AS DOUBLE) / 100 AS y, list_dot_product(w, list_concat(
          [CAST(1 AS DOUBLE), x[1], CAST(round(x[2] * 100) AS DOUBLE)], x[3:])) / 100 AS p FROM test, weights)
        """ + ERRORS.format(model="Linear Regression"),
    "lloyd_clusters": _lloyd() + f"SELECT key AS customer_id, CAST(k AS INT) AS k, CAST(j - 1 AS INT) AS cluster FROM owned{LLOYD_ROUNDS}",
    "lloyd_elbow": _lloyd() + f"""SELECT CAST(k AS INT) AS k, round(sum(d) / 1e12, 4) AS inertia, max(n) AS largest_cluster FROM (
        SELECT k, j, sum(d.d) AS d, count(*) AS n FROM owned{LLOYD_ROUNDS} GROUP BY k, j) sizes GROUP BY k""",
    "line_features": f"""{CODES} SELECT sales_item_id, quantity, {dbl('unit_price')} AS unit_price, discount_pct,
        CAST(discount_pct > 0 AS INT) AS has_discount, CAST(isodow(transaction_date) - 1 AS INT) AS day_of_week,
        CAST(month(transaction_date) AS INT) AS month, CAST(isodow(transaction_date) >= 6 AS INT) AS is_weekend,
        category_code AS category_encoded, city_code AS customer_city_encoded, region_code AS store_region_encoded,
        payment_code AS payment_method_encoded, segment_code AS segment_encoded, {dbl('net_amount')} AS net_amount
        FROM coded""",
    "customer_values": f"{VALUES} SELECT * FROM customer_values",
    "customer_features": f"""{VALUES} {CODES}, medians AS (
        SELECT customer_id, {dbl('median(category_code)')} AS favourite_category,
               {dbl('median(region_code)')} AS store_region, min(segment_code) AS segment_encoded FROM coded GROUP BY 1),
        payments AS (
        SELECT customer_id, payment_code, row_number() OVER (
                 PARTITION BY customer_id ORDER BY count(*) DESC, payment_code) AS place
        FROM coded GROUP BY 1, 2)
        SELECT v.*, m.favourite_category, p.payment_code AS preferred_payment, m.store_region, m.segment_encoded
        FROM customer_values v JOIN medians m ON m.customer_id = v.customer_id
        JOIN payments p ON p.customer_id = v.customer_id AND p.place = 1""",
    "random_split": f"""SELECT CASE WHEN {hash_number('sales_item_id')} % 100 < 20 THEN 'test' ELSE 'train' END AS split,
        count(*) AS line_count, {dbl('sum(net_amount)')} AS revenue FROM sales_items GROUP BY 1""",
    "stratified_split": f""", drawn AS (
        SELECT customer_id, segment, row_number() OVER (
                 PARTITION BY segment ORDER BY {hash_number('customer_id')}, customer_id) AS place,
               count(*) OVER (PARTITION BY segment) AS size FROM customers)
        SELECT customer_id, segment, CASE WHEN place * 200 <= size * 40 + 100 THEN 'test' ELSE 'train' END AS split
        FROM drawn""",
    "class_supports": f"""{CODES}, drawn AS (
        SELECT customer_id, segment_code, row_number() OVER (
                 PARTITION BY segment_code ORDER BY {hash_number('customer_id')}, customer_id) AS place,
               count(*) OVER (PARTITION BY segment_code) AS size
        FROM (SELECT DISTINCT customer_id, segment_code FROM coded) buyers)
        SELECT segment_code AS segment_encoded,
        CASE WHEN place * 200 <= size * 40 + 100 THEN 'test' ELSE 'train' END AS split, count(*) AS customers
        FROM drawn GROUP BY 1, 2""",
    "fold_sizes": f"""SELECT fold, count(*) AS line_count, {dbl('sum(net_amount)')} AS revenue FROM (
        SELECT CAST(ntile(5) OVER (ORDER BY sales_item_id) AS INT) AS fold, net_amount FROM sales_items) folds GROUP BY 1""",
    "pca_variance": f"""{COMPONENTS} SELECT CAST(component AS INT) AS component,
        round(value / sum(value) OVER (), 6) AS explained_ratio,
        round(sum(value) OVER (ORDER BY component) / sum(value) OVER (), 6) AS cumulative_ratio FROM signed""",
    "pca_projections": f"{COMPONENTS} SELECT customer_id, {PROJECTED} FROM scaled",
    "dbscan_silhouette": f"""{SILHOUETTE} SELECT CASE WHEN count(DISTINCT b) > 0 THEN
        round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) END AS silhouette FROM sides""",
    "amount_tree": CODES + LINE_ROWS.format(hash=hash_number("sales_item_id")) + _tree(1, len(LINE_X), 6)
    + _tree_nodes(LINE_X, "CAST(m0 AS DOUBLE) / n / 100"),
    "amount_tree_metrics": CODES + LINE_ROWS.format(hash=hash_number("sales_item_id")) + _tree(1, len(LINE_X), 6)
    + ", judged AS (SELECT CAST(label AS DOUBLE) / 100 AS y, CAST(m0 AS DOUBLE) / n / 100 AS p FROM placed JOIN nodes USING (node)) "
    + ERRORS.format(model="Decision Tree"),
    "scaled_customer_values": f"{SCALED} SELECT * FROM scaled",
    "dbscan_clusters": f"{DENSITY} SELECT customer_id, dbscan_cluster FROM labels",
    "dbscan_counts": f"""{DENSITY} SELECT count(DISTINCT CASE WHEN dbscan_cluster >= 0 THEN dbscan_cluster END)
        AS clusters, count(CASE WHEN dbscan_cluster = -1 THEN 1 END) AS noise FROM labels""",
}


BUYERS = LEARNING["customer_features"].partition("SELECT v.*")
SEGMENT_ROWS = BUYERS[0] + CUSTOMER_ROWS.format(features=BUYERS[1] + BUYERS[2], hash=hash_number("customer_id"))
SEGMENT_TREE = SEGMENT_ROWS + _tree(SEGMENT_CLASSES, len(CUSTOMER_X), 5)
GUESSED = f"SELECT label AS truth, {_main_class(SEGMENT_CLASSES)} AS guess FROM placed JOIN nodes USING (node)"
LEARNING["segment_tree"] = SEGMENT_TREE + _tree_nodes(CUSTOMER_X, _main_class(SEGMENT_CLASSES))
LEARNING["segment_tree_metrics"] = SEGMENT_TREE + REPORT.format(judged=GUESSED, model="Decision Tree")


def all_oracles() -> dict[str, str]:
    return {name: PREFIX + body for name, body in {**MODELS, **REVENUE, **CUSTOMERS, **CAMPAIGN, **OPERATIONS, **LEARNING}.items()}
