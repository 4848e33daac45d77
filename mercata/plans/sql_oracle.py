"""Oracle SQL: every registered query restated as plain SQL for DuckDB.

The oracle is deliberately naive: surrogate keys are ``row_number()`` over the
natural columns, marts join first and group afterwards (the source warehouse's
shape), ranks and shares use ordinary windows / scalar subqueries.  Output
types are cast to the Spark result types so schemas compare equal.
"""

from __future__ import annotations

from mercata.sources.driver_tables import ORDERS_SQL, PEOPLE_SQL, RETURNS_SQL, duckdb_text


def _keyed(key: str, cols: list[str], source: str, distinct: bool = True, order_by: list[str] | None = None) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in (order_by or cols))
    sel = ", ".join(cols)
    inner = f"SELECT DISTINCT {sel} FROM {source}" if distinct else f"SELECT {sel} FROM {source}"
    return f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {key}, {sel} FROM ({inner}) t"


def _dkey(col: str) -> str:
    return f"CAST(strftime({col}, '%Y%m%d') AS INTEGER)"


def _mean(col: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / NULLIF(COUNT({col}), 0)"


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE)"


def _margin(col: str = "profit_margin") -> str:
    """Mean of a double column over an order-independent sum: units of 2^48, 2^24, ... 2^-72, each summed as an integer."""
    units = [f"round_even({col} * CAST({2.0 ** -p!r} AS DOUBLE), 0)" for p in (48, 24, 0, -24, -48, -72)]
    own = [units[0], *(f"({u} - {above} * CAST(16777216 AS DOUBLE))" for above, u in zip(units, units[1:]))]
    sums = [f"CAST(SUM(CAST({x} AS BIGINT)) AS DOUBLE) * CAST({2.0 ** p!r} AS DOUBLE)" for p, x in zip((48, 24, 0, -24, -48, -72), own)]
    return f"({' + '.join(reversed(sums))}) / NULLIF(COUNT({col}), 0)"


# Restated here, not imported: a wrong value in the engine must not pass.
_SHIP_CASE = """CASE ship_mode
    WHEN 'First Class' THEN 'Priority shipping (1-2 business days)'
    WHEN 'Second Class' THEN 'Standard priority (2-4 business days)'
    WHEN 'Standard Class' THEN 'Regular shipping (4-7 business days)'
    WHEN 'Same Day' THEN 'Same day delivery'
    ELSE 'Unknown' END"""
_TIER_CASE = """CASE WHEN lifetime_revenue >= 5000 THEN 'Platinum' WHEN lifetime_revenue >= 2000 THEN 'Gold'
    WHEN lifetime_revenue >= 500 THEN 'Silver' ELSE 'Bronze' END"""

_FACT_SALES_ORDER = ["order_id", "order_date_key", "ship_date_key", "customer_key", "product_key",
                     "geography_key", "ship_mode_key", "revenue", "quantity", "discount", "profit"]

CTES: dict[str, str] = {
    "fx_orders": duckdb_text(ORDERS_SQL),
    "fx_people": duckdb_text(PEOPLE_SQL),
    "fx_returns": duckdb_text(RETURNS_SQL),
    "dim_customer": _keyed("customer_key", ["customer_id", "customer_name", "segment"], "fx_orders"),
    "dim_product": _keyed("product_key", ["product_id", "category", "sub_category", "product_name"], "fx_orders"),
    "dim_geography": _keyed("geography_key", ["country", "state", "city", "postal_code", "region"], "fx_orders"),
    "dim_ship_mode": f"SELECT ship_mode_key, ship_mode, {_SHIP_CASE} AS ship_mode_description FROM ("
                     + _keyed("ship_mode_key", ["ship_mode"], "fx_orders") + ") s",
    "dim_date": f"""SELECT {_dkey('date')} AS date_key, date,
        CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
        CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
        CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
        dayname(date) AS day_name, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
        CASE WHEN dayofweek(date) IN (0, 6) THEN TRUE ELSE FALSE END AS is_weekend
      FROM (SELECT order_date AS date FROM fx_orders UNION SELECT ship_date AS date FROM fx_orders) d""",
    "dim_regional_manager": _keyed("manager_key", ["manager_name", "region"],
                                   "(SELECT regional_manager AS manager_name, region FROM fx_people)",
                                   distinct=False, order_by=["region", "manager_name"]),
    "fact_sales_lines": f"""SELECT o.order_id, {_dkey('o.order_date')} AS order_date_key,
        {_dkey('o.ship_date')} AS ship_date_key, c.customer_key, p.product_key, g.geography_key,
        s.ship_mode_key, o.sales AS revenue, o.quantity, o.discount, o.profit,
        CAST(o.sales - o.profit AS DECIMAL(19,9)) AS cost,
        CASE WHEN o.sales <> 0 THEN CAST(o.profit AS DOUBLE) / CAST(o.sales AS DOUBLE) ELSE 0.0 END AS profit_margin
      FROM fx_orders o
      LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
      LEFT JOIN dim_product p ON o.product_id = p.product_id
      LEFT JOIN dim_geography g ON o.country = g.country AND o.state = g.state
                               AND o.city = g.city AND o.postal_code = g.postal_code
      LEFT JOIN dim_ship_mode s ON o.ship_mode = s.ship_mode""",
    "fact_sales": "SELECT CAST(row_number() OVER (ORDER BY "
                  + ", ".join(f"{c} ASC NULLS FIRST" for c in _FACT_SALES_ORDER)
                  + ") AS BIGINT) AS sales_key, order_id, order_date_key, ship_date_key, customer_key, "
                    "product_key, geography_key, ship_mode_key, revenue, quantity, discount, profit, cost, "
                    "profit_margin FROM fact_sales_lines",
    "fact_returns_lines": f"""SELECT r.order_id, {_dkey('ol.order_date')} AS order_date_key,
        c.customer_key, p.product_key
      FROM (SELECT order_id FROM fx_returns WHERE returned = 'Yes') r
      LEFT JOIN (SELECT DISTINCT order_id, customer_id, product_id, order_date, region FROM fx_orders) ol
             ON r.order_id = ol.order_id
      LEFT JOIN dim_customer c ON ol.customer_id = c.customer_id
      LEFT JOIN dim_product p ON ol.product_id = p.product_id""",
    "fact_returns": """SELECT CAST(row_number() OVER (ORDER BY order_id ASC NULLS FIRST,
        order_date_key ASC NULLS FIRST, customer_key ASC NULLS FIRST, product_key ASC NULLS FIRST) AS BIGINT)
        AS return_key, order_id, order_date_key, customer_key, product_key FROM fact_returns_lines""",
    "agg_monthly_sales": f"""SELECT d.year, d.month, d.month_name,
        CAST(SUM(f.revenue) AS DECIMAL(28,9)) AS total_revenue,
        CAST(SUM(f.profit) AS DECIMAL(28,9)) AS total_profit,
        CAST(SUM(f.cost) AS DECIMAL(29,9)) AS total_cost,
        COUNT(DISTINCT f.order_id) AS total_orders,
        CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
        {_mean('f.revenue')} AS avg_line_item_value,
        {_mean('f.discount')} AS avg_discount,
        {_margin('f.profit_margin')} AS avg_profit_margin,
        CAST(SUM(f.revenue * f.discount) AS DECIMAL(33,11)) AS total_discount_amount,
        {_ratio('SUM(f.revenue)', 'COUNT(DISTINCT f.order_id)')} AS revenue_per_order,
        {_ratio('SUM(f.profit)', 'COUNT(DISTINCT f.order_id)')} AS profit_per_order
      FROM fact_sales f LEFT JOIN dim_date d ON f.order_date_key = d.date_key
      GROUP BY d.year, d.month, d.month_name""",
    "customer_sales": f"""SELECT f.customer_key, c.customer_id, c.customer_name, c.segment,
        CAST(SUM(f.revenue) AS DECIMAL(28,9)) AS lifetime_revenue,
        CAST(SUM(f.profit) AS DECIMAL(28,9)) AS lifetime_profit,
        COUNT(DISTINCT f.order_id) AS total_orders,
        CAST(SUM(f.quantity) AS BIGINT) AS total_units_purchased,
        {_mean('f.revenue')} AS avg_order_value,
        MIN(d.date) AS first_order_date, MAX(d.date) AS last_order_date,
        {_mean('f.discount')} AS avg_discount_received
      FROM fact_sales f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
      LEFT JOIN dim_date d ON f.order_date_key = d.date_key
      GROUP BY f.customer_key, c.customer_id, c.customer_name, c.segment""",
    "customer_returns": """SELECT customer_key, COUNT(DISTINCT order_id) AS total_returns
      FROM fact_returns GROUP BY customer_key""",
    "agg_customer_lifetime_value": f"""SELECT cs.customer_key, cs.customer_id, cs.customer_name, cs.segment,
        cs.lifetime_revenue, cs.lifetime_profit, cs.total_orders, cs.total_units_purchased, cs.avg_order_value,
        cs.first_order_date, cs.last_order_date, cs.avg_discount_received,
        COALESCE(cr.total_returns, 0) AS total_returns,
        {_ratio('COALESCE(cr.total_returns, 0)', 'cs.total_orders')} AS return_rate,
        CAST(cs.last_order_date - cs.first_order_date AS INTEGER) AS customer_tenure_days,
        {_TIER_CASE} AS ltv_tier
      FROM customer_sales cs LEFT JOIN customer_returns cr ON cs.customer_key = cr.customer_key""",
    "product_sales": f"""SELECT f.product_key, p.product_id, p.product_name, p.category, p.sub_category,
        CAST(SUM(f.revenue) AS DECIMAL(28,9)) AS total_revenue,
        CAST(SUM(f.profit) AS DECIMAL(28,9)) AS total_profit,
        CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
        COUNT(DISTINCT f.order_id) AS total_orders,
        {_margin('f.profit_margin')} AS avg_profit_margin,
        {_mean('f.discount')} AS avg_discount
      FROM fact_sales f LEFT JOIN dim_product p ON f.product_key = p.product_key
      GROUP BY f.product_key, p.product_id, p.product_name, p.category, p.sub_category""",
    "product_returns": """SELECT product_key, COUNT(return_key) AS total_returns
      FROM fact_returns GROUP BY product_key""",
    "agg_product_performance": """SELECT ps.*, COALESCE(pr.total_returns, 0) AS total_returns,
        CASE WHEN ps.total_orders > 0
             THEN CAST(COALESCE(pr.total_returns, 0) AS DOUBLE) / CAST(ps.total_orders AS DOUBLE)
             ELSE 0.0 END AS return_rate,
        CAST(rank() OVER (ORDER BY ps.total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank,
        CAST(rank() OVER (ORDER BY ps.total_profit DESC NULLS LAST) AS INTEGER) AS profit_rank
      FROM product_sales ps LEFT JOIN product_returns pr ON ps.product_key = pr.product_key""",
    "agg_regional_summary": f"""SELECT region, manager_name, total_revenue, total_profit, total_cost,
        total_orders, total_customers, total_units_sold, avg_profit_margin, avg_discount,
        {_ratio('total_revenue', 'total_customers')} AS revenue_per_customer,
        {_ratio('total_profit', 'total_customers')} AS profit_per_customer
      FROM (SELECT g.region, m.manager_name,
          CAST(SUM(f.revenue) AS DECIMAL(28,9)) AS total_revenue,
          CAST(SUM(f.profit) AS DECIMAL(28,9)) AS total_profit,
          CAST(SUM(f.cost) AS DECIMAL(29,9)) AS total_cost,
          COUNT(DISTINCT f.order_id) AS total_orders,
          COUNT(DISTINCT f.customer_key) AS total_customers,
          CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
          {_margin('f.profit_margin')} AS avg_profit_margin,
          {_mean('f.discount')} AS avg_discount
        FROM fact_sales f LEFT JOIN dim_geography g ON f.geography_key = g.geography_key
        LEFT JOIN dim_regional_manager m ON g.region = m.region
        GROUP BY g.region, m.manager_name) a""",
    "category_quarterly": f"""SELECT d.year, d.quarter, p.category, p.sub_category,
        CAST(SUM(f.revenue) AS DECIMAL(28,9)) AS total_revenue,
        CAST(SUM(f.profit) AS DECIMAL(28,9)) AS total_profit,
        CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
        COUNT(DISTINCT f.order_id) AS total_orders,
        {_margin('f.profit_margin')} AS avg_profit_margin
      FROM fact_sales f LEFT JOIN dim_product p ON f.product_key = p.product_key
      LEFT JOIN dim_date d ON f.order_date_key = d.date_key
      GROUP BY d.year, d.quarter, p.category, p.sub_category""",
    "agg_category_trends": f"""SELECT year, quarter, category, sub_category, total_revenue, total_profit,
        total_units_sold, total_orders, avg_profit_margin, prev_year_revenue,
        CASE WHEN prev_year_revenue IS NOT NULL
             THEN {_ratio('total_revenue - prev_year_revenue', 'prev_year_revenue')} * 100 END AS yoy_revenue_growth,
        prev_year_profit,
        CASE WHEN prev_year_profit IS NOT NULL
             THEN {_ratio('total_profit - prev_year_profit', 'prev_year_profit')} * 100 END AS yoy_profit_growth
      FROM (SELECT *,
          lag(total_revenue) OVER (PARTITION BY quarter, category, sub_category ORDER BY year ASC NULLS FIRST) AS prev_year_revenue,
          lag(total_profit) OVER (PARTITION BY quarter, category, sub_category ORDER BY year ASC NULLS FIRST) AS prev_year_profit
        FROM category_quarterly) q""",
    "shipping_groups": f"""SELECT ship_mode, ship_mode_description,
        CAST(SUM(revenue) AS DECIMAL(28,9)) AS total_revenue,
        CAST(SUM(profit) AS DECIMAL(28,9)) AS total_profit,
        COUNT(DISTINCT order_id) AS total_orders,
        CAST(SUM(quantity) AS BIGINT) AS total_units_shipped,
        {_mean('delivery_days')} AS avg_delivery_days,
        MIN(delivery_days) AS min_delivery_days, MAX(delivery_days) AS max_delivery_days,
        {_margin('profit_margin')} AS avg_profit_margin
      FROM (SELECT f.*, s.ship_mode, s.ship_mode_description,
                   CAST(sd.date - od.date AS INTEGER) AS delivery_days
            FROM fact_sales f LEFT JOIN dim_ship_mode s ON f.ship_mode_key = s.ship_mode_key
            LEFT JOIN dim_date od ON f.order_date_key = od.date_key
            LEFT JOIN dim_date sd ON f.ship_date_key = sd.date_key) j
      GROUP BY ship_mode, ship_mode_description""",
    "agg_shipping_analysis": f"""SELECT g.*,
        {_ratio('g.total_revenue', '(SELECT SUM(total_revenue) FROM shipping_groups)')} * 100 AS revenue_share_pct,
        {_ratio('g.total_orders', '(SELECT SUM(total_orders) FROM shipping_groups)')} * 100 AS order_share_pct
      FROM shipping_groups g""",
    "agg_state_performance": f"""SELECT *,
        CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS state_revenue_rank
      FROM (SELECT country, state, region, total_revenue, total_profit, total_cost, total_orders,
          total_customers, total_units_sold, avg_profit_margin, avg_discount, first_order_date, last_order_date,
          {_ratio('total_revenue', 'total_customers')} AS revenue_per_customer,
          {_ratio('total_orders', 'total_customers')} AS orders_per_customer,
          {_ratio('total_revenue', 'total_orders')} AS avg_order_value,
          CASE WHEN total_cost > 0 THEN CAST(total_profit AS DOUBLE) / CAST(total_cost AS DOUBLE) ELSE 0.0 END
            AS profit_to_cost_ratio
        FROM (SELECT g.country, g.state, g.region,
            CAST(SUM(f.revenue) AS DECIMAL(28,9)) AS total_revenue,
            CAST(SUM(f.profit) AS DECIMAL(28,9)) AS total_profit,
            CAST(SUM(f.cost) AS DECIMAL(29,9)) AS total_cost,
            COUNT(DISTINCT f.order_id) AS total_orders,
            COUNT(DISTINCT f.customer_key) AS total_customers,
            CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
            {_margin('f.profit_margin')} AS avg_profit_margin,
            {_mean('f.discount')} AS avg_discount,
            MIN(d.date) AS first_order_date, MAX(d.date) AS last_order_date
          FROM fact_sales f LEFT JOIN dim_geography g ON f.geography_key = g.geography_key
          LEFT JOIN dim_date d ON f.order_date_key = d.date_key
          GROUP BY g.country, g.state, g.region) a) b""",
}

_STAR = ["dim_customer", "dim_product", "dim_geography", "dim_ship_mode", "dim_date",
         "dim_regional_manager", "fact_sales", "fact_returns"]


def _clean(col: str) -> str:
    stripped = f"regexp_replace({col}, '^[ \\t\\n]+|[ \\t\\n]+$', '', 'g')"  # the white space that the names below hold
    return f"replace(replace(replace(replace(lower({stripped}), ' ', '_'), '-', '_'), '(', ''), ')', '')"


EXTRA_FINAL: dict[str, str] = {
    "clean_identifiers": f"""SELECT p_partkey, raw_name, raw_type, {_clean('raw_name')} AS name_identifier,
        {_clean('raw_type')} AS type_identifier FROM (SELECT p_partkey,
          concat(' ', p_name, ' (', p_brand, ')-', p_type, chr(9)) AS raw_name, concat('(', p_type, ') - ', p_size, '  ') AS raw_type
        FROM part) p""",
    "landing_dispatch": """SELECT n_name, COUNT(s_suppkey) AS suppliers, MIN(s_name) AS first_supplier
        FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_name""",
    "filter_returned": "SELECT order_id, returned FROM fx_returns WHERE returned = 'Yes'",
    "ingest_delimited_roundtrip": """SELECT order_id, order_date, ship_date, ship_mode, customer_id,
        customer_name, segment, country AS "country/region", state AS "state/province", city,
        CAST(postal_code AS INTEGER) AS postal_code, region, product_id, category, sub_category,
        product_name, CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount,
        CAST(profit AS DOUBLE) AS profit FROM fx_orders""",
    "layer_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{'DIMENSION' if t.startswith('dim_') else 'FACT'}' AS table_kind, "
        f"COUNT(*) AS row_count FROM {t}" for t in _STAR),
    "layer_health": "SELECT 'mercata_star_check' AS database, TRUE AS healthy, CAST(8 AS INTEGER) AS table_count, "
                    "CAST((" + " + ".join(f"(SELECT COUNT(*) FROM {t})" for t in _STAR) + ") AS BIGINT) AS total_rows, "
                    "CAST(NULL AS VARCHAR) AS error",
    "duplicate_lookup_keys": """
      SELECT 'dim_customer' AS dimension, customer_id AS lookup_value, COUNT(*) AS member_rows
        FROM dim_customer WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING COUNT(*) > 1
      UNION ALL
      SELECT 'dim_product', product_id, COUNT(*) FROM dim_product
        WHERE product_id IS NOT NULL GROUP BY product_id HAVING COUNT(*) > 1
      UNION ALL
      SELECT 'dim_geography', concat_ws('|', country, state, city, postal_code), COUNT(*) FROM dim_geography
        WHERE country IS NOT NULL AND state IS NOT NULL AND city IS NOT NULL AND postal_code IS NOT NULL
        GROUP BY country, state, city, postal_code HAVING COUNT(*) > 1
      UNION ALL
      SELECT 'dim_ship_mode', ship_mode, COUNT(*) FROM dim_ship_mode
        WHERE ship_mode IS NOT NULL GROUP BY ship_mode HAVING COUNT(*) > 1
      UNION ALL
      SELECT 'dim_regional_manager', region, COUNT(*) FROM dim_regional_manager
        WHERE region IS NOT NULL GROUP BY region HAVING COUNT(*) > 1""",
    "unmatched_lookups": " UNION ALL ".join(
        f"SELECT '{fact}' AS fact, '{col}' AS key_column, COUNT(*) - COUNT({col}) AS null_rows, "
        f"COUNT(*) AS total_rows FROM {fact}"
        for fact, cols in (("fact_sales", ["order_date_key", "ship_date_key", "customer_key", "product_key",
                                           "geography_key", "ship_mode_key"]),
                           ("fact_returns", ["order_date_key", "customer_key", "product_key"]))
        for col in cols),
}

QUERY_KEYS = [*_STAR, "agg_monthly_sales", "customer_sales", "customer_returns", "agg_customer_lifetime_value",
              "product_sales", "product_returns", "agg_product_performance", "agg_regional_summary",
              "category_quarterly", "agg_category_trends", "agg_shipping_analysis", "agg_state_performance"]


def oracle_queries() -> dict[str, str]:
    """DuckDB SQL for every registered query, as one WITH chain each."""
    with_clause = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    out = {k: f"{with_clause}\nSELECT * FROM {k}" for k in QUERY_KEYS}
    for k, final in EXTRA_FINAL.items():
        out[k] = f"{with_clause}\n{final}"
    return out
