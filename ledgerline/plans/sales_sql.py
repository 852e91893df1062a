"""Sales reports as SQL text over the sales tables and the fact view, run by
``sources.views.run_sql``."""

# R20 over its tables.
QUANTITY_SOLD = """
SELECT CAST(sum(product_qty) AS DOUBLE) AS qty
FROM sales_order_line JOIN sales_order USING (sales_order_id)
WHERE order_date > CAST(:after AS TIMESTAMP_NTZ) AND order_date < CAST(:before AS TIMESTAMP_NTZ)
"""

# The managers of the highest income, ties kept.
BEST_MANAGERS = """
WITH income AS (
  SELECT manager_id, sum(product_price * product_qty) AS total
  FROM sales_order_line JOIN sales_order USING (sales_order_id)
  WHERE order_date > CAST(:after AS TIMESTAMP_NTZ) AND order_date < CAST(:before AS TIMESTAMP_NTZ)
  GROUP BY manager_id)
SELECT CAST(total AS DOUBLE) AS max_income, manager_last_name, manager_first_name
FROM income JOIN manager USING (manager_id)
WHERE total = (SELECT max(total) FROM income JOIN manager USING (manager_id))
"""

# R27 over the view: at most twelve months reach the windows.
RUNNING_TOTALS = """
WITH months AS (
  SELECT trunc(sale_date, 'MM') AS sale_month, trunc(sale_date, 'QUARTER') AS sale_quarter, sum(sale_amount) AS amount
  FROM v_fact_sale
  WHERE sale_date BETWEEN CAST(:first AS TIMESTAMP_NTZ) AND CAST(:last AS TIMESTAMP_NTZ)
  GROUP BY 1, 2)
SELECT sale_month, sale_quarter, CAST(amount AS DOUBLE) AS month_sum,
       CAST(sum(amount) OVER (ORDER BY sale_month) AS DOUBLE) AS cumul_month_sum,
       CAST(sum(amount) OVER (ORDER BY sale_quarter) AS DOUBLE) AS cumul_quart_sum
FROM months
ORDER BY sale_month ASC NULLS LAST
"""
