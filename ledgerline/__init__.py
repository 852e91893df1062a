"""ledgerline: analytic reports and ETL operators written as Spark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame; nothing is collected to
the driver except bounded metadata (a level count in the tree walk, an
"is the frontier empty" probe).  See README.md for the layout.
"""

__all__ = ["session", "schemas"]
