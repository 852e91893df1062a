"""R24 on driver-shaped tables whose order dates carry a time of day and hit
month ends (the driver tables are all at midnight): the registered query
against its DuckDB oracle on the same files.  The frame quirk of Spark's own
interval RANGE window is shown at operator level in test_operators.py; in
this report only each month's maximum survives, so it does not surface here."""

import datetime as dt
import os
import random

import duckdb
import pandas as pd

import __spark_entry__ as E


def _write_tables(folder):
    rnd = random.Random(11)
    pd.DataFrame({"r_regionkey": [0, 1], "r_name": ["EAST", "WEST"]}).astype(
        {"r_regionkey": "int32"}).to_parquet(os.path.join(folder, "region.parquet"))
    pd.DataFrame({"n_nationkey": [0, 1, 2], "n_name": ["N0", "N1", "N2"], "n_regionkey": [0, 1, 1]}).astype(
        {"n_nationkey": "int32", "n_regionkey": "int32"}).to_parquet(os.path.join(folder, "nation.parquet"))
    pd.DataFrame({"c_custkey": [1, 2, 3], "c_name": ["A", "B", "C"], "c_nationkey": [0, 1, 2],
                  "c_acctbal": [1.0, 2.0, 3.0], "c_mktsegment": ["S1", "S2", "S3"]}).astype(
        {"c_nationkey": "int32"}).to_parquet(os.path.join(folder, "customer.parquet"))
    pd.DataFrame({"p_partkey": [1, 2], "p_name": ["p1", "p2"], "p_brand": ["Brand#1", "Brand#2"],
                  "p_type": ["T", "T"], "p_size": [1, 2], "p_retailprice": [1.0, 2.0]}).astype(
        {"p_size": "int32"}).to_parquet(os.path.join(folder, "part.parquet"))
    stamps = [dt.datetime(1995, 10, 1) + dt.timedelta(days=d, hours=rnd.choice([0, 0, 13, 23]))
              for d in range(0, 455, 3)]
    stamps += [dt.datetime(1996, 2, 28), dt.datetime(1996, 3, 30, 13), dt.datetime(1996, 3, 31),
               dt.datetime(1996, 4, 30, 13), dt.datetime(1996, 5, 31)]
    orders = pd.DataFrame({"o_orderkey": range(1, len(stamps) + 1),
                           "o_custkey": [1 if i % 3 == 0 else rnd.choice([2, 3]) for i in range(len(stamps))],
                           "o_orderstatus": "O", "o_totalprice": 1.0, "o_orderdate": stamps,
                           "o_orderpriority": "1-URGENT"})
    orders.loc[len(stamps) - 5:, "o_custkey"] = 1
    orders.to_parquet(os.path.join(folder, "orders.parquet"), coerce_timestamps="us")
    lines = pd.DataFrame({"l_orderkey": list(orders.o_orderkey) * 2,
                          "l_partkey": [1] * len(orders) + [2] * len(orders),
                          "l_suppkey": 1, "l_linenumber": [1] * len(orders) + [2] * len(orders),
                          "l_quantity": [float(rnd.randint(1, 9)) for _ in range(2 * len(orders))],
                          "l_extendedprice": [float(rnd.randint(100, 9999)) / 4 for _ in range(2 * len(orders))],
                          "l_discount": 0.0, "l_tax": 0.0, "l_returnflag": "A", "l_linestatus": "O",
                          "l_shipdate": list(orders.o_orderdate) * 2}).astype({"l_linenumber": "int32"})
    lines.to_parquet(os.path.join(folder, "lineitem.parquet"), coerce_timestamps="us")


def test_r24_with_times_of_day_matches_oracle(spark, scratch_dir):
    _write_tables(scratch_dir)
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{scratch_dir}/{t}.parquet')")
    name = "r24_best_manager_bonus_first_version"
    df = E.queries()[name](spark, scratch_dir)
    rel = con.sql(E.oracle_sql()[name])
    order = [rel.columns.index(c) for c in df.columns]
    got = sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())
    want = sorted(tuple(round(float(r[i]), 6) if isinstance(r[i], float) else r[i] for i in order)
                  for r in rel.fetchall())
    assert len(got) == 12
    assert got == want
