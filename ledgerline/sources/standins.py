"""The reference's input schemas, derived from the driver's TPC-H-like tables.

The reference reads Q&A dumps, a sales schema and a file-system table that
the driver does not ship.  Each function below maps driver tables onto one of
those schemas with plain projections and joins, so every report runs over the
whole driver tables and grows with them.  The DuckDB oracle defines the same
mapping in SQL (``ledgerline.plans.oracle_sql``).

Mapping (fixed rules, documented in README):
  sales_order       <- orders    (o_orderkey, o_orderdate, o_custkey as manager)
  sales_order_line  <- lineitem  (qty = l_quantity, price = l_extendedprice, decimals;
                                  id = 10 x order + line number, which the driver
                                  tables do not keep unique: s12 lists the repeats)
  manager           <- customer  (first name = c_mktsegment, last name = c_name)
  office            <- nation    ('OFFICE_' || n_name); city <- nation + region
                                  (country = r_name, region NULL where
                                   n_nationkey = n_regionkey, else 'SUB_' || r_name)
  product           <- part
  Q&A questions     <- orders; answers <- lineitem (parent = l_orderkey,
                                  owner = l_suppkey); users <- supplier + nation
  tags              <- part brands ('Brand#n' has id n); posttags <- distinct
                       (l_orderkey, brand of l_partkey); synonyms from brand numbers
  file system       <- region > nation > customer (directories) > orders (files)
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY
from .tables import read_table


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


class Tables(Mapping):
    """Tables by name, each made when it is first asked for: a report opens
    only the files it reads."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


# ---------------------------------------------------------------- sales ----
def sales_tables(spark: SparkSession, sf_dir: str) -> Tables:
    source = lambda name: _t(spark, sf_dir, name)
    return Tables({
        "sales_order": lambda: source("orders").select(
            F.col("o_orderkey").cast("long").alias("sales_order_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").cast("long").alias("manager_id")),
        "sales_order_line": lambda: source("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("order_line_id"),
            F.col("l_orderkey").cast("long").alias("sales_order_id"),
            F.col("l_partkey").cast("long").alias("product_id"),
            F.col("l_quantity").cast(MONEY).alias("product_qty"),
            F.col("l_extendedprice").cast(MONEY).alias("product_price")),
        "manager": lambda: source("customer").select(
            F.col("c_custkey").cast("long").alias("manager_id"),
            F.col("c_mktsegment").alias("manager_first_name"),
            F.col("c_name").alias("manager_last_name"),
            F.col("c_nationkey").cast("long").alias("office_id")),
        "office": lambda: source("nation").select(
            F.col("n_nationkey").cast("long").alias("office_id"),
            F.concat(F.lit("OFFICE_"), F.col("n_name")).alias("office_name"),
            F.col("n_nationkey").cast("long").alias("city_id")),
        "city": lambda: _cities(source("nation"), source("region")),
        "product": lambda: source("part").select(
            F.col("p_partkey").cast("long").alias("product_id"), F.col("p_name").alias("product_name"))})


def _cities(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("long").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("country"),
                    F.when(F.col("n_nationkey") == F.col("n_regionkey"), F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("SUB_"), F.col("r_name"))).alias("region")))


# ------------------------------------------------------- Q&A, expert job ----
def expert_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in the XML dump's shape: questions from orders (tags = order
    priority), answers from line items (parent = the order)."""
    orders = _t(spark, sf_dir, "orders")
    lineitem = _t(spark, sf_dir, "lineitem")
    questions = orders.select(
        F.col("o_orderkey").cast("long").alias("_Id"),
        F.lit(1).alias("_PostTypeId"),
        F.lit(None).cast("long").alias("_ParentId"),
        F.col("o_custkey").cast("long").alias("_OwnerUserId"),
        (F.round(F.col("o_totalprice") / 10000, 0).cast("long") - 25).alias("_Score"),
        F.col("o_orderpriority").alias("_Tags"))
    answers = lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("_Id"),
        F.lit(2).alias("_PostTypeId"),
        F.col("l_orderkey").cast("long").alias("_ParentId"),
        F.col("l_suppkey").cast("long").alias("_OwnerUserId"),
        F.round(F.col("l_quantity"), 0).cast("long").alias("_Score"),
        F.lit(None).cast("string").alias("_Tags"))
    return questions.unionByName(answers)


def expert_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _t(spark, sf_dir, "supplier")
    nation = _t(spark, sf_dir, "nation")
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
            .select(F.col("s_suppkey").cast("long").alias("_Id"),
                    F.col("s_name").alias("_DisplayName"),
                    F.col("n_name").alias("_Location"),
                    F.col("s_suppkey").cast("long").alias("_AccountId")))


# ------------------------------------------------------ Q&A, star schema ----
def _brand_number(c) -> F.Column:
    return F.substring(c, 7, 10).cast("long")


def qa_tables(spark: SparkSession, sf_dir: str) -> Tables:
    source = lambda name: _t(spark, sf_dir, name)

    def posts() -> DataFrame:
        return source("orders").select(
            F.col("o_orderkey").cast("long").alias("id"),
            F.lit(1).alias("posttypeid"),
            F.col("o_orderdate").alias("creationdate"),
            F.round(F.col("o_totalprice") / 100, 0).cast("long").alias("viewcount"),
            (F.round(F.col("o_totalprice") / 10000, 0).cast("long") - 25).alias("score"),
            F.substring("o_orderpriority", 1, 1).cast("long").alias("answercount"))

    def posttags() -> DataFrame:
        lineitem, part = source("lineitem"), source("part")
        return (lineitem.join(part, lineitem.l_partkey == part.p_partkey, "inner")
                .select(F.col("l_orderkey").cast("long").alias("postid"),
                        _brand_number(F.col("p_brand")).alias("tagid"))
                .distinct())

    def tags() -> DataFrame:
        return source("part").select(_brand_number(F.col("p_brand")).alias("id"),
                                     F.col("p_brand").alias("tagname")).distinct()

    def tagsynonyms() -> DataFrame:
        # Fixed stand-in rules: 21-25 are synonyms of 1-5; 24-25 also of 14-15
        # (a source with two targets); 19-20 point at tags that do not exist.
        n = F.col("id")
        targets = F.array(F.when(n > 20, n - 20), F.when(n > 23, n - 10), F.when(n.between(19, 20), n + 100))
        return (tags().select(F.col("tagname").alias("sourcetagname"),
                              F.explode(F.filter(targets, lambda x: x.isNotNull())).alias("_target"))
                .select("sourcetagname",
                        F.concat(F.lit("Brand#"), F.col("_target").cast("string")).alias("targettagname")))

    return Tables({"posts": posts, "posttags": posttags, "tags": tags, "tagsynonyms": tagsynonyms})


# ---------------------------------------------------------- hierarchy ----
def file_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region > nation > customer directories, orders as files sized by total
    price.  Ids are ``4 * key + kind`` so the four key spaces never collide."""
    region = _t(spark, sf_dir, "region")
    nation = _t(spark, sf_dir, "nation")
    customer = _t(spark, sf_dir, "customer")
    orders = _t(spark, sf_dir, "orders")
    nodir = F.lit(None).cast("long")
    regions = region.select((F.col("r_regionkey") * 4 + 1).cast("long").alias("id"),
                            F.lit(None).cast("long").alias("parent_id"),
                            F.col("r_name").alias("name"), F.lit("dir").alias("type"),
                            nodir.alias("file_size"))
    nations = nation.select((F.col("n_nationkey") * 4 + 2).cast("long").alias("id"),
                            (F.col("n_regionkey") * 4 + 1).cast("long").alias("parent_id"),
                            F.col("n_name").alias("name"), F.lit("dir").alias("type"),
                            nodir.alias("file_size"))
    customers = customer.select((F.col("c_custkey") * 4 + 3).cast("long").alias("id"),
                                (F.col("c_nationkey") * 4 + 2).cast("long").alias("parent_id"),
                                F.col("c_name").alias("name"), F.lit("dir").alias("type"),
                                nodir.alias("file_size"))
    files = orders.select((F.col("o_orderkey") * 4 + 4).cast("long").alias("id"),
                          (F.col("o_custkey") * 4 + 3).cast("long").alias("parent_id"),
                          F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("name"),
                          F.lit("file").alias("type"),
                          F.round(F.col("o_totalprice"), 0).cast("long").alias("file_size"))
    return regions.unionByName(nations).unionByName(customers).unionByName(files)
