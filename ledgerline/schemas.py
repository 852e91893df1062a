"""Explicit schemas of the reference's inputs and outputs.

Inputs are read with these schemas instead of inference: inference costs a
full pass and loses attributes absent from a slice.
"""

from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

MONEY = DecimalType(18, 2)

# Q&A XML dumps: each <row .../> attribute becomes a "_Name" column.
POSTS_XML = StructType([
    StructField("_Id", LongType()),
    StructField("_PostTypeId", IntegerType()),
    StructField("_ParentId", LongType()),
    StructField("_OwnerUserId", LongType()),
    StructField("_Score", LongType()),
    StructField("_Tags", StringType()),
])
USERS_XML = StructType([
    StructField("_Id", LongType()),
    StructField("_DisplayName", StringType()),
    StructField("_Location", StringType()),
    StructField("_AccountId", LongType()),
])
EXPERTS_XML = StructType([
    StructField("_DisplayName", StringType()),
    StructField("_AccountId", LongType()),
    StructField("_Location", StringType()),
    StructField("sum_score", LongType()),
])

# Q&A relational tables feeding the star schema.
POSTS = StructType([
    StructField("id", LongType(), False),
    StructField("posttypeid", IntegerType()),
    StructField("creationdate", TimestampNTZType()),
    StructField("viewcount", LongType()),
    StructField("score", LongType()),
    StructField("answercount", LongType()),
])
POSTTAGS = StructType([StructField("postid", LongType()), StructField("tagid", LongType())])
TAGS = StructType([StructField("id", LongType(), False), StructField("tagname", StringType())])
TAGSYNONYMS = StructType([StructField("sourcetagname", StringType()),
                          StructField("targettagname", StringType())])

DIM_DATE = StructType([
    StructField("dim_date_id", LongType(), False),
    StructField("date_val", DateType()),
    StructField("date_lvl", IntegerType()),
])
DIM_TAGS = StructType([
    StructField("dim_tag_id", LongType(), False),
    StructField("tag_name", StringType(), False),
])
FACT_QUESTIONED = StructType([
    StructField("d_date_id", LongType()),
    StructField("d_tag_id", LongType()),
    StructField("fact_id", LongType()),
    StructField("views_amount", LongType()),
    StructField("answers_amount", LongType()),
    StructField("total_amount", LongType()),
    StructField("score", LongType()),
])

# Sales schema.
SALES_ORDER = StructType([
    StructField("sales_order_id", LongType(), False),
    StructField("order_date", TimestampNTZType()),
    StructField("manager_id", LongType()),
])
SALES_ORDER_LINE = StructType([
    StructField("order_line_id", LongType()),
    StructField("sales_order_id", LongType()),
    StructField("product_id", LongType()),
    StructField("product_qty", MONEY),
    StructField("product_price", MONEY),
])
MANAGER = StructType([
    StructField("manager_id", LongType(), False),
    StructField("manager_first_name", StringType()),
    StructField("manager_last_name", StringType()),
    StructField("office_id", LongType()),
])
OFFICE = StructType([
    StructField("office_id", LongType(), False),
    StructField("office_name", StringType()),
    StructField("city_id", LongType()),
])
CITY = StructType([
    StructField("city_id", LongType(), False),
    StructField("city_name", StringType()),
    StructField("country", StringType()),
    StructField("region", StringType()),
])
PRODUCT = StructType([
    StructField("product_id", LongType(), False),
    StructField("product_name", StringType()),
])

# Hierarchy.
FILE_SYSTEM = StructType([
    StructField("id", LongType(), False),
    StructField("parent_id", LongType()),
    StructField("name", StringType()),
    StructField("type", StringType()),
    StructField("file_size", LongType()),
])
