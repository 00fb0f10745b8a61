"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import char_slice
from ..operators import filters as fl
from .base import query

# A part whose type is missing, for the predicates where NULL decides.
_PART_NULLS = "SELECT *, nullif(p_type, 'PROMO') AS kind FROM part"


def _part_nulls(t):
    return t.part.withColumn("kind", F.nullif("p_type", F.lit("PROMO")))


@query(
    "filter_english_authorities", "FLT-01",
    sql="""WITH a AS (SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN 'E0' ELSE 'XE0' END
                      || CAST(c_nationkey AS VARCHAR) AS code FROM customer)
           SELECT c_custkey, code FROM a WHERE code LIKE 'E0%'""",
)
def _(t):
    prefix = F.when(F.col("c_nationkey") < 20, "E0").otherwise("XE0")
    coded = t.customer.select(
        "c_custkey", F.concat(prefix, F.col("c_nationkey").cast("string")).alias("code")
    )
    return fl.english_authorities(coded)


@query(
    "filter_english_anywhere", "FLT-01",
    sql="""WITH a AS (SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'E0'
                      WHEN c_nationkey < 20 THEN 'XE0' ELSE 'W0' END
                      || CAST(c_nationkey AS VARCHAR) AS code FROM customer)
           SELECT c_custkey, code FROM a WHERE code LIKE '%E0%'""",
)
def _(t):
    prefix = (
        F.when(F.col("c_nationkey") < 10, "E0")
        .when(F.col("c_nationkey") < 20, "XE0")
        .otherwise("W0")
    )
    coded = t.customer.select(
        "c_custkey", F.concat(prefix, F.col("c_nationkey").cast("string")).alias("code")
    )
    return fl.english_authorities(coded, anywhere=True)


@query(
    "filter_like_prefix", "FLT-01",
    sql="SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'S%'",
)
def _(t):
    return t.part.where(F.col("p_type").like("S%")).select("p_partkey", "p_type")


@query(
    "filter_slice_prefix", "FLT-02",
    sql="SELECT p_partkey, p_name FROM part WHERE p_name[0:1] = 's' AND p_brand[0:2] = 'Br'",
)
def _(t):
    head = (char_slice("p_name", 0, 1) == "s") & (char_slice("p_brand", 0, 2) == "Br")
    return t.part.where(head).select("p_partkey", "p_name")


@query(
    "filter_like_any_case", "FLT-03",
    sql="SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%mo%' OR p_name ILIKE 'RED%'",
)
def _(t):
    hit = F.col("p_type").ilike("%mo%") | F.col("p_name").ilike("RED%")
    return t.part.where(hit).select("p_partkey", "p_type")


@query(
    "filter_in_list", "FLT-04",
    sql="""SELECT c_mktsegment, count(*) AS n FROM customer
           WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1""",
)
def _(t):
    chosen = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return chosen.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_and_or", "FLT-05",
    sql="""SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
           WHERE o_orderstatus <> 'P' AND (o_orderpriority = '1-URGENT'
                                           OR o_orderpriority LIKE '4%')""",
)
def _(t):
    keep = (F.col("o_orderstatus") != "P") & (
        (F.col("o_orderpriority") == "1-URGENT") | F.col("o_orderpriority").startswith("4")
    )
    return t.orders.where(keep).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "filter_not_null", "FLT-06",
    sql=f"SELECT p_partkey, kind FROM ({_PART_NULLS}) WHERE kind IS NOT NULL",
)
def _(t):
    return _part_nulls(t).where(F.col("kind").isNotNull()).select("p_partkey", "kind")


@query(
    "filter_drop_sentinel", "FLT-07",
    sql=f"SELECT p_partkey, kind FROM ({_PART_NULLS}) WHERE kind <> 'ECONOMY'",
)
def _(t):
    return _part_nulls(t).where(F.col("kind") != "ECONOMY").select("p_partkey", "kind")


@query(
    "filter_not_in_keep_null", "FLT-08",
    sql=f"""SELECT p_partkey, kind FROM ({_PART_NULLS})
            WHERE kind NOT IN ('ECONOMY', 'LARGE') OR kind IS NULL""",
)
def _(t):
    keep = fl.not_in_or_null("kind", ["ECONOMY", "LARGE"])
    return _part_nulls(t).where(keep).select("p_partkey", "kind")


@query(
    "filter_regex_include_exclude", "FLT-09",
    sql="""SELECT p_partkey, p_name FROM part
           WHERE regexp_matches(p_name, 'red.*ring|ring.*red|old.*rod')
             AND NOT regexp_matches(p_name, 'old')""",
)
def _(t):
    keep = fl.include_exclude("p_name", "red.*ring|ring.*red|old.*rod", "old")
    return t.part.where(keep).select("p_partkey", "p_name")


@query(
    "filter_starts_not", "FLT-10",
    sql="""SELECT p_type, count(*) AS n FROM part
           WHERE NOT starts_with(p_type, 'S') AND starts_with(p_brand, 'Brand#1') GROUP BY 1""",
)
def _(t):
    keep = ~F.col("p_type").startswith("S") & F.col("p_brand").startswith("Brand#1")
    return t.part.where(keep).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_members_of", "FLT-11",
    sql="""SELECT c_custkey, c_nationkey FROM customer
           WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region
                                 ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')""",
)
def _(t):
    chosen = t.nation.join(
        t.region.where(F.col("r_name") == "EUROPE"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return fl.members_of(t.customer, "c_nationkey", chosen, "n_nationkey").select(
        "c_custkey", "c_nationkey"
    )


@query(
    "filter_latest_year", "FLT-12",
    sql="""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders
           WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
)
def _(t):
    dated = t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr"))
    return fl.latest_slice(dated, "yr")


@query(
    "filter_latest_year_of_other", "FLT-12",
    sql="""SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS n FROM lineitem
           WHERE year(l_shipdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1""",
)
def _(t):
    lines = t.lineitem.select(F.year("l_shipdate").alias("yr"))
    orders = t.orders.select(F.year("o_orderdate").alias("yr"))
    return fl.latest_slice(lines, "yr", orders).groupBy("yr").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_trailing_years", "FLT-13",
    sql="""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM orders
           WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) - 3 FROM orders) GROUP BY 1""",
)
def _(t):
    dated = t.orders.select(F.year("o_orderdate").alias("yr"))
    return fl.trailing_slice(dated, "yr", 3).groupBy("yr").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_date_bound", "FLT-14",
    sql="""SELECT l_linestatus, count(*) AS n FROM lineitem
           WHERE l_shipdate <= DATE '1998-03-31' GROUP BY 1""",
)
def _(t):
    early = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-03-31").cast("timestamp_ntz"))
    return early.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "filter_positive", "FLT-15",
    sql="SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
)
def _(t):
    return t.customer.where(F.col("c_acctbal") > 0).select("c_custkey", "c_acctbal")
