"""Whole-table order, sorts, top rows, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordered as od
from ..operators import ranking as rk
from ..operators.aggregates import share_of_total
from .base import query, rounded


def _yearly(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("yr")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("price")
    )


_YEARLY = """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr,
                    round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1"""


@query(
    "change_by_year", "WN-01",
    sql=f"""SELECT yr, price, round(price - lag(price) OVER (ORDER BY yr), 4) AS change,
                   round((price - lag(price) OVER (ORDER BY yr)) * 100
                         / lag(price) OVER (ORDER BY yr), 4) AS pct_change FROM ({_YEARLY})""",
)
def _(t):
    return rounded(od.with_change(_yearly(t), "yr", "price"))


@query(
    "change_by_year_in_group", "WN-01",
    sql="""WITH s AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS yr,
                             round(sum(o_totalprice), 2) AS price
                      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
           SELECT *, round(price - lag(price) OVER w, 4) AS change,
                  round((price - lag(price) OVER w) * 100 / lag(price) OVER w, 4) AS pct_change
           FROM s WINDOW w AS (PARTITION BY c_nationkey ORDER BY yr)""",
)
def _(t):
    sums = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("yr"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("price"))
    )
    return rounded(od.with_change(sums, "yr", "price", ["c_nationkey"]))


@query(
    "change_by_order", "WN-01",
    sql="""SELECT o_orderkey, o_totalprice,
                  round(o_totalprice - lag(o_totalprice) OVER (ORDER BY o_orderkey), 2) AS change
           FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    before = od.previous_value(rows, ["o_orderkey"], "o_totalprice")
    return before.select(
        "o_orderkey",
        "o_totalprice",
        F.round(F.col("o_totalprice") - F.col("previous"), 2).alias("change"),
    )


@query(
    "running_total_by_order", "WN-02",
    sql="""SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderkey
                  ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    summed = od.running_total(rows, ["o_orderkey"], "o_totalprice")
    return rounded(summed.drop("o_totalprice"), 2)


@query(
    "running_midpoint_by_place", "WN-02", "SO-03", "SC-14",
    sql="""WITH s AS (SELECT o_orderpriority, sum(o_totalprice) AS x,
                      CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2
                           WHEN '5-LOW' THEN 3 ELSE 4 END AS place FROM orders GROUP BY 1),
                v AS (SELECT *, round(x * 1000 / (SELECT sum(x) FROM s)) AS value FROM s)
           SELECT o_orderpriority, value, sum(value) OVER (ORDER BY place, o_orderpriority
                  ROWS UNBOUNDED PRECEDING) - 0.5 * value AS midpoint FROM v""",
)
def _(t):
    sums = t.orders.groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("x"))
    shared = share_of_total(sums, "x", "value", 1000)
    place = F.coalesce(
        rk.list_position("o_orderpriority", ["3-MEDIUM", "1-URGENT", "5-LOW"]), F.lit(4)
    )
    values = shared.select(
        "o_orderpriority", F.bround("value", 0).alias("value"), place.alias("place")
    )
    out = od.display_midpoint(values, ["place", "o_orderpriority"], "value")
    return out.drop("place")


@query(
    "row_ids_of_distinct", "WN-03", "AG-06",
    sql="""SELECT label, CAST(row_number() OVER (ORDER BY label) AS BIGINT) AS id
           FROM (SELECT DISTINCT p_name || ' ' || p_brand AS label FROM part)""",
)
def _(t):
    label = F.concat("p_name", F.lit(" "), "p_brand")
    distinct = t.part.select(label.alias("label")).distinct()
    return od.row_ids(distinct, ["label"]).withColumn("id", F.col("id").cast("bigint"))


@query(
    "batches_of_hundred", "WN-04",
    sql="""WITH n AS (SELECT label, row_number() OVER (ORDER BY label) AS id
                      FROM (SELECT DISTINCT p_name || ' ' || p_brand AS label FROM part))
           SELECT CAST((id - 1) // 100 AS BIGINT) AS batch, count(*) AS n,
                  array_to_string(list_sort(list(label)), ';') AS items FROM n GROUP BY 1""",
)
def _(t):
    label = F.concat("p_name", F.lit(" "), "p_brand")
    distinct = t.part.select(label.alias("label")).distinct()
    items = F.array_join(F.array_sort(F.collect_list("label")), ";")
    return (
        od.batches(distinct, ["label"], 100)
        .groupBy("batch")
        .agg(F.count(F.lit(1)).alias("n"), items.alias("items"))
    )


@query(
    "sort_many_keys", "SO-01",
    sql="""SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2
           ORDER BY 1, 2""",
)
def _(t):
    counts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return rk.arrange(counts, "c_nationkey", "c_mktsegment")


@query(
    "sort_descending", "SO-02",
    sql="""SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1""",
)
def _(t):
    counts = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc_nulls_last("n"), "p_brand")


@query(
    "sort_by_list", "SO-03",
    sql="""SELECT o_orderpriority, count(*) AS n,
                  CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 END::BIGINT
                      AS place
           FROM orders GROUP BY 1 ORDER BY place NULLS LAST, 1""",
)
def _(t):
    order = ["5-LOW", "1-URGENT"]
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.withColumn("place", rk.list_position("o_orderpriority", order).cast("bigint"))
    return rk.arrange_by_list(placed, "o_orderpriority", order)


@query(
    "top_one_group", "SO-04",
    sql="""SELECT l_suppkey, round(sum(l_extendedprice), 2) AS price FROM lineitem
           GROUP BY 1 ORDER BY price DESC LIMIT 1""",
)
def _(t):
    sums = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("price"))
    return rounded(rk.top(sums, 1, "price"), 2)


@query(
    "top_ten_orders", "SO-05", "SO-02",
    sql="""SELECT o_orderkey, o_totalprice FROM orders
           ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10""",
)
def _(t):
    return rk.top(t.orders.select("o_orderkey", "o_totalprice"), 10, "o_totalprice", "o_orderkey")


@query(
    "bottom_ten_orders", "SO-05",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rk.bottom(rows, 10, "o_totalprice", "o_orderkey")


@query(
    "sort_category_by_count", "SO-06",
    sql="""SELECT lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY n""",
)
def _(t):
    return t.documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("n")


@query(
    "sample_ten_descriptions", "SO-07",
    sql="""SELECT p_partkey, p_name FROM part
           ORDER BY md5('7|' || CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 10""",
)
def _(t):
    return rk.repeatable_sample(t.part.select("p_partkey", "p_name"), 10, "p_partkey", seed=7)
