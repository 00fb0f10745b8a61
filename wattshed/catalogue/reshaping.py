"""Unpivot, pivot, split, and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reshape as rs
from ..operators import unions as un
from .base import query, rounded


def _measures(t):
    return t.lineitem.select(
        "l_returnflag",
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax")).alias("tax"),
    )


_MEASURES = """SELECT l_returnflag, l_quantity AS quantity,
                      CASE WHEN l_discount <> 0 THEN l_discount END AS discount,
                      CASE WHEN l_linestatus = 'O' THEN l_tax END AS tax FROM lineitem"""


def _summary(long):
    return rounded(
        long.groupBy("l_returnflag", "name").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")
        ),
        2,
    )


@query(
    "unpivot_drop_nulls", "RS-01",
    sql=f"""WITH m AS ({_MEASURES})
            SELECT l_returnflag, name, count(*) AS n, round(sum(value), 2) AS value
            FROM (UNPIVOT m ON COLUMNS(* EXCLUDE (l_returnflag)) INTO NAME name VALUE value)
            GROUP BY 1, 2""",
)
def _(t):
    return _summary(rs.to_long(_measures(t), ["l_returnflag"]))


@query(
    "unpivot_keep_nulls", "RS-04",
    sql=f"""WITH m AS ({_MEASURES})
            SELECT l_returnflag, name, count(*) AS n, round(sum(value), 2) AS value
            FROM m UNPIVOT INCLUDE NULLS (value FOR name IN (quantity, discount, tax))
            GROUP BY 1, 2""",
)
def _(t):
    return _summary(rs.to_long(_measures(t), ["l_returnflag"], keep_nulls=True))


@query(
    "unpivot_matching", "RS-02",
    sql=f"""WITH m AS ({_MEASURES})
            SELECT l_returnflag, name, count(*) AS n, round(sum(value), 2) AS value
            FROM (UNPIVOT m ON COLUMNS('^[dt].*') INTO NAME name VALUE value) GROUP BY 1, 2""",
)
def _(t):
    return _summary(rs.to_long_matching(_measures(t), "^[dt].*"))


@query(
    "unpivot_every_column", "RS-03",
    sql="""WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part)
           SELECT technology, capacity FROM (UNPIVOT m ON * INTO NAME technology VALUE capacity)""",
)
def _(t):
    return rs.to_long(t.part.select("p_partkey", "p_name", "p_brand"), [], "technology", "capacity")


@query(
    "pivot_sum_by_year", "RS-05",
    sql="""SELECT o_orderpriority, """
    + ", ".join(
        f"""round(sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END), 2) AS "{y}" """
        for y in range(1995, 2002)
    )
    + " FROM orders GROUP BY 1",
)
def _(t):
    dated = t.orders.withColumn("yr", F.year("o_orderdate"))
    wide = rs.pivot_sum(dated, ["o_orderpriority"], "yr", "o_totalprice", list(range(1995, 2002)))
    return rounded(wide, 2)


@query(
    "pivot_finding_its_years", "RS-05", "P27",
    sql="""SELECT o_orderpriority, """
    + ", ".join(
        f"""round(sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END), 2) AS "{y}" """
        for y in range(1995, 2002)
    )
    + " FROM orders GROUP BY 1",
)
def _(t):
    dated = t.orders.withColumn("yr", F.year("o_orderdate"))
    return rounded(rs.pivot_found(dated, ["o_orderpriority"], "yr", "o_totalprice"), 2)


@query(
    "pivot_to_maps", "RS-05",
    sql="""SELECT c_mktsegment, c_nationkey, round(sum(c_acctbal), 2) AS total FROM customer
           WHERE c_nationkey IS NOT NULL GROUP BY 1, 2""",
)
def _(t):
    maps = rs.pivot_map(t.customer, ["c_mktsegment"], "c_nationkey", "c_acctbal")
    return rounded(maps.select("c_mktsegment", F.explode("totals").alias("c_nationkey", "total")), 2)


@query(
    "split_in_two", "RS-06",
    sql="""SELECT o_orderkey, o_orderpriority[1] AS id,
                  substr(o_orderpriority, 3) AS text FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return rs.split_in_two(rows, "o_orderpriority", "-", "id", "text").drop("o_orderpriority")


@query(
    "split_lines", "RS-06",
    sql="""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
           SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS chars
           FROM l WHERE length(line) > 0 GROUP BY 1""",
)
def _(t):
    kept = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
    chars = F.aggregate(
        F.transform(kept, lambda x: F.length(x).cast("bigint")), F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    counted = t.documents.select(
        "doc_id", F.size(kept).cast("bigint").alias("n_lines"), chars.alias("chars")
    )
    return counted.where(F.col("n_lines") > 0)


def _by_status(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return {s: rows.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")}


@query(
    "union_by_position", "ST-01",
    sql="""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
           UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
           WHERE o_orderstatus = 'F'""",
)
def _(t):
    parts = _by_status(t)
    return un.union_by_position([*parts.values(), parts["F"]])


@query(
    "union_filling", "ST-02",
    sql="""SELECT o_orderkey, o_orderstatus, o_totalprice, NULL::VARCHAR AS extra FROM orders
           WHERE o_orderstatus = 'F'
           UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'x' FROM orders
           WHERE o_orderstatus = 'O'""",
)
def _(t):
    parts = _by_status(t)
    other = parts["O"].drop("o_orderstatus").withColumn("extra", F.lit("x"))
    return un.union_filling([parts["F"], other])


@query(
    "union_strict", "ST-03",
    sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def _(t):
    return un.union_strict(list(_by_status(t).values()))


@query(
    "union_with_id", "ST-04", "PRJ-10",
    sql="""SELECT lower(o_orderstatus) AS source, count(*) AS n,
                  round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1""",
)
def _(t):
    named = {s.lower(): df for s, df in _by_status(t).items()}
    sums = un.union_with_id(named).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("price")
    )
    return rounded(sums, 2)
