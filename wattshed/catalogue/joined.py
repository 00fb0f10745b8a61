"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as jn
from .base import query, rounded


@query(
    "join_inner_lookup", "JN-01",
    sql="""SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
           WHERE n_nationkey < 20 GROUP BY 1""",
)
def _(t):
    names = t.nation.where(F.col("n_nationkey") < 20).withColumnRenamed(
        "n_nationkey", "c_nationkey"
    )
    return t.customer.join(names, "c_nationkey").groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "join_inner_other_names", "JN-02",
    sql="""SELECT s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    named = jn.lookup(t.supplier, t.nation, {"s_nationkey": "n_nationkey"})
    return jn.lookup(named, t.region, {"n_regionkey": "r_regionkey"}).select(
        "s_name", "n_name", "r_name"
    )


@query(
    "join_composite_key", "JN-03",
    sql="""WITH a AS (SELECT c_nationkey AS nation, c_mktsegment AS seg, count(*) AS customers
                      FROM customer GROUP BY 1, 2),
                b AS (SELECT c_nationkey AS nation, c_mktsegment AS seg,
                             round(sum(o_totalprice), 2) AS price
                      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
           SELECT * FROM a JOIN b USING (nation, seg)""",
)
def _(t):
    keys = [F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg")]
    a = t.customer.groupBy(*keys).agg(F.count(F.lit(1)).alias("customers"))
    spent = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    b = spent.groupBy(*keys).agg(F.sum("o_totalprice").alias("price"))
    return rounded(a.join(b, ["nation", "seg"]), 2)


@query(
    "join_left_lookup", "JN-04",
    sql="""SELECT c_custkey, r_name FROM customer
           LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey
                      WHERE r_name <> 'ASIA') ON c_nationkey = n_nationkey""",
)
def _(t):
    placed = jn.lookup(
        t.nation, t.region.where(F.col("r_name") != "ASIA"), {"n_regionkey": "r_regionkey"}
    ).select("n_nationkey", "r_name")
    return jn.lookup(
        t.customer.select("c_custkey", "c_nationkey"), placed, {"c_nationkey": "n_nationkey"}, "keep"
    ).select("c_custkey", "r_name")


@query(
    "join_then_count", "JN-05",
    sql="""SELECT n_name, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
           JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
           GROUP BY 1, 2""",
)
def _(t):
    counted = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "p_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return jn.lookup(counted, t.nation, {"s_nationkey": "n_nationkey"}).groupBy(
        "n_name", "p_type"
    ).agg(F.sum("n").alias("n"))


@query(
    "join_array_element", "JN-06", "SC-29",
    sql="""SELECT vec_id, label, n_name FROM embeddings
           JOIN (SELECT list_extract([n_nationkey, n_regionkey], 1) AS code, n_name FROM nation)
                ON label = code""",
)
def _(t):
    names = t.nation.select(
        F.element_at(F.array("n_nationkey", "n_regionkey"), 1).alias("code"), "n_name"
    )
    return t.embeddings.join(names, F.col("label") == F.col("code")).select(
        "vec_id", "label", "n_name"
    )


# A square with a hole, and an L-shape, as rings of [x, y].
AREAS = [
    ("holed", [[[5.0, 905.0], [45.0, 905.0], [45.0, 960.0], [5.0, 960.0], [5.0, 905.0]],
               [[15.5, 920.5], [30.5, 920.5], [30.5, 940.5], [15.5, 940.5], [15.5, 920.5]]]),
    ("bent", [[[20.2, 930.2], [49.2, 930.2], [49.2, 950.2], [35.2, 950.2], [35.2, 999.2],
               [20.2, 999.2], [20.2, 930.2]]]),
]


def _edge_values() -> str:
    edges = [
        (name, *ring[i], *ring[i + 1])
        for name, rings in AREAS
        for ring in rings
        for i in range(len(ring) - 1)
    ]
    return ", ".join(f"('{n}', {a}, {b}, {c}, {d})" for n, a, b, c, d in edges)


@query(
    "join_points_in_areas", "JN-07", "SC-32",
    sql=f"""WITH e(area, x1, y1, x2, y2) AS (
                SELECT column0, column1::DOUBLE, column2::DOUBLE, column3::DOUBLE, column4::DOUBLE
                FROM (VALUES {_edge_values()}) AS v(column0, column1, column2,
                                                                       column3, column4)),
            p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part)
            SELECT p_partkey, area FROM (
              SELECT p_partkey, area,
                     sum(CASE WHEN (y1 > y) <> (y2 > y) THEN
                         CASE WHEN x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END
                         ELSE 0 END) AS crossings,
                     bool_or((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) = 0
                             AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                             AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS edge
              FROM p, e GROUP BY 1, 2)
            WHERE crossings % 2 = 1 AND NOT edge""",
)
def _(t):
    areas = t.spark.createDataFrame(AREAS, "area string, rings array<array<array<double>>>")
    points = t.part.select(
        "p_partkey", F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y")
    )
    found = jn.points_in_polygons(points, "x", "y", areas, "area", "rings", 10.0)
    return found.select("p_partkey", "area")


@query(
    "join_missing_from", "JN-08",
    sql="""SELECT c_custkey FROM customer WHERE c_custkey NOT IN
           (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999)""",
)
def _(t):
    busy = t.orders.where(F.year("o_orderdate") == 1999).select(
        F.col("o_custkey").alias("c_custkey")
    )
    return jn.missing_from(t.customer.select("c_custkey"), busy, ["c_custkey"])
