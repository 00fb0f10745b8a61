"""Boundaries, grid connections, future scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geography import wkb_parts
from ..operators import areas as ar
from ..plans import places as pl
from ..session import scratch_folder
from ..sources import records as rc
from ..sources import sinks as sk
from .base import query, rounded
from .inputs import REGION, grid_sql, triangle_wkb, with_ctes


# Squares of the areas below, by kind of area (the customer's number
# modulo 3): part, ring, corner from the area's own, size. Ring 0 is a shell.
SQUARES = [
    (0, 0, 0, 0, 0, 8), (0, 0, 1, 2, 2, 4), (1, 0, 0, 0, 0, 8), (1, 0, 1, 2, 2, 4), (1, 1, 0, 20, 1, 5),
    (1, 2, 0, 3, 3, 1), (2, 0, 0, 0, 0, 8),
]


def _square(x, y, size: int, hole: bool):
    corners = [(0, 0), (size, 0), (size, size), (0, size), (0, 0)]
    return F.array(*[F.array(x + a, y + b) for a, b in (reversed(corners) if hole else corners)])


def _areas(t):
    """An area for each customer: with a hole; with parts, one in another's hole; or plain."""
    x, y = F.col("c_acctbal"), F.col("c_nationkey") * 100.0

    def parts(kind):
        mine = [s for s in SQUARES if s[0] == kind]
        rings = lambda p: [_square(x + dx, y + dy, n, r > 0) for _, q, r, dx, dy, n in mine if q == p]
        return F.array(*[F.array(*rings(p)) for p in range(mine[-1][1] + 1)])

    kind = F.col("c_custkey") % 3
    shape = F.when(kind == 0, parts(0)).when(kind == 1, parts(1)).otherwise(parts(2))
    return t.inputs.customers.select("c_custkey", F.col("ladnm").alias("lad_name"), "c_nationkey", shape.alias("parts"))


_RING_SQL = "VALUES " + ", ".join(
    str((k, p, r, float(dx), float(dy), float(n if not r else 0), float(0 if not r else n), n))
    for k, p, r, dx, dy, n in SQUARES
)
_RINGS = f"""SELECT c_custkey, ladnm AS lad_name, CAST(part AS INTEGER) AS part, CAST(ring AS INTEGER) AS ring,
        CAST(5 AS INTEGER) AS corners, c_acctbal + dx AS first_x, (c_nationkey * 100 + dy)::DOUBLE AS first_y,
        c_acctbal + dx + right_x AS second_x, (c_nationkey * 100 + dy + up_y)::DOUBLE AS second_y
    FROM customers JOIN ({_RING_SQL}) v(kind, part, ring, dx, dy, right_x, up_y, size) ON c_custkey % 3 = kind"""
_PROPERTIES = "c_custkey bigint, lad_name string"


def _described(rings):
    first, second = F.col("points")[0], F.col("points")[1]
    return rings.select(
        "c_custkey", "lad_name", "part", "ring", F.size("points").alias("corners"),
        first[0].alias("first_x"), first[1].alias("first_y"), second[0].alias("second_x"), second[1].alias("second_y"),
    )


@query("boundaries_from_features", "P07", "SRC-09", "SNK-06", sql=with_ctes("customers") + _RINGS)
def _(t):
    """Polygons, multipolygons and holes in one set of files, a feature to a line."""
    path = scratch_folder(t.spark, "boundaries")
    sk.write_area_features(_areas(t).drop("c_nationkey"), path)
    found = rc.read_areas(t.spark, path, _PROPERTIES, collection=False)
    return _described(pl.boundaries(found, ["c_custkey", "lad_name"]))


@query("boundaries_from_collections", "P07", "SRC-09", sql=with_ctes("customers") + _RINGS)
def _(t):
    """The same as collections, one document for each nation."""
    path = scratch_folder(t.spark, "collections")
    lines = rc.to_area_features(_areas(t).drop("c_nationkey")).withColumn(
        "nation", F.get_json_object("value", "$.properties.lad_name")
    )
    features = F.array_join(F.collect_list("value"), ",")
    document = F.concat(F.lit('{"type":"FeatureCollection","features":['), features, F.lit("]}"))
    documents = lines.groupBy("nation").agg(document.alias("value"))
    documents.repartition("nation").write.partitionBy("nation").text(path)
    found = rc.read_areas(t.spark, path, _PROPERTIES)
    return _described(pl.boundaries(found, ["c_custkey", "lad_name"]))


@query("boundaries_assembled", "P07", "SNK-06", "JN-07", sql=with_ctes("customers") + _RINGS)
def _(t):
    """Loose rings, all turned the wrong way, put together, exported and read back."""
    rings = rc.rings_of(_areas(t), ["c_custkey", "lad_name"])
    key = F.struct("c_custkey", "lad_name").alias("key")
    loose = rings.select(key, F.reverse("points").alias("points"))
    whole = ar.assemble_rings(loose, "key", "points", 4.0)
    path = scratch_folder(t.spark, "assembled")
    sk.write_area_features(whole.select("key.*", "parts"), path)
    found = rc.read_areas(t.spark, path, _PROPERTIES, collection=False)
    return _described(pl.boundaries(found, ["c_custkey", "lad_name"]))


_CORNERS = [(0, 0), (9000, 0), (9000, 7000), (0, 0)]


@query(
    "boundaries_on_the_grid", "P07", "SC-33", "SC-35",
    sql=with_ctes(
        "customers",
        c="""SELECT c_custkey, spot, c_acctbal * 4 + 330000 + dx AS e, (c_nationkey * 8000.0 + 150000 + dy)::DOUBLE AS n
             FROM customers, (VALUES (0, 0, 0), (1, 9000, 0), (2, 9000, 7000), (3, 0, 0)) v(spot, dx, dy)""",
        **grid_sql("c", "e", "n"),
    )
    + """SELECT c_custkey, CAST(0 AS INTEGER) AS part, CAST(0 AS INTEGER) AS ring,
                CAST(spot AS INTEGER) AS spot, round(lon, 6) AS lon, round(lat, 6) AS lat FROM placed""",
)
def _(t):
    """Rings in WKB on the national grid, to degrees and out again corner by corner."""
    east, north = F.col("c_acctbal") * 4 + 330000, F.col("c_nationkey") * 8000.0 + 150000
    shape = triangle_wkb(*[v + d for dx, dy in _CORNERS for v, d in ((east, dx), (north, dy))])
    parts = t.inputs.customers.select("c_custkey", wkb_parts(shape)["parts"].alias("parts"))
    rings = pl.grid_rings_to_lonlat(rc.rings_of(parts, ["c_custkey"]), ["c_custkey", "part", "ring"])
    corners = rings.select("c_custkey", "part", "ring", F.posexplode("points").alias("spot", "p"))
    return rounded(
        corners.select("c_custkey", "part", "ring", "spot", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat")), 6
    )


@query(
    "connections_at_substations", "P20", "JN-02", "SC-32",
    sql="""SELECT o_orderkey, c_name AS substation_name, c_acctbal AS x,
                  CAST(c_nationkey AS DOUBLE) AS y
           FROM orders JOIN customer ON 'Customer#' || printf('%09d', o_custkey)
                = c_name""",
)
def _(t):
    site = F.concat(F.lit("Customer#"), F.format_string("%09d", F.col("o_custkey")))
    register = t.orders.select("o_orderkey", site.alias("connection_site"))
    substations = t.customer.select(
        F.col("c_name").alias("substation_name"),
        F.col("c_acctbal").alias("longitude"),
        F.col("c_nationkey").cast("double").alias("latitude"),
    )
    joined = pl.connections_at_substations(register, substations)
    return joined.select(
        "o_orderkey",
        "substation_name",
        F.col("geo_point_2d.x").alias("x"),
        F.col("geo_point_2d.y").alias("y"),
    )


def _scenarios(t):
    value = F.when(F.col("o_totalprice") < 100000, "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    year = F.when(F.col("yr") == 1995, 0).otherwise(F.col("yr"))
    raw = t.inputs.order_sites.select(
        "o_orderkey",
        F.col("ladnm").alias("local_authority"),
        F.col("o_orderpriority").alias("technology"),
        F.col("c_mktsegment").alias("subtechnology"),
        F.col("o_orderstatus").alias("scenario"),
        value.alias("value"),
        year.cast("string").alias("year"),
    )
    named = t.inputs.ca_la.select(
        F.col("ladnm").alias("lad_name"), F.array("ladcd", "cauthcd").alias("lad_code")
    )
    return pl.scenarios_with_codes(raw, named)


_CODED = """SELECT o_orderkey, ladnm AS lad_name, ladcd AS lad_code, o_orderpriority AS technology,
                   c_mktsegment AS subtechnology, o_orderstatus AS scenario,
                   CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS value,
                   CASE WHEN yr = 1995 THEN 2024 ELSE yr END AS year, cauthnm FROM order_sites"""


@query(
    "scenarios_with_codes", "P38", "JN-06", "SC-29", "SC-30",
    sql=with_ctes("order_sites", c=_CODED)
    + """SELECT lad_name, lad_code, year, count(*) AS n, count(value) AS given FROM c
         GROUP BY 1, 2, 3""",
)
def _(t):
    given = F.count_if(F.col("value") != "n/a")
    return _scenarios(t).groupBy("lad_name", "lad_code", "year").agg(
        F.count(F.lit(1)).alias("n"), given.alias("given")
    )


@query(
    "scenario_slice_in_region", "P38", "FLT-11", "SC-12",
    sql=with_ctes("order_sites", c=_CODED)
    + f"""SELECT o_orderkey, lad_name, lad_code, technology, subtechnology, scenario, value, year
          FROM c WHERE cauthnm = '{REGION}' AND scenario = 'F' AND technology = '1-URGENT'""",
)
def _(t):
    rows = pl.scenario_slice(_scenarios(t), t.inputs.authorities, "F", "1-URGENT")
    return rounded(rows, 2)
