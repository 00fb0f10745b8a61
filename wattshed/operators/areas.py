"""Polygons: edges, a cover of grid cells, points within, and rings put together.

The plane is cut into square cells. Cells that an edge passes through are border
cells; the runs of cells between them on a grid row are wholly inside a polygon or
wholly outside. A run inside is kept as a few pieces whose lengths are powers of
SPAN, so a point looks for its own cell and for the piece of each length that would
hold it, and needs no edge. In a border cell a point is compared with the cell's
reference point, of which is known whether it is inside: each edge of the cell
between the two changes the side. Every edge of every cell is a row of its own, so
nothing holds a polygon and a cell with many edges is no heavier than its points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Pieces of runs are 1, SPAN, SPAN^2 .. cells long, LENGTHS kinds of them.
SPAN, LENGTHS = 8, 4
#: Where in its cell the reference point is: off the places that grids and corners like.
_OFF_X, _OFF_Y = 0.5023715402, 0.4961734079
#: Room for rounding when cells are dealt out; a cell more than needed does no harm.
_MARGIN = 1e-9


def polygon_edges(polygons: DataFrame, polygon_id: str, rings: str) -> DataFrame:
    """One row for each edge of each ring; a ring is an array of ``[x, y]`` pairs."""
    ring = polygons.select(polygon_id, F.explode(rings).alias("_ring"))
    return ring_edges(ring, [polygon_id], "_ring").drop("_at")


def ring_edges(rings: DataFrame, keys: list[str], points: str) -> DataFrame:
    """The keys and one row for each edge: its place from 0 as ``_at``, x1, y1, x2, y2."""
    pairs = F.arrays_zip(
        F.slice(points, 1, F.size(points) - 1).alias("a"), F.slice(points, 2, F.size(points) - 1).alias("b")
    )
    edges = rings.where(F.size(points) >= 2).select(*keys, F.posexplode(pairs).alias("_at", "_e"))
    a, b = F.col("_e.a"), F.col("_e.b")
    return edges.select(
        *keys, "_at", a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
    )


def _x_at(y: Column) -> Column:
    """Where an edge that is not level has the height y."""
    return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))


def _edge_rows(edges: DataFrame, cell: float) -> DataFrame:
    """Each edge once for each grid row that it touches."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = F.sequence(F.floor(low / cell - _MARGIN), F.floor(high / cell + _MARGIN))
    whole = edges.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null")
    return whole.withColumn("_row", F.explode(rows))


def border_edges(edges: DataFrame, cell: float) -> DataFrame:
    """Each edge once for each cell that it passes through: ``_row`` and ``_cell`` beside it."""
    rows = _edge_rows(edges, cell)
    bottom, top = F.col("_row") * cell, (F.col("_row") + 1) * cell
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    enters, leaves = _x_at(F.greatest(low, bottom)), _x_at(F.least(high, top))
    level = F.col("y1") == F.col("y2")
    # Within the ends of the edge, so that rounding cannot lead far off.
    clip = lambda x: F.greatest(F.least(x, F.greatest("x1", "x2")), F.least("x1", "x2"))
    left = F.when(level, F.least("x1", "x2")).otherwise(F.least(clip(enters), clip(leaves)))
    right = F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(clip(enters), clip(leaves)))
    cells = F.sequence(F.floor(left / cell - _MARGIN), F.floor(right / cell + _MARGIN))
    return rows.withColumn("_cell", F.explode(cells))


def _reference(cell: float) -> tuple[Column, Column]:
    return (F.col("_cell") + _OFF_X) * cell, (F.col("_row") + _OFF_Y) * cell


def cell_cover(edges: DataFrame, polygon_id: str, cell: float) -> tuple[DataFrame, DataFrame]:
    """Border cells and runs of cells between them: (border, runs), by polygon, ``_row`` and ``_cell``.

    Border cells come with their edges, a row for each, and ``inside`` tells of the
    cell's reference point. A run has its first cell, how many there are in
    ``run``, and ``inside`` of all of them. Both come out of one sweep along each
    grid row of a polygon, over the places where edges cross the reference height.
    """
    keys = [polygon_id, "_row"]
    corners = ["x1", "y1", "x2", "y2"]
    near = border_edges(edges, cell).withColumn("_x", F.col("_cell") + _OFF_X)  # in cells
    height = (F.col("_row") + _OFF_Y) * cell
    spans = (F.col("y1") > height) != (F.col("y2") > height)
    crossings = _edge_rows(edges, cell).where(spans).select(*keys, (_x_at(height) / cell).alias("_x"))
    events = near.select(*keys, "_x", "_cell", *corners).unionByName(crossings, allowMissingColumns=True)
    sweep = W.partitionBy(*keys).orderBy("_x")
    crossed = F.count(F.when(F.col("_cell").isNull(), 1))
    swept = events.repartition(*keys).withColumns(
        {
            "_here": crossed.over(sweep.rangeBetween(W.unboundedPreceding, 0)),
            # No edge passes through the cell behind, if it is the first of a run.
            "_behind": crossed.over(sweep.rangeBetween(W.unboundedPreceding, 1)),
            "_next": F.min("_cell").over(sweep.rowsBetween(1, W.unboundedFollowing)),
        }
    ).where("_cell is not null")
    border = swept.select(*keys, "_cell", *corners, (F.col("_here") % 2 == 1).alias("inside"))
    run = F.col("_next") - F.col("_cell") - 1
    runs = swept.where(run > 0).select(
        *keys, (F.col("_cell") + 1).alias("_cell"), run.alias("run"), (F.col("_behind") % 2 == 1).alias("inside")
    )
    return border, runs


def _pieces(runs: DataFrame) -> DataFrame:
    """Runs as pieces: ``_length`` (an exponent of SPAN) and ``_piece``, the cell divided by the length.

    The pieces of each length are what the run has beyond those of the next one,
    at both of its ends: at most SPAN - 1 there, and of the longest kind as many as
    are needed.
    """
    first, last = F.col("_cell"), F.col("_cell") + F.col("run")
    out = []
    for k in range(LENGTHS):
        size, more = SPAN**k, SPAN ** (k + 1)
        a, b = F.ceil(first / size), F.floor(last / size)
        # What the next length covers, in pieces of this one.
        c, d = F.ceil(first / more) * SPAN, F.floor(last / more) * SPAN
        longest = k + 1 == LENGTHS
        covered = F.lit(False) if longest else c < d
        span = lambda x, y: F.when(x < y, F.sequence(x, y - 1)).otherwise(F.array().cast("array<bigint>"))
        pieces = F.when(covered, F.concat(span(a, c), span(d, b))).otherwise(span(a, b))
        out.append(F.struct(F.lit(k).alias("_length"), pieces.alias("_p")))
    spread = runs.select("*", F.inline(F.array(*out)))
    return spread.withColumn("_piece", F.explode("_p")).drop("_p")


def points_in_polygons(
    points: DataFrame,
    x: str,
    y: str,
    polygons: DataFrame,
    polygon_id: str,
    rings: str,
    cell: float,
) -> DataFrame:
    """Inner join of points to the polygons that contain them.

    Holes and concave rings come out right, and a point on the boundary is not
    within. Rings of one polygon id count together, in one row of polygons or in
    many. ``cell`` is the size of the grid's cells: some hundredths of a polygon
    let most points pass without an edge. Points without x or y are in nothing. The
    points are read twice, for inner and for border cells; write them first if they
    are dear to make.
    """
    return points_in_edges(points, x, y, polygon_edges(polygons, polygon_id, rings), polygon_id, cell)


def points_in_edges(points: DataFrame, x: str, y: str, edges: DataFrame, polygon_id: str, cell: float) -> DataFrame:
    """The same for polygons as rows of edges."""
    border, runs = cell_cover(edges, polygon_id, cell)
    inner = _pieces(runs.where("inside")).select(polygon_id, "_row", "_length", "_piece")
    real = ~F.isnan(F.col(x)) & ~F.isnan(F.col(y))
    placed = points.where(real).withColumns({"_row": F.floor(F.col(y) / cell), "_cell": F.floor(F.col(x) / cell)})
    lengths = F.array(
        *[F.struct(F.lit(k).alias("_length"), F.floor(F.col("_cell") / SPAN**k).alias("_piece")) for k in range(LENGTHS)]
    )
    wholly = placed.select("*", F.inline(lengths)).join(inner, ["_row", "_length", "_piece"])
    names = [*points.columns, polygon_id]
    return wholly.select(*names).unionByName(_by_the_border(placed, x, y, border, polygon_id, cell).select(*names))


def _by_the_border(placed: DataFrame, x: str, y: str, border: DataFrame, polygon_id: str, cell: float) -> DataFrame:
    """Points in border cells: which side of the cell's edges they are on, counted from its reference point."""
    border = border.withColumnRenamed("inside", "_inside")
    met = placed.withColumn("_point", F.monotonically_increasing_id()).join(border, ["_row", "_cell"])
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    qx, qy = _reference(cell)

    def turn(ax, ay, bx, by, cx, cy):
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)

    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    of_point, of_reference = turn(x1, y1, x2, y2, px, py), turn(x1, y1, x2, y2, qx, qy)
    # A corner on the line between the two counts to one side of it, for both its edges.
    parted = (turn(qx, qy, px, py, x1, y1) >= 0) != (turn(qx, qy, px, py, x2, y2) >= 0)
    between = parted & ((of_point >= 0) != (of_reference >= 0))
    on_edge = (of_point == 0) & px.between(F.least(x1, x2), F.greatest(x1, x2)) & py.between(F.least(y1, y2), F.greatest(y1, y2))
    keys = ["_point", polygon_id, "_inside", *placed.columns]
    # All rows of a point stand together, so they are counted before they are shuffled.
    counted = met.groupBy(*keys).agg(F.count_if(between).alias("_turns"), F.max(on_edge).alias("_on"))
    return counted.where(~F.col("_on") & (F.col("_inside") != (F.col("_turns") % 2 == 1)))


def signed_area(points: str) -> Column:
    """Twice the area of a ring, above 0 if it runs against the clock."""
    pairs = F.arrays_zip(
        F.slice(points, 1, F.size(points) - 1).alias("a"), F.slice(points, 2, F.size(points) - 1).alias("b")
    )
    # From the first corner, so that far-off coordinates do not eat up the digits.
    x0, y0 = F.col(points)[0][0], F.col(points)[0][1]
    cross = lambda e: (e["a"][0] - x0) * (e["b"][1] - y0) - (e["b"][0] - x0) * (e["a"][1] - y0)
    total = F.aggregate(F.transform(pairs, cross), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(points) >= 2, total).otherwise(0.0)


def assemble_rings(rings: DataFrame, key: str, points: str, cell: float) -> DataFrame:
    """(key, parts): loose rings put together to polygons.

    A ring that an even number of larger rings of its key hold is a shell, any
    other a hole of the smallest ring that holds it. Shells come out against the
    clock and holes with it, parts by falling area. Rings must not cross; rings of
    no area are left out, and closed if they are open. Which ring holds which is
    found by points_in_edges, with a point of each ring and cells of size ``cell``,
    not by pairs of rings. Rows without key are one area.
    """
    closed = F.when(F.col(points)[0] == F.element_at(points, -1), F.col(points)).otherwise(
        F.concat(points, F.array(F.col(points)[0]))
    )
    named = rings.where(F.size(points) >= 3).select(F.col(key).alias("_key"), closed.alias("_points"))
    # Numbered by what it holds, so that a task that runs again names it alike.
    named = named.withColumn("_ring", F.xxhash64("_key", "_points")).withColumn("_area", signed_area("_points"))
    named = named.where("_area <> 0")
    a, b = F.col("_points")[0], F.col("_points")[1]
    probes = named.select("_key", "_ring", F.abs("_area").alias("_own"), ((a[0] + b[0]) / 2).alias("_px"), ((a[1] + b[1]) / 2).alias("_py"))
    holders = named.select("_key", F.col("_ring").alias("_holder"), F.abs("_area").alias("_size"), "_points")
    edges = ring_edges(holders.withColumn("_which", F.struct(F.col("_key").alias("k"), F.col("_holder").alias("r"), F.col("_size").alias("s"))), ["_which"], "_points")
    held = points_in_edges(probes, "_px", "_py", edges.drop("_at"), "_which", cell)
    held = held.where(F.col("_which.k").eqNullSafe(F.col("_key")) & (F.col("_which.s") > F.col("_own")))
    depth = held.groupBy("_key", "_ring").agg(
        F.count(F.lit(1)).alias("_depth"), F.min_by("_which.r", "_which.s").alias("_shell")
    )
    same = (F.col("n._ring") == F.col("d._ring")) & F.col("n._key").eqNullSafe(F.col("d._key"))
    known = named.alias("n").join(depth.alias("d"), same, "left").select(
        "n._key", "n._ring", "n._points", "n._area", F.coalesce("_depth", F.lit(0)).alias("_depth"), "_shell"
    )
    shell = F.col("_depth") % 2 == 0
    turned = F.when((F.col("_area") > 0) == shell, F.col("_points")).otherwise(F.reverse("_points"))
    owner = F.when(shell, F.col("_ring")).otherwise(F.col("_shell"))
    order = F.struct((~shell).alias("hole"), (-F.abs("_area")).alias("area"), turned.alias("points"))
    # One feature is one row, so its rings must meet.
    parts = known.groupBy("_key", owner.alias("_owner")).agg(F.sort_array(F.collect_list(order)).alias("_rings"))
    parts = parts.select("_key", F.struct(F.col("_rings")[0]["area"].alias("area"), F.col("_rings")["points"].alias("rings")).alias("_part"))
    whole = parts.groupBy("_key").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    return whole.select(F.col("_key").alias(key), F.col("_parts")["rings"].alias("parts"))
