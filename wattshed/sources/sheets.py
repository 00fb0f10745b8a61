"""Worksheets as staged cells: ``cells(workbook, sheet, row, col, value)``.

Staged as Parquet partitioned by workbook and sheet, a range is a filter and a
sheet pattern prunes partitions. Cells are long already, so the usual goal, one
row for each id and named value, needs one shuffle and no wide table. What a task
has read of a worksheet row goes through that shuffle as one row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Row number first: rows then sort on a number rather than on equal text.
ROW_KEYS = ["row", "sheet", "workbook"]
CELLS = "workbook string, sheet string, row bigint, col int, value string"


def a1_bounds(a1: str) -> tuple[int, int | None, int, int]:
    """``A5:X374`` to (first row, last row, first column, last column), from 1.

    ``A5:X`` has no last row.
    """
    m = re.fullmatch(r"([A-Z]+)(\d+):([A-Z]+)(\d*)", a1)
    if not m:
        raise ValueError(f"not an A1 range: {a1}")
    number = lambda letters: sum(
        (ord(ch) - 64) * 26**i for i, ch in enumerate(reversed(letters))
    )
    return int(m[2]), int(m[4]) if m[4] else None, number(m[1]), number(m[3])


def sheet_names(cells: DataFrame, pattern: str = "") -> DataFrame:
    return cells.where(F.col("sheet").rlike(pattern)).select("sheet").distinct()


def slice_range(cells: DataFrame, a1: str | None = None, skip: int | None = None) -> DataFrame:
    """Cells of a range, or of all rows after the first ``skip``.

    The last row of a range written for one release often cuts later ones short;
    ``skip``, and a range such as ``B7:C``, have no such end.
    """
    if a1:
        top, bottom, left, right = a1_bounds(a1)
        part = cells.where((F.col("row") >= top) & F.col("col").between(left, right))
        return part.where(F.col("row") <= bottom) if bottom else part
    return cells.where(F.col("row") > (skip or 0))


def header_name(c: Column, style: str = "plain") -> Column:
    """A header cell as a column name, by the same rules as for file headers."""
    if style == "plain":
        kept = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", ""))
        name = F.regexp_replace(kept, r"\s+", "_")
        return F.when(name.rlike("^[0-9]"), F.concat(F.lit("_"), name)).otherwise(name)
    if style == "underscore":
        return F.lower(F.regexp_replace(F.regexp_replace(c, "[^0-9A-Za-z]+", "_"), "_+$", ""))
    if style == "as_is":
        return c
    raise ValueError(f"unknown style {style}")


#: Header cells of all sheets together that are sent to every executor: some 25 MB.
MOST_HEADERS = 250_000


def header_names(
    cells: DataFrame,
    header_row: int | Column,
    style: str = "plain",
    clean: Callable[[Column], Column] | None = None,
    most: int | None = MOST_HEADERS,
    lowest: int | None = None,
) -> DataFrame:
    """(workbook, sheet, col, name) of every header cell; repeats in a sheet are numbered.

    ``lowest`` is a row that no header stands below: a number that readers can skip
    blocks by, where the header row is worked out from the sheet.

    With ``most``, the headers are taken into one task and marked for broadcast,
    and more of them than that are an error when the plan runs: no job measures
    them while it is built. Without it, they are a table like any other.
    """
    at = F.lit(header_row) if isinstance(header_row, int) else header_row
    name = header_name(F.col("value"), style)
    top = cells if lowest is None else cells.where(F.col("row") <= lowest)
    named = top.where(F.col("row") == at).select(
        "workbook", "sheet", "col", (clean(name) if clean else name).alias("name")
    )
    same = W.partitionBy("workbook", "sheet", "name").orderBy("col")
    turn = F.row_number().over(same) - 1
    final = F.when(turn > 0, F.concat("name", F.lit("_"), turn.cast("string"))).otherwise(F.col("name"))
    if most:
        # One partition from here on: the window moves nothing, and the rows are numbered from 0.
        too_many = F.raise_error(F.lit(f"more than {most} header cells: pass most_headers=None to join them"))
        final = F.when(F.monotonically_increasing_id() >= most, too_many.cast("string")).otherwise(final)
        named = named.limit(most + 1)
    return named.select("workbook", "sheet", "col", final.alias("name"))


def header_count(cells: DataFrame, header_row: int | Column) -> int:
    """How many header cells there are: one job over the rows that may hold them."""
    at = F.lit(header_row) if isinstance(header_row, int) else header_row
    return cells.where(F.col("row") == at).count()


def named_cells(
    cells: DataFrame,
    header_row: int | Column,
    style: str = "plain",
    clean: Callable[[Column], Column] | None = None,
    drop: list[str] | None = None,
    only: list[str] | None = None,
    lookup: DataFrame | None = None,
    most_headers: int | None = MOST_HEADERS,
    lowest_header: int | None = None,
) -> DataFrame:
    """(workbook, sheet, row, name, value) for the rows under the header, and the lookup's columns.

    Names are cleaned, repeats in a sheet numbered and unwanted columns left out
    among the headers, before these meet any cell; so does a ``lookup`` by
    ``name``, whose names are kept beside those of ``only``. The headers go to the
    cells, which stay where they are; with ``most_headers=None`` both are joined as
    Spark finds best, for more headers than can be sent around.
    """
    at = F.lit(header_row) if isinstance(header_row, int) else header_row
    header = header_names(cells, header_row, style, clean, most_headers, lowest_header)
    if drop:
        header = header.where(~F.col("name").isin(drop))
    if lookup is not None:
        ids = F.col("name").isin(only or [])
        given = lookup.select("*", F.lit(True).alias("_given")).where(~ids)
        header = header.join(given, "name", "left").where(ids | F.col("_given")).drop("_given")
    elif only is not None:
        header = header.where(F.col("name").isin(only))
    body = cells.where((F.col("row") > at) & F.col("value").isNotNull())
    header = F.broadcast(header) if most_headers else header
    return body.join(header, ["workbook", "sheet", "col"])


def _rows_of_cells(named: DataFrame, more: list[str]) -> DataFrame:
    """One row for each worksheet row, with its cells as structs in ``_cells``.

    What a task has read of a row is put together before it is shuffled. A list is
    added to, where maxima of text would be copied at every cell.
    """
    return named.groupBy(*ROW_KEYS).agg(F.collect_list(F.struct("name", "value", *more)).alias("_cells"))


def _value_of(name: str) -> Column:
    """The value of the cell of that name in ``_cells``, the greatest if there are several.

    Places are found in generated code. Only a row where the first such cell is not
    the last one too goes through the functions that Spark interprets.
    """
    names, values = F.col("_cells")["name"], F.col("_cells")["value"]
    first, last = F.array_position(names, name), F.array_position(F.reverse(names), name)
    several = F.filter("_cells", lambda c: c["name"] == name)
    return F.when(first + last == F.size(names) + 1, F.get(values, first.cast("int") - 1)).when(
        first > 0, F.array_max(F.transform(several, lambda c: c["value"]))
    )


def long_table(
    cells: DataFrame,
    header_row: int | Column,
    ids: list[str],
    name: str = "name",
    value: str = "value",
    drop: list[str] | None = None,
    style: str = "plain",
    clean: Callable[[Column], Column] | None = None,
    only: list[str] | None = None,
    lookup: DataFrame | None = None,
    most_headers: int | None = MOST_HEADERS,
    lowest_header: int | None = None,
    of_sheet: dict[str, Column] | None = None,
) -> DataFrame:
    """Staged cells straight to long rows: workbook, sheet, ids, ``name``, ``value``.

    A worksheet row is one small group (its cells), so the ids spread to its
    values in a single shuffle by row, each task's cells of a row together. An empty
    cell is absent, which is what dropping NULLs on unpivot means. ``only`` leaves out
    all value columns but those; ``lookup`` has a column called ``name`` and joins its
    others to each value, leaving out columns it does not know. ``of_sheet`` adds columns
    that follow from workbook and sheet, worked out for each row and not for each cell.
    """
    more: list[str] = []
    if lookup is not None:
        lookup = lookup.withColumnRenamed(name, "name")
        more = [c for c in lookup.columns if c != "name"]
        clash = {*more} & {"workbook", "sheet", "row", "value", *ids, value}
        if clash:
            raise ValueError(f"columns of the lookup clash with the table's: {sorted(clash)}")
    kept = [*ids, *(only or [])] if only is not None or lookup is not None else None
    named = named_cells(cells, header_row, style, clean, drop, kept, lookup, most_headers, lowest_header)
    sheet = of_sheet or {}
    rows = _rows_of_cells(named, more).select(
        "workbook",
        "sheet",
        *[_value_of(c).alias(f"_id_{i}") for i, c in enumerate(ids)],
        *[v.alias(f"_of_{i}") for i, v in enumerate(sheet.values())],
        "_cells",
    )
    cells, cell = rows.select("*", F.explode("_cells").alias("_cell")), F.col("_cell")
    return cells.where(~cell["name"].isin(ids)).select(
        "workbook",
        "sheet",
        *[F.col(f"_id_{i}").alias(c) for i, c in enumerate(ids)],
        cell["name"].alias(name),
        cell["value"].alias(value),
        *[cell[c].alias(c) for c in more],
        *[F.col(f"_of_{i}").alias(c) for i, c in enumerate(sheet)],
    )


def wide_table(
    cells: DataFrame,
    header_row: int | Column,
    columns: list[str],
    style: str = "plain",
    clean: Callable[[Column], Column] | None = None,
    blank_rows: bool = True,
    most_headers: int | None = MOST_HEADERS,
    lowest_header: int | None = None,
) -> DataFrame:
    """One row for each worksheet row, all text, with the named columns.

    A name that a sheet lacks is NULL there, so sheets of several years unite by
    name in the one pass. With ``blank_rows=False`` rows without a cell in any of
    the named columns are left out, and other cells are not shuffled at all. Each
    task puts its cells of a row together before they are shuffled.
    """
    only = None if blank_rows else columns
    named = named_cells(
        cells, header_row, style, clean, only=only, most_headers=most_headers, lowest_header=lowest_header
    )
    return _rows_of_cells(named, []).select(*ROW_KEYS, *[_value_of(c).alias(c) for c in columns])
