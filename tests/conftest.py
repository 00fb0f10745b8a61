"""One local session with a shared checkpoint folder."""

from __future__ import annotations

import pytest

from wattshed.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = session(
        "wattshed-tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            "spark.driver.memory": "8g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect


@pytest.fixture
def cells(spark):
    """Staged cells from ``{sheet: [[cell, ...], ...]}``; None is an empty cell."""

    def make(book):
        flat = [
            ("book", sheet, r, c, v)
            for sheet, grid in book.items()
            for r, line in enumerate(grid, 1)
            for c, v in enumerate(line, 1)
            if v is not None
        ]
        return spark.createDataFrame(
            flat, "workbook string, sheet string, row bigint, col int, value string"
        )

    return make
