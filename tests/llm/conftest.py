"""Odd rows that every operator must take."""

from __future__ import annotations

import pytest

LONG = " ".join(f"w{i}" for i in range(120))


@pytest.fixture
def odd_docs(spark):
    """NULLs, empty and long texts, repeated rows, and columns whose names clash with the operators'."""
    rows = [
        (1, LONG, "en", "a", 1, "x", "y", "z", 1),
        (1, LONG, "en", "a", 1, "x", "y", "z", 1),
        (2, LONG + " tail", "en", "a", 1, "x", "y", "z", 1),
        (None, LONG, None, None, None, None, None, None, None),
        (3, None, "en", "a", 1, "x", "y", "z", 1),
        (4, "", "en", "b", 1, "x", "y", "z", 1),
        (5, "é 🙂 " * 6000, "en", "b", 1, "x", "y", "z", 1),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, counts int, kept string, places string, tag string, n_words int"
    )


@pytest.fixture
def save(tmp_path):
    """Writes a table where a query will look for it and gives the folder."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
