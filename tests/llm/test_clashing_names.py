"""Columns of docs that are named like the operators' own."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattshed.llm import quality


def test_quality_takes_names_that_are_free(spark, odd_docs):
    clashing = odd_docs.withColumns(
        {c: F.lit(7) for c in ("counts_", "counts_lang", "counts_source", "Counts_Limits", "counts__lang", "limits", "measure")}
    )
    judged, name = quality.verdicts(clashing)
    assert judged.columns == [*clashing.columns, name]
    plain, plain_name = quality.verdicts(odd_docs)
    got = sorted(map(str, judged.select("doc_id", f"{name}.*").collect()))
    assert got == sorted(map(str, plain.select("doc_id", f"{plain_name}.*").collect()))
    assert quality.keep_good(clashing).columns == clashing.columns
