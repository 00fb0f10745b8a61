"""Quality rules with thresholds that follow each language and source.

Fixed cutoffs judge a language with long words, or a source full of tables, by
another's habits. Here every measure of a text is put into a mergeable quantile
sketch of its language and source: counts in buckets that keep the seven leading
bits of the value, so a quantile is off by less than 1/64 of itself and the sum
of two sketches is the sketch of both inputs, in any order. Sketches of sources
add up to the language's and to the whole corpus', which stand in where a
source, or a language, has too few texts of its own. A text goes if a measure
lies beyond a fence: so many middle spreads outside the quartiles.

Sketches are grouped counts with map-side sums: a hot source costs each task a
few hundred rows. Texts are read twice and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattshed.llm.common import free_name, table, with_struct
from wattshed.llm.features import COUNTS, counts
from wattshed.llm.words import chunks

#: measure: (its expression, spreads allowed, smallest spread, whether low values fail too)
MEASURES = {
    "word_length": ("word_chars * 100 div n_words", 12, 30, True),
    "symbols": ("n_symbols * 1000 div n_words", 6, 20, False),
    "dup_lines": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 6, 100, False),
    "repeats": ("n_repeat_words * 1000 div n_words", 6, 100, False),
    "capitals": ("n_upper * 1000 div greatest(n_letters, 1)", 20, 20, False),
    "shouts": ("n_shouts * 1000 div n_words", 6, 50, False),
}
#: Texts that a language-and-source, or a language, needs for fences of its own.
LEAST_TEXTS = 500

_COUNT_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def with_counts(docs: DataFrame, text: str = "text", name: str = "counts") -> DataFrame:
    """docs and a struct of COUNTS for each text. NULL and empty texts count 0."""

    def make(batch: pa.RecordBatch) -> pa.Array:
        rows = [counts(data, offsets) for _, _, data, offsets in chunks(batch.column(text))]
        rows = np.concatenate(rows) if rows else np.zeros((0, len(COUNTS)), dtype=np.int64)
        return pa.StructArray.from_arrays([pa.array(rows[:, i].astype(np.int64)) for i in range(len(COUNTS))], COUNTS)

    return with_struct(docs, name, _COUNT_TYPE, make)


def base_failed(name: str) -> Column:
    """Fewer than 50 words, or over half of them in repeated three-word windows."""
    words = F.col(f"{name}.n_words")
    return (words < 50) | (100 * F.col(f"{name}.n_repeat_words") > 50 * words)


def bucket(value: Column) -> Column:
    """The value with all but its seven leading bits cleared."""
    size = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 7, F.lit(0))).cast("long")
    return F.floor(value / size).cast("long") * size


def sketches(counted: DataFrame, lang: str = "lang", source: str = "source", name: str = "counts") -> DataFrame:
    """(lang, source, measure, bucket, n) over texts that pass the base rules."""
    kept = counted.where(~base_failed(name)).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), f"{name}.*"
    )
    measures = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(e).alias("value")) for m, (e, *_) in MEASURES.items()])
    return (
        kept.select("lang", "source", F.explode(measures).alias("m"))
        .select("lang", "source", "m.measure", bucket(F.col("m.value")).alias("bucket"))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Texts, lower and upper quartile of each measure, from the summed sketches of the keys.

    The windows run over buckets of one measure of one group, at most 64 for
    each power of two, and not over texts.
    """
    parts = [*keys, "measure"]
    summed = sketch.groupBy(*parts, "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*parts)
    ranked = summed.withColumns(
        {"upto": F.sum("n").over(whole.orderBy("bucket")), "total": F.sum("n").over(whole)}
    )
    least = lambda part: F.min(F.when(F.col("upto") * 4 >= F.col("total") * part, F.col("bucket")))
    return ranked.groupBy(*parts).agg(F.max("total").alias("texts"), least(1).alias("q1"), least(3).alias("q3"))


def fences(sketch: DataFrame, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """(lang, source, limits): lowest and highest value allowed of each measure.

    limits is a map from measure to {low, high}. A language and source with
    fewer than least_texts texts takes the fences of its language, and that of
    the corpus where the language has fewer too.
    """
    own = _quartiles(sketch, ["lang", "source"])
    lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("l_lang"), F.col("measure").alias("l_measure"),
        *[F.col(c).alias(f"l_{c}") for c in ("texts", "q1", "q3")],
    )
    corpus = _quartiles(sketch, []).select(
        F.col("measure").alias("c_measure"), *[F.col(c).alias(f"c_{c}") for c in ("q1", "q3")]
    )
    met = own.join(lang, own["lang"].eqNullSafe(lang["l_lang"]) & (own["measure"] == lang["l_measure"])).join(
        corpus, F.col("measure") == F.col("c_measure")
    )
    pick = lambda c: (
        F.when(F.col("texts") >= least_texts, F.col(c))
        .when(F.col("l_texts") >= least_texts, F.col(f"l_{c}"))
        .otherwise(F.col(f"c_{c}"))
    )
    rule = lambda i: F.create_map(*[F.lit(x) for m, r in MEASURES.items() for x in (m, int(r[i]))])[F.col("measure")]
    met = met.select("lang", "source", "measure", pick("q1").alias("q1"), pick("q3").alias("q3"))
    reach = rule(1) * F.greatest(F.col("q3") - F.col("q1"), rule(2))
    low = F.when(rule(3) == 1, F.col("q1") - reach)
    return met.groupBy("lang", "source").agg(
        F.map_from_entries(
            F.collect_list(F.struct("measure", F.struct(low.alias("low"), (F.col("q3") + reach).alias("high"))))
        ).alias("limits")
    )


def verdicts(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_texts: int = LEAST_TEXTS
) -> tuple[DataFrame, str]:
    """docs with a struct more, and its name: the counts, base_failed and kept.

    Each row gets one verdict, repeated rows and NULL keys included (NULL is a
    language or source of its own). NULL and empty texts have no words and fail
    the base rules. Columns of docs keep their names: the struct takes one that
    is free.
    """
    name = free_name(docs, "counts")
    # The fences come under names of their own, which must be free as well.
    while any(free_name(docs, f"{name}_{c}") != f"{name}_{c}" for c in ("lang", "source", "limits")):
        name = free_name(docs, f"{name}_")
    counted = with_counts(docs, text, name)
    limits = fences(sketches(counted, lang, source, name), least_texts).select(
        F.col("lang").alias(f"{name}_lang"), F.col("source").alias(f"{name}_source"), F.col("limits").alias(f"{name}_limits")
    )
    met = counted.join(
        limits,
        counted[lang].eqNullSafe(limits[f"{name}_lang"]) & counted[source].eqNullSafe(limits[f"{name}_source"]),
        "left",
    )
    inside = F.lit(True)
    for measure, (how, *_) in MEASURES.items():
        for count in COUNTS:
            how = how.replace(count, f"{name}.{count}")
        edge = F.col(f"{name}_limits")[measure]
        value = F.expr(how)
        inside &= (value <= edge["high"]) & (edge["low"].isNull() | (value >= edge["low"]))
    failed = base_failed(name)
    judged = F.struct(
        *[F.col(f"{name}.{c}") for c in COUNTS],
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(F.coalesce(inside, F.lit(True))).alias("kept"),
    )
    return met.select(*[met[c] for c in docs.columns], judged.alias(name)), name


def keep_good(docs: DataFrame, **names: str) -> DataFrame:
    """The rows of docs whose text the rules keep, with the columns of docs."""
    judged, name = verdicts(docs, **names)
    return judged.where(F.col(f"{name}.kept")).select(*docs.columns)


def op7_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged, name = verdicts(docs)
    return judged.select("doc_id", *[f"{name}.{c}" for c in [*COUNTS[:5], "base_failed", "kept"]])
