"""Search for credentials, judged by who owns them across the corpus.

A candidate that many owners hold has been copied from documentation or a
tutorial; one that few owners hold may be live, in however many repositories.
Repositories are counted too, and do not take part in the verdict.
Candidates are hashed, counted by distinct repository and owner with map-side
sums, and each found place gets the verdict of its hash by a join that splits hot
hashes. Base patterns are always reported. Long mixed tokens outside them are
added where their hash belongs to few owners and looks random.

Only DataFrame functions run here. A pattern's places come from split, which
gives the text between matches, and regexp_extract_all, which gives the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattshed.llm.common import free_name, staged, table

#: Kinds of the base search in their order, with pattern, least length, and
#: the group which that length and the candidate's hash are of.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", "AKIA[A-Z0-9]+", 20, 0),
    ("hex", "[0-9a-f]+", 24, 0),
]
#: What the method adds: tokens of letters of either case and digits, of 20 characters or more.
ADDED = "mixed"
MIXED = r"[A-Za-z0-9+/_=-]++"
MIXED_LEAST = 20
KINDS = [*(k for k, *_ in BASE), ADDED]
#: A candidate that as many owners hold is an example.
EXAMPLE_OWNERS = 3
#: A live-looking candidate has as many different characters.
LEAST_VARIETY = 8
#: Words that examples are made of.
PLACEHOLDERS = "(?i)example|sample|changeme|placeholder|dummy|your[-_]?(key|token|secret|password)|x{6}|1234567"



def _places(text: Column, pattern: str) -> Column:
    """Structs (start, value) of the leftmost matches that do not overlap, in order."""
    # Patterns go in as literals, so that each is compiled once.
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(values, F.length)
    steps = F.zip_with(gaps, F.concat(F.array(F.lit(0)), sizes), lambda g, s: F.coalesce(g, F.lit(0)) + F.coalesce(s, F.lit(0)))
    ends = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda acc, step: F.struct(
            (acc["at"] + step).alias("at"), F.concat(acc["starts"], F.array(acc["at"] + step)).alias("starts")
        ),
    )["starts"]
    return F.arrays_zip(ends.alias("start"), values.alias("value"))


def _spans(text: Column, kind: str, pattern: str, least: int, group: int) -> Column:
    """Structs (start, end, kind number, value) of the matches that are long enough."""
    # A text without a match, the usual case, takes one pass of the pattern.
    probe = pattern if kind in ("assign", ADDED) else pattern[:-1] + f"{{{least if kind == 'hex' else least - 4},}}"
    held = F.when(text.rlike(probe), _places(text, pattern if kind != "hex" else probe))
    value = lambda m: F.regexp_extract(m["value"], pattern, group) if group else m["value"]
    found = F.transform(
        held,
        lambda m: F.struct(
            m["start"].alias("start"),
            (m["start"] + F.length(m["value"])).alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            value(m).alias("value"),
        ),
    )
    return F.coalesce(
        F.filter(found, lambda s: F.length(s["value"]) >= least),
        F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>"),
    )


def _mixed(text: Column) -> Column:
    """Long tokens with digits and letters of both cases."""
    found = _spans(text, ADDED, MIXED.replace("++", "{20,}+"), MIXED_LEAST, 0)
    return F.filter(
        found,
        lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]"),
    )


def candidates(docs: DataFrame, doc_id: str, text: str, repository: list[str], owner: str) -> DataFrame:
    """(doc_id, print, repository, owner, base, more): the spans found in each text.

    print tells apart different texts of one doc_id. more holds added candidates
    that overlap no base span.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.sort_array(F.concat(*[_spans(whole, *b) for b in BASE]))
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole).alias("print"),
        F.to_json(F.struct(*[F.col(c).cast("string").alias(f"r{i}") for i, c in enumerate(repository)])).alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        base.alias("base"),
        _mixed(whole).alias("tokens"),
    )
    apart = F.filter(
        "tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    return found.withColumn("more", apart).drop("tokens")


def _hashed(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, texts, repositories, owners) of each candidate; NULL counts as one owner."""
    every = found.select("repository", "owner", F.explode(F.concat("base", "more")).alias("s"))
    by_place = (
        every.select(_hashed(F.col("s.value")).alias("hash"), "repository", F.coalesce("owner", F.lit("")).alias("owner"))
        .groupBy("hash", "repository", "owner")
        .agg(F.count("*").alias("texts"))
    )
    by_owner = by_place.groupBy("hash", "owner").agg(F.sum("texts").alias("texts"), F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(
        F.sum("texts").alias("texts"), F.sum("repositories").alias("repositories"), F.count("*").alias("owners")
    )


def _looks_random(value: Column) -> Column:
    varied = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_VARIETY
    return varied & ~value.rlike(PLACEHOLDERS)


def found_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repository: list[str] | None = None,
    owner: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """(doc_id, print, base, spans, n_live, n_example) for each row of docs.

    base and spans are arrays of (start, end, kind, value, owners, live), by
    start and then kind; spans holds the base ones and the live added ones. live:
    fewer than example_owners owners hold the value and it looks random. A NULL
    text is empty. NULL lang or source is a repository or an owner of its own.
    Rows are judged for themselves; rows equal in doc_id and text come once each.
    """
    repository = repository or [c for c in ("source", "lang") if c in docs.columns]
    found = staged(candidates(docs, doc_id, text, repository, owner), "candidates")
    owners = ownership(found)
    spans = found.select("doc_id", "print", F.explode(F.concat("base", "more")).alias("s")).distinct()
    spans = spans.withColumn("hash", _hashed(F.col("s.value"))).join(owners, "hash")
    live = (F.col("owners") < example_owners) & _looks_random(F.col("s.value"))
    judged = spans.where((F.col("s.kind") != KINDS.index(ADDED)) | live).select(
        "doc_id", "print",
        F.struct("s.start", "s.kind", "s.end", "s.value", "owners", live.alias("live")).alias("s"),
    )
    by_text = judged.groupBy("doc_id", "print").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    theirs = by_text.select(F.col("doc_id").alias("d"), F.col("print").alias("p"), "spans")
    met = found.select("doc_id", "print").join(
        theirs, found["doc_id"].eqNullSafe(theirs["d"]) & (found["print"] == theirs["p"]), "left"
    )
    empty = F.array().cast(by_text.schema["spans"].dataType)
    spans_of = F.coalesce("spans", empty)
    return met.select(
        "doc_id",
        "print",
        F.filter(spans_of, lambda s: s["kind"] != KINDS.index(ADDED)).alias("base"),
        spans_of.alias("spans"),
        F.size(F.filter(spans_of, lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter(spans_of, lambda s: ~s["live"])).cast("long").alias("n_example"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "[SECRET]", **how) -> DataFrame:
    """docs with every found span replaced by mark; overlapping spans become one.

    n_chars, where there, follows. Rows and columns stay as they are otherwise.
    """
    found = found_secrets(docs, doc_id, text, **how).where(F.size("spans") > 0)
    spans, key, tag = (free_name(docs, n) for n in ("spans", "found_id", "found_print"))
    theirs = found.select(F.col("doc_id").alias(key), F.col("print").alias(tag), F.col("spans").alias(spans)).distinct()
    whole = F.coalesce(F.col(text), F.lit(""))
    met = docs.join(theirs, docs[doc_id].eqNullSafe(theirs[key]) & (F.xxhash64(whole) == theirs[tag]), "left")
    cut = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))),
    )
    new = F.when(F.col(spans).isNull(), F.col(text)).otherwise(cut)
    picked = {text: new}
    if "n_chars" in docs.columns:
        picked["n_chars"] = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(
            F.length(new).cast(docs.schema["n_chars"].dataType)
        )
    return met.select(*[picked[c].alias(c) if c in picked else docs[c] for c in docs.columns])


def op10_owned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = found_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        "n_live",
        "n_example",
    )
