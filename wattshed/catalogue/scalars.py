"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions import geography as geo
from ..functions import numbers as nu
from ..functions import text as tx
from ..functions.heating import SYSTEM_WORDS, with_category
from .base import query, rounded
from .inputs import grid_sql, triangle_wkb, with_ctes


@query(
    "text_slice", "SC-01",
    sql="""SELECT p_partkey, p_name[1] AS a, p_name[1:4] AS b, p_name[2:] AS c, p_name[2:5] AS d
           FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        tx.char_slice("p_name", 1, 1).alias("a"),
        tx.char_slice("p_name", 1, 4).alias("b"),
        tx.char_slice("p_name", 2).alias("c"),
        tx.char_slice("p_name", 2, 5).alias("d"),
    )


@query(
    "text_join", "SC-02",
    sql="SELECT p_partkey, p_name || '_' || nullif(p_type, 'PROMO') AS label FROM part",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.concat("p_name", F.lit("_"), F.nullif("p_type", F.lit("PROMO"))).alias("label"),
    )


@query(
    "text_case", "SC-03",
    sql="SELECT c_custkey, lower(c_mktsegment) AS low, upper(c_name) AS up FROM customer",
)
def _(t):
    return t.customer.select(
        "c_custkey", F.lower("c_mktsegment").alias("low"), F.upper("c_name").alias("up")
    )


@query(
    "text_replace", "SC-04",
    sql="""SELECT p_partkey, replace(p_name || '_' || p_name, '_', ' ') AS every,
                  regexp_replace('_' || p_name || '_x', '_', ' ') AS first_only FROM part""",
)
def _(t):
    twice = F.concat("p_name", F.lit("_"), "p_name")
    edged = F.concat(F.lit("_"), "p_name", F.lit("_x"))
    return t.part.select(
        "p_partkey",
        F.replace(twice, F.lit("_"), F.lit(" ")).alias("every"),
        tx.replace_first(edged, "_", " ").alias("first_only"),
    )


@query(
    "text_regex_replace", "SC-05",
    sql="""SELECT c_custkey, regexp_replace(c_name, '[^a-zA-Z]', '_', 'g') AS clean,
                  regexp_replace(lower(c_name) || '_note_3', '_note.*', '') AS bare FROM customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.regexp_replace("c_name", "[^a-zA-Z]", "_").alias("clean"),
        tx.strip_note(F.concat(F.lower("c_name"), F.lit("_note_3"))).alias("bare"),
    )


@query(
    "text_year_at_end", "SC-06", "UDF-04",
    sql="""SELECT o_orderkey, label, TRY_CAST(nullif(regexp_extract(label, '(\\d{4})$', 1), '')
                  AS INTEGER) AS yr FROM (
             SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'LA - Sites '
                      || CAST(year(o_orderdate) AS VARCHAR)
                    WHEN 'O' THEN 'LA - Capacity, ' || CAST(year(o_orderdate) AS VARCHAR)
                    ELSE 'Contents' END AS label FROM orders)""",
)
def _(t):
    year = F.year("o_orderdate").cast("string")
    label = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("LA - Sites "), year))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("LA - Capacity, "), year))
        .otherwise("Contents")
    )
    named = t.orders.select("o_orderkey", label.alias("label"))
    return named.withColumn("yr", d.year_from_label("label"))


@query(
    "text_regex_extract", "SC-06",
    sql="""SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2})/(\\d+)', 2), '') AS number
           FROM pages""",
)
def _(t):
    return t.pages.select(
        "page_id", tx.regex_or_null("url", r"/([a-z]{2})/(\d+)", 2).alias("number")
    )


@query(
    "text_contains", "SC-07",
    sql="""SELECT p_partkey, regexp_matches(p_name, 'ri.g|rod') AS by_pattern,
                  contains(p_name, 'plate') AS by_text FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.col("p_name").rlike("ri.g|rod").alias("by_pattern"),
        F.col("p_name").contains("plate").alias("by_text"),
    )


@query(
    "text_trim_squish", "SC-08",
    sql="""SELECT p_partkey, rtrim(p_type || '__', '_') AS trimmed,
                  trim(regexp_replace('  ' || p_name || '   ' || p_type || ' ', '\\s+', ' ', 'g'))
                      AS squished FROM part""",
)
def _(t):
    loose = F.concat(F.lit("  "), "p_name", F.lit("   "), "p_type", F.lit(" "))
    return t.part.select(
        "p_partkey",
        F.rtrim(F.concat("p_type", F.lit("__")), F.lit("_")).alias("trimmed"),
        tx.squish(loose).alias("squished"),
    )


@query(
    "text_sentence_case", "SC-09",
    sql="""SELECT p_partkey, upper(s[1]) || replace(s[2:], '_', ' ') AS kept,
                  upper(s[1]) || lower(replace(s[2:], '_', ' ')) AS lowered
           FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '_' || p_type AS s FROM part)""",
)
def _(t):
    s = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), "p_type")
    return t.part.select(
        "p_partkey",
        tx.sentence_case(s).alias("kept"),
        tx.sentence_case(s, lower_rest=True).alias("lowered"),
    )


@query(
    "text_plain_words", "SC-10",
    sql="""SELECT doc_id, CAST(length(clean) AS BIGINT) AS chars, md5(clean) AS digest FROM (
             SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\\s:]', ' ', 'g'),
                                                '\\s+', ' ', 'g')) AS clean FROM documents)""",
)
def _(t):
    clean = tx.plain_words("text")
    return t.documents.select(
        "doc_id", F.length(clean).cast("bigint").alias("chars"), F.md5(clean).alias("digest")
    )


@query(
    "cast_hard", "SC-11",
    sql="""SELECT p_partkey, CAST(CAST(p_retailprice AS VARCHAR) AS INTEGER) AS whole,
                  CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS exact FROM part""",
)
def _(t):
    text = F.col("p_retailprice").cast("string")
    return t.part.select(
        "p_partkey", nu.half_away_int(text).alias("whole"), text.cast("double").alias("exact")
    )


@query(
    "cast_lenient", "SC-12",
    sql="""SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                  ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS value FROM orders""",
)
def _(t):
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    return t.orders.select("o_orderkey", nu.lenient_cast(text).alias("value"))


@query(
    "cast_marker", "SC-13",
    sql="""SELECT l_returnflag, count(cell) AS cells,
                  count(CASE WHEN cell[1] = '[' THEN NULL ELSE cell END) AS kept,
                  round(sum(CAST(CASE WHEN cell[1] = '[' THEN NULL ELSE cell END AS DOUBLE)), 2)
                      AS value
           FROM (SELECT l_returnflag, CASE WHEN l_discount = 0 THEN '[c]'
                        WHEN l_linestatus = 'F' AND l_tax = 0 THEN '[x]' WHEN l_tax = 0.08 THEN NULL
                        ELSE CAST(l_extendedprice AS VARCHAR) END AS cell FROM lineitem)
           GROUP BY 1""",
)
def _(t):
    cell = (
        F.when(F.col("l_discount") == 0, "[c]")
        .when((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0), "[x]")
        .when(F.col("l_tax") != 0.08, F.col("l_extendedprice").cast("string"))
    )
    value = nu.marker_cast("cell")
    sums = t.lineitem.select("l_returnflag", cell.alias("cell")).groupBy("l_returnflag").agg(
        F.count("cell").alias("cells"), F.count(value).alias("kept"), F.sum(value).alias("value")
    )
    return rounded(sums, 2)


@query(
    "round_both_ways", "SC-14",
    sql="""SELECT l_linenumber, round(l_linenumber + 0.5) AS away,
                  round_even(l_linenumber + 0.5, 0) AS even, count(*) AS n
           FROM (SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem) GROUP BY ALL""",
)
def _(t):
    x = F.col("l_linenumber").cast("double")
    half = x + 0.5
    return (
        t.lineitem.select(
            x.alias("l_linenumber"),
            nu.round_half_away(half).alias("away"),
            nu.round_half_even(half).alias("even"),
        )
        .groupBy("l_linenumber", "away", "even")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "absolute_gap", "SC-15",
    sql="SELECT c_custkey, round(abs(c_acctbal - 5000), 2) AS gap FROM customer",
)
def _(t):
    return rounded(
        t.customer.select("c_custkey", nu.absolute_gap("c_acctbal", F.lit(5000)).alias("gap")), 2
    )


@query(
    "convert_units", "SC-16",
    sql="""SELECT o_orderkey, round(o_totalprice * 11.63, 4) AS gwh,
                  round(o_totalprice / 1000, 5) AS mt FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.round(nu.ktoe_to_gwh("o_totalprice"), 4).alias("gwh"),
        F.round(nu.kt_to_mt("o_totalprice"), 5).alias("mt"),
    )


@query(
    "percent_change_bases", "SC-17",
    sql="""SELECT c_custkey, round((new - old) * 100 / nullif(old, 0), 4) AS on_old,
                  round((new - old) * 100 / nullif(new, 0), 4) AS on_new
           FROM (SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS old, c_acctbal AS new
                 FROM customer)""",
)
def _(t):
    old, new = F.col("c_nationkey").cast("double"), F.col("c_acctbal")
    return rounded(
        t.customer.select(
            "c_custkey",
            nu.percent_change(old, new).alias("on_old"),
            nu.percent_change(old, new, base="new").alias("on_new"),
        )
    )


@query(
    "case_units_by_type", "SC-18",
    sql="""SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'number' WHEN 'O' THEN 'mw' END
                  AS units, count(*) AS n FROM orders GROUP BY ALL""",
)
def _(t):
    units = F.when(F.col("o_orderstatus") == "F", "number").when(
        F.col("o_orderstatus") == "O", "mw"
    )
    return t.orders.groupBy("o_orderstatus", units.alias("units")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "bucket_main_or_other", "SC-19",
    sql="""SELECT CASE WHEN nullif(p_type, 'PROMO') IN ('LARGE', 'SMALL') THEN p_type
                       ELSE 'Other' END AS class, count(*) AS n FROM part GROUP BY 1""",
)
def _(t):
    kind = nu.main_or_other(F.nullif("p_type", F.lit("PROMO")), ["LARGE", "SMALL"])
    return t.part.groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_parse_dmy", "SC-21",
    sql="""SELECT o_orderkey, strptime(day(o_orderdate) || '/' || month(o_orderdate) || '/'
                  || year(o_orderdate), '%d/%m/%Y')::DATE AS d FROM orders""",
)
def _(t):
    day, month, year = (
        f("o_orderdate").cast("string") for f in (F.dayofmonth, F.month, F.year)
    )
    return t.orders.select("o_orderkey", d.parse_dmy(F.concat_ws("/", day, month, year)).alias("d"))


@query(
    "date_parse_quarter", "SC-22",
    sql="""SELECT q, strptime(q[1:4] || '20' || q[5:6], '%b-%Y')::DATE AS quarter, count(*) AS n
           FROM (SELECT strftime(o_orderdate + INTERVAL 25 YEAR, '%b-%y') AS q FROM orders)
           GROUP BY ALL""",
)
def _(t):
    label = F.date_format(F.add_months(F.to_date("o_orderdate"), 300), "MMM-yy")
    counts = t.orders.groupBy(label.alias("q")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("quarter", d.parse_quarter("q"))


@query(
    "date_year", "SC-23",
    sql="""SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS n FROM lineitem GROUP BY 1""",
)
def _(t):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_of_timestamp", "SC-24",
    sql="""SELECT CAST(ts + INTERVAL 30 MINUTE AS DATE) AS day, count(*) AS n FROM events
           GROUP BY 1""",
)
def _(t):
    later = F.timestamp_add("MINUTE", F.lit(30), F.col("ts"))
    text = F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss")
    day = F.to_date(F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return t.events.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_month_label", "SC-25",
    sql="""SELECT strftime(o_orderdate, '%B %Y') AS month, count(*) AS n FROM orders GROUP BY 1""",
)
def _(t):
    return t.orders.groupBy(d.month_label("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "date_month_end_before", "SC-26",
    sql="""SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1999-05-10'
                  THEN last_day(DATE '1999-04-10') ELSE CAST(o_orderdate AS DATE) END AS d
           FROM orders""",
)
def _(t):
    today = F.lit("1999-05-10").cast("date")
    return t.orders.select(
        "o_orderkey", d.month_end_before(F.to_date("o_orderdate"), today).alias("d")
    )


# Clocks went back on the fourth Sunday of October until 1995, on the last one since.
@query(
    "date_settlement_calendar", "SC-27",
    sql="""WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
           s AS (SELECT day, year(day) AS y,
                        last_day(make_date(year(day), 3, 1)) AS m,
                        last_day(make_date(year(day), 10, 1)) AS o FROM days),
           n AS (SELECT day, CASE WHEN day = m - CAST(dayofweek(m) AS INTEGER) THEN 46
                                  WHEN y = 1995 AND day = DATE '1995-10-22' THEN 50
                                  WHEN y > 1995 AND day = o - CAST(dayofweek(o) AS INTEGER) THEN 50
                                  ELSE 48 END AS n FROM s)
           SELECT day, CAST(unnest(range(1, n + 1)) AS INTEGER) AS settlement_period FROM n""",
)
def _(t):
    days = t.lineitem.select(F.to_date("l_shipdate").alias("day")).distinct()
    return d.settlement_calendar(days, "day")


@query(
    "date_sortable_year", "SC-28",
    sql="""SELECT c_nationkey, substr(CAST(max(year(o_orderdate) * 10000) AS VARCHAR), 1, 4)
                  AS max_year FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def _(t):
    period = F.year("o_orderdate") * 10000
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_nationkey").agg(d.sortable_year(F.max(period)).alias("max_year"))


@query(
    "array_first_element", "SC-29",
    sql="""SELECT vec_id, round(CAST(list_extract(embedding, 1) AS DOUBLE), 6) AS first
           FROM embeddings""",
)
def _(t):
    return rounded(t.embeddings.select("vec_id", F.element_at("embedding", 1).alias("first")), 6)


@query(
    "correct_sentinel_year", "SC-30",
    sql="""SELECT CASE WHEN p_size = 1 THEN 2024 ELSE p_size END AS yr, count(*) AS n FROM part
           GROUP BY 1""",
)
def _(t):
    return t.part.groupBy(nu.correct_sentinel("p_size", 1, 2024).alias("yr")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "geo_point_swapped", "SC-32", "SC-34",
    sql="""SELECT c_custkey, c_acctbal AS y, CAST(c_nationkey AS DOUBLE) AS x FROM customer""",
)
def _(t):
    p = geo.point(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
    swapped = geo.swap_axes(F.col("p"))
    return t.customer.select("c_custkey", p.alias("p")).select(
        "c_custkey", swapped["x"].alias("x"), swapped["y"].alias("y")
    )


@query(
    "geo_ring_swapped", "SC-34",
    sql="""SELECT c_custkey, c_acctbal AS first_x, c_custkey::DOUBLE AS first_y,
                  c_acctbal + 1 AS second_x FROM customer""",
)
def _(t):
    x, y = F.col("c_custkey").cast("double"), F.col("c_acctbal")
    rings = t.customer.select(
        "c_custkey", F.array(F.array(x, y), F.array(x, y + 1)).alias("ring")
    ).withColumn("ring", geo.swap_ring_axes("ring"))
    return rings.select(
        "c_custkey",
        F.col("ring")[0][0].alias("first_x"),
        F.col("ring")[0][1].alias("first_y"),
        F.col("ring")[1][0].alias("second_x"),
    )


@query(
    "geo_grid_to_lonlat", "SC-33",
    sql=with_ctes("planning", **grid_sql("planning", "xcoordinate", "ycoordinate"))
    + "SELECT o_orderkey, round(lon, 7) AS lon, round(lat, 7) AS lat FROM placed",
)
def _(t):
    placed = geo.grid_to_lonlat(t.inputs.planning, "xcoordinate", "ycoordinate")
    return rounded(placed.select("o_orderkey", "lon", "lat"), 7)


@query(
    "geo_wkb_rings", "SC-35", "P07",
    sql="""SELECT c_custkey, CAST(4 AS INTEGER) AS corners, c_acctbal + 1 AS second_x,
                  CAST(c_nationkey AS DOUBLE) + 1 AS third_y FROM customer""",
)
def _(t):
    x, y = F.col("c_acctbal"), F.col("c_nationkey").cast("double")
    shape = triangle_wkb(x, y, x + 1, y, x, y + 1, x, y)
    rings = t.customer.select("c_custkey", geo.wkb_rings(shape).alias("rings"))
    return rings.select(
        "c_custkey",
        F.size(F.col("rings")[0]).alias("corners"),
        F.col("rings")[0][1][0].alias("second_x"),
        F.col("rings")[0][2][1].alias("third_y"),
    )


# The classifier's rules again, as SQL over text that has been lowered and cleaned.
def category_sql(text: str) -> str:
    names = list(SYSTEM_WORDS)
    shown = {
        n: f"regexp_matches({text}, '\\b(?:{'|'.join(w)})\\b')" for n, w in SYSTEM_WORDS.items()
    }
    count = " + ".join(f"CAST({s} AS INTEGER)" for s in shown.values())
    single = [n for n in names if n != "Other and unknown"]
    order = [n for n in ("Community heating scheme", "Renewable energy(including heat pumps)",
                         "Mains gas", "Electricity", "Oil") if n in single]
    whens = " ".join(f"WHEN {shown[n]} THEN '{n}'" for n in order)
    return (
        f"CASE WHEN {count} > 1 AND {shown['Renewable energy(including heat pumps)']}"
        " THEN 'Two or more(including renewable energy)'"
        f" WHEN {count} > 1 THEN 'Two or more(not including renewable energy)'"
        f" {whens} ELSE 'Other and unknown' END"
    )


@query(
    "classify_documents", "SC-36",
    sql=f"""WITH d AS (SELECT source, regexp_replace(lower(trim(regexp_replace(regexp_replace(
                 text || ' ' || CASE WHEN lang = 'en' THEN 'gas boiler' WHEN lang = 'fr'
                 THEN 'oil boiler and solar panels' ELSE 'communal system' END,
                 '[^a-zA-Z0-9\\s:]', ' ', 'g'), '\\s+', ' ', 'g'))),
                 'heat pumps? (?:(?:radiators|underfloor heating|underfloor|warm air|fan coil units?) )?electric(?:ity)?\\b',
                 'heat pump', 'g') AS words FROM documents)
            SELECT source, {category_sql("words")} AS category, count(*) AS n FROM d GROUP BY 1, 2""",
)
def _(t):
    tail = (
        F.when(F.col("lang") == "en", "gas boiler")
        .when(F.col("lang") == "fr", "oil boiler and solar panels")
        .otherwise("communal system")
    )
    described = t.documents.select("source", F.concat_ws(" ", "text", tail).alias("words"))
    return with_category(described, "words").groupBy("source", "category").agg(F.count(F.lit(1)).alias("n"))
