"""Aggregates, shares, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..session import scratch_folder
from .base import query, rounded

# Line items whose quantity is missing for some of them: the groups then show
# each NULL mode. All of group (N, F) is missing, one status of R in part.
_GAPS = """SELECT l_returnflag, l_linestatus,
                  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
                       WHEN l_returnflag = 'R' AND l_tax = 0.08 THEN NULL
                       ELSE l_quantity END AS qty FROM lineitem"""


def _gaps(t):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    lost = ((flag == "N") & (status == "F")) | ((flag == "R") & (F.col("l_tax") == 0.08))
    return t.lineitem.select(
        "l_returnflag", "l_linestatus", F.when(~lost, F.col("l_quantity")).alias("qty")
    )


@query(
    "total_global", "AG-01", "SC-16",
    sql="SELECT round(sum(l_extendedprice) / 1000, 4) AS thousands FROM lineitem",
)
def _(t):
    return rounded(t.lineitem.agg((F.sum("l_extendedprice") / 1000).alias("thousands")))


for _mode, _sql in {
    "zero": "coalesce(sum(qty), 0)",
    "null": "sum(qty)",
    "poison": "CASE WHEN count(qty) = count(*) THEN sum(qty) END",
}.items():

    @query(
        f"total_by_group_{_mode}",
        "AG-03" if _mode == "poison" else "AG-02",
        "AG-07",
        sql=f"""SELECT l_returnflag, l_linestatus, CAST({_sql} AS DOUBLE) AS qty
                FROM ({_GAPS}) GROUP BY 1, 2""",
    )
    def _(t, mode=_mode):
        return _gaps(t).groupBy("l_returnflag", "l_linestatus").agg(
            ag.total("qty", mode).cast("double").alias("qty")
        )


@query(
    "total_count", "AG-04",
    sql="""SELECT nullif(p_type, 'PROMO') AS kind, count(*) AS n FROM part GROUP BY 1""",
)
def _(t):
    kinds = t.part.select(F.nullif("p_type", F.lit("PROMO")).alias("kind"))
    return ag.value_counts(kinds, "kind")


@query(
    "total_min_max", "AG-05", "SC-23",
    sql="""SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
                  CAST(max(year(o_orderdate)) AS INTEGER) AS last_year,
                  max(CAST(o_orderdate AS DATE)) AS last_day,
                  min(CAST(year(o_orderdate) AS VARCHAR)) AS first_text FROM orders""",
)
def _(t):
    yr = F.year("o_orderdate")
    return t.orders.agg(
        F.min(yr).alias("first_year"),
        F.max(yr).alias("last_year"),
        F.max(F.to_date("o_orderdate")).alias("last_day"),
        F.min(yr.cast("string")).alias("first_text"),
    )


@query(
    "total_distinct", "AG-06",
    sql="""SELECT DISTINCT regexp_replace(p_brand, '#.*', '') || p_type AS label
           FROM part ORDER BY label""",
)
def _(t):
    label = F.concat(F.regexp_replace("p_brand", "#.*", ""), F.col("p_type"))
    return t.part.select(label.alias("label")).distinct().orderBy("label")


@query(
    "total_two_keys", "AG-07",
    sql="""SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, l_returnflag,
                  round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    keyed = t.lineitem.groupBy(F.year("l_shipdate").alias("yr"), "l_returnflag")
    return rounded(keyed.agg(F.sum("l_extendedprice").alias("price")), 2)


@query(
    "share_of_total", "AG-09",
    sql="""SELECT o_orderpriority, round(sum(o_totalprice), 2) AS price,
                  round(sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 6) AS share
           FROM orders GROUP BY 1""",
)
def _(t):
    sums = t.orders.groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("price"))
    shared = ag.share_of_total(sums, "price")
    return shared.withColumns({"price": F.round("price", 2), "share": F.round("share", 6)})


@query(
    "share_within_group", "AG-10",
    sql="""SELECT c_nationkey, c_mktsegment, n,
                  round(n * 100 / sum(n) OVER (PARTITION BY c_nationkey), 4) AS pct
           FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)""",
)
def _(t):
    counts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return rounded(ag.share_within(counts, "n", ["c_nationkey"], "pct"))



def _rates(t):
    return t.lineitem.select(
        F.when(F.col("l_returnflag") != "N", F.col("l_discount") * 100).alias("rate"),
        F.when(F.col("l_tax") != 0.08, F.col("l_quantity")).alias("pop"),
    )


_RATES_SQL = """SELECT CASE WHEN l_returnflag <> 'N' THEN l_discount * 100 END AS rate,
                       CASE WHEN l_tax <> 0.08 THEN l_quantity END AS pop FROM lineitem"""


@query(
    "mean_weighted", "AG-11",
    sql=f"""SELECT round(sum(rate / 100 * pop) * 100 / sum(pop), 6) AS weighted
            FROM ({_RATES_SQL})""",
)
def _(t):
    return rounded(ag.weighted_mean(_rates(t), "rate", "pop"), 6)


@query(
    "mean_weighted_rated", "AG-11",
    sql=f"""SELECT round(sum(rate / 100 * pop) * 100
                         / sum(CASE WHEN rate IS NOT NULL THEN pop END), 6) AS weighted
            FROM ({_RATES_SQL})""",
)
def _(t):
    return rounded(ag.weighted_mean(_rates(t), "rate", "pop", require_rate=True), 6)


@query(
    "total_row", "AG-12",
    sql="""WITH s AS (SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
                      FROM customer GROUP BY 1)
           SELECT * FROM s
           UNION ALL SELECT 'Total', CAST(sum(n) AS BIGINT), round(sum(balance), 2) FROM s""",
)
def _(t):
    sums = t.customer.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    return rounded(ag.with_totals_row(sums, "c_mktsegment"), 2)


@query(
    "total_list", "AG-13",
    sql="""SELECT r_name, array_to_string(list_sort(list(DISTINCT n_name)), ',') AS nations
           FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def _(t):
    held = t.customer.select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    named = held.join(t.nation, "n_nationkey").join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    names = F.array_sort(F.collect_list("n_name"))
    return named.groupBy("r_name").agg(F.array_join(names, ",").alias("nations"))


@query(
    "total_conditional", "AG-14",
    sql="""SELECT sum(quality) FILTER (WHERE toxic = 1)::BIGINT AS toxic_quality,
                  sum(CASE WHEN toxic = 0 THEN quality END)::BIGINT AS clean_quality FROM labels""",
)
def _(t):
    return t.labels.agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("quality"))).alias("toxic_quality"),
        F.sum(F.when(F.col("toxic") == 0, F.col("quality"))).alias("clean_quality"),
    )


@query(
    "total_by_derived_class", "AG-14", "SC-18",
    sql="""SELECT CASE WHEN nullif(p_type, 'PROMO') = 'LARGE' THEN 'Fossil' ELSE 'Renewable' END
                      AS class, round(sum(p_retailprice), 2) AS price FROM part GROUP BY 1""",
)
def _(t):
    kind = F.nullif("p_type", F.lit("PROMO"))
    keyed = t.part.groupBy(F.when(kind == "LARGE", "Fossil").otherwise("Renewable").alias("class"))
    return rounded(keyed.agg(F.sum("p_retailprice").alias("price")), 2)


@query(
    "total_by_day", "AG-15", "SC-24",
    sql="""SELECT CAST(ts AS DATE) AS day, event_type, round(sum(value), 2) AS value
           FROM events GROUP BY 1, 2""",
)
def _(t):
    keyed = t.events.groupBy(F.to_date("ts").alias("day"), "event_type")
    return rounded(keyed.agg(F.sum("value").alias("value")), 2)


@query(
    "profile_columns", "AG-16",
    sql=f"""SELECT 'l_returnflag' AS "column", count(*) AS row_count,
                   count(*) FILTER (WHERE l_returnflag IS NULL) AS nulls,
                   count(l_returnflag) = 0 AS all_missing FROM ({_GAPS})
            UNION ALL SELECT 'l_linestatus', count(*),
                   count(*) FILTER (WHERE l_linestatus IS NULL), count(l_linestatus) = 0 FROM ({_GAPS})
            UNION ALL SELECT 'qty', count(*), count(*) FILTER (WHERE qty IS NULL),
                   count(qty) = 0 FROM ({_GAPS})""",
)
def _(t):
    return ag.profile(_gaps(t))


_PROFILED = ["o_orderstatus", "o_orderpriority", "o_shippriority_text"]
_PROFILE_ROWS = """SELECT year(o_orderdate) AS yr, o_orderstatus, o_orderpriority,
                          CASE WHEN o_orderstatus = 'P' THEN 'part' END AS o_shippriority_text FROM orders"""


def _dated(t):
    text = F.when(F.col("o_orderstatus") == "P", "part").alias("o_shippriority_text")
    return t.orders.select(F.year("o_orderdate").alias("yr"), "o_orderstatus", "o_orderpriority", text)


@query(
    "profile_united_from_years", "AG-16",
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
                   count({c}) = 0 AS all_missing, count(DISTINCT {c}) AS "distinct",
                   count(DISTINCT yr) AS years, CAST(min(yr) AS INTEGER) AS first_year,
                   CAST(max(yr) AS INTEGER) AS last_year FROM ({_PROFILE_ROWS})"""
        for c in _PROFILED
    ),
)
def _(t):
    """Profiles of each year, written apart, united to that of all years."""
    dated, path = _dated(t), scratch_folder(t.spark, "profiles")
    ag.profile_by(dated, "yr", _PROFILED).write.partitionBy("period").parquet(path)
    united = ag.unite_profiles(t.spark.read.parquet(path))
    return united.select(
        "column", "row_count", "nulls", "all_missing", F.col("distinct").cast("bigint").alias("distinct"),
        F.size("periods").cast("bigint").alias("years"), F.array_min("periods").alias("first_year"),
        F.array_max("periods").alias("last_year"),
    )


@query(
    "profile_frequent_values", "AG-16",
    sql=f"""WITH long AS (UNPIVOT (SELECT CAST(yr AS VARCHAR) AS yr, o_orderstatus, o_orderpriority
                                   FROM ({_PROFILE_ROWS})) ON o_orderstatus, o_orderpriority
                          INTO NAME "column" VALUE value),
            counts AS (SELECT "column", yr, value, count(*) AS n,
                              sum(count(*)) OVER (PARTITION BY "column", yr) AS given FROM long
                       GROUP BY "column", yr, value),
            kept AS (SELECT "column", value, CAST(sum(n) AS BIGINT) AS at_least,
                            sum(given // 4) AS seen FROM counts WHERE n * 4 > given
                     GROUP BY "column", value),
            whole AS (SELECT "column", sum(given) AS given, sum(given // 4) AS unseen
                      FROM (SELECT DISTINCT "column", yr, given FROM counts) GROUP BY "column")
            SELECT "column", value, at_least, CAST(at_least + unseen - seen AS BIGINT) AS at_most
            FROM kept JOIN whole USING ("column") WHERE (at_least + unseen - seen) * 4 > given""",
)
def _(t):
    parts = ag.frequent_by(_dated(t), "yr", _PROFILED[:2], most=4)
    return ag.unite_frequent(parts, most=4)


@query(
    "profile_values", "AG-16",
    sql="SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2",
)
def _(t):
    return ag.value_counts(t.documents, "lang", "source")


@query(
    "run_summary", "AG-17", "SC-20",
    sql="""SELECT count(*) AS records, min(CAST(ts AS DATE)) AS first_day,
                  max(CAST(ts AS DATE)) AS last_day, count(DISTINCT event_type) AS units,
                  round(coalesce(sum(value), 0), 2) AS total_quantity FROM events""",
)
def _(t):
    dated = t.events.withColumn("day", F.to_date("ts"))
    return rounded(ag.run_summary(dated, "day", "event_type", "value"), 2)


@query(
    "only_one_value", "AG-18",
    sql="""SELECT count(DISTINCT o_orderstatus) = 1 AS single FROM orders""",
)
def _(t):
    return ag.only_one(t.orders, "o_orderstatus")


@query(
    "ratio_of_sums", "AG-19",
    sql="""SELECT round(f * 100 / (f + o), 6) AS pct FROM (
             SELECT sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f,
                    sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o FROM orders)""",
)
def _(t):
    done = t.orders.where(F.col("o_orderstatus") == "F")
    still = t.orders.where(F.col("o_orderstatus") == "O")
    pct = ag.ratio_percent(done, "o_totalprice", still, "o_totalprice")
    return rounded(t.spark.range(1).select(pct.alias("pct")), 6)
