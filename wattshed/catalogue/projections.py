"""Projection and schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import zero_if_null
from ..functions.text import sentence_case
from ..operators import columns as co
from ..operators.aggregates import sum_columns
from .base import query, rounded


@query(
    "project_rename", "PRJ-01",
    sql="SELECT c_custkey AS customer, c_name AS name, c_acctbal * 2 AS twice FROM customer",
)
def _(t):
    return t.customer.select(
        F.col("c_custkey").alias("customer"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") * 2).alias("twice"),
    )


@query(
    "project_star_exclude", "PRJ-02",
    sql="SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders",
)
def _(t):
    return co.without(t.orders, "o_totalprice", "o_orderdate")


@query(
    "project_star_replace", "PRJ-03",
    sql="""SELECT * REPLACE (upper(p_name) AS p_name, p_size * 10 AS p_size) FROM part""",
)
def _(t):
    return co.replaced(t.part, p_name=F.upper("p_name"), p_size=F.col("p_size") * 10)


@query(
    "project_star_rename", "PRJ-04",
    sql="SELECT * EXCLUDE (s_name, s_acctbal), s_name AS name, s_acctbal AS balance FROM supplier",
)
def _(t):
    return t.supplier.withColumnsRenamed({"s_name": "name", "s_acctbal": "balance"})


_NOTED = """SELECT p_partkey, p_name AS hydro, p_type AS anaerobic_digestion_note_5_note_6,
                   p_brand AS landfill_note_1 FROM part"""


def _noted(t):
    return t.part.select(
        "p_partkey",
        F.col("p_name").alias("hydro"),
        F.col("p_type").alias("anaerobic_digestion_note_5_note_6"),
        F.col("p_brand").alias("landfill_note_1"),
    )


@query(
    "project_regex_rename", "PRJ-05",
    sql="SELECT p_type AS anaerobic_digestion, p_brand AS landfill FROM part",
)
def _(t):
    return co.select_renamed(_noted(t), "^([a-z_]+?)_note_.*$")


@query(
    "project_strip_notes", "PRJ-05", "PRJ-06",
    sql=f"""SELECT anaerobic_digestion_note_5_note_6 AS anaerobic_digestion,
                   landfill_note_1 AS landfill, p_partkey, hydro FROM ({_NOTED})""",
)
def _(t):
    return co.strip_note_suffixes(_noted(t))


@query(
    "project_names_by_test", "PRJ-06",
    sql="SELECT p_partkey, p_name AS hydro FROM part",
)
def _(t):
    df = _noted(t)
    return df.select(co.matching(df, lambda c: "_note" not in c))


@query(
    "project_by_prefix_suffix", "PRJ-07",
    sql="SELECT c_custkey, c_nationkey, c_name FROM customer",
)
def _(t):
    df = t.customer
    return df.drop(*co.starting(df, "C_ACCT"), *co.ending(df, "SEGMENT"))


@query(
    "project_remove_pattern", "PRJ-08",
    sql="""SELECT p_partkey, p_name AS hydro, p_type AS anaerobic_digestion, p_brand AS landfill
           FROM part""",
)
def _(t):
    return co.rename_removing(_noted(t), r"_note.+$")


def _messy(t):
    return t.supplier.toDF("Key (Code)", "2025 Q1", "X-coordinate", "Total: MW [note 4]")


@query(
    "project_plain_names", "PRJ-09", "SRC-02",
    sql="""SELECT s_suppkey AS key_code, s_name AS _2025_q1, s_nationkey AS xcoordinate,
                  s_acctbal AS total_mw_note_4 FROM supplier""",
)
def _(t):
    return co.normalise_columns(_messy(t), "plain")


@query(
    "project_cut_note_names", "PRJ-09",
    sql="""SELECT s_suppkey AS key_code, s_name AS "2025_q1", s_nationkey AS xcoordinate,
                  s_acctbal AS total_mw FROM supplier""",
)
def _(t):
    return co.normalise_columns(_messy(t), "cut_note")


@query(
    "project_punctuated_names", "PRJ-09",
    sql="""SELECT s_suppkey AS "key_(code)", s_name AS "2025_q1", s_nationkey AS "x-coordinate",
                  s_acctbal AS "total:_mw_[note_4]" FROM supplier""",
)
def _(t):
    return co.normalise_columns(_messy(t), "keep_punctuation")


@query(
    "project_underscore_names", "PRJ-09",
    sql="""SELECT s_suppkey AS key_code, s_name AS "2025_q1", s_nationkey AS x_coordinate,
                  s_acctbal AS total_mw_note_4 FROM supplier""",
)
def _(t):
    return co.normalise_columns(_messy(t), "underscore")


@query(
    "project_lineage", "PRJ-10",
    sql="SELECT c_custkey, 'customer' AS source, 2024 AS calendar_year FROM customer",
)
def _(t):
    return t.customer.select(
        "c_custkey", F.lit("customer").alias("source"), F.lit(2024).alias("calendar_year")
    )


@query(
    "project_positional_names", "PRJ-11",
    sql="""SELECT p_partkey AS local_authority_code, p_name AS local_authority_name,
                  p_brand AS col_0, p_type AS col_1, p_size AS col_2, p_retailprice AS col_3
           FROM part""",
)
def _(t):
    return co.positional_names(t.part, "local_authority_code", "local_authority_name")


@query(
    "project_lateral_alias", "PRJ-12",
    sql="""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(year(d) AS INTEGER) AS yr,
                  yr + 1 AS next_yr FROM orders WHERE yr >= 1997""",
)
def _(t):
    t.orders.createOrReplaceTempView("wattshed_orders")
    return t.spark.sql(
        """SELECT * FROM (
             SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, year(d) AS yr, yr + 1 AS next_yr
             FROM wattshed_orders)
           WHERE yr >= 1997"""
    )


@query(
    "project_lateral_alias_over_sum", "PRJ-12", "SC-14",
    sql="""SELECT l_returnflag, round(sum(l_quantity), 1) AS qty,
                  round(round(sum(l_quantity), 1) * 100 / (SELECT sum(l_quantity) FROM lineitem), 4)
                      AS pct FROM lineitem GROUP BY 1""",
)
def _(t):
    t.lineitem.createOrReplaceTempView("wattshed_lineitem")
    return t.spark.sql(
        """SELECT l_returnflag, round(sum(l_quantity), 1) AS qty,
                  round(qty * 100 / (SELECT sum(l_quantity) FROM wattshed_lineitem), 4) AS pct
           FROM wattshed_lineitem GROUP BY l_returnflag"""
    )


@query(
    "project_first_columns", "PRJ-13",
    sql="""SELECT c_mktsegment, c_nationkey, c_custkey, c_name, c_acctbal FROM customer""",
)
def _(t):
    return co.first_columns(t.customer, "c_mktsegment", "c_nationkey")


@query(
    "project_apply_many", "PRJ-14",
    sql="""SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
                  upper(p_type) AS p_type, p_size, p_retailprice FROM part""",
)
def _(t):
    df = t.part
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return co.apply_to(df, text, lambda c: F.upper(c))


@query(
    "project_drop_containing", "PRJ-15",
    sql="SELECT * EXCLUDE (o_totalprice) FROM orders",
)
def _(t):
    df = t.orders
    return df.drop(*co.containing(df, "TOTAL"))


@query(
    "project_parameter_column", "PRJ-16",
    sql="SELECT p_partkey, p_size AS chosen FROM part WHERE p_size > 25",
)
def _(t):
    t.part.createOrReplaceTempView("wattshed_part")
    return t.spark.sql(
        """SELECT p_partkey, IDENTIFIER(:period) AS chosen FROM wattshed_part
           WHERE IDENTIFIER(:period) > 25""",
        args={"period": "p_size"},
    )


@query(
    "project_across_sum", "PRJ-14", "PRJ-07", "AG-08",
    sql="""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, round(sum(o_totalprice), 2) AS a_total,
                  round(sum(o_totalprice * 2), 2) AS b_total FROM orders GROUP BY 1""",
)
def _(t):
    price = F.col("o_totalprice")
    wide = t.orders.select(
        F.year("o_orderdate").alias("yr"),
        price.alias("a_total"),
        (price * 2).alias("b_total"),
        price.alias("grand_total"),
    )
    names = [c for c in co.ending(wide, "total") if c != "grand_total"]
    return rounded(sum_columns(wide, ["yr"], names), 2)


@query(
    "project_null_default", "SC-20",
    sql="""SELECT p_partkey, coalesce(nullif(p_size, 50), 0) AS size FROM part""",
)
def _(t):
    return t.part.select("p_partkey", zero_if_null(F.nullif("p_size", F.lit(50))).alias("size"))


@query(
    "project_macro", "UDF-01", "SC-09",
    sql="""SELECT p_partkey, upper(p_name[1]) || replace(substr(p_name, 2), 'i', ' ') AS title
           FROM part""",
)
def _(t):
    t.part.createOrReplaceTempView("wattshed_part")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION wattshed_title(s STRING) RETURNS STRING
           RETURN upper(substring(s, 1, 1)) || replace(substring(s, 2), 'i', ' ')"""
    )
    return t.spark.sql("SELECT p_partkey, wattshed_title(p_name) AS title FROM wattshed_part")


@query(
    "project_session_variable", "UDF-02", "FLT-13", "AG-01",
    sql="""SELECT round(sum(o_totalprice), 2) AS added FROM orders
           WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) - 5 FROM orders)""",
)
def _(t):
    t.orders.createOrReplaceTempView("wattshed_orders")
    t.spark.sql("DECLARE OR REPLACE VARIABLE wattshed_start INT")
    t.spark.sql(
        "SET VAR wattshed_start = (SELECT max(year(o_orderdate)) - 5 FROM wattshed_orders)"
    )
    return t.spark.sql(
        """SELECT round(sum(o_totalprice), 2) AS added FROM wattshed_orders
           WHERE year(o_orderdate) >= wattshed_start"""
    )


@query(
    "project_sentence_names", "SC-09", "SC-03",
    sql="""SELECT c_custkey, upper(c_mktsegment[1]) || lower(substr(c_mktsegment, 2)) AS segment
           FROM customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey", sentence_case("c_mktsegment", lower_rest=True).alias("segment")
    )
