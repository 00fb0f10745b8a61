"""Sources and sinks: files and tables written from the test tables, then read back.

Each query writes its whole table to a fresh folder under the shared checkpoint
folder, so readers and writers are exercised on data that grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.columns import normalise_columns
from ..plans import external as ex
from ..session import scratch_folder
from ..sources import delimited as de
from ..sources import landing as la
from ..sources import records as rc
from ..sources import sheets as sh
from ..sources import sinks as sk
from .base import query, rounded
from .inputs import with_ctes


def _landed_csv(t, df, purpose):
    path = scratch_folder(t.spark, purpose)
    sk.write_csv(df, path)
    return path


@query(
    "read_csv_typed", "SRC-01", "SNK-04",
    sql="SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def _(t):
    path = _landed_csv(t, t.customer.select("c_custkey", "c_name", "c_acctbal"), "csv")
    return de.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query(
    "read_csv_guessed", "SRC-01",
    sql="SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_acctbal FROM supplier",
)
def _(t):
    path = _landed_csv(t, t.supplier.select("s_suppkey", "s_name", "s_acctbal"), "csv")
    return de.read_csv_guessing(t.spark, path)


@query(
    "read_csv_normalised", "SRC-02", "PRJ-09",
    sql="""SELECT CAST(c_custkey AS VARCHAR) AS xcoordinate, c_name AS local_authority_name,
                  c_mktsegment AS _2025_q1 FROM customer""",
)
def _(t):
    raw = t.customer.select(
        F.col("c_custkey").alias("X-coordinate"),
        F.col("c_name").alias("Local Authority  (Name)"),
        F.col("c_mktsegment").alias("2025 Q1"),
    )
    return de.read_csv_text(t.spark, _landed_csv(t, raw, "csv"), "plain")


def _spoilt(t):
    """A customer file in which one segment's balances are not numbers."""
    balance = F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(
        F.col("c_acctbal").cast("string")
    )
    return _landed_csv(t, t.customer.select("c_custkey", balance.alias("c_acctbal")), "csv")


@query(
    "read_csv_dropping_bad_rows", "SRC-03",
    sql="SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'",
)
def _(t):
    return de.read_csv_dropping(t.spark, _spoilt(t), "c_custkey bigint, c_acctbal double")


@query(
    "read_csv_keeping_bad_rows", "SRC-04",
    sql="""SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey || ',n/a' END AS _bad_record
           FROM customer""",
)
def _(t):
    return de.read_csv_lenient(t.spark, _spoilt(t), "c_custkey bigint, c_acctbal double")


@query(
    "read_csv_all_text", "SRC-05", "SC-12",
    sql="""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
                  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal
           FROM customer""",
)
def _(t):
    df = de.read_csv_text(t.spark, _spoilt(t))
    return df.withColumn("c_acctbal", F.col("c_acctbal").try_cast("double"))


@query(
    "sheets_landed_and_staged", "SRC-06", "SRC-07", "SRC-08",
    sql="""WITH numbered AS (
               SELECT CAST(year(o_orderdate) AS VARCHAR) AS sheet, 'order ' || o_orderkey AS a,
                      'say "' || o_orderpriority || '",' || chr(10) || o_orderstatus AS b,
                      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS c,
                      3 + row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS row
               FROM orders
               UNION ALL BY NAME SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS sheet,
                      'Orders, by year' AS a, 1 AS row FROM orders
               UNION ALL BY NAME SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS sheet,
                      'Order' AS a, 'Priority ' || chr(10) || '[Note 5]' AS b, 'Customer' AS c, 3 AS row
               FROM orders)
           SELECT 'orders book' AS workbook, sheet, row, CAST(col AS INTEGER) AS col, value
           FROM (SELECT sheet, row, unnest([1, 2, 3]) AS col, unnest([a, b, c]) AS value FROM numbered)
           WHERE value IS NOT NULL""",
)
def _(t):
    """Sheets of titles, blank rows, headers and cells with line breaks, landed and staged again."""
    sheet = F.year("o_orderdate").cast("string").alias("sheet")
    body = t.orders.select(
        sheet,
        (F.col("o_orderkey") + 4).alias("at"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("a"),
        F.concat(F.lit('say "'), "o_orderpriority", F.lit('",\n'), "o_orderstatus").alias("b"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("c"),
    )
    top = [(1, "Orders, by year", None, None), (2, None, None, None), (3, "Order", "Priority \n[Note 5]", "Customer")]
    heads = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("at", "a", "b", "c"), r, strict=True)]) for r in top])
    rows = body.unionByName(t.orders.select(sheet).distinct().select("sheet", F.inline(heads)))
    folder = scratch_folder(t.spark, "landed-sheets")
    la.land_sheets(rows.withColumn("workbook", F.lit("orders book")), folder, ["at"], ["a", "b", "c"])
    return la.landed_cells(t.spark, folder)


@query(
    "read_sheet_range_long", "SRC-06", "SRC-08", "RS-01",
    sql=with_ctes("energy_long")
    + """SELECT code, calendar_year AS yr, fuel_sector, count(*) AS cells,
                count(ktoe) AS kept FROM energy_long GROUP BY 1, 2, 3""",
)
def _(t):
    cells = sh.slice_range(t.inputs.energy_cells, skip=5)
    long = sh.long_table(
        cells, 6, ["code"], "fuel_sector", "cell",
        drop=["country_or_region", "local_authority", "notes"],
        clean=lambda c: F.regexp_replace(c, "_note.*", ""),
    )
    keyed = long.groupBy("code", F.col("sheet").cast("int").alias("yr"), "fuel_sector")
    kept = F.count(F.when(~F.col("cell").startswith("["), 1))
    return keyed.agg(F.count(F.lit(1)).alias("cells"), kept.alias("kept"))


@query(
    "read_sheet_range_wide", "SRC-06", "SRC-08",
    sql=with_ctes("order_sites")
    + """SELECT yr, ladcd AS code, ladnm AS local_authority,
                round(sum(o_totalprice), 2) AS all_fuels_total FROM order_sites GROUP BY 1, 2, 3""",
)
def _(t):
    cells = sh.slice_range(t.inputs.energy_cells, skip=5)
    wide = sh.wide_table(cells, 6, ["code", "local_authority", "all_fuels_total"])
    keyed = wide.groupBy(F.col("sheet").cast("int").alias("yr"), "code", "local_authority")
    total = F.sum(F.col("all_fuels_total").cast("double"))
    return rounded(keyed.agg(total.alias("all_fuels_total")), 2)


@query(
    "read_sheet_range_columns", "SRC-06",
    sql=with_ctes("order_sites")
    + """SELECT CAST(yr AS VARCHAR) AS sheet, count(*) * 2 AS n FROM order_sites
         GROUP BY 1""",
)
def _(t):
    part = sh.slice_range(t.inputs.energy_cells, "B7:C")
    return part.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"))


@query(
    "read_sheet_names", "SRC-07",
    sql=with_ctes("order_sites")
    + """SELECT DISTINCT CASE o_orderstatus WHEN 'O' THEN 'LA - Capacity, ' ELSE 'LA - Sites ' END
                || CAST(yr AS VARCHAR) AS sheet FROM order_sites WHERE o_orderstatus <> 'F'""",
)
def _(t):
    return sh.sheet_names(t.inputs.renewable_cells, "Sites|Capacity")


@query(
    "read_staged_cells_pruned", "SRC-06", "SRC-07", "SNK-05",
    sql=with_ctes("order_sites")
    + """SELECT CAST(yr AS VARCHAR) AS sheet, count(*) AS rows FROM order_sites
         WHERE yr >= 2000 GROUP BY 1""",
)
def _(t):
    path = scratch_folder(t.spark, "cells")
    sk.write_parquet(t.inputs.energy_cells, path, ["workbook", "sheet"])
    schema = "row bigint, col int, value string, workbook string, sheet string"
    cells = t.spark.read.schema(schema).parquet(path)
    rows = cells.where((F.col("sheet") >= "2000") & (F.col("row") > 6) & (F.col("col") == 3))
    return rows.groupBy("sheet").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "read_geojson_features", "SRC-09", "SNK-06",
    sql="SELECT c_custkey, c_mktsegment, c_acctbal AS x, c_nationkey::DOUBLE AS y FROM customer",
)
def _(t):
    points = t.customer.select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.col("c_nationkey").cast("double").alias("y")
    )
    path = scratch_folder(t.spark, "features")
    sk.write_features(points, path, "c_acctbal", "y")
    found = rc.read_features(
        t.spark, path, "c_custkey bigint, c_mktsegment string", "Point", collection=False
    )
    return found.select(
        "c_custkey",
        "c_mktsegment",
        F.col("coordinates")[0].alias("x"),
        F.col("coordinates")[1].alias("y"),
    )


@query(
    "read_landed_extract", "SRC-10", "AG-04",
    sql="""SELECT o_orderstatus, o_orderpriority, count(*) AS "count" FROM orders
           WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1, 2""",
)
def _(t):
    path = _landed_csv(t, t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), "csv")
    return de.read_landed_extract(
        t.spark,
        path,
        "o_orderkey bigint, o_orderstatus string, o_orderpriority string",
        refine={"o_orderpriority": ["1-URGENT", "5-LOW"]},
        group_by=["o_orderstatus", "o_orderpriority"],
    )


def land_payloads(t, path, where="true"):
    """Readings as payload lines: one for each day, period and hundred of units, holding their records."""
    r = t.inputs.readings.where(where)
    end = F.date_format("halfHourEndTime", "yyyy-MM-dd'T'HH:mm:ss").alias("halfHourEndTime")
    record = F.struct(*[end if c == "halfHourEndTime" else F.col(c) for c in r.columns])
    # A request names its units, so a payload has at most that many records.
    asked = F.floor(F.regexp_extract("bmUnit", r"(\d+)$", 1).cast("bigint") / 100).alias("asked")
    payloads = r.groupBy("settlementDate", "settlementPeriod", asked).agg(
        F.collect_list(record).alias("data")
    )
    payloads.select("data").write.mode("append").json(path)


@query(
    "read_json_records", "SRC-11",
    sql=with_ctes("readings")
    + """SELECT bmunit AS "bmUnit", settlementdate AS "settlementDate",
                settlementperiod AS "settlementPeriod", halfhourendtime AS "halfHourEndTime",
                quantity FROM readings""",
)
def _(t):
    path = scratch_folder(t.spark, "payloads")
    land_payloads(t, path)
    records = rc.read_payloads(t.spark, path, rc.HALF_HOURLY)
    return records.select(
        "bmUnit", "settlementDate", "settlementPeriod", "halfHourEndTime", "quantity"
    )


@query(
    "read_parquet_pruned", "SRC-12", "SNK-05",
    sql="""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, round(sum(o_totalprice), 2) AS price
           FROM orders WHERE year(o_orderdate) >= 1999 GROUP BY 1""",
)
def _(t):
    path = scratch_folder(t.spark, "parquet")
    sk.write_parquet(t.orders.withColumn("yr", F.year("o_orderdate")), path, ["yr"])
    stored = t.spark.read.parquet(path).where(F.col("yr") >= 1999)
    return rounded(stored.groupBy("yr").agg(F.sum("o_totalprice").alias("price")), 2)


@query(
    "read_catalog_table", "SRC-13", "SNK-01",
    sql="SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0",
)
def _(t):
    sk.replace_table(t.supplier, "wattshed_supplier", scratch_folder(t.spark, "table"))
    return t.spark.table("wattshed_supplier").where("s_acctbal > 0").select(
        "s_suppkey", "s_acctbal"
    )


def _databases(t):
    """Two databases of this run's own."""
    names = [f"wattshed_{side}_{uuid.uuid4().hex}" for side in ("far", "near")]
    for name in names:
        t.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_folder(t.spark, name)}'")
    return names


@query(
    "read_imported_table", "SRC-14", "SNK-01",
    sql="SELECT n_regionkey, count(*) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1",
)
def _(t):
    far, close = _databases(t)
    t.nation.write.saveAsTable(f"{far}.nation_tbl")
    t.customer.write.saveAsTable(f"{far}.customer_tbl")
    de.import_tables(t.spark, far, close, ["nation_tbl", "customer_tbl"])
    near = t.spark.table(f"{close}.customer_tbl").join(
        t.spark.table(f"{close}.nation_tbl"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return near.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "external_tables_imported", "P17", "SRC-14",
    sql=with_ctes("emissions", "certificates")
    + """SELECT 'emissions_tbl' AS name, count(*) AS n FROM emissions
         UNION ALL SELECT 'epc_domestic_tbl', count(*) FROM certificates""",
)
def _(t):
    far, close = _databases(t)
    t.inputs.emissions.write.saveAsTable(f"{far}.{ex.EMISSIONS}")
    t.inputs.certificates.write.saveAsTable(f"{far}.{ex.CERTIFICATES}")
    got = ex.import_external(t.spark, far, close)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k, df in got.items()]
    return counts[0].unionByName(counts[1])


@query(
    "read_literal_lookup", "SRC-15", "JN-04",
    sql="""SELECT c_mktsegment, icon, count(*) AS n FROM customer LEFT JOIN
           (VALUES ('BUILDING', 'house'), ('AUTOMOBILE', 'car-side')) AS v(seg, icon)
           ON c_mktsegment = seg GROUP BY 1, 2""",
)
def _(t):
    icons = t.spark.sql(
        "SELECT * FROM VALUES ('BUILDING', 'house'), ('AUTOMOBILE', 'car-side') AS v(c_mktsegment, icon)"
    )
    return (
        t.customer.join(F.broadcast(icons), "c_mktsegment", "left")
        .groupBy("c_mktsegment", "icon")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "read_saved_lookup", "SRC-16", "JN-02",
    sql="""SELECT category, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
           JOIN (SELECT DISTINCT p_type AS kind, lower(p_type) AS category FROM part)
           ON p_type = kind GROUP BY 1""",
)
def _(t):
    path = scratch_folder(t.spark, "lookup")
    kinds = t.part.select(F.col("p_type").alias("kind")).distinct()
    sk.write_parquet(kinds.withColumn("category", F.lower("kind")), path)
    saved = t.spark.read.parquet(path)
    counts = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    named = counts.join(saved, F.col("p_type") == F.col("kind"))
    return named.groupBy("category").agg(F.sum("_n").alias("n"))


for _how, _row in {"typed": "SRC-01", "dropping": "SRC-03", "lenient": "SRC-04"}.items():

    @query(
        f"read_csv_quoted_{_how}", _row, "SNK-04",
        sql="SELECT doc_id, md5(coalesce(text, '')) AS digest, n_chars FROM documents",
    )
    def _(t, how=_how):
        """Whole texts with quotes, commas and line breaks, written and read again."""
        reader = {"typed": de.read_csv, "dropping": de.read_csv_dropping, "lenient": de.read_csv_lenient}[how]
        quoted = F.concat(F.lit('"a", '), F.coalesce("text", F.lit("")), F.lit("\n b"))
        path = _landed_csv(t, t.documents.select("doc_id", quoted.alias("text"), "n_chars"), "quoted")
        got = reader(t.spark, path, "doc_id bigint, text string, n_chars bigint")
        plain = F.substring("text", F.lit(6), F.length("text") - 8)
        return got.select("doc_id", F.md5(plain).alias("digest"), "n_chars")


@query(
    "write_replaced_view", "SNK-02",
    sql="""SELECT n_name, round(sum(c_acctbal), 2) AS balance FROM customer
           JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def _(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sk.replace_view(joined.select("n_name", "c_acctbal"), "wattshed_customer_vw")
    return t.spark.sql(
        """SELECT n_name, round(sum(c_acctbal), 2) AS balance FROM wattshed_customer_vw
           GROUP BY n_name"""
    )


@query(
    "write_union_as_table", "SNK-03", "ST-01",
    sql="""SELECT o_orderkey, yr FROM (
             SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders)
           UNION ALL SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) FROM lineitem""",
)
def _(t):
    a = t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr"))
    b = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("yr"))
    name = f"wattshed_union_{uuid.uuid4().hex}"
    sk.create_table(a.unionByName(b), name, scratch_folder(t.spark, "union"))
    return t.spark.table(name)


@query(
    "write_csv_with_nulls", "SNK-04",
    sql="""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, nullif(p_type, 'PROMO') AS kind
           FROM part""",
)
def _(t):
    kinds = t.part.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("kind"))
    path = scratch_folder(t.spark, "csv")
    sk.write_csv(kinds, path)
    return de.read_csv_text(t.spark, path)


@query(
    "write_declared_rows", "SNK-07",
    sql="""SELECT 'Fossil' AS category, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice
                  END), 2) AS capacity FROM orders
           UNION ALL SELECT 'Renewable', round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice
                  END), 2) FROM orders""",
)
def _(t):
    t.orders.createOrReplaceTempView("wattshed_orders")
    rows = t.spark.sql(
        """SELECT 'Fossil' AS category, (SELECT round(sum(o_totalprice), 2) FROM wattshed_orders
                  WHERE o_orderstatus = 'F') AS capacity
           UNION ALL SELECT 'Renewable', (SELECT round(sum(o_totalprice), 2) FROM wattshed_orders
                  WHERE o_orderstatus = 'O')"""
    )
    sk.replace_table(rows, "wattshed_capacity", scratch_folder(t.spark, "declared"))
    return t.spark.table("wattshed_capacity")


@query(
    "write_verified", "SNK-08",
    sql="SELECT count(*) AS rows FROM lineitem WHERE l_quantity > 25",
)
def _(t):
    big = t.lineitem.where(F.col("l_quantity") > 25)
    rows = sk.write_verified(big, scratch_folder(t.spark, "verified"))
    return t.spark.range(1).select(F.lit(rows).cast("bigint").alias("rows"))


@query(
    "write_published_run", "SNK-09",
    sql="""SELECT c_mktsegment, round(sum(o_totalprice), 2) AS price FROM orders
           JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def _(t):
    root = scratch_folder(t.spark, "published")
    sk.publish(t.spark, {"orders": t.orders, "customer": t.customer}, root)
    orders = sk.read_published(t.spark, root, "orders")
    customer = sk.read_published(t.spark, root, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return rounded(joined.groupBy("c_mktsegment").agg(F.sum("o_totalprice").alias("price")), 2)


@query(
    "read_extract_normalised_types", "SRC-02", "SRC-05", "SC-13",
    sql=with_ctes("vehicles")
    + """SELECT fuel, count(*) AS n, count(_2025_q1) AS given, round(sum(_2025_q1), 2) AS total
         FROM vehicles GROUP BY 1""",
)
def _(t):
    df = normalise_columns(de.read_csv_text(t.spark, _landed_csv(t, t.inputs.vehicles, "csv")))
    value = F.when(~F.col("_2025_q1").startswith("["), F.col("_2025_q1")).cast("double")
    sums = df.groupBy("fuel").agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("given"), F.sum(value).alias("total")
    )
    return rounded(sums, 2)
