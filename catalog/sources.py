"""Readers, writers and row positions.

Reader queries first land a test table as files in a fresh folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import LINE_KEY, LINE_ORDER, TABLES, add, ctes, fact, money, table  # noqa: F401
from plumbline.operators.aggregates import aggregate
from plumbline.session import scratch_dir
from plumbline.sources import ordinals, tables

ORDERS_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
ORDERS_COLUMNS = [c.split()[0] for c in ORDERS_DDL.split(", ")]


def _landed_orders(spark, sf, name, **options):
    path = scratch_dir(spark, name)
    table(spark, sf, "orders").select(*ORDERS_COLUMNS).write.options(header=True, **options).csv(path)
    return path


@add("csv_scan", "A1 A4", f"SELECT {', '.join(ORDERS_COLUMNS)} FROM orders")
def _(spark, sf):
    return tables.read_table(spark, _landed_orders(spark, sf, "csv"), ORDERS_DDL)


# Whole texts, but for characters that the code page lacks.
_BEYOND = "[^\\x01-\\x7E\\xA0-\\xFF]"


@add("csv_scan_windows_1252", "A2", f"SELECT doc_id, lang, regexp_replace(text, '{_BEYOND}', '?', 'g') || '€–\",\n' AS text FROM documents")
def _(spark, sf):
    # the landed bytes are Windows-1252: ISO-8859-1 plus 0x80, 0x96
    path = scratch_dir(spark, "cp1252")
    text = F.concat(F.regexp_replace("text", _BEYOND, "?"), F.lit('\x80\x96",\n'))
    rows = table(spark, sf, "documents").select("doc_id", "lang", text.alias("text"))
    options = {"header": True, "encoding": "iso-8859-1", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**options).csv(path)
    return tables.read_table(spark, path, "doc_id BIGINT, lang STRING, text STRING", encoding="cp1252", multiline=True)


@add("forced_text_type", "A4", "SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS zip, c_name FROM customer")
def _(spark, sf):
    path = scratch_dir(spark, "typed")
    zips = F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("zip")
    table(spark, sf, "customer").select(zips, "c_name").write.option("header", True).csv(path)
    return tables.read_table(spark, path, "zip STRING, c_name STRING")


@add("names_given_at_read", "A5", "SELECT o_orderkey AS invoice, o_custkey AS vendor FROM orders")
def _(spark, sf):
    path = scratch_dir(spark, "unnamed")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey").write.option("header", False).csv(path)
    return tables.read_table(spark, path, "invoice BIGINT, vendor BIGINT", header=False)


SHEETS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _landed_sheets(spark, sf):
    path = scratch_dir(spark, "sheets")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("sheet"))
    tables.write_sheets(rows, path)
    return path


@add("sheet_by_name", "A3", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'")
def _(spark, sf):
    return tables.read_sheet(spark, _landed_sheets(spark, sf), "2-HIGH")


@add("sheet_by_number", "A3", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'")
def _(spark, sf):
    return tables.read_sheet(spark, _landed_sheets(spark, sf), 4, order=list(SHEETS))


@add("spelling_map_file", "A6", "SELECT CAST(c_custkey AS VARCHAR) AS wrong, max_by(v, o) AS right FROM (SELECT c_custkey, upper(c_name) AS v, 2 AS o FROM customer) GROUP BY ALL")
def _(spark, sf):
    # every key twice; the later line counts
    path = scratch_dir(spark, "mapping")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("k"), "c_name")
    twice = rows.select("k", F.posexplode(F.array("c_name", F.upper("c_name"))).alias("o", "v"))
    twice.select(F.concat_ws(":", "k", "v").alias("value")).write.text(path)
    return tables.read_mapping(spark, path)


@add("exclusion_list_file", "A7", "SELECT p_name AS value FROM part")
def _(spark, sf):
    path = scratch_dir(spark, "list")
    table(spark, sf, "part").select("p_name").write.text(path)
    return tables.read_list(spark, path)


@add(
    "several_sheets_in_one_scan", "A8 F3",
    "SELECT o_orderpriority AS sheet, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')",
)
def _(spark, sf):
    return tables.read_sheets(spark, _landed_sheets(spark, sf), ["1-URGENT", "2-HIGH", "5-LOW"])


@add("sheet_catalog", "A9", "SELECT DISTINCT o_orderpriority AS sheet FROM orders")
def _(spark, sf):
    return tables.list_sheets(tables.read_sheets(spark, _landed_sheets(spark, sf)))


@add(
    "year_table_overwrite", "A10 A12",
    f"""{ctes('spend')} SELECT invoice, fy, CASE WHEN fy = '19-20' THEN vendor END AS vendor, CASE WHEN fy <> '19-20' THEN state END AS state
    FROM spend WHERE fy IN ('18-19', '19-20', '20-21')""",
)
def _(spark, sf):
    path, rows = scratch_dir(spark, "years"), fact(spark, sf, "spend")
    for year in ("18-19", "19-20", "20-21"):
        tables.write_year(rows.filter(F.col("fy") == year).select("invoice", "state"), path, year)
    # a second write replaces its year only, and brings other columns
    tables.write_year(rows.filter(F.col("fy") == "19-20").select("invoice", "vendor"), path, "19-20")
    return tables.read_years(spark, path)


@add(
    "summary_table_as_csv", "A11",
    f"{ctes('spend')} SELECT fy, {money('price')} AS price FROM spend GROUP BY fy",
)
def _(spark, sf):
    path = scratch_dir(spark, "summary")
    tables.write_table(aggregate(fact(spark, sf, "spend"), ["fy"], {"price": ("price", "money")}), path, fmt="csv")
    return tables.read_table(spark, path, "fy STRING, price DOUBLE")


ROWS = "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders"
FIRST_TO_LAST = "SELECT o_orderkey, o_custkey FROM"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey")


@add("row_numbers_by_order", "B1", "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS _ord FROM orders")
def _(spark, sf):
    return ordinals.with_ordinal(_orders(spark, sf), ["o_orderkey"])


@add(
    "row_numbers_by_several_columns", "B1",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    f"CAST(row_number() OVER (ORDER BY {LINE_KEY}) - 1 AS BIGINT) AS _ord FROM lineitem",
)
def _(spark, sf):
    return ordinals.with_ordinal(table(spark, sf, "lineitem").select(*LINE_ORDER), LINE_ORDER)


@add("row_numbers_in_file_order", "B1", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS _ord FROM orders")
def _(spark, sf):
    # landed in key order, so that file order is known
    path = scratch_dir(spark, "ordered")
    table(spark, sf, "orders").select("o_orderkey").sort("o_orderkey").write.csv(path)
    return ordinals.with_ordinal(tables.read_table(spark, path, "o_orderkey BIGINT", header=False))


@add("header_rows_skipped", "B2", f"{FIRST_TO_LAST} ({ROWS}) WHERE n >= 3")
def _(spark, sf):
    return ordinals.skip_rows(_orders(spark, sf), 3, ["o_orderkey"])


@add("footer_rows_skipped", "B3", f"{FIRST_TO_LAST} ({ROWS}) WHERE n < (SELECT count(*) FROM orders) - 16")
def _(spark, sf):
    return ordinals.skip_footer(_orders(spark, sf), 16, ["o_orderkey"])


@add("head_slice_end_included", "B4", f"{FIRST_TO_LAST} ({ROWS}) WHERE n <= 28")
def _(spark, sf):
    return ordinals.slice_labels(_orders(spark, sf), 0, 28, ["o_orderkey"])


@add("tail_slice", "B5", f"{FIRST_TO_LAST} ({ROWS}) WHERE n >= 60")
def _(spark, sf):
    return ordinals.slice_rows(_orders(spark, sf), 60, None, ["o_orderkey"])


@add(
    "slice_by_several_columns", "B4 B5",
    f"""SELECT {LINE_KEY} FROM (SELECT *, row_number() OVER (ORDER BY {LINE_KEY}) - 1 AS n FROM lineitem) WHERE n >= 100""",
)
def _(spark, sf):
    return ordinals.slice_rows(table(spark, sf, "lineitem").select(*LINE_ORDER), 100, None, LINE_ORDER)


@add("given_rows_dropped", "B6", f"{FIRST_TO_LAST} ({ROWS}) WHERE n NOT BETWEEN 5 AND 13 AND n <> 177")
def _(spark, sf):
    return ordinals.drop_ordinals(_orders(spark, sf), [5, 6, 7, 8, 9, 10, 11, 12, 13, 177], ["o_orderkey"])


@add(
    "row_promoted_to_header", "B7",
    """SELECT o_orderkey, o_orderstatus AS "status", o_orderpriority AS "priority" FROM orders""",
)
def _(spark, sf):
    # a names row ahead of the data, as in a sheet with a title line
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("c0"), F.col("o_orderpriority").alias("c1")
    )
    first = rows.agg((F.min("o_orderkey") - 1).alias("o_orderkey"), F.lit("status").alias("c0"), F.lit("priority").alias("c1"))
    return ordinals.promote_header(rows.unionByName(first), ["o_orderkey"])


@add(
    "cells_corrected_by_key", "B8",
    "SELECT c_custkey, CASE c_custkey WHEN 2 THEN 'BLACKWATER' ELSE c_name END AS c_name, "
    "CASE c_custkey WHEN 5 THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment FROM customer",
)
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ordinals.apply_corrections(rows, "c_custkey", {2: {"c_name": "BLACKWATER"}, 5: {"c_mktsegment": "NONE"}})


@add(
    "cell_corrected_by_row_number", "B8",
    "SELECT c_custkey, CASE row_number() OVER (ORDER BY c_custkey) - 1 WHEN 2 THEN 'BLACKWATER' ELSE c_name END AS c_name FROM customer",
)
def _(spark, sf):
    return ordinals.correct_at(table(spark, sf, "customer").select("c_custkey", "c_name"), 2, "c_name", "BLACKWATER", ["c_custkey"])


@add("columns_by_position", "B9", "SELECT l_partkey, l_suppkey, l_linenumber FROM lineitem")
def _(spark, sf):
    return ordinals.keep_columns_from(table(spark, sf, "lineitem"), 1, 4)
