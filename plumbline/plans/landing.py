"""From landed raw files to written year tables.

Workbooks are landed as CSV, a sheet per folder, as they are: title lines,
header row, data, total lines. A layout per source and year says which rows
are data, a rename map brings that year's headers to one declared schema.
"""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import cp1252_from_latin1, cp1252_text
from plumbline.operators.clean import dedup_first, with_fy
from plumbline.operators.unions import union_years
from plumbline.plans.claims import SHEETS
from plumbline.plans.cleaning import Refs
from plumbline.plans.fixed import (
    FLEET_ROWS,
    PRISON_CORRECTION,
    PRISON_LAST_LABEL,
    RETIREE_IN_STATE_FROM,
    RETIREE_OUT_OF_STATE_TO,
)
from plumbline.plans.out_of_state import claims_outside, fy_spine, retirees_outside, spend_outside, summary
from plumbline.plans.years import city_metrics, county_year_table, guard_repeats, year_report, year_table
from plumbline.sources.ordinals import ORDINAL, with_ordinal
from plumbline.sources.tables import YEAR, conform, read_list, read_mapping, write_table, write_year

ROW = "row_id"


@dataclass(frozen=True)
class Layout:
    """Rows of a landed sheet: ``header`` lines above the header row, data rows
    ``first`` to ``last`` (included), ``footer`` lines at the end."""

    header: int = 0
    first: int = 0
    last: int | None = None
    footer: int = 0

    @property
    def plain(self) -> bool:
        return self == Layout()


@dataclass(frozen=True)
class File:
    """Where a source lies and how its headers map to the schema's names."""

    path: str
    renames: dict[str, str] = field(default_factory=dict)
    encoding: str = "utf-8"
    # Sheets (files or folders below ``path``) in their order.
    sheets: tuple[str, ...] = ()
    # Cells may hold line breaks; such a file is read by one task.
    multiline: bool = False
    # In place of the fixed layout of the source and year.
    layout: Layout | None = None

    @property
    def names(self) -> dict[str, str]:
        """The renames, whatever white space ends a header."""
        return {header.strip(): name for header, name in self.renames.items()}


# Rows of the sources that are not a plain table, by year.
_CLAIMS = {y: Layout(footer=1) for y in ("18-19", "19-20", "20-21", "21-22")}
_PARTS = {y: Layout(header=1, last=66) for y in ("19-20", "20-21", "21-22")}
LAYOUTS: dict[str, dict[str, Layout]] = {
    "circuits": {"21-22": Layout(header=3)},
    "disbursements": {"18-19": Layout(first=1, footer=1), **_PARTS},
    "medical_retiree": _CLAIMS,
    "medical_active": {"21-22": Layout(footer=1)},
    "pharmacy_retiree": {"21-22": Layout(footer=1)},
    "pharmacy_active": {"21-22": Layout(footer=1)},
    "fleet": {"20-21": Layout(last=FLEET_ROWS - 1)},
    "prisons": {
        "18-19": Layout(header=1, last=PRISON_LAST_LABEL, footer=16),
        "19-20": Layout(header=1, last=PRISON_LAST_LABEL),
        "20-21": Layout(header=1, last=PRISON_LAST_LABEL),
        "21-22": Layout(header=1, last=PRISON_LAST_LABEL, footer=16),
    },
    "state_surplus": {"21-22": Layout(footer=1)},
    "expenses": {"20-21": Layout(header=3)},
    "construction": {"21-22": Layout(header=1)},
    "retirees": {"18-19": Layout(header=58, footer=2), "21-22": Layout(header=1, first=RETIREE_IN_STATE_FROM, footer=1)},
    "retirees_outside": {
        y: Layout(header=1 if y == "21-22" else 0, last=last, footer=1 if y == "21-22" else 0)
        for y, last in RETIREE_OUT_OF_STATE_TO.items()
    },
    "employers": {"18-19": Layout(footer=2)},
    "contributions": {"21-22": Layout(footer=1)},
}

_CLAIM = "zip string, enrollee decimal(28,10), dependents decimal(28,10)"
_COSTS = "city string, asset string, operating_cost string, maintenance_cost string, fuel_cost string"
_RETIREE = "zip string, payment decimal(28,10), payees bigint"
_EMPLOYER = "agency string, city string, contribution decimal(28,10)"
_BUILDING = (
    "agency string, id string, city string, square_feet decimal(28,10), land decimal(28,10), structure decimal(28,10)"
)
_POSITION = "emp_type bigint, city string, position string, vacant string, fte decimal(28,10)"

# Declared columns of every source; a year's own where they differ.
SCHEMAS: dict[str, str | dict[str, str]] = {
    "circuits": {
        "": "zip string, circuits bigint, charge decimal(28,10)",
        "21-22": "inventory_id string, city string, retail decimal(28,10)",
    },
    "grants": "county string, final_award decimal(28,10)",
    "disbursements": {
        "": "county string, wireless decimal(28,10), nonwireless decimal(28,10), prepaid_wireless decimal(28,10), "
        "supplemental decimal(28,10), special decimal(28,10)",
        "18-19": "county string, total decimal(28,10)",
    },
    "erate": "county string, authorized string",
    "call_centers": "county string, center string",
    "towers": "county string, tower string",
    "phones_local": "city string, charges decimal(28,10)",
    "phones_internet": "city string, charges decimal(28,10)",
    **{name: _CLAIM for name in SHEETS},
    "fleet": _COSTS,
    "prisons": "facility string, reimbursement decimal(28,10)",
    "prison_locations": "facility string, city string",
    "federal_surplus": {
        "": "agency string, invoice string, acquisition_cost decimal(28,10), service_charge decimal(28,10), items bigint",
        "20-21": "agency string, savings decimal(28,10), items bigint",
    },
    "state_surplus": {
        "": "donee string, line_items bigint, direct_cost string, federal_cost string, overseas_cost string, service_charge string",
        "18-19": "city string, line_items bigint, savings string",
        "21-22": "city string, line_items bigint, savings string",
    },
    "donees": "donee string, city string",
    "marketplace": "state string, city string, amount string, vendor string, invoice string",
    "certified": {
        "": "tax_id string, business string, city string",
        "18-19": "tax_id string, business string, effective_on date, expire_on date, address string",
        "19-20": "tax_id string, business string, effective_on date, expire_on date, address string",
    },
    "positions": {
        "": f"{_POSITION}, base_rate decimal(28,10), pay_code string",
        "21-22": f"{_POSITION}, salary decimal(28,10), health decimal(28,10), home_city string",
    },
    "facilities": {
        "": _BUILDING,
        "18-19": f"{_BUILDING}, utilities decimal(28,10), operating decimal(28,10)",
        "19-20": f"{_BUILDING}, utilities decimal(28,10), operating decimal(28,10)",
    },
    "expenses": "city string, category string, amount decimal(28,10)",
    "construction": "city string, funds decimal(28,10)",
    "retirees": {"": f"{_RETIREE}, fiscal_year string", "18-19": _RETIREE, "21-22": _RETIREE},
    "retirees_outside": {"": f"{_RETIREE}, fiscal_year string", "21-22": _RETIREE},
    "employers": {"": f"{_EMPLOYER}, fiscal_year string", "18-19": _EMPLOYER, "21-22": _EMPLOYER},
    "contributions": _EMPLOYER,
    "travel": "destination string, amount decimal(28,10)",
}

# Sources whose jobs refer to row order.
ORDERED = {"federal_surplus", "certified", "donees", "prisons", "retirees_outside"}
ORDERS = {name: [ROW] for name in ORDERED}
# Sources whose undeclared columns are part of the result.
KEEPS_ALL = {"prison_locations"}
# Numbers of a sheet's rows start this far from those of the one before.
SHEET_ROWS = 1 << 40
RAGGED = "_ragged"


def schema_of(source: str, year: str) -> str:
    schema = SCHEMAS[source]
    return schema if isinstance(schema, str) else schema.get(year, schema[""])


def load_source(spark: SparkSession, file: File, source: str, year: str) -> DataFrame:
    """A landed source of one year with its declared columns, plus ``row_id``
    where the job needs the order.

    Every data row must have as many cells as the header row; lines above the
    header and lines cut off may have any number. Sheets of a file each have a
    header row of their own and follow each other in the order given.
    """
    layout = file.layout or LAYOUTS.get(source, {}).get(year, Layout())
    if file.sheets:
        parts = [
            _rows(spark, replace(file, path=f"{file.path.rstrip('/')}/{sheet}", sheets=()), layout, True)
            .withColumnsRenamed(file.names).withColumn(ROW, F.col(ROW) + i * SHEET_ROWS)
            for i, sheet in enumerate(file.sheets)
        ]
        rows = union_years(parts)
    else:
        rows = _rows(spark, file, layout, source in ORDERED)
    ordered = ROW in rows.columns
    out = _declared(rows, file, source, year, ordered)
    if source == "prisons":
        at, column, value = PRISON_CORRECTION
        out = out.withColumn(column, F.when(F.col(ROW) == at, F.lit(value)).otherwise(F.col(column)))
    return out if source in ORDERED else out.drop(ROW)


def _declared(rows: DataFrame, file: File, source: str, year: str, ordered: bool) -> DataFrame:
    schema = schema_of(source, year) + (f", {ROW} bigint" if ordered else "")
    if source not in KEEPS_ALL:
        return conform(rows, file.names, schema)
    declared = conform(rows, file.names, schema)
    renamed = rows.withColumnsRenamed(file.names)
    return renamed.select(*[F.col(f"`{c}`").cast(declared.schema[c].dataType) if c in declared.columns else F.col(f"`{c}`") for c in renamed.columns])


def _rows(spark: SparkSession, file: File, layout: Layout, ordered: bool) -> DataFrame:
    """Data rows of one sheet under the names of its header row, all as text,
    with ``row_id`` if the layout or the caller needs it."""
    reader = spark.read.option("encoding", "iso-8859-1" if file.encoding == "cp1252" else file.encoding)
    reader = reader.option("multiLine", file.multiline).option("escape", '"')
    names = _header(reader, file.path, layout.header)
    if file.encoding == "cp1252":
        names = [cp1252_text(n) for n in names]
    text = ", ".join(f"`_c{i}` string" for i in range(len(names)))
    named = [F.col(f"_c{i}").alias(n) for i, n in enumerate(names) if n]
    if layout.plain and not ordered:
        # a row with another number of cells fails the job
        df = reader.schema(text).option("header", True).option("enforceSchema", True).option("mode", "FAILFAST").csv(file.path)
        return _recoded(df, file).select(*named)
    ragged = reader.schema(f"{text}, {RAGGED} string").option("columnNameOfCorruptRecord", RAGGED).option("columnPruning", False)
    rows = with_ordinal(_recoded(ragged.csv(file.path), file), total="_all")
    at, last = F.col(ORDINAL) - (layout.header + 1), F.col("_all") - layout.footer
    inside = (F.col(ROW) >= layout.first) & (F.col(ORDINAL) < last)
    if layout.last is not None:
        inside = inside & (F.col(ROW) <= layout.last)
    # A query may not read the record of a faulty line alone, so a cell is read with it.
    fits = F.col(RAGGED).isNull() & (F.length(F.coalesce("_c0", F.lit(""))) >= 0)
    fault = F.raise_error(F.concat(F.lit(f"{file.path}: not {len(names)} cells: "), F.col(RAGGED))).cast("boolean")
    kept = rows.withColumn(ROW, at).where(F.when(~inside, False).when(fits, True).otherwise(fault))
    return kept.select(*named, ROW)


def _header(reader: DataFrameReader, path: str, at: int) -> list[str]:
    """Cells of the header row without the white space at their ends, read with
    the lines above it from the start of the first file."""
    first = min(reader.text(path).inputFiles())
    # No line has so few cells, so each comes as the record it is.
    raw = reader.schema(f"`_c0` string, `_c1` string, {RAGGED} string").option("columnNameOfCorruptRecord", RAGGED)
    lines = raw.option("columnPruning", False).csv(first).head(at + 1)
    if len(lines) <= at:
        raise ValueError(f"{path}: no header row {at}")
    line = lines[at]
    record = line[RAGGED] if line[RAGGED] is not None else None
    if record is None:
        return [(line[0] or "").strip(), (line[1] or "").strip()]
    return [c.strip() for c in next(csv.reader(io.StringIO(record)))]


def _recoded(df: DataFrame, file: File) -> DataFrame:
    if file.encoding != "cp1252":
        return df
    return df.select(*[cp1252_from_latin1(F.col(f"`{c}`")).alias(c) for c in df.columns])


def load_refs(spark: SparkSession, geo: File, zips: File, replacements: str, exclusions: str) -> Refs:
    """The shared dimensions: first row per city in file order with all its
    columns, upper-case cities in the zip lookup, spelling map, exclusions. Both
    files are read as sources are: by layout and encoding, and a row with
    another number of cells than the header fails the job."""
    rows = _rows(spark, geo, geo.layout or Layout(), True).withColumnsRenamed(geo.names)
    spine = rows.withColumn("ord", F.col(ROW) + 1).drop(ROW)  # lines below the header, from 1
    lookup = conform(_rows(spark, zips, zips.layout or Layout(), False), zips.names, "zip string, city string")
    return Refs(
        dedup_first(spine, ["city"], ["ord"]),
        lookup.withColumn("city", F.upper("city")),
        read_mapping(spark, replacements),
        read_list(spark, exclusions),
    )


def load_year(spark: SparkSession, files: dict[str, File], year: str) -> dict[str, object]:
    """Sources of one year by the names the year tables use."""
    s: dict[str, object] = {name: load_source(spark, file, name, year) for name, file in files.items()}
    if "prisons" in s:
        s["prisons"] = (s["prisons"].drop(ROW), s.pop("prison_locations"))
    if "phones_local" in s:
        s["phones"] = (s.pop("phones_local"), s.pop("phones_internet"))
    if set(SHEETS) <= set(s):
        s["claims"] = {name: s.pop(name) for name in SHEETS}
    if "positions" in s:
        s["temporary"] = s["positions"]
        if year == "21-22":
            s["residences"] = s["positions"]
    return s


def assemble_year(
    spark: SparkSession,
    files: dict[str, File],
    refs: Refs,
    year: str,
    *,
    city_path: str,
    county_path: str,
    home_state: str,
    agency: str,
    repeat_rows: bool = True,
    report_path: str | None = None,
    most_repeats: int | None = None,
) -> None:
    """Read a year's landed files and write its city and county tables, and to
    ``report_path`` what :func:`year_report` finds in the city table. The
    metrics are written first, so the table, the guard and the report read no
    source again. With ``most_repeats`` prisons and maintenance rows may make at
    most so many rows of one city; more fail the job."""
    sources = load_year(spark, files, year)
    metrics = city_metrics(sources, refs, year, home_state=home_state, agency=agency, orders=ORDERS, repeat_rows=repeat_rows).written()
    if most_repeats is not None:
        guard_repeats(metrics, most_repeats)
    city = with_fy(year_table(refs.spine.drop("ord"), metrics), year)
    write_year(county_year_table(sources, refs, year), county_path)
    write_year(city, city_path)
    if report_path is not None:
        written = spark.read.schema(city.schema).parquet(city_path).where(F.col(YEAR) == year)
        write_year(year_report(metrics, refs.spine, written), report_path, year)


def assemble_out_of_state(
    spark: SparkSession,
    files: dict[str, dict[str, File]],
    history: File,
    refs: Refs,
    path: str,
    *,
    home_state: str,
    current_year: str = "21-22",
) -> None:
    """Write the out-of-state summary. ``files`` holds the claim sheets and
    marketplace file of each year and the current retiree file; ``history``
    is the retiree file of the earlier years."""
    def tagged(source: str) -> DataFrame:
        return union_years([with_fy(load_source(spark, f[source], source, y), y) for y, f in files.items()])

    years = fy_spine(spark, tuple(files))
    current = load_source(spark, files[current_year]["retirees_outside"], "retirees_outside", current_year)
    earlier = load_source(spark, history, "retirees_outside", "20-21")
    parts = (
        claims_outside({name: tagged(name) for name in SHEETS}, refs.zips, years),
        spend_outside(tagged("marketplace"), years, home_state=home_state),
        retirees_outside(current, earlier, order=[ROW], current_year=current_year),
    )
    write_table(summary(years, *parts), path)
