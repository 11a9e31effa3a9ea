"""Year tables (one per fiscal year) and the all-years tables.

The metrics of a year are one tall table: a row per source and key, a column
per metric, null in the rows of the other sources. One aggregation turns it
into a row per key, and one join brings that to the spine, however many sources
there are. Checks read the tall table too, so no source is read for them again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import quality
from plumbline.operators.clean import drop_if_all_present, with_fy
from plumbline.operators.joins import attach_rows
from plumbline.operators.unions import union_years
from plumbline.plans import city_jobs as city
from plumbline.plans import county_jobs as county
from plumbline.plans.cleaning import Refs
from plumbline.plans.fixed import STEPS
from plumbline.session import written
from plumbline.sources.tables import YEAR, read_years, write_table, write_year

Sources = dict[str, object]
SOURCE = "source"


@dataclass(frozen=True)
class Frame:
    """Metrics of one source. ``repeats``: a key may have several rows, each of
    which repeats the row of the table it joins (a key in several spellings
    that the last cleaning step made one). ``extends``: keys that the spine
    lacks get a row, with the metrics from this one on."""

    name: str
    columns: tuple[str, ...]
    repeats: bool = False
    extends: bool = False


@dataclass(frozen=True)
class Metrics:
    """``rows``: source, the key, and a column ``source.metric`` per metric.
    ``joined``: frames that are not aggregated, whose rows join the spine as
    they are, ahead of all others."""

    key: str
    rows: DataFrame | None
    frames: tuple[Frame, ...]
    joined: dict[str, DataFrame]

    def written(self) -> Metrics:
        """The same metrics, read from tables of their own."""
        rows = written(self.rows, "metrics") if self.rows is not None else None
        return replace(self, rows=rows, joined={n: written(df, n) for n, df in self.joined.items()})


def _tall_name(frame: str, column: str) -> str:
    return f"{frame}.{column}"


def tall(parts: list[tuple[Frame, DataFrame]], key: str) -> DataFrame | None:
    """The metric frames as one table. A part may hold several frames if it has
    a column ``frame`` that names them."""
    rows = []
    for i, (frame, df) in enumerate(parts):
        if any(df is d for _, d in parts[:i]):
            continue
        own = {_tall_name(f.name, c): c for f, d in parts if d is df for c in f.columns}
        name = "`frame`" if "frame" in df.columns else f"'{frame.name}'"
        rows.append(df.selectExpr(f"{name} AS {SOURCE}", f"`{key}`", *[f"`{c}` AS `{t}`" for t, c in own.items()]))
    return union_years(rows) if rows else None


def wide(metrics: Metrics) -> DataFrame:
    """One row per key: the metrics, lists of rows for frames that repeat, and
    for those that extend whether they have the key."""
    cells = []
    for f in metrics.frames:
        mine = f"{SOURCE} = '{f.name}'"
        names = [f"`{_tall_name(f.name, c)}`" for c in f.columns]
        if f.repeats:
            # few: the spellings of one key
            cells.append(f"collect_list(CASE WHEN {mine} THEN struct({', '.join(names)}) END) AS `{f.name}`")
        else:
            # a key has one row, so the largest value is the only one
            cells += [f"max({n}) AS {n}" for n in names]
        if f.extends:
            cells.append(f"coalesce(max({mine}), false) AS `{f.name}?`")
    return metrics.rows.where(F.col(metrics.key).isNotNull()).groupBy(metrics.key).agg(*map(F.expr, cells))


def year_table(spine: DataFrame, metrics: Metrics) -> DataFrame:
    """The spine with all metrics; a spine row without a metric has nulls."""
    key, base = metrics.key, spine.columns
    joined = list(metrics.joined.values())
    # Rows of several such frames multiply, so the last is joined after all else.
    last = joined.pop() if len(joined) > 1 else None
    table = spine
    for df in joined:
        table = table.join(df, key, "left")
    names = [*base, *[c for c in table.columns if c not in base]]
    if metrics.rows is None:
        return table if last is None else _multiplied(table.withColumn("_from_spine", F.lit(True)), key, names, [], last)
    extending = [f.name for f in metrics.frames if f.extends]
    right = wide(metrics).withColumnRenamed(key, "_key").withColumn("_there", F.lit(True))
    if extending:
        table = table.withColumn("_spine", F.lit(True)).join(right, F.col(key) == F.col("_key"), "full_outer")
        of_spine = F.coalesce("_spine", F.lit(False))
        table = table.where(of_spine | reduce(lambda a, b: a | b, [F.col(f"`{n}?`") for n in extending]))
        table = table.withColumn("_from_spine", of_spine).withColumn(key, F.coalesce(key, "_key"))
    else:
        table = table.join(right, F.col(key) == F.col("_key"), "left").withColumn("_from_spine", F.lit(True))
    out, late = [], "_from_spine"
    for f in metrics.frames:
        if f.extends:
            late = f"({late} OR `{f.name}?`)"
        if f.repeats:
            table = table.withColumn(f.name, F.expr(f"explode_outer(CASE WHEN {late} THEN `{f.name}` END)"))
            out += [(f"`{f.name}`.`{_tall_name(f.name, c)}`", c) for c in f.columns]
        else:
            out += [(f"CASE WHEN {late} THEN `{_tall_name(f.name, c)}` END", c) for c in f.columns]
    if last is not None:
        return _multiplied(table, key, names, out, last)
    return table.selectExpr(*[f"`{c}`" for c in names], *[f"{e} AS `{c}`" for e, c in out])


def _multiplied(table: DataFrame, key: str, names: list[str], out: list[tuple[str, str]], last: DataFrame) -> DataFrame:
    """The columns ``names``, those of ``last`` and ``out`` (expression, name)
    of a table whose rows from the spine each row of ``last`` repeats. All else
    is written first, so that the join only copies it."""
    cells = [*[(f"`{c}`", c) for c in names], *out]
    on = f"CASE WHEN _from_spine THEN `{key}` END AS _on"
    kept = written(table.selectExpr(on, *[f"{e} AS `_c{i}`" for i, (e, _) in enumerate(cells)]), "year-table")
    renamed = [f"`_c{i}` AS `{c}`" for i, (_, c) in enumerate(cells)]
    more = [f"`{c}`" for c in last.columns if c != key]
    return attach_rows(kept, last, "_on", key).selectExpr(*renamed[: len(names)], *more, *renamed[len(names) :])


def guard_repeats(metrics: Metrics, most: int) -> None:
    """Fail if the frames that are not aggregated would make more than ``most``
    rows of one spine row; names some of the keys."""
    counts = [df.groupBy(metrics.key).agg(F.count("*").alias(f"n{i}")) for i, df in enumerate(metrics.joined.values())]
    if not counts:
        return
    both = reduce(lambda a, b: a.join(b, metrics.key, "full_outer"), counts)
    rows = reduce(lambda a, b: a * b, [F.coalesce(f"n{i}", F.lit(1)).cast("decimal(19,0)") for i in range(len(counts))])
    bad = both.select(metrics.key, rows.alias("rows")).where(F.col(metrics.key).isNotNull() & (F.col("rows") > most))
    worst = bad.orderBy(F.col("rows").desc(), metrics.key).limit(5).collect()
    if worst:
        listed = ", ".join(f"{r[0]} ({r[1]})" for r in worst)
        raise ValueError(f"{' and '.join(metrics.joined)} would repeat rows of the table more than {most} times: {listed}")


def year_report(metrics: Metrics, spine: DataFrame, table: DataFrame) -> DataFrame:
    """(check, subject, value) of a year table and the metrics joined to it:
    ``repeated keys`` and ``keys off the spine`` per source, ``total of the
    metric`` and ``total in the table`` before and after the joins, and
    ``percent null`` per column of the table. Give it written metrics and the
    written table: it reads those, not the sources."""
    key, parts = metrics.key, []
    if metrics.rows is not None:
        parts.append(quality.key_report(metrics.rows, [f.name for f in metrics.frames], SOURCE, spine, key))
        columns = {_tall_name(f.name, c): c for f in metrics.frames for c in f.columns}
        parts.append(quality.totals_report(metrics.rows, "total of the metric", columns))
    for name, df in metrics.joined.items():
        parts.append(quality.key_report(df.withColumn(SOURCE, F.lit(name)), [name], SOURCE, spine, key))
        parts.append(quality.totals_report(df, "total of the metric", {c: c for c in df.columns if c != key}))
    parts.append(quality.totals_report(table, "total in the table", {c: c for c in table.columns if c != key}))
    return quality.reports([*parts, quality.null_report(table)])


def county_metrics(sources: Sources, refs: Refs, year: str) -> Metrics:
    jobs: list[tuple[str, Callable[[DataFrame, Refs, str], DataFrame]]] = [
        ("grants", county.grants),
        ("disbursements", county.disbursements),
        ("erate", county.erate),
        ("call_centers", county.call_centers),
        ("towers", county.towers),
    ]
    parts = []
    for name, job in jobs:
        if name in sources:
            df = job(sources[name], refs, year)
            parts.append((Frame(name, _but_key(df, "county"), repeats=bool(STEPS[name][year][1])), df))
    return Metrics("county", tall(parts, "county"), tuple(f for f, _ in parts), {})


def county_year_table(sources: Sources, refs: Refs, year: str) -> DataFrame:
    """County spine with every metric whose source is given."""
    return with_fy(year_table(refs.counties(), county_metrics(sources, refs, year)), year)


def _but_key(df: DataFrame, key: str) -> tuple[str, ...]:
    return tuple(c for c in df.columns if c not in (key, "frame"))


def city_metrics(
    sources: Sources,
    refs: Refs,
    year: str,
    *,
    home_state: str,
    agency: str,
    orders: dict[str, list[str]],
    repeat_rows: bool = True,
) -> Metrics:
    """Metrics of every source that is given, in job order.

    ``sources['claim_zips']`` gives the claims a zip lookup of their own.
    ``orders`` names the row order of the sources that need one: federal
    surplus, the donees of the state surplus, and certified businesses.

    Positions, temporary staff and residences that share a source are read in
    one scan. The employers of 21-22 extend the table. Prisons, and the
    maintenance rows of 20-21 (unless ``repeat_rows`` is false), are joined row
    by row.
    """
    s = sources
    claim_refs = replace(refs, zips=s["claim_zips"]) if "claim_zips" in s else refs
    jobs: dict[str, Callable[[], DataFrame]] = {
        "circuits": lambda: city.internet_circuits(s["circuits"], refs, year),
        "phones": lambda: city.phone_charges(*s["phones"], refs, year),
        "claims": lambda: city.health_claims(s["claims"], claim_refs, year),
        "fleet": lambda: city.fleet(s["fleet"], refs, year),
        "federal_surplus": lambda: city.federal_surplus(s["federal_surplus"], refs, year, order=orders.get("federal_surplus")),
        "state_surplus": lambda: city.state_surplus(s["state_surplus"], refs, year, bridge=s.get("donees"), order=orders.get("donees")),
        "marketplace": lambda: city.marketplace(s["marketplace"], refs, year, home_state=home_state),
        "certified": lambda: city.certified_businesses(s["certified"], refs, year, order=orders["certified"]),
        "positions": lambda: city.positions(s["positions"], refs, year),
        "residences": lambda: city.employee_residences(s["residences"], refs, year),
        "temporary": lambda: city.temporary_staff(s["temporary"], refs, year),
        "facilities": lambda: city.facilities(s["facilities"], refs, year, agency=agency),
        "expenses": lambda: city.expenses(s["expenses"], refs),
        "construction": lambda: city.construction(s["construction"], refs, year),
        "retirees": lambda: city.retiree_payments(s["retirees"], refs, year),
        "employers": lambda: city.retirement_employers(s["employers"], refs, year),
        "contributions": lambda: city.employer_contributions(s["contributions"], refs, year),
        "travel": lambda: city.travel(s["travel"], refs, year),
    }
    joined = {}
    if "prisons" in s:
        joined["prisons"] = city.private_prisons(*s["prisons"])
    if "expenses" in s and repeat_rows:
        joined["maintenance"] = city.maintenance_rows(s["expenses"], refs)
    shared = [n for n in ("positions", "residences", "temporary") if n in s and s[n] is s.get("positions")]
    staff = city.staff(s["positions"], refs, year) if len(shared) > 1 and ("residences" in shared or year != "21-22") else None
    parts = []
    for name, job in jobs.items():
        if name not in s:
            continue
        if staff is not None and name in shared:
            df = staff
            columns = {"residences": ("employee_residences",), "temporary": ("temporary_employees",)}.get(name)
            columns = columns or tuple(c for c in _but_key(staff, "city") if c not in ("employee_residences", "temporary_employees"))
        else:
            df = job()
            columns = _but_key(df, "city")
        if name == "expenses" and repeat_rows:
            columns = ("utility_bills_paid",)  # the maintenance rows are joined as they are
        repeats = bool(STEPS[name][year][1]) if name in STEPS else False
        parts.append((Frame(name, columns, repeats, extends=name == "employers" and year == "21-22"), df))
    return Metrics("city", tall(parts, "city"), tuple(f for f, _ in parts), joined)


def city_year_table(
    sources: Sources,
    refs: Refs,
    year: str,
    *,
    home_state: str,
    agency: str,
    orders: dict[str, list[str]],
    repeat_rows: bool = True,
) -> DataFrame:
    """City spine with every metric whose source is given; see :func:`city_metrics`."""
    metrics = city_metrics(sources, refs, year, home_state=home_state, agency=agency, orders=orders, repeat_rows=repeat_rows)
    return with_fy(year_table(refs.spine.drop("ord"), metrics), year)


def all_years(tables: list[DataFrame], stray: list[str] | None = None) -> DataFrame:
    """Year tables in one. Columns a year lacks are null; stray columns go."""
    united = union_years([t.drop(*(stray or [])) for t in tables])
    return united.withColumn(YEAR, F.col(YEAR).cast("string"))


def all_years_on_disk(
    spark: SparkSession, tables: dict[str, DataFrame], year_path: str, out_path: str, stray: list[str] | None = None
) -> DataFrame:
    """Write each year, read all years back, drop stray columns, write the
    result and return it. Years already in ``year_path`` stay."""
    for label, table in tables.items():
        write_year(table, year_path, label)
    write_table(drop_if_all_present(read_years(spark, year_path), stray or []), out_path)
    return spark.read.parquet(out_path)
