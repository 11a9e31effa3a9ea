"""Metrics per city. Each job returns ``city`` and its metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numbers
from plumbline.functions.dates import endpoint_in_range, fiscal_bounds
from plumbline.functions.text import MONEY, parse_money, strip_commas
from plumbline.operators import clean
from plumbline.operators.aggregates import aggregate, per_group, pre_sum
from plumbline.operators.joins import bridge_first, enrich
from plumbline.operators.locate import address_zip, city_from_address, resolve_location
from plumbline.plans import claims as claim_sheets
from plumbline.plans.cleaning import Refs, aggregate_cleaned, apply_steps, steps_of
from plumbline.plans.fixed import (
    CALENDAR_STAMPS,
    CERTIFIED_CITIES,
    FEDERAL_SURPLUS_DROP,
    RETIREE_DROP_ZIPS,
    RETIREMENT_YEAR,
    STEPS,
)
from plumbline.sources.ordinals import drop_ordinals


def internet_circuits(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: inventory_id, city, retail in 21-22; zip, circuits, charge before.

    The circuits of 18-19 are halved: each was listed by both owners.
    """
    by_city = {"city": F.upper("city")}
    steps = STEPS["circuits"][year][0]
    if year == "21-22":
        spec = {"internet_circuits": ("inventory_id", "nunique"), "value_of_internet_circuits": ("retail", "money")}
        # in upper case by its steps
        return aggregate_cleaned(fact, "city", f"{steps} U", refs, spec, texts=("inventory_id",))
    per_zip = pre_sum(fact.withColumn("charge", F.col("charge").cast(MONEY)), ["zip"], ["circuits", "charge"])
    spec = {"internet_circuits": ("circuits", "sum"), "value_of_internet_circuits": ("charge", "exact")}
    out = aggregate(apply_steps(per_zip, "city", steps, refs, present=True), by_city, spec, present=True)
    if year == "18-19":
        out = out.withColumn("internet_circuits", numbers.ceil_half(F.col("internet_circuits")))
    return out


def phone_charges(local: DataFrame, internet: DataFrame, refs: Refs, year: str = "21-22") -> DataFrame:
    """local and internet: city, charges."""
    out = []
    for fact, job, name in (
        (local, "phones_local", "local_digital_phone_charges"),
        (internet, "phones_internet", "internet_phone_charges"),
    ):
        out.append(aggregate_cleaned(fact, "city", STEPS[job][year][0], refs, {name: ("charges", "money")}))
    # both sides are grouped, so no key is null
    return out[0].join(out[1], "city", "full_outer")


def health_claims(sheets: dict[str, DataFrame], refs: Refs, year: str) -> DataFrame:
    """sheets: zip, enrollee, dependents under each name of the four sheets."""
    sheets = dict(sheets)
    if year == "18-19":
        sheets["pharmacy_active"] = claim_sheets.strip_zip(sheets["pharmacy_active"])
    if year == "20-21":
        sheets["medical_retiree"] = sheets["medical_retiree"].na.fill(0)
    sums = {name: (name, "sum") for name in claim_sheets.TOTALS}
    per_zip = claim_sheets.claims_by_zip(sheets)
    if year == "21-22":
        per_zip = aggregate(claim_sheets.strip_zip(per_zip), ["zip"], sums)
    before, after = STEPS["claims"][year]
    per_zip = per_zip.filter(F.col("zip").isNotNull())
    totals = {name: (name, "exact") for name in claim_sheets.TOTALS}
    out = aggregate(apply_steps(per_zip, "city", before, refs, present=True), ["city"], totals, present=True)
    return apply_steps(out, "city", after, refs)


def fleet(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: city, asset and three costs as text, ``--`` for none."""
    costs = {
        "total_operating_cost": "operating_cost",
        "fleet_maintenance_cost": "maintenance_cost",
        "fuel_cost": "fuel_cost",
    }
    df = fact.withColumns({c: numbers.sentinel_to_zero(F.col(c), as_type=MONEY) for c in costs.values()})
    # the sentinel is a number in every column, and a number is no city
    df = df.withColumn("city", F.nullif("city", F.lit("--")))
    spec = {name: (c, "money") for name, c in costs.items()}
    return aggregate_cleaned(df, "city", STEPS["fleet"][year][0], refs, {**spec, "fleet_assets": ("asset", "count")})


def private_prisons(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """fact: facility, reimbursement; locations: facility, city and others.
    One row per matching pair: nothing is aggregated."""
    places = locations.withColumnRenamed("facility", "_facility")
    return (
        fact.join(places, F.col("facility").eqNullSafe(F.col("_facility")), "inner")
        .drop("facility", "_facility")
        .withColumnRenamed("reimbursement", "private_prison_contract_spend")
    )


def federal_surplus(fact: DataFrame, refs: Refs, year: str, *, order: list[str] | None = None) -> DataFrame:
    """fact: agency, invoice, acquisition_cost, service_charge, items; savings
    instead of the costs in 20-21. ``order`` numbers the rows to leave out."""
    df = fact
    if year != "20-21":
        df = clean.drop_null(df, ["agency"])
        if year == "21-22":
            df = clean.drop_null(df, ["invoice"])
        if order and year in FEDERAL_SURPLUS_DROP:
            df = drop_ordinals(df, FEDERAL_SURPLUS_DROP[year], order)
        df = df.withColumn("savings", F.col("acquisition_cost").cast(MONEY) - F.col("service_charge").cast(MONEY))
    spec = {"federal_surplus_savings": ("savings", "money"), "federal_surplus_items": ("items", "sum")}
    return aggregate_cleaned(df.withColumnRenamed("agency", "city"), "city", STEPS["federal_surplus"][year][0], refs, spec)


def state_surplus(
    fact: DataFrame, refs: Refs, year: str, *, bridge: DataFrame | None = None, order: list[str] | None = None
) -> DataFrame:
    """fact: line_items with city and savings (text), or with donee and four
    money texts in 19-20 and 20-21, whose city comes from ``bridge`` (donee,
    city, in ``order``). Line items are summed in 18-19 and counted later."""
    if year in ("19-20", "20-21"):
        parts = ("direct_cost", "federal_cost", "overseas_cost", "service_charge")
        texts = [parse_money(F.col(c), as_type="string") for c in parts]
        direct, federal, overseas, charge = (t.try_cast(MONEY) for t in texts)
        total = ((direct + federal + overseas) - charge).cast("string")
        # the first part that is null, or is no number, stays as it is until excluded cities are out
        amount = reduce(lambda rest, t: F.when(t.try_cast(MONEY).isNull(), t).otherwise(rest), reversed(texts), total)
        df = fact.select("donee", "line_items", amount.alias("amount"))
        df = bridge_first(df, bridge, "donee", "city", order)
    else:
        df = fact.withColumn("amount", parse_money(F.col("savings"), as_type="string"))
    items = "sum" if year == "18-19" else "count"
    spec = {"state_surplus_items": ("line_items", items), "state_surplus_savings": ("amount", "money")}
    return aggregate_cleaned(df, "city", STEPS["state_surplus"][year][0], refs, spec)


def marketplace(fact: DataFrame, refs: Refs, year: str, *, home_state: str) -> DataFrame:
    """fact: state, city, amount (text), vendor."""
    df = fact.filter(F.col("state") == home_state).select("city", "amount", "vendor")
    df = df.withColumn("amount", strip_commas(F.col("amount")))
    spec = {"marketplace_spend": ("amount", "money"), "vendors": ("vendor", "nunique")}
    return aggregate_cleaned(df, "city", STEPS["marketplace"][year][0], refs, spec, texts=("vendor",))


# Years whose certificates are chosen by date and located by address.
DATED = ("18-19", "19-20")


def certified_places(fact: DataFrame, years: tuple[str, ...], *, order: list[str]) -> DataFrame:
    """(rules, place, businesses) over the first row per tax id, for all years
    from one pass: place is the zip of the address under the year's own name
    where certificates are dated, else the city under ``all``."""
    taken = {}
    for year in years:
        if year in DATED:
            active = endpoint_in_range(F.col("effective_on"), F.col("expire_on"), *fiscal_bounds(year), CALENDAR_STAMPS)
            taken[year] = (active, {"business": F.col("business"), "place": address_zip(F.col("address"))})
        else:
            taken["all"] = (None, {"business": F.col("business"), "place": F.col("city")})
    firsts = clean.first_rows(fact, ["tax_id"], order, taken)
    named = [F.when(F.col(f"`{n}`").isNotNull(), F.struct(F.lit(n).alias("rules"), F.col(f"`{n}`.business"), F.col(f"`{n}`.place"))) for n in taken]
    rows = firsts.select(F.explode(F.array_compact(F.array(*named))).alias("_r")).select("_r.*")
    return per_group(rows, ["rules", "place"], [F.count("business").alias("businesses")])


def certified_businesses(
    fact: DataFrame, refs: Refs, year: str, *, order: list[str], places: DataFrame | None = None
) -> DataFrame:
    """fact: tax_id, business, city; effective_on, expire_on and address
    instead of the city in 18-19 and 19-20. ``places``: those of several years
    that share the source, written."""
    rows = certified_places(fact, (year,), order=order) if places is None else places
    if year in DATED:
        df = rows.filter(F.col("rules") == year).select(F.col("place").alias("address"), "businesses")
        df = city_from_address(df, "address", refs.zips)
    else:
        df = rows.filter(F.col("rules") == "all").select(F.col("place").alias("city"), "businesses")
    df = apply_steps(df, "city", STEPS["certified"][year][0], refs, inline=CERTIFIED_CITIES, present=True)
    return aggregate(df, ["city"], {"minority_owned_businesses_registered": ("businesses", "sum")}, present=True)


def positions(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: emp_type, city, position, vacant, fte, and salary and health in
    21-22 or base_rate and pay_code before."""
    df = fact.filter((F.col("emp_type") == 1) | (F.col("emp_type") == 2))
    if year != "21-22":
        pay = numbers.annualize_hourly(F.col("base_rate"), F.col("fte"), F.col("emp_type"), F.col("pay_code"))
        df = df.withColumn("salary", pay)
    df = df.withColumn("vacant", numbers.flag_to_int(F.col("vacant")))
    before, after = STEPS["positions"][year]
    spec = {
        "positions": ("position", "nunique"),
        "vacancies": ("vacant", "sum"),
        "annualized_salary": ("salary", "money"),
        "employees": ("fte", "quantity"),
    }
    if year == "21-22":
        spec["employer_insurance_contributions"] = ("health", "money")
    out = aggregate(apply_steps(df, "city", before, refs, present=True), ["city"], spec, present=True)
    return apply_steps(out, "city", after, refs)


def temporary_staff(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: emp_type, city, position, vacant. Vacant rows count in 18-19."""
    df = fact.filter((F.col("emp_type") == 4) | (F.col("emp_type") == 5)).select("city", "position", "vacant")
    before, after = STEPS["temporary"][year]
    out = aggregate(apply_steps(df, "city", before, refs, present=True), ["city"], {"temporary_employees": ("position", "nunique")}, present=True)
    return apply_steps(out, "city", after, refs)


def employee_residences(fact: DataFrame, refs: Refs, year: str = "21-22") -> DataFrame:
    """fact: home_city, salary."""
    before, after = STEPS["residences"][year]
    df = apply_steps(fact.select(F.col("home_city").alias("city"), "salary"), "city", before, refs, present=True)
    out = aggregate(df, ["city"], {"employee_residences": ("salary", "count")}, present=True)
    return apply_steps(out, "city", after, refs)


def staff(fact: DataFrame, refs: Refs, year: str) -> DataFrame | None:
    """Positions, temporary staff and (in 21-22) residences from one scan.

    Each has its own rows, key and cleaning order; a row becomes one for each
    of the three that takes it, and one aggregation by frame and city serves
    all. Returns ``frame`` (positions, temporary, residences), ``city`` and the
    metrics of all three, null in rows of another frame; None where a cleaning
    step takes a join.
    """
    kind = F.col("emp_type")
    wanted = {"positions": ("city", (kind == 1) | (kind == 2)), "temporary": ("city", (kind == 4) | (kind == 5))}
    if year in STEPS["residences"]:
        wanted["residences"] = ("home_city", F.lit(True))
    cleaned = {name: steps_of(F.col(key), STEPS[name][year][0], refs) for name, (key, _) in wanted.items()}
    if None in cleaned.values():
        return None
    pay = F.col("salary")
    if year != "21-22":
        pay = numbers.annualize_hourly(F.col("base_rate"), F.col("fte"), kind, F.col("pay_code"))
    taken = F.array(*[
        F.when(F.coalesce(mine & cleaned[name][1], F.lit(False)), F.struct(F.lit(name).alias("frame"), cleaned[name][0].alias("city")))
        for name, (_, mine) in wanted.items()
    ])
    fields = {"position": F.col("position"), "flag": numbers.flag_to_int(F.col("vacant")), "salary": pay.cast(MONEY), "fte": F.col("fte")}
    if year == "21-22":
        fields["health"] = F.col("health")
    rows = fact.select(F.explode(F.array_compact(taken)).alias("_t"), *[c.alias(n) for n, c in fields.items()]).select("_t.*", *fields)
    # residences count no positions: without them fewer rows are kept apart
    rows = rows.withColumn("position", F.when(F.col("frame") != "residences", F.col("position")))
    spec = {
        "positions": ("position", "nunique"),
        "vacancies": ("flag", "sum"),
        "annualized_salary": ("salary", "money"),
        "employees": ("fte", "quantity"),
        **({"employer_insurance_contributions": ("health", "money")} if year == "21-22" else {}),
        "employee_residences": ("salary", "count"),
    }
    sums = aggregate(rows, ["frame", "city"], spec, present=True)
    mine = {"temporary_employees": ("temporary", "positions")}
    if year == "21-22":
        mine["employee_residences"] = ("residences", "employee_residences")
    mine |= {n: ("positions", n) for n in spec if n != "employee_residences"}
    upper = [name for name in wanted if STEPS[name][year][1] == "U"]
    key = F.when(F.col("frame").isin(*upper), F.upper("city")).otherwise(F.col("city")) if upper else F.col("city")
    return sums.select("frame", key.alias("city"), *[F.when(F.col("frame") == f, F.col(c)).alias(n) for n, (f, c) in mine.items()])


def facilities(
    fact: DataFrame, refs: Refs, year: str, *, agency: str, keep_excluded: bool | None = None
) -> DataFrame:
    """fact: agency, id, city, square_feet, land, structure, and utilities and
    operating before 20-21.

    In 20-21 excluded cities are kept, as the filtered table was not the one
    aggregated; ``keep_excluded=False`` leaves them out.
    """
    df = fact.filter(F.col("agency") == agency)
    if year == "21-22":
        df = clean.fill_null(df.withColumn("id", F.col("id").cast("string")), "0", ["id"])
    steps = STEPS["facilities"][year][0]
    if year == "20-21" and keep_excluded in (None, True):
        steps = steps.replace(" X", "")
    spec = {
        "facilities_owned": ("id", "count"),
        "owned_square_footage": ("square_feet", "money"),
        "land_value": ("land", "money"),
        "structure_value": ("structure", "money"),
    }
    if year in ("18-19", "19-20"):
        spec["utility_bills_paid"] = ("utilities", "money")
        spec["building_maintenance"] = ("operating", "money")
    return aggregate_cleaned(df, "city", steps, refs, spec)


# Categories of the operating-expense source.
UTILITIES, MAINTENANCE, DIRECT_TOTAL = "Utilities", "O&M Expenses", "Total Direct Expenses"


def expenses(fact: DataFrame, refs: Refs, year: str = "20-21") -> DataFrame:
    """fact: city, category, amount. Both metrics from one aggregation; a
    metric is null for a city without rows of its category."""
    df = clean.filter_ne(apply_steps(fact, "city", STEPS["expenses"][year][0], refs), "category", DIRECT_TOTAL)

    def part(category: str):
        mine = F.col("category") == category
        total = F.coalesce(F.sum(F.when(mine, F.col("amount").cast(MONEY))), F.lit(0)).cast("double")
        return F.when(F.count_if(mine) > 0, total)

    return (
        df.filter(F.col("city").isNotNull() & F.col("category").isin(UTILITIES, MAINTENANCE))
        .groupBy("city")
        .agg(part(UTILITIES).alias("utility_bills_paid"), part(MAINTENANCE).alias("building_maintenance"))
    )


def maintenance_rows(fact: DataFrame, refs: Refs) -> DataFrame:
    """Maintenance expenses of 20-21 row by row, with their category."""
    df = apply_steps(fact, "city", STEPS["expenses"]["20-21"][0], refs)
    amount = F.col("amount").cast("double").alias("building_maintenance")
    return df.filter(F.col("category") == MAINTENANCE).select("city", "category", amount)


def attach_expenses(table: DataFrame, fact: DataFrame, refs: Refs, *, repeat_rows: bool = True) -> DataFrame:
    """Add the expense metrics of 20-21 to a city table.

    The maintenance rows were joined without being aggregated, so a city row
    repeats once per maintenance row and gains its category;
    ``repeat_rows=False`` adds the aggregate instead.
    """
    both = expenses(fact, refs)
    if not repeat_rows:
        return table.join(both, "city", "left")
    return table.join(both.select("city", "utility_bills_paid"), "city", "left").join(maintenance_rows(fact, refs), "city", "left")


def construction(fact: DataFrame, refs: Refs, year: str = "21-22") -> DataFrame:
    """fact: city, funds."""
    return aggregate_cleaned(fact, "city", STEPS["construction"][year][0], refs, {"fixed_capital_outlay": ("funds", "money")})


def retiree_payments(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: zip, payment, payees, and fiscal_year in 19-20 and 20-21. The
    zip lookup leads in 21-22, so its cities without payees get 0."""
    if year in RETIREMENT_YEAR:
        fact = fact.filter(F.col("fiscal_year") == RETIREMENT_YEAR[year])
    steps = STEPS["retirees"][year][0]
    df = pre_sum(fact.withColumn("payment", F.col("payment").cast(MONEY)), ["zip"], ["payment", "payees"])
    if year == "21-22":
        df = clean.exclude_values(df, "zip", list(RETIREE_DROP_ZIPS[year]))
        df = apply_steps(enrich(refs.zips.select("zip", "city"), df, "zip", "zip"), "city", steps, refs, present=True)
    else:
        df = clean.replace_values(df, ["zip"], refs.lookup("replacements"))
        df = apply_steps(df, "city", steps, refs, drop_zips=RETIREE_DROP_ZIPS[year], present=True)
    return aggregate(
        df, ["city"], {"benefits_paid_to_retirees": ("payment", "exact"), "number_of_payees": ("payees", "sum")}, present=True
    )


def _of_year(fact: DataFrame, year: str) -> DataFrame:
    return fact.filter(F.col("fiscal_year") == RETIREMENT_YEAR[year]) if year in RETIREMENT_YEAR else fact


def retirement_employers(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: agency, city, contribution, and fiscal_year in 19-20 and 20-21.
    Before 21-22 the contributions come from the same pass."""
    spec = {"employers_using_retirement_system": ("agency", "nunique")}
    if year != "21-22":
        spec["employer_contributions"] = ("contribution", "money")
    return aggregate_cleaned(_of_year(fact, year), "city", STEPS["employers"][year][0], refs, spec, texts=("agency",))


def employer_contributions(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact as for the employers; the total row at its end is already off."""
    if year != "21-22":
        return retirement_employers(fact, refs, year).select("city", "employer_contributions")
    return aggregate_cleaned(fact, "city", STEPS["contributions"][year][0], refs, {"employer_contributions": ("contribution", "money")})


def travel(fact: DataFrame, refs: Refs, year: str) -> DataFrame:
    """fact: destination (free text), amount.

    Amounts are summed per distinct text first, so the search for a place
    sees each text once.
    """
    known = fact.filter(F.col("destination").isNotNull()).withColumn("amount", F.col("amount").cast(MONEY))
    per_text = pre_sum(known, ["destination"], ["amount"])
    df = resolve_location(per_text, "destination", refs.spine, "city").select("city", "amount")
    df = apply_steps(df, "city", STEPS["travel"][year][0], refs, present=True)
    return aggregate(df, ["city"], {"travel_spend": ("amount", "exact")}, present=True)
