"""Metric jobs. Each query runs every year's rules over the whole source and
labels the result with the year whose rules it used."""

from __future__ import annotations



from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.joins import ALL_SHEETS, COMBINED, SHEETS
from catalog.registry import LINE_KEY, LINE_ORDER, REFS, add, cleaned, ctes, fact, money, refs, whole
from catalog.scalars import CITY_HIT, COUNTY_HIT, WORDS, ZIP
from plumbline.operators.joins import attach_metric
from plumbline.operators.unions import union_years
from plumbline.plans import city_jobs as city
from plumbline.plans import county_jobs as county
from plumbline.plans.fixed import YEARS
from plumbline.session import written

Y18, Y19, Y20, Y21 = YEARS


def _each(job, years=YEARS) -> DataFrame:
    """One frame from ``job(year)`` for all years, labelled."""
    return union_years([job(y).withColumn("rules", F.lit(y)) for y in years])


PARTS: dict[str, dict[str, str]] = {}


def _rules(job: str, parts: dict[str, str]) -> str:
    """``{year: select list and source}`` as one SQL union, labelled. The
    parts are kept for the year tables."""
    PARTS[job] = parts
    return " UNION ALL BY NAME ".join(f"SELECT '{y}' AS rules, {body}" for y, body in parts.items())


def _grouped(source: str, key: str, metrics: str, by: str | None = None) -> str:
    by = by or key
    return f"{by} AS {key}, {metrics} FROM {source} t WHERE {by} IS NOT NULL GROUP BY {by}"


def _after(body: str, key: str, expr: str) -> str:
    """Rewrite the key of an aggregated result."""
    return f"* REPLACE ({expr} AS {key}) FROM (SELECT {body})"


SITE = f"CAST(count(DISTINCT inventory_id) AS BIGINT) AS internet_circuits, {money('retail')} AS value_of_internet_circuits"
ZIPPED = f"{whole('circuits')} AS internet_circuits, {money('charge')} AS value_of_internet_circuits"
HALVED = f"CAST(ceil(coalesce(sum(circuits), 0) / 2) AS BIGINT) AS internet_circuits, {money('charge')} AS value_of_internet_circuits"


@add(
    "internet_circuits", "J1",
    f"{ctes('site_circuits', 'zip_circuits', *REFS)} "
    + _rules("circuits", 
        {
            Y18: _grouped(cleaned("zip_circuits", "city", "J S R X"), "city", HALVED, "upper(city)"),
            Y19: _grouped(cleaned("zip_circuits", "city", "J S R X"), "city", ZIPPED, "upper(city)"),
            Y20: _grouped(cleaned("zip_circuits", "city", "J R X U S"), "city", ZIPPED, "upper(city)"),
            Y21: _grouped(cleaned("site_circuits", "city", "U S R X", texts=("inventory_id",)), "city", SITE, "upper(city)"),
        }
    ),
)
def _(spark, sf):
    r = refs(spark, sf)
    sources = {y: fact(spark, sf, "site_circuits" if y == Y21 else "zip_circuits") for y in YEARS}
    return _each(lambda y: city.internet_circuits(sources[y], r, y))


@add(
    "grants_by_county", "J2",
    f"{ctes('county_facts', *REFS)} "
    + _rules("grants", {y: _grouped(cleaned("county_facts", "county", "S C"), "county", f"{money('final_award')} AS grants_awarded") for y in YEARS}),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "county_facts")
    return _each(lambda y: county.grants(rows, r, y))


PAID = money("wireless + nonwireless + prepaid_wireless + supplemental + special")


@add(
    "disbursements_by_county", "J3",
    f"{ctes('county_facts', *REFS)} "
    + _rules("disbursements", 
        {
            y: _grouped(
                cleaned("county_facts", "county", "S C"), "county", f"{money('total') if y == Y18 else PAID} AS e911_disbursements"
            )
            for y in YEARS
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "county_facts")
    return _each(lambda y: county.disbursements(rows, r, y))


ERATE = f"{money('''CAST(trim(replace(ltrim(authorized, '$'), ',', '')) AS decimal(18,2))''')} AS erate_disbursements"


@add(
    "erate_by_county", "J4",
    f"{ctes('erate', *REFS)} "
    + _rules("erate", 
        {
            Y18: _grouped(
                cleaned("erate", "county", "S C R M", inline={"Dade County": "Miami-Dade County"}), "county", ERATE, "replace(county, ',', '')"
            ),
            Y19: _grouped(cleaned("erate", "county", "S C R"), "county", ERATE, "replace(county, ',', '')"),
            Y20: _grouped(cleaned("erate", "county", "S C R"), "county", ERATE, "replace(county, ',', '')"),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "erate")
    return _each(lambda y: county.erate(rows, r, y), YEARS[:3])


@add(
    "call_centers_by_county", "J5",
    f"{ctes('county_facts', *REFS)} "
    + _rules("call_centers", 
        {y: _grouped(cleaned("county_facts", "county", "S C R"), "county", "CAST(count(center) AS BIGINT) AS e911_circuits") for y in YEARS}
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "county_facts")
    return _each(lambda y: county.call_centers(rows, r, y))


# County spellings of the tower source, as in plans/fixed.py.
TOWERS = {"Dade County": "Miami-Dade County", "Saint Lucie County": "St. Lucie County", "De Soto County": "Desoto County"}
TOWER_COUNT = "CAST(count(tower) AS BIGINT) AS radio_towers"


def _towers(before: str, after: str) -> str:
    counted = f"(SELECT {_grouped(cleaned('towers', 'county', before, inline=TOWERS), 'county', TOWER_COUNT)})"
    return f"county, radio_towers FROM {cleaned(counted, 'county', after)}"


@add(
    "radio_towers_by_county", "J6",
    f"{ctes('towers', *REFS)} "
    + _rules("towers", {Y18: _towers("M", "S C R"), Y19: _towers("M", "S C R"), Y20: _towers("M", "S C R"), Y21: _towers("M S", "C R")}),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "towers")
    return _each(lambda y: county.towers(rows, r, y))


LOCAL = _grouped(cleaned("phones_local", "city", "N L U S X R"), "city", f"{money('charges')} AS local_digital_phone_charges")
INTERNET = _grouped(cleaned("phones_internet", "city", "N L U S R X"), "city", f"{money('charges')} AS internet_phone_charges")
PARTS["phones"] = {
    Y21: f"""coalesce(a.city, b.city) AS city, local_digital_phone_charges, internet_phone_charges
      FROM (SELECT {LOCAL}) a FULL OUTER JOIN (SELECT {INTERNET}) b ON a.city = b.city"""
}


@add("phone_charges", "J7", f"{ctes('phones_local', 'phones_internet', *REFS)} SELECT {PARTS['phones'][Y21]}")
def _(spark, sf):
    return city.phone_charges(fact(spark, sf, "phones_local"), fact(spark, sf, "phones_internet"), refs(spark, sf))


CLAIM_SUMS = ", ".join(f"sum({c}) AS {c}" for c in ("medical_claims", "pharmacy_claims", "total_claims"))
CLAIM_MONEY = ", ".join(f"{money(c)} AS {c}" for c in ("medical_claims", "pharmacy_claims", "total_claims"))


def _claims(year: str, steps: str, after: str = "") -> str:
    per_zip = f"(SELECT zip, {CLAIM_SUMS} FROM combined{year[:2]} WHERE zip IS NOT NULL GROUP BY zip)"
    body = _grouped(cleaned(per_zip, "city", steps, zips="customer_zips"), "city", CLAIM_MONEY)
    return _after(body, "city", "trim(city)") if after else body


def _combined(year: str, **changed: str) -> str:
    """The four-way join under names of its own, with a sheet changed."""
    text = COMBINED
    for name, body in changed.items():
        text = text.replace(f"FROM {name})", f"FROM {body})")
    for name in ("mr", "me", "pr", "pe", "medical", "pharmacy", "combined"):
        text = text.replace(f"{name} AS (", f"{name}{year[:2]} AS (").replace(f"FROM {name} ", f"FROM {name}{year[:2]} {name} ")
        text = text.replace(f"JOIN {name} ", f"JOIN {name}{year[:2]} {name} ")
    return text


FILLED = "(SELECT zip, coalesce(enrollee, 0) AS enrollee, coalesce(dependents, 0) AS dependents FROM medical_retiree)"
STRIPPED = "(SELECT trim(zip) AS zip, enrollee, dependents FROM pharmacy_active)"


CLAIM_CTES = {
    Y18: _combined(Y18, pharmacy_active=STRIPPED),
    Y19: _combined(Y19),
    Y20: _combined(Y20, medical_retiree=FILLED),
    Y21: f"{_combined(Y21).replace('combined21 AS (', 'raw21 AS (')}, combined21 AS (SELECT * REPLACE (trim(zip) AS zip) FROM raw21)",
}


@add(
    "health_claims", "J8 E7",
    f"{ALL_SHEETS}, {ctes('customer_zips', 'replacements').removeprefix('WITH ')}, {', '.join(CLAIM_CTES.values())} "
    + _rules("claims", 
        {Y18: _claims(Y18, "J N S R"), Y19: _claims(Y19, "J N R", "S"), Y20: _claims(Y20, "J N R", "S"), Y21: _claims(Y21, "J N R S")}
    ),
)
def _(spark, sf):
    r = refs(spark, sf, zips="customer_zips")
    sheets = {name: fact(spark, sf, name).drop("fy") for name in SHEETS}
    return _each(lambda y: city.health_claims(sheets, r, y))


def _cost(c):
    return money(f"CASE {c} WHEN '--' THEN 0 ELSE CAST({c} AS decimal(18,2)) END")


FLEET = f"""{_cost('operating_cost')} AS total_operating_cost, {_cost('maintenance_cost')} AS fleet_maintenance_cost,
    {_cost('fuel_cost')} AS fuel_cost, CAST(count(asset) AS BIGINT) AS fleet_assets"""
FLEET_ROWS = "(SELECT * REPLACE (nullif(city, '--') AS city) FROM fleet)"


@add(
    "fleet_costs", "J9",
    f"{ctes('fleet', *REFS)} "
    + _rules("fleet", 
        {
            Y18: _grouped(cleaned(FLEET_ROWS, "city", "U S R"), "city", FLEET),
            Y19: _grouped(cleaned(FLEET_ROWS, "city", "S U R"), "city", FLEET),
            Y20: _grouped(cleaned(FLEET_ROWS, "city", "R S"), "city", FLEET),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "fleet")
    return _each(lambda y: city.fleet(rows, r, y), YEARS[:3])


@add(
    "private_prison_spend", "J10",
    f"""{ctes('prisons', 'prison_locations')} SELECT CAST(reimbursement AS DOUBLE) AS private_prison_contract_spend, city, district
    FROM prisons JOIN prison_locations USING (facility)""",
)
def _(spark, sf):
    out = city.private_prisons(fact(spark, sf, "prisons"), fact(spark, sf, "prison_locations"))
    return out.withColumn("private_prison_contract_spend", F.col("private_prison_contract_spend").cast("double"))


FEDERAL = f"{money('savings')} AS federal_surplus_savings, {whole('items')} AS federal_surplus_items"
DIFFERENCE = "acquisition_cost - service_charge AS savings, items"


def _federal(rows: str, steps: str) -> str:
    return _grouped(cleaned(rows, "city", steps), "city", FEDERAL)


NUMBERED = f"*, row_number() OVER (ORDER BY {LINE_KEY}) - 1 AS n FROM federal_surplus WHERE agency IS NOT NULL"


@add(
    "federal_surplus", "J11",
    f"{ctes('federal_surplus', *REFS)} "
    + _rules("federal_surplus", 
        {
            Y18: _federal(f"(SELECT agency AS city, {DIFFERENCE} FROM (SELECT {NUMBERED}) WHERE n <> 177)", "S R"),
            Y19: _federal(f"(SELECT agency AS city, {DIFFERENCE} FROM federal_surplus WHERE agency IS NOT NULL)", "S R"),
            Y20: _federal("(SELECT agency AS city, savings, items FROM federal_surplus)", "R R S"),
            Y21: _federal(
                f"(SELECT agency AS city, {DIFFERENCE} FROM (SELECT {NUMBERED} AND invoice IS NOT NULL) WHERE n NOT BETWEEN 5 AND 13)",
                "R R S",
            ),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "federal_surplus")
    return _each(lambda y: city.federal_surplus(rows, r, y, order=LINE_ORDER))


def _dollars(c):
    return f"CAST(replace(ltrim({c}, '$'), ',', '') AS decimal(18,2))"


STATE_SAVINGS = f"{money(_dollars('savings'))} AS state_surplus_savings"
STATE_PARTS = f"""{money(f"{_dollars('direct_cost')} + {_dollars('federal_cost')} + {_dollars('overseas_cost')} - {_dollars('service_charge')}")}
    AS state_surplus_savings"""
BY_DONEE = """(SELECT f.* EXCLUDE (city), d.city FROM state_surplus f LEFT JOIN
    (SELECT donee, arg_min(city, seq) AS city FROM donees WHERE city IS NOT NULL GROUP BY donee) d ON f.donee = d.donee)"""
COUNTED = "CAST(count(line_items) AS BIGINT) AS state_surplus_items"


@add(
    "state_surplus", "J12",
    f"{ctes('state_surplus', 'donees', *REFS)} "
    + _rules("state_surplus", 
        {
            Y18: _grouped(cleaned("state_surplus", "city", "S U R X"), "city", f"{whole('line_items')} AS state_surplus_items, {STATE_SAVINGS}"),
            Y19: _grouped(cleaned(BY_DONEE, "city", "S R X"), "city", f"{COUNTED}, {STATE_PARTS}"),
            Y20: _grouped(cleaned(BY_DONEE, "city", "S R X"), "city", f"{COUNTED}, {STATE_PARTS}"),
            Y21: _grouped(cleaned("state_surplus", "city", "S R X"), "city", f"{COUNTED}, {STATE_SAVINGS}"),
        }
    ),
)
def _(spark, sf):
    r, rows, donees = refs(spark, sf), fact(spark, sf, "state_surplus"), fact(spark, sf, "donees")
    return _each(lambda y: city.state_surplus(rows, r, y, bridge=donees, order=["seq"]))


MARKET = f"""{money("CAST(replace(amount, ',', '') AS decimal(18,2))")} AS marketplace_spend, CAST(count(DISTINCT vendor) AS BIGINT) AS vendors"""
AT_HOME = "(SELECT city, amount, vendor FROM spend WHERE state = 'HS')"


def _market(steps: str) -> str:
    return _grouped(cleaned(AT_HOME, "city", steps, texts=("vendor",)), "city", MARKET)


@add(
    "marketplace_spend", "J13",
    f"{ctes('spend', *REFS)} "
    + _rules("marketplace", {Y18: _market("U S R X"), Y19: _market("U S R X"), Y20: _market("U S R X"), Y21: _market("U R X S")}),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "spend")
    return _each(lambda y: city.marketplace(rows, r, y, home_state="HS"))


MARKET_ROWS = _market("U R X S")


@add(
    "marketplace_spend_on_spine", "J13 D1 C16",
    f"""{ctes('spend', *REFS)} SELECT s.city, s.county, m.marketplace_spend, m.vendors, '21-22' AS fy
    FROM spine s LEFT JOIN (SELECT {MARKET_ROWS}) m ON s.city = m.city""",
)
def marketplace_on_spine(spark, sf):
    r = refs(spark, sf)
    metric = city.marketplace(fact(spark, sf, "spend"), r, Y21, home_state="HS")
    return attach_metric(r.spine, metric, "city").drop("ord").withColumn("fy", F.lit(Y21))


CERTIFIED_MAP = {"FERN": "FERN PARK"}
BUSINESSES = "CAST(count(business) AS BIGINT) AS minority_owned_businesses_registered"
ONE_PER_TAX_ID = f"QUALIFY row_number() OVER (PARTITION BY tax_id ORDER BY {LINE_KEY}) = 1"


def _active(first: str, last: str, gap: str | None) -> str:
    skip = f" AND {{c}} <> DATE '{gap}'" if gap else ""
    test = f"({{c}} BETWEEN DATE '{first}' AND DATE '{last}'{skip})"
    return f"{test.format(c='effective_on')} OR {test.format(c='expire_on')}"


def _certified(first: str, last: str, gap: str | None = None) -> str:
    rows = f"(SELECT business, {ZIP} AS zip FROM (SELECT * FROM certified WHERE {_active(first, last, gap)} {ONE_PER_TAX_ID}))"
    return _grouped(cleaned(rows, "city", "J U S R X"), "city", BUSINESSES)


FIRST_ROWS = f"(SELECT * FROM certified {ONE_PER_TAX_ID})"


@add(
    "certified_businesses", "J14",
    f"{ctes('certified', *REFS)} "
    + _rules("certified", 
        {
            Y18: _certified("2018-07-01", "2019-06-30"),
            Y19: _certified("2019-07-01", "2020-06-30", "2020-06-29"),
            Y20: _grouped(cleaned(FIRST_ROWS, "city", "U S R M X S", inline=CERTIFIED_MAP), "city", BUSINESSES),
            Y21: _grouped(cleaned(FIRST_ROWS, "city", "U R M X S", inline=CERTIFIED_MAP), "city", BUSINESSES),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "certified")
    places = written(city.certified_places(rows, YEARS, order=LINE_ORDER), "certified-places")
    return _each(lambda y: city.certified_businesses(rows, r, y, order=LINE_ORDER, places=places))


def _positions(salary: str) -> str:
    return f"""CAST(count(DISTINCT position) AS BIGINT) AS positions,
      CAST(coalesce(sum(CASE vacant WHEN 'Y' THEN 1 END), 0) AS BIGINT) AS vacancies, {money(salary)} AS annualized_salary, {money('fte')} AS employees"""


STAFF = "(SELECT * FROM positions WHERE emp_type IN (1, 2))"
PAY = "base_rate * CASE pay_code WHEN 'M' THEN 12 WHEN 'B' THEN 26 END"


def _staff(steps: str, metrics: str) -> str:
    return _after(_grouped(cleaned(STAFF, "city", steps), "city", metrics), "city", "upper(city)")


@add(
    "positions_and_salary", "J15",
    f"{ctes('positions', *REFS)} "
    + _rules("positions", 
        {
            Y18: _staff("R X F", _positions(PAY)),
            Y19: _staff("R X F S", _positions(PAY)),
            Y20: _staff("S R X F", _positions(PAY)),
            Y21: _staff("R X F S", f"{_positions('salary')}, {money('health')} AS employer_insurance_contributions"),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "positions")
    return _each(lambda y: city.positions(rows, r, y))


TEMPS = "(SELECT * FROM positions WHERE emp_type IN (4, 5))"
TEMP_COUNT = "CAST(count(DISTINCT position) AS BIGINT) AS temporary_employees"


@add(
    "temporary_staff", "J16",
    f"{ctes('positions', *REFS)} "
    + _rules("temporary", 
        {
            Y18: _grouped(cleaned(TEMPS, "city", "U F"), "city", TEMP_COUNT),
            Y19: _grouped(cleaned(TEMPS, "city", "U S V F"), "city", TEMP_COUNT),
            Y20: _after(_grouped(cleaned(TEMPS, "city", "R S X V F"), "city", TEMP_COUNT), "city", "upper(city)"),
            Y21: _after(_grouped(cleaned(TEMPS, "city", "R X V"), "city", TEMP_COUNT), "city", "upper(city)"),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "positions")
    return _each(lambda y: city.temporary_staff(rows, r, y))


HOMES = "(SELECT home_city AS city, salary FROM positions)"
PARTS["residences"] = {
    Y21: _after(
        _grouped(cleaned(HOMES, "city", "R X F S"), "city", "CAST(count(salary) AS BIGINT) AS employee_residences"), "city", "upper(city)"
    )
}


@add(
    "employee_residences", "J17",
    f"{ctes('positions', *REFS)} SELECT {PARTS['residences'][Y21]}",
)
def _(spark, sf):
    return city.employee_residences(fact(spark, sf, "positions"), refs(spark, sf))


BUILDINGS = f"{money('square_feet')} AS owned_square_footage, {money('land')} AS land_value, {money('structure')} AS structure_value"
UPKEEP = f"{money('utilities')} AS utility_bills_paid, {money('operating')} AS building_maintenance"
OWNED = "(SELECT * FROM facilities WHERE agency = 'F')"
IDS = "CAST(count(id) AS BIGINT) AS facilities_owned"


@add(
    "facilities", "J18",
    f"{ctes('facilities', *REFS)} "
    + _rules("facilities", 
        {
            Y18: _grouped(cleaned(OWNED, "city", "U R X"), "city", f"{IDS}, {BUILDINGS}, {UPKEEP}"),
            Y19: _grouped(cleaned(OWNED, "city", "U S R X"), "city", f"{IDS}, {BUILDINGS}, {UPKEEP}"),
            Y20: _grouped(cleaned(OWNED, "city", "U S R"), "city", f"{IDS}, {BUILDINGS}"),
            Y21: _grouped(cleaned(OWNED, "city", "U R X S"), "city", f"CAST(count(*) AS BIGINT) AS facilities_owned, {BUILDINGS}"),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "facilities")
    return _each(lambda y: city.facilities(rows, r, y, agency="F"))


@add(
    "facilities_with_exclusions_applied", "J18",
    f"{ctes('facilities', *REFS)} SELECT {_grouped(cleaned(OWNED, 'city', 'U S R X'), 'city', f'{IDS}, {BUILDINGS}')}",
)
def _(spark, sf):
    return city.facilities(fact(spark, sf, "facilities"), refs(spark, sf), Y20, agency="F", keep_excluded=False)


EXPENSE_CTES = f"""rows_kept AS (SELECT * FROM {cleaned('expenses', 'city', 'U S')}
      WHERE category IS DISTINCT FROM 'Total Direct Expenses'),
    utilities AS (SELECT city, {money('amount')} AS utility_bills_paid FROM rows_kept WHERE category = 'Utilities' AND city IS NOT NULL GROUP BY city),
    maintenance AS (SELECT city, {money('amount')} AS building_maintenance FROM rows_kept WHERE category = 'O&M Expenses' AND city IS NOT NULL GROUP BY city)"""
EXPENSES = f"{ctes('expenses', *REFS)}, {EXPENSE_CTES}"


@add(
    "utilities_and_maintenance", "J19",
    f"""{EXPENSES} SELECT coalesce(u.city, m.city) AS city, utility_bills_paid, building_maintenance
    FROM utilities u FULL OUTER JOIN maintenance m ON u.city = m.city""",
)
def _(spark, sf):
    return city.expenses(fact(spark, sf, "expenses"), refs(spark, sf))


@add(
    "maintenance_rows_repeating_the_spine", "J19",
    f"""{EXPENSES} SELECT s.city, s.county, utility_bills_paid, r.category, CAST(r.amount AS DOUBLE) AS building_maintenance
    FROM spine s LEFT JOIN utilities u ON s.city = u.city LEFT JOIN (SELECT * FROM rows_kept WHERE category = 'O&M Expenses') r ON s.city = r.city""",
)
def _(spark, sf):
    r = refs(spark, sf)
    out = city.attach_expenses(r.spine.drop("ord"), fact(spark, sf, "expenses"), r)
    return out.withColumn("building_maintenance", F.col("building_maintenance").cast("double"))


@add(
    "maintenance_aggregated_on_the_spine", "J19",
    f"""{EXPENSES} SELECT s.city, s.county, utility_bills_paid, building_maintenance
    FROM spine s LEFT JOIN utilities u ON s.city = u.city LEFT JOIN maintenance m ON s.city = m.city""",
)
def _(spark, sf):
    r = refs(spark, sf)
    return city.attach_expenses(r.spine.drop("ord"), fact(spark, sf, "expenses"), r, repeat_rows=False)


PARTS["construction"] = {
    Y21: _grouped(cleaned("construction", "city", "U R X S"), "city", f"{money('funds')} AS fixed_capital_outlay")
}


@add("construction_outlay", "J20", f"{ctes('construction', *REFS)} SELECT {PARTS['construction'][Y21]}")
def _(spark, sf):
    return city.construction(fact(spark, sf, "construction"), refs(spark, sf))


BENEFITS = f"{money('payment')} AS benefits_paid_to_retirees, {whole('payees')} AS number_of_payees"
DROP_18 = (
    "75791", "38221", "31646", "07070", "07024", "28904", "30076", "75039", "46590", "33343", "32271", "34722", "33939", "36542",
)
DROP_19 = DROP_18[:9]
OF_2020 = "(SELECT zip, payment, payees FROM retirees WHERE fiscal_year = '2020')"
KEPT_21 = "(SELECT zip, payment, payees FROM retirees WHERE zip NOT IN ('95136', '30564', '28792', '63042'))"


def _retirees(rows: str, drop: tuple[str, ...]) -> str:
    return _grouped(cleaned(rows, "city", "Q J", drop_zips=drop), "city", BENEFITS)


@add(
    "retiree_payments", "J21",
    f"{ctes('retirees', *REFS)} "
    + _rules("retirees", 
        {
            Y18: _retirees("(SELECT zip, payment, payees FROM retirees)", DROP_18),
            Y19: _retirees(OF_2020, DROP_19),
            Y20: _retirees(OF_2020, DROP_19),
            Y21: _grouped(
                cleaned(f"(SELECT z.city, r.payment, r.payees FROM zips z LEFT JOIN {KEPT_21} r ON z.zip = r.zip)", "city", "U R S"),
                "city", BENEFITS,
            ),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "retirees")
    return _each(lambda y: city.retiree_payments(rows, r, y))


AGENCIES = "CAST(count(DISTINCT agency) AS BIGINT) AS employers_using_retirement_system"
PAID_IN = f"{money('contribution')} AS employer_contributions"
EMPLOYERS_2020 = "(SELECT * FROM employers WHERE fiscal_year = '2020')"


@add(
    "retirement_employers", "J22",
    f"{ctes('employers', *REFS)} "
    + _rules("employers", 
        {
            Y18: _grouped(cleaned("employers", "city", "T R X", texts=("agency",)), "city", f"{AGENCIES}, {PAID_IN}"),
            Y19: _grouped(cleaned(EMPLOYERS_2020, "city", "U S R X", texts=("agency",)), "city", f"{AGENCIES}, {PAID_IN}"),
            Y20: _grouped(cleaned(EMPLOYERS_2020, "city", "S R X", texts=("agency",)), "city", f"{AGENCIES}, {PAID_IN}"),
            Y21: _grouped(cleaned("employers", "city", "R X S", texts=("agency",)), "city", AGENCIES),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "employers")
    return _each(lambda y: city.retirement_employers(rows, r, y))


@add(
    "employer_contributions", "J23",
    f"{ctes('employers', *REFS)} "
    + _rules("contributions", 
        {
            Y18: _grouped(cleaned("employers", "city", "T R X", texts=("agency",)), "city", PAID_IN),
            Y19: _grouped(cleaned(EMPLOYERS_2020, "city", "U S R X"), "city", PAID_IN),
            Y20: _grouped(cleaned(EMPLOYERS_2020, "city", "S R X"), "city", PAID_IN),
            Y21: _grouped(cleaned("employers", "city", "R X L S"), "city", PAID_IN),
        }
    ),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "employers")
    return _each(lambda y: city.employer_contributions(rows, r, y))


TRAVEL_CTES = f"""{WORDS}, places AS (SELECT destination, coalesce({CITY_HIT.format(t='upper(destination)')},
      {COUNTY_HIT.format(t='upper(destination)')}, upper(destination)) AS city FROM (SELECT DISTINCT destination FROM travel)),
    located AS (SELECT p.city, t.amount FROM travel t JOIN places p ON t.destination = p.destination)"""
LOCATED = "(SELECT city, amount FROM located)"


def _travel(steps: str) -> str:
    return _grouped(cleaned(LOCATED, "city", steps), "city", f"{money('amount')} AS travel_spend")


@add(
    "travel_spend", "J24 G22",
    f"{ctes('travel', *REFS)}, {TRAVEL_CTES} "
    + _rules("travel", {Y18: _travel("R X"), Y19: _travel("U S R X"), Y20: _travel("R X S"), Y21: _travel("R X S")}),
)
def _(spark, sf):
    r, rows = refs(spark, sf), fact(spark, sf, "travel")
    return _each(lambda y: city.travel(rows, r, y))
