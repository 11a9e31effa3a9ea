"""Fixed values of the jobs: year labels, cleaning orders, maps and lists."""

# Fiscal years in order.
YEARS = ("18-19", "19-20", "20-21", "21-22")

# Cleaning steps per job and year, before and after the group-by.
STEPS = {
    "circuits": {
        "18-19": ("J S R X", ""), "19-20": ("J S R X", ""), "20-21": ("J R X U S", ""), "21-22": ("U S R X", ""),
    },
    "grants": {"18-19": ("S C", ""), "19-20": ("S C", ""), "20-21": ("S C", ""), "21-22": ("S C", "")},
    "disbursements": {"18-19": ("S C", ""), "19-20": ("S C", ""), "20-21": ("S C", ""), "21-22": ("S C", "")},
    "erate": {"18-19": ("S C R M", ""), "19-20": ("S C R", ""), "20-21": ("S C R", "")},
    "call_centers": {"18-19": ("S C R", ""), "19-20": ("S C R", ""), "20-21": ("S C R", ""), "21-22": ("S C R", "")},
    "towers": {"18-19": ("M", "S C R"), "19-20": ("M", "S C R"), "20-21": ("M", "S C R"), "21-22": ("M S", "C R")},
    "phones_local": {"21-22": ("N L U S X R", "")},
    "phones_internet": {"21-22": ("N L U S R X", "")},
    "claims": {
        "18-19": ("J N S R", ""), "19-20": ("J N R", "S"), "20-21": ("J N R", "S"), "21-22": ("J N R S", ""),
    },
    "fleet": {"18-19": ("U S R", ""), "19-20": ("S U R", ""), "20-21": ("R S", "")},
    "federal_surplus": {"18-19": ("S R", ""), "19-20": ("S R", ""), "20-21": ("R R S", ""), "21-22": ("R R S", "")},
    "state_surplus": {"18-19": ("S U R X", ""), "19-20": ("S R X", ""), "20-21": ("S R X", ""), "21-22": ("S R X", "")},
    "marketplace": {
        "18-19": ("U S R X", ""), "19-20": ("U S R X", ""), "20-21": ("U S R X", ""), "21-22": ("U R X S", ""),
    },
    "certified": {
        "18-19": ("U S R X", ""), "19-20": ("U S R X", ""), "20-21": ("U S R M X S", ""), "21-22": ("U R M X S", ""),
    },
    "positions": {
        "18-19": ("R X F", "U"), "19-20": ("R X F S", "U"), "20-21": ("S R X F", "U"), "21-22": ("R X F S", "U"),
    },
    "temporary": {"18-19": ("U F", ""), "19-20": ("U S V F", ""), "20-21": ("R S X V F", "U"), "21-22": ("R X V", "U")},
    "residences": {"21-22": ("R X F S", "U")},
    "facilities": {"18-19": ("U R X", ""), "19-20": ("U S R X", ""), "20-21": ("U S R X", ""), "21-22": ("U R X S", "")},
    "expenses": {"20-21": ("U S", "")},
    "construction": {"21-22": ("U R X S", "")},
    "retirees": {"18-19": ("Q J", ""), "19-20": ("Q J", ""), "20-21": ("Q J", ""), "21-22": ("U R S", "")},
    "employers": {"18-19": ("T R X", ""), "19-20": ("U S R X", ""), "20-21": ("S R X", ""), "21-22": ("R X S", "")},
    "contributions": {"21-22": ("R X L S", "")},
    "travel": {"18-19": ("R X", ""), "19-20": ("U S R X", ""), "20-21": ("R X S", ""), "21-22": ("R X S", "")},
}

# County spellings of the tower source.
TOWER_COUNTIES = {
    "Dade County": "Miami-Dade County",
    "Saint Lucie County": "St. Lucie County",
    "De Soto County": "Desoto County",
}

# County spelling of the first E-rate file.
ERATE_COUNTIES = {"Dade County": "Miami-Dade County"}

# City spellings of the certified-business source.
CERTIFIED_CITIES = {
    "TALLAHASEE": "TALLAHASSEE",
    "PALM SPRINGS": "LAKE WORTH",
    "PEMBROKE PARK": "PEMBROKE PINES",
    "FT. LAUDERDALE": "FT LAUDERDALE",
    "MAMI GARDENS,": "MIAMI GARDENS",
    "ST CLOUD": "SAINT CLOUD",
    "LANDOLAKES": "LAND O LAKES",
    "ORANGE PARK,FL": "JACKSONVILLE",
    "TALLAHASSEE, FL": "TALLAHASSEE",
    "JACKSONVILLE, FL": "JACKSONVILLE",
    "BIG PINE": "BIG PINE KEY",
    "HERNANDO BEACH": "HERNANDO",
    "N. LAUDERDALE": "FT LAUDERDALE",
    "FERN": "FERN PARK",
    "LONGWOOD, FL": "LONGWOOD",
}

# Zips left out of the retiree source, by year.
RETIREE_DROP_ZIPS = {
    "18-19": (
        "75791", "38221", "31646", "07070", "07024", "28904", "30076", "75039", "46590",
        "33343", "32271", "34722", "33939", "36542",
    ),
    "19-20": ("75791", "38221", "31646", "07070", "07024", "28904", "30076", "75039", "46590"),
    "20-21": ("75791", "38221", "31646", "07070", "07024", "28904", "30076", "75039", "46590"),
    "21-22": ("95136", "30564", "28792", "63042"),
}

# Fiscal year taken from the multi-year retirement files. The
# in-state tables of 19-20 and 20-21 both take 2020.
RETIREMENT_YEAR = {"19-20": "2020", "20-21": "2020"}

# Row ordinals of the sources that are cut by position.
FEDERAL_SURPLUS_DROP = {"18-19": [177], "21-22": [5, 6, 7, 8, 9, 10, 11, 12, 13]}
PRISON_LAST_LABEL = 28
PRISON_CORRECTION = (2, "facility", "BLACKWATER")
FLEET_ROWS = 31655
RETIREE_IN_STATE_FROM = 60
RETIREE_OUT_OF_STATE_TO = {"18-19": 174, "19-20": 174, "20-21": 174, "21-22": 57}
RETIREE_OUT_OF_STATE_YEAR = {"18-19": "2019", "19-20": "2020", "20-21": "2021"}

# Evenly spaced stamps that stand for the days of a year.
CALENDAR_STAMPS = 365
