"""Lists, tables and patterns the results depend on.

Nothing here is logic. Each entry has to hold exactly for a listing to conform
the way its users expect.
"""

# Name of a raw scrape file.
SCRAPE_PREFIX = "scrape-results-"
SCRAPE_GLOB = SCRAPE_PREFIX + "*.csv"
INGEST_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"

# A file whose name contains one of these is a re-processing of raw scrapes.
DERIVED_MARKERS = ("screened", "combined", "shortlist", "extracted", "yearsbar")

# Columns that are never written down.
SENSITIVE_COLUMNS = ("emails",)

# Legal forms left out of a company key.
LEGAL_FORMS = (
    "inc", "incorporated", "ltd", "limited", "llc", "llp",
    "corp", "corporation", "plc", "gmbh", "pvt", "pte",
)

# Country tokens, and the country names by code.
COUNTRY_BY_TOKEN = {
    "CA": "CA", "CAN": "CA", "CANADA": "CA",
    "US": "US", "USA": "US", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US",
}
COUNTRY_NAME = {"CA": "Canada", "US": "United States"}

# Provinces and territories of Canada.
PROVINCES = {
    "AB": "Alberta", "BC": "British Columbia", "MB": "Manitoba", "NB": "New Brunswick",
    "NL": "Newfoundland and Labrador", "NS": "Nova Scotia", "NT": "Northwest Territories",
    "NU": "Nunavut", "ON": "Ontario", "PE": "Prince Edward Island", "QC": "Quebec",
    "SK": "Saskatchewan", "YT": "Yukon",
}

# States of the USA and the District of Columbia.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois",
    "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana",
    "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon",
    "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota",
    "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia",
    "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}

# Characters stripped from both ends of a text (Unicode blanks and the
# four information separators).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a class in a pattern.
BLANK_CLASS = r"\t-\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Shapes of a Canadian postal code, a posted date and an amount (Java syntax).
POSTAL_CODE_PATTERN = r"(?iU)^[A-Z]\d[A-Z][\s\x1c-\x1f]*\d[A-Z]\d$"
POSTED_DATE_PATTERN = r"(?d)^(\d{4}-\d{2}-\d{2})(?:[ T]\d{2}:\d{2}:\d{2}.*)?$"
AMOUNT_PATTERN = (
    r"^[+-]?(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?$"
)

# How a source key reads.
EMPLOYER_PREFIX = "company:"
EMPLOYER_TYPE = "employer_ats"
BOARD_TYPE = "job_board"

# How keys of locations read.
UNRESOLVED_PREFIX = "raw:"
KEY_SEPARATOR = "|"
REMOTE = "remote"
