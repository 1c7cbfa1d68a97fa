"""Fixed values of the cleaning rules.

These must equal the values the source pipeline uses, or results change, so
they are kept together here, as plain text, in the order the rules apply.
"""

# The trailing full date, the date format, and the "unknown
# day/month" marker.
LAST_FULL_DATE = r"(\d{2}\.\d{2}\.\d{4})$"
DATE_FORMAT = "dd.MM.yyyy"
UNKNOWN_PART_TEXT = "00."
UNKNOWN_PART_REPLACEMENT = "01."

# Event name = "<name> (<ISO3>)" with optional trailing blanks/quotes.
COUNTRY_CODE = r"\(([A-Z]{3})\)[\s\"']*$"
NAME_BEFORE_CODE = r"^[\s\"']*(.*?)\s*\([A-Z]{3}\)[\s\"']*$"
OUTER_BLANKS_AND_QUOTES = r"^[\s\"']+|[\s\"']+$"
DOUBLED_QUOTE = '""'
UNKNOWN_COUNTRY_CODE = "XXX"
UNKNOWN_LABEL = "Unknown"
GLOBAL_EVENT_MARK = "Wings for Life"
GLOBAL_COUNTRY_NAME = "Global"
GLOBAL_COUNTRY_CODE = "GLO"

# Event distance/length and athlete performance.
WALK_EVENT = r"(?i)fotrally|maratonmarschen"
LEADING_AMOUNT = r"^([\d\.:]+)"
AMOUNT_UNIT = r"^[\d\.:]+\s*([a-zA-Z]+)"
TIME_UNITS = ["h", "d"]
KM_UNITS = ["km", "k"]
MILE_UNITS = ["mi", "mile", "miles"]
KM_PER_MILE = 1.60934
HOURS_PER_DAY = 24
TRAILING_LETTERS = r"[a-zA-Z\s]+$"
LEADING_NUMBER = r"^([\d\.]+)"
MILE_MARK = "mi"
PERF_DAYS = r"(\d+)d"
PERF_HOURS = r"(?:^|\s)(\d+):"
PERF_MINUTES = r":(\d{2}):"
PERF_SECONDS = r":(\d{2})$"
WALK_SPEED_KMH = 5.0
EVENT_DISTANCE = "Distance"
EVENT_TIME = "Time"
EVENT_ENDURANCE = "Endurance"

# Athlete attributes.
GENDERS = ["M", "F", "X"]
UNKNOWN_GENDER = "U"
WOMEN_PREFIX_IN = r"^F"
WOMEN_PREFIX_OUT = "W"
KEY_SEPARATOR = "_"
KEY_UNKNOWN = "UNKNOWN"

# Quality gate.
MIN_AGE = 15
MAX_AGE = 100
MAX_SPEED_KMH = 21.19
