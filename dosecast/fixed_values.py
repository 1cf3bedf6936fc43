"""Values that results depend on, stated once: statuses, column lists, file kinds, formats.

Column lists are written ``Header: type``. The table column name follows from the header by
``snake_case``; a header of None marks a metadata column that does not come from the file.
"""

from __future__ import annotations

import re

# ---- fixed values: forecast -------------------------------------------------------------------

EXCLUDED_STATUSES = (
    "Screen Failed",
    "Pre-Screened Failed",
    "Treatment Discontinued",
    "Crossover Treatment Discontinued",
    "Enrolled",
)

MATCH_KEYS = ("study_protocol", "randomized_treatment", "tpc", "subject_status")
NORMALIZED_SUBJECT_COLUMNS = ("study_protocol", "randomized_treatment", "tpc", "country")
NORMALIZED_MAPPING_COLUMNS = NORMALIZED_SUBJECT_COLUMNS + (
    "study_drug_dispensed",
    "additional_study_drug_dispensed",
)

CYCLE_PATTERN = r"(?:C|Cycle\s?)(\d+)"
DAY_PATTERN = r"(?:D|Day\s?)(\d+)"
DOSE_PREFIX_PATTERN = r"^(.*?)\s\d"

FORECAST_SCHEMA = (
    "study_name string, parent_depot int, site_id int, subject_number bigint, subject_status string, "
    "subject_country string, randomized_treatment string, tpc string, drug_dispensed string, "
    "dispensing_quantity bigint, predicted_study_visit string, cycle int, day int, "
    "predicted_next_visit_date date, extract_date date, processed_timestamp timestamp"
)
FORECAST_SORT = ("study_name", "parent_depot", "site_id", "subject_number", "cycle", "day")

# ---- fixed values: curation -------------------------------------------------------------------

DATE_FORMATS = ("d-MMM-yyyy", "d MMM yyyy")
# further forms of a date in an input of the forecast, month first where only numbers tell
LOOSE_DATE_FORMATS = DATE_FORMATS + ("M/d/yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMMM yyyy", "yyyyMMdd", "yyyy/M/d")

NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# kind: substrings of the lower-cased file name that must all occur; the first kind that fits wins
FILE_KINDS = {
    "subject": ("subject summary",),
    "site": ("site", "inventory"),
    "depot": ("depot", "inventory"),
    "site_supply": ("site", "supplymethod"),
    "country_supply": ("country", "supplymethod"),
}

STUDY_HEADER = "Study Protocol"
MAPPING_HEADER = "Column Header"

SUBJECT_HEADERS = """
Site ID: int
Country: string
Parent Depot: int
Investigator: string
Subject Number: bigint
Year of Birth: int
Gender: string
TPC: string
Date Randomized: date
Date Treatment Discontinued: date
Date Crossover Enrolled: date
Date Crossover Approved: date
Date Crossover Treatment Discontinued: date
Subject Status: string
Randomized Treatment: string
Last Study Visit Recorded: string
Last Study Visit Date: date
Last Study Visit Number: string
Next Min. Study Visit Date: date
Next Max. Study Visit Date: date
Additional Drug Status: string
Last Additional Drug Visit Recorded: string
Last Additional Drug Visit Date: date
Last Additional Drug Visit Number: int
Next Min. Additional Drug Visit Date: date
Next Max. Additional Drug Visit Date: date
"""

DEPOT_HEADERS = """
Depot ID: int
Country: string
Depot Type: string
Study Drug Type: string
Unblinded Study Drug Name: string
Britestock Lot Number: string
Finished Lot Number: string
Part Number: string
FP Expiry Date: date
Quantity Study Drug - Requested: bigint
Quantity Study Drug - Available: bigint
Quantity Study Drug - Lost: bigint
Quantity Study Drug - Damaged: bigint
Quantity Study Drug - Quarantined: bigint
Quantity Study Drug - Rejected: bigint
Quantity Study Drug - Do Not Ship: bigint
Quantity Study Drug - Expired: bigint
Quantity Study Drug - Packaged (Unavailable): bigint
Quantity Study Drug - Total: bigint
Approved Countries: string
"""

SITE_HEADERS = """
Site ID: int
Country: string
Investigator: string
Parent Depot: int
Site Status: string
Study Drug Type: string
Unblinded Study Drug Name: string
Britestock Lot Number: string
Finished Lot Number: string
Part Number: string
FP Expiry Date: date
Quantity Study Drug - Requested: bigint
Quantity Study Drug - Available: bigint
Quantity Study Drug - Assigned: bigint
Quantity Study Drug - Lost: bigint
Quantity Study Drug - Damaged: bigint
Quantity Study Drug - Quarantined: bigint
Quantity Study Drug - Rejected: bigint
Quantity Study Drug - Do Not Dispense: bigint
Quantity Study Drug - Expired: bigint
Quantity Study Drug - Total: bigint
"""

SITE_SUPPLY_HEADERS = """
Country: string
Site ID: string
Comparator Name: string
Site Level Supply Method: string
Site Status: string
"""

COUNTRY_SUPPLY_HEADERS = """
Country: string
Comparator Name: string
Country Level Supply Method: string
"""

# table column = header of the treatment mapping sheet: type
TREATMENT_MAPPING_HEADERS = """
study_protocol = Study Protocol: string
randomized_treatment = Randomized Treatment: string
subject_status = Subject Status: string
tpc = TPC: string
study_drug_dispensed = Study Drug Dispensed: string
additional_study_drug_dispensed = Additional Study Drug Dispensed: string
additional_study_drug_prefix = Additional Study Drug Prefix: string
country = Country: string
visit_days = Visit Days: string
dispensing_quantity = Dispensing Quantity: bigint
dispensing_frequency_days = Dispensing Frequency (Days): bigint
max_cycles = Max Cycles: double
"""


def snake_case(header: str) -> str:
    """Table column name of a file header: words in lower case, joined by underscores."""
    return re.sub(r"[^a-z0-9]+", "_", header.lower()).strip("_")


def headers(block: str) -> list[tuple[str, str, str]]:
    """(column, header, type) of every line of a ``Header: type`` block."""
    out = []
    for line in block.strip().splitlines():
        left, kind = line.rsplit(": ", 1)
        name, _, header = left.rpartition(" = ")
        out.append((name or snake_case(header), header, kind))
    return out


# columns the forecast reads, where they exist
SUBJECT_COLUMNS = tuple(
    name
    for name, _, _ in headers("Study Protocol: string\n" + SUBJECT_HEADERS.strip())
    if name != "date_treatment_discontinued"
) + ("extract_date",)
MAPPING_COLUMNS = tuple(name for name, _, _ in headers(TREATMENT_MAPPING_HEADERS))
