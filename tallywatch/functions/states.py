"""United States state and territory codes, and column expressions over them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 56 codes and their full names.
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia",
    "PR": "Puerto Rico", "VI": "Virgin Islands", "GU": "Guam",
    "MP": "Northern Mariana Islands", "AS": "American Samoa",
}

STATE_CODES = tuple(STATE_NAMES)
REMOTE = "REMOTE"


def squeeze(name: str) -> str:
    return name.replace(" ", "").upper()


CODE_PATTERN = r"\b(" + "|".join(STATE_CODES) + r")\b"

# A name is accepted as written or with all inner spaces removed. The longest
# alternative comes first, so that "West Virginia" is not read as "Virginia".
_SPELLINGS = {s for name in STATE_NAMES.values() for s in (name, name.replace(" ", ""))}
NAME_PATTERN = (
    r"(?i)\b("
    + "|".join(re.escape(s).replace(r"\ ", " ") for s in sorted(_SPELLINGS, key=lambda s: (-len(s), s)))
    + r")\b"
)


def valid_state(col: Column) -> Column:
    """The value if it is one of the 56 codes exactly, else null."""
    return F.when(col.isin(*STATE_CODES), col)


def state_code_in(text: Column) -> Column:
    """The first state code that stands as a word of its own in ``text``."""
    # Null without a match, and the pattern is evaluated once.
    return F.get(F.regexp_extract_all(text, F.lit(CODE_PATTERN), 1), F.lit(0))


def state_name_in(text: Column) -> Column:
    """The code of the first full state name in ``text``, in any case."""
    found = F.upper(F.replace(F.regexp_extract(text, NAME_PATTERN, 1), F.lit(" "), F.lit("")))
    pairs = [F.lit(v) for code, name in STATE_NAMES.items() for v in (squeeze(name), code)]
    return F.try_element_at(F.create_map(*pairs), found)
