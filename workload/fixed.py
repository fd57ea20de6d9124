"""Fixed values for the SQL side, written out here so that no counterpart takes them from the code it checks."""

#: The 56 codes and names.
STATE_NAMES = dict(line.split(" ", 1) for line in """\
AL Alabama
AK Alaska
AZ Arizona
AR Arkansas
CA California
CO Colorado
CT Connecticut
DE Delaware
FL Florida
GA Georgia
HI Hawaii
ID Idaho
IL Illinois
IN Indiana
IA Iowa
KS Kansas
KY Kentucky
LA Louisiana
ME Maine
MD Maryland
MA Massachusetts
MI Michigan
MN Minnesota
MS Mississippi
MO Missouri
MT Montana
NE Nebraska
NV Nevada
NH New Hampshire
NJ New Jersey
NM New Mexico
NY New York
NC North Carolina
ND North Dakota
OH Ohio
OK Oklahoma
OR Oregon
PA Pennsylvania
RI Rhode Island
SC South Carolina
SD South Dakota
TN Tennessee
TX Texas
UT Utah
VT Vermont
VA Virginia
WA Washington
WV West Virginia
WI Wisconsin
WY Wyoming
DC District of Columbia
PR Puerto Rico
VI Virgin Islands
GU Guam
MP Northern Mariana Islands
AS American Samoa""".splitlines())

#: The 18 feature columns in order.
FEATURES = (
    "job_count", "mean_7", "mean_14", "mean_28", "std_7", "std_28", "mad_28", "pct_chg_1", "pct_chg_7", "z_7", "z_28",
    "roll_min_14", "roll_max_14", "lt_mean", "share_vs_lt", "dow", "woy", "month",
)

CODE_PATTERN = r"\b(" + "|".join(STATE_NAMES) + r")\b"
#: Names with and without their blanks, the longest first.
NAME_PATTERN = r"(?i)\b(" + "|".join(
    sorted({s for n in STATE_NAMES.values() for s in (n, n.replace(" ", ""))}, key=len, reverse=True)) + r")\b"
