"""Value maps: two-value flags, range labels, bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Midpoint of each demographic range label.
AGE = {
    "A: 18-24 years old": 21.0,
    "B: 25-34 years old": 30.0,
    "C: 35-44 years old": 40.0,
    "D: 45-54 years old": 50.0,
    "E: 55-64 years old": 60.0,
    "F: 65-74 years old": 70.0,
    "G: 75+ years old": 80.0,
}
HOME_VALUE = {
    "A. Under $50k": 35000.0,
    "B. $50 - $100k": 75000.0,
    "C. $100 - $150k": 125000.0,
    "D. $150 - $200k": 175000.0,
    "E. $200 - $250k": 225000.0,
    "F. $250 - $300k": 275000.0,
    "G. $300 - $350k": 325000.0,
    "H. $350 - $400k": 375000.0,
    "I. $400 - $450k": 425000.0,
    "J. $450 - $500k": 475000.0,
    "K. $500 - $550k": 525000.0,
    "L. $550 - $600k": 575000.0,
    "M. $600 - $650k": 625000.0,
    "N. $650 - $700k": 675000.0,
    "O. $700 - $750K": 725000.0,
    "P. $750K +": 800000.0,
}
INCOME = {
    "A: Under $15,000": 10000.0,
    "B: $15,000 - $19,999": 17250.0,
    "C: $20,000 - $29,999": 25000.0,
    "D: $30,000 - $39,999": 35000.0,
    "E: $40,000 - $49,999": 45000.0,
    "F: $50,000 - $74,999": 62500.0,
    "G: $75,000 - $99,999": 87500.0,
    "H: $100,000 - $124,999": 112500.0,
    "I: $125,000 - $149,999": 137500.0,
    "J: $150,000 and over": 175000.0,
}
NET_WORTH = {
    "A. Less than -$20,000": -30000.0,
    "B. -$20,000 thru -$2,500": -11250.0,
    "C. -$2,499 thru $2,499": 0.0,
    "D. $2,500 thru $24,999": 13750.0,
    "E. $25,000 thru $49,999": 37500.0,
    "F. $50,000 thru $74,999": 62500.0,
    "G. $75,000 thru $99,999": 87500.0,
    "H. $100,000 thru $149,999": 125000.0,
    "I. $150,000 thru $249,999": 200000.0,
    "J. $250,000 thru $499,999": 375000.0,
    "K. $500,000 thru $749,999": 625000.0,
    "L. $750,000 thru $999,999": 875000.0,
    "M. $1,000,000+": 1250000.0,
}
RESIDENCE_YEARS = {**{str(n): float(n) for n in range(1, 15)}, "15+": 25.0}
EDUCATION = {
    "A. Less than High School Diploma": 1.0,
    "B. High School Diploma": 3.0,
    "C. Some College": 6.0,
    "D. Bachelor Degree": 10.0,
    "E. Graduate Degree": 15.0,
}
# Fixed values: (true label, false label) per two-valued column.
TWO_VALUES = {
    "device_os_type": ("ios", "android"),
    "gender": ("M", "F"),
    "marital_status": ("Married", "Single"),
    "home_ownership": ("Owner", "Renter"),
    "presence_of_children": ("Y", "N"),
    "head_of_household": ("Y", "N"),
    "premover": ("Y", "N"),
}
RANGE_LABELS = {
    "age_range": AGE,
    "home_value_range": HOME_VALUE,
    "income_range_vds": INCOME,
    "networthindicator_rollup": NET_WORTH,
    "length_of_residence": RESIDENCE_YEARS,
    "level_of_education": EDUCATION,
}
# Upper bounds of the day bins, lettered a, b, c, ...
DAY_BINS = (6, 12, 21, 30, 45, 60, 80, 110, 140, 180, 250, 350)


def two_values(c: Column, true_label: str, false_label: str) -> Column:
    return F.when(c == true_label, 1.0).when(c == false_label, 0.0)


def midpoint(label: Column, table: Mapping[str, float]) -> Column:
    """Midpoint of a range label; null for unknown labels."""
    pairs = [F.lit(v) for item in table.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), label)


def day_bin(days: Column, bounds: Sequence[int] = DAY_BINS) -> Column:
    """Letter of the day bin ``[bound, next bound)``; null stays null."""
    index = reduce(lambda a, b: a + b, [F.when(days >= b, 1).otherwise(0) for b in bounds])
    return F.when(days.isNotNull(), F.char(index + 97))


def success_flag(time_on_page: Column, seconds: float = 3) -> Column:
    return F.when(time_on_page >= seconds, 1).otherwise(0)


def unknown_to_null(c: Column) -> Column:
    return F.when(~c.contains("Unknown") & (c != ""), c)


def positive_or_zero(c: Column) -> Column:
    return F.when(c > 0, c).otherwise(F.lit(0.0))
