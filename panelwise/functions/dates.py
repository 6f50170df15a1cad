"""Calendar and scalar helpers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = {"monthly": 12, "weekly": 52, "daily": 252}
TOLERANCE = {"daily": 2, "weekly": 6, "monthly": 3}


def month_end(d: Column) -> Column:
    return F.last_day(d)


def aligned_start(d: Column, freq: Column) -> Column:
    """Monthly: month end; weekly: next Friday, the day itself if it is one; else unchanged."""
    return F.when(freq == "monthly", F.last_day(d)).when(freq == "weekly", F.next_day(F.date_sub(d, 1), "FRI")).otherwise(d)


def tolerance(freq: Column) -> Column:
    """Days of slack in coverage checks; 2 for an unknown frequency."""
    out = F.lit(2)
    for name, days in TOLERANCE.items():
        out = F.when(freq == name, days).otherwise(out)
    return out


def periodic(rate: Column, periods: int = 12) -> Column:
    """Annual percent as a decimal per period."""
    return rate / 100 / periods


def compounded(monthly: Column) -> Column:
    return F.pow(1 + monthly, F.lit(12)) - 1


def monthly_from_annual(annual: Column) -> Column:
    return F.pow(1 + annual, F.lit(1 / 12)) - 1


def stars(p: Column) -> Column:
    return F.when(p < 0.01, "***").when(p < 0.05, "**").when(p < 0.10, "*").otherwise("")


def sic_division(sic: Column) -> Column:
    """Division of a SIC code; null in, null out."""
    # The upper bound of each division of the classification.
    bounds = [(999, "Agriculture"), (1499, "Mining"), (1799, "Construction"), (3999, "Manufacturing"), (4999, "Transportation & Utilities"), (5199, "Wholesale Trade"), (5999, "Retail Trade"), (6799, "Finance & Real Estate"), (8999, "Services"), (9999, "Public Administration")]
    out = F.when(sic <= bounds[0][0], bounds[0][1])
    for top, name in bounds[1:]:
        out = out.when(sic <= top, name)
    return out


def clean_ticker(t: Column) -> Column:
    """Upper case; a numeric suffix or a trailing dot goes, a class suffix stays."""
    return F.regexp_replace(F.upper(F.trim(t)), r"^([^.]*)\.[0-9]*$", "$1")
