"""Period algebra as column functions: fiscal years and quarters, period tokens and types, calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANNUAL_FORMS = ["10-K", "20-F", "HK-AR"]
QUARTER_TYPES = ["Q1", "Q2", "Q3", "Q4"]
#: Months that each period type covers.
BASIS_MONTHS = {"Q1": 3, "Q2": 3, "Q3": 3, "Q4": 3, "3M": 3, "H1": 6, "H2": 6, "9M": 9, "FY": 12}
#: Last days of months; a fiscal year that ends in February ends on the 28th.
MONTH_ENDS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def fiscal_year(date: Column, fye: Column) -> Column:
    """The year in which the fiscal year of a date ends; null where the month of the year end isn't 1 to 12."""
    return F.when(fye.between(1, 12), F.year(date) + F.when(F.month(date) <= fye, 0).otherwise(1))


def months_into_year(date: Column, fye: Column) -> Column:
    """1 for the first month of the fiscal year, 12 for the last."""
    return F.pmod(F.month(date) - fye - 1, F.lit(12)) + 1


def fiscal_quarter(date: Column, fye: Column) -> Column:
    return F.ceil(months_into_year(date, fye) / 3).cast("int")


def period_token(form: Column, date: Column, fye: Column) -> Column:
    """AR, Q1-Q4, H1 or H2. Null: an unknown form, or a 10-Q on the fiscal year end (see token_error)."""
    q = fiscal_quarter(date, fye)
    quarter = F.concat(F.lit("Q"), q)
    return (
        F.when(form.isin(*ANNUAL_FORMS), "AR")
        .when((form == "10-Q") & (q < 4), quarter)
        .when(form == "6-K", quarter)
        .when(form == "HK-IR", F.when(months_into_year(date, fye) <= 6, "H1").otherwise("H2"))
    )


def token_error(form: Column, date: Column, fye: Column) -> Column:
    q4 = (form == "10-Q") & (fiscal_quarter(date, fye) == 4)
    return F.when(q4, "10-Q on the fiscal year end").when(~form.isin(*ANNUAL_FORMS, "10-Q", "6-K", "HK-IR"), "unknown form")


def period_type(stored: Column, form: Column, token: Column, date: Column, fye: Column) -> Column:
    """The stored type, else one inferred: AR is a fiscal year only on its end; 10-Q tokens accumulate; '' where none fits."""
    inferred = (
        F.when(token == "AR", F.when(F.month(date) == fye, "FY").otherwise(""))
        .when(form == "10-Q", F.when(token == "Q1", "Q1").when(token == "Q2", "H1").when(token == "Q3", "9M").otherwise(""))
        .when((form == "6-K") & token.isin(*QUARTER_TYPES), token)
        .when((form == "HK-IR") & token.isin("H1", "H2"), token)
        .otherwise("")
    )
    return F.coalesce(F.when(stored != "", stored), inferred)


def type_from_basis(months: Column, date: Column, fye: Column) -> Column:
    quarter = F.concat(F.lit("Q"), fiscal_quarter(date, fye))
    return F.when(months == 12, "FY").when(months == 9, "9M").when(months == 6, "H1").when(months == 3, quarter)


def type_from_duration(days: Column, token: Column, date: Column, fye: Column) -> Column:
    """From a context's days; null for a whole year (to be skipped), the token where no band fits."""
    quarter = F.concat(F.lit("Q"), fiscal_quarter(date, fye))
    return F.when(days <= 100, quarter).when(days.between(150, 200), "H1").when(days.between(250, 290), "9M").when(days >= 350, None).otherwise(token)


def calendar_label(date: Column) -> Column:
    return F.concat(F.year(date), F.lit("Q"), F.quarter(date))


def calendar_from_fiscal(fy: Column, quarter: Column, fye: Column) -> Column:
    """The calendar quarter in which fiscal quarter 1-4 of fiscal year fy ends."""
    month = fy * 12 + fye - 1 - (4 - quarter) * 3
    return F.concat(F.floor(month / 12), F.lit("Q"), F.floor(F.pmod(month, F.lit(12)) / 3) + 1)


def calendar_event(date: Column, fye: Column) -> Column:
    """FY on the fiscal year's last month, else the fiscal quarter."""
    return F.when(F.month(date) == fye, "FY").otherwise(F.concat(F.lit("Q"), F.floor(F.pmod(F.month(date) - fye - 1, F.lit(12)) / 3) + 1))


def year_end(fy: Column, fye: Column) -> Column:
    return F.make_date(fy, fye, F.element_at(F.array(*[F.lit(d) for d in MONTH_ENDS]), fye))


def basis_months(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in BASIS_MONTHS.items() for x in pair]), kind)


def expected_form(date: Column, fye: Column, files_6k: Column, q4_by_6k: Column) -> Column:
    """The form in which a period is expected: annual on the year end unless its fourth quarter comes by 6-K."""
    at_end = F.month(date) == fye
    return F.when(files_6k, F.when(at_end & ~q4_by_6k, "20-F").otherwise("6-K")).otherwise(F.when(at_end, "10-K").otherwise("10-Q"))


def cadence_forms(annual: Column) -> Column:
    return F.when(annual == "20-F", "6-K").when(annual == "HK-AR", "HK-IR").otherwise("10-Q")


def period_of_filing_month(date: Column) -> Column:
    """The quarter that a release of that month reports; null outside reporting months."""
    m, y = F.month(date), F.year(date)
    quarter = F.when(m.isin(2, 3), 4).when(m.isin(4, 5), 1).when(m.isin(7, 8), 2).when(m.isin(10, 11), 3)
    return F.when(quarter.isNotNull(), F.concat(F.when(quarter == 4, y - 1).otherwise(y), F.lit("Q"), quarter))


def march_quarter(date: Column) -> Column:
    """The fiscal quarter of a year that ends in March."""
    return F.concat(F.lit("Q"), F.floor(F.pmod(F.month(date) - 4, F.lit(12)) / 3) + 1)
