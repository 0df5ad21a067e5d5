"""Formats, names and small parsers as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_days(start: Column, end: Column) -> Column:
    """Days between ISO dates; null where one is missing or no date."""
    return F.date_diff(F.try_to_date(end, "yyyy-MM-dd"), F.try_to_date(start, "yyyy-MM-dd"))


def padded(x: Column, n: int) -> Column:
    """x with zeros before it, up to n signs; longer ones stay whole."""
    return F.lpad(x, F.greatest(F.length(x), F.lit(n)), F.lit("0"))


def cik(x: Column) -> Column:
    return padded(F.ltrim(x, F.lit("0")), 10)


def accession_url(base: Column, cik_: Column, accession: Column) -> Column:
    return F.concat(base, F.lit("/"), cik_.cast("long"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"))


def feed_date(x: Column) -> Column:
    """The date of DD/MM/YYYY HH:MM."""
    return F.try_to_date(F.split(F.btrim(x), " ")[0], "dd/MM/yyyy")


def feed_period(title: Column, filed: Column, form: Column) -> Column:
    """The period's end: of the year in the title (2010 to 2029), else of the filing's, for annual reports the one before."""
    said = F.regexp_extract(title, "20[12][0-9]", 0)
    year = F.when(said != "", said.try_cast("int")).otherwise(F.year(filed) - (form == "HK-AR").cast("int"))
    return F.when(form == "HK-AR", F.make_date(year, F.lit(12), F.lit(31))).otherwise(F.make_date(year, F.lit(6), F.lit(30)))


def _fixed(x: Column, places: int) -> Column:
    return F.format_number(x, places)


def money(v: Column) -> Column:
    """In millions: without decimals from 1,000 on."""
    return F.when(v.isNull(), "—").when(F.abs(v) >= 1000, F.concat(F.lit("$"), _fixed(v, 0), F.lit("M"))).otherwise(F.concat(F.lit("$"), _fixed(v, 1), F.lit("M")))


def short_money(v: Column) -> Column:
    """In billions from 1,000 millions on."""
    plain = lambda x, n: F.replace(_fixed(x, n), F.lit(","), F.lit(""))
    return F.when(v >= 1000, F.concat(F.lit("$"), plain(v / 1000, 1), F.lit("B"))).otherwise(F.concat(F.lit("$"), plain(v, 0), F.lit("M")))


def signed_pct(p: Column) -> Column:
    return F.when(p.isNull(), "").otherwise(F.concat(F.lit("("), F.when(p >= 0, "+").otherwise(""), F.replace(_fixed(p, 1), F.lit(","), F.lit("")), F.lit("%)")))


def countdown(days: Column) -> Column:
    return F.when(days == 0, "today").when(days == 1, "tomorrow").when(days == -1, "yesterday").when(days > 0, F.concat(F.lit("in "), days, F.lit(" days"))).otherwise(F.concat(F.abs(days), F.lit(" days ago")))


def clean_entities(text: Column) -> Column:
    """Character references as blanks, white space collapsed."""
    for pattern in ("&#[0-9]+;", "&#x[0-9A-Fa-f]+;", "&[a-z]+;"):
        text = F.regexp_replace(text, pattern, " ")
    return F.btrim(F.regexp_replace(text, r"\s+", " "))


def scaled_millions(number: Column, unit: Column) -> Column:
    """A number with separators in millions; billions are scaled."""
    return F.replace(number, F.lit(","), F.lit("")).try_cast("double") * F.when(F.lower(unit) == "billion", 1000.0).otherwise(1.0)


def canonical_name(filed: Column, ticker: Column, token: Column, form: Column, extension: Column) -> Column:
    dot = F.when(extension.startswith("."), extension).otherwise(F.concat(F.lit("."), extension))
    return F.concat(F.lit("["), F.date_format(filed, "yyyy.MM.dd"), F.lit("]["), ticker, F.lit("]["), token, F.lit("]["), form, F.lit("]"), dot)


def external_url(url: Column) -> Column:
    return F.when(url.startswith("http"), url)


def is_virtual(path: Column) -> Column:
    return F.contains(path, F.lit("://")) & ~path.startswith("http")


def pct_of(part: Column, whole: Column, places: int = 3) -> Column:
    return F.round(F.try_divide(part, whole) * 100, places)


def keywords(names: Column, more: Column) -> Column:
    """Both lists, in order, each word once."""
    return F.array_distinct(F.concat(F.coalesce(names, F.array().cast("array<string>")), F.coalesce(more, F.array().cast("array<string>"))))


def balanced_json(text: Column) -> Column:
    """The first {...} that closes as often as it opens, outside strings; null where there is none."""
    at = F.instr(text, "{")
    signs = F.regexp_extract_all(F.substring(text, at, F.length(text)), F.lit(r'(?s)"(?:[^"\\]|\\.)*"|.'), 0)

    def step(acc, x):
        depth = acc["depth"] + F.when(x == "{", 1).when(x == "}", -1).otherwise(0)
        open_ = acc["open"]
        return F.struct(depth.alias("depth"), (open_ & (depth > 0)).alias("open"), F.when(open_, acc["n"] + F.length(x)).otherwise(acc["n"]).alias("n"))

    end = F.aggregate(signs, F.struct(F.lit(0).alias("depth"), F.lit(True).alias("open"), F.lit(0).alias("n")), step)
    return F.when((at > 0) & ~end["open"], F.substring(text, at, end["n"]))
