"""Text helpers: pure Python functions on one text each, for Arrow UDFs, and column expressions."""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType, StructField, StructType

#: Elements that the HTML standard lays out as blocks or rows, and line breaks.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|tr|ul"
TABLE = StructType([StructField("year", StringType()), StructField("value", DoubleType())])


def table_text(table: str) -> str:
    """Rows of a table as lines of tab-separated cells; rows without text are left out."""
    rows = []
    for row in re.findall(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>", table):
        cells = [" ".join(_html.unescape(re.sub(r"(?s)<[^>]+>", " ", c)).split()) for c in re.findall(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>", row)]
        if any(cells):
            rows.append("\t".join(cells))
    return "\n".join(rows)


def html_to_text(page: str) -> str:
    """Visible text: tables between markers, block ends as line ends, entities resolved, white space collapsed."""
    page = re.sub(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ", page)
    page = re.sub(r"(?is)<table\b.*?</table\s*>", lambda m: f"<br>[TABLE]<br>{_html.escape(table_text(m[0])).replace(chr(10), '<br>')}<br>[/TABLE]<br>", page)
    page = re.sub(rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n", page)
    page = _html.unescape(re.sub(r"(?s)<[^>]+>", "", page)).replace("\xa0", " ")
    lines = [re.sub(r"[ \f\v\r]+", " ", x).strip(" ") for x in page.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


#: Fixed value: an item's heading at the start of a line.
ITEM = re.compile(r"^\s*(Item\s+(\d+[A-Za-z]?))\s*[\.\:\—\-–]?\s*(.*)", re.IGNORECASE | re.MULTILINE)


def split_sections(text: str) -> dict[str, str]:
    """Sections by item heading, and the whole text. Headings in the first tenth are a table of contents, unless no others
    follow; a section starts only where the item changes; of items that come again the last stands."""
    found = [(m.start(), m[2].upper()) for m in ITEM.finditer(text)]
    body = [x for x in found if x[0] >= len(text) // 10] or found
    starts = [x for k, x in enumerate(body) if k == 0 or body[k - 1][1] != x[1]]
    ends = [at for at, _ in starts[1:]] + [len(text)]
    return {"_full": text} | {f"Item {name}": text[at:end].strip() for (at, name), end in zip(starts, ends, strict=True)}


def _large(line: str) -> list[int]:
    """Amounts over 100; smaller ones are notes or percentages."""
    return [v for x in re.findall(r"\$?\s*([\d,]+)", line) if x.strip(",") and (v := int(x.replace(",", ""))) > 100]


def header_years(table: str) -> list[int]:
    """The years after a period's header, else the different ones of the first five lines."""
    head = re.search(r"(?i)(?:Year\s+Ended|Fiscal\s+Year|For\s+the\s+year)[^\n]*((?:20[12]\d[\s,]*)+)", table)
    if head:
        return [int(y) for y in re.findall(r"20[12]\d", head[0])]
    return [int(y) for y in dict.fromkeys(re.findall(r"20[12]\d", "\n".join(table.split("\n")[:5])))]


REVENUE = re.compile(r"(?i)^(revenue|net\s+sales)")


def segment_values(table: str, names: list[str]) -> list[tuple[str, float]]:
    """(year, value) of the first segment name that a table has.

    Tried in turn: a line with the name; a revenue line within the four lines after it; any of the line and the three after
    it with at least two values. A line fits if it has values, and no more than there are years."""
    name = next((n for n in names if n in table), None)
    if name is None:
        return []
    years, rows = header_years(table), [x.strip() for x in table.split("\n") if x.strip()]
    at = [i for i, row in enumerate(rows) if name in row]
    tried = [*(_large(rows[i]) for i in at), *(_large(r) for i in at for r in rows[i + 1 : i + 5] if REVENUE.search(r)), *(v for i in at for r in rows[i : i + 4] if len(v := _large(r)) >= 2)]
    fit = next((v for v in tried if v and len(v) <= len(years)), [])
    return [(str(y), float(v)) for y, v in zip(years, fit, strict=False)]


#: Two and four amounts in a row.
AMOUNTS = {2: re.compile(r"\$?\s*([\d,]+)\s+\$?\s*([\d,]+)"), 4: re.compile(r"\$?\s*([\d,]+)\s+\$?\s*([\d,]+)\s+\$?\s*([\d,]+)\s+\$?\s*([\d,]+)")}


def quarterly_values(text: str, names: list[str], token: str) -> list[tuple[str, float]]:
    """(period type, value) of the current year from the first table that gives any: the quarter, and the year to date.

    Tables must name a segment, revenue and months that ended. The header's first two years tell whether the current year
    comes first (if they don't, it comes second). Values follow the name, or stand in the first revenue line within the four lines
    after it: quarter and year to date of both years, or, in a first quarter without a longer period, the quarter of both. A
    year to date under its quarter, quarters under 100 or over five times apart give nothing."""
    for table in re.findall(r"(?s)\[TABLE\](.*?)\[/TABLE\]", text):
        if any(n in table for n in names) and re.search(r"(?i)net\s+sales|revenue", table) and re.search(r"(?i)(three|six|nine)\s*months?\s*ended", table):
            if found := _quarterly(table, names, token):
                return found
    return []


def _quarterly(table: str, names: list[str], token: str) -> list[tuple[str, float]]:
    years = [int(y) for y in re.findall(r"\b(20\d{2})\b", table[:400])[:2]]
    place = 0 if len(years) == 2 and years[0] > years[1] else 1
    said = [p for p, word in (("9M", "nine"), ("H1", "six")) if re.search(rf"(?i){word}\s+months?\s+ended", table)]
    longer = said[0] if said else {"Q3": "9M", "Q2": "H1"}.get(token, "")
    n = 2 if token == "Q1" and not longer else 4
    rows = table.split("\n")
    for i, row in enumerate(rows):
        for name in (x for x in names if x in row):
            after = [x for x in rows[i + 1 : i + 5] if REVENUE.search(x.strip())][:1]
            for line in (row[row.index(name) + len(name) :], *after):
                if m := AMOUNTS[n].search(line):
                    v = [int(x.replace(",", "") or 0) for x in m.groups()]
                    if n == 2:
                        return [("Q1", float(v[place]))] if min(v) >= 100 and max(v) <= 5 * min(v) else []
                    quarter, total = v[place], v[place + 2]
                    kind = token if token in ("Q1", "Q2", "Q3") else "3M_reported"
                    return [(kind, float(quarter)), *([(longer, float(total))] if longer else [])] if total >= quarter else []
    return []


def _spelled(value: float) -> list[re.Pattern]:
    """How a value in millions is written: as millions with separators; from a thousand on as billions, too."""
    forms = [rf"\$?\s*{round(value):,}(?:\.\d+)?\s*(?:million|M)?\b"]
    if value >= 1000:
        forms += [rf"\$?\s*{re.escape(f'{value / 1000:.{d}f}')}\s*(?:billion|B|bn)\b" for d in (1, 2)]
    return [re.compile(f, re.IGNORECASE) for f in forms]


#: The signs around a value in which a keyword is sought, those kept without a sentence's end, and of a quote.
BEFORE, AFTER, REST, LONGEST = 180, 120, 80, 300


def find_quote(text: str, value: float, keywords: list[str]) -> str | None:
    """The sentence around a known value, in millions, with one of the keywords near it (any place, if there are none).

    Spellings are tried in turn, each at all places. A sentence begins after the last ". ", line end after a full stop, "!"
    or "?" before the value, and ends before the next ". " or some signs after it. Values of 0 or less have no quote."""
    if value <= 0:
        return None
    for m in (m for p in _spelled(value) for m in p.finditer(text)):
        near = text[max(0, m.start() - BEFORE) : m.end() + AFTER]
        if keywords and not any(k.lower() in near.lower() for k in keywords):
            continue
        left, right = text[max(0, m.start() - BEFORE) : m.start()], text[m.end() : m.end() + AFTER]
        begin = max(0, *(left.rfind(stop) for stop in (". ", ".\n", "!", "?")))
        end = right.find(". ")
        quote = (left[begin:] + m[0] + right[: end if end > 0 else REST]).strip(" .\n")
        return quote if len(quote) <= LONGEST else quote[: LONGEST - 3] + "..."
    return None


@arrow_udf(StringType())
def html_text(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else html_to_text(p) for p in pages.to_pylist()], pa.string())


@arrow_udf(MapType(StringType(), StringType()))
def sections(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else list(split_sections(t).items()) for t in texts.to_pylist()], pa.map_(pa.string(), pa.string()))


@arrow_udf(ArrayType(TABLE))
def segments(tables: pa.Array, names: pa.Array) -> pa.Array:
    out = [[{"year": y, "value": v} for y, v in segment_values(t or "", n or [])] for t, n in zip(tables.to_pylist(), names.to_pylist(), strict=True)]
    return pa.array(out, pa.list_(pa.struct([("year", pa.string()), ("value", pa.float64())])))


@arrow_udf(ArrayType(TABLE))
def quarters(texts: pa.Array, names: pa.Array, tokens: pa.Array) -> pa.Array:
    out = [[{"year": k, "value": v} for k, v in quarterly_values(t or "", n or [], q or "")] for t, n, q in zip(texts.to_pylist(), names.to_pylist(), tokens.to_pylist(), strict=True)]
    return pa.array(out, pa.list_(pa.struct([("year", pa.string()), ("value", pa.float64())])))


@arrow_udf(StringType())
def quotes(texts: pa.Array, values: pa.Array, keywords: pa.Array) -> pa.Array:
    return pa.array([find_quote(t or "", v, k or []) if v is not None else None for t, v, k in zip(texts.to_pylist(), values.to_pylist(), keywords.to_pylist(), strict=True)], pa.string())


#: Period headers of filings.
HEADERS = {
    "three_months": r"three[\s\-\u2013\u2014]*months?\s+ended",
    "six_months": r"six[\s\-\u2013\u2014]*months?\s+ended",
    "nine_months": r"nine[\s\-\u2013\u2014]*months?\s+ended",
    "year": r"(?:year|twelve[\s\-]?months?|fiscal\s+year)\s+ended",
    "quarter": r"quarter(?:ly)?\s+ended",
    "interim": r"interim\s+(?:report|results|consolidated)",
}


def header_counts(text: Column) -> dict[str, Column]:
    """How often each period header stands in a text."""
    return {k: F.regexp_count(text, F.lit(f"(?iU){p}")) for k, p in HEADERS.items()}


def light_strip(page: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(page, "(?s)<[^>]+>", " "), r"\s+", " "))


def first_numeric_sentence(text: Column, most: int = 200) -> Column:
    return F.substring(F.try_element_at(F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: s.rlike(r"[0-9]")), F.lit(1)), 1, most)


def json_block(text: Column) -> Column:
    """A model's answer without code fences, else from the first to the last brace; null where there is none."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.when(fenced != "", fenced), F.when(braces != "", braces))


#: What the messages of each class of failed calls say, in the order in which classes are tried.
FAILURES = [
    ("auth", r"\b401\b|unauthori[sz]ed|authenticat|invalid (api key|token|bearer)|/login\b|login expired|token (has )?expired|oauth token"),
    ("limit", r"usage limit|limit reached|hit your [\w -]{0,20}limit|\b(session|weekly|daily|opus) limit|rate.?limit|\b429\b|too many requests"),
    ("model", r"model[^\n]{0,40}(not found|not available|does not exist|invalid)|invalid model|unknown model"),
    ("transient", r"overloaded|\b5\d\d\b|timed? ?out|connection|network|temporar|try again"),
]


def error_class(message: Column) -> Column:
    """The first class whose pattern the message has; any other failure may pass, too."""
    found = [F.when(message.rlike(f"(?i){p}"), name) for name, p in FAILURES]
    return F.coalesce(*found, F.when(message.isNotNull(), "transient"))


def reset_time(message: Column, now: Column) -> Column:
    """When a limit lifts: an epoch after a bar, else a clock time in a zone, on a named day or the next time it comes.

    An unknown zone is taken as UTC; now and the result are instants of a session in UTC. Null: nothing said.
    """
    epoch = F.regexp_extract(message, r"\|([0-9]{10})\b", 1)
    clock = r"(?i)resets\s+(?:([A-Za-z]{3,9})\.?\s+([0-9]{1,2}),?\s+(?:at\s+)?)?([0-9]{1,2})(?::([0-9]{2}))?\s*([ap]m)\s*\(([^)]+)\)"
    part = lambda k: F.regexp_extract(message, clock, k)
    zone = F.btrim(part(6))
    zone = F.when(zone.rlike(r"^(UTC|GMT|[A-Z][A-Za-z]+/[A-Za-z_/]+)$"), zone).otherwise("UTC")
    hour = F.try_to_number(part(3), F.lit("99")).cast("int") % 12 + F.when(F.lower(part(5)) == "pm", 12).otherwise(0)
    minute = F.coalesce(F.try_to_number(part(4), F.lit("99")).cast("int"), F.lit(0))
    local = F.from_utc_timestamp(now, zone)
    at = lambda day: day.cast("timestamp") + F.make_dt_interval(hours=hour, mins=minute)
    month = F.element_at(F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS.split("|"), 1) for x in (m[:3].lower(), i)]), F.lower(F.substring(part(1), 1, 3)))
    day = F.try_to_date(F.concat_ws("-", F.year(local), month, part(2)), "y-M-d")
    today = at(F.to_date(local))
    named = F.when(at(day) < local - F.expr("interval 1 day"), at(F.add_months(day, 12))).otherwise(at(day))
    moment = F.when(day.isNotNull(), named).when((part(1) == "") & (today <= local), at(F.date_add(F.to_date(local), 1))).otherwise(today)
    return F.when(epoch != "", F.timestamp_seconds(epoch.try_cast("long"))).when(part(3) != "", F.to_utc_timestamp(moment, zone))


#: Cues of results releases and of notices.
TITLE = r"(?i)\b(announces?|reports?)\b[^\n]{0,80}?\b(quarter|quarterly|fiscal year|full year)\b[^\n]{0,60}?\bresults\b"
INTRODUCTION = r"(?i)\bfinancial results for the\b"
STATEMENTS = r"(?i)condensed consolidated (statements? of (operations|income|comprehensive|cash flows)|balance sheets?)"
NOTICE = r"(?i)annual general meeting|extraordinary general meeting|notice of (the )?(annual|extraordinary)|proxy (statement|form)|next day disclosure return|monthly return of equity|this circular is important"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
ENDED = rf"(?i)(?:(?:three|3)(?:\s+and\s+(?:six|nine|twelve))?\s+months|(?:first|second|third|fourth|march|june|september|december)?\s*quarter)\s+ended\s+({MONTHS}|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept|Sep|Oct|Nov|Dec)\.?\s+(\d{{1,2}}),?\s+(\d{{4}})"


def collapsed(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"(?U)\s+", " "))


def release_score(text: Column) -> Column:
    """How much a filing looks like a release of results; one from 4 on is.

    In the first 4,000 signs, white space collapsed: a title +4, an introduction +2, a period's end +1; condensed statements
    in the first 60,000 +2; a notice or circular in the first 600 -6."""
    head = F.substring(collapsed(F.substring(text, 1, 6_000)), 1, 4_000)
    body = collapsed(F.substring(text, 1, 60_000))
    hit = lambda c, p, n: F.when(c.rlike(p), n).otherwise(0)
    return hit(head, TITLE, 4) + hit(head, INTRODUCTION, 2) + hit(body, STATEMENTS, 2) + hit(head, ENDED, 1) - hit(F.substring(head, 1, 600), NOTICE, 6)


def period_ends(text: Column) -> Column:
    """Ends of quarters named in the first 40,000 signs, as an array; dates that don't exist are left out."""
    head = F.substring(text, 1, 40_000)
    parts = F.arrays_zip(*[F.regexp_extract_all(head, F.lit(ENDED), k).alias(n) for k, n in ((1, "m"), (2, "d"), (3, "y"))])
    date = lambda x: F.try_to_date(F.concat_ws("-", x["y"], F.initcap(F.substring(x["m"], 1, 3)), x["d"]), "yyyy-MMM-d")
    return F.array_compact(F.transform(parts, date))


def mode_date(dates: Column, filed: Column, most_days: int = 120) -> Column:
    """The most frequent date within so many days before the filing; the latest one on ties."""
    near = F.filter(dates, lambda d: F.date_diff(filed, d).between(0, most_days))
    counted = F.transform(F.array_distinct(near), lambda d: F.struct(F.size(F.filter(near, lambda x: x == d)).alias("n"), d.alias("d")))
    return F.try_element_at(F.array_sort(counted), F.lit(-1))["d"]
