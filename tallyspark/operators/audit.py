"""Data-quality audit: the universe of expected cells, checks, classification, fix routing, matrix and restatements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import periods as P
from tallyspark.operators.reconcile import PERIODS, TOLERANCE, _derive_sql, derive, pivot_periods, relative_difference, v
from tallyspark.operators.winners import AUDIT, audit, reconcile
from tallyspark.plans.shared import fresh_folder
from tallyspark.plans.views import SQL, companies, facts, filings

#: Duration bands in days of each period type.
DURATIONS = {"Q1": (75, 105), "Q2": (75, 105), "Q3": (75, 105), "Q4": (75, 105), "3M_reported": (75, 105), "H1": (160, 200), "9M": (250, 290), "FY": (350, 370)}
#: Metrics that can't be negative, the one whose sign is normalised, and the one that only warns.
POSITIVE = ["revenue", "property_plant_equipment_net", "depreciation_amortization", "cloud_segment_revenue", "capital_expenditures"]
ABSOLUTE, WARNED = ["capital_expenditures"], ["operating_cash_flow"]
#: Companies whose operating cash flow may be negative.
EARLY_STAGE = ["CRWV", "APLD", "IREN", "NBIS"]
#: The same roles among the metrics of the test tables.
SIGNS = {"positive": ["m1", "m2", "m3"], "absolute": ["m3"], "warned": ["m4"], "exempt": [1, 2, 3, 4]}
#: Bounds that are broadcast at most.
MOST_BOUNDS = 100_000
CELL = ["ticker", "fy", "metric", "period_type"]
METRICS = [f"m{i}" for i in range(1, 8)]
#: (ticker or none for all, metric, period group or type, low, high) of the test tables.
BOUNDS = [(None, f"m{i}", g, 1500.0 * i, 80000.0 + 1000 * i) for i in range(1, 7) for g in ("Q1_Q2_Q3_Q4", "FY")] + [(None, "m2", "H1", 5000.0, 60000.0), (1, "m3", "FY", 10000.0, 50000.0), (2, "m7", "Q1_Q2_Q3_Q4", 5000.0, 70000.0), (4, "m1", "Q2", 100.0, 40000.0)]
BOUND = "ticker long, metric string, group string, lo double, hi double"


def expected(firms: DataFrame, metrics: list[str], first: Column, last: Column, kinds: Column) -> DataFrame:
    """A row per company with what its expected cells are made of: (ticker, years, kinds, metrics), three arrays. firms: a row
    per ticker, with its first and last year; kinds: its array of period types."""
    return firms.select("ticker", F.sequence(first.cast("long"), last.cast("long")).alias("years"), kinds.alias("kinds"), F.array(*[F.lit(m) for m in metrics]).alias("metrics"))


def exploded(firms: DataFrame) -> DataFrame:
    """Each expected cell, and the company's other columns. Rows are exploded, so the work is spread over the companies and
    nothing is crossed."""
    out = firms.withColumn("metric", F.explode("metrics")).withColumn("fy", F.explode("years")).withColumn("period_type", F.explode("kinds"))
    return out.drop("years", "kinds", "metrics")


def _fixable(kind: Column, of: Column) -> Column:
    """Whether a filing of these classes could hold a cell of the kind. A fourth quarter may come from an annual form or a 6-K."""
    has = lambda c: F.coalesce(of[c], F.lit(False))
    return F.when(kind == "FY", has("annual")).when(kind == "Q4", has("annual") | has("half")).otherwise(has("half") | has("interim"))


def _company_years(firms: DataFrame, winners: DataFrame, docs: DataFrame, own: list[str]) -> DataFrame:
    """A row per expected() company and year: its winners there (__won), their numbers among the year's cells (__taken; null for
    cells that aren't expected), and which classes of filings there are (__of). Winners that are dealt by their company need no
    further shuffle. Each row has its own year's winners only, as all that is exploded from it carries them along."""
    one = lambda rows, c: rows.groupBy("ticker").agg(F.map_from_entries(F.collect_list(F.struct("fy", c))).alias(c))
    held = winners.filter("ticker is not null and metric is not null and fy is not null")
    held = one(held.groupBy("ticker", "fy").agg(F.collect_list(F.struct("metric", "period_type", *own)).alias("__won")), "__won")
    form = F.col("form")
    annual, half = F.coalesce(form.isin(*P.ANNUAL_FORMS), F.lit(False)), F.coalesce(form == "6-K", F.lit(False))
    classes = docs.filter("ticker is not null and fy is not null").groupBy("ticker", "fy").agg(F.max(annual).alias("annual"), F.max(half).alias("half"), F.max(~annual & ~half).alias("interim"))
    classes = one(classes.select("ticker", "fy", F.struct("annual", "half", "interim").alias("__of")), "__of")
    out = firms.join(held, "ticker", "left").join(classes, "ticker", "left")
    years = F.transform("years", lambda y: F.struct(y.alias("fy"), F.col("__won")[y].alias("__won"), F.col("__of")[y].alias("__of")))
    out = out.select("ticker", "kinds", "metrics", F.explode(years).alias("__year")).select("ticker", "kinds", "metrics", "__year.*")
    place = lambda names, x: F.nullif(F.array_position(names, x), F.lit(0)) - 1
    number = lambda x: (place("metrics", x["metric"]) * F.size("kinds") + place("kinds", x["period_type"])).cast("int")
    return out.withColumn("__taken", F.coalesce(F.transform("__won", number), F.array().cast("array<int>")))


def _cells_at(years: DataFrame, places: Column) -> DataFrame:
    """The cells of _company_years() at these places: a gap's is its number, a winner's below zero is that in __won (then the
    struct won isn't null)."""
    out = years.withColumn("__at", F.explode(places))
    out = out.withColumn("won", F.get("__won", -1 - F.col("__at")))
    cell = F.when(F.col("__at") < 0, F.get("__taken", -1 - F.col("__at"))).otherwise(F.col("__at"))
    return out.withColumn("metric", F.get("metrics", F.floor(cell / F.size("kinds")).cast("int"))).withColumn("period_type", F.get("kinds", cell % F.size("kinds")))


#: Places of a year's winners whose cells are expected.
WINNERS = "filter(transform(__taken, (x, i) -> if(x is null, null, -1 - i)), x -> x is not null)"


def check_gap(firms: DataFrame, winners: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """present, gap_fixable (a filing that could hold the cell exists) or gap_unfixable, of each cell of expected() companies.

    A year's cells have numbers: its winners are listed with theirs, the numbers that are left are gaps. Numbers alone are
    exploded, and a winner is found by its place: cells, many times the facts in number, are neither shuffled nor sorted, and
    none is searched for."""
    own = ["doc_id", "value_usd", "model", *more]
    every = "if(size(kinds) * size(metrics) > 0, sequence(0, size(kinds) * size(metrics) - 1), cast(array() as array<int>))"
    out = _cells_at(_company_years(firms, winners, docs, own), F.expr(f"concat({WINNERS}, array_except({every}, __taken))"))
    gap = F.when(F.col("won.doc_id").isNotNull(), "present").when(_fixable(F.col("period_type"), F.col("__of")), "gap_fixable").otherwise("gap_unfixable")
    return out.select(*CELL, *[F.col(f"won.{c}").alias(c) for c in own], gap.alias("gap"))


def check_identity(cells: DataFrame, keys=("ticker", "fy", "metric")) -> DataFrame:
    """Violated identities of each (ticker, fy, metric) with all their parts."""
    wide = pivot_periods(cells.withColumn("v", F.abs("value_usd")), list(keys))
    return wide.select(*keys, _violations({p: F.col(v(p)) for p in PERIODS}).alias("violations"))


def _violations(at: dict[str, Column]) -> Column:
    rules = [("FY=Q1+Q2+Q3+Q4", at["FY"], at["Q1"] + at["Q2"] + at["Q3"] + at["Q4"]), ("9M=Q1+Q2+Q3", at["9M"], at["Q1"] + at["Q2"] + at["Q3"]), ("H1=Q1+Q2", at["H1"], at["Q1"] + at["Q2"])]
    return _names([(name, relative_difference(whole, parts) > TOLERANCE) for name, whole, parts in rules])


def _names(tests: list[tuple[str, Column]]) -> Column:
    """The names of the conditions that hold, in their order. Arrays are joined, as array_compact() leaves what it filters to
    the interpreter, condition by condition."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(holds, F.array(F.lit(name))).otherwise(none) for name, holds in tests])


def with_neighbours(cells: DataFrame) -> DataFrame:
    """Winners with the violated identities of their group and the factor to the quarter before. Rows that are dealt by their
    company need no further shuffle, neither for both nor for what follows, and winners of winners.audit() are in the order that
    both ask for. A company has one winner a cell, however many facts."""
    group, series = Window.partitionBy("ticker", "metric", "fy"), Window.partitionBy("ticker", "metric")
    part = {p: F.max(F.when(F.col("period_type") == p, F.abs("value_usd"))).over(group) for p in PERIODS}
    quarter = F.col("period_type").isin(*P.QUARTER_TYPES)
    order = series.orderBy("fy", "period_type").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(quarter, F.struct("value_usd")), ignorenulls=True).over(order)["value_usd"]
    out = cells.withColumn("factor", F.when(quarter & (before != 0), F.col("value_usd") / before))
    return out.withColumn("violations", _violations(part))


def check_range(cells: DataFrame, bounds: DataFrame) -> DataFrame:
    """within, below or above, inclusive; within where there are no bounds.

    A company's own bounds of a metric stand in place of the default ones, all of them; among them those of the period's
    group (quarters together) come before those of the period type itself. Bounds are hand-kept; beyond a counted size they
    aren't broadcast."""
    pair = F.map_from_entries(F.collect_list(F.struct("group", F.struct("lo", "hi"))))
    sets = bounds.groupBy("ticker", "metric").agg(pair.alias("b"))
    small = bounds.count() <= MOST_BOUNDS
    hint = F.broadcast if small else lambda d: d
    own = hint(sets.filter("ticker is not null").withColumnRenamed("b", "__own"))
    rest = hint(sets.filter("ticker is null").select("metric", F.col("b").alias("__rest")))
    out = cells.join(own, ["ticker", "metric"], "left").join(rest, "metric", "left").withColumn("__b", F.coalesce("__own", "__rest"))
    group = F.when(F.col("period_type").isin(*P.QUARTER_TYPES, "3M_reported"), "Q1_Q2_Q3_Q4").otherwise(F.col("period_type"))
    at = F.coalesce(F.col("__b")[group], F.col("__b")[F.col("period_type")])
    out = out.withColumn("range", F.when(F.col("value_usd") < at["lo"], "below").when(F.col("value_usd") > at["hi"], "above").otherwise("within"))
    return out.drop("__own", "__rest", "__b")


def check_continuity(cells: DataFrame) -> DataFrame:
    """Quarters against the quarter that exists before them: a factor over 2.5 or under 0.4 fails."""
    rows = cells.filter(F.col("period_type").isin(*P.QUARTER_TYPES))
    before = F.lag("value_usd").over(Window.partitionBy("ticker", "metric").orderBy("fy", "period_type", "value_usd"))
    out = rows.withColumn("factor", F.when(before != 0, F.col("value_usd") / before))
    return out.withColumn("continuous", F.col("factor").isNull() | F.col("factor").between(0.4, 2.5))


def check_cross_source(quote: Column, value_usd: Column) -> Column:
    """False where the quote has numbers over 100 and none lies within the tolerance of the value."""
    size = F.abs(value_usd)
    # Fixed value: what is read as a number.
    numbers = F.transform(F.regexp_extract_all(quote, F.lit(r"\d[\d,]{2,}(?:\.\d+)?"), 0), lambda x: F.regexp_replace(x, ",", "").cast("double"))
    near = F.transform(F.filter(numbers, lambda x: x > 100), lambda x: F.abs(x - size) / F.greatest(size, F.lit(1.0)) <= TOLERANCE)
    return F.coalesce(F.array_max(near), F.lit(True))  # the quote is read once


def check_sign(ticker: Column, metric: Column, value: Column, positive=POSITIVE, absolute=ABSOLUTE, warned=WARNED, exempt=EARLY_STAGE) -> Column:
    """ok, error or warn; capital expenditure may be booked as an outflow, young companies may burn cash."""
    wrong = (value < 0) & metric.isin(*positive) & ~metric.isin(*absolute)
    return F.when(wrong, "error").when((value < 0) & metric.isin(*warned) & ~ticker.isin(*exempt), "warn").otherwise("ok")


def check_currency(currency: Column, value: Column, value_usd: Column, rate: Column) -> Column:
    """USD filers: both values alike (error). Others: missing fields, or a rate that is off by over a thousandth, warn."""
    usd = F.when(F.abs(value - value_usd) > 0.5, "error").otherwise("ok")
    off = F.abs(F.try_divide(value_usd, value) - rate) / F.greatest(F.abs(rate), F.lit(1e-6)) > 0.001
    other = F.when(value.isNull() | value_usd.isNull() | rate.isNull(), "warn").when(value == 0, "ok").when(off, "warn").otherwise("ok")
    return F.when(currency == "USD", usd).otherwise(other)


def check_segment_def(metric: Column, names: Column, section: Column, quote: Column, applies=("cloud_segment_revenue",)) -> Column:
    """False where none of the configured segment names is in the section's name or the quote, without regard to case."""
    hay = F.lower(F.concat_ws(" ", F.coalesce(section, F.lit("")), F.coalesce(quote, F.lit(""))))
    known = F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda n: n != "")
    return ~metric.isin(*applies) | (F.size(known) == 0) | F.exists(known, lambda n: F.contains(hay, F.lower(n)))


def check_duration(kind: Column, days: Column) -> Column:
    """False only where the type has a band and the days are known and outside it."""
    fits = F.lit(True)
    for k, (lo, hi) in DURATIONS.items():
        fits = F.when(kind == k, F.coalesce(days.between(lo, hi), F.lit(True))).otherwise(fits)
    return F.coalesce(fits, F.lit(True))


def classify(gap: Column, failed: Column, model: Column) -> Column:
    return F.when(gap != "present", gap).when(F.size(failed) > 0, "flagged").when(model.startswith("reconcile-derived"), "derived").otherwise("verified")


def route(gap: Column, failed: Column) -> Column:
    """The fix for a cell, the first that applies; null where none does."""
    has = lambda x: F.array_contains(failed, x)
    return (
        F.when(has("period_type") | (has("cross_source") & ~has("identity")), "refetch")
        .when((F.size(failed) == 1) & has("identity"), "reconcile")
        .when(has("range") | has("continuity"), "refetch")
        .when(gap == "gap_fixable", "extract")
    )


#: Checks whose failure is an error; that of the others is a warning.
ERRORS = ["identity", "sign_error", "currency_error"]


def severity(failed: Column) -> Column:
    """error if any failure is one, else warn; null without failures."""
    return F.when(F.arrays_overlap(failed, F.array(*[F.lit(x) for x in ERRORS])), "error").when(F.size(failed) > 0, "warn")


def restatements(df: DataFrame, **more: Column) -> DataFrame:
    """Cells whose last observation differs from the first by over half a percent; null filing dates come first. more: further
    aggregates of a cell's observations, by name."""
    order = F.struct(F.col("filing_date").isNotNull(), "filing_date", "doc_id", "partkey", "suppkey", "quantity", "tax", "value")
    out = df.filter("value_usd is not null").groupBy(*CELL).agg(F.min_by("value_usd", order).alias("first"), F.max_by("value_usd", order).alias("last"), F.count("*").alias("n"), *[c.alias(n) for n, c in more.items()])
    change = F.abs(F.col("last") - F.col("first")) / F.greatest(F.abs("first"), F.lit(1.0))
    return out.filter("n >= 2").withColumn("change", change).filter("change > 0.005")


def _cells(spark, sf_dir):
    """Every year for which there are filings; a company of the third region files half-yearly."""
    every = F.array(*[F.lit(x) for x in ("Q1", "Q2", "Q3", "Q4", "FY")])
    half = F.array(F.lit("H1"), F.lit("H2"), F.lit("FY"))
    first, last = filings(spark, sf_dir).agg(F.min("fy"), F.max("fy")).first()
    firms = companies(spark, sf_dir).select("ticker", "currency")
    return expected(firms, METRICS, F.lit(first), F.lit(last), F.when(F.col("currency") == "HKD", half).otherwise(every))


def _checked(spark, sf_dir):
    return checked(facts(spark, sf_dir))


def checked(stored: DataFrame) -> DataFrame:
    """The audit winners of facts with all nine checks but gap. Quotes, contexts and rates are made of the columns at hand.
    Facts are dealt once, by company, for the winners and all that follows."""
    won = with_neighbours(audit(stored.repartition("ticker")))
    bounds = stored.sparkSession.createDataFrame(BOUNDS, BOUND)
    out = check_range(won, bounds).withColumn("__quote", _quote())
    value = F.when(F.col("suppkey") % 5 == 0, -F.col("value_usd")).otherwise(F.col("value_usd"))
    sign_ = check_sign(F.col("ticker"), F.col("metric"), value, **SIGNS)
    money = check_currency(F.col("currency"), F.col("value"), F.col("value_usd"), _rate())
    segment = check_segment_def(F.col("metric"), F.array(F.lit("cloud"), F.lit("Segment 7")), F.lit(""), F.col("__quote"), applies=["m5"])
    tests = [
        ("identity", F.size("violations") > 0),
        ("range", F.col("range") != "within"),
        ("continuity", ~F.col("factor").between(0.4, 2.5)),
        ("cross_source", ~check_cross_source(F.col("__quote"), F.col("value_usd"))),
        ("sign_error", sign_ == "error"),
        ("sign_warn", sign_ == "warn"),
        ("currency_error", money == "error"),
        ("currency_warn", money == "warn"),
        ("segment_def", ~segment),
        ("period_type", ~check_duration(F.col("period_type"), _basis() * 30)),
    ]
    return out.withColumn("failed", _names(tests)).drop("__quote")


def _quote() -> Column:
    number = F.format_number(F.col("value_usd") * F.when(F.col("suppkey") % 7 == 0, 2).otherwise(1), 0)
    return F.when(F.col("suppkey") % 3 > 0, F.concat(F.lit("Total for segment "), F.col("suppkey") % 10, F.lit(" was "), number, F.lit(" against 112,000,000")))


def _rate() -> Column:
    return F.when(F.col("suppkey") % 7 > 0, 1 - F.floor(F.col("quantity") / 5) / 100)


def _basis() -> Column:
    """Stored basis months: those of the period type, but twelve for every eleventh supplier, and some unknown."""
    return F.when(F.col("suppkey") % 13 == 0, None).when(F.col("suppkey") % 11 == 0, 12).otherwise(P.basis_months(F.col("period_type")))


def _audited(spark, sf_dir):
    return audited(facts(spark, sf_dir), _cells(spark, sf_dir), filings(spark, sf_dir))


def audited(stored: DataFrame, firms: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The cells of expected() companies with gap, failed checks, class and fix, and more columns of checked(). The winners are
    made once, with all their checks."""
    out = check_gap(firms, checked(stored), docs, "failed", *more)
    out = out.withColumn("failed", F.coalesce("failed", F.array().cast("array<string>")))
    return out.withColumn("class", classify(F.col("gap"), F.col("failed"), F.col("model"))).withColumn("fix", route(F.col("gap"), F.col("failed")))


def flagged(stored: DataFrame, firms: DataFrame) -> DataFrame:
    """The flagged ones of audited() cells. They are winners with a failed check that some company expects, so no other cell is
    made."""
    rows = checked(stored).filter("size(failed) > 0 and doc_id is not null and metric is not null").join(firms.select("ticker", "years", "kinds", "metrics"), "ticker")
    rows = rows.filter("array_contains(years, fy) and array_contains(kinds, period_type) and array_contains(metrics, metric)")
    gap = F.lit("present")
    rows = rows.withColumn("class", classify(gap, F.col("failed"), F.col("model"))).withColumn("fix", route(gap, F.col("failed")))
    return rows.select(*CELL, "doc_id", "value_usd", "model", "failed", gap.alias("gap"), "class", "fix")


def fixes(stored: DataFrame, firms: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of audited() cells that have a fix. They are winners whose failures are routed and gaps that a filing could fill, so
    no other cell is made."""
    own = ["doc_id", "value_usd", "failed", "fix"]
    years = _company_years(firms, checked(stored).withColumn("fix", route(F.lit("present"), F.col("failed"))), docs, own)
    asked = lambda x: F.get("__won", -1 - x)["fix"].isNotNull() | F.get("__won", -1 - x)["doc_id"].isNull()
    kinds = F.filter(F.transform("kinds", lambda k, i: F.when(_fixable(k, F.col("__of")), i)), lambda i: i.isNotNull())
    end, none = F.size("kinds") * F.size("metrics") - 1, F.array().cast("array<int>")
    gaps = F.when(F.size("metrics") > 0, F.flatten(F.transform(kinds, lambda i: F.sequence(i, end, F.size("kinds"))))).otherwise(none)
    out = _cells_at(years, F.concat(F.filter(F.expr(WINNERS), asked), F.array_except(gaps, F.col("__taken"))))
    open_ = F.col("won.doc_id").isNull() & _fixable(F.col("period_type"), F.col("__of"))
    fix = F.coalesce(F.col("won.fix"), F.when(open_, "extract"))
    failed = F.coalesce(F.col("won.failed"), F.array().cast("array<string>"))
    return out.select(*CELL, F.col("won.doc_id").alias("doc_id"), F.col("won.value_usd").alias("value_usd"), failed.alias("failed"), fix.alias("fix")).filter("fix is not null")


def _fixes(spark, sf_dir):
    return fixes(facts(spark, sf_dir), _cells(spark, sf_dir), filings(spark, sf_dir))


def _flagged(spark, sf_dir):
    return flagged(facts(spark, sf_dir), _cells(spark, sf_dir))


def cell_universe(spark, sf_dir):
    return exploded(_cells(spark, sf_dir)).select(*CELL)


def gap(spark, sf_dir):
    out = check_gap(_cells(spark, sf_dir), audit(facts(spark, sf_dir).repartition("ticker")), filings(spark, sf_dir))
    return out.select(*CELL, "gap", "doc_id")


def identity(spark, sf_dir):
    wide = derive(pivot_periods(reconcile(facts(spark, sf_dir)), ["ticker", "fy", "metric"]))
    cells = wide.select("ticker", "fy", "metric", F.expr("stack(7, 'Q1', v_q1, 'Q2', v_q2, 'Q3', v_q3, 'Q4', v_q4, 'H1', v_h1, '9M', v_9m, 'FY', v_fy) as (period_type, value_usd)")).filter("value_usd is not null")
    return check_identity(cells).select("ticker", "fy", "metric", F.array_join("violations", ";").alias("violations"))


def range_(spark, sf_dir):
    bounds = spark.createDataFrame(BOUNDS, BOUND)
    return check_range(audit(facts(spark, sf_dir)), bounds).select(*CELL, "range")


def continuity(spark, sf_dir):
    return check_continuity(audit(facts(spark, sf_dir))).select(*CELL, F.round("factor", 6).alias("factor"), "continuous")


def cross_source(spark, sf_dir):
    return audit(facts(spark, sf_dir)).select(*CELL, check_cross_source(_quote(), F.col("value_usd")).alias("passed"))


def sign(spark, sf_dir):
    value = F.when(F.col("suppkey") % 5 == 0, -F.col("value_usd")).otherwise(F.col("value_usd"))
    return audit(facts(spark, sf_dir)).select(*CELL, check_sign(F.col("ticker"), F.col("metric"), value, **SIGNS).alias("sign"))


def currency(spark, sf_dir):
    return audit(facts(spark, sf_dir)).select(*CELL, check_currency(F.col("currency"), F.col("value"), F.col("value_usd"), _rate()).alias("verdict"))


def segment_def(spark, sf_dir):
    names = F.when(F.col("suppkey") % 4 > 0, F.array(F.lit("cloud"), F.lit("Segment 7"), F.lit("segment 1")))
    return audit(facts(spark, sf_dir)).select(*CELL, check_segment_def(F.col("metric"), names, F.lit("note"), _quote(), applies=["m5"]).alias("passed"))


def duration(spark, sf_dir):
    return audit(facts(spark, sf_dir)).select(*CELL, check_duration(F.col("period_type"), _basis() * 30).alias("passed"))


def verdict_severity(spark, sf_dir):
    """What is stored for a flagged cell: its failures and their severity."""
    rows = _flagged(spark, sf_dir)
    return rows.select(*CELL, "doc_id", F.array_join("failed", ";").alias("failed"), severity(F.col("failed")).alias("severity"))


def fix_batches(spark, sf_dir):
    """Fixes grouped by class, with the companies and years that a batch covers; a dry run changes nothing."""
    # First by company, where the cells are; the sets of metrics are few.
    rows = _fixes(spark, sf_dir).groupBy("ticker", "fix").agg(F.count("*").alias("n"), F.min("fy").alias("first"), F.max("fy").alias("last"), F.sort_array(F.collect_set("metric")).alias("of"))
    metrics = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("of")))), ",")
    return rows.groupBy("fix").agg(F.sum("n").alias("cells"), F.count("ticker").alias("tickers"), F.min("first").alias("first"), F.max("last").alias("last"), metrics.alias("metrics"))


def fixes_dry_run(spark, sf_dir):
    rows = _fixes(spark, sf_dir)
    suggested = F.when(F.col("fix") == "extract", F.when(F.col("period_type") == "FY", "facts").otherwise("model")).when(F.col("fix") == "refetch", "facts")
    return rows.select(*CELL, "fix", suggested.alias("extractor"), F.col("value_usd").alias("old_usd"), F.lit(None).cast("double").alias("new_usd"))


#: The checks of a value that are persisted; those that end in _warn only warn.
VALUE_CHECKS = ["identity", "range", "continuity", "cross_source", "sign_error", "sign_warn", "currency_error", "currency_warn", "segment_def", "period_type"]


def value_checks(rows: DataFrame) -> DataFrame:
    """A row for each checked winner and check: whether it passed, and how grave a failure is."""
    grave = lambda n: "warn" if n.endswith("_warn") else "error"
    checks = F.array(*[F.struct(F.lit(n).alias("check_name"), (~F.array_contains("failed", n)).alias("passed"), F.lit(grave(n)).alias("severity")) for n in VALUE_CHECKS])
    return rows.select("doc_id", *CELL, F.explode(checks).alias("c")).select("doc_id", *CELL, "c.*")


def run_value_checks(spark, sf_dir):
    """All value checks of all winners, persisted and read again."""
    path = fresh_folder(spark, "value-checks")
    rows = value_checks(_checked(spark, sf_dir))
    rows.write.partitionBy("check_name").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def period_coverage(spark, sf_dir):
    """What each company has of a year's period types: a stored value beats a derived one."""
    f = audit(facts(spark, sf_dir))
    kind = F.when(F.col("model").startswith("reconcile-derived"), 1).otherwise(2)
    best = lambda p: F.max(F.when(F.col("period_type") == p, kind))
    mark = lambda p: F.when(best(p) == 2, "stored").when(best(p) == 1, "derived").otherwise("-")
    return f.groupBy("ticker", "metric", "fy").agg(*[mark(p).alias(f"p_{p}") for p in PERIODS])


def classify_cells(spark, sf_dir):
    return _audited(spark, sf_dir).groupBy("metric", "class").agg(F.count("*").alias("n"))


def fix_routing(spark, sf_dir):
    return _fixes(spark, sf_dir).select(*CELL, "fix", F.array_join("failed", ";").alias("failed"))


def coverage_matrix(spark, sf_dir):
    """Per company and metric, the share of verified and derived cells and whether any is flagged."""
    good = F.when(F.col("class").isin("verified", "derived"), 1.0).otherwise(0.0)
    out = _audited(spark, sf_dir).groupBy("ticker").pivot("metric", METRICS).agg(F.round(F.avg(good) * 100, 2).alias("pct"), F.max(F.col("class") == "flagged").alias("flag"))
    return out


#: What a row of audit_totals() is about.
LEVELS = {"class": ["metric", "class"], "coverage": ["ticker", "metric"], "company": ["ticker"], "all": []}


def audit_totals(cells: DataFrame) -> DataFrame:
    """All roll-ups of audited cells in one pass: cells by metric and class, each company's share of verified and derived cells
    by metric and whether any is flagged, its gaps that can't be fixed, and the totals.

    `level` names the grouping (LEVELS). Cells are first counted by company, metric and class, where they are; only these counts
    are repeated for the grouping sets."""
    gap = F.col("class") == "gap_unfixable"
    columns = ["ticker", "metric", "class"]
    rows = cells.groupBy(*columns).agg(F.count("*").alias("n"), F.min("fy").alias("__first"), F.max("fy").alias("__last"))
    # Copies under other names, as a grouped column is null in the sets that lack it.
    of = lambda c: F.when(c, F.col("n")).otherwise(0)
    rows = rows.withColumns({"__metric": F.when(gap, F.col("metric")), "__first": F.when(gap, F.col("__first")), "__last": F.when(gap, F.col("__last")), "__gap": of(gap), "__good": of(F.col("class").isin("verified", "derived")), "__flag": of(F.col("class") == "flagged")})
    sets = [[F.col(c) for c in LEVELS[k]] for k in LEVELS]
    out = rows.groupingSets(sets, *columns).agg(
        F.grouping_id(*columns).alias("__id"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("__good"), F.lit(0)).alias("good"), F.coalesce(F.sum("__flag"), F.lit(0)).alias("flagged"),
        F.coalesce(F.sum("__gap"), F.lit(0)).alias("unfixable"), F.count_distinct("__metric").alias("metrics"), F.min("__first").alias("first"), F.max("__last").alias("last"),
    )
    bit = {c: 1 << (len(columns) - 1 - k) for k, c in enumerate(columns)}
    ids = {sum(b for c, b in bit.items() if c not in LEVELS[k]): k for k in LEVELS}
    level = F.element_at(F.create_map(*[F.lit(x) for pair in ids.items() for x in pair]), F.col("__id").cast("int"))
    return out.select(level.alias("level"), *columns, "n", F.round(F.col("good") / F.col("n") * 100, 2).alias("pct"), "flagged", "unfixable", "metrics", "first", "last")


def audit_rollup(spark, sf_dir):
    return audit_totals(_audited(spark, sf_dir))


def unfixable(spark, sf_dir):
    rows = _audited(spark, sf_dir).filter("class = 'gap_unfixable'")
    return rows.groupBy("ticker").agg(F.count("*").alias("n"), F.count_distinct("metric").alias("metrics"), F.min("fy").alias("first"), F.max("fy").alias("last"))


def flag_clusters(spark, sf_dir):
    """Flagged cells of a company and metric, and all cells beside them."""
    flagged = F.col("class") == "flagged"
    member = F.concat(F.col("fy"), F.col("period_type"))
    text = lambda c: F.array_join(F.sort_array(F.collect_list(c)), ",")
    rows = _audited(spark, sf_dir).groupBy("ticker", "metric").agg(F.count_if(flagged).alias("n"), text(F.when(flagged, member)).alias("members"), text(member).alias("siblings"))
    return rows.filter("n > 0")


def restatement_detect(spark, sf_dir):
    return restatements(facts(spark, sf_dir).filter("period_type <> ''")).select(*CELL, "first", "last", "n", F.round("change", 6).alias("change"))


QUERIES = {
    "cell_universe": cell_universe,
    "check_gap": gap,
    "check_identity": identity,
    "check_range": range_,
    "check_continuity": continuity,
    "check_cross_source": cross_source,
    "check_sign": sign,
    "check_currency": currency,
    "check_period_type": duration,
    "check_segment_def": segment_def,
    "verdict_severity": verdict_severity,
    "fix_batches": fix_batches,
    "fixes_dry_run": fixes_dry_run,
    "run_value_checks": run_value_checks,
    "period_coverage": period_coverage,
    "classify_cells": classify_cells,
    "audit_rollup": audit_rollup,
    "fix_routing": fix_routing,
    "coverage_matrix": coverage_matrix,
    "unfixable_gaps": unfixable,
    "flag_clusters": flag_clusters,
    "restatement_detect": restatement_detect,
}

_bounds = ", ".join(f"({'NULL::BIGINT' if t is None else t}, '{m}', '{g}', {lo}::DOUBLE, {hi}::DOUBLE)" for t, m, g, lo, hi in BOUNDS)
CELLS = f"""{SQL}, won AS ({AUDIT}), u AS (SELECT ticker, unnest(range((SELECT min(fy) FROM filings), (SELECT max(fy) FROM filings) + 1)) AS fy, CASE WHEN currency = 'HKD' THEN ['H1', 'H2', 'FY'] ELSE ['Q1', 'Q2', 'Q3', 'Q4', 'FY'] END AS kinds FROM companies),
u2 AS (SELECT ticker, fy, unnest(kinds) AS period_type FROM u), cells AS (SELECT u2.*, m AS metric FROM u2, (SELECT unnest({METRICS}) AS m))"""
QUOTED = """CASE WHEN suppkey % 3 > 0 THEN 'Total for segment ' || (suppkey % 10) || ' was ' || format('{:,}', round_even(value_usd * CASE WHEN suppkey % 7 = 0 THEN 2 ELSE 1 END, 0)::BIGINT) || ' against 112,000,000' END"""
CROSS = "suppkey % 3 = 0 OR abs(round_even(value_usd * CASE WHEN suppkey % 7 = 0 THEN 2 ELSE 1 END, 0) - abs(value_usd)) <= 0.005 * greatest(abs(value_usd), 1)"
SIGN = "CASE WHEN suppkey % 5 = 0 AND value_usd > 0 AND metric IN ('m1', 'm2') THEN 'error' WHEN suppkey % 5 = 0 AND value_usd > 0 AND metric = 'm4' AND ticker NOT BETWEEN 1 AND 4 THEN 'warn' ELSE 'ok' END"
MONEY = "CASE WHEN currency = 'USD' THEN CASE WHEN abs(value - value_usd) > 0.5 THEN 'error' ELSE 'ok' END WHEN suppkey % 7 = 0 THEN 'warn' WHEN abs(value_usd / value - (1 - floor(quantity / 5) / 100)) / (1 - floor(quantity / 5) / 100) > 0.001::DOUBLE THEN 'warn' ELSE 'ok' END"
SEGMENT = f"metric <> 'm5' OR NOT named OR contains(lower(coalesce({QUOTED}, '')), 'cloud') OR contains(coalesce({QUOTED}, ''), 'segment 7') OR (also AND contains(coalesce({QUOTED}, ''), 'segment 1'))"
DAYS = "CASE WHEN suppkey % 13 = 0 THEN NULL WHEN suppkey % 11 = 0 THEN 360 WHEN period_type IN ('H1', 'H2') THEN 180 WHEN period_type = '9M' THEN 270 WHEN period_type = 'FY' THEN 360 ELSE 90 END"
DURATION = f"coalesce(CASE WHEN period_type LIKE 'Q_' THEN {DAYS} BETWEEN 75 AND 105 WHEN period_type = 'H1' THEN {DAYS} BETWEEN 160 AND 200 WHEN period_type = '9M' THEN {DAYS} BETWEEN 250 AND 290 WHEN period_type = 'FY' THEN {DAYS} BETWEEN 350 AND 370 END, true)"
GAPS = f"""{CELLS}, c AS (SELECT ticker, fy, bool_or(form IN ('10-K', '20-F', 'HK-AR')) AS annual, bool_or(form = '6-K') AS k6, bool_or(form NOT IN ('10-K', '20-F', 'HK-AR', '6-K')) AS interim FROM filings GROUP BY ALL),
gaps AS (SELECT cells.*, w.doc_id, w.value_usd, w.model, CASE WHEN w.doc_id IS NOT NULL THEN 'present' WHEN coalesce(CASE cells.period_type WHEN 'FY' THEN annual WHEN 'Q4' THEN annual OR k6 ELSE k6 OR interim END, false) THEN 'gap_fixable' ELSE 'gap_unfixable' END AS gap
  FROM cells LEFT JOIN won w USING (ticker, fy, metric, period_type) LEFT JOIN c USING (ticker, fy))"""
RANGED = f"bounds AS (SELECT * FROM (VALUES {_bounds}) b(ticker, metric, grp, lo, hi))"


def _ranged(source: str) -> str:
    group = "CASE WHEN period_type LIKE 'Q_' THEN 'Q1_Q2_Q3_Q4' ELSE period_type END"
    owner = "(b.ticker = x.ticker OR (b.ticker IS NULL AND NOT EXISTS (SELECT 1 FROM bounds o WHERE o.ticker = x.ticker AND o.metric = x.metric)))"
    pick = lambda c: f"(SELECT arg_min(b.{c}, CASE WHEN b.grp = {group} THEN 0 ELSE 1 END) FROM bounds b WHERE b.metric = x.metric AND {owner} AND b.grp IN ({group}, period_type))"
    return f"SELECT *, CASE WHEN value_usd < lo THEN 'below' WHEN value_usd > hi THEN 'above' ELSE 'within' END AS range FROM (SELECT x.*, {pick('lo')} AS lo, {pick('hi')} AS hi FROM {source} x)"


def _violations_sql(source: str) -> str:
    part = lambda p: f"max(CASE WHEN period_type = '{p}' THEN abs(value_usd) END)"
    bad = lambda whole, parts: f"abs({whole} - ({parts})) / greatest(abs({whole}), abs({parts}), 1.0) > {TOLERANCE}"
    inner = f"SELECT ticker, fy, metric, {part('Q1')} AS a, {part('Q2')} AS b, {part('Q3')} AS c, {part('Q4')} AS d, {part('H1')} AS h, {part('9M')} AS m, {part('FY')} AS y FROM {source} GROUP BY ALL"
    return f"SELECT ticker, fy, metric, concat_ws(';', CASE WHEN {bad('y', 'a + b + c + d')} THEN 'FY=Q1+Q2+Q3+Q4' END, CASE WHEN {bad('m', 'a + b + c')} THEN '9M=Q1+Q2+Q3' END, CASE WHEN {bad('h', 'a + b')} THEN 'H1=Q1+Q2' END) AS violations FROM ({inner})"


CONTINUITY = "SELECT ticker, fy, metric, period_type, value_usd / nullif(lag(value_usd) OVER (PARTITION BY ticker, metric ORDER BY fy, period_type, value_usd), 0) AS factor FROM won WHERE period_type IN ('Q1', 'Q2', 'Q3', 'Q4')"
CHECKED = f"""{GAPS}, {RANGED}, ident AS ({_violations_sql('won')}), cont AS ({CONTINUITY}), ranged AS ({_ranged('won')}),
checked AS (SELECT r.*, concat_ws(';', CASE WHEN coalesce(violations, '') <> '' THEN 'identity' END, CASE WHEN range <> 'within' THEN 'range' END, CASE WHEN coalesce(NOT factor BETWEEN 0.4 AND 2.5, false) THEN 'continuity' END,
    CASE WHEN NOT ({CROSS}) THEN 'cross_source' END, CASE WHEN {SIGN} = 'error' THEN 'sign_error' END, CASE WHEN {SIGN} = 'warn' THEN 'sign_warn' END, CASE WHEN {MONEY} = 'error' THEN 'currency_error' END, CASE WHEN {MONEY} = 'warn' THEN 'currency_warn' END,
    CASE WHEN NOT ({SEGMENT.replace('named', 'true').replace('also', 'false')}) THEN 'segment_def' END, CASE WHEN NOT {DURATION} THEN 'period_type' END) AS failed
  FROM ranged r LEFT JOIN ident USING (ticker, fy, metric) LEFT JOIN cont USING (ticker, fy, metric, period_type))"""
AUDITED = f"""{CHECKED}, audited AS (SELECT *, CASE WHEN gap <> 'present' THEN gap WHEN failed <> '' THEN 'flagged' WHEN starts_with(model, 'reconcile-derived') THEN 'derived' ELSE 'verified' END AS class,
  CASE WHEN contains(failed, 'period_type') OR (contains(failed, 'cross_source') AND NOT contains(failed, 'identity')) THEN 'refetch' WHEN failed = 'identity' THEN 'reconcile' WHEN contains(failed, 'range') OR contains(failed, 'continuity') THEN 'refetch' WHEN gap = 'gap_fixable' THEN 'extract' END AS fix
  FROM (SELECT gaps.*, coalesce(c.failed, '') AS failed FROM gaps LEFT JOIN checked c USING (ticker, fy, metric, period_type)))"""
_won = f"{SQL}, won AS ({AUDIT}) SELECT ticker, fy, metric, period_type"
ORACLES = {
    "cell_universe": f"{CELLS} SELECT ticker, fy, metric, period_type FROM cells",
    "check_gap": f"{GAPS} SELECT ticker, fy, metric, period_type, gap, doc_id FROM gaps",
    "check_identity": f"{_derive_sql()}, every AS (SELECT ticker, fy, metric, unnest(['Q1', 'Q2', 'Q3', 'Q4', 'H1', '9M', 'FY']) AS period_type, unnest([v_q1, v_q2, v_q3, v_q4, v_h1, v_9m, v_fy]) AS value_usd FROM wide), long AS (SELECT * FROM every WHERE value_usd IS NOT NULL) {_violations_sql('long')}",
    "check_range": f"{SQL}, won AS ({AUDIT}), {RANGED} SELECT ticker, fy, metric, period_type, range FROM ({_ranged('won')})",
    "check_continuity": f"{SQL}, won AS ({AUDIT}) SELECT ticker, fy, metric, period_type, round(factor, 6) AS factor, factor IS NULL OR factor BETWEEN 0.4 AND 2.5 AS continuous FROM ({CONTINUITY})",
    "check_cross_source": f"{_won}, {CROSS} AS passed FROM won",
    "check_sign": f"{_won}, {SIGN} AS sign FROM won",
    "check_currency": f"{_won}, {MONEY} AS verdict FROM won",
    "check_period_type": f"{_won}, {DURATION} AS passed FROM won",
    "check_segment_def": f"{_won}, {SEGMENT} AS passed FROM (SELECT *, suppkey % 4 > 0 AS named, true AS also FROM won)",
    "verdict_severity": f"{AUDITED} SELECT ticker, fy, metric, period_type, doc_id, failed, CASE WHEN contains(failed, 'identity') OR contains(failed, '_error') THEN 'error' ELSE 'warn' END AS severity FROM audited WHERE class = 'flagged'",
    "fix_batches": f"{AUDITED} SELECT fix, count(*) AS cells, count(DISTINCT ticker) AS tickers, min(fy) AS first, max(fy) AS last, string_agg(DISTINCT metric, ',' ORDER BY metric) AS metrics FROM audited WHERE fix IS NOT NULL GROUP BY fix",
    "fixes_dry_run": f"{AUDITED} SELECT ticker, fy, metric, period_type, fix, CASE WHEN fix = 'extract' AND period_type = 'FY' OR fix = 'refetch' THEN 'facts' WHEN fix = 'extract' THEN 'model' END AS extractor, value_usd AS old_usd, NULL::DOUBLE AS new_usd FROM audited WHERE fix IS NOT NULL",
    "run_value_checks": f"{CHECKED} SELECT doc_id, ticker, fy, metric, period_type, x AS check_name, NOT list_contains(string_split(failed, ';'), x) AS passed, CASE WHEN ends_with(x, '_warn') THEN 'warn' ELSE 'error' END AS severity FROM checked, (SELECT unnest({VALUE_CHECKS}) AS x)",
    "period_coverage": f"{SQL}, won AS ({AUDIT}) SELECT ticker, metric, fy, " + ", ".join(f"CASE max(CASE WHEN starts_with(model, 'reconcile-derived') THEN 1 ELSE 2 END) FILTER (period_type = '{p}') WHEN 2 THEN 'stored' WHEN 1 THEN 'derived' ELSE '-' END AS \"p_{p}\"" for p in ("Q1", "Q2", "Q3", "Q4", "H1", "9M", "FY")) + " FROM won GROUP BY ALL",
    "audit_rollup": f"""{AUDITED}, x AS (SELECT *, class = 'gap_unfixable' AS gone, class IN ('verified', 'derived') AS good, metric AS m, fy AS y, class AS c FROM audited)
SELECT CASE WHEN grouping(class) = 0 THEN 'class' WHEN grouping(ticker) = 1 THEN 'all' WHEN grouping(metric) = 0 THEN 'coverage' ELSE 'company' END AS level, ticker, metric, class, count(*) AS n, round(count(*) FILTER (good) / count(*) * 100, 2) AS pct,
  count(*) FILTER (c = 'flagged') AS flagged, count(*) FILTER (gone) AS unfixable, count(DISTINCT m) FILTER (gone) AS metrics, min(y) FILTER (gone) AS first, max(y) FILTER (gone) AS last FROM x GROUP BY GROUPING SETS ((metric, class), (ticker, metric), (ticker), ())""",
    "classify_cells": f"{AUDITED} SELECT metric, class, count(*) AS n FROM audited GROUP BY ALL",
    "fix_routing": f"{AUDITED} SELECT ticker, fy, metric, period_type, fix, failed FROM audited WHERE fix IS NOT NULL",
    "coverage_matrix": f"{AUDITED} SELECT ticker, " + ", ".join(f"round(avg(CASE WHEN class IN ('verified', 'derived') THEN 1.0 ELSE 0.0 END) FILTER (metric = '{m}') * 100, 2) AS {m}_pct, bool_or(class = 'flagged') FILTER (metric = '{m}') AS {m}_flag" for m in METRICS) + " FROM audited GROUP BY ticker",
    "unfixable_gaps": f"{AUDITED} SELECT ticker, count(*) AS n, count(DISTINCT metric) AS metrics, min(fy) AS first, max(fy) AS last FROM audited WHERE class = 'gap_unfixable' GROUP BY ticker",
    "flag_clusters": f"{AUDITED} SELECT ticker, metric, count(*) FILTER (class = 'flagged') AS n, string_agg(fy || period_type, ',' ORDER BY fy || period_type) FILTER (class = 'flagged') AS members, string_agg(fy || period_type, ',' ORDER BY fy || period_type) AS siblings FROM audited GROUP BY ALL HAVING n > 0",
    "restatement_detect": f"""{SQL}, r AS (SELECT ticker, fy, metric, period_type, arg_min(value_usd, (filing_date, doc_id, partkey, suppkey, quantity, tax, value)) AS first, arg_max(value_usd, (filing_date, doc_id, partkey, suppkey, quantity, tax, value)) AS last, count(*) AS n
FROM facts WHERE period_type <> '' GROUP BY ALL) SELECT *, round(abs(last - first) / greatest(abs(first), 1.0), 6) AS change FROM r WHERE n >= 2 AND abs(last - first) / greatest(abs(first), 1.0) > 0.005""",
}
