"""Pricing in exact decimals: every printed line is rounded half up, then lines are summed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MONEY = "decimal(18,2)"


def money(x: Column) -> Column:
    return F.round(x.cast("decimal(28,10)"), 2).cast(_MONEY)


def periods(rates: DataFrame) -> DataFrame:
    """Rate periods with the day their successor starts."""
    w = Window.partitionBy("meter").orderBy("effective_from")
    return rates.withColumn("effective_to", F.lead("effective_from").over(w))


def billed_days(cycles: DataFrame) -> DataFrame:
    """(meter, cycle_start, cycle_end, local_day): the days charged are after the first read, up to the second."""
    return cycles.select("meter", "cycle_start", "cycle_end", F.explode(F.expr("sequence(date_add(cycle_start, 1), cycle_end, INTERVAL 1 DAY)")).alias("local_day"))


def active_period(days: DataFrame, rates: DataFrame) -> DataFrame:
    """Each day with the latest period in effect. Days before the first period drop out: see :func:`unpriced`."""
    p = periods(rates).withColumnRenamed("meter", "_m")
    on = (F.col("meter") == F.col("_m")) & (F.col("local_day") >= F.col("effective_from")) & (F.col("effective_to").isNull() | (F.col("local_day") < F.col("effective_to")))
    return days.join(p, on).drop("_m", "effective_to")


def unpriced(days: DataFrame, rates: DataFrame) -> DataFrame:
    """Days earlier than their meter's first period: to be refused, not guessed."""
    first = rates.groupBy("meter").agg(F.min("effective_from").alias("first_from"))
    return days.join(first, "meter", "left").where("first_from IS NULL OR local_day < first_from")


def allocate(spans: DataFrame, keys: list[str], order: str, weight: str, total: str, out: str = "part") -> DataFrame:
    """Whole units of ``total`` by weight, half up; the last span takes the remainder, so parts always add up.

    With no weight at all, the last span takes everything.
    """
    w = Window.partitionBy(*keys)
    run = w.orderBy(order)
    share = F.coalesce(F.try_divide(F.col(weight).cast("decimal(28,10)"), F.sum(weight).over(w).cast("decimal(28,10)")), F.lit(0))
    rows = spans.withColumn("_part", F.round(share * F.col(total), 0).cast("long")).withColumn("_last", F.lead(order).over(run).isNull())
    before = F.coalesce(F.sum("_part").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn(out, F.when(F.col("_last"), F.col(total) - before).otherwise(F.col("_part")).cast("long")).drop("_part", "_last")


def spans(cycles: DataFrame, rates: DataFrame, usage: DataFrame) -> DataFrame:
    """(meter, cycle, period, days, kWh in whole units): usage by day where every billed day has some, else by day count."""
    days = active_period(billed_days(cycles), rates).join(usage, ["meter", "local_day"], "left")
    keys = ["meter", "cycle_start", "cycle_end"]
    per = days.groupBy(*keys, "effective_from").agg(*(F.first(c).alias(c) for c in ("basic", "energy", "dsm")), F.count("*").alias("days"), F.sum("kwh").alias("used"), F.count("kwh").alias("known"))
    w = Window.partitionBy(*keys)
    full = F.sum("known").over(w) == F.sum("days").over(w)
    per = per.withColumn("total", F.round(F.coalesce(F.sum("used").over(w), F.lit(0.0)).cast("decimal(20,6)"), 0).cast("long"))
    per = per.withColumn("method", F.when(F.count("*").over(w) == 1, "single_period").when(full, "metered").otherwise("day_proration"))
    per = per.withColumn("weight", F.when(full, F.round(F.col("used").cast("decimal(20,6)"), 3)).otherwise(F.col("days").cast("decimal(20,3)")))
    return allocate(per, keys, "effective_from", "weight", "total")


def price(cycles: DataFrame, rates: DataFrame, usage: DataFrame, school_pct: float = 3.0, sales_pct: float = 0.0, fuel_in_base: bool = True, deduction: float = 0.0) -> DataFrame:
    """Charge lines of all meters and cycles in one job.

    Basic, energy and DSM are rounded per period and summed; riders apply to different bases in turn; the assistance charge
    is not taxed, and sales tax is levied on top of the school tax.
    """
    keys = ["meter", "cycle_start", "cycle_end"]
    s = spans(cycles, rates, usage)
    lines = s.groupBy(*keys).agg(
        F.sum("part").alias("kwh"), F.sum("days").alias("days"), F.max("method").alias("method"), F.sum(money(F.col("basic") * F.col("days"))).cast(_MONEY).alias("basic"),
        F.sum(money(F.col("energy") * F.col("part"))).cast(_MONEY).alias("energy"), F.sum(money(F.col("dsm") * F.col("part"))).cast(_MONEY).alias("dsm"),
    )
    out = lines.join(cycles.select(*keys, "fuel", "env_pct", "rar_pct", "pgr_pct", "hea"), keys)
    pct = lambda p, base: F.coalesce(money(F.col(p) / 100 * base), F.lit(0).cast(_MONEY))
    out = out.withColumn("fuel_charge", money(F.col("fuel") * F.col("kwh"))).withColumn("less", money(F.lit(deduction).cast("decimal(12,6)") * F.col("kwh")))
    base = F.col("basic") + F.col("energy") + F.col("dsm") + (F.col("fuel_charge") if fuel_in_base else F.lit(0)) - F.col("less")
    out = out.withColumn("base", base.cast(_MONEY)).withColumn("env", pct("env_pct", F.col("base"))).withColumn("rar", pct("rar_pct", F.col("base") + F.col("env")))
    out = out.withColumn("pgr", pct("pgr_pct", F.col("basic") + F.col("energy") - F.col("less"))).withColumn("assistance", money(F.col("hea")))
    out = out.withColumn("electric", (F.col("basic") + F.col("energy") + F.col("dsm") + F.col("fuel_charge") + F.col("env") + F.col("rar") + F.col("pgr") + F.col("assistance")).cast(_MONEY))
    tax = lambda p, b: money(F.lit(p).cast("decimal(12,6)") / 100 * b)
    out = out.withColumn("school_tax", tax(school_pct, F.col("electric") - F.col("assistance"))).withColumn("sales_tax", tax(sales_pct, F.col("electric") + F.col("school_tax")))
    out = out.withColumn("total", (F.col("electric") + F.col("school_tax") + F.col("sales_tax")).cast(_MONEY))
    return out.select(*keys, "kwh", "days", "method", "basic", "energy", "dsm", "fuel_charge", "env", "rar", "pgr", "assistance", "electric", "school_tax", "sales_tax", "total")


def cycle_for(wanted: DataFrame, cycles: DataFrame) -> DataFrame:
    """The cycle with the same read dates, else the meter's latest, flagged estimated."""
    keys, terms = ["meter", "cycle_start", "cycle_end"], ["fuel", "env_pct", "rar_pct", "pgr_pct", "hea"]
    exact = wanted.join(cycles.select(*keys, F.struct(*terms).alias("own")), keys, "left")
    last = cycles.groupBy("meter").agg(F.max_by(F.struct(*terms), "cycle_end").alias("latest"))
    out = exact.join(last, "meter", "left").withColumn("riders_estimated", F.col("own").isNull())
    return out.withColumn("terms", F.coalesce("own", "latest")).select(*keys, *(F.col(f"terms.{t}").alias(t) for t in terms), "riders_estimated")


def near_miss(bills: DataFrame, cycles: DataFrame) -> DataFrame:
    """Bills that share exactly one read date with a cycle on file: refused as mistyped."""
    c = cycles.select("meter", F.col("cycle_start").alias("_s"), F.col("cycle_end").alias("_e"))
    return bills.join(c, (bills.meter == c.meter) & ((bills.cycle_start == F.col("_s")) != (bills.cycle_end == F.col("_e"))), "left_semi")


def marginal_rates(rates: DataFrame, cycles: DataFrame, on: str, school_pct: float = 3.0, sales_pct: float = 0.0) -> DataFrame:
    """All-in price of one more kWh per meter: everything variable, taxes included; terms of the latest cycle."""
    day = F.lit(on).cast("date")
    p = rates.where(F.col("effective_from") <= day).groupBy("meter").agg(F.max_by(F.struct("energy", "dsm"), "effective_from").alias("p")).select("meter", "p.energy", "p.dsm")
    c = cycles.groupBy("meter").agg(F.max_by(F.struct("fuel", "env_pct", "rar_pct", "pgr_pct"), "cycle_end").alias("c")).select("meter", "c.*")
    d = "decimal(24,12)"
    j = p.join(c, "meter").select("meter", *(F.coalesce(F.col(x), F.lit(0)).cast("double").alias(x) for x in ("energy", "dsm", "fuel", "env_pct", "rar_pct", "pgr_pct")))
    base = F.col("energy") + F.col("dsm") + F.col("fuel")
    env = F.col("env_pct") / 100 * base
    variable = base + env + F.col("rar_pct") / 100 * (base + env) + F.col("pgr_pct") / 100 * F.col("energy")
    return j.select("meter", F.round((variable * (1 + school_pct / 100) * (1 + sales_pct / 100)).cast(d), 5).cast("double").alias("usd_per_kwh"))


def verify(priced: DataFrame, bills: DataFrame, coverage: DataFrame, tolerance_pct: float = 1.0, least: float = 0.995) -> DataFrame:
    """A verdict per bill; a bill without coverage, total or known riders has no verdict, and says which."""
    keys = ["meter", "cycle_start", "cycle_end"]
    rows = bills.join(priced.select(*keys, "total", "kwh"), keys, "left").join(coverage.select(*keys, "intervals", "expected"), keys, "left")
    covered = F.coalesce(F.col("intervals") / F.col("expected") >= least, F.lit(False))
    off = F.abs(F.col("total") - F.col("billed_total")) / F.col("billed_total") * 100
    verdict = F.when(F.col("total").isNull(), "no_verdict_estimated_riders").when(~covered, "no_verdict_coverage").when(F.col("billed_total").isNull(), "no_bill_total").when(off <= tolerance_pct, "verified").otherwise("discrepancy")
    return rows.withColumn("verdict", verdict).select(*keys, "billed_total", "total", "verdict")
