"""Column expressions: parsing, vocabularies, units, levels and labels. All JVM-side."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import ENUMS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def number(text: Column | str) -> Column:
    """Lenient: 'None', blank, NaN and infinities are null; zero stays zero."""
    v = F.trim(_c(text)).try_cast("double")
    return finite(F.when(F.lower(F.trim(_c(text))) != "none", v))


def finite(v: Column | str) -> Column:
    v = _c(v)
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v)


def truth(text: Column | str) -> Column:
    """Lenient boolean; unknown words are null."""
    v = F.lower(F.trim(_c(text)))
    return F.when(v.isin("true", "yes", "1", "on", "enabled", "y", "t"), True).when(v.isin("false", "no", "0", "off", "disabled", "n", "f"), False)


def encode(metric: str, word: Column | str) -> Column:
    """An enum word's code; null for unknown words."""
    table = F.create_map(*(F.lit(x) for x in chain(*ENUMS[metric].items())))
    return F.try_element_at(table, F.lower(F.trim(_c(word))))


def decode(metric: str, code: Column | str) -> Column:
    """The word of a code; an unknown code is kept as digits."""
    table = F.create_map(*(F.lit(x) for x in chain(*((v, k) for k, v in ENUMS[metric].items()))))
    return F.coalesce(F.try_element_at(table, _c(code).cast("int")), _c(code).cast("int").cast("string"))


def stage_pct(text: Column | str) -> Column:
    """A numeric stage in 0..100; a word or a number out of range is null, never clamped."""
    v = number(text)
    return F.when(v.between(0, 100), v)


def fahrenheit(v: Column | str, unit: Column | str) -> Column:
    return F.when(_c(unit) == "F", _c(v)).when(_c(unit) == "C", _c(v) * 9 / 5 + 32)


def two_pole(poles: Column | str, a: Column | str, b: Column | str, how: str = "sum") -> Column:
    """A breaker's value: one leg, or both (null if either is) summed or averaged."""
    both = _c(a) + _c(b)
    return F.when(_c(poles) >= 2, both if how == "sum" else both / 2).otherwise(_c(a))


def level(channel: Column | str = "channel_id") -> Column:
    """Where a channel stands: feed, subfeed, branch, reference or other. Levels nest, so they are never summed together."""
    c = _c(channel)
    return F.when(c.isin("ct_1_a", "ct_1_b"), "feed").when(c.like("ct_2%"), "subfeed").when(c.like("breaker_%"), "branch").when(c.like("panel_leg_%"), "reference").otherwise("other")


def is_child(channel: Column | str = "channel_id") -> Column:
    return _c(channel).like("breaker_%") | _c(channel).like("ct_2%")


def coverage_class(pct: Column | str) -> Column:
    p = _c(pct)
    return F.when(p.isNull(), "unknown").when(p >= 98, "complete").when(p >= 80, "thin").when(p >= 50, "sparse").otherwise("mostly missing")


def to_kwh(value: Column | str, power: Column | str, uom: Column | str) -> Column:
    """Watt-hours times ten to the power, in kWh; other units are null."""
    return F.when(_c(uom) == 72, _c(value) * F.pow(F.lit(10.0), _c(power)) / 1000)


def category(role: Column | str, kind: Column | str) -> Column:
    """From the leading word of the circuit's kind, else its role; unknown is null."""
    first = F.lower(F.regexp_extract(F.coalesce(_c(kind), F.lit("")), "^([A-Za-z]+)", 1))
    known = F.when(first.isin("hvac", "heat", "cool"), "hvac").when(first.isin("water"), "water_heating").when(first.isin("light", "lighting"), "lighting").when(first.isin("kitchen", "range", "oven"), "kitchen").when(first.isin("ev", "charger"), "ev")
    return F.coalesce(known, F.when(F.lower(_c(role)) == "feed", "feed").when(F.lower(_c(role)) == "solar", "generation"))


def channel_name(channel: Column | str = "channel_id") -> Column:
    """A readable name by pattern; the id itself where no pattern holds."""
    c = _c(channel)
    return F.coalesce(
        F.when(c.rlike("^breaker_p[0-9]+$"), F.concat(F.lit("Breaker "), F.regexp_extract(c, "([0-9]+)$", 1))),
        F.when(c.rlike("^ct_[0-9]+_[ab]$"), F.concat(F.lit("CT "), F.regexp_extract(c, "^ct_([0-9]+)", 1), F.lit(" leg "), F.upper(F.regexp_extract(c, "_([ab])$", 1)))),
        F.when(c.rlike("^panel_leg_[ab]$"), F.concat(F.lit("Panel leg "), F.upper(F.regexp_extract(c, "_([ab])$", 1)))),
        F.when(c.rlike("^zone_[0-9]+$"), F.concat(F.lit("Zone "), F.regexp_extract(c, "([0-9]+)$", 1))),
        c,
    )


def label_or_tail(label: Column | str, channel: Column | str = "channel_id", device: Column | str = "device_id") -> Column:
    """A mapped label, else the id with the device's tail, so two devices never share one."""
    return F.coalesce(_c(label), F.concat(_c(channel), F.lit(" · "), F.element_at(F.split(_c(device), "_"), -1)))


def freshness(age_s: Column | str, interval_s: float) -> Column:
    a = _c(age_s)
    return F.when(a <= 1.5 * interval_s, "live").when(a <= 3 * interval_s, "late").otherwise("silent")
