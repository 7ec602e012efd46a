"""Scalar column functions: months, seasons, rounding rules, display forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a single-precision value is compared and cut at so many decimals of its double
SINGLE_DECIMALS = 6

# Meteorological seasons (December counts as winter, all years pooled) and their labels.
SEASON_MONTHS = {
    "DJF": ("12", "01", "02"),
    "MAM": ("03", "04", "05"),
    "JJA": ("06", "07", "08"),
    "SON": ("09", "10", "11"),
}

# Display names of the countries around the study area, by ISO 3166-1 alpha-3.
COUNTRY_NAMES = {
    "ALB": "Albania", "BIH": "Bosnia and Herzegovina", "CYP": "Cyprus", "DZA": "Algeria", "EGY": "Egypt",
    "ESP": "Spain", "FRA": "France", "GBR": "United Kingdom", "GIB": "Gibraltar", "GRC": "Greece",
    "HRV": "Croatia", "ISR": "Israel", "ITA": "Italy", "LBN": "Lebanon", "LBY": "Libya", "MAR": "Morocco",
    "MCO": "Monaco", "MLT": "Malta", "MNE": "Montenegro", "PSE": "Palestine", "SVN": "Slovenia",
    "SYR": "Syria", "TUN": "Tunisia", "TUR": "Türkiye", "UNK": "Outside EEZ / unknown",
}


def month_of(timestamp: Column) -> Column:
    """``'2026-06-09 16:59:26.591 UTC'`` or ``'2026-06-01'`` -> ``'2026-06'``."""
    return F.substring(timestamp, 1, 7)


def season_of(month: Column) -> Column:
    number = F.substring(month, 6, 2)
    branches = [F.when(number.isin(*numbers), F.lit(name)) for name, numbers in SEASON_MONTHS.items()]
    return F.coalesce(*branches)


def widened(x: Column) -> Column:
    """A 32-bit value as double at its decimal value: 0.9f becomes 0.9, not 0.89999998."""
    return F.round(x.cast("double"), SINGLE_DECIMALS)


def num(x: Column, decimals: int | None = None) -> Column:
    """Publishable number: NaN becomes NULL; rounded half-even when ``decimals`` is given."""
    x = x.cast("double")
    value = F.when(~F.isnan(x), x)
    if decimals is None:
        return value
    return F.bround(value, 0).cast("bigint") if decimals == 0 else F.bround(value, decimals)


def floor_nd(x: Column, decimals: int) -> Column:
    """Cut to ``decimals``. The cut is made at the decimal value a single-precision number stands for."""
    scale = float(10**decimals)
    return F.floor(F.bround(num(x) * F.lit(scale), SINGLE_DECIMALS - decimals)) / F.lit(scale)


def step_round(x: Column, step: int) -> Column:
    """Nearest multiple of ``step``, ties to the even multiple."""
    return (F.rint(num(x) / F.lit(float(step))) * F.lit(float(step))).cast("bigint")


def ais_class(matched: Column, confident: Column, stationary: Column) -> Column:
    """0 no match, 1 uncertain match, 2 confident, 3 confident and stationary."""
    return matched.cast("int") + confident.cast("int") + stationary.cast("int")


def is_annual(period: Column) -> Column:
    return F.length(period) == 4


def period_months(period: Column) -> Column:
    """Months a release covers: twelve for ``'2024'``, one for ``'202407'``."""
    year = F.substring(period, 1, 4)
    whole = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.concat(year, F.lit("-"), F.lpad(m.cast("string"), 2, "0")))
    return F.when(is_annual(period), whole).otherwise(F.array(F.concat(year, F.lit("-"), F.substring(period, 5, 2))))


def month_label(month: Column) -> Column:
    """``'2025-08'`` -> ``'Aug 2025'``; text that is no month stays as it is."""
    day = F.try_to_date(month, "yyyy-MM")
    return F.coalesce(F.when(month.rlike(r"\A\d{4}-\d{2}\z"), F.date_format(day, "MMM yyyy")), month)


def country_display(iso3: Column, data_name: Column | None = None) -> Column:
    """Name of a country: the name in the data first, then the static one, then the code itself."""
    static = F.create_map(*[F.lit(v) for kv in COUNTRY_NAMES.items() for v in kv])
    known = F.try_element_at(static, F.coalesce(iso3, F.lit("")))
    options = [known, iso3, F.lit("Unknown")]
    return F.coalesce(*([F.when(F.length(data_name) > 0, data_name)] if data_name is not None else []), *options)


def decode_ais(cls: Column, conf: Column, speed: Column, length: Column, flag: Column) -> list[Column]:
    """Display fields of a published point from its class: a = 1 for a confident match, st = 1 when it is stationary;
    an uncertain match shows only its confidence, a confident one its speed, length and flag."""
    known, confident = cls.isNotNull(), cls >= 2
    return [
        F.when(known, confident.cast("int")).alias("a"),
        F.when(cls >= 1, (cls == 3).cast("int")).alias("st"),
        F.when(cls == 1, conf).alias("shown_conf"),
        F.when(confident, speed).alias("shown_speed"),
        F.when(confident, length).alias("shown_length"),
        F.when(confident, flag).alias("shown_flag"),
    ]


def country_names(eez: DataFrame) -> DataFrame:
    """First name per country by polygon priority; ``UNK`` keeps its preset name."""
    named = eez.groupBy("iso3").agg(F.min_by("name", F.struct("priority", "name")).alias("name"))
    return named.withColumn("name", F.when(F.col("iso3") == "UNK", F.lit("Unknown / outside EEZ")).otherwise(F.col("name")))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)
