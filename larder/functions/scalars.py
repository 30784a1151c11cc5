"""Column expressions: scores, names, dates, movement classes, surrogate keys and word tokens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MISSING_SCORE = "Falta Dato"
SHELF_LIFE_DAYS = {4: 7, 16: 12, 7: 30, 13: 120, 19: 45}
DEFAULT_SHELF_LIFE = 14
DEFAULT_HOUR_SHARE = 0.05
GRACE_DAYS = 2
SCORE_UPPER_BOUNDS = [("A", 50.0), ("B", 150.0), ("C", 300.0)]
LAST_SCORE = "D"

# English words left out of the text features.
STOP_WORDS = (
    "a about above after again against all also am an and another any are around as at be because been before being "
    "below between both but by can cannot could did do does doing done down due during each either else enough etc "
    "even ever every few first for from further get go had has have he hence her here hers herself him himself his "
    "how however i if in indeed into is it its itself last least less made many may me might mine more most much must "
    "my myself neither never no nor not now of off often on once one only or other others our ours ourselves out over "
    "own per please put rather same see seem she should since so some still such than that the their theirs them "
    "themselves then there these they this those though through thus to together too toward two under until up upon "
    "us very was we well were what when where which while who whole whom whose why will with within without would yet "
    "you your yours yourself "
    "bill bottom call cry describe detail eleven empty fifteen fifty fill find fire five forty found four front full give "
    "hundred interest keep mill move name nine part show side sincere six sixty system ten thick thin third three top "
    "twelve twenty"
).split()

# Maximal runs of at least two letters, digits or underscores.
TOKEN_PATTERN = r"([\p{L}\p{N}_]{2,})"


def lookup_constant(key: Column, table: Mapping, default=None) -> Column:
    """Small constant map as an expression; NULL or ``default`` for an unmapped key."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def hour_share(hour: Column, shares: Mapping) -> Column:
    """Share of the movements that fall in an hour; an hour that the shares do not list gets the default."""
    return lookup_constant(hour, shares, DEFAULT_HOUR_SHARE)


def nutriscore(calories: Column) -> Column:
    expr = F.when(calories.isNull() | F.isnan(calories), F.lit(MISSING_SCORE))
    for grade, bound in SCORE_UPPER_BOUNDS:
        expr = expr.when(calories < bound, F.lit(grade))
    return expr.otherwise(F.lit(LAST_SCORE))


def search_name(name: Column) -> Column:
    """Name used to look a product up: every 'Organic' removed, white space stripped at the ends only."""
    return F.regexp_replace(F.replace(name, F.lit("Organic"), F.lit("")), r"^\s+|\s+$", "")


def out_indicator(event_type: Column) -> Column:
    return F.when(event_type == "OUT", F.lit(1)).otherwise(F.lit(0))


def parse_timestamp(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def shelf_life(category: Column) -> Column:
    return F.coalesce(lookup_constant(category, SHELF_LIFE_DAYS), F.lit(DEFAULT_SHELF_LIFE))


def expiry_date(purchase_day: Column, category: Column) -> Column:
    return F.date_add(purchase_day, shelf_life(category))


def writeoff_day(expiry: Column) -> Column:
    """First day later than the expiry date plus the grace days."""
    return F.date_add(expiry, GRACE_DAYS + 1)


def end_of_day(day: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), F.lit(23), F.lit(59), F.lit(59)
    )


def classify_movement(event_type: Column, day: Column, expiry: Column) -> Column:
    """Purchase for IN; for OUT by calendar day: past the expiry or in time. Only the expiry sweep writes Forced_Waste."""
    return (
        F.when(event_type == "IN", F.lit("Purchase"))
        .when(day > expiry, F.lit("Waste"))
        .otherwise(F.lit("Consumption"))
    )


def surrogate_key(*cols: Column, length: int = 16) -> Column:
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.substring(F.sha2(text, 256), 1, length)


def tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-cased word tokens of two or more characters, repeats kept, stop words dropped."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(1))
    return F.filter(found, lambda t: ~t.isin(list(stop_words)))
