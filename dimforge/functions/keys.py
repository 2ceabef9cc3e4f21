"""Column-level building blocks (no UDFs: every function returns a Column
expression, so it stays inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for keys to match across runs).
# Accented letters and, position by position, their plain replacements.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"
# Whitespace collapsed by the text key: space, tab, newline, vertical tab,
# form feed, carriage return (written out so every engine agrees).
WHITESPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"
# Size bands: population edges and labels.
BAND_SMALL_MAX = 100_000      # strictly below -> small
BAND_MEDIUM_MAX = 500_000     # up to and including -> medium
BAND_UNKNOWN = "Not informed"
BAND_SMALL = "Small (up to 100k)"
BAND_MEDIUM = "Medium (100k to 500k)"
BAND_LARGE = "Large (above 500k)"
# Trip status labels, in precedence order.
STATUS_CANCELLED = "Cancelled"
STATUS_LATE = "Completed late"
STATUS_DONE = "Completed"
STATUS_RUNNING = "In progress"
# Open-ended validity: start sentinel for first versions, far-future end.
VALID_FROM_SENTINEL = "1900-01-01"
VALID_TO_OPEN = "9999-12-31"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalise_text(x) -> Column:
    """Collapse whitespace runs to one space, trim, strip accents, upper-case."""
    collapsed = F.trim(F.regexp_replace(_c(x), WHITESPACE_RUN, " "))
    # sharp s upper-cases to "SS"; folding it first keeps the key engine-independent
    folded = F.replace(F.translate(collapsed, ACCENTED, PLAIN), F.lit("ß"), F.lit("ss"))
    return F.upper(folded)


def place_key(name, region) -> Column:
    """'São Gonçalo', ' rj ' -> 'SAO GONCALO/RJ'; NULL in, NULL out."""
    return F.concat(normalise_text(name), F.lit("/"), F.upper(F.trim(_c(region))))


def size_band(population) -> Column:
    p = _c(population)
    return (F.when(p.isNull(), BAND_UNKNOWN)
            .when(p < BAND_SMALL_MAX, BAND_SMALL)
            .when(p <= BAND_MEDIUM_MAX, BAND_MEDIUM)
            .otherwise(BAND_LARGE))


def surrogate_key(namespace: str, *cols) -> Column:
    """Deterministic surrogate key: md5 of 'namespace|c1|c2...'.

    Rebuilding a table gives the same keys, so reruns and set-difference
    reconciliations line up (a random UUID would not).  Separators inside a
    part are escaped and NULL has a mark of its own, so that different parts
    never make one key.
    """
    def part(c):
        text = _c(c).cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        return F.coalesce(escaped, F.lit("\\N"))
    return F.md5(F.concat_ws("|", F.lit(namespace), *[part(c) for c in cols]))


def money(x) -> Column:
    """Fixed two-decimal money."""
    return _c(x).cast("decimal(18,2)")


def decode(x, mapping: dict, default) -> Column:
    """Simple CASE: listed codes map to labels, everything else (NULL too)
    falls to ``default``."""
    c = _c(x)
    expr = None
    for code, label in mapping.items():
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    return expr.otherwise(default)


# -- calendar attributes ----------------------------------------------------

def weekday_abbrev(d) -> Column:
    return F.upper(F.date_format(_c(d), "EEE"))


def month_text(d) -> Column:
    return F.date_format(_c(d), "MM")


def calendar_key(d) -> Column:
    """Integer yyyymmdd of the date (readable, ordered, no hashing)."""
    x = _c(d).cast("date")
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def minutes_between(start, end) -> Column:
    """Whole minutes from start to end, rounded half away from zero
    (casting straight to int would truncate); exact to the microsecond, and
    on local times, whatever the session's zone."""
    gap = _c(end).cast("timestamp_ntz") - _c(start).cast("timestamp_ntz")
    secs = gap.cast("interval second").cast("decimal(28,6)")
    return F.round(secs / F.lit(60).cast("decimal(2,0)"), 0).cast("bigint")


def trip_status(has_cancel, has_delay, end_ts) -> Column:
    """Any cancel notice wins; else any delay; else finished if it has an end."""
    return (F.when(_c(has_cancel), STATUS_CANCELLED)
            .when(_c(has_delay), STATUS_LATE)
            .when(_c(end_ts).isNotNull(), STATUS_DONE)
            .otherwise(STATUS_RUNNING))


def rate_per_100k(count, population) -> Column:
    """round(count * 100000 / population, 2), half up on the *exact* quotient,
    NULL when the population is NULL or zero (measures are non-negative).

    Computed in integers: with c = count in cents, the rate in cents is
    floor((2 * c * 100000 + p) / (2 * p)); the floor is taken exactly with
    ``pmod``, so no intermediate decimal or double rounding can flip a half.
    """
    p = F.nullif(_c(population), F.lit(0)).cast("decimal(38,0)")
    cents = (_c(count).cast("decimal(38,2)") * F.lit(100)).cast("decimal(38,0)")
    num = cents * F.lit(200000) + p
    den = p * F.lit(2)
    q = ((num - F.pmod(num, den)) / den).cast("decimal(38,0)")
    return (q / F.lit(100)).cast("decimal(18,2)")
