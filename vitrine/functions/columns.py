"""Scalar column functions.

Every function returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage code generation; there is no Python UDF here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the source format: the partner placeholder for a
# missing name, the key separator, the path separators on input and output.
UNKNOWN_PARTNER = "_unknown"
KEY_SEPARATOR = "_"
SOURCE_PATH_SPLIT = r"\\+"          # one or more backslashes
PATH_SEPARATOR = "/"

# Whitespace removed around text, as Python's str.strip does: Unicode white
# space plus the four ASCII separator controls.
_WS = r"[\s\x1c-\x1f]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Remove surrounding white space, tabs and newlines included
    (``trim`` only removes blanks)."""
    return F.regexp_replace(_c(x), _STRIP_RE, "")


def normalize_partner(x) -> Column:
    """Partner clean-up (G7): null to ``_unknown``; otherwise strip, lower,
    blanks to ``_`` and a leading ``_`` added when absent."""
    s = F.replace(F.lower(strip(_c(x).cast("string"))), F.lit(" "), F.lit("_"))
    return F.when(_c(x).isNull(), F.lit(UNKNOWN_PARTNER)) \
            .otherwise(F.when(s.startswith("_"), s).otherwise(F.concat(F.lit("_"), s)))


def split_path(x) -> Column:
    """Category path text to parts (G8): split on runs of backslash, strip
    each part, drop empty parts; null gives an empty array."""
    parts = F.split(F.coalesce(_c(x).cast("string"), F.lit("")), SOURCE_PATH_SPLIT)
    return F.filter(F.transform(parts, strip), lambda p: p != F.lit(""))


def join_path(parts) -> Column:
    """Parts joined with ``/``."""
    return F.array_join(_c(parts), PATH_SEPARATOR)


def parent_path(parts) -> Column:
    """Parent path, null at level 0 and 1."""
    n = F.size(_c(parts))
    return F.when(n > 1, F.array_join(F.slice(_c(parts), F.lit(1), n - 1), PATH_SEPARATOR))


def last_or_null(parts) -> Column:
    """Last element or null for an empty array."""
    return F.try_element_at(_c(parts), F.lit(-1))


def depth(parts) -> Column:
    """Array length with a null array counted as empty."""
    return F.size(F.coalesce(_c(parts), F.array().cast("array<string>")))


def element_or_null(arr, index0: int) -> Column:
    """0-based element, null when out of bounds."""
    return F.get(_c(arr), F.lit(index0))


def breadcrumbs(parts) -> Column:
    """Parts enumerated to ``{level: i+1, name}`` structs."""
    return F.transform(_c(parts), lambda name, i: F.struct((i + 1).alias("level"), name.alias("name")))


def doc_key(*cols) -> Column:
    """Key concatenation with ``_`` (G16); null when any part is null, so a
    row without a key is rejected instead of getting an invented one."""
    out = [_c(cols[0])]
    for c in cols[1:]:
        out += [F.lit(KEY_SEPARATOR), _c(c)]
    return F.concat(*out)


def month_key(d) -> Column:
    """``toYYYYMM`` of a date."""
    return F.year(_c(d)) * 100 + F.month(_c(d))


def epoch_micros(ts_ntz) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp, independent of
    the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, _c(ts_ntz))


def hour_floor(ts_ntz) -> Column:
    """Start of the hour of a wall-clock timestamp (used for ``Hour``)."""
    return F.date_trunc("hour", _c(ts_ntz)).cast("timestamp_ntz")


def safe_ratio(num, den) -> Column:
    """Division that gives null on a zero or missing denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


_SPLITTER = float((1 << 27) + 1)


def round_half_even(x, digits: int = 0) -> Column:
    """A double rounded to ``digits`` decimals as Python's ``round`` does (G18):
    by its exact binary value, halves to the even digit (2.675 lies below the
    half and gives 2.67, 0.125 is one and gives 0.12).

    The product with the power of ten is taken exactly, as a double and what
    was rounded off it (both factors split into halves of 26 bits), so it is
    compared with the half as it is.
    """
    power = 10.0 ** digits
    x = _c(x).cast("double")

    def high(v: Column) -> Column:
        c = v * F.lit(_SPLITTER)
        return c - (c - v)

    p = x * F.lit(power)
    xh, th = high(x), (_SPLITTER * power) - (_SPLITTER * power - power)
    xl, tl = x - xh, power - th
    off = ((xh * F.lit(th) - p) + xh * F.lit(tl) + xl * F.lit(th)) + xl * F.lit(tl)
    down = F.floor(p).cast("double")
    past = (p - down) - F.lit(0.5)
    odd = F.pmod(down, F.lit(2.0)) == F.lit(1.0)
    below = (p == down) & (off == F.lit(-0.5))  # a half itself, below a product that was rounded up to it
    whole = F.when((past > -off) | ((past == -off) & odd), down + F.lit(1.0)).when(below & odd, down - F.lit(1.0)).otherwise(down)
    exact = F.isnan(x) | (F.abs(p) >= F.lit(float(1 << 53)))  # no decimals left to round
    return F.when(x.isNull(), F.lit(None)).when(exact, x).otherwise(whole / F.lit(power))
