"""Column -> Column cleaning helpers (all JVM-side, codegen friendly).

The load semantics are those of the source engine's ``TRY_CAST`` and
``TRY_STRPTIME``; plain Spark casts differ on a few inputs, so each helper
restates the behaviour with built-in expressions:

* integers: ``'123.6' -> 124`` (round half away from zero, then range check);
  Spark's ``try_cast('123.6' as bigint)`` is NULL, so parse through a decimal,
  ``round`` (HALF_UP) and then narrow with ``try_cast``.  The fraction is cut to
  its first digit before the cast, which alone decides the rounding, so
  ``'2.49999999999'`` stays 2; texts with an exponent go through DECIMAL(38,18).
* ``'1_000' -> 1000`` (single underscores between digits), and for integers
  ``'0x1F' -> 31`` and ``'0b11' -> 3``, unsigned and without blanks.
* ``%m%d%Y``: the year takes one to four digits (``'010526' -> 0026-01-05``),
  month and day exactly two.  ``MMddyyyy`` would reject that, so the parts are
  cut out by position and re-joined as ``yyyy-MM-dd`` for the date cast.
* ``%m/%d/%Y``: month and day take one or two digits.

``trim`` removes spaces only (a leading tab survives) in both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MDY_COMPACT = r"^[0-9]{5,8}$"  # MMdd + 1..4 year digits
MDY_SLASHED = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{1,4}$"
FRACTION_TAIL = r"^(\s*[+-]?[0-9]*\.[0-9])[0-9]+(\s*)$"
DIGIT_GROUPS = "(?<=[0-9A-Fa-f])_(?=[0-9A-Fa-f])"


def blank_to_null(c: Column) -> Column:
    """``NULLIF(x, '')``."""
    return F.nullif(c, F.lit(""))


def trimmed(c: Column) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return blank_to_null(F.trim(c))


def _ungrouped(c: Column) -> Column:
    """Digit-group underscores removed; anything else is left for the cast to judge."""
    return F.when(c.contains("_"), F.regexp_replace(c, DIGIT_GROUPS, "")).otherwise(c)


def _bound(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` evaluated once, outside the generated code.

    For texts that are rare: an expression that names its text often is generated once for each
    time, and a method beyond what the JVM compiles slows down the plain texts beside it.
    """
    return F.get(F.transform(F.array(c), body), 0)


def _holds_none(c: Column, letters: str) -> Column:
    return reduce(Column.__and__, [~c.contains(x) for x in letters])


def to_int(c: Column, type_name: str = "bigint") -> Column:
    """TRY_CAST of text to an integer type, rounding fractions half away from zero.

    Plain digits, nearly all values, end at the first cast; the rest is only tried behind it.  A text with one of
    ``._xX`` is none, which the cast would find out by an exception with its stack trace.
    """
    rare = F.when(c.isNotNull(), _bound(c, lambda t: _rare_int(t, type_name)))
    return F.coalesce(F.when(_holds_none(c, "._xX"), c.try_cast(type_name)), rare)


def _rare_int(c: Column, type_name: str) -> Column:
    """Fractions, exponents, digit groups, hexadecimal and binary texts."""
    return _bound(_ungrouped(c), lambda t: _rare_ungrouped(t, type_name))


def _rare_ungrouped(t: Column, type_name: str) -> Column:
    plain = F.when(t.contains("."), F.regexp_replace(t, FRACTION_TAIL, "$1$2")).otherwise(t)
    number = F.round(plain.try_cast("decimal(38,18)"), 0)
    coded = (F.when(t.rlike("^0[xX]0*[0-9A-Fa-f]{1,16}$"), F.conv(F.substring(t, 3, 1000), 16, 10))
             .when(t.rlike("^0[bB]0*[01]{1,64}$"), F.conv(F.substring(t, 3, 1000), 2, 10)))
    return F.when(t.rlike("^0[xXbB]"), coded.try_cast("decimal(38,0)")).otherwise(number).try_cast(type_name)


def to_decimal(c: Column, precision: int = 14, scale: int = 2) -> Column:
    """TRY_CAST to DECIMAL(p,s): half-up rounding, overflow -> NULL.

    No number holds a comma or an x; the cast would find out by an exception with its stack trace.
    """
    kind = f"decimal({precision},{scale})"
    grouped = _bound(c, lambda t: F.regexp_replace(t, DIGIT_GROUPS, "").try_cast(kind))
    return F.when(_holds_none(c, ",xX"), F.when(c.contains("_"), grouped).otherwise(c.try_cast(kind)))


def to_money(c: Column) -> Column:
    return to_decimal(trimmed(c), 14, 2)


def to_percent(c: Column) -> Column:
    return to_decimal(trimmed(c), 7, 4)


def postal5(c: Column) -> Column:
    """``NULLIF(SUBSTR(TRIM(x), 1, 5), '')``."""
    return blank_to_null(F.substring(F.trim(c), 1, 5))


def year4(c: Column) -> Column:
    """Four-character guard, then SMALLINT (``'20.6' -> 21``, ``'26' -> NULL``)."""
    t = F.trim(c)
    return to_int(F.when(F.length(t) == 4, t), "smallint")


def _ymd_date(y: Column, m: Column, d: Column) -> Column:
    """Zero-padded ISO text -> DATE via the cast parser (invalid calendar dates -> NULL)."""
    iso = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return iso.try_cast("date")


def date_mdy(c: Column) -> Column:
    """``TRY_STRPTIME(NULLIF(TRIM(x), ''), '%m%d%Y')::DATE``.

    One digit-shape check, then fixed substrings (month 2, day 2, year 1..4
    digits) re-joined as ISO text for the cast parser -- no per-part regex and
    no pattern formatter on the hot path.  Month and day are whole here, so only
    the year is padded; a month 13 ends before the cast.
    """
    t = F.trim(c)
    m, d = F.substring(t, 1, 2), F.substring(t, 3, 2)
    iso = F.concat(F.lpad(F.substring(t, 5, 4), 4, "0"), F.lit("-"), m, F.lit("-"), d)
    return F.when(t.rlike(MDY_COMPACT) & m.between("01", "12") & d.between("01", "31"), iso.try_cast("date"))


def date_mdy_slashed(c: Column) -> Column:
    """``TRY_STRPTIME(NULLIF(TRIM(x), ''), '%m/%d/%Y')::DATE`` (month/day 1..2 digits)."""
    t = trimmed(c)
    parts = F.split(t, "/", 3)
    return F.when(t.rlike(MDY_SLASHED), _ymd_date(F.get(parts, 2), F.get(parts, 0), F.get(parts, 1)))


def date_two_format(c: Column) -> Column:
    """``COALESCE(%m/%d/%Y, %m%d%Y)``."""
    return F.coalesce(date_mdy_slashed(c), date_mdy(c))


def clean(kind: str, c: Column) -> Column:
    """Apply the cleaning rule of a layout kind to a raw text field."""
    if kind == "s":
        return blank_to_null(c)
    if kind == "z":
        return postal5(c)
    if kind == "y":
        return year4(c)
    if kind == "h":
        return to_int(trimmed(c), "smallint")
    if kind == "b":
        return to_int(trimmed(c), "bigint")
    if kind == "m":
        return to_money(c)
    if kind == "p":
        return to_percent(c)
    if kind == "d":
        return date_mdy(c)
    if kind == "D":
        return date_two_format(c)
    raise ValueError(f"unknown layout kind {kind!r}")

