"""Column expressions that coerce raw strings without dropping rows.

Every function returns a ``Column`` built from JVM-side built-ins, so the
whole bronze projection stays inside one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONEY, NA_TOKENS

# The characters a Unicode-aware ``strip()`` removes
# (tab..carriage return, the four information separators, space, NEL,
# no-break space, ogham space, en quad..hair space, line and paragraph
# separators, narrow no-break space, medium math space, ideographic space).
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Accepted date text: ISO date, optionally with an ISO time of day and zone.
ISO_DATETIME_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
ZONE_PATTERN = r"(Z|[+-]\d{2}:?\d{2})$"

# Accepted number text; Spark's own casts also take suffixes such as "5d".
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
NUMBER_PARTS = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"


def na_to_null(c: Column) -> Column:
    """Missing-value tokens become null; recognised before any trimming."""
    return F.when(~c.isin(*NA_TOKENS), c)


def _plain_ends(c: Column) -> Column:
    """Whether the first and last characters are printable ASCII: nothing to strip."""
    return F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)


def unicode_trim(c: Column) -> Column:
    """Strip Unicode whitespace at both ends (``btrim`` with a fixed set:
    a character scan, no regular expression; most texts need none)."""
    return F.when(_plain_ends(c), c).otherwise(F.btrim(c, F.lit(UNICODE_WHITESPACE)))


def trim_to_null(c: Column) -> Column:
    """Strip Unicode whitespace at both ends; empty becomes null."""
    return F.when(_plain_ends(c), c).otherwise(F.nullif(F.btrim(c, F.lit(UNICODE_WHITESPACE)), F.lit("")))


def to_number(c: Column) -> Column:
    """String -> double; anything but a plain decimal number -> null."""
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def to_whole_number(c: Column) -> Column:
    """String -> bigint; text, fractions, infinities and overflow -> null.

    Plain integers go straight through ``try_cast``. Of other number text
    ("2.0", "1e3", "1200e-2") the digits themselves decide, at any length:
    the number is whole if all digits after the point, once the exponent has
    moved it, are zeros.
    """
    as_long = c.try_cast("bigint")

    def part(i: int) -> Column:
        return F.regexp_extract(c, NUMBER_PARTS, i)

    sign, fraction, exponent = part(1), part(3), part(4)
    digits = F.concat(part(2), fraction)
    moved = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))
    after = F.length(fraction).cast("bigint") - moved  # digits after the point; below 0: zeros to add
    significant = F.rtrim(digits, F.lit("0"))
    zeros = F.length(digits) - F.length(significant)
    kept = F.when(after >= 0, F.substring(digits, F.lit(1), (F.length(digits) - after).cast("int")))
    grown = F.when((after < 0) & (after >= -19), F.concat(digits, F.repeat(F.lit("0"), (-after).cast("int"))))
    whole = (F.when(F.length(significant) == 0, F.lit("0"))
             .when((after >= 0) & (after <= zeros), kept).otherwise(grown))
    return F.coalesce(as_long, F.when(c.rlike(NUMBER_PATTERN), F.concat(sign, whole).try_cast("bigint")))


def to_money(c: Column) -> Column:
    """String -> decimal(12,2); more decimals round half-up, bad -> null."""
    return c.try_cast(MONEY)


def to_iso_timestamp(c: Column) -> Column:
    """ISO date or ISO date-time text -> timestamp_ntz; anything else null.

    The pattern guard rejects what a permissive parser would accept
    ("2025", "2025-1-1", "Jan 1 2025"); ``try_cast`` rejects impossible
    calendar dates such as 2025-02-30. A zone ("Z", "+02:00") is accepted
    and dropped: the time stays as the writer's clock showed it. A bare
    date is told by its dashes and last digit, without the pattern: the cast
    takes only digits between them.
    """
    dashes = (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    bare = (F.length(c) == 10) & dashes & F.ascii(F.substring(c, 10, 1)).between(48, 57)
    return F.when(bare, c.try_cast("timestamp_ntz")).otherwise(_patterned_timestamp(c))


def _patterned_timestamp(c: Column) -> Column:
    text = unicode_trim(c)
    plain = F.when(text.contains(":"), F.regexp_replace(text, ZONE_PATTERN, "")).otherwise(text)
    return F.when(text.rlike(ISO_DATETIME_PATTERN), plain.try_cast("timestamp_ntz"))
