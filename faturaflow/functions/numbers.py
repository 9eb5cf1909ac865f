"""Number and date expressions that never fail on bad text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faturaflow.config import POSTING_GROUPS

_BLANK = r"[\s\p{Z}\x1c-\x1f\x85]*"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_DECIMAL = rf"(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_SPECIAL = "(?i:nan|inf|infinity)"
_FLOAT = rf"^{_BLANK}[+-]?(?:{_DECIMAL}|{_SPECIAL}){_BLANK}\z"
# Digits as nearly all payloads hold them: nothing to drop, and no type suffix that a cast would take.
_PLAIN = r"\A[0-9]++(?:\.[0-9]++)?+\z"
# Characters the pattern allows and a cast does not: '_' and blanks beyond ASCII.
_DROPPED = "_\u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def text_to_float(c: Column) -> Column:
    """Decimal text, with blanks around it, '_' between digits, nan and inf allowed.

    Anything else is NULL, also the type suffixes of '1.0d' and '1.0f' that a
    bare cast would take. There is one cast, as its generated code is long and Java
    compiles no method of more than 8,000 bytes.
    """
    plain = F.when(c.rlike(_PLAIN), c)
    return plain.when(c.rlike(_FLOAT), F.translate(c, _DROPPED, "")).try_cast("double")


def is_positive(c: Column) -> Column:
    """NaN is not positive, although Spark orders it above every number."""
    return (c > 0) & ~F.isnan(c)


def vat_percent(vat: Column, base: Column) -> Column:
    return F.try_divide(vat, base) * 100


def round_half_even_2(c: Column) -> Column:
    return F.rint(c * 100) / 100


def posting_group(p: Column) -> Column:
    """Group of a VAT percentage already rounded to two digits."""
    (name, low, high), *rest = POSTING_GROUPS
    out = F.when(p.between(low, high), F.lit(name))
    for name, low, high in rest:
        out = out.when(p.between(low, high), F.lit(name))
    return out


def strict_date(c: Column) -> Column:
    """Date from exactly eight digits yyyyMMdd, else NULL."""
    return F.when(c.rlike("^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd"))
