"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All whitespace, not only the blank that trim() removes.
_WS = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def count_char(c: Column, char: str) -> Column:
    """How often a character of one byte occurs: told by bytes, which need no pass over the text to be counted."""
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(char), F.lit("")))


def last_segment(path: Column) -> Column:
    """Text after the last '/'; '' for a missing path."""
    return F.substring_index(F.coalesce(path, F.lit("")), "/", -1)


def message_id(raw: Column) -> Column:
    return F.substring_index(raw, "Messages/", -1)


def received_date(received_at: Column) -> Column:
    return F.substring_index(received_at, "T", 1)


def display_name(name: Column, address: Column) -> Column:
    return F.coalesce(name, address, F.lit("Unknown Sender"))


def nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def zero_fill(n: Column, width: int) -> Column:
    """Zero-padded digits; longer numbers keep all their digits, a sign stays first."""
    digits = F.abs(n).cast("string")
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(""))
    room = F.greatest(F.length(digits), F.lit(width) - F.length(sign))
    return F.concat(sign, F.lpad(digits, room, F.lit("0")))


# White space that base64 decoding skips, and the letters of its alphabet.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)
_BASE64 = r"\A[A-Za-z0-9+/\p{javaWhitespace}]*={0,2}\z"
_PLAIN_BASE64 = r"\A[A-Za-z0-9+/]*+={0,2}\z"


def is_base64(encoded: Column) -> Column:
    """Whether a text can be decoded, without decoding it: letters of the alphabet, at most two
    signs of padding at the end, and a length that they fit. NULL for NULL.

    Texts without white space, as encoders write them, are told by one pass; the others need their blanks counted.
    """

    def fits(text: Column, size: Column) -> Column:
        return F.when(text.endswith("="), size % 4 == 0).otherwise(size % 4 != 1)

    bare = F.translate(encoded, _BLANKS, "")
    spaced = encoded.rlike(_BASE64) & fits(bare, F.length(bare))
    return F.when(encoded.rlike(_PLAIN_BASE64), fits(encoded, F.octet_length(encoded))).otherwise(spaced)
