"""The invoice QR payload: `A:..*B:..*H:..*I3:..*I4:..*`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faturaflow.config import MIN_QR_STARS
from faturaflow.functions.text import count_char


def is_payload(text: Column) -> Column:
    """At least so many '*': what goes before the last one needed is shorter than the text. The search ends there."""
    return text.isNotNull() & (F.octet_length(F.substring_index(text, "*", MIN_QR_STARS)) < F.octet_length(text))


def pairs(payload: Column) -> Column:
    """The parts `key:value` that hold exactly one ':'."""
    return F.filter(F.split(payload, r"\*"), lambda p: count_char(p, ":") == 1)


def value(pair_array: Column, key: str) -> Column:
    """Value of one key, NULL where there is none; the last of equal keys wins."""
    of_key = F.filter(pair_array, lambda p: F.startswith(p, F.lit(f"{key}:")))
    return F.substring_index(F.try_element_at(of_key, F.lit(-1)), ":", -1)


def joined(pair_array: Column) -> Column:
    """The pairs as one text, with a '*' before and after each."""
    return F.concat(F.lit("*"), F.array_join(pair_array, "*"), F.lit("*"))


#: A payload whose parts all are pairs and end with a '*'.
_ALL_PAIRS = r"\A(?:[^:*]*+:[^:*]*+\*)++\z"


def joined_pairs(payload: Column) -> Column:
    """joined() of the payload's pairs. A payload of nothing else is that text already, without its first '*';
    only others are split, which takes a call per part."""
    whole = F.when(payload.rlike(_ALL_PAIRS), F.concat(F.lit("*"), payload))
    return whole.otherwise(joined(pairs(payload)))


def joined_value(joined_pairs: Column, key: str) -> Column:
    """As value(), from the text of joined(): searched in generated code, without a call per pair and key.

    A pair has no '*' and no second ':', so its value ends at the next '*'.
    """
    lead = f"*{key}:"
    found = F.substring_index(F.substring_index(joined_pairs, lead, -1), "*", 1)
    return F.when(F.contains(joined_pairs, F.lit(lead)), found)


def fields(payload: Column) -> Column:
    """map<key, value> of the whole payload, unknown keys included; the last of equal keys wins.

    Equal keys are removed here, so the result does not hang on the session's
    map-key policy.
    """
    entries = F.transform(
        pairs(payload),
        lambda p: F.struct(
            F.substring_index(p, ":", 1).alias("key"),
            F.substring_index(p, ":", -1).alias("value"),
        ),
    )

    def last_only(all_entries: Column) -> Column:
        def is_last(e: Column, i: Column) -> Column:
            later = F.slice(all_entries, i + 2, F.size(all_entries))
            return ~F.exists(later, lambda x: x["key"] == e["key"])

        return F.filter(all_entries, is_last)

    keys = F.transform(entries, lambda e: e["key"])
    no_repeats = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.map_from_entries(F.when(no_repeats, entries).otherwise(last_only(entries)))
