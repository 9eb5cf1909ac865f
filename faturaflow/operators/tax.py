"""Tax bands of an invoice: field pairs to band records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faturaflow.config import BANDS, SITUATION, JobConfig
from faturaflow.functions import numbers
from faturaflow.operators.qr import BAND_FIELDS
from faturaflow.operators.status import first_failure


def with_bands(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """Adds `bands`, an array of at most four records in posting order, and the tax gates.

    A band stays if its base is a positive number and its VAT, where given, is a
    number; an invoice that fails a gate has no bands. Bands stay nested in the
    invoice row: unpivoting, grouping and line numbering then need no shuffle.
    `df` has the columns of operators.qr.with_invoice_columns.
    """
    numbers_of = {f"_{c}": numbers.text_to_float(F.col(c)) for c in BAND_FIELDS}
    amounts = F.array(*(_amounts(order, base, vat) for order, (base, vat) in enumerate(BANDS)))
    # Bands that are not given go first: neither a gate nor a record asks for them.
    parsed = df.withColumns(numbers_of).withColumn("_amounts", F.filter(amounts, lambda a: a["given"]))
    kept = F.filter("_amounts", lambda a: numbers.is_positive(a["base"]) & a["vat"].isNotNull())
    priced = parsed.withColumn("_kept", kept)
    is_missing = F.col("vendor_invoice_no").isNull() & (F.size("_kept") > 0)
    gated = first_failure(
        priced,
        ("NO_TAX_COLUMNS", F.size("_amounts") == 0),
        ("MISSING_FIELD", is_missing | F.exists("_amounts", lambda a: a["breaks"])),
        ("NO_TAX_VALUES", F.size("_kept") == 0),
    )
    rated = F.transform(
        F.when(F.col("status").isNull(), F.col("_kept")).otherwise(F.slice("_kept", 1, 0)),
        lambda a: F.struct(
            a["band_order"].alias("band_order"),
            a["band"].alias("band"),
            a["base"].cast(cfg.money).alias("base"),
            a["vat"].cast(cfg.money).alias("vat"),
            numbers.round_half_even_2(numbers.vat_percent(a["vat"], a["base"])).alias("percent"),
        ),
    )
    bands = F.transform(
        rated,
        lambda b: F.struct(
            b["band_order"].alias("band_order"),
            b["band"].alias("band"),
            (b["base"] + b["vat"]).cast(cfg.money).alias("total"),
            b["vat"].alias("vat"),
            b["base"].alias("base"),
            b["percent"].alias("vat_percent"),
            numbers.posting_group(b["percent"]).alias("posting_group"),
        ),
    )
    return gated.withColumn("bands", bands).drop("_amounts", "_kept", *BAND_FIELDS, *numbers_of)


def _amounts(order: int, base: str, vat: str | None) -> Column:
    """One band as given. `breaks`: a base that is no number in a band without its VAT field."""
    given = F.col(base.lower()).isNotNull()
    base_n = F.col(f"_{base.lower()}")
    if vat:
        no_vat = F.col(vat.lower()).isNull()
        vat_n = F.when(no_vat, F.lit(0.0)).otherwise(F.col(f"_{vat.lower()}"))
        breaks = given & base_n.isNull() & no_vat
    else:
        vat_n, breaks = F.lit(0.0), F.lit(False)
    return F.struct(
        F.lit(order).alias("band_order"),
        F.lit(base).alias("band"),
        given.alias("given"),
        base_n.alias("base"),
        vat_n.alias("vat"),
        breaks.alias("breaks"),
    )


def band_records(df: DataFrame) -> DataFrame:
    """One row per band, with the band record's fixed columns.

    The outer form keeps Catalyst from deriving a filter on the array, which would
    compute the bands twice.
    """
    records = df.select(
        "message_id",
        "vendor_name",
        "vendor_invoice_no",
        F.coalesce("doc_type", F.lit("")).alias("doc_type"),
        F.coalesce("issue_date", F.lit("")).alias("issue_date"),
        F.lit(SITUATION).alias("situation"),
        F.coalesce("region", F.lit("")).alias("issuer_region"),
        F.lit("").alias("buyer_region"),
        "account",
        F.inline_outer("bands"),
    )
    return records.filter(F.col("band").isNotNull())
