"""Known-invoice screening and the header and line records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faturaflow.config import (
    DOCUMENT_TYPE,
    LINE_STEP,
    LINE_TYPE,
    WITHHOLDING_CODE,
    WITHHOLDING_PREFIX,
    JobConfig,
)
from faturaflow.functions import numbers
from faturaflow.operators.joins import lookup_join
from faturaflow.operators.status import SENT, first_failure


def known_keys(keys: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Invoice keys held by any of the tables; NULL keys match nothing and are left out."""
    out = tables[0].select(*keys)
    for t in tables[1:]:
        out = out.unionByName(t.select(*keys))
    return out.dropna(subset=list(keys))


def not_known(records: DataFrame, known: DataFrame, keys: Sequence[str], spread_by: str) -> DataFrame:
    """Anti-join: records whose key no table holds. One join for all tables together."""
    return lookup_join(records, known.distinct(), keys, "left_anti", spread_by)


def with_document_date(df: DataFrame) -> DataFrame:
    return df.withColumn("document_date", numbers.strict_date(F.col("issue_date")))


def has_date_text() -> Column:
    return F.coalesce(F.col("issue_date"), F.lit("")) != ""


def has_group() -> Column:
    return F.exists("bands", lambda b: b["posting_group"].isNotNull())


def decisions(df: DataFrame, known: DataFrame, cfg: JobConfig) -> DataFrame:
    """(message_id, received_at, status): duplicate, date and posting-group gates; what passes all is SENT.

    As if the messages were handled one after another by (received_at, message_id):
    an invoice is a duplicate if the ERP holds its key or an earlier message of the
    batch with that key is sent. So only invoices that pass every other gate can
    make a later one a duplicate.

    `df` should be a written table: it is read for the batch's keys, for the first
    sendable message per key, and for the result. Only keys, times and flags are shuffled.
    """
    keys = list(cfg.dup_keys)
    slim = df.select(
        "message_id",
        "received_at",
        "status",
        *keys,
        has_date_text().alias("has_date_text"),
        (~has_date_text() | F.col("document_date").isNotNull()).alias("date_ok"),
        has_group().alias("has_group"),
        (F.col("status").isNull() & F.col("document_date").isNotNull() & has_group()).alias("sendable"),
    )
    arrival = F.struct("received_at", "message_id")

    batch = slim.filter(F.col("status").isNull())
    first_sent = batch.filter("sendable").groupBy(*keys).agg(F.min(arrival).alias("first_sent"))
    held = lookup_join(known, batch.select(*keys).distinct(), keys, "left_semi")
    per_key = (
        held.withColumn("is_known", F.lit(True))
        .unionByName(first_sent, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(F.bool_or("is_known").alias("is_known"), F.min("first_sent").alias("first_sent"))
    )
    screened = lookup_join(slim, per_key, keys, "left", "message_id")
    out = first_failure(
        screened,
        ("DUPLICATE", F.coalesce("is_known", F.lit(False)) | (F.col("first_sent") < arrival)),
        ("BAD_DATE", ~F.col("date_ok")),
        ("NO_VALID_GROUP", ~F.col("has_group")),
        ("NO_DATE", ~F.col("has_date_text")),
        (SENT, F.lit(True)),
    )
    return out.select("message_id", "received_at", "status")


def decided(df: DataFrame, results: DataFrame) -> DataFrame:
    """`df` with the columns of `results` in place of its own; both have a row per message id."""
    own = [c for c in df.columns if c == "message_id" or c not in results.columns]
    return df.select(*own).join(results, "message_id")


def screen(df: DataFrame, known: DataFrame, cfg: JobConfig) -> DataFrame:
    """`df` with its final status."""
    return decided(df, decisions(df, known, cfg))


def header_records(numbered: DataFrame) -> DataFrame:
    """One header per numbered document."""
    return numbered.filter(F.col("document_no").isNotNull()).select(
        F.col("document_no"),
        F.lit(DOCUMENT_TYPE).alias("document_type"),
        F.col("buy_from_no").alias("buy_from_vendor_no"),
        "document_date",
        "vendor_invoice_no",
    )


def line_records(numbered: DataFrame) -> DataFrame:
    """One line per band; the band's place in the array gives the line number."""
    exploded = numbered.filter(F.col("document_no").isNotNull()).select(
        "document_no", "account", F.posexplode("bands").alias("pos", "band")
    )
    return exploded.select(
        "document_no",
        F.lit(DOCUMENT_TYPE).alias("document_type"),
        ((F.col("pos") + 1) * LINE_STEP).alias("line_no"),
        F.lit(1).alias("quantity"),
        "account",
        F.col("band.base").alias("direct_unit_cost"),
        F.col("band.vat").alias("total_vat_amount"),
        F.col("band.vat_percent").alias("vat_percent"),
        F.col("band.posting_group").alias("vat_prod_posting_group"),
        withholding(F.col("document_no")).alias("withholding_tax_code"),
        F.lit(LINE_TYPE).alias("type"),
        F.lit(LINE_TYPE).alias("filtered_type_field"),
        F.col("account").alias("no"),
        F.col("band.band_order").alias("band_order"),
    )


def withholding(document_no: Column) -> Column:
    return F.when(document_no.startswith(WITHHOLDING_PREFIX), F.lit(WITHHOLDING_CODE)).otherwise(F.lit(""))


def valid_documents(records: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows of documents that have at least one line with a posting group."""
    valid = lines.filter(F.col("vat_prod_posting_group").isNotNull()).select("document_no").distinct()
    return lookup_join(records, valid, ["document_no"], "left_semi")


def match_lines(headers: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines that have a header, headers without any line). For tables from elsewhere."""
    matched = lookup_join(lines, headers.select("document_no").distinct(), ["document_no"], "left_semi")
    missing = lookup_join(headers, _documents(lines), ["document_no"], "left_anti")
    return matched, missing.withColumn("status", F.lit("NO_LINES"))


def with_lines(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers that have at least one line."""
    return lookup_join(headers, _documents(lines), ["document_no"], "left_semi")


def _documents(lines: DataFrame) -> DataFrame:
    return lines.select("document_no").distinct()
