"""Headers and lines from a plain table of band records, for callers that bring their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.config import DOCUMENT_TYPE, LINE_STEP, LINE_TYPE, JobConfig
from faturaflow.functions import numbers
from faturaflow.operators import numbering, payloads, transform, vendors
from faturaflow.operators.joins import lookup_join
from faturaflow.sources.stage import Stage


def transform_records(
    records: DataFrame,
    vendor_master: DataFrame,
    purchase_header: DataFrame,
    purchase_header_reg: DataFrame,
    cfg: JobConfig,
    stage: Stage,
) -> tuple[DataFrame, DataFrame]:
    """(headers, lines) of the records' new invoices.

    `records` are rows as operators.tax.band_records gives them. Records are joined to
    vendors by name, so vendors that share a name multiply lines; an invoice is new if
    the ERP does not hold its number; its records share one document. Invoices without
    a date or without any posting group are left out, and of several messages with one
    number the first stays. A document may have any number of lines.
    """
    keys = ["vendor_invoice_no"]
    known = transform.known_keys(keys, purchase_header, purchase_header_reg)
    as_lines = records.select(
        "message_id",
        "vendor_name",
        *keys,
        "band_order",
        "account",
        numbers.strict_date(F.col("issue_date")).alias("document_date"),
        F.col("base").alias("direct_unit_cost"),
        F.col("vat").alias("total_vat_amount"),
        F.col("posting_group").alias("vat_prod_posting_group"),
    )
    named = vendors.join_by_name(as_lines, vendor_master)
    written = stage.table("records", transform.not_known(named, known, keys, "message_id"))
    documents = (
        written.groupBy("message_id", *keys)
        .agg(
            F.min("vendor_no").alias("buy_from_no"),
            F.min("document_date").alias("document_date"),
            F.count("vat_prod_posting_group").alias("n_groups"),
        )
        .filter("n_groups > 0 AND document_date IS NOT NULL")
    )
    first = (
        documents.groupBy(*keys)
        .agg(F.min(F.struct("message_id", "buy_from_no", "document_date")).alias("d"))
        .select(*keys, "d.*")
    )
    ranked = numbering.ranked(
        first.withColumn("first_no", numbering.next_number(purchase_header, cfg.number_prefix).scalar()),
        [F.col("message_id")],
        stage,
        "documents",
    )
    numbered = ranked.withColumn(
        "document_no",
        numbering.document_no(F.col("rank") + F.col("first_no"), cfg.number_prefix, cfg.number_width),
    )
    of_document = numbered.select("message_id", *keys, "document_no")
    lines = numbering.ranked_within(
        lookup_join(written, of_document, ["message_id", *keys], "inner"),
        "document_no",
        [F.col("band_order"), F.col("vendor_no")],
        stage,
        "lines",
    )
    return transform.header_records(numbered), lines.select(
        "document_no",
        F.lit(DOCUMENT_TYPE).alias("document_type"),
        ((F.col("rank") + 1) * LINE_STEP).alias("line_no"),
        F.lit(1).alias("quantity"),
        "account",
        "direct_unit_cost",
        "total_vat_amount",
        "vat_prod_posting_group",
        transform.withholding(F.col("document_no")).alias("withholding_tax_code"),
        F.lit(LINE_TYPE).alias("type"),
        F.lit(LINE_TYPE).alias("filtered_type_field"),
        F.col("account").alias("no"),
    )


def process_records(
    headers: DataFrame, lines: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(header payloads, line payloads, outcomes) of any header and line tables.

    A header without lines is not sent: its outcome is NO_LINES.
    """
    matched, missing = transform.match_lines(headers, lines)
    complete = transform.with_lines(headers, lines)
    outcome = complete.select("document_no", F.lit("SENT").alias("status")).unionByName(
        missing.select("document_no", "status")
    )
    return payloads.header_payloads(complete), payloads.line_payloads(matched), outcome
