"""QR payload choice and parsing, and PDF text assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faturaflow.config import BANDS
from faturaflow.functions import qr
from faturaflow.operators.joins import lookup_join
from faturaflow.sources.messages import is_pdf

# Invoice fields read from the payload: our column -> payload key.
INVOICE_FIELDS = {
    "issuer_nif": "A",
    "payload_buyer": "B",
    "doc_type": "D",
    "issue_date": "F",
    "vendor_invoice_no": "H",
    "region": "I1",
}
BAND_FIELDS = {key.lower(): key for band in BANDS for key in band if key}


def first_accepted(candidates: DataFrame) -> DataFrame:
    """The first text, in the decoder's search order, that is an invoice payload.

    The filters run before the aggregate and the partial aggregate leaves one row
    per message and task, however many attempts a message has.
    """
    ok = candidates.filter(is_pdf(F.col("content_type")) & qr.is_payload(F.col("text")))
    order = F.struct("att_pos", "page_no", "phase", "image_no", "method_no")
    return ok.groupBy("message_id").agg(F.min_by("text", order).alias("payload"))


def with_fields(df: DataFrame) -> DataFrame:
    """Adds `fields`: the whole payload as a map, unknown keys included."""
    return df.withColumn("fields", qr.fields(F.col("payload")))


#: The fields that decide who issued an invoice to whom; the others are read once that is known.
PARTY_FIELDS = ("issuer_nif", "payload_buyer")


def with_parties(df: DataFrame) -> DataFrame:
    """The payload replaced by the issuer, the buyer and `pairs_text`, one column for all other fields.

    What is shuffled next is one text and not a column for each field. The payload is split once,
    into a column of its own; Catalyst does not repeat an expression that several columns use.
    """
    split = df.withColumn("pairs_text", qr.joined_pairs(F.col("payload"))).drop("payload")
    return split.withColumns({c: _field(INVOICE_FIELDS[c]) for c in PARTY_FIELDS})


def with_other_fields(df: DataFrame, banded: Column | None = None) -> DataFrame:
    """After with_parties: `pairs_text` replaced by one text column per field the job reads.

    `banded`: where the band fields are read; elsewhere they are NULL. A message that has failed a gate has no bands.
    """
    others = {c: _field(k) for c, k in INVOICE_FIELDS.items() if c not in PARTY_FIELDS}
    pairs = F.col("pairs_text") if banded is None else F.when(banded, F.col("pairs_text"))
    bands = {c: qr.joined_value(F.col("_band_pairs"), k) for c, k in BAND_FIELDS.items()}
    read = df.withColumns({**others, "_band_pairs": pairs}).withColumns(bands)
    return read.drop("pairs_text", "_band_pairs")


def with_invoice_columns(df: DataFrame) -> DataFrame:
    """The payload replaced by one text column per field the job reads."""
    kept = [c for c in df.columns if c != "payload"]
    return with_other_fields(with_parties(df)).select(*kept, *INVOICE_FIELDS, *BAND_FIELDS)


def _field(key: str) -> Column:
    return qr.joined_value(F.col("pairs_text"), key)


def text_blocks(pages: DataFrame, block: int) -> DataFrame:
    """Page texts joined in blocks of `block` page numbers.

    No group grows with the document, so a huge document is spread over tasks;
    its blocks in order are its whole text.
    """
    return (
        pages.filter(F.col("text").isNotNull())
        .groupBy(
            "message_id",
            "att_pos",
            F.floor(F.col("page_no") / block).cast("bigint").alias("block_no"),
        )
        .agg(
            F.min("filename").alias("filename"),
            F.expr("listagg(text, '') within group (order by page_no)").alias("text"),
            F.count(F.lit(1)).alias("pages"),
        )
    )


def pdf_texts(pages: DataFrame, block: int) -> DataFrame:
    """One text per attachment from its blocks; attachments without any text are left out.

    The result is one value per attachment, so its size bounds what a task gathers;
    use text_blocks where a document may be larger than a value should be.
    """
    whole = (
        text_blocks(pages, block)
        .groupBy("message_id", "att_pos")
        .agg(
            F.min("filename").alias("filename"),
            F.expr("listagg(text, '') within group (order by block_no)").alias("text"),
            F.sum("pages").cast("string").alias("pages"),
        )
    )
    return whole.filter(F.length("text") > 0)


def pdf_texts_or_default(ids: DataFrame, pages: DataFrame, block: int) -> DataFrame:
    """As pdf_texts, with one placeholder row for a message that has none."""
    texts = ids.join(pdf_texts(pages, block), "message_id", "left")
    return texts.select(
        "message_id",
        F.coalesce("att_pos", F.lit(0)).alias("att_pos"),
        F.coalesce("filename", F.lit("No text")).alias("filename"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("pages", F.lit("0")).alias("pages"),
    )


def responses(mail: DataFrame, payloads: DataFrame, texts: DataFrame) -> DataFrame:
    """Message, payload and texts in one row per text: what reading a message returns."""
    return lookup_join(texts, mail.join(payloads, "message_id"), ["message_id"], "inner")
