"""Mail messages and their attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faturaflow import schemas
from faturaflow.functions import text


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MESSAGE).json(path)


def _decoded(encoded: Column) -> Column:
    return F.try_to_binary(text.nonempty(encoded), F.lit("base64"))


def attachments(raw: Column) -> Column:
    """Decoded attachments with defaults; one that cannot be decoded is left out alone."""

    def project(a: Column, i: Column) -> Column:
        return F.struct(
            i.cast("int").alias("att_pos"),
            F.coalesce(a["name"], F.lit("Unknown")).alias("name"),
            F.coalesce(a["contentType"], F.lit("Unknown")).alias("content_type"),
            _decoded(a["contentBytes"]).alias("content"),
            F.coalesce(a["size"], F.lit(0)).cast("bigint").alias("size"),
            (F.length(F.coalesce(a["contentBytes"], F.lit(""))) > 0).alias("had_content"),
        )

    kept = F.filter(
        F.transform(F.coalesce(raw, F.array().cast(schemas.MESSAGE["attachments"].dataType)), project),
        lambda a: ~a["had_content"] | a["content"].isNotNull(),
    )
    return F.transform(kept, lambda a: a.dropFields("had_content"))


def has_attachments(raw: Column) -> Column:
    """Whether any attachment is left by attachments(), told without decoding one."""
    left = F.exists(raw, lambda a: F.coalesce(text.is_base64(text.nonempty(a["contentBytes"])), F.lit(True)))
    return F.coalesce(left, F.lit(False))


def parse(messages: DataFrame) -> DataFrame:
    """Flat message columns. `readable` is false where id, sender, subject or body is missing;
    such a message counts as not found.

    `message_id` is never NULL: joins on it then derive no null filter, which would
    parse a JSON message twice.
    """
    m = messages.select(
        F.coalesce(text.message_id(F.col("id")), F.lit("")).alias("message_id"),
        F.col("id").isNotNull().alias("_has_id"),
        F.coalesce("internetMessageId", F.lit("")).alias("internet_message_id"),
        F.col("sender.emailAddress").alias("_sender"),
        F.col("subject"),
        F.col("body.content").alias("body"),
        F.coalesce("receivedDateTime", F.lit("")).alias("received_at"),
        F.coalesce("isDraft", F.lit(False)).alias("is_draft"),
        attachments(F.col("attachments")).alias("attachments"),
        has_attachments(F.col("attachments")).alias("has_attachments"),
    )
    return m.select(
        "message_id",
        "internet_message_id",
        F.col("_sender.name").alias("sender_name"),
        F.col("_sender.address").alias("sender_address"),
        "subject",
        "body",
        "received_at",
        "is_draft",
        "attachments",
        "has_attachments",
        (
            F.col("_has_id")
            & F.col("_sender").isNotNull()
            & F.col("subject").isNotNull()
            & F.col("body").isNotNull()
        ).alias("readable"),
    )


def subscribed(messages: DataFrame, today: Column) -> DataFrame:
    """Messages the mailbox subscription asks for: from `today` on, with attachments, sent."""
    return messages.filter(
        (F.col("received_at") >= F.date_format(today, "yyyy-MM-dd"))
        & F.col("has_attachments")
        & ~F.col("is_draft")
    )


def one_per_id(messages: DataFrame) -> DataFrame:
    """One row per message id when the export holds a message more than once."""
    rest = [c for c in messages.columns if c != "message_id"]
    return (
        messages.groupBy("message_id").agg(F.min(F.struct(*rest)).alias("m")).select("message_id", "m.*")
    )


def exploded_attachments(parsed: DataFrame) -> DataFrame:
    return parsed.select("message_id", F.inline("attachments"))


def is_pdf(content_type: Column, content: Column | None = None) -> Column:
    cond = content_type == "application/pdf"
    return cond if content is None else cond & (F.length(content) > 0)


def fetched_attachments(wanted: DataFrame, store: DataFrame) -> DataFrame:
    """Second route: attachments named by id, taken from an attachment export.

    `wanted` has message_id and attachments (with id); `store` has id, name, contentType
    and contentBytes. Attachments without an id, an export row or content are skipped.
    """
    ids = wanted.select("message_id", F.explode("attachments.id").alias("id")).filter("id is not null")
    found = ids.join(store.filter(F.length("contentBytes") > 0), "id")
    return found.select(
        "message_id",
        F.coalesce("name", F.lit("arquivo_desconhecido")).alias("filename"),
        F.try_to_binary("contentBytes", F.lit("base64")).alias("content"),
        F.coalesce("contentType", F.lit("application/octet-stream")).alias("content_type"),
    ).filter(F.col("content").isNotNull())
