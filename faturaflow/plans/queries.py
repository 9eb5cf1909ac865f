"""Registered queries: one per operator group, each over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from faturaflow import fixtures as fx
from faturaflow.functions import text
from faturaflow.operators import accounts, joins, numbering, payloads, qr, rejects, tax, transform, vendors
from faturaflow.plans import invoice_run, record_run
from faturaflow.sinks.directories import Directories
from faturaflow.sinks.outbox import Outbox
from faturaflow.sources import export, messages, notifications, tables
from faturaflow.sources.landing import LandingLog
from faturaflow.sources.stage import Stage, shared_root
from faturaflow.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
CFG = fx.CONFIG

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return qr.with_invoice_columns(fx.qr_messages(spark, sf))


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ---------------------------------------------------------------- intake


@query
def notification_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Parse, explode and reduce each notification to its message id."""
    return fx.events_of(fx.event_bodies(spark, sf)).select("message_id", _iso("ts").alias("ts"))


@query
def notification_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """First arrival of each message id."""
    ids = notifications.distinct_ids(fx.events_of(fx.event_bodies(spark, sf)))
    return ids.select("message_id", _iso("ts").alias("first_ts"))


@query
def message_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The mailbox subscription over one message per event."""
    mail = fx.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("received_at"),
        (F.col("event_type") != "view").alias("has_attachments"),
        (F.col("value") < 1.0).alias("is_draft"),
    )
    today = F.lit("2024-01-08").cast("date")
    return messages.subscribed(mail, today).select("message_id", "received_at")


@query
def message_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Message projection with defaults and required fields; attachments decoded in place."""
    m = fx.parsed_mail(fx.document_mail_json(spark, sf))
    return m.select(
        "message_id",
        "internet_message_id",
        "sender_address",
        text.display_name(F.col("sender_name"), F.col("sender_address")).alias("sender"),
        "subject",
        "body",
        "has_attachments",
        F.size("attachments").cast("bigint").alias("n_attachments"),
        F.when(~F.col("readable"), F.lit("NOT_FOUND")).alias("status"),
    )


@query
def attachment_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Attachments decoded from base64, broken ones left out; whole content as hash and length."""
    a = messages.exploded_attachments(fx.parsed_mail(fx.document_mail_json(spark, sf)))
    return a.select(
        "message_id",
        F.col("att_pos").cast("bigint").alias("att_pos"),
        "name",
        "content_type",
        F.length("content").cast("bigint").alias("n_bytes"),
        F.md5("content").alias("content_md5"),
        "size",
        messages.is_pdf(F.col("content_type"), F.col("content")).alias("is_pdf"),
    )


@query
def attachment_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """Attachments fetched by id from an attachment export; ids without export are skipped."""
    d = F.col("doc_id")
    wanted = fx.table(spark, sf, "labels").select(
        F.concat(F.lit("m"), d.cast("string")).alias("message_id"),
        F.array(F.struct(F.when(F.col("toxic") == 0, d.cast("string")).alias("id"))).alias("attachments"),
    )
    store = fx.table(spark, sf, "documents").select(
        d.cast("string").alias("id"),
        F.when(d % 5 != 0, F.col("source")).alias("name"),
        F.when(d % 3 != 0, F.lit("application/pdf")).alias("contentType"),
        F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "\r\n", "").alias("contentBytes"),
    )
    got = messages.fetched_attachments(wanted, store)
    return got.select(
        "message_id",
        "filename",
        "content_type",
        F.length("content").cast("bigint").alias("n_bytes"),
        F.md5("content").alias("content_md5"),
    )


# ---------------------------------------------------------------- QR and PDF text


@query
def qr_accept_first(spark: SparkSession, sf: str) -> DataFrame:
    """First accepted decoder text per message."""
    return qr.first_accepted(fx.decode_candidates(spark, sf))


@query
def qr_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Payload to its fields, as columns and as a map with every key."""
    parsed = qr.with_invoice_columns(qr.with_fields(fx.qr_messages(spark, sf)))
    return parsed.select(
        "message_id",
        *qr.INVOICE_FIELDS,
        *qr.BAND_FIELDS,
        F.size("fields").cast("bigint").alias("n_fields"),
        F.array_join(F.array_sort(F.map_values("fields")), " ").alias("all_values"),
    )


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("message_id"),
        (F.col("turn") % 2).cast("int").alias("att_pos"),
        F.format_string("conv%d-%d.pdf", F.col("conv_id"), F.col("turn") % 2).alias("filename"),
        F.col("turn").alias("page_no"),
        "text",
    )


@query
def pdf_text_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Whole text per attachment in page order; a placeholder for messages without text."""
    ids = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("message_id"))
    both = ids.unionByName(_pages(spark, sf).select("message_id")).distinct()
    return qr.pdf_texts_or_default(both, _pages(spark, sf), CFG.page_block).select(
        "message_id", "filename", "text", "pages"
    )


@query
def pdf_text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as blocks of two pages."""
    return qr.text_blocks(_pages(spark, sf), 2).select(
        "message_id", F.col("att_pos").cast("bigint").alias("att_pos"), "block_no", "text", "pages"
    )


@query
def response_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Message, payload and text in one row: what reading a mail returns."""
    mail = fx.parsed_mail(fx.mail_json(spark, sf)).filter("readable and has_attachments")
    pages = _pages(spark, sf)
    first = qr.first_accepted(fx.decode_candidates(spark, sf))
    texts = qr.pdf_texts_or_default(mail.select("message_id"), pages, CFG.page_block)
    return qr.responses(mail, first, texts).select(
        "message_id", "subject", "received_at", "payload", "filename", "text", "pages"
    )


# ---------------------------------------------------------------- ERP tables, validation and account


@query
def erp_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The four ERP tables under their own column names, cut to the columns the job reads."""
    nothing = F.lit(None).cast("string")
    reads = [
        fx.vendors(spark, sf).select(F.lit("vendors").alias("erp_table"), "vendor_no", "name", "vat"),
        fx.purchase_header(spark, sf).select(
            F.lit("purchase_header"), "document_no", "vendor_invoice_no", nothing
        ),
        fx.purchase_header_reg(spark, sf).select(
            F.lit("purchase_header_reg"), nothing, "vendor_invoice_no", nothing
        ),
        fx.posted_lines(spark, sf).select(F.lit("posted_lines"), "vendor_no", "account", "description"),
    ]
    out = reads[0]
    for df in reads[1:]:
        out = out.union(df)
    return out.toDF("erp_table", "first", "second", "third")


@query
def buyer_check(spark: SparkSession, sf: str) -> DataFrame:
    """Buyer and issuer gates."""
    return vendors.check_buyer(_parsed(spark, sf), CFG.buyer_nif).select(
        "message_id", "payload_buyer", "issuer_nif", "status"
    )


@query
def vendor_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor by tax number, then number by name."""
    checked = vendors.check_buyer(_parsed(spark, sf), CFG.buyer_nif)
    return vendors.resolve(checked, vendors.directory(fx.vendors(spark, sf))).select(
        "message_id", "issuer_nif", "vendor_name", "vendor_no", "buy_from_no", "status"
    )


@query
def vendor_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Each vendor's account list with repeats as counts, and its totals."""
    per_vendor = accounts.per_vendor(fx.posted_lines(spark, sf))
    return joins.lookup_join(per_vendor, accounts.summary(per_vendor), ["vendor_no"], "inner").select(
        "vendor_no", "account", "n_lines", "n_rows", "n_accounts"
    )


@query
def account_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """None, one or many posted lines; the classifier's answer must be one of the accounts."""
    named = vendors.resolve(
        vendors.check_buyer(_parsed(spark, sf), CFG.buyer_nif),
        vendors.directory(fx.vendors(spark, sf)),
    )
    per_vendor = accounts.per_vendor(fx.posted_lines(spark, sf))
    counted = joins.lookup_join(named, accounts.summary(per_vendor), ["vendor_no"], "left", "message_id")
    answered = counted.join(fx.classifier_answers(spark, sf), "message_id", "left")
    return accounts.resolve(answered, per_vendor, CFG).select(
        "message_id", "vendor_no", "n_rows", "answer", "account", "status"
    )


@query
def classification_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One prompt per invoice whose vendor has more than one posted line."""
    named = vendors.resolve(
        vendors.check_buyer(_parsed(spark, sf), CFG.buyer_nif),
        vendors.directory(fx.vendors(spark, sf)),
    ).filter(F.col("status").isNull())
    lines = fx.posted_lines(spark, sf)
    summary = accounts.summary(accounts.per_vendor(lines))
    counted = joins.lookup_join(named, summary, ["vendor_no"], "inner")
    mail = fx.parsed_mail(fx.mail_json(spark, sf)).select(
        "message_id", "sender_name", "sender_address", "subject", "body"
    )
    asked = counted.join(mail, "message_id").withColumn("attachments_text", F.lit(""))
    return accounts.classification_requests(asked, lines, CFG).select(
        "message_id", "vendor_no", "model", "max_tokens", "prompt"
    )


# ---------------------------------------------------------------- tax bands and records


@query
def tax_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Band records of every invoice payload."""
    nothing = F.lit(None).cast("string")
    parsed = _parsed(spark, sf).withColumns({"vendor_name": nothing, "account": nothing})
    return tax.band_records(tax.with_bands(parsed, CFG)).select(
        "message_id",
        "vendor_invoice_no",
        "doc_type",
        "issue_date",
        "situation",
        "issuer_region",
        "buyer_region",
        "band",
        "base",
        "vat",
        "total",
        "vat_percent",
        "posting_group",
    )


@query
def vendor_name_join(spark: SparkSession, sf: str) -> DataFrame:
    """Invoices to vendors on the upper-cased name; shared names multiply rows."""
    v = fx.vendors(spark, sf)
    named = vendors.resolve(_parsed(spark, sf), vendors.directory(v)).select("message_id", "vendor_name")
    return vendors.join_by_name(named, v).select("message_id", "vendor_name", "vendor_no", "vat")


@query
def new_invoices(spark: SparkSession, sf: str) -> DataFrame:
    """Invoice numbers neither open nor registered in the ERP."""
    keys = ["vendor_invoice_no"]
    known = transform.known_keys(keys, fx.purchase_header(spark, sf), fx.purchase_header_reg(spark, sf))
    records = _parsed(spark, sf).select("message_id", "vendor_invoice_no")
    return transform.not_known(records, known, keys, "message_id").select("message_id", "vendor_invoice_no")


@query
def next_invoice_number(spark: SparkSession, sf: str) -> DataFrame:
    """Next free number after the largest document number."""
    return numbering.next_number(fx.purchase_header(spark, sf), CFG.number_prefix)


@query
def invoice_numbering(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive numbers over all invoices by (issue date, id)."""
    invoices = _parsed(spark, sf).select("message_id", F.coalesce("issue_date", F.lit("")).alias("issue_date"))
    ranked = numbering.ranked(
        invoices, [F.col("issue_date"), F.col("message_id")], Stage(spark), "numbering"
    )
    first = numbering.next_number(fx.purchase_header(spark, sf), CFG.number_prefix)
    number = (F.col("rank") + first.scalar()).alias("number")
    return ranked.select("message_id", number).select(
        "message_id",
        "number",
        numbering.document_no(F.col("number"), CFG.number_prefix, CFG.number_width).alias("document_no"),
    )


def _records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    v = fx.vendors(spark, sf)
    named = vendors.resolve(_parsed(spark, sf), vendors.directory(v)).drop("status")
    banded = tax.with_bands(named.withColumn("account", F.lit("62000")), CFG)
    return record_run.transform_records(
        tax.band_records(banded),
        v,
        fx.purchase_header(spark, sf),
        fx.purchase_header_reg(spark, sf),
        CFG,
        Stage(spark),
    )


@query
def record_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Headers from a plain table of band records."""
    headers_of, _ = _records(spark, sf)
    return headers_of.withColumn("document_date", F.date_format("document_date", "yyyy-MM-dd"))


@query
def record_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines from a plain table of band records; vendors that share a name multiply them."""
    _, lines_of = _records(spark, sf)
    return lines_of.select(
        "document_no", "line_no", "account", "direct_unit_cost", "total_vat_amount", "vat_prod_posting_group"
    )


# ---------------------------------------------------------------- the whole run


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.events_of(fx.mailbox_bodies(spark, sf))
    return invoice_run.run(events, fx.inputs(spark, sf), CFG, Stage(spark))


def _screened(spark: SparkSession, sf: str) -> DataFrame:
    """The run without its numbers, for queries that need only the status."""
    ids = notifications.distinct_ids(fx.events_of(fx.mailbox_bodies(spark, sf))).select("message_id")
    inp = fx.inputs(spark, sf)
    return invoice_run.screen(invoice_run.classify(ids, inp, CFG), inp, CFG, Stage(spark))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return transform.line_records(_numbered(spark, sf))


@query
def headers(spark: SparkSession, sf: str) -> DataFrame:
    """Header record per accepted invoice."""
    return transform.header_records(_numbered(spark, sf)).withColumn(
        "document_date", F.date_format("document_date", "yyyy-MM-dd")
    )


@query
def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line records of the accepted invoices."""
    return _lines(spark, sf).select(
        "document_no",
        "document_type",
        F.col("line_no").cast("bigint").alias("line_no"),
        F.col("quantity").cast("bigint").alias("quantity"),
        "account",
        "direct_unit_cost",
        "total_vat_amount",
        "vat_percent",
        "vat_prod_posting_group",
        "withholding_tax_code",
        "type",
        "filtered_type_field",
    )


def _line_table(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every invoice payload as a plain table, document number = message id."""
    banded = tax.with_bands(_parsed(spark, sf).withColumn("vendor_invoice_no", F.lit("")), CFG)
    flat = banded.select(F.col("message_id").alias("document_no"), F.inline_outer("bands"))
    return flat.filter(F.col("band").isNotNull()).select(
        "document_no",
        "band_order",
        F.col("base").alias("direct_unit_cost"),
        F.col("posting_group").alias("vat_prod_posting_group"),
    )


@query
def valid_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All lines of documents with at least one posting group, on a plain line table."""
    table = _line_table(spark, sf)
    return transform.valid_documents(table, table).select(
        "document_no",
        F.col("band_order").cast("bigint").alias("band_order"),
        "vat_prod_posting_group",
    )


@query
def line_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Line numbers per document on a plain line table, without a task per document."""
    out = numbering.ranked_within(
        _line_table(spark, sf), "document_no", [F.col("band_order")], Stage(spark), "line_numbers"
    )
    return out.select(
        "document_no",
        F.col("band_order").cast("bigint").alias("band_order"),
        ((F.col("rank") + 1) * transform.LINE_STEP).alias("line_no"),
    )


@query
def header_line_match(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as headers against the plain line table: those without lines."""
    hdr = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("document_no"))
    matched, missing = transform.match_lines(hdr, _line_table(spark, sf))
    counted = matched.groupBy("document_no").agg(F.count(F.lit(1)).alias("n_lines"))
    return counted.withColumn("status", F.lit(None).cast("string")).unionByName(
        missing.withColumn("n_lines", F.lit(0).cast("bigint"))
    )


@query
def header_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Header JSON, read back field by field."""
    p = payloads.header_payloads(transform.header_records(_numbered(spark, sf)))
    keys = ["Document_Type", "No", "Buy_from_Vendor_No", "Document_Date", "Vendor_Invoice_No"]
    return p.select(
        "document_no", *(F.get_json_object("payload", f"$.{k}").alias(k.lower()) for k in keys)
    )


@query
def line_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Line JSON, read back field by field: absent entries are NULL."""
    p = payloads.line_payloads(_lines(spark, sf))
    texts = ["Document_Type", "Document_No", "Type", "FilteredTypeField", "No",
             "VAT_Prod_Posting_Group", "Withholding_Tax_Code"]
    numbers = ["Quantity", "Direct_Unit_Cost", "Total_VAT_Amount"]
    return p.select(
        *(F.get_json_object("payload", f"$.{k}").alias(k.lower()) for k in texts),
        F.get_json_object("payload", "$.Line_No").cast("bigint").alias("line_no"),
        *(F.get_json_object("payload", f"$.{k}").cast("double").alias(k.lower()) for k in numbers),
    )


@query
def prefixed_line_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Line JSON of a plain line table: numbers that start with F go without their withholding code."""
    line = fx.table(spark, sf, "lineitem").selectExpr(
        "concat(if(l_returnflag = 'N', 'F', 'P'), l_orderkey) AS document_no",
        "'Invoice' AS document_type",
        "l_linenumber * 10000 AS line_no",
        "1 AS quantity",
        "cast(l_extendedprice AS double) AS direct_unit_cost",
        "cast(l_tax AS double) AS total_vat_amount",
        "'G/L Account' AS type",
        "'G/L Account' AS filtered_type_field",
        "string(l_partkey) AS no",
        "if(l_tax = 0, 'OBS-ISEN', NULL) AS vat_prod_posting_group",
        "if(l_linestatus = 'O', 'IRSINDEP23', '') AS withholding_tax_code",
    )
    p = payloads.line_payloads(line)
    texts = ["Document_No", "No", "VAT_Prod_Posting_Group", "Withholding_Tax_Code"]
    numbers = ["Direct_Unit_Cost", "Total_VAT_Amount"]
    return p.select(
        *(F.get_json_object("payload", f"$.{k}").alias(k.lower()) for k in texts),
        F.get_json_object("payload", "$.Line_No").cast("bigint").alias("line_no"),
        *(F.get_json_object("payload", f"$.{k}").cast("double").alias(k.lower()) for k in numbers),
        F.size(F.json_object_keys("payload")).cast("bigint").alias("n_entries"),
    )


@query
def run_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run's requests, while some answers are missing: one per invoice that waits."""
    ids = notifications.distinct_ids(fx.events_of(fx.mailbox_bodies(spark, sf))).select("message_id")
    inp = fx.inputs(spark, sf)
    inp = replace(inp, answers=fx.early_answers(inp.answers))
    asked, listings = invoice_run.requests(invoice_run.classify(ids, inp, CFG), inp, CFG, Stage(spark))
    return accounts.prompts(asked, listings).select("message_id", "vendor_no", "model", "max_tokens", "prompt")


@query
def narrow_line_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """The six-field line JSON, read back."""
    p = payloads.narrow_line_payloads(_lines(spark, sf))
    return p.select(
        F.get_json_object("payload", "$.Document_Type").alias("document_type"),
        F.get_json_object("payload", "$.Document_No").alias("document_no"),
        F.get_json_object("payload", "$.Line_No").cast("bigint").alias("line_no"),
        *(
            F.get_json_object("payload", f"$.{k}").cast("double").alias(k.lower())
            for k in ("Quantity", "Direct_Unit_Cost", "Total_VAT_Amount")
        ),
        F.size(F.json_object_keys("payload")).cast("bigint").alias("n_entries"),
    )


@query
def reject_notices(spark: SparkSession, sf: str) -> DataFrame:
    """Every message that was not sent, with the notice to send."""
    return rejects.rejects(_screened(spark, sf))


@query
def notice_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Recipient lists: first address, copies, and whether there is any recipient."""
    k = F.col("c_custkey")
    one = F.concat("c_name", F.lit("@example.com"))
    addresses = (
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 1, one)
        .when(k % 5 == 2, F.concat(one, F.lit(" , "), F.lower("c_mktsegment")))
        .otherwise(F.concat(F.lit(" "), one, F.lit(",a@x , b@x")))
    )
    to = rejects.recipients(addresses)
    return fx.table(spark, sf, "customer").select(
        k.alias("c_custkey"),
        to["recipient"].alias("recipient"),
        F.array_join(to["cc"], ";").alias("cc"),
        to["recipient"].isNotNull().alias("sendable"),
    )


@query
def message_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run: one row per notified message with status, number, lines and total."""
    return rejects.outcomes(_numbered(spark, sf)).select(
        "message_id",
        "received_at",
        "status",
        "document_no",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        "total",
    )


@query
def outcome_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Messages per status."""
    return rejects.outcome_summary(_screened(spark, sf))


@query
def stream_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The run as a stream: notifications land as files, the outbox holds the outcomes."""
    root = f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    fx.mailbox_bodies(spark, sf).select("body").write.option("compression", "gzip").text(f"{root}/landing")
    events = intake.landing_stream(spark, f"{root}/landing")
    intake.start(
        events, lambda s: fx.inputs(s, sf), CFG, f"{root}/out", available_now=True
    ).awaitTermination()
    return Outbox(spark, f"{root}/out", CFG).read("outcomes").select(
        "message_id",
        "received_at",
        "status",
        "document_no",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        "total",
    )


def _rounds(spark: SparkSession, sf: str) -> Outbox:
    """The stream in three rounds: each lands its notifications and reads them as a batch. Some
    answers are there from the second round on only."""
    root = f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    bodies = fx.mailbox_bodies(spark, sf)
    inputs = fx.landed(spark, sf, f"{root}/inputs")
    for k in range(1, fx.ROUNDS + 1):

        def load(s: SparkSession, k: int = k) -> invoice_run.Inputs:
            inp = inputs(s)
            return inp if k >= fx.ALL_ANSWERED else replace(inp, answers=fx.early_answers(inp.answers))

        fx.landing_round(bodies, k).select("body").write.mode("append").text(f"{root}/landing")
        events = intake.landing_stream(spark, f"{root}/landing")
        intake.start(events, load, CFG, f"{root}/out", available_now=True).awaitTermination()
    return Outbox(spark, f"{root}/out", CFG)


@query
def swept_notifications(spark: SparkSession, sf: str) -> DataFrame:
    """The landing log: notifications land as files in two rounds, are swept into segments and read as a
    stream; arrivals per message id."""
    root = f"{shared_root(spark)}/landing-{uuid.uuid4().hex}"
    log = LandingLog(spark, f"{root}/landing", f"{root}/log", most=5)
    early = F.dayofyear("ts") % 2 == 0
    ids = f"{root}/ids"
    for part in (early, ~early):
        bodies = fx.event_bodies(spark, sf).filter(part).select("body")
        bodies.write.mode("append").text(f"{root}/landing")
        log.drain()
        writer = intake.swept_stream(log).select("message_id").writeStream.trigger(availableNow=True)
        writer.option("checkpointLocation", f"{root}/checkpoint").format("parquet").start(ids).awaitTermination()
    return spark.read.schema("message_id string").parquet(ids).groupBy("message_id").agg(
        F.count(F.lit(1)).alias("n_events")
    )


@query
def exported_messages(spark: SparkSession, sf: str) -> DataFrame:
    """A message export by buckets, and what a batch of ids reads of it: every seventh notified id."""
    mail = fx.parsed_mail(fx.mail_json(spark, sf)).select("message_id", "subject", "received_at", "has_attachments")
    path = f"{shared_root(spark)}/export-{uuid.uuid4().hex}"
    export.write(mail, path, buckets=16)
    notified = notifications.distinct_ids(fx.events_of(fx.mailbox_bodies(spark, sf)))
    batch = notified.select("message_id").filter(F.col("message_id").try_cast("bigint") % 7 == 0)
    return export.of_ids(export.read(spark, path, mail.schema), batch, buckets=16)


@query
def erp_key_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Posted lines read by ranges of a text key, cut from a sample: rows and keys of every vendor's first
    letters, the same whatever the cuts."""
    posted = fx.posted_lines(spark, sf)
    parts = tables.key_ranges(posted, "vendor_no", tables.key_bounds(posted, "vendor_no", 8))
    whole = reduce(DataFrame.unionByName, (p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)))
    per_vendor = whole.groupBy("vendor_no").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("part").alias("n_ranges")
    )
    return per_vendor


def _directories(spark: SparkSession, sf: str, root: str) -> tuple[Directories, DataFrame]:
    """Vendors and posted lines in three changes, and the posted lines as a written table. The first change
    also brings a wrong name for every vendor and a wrong line for every line, which the last one takes back."""
    kept = Directories(spark, root)
    master = fx.vendors(spark, sf)
    third = F.pmod(F.xxhash64("vendor_no", "account", "description"), F.lit(3)).cast("int")
    # The lines land as a table by their change, so that each change reads its own and none joins them again.
    landed = fx.posted_lines(spark, sf).withColumn("third", third)
    schema = landed.schema
    landed.write.partitionBy("third").parquet(f"{root}/posted_lines")
    landed = spark.read.schema(schema).parquet(f"{root}/posted_lines")
    posted = landed.drop("third")
    wrong_names = master.withColumn("name", F.concat(F.lit("A"), "name"))
    wrong_lines = posted.withColumn("account", F.lit("0"))
    one, back = F.lit(1).alias("n"), F.lit(-1).alias("n")
    for k in range(3):
        lines = landed.filter(F.col("third") == k).drop("third").select("*", one)
        vendors_ = None
        if k == 0:
            lines = lines.unionByName(wrong_lines.select("*", one))
            vendors_ = wrong_names.select("*", one)
        if k == 2:
            lines = lines.unionByName(wrong_lines.select("*", back))
            vendors_ = wrong_names.select("*", back).unionByName(master.select("*", one))
        kept = kept.apply(k, vendors_, lines)
    return kept, posted


@query
def maintained_directories(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor directory and accounts after inserts and deletes, for the tax numbers of all invoices."""
    kept, _ = _directories(spark, sf, f"{shared_root(spark)}/directories-{uuid.uuid4().hex}")
    # Lookups read their keys several times: written once, they are not derived again from the payloads.
    stage = Stage(spark)
    issuers = stage.table("issuers", _parsed(spark, sf).select("issuer_nif").distinct())
    directory = stage.table("directory", kept.vendors(issuers))
    summary = accounts.summary(kept.accounts(directory.select("vendor_no").distinct()))
    return joins.lookup_join(directory, summary, ["vendor_no"], "left")


@query
def stream_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers as events: all notifications land first, with three quarters of the answers; then
    the other answers land, without a notification. Vendors and posted lines come from directories.
    `turn` is the outcome's place among those of its message."""
    root = f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    kept, posted = _directories(spark, sf, f"{root}/directories")
    inputs = fx.landed(spark, sf, f"{root}/inputs", posted)
    answers = inputs(spark).answers.filter("answer is not null").select("message_id", "answer")
    early = fx.early_answers(answers)

    def load(s: SparkSession) -> invoice_run.Inputs:
        return replace(inputs(s), answers=None, vendors=None, posted_lines=None, directories=kept)

    for landed in (early, joins.lookup_join(answers, early.select("message_id"), ["message_id"], "left_anti")):
        landed.write.mode("append").json(f"{root}/answers")
        if landed is early:
            fx.mailbox_bodies(spark, sf).select("body").write.text(f"{root}/landing")
        intake.start(
            intake.landing_stream(spark, f"{root}/landing"),
            load,
            CFG,
            f"{root}/out",
            available_now=True,
            answers=intake.answer_stream(spark, f"{root}/answers"),
        ).awaitTermination()
    turn = F.row_number().over(W.partitionBy("message_id").orderBy("batch_id")).cast("bigint")
    return Outbox(spark, f"{root}/out", CFG).read("outcomes").select(
        "message_id", turn.alias("turn"), "received_at", "status", "document_no", "total"
    )


@query
def stream_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """The outbox after several batches: ids and invoice numbers that come again, numbers that go on,
    and invoices that wait for an answer and are taken up later. One row per outcome and line;
    `turn` is the outcome's place among those of its message."""
    outbox = _rounds(spark, sf)
    turn = F.row_number().over(W.partitionBy("message_id").orderBy("batch_id")).cast("bigint")
    outcomes = outbox.read("outcomes").select(
        "message_id", turn.alias("turn"), "received_at", "status", "document_no", "total"
    )
    headers_out = outbox.read("headers_out").select(
        "document_no",
        "buy_from_vendor_no",
        F.date_format("document_date", "yyyy-MM-dd").alias("document_date"),
        "vendor_invoice_no",
    )
    lines_out = outbox.read("lines_out").select(
        "document_no",
        F.col("line_no").cast("bigint").alias("line_no"),
        "account",
        "direct_unit_cost",
        "total_vat_amount",
        "vat_prod_posting_group",
    )
    return outcomes.join(headers_out.join(lines_out, "document_no", "full"), "document_no", "full")
