"""Schemas of the job's inputs. Every reader passes one of these; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# Body of one "new message" notification.
NOTIFICATION = _struct(value=T.ArrayType(_struct(resource=_S)))

# One mail message as the mail service exports it.
ATTACHMENT = _struct(id=_S, name=_S, contentType=_S, contentBytes=_S, size=T.LongType())
MESSAGE = _struct(
    id=_S,
    internetMessageId=_S,
    sender=_struct(emailAddress=_struct(name=_S, address=_S)),
    subject=_S,
    body=_struct(content=_S),
    receivedDateTime=_S,
    hasAttachments=T.BooleanType(),
    isDraft=T.BooleanType(),
    attachments=T.ArrayType(ATTACHMENT),
)

# Texts found by the QR decoder, one row per attempt.
DECODE_CANDIDATE = _struct(
    message_id=_S,
    att_pos=T.IntegerType(),
    content_type=_S,
    page_no=T.IntegerType(),
    phase=T.IntegerType(),
    image_no=T.LongType(),
    method_no=T.LongType(),
    text=_S,
)
PAGE_TEXT = _struct(
    message_id=_S, att_pos=T.IntegerType(), filename=_S, page_no=T.IntegerType(), text=_S
)
CLASSIFIER_ANSWER = _struct(message_id=_S, answer=_S)


def outbox(money: str) -> dict[str, T.StructType]:
    """Tables of the outbox; `money` is the Spark type of amounts."""
    amount = T.DataType.fromDDL(money)
    number, flag = T.IntegerType(), T.BooleanType()
    return {
        "headers_out": _struct(
            document_no=_S,
            document_type=_S,
            buy_from_vendor_no=_S,
            document_date=T.DateType(),
            vendor_invoice_no=_S,
            payload=_S,
        ),
        "lines_out": _struct(
            document_no=_S,
            document_type=_S,
            line_no=number,
            quantity=number,
            account=_S,
            direct_unit_cost=amount,
            total_vat_amount=amount,
            vat_percent=T.DoubleType(),
            vat_prod_posting_group=_S,
            withholding_tax_code=_S,
            type=_S,
            filtered_type_field=_S,
            no=_S,
            band_order=number,
            payload=_S,
        ),
        "requests": _struct(
            message_id=_S,
            vendor_no=_S,
            model=_S,
            temperature=T.DoubleType(),
            max_tokens=number,
            listing_id=_S,
            mail=_S,
        ),
        "rejects": _struct(
            message_id=_S, status=_S, received_date=_S, sender=_S, notice_subject=_S, notice_text=_S
        ),
        "notices": _struct(
            message_id=_S,
            notice_subject=_S,
            notice_text=_S,
            recipient=_S,
            cc=T.ArrayType(_S),
            sendable=flag,
        ),
        "outcomes": _struct(
            message_id=_S,
            received_at=_S,
            status=_S,
            document_no=_S,
            n_lines=number,
            total=T.DoubleType(),
        ),
    }


def state(dup_keys: Sequence[str]) -> dict[str, tuple[T.StructType, list[str]]]:
    """Tables of the stream's state (sinks.keyed_log) with their keys.

    keys: what has been sent. seen: ids with a final outcome. waiting: ids without an answer yet. answers:
    those that arrived as events. listings: texts of classification requests, by their hash.
    """
    types = {"document_date": T.DateType()}
    keys = _struct(document_no=_S, **{c: types.get(c, _S) for c in dup_keys})
    return {
        "keys": (keys, list(dup_keys)),
        "seen": (_struct(message_id=_S), ["message_id"]),
        "waiting": (_struct(message_id=_S), ["message_id"]),
        "answers": (CLASSIFIER_ANSWER, ["message_id"]),
        "listings": (_struct(listing_id=_S, listing=_S), ["listing_id"]),
    }


# Directories kept beside the ERP (streaming.directories), with their keys.
DIRECTORIES: dict[str, tuple[T.StructType, list[str]]] = {
    "posted": (_struct(vendor_no=_S, account=_S, description=_S), ["vendor_no"]),
    "by_vat": (_struct(vat=_S, vendor_no=_S, name=_S), ["vat"]),
    "by_name": (_struct(name=_S, vendor_no=_S), ["name"]),
    "on_headers": (_struct(name_upper=_S, vendor_no=_S), ["name_upper"]),
}

# ERP tables: our column -> column in the ERP.
ERP_COLUMNS: dict[str, dict[str, str]] = {
    "vendors": {"vendor_no": "No_", "name": "Name", "vat": "VAT Registration No_"},
    "purchase_header": {"document_no": "No_", "vendor_invoice_no": "Vendor Invoice No_"},
    "purchase_header_reg": {"vendor_invoice_no": "Vendor Invoice No_"},
    "posted_lines": {
        "account": "No_",
        "description": "Description",
        "vendor_no": "Buy-From Vendor No_",
    },
}
