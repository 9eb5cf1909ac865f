from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from faturaflow.config import JobConfig
from faturaflow.operators import (
    accounts,
    joins,
    numbering,
    payloads,
    qr,
    rejects,
    status,
    tax,
    transform,
    vendors,
)
from faturaflow.plans import record_run
from faturaflow.sources.stage import Stage

CFG = JobConfig(buyer_nif="500")


def invoices(spark, **payload_by_id):
    df = spark.createDataFrame(list(payload_by_id.items()), "message_id string, payload string")
    return qr.with_invoice_columns(df)


# ------------------------------------------------------------------ QR candidates and texts


def test_first_accepted_follows_the_search_order(spark, rows):
    good, late = "A:1*B:2*C*D*E*F*first", "A:1*B:2*C*D*E*F*late"
    cols = "message_id string, att_pos int, content_type string, page_no int, phase int, image_no bigint, method_no bigint, text string"
    pdf = "application/pdf"
    df = spark.createDataFrame(
        [
            ("m", 1, pdf, 0, 0, 0, 0, late),
            ("m", 0, pdf, 2, 1, 0, 0, late),
            ("m", 0, pdf, 2, 0, 0, 1, good),
            ("m", 0, pdf, 1, 0, 0, 0, "A*B"),  # too few stars
            ("m", 0, pdf, 0, 0, 0, 0, None),
            ("m", 0, "text/plain", 0, 0, 0, 0, late),  # no PDF
            ("none", 0, pdf, 0, 0, 0, 0, ""),
        ],
        cols,
    )
    assert rows(qr.first_accepted(df)) == [("m", good)]


def pages(spark, data):
    return spark.createDataFrame(data, "message_id string, att_pos int, filename string, page_no int, text string")


def test_texts(spark, rows):
    p = pages(
        spark,
        [("m", 0, "a", n, f"<{n}>") for n in range(9)]
        + [("m", 1, "empty", 0, ""), ("m", 2, "b", 0, None), ("m", 2, "b", 1, "x")],
    )
    whole = "".join(f"<{n}>" for n in range(9))
    for block in (2, 100):  # the same text however the pages are grouped
        assert rows(qr.pdf_texts(p, block)) == [("m", 0, "a", whole, "9"), ("m", 2, "b", "x", "1")]
    ids = spark.createDataFrame([("m",), ("z",)], "message_id string")
    assert ("z", 0, "No text", "", "0") in rows(qr.pdf_texts_or_default(ids, p, 2))


def test_responses(spark, rows):
    mail = spark.createDataFrame([("m", "s")], "message_id string, subject string")
    payload = spark.createDataFrame([("m", "p"), ("x", "q")], "message_id string, payload string")
    texts = spark.createDataFrame([("m", "t1"), ("m", "t2")], "message_id string, text string")
    got = qr.responses(mail, payload, texts)
    assert rows(got, "message_id", "subject", "payload", "text") == [("m", "s", "p", "t1"), ("m", "s", "p", "t2")]


# ------------------------------------------------------------------ vendors


def test_buyer_gate(spark, rows):
    df = vendors.check_buyer(
        invoices(spark, ok="A:1*B:500", wrong="B:501", nob="A:1", noa="B:500", none="x"), "500"
    )
    assert dict(rows(df, "message_id", "status")) == {
        "ok": None,
        "wrong": "WRONG_BUYER",  # tested before the missing issuer
        "nob": "BAD_QR",
        "noa": "BAD_QR",
        "none": "BAD_QR",
    }


VENDORS = [
    ("V3", "Acme", "1"),
    ("V2", "Beta", "1"),  # smaller number: gives the name for tax number 1
    ("V1", "Beta", None),  # same name, smaller number, no tax number
    ("V4", "BETA", "4"),
    ("V5", None, "5"),
    ("V6", "Gamma", None),
]


def vendor_frame(spark):
    return spark.createDataFrame(VENDORS, "vendor_no string, name string, vat string")


def test_vendor_directory(spark, rows):
    got = vendors.directory(vendor_frame(spark))
    assert rows(got, "vat", "vendor_name", "vendor_no", "buy_from_no") == [
        ("1", "Beta", "V1", "V2"),
        ("4", "BETA", "V4", "V2"),
    ]


def test_unknown_vendor(spark, rows):
    df = vendors.check_buyer(invoices(spark, a="A:1*B:500", b="A:9*B:500", c="A:9*B:0"), "500")
    got = vendors.resolve(df, vendors.directory(vendor_frame(spark)))
    assert dict(rows(got, "message_id", "status")) == {"a": None, "b": "UNKNOWN_VENDOR", "c": "WRONG_BUYER"}


def test_join_by_name_multiplies_and_drops_vendors_without_tax_number(spark, rows):
    r = spark.createDataFrame([("m", "beta"), ("n", "gamma"), ("o", "none")], "message_id string, vendor_name string")
    assert rows(vendors.join_by_name(r, vendor_frame(spark)), "message_id", "vendor_no") == [("m", "V2"), ("m", "V4")]


# ------------------------------------------------------------------ accounts


LINES = [
    ("many", "62", "rent"),
    ("many", "62", "rent"),
    ("many", "61", "fuel"),
    ("twice", "63", "same"),
    ("twice", "63", "same"),
    ("one", "64", "x"),
    ("blank", None, "x"),
    (None, "65", "x"),
]


def posted(spark):
    return spark.createDataFrame(LINES, "vendor_no string, account string, description string")


def resolve_accounts(spark, cfg):
    per_vendor = accounts.per_vendor(posted(spark))
    asked = spark.createDataFrame(
        [
            ("hit", "many", " 61\n"),
            ("miss", "many", "99"),
            ("other", "many", "63"),  # another vendor's account
            ("silent", "many", None),
            ("empty", "many", "  "),
            ("twice", "twice", None),
            ("one", "one", "99"),
            ("blank", "blank", None),
            ("new", "unseen", "62"),
        ],
        "message_id string, vendor_no string, answer string",
    )
    counted = joins.lookup_join(asked, accounts.summary(per_vendor), ["vendor_no"], "left")
    got = accounts.resolve(counted, per_vendor, cfg)
    return {r.message_id: (r.account, r.status) for r in got.collect()}


def test_account_resolution(spark):
    assert resolve_accounts(spark, CFG) == {
        "hit": ("61", None),
        "miss": (None, "NO_ACCOUNT"),
        "other": (None, "NO_ACCOUNT"),
        "silent": (None, "AWAITING_ACCOUNT"),
        "empty": (None, "NO_ACCOUNT"),
        "twice": (None, "AWAITING_ACCOUNT"),  # two lines on one account still ask the classifier
        "one": ("64", None),
        "blank": (None, "NO_ACCOUNT"),
        "new": (None, "NO_POSTING_HISTORY"),
    }


def test_distinct_accounts_option(spark):
    got = resolve_accounts(spark, JobConfig("500", distinct_accounts=True))
    assert got["twice"] == ("63", None) and got["miss"] == (None, "NO_ACCOUNT")


def test_per_vendor_keeps_repeats(spark, rows):
    got = accounts.per_vendor(posted(spark)).filter("vendor_no = 'many'")
    assert rows(got) == [("many", "61", 1), ("many", "62", 2)]


def test_classification_request(spark):
    per_vendor = accounts.per_vendor(posted(spark))
    df = spark.createDataFrame(
        [("m", "many", None, "a@x", "subj", "body", ""), ("n", "one", None, "a@x", "s", "b", "")],
        "message_id string, vendor_no string, sender_name string, sender_address string, subject string, body string, attachments_text string",
    )
    counted = joins.lookup_join(df, accounts.summary(per_vendor), ["vendor_no"], "left")
    (row,) = accounts.classification_requests(counted, posted(spark), CFG).collect()
    assert row.message_id == "m" and row.model == "gpt-4" and row.max_tokens == 10
    assert "\n61 fuel\n62 rent\n" in row.prompt and "- Remetente: a@x\n- Assunto: subj" in row.prompt


def test_attachments_text(spark, rows):
    texts = spark.createDataFrame(
        [("m", 1, "b", "y"), ("m", 0, "a", "x")], "message_id string, att_pos int, filename string, text string"
    )
    assert rows(accounts.attachments_text(texts)) == [("m", "Arquivo: a, Conteúdo: x\nArquivo: b, Conteúdo: y")]


# ------------------------------------------------------------------ tax bands


BANDS = {
    # id: (payload, status, [(band, base, vat)])
    "i2": ("H:1*I2:10", None, [("I2", 10.0, 0.0)]),
    "all": ("H:1*I7:4*I8:0.92*I2:1*I3:2*I4:0.12*I5:3*I6:.39", None,
            [("I2", 1.0, 0.0), ("I3", 2.0, 0.12), ("I5", 3.0, 0.39), ("I7", 4.0, 0.92)]),
    "novat": ("H:1*I3:5", None, [("I3", 5.0, 0.0)]),
    "badvat": ("H:1*I3:5*I4:x*I2:1", None, [("I2", 1.0, 0.0)]),
    "badbase": ("H:1*I3:x*I4:1*I2:1", None, [("I2", 1.0, 0.0)]),
    "badi2": ("H:1*I2:x*I3:1*I4:0", None, [("I3", 1.0, 0.0)]),
    "breaks": ("H:1*I3:x*I2:1", "MISSING_FIELD", []),
    "noh": ("I2:1", "MISSING_FIELD", []),
    "noh0": ("I2:0", "NO_TAX_VALUES", []),
    "none": ("H:1*I4:5", "NO_TAX_COLUMNS", []),
    "zero": ("H:1*I2:0*I3:-5*I4:1", "NO_TAX_VALUES", []),
    "nan": ("H:1*I2:nan", "NO_TAX_VALUES", []),
    "under": ("H:1*I2:1_000", None, [("I2", 1000.0, 0.0)]),
    "suffix": ("H:1*I2:1.0d", "NO_TAX_VALUES", []),
}


def test_tax_bands(spark):
    df = tax.with_bands(invoices(spark, **{k: v[0] for k, v in BANDS.items()}), CFG)
    got = {r.message_id: (r.status, [(b.band, b.base, b.vat) for b in r.bands]) for r in df.collect()}
    assert got == {k: (s, b) for k, (_, s, b) in BANDS.items()}


def test_band_records(spark):
    df = tax.with_bands(invoices(spark, m="H:9*I7:100*I8:23*I5:50*I6:6.5", x="H:1"), CFG)
    df = df.withColumns({"vendor_name": F.lit("V"), "account": F.lit("62")})
    got = [r.asDict() for r in tax.band_records(df).orderBy("band_order").collect()]
    assert [(r["band"], r["total"], r["vat_percent"], r["posting_group"]) for r in got] == [
        ("I5", 56.5, 13.0, None),
        ("I7", 123.0, 23.0, "OBS-NOR"),
    ]
    first = got[0]
    assert (first["doc_type"], first["issue_date"], first["situation"]) == ("", "", "Registrada")
    assert (first["issuer_region"], first["buyer_region"]) == ("", "")


def test_decimal_money(spark):
    cfg = JobConfig("500", money="decimal(18,2)")
    (row,) = tax.with_bands(invoices(spark, m="H:1*I7:0.1*I8:0.2"), cfg).collect()
    assert str(row.bands[0].total) == "0.30"


# ------------------------------------------------------------------ known invoices, documents


def test_not_known_with_nulls_on_the_right(spark, rows):
    rec = spark.createDataFrame([("m", "1"), ("n", "2"), ("o", None)], "message_id string, vendor_invoice_no string")
    t1 = spark.createDataFrame([("2",), (None,)], "vendor_invoice_no string")
    t2 = spark.createDataFrame([("3",)], "vendor_invoice_no string")
    keys = ["vendor_invoice_no"]
    got = transform.not_known(rec, transform.known_keys(keys, t1, t2), keys, "message_id")
    assert rows(got, "message_id") == [("m",), ("o",)]


def line_table(spark):
    data = [("d1", 0, "G"), ("d1", 1, None), ("d2", 0, None)]
    return spark.createDataFrame(data, "document_no string, band_order int, vat_prod_posting_group string")


def test_valid_documents(spark, rows):
    lines = line_table(spark)
    assert rows(transform.valid_documents(lines, lines), "document_no", "band_order") == [("d1", 0), ("d1", 1)]


def test_match_lines(spark, rows):
    headers = spark.createDataFrame([("d1",), ("d9",)], "document_no string")
    matched, missing = transform.match_lines(headers, line_table(spark))
    assert rows(matched, "document_no", "band_order") == [("d1", 0), ("d1", 1)]
    assert rows(missing) == [("d9", "NO_LINES")]


def test_transform_and_process_records(spark, rows):
    cols = (
        "message_id string, vendor_name string, vendor_invoice_no string, issue_date string, account string,"
        "band_order int, base double, vat double, posting_group string"
    )
    recs = spark.createDataFrame(
        [
            ("m1", "beta", "N1", "20240105", "62", 0, 10.0, 0.0, "OBS-ISEN"),  # two vendors of that name
            ("m1", "beta", "N1", "20240105", "62", 2, 5.0, 0.65, None),
            ("m2", "Acme", "N1", "20240105", "62", 0, 1.0, 0.0, "OBS-ISEN"),  # same number, later
            ("m3", "Acme", "K1", "20240105", "62", 0, 1.0, 0.0, "OBS-ISEN"),  # open in the ERP
            ("m4", "Acme", "K3", "20240105", "62", 0, 1.0, 0.0, "OBS-ISEN"),  # registered
            ("m5", "Acme", "N5", "20240105", "62", 2, 5.0, 0.65, None),  # no group at all
            ("m6", "gamma", "N6", "20240105", "62", 0, 1.0, 0.0, "OBS-ISEN"),  # vendor without tax number
            ("m7", "Acme", "N7", "", "62", 0, 1.0, 0.0, "OBS-ISEN"),  # no date
            ("m8", "Acme", "N8", "20240106", "62", 0, 1.0, 0.0, "OBS-ISEN"),
        ],
        cols,
    )
    open_ = spark.createDataFrame([("FCA25000041", "K1")], "document_no string, vendor_invoice_no string")
    reg = spark.createDataFrame([("K3",), (None,)], "vendor_invoice_no string")
    headers, lines = record_run.transform_records(recs, vendor_frame(spark), open_, reg, CFG, Stage(spark))
    assert rows(headers, "document_no", "buy_from_vendor_no", "vendor_invoice_no") == [
        ("FCA25000042", "V2", "N1"),
        ("FCA25000043", "V3", "N8"),
    ]
    assert rows(lines, "document_no", "line_no", "direct_unit_cost") == [
        ("FCA25000042", 10000, 10.0),
        ("FCA25000042", 20000, 10.0),
        ("FCA25000042", 30000, 5.0),
        ("FCA25000042", 40000, 5.0),
        ("FCA25000043", 10000, 1.0),
    ]
    kept = lines.filter("document_no = 'FCA25000042'")
    header_json, line_json, outcome = record_run.process_records(headers, kept)
    assert header_json.count() == 1 and line_json.count() == 4
    assert rows(outcome) == [("FCA25000042", "SENT"), ("FCA25000043", "NO_LINES")]


# ------------------------------------------------------------------ numbering


@pytest.mark.parametrize(
    ("numbers", "expected"),
    [
        ([], 1),
        (["X1"], 1),
        (["FCA25000009", "FCA25000010", None], 11),
        (["FCA25999999", "FCA251000000"], 1000000),  # compared as text
        (["FCA25abc"], 1),
        (["aFCA2512FCA2599"], 13),  # the text between the first two prefixes
        (["FCA25"], 1),
    ],
)
def test_next_number(spark, numbers, expected):
    df = spark.createDataFrame([(n,) for n in numbers], "document_no string")
    assert numbering.next_number(df, "FCA25").first()[0] == expected


def test_ranked_is_dense_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("a").alias("g"))
    got = numbering.ranked(df, [F.col("g"), F.col("k")], Stage(spark), "t")
    assert sorted((r.k, r["rank"]) for r in got.collect()) == [(i, i) for i in range(5000)]


def test_ranked_within_groups_with_a_hot_group(spark):
    df = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") * 17 % 3000).alias("k"),
    )
    got = numbering.ranked_within(df, "g", [F.col("k")], Stage(spark), "t").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.k, r["rank"]))
    assert len(got) == 3000 and len(groups["hot"]) == 1000
    for members in groups.values():
        assert [rank for _, rank in sorted(members)] == list(range(len(members)))


# ------------------------------------------------------------------ payloads


def line_row(spark, document_no="FCA25000001", vat=0.0, group=None, cost=10.0):
    return spark.createDataFrame(
        [(document_no, "Invoice", 10000, 1, "62", cost, vat, group, "IRSINDEP23", "G/L Account", "G/L Account", "62")],
        "document_no string, document_type string, line_no int, quantity int, account string, direct_unit_cost double,"
        "total_vat_amount double, vat_prod_posting_group string, withholding_tax_code string, type string,"
        "filtered_type_field string, no string",
    )


def test_line_payload_without_empty_entries(spark):
    (row,) = payloads.line_payloads(line_row(spark)).collect()
    assert json.loads(row.payload) == {
        "Document_Type": "Invoice",
        "Document_No": "FCA25000001",
        "Line_No": 10000,
        "Quantity": 1.0,
        "Direct_Unit_Cost": 10.0,
        "Type": "G/L Account",
        "FilteredTypeField": "G/L Account",
        "No": "62",
    }


def test_line_payload_with_other_prefix_has_the_withholding_code(spark):
    (row,) = payloads.line_payloads(line_row(spark, "X1", 2.3, "OBS-NOR")).collect()
    got = json.loads(row.payload)
    assert got["Withholding_Tax_Code"] == "IRSINDEP23" and got["Total_VAT_Amount"] == 2.3
    assert got["VAT_Prod_Posting_Group"] == "OBS-NOR" and len(got) == 11


def test_narrow_line_payload(spark):
    (row,) = payloads.narrow_line_payloads(line_row(spark, vat=1.0)).collect()
    assert list(json.loads(row.payload)) == [
        "Document_Type", "Document_No", "Line_No", "Quantity", "Direct_Unit_Cost", "Total_VAT_Amount",
    ]


def test_header_payload(spark):
    df = spark.createDataFrame(
        [("F1", "Invoice", "V1", dt.date(2024, 2, 3), "")],
        "document_no string, document_type string, buy_from_vendor_no string, document_date date, vendor_invoice_no string",
    )
    assert json.loads(payloads.header_payloads(df).first().payload) == {
        "Document_Type": "Invoice", "No": "F1", "Buy_from_Vendor_No": "V1", "Document_Date": "2024-02-03",
    }


# ------------------------------------------------------------------ rejects


@pytest.mark.parametrize(
    ("addresses", "recipient", "cc"),
    [("a@x", "a@x", None), (" a@x , b@x,c@x", "a@x", ["b@x", "c@x"]), ("", None, None), (None, None, None)],
)
def test_recipients(spark, addresses, recipient, cc):
    df = spark.createDataFrame([(addresses,)], "a string").select(rejects.recipients(F.col("a")).alias("r"))
    r = df.first().r
    assert (r.recipient, r.cc) == (recipient, cc)


def test_every_status_with_a_subject_has_a_text(spark):
    names = [*status.NOTICE_SUBJECTS, "BAD_QR", "BAD_DATE", "NO_LINES", "SENT"]
    df = spark.createDataFrame(
        [(n, n, "2024-01-02T03:04:05Z", None, "a@x", "s", "77") for n in names],
        "message_id string, status string, received_at string, sender_name string, sender_address string, subject string, issuer_nif string",
    )
    got = {r.message_id: r for r in rejects.rejects(df).collect()}
    assert "SENT" not in got
    for n in names[:-1]:
        assert (got[n].notice_subject is None) == (got[n].notice_text is None) == (n not in status.NOTICE_SUBJECTS)
    assert "received:2024-01-02\n" in got["NO_QR"].notice_text
    assert got["UNKNOWN_VENDOR"].notice_text.startswith("Vendor 77 ")
    sent = rejects.notices(rejects.rejects(df), "x@y, z@y").filter("message_id = 'NO_QR'").first()
    assert (sent.recipient, sent.cc, sent.sendable) == ("x@y", ["z@y"], True)
    assert rejects.notices(rejects.rejects(df), None).filter("sendable").count() == 0


def test_outcome_summary_and_any_sent(spark, rows):
    df = spark.createDataFrame([("SENT",), ("NO_QR",), ("NO_QR",)], "status string")
    assert rows(rejects.outcome_summary(df)) == [("NO_QR", 2), ("SENT", 1)]
    assert rejects.any_sent(df).first()[0] is True
    assert rejects.any_sent(df.filter("status <> 'SENT'")).first()[0] is False
    assert rejects.any_sent(df.limit(0)).first()[0] is False


def test_first_failure_keeps_the_first(spark):
    df = spark.range(1)
    df = status.first_failure(df, ("A", F.lit(False)), ("B", F.lit(None).cast("boolean")), ("C", F.lit(True)))
    df = status.first_failure(df, ("D", F.lit(True)))
    assert df.first().status == "C"
