"""A small random mailbox, and the same job done one message after another in plain Python."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession

from faturaflow import schemas
from faturaflow.config import JobConfig
from faturaflow.plans.invoice_run import Inputs

CFG = JobConfig(buyer_nif="500", recipients="ap@example.com")
VENDORS = [("V1", "One", "1"), ("V2", "Two", "2"), ("V3", "Three", "3"), ("V4", "Four", "4")]
POSTED = [("V1", "61", "a")] + [("V2", "62", "b"), ("V2", "63", "c")]  # V3: none, V4: none
OPEN = [("FCA25000041", "K1"), ("X", "K2"), ("FCA25000040", None)]
REGISTERED = [("K3",), (None,)]


class Mailbox:
    """A third of all invoices carry one number, a third of all notifications one id."""

    def __init__(self, seed: int, size: int = 240):
        rnd = random.Random(seed)
        self.messages, self.payloads, self.answers = [], {}, {}
        for i in range(size):
            mid = f"m{i:04d}"
            self.messages.append(
                {
                    "id": mid,
                    "received_at": f"2024-01-{rnd.randint(1, 9):02d}T00:00:00Z",
                    "subject": None if rnd.random() < 0.03 else "s",
                    "attachments": rnd.random() > 0.04,
                    "sender": None if rnd.random() < 0.1 else "a@x",
                }
            )
            if rnd.random() > 0.05:
                self.payloads[mid] = self._payload(rnd)
            self.answers[mid] = rnd.choice([" 62 ", "63", "61", ""])
        ids = [m["id"] for m in self.messages]
        self.notified = ids + ["gone"] + ["m0001"] * (size // 2)
        rnd.shuffle(self.notified)

    @staticmethod
    def _payload(rnd: random.Random) -> str:
        number = "HOT" if rnd.random() < 0.33 else f"K{rnd.randint(0, 60)}"
        parts = {
            "A": rnd.choice(["1", "2", "1", "2", "3", "9"]),
            "B": "500" if rnd.random() > 0.04 else "501",
            "D": "FT",
            "F": rnd.choice(["20240105"] * 6 + ["20241399", ""]),
            "H": number,
            "I1": "PT",
            "I2": rnd.choice(["10", "0", "x", ""]),
            "I5": rnd.choice(["5", "0"]),
            "I6": "0.65",
            "I7": rnd.choice(["100", "7", "0"]),
            "I8": rnd.choice(["23", "1.61", "bad"]),
        }
        for key in list(parts):
            if rnd.random() < 0.03:
                del parts[key]
        return "*".join(f"{k}:{v}" for k, v in parts.items()) + "*"

    # ---- the expected result, message by message

    def expected(self) -> dict[str, tuple[str, str | None]]:
        known = {k for _, k in OPEN if k} | {k for (k,) in REGISTERED if k}
        number, out = 42, {}
        by_id = {m["id"]: m for m in self.messages}
        order = sorted(set(self.notified), key=lambda i: (by_id.get(i, {}).get("received_at", ""), i))
        for mid in order:
            status, key = self._gate(by_id.get(mid), known)
            document = None
            if status == "SENT":
                document = f"FCA25{number:06d}"
                number += 1
                known.add(key)
            out[mid] = (status, document)
        return out

    def _gate(self, m: dict | None, known: set[str]) -> tuple[str, str | None]:
        if m is None or m["subject"] is None:
            return "NOT_FOUND", None
        payload = self.payloads.get(m["id"])
        accepted = payload is not None and payload.count("*") >= 6
        if not (m["attachments"] and accepted) and m["sender"] is None:
            return "EMAIL_ERROR", None
        if not m["attachments"]:
            return "NO_ATTACHMENTS", None
        if not accepted:
            return "NO_QR", None
        f = {}
        for part in payload.split("*"):
            if part.count(":") == 1:
                k, v = part.split(":")
                f[k] = v
        if "B" not in f:
            return "BAD_QR", None
        if f["B"] != "500":
            return "WRONG_BUYER", None
        if "A" not in f:
            return "BAD_QR", None
        vendor = {v: no for no, _, v in VENDORS}.get(f["A"])
        if vendor is None:
            return "UNKNOWN_VENDOR", None
        held = [a for v, a, _ in POSTED if v == vendor]
        if not held:
            return "NO_POSTING_HISTORY", None
        if len(held) > 1 and self.answers[m["id"]].strip() not in held:
            return "NO_ACCOUNT", None
        return self._bands(f, known)

    @staticmethod
    def _bands(f: dict[str, str], known: set[str]) -> tuple[str, str | None]:
        pairs = [("I2", None), ("I3", "I4"), ("I5", "I6"), ("I7", "I8")]
        if not any(b in f for b, _ in pairs):
            return "NO_TAX_COLUMNS", None
        percents = []
        for b, v in pairs:
            if b not in f:
                continue
            try:
                base = float(f[b])
                vat = float(f[v]) if v and v in f else 0.0
            except ValueError:
                if v and v not in f:
                    return "MISSING_FIELD", None
                continue
            if base > 0:
                if "H" not in f:
                    return "MISSING_FIELD", None
                percents.append(round(vat / base * 100, 2))
        if not percents:
            return "NO_TAX_VALUES", None
        if f["H"] in known:
            return "DUPLICATE", None
        if f.get("F", "") not in ("", "20240105"):
            return "BAD_DATE", None
        if not any(abs(p - g) <= 0.011 for p in percents for g in (23, 22, 6, 0)):
            return "NO_VALID_GROUP", None
        if f.get("F", "") == "":
            return "NO_DATE", None
        return "SENT", f["H"]

    # ---- as Spark inputs

    def inputs(self, spark: SparkSession) -> Inputs:
        messages = spark.createDataFrame(
            [
                (m["id"], m["received_at"], None, m["sender"], m["subject"], m["subject"] is not None, m["attachments"])
                for m in self.messages
            ],
            "message_id string, received_at string, sender_name string, sender_address string, subject string,"
            "readable boolean, has_attachments boolean",
        )
        pdf = "application/pdf"
        candidates = spark.createDataFrame(
            [(mid, 0, pdf, 1, 0, 0, 0, text) for mid, text in self.payloads.items()]
            + [(mid, 0, pdf, 0, 0, 0, 0, "A*B") for mid in self.payloads],
            schemas.DECODE_CANDIDATE,
        )
        return Inputs(
            messages=messages,
            candidates=candidates,
            answers=spark.createDataFrame(list(self.answers.items()), schemas.CLASSIFIER_ANSWER),
            vendors=spark.createDataFrame(VENDORS, "vendor_no string, name string, vat string"),
            posted_lines=spark.createDataFrame(POSTED, "vendor_no string, account string, description string"),
            purchase_header=spark.createDataFrame(OPEN, "document_no string, vendor_invoice_no string"),
            purchase_header_reg=spark.createDataFrame(REGISTERED, "vendor_invoice_no string"),
        )

    def events(self, spark: SparkSession):
        df = spark.createDataFrame([(i,) for i in self.notified], "message_id string")
        return df.selectExpr("message_id", "timestamp '2024-01-10 00:00:00' AS ts")
