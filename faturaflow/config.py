"""Job parameters. Nothing here is a secret: hosts, credentials and the buyer's
tax number are given by the caller."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the invoice format: base field and VAT field of each tax band,
# in posting order. The first band is exempt and has no VAT field.
BANDS: tuple[tuple[str, str | None], ...] = (
    ("I2", None),
    ("I3", "I4"),
    ("I5", "I6"),
    ("I7", "I8"),
)

# VAT percentage range (inclusive, after rounding to two digits)
# of each posting group. There is no group for the 13 % band.
POSTING_GROUPS: tuple[tuple[str, float, float], ...] = (
    ("OBS-NOR", 22.99, 23.01),
    ("OBS-NORMAD", 21.99, 22.01),
    ("OBS-RDZ", 5.99, 6.01),
    ("OBS-ISEN", -0.01, 0.01),
)

# Fixed values written to the ERP records.
DOCUMENT_TYPE = "Invoice"
LINE_TYPE = "G/L Account"
SITUATION = "Registrada"
WITHHOLDING_CODE = "IRSINDEP23"
WITHHOLDING_PREFIX = "F"
LINE_STEP = 10000
MIN_QR_STARS = 6


@dataclass(frozen=True)
class JobConfig:
    """Parameters of one job.

    dup_keys: columns that identify an invoice already known to the ERP.
    distinct_accounts: count distinct accounts instead of posted lines when
        deciding whether a vendor needs the classifier.
    money: Spark type of the amounts in band, header and line records.
    page_block: pages concatenated per first-level group when texts are built.
    """

    buyer_nif: str
    number_prefix: str = "FCA25"
    number_width: int = 6
    dup_keys: tuple[str, ...] = ("vendor_invoice_no",)
    distinct_accounts: bool = False
    money: str = "double"
    recipients: str | None = None
    model: str = "gpt-4"
    page_block: int = 256
