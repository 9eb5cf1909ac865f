"""One `status` column per message: the first gate it failed, NULL while it passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Subject of the notice for each status that has one.
NOTICE_SUBJECTS = {
    "NOT_FOUND": "Email não encontrado",
    "NO_ATTACHMENTS": "Email sem anexos",
    "NO_QR": "QR Code não encontrado",
    "EMAIL_ERROR": "Erro no processamento",
    "WRONG_BUYER": "Invoice wrong issued",
    "UNKNOWN_VENDOR": "Invalid vendor",
    "NO_POSTING_HISTORY": "Erro no processamento",
    "NO_ACCOUNT": "Invalid account number",
    "NO_TAX_COLUMNS": "Invoice without values",
    "MISSING_FIELD": "Erro no processamento",
    "NO_TAX_VALUES": "Invoice without values",
    "DUPLICATE": "Invalid invoice",
    "NO_VALID_GROUP": "Invalid invoice",
    "NO_DATE": "Invalid invoice",
}
SENT = "SENT"
# Not final: the invoice waits for the classifier's answer and is taken up again when it is there.
AWAITING = "AWAITING_ACCOUNT"


def first_failure(df: DataFrame, *checks: tuple[str, Column]) -> DataFrame:
    """Set `status` to the first check that holds, for rows that passed all gates so far."""
    before = [F.col("status")] if "status" in df.columns else []
    failed = [F.when(cond, F.lit(name)) for name, cond in checks]
    return df.withColumn("status", F.coalesce(*before, *failed))
