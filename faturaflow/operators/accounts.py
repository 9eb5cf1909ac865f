"""Ledger account of an invoice, from the vendor's posting history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faturaflow.config import JobConfig
from faturaflow.functions import text
from faturaflow.operators.joins import lookup_join
from faturaflow.operators.status import AWAITING, first_failure

# Fixed values of the classification request.
SYSTEM_PROMPT = (
    "Você é um assistente especializado em classificação contábil. "
    "Responda APENAS com o número da conta, sem texto adicional."
)
PROMPT_INTRO = "Você é um assistente especializado em análise de documentos e correspondência contábil."
PROMPT_ACCOUNTS = "### 📊 Contas Disponíveis:"
PROMPT_MAIL = "### 📧 Email:"
PROMPT_RULE = (
    "📌 IMPORTANTE: Retorne APENAS o número exato da conta (No_) que melhor corresponde. "
    "A resposta deve ser EXATAMENTE igual a um dos números de conta listados acima, sem texto adicional."
)
LABEL_SENDER, LABEL_SUBJECT, LABEL_BODY = "- Remetente: ", "- Assunto: ", "- Conteúdo: "
LABEL_FILES, FILE_NAME, FILE_TEXT = "- Anexos: ", "Arquivo: ", ", Conteúdo: "
TEMPERATURE = 0.1
MAX_TOKENS = 10


def per_vendor(posted_lines: DataFrame) -> DataFrame:
    """Posted lines per vendor and account: the vendor's account list with its repeats.

    Counting first, on vendor and account, keeps a vendor with very many lines from
    being gathered anywhere. A line without account has the account ''; it is as
    little a valid account. (Never NULL, the column needs no null filter in one use
    and none in the other, so Spark runs the aggregation once for both.)
    """
    return (
        posted_lines.filter(F.col("vendor_no").isNotNull())
        .groupBy("vendor_no", F.coalesce("account", F.lit("")).alias("account"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def summary(accounts: DataFrame) -> DataFrame:
    """One row per vendor: number of posted lines, of distinct accounts, smallest account."""
    return accounts.groupBy("vendor_no").agg(
        F.sum("n_lines").alias("n_rows"),
        F.count(F.lit(1)).alias("n_accounts"),
        F.min("account").alias("first_account"),
    )


def choices(cfg: JobConfig) -> Column:
    return F.col("n_accounts" if cfg.distinct_accounts else "n_rows")


def resolve(
    df: DataFrame, accounts: DataFrame, cfg: JobConfig, spread_by: str = "message_id"
) -> DataFrame:
    """Adds `account`. One posted line: its account. More: the classifier's answer, which must
    be one of the vendor's accounts; without an answer yet, the invoice waits for it. `df` has vendor_no, first_account, n_rows, n_accounts, answer;
    `accounts` is per_vendor's result, whole, so that its one aggregation serves summary() too.
    """
    many = choices(cfg) > 1
    asked = df.withColumn("account", F.when(many, text.strip("answer")))
    checked = lookup_join(asked, accounts, ["vendor_no", "account"], "left", spread_by)
    known = F.when(F.col("n_lines").isNotNull(), F.col("account"))
    account = F.when(many, known).otherwise(F.col("first_account"))
    out = checked.withColumn("account", text.nonempty(account)).drop("n_lines")
    return first_failure(
        out,
        ("NO_POSTING_HISTORY", F.coalesce(choices(cfg), F.lit(0)) == 0),
        (AWAITING, many & F.col("answer").isNull()),
        ("NO_ACCOUNT", F.col("account").isNull()),
    )


def listings(posted_lines: DataFrame) -> DataFrame:
    """One text per vendor: its distinct accounts with their descriptions, sorted.

    Repeats go first, with partial aggregation, and entries are joined per account
    before they are joined per vendor, so a vendor with very many lines is spread
    over tasks until only its listing is left.
    """
    entries = (
        posted_lines.filter(F.col("vendor_no").isNotNull())
        .select(
            "vendor_no", "account", F.concat_ws(" ", F.col("account"), F.col("description")).alias("entry")
        )
        .distinct()
    )
    per_account = entries.groupBy("vendor_no", "account").agg(
        F.expr("listagg(entry, '\n') within group (order by entry)").alias("block")
    )
    return per_account.groupBy("vendor_no").agg(
        F.expr("listagg(block, '\n') within group (order by account)").alias("listing")
    )


def attachments_text(texts: DataFrame) -> DataFrame:
    """One text per message from its attachment texts, for classification requests."""
    entry = F.concat(F.lit(FILE_NAME), F.col("filename"), F.lit(FILE_TEXT), F.col("text"))
    return (
        texts.select("message_id", "att_pos", entry.alias("entry"))
        .groupBy("message_id")
        .agg(F.expr("listagg(entry, '\n') within group (order by att_pos)").alias("attachments_text"))
    )


def with_ids(vendor_listings: DataFrame) -> DataFrame:
    """Adds `listing_id`, a hash of the text: vendors with the same accounts share one listing."""
    return vendor_listings.withColumn("listing_id", F.sha2("listing", 256))


def listing_texts(identified: DataFrame) -> DataFrame:
    """Each listing once, by its id."""
    return identified.select("listing_id", "listing").distinct()


def classification_requests(df: DataFrame, posted_lines: DataFrame, cfg: JobConfig) -> DataFrame:
    """One request with its whole prompt per invoice whose vendor has more than one choice.

    `df` has message_id, vendor_no, n_rows, n_accounts, sender_name, sender_address, subject,
    body and attachments_text.
    """
    identified = with_ids(listings(posted_lines))
    return prompts(requests(df.filter(choices(cfg) > 1), identified, cfg), listing_texts(identified))


def requests(asked: DataFrame, identified: DataFrame, cfg: JobConfig) -> DataFrame:
    """Requests as they are kept: the mail's part of the prompt, and the id of the listing.
    `identified` is with_ids' result; only its ids are joined."""
    asked = lookup_join(asked, identified.select("vendor_no", "listing_id"), ["vendor_no"], "inner")
    mail = [
        _line(LABEL_SENDER, text.display_name(F.col("sender_name"), F.col("sender_address"))),
        _line(LABEL_SUBJECT, F.col("subject")),
        _line(LABEL_BODY, F.col("body")),
        _line(LABEL_FILES, F.col("attachments_text")),
    ]
    return asked.select(
        "message_id",
        "vendor_no",
        F.lit(cfg.model).alias("model"),
        F.lit(TEMPERATURE).alias("temperature"),
        F.lit(MAX_TOKENS).alias("max_tokens"),
        "listing_id",
        F.concat_ws("\n", *mail).alias("mail"),
    )


def prompts(kept_requests: DataFrame, texts: DataFrame) -> DataFrame:
    """The requests with their whole prompt: a view, as the listing is in every one of them."""
    lines = [
        F.lit(PROMPT_INTRO),
        F.lit(""),
        F.lit(PROMPT_ACCOUNTS),
        F.col("listing"),
        F.lit(""),
        F.lit(PROMPT_MAIL),
        F.col("mail"),
        F.lit(""),
        F.lit(PROMPT_RULE),
    ]
    joined = lookup_join(kept_requests, texts.select("listing_id", "listing"), ["listing_id"], "inner")
    return joined.withColumns(
        {"system_prompt": F.lit(SYSTEM_PROMPT), "prompt": F.concat_ws("\n", *lines)}
    ).drop("listing", "listing_id", "mail")


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), F.coalesce(value, F.lit("")))
