"""The job's inputs derived from the test tables (see FIXTURES.md).

Values vary by key so that every status occurs; no table is cut down.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faturaflow import schemas
from faturaflow.config import JobConfig
from faturaflow.operators import accounts
from faturaflow.operators.joins import lookup_join
from faturaflow.plans.invoice_run import Inputs
from faturaflow.sources import messages, notifications, tables

BUYER = "500000000"
CONFIG = JobConfig(buyer_nif=BUYER, recipients="ap@example.com, audit@example.com")


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _padded(value: str, width: int) -> str:
    """SQL: digits with leading zeros; longer numbers keep all their digits."""
    return f"lpad({value}, greatest(length(string({value})), {width}), '0')"


def _vendor_no(key: str) -> str:
    return f"concat('V', {_padded(key, 6)})"


def invoiced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """message_id, k, o_orderdate, supp and the bases I2, I3, I5, I7: one row per order that has lines.

    Lines are grouped and joined by the message id, so that what is joined by it next need not
    be shuffled again. Amounts are added up as whole cents, which take eight bytes a sum.
    """

    def total(cond: str) -> Column:
        cents = "bigint(cast(l_extendedprice AS decimal(15,2)) * 100BD)"
        return F.expr(f"cast(sum(if({cond}, {cents}, NULL)) * 0.01BD AS decimal(15,2))")

    sums = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("message_id"))
        .agg(
            F.min("l_suppkey").alias("supp"),
            total("l_tax = 0").alias("I2"),
            total("l_tax > 0 AND l_returnflag = 'A'").alias("I3"),
            total("l_tax > 0 AND l_returnflag = 'R'").alias("I5"),
            total("l_tax > 0 AND l_returnflag = 'N'").alias("I7"),
        )
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) AS message_id", "o_orderkey AS k", "o_orderdate"
    )
    return orders.join(sums, "message_id")


def qr_messages(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """message_id, order_key, supp, payload: one invoice per order that has lines."""

    def vat(base: str, rate: str) -> str:
        return f"cast(round({base} * {rate}BD, 2) AS decimal(15,2))"

    plain = "NOT (k % 109 = 4 OR k % 113 = 5 OR k % 137 = 8)"
    payload = f"""concat(concat_ws('*',
        if(k % 131 = 7, NULL, concat('A:', 500000000 + supp)),
        CASE WHEN k % 127 = 6 THEN NULL WHEN k % 17 = 0 THEN 'B:999' ELSE 'B:{BUYER}' END,
        'D:FT',
        CASE WHEN k % 101 = 1 THEN NULL WHEN k % 103 = 2 THEN 'F:20241399'
             ELSE concat('F:', date_format(o_orderdate, 'yyyyMMdd')) END,
        if(k % 107 = 3, NULL, concat('H:ATCUD-', k - if(k % 29 = 1, 1, 0))),
        'I1:PT',
        CASE WHEN {plain} THEN concat('I2:', I2) WHEN k % 109 = 4 THEN NULL WHEN k % 113 = 5 THEN 'I2:abc'
             ELSE NULL END,
        CASE WHEN {plain} THEN concat('I3:', I3) WHEN k % 109 = 4 OR k % 113 = 5 THEN NULL ELSE 'I3:abc' END,
        if({plain}, concat('I4:', {vat("I3", "0.06")}), NULL),
        if({plain}, concat('I5:', I5), NULL), if({plain}, concat('I6:', {vat("I5", "0.13")}), NULL),
        if({plain}, concat('I7:', I7), NULL), if({plain}, concat('I8:', {vat("I7", "0.23")}), NULL)), '*')"""
    return (invoiced_orders(spark, sf_dir) if orders is None else orders).selectExpr(
        "message_id", "k AS order_key", "supp", f"{payload} AS payload"
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some vendors share a name, some a tax number, some have none."""
    name = "concat('Supplier#', lpad(s_suppkey - if(s_suppkey % 13 = 5, 1, 0), 9, '0'))"
    erp = table(spark, sf_dir, "supplier").selectExpr(
        f"{_vendor_no('s_suppkey')} AS `No_`",
        f"if(s_suppkey % 3 = 0, lower({name}), {name}) AS `Name`",
        "if(s_suppkey % 10 <> 9, 500000000 + s_suppkey - if(s_suppkey % 11 = 6, 1, 0), NULL)"
        " AS `VAT Registration No_`",
        "s_acctbal AS `Balance`",
    )
    return tables.narrow(erp, "vendors")


def purchase_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    erp = open_orders.selectExpr(
        f"concat('FCA25', {_padded('o_orderkey', 6)}) AS `No_`",
        "concat('ATCUD-', o_orderkey) AS `Vendor Invoice No_`",
        "o_orderdate AS `Document Date`",
    )
    return tables.narrow(erp, "purchase_header")


def purchase_header_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled_orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    erp = filled_orders.selectExpr(
        "concat('ATCUD-', o_orderkey) AS `Vendor Invoice No_`", "o_orderdate AS `Document Date`"
    )
    return tables.narrow(erp, "purchase_header_reg")


def posted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors 4n have many lines, 4n+1 one line, the others none."""
    sold = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    many = sold.selectExpr(
        f"{_vendor_no('l_suppkey - l_suppkey % 4')} AS `Buy-From Vendor No_`",
        f"concat('62', {_padded('p_size', 3)}) AS `No_`",
        "p_type AS `Description`",
    )
    one = table(spark, sf_dir, "supplier").selectExpr(
        f"{_vendor_no('if(s_suppkey % 4 = 1, s_suppkey, s_suppkey - s_suppkey % 4)')}"
        " AS `Buy-From Vendor No_`",
        "'62000' AS `No_`",
        "'LITERAL' AS `Description`",
    )
    return tables.narrow(many.unionByName(one), "posted_lines")


def decode_candidates(
    spark: SparkSession, sf_dir: str, payloads: DataFrame | None = None
) -> DataFrame:
    """Both sides of the join are partitioned by message id, and so is what comes of it."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_orderkey) AS message_id", "l_linenumber", "cast(l_suppkey % 2 AS int) AS att_pos", "l_partkey"
    )
    by_order = (qr_messages(spark, sf_dir) if payloads is None else payloads).select("message_id", "payload")
    return lines.join(by_order, "message_id").selectExpr(
        "message_id",
        "att_pos",
        "if(l_partkey % 11 = 5, 'image/png', 'application/pdf') AS content_type",
        "cast(l_linenumber % 3 AS int) AS page_no",
        "cast(l_partkey % 2 AS int) AS phase",
        "cast(l_linenumber AS bigint) AS image_no",
        "l_partkey AS method_no",
        "if(l_linenumber >= 3, concat(payload, 'Z:', l_linenumber, '*'), 'A*B') AS text",
    )


def classifier_answers(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, posted: DataFrame | None = None
) -> DataFrame:
    """Answers for the vendor of the payload's tax number. An invoice whose vendor has another
    number by its name, or none, may stay without one."""
    # The aggregation that the run itself makes, with its count: Spark then makes it once for both.
    smallest = (
        accounts.per_vendor(posted_lines(spark, sf_dir) if posted is None else posted)
        .groupBy("vendor_no")
        .agg(F.expr("min(nullif(account, ''))").alias("account"), F.sum("n_lines").alias("n"))
        .filter("n > 0")
        .select("vendor_no", "account")
    )
    # Every row has a key, so all are asked. The sums are named for their columns: with fewer Spark would
    # add up all lines once more. No payload is made for it, which would be made twice.
    invoices = (invoiced_orders(spark, sf_dir) if orders is None else orders).filter(
        "coalesce(I2, I3, I5, I7, cast(k AS decimal(20,0))) IS NOT NULL"
    )
    asked = invoices.selectExpr("message_id", "k AS order_key", f"{_vendor_no('supp')} AS vendor_no")
    return lookup_join(asked, smallest, ["vendor_no"], "inner").selectExpr(
        "message_id", "if(order_key % 5 = 0, '99999', concat('  ', account, ' ')) AS answer"
    )


def mail_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw`: one exported message per order, as JSON text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").selectExpr(
        """to_json(named_struct(
            'id', string(o_orderkey),
            'internetMessageId', concat('<', o_orderkey, '@mb>'),
            'sender', named_struct('emailAddress', named_struct(
                'name', if(o_custkey % 7 <> 0, c_name, NULL),
                'address', if(o_custkey % 21 <> 0, concat('c', o_custkey, '@example.com'), NULL))),
            'subject', if(o_orderkey % 23 <> 5, concat('Invoice ', o_orderkey), NULL),
            'body', named_struct('content', o_orderpriority),
            'receivedDateTime', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            'isDraft', false,
            'attachments', if(o_orderkey % 19 <> 3, array(named_struct(
                'name', 'invoice.pdf', 'contentType', 'application/pdf',
                'contentBytes', if(o_orderkey % 19 = 4, '!!', 'JVBERi0='), 'size', 5)), NULL))) AS raw"""
    )


def parsed_mail(raw: DataFrame) -> DataFrame:
    """The fields come out of a generator: filters on them, which Catalyst would move below a
    projection with the whole expression, then parse no text again for each field they ask for."""
    return messages.parse(raw.select(F.inline(F.array(F.from_json("raw", schemas.MESSAGE)))))


def document_mail_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw`: one message per document; the document's text is the attachment."""
    return table(spark, sf_dir, "documents").selectExpr(
        """to_json(named_struct(
            'id', concat('users/mb/Messages/', doc_id),
            'sender', named_struct('emailAddress', named_struct('address', concat(lang, '@example.com'))),
            'subject', if(doc_id % 11 <> 0, concat('Document ', doc_id), NULL),
            'body', named_struct('content', lang),
            'hasAttachments', true,
            'attachments', array(named_struct(
                'name', source,
                'contentType', if(lang IN ('en', 'de'), 'application/pdf', 'text/plain'),
                'contentBytes', if(doc_id % 7 = 0, '!!', translate(base64(encode(text, 'UTF-8')), '\r\n', '')),
                'size', n_chars)))) AS raw"""
    )


_BODY = """concat('{{"value":[{{', coalesce(concat('"resource":"users/mb/messages/', {}, '"'), ''), '}}]}}')"""


def event_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ts, body: one notification per event; errors are notified without a value."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(ts AS timestamp) AS ts",
        f"if(event_type = 'error', '{{}}', {_BODY.format('user_id')}) AS body",
    )


def mailbox_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications of the whole run: every order once, every event once more for its user's
    message; events of type error name a message that does not exist."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate AS timestamp) AS ts", f"{_BODY.format('o_orderkey')} AS body"
    )
    target = "if(event_type = 'error', 'X', ''), user_id"
    events = table(spark, sf_dir, "events").selectExpr(
        "cast(ts AS timestamp) AS ts", f"{_BODY.format(target)} AS body"
    )
    return orders.unionByName(events)


#: Rounds in which the notifications of the whole run land, and the first one with all answers.
ROUNDS, ALL_ANSWERED = 3, 2


def landing_round(bodies: DataFrame, k: int) -> DataFrame:
    """Round k of the notifications: those of the days of year that leave rest k - 1."""
    return bodies.filter(F.dayofyear("ts") % ROUNDS == k - 1)


def early_answers(answers: DataFrame) -> DataFrame:
    """The answers that are there from the first round on."""
    return answers.filter(F.col("message_id").try_cast("bigint") % 4 != 1)


def events_of(bodies: DataFrame) -> DataFrame:
    parsed = bodies.select("ts", notifications.parse_body(F.col("body")).alias("n"))
    return notifications.message_ids(parsed.select("ts", "n.value"))


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    orders = invoiced_orders(spark, sf_dir)
    return Inputs(
        messages=parsed_mail(mail_json(spark, sf_dir)),
        candidates=decode_candidates(spark, sf_dir, qr_messages(spark, sf_dir, orders)),
        answers=classifier_answers(spark, sf_dir, orders),
        vendors=vendors(spark, sf_dir),
        posted_lines=posted_lines(spark, sf_dir),
        purchase_header=purchase_header(spark, sf_dir),
        purchase_header_reg=purchase_header_reg(spark, sf_dir),
    )


def landed(
    spark: SparkSession, sf_dir: str, root: str, posted: DataFrame | None = None
) -> Callable[[SparkSession], Inputs]:
    """`inputs` for a stream: the tables that take joins, sums or JSON texts are written under `root` once. What is
    returned reads them, and the other test tables, anew for every batch: the same rows, derived once and not per batch.

    `posted`: the posted lines, if they are a written table already. Messages land without their attachments'
    content, which no batch reads.
    """

    def written(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    orders = written("orders", invoiced_orders(spark, sf_dir))
    posted = written("posted_lines", posted_lines(spark, sf_dir)) if posted is None else posted
    tables_ = {
        "messages": written("messages", parsed_mail(mail_json(spark, sf_dir)).drop("attachments")),
        "candidates": written("candidates", decode_candidates(spark, sf_dir, qr_messages(spark, sf_dir, orders))),
        "answers": written("answers", classifier_answers(spark, sf_dir, orders, posted)),
    }
    schemas_ = {name: df.schema for name, df in tables_.items()}

    def load(s: SparkSession) -> Inputs:
        own = {name: s.read.schema(schema).parquet(f"{root}/{name}") for name, schema in schemas_.items()}
        return replace(inputs(s, sf_dir), posted_lines=posted, **own)

    return load
