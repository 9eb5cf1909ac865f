"""Vendor master: resolution by tax number and by name, buyer check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.operators.joins import lookup_join
from faturaflow.operators.status import first_failure


def directory(vendors: DataFrame) -> DataFrame:
    """One row per tax number: vendor name, vendor number, number used on headers.

    Several vendors with one tax number: the smallest number gives the name. The
    vendor number is the smallest one with exactly that name; the header number is
    the smallest one with that name in any case and a tax number.
    """
    by_vat = (
        vendors.filter(F.col("vat").isNotNull())
        .groupBy("vat")
        .agg(F.min(F.struct("vendor_no", "name")).alias("v"))
        .select("vat", F.col("v.name").alias("name"))
        .filter(F.col("name").isNotNull())
    )
    by_name = (
        vendors.filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.min("vendor_no").alias("vendor_no"))
    )
    on_headers = (
        vendors.filter(F.col("name").isNotNull() & F.col("vat").isNotNull())
        .groupBy(F.upper("name").alias("name_upper"))
        .agg(F.min("vendor_no").alias("buy_from_no"))
    )
    named = lookup_join(by_vat, by_name, ["name"], "inner")
    full = lookup_join(
        named.withColumn("name_upper", F.upper("name")), on_headers, ["name_upper"], "inner"
    )
    return full.select("vat", F.col("name").alias("vendor_name"), "vendor_no", "buy_from_no")


def check_buyer(df: DataFrame, buyer_nif: str) -> DataFrame:
    """Payload without pairs or buyer: BAD_QR; other buyer: WRONG_BUYER; then no issuer: BAD_QR."""
    return first_failure(
        df,
        ("BAD_QR", F.col("payload_buyer").isNull()),
        ("WRONG_BUYER", F.col("payload_buyer") != buyer_nif),
        ("BAD_QR", F.col("issuer_nif").isNull()),
    )


def resolve(df: DataFrame, vendor_directory: DataFrame, spread_by: str = "message_id") -> DataFrame:
    found = lookup_join(
        df, vendor_directory.withColumnRenamed("vat", "issuer_nif"), ["issuer_nif"], "left", spread_by
    )
    return first_failure(found, ("UNKNOWN_VENDOR", F.col("vendor_no").isNull()))


def join_by_name(records: DataFrame, vendors: DataFrame) -> DataFrame:
    """Left join on the upper-cased name, then only rows with a tax number.

    Vendors that share a name multiply the rows. Both inputs of the join are plain
    scans, so AQE can split a hot name on the records side.
    """
    v = vendors.select(F.upper("name").alias("name_upper"), "vendor_no", "vat")
    r = records.withColumn("name_upper", F.upper("vendor_name"))
    return r.join(v, "name_upper", "left").dropna(subset=["vat"])
