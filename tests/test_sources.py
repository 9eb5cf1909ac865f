from __future__ import annotations

import base64
import json
import os
from dataclasses import replace

import pytest
from mailbox import CFG, Mailbox
from pyspark.sql import functions as F

from faturaflow import schemas
from faturaflow.sinks.outbox import Outbox
from faturaflow.sources import export, files, messages, notifications, stage, tables
from faturaflow.sources.landing import LandingLog
from faturaflow.streaming import intake


def mail(spark, *docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "raw string")
    parsed = df.select(F.from_json("raw", schemas.MESSAGE).alias("m")).select("m.*")
    return messages.parse(parsed)


FULL = {
    "id": "m1",
    "sender": {"emailAddress": {"address": "contas@fornecedor.example"}},
    "subject": "Fatura 17/A",
    "body": {"content": "Segue a fatura."},
    "attachments": [],
    "receivedDateTime": "2025-03-09T17:45:10Z",
    "hasAttachments": True,
}


def test_message_projection(spark):
    row = mail(spark, FULL).first()
    assert (row.sender_address, row.subject, row.body) == (
        "contas@fornecedor.example",
        "Fatura 17/A",
        "Segue a fatura.",
    )
    assert row.internet_message_id == "" and row.sender_name is None
    assert row.has_attachments is False  # recomputed from the attachments
    assert row.readable is True


@pytest.mark.parametrize("missing", ["sender", "subject", "body"])
def test_required_fields(spark, missing):
    doc = {k: v for k, v in FULL.items() if k != missing}
    assert mail(spark, doc).first().readable is False


def test_not_found_error_object_is_not_readable(spark):
    row = mail(spark, {"error": {"code": "ErrorItemNotFound"}}).first()
    assert row.readable is False and row.message_id == ""


def test_attachment_decoding(spark):
    good = base64.b64encode(b"%PDF-1.7 um").decode()
    doc = FULL | {
        "attachments": [
            {"name": "a.pdf", "contentType": "application/pdf", "contentBytes": good, "size": 11},
            {"name": "bad.pdf", "contentType": "application/pdf", "contentBytes": "!!"},
            {},
            {"contentBytes": ""},
        ]
    }
    row = mail(spark, doc).first()
    got = [(a.att_pos, a.name, a.content_type, a.content and bytes(a.content), a.size) for a in row.attachments]
    assert got == [
        (0, "a.pdf", "application/pdf", b"%PDF-1.7 um", 11),
        (2, "Unknown", "Unknown", None, 0),
        (3, "Unknown", "Unknown", None, 0),
    ]
    assert row.has_attachments is True


def test_missing_attachments(spark):
    doc = {k: v for k, v in FULL.items() if k != "attachments"}
    assert mail(spark, doc).first().attachments == []


def test_subscription_filter(spark, rows):
    df = spark.createDataFrame(
        [
            ("in", "2024-05-02T08:00:00Z", True, False),
            ("early", "2024-05-01T23:59:59Z", True, False),
            ("bare", "2024-05-02T08:00:00Z", False, False),
            ("draft", "2024-05-02T08:00:00Z", True, True),
        ],
        "message_id string, received_at string, has_attachments boolean, is_draft boolean",
    )
    assert rows(messages.subscribed(df, F.lit("2024-05-02").cast("date")), "message_id") == [("in",)]


def test_one_per_id(spark, rows):
    df = spark.createDataFrame([("a", "2", "x"), ("a", "1", "y"), ("b", None, "z")], "message_id string, r string, s string")
    assert rows(messages.one_per_id(df)) == [("a", "1", "y"), ("b", None, "z")]


def test_fetched_attachments(spark, rows):
    wanted = spark.createDataFrame([("m", ["1", "2", "3", None])], "message_id string, ids array<string>").select(
        "message_id", F.transform("ids", lambda i: F.struct(i.alias("id"))).alias("attachments")
    )
    enc = base64.b64encode(b"x").decode()
    store = spark.createDataFrame(
        [("1", None, None, enc), ("2", "n", "t", ""), ("9", "n", "t", enc)],
        "id string, name string, contentType string, contentBytes string",
    )
    got = messages.fetched_attachments(wanted, store)
    assert [(r.message_id, r.filename, bytes(r.content), r.content_type) for r in got.collect()] == [
        ("m", "arquivo_desconhecido", b"x", "application/octet-stream")
    ]


def test_notifications(spark, rows):
    bodies = spark.createDataFrame(
        [
            ('{"value":[{"resource":"users/x/messages/1"},{"resource":"users/x/Messages/2"},{}]}',),
            ('{"other":1}',),
            ("no json",),
        ],
        "body string",
    )
    parsed = bodies.select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"),
        notifications.parse_body(F.col("body")).alias("n"),
    ).select("ts", "n.value")
    events = notifications.message_ids(parsed)
    assert rows(events, "message_id") == [("",), ("1",), ("2",)]
    twice = events.unionByName(events.withColumn("ts", F.col("ts") - F.expr("interval 1 day")))
    first = notifications.distinct_ids(twice)
    assert first.count() == 3
    assert first.agg(F.max("ts").cast("date").cast("string")).first()[0] == "2023-12-31"


def test_tables_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "vendors")
    spark.createDataFrame(
        [("V1", "Acme", "500", "x")], "No_ string, Name string, `VAT Registration No_` string, Other string"
    ).write.parquet(path)
    df = tables.read_table(spark, "vendors", path)
    assert df.columns == ["vendor_no", "name", "vat"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Other" not in plan.split("ReadSchema")[1]
    assert tuple(df.first()) == ("V1", "Acme", "500")


def test_jdbc_options_are_partitioned():
    o = tables.jdbc_options("jdbc:x", "t", partition_column="id", lower=0, upper=9, partitions=3)
    assert o["numPartitions"] == "3" and o["partitionColumn"] == "id"


@pytest.mark.parametrize("bounds", [[], ["m"], ["B'x", "m", "t"]])
def test_key_predicates_put_each_row_into_one_partition(spark, bounds):
    keys = [None, "", "A", "B'x", "B'y", "m", "ma", "t", "zz"]
    df = spark.createDataFrame([(k,) for k in keys], "`No_` string")
    found = []
    for p in tables.key_predicates("No_", bounds):
        found += [r[0] for r in df.filter(p.replace('"No_"', "`No_`").replace("''", "\\'")).collect()]
    assert len(found) == len(keys) and set(found) == set(keys)
    assert len(tables.key_predicates("No_", bounds)) == len(bounds) + 1


def test_stage_reuses_a_complete_table(spark, tmp_path):
    s = stage.Stage(spark, str(tmp_path / "s"))
    assert s.table("t", spark.range(3)).count() == 3
    with pytest.raises(ValueError):
        s.table("t", spark.range(5))
    again = stage.Stage(spark, str(tmp_path / "s"))  # a replay of the same run
    assert again.table("t", spark.range(3)).count() == 3


def test_landing_files(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(FULL))
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "n.json").write_text('{"value":[{"resource":"a/b"}]}')
    assert messages.parse(messages.read_landing(spark, str(tmp_path / "m.json"))).first().message_id == "m1"
    landed = notifications.read_landing(spark, str(tmp_path / "n"))
    assert notifications.message_ids(landed, ts=None).first().message_id == "b"


# ------------------------------------------------------------------ landing log


def land_lines(folder, name, *ids, changed=None):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(json.dumps({"value": [{"resource": f"users/mb/messages/{i}"}]}) for i in ids))
    if changed is not None:
        os.utime(path, (changed, changed))


def swept_ids(spark, log, checkpoint):
    seen = []
    writer = intake.swept_stream(log).writeStream.option("checkpointLocation", str(checkpoint))
    query = writer.trigger(availableNow=True).foreachBatch(lambda df, _: seen.extend(r.message_id for r in df.collect())).start()
    query.awaitTermination()
    assert query.exception() is None
    return sorted(seen)


def test_landing_log_reads_every_file_once(spark, tmp_path):
    """Files of any age, in sweeps of two; nothing stays in the folder, no line comes twice."""
    log = LandingLog(spark, str(tmp_path / "landing"), str(tmp_path / "log"), most=2)
    assert log.drain() == 0 and swept_ids(spark, log, tmp_path / "cp") == []
    for k in range(5):
        land_lines(tmp_path / "landing", f"n{k}.json", f"a{k}", f"b{k}", changed=1_000_000_000 - 10_000 * k)
    land_lines(tmp_path / "landing", "_part", "unfinished")
    assert log.drain() == 5
    assert swept_ids(spark, log, tmp_path / "cp") == sorted(f"{x}{k}" for k in range(5) for x in "ab")
    land_lines(tmp_path / "landing", "n0.json", "again", changed=1)  # an old file, under a name that was there before
    assert log.drain() == 1 and swept_ids(spark, log, tmp_path / "cp") == ["again"]
    assert [f for f in os.listdir(tmp_path / "landing") if not f.startswith(".")] == ["_part"]
    assert len(json.loads((tmp_path / "log" / "intent.json").read_text())["files"]) <= 2


@pytest.mark.parametrize("where", ["text", "delete"])
def test_a_sweep_that_was_cut_short_is_finished(spark, tmp_path, monkeypatch, where):
    log = LandingLog(spark, str(tmp_path / "landing"), str(tmp_path / "log"))
    land_lines(tmp_path / "landing", "n0.json", "x")
    land_lines(tmp_path / "landing", "n1.json", "y")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if where == "delete":
            m.setattr(files, "delete", stop)
        else:
            m.setattr(type(spark.read), "text", stop)
        with pytest.raises(RuntimeError):
            log.sweep()
    land_lines(tmp_path / "landing", "n2.json", "z")
    log.drain()
    assert swept_ids(spark, log, tmp_path / "cp") == ["x", "y", "z"]


# ------------------------------------------------------------------ exports by id


def scan_metrics(df, *names):
    """Of the one scan of a query that has run."""
    # Of an adaptive plan: its result stage, and in that the plan that ran.
    leaves = df._jdf.queryExecution().executedPlan().executedPlan().plan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).nodeName().strip() == "Scan parquet"]
    assert len(scans) == 1
    return {n: scans[0].metrics().apply(n).value() for n in names}


def test_a_batch_reads_the_buckets_of_its_ids(spark, tmp_path):
    rows = spark.range(4000).selectExpr("concat('m', id) AS message_id", "id AS v")
    # A third of all rows has one id.
    hot = spark.range(2000).selectExpr("'hot' AS message_id", "id AS v")
    export.write(rows.unionByName(hot), str(tmp_path / "out"), buckets=32)
    kept = export.read(spark, str(tmp_path / "out"), rows.schema)
    spark.createDataFrame([("m7",)], "message_id string").write.parquet(str(tmp_path / "ids"))
    one = spark.read.parquet(str(tmp_path / "ids"))  # as a batch's ids are
    found = export.of_ids(kept, one, buckets=32)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("m7", 7)]
    read = scan_metrics(found, "numFiles", "numPartitions", "numOutputRows")
    assert 1 <= read["numFiles"] <= 2 and read["numOutputRows"] < 600, read
    assert kept.select(export.BUCKET).distinct().count() == 32
    many = spark.range(0, 4000, 2).selectExpr("concat('m', id) AS message_id").union(spark.createDataFrame([("hot",), ("none",)]))
    assert export.of_ids(kept, many, buckets=32).count() == 4000
    assert export.of_ids(rows, one).count() == 1, "a plain table"


def test_a_run_over_exports_gives_the_same(spark, tmp_path):
    """Messages, decoder texts and answers from exports, in two batches."""
    box = Mailbox(15, size=80)

    def load(s):
        inp = box.inputs(s)
        return replace(inp, **{t: export.read(s, f"{tmp_path}/{t}", getattr(inp, t).schema) for t in parts})

    parts = ("messages", "candidates", "answers")
    for t in parts:
        export.write(getattr(box.inputs(spark), t), f"{tmp_path}/{t}")
    half = F.pmod(F.xxhash64("message_id"), F.lit(2)) == 0
    for k, some in enumerate((half, ~half)):
        intake.process_batch(spark, box.events(spark).filter(some), k, load, CFG, f"{tmp_path}/out")
    done = {r.message_id: r.status for r in Outbox(spark, f"{tmp_path}/out", CFG).read("outcomes").collect()}
    gates = {m: s for m, (s, _) in box.expected().items() if s not in ("SENT", "DUPLICATE")}
    assert {m: done[m] for m in gates} == gates and set(done) == set(box.notified)


# ------------------------------------------------------------------ key ranges


def test_key_ranges_are_disjoint_complete_and_even(spark):
    """A third of the rows has one key, some have none; ranges hold their share but for that key's."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, "k00500").when(F.col("id") % 100 == 1, None).otherwise(F.format_string("k%05d", F.col("id") % 997))
    df = spark.range(0, n, 1, 6).select("id", key.alias("key")).cache()
    bounds = tables.key_bounds(df, "key", 10)
    assert bounds == sorted(set(bounds)) and 6 <= len(bounds) <= 9
    parts = [p.select("id", "key").collect() for p in tables.key_ranges(df, "key", bounds)]
    assert sorted(r.id for p in parts for r in p) == list(range(n))
    nulls = sum(r.key is None for r in parts[0])
    sizes = [sum(r.key not in (None, "k00500") for r in p) for p in parts]
    assert nulls == df.filter("key is null").count() and max(sizes) < 1.5 * n / 10
    assert [p.replace('"key"', "key") for p in tables.key_predicates("key", bounds)][-1] == f"key >= '{bounds[-1]}'"
    assert tables.key_bounds(df.limit(0), "key", 10) == [] and len(tables.key_ranges(df, "key", [])) == 1
    df.unpersist()
