"""What the large runs rest on: each table is added up and shuffled once."""

from __future__ import annotations

import random
import re
from dataclasses import replace

from pyspark.sql import functions as F

from faturaflow import fixtures as fx
from faturaflow.functions import numbers
from faturaflow.functions import qr as qr_functions
from faturaflow.operators import joins, qr, rejects, tax
from faturaflow.plans import invoice_run, queries
from faturaflow.sinks.outbox import Manifest, Outbox
from faturaflow.sources import notifications
from faturaflow.sources.stage import Stage
from faturaflow.streaming import intake


def write_tables(spark, root, null_size: bool = False):
    """Three orders with lines; every second line of a vendor with many lines."""
    n = 24
    spark.range(n).selectExpr(
        "id % 3 + 1 AS l_orderkey", "id AS l_partkey", "id % 8 AS l_suppkey", "cast(id % 7 + 1 AS int) AS l_linenumber",
        "id * 1.005D AS l_extendedprice", "if(id % 4 = 0, 0.0D, 0.05D) AS l_tax", "substr('ARN', cast(id % 3 AS int) + 1, 1) AS l_returnflag",
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(4).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'P' AS o_orderstatus", "timestamp'2024-01-05' AS o_orderdate", "'5-LOW' AS o_orderpriority"
    ).write.parquet(f"{root}/orders.parquet")
    size = "cast(NULL AS int)" if null_size else "cast(id % 5 AS int)"
    spark.range(n).selectExpr("id AS p_partkey", f"{size} AS p_size", "'LARGE' AS p_type").write.parquet(f"{root}/part.parquet")
    spark.range(8).selectExpr("id AS s_suppkey", "0.0D AS s_acctbal").write.parquet(f"{root}/supplier.parquet")
    spark.range(4).selectExpr("id AS c_custkey", "concat('C', id) AS c_name").write.parquet(f"{root}/customer.parquet")
    spark.range(3).selectExpr(
        "id AS event_id", "timestamp'2024-01-06' AS ts", "if(id = 2, NULL, id) AS user_id", "'view' AS event_type"
    ).write.parquet(f"{root}/events.parquet")
    return str(root)


def shuffles(df, pattern: str) -> int:
    """Different exchanges of the plan whose keys match; equal ones are made once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = set(re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan))
    return sum(1 for k in keys if re.search(pattern, k))


def test_payload_and_candidates_meet_without_another_shuffle(spark, tmp_path):
    sf = write_tables(spark, tmp_path / "sf")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = qr.first_accepted(fx.decode_candidates(spark, sf))
        # lines, orders and sums, each once, and nothing after that
        assert shuffles(first, "") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_posted_lines_are_added_up_once(spark, tmp_path):
    sf = write_tables(spark, tmp_path / "sf")
    ids = notifications.distinct_ids(fx.events_of(fx.mailbox_bodies(spark, sf))).select("message_id")
    df = invoice_run.classify(ids, fx.inputs(spark, sf), queries.CFG)
    plan = df._jdf.queryExecution().executedPlan().toString()
    masked = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"functions=\[partial_count\(1\)\][^\n]*", plan)]
    filters = {re.sub(r"#\d+L?", "", x) for x in re.findall(r"\n[^\n]*Filter ([^\n]*l_suppkey[^\n]*l_partkey[^\n]*)", plan)}
    assert masked and len(filters) == 1  # one shape for all uses, so one aggregation


def test_amounts_are_exact_and_answers_ignore_missing_accounts(spark, tmp_path):
    sf = write_tables(spark, tmp_path / "sf", null_size=True)
    got = fx.qr_messages(spark, sf).orderBy("message_id").collect()
    exact = fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.expr("cast(sum(if(l_tax = 0, cast(l_extendedprice AS decimal(15,2)), NULL)) AS decimal(15,2))").alias("i2")
    )
    want = {str(r.l_orderkey): str(r.i2) for r in exact.collect()}
    assert {r.message_id: re.search(r"\*I2:([0-9.]+)", r.payload).group(1) for r in got} == want
    answers = {r.answer for r in fx.classifier_answers(spark, sf).collect()}
    assert answers and "    " not in answers


def test_bodies_without_a_message_are_json(spark, tmp_path):
    sf = write_tables(spark, tmp_path / "sf")
    bodies = sorted(r.body for r in fx.event_bodies(spark, sf).collect())
    assert bodies == ['{"value":[{"resource":"users/mb/messages/0"}]}', '{"value":[{"resource":"users/mb/messages/1"}]}', '{"value":[{}]}']


def test_joined_pairs_give_the_values_of_the_pairs(spark):
    texts = ["A:1*B:2*A:3*", "A:1:2*A:4*", "*A:*", "AA:1*B:A:2*", "", "A:5", "B:1*A:6*A:7:8", "x*:*A", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for key in ("A", "B", "AA", "Z"):
        pairs = qr_functions.pairs(F.col("t"))
        got = df.select(qr_functions.value(pairs, key), qr_functions.joined_value(qr_functions.joined(pairs), key)).collect()
        assert all(a == b for a, b in got)


def test_a_route_is_small_and_never_null(spark):
    routed = spark.range(100).select(joins._route(["id"], None).alias("r"))
    assert not routed.schema["r"].nullable
    assert routed.agg(F.min("r") >= 0, F.max("r") < 4096).first() == (True, True)


def test_lookup_keys_are_not_derived_again(spark, tmp_path):
    """maintained_directories: neither the payloads nor the posted lines are computed once more for the result."""
    sf = write_tables(spark, tmp_path / "sf")
    plan = queries.REGISTRY["maintained_directories"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


def test_answers_are_not_read_while_nothing_waits(spark, tmp_path):
    outbox = Outbox(spark, str(tmp_path / "out"), queries.CFG)
    arrived = spark.sql("SELECT '1' AS message_id, current_timestamp() AS ts, cast(NULL AS string) AS answer")
    unread = spark.range(1).selectExpr("'1' AS message_id", "string(raise_error('read')) AS answer")
    ids = intake.taken_up(arrived, outbox, Manifest(), unread).collect()
    assert [(r.message_id, r.waited) for r in ids] == [("1", False)]


def test_a_filter_on_mail_parses_its_text_once(spark, tmp_path):
    """response_assembly: the filter asks for five fields of the JSON text, which was parsed for each."""
    sf = write_tables(spark, tmp_path / "sf")
    mail = fx.parsed_mail(fx.mail_json(spark, sf)).filter("readable and has_attachments").select("message_id", "received_at")
    assert mail._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert sorted(mail.collect()) == [(str(i), "2024-01-05T00:00:00Z") for i in (0, 1, 2)]
    broken = fx.parsed_mail(spark.createDataFrame([("no json",), (None,)], "raw string"))
    assert [(r.message_id, r.readable) for r in broken.collect()] == [("", False)] * 2


def test_answers_make_no_payload(spark, tmp_path):
    """The answers ask who sold, and name the sums only to share the candidates' aggregation of all lines."""
    sf = write_tables(spark, tmp_path / "sf")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        answers = fx.classifier_answers(spark, sf)
        plan = answers._jdf.queryExecution().executedPlan().toString()
        assert "concat_ws" not in plan
        partial = r"functions=\[(partial_min\(l_suppkey[^\n]*), output"
        both = answers.unionByName(qr.first_accepted(fx.decode_candidates(spark, sf)).toDF("message_id", "answer"))
        plan = both._jdf.queryExecution().executedPlan().toString()
        sums = re.findall(partial, plan)
        assert len(sums) == 2 and len({re.sub(r"#\d+L?", "", x) for x in sums}) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_payloads_are_not_split(spark):
    """Equal to the text of the pairs; only payloads with other parts take the longer way."""
    texts = ["A:1*B:2*A:3*", "A:1*", "A:1*B:2", "A:1:2*A:4*", "*A:*", "A:1**B:2*", "A*B:1*", ":*", "A:1\n*B:\u00e9*", "", "*", None, "A:1*" * 20_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(qr_functions.joined_pairs(F.col("t")), qr_functions.joined(qr_functions.pairs(F.col("t")))).collect()
    assert all(a == b for a, b in got)


def test_stars_and_plain_numbers_are_told_as_before(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("A*:", k=rng.randint(0, 14))) for _ in range(3_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    told = df.select("t", qr_functions.is_payload(F.col("t")).alias("p")).collect()
    assert all(r.p == (r.t.count("*") >= 6) for r in told)
    texts = ["".join(rng.choices("0017.._+-e fd\u00a0", k=rng.randint(0, 7))) for _ in range(5_000)]
    df = spark.createDataFrame([(t,) for t in [*texts, "12.50", "007", "1.", ".5", "9" * 400, "1.0d", "\u0661", "1\n"]], "t string")
    c = F.col("t")
    general = F.when(c.rlike(numbers._FLOAT), F.translate(c, numbers._DROPPED, "").try_cast("double"))
    wrong = df.filter(~numbers.text_to_float(c).eqNullSafe(general)).collect()
    assert not wrong


def test_requests_classify_once(spark, tmp_path):
    """run_requests: who waits is written, so the run is not made again for the listings."""
    sf = write_tables(spark, tmp_path / "sf")
    plan = queries.REGISTRY["run_requests"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "event_type" not in plan and "p_type" in plan  # the listings' tables, not the notifications



def loaders(monkeypatch, name: str, spark, sf: str) -> list:
    """What the query gives its stream to load the batches' inputs with."""
    seen = []
    start = intake.start
    monkeypatch.setattr(intake, "start", lambda events, load, *a, **k: (seen.append(load), start(events, load, *a, **k))[1])
    queries.REGISTRY[name](spark, sf).collect()
    return seen


def assert_only_written_tables(spark, sf: str, loads: list):
    """A batch derives nothing anew, and reads the rows that `inputs` derives."""
    whole = fx.inputs(spark, sf)
    for load in loads:
        inp = load(spark)
        for name in ("messages", "candidates", "answers", "posted_lines"):
            df = getattr(inp, name)
            if df is None:
                continue
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert not re.search("Join|Aggregate|from_json|Generate", plan), name
            if name != "answers" or load is loads[-1]:
                want = getattr(whole, name).select(df.columns)
                assert sorted(df.collect(), key=repr) == sorted(want.collect(), key=repr), name


def test_rounds_derive_their_inputs_once(spark, tmp_path, monkeypatch):
    """stream_rounds: sums, candidates, mail and answers were derived again for every round."""
    sf = write_tables(spark, tmp_path / "sf")
    loads = loaders(monkeypatch, "stream_rounds", spark, sf)
    assert len(loads) == fx.ROUNDS
    assert_only_written_tables(spark, sf, loads)


def test_late_answers_derive_their_inputs_once(spark, tmp_path, monkeypatch):
    """stream_answers: as above, and the answers that land as events come from one table."""
    sf = write_tables(spark, tmp_path / "sf")
    loads = loaders(monkeypatch, "stream_answers", spark, sf)
    assert len(loads) == 2
    assert_only_written_tables(spark, sf, loads)


def test_listings_of_a_batch_are_made_once(spark, tmp_path):
    """stream_rounds: requests, known listings and the state each made them; where nobody waits none is made."""
    rows = "SELECT '{}' AS message_id, 'V1' AS vendor_no, 'n' AS sender_name, 'a' AS sender_address, 's' AS subject, '{}' AS status"
    mail = spark.sql("SELECT 'm' AS message_id, 'b' AS body")
    posted = spark.sql("SELECT 'V1' AS vendor_no, '62' AS account, 'd' AS description UNION ALL SELECT 'V2', '63', 'e'")
    inp = invoice_run.Inputs(mail, None, None, None, posted, None, None)
    asked, listings = invoice_run.requests(spark.sql(rows.format("m", "AWAITING_ACCOUNT")), inp, queries.CFG, Stage(spark, str(tmp_path / "a")), True)
    for df in (asked, listings):
        assert "listagg" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.message_id, r.vendor_no) for r in asked.collect()] == [("m", "V1")]
    assert [r.listing for r in listings.collect()] == ["62 d"]
    unread = posted.withColumn("description", F.expr("string(raise_error('read'))"))
    nobody = spark.sql(rows.format("m", "SENT"))
    asked, listings = invoice_run.requests(nobody, replace(inp, posted_lines=unread), queries.CFG, Stage(spark, str(tmp_path / "b")), True)
    assert "raise_error" not in listings._jdf.queryExecution().optimizedPlan().toString()
    assert asked.collect() == [] and listings.collect() == []


def test_failed_messages_have_their_band_fields_left_unread(spark):
    text = "*A:1*B:2*F:20240101*H:h*I2:5*I3:10*I4:2*"
    df = spark.createDataFrame([("m", text, None), ("x", text, "BAD_QR")], "message_id string, pairs_text string, status string")
    got = {r.message_id: r for r in qr.with_other_fields(df, F.col("status").isNull()).collect()}
    assert (got["m"].i2, got["m"].i4, got["x"].i2, got["x"].i4) == ("5", "2", None, None)
    assert got["m"].vendor_invoice_no == got["x"].vendor_invoice_no == "h"
    bands = tax.with_bands(qr.with_other_fields(df, F.col("status").isNull()), queries.CFG)
    whole = tax.with_bands(qr.with_other_fields(df), queries.CFG)
    assert sorted(bands.select("message_id", "status", "bands").collect()) == sorted(whole.select("message_id", "status", "bands").collect())


def test_recipients_are_taken_from_their_list_once(spark):
    """Not for every notice, by patterns."""
    rejected = spark.sql("SELECT 'm' AS message_id, 's' AS notice_subject, 't' AS notice_text UNION ALL SELECT 'x', NULL, NULL")
    for addresses, want in (("a@x, b@x", ("a@x", ["b@x"], True)), ("a@x", ("a@x", None, True)), (None, (None, None, False)), (" ,b", (None, ["b"], False))):
        df = rejects.notices(rejected, addresses)
        assert [(r.recipient, r.cc, r.sendable) for r in df.collect()] == [want]
        assert "transform(" not in df._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
