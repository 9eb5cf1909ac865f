"""Chat formatting: logged snapshots of conversations that go on elsewhere are collapsed.

A chat log keeps a conversation again after every turn, so that most logged conversations are a
prefix of a longer one. Every turn has a rolling hash of the turns up to it: the exclusive-or
of position-salted turn hashes, twice 64 bits. A conversation is dropped by an anti-join if its
last hash is an earlier turn's hash of another one; of equal conversations the one with the
smallest id stays. Only what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faturaflow.llm.common import checkpointed

#: Turn numbers of a part, within which positions and hashes are summed up, and turns of a block.
PART, BLOCK = 256, 256
#: Fixed values of the rendered form: what stands around a role and after a text.
HEAD, MIDDLE, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"


def _prefix(name: str, keys: list[str], order: list[Column], fold) -> Column:
    window = W.partitionBy(*keys).orderBy(*order)
    return fold(name).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))


def _before(name: str, keys: list[str], order: list[Column], fold) -> Column:
    window = W.partitionBy(*keys).orderBy(*order)
    total = fold(name).over(window.rowsBetween(W.unboundedPreceding, -1))
    return F.coalesce(total, F.lit(0).cast("long"))


def positions(turns: DataFrame) -> DataFrame:
    """(conv, role, text, part, at, rest): the place of every turn in its conversation, from 1.

    A prefix sum over parts of PART turn numbers and within them, so that a conversation with
    any number of turns is not brought into one task. Turns with one number come in the order
    of role and text; null numbers come first.
    """
    rows = turns.select(
        F.struct(F.col("conv_id").cast("long").alias("id")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / PART), F.lit(-(1 << 62))))
    sizes = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("first", _before("n", ["conv"], [F.col("part")], F.sum))
    order = W.partitionBy("conv", "part").orderBy("turn", "role", "text")
    rows = rows.withColumn("local", F.row_number().over(order))
    placed = rows.join(sizes.drop("n"), ["conv", "part"])
    return placed.withColumn("at", F.col("first") + F.col("local")).drop("first", "local", "turn")


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """(conv, at, a, b, last): the rolling hash of the turns up to each one."""
    turn = placed.select(
        "conv",
        "part",
        "at",
        F.xxhash64("at", "role", "text").alias("x"),
        F.xxhash64(F.lit(7), "text", "at", "role").alias("y"),
    )
    parts = turn.groupBy("conv", "part").agg(
        F.bit_xor("x").alias("px"), F.bit_xor("y").alias("py"), F.max("at").alias("end")
    )
    by = [F.col("part")]
    parts = parts.select(
        "conv",
        "part",
        _before("px", ["conv"], by, F.bit_xor).alias("bx"),
        _before("py", ["conv"], by, F.bit_xor).alias("by"),
        F.max("end").over(W.partitionBy("conv")).alias("size"),
    )
    rolled = turn.select(
        "conv",
        "part",
        "at",
        _prefix("x", ["conv", "part"], [F.col("at")], F.bit_xor).alias("x"),
        _prefix("y", ["conv", "part"], [F.col("at")], F.bit_xor).alias("y"),
    )
    joined = rolled.join(parts, ["conv", "part"])
    return joined.select(
        "conv",
        "at",
        F.col("x").bitwiseXOR(F.col("bx")).alias("a"),
        F.col("y").bitwiseXOR(F.col("by")).alias("b"),
        (F.col("at") == F.col("size")).alias("last"),
    )


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv, n_turns, copies) of the conversations that are no prefix of a longer one."""
    key = ["at", "a", "b"]
    # One conversation for each sequence of turns, reduced in every task before the shuffle.
    whole = hashes.filter("last").groupBy(*key).agg(
        F.min_by("conv", F.struct(F.col("conv.id").isNull(), F.col("conv.id"))).alias("conv"),
        F.count(F.lit(1)).alias("copies"),
    )
    longer = hashes.filter(~F.col("last")).select(*key).distinct()
    kept = whole.join(longer, key, "left_anti")
    return kept.select("conv", F.col("at").alias("n_turns"), "copies")


def rendered(turn_role: Column, turn_text: Column) -> Column:
    return F.concat(F.lit(HEAD), turn_role, F.lit(MIDDLE), turn_text, F.lit(TAIL))


def collapse(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, n_turns, copies, block, text): the maximal conversations, rendered.

    A conversation is one row for every `block` turns, in order from block 0, so that no value
    grows without bound; the whole text is its blocks joined. copies says how many logged
    conversations have the same turns. Null roles and texts are empty, and count as equal to
    empty ones; rows with a null conv_id are one conversation; a row repeated within a
    conversation is a turn of its own. An empty table gives an empty result.
    """
    placed = checkpointed(positions(turns))
    kept = maximal(prefix_hashes(placed))
    rows = placed.join(kept, "conv").withColumn("block", F.floor((F.col("at") - 1) / block))
    turn = F.struct("at", rendered(F.col("role"), F.col("text")).alias("text"))
    blocks = rows.groupBy("conv", "n_turns", "copies", "block").agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    return blocks.select(
        F.col("conv.id").alias("conv_id"),
        "n_turns",
        "copies",
        "block",
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("text"),
    )


def op1_chat(conversations: DataFrame) -> DataFrame:
    """One row per block of 256 turns of each maximal conversation."""
    return collapse(conversations.select("conv_id", "turn", "role", "text"))


SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER w AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, ''))),
h AS (SELECT *, md5(length(role) || ':' || role || text) AS h,
             pos = max(pos) OVER (PARTITION BY conv_id) AS is_last FROM t),
p AS (SELECT *, md5(string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS prefix FROM h),
k AS (SELECT min(conv_id) AS conv_id, pos AS n_turns, count(*) AS copies, prefix
      FROM p WHERE is_last GROUP BY pos, prefix),
m AS (SELECT conv_id, n_turns, copies FROM k
      WHERE NOT EXISTS (SELECT 1 FROM p WHERE NOT p.is_last AND p.pos = k.n_turns AND p.prefix = k.prefix))
SELECT m.conv_id, m.n_turns, m.copies, (t.pos - 1) // 256 AS block,
       string_agg('<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10), ''
                  ORDER BY t.pos) AS text
FROM m JOIN t ON t.conv_id IS NOT DISTINCT FROM m.conv_id
GROUP BY ALL
"""
