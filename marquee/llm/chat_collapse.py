"""Chat formatting after collapsing cumulative snapshots.

Loggers store a conversation again after every turn, so most logged ones are prefixes of longer ones.
A rolling hash of each prefix of turns finds them: a conversation whose whole hash is a prefix hash of a
longer one is dropped by an anti-join, equal ones keep the smallest id, and only maximal conversations
are rendered.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise

# Turns are numbered and hashed in blocks of their turn value, so that one conversation with a large
# share of all rows is spread over tasks; a rendered part holds as many turns.
BLOCK_TURNS = 1024
# The marks of the chat format.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
DEFAULT_ROLE = "user"


def turn_hashes(position: Column, role: Column, text: Column) -> list[Column]:
    """Two hashes of a turn at its place; null and empty differ."""
    parts = [position, role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit(""))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (17, 91)]


def prefixes(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Stored ``(conv_id, position, role, text, p1, p2)``: each turn with the hashes of the prefix it ends.

    Turns are ordered by ``turn`` (null first), role and text, and numbered from 1; rows that are equal in
    all four columns are one turn.  Rows without a conversation id belong to none and are left out.  Other
    columns are not read.
    """
    rows = chats.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ).where("conv_id IS NOT NULL").distinct()
    blocked = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))))
    sizes = blocked.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    placed = blocked.join(offsets, ["conv_id", "block"]).withColumn("position", F.col("before") + F.row_number().over(inside))
    h1, h2 = turn_hashes(F.col("position"), F.col("role"), F.col("text"))
    # The prefix hash is the xor of its turns' hashes; each covers its place, so order counts.
    to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.withColumns({"h1": h1, "h2": h2}).withColumns({
        "i1": F.bit_xor("h1").over(to_here), "i2": F.bit_xor("h2").over(to_here),
    })
    stored = materialise(rolled.select("conv_id", "block", "position", "role", "text", "i1", "i2", "h1", "h2"), "turns")
    blocks = stored.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    carried = blocks.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(b).over(earlier), F.lit(0)).alias(c) for b, c in (("b1", "c1"), ("b2", "c2"))
    ])
    return stored.join(carried, ["conv_id", "block"]).select(
        "conv_id", "position", "role", "text", F.col("i1").bitwiseXOR(F.col("c1")).alias("p1"), F.col("i2").bitwiseXOR(F.col("c2")).alias("p2")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of the conversations that no longer one begins with.

    ``turns`` are prefixes.  Equal conversations are counted and the smallest id stays.  Prefix hashes are
    counted before they are joined, so a first turn that a third of the conversations share is one row.
    """
    prefix = F.struct("position", "p1", "p2")
    size = turns.groupBy("conv_id").agg(F.max(prefix).alias("whole"))
    whole = size.groupBy("whole").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    # A conversation goes on after a prefix that more conversations pass than end at.
    passed = turns.groupBy(prefix.alias("whole")).agg(F.count("*").alias("n_pass"))
    longer = passed.join(whole, "whole").where("n_pass > n_copies").select("whole")
    return whole.join(longer, "whole", "left_anti").select("conv_id", F.col("whole.position").alias("n_turns"), "n_copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn in chat format; a null role is the user's, a null text is empty."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit(DEFAULT_ROLE)), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def format_chats(chats: DataFrame, **columns: str) -> DataFrame:
    """``(conv_id, part, n_turns, n_copies, chat)``: maximal conversations in chat format.

    A conversation of up to 1,024 turns is one row; of a longer one each row holds the next 1,024 turns,
    and the rows in order of ``part`` make up the whole, so that no group is unbounded.
    """
    turns = materialise(prefixes(chats, **columns), "prefixes")
    kept = maximal(turns)
    lines = turns.join(kept, "conv_id").select(
        "conv_id", "n_turns", "n_copies", F.floor((F.col("position") - 1) / BLOCK_TURNS).alias("part"), "position",
        rendered(F.col("role"), F.col("text")).alias("line"),
    )
    gathered = lines.groupBy("conv_id", "n_turns", "n_copies", "part").agg(F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"))
    return gathered.select("conv_id", "part", "n_turns", "n_copies", F.array_join(F.col("lines.line"), "").alias("chat"))
