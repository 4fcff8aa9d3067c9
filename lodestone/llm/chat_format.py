"""Chat formatting as relational plans: Spark expressions only, no Python on the executors.

A conversation becomes one string of blocks::

    <|role|>\\nfirst text<|+|>second text<|end|>\\n

Adjacent turns of one role share a block; ``<|+|>`` keeps their boundary, so that the turns can be read back. Inside
roles and texts ``\\``, ``<`` and ``>`` are written ``\\e``, ``\\l`` and ``\\g``. No control string can therefore occur inside
a text, whatever it says, and ``unescape`` gives back exactly what went in. Beside the string stands the loss mask: one
flag for each block; what lies between the header and the end mark of a flagged block is trained on, separators aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Control strings of the template, and the escapes, in the order in which unescape() undoes them.
OPEN, CLOSE, PART, END = "<|", "|>\n", "<|+|>", "<|end|>\n"
ESCAPES = (("<", "\\l"), (">", "\\g"), ("\\", "\\e"))


def escape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per conversation: conv_id, formatted string, loss_mask array<boolean>.

    Turns stand in the order of ``turn``; ties (repeated rows) in the order of role and text, and each is kept. Null
    texts and roles count as empty ones, null turns come first, null conv_ids form one conversation. An empty table
    gives no rows. Other columns, whatever their names, are not looked at.

    Runs of one role are numbered with a window, merged by array aggregation, and the blocks are merged again: both
    steps use the one partitioning by conv_id, and windows and aggregations spill. The two levels keep the arrays
    small where a conversation has very many turns.
    """
    rows = turns.select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"),
        F.coalesce(F.col("role"), F.lit("")).alias("r"), F.coalesce(F.col("text"), F.lit("")).alias("x"),
    )
    order = W.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), "r", "x")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("new", (F.lag("r").over(order).isNull() | (F.lag("r").over(order) != F.col("r"))).cast("long"))
    rows = rows.withColumn("b", F.sum("new").over(W.partitionBy("c").orderBy("n").rowsBetween(W.unboundedPreceding, 0)))
    texts = F.array_sort(F.collect_list(F.struct("n", escape(F.col("x")).alias("x"))))
    blocks = rows.groupBy("c", "b").agg(F.first("r").alias("r"), F.array_join(F.transform(texts, lambda s: s["x"]), PART).alias("x"))
    one = F.concat(F.lit(OPEN), escape(F.col("r")), F.lit(CLOSE), F.col("x"), F.lit(END))
    conv = blocks.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("b", one.alias("x"), F.col("r").isin(*loss_roles).alias("loss")))).alias("s"))
    return conv.select(
        F.col("c").alias("conv_id"), F.array_join(F.transform("s", lambda s: s["x"]), "").alias("formatted"), F.transform("s", lambda s: s["loss"]).alias("loss_mask")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses formatted conversations: conv_id, turns array<struct<role, text>>, loss_text (all text under the mask), formatted, loss_mask."""
    blocks = F.split(F.col("formatted"), "<\\|end\\|>\n")
    parsed = F.transform(
        F.slice(blocks, 1, F.size(blocks) - 1),
        lambda b: F.struct(
            unescape(F.substring_index(F.substring(b, 3, 2**31 - 1), CLOSE, 1)).alias("role"),
            F.transform(F.split(F.substring(b, F.locate(CLOSE, b) + len(CLOSE), F.length(b)), "<\\|\\+\\|>"), unescape).alias("texts"),
        ),
    )
    return formatted.withColumn("blocks", parsed).select(
        "conv_id", "formatted", "loss_mask",
        F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), t.alias("text"))))).alias("turns"),
        F.array_join(F.flatten(F.transform(F.filter("blocks", lambda b, i: F.col("loss_mask")[i]), lambda b: b["texts"])), "").alias("loss_text"),
    )
