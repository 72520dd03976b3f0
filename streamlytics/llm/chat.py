"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted. Neighbouring turns of one role are merged into a block
by an array aggregation (a fold over slices of ``SLICE`` turns, so that its cost stays linear), blocks are wrapped in the
marks of their role, and all is concatenated. In texts, ``<`` or ``[`` before the rest of a mark gets a backslash behind
it, and one more where backslashes stand there already, so that :func:`read_back` finds exactly the turns that went in.

Conversations of more than ``LONG`` turns are dealt over the tasks by ranges of their order, equal turns are counted
first, and only one formatted part for each task is gathered, so no task holds the rows of a hot conversation.

``<s>`` opens a conversation. Blocks: ``<<SYS>>..<</SYS>>`` (system), ``[INST]..[/INST]`` (user), ``[ANS]..</s>``
(assistant) and ``[ROLE]name[:]..[/ROLE]`` (any other role); ``[NEXT]`` stands between the texts of a block. The loss
mask covers the texts of the assistant, without marks.

Defined results: a null role or text is the empty one. Turns with equal or null numbers go by (turn, role, text), null
first, and repeated rows are repeated turns. Rows without a conversation id are one conversation. Other columns, whatever
their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize

SLICE = 64  # turns folded at once
LONG = 4096  # turns of a conversation that are collected by one task

# Fixed marks of the template.
BEGIN, NEXT, NAMED = "<s>", "[NEXT]", "[:]"
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]")

# A mark's first character, backslashes, and the rest of a mark.
_MARK = r"([<\[])%s((?:/?s>)|(?:</?SYS>>)|(?:/?(?:INST|ROLE)\])|(?:(?:ANS|NEXT|:)\]))"
ESCAPE, UNESCAPE = _MARK % r"(\\*)", _MARK % r"\\(\\*)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit(r"$1$2$3"))


def _by_role(role: Column, side: int, other: Column) -> Column:
    known = F.when(role == "system", MARKS["system"][side])
    for name in ("user", "assistant"):
        known = known.when(role == name, MARKS[name][side])
    return known.otherwise(other)


def _open(role: Column) -> Column:
    return _by_role(role, 0, F.concat(F.lit(OTHER[0]), escaped(role), F.lit(NAMED)))


def _close(role: Column) -> Column:
    return _by_role(role, 1, F.lit(OTHER[1]))


def _glue(before: Column, role: Column) -> Column:
    """What stands between a text of one role and a text of the next."""
    return F.when(before == role, NEXT).otherwise(F.concat(_close(before), _open(role)))


def _folded(turns: Column) -> Column:
    """The piece of a few sorted turns: its first and last role, its text without the outer marks, and the loss spans."""
    empty = F.expr("named_struct('last', CAST(NULL AS STRING), 'chars', 0, 'parts', CAST(array() AS array<string>), "
                   "'loss', CAST(array() AS array<struct<start: int, chars: int>>))")

    def add(made: Column, turn: Column) -> Column:
        text = escaped(turn["text"])
        glue = F.when(made["last"].isNull(), "").otherwise(_glue(made["last"], turn["role"]))
        start = made["chars"] + F.length(glue)
        span = F.array(F.struct(start.alias("start"), F.length(text).alias("chars")))
        return F.struct(
            turn["role"].alias("last"), (start + F.length(text)).alias("chars"),
            F.concat(made["parts"], F.array(glue, text)).alias("parts"),
            F.when(turn["role"] == "assistant", F.concat(made["loss"], span)).otherwise(made["loss"]).alias("loss"))

    return F.aggregate(turns, empty, add, lambda made: F.struct(
        F.get(turns, F.lit(0))["role"].alias("first"), made["last"].alias("last"),
        F.array_join(made["parts"], "").alias("body"), made["loss"].alias("loss")))


def _joined(df: DataFrame, pieces: str) -> DataFrame:
    """Columns ``first``, ``last``, ``body`` and ``loss`` of all pieces of a row in order."""
    array = F.col(pieces)

    def glue(piece: Column, i: Column) -> Column:
        return F.when(i == 0, "").otherwise(_glue(F.get(array, i - 1)["last"], piece["first"]))

    df = df.withColumn("glues", F.transform(array, glue))
    df = df.withColumn("sizes", F.zip_with("glues", array, lambda g, p: F.length(g) + F.length(p["body"])))
    at = F.transform(array, lambda p, i: F.aggregate(F.slice("sizes", 1, i), F.lit(0), lambda a, b: a + b))
    df = df.withColumn("at", F.zip_with(at, "glues", lambda a, g: a + F.length(g)))
    loss = F.flatten(F.zip_with(array, "at", lambda p, a: F.transform(p["loss"], lambda s: F.struct(
        (s["start"] + a).alias("start"), s["chars"].alias("chars")))))
    body = F.array_join(F.zip_with("glues", array, lambda g, p: F.concat(g, p["body"])), "")
    return df.select(
        "*", F.get(array, F.lit(0))["first"].alias("first"), F.element_at(array, -1)["last"].alias("last"),
        body.alias("body"), loss.alias("loss")).drop("glues", "sizes", "at", pieces)


def _pieces(rows: DataFrame, *keys: str) -> DataFrame:
    """The piece of all turns of a key, from rows of ``(turn, role, text, n)``."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "n")))
    one_by_one = F.flatten(F.transform("counted", lambda t: F.array_repeat(
        F.struct(t["role"].alias("role"), t["text"].alias("text")), t["n"].cast("int"))))
    df = rows.groupBy(*keys).agg(turns.alias("counted"))
    df = df.withColumn("turns", one_by_one).drop("counted")
    parts = F.transform(F.sequence(F.lit(1), F.size("turns"), F.lit(SLICE)), lambda i: F.slice("turns", i, SLICE))
    return _joined(df.withColumn("slices", parts).drop("turns").withColumn(
        "pieces", F.transform("slices", _folded)).drop("slices"), "pieces")


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """``(conv_id, formatted, loss array<struct<start, chars>>)`` for each conversation: its text, and the spans (in
    code points) of the assistant's texts in it."""
    rows = df.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = materialize(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > LONG).drop("n"), "long-conversations")
    one = F.lit(1).cast("bigint").alias("n")
    if long.isEmpty():
        made = _pieces(rows.select("*", one), "conv_id")
    else:
        same = F.expr("r.conv_id <=> l.conv_id")
        short = rows.alias("r").join(long.alias("l"), same, "left_anti").select("*", one)
        counted = rows.alias("r").join(long.alias("l"), same, "left_semi").groupBy(
            "conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
        dealt = materialize(counted, "long-turns").repartitionByRange(
            "conv_id", "turn", "role", "text").withColumn("place", F.spark_partition_id())
        pieces = materialize(_pieces(dealt, "conv_id", "place"), "long-pieces")
        gathered = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(
            F.struct("place", "first", "last", "body", "loss"))).alias("pieces"))
        made = _pieces(short, "conv_id").unionByName(_joined(gathered, "pieces"))
    head = F.concat(F.lit(BEGIN), _open(F.col("first")))
    return made.withColumn("head", head).select(
        "conv_id", F.concat("head", "body", _close(F.col("last"))).alias("formatted"),
        F.transform("loss", lambda s: F.struct(
            (s["start"] + F.length("head")).alias("start"), s["chars"].alias("chars"))).alias("loss"))


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>``: the turns of a formatted conversation."""
    closing = "|".join(rf"\Q{c}\E" for _, c in (*MARKS.values(), OTHER))
    blocks = F.filter(F.split(F.substr(formatted, F.lit(len(BEGIN) + 1)), rf"(?<={closing})", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.when(F.startswith(block, F.lit(MARKS["system"][0])), "system")
        for name in ("user", "assistant"):
            role = role.when(F.startswith(block, F.lit(MARKS[name][0])), name)
        named = F.length(F.substring_index(block, NAMED, 1))
        other = unescaped(F.substr(block, F.lit(len(OTHER[0]) + 1), named - len(OTHER[0])))
        role = role.otherwise(other)
        opening = F.when(role.isin(*MARKS), F.length(_open(role))).otherwise(named + len(NAMED))
        body = F.substr(block, opening + 1, F.length(block) - opening - F.length(_close(role)))
        return F.transform(F.split(body, r"\Q" + NEXT + r"\E", -1), lambda t: F.struct(
            role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["chars"]))), "")
