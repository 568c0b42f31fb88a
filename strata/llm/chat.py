"""Chat formatting: fold logged chat events into final messages and render them for training.

Only DataFrame functions run here. A conversation comes out as one row, so its final text must fit a row; its log need
not fit memory, because windows over a conversation sort with spilling and each message is put together on its own.

Events have the columns ``conv_id, seq, turn, kind, role, text``, and a kind of

* ``message``: opens the message of a turn, or replaces it,
* ``delta``: adds text to it,
* ``edit``: replaces its text,
* ``regenerate``: drops its text and every later turn; its own text, if any, is the beginning of the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

KINDS = ("message", "delta", "edit", "regenerate")

START, END = "<|im_start|>", "<|im_end|>\n"

# What reads as a control string of a common chat template: <s> </s> <|name|> <<SYS>> [INST] and their like. One
# backslash more behind the first character makes it plain text, and takes part in no other control string.
_REST = r"(/?s>|</?SYS>>|/?INST\]|\|[A-Za-z0-9_]+\|>)"
_CONTROL = r"([<\[])(\\*)" + _REST
_ESCAPED = r"([<\[])\\(\\*)" + _REST


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, turn, role, text`` of an event log.

    Events of a conversation apply in order of ``seq``; ties go by turn, kind, role and text. The role of a message is
    the last one given. NULL text and role are empty, a NULL kind is ``message``, an unknown kind raises. NULL ids are
    one conversation, a NULL turn is one turn before all others. A row logged twice counts twice. Other columns are
    ignored; an empty log has no messages.
    """
    kind = F.coalesce("kind", F.lit("message"))
    log = events.select(
        "conv_id", "seq", F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("turn"),
        F.when(kind.isin(*KINDS), kind).otherwise(
            F.raise_error(F.concat(F.lit("unknown kind of event: "), kind))).alias("kind"),
        "role", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("seq", "turn", "kind", "role", "text")]
    placed = log.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    after = Window.partitionBy("conv_id").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(after)
    alive = placed.withColumn("cut", cut).where("cut is null or cut >= turn")
    after_in_turn = (Window.partitionBy("conv_id", "turn").orderBy(F.desc("place"))
                     .rowsBetween(Window.unboundedPreceding, -1))
    reset = F.max(F.col("kind") != "delta").over(after_in_turn)
    # A regenerated message keeps its role but none of the text before.
    part = F.when(F.coalesce(F.col("reset"), F.lit(False)), None).otherwise(F.struct("place", "text"))
    said = alive.withColumn("reset", reset).groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("place"))).alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"]), "").alias("text"))
    return said.select(
        "conv_id", F.when(F.col("turn") != -(1 << 63), F.col("turn")).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), "text")


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, spans``.

    A message becomes a start mark, its role, a line feed, its text with control strings escaped, and an end mark.
    ``spans`` lists for each turn where its text begins and how long it is, in characters of ``formatted``, and whether
    it is under the loss mask, which holds texts with the role ``learn_from``. Roles are percent-encoded in the marks.
    Messages with equal turns go by role and text; NULL role and text are empty. No messages, no rows.
    """
    head = F.concat(F.lit(START), F.url_encode(F.coalesce("role", F.lit(""))), F.lit("\n"))
    pieces = messages.select(
        "conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("_role"),
        head.alias("_head"), escape(F.coalesce("text", F.lit(""))).alias("_body"))
    order = Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("_turn", "_role", "_body")])
    width = F.char_length("_head") + F.char_length("_body") + len(END)
    before = F.sum(width.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = pieces.select(
        "conv_id", F.row_number().over(order).alias("place"), F.concat("_head", "_body", F.lit(END)).alias("piece"),
        F.struct((F.coalesce(before, F.lit(0)) + F.char_length("_head")).alias("start"),
                 F.char_length("_body").cast("long").alias("length"),
                 (F.col("_role") == learn_from).alias("loss")).alias("span"))
    turns = F.array_sort(F.collect_list(F.struct("place", "piece", "span")))
    return (placed.groupBy("conv_id").agg(turns.alias("turns"))
            .select("conv_id", F.array_join("turns.piece", "").alias("formatted"), F.col("turns.span").alias("spans")))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``role, text``: the inverse of ``render``."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        skip = F.char_length(role) + 1
        body = F.substring(piece, skip + 1, F.char_length(piece) - skip - len(END))
        return F.struct(F.url_decode(role).alias("role"), unescape(body).alias("text"))

    marks = F.split(formatted, START.replace("|", r"\|"), -1)
    return F.transform(F.slice(marks, 2, F.greatest(F.size(marks) - 1, F.lit(0))), turn)
