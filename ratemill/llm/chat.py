"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context,
and its reply as the only text a loss is taken on. A turn reads

    ### <role>: <text></turn>

and a line feed. Inside roles and texts a backslash, the two control strings and
(in roles) a colon are written as two-character codes that start with a backslash,
so a control string never appears in them and reading back is plain replacement.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, CLOSE = "### ", "</turn>"
REPLY = "assistant"
#: Fixed values of the format: what is written as a code, the backslash first.
TEXT_CODES = (("\\", "\\b"), (OPEN, "\\h"), (CLOSE, "\\e"))
ROLE_CODES = (*TEXT_CODES, (":", "\\c"))


def escape(text: Column, codes=TEXT_CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes=TEXT_CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role, ROLE_CODES), F.lit(": "))


def format_examples(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turn_number, formatted, loss_start, loss_end), one row per example.

    ``formatted`` holds a conversation up to and with one reply; the loss mask is
    its code points from ``loss_start`` (from 0) up to ``loss_end``, the escaped
    text of that reply. Turns after the last reply, or a conversation without one,
    get a last row whose loss positions are null, so that the output holds every
    turn. Turns go by turn (null first), ties by role and text; repeated rows stay.
    A null text or role is empty, a null conv_id a conversation like any other, an
    empty table gives no rows, and other columns do not matter.

    Turns are numbered, and lengths added up, by windows, which spill; the turns up to a
    reply are joined to one piece first. Examples come out one at a time, each as the
    pieces up to its own, so no row holds more than its example and a task no more than
    the pieces of one conversation. An example longer than a string of 2 GB fails.
    """
    filled = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    is_reply = F.col("role") == REPLY
    numbered = filled.select(
        "conv_id",
        F.row_number().over(in_order).alias("turn_number"),
        # Replies before a turn: those with the same number end in the same example.
        F.coalesce(F.count_if(is_reply).over(before), F.lit(0)).alias("example"),
        is_reply.alias("is_reply"),
        _header(F.col("role")).alias("header"),
        escape(F.col("text")).alias("escaped"),
    )
    piece = F.concat("header", "escaped", F.lit(CLOSE + "\n"))
    of_reply = F.when(F.col("is_reply"), F.char_length("escaped"))
    pieces = (
        numbered.groupBy("conv_id", "example")
        .agg(
            F.sort_array(F.collect_list(F.struct("turn_number", piece.alias("piece")))).alias("turns"),
            F.max("turn_number").alias("turn_number"),
            F.max(of_reply).cast("long").alias("reply_chars"),
        )
        .select("conv_id", "example", "turn_number", "reply_chars", F.array_join("turns.piece", "").alias("piece"))
    )
    so_far = Window.partitionBy("conv_id").orderBy("example").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.char_length("piece")).over(so_far) - len(CLOSE + "\n")
    return pieces.select(
        "conv_id",
        "turn_number",
        F.array_join(F.collect_list("piece").over(so_far), "").alias("formatted"),
        F.when(F.col("reply_chars").isNotNull(), (end - F.col("reply_chars")).cast("int")).alias("loss_start"),
        F.when(F.col("reply_chars").isNotNull(), end.cast("int")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) that ``formatted`` holds."""
    parts = F.split(formatted, f"{CLOSE}\n", -1)

    def turn(part: Column) -> Column:
        colon = F.instr(part, ":")
        return F.struct(
            unescape(F.substring(part, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1), ROLE_CODES).alias("role"),
            unescape(F.substring(part, colon + 2, F.char_length(part))).alias("text"),
        )

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The unescaped text under a loss mask; null without one."""
    return unescape(F.substring(formatted, start + 1, end - start))


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation: its turns, its loss text, the length of its output."""
    loss = read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    return (
        examples.select("conv_id", "turn_number", "formatted", loss.alias("loss"))
        .groupBy("conv_id")
        .agg(
            F.max_by("formatted", "turn_number").alias("longest"),
            F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("turn_number", "loss")))).alias("losses"),
            F.sum(F.char_length("formatted")).alias("formatted_chars"),
        )
        .select(
            "conv_id",
            read_turns(F.col("longest")).alias("turns"),
            F.array_join(F.col("losses")["loss"], "").alias("loss"),
            "formatted_chars",
        )
    )
