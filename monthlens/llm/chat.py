"""Chat formatting with Spark expressions only.

The rows of a conversation are collected as structs and sorted by turn; adjacent turns of one
role share one block. A block is ``<|im_start|>role``, a newline, its turns with ``<|im_sep|>``
between them, and ``<|im_end|>`` with a newline. ``<|`` and backslashes of texts and roles (and
newlines of roles) are escaped, so a marker in a text never reads as one, and the output can be
read back.

Defined cases: a null text or role is empty; turns with the same number are ordered by role, then
text; a null turn number comes first; repeated rows are turns of their own; a null ``conv_id`` is
a conversation; an empty table gives no rows; other columns of the input are ignored. A
conversation becomes one string and must fit into one row, as its output does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """No ``<|`` is left; every backslash of the result is followed by ``b`` or ``l``."""
    return F.replace(
        F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l")
    )


def unescape(text: Column) -> Column:
    return F.replace(
        F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\b"), F.lit("\\")
    )


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def format_chats(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and its loss mask.

    ``loss_runs`` is the mask as run lengths in code points: pieces of ``formatted`` in order,
    each with ``loss`` true where it is text of ``loss_role``.
    """
    turns = rows.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(turn: Column, i: Column) -> Column:
        # get() is null beyond the ends, so the first and last turns open and close a block
        opens = ~F.get("turns", i - 1)["role"].eqNullSafe(turn["role"])
        closes = ~F.get("turns", i + 1)["role"].eqNullSafe(turn["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(START), _escape_role(turn["role"]), F.lit("\n")))
            .otherwise(F.lit(SEP))
            .alias("before"),
            escape(turn["text"]).alias("text"),
            F.when(closes, F.lit(END + "\n")).otherwise(F.lit("")).alias("after"),
            (turn["role"] == loss_role).alias("loss"),
        )

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    runs = F.flatten(
        F.transform(
            "pieces",
            lambda p: F.array(
                F.struct(F.length(p["before"]).alias("n"), F.lit(False).alias("loss")),
                F.struct(F.length(p["text"]).alias("n"), p["loss"].alias("loss")),
                F.struct(F.length(p["after"]).alias("n"), F.lit(False).alias("loss")),
            ),
        )
    )
    whole = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), ""
    )
    return pieces.select("conv_id", whole.alias("formatted"), runs.alias("loss_runs"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)

    def turns(block: Column) -> Column:
        role = _unescape_role(F.substring_index(block, "\n", 1))
        body = F.regexp_replace(F.regexp_replace(block, r"\A[^\n]*\n", ""), r"<\|im_end\|>\n\z", "")
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def digests(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Counts and digests of the turns and of the text under the loss mask, read back."""
    turns = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    loss = F.array_join(
        F.transform(
            F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"]
        ),
        "",
    )
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
