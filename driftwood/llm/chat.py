"""Chat formatting with Spark expressions only.

The rows of a conversation are collected as (turn, role, text) structs and sorted, adjacent
turns of one role are merged into a block by array expressions, and the blocks are
concatenated:

    <|turn|>ROLE<|text|>TEXT<|part|>TEXT ...<|end|>\\n

Every marker starts with ``<|``.  Roles and texts are escaped so that ``<|`` can't occur in
them: ``~`` becomes ``~0`` and ``<|`` becomes ``<~1``; undoing the second and then the first
restores any string.  ``<|part|>`` keeps the merged turns apart, so that ``parse_chat`` gives
back every turn.

``pieces`` holds the same string cut at the markers, with the loss mask per piece: true for
the texts of the role ``assistant`` alone, never for markers or roles.

One shuffle by conversation.  A conversation is one output string, so its rows meet in one
task by nature; the array steps are linear in its turns.

Defined results: null texts and roles are empty; ties of ``turn`` are ordered by role, then
text (repeated rows all stay); null turns come first; rows with a null conversation id form
one conversation; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import null_as_empty, pick

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>\n"


def escape(c) -> F.Column:
    return F.replace(F.replace(c, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1"))


def unescape(c) -> F.Column:
    return F.replace(F.replace(c, F.lit("<~1"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``pieces``, an array of (piece, loss)."""
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).select(
        "conv_id", F.struct("turn", null_as_empty(F.col("role")).alias("role"), null_as_empty(F.col("text")).alias("text")).alias("t"))
    sorted_turns = F.sort_array(F.collect_list("t"))  # ties by role and text as they are, then escaped
    convs = rows.groupBy("conv_id").agg(sorted_turns.alias("turns")).select("conv_id", F.transform(
        "turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"))
    # Where a block starts: the first turn, and every turn whose role differs from the one before.
    roles = convs.select("*", F.transform("turns", lambda t: t["role"]).alias("roles"))
    pairs = F.zip_with("roles", F.concat(F.array(F.lit(None).cast("string")), F.slice("roles", F.lit(1), F.size("roles") - 1)),
                       lambda now, before: ~F.equal_null(now, before))
    starts = F.filter(F.transform(pairs, lambda new, i: F.when(new, i)), lambda i: i.isNotNull())
    blocks = roles.select("conv_id", "turns", starts.alias("starts"))
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("turns")))
    merged = blocks.select("conv_id", F.zip_with("starts", ends, lambda a, b: F.slice("turns", a + 1, b - a)).alias("blocks"))

    def pieces(block):
        role = F.element_at(block, 1)["role"]
        loss = role == F.lit(loss_role)
        texts = F.flatten(F.transform(block, lambda t, i: F.array(
            F.struct(F.when(i == 0, F.lit(TEXT)).otherwise(F.lit(PART)).alias("piece"), F.lit(False).alias("loss")),
            F.struct(t["text"].alias("piece"), loss.alias("loss")))))
        head = F.array(F.struct(F.lit(TURN).alias("piece"), F.lit(False).alias("loss")),
                       F.struct(role.alias("piece"), F.lit(False).alias("loss")))
        return F.concat(head, texts, F.array(F.struct(F.lit(END).alias("piece"), F.lit(False).alias("loss"))))

    cut = merged.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    return cut.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "pieces")


def parse_chat(formatted) -> F.Column:
    """The turns of a formatted string: an array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|turn\|>"), lambda _, i: i > 0)

    def cut(block):
        body = F.split(F.regexp_replace(block, r"<\|end\|>\n\z", ""), r"<\|text\|>")
        return F.struct(F.element_at(body, 1).alias("role"), F.split(F.element_at(body, 2), r"<\|part\|>").alias("parts"))

    def turns(block):
        return F.transform(block["parts"], lambda t: F.struct(unescape(block["role"]).alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(F.transform(blocks, cut), turns))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from ``format_chat``: turns from the string, loss text from the mask."""
    back = formatted.select(
        "conv_id", parse_chat(F.col("formatted")).alias("turns"), F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.array_join(F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: unescape(p["piece"])), "").alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
