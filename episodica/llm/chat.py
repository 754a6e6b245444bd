"""Chat formatting with typed content parts; DataFrame functions only.

A message's content is a list of parts (text, image, audio, document). A visitor flattens it to one string: texts are
escaped, every other part becomes a numbered placeholder, and its reference and the tokens it expands to are recorded.

Edge cases: null text, role or content counts as empty; an unknown kind becomes a placeholder of no tokens; messages
with the same turn are ordered by role, then content; repeated rows stay; rows without a conversation id form one
conversation with a null id; an empty table gives no conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"


@dataclass(frozen=True)
class Expansion:
    """Tokens that a part expands to."""

    image_patch: int = 14
    audio_per_second: float = 25.0
    document_per_page: int = 576
    chars_per_token: int = 4


def escape(text: Column) -> Column:
    r"""Text without control strings: ``\`` becomes ``\b``, then ``<|`` becomes ``\l|``.

    Texts that are joined afterwards also lose a ``<`` at their end (``\l``), see ``flatten_content``.
    """
    slashed = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    return F.replace(slashed, F.lit("<|"), F.lit("\\l|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    empty = {name: F.lit(None).cast(kind) for name, kind in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(c.alias(n) for n, c in empty.items())))


def _expands_to(part: Column, rule: Expansion) -> Column:
    patches = F.ceil(part["width"] / rule.image_patch) * F.ceil(part["height"] / rule.image_patch)
    return F.coalesce(
        F.when(part["kind"] == "text", F.ceil(F.length(part["text"]) / rule.chars_per_token))
        .when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * rule.audio_per_second))
        .when(part["kind"] == "document", part["pages"] * rule.document_per_page)
        .cast("long"),
        F.lit(0).cast("long"),
    )


def flatten_content(parts: Column, rule: Expansion = Expansion()) -> Column:
    """struct<body, attachments, tokens> of a content list; attachments are numbered by their place among all parts."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    kind = lambda p: F.coalesce(p["kind"], F.lit("unknown"))
    # A text's last "<" would begin a control string with the parts that follow.
    open_end = lambda t: F.when(F.endswith(t, F.lit("<")), F.concat(F.substr(t, F.lit(1), F.length(t) - 1), F.lit("\\l"))).otherwise(t)
    inner = lambda p, i: F.when(i < F.size(parts) - 1, open_end(escape(p["text"]))).otherwise(escape(p["text"]))
    visit = lambda p, i: F.when(kind(p) == "text", inner(p, i)).otherwise(
        F.concat(F.lit("<|"), F.replace(escape(kind(p)), F.lit("|"), F.lit("/")), F.lit(":"), i.cast("string"), F.lit("|>"))
    )
    record = lambda p, i: F.struct(
        i.cast("int").alias("part"), kind(p).alias("kind"), p["ref"].alias("ref"), _expands_to(p, rule).alias("tokens")
    )
    return F.struct(
        F.array_join(F.transform(parts, visit), "").alias("body"),
        F.filter(F.transform(parts, record), lambda a: a["kind"] != "text").alias("attachments"),
        F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + _expands_to(p, rule)).alias("tokens"),
    )


def format_chats(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "content",
    trained_role: str = "assistant",
    rule: Expansion = Expansion(),
) -> DataFrame:
    """One row per conversation: its text, the spans under the loss mask (code points), attachments, token count.

    ``content`` is an array of PART. Offsets are running sums in the conversation's order, so the work grows with its
    length, and one shuffle on the conversation serves both the sums and the grouping.
    """
    rows = messages.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        flatten_content(F.col(content), rule).alias("flat"),
    )
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS))
    rows = rows.select(
        "conv_id", "turn", "role", F.col("flat.body").alias("body"), F.col("flat.attachments").alias("attachments"),
        F.col("flat.tokens").alias("tokens"), head.alias("head"),
    )
    size = F.length("head") + F.length("body") + len(END)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "body")
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "start", F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size
    )
    said = F.struct(
        "place",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(
            F.col("role") == trained_role,
            F.struct((F.col("start") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")),
        ).alias("span"),
        F.transform(
            "attachments", lambda a: F.struct(F.col("place").alias("message"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))
        ).alias("attachments"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("said"), F.sum("tokens").alias("n_tokens"))
    return grouped.select(
        "conv_id",
        F.array_join(F.col("said.piece"), "").alias("text"),
        F.filter(F.col("said.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.col("said.attachments")).alias("attachments"),
        "n_tokens",
    )


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation; placeholders stay in the text."""
    pieces = F.split(text, "<\\|end\\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head, body = F.split(piece, "<\\|says\\|>")[0], F.split(piece, "<\\|says\\|>")[1]
        return F.struct(unescape(F.substr(head, F.lit(len(TURN) + 1))).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_spans(text: Column, spans: Column) -> Column:
    """The unescaped text under each span."""
    return F.transform(spans, lambda s: unescape(F.substr(text, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
