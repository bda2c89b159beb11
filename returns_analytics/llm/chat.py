"""Chat formatting: typed content parts flattened into one training text per conversation.

Only DataFrame functions are used. A message holds a list of parts; a visitor has one method per
kind of part and turns each into template text. Attachments become placeholders in their order,
their references and expanded token counts are recorded beside the text.

Defined results: a null text, role or list of parts counts as empty; a part of unknown kind is
visited as text; turns with equal numbers are ordered by role, then text; repeated messages stay;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"

PART = "struct<kind:string,text:string,ref:string,units:int>"


def escape(text: Column) -> Column:
    """Text without control strings; ``unescape`` gives it back."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


class PartVisitor:
    """How each kind of part is written. ``tokens`` gives the tokens one unit expands to."""

    def __init__(self, image: int = 256, audio: int = 25, document: int = 512) -> None:
        self.tokens = {"image": image, "audio": audio, "document": document}

    def text(self, part: Column) -> Column:
        return escape(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        return F.lit("<|image|>")

    def audio(self, part: Column) -> Column:
        return F.lit("<|audio|>")

    def document(self, part: Column) -> Column:
        """A document keeps its title readable behind the placeholder."""
        return F.concat(F.lit("<|document|>"), self.text(part))

    def visit(self, part: Column) -> Column:
        kinds = F.when(part["kind"] == "image", self.image(part)).when(part["kind"] == "audio", self.audio(part))
        return kinds.when(part["kind"] == "document", self.document(part)).otherwise(self.text(part))

    def is_attachment(self, part: Column) -> Column:
        return F.coalesce(part["kind"].isin(*self.tokens), F.lit(False))

    def attachment(self, part: Column) -> Column:
        """Kind, reference and expanded tokens (a missing unit count is one unit)."""
        per_unit = F.create_map(*(F.lit(x) for pair in self.tokens.items() for x in pair))
        units = F.coalesce(part["units"], F.lit(1)).cast("long")
        return F.struct(
            part["kind"].alias("kind"), part["ref"].alias("ref"), (units * per_unit[part["kind"]]).alias("tokens")
        )


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(
        F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                 F.lit(None).cast("int").alias("units"))
    )


def format_chat(messages: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens.

    messages: conv_id, turn, role, parts (a list of ``PART``). loss_spans are the start (from 0) and
    length, in code points, of the assistants' bodies: the loss mask. A conversation is one output
    row, so its messages meet in one task; offsets come from a running sum over the same exchange.
    """
    visitor = visitor or PartVisitor()
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    written = messages.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(parts, visitor.visit), "").alias("body"),
        F.transform(F.filter(parts, visitor.is_attachment), visitor.attachment).alias("attached"),
    )
    pieces = written.select(
        "*", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    size = F.char_length("head") + F.char_length("body") + len(END) + 1
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select(
        "conv_id",
        F.struct(
            before.cast("long").alias("at"),
            F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
            (F.col("role") == "assistant").alias("loss"),
            (before + F.char_length("head")).cast("long").alias("start"),
            F.char_length("body").cast("long").alias("length"),
            "attached",
        ).alias("t"),
    )
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["loss"]),
        lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
    )
    attachments = F.flatten(F.transform("turns", lambda t: t["attached"]))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn, read back from a formatted text (placeholders stay in the text)."""
    pieces = F.slice(
        F.split(formatted, r"<\|im_end\|>\n"), 1, F.size(F.split(formatted, r"<\|im_end\|>\n")) - 1
    )

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substr(piece, F.char_length(role) + len(START) + 2)).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )


def digest(conversations: DataFrame) -> DataFrame:
    """Formats plain conversations and reads the output back; one row per conversation."""
    parted = conversations.select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))
    formatted = format_chat(parted)
    read = formatted.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("read_turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss_text"),
    )
    whole = F.array_join(
        F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
