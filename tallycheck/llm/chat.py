"""Chat formatting of typed content parts.

A message holds parts of the types text, image, audio and document. A visitor
turns each into text: a text part is escaped, an attachment becomes numbered
placeholders in order, and its reference and expanded token count are recorded.
The template then marks the turns::

    <|im_start|>role\\n  content  <|im_end|>\\n

A placeholder is ``<|image:2|>``: the second attachment of its message. Control
strings inside texts are escaped reversibly (``~`` to ``~0``, ``<|`` to
``<~1|``, and in roles a line break to ``~2``), so a text can never open or close
a turn or spell a placeholder. ``loss`` lists the spans (code points, end exclusive)
of the assistant's content; :func:`read_back` recovers turns, their texts and
placeholders, and the loss text from the string.

Defined results: a null text or role counts as empty, a null part list too, an
unknown part type as text; turns are ordered by turn number, nulls first, ties
by role and content, and repeated rows stay repeated turns; a row without a
conversation id is a conversation of its own; an empty table gives an empty result;
other columns are ignored. A conversation is one output string, so its turns
meet in one row; nothing larger is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1|"))


def unescaped(text: Column) -> Column:
    """What :func:`escaped` hid, and the marks between parts, undone."""
    opened = F.replace(F.replace(text, F.lit("<~1|"), F.lit("<|")), F.lit("~2"), F.lit(""))
    return F.replace(opened, F.lit("~0"), F.lit("~"))


class PartVisitor:
    """One method a part type; each gives the part's text. ``tokens_per_unit``:
    tokens an image tile, audio second or document page expands to."""

    def __init__(self, image: int = 256, audio: int = 25, document: int = 512):
        self.tokens_per_unit = {"image": image, "audio": audio, "document": document}

    def visit_text(self, part: Column) -> Column:
        return escaped(F.coalesce(part["text"], F.lit("")))

    def visit_attachment(self, part: Column, number: Column) -> Column:
        return F.concat(F.lit("<|"), part["type"], F.lit(":"), number.cast("string"), F.lit("|>"))

    def is_attachment(self, part: Column) -> Column:
        return F.coalesce(part["type"].isin(*self.tokens_per_unit), F.lit(False))

    def visit(self, part: Column, number: Column) -> Column:
        return F.when(self.is_attachment(part), self.visit_attachment(part, number)).otherwise(self.visit_text(part))

    def flatten(self, parts: Column) -> Column:
        """The parts' texts in a row. A part that ends in ``<`` gets a mark before the
        next one, which could go on with ``|`` and so make a control string of two parts."""
        def joined(part: Column, at: Column) -> Column:
            text = self.visit(part, F.size(F.filter(F.slice(parts, 1, at + 1), self.is_attachment)))
            return F.when(text.endswith("<") & (at < F.size(parts) - 1), F.concat(text, F.lit("~2"))).otherwise(text)

        return F.concat_ws("", F.transform(parts, joined))

    def attachments(self, parts: Column) -> Column:
        """In the order of their numbers: type, reference and tokens they expand to."""
        def record(p: Column) -> Column:
            per = F.lit(0)
            for kind, n in self.tokens_per_unit.items():
                per = F.when(p["type"] == kind, F.lit(n)).otherwise(per)
            return F.struct(p["type"].alias("type"), p["ref"].alias("ref"),
                            (F.coalesce(p["units"], F.lit(1)) * per).cast("long").alias("tokens"))

        return F.transform(F.filter(parts, self.is_attachment), record)


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null.cast("string").alias("ref"),
                            null.cast("bigint").alias("units")))


def format_chats(messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", visitor: PartVisitor | None = None,
                 loss_role: str = "assistant") -> DataFrame:
    """A row per conversation: conv_id, ``formatted``, ``loss`` (array of start
    and end) and ``attachments`` (turn index, number, type, ref, tokens, in order)."""
    visitor = visitor or PartVisitor()
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    role = F.replace(escaped(F.coalesce(F.col(role_col).cast("string"), F.lit(""))), F.lit("\n"), F.lit("~2"))
    alone = F.when(F.col(conv_col).isNull(), F.monotonically_increasing_id())
    turns = messages.select(
        F.col(conv_col).alias("conv_id"), alone.alias("alone"), F.col(turn_col).alias("turn"), role.alias("role"),
        visitor.flatten(parts).alias("content"), visitor.attachments(parts).alias("attached"))
    whole = turns.groupBy("conv_id", "alone").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "content", "attached"))).alias("turns"))
    head = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"))
    pieces = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(head(t), t["content"], F.lit(f"{END}\n"))).alias("piece"),
        F.transform("turns", lambda t: F.struct(
            (t["role"] == loss_role).alias("loss"), F.length(head(t)).alias("head"),
            F.length(t["content"]).alias("n"))).alias("size"),
        F.flatten(F.transform("turns", lambda t, i: F.transform(t["attached"], lambda a, k: F.struct(
            i.cast("long").alias("turn"), (k + 1).alias("number"), a["type"].alias("type"), a["ref"].alias("ref"),
            a["tokens"].alias("tokens"))))).alias("attachments"))
    tail = len(END) + 1
    span = "struct<start:bigint,end:bigint>"
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    walk = F.aggregate(
        "size", none,
        lambda acc, s: F.struct(
            (acc["at"] + s["head"] + s["n"] + tail).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + s["head"]).alias("start"), (acc["at"] + s["head"] + s["n"]).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return pieces.select("conv_id", F.concat_ws("", "piece").alias("formatted"), walk.alias("loss"), "attachments")


def read_back(chats: DataFrame) -> DataFrame:
    """From ``formatted`` and ``loss`` alone: conv_id, ``turns`` (role, text;
    placeholders stay as they are), ``parts`` (per turn a list of ``placeholder``,
    null for texts, and ``text``, null for placeholders; neighbouring texts are one,
    empty ones left out), ``loss_text`` and the formatted string."""
    cut = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda x: x.startswith(START))
    content = lambda x: F.substring(x, F.instr(x, F.lit("\n")) + 1, F.length(x))
    turn = F.transform(cut, lambda x: F.struct(
        unescaped(F.replace(F.substring_index(F.substring(x, len(START) + 1, 2**31 - 1), "\n", 1),
                            F.lit("~2"), F.lit("\n"))).alias("role"),
        unescaped(content(x)).alias("text")))

    def pieces(chunk: Column) -> Column:
        """A chunk may open with a placeholder: no text has ``<|`` unescaped."""
        mark = F.regexp_extract(chunk, r"^<\|[^|]*\|>", 0)
        text = unescaped(F.substring(chunk, F.length(mark) + 1, F.length(chunk)))
        null = F.lit(None).cast("string")
        found = F.array(F.struct(mark.alias("placeholder"), null.alias("text")), F.struct(null.alias("placeholder"), text.alias("text")))
        return F.filter(found, lambda p: F.coalesce(p["placeholder"], p["text"]) != "")

    parts = F.transform(cut, lambda x: F.flatten(F.transform(F.split(content(x), r"(?=<\|)", -1), pieces)))
    loss = F.concat_ws("", F.transform("loss", lambda s: F.substring(
        "formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return chats.select("conv_id", "formatted", turn.alias("turns"), parts.alias("parts"), unescaped(loss).alias("loss_text"))
