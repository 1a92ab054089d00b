"""Chat formatting of typed content parts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The control strings of the template.
OPEN, CLOSE = "[INST]", "[/INST]"
BEGIN, END = "<s>", "</s>"
CONTROLS = (BEGIN, END, OPEN, CLOSE, "[IMG]", "[AUD]", "[DOC]")

PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
TRAINED_ROLE = "assistant"

# A control string, or what an escape makes of one: backslashes after its first letter.
INNER = "/?s>|/?INST\\]|IMG\\]|AUD\\]|DOC\\]"


def escape(text: Column) -> Column:
    """Puts a backslash after the first letter of every control string, and of those that have some already.

    No control string is left, and ``unescape`` gives the text back exactly. As
    control strings begin with < or [ and have neither letter again, none can
    arise where an escaped text meets a marker.
    """
    return F.regexp_replace(text, rf"([<\[])(\\*(?:{INNER}))", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*(?:{INNER}))", "$1$2")


class PartVisitor:
    """What each type of part becomes: its piece of the text, its attachment, its tokens beyond that text.

    A subclass may change how many tokens an attachment expands to.
    """

    patch = 14  # pixels of the side of an image token
    seconds_per_token = 0.04
    tokens_per_page = 512

    def text(self, part: Column) -> tuple[Column, Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(None).cast("string"), F.lit(0).cast("long")

    def image(self, part: Column) -> tuple[Column, Column, Column]:
        side = lambda c: F.ceil(F.coalesce(part[c], F.lit(0)) / self.patch)
        return F.lit("[IMG]"), part["ref"], (side("width") * side("height")).cast("long")

    def audio(self, part: Column) -> tuple[Column, Column, Column]:
        return F.lit("[AUD]"), part["ref"], F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) / self.seconds_per_token).cast("long")

    def document(self, part: Column) -> tuple[Column, Column, Column]:
        return F.lit("[DOC]"), part["ref"], (F.coalesce(part["pages"], F.lit(0)) * self.tokens_per_page).cast("long")

    def visit(self, part: Column) -> Column:
        """struct<piece, ref, kind, tokens> of a part; one of an unknown type counts as text."""
        out = None
        for kind, (piece, ref, tokens) in (
            ("image", self.image(part)), ("audio", self.audio(part)), ("document", self.document(part)), ("text", self.text(part)),
        ):
            made = F.struct(piece.alias("piece"), ref.alias("ref"), F.lit(kind).alias("kind"), tokens.alias("tokens"))
            if kind == "text":
                return out.otherwise(made)
            out = (F.when if out is None else out.when)(F.coalesce(part["type"] == kind, F.lit(False)), made)
        raise AssertionError


def _turns(messages: DataFrame, conv: str, turn: str, role: str, parts: str, visitor: PartVisitor) -> DataFrame:
    """One row for each conversation: its messages in order, each part visited."""
    visited = F.transform(F.coalesce(F.col(parts), F.array()), visitor.visit)
    flat = messages.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        visited.alias("parts"),
    )
    body = F.array_join(F.transform("parts", lambda p: p["piece"]), "")
    one = F.struct("turn", "role", body.alias("body"), "parts")
    return flat.select("conv", one.alias("m")).groupBy("conv").agg(F.sort_array(F.collect_list("m")).alias("turns"))


def header(role: Column) -> Column:
    """Role names are written as in a URL, so they hold no marker, blank or line break."""
    return F.concat(F.lit(OPEN + " "), F.url_encode(role), F.lit(" " + CLOSE + " "))


def format_parts(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    visitor: PartVisitor | None = None,
) -> DataFrame:
    """conv, formatted, loss_spans, attachments, n_placeholder_tokens of each conversation.

    ``parts`` is array<struct> with at least the fields of PART. Each turn is
    ``[INST] role [/INST] body</s>``, the whole preceded by ``<s>``; a body is its
    parts in order, texts escaped, attachments as placeholders. attachments lists
    (turn index, kind, ref, tokens) in the order of the placeholders, loss_spans
    the [from, to) code points of assistant bodies, n_placeholder_tokens the sum of
    tokens that placeholders expand to.

    A conversation is one training example and so one row: its turns meet in one
    task, nothing else does. Turns are in order of ``turn``; equal and null turn
    numbers (nulls first) go by role and body, so the result does not depend on
    the order of rows; repeated rows are repeated turns. Null roles and texts are
    empty; null parts are none; a null conversation id is an id of its own; a part
    of unknown type is text. Other columns are not looked at; an empty table gives
    an empty table.
    """
    rows = _turns(messages, conv, turn, role, parts, visitor or PartVisitor())
    head = lambda t: header(t["role"])
    text = F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["body"], F.lit(END))), ""))
    step = lambda a, t: F.struct(
        (a["at"] + F.length(head(t)) + F.length(t["body"]) + len(END)).alias("at"),
        F.when(
            t["role"] == TRAINED_ROLE,
            F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(head(t))).alias("from"), (a["at"] + F.length(head(t)) + F.length(t["body"])).alias("to")))),
        ).otherwise(a["spans"]).alias("spans"),
    )
    start = F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"))
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                F.filter(t["parts"], lambda p: p["kind"] != "text"),
                lambda p: F.struct(i.alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
            ),
        )
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return rows.select(
        F.col("conv").alias(conv), text.alias("formatted"), F.aggregate("turns", start, step)["spans"].alias("loss_spans"), attached.alias("attachments")
    ).withColumn("n_placeholder_tokens", total)


def format_conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``format_parts`` for messages of one plain text each."""
    part = F.struct(
        F.lit("text").alias("type"), F.col(text).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return format_parts(messages.select(conv, turn, role, F.array(part).alias("__parts")), conv, turn, role, "__parts")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, texts unescaped, placeholders as they stand."""
    inner = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    turns = F.filter(F.split(inner, f"(?<={END})"), lambda t: t != "")
    mark = F.lit(" " + CLOSE + " ")

    def parsed(turn: Column) -> Column:
        at = F.locate(" " + CLOSE + " ", turn)
        role = F.substring(turn, F.lit(len(OPEN) + 2), at - len(OPEN) - 2)
        begin = at + F.length(mark)
        body = F.substring(turn, begin, F.length(turn) - begin + 1 - len(END))
        return F.struct(F.url_decode(role).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, parsed)


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from ``format_parts``' output."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["from"] + 1, s["to"] - s["from"])))
    read = formatted.select(conv, "formatted", read_back(F.col("formatted")).alias("turns"), F.array_join(masked, "").alias("loss"))
    return read.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
