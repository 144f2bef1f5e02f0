"""Chat formatting: typed content parts flattened into one training string per conversation.

A message's content is a list of typed parts. A visitor has one method per part type; it turns a
text into its escaped form and an image, audio or document into a numbered placeholder with an
attachment reference and the number of tokens the placeholder will expand to. Everything is built
from column functions.

Template, per turn: ``<turn:ROLE>CONTENT</turn>`` and a line feed. Every control string starts
with ``<``, and escaped texts hold no ``<``: ``\\`` becomes ``\\0`` and ``<`` becomes ``\\1`` (in a
role also ``>`` becomes ``\\2``), so the output can be cut at ``</turn>`` and read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

HEAD, HEAD_END, TAIL = "<turn:", ">", "</turn>\n"

PART_TYPE = (
    "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)
_LENGTH = "struct<skip:bigint,keep:bigint>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\1"), F.lit("<")), F.lit("\\0"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\2"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\2"), F.lit(">")))


@dataclass(frozen=True)
class PartVisitor:
    """Renders each part type; the rates say how many tokens a placeholder expands to."""

    patch: int = 14
    audio_tokens_per_second: int = 25
    tokens_per_page: int = 256

    def text(self, part: Column, at: Column) -> Column:
        words = F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"))
        return self._rendered(escape(F.coalesce(part["text"], F.lit(""))), words, F.lit(True))

    def image(self, part: Column, at: Column) -> Column:
        across = F.ceil(F.coalesce(part["width"], F.lit(0)) / self.patch)
        down = F.ceil(F.coalesce(part["height"], F.lit(0)) / self.patch)
        return self._rendered(self._placeholder("image", at), across * down, F.lit(False))

    def audio(self, part: Column, at: Column) -> Column:
        tokens = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_tokens_per_second)
        return self._rendered(self._placeholder("audio", at), tokens, F.lit(False))

    def document(self, part: Column, at: Column) -> Column:
        tokens = F.coalesce(part["pages"], F.lit(0)) * self.tokens_per_page
        return self._rendered(self._placeholder("document", at), tokens, F.lit(False))

    def other(self, part: Column, at: Column) -> Column:
        return self._rendered(self._placeholder("other", at), F.lit(0), F.lit(False))

    def visit(self, part: Column, at: Column) -> Column:
        return (
            F.when(part["kind"] == "text", self.text(part, at))
            .when(part["kind"] == "image", self.image(part, at))
            .when(part["kind"] == "audio", self.audio(part, at))
            .when(part["kind"] == "document", self.document(part, at))
            .otherwise(self.other(part, at))
        )

    @staticmethod
    def _placeholder(kind: str, at: Column) -> Column:
        return F.concat(F.lit(f"<{kind}:"), at.cast("string"), F.lit(">"))

    @staticmethod
    def _rendered(shown: Column, tokens: Column, is_text: Column) -> Column:
        return F.struct(shown.alias("shown"), tokens.cast("long").alias("tokens"), is_text.alias("is_text"))


def text_parts(text: Column) -> Column:
    """A plain text as a content of one text part."""
    part = F.struct(
        F.lit("text").alias("kind"),
        text.alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


def format_conversations(
    messages: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    visitor: PartVisitor | None = None,
    loss_roles: tuple[str, ...] = ("assistant",),
    turns_per_piece: int = 64,
) -> DataFrame:
    """One row per conversation: key, n_turns, formatted, loss, attachments, n_tokens.

    ``content`` is a string or a list of parts (``PART_TYPE``). ``loss`` has, per turn, runs of
    (characters to skip, characters to keep) over the formatted turn; kept are the text parts of
    the roles in ``loss_roles``. ``attachments`` lists (turn number from 0, part, kind, ref, tokens).

    Rows are ordered by (turn, role, content), so ties and repeated rows have a fixed place; NULL
    turns come first. A NULL text, role or content is empty, a NULL key is a conversation of its
    own, unknown part kinds become ``<other:N>``. Other columns are ignored. An empty input gives
    an empty result. A long conversation is sorted and rendered in pieces of ``turns_per_piece``
    turn numbers by many tasks; only finished pieces meet in its one output row.
    """
    visitor = visitor or PartVisitor()
    is_list = isinstance(messages.schema[content].dataType, ArrayType)
    parts = F.col(f"`{content}`")
    parts = parts.cast(PART_TYPE) if is_list else text_parts(parts.cast("string"))
    rows = messages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(parts, F.array().cast(PART_TYPE)).alias("parts"),
    )
    seen = F.transform("parts", lambda p, i: visitor.visit(p, i))
    head = F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(HEAD_END))
    bears_loss = F.col("role").isin(*loss_roles)
    runs = F.concat(
        F.array(_run(F.length(head), F.lit(0))),
        F.transform(
            "seen",
            lambda p: F.when(bears_loss & p["is_text"], _run(F.lit(0), F.length(p["shown"]))).otherwise(
                _run(F.length(p["shown"]), F.lit(0))
            ),
        ),
        F.array(_run(F.lit(len(TAIL)), F.lit(0))),
    )
    attachments = F.filter(
        F.transform(
            F.arrays_zip("parts", "seen"),
            lambda z, i: F.struct(
                i.alias("part"),
                z["parts"]["kind"].alias("kind"),
                z["parts"]["ref"].alias("ref"),
                z["seen"]["tokens"].alias("tokens"),
                z["seen"]["is_text"].alias("is_text"),
            ),
        ),
        lambda a: ~a["is_text"],
    )
    body = F.array_join(F.transform("seen", lambda p: p["shown"]), "")
    turns = rows.withColumn("seen", seen).select(
        "key",
        F.floor(F.col("turn") / turns_per_piece).alias("piece"),
        F.struct(
            "turn",
            "role",
            F.concat(head, body, F.lit(TAIL)).alias("shown"),
            runs.alias("runs"),
            attachments.alias("attached"),
            F.aggregate("seen", F.lit(0).cast("long"), lambda n, p: n + p["tokens"]).alias("tokens"),
        ).alias("t"),
    )
    pieces = (
        turns.groupBy("key", "piece")
        .agg(F.sort_array(F.collect_list("t")).alias("ts"))
        .select(
            "key",
            F.struct(
                "piece",
                F.array_join(F.transform("ts", lambda t: t["shown"]), "").alias("shown"),
                F.transform("ts", lambda t: t["runs"]).alias("loss"),
                F.transform("ts", lambda t: t["attached"]).alias("attached"),
                F.aggregate("ts", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
            ).alias("p"),
        )
    )
    whole = pieces.groupBy("key").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    of_turn = F.flatten(F.transform("ps", lambda p: p["attached"]))
    return whole.select(
        F.col("key").alias(key),
        F.size(F.flatten(F.transform("ps", lambda p: p["loss"]))).cast("long").alias("n_turns"),
        F.array_join(F.transform("ps", lambda p: p["shown"]), "").alias("formatted"),
        F.flatten(F.transform("ps", lambda p: p["loss"])).alias("loss"),
        F.flatten(
            F.transform(
                of_turn,
                lambda list_, n: F.transform(
                    list_,
                    lambda a: F.struct(
                        n.alias("turn"),
                        a["part"].alias("part"),
                        a["kind"].alias("kind"),
                        a["ref"].alias("ref"),
                        a["tokens"].alias("tokens"),
                    ),
                ),
            )
        ).alias("attachments"),
        F.aggregate("ps", F.lit(0).cast("long"), lambda n, p: n + p["tokens"]).alias("n_tokens"),
    )


def _run(skip: Column, keep: Column) -> Column:
    return F.struct(skip.cast("long").alias("skip"), keep.cast("long").alias("keep"))


def read_back(formatted: Column, loss: Column) -> Column:
    """The turns of a formatted conversation: a list of (role, text, loss_text), unescaped."""
    cut = F.split(formatted, TAIL.strip() + "\n", -1)
    whole_turns = F.transform(F.slice(cut, 1, F.size(cut) - 1), lambda t: F.concat(t, F.lit(TAIL)))

    def parsed(pair: Column) -> Column:
        shown = pair["shown"]
        head_end = F.instr(shown, HEAD_END)
        role = F.substring(shown, F.lit(len(HEAD) + 1), head_end - len(HEAD) - 1)
        body = F.substring(shown, head_end + 1, F.length(shown) - head_end - len(TAIL))
        kept = F.aggregate(
            pair["loss"],
            F.struct(F.lit(1).cast("long").alias("at"), F.lit("").alias("text")),
            lambda acc, r: F.struct(
                (acc["at"] + r["skip"] + r["keep"]).alias("at"),
                F.concat(
                    acc["text"],
                    F.substring(shown, (acc["at"] + r["skip"]).cast("int"), r["keep"].cast("int")),
                ).alias("text"),
            ),
        )["text"]
        return F.struct(
            unescape_role(role).alias("role"), unescape(body).alias("text"), unescape(kept).alias("loss_text")
        )

    zipped = F.arrays_zip(whole_turns.alias("shown"), loss.alias("loss"))
    return F.transform(zipped, parsed)
