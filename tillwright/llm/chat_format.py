"""Conversations with typed content parts as one training text each, with DataFrame functions only (operator 13).

A turn's content is a list of parts: text, images, audio and documents. A visitor with one method a
kind flattens them, in order: text is escaped, any other part becomes a numbered placeholder, and its
reference and the number of tokens that it stands for are recorded. The parts of a conversation are
joined behind marks for its turns, and a loss mask names the spans of the assistant's text.

    <s>[ROLE]user[/ROLE]What is [IMAGE 0]?</s>[ROLE]assistant[/ROLE]A cat.</s>

Control strings inside texts and roles are told apart by backslashes behind their first character, one
more than they had: ``</s>`` in a text is ``<\\/s>`` in the output, and ``<\\/s>`` is ``<\\\\/s>``. So no
text holds a control string, and one backslash less gives the text back.

A conversation is one record: its parts meet in one task, sorted on disk if need be, and the text is
one value of at most 2 GB, as any of Spark's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, ROLE, ROLE_END = "<s>", "</s>", "[ROLE]", "[/ROLE]"
# Control strings without backslashes; those of other chat templates are kept out of texts too.
_PLAIN = r"<(\\*)(/?s>)", r"\[(\\*)(/?(?:INST|ROLE|SYS)\]|(?:IMAGE|AUDIO|DOCUMENT) [0-9]+\])"
_QUOTED = tuple(pattern.replace(r"(\\*)", r"\\(\\*)", 1) for pattern in _PLAIN)
LEARNED_ROLE = "assistant"

PARTS = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"


def escaped(text: Column) -> Column:
    """The text without control strings; ``unescaped`` gives it back."""
    for pattern, first in zip(_PLAIN, "<[", strict=True):
        text = F.regexp_replace(text, pattern, rf"{first}\\$1$2")
    return text


def unescaped(text: Column) -> Column:
    for pattern, first in zip(_QUOTED, "<[", strict=True):
        text = F.regexp_replace(text, pattern, f"{first}$1$2")
    return text


class Visitor:
    """How each kind of part is shown and how many tokens it stands for; subclass for another model.

    Every method takes the part as a struct column. ``placeholder`` is the word of its mark.
    """

    patch_pixels = 28
    audio_tokens_a_second = 25.0
    page_tokens = 768
    placeholders = {"image": "IMAGE", "audio": "AUDIO", "document": "DOCUMENT"}

    def text(self, part: Column) -> Column:
        return escaped(F.coalesce(part["text"], F.lit("")))

    def attachment(self, word: str, number: Column) -> Column:
        return F.concat(F.lit(f"[{word} "), number.cast("string"), F.lit("]"))

    def image_tokens(self, part: Column) -> Column:
        """One token a patch, at least one row and column of them."""

        def patches(side: str) -> Column:
            return F.greatest(F.lit(1), F.ceil(F.coalesce(part[side], F.lit(0)) / self.patch_pixels))

        return patches("width") * patches("height")

    def audio_tokens(self, part: Column) -> Column:
        seconds = F.coalesce(part["seconds"], F.lit(0.0))
        # An unknown or impossible length is one token.
        known = (seconds > 0) & (seconds < 1e9)
        return F.when(known, F.ceil(seconds * self.audio_tokens_a_second)).otherwise(F.lit(1))

    def document_tokens(self, part: Column) -> Column:
        return F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(0))) * self.page_tokens

    def visit(self, part: Column, number: Column) -> Column:
        """struct<shown, tokens, is_text> of a part; ``number`` is its place among the attachments.

        A part without a kind, or of a kind without a method, is shown as its text.
        """
        shown, tokens, is_text = self.text(part), F.lit(0).cast("long"), F.lit(True)
        for kind, word in self.placeholders.items():
            mine = F.lower(part["kind"]).eqNullSafe(F.lit(kind))
            shown = F.when(mine, self.attachment(word, number)).otherwise(shown)
            tokens = F.when(mine, getattr(self, f"{kind}_tokens")(part).cast("long")).otherwise(tokens)
            is_text = F.when(mine, F.lit(False)).otherwise(is_text)
        return F.struct(shown.alias("shown"), tokens.alias("tokens"), is_text.alias("is_text"))

    def is_attachment(self, part: Column) -> Column:
        return F.coalesce(F.lower(part["kind"]).isin(list(self.placeholders)), F.lit(False))


def text_parts(text: Column) -> Column:
    """A turn that is text alone as a list of one part."""
    fields = (F.lit("text"), text.cast("string"), *[F.lit(None)] * 5)
    return F.array(F.struct(*fields)).cast(PARTS)


def format_chats(turns: DataFrame, visitor: Visitor | None = None, learned: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, and ``parts`` or else ``text``).

    Columns: conv_id, formatted, loss (spans of the text under the loss mask, as byte offsets of the UTF-8 output:
    array of struct<from, to>), attachments (array of struct<number, kind, uri, tokens>), n_turns, n_tokens (of attachments).

    Rows go by turn; without a turn last, and rows of one turn by role, then by a hash of their parts. Repeated rows are
    turns of their own. A null text or role is an empty one, a turn without parts has an empty text. A row
    without a conv_id is a conversation of its own. Other columns are ignored; no rows give no rows.
    """
    visitor = visitor or Visitor()
    parts = F.col("parts").cast(PARTS) if "parts" in turns.columns else text_parts(F.col("text"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        parts.alias("parts"),
    )
    # Rows are told apart by the numbers of one run only; they decide nothing but which of equal rows comes first.
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_alone", F.when(F.col("conv_id").isNull(), F.col("_row")))
    order = [F.asc_nulls_last("turn"), F.asc("role"), F.asc("_mark"), F.asc("_row"), F.asc("_at")]
    full = F.when(F.size("parts") > 0, F.col("parts")).otherwise(text_parts(F.lit(None)))
    rows = rows.withColumns({"parts": full, "_mark": F.xxhash64("parts"), "_n": F.greatest(F.lit(1), F.size("parts"))})
    each = rows.select("*", F.posexplode("parts").alias("_at", "_part")).drop("parts")

    conversation = Window.partitionBy("conv_id", "_alone").orderBy(*order)
    before = conversation.rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(visitor.is_attachment(F.col("_part")).cast("long")).over(before), F.lit(0))
    each = each.withColumn("_number", number).withColumn("_seen", visitor.visit(F.col("_part"), F.col("_number")))
    opened = F.concat(F.lit(ROLE), escaped(F.col("role")), F.lit(ROLE_END))
    first, last = F.col("_at") == 0, F.col("_at") == F.col("_n") - 1
    each = each.withColumns({"_head": F.when(first, opened).otherwise(F.lit("")), "_tail": F.when(last, F.lit(END)).otherwise(F.lit(""))})
    each = each.withColumn("_piece", F.concat("_head", "_seen.shown", "_tail"))
    start = F.coalesce(F.sum(F.octet_length("_piece")).over(before), F.lit(0)) + len(START) + F.octet_length("_head")
    under_loss = (F.col("role") == learned) & F.col("_seen.is_text") & (F.octet_length("_seen.shown") > 0)
    each = each.withColumns({"_rank": F.row_number().over(conversation), "_start": start.cast("long"), "_learned": under_loss})
    span = F.struct(F.col("_start").alias("from"), (F.col("_start") + F.octet_length("_seen.shown")).alias("to"))
    attached = F.struct(
        F.col("_number").alias("number"), F.lower("_part.kind").alias("kind"), F.col("_part.uri").alias("uri"), F.col("_seen.tokens").alias("tokens")
    )
    entry = F.struct("_rank", "_piece", F.when(F.col("_learned"), span).alias("span"), F.when(~F.col("_seen.is_text"), attached).alias("attached"))
    chats = each.groupBy("conv_id", "_alone").agg(
        F.array_sort(F.collect_list(entry)).alias("_all"),
        F.sum(F.col("_at").eqNullSafe(F.lit(0)).cast("long")).alias("n_turns"),
        F.sum("_seen.tokens").alias("n_tokens"),
    )

    def present(field: str) -> Column:
        return F.filter(F.transform("_all", lambda x: x[field]), lambda x: x.isNotNull())

    return chats.select(
        "conv_id",
        F.concat(F.lit(START), F.array_join(F.transform("_all", lambda x: x["_piece"]), "")).alias("formatted"),
        present("span").alias("loss"),
        present("attached").alias("attachments"),
        "n_turns",
        "n_tokens",
    )


_TURN = r"(?s)\[ROLE\](.*?)\[/ROLE\](.*?)</s>"


def read_back(formatted: Column) -> Column:
    """The turns in a formatted text: array of struct<role, text>, unescaped; placeholders stay as they are."""
    roles, texts = (F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(group)) for group in (1, 2))
    return F.transform(F.arrays_zip(roles.alias("role"), texts.alias("text")), lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(t["text"]).alias("text")))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, one span after the other."""
    # The text goes along with each span by reference, so that it is turned into bytes once.
    content = F.array_repeat(formatted.cast("binary"), F.size(loss))

    def cut(span: Column) -> Column:
        part = F.substring(span["content"], (span["loss"]["from"] + 1).cast("int"), (span["loss"]["to"] - span["loss"]["from"]).cast("int"))
        return unescaped(part.cast("string"))

    return F.array_join(F.transform(F.arrays_zip(loss.alias("loss"), content.alias("content")), cut), "")


def digest(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted texts."""
    read = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
