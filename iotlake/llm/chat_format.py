"""Chat formatting of turns with typed content parts; DataFrame functions only.

A turn's content is an array of parts (`PART`): text, image, audio or document. A visitor turns each part into what
stands in the formatted text, a text as itself and an attachment as a placeholder, and into an attachment
record (kind, reference, number of tokens that the placeholder expands to). The n-th placeholder of a conversation belongs to
its n-th attachment record.

A turn reads `<|turn|>role<|text|>content<|end|>`. Every mark starts with `<`, as do other templates' marks, or with `[`.
Roles and texts have these two characters and the escape character replaced one by one, so that no mark, and none of the
usual control strings such as `</s>` or `[/INST]`, can come from them, also not across neighbouring parts; `unescaped` undoes it.

The loss mask is a list of spans (start, length) of code points of the formatted text: the content of each assistant turn.

Defined results: turns are ordered by turn, role and content, nulls first, and repeated rows stay; a null role or text
is empty; null or no parts are empty content; a part of unknown or null kind counts as text; missing sizes expand to no
tokens; rows without conv_id can't be put together, each is a conversation of its own; an empty table gives no
conversation. Other columns are ignored. A conversation is one row, so it has to fit a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Replaced in this order, and back in the reverse order.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))


def escaped(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), ESCAPES, F.coalesce(text, F.lit("")))


def unescaped(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0])), reversed(ESCAPES), text)


def text_parts(text: Column) -> Column:
    """Plain text as a content of one part."""
    missing = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            *[F.lit(None).cast(kind).alias(name) for name, kind in missing.items()]))


class Visitor:
    """What a part of each kind becomes; a subclass can change a kind or the token rates."""

    def __init__(self, patch: int = 14, audio_per_second: int = 25, tokens_per_page: int = 512):
        self.patch, self.audio_per_second, self.tokens_per_page = patch, audio_per_second, tokens_per_page

    def text(self, part: Column) -> Column:
        return escaped(part["text"])

    def image_tokens(self, part: Column) -> Column:
        """One token per patch of the picture."""
        return F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)

    def audio_tokens(self, part: Column) -> Column:
        return F.ceil(part["seconds"] * self.audio_per_second)

    def document_tokens(self, part: Column) -> Column:
        return part["pages"] * F.lit(self.tokens_per_page)

    @property
    def kinds(self) -> dict:
        """Attachment kinds and their token counts; all else is text."""
        return {"image": self.image_tokens, "audio": self.audio_tokens, "document": self.document_tokens}

    def is_attachment(self, part: Column) -> Column:
        return F.coalesce(part["kind"].isin(*self.kinds), F.lit(False))

    def written(self, part: Column) -> Column:
        """What stands in the formatted text."""
        return F.when(self.is_attachment(part), F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(self.text(part))

    def attachment(self, part: Column) -> Column:
        tokens = reduce(lambda c, kind: c.when(part["kind"] == kind, self.kinds[kind](part)), self.kinds, F)
        return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"),
                        F.coalesce(tokens.cast("bigint"), F.lit(0)).alias("tokens"))


def format_chats(turns: DataFrame, visitor: Visitor | None = None) -> DataFrame:
    """conv_id, formatted, loss_spans, attachments and expanded_tokens per conversation.

    `turns` has conv_id, turn, role and parts (array of PART).
    """
    visitor = visitor or Visitor()
    row = F.struct("turn", "role", "parts").alias("t")
    rows = turns.select("conv_id", row)
    grouped = rows.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    chats = grouped.unionByName(rows.where("conv_id is null").select("conv_id", F.array("t").alias("turns")))

    def written(turn):
        parts = F.coalesce(turn["parts"], F.array().cast(f"array<{PART}>"))
        return F.struct(
            F.concat(F.lit(TURN), escaped(turn["role"]), F.lit(TEXT)).alias("head"),
            F.array_join(F.transform(parts, visitor.written), "").alias("body"),
            F.coalesce(turn["role"] == "assistant", F.lit(False)).alias("learned"))

    chats = chats.withColumn("written", F.transform("turns", written))
    # Where each turn's content ends is the sum of all lengths up to it.
    sizes = F.transform("written", lambda w: F.length(w["head"]) + F.length(w["body"]) + len(END))
    ends = F.aggregate(sizes, F.array().cast("array<int>"), lambda done, n: F.concat(
        done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + n)))
    spans = F.transform(F.arrays_zip("written", ends.alias("end")), lambda z: F.struct(
        (z["end"] - len(END) - F.length(z["written"]["body"])).alias("start"),
        F.length(z["written"]["body"]).alias("length"), z["written"]["learned"].alias("learned")))
    spans = F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(
        s["start"].alias("start"), s["length"].alias("length")))
    none = F.array().cast(f"array<{PART}>")
    attached = F.flatten(F.transform("turns", lambda t: F.transform(
        F.filter(F.coalesce(t["parts"], none), visitor.is_attachment), visitor.attachment)))
    return chats.select(
        "conv_id", F.array_join(F.transform("written", lambda w: F.concat(w["head"], w["body"], F.lit(END))), "").alias("formatted"),
        spans.alias("loss_spans"), attached.alias("attachments")).withColumn(
        "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """Role and text of each turn of a formatted chat; placeholders stay in the text."""
    def read(turn):
        halves = F.split(F.substring(turn, len(TURN) + 1, 2 ** 31 - 1), r"<\|text\|>")
        return F.struct(unescaped(halves[0]).alias("role"), unescaped(halves[1]).alias("text"))

    parts = F.split(formatted, r"<\|end\|>")
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), read)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substring(formatted, s["start"] + 1, s["length"]))), "")
