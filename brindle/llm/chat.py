"""2. Chat formatting by a grammar round trip, with DataFrame operations only.

    conversation := turn*
    turn         := "<|im_start|>" role LF body "<|im_end|>" LF

A conversation is first written as it is and read back by a deterministic parser: split at every end
mark, take role and body by the start mark and the first line feed, unescape. A start mark elsewhere
is an error, so neither mark can pass as text. If the turns read back
are not those that went in, its roles and bodies are escaped: every ``<``, backslashes, ``|`` run gets
one backslash more, so no mark can stand in a text, and the parser's unescaping takes it away again.
Conversations that need no escaping stay verbatim. A conversation that still differed would raise.

Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one order.
Null role or text: empty. Null conv_id: a conversation of its own. An empty table gives an empty
table. A conversation is one string, so a single one is limited to what a string can hold (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"  # the role under the loss mask


def escape(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(r"<(\\*)\|"), F.lit(r"<\\$1|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(r"<\\(\\*)\|"), F.lit(r"<$1|"))


def escape_role(c: Column) -> Column:
    """A role has no line feed in the grammar; one inside it becomes a control string of its own."""
    return F.replace(escape(c), F.lit("\n"), F.lit("<|lf|>"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<|lf|>"), F.lit("\n")))


def render(turns: Column, role=lambda c: c, body=lambda c: c) -> Column:
    """An array of (role, text) as one string."""
    one = lambda t: F.concat(F.lit(START), role(t["role"]), F.lit("\n"), body(t["text"]), F.lit(END + "\n"))
    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """The array of (role, text) that the grammar gives; a part without its marks has a null role."""
    parts = F.split(formatted, r"<\|im_end\|>\n?")
    parts = F.slice(parts, 1, F.size(parts) - 1)  # the last is what follows the last end mark
    head = F.lit(len(START) + 1)

    def one(part: Column) -> Column:
        at = F.locate("\n", part)
        good = part.startswith(F.lit(START)) & (at > 0) & (F.locate(START, part, 2) == 0)
        role = F.when(good, unescape_role(F.substring(part, head, at - head)))
        return F.struct(role.alias("role"), unescape(F.substring(part, at + 1, F.length(part))).alias("text"))

    return F.transform(parts, one)


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, escaped): turns as read back from formatted."""
    rows = conversations.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    chats = chats.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    chats = chats.withColumn("plain", render(F.col("source")))
    chats = chats.withColumn("same", F.coalesce(parse(F.col("plain")) == F.col("source"), F.lit(False)))
    chats = chats.withColumn("formatted", F.when(F.col("same"), F.col("plain")).otherwise(render(F.col("source"), escape_role, escape)))
    chats = chats.withColumn("turns", parse(F.col("formatted")))
    sure = F.when(F.coalesce(F.col("turns") == F.col("source"), F.lit(False)), F.col("turns")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))
    return chats.select("conv_id", "formatted", sure.alias("turns"), (~F.col("same")).alias("escaped"))


def digests(chats: DataFrame) -> DataFrame:
    """From what was read back: number of turns, digest of all turns, length and digest of the text under the loss mask."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), "")
    return chats.withColumn("loss", loss).select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
