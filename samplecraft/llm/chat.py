"""Conversations as training texts, from trees of replies.

Messages name the message they answer. Self-joins with doubled reach give every message
its root, its depth and the sum of the scores on its way: after k joins these hold for
all ways of up to 2^k messages. A leaf ends a path; the paths of a tree are ranked by
mean score, and each chosen one becomes one conversation in this format, with the turns
directly after one another:

    <|im_start|>role<|im_sep|>text<|im_end|>

Control strings that occur in a role or text are marked with a backslash behind their
first character, and those that have such backslashes already get one more. Taking one
away gives the text back, whatever it was. All of this is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..plans.staging import staged

START, SEPARATOR, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of this format and of common others, after their first
#: character.
_TAILS = r"\|[A-Za-z_]+\|>|/?s>|<SYS>>|</SYS>>|/?INST\]"
_PLAIN = rf"([<\[])(\\*)(?=(?:{_TAILS}))"
_MARKED = rf"([<\[])\\(\\*)(?=(?:{_TAILS}))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1$2\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, "$1$2")


def linear_replies(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of conversations that are plain lists: each answers the one before.

    Rows of the same turn follow one another by role and text (nulls first); a null
    conversation or turn is a value like others. Columns: conversation, message,
    parent, role, text, score (0).
    """
    place = F.row_number().over(Window.partitionBy(conversation).orderBy(turn, role, text)).cast("long")
    return rows.select(
        F.col(conversation).alias("conversation"),
        place.alias("message"),
        F.when(place > 1, place - 1).alias("parent"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
        F.lit(0.0).alias("score"),
    )


def reply_paths(messages: DataFrame) -> DataFrame:
    """Every root-to-leaf path: conversation, root, leaf, depth (messages), total (of the
    scores).

    ``messages`` has conversation, message, parent, score; message is unique within its
    conversation. A parent that is null or doesn't exist makes a root; a null score is
    0. Messages whose parents form a ring are on no path. Rows without a message number
    are left out.
    """
    base = messages.filter(F.col("message").isNotNull()).select(
        "conversation", "message", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    )
    known = base.select(F.col("conversation").alias("c"), F.col("message").alias("m"))
    same = F.col("conversation").eqNullSafe(F.col("c"))
    ways = (
        base.join(known, same & (F.col("parent") == F.col("m")), "left")
        # ``up`` is the message the way has come to from below, null once at the root.
        .select("conversation", "message", F.col("m").alias("up"), F.col("message").alias("root"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    )
    ways = staged(ways, "reply-ways")
    parents = ways.filter(F.col("up").isNotNull()).select("conversation", F.col("up").alias("message")).distinct()
    # A way of n messages ends within log2(n) rounds, one on a ring never does.
    for _ in range(ways.count().bit_length()):
        under_way = ways.filter(F.col("up").isNotNull())
        if under_way.isEmpty():
            break
        above = ways.select(
            F.col("conversation").alias("c"), F.col("message").alias("m"), F.col("up").alias("next"),
            F.col("root").alias("top"), F.col("depth").alias("more"), F.col("total").alias("sum"),
        )
        # Only ways that go on take part; the message they have come to always exists.
        further = under_way.join(above, same & (F.col("up") == F.col("m"))).select(
            "conversation", "message", F.col("next").alias("up"), F.col("top").alias("root"),
            (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("sum")).alias("total"),
        )
        ways = staged(ways.filter(F.col("up").isNull()).unionByName(further), "reply-ways")
    at_root = ways.filter(F.col("up").isNull()).alias("w")
    ends = parents.select(F.col("conversation").alias("c"), F.col("message").alias("m"))
    return at_root.join(ends, same & (F.col("message") == F.col("m")), "left_anti").select(
        "conversation", "root", F.col("message").alias("leaf"), "depth", "total"
    )


def best_paths(paths: DataFrame, most: int = 1) -> DataFrame:
    """The ``most`` paths of each conversation with the highest mean score, numbered
    from 1 as ``rank``; ties go to the longer path, then to the smaller leaf."""
    if most == 1:
        best = F.max_by(F.struct("root", "leaf", "depth", "total"), F.struct(F.col("total") / F.col("depth"), "depth", -F.col("leaf"), -F.col("root")))
        return paths.groupBy("conversation").agg(best.alias("b")).select("conversation", "b.*", F.lit(1).alias("rank"))
    order = Window.partitionBy("conversation").orderBy((F.col("total") / F.col("depth")).desc(), F.col("depth").desc(), "leaf", "root")
    return paths.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def path_messages(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """The messages on chosen paths: conversation, rank, message, place (from the root,
    0), role, text. Found from the leaves up, with doubled reach."""
    links = messages.filter(F.col("message").isNotNull()).select(F.col("conversation").alias("c"), F.col("message").alias("m"), F.col("parent").alias("p"))
    known = links.select(F.col("c").alias("c2"), F.col("m").alias("m2"))
    links = links.join(known, F.col("c").eqNullSafe(F.col("c2")) & (F.col("p") == F.col("m2"))).select("c", "m", "p")
    jump = staged(links, "reply-jumps")  # message to the one 2^k above
    found = chosen.select("conversation", "rank", F.col("leaf").alias("message"), (F.col("depth") - 1).alias("place"))
    longest, reach = chosen.agg(F.max("depth")).first()[0] or 0, 1
    same = F.col("conversation").eqNullSafe(F.col("c"))
    while reach < longest:
        further = found.join(jump, same & (F.col("message") == F.col("m"))).select(
            "conversation", "rank", F.col("p").alias("message"), (F.col("place") - reach).alias("place")
        )
        found = staged(found.unionByName(further), "reply-path")
        reach *= 2
        if reach < longest:
            again = jump.select(F.col("c").alias("c2"), F.col("m").alias("m2"), F.col("p").alias("p2"))
            jump = staged(
                jump.join(again, F.col("c").eqNullSafe(F.col("c2")) & (F.col("p") == F.col("m2"))).select("c", "m", F.col("p2").alias("p")), "reply-jumps"
            )
    words = messages.select(F.col("conversation").alias("c"), F.col("message").alias("m"), "role", "text")
    return found.join(words, same & (F.col("message") == F.col("m"))).select("conversation", "rank", "message", "place", "role", "text")


def formatted(turns: DataFrame, speaker: str = "assistant") -> DataFrame:
    """One row for each conversation and rank: formatted, loss_spans.

    ``turns`` has conversation, rank, place, role, text; null roles and texts are empty.
    ``loss_spans`` are (start, length) in characters, in order: the texts of
    ``speaker`` as they stand in the formatted text. A conversation is one value, so
    its turns meet in one row.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct("place", role.alias("role"), escaped(role).alias("r"), escaped(text).alias("t"))
    rows = turns.groupBy("conversation", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    marks = len(START) + len(SEPARATOR)
    size = lambda t: F.char_length(t["r"]) + F.char_length(t["t"]) + marks + len(STOP)
    # Where each turn begins: one pass that carries the end so far.
    begun = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,length:int,loss:boolean>>").alias("spans")),
        lambda so, t: F.struct(
            (so["end"] + size(t)).alias("end"),
            F.concat(
                so["spans"],
                F.array(F.struct((so["end"] + marks + F.char_length(t["r"])).alias("start"), F.char_length(t["t"]).alias("length"), (t["role"] == speaker).alias("loss"))),
            ).alias("spans"),
        ),
    )["spans"]
    return rows.select(
        "conversation",
        "rank",
        F.array_join(F.transform("turns", lambda t: F.concat(F.lit(START), t["r"], F.lit(SEPARATOR), t["t"], F.lit(STOP))), "").alias("formatted"),
        F.transform(F.filter(begun, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["length"])).alias("loss_spans"),
    )


def format_conversations(messages: DataFrame, most: int = 1, speaker: str = "assistant") -> DataFrame:
    """The best ``most`` paths of each tree of replies, formatted: see ``formatted``.

    ``messages``: conversation, message, parent, role, text, score; others are ignored.
    """
    messages = staged(messages.select("conversation", "message", "parent", "role", "text", "score"), "messages")
    chosen = staged(best_paths(reply_paths(messages), most), "reply-chosen")
    return formatted(path_messages(messages, chosen), speaker)


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text of each, as they were) and ``loss_text`` (all text
    under the loss mask, unescaped) to formatted conversations."""
    quoted = lambda s: rf"\Q{s}\E"
    body = F.substring("formatted", F.lit(len(START) + 1), F.char_length("formatted") - len(START) - len(STOP))
    parts = F.when(F.col("formatted") == "", F.array().cast("array<string>")).otherwise(F.split(body, quoted(STOP + START), -1))
    turns = F.transform(
        F.transform(parts, lambda p: F.split(p, quoted(SEPARATOR), 2)),
        lambda p: F.struct(unescaped(F.get(p, 0)).alias("role"), unescaped(F.get(p, 1)).alias("text")),
    )
    loss = F.transform("loss_spans", lambda s: unescaped(F.col("formatted").substr(s["start"] + 1, s["length"])))
    return conversations.withColumns({"turns": turns, "loss_text": F.array_join(loss, "")})
