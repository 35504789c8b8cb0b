"""Chat formatting by event-sourced reconstruction.

A log holds events ``conv_id, seq, turn, kind, role, text``.  Events of a
conversation are taken in the order of ``seq``:

* ``message``     sets role and text of a turn,
* ``delta``       appends text to a turn (streamed output),
* ``edit``        replaces the text of a turn, its role stays unless given,
* ``regenerate``  empties a turn and withdraws every later turn written so far.

``fold`` gives one row per turn that is left, ``render`` one row per
conversation.  Deltas are merged before conversations are put together, so a
long stream is reduced where it lies.  A conversation is one string in the end
and must fit one row; nothing else of it has to.

Defined cases: null text is empty, a null role is written as ``unknown``, an
unknown kind counts as ``message``, a null kind too; a null ``seq`` comes first; events equal in ``seq`` go
by kind and text; repeated ``message`` events overwrite each other; a null
``conv_id`` is a conversation of its own; an empty log gives no rows.  Columns
beyond the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roomtrace.llm.tables import read

#: Control strings of the template, and the role whose texts carry the loss.
HEAD, END = "### ", "</turn>\n"
LEARNED = "assistant"
#: Escapes in texts; a backslash starts every one of them, so they can't be mistaken.
TEXT_ESCAPES = (("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\e"))
#: A role is the rest of its line.
ROLE_ESCAPES = (*TEXT_ESCAPES, ("\n", "\\n"))


def escape(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, coded in escapes:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, coded in reversed(escapes):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def fold(events: DataFrame) -> DataFrame:
    """The turns that are left: ``conv_id, turn, role, text``."""
    key = F.struct(F.col("conv_id"), F.col("turn"))
    kind = F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")).otherwise("message")
    log = events.select(
        "conv_id", "turn", F.coalesce("seq", F.lit(-(2**63))).alias("seq"), "role", kind.alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    # The last withdrawal of any earlier turn: few rows, one per turn that was ever regenerated.
    again = (
        log.where("kind = 'regenerate'").groupBy("conv_id", "turn").agg(F.max("seq").alias("seq"))
    )
    turns = log.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("kind") != "delta", F.struct("seq", "kind", "text"))).alias("start"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    bounds = (
        turns.join(again.withColumnRenamed("seq", "again"), [turns.conv_id.eqNullSafe(again.conv_id), turns.turn.eqNullSafe(again.turn)], "left")
        .select(turns.conv_id, turns.turn, "start", "again")
        .withColumn("void_to", F.max("again").over(earlier))
        .select(F.struct("conv_id", "turn").alias("key"), "start", "void_to")
    )
    live = (
        log.select(key.alias("key"), "seq", "kind", "role", "text")
        .join(bounds, "key")
        .where(F.col("void_to").isNull() | (F.col("seq") > F.col("void_to")))
    )
    opened = (F.col("start").isNull()) | (F.col("seq") >= F.col("start.seq"))
    counts = opened & (
        (F.col("kind") == "delta")
        | ((F.col("kind") == F.col("start.kind")) & (F.col("text") == F.col("start.text")) & (F.col("kind") != "regenerate"))
    )
    part = F.struct(F.col("seq"), (F.col("kind") == "delta").alias("later"), F.col("text"))
    folded = live.groupBy("key").agg(
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("said"),
        F.sort_array(F.collect_list(F.when(counts, part))).alias("parts"),
        F.first("start").alias("start"),
    )
    # Equal first events of one seq are one event.
    first = F.col("parts")[0]
    once = F.filter("parts", lambda p: p["later"] | ((p["seq"] == first["seq"]) & ~p["later"]))
    deltas = F.filter(once, lambda p: p["later"])
    begun = F.when((F.size("parts") > 0) & ~first["later"], first["text"]).otherwise("")
    return folded.select(
        "key.conv_id",
        "key.turn",
        F.coalesce(F.col("said.role"), F.lit("unknown")).alias("role"),
        F.concat(begun, F.array_join(F.transform(deltas, lambda p: p["text"]), "")).alias("text"),
    )


def render(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted``: the turns of each conversation in order, marked and escaped."""
    line = F.concat(
        F.lit(HEAD),
        escape(F.coalesce("role", F.lit("unknown")), ROLE_ESCAPES),
        F.lit("\n"),
        escape(F.coalesce("text", F.lit(""))),
        F.lit(END),
    )
    rows = turns.select("conv_id", F.struct(F.col("turn"), line.alias("line")).alias("part"))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["line"]), "").alias("formatted")
    )


def parsed(formatted: Column) -> Column:
    """The turns in a rendered conversation: array of ``role, text``, unescaped."""
    pieces = F.slice(F.split(formatted, END, -1), 1, F.size(F.split(formatted, END, -1)) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(HEAD) + 1)), ROLE_ESCAPES).alias("role"),
            unescape(F.substr(piece, F.length(head) + 2)).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_spans(formatted: Column) -> Column:
    """Where the learned texts stand: array of ``start, length`` in code points of the rendered string."""
    pieces = F.slice(F.split(formatted, END, -1), 1, F.size(F.split(formatted, END, -1)) - 1)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        head = F.length(F.substring_index(piece, "\n", 1)) + 1
        span = F.struct((state["at"] + head).alias("start"), (F.length(piece) - head).cast("bigint").alias("length"))
        learned = piece.startswith(f"{HEAD}{LEARNED}\n")
        return F.struct(
            (state["at"] + F.length(piece) + len(END)).alias("at"),
            F.when(learned, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, start, step, lambda s: s["spans"])


#: What comes before the last writing of a turn, and the writing itself, in the order of ``seq``.
DRAFT, AGAIN, WRITTEN = 0, 1, 10


def as_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of turns, as if each had been written while it was streamed; rows equal in turn stay separate turns.

    By a hash of the turn, its text comes in one piece and two deltas, as an edit of a draft, in one piece and a
    delta after the turn was regenerated, or in deltas alone after that.  All turns share sequence numbers, so an
    event says nothing without its place: a regenerated turn withdraws what later turns had as drafts.
    """
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    at = F.struct(F.col("turn"), F.row_number().over(order).alias("copy"))
    text, size = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    third = F.ceil(size / 3).cast("int")

    def piece(n: int, to_end: bool = False) -> Column:
        return F.substr(text, third * n + 1, size if to_end else third)

    def event(seq: int, kind: str, said: Column) -> Column:
        return F.struct(F.lit(seq).cast("bigint").alias("seq"), F.lit(kind).alias("kind"), said.alias("text"))

    draft = event(DRAFT, "message", F.concat(F.lit("draft of "), piece(1)))
    again = event(AGAIN, "regenerate", F.lit(""))
    last = [event(WRITTEN + 1, "delta", piece(1)), event(WRITTEN + 2, "delta", piece(2, True))]
    ways = [
        F.array(event(WRITTEN, "message", piece(0)), *last),
        F.array(draft, event(WRITTEN, "edit", text)),
        F.array(draft, again, event(WRITTEN, "message", piece(0)), event(WRITTEN + 1, "delta", piece(1, True))),
        F.array(draft, again, event(WRITTEN, "delta", piece(0)), *last),
    ]
    way = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(len(ways)))
    events = F.when(way == 0, ways[0]).when(way == 1, ways[1]).when(way == 2, ways[2]).otherwise(ways[3])
    # Copies are numbered before the events are spread out.
    turns = conversations.select("conv_id", at.alias("turn"), "role", "text")
    rows = turns.select("conv_id", "turn", "role", F.explode(events).alias("event"))
    return rows.select("conv_id", "turn", "event.seq", "event.kind", "role", "event.text")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, LEARNED, said)], "conv_id bigint, turn bigint, role string, text string"
    )
    log = as_events(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra))
    out = render(fold(log)).select(
        "conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), loss_spans(F.col("formatted")).alias("spans")
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = unescape(
        F.array_join(
            F.transform("spans", lambda s: F.substr("formatted", s["start"].cast("int") + 1, s["length"].cast("int"))), ""
        )
    )
    return out.select("conv_id", "formatted", whole.alias("whole"), F.size("turns").cast("bigint").alias("n_turns"), learned.alias("learned")).select(
        "conv_id",
        "n_turns",
        F.sha2("whole", 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


_PLAIN = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), said AS (
  SELECT *, {text} AS coded, replace({role}, chr(10), '\\n') AS coded_role FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(coded) + length(coded_role) + 13) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""
_CODED = "replace(replace(replace({0}, '\\', '\\s'), '###', '\\h'), '</turn>', '\\e')"
OP10_SQL = _PLAIN.format(text=_CODED.format("text"), role=_CODED.format("role"))
