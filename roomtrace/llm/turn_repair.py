"""Repair of the order of roles in conversations, by alignment with the grammar ``(s?(ua)+)?``.

Wagner-Fischer target alignment: the turns are aligned with the alternating
string of every feasible length.  Lengths are tried from the number of turns
outwards; the cheapest alignment so far bounds the length (every missing turn is
an insert, every surplus one a delete) and gives each table its Ukkonen band.
Tables hold costs of suffixes, so the trace from the front meets the ASCII-least
audit of a length first; equal costs are settled by comparing the traced audits.

Edits: ``K`` keep (0), ``R`` rerole to user or assistant (2), ``D`` delete (3,
required for blank and duplicate turns), ``I`` insert an empty user or assistant
turn (2); a truncated turn that is not deleted adds 1.

A conversation may hold a large part of all rows.  Its turns are sorted by range,
without their texts, and cut into spans of ``SPAN`` turns and segments of
``SEGMENT``.  A segment is aligned from each of the four states of the grammar to
each of them; these costs are put together, and then every segment is traced
with the cost of what follows it.  Inserts belong to the segment of the turn they
precede, so equal audits mean equal states and the choice inside a segment is final.
What is one row per conversation (its audit, one letter per edit) must fit a row;
texts are only merged by conversation as a stream.

Turns are ordered by ``turn`` (nulls first), then role, then digest of the text.
Null roles and texts read as one space; a null ``conv_id`` is a conversation of
its own; equal rows are copies; an empty role or one with another initial can't
be kept; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import for_python, read
from roomtrace.session import work_dir

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of the grammar: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Inserts that end a conversation from each state.
CLOSING = (0, 2 * INSERT, INSERT, 0)
LEGAL = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"
NEVER = 1 << 50

SEGMENT = 32
SPAN = 4096


# --- alignment -----------------------------------------------------------


def targets(state: int, length: int) -> Iterator[str]:
    """The stretches of the alternating string of this length that may follow ``state``."""
    pair = "au" if state == USER else "ua"
    yield (pair * length)[:length]
    if state == START and length:
        yield "s" + ("ua" * length)[: length - 1]


def _take(token: str, wanted: str) -> int:
    """Cost of a turn in the place of ``wanted``."""
    if token == "-" or (wanted == "s" and token not in "sS"):
        return NEVER
    return (0 if token in (wanted, wanted.upper()) else REROLE) + (TRUNCATED if token.isupper() else 0)


def _suffix_costs(tokens: str, target: str, limit: int, closing: bool) -> list[tuple[int, list[int]]] | None:
    """Row ``i``: the first column of its band, and costs of aligning ``tokens[i:]`` with ``target[j:]``.

    Costs up to ``limit`` are exact.  Without ``closing`` nothing is inserted after the last turn.
    """
    n, m = len(tokens), len(target)
    more = m - n
    slack = (limit - (INSERT * more if more > 0 else -DELETE * more)) // (INSERT + DELETE)
    if slack < 0:
        return None
    below, above = min(0, more) - slack, max(0, more) + slack
    rows: list[tuple[int, list[int]]] = []
    under: list[int] = []
    under_from = 0
    for i in range(n, -1, -1):
        first, last = max(0, i + below), min(m, i + above)
        row = [NEVER] * (last - first + 1)
        for j in range(last, first - 1, -1):
            best = NEVER
            if i == n:
                if j == m:
                    best = 0
            else:
                at = j - under_from
                if 0 <= at < len(under):
                    best = under[at] + DELETE
                if j < m and 0 <= at + 1 < len(under):
                    best = min(best, under[at + 1] + _take(tokens[i], target[j]))
            if j < last and target[j] != "s" and (i < n or closing):
                best = min(best, row[j + 1 - first] + INSERT)
            row[j - first] = best
        rows.append((first, row))
        under, under_from = row, first
    rows.reverse()
    return rows


def _trace(tokens: str, target: str, rows: list[tuple[int, list[int]]]) -> tuple[str, str]:
    """The ASCII-least audit of the cheapest alignments, and its edits of turns that may stay."""
    n, m = len(tokens), len(target)

    def cost(i: int, j: int) -> int:
        first, row = rows[i]
        return row[j - first] if 0 <= j - first < len(row) else NEVER

    i = j = 0
    audit, edits = [], []
    while i < n or j < m:
        here = cost(i, j)
        if i < n and cost(i + 1, j) + DELETE == here:
            audit.append("D")
            if tokens[i] != "-":
                edits.append("D")
            i += 1
        elif j < m and target[j] != "s" and cost(i, j + 1) + INSERT == here:
            audit.append("I")
            edits.append(target[j])
            j += 1
        else:
            kept = tokens[i].lower() == target[j]
            audit.append("K" if kept else "R")
            edits.append("K" if kept else target[j].upper())
            i, j = i + 1, j + 1
    return "".join(audit), "".join(edits)


@lru_cache(1 << 15)
def align(tokens: str, state: int, after: tuple[int, ...] | None) -> tuple[int, str, str, int]:
    """Cost, audit, edits and last state of the best alignment of ``tokens`` from ``state``.

    ``after`` is the cost of what follows from each last state; None: this is the
    end, and the whole must be a conversation of the grammar.
    """
    n = len(tokens)
    closing = after is None
    rest = (0, NEVER, NEVER, 0) if after is None else after
    most = (DELETE + TRUNCATED) * n + INSERT * (2 * n + 4) + max(r for r in rest if r < NEVER)
    best: tuple[int, str, str, int] | None = None
    found = most
    for m in sorted(range(2 * n + 4), key=lambda m: (max(INSERT * (m - n), DELETE * (n - m)), m)):
        if max(INSERT * (m - n), DELETE * (n - m)) + min(rest) > found:
            break
        for target in targets(state, m):
            last = STATE[target[-1]] if target else state
            if rest[last] >= NEVER:
                continue
            rows = _suffix_costs(tokens, target, found - rest[last], closing)
            if rows is None:
                continue
            first, row = rows[0]
            total = row[0] + rest[last] if first == 0 and row else NEVER
            if total > found:
                continue
            audit, edits = _trace(tokens, target, rows)
            if best is None or (total, audit) < (found, best[1]):
                best = (row[0], audit, edits, last)
                found = total
    return best or (NEVER, "", "", state)


@lru_cache(1 << 14)
def _costs(tokens: str) -> tuple[tuple[int, ...], ...]:
    """Costs of a segment from each state (row) to each state."""
    ends = range(4)
    return tuple(
        tuple(align(tokens, state, tuple(0 if e == end else NEVER for e in ends))[0] for end in ends) for state in ends
    )


def _before(costs: tuple[tuple[int, ...], ...], after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(NEVER, min(c + a for c, a in zip(row, after))) for row in costs)


def _segments(tokens: str) -> list[str]:
    return [tokens[i : i + SEGMENT] for i in range(0, len(tokens), SEGMENT)]


def span_costs(tokens: str) -> list[int]:
    """Costs of a span from each state to each state, row after row."""
    whole = [tuple(0 if a == b else NEVER for b in range(4)) for a in range(4)]
    for segment in reversed(_segments(tokens)):
        # Columns of ``whole``: what follows, for each last state.
        whole = [_before(_costs(segment), column) for column in whole]
    return [whole[end][state] for state in range(4) for end in range(4)]


def span_audit(tokens: str, state: int, after: tuple[int, ...] | None) -> tuple[int, str, str, int]:
    """Cost, audit, edits and last state of a span; None: it is the last one."""
    segments = _segments(tokens)
    follows = [CLOSING if after is None else after]
    for segment in reversed(segments[1:]):
        follows.append(_before(_costs(segment), follows[-1]))
    cost, audit, edits = 0, [], []
    for k, segment in enumerate(segments):
        rest = follows[len(segments) - 1 - k]
        least = min(rest)
        ends = after is None and k == len(segments) - 1
        found = align(segment, state, None if ends else tuple(min(NEVER, r - least) for r in rest))
        cost, state = cost + found[0], found[3]
        audit.append(found[1])
        edits.append(found[2])
    return cost, "".join(audit), "".join(edits), state


# --- turns ---------------------------------------------------------------


def _turns(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    text = F.coalesce(F.col("text"), space)
    end = F.rtrim(text, F.lit(BLANKS))
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        text.alias("text"),
        F.sha2(text, 256).alias("digest"),
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


def _look_up(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Adds ``values`` of ``b``, which has each key once; null keys match null keys."""
    b = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *values)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return a.join(b, on, "left").drop(*[f"_{k}" for k in keys])


def _first_turn() -> list[Column]:
    # Null is the first turn; both aggregates are combined on the map side.
    return [F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_least")]


def _skeleton(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """One row per different turn, without its text: ``n`` copies, and whether it is the first of its role and text."""
    path = work_dir(spark, "turn-skeleton")
    turns.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut")
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    first = (
        rows.groupBy("conv_id", "role", "digest")
        .agg(*_first_turn())
        .select("conv_id", "role", "digest", F.when(~F.col("_null"), F.col("_least")).alias("turn"), F.lit(True).alias("first"))
    )
    found = _look_up(rows, first, ["conv_id", "role", "digest", "turn"], ["first"])
    return found.withColumn("first", F.coalesce("first", F.lit(False)))


SPAN_FIELDS = {
    "at": pa.int64(), "edge": pa.bool_(), "tokens": pa.string(), "blank": pa.int64(), "duplicate": pa.int64(),
    "truncated": pa.int64(), "illegal": pa.int64(), "head": pa.string(), "tail": pa.string(), "least": pa.int64(),
    "most": pa.int64(), "turns": pa.int64(), "first_turn": pa.int64(), "last_turn": pa.int64(),
}
COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _batch(rows: list[dict], conv: pa.DataType, fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    fields = {"conv_id": conv, **fields}
    return pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in fields.items()], list(fields))


def _ddl(conv: str, fields: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.string(): "string"}
    return ", ".join([f"conv_id {conv}", *[f"{n} {names.get(t) or f'array<{names[t.value_type]}>'}" for n, t in fields.items()]])


def _new_span(conv, edge: bool) -> dict:
    return {"conv_id": conv, "edge": edge, "tokens": [], "least": None, "most": None, **dict.fromkeys(COUNTS, 0)}


def _add(span: dict, token: str, fault: str | None, initial: str, turn: int | None) -> None:
    if not span["tokens"]:
        span["head"], span["first_turn"], span["turns"] = initial, turn, int(turn is not None)
    else:
        span["illegal"] += span["tail"] + initial not in LEGAL
        span["turns"] += turn is not None and turn != span["last_turn"]
    span["tail"], span["last_turn"] = initial, turn
    if turn is not None:
        span["least"] = turn if span["least"] is None else span["least"]
        span["most"] = turn
    span["tokens"].append(token)
    if fault:
        span[fault] += 1


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns to spans of up to ``most`` turns.  A span is an ``edge`` if its conversation has more spans here or may have some in other partitions."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    span, out, conv_type, first_here = None, [], pa.null(), True

    def close() -> None:
        nonlocal number
        out.append({**span, "tokens": "".join(span["tokens"]), "at": number})
        number += 1

    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "n", "blank", "cut", "first")]
        for conv, turn, role, n, blank, short, first in zip(*columns):
            if span is None or span["conv_id"] != conv:
                if span is not None:
                    close()
                    first_here = False
                span = _new_span(conv, first_here)
            initial = role[:1]
            letter = initial if initial in STATE else "x"
            for copy in range(n):
                if len(span["tokens"]) >= most:
                    span["edge"] = True
                    close()
                    span = _new_span(conv, True)
                again = copy > 0 or not first
                token = "-" if blank or again else letter.upper() if short else letter
                fault = "blank" if blank else "duplicate" if again else "truncated" if short else None
                _add(span, token, fault, initial, turn)
            if len(out) >= 1000:
                yield _batch(out, conv_type, SPAN_FIELDS)
                out.clear()
    if span is not None:
        span["edge"] = True
        close()
    if out:
        yield _batch(out, conv_type, SPAN_FIELDS)


def _edge_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = [span_costs(t) for t in batch.column("tokens").to_pylist()]
        yield pa.record_batch([batch.column("conv_id"), batch.column("at"), pa.array(costs, pa.list_(pa.int64()))], ["conv_id", "at", "costs"])


def _what_follows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans from the last to the first of each conversation: what follows a span costs from each state; null for the last."""
    conv, after = None, None
    begun = False
    for batch in batches:
        out = []
        for c, at, costs in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "at", "costs")]):
            if not begun or c != conv:
                begun, conv, after = True, c, None
            out.append({"conv_id": c, "at": at, "after": None if after is None else list(after)})
            after = _before(tuple(tuple(costs[4 * s : 4 * s + 4]) for s in range(4)), CLOSING if after is None else after)
        yield _batch(out, batch.schema.field("conv_id").type, {"at": pa.int64(), "after": pa.list_(pa.int64())})


FOUND_FIELDS = {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "edits": pa.list_(pa.string()), "ends": pa.list_(pa.int64())}
KEPT_FIELDS = {n: t for n, t in SPAN_FIELDS.items() if n not in ("tokens", "edge")}


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of each span from every state it may begin in; a whole conversation begins in the first."""
    for batch in batches:
        found = [
            [span_audit(tokens, s, None if after is None else tuple(after)) for s in (range(4) if edge else [START])]
            for tokens, edge, after in zip(*[batch.column(n).to_pylist() for n in ("tokens", "edge", "after")])
        ]
        lists = [pa.array([[f[k] for f in span] for span in found], t) for k, t in enumerate(FOUND_FIELDS.values())]
        kept = ["conv_id", *KEPT_FIELDS]
        yield pa.record_batch([*[batch.column(n) for n in kept], *lists], [*kept, *FOUND_FIELDS])


RESULT_FIELDS = {n: pa.int64() for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": pa.string(), "edits": pa.string()}


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans in order to one row per conversation."""
    whole, conv_type, out = None, pa.null(), []

    def close() -> None:
        gaps = 0 if whole["least"] is None else whole["most"] - whole["least"] + 1 - whole["turns"]
        out.append({**whole, "gaps": gaps, "audit": "".join(whole["audit"]), "edits": "".join(whole["edits"])})

    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        for span in batch.to_pylist():
            if whole is None or whole["conv_id"] != span["conv_id"]:
                if whole is not None:
                    close()
                whole = {"conv_id": span["conv_id"], "state": START, "cost": 0, "audit": [], "edits": [], "least": None, **dict.fromkeys(COUNTS, 0)}
            else:
                whole["illegal"] += whole["tail"] + span["head"] not in LEGAL
                whole["turns"] -= span["first_turn"] is not None and span["first_turn"] == whole["last_turn"]
            for name in COUNTS:
                whole[name] += span[name]
            whole["tail"], whole["last_turn"] = span["tail"], span["last_turn"]
            if span["least"] is not None:
                whole["least"] = span["least"] if whole["least"] is None else whole["least"]
                whole["most"] = span["most"]
            s = whole["state"]
            whole["cost"] += span["costs"][s]
            whole["audit"].append(span["audits"][s])
            whole["edits"].append(span["edits"][s])
            whole["state"] = span["ends"][s]
        if out:
            yield _batch(out, conv_type, RESULT_FIELDS)
            out.clear()
    if whole is not None:
        close()
        yield _batch(out, conv_type, RESULT_FIELDS)


def audits(spark: SparkSession, rows: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text``: its counts of faults, the cost and the audit of
    its repair, and ``edits``, the audit without turns that had to go (``U``, ``A``: reroled; ``u``, ``a``: inserted)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    skeleton = for_python(_skeleton(spark, _turns(rows)))
    path = work_dir(spark, "turn-spans")
    skeleton.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order).mapInArrow(
        partial(_cut, most=span), _ddl(kind, SPAN_FIELDS)
    ).write.parquet(path)
    spans = spark.read.parquet(path)
    costs = spans.where("edge").select("conv_id", "at", "tokens").mapInArrow(_edge_costs, f"conv_id {kind}, at bigint, costs array<bigint>")
    follows = (
        costs.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("at").desc())
        .mapInArrow(_what_follows, f"conv_id {kind}, at bigint, after array<bigint>")
        .drop("conv_id")
    )
    found = spans.join(follows, "at", "left").mapInArrow(_audits, _ddl(kind, KEPT_FIELDS | FOUND_FIELDS))
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_joined, _ddl(kind, RESULT_FIELDS))


TURN_FIELDS = {"position": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
#: Characters of text in a batch of repaired turns.
BATCH = 1 << 22


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each conversation, then its turns in order, to the turns of the repaired conversation."""
    conv, edits, at, position, size = None, "", 0, 0, 0
    conv_type, out = pa.null(), []

    def say(edit: str, role: str, text: str) -> None:
        nonlocal position, size
        out.append({"conv_id": conv, "position": position, "edit": edit, "role": role, "text": text})
        position, size = position + 1, size + len(text)

    def insert() -> None:
        nonlocal at
        while edits[at : at + 1] in ("u", "a"):
            say("I", "user" if edits[at] == "u" else "assistant", "")
            at += 1

    for batch in batches:
        conv_type = batch.schema.field("conv_id").type
        columns = {n: batch.column(n) for n in ("conv_id", "edits", "role", "text")}
        for i in range(batch.num_rows):
            row = {n: c[i].as_py() for n, c in columns.items()}
            if row["edits"] is not None:
                insert()
                conv, edits, at, position = row["conv_id"], row["edits"], 0, 0
                continue
            insert()
            edit, at = edits[at], at + 1
            if edit != "D":
                say("K" if edit == "K" else "R", {"U": "user", "A": "assistant"}.get(edit, row["role"]), row["text"])
            if size > BATCH:
                yield _batch(out, conv_type, TURN_FIELDS)
                out.clear()
                size = 0
    insert()
    if out:
        yield _batch(out, conv_type, TURN_FIELDS)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of the repaired conversations, ``conv_id, position, edit, role, text``; ``found`` is what ``audits`` gives.

    Conversations lie together and in order within a partition.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    # Only turns that may stay: the first of each role and text, unless blank.
    texts = (
        _turns(rows)
        .where(~F.col("blank"))
        .groupBy("conv_id", "role", "text")
        .agg(*_first_turn())
        .select("conv_id", F.when(~F.col("_null"), F.col("_least")).alias("turn"), "role", F.sha2("text", 256).alias("digest"), "text", F.lit(None).cast("string").alias("edits"))
    )
    none = F.lit(None)
    first = found.select("conv_id", none.cast("bigint").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("digest"), none.cast("string").alias("text"), "edits")
    return (
        for_python(first.unionByName(texts))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("edits").isNull(), F.col("turn").asc_nulls_first(), "role", "digest")
        .mapInArrow(_rebuild, _ddl(kind, TURN_FIELDS))
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns, together and in order, to one digest per conversation."""
    conv, sha, conv_type = None, None, pa.null()
    fields = {"repaired_sha256": pa.string()}
    for batch in batches:
        conv_type, out = batch.schema.field("conv_id").type, []
        columns = {n: batch.column(n) for n in ("conv_id", "role", "text")}
        for i in range(batch.num_rows):
            c = columns["conv_id"][i].as_py()
            if sha is None or c != conv:
                if sha is not None:
                    out.append({"conv_id": conv, "repaired_sha256": sha.hexdigest()})
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{columns['role'][i].as_py()}:{columns['text'][i].as_py()}".encode())
        if out:
            yield _batch(out, conv_type, fields)
    if sha is not None:
        yield _batch([{"conv_id": conv, "repaired_sha256": sha.hexdigest()}], conv_type, fields)


# --- query ---------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with the faults that the query plants: by a check sum of ``conv_id:turn`` some are dropped, emptied,
    stripped of their sentence ends, said twice or given to the user."""
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = rows.withColumn("fault", F.crc32(name) % 20).where("fault <> 0")
    return hit.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    rows = damage(said)
    path = work_dir(spark, "turn-audits")
    audits(spark, rows).write.parquet(path)
    found = spark.read.parquet(path)
    digests = repaired(rows, found).mapInArrow(_digest, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")
    every = said.select("conv_id").distinct()
    counts = [n for n, t in RESULT_FIELDS.items() if t == pa.int64()]
    out = _look_up(every, found, ["conv_id"], [*counts, "audit"])
    out = _look_up(out, digests, ["conv_id"], ["repaired_sha256"])
    return out.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
