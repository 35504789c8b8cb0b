"""Spelling variants: words of the corpus and their frequent neighbours at one edit.

Finite-state composition: the vocabulary is an acceptor A, the pairs of words that
differ by exactly one inserted, deleted or replaced code point are what A, a one-edit
transducer and A again accept.  Words of a pair share their first half or the rest of
their last (an edit is in one of them), so the vocabulary is dealt by these: each part
is the acceptor from one initial state.  Within a part, A is minimised; the walk goes
through triples of two states and "edited yet".  Before the edit both states are the
same one; after it, equal states have equal languages, whose words pair up without
being walked.  States count the words behind them, so a walk knows words by numbers.

A part holds words of two lengths, ``m`` and ``m + 1``, that agree in ``m // 2`` or
``m - m // 2`` code points: its size is bounded by the alphabet, not by the corpus, and
no word meets all others.  Words are counted before they are shuffled.

Null texts have no words; a null ``doc_id`` reads as empty; words may be of any length;
equal rows count each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import for_python, read
from roomtrace.llm.words import texts
from roomtrace.session import work_dir

#: Fixed values of the words: shortest length, fewest occurrences, and one run in how many loses a code point.
SHORTEST, FEWEST, DAMAGED = 5, 3, 97
#: A form occurs at least this many times as often.
TIMES = 2
RUN = re.compile("[a-zÀ-ÿ]+")
#: Words counted in a task before they are handed on.
HELD = 1 << 18


# --- vocabulary ----------------------------------------------------------


def words_of(doc_id: str, text: str) -> Counter:
    """The words of a text with their counts; a run whose check sum is divided by ``DAMAGED`` has lost a code point."""
    # As bytes only A-Z change.
    runs = Counter(RUN.findall(text.encode().lower().decode()))
    words: Counter = Counter()
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= SHORTEST:
            words[run] += n
    return words


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            held.update(words_of(doc, text))
            if len(held) >= HELD:
                yield flush()
    if held:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of ``doc_id, text``."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    counts = for_python(rows).mapInArrow(_counted, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= FEWEST)


# --- acceptors -----------------------------------------------------------


class Acceptor:
    """The minimal acyclic automaton of sorted different words; states are numbers, ``count`` the words behind each.

    ``number`` of an arc is how many words of its state come before those that take it.
    """

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self._known: dict[tuple, int] = {}
        # The path of the last word, not yet minimised: (letter to here, final, arcs so far).
        path: list[tuple[str, list[bool], dict[str, int]]] = [("", [False], {})]
        last = ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._fold(path, same + 1)
            path += [(c, [False], {}) for c in word[same:]]
            path[-1][1][0] = True
            last = word
        self._fold(path, 1)
        self.start = self._state(path[0][1][0], path[0][2])

    def _fold(self, path: list, depth: int) -> None:
        while len(path) > depth:
            letter, final, arcs = path.pop()
            path[-1][2][letter] = self._state(final[0], arcs)

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            numbered, before = {}, int(final)
            for letter, to in arcs.items():
                numbered[letter] = (to, before)
                before += self.count[to]
            self.arcs.append(numbered)
            self.final.append(final)
            self.count.append(before)
        return state

    def one_edit_pairs(self) -> Iterator[tuple[int, int]]:
        """Numbers ``x, y`` of the words with one code point replaced (x before y) or with one more in x; each pair once."""
        arcs, final, count = self.arcs, self.final, self.count
        ahead = [(self.start, 0)]
        while ahead:
            p, n = ahead.pop()
            after: list[tuple[int, int, int, int, str]] = []
            out = list(arcs[p].items())
            for i, (letter, (to, k)) in enumerate(out):
                ahead.append((to, n + k))
                after += [(to, other, n + k, n + j, "") for _, (other, j) in out[i + 1 :]]
                # Of equal letters in a row the last one is taken for the inserted one.
                after.append((to, p, n + k, n, letter))
            while after:
                p1, q1, x, y, barred = after.pop()
                if p1 == q1:
                    yield from ((x + i, y + i) for i in range(count[p1]))
                    continue
                if final[p1] and final[q1]:
                    yield x, y
                others = arcs[q1]
                for letter, (to, k) in arcs[p1].items():
                    if letter != barred and letter in others:
                        q2, j = others[letter]
                        after.append((to, q2, x + k, y + j, ""))


def pairs_of_part(words: list[str], shorter: int, front: bool) -> Iterator[tuple[str, str]]:
    """Near words of a part: they share ``shorter // 2`` code points in front, or the others of ``shorter`` at the end.

    Pairs of two longer words belong to another part, and so do those of a part by the end that share the front too.
    """
    half = shorter // 2
    rest = shorter - half
    tails = sorted((w[half:] if front else w[:-rest], w) for w in words)
    acceptor = Acceptor([t for t, _ in tails])
    for i, j in acceptor.one_edit_pairs():
        x, y = tails[i][1], tails[j][1]
        if min(len(x), len(y)) == shorter and (front or x[:half] != y[:half]):
            yield x, y


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part to pairs of near words, each in both directions."""
    at, held, out = None, [], []

    def close() -> None:
        if len(held) > 1:
            counts = dict(held)
            for x, y in pairs_of_part(list(counts), at[1], at[0]):
                out.append((x, y, counts[y]))
                out.append((y, x, counts[x]))

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))]
        out.clear()
        return pa.record_batch(columns, ["word", "near", "near_n"])

    for batch in batches:
        for front, shorter, shared, word, n in zip(*[batch.column(c).to_pylist() for c in ("front", "shorter", "shared", "word", "n")]):
            if (front, shorter, shared) != at:
                close()
                at, held = (front, shorter, shared), []
                if len(out) >= 100_000:
                    yield flush()
            held.append((word, n))
    close()
    if out:
        yield flush()


def near_words(known: DataFrame) -> DataFrame:
    """``word, near, near_n``: all pairs of different words of ``word, n`` at exactly one edit, in both directions."""
    length = F.length("word")
    shorter = F.explode(F.filter(F.array(length, length - 1), lambda m: m >= SHORTEST)).alias("shorter")
    half = F.floor(F.col("shorter") / 2).cast("int")
    part = F.explode(
        F.array(
            F.struct(F.lit(True).alias("front"), F.substr("word", F.lit(1), half).alias("shared")),
            F.struct(F.lit(False).alias("front"), F.right("word", F.col("shorter") - half).alias("shared")),
        )
    )
    keys = ["front", "shorter", "shared"]
    dealt = known.select("word", "n", shorter).select("word", "n", "shorter", part.alias("part")).select("part.front", "shorter", "part.shared", "word", "n")
    return for_python(dealt).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_parts, "word string, near string, near_n bigint")


# --- groups --------------------------------------------------------------


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the end of each chain of forms, by doubling its steps.

    Counts at least double along a chain, so it is short; each round is written to the shared folder.
    """
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        path = work_dir(spark, "roots")
        on = at.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        step = at.join(on, F.col("root") == F.col("_word"), "left")
        step.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")).write.parquet(path)
        found = spark.read.parquet(path)
        at = found.select("word", "root")
        if found.where("moved").isEmpty():
            return at


def variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per word of ``doc_id, text``: its count, near words, form and root."""
    path = work_dir(spark, "vocabulary")
    vocabulary(docs).write.parquet(path)
    known = spark.read.parquet(path)
    path = work_dir(spark, "near-words")
    # The most frequent near word; equal counts: the first in code-point order, which is the order of UTF-8 bytes.
    near_words(known).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top")
    ).write.parquet(path)
    near = spark.read.parquet(path).select(F.col("word").alias("_word"), "n_near", F.col("top.near").alias("form"), (-F.col("top.less")).alias("form_n"))
    path = work_dir(spark, "forms")
    strong = F.col("form_n") >= TIMES * F.col("n")
    known.join(near, F.col("word") == F.col("_word"), "left").select(
        "word",
        F.when(strong, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(strong, F.col("form_n")).alias("form_n"),
    ).write.parquet(path)
    forms = spark.read.parquet(path)
    ends = roots(spark, forms.where("form IS NOT NULL").select("word", "form")).select(F.col("word").alias("_word"), "root")
    return forms.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, read(spark, sf_dir, "documents", "doc_id", "text"))


OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, n, length(run) AS size, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_table
), vocabulary AS (
  SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {SHORTEST} AND sum(n) >= {FEWEST}
), shorter AS (
  SELECT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM vocabulary)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.less = b.less AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN vocabulary b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN vocabulary b ON a.less = b.word
), near AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS top, max(near_n) AS top_n FROM pairs GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= {TIMES} * v.n THEN top END AS form,
    CASE WHEN top_n >= {TIMES} * v.n THEN top_n END AS form_n
  FROM vocabulary v LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, c.root FROM forms f JOIN chain c ON f.form = c.word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word)
"""
