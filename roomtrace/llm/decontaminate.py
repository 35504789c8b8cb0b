r"""Benchmark decontamination by a distributed positional inverted index.

``build`` cuts the documents into segments of about ``SEGMENT`` words, whole
documents each, and stores for every segment the postings of all its words: per
word the ascending positions in the segment, as gaps in byte-aligned coding.  A
segment is one row, its size is bounded, and no posting is ever shuffled.

``search`` looks for the windows of test items (``WINDOW`` consecutive words; a
shorter item is one window).  In each segment a window starts from the postings of
its rarest word there, shifted to where the window would begin; they are
intersected with the shifted lists of the other words from rare to common, and
nothing is left of most windows after one or two steps.  With ``slop`` above 0 each
word may stand up to that many places off (proximity matches).  Positions leave a
gap between documents, so no match crosses a border.

Test items go to the workers in blocks of at most ``BLOCK_BYTES``, as many as
there are; blocks are chosen by hash, and the matches of all blocks are put
together per document.

Words: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` with A-Z folded to a-z.  Defined cases:
null text has no words and no hits, an item without words has no window; a null
item id is reported as ``null``; items that share an id are one item; repeated
rows are rows of their own; empty tables give no rows or no hits; other columns
are ignored, or kept by ``keep``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import for_python, read
from roomtrace.llm.token_files import pack_ids, unpack_ids
from roomtrace.llm.words import texts
from roomtrace.session import work_dir

WINDOW = 13
SEGMENT = 1 << 18
#: Free positions between documents; ``slop`` must be smaller.
GAP = 64
BLOCK_BYTES = 16 << 20
#: Keys that may be broadcast when their documents are taken out; more are joined by shuffle.
FEW = 500_000

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


# --- the index ------------------------------------------------------------------


def _segment(name: str, docs: list, counts: list[int], words: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
    sizes = np.array(counts, np.int64)
    starts = np.cumsum(sizes + GAP) - sizes - GAP
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(words))
    terms = list(set(words))
    number = dict(zip(terms, range(len(terms))))
    ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    tallies = np.bincount(ids, minlength=len(terms))
    positions = at[np.argsort(ids, kind="stable")]
    gaps = np.diff(positions, prepend=0)
    first = np.cumsum(tallies) - tallies
    gaps[first] = positions[first]
    control, data = pack_ids(gaps)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name]), pa.array([docs], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64())),
            pa.array([terms], pa.list_(pa.binary())), pa.array([tallies], pa.list_(pa.int64())),
            pa.array([control], pa.binary()), pa.array([data], pa.binary()),
        ],
        ["segment", "docs", "words", "terms", "counts", "control", "data"],
    )


def build(docs: DataFrame, folder: str, key: str = "doc_id", segment: int = SEGMENT) -> None:
    """Writes the index of ``key, text``."""
    kind = docs.schema[key].dataType.simpleString()
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        keys: list = []
        counts: list[int] = []
        words: list[bytes] = []
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), texts(batch)):
                found = words_of(text)
                keys.append(name)
                counts.append(len(found))
                words += found
                if len(words) >= segment:
                    yield _segment(f"{part}-{made}", keys, counts, words, arrow_kind)
                    made += 1
                    keys, counts, words = [], [], []
        if keys:
            yield _segment(f"{part}-{made}", keys, counts, words, arrow_kind)

    for_python(docs.select(key, "text")).mapInArrow(
        run,
        f"segment string, docs array<{kind}>, words array<bigint>, terms array<binary>, counts array<bigint>,"
        " control binary, data binary",
    ).write.parquet(folder)


# --- searching --------------------------------------------------------------------


def windows_of(items: list[tuple[str, str | None]], size: int = WINDOW) -> list[tuple[str, list[bytes]]]:
    """Each window once per item id."""
    found = {}
    for name, text in items:
        words = words_of(text or "")
        for at in range(max(1, len(words) - size + 1)) if words else ():
            window = words[at : at + size]
            found[name, tuple(window)] = (name, window)
    return list(found.values())


class Postings:
    """The postings of one segment, as far as test items use them."""

    def __init__(self, row: dict, wanted: Container[bytes]) -> None:
        counts = np.asarray(row["counts"].values)
        gaps = unpack_ids(row["control"].as_buffer(), row["data"].as_buffer(), int(counts.sum()) if len(counts) else 0)
        ends = np.cumsum(counts)
        self.lists: dict[bytes, np.ndarray] = {}
        for i, term in enumerate(row["terms"].values.to_pylist()):
            if term in wanted:
                self.lists[term] = np.cumsum(gaps[ends[i] - counts[i] : ends[i]], dtype=np.int64)

    def starts(self, window: list[bytes], slop: int) -> np.ndarray:
        """Where a window begins."""
        lists = []
        for at, word in enumerate(window):
            found = self.lists.get(word)
            if found is None:
                return _NONE
            lists.append((len(found), at, found))
        lists.sort(key=lambda x: x[:2])
        _, at, rarest = lists[0]
        starts = rarest - at
        for _, at, found in lists[1:]:
            wanted = starts + at
            near = np.searchsorted(found, wanted - slop)
            starts = starts[(near < len(found)) & (found[np.minimum(near, len(found) - 1)] <= wanted + slop)]
            if not len(starts):
                return _NONE
        return starts


_NONE = np.empty(0, np.int64)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def search(spark: SparkSession, folder: str, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``segment, nth, key, n_words, matches`` for every indexed document.

    ``matches`` has the spans of words, from 0, that windows of an item cover:
    array of ``item_id, start, end``.
    """
    index = spark.read.parquet(folder)
    kind = index.schema["docs"].dataType.elementType.simpleString()
    held = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    weight = held.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + F.length("item_id"))).first()[0] or 0
    blocks = -(-weight // BLOCK_BYTES) or 1
    schema = (
        f"segment string, nth int, key {kind}, n_words bigint,"
        " matches array<struct<item_id:string,start:bigint,end:bigint>>"
    )
    found = None
    for block in range(blocks):
        # About BLOCK_BYTES of test items.
        rows = held.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        matched = for_python(index).mapInArrow(_Search(windows_of([tuple(r) for r in rows], window), slop), schema)
        found = matched if found is None else found.unionByName(matched)
    if blocks == 1:
        return found
    return found.groupBy("segment", "nth").agg(
        F.first("key").alias("key"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches")
    )


class _Search:
    def __init__(self, windows: list[tuple[str, list[bytes]]], slop: int) -> None:
        if slop >= GAP // 2:
            raise ValueError(f"slop must be below {GAP // 2}")
        self.windows, self.slop = windows, slop
        self.wanted: dict[bytes, int] = {}
        for _, window in windows:
            for w in window:
                self.wanted.setdefault(w, len(self.wanted))
        # Words of the windows by number; a shorter one repeats its last word.
        longest = max((len(window) for _, window in windows), default=0)
        numbers = [self.wanted[w] for _, window in windows for w in window + window[-1:] * (longest - len(window))]
        self.numbers = np.array(numbers, np.int32).reshape(len(windows), longest)

    def possible(self, postings: "Postings") -> list[int]:
        """Windows all of whose words are in the segment."""
        there = np.zeros(len(self.wanted), bool)
        there[[self.wanted[w] for w in postings.lists]] = True
        return np.flatnonzero(there[self.numbers].all(axis=1)).tolist() if len(self.windows) else []

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield self.segment({c: batch.column(c)[k] for c in batch.schema.names})

    def segment(self, row: dict) -> pa.RecordBatch:
        postings = Postings(row, self.wanted)
        sizes = np.asarray(row["words"].values)
        begins = np.cumsum(sizes + GAP) - sizes - GAP
        spans: dict[int, dict[str, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for at in self.possible(postings):
            item, window = self.windows[at]
            for start in postings.starts(window, self.slop).tolist():
                doc = int(np.searchsorted(begins, start + self.slop, "right")) - 1
                first = start - int(begins[doc])
                spans[doc][item].append((max(0, first), min(first + len(window), int(sizes[doc]))))
        matches = [
            [
                {"item_id": item, "start": a, "end": b}
                for item, found in sorted(spans[doc].items())
                for a, b in _merged(found)
            ]
            if doc in spans
            else []
            for doc in range(len(sizes))
        ]
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row["segment"].as_py()] * len(sizes), pa.string()), pa.array(range(len(sizes)), pa.int32()),
                row["docs"].values, pa.array(sizes, pa.int64()), pa.array(matches, kind),
            ],
            ["segment", "nth", "key", "n_words", "matches"],
        )


def hit_words(matches: Column) -> Column:
    """Words in at least one span."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("to"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda s, m: F.struct(
            F.greatest(s["to"], m["end"]).alias("to"),
            (s["n"] + F.greatest(F.lit(0).cast("bigint"), m["end"] - F.greatest(s["to"], m["start"]))).alias("n"),
        ),
        lambda s: s["n"],
    )


def verdicts(found: DataFrame) -> DataFrame:
    """Adds ``n_hit, items, contaminated``: hit words are at least one in twenty."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    rows = found.withColumns({"n_hit": hit_words(F.col("matches")), "items": items})
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def keep(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; its columns stay as they are."""
    spark = docs.sparkSession
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64("text")))
    folder, bad_folder = work_dir(spark, "postings"), work_dir(spark, "contaminated")
    build(docs.select(key.alias("key"), "text"), folder, "key")
    verdicts(search(spark, folder, items)).where("contaminated").select("key").distinct().write.parquet(bad_folder)
    bad = spark.read.parquet(bad_folder).withColumnRenamed("key", "_key")
    if bad.count() <= FEW:
        bad = F.broadcast(bad)
    own = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"))
    return own.join(bad, "_key", "left_anti").select("_row.*")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "postings")
    build(read(spark, sf_dir, "documents", "doc_id", "text"), folder)
    return verdicts(search(spark, folder, read(spark, sf_dir, "benchmark", "item_id", "text"))).select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN lengths WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, dw.n, s, item_id FROM dw JOIN bw ON dw.phrase = bw.phrase AND dw.n = bw.n
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
