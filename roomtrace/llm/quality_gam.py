"""Quality classifier: a generalised additive model with pairwise interactions.

``features`` turns a whole text into a few numbers (never its id, language or
source).  ``fit`` learns, for every feature, a table with one value per bin: in
cycles over the features, a tree of at most four leaves is fitted to the
gradient of the log loss and added to the feature's table with a small step.
Then the pairs of features that would still gain most get a two-way table each,
learned the same way.  A score is the sigmoid of a sum of table entries, looked
up for whole batches at once.

The model is fitted on at most ``FIT_ROWS`` labelled ids, half of them per
label where there are enough, those with the smallest hashes of ``doc_id``; a
repeated id counts once, with the text of the smallest hash; weights restore the shares of the labels.  Documents with ``held_out``
(crc32 of the id as text, modulo 3, is 1) are never learned from.  Every document
is scored.

Defined cases: null text is empty; repeated labels count once, ids labelled both
ways and null ids are not learned from; without labels of both kinds the score is
the share of label 1, or 0.5 without any; repeated rows get equal scores; an
empty table gives no rows; other columns are ignored, or kept by ``keep``.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from roomtrace.llm.tables import for_python, read
from roomtrace.llm.words import texts

FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 12, 6
ROUNDS, STEP, SHRINK = 150, 0.2, 5.0

FEATURES = [
    "log words", "word length", "longest word", "distinct words", "words like the one before", "capitals",
    "digits", "symbols", "bars", "exclamation marks", "sentence marks", "beyond ascii", "log lines", "repeated lines",
]
#: Kinds of bytes: 1 capital, 2 digit, 3 symbol, 4 bar, 5 exclamation mark, 6 sentence mark, 7 beyond ASCII (continuation).
_KIND = np.zeros(256, np.uint8)
for _kind, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~=+_\\", b"|", b"!", b".,;:?"), 1):
    _KIND[list(_chars)] = _kind
_KIND[128:192] = 7


def features(text: str) -> list[float]:
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(_KIND[raw], minlength=8)
    # Capitals of Latin-1 are two bytes, the second between 80 and 9E.
    high = int(np.count_nonzero((raw[:-1] == 0xC3) & (raw[1:] < 0x9F))) if len(raw) else 0
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    again = sum(map(operator.eq, words, words[1:])) if len(words) > 1 else 0
    lines = [x for x in text.split("\n") if x]
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        max(map(len, words), default=0),
        len(set(words)) / n,
        again / n,
        (counts[1] + high) / chars,
        counts[2] / chars,
        counts[3] / n,
        counts[4] / n,
        counts[5] / n,
        counts[6] / n,
        counts[7] / chars,
        np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    ]


# --- the model ---------------------------------------------------------------


@dataclass
class Model:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    #: Two features, their coarser edges, and their table.
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for a, b, table in self.pairs:
            total += table[
                np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")
            ]
        return sigmoid(total)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    """Edges between the distinct values at even quantiles."""
    marks = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1), method="nearest"))
    return (marks[1:] + marks[:-1]) / 2


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of a run of bins, and what it gains; cut 0 is none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A value per bin: a tree of depth two on sums of gradients and curvatures."""
    out = np.zeros(len(g))
    _, cut = _split(g, h)
    for side in (slice(0, cut), slice(cut, len(g))):
        gs, hs = g[side], h[side]
        _, inner = _split(gs, hs)
        for a, b in ((0, inner), (inner, len(gs))):
            if b > a:
                out[side][a:b] = gs[a:b].sum() / (hs[a:b].sum() + SHRINK)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A value per cell and the gain: one cut of the first feature, one of the second on either side."""
    best: tuple[float, np.ndarray] = (0.0, np.zeros_like(g))
    for cut in range(1, g.shape[0]):
        out, gain = np.zeros_like(g), -float(_gain(g.sum(), h.sum()))
        for rows in (slice(0, cut), slice(cut, g.shape[0])):
            gs, hs = g[rows].sum(0), h[rows].sum(0)
            _, inner = _split(gs, hs)
            for cols in (slice(0, inner), slice(inner, g.shape[1])):
                if cols.stop > cols.start:
                    gain += float(_gain(gs[cols].sum(), hs[cols].sum()))
                    out[rows, cols] = gs[cols].sum() / (hs[cols].sum() + SHRINK)
        if gain > best[0]:
            best = gain, out
    return best


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Model:
    weight = np.ones(len(y)) if weight is None else weight
    share = float(np.average(y, weights=weight)) if len(y) else 0.5
    model = Model(float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6))))
    if len(set(y.tolist())) < 2:
        return model
    width = x.shape[1]
    model.edges = [cut_points(x[:, j], BINS) for j in range(width)]
    model.coarse = [cut_points(x[:, j], PAIR_BINS) for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    far = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(total)
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            size = len(model.tables[j])
            change = STEP * tree(np.bincount(at[j], g, size), np.bincount(at[j], h, size))
            model.tables[j] += change
            total += change[at[j]]

    def grid(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        cell = far[a] * shape[1] + far[b]
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    g, h = slopes()
    gains = sorted(((pair_tree(*grid(a, b, g, h))[0], a, b) for a in range(width) for b in range(a + 1, width)), reverse=True)
    model.pairs = [(a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))) for gain, a, b in gains[:PAIRS] if gain > 0]
    for _ in range(ROUNDS // 5):
        for a, b, table in model.pairs:
            g, h = slopes()
            change = STEP * pair_tree(*grid(a, b, g, h))[1]
            table += change
            total += change[far[a], far[b]]
    return model


# --- over tables ---------------------------------------------------------------


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.float64()))], ["label", "x"])


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from the labelled ids of ``docs`` that are not held out, each with one of its texts; at most ``rows`` of them come to the driver."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where((F.col("label") == F.col("most")) & ~held_out(F.col("doc_id")))
        .select("doc_id", "label")
    )
    there = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sizes = {r.label: r.n for r in there.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # The labels' halves; what one lacks the other may use.
    least = min(sizes.get(0, 0), sizes.get(1, 0), rows // 2)
    chosen = [
        there.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows - least if n > rows // 2 else n)
        for label, n in sizes.items()
    ]
    if not chosen:
        return Model(0.0)
    sample = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    # At most ``rows`` ids and labels.
    joined = docs.join(F.broadcast(sample), "doc_id")
    # Of a repeated id the text with the least hash, so that it counts once.
    one_each = joined.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    picked = one_each.select("label", "least.text")
    found = for_python(picked).mapInArrow(_features_of, "label int, x array<double>").toArrow()
    if not found.num_rows:
        return Model(0.0)
    y = np.asarray(found["label"], float)
    x = np.array(found["x"].to_pylist())
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    weight = np.ones(len(y))
    for label, n in sizes.items():
        weight[y == label] = n / max(1, np.count_nonzero(y == label)) / max(1, sum(sizes.values())) * len(y)
    return fit(x, y, weight)


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the score to every row of ``docs``, which has a ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in texts(batch)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*batch.schema.names, name])

    return for_python(docs).mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least a half; its columns stay as they are."""
    scored = with_score(docs, train(docs.select("doc_id", "text"), labels), "_quality_score")
    return scored.where("_quality_score >= 0.5").drop("_quality_score")


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return with_score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
