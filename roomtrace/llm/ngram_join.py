"""N-gram Jaccard join: MinHash LSH with prefixes of one length, then exact verification.

Documents are sets of word shingles (five words; a shorter text is one shingle).
Documents with equal sets are one *node*.

1. Every node has a signature of ``TREES * HEIGHT`` min-hashes (one permutation,
   densified), in ``TREES`` stretches.  The keys are prefixes of the stretches, all
   of the one length (``depth``, 6 for these constants) that is the longest at which
   two nodes at the threshold share one with a chance of ``RECALL``.  It depends on
   the constants alone, so no trie is built or walked; values past the prefix serve
   only the comparison of step 2.  Nodes under one prefix are a bucket.
2. Each node is compared with the least node of its buckets by signature, which is
   linear, and alike ones become groups.  Buckets that still hold nodes of several
   groups are searched for further pairs across groups, in blocks; such pairs join
   their groups.  The comparison by signature only drops pairs six standard
   deviations below the threshold.
3. Inside a group all pairs are verified on their whole shingle sets, in blocks of
   nodes by products of incidence matrices.  Blocks hand on a count per node and a
   spanning forest of the links, never the pairs.
4. Links make classes: the connected components.

Result of ``join``: a row per document with its class (least ``doc_id``), the number
of documents it is linked with (similarity at or above the threshold, copies
included) and the size of its class.

A large group of copies of one text is one node.  A large group of distinct near
copies costs a verification of its pairs, spread over blocks of bounded size.

Words: as in ``tables.WORD_CLASS``, A-Z folded.  Defined cases: a text without words
(null too) has no shingles and no links and is a class of its own; repeated rows are
linked copies; a null id counts like any document, but names a class only if no
other id is there; an empty table gives no rows; other columns are ignored, or kept
by ``keep``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace.llm.decontaminate import FEW, words_of
from roomtrace.llm.graphs import components
from roomtrace.llm.tables import for_python, read
from roomtrace.llm.words import blocks as row_blocks
from roomtrace.session import work_dir

SHINGLE, THRESHOLD = 5, Fraction(4, 5)
TREES, HEIGHT, RECALL = 24, 8, 0.999
BINS = TREES * HEIGHT
#: Nodes and shingles in a block of a group, and rows in a block of a bucket.
BLOCK_NODES, BLOCK_SHINGLES, BUCKET_ROWS = 128, 1 << 18, 256


def depth(threshold: float = float(THRESHOLD), trees: int = TREES, height: int = HEIGHT, recall: float = RECALL) -> int:
    """The longest prefix that still gives the recall for pairs at the threshold."""
    d = height
    while d > 1 and 1 - (1 - threshold**d) ** trees < recall:
        d -= 1
    return d


def alike_from(a: np.ndarray, b: np.ndarray, threshold: float = float(THRESHOLD)) -> np.ndarray:
    """The share of equal min-hashes from which nodes of so many shingles are kept as maybe linked."""
    return threshold - 6 * np.sqrt(threshold * (1 - threshold) / np.minimum(np.minimum(a, b), BINS))


# --- shingles and signatures --------------------------------------------------------

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def shingle_sets(held: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    docs = [words_of(t) for t in held]
    flat = [w for d in docs for w in d]
    distinct = list(set(flat))
    number = dict(zip(distinct, range(len(distinct))))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    own = hashes[np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))]
    out, at = [], 0
    for d in docs:
        h = own[at : at + len(d)]
        at += len(d)
        size = min(SHINGLE, len(h))
        if not size:
            out.append(np.empty(0, np.uint64))
            continue
        rolled = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            rolled = (rolled ^ h[k : len(h) - size + 1 + k]) * _A
            rolled ^= rolled >> np.uint64(31)
        out.append(np.unique(_mix(rolled)))
    return out


_PROBES = np.random.default_rng(20240229).integers(0, BINS, (64, BINS))
_NO = np.uint64(0xFFFFFFFFFFFFFFFF)


def signature(shingles: np.ndarray) -> np.ndarray:
    """One-permutation min-hashes; empty bins take a value from others, in an order fixed for each bin."""
    sig = np.full(BINS, _NO)
    np.minimum.at(sig, (shingles % np.uint64(BINS)).astype(np.int64), _mix(shingles + np.uint64(1)))
    filled = sig != _NO
    empty = np.flatnonzero(~filled)
    out = sig.copy()
    for probe in _PROBES:
        if not len(empty):
            return out
        source = probe[empty]
        there = filled[source]
        out[empty[there]] = sig[source[there]] + empty[there].astype(np.uint64)
        empty = empty[~there]
    full = np.flatnonzero(filled)
    if len(empty) and len(full):
        out[empty] = sig[full[np.searchsorted(full, empty) % len(full)]] + empty.astype(np.uint64)
    return out


def prefixes(sig: np.ndarray, d: int) -> np.ndarray:
    """A hash of the first ``d`` values under each tree."""
    label = np.arange(1, TREES + 1, dtype=np.uint64)
    for column in sig.reshape(TREES, HEIGHT).T[:d]:
        label = _mix((label ^ column) * _A + np.uint64(1))
    return label.view(np.int64)


def _profiles(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, held in row_blocks(batch):
            sets = shingle_sets(held)
            with np.errstate(over="ignore"):
                nodes = [int(_mix(np.array([s.sum(dtype=np.uint64) + np.uint64(len(s))])).view(np.int64)[0]) for s in sets]
                signs = [signature(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_key"),
                    pa.array(nodes, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([None if s is None else s.astype("<u2").tobytes() for s in signs], pa.binary()),
                    pa.array([[] if s is None else prefixes(s, d) for s in signs], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "node", "n", "sig", "labels"],
            )


# --- groups of rows in a stream ---------------------------------------------------------


def by_key(rows: DataFrame, keys: list[str], use: Callable, schema: str) -> DataFrame:
    """``use`` on the rows of each key, as a dict of arrays; keys are dealt out by hash, their rows are sorted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            ends = _ends(held, keys)
            # The last key may go on in the next batch.
            for a, b in zip(ends[:-2], ends[1:-1]):
                yield from use(held.slice(a, b - a))
            held = held.slice(ends[-2]) if len(ends) > 1 else held
        if held is not None and held.num_rows:
            yield from use(held)

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return for_python(dealt).mapInArrow(run, schema)


def _ends(table: pa.Table, keys: list[str]) -> list[int]:
    if not table.num_rows:
        return [0]
    change = np.zeros(table.num_rows - 1, bool)
    for key in keys:
        column = table.column(key).to_numpy()
        change |= column[1:] != column[:-1]
    return [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first row of each component of a symmetric matrix."""
    root = np.arange(len(linked))
    todo = set(range(len(linked)))
    while todo:
        start = min(todo)
        front = np.array([start])
        seen = np.zeros(len(linked), bool)
        seen[start] = True
        while len(front):
            reached = linked[front].any(0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached)
        root[seen] = start
        todo -= set(np.flatnonzero(seen).tolist())
    return root


def _signs(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BINS)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _alike_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            share = (_signs(batch.column("sig")) == _signs(batch.column("hub_sig"))).mean(1)
            n, m = (batch.column(c).to_numpy() for c in ("n", "hub_n"))
            ok = share >= alike_from(n, m)
            yield _edges(batch.column("node").to_numpy()[ok], batch.column("hub").to_numpy()[ok])


def _alike_across(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Groups that meet in a block of a bucket: pairs across groups that are alike, as a spanning forest."""
    signs, n = _signs(table.column("sig")), table.column("n").to_numpy()
    group, nodes = table.column("root").to_numpy(), table.column("node").to_numpy()
    _, first = np.unique(nodes, return_index=True)
    signs, n, group = signs[first], n[first], group[first]
    linked = np.zeros((len(n), len(n)), bool)
    for i in range(len(n)):
        linked[i] = ((signs == signs[i]).mean(1) >= alike_from(n, n[i])) & (group != group[i])
    root = _roots(linked | linked.T)
    apart = group != group[root]
    yield _edges(group[apart], group[root][apart])


def _verified(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links of one pair of blocks of a group: per node the linked documents, and a spanning forest."""
    nodes, block = table.column("node").to_numpy(), table.column("block").to_numpy()
    size, same = table.column("size").to_numpy(), table.column("i")[0].as_py() == table.column("j")[0].as_py()
    _, first = np.unique(nodes, return_index=True)
    texts = table.column("text").to_pylist()
    sets = shingle_sets([texts[k] or "" for k in first])
    nodes, block, size = nodes[first], block[first], size[first]
    n = np.array([len(s) for s in sets], np.int64)
    shared = shared_counts(sets)
    union = n[:, None] + n[None, :] - shared
    linked = (shared * THRESHOLD.denominator >= union * THRESHOLD.numerator) & (shared > 0)
    np.fill_diagonal(linked, False)
    if not same:
        linked &= block[:, None] != block[None, :]
    counts = linked @ size
    root = nodes[_roots(linked)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(root, pa.int64())], ["node", "links", "root"]
    )


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Shingles that each two sets share, by products of incidence matrices of ``width`` shingles at a time."""
    out = np.zeros((len(sets), len(sets)), np.int64)
    if not sets:
        return out
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, kinds = np.unique(flat, return_inverse=True, return_counts=True)
    out[np.diag_indices(len(sets))] = np.bincount(row, minlength=len(sets))
    often = kinds[column] > 1
    row, column = row[often], column[often]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    sums = np.zeros(out.shape, np.float64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        seen = np.zeros((len(sets), width), np.float32)
        seen[row[a:b], column[a:b] - start] = 1
        sums += seen @ seen.T
    off = ~np.eye(len(sets), dtype=bool)
    out[off] = sums[off].astype(np.int64)
    return out


# --- the join -------------------------------------------------------------------------------


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = work_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def profiles(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, node, n, sig, labels`` of each document, written."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = depth()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = for_python(keyed).mapInArrow(
        lambda batches: _profiles(batches, d),
        f"doc_id {kind}, text_key bigint, node bigint, n bigint, sig binary, labels array<bigint>",
    )
    return _kept(rows, "profiles")


def groups(found: DataFrame) -> DataFrame:
    """``node, unit``: nodes that may be linked share a unit; nodes without any partner are left out."""
    labels = found.select(F.explode("labels").alias("label"), "node")
    # Copies of one node don't make a bucket.
    buckets = labels.groupBy("label").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last")
    members = _kept(labels.join(buckets.select("label", "hub"), "label").distinct(), "buckets")
    there = members.select("node").distinct()
    signs = _kept(
        found.join(there, "node", "left_semi").select("node", "n", "sig").dropDuplicates(["node"]), "signatures"
    )
    stars = members.where("node <> hub").select("node", "hub").distinct()
    of_hub = signs.toDF("hub", "hub_n", "hub_sig")
    near = for_python(stars.join(signs, "node").join(of_hub, "hub")).mapInArrow(_alike_stars, "a bigint, b bigint")
    near = _kept(near, "stars")
    first = components(near)
    rooted = members.select("label", "node").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = (
        rooted.groupBy("label")
        .agg(F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high AND rows > 2")
    )
    parts = F.ceil(F.col("rows") / BUCKET_ROWS).cast("int")
    across = (
        rooted.join(mixed.select("label", parts.alias("parts")), "label")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "root")
        .join(signs, "node")
    )
    more = _kept(by_key(across, ["label", "i", "j"], _alike_across, "a bigint, b bigint").distinct(), "across")
    second = components(more).toDF("root", "unit")
    return first.join(second, "root", "left").select("node", F.coalesce("unit", "root").alias("unit")).unionByName(
        # Groups of one node that another group was joined to.
        second.join(first.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), "unit")
    )


def links(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, links`` (documents linked with a node's, other than its own) and ``a, b`` that span the links."""
    nodes = found.groupBy("node").agg(
        F.count("*").alias("size"), F.min(F.struct("doc_id", "text_key")).alias("rep"), F.max("n").alias("n")
    )
    units = _kept(groups(found).join(nodes, "node"), "units")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK_NODES, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    split = units.groupBy("unit").agg(parts.alias("parts"))
    own = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    keyed = units.join(split, "unit").select(
        "unit",
        "node",
        "size",
        "parts",
        F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("block"),
        F.col("rep.doc_id").alias("rep_id"),
        F.col("rep.text_key").alias("text_key"),
    )
    # So few rows are brought to the texts; more meet them by shuffle.
    few = F.broadcast(keyed) if units.count() <= FEW else keyed
    work = (
        own.join(few, (own.text_key == few.text_key) & own.doc_id.eqNullSafe(few.rep_id))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select(
            "unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "size", "text"
        )
    )
    done = _kept(by_key(work, ["unit", "i", "j"], _verified, "node bigint, links bigint, root bigint"), "links")
    return done.groupBy("node").agg(F.sum("links").alias("links")), done.where("node <> root").select(
        F.col("node").alias("a"), F.col("root").alias("b")
    )


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, class_id, n_links, class_size, leads``; one row of a class leads."""
    found = profiles(docs)
    counts, spanning = links(docs, found)
    roots = components(spanning)
    rows = (
        found.select("doc_id", "text_key", "node", "n")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("alone", F.col("n") == 0)
    )
    named = F.struct(
        F.when(F.col("alone"), F.struct("doc_id", "text_key")).alias("own"),
        F.when(~F.col("alone"), F.coalesce("root", "node")).alias("root"),
    )
    rows = rows.withColumn("class", named)
    # Ids may be null; the first row of a class leads, and its least id names it.
    heads = rows.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct("doc_id", "text_key")).alias("head")
    )
    copies = found.where("n > 0").groupBy("node").agg(F.count("*").alias("copies"))
    joined = rows.join(heads, "class").join(copies, "node", "left")
    return joined.select(
        "doc_id",
        "text_key",
        F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("alone"), F.lit(0).cast("bigint"))
        .otherwise(F.coalesce("links", F.lit(0).cast("bigint")) + F.col("copies") - 1)
        .alias("n_links"),
        F.when(F.col("alone"), F.lit(1).cast("bigint")).otherwise(F.col("class_size")).alias("class_size"),
        (F.col("alone") | (F.struct("doc_id", "text_key") == F.col("head"))).alias("leads"),
    )


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links, class_size``."""
    return classes(docs).drop("text_key", "leads")


def keep(docs: DataFrame) -> DataFrame:
    """One row of each class, the one with the least id; the columns of ``docs`` stay as they are.

    The rows come in partitions of about equal size, whatever is left where.
    """
    found = _kept(classes(docs), "classes")
    key = F.struct(F.col("doc_id"), F.xxhash64("text"))
    own = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"))

    def keys(rows: DataFrame) -> DataFrame:
        out = rows.select(F.struct("doc_id", "text_key").alias("_key")).distinct()
        return F.broadcast(out) if out.count() <= FEW else out

    left = own.join(keys(found.where("NOT leads")), "_key", "left_anti")
    # Rows equal in id and text lead together; one of them stays.
    twice = found.where("leads AND class_size > 1").groupBy("doc_id", "text_key").agg(F.count("*").alias("rows")).where("rows > 1")
    again = keys(twice)
    return left.join(again, "_key", "left_anti").select("_row.*").unionByName(
        left.join(again, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
    ).hint("rebalance")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents", "doc_id", "text"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[p : p + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 5 * k >= 4 * (na.n + nb.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), classes AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY a)
SELECT doc_id, class_id, (SELECT count(*) FROM links WHERE a = classes.doc_id)::BIGINT AS n_links, class_size::BIGINT AS class_size
FROM classes
"""
