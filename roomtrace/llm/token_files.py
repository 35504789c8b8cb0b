"""Token ids in files: ids by frequency, in byte-aligned variable length with separate control bytes.

Ids are replaced by their rank of frequency, so common ones take one byte.  Four
ranks share a control byte, two bits each for their number of bytes (1 to 4);
control and data bytes are kept apart.  Reading looks up in a table, by control
byte, which data bytes make up the four values, whole blocks at once in numpy.

A file set is a folder with three Parquet tables, written by Spark, so lost tasks
are simply done again:

* ``blocks``: ``part, block, start, doc_ids, counts, control, data``: documents
  in ascending ``doc_id``, about ``BLOCK`` ids a block, documents whole;
* ``parts``: ``part, base``: ids in all parts before;
* ``ranks``: ``rank, id``: at most one row per id of the vocabulary.

Documents are dealt out in ranges of (doc_id, hash of text), so rows that share an
id are spread too.  Only ``parts`` and ``ranks`` ever come to the driver: one row
per file and one per vocabulary entry.

Texts are split at blanks, line ends and single marks, where this tokenizer always
splits, and distinct stretches are given to the tokenizers library once per worker (bounded,
see ``WordTable``).

Defined cases: null text is empty and holds the end id alone; a null ``doc_id``
sorts first; rows that share an id go by hash of text, then text; an empty table
gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import read as read_table, for_python, text_or_empty
from roomtrace.llm.trie_bpe import byte_characters
from roomtrace.llm.words import WordTable, blocks
from roomtrace.session import work_dir

#: Ids in a block, about.
BLOCK = 1 << 17
#: Number of the row that holds the counts of a task's ids, behind its blocks.
TALLY = -1
END_ID = 1

# --- the code of a block --------------------------------------------------

#: By control byte: bytes of each value, bytes of all four, and the source of each of 16 output bytes (16: a zero).
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_TOTALS = _LENGTHS.sum(1)
_FIRST = np.cumsum(_LENGTHS, 1) - _LENGTHS
_SOURCE = np.where(
    np.arange(4) < _LENGTHS[:, :, None], _FIRST[:, :, None] + np.arange(4), 16
).reshape(256, 16)


def pack_ids(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    """``n`` values from their control and data bytes."""
    codes = np.frombuffer(control, np.uint8)
    # Padding values take a byte each in the totals but have none in the data.
    stream = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(32, np.uint8)])
    totals = _TOTALS[codes]
    starts = np.cumsum(totals) - totals
    source = _SOURCE[codes]
    out = np.where(source < 16, stream[starts[:, None] + np.minimum(source, 15)], 0).astype(np.uint8)
    return out.reshape(-1).view("<u4")[:n]


# --- tokenizing -------------------------------------------------------------

class Words:
    """Ids of distinct stretches of text between blanks.

    A Latin-1 word goes to the library's model directly, in lower case and byte
    characters, which is what the library's own normalizing and splitting make of
    it.  All else goes through the whole library.
    """

    def __init__(self, coder) -> None:
        self.coder, self.model = coder, coder.model
        self.bytes = {b: c for c, b in byte_characters().items()}

    def __call__(self, new: list[str]) -> list[list[int]]:
        out, others, tokenize = [], [], self.model.tokenize
        for i, word in enumerate(new):
            if not word.isalpha():
                coded = None
            elif word.isascii():
                coded = word.lower()
            else:
                coded = word.lower().encode().decode("latin-1").translate(self.bytes) if max(word) <= "\xff" else None
            if coded is None:
                others.append(i)
                out.append([])
            else:
                out.append([t.id for t in tokenize(coded)])
        for i, e in zip(others, self.coder.encode_batch_fast([new[i] for i in others], add_special_tokens=False)):
            out[i] = e.ids
        return out


#: A full stop or comma before a blank that is not the only mark there.
_RUN = re.compile("(?<![a-z0-9\u00e0-\u00f6\u00f8-\u00ff\u00df])[.,] ")


def stretches(text: str) -> list[str]:
    """The text in parts that the tokenizer treats one by one: cut at blanks, in Latin-1 texts also before a single mark."""
    text = text.replace("\n", " ")
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split(" ")
    text = text.lower() + " "
    if _RUN.search(text) is None:
        text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


_TOKENIZERS: dict[str, tuple] = {}


def tokenizer(path: str):
    """The tokenizer of a worker and its table of words."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(path)
        table = WordTable(Words(coder), 400_000)
        _TOKENIZERS.clear()
        _TOKENIZERS[path] = coder, table, [t.content for t in coder.get_added_tokens_decoder().values()]
    return _TOKENIZERS[path]


def token_ids(held: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts one after another, and the number of each."""
    coder, table, special = tokenizer(path)
    words: list[str] = []
    ends = []
    for text in held:
        # A written-out special token may stand anywhere, so such a text is not split.
        words += [text] if any(map(text.__contains__, special)) else stretches(text)
        ends.append(len(words))
    ids, lengths = table.encode(words)
    upto = np.concatenate([[0], np.cumsum(lengths)])[np.array([0, *ends], np.int64)]
    return ids, np.diff(upto)


def _stage(path: str, end_id: int, batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Blocks of ids, then one row, of block ``TALLY``, whose ``counts`` are how often each id occurs in them."""
    part = TaskContext.get().partitionId()
    block, start, held_ids, held_docs, held_counts = 0, 0, [], [], []
    tally = np.zeros(max(tokenizer(path)[0].get_vocab_size(), end_id + 1), np.int64)
    narrow = np.dtype("<u2" if len(tally) <= 1 << 16 else "<u4")

    def row(block: int, docs: list, counts: np.ndarray, ids: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                pa.array([docs], pa.list_(kind)), pa.array([counts], pa.list_(pa.int64())), pa.array([ids], pa.binary()),
            ],
            ["part", "block", "start", "doc_ids", "counts", "ids"],
        )

    def flush() -> pa.RecordBatch:
        nonlocal block, start, tally
        flat = np.concatenate(held_ids)
        found = np.bincount(flat, minlength=len(tally))
        found[: len(tally)] += tally
        tally = found
        out = row(block, [d for x in held_docs for d in x], np.concatenate(held_counts), flat.astype(narrow).tobytes())
        block, start = block + 1, start + len(flat)
        for x in (held_ids, held_docs, held_counts):
            x.clear()
        return out

    size = 0
    for batch in batches:
        for rows, held in blocks(batch, 1 << 19):
            ids, counts = token_ids(held, path)
            ends = np.cumsum(counts)
            held_ids.append(np.insert(ids, ends, end_id))
            held_counts.append(counts + 1)
            held_docs.append(rows.column(0).to_pylist())
            size += len(ids) + len(counts)
            if size >= BLOCK:
                yield flush()
                size = 0
    if held_ids:
        yield flush()
    yield row(TALLY, [], tally, b"")


def _staged_ids(ids: pa.BinaryScalar, counts: pa.ListScalar) -> np.ndarray:
    """Ids of a block as numbers; they were staged in two bytes each where the vocabulary allows it."""
    raw = ids.as_buffer()
    n = int(np.asarray(counts.values).sum())
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Writes the file set of ``doc_id, text`` with the tokenizer at ``path`` (the same on every machine)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow_kind = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    staged = work_dir(spark, "token-ids")
    for_python(dealt.select("doc_id", "text")).mapInArrow(
        lambda batches: _stage(path, end_id, batches, arrow_kind),
        f"part int, block int, start bigint, doc_ids array<{kind}>, counts array<bigint>, ids binary",
    ).write.parquet(staged)
    staging = spark.read.parquet(staged)
    stage = staging.where(F.col("block") != TALLY)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                found = np.asarray(counts.values)
                total = np.pad(total, (0, max(0, len(found) - len(total))))
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    # A row per task that staged, summed where they are read.
    tally = staging.where(F.col("block") == TALLY).select("counts")
    tallies = for_python(tally).mapInArrow(counted, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # One row per entry of the vocabulary that occurs.
    ranked = [r.id for r in sorted(tallies.collect(), key=lambda r: (-r.n, r.id))]
    spark.createDataFrame(list(enumerate(ranked)), "rank bigint, id bigint").write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ranked, default=-1) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams = [pack_ids(rank_of[_staged_ids(ids, n)]) for ids, n in zip(batch.column("ids"), batch.column("counts"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([c for c, _ in streams], pa.binary()), pa.array([d for _, d in streams], pa.binary())],
                [*batch.schema.names[:5], "control", "data"],
            )

    for_python(stage).mapInArrow(
        coded, f"part int, block int, start bigint, doc_ids array<{kind}>, counts array<bigint>, control binary, data binary"
    ).write.parquet(f"{folder}/blocks")
    sizes = (
        spark.read.parquet(f"{folder}/blocks")
        .groupBy("part")
        .agg(F.max(F.col("start") + F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    )
    bases, base = [], 0
    for row in sorted(sizes.collect()):
        bases.append((row.part, base))
        base += row.n
    spark.createDataFrame(bases, "part int, base bigint").write.parquet(f"{folder}/parts")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, tokens`` from a file set; ``tokens`` are the ids as little-endian unsigned 32-bit integers."""
    table = spark.read.parquet(f"{folder}/blocks")
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()
    id_of = np.array([r.id for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()], "<u4")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, start, docs, counts, control, data = (batch.column(c)[k] for c in range(6))
                counts = np.asarray(counts.values)
                ends = np.cumsum(counts)
                tokens = id_of[unpack_ids(control.as_buffer(), data.as_buffer(), int(ends[-1]))]
                raw = pa.py_buffer(tokens.tobytes())
                offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.values,
                        pa.array(np.full(len(counts), part.as_py()), pa.int32()),
                        pa.array(start.as_py() + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), raw]),
                    ],
                    ["doc_id", "part", "at", "n_tokens", "tokens"],
                )

    rows = for_python(table.select("part", "start", "doc_ids", "counts", "control", "data")).mapInArrow(
        decoded, f"doc_id {kind}, part int, at bigint, n_tokens bigint, tokens binary"
    )
    # One row per file.
    bases = F.broadcast(spark.read.parquet(f"{folder}/parts"))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "tokens")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = work_dir(spark, "token-files")
    write(read_table(spark, sf_dir, "documents", "doc_id", "text"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
