"""BPE encoding by walking a trie of distinct words, and decoding.

The distinct words of a stretch of text are sorted, which is the depth-first order
of their trie: a word shares with the one before it the path to their last
common node.  At every node the *last token* of the encoding of the path so far
is kept; it is the one token that ends there and may stand after the last token
of the path before it.  Shared prefixes are therefore encoded once, and a word's
encoding is read backwards from its last node.

Two tokens may stand side by side unless some merge across their border comes
before both of its parts are merged away (``Merges.side_by_side``).

Each Python worker keeps the encodings of the words it saw (bounded, see
``WordTable``); texts are cut into pieces before a blank between words, where
no token spans, so memory doesn't grow with the length of a text.

``encode`` gives ``doc_id, ids, decoded``; ``decode`` turns ids into text.  Null
text is empty and gives no ids; repeated rows give repeated rows; an empty table
gives none; other columns are ignored.  Special tokens written out in a text are
taken as such, as the tokenizers library does by default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from tokenizers import pre_tokenizers

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import for_python, read
from roomtrace.llm.words import WordTable, blocks, gather

#: Characters of text that are put together before they are looked up.
PIECE = 1 << 20
#: Words that are looked up at once, about.
MANY = 400_000
#: Fixed value: the split of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NEVER = 1 << 30


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_characters()
        raw = {k: bytes(of[c] for c in k) for k in spec["model"]["vocab"]}
        self.vocab = {raw[k]: i for k, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            left, right = self.vocab[raw[a]], self.vocab[raw[b]]
            whole = self.vocab[raw[a] + raw[b]]
            self.merged[left, right] = (rank, whole)
            self.parts.setdefault(whole, (rank, left, right))
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._known: dict[int, bool] = {}
        self._build()
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        names = [b""] * size
        for name, i in self.vocab.items():
            names[i] = name
        for name, i in self.special.items():
            names[i] = name.encode()
        self.lengths = np.array([len(x) for x in names], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(names), np.uint8)

    def edge(self, token: int, right: int) -> list[tuple[int, int]]:
        """The parts that stand at one side of a token while it is built, each with the rank that takes it away."""
        if (found := self._edges.get((token, right))) is None:
            found, end, at = [], _NEVER, token
            while True:
                found.append((at, end))
                if at not in self.parts:
                    break
                end, at = self.parts[at][0], self.parts[at][1 + right]
            self._edges[token, right] = found
        return found

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether the border between two tokens stays.

        A merge across it happens if both parts are there at its rank.  Of equal
        merges the leftmost goes first: it takes the left part away, not the right.
        """
        key = a << 32 | b
        if (known := self._known.get(key)) is None:
            known = not any(
                (m := self.merged.get((x, y))) and m[0] < x_end and m[0] <= y_end
                for x, x_end in self.edge(a, 1)
                for y, y_end in self.edge(b, 0)
            )
            if len(self._known) > 2_000_000:
                self._known.clear()
            self._known[key] = known
        return known

    def _build(self) -> None:
        """The vocabulary as a trie; nodes are numbered, ``child`` goes down by a byte."""
        self.child: dict[int, int] = {}
        self.token_at, self.depth, self.above = [-1], [0], [(0, 0)]
        for name, token in self.vocab.items():
            node = 0
            for byte in name:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.above.append((node, byte))
                node = self.child[key]
            self.token_at[node] = token
        self.go: dict[int, int] = {}
        self._shorter: dict[int, int] = {}
        self.ending: dict[int, tuple] = {0: ()}

    def step(self, node: int, byte: int) -> int:
        """The node of the longest end of a path that begins some token, one byte further."""
        key = node << 8 | byte
        if (to := self.go.get(key)) is None:
            to = self.child.get(key)
            if to is None:
                to = self.step(self.shorter(node), byte) if node else 0
            self.go[key] = to
            self.ends_at(to)
        return to

    def shorter(self, node: int) -> int:
        """The node of the next shorter such end."""
        if node not in self._shorter:
            up, byte = self.above[node]
            self._shorter[node] = self.step(self.shorter(up), byte) if up else 0
        return self._shorter[node]

    def ends_at(self, node: int) -> tuple:
        """The tokens that end where a path reaches a node, longest first, with their lengths."""
        if (found := self.ending.get(node)) is None:
            own = ((self.token_at[node], self.depth[node]),) if self.token_at[node] >= 0 else ()
            found = self.ending[node] = own + self.ends_at(self.shorter(node))
        return found

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The encodings of distinct words, in the order of their trie."""
        coded = sorted((w.encode(), i) for i, w in enumerate(words))
        out: list[list[int]] = [[]] * len(words)
        go, ending, known, fits, special = self.go, self.ending, self._known, self.side_by_side, self.special
        # Along the path: last token, its length, and the node in the vocabulary's trie.
        before, last, length, nodes = b"", [-1], [0], [0]
        for word, where in coded:
            if words[where] in special:
                out[where] = [special[words[where]]]
                continue
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], length[shared + 1 :], nodes[shared + 1 :]
            node = nodes[-1]
            for end in range(shared + 1, len(word) + 1):
                key = node << 8 | word[end - 1]
                node = go[key] if key in go else self.step(node, word[end - 1])
                for token, size in ending[node]:
                    start = end - size
                    if not start:
                        break
                    pair = last[start] << 32 | token
                    if known[pair] if pair in known else fits(last[start], token):
                        break
                else:
                    raise ValueError(f"the vocabulary has no token for {word[end - 1 : end]!r}")
                last.append(token)
                length.append(size)
                nodes.append(node)
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= length[at]
            ids.reverse()
            out[where] = ids
            before = word
        return out

    def text_of(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        return gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes().decode("utf-8", "replace")


def _class(category: str) -> str:
    """The characters below U+0530 of a category, for a character class."""
    return "".join(f"\\u{c:04x}" for c in range(0x530) if regex.match(category, chr(c)))


class Encoder:
    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        self.words = WordTable(self.merges.encode_words)
        letter, number, blank = _class(r"\p{L}"), _class(r"\p{N}"), _class(r"\s")
        # The same split for the scripts below U+0530, in the faster module.
        self.plain = re.compile(
            f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{letter}{number}{blank}]+"
            f"|[{blank}]+(?![^{blank}])|[{blank}]+"
        )
        self.beyond = re.compile("[^\x00-\u052f]")
        self.any = regex.compile(SPLIT)
        self.cut = regex.compile(r"(?<=\S) (?=\p{L})")
        names = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.agreed: dict[str, bool] = {}

    def library_split(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def agrees(self, character: str) -> bool:
        """Whether this module knows a character as the tokenizers library does; they follow different Unicode versions."""
        if character not in self.agreed:
            probe = f"a{character}1{character} {character}  {character}!{character}"
            self.agreed[character] = self.any.findall(probe) == self.library_split(probe)
        return self.agreed[character]

    def split(self, text: str) -> list[str]:
        beyond = set(self.beyond.findall(text))
        if not beyond:
            return self.plain.findall(text)
        return self.any.findall(text) if all(map(self.agrees, beyond)) else self.library_split(text)

    def pieces(self, text: str) -> Iterator[str]:
        """The text in stretches that are tokenized independently."""
        at = 0
        while len(text) - at > PIECE:
            found = self.cut.search(text, at + PIECE)
            if found is None:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:] if at else text

    def ids(self, held: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and the number of ids of each text."""
        counts = np.zeros(len(held), np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []  # a text, and how many words there are with it
        done: list[np.ndarray] = []

        def look_up() -> None:
            ids, lengths = self.words.encode(words)
            upto = np.concatenate([[0], np.cumsum(lengths)])
            at = 0
            for owner, end in owners:
                counts[owner] += upto[end] - upto[at]
                at = end
            done.append(ids)
            words.clear()
            owners.clear()

        for k, text in enumerate(held):
            special = self.special is not None and self.special.search(text)
            for i, part in enumerate(self.special.split(text) if special else [text]):
                if i % 2:
                    words.append(part)
                    continue
                for piece in self.pieces(part):
                    words += self.split(piece)
                    if len(words) > MANY:
                        owners.append((k, len(words)))
                        look_up()
            owners.append((k, len(words)))
        look_up()
        return np.concatenate(done), counts


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a worker; reading a vocabulary takes long, so it is kept."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` for each row of ``doc_id, text``; ``path`` is the vocabulary's on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for rows, held in blocks(batch):
                flat, counts = coder.ids(held)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                back = pa.array([coder.merges.text_of(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.string())
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, back], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return for_python(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` for each row of ``doc_id, ids``; null ids give empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = encoder(path).merges
        for batch in batches:
            text = [merges.text_of(np.asarray(x.as_py() or [], np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return for_python(tokens.select("doc_id", "ids")).mapInArrow(run, f"doc_id {kind}, text string")


def digests(encoded: DataFrame, *also: str) -> DataFrame:
    return encoded.select(
        "doc_id",
        *also,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_50k.json")))
