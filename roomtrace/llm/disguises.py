"""Personal data in texts, plain and disguised, with the places of the source.

Offset-preserving deobfuscation: a chain of transducers rewrites a text and keeps,
for every character of its output, where in the source it came from.

1. characters: look-alikes of other scripts, full width and mathematical letters,
   foreign digits, blanks, dots and hyphens become ASCII; invisible ones vanish;
2. letters that stand for digits among digits (``O``, ``I``, ``l``);
3. spelled digits in a row (English, German, French, Spanish), ``plus`` before them,
   ``dot`` between them;
4. ``at`` and ``dot`` in brackets, as words, as character references, with blanks around.

What the base patterns find in the output is mapped back.  It is added if its
source differs from what was read there, no base span of the kind covers it, and
no letter or digit touches it.  What the base patterns find in the source stays as
it is.  Each transducer first looks for its marks; where there are none, as in most
texts, nothing is rewritten, and the output needs no second search.

All searches take time in proportion to the text, whatever it holds.  Blanks inside
a disguise are at most three.  Null is the empty text; empty texts, and tables
without rows, have no spans; equal rows have equal spans; other columns play no part.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import for_python, read
from roomtrace.llm.words import texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

# --- base patterns -------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can't begin inside a run of digits: what fails at its start fails there too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            yield start, floor
        at = text.find("@", floor)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m.group())) <= 19 and _luhn(digits):
            yield m.span()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = dict(zip(KINDS, (_emails, _ips, _cards, _phones)))


def base_spans(text: str) -> list[Span]:
    """``start, end, kind`` of the base patterns, by start, then kind."""
    found = [(s, e, kind) for kind, find in FINDERS.items() for s, e in find(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


# --- transducers ---------------------------------------------------------


class Tape:
    """A text, and for each of its characters the start and end in the source (None: the text is the source)."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts: np.ndarray | None = None
        self.ends: np.ndarray | None = None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces stretches ``start, end, output``, in order and apart."""
        if not edits:
            return
        if self.starts is None:
            self.starts = np.arange(len(self.text))
            self.ends = self.starts + 1
        out, starts, ends, done = [], [], [], 0
        for a, b, put in edits:
            out += [self.text[done:a], put]
            starts += [self.starts[done:a], np.full(len(put), self.starts[a])]
            ends += [self.ends[done:a], np.full(len(put), self.ends[b - 1])]
            done = b
        self.text = "".join([*out, self.text[done:]])
        self.starts = np.concatenate([*starts, self.starts[done:]])
        self.ends = np.concatenate([*ends, self.ends[done:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


# Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "a": "аαɑ", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "јϳ", "k": "κ",
    "l": "ӏ", "m": "м", "n": "ո", "o": "оοօσ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υս", "v": "νѵ", "w": "ԝ",
    "x": "хχ", "y": "уγү", "z": "ᴢ", "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј",
    "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ", "Z": "Ζ",
    "@": "﹫", ".": "․。｡", "-": "‐‑‒–—−﹣", "+": "﹢", " ": "      　", "_": "＿",
}
INVISIBLE = "­᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"


def _characters() -> dict[str, str]:
    table = {c: plain for plain, others in LOOKALIKES.items() for c in others} | dict.fromkeys(INVISIBLE, "")
    # Full width forms and mathematical letters, by their compatibility decomposition; digits of any script.
    for code in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2460, 0x2469), *range(0x24B6, 0x24EA)]:
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and " " <= plain <= "~":
            table.setdefault(chr(code), plain)
    for code in range(0x80, 0x1FBFA):
        if (digit := unicodedata.decimal(chr(code), None)) is not None:
            table.setdefault(chr(code), str(digit))
    return table


CHARACTERS = _characters()
#: Rewritten characters that Latin-1 has too.
_LATIN = [c for c in CHARACTERS if ord(c) < 256]


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def plain_characters(tape: Tape) -> None:
    text = tape.text
    if text.isascii():
        return
    there = [c for c in _LATIN if c in text] if _is_latin(text) else list(CHARACTERS.keys() & set(text))
    if there:
        # A class of the few that are there is searched much faster than one of all.
        found = re.finditer("[" + "".join(map(re.escape, there)) + "]", text)
        tape.rewrite([(m.start(), m.end(), CHARACTERS[m.group()]) for m in found])


_DIGIT_LIKE = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?:[ .()-]{1,2}[0-9OoIl]++)*+(?![A-Za-z0-9])")
_READ_AS = {"O": "0", "o": "0", "I": "1", "l": "1"}


def digit_letters(tape: Tape) -> None:
    edits = []
    for m in _DIGIT_LIKE.finditer(tape.text):
        run = m.group()
        letters = [i for i, c in enumerate(run) if c in _READ_AS]
        if letters and 2 * len(letters) <= len(_digits(run)):
            edits += [(m.start() + i, m.start() + i + 1, _READ_AS[run[i]]) for i in letters]
    tape.rewrite(edits)


# Digits as words, 0 to 9.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_OF = {word: str(d) for words in SPELLED for d, word in enumerate(words.split())}
DOT_WORDS = ("dot", "punkt", "point", "punto")
AT_WORDS = ("at", "arroba", "arobase")
#: Fewest spelled digits in a run that is taken for a number.
FEWEST = 3
_GAP = r"[ \t]{1,3}"
_SAID = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_DOTS = "|".join(DOT_WORDS)
_RUN = re.compile(
    rf"(?<!\w)(?:\+|plus{_GAP})?(?:(?:{_SAID})(?!\w)|[0-9]++)(?:(?:{_GAP}|[ \t]?[-.,/][ \t]?)(?:(?:{_SAID}|{_DOTS})(?!\w)|[0-9]++))++"
)
_ITEM = re.compile(r"[^\W\d_]+|[0-9]+|\+|[^\w+]+")


def lowered(text: str) -> str:
    """Lower case with the places kept."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def spelled_digits(tape: Tape) -> None:
    edits = []
    for run in _RUN.finditer(lowered(tape.text)):
        items = [(m.start() + run.start(), m.end() + run.start(), m.group()) for m in _ITEM.finditer(run.group())]
        if sum(word in DIGIT_OF for *_, word in items) < FEWEST:
            continue
        put = []
        for a, b, word in items:
            out = DIGIT_OF.get(word) or ("+" if word == "plus" else "." if word in DOT_WORDS else word)
            put.append([a, b, out, word[0].isalpha()])
        # Gaps beside a word vanish, whether blanks, commas or hyphens; between plain digits they stay.
        for i, item in enumerate(put):
            gap = not item[2][0].isalnum() and item[2] not in ("+", ".") and not item[3]
            if gap and ((i and put[i - 1][3]) or (i + 1 < len(put) and put[i + 1][3])):
                item[2] = ""
        edits += [(a, b, out) for a, b, out, _ in put if tape.text[a:b] != out]
    tape.rewrite(edits)


_OPEN, _CLOSE = r"[(\[{<][ \t]{0,3}", r"[ \t]{0,3}[)\]}>]"
_DOT = rf"(?:\.|[ \t]\.[ \t]|[ \t]{{0,3}}{_OPEN}(?:\.|{_DOTS}){_CLOSE}[ \t]{{0,3}}|{_GAP}(?:{_DOTS}){_GAP}|&#0*46;|&#x0*2e;|&period;)"
_NAMED = rf"(?=[a-z0-9-]{{1,63}}{_DOT}[a-z0-9])"
# Each pattern begins with a few characters, which is what makes its search fast.
_AT = (
    ("sure", re.compile(rf"[(\[{{<][ \t]{{0,3}}(?:{'|'.join(AT_WORDS)}|@){_CLOSE}[ \t]{{0,3}}(?=[a-z0-9])")),
    ("sure", re.compile(r"[(\[{<](?<=[a-z0-9].)a[)\]}>](?=[a-z0-9])")),
    ("sure", re.compile(r"&(?:#0*64|#x0*40|commat);[ \t]{0,3}(?=[a-z0-9])")),
    ("sure", re.compile(r"%40(?=[a-z0-9])")),
    ("sure", re.compile(r"_at_(?<=[a-z0-9]_at_)(?=[a-z0-9])")),
    ("word", re.compile(rf" (?:{'|'.join(AT_WORDS)}){_GAP}{_NAMED}")),
    ("sign", re.compile(rf"@[ \t]{{0,3}}{_NAMED}")),
)
_HOST = re.compile(rf"[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)++")
_DOT_IN = re.compile(_DOT)
_DOT_BEFORE = re.compile(rf"{_DOT}\Z")
_NUMBER_DOT = re.compile(rf"(?<=[0-9])(?!\.){_DOT}(?=[0-9])")
#: Longest disguise of a dot, for looking back.
_LONGEST_DOT = 24


def _local(text: str, end: int, floor: int) -> int:
    while end > floor and text[end - 1] in _LOCAL:
        end -= 1
    return end


def at_and_dot(tape: Tape) -> None:
    low = lowered(tape.text)
    edits, floor = [], 0
    marks = sorted((m.start(), m.end(), kind) for kind, pattern in _AT for m in pattern.finditer(low))
    for a, b, kind in marks:
        core = a
        if a < floor:
            continue
        blanks = 0
        while a > floor and low[a - 1] in " \t" and blanks < 3:
            a, blanks = a - 1, blanks + 1
        start = _local(low, a, floor)
        host = _HOST.match(low, b) if start < a else None
        if host is None or not low[host.start() : host.end()].rpartition(".")[2][-2:].isalpha():
            continue
        said = [d for d in _DOT_IN.finditer(low, host.start(), host.end()) if d.group() != "."]
        # "look at example.com" is no address: with a plain word on both sides the name must have the form of one.
        named = low[start].isalnum() and low[a - 1].isalnum() and not low[start:a].isalpha()
        if kind == "word" and not named and all(d.group().strip() == "." for d in said):
            continue
        # A sign with a blank on one side only is a mention.
        if kind == "sign" and bool(blanks) != (b > core + 1):
            continue
        before = []
        while said or kind == "sure":
            d = _DOT_BEFORE.search(low, max(floor, start - _LONGEST_DOT), start)
            if d is None or d.group() == "." or (rest := _local(low, d.start(), floor)) == d.start():
                break
            before.append((d.start(), d.end(), "."))
            start = rest
        found = [*reversed(before), (a, b, "@"), *[(d.start(), d.end(), ".") for d in said]]
        edits += [e for e in found if tape.text[e[0] : e[1]] != e[2]]
        floor = host.end()
    tape.rewrite(edits)
    tape.rewrite([(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(lowered(tape.text))])


TRANSDUCERS = (plain_characters, digit_letters, spelled_digits, at_and_dot)


def deobfuscate(text: str) -> Tape:
    tape = Tape(text)
    for transduce in TRANSDUCERS:
        transduce(tape)
    return tape


def spans(text: str) -> list[tuple[int, int, str, bool]]:
    """``start, end, kind, base`` of all that is found, by start, kind and end; places count code points of ``text``."""
    base = base_spans(text)
    found = [(*b, True) for b in base]
    tape = deobfuscate(text)
    if tape.starts is not None:
        plain = tape.text
        known: dict[str, list[tuple[int, int]]] = {k: [(s, e) for s, e, kind in base if kind == k] for k in KINDS}
        at = dict.fromkeys(KINDS, 0)
        for s, e, kind in base_spans(plain):
            a, b = tape.source(s, e)
            if text[a:b] == plain[s:e] or plain[s - 1 : s].isalnum() or plain[e : e + 1].isalnum():
                continue
            # Both lists run in order, so one step forward finds the base span that may cover this one.
            while at[kind] < len(known[kind]) and known[kind][at[kind]][1] <= a:
                at[kind] += 1
            near = known[kind][at[kind]] if at[kind] < len(known[kind]) else None
            if near is None or not (near[0] <= a and b <= near[1]):
                found.append((a, b, kind, False))
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2]), f[1], not f[3]))


def masked(text: str) -> str:
    """The text with every span, or stretch of spans that overlap, replaced by its first kind in capitals."""
    out, done = [], 0
    for start, end, kind, _ in spans(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


# --- tables --------------------------------------------------------------

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[dict(zip(("start", "end", "kind", "base"), s)) for s in spans(text)] for text in texts(batch)]
        yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.list_(_SPAN))], ["doc_id", "found"])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, found``: the spans of each text, an array of ``start, end, kind, base``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = for_python(docs.select("doc_id", "text"))
    return rows.mapInArrow(_found, f"doc_id {kind}, found array<struct<start:bigint,end:bigint,kind:string,base:boolean>>")


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        clean = pa.array([None if t is None else masked(t) for t in (v.as_py() for v in batch.column(at))], batch.schema.field(at).type)
        yield batch.set_column(at, batch.schema.field(at), clean)


def mask(docs: DataFrame) -> DataFrame:
    """The same rows with personal data replaced by its kind; null texts stay null."""
    return for_python(docs).mapInArrow(_masked, docs.schema)


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_disguised_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("found", lambda s: s["base"])

    def n(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[n(kind) for kind in KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: ~s["base"])).cast("bigint").alias("n_disguised"),
    )
