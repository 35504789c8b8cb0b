"""Personal data: base patterns against plain searches, disguises by their places in the source."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from conftest import rows
from roomtrace.llm import disguises as D

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0


def plain(text):
    """The contract's patterns, searched as they stand."""
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = [
                True,
                k == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            ]
            if good[k]:
                found.append((m.start(), k, m.end()))
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def test_base_against_plain_search():
    rnd = random.Random(7)
    pieces = ["a", "b.c", "@", "@", ".", ".", "_", "1", "25", "300", "4532015112830366", " ", "-", "+", "+1 ", "(", ")", "é", "/",
              "12.3.4", "0000255.1.1.1", "x@y.z", "4532 0151 1283 0366", "415-555-2671", "\n"]
    for _ in range(20_000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 14)))
        assert D.base_spans(text) == plain(text), text


def test_base_of_the_query(answer, texts):
    got = {r["doc_id"]: r for r in answer("op12_disguised_pii")}
    assert set(got) == set(texts)
    for doc, text in texts.items():
        want = plain(text or "")
        listed = ",".join(f"{k}:{s}:{e}" for s, e, k in want)
        r = got[doc]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w[2] == k for w in want) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r["spans"].split(","))
        # The given texts hold nothing disguised.
        assert r["spans"] == listed and r["n_disguised"] == 0


CASES = [
    ("email", "write to ", "john.doe (at) example (dot) com", " today"),
    ("email", "write to ", "john.doe[at]example[dot]com", "."),
    ("email", "", "john dot doe at mail dot example dot com", ""),
    ("email", "Mail: ", "JOHN AT EXAMPLE DOT COM", "!"),
    ("email", "c/o ", "anna.k at example.org", ", thanks"),
    ("email", "", "anna {at} example {punkt} de", ""),
    ("email", "x ", "anna &#64; example&#46;de", " y"),
    ("email", "x ", "anna&commat;example.de", " y"),
    ("email", "x ", "anna @ example.de", " y"),
    ("email", "x ", "anna(a)example.de", " y"),
    ("email", "x ", "anna_at_example.de", " y"),
    ("email", "x ", "anna%40example.de", " y"),
    ("email", "по ", "аnnа@еxаmple.соm", " ок"),
    ("email", "", "ａｎｎａ＠ｅｘａｍｐｌｅ．ｃｏｍ", "　"),
    ("email", "", "an​na@exam​ple.c­om", ""),
    ("email", "", "𝐚𝐧𝐧𝐚@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦", ""),
    ("ip", "host ", "192[.]168[.]10[.]1", " up"),
    ("ip", "host ", "192 dot 168 dot 10 dot 1", " up"),
    ("ip", "host ", "one two seven dot zero dot zero dot one", " up"),
    ("ip", "host ", "l92.168.l0.l", " up"),
    ("ip", "host ", "１９２．１６８．１０．１", " up"),
    ("card", "pay ", "four five three two zero one five one one two eight three zero three six six", " now"),
    ("card", "pay ", "4532 O151 1283 O366", " now"),
    ("card", "pay ", "٤٥٣٢٠١٥١١٢٨٣٠٣٦٦", " now"),
    ("card", "pay ", "4532‑0151‑1283‑0366", " now"),
    ("phone", "call ", "plus one four one five five five five two six seven one", " now"),
    ("phone", "call ", "＋1 (415) 555 2671", " now"),
    ("phone", "call ", "+1 four one five 555 2671", " now"),
    ("phone", "ruf ", "plus vier neun drei null eins zwei drei vier fünf sechs", " an"),
]


@pytest.mark.parametrize("kind, before, disguised, after", CASES)
def test_disguises(kind, before, disguised, after):
    text = f"Ünïcode 🙂 first. {before}{disguised}{after}"
    start = text.index(disguised)
    assert (start, start + len(disguised), kind, False) in D.spans(text)
    assert D.masked(text) == text.replace(disguised, f"[{kind.upper()}]")


CLEAN = [
    "Look at example.com for more.", "We met at noon. Dot the i.", "One, two, three, four: go!", "item (a) e.g. this one",
    "Thanks @anna for this.", "at home.then we left", "word. at foo.bar", "Il y a un deux trois.", "version 1.2.3 dot release",
    "О нас. Привет, мир! а.б", "eins zwei drei vier fünf sechs sieben acht neun null", "١٢٣ و ٤٥٦", "1 2 3 4 5 6 7 8 9 10", "look at foo . bar",
    "count: one two three four five six seven eight nine",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts(text):
    assert D.spans(text) == []
    assert D.masked(text) == text


def test_plain_data_beside_disguised():
    text = "a@b.cd and x (at) y.zz and 10.0.0.1"
    assert D.spans(text) == [(0, 6, "email", True), (11, 22, "email", False), (27, 35, "ip", True)]
    # A look-alike before a plain address: the base span stays, the whole one is added.
    assert D.spans("аlice@b.cd") == [(0, 10, "email", False), (1, 10, "email", True)]


def test_tape_places():
    rnd = random.Random(3)
    for _ in range(500):
        text = "".join(rnd.choice(["a", "а", "​", "(at)", " dot ", "1", "one ", "x.y", " ", "İ"]) for _ in range(30))
        tape = D.deobfuscate(text)
        if tape.starts is None:
            assert tape.text == text
            continue
        assert len(tape.text) == len(tape.starts) == len(tape.ends)
        assert all(tape.starts[:-1] <= tape.starts[1:]) and all(tape.starts < tape.ends)


@pytest.mark.parametrize("unit", ["x", "1", "1.", "1 ", "+1", "@", "a@", " ", "a@b", "one ", "at ", "a at b.", "(", "О", "dot ", "a at b dot ", "l", ".", "1 dot ", "(at)", "&#"])
def test_long_texts_take_linear_time(unit):
    start = time.perf_counter()
    D.spans(unit * (200_000 // len(unit)))
    assert time.perf_counter() - start < 8


def test_odd_rows(spark, odd, empty):
    got = rows(D.find(odd))
    assert len(got) == odd.count() and all(r["found"] == [] for r in got)
    assert rows(D.find(empty)) == []
    said = odd.sparkSession.createDataFrame([(1, "to a (at) b.cd", 5), (2, None, 6)], "doc_id string, text string, found int")
    assert sorted((r["doc_id"], r["text"], r["found"]) for r in rows(D.mask(said))) == [("1", "to [EMAIL]", 5), ("2", None, 6)]
