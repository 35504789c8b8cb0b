"""Chat reconstruction, license scan and quality rules on small logs and texts."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roomtrace.llm import chat, licenses, quality_rules as Q

LOG = "conv_id bigint, seq bigint, turn bigint, kind string, role string, text string"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def said(spark, *rows):
    return [(r.conv_id, r.turn, r.role, r.text) for r in chat.fold(events(spark, *rows)).orderBy("conv_id", "turn").collect()]


def test_deltas_edits_and_regenerations(spark):
    got = said(
        spark,
        (1, 1, 0, "message", "user", "hi"),
        (1, 2, 1, "delta", "assistant", "Hel"),
        (1, 3, 1, "delta", None, "lo"),
        (1, 4, 2, "message", "user", "more"),
        (1, 5, 3, "message", "assistant", "gone"),
        # Turn 1 anew: what followed is withdrawn, what comes later is not.
        (1, 6, 1, "regenerate", "assistant", None),
        (1, 7, 1, "delta", "assistant", "Good "),
        (1, 8, 1, "delta", "assistant", "day"),
        (1, 9, 2, "message", "user", "thanks"),
        (1, 10, 0, "edit", None, "hello"),
    )
    assert got == [(1, 0, "user", "hello"), (1, 1, "assistant", "Good day"), (1, 2, "user", "thanks")]


def test_deltas_go_on_after_an_edit(spark):
    got = said(spark, (1, 1, 0, "delta", "a", "x"), (1, 2, 0, "edit", None, "new"), (1, 3, 0, "delta", None, "!"))
    assert got == [(1, 0, "a", "new!")]


def test_odd_logs(spark):
    rows = [
        (None, 1, 0, "message", None, None), (None, 1, 0, "message", None, None), (2, None, None, None, "user", "t"),
        (3, 1, 0, "regenerate", "assistant", None), (4, 1, 0, "shout", "user", "as a message"),
    ]
    assert said(spark, *rows) == [
        (None, 0, "unknown", ""), (2, None, "user", "t"), (3, 0, "assistant", ""), (4, 0, "user", "as a message"),
    ]
    assert chat.fold(events(spark, *rows).limit(0)).count() == 0
    assert chat.render(chat.fold(events(spark, *rows).limit(0))).count() == 0


PARTS = ["\\", "#", "###", "</turn>", "\n", "\\h", "\\s", "\\e", "\\n", "### user\n", "ok", "<", "/turn>", "é🙂"]


def test_rendering_is_reversible(spark):
    import itertools
    import random

    pick = random.Random(5)
    words = ["".join(p) for p in itertools.product(PARTS, PARTS)] + ["".join(pick.choices(PARTS, k=8)) for _ in range(300)] + [""]
    rows = [(k // 7, k, pick.choice(["assistant", "user", "we###ird\n role"]), w) for k, w in enumerate(words)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.render(turns).select("conv_id", "formatted", chat.parsed(F.col("formatted")).alias("turns"), chat.loss_spans(F.col("formatted")).alias("spans"))
    for r in out.collect():
        want = [(role, text) for conv, _, role, text in rows if conv == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == want
        learned = [r.formatted[s.start : s.start + s.length] for s in r.spans]
        plain = [x.replace("\\e", "</turn>").replace("\\h", "###").replace("\\s", "\\") for x in learned]
        assert plain == [t for role, t in want if role == "assistant"]


def test_the_log_of_a_table_has_every_kind_of_event(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], "é" * n + "xyz"[: n % 4]) for c in range(12) for t, n in enumerate([0, 1, 2, 3, 4, 50])]
    log = chat.as_events(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    shuffled = log.orderBy(F.xxhash64("conv_id", "turn", "seq", "text"))
    got = {(r.conv_id, r.turn.turn, r.role, r.text) for r in chat.fold(shuffled.repartition(5)).collect()}
    assert got == set(rows)


def test_rows_equal_in_turn_stay(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", None)]
    log = chat.as_events(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = chat.render(chat.fold(log)).select(chat.parsed(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in got] == [("assistant", ""), ("user", "a"), ("user", "a")]


# --- licenses ---------------------------------------------------------------------


def found(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [sorted({m.license for m in r.matches}) for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_each_template_is_found_anywhere(spark):
    filler = "some words that say nothing at all about it "
    for pad in (0, 1, 3, 50):
        texts = [filler * pad + t.upper() + " " + filler * pad for t in licenses.TEMPLATES.values()]
        assert [n in f for n, f in zip(licenses.TEMPLATES, found(spark, *texts))] == [True] * len(texts)


def test_partial_templates(spark):
    words = licenses.TEMPLATES["MIT-text"].split()
    whole, half = " ".join(words[:-2]), " ".join(words[: len(words) // 2])
    assert found(spark, whole, half, "reserved rights all", None, "", "licensed") == [["MIT-text"], [], [], [], [], []]


def test_probes_are_needed_words():
    for text in licenses.TEMPLATES.values():
        shingles = set(licenses.shingles_of(text))
        without = {s for s in shingles if not set(s.split()) & set(licenses.probes(text))}
        assert len(without) < licenses.CONTAINED * len(shingles)


def test_no_templates_and_no_rows(spark, odd, empty):
    assert {tuple(r.matches) for r in licenses.scan(odd, {}).collect()} == {()}
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0


# --- rules ------------------------------------------------------------------------


def brute(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {k for at in windows.values() if len(at) > 1 for i in at for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_measures_against_plain_python(spark, odd):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.text(alphabet="ab \n# é\x1c", max_size=40), min_size=150, max_size=150))
    def check(texts):
        own = spark.createDataFrame([(t,) for t in texts], "text string").unionByName(odd.select("text"))
        for r in Q.measures(own).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)

    check()


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (100, 3, 0.02), (2000, 0, 0.004), (5000, 30, 0.004), (0, 0, 0.1)])
def test_binomial(spark, n, k, p):
    got = spark.range(1).select(Q.binomial_at_most(F.lit(k).cast("bigint"), F.lit(n).cast("bigint"), p)).first()[0]
    want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert got == pytest.approx(want, rel=1e-9)


def judged(spark, rows):
    text = "word another third more five six seven eight nine ten " * 6
    return spark.createDataFrame([(i, lang, text, r) for i, (lang, r) in enumerate(rows)], "doc_id bigint, lang string, text string, n_symbols bigint").selectExpr(
        "doc_id", "lang", "100L n_words", "500L word_chars", "n_symbols", "10L n_lines", "0L n_dup_lines", "0L n_repeat_words", "false base_failed"
    )


def test_cutoffs_are_certified_per_stratum(spark):
    # 2,000 clean documents in one language; half of another one is full of symbols; a third has too few labels.
    rows = [("en", 0)] * 2000 + [("de", 90 * (i % 2)) for i in range(2000)] + [(None, 0)] * 20
    df = judged(spark, rows)
    labels = df.selectExpr("doc_id", "1 quality")
    got = {(r.stratum, r.rule): r.cutoff for r in Q.cutoffs(df, labels).collect()}
    assert got["en", "symbols"] == 0.1 and got["de", "symbols"] == 1.0
    assert not any(s is None for s, _ in got)
    kept = Q.apply(df, Q.cutoffs(df, labels))
    assert kept.where("NOT kept").count() == 0 and kept.count() == len(rows)


def test_no_labels_no_cutoffs(spark):
    df = judged(spark, [("en", 900)] * 5)
    none = df.selectExpr("doc_id", "1 quality").limit(0)
    assert Q.apply(df, Q.cutoffs(df, none)).where("kept").count() == 5
    both = df.selectExpr("doc_id", "1 quality").unionByName(df.selectExpr("doc_id", "0 quality"))
    assert Q.cutoffs(df, both).count() == 0


def test_rules_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (None, 1)], "doc_id bigint, quality int")
    assert Q.keep(odd, labels).columns == odd.columns
    assert Q.keep(odd, labels).count() == 0
    assert Q.keep(empty, labels).count() == 0


@pytest.mark.parametrize("name", ["BSD", "MIT-text", "GPL-3.0", "proprietary"])
def test_windows_that_are_not_skipped_find_a_template_at_every_place(spark, name):
    """Shingles of other templates lie around it, and a fifth of its own may be missing."""
    words = licenses.words_of(licenses.TEMPLATES[name])
    kept = words[: len(words) - (len(licenses.shingles_of(licenses.TEMPLATES[name])) // 5)]
    other = licenses.words_of(licenses.TEMPLATES["Apache-2.0"])[:6]
    texts = [(i, " ".join([f"w{k}" for k in range(i)] + kept + other + ["x"] * 40)) for i in range(25)]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string"))
    got = {r.doc_id: {(m.license, m.start) for m in r.matches if m.license == name} for r in found.collect()}
    m = len(licenses.shingles_of(licenses.TEMPLATES[name]))
    step = licenses.stride(m)
    for i in range(25):
        assert got[i] and all(i - m - step < start <= i + m + step and start % step == 0 for _, start in got[i])
