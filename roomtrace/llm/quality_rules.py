r"""Quality rules whose cutoffs are set with a guaranteed limit on false rejections.

``measures`` counts, per text, what the rules look at.  Base rules are fixed:
fewer than ``MIN_WORDS`` words, or more than half of the words in repeated
three-word windows.  Each further rule compares one ratio with a cutoff, and the
cutoffs are learned, rule by rule and stratum by stratum (the language), from
labelled documents:

* the good documents of a stratum that the base rules keep are its holdout, of
  n documents, of which k lie beyond a cutoff;
* a cutoff is *certified* if P(X <= k) <= error / tests for X binomial with n
  trials and the limit as its rate: the exact bound rejects "more than the limit
  of good documents are lost";
* cutoffs are tested from the loosest on, and testing stops at the first that
  fails (fixed sequence), so only rules and strata need a correction: ``tests``
  is their number (Bonferroni), and the limit is shared out among the rules.

So with probability 1 - ``ERROR`` no stratum loses more than ``LIMIT`` of its good
documents to the learned rules.  Of the certified cutoffs the strictest is used;
a stratum with too few labels for any has no learned rules, and all that pass the
base rules are kept there.

Everything is built-in columns and SQL functions; what the cutoffs are learned
from is counted per stratum, rule and cutoff before it is shuffled.

Defined cases: null text has no words, so it fails the base rules; a null stratum
is one of its own; repeated labels count once, and documents labelled both ways
do not count; repeated rows are judged alike; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roomtrace.llm.tables import read, text_or_empty
from roomtrace.session import work_dir

MIN_WORDS = 50
#: Most good documents of a stratum that the learned rules may lose together, and the chance that they lose more.
LIMIT, ERROR = 0.02, 0.05
#: Rules: a ratio of the measures, and its cutoffs from the loosest on.  A text fails if it is above.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1]),
    "duplicate lines": ("n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "repeated words": ("n_repeat_words / n_words", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "long words": ("word_chars / n_words", [30.0, 20.0, 15.0, 12.0, 10.0]),
    "short words": ("n_words / word_chars", [0.9, 0.7, 0.5, 0.4]),
}


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more: equal windows meet when their hashes are sorted."""
    last = F.size(words) - 2
    windows = F.transform(
        F.slice(words, 1, F.greatest(last, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("hash"), i.alias("at")
        ),
    )
    ordered = F.array_sort(windows)

    def again(w: Column, i: Column) -> Column:
        return (F.get(ordered_, i - 1)["hash"] == w["hash"]) | (F.get(ordered_, i + 1)["hash"] == w["hash"])

    # A one-element transform names the sorted array, so that it is built once.
    def count(ordered: Column) -> Column:
        nonlocal ordered_
        ordered_ = ordered
        found = F.filter(ordered, lambda w, i: F.coalesce(again(w, i), F.lit(False)))
        places = F.array_sort(F.transform(found, lambda w: w["at"]))
        start = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda s, p: F.struct(p.alias("at"), (s["n"] + F.least(F.lit(3), p - s["at"])).alias("n")),
            lambda s: s["n"],
        )

    ordered_: Column | None = None
    return F.transform(F.array(ordered), count)[0]


def measures(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` and ``base_failed`` to ``docs``; needs ``text``."""
    text = text_or_empty()
    blank = r"[\x20\x09-\x0D]+"
    words = F.filter(F.split(text, blank, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def count(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"), repeated_words(words).alias("n_repeat_words")
        )

    counted = docs.withColumns(
        {
            "_words": F.transform(F.array(words), count)[0],
            "word_chars": F.length(F.regexp_replace(text, blank, "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint"),
            "_lines": F.transform(
                F.array(lines),
                lambda x: F.struct(F.size(x).cast("bigint").alias("n"), F.size(F.array_distinct(x)).cast("bigint").alias("kinds")),
            )[0],
        }
    )
    found = counted.select(
        *docs.columns,
        F.col("_words.n_words").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.n").alias("n_lines"),
        (F.col("_lines.n") - F.col("_lines.kinds")).alias("n_dup_lines"),
        F.col("_words.n_repeat_words").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def binomial_at_most(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial, summed term by term; the terms are kept as logarithms."""
    odds = F.log(F.lit(rate / (1 - rate)))
    first = F.struct((n * F.log(F.lit(1 - rate))).alias("term"), F.exp(n * F.log(F.lit(1 - rate))).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (s["sum"] + F.exp(term)).alias("sum"))

    upto = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(upto, first, step, lambda s: s["sum"])


def cutoffs(
    judged: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", limit: float = LIMIT, error: float = ERROR
) -> DataFrame:
    """``stratum, rule, cutoff``: the strictest certified cutoff of each rule, where there is one.

    ``judged`` has the measures; ``labels`` has ``doc_id, quality`` (1: good).
    """
    good = labels.groupBy(key).agg(F.min("quality").alias("least"), F.max("quality").alias("most")).where("least = 1 and most = 1")
    holdout = judged.where(~F.col("base_failed")).join(good.select(key), key, "left_semi")
    tried = [
        F.sum(F.when(F.expr(f"{ratio} > {c}D"), 1).otherwise(0)).alias(f"k_{r}_{c_at}")
        for r, (ratio, cuts) in enumerate(RULES.values())
        for c_at, c in enumerate(cuts)
    ]
    counts = holdout.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"), *tried)
    cells = F.array(
        *(
            F.struct(F.lit(name).alias("rule"), F.lit(at).alias("at"), F.lit(float(c)).alias("cutoff"), F.col(f"k_{r}_{at}").alias("k"))
            for r, (name, (_, cuts)) in enumerate(RULES.items())
            for at, c in enumerate(cuts)
        )
    )
    tests = F.count("*").over(Window.partitionBy(F.lit(1))) * len(RULES)
    rows = counts.withColumn("tests", tests).select("stratum", "n", "tests", F.inline(cells))
    passed = binomial_at_most(F.col("k"), F.col("n"), limit / len(RULES)) <= error / F.col("tests")
    sequence = Window.partitionBy("stratum", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("passed", passed)
        .withColumn("certified", F.min("passed").over(sequence))
        .where("certified")
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", "at").alias("cutoff"))
    )


def apply(judged: DataFrame, chosen: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds ``kept``: false for what fails the base rules or a learned rule of its stratum."""
    wide = chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    wide = wide.toDF("_stratum", *(f"_cut_{i}" for i in range(len(RULES))))
    beyond = F.lit(False)
    for i, (ratio, _) in enumerate(RULES.values()):
        beyond = beyond | F.coalesce(F.expr(ratio) > F.col(f"_cut_{i}"), F.lit(False))
    # One row per stratum.
    joined = judged.join(wide, judged[stratum].eqNullSafe(wide["_stratum"]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~beyond).drop(*wide.columns)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, lang, text`` and others) that pass; its columns stay as they are."""
    path = work_dir(docs.sparkSession, "measured")
    # Each text is measured once; the cutoffs and the verdicts read the numbers.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "lang", "text")
    measures(rows).drop("text").write.parquet(path)
    judged = docs.sparkSession.read.parquet(path)
    return apply(judged, cutoffs(judged, labels)).where("kept").select("_row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "text")
    path = work_dir(spark, "measures")
    # A few numbers per text, read for the cutoffs and for the verdicts.
    measures(docs).drop("text").write.parquet(path)
    judged = spark.read.parquet(path)
    return apply(judged, cutoffs(judged, read(spark, sf_dir, "labels", "doc_id", "quality"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    ratios = {
        name: ratio.replace(" / ", "::DOUBLE / nullif(") + ", 0)" for name, (ratio, _) in RULES.items()
    }
    cells = ", ".join(
        f"('{name}', {at}, {float(c)!r}::DOUBLE)" for name, (_, cuts) in RULES.items() for at, c in enumerate(cuts)
    )
    beyond = "CASE rule " + " ".join(f"WHEN '{n}' THEN {r}" for n, r in ratios.items()) + " END"
    rate = LIMIT / len(RULES)
    return rf"""
WITH words AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS b, w FROM words WHERE len(w) > 2
), again AS (
  SELECT doc_id, b FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, w[b], w[b + 1], w[b + 2]) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([b, b + 1, b + 2]) AS p FROM again) GROUP BY doc_id
), judged AS (
  SELECT words.doc_id, lang, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN covered USING (doc_id)
), based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM judged
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1
), cells(rule, pos, cutoff) AS (VALUES {cells}),
counts AS (
  SELECT lang, rule, pos, cutoff, count(*) AS n, count(*) FILTER ({beyond} > cutoff) AS k
  FROM based SEMI JOIN good USING (doc_id) CROSS JOIN cells WHERE NOT base_failed GROUP BY ALL
), tested AS (
  SELECT *, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}::DOUBLE) + (n - i) * ln(1 - {rate}::DOUBLE)))
    FROM (SELECT unnest(range(0, k + 1)) AS i)) <= {ERROR}::DOUBLE / ({len(RULES)} * (SELECT count(DISTINCT coalesce(lang, '?null')) FROM counts)) AS passed
  FROM counts
), chosen AS (
  SELECT lang, rule, max_by(cutoff, pos) AS cutoff FROM (
    SELECT *, bool_and(passed) OVER (PARTITION BY lang, rule ORDER BY pos) AS certified FROM tested
  ) WHERE certified GROUP BY lang, rule
), failing AS (
  SELECT DISTINCT doc_id FROM based JOIN chosen ON based.lang IS NOT DISTINCT FROM chosen.lang WHERE {beyond} > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failing) AS kept
FROM based
"""


OP9_SQL = _sql()
