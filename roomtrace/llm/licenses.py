r"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

A text and a template are sequences of word shingles (five words; a template of
fewer words is one shingle).  For a template of m shingles, windows of m shingles
start at every m/4-th shingle, so that some window lies within m/8 of any
occurrence.  If 0.8 of the template are there, that window and the template have a
Jaccard similarity of at least (0.8 - 1/8) / (1.2 + 1/8) = 0.51, and one of
``BANDS`` min-hashes agrees with a probability above 1 - 0.49^16 = 0.99998.
Retrieved windows, widened by m/4 on either side, are verified: at least
``CONTAINED`` of the template's shingles must be in them.

Texts without any *probe* word skip the windows.  Probes are words of a template of
which one must be there if 0.8 of its shingles are, so no match is lost
(``probes``).  A window that agrees with a template in a min-hash holds the shingle
it is of, so windows without any shingle of the templates are not hashed either; no
match is lost by that.  Everything stays in the row of its text: no shuffle, no join, and
built-in functions only.

Defined cases: null and empty text have no matches; windows that overlap may report one
place more than once; repeated rows are repeated; an empty table gives no rows; an empty
list of templates gives no matches; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import WORD_CLASS, read, text_or_empty

SHINGLE, CONTAINED, BANDS = 5, 0.8, 16

#: Short notices of public licenses.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
}


def words_of(text: str) -> list[str]:
    return re.findall(WORD_CLASS, text.lower())


def shingles_of(template: str) -> list[str]:
    words = words_of(template)
    size = min(SHINGLE, len(words))
    return [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []


def probes(template: str) -> list[str]:
    """Words of which one must be in a text that contains enough of the template: they touch more than a fifth of its shingles."""
    shingles = set(shingles_of(template))
    chosen: list[str] = []
    left = set(shingles)
    for word in sorted(set(words_of(template)), key=lambda w: (-len(w), w)):
        if len(shingles) - len(left) > (1 - CONTAINED) * len(shingles) + 1e-9:
            break
        chosen.append(word)
        left = {s for s in left if word not in s.split(" ")}
    return chosen


def stride(m: int) -> int:
    return max(1, m // 4)


def permuted(hashes: Column, number: int) -> Column:
    """The hashes in the order of one of the min-hashes."""
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(number)))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _hashed(spark: SparkSession, templates: dict[str, list[str]]) -> dict[str, tuple[list[int], list[int]]]:
    """Per template the hashes of its shingles and its min-hash keys, one per band, as literals for the plan."""

    def row(name: str, shingles: list[str]) -> Column:
        own = F.array(*(F.xxhash64(F.lit(s)) for s in dict.fromkeys(shingles)))
        keys = F.array(*(F.xxhash64(F.array_min(permuted(own, b)), F.lit(b)) for b in range(BANDS)))
        return F.struct(F.lit(name).alias("name"), own.alias("own"), keys.alias("keys"))

    rows = spark.range(1).select(F.explode(F.array(*(row(n, s) for n, s in templates.items()))).alias("t")).select("t.*")
    return {r.name: (list(r.own), list(r["keys"])) for r in rows.collect()}


def _matches(words: Column, size: int, classes: dict[int, dict[str, tuple[list[int], list[int]]]]) -> Column:
    """Matches of templates (hashes and keys) with shingles of ``size`` words, by their number of shingles."""
    last = F.size(words) - size + 1
    hashes = F.transform(
        F.slice(words, 1, F.greatest(last, F.lit(0))),
        lambda w, i: F.xxhash64(F.concat_ws(" ", w, *(F.get(words, i + k) for k in range(1, size)))),
    )

    def own_hashes(templates: dict[str, tuple[list[int], list[int]]]) -> Column:
        return F.array(*(F.lit(h).cast("bigint") for h in sorted({h for own, _ in templates.values() for h in own})))

    def of_class(hashes: Column, near: Column, m: int, templates: dict[str, tuple[list[int], list[int]]]) -> Column:
        step = stride(m)
        places = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)), F.lit(step))

        def keys_of(window: Column) -> Column:
            return F.array(*(F.xxhash64(F.array_min(permuted(window, b)), F.lit(b)) for b in range(BANDS)))

        def windows_of(held: Column) -> Column:
            chosen = F.filter(places, lambda p: F.exists(held, lambda i: (i >= p) & (i < p + m)))
            return F.transform(chosen, lambda p: F.struct(p.alias("at"), _bound(F.slice(hashes, p + 1, m), keys_of).alias("keys")))

        own_of_class = own_hashes(templates)
        windows = _bound(F.filter(near, lambda i: F.array_contains(own_of_class, F.get(hashes, i))), windows_of)

        def of_template(name: str, hashed: tuple[list[int], list[int]], found: Column) -> Column:
            own, keys = (F.array(*(F.lit(h).cast("bigint") for h in part)) for part in hashed)
            retrieved = F.filter(found, lambda w: F.arrays_overlap(w["keys"], keys))
            measured = F.transform(
                retrieved,
                lambda w: F.struct(
                    F.lit(name).alias("license"),
                    w["at"].alias("start"),
                    (
                        F.size(
                            F.array_intersect(
                                F.slice(hashes, F.greatest(w["at"] - step, F.lit(0)) + 1, m + step + F.least(w["at"], F.lit(step))), own
                            )
                        )
                        / F.size(own)
                    ).alias("contained"),
                ),
            )
            return F.filter(measured, lambda x: x["contained"] >= CONTAINED)

        return _bound(windows, lambda found: F.concat(*(of_template(n, s, found) for n, s in templates.items())))

    def scan(hashes: Column) -> Column:
        own_of_all = own_hashes({n: hashed for own in classes.values() for n, hashed in own.items()})
        places = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)))
        near = F.filter(places, lambda i: F.array_contains(own_of_all, F.get(hashes, i)))
        found = _bound(near, lambda near: F.concat(*(of_class(hashes, near, m, own) for m, own in classes.items())))
        return F.when(F.size(hashes) > 0, found)

    return _bound(hashes, scan)


_MATCHES = "array<struct<license:string,start:int,contained:double>>"


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id, matches``: per match the license, the word its window starts at, and how much of the template is there."""
    sizes: dict[int, dict[int, dict[str, list[str]]]] = {}
    for name, template in templates.items():
        if shingles := shingles_of(template):
            size = len(shingles[0].split(" "))
            sizes.setdefault(size, {}).setdefault(len(shingles), {})[name] = shingles
    none = F.array().cast(_MATCHES)
    if not sizes:
        return docs.select("doc_id", none.alias("matches"))
    shingled = {n: s for classes in sizes.values() for own in classes.values() for n, s in own.items()}
    hashed = _hashed(docs.sparkSession, shingled)
    keyed = {size: {m: {n: hashed[n] for n in own} for m, own in classes.items()} for size, classes in sizes.items()}
    low = F.lower(text_or_empty())
    wanted = sorted({w for t in templates.values() for w in probes(t)})

    def probed(low: Column) -> Column:
        found = F.lit(False)
        for word in wanted:
            found = found | low.contains(word)
        return found

    words = F.regexp_extract_all(low, F.lit(WORD_CLASS), F.lit(0))
    found = _bound(
        words,
        lambda w: F.concat(*(F.coalesce(_matches(w, size, classes), none) for size, classes in keyed.items())),
    )
    return docs.select("doc_id", F.when(_bound(low, probed), found).otherwise(none).cast(_MATCHES).alias("matches"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return scan(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id",
        F.size(names).cast("bigint").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
    )


def _sql() -> str:
    rows = ", ".join(
        f"('{name}', {len(shingles_of(t))}, {stride(len(shingles_of(t)))}, {len(s.split(' '))}, '{s}')"
        for name, t in TEMPLATES.items()
        for s in dict.fromkeys(shingles_of(t))
    )
    return rf"""
WITH t(license, m, step, size, shingle) AS (VALUES {rows}),
kinds AS (SELECT license, count(*) AS n FROM t GROUP BY license),
w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM t),
s AS (
  SELECT doc_id, size, p, len(w) - size + 1 AS n, array_to_string(w[p + 1 : p + size], ' ') AS shingle
  FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS p FROM w CROSS JOIN sizes WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, license, m, step, s.shingle, p, unnest(range(greatest(0, (p - m - step) // step), least(p + step, n - 1) // step + 1)) AS j
  FROM s JOIN t ON s.shingle = t.shingle AND s.size = t.size
), found AS (
  SELECT doc_id, license, j FROM hits JOIN kinds USING (license)
  WHERE p >= j * step - step AND p < j * step + m + step GROUP BY doc_id, license, j, n
  HAVING count(DISTINCT shingle) / n >= {CONTAINED}
)
SELECT doc_id, count(DISTINCT license)::BIGINT AS n_licenses,
  coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses
FROM w LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""


OP8_SQL = _sql()
