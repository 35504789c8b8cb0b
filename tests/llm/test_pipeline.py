"""The pipeline against its operators applied by hand, and the guard around it."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline as C
from test_chat_and_rules import brute
from test_joins import brute_classes, brute_hits

REPO = Path(C.__file__).parent
SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, states = docs.columns, []
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        states.append({r.doc_id: r for r in docs.collect()})
        assert docs.columns == columns or k == len(C.STAGES) - 1
    quality, rules, unique, clean, encoded = states
    passed = {i for i, r in quality.items() if (m := brute(r.text))[0] >= 50 and 2 * m[4] <= m[0]}
    assert set(rules) <= passed and len(rules) >= 0.95 * len(passed)
    order = sorted(rules)
    classes = brute_classes([rules[i].text for i in order])
    assert set(unique) == {order[c] for c, _, _ in classes.values()}
    hits = {i: brute_hits(r.text, items) for i, r in unique.items()}
    assert set(clean) == {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}
    assert set(encoded) == set(clean)
    ran = {r.doc_id: r.ids_sha256 for r in C.run(spark, SF).select("doc_id", "ids_sha256").collect()}
    assert ran == {i: r.ids_sha256 for i, r in encoded.items()}


def test_the_rest_works_without(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q)); assert 'rule_counts' in q and 'pipeline' not in q and not [k for k in q if k.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
