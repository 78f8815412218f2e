"""The pipeline stage by stage against brute force, and the registration of its queries."""

from __future__ import annotations

import os
import re
import subprocess
import sys

import corpus_pipeline
from llm_cases import rows_of
from test_free import expected_components
from test_native import check_mix, expected_lines

DATA = os.environ.get("SPOTLAKE_TEST_DATA", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_every_stage_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        held[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = held[name][1]
        if name != "mix":
            assert docs.columns == COLUMNS
    plain = {name: [rows_of(frame, *frame.columns) for frame in pair] for name, pair in held.items()}

    before, after = plain["quality"]
    kept = {r[0] for r in after}
    known = [i for i in labels if i in {r[0] for r in before}]
    assert set(after) <= set(before)
    assert sum((i in kept) == (labels[i] == 1) for i in known) >= 0.97 * len(known)

    before, after = plain["lines"]
    want = {i: text for i, _, removed, text in expected_lines(before, 10) if not removed or text.strip()}
    assert {r[0]: r[1] for r in after} == want
    assert all(r[4] == len(r[1]) for r in after)

    before, after = plain["near_copies"]
    assert after == sorted([r for r in before if r[0] in {i for i, _, c in expected_components(before) if i == c}], key=repr)

    before, after = plain["decontamination"]
    def words(text):
        return re.sub(r"\W+", " ", text.lower()).strip()
    items = [words(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert after == [r for r in before if not any(item in words(r[1]) for item in items)]

    check_mix(plain["mix"][0], held["mix"][1].collect())
    assert rows_of(corpus_pipeline.run(spark, DATA)) == plain["mix"][1]


def test_stages_take_empty_tables(spark, nothing, tmp_path):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, DATA).count() == 0


def test_queries_are_registered_only_with_the_subpackage(tmp_path):
    code = "import __spark_entry__ as e; print(sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'))"
    here = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert here.stdout.count("'") == 22, here.stderr
    bare = tmp_path / "bare"
    bare.mkdir()
    (bare / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    (bare / "spotlake").mkdir()
    for name in os.listdir(f"{ROOT}/spotlake"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/spotlake/{name}", bare / "spotlake" / name)
    gone = subprocess.run([sys.executable, "-c", code], cwd=bare, capture_output=True, text=True)
    assert gone.stdout.strip() == "[]", gone.stderr
