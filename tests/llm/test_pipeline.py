"""Every stage of the pipeline against a plain version on its own input, and the entry points."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from test_decontamination import multiset, plain, words_of
from test_simhash import plain_classes, plain_fingerprint
from vintner.llm.packing import cut_points
from vintner.llm.shared import stored
from vintner.llm.tokens import default_path, encoder

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def tables(spark):
    """The documents, and what each stage returns."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(stored(stage(spark, out[-1], SF), f"test-stage-{k}"))
    return out


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages_have_the_order_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "toxicity", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"
    ]


def test_columns_and_rows_are_those_of_documents(tables):
    for before, after in zip(tables[:4], tables[1:5], strict=True):
        assert after.dtypes == before.dtypes
        assert set(after.collect()) <= set(before.collect())


def test_rejected_documents_go_and_others_stay(spark, tables):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    quality = {r["doc_id"]: r["quality"] for r in labels}
    toxic = {r["doc_id"]: r["toxic"] for r in labels}
    kept = ids(tables[1])
    known = [i for i in ids(tables[0]) if i in quality]
    assert sum((i in kept) != (quality[i] == 1) for i in known) <= 0.03 * len(known)
    kept, known = ids(tables[2]), [i for i in ids(tables[1]) if i in toxic]
    assert all(i in kept for i in known if not toxic[i])
    assert sum(i in kept for i in known if toxic[i]) <= 0.5 * sum(toxic[i] for i in known)  # few rows to learn from


def test_one_of_each_class_stays(tables):
    rows = sorted((r["doc_id"], plain_fingerprint(r["text"].encode())) for r in tables[2].collect())
    assert ids(tables[3]) == set(plain_classes(rows))


def test_contaminated_documents_go(spark, tables):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    runs = [(i, t, set(multiset(words_of(t), 5))) for i, t in items]
    hit = set()
    for r in tables[3].collect():
        held = set(multiset(words_of(r["text"]), 5))
        hit |= {i for i, _ in plain([(r["doc_id"], r["text"])], [(i, t) for i, t, run in runs if run & held])}
    assert hit and ids(tables[4]) == ids(tables[3]) - hit


def test_all_that_is_left_is_packed(tables):
    encode = encoder(default_path())
    rows = tables[5].toPandas()
    want = {(r["doc_id"], k, a, n) for r in tables[4].collect() for k, (a, n) in enumerate(cut_points(len(encode(r["text"])) + 1, 1024))}
    assert set(zip(rows.doc_id, rows.piece, rows.start, rows.length, strict=True)) == want and len(rows) == len(want)


def test_run_applies_the_stages(spark, tables):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(got.drop("sequence_id", "offset").collect()) == sorted(tables[5].drop("sequence_id", "offset").collect())


def test_queries_are_registered():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry_points.queries() and set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_the_rest_works_without_the_subpackage(tmp_path):
    for name in ("vintner", "checks", "__spark_entry__.py"):
        source, target = ROOT / name, tmp_path / name
        for path in [source] if source.is_file() else source.rglob("*.py"):
            to = target if source.is_file() else target / path.relative_to(source)
            if "llm" not in path.relative_to(ROOT).parts:
                to.parent.mkdir(parents=True, exist_ok=True)
                to.write_text(path.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cohort_spine' in q and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
