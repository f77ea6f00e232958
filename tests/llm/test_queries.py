"""The registered queries of the operators against their SQL, the pipeline, and the promise that the rest stands alone."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import oracle
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from lockgate.llm import common, queries

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.ORACLES[name]) == ""


def test_one_query_for_each_operator():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = common.table(spark, SF, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        assert docs.count() <= n
        n = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == n and 0 < n < common.table(spark, SF, "documents").count()


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("lockgate/*.py"), *ROOT.glob("lockgate/[!l]*/*.py"), *ROOT.glob("workload/*.py"), ROOT / "bench.py"]:
        assert "llm" not in path.read_text(), path


ALONE = "import sys; {}import __spark_entry__ as e; assert 'pipeline' not in e.queries() and len(e.queries()) == len(e.oracle_sql()) > 100"


def test_entry_works_without_the_subpackage(tmp_path):
    """In a copy of the repository without the folder, with its compiled leftovers, and without the pipeline."""
    away = shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=away)
    (tmp_path / "copy/lockgate/llm/__pycache__").mkdir(parents=True)
    subprocess.run([sys.executable, "-c", ALONE.format("")], cwd=tmp_path / "copy", check=True, timeout=300)


def test_entry_works_where_a_dependency_is_missing():
    code = ALONE.format("sys.modules['xxhash'] = None; ")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=300)
