import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from lakestar.plans import catalog
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    compare(spark, sf_dir, catalog.QUERIES[name], catalog.SQL[name])


#: Queries that SQL can't express, tested against brute force below.
NO_SQL = {"r94_fixture_cover"}


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL) | NO_SQL


def test_fixture_cover_is_greedy(spark, sf_dir):
    docs = sorted((r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect())
    shown = lambda t, lang: {f for f, has in {"de": lang == "de", "fr": lang == "fr", "short": t is not None and len(t) < 40, "long": t is not None and len(t) > 5000, "lines": "\n" in (t or ""), "digits": re.search("[0-9]{6}", t or "") is not None, "null": t is None}.items() if has}
    features, chosen = {d: shown(t, lang) for d, t, lang in docs}, []
    left = set().union(*features.values())
    while left:
        best = max(features, key=lambda d: (len(left & features[d]), len(features[d]), -d))
        chosen.append(best)
        left -= features[best]
    assert sorted(r.doc_id for r in catalog.QUERIES["r94_fixture_cover"](spark, sf_dir).collect()) == sorted(chosen)


def test_entry_works_without_the_llm_subpackage(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "lakestar", tmp_path / "lakestar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}).returncode == 0


def test_an_import_that_fails_inside_the_subpackage_is_seen(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "lakestar", tmp_path / "lakestar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "lakestar/llm").mkdir()
    (tmp_path / "lakestar/llm/__init__.py").write_text("import no_such_module\n")
    (tmp_path / "corpus_pipeline.py").write_text("import lakestar.llm\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.returncode and "no_such_module" in done.stderr
