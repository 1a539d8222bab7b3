"""The entry point, with and without the optional subpackage."""

import ast
import os
import subprocess
import sys
from pathlib import Path

import duckdb

import __spark_entry__
from skyledger.plans import queries as own

ROOT = Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def rows(names, held):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(str(None if r[i] is None or r[i] != r[i] else r[i]) for i in order) for r in held)


def test_own_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert set(own.ORACLES) == set(own.QUERIES)
    for name, query in own.QUERIES.items():
        df = query(spark, SF)
        found = con.execute(own.ORACLES[name])
        columns = [c[0] for c in found.description]
        assert sorted(df.columns) == sorted(columns), name
        assert rows(df.columns, df.collect()) == rows(columns, found.fetchall()), name


def test_smoke(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_optional_subpackage():
    for path in [*ROOT.glob("skyledger/**/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path


def test_entry_without_the_optional_subpackage(tmp_path):
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op1_') for k in e.queries()))"
    for part in ("__spark_entry__.py", "skyledger"):
        os.symlink(ROOT / part, tmp_path / part) if part.endswith(".py") else None
    (tmp_path / "skyledger").mkdir()
    for x in (ROOT / "skyledger").iterdir():
        if x.name not in ("llm", "__pycache__"):
            os.symlink(x, tmp_path / "skyledger" / x.name)
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    # The script's own folder comes first on the path, so the link above decides what is found.
    done = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {str(tmp_path)!r})\n{code}"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.split()[-2:] == [str(len(own.QUERIES)), "False"], done.stderr
