from __future__ import annotations

import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_never_imports_the_llm_subpackage():
    for p in (ROOT / "sylva").rglob("*.py"):
        if "llm" in p.relative_to(ROOT / "sylva").parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), p


def test_some_queries_equal_their_sql(spark, sf):
    import duckdb

    import __spark_entry__ as e
    from tools.compare import norm

    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS FROM read_parquet('{p}')")
    q, o = e.queries(), e.oracle_sql()
    for name in ("p2_found", "p3_per_taxid", "balanced_plan", "proportional_allocation", "outcome_scores", "near_pool_sizes", "holdout_selection"):
        df = q[name](spark, sf)
        cols = sorted(df.columns)
        mine = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
        r = con.execute(o[name])
        at = [[x[0] for x in r.description].index(c) for c in cols]
        assert mine == sorted(tuple(norm(row[i]) for i in at) for row in r.fetchall()), name
