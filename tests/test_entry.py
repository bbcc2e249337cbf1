import ast
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
ROOT = Path(entry.__file__).parent


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["parent", "src", "dst", "conf", "cooccur", "sim", "gap", "rank"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["seed_prepare", "pre_edges", "beam_chains", "bm25_topk", "subnode_merge", "difficulty_mix", "answer_errors"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    cursor = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    df = entry.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_nothing_outside_imports_llm():
    for p in (ROOT / "skeinworks").rglob("*.py"):
        if "llm" in p.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("skeinworks.llm") for n in names), p
