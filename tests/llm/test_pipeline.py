"""The corpus pipeline stage by stage, queries with SQL twins, and the optional package."""

import subprocess
import sys

import pytest
from check import connect
from conftest import SF
from test_brute_force import classes, print_of

import __spark_entry__
import corpus_pipeline
from tallywire.llm.queries import ORACLES, QUERIES


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, name):
    df = QUERIES[name](spark, SF)
    want = connect(SF).sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_every_operator_has_a_query():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert set(after) <= set(before)
        if name != "mixing":
            assert docs.columns == columns and len(rows) == len(after)
        if name == "quality rules":
            verdict = {r["doc_id"] for r in QUERIES["op1_quality"](spark, SF).collect() if r["kept"]}
            assert set(after) == verdict
        if name == "line dedup":
            assert set(after) == set(before) and all(len(r["text"]) == r["n_chars"] for r in rows)
        if name == "SimHash near-dedup":
            lowest = classes({i: print_of(r["text"]) for i, r in before.items()})
            assert set(after) == set(lowest.values())
        if name == "mixing":
            assert {"pass_no", "position"} <= set(docs.columns)
            assert all(r["text"] == before[r["doc_id"]]["text"] for r in rows)
        before = after


def test_entry_works_without_the_package():
    code = "\n".join(
        [
            "import sys",
            "class Gone:",
            "    def find_spec(self, name, path=None, target=None):",
            "        if name in ('corpus_pipeline', 'tallywire.llm'):",
            "            raise ModuleNotFoundError(name, name=name)",
            "sys.meta_path.insert(0, Gone())",
            "import __spark_entry__ as e",
            "assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())",
        ]
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(__import__("pathlib").Path(__spark_entry__.__file__).parent))
