"""Node tables of fitted ensembles: the walk in Spark and a walk in SQL agree with the library's own scoring."""

import duckdb
import pytest
from conftest import SF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallywire.operators import models, split, trees
from tallywire.operators.features import build_features
from tallywire.functions import fill_numeric
from tallywire.queries.common import tx


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "rows")
    build_features(tx(spark, SF)).write.parquet(path)
    rows = models.assemble(fill_numeric(spark.read.parquet(path), 0))
    params = models.GbtParams(maxDepth=4, maxIter=6)
    return models.fit_gbt(split.with_class_weight(rows), params), rows


def test_walk_equals_the_model(fitted):
    model, rows = fitted
    nodes = trees.node_table(model)
    both = trees.walked(model.transform(rows), nodes, 4)
    wrong = both.where((F.abs(vector_to_array("probability")[1] - F.col("walk_prob_1")) > 1e-9) | (F.col("prediction") != F.col("walk_prediction")))
    assert both.count() == 1000 and wrong.count() == 0
    # a cut walk ends before the leaves of some rows
    assert trees.walked(model.transform(rows), nodes, 1).where(F.abs(vector_to_array("probability")[1] - F.col("walk_prob_1")) > 1e-9).count() > 0


def test_sql_walk_over_the_node_table(fitted, tmp_path):
    model, rows = fitted
    trees.node_table(model).write.parquet(str(tmp_path / "nodes"))
    scored = model.transform(rows).select("transaction_id", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"))
    scored.write.parquet(str(tmp_path / "rows"))
    sql = f"""WITH RECURSIVE nodes AS (SELECT * FROM '{tmp_path}/nodes/*.parquet'), data AS (SELECT * FROM '{tmp_path}/rows/*.parquet'),
    walk(transaction_id, tree, node) AS (
      SELECT transaction_id, tree, 0 FROM data, (SELECT DISTINCT tree FROM nodes)
      UNION ALL
      SELECT w.transaction_id, w.tree, CASE WHEN d.x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END
      FROM walk w JOIN nodes n USING (tree, node) JOIN data d USING (transaction_id) WHERE n."left" IS NOT NULL)
    SELECT max(abs(p - 1 / (1 + exp(-2 * m)))), count(*) FROM (SELECT transaction_id, sum(n.weight * n.prediction) AS m
      FROM walk JOIN nodes n USING (tree, node) WHERE n."left" IS NULL GROUP BY 1) JOIN data USING (transaction_id)"""
    apart, n = duckdb.sql(sql).fetchall()[0]
    assert n == 1000 and apart < 1e-9


def test_walk_takes_whole_batches(fitted, conf, spark):
    """Trees are walked for a batch of rows at once, whatever its size; the ensemble does not go along with each row."""
    model, rows = fitted
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    both = trees.walked(model.transform(rows.limit(100).unionByName(rows.limit(1))), trees.node_table(model), 4)
    assert both.where(F.abs(vector_to_array("probability")[1] - F.col("walk_prob_1")) < 1e-9).count() == 101
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    empty = trees.walked(model.transform(rows.where("false")), trees.node_table(model), 4)
    assert empty.count() == 0
