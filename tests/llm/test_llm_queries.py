"""The registered queries on the smallest data set."""

from __future__ import annotations

import pytest
from compare import difference, duck
from conftest import SF_DIR

from __spark_entry__ import queries
from aeropunct.llm.queries import ORACLE_SQL, QUERIES


def test_a_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_a_row_for_each_input_row(spark, name):
    table = {"op4": "pages", "op7": "embeddings", "op11": "pages"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    got = QUERIES[name](spark, SF_DIR).count()
    assert got >= rows if name.startswith("op3_") else got == rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, duck(SF_DIR).sql(ORACLE_SQL[name]).df()) is None


def test_native_queries_run_no_python(spark):
    for name in ("op1_pareto_mix", "op5_weak_supervision_pii"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
