"""Every registered query against its SQL, on the smallest tables."""

import compare
import pytest
from conftest import TESTDATA

from linkweave.plans.oracle import ORACLE
from linkweave.plans.queries import QUERIES

FOLDER = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_statement_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"train_accuracy", "pair_scores", "forest_targets"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, str(FOLDER))
    assert compare.differences(result, duck, ORACLE[name]) is None


def test_forest_queries(spark):
    accuracy = QUERIES["train_accuracy"](spark, str(FOLDER)).first()
    assert accuracy.n > 0 and 0.5 <= accuracy.accuracy <= 1.0
    scores = QUERIES["pair_scores"](spark, str(FOLDER)).collect()
    assert scores and all(0.0 <= row.score <= 1.0 for row in scores)


def test_entry_gives_rows(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark)
    assert rows.columns == ["source_type", "source_id", "target_type", "target_id", "score"]
    assert rows.count() > 0
