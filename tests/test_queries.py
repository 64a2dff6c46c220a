"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check import compare, open_tables  # noqa: E402

from undercut.plans.oracles import ORACLES  # noqa: E402
from undercut.plans.queries import QUERIES  # noqa: E402

TABLES = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are absent")


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, TABLES)
    oracles = oracle_sql()
    if name in oracles:
        rows, differences = compare(df, open_tables(TABLES), oracles[name])
        assert not differences
    else:
        rows = df.count()
    assert rows > 0


def test_every_query_has_sql(spark):
    assert set(QUERIES) <= set(oracle_sql())
    assert set(QUERIES) - set(ORACLES) == {"pit_scores", "stream_predictions"}
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_stream_scores_equal_batch_scores(spark):
    from undercut.operators import features, model
    from undercut.plans import inputs
    from undercut.plans.queries import trained_model

    batch = features.prediction_rows(
        model.score(inputs.project(spark, TABLES, inputs.GAPPY_SQL).where("decoded"), trained_model(spark))
    )
    stream = queries()["stream_predictions"](spark, TABLES)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_entry(spark):
    assert entry(spark).count() > 0
