"""Every query of the package runs, and gives the rows its SQL gives where it has any."""

import pytest

from compare import DATA, differences, oracle
from drayage.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return oracle()


def test_there_is_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    assert differences(df.collect(), df.columns, con.execute(SQL[name])) is None
