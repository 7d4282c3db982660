import oracle
import pytest

from rollbook.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert oracle.differences(QUERIES[name](spark, SF), oracle.connect(SF), SQL[name]) is None


def test_a_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
