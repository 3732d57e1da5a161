import compare
import pytest

import __spark_entry__ as entry
from heatline.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(set(SQL) - {"op1_mixing"}))
def test_equals_sql(spark, tables, name):
    text, _, n = compare.differences(QUERIES[name](spark, tables), compare.connect(tables), SQL[name])
    assert not text and n > 0


def test_all_are_registered():
    known = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in known) == 1
    assert "pipeline" in known
