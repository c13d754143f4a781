"""Each query of the registry gives the rows of its SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

from vdjspark.jobs import alignments, registry  # noqa: F401 (alignments registers its queries)

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_rows_match_sql(spark, name):
    assert oracle.same(registry.QUERIES[name](spark, SF).toPandas(), oracle.by_sql(registry.ORACLE[name], SF))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["a", "b", "distance"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
