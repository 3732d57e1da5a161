"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry
from heatline.plans.catalog import QUERIES

# On the smallest tables the first refits of these are singular, where no solution is the only one.
FULLER = {"walk_forward_ar5", "walk_forward_error"}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(QUERIES)))
def test_equals_sql(spark, tables, name):
    folder = "/root/testdata/sf0.01" if name in FULLER else tables
    text, _, n = compare.differences(QUERIES[name](spark, folder), compare.connect(folder), entry.oracle_sql()[name])
    assert not text and n > 0


# More fits of the same boosted model as in score_messages and holdout_scores, a minute and more each.
SLOW = {"retrained_scores", "stream_scores", "tuned_rounds"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(entry.oracle_sql()) - SLOW))
def test_gives_rows(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_outliers_are_found(spark):
    folder = "/root/testdata/sf0.01"
    for name in ("anomalies", "anomalous_lengths"):
        assert QUERIES[name](spark, folder).where("isAnomaly = 1").count() > 0


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["series", "times", "prediction", "isAnomaly"] and got.count() > 0
