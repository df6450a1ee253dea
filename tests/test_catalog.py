"""Every catalogue query against its SQL statement, or for rows where it has none."""

import pytest

from compare import connect, differences
from review_pulse.plans import catalog, oracle


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_agrees_with_sql(spark, sf_dir, database, name):
    assert differences(catalog.QUERIES[name](spark, sf_dir), database, oracle.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(oracle.SQL)))
def test_yields_rows(spark, name):
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_every_statement_has_a_query():
    assert set(oracle.SQL) <= set(catalog.QUERIES)


def test_models_store_only_the_columns_they_read(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "stored_rows", lambda rows, path: stored.append(rows.columns) or rows)
    model, held_out = catalog._fitted(spark, "/root/testdata/sf0.001", "svm")
    assert stored == [list(catalog.MODEL_COLUMNS)]
    assert {"review_id", "split", "label", "lemmatized_text"} <= set(held_out.columns)
    assert catalog.models.score(model, held_out).count() == held_out.count()
