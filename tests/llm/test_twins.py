"""Queries of the operators give the rows of their SQL twins."""

import oracle
import pytest

from shoreline.llm.queries import RUNNERS, TWINS

SF_DIRS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


@pytest.mark.parametrize("sf_dir", SF_DIRS)
@pytest.mark.parametrize("name", sorted(TWINS))
def test_rows_equal_the_twin(spark, name, sf_dir):
    assert oracle.difference(RUNNERS[name](spark, sf_dir), oracle.connect(sf_dir), TWINS[name]) is None
