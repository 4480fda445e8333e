"""The operators' queries against their SQL."""

import pytest
from test_queries import duck, same  # noqa: F401

from tidemill.llm import registry


@pytest.mark.parametrize("name", registry.ORACLES)
def test_query(spark, duck, name):  # noqa: F811
    same(spark, duck, registry.QUERIES[name], registry.ORACLES[name])
