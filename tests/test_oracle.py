"""Every registered query of the core against its SQL on the smallest tables."""

import os

import pytest

from tests.oracle import DATA, differences
from weft.plans import registry

SF = "sf0.001"


@pytest.mark.skipif(not os.path.isdir(f"{DATA}/{SF}"), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, name, SF) == ""


def test_a_name_is_registered_once():
    with pytest.raises(ValueError):
        registry.query("success_by_category")(lambda spark, sf_dir: None)
