from __future__ import annotations

import pytest

from ..conftest import SF


@pytest.fixture(scope="session")
def results(spark):
    """The columns and rows of a registered query on the smallest tables; each is run once."""
    from pulsegrid.llm.queries import QUERIES

    held = {}

    def of(name):
        if name not in held:
            df = QUERIES[name](spark, SF)
            held[name] = (df.columns, df.collect())
        return held[name]

    return of
