from __future__ import annotations

import random

import pytest

from panelloom.llm.registry import importable

WORDS = ["alpha", "Bravo", "charlie", "delta", "écho", "foxtrot", "golf", "hotel", "india", "Juliett", "kilo", "lima"]


@pytest.fixture(autouse=True)
def on_workers(spark):
    importable(spark)


@pytest.fixture
def prose():
    """A text of n words, the same for the same seed."""

    def make(seed: int, n: int) -> str:
        rnd = random.Random(seed)
        return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))

    return make


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table that has further columns, some of clashing names."""

    def make(rows, extra="row string, key long, text_key string, runs int, nth int, shard string, spans int"):
        names = [c.split()[0] for c in extra.split(",")] if extra else []
        schema = "doc_id long, text string" + (", " + extra if extra else "")
        return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], schema)

    return make
