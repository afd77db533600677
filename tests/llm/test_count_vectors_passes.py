"""Op 8 goes through the texts three times, and only through some the last time."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import count_vectors
from tidemark.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(4, "tests")


def test_shared_shingles_are_counted_on_stored_sets(spark, monkeypatch):
    """What is shared is found, and what one text has for itself is dropped, with no text at hand."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words), None, "", " ".join(f"z{k}" for k in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    order = count_vectors.fine_counts(docs)
    stored = count_vectors.rare_sets(docs, order, 80)
    seen = []
    inner = count_vectors.shared_slots
    monkeypatch.setattr(count_vectors, "shared_slots", lambda sets: (seen.append(sets.columns), inner(sets))[1])
    found = {r["doc_id"]: r for r in count_vectors.spread_sets(stored).collect()}
    assert seen == [["doc_id", "set_key", "n", "rare", "text_key"]]
    before = {r["doc_id"]: r for r in stored.collect()}
    assert [found[k]["n"] for k in range(6)] == [56, 56, 56, 0, 0, 36]
    assert found[0]["rare"] == found[2]["rare"] == before[0]["rare"] and len(found[0]["rare"]) > 0
    assert set(found[1]["rare"]) == set(before[0]["rare"]) & set(before[1]["rare"])
    assert found[5]["rare"] == [] and len(before[5]["rare"]) > 0 and found[3]["rare"] == []


def test_only_texts_of_active_sets_are_looked_at(spark):
    docs = spark.createDataFrame([(k, f"{k} a b c d e f g") for k in range(50)] + [(50, "7 a b c d e f g"), (51, None)], "doc_id bigint, text string").coalesce(1)
    sets = count_vectors.rare_sets(docs, np.zeros(1 << 16, np.int64), 80).cache()
    active = sets.filter("doc_id IN (3, 7)").select("set_key")
    found = {r["set_key"]: r for r in count_vectors.active_sets(docs, sets, active).collect()}
    assert set(found) == {r["set_key"] for r in active.collect()} and all(r["n"] == 4 for r in found.values())
    assert all(sum(r["counts"]) == 4 for r in found.values())
