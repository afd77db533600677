"""Words are hashed all at once; what goes to the driver has a fixed size."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import count_vectors, words
from tidemark.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(4, "tests")


def some_words(seed):
    r = random.Random(seed)
    made = ["".join(r.choices("ab\x00é", k=r.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 24, 63, 64, 65, 200]))).encode() for _ in range(3_000)]
    return [*made, b"a", b"a\x00", b"a\x00\x00", b"b" * 8, b"b" * 8 + b"\x00", b"b" * 64, b"b" * 65, b"\x00" * 7, b"\x00" * 8, b"\x00" * 9]


def test_numbers_tell_words_apart_in_any_place(monkeypatch):
    texts = [b" ".join(some_words(seed)) for seed in (1, 2, 1)] + [b"", b" ", b"a"]
    split = [w for t in texts for w in t.split()]
    whole = words.Words(texts).numbers()
    monkeypatch.setattr(words, "PIECE", 7)
    assert words.Words(texts).numbers().tolist() == whole.tolist() and len(whole) == len(split)
    assert len(set(whole.tolist())) == len(set(split)) == len(set(zip(split, whole.tolist(), strict=True)))
    assert len(words.Words([b"", b" "]).numbers()) == 0


def test_shingles_make_no_object_of_each_word(monkeypatch):
    monkeypatch.setattr(words.Words, "hashes", lambda self: pytest.fail("words one by one"))
    texts = [b"A b c d e f a b c d e", b"a b c d e f", b"x", b"", b"a b c d e f a b c d e"]
    sets = list(count_vectors.shingle_sets(texts))
    assert [len(s) for s in sets] == [6, 2, 1, 0, 6] and (sets[0] == sets[4]).all() and np.isin(sets[1], sets[0]).all()
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets)


def test_the_driver_gets_the_filter_as_bits(spark, monkeypatch):
    texts = spark.range(5_000).selectExpr("xxhash64(id) text_key").union(spark.sql("SELECT -1L UNION ALL SELECT 0L UNION ALL SELECT 0L"))
    want = np.zeros(count_vectors.FILTER_BITS, bool)
    want[[r["text_key"] % count_vectors.FILTER_BITS for r in texts.collect()]] = True
    sent, collect_ = [], type(texts).collect
    monkeypatch.setattr(type(texts), "collect", lambda self: (sent.append(collect_(self)), sent[-1])[1])
    monkeypatch.setattr(type(texts), "toPandas", lambda self: pytest.fail("places one by one"))
    found = count_vectors._active_filter(texts)
    assert (np.unpackbits(found).astype(bool) == want).all() and [len(rows) <= count_vectors.FILTER_RANGES for rows in sent] == [True]
    assert not count_vectors._active_filter(texts.filter("false")).any()
