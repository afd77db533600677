"""What op 4 and the pipeline's token stage keep of words is small."""

from __future__ import annotations

import sys

import numpy as np

from tidemark.llm import bpe_tree
from tidemark.llm.queries import VOCABULARY


def test_kept_words_are_small_and_frequent_ones_stay(monkeypatch):
    enc = bpe_tree.Encoder(VOCABULARY)
    monkeypatch.setattr(bpe_tree, "KEPT_WORDS", 500)
    monkeypatch.setattr(bpe_tree, "BATCH", 7, raising=False)
    texts = [" ".join(["often", "Often,", "café", "x1", *(f"w{k}q{n}" for n in range(300))]).encode() for k in range(8)]
    for text in texts:
        ids, decoded = next(enc.short([text]))
        want = enc.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == enc.tokenizer.decode(want, skip_special_tokens=False)
        assert len(enc.known) <= 500 + 304
    learned = []
    inner = enc.tokenizer

    class Watched:
        def __getattr__(self, name):
            return getattr(inner, name)

        def encode_batch_fast(self, some, **more):
            learned.extend(some)
            return inner.encode_batch_fast(some, **more)

    enc.tokenizer = Watched()
    for k in range(100, 106):
        next(enc.short([" ".join(["x1", *(f"w{k}q{n}" for n in range(300))]).encode()]))
    assert "x1" not in learned and len(learned) == 1_800
    assert all(isinstance(ids, bytes) for ids in enc.known.values()) and max(map(sys.getsizeof, enc.known.values())) < 100
