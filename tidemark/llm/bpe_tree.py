"""BPE encoding and decoding of whole texts, exactly as the tokenizers library does it.

The vocabularies served here drop white space before they merge, so a text's tokens are those of its words in turn. Words are
encoded by the library once per block of texts and kept for the next ones. Texts over ``long_bytes`` are cut into pieces
that become rows, so one long text is encoded by many tasks. Pieces end at white space where there is some. Longer
unsplit text is cut into halves, again and again: a tree whose leaves are encoded in parallel. To join two parts, a window
around the join is encoded anew and grows until it agrees with the left part on several tokens before the join and with the
right part on several tokens after it. Each neighbouring pair of tokens in the joined list then stands next to each other in
an encoding of a text with both of them, which is what makes a list of tokens the BPE encoding. A window that covers both
parts is exact as such.

Null texts count as empty: no tokens, empty decoded text. Repeated rows give repeated results, an empty table an empty one.
Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.words import blocks

LONG_BYTES = 1 << 16
PIECE_CHARS = 1 << 14
#: Bytes of short texts that are encoded together.
TOGETHER = 1 << 21
#: Tokens that have to agree on each side of a join.
AGREE = 3
#: Words kept encoded by a Python worker.
KEPT_WORDS = 100_000
#: Words that the library gets together.
BATCH = 4096
#: A cut keeps so far away from what may start a special token or a contraction.
MARGIN = 16

ENCODED = "doc_id bigint, n_tokens bigint, ids binary, decoded string"


#: What a vocabulary has to do with a text before it merges: these make its words independent and let letters be
#: looked up as they are. Fixed values, as the library writes them.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
PRE_TOKENIZER = ["Split", "ByteLevel"]
#: Marks that are a run of their own behind a word of letters.
MARKS = ".,;:!?"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """The library's tokenizer with words kept encoded."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        kinds = [[x["type"] for x in (spec[part] or {}).get(more, [])] for part, more in
                 (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if kinds != [NORMALIZER, PRE_TOKENIZER] or spec["decoder"] or spec["post_processor"]:
            raise ValueError(f"{path}: its words depend on each other")
        self.text_of = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.letters = byte_letters()
        #: Packed ids of words, and of what they consist of: a few bytes each, as there are many.
        self.known: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def direct(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return e.ids, e.offsets

    def stem(self, text: str) -> bytes | None:
        """Packed ids of a word of Latin letters, straight from the model: nothing before it would change or split it."""
        if not text.isalpha() or max(text) >= "\u0180" or not (low := text.lower()).isalpha():
            return None
        if (ids := self.stems.get(low)) is None:
            letters = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            ids = self.stems[low] = packed([t.id for t in self.tokenizer.model.tokenize(letters)])
        return ids

    def learn(self, words: set[bytes]) -> None:
        """Encode words not yet known. When too many are, those that come again are kept: most words come once."""
        if len(self.known) > KEPT_WORDS:
            self.known = {word: self.known[word] for word in words.intersection(self.known)}
            self.stems.clear()
        known, rest = self.known, []
        for word in words.difference(known):
            text = word.decode()
            letters = text.rstrip(MARKS)
            marks = text[len(letters):]
            ids = self.stem(letters) if letters else None
            if ids is None:
                rest.append(word)
            else:
                known[word] = ids + self.marks(marks) if marks else ids
        for a in range(0, len(rest), BATCH):
            some = rest[a:a + BATCH]
            for word, e in zip(some, self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                known[word] = packed(e.ids)

    def marks(self, marks: str) -> bytes:
        if (ids := self.stems.get(marks)) is None:
            ids = self.stems[marks] = packed(self.direct(marks)[0])
        return ids

    def short(self, texts: list[bytes]) -> Iterator[tuple[bytes, str]]:
        """Ids and decoded text of texts whose words are of moderate length."""
        split = [t.split() for t in texts]
        self.learn(set().union(*split))
        for words in split:
            ids = b"".join(map(self.known.__getitem__, words))
            yield ids, self.decode(memoryview(ids).cast("I").tolist())

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.text_of.__getitem__, ids))


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


@dataclass
class Part:
    """An encoded piece of unsplit text: token k has ``ids[k]`` and covers the characters of ``spans[k]``."""

    text: str
    ids: list[int]
    spans: list[tuple[int, int]]

    @classmethod
    def of(cls, enc: Encoder, text: str) -> Part:
        return cls(text, *enc.direct(text))


def can_cut(text: str, at: int) -> bool:
    """Whether no character, contraction or special token reaches over ``at``."""
    after = text[at]
    return not (unicodedata.category(after)[0] == "M" or 0x1100 <= ord(after) <= 0x11FF or "'" in text[max(0, at - 3):at + 3]
                or "<|" in text[max(0, at - MARGIN):at + MARGIN])


def halves(text: str, most: int) -> list[str]:
    """``text`` cut in the middle, and its halves again, until no piece is longer than ``most`` where that can be."""
    if len(text) <= most:
        return [text]
    middle = len(text) // 2
    for step in range(len(text) // 4):
        for at in (middle + step, middle - step):
            if can_cut(text, at):
                return halves(text[:at], most) + halves(text[at:], most)
    return [text]


def pieces(text: str, most: int) -> Iterator[tuple[str, bool]]:
    """(piece, whether it goes on the unsplit text of the piece before)."""
    held: list[str] = []
    size = 0
    for word in text.encode().split():
        if len(word) <= most:
            held.append(word.decode())
            size += len(word)
            if size >= most:
                yield " ".join(held), False
                held, size = [], 0
            continue
        if held:
            yield " ".join(held), False
            held, size = [], 0
        for k, half in enumerate(halves(word.decode(), most)):
            yield half, k > 0
    if held:
        yield " ".join(held), False


def agreement(a: Part, shift_a: int, b: Part, shift_b: int, least: int, most: int) -> list[tuple[int, int]]:
    """Where ``AGREE`` tokens of ``a`` and ``b`` in a row have the same ids and characters in [least, most)."""
    place = {(s + shift_b, e + shift_b, b.ids[k]): k for k, (s, e) in enumerate(b.spans)}
    run, out = 0, []
    before = None
    for k, (s, e) in enumerate(a.spans):
        other = place.get((s + shift_a, e + shift_a, a.ids[k])) if least <= s + shift_a and e + shift_a <= most else None
        run = run + 1 if other is not None and before is not None and other == before + 1 else int(other is not None)
        before = other
        if run >= AGREE:
            out.append((k, other))
    return out


def join(enc: Encoder, left: Part, right: Part) -> Part:
    """The encoding of both texts together."""
    cut, both = len(left.text), left.text + right.text
    size = 4 * MARGIN
    while True:
        start, end = max(0, cut - size), min(len(both), cut + size)
        while start and not can_cut(both, start):
            start -= 1
        window = Part.of(enc, both[start:end])
        if start == 0 and end == len(both):
            return window
        before = agreement(left, 0, window, start, start + MARGIN if start else 0, cut - MARGIN) if start else [(-1, -1)]
        after = agreement(right, cut, window, start, cut + MARGIN, end - MARGIN) if end < len(both) else [(len(right.ids), len(window.ids))]
        if before and after:
            (i, u), (j, v) = before[0], after[-1]
            move = lambda spans, by: [(s + by, e + by) for s, e in spans]
            return Part(both, left.ids[:i + 1] + window.ids[u + 1:v] + right.ids[j:],
                        left.spans[:i + 1] + move(window.spans[u + 1:v], start) + move(right.spans[j:], cut))
        size *= 2


def join_all(enc: Encoder, parts: list[Part]) -> Part:
    """Neighbours joined in pairs, up the tree."""
    while len(parts) > 1:
        parts = [join(enc, *parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def encode(docs: DataFrame, path: str, long_bytes: int = LONG_BYTES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Per document ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``.

    ``path`` is the vocabulary's file, which every executor can read.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b in blocks(texts, TOGETHER):
                ids, decoded = zip(*enc.short(texts[a:b]), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(pieces(text, piece_chars))
                unsplit = [goes_on or (k + 1 < len(found) and found[k + 1][1]) for k, (_, goes_on) in enumerate(found)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found), pa.string()), pa.array(range(len(found)), pa.int32()),
                     pa.array([p for p, _ in found], pa.string()), pa.array([g for _, g in found], pa.bool_()),
                     pa.array(unsplit, pa.bool_())], names=["key", "no", "piece", "goes_on", "unsplit"])

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids, spans, texts = [], [], []
            for text, unsplit in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if unsplit:
                    found = Part.of(enc, text)
                    ids.append(found.ids)
                    spans.append([x for span in found.spans for x in span])
                    texts.append(text)
                else:
                    packed, _ = next(enc.short([text.encode()]))
                    ids.append(memoryview(packed).cast("I").tolist())
                    spans.append(None)
                    texts.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(texts, pa.string()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(spans, pa.list_(pa.int32()))],
                names=["key", "no", "goes_on", "piece", "ids", "spans"])

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(path)
        ids: list[int] = []
        run: list[Part] = []
        for row in group.sort_values("no").itertuples():
            if run and not row.goes_on:
                ids += join_all(enc, run).ids
                run = []
            if row.piece is None:
                ids += row.ids.tolist()
            else:
                flat = row.spans.tolist()
                run.append(Part(row.piece, row.ids.tolist(), list(zip(flat[0::2], flat[1::2], strict=True))))
        if run:
            ids += join_all(enc, run).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return pd.DataFrame({"key": [group["key"].iloc[0]], "n_tokens": [len(ids)], "ids": [packed], "decoded": [enc.decode(ids)]})

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    size = F.octet_length("text")
    short = rows.filter(size.isNull() | (size <= long_bytes)).mapInArrow(whole, ENCODED)
    long = rows.filter(size > long_bytes).select("doc_id", F.sha2("text", 256).alias("key"), "text")
    # Copies of a long text are encoded once.
    texts = long.groupBy("key").agg(F.min("text").alias("text"))
    cuts = texts.mapInArrow(cut, "key string, no int, piece string, goes_on boolean, unsplit boolean").repartition("key", "no")
    found = cuts.mapInArrow(encode_pieces, "key string, no int, goes_on boolean, piece string, ids array<int>, spans array<int>")
    whole_ids = found.groupBy("key").applyInPandas(gather, "key string, n_tokens bigint, ids binary, decoded string")
    return short.unionByName(long.select("doc_id", "key").join(whole_ids, "key").select("doc_id", "n_tokens", "ids", "decoded"))
