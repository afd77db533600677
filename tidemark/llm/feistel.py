"""Personal data replaced by format-preserving pseudonyms, made by a keyed Feistel permutation.

Each validated value is a number in the range of its format (the sixteen-digit card numbers that pass their check, the days
of a calendar, ...). A Feistel network over two factors of about equal size permutes the range; results beyond the
range are permuted again until they fall inside, which keeps it a permutation. So equal values get equal pseudonyms in
every document, different values different ones, and a pseudonym is a valid value of the same form. Separators
stay where they are.

Formats: card numbers (Luhn check), bank account numbers (IBAN check), social security numbers, phone numbers, IPv4 addresses,
dates, mail addresses, and access keys or assigned secrets. What fails its check stays as it is. Of a run of digit groups that
fails as a whole, parts at its group borders are tried (a card before an expiry, a bank account before a word), and the scan goes
on behind the first group. A part that is taken as a card has groups of three digits or more, but for its last.

Null and empty texts stay. Repeated rows give repeated results, an empty table an empty one. All columns other than ``text``
pass through under any name.
"""

from __future__ import annotations

import calendar
import datetime
import hashlib
import hmac
import math
import re
import string
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The key of tests and examples; production passes its own.
KEY = b"tidemark-pseudonyms"
ROUNDS = 8

DIGITS, LOWER, UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase


def permuted(key: bytes, tweak: str, n: int, x: int) -> int:
    """The image of ``x`` under the keyed permutation of 0 ... n - 1 named by ``tweak``."""
    if n < 2:
        return x
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for r in range(ROUNDS):
            if r % 2:
                right = (right + _round(key, tweak, r, n, left)) % b
            else:
                left = (left + _round(key, tweak, r, n, right)) % a
        x = left * b + right
        if x < n:
            return x


def _round(key: bytes, tweak: str, r: int, n: int, x: int) -> int:
    """A number much longer than ``n``, so that its remainders are even."""
    size = n.bit_length() // 16 + 17
    seed = hmac.new(key, f"{tweak}|{n}|{r}|{x}".encode(), hashlib.sha256).digest()
    return int.from_bytes(hashlib.shake_128(seed).digest(size), "big")


def shuffle(key: bytes, tweak: str, text: str, alphabets: Sequence[str]) -> str:
    """``text``, whose k-th character is in ``alphabets[k]``, as another such text."""
    n, x = 1, 0
    for ch, letters in zip(text, alphabets, strict=True):
        n, x = n * len(letters), x * len(letters) + letters.index(ch)
    x = permuted(key, tweak, n, x)
    out = []
    for letters in reversed(alphabets):
        x, k = divmod(x, len(letters))
        out.append(letters[k])
    return "".join(reversed(out))


def classes(text: str) -> list[str]:
    """Digits stay digits, small letters small letters, capitals capitals."""
    return [DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else c for c in text]


def refill(form: str, chars: str, fits: Callable[[str], bool]) -> str:
    """``form`` with its fitting characters replaced by ``chars`` in turn."""
    rest = iter(chars)
    return "".join(next(rest) if fits(c) else c for c in form)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def luhn_digit(payload: str) -> str:
    total = sum(d if k % 2 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(payload))))
    return str(-total % 10)


def card(key: bytes, text: str) -> str | None:
    d = digits_of(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    payload = d[0] + shuffle(key, "card", d[1:-1], [DIGITS] * (len(d) - 2))
    return refill(text, payload + luhn_digit(payload), DIGITS.__contains__)


def iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(key: bytes, text: str) -> str | None:
    c = text.replace(" ", "")
    if not 15 <= len(c) <= 34 or iban_remainder(c[4:] + c[:4]) != 1:
        return None
    account = shuffle(key, "iban", c[4:], classes(c[4:]))
    check = 98 - iban_remainder(account + c[:2] + "00")
    return refill(text, f"{c[:2]}{check:02d}{account}", lambda ch: ch != " ")


#: Area numbers in use: 001 ... 899 without 666.
_AREAS = [a for a in range(1, 900) if a != 666]


def social_security(key: bytes, text: str) -> str | None:
    area, group, serial = map(int, re.split(r"[- ]", text))
    if area not in _AREAS or not group or not serial:
        return None
    x = (_AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(permuted(key, "ssn", len(_AREAS) * 99 * 9999, x), 9999)
    area, group = divmod(x, 99)
    return refill(text, f"{_AREAS[area]:03d}{group + 1:02d}{serial + 1:04d}", DIGITS.__contains__)


def phone(key: bytes, text: str) -> str | None:
    d = digits_of(text)
    if not 8 <= len(d) <= 15:
        return None
    country = re.match(r"\+([0-9]{1,3})[^0-9]", text)
    keep = len(country[1]) if country else 0
    alphabets = [DIGITS] * (len(d) - keep)
    if len(alphabets) == 10 and d[keep] in "23456789" and d[keep + 3] in "23456789":  # an area code and an exchange
        alphabets[0] = alphabets[3] = "23456789"
    return refill(text, d[:keep] + shuffle(key, "phone", d[keep:], alphabets), DIGITS.__contains__)


def ipv4(key: bytes, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    ranges = [[(0, 10), (10, 90), (100, 156)][len(p) - 1] for p in parts]  # first, count
    n, x = 1, 0
    for p, (first, count) in zip(parts, ranges, strict=True):
        n, x = n * count, x * count + int(p) - first
    x = permuted(key, "ip", n, x)
    out = []
    for first, count in reversed(ranges):
        x, k = divmod(x, count)
        out.append(str(first + k))
    return ".".join(reversed(out))


FIRST_DAY = datetime.date(1900, 1, 1)
DAYS = (datetime.date(2100, 1, 1) - FIRST_DAY).days


def date(key: bytes, text: str) -> str | None:
    """Years 1900 to 2099; year first, or day and month first with the day before the month where both fit."""
    numbers = re.findall(r"[0-9]+", text)
    order = (0, 1, 2) if len(numbers[0]) == 4 else (2, 1, 0)
    year, month, day = (int(numbers[k]) for k in order)
    if month > 12 and order[0] == 2:
        order, month, day = (2, 0, 1), day, month
    if not 1900 <= year <= 2099 or not 1 <= month <= 12 or not 1 <= day <= calendar.monthrange(year, month)[1]:
        return None
    at = FIRST_DAY + datetime.timedelta(permuted(key, "date", DAYS, (datetime.date(year, month, day) - FIRST_DAY).days))
    new = dict(zip(order, (f"{at.year:04d}", f"{at.month:02d}", f"{at.day:02d}"), strict=True))
    separators = re.findall(r"[^0-9]", text)
    return new[0] + separators[0] + new[1] + separators[1] + new[2]


def mail(key: bytes, text: str) -> str | None:
    name, _, host = text.rpartition("@")
    rest, _, top = host.rpartition(".")
    changed = name + "@" + rest
    return shuffle(key, "mail", changed, classes(changed)) + "." + top


def secret(key: bytes, text: str) -> str | None:
    letters = classes(text)
    if re.fullmatch(r"[0-9a-f]+", text):
        letters = ["0123456789abcdef"] * len(text)
    return shuffle(key, "secret", text, letters)


#: Kind, pattern and replacement, the first that fits counts. A group ``v`` is the part to replace.
KINDS: list[tuple[str, str, Callable[[bytes, str], str | None]]] = [
    ("mail", r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,}", mail),
    ("secret", r"\b(?:AKIA|ASIA)(?P<v1>[0-9A-Z]{16})\b", secret),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))\s{0,3}[=:]\s{0,3}[\"']?(?P<v2>[A-Za-z0-9_\-./+]{8,})",
     secret),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    ("date", r"(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4})(?:(?![\w-])|(?=[Tt][0-9]{2}))", date),
    ("ssn", r"(?<![\w-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![\w-])", social_security),
    ("ip", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", ipv4),
    ("card", r"(?:(?<![\w.-])|(?<=[0-9]-))[0-9](?:[ -]?[0-9]){12,18}(?![\w])", card),
    ("phone", r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)"
              r"|(?<![\w.])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?!\w)|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?!\w)", phone),
]
_PATTERN = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p, _) in enumerate(KINDS)))
_MAY_HOLD = re.compile(r"[0-9@=:]")


_ONE = [re.compile(p) for _, p, _ in KINDS]
_NAMES = [name for name, _, _ in KINDS]
#: A word and the marks before it; digit groups that follow one another, more of them than a card and what follows it have.
_FIRST, _RUN = re.compile(r"\W*\w+"), re.compile(r"[0-9]+(?:[ -][0-9]+){0,24}(?!\w)")
_DIGIT_RUN = re.compile(r"[0-9]+")
#: What a value other than the first of a run of digit groups begins with.
_OPENS = re.compile(r"[0-9]{3}[- ][0-9]{2}[- ]|[0-9]{3}[-.]|[0-9]{1,2}[-/.]|[0-9]{4}")
#: Digit groups as cards are written.
_CARD_FORMS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 3, 3, 3), (4, 4, 4, 4, 3), (6, 13), *((n,) for n in range(13, 20))}


@lru_cache(100_000)
def pseudonym(key: bytes, i: int, value: str) -> str | None:
    return KINDS[i][2](key, value)


def _groups(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _DIGIT_RUN.finditer(text, start, end)]


def _before_others(key: bytes, text: str, groups: list[tuple[int, int]], others: Sequence[str]) -> list[tuple[int, int]]:
    """``groups`` up to the first, other than the first of all, at which a value of one of ``others`` begins."""
    for n, (a, _) in enumerate(groups):
        if n and text[a - 1] == " " and _OPENS.match(text, a):
            for k, name in enumerate(_NAMES):
                if name in others and (m := _ONE[k].match(text, a)):
                    spans = [m.span()] if name != "card" else [s for s, rank in _cards(text, a, m.end()) if s[0] == a and not rank]
                    if any(pseudonym(key, k, text[b:c]) is not None for b, c in spans):
                        return groups[:n]
    return groups


def _cards(text: str, start: int, end: int, groups: list[tuple[int, int]] | None = None) -> list[tuple[tuple[int, int], int]]:
    """Spans of 13 to 19 digits that begin in the match, with 0 if they have the form of a card, 1 if they are the match, or 2."""
    if groups is None:
        m = _RUN.match(text, start)
        groups = _groups(text, start, m.end() if m else end)
    found, size = [], [b - a for a, b in groups]
    for i, (a, _) in enumerate(groups):
        if a >= end:
            break
        if a != start and size[i] < 3:  # begins no card but the match itself
            continue
        total, short = 0, False
        for j in range(i, len(groups)):
            total += size[j]
            if total > 19 or short and a != start:
                break
            b = groups[j][1]
            if total >= 13 and not short and (form := tuple(size[i:j + 1])) in _CARD_FORMS:
                found.append(((a, b), 0))
            elif total >= 13 and (a, b) == (start, end):
                found.append(((a, b), 1))
            elif total >= 13 and not short:
                found.append(((a, b), 2))
            short |= size[j] < 3
    return sorted(found, key=lambda f: (f[1], f[0][0], -f[0][1]))


def _spans(key: bytes, i: int, text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Parts of a match of kind ``i`` to try in turn: the whole and what ends or begins at its group borders."""
    name = _NAMES[i]
    if name == "iban":
        return [(start, end), *((start, start + m.start()) for m in reversed(list(re.finditer(" ", text[start:end]))))]
    if name == "card":
        m = _RUN.match(text, start)
        groups = _before_others(key, text, _groups(text, start, m.end() if m else end), ("date", "ssn", "ip", "phone"))
        return [s for s, _ in _cards(text, start, min(end, groups[-1][1]), groups)]
    if name == "phone":
        whole = _groups(text, start, end)
        groups = _before_others(key, text, whole, ("date", "ssn", "ip", "card", "phone"))
        return [(start, b) for _, b in reversed(groups)]
    return [(start, end)]


def _valid(key: bytes, i: int, text: str, start: int, end: int) -> tuple[int, int, str] | None:
    """Start, end and pseudonym of the first part that is valid."""
    for a, b in _spans(key, i, text, start, end):
        new = pseudonym(key, i, text[a:b])
        if new is not None:
            return a, b, new
    return None


def pseudonymised(key: bytes, text: str) -> tuple[str, int]:
    """(text with pseudonyms, how many)."""
    out: list[str] = []
    done = at = pos = 0
    while m := _PATTERN.search(text, pos):
        i = int(m.lastgroup[1:]) if m.lastgroup[0] == "k" else next(k for k in range(len(KINDS)) if m[f"k{k}"] is not None)
        part = next((g for g in ("v1", "v2") if m[g] is not None), None)
        if part:
            found = (*m.span(part), pseudonym(key, i, m[part]))
        else:
            found = _valid(key, i, text, *m.span())
            for k in range(i + 1, len(KINDS)):  # not valid as this kind; perhaps as a later one
                if found is None and (other := _ONE[k].match(text, m.start())):
                    found = _valid(key, k, text, *other.span())
        if found is None:
            pos = _FIRST.match(text, m.start()).end()
            continue
        start, end, new = found
        out.append(text[at:m.start()])
        before, n = (text[m.start():start], 0) if part else pseudonymised(key, text[m.start():start])
        out += before, new
        done += n + 1
        at = pos = end
    return "".join([*out, text[at:]]), done


def pseudonymise(docs: DataFrame, key: bytes = KEY, column: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``column``; ``count`` names a further column for their number."""
    at = docs.columns.index(column)
    schema = T.StructType([*docs.schema.fields, *([T.StructField(count, T.LongType())] if count else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(t, 0) if t is None or not _MAY_HOLD.search(t) else pseudonymised(key, t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], batch.schema.field(at).type)
            if count:
                columns.append(pa.array([n for _, n in done], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
