"""Streaming twins of the keyed operators, as stateful processors.

Rows are kept until the watermark has passed their time and are then handled in time order, equal times settled by
the other columns. So the answer does not depend on how rows were cut into batches, nor on how many a key has: it is
that of the batch form in ``operators.keyed`` for all rows that are not late. ``keep`` milliseconds of event time after a key's last row its
state is forgotten; None keeps it for ever. The original's values are named at each operator.

Keys are dealt to ``BUCKETS`` groups by hash, and a processor is called once for a group's rows of a batch: its timer, its waiting rows and
its keys' states are kept for many keys at once, so a batch costs state calls by the group, not by the row. Waiting rows are kept in pieces by
time and handed out in slices of an hour: what a worker holds of a group at once is one slice and a piece of each ``HELD`` rows that came, however many rows a
key has.

Days are calendar days at a fixed offset from UTC (business zone: +8 hours).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StringType, StructField, StructType, TimestampType

from tidemark.sources.cdc import with_event_time

DAY_MS = 86_400_000
BUSINESS_OFFSET_MS = 8 * 3_600_000
#: Groups that keys are dealt to, and the parts in which a group keeps their states.
BUCKETS, PARTS = 512, 16
#: Rows handed to the state store at once, and rows that wait in a worker for that or to be given out.
PIECE, HELD = 1_000, 10_000
#: Rows that wait are handed out by slices of event time this long.
SLICE_MS = 3_600_000
#: Interval joins: groups that keys and slices are dealt to, rows that are joined at once, and rows in a piece of the state.
JOIN_BUCKETS, JOINED, JOIN_PIECE = 128, 100_000, 20_000


def _with(schema: StructType, *extra: StructField) -> StructType:
    return StructType([*schema.fields, *extra])


def _comparable(value):
    """Something that sorts, nulls first, also where ``value`` is a map, a list or a struct."""
    if isinstance(value, dict):
        value = sorted((str(k), _comparable(v)) for k, v in value.items())
    elif isinstance(value, (list, tuple)):
        value = [_comparable(v) for v in value]
    return value is not None, value


def _plain(value, kind: DataType):
    """``value`` of a type with plain tuples for structs."""
    if value is None:
        return None
    if isinstance(kind, StructType):
        parts = value.values() if isinstance(value, dict) else value
        return tuple([_plain(part, f.dataType) for part, f in zip(parts, kind.fields, strict=True)])
    if isinstance(kind, ArrayType):
        return [_plain(v, kind.elementType) for v in value]
    if isinstance(kind, MapType):
        return {_plain(k, kind.keyType): _plain(v, kind.valueType) for k, v in dict(value).items()}
    return value


class _PerKey(StatefulProcessor):
    """Rows of a group of keys are held back until the watermark has passed them, then folded key by key in time order.

    Of each key there is an entry ``[last, state]``: the time of its last row (where it counts) and what ``fold`` makes of it.
    """

    out: Sequence[str] = ()  # names of the output columns
    held_names: Sequence[str] = ()
    keys: Sequence[str] = ()
    #: The type of a row, if it holds lists, maps or structs.
    nested: StructType | None = None
    keep: int | None = None
    #: Whether entries end also without ``keep``.
    forgets = False
    #: Rows of a batch are folded at once instead of waiting, and come with this column, their event time, for what follows.
    hand_on: str | None = None

    def __init__(self, ms: str, ties: Sequence[str] = ()):
        self.ms, self.ties = ms, list(ties)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        names = list(self.held_names)
        self.at, self.ties_at = names.index(self.ms), [names.index(c) for c in self.ties]
        self.time = itemgetter(self.at)
        self.keys_at = [names.index(c) for c in self.keys]
        self.waiting = handle.getMapState("waiting", "piece bigint", "held binary")
        self.states = handle.getMapState("states", "part bigint", "entries binary")
        #: What waits, as (first time, piece), when each part has to be looked at, and the timer that is set.
        self.index = handle.getValueState("index", "held binary")

    # -- what is kept of a group ------------------------------------------------------------------------

    def _begin(self) -> None:
        self.pieces, self.ends, self.due, self.given = pickle.loads(self.index.get()[0]) if self.index.exists() else ([], {}, None, 0)
        self.loaded: dict[int, dict] = {}
        self.changed: set[int] = set()
        self.ahead: dict[int, list[tuple]] = {}

    def _end(self) -> None:
        """Keep what has changed, and set the timer to whatever is next."""
        for part in self.changed:
            entries = self.loaded[part]
            if entries:
                self.states.updateValue((part,), (pickle.dumps(entries, 5),))
            elif self.states.containsKey((part,)):
                self.states.removeKey((part,))
            ends = [end for end in map(self.end_of, entries.values()) if end is not None]
            self.ends.pop(part, None)
            if ends:
                self.ends[part] = min(ends)
        times = [first for first, _ in self.pieces] + list(self.ends.values())
        if times and (self.due is None or min(times) < self.due):
            self.due = int(min(times))
            self.handle.registerTimer(self.due)
        if times or self.due is not None:
            self.index.update((pickle.dumps((self.pieces, self.ends, self.due, self.given), 5),))
        else:
            self.index.clear()
        self.loaded, self.ahead = {}, {}

    def _entries(self, part: int) -> dict:
        if part not in self.loaded:
            found = self.states.getValue((part,)) if self.states.containsKey((part,)) else None
            self.loaded[part] = pickle.loads(found[0]) if found else {}
        return self.loaded[part]

    def entry(self, key: tuple) -> list:
        """The entry of a key, which will be changed."""
        part = crc32(repr(key).encode()) % PARTS
        self.changed.add(part)
        return self._entries(part).setdefault(key, [None, None])

    def end_of(self, entry: list) -> int | None:
        """When there is something to forget of an entry."""
        return None if self.keep is None else entry[0] + self.keep

    def lasts(self, entry: list, passed: int) -> bool:
        """Whether anything of an entry is still needed, as rows to come are later than ``passed``."""
        return entry[0] + self.keep > passed

    def _forget(self, passed: int) -> None:
        if self.keep is None and not self.forgets:
            return
        for part in {part for part, end in self.ends.items() if end <= passed} | self.changed:
            self.loaded[part] = {key: entry for key, entry in self._entries(part).items() if self.lasts(entry, passed)}
            self.changed.add(part)

    # -- rows that wait ---------------------------------------------------------------------------------

    def _put(self, rows: list[tuple]) -> None:
        rows.sort(key=self.time)
        for k in range(0, len(rows), PIECE):
            some = rows[k:k + PIECE]
            self.waiting.updateValue((self.given,), (pickle.dumps(some, 5),))
            self.pieces.append((some[0][self.at], self.given))
            self.given += 1

    def _take(self, part: int, pieces: Sequence[int]) -> list[tuple]:
        """The rows of a slice, given the pieces that begin in it; what those hold of later slices stays for these."""
        for piece in pieces:
            for row in pickle.loads(self.waiting.getValue((piece,))[0]):
                self.ahead.setdefault(row[self.at] // SLICE_MS, []).append(row)
            self.waiting.removeKey((piece,))
        return self.ahead.pop(part, [])

    def _release(self, passed: float) -> Iterator[tuple]:
        """Fold the rows up to ``passed``, slice after slice."""
        begun: dict[int, list[int]] = {}
        for first, piece in self.pieces:
            if first <= passed:
                begun.setdefault(first // SLICE_MS, []).append(piece)
        self.pieces = [(first, piece) for first, piece in self.pieces if first > passed]
        rest: list[tuple] = []
        while begun or self.ahead:
            part = min([*begun, *self.ahead])
            if part * SLICE_MS > passed:
                break
            ready = self._take(part, begun.pop(part, ()))
            if (part + 1) * SLICE_MS > passed:  # the slice that the watermark is in
                rest += [row for row in ready if self.time(row) > passed]
                ready = [row for row in ready if self.time(row) <= passed]
            yield from self._fold_rows(ready)
        self._put([row for rows in (rest, *self.ahead.values()) for row in rows])

    def key_of(self, row: tuple) -> tuple:
        return tuple([row[k] for k in self.keys_at])

    def _in_order(self, rows: list[tuple]) -> Iterator[tuple]:
        rows.sort(key=self.time)
        for _, same in groupby(rows, key=self.time):
            equal = list(same)
            if len(equal) > 1:
                equal.sort(key=lambda row: [_comparable(row[c]) for c in self.ties_at])
            yield from equal

    def _fold_rows(self, rows: list[tuple]) -> Iterator[tuple]:
        by_key: dict[tuple, list[tuple]] = {}
        for row in self._in_order(rows):
            by_key.setdefault(self.key_of(row), []).append(row)
        for key, some in by_key.items():
            entry = self.entry(key)
            yield from self.fold(key, some, entry) if self.keep is None else self.fold_apart(key, some, entry)

    # -- what Spark calls ---------------------------------------------------------------------------------

    def _rows(self, frames: Iterable[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            if self.nested is None:
                yield from (tuple(row.values()) for row in frame["row"])
            else:
                yield from (_plain(row, self.nested) for row in frame["row"])

    def _frames(self, rows: Iterable[tuple], size: int = HELD) -> Iterator[pd.DataFrame]:
        some: list[tuple] = []
        for row in rows:
            some.append(row)
            if len(some) == size:
                yield self._frame(some)
                some = []
        if some:
            yield self._frame(some)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in zip(self.out, zip(*rows, strict=True), strict=True)})
        if self.hand_on:
            frame[self.hand_on] = pd.to_datetime(frame[self.out[list(self.out).index(self.ms)]].astype("int64"), unit="ms", utc=True)
        return frame

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._begin()
        held: list[tuple] = []
        for row in self._rows(rows):
            held.append(row)
            if len(held) == HELD:
                self._put(held)
                held = []
        if self.hand_on and not self.pieces:  # few enough to need no store
            yield from self._frames(self._fold_rows(held))
        else:
            self._put(held)
            if self.hand_on:
                yield from self._frames(self._release(float("inf")))
        self._end()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        self._begin()
        if self.due is not None and self.due <= passed:
            self.due = None
        yield from self._frames(self._released(passed))
        self._end()

    def _released(self, passed: int) -> Iterator[tuple]:
        yield from self._release(passed)
        self._forget(passed)

    def fold_apart(self, key: tuple, rows: list[tuple], entry: list) -> Iterator[tuple]:
        """Rows after a pause of ``keep`` find no state, whether or not a timer came between."""
        last, start = entry[0], 0
        for k, row in enumerate(rows):
            ms = row[self.at]
            if last is not None and ms - last >= self.keep:
                if k > start:
                    yield from self.fold(key, rows[start:k], entry)
                entry[1] = None
                start = k
            last = ms
        yield from self.fold(key, rows[start:], entry)
        entry[0] = last

    def fold(self, key: tuple, rows: list[tuple], entry: list) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class FlagFirstOfDay(_PerKey):
    """All records, with a 1 on the first of each day and a 0 on the rest."""

    def __init__(self, ms: str, offset: int, ties: Sequence[str] = ()):
        super().__init__(ms, ties)
        self.offset = offset

    def key_of(self, row):
        return *super().key_of(row), (row[self.at] + self.offset) // DAY_MS

    def fold(self, key, rows, entry):
        for row in rows:
            yield *row, int(entry[1] is None)
            entry[1] = key[-1]


class RepairIsNew(_PerKey):
    """``is_new`` set to "0" where a device claims to be new on a day other than its stored one."""

    def __init__(self, ms: str, flag: str, offset: int):
        super().__init__(ms, [flag])
        self.flag, self.offset = flag, offset

    def init(self, handle):
        super().init(handle)
        self.flag_at = list(self.held_names).index(self.flag)

    def fold(self, key, rows, entry):
        flag = self.flag_at
        if entry[1] is None:
            entry[1] = (rows[0][self.at] + self.offset) // DAY_MS - (0 if rows[0][flag] == "1" else 1)
        for row in rows:
            wrong = row[flag] == "1" and (row[self.at] + self.offset) // DAY_MS != entry[1]
            yield (*row[:flag], "0", *row[flag + 1:]) if wrong else row


class RepairTexts(RepairIsNew):
    """The same for log records that are held as texts. What has no device or time, as texts that are no records, passes at once."""

    def handleInputRows(self, key, rows, timerValues):
        passing: list[tuple] = []
        mid = self.keys_at[0]

        def others(frame: pd.DataFrame) -> pd.DataFrame:
            passes = [row["mid"] is None or row[self.ms] is None for row in frame["row"]]
            passing.extend((*row[:mid], None, *row[mid + 1:]) for row in self._rows([frame[passes]]))
            return frame[[not p for p in passes]]

        for frame in rows:
            waits = others(frame)
            yield from self._frames(passing)
            passing.clear()
            if len(waits):
                yield from super().handleInputRows(key, iter([waits]), timerValues)


class IdleJoin(_PerKey):
    """Pairs of left and right rows. A row is forgotten when it was neither written nor joined for longer than ``idle`` milliseconds.

    A key's state is its left and right rows that are still remembered, each with the time of its last use.
    """

    forgets = True

    def __init__(self, idle: int):
        super().__init__("_ms", ["_side", "_left", "_right"])
        self.idle = idle

    def init(self, handle):
        super().init(handle)
        self.side_at, self.rows_at = self.held_names.index("_side"), [self.held_names.index(c) for c in ("_left", "_right")]

    def fold(self, key, rows, entry):
        live = entry[1] = entry[1] or [[], []]
        for row in rows:
            own, ms = row[self.side_at], row[self.at]
            values = row[self.rows_at[own]]
            others = live[1 - own] = [other for other in live[1 - own] if ms - other[0] <= self.idle]
            for other in others:
                other[0] = ms
                left, right = (values, other[1]) if own == 0 else (other[1], values)
                yield (*key, *left, *right)
            live[own].append([ms, values])

    def end_of(self, entry):
        return min(last for side in entry[1] for last, _ in side) + self.idle + 1

    def lasts(self, entry, passed):
        entry[1] = [[row for row in side if row[0] + self.idle >= passed] for side in entry[1]]
        return any(entry[1])


class LoginDays(_PerKey):
    """The first login of each day, with a flag on those ``away`` days or more after the last."""

    def __init__(self, ms: str, offset: int, away: int):
        super().__init__(ms)
        self.offset, self.away = offset, away

    def fold(self, key, rows, entry):
        for row in rows:
            day, last = (row[self.at] + self.offset) // DAY_MS, entry[1]
            if day != last:
                yield *row, 1, int(last is not None and day - last >= self.away)
                entry[1] = day


class RetractVersions(_PerKey):
    """Each version, preceded by the one it replaces with its amount negated."""

    def __init__(self, ms: str, amount: str, columns: Sequence[str]):
        super().__init__(ms, [c for c in columns if c != ms])
        self.amount = list(columns).index(amount)

    def fold(self, key, rows, entry):
        for row in rows:
            last = entry[1]
            if last is not None:
                yield *last[: self.amount], -last[self.amount], *last[self.amount + 1:]
            yield row
            entry[1] = row


class StrictlyNewer(_PerKey):
    """Records whose value exceeds every earlier one of their key."""

    def __init__(self, ms: str, value: str):
        super().__init__(ms, [value])

    def fold(self, key, rows, entry):
        at = self.ties_at[0]
        for row in rows:
            if entry[1] is None or row[at] > entry[1]:
                entry[1] = row[at]
                yield row


class LatestAfterWait(_PerKey):
    """The newest version of a key, given out once ``wait`` milliseconds of event time have passed since its first.

    An entry is ``[when it is due, newest version]``.
    """

    forgets = True

    def __init__(self, ms: str, columns: Sequence[str], wait: int):
        super().__init__(ms, [c for c in columns if c != ms])
        self.wait = wait

    def handleInputRows(self, key, rows, timerValues):
        """Versions need not wait: the newest and the first are the same in any order."""
        self._begin()
        fresh = set()
        for row in self._rows(rows):
            own = self.key_of(row)
            entry = self.entry(own)
            if entry[1] is None:
                fresh.add(own)
                entry[:] = [row[self.at] + self.wait, row]
                continue
            if own in fresh:
                entry[0] = min(entry[0], row[self.at] + self.wait)
            if self._rank(row) > self._rank(entry[1]):
                entry[1] = row
        self._end()
        return iter(())

    def _rank(self, row: tuple) -> list:
        return [_comparable(row[c]) for c in (self.at, *self.ties_at)]

    def end_of(self, entry):
        return entry[0]

    def lasts(self, entry, passed):
        return entry[0] > passed

    def _released(self, passed):
        for part in [part for part, end in self.ends.items() if end <= passed]:
            yield from (entry[1] for entry in self._entries(part).values() if not self.lasts(entry, passed))
        self._forget(passed)


class RunningProfile(_PerKey):
    """Per record its user's page views and distinct values so far."""

    def __init__(self, ms: str, fields: Sequence[str]):
        super().__init__(ms, fields)

    def fold(self, key, rows, entry):
        if entry[1] is None:
            entry[1] = [0, [set() for _ in self.ties], [""] * len(self.ties)]
        state = entry[1]
        _, seen, texts = state
        for row in rows:
            state[0] += 1
            for k, at in enumerate(self.ties_at):
                value = row[at]
                if value is not None and value not in seen[k]:
                    seen[k].add(value)
                    texts[k] = ",".join(sorted(seen[k]))
            yield key[0], row[self.at], state[0], *texts


class IntervalJoin(StatefulProcessor):
    """Pairs of left and right rows of one ``hash`` and ``key``, the right time in [left time - before, left time + after].

    Rows come as texts. A group's rows are kept in pieces of Arrow data by side and time, so that a batch joins whole pieces and forgets them
    whole. A left row is kept until the watermark has passed the times it can meet, a right row ``lag`` longer: left rows come up to that
    much behind the watermark. With ``outer`` a left row that met none is given out then.
    """

    columns = ["hash", "key", "ms", "row", "met"]

    def __init__(self, before: int, after: int, lag: int, outer: bool):
        self.before, self.after, self.lag, self.outer = before, after, lag, outer

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "piece bigint", "rows binary")
        #: Pieces as (side, first time, last time, rows, number), the next number, and the timer that is set.
        self.index = handle.getValueState("index", "pieces binary")

    def _begin(self) -> None:
        self.pieces, self.given, self.due = pickle.loads(self.index.get()[0]) if self.index.exists() else ([], 0, None)

    def _end(self) -> None:
        times = [self._end_of(piece) for piece in self.pieces]
        if times and (self.due is None or min(times) < self.due):
            self.due = min(times)
            self.handle.registerTimer(self.due)
        if times or self.due is not None:
            self.index.update((pickle.dumps((self.pieces, self.given, self.due), 5),))
        else:
            self.index.clear()

    def _needed(self, side: int) -> int:
        """For how long after its time a row is needed."""
        return self.before + self.lag if side else self.after

    def _end_of(self, piece: tuple) -> int:
        """When there is something to give out or to forget of a piece."""
        side, first, last, _, _ = piece
        return (first if self.outer and side == 0 else last) + self._needed(side) + 1

    def _load(self, piece: tuple) -> pd.DataFrame:
        with pa.ipc.open_stream(self.held.getValue((piece[4],))[0]) as stream:
            return stream.read_all().to_pandas()

    def _drop(self, piece: tuple) -> None:
        self.pieces.remove(piece)
        self.held.removeKey((piece[4],))

    def _write(self, number: int, rows: pd.DataFrame) -> None:
        table = pa.table({"hash": pa.array(rows["hash"], pa.int64()), "key": pa.array(rows["key"], pa.string()), "ms": pa.array(rows["ms"], pa.int64()),
                          "row": pa.array(rows["row"], pa.string()), "met": pa.array(rows["met"], pa.bool_())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        self.held.updateValue((number,), (sink.getvalue().to_pybytes(),))

    def _put(self, side: int, rows: pd.DataFrame) -> None:
        small = [piece for piece in self.pieces if piece[0] == side and piece[3] < JOIN_PIECE // 4]
        if len(small) > 8:  # what many short batches have left
            rows = pd.concat([rows, *map(self._load, small)], ignore_index=True)
            for piece in small:
                self._drop(piece)
        rows = rows.sort_values("ms", kind="stable")
        for k in range(0, len(rows), JOIN_PIECE):
            some = rows.iloc[k:k + JOIN_PIECE]
            self._write(self.given, some)
            self.pieces.append((side, int(some["ms"].iloc[0]), int(some["ms"].iloc[-1]), len(some), self.given))
            self.given += 1

    def _pairs(self, left: pd.DataFrame, right: pd.DataFrame, passed: int) -> Iterator[pd.DataFrame]:
        """What meets of both, and a mark on left rows that met something."""
        if left.empty or right.empty:
            return
        # Right rows in the order of hash and time, both as ranks: the partners of a left row are next to each other.
        hashes, of_hash = np.unique(right["hash"].to_numpy(), return_inverse=True)
        times, of_time = np.unique(right["ms"].to_numpy(), return_inverse=True)
        rank = of_hash * (len(times) + 1) + of_time
        order = np.argsort(rank, kind="stable")
        rank = rank[order]
        mine, ms = left["hash"].to_numpy(), left["ms"].to_numpy()
        known = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
        base = known * (len(times) + 1)
        low = np.searchsorted(rank, base + np.searchsorted(times, ms - self.before, "left"))
        high = np.searchsorted(rank, base + np.searchsorted(times, ms + self.after, "right"))
        ends = np.cumsum(np.where(hashes[known] == mine, high - low, 0))
        left_key, right_key, met = left["key"].to_numpy(), right["key"].to_numpy(), left["met"].to_numpy(copy=True)
        for k in range(0, int(ends[-1]), HELD):
            pair = np.arange(k, min(k + HELD, int(ends[-1])))
            a = np.searchsorted(ends, pair, "right")
            b = order[high[a] - (ends[a] - pair)]
            same = left_key[a] == right_key[b]
            a, b = a[same], b[same]
            met[a] = True
            if len(a):
                at = np.maximum(ms[a], right["ms"].to_numpy()[b])
                yield self._frame(left["row"].to_numpy()[a], right["row"].to_numpy()[b], at, passed)
        left["met"] = met

    @staticmethod
    def _frame(left: np.ndarray, right: np.ndarray, ms: np.ndarray, passed: int) -> pd.DataFrame:
        # A time that the watermark has reached would be too late for what follows.
        return pd.DataFrame({"left": left, "right": right, "et": pd.to_datetime(np.maximum(ms, passed + 1), unit="ms", utc=True)})

    def _meet(self, rows: pd.DataFrame, passed: int) -> Iterator[pd.DataFrame]:
        """Join rows that came with each other and with what is held, and hold them."""
        left, right = (rows.loc[rows["side"] == side, self.columns].reset_index(drop=True) for side in (0, 1))
        held = list(self.pieces)
        yield from self._pairs(left, right, passed)
        for piece in held:
            side, first, last, _, number = piece
            if side == 1 and len(left) and last >= left["ms"].min() - self.before and first <= left["ms"].max() + self.after:
                yield from self._pairs(left, self._load(piece), passed)
            elif side == 0 and len(right) and last >= right["ms"].min() - self.after and first <= right["ms"].max() + self.before:
                old = self._load(piece)
                before = int(old["met"].sum())
                yield from self._pairs(old, right, passed)
                if self.outer and int(old["met"].sum()) > before:
                    self._write(number, old)
        for side, some in ((0, left), (1, right)):
            if len(some):
                self._put(side, some)

    def _pass(self, passed: int) -> Iterator[pd.DataFrame]:
        """Give out and forget what the watermark has passed."""
        for piece in [piece for piece in self.pieces if self._end_of(piece) <= passed]:
            side, _, last, _, _ = piece
            if self.outer and side == 0:
                rows = self._load(piece)
                over = rows["ms"] + self._needed(0) < passed
                alone = rows[over & ~rows["met"]]
                for k in range(0, len(alone), HELD):
                    some = alone.iloc[k:k + HELD]
                    yield self._frame(some["row"].to_numpy(), np.full(len(some), None, dtype=object), some["ms"].to_numpy(), passed)
                self._drop(piece)
                if not over.all():
                    self._put(0, rows[~over])
            else:
                self._drop(piece)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), 0)
        self._begin()
        some, n = [], 0
        for frame in rows:
            some.append(frame.assign(met=False))
            n += len(frame)
            if n >= JOINED:
                yield from self._meet(pd.concat(some, ignore_index=True), passed)
                some, n = [], 0
        if n:
            yield from self._meet(pd.concat(some, ignore_index=True), passed)
        yield from self._pass(passed)
        self._end()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        self._begin()
        if self.due is not None and self.due <= passed:
            self.due = None
        yield from self._pass(passed)
        self._end()

    def close(self) -> None:
        pass


# -- the operators ------------------------------------------------------------------------------------------


def _texts(fields: Sequence[StructField]) -> tuple[Column, Callable[[str], Column]]:
    """A row as one text, and how the row is read back from a column of such texts."""
    nested = (ArrayType, MapType, StructType)
    kinds = StructType([StructField(f.name, f.dataType if isinstance(f.dataType, nested) else StringType()) for f in fields])
    text = F.to_json(F.struct(*[F.col(f.name).cast(k.dataType).alias(f.name) for f, k in zip(fields, kinds, strict=True)]), {"ignoreNullFields": "false"})
    return text, lambda column: F.from_json(column, kinds)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ms: str, right_ms: str, before: int, after: int, lag: int = 0, outer: bool = False,
    copied: str = "right",
) -> DataFrame:
    """Join of two streams with event times ``et`` (left) and ``_et`` (right): the right time lies in [left time - before, left time + after].

    As in the batch form the time axis is cut into slices, and rows of the ``copied`` side go to each slice they can meet rows in: name the smaller
    one; with ``outer`` it is the right one. A pair comes with the later of its times as ``et``, or a time just after the watermark if that is later still, so that joins
    and windows can follow. ``lag``: how far left rows come behind the watermark, as those of an earlier join do. Columns but ``key`` have to differ in
    name.
    """
    if outer and copied != "right":
        raise ValueError("left rows that may come alone cannot be copied")
    sides = ([f for f in left.schema.fields if f.name != "et"], [f for f in right.schema.fields if f.name not in (key, "_et")])
    packed = [_texts(fields) for fields in sides]
    width = F.lit(4 * max(before + after, 1))
    slice_of = lambda at: F.floor(at / width)

    def tagged(df: DataFrame, side: int, ms: str, et: str) -> DataFrame:
        at = F.coalesce(F.col(ms).try_cast("bigint"), F.lit(0))
        met = slice_of(at)
        if copied == ("left", "right")[side]:
            back, ahead = (before, after) if side == 0 else (after, before)
            met = F.explode(F.sequence(slice_of(at - back), slice_of(at + ahead)))
        rows = df.select(F.col(key).cast("string").alias("key"), at.alias("ms"), packed[side][0].alias("row"), F.lit(side).alias("side"), met.alias("slice"),
                         F.col(et).alias("et"))
        rows = rows if outer and side == 0 else rows.filter(F.col("key").isNotNull())
        return rows.select(F.xxhash64("key", "slice").alias("hash"), "key", "ms", "row", "side", "et")

    rows = tagged(left, 0, left_ms, "et").unionByName(tagged(right, 1, right_ms, "_et"))
    # A left row without a key meets nothing: such rows are spread by their text.
    bucket = F.pmod(F.when(F.col("key").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("hash")), F.lit(JOIN_BUCKETS))
    schema = StructType([StructField("left", StringType()), StructField("right", StringType()), StructField("et", TimestampType())])
    pairs = rows.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=IntervalJoin(before, after, lag, outer), outputStructType=schema, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="et")
    both = pairs.select(packed[0][1]("left").alias("_l"), packed[1][1]("right").alias("_r"), "et")
    named = [F.col(f"{name}.{f.name}").cast(f.dataType).alias(f.name) for name, fields in zip(("_l", "_r"), sides) for f in fields]
    return both.select(*named[:len(sides[0])], "et", *named[len(sides[0]):])


def _transform(timed: DataFrame, held: Sequence[str], bucket: Column, processor: _PerKey, schema: StructType, keys: Sequence[str], keep: int | None,
               hand_on: str | None = None) -> DataFrame:
    """``timed`` has an event time ``_et`` and the ``held`` columns; ``bucket`` deals its rows to groups."""
    processor.out, processor.keep, processor.hand_on = schema.names, keep, hand_on
    processor.held_names, processor.keys = list(held), list(keys)
    rows = timed.select(F.struct(*held).alias("row"), F.pmod(bucket, F.lit(BUCKETS)).alias("bucket"), F.col("_et").alias("et"))
    kind = rows.schema["row"].dataType
    processor.nested = kind if any(isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in kind.fields) else None
    grouped = rows.groupBy("bucket")
    if hand_on:
        return grouped.transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=_with(schema, StructField(hand_on, TimestampType())), outputMode="Append",
            timeMode="EventTime", eventTimeColumnName=hand_on)
    return grouped.transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def _apply(df: DataFrame, keys: Sequence[str], processor: _PerKey, schema: StructType, delay: str, keep: int | None = None,
           more: Sequence[Column] = (), hand_on: str | None = None) -> DataFrame:
    """``more`` deals the rows of a key to several groups. ``hand_on`` names the event time of what comes out, if windows or joins
    follow in the same query; then rows are folded in the order of their batches, and only within a batch by time."""
    timed = with_event_time(df, processor.ms, delay, "_et")
    return _transform(timed, df.columns, F.xxhash64(*keys, *more), processor, schema, keys, keep, hand_on)


def flag_first_of_day(
    df: DataFrame, keys: Sequence[str], name: str, ms: str = "ts", offset: int = BUSINESS_OFFSET_MS, delay: str = "0 seconds",
    keep: int | None = DAY_MS, hand_on: str | None = None,
) -> DataFrame:
    """The original forgets a key after a day, which is enough: a later row is on another day. State is by key and day, so the days of a
    key with very many rows are apart."""
    schema = _with(df.schema, StructField(name, LongType()))
    ties = [c for c in df.columns if c not in (*keys, ms)]
    day = F.floor((F.coalesce(F.col(ms).try_cast("bigint"), F.lit(0)) + offset) / DAY_MS)
    return _apply(df, keys, FlagFirstOfDay(ms, offset, ties), schema, delay, keep, [day], hand_on)


def repair_is_new(df: DataFrame, key: str = "mid", flag: str = "is_new", ms: str = "ts", offset: int = BUSINESS_OFFSET_MS,
                  delay: str = "0 seconds", keep: int | None = None) -> DataFrame:
    """The original forgets a device after 10 seconds (``keep=10_000``), so that a returning one counts as new."""
    return _apply(df, [key], RepairIsNew(ms, flag, offset), df.schema, delay, keep)


def repair_texts(df: DataFrame, flag: str = "is_new", ms: str = "ts", offset: int = BUSINESS_OFFSET_MS, delay: str = "0 seconds",
                 keep: int | None = None) -> DataFrame:
    """``repair_is_new`` of rows (mid, ts, is_new, value, ...); those without ``mid`` or ``ts`` pass unchanged, spread over many keys.

    Such a row has no event time, so it is never late and does not move the watermark.
    """
    passes = F.col("mid").isNull() | F.col(ms).isNull()
    timed = df.withColumn("_et", F.when(~passes, F.timestamp_millis(ms))).withWatermark("_et", delay)
    bucket = F.xxhash64(F.when(passes, F.xxhash64(*df.columns).cast("string")).otherwise(F.col("mid")))
    return _transform(timed, df.columns, bucket, RepairTexts(ms, flag, offset), df.schema, ["mid"], keep)


def idle_join(left: DataFrame, right: DataFrame, key: str, left_ms: str, right_ms: str, idle: int, delay: str = "0 seconds") -> DataFrame:
    """Join of two streams whose rows are remembered until they were idle for ``idle`` milliseconds: being joined counts as use.

    The original keeps the rows of its joins 1,805 seconds (``idle=1_805_000``) of processing time; here it is event time. Other
    columns than ``key`` have to differ in name.
    """
    sides = [[f for f in df.schema.fields if f.name != key] for df in (left, right)]
    kinds = [StructType(fields) for fields in sides]

    def tagged(df: DataFrame, ms: str, side: int) -> DataFrame:
        row = F.struct(*[F.col(f.name) for f in sides[side]])
        both = [row if k == side else F.lit(None).cast(kinds[k]) for k in (0, 1)]
        return df.select(key, F.col(ms).cast("bigint").alias("_ms"), F.lit(side).cast("bigint").alias("_side"), both[0].alias("_left"), both[1].alias("_right"))

    schema = StructType([left.schema[key], *sides[0], *sides[1]])
    rows = tagged(left, left_ms, 0).unionByName(tagged(right, right_ms, 1))
    return _apply(rows, [key], IdleJoin(idle), schema, delay)


def login_days(df: DataFrame, key: str = "uid", ms: str = "ts", offset: int = BUSINESS_OFFSET_MS, away: int = 8,
               delay: str = "0 seconds", keep: int | None = None, hand_on: str | None = None) -> DataFrame:
    schema = _with(df.schema, StructField("uu", LongType()), StructField("back", LongType()))
    return _apply(df, [key], LoginDays(ms, offset, away), schema, delay, keep, hand_on=hand_on)


def retract_versions(df: DataFrame, key: str, amount: str, ms: str = "ts_ms", delay: str = "0 seconds", keep: int | None = None) -> DataFrame:
    """The original forgets a line after 10 seconds (``keep=10_000``)."""
    return _apply(df, [key], RetractVersions(ms, amount, df.columns), df.schema, delay, keep)


def strictly_newer(df: DataFrame, key: str, value: str, ms: str, delay: str = "0 seconds", keep: int | None = None) -> DataFrame:
    """The original forgets a key after an hour (``keep=3_600_000``)."""
    return _apply(df, [key], StrictlyNewer(ms, value), df.schema, delay, keep)


def latest_after_wait(df: DataFrame, key: str, wait: int, ms: str = "ts_ms", delay: str = "0 seconds") -> DataFrame:
    return _apply(df, [key], LatestAfterWait(ms, df.columns, wait), df.schema, delay)


def running_profile(df: DataFrame, fields: Sequence[str], key: str = "uid", ms: str = "ts", delay: str = "0 seconds",
                    keep: int | None = None) -> DataFrame:
    texts = [StructField(f, StringType()) for f in fields]
    schema = StructType([StructField("uid", StringType()), StructField("ts_ms", LongType()), StructField("pv", LongType()), *texts])
    return _apply(df, [key], RunningProfile(ms, fields), schema, delay, keep)

