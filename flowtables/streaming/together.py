"""Many small keys in one key of state.

Every call to the state store is a round trip between Python and the JVM, and so is every timer. A stream of short flows
spends nearly all its time there if each flow is a key. Here flows are dealt into a fixed number of buckets by hash: a
bucket reads and writes once per micro-batch what is known of its flows (a few numbers and the numbers of their pieces) and
has one timer. Payloads are entries of their own, touched only for flows that stay open.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: A stream must keep its number of buckets for as long as it keeps its checkpoint.
BUCKETS = 1024


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets).cast("bigint"))


class _Known:
    """What a bucket knows of one key: its timer, values, numbers of list entries and keys of map entries."""

    __slots__ = ("due", "values", "lists", "maps")

    def __init__(self, due=None, values=None, lists=None, maps=None):
        self.due, self.values, self.lists, self.maps = due, values or {}, lists or {}, maps or {}

    def packed(self) -> tuple:
        return (self.due, self.values, self.lists, {name: set(keys) for name, keys in self.maps.items()})

    def empty(self) -> bool:
        return self.due is None and not (self.values or any(self.lists.values()) or any(self.maps.values()))


class _Value:
    def __init__(self, owner: Together, name: str):
        self.owner, self.name = owner, name

    def exists(self) -> bool:
        return self.name in self.owner.current.values

    def get(self) -> tuple | None:
        return self.owner.current.values.get(self.name)

    def update(self, value: tuple) -> None:
        self.owner.current.values[self.name] = tuple(value)

    def clear(self) -> None:
        self.owner.current.values.pop(self.name, None)


class _List(_Value):
    """Entries are what was appended at once."""

    def get(self) -> Iterator[tuple]:
        for i in range(self.owner.current.lists.get(self.name, 0)):
            yield from self.owner.cell(self.name, i)

    def appendList(self, values: list[tuple]) -> None:
        n = self.owner.current.lists.get(self.name, 0)
        self.owner.set_cell(self.name, n, values)
        self.owner.current.lists[self.name] = n + 1

    def clear(self) -> None:
        for i in range(self.owner.current.lists.pop(self.name, 0)):
            self.owner.drop_cell(self.name, i)


class _Map(_Value):
    def _keys(self) -> set:
        return self.owner.current.maps.setdefault(self.name, set())

    def containsKey(self, key: tuple) -> bool:
        return key in self._keys()

    def getValue(self, key: tuple) -> tuple:
        return self.owner.cell(self.name, key)

    def updateValue(self, key: tuple, value: tuple) -> None:
        self._keys().add(key)
        self.owner.set_cell(self.name, key, value)

    def keys(self) -> Iterator[tuple]:
        return iter(sorted(self._keys()))

    def iterator(self) -> Iterator[tuple]:
        return ((key, self.getValue(key)) for key in self.keys())

    def clear(self) -> None:
        for key in self.owner.current.maps.pop(self.name, set()):
            self.owner.drop_cell(self.name, key)


class Together(StatefulProcessor):
    """Runs a processor written for one key for every ``key`` of a bucket."""

    def __init__(self, processor: StatefulProcessor, key: Sequence[str]):
        self.processor, self.key = processor, list(key)

    def init(self, handle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "timer long, known binary")
        self.cells = handle.getMapState("cells", "name binary", "value binary")
        self.processor.init(self)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._load()
        flows: dict[tuple, list[Row]] = {}
        for row in rows:
            flows.setdefault(tuple(row[c] for c in self.key), []).append(row)
        for flow, own in flows.items():
            self._enter(flow)
            yield from self.processor.handleInputRows(flow, iter(own), timerValues)
            self._leave()
        self._save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        self.timer = None  # it is this one
        now = timerValues.getCurrentWatermarkInMs()
        for flow in [f for f, known in self.known.items() if known.due is not None and known.due < now]:
            self._enter(flow)
            self.current.due = None
            yield from self.processor.handleExpiredTimer(flow, timerValues, expiredTimerInfo)
            self._leave()
        self._save()

    def close(self) -> None:
        self.processor.close()

    # --- what the processor sees as its handle

    def getValueState(self, name: str, *schema: str) -> _Value:
        return _Value(self, name)

    def getListState(self, name: str, *schema: str) -> _List:
        return _List(self, name)

    def getMapState(self, name: str, *schema: str) -> _Map:
        return _Map(self, name)

    def registerTimer(self, at: int) -> None:
        self.current.due = int(at)

    def deleteTimer(self, at: int) -> None:
        self.current.due = None

    def listTimers(self) -> Iterator[int]:
        return iter(() if self.current.due is None else (self.current.due,))

    # --- entries of the current key: read when asked for, written when the key is left

    def _name(self, name: str, key) -> bytes:
        return pickle.dumps((self.flow, name, key), 5)

    def cell(self, name: str, key):
        if (name, key) not in self.read:
            self.read[name, key] = pickle.loads(bytes(self.cells.getValue((self._name(name, key),))[0]))
        return self.read[name, key]

    def set_cell(self, name: str, key, value) -> None:
        self.read[name, key] = value
        self.fresh.add((name, key))

    def drop_cell(self, name: str, key) -> None:
        self.read.pop((name, key), None)
        if (name, key) in self.stored:
            self.cells.removeKey((self._name(name, key),))
            self.stored.discard((name, key))
        self.fresh.discard((name, key))

    def _enter(self, flow: tuple) -> None:
        self.flow, self.current = flow, self.known.get(flow) or _Known()
        self.read, self.fresh = {}, set()
        lists = ((name, i) for name, n in self.current.lists.items() for i in range(n))
        self.stored = {*lists, *((name, key) for name, keys in self.current.maps.items() for key in keys)}

    def _leave(self) -> None:
        for name, key in self.fresh:
            self.cells.updateValue((self._name(name, key),), (pickle.dumps(self.read[name, key], 5),))
        if self.current.empty():
            self.known.pop(self.flow, None)
        else:
            self.known[self.flow] = self.current

    def _load(self) -> None:
        self.timer, self.known, self.had = None, {}, self.index.exists()
        if self.had:
            self.timer, known = self.index.get()
            self.known = {flow: _Known(*packed) for flow, packed in pickle.loads(bytes(known)).items()}

    def _save(self) -> None:
        due = min((known.due for known in self.known.values() if known.due is not None), default=None)
        if due != self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            if due is not None:
                self.handle.registerTimer(due)
        if self.known:
            self.index.update((due, pickle.dumps({flow: known.packed() for flow, known in self.known.items()}, 5)))
        elif self.had:
            self.index.clear()
