"""Stateful processors for what windows and joins of the streaming engine cannot say.

All of them buffer rows until the watermark passes, so results do not depend on the order in which
files or partitions arrive. Times travel as microseconds, timers fire in milliseconds.

Every state group costs several calls to the state store per micro-batch, however few rows it has. So ``VersionedLookup`` and
``PathCollector`` hold many keys per group, work on whole columns, and keep their rows as packed Arrow pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def _due_ms(us: int) -> int:
    return -(-int(us) // 1000)


#: rows of one piece of packed state
PIECE_ROWS = 20_000


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> list[tuple[bytes]]:
    """Rows as entries of a list state, many rows to an entry."""
    out = []
    for batch in pa.Table.from_pandas(frame, schema, preserve_index=False).to_batches(PIECE_ROWS):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as writer:
            writer.write_batch(batch)
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _unpacked(state, schema: pa.Schema) -> pd.DataFrame:
    held = [pa.ipc.open_stream(pa.py_buffer(bytes(p[0]))).read_all() for p in state.get()] if state.exists() else []
    return pa.concat_tables([schema.empty_table(), *held]).to_pandas()


def _put(state, frame: pd.DataFrame, schema: pa.Schema) -> None:
    if len(frame):
        state.put(_packed(frame, schema))
    else:
        state.clear()


def _codes(*columns: pd.Series) -> np.ndarray:
    """A number for each different combination of values; a null is a value like others."""
    codes = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        own, values = pd.factorize(column)
        codes = pd.factorize(codes * (len(values) + 1) + own + 1)[0]
    return codes


class _OneTimer:
    """The one timer of a group, at the earliest moment asked for."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle, self.due = handle, handle.getValueState("due", "ms bigint")

    def earlier(self, us: int, watermark: int) -> None:
        """Rows have come that are due at ``us``."""
        ms = max(_due_ms(us), watermark + 1)
        if self.due.exists():
            old = self.due.get()[0]
            if old <= ms:
                return
            self.handle.deleteTimer(old)
        self.at(ms)

    def at(self, ms: int) -> None:
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def off(self) -> None:
        self.due.clear()


def _latest(version_codes: np.ndarray, version_times: np.ndarray, codes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The place of the last version of the same code at or before each time, or -1. Versions are sorted by code and time."""
    side = np.repeat([0, 1], [len(version_codes), len(codes)])
    order = np.lexsort((side, np.concatenate([version_times, times]), np.concatenate([version_codes, codes])))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(side[order] == 0) - 1
    place = place[len(version_codes):]
    if not len(version_codes):
        return np.full(len(codes), -1)
    return np.where((place >= 0) & (version_codes[place] == codes), place, -1)


class VersionedLookup(StatefulProcessor):
    """Facts probe the versions of their key at fact time, then ``probes`` more times every ``step_us``.

    Input columns: key (text), side (0 version, 1 fact), at_us, id, payload (text). Output: group columns, key, id,
    payload of the fact, version (text, null if padded), attempt (null if padded). A group holds many keys. Versions
    older than the newest one the watermark has passed are forgotten.
    """

    VERSIONS = pa.schema([("key", pa.string()), ("at_us", pa.int64()), ("id", pa.int64()), ("payload", pa.string())])
    WAITING = pa.schema([("key", pa.string()), ("probe_us", pa.int64()), ("id", pa.int64()), ("payload", pa.string()), ("attempt", pa.int32())])

    def __init__(self, group_columns: list[str], step_us: int, probes: int, keep_misses: bool):
        self.group_columns, self.step_us, self.probes, self.keep_misses = group_columns, step_us, probes, keep_misses

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getListState("versions", "rows binary")
        self.waiting = handle.getListState("waiting", "rows binary")
        self.timer = _OneTimer(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, newest = [], []
        for batch in rows:
            versions, facts = batch[batch["side"] == 0], batch[batch["side"] != 0]
            if len(versions):
                self.versions.appendList(_packed(versions[self.VERSIONS.names], self.VERSIONS))
                newest.append(int(versions["at_us"].max()))
            if len(facts):
                facts = facts.rename(columns={"at_us": "probe_us"}).assign(attempt=0)[self.WAITING.names]
                self.waiting.appendList(_packed(facts, self.WAITING))
                due.append(int(facts["probe_us"].min()))
        # also a group without facts forgets what its newest passed versions have replaced
        self.timer.earlier(min([*due, *([max(newest)] if newest else [])]), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed_us = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, known = _unpacked(self.waiting, self.WAITING), _unpacked(self.versions, self.VERSIONS)
        codes = _codes(pd.concat([known["key"], waiting["key"]], ignore_index=True))
        known_codes, codes = codes[:len(known)], codes[len(known):]
        order = np.lexsort((pd.factorize(known["payload"], sort=True)[0], known["id"].to_numpy(np.int64), known["at_us"].to_numpy(np.int64), known_codes))
        known, known_codes = known.iloc[order], known_codes[order]
        times = known["at_us"].to_numpy(np.int64)

        probe, attempt = waiting["probe_us"].to_numpy(np.int64).copy(), waiting["attempt"].to_numpy(np.int64).copy()
        version, done = np.full(len(waiting), -1), np.zeros(len(waiting), bool)
        due = np.flatnonzero(probe <= passed_us)
        while len(due):
            version[due] = _latest(known_codes, times, codes[due], probe[due])
            again = (version[due] < 0) & (attempt[due] < self.probes)
            done[due[~again]] = True
            due = due[again]
            probe[due] += self.step_us
            attempt[due] += 1
            due = due[probe[due] <= passed_us]
        changed = done | (attempt != waiting["attempt"].to_numpy())
        rest = waiting.assign(probe_us=probe, attempt=attempt)[~done]
        if changed.any():
            _put(self.waiting, rest, self.WAITING)

        # no row still to come or waiting probes a key before this moment, so only the newest version then stays
        floor = np.full(max([-1, *codes, *known_codes]) + 1, passed_us)
        np.minimum.at(floor, codes[~done], probe[~done])
        replaced = np.zeros(len(known), bool)
        replaced[:-1] = (known_codes[1:] == known_codes[:-1]) & (times[1:] <= floor[known_codes[1:]])
        if replaced.any():
            _put(self.versions, known[~replaced], self.VERSIONS)
        wake = [*rest["probe_us"].nsmallest(1), *([times.max()] if len(times) and times.max() > passed_us else [])]
        if wake:
            self.timer.at(_due_ms(min(wake)))
        else:
            self.timer.off()

        out = np.flatnonzero(done & ((version >= 0) | self.keep_misses))
        if len(out):
            found = version[out] >= 0
            frame = waiting.iloc[out][["key", "id", "payload"]].reset_index(drop=True)
            held = known["payload"].to_numpy(object)
            frame["version"] = np.where(found, held[np.maximum(version[out], 0)], None) if len(held) else None
            frame["attempt"] = pd.array(attempt[out], "Int32")
            frame.loc[~found, "attempt"] = pd.NA
            for i, name in enumerate(self.group_columns):
                frame.insert(i, name, key[i])
            yield frame

    def close(self) -> None:
        pass


class GrowingWindow(StatefulProcessor):
    """Incremental window: reports the running result of (key, window_start) at every interval.

    Input columns: at_us, n, total_cents (already summed per interval or raw). Output: key columns,
    fire_us, n, total_cents. The state is one accumulator per interval.
    """

    def __init__(self, key_columns: list[str], size_us: int, step_us: int):
        self.key_columns, self.size_us, self.step_us = key_columns, size_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.steps = handle.getMapState("steps", "step bigint", "n bigint, total bigint")
        self.fired = handle.getValueState("fired", "step bigint")

    def _end(self, start: int, step: int) -> int:
        return min(start + (step + 1) * self.step_us, start + self.size_us)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start, added = int(key[-1]), {}
        for batch in rows:
            steps = (batch["at_us"] - start) // self.step_us
            sums = batch.groupby(steps)[["n", "total_cents"]].sum()
            for step, n, total in zip(sums.index, sums["n"], sums["total_cents"]):
                old = added.get(int(step), (0, 0))
                added[int(step)] = (old[0] + int(n), old[1] + int(total))
        for step, (n, total) in added.items():
            old = self.steps.getValue((step,)) if self.steps.containsKey((step,)) else (0, 0)
            self.steps.updateValue((step,), (old[0] + n, old[1] + total))
        if added:
            due = _due_ms(self._end(start, min(added)))
            self.handle.registerTimer(max(due, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, watermark = int(key[-1]), timerValues.getCurrentWatermarkInMs()
        known = {k[0]: (v[0], v[1]) for k, v in self.steps.iterator()}
        last = (self.size_us - 1) // self.step_us
        step = self.fired.get()[0] + 1 if self.fired.exists() else min(known, default=0)
        n = sum(v[0] for s, v in known.items() if s < step)
        total = sum(v[1] for s, v in known.items() if s < step)
        out = []
        while step <= last and _due_ms(self._end(start, step)) <= watermark:
            add = known.get(step, (0, 0))
            n, total = n + add[0], total + add[1]
            out.append((self._end(start, step), n, total))
            step += 1
        if step > last:
            self.steps.clear()
            self.fired.clear()
        else:
            if out:
                self.fired.update((step - 1,))
            self.handle.registerTimer(_due_ms(self._end(start, step)))
        if out:
            frame = pd.DataFrame(out, columns=["fire_us", "n", "total_cents"])
            for i, name in enumerate(self.key_columns):
                frame.insert(i, name, key[i])
            yield frame

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """Tumbling count window per key: emits number and sum when ``size`` rows have arrived.

    Input columns: id (arrival order inside a micro-batch), cents. Output: key columns, window_no, total_cents.
    """

    def __init__(self, key_columns: list[str], size: int):
        self.key_columns, self.size = key_columns, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "window_no bigint, n bigint, total bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number, n, total = self.open.get() if self.open.exists() else (0, 0, 0)
        arrived = pd.concat(list(rows)).sort_values("id")
        sums = total + np.cumsum(arrived["cents"].to_numpy(np.int64))
        full = np.arange(self.size - n - 1, len(sums), self.size)  # the rows that fill a window
        out = list(zip(range(number, number + len(full)), np.diff(sums[full], prepend=0).tolist()))
        number, n = number + len(full), (n + len(sums)) % self.size
        total = int(sums[-1] - (sums[full[-1]] if len(full) else 0))
        self.open.update((number, n, total))
        if out:
            frame = pd.DataFrame(out, columns=["window_no", "total_cents"])
            for i, name in enumerate(self.key_columns):
                frame.insert(i, name, key[i])
            yield frame

    def close(self) -> None:
        pass


class SlidingCountWindow(StatefulProcessor):
    """Every ``slide`` rows of a key the sum of its last ``size`` rows, fewer at the beginning.

    Input columns: id (arrival order inside a micro-batch), cents. Output: key columns, arrivals, total_cents. The state is
    a ring of the running totals at the ends of the last panes, a pane being the rows that divide both size and slide.
    """

    def __init__(self, key_columns: list[str], size: int, slide: int):
        self.key_columns, self.size, self.slide, self.pane = key_columns, size, slide, gcd(size, slide)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "arrivals bigint, total bigint, marks array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before, total, marks = self.open.get() if self.open.exists() else (0, 0, [0])
        arrived = pd.concat(list(rows)).sort_values("id")
        sums = total + np.cumsum(arrived["cents"].to_numpy(np.int64))
        now, passed = before + len(sums), before // self.pane
        ends = np.arange((passed + 1) * self.pane, now + 1, self.pane)
        oldest = passed + 1 - len(marks)  # the pane end that the first mark stands for
        marks = np.append(np.array(marks, np.int64), sums[ends - before - 1])
        fired = np.arange((before // self.slide + 1) * self.slide, now + 1, self.slide)
        kept = marks[-(self.size // self.pane):]
        # totals count from the oldest mark, so they stay small however long the stream runs
        self.open.update((now, int(sums[-1] - kept[0]), (kept - kept[0]).tolist()))
        if len(fired):
            held = marks[fired // self.pane - oldest] - marks[np.maximum(fired - self.size, 0) // self.pane - oldest]
            frame = pd.DataFrame({"arrivals": fired, "total_cents": held})
            for i, name in enumerate(self.key_columns):
                frame.insert(i, name, key[i])
            yield frame

    def close(self) -> None:
        pass


class GrowingDistinct(StatefulProcessor):
    """Incremental window that counts rows and distinct values of (key, window start, salt) at every interval.

    Input columns: at_us, value (text, null: counts as a row only). Output: key columns, fire_us, n, distinct. A value counts in
    the interval that saw it first. An earlier row that arrives later moves it there, which changes no result that has been
    reported, because the watermark has not passed that interval.
    """

    def __init__(self, key_columns: list[str], size_us: int, step_us: int):
        self.key_columns, self.size_us, self.step_us = key_columns, size_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getMapState("first", "value string", "step bigint")
        self.steps = handle.getMapState("steps", "step bigint", "n bigint, found bigint")
        self.fired = handle.getValueState("fired", "step bigint, n bigint, found bigint")

    def _end(self, start: int, step: int) -> int:
        return min(start + (step + 1) * self.step_us, start + self.size_us)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start = int(key[self.key_columns.index("start_us")])
        for batch in rows:
            steps = ((batch["at_us"] - start) // self.step_us).astype("int64")
            added = {int(s): [int(n), 0] for s, n in steps.value_counts().items()}
            for value, step in steps.groupby(batch["value"]).min().items():
                seen = self.first.getValue((value,))[0] if self.first.containsKey((value,)) else None
                if seen is None or step < seen:
                    self.first.updateValue((value,), (int(step),))
                    added.setdefault(int(step), [0, 0])[1] += 1
                    if seen is not None:
                        added.setdefault(seen, [0, 0])[1] -= 1
            for step, (n, found) in added.items():
                old = self.steps.getValue((step,)) if self.steps.containsKey((step,)) else (0, 0)
                self.steps.updateValue((step,), (old[0] + n, old[1] + found))
            if added:
                self.handle.registerTimer(max(_due_ms(self._end(start, min(added))), timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, watermark = int(key[self.key_columns.index("start_us")]), timerValues.getCurrentWatermarkInMs()
        last = (self.size_us - 1) // self.step_us
        if self.fired.exists():
            step, n, found = self.fired.get()
            step += 1
        else:
            step, n, found = min((k[0] for k in self.steps.keys()), default=last + 1), 0, 0
        out = []
        while step <= last and _due_ms(self._end(start, step)) <= watermark:
            if self.steps.containsKey((step,)):
                add = self.steps.getValue((step,))
                n, found = n + add[0], found + add[1]
                self.steps.removeKey((step,))
            out.append((self._end(start, step), n, found))
            step += 1
        if step > last:
            self.steps.clear()
            self.first.clear()
            self.fired.clear()
        else:
            if out:
                self.fired.update((step - 1, n, found))
            self.handle.registerTimer(_due_ms(self._end(start, step)))
        if out:
            frame = pd.DataFrame(out, columns=["fire_us", "n", "distinct"])
            for i, name in enumerate(self.key_columns):
                frame.insert(i, name, key[i])
            yield frame

    def close(self) -> None:
        pass


class PathCollector(StatefulProcessor):
    """Purchase paths per (user_id, channel): one row per PURCHASE with the counts of its path.

    Input columns: user_id (text), channel, event_type, at_us, id. Output: group column, user_id, channel, purchase_us,
    id of the purchase, length, counts as map. A group holds many users. Events wait for the watermark, so a path
    follows event time.
    """

    WAITING = pa.schema([("user_id", pa.string()), ("channel", pa.string()), ("event_type", pa.string()), ("at_us", pa.int64()), ("id", pa.int64())])
    COUNTS = pa.schema([("user_id", pa.string()), ("channel", pa.string()), ("event_type", pa.string()), ("n", pa.int64())])

    def __init__(self, group_column: str, closing_type: str = "PURCHASE"):
        self.group_column, self.closing_type = group_column, closing_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", "rows binary")
        self.counts = handle.getListState("counts", "rows binary")
        self.timer = _OneTimer(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due = []
        for batch in rows:
            self.waiting.appendList(_packed(batch[self.WAITING.names], self.WAITING))
            due.append(int(batch["at_us"].min()))
        self.timer.earlier(min(due), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = _unpacked(self.waiting, self.WAITING)
        ready = (waiting["at_us"] <= timerValues.getCurrentWatermarkInMs() * 1000).to_numpy()
        rest = waiting[~ready]
        if len(rest):
            self.timer.at(_due_ms(rest["at_us"].min()))
        else:
            self.timer.off()
        if not ready.any():
            return
        _put(self.waiting, rest, self.WAITING)
        # the counts of a path still open stand before the events of its user
        begun = _unpacked(self.counts, self.COUNTS).assign(at_us=np.iinfo(np.int64).min, id=0)
        rows = pd.concat([begun, waiting[ready].assign(n=1)], ignore_index=True)
        kinds, kind_names = pd.factorize(rows["event_type"], sort=True)
        codes = _codes(rows["user_id"], rows["channel"])
        order = np.lexsort((kinds, rows["id"].to_numpy(np.int64), rows["at_us"].to_numpy(np.int64), codes))
        rows, kinds, codes = rows.iloc[order].reset_index(drop=True), kinds[order], codes[order]
        closes = (rows["event_type"] == self.closing_type).to_numpy(bool)
        begins = np.ones(len(rows), bool)
        begins[1:] = closes[:-1] | (codes[1:] != codes[:-1])
        path = np.cumsum(begins) - 1
        # one entry per path and event type, in the order of the paths
        entry, first, of = np.unique(path * (len(kind_names) + 1) + kinds + 1, return_index=True, return_inverse=True)
        n = np.zeros(len(entry), np.int64)
        np.add.at(n, of, rows["n"].to_numpy(np.int64))
        entry_path, entry_kind = path[first], rows["event_type"].to_numpy(object)[first]
        closed = np.zeros(path[-1] + 1, bool)
        closed[path[closes]] = True
        left = first[~closed[entry_path]]
        _put(self.counts, rows.loc[left, ["user_id", "channel", "event_type"]].assign(n=n[~closed[entry_path]]), self.COUNTS)
        if closes.any():
            frame = rows.loc[closes, ["user_id", "channel", "at_us", "id"]].rename(columns={"at_us": "purchase_us"}).reset_index(drop=True)
            a, b = (np.searchsorted(entry_path, path[closes], side) for side in ("left", "right"))
            frame["length"] = [int(n[i:j].sum()) for i, j in zip(a, b)]
            names, counts = entry_kind.tolist(), n.tolist()
            frame["counts"] = [dict(zip(names[i:j], counts[i:j])) for i, j in zip(a.tolist(), b.tolist())]
            frame.insert(0, self.group_column, key[0])
            yield frame

    def close(self) -> None:
        pass


class FirstSeen(StatefulProcessor):
    """Passes the first row per key and remembers the key for ``ttl_ms`` of processing time after it
    was last written, the counterpart of an idle state retention."""

    def __init__(self, ttl_ms: int, time: str | None = None):
        self.ttl_ms, self.time = ttl_ms, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at bigint", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))
        first = None
        for batch in rows:
            if known or batch.empty:
                continue
            row = batch.head(1) if self.time is None else batch.sort_values(self.time, kind="stable").head(1)
            if first is None or self.time is not None and row[self.time].iloc[0] < first[self.time].iloc[0]:
                first = row
        if first is not None:
            yield first

    def close(self) -> None:
        pass


class FlushBuffer(StatefulProcessor):
    """Gathers rows per key until there are ``size`` of them or the oldest has waited ``wait_ms``.

    Input column: payload (text). Output: key columns, flush (number of the flush of the key), payload. At most ``size`` - 1
    rows of a key wait in state; the timer is part of the checkpoint, so it also fires after a restart.
    """

    def __init__(self, key_columns: list[str], size: int, wait_ms: int):
        self.key_columns, self.size, self.wait_ms = key_columns, size, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "payload string")
        self.open = handle.getValueState("open", "n bigint, flush bigint, due bigint")

    def _frame(self, key, payloads: list, first: int) -> pd.DataFrame:
        frame = pd.DataFrame({"flush": first + np.arange(len(payloads)) // self.size, "payload": payloads})
        for i, name in enumerate(self.key_columns):
            frame.insert(i, name, key[i])
        return frame

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, flush, due = self.open.get() if self.open.exists() else (0, 0, 0)
        for batch in rows:
            arrived = batch["payload"].tolist()
            if n + len(arrived) < self.size:
                self.rows.appendList([(p,) for p in arrived])
                n += len(arrived)
            else:
                held = ([p[0] for p in self.rows.get()] if n else []) + arrived
                full = len(held) // self.size * self.size
                yield self._frame(key, held[:full], flush)
                flush, n = flush + full // self.size, len(held) - full
                if n:
                    self.rows.put([(p,) for p in held[full:]])
                else:
                    self.rows.clear()
                if due:
                    self.handle.deleteTimer(due)
                    due = 0
        if n and not due:
            due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(due)
        self.open.update((n, flush, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, flush, due = self.open.get()
        if n and due <= timerValues.getCurrentProcessingTimeInMs():
            held = [p[0] for p in self.rows.get()]
            self.rows.clear()
            self.open.update((0, flush + 1, 0))
            yield self._frame(key, held, flush)

    def close(self) -> None:
        pass
