"""States of a group of files: what runs in the workers of :mod:`rosterflow.streaming.state`."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

#: Time of an entry without one: before all others.
NEVER = -(1 << 62)


class FileStatus(StatefulProcessor):
    """Folds the entries of files as :func:`rosterflow.streaming.status.latest_status` does.

    A call of the store costs far more than to fold a file, so the files of a group share one
    value, JSON by file id: the newest entry, the newest that finished the file, the order of
    its last submission, and when its time runs out. They share one timer as well, set to the
    first of these times. So a batch reads and writes each group that it has entries of once.
    """

    def __init__(self, stuck_after_minutes: int, terminal: tuple[str, ...]):
        self.limit, self.terminal = stuck_after_minutes * 60_000_000, terminal

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("files", "files string, timer long")

    def _read(self) -> tuple[dict[str, list], int | None]:
        held = self.state.get()
        return ({}, None) if held is None else (json.loads(held[0]), held[1])

    def _write(self, files: dict[str, list], timer: int | None) -> None:
        first = min((due for *_, due in files.values() if due is not None), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        self.state.update((json.dumps(files, separators=(",", ":")), first))

    @staticmethod
    def _shown(newest: list, finished: list | None, again: list | None) -> list:
        return finished if finished and (again is None or finished[:2] > again) else newest

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        files, timer = self._read()
        changed = {}
        for _, file_id, *entry in rows:
            order, status = entry[:2], entry[2]
            newest, finished, again, _ = files.get(file_id) or (None, None, None, None)
            newest = entry if newest is None or order > newest[:2] else newest
            if status in self.terminal and (finished is None or order > finished[:2]):
                finished = entry
            if status == "PENDING" and entry[4] is None and (again is None or order > again):
                again = order
            changed[file_id] = shown = self._shown(newest, finished, again)
            # a time that has passed goes off with this batch
            due = max((shown[0] + self.limit) // 1000, 1) if shown[2] == "PROCESSING" else None
            files[file_id] = [newest, finished, again, due]
        self._write(files, timer)
        for file_id, shown in changed.items():
            yield self._row(file_id, shown, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        files, _ = self._read()
        now, stuck = timerValues.getCurrentProcessingTimeInMs(), []
        for file_id, file in files.items():
            if file[3] is not None and file[3] <= now:
                file[3] = None
                stuck.append(file_id)
        # the timer that went off is deleted by Spark
        self._write(files, None)
        for file_id in stuck:
            yield self._row(file_id, self._shown(*files[file_id][:3]), True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(file_id: str, entry: list, stuck: bool) -> Row:
        micros, _, status, error, batch = entry
        return Row(file_id=file_id, status=status, error_message=error, micros=micros, batch_id=batch, stuck=stuck)
