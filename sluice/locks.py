"""Leases: one run per entity at a time."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

#: Minutes of a lease, milliseconds to settle, heartbeats that may be missed.
LEASE_MINUTES, SETTLE_MS, MISSED_BEATS = 240, 2_000, 3


class LockError(RuntimeError):
    """The lease is held by another run, or was lost."""


@dataclass(frozen=True)
class LockEvent:
    entity: str
    run_id: str
    action: str
    lease_until: float
    event_ts: float


def holder(events: list[LockEvent], entity: str, now: float, beat_seconds: float | None = None) -> str | None:
    """Who holds the lease: the earliest claim that is neither released nor expired nor, with ``beat_seconds``, silent for three beats."""
    last: dict[str, LockEvent] = {}
    first: dict[str, float] = {}
    for e in sorted((e for e in events if e.entity == entity), key=lambda e: (e.event_ts, e.run_id)):
        if e.action == "RELEASE":
            last.pop(e.run_id, None)
            first.pop(e.run_id, None)
        else:
            last[e.run_id] = e
            first.setdefault(e.run_id, e.event_ts)
    alive = [r for r, e in last.items() if e.lease_until > now and (beat_seconds is None or now - e.event_ts <= MISSED_BEATS * beat_seconds)]
    return min(alive, key=lambda r: (first[r], r), default=None)


class LeaseLock:
    """Claim, wait for others' claims to appear, read again: of several claimants the first wins.

    Works on any append-only table of events through ``read`` and ``append``.
    """

    def __init__(self, entity: str, run_id: str, read: Callable[[], list[LockEvent]], append: Callable[[LockEvent], None], minutes: float = LEASE_MINUTES, settle_ms: int = SETTLE_MS, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.entity, self.run_id, self._read, self._append = entity, run_id, read, append
        self.seconds, self.settle, self.clock, self.sleep = minutes * 60, settle_ms / 1000, clock, sleep
        self.beat_seconds = self.seconds / 3
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None
        self.lost = False

    def _say(self, action: str) -> None:
        now = self.clock()
        self._append(LockEvent(self.entity, self.run_id, action, now + self.seconds, now))

    def acquire(self) -> None:
        now = holder(self._read(), self.entity, self.clock(), self.beat_seconds)
        if now not in (None, self.run_id):
            raise LockError(f"LCK_001 {self.entity} is held by {now}")
        self._say("CLAIM")
        self.sleep(self.settle)
        if (won := holder(self._read(), self.entity, self.clock(), self.beat_seconds)) != self.run_id:
            self._say("RELEASE")
            raise LockError(f"LCK_001 {self.entity} is held by {won}")

    def renew(self) -> bool:
        """Extends the lease; False once another run holds it."""
        if holder(self._read(), self.entity, self.clock(), self.beat_seconds) != self.run_id:
            self.lost = True
            return False
        self._say("CLAIM")
        return True

    def check(self) -> None:
        """Before each step that can't be taken back."""
        if self.lost or holder(self._read(), self.entity, self.clock(), self.beat_seconds) != self.run_id:
            self.lost = True
            raise LockError(f"PIPE_001 {self.run_id} no longer holds {self.entity}")

    def release(self) -> None:
        self._stop.set()
        if self._thread:
            self._thread.join(timeout=5)
        self._say("RELEASE")

    def heartbeat(self) -> None:
        """Renews in the background at a third of the lease."""

        def beat() -> None:
            while not self._stop.wait(self.beat_seconds):
                try:
                    if not self.renew():
                        return
                except Exception:  # noqa: BLE001 - the next beat tries again; the lease decides
                    continue

        self._thread = threading.Thread(target=beat, daemon=True)
        self._thread.start()

    def __enter__(self):
        self.acquire()
        self.heartbeat()
        return self

    def __exit__(self, *_):
        self.release()


class DatabaseLease:
    """A lease kept in one row per entity of a database table, taken by compare-and-set.

    Every change names the version it saw; of two runs that saw the same version one
    update finds no row. Works through the session's JDBC drivers.
    """

    DDL = "CREATE TABLE {t} (entity_name VARCHAR(200) NOT NULL PRIMARY KEY, holder_run_id VARCHAR(200), lease_acquired_ts DOUBLE PRECISION, lease_expires_ts DOUBLE PRECISION, lease_version BIGINT NOT NULL)"

    def __init__(self, spark, url: str, entity: str, run_id: str, table: str = "ingestion_lock", minutes: float = LEASE_MINUTES, clock: Callable[[], float] = time.time, driver: str | None = None):
        self._jvm, self.url, self.table = spark._jvm, url, table
        self.entity, self.run_id, self.seconds, self.clock = entity, run_id, minutes * 60, clock
        if driver:
            self._jvm.java.lang.Class.forName(driver)

    def _run(self, sql: str, *values) -> int | list[tuple]:
        c = self._jvm.java.sql.DriverManager.getConnection(self.url)
        try:
            s = c.prepareStatement(sql.format(t=self.table))
            for i, v in enumerate(values, 1):
                s.setString(i, v) if isinstance(v, str) or v is None else s.setDouble(i, float(v)) if isinstance(v, float) else s.setLong(i, v)
            if not sql.startswith("SELECT"):
                return s.executeUpdate()
            r, out = s.executeQuery(), []
            while r.next():
                out.append((r.getString(1), r.getDouble(2), r.getLong(3)))
            return out
        finally:
            c.close()

    def create_table(self) -> None:
        self._run(self.DDL)

    def _row(self) -> tuple | None:
        got = self._run("SELECT holder_run_id, lease_expires_ts, lease_version FROM {t} WHERE entity_name = ?", self.entity)
        return got[0] if got else None

    def acquire(self) -> None:
        """Takes a free or expired lease, or one this run holds already."""
        row, now = self._row(), float(self.clock())
        if row is None:
            try:
                self._run("INSERT INTO {t} VALUES (?, ?, ?, ?, ?)", self.entity, self.run_id, now, now + self.seconds, 1)
                return
            except Exception:  # noqa: BLE001 - another run inserted the row; decided below
                row = self._row()
        if row[0] not in (None, self.run_id) and row[1] > now:
            raise LockError(f"LCK_001 {self.entity} is held by {row[0]}")
        if not self._set(self.run_id, now + self.seconds, row[2]):
            raise LockError(f"LCK_001 {self.entity} was taken by another run")

    def _set(self, run_id: str | None, until: float, version: int) -> bool:
        return self._run("UPDATE {t} SET holder_run_id = ?, lease_acquired_ts = ?, lease_expires_ts = ?, lease_version = ? WHERE entity_name = ? AND lease_version = ?", run_id, float(self.clock()), until, version + 1, self.entity, version) == 1

    def renew(self) -> bool:
        row = self._row()
        return bool(row and row[0] == self.run_id and self._set(self.run_id, float(self.clock()) + self.seconds, row[2]))

    def release(self) -> None:
        row = self._row()
        if row and row[0] == self.run_id:
            self._set(None, 0.0, row[2])
