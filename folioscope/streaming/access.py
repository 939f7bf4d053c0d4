"""Access over a stream: one-time codes, limits on attempts and sessions, as state that expires.

Events are (key, at, event_id, kind) with these kinds and results:

* ``issue``: a code is issued and replaces the one before: ``issued``.
* ``try``: an attempt with the latest code. ``limited`` if it is beyond ``limit`` attempts (itself and limited ones counted) within the last
  ``window`` seconds, ``no code`` if none was issued within the last ``code`` seconds, ``used`` if it has been used, else ``ok``: it uses the code up and opens
  a session of ``session`` seconds, or prolongs the one that is open.
* ``request``: ``ok`` within a session, else ``no session``.
* ``logout``: ``ok`` and the session is revoked, or ``no session``.
* any other kind: ``unknown``, nothing changes.

A session that runs out gives a row of its own: kind ``session``, result ``ended``, the time it ran out and the event that opened it or prolonged it last.

Events are judged in order of time and event_id once the watermark has passed them (ordered.py). Timers also clear codes, attempts and sessions that
have run out, so a silent key keeps no state. Of attempts the last ``limit`` times are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.streaming.ordered import InOrder, judged

SECOND = 1_000_000


@dataclass(frozen=True)
class Rules:
    """Seconds that a code and a session last, and how many attempts are allowed in how many seconds."""

    code: int = 600
    session: int = 3600
    window: int = 300
    limit: int = 5


@dataclass
class Account:
    """What is known of a key; times in microseconds. ``code`` is (at, used), ``session`` (until, event_id)."""

    code: tuple[int, bool] | None = None
    session: tuple[int, int] | None = None
    tries: list[int] = field(default_factory=list)

    def ended(self, rules: Rules, now: int) -> Iterator[tuple]:
        """Forgets what has run out before ``now``, and says so of a session."""
        if self.session and self.session[0] < now:
            yield self.session[0], self.session[1], "session", "ended"
            self.session = None
        if self.code and self.code[0] + rules.code * SECOND < now:
            self.code = None
        self.tries = [t for t in self.tries if t + rules.window * SECOND >= now]

    def judge(self, rules: Rules, at: int, event_id: int, kind: str) -> Iterator[tuple]:
        yield from self.ended(rules, at)
        result = "unknown"
        if kind == "issue":
            self.code, result = (at, False), "issued"
        elif kind == "try":
            limited = len(self.tries) >= rules.limit
            self.tries = [*self.tries, at][-rules.limit :] if rules.limit else []
            result = "limited" if limited else "no code" if not self.code else "used" if self.code[1] else "ok"
            if result == "ok":
                self.code, self.session = (self.code[0], True), (at + rules.session * SECOND, event_id)
        elif kind in ("request", "logout"):
            result = "ok" if self.session else "no session"
            if kind == "logout":
                self.session = None
        yield at, event_id, kind, result

    def expiry(self, rules: Rules) -> int | None:
        """When something held runs out next."""
        ends = [self.session[0]] if self.session else []
        ends += [self.code[0] + rules.code * SECOND] if self.code else []
        ends += [self.tries[0] + rules.window * SECOND] if self.tries else []
        return min(ends, default=None)


class Access(InOrder):
    def __init__(self, key: str, rules: Rules):
        super().__init__(key)
        self.rules = rules

    def init(self, handle) -> None:
        super().init(handle)
        self.code = handle.getValueState("code", "at long, used boolean")
        self.session = handle.getValueState("session", "until long, event_id long")
        self.tries = handle.getListState("tries", "at long")

    def take(self, due: list[tuple], now: int) -> Iterator[dict]:
        code = self.code.get() if self.code.exists() else None
        session = self.session.get() if self.session.exists() else None
        tries = [x[0] for x in self.tries.get()] if self.tries.exists() else []
        account = Account(code and tuple(code), session and tuple(session), tries)
        before = (account.code, account.session, list(tries))
        out = [row for x in due for row in account.judge(self.rules, *x)]
        out += account.ended(self.rules, now)
        if (account.code, account.session, account.tries) != before:
            for state, value in ((self.code, account.code), (self.session, account.session)):
                if value:
                    state.update(value)
                else:
                    state.clear()
            self.tries.clear()
            if account.tries:
                self.tries.put([(t,) for t in account.tries])
        if (ends := account.expiry(self.rules)) is not None:
            self.wake(ends)
        for at, event_id, kind, result in out:
            yield {"at_us": at, "event_id": event_id, "kind": kind, "result": result}


def decisions(events: DataFrame, key: str, rules: Rules = Rules(), delay: str = "1 minute") -> DataFrame:  # noqa: B008
    """The stream of (key, at, event_id, kind, result) of a stream of (key, at, event_id, kind)."""
    rows = judged(events, Access(key, rules), "event_id", "kind", "at_us long, event_id long, kind string, result string", delay)
    return rows.select(key, F.timestamp_micros("at_us").alias("at"), "event_id", "kind", "result")
