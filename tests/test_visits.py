"""Visits of many sessions in one call, against a walk through the events one by one."""

import random

import pandas as pd

from tidemark.operators.attribution import FIRST_ACTIVE
from tidemark.streaming.visits import visit_tracker

IDLE = 10


class State:
    """What a call is given of its bucket, with the watermark of the batch."""

    exists, get, hasTimedOut, timeout = False, None, False, None

    def update(self, value):
        self.exists, self.get = True, value

    def remove(self):
        self.exists, self.get = False, None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, timeout):
        assert timeout > self.watermark
        self.timeout = timeout


def one_by_one(batches, watermarks):
    visits, rows, ended = {}, {}, []

    def over(session):
        start, newest, n, section = visits.pop(session)
        ended.append((session, start, newest, n, section or FIRST_ACTIVE))

    for batch, watermark in zip(batches, watermarks, strict=True):
        for session, at, event, section in sorted(batch, key=lambda r: (r[1], r[2])):
            start, newest, n, known = visits.get(session, (at, at, 0, None))
            if at - newest > IDLE * 1_000_000:
                over(session)
                start, newest, n, known = at, at, 0, None
            visits[session] = start, max(at, newest), n + 1, section or known
            rows[event] = session, start, section or known or FIRST_ACTIVE
        for session, (_, newest, *_) in list(visits.items()):
            if (newest + IDLE * 1_000_000) // 1000 + 1 < watermark:
                over(session)
    return rows, sorted(ended)


def test_one_call_takes_all_sessions_of_a_bucket():
    rng = random.Random(4)
    batches, watermarks, event = [], [], 0
    for k in range(30):
        batch = []
        for _ in range(rng.choice([0, 5, 60])):
            event += 1
            at = k * 20_000_000 + rng.randrange(40_000_000)
            batch.append((rng.randrange(12), at, event, rng.choice([None, "home", "about"])))
        batches.append(batch)
        watermarks.append(k * 20_000 - 5_000)
    track, state, rows, ended, calls = visit_tracker(IDLE), State(), {}, [], 0
    for batch, state.watermark in zip(batches, watermarks, strict=True):
        state.hasTimedOut = not batch
        if not batch and (not state.exists or state.timeout >= state.watermark):
            continue
        frame = pd.DataFrame(batch, columns=["session_id", "at", "event_id", "section_id"])
        calls += 1
        for out in track((0,), iter([frame] if batch else []), state):
            for r in out.itertuples():
                if pd.notna(r.event_id):
                    rows[r.event_id] = r.session_id, r.start_us, r.active_section
                else:
                    ended.append((r.session_id, r.start_us, r.end_us, r.n_events, r.ended_in))
    expected, visits = one_by_one(batches, watermarks)
    assert rows == expected and sorted(ended) == visits and len(visits) > 100
    assert calls <= len(batches)
