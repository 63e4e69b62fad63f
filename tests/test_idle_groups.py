"""The state of silent keys: a group of keys takes a few calls, whatever the number of its keys."""

import pickle
from types import SimpleNamespace

import pandas as pd

from tidemill.streaming.idle import _Silence


def test_keys_of_a_group_share_state_and_timer():
    held, timers, calls = [], set(), []
    state = SimpleNamespace(
        exists=lambda: bool(held), get=lambda: held[0], clear=held.clear,
        update=lambda v: (calls.append("update"), held.clear(), held.append(v)),
    )
    handle = SimpleNamespace(
        getValueState=lambda *a: state, registerTimer=lambda t: (calls.append("timer"), timers.add(t)),
        deleteTimer=timers.discard, listTimers=lambda: list(timers),
    )
    job = _Silence(2000, "k")
    job.init(handle)

    def at(now):
        return SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)

    def rows(names, n):
        return iter([pd.DataFrame({"key": [pickle.dumps(k, 4) for k in names], "count": [n] * len(names)})])

    def fired(now):
        timers.difference_update({t for t in timers if t <= now})
        return {k: n for part in job.handleExpiredTimer((0,), at(now), None) for k, n in zip(part["k"], part["count"].tolist())}

    list(job.handleInputRows((0,), rows(range(500), 1), at(1000)))
    list(job.handleInputRows((0,), rows([1, 2], 5), at(2500)))
    assert timers == {3000} and len(calls) == 3
    assert fired(3000) == {k: 1 for k in range(500) if k not in (1, 2)}
    assert timers == {4500} and fired(4500) == {1: 6, 2: 6} and not held and not timers
