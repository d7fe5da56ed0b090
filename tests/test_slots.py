"""Keyed state serves all keys of a slot at once."""

from types import SimpleNamespace

import pandas as pd

from tidewell.streaming.stateful import CountTrigger


class Handle:
    """State in plain dictionaries that counts its calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def _state(self):
        held = {}

        def called(act):
            def run(*args):
                self.calls += 1
                return act(*args)
            return run

        return SimpleNamespace(
            keys=called(lambda: list(held)), getValue=called(lambda k: held[k]), updateValue=called(held.__setitem__), removeKey=called(held.pop),
            get=called(lambda: held.get(0)), update=called(lambda v: held.__setitem__(0, v)), clear=called(held.clear),
        )

    def getMapState(self, *_):
        return self._state()

    def getValueState(self, *_):
        return self._state()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_many_keys_share_calls():
    handle, processor = Handle(), CountTrigger(2, 3600)
    processor.init(handle)
    rows = pd.DataFrame({"key": range(3000), "keyless": [k == 5 for k in range(3000)], "at_us": 1_000_000, "event_id": range(3000), "cents": 7})
    twice = pd.concat([rows, rows.assign(at_us=2_000_000, event_id=rows["event_id"] + 3000)])
    list(processor.handleInputRows((0,), iter([twice]), None))
    [due] = handle.timers
    handle.timers.clear()
    [out] = processor.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: due + 2000), None)
    assert out["event_count"].tolist() == [2] * 3000 and sorted(k for k in out["user_id"] if k is not None) == [k for k in range(3000) if k != 5]
    assert handle.calls < 50
