"""The registered user aggregate over very many keys of one row each."""

import time

import pandas as pd

from tidewell.plans.functions_io import SpendProfile


def test_one_row_at_a_time_is_cheap():
    profile, values = SpendProfile(), [float(i * 7919 % 1000) if i % 10 else None for i in range(4000)]
    frame, state = pd.DataFrame({"cents": values}), profile.create()
    start = time.process_time()
    for low in range(len(frame)):
        state = profile.add(state, frame.iloc[low : low + 1])
    assert time.process_time() - start < 0.8
    known = [int(v) for v in values if v is not None]
    assert state == (4000, sum(known), sorted(known, reverse=True)[:3])
    whole = profile.add(profile.create(), frame)
    assert whole == state
