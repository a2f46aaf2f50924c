"""A batch asks the session's state once for each bucket of ids, not for each id."""

import numpy as np
import pandas as pd
from pyspark.sql import types as T

from commentguard.streaming import session as SS


class State:
    def __init__(self):
        self.held, self.calls = {}, 0

    def _call(self, result):
        self.calls += 1
        return result

    exists = lambda self: self._call(() in self.held)
    get = lambda self: self._call(self.held[()])
    update = lambda self, v: self._call(self.held.update({(): v}))
    containsKey = lambda self, k: self._call(k in self.held)
    getValue = lambda self, k: self._call(self.held[k])
    updateValue = lambda self, k, v: self._call(self.held.update({k: v}))
    removeKey = lambda self, k: self._call(self.held.pop(k, None))
    iterator = lambda self: self._call(iter(list(self.held.items())))


class Handle:
    def __init__(self):
        self.newest, self.reset = State(), State()

    getMapState = lambda self, *a, **k: self.newest
    getValueState = lambda self, *a, **k: self.reset


class Timer:
    def __init__(self, now):
        self.getCurrentProcessingTimeInMs = lambda: now


def frame(us, reset=False, n=5000):
    ids = np.arange(1 if reset else n)
    return pd.DataFrame({"id": ids, "own_us_": us, "own_reset_": reset, "own_id_": ids, "own_bucket_": ids % SS.BUCKETS})


def test_state_calls_grow_with_buckets(spark):
    handle, processor = Handle(), SS._KeepLast(T.LongType(), 1000, ["id"])
    processor.init(handle)

    def batch(now, *frames):
        handle.newest.calls = 0
        return [len(f) for f in processor.handleInputRows((0,), iter(frames), Timer(now))]

    assert batch(0, frame(50)) == [5000] and handle.newest.calls <= 3 * SS.BUCKETS
    assert batch(10, frame(49)) == []
    assert batch(10, frame(50, n=10)) == [10]  # written again, so these live until 1010
    assert batch(1000, frame(49)) == [4990]  # the others are forgotten, though their bucket is not
    assert batch(1005, frame(49, True), frame(49), frame(51, n=1)) == [1, 1]
    assert sum(len(v[0]) for v in handle.newest.held.values()) == 10
