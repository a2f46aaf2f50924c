"""The frames of a batch meet the session's state together, within bounds, with the same rows kept."""

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from test_session_at_size import Handle, Timer, frame

from commentguard.streaming import session as SS


def started():
    handle, processor = Handle(), SS._KeepLast(T.LongType(), 1000, ["id", "own_us_", "own_reset_"])
    processor.init(handle)
    return handle, processor


def test_state_calls_do_not_grow_with_frames(spark):
    handle, processor = started()
    frames = [frame(50 + k) for k in range(20)]
    out = pd.concat(processor.handleInputRows((0,), iter(frames), Timer(0)))
    assert handle.newest.calls <= 3 * SS.BUCKETS
    assert len(out) == 5000 and set(out["own_us_"]) == {69}


def test_frames_are_put_together_within_bounds(spark, monkeypatch):
    rng = np.random.default_rng(3)
    frames = []
    for k in range(30):
        ids = rng.integers(0, 200, 100)
        frames.append(pd.DataFrame({"id": ids, "own_us_": rng.integers(0, 1000, 100), "own_reset_": False, "own_id_": ids, "own_bucket_": ids % 7}))
    frames.insert(15, frame(300, True))
    newest = pd.concat(f for f in frames if not f["own_reset_"].any()).groupby("id")["own_us_"].max()
    want = newest[newest > 300].to_dict()
    for rows, size in ((1 << 19, 64 << 20), (250, 64 << 20), (1 << 19, 9000), (1, 1)):
        monkeypatch.setattr(SS, "HELD_ROWS", rows)
        monkeypatch.setattr(SS, "HELD_BYTES", size)
        assert max(len(f) for f in SS._chunks(iter(frames))) <= rows + 100
        assert sum(len(f) for f in SS._chunks(iter(frames))) == 3001
        handle, processor = started()
        out = pd.concat(processor.handleInputRows((0,), iter(frames), Timer(0)))
        assert out["own_reset_"].sum() == 1
        out = out[~out["own_reset_"] & (out["own_us_"] > 300)]
        assert out.groupby("id")["own_us_"].max().to_dict() == want
        assert {k: us for held in handle.newest.held.values() for k, us in zip(*held[:2])} == want
    assert list(SS._chunks(iter([]))) == []
