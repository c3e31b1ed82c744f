"""Both passes of the smoother, on tracks that lie across many ranges."""

import math
from datetime import datetime as dt, timedelta

import numpy as np
import pytest

from lakeloom.streaming import kalman
from lakeloom.streaming.kalman import kalman_smooth, rts_smooth

T0 = dt(2024, 1, 1)
SCHEMA = "vehicle string, timestamp timestamp, n int, x double, y double"


def tracks(seed, sizes, gaps=0.1, spread=20):
    draw, rows = np.random.default_rng(seed), []
    for v, size in enumerate(sizes):
        for i in range(size):
            hole = draw.random() < gaps
            rows.append((None if v == 3 else f"v{v}", T0 + timedelta(seconds=float(spread * i + draw.integers(spread + 1))), len(rows),
                         None if hole else float(i + draw.normal()), float(2 * i + draw.normal())))
    return rows


def both_passes(rows, q=1e-3, r=1.0, v0=1.0):
    """(filtered, smoothed) x, y, vx, vy per row number, one track after the other, in
    plain matrix form."""
    by = {}
    for v, t, n, x, y in rows:
        by.setdefault(v, []).append((t, n, x, y))
    forward, backward = {}, {}
    for pts in by.values():
        pts.sort(key=lambda p: (p[0], p[1]))
        held, before = [], None
        for t, n, x, y in pts:
            told = x is not None and y is not None
            if before is None:
                if not told:
                    forward[n] = backward[n] = (x, y, None, None)
                    continue
                m, p = np.array([[x, y], [0.0, 0.0]]), np.diag([r, v0])
            else:
                h = (t - before).total_seconds()
                f, noise = np.array([[1, h], [0, 1]]), q * np.array([[h**3 / 3, h**2 / 2], [h**2 / 2, h]])
                m, p = f @ m, f @ p @ f.T + noise
                if told:
                    gain = p[:, :1] / (p[0, 0] + r)
                    m, p = m + gain @ (np.array([[x, y]]) - m[:1]), p - gain @ p[:1]
            before = t
            held.append((t, n, m, p))
            forward[n] = tuple(m.reshape(-1))
        later = None
        for t, n, m, p in reversed(held):
            if later is not None:
                h = (later[0] - t).total_seconds()
                f, noise = np.array([[1, h], [0, 1]]), q * np.array([[h**3 / 3, h**2 / 2], [h**2 / 2, h]])
                gain = p @ f.T @ np.linalg.inv(f @ p @ f.T + noise)
                m = m + gain @ (later[1] - f @ m)
            later = (t, m)
            backward[n] = tuple(m.reshape(-1))
    return forward, backward


def shown(df):
    return {r.n: tuple(None if v is None or math.isnan(v) else v for v in (r.x_smooth, r.y_smooth, r.vx, r.vy)) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k, values in want.items():
        assert all(a is None and b is None or a == pytest.approx(b, rel=1e-6, abs=1e-5) for a, b in zip(got[k], values)), k


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_a_hot_track_across_ranges(spark, ranges):
    rows = tracks(1, [700, 3, 120, 40, 1, 60])
    df = spark.createDataFrame(rows, SCHEMA).repartition(4, "n")
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        forward, backward = both_passes(rows)
        same(shown(kalman_smooth(df, tie="n")), forward)
        same(shown(rts_smooth(df, tie="n")), backward)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_only_tracks_at_the_ends_of_batches_are_dealt_again(spark, monkeypatch):
    written, keep = {}, kalman.written_once

    def counted(df, name):
        out = keep(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(kalman, "written_once", counted)
    monkeypatch.setattr(kalman, "_ROWS_AT_ONCE", 150)
    rows = tracks(4, [12] * 60 + [90, 1, 1])
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        same(shown(rts_smooth(spark.createDataFrame(rows, SCHEMA).repartition(4, "n"), tie="n")), both_passes(rows)[1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert written["forward"] == len(rows) and 0 < written["backward"] < len(rows) / 2


def test_small_chunks_change_nothing():
    """The passes of one range, run over chunks of a few rows."""
    import pandas as pd

    rows = sorted(tracks(2, [200, 30, 90], gaps=0.3), key=lambda r: (r[0], r[1], r[2]))
    model = kalman._Model(1e-3, 1.0, 1.0)
    seconds = [(r[1] - T0).total_seconds() for r in rows]
    frame = pd.DataFrame({"_vehicle": [r[0] for r in rows], "_t": seconds, "_slice": [int(s // 300) for s in seconds],
                          "x": [r[3] for r in rows], "y": [r[4] for r in rows]})

    def run(size):
        ahead = kalman._Forward(model, "x", "y")
        one = pd.concat([ahead.run(frame.iloc[i:i + size].reset_index(drop=True)) for i in range(0, len(frame), size)], ignore_index=True)
        back = one.iloc[::-1].drop(columns="_map").reset_index(drop=True)
        behind = kalman._Backward(model)
        two = pd.concat([behind.run(back.iloc[i:i + size].reset_index(drop=True)) for i in range(0, len(back), size)], ignore_index=True)
        return one, two

    whole, parts = run(10**6), run(7)
    for a, b in zip(whole, parts):
        assert np.allclose(a[kalman._SMOOTH].to_numpy(float), b[kalman._SMOOTH].to_numpy(float), atol=1e-7, equal_nan=True)
        assert (a["_open"] == b["_open"]).all()
        open_ = a["_open"].to_numpy()
        for m, w in zip(kalman._unpacked(a["_map"][open_]), kalman._unpacked(b["_map"][open_])):
            assert np.allclose(m, w, rtol=1e-6, atol=1e-7)


def test_rows_without_time_vehicle_or_position(spark):
    rows = [("v", None, 0, 1.0, 2.0), ("v", None, 1, None, 2.0), ("v", T0, 2, None, 5.0), ("v", T0 + timedelta(seconds=9), 3, 4.0, 5.0),
            (None, T0, 4, 1.0, 1.0), (None, T0, 5, 1.0, 1.0), ("w", T0, 6, None, None)]
    for smooth in (kalman_smooth, rts_smooth):
        out = shown(smooth(spark.createDataFrame(rows, SCHEMA), tie="n"))
        assert out[0] == (1.0, 2.0, 0.0, 0.0) and out[1] == (None, 2.0, None, None) and out[2] == (None, 5.0, None, None)
        assert out[3] == (4.0, 5.0, 0.0, 0.0) and out[6] == (None,) * 4
        assert out[4][:2] == pytest.approx((1.0, 1.0)) and out[5][:2] == pytest.approx((1.0, 1.0))
        assert smooth(spark.createDataFrame([], SCHEMA)).collect() == []
