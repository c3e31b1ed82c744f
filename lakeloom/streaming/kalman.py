"""Per-vehicle smoothing of positions by a constant-velocity Kalman filter, forwards,
and by a Rauch-Tung-Striebel pass backwards.

A step of either pass is one of a family of maps that is closed under composition, so
both are prefix scans:

1. Rows are dealt in ranges of (vehicle, time): a track of any length is spread over
   tasks, and only the first and the last track of a range go on elsewhere.
2. In a range, tracks are cut into pieces of a few rows. The pieces are reduced to one
   map each, all pieces in step; a log-step scan over the maps gives the state before
   each piece; the pieces are run from there, again in step.
3. Rows of a track that a range does not begin carry their map from the range's start.
   The states at the starts follow from the two end rows of each range, and complete those rows.
4. Tracks that lie in one batch of a range from end to end are run backwards at once, in the same
   task. Only what is left, the first and the last track of each batch, is dealt by range again.

x and y share the model, so they share all matrices. The number of ranges is that of
shuffle partitions; their end rows are all that comes to the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.frames import written_once

# a state is time, x, y, vx, vy, and the covariance: position, position-velocity, velocity
_STATE = [f"_s{i}" for i in range(8)]
# a map is kept as the bytes of its matrices, row by row: A, b, C, eta, J forwards, E and
# g backwards
_ROWS_AT_ONCE = 200_000
_PIECE = 32


class _Model:
    """The filter's matrices, for many steps at a time."""

    def __init__(self, process_noise: float, measurement_noise: float, velocity_variance: float):
        self.q, self.r, self.v0 = process_noise, measurement_noise, velocity_variance

    def move(self, dt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Transition and its noise over time steps."""
        f = np.broadcast_to(np.eye(2), (len(dt), 2, 2)).copy()
        f[:, 0, 1] = dt
        q = np.empty((len(dt), 2, 2))
        q[:, 0, 0], q[:, 1, 1] = self.q * dt**3 / 3, self.q * dt
        q[:, 0, 1] = q[:, 1, 0] = self.q * dt**2 / 2
        return f, q

    def step(self, state: np.ndarray, t: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States (n x 8, NaN time: not begun) after one row each, and what the rows show."""
        new, begun, told = state.copy(), ~np.isnan(state[:, 0]), ~(np.isnan(x) | np.isnan(y))
        dt = np.where(begun, t - state[:, 0], 0.0)
        _, sx, sy, vx, vy, a, b, c = state.T
        pa, pb, pc = (a + dt * (2 * b + dt * c) + self.q * dt**3 / 3, b + dt * c + self.q * dt**2 / 2, c + self.q * dt)
        px, py = sx + dt * vx, sy + dt * vy
        known = begun & told
        gain_p, gain_v = np.where(known, pa / (pa + self.r), 0.0), np.where(known, pb / (pa + self.r), 0.0)
        left = np.where(known, self.r / (pa + self.r), 1.0)  # 1 - gain_p
        ex, ey = np.where(known, x - px, 0.0), np.where(known, y - py, 0.0)
        moved = np.stack([t, px + gain_p * ex, py + gain_p * ey, vx + gain_v * ex, vy + gain_v * ey,
                          pa * left, pb * left, np.where(known, (pc * self.r + (pa * pc - pb * pb)) / (pa + self.r), pc)], axis=1)
        new[begun] = moved[begun]
        first = ~begun & told
        zero = np.zeros(int(first.sum()))
        new[first] = np.stack([t[first], x[first], y[first], zero, zero, zero + self.r, zero, zero + self.v0], axis=1)
        shown = new[:, 1:5].copy()
        early = ~begun & ~told  # no position yet
        shown[early] = np.stack([x[early], y[early], x[early] * np.nan, x[early] * np.nan], axis=1)
        return new, shown

    def element(self, dt: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """One row each as a map: mean -> A mean + b, covariance parts C and J, and the
        information eta about the state before; b and eta for x and y side by side."""
        told = ~(np.isnan(x) | np.isnan(y))
        f, q = self.move(dt)
        s = q[:, 0, 0] + self.r
        gain = np.where(told[:, None], q[:, :, 0] / s[:, None], 0.0)
        keep = np.broadcast_to(np.eye(2), f.shape).copy()
        keep[:, :, 0] -= gain
        z = np.where(told[:, None], np.stack([x, y], axis=1), 0.0)
        b = gain[:, :, None] * z[:, None, :]
        info = np.where(told[:, None], f[:, 0, :] / s[:, None], 0.0)
        return keep @ f, b, keep @ q, info[:, :, None] * z[:, None, :], info[:, :, None] * f[:, 0, None, :]


def _adjugate(m: np.ndarray) -> np.ndarray:
    return np.stack([np.stack([m[:, 1, 1], -m[:, 0, 1]], 1), np.stack([-m[:, 1, 0], m[:, 0, 0]], 1)], 1)


def _determinant(m: np.ndarray) -> np.ndarray:
    return (m[:, 0, 0] * m[:, 1, 1] - m[:, 0, 1] * m[:, 1, 0])[:, None, None]


def _joined(c: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a covariance c and an information matrix j: (1 + cj)^-1, (1 + cj)^-1 c and
    (1 + jc)^-1 j. Written out for 2 x 2, where the large terms, which long gaps bring,
    are all of one sign and do not cancel as they do in a general inverse."""
    dc, dj = _determinant(c), _determinant(j)
    whole = 1 + np.einsum("nij,nji->n", c, j)[:, None, None] + dc * dj
    return ((np.eye(2) + _adjugate(j) @ _adjugate(c)) / whole, (c + dc * _adjugate(j)) / whole, (j + dj * _adjugate(c)) / whole)


def _compose(first: tuple, then: tuple) -> tuple:
    """The map of ``first`` followed by ``then``; associative."""
    a1, b1, c1, e1, j1 = first
    a2, b2, c2, e2, j2 = then
    t = lambda m: np.swapaxes(m, 1, 2)
    inverse, cov, info = _joined(c1, j2)
    return (a2 @ inverse @ a1, a2 @ (inverse @ b1 + cov @ e2) + b2, a2 @ cov @ t(a2) + c2,
            t(a1) @ (t(inverse) @ e2 - info @ b1) + e1, t(a1) @ info @ a1 + j1)


def _apply(element: tuple, state: np.ndarray, last: np.ndarray) -> np.ndarray:
    """States (n x 8) after the maps, whose last rows are at times ``last``."""
    a, b, c, eta, j = element
    p = np.stack([np.stack([state[:, 5], state[:, 6]], 1), np.stack([state[:, 6], state[:, 7]], 1)], 1)
    m = np.stack([np.stack([state[:, 1], state[:, 2]], 1), np.stack([state[:, 3], state[:, 4]], 1)], 1)
    inverse, cov, _ = _joined(p, j)
    mean = a @ (inverse @ m + cov @ eta) + b
    cov = a @ cov @ np.swapaxes(a, 1, 2) + c
    return np.stack([last, mean[:, 0, 0], mean[:, 0, 1], mean[:, 1, 0], mean[:, 1, 1], cov[:, 0, 0], cov[:, 0, 1],
                     cov[:, 1, 1]], axis=1)


def _in_step(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For pieces that lie one after the other: at each step, which pieces still have a
    row and where that row is."""
    starts, order = np.cumsum(sizes) - sizes, np.argsort(-sizes, kind="stable")
    for k in range(int(sizes.max()) if len(sizes) else 0):
        order = order[: np.searchsorted(-sizes[order], -k, side="left")]
        yield order, starts[order] + k


def _scanned(maps: tuple, first: np.ndarray, compose: Callable) -> tuple:
    """Composition of the maps of a run from its start up to and with each, where
    ``first`` tells the place of a run's start; log-step."""
    place, reach, n = np.arange(len(first)), 1, len(first)
    maps = tuple(m.copy() for m in maps)
    while reach < n:
        at = np.flatnonzero(place - first >= reach)
        if not len(at):
            break
        done = compose(tuple(m[at - reach] for m in maps), tuple(m[at] for m in maps))
        for m, d in zip(maps, done):
            m[at] = d
        reach *= 2
    return maps


def _pieces(new_run: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of pieces: cut at ``new_run``, at ``cut`` and every `_PIECE` rows."""
    n = len(new_run)
    begin = np.maximum.accumulate(np.where(new_run | cut, np.arange(n), 0))
    starts = np.flatnonzero((np.arange(n) - begin) % _PIECE == 0)
    return starts, np.diff(np.append(starts, n))


def _reduced(elements: tuple, sizes: np.ndarray, compose: Callable) -> tuple:
    """The composed map of each piece."""
    starts = np.cumsum(sizes) - sizes
    whole = tuple(m[starts].copy() for m in elements)
    for pieces, at in _in_step(sizes):
        if (at == starts[pieces]).all():
            continue
        done = compose(tuple(m[pieces] for m in whole), tuple(m[at] for m in elements))
        for m, d in zip(whole, done):
            m[pieces] = d
    return whole


def _prefixes(elements: tuple, sizes: np.ndarray, run_of_piece: np.ndarray, compose: Callable) -> tuple[tuple, np.ndarray]:
    """Map of each piece composed with all before it in its run, and whether a piece has
    one before it."""
    first = np.searchsorted(run_of_piece, run_of_piece)
    return _scanned(_reduced(elements, sizes, compose), first, compose), np.arange(len(first)) > first


def _flat(maps: tuple) -> np.ndarray:
    return np.concatenate([m.reshape(len(m), -1) for m in maps], axis=1)


def _packed(maps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of ``maps`` as bytes at the places ``at`` holds for, else None."""
    out = np.full(len(at), None, object)
    out[at] = [m.tobytes() for m in maps]
    return out


def _unpacked(maps) -> tuple:
    maps = list(maps)
    return _unflat(np.frombuffer(b"".join(maps)).reshape(len(maps), -1))


def _unflat(rows: np.ndarray) -> tuple:
    return tuple(rows[:, k: k + 4].reshape(-1, 2, 2) for k in range(0, rows.shape[1], 4))


class _Forward:
    """Filters the rows of one range, some hundred thousand at a time."""

    def __init__(self, model: _Model, x: str, y: str):
        self.model, self.x, self.y = model, x, y
        self.track, self.state, self.map, self.open, self.start = None, np.full(8, np.nan), None, True, np.nan

    def run(self, rows: pd.DataFrame) -> pd.DataFrame:
        model = self.model
        t, px, py = (rows[c].to_numpy(dtype=float, na_value=np.nan) for c in ("_t", self.x, self.y))
        tracks, n = rows["_vehicle"].to_numpy(), len(rows)
        new = np.ones(n, bool)
        new[1:] = tracks[1:] != tracks[:-1]
        new[0] = self.track is None or tracks[0] != self.track
        if new[0] and self.track is not None:
            self.open = False       # the range's first track has ended
        if new[0]:
            self.state, self.map, self.start = np.full(8, np.nan), None, t[0]
        run = np.cumsum(np.concatenate([[0], new[1:].astype(int)]))
        starts, sizes = _pieces(np.concatenate([[True], new[1:]]), np.concatenate([[False], np.diff(rows["_slice"].to_numpy()) != 0]))
        state = self._states_before(t, px, py, run, new, starts, sizes)
        out = np.empty((n, 4))
        after = np.empty((n, 8))
        for pieces, at in _in_step(sizes):
            state[pieces], out[at] = model.step(state[pieces], t[at], px[at], py[at])
            after[at] = state[pieces]
        kept, opened = np.empty((0, 20)), self.open & (run == 0)
        if self.open:
            kept = self._maps(t[opened], px[opened], py[opened])
            self.map = kept[-1]
            if run[-1] > 0:
                self.open = False
        self.track, self.state = tracks[-1], after[-1]
        more = {"x_smooth": out[:, 0], "y_smooth": out[:, 1], "vx": out[:, 2], "vy": out[:, 3], "_open": opened, "_from": self.start, "_map": _packed(kept, opened)}
        return pd.concat([rows.assign(**more), pd.DataFrame(after, columns=_STATE, index=rows.index)], axis=1)

    def _states_before(self, t, px, py, run, new, starts, sizes) -> np.ndarray:
        """State before each piece, if nothing came before the range."""
        told = ~(np.isnan(px) | np.isnan(py) | np.isnan(t))
        n, runs = len(t), run[-1] + 1
        place = np.where(told, np.arange(n), n)
        begin = np.full(runs, n)
        np.minimum.at(begin, run, place)
        before = np.concatenate([[np.nan], t[:-1]])
        before[np.flatnonzero(np.concatenate([[False], new[1:]]))] = np.nan
        if not new[0] and not np.isnan(self.state[0]):
            begin[0], before[0] = -1, self.state[0]
        elements = self.model.element(np.where(np.isnan(t - before), 0.0, t - before), px, py)
        at = begin[(begin >= 0) & (begin < n)]
        for m, value in zip(elements, (0.0, np.stack([np.stack([px[at], py[at]], 1), np.zeros((len(at), 2))], 1),
                                       np.diag([self.model.r, self.model.v0]), 0.0, 0.0)):
            m[at] = value
        # rows before the first position leave no trace
        early = np.arange(n) < begin[run]
        for m, value in zip(elements, (np.eye(2), 0.0, 0.0, 0.0, 0.0)):
            m[early] = value
        prefix, follows = _prefixes(elements, sizes, run[starts], _compose)
        state = np.full((len(starts), 8), np.nan)
        if begin[0] == -1:
            mine = np.flatnonzero(run[starts] == 0)
            held = np.broadcast_to(self.state, (len(mine), 8)).copy()
            later = mine[1:]
            state[mine[0]] = self.state
            if len(later):
                state[later] = _apply(tuple(m[later - 1] for m in prefix), held[1:], t[starts[later] - 1])
        b, c = prefix[1], prefix[2]
        known = np.flatnonzero(follows & (begin[run[starts]] >= 0) & (starts > begin[run[starts]]))
        p = known - 1
        state[known] = np.stack([t[starts[known] - 1], b[p, 0, 0], b[p, 0, 1], b[p, 1, 0], b[p, 1, 1], c[p, 0, 0], c[p, 0, 1],
                                 c[p, 1, 1]], axis=1)
        return state

    def _maps(self, t, px, py) -> np.ndarray:
        """Per row of the range's first track the map from the state at the track's first
        time in the range, for the case that the track has begun before."""
        n = len(t)
        before = np.concatenate([[self.state[0] if self.map is not None else t[0]], t[:-1]])
        if self.map is not None:
            before[0] = self._last
        self._last = t[-1]
        elements = self.model.element(np.where(np.isnan(t - before), 0.0, t - before), px, py)
        starts, sizes = _pieces(np.arange(n) == 0, np.zeros(n, bool))
        prefix, follows = _prefixes(elements, sizes, np.zeros(len(starts), int), _compose)
        whole = tuple(m.copy() for m in elements)
        for pieces, at in _in_step(sizes):
            inner = at != starts[pieces]
            lead = np.where(inner, at - 1, 0)
            if inner.any():
                done = _compose(tuple(m[lead[inner]] for m in whole), tuple(m[at[inner]] for m in elements))
                for m, d in zip(whole, done):
                    m[at[inner]] = d
        piece = np.repeat(np.arange(len(starts)), sizes)
        later = np.flatnonzero(piece > 0)
        if len(later):
            done = _compose(tuple(m[piece[later] - 1] for m in prefix), tuple(m[later] for m in whole))
            for m, d in zip(whole, done):
                m[later] = d
        if self.map is not None:
            held = _unflat(np.broadcast_to(self.map, (n, 20)))
            whole = _compose(held, whole)
        return _flat(whole)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if len(pdf):
            held.append(pdf)
        if sum(map(len, held)) >= _ROWS_AT_ONCE:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _numbers(names: list[str]) -> list[T.StructField]:
    return [T.StructField(c, T.DoubleType()) for c in names]


_SMOOTH = ["x_smooth", "y_smooth", "vx", "vy"]
_PLACE = [T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType()), T.StructField("_last", T.BooleanType()),
          T.StructField("_open", T.BooleanType()), T.StructField("_from", T.DoubleType()), T.StructField("_done", T.BooleanType())]


def _placed(runner, names: list[str], part_of: Callable, finish: Callable) -> Callable:
    """Runs a pass over the batches of a range, and numbers its rows; its last one is
    marked. ``finish`` gets the rows of each batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, waiting = 0, None
        here = runner()
        for rows in _gathered(batches):
            if waiting is not None:
                yield waiting
            out = here.run(rows)
            waiting = finish(out.assign(_part=np.int32(part_of(rows)), _at=np.arange(done, done + len(out)), _last=False, _done=False))[names]
            done += len(rows)
        if waiting is not None:
            waiting.iloc[-1, waiting.columns.get_loc("_last")] = True
            yield waiting

    return run


def _states_at_starts(firsts: list, lasts: list, model: _Model) -> dict[int, np.ndarray]:
    """State before each range whose first track has begun before, from the first and
    the last rows of the ranges in order."""
    found: dict[int, np.ndarray] = {}
    state, track, nothing = np.full((1, 8), np.nan), None, np.array([np.nan])
    for first, last in zip(firsts, lasts):
        goes_on = first["_vehicle"] == track and not np.isnan(state[0, 0])
        if goes_on:
            found[first["_part"]] = state[0]
        if goes_on and last["_open"]:
            moved, _ = model.step(state, np.array([last["_from"]]), nothing, nothing)
            state = _apply(_unpacked([last["_map"]]), moved, np.array([last["_t"]]))
        else:
            state = np.array([[last[c] for c in _STATE]], float)
        track = last["_vehicle"]
    return found


def _filtered(df: DataFrame, vehicle: str, ts: str, x: str, y: str, tie: str | None, slice_seconds: int, model: _Model,
              finish: Callable) -> tuple[DataFrame, DataFrame]:
    """Rows that ``finish`` has done, as shown; and all others with the result of the forward pass, their state,
    range and place."""
    spark = df.sparkSession
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1_000_000.0)
    keyed = df.withColumns({"_t": seconds, "_vehicle": F.coalesce(F.concat(F.lit("v"), F.col(vehicle).cast("string")), F.lit("")),
                            "_slice": F.coalesce(F.floor(seconds / slice_seconds), F.lit(-(2**62))).cast("bigint")})
    order = ["_vehicle", "_t", *([tie] if tie else [])]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*keyed.drop("_slice").schema.fields, *_numbers(_SMOOTH), *_PLACE, *_numbers(_STATE), T.StructField("_map", T.BinaryType())])
    names = schema.fieldNames()
    xs, ys = x, y
    first = written_once(keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInPandas(
        _placed(lambda: _Forward(model, xs, ys), names, lambda rows: TaskContext.get().partitionId(), finish), schema), "forward")
    ends = first.select("_part", "_vehicle", "_t", "_open", "_from", *_STATE, "_map")
    starts, lasts = (ends.where(end).orderBy("_part").collect() for end in (first["_at"] == 0, first["_last"]))
    before = spark.sparkContext.broadcast(_states_at_starts(starts, lasts, model))

    def completed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nothing = np.array([np.nan])
        for rows in batches:
            parts = rows["_part"].to_numpy()
            at = np.flatnonzero(np.isin(parts, list(before.value)))
            if len(at):
                held = np.array([before.value[p] for p in parts[at]])
                n = len(at)
                moved, _ = model.step(held, rows["_from"].to_numpy()[at], np.repeat(nothing, n), np.repeat(nothing, n))
                state = _apply(_unpacked(rows["_map"].to_numpy()[at]), moved, rows["_t"].to_numpy()[at])
                for k, c in enumerate(_STATE):
                    rows.iloc[at, rows.columns.get_loc(c)] = state[:, k]
                for k, c in enumerate(_SMOOTH):
                    rows.iloc[at, rows.columns.get_loc(c)] = state[:, k + 1]
            yield rows.drop(columns="_map")

    schema = T.StructType([f for f in schema.fields if f.name != "_map"])
    rest = first.where("NOT _done AND NOT _open").drop("_map").unionByName(first.where("_open").mapInPandas(completed, schema))
    return first.where("_done").select(*[F.col(f"`{c}`") for c in df.columns], *_SMOOTH), rest


def kalman_smooth(df: DataFrame, vehicle: str = "vehicle", ts: str = "timestamp", x: str = "x", y: str = "y",
                  tie: str | None = None, slice_seconds: int = 3600, process_noise: float = 1e-3,
                  measurement_noise: float = 1.0, velocity_variance: float = 1.0) -> DataFrame:
    """Adds x_smooth, y_smooth, vx and vy: the state given all rows up to each.

    ``slice_seconds`` decides where a track is cut into pieces, not the result. Rows of a
    vehicle before its first position have no state. Rows without a vehicle are one
    track; rows without a time come first and are shown as they are."""
    model = _Model(process_noise, measurement_noise, velocity_variance)
    _, rest = _filtered(df, vehicle, ts, x, y, tie, slice_seconds, model, lambda rows: rows)
    return rest.select(*[F.col(f"`{c}`") for c in df.columns], *_SMOOTH)


def _step_back(state: np.ndarray, dt: np.ndarray, model: _Model) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed mean of a row from that of the next: E next + g; filtered states n x 8."""
    f, q = model.move(dt)
    p = np.stack([np.stack([state[:, 5], state[:, 6]], 1), np.stack([state[:, 6], state[:, 7]], 1)], 1)
    m = np.stack([np.stack([state[:, 1], state[:, 2]], 1), np.stack([state[:, 3], state[:, 4]], 1)], 1)
    ahead = f @ p @ np.swapaxes(f, 1, 2) + q
    gain = p @ np.swapaxes(f, 1, 2) @ (_adjugate(ahead) / _determinant(ahead))
    return gain, m - gain @ (f @ m)


def _follow(first: tuple, then: tuple) -> tuple:
    return then[0] @ first[0], then[0] @ first[1] + then[1]


class _Backward:
    """The backward pass over the rows of one range, the latest first. A row's map leads
    from the smoothed mean of the range's last row."""

    def __init__(self, model: _Model):
        self.model, self.track, self.time, self.mean, self.map, self.open = model, None, np.nan, None, None, True

    def run(self, rows: pd.DataFrame) -> pd.DataFrame:
        state = rows[_STATE].to_numpy(dtype=float)
        tracks, n = rows["_vehicle"].to_numpy(), len(rows)
        new = np.ones(n, bool)
        new[1:] = tracks[1:] != tracks[:-1]
        new[0] = self.track is None or tracks[0] != self.track
        if new[0] and self.track is not None:
            self.open = False
        begun = ~np.isnan(state[:, 0])
        state = np.where(begun[:, None], state, 0.0)
        state[~begun, 5] = state[~begun, 7] = 1.0
        after = np.concatenate([[self.time], rows["_t"].to_numpy(dtype=float)[:-1]])
        dt = after - rows["_t"].to_numpy(dtype=float)
        elements = _step_back(state, np.where(np.isnan(dt), 0.0, dt), self.model)
        own = np.stack([np.stack([state[:, 1], state[:, 2]], 1), np.stack([state[:, 3], state[:, 4]], 1)], 1)
        elements[0][new], elements[1][new] = 0.0, own[new]
        if not new[0]:
            elements[1][0], elements[0][0] = (elements[0][:1] @ self.mean + elements[1][:1])[0], 0.0
        run = np.cumsum(np.concatenate([[0], new[1:].astype(int)]))
        starts, sizes = _pieces(np.concatenate([[True], new[1:]]), np.zeros(n, bool))
        prefix, follows = _prefixes(elements, sizes, run[starts], _follow)
        mean, now = np.empty((n, 2, 2)), np.zeros((len(starts), 2, 2))
        now[follows] = prefix[1][np.flatnonzero(follows) - 1]
        for pieces, at in _in_step(sizes):
            now[pieces] = elements[0][at] @ now[pieces] + elements[1][at]
            mean[at] = now[pieces]
        kept, opened = np.empty((0, 8)), self.open & (run == 0)
        if self.open:
            k = int(opened.sum())
            link = _step_back(state[:k], np.where(np.isnan(dt[:k]), 0.0, dt[:k]), self.model)
            if self.map is None:
                link[0][0], link[1][0] = np.eye(2), 0.0
            starts, sizes = _pieces(np.arange(k) == 0, np.zeros(k, bool))
            prefix, _ = _prefixes(link, sizes, np.zeros(len(starts), int), _follow)
            whole, now = tuple(m.copy() for m in link), tuple(np.concatenate([[z], m[:-1]]) for z, m in zip((np.eye(2), np.zeros((2, 2))), prefix))
            for pieces, at in _in_step(sizes):
                now_here = _follow(tuple(m[pieces] for m in now), tuple(m[at] for m in link))
                for m, w, d in zip(now, whole, now_here):
                    m[pieces], w[at] = d, d
            if self.map is not None:
                whole = _follow(_unflat(np.broadcast_to(self.map, (k, 8))), whole)
            kept = _flat(whole)
            self.map = kept[-1]
            if run[-1] > 0:
                self.open = False
        self.track, self.time, self.mean = tracks[-1], rows["_t"].iloc[-1], mean[-1]
        shown = np.where(begun[:, None], mean.reshape(n, 4), rows[_SMOOTH].to_numpy(dtype=float))
        out = rows.assign(**{c: shown[:, i] for i, c in enumerate(_SMOOTH)}, _open=opened & begun)
        return out.assign(_map=_packed(kept, opened))


def _whole_tracks(model: _Model) -> Callable:
    """Runs the tracks of a batch that begin and end inside it backwards at once. The first and the last
    track of a batch may go on elsewhere and are left. What is done needs no state any more."""
    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        tracks = rows["_vehicle"].to_numpy()
        cuts = np.flatnonzero(tracks[1:] != tracks[:-1]) + 1
        if len(cuts) < 2:
            return rows
        low, high = int(cuts[0]), int(cuts[-1])
        smooth = _Backward(model).run(rows.iloc[low:high][::-1].reset_index(drop=True))[_SMOOTH].to_numpy(dtype=float)[::-1]
        inner = np.zeros(len(rows), bool)
        inner[low:high] = True
        shown = {c: rows[c].to_numpy(dtype=float, copy=True) for c in _SMOOTH}
        for k, c in enumerate(_SMOOTH):
            shown[c][low:high] = smooth[:, k]
        spent = {c: np.where(inner, np.nan, rows[c].to_numpy(dtype=float)) for c in ["_from", *_STATE]}
        return rows.assign(**shown, **spent, _vehicle=np.where(inner, "", tracks), _done=inner)

    return finish


def rts_smooth(df: DataFrame, vehicle: str = "vehicle", ts: str = "timestamp", x: str = "x", y: str = "y",
               tie: str | None = None, slice_seconds: int = 3600, process_noise: float = 1e-3,
               measurement_noise: float = 1.0, velocity_variance: float = 1.0) -> DataFrame:
    """As `kalman_smooth`, but each state is given all rows of the vehicle, later ones
    included: the filter, then the Rauch-Tung-Striebel pass from the last row back."""
    spark, model = df.sparkSession, _Model(process_noise, measurement_noise, velocity_variance)
    done, forward = _filtered(df, vehicle, ts, x, y, tie, slice_seconds, model, _whole_tracks(model))
    schema = T.StructType([*forward.schema.fields, T.StructField("_map", T.BinaryType())])
    names, ranges = schema.fieldNames(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a task may hold several ranges, one after the other
    back = written_once(forward.repartition(ranges, "_part").sortWithinPartitions("_part", F.desc("_at"))
                        .mapInPandas(_range_by_range(lambda: _Backward(model), names), schema), "backward")
    columns = ["_part", "_vehicle", "_t", "_open", *_SMOOTH, *_STATE, "_map"]
    firsts, lasts = (back.where(w).select(*columns).orderBy("_part").collect() for w in ("_at = 0", "_last"))
    means = spark.sparkContext.broadcast(_means_at_ends(firsts, lasts, model))

    def completed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            parts = rows["_part"].to_numpy()
            at = np.flatnonzero(np.isin(parts, list(means.value)))
            if len(at):
                e, g = _unpacked(rows["_map"].to_numpy()[at])
                mean = (e @ np.array([means.value[p] for p in parts[at]]) + g).reshape(-1, 4)
                for k, c in enumerate(_SMOOTH):
                    rows.iloc[at, rows.columns.get_loc(c)] = mean[:, k]
            yield rows[out_names]

    out = T.StructType([*df.schema.fields, *_numbers(_SMOOTH)])
    out_names = out.fieldNames()
    shown = back.where("NOT _open").select(*[F.col(f"`{c}`") for c in out_names])
    return done.unionByName(shown).unionByName(back.where("_open").mapInPandas(completed, out))


def _range_by_range(runner: Callable, names: list[str]) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, part = None, None
        for rows in _gathered(batches):
            parts = rows["_part"].to_numpy()
            for begin, end in zip(*(lambda c: (c, np.append(c[1:], len(parts))))(np.flatnonzero(np.diff(parts, prepend=-1) != 0))):
                if parts[begin] != part:
                    here, part = runner(), parts[begin]
                yield here.run(rows.iloc[begin:end].reset_index(drop=True))[names]

    return run


def _means_at_ends(firsts: list, lasts: list, model: _Model) -> dict[int, np.ndarray]:
    """Smoothed mean of the last row of each range whose track goes on in the next one,
    from the first and the last rows of the ranges."""
    found: dict[int, np.ndarray] = {}
    matrix = lambda row, names: np.array([row[c] for c in names], float).reshape(-1, 2, 2)
    for k in range(len(lasts) - 2, -1, -1):
        last, ahead = lasts[k], firsts[k + 1]
        state = np.array([[last[c] for c in _STATE]], float)
        if last["_vehicle"] != ahead["_vehicle"] or np.isnan(state[0, 0]):
            continue
        mean = matrix(ahead, _SMOOTH)[0]
        if ahead["_open"] and ahead["_part"] in found:
            e, g = (m[0] for m in _unpacked([ahead["_map"]]))
            mean = e @ found[ahead["_part"]] + g
        gain, rest = _step_back(state, np.array([ahead["_t"] - last["_t"]]), model)
        found[last["_part"]] = (gain @ mean + rest)[0]
    return found
