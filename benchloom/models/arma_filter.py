"""The exact Gaussian likelihood of ARMA candidates, in stretches that combine exactly.

The Kalman filter of an ARMA model is affine in its state: what a stretch of values does to the state, and to the sum of
squared errors, is a matrix, an offset and a quadratic form of the state it starts from. Forms of neighbouring stretches
join to the form of both, in any grouping, so a series can be filtered in lanes side by side within numpy and in pieces on
many machines, with the likelihood of the plain recursion.

The variances do not depend on the values. Written with the state before the current shock, the model has no noise but the
shock itself, so its covariance after k values is F^k X (I + O X)^-1 F^k' with O = sum of F^j' h h' F^j: a stretch in the
middle of a series starts with its covariance right away, however slowly the filter settles.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np

HEAD = 256  # values filtered one by one until the gain is steady; if it is not by then, lanes have gains of their own
STEADY = 1e-14


class Stretch(NamedTuple):
    """The form of a stretch for C candidates with r states, as functions of the state s it starts from.

    state at the end: move @ s + offset; sum of squared scaled errors: square - 2 * cross @ s + s @ form @ s.
    """

    move: np.ndarray
    offset: np.ndarray
    square: np.ndarray
    cross: np.ndarray
    form: np.ndarray
    log_f: np.ndarray

    def flat(self) -> np.ndarray:
        c = len(self.square)
        return np.concatenate([part.reshape(c, -1) for part in self], axis=1).reshape(-1)


def unflatten(values: np.ndarray, c: int, r: int) -> Stretch:
    table, at, out = np.asarray(values, dtype=float).reshape(c, -1), 0, []
    for shape in ((r, r), (r,), (), (r,), (r, r), ()):
        size = math.prod(shape)
        out.append(table[:, at : at + size].reshape(c, *shape))
        at += size
    return Stretch(*out)


def join(a: Stretch, b: Stretch) -> Stretch:
    """The form of `a` followed by `b`; leading axes are matched as numpy does."""
    column = a.offset[..., None]
    shifted = (b.form @ column)[..., 0]
    turned = np.swapaxes(a.move, -1, -2)
    return Stretch(
        b.move @ a.move,
        (b.move @ column)[..., 0] + b.offset,
        a.square + b.square + np.sum(a.offset * (shifted - 2 * b.cross), axis=-1),
        a.cross + (turned @ (b.cross - shifted)[..., None])[..., 0],
        a.form + turned @ b.form @ a.move,
        a.log_f + b.log_f,
    )


def system(ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transition matrix and loading of the shock, one per candidate."""
    c, p, q = len(ar), ar.shape[1], ma.shape[1]
    r = max(p, q + 1)
    t = np.zeros((c, r, r))
    t[:, :p, 0] = ar
    for i in range(r - 1):
        t[:, i, i + 1] = 1.0
    w = np.zeros((c, r))
    w[:, 0] = 1.0
    w[:, 1 : q + 1] = ma
    return t, w


class Variances:
    """Covariance of the state before each value of a series, from the stationary start."""

    def __init__(self, t: np.ndarray, w: np.ndarray):
        c, r = w.shape
        self.noise = w[:, :, None] * w[:, None, :]
        lifted = np.einsum("cij,ckl->cikjl", t, t).reshape(c, r * r, r * r)
        start = np.linalg.solve(np.eye(r * r)[None] - lifted, self.noise.reshape(c, r * r, 1)).reshape(c, r, r)
        self.x = start - self.noise
        self.f = t - (t @ w[:, :, None]) * np.eye(r)[0][None, None, :]
        self.seen = np.zeros((c, r, r))
        self.seen[:, 0, 0] = 1.0

    def power(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(F^k, O after k values), by halving k."""
        r = self.f.shape[-1]
        move, seen = np.broadcast_to(np.eye(r), self.f.shape), np.zeros_like(self.f)
        step, own = self.f, self.seen
        while k:
            if k & 1:
                seen = seen + np.swapaxes(move, 1, 2) @ own @ move
                move = step @ move
            own = own + np.swapaxes(step, 1, 2) @ own @ step
            step = step @ step
            k >>= 1
        return move, seen

    def of(self, move: np.ndarray, seen: np.ndarray) -> np.ndarray:
        inner = np.linalg.solve(np.swapaxes(np.eye(self.f.shape[-1]) + seen @ self.x, 1, 2), self.x)
        return self.noise + move @ np.swapaxes(inner, 1, 2) @ np.swapaxes(move, 1, 2)

    def at(self, k: int) -> np.ndarray:
        return self.of(*self.power(k))

    def every(self, first: int, step: int, n: int) -> np.ndarray:
        """Covariances before the values first, first + step, ...: shape (candidates, n, states, states)."""
        move, seen = self.power(first)
        by, own = self.power(step)
        out = []
        for _ in range(n):
            out.append(self.of(move, seen))
            seen = seen + np.swapaxes(move, 1, 2) @ own @ move
            move = by @ move
        return np.stack(out, axis=1)


def _lanes(x: np.ndarray, const: np.ndarray, t: np.ndarray, noise: np.ndarray, cov: np.ndarray, fixed: bool, settle: bool = False):
    """Filter the columns of x side by side, each from state 0: (form per lane, covariance after, values read).

    `cov` has one covariance per lane, or one for all; `fixed`: it stays as it is. `settle`: stop when it no longer changes.
    """
    lanes, (c, r) = x.shape[1], t.shape[:2]
    wide, spread = t[:, None], np.swapaxes(t, 1, 2)[:, None]
    ar = t[:, None, :, 0]
    k = cov.shape[1]
    state, square, cross = np.zeros((c, lanes, r)), np.zeros((c, lanes)), np.zeros((c, lanes, r))
    move, form, log_f = np.broadcast_to(np.eye(r), (c, k, r, r)).copy(), np.zeros((c, k, r, r)), np.zeros((c, k))
    gain, read = None, 0
    for values in x:
        if gain is None or not fixed:
            f = cov[..., 0, 0]
            gain = (wide @ cov[..., :1])[..., 0] / f[..., None]
            back = np.broadcast_to(wide, cov.shape).copy()
            back[..., 0] -= gain
            log_step = np.log(f)
        error = values[None, :] - const[:, None] - state[..., 0]
        scaled = error / f
        row = move[..., 0, :]
        square += error * scaled
        cross += scaled[..., None] * row
        form += row[..., :, None] * row[..., None, :] / f[..., None, None]
        log_f += log_step
        new = state[..., :1] * ar
        new += gain * error[..., None]
        new[..., :-1] += state[..., 1:]
        state = new
        move = back @ move
        read += 1
        if not fixed:
            new = wide @ cov @ spread + noise[:, None] - gain[..., :, None] * gain[..., None, :] * f[..., None, None]
            change = np.abs(new - cov).max()
            cov = new
            if settle and change < STEADY * max(1.0, float(np.abs(new).max())):
                break
    return Stretch(move, state, square, cross, form, log_f), cov, read


def folded(lanes: Stretch, n: int) -> Stretch:
    """All lanes of one form per candidate, joined in order, pair by pair."""

    def part(s: Stretch, which) -> Stretch:
        return Stretch(*(v if v.shape[1] == 1 and n > 1 else v[:, which] for v in s))

    rest = None
    while n > 1:
        if n % 2:
            last = part(lanes, slice(n - 1, n))
            rest = last if rest is None else join(last, rest)
        even, odd = part(lanes, slice(0, n - 1, 2)), part(lanes, slice(1, n, 2))
        lanes, n = join(even, odd), n // 2
    whole = lanes if rest is None else join(lanes, rest)
    return Stretch(*(v[:, 0] for v in whole))


def stretch(y: np.ndarray, const: np.ndarray, ar: np.ndarray, ma: np.ndarray, before: int = 0) -> Stretch:
    """The form of the values y, which have `before` values of their series in front of them."""
    t, w = system(ar, ma)
    variances = Variances(t, w)
    cov = variances.at(before)[:, None]
    out, cov, read = _lanes(y[: min(HEAD, len(y)), None], const, t, variances.noise, cov, False, True)
    whole = folded(out, 1)
    rest, steady = y[read:], read < HEAD
    size = max(32, math.isqrt(len(rest)))
    for part in (rest[: len(rest) - len(rest) % size].reshape(-1, size).T, rest[len(rest) - len(rest) % size :, None]):
        if part.size:
            if not steady:
                cov = variances.every(before + read, len(part), part.shape[1])
            more, _, _ = _lanes(part, const, t, variances.noise, cov, steady)
            whole = join(whole, folded(more, part.shape[1]))
            read += part.size
    return whole


def objective(whole: Stretch, n: int) -> np.ndarray:
    """Minus the log-likelihood per value with the best variance, of series that start in the mean state."""
    with np.errstate(all="ignore"):
        value = 0.5 * (np.log(2 * math.pi * whole.square / n) + 1.0) + 0.5 * whole.log_f / n
    return np.where(np.isfinite(value), value, 1e10)
