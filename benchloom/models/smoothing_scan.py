"""Additive exponential smoothing in stretches that combine exactly.

With additive trend and season (or without either) the recursion corrects its state by a multiple of the one-step error, so
it is linear: a stretch is the same kind of form as in ``arma_filter``, and forms join. What does not depend on the values,
the matrix of a stretch and its quadratic part, follows from one season by doubling.
"""

from __future__ import annotations

import math

import numpy as np

from benchloom.models.arma_filter import Stretch, folded, join

CELLS = 2_000_000  # numbers in a table of candidates x states x states


class Correction:
    """The linear recursion of C candidates (alpha, beta, gamma); state: level, slope, one value for each place of the season."""

    def __init__(self, params: np.ndarray, trend: str | None, seasonal: str | None, m: int):
        if "mul" in (trend, seasonal):
            raise ValueError("multiplicative forms are not linear")
        self.m = m if seasonal else 1
        self.states = self.m + 2
        alpha, beta, gamma = params.T
        self.gain = alpha, alpha * beta if trend else 0 * alpha, gamma if seasonal else 0 * gamma

    def _through(self, steps: int, values: np.ndarray | None = None) -> Stretch:
        """The form of `steps` steps from the start of a season; `values`: one column per lane."""
        a, b, g = self.gain
        c, n = len(a), self.states
        move, form = np.broadcast_to(np.eye(n), (c, n, n)).copy(), np.zeros((c, n, n))
        lanes = 1 if values is None else values.shape[1]
        state, square, cross = np.zeros((n, c, lanes)), np.zeros((c, lanes)), np.zeros((c, lanes, n))
        for step in range(steps):
            p = 2 + step % self.m
            row = move[:, 0] + move[:, 1] + move[:, p]
            form += row[:, :, None] * row[:, None, :]
            move[:, 0] += move[:, 1] - a[:, None] * row
            move[:, 1] -= b[:, None] * row
            move[:, p] -= g[:, None] * row
            if values is not None:
                error = values[step] - (state[0] + state[1] + state[p])
                square += error * error
                cross += error[:, :, None] * row[:, None, :]
                state[0] += state[1] + a[:, None] * error
                state[1] += b[:, None] * error
                state[p] += g[:, None] * error
        return Stretch(move[:, None], np.moveaxis(state, 0, 2), square, cross, form[:, None], np.zeros((c, 1)))

    def scan(self, values: np.ndarray) -> Stretch:
        """The form of the values, which begin a season."""
        size = self.m * max(1, round(math.sqrt(len(values)) / self.m))
        whole, at = None, len(values) - len(values) % size
        for part in (values[:at].reshape(-1, size).T, values[at:, None]):
            if part.size:
                own = folded(self._through(len(part), part), part.shape[1])
                whole = own if whole is None else join(whole, own)
        return whole

    def transfer(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(matrix, quadratic part) of a stretch of so many values: whole seasons by doubling, then what is left."""

        def then(x, y):
            return y[0] @ x[0], x[1] + np.swapaxes(x[0], 1, 2) @ y[1] @ x[0]

        def form(steps):
            f = self._through(steps)
            return f.move[:, 0], f.form[:, 0]

        season, out = form(self.m), form(0)
        seasons, rest = divmod(length, self.m)
        while seasons:
            if seasons & 1:
                out = then(out, season)
            season, seasons = then(season, season), seasons >> 1
        return then(out, form(rest)) if rest else out


def batches(candidates: int, states: int):
    """Slices of candidates whose tables stay small."""
    size = max(1, CELLS // states**2)
    return [slice(at, at + size) for at in range(0, candidates, size)]


def scan_numbers(values: np.ndarray, params: np.ndarray, trend: str | None, seasonal: str | None, m: int) -> np.ndarray:
    """What depends on the values: offset, square and cross of each candidate, one row each."""
    out = []
    for part in batches(len(params), (m if seasonal else 1) + 2):
        f = Correction(params[part], trend, seasonal, m).scan(values)
        out.append(np.hstack([f.offset, f.square[:, None], f.cross]))
    return np.vstack(out)


def follow(starts: np.ndarray, numbers: list[np.ndarray], lengths: list[int], params: np.ndarray, trend: str | None, seasonal: str | None, m: int):
    """(state after the last stretch, sum of squared errors) of each candidate through stretches in order."""
    states, squares = [], []
    for part in batches(len(params), (m if seasonal else 1) + 2):
        correction = Correction(params[part], trend, seasonal, m)
        n, known = correction.states, {}
        x, total = np.broadcast_to(starts, (len(params[part]), n)).copy(), 0.0
        for own, length in zip(numbers, lengths, strict=True):
            if length not in known:  # all but the last have one length
                known[length] = correction.transfer(length)
            move, form = known[length]
            offset, square, cross = own[part, :n], own[part, n], own[part, n + 1 :]
            total = total + square - 2 * np.sum(cross * x, axis=1) + np.einsum("ci,cij,cj->c", x, form, x)
            x = (move @ x[:, :, None])[:, :, 0] + offset
        states.append(x)
        squares.append(np.maximum(total, 0.0))
    return np.vstack(states), np.concatenate(squares)
