"""A cascade of second-order sections as one linear recurrence, whose runs over blocks of samples compose.

A block takes the state before it to A^length state + end, where end is the state after a run from rest. Blocks can so be summarised side by
side, their states found by a fold over summaries, and the blocks then run from their states, forward and backward.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from . import dsp

CHUNK = 256


def normal_form(b0: float, b1: float, b2: float, a1: float, a2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(state matrix, input, output, direct gain) of a section, its state a rotation by the pole, so that its powers never grow."""
    c1, c2 = b1 - a1 * b0, b2 - a2 * b0
    if a2 == b2 == 0:
        return np.array([[-a1, 0.0], [0.0, 0.0]]), np.array([1.0, 0.0]), np.array([c1, 0.0]), b0
    re = -a1 / 2
    im = np.sqrt(a2 - re * re)
    return np.array([[re, im], [-im, re]]), np.array([1.0, 0.0]), np.array([c1, -(c2 + c1 * re) / im]), b0


class Cascade:
    """Sections (b0 b1 b2 a1 a2), two states each."""

    def __init__(self, sections: np.ndarray):
        m = 2 * len(sections)
        self.sections = sections
        self.a, self.b, self.c, self.d = np.zeros((m, m)), np.zeros(m), np.zeros(m), 1.0
        for k, section in enumerate(sections):  # the section's input is c state + d x of those before it
            i = 2 * k
            turn, into, out, b0 = normal_form(*section)
            self.a[i : i + 2] += np.outer(into, self.c)
            self.b[i : i + 2] = into * self.d
            self.a[i : i + 2, i : i + 2] += turn
            self.c, self.d = b0 * self.c, b0 * self.d
            self.c[i : i + 2] += out
        powers = [np.eye(m)]
        for _ in range(CHUNK):
            powers.append(self.a @ powers[-1])
        self.powers = np.array(powers)
        self.free = np.array([self.c @ p for p in powers[:CHUNK]])
        reach = np.array([p @ self.b for p in powers[:CHUNK]])  # the state some steps after a sample of one
        response = np.append(self.d, reach[:-1] @ self.c)
        t = np.arange(CHUNK)
        self.toeplitz = np.where(t[:, None] <= t, response[np.abs(t[:, None] - t)], 0.0)
        self.reach = reach[::-1]
        self._levels: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        self._maps: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def steady(self, value: float) -> np.ndarray:
        """The state after value has been there for ever."""
        found = []
        for section in self.sections:
            turn, into, out, b0 = normal_form(*section)
            state = np.linalg.solve(np.eye(2) - turn, into * value)
            found.append(state)
            value = out @ state + b0 * value
        return np.concatenate(found)

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output and the state after it. x: samples, or samples by column with a state by column."""
        y = np.empty_like(x, np.float64)
        for a in range(0, len(x), CHUNK):
            part = x[a : a + CHUNK]
            n = len(part)
            y[a : a + n] = self.toeplitz[:n, :n].T @ part + self.free[:n] @ state
            state = self.powers[n] @ state + self.reach[CHUNK - n :].T @ part
        return y, state

    def maps(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a block of this length, as matrices on the state before it: the state after it, the end of a backward run over the output, the last output."""
        if length not in self._maps:
            m = len(self.b)
            y, after = self.run(np.zeros((length, m)), np.eye(m))
            self._maps[length] = after, self.run(y[::-1], np.zeros((m, m)))[1], y[-1]
        return self._maps[length]

    def summary(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """From rest: the state after a block, the end of the backward run over its output, and its last output."""
        rest = np.zeros(len(self.b))
        y, after = self.run(x, rest)
        return after, self.run(y[::-1], rest)[1], float(y[-1])

    def level(self, length: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The summary of a block of ones."""
        if length not in self._levels:
            self._levels[length] = self.summary(np.ones(length))
        return self._levels[length]

    def states(self, first: float, lengths: list[int], ends: list[np.ndarray], backs: list[np.ndarray], lasts: list[float]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The state before each block of a channel, forward and backward, from the blocks' summaries."""
        state, forward = self.steady(first), []
        for n, end in zip(lengths, ends):
            forward.append(state)
            state = self.maps(n)[0] @ state + end
        backward: list[np.ndarray] = [state] * len(lengths)
        for k in range(len(lengths) - 1, -1, -1):
            after, back, last = self.maps(lengths[k])
            if k == len(lengths) - 1:
                state = self.steady(lasts[k] + float(last @ forward[k]))
            backward[k] = state
            state = after @ state + backs[k] + back @ forward[k]
        return forward, backward

    def both(self, x: np.ndarray, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """A block's output of both passes."""
        return self.run(self.run(x, forward)[0][::-1], backward)[0][::-1]


@lru_cache(64)
def highpass(rate: float) -> Cascade:
    """One pass of the zero-phase high-pass."""
    order, cutoff = dsp.butterworth_order(rate, dsp.HIGH_STOP, dsp.HIGH_PASS, dsp.HIGH_STOP_DB / 2, dsp.HIGH_PASS_DB / 2)
    return Cascade(dsp.highpass_sections(rate, order, cutoff))


def padding(n: int, rate: float) -> int:
    """Samples of the odd extension at each end."""
    return min(n - 1, int(6 * rate / dsp.HIGH_STOP))
