"""Signal processing in numpy: kernel design, fractional resampling, zero-phase high-pass, spectra."""

from __future__ import annotations

import math

import numpy as np

from ..errors import require

PASS_HZ, STOP_HZ, STOP_DB, BLOCK = 120.0, 128.0, 80.0, 4096
HIGH_STOP, HIGH_PASS, HIGH_STOP_DB, HIGH_PASS_DB = 0.15, 0.30, 80.0, 0.05


def kaiser_plan(rate: float, low: float = PASS_HZ, high: float = STOP_HZ, stop_db: float = STOP_DB) -> tuple[int, float, float]:
    """Even order, shape and normalised cutoff of a Kaiser-windowed sinc that passes below low and stops from high."""
    require(0 < low < high < rate / 2, "resample_eeg_segments:InvalidAntialiasingBand")
    order = math.ceil((stop_db - 7.95) / (2.285 * 2 * math.pi * (high - low) / rate))
    return order + order % 2, 0.1102 * (stop_db - 8.7), (low + high) / rate


def kernel(offset: np.ndarray, order: int, beta: float, cutoff: float, frac: float | np.ndarray = 0.0) -> np.ndarray:
    """Weights at integer offsets from the nearest sample, for a point frac samples past it; they sum to one."""
    half = order / 2
    window = np.i0(beta * np.sqrt(np.maximum(0, 1 - (offset / half) ** 2))) / np.i0(beta)
    w = cutoff * np.sinc(cutoff * (frac - offset)) * window
    return w / w.sum(axis=-1, keepdims=True)


def reflect(index: np.ndarray, n: int) -> np.ndarray:
    """Zero-based indexes folded into [0, n) by reflection at the first and last sample."""
    if n == 1:
        return np.zeros_like(index)
    period = 2 * (n - 1)
    folded = np.mod(index, period)
    return np.where(folded >= n, period - folded, folded)


def resample(x: np.ndarray, step: float, count: int, plan: tuple[int, float, float], first: int = 0) -> np.ndarray:
    """count values of x (channels x samples) at positions (first + k) * step, by blocks."""
    order, beta, cutoff = plan
    taps = np.arange(-(order // 2), order // 2 + 1)
    out = np.empty((*x.shape[:-1], count))
    for a in range(0, count, BLOCK):
        k = np.arange(a, min(a + BLOCK, count))
        position = (first + k) * step
        centre = np.floor(position + 0.5)
        w = kernel(taps, order, beta, cutoff, (position - centre)[:, None])
        at = reflect((centre[:, None] + taps).astype(np.int64), x.shape[-1])
        out[..., k] = np.einsum("...kt,kt->...k", x[..., at], w)
    return out


def butterworth_order(rate: float, stop: float, passing: float, stop_db: float, pass_db: float) -> tuple[int, float]:
    """Order and half-power frequency of a high-pass that just meets its stop loss."""
    warp = lambda f: math.tan(math.pi * f / rate)
    ratio = warp(passing) / warp(stop)
    order = math.ceil(math.log10((10 ** (stop_db / 10) - 1) / (10 ** (pass_db / 10) - 1)) / (2 * math.log10(ratio)))
    w = warp(stop) * (10 ** (stop_db / 10) - 1) ** (1 / (2 * order))
    return order, math.atan(w) * rate / math.pi


def highpass_sections(rate: float, order: int, cutoff: float) -> np.ndarray:
    """Second-order sections (b0 b1 b2 a1 a2) of a Butterworth high-pass, unit gain at the highest frequency."""
    w = math.tan(math.pi * cutoff / rate)
    rows = []
    for k in range((order + 1) // 2):
        if order % 2 and k == 0:
            pole = (1 - w) / (1 + w)
            gain = (1 + pole) / 2
            rows.append([gain, -gain, 0, -pole, 0])
            continue
        m = k - order % 2
        angle = math.pi * (2 * m + 1 + order) / (2 * order)
        s = w / complex(math.cos(angle), math.sin(angle))  # the analogue high-pass pole
        z = (1 + s) / (1 - s)
        a1, a2 = -2 * z.real, abs(z) ** 2
        gain = (1 - a1 + a2) / 4
        rows.append([gain, -2 * gain, gain, a1, a2])
    return np.array(rows)


def _run(x: np.ndarray, sections: np.ndarray, chunk: int = 512) -> np.ndarray:
    """Sections in cascade over the last axis, started as if the first value had always been there.

    Each section's recursion runs chunk by chunk: its impulse response within a chunk is a triangular
    matrix, and the two states carry over, so no loop goes sample by sample.
    """
    lead = x.shape[:-1]
    y = x.reshape(-1, x.shape[-1]).astype(np.float64)
    for b0, b1, b2, a1, a2 in sections:
        n = y.shape[1]
        first = y[:, :1]
        gain = (b0 + b1 + b2) / (1 + a1 + a2)
        # free response of the recursion to its two past outputs, and its impulse response
        h = np.zeros(chunk)
        f1, f2 = np.zeros(chunk), np.zeros(chunk)
        for i in range(chunk):
            h[i] = (1.0 if i == 0 else 0.0) - (a1 * h[i - 1] if i else 0) - (a2 * h[i - 2] if i > 1 else 0)
            f1[i] = -a1 * (f1[i - 1] if i else 1) - a2 * (f1[i - 2] if i > 1 else (1 if i == 1 else 0))
            f2[i] = -a1 * (f2[i - 1] if i else 0) - a2 * (f2[i - 2] if i > 1 else (0 if i == 1 else 1))
        t = np.arange(chunk)
        toeplitz = np.where(t[:, None] >= t, h[np.abs(t[:, None] - t)], 0.0).T
        wide = np.concatenate([first, first, y], axis=1)
        driven = b0 * wide[:, 2:] + b1 * wide[:, 1:-1] + b2 * wide[:, :-2]
        out = np.empty_like(driven)
        p1 = p2 = first[:, 0] * gain
        for a in range(0, n, chunk):
            m = min(chunk, n - a)
            part = driven[:, a : a + m] @ toeplitz[:m, :m] + p1[:, None] * f1[:m] + p2[:, None] * f2[:m]
            out[:, a : a + m] = part
            p1, p2 = part[:, -1], (part[:, -2] if m > 1 else p1)
        y = out
    return y.reshape(*lead, -1)


def highpass(x: np.ndarray, rate: float) -> np.ndarray:
    """Zero-phase high-pass: forward and backward over an odd extension, half the loss in each pass."""
    order, cutoff = butterworth_order(rate, HIGH_STOP, HIGH_PASS, HIGH_STOP_DB / 2, HIGH_PASS_DB / 2)
    sections = highpass_sections(rate, order, cutoff)
    n = x.shape[-1]
    pad = min(n - 1, int(6 * rate / HIGH_STOP))
    wide = np.concatenate([2 * x[..., :1] - x[..., pad:0:-1], x, 2 * x[..., -1:] - x[..., -2 : -pad - 2 : -1]], axis=-1)
    once = _run(wide, sections)[..., ::-1]
    return _run(once, sections)[..., ::-1][..., pad : pad + n]


def highpass_gain(rate: float, frequency: float) -> float:
    """Magnitude of both passes at a frequency."""
    order, cutoff = butterworth_order(rate, HIGH_STOP, HIGH_PASS, HIGH_STOP_DB / 2, HIGH_PASS_DB / 2)
    z = np.exp(-2j * np.pi * frequency / rate)
    h = 1.0
    for b0, b1, b2, a1, a2 in highpass_sections(rate, order, cutoff):
        h *= (b0 + b1 * z + b2 * z * z) / (1 + a1 * z + a2 * z * z)
    return abs(h) ** 2


def welch(x: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and power density in dB: periodic Hamming windows of 4 s at most, half overlapping."""
    n = min(round(4 * rate), len(x))
    window = 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(n) / n)
    size = max(256, 1 << (n - 1).bit_length())
    starts = range(0, len(x) - n + 1, max(1, n - n // 2))
    power = np.mean([np.abs(np.fft.rfft(x[s : s + n] * window, size)) ** 2 for s in starts], axis=0) / (rate * (window**2).sum())
    power[1 : -1 if size % 2 == 0 else None] *= 2
    return np.arange(len(power)) * rate / size, 10 * np.log10(np.maximum(power, np.finfo(float).tiny))


def slepian(n: int, nw: float, k: int) -> np.ndarray:
    """The k first discrete prolate spheroidal sequences of length n."""
    t = np.arange(n)
    m = np.diag(((n - 1 - 2 * t) / 2) ** 2 * math.cos(2 * math.pi * nw / n)) + np.diag(t[1:] * (n - t[1:]) / 2, 1) + np.diag(t[1:] * (n - t[1:]) / 2, -1)
    _, v = np.linalg.eigh(m)
    v = v[:, ::-1][:, :k].T
    flip = np.where(np.arange(k) % 2 == 0, np.sign(v.sum(axis=1)), np.sign(v @ (n - 1 - 2.0 * t)))
    return v * np.where(flip == 0, 1, flip)[:, None]


def multitaper(x: np.ndarray, rate: float, low: float = 0.0, high: float = 40.0, nw: float = 2.0, tapers: int = 3, window: float = 1.0, step: float = 0.05, resolution: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Times, frequencies and dB of the mean tapered spectrum of windows without their mean."""
    n, hop = round(window * rate), math.ceil(step * rate - 1e-9)
    size = 1 << max(1, math.ceil(math.log2(rate / resolution)))
    v = slepian(n, nw, tapers)
    starts = np.arange(0, len(x) - n + 1, hop)
    freq = np.arange(size // 2 + 1) * rate / size
    keep = (freq >= low) & (freq <= high)
    out = np.empty((len(starts), keep.sum()))
    for i, s in enumerate(starts):
        w = x[s : s + n] - x[s : s + n].mean()
        p = (np.abs(np.fft.rfft(v * w, size)) ** 2).mean(axis=0)[keep] / rate
        out[i] = 10 * np.log10(np.maximum(p, np.finfo(float).tiny))
    return (starts + n / 2) / rate, freq[keep], out
