"""Signals as numpy arrays, inside Arrow functions: decoding, mixing down, resampling, framing, spectra."""

from __future__ import annotations

import struct

import numpy as np

RATE, CHUNK = 32_000, 160_000
#: Rates above this are damage; a filter for them would be as large as they are.
MOST_RATE = 10_000_000


class BadAudio(ValueError):
    """What isn't a WAV file that can be decoded."""


def wav_header(data: bytes, total: int | None = None) -> dict:
    """format (1 PCM, 3 float), channels, rate, bits, and the place and length of the samples. total: the file's length, if data is only its
    beginning. Whatever isn't such a header raises BadAudio, wherever it was cut."""
    total = len(data) if total is None else total
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise BadAudio("not a RIFF WAVE file")
    at, found = 12, {}
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            if size < 16 or at + 24 > len(data):
                raise BadAudio("a format chunk that is too short")
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            if kind == 0xFFFE and size >= 26 and at + 34 <= len(data):
                kind = struct.unpack_from("<H", data, at + 32)[0]
            found |= {"format": kind, "channels": channels, "rate": rate, "bits": bits}
        elif name == b"data":
            found |= {"start": at + 8, "length": max(0, min(size, total - at - 8))}
            break
        at += 8 + size + (size & 1)
    if "format" not in found or "start" not in found:
        raise BadAudio("no format or no samples")
    if not found["channels"] or not found["rate"] or found["bits"] < 8:
        raise BadAudio("no channels, no rate or no bits")
    return found


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Samples (frames x channels, float32 in -1..1) and rate."""
    h = wav_header(data)
    width = h["bits"] // 8
    raw = data[h["start"] : h["start"] + h["length"] // (width * h["channels"]) * width * h["channels"]]
    if h["format"] == 3 and h["bits"] in (32, 64):
        x = np.frombuffer(raw, f"<f{width}").astype(np.float32)
    elif h["format"] == 1 and h["bits"] == 8:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif h["format"] == 1 and h["bits"] in (16, 32):
        x = (np.frombuffer(raw, f"<i{width}") / float(1 << (h["bits"] - 1))).astype(np.float32)
    elif h["format"] == 1 and h["bits"] == 24:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)).astype(np.float32)
    else:
        raise BadAudio(f"format {h['format']} with {h['bits']} bits")
    return x.reshape(-1, h["channels"]), h["rate"]


def encode_wav(x: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit PCM of samples in -1..1."""
    x = np.atleast_2d(np.asarray(x, np.float64).T).T
    pcm = np.clip(np.round(x * 32767), -32768, 32767).astype("<i2").tobytes()
    ch = x.shape[1]
    return b"RIFF" + struct.pack("<I", 36 + len(pcm)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, ch, rate, rate * ch * 2, ch * 2, 16) + b"data" + struct.pack("<I", len(pcm)) + pcm


def downmix(x: np.ndarray) -> np.ndarray:
    return x.mean(axis=1, dtype=np.float32) if x.ndim > 1 and x.shape[1] > 1 else x.reshape(-1)


def resample(x: np.ndarray, rate: int, to: int = RATE, zeros: int = 32) -> np.ndarray:
    """Band-limited resampling by a Kaiser-windowed sinc, one filter for each phase."""
    if rate == to or not len(x):
        return x.astype(np.float32, copy=False)
    g = np.gcd(rate, to)
    up, down = to // g, rate // g
    n = -(-len(x) * up // down)
    cut = min(1.0, to / rate) * 0.95
    half = int(np.ceil(zeros / cut))
    taps = np.arange(-half, half + 1)
    out = np.empty(n, np.float64)
    padded = np.concatenate([np.zeros(half), x.astype(np.float64), np.zeros(half + 1)])
    for phase in range(min(up, n)):
        at = np.arange(phase, n, up, dtype=np.int64)
        where = at * down
        base, frac = where // up, (where % up) / up
        t = taps - frac[0]
        window = np.i0(8.6 * np.sqrt(np.clip(1 - (t / (half + 1)) ** 2, 0, 1))) / np.i0(8.6)
        kernel = np.sinc(t * cut) * cut * window
        for a in range(0, len(at), 8192):
            rows = base[a : a + 8192, None] + np.arange(2 * half + 1)
            out[at[a : a + 8192]] = padded[np.minimum(rows, len(padded) - 1)] @ kernel
    return out.astype(np.float32)


def load(data: bytes, rate: int = RATE) -> np.ndarray:
    x, own = decode_wav(data)
    if own > MOST_RATE:
        raise BadAudio(f"a rate of {own}")
    return resample(downmix(x), own, rate)


def frames(x: np.ndarray, size: int = CHUNK) -> list[np.ndarray]:
    return [x[i : i + size] for i in range(0, len(x), size)]


def prepared(x: np.ndarray, size: int = CHUNK, always: bool = False, to: float = 0.25) -> np.ndarray:
    """Padded with zeros to size and scaled to a peak of `to`; a silent frame stays as it is unless `always`."""
    out = np.zeros(size, np.float32)
    out[: len(x)] = x[:size]
    top = np.abs(out).max(initial=0.0)
    if top > 1e-10:
        return out / top * np.float32(to)
    return out * np.float32(to) if always else out


def stft_db(x: np.ndarray, n_fft: int = 2048, hop: int = 512, floor: float = 80.0) -> np.ndarray:
    """Decibels below the largest magnitude, bins x frames, of centred Hann frames."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    padded = np.pad(np.asarray(x, np.float64), n_fft // 2)
    n = 1 + (len(padded) - n_fft) // hop
    cut = np.lib.stride_tricks.sliding_window_view(padded, n_fft)[:: hop][:n]
    mag = np.abs(np.fft.rfft(cut * window, axis=1)).T
    top = max(mag.max(initial=0.0), 1e-5)
    db = 20 * np.log10(np.maximum(mag, 1e-5)) - 20 * np.log10(top)
    return np.maximum(db, db.max(initial=-floor) - floor)
