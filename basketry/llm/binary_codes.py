"""Binary codes of unit vectors after a random rotation, with correction factors.

A unit vector o is padded to a multiple of 64 dimensions and rotated; its code is the signs of
the rotated entries, ō = ±1/sqrt(D), and the stored factor is f = <ō, o>.  For another unit
vector q, <ō, q> / f is an unbiased estimate of <o, q>, whose error spreads like
sqrt(1 - f²) / f * sqrt(1 - <o, q>²) / sqrt(D - 1).  q travels rotated too, in six bits an entry with a
subtracted dither, so that the estimate is a sum of popcounts.

A pair may have a cosine of ``least`` or more only if both estimates (each vector's code against
the other's entries) reach ``least`` less ``CONFIDENCE`` spreads.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Standard deviations of the confidence bound: a pair is misjudged with a probability of 1e-9.
CONFIDENCE = 6.0
#: Bits of a quantised entry.
PLANES = 6


@lru_cache(maxsize=32)
def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same arguments."""
    rng = np.random.default_rng([dimension, seed])
    q, r = np.linalg.qr(rng.standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=32)
def _dither(dimension: int) -> np.ndarray:
    return np.random.default_rng([dimension, 1 << 20]).random(dimension)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (none is zero), padded to a multiple of 64 dimensions."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
    return np.pad(scaled, ((0, 0), (0, -vectors.shape[1] % 64)))


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """Of each vector: signs (n x words), f, the sums of signs and of dithered signs; the six
    bit planes of its rotated entries (n x planes x words), their least, step and sum."""

    signs: np.ndarray
    factor: np.ndarray
    total: np.ndarray
    shift: np.ndarray
    planes: np.ndarray
    low: np.ndarray
    step: np.ndarray
    level: np.ndarray

    def pick(self, rows) -> Codes:
        return Codes(*(getattr(self, f)[rows] for f in self.__dataclass_fields__))

    def pack(self) -> list[bytes]:
        """One binary a vector."""
        parts = [self.signs.view(np.uint8).reshape(len(self.signs), -1), self.planes.reshape(len(self.signs), -1).view(np.uint8)]
        numbers = np.stack([self.factor, self.total, self.shift, self.low, self.step, self.level], axis=1)
        whole = np.concatenate([*parts, np.ascontiguousarray(numbers).view(np.uint8)], axis=1)
        return [row.tobytes() for row in whole]


def unpack(rows: list[bytes]) -> Codes:
    whole = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    words = (whole.shape[1] // 8 - 6) // (1 + PLANES)
    data = np.ascontiguousarray(whole).view(np.uint64)
    numbers = np.ascontiguousarray(data[:, -6:]).view(np.float64)
    return Codes(data[:, :words], numbers[:, 0], numbers[:, 1], numbers[:, 2], data[:, words:-6].reshape(len(rows), PLANES, words),
                 numbers[:, 3], numbers[:, 4], numbers[:, 5])


def encode(units: np.ndarray) -> Codes:
    """Codes of unit vectors (padded)."""
    d = units.shape[1]
    turned = units @ rotation(d, 0)
    up = turned >= 0
    sign = np.where(up, 1.0, -1.0)
    low, high = turned.min(axis=1), turned.max(axis=1)
    step = np.maximum((high - low) / ((1 << PLANES) - 1), 1e-300)
    level = np.clip(np.floor((turned - low[:, None]) / step[:, None] + _dither(d)), 0, (1 << PLANES) - 1).astype(np.uint8)
    planes = np.stack([_words(level >> k & 1) for k in range(PLANES)], axis=1)
    return Codes(_words(up), np.abs(turned).sum(axis=1) / np.sqrt(d), sign.sum(axis=1), sign @ (0.5 - _dither(d)), planes, low, step,
                 level.sum(axis=1).astype(float))


def estimates(a: Codes, b: Codes) -> np.ndarray:
    """Unbiased estimates of the inner products, from a's codes and b's entries."""
    words = a.signs.shape[1]
    agree = np.zeros((len(a.signs), len(b.signs)))
    for k in range(PLANES):
        for w in range(words):
            agree += np.bitwise_count(a.signs[:, None, w] & b.planes[None, :, k, w]) * float(1 << k)
    inner = b.low * a.total[:, None] + b.step * (2.0 * agree - b.level + a.shift[:, None])
    return inner / (np.sqrt(64.0 * words) * a.factor[:, None])


def spread(a: Codes, b: Codes, least: float) -> np.ndarray:
    """The standard deviation of an estimate at an inner product of ``least``."""
    d = 64 * a.signs.shape[1]
    turn = np.sqrt(np.maximum(0.0, 1 - a.factor**2)) / a.factor * np.sqrt((1 - least**2) / (d - 1))
    return np.hypot(turn[:, None], (b.step / np.sqrt(12.0)) / a.factor[:, None])


def possible(a: Codes, b: Codes, least: float) -> np.ndarray:
    """The pairs whose inner product may be ``least`` or more, by both estimates' bounds."""
    one = estimates(a, b) >= least - CONFIDENCE * spread(a, b, least)
    return one & (estimates(b, a) >= least - CONFIDENCE * spread(b, a, least)).T


def side_bits(units: np.ndarray, count: int) -> np.ndarray:
    """``count`` sign bits of each vector under further rotations, for bands of candidates."""
    d = units.shape[1]
    return np.concatenate([units @ rotation(d, 1 + k) >= 0 for k in range(-(-count // d))], axis=1)[:, :count]
