"""Hashes of word shingles inside a task, by numpy: words are letters and digits, lower-cased."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import xxhash

WORDS = re.compile(r"\w+")
KNOWN = 500_000  # words whose hash a worker remembers
SHORT = 32       # longer words, in bytes, are hashed one by one


class _Hashes(dict):
    def __missing__(self, word):
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()
_P1, _P2, _P3, _P4, _P5 = (np.uint64(int(x)) for x in (  # fixed values of XXH64
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_STEP, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def hashed(tokens: list[str]) -> np.ndarray:
    if len(_HASHES) > KNOWN:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))


def shingles(tokens: list[str], size: int = 5) -> np.ndarray:
    """Hash of each run of `size` words; fewer words are one shingle, none are no shingle."""
    if not tokens:
        return np.zeros(0, np.uint64)
    h = hashed(tokens)
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(size, len(h)), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(size, len(h))):
            out = (out * _STEP) + h[i:i + n]
            out ^= out >> np.uint64(29)
    return mixed(out)


@cache
def _word_characters(most: int) -> np.ndarray:
    out = np.zeros(most, bool)
    for run in WORDS.finditer(np.arange(most, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")):
        out[run.start():run.end()] = True
    return out


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 (fixed by its specification, seed 0) of each slice of `data`."""
    octets = np.frombuffer(data + bytes(8), np.uint8)
    lanes = np.ndarray((len(data) + 1,), "<u8", octets, strides=(1,))
    with np.errstate(over="ignore"):
        h = _P5 + sizes.astype(np.uint64)
        for lane in range(SHORT // 8 - 1):
            rows = np.flatnonzero((sizes >= 8 * lane + 8) & (sizes < SHORT))
            h[rows] = _turned(h[rows] ^ (_turned(lanes[starts[rows] + 8 * lane] * _P2, 31) * _P1), 27) * _P1 + _P4
        rows = np.flatnonzero(sizes & 4)
        h[rows] = _turned(h[rows] ^ ((lanes[starts[rows] + (sizes[rows] & -8)] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        for k in range(3):
            rows = np.flatnonzero((sizes & 3) > k)
            h[rows] = _turned(h[rows] ^ (octets[starts[rows] + (sizes[rows] & -4) + k] * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(sizes >= SHORT):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + sizes[i]])
    return h


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and the number of each text's: hashed(words(x)) of each, at once."""
    lower = [x.lower() if x else "" for x in texts]
    plain = np.fromiter((x.isascii() for x in lower), bool, len(lower))
    parts = []
    for rows in (np.flatnonzero(plain), np.flatnonzero(~plain)):
        some = [lower[i] for i in rows]
        joined = "\n" + "\n".join(some) + "\n"
        data = joined.encode()
        if len(joined) == len(data):
            codes, places = np.frombuffer(data, np.uint8), None
            inside = _word_characters(128)[codes]
        else:
            codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            places = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF))])
            inside = _word_characters(0x110000)[codes]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        ends = np.cumsum([1, *[len(x) + 1 for x in some]])
        counts = np.diff(np.searchsorted(edges[::2], ends))
        at = edges if places is None else places[edges]
        parts.append((rows, counts, xxh64(data, at[::2], at[1::2] - at[::2])))
    counts = np.zeros(len(texts), np.int64)
    for rows, n, _ in parts:
        counts[rows] = n
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    for rows, n, found in parts:
        out[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(len(found))] = found
    return out, counts


def runs_of(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """The shingle of `size` words that begins at each word but the last ones."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = (out * _STEP) + hashes[i:i + n]
            out ^= out >> np.uint64(29)
    return mixed(out)


def simhash(rows: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each row of a matrix of shingle hashes; a bit is set if it is in over half of the row."""
    if not rows.size:
        return np.zeros(len(rows), np.uint64)
    out = np.empty(len(rows), np.uint64)
    step = max(1, (1 << 20) // rows.shape[1])
    for at in range(0, len(rows), step):
        part = rows[at:at + step]
        octets = part.astype(">u8").view(np.uint8).reshape(len(part), part.shape[1], 8)
        counts = np.unpackbits(octets, axis=2).sum(axis=1, dtype=np.int32)
        out[at:at + step] = np.packbits(2 * counts > part.shape[1], axis=1).view(">u8").ravel()
    return out
