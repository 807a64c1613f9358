"""Words and shingles of whole texts as hash arrays, for the near-duplicate operators."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

WIDTH = 5
_WORD = re.compile(r"\w+")
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Hashes(dict):
    """Word hashes seen lately; bounded."""

    LIMIT = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()
#: UTF-8 bytes of words; whether a longer character belongs to one is seen from the distinct words
_IN_WORD = np.array([i >= 128 or chr(i).isalnum() or i == ord("_") for i in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(text: str) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def batch_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of all texts, one after the other, and where each ends; every distinct word is hashed once."""
    encoded = [t.lower().encode() for t in texts]
    raw = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    inside = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    text_ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in encoded]))
    offsets = np.append(0, np.cumsum(stops - starts))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    words = words.dictionary_encode()
    code, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False)
    values = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    # characters that are no letters, such as dashes and quotes, part or remove words
    parts = {i: _WORD.findall(w.decode()) for i, w in enumerate(distinct) if not w.isascii()}
    parts = {i: part for i, part in parts.items() if part != [distinct[i].decode()]}
    if not parts:
        return values[code], text_ends
    count = np.ones(len(distinct), np.int64)
    count[list(parts)] = [len(x) for x in parts.values()]
    first = np.cumsum(count) - count
    flat = np.empty(count.sum(), np.uint64)
    flat[first[count > 0]] = values[count > 0]
    for i, part in parts.items():
        flat[first[i] : first[i] + len(part)] = [xxhash.xxh3_64_intdigest(x) for x in part]
    size = count[code]
    ends = np.append(0, np.cumsum(size))
    place = np.repeat(first[code] - ends[:-1], size) + np.arange(ends[-1])
    return flat[place], ends[text_ends]


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """One hash per run of five words; a shorter text is one shingle of all its words, an empty one none."""
    if not len(words):
        return words
    if len(words) < WIDTH:
        words = np.concatenate([words, np.zeros(WIDTH - len(words), np.uint64)])
    n = len(words) - WIDTH + 1
    total = words[:n] * _STEPS[0]
    for i in range(1, WIDTH):
        total += words[i : i + n] * _STEPS[i]
    return mixed(total)
