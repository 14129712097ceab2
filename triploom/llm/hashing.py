"""64-bit hashes of words and word windows of many texts at once, with numpy.

Used inside tasks by the operators that are free to run Python there. All
arithmetic is modulo 2**64 and depends on nothing but the bytes, so hashes
agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEP = _U(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=_U) * _STEP)   # a random number per byte value
_BASE = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.ones(1, _U)


def _powers(n: int) -> np.ndarray:
    """_BASE to the powers 0 to n - 1."""
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * (_POWERS[-1:] * _BASE)])
    return _POWERS[:n]


def _chunk(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts that together fit a chunk, and words per text."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, _U), np.zeros(len(texts), np.int64)
    lengths = ends - starts
    letters = raw[inside]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    value = _BYTE[letters] * _powers(int(lengths.max()))[place]
    words = mix(np.add.reduceat(value, first) + lengths.astype(_U) * _STEP)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return words, np.diff(np.searchsorted(starts, bounds))


def word_hashes(texts: list[str | bytes | None], lower: bool) -> Iterator[np.ndarray]:
    """Per text, the hashes of its words (runs without ASCII white space),
    with A-Z in lower case if ``lower``. Works through chunks of about
    ``CHUNK_BYTES``; a longer text is a chunk of its own."""
    batch: list[bytes] = []
    size = 0

    def done() -> Iterator[np.ndarray]:
        words, counts = _chunk(batch)
        yield from np.split(words, np.cumsum(counts)[:-1])

    for t in texts:
        raw = t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")
        raw = raw.lower() if lower else raw   # bytes: A-Z only
        if batch and size + len(raw) > CHUNK_BYTES:
            yield from done()
            batch, size = [], 0
        batch.append(raw)
        size += len(raw)
    if batch:
        yield from done()


def flat_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts in one array, and the number of
    words of each text. For many short texts; works through chunks."""
    sizes = np.cumsum(np.fromiter((len(t) for t in texts), np.int64, len(texts)))
    edges = np.searchsorted(sizes, np.arange(CHUNK_BYTES, int(sizes[-1]) if len(texts) else 0,
                                             CHUNK_BYTES))
    parts = [_chunk(texts[a:b]) for a, b in zip([0, *edges], [*edges, len(texts)]) if a < b]
    return (np.concatenate([np.empty(0, _U), *[p[0] for p in parts]]),
            np.concatenate([np.empty(0, np.int64), *[p[1] for p in parts]]))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per window of ``size`` words, in order; none for fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    total = np.full(n, size, _U)
    for k in range(size):
        total = total * _BASE + words[k:k + n]
        total ^= total >> _U(29)
    return mix(total)
