"""Words of text as 64-bit hashes, worked out for many texts at once."""

from __future__ import annotations

import numpy as np

from seriesloom.llm.common import ship

ship(__name__)

PIECE_BYTES = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BYTE_VALUES = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BYTE_VALUES[SPACE] = 0
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash per run of ``values``; ``starts`` begins with 0."""
    place = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
    powers = np.full(int(place.max()) + 1, STEP, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    return mixed(np.add.reduceat(values * powers[place], starts))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of every word, words being runs without ASCII white space."""
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = SPACE[raw]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    return run_hashes(BYTE_VALUES[raw[starts[0] :]], starts - starts[0]), starts


def text_words(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of each text; long ones go through piece by piece, cut at white space."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * len(texts)
    group: list[int] = []
    held = 0

    def flush() -> None:
        if group:
            hashes, starts = word_hashes(b" ".join(texts[i] for i in group))
            cuts = np.searchsorted(starts, np.cumsum([len(texts[i]) + 1 for i in group]))
            for i, a, b in zip(group, [0, *cuts[:-1]], cuts):
                out[i] = hashes[a:b]
            group.clear()

    for i, text in enumerate(texts):
        if len(text) > PIECE_BYTES:
            pieces, at = [], 0
            while at < len(text):
                end = at + PIECE_BYTES
                while end < len(text) and not SPACE[text[end]]:
                    end += 1
                pieces.append(word_hashes(text[at:end])[0])
                at = end
            out[i] = np.concatenate(pieces)
            continue
        if held + len(text) > PIECE_BYTES:
            flush()
            held = 0
        group.append(i)
        held += len(text)
    flush()
    return out
