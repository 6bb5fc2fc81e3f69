"""Texts as sets of word shingles: min-hash bands, which find candidates, and exact Jaccard similarities, which decide.

A text is the set of hashes of its ``shingle``-word runs, lower-cased. Sets that agree in all ``ROWS`` min-hashes of one of
``BANDS`` bands meet; a pair of similarity s is missed by all bands with probability (1 - s**5)**32, 3e-6 at 0.8 and less above.
Of those that meet, sets are candidates if their signatures (a byte of each min-hash) agree in about as many places as sets of
the wanted similarity do: ``DEVIATIONS`` standard deviations fewer are allowed, which leaves out less than 1e-6 of them.
"""

from __future__ import annotations

import numpy as np

from talus.llm.common import Rolling, hashed, mix, split_words

SHINGLE, LEAST, BANDS, ROWS, DEVIATIONS = 5, 0.8, 32, 5, 5.5
_STEP, _VOCABULARY = 1 << 10, 1 << 12
_roll = Rolling(0xA0761D6478BD642F)
_keys = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _TIMES = _keys[: BANDS * ROWS, None], _keys[BANDS * ROWS :, None] | np.uint64(1)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes in order; fewer words than a shingle are one shingle, no words are the shingle 0."""
    h = hashed(split_words(text and text.lower()))
    return np.unique(_roll(h, min(shingle, len(h)))) if len(h) else np.zeros(1, np.uint64)


def node_of(x: np.ndarray) -> np.uint64:
    """One number for a whole set."""
    return mix(mix(x).sum() + np.uint64(len(x)))


def minima(x: np.ndarray) -> np.ndarray:
    """The min-hashes of a set; their low bytes are its signature."""
    return np.min([((x[None, at : at + _STEP] ^ _XOR) * _TIMES).min(axis=1) for at in range(0, len(x), _STEP)], axis=0)


def bands(low: np.ndarray) -> np.ndarray:
    """A hash of each band's min-hashes."""
    out = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def resembling(signs: np.ndarray, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of signatures (rows) that may be of similar sets connect.

    Each row joins the first leader that it agrees with; then members are compared with the groups that theirs isn't yet connected
    with. Copies of one text thus cost a comparison each, not one for each pair.
    """
    places = signs.shape[1]
    limit = int(places * least - DEVIATIONS * (places * least * (1 - least)) ** 0.5)
    alike = lambda rows, x: (signs[rows] == signs[x]).sum(axis=1) >= limit
    i, j, groups, rest = [], [], [], np.arange(len(signs))
    while len(rest):
        near = alike(rest, rest[0])
        groups.append(rest[near])
        rest = rest[~near]
    for group in groups:
        i += [group[0]] * (len(group) - 1)
        j += group[1:].tolist()
    at, of = np.concatenate(groups), np.repeat(np.arange(len(groups)), list(map(len, groups)))
    root = np.arange(len(groups))
    for g, group in enumerate(groups):
        others, owner = at[of > g], of[of > g]
        for x in group[1:]:
            apart = root[owner] != root[g]
            others, owner = others[apart], owner[apart]
            if not len(others):
                break
            for y in np.flatnonzero(alike(others, x)):
                if root[owner[y]] != root[g]:
                    i.append(x), j.append(others[y])
                    root[root == root[owner[y]]] = root[g]
    return np.array(i, np.int64), np.array(j, np.int64)


def similar(sets: list[np.ndarray], least: float = LEAST, across: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links i < j between sets of similarity least or more; with across, only from the first so many sets to the others."""
    size = np.array(list(map(len, sets)))
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = count[token] > 1
    place = np.cumsum(count > 1) - 1
    token, owner = place[token[shared]], owner[shared]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    a = across or len(sets)
    both = np.zeros((a, len(sets) - across), np.float32)  # sizes are far below 2**24, so sums are exact
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, _VOCABULARY):
        i, j = np.searchsorted(token, [lo, lo + _VOCABULARY])
        has = np.zeros((len(sets), min(_VOCABULARY, int(token[-1]) + 1 - lo)), np.float32)
        has[owner[i:j], token[i:j] - lo] = 1
        both += has[:a] @ has[across:].T
    # both / union >= least, as union = sizes - both
    i, j = np.nonzero(both.astype(np.float64) * (1 + least) >= least * (size[:a, None] + size[None, across:]) - 1e-6)
    j = j + across
    return i[i < j], j[i < j]
