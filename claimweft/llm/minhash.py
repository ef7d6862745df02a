"""BagMinHash signatures of weighted sets, many documents at a time (numpy).

Each element carries Poisson processes over dyadic intervals of its weight axis, [0, 1), [1, 2),
[2, 4), ..., with a rate of the interval's length. A point has a time, a signature component and
a place in the interval; an element of weight w owns the points placed below w. A component's
value is the time of its first owned point. Two documents share it with the probability of
their weighted Jaccard similarity, sum(min) / sum(max), since the points depend on the element
only. Points are made in order of time and only up to a horizon by which a document's
components are filled, which long documents reach after a few points; where one stays empty, the
document is done again with twice the horizon, so signatures are exact.
"""

from __future__ import annotations

import numpy as np

from claimweft.llm.grams import mix

U = np.uint64
BANDS, ROWS = 50, 8
COMPONENTS = BANDS * ROWS
_STEP, _OTHER = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
_ARRIVALS = 8


def _processes(owner: np.ndarray, element: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """(owner, seed, length, share): the dyadic intervals of all elements; share of the last one owned."""
    parts = [(owner, mix(element), np.ones(len(owner)), np.ones(len(owner)))]
    level, low = 1, 1
    alive = np.flatnonzero(weight > 1)
    while len(alive):
        share = np.minimum(1.0, (weight[alive] - low) / low)
        parts.append((owner[alive], mix(element[alive] ^ U(level * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)), np.full(len(alive), float(low)), share))
        low *= 2
        level += 1
        alive = alive[weight[alive] > low]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _fill(n: int, owner: np.ndarray, seed: np.ndarray, length: np.ndarray, share: np.ndarray, horizon: np.ndarray) -> np.ndarray:
    first = np.full(n * COMPONENTS, np.inf)
    time = np.zeros(len(owner))
    count, block = 0, 1
    while len(owner):
        steps = np.arange(count + 1, count + block + 1, dtype=np.uint64) * _STEP
        x = mix(seed[:, None] + steps[None, :])
        gaps = -np.log(((x >> U(11)).astype(float) + 0.5) * 2.0**-53) / length[:, None]
        at = time[:, None] + np.cumsum(gaps, axis=1)
        y = mix(x ^ _OTHER)
        place = (y & U(0xFFFFFFFF)).astype(float) * 2.0**-32
        row, col = np.nonzero((at < horizon[owner][:, None]) & (place < share[:, None]))
        component = ((y[row, col] >> U(32)) * U(COMPONENTS)) >> U(32)
        np.minimum.at(first, owner[row] * COMPONENTS + component.astype(np.int64), at[row, col])
        time = at[:, -1]
        alive = time < horizon[owner]
        owner, seed, length, share, time = owner[alive], seed[alive], length[alive], share[alive], time[alive]
        count, block = count + block, _ARRIVALS
    return first.reshape(n, COMPONENTS)


def signatures(n: int, owner: np.ndarray, element: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(n, COMPONENTS) times; ``owner`` says whose of n documents an element is. No element: infinite."""
    total = np.bincount(owner, weights=weight, minlength=n)
    horizon = COMPONENTS * (np.log(COMPONENTS) + 4.0) / np.maximum(total, 1.0)
    parts = _processes(owner, element, weight)
    out = np.full((n, COMPONENTS), np.inf)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        slot = np.full(n, -1)
        slot[todo] = np.arange(len(todo))
        chosen = slot[parts[0]] >= 0
        out[todo] = _fill(len(todo), slot[parts[0][chosen]], *[p[chosen] for p in parts[1:]], horizon[todo])
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        horizon[todo] *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(n, BANDS) long: equal where all rows of the band are."""
    bits = signature.view(U).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U) * _STEP, bits.shape[:2])
    for r in range(ROWS):
        key = mix(key ^ bits[:, :, r])
    return key.view(np.int64)
