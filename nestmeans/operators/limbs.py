"""Exact sums of floating numbers of any spread, whatever the order of adding.

A number is cut at powers of 2**24 into *limbs*: limb ``j`` counts units of ``2**(24 j)`` as a signed integer of at
most 25 bits. Sums of limbs are plain integer sums, so what they stand for is the same for any partitioning and
loses nothing, and one large number does not take the low bits of the others. Limbs of up to 2**38 numbers add up in 64 bits. Data of a narrow range (0/1 vectors, small integers, float32
near one size) need one or two limbs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from nestmeans.operators.kernels import run_starts

BITS = 24
BASE = 1 << BITS
_BLOCK = 1 << 18


def split(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(limb, multiples of 2**(24 limb))`` that add up to the numbers ``x``, highest limb first, as far as any is not zero.

    Adding and taking away 1.5 * 2**52 units rounds to whole units, so every step is exact.
    """
    top = float(np.abs(x).max(initial=0.0))
    rest = x.astype(np.float64, copy=True)
    limb = (int(np.frexp(top)[1]) - 1) // BITS if top else 0
    more = top > 0
    while more:
        far = np.ldexp(1.5, 52 + BITS * limb)
        whole = rest + far
        whole -= far
        rest -= whole
        yield limb, whole
        more = rest.any()
        limb -= 1


def grouped_sums(x: np.ndarray, slot: np.ndarray, slots: int) -> dict[int, np.ndarray]:
    """Per limb the integer sums of the rows of ``x`` that share a slot, as (slots, width)."""
    sums: dict[int, np.ndarray] = {}
    step = max(1, _BLOCK // max(1, x.shape[1]))
    for start in range(0, len(x), step):
        place = slot[start : start + step]
        order = np.argsort(place, kind="stable")
        first = run_starts(place[order])[:-1]
        for limb, part in split(x[start : start + step][order]):
            held = sums.setdefault(limb, np.zeros((slots, x.shape[1]), dtype=np.int64))
            held[place[order][first]] += np.ldexp(np.add.reduceat(part, first, axis=0), -BITS * limb).astype(np.int64)
    return sums


def quotient(sums: dict[int, np.ndarray], divisors: np.ndarray) -> np.ndarray:
    """The sums divided by positive integers below 2**38 (one for each row), rounded once to the nearest double."""
    shape = (len(divisors), next(iter(sums.values())).shape[1]) if sums else (len(divisors), 0)
    if not sums:
        return np.zeros(shape)
    low, high = min(sums), max(sums)
    # 64-bit sums carry into three more limbs; below, the quotient goes on for as long as a double can tell
    places = high - low + 4
    digits = np.zeros((places, *shape), dtype=np.int64)
    for limb, part in sums.items():
        digits[limb - low] = part
    negative = _carried(digits)[-1] < 0
    digits = _carried(np.where(negative, -digits, digits))
    more = 5
    n = divisors.astype(np.int64)[:, None]
    rest = np.zeros(shape, dtype=np.int64)
    out = np.zeros((places + more, *shape), dtype=np.int64)
    for place in range(places - 1, -more - 1, -1):
        rest = (rest << BITS) + (digits[place] if place >= 0 else 0)
        out[place + more], rest = np.divmod(rest, n)
    return _rounded(out, rest > 0, low - more) * np.where(negative, -1.0, 1.0)


def _carried(digits: np.ndarray) -> np.ndarray:
    """The same numbers with all digits but the highest in 0..BASE-1."""
    digits = digits.copy()
    for place in range(len(digits) - 1):
        digits[place + 1] += digits[place] >> BITS
        digits[place] &= BASE - 1
    return digits


def _rounded(digits: np.ndarray, rest: np.ndarray, lowest: int) -> np.ndarray:
    """Numbers given by digits, lowest first, and whether something is left below them; nearest doubles.

    The four highest digits from the first that is not zero hold at least 73 bits: the upper two and the lower two
    are exact doubles, whatever follows is one bit at the end, and their sum is rounded once.
    """
    places = len(digits)
    padded = np.concatenate([np.zeros((3, *digits.shape[1:]), dtype=np.int64), digits])
    lead = places - 1 - (digits[::-1] != 0).argmax(axis=0)  # of zeros the last place, where all digits are 0
    at = lambda back: np.take_along_axis(padded, (lead + 3 - back)[None], axis=0)[0]
    below = np.cumsum(padded != 0, axis=0)
    follows = (lead - 1 >= 0) & (np.take_along_axis(below, np.maximum(lead - 1, 0)[None], axis=0)[0] > 0)
    upper = (at(0) << BITS) + at(1)
    lower = ((at(2) << BITS) + at(3)) | (follows | rest)
    unit = BITS * (lead - 3 + lowest)
    return np.ldexp(np.ldexp(upper.astype(np.float64), 2 * BITS) + lower.astype(np.float64), unit)


def value(parts: dict[int, int]) -> float:
    """The number that summed limbs stand for, rounded once."""
    return float(quotient({limb: np.array([[part]], dtype=np.int64) for limb, part in parts.items()}, np.ones(1))[0, 0]) if parts else 0.0
