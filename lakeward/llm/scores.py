"""Exact integer scores that a long may not hold.

A score beyond a long's range is reported as the range's end.  A second
column then keeps what is cut off, as a text whose order is that of the
scores, so that ranks stay exact; it is NULL for scores above the least long and up to the largest one.
"""

from __future__ import annotations

LEAST, MOST = -(1 << 63), (1 << 63) - 1
_DIGITS = 7


def as_long(score: int) -> int:
    """The score, or the end of a long's range that it lies beyond."""
    return min(max(score, LEAST), MOST)


def beyond(score: int) -> str | None:
    """What :func:`as_long` cuts off, or None: larger for the larger of two scores with the same long."""
    if LEAST < score <= MOST:
        return None
    excess = score - MOST if score > 0 else LEAST - score
    n = excess.bit_length()
    if score < 0:  # further below is less
        n, excess = 10**_DIGITS - 1 - n, (1 << n) - excess
    return f"{n:0{_DIGITS}d}:{excess:x}" if score > 0 else f"{n:0{_DIGITS}d}:{excess:0{(10**_DIGITS - 1 - n) // 4 + 1}x}"


def restored(score: int, cut_off: str | None) -> int:
    """The exact score."""
    if cut_off is None:
        return score
    n, excess = int(cut_off[:_DIGITS]), int(cut_off[_DIGITS + 1:], 16)
    return MOST + excess if score > 0 else LEAST - ((1 << (10**_DIGITS - 1 - n)) - excess)
