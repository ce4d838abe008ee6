"""Adaptive window over errors (Bifet and Gavaldà, SDM 2007)."""

from __future__ import annotations

import math

BUCKETS_PER_ROW = 5
CHECK_EVERY = 32
SMALLEST_SIDE = 5


class AdaptiveWindow:
    """Exponential histogram of the recent errors; shrinks when its two ends disagree.

    ``rows[i]`` holds buckets of ``2**i`` additions as (observations, errors), newest
    first, so memory grows with the logarithm of the window. An addition is one
    observation, or the counts of a whole block.
    """

    def __init__(self, delta: float, rows: list | None = None, ticks: int = 0):
        self.delta = delta
        self.rows = [[tuple(b) for b in row] for row in rows] if rows else [[]]
        self.ticks = ticks
        buckets = [b for row in self.rows for b in row]
        self.width = sum(n for n, _ in buckets)
        self.total = float(sum(errors for _, errors in buckets))

    @property
    def estimate(self) -> float:
        return self.total / self.width if self.width else 0.0

    def add(self, errors: float, count: int = 1) -> bool:
        """Take an observation (or a block of them); true if the window was cut."""
        self.rows[0].insert(0, (count, errors))
        self.width += count
        self.total += errors
        level = 0
        while len(self.rows[level]) > BUCKETS_PER_ROW:
            (n0, s0), (n1, s1) = self.rows[level].pop(), self.rows[level].pop()
            if level + 1 == len(self.rows):
                self.rows.append([])
            level += 1
            self.rows[level].insert(0, (n0 + n1, s0 + s1))
        checked = self.ticks // CHECK_EVERY
        self.ticks += count
        if self.ticks // CHECK_EVERY == checked or self.width <= 2 * SMALLEST_SIDE:
            return False
        changed = False
        while self._ends_disagree():
            self._drop_oldest()
            changed = True
        return changed

    def _ends_disagree(self) -> bool:
        mean = self.estimate
        if not 0.0 < mean < 1.0:
            return False
        log_term = math.log(2 * math.log(self.width) / self.delta)
        n0, s0 = 0, 0.0
        for row in reversed(self.rows):
            for count, errors in reversed(row):
                n0 += count
                s0 += errors
                n1 = self.width - n0
                if n1 < SMALLEST_SIDE:
                    return False
                if n0 < SMALLEST_SIDE:
                    continue
                inverse = 1 / n0 + 1 / n1
                bound = math.sqrt(2 * inverse * mean * (1 - mean) * log_term)
                bound += 2 / 3 * inverse * log_term
                if abs(s0 / n0 - (self.total - s0) / n1) > bound:
                    return True
        return False

    def _drop_oldest(self) -> None:
        count, errors = self.rows[-1].pop()
        self.total -= errors
        self.width -= count
        while len(self.rows) > 1 and not self.rows[-1]:
            self.rows.pop()
