"""Spans of a text that don't overlap."""

from __future__ import annotations

from bisect import bisect_left


class Spans:
    """Takes spans that touch none taken before; each question costs a binary search."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        # of the taken spans that begin before ``end``, the last one also ends last
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def take(self, start: int, end: int) -> bool:
        """Whether the span was free; then it is taken."""
        if not self.free(start, end):
            return False
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True
