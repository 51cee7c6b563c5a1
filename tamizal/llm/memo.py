"""A bounded memo for values that are costly to make, kept between the tasks of one Python worker."""

from __future__ import annotations


class Memo:
    """Two generations of entries: when the young one is full it becomes the old one, which is dropped.

    What is in use moves back into the young one, so frequent keys stay and memory is bounded.
    """

    def __init__(self, limit: int = 300_000):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> list:
        """Keys without a value; the values of the others are in the young generation after this."""
        unknown = []
        for key in keys.difference(self.young):
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self.young[key] = value
        return unknown

    def turn(self) -> None:
        """Between batches: begin a new generation if this one is full."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
