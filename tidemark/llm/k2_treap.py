"""A tile of the term-document grid as K2-treap: a compressed quadtree with impact maxima.

Rows are the tile's terms, columns its documents. Rows are cut into squares as wide as the tile;
every square with a point is the root of a quadtree. Of a cell, the tree keeps four bits, which
say what quarters have points, and how far the largest impact of each such quarter lies below the
cell's own. Quarters of a level are stored one after the other, so that ranks of bits lead from a
cell to its quarters. Frequent terms come first among rows and documents go by length, which puts
like impacts side by side.

A search takes the row paths of a query's terms down together over ranges of documents. The
bound of a range is the weighted sum of the maxima of the cells that the paths are in; ranges are
opened in descending order of their bounds, up to ``BLOCK`` of one level at a time, and none whose
bound is below the k-th score found so far.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np

#: Ranges that are opened together, at most.
BLOCK = 256

_BITS = np.array([bin(i).count("1") for i in range(16)], np.uint8)
#: Of a cell's four bits, how many lie below each quarter.
_BELOW = np.array([[_BITS[mask & ((1 << q) - 1)] for q in range(4)] for mask in range(16)], np.uint8)


def _spread(values: np.ndarray) -> np.ndarray:
    """The low 16 bits of each value with a zero bit before every one."""
    x = values.astype(np.int64)
    for shift, keep in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x | (x << shift)) & keep
    return x


class Treap:
    """The quadtrees of a tile.

    ``terms`` are sorted, ``row_of`` their rows and ``frequency`` their numbers of documents.
    ``masks[d]`` has the quarters of the cells of depth d, ``maxima[d]`` their largest impacts.
    """

    def __init__(self, terms, row_of, frequency, bits, masks, maxima):
        self.terms, self.row_of, self.frequency, self.bits = terms, row_of, frequency, bits
        self.masks, self.maxima = masks, maxima
        self.first = [np.concatenate([[0], np.cumsum(_BITS[m], dtype=np.int32)[:-1]]).astype(np.int32)
                      if len(m) else np.zeros(0, np.int32) for m in masks]

    @classmethod
    def build(cls, terms: np.ndarray, columns: np.ndarray, impacts: np.ndarray, width: int) -> "Treap":
        """From points: a term, a column below ``width`` and a positive impact each."""
        bits = max(1, (max(width, 1) - 1).bit_length())
        names, found, frequency = np.unique(terms, return_inverse=True, return_counts=True)
        row_of = np.empty(len(names), np.int32)
        row_of[np.argsort(-frequency, kind="stable")] = np.arange(len(names), dtype=np.int32)
        rows = row_of[found]
        low = (1 << bits) - 1
        code = ((rows >> bits).astype(np.int64) << (2 * bits)) | (_spread(rows & low) << 1) | _spread(columns)
        order = np.argsort(code)
        code, top = code[order], impacts[order].astype(np.int64)
        masks, maxima = [], [top]
        for _ in range(bits):
            parent = code >> 2
            starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            if not len(code):
                starts = np.zeros(0, np.int64)
            bit = (1 << (code & 3)).astype(np.uint8)
            masks.append(np.bitwise_or.reduceat(bit, starts) if len(starts) else bit)
            top = np.maximum.reduceat(top, starts) if len(starts) else top
            maxima.append(top)
            code = parent[starts]
        return cls(names, row_of, frequency.astype(np.int32), bits, masks[::-1], maxima[::-1])

    def dump(self) -> dict:
        """Plain fields for storage: the maxima as differences to those of the cells above."""
        steps = [self.maxima[0].astype(np.int32)]
        for d, mask in enumerate(self.masks):
            steps.append((np.repeat(self.maxima[d], _BITS[mask]) - self.maxima[d + 1]).astype(np.int32))
        return {"terms": self.terms.view(np.int64), "row_of": self.row_of, "frequency": self.frequency,
                "bits": self.bits, "cells": [len(m) for m in self.masks],
                "masks": np.concatenate(self.masks).tobytes(), "steps": np.concatenate(steps)}

    @classmethod
    def load(cls, terms, row_of, frequency, bits, cells, masks, steps) -> "Treap":
        flat, masks_of, at = np.frombuffer(masks, np.uint8), [], 0
        for n in cells:
            masks_of.append(flat[at:at + n])
            at += n
        at = cells[0]
        maxima = [steps[:at].astype(np.int64)]
        for mask in masks_of:
            above = np.repeat(maxima[-1], _BITS[mask])
            maxima.append(above - steps[at:at + len(above)])
            at += len(above)
        return cls(terms.view(np.uint64), row_of, frequency, bits, masks_of, maxima)

    def places(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in ``self.terms`` of those of ``terms`` that the tile has, and where they are."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        has = np.flatnonzero(self.terms[at] == terms) if len(self.terms) else np.zeros(0, np.int64)
        return at[has], has

    def search(self, terms: np.ndarray, weights: np.ndarray, least: Callable[[], int]
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Columns and their weighted sums of impacts, best first by blocks. What is below
        ``least()`` at the time, or not above 0, is left out."""
        own, has = self.places(terms)
        if not len(own):
            return
        rows, weights = self.row_of[own], weights[has]
        cells = (rows >> self.bits)[None, :].astype(np.int32)
        bounds = self.maxima[0][cells] @ weights
        heap = [(-int(bounds[0]), 0, 0, np.zeros(1, np.int64), cells, bounds)]
        made = 0
        while heap and -heap[0][0] >= least():
            _, minus_depth, _, ranges, cells, bounds = heapq.heappop(heap)
            good = bounds >= least()
            ranges, cells, bounds = self._open(-minus_depth, ranges[good], cells[good], rows, weights)
            good = bounds >= max(least(), 1)
            ranges, cells, bounds = ranges[good], cells[good], bounds[good]
            if not len(ranges):
                continue
            if 1 - minus_depth == self.bits:
                yield ranges, bounds
                continue
            order = np.argsort(-bounds, kind="stable")
            for at in range(0, len(order), BLOCK):
                part = order[at:at + BLOCK]
                made += 1
                heapq.heappush(heap, (-int(bounds[part[0]]), minus_depth - 1, made, ranges[part],
                                      cells[part], bounds[part]))

    def _open(self, depth: int, ranges: np.ndarray, cells: np.ndarray, rows: np.ndarray,
              weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both halves of every range, with the cells of the row paths (-1: no point) and bounds."""
        mask = np.where(cells >= 0, self.masks[depth][cells], 0)
        first = self.first[depth][cells]
        below_row = ((rows >> (self.bits - 1 - depth)) & 1) << 1
        halves, maxima = [], self.maxima[depth + 1]
        for side in (0, 1):
            quarter = below_row | side
            has = (mask >> quarter) & 1 > 0
            child = np.where(has, first + _BELOW[mask, quarter], -1).astype(np.int32)
            bound = np.where(has, maxima[child], 0) @ weights
            halves.append((ranges * 2 + side, child, bound))
        return tuple(np.concatenate(parts) for parts in zip(*halves))
