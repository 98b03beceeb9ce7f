"""Nearest unit vectors, exactly, with few of the multiplications.

Vectors are rotated so that the first few dimensions hold most of their length. The rest of
a dot product is at most the product of the two rest lengths (Cauchy-Schwarz), so most
pairs are ruled out after those dimensions; only the others are multiplied in full.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

#: Share of the squared length that the leading dimensions should hold.
LEADING_SHARE = 0.8
#: What the bound in single precision is widened by.
SLACK = 1e-4
# Pairs that are bounded and multiplied at once, so that memory does not grow with either side.
ROWS_AT_ONCE = 1024
LISTED_AT_ONCE = 4096
PAIRS_AT_ONCE = 1 << 14
# Where more than one pair in so many is likely, all are multiplied in single precision, and
# only those near the best of a row in full.
LIKELY_ENOUGH = 64


def unit_rows(vectors: pd.Series) -> np.ndarray:
    rows = np.vstack(vectors.to_numpy()).astype("float64")
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@dataclass(frozen=True)
class Turn:
    """A rotation (columns by falling share of the length) and how many dimensions lead."""

    matrix: np.ndarray
    lead: int

    @classmethod
    def of(cls, sample: np.ndarray) -> Turn:
        """From the second moments of some unit rows; any rotation is right, a good one is quick."""
        power, matrix = np.linalg.eigh(sample.T @ sample)
        order = np.argsort(-power)
        share = np.cumsum(power[order]) / power.sum()
        lead = min(int(np.searchsorted(share, LEADING_SHARE)) + 1, max(1, sample.shape[1] // 2))
        return cls(matrix[:, order], lead)

    def led(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading dimensions, length of the rest) in single precision."""
        first = rows @ self.matrix[:, : self.lead]
        rest = np.sqrt(np.maximum(0.0, 1.0 - (first * first).sum(axis=1)))
        return first.astype("float32"), rest.astype("float32")


@dataclass
class Listed:
    """Unit rows to be found, in the order in which ties go."""

    rows: np.ndarray
    turn: Turn

    def __post_init__(self) -> None:
        self.first, self.rest = self.turn.led(self.rows)
        self.single = self.rows.astype("float32")

    def best(self, asked: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest row or -1 if none reaches the threshold, cosine to nine digits)."""
        place, cosine = np.full(len(asked), -1), np.full(len(asked), -np.inf)
        for start in range(0, len(asked), ROWS_AT_ONCE):
            part, at = asked[start : start + ROWS_AT_ONCE], slice(start, start + ROWS_AT_ONCE)
            first, rest = self.turn.led(part)
            single = part.astype("float32")
            bounds_help = True
            for low in range(0, len(self.rows), LISTED_AT_ONCE):
                some = slice(low, low + LISTED_AT_ONCE)
                if bounds_help:
                    bound = first @ self.first[some].T
                    bound += rest[:, None] * self.rest[some]
                    likely = bound >= threshold - SLACK
                    bounds_help = np.count_nonzero(likely) * LIKELY_ENOUGH <= likely.size
                if not bounds_help:
                    near = single @ self.single[some].T
                    least = np.maximum(near.max(axis=1), np.maximum(threshold, cosine[at])) - SLACK
                    likely = near >= least[:, None].astype("float32")
                here, found = _nearest_of(part, self.rows[some], likely)
                ahead = found > cosine[at]  # a tie stays with the row listed earlier
                place[at][ahead], cosine[at][ahead] = low + here[ahead], found[ahead]
        place[cosine < threshold] = -1
        return place, cosine


def _nearest_of(part: np.ndarray, rows: np.ndarray, likely: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest of the likely rows, cosine to nine digits), -inf where there is none."""
    place, cosine = np.full(len(part), -1), np.full(len(part), -np.inf)
    row, column = np.divmod(np.flatnonzero(likely), likely.shape[1])
    exact = np.empty(len(row))
    for low in range(0, len(row), PAIRS_AT_ONCE):
        pairs = slice(low, low + PAIRS_AT_ONCE)
        exact[pairs] = np.einsum("ij,ij->i", part[row[pairs]], rows[column[pairs]])
    exact = np.round(exact, 9)
    if len(row):
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        top = np.maximum.reduceat(exact, starts)
        first = np.where(exact == np.repeat(top, np.diff(np.append(starts, len(row)))), np.arange(len(row)), len(row))
        ahead = np.minimum.reduceat(first, starts)
        held = ahead < len(row)
        place[row[starts[held]]], cosine[row[starts[held]]] = column[ahead[held]], top[held]
    return place, cosine
