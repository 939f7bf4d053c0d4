"""Inner products of 64-bit integer weights, exact whatever their size."""

from __future__ import annotations

import numpy as np

LOW, HIGH = -(2**63), 2**63 - 1


def reach(queries: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A bound of |q . w| for every query, where |w| is at most ``most`` in each dimension; as double, rounded up."""
    sums = np.abs(queries.astype(np.float64)) @ np.abs(most.astype(np.float64))
    return sums * (1 + 1e-9)


def products(queries: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """queries x weights of inner products of int64 rows, cut to the range of 64 bits.

    Sums that can't leave 53 bits are computed in doubles, those that can't leave 63 in integers, all others in
    Python's integers: the bound is per dimension, |q_d| times the largest |w_d|, added up. Only a score that itself
    lies outside 64 bits is cut.
    """
    if not len(queries) or not len(weights) or not queries.shape[1]:
        return np.zeros((len(queries), len(weights)), np.int64)
    most = np.maximum(weights.max(0).astype(np.float64), -weights.min(0).astype(np.float64))
    bound = reach(queries, most)
    out = np.empty((len(queries), len(weights)), np.int64)
    small, wide = bound < 2.0**53, bound >= 2.0**63 * (1 - 1e-6)
    if small.any():
        out[small] = (queries[small].astype(np.float64) @ weights.T.astype(np.float64)).astype(np.int64)
    middle = ~small & ~wide
    if middle.any():
        out[middle] = queries[middle] @ weights.T
    if wide.any():
        exact = queries[wide].astype(object) @ weights.T.astype(object)
        out[wide] = np.clip(exact, LOW, HIGH).astype(np.int64)
    return out
