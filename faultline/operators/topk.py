"""Exact nearest-neighbour scoring of one tile of probes against one tile of corpus vectors.

Runs inside tasks. A single-precision matrix product finds the candidates (everything within its
rounding bound of the k-th best), and only those are scored again in double precision, each pair on
its own, so a score never depends on how rows were laid out over tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CELLS_AT_ONCE = 16_000_000  # entries of one score matrix held in memory: 64 MB, enough probes for a fast product
GROUP = 64  # columns of a score matrix that are first looked at through their maximum


def to_matrix(vectors: pa.Array) -> np.ndarray:
    """Arrow list column without NULL rows -> float32 matrix; unequal widths are an error."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten()
    if flat.null_count:
        raise ValueError("vector holds a NULL element")
    rows = len(vectors)
    widths = np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False)) if rows else []
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths in one search: {list(map(int, widths))}")
    width = int(widths[0]) if rows else 0
    return flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(rows, width)


def groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows: (first occurrence of each distinct row, number of its group for every row)."""
    rows = np.ascontiguousarray(rows + np.float32(0))  # -0.0 and 0.0 are one value
    as_bytes = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
    _, first, owner = np.unique(as_bytes, return_index=True, return_inverse=True)
    return first, owner


def pack(ids: np.ndarray, vectors: np.ndarray, metric: str, k: int) -> dict:
    """Corpus side of a tile.

    Ties go to the smaller id, so of equal vectors only the k smallest ids can ever be hits: each
    distinct vector is kept once, with those ids. However many copies there are, none is lost that
    could have been returned.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    if len(vectors):
        usable = np.isfinite(vectors).all(axis=1)
        if metric == "COSINE":
            usable &= np.any(vectors != 0, axis=1)  # a zero vector has no direction, hence no score
        ids, vectors = ids[usable], vectors[usable]
    if len(vectors):
        first, owner = groups(vectors)
        by_owner = np.argsort(owner, kind="stable")
        starts = np.searchsorted(owner[by_owner], np.arange(len(first)))
        nth = np.arange(len(owner)) - starts[owner[by_owner]]
        kept = by_owner[nth < k]
        distinct, counts = vectors[first], np.bincount(owner[kept], minlength=len(first))
    else:
        kept, distinct, counts = np.arange(0), vectors, np.zeros(0, dtype=np.int64)
    norms = np.sqrt((distinct.astype(np.float64) ** 2).sum(axis=1))
    return {
        "ids": ids, "copies": kept, "counts": counts, "offsets": np.cumsum(counts) - counts,
        "vectors": distinct, "norms": norms,
    }


def search_distinct(tile: dict, probes: np.ndarray, metric: str, k: int):
    """``search``, with equal probes searched once and their hits repeated."""
    if not len(probes) or not probes.shape[1]:
        return search(tile, probes, metric, k)
    first, owner = groups(probes)
    if len(first) == len(probes):
        return search(tile, probes, metric, k)
    row, pos, score, rank = search(tile, probes[first], metric, k)
    starts, ends = np.searchsorted(row, owner), np.searchsorted(row, owner, side="right")
    counts = ends - starts
    source = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return np.repeat(np.arange(len(probes)), counts), pos[source], score[source], rank[source]


def _exact(p: np.ndarray, c: np.ndarray, pn: np.ndarray, cn: np.ndarray, metric: str) -> np.ndarray:
    p, c = p.astype(np.float64), c.astype(np.float64)
    if metric == "L2":
        return np.sqrt(((p - c) ** 2).sum(axis=1))
    dots = (p * c).sum(axis=1)
    return dots if metric == "IP" else dots / (pn * cn)


def search(tile: dict, probes: np.ndarray, metric: str, k: int):
    """Per probe its best k corpus rows -> (probe row, position in tile['ids'], score, rank)."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))
    total, width = tile["vectors"].shape if len(tile["vectors"]) else (0, 0)
    if not total or not len(probes):
        return empty
    if probes.shape[1] != width:
        raise ValueError(f"probe width {probes.shape[1]} differs from corpus width {width}")
    found = []
    step = max(1, CELLS_AT_ONCE // total)
    for start in range(0, len(probes), step):
        found.append(_search_some(tile, probes[start:start + step], start, metric, k))
    return tuple(np.concatenate(part) for part in zip(*found))


def _candidates(close: np.ndarray, slack: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every entry within ``2 * slack`` of its row's k-th largest, or larger.

    The k-th largest of the maxima of column groups is no larger than the k-th largest entry, so
    whatever is below it less the slack can be left out, and only the groups that reach it are read
    again.
    """
    rows, total = close.shape
    groups = total // GROUP
    if groups < 2 * k:
        kth = np.partition(close, total - k, axis=1)[:, total - k] - 2 * slack
        return np.nonzero(close >= kth[:, None])
    body, rest = close[:, :groups * GROUP].reshape(rows, GROUP, groups), close[:, groups * GROUP:]
    tops = body.max(axis=1)
    kth = np.partition(tops, groups - k, axis=1)[:, groups - k] - 2 * slack
    row, group = np.nonzero(tops >= kth[:, None])
    which, member = np.nonzero(body[row, :, group] >= kth[row][:, None])
    late_row, late = np.nonzero(rest >= kth[:, None])
    return (np.concatenate((row[which], late_row)),
            np.concatenate((member * groups + group[which], late + groups * GROUP)))


def _search_some(tile, probes, base, metric, k):
    vectors, norms = tile["vectors"], tile["norms"]
    width, k_distinct = vectors.shape[1], min(k, len(vectors))
    pn = np.sqrt((probes.astype(np.float64) ** 2).sum(axis=1))
    rounding = (width + 8) * 2.0 ** -23
    close = probes @ vectors.T
    top = norms.max()
    if metric == "COSINE":
        with np.errstate(divide="ignore", invalid="ignore"):
            close /= norms.astype(np.float32)
        slack = 2 * rounding * pn
    elif metric == "IP":
        slack = rounding * pn * top
    else:
        close *= 2
        close -= (norms ** 2).astype(np.float32)
        slack = 2 * rounding * (2 * pn * top + top ** 2)
    row, col = _candidates(close, slack, k_distinct)
    scored = np.isfinite(pn[row]) & ((pn[row] > 0) | (metric != "COSINE"))
    row, col = row[scored], col[scored]
    score = _exact(probes[row], vectors[col], pn[row], norms[col], metric)
    copies = tile["counts"][col]
    within = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    pos = tile["copies"][np.repeat(tile["offsets"][col], copies) + within]
    row, score = np.repeat(row, copies), np.repeat(score, copies)
    order = np.lexsort((pos, score if metric == "L2" else -score, row))
    row, pos, score = row[order], pos[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    keep = rank <= k
    return row[keep] + base, pos[keep], score[keep], rank[keep].astype(np.int32)
