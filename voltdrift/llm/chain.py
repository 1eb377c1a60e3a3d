"""Forward-backward of a linear-chain conditional random field, over many chains at once."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 64


class Chains(NamedTuple):
    """Chains of positions laid end to end, cut into blocks that numpy handles side by side."""

    start: np.ndarray  # of each block, longest block first
    active: list[int]  # how many blocks have a position t, for t = 0, 1, ...
    first: np.ndarray  # blocks that begin a chain
    ranks: list[np.ndarray]  # the k-th block of every chain that has one, for k = 0, 1, ...
    before: np.ndarray  # the block before, in the same chain; -1 for a first one
    positions: int


def chains(lengths: np.ndarray, block: int = BLOCK) -> Chains:
    """``lengths``: of each chain, at least 1."""
    lengths = np.asarray(lengths, np.int64)
    counts = -(-lengths // block)
    chain = np.repeat(np.arange(len(lengths)), counts)
    rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(lengths) - lengths, counts) + rank * block
    size = np.minimum(block, lengths[chain] - rank * block) if len(chain) else np.zeros(0, np.int64)
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.where(rank > 0, np.concatenate([[-1], place[:-1]]), -1)[order] if len(order) else np.zeros(0, np.int64)
    by_rank = np.argsort(rank, kind="stable")
    ranks = np.split(place[by_rank], np.cumsum(np.bincount(rank))[:-1]) if len(rank) else []
    active = [int((size > t).sum()) for t in range(int(size.max(initial=0)))]
    return Chains(start[order], active, (rank == 0)[order], ranks, before, int(lengths.sum()))


def marginals(scores: np.ndarray, transitions: np.ndarray, at: Chains, pairs: bool = False):
    """Posterior of every label at every position.

    scores: positions x labels; transitions: from x to; both logarithms, with any
    scale. With ``pairs`` also the sum over neighbours of the posterior of their
    labels, and the logarithm of the product of all chains' normalisers.

    The products of each block's transfer matrices come first, then the messages
    that cross from block to block, then positions inside all blocks at once: a
    chain of n positions takes about n / BLOCK + 3 * BLOCK array steps.
    """
    labels = transitions.shape[0]
    top = scores.max(axis=1, keepdims=True)
    emit = np.exp(scores - top)
    shift = transitions.max()
    step = np.exp(transitions - shift).astype(emit.dtype)
    blocks = len(at.start)
    matrix = np.tile(np.eye(labels, dtype=emit.dtype), (blocks, 1, 1))
    scale = np.zeros(blocks)
    for t, n in enumerate(at.active):
        moved = matrix[:n] @ step
        if t == 0:
            moved[at.first[:n]] = matrix[:n][at.first[:n]]
        moved *= emit[at.start[:n] + t][:, None, :]
        total = moved.sum(axis=(1, 2))
        matrix[:n] = moved / total[:, None, None]
        scale[:n] += np.log(total)
    enter = np.ones((blocks, labels), emit.dtype)
    leave = np.ones((blocks, labels), emit.dtype)
    normal = 0.0
    out = np.ones((blocks, labels), emit.dtype)
    for k, here in enumerate(at.ranks):
        if k:
            enter[here] = out[at.before[here]]
        sent = np.einsum("bi,bij->bj", enter[here], matrix[here])
        total = sent.sum(axis=1, keepdims=True)
        out[here] = sent / total
        normal += float(np.log(total).sum())
    for here in at.ranks[:0:-1]:
        back = np.einsum("bij,bj->bi", matrix[here], leave[here])
        leave[at.before[here]] = back / back.sum(axis=1, keepdims=True)
    found = np.empty_like(emit)
    ahead = enter
    for t, n in enumerate(at.active):
        moved = ahead[:n] @ step
        if t == 0:
            moved[at.first[:n]] = 1
        moved *= emit[at.start[:n] + t]
        ahead = moved / moved.sum(axis=1, keepdims=True)
        found[at.start[:n] + t] = ahead
    between = np.zeros((labels, labels))
    back = leave
    for t in range(len(at.active) - 1, -1, -1):
        n = at.active[t]
        place = at.start[:n] + t
        seen = emit[place] * back[:n]
        if pairs:
            previous = enter[:n] if t == 0 else found[place - 1]
            weight = ((previous @ step) * seen).sum(axis=1, keepdims=True)
            share = previous / weight
            if t == 0:
                share = np.where(at.first[:n, None], 0, share)
            between += step * (share.T @ seen)
        sent = seen @ step.T
        both = found[place] * back[:n]
        if t:
            back[:n] = sent / sent.sum(axis=1, keepdims=True)
        found[place] = both / both.sum(axis=1, keepdims=True)
        if pairs and t:
            pass
    if not pairs:
        return found
    steps = at.positions - int(at.first.sum())
    return found, between, normal + float(scale.sum()) + float(top.sum()) + float(shift) * steps
