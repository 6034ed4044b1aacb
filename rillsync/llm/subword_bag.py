"""Bags of hashed subword embeddings averaged into a linear softmax, trained jointly by stochastic gradient descent.

A text is lower-cased UTF-8; every byte that is neither a letter, a digit nor part of a longer character parts words.
The subwords are the byte n-grams of each word with its two word marks. Once trained, a subword's embedding times
the softmax's weights is a row of one table, so scoring is a gather and a sum over bytes, in numpy throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTES = np.full(256, 32, np.uint8)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _BYTES[_b] = _b
#: Bytes hashed at once: the arrays of a slice stay in a core's cache.
_SLICE = 1 << 17


def buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another, a space before each and after the last, and where each begins."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    starts = np.cumsum([0, *[len(r) + 1 for r in raw]])
    return _BYTES[np.frombuffer(b" " + b" ".join(raw) + b" " * 8, np.uint8)], starts


def segments(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the segments of `size` bytes of each text begin, and whose they are. Every text has one at least."""
    n = np.maximum(1, -(-np.diff(starts) // size))
    owner = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return starts[:-1][owner] + size * (np.arange(len(owner)) - first[owner]), owner


def grams(part: np.ndarray, length: int, sizes: tuple[int, ...], bits: int):
    """For each size, the bucket of the n-gram at each of the first `length` bytes; 0 where there is none."""
    space, code = part == 32, part.astype(np.uint32)
    h, bad = code[:], np.zeros(len(part), bool)
    for n in range(2, max(sizes) + 1):
        h = h[:-1] * np.uint32(0x01000193) + code[n - 1 :]
        bad = bad[:-1]
        if n > 2:
            bad = bad | space[n - 2 : len(space) - 1]
        if n in sizes:
            k = (
                h[:length] ^ (h[:length] >> np.uint32(15))
            ) * np.uint32(0x85EBCA6B) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            k >>= np.uint32(32 - bits)
            k[(bad[:length]) | (space[:length] & space[1 : length + 1])] = 0
            yield k


@dataclass
class Bag:
    table: np.ndarray  # (buckets, classes) float32: what a subword adds to the logits; row 0 is empty
    bias: np.ndarray
    sizes: tuple[int, ...]
    bits: int

    def sums(self, data: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """For segments that begin at `at`: the sums of their subwords' rows, and how many subwords they have."""
        bounds = np.append(at, end)
        total, count = np.zeros((len(at), self.table.shape[1])), np.zeros(len(at))
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + _SLICE, "right")) - 1)
            begin, stop = int(bounds[lo]), int(bounds[hi])
            part, cuts = data[begin : stop + max(self.sizes)], bounds[lo:hi] - begin
            if stop > begin:
                for k in grams(part, stop - begin, self.sizes, self.bits):
                    total[lo:hi] += np.add.reduceat(self.table[k], cuts, axis=0)
                    count[lo:hi] += np.add.reduceat((k != 0).astype(np.int32), cuts)
            lo = hi
        return total, count


def train(
    data: np.ndarray, at: np.ndarray, end: int, target: np.ndarray, weight: np.ndarray, classes: int,
    sizes: tuple[int, ...], bits: int, dims: int, epochs: int, rate: float, seed: int = 1, bag: tuple | None = None
) -> tuple[Bag, tuple]:
    """Fit on segments with a class and a weight each, by minibatches with Adagrad steps; `bag` goes on from there."""
    rng = np.random.default_rng(seed)
    if bag is None:
        emb = np.asfortranarray(rng.normal(0, 0.1, (1 << bits, dims)).astype(np.float32))
        out, bias = rng.normal(0, 1.0, (dims, classes)).astype(np.float32), np.zeros(classes, np.float32)
        seen = np.full(
            (1 << bits, dims), 1e-8, np.float32, order="F"
        ), np.full((dims, classes), 1e-6, np.float32), np.full(classes, 1e-6, np.float32)
    else:
        emb, out, bias, seen = bag
    emb[0] = 0
    bounds = np.append(at, end)
    # neighbouring segments are drawn together, so that their bytes are hashed in one go
    run = 16
    groups = np.arange(0, len(at), run)
    size = (1024 if len(at) > 50_000 else 256 if len(at) > 10_000 else 64) // run
    for _ in range(epochs):
        for chosen_groups in np.array_split(rng.permutation(groups), max(1, len(groups) // size)):
            ids, owner, chosen, n_before = [], [], [], 0
            for i in chosen_groups:
                last = min(i + run, len(at))
                a, b = int(bounds[i]), int(bounds[last])
                own = np.repeat(np.arange(n_before, n_before + last - i, dtype=np.int32), np.diff(bounds[i : last + 1]))
                for k in grams(data[a : b + max(sizes)], b - a, sizes, bits):
                    real = k != 0
                    ids.append(k[real])
                    owner.append(own[real])
                chosen.append(np.arange(i, last))
                n_before += last - i
            if not ids or not (flat := np.concatenate(ids).astype(np.int64)).size:
                continue
            chosen = np.concatenate(chosen)
            owner = np.concatenate(owner)
            n = np.maximum(np.bincount(owner, minlength=len(chosen)), 1)
            mean = np.stack([np.bincount(owner, emb[flat, d], len(chosen)) for d in range(dims)], 1) / n[:, None]
            logit = mean @ out + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), target[chosen]] -= 1
            g = p * (weight[chosen] / len(chosen))[:, None]
            back = (g @ out.T) / n[:, None]
            go, gb = mean.T @ g, g.sum(0)
            for d in range(dims):
                ge = np.bincount(flat, back[owner, d], 1 << bits).astype(np.float32)
                seen[0][:, d] += ge**2
                emb[:, d] -= rate * ge / np.sqrt(seen[0][:, d])
            for x, gx, s in ((out, go, seen[1]), (bias, gb, seen[2])):
                s += gx**2
                x -= 0.3 * rate * gx / np.sqrt(s)
    return Bag((emb @ out).astype(np.float32), bias.astype(np.float64), sizes, bits), (emb, out, bias, seen)


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; x has a column of ones."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
