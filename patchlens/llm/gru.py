"""A gated recurrent language model with a class-factored output softmax, in numpy.

Token 0 ends a text and, as an input, starts the next one from a zero state.
Tokens 1 to ``n_words - 1`` are words of the output vocabulary, in classes of
``size``; one more class stands for all other words, which as inputs fall in
``buckets`` more embeddings.  Texts are laid end to end in parallel streams and
read in windows; the state is carried from window to window, gradients stop
at the window's start (truncated backpropagation).
"""

from __future__ import annotations

import heapq

import numpy as np


def start_parameters(counts: np.ndarray, rest: float, *, size: int, buckets: int, hidden: int, embed: int,
                     seed: int = 11) -> dict[str, np.ndarray]:
    """Parameters whose output is the unigram distribution of ``counts`` (token 0 first) and ``rest``."""
    rng = np.random.default_rng(seed)
    classes = -(-len(counts) // size)
    padded = np.zeros(classes * size)
    padded[:len(counts)] = counts + 0.1
    table = padded.reshape(classes, size)
    normal = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[-2])).astype(np.float32)
    with np.errstate(divide="ignore"):
        inner = np.where(table > 0, np.log(table / table.sum(axis=1, keepdims=True)), -1e9)
    return {
        "embed": (0.3 * rng.normal(size=(len(padded) + buckets, embed))).astype(np.float32),
        "w": normal(embed, 3 * hidden), "u": normal(hidden, 3 * hidden), "b": np.zeros(3 * hidden, np.float32),
        "class_w": np.zeros((hidden, classes + 1), np.float32),
        "class_b": np.log(np.append(table.sum(axis=1), rest + 0.1)).astype(np.float32),
        "word_w": np.zeros((classes, hidden, size), np.float32), "word_b": inner.astype(np.float32)}


def streams(lens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Deal texts to ``width`` streams, longest first to the shortest stream:
    (stream of each text, its first place there, length of the longest stream)."""
    heap = [(0, s) for s in range(width)]
    stream, place = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
    longest = 0
    for i in np.argsort(-lens, kind="stable").tolist():
        at, s = heapq.heappop(heap)
        stream[i], place[i] = s, at
        heapq.heappush(heap, (at + int(lens[i]), s))
        longest = max(longest, at + int(lens[i]))
    return stream, place, longest


def _order(a: np.ndarray, below: int) -> np.ndarray:
    """Places of ``a`` (from 0, less than ``below``) in order, equal ones as they come; 16 bits are sorted by radix."""
    return np.argsort(a.astype(np.int16) if below < 1 << 15 else a, kind="stable")


def _log_share(a: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(log softmax at column ``at`` of each row, exponentials, their row sums, places of those columns in all of
    ``a``); works in place of ``a``."""
    top = a
    while len(a) > 2048 and top.shape[1] > 8:  # by halves first, so that what is turned is small
        half = top.shape[1] // 2
        rest = top[:, 2 * half:]
        top = np.maximum(top[:, :half], top[:, half:2 * half])
        if rest.size:
            np.maximum(top[:, :1], rest, out=top[:, :1])
    top = np.ascontiguousarray(top.T).max(axis=0)[:, None]  # a reduction along many short rows is slow
    a -= top
    places = np.arange(0, a.size, a.shape[1])
    places += at
    picked = a.ravel()[places]
    np.exp(a, out=a)
    total = a.sum(axis=1)
    return picked - np.log(total), a, total, places


def _sigmoid_of_minus(a: np.ndarray) -> np.ndarray:
    """In place."""
    np.exp(a, out=a)
    a += 1
    return np.reciprocal(a, out=a)


def _gates(a: np.ndarray, hidden: int) -> np.ndarray:
    """Columns of the three gates, each in a block of its own."""
    return np.ascontiguousarray(a.reshape(len(a), 3, hidden).transpose(1, 0, 2))


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Arrays in the shapes of ``like`` over ``flat``, end to end."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: part.reshape(like[k].shape) for k, part in zip(like, np.split(flat, ends[:-1]))}


class ClassGru:
    def __init__(self, parameters: dict[str, np.ndarray]):
        self.all = np.concatenate([v.ravel() for v in parameters.values()])  # so that a step is made once for all
        self.p = _views(self.all, parameters)
        self.size = self.p["word_w"].shape[2]
        self.hidden = self.p["u"].shape[0]
        self.other = self.p["word_w"].shape[0] * self.size  # as a target: a word of the last class
        self.steps = 0
        self.moments = np.zeros_like(self.all), np.zeros_like(self.all)

    def window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, learn: float = 0.0, lanes: np.ndarray | None = None,
               all_lanes: int = 0):
        """(log probability of each target, 0 where y < 0; state after the window).  ``lanes``: the places of these
        streams among ``all_lanes``, the others have ended."""
        p, n_h = self.p, self.hidden
        steps, width = x.shape
        keep = (x != 0).astype(np.float32)[:, :, None]
        resets = (x == 0).any(axis=1).tolist()
        emb = p["embed"][x]
        # the gates take minus their sum, the candidate -2 times its own: tanh(a) = 2 sigmoid(2 a) - 1
        times = np.repeat(np.array([-1, -2], p["u"].dtype), [2 * n_h, n_h])
        xw = np.matmul(emb.reshape(-1, emb.shape[2]), _gates(p["w"], n_h)).reshape(3, steps, width, n_h)
        xw += p["b"].reshape(3, 1, 1, n_h)
        xw *= times[::n_h].reshape(3, 1, 1, 1)
        u = _gates(p["u"] * times, n_h)
        state = np.empty((steps, width, n_h), np.float32)
        if learn:
            before, new, back = (np.empty_like(state) for _ in range(3))
            gates = np.empty((2, *state.shape), np.float32)
        xzr, xn = xw[:2], xw[2]
        hu = np.empty((3, width, n_h), state.dtype)  # a block for each gate: steps work on whole blocks
        hzr, hn, zr, n = hu[:2], hu[2], np.empty((2, width, n_h), state.dtype), np.empty_like(h)
        z, r = zr
        with np.errstate(over="ignore"):
            for t in range(steps):
                if resets[t]:
                    h = h * keep[t]
                np.matmul(h, u, out=hu)
                np.add(xzr[:, t], hzr, out=zr)
                _sigmoid_of_minus(zr)
                np.multiply(r, hn, out=n)
                n += xn[t]
                _sigmoid_of_minus(n)
                n *= 2
                n -= 1
                if learn:
                    before[t], gates[:, t], new[t], back[t] = h, zr, n, hn
                h = np.subtract(h, n, out=state[t])
                h *= z
                h += n
        if learn:
            back *= -0.5
        flat, target = state.reshape(-1, n_h), y.ravel()
        real = np.flatnonzero(target >= 0)
        group = target[real] // self.size
        order = _order(group, p["word_w"].shape[0] + 1)  # tokens by class, so that each class is one slice
        real, group = real[order], group[order]
        hs, target = flat[real], target[real]
        ends = np.searchsorted(group, np.arange(p["word_w"].shape[0] + 1))
        got, e, total, places = _log_share(hs @ p["class_w"] + p["class_b"], group)
        got = got.astype(np.float64)
        grad = _views(np.zeros_like(self.all), p) if learn else {}
        d_hs = None
        scale = np.float32(1 / max(1, len(real)))
        if learn:
            e *= (scale / total)[:, None]
            e.ravel()[places] -= scale
            grad["class_w"][:], grad["class_b"][:] = hs.T @ e, e.sum(axis=0)
            d_hs = e @ p["class_w"].T
        for c in range(p["word_w"].shape[0]):
            at = slice(ends[c], ends[c + 1])
            n_at = ends[c + 1] - ends[c]
            if not n_at:
                continue
            slot = target[at] % self.size
            one, e, total, places = _log_share(hs[at] @ p["word_w"][c] + p["word_b"][c], slot)
            got[at] += one
            if learn:
                e *= (scale / total)[:, None]
                e.ravel()[places] -= scale
                grad["word_w"][c], grad["word_b"][c] = hs[at].T @ e, e.sum(axis=0)
                d_hs[at] += e @ p["word_w"][c].T
        out = np.zeros(x.size)
        out[real] = got
        if learn:
            d_state = np.zeros_like(flat)
            d_state[real] = d_hs
            self._backward(x, keep, resets, emb, d_state.reshape(state.shape), before, gates, new, back, grad, lanes, all_lanes)
            self._step(grad, learn)
        return out.reshape(x.shape), h

    def _backward(self, x, keep, resets, emb, d_state, before, gates, new, back, grad, lanes, all_lanes) -> None:
        p, n_h = self.p, self.hidden
        u_back = p["u"].T
        z, r = gates
        # what a step's gradient is multiplied with, for all steps at once
        by_new = (1 - z) * (1 - new * new)
        by_z = (before - new) * z * (1 - z)
        by_r = back * r * (1 - r)
        # products over streams have a row for all of them, zero for the ended ones: rounding depends on the rows
        some = lanes is not None and len(lanes) < all_lanes
        at = lanes if some else slice(None)

        def placed(a: np.ndarray) -> np.ndarray:
            if some:
                whole = np.zeros((len(a), all_lanes, a.shape[2]), a.dtype)
                whole[:, at] = a
                a = whole
            return a.reshape(-1, a.shape[2])

        d_h = np.zeros_like(before[0])
        d_gates = np.empty((3, *before.shape), before.dtype)
        d_z, d_r, d_n = d_gates
        width = before.shape[1]
        d_hu = np.zeros((len(before), all_lanes if some else width, 3 * n_h), before.dtype)  # the running streams first
        for t in range(len(before) - 1, -1, -1):
            d_h += d_state[t]
            np.multiply(d_h, by_new[t], out=d_n[t])
            np.multiply(d_h, by_z[t], out=d_z[t])
            np.multiply(d_n[t], by_r[t], out=d_r[t])
            d_hu[t, :width, :n_h] = d_z[t]
            d_hu[t, :width, n_h:2 * n_h] = d_r[t]
            d_hu[t, :width, 2 * n_h:] = d_n[t] * r[t]
            d_h *= z[t]
            d_h += (d_hu[t] @ u_back)[:width]
            if resets[t]:
                d_h *= keep[t]
        d_pre = np.ascontiguousarray(d_gates.transpose(1, 2, 0, 3)).reshape(*before.shape[:2], 3 * n_h)
        rows = placed(d_pre)
        own = d_pre.reshape(-1, 3 * n_h)
        grad["u"][:] = placed(before).T @ placed(d_hu[:, :width])
        grad["w"][:], grad["b"][:] = placed(emb).T @ rows, own.sum(axis=0)
        if len(own) < 256:  # small products are rounded otherwise than large ones
            d_emb = (rows @ p["w"].T).reshape(len(before), -1, emb.shape[2])[:, at].reshape(-1, emb.shape[2])
        else:
            d_emb = own @ p["w"].T
        flat = x.ravel()
        order = _order(flat, len(p["embed"]))
        ids = flat[order]
        first = np.flatnonzero(np.diff(ids, prepend=-1))
        grad["embed"][ids[first]] = np.add.reduceat(d_emb[order], first, axis=0)

    def _step(self, grad: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        clip = min(1.0, 1.0 / (norm + 1e-9))
        fix = rate * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        g = np.concatenate([g.ravel() for g in grad.values()]) * clip
        m, v = self.moments
        change = g - m
        change *= 0.1
        m += change
        g *= g
        g -= v
        g *= 0.01
        v += g
        change = fix * m
        change /= np.sqrt(v) + 1e-6
        self.all -= change.astype(np.float32)

    def texts(self, ids: np.ndarray, targets: np.ndarray, lens: np.ndarray, *, width: int, steps: int,
              learn: float = 0.0) -> np.ndarray:
        """Log probability of each text; ``ids`` and ``targets`` hold the texts end to end, each with its end."""
        if not len(lens):
            return np.empty(0)
        stream, place, longest = streams(lens, min(width, len(lens)))
        width = int(stream.max()) + 1
        begins = np.cumsum(lens) - lens
        spot = np.arange(len(ids))
        spot += np.repeat(place - begins, lens)
        spot *= width
        spot += np.repeat(stream, lens)
        x = np.zeros((longest + 1, width), np.int32)
        y = np.full((longest, width), -1, np.int32)
        x.ravel()[spot + width] = ids  # an input is the token before; a text's first is the end before it
        y.ravel()[spot] = targets
        got = np.zeros((longest, width))
        h = np.zeros((width, self.hidden), np.float32)
        lanes, held = np.arange(width), np.bincount(stream, weights=lens, minlength=width)
        for at in range(0, longest, steps):
            to = min(longest, at + steps)
            on = held[lanes] > at  # one long text outlasts the other streams by far
            lanes, h = lanes[on], h[on]
            got[at:to, lanes], h = self.window(x[at:to, lanes], y[at:to, lanes], h, learn, lanes, width)
        return np.bincount(np.repeat(np.arange(len(lens)), lens), weights=got.ravel()[spot], minlength=len(lens))
