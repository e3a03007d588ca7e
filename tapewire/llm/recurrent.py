"""A gated recurrent language model over token numbers, in numpy.

The input of a step is the token before; a text starts from a state of zeros and the end
token. With a = h U,

    r = s(x_r + a_r),  z = s(x_z + a_z),  c = tanh(x_c + r a_c),  h' = (1 - z) c + z h

where x is the row of the input token. The output is factored by classes: P(class | h') times
P(token | class, h'). Classes hold WIDTH tokens each, by rank; further classes hold a
single token and need no second softmax.

Training cuts the texts, one after another, into parallel streams and goes over these in
windows of WINDOW steps. The state goes on from window to window and is zero where a text
begins; gradients go back to the start of the window (truncated backpropagation). Scoring takes
texts side by side, longest first, and carries the state of each through all of its windows.
"""

from __future__ import annotations

import numpy as np

HIDDEN, WIDTH = 16, 32
WINDOW, STREAMS, STREAM = 16, 256, 512
# Tokens that a window of scoring holds, and states that go through the output at a time.
PLACES, ROWS = 1 << 16, 8192
CLIP = 1.0
_LOW = np.float32(-1e9)


class Layout:
    """Tokens 0 to ``ranked`` - 1 share classes of WIDTH, the ``single`` others have one each."""

    def __init__(self, ranked: int, single: int):
        self.ranked, self.single = ranked, single
        self.shared = -(-ranked // WIDTH)
        self.classes = self.shared + single
        self.tokens = ranked + single

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """The class of each token."""
        return np.where(
            tokens < self.ranked, tokens // WIDTH, tokens - self.ranked + self.shared
        )


def shapes(layout: Layout) -> dict[str, tuple[int, ...]]:
    return {
        "x": (layout.tokens, 3 * HIDDEN),
        "u": (HIDDEN, 3 * HIDDEN),
        "class_w": (HIDDEN, layout.classes),
        "class_b": (layout.classes,),
        "word_w": (layout.shared, HIDDEN, WIDTH),
        "word_b": (layout.shared, WIDTH),
    }


def initial(layout: Layout, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters that give each token its share of ``counts``, whatever came before."""
    random = np.random.default_rng(12)
    scale = 1 / np.sqrt(HIDDEN)
    out = {n: (random.standard_normal(s) * scale).astype(np.float32)
           for n, s in shapes(layout).items()}
    held = np.maximum(counts.astype(np.float64), 0.5)
    out["class_b"] = np.log(
        np.bincount(layout.of(np.arange(layout.tokens)), held, layout.classes) / held.sum()
    ).astype(np.float32)
    words = np.full(layout.shared * WIDTH, np.exp(float(_LOW)))
    words[: layout.ranked] = held[: layout.ranked]
    with np.errstate(divide="ignore"):
        words = np.maximum(np.log(words), _LOW).reshape(layout.shared, WIDTH)
    out["word_b"] = words.astype(np.float32)
    out["class_w"] *= 0.1
    out["word_w"] *= 0.1
    return out


def packed(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params.values()])


def unpacked(flat: np.ndarray, layout: Layout) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(layout).items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def _gate(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _apart(*shape: int, kind: type) -> np.ndarray:
    """An empty array whose rows do not lie a power of two apart, so that caches hold many."""
    return np.empty((*shape[:-1], shape[-1] + 16), kind)[..., : shape[-1]]


def _softmax(logits: np.ndarray, row: np.ndarray, place: np.ndarray, parts: list[slice],
             grad: bool) -> np.ndarray:
    """Log probability of ``row`` in each column.

    With ``grad``, the logits become the gradients of minus these, else anything. ``parts``:
    columns that are added up together, since numpy rounds the sum of a lone one in its own way.
    """
    logits -= logits.max(axis=0)
    value = logits[row, place]
    np.exp(logits, out=logits)
    total = np.empty_like(value)
    for part in parts:
        logits[:, part].sum(axis=0, out=total[part])
    value -= np.log(total)
    if grad:
        logits /= total
        logits[row, place] -= 1
    return value


class Model:
    """States and logits lie column by column, so that numpy adds up along rows."""

    def __init__(self, layout: Layout, params: dict[str, np.ndarray]):
        self.layout, self.params = layout, params
        # Small numbers, since numpy sorts these in one pass.
        self.kinds = layout.of(np.arange(layout.tokens)).astype(np.uint16)

    def step(self, h: np.ndarray, x: np.ndarray):
        """The next state of each column of ``h``, and what its gradient needs."""
        a = self.params["u"].T @ h
        gates = _gate(x[: 2 * HIDDEN] + a[: 2 * HIDDEN])
        r, z = gates[:HIDDEN], gates[HIDDEN:]
        c = r * a[2 * HIDDEN :]
        c += x[2 * HIDDEN :]
        np.tanh(c, out=c)
        new = h - c
        new *= z
        new += c
        return new, (r, z, c, a[2 * HIDDEN :])

    def log_probs(self, h: np.ndarray, target: np.ndarray, grad: dict | None = None):
        """Natural log probability of each target after each state (column) of ``h``.

        With ``grad``, the gradients of minus their sum are put there, and that of ``h`` is
        returned as well.
        """
        p, layout = self.params, self.layout
        kind = self.kinds[target]
        order = np.argsort(kind, kind="stable")
        h = h[:, order]
        target, kind = target[order], kind[order]
        place = np.arange(len(target))
        logits = _apart(layout.classes, len(target), kind=h.dtype)
        np.matmul(p["class_w"].T, h, out=logits)
        logits += p["class_b"][:, None]
        value = _softmax(logits, kind, place, [slice(None)], grad is not None)
        dh = None
        if grad is not None:
            grad["class_w"], grad["class_b"] = h @ logits.T, logits.sum(axis=1)
            grad["word_w"], grad["word_b"] = np.zeros_like(p["word_w"]), np.zeros_like(p["word_b"])
            dh = p["class_w"] @ logits
        ends = np.searchsorted(kind, np.arange(layout.shared + 1))
        owns = [(k, slice(ends[k], ends[k + 1])) for k in range(layout.shared)
                if ends[k] < ends[k + 1]]
        # One softmax for the words of all classes, side by side.
        shared = slice(0, ends[-1])
        inner = _apart(WIDTH, ends[-1], kind=h.dtype)
        for k, own in owns:
            np.add(p["word_w"][k].T @ h[:, own], p["word_b"][k][:, None], out=inner[:, own])
        parts = [own for _, own in owns]
        value[shared] += _softmax(
            inner, target[shared] % WIDTH, place[shared], parts, grad is not None
        )
        out = np.empty_like(value)
        out[order] = value
        if grad is not None:
            for k, own in owns:
                part = inner[:, own]
                grad["word_w"][k], grad["word_b"][k] = h[:, own] @ part.T, part.sum(axis=1)
                dh[:, own] += p["word_w"][k] @ part
            inverse = np.empty_like(order)
            inverse[order] = place
            dh = dh.take(inverse, axis=1, mode="clip")
        return out, dh

    def window(self, h: np.ndarray, before: np.ndarray, target: np.ndarray, fresh: np.ndarray):
        """(log probability, gradients, last state) of one window of all streams.

        Arrays are steps by streams; ``fresh``: steps at which a text begins.
        """
        steps, streams = target.shape
        x = self.params["x"].T.take(before, axis=1, mode="clip").transpose(1, 0, 2)
        old = np.empty((steps, HIDDEN, streams), x.dtype)
        new, r, z, c, a = (np.empty_like(old) for _ in range(5))
        carried = (~fresh).astype(x.dtype)
        for t in range(steps):
            begin = np.multiply(h, carried[t], out=old[t])
            h, (r[t], z[t], c[t], a[t]) = self.step(begin, x[t])
            new[t] = h
        grad: dict[str, np.ndarray] = {}
        found, dh_out = self.log_probs(_columns(new), target.ravel(), grad)
        dh_out = dh_out.reshape(HIDDEN, steps, streams)
        by_r, by_z, by_c, away = 1 - r, 1 - z, 1 - c * c, old - c
        da = np.empty((steps, 3 * HIDDEN, streams), x.dtype)
        dx = _apart(steps, 3 * HIDDEN, streams, kind=x.dtype)
        later = np.zeros((HIDDEN, streams), x.dtype)
        for t in range(steps - 1, -1, -1):
            dh = dh_out[:, t] + later
            through = dh * z[t]
            dh -= through
            inner_r, inner_z, inner_c = da[t].reshape(3, HIDDEN, streams)
            dc = np.multiply(dh, by_c[t], out=dh)
            np.multiply(dc, a[t], out=inner_r)
            inner_r *= r[t]
            inner_r *= by_r[t]
            np.multiply(through, away[t], out=inner_z)
            inner_z *= by_z[t]
            np.multiply(dc, r[t], out=inner_c)
            dx[t, 2 * HIDDEN :] = dc
            later = self.params["u"] @ da[t]
            later += through
            later *= carried[t]
        dx[:, : 2 * HIDDEN] = da[:, : 2 * HIDDEN]
        grad["u"] = _columns(old) @ _columns(da).T
        rows = dx.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)
        grad["x"] = _summed(before.ravel(), rows, self.layout.tokens)
        return float(found.sum()), grad, h

    def train(self, tokens: np.ndarray, first: np.ndarray, end: int, rate: float) -> None:
        """One pass over texts one after another. ``first``: whether a text begins at a token;
        ``end``: the token that stands before a text's first."""
        n = len(tokens)
        streams = int(np.clip(n // STREAM, 1, STREAMS))
        size = -(-n // streams)
        place = np.arange(size)[:, None] + np.arange(streams) * size
        used = place < n
        place = np.minimum(place, n - 1)
        target, fresh = tokens[place], first[place] | ~used
        before = np.where(fresh, end, tokens[np.maximum(place - 1, 0)])
        h = np.zeros((HIDDEN, streams), np.float32)
        adam = _Adam(self.params, rate)
        for t in range(0, size, WINDOW):
            part = slice(t, t + WINDOW)
            _, grad, h = self.window(h, before[part], target[part], fresh[part])
            adam.update(grad, target[part].size)

    def scores(self, tokens: np.ndarray, at: np.ndarray, end: int) -> np.ndarray:
        """Natural log probability of each text; text i is tokens at[i] to at[i + 1]."""
        sizes = np.diff(at)
        order = np.argsort(-sizes, kind="stable")
        start, sizes = at[:-1][order], sizes[order]
        found = np.zeros(len(sizes))
        inputs = np.ascontiguousarray(self.params["x"].T)
        h = np.zeros((HIDDEN, len(sizes)), np.float32)
        t, longest = 0, int(sizes[0]) if len(sizes) else 0
        while t < longest:
            live = int(np.searchsorted(-sizes, -t, side="left"))
            steps = min(max(PLACES // live, 1), longest - t)
            # Tokens of this window, step by step, of the texts that reach so far.
            lives = np.searchsorted(-sizes, -np.arange(t, t + steps), side="left")
            ends = np.cumsum(lives)
            owner = np.arange(ends[-1]) - np.repeat(ends - lives, lives)
            place = start[owner] + np.repeat(np.arange(t, t + steps), lives)
            target, before = tokens[place], tokens[place - 1]
            if t == 0:
                before[:live] = end
            x = inputs.take(before, axis=1, mode="clip")
            states = np.empty((HIDDEN, len(place)), np.float32)
            for stop, n in zip(ends.tolist(), lives.tolist(), strict=True):
                h, _ = self.step(h[:, :n], x[:, stop - n : stop])
                states[:, stop - n : stop] = h
            value = [
                self.log_probs(states[:, i : i + ROWS], target[i : i + ROWS])[0]
                for i in range(0, len(place), ROWS)
            ]
            found += np.bincount(owner, np.concatenate(value), len(found))
            t += steps
        out = np.empty(len(found))
        out[order] = found
        return out


def _columns(values: np.ndarray) -> np.ndarray:
    """Steps by units by streams as units by all steps' streams."""
    steps, units, streams = values.shape
    out = np.empty((units, steps, streams), values.dtype)
    out[:] = values.transpose(1, 0, 2)
    return out.reshape(units, -1)


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sum of the values of each row number."""
    out = np.zeros((n, values.shape[1]), np.float32)
    order = np.argsort(rows.astype(np.uint16) if n <= 1 << 16 else rows, kind="stable")
    rows = rows[order]
    begin = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    out[rows[begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


class _Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.n = params, rate, 0
        self.mean = {k: np.zeros_like(p) for k, p in params.items()}
        self.square = {k: np.zeros_like(p) for k, p in params.items()}

    def update(self, grad: dict[str, np.ndarray], tokens: int) -> None:
        self.n += 1
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values())) / tokens
        scale = np.float32(min(1.0, CLIP / max(norm, 1e-12)) / tokens)
        rate = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
        for k, g in grad.items():
            g *= scale
            mean, square = self.mean[k], self.square[k]
            mean += np.float32(0.1) * (g - mean)
            square += np.float32(0.001) * (g * g - square)
            self.params[k] -= np.float32(rate) * mean / (np.sqrt(square) + np.float32(1e-8))
