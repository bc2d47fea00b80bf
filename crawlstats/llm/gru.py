"""A small gated recurrent network with a class-factored softmax, in numpy.

A symbol's vector is its input to the three gates. The output is factored:
first the class of the next token, then, in a head class, the token within
it; tokens of other classes have fixed shares of their class, which the caller
adds. Documents run side by side in lanes, in windows of a few steps; a lane
takes one document after the other, from state zero, so that all lanes are
busy to about the same step. The state is carried from window to window, and
gradients stop at a window's start (truncated backpropagation) and at a
document's.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

LANES = 512
#: Tokens of a window, and the bounds of its steps: few lanes take longer windows.
WINDOW, STEPS = 1 << 13, (16, 256)
RATE = 0.08
#: Logits beyond this are shifted before their exponentials are taken.
LARGEST = 60.0


class Gru:
    """``symbols`` inputs; ``heads`` classes of ``size`` tokens each come first among ``classes``."""

    def __init__(self, symbols: int, classes: int, heads: int, size: int, hidden: int):
        self.heads, self.size, self.hidden = heads, size, hidden
        r = np.random.default_rng(7)
        f = np.float32
        self.emb = (r.standard_normal((symbols, 3 * hidden)) * 0.1).astype(f)
        self.rec = (r.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(f)
        self.out, self.out_bias = np.zeros((hidden, classes), f), np.zeros(classes, f)
        self.tok, self.tok_bias = np.zeros((heads * size, hidden), f), np.zeros(heads * size, f)

    NAMES = ("emb", "rec", "out", "out_bias", "tok", "tok_bias")

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def set_vector(self, v: np.ndarray) -> Gru:
        at = 0
        for n in self.NAMES:
            p = getattr(self, n)
            setattr(self, n, v[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return self

    # --- one window ----------------------------------------------------------------

    def states(self, x: np.ndarray, first: np.ndarray, h: np.ndarray, keep: tuple | None = None) -> np.ndarray:
        """The states after each step of ``x`` (steps x lanes), from state ``h``; zero before a ``first`` token.

        ``keep`` takes, per step, the state before it, both gates, the candidate's recurrent part and the candidate.
        """
        n, out = self.hidden, np.empty((len(x), *h.shape), np.float32)
        begins = first.any(axis=1).tolist()
        for t, symbols in enumerate(x):
            if begins[t]:
                h = np.where(first[t][:, None], np.float32(0), h)
            gx, gh = self.emb[symbols], h @ self.rec
            gates = gx[:, : 2 * n] + gh[:, : 2 * n]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r, own = gates[:, :n], gates[:, n:], gh[:, 2 * n :]
            new = r * own
            new += gx[:, 2 * n :]
            np.tanh(new, out=new)
            if keep is not None:
                for array, value in zip(keep, (h, z, r, own, new)):
                    array[t] = value
            h = np.subtract(h, new, out=out[t])
            h *= z
            h += new
        return out

    @staticmethod
    def _exp(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
        """Makes ``logits`` their exponentials; returns the rows' sums, and what was taken off before.

        Rows are shifted by their maximum only where some logit is large.
        """
        off: np.ndarray | float = 0.0
        if logits.size and max(logits.max(), -logits.min()) > LARGEST:
            off = logits.max(axis=1)
            logits -= off[:, None]
        np.exp(logits, out=logits)
        return logits @ np.ones(logits.shape[1], logits.dtype), off

    def _log_prob(self, logits: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural-log probabilities of the targets; overwrites ``logits``."""
        at = logits[np.arange(len(target)), target]
        total, off = self._exp(logits)
        return at - off - np.log(total)

    def _error(self, logits: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The gradient at the logits: probabilities less the target's one; overwrites ``logits``."""
        logits /= self._exp(logits)[0][:, None]
        logits[np.arange(len(target)), target] -= 1
        return logits

    def _by_class(self, kind: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The rows of head classes in the order of their class, and where each class begins among them."""
        head = np.flatnonzero(kind < self.heads)
        order = head[np.argsort(kind[head], kind="stable")]
        return order, np.searchsorted(kind[order], np.arange(self.heads + 1)).tolist()

    def log_probs(self, h: np.ndarray, kind: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Natural-log probabilities of tokens by class and place in a head class, given states."""
        lp = self._log_prob(h @ self.out + self.out_bias, kind)
        rows, cut = self._by_class(kind)
        part, at, more = h[rows], place[rows], np.zeros(len(rows), lp.dtype)
        for c in range(self.heads):
            own, own_rows = slice(c * self.size, (c + 1) * self.size), slice(cut[c], cut[c + 1])
            if cut[c] < cut[c + 1]:
                more[own_rows] = self._log_prob(part[own_rows] @ self.tok[own].T + self.tok_bias[own], at[own_rows])
        lp[rows] += more
        return lp

    # --- learning --------------------------------------------------------------------

    def learn(self, x, first, h0, kind, place, live, memory: dict) -> np.ndarray:
        """One update on a window (all arrays steps x lanes); returns the state after it."""
        steps, lanes, n = *x.shape, self.hidden
        h, z, r, own, new = keep = tuple(np.empty((5, steps, lanes, n), np.float32))
        hs = self.states(x, first, h0, keep)
        before = h.reshape(-1, n)
        flat, kind, place, live = hs.reshape(-1, n), kind.ravel(), place.ravel(), live.ravel()
        d = self._error(flat @ self.out + self.out_bias, kind)
        if not live.all():
            d *= live[:, None]
            kind = np.where(live > 0, kind, self.heads)
        dh = d @ self.out.T
        grads = {"out": flat.T @ d, "out_bias": np.ones(len(d), d.dtype) @ d}
        tok, tok_bias = np.zeros_like(self.tok), np.zeros_like(self.tok_bias)
        rows, cut = self._by_class(kind)
        part, down, at = flat[rows], np.empty((len(rows), n), flat.dtype), place[rows]
        for c in range(self.heads):
            members, own_rows = slice(c * self.size, (c + 1) * self.size), slice(cut[c], cut[c + 1])
            if cut[c] < cut[c + 1]:
                e = self._error(part[own_rows] @ self.tok[members].T + self.tok_bias[members], at[own_rows])
                np.matmul(e, self.tok[members], out=down[own_rows])
                tok[members], tok_bias[members] = e.T @ part[own_rows], e.sum(axis=0)
        dh[rows] += down
        grads |= {"tok": tok, "tok_bias": tok_bias}
        dh = dh.reshape(steps, lanes, n)
        # What a step's gradient is multiplied by on its way to the gates.
        to_new = 1 - new * new
        to_new *= 1 - z
        to_z = (h - new) * z
        to_z *= 1 - z
        to_r = own * r
        to_r *= 1 - r
        gate_h = np.empty((steps, lanes, 3 * n), np.float32)
        gate_x = np.empty((steps, lanes, 3 * n), np.float32)
        back, rec_t = np.zeros((lanes, n), np.float32), np.ascontiguousarray(self.rec.T)
        for t in range(steps - 1, -1, -1):
            g = dh[t] + back
            d_new = g * to_new[t]
            gh = gate_h[t]
            np.multiply(g, to_z[t], out=gh[:, :n])
            np.multiply(d_new, to_r[t], out=gh[:, n : 2 * n])
            np.multiply(d_new, r[t], out=gh[:, 2 * n :])
            gate_x[t, :, 2 * n :] = d_new
            back = gh @ rec_t
            back += g * z[t]
            back[first[t]] = 0
        gate_x[:, :, : 2 * n] = gate_h[:, :, : 2 * n]
        grads["rec"] = before.T @ gate_h.reshape(-1, 3 * n)
        for name, g in grads.items():
            self._step(getattr(self, name), g, memory.setdefault(name, np.full_like(g, 1e-2)), slice(None))
        order = np.argsort(x.ravel(), kind="stable")
        symbols = x.ravel()[order]
        first = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        g = np.add.reduceat(gate_x.reshape(-1, 3 * n)[order], first, axis=0)
        self._step(self.emb, g, memory.setdefault("emb", np.full_like(self.emb, 1e-2)), symbols[first])
        return hs[-1]

    @staticmethod
    def _step(p: np.ndarray, g: np.ndarray, m: np.ndarray, rows) -> None:
        m[rows] += g * g
        p[rows] -= RATE * g / np.sqrt(m[rows])


def lanes(length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents in the order of their lanes, tokens of each lane), the longest lane first.

    The longest documents are dealt first, each to the shortest lane.
    """
    order = np.argsort(-length, kind="stable").tolist()
    own: list[list[int]] = [[] for _ in range(min(width, len(order)))]
    load = [(0, i) for i in range(len(own))]
    for d in order:
        n, i = load[0]
        own[i].append(d)
        heapq.heapreplace(load, (n + int(length[d]), i))
    total = np.zeros(len(own), dtype=np.int64)
    for n, i in load:
        total[i] = n
    by_total = np.argsort(-total, kind="stable")
    return np.concatenate([np.array(own[i], dtype=np.int64) for i in by_total]), total[by_total]


def windows(total: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(lanes still running, places in the lanes' tokens, live) of one window after the other."""
    start, t, end = np.cumsum(total) - total, 0, int(total[0])
    while t < end:
        on = int(np.searchsorted(-total, -t))  # lanes longer than t
        steps = min(max(WINDOW // on, STEPS[0]), STEPS[1], end - t)
        step = t + np.arange(steps)[:, None]
        live = step < total[:on]
        yield on, start[:on] + np.minimum(step, total[:on] - 1), live
        t += steps
