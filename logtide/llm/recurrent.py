"""A small gated recurrent language model in numpy: words in classes, state carried from window to window.

Texts lie one after another in lanes, and all lanes take a step at a time. The state is cleared after the end token of
a text and carried across everything else, so a long text is read as a whole. A word's probability is that of its class
times that of the word within its class; classes hold equally many words, in order of their counts. All words outside the
vocabulary are one further class, whose own share of a word's probability the caller multiplies in.

Training cuts the gradient, not the state, at each window's first step (truncated backpropagation).
"""

from __future__ import annotations

import ctypes
import glob
import os
from dataclasses import dataclass

import numpy as np

F32 = np.float32
HALF, ONE = F32(0.5), F32(1)
WINDOW = 16
#: Least output bias, and the most that a state can add to an output.
OFF, BOUND = F32(-30.0), F32(48.0)


def one_core() -> None:
    """Keep numpy's products on the task's one core: for matrices this small, further threads only wait, and use time."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def lanes_of(lengths: np.ndarray, lanes: int) -> list[np.ndarray]:
    """Texts dealt to lanes, the longest first, each to the lane with the fewest tokens so far."""
    import heapq

    heap = [(0, k) for k in range(lanes)]
    held: list[list[int]] = [[] for _ in range(lanes)]
    for t in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        held[k].append(t)
        heapq.heappush(heap, (size + int(lengths[t]), k))
    return [np.array(h, np.int64) for h in held if h]


def lay_out(ids: np.ndarray, first: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, owner)``, each steps x lanes: token ids and the text of each; -1 where a lane has run dry."""
    lengths = np.diff(first)
    held = sorted(lanes_of(lengths, min(lanes, max(len(lengths), 1))), key=lambda h: -int(lengths[h].sum()))  # busy lanes first
    steps = int(lengths[held[0]].sum()) if held else 0
    tokens, owner = np.full((steps, len(held)), -1, np.int32), np.full((steps, len(held)), -1, np.int32)
    for k, own in enumerate(held):
        at = np.concatenate([np.arange(first[t], first[t + 1]) for t in own])
        tokens[: len(at), k] = ids[at]
        owner[: len(at), k] = np.repeat(own, lengths[own])
    return tokens, owner


def _stable_order(small: np.ndarray) -> np.ndarray:
    """Of class or token numbers; numpy sorts 16 bits by counting."""
    return np.argsort(small.astype(np.int16) if small.size and int(small.max()) < 1 << 15 else small, kind="stable")


def _shares(x: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the chosen entries (places in the flat array) under a softmax of each row, and the sums to divide
    ``x`` by, which becomes its exponentials.

    Output weights and biases are bounded (``BOUND``, ``OFF``), so nothing overflows."""
    own = x.ravel().take(chosen)
    np.exp(x, out=x)
    whole = x @ np.ones(x.shape[1], F32)
    return own - np.log(whole), whole


def _three(x: np.ndarray) -> np.ndarray:
    """Update gate, reset gate and candidate one after another, each a stretch of memory, instead of side by side."""
    return np.ascontiguousarray(x.reshape(-1, 3, x.shape[-1] // 3).swapaxes(0, 1))


def _halved(x: np.ndarray) -> np.ndarray:
    """In place: half of what goes into the two gates, for ``_step``."""
    x[:2] *= HALF
    return x


def _step(gates: np.ndarray, h: np.ndarray, u: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The new state of all lanes. ``gates`` has what the tokens add (``_halved``, as is ``u``) and becomes update gate, reset
    gate and candidate; ``room[2]`` becomes what the state adds to the candidate."""
    np.matmul(h, u, out=room)
    both, c, more = gates[:2], gates[2], room[2]
    both += room[:2]
    np.tanh(both, out=both)
    both += ONE
    both *= HALF
    more *= both[1]
    c += more
    np.tanh(c, out=c)
    new = c - h
    new *= both[0]
    new += h
    return new


def _ends(part: np.ndarray, end: int) -> list[np.ndarray]:
    """For each step the lanes whose text ends there."""
    step, lane = np.nonzero(part == end)
    edges = np.searchsorted(step, np.arange(len(part) + 1)).tolist()
    return [lane[a:b] for a, b in zip(edges, edges[1:])]


class Weights:
    """All parameters of a model in one vector, with views of its parts, laid out as products take them: gates one after
    another, and the biases of outputs as a further row of their weights, met by a further 1 in each state."""

    def __init__(self, p: dict[str, np.ndarray]):
        (tokens, n), (classes, _, members) = p["embed"].shape, p["wm"].shape
        shapes = {"embed": (tokens, n), "wx": (3, n, n), "bx": (3, 1, n), "u": (3, n, n), "wc": (n + 1, classes + 1), "wm": (classes, n + 1, members)}
        sizes = [int(np.prod(shape)) for shape in shapes.values()]
        self.all = np.zeros(sum(sizes), F32)
        self.part = {name: v.reshape(shape) for (name, shape), v in zip(shapes.items(), np.split(self.all, np.cumsum(sizes)[:-1]))}
        self.own = p
        for v, name in self._pairs():
            v[...] = p[name] if v.ndim == p[name].ndim else _three(p[name])

    def _pairs(self) -> list[tuple[np.ndarray, str]]:
        q = self.part
        return [
            (q["embed"], "embed"), (q["wx"], "wx"), (q["bx"], "bx"), (q["u"], "u"), (q["wc"][:-1], "wc"), (q["wc"][-1], "bc"),
            (q["wm"][:, :-1], "wm"), (q["wm"][:, -1], "bm"),
        ]

    def put_back(self) -> None:
        for v, name in self._pairs():
            self.own[name][...] = v if v.ndim == self.own[name].ndim else v.swapaxes(0, 1).reshape(self.own[name].shape)


@dataclass
class GatedModel:
    """Parameters by name; ``words`` is the number of words with an id, and id ``classes * members`` is every other word."""

    classes: int
    members: int
    end: int
    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, counts: np.ndarray, others: int, classes: int, members: int, end: int, size: int, seed: int = 0) -> GatedModel:
        """Random recurrent weights, and output biases that give each word its share of all tokens."""
        rng = np.random.default_rng(seed)
        full = np.zeros(classes * members)
        full[: len(counts)] = counts
        grid = full.reshape(classes, members)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(size)).astype(F32)
        mass = np.append(grid.sum(axis=1), others)
        with np.errstate(divide="ignore"):
            return cls(classes, members, end, {
                "embed": draw(classes * members + 1, size), "wx": draw(size, 3 * size), "bx": np.zeros(3 * size, F32),
                "u": draw(size, 3 * size), "wc": np.zeros((size, classes + 1), F32),
                "bc": np.maximum(np.log(mass / max(mass.sum(), 1)), OFF).astype(F32),
                "wm": np.zeros((classes, size, members), F32),
                "bm": np.maximum(np.log(grid / np.maximum(grid.sum(axis=1, keepdims=True), 1)), OFF).astype(F32),
            })

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def with_flat(self, values: np.ndarray) -> GatedModel:
        at, p = 0, {}
        for name, v in self.p.items():
            p[name] = values[at : at + v.size].reshape(v.shape).astype(F32)
            at += v.size
        return GatedModel(self.classes, self.members, self.end, p)

    def _outputs(self, h: np.ndarray, ids: np.ndarray, w: dict[str, np.ndarray], grad: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probabilities of ``ids``, which ascend, after states ``h`` (with their 1); with ``grad``, the gradients of
        output weights are set and those of h returned."""
        kind = ids // self.members
        row = np.arange(len(ids))
        edges = np.searchsorted(kind, np.arange(self.classes + 1)).tolist()
        known = edges[-1]  # the class of all other words comes last
        classes = [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
        d = h @ w["wc"]
        chosen = row * d.shape[1] + kind
        out, whole = _shares(d, chosen)
        back = None
        if grad is not None:
            d /= whole[:, None]
            d.ravel()[chosen] -= 1
            np.matmul(h.T, d, out=grad["wc"])
            back = d @ w["wc"][:-1].T
        inner = np.empty((known, self.members), F32)
        for k, a, b in classes:
            np.matmul(h[a:b], w["wm"][k], out=inner[a:b])
        chosen = row[:known] * self.members + (ids[:known] - kind[:known] * self.members)
        logs, whole = _shares(inner, chosen)
        out[:known] += logs
        if grad is not None:
            inner /= whole[:, None]
            inner.ravel()[chosen] -= 1
            more = np.empty((known, h.shape[1] - 1), F32)
            for k, a, b in classes:
                np.matmul(h[a:b].T, inner[a:b], out=grad["wm"][k])
                np.matmul(inner[a:b], w["wm"][k, :-1].T, out=more[a:b])
            back[:known] += more
        return out, back

    def score(self, ids: np.ndarray, first: np.ndarray, least: int = 32, most: int = 512, batch: int = 16_384) -> np.ndarray:
        """Natural log-probability of each text ``ids[first[t]:first[t + 1]]``, as a sum of doubles."""
        lengths = np.diff(first)
        total = np.zeros(len(lengths))
        if not len(ids):
            return total
        lanes = int(np.clip(len(ids) // max(int(lengths.max()), 1), least, most))
        tokens, owner = lay_out(ids, first, lanes)
        w = Weights(self.p).part
        n = len(w["u"][0])
        table, u = _halved(w["embed"] @ w["wx"] + w["bx"]), _halved(w["u"])
        live = (tokens >= 0).sum(axis=1)
        h = np.zeros((tokens.shape[1], n), F32)
        room = np.empty((3, *h.shape), F32)
        window = max(WINDOW, batch // tokens.shape[1])
        for at in range(0, len(tokens), window):
            part = tokens[at : at + window]
            states = np.ones((*part.shape, n + 1), F32)
            for t, (row, over) in enumerate(zip(part, _ends(part, self.end))):
                k = live[at + t]  # lanes run dry from the last on
                h = h[:k]
                states[t, :k, :-1] = h
                h = _step(table.take(row[:k], axis=1), h, u, room[:, :k])
                h[over] = 0
            flat = part.ravel()
            order = _stable_order(flat)[np.count_nonzero(flat < 0) :]
            logs, _ = self._outputs(states.reshape(-1, n + 1).take(order, axis=0), flat[order], w)
            total += np.bincount(owner[at : at + window].ravel()[order], weights=logs, minlength=len(total))
        return total

    @staticmethod
    def _backward(w: dict[str, np.ndarray], steps: tuple[np.ndarray, ...], over: list[np.ndarray], back: np.ndarray, grad: dict[str, np.ndarray]) -> np.ndarray:
        """Gradients of a window's tokens at the gates and the candidate, from those of its states, and that of ``u``, which is set;
        nothing flows into the window before. ``steps``: gates and candidate, what the state added to the candidate, and states."""
        (z, r, c), inner, states = steps
        n = states.shape[-1]
        kept = 1 - z
        # what a new state's gradient is multiplied by, for both gates, for what u adds to the candidate, and for the candidate
        d = np.empty((4, *states.shape), F32)
        np.multiply(z, 1 - c * c, out=d[3])
        np.multiply(d[3], r, out=d[2])
        np.multiply(d[3], inner * (1 - r), out=d[1])
        np.multiply(c - states, z * kept, out=d[0])
        u = np.ascontiguousarray(w["u"].swapaxes(1, 2))
        carry, room = np.zeros(states.shape[1:], F32), np.empty((3, *states.shape[1:]), F32)
        for t in range(len(states) - 1, -1, -1):
            if len(over[t]):
                carry[over[t]] = 0  # the state after an end token is zero whatever came before
            d[:, t] *= carry
            np.matmul(d[:3, t], u, out=room)
            carry *= kept[t]
            carry += room[0]
            carry += room[1]
            carry += room[2]
            carry += back[t]
        d = d.reshape(4, -1, n)
        np.matmul(states.reshape(-1, n).T, d[:3], out=grad["u"])
        d[2] = d[3]
        return d[:3]

    def train(self, ids: np.ndarray, first: np.ndarray, past: dict[str, np.ndarray], rate: float, lanes: int, window: int = WINDOW) -> float:
        """One pass over the texts, an update (Adagrad) for each window. Returns the summed log-probability before each update."""
        tokens, _ = lay_out(ids, first, lanes)
        weights, seen, grads = Weights(self.p), Weights(past), Weights(past)
        w, grad, g, step = weights.part, grads.part, grads.all, np.empty_like(grads.all)
        bounds = [(w["wc"][:-1], True), (w["wm"][:, :-1], True), (w["wc"][-1], False), (w["wm"][:, -1], False)]
        n = len(w["u"][0])
        h = np.zeros((tokens.shape[1], n), F32)
        live = (tokens >= 0).sum(axis=1)
        total = 0.0
        for at in range(0, len(tokens), window):
            part = tokens[at : at + window, : live[at]]
            h = np.ascontiguousarray(h[: live[at]])
            flat = part.ravel()
            order = _stable_order(flat)  # dry lanes, which take part without targets, come first
            own = flat[order]
            dry = np.searchsorted(own, 0)
            new = np.concatenate([[True], own[1:] != own[:-1]])
            begin, place = np.flatnonzero(new), np.empty_like(order)
            place[order] = np.cumsum(new) - 1
            over = _ends(part, self.end)

            embed = w["embed"].take(own[begin], axis=0)
            gates = _halved(embed @ w["wx"] + w["bx"]).take(place.reshape(part.shape), axis=1)
            u = _halved(w["u"].copy())
            states, inner = np.empty((*part.shape, n), F32), np.empty((*part.shape, n), F32)
            room = np.empty((3, *h.shape), F32)
            for t in range(len(part)):
                states[t] = h
                h = _step(gates[:, t], h, u, room)
                inner[t] = room[2]
                if len(over[t]):
                    h[over[t]] = 0

            g.fill(0)
            sorted_states = np.ones((len(own) - dry, n + 1), F32)
            sorted_states[:, :-1] = states.reshape(-1, n).take(order[dry:], axis=0)
            logs, some = self._outputs(sorted_states, own[dry:], w, grad)
            total += float(logs.sum(dtype=float))
            back = np.zeros(states.shape, F32) if dry else np.empty(states.shape, F32)
            back.reshape(-1, n)[order[dry:]] = some
            d = self._backward(w, (gates, inner, states), over, back, grad)
            np.matmul(embed.take(place, axis=0).T, d, out=grad["wx"])
            np.matmul(np.ones((1, len(own)), F32), d, out=grad["bx"])
            dx = np.matmul(d, w["wx"].swapaxes(1, 2))
            dx[0] += dx[1]
            dx[0] += dx[2]
            sums, named = np.add.reduceat(dx[0].take(order, axis=0), begin, axis=0), own[begin] >= 0
            grad["embed"][own[begin][named]] = sums[named]

            g /= F32(len(logs))
            seen.all += np.multiply(g, g, out=step)
            np.sqrt(seen.all, out=step)
            step += F32(1e-6)
            g *= F32(rate)
            g /= step
            weights.all -= g
            for v, weight in bounds:
                limit = BOUND / n if weight else -OFF
                np.clip(v, -limit, limit, out=v)
        weights.put_back()
        seen.put_back()
        return total
