"""A small causal self-attention model in numpy.

One attention layer and one feed-forward layer over unit embeddings; the output is a softmax over
groups of units and one over the units of a group, so a unit costs two short sums. All arrays are
float32. Gradients are written out; Adam takes the steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH = 24
#: Units of a window, and how many of them a later window only has as context.
WINDOW = 48
OVERLAP = 8
#: Windows of a training step, and those that are scored at once.
BATCH = 64
SCORED = 256

Params = dict[str, np.ndarray]


@dataclass
class Shape:
    groups: int
    slots: int

    @property
    def units(self) -> int:
        return self.groups * self.slots


def initial(shape: Shape, log_group: np.ndarray, log_slot: np.ndarray, seed: int = 7) -> Params:
    """Small random weights; output biases from the corpus's unit frequencies."""
    rng = np.random.default_rng(seed)
    d = WIDTH
    draw = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
    return {
        "embed": draw(shape.units + 1, d, scale=0.3),  # the last row starts a text
        "place": draw(WINDOW, d, scale=0.05),
        "qkv": draw(d, 3 * d, scale=d**-0.5),
        "mix": draw(d, d, scale=0.5 * d**-0.5),
        "up": draw(d, 2 * d, scale=d**-0.5),
        "down": draw(2 * d, d, scale=0.5 * d**-0.5),
        "group": draw(d, shape.groups, scale=0.1),
        "group_bias": log_group.astype(np.float32),
        "slot": draw(shape.groups, d, shape.slots, scale=0.1),
        "slot_bias": log_slot.astype(np.float32),
    }


_MASK = np.where(np.tril(np.ones((WINDOW, WINDOW))) > 0, 0, -1e9).astype(np.float32)


def hidden(p: Params, x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Last layer for windows of units, and what the gradients need. x: windows by places."""
    n, d = x.shape[1], WIDTH
    flat = lambda a: a.reshape(-1, a.shape[-1])
    h0 = p["embed"][x]
    h0 += p["place"][:n]
    q, k, v = np.split((flat(h0) @ p["qkv"]).reshape(*x.shape, 3 * d), 3, axis=2)
    weights = q @ k.transpose(0, 2, 1)
    weights *= d**-0.5
    weights += _MASK[:n, :n]
    weights -= weights.max(axis=2, keepdims=True)
    np.exp(weights, out=weights)
    weights /= weights.sum(axis=2, keepdims=True)
    mixed = weights @ v
    h1 = (flat(mixed) @ p["mix"]).reshape(h0.shape)
    h1 += h0
    up = flat(h1) @ p["up"]
    np.maximum(up, 0, out=up)
    h2 = (up @ p["down"]).reshape(h0.shape)
    h2 += h1
    return h2, (h0, q, k, v, weights, mixed, h1, up)


def log_sum(z: np.ndarray) -> np.ndarray:
    top = z.max(axis=1, keepdims=True)
    return np.log(np.exp(z - top).sum(axis=1)) + top[:, 0]


def log_probabilities(p: Params, h: np.ndarray, y: np.ndarray, slots: int) -> np.ndarray:
    """Natural log probability of each unit y (flat) from the last layer (flat rows)."""
    group, slot = np.divmod(y, slots)
    z = h @ p["group"] + p["group_bias"]
    out = z[np.arange(len(y)), group] - log_sum(z)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(len(p["group_bias"]) + 1))
    for g in np.flatnonzero(np.diff(bounds)):
        at = order[bounds[g] : bounds[g + 1]]
        z = h[at] @ p["slot"][g] + p["slot_bias"][g]
        out[at] += z[np.arange(len(at)), slot[at]] - log_sum(z)
    return out


def _soften(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Losses of the targets, one a row; `z` becomes the gradient of their mean."""
    rows, n = np.arange(len(target)), len(target)
    z -= z.max(axis=1, keepdims=True)
    own = z[rows, target]
    np.exp(z, out=z)
    total = z.sum(axis=1)
    z *= (1 / (n * total))[:, None]
    z[rows, target] -= 1 / n
    return np.log(total) - own


def gradients(p: Params, x: np.ndarray, y: np.ndarray, valid: np.ndarray, slots: int) -> tuple[float, Params]:
    """Mean loss over valid places, and its gradients."""
    h2, (h0, q, k, v, weights, mixed, h1, up) = hidden(p, x)
    d, places = WIDTH, np.flatnonzero(valid.ravel())
    target = y.ravel()[places]
    order = np.argsort(target.astype(np.uint16), kind="stable")  # by group, then slot
    places, target = places[order], target[order]
    h = h2.reshape(-1, d)[places]
    g: Params = {name: np.zeros_like(p[name]) for name in ("embed", "place", "slot", "slot_bias")}
    group, slot = np.divmod(target, slots)
    z = h @ p["group"]
    z += p["group_bias"]
    loss = _soften(z, group)
    g["group"], g["group_bias"] = h.T @ z, z.sum(axis=0)
    dh = z @ p["group"].T
    # The softmax over slots is one for all groups; only products with a group's own weights go group by group.
    bounds = np.searchsorted(group, np.arange(len(p["group_bias"]) + 1))
    there = np.flatnonzero(np.diff(bounds))
    z = p["slot_bias"][group]
    for c in there:
        a, b = bounds[c], bounds[c + 1]
        z[a:b] += h[a:b] @ p["slot"][c]
    loss += _soften(z, slot)
    g["slot_bias"][there] = np.add.reduceat(z, bounds[there], axis=0)
    for c in there:
        a, b = bounds[c], bounds[c + 1]
        g["slot"][c] = h[a:b].T @ z[a:b]
        dh[a:b] += z[a:b] @ p["slot"][c].T
    dh2 = np.zeros((h2.size // d, d), h2.dtype)
    dh2[places] = dh

    flat = lambda a: a.reshape(-1, a.shape[-1])
    g["down"] = flat(up).T @ dh2
    dup = dh2 @ p["down"].T
    dup *= flat(up) > 0
    g["up"] = flat(h1).T @ dup
    dh1 = dup @ p["up"].T
    dh1 += dh2
    g["mix"] = flat(mixed).T @ dh1
    dmixed = (dh1 @ p["mix"].T).reshape(mixed.shape)
    dscores = dmixed @ v.transpose(0, 2, 1)
    # the sum of the weights' gradients over a row is that of its mixed values'
    dscores -= (dmixed * mixed).sum(axis=2, keepdims=True)
    dscores *= weights
    dscores *= d**-0.5
    dqkv = np.empty((*x.shape, 3 * d), h2.dtype)
    np.matmul(dscores, k, out=dqkv[:, :, :d])
    np.matmul(dscores.transpose(0, 2, 1), q, out=dqkv[:, :, d : 2 * d])
    np.matmul(weights.transpose(0, 2, 1), dmixed, out=dqkv[:, :, 2 * d :])
    g["qkv"] = flat(h0).T @ flat(dqkv)
    dh0 = flat(dqkv) @ p["qkv"].T
    dh0 += dh1
    g["place"][: x.shape[1]] = dh0.reshape(h0.shape).sum(axis=0)
    order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    unit = x.ravel()[order]
    starts = np.flatnonzero(np.diff(unit, prepend=-1))
    g["embed"][unit[starts]] = np.add.reduceat(dh0[order], starts, axis=0)
    return float(loss.mean()), g


def _keep_heap() -> None:
    """Let glibc keep up to twice this block's size of freed memory.

    Until such a block was freed, a step's arrays go back to the system each time and are faulted in anew.
    """
    np.empty(8 << 20, np.uint8)


def fit(p: Params, x: np.ndarray, y: np.ndarray, valid: np.ndarray, slots: int, rate: float, passes: int, seed: int) -> Params:
    """Adam over the windows in random order, `passes` times; the rate falls to a tenth."""
    _keep_heap()
    p = {name: a.copy() for name, a in p.items()}
    first = {name: np.zeros_like(a) for name, a in p.items()}
    second = {name: np.zeros_like(a) for name, a in p.items()}
    rng = np.random.default_rng(seed)
    steps = passes * -(-len(x) // BATCH)
    t = 0
    for _ in range(passes):
        order = rng.permutation(len(x))
        for k in range(0, len(x), BATCH):
            t += 1
            at = order[k : k + BATCH]
            _, g = gradients(p, x[at].astype(np.int32), y[at].astype(np.int32), valid[at], slots)
            now = rate * (1 - 0.9 * t / steps) * min(1, t / 20)
            for name, a in g.items():
                first[name] *= 0.9
                second[name] *= 0.98
                first[name] += 0.1 * a
                a *= a
                a *= 0.02
                second[name] += a
                np.multiply(second[name], 1 / (1 - 0.98**t), out=a)
                np.sqrt(a, out=a)
                a += 1e-6
                np.divide(first[name], a, out=a)
                a *= now / (1 - 0.9**t)
                p[name] -= a
    return p


def windows(sequences: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets, which places count, and each window's sequence.

    Windows overlap; a place that an earlier window has counts there only. The input before the
    first target is `start`.
    """
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    step = WINDOW - OVERLAP
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // step)), 0)
    owner = np.repeat(np.arange(len(sequences)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.concatenate([*sequences, np.zeros(0, np.int64)]).astype(np.int32)
    base = (np.cumsum(lengths) - lengths)[owner]
    place = (number * step)[:, None] + np.arange(WINDOW)[None, :]
    inside = place < lengths[owner][:, None]
    at = np.where(inside, base[:, None] + place, 0)
    y = np.where(inside, flat[at], 0).astype(np.int32) if len(flat) else np.zeros(place.shape, np.int32)
    x = np.where(inside & (place > 0), flat[np.maximum(at - 1, 0)], start).astype(np.int32) if len(flat) else y
    valid = inside & ((number == 0)[:, None] | (np.arange(WINDOW) >= OVERLAP)[None, :])
    return x, y, valid, owner


@dataclass
class Scorer:
    """A model laid out for scoring: no gradients kept, and as few passes over arrays as there can be."""

    p: Params
    slots: int

    def __post_init__(self) -> None:
        p = self.p
        scaled = p["qkv"].copy()
        scaled[:, :WIDTH] *= WIDTH**-0.5
        # h0 is embed + place, so its product with qkv is a sum of two table rows.
        self.token_qkv = p["embed"] @ scaled
        self.place_qkv = p["place"] @ scaled
        self.allowed = np.tril(np.ones((WINDOW, WINDOW), np.float32))
        _keep_heap()

    def last(self, x: np.ndarray) -> np.ndarray:
        p, d = self.p, WIDTH
        qkv = self.token_qkv[x]
        qkv += self.place_qkv
        weights = qkv[:, :, :d] @ qkv[:, :, d : 2 * d].transpose(0, 2, 1)
        np.minimum(weights, 60, out=weights)  # exp stays finite; trained scores are far below
        np.exp(weights, out=weights)
        weights *= self.allowed
        mixed = weights @ qkv[:, :, 2 * d :]
        mixed /= weights.sum(axis=2)[:, :, None]
        h = (mixed.reshape(-1, d) @ p["mix"]).reshape(*x.shape, d)
        h += p["embed"][x]
        h += p["place"]
        h = h.reshape(-1, d)
        up = h @ p["up"]
        np.maximum(up, 0, out=up)
        h += up @ p["down"]
        return h

    def logs(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probability of each unit y from its row of h."""
        p = self.p
        order = np.argsort(y.astype(np.uint16), kind="stable")  # by group, then slot
        h, group, slot = h[order], *np.divmod(y[order], self.slots)
        z = h @ p["group"]
        z += p["group_bias"]
        out = z[np.arange(len(y)), group] - self._log_sum(z)
        bounds = np.searchsorted(group, np.arange(len(p["group_bias"]) + 1))
        for g in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[g], bounds[g + 1]
            z = h[a:b] @ p["slot"][g]
            z += p["slot_bias"][g]
            out[a:b] += z[np.arange(b - a), slot[a:b]] - self._log_sum(z)
        back = np.empty_like(out)
        back[order] = out
        return back

    @staticmethod
    def _log_sum(z: np.ndarray) -> np.ndarray:
        if z.size and z.max() < 60:
            return np.log(np.exp(z).sum(axis=1) + np.float32(1e-37))
        return log_sum(z)

    def score(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each sequence of units."""
        out = np.zeros(len(sequences))
        x, y, valid, owner = windows(sequences, len(self.p["embed"]) - 1)
        for k in range(0, len(x), SCORED):
            places = np.flatnonzero(valid[k : k + SCORED].ravel())
            h = self.last(x[k : k + SCORED])[places]
            logs = self.logs(h, y[k : k + SCORED].ravel()[places])
            np.add.at(out, owner[k : k + SCORED][places // WINDOW], logs)
        return out
