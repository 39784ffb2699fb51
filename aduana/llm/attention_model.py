"""A causal self-attention model over a small set of symbols, in numpy: forward, gradients, local training, scoring."""

from __future__ import annotations

import math

import numpy as np

#: Output symbols are chosen in two steps: a group, then a member of it.
GROUPS = 32
MEMBERS = 32
SYMBOLS = GROUPS * MEMBERS
#: The input has one more symbol, which stands before a text.
START = SYMBOLS
WIDTH = 32
#: Positions of a window, and how far windows advance: all but the first score their last `STRIDE` positions.
CONTEXT = 32
STRIDE = 24
_SHAPES = {
    "embed": (SYMBOLS + 1, WIDTH), "place": (CONTEXT, WIDTH), "match": (WIDTH, WIDTH), "value": (WIDTH, WIDTH),
    "group": (GROUPS, WIDTH), "group_bias": (GROUPS,), "member": (GROUPS, MEMBERS, WIDTH), "member_bias": (GROUPS, MEMBERS),
}
_FUTURE = np.triu(np.full((CONTEXT, CONTEXT), -1e9, np.float32), 1)
_PAST = np.tril(np.ones((CONTEXT, CONTEXT), np.float32))
#: Exponentials of values up to this are added in single precision without overflow or underflow.
_MODERATE = 40.0
#: Windows whose gradients are computed at once.
_AT_ONCE = 192

Parameters = dict[str, np.ndarray]


def initial(shares: np.ndarray) -> Parameters:
    """Small random weights; the biases start at the symbols' shares, a model without context."""
    rng = np.random.default_rng(7)
    drawn = {k: (rng.normal(size=s) * 0.3 / np.sqrt(s[-1])).astype(np.float32) for k, s in _SHAPES.items()}
    table = shares.reshape(GROUPS, MEMBERS)
    return drawn | {
        "embed": drawn["embed"] * 3, "group_bias": np.log(table.sum(1)).astype(np.float32),
        "member_bias": np.log(table / table.sum(1, keepdims=True)).astype(np.float32)}


def packed(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _SHAPES])


def unpacked(flat: np.ndarray) -> Parameters:
    out, at = {}, 0
    for k, s in _SHAPES.items():
        out[k] = flat[at:at + int(np.prod(s))].reshape(s)
        at += int(np.prod(s))
    return out


class Room:
    """Arrays kept by name from call to call. Fresh arrays of this size are handed back to the system after each use and come
    back page by page, which costs a kernel as much time as its work."""

    def __init__(self, kind: np.dtype | type = np.float32):
        self.kind, self.kept = kind, {}

    def __call__(self, name: str, *shape: int, kind: type | None = None) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or len(self.kept[name]) < size:
            self.kept[name] = np.empty(size, kind or self.kind)
        return self.kept[name][:size].reshape(shape)


def loss_and_gradients(p: Parameters, symbols: np.ndarray, targets: np.ndarray, weight: np.ndarray,
                       n: float | None = None, room: Room | None = None) -> tuple[float, Parameters]:
    """Mean negative log probability of the targets, and its gradients. Arrays are windows x CONTEXT. `n` is the weight of
    which these windows are a part, if they are not all. With a `room`, gradients hold until its next use."""
    room = Room(p["embed"].dtype) if room is None else room
    scale = np.float32(WIDTH ** -0.5)
    size, shape, wide = symbols.size, (*symbols.shape, WIDTH), (*symbols.shape, 2 * WIDTH)
    grads = {k: room("d " + k, *s) for k, s in _SHAPES.items()}
    own_symbol = symbols.ravel()
    flat_x = np.take(p["embed"], own_symbol, 0, out=room("x", size, WIDTH), mode="clip")
    x = flat_x.reshape(shape)
    x += p["place"]
    # Matches and values by one product.
    both = np.concatenate([p["match"] * scale, p["value"]], 1)
    qv = np.matmul(flat_x, both, out=room("qv", size, 2 * WIDTH)).reshape(wide)
    q, v = qv[..., :WIDTH], qv[..., WIDTH:]
    a = _attention(np.matmul(q, x.transpose(0, 2, 1), out=room("a", *symbols.shape, CONTEXT)))
    h = np.matmul(a, v, out=room("h", *shape))
    h += x
    # Rows in the order of their groups, so that each group is a slice; what is done row by row covers all groups at once.
    order, slices = _group_slices(targets.ravel() // MEMBERS)
    group, member = np.divmod(targets.ravel()[order], MEMBERS)
    h = np.take(h.reshape(-1, WIDTH), order, 0, out=room("sorted h", size, WIDTH), mode="clip")
    counted = weight.ravel()[order]
    n = max(float(counted.sum()), 1.0) if n is None else n
    share = counted / np.float32(n)
    each, ones = np.arange(size), np.ones(size, np.float32)
    chance = np.matmul(h, p["group"].T, out=room("chance", size, GROUPS))
    chance += p["group_bias"]
    _softmax(chance)
    own = np.log(chance[each, group])
    chance[each, group] -= 1
    chance *= share[:, None]
    np.matmul(chance.T, h, out=grads["group"])
    np.matmul(ones, chance, out=grads["group_bias"])
    dh = np.matmul(chance, p["group"], out=room("sorted dh", size, WIDTH))
    inner = np.take(p["member_bias"], group, 0, out=room("inner", size, MEMBERS), mode="clip")
    for g, rows in slices:
        inner[rows] += h[rows] @ p["member"][g].T
    _softmax(inner)
    own += np.log(inner[each, member])
    inner[each, member] -= 1
    inner *= share[:, None]
    grads["member"][:] = 0
    grads["member_bias"][:] = 0
    for g, rows in slices:
        part = inner[rows]
        np.matmul(part.T, h[rows], out=grads["member"][g])
        np.matmul(ones[rows], part, out=grads["member_bias"][g])
        dh[rows] += part @ p["member"][g]
    sorted_dh, dh = dh, room("dh", size, WIDTH)
    dh[order] = sorted_dh
    dh = dh.reshape(shape)
    dqv = room("dqv", *wide)
    np.matmul(a.transpose(0, 2, 1), dh, out=dqv[..., WIDTH:])
    ds = np.matmul(dh, v.transpose(0, 2, 1), out=room("ds", *symbols.shape, CONTEXT))
    ds -= np.einsum("ijk,ijk->ij", ds, a)[..., None]
    ds *= a
    np.matmul(ds, x, out=dqv[..., :WIDTH])
    dx = np.matmul(ds.transpose(0, 2, 1), q, out=room("dx", *shape))
    dx += dh
    dqv, flat_dx = dqv.reshape(-1, 2 * WIDTH), dx.reshape(-1, WIDTH)
    flat_dx += np.matmul(dqv, both.T, out=room("dx of both", size, WIDTH))
    d_both = flat_x.T @ dqv
    np.multiply(d_both[:, :WIDTH], scale, out=grads["match"])
    grads["value"][:] = d_both[:, WIDTH:]
    np.sum(dx, 0, out=grads["place"])
    grads["embed"][:] = 0
    place = np.add(own_symbol[:, None] * WIDTH, np.arange(WIDTH), out=room("place", size, WIDTH, kind=np.int64))
    np.add.at(grads["embed"].reshape(-1), place.ravel(), flat_dx.ravel())
    return -float((own * counted).sum()) / n, grads


def _moderate(z: np.ndarray) -> bool:
    """Whether exponentials of all values can be added up as they are; if not, rows are first drawn to their largest."""
    return not z.size or bool(z.max() < _MODERATE and z.min() > -_MODERATE)


def _row_sums(z: np.ndarray) -> np.ndarray:
    """Sums of rows, as a product, which is several times faster than a sum over a short axis."""
    return (z.reshape(-1, z.shape[-1]) @ np.ones(z.shape[-1], np.float32)).reshape(*z.shape[:-1], 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    """Of rows, in place."""
    if not _moderate(z):
        z -= z.max(-1, keepdims=True)
    np.exp(z, out=z)
    z /= _row_sums(z)
    return z


def _attention(s: np.ndarray) -> np.ndarray:
    """Softmax, in place, of each position over itself and those before it; positions are the last ones of a window."""
    if not _moderate(s):
        s += _FUTURE[-s.shape[1]:]
        return _softmax(s)
    np.exp(s, out=s)
    s *= _PAST[-s.shape[1]:]
    s /= _row_sums(s)
    return s


def _group_slices(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of rows by group, and within it the slice of each group that occurs."""
    order = np.argsort(group.astype(np.uint8), kind="stable")
    bounds = np.append(0, np.cumsum(np.bincount(group, minlength=GROUPS)))
    return order, [(g, slice(bounds[g], bounds[g + 1])) for g in range(GROUPS) if bounds[g] < bounds[g + 1]]


def train_locally(p: Parameters, symbols: np.ndarray, targets: np.ndarray, weight: np.ndarray, rate: float, seed: int,
                  steps: int, batch: int = 48) -> Parameters:
    """`steps` adaptive-moment steps over windows in random order, with a falling rate."""
    flat = packed(p).astype(np.float32)
    mean, square, g = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    at, sums, room = unpacked(flat), unpacked(g), Room()
    rng = np.random.default_rng(seed)
    order = np.concatenate([rng.permutation(len(symbols)) for _ in range(steps * batch // len(symbols) + 1)])
    change = np.empty_like(flat)
    for t in range(steps):
        rows = order[t * batch:(t + 1) * batch]
        # Gradients of a batch are added up over parts, which bound the arrays.
        n = max(float(weight[rows].sum()), 1.0)
        g[:] = 0
        for k in range(0, len(rows), _AT_ONCE):
            own = rows[k:k + _AT_ONCE]
            for name, gradient in loss_and_gradients(at, symbols[own], targets[own], weight[own], n, room)[1].items():
                sums[name] += gradient
        g *= np.float32(min(1.0, 1.0 / (float(np.sqrt(g @ g)) + 1e-9)))
        mean *= np.float32(0.9)
        mean += np.multiply(g, np.float32(0.1), out=change)
        np.square(g, out=g)
        square *= np.float32(0.99)
        square += np.multiply(g, np.float32(0.01), out=change)
        now = rate * min(1.0, (t + 1) / 20) * (1 - 0.7 * t / steps)
        np.sqrt(square, out=g)
        g *= np.float32((1 - 0.99 ** (t + 1)) ** -0.5)
        g += np.float32(1e-8)
        np.divide(mean, g, out=g)
        g *= np.float32(now / (1 - 0.9 ** (t + 1)))
        flat -= g
    return unpacked(flat)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For consecutive sequences: text, first position and first scored position of the windows that score every
    position of every sequence exactly once."""
    count = 1 + np.maximum(0, -(-(lengths - CONTEXT) // STRIDE))
    text = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, number * STRIDE, np.where(number == 0, 0, number * STRIDE + CONTEXT - STRIDE)


class Scorer:
    """Scores sequences; what depends on a symbol or a position only is looked up, not multiplied again."""

    def __init__(self, p: Parameters):
        scale = np.float32(WIDTH ** -0.5)
        self.of_symbol, self.of_place = (
            np.concatenate([p[k], p[k] @ p["match"] * scale, p[k] @ p["value"]], 1).astype(np.float32) for k in ("embed", "place"))
        # A constant input carries the biases.
        self.group = np.ascontiguousarray(np.concatenate([p["group"], p["group_bias"][:, None]], 1).T, dtype=np.float32)
        self.member = np.ascontiguousarray(
            np.concatenate([p["member"], p["member_bias"][..., None]], 2).transpose(0, 2, 1), dtype=np.float32)

    def log_probabilities(self, symbols: np.ndarray, bounds: np.ndarray, at_once: int = 192) -> np.ndarray:
        """Natural log probability of each symbol of consecutive sequences, given those before it."""
        result, room = np.zeros(len(symbols)), Room()
        lengths = np.diff(bounds)
        text, first, scored = windows(lengths)
        inputs = np.empty(len(symbols) + 1, np.int32)
        inputs[1:] = symbols
        inputs[bounds[:-1]] = START
        # Positions before a window's first scored one are only looked back at.
        for lead in (0, CONTEXT - STRIDE):
            alike = np.flatnonzero(scored - first == lead)
            for k in range(0, len(alike), at_once):
                t, a = text[alike[k:k + at_once]], first[alike[k:k + at_once]]
                self._score(symbols, inputs, bounds[t] + a, lengths[t] - a, lead, room, result)
        return result

    def _score(self, symbols: np.ndarray, inputs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lead: int, room: Room,
               result: np.ndarray) -> None:
        """Write the log probabilities of windows, of which the first `lead` positions are scored elsewhere."""
        position = np.minimum(starts[:, None] + np.arange(CONTEXT), len(symbols))
        looked_up = np.take(self.of_symbol, inputs[position].ravel(), 0, out=room("looked up", position.size, 3 * WIDTH), mode="clip")
        looked_up = looked_up.reshape(*position.shape, 3 * WIDTH)
        looked_up += self.of_place
        x, q, v = looked_up[..., :WIDTH], looked_up[:, lead:, WIDTH:2 * WIDTH], looked_up[..., 2 * WIDTH:]
        a = _attention(np.matmul(q, x.transpose(0, 2, 1), out=room("a", len(starts), CONTEXT - lead, CONTEXT)))
        h = np.matmul(a, v, out=room("h", len(starts), CONTEXT - lead, WIDTH))
        h += x[:, lead:]
        rows = np.flatnonzero(np.arange(lead, CONTEXT) < lengths[:, None])
        own = position[:, lead:].ravel()[rows]
        order, slices = _group_slices(symbols[own] // MEMBERS)
        rows, own = rows[order], own[order]
        group, member = np.divmod(symbols[own], MEMBERS)
        wide = room("wide", len(rows), WIDTH + 1)
        wide[:, :WIDTH] = np.take(h.reshape(-1, WIDTH), rows, 0, out=room("sorted h", len(rows), WIDTH), mode="clip")
        wide[:, WIDTH] = 1
        logs = _chosen_log(np.matmul(wide, self.group, out=room("group", len(rows), GROUPS)), group)
        inner = room("inner", len(rows), MEMBERS)
        for g, part in slices:
            np.matmul(wide[part], self.member[g], out=inner[part])
        result[own] = logs + _chosen_log(inner, member)


def _chosen_log(z: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of the chosen column's share after a softmax."""
    each = np.arange(len(z))
    out = z[each, chosen]
    if not _moderate(z):
        largest = z.max(-1, keepdims=True)
        z -= largest
        out -= largest[:, 0]
    np.exp(z, out=z)
    return out - np.log(_row_sums(z)[:, 0])
