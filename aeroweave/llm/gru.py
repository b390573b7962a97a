"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax, state over windows."""

from __future__ import annotations

import heapq

import numpy as np

HEAD = 4096
CLASSES = 64
SIZE = HEAD // CLASSES
#: Token numbers besides the head words: any other word, and the input before the first token.
RARE, START = HEAD, HEAD + 1
WIDTH = 16
LANES = 256
WINDOW = 32
RATE = 0.01
_NAMES = ("embed", "into", "within", "bias", "classes", "class_bias", "words", "word_bias")


def initial(counts: np.ndarray, rare: float, seed: int = 3) -> dict[str, np.ndarray]:
    """Parameters whose output is the distribution of ``counts`` (head words) and ``rare``, whatever the input."""
    draw = np.random.default_rng(seed)
    full = np.zeros(HEAD)
    full[:len(counts)] = counts
    full += 1e-6
    grouped = full.reshape(CLASSES, SIZE)
    mass = np.append(grouped.sum(1), rare + 1e-3)
    found = {
        "embed": draw.normal(0, 0.3, (HEAD + 2, WIDTH)), "into": draw.normal(0, 0.25, (WIDTH, 3 * WIDTH)),
        "within": draw.normal(0, 0.25, (WIDTH, 3 * WIDTH)), "bias": np.zeros(3 * WIDTH),
        "classes": draw.normal(0, 0.01, (WIDTH, CLASSES + 1)), "class_bias": np.log(mass / mass.sum()),
        "words": draw.normal(0, 0.01, (HEAD, WIDTH)), "word_bias": np.log(grouped / grouped.sum(1, keepdims=True)).ravel(),
    }
    return {k: v.astype(np.float32) for k, v in found.items()}


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in _NAMES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    shapes = [(k, v.shape) for k, v in initial(np.zeros(0), 0).items()]
    ends = np.cumsum([int(np.prod(s)) for _, s in shapes])
    return {k: values[e - int(np.prod(s)):e].reshape(s).astype(np.float32) for (k, s), e in zip(shapes, ends)}


#: Lanes when nothing is learnt, where their number changes no result.
SCORE_LANES = 1024


class Lanes:
    """Documents laid one after another into lanes of about equal length, longest lanes first.

    ``inputs`` and ``targets`` are (step, lane); ``fresh`` marks a document's first step. ``spots`` has each document's lane
    and first step. A lane is never shorter than its longest document, so a document is always whole.
    """

    def __init__(self, docs: list[np.ndarray], lanes: int = LANES):
        sizes = np.array([len(d) for d in docs], np.int64)
        longest = int(sizes.max())
        lanes = int(max(1, min(lanes, 2 * sizes.sum() // longest, len(docs))))
        heap, held = [(0, i) for i in range(lanes)], [[] for _ in range(lanes)]
        for doc in np.argsort(-sizes, kind="stable"):
            size, lane = heapq.heappop(heap)
            held[lane].append((int(doc), size))
            heapq.heappush(heap, (size + int(sizes[doc]), lane))
        totals = np.array([size for size, _ in sorted(heap, key=lambda x: x[1])])
        order = np.argsort(-totals, kind="stable")
        self.totals = totals[order]
        self.inputs = np.full((int(totals.max()), lanes), START, np.int32)
        self.targets = np.full_like(self.inputs, -1)
        self.fresh = np.zeros(self.inputs.shape, bool)
        self.spots = np.zeros((len(docs), 2), np.int64)
        for column, lane in enumerate(order):
            for doc, start in held[lane]:
                stop = start + len(docs[doc])
                self.targets[start:stop, column] = docs[doc]
                self.inputs[start + 1:stop, column] = docs[doc][:-1]
                self.fresh[start, column] = True
                self.spots[doc] = column, start

    def windows(self, window: int = WINDOW):
        for start in range(0, len(self.inputs), window):
            active = int((self.totals > start).sum())
            rows = slice(start, start + window)
            yield rows, active, self.inputs[rows, :active], self.targets[rows, :active], self.fresh[rows, :active]


def _sigmoid(x: np.ndarray) -> None:
    """In place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += 1
    x *= np.float32(0.5)


def drives(p: dict) -> np.ndarray:
    """What each token number adds to the gates and the candidate."""
    return p["embed"] @ p["into"] + p["bias"]


def forward(p: dict, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, table: np.ndarray | None = None):
    """States after each step of a window, from the state before it, the last of them, and what the way back needs.

    ``table`` are the parameters' :func:`drives`, where they are used for many windows.
    """
    drive = (drives(p) if table is None else table)[inputs]
    shape, within = inputs.shape, p["within"]
    before, new, states = (np.empty((*shape, WIDTH), np.float32) for _ in range(3))
    push, gates = np.empty((*shape, 3 * WIDTH), np.float32), np.empty((*shape, 2 * WIDTH), np.float32)
    live, any_fresh = (~fresh).astype(np.float32)[:, :, None], fresh.any(1)
    for t in range(len(inputs)):
        b, g, n, s = before[t], gates[t], new[t], states[t]
        if any_fresh[t]:
            np.multiply(state, live[t], out=b)
        else:
            b[...] = state
        np.matmul(b, within, out=push[t])
        np.add(drive[t, :, :2 * WIDTH], push[t, :, :2 * WIDTH], out=g)
        _sigmoid(g)
        np.multiply(g[:, WIDTH:], push[t, :, 2 * WIDTH:], out=n)
        n += drive[t, :, 2 * WIDTH:]
        np.tanh(n, out=n)
        np.subtract(b, n, out=s)
        s *= g[:, :WIDTH]
        s += n
        state = s
    return states, state.copy(), (before, push[:, :, 2 * WIDTH:], gates[:, :, :WIDTH], gates[:, :, WIDTH:], new)


#: Rows of a class that are multiplied together.
BLOCK = 32


def _bounded(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no state within (-1, 1) can give a logit whose exponential overflows."""
    return float((np.abs(weights).sum(0) + np.abs(bias)).max()) < 60


def _powers(logits: np.ndarray, bounded: bool) -> np.ndarray:
    """Exponentials, in the place of the logits."""
    if not bounded:
        np.minimum(logits, 60, out=logits)
    return np.exp(logits, out=logits)


#: Rows whose logits are held at a time, so that they stay in the processor's cache.
ROWS_AT_ONCE = 2048


def _log_chosen(states, weights, bias, chosen: np.ndarray) -> np.ndarray:
    """Log of the softmax at one column of each row."""
    bounded, out = _bounded(weights, bias), np.empty(len(states), states.dtype)
    for start in range(0, len(states), ROWS_AT_ONCE):
        rows = slice(start, start + ROWS_AT_ONCE)
        logits = states[rows] @ weights
        logits += bias
        if not bounded:
            np.minimum(logits, 60, out=logits)
        own = logits[np.arange(len(logits)), chosen[rows]]
        out[rows] = own - np.log(np.exp(logits, out=logits).sum(1))
    return out


def _softmax_error(states, weights, bias, chosen: np.ndarray, share) -> np.ndarray:
    """Gradient of the negative log of the softmax at the chosen column, times ``share``."""
    logits = states @ weights
    logits += bias
    powers = _powers(logits, _bounded(weights, bias))
    powers *= share / powers.sum(1, keepdims=True)
    powers[np.arange(len(chosen)), chosen] -= share
    return powers


def _by_class(targets: np.ndarray):
    """(class, rows) of the head words among ``targets``."""
    kinds = np.where(targets < HEAD, targets // SIZE, CLASSES)
    order = np.argsort(kinds, kind="stable")
    cuts = np.searchsorted(kinds[order], np.arange(CLASSES + 1))
    return kinds, [(k, order[cuts[k]:cuts[k + 1]]) for k in range(CLASSES) if cuts[k] < cuts[k + 1]]


def log_probability(p: dict, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of the class's probability times, for head words, that of the word in its class."""
    kinds, groups = _by_class(targets)
    out = _log_chosen(states, p["classes"], p["class_bias"], kinds)
    for k, rows in groups:
        part = slice(k * SIZE, (k + 1) * SIZE)
        out[rows] += _log_chosen(states[rows], p["words"][part].T, p["word_bias"][part], targets[rows] % SIZE)
    return out


def _word_gradients(p: dict, h: np.ndarray, y: np.ndarray, kinds: np.ndarray, share, grad: dict, dh: np.ndarray) -> None:
    """Adds the part of the words within their classes, for the head words among ``y``.

    Words of a class are cut into blocks of BLOCK rows, the last one filled up with zeros, and all blocks multiplied at once.
    """
    head = np.flatnonzero(y < HEAD)
    if not len(head):
        return
    order = head[np.argsort(kinds[head], kind="stable")]
    counts = np.bincount(kinds[order], minlength=CLASSES)
    blocks = -(-counts // BLOCK)
    first = np.cumsum(blocks) - blocks
    of = kinds[order]
    slot = first[of] * BLOCK + np.arange(len(order)) - (np.cumsum(counts) - counts)[of]
    block_class = np.repeat(np.arange(CLASSES), blocks)
    held = np.zeros((len(block_class) * BLOCK, WIDTH), h.dtype)
    held[slot] = h[order]
    held = held.reshape(-1, BLOCK, WIDTH)
    words, bias = p["words"].reshape(CLASSES, SIZE, WIDTH), p["word_bias"].reshape(CLASSES, SIZE)
    logits = held @ words.transpose(0, 2, 1)[block_class]
    logits += bias[block_class][:, None]
    powers = _powers(logits, _bounded(p["words"].T, p["word_bias"])).reshape(-1, SIZE)
    scale = np.zeros(len(powers), powers.dtype)
    scale[slot] = share
    powers *= (scale / powers.sum(1))[:, None]
    powers[slot, y[order] % SIZE] -= share
    error = powers.reshape(-1, BLOCK, SIZE)
    used = np.flatnonzero(blocks)
    grad["words"].reshape(CLASSES, SIZE, WIDTH)[used] = np.add.reduceat(error.transpose(0, 2, 1) @ held, first[used], axis=0)
    grad["word_bias"].reshape(CLASSES, SIZE)[used] = np.add.reduceat(error.sum(1), first[used], axis=0)
    dh[order] += (error @ words[block_class]).reshape(-1, WIDTH)[slot]


def gradients(p: dict, inputs, targets, fresh, state) -> tuple[dict, np.ndarray]:
    """Gradients of the mean negative log-probability of a window, and the state after it; no gradient enters earlier windows."""
    states, last, trace = forward(p, inputs, fresh, state)
    valid = targets >= 0
    h, y = states[valid], targets[valid]
    share = np.float32(1 / max(1, len(y)))
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    kinds = np.where(y < HEAD, y // SIZE, CLASSES)
    dh, onto = np.empty_like(h), np.ascontiguousarray(p["classes"].T)
    for start in range(0, len(y), ROWS_AT_ONCE):
        rows = slice(start, start + ROWS_AT_ONCE)
        error = _softmax_error(h[rows], p["classes"], p["class_bias"], kinds[rows], share)
        grad["classes"] += h[rows].T @ error
        grad["class_bias"] += error.sum(0)
        np.matmul(error, onto, out=dh[rows])
    _word_gradients(p, h, y, kinds, share, grad, dh)
    every = np.zeros_like(states)
    every[valid] = dh
    # how a change of a state changes its gates and its candidate; only the chain over steps is a loop
    before, push, hold, reset, new = trace
    kept = 1 - hold
    by_new = kept * (1 - new * new)
    by_push = np.empty((*states.shape[:2], 3, WIDTH), states.dtype)
    np.multiply((before - new) * hold, kept, out=by_push[:, :, 0])
    np.multiply(by_new, reset, out=by_push[:, :, 2])
    np.multiply(by_push[:, :, 2] * push, 1 - reset, out=by_push[:, :, 1])
    back, live = np.ascontiguousarray(p["within"].T), (~fresh).astype(np.float32)[:, :, None]
    carried = np.zeros_like(last)
    for t in range(len(inputs) - 1, -1, -1):
        d = every[t]
        d += carried
        by_push[t] *= d[:, None]  # from here on, the gradient itself
        carried = by_push[t].reshape(len(d), -1) @ back
        carried += d * hold[t]
        carried *= live[t]
    rows = by_push.reshape(-1, 3 * WIDTH)
    grad["within"] = before.reshape(-1, WIDTH).T @ rows
    np.multiply(every, by_new, out=by_push[:, :, 2])
    x = p["embed"][inputs].reshape(-1, WIDTH)
    grad["into"], grad["bias"] = x.T @ rows, rows.sum(0)
    sent, ids = rows @ p["into"].T, inputs.ravel()
    for j in range(WIDTH):
        grad["embed"][:, j] = np.bincount(ids, sent[:, j], HEAD + 2)
    return grad, last


class Trainer:
    """Adam over windows; the state is carried from window to window of the same lanes."""

    def __init__(self, params: dict):
        self.params = {k: v.copy() for k, v in params.items()}
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}
        self.steps = self.tokens = 0

    def learn(self, docs: list[np.ndarray]) -> None:
        if not docs:
            return
        lanes = Lanes(docs)
        state = np.zeros((lanes.inputs.shape[1], WIDTH), np.float32)
        for _, active, inputs, targets, fresh in lanes.windows():
            grad, state = gradients(self.params, inputs, targets, fresh, state[:active])
            self.steps += 1
            self.tokens += int((targets >= 0).sum())
            rate = RATE * min(1.0, self.steps / 20) * (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
            for k, g in grad.items():
                self.mean[k] += 0.1 * (g - self.mean[k])
                self.square[k] += 0.001 * (g * g - self.square[k])
                self.params[k] -= rate * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)


#: Steps whose states wait until the softmax is taken of all of them, class by class.
SCORED_AT_ONCE = 131_072


def score(params: dict, docs: list[np.ndarray], table: np.ndarray | None = None) -> np.ndarray:
    """Natural log-probability of each whole document, the words inside the rare class left out."""
    if not docs:
        return np.zeros(0)
    table = drives(params) if table is None else table
    lanes = Lanes(docs, SCORE_LANES)
    sums = np.zeros(lanes.inputs.shape, np.float32)
    state = np.zeros((lanes.inputs.shape[1], WIDTH), np.float32)
    waiting, size = [], 0

    def settle():
        found = log_probability(params, np.concatenate([h for _, _, _, h, _ in waiting]), np.concatenate([y for *_, y in waiting]))
        start = 0
        for rows, active, valid, h, _ in waiting:
            part = np.zeros(valid.shape, np.float32)
            part[valid] = found[start:start + len(h)]
            sums[rows, :active] = part
            start += len(h)

    for rows, active, inputs, targets, fresh in lanes.windows():
        states, state, _ = forward(params, inputs, fresh, state[:active], table=table)
        valid = targets >= 0
        waiting.append((rows, active, valid, states[valid], targets[valid]))
        size += len(waiting[-1][3])
        if size >= SCORED_AT_ONCE:
            settle()
            waiting, size = [], 0
    if waiting:
        settle()
    return np.array([sums[start:start + len(d), lane].sum(dtype=np.float64) for d, (lane, start) in zip(docs, lanes.spots)])
