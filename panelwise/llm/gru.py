"""A gated recurrent language model in numpy: truncated backpropagation, class-factored output softmax."""

from __future__ import annotations

import heapq
import math

import numpy as np

HIDDEN, CLASSES, LANES = 16, 64, 512
#: Steps that are prepared at once, and states whose softmax lies in the processor's cache; they change results by rounding only.
STEPS, ROWS = 32, 1024
SHAPES = ("embed", "wx", "wh", "b", "wc", "bc", "wo", "bo")


def classes_of(counts: np.ndarray, rare: float) -> np.ndarray:
    """First word of each class, then the number of words: words in descending count fall into classes of about equal mass.

    The last class is that of all words outside the vocabulary and has one entry.
    """
    share = np.cumsum(counts) / max(counts.sum(), 1)
    label = np.minimum((share * CLASSES).astype(int), CLASSES - 1)
    first = np.flatnonzero(np.diff(label, prepend=-1))
    return np.concatenate([first, [len(counts), len(counts) + 1]])


def start(counts: np.ndarray, rare: float, seed: int = 1) -> dict[str, np.ndarray]:
    """Parameters of a model that gives the unigram distribution whatever its state is."""
    rng, bounds = np.random.default_rng(seed), classes_of(counts, rare)
    mass = np.append(counts, max(rare, 1.0)).astype(float)
    v = len(mass)
    by_class = np.add.reduceat(mass, bounds[:-1])
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "embed": small(v + 1, HIDDEN) * 3, "wx": small(HIDDEN, 3 * HIDDEN) * 3, "wh": small(HIDDEN, 3 * HIDDEN) * 3, "b": np.zeros(3 * HIDDEN, np.float32),
        "wc": np.zeros((HIDDEN, len(by_class)), np.float32), "bc": np.log(by_class / by_class.sum()).astype(np.float32),
        "wo": np.zeros((v, HIDDEN), np.float32), "bo": np.log(mass / np.repeat(by_class, np.diff(bounds))).astype(np.float32), "bounds": bounds,
    }


class _Room:
    """Arrays used again from window to window, by name: fresh memory costs more than the sums done in it."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, dtype: type = np.float32) -> np.ndarray:
        size, old = math.prod(shape), self.held.get(name)
        if old is None or len(old) < size or old.dtype != dtype:
            old = self.held[name] = np.empty(size, dtype)
        return old[:size].reshape(shape)


def _shift(x: np.ndarray) -> np.ndarray | None:
    """What to take off each row of x before exp, or None where exp of x and sums of it are far from the limits of a float."""
    return None if x.size and -40 < x.min() and x.max() < 40 else x.max(axis=1)[:, None]


def _with_ones(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)


class _Output:
    """Weights of the softmax over classes and of that over each class's words, a row an entry, its bias last."""

    def __init__(self, p: dict):
        self.bounds, self.room = p["bounds"], _Room()
        self.wc, self.wo = (np.concatenate([w, b[:, None]], axis=1) for w, b in ((p["wc"].T, p["bc"]), (p["wo"], p["bo"])))
        self.size = np.diff(self.bounds)
        self.wo[self.bounds[:-1][self.size == 1]] = 0  # the only word of a class has all its chance
        reach = [np.abs(w) for w in (self.wc, self.wo)]
        self.reach = [(x[:, :-1].sum(axis=1).max(initial=0), x[:, -1].max(initial=0)) for x in reach]

    def exps(self, seen: np.ndarray, w: np.ndarray, far: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """exp of each state's logits, and what was taken off each row of them, where they may be far from 0."""
        x = np.matmul(seen, w.T, out=self.room("x", len(seen), len(w), dtype=w.dtype))
        top = _shift(x) if far else None
        if top is not None:
            x -= top
        return np.exp(x, out=x), top

    def far(self, seen: np.ndarray) -> list[bool]:
        """Whether a logit of a class, of a word may be far from 0."""
        most = max(float(seen.max(initial=0)), -float(seen.min(initial=0)))
        return [not most * weights + bias < 40 for weights, bias in self.reach]


def _log_chance(out: _Output, seen: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Natural log of the chance of each word after each state, whose last number is 1."""
    order = np.argsort(word.astype(np.int16), kind="stable")
    seen = np.take(seen, order, axis=0, out=out.room("seen", *seen.shape, dtype=seen.dtype), mode="clip")
    word, found = word[order], np.empty(len(seen), seen.dtype)
    label = np.searchsorted(out.bounds, word, side="right") - 1
    far_class, far_word = out.far(seen)
    ones = np.ones(int(max(len(out.wc), out.size.max())), seen.dtype)

    def less(own: slice, w: np.ndarray, far: bool) -> None:
        x, top = out.exps(seen[own], w, far)
        sums = np.log(x @ ones[: len(w)])
        found[own] -= sums if top is None else sums + top[:, 0]

    for a in range(0, len(seen), ROWS):
        own = slice(a, a + ROWS)
        weights = out.wc[label[own]]
        weights += out.wo[word[own]]
        np.einsum("ij,ij->i", seen[own], weights, out=found[own])
        less(own, out.wc, far_class)
    cuts = np.searchsorted(label, np.arange(len(out.bounds)))
    for c in np.flatnonzero((np.diff(cuts) > 0) & (out.size > 1)):
        for a in range(cuts[c], cuts[c + 1], ROWS):
            less(slice(a, min(a + ROWS, cuts[c + 1])), out.wo[out.bounds[c] : out.bounds[c + 1]], far_word)
    back = np.empty_like(found)
    back[order] = found
    return back


class _Input:
    """Each word's vector with a 1, weights of the input (its bias last) and of the state, those of the two gates halved, as a sigmoid is (1 + tanh(x / 2)) / 2."""

    def __init__(self, p: dict):
        self.embed = _with_ones(p["embed"])
        self.wx, self.wh = np.concatenate([p["wx"], p["b"][None]]).T.copy(), p["wh"].T.copy()
        self.wx[: 2 * HIDDEN] *= 0.5
        self.wh[: 2 * HIDDEN] *= 0.5

    def gates(self, source: np.ndarray, room: _Room) -> tuple[np.ndarray, np.ndarray]:
        """(vectors of the words (steps x lanes), the input part of their gates, in which the lanes of a number lie together)."""
        steps, lanes = source.shape
        x = np.take(self.embed, source.reshape(-1), axis=0, out=room("embed", steps * lanes, HIDDEN + 1, dtype=self.embed.dtype), mode="clip")
        x = x.reshape(steps, lanes, -1)
        return x, np.matmul(self.wx, x.transpose(0, 2, 1), out=room("gates", steps, 3 * HIDDEN, lanes, dtype=self.wx.dtype))


def _advance(a: np.ndarray, wh: np.ndarray, h: np.ndarray, u: np.ndarray, after: np.ndarray) -> None:
    """Takes the states h one word further, into after; u becomes the two gates and the state's part of the new state, the last third of the input part a the new state."""
    k = HIDDEN
    np.matmul(wh, h, out=u)
    gates, new = u[: 2 * k], a[2 * k :]
    gates += a[: 2 * k]
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    np.multiply(gates[k:], u[2 * k :], out=after)
    new += after
    np.tanh(new, out=new)
    np.subtract(h, new, out=after)
    after *= gates[:k]
    after += new


def _rows(states: np.ndarray, room: _Room) -> np.ndarray:
    """States (steps x HIDDEN x lanes), each in a row of its own with a 1 after it."""
    steps, k, lanes = states.shape
    rows = room("rows", steps, lanes, k + 1, dtype=states.dtype)
    rows[:, :, :k], rows[:, :, k] = states.transpose(0, 2, 1), 1
    return rows


def _states(given: _Input, source: np.ndarray, h: np.ndarray, fresh: np.ndarray | None, room: _Room) -> np.ndarray:
    """The states after each word (steps x HIDDEN x lanes), from h (HIDDEN x lanes) on and from the zero state where fresh."""
    _, a = given.gates(source, room)
    states, u = room("states", len(a), HIDDEN, h.shape[1], dtype=a.dtype), room("u", 3 * HIDDEN, h.shape[1], dtype=a.dtype)
    begun = fresh.any(axis=1).tolist() if fresh is not None else [False] * len(a)
    for t in range(len(a)):
        if begun[t]:
            h = np.where(fresh[t], 0, h).astype(h.dtype)
        _advance(a[t], given.wh, h, u, states[t])
        h = states[t]
    return states


def _lanes(sizes: np.ndarray, many: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal words, longest first; the fullest lane comes first."""
    heap = [(0, i) for i in range(min(many, len(sizes)))]
    owners: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-sizes, kind="stable").tolist():
        load, lane = heapq.heappop(heap)
        owners[lane].append(d)
        heapq.heappush(heap, (load + int(sizes[d]), lane))
    owners.sort(key=lambda own: -sum(int(sizes[d]) for d in own))
    return owners


def document_scores(p: dict, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural log probability of each document, its state carried from its first word to its last.

    Documents are laid end to end in lanes, longest first, and all lanes step at
    once; a document starts from the zero state with the start sign.
    """
    sizes = np.diff(offsets)
    owners = _lanes(sizes, LANES)
    order = np.array([d for own in owners for d in own], dtype=np.int64)
    place = np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in order]) if len(order) else np.zeros(0, np.int64)
    target, owner = words[place], np.repeat(order, sizes[order])
    fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
    source = np.concatenate([[0], target[:-1]])
    source[fresh] = len(p["embed"]) - 1
    loads = np.array([sum(int(sizes[d]) for d in own) for own in owners])
    begins = np.cumsum(loads) - loads
    given, output, room = _Input(p), _Output(p), _Room()
    h, out, states, places, held = np.zeros((HIDDEN, len(loads)), p["wx"].dtype), np.zeros(len(sizes)), [], [], 0
    for t in range(0, loads[0] if len(loads) else 0, STEPS):
        active = int(np.searchsorted(-loads, -t, side="left"))
        at = begins[:active] + np.arange(t, min(t + STEPS, loads[0]))[:, None]
        real = at < (begins + loads)[:active]
        at = np.where(real, at, 0)
        after = _states(given, source[at], np.ascontiguousarray(h[:, :active]), fresh[at] & real, room)
        h = after[-1].copy()
        states.append(_rows(after, room).reshape(-1, HIDDEN + 1)[real.reshape(-1)])
        places.append(at[real])
        held += len(places[-1])
        if held >= 1 << 14 or t + STEPS >= loads[0]:
            at, held = np.concatenate(places), 0
            out += np.bincount(owner[at], _log_chance(output, np.concatenate(states), target[at]).astype(float), minlength=len(sizes))
            states, places = [], []
    return out


def _chance_gradients(p: dict, g: dict, seen: np.ndarray, word: np.ndarray, room: _Room) -> np.ndarray:
    """Puts the output weights' gradients of the words' mean loss into g and returns the states' own; words in ascending order, each state's last number is 1."""
    out, k, share, kind = _Output(p), HIDDEN, 1 / max(len(word), 1), seen.dtype
    own_dh, dwc, dwo = room("own_dh", len(word), k, dtype=kind), np.zeros_like(out.wc), room("dwo", *out.wo.shape, dtype=kind)
    dwo[:] = 0
    to_class, to_word = _with_ones(p["wc"].T), _with_ones(p["wo"])  # the 1 gives the sum of a row
    far_class, far_word = out.far(seen)

    def spread(own: slice, w: np.ndarray, back: np.ndarray, far: bool) -> tuple[np.ndarray, np.ndarray]:
        """The expected weights after each state, and what that adds to the weights' gradients; neither has the word's own yet."""
        x, _ = out.exps(seen[own], w, far)
        mean = x @ back
        times = share / mean[:, k:]
        return mean[:, :k] * times, x.T @ (seen[own] * times)

    for a in range(0, len(word), ROWS):
        own_dh[a : a + ROWS], d = spread(slice(a, a + ROWS), out.wc, to_class, far_class)
        dwc += d
    first = np.flatnonzero(np.diff(word, prepend=-1))
    found, many = word[first], np.diff(np.append(first, len(word)))
    label = np.searchsorted(out.bounds, found, side="right") - 1
    cuts = np.append(first, len(word))[np.searchsorted(label, np.arange(len(out.bounds)))]
    for c in np.flatnonzero((np.diff(cuts) > 0) & (out.size > 1)):
        a_, b_ = out.bounds[c], out.bounds[c + 1]
        for a in range(cuts[c], cuts[c + 1], ROWS):
            own = slice(a, min(a + ROWS, cuts[c + 1]))
            dh, d = spread(own, out.wo[a_:b_], to_word[a_:b_], far_word)
            own_dh[own] += dh
            dwo[a_:b_] += d
    if len(word):
        sums, of_words = np.add.reduceat(seen, first, axis=0) * kind.type(share), out.size[label] > 1
        begins = np.flatnonzero(np.diff(label, prepend=-1))
        dwc[label[begins]] -= np.add.reduceat(sums, begins, axis=0)
        dwo[found[of_words]] -= sums[of_words]
        own_dh -= np.repeat((out.wc[label, :k] + out.wo[found, :k]) * kind.type(share), many, axis=0)
    g["wc"], g["bc"], g["wo"], g["bo"] = dwc[:, :k].T, dwc[:, k], np.ascontiguousarray(dwo[:, :k]), dwo[:, k]
    return own_dh


def _window(
    p: dict, source: np.ndarray, target: np.ndarray, h: np.ndarray, fresh: np.ndarray | None = None, given: np.ndarray | None = None, room: _Room | None = None
) -> tuple[dict, np.ndarray]:
    """Gradients of one window (lanes x steps), -1 marking no word, and the state after it; where fresh, a stretch begins from the given (lanes x steps x HIDDEN) or zero state.

    `used` are the rows of `embed` whose gradients may differ from 0.
    """
    k, room, kind, (lanes, steps) = HIDDEN, room or _Room(), p["wx"].dtype, source.shape
    source, word = np.ascontiguousarray(source.T), target.T.reshape(-1)  # step by step, so that a step's lanes lie together
    begins = np.zeros((steps, lanes), bool) if fresh is None else np.ascontiguousarray(fresh.T)
    begun = begins.any(axis=1).tolist()
    inputs = _Input(p)
    x, a = inputs.gates(source, room)
    h = np.ascontiguousarray(h.T, kind)
    before, states = (room(n, steps, k, lanes, dtype=kind) for n in ("before", "after"))
    both = room("both", steps, 3 * k, lanes, dtype=kind)
    for t in range(steps):
        if begun[t]:
            h = np.where(begins[t], 0 if given is None else given[:, t].T, h)
        before[t] = h
        _advance(a[t], inputs.wh, before[t], both[t], states[t])
        h = states[t]
    real = np.flatnonzero(word >= 0)
    real = real[np.argsort(word[real].astype(np.int16), kind="stable")]
    seen = np.take(_rows(states, room).reshape(-1, k + 1), real, axis=0, out=room("seen", len(real), k + 1, dtype=kind), mode="clip")
    g: dict = {}
    dh = room("dh", steps * lanes, k, dtype=kind)
    dh[:] = 0
    dh[real] = _chance_gradients(p, g, seen, word[real], room)
    dh_steps = room("dh_steps", steps, k, lanes, dtype=kind)
    dh_steps[:] = dh.reshape(steps, lanes, k).transpose(0, 2, 1)
    # What reaches each part a unit of the state's gradient: the new state's input, the two gates, the new state's part of the state.
    of, d = (room(n, steps, 4, k, lanes, dtype=kind) for n in ("of", "d"))
    z, r, inner, new = both[:, :k], both[:, k : 2 * k], both[:, 2 * k :], a[:, 2 * k :]
    less = np.subtract(1, z, out=room("less", steps, k, lanes, dtype=kind))
    np.multiply(new, new, out=of[:, 0])
    np.subtract(1, of[:, 0], out=of[:, 0])
    of[:, 0] *= less
    np.subtract(before, new, out=of[:, 1])
    of[:, 1] *= z
    of[:, 1] *= less
    np.multiply(of[:, 0], r, out=of[:, 3])
    np.multiply(of[:, 3], inner, out=of[:, 2])
    of[:, 2] *= np.subtract(1, r, out=less)
    back, more, wh = np.zeros((k, lanes), kind), np.empty((k, lanes), kind), p["wh"]
    by_input, by_state = d[:, :3].reshape(steps, 3 * k, lanes), d[:, 1:].reshape(steps, 3 * k, lanes)
    for t in reversed(range(steps)):
        back += dh_steps[t]
        np.multiply(back, of[t], out=d[t])
        back *= z[t]
        back += np.matmul(wh, by_state[t], out=more)
        if begun[t]:
            back[:, begins[t]] = 0
    g["wh"] = np.matmul(before, by_state.transpose(0, 2, 1)).sum(axis=0)
    dwx = np.roll(np.matmul(by_input, x).sum(axis=0), -k, axis=0)  # the new state's columns come last
    g["wx"], g["b"] = dwx[:, :k].T, dwx[:, k]
    flat = source.reshape(-1)
    dx = np.matmul(by_input.transpose(0, 2, 1), np.roll(p["wx"], k, axis=1).T, out=room("dx", steps, lanes, k, dtype=kind)).reshape(-1, k)
    order = np.argsort(flat.astype(np.int16), kind="stable")
    first = np.flatnonzero(np.diff(flat[order], prepend=-1))
    g["used"], g["embed"] = flat[order[first]], np.zeros_like(p["embed"])
    g["embed"][g["used"]] = np.add.reduceat(dx[order], first, axis=0)
    return g, states[-1].T.copy()


def no_steps(p: dict) -> dict:
    """The sums of squares of steps that training starts from."""
    return {n: np.full_like(p[n], 1e-6) for n in SHAPES}


def _stretches(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, first place in it) of each stretch when documents are cut every `most` words."""
    many = -(-sizes // most)
    document = np.repeat(np.arange(len(sizes)), many)
    return document, (np.arange(len(document)) - np.repeat(np.cumsum(many) - many, many)) * most


def _states_before(p: dict, words: np.ndarray, offsets: np.ndarray, document: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """The state before each place of a document, all being multiples of `most`: the model has read the document from its first word."""
    out = np.zeros((len(document), HIDDEN), np.float32)
    last = np.zeros(len(offsets) - 1, np.int64)
    np.maximum.at(last, document, place)
    long = np.flatnonzero(last)
    long = long[np.argsort(-last[long], kind="stable")]
    of = {(d, a): i for i, (d, a) in enumerate(zip(document.tolist(), place.tolist(), strict=True)) if a}
    inputs, room, h = _Input(p), _Room(), np.zeros((HIDDEN, len(long)), p["wx"].dtype)
    for begin in range(0, int(last[long[0]]) if len(long) else 0, most):
        long = long[last[long] > begin]
        h = np.ascontiguousarray(h[:, : len(long)])
        for t in range(begin, begin + most, STEPS):
            at = offsets[long] + np.arange(t - 1, min(t + STEPS, begin + most) - 1)[:, None]
            source = words[np.maximum(at, 0)]
            if t == 0:
                source[0] = len(p["embed"]) - 1
            h = _states(inputs, source, h, None, room)[-1].copy()
        for i, d in enumerate(long.tolist()):
            out[of[d, begin + most]] = h[:, i]
    return out


def train(p: dict, blocks, window: int = 32, lanes: int = 256, rate: float = 0.1, squares: dict | None = None) -> tuple[dict, dict]:
    """(p, sums of squares of steps) after adaptive gradient steps, once over every word of blocks of whole documents (words, offsets), going on from the squares given.

    Documents lie end to end in lanes, in an order fixed by a seed, each from the
    zero state and the start sign; the state goes on from window to window to a
    document's last word, gradients do not. A window's step counts by its words;
    small blocks have fewer lanes, for 64 windows or so. A document of more words
    than an even lane is cut into stretches of that many, which lie in lanes like
    documents: each goes on from the state that the block's first model has after
    all words before it.
    """
    p = {n: p[n].copy() for n in p}
    squares = {n: x.copy() for n, x in (squares or no_steps(p)).items()}
    first, rng, room = len(p["embed"]) - 1, np.random.default_rng(2), _Room()
    for words, offsets in blocks:
        total = int(offsets[-1])
        many = min(lanes, max(8, total // (64 * window)))
        most = window * max(64, -(-total // (many * window)))
        document, place = _stretches(np.diff(offsets), most)
        sizes, begin = np.minimum(np.diff(offsets)[document] - place, most), offsets[document] + place
        kept = _states_before(p, words, offsets, document, place, most)
        owners = _lanes(sizes, many)
        load = max((int(sizes[own].sum()) for own in owners), default=0)
        target, source = (np.full((len(owners), load), fill, np.int32) for fill in (-1, first))
        fresh, after = np.zeros((len(owners), load), bool), np.full((len(owners), load), -1, np.int32)
        for lane, own in enumerate(owners):
            at = 0
            for d in rng.permutation(own).tolist():
                text, to = words[begin[d] : begin[d] + sizes[d]], at + int(sizes[d])
                if to > at:
                    target[lane, at:to], source[lane, at + 1 : to], fresh[lane, at] = text, text[:-1], True
                    if place[d]:
                        source[lane, at], after[lane, at] = words[begin[d] - 1], d
                at = to
        h = np.zeros((len(owners), HIDDEN), np.float32)
        for a in range(0, load, window):
            active = int((target[:, a] >= 0).sum())  # lanes are in descending order of their words
            part = np.s_[:active, a : a + window]
            given = np.where(after[part][:, :, None] >= 0, kept[after[part]], np.float32(0)) if (after[part] >= 0).any() else None
            g, h = _window(p, source[part], target[part], h[:active], fresh[part], given, room)
            share = np.float32((target[part] >= 0).sum() / (len(owners) * window))
            for n in SHAPES:
                rows = g["used"] if n == "embed" else slice(None)
                step = g[n][rows]
                step *= share
                size = step * step
                squares[n][rows] += size
                np.sqrt(squares[n][rows], out=size)
                step /= size
                step *= rate
                p[n][rows] -= step
    return p, squares
