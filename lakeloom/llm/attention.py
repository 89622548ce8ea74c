"""A small causal self-attention model over subword ids, trained and applied in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW, STRIDE = 32, 24
#: Where a sum of exponentials leaves this range, a maximum is taken off before they are added up.
LEAST, MOST = 1e-17, 1e17
#: Logits are taken to base 2, whose powers are quicker than exponentials.
LN2 = float(np.log(2))


@dataclass
class Vocabulary:
    """How ids go into the model, and which class a word belongs to by its last id.

    Ids that end many words make a class of their own, the others share classes
    of about equal mass; frequent ids have an input vector of their own, the
    others share one with their class. ``norm`` is what the smoothed counts of
    an id's class add up to, as a natural logarithm.
    """

    inputs: np.ndarray   # id -> input vector
    classes: np.ndarray  # last id -> class
    norm: np.ndarray     # last id -> log(words of the class + 0.5 * (its different words + 1))
    mass: np.ndarray     # class -> words
    n_inputs: int

    @classmethod
    def of(cls, uses: np.ndarray, words: np.ndarray, types: np.ndarray, own_classes: int = 224, shared: int = 32, own_inputs: int = 2000) -> Vocabulary:
        """uses: how often each id stands in training texts; words, types: words that end with it, different ones."""
        order = np.lexsort((np.arange(len(words)), -words))
        classes = np.empty(len(words), np.int64)
        classes[order[:own_classes]] = np.arange(min(own_classes, len(words)))
        rest = order[own_classes:]
        run = np.cumsum(words[rest] + 0.01)
        classes[rest] = own_classes + np.minimum((run - words[rest]) / max(run[-1] if len(run) else 1, 1e-9) * shared, shared - 1).astype(np.int64)
        _, classes = np.unique(classes, return_inverse=True)
        n = int(classes.max()) + 1
        mass, kinds = np.bincount(classes, words, n), np.bincount(classes, types, n)
        frequent = np.lexsort((np.arange(len(uses)), -uses))[:own_inputs]
        inputs = classes + len(frequent)
        inputs[frequent] = np.arange(len(frequent))
        return cls(inputs, classes, np.log(mass + 0.5 * (kinds + 1))[classes], mass, len(frequent) + n + 1)


def windows_of(counts: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over sequences of ``counts`` ids: sequence, first place, first place that the window scores.

    Windows overlap, so that each id but the first few of a sequence has at
    least WINDOW - stride ids before it, and each is scored exactly once.
    """
    many = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // stride)), 0)
    row = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return row, nth * stride, np.where(nth > 0, WINDOW - stride, 0)


class Windows:
    """Overlapping windows over sequences laid end to end; each place is wanted in one window at most.

    ``goals`` holds the last id of a word where the word starts, else -1.
    """

    def __init__(self, vocabulary: Vocabulary, start: int, ids: np.ndarray, goals: np.ndarray, counts: np.ndarray, stride: int = STRIDE) -> None:
        self.counts, self.begin = counts, np.cumsum(counts) - counts
        self.row, self.first, self.scored = windows_of(counts, stride)
        self.starts, self.classes = goals >= 0, np.append(vocabulary.classes, -1)[goals]
        self.inputs = np.empty(len(ids), np.int64)
        self.inputs[1:] = vocabulary.inputs[ids[:-1]]
        self.inputs[self.begin] = start

    def cut(self, which: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some windows: the inputs before each place, where a word is wanted, and the classes, -1 where no word starts."""
        row, place = self.row[which], np.arange(WINDOW)
        begin, first = self.begin[row], self.first[which]
        room = (self.counts[row] - first)[:, None]
        at = (begin + first)[:, None] + place
        np.minimum(at, (begin + self.counts[row] - 1)[:, None], out=at)
        classes = np.take(self.classes, at)
        wanted = classes >= 0
        wanted &= place < room
        wanted &= place >= self.scored[which][:, None]
        return np.take(self.inputs, at), wanted, classes

    def wants(self) -> np.ndarray:
        """How many places each window wants."""
        upto = np.append(0, np.cumsum(self.starts))
        begin, stop = self.begin[self.row], (self.begin + self.counts)[self.row]
        return upto[np.minimum(begin + self.first + WINDOW, stop)] - upto[np.minimum(begin + self.first + self.scored, stop)]


class Adam:
    """Steps along gradients by running means of them and of their squares.

    The parameters are laid end to end, and those in ``p`` become views of them.
    """

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.names, self.done = list(p), 0
        self.flat = np.concatenate([v.ravel() for v in p.values()])
        for k, part in zip(self.names, np.split(self.flat, np.cumsum([v.size for v in p.values()])[:-1]), strict=True):
            p[k] = part.reshape(p[k].shape)
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.done += 1
        scale = rate * min(1, self.done / 20) * (1 - 0.98**self.done) ** 0.5 / (1 - 0.9**self.done)
        m, v, own = self.mean, self.square, np.concatenate([g[k].ravel() for k in self.names])
        x = own - m
        x *= 0.1
        m += x
        np.multiply(own, own, out=x)
        x -= v
        x *= 0.02
        v += x
        np.sqrt(v, out=x)
        x += 1e-8
        np.divide(m, x, out=x)
        x *= scale
        self.flat -= x


class Asked:
    """The wanted places of some windows, those of a window side by side, so that a batch is as wide as the most that one window wants.

    ``own`` are the places, ``at`` where each lies in that packing, ``source`` the place that lies at each; the rest of it is idle.
    """

    def __init__(self, wanted: np.ndarray) -> None:
        b, w = wanted.shape
        self.own, n = np.flatnonzero(wanted), np.count_nonzero(wanted, axis=1)
        self.windows, self.most = b, max(1, int(n.max(initial=0)))
        self.at = np.arange(len(self.own)) + np.repeat(np.arange(b) * self.most - (np.cumsum(n) - n), n)
        self.source = np.zeros(b * self.most, np.int64)
        self.source[self.at] = self.own
        self.place = self.source - self.source // w * w

    @staticmethod
    def _laid(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        which = np.full(size, len(rows))
        which[at] = np.arange(len(rows))
        return np.take(np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)]), which, axis=0)

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the wanted places in the packing, zero where it is idle."""
        return self._laid(rows, self.at, len(self.source)).reshape(self.windows, self.most, -1)

    def spread(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Rows of the wanted places among all places, zero at the others."""
        return self._laid(rows, self.own, size)


def look(asked: Asked, q: np.ndarray, k: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of all places of a window for each packed query, not divided by their sum; of the wanted places this sum, and the mean of values.

    Queries come scaled, so that weights are powers of two of products. A value has a further one, so that the same product adds up the weights.
    """
    w = k.shape[1]
    past = np.take(np.tril(np.ones((w, w), k.dtype)), asked.place, axis=0).reshape(*q.shape[:2], w)
    back = np.ascontiguousarray(k.transpose(0, 2, 1))
    a = np.matmul(q, back)
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp2(a, out=a)
        a *= past
        seen = np.matmul(a, v)
    if not _safe(seen[:, :, -1]):
        np.matmul(q, back, out=a)
        a -= np.where(past > 0, a, -np.inf).max(2, keepdims=True)
        np.minimum(a, 0, out=a)
        np.exp2(a, out=a)
        a *= past
        seen = np.matmul(a, v)
    seen = np.take(seen.reshape(-1, v.shape[2]), asked.at, axis=0)
    return a, seen[:, -1], seen[:, :-1] / seen[:, -1:]


def _and_one(x: np.ndarray) -> np.ndarray:
    """Rows followed by a one, so that a product with them adds a constant or adds up."""
    out = np.ones((len(x), x.shape[1] + 1), x.dtype)
    out[:, :-1] = x
    return out


def _safe(total: np.ndarray) -> bool:
    """Whether sums of exponentials came out well without taking off a maximum."""
    return not total.size or bool(LEAST < total.min() and total.max() < MOST)


class Attention:
    """One layer: x + attention(x), then x + relu network(x), then class logits."""

    def __init__(self, n_inputs: int, n_classes: int, width: int = 16, hidden: int = 32, seed: int = 5) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "embed": draw(n_inputs, width, scale=0.3), "place": draw(WINDOW, width, scale=0.1),
            "q": draw(width, width, scale=width**-0.5), "k": draw(width, width, scale=width**-0.5), "v": draw(width, width, scale=width**-0.5),
            "o": draw(width, width, scale=0.5 * width**-0.5), "up": draw(width, hidden, scale=width**-0.5), "bend": np.zeros(hidden, np.float32),
            "down": draw(hidden, width, scale=0.5 * hidden**-0.5), "out": draw(width, n_classes, scale=width**-0.5),
            "bias": np.zeros(n_classes, np.float32),
        }
        self.start, self.scale = n_inputs - 1, np.float32(width**-0.5)  # of products of queries and keys

    def attend(self, inputs: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray | Asked]:
        """What attention gives at the wanted places; the others ask nothing, they are only looked at."""
        p = self.p
        b, w = inputs.shape
        asked = Asked(wanted)
        x = np.take(p["embed"], inputs, axis=0)
        x += p["place"][:w]
        x = x.reshape(b * w, -1)
        q = np.take(x, asked.source, axis=0) @ (p["q"] * np.float32(self.scale / LN2))
        both = np.ones((b, w, 2 * x.shape[1] + 1), x.dtype)
        np.matmul(x, np.concatenate([p["k"], p["v"]], 1), out=both.reshape(b * w, -1)[:, :-1])
        f = {"asked": asked, "x": x, "q": q.reshape(b, asked.most, -1), "k": both[:, :, :x.shape[1]], "v": both[:, :, x.shape[1]:]}
        return f | dict(zip(("a", "sum", "o"), look(asked, f["q"], f["k"], f["v"]), strict=True))

    def follow(self, x: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What follows attention, on rows of inputs and of what attention gave: y, r, z."""
        p = self.p
        y = o @ p["o"]
        y += x
        r = y @ p["up"]
        r += p["bend"]
        np.maximum(r, 0, out=r)
        z = r @ p["down"]
        z += y
        return y, r, z

    def forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        f = self.attend(inputs, np.ones(inputs.shape, bool))
        return f | {n: t.reshape(*inputs.shape, -1) for n, t in zip("yrz", self.follow(f["x"], f["o"]), strict=True)}

    def to_classes(self, kind: np.dtype) -> np.ndarray:
        """What takes rows, each with a one behind, to class logits to base 2."""
        return (np.concatenate([self.p["out"], self.p["bias"][None]]) / kind.type(LN2)).astype(kind)

    def class_gradients(self, z: np.ndarray, classes: np.ndarray, together: int = 192) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Mean loss of rows of wanted classes and its gradients by z, by ``out`` and by ``bias``, over as many rows at once as a cache holds."""
        p, n = self.p, max(1, len(z))
        ahead, back = self.to_classes(z.dtype), np.ascontiguousarray(p["out"].T)
        wide, with_one, by, dz = np.ones(len(back), z.dtype), _and_one(z), np.zeros_like(ahead), np.empty_like(z)
        room = np.empty((min(together, len(z)), len(back)), z.dtype)
        at = np.arange(len(z)) % together * len(back) + classes
        own, total = np.empty(len(z), z.dtype), np.empty(len(z), z.dtype)
        with np.errstate(over="ignore"):
            for a in range(0, len(z), together):
                part = slice(a, a + together)
                rows = with_one[part]
                d = np.matmul(rows, ahead, out=room[:len(rows)])
                np.exp2(d, out=d)
                add = np.matmul(d, wide, out=total[part])
                if not _safe(add):
                    np.matmul(rows, ahead, out=d)
                    d -= d.max(1, keepdims=True)
                    np.exp2(d, out=d)
                    np.matmul(d, wide, out=add)
                np.matmul(d, back, out=dz[part])
                flat = d.reshape(-1)
                own[part] = mine = flat[at[part]]
                flat[at[part]] = mine - add
                rows /= add[:, None]
                by += rows.T @ d
        dz /= total[:, None]
        dz -= np.take(back, classes, axis=0)
        dz *= z.dtype.type(1 / n)
        by *= z.dtype.type(1 / n)
        return -float(np.log(np.maximum(own / total, 1e-30)).sum()) / n, dz, by[:-1], by[-1]

    def log_classes(self, z: np.ndarray, classes: np.ndarray, together: int = 192) -> np.ndarray:
        """Log probability of each row's class, over as many rows at once as a processor's cache holds."""
        ahead, with_one = self.to_classes(z.dtype), _and_one(z)
        wide, room = np.ones(ahead.shape[1], z.dtype), np.empty((min(together, len(z)), ahead.shape[1]), z.dtype)
        at = np.arange(len(z)) % together * ahead.shape[1] + classes
        own, total = np.empty(len(z), z.dtype), np.empty(len(z), z.dtype)
        with np.errstate(over="ignore"):
            for a in range(0, len(z), together):
                part = slice(a, a + together)
                rows = with_one[part]
                logits = np.matmul(rows, ahead, out=room[:len(rows)])
                np.take(logits, at[part], out=own[part])
                np.exp2(logits, out=logits)
                add = np.matmul(logits, wide, out=total[part])
                if not _safe(add):
                    np.matmul(rows, ahead, out=logits)
                    logits -= logits.max(1, keepdims=True)
                    np.take(logits, at[part], out=own[part])
                    np.exp2(logits, out=logits)
                    np.matmul(logits, wide, out=add)
        return (own - np.log2(total)) * z.dtype.type(LN2)

    def gradients(self, inputs: np.ndarray, classes: np.ndarray, valid: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, f = self.p, self.attend(inputs, valid)
        b, w = inputs.shape
        asked, x, o = f["asked"], f["x"], f["o"]
        flat = lambda t: t.reshape(-1, t.shape[-1])
        own = np.take(x, asked.own, axis=0)
        y, r, z = self.follow(own, o)
        loss, dz, by_out, by_bias = self.class_gradients(z, classes.ravel()[asked.own])
        g = {"out": by_out, "bias": by_bias}
        g["down"] = r.T @ dz
        dr = dz @ p["down"].T
        dr *= r > 0
        g["up"], g["bend"] = y.T @ dr, dr.sum(0)
        dy = dz + dr @ p["up"].T
        g["o"] = o.T @ dy
        do = np.empty((len(dy), o.shape[1] + 1), dy.dtype)
        np.matmul(dy / f["sum"][:, None], p["o"].T, out=do[:, :-1])
        do[:, -1] = -np.einsum("ij,ij->i", do[:, :-1], o)
        do = asked.pack(do)
        width, both = x.shape[1], np.empty((b, w, 2 * x.shape[1]), x.dtype)
        np.matmul(f["a"].transpose(0, 2, 1), do[:, :, :-1], out=both[:, :, width:])
        ds = np.matmul(do, np.ascontiguousarray(f["v"].transpose(0, 2, 1)))
        ds *= f["a"]
        dq = np.take(flat(np.matmul(ds, f["k"])), asked.at, axis=0)
        np.matmul(ds.transpose(0, 2, 1), f["q"], out=both[:, :, :width])
        g["q"] = (own.T @ dq) * self.scale
        dx = asked.spread(dy + dq @ (p["q"].T * self.scale), b * w)
        by_both = x.T @ flat(both)
        g["k"], g["v"] = by_both[:, :width] * x.dtype.type(LN2), by_both[:, width:]
        dx += flat(both) @ np.concatenate([p["k"].T * x.dtype.type(LN2), p["v"].T])
        g["place"] = np.zeros_like(p["place"])
        g["place"][:w] = dx.reshape(b, w, -1).sum(0)
        g["embed"] = np.zeros_like(p["embed"])
        flat_inputs = inputs.ravel().astype(np.uint16) if len(p["embed"]) <= 1 << 16 else inputs.ravel()
        by = np.argsort(flat_inputs, kind="stable")
        held = flat_inputs[by]
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        seen = held[first]
        g["embed"][seen] = np.add.reduceat(np.take(dx, by, axis=0), first)
        return float(loss), g

    def score(self, vocabulary: Vocabulary, ids: np.ndarray, goals: np.ndarray, counts: np.ndarray, together: int = 512) -> np.ndarray:
        """Natural log probability of the word classes of each of some sequences laid end to end.

        Queries, keys and values are looked up by input and place. Windows that
        want as many places go together. Queries are asked, and what follows
        attention is worked out, only where a word starts.
        """
        p = self.p
        further = np.zeros((p["v"].shape[0], 1), np.float32)
        tables = [(p["embed"] @ m, p["place"] @ m) for m in (p["q"] * np.float32(self.scale / LN2), p["k"], np.concatenate([p["v"], further], 1))]
        tables[2][1][:, -1] = 1
        windows = Windows(vocabulary, self.start, ids, goals, counts)
        order = np.argsort(windows.wants(), kind="stable")
        out = np.zeros(len(counts))
        for a in range(0, len(order), together):
            part = order[a:a + together]
            before, take, classes = windows.cut(part)
            asked, flat = Asked(take), before.ravel()
            query, key, value = (np.take(by_input, some, axis=0) for (by_input, _), some in zip(tables, (flat[asked.source], before, before), strict=True))
            query += np.take(tables[0][1], asked.place, axis=0)
            key += tables[1][1]
            value += tables[2][1]
            _, _, seen = look(asked, query.reshape(len(part), asked.most, -1), key, value)
            y = np.take(p["embed"], flat[asked.own], axis=0)
            y += np.take(p["place"], asked.own % WINDOW, axis=0)
            _, _, z = self.follow(y, seen)
            out += np.bincount(windows.row[part][asked.own // WINDOW], self.log_classes(z, classes.ravel()[asked.own]), len(counts))
        return out
