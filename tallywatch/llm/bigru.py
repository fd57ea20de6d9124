"""A bidirectional gated recurrent network with attention pooling, in numpy (Cho et al. 2014; Yang et al. 2016).

A word enters as two vectors: the embedding of its hash, and its characters, which are
the embeddings of its hashed character n-grams (the word's ends marked) pooled by
attention. Two gated recurrent layers read a window of words in either direction, a
second attention pools their states, and a logistic unit gives the window's probability.

Both inputs depend on the word alone, so a batch computes them once per distinct word.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WINDOW = 48
STRIDE = 32
HIDDEN = 8
EMBED = 8
WORD_BUCKETS = 1 << 16
GRAM_BUCKETS = 1 << 17
GRAMS = (3, 5)
CHUNK = 2048
#: Words hashed and embedded at once.
BLOCK = 16_384
STEPS = 400
BATCH = 128
RATE = 0.02
SEED = 5
#: Words and n-grams seen in fewer training texts count as unknown: their embedding is zero.
#: One text in 200, within these bounds.
LEAST_TEXTS = (3, 8)
#: So many of a step's words go without their own embedding, so that their characters must carry.
DROP = 0.8
#: Where callers separate the labels.
CUT = 0.7
MARK = 0x20

_FNV = np.uint64(0x100000001B3)
_BASE = np.uint64(0xCBF29CE484222325)


def _fold(values: np.ndarray, buckets: int) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return ((values >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def hashed(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, gram buckets, gram bounds) of words given as bytes; A-Z count as a-z.

    Every word has grams: one that is shorter than a gram, marks included, is filled up.
    """
    parts = [_hashed(data, bounds[at:at + BLOCK + 1]) for at in range(0, len(bounds) - 1, BLOCK)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    counts = np.concatenate([np.diff(p[2]) for p in parts])
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
            np.concatenate([[0], np.cumsum(counts)]))


def _hashed(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, bounds = data[bounds[0]:bounds[-1]], bounds - bounds[0]
    n = len(bounds) - 1
    lengths = np.diff(bounds)
    # A mark before and after each word, and behind all words room for the longest gram.
    total = len(data) + 2 * n
    marked = np.full(total + max(GRAMS), MARK, dtype=np.uint8)
    place = np.arange(len(data)) + 2 * np.repeat(np.arange(n), lengths) + 1
    low = data.copy()
    low[(low >= 65) & (low <= 90)] += 32
    marked[place] = low
    starts = bounds[:-1] + 2 * np.arange(n)
    sizes = lengths + 2
    with np.errstate(over="ignore"):
        # A word's hash: the sum of a mix of its bytes with their places.
        spot = (np.arange(total) - np.repeat(starts, sizes)).astype(np.uint64)
        mixed = (marked[:total].astype(np.uint64) + _BASE) * (spot * np.uint64(2) + np.uint64(0x9E3779B1)) * _FNV
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        words = _fold(np.add.reduceat(mixed, starts) if n else np.zeros(0, np.uint64), WORD_BUCKETS)
        parts, owners = [], []
        for width in GRAMS:
            count = np.maximum(1, sizes - width + 1)
            owner = np.repeat(np.arange(n), count)
            at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            value = np.full(len(at), _BASE + np.uint64(width), dtype=np.uint64)
            for k in range(width):
                # Bytes past the word's end count as marks.
                inside = at + k < (starts + sizes)[owner]
                value = (value ^ np.where(inside, marked[at + k], MARK).astype(np.uint64)) * _FNV
            parts.append(_fold(value, GRAM_BUCKETS))
            owners.append(owner)
    owner, grams = np.concatenate(owners), np.concatenate(parts)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=n)
    return words, grams[order], np.concatenate([[0], np.cumsum(counts)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class BiGru:
    """``side``: for each direction input weights, recurrent weights and biases of the three gates
    (reset, update, new), each gate ``HIDDEN`` columns."""

    word: np.ndarray
    gram: np.ndarray
    gram_look: np.ndarray
    side: list[list[np.ndarray]]
    look: np.ndarray
    out: np.ndarray
    bias: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))

    @classmethod
    def fresh(cls, seed: int = SEED) -> BiGru:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        side = [[draw(0.25, 2 * EMBED, 3 * HIDDEN), draw(0.25, HIDDEN, 3 * HIDDEN), np.zeros(3 * HIDDEN, np.float32)]
                for _ in range(2)]
        return cls(np.zeros((WORD_BUCKETS, EMBED), np.float32), draw(0.05, GRAM_BUCKETS, EMBED), draw(0.3, EMBED), side,
                   draw(0.1, 2 * HIDDEN), draw(0.3, 2 * HIDDEN))

    # ---- words ----

    def pooled_grams(self, grams: np.ndarray, bounds: np.ndarray):
        """The characters' vector of every word and, for training, the attention and embeddings."""
        seen = self.gram[grams]
        force = np.exp(np.clip(seen @ self.gram_look, -15, 15))
        total = np.add.reduceat(force, bounds[:-1])
        share = force / np.repeat(total, np.diff(bounds))
        return np.add.reduceat(seen * share[:, None], bounds[:-1], axis=0), share, seen

    def inputs(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The vector of each word: embedding, characters."""
        out = np.empty((len(bounds) - 1, 2 * EMBED), np.float32)
        for begin in range(0, len(out), BLOCK):
            words, grams, at = _hashed(data, bounds[begin:begin + BLOCK + 1])
            rows = slice(begin, begin + len(words))
            out[rows, :EMBED], out[rows, EMBED:] = self.word[words], self.pooled_grams(grams, at)[0]
        return out

    # ---- windows ----

    def _run(self, gates: np.ndarray, there: np.ndarray, recurrent: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step, (steps, windows, HIDDEN); ``gates`` (steps, windows, 3 * HIDDEN) are the inputs' parts."""
        steps, n, _ = gates.shape
        states = np.zeros((steps, n, HIDDEN), np.float32)
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(steps):
            own = h @ recurrent
            rz = sigmoid(gates[t, :, :2 * HIDDEN] + own[:, :2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            new = np.tanh(gates[t, :, 2 * HIDDEN:] + r * own[:, 2 * HIDDEN:])
            # Where the window has no word the state stays as it was.
            move = (1 - z) * there[t][:, None]
            after = h + move * (new - h)
            if keep is not None:
                keep.append((h, own, r, z, new, move))
            h = after
            states[t] = h
        return states

    def _pool(self, states: np.ndarray, there: np.ndarray):
        score = states @ self.look
        score = np.where(there > 0, score, -30.0)
        force = np.exp(score - score.max(axis=0))
        share = force / force.sum(axis=0)
        return (states * share[:, :, None]).sum(axis=0), share

    def probabilities(self, tables: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
        """Probability of each window; ``codes`` (windows, WINDOW) name rows of ``tables``, the words'
        parts of the gates for either direction, whose last row stands for no word."""
        out = np.empty(len(codes), np.float32)
        none = len(tables[0]) - 1
        for at in range(0, len(codes), CHUNK):
            c = np.ascontiguousarray(codes[at:at + CHUNK].T)
            used = int((c != none).any(axis=1).sum()) or 1
            c = c[:used]
            there = (c != none).astype(np.float32)
            ahead = self._run(tables[0][c], there, self.side[0][1])
            back = self._run(tables[1][c[::-1]], there[::-1], self.side[1][1])[::-1]
            pooled, _ = self._pool(np.concatenate([ahead, back], axis=2), there)
            out[at:at + CHUNK] = sigmoid(pooled @ self.out + self.bias)
        return out

    def tables(self, vectors: np.ndarray) -> list[np.ndarray]:
        padded = np.concatenate([vectors, np.zeros((1, 2 * EMBED), np.float32)])
        return [padded @ w + b for w, _, b in self.side]


def windows_of(bounds: np.ndarray, codes: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, owner): all overlapping windows of every text, filled up with ``none``; a text has at least one."""
    lengths = np.diff(bounds)
    count = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(lengths)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[:-1][owner] + place * STRIDE
    padded = np.concatenate([codes, np.full(WINDOW, none, codes.dtype)])
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    left = bounds[1:][owner] - start
    short = np.flatnonzero(left < WINDOW)
    out[short] = np.where(np.arange(WINDOW) < left[short, None], out[short], none)
    return out, owner


# ---- training ----


class _Adam:
    """Adam with the same step count for every row; embeddings move only where they were used."""

    def __init__(self, rate: float):
        self.rate, self.t, self.memory = rate, 0, {}

    def step(self, name: str, array: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None, scale: float = 1.0) -> None:
        m, v = self.memory.setdefault(name, (np.zeros_like(array), np.zeros_like(array)))
        rate = scale * self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.999 * v[at] + 0.001 * grad * grad
        array[at] -= (rate * m[at] / (np.sqrt(v[at]) + 1e-8)).astype(np.float32)


def _back(net: BiGru, d: int, grads: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    """Through one direction: gradients of the gates' inputs and of the recurrent weights."""
    recurrent = net.side[d][1]
    steps, n, _ = grads.shape
    dgates = np.zeros((steps, n, 3 * HIDDEN), np.float32)
    dweights = np.zeros_like(recurrent)
    dh = np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, own, r, z, new, move = keep[t]
        dh = dh + grads[t]
        dnew = dh * move * (1 - new * new)
        # move = (1 - z) * there, so a step without a word passes the gradient on.
        there = np.divide(move, 1 - z, out=np.zeros_like(move), where=z < 1)
        dz = -dh * (new - h) * there * z * (1 - z)
        dr = dnew * own[:, 2 * HIDDEN:] * r * (1 - r)
        dgates[t] = np.concatenate([dr, dz, dnew], axis=1)
        down = np.concatenate([dr, dz, dnew * r], axis=1)
        dweights += h.T @ down
        dh = dh * (1 - move) + down @ recurrent.T
    return dgates, dweights


def train(data: np.ndarray, bounds: np.ndarray, codes: np.ndarray, owner: np.ndarray, y: np.ndarray,
          steps: int = STEPS, seed: int = SEED) -> BiGru:
    """Fit on windows (rows of ``codes`` over the distinct words ``data``/``bounds``) of labelled texts.

    ``owner`` names each window's text, ``y`` each text's label. A text counts through one
    window a step: at first any, later, for texts of label 1, the one the network finds
    likeliest. Both labels are drawn equally often, later half of label 0 from the texts
    most often mistaken; the number of steps is fixed. Most words enter a step by their characters
    alone (``DROP``); word embeddings begin at zero. So the network learns what words look like
    rather than which texts they come from. In the end the bias is moved so that
    ``CUT`` lies between the likeliest windows of most texts of either label.
    """
    rng = np.random.default_rng(seed)
    net = BiGru.fresh(seed)
    none = len(bounds) - 1
    words, grams, gram_at = hashed(data, bounds)
    known_word, known_gram = _known(codes, owner, none, words, grams, gram_at)
    net.word[~known_word] = 0
    net.gram[~known_gram] = 0
    first = np.searchsorted(owner, np.arange(len(y)))
    count = np.bincount(owner, minlength=len(y))
    texts = [np.flatnonzero((y == k) & (count > 0)) for k in (0, 1)]
    if not len(texts[0]) or not len(texts[1]):
        net.out[:] = 0
        net.bias[:] = 6.0 if len(texts[1]) else -6.0
        return net
    likeliest, worst = None, texts[0]
    adam = _Adam(RATE)
    for step in range(steps):
        if step >= steps // 4 and step % (steps // 8) == 0:
            likeliest, p = _likeliest(net, data, bounds, codes, owner, len(y))
            worst = texts[0][np.argsort(-p[texts[0]], kind="stable")[: max(1, len(texts[0]) // 10)]]
        chosen = np.concatenate([
            rng.choice(texts[0], BATCH // 4), rng.choice(worst, BATCH // 4), rng.choice(texts[1], BATCH // 2)])
        label = y[chosen].astype(np.float32)
        window = first[chosen] + rng.integers(0, count[chosen])
        if likeliest is not None:
            window = np.where((label == 1) | (rng.random(BATCH) < 0.5), likeliest[chosen], window)
        rows, local = np.unique(codes[window], return_inverse=True)
        local = local.reshape(BATCH, WINDOW).T
        rows = rows[rows < none]
        # The words of this step and their grams.
        sizes = np.diff(gram_at)[rows]
        flat = np.repeat(gram_at[:-1][rows], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.concatenate([[0], np.cumsum(sizes)])
        pooled, share, seen = net.pooled_grams(grams[flat], at)
        kept = rng.random(len(rows)) >= DROP
        vectors = np.concatenate([net.word[words[rows]] * kept[:, None].astype(np.float32), pooled], axis=1)
        tables = net.tables(vectors)
        there = (local < len(rows)).astype(np.float32)
        keeps: list[list] = [[], []]
        ahead = net._run(tables[0][local], there, net.side[0][1], keeps[0])
        back = net._run(tables[1][local[::-1]], there[::-1], net.side[1][1], keeps[1])[::-1]
        states = np.concatenate([ahead, back], axis=2)
        context, weight = net._pool(states, there)
        p = sigmoid(context @ net.out + net.bias)

        dlogit = ((p - label) / BATCH).astype(np.float32)
        dcontext = dlogit[:, None] * net.out
        dscore = weight * ((states - context) * dcontext).sum(axis=2)
        dstates = weight[:, :, None] * dcontext + dscore[:, :, None] * net.look
        dvectors = np.zeros((len(rows) + 1, 2 * EMBED), np.float32)
        adam.t += 1
        scale = 1 - step / steps
        for d, grads in enumerate((dstates[:, :, :HIDDEN], dstates[::-1, :, HIDDEN:])):
            dgates, dweights = _back(net, d, grads, keeps[d])
            where = local if d == 0 else local[::-1]
            dtable = np.zeros((len(rows) + 1, 3 * HIDDEN), np.float32)
            np.add.at(dtable, where.reshape(-1), dgates.reshape(-1, 3 * HIDDEN))
            weights, recurrent, bias = net.side[d]
            dvectors += dtable @ weights.T
            padded = np.concatenate([vectors, np.zeros((1, 2 * EMBED), np.float32)])
            adam.step(f"w{d}", weights, padded.T @ dtable, scale=scale)
            adam.step(f"u{d}", recurrent, dweights, scale=scale)
            adam.step(f"b{d}", bias, dtable.sum(axis=0), scale=scale)
        adam.step("look", net.look, (dscore[:, :, None] * states).sum(axis=(0, 1)), scale=scale)
        adam.step("out", net.out, dlogit @ context, scale=scale)
        adam.step("bias", net.bias, np.array([dlogit.sum()]), scale=scale)
        dword, dchars = dvectors[:-1, :EMBED], dvectors[:-1, EMBED:]
        learnt = known_word[words[rows]] & kept
        _rows_step(adam, "word", net.word, words[rows][learnt], dword[learnt], scale)
        wide = np.repeat(dchars, sizes, axis=0)
        pull = share * ((seen - np.repeat(pooled, sizes, axis=0)) * wide).sum(axis=1)
        learnt = known_gram[grams[flat]]
        _rows_step(adam, "gram", net.gram, grams[flat][learnt],
                   (share[:, None] * wide + pull[:, None] * net.gram_look)[learnt], scale)
        adam.step("gram_look", net.gram_look, pull @ seen, scale=scale)
    net.word *= 1 - DROP
    p = np.clip(_likeliest(net, data, bounds, codes, owner, len(y))[1], 1e-6, 1 - 1e-6)
    odds = np.log(p / (1 - p))
    # Nearer to label 1: a whole text has more windows, and so a likelier one, than its part here.
    middle = 0.2 * np.quantile(odds[texts[0]], 0.995) + 0.8 * np.quantile(odds[texts[1]], 0.02)
    net.bias += np.float32(np.log(CUT / (1 - CUT)) - middle)
    return net


def _likeliest(net: BiGru, data, bounds, codes, owner, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest window of every text and its probability."""
    p = net.probabilities(net.tables(net.inputs(data, bounds)), codes)
    best = np.lexsort((-p, owner))[np.searchsorted(owner, np.arange(n_texts))]
    return best, p[best]


def _known(codes: np.ndarray, owner: np.ndarray, none: int, words: np.ndarray, grams: np.ndarray,
           gram_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word and gram buckets that occur in enough texts (``LEAST_TEXTS``), counted some texts at a time."""
    seen_word, seen_gram = np.zeros(WORD_BUCKETS, np.int32), np.zeros(GRAM_BUCKETS, np.int32)
    sizes = np.diff(gram_at)
    for begin in range(0, int(owner.max(initial=-1)) + 1, 64):
        rows = slice(*np.searchsorted(owner, [begin, begin + 64]))
        there = codes[rows] < none
        pairs = np.unique(np.repeat(owner[rows], there.sum(axis=1)) * (none + 1) + codes[rows][there])
        text, word = pairs // (none + 1), pairs % (none + 1)
        seen_word += np.bincount(np.unique(text * WORD_BUCKETS + words[word]) % WORD_BUCKETS, minlength=WORD_BUCKETS).astype(np.int32)
        n = sizes[word]
        flat = np.repeat(gram_at[:-1][word], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        grams_here = np.unique(np.repeat(text, n) * GRAM_BUCKETS + grams[flat]) % GRAM_BUCKETS
        seen_gram += np.bincount(grams_here, minlength=GRAM_BUCKETS).astype(np.int32)
    least = min(max(LEAST_TEXTS[0], int(owner.max(initial=-1) + 1) // 200), LEAST_TEXTS[1])
    return seen_word >= least, seen_gram >= least


def _rows_step(adam: _Adam, name: str, table: np.ndarray, rows: np.ndarray, grads: np.ndarray, scale: float) -> None:
    used, place = np.unique(rows, return_inverse=True)
    total = np.zeros((len(used), table.shape[1]), np.float32)
    np.add.at(total, place, grads)
    adam.step(name, table, total, used, scale)
