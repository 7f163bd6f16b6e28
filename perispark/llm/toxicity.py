"""Toxicity from a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of two inputs: an embedding of the whole word and the mean embedding of its characters' n-grams
(both by hash, so there is no vocabulary to keep). Two gated recurrent units read a window of words from left and from
right; attention weighs their states, and the pooled state gives the window's logit. Windows overlap by half, all windows
of a text are scored, and the text's score is a calibrated function of its largest window logit.

Training is on a bounded sample of labelled documents, each read whole: in each step a text is scored over its windows and
the error goes back through the window with the largest logit, so one marked passage in a long text is enough. Long toxic
texts begin with the window that has the word most peculiar to toxic texts; every ``MINE_STEPS`` steps they are scored over all
their windows, and the largest is always among those looked at. The
calibration is fitted on a fifth of the sample that the network was not trained on.

A word is what stands between white space; of a longer one than ``WORD_CHARS`` characters, overlapping pieces are words, so a
script without blanks has windows as well.

Defined results: a null text counts as empty; a text without words is one window of padding and scores like it; repeated
rows score alike; if the labelled rows outside the held-out fold lack a class, every document scores the share of toxic
labels (0 without any); an empty table stays empty;
other columns are not read, and ``add_score`` keeps them.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.llm.common import held_out, map_columns, training_texts
from perispark.llm.quality import logistic

TRAINING_DOCS = 1_000  # bound of the sample per class
WINDOW, STRIDE = 32, 16  # words
HIDDEN, EMBEDDING = 8, 12
WORD_BUCKETS, NGRAM_BUCKETS = 1 << 15, 1 << 14
STEPS, BATCH, RATE = 300, 48, 0.01
WINDOWS_PER_TEXT = 12  # windows of a training text looked at in one step, drawn anew each time; scoring takes all
TOXIC_FROM = 0.5
CACHED_WORDS = 120_000
MINE_STEPS = 75
WORD_CHARS = 64


def split_words(text: str | None) -> list[str]:
    """Words of a text; very long ones as pieces of ``WORD_CHARS`` characters that overlap by half."""
    words = (text or "").split()
    if words and max(map(len, words)) > WORD_CHARS:
        half = WORD_CHARS // 2
        words = [w[k:k + WORD_CHARS] for w in words for k in (range(0, len(w) - half, half) if len(w) > WORD_CHARS else (0,))]
    return words


def word_inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash bucket of each word, hash buckets of all their character trigrams, and each word's first trigram.

    Words are lower-cased and framed by one mark on either side, so every word has a trigram.
    """
    framed = [b"\x02" + w.lower().encode("utf-8", "surrogatepass") + b"\x03" for w in words]
    buckets = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in framed), dtype=np.int64, count=len(framed))
    data = np.frombuffer(b"".join(framed) + b"\0\0", dtype=np.uint8).astype(np.uint32)
    grams = (data[:-2] * np.uint32(2654435761) + data[1:-1] * np.uint32(2246822519) + data[2:] * np.uint32(3266489917)) >> np.uint32(18)
    lengths = np.fromiter(map(len, framed), dtype=np.int64, count=len(framed))
    starts = np.cumsum(lengths) - lengths
    inside = np.ones(len(grams), dtype=bool)  # trigrams that would reach into the next word are left out
    inside[starts + lengths - 1] = False
    inside[starts + lengths - 2] = False
    firsts = np.cumsum(inside)[starts] - 1
    return buckets, (grams[inside] % NGRAM_BUCKETS).astype(np.int64), firsts


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters and passes. Arrays run (time, window, unit); ``mask`` is 1 on words and 0 on padding."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"word": np.zeros((WORD_BUCKETS, EMBEDDING), np.float32), "gram": (0.1 * rng.standard_normal((NGRAM_BUCKETS, EMBEDDING))).astype(np.float32),
                  "va": normal(2 * HIDDEN, HIDDEN), "vb": np.zeros(HIDDEN, np.float32), "vc": normal(HIDDEN), "out": normal(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"{side}x": normal(EMBEDDING, 3 * HIDDEN), f"{side}h": normal(HIDDEN, 3 * HIDDEN), f"{side}b": np.zeros(3 * HIDDEN, np.float32)}
        self.calibration = (0.0, 1.0)

    def embed(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        buckets, grams, firsts = word_inputs(words)
        counts = np.diff(np.append(firsts, len(grams)))
        means = np.add.reduceat(self.p["gram"][grams], firsts, axis=0) / counts[:, None]
        return self.p["word"][buckets] + means, (buckets, grams, counts)

    def run(self, side: str, inputs: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States of one direction over the gates' inputs (time, window, 3 x HIDDEN); padding leaves a state as it is."""
        t, n, h = len(inputs), inputs.shape[1], HIDDEN
        states, state, w, kept = np.empty((t, n, h), np.float32), np.zeros((n, h), np.float32), self.p[f"{side}h"], []
        for i in (range(t) if side == "f" else range(t - 1, -1, -1)):
            x = inputs[i]
            gates = sigmoid(x[:, :2 * h] + state @ w[:, :2 * h])
            reset, update = gates[:, :h], gates[:, h:]
            inner = state @ w[:, 2 * h:]
            new = np.tanh(x[:, 2 * h:] + reset * inner)
            moved = (1 - update) * mask[i][:, None]
            if keep:
                kept.append((i, state, reset, update, inner, new, moved))
            state = state + moved * (new - state)
            states[i] = state
        return states, kept

    def pool(self, states: np.ndarray, mask: np.ndarray):
        """Logit of each window, with what the backward pass needs. Windows of padding alone pool to nothing."""
        hidden = np.tanh(states @ self.p["va"] + self.p["vb"])
        energy = hidden @ self.p["vc"]
        weight = np.exp(energy - energy.max(axis=0)) * mask
        weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        return pooled @ self.p["out"] + self.p["bias"][0], (hidden, weight, pooled)

    def logits(self, projected: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
        """Logits of windows given as word numbers (window, time), -1 for padding.

        The same as ``run`` and ``pool``, with the windows along the last axis, so that every step works on whole rows.
        """
        h, at = HIDDEN, np.ascontiguousarray(at.T)
        t, n = at.shape
        mask = (at >= 0).astype(np.float32)
        whole = bool(mask.all())
        states = np.empty((t, 2 * h, n), np.float32)
        product, gates, new = np.empty((3 * h, n), np.float32), np.empty((2 * h, n), np.float32), np.empty((h, n), np.float32)
        for k, side in enumerate("fb"):
            w = np.ascontiguousarray(self.p[f"{side}h"].T, dtype=np.float32)
            inputs = np.ascontiguousarray(projected[side][at].transpose(0, 2, 1), dtype=np.float32)
            state = np.zeros((h, n), np.float32)
            for i in (range(t) if side == "f" else range(t - 1, -1, -1)):
                x = inputs[i]
                np.matmul(w, state, out=product)
                np.add(x[:2 * h], product[:2 * h], out=gates)
                np.multiply(gates, np.float32(0.5), out=gates)  # the logistic function by the hyperbolic tangent
                np.tanh(gates, out=gates)
                gates += np.float32(1)
                gates *= np.float32(0.5)
                np.multiply(gates[:h], product[2 * h:], out=new)
                new += x[2 * h:]
                np.tanh(new, out=new)
                new -= state
                moved = np.float32(1) - gates[h:]
                if not whole:
                    moved *= mask[i]
                new *= moved
                state = state + new
                states[i, k * h:(k + 1) * h] = state
        hidden = np.tanh(np.matmul(np.ascontiguousarray(self.p["va"].T, dtype=np.float32), states) + self.p["vb"].astype(np.float32)[None, :, None])
        energy = np.einsum("h,thn->tn", self.p["vc"].astype(np.float32), hidden)
        weight = np.exp(energy - energy.max(axis=0)) * mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        score = np.einsum("h,thn->tn", self.p["out"].astype(np.float32), states)
        return (weight * score).sum(axis=0) + self.p["bias"][0]

    def project(self, embedded: np.ndarray) -> dict[str, np.ndarray]:
        """Gate inputs of each word for both directions."""
        return {side: embedded @ self.p[f"{side}x"] + self.p[f"{side}b"] for side in "fb"}

    def gradients(self, words: list[str], at: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
        """Gradients of the mean cross entropy over windows; embeddings as (bucket, gram, count) and per-word rows."""
        p, h = self.p, HIDDEN
        embedded, places = self.embed(words)
        at = np.ascontiguousarray(at.T)
        mask = (at >= 0).astype(np.float32)
        x = embedded[at] * mask[:, :, None]
        sides = {side: self.run(side, x @ p[f"{side}x"] + p[f"{side}b"], mask, keep=True) for side in "fb"}
        states = np.concatenate([sides[s][0] for s in "fb"], axis=2)
        logit, (hidden, weight, pooled) = self.pool(states, mask)
        d_logit = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"][None, :]
        d_states = weight[:, :, None] * d_pooled[None]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_hidden = d_energy[:, :, None] * p["vc"] * (1 - hidden ** 2)
        g["vc"] = np.einsum("tnh,tn->h", hidden, d_energy)
        g["va"] = np.einsum("tni,tnj->ij", states, d_hidden)
        g["vb"] = d_hidden.sum(axis=(0, 1))
        d_states = d_states + d_hidden @ p["va"].T
        d_x = np.zeros_like(x)
        for k, side in enumerate("fb"):
            w, d_w = p[f"{side}h"], np.zeros_like(p[f"{side}h"])
            d_in, d_state = np.zeros((len(x), x.shape[1], 3 * h), np.float32), np.zeros((x.shape[1], h), np.float32)
            for i, state, reset, update, inner, new, moved in reversed(sides[side][1]):
                d_state = d_state + d_states[i, :, k * h:(k + 1) * h]
                d_new = d_state * moved * (1 - new ** 2)
                d_update = -d_state * (new - state) * mask[i][:, None] * update * (1 - update)
                d_reset = d_new * inner * reset * (1 - reset)
                d_gates = np.concatenate([d_reset, d_update], axis=1)
                d_in[i, :, :2 * h], d_in[i, :, 2 * h:] = d_gates, d_new
                d_inner = d_new * reset
                d_w[:, :2 * h] += state.T @ d_gates
                d_w[:, 2 * h:] += state.T @ d_inner
                d_state = d_state * (1 - moved) + d_gates @ w[:, :2 * h].T + d_inner @ w[:, 2 * h:].T
            g[f"{side}h"], g[f"{side}b"] = d_w, d_in.sum(axis=(0, 1))
            g[f"{side}x"] = np.einsum("tni,tnj->ij", x, d_in)
            d_x += d_in @ p[f"{side}x"].T
        d_words = np.zeros_like(embedded)
        np.add.at(d_words, at[mask > 0], d_x[mask > 0])
        return g, (d_words, *places)


class Adam:
    """Adaptive steps; embedding rows are stepped only when a step touches them."""

    def __init__(self, params: dict[str, np.ndarray]):
        self.params, self.m, self.v, self.t = params, {k: np.zeros_like(v) for k, v in params.items()}, {k: np.zeros_like(v) for k, v in params.items()}, 0

    def step(self, gradients: dict[str, np.ndarray], rows: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self._move(k, slice(None), g)
        for k, (at, g) in rows.items():
            some, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(some), g.shape[1]), np.float32)
            np.add.at(total, inverse, g)
            self._move(k, some, total)

    def _move(self, k, at, g) -> None:
        self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
        self.v[k][at] = 0.99 * self.v[k][at] + 0.01 * g * g
        m, v = self.m[k][at] / (1 - 0.9 ** self.t), self.v[k][at] / (1 - 0.99 ** self.t)
        self.params[k][at] -= RATE * m / (np.sqrt(v) + 1e-8)


def window_starts(n: int) -> range:
    """Starts of all windows of ``n`` words: every stride until one reaches the end."""
    return range(0, max(n - WINDOW, 0) + STRIDE if n > WINDOW else 1, STRIDE)


def windows(numbers: np.ndarray) -> np.ndarray:
    """All windows (window, time) of a text's word numbers, -1 for padding."""
    starts = np.array(window_starts(len(numbers)))
    padded = np.concatenate([numbers, np.full(max(starts[-1] + WINDOW - len(numbers), 0), -1, dtype=np.int64)])
    return padded[starts[:, None] + np.arange(WINDOW)[None, :]]


def train(sample: list[tuple[str, int]], share: float, seed: int = 11, steps: int = STEPS) -> Network | None:
    """A network from labelled texts; None if a class is missing.

    Of each class every fifth text is kept for the calibration; a class of fewer than five texts has none to spare, and then
    all texts serve both.
    """
    labels = np.array([c for _, c in sample])
    if len(set(labels.tolist())) < 2:
        return None
    kept = np.zeros(len(sample), dtype=bool)
    for c in (0, 1):
        kept[np.flatnonzero(labels == c)[4::5]] = True
    spare = len(set(labels[kept].tolist())) == 2
    learn = [t for t, k in zip(sample, kept) if not k] if spare else sample
    y = np.array([c for _, c in learn])
    net, rng = Network(), np.random.default_rng(seed)
    known: dict[str, int] = {}
    cut = [windows(np.array([known.setdefault(w, len(known)) for w in split_words(t)], dtype=np.int64)).astype(np.int32) for t, _ in learn]
    vocabulary = list(known)
    optimiser = Adam(net.p)
    classes = [np.flatnonzero(y == c) for c in (0, 1)]
    long = [i for i in classes[1] if len(cut[i]) > WINDOWS_PER_TEXT]
    marked = _telling(cut, y, long, len(vocabulary))
    for step in range(steps):
        if step and step % MINE_STEPS == 0:
            marked = {i: int(_all_logits(net, vocabulary, cut[i]).argmax()) for i in long}
        batch = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        drawn = [cut[i] if len(cut[i]) <= WINDOWS_PER_TEXT else cut[i][_some(rng, len(cut[i]), marked.get(i))] for i in batch]
        flat = np.concatenate(drawn)
        used, local = np.unique(flat, return_inverse=True)
        offset = int(used[0] < 0)
        local = local.reshape(flat.shape) - offset
        words = [vocabulary[i] for i in used[offset:]] or [""]
        logits = net.logits(net.project(net.embed(words)[0]), local)
        ends = np.cumsum([len(d) for d in drawn])
        largest = np.array([e - len(d) + logits[e - len(d):e].argmax() for d, e in zip(drawn, ends)])
        g, (d_words, buckets, grams, counts) = net.gradients(words, local[largest], y[batch].astype(np.float32))
        optimiser.step(g, {"word": (buckets, d_words), "gram": (grams, np.repeat(d_words / counts[:, None], counts, axis=0))})
    del cut, known, vocabulary, optimiser
    apart = [t for t, k in zip(sample, kept) if k] if spare else sample
    y = np.array([c for _, c in apart])
    z = np.concatenate([text_logits(net, [t for t, _ in apart[i:i + 100]]) for i in range(0, len(apart), 100)]).reshape(-1, 1)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    a, b = logistic(z, y.astype(float), weight)
    net.calibration = (float(a), float(b))
    return net


def _telling(cut: list[np.ndarray], y: np.ndarray, long: list[int], size: int) -> dict[int, int]:
    """Of each of the ``long`` texts the window to begin with: the one with the word most peculiar to toxic texts of the sample."""
    seen = np.full((2, size), 0.5)
    for c, windows_ in zip(y, cut):
        met = np.unique(windows_)
        seen[c, met[met >= 0]] += 1
    odds = np.log(seen[1] / (y == 1).sum()) - np.log(seen[0] / (y == 0).sum())
    return {i: int(np.where(cut[i] >= 0, odds[cut[i]], -np.inf).max(axis=1).argmax()) for i in long}


def _some(rng: np.random.Generator, n: int, always: int | None) -> np.ndarray:
    """Some window numbers out of ``n``, drawn anew, and the one that has to be among them."""
    some = rng.choice(n, WINDOWS_PER_TEXT, replace=False)
    if always is not None and always not in some:
        some[0] = always
    return some


def _all_logits(net: Network, vocabulary: list[str], cut: np.ndarray, at_once: int = 2048) -> np.ndarray:
    """Logits of all windows of one training text."""
    used, local = np.unique(cut, return_inverse=True)
    offset = int(used[0] < 0)
    local = local.reshape(cut.shape) - offset
    rows = net.project(net.embed([vocabulary[i] for i in used[offset:]] or [""])[0])
    return np.concatenate([net.logits(rows, local[k:k + at_once]) for k in range(0, len(local), at_once)])


class WordTable(dict):
    """Number of each word in a growing table of gate inputs; the table starts anew when it is full."""

    def __init__(self, net: Network):
        super().__init__()
        self.net, self.rows = net, {side: np.zeros((0, 3 * HIDDEN), np.float32) for side in "fb"}

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        new = [w for w in dict.fromkeys(w for t in texts for w in t) if w not in self]
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            self.rows = {side: r[:0] for side, r in self.rows.items()}
            new = list(dict.fromkeys(w for t in texts for w in t))
        if new:
            self.update(zip(new, range(len(self), len(self) + len(new))))
            made = self.net.project(self.net.embed(new)[0])
            self.rows = {side: np.concatenate([r, made[side]]) for side, r in self.rows.items()}
        return [np.fromiter(map(self.__getitem__, t), dtype=np.int64, count=len(t)) for t in texts]


def text_logits(net: Network, texts: list[str | None], table: WordTable | None = None, at_once: int = 2048, words_at_once: int = 50_000) -> np.ndarray:
    """Largest window logit of every text. Texts go in portions of bounded length, windows in batches."""
    table = table or WordTable(net)
    found = np.empty(len(texts), dtype=np.float64)
    k = 0
    while k < len(texts):
        split, total = [], 0
        while k + len(split) < len(texts) and total < words_at_once:
            split.append(split_words(texts[k + len(split)]))
            total += len(split[-1])
        j = k + len(split)
        cut = [windows(n) for n in table.numbers(split)]
        flat, owner = np.concatenate(cut), np.repeat(np.arange(k, j), [len(c) for c in cut])
        rows = table.rows if len(table) else {side: np.zeros((1, 3 * HIDDEN), np.float32) for side in "fb"}
        logits = np.concatenate([net.logits(rows, flat[i:i + at_once]) for i in range(0, len(flat), at_once)])
        found[k:j] = np.maximum.reduceat(logits, np.flatnonzero(np.diff(owner, prepend=-1)))
        k = j
    return found


class Scorer:
    """A trained network as it goes to the workers; each keeps one table of words."""

    def __init__(self, net: Network | None, share: float):
        self.net, self.share = net, share

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.share)
        if "table" not in self.__dict__:
            self.table = WordTable(self.net)
        a, b = self.net.calibration
        number: dict[str, int] = {}
        at = [number.setdefault(t or "", len(number)) for t in texts]  # copies in a batch are scored once
        return sigmoid(np.clip(a + b * text_logits(self.net, list(number), self.table)[at], -30, 30)) if texts else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = TRAINING_DOCS) -> Scorer:
    """A scorer from at most ``per_class`` labelled documents of each class outside the held-out fold."""
    sample = training_texts(docs, labels, label, per_class)
    frequency = {r.q: r.n for r in labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy(F.col(label).cast("int").alias("q")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = frequency.get(1, 0) / sum(frequency.values()) if frequency else 0.0
    return Scorer(train(sample, share), share)


def add_score(docs: DataFrame, scorer: Scorer, out: str = "score", keep: list[str] | None = None) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(scorer)  # a few megabytes of parameters, whatever the corpus
    return map_columns(docs, ["text"], f"`{out}` double", lambda texts: {out: shared.value(texts).tolist()}, keep=keep)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = add_score(docs.select("doc_id", "text"), fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
