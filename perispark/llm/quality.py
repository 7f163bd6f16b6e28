"""Quality score from compression: does a dictionary of good or of bad text compress a document better?

Zstandard dictionaries are trained on labelled good and on bad text, several on separate documents of each class, so that no
one passage that got into a dictionary decides. A document is cut into blocks, so that the
dictionaries matter over its whole length, and every block is compressed with all. The difference of the summed sizes,
normalised by the compressed and by the plain size, goes through a logistic calibration that was fitted on labelled
documents kept out of the dictionaries and weighted to the labels' own frequencies.

Defined results: a null or empty text has difference 0 and gets that difference's score; repeated rows score alike; if
the labelled rows outside the held-out fold lack a class, or are too few for a dictionary, every document scores the
share of good labels (1 without any); a text of any length is compressed whole; an empty table stays empty; other columns
are not read, and ``add_score`` keeps them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.llm.common import held_out, map_columns, training_texts

TRAINING_DOCS = 1_600  # bound of the sample per class: half for the dictionaries, half for the calibration
BLOCK_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 2048, 65_536, 256, 3
FRAME_BYTES = 6  # magic number and header of a frame, the same with either dictionary
DICTIONARIES = 3  # per class
KEEP_FROM = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Both classes' dictionaries and the calibration: knee of the plain-size difference, feature means and spreads, weights."""

    bad: tuple[bytes, ...]
    good: tuple[bytes, ...]
    knee: float
    centre: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]
    share: float  # score where there is nothing to learn from


@lru_cache(maxsize=4)
def _compressors(model: QualityModel):
    import zstandard

    def compressor(data: bytes):
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False)

    return [[compressor(d) for d in side] for side in (model.bad, model.good)]


def differences(model: QualityModel, text: str | None) -> tuple[float, float]:
    """Bad less good size over both sizes' sum, and over the plain size; positive where the good dictionary does better."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0, 0.0
    bad, good = _compressors(model)
    b = g = 0
    for k in range(0, len(data), BLOCK_BYTES):
        block = data[k:k + BLOCK_BYTES]
        b += sum([len(c.compress(block)) - FRAME_BYTES for c in bad])
        g += sum([len(c.compress(block)) - FRAME_BYTES for c in good])
    return (b - g) / max(b + g, 1), (b - g) / (len(data) * len(good))


def _features(pairs: np.ndarray, knee: float) -> np.ndarray:
    return np.column_stack([pairs, np.minimum(pairs[:, 1], knee)])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 100) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression: Newton steps, halved until the loss falls.

    Columns are standardised inside, so the ridge weighs them alike and neither scale nor separable classes upset it.
    """
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / spread])
    penalty = ridge * np.r_[0.0, np.ones(x.shape[1])]

    def loss(w: np.ndarray) -> float:
        margin = z @ w
        return float((weight * (np.logaddexp(0, margin) - y * margin)).sum() + (penalty * w * w).sum() / 2)

    w = np.zeros(z.shape[1])
    least = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + penalty * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-8 and (now := loss(w - size * step)) > least:
            size /= 2
        if size <= 1e-8 or least - now < 1e-9:
            break
        w, least = w - size * step, now
    slopes = w[1:] / spread
    return np.r_[w[0] - slopes @ centre, slopes]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = TRAINING_DOCS) -> QualityModel:
    """A model from at most ``per_class`` labelled documents of each class outside the held-out fold."""
    import zstandard

    sample = training_texts(docs, labels, label, per_class)
    frequency = {r.q: r.n for r in labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy(F.col(label).cast("int").alias("q")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = frequency.get(1, 0) / sum(frequency.values()) if frequency else 1.0
    by_class = {q: [t for t, c in sample if c == q] for q in (0, 1)}
    nothing = QualityModel((), (), 0.0, (), (), (), share)
    if min(map(len, by_class.values())) < 4:
        return nothing
    dictionaries = {}
    for q, texts in by_class.items():
        data = [t.encode("utf-8", "surrogatepass") for t in texts[::2]]
        made = []
        for part in range(DICTIONARIES):
            blocks = [d[k:k + SAMPLE_BYTES] for d in data[part::DICTIONARIES] for k in range(0, len(d), SAMPLE_BYTES)]
            try:
                made.append(zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, blocks)) // 4)), blocks, level=LEVEL).as_bytes())
            except (zstandard.ZstdError, ValueError):
                return nothing
        dictionaries[q] = tuple(made)
    model = QualityModel(dictionaries[0], dictionaries[1], 0.0, (), (), (), share)
    rest = [(t, q) for q in (0, 1) for t in by_class[q][1::2]]
    y = np.array([q for _, q in rest], dtype=float)
    pairs = np.array([differences(model, t) for t, _ in rest])
    knee = float((pairs[y == 0, 1].mean() + pairs[y == 1, 1].mean()) / 2)
    x = _features(pairs, knee)
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = logistic((x - centre) / spread, y, weight)
    return QualityModel(model.bad, model.good, knee, tuple(centre), tuple(spread), tuple(w), share)


def score_texts(model: QualityModel, texts: list[str | None]) -> np.ndarray:
    if not model.weights or not texts:
        return np.full(len(texts), model.share)
    x = _features(np.array([differences(model, t) for t in texts]), model.knee)
    z = model.weights[0] + (x - np.array(model.centre)) / np.array(model.spread) @ np.array(model.weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def add_score(docs: DataFrame, model: QualityModel, out: str = "score", keep: list[str] | None = None) -> DataFrame:
    return map_columns(docs, ["text"], f"`{out}` double", lambda texts: {out: score_texts(model, texts).tolist()}, keep=keep)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = add_score(docs.select("doc_id", "text"), fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
