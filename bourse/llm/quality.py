"""Quality rules: a logistic regression on hashed word and character n-grams.

Features are the shares of a text's word unigrams and bigrams, and of its
character n-grams (two to four UTF-8 bytes), that fall into each of BUCKETS
hash buckets. The regression is trained on labelled quality rows, a bounded
sample chosen by a hash of the id, and calibrated (Platt) on a part of them it
was not fitted to. Texts are scored whole in Arrow batches: a text's logit is
the mean weight of its n-grams, so no feature vector is built. A text is kept
where its calibrated probability of good quality reaches THRESHOLD and the
base rules do not fail it.

Base rules. Words are runs of other than ASCII white space; ``n_repeat_words``
counts the words in windows of eight words that occur twice or more in the
text. A text fails with fewer than 20 words, or where more than 30 in a
hundred words are repeated.

Results for odd rows: a null text is empty: no words, fails; a null id stays;
rows that repeat an id are judged each, and the least of their texts teaches;
without labels of both classes the regression says nothing and only the base
rules decide; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage

BITS = 18
BUCKETS = 1 << BITS
CHARS = (2, 3, 4)
#: Labelled rows that training looks at, at most, of either class.
MAX_ROWS = 800
#: Least calibrated probability of good quality.
THRESHOLD = 0.2
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_WHITE = bytes(range(9, 14)) + b" "
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.random.default_rng(8).integers(0, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, kept while it stays small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(data: bytes, hashes: WordHashes) -> np.ndarray:
    words = data.split()  # of bytes: ASCII white space only
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * _ODD) >> np.uint64(64 - BITS)).astype(np.int64)


def parts(data: bytes, words: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams of each kind, one entry for each occurrence."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    out, h = [], np.zeros(len(b), np.uint64)
    for k in range(max(CHARS)):
        if len(b) <= k:
            break
        h = h[:len(b) - k] * np.uint64(257) + b[k:] + np.uint64(1)
        if k + 1 in CHARS:
            out.append(_bucket(h + np.uint64(k)))
    out.append(_bucket(words))
    out.append(_bucket(words[:-1] * _PLACE[0] + words[1:] * _PLACE[1]))
    return out


def logit(data: bytes, words: np.ndarray, weights: np.ndarray) -> float:
    return float(sum(weights[p].mean() for p in parts(data, words) if len(p)))


def sparse(data: bytes, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same features as buckets and their shares."""
    found = [p for p in parts(data, words) if len(p)]
    if not found:
        return np.empty(0, np.int64), np.empty(0)
    at, share = np.concatenate(found), np.concatenate([np.full(len(p), 1 / len(p)) for p in found])
    unique, inverse = np.unique(at, return_inverse=True)
    return unique, np.bincount(inverse, share)


class Model:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def probability(self, data: bytes, words: np.ndarray) -> float:
        z = self.slope * (logit(data, words, self.weights) + self.bias) + self.offset
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt: the logistic regression of labels on logits, targets smoothed."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([z, np.ones(len(z))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - t) + 1e-6 * w)
        w -= move / max(1.0, np.abs(move).max())
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], steps: int = 150) -> Model | None:
    """Weights by Adam over all rows, both classes of equal weight; every
    fourth row of either class is left for the calibration."""
    y = np.array(labels)
    if not (y > 0).any() or not (y <= 0).any():
        return None
    rank = np.zeros(len(y), int)
    for k in (0, 1):
        rank[y == k] = np.arange((y == k).sum())
    aside = (rank % 4 == 3) & bool(min((y > 0).sum(), (y <= 0).sum()) >= 8)
    at = np.concatenate([r[0] for r in rows])
    share = np.concatenate([r[1] for r in rows]).astype(np.float32)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    used, col = np.unique(at, return_inverse=True)
    fit_on = ~aside
    c = np.where(y > 0, 0.5 / (fit_on & (y > 0)).sum(), 0.5 / (fit_on & (y <= 0)).sum()) * fit_on
    w, b = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    scores = lambda: np.bincount(row, share * w[col], len(rows)) + b
    for k in range(1, steps + 1):
        r = c * (1 / (1 + np.exp(-np.clip(scores(), -30, 30))) - y)
        g = np.append(np.bincount(col, share * r[row], len(used)) + 1e-6 * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-7)
        w, b = w - move[:-1], b - move[-1]
    z = scores()
    slope, offset = _calibrate(z[aside], y[aside]) if aside.any() else (1.0, 0.0)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return Model(weights, float(b), slope, offset)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """A model from at most ``max_rows`` labelled rows of either class, those
    with the least hash of their id. Features are computed where the texts lie;
    the driver gets the sample's sparse vectors."""
    one = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where("_id is not null and _y is not null")
           .groupBy("_id").agg(F.min("_y").alias("_y")))
    # the sample comes from ids that are among the documents, one row for each
    there = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct()
    one = stage(one.join(there, "_id", "left_semi"), "quality-labels")
    key = F.xxhash64("_id")
    chosen = one.where("_y > 0").orderBy(key, "_id").limit(max_rows).union(one.where("_y <= 0").orderBy(key, "_id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(stage(chosen, "quality-sample"), "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t"))

    def featurize(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            found = []
            for t in batch.column(2).to_pylist():
                data = (t or "").encode()
                found.append(sparse(data, word_hashes(data, hashes)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
                ["_id", "_y", "at", "share"])

    kinds = dict(rows.dtypes)
    got = rows.mapInArrow(featurize, f"_id {kinds['_id']}, _y {kinds['_y']}, at array<int>, share array<float>").toArrow().sort_by([("_id", "ascending")])
    y = [int(v > 0) for v in got.column("_y").to_pylist()]
    return fit([(np.asarray(a.values, np.int64), np.asarray(s.values, np.float64)) for a, s in zip(got.column("at"), got.column("share"))], y)


def repeated_words(words: np.ndarray) -> int:
    """Words in windows of WINDOW words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        h += words[j:j + n] * _PLACE[j]
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    cover[:n] += twice
    cover[WINDOW:WINDOW + n] -= twice
    return int((np.cumsum(cover)[:-1] > 0).sum())


def base_counts(text: str, data: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    white = len(data) - len(data.translate(None, _WHITE))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), len(text) - white, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``quality``
    (the calibrated probability; null without a model) per row."""
    kind = dict(docs.dtypes)[id_col]

    def score(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            found, probability = [], []
            for t in batch.column(1).to_pylist():
                text = t or ""
                data = text.encode()
                words = word_hashes(data, hashes)
                found.append(base_counts(text, data, words))
                probability.append(model.probability(data, words) if model else None)
            cols = list(zip(*found)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols], pa.array(probability, pa.float64())], ["doc_id", *COUNTS, "quality"])

    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, f"doc_id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, quality double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & F.coalesce(F.col("quality") >= THRESHOLD, F.lit(True))).alias("kept"), "quality")
