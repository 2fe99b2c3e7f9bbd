"""Toxicity by a subsequence string kernel and a support vector machine.

A text is a set of units: its lower-cased words without marks, where single
characters in a row (``i d i o t``) make one unit; long units are cut into
overlapping pieces. The kernel of two strings sums over all subsequences of
ORDER characters, each weighted by DECAY to the length it spans in either
string, and is normalized, so a word with gaps or inserted characters stays
close to the plain one.

Training, on a bounded sample of the labelled rows (MAX_TOXIC, MAX_CLEAN,
chosen by a hash of the id): short character cores that mark toxic documents
and hardly occur in clean ones are chosen greedily, each time for the units
that no earlier core explains, as many as are significant. Where none is (few
labels), the best-ranked ones are taken, and scores stay below the threshold:
documents are ranked, none is rejected. Cores and a few clean units that look like them
are the Nystrom landmarks; a linear SVM in that space separates units with a
core, plain and with inserted characters, from units of clean documents. A
logistic regression of a document's best margins, on the same labelled
documents, gives the score.

Scoring runs over whole texts in Arrow batches. A unit whose longest common
subsequence with every core is below REACH and six tenths of the core has no
common kernel mass to speak of and counts as clean; this is part of the model at every size. Units are
judged once per task, by value.

Results for odd rows: a null or empty text has no units and gets the score of
a text without any insult; a null id is kept and never held out; rows that
repeat an id are scored each; labels that repeat an id count as toxic if any
is; without labels of both classes, or where the toxic rows have no unit of
four characters, nothing is learnt and every score is 0; an empty table gives
an empty table. Language, source and id are no inputs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stage

ORDER, DECAY, REACH = 3, 0.6, 4
#: Labelled rows that training looks at, at most, of either class.
MAX_TOXIC, MAX_CLEAN = 600, 1500
CLEAN_LANDMARKS, THRESHOLD = 12, 0.7
#: Cores that are chosen where none is significant, and the factor of their
#: scores, below the threshold.
BEST_RANKED, WEAK = 8, 0.69
#: A core grows by a character that this share of its units has, to at most so many.
SHARED, MAX_CORE = 0.7, 12
#: A longer unit is cut into pieces of this length, half overlapping.
PIECE = 32
#: Share of clean documents in which a core may occur, over that of toxic ones.
RARE = 0.01

_MARKS = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)\w(?:[\W_]{1,3}\w){2,}(?!\S)")


def tokens_of(text: str) -> set[str]:
    """Distinct lower-cased words, and runs of single characters as one word."""
    low = text.lower()
    found = set(low.split())
    for m in _SPACED.finditer(low):
        found.add(m[0])
    return found


def units_of_token(token: str) -> list[str]:
    u = _MARKS.sub("", token)
    if len(u) <= PIECE:
        return [u] if len(u) > 2 else []
    return [u[i:i + PIECE] for i in range(0, len(u) - PIECE // 2, PIECE // 2)]


def units_of(text: str | None) -> set[str]:
    return {u for t in tokens_of(text or "") for u in units_of_token(t)}


def _codes(strings: list[str], alphabet: dict[str, int]) -> np.ndarray:
    width = max(map(len, strings), default=1) or 1
    out = np.full((len(strings), width), -1, np.int32)
    for i, s in enumerate(strings):
        out[i, :len(s)] = [alphabet.get(c, -1) for c in s]
    return out


def kernel(strings: list[str], others: list[str] | None = None) -> np.ndarray:
    """Gap-weighted subsequence kernel of each string with each of ``others``
    (not normalized); without them, of each string with itself."""
    alphabet: dict[str, int] = {}
    for s in [*(others or []), *([] if others else strings)]:
        for c in s:
            alphabet.setdefault(c, len(alphabet))
    order = np.argsort([-len(s) for s in strings], kind="stable")
    a = _codes([strings[i] for i in order], alphabet)
    lengths = np.array([len(strings[i]) for i in order])
    t = _codes(others, alphabet)[None] if others else a[:, None, :]
    n, m, w = len(strings), t.shape[1], t.shape[2]
    step = np.arange(w)
    # carry[j, k]: a match at j still open at k
    carry = np.where(step[:, None] <= step[None, :], DECAY ** (step[None, :] - step[:, None] + 2.0), 0.0).astype(np.float32)
    inner = [np.ones((n, m, w + 1), np.float32)] + [np.zeros((n, m, w + 1), np.float32) for _ in range(ORDER - 1)]
    total = np.zeros((n, m), np.float32)
    for k in range(a.shape[1]):
        live = int(np.searchsorted(-lengths, -k, side="left"))
        if not live:
            break
        same = ((a[:live, k, None, None] == t[:live] if not others else a[:live, k, None, None] == t) & (a[:live, k, None, None] >= 0)).astype(np.float32)
        total[:live] += DECAY ** 2 * (inner[ORDER - 1][:live, :, :w] * same).sum(axis=2)
        for i in range(ORDER - 1, 0, -1):
            inner[i][:live, :, 1:] = DECAY * inner[i][:live, :, 1:] + (inner[i - 1][:live, :, :w] * same) @ carry
    out = np.empty((n, m), np.float32)
    out[order] = total
    return out if others else out[:, 0]


class Cores:
    """Longest common subsequence of units with a few short strings, all at
    once by bit-parallel steps."""

    def __init__(self, cores: list[str]):
        self.alphabet = {c: i for i, c in enumerate(sorted(set("".join(cores))))}
        self.masks = np.zeros((len(self.alphabet) + 1, len(cores)), np.uint16)
        for j, core in enumerate(cores):
            for i, c in enumerate(core):
                self.masks[self.alphabet[c], j] |= 1 << i
        self.full = np.array([(1 << len(c)) - 1 for c in cores], np.uint16)
        self.need = np.array([max(min(REACH, len(c)), math.ceil(0.6 * len(c))) for c in cores])

    def reached(self, units: list[str]) -> np.ndarray:
        order = np.argsort([-len(u) for u in units], kind="stable")
        a = _codes([units[i] for i in order], self.alphabet)
        lengths = np.array([len(units[i]) for i in order])
        v = np.full((len(units), len(self.full)), 0x7FFF, np.uint16)
        for k in range(a.shape[1]):
            live = int(np.searchsorted(-lengths, -k, side="left"))
            if not live:
                break
            m = self.masks[a[:live, k]]
            u = v[:live] & m
            v[:live] = ((v[:live] + u) | (v[:live] - u)) & 0x7FFF
        common = np.bitwise_count(~v & self.full)
        out = np.empty(len(units), bool)
        out[order] = (common >= self.need).any(axis=1)
        return out


class Model:
    """What training leaves: landmarks, the SVM and the score."""

    def __init__(self, cores, landmarks, whiten, weights, bias, final, weak=False):
        self.cores, self.landmarks, self.whiten, self.weights, self.bias, self.final, self.weak = cores, landmarks, whiten, weights, bias, final, weak

    def features(self, units: list[str]) -> np.ndarray:
        if not hasattr(self, "_own"):
            self._own = np.sqrt(kernel(self.landmarks))
        k = kernel(units, self.landmarks) / (np.sqrt(np.maximum(kernel(units), 1e-12))[:, None] * self._own)
        return k @ self.whiten

    def margins(self, units: list[str]) -> np.ndarray:
        return self.features(units) @ self.weights + self.bias if units else np.empty(0)


FLOOR = -1.0
#: Bytes of tokens that a task remembers, bytes of text that it looks at at a
#: time, units compared with all cores and kernels computed together.
KNOWN_BYTES, TEXT_BYTES, UNITS, KERNELS = 24_000_000, 500_000, 16_384, 16_384


class Judge:
    """Scores texts with a model, knowing the tokens it has met."""

    def __init__(self, model: Model | None):
        self.model, self.known, self.held = model, {}, 0
        self.cores = Cores(model.cores) if model else None

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.known]
        if not new:
            return
        units = [(i, u) for i, t in enumerate(new) for u in units_of_token(t)]
        best = np.full(len(new), FLOOR)
        if units:
            which, strings = np.array([i for i, _ in units]), [u for _, u in units]
            step = max(64, KERNELS // len(self.model.landmarks))
            for b in range(0, len(strings), UNITS):
                at = b + np.flatnonzero(self.cores.reached(strings[b:b + UNITS]))
                for c in range(0, len(at), step):
                    part = at[c:c + step]
                    np.maximum.at(best, which[part], self.model.margins([strings[i] for i in part]))
        self.known.update(zip(new, best.tolist()))
        # a string, a float and their entry take about 200 bytes besides the characters
        self.held += sum(map(len, new)) + 200 * len(new)

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Per text: best and second best margin of its tokens, and the
        logarithm of how many are positive."""
        sets = [tokens_of(t or "") for t in texts]
        if self.held > KNOWN_BYTES:
            self.known, self.held = {}, 0
        self.learn(set().union(*sets))
        out = np.empty((len(texts), 3))
        known = self.known
        for i, s in enumerate(sets):
            top = sorted((m for m in map(known.__getitem__, s) if m > FLOOR), reverse=True)
            out[i] = (*(top + [FLOOR, FLOOR])[:2], np.log1p(sum(m > 0 for m in top)))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(texts))
        w, b = self.model.final
        score = 1 / (1 + np.exp(-(self.evidence(texts) @ w + b)))
        return score * WEAK if self.model.weak else score


def without_copies(docs: list[set[str]]) -> list[int]:
    """Positions of documents that look like no earlier one: none of the least
    hashes of their long units was met before. Copies would make their rare
    words look common."""
    met: set[tuple[int, int]] = set()
    out = []
    for i, d in enumerate(docs):
        long = [u.encode() for u in d if len(u) >= 8]
        marks = {(k, min(zlib.crc32(u, k) for u in long)) for k in range(4)} if long else set()
        if not marks & met:
            out.append(i)
        met |= marks
    return out


def extended(core: str, docs: list[set[str]]) -> str:
    """The core with the characters that most documents' units have beside it."""
    words = Counter(u for d in docs for u in d if core in u)
    while len(core) < MAX_CORE:
        grown: Counter = Counter()
        for u, n in words.items():
            if (i := u.find(core)) >= 0:
                if i:
                    grown[u[i - 1:i + len(core)]] += n
                if i + len(core) < len(u):
                    grown[u[i:i + len(core) + 1]] += n
        longer, n = max(grown.items(), key=lambda x: (x[1], x[0]), default=("", 0))
        if n < SHARED * sum(k for u, k in words.items() if core in u):
            break
        core = longer
    return core


def choose_cores(toxic: list[set[str]], clean: list[set[str]]) -> tuple[list[str], list[set[str]], bool]:
    """Cores in the order chosen, each toxic document's units with a core, and
    whether the cores are weak: none is significant, the best-ranked grams are
    taken."""
    grams = lambda units: {u[i:i + n] for u in units for n in (4, 5) for i in range(len(u) - n + 1)}
    hot: Counter = Counter()
    for d in toxic:
        hot.update(grams(d))
    # a gram of one document only, where no two share one
    least = min(max(2, round(0.005 * len(toxic))), max(hot.values(), default=1))
    hot = Counter({g: n for g, n in hot.items() if n >= least})
    cold: Counter = Counter()
    for d in clean:
        cold.update(g for g in grams(d) if g in hot)
    share = len(toxic) / (len(toxic) + len(clean))

    def surprise(n: int, other: int) -> float:
        """Bound of -ln of the chance that so many of n + other are toxic."""
        r = n / (n + other)
        return (n + other) * (r * np.log(r / share) + ((1 - r) * np.log((1 - r) / (1 - share)) if r < 1 else 0.0))

    # no more than a thousandth of a core is expected to pass by chance
    limit = np.log(1000.0 * max(len(hot), 1))
    rare = {g: surprise(n, cold[g]) for g, n in hot.items() if cold[g] / max(len(clean), 1) <= RARE * n / len(toxic)}
    marks = {g for g, x in rare.items() if x >= limit}
    weak = not marks
    if weak:
        marks = set(sorted(rare or {g: surprise(n, cold[g]) for g, n in hot.items()}, key=lambda g: (-rare.get(g, 0), g))[:BEST_RANKED])
    open_units = [{u for u in d if any(u[i:i + n] in marks for n in (4, 5) for i in range(len(u) - n + 1))} for d in toxic]
    suspects, cores = [set(d) for d in open_units], []
    while True:
        count: Counter = Counter()
        for d in open_units:
            count.update(grams(d) & marks)
        if not count:
            break
        core, n = max(count.items(), key=lambda x: (x[1], len(x[0]), x[0]))
        if n < least:
            break
        core = extended(core, open_units)
        cores.append(core)
        open_units = [{u for u in d if core not in u} for d in open_units]
    return cores, [{u for u in d if any(c in u for c in cores)} for d in suspects], weak


def _svm(x: np.ndarray, y: np.ndarray, reg: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, both classes of equal weight) by Newton steps
    on the rows inside the margin."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    c = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    ridge = np.eye(x1.shape[1]) * reg
    ridge[-1, -1] = 1e-8
    w = np.zeros(x1.shape[1])
    active = np.ones(len(x), bool)
    for _ in range(steps):
        xa = x1[active] * c[active, None]
        w = np.linalg.solve(xa.T @ x1[active] + ridge, xa.T @ y[active])
        now = y * (x1 @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, reg: float = 1e-3) -> tuple[np.ndarray, float]:
    """Newton steps; both classes of equal weight."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    c = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y <= 0).sum())
    w = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (c * (p - y)) + reg * w
        hess = (x1 * (c * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x1 + reg * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move / max(1.0, np.abs(move).max() / 2)
        if np.abs(move).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(texts: list[str | None], labels: list[int]) -> Model | None:
    """A model from texts and their labels; None without both classes."""
    docs, y = [units_of(t) for t in texts], np.array(labels)
    if not (y > 0).any() or not (y <= 0).any():
        return None
    kept = without_copies(docs)
    docs, y, texts = [docs[i] for i in kept], y[kept], [texts[i] for i in kept]
    toxic, clean = [d for d, k in zip(docs, y) if k], [d for d, k in zip(docs, y) if not k]
    if not toxic or not clean:
        return None
    rng = np.random.default_rng(5)
    cores, marked, weak = choose_cores(toxic, clean)
    if not cores:
        return None
    common = Counter(u for d in clean for u in d)
    pool = sorted(common)
    near = np.flatnonzero(Cores(cores).reached(pool)) if pool else np.empty(0, int)
    hard = [pool[i] for i in rng.permutation(near)[:3000]]
    easy = [pool[i] for i in rng.permutation(len(pool))[:1500]]
    plain = sorted({u for d in marked for u in d if len(u) > 2})
    plain = [plain[i] for i in rng.permutation(len(plain))[:1500]]

    def disturbed(u: str) -> str:
        # one or two inserted characters
        for _ in range(int(rng.integers(1, 3))):
            k = int(rng.integers(1, len(u)))
            u = u[:k] + "xqzj*"[int(rng.integers(0, 4))] + u[k:]
        return u

    good = [u for u in plain + [disturbed(u) for u in plain] + cores]
    bad = hard + easy
    landmarks = cores + [u for u in hard if ORDER <= len(u) <= 12][:CLEAN_LANDMARKS]
    landmarks = [u for u in dict.fromkeys(landmarks) if len(u) >= ORDER]
    own = np.sqrt(kernel(landmarks))
    gram = kernel(landmarks, landmarks) / (own[:, None] * own)
    value, vector = np.linalg.eigh(gram.astype(np.float64))
    whiten = (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    model = Model(cores, landmarks, whiten, np.zeros(len(landmarks)), 0.0, (np.zeros(3), 0.0), weak)
    good, bad = ([u for u in x if len(u) >= ORDER] for x in (good, bad))
    x = np.vstack([model.features(good), model.features(bad)]) if bad else model.features(good)
    target = np.concatenate([np.ones(len(good)), -np.ones(len(bad))])
    if bad:
        model.weights, model.bias = _svm(x, target)
    judge = Judge(model)
    seen = np.vstack([judge.evidence(texts[i:i + 200]) for i in range(0, len(texts), 200)])
    model.final = _logistic(seen, (y > 0).astype(float))
    del model._own
    return model


def in_training(doc_id: Column) -> Column:
    """Rows that may be learnt from; the others are held out."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """A model from at most so many labelled rows of either class, those with
    the least hash of their id, of which none is held out."""
    one = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where("_id is not null and _y is not null")
           .where(in_training(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y")))
    # the sample comes from rows that are among the documents
    there = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct()
    one = stage(one.join(there, "_id", "left_semi"), "toxic-labels")
    key = F.xxhash64("_id")
    chosen = one.where("_y > 0").orderBy(key, "_id").limit(max_toxic).union(one.where("_y <= 0").orderBy(key, "_id").limit(max_clean))
    chosen = stage(chosen, "toxic-sample")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(chosen, "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t"))
    rows = sorted((r["_id"], r["_t"], int(r["_y"] > 0)) for r in rows.toLocalIterator() if r["_t"] is not None)
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id held_out score predicted`` per row."""
    kind = dict(docs.dtypes)[id_col]

    def score(batches):
        judge = Judge(model)
        for batch in slices(batches, TEXT_BYTES):
            s = judge.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold."""
    at = docs.columns.index(text_col)

    def keep(batches):
        judge = Judge(model)
        for batch in slices(batches, TEXT_BYTES):
            yield batch.filter(pa.array(judge.scores(batch.column(at).to_pylist()) < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
