"""Language identification by multinomial naive Bayes over hashed character
n-grams.

A text is its lower-cased letters, every run of other characters one space,
with a space at either end. Its n-grams of one to four characters that hold a
letter are hashed into buckets. Training counts each language's n-grams: tasks
add up what they read, Spark adds up the counts of each language and bucket, and
the driver meets only the matrix of log probabilities. It is trained on about MAX_ROWS texts of each language,
chosen by a hash of id and text (all texts where a language has no more). The
matrix has one row for each bucket and one column for each language; the number
of buckets is the largest power of two that keeps it within MATRIX_BYTES, so
what is broadcast has that bound for up to 60,000 languages (256 buckets, the
least, grow with the languages beyond).

Scoring is one pass over whole texts in Arrow batches: the rows of a text's
n-grams are gathered and added up, a bounded number at a time, and the language
with the largest sum (ties: the first in order) is predicted. Its score is its
share of the likelihoods, each brought to the power 1 / sqrt(n) for n n-grams,
since n-grams of one text are not independent.

Results for odd rows: a null text, or one without a letter, is ``und`` with
score 0; a null id is kept and never held out; rows that repeat an id are judged
each; rows of unknown language, held-out rows and texts without a letter teach
nothing; where nothing is learnt every text is ``und``; an empty table gives an
empty table. Only text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stage

LENGTHS = 4
#: Texts of a language that training reads, about, where there are more.
MAX_ROWS = 4000
#: Bound of the matrix of log probabilities, and of buckets.
MATRIX_BYTES, MAX_BITS = 64_000_000, 17
#: N-grams that are gathered at a time, and added up in single precision.
GATHERED = 1 << 13
SMOOTHING = 0.1
UNKNOWN = "und"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def codes(text: str | None) -> np.ndarray:
    """Code points of the normalized text; empty without a letter."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[c]
    if not letter.any():
        return np.empty(0, np.uint64)
    kept = letter | np.concatenate(([False], letter[:-1]))
    out = np.where(letter, c, np.uint32(32))[kept].astype(np.uint64)
    head = [] if out[0] == 32 else [np.full(1, 32, np.uint64)]
    tail = [] if out[-1] == 32 else [np.full(1, 32, np.uint64)]
    return np.concatenate([*head, out, *tail])


def buckets(c: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of every n-gram but the space alone."""
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(min(LENGTHS, len(c))):
        h = h[:len(c) - n] * np.uint64(0x110001) + c[n:] + np.uint64(1)
        out.append(((h if n else h[c != 32]) * _MIX) >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


class Model:
    """Languages in order and the log probabilities, one row for each bucket.
    All languages are as likely beforehand."""

    def __init__(self, langs: list[str], matrix: np.ndarray):
        self.langs, self.matrix = langs, matrix
        self.bits = len(matrix).bit_length() - 1

    def judge(self, text: str | None) -> tuple[str, float]:
        at = buckets(codes(text), self.bits)
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        for k in range(0, len(at), GATHERED):
            total += np.einsum("ij->j", self.matrix.take(at[k:k + GATHERED], 0))
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp((total - total[best]) / np.sqrt(len(at))).sum())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counter(bits: int):
    """Adds up a task's counts: one row for each language and bucket met."""
    def rows(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], ["lang", "bucket", "n"])

    def count(batches) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = buckets(codes(text), bits)
                for k in range(0, len(at), GATHERED):
                    if lang not in held:
                        held[lang] = np.zeros(1 << bits, np.int64)
                    np.add.at(held[lang], at[k:k + GATHERED], 1)
                if len(held) << (bits + 3) > MATRIX_BYTES:
                    yield from rows(held)
                    held = {}
        yield from rows(held)
    return count


def _logs(bits: int):
    """A language's counts, smoothed, as log probabilities of all buckets."""
    def logs(key: tuple[pa.Scalar, ...], counts: pa.Table) -> pa.Table:
        total = np.zeros(1 << bits)
        total[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
        p = np.log(total + SMOOTHING) - np.log(total.sum() + SMOOTHING * len(total))
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "logs": pa.array([p.astype(np.float32).tobytes()], pa.binary())})
    return logs


def train(docs: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the rows that are not held out. The languages are known by
    their text, whatever their type."""
    rows = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    sizes = stage(rows.groupBy("lang").agg(F.count("*").alias("n")), "langid-sizes")
    languages = sizes.count()
    bits = min(MAX_BITS, max(8, (MATRIX_BYTES // (4 * max(languages, 1))).bit_length() - 1))
    # a text is in where its hash falls in the language's share
    share = F.least(F.lit(1.0), F.lit(float(max_rows)) / F.col("n"))
    chosen = rows.join(sizes, "lang").where((share >= 1) | (F.xxhash64("id", "text").cast("double") / F.lit(2.0**64) + 0.5 < share))
    counts = chosen.select("lang", "text").mapInArrow(_counter(bits), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").applyInArrow(_logs(bits), "lang string, logs binary").collect()
    found = sorted((r["lang"], bytes(r["logs"])) for r in found)
    matrix = np.stack([np.frombuffer(x, np.float32) for _, x in found], 1) if found else np.zeros((1 << bits, 0), np.float32)
    return Model([x for x, _ in found], np.ascontiguousarray(matrix))


def identify(docs: DataFrame, model: Model | Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id held_out lang_pred score`` per row."""
    kind = dict(docs.dtypes)[id_col]
    shared = model if isinstance(model, Broadcast) else docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        known = shared.value
        for batch in slices(batches):
            found = [known.judge(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
