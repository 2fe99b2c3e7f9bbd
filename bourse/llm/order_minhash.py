"""Near-duplicate documents by Order MinHash.

A document is the sequence of its five-word shingles, each labelled with its
occurrence (first, second, ...), so no label occurs twice in a document. A
sketch takes the two least labelled shingles under one hash function and keeps
their text order; three sketches make a band. Equal bands propose candidates:
two documents whose shingles agree by 0.8 share one of the 20 bands with
probability above 0.997, and only where the order agrees too.

Candidates are verified by a banded alignment of the shingles themselves, not of
their labels, as one changed occurrence gives all later ones another label. The
alignment is the longest common subsequence, computed with one bit per column;
columns further from the diagonal than any alignment of 0.8 allows are left
out. Where no shingle repeats, it is the longest chain of shared shingles that
rises in both documents. Similarity is ``m / (n1 + n2 - m)`` for ``m`` aligned
shingles, and 0.8 or more is a link.

Exact copies are grouped first by their text's digest (a partial aggregation)
and only one of each class is compared. The classes in a band are first
compared with one leader of the band, in LEADER_ROUNDS rounds with other
leaders; the links are joined into components. Then every pair in a band that
still lies in different components is compared too, so nothing is capped, and
a group of thousands of near copies costs thousands of comparisons, not
millions.

A pair in a band is aligned only where its signatures agree: 512 minima of the
labelled shingles, four bits of each, compared inside the join. Documents of
similarity 0.8 agree in so many with probability above 0.998; most that share
a passage do not, and are never emitted as a pair.

Results for odd rows: a null text is never a copy of another; texts without a
word link with nothing; fewer than five words are one shingle; rows that
repeat an id and its text share a class; another text of that id is another
class, grouped by its own links, and stays or goes by itself; an empty table gives an empty table;
only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, unstage
from .components import connected_components

WORDS, SIMILARITY = 5, 0.8
#: Least shingles in a sketch, sketches in a band, bands.
LEAST, ROWS, BANDS = 2, 3, 20
#: Rounds in which a band's classes meet one leader each.
LEADER_ROUNDS = 2
#: Minima in a signature, and how many must agree: three standard deviations
#: below what a pair of similarity 0.8 is expected to agree in by its minima or
#: by chance (one in sixteen).
MINIMA = 512
_AGREE = SIMILARITY + (1 - SIMILARITY) / 16
LEAST_AGREEING = math.floor(MINIMA * _AGREE - 3.0 * math.sqrt(MINIMA * _AGREE * (1 - _AGREE)))
#: Columns of a text hashed at once.
_BLOCK = 4096
#: Occurrences of a shingle whose bits are set one by one, bytes of the masks
#: kept for the others, rows between two looks at what can still be reached.
_FEW, _MASK_BYTES, _LOOK = 16, 32_000_000, 512

_rng = np.random.default_rng(20240229)
_SALT = _rng.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 2**63, WORDS + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIGN = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64)
_SIGN_ODD = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MAX = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class WordHashes(dict):
    """Word to 64-bit hash, kept while it stays small."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Hashes of the shingles in text order."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(w))
    n = len(w) - k + 1
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s += w[j:j + n] * _PLACE[j]
    return _mixed(s)


def labelled_shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles in text order, all distinct."""
    s = shingles(text, hashes)
    n = len(s)
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if new.all():
        return s
    at = np.arange(n)
    label = np.empty(n, np.uint64)
    label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return np.where(label > 0, _mixed(s + label * _PLACE[WORDS]), s)


def bands(labelled: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, from the least labels in text order."""
    rows = np.arange(len(_SALT))
    value = np.full((len(_SALT), LEAST), _MAX)
    pos = np.full((len(_SALT), LEAST), -1, np.int64)
    for b in range(0, len(labelled), _BLOCK):
        h = (labelled[None, b:b + _BLOCK] ^ _SALT[:, None]) * _ODD[:, None]
        for _ in range(min(LEAST, h.shape[1])):
            i = h.argmin(axis=1)
            v = h[rows, i]
            h[rows, i] = _MAX
            worst = value.argmax(axis=1)
            better = v < value[rows, worst]
            value[rows[better], worst[better]] = v[better]
            pos[rows[better], worst[better]] = i[better] + b
    by_place = np.take_along_axis(pos, pos.argsort(axis=1), axis=1)
    label = np.where(by_place >= 0, labelled[np.maximum(by_place, 0)], np.uint64(0))
    sketch = _mixed((label * _PLACE[:LEAST]).sum(axis=1, dtype=np.uint64))
    parts = sketch.reshape(BANDS, ROWS) * _PLACE[:ROWS]
    return _mixed(parts.sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACE[-1])


def signature(labelled: np.ndarray) -> np.ndarray:
    """Four planes of MINIMA bits, as 64-bit words: the low bits of the least
    labels under MINIMA hash functions."""
    least = np.full(MINIMA, _MAX)
    for b in range(0, len(labelled), 1024):
        least = np.minimum(least, ((labelled[None, b:b + 1024] ^ _SIGN[:, None]) * _SIGN_ODD[:, None]).min(axis=1))
    bits = (_mixed(least)[None, :] >> np.arange(4, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64).ravel()


def agreeing(a: Column, b: Column) -> Column:
    """How many minima of two signatures agree."""
    words = MINIMA // 64

    def differ(w: int) -> Column:
        planes = [a[p * words + w].bitwiseXOR(b[p * words + w]) for p in range(4)]
        return F.bit_count(planes[0].bitwiseOR(planes[1]).bitwiseOR(planes[2]).bitwiseOR(planes[3]))

    return F.lit(MINIMA) - sum((differ(w) for w in range(1, words)), differ(0))


def _risen(ia: np.ndarray, ib: np.ndarray) -> int:
    """Length of the longest chain that rises in both, for distinct positions."""
    path = ib[np.argsort(ia)]
    if np.all(path[1:] > path[:-1]):
        return len(path)
    tails: list[int] = []
    for x in path.tolist():
        k = bisect_left(tails, x)
        if k == len(tails):
            tails.append(x)
        else:
            tails[k] = x
    return len(tails)


def _common(a: np.ndarray, b: np.ndarray, band: int, least: float) -> int:
    """Length of the longest common subsequence of two sequences of small
    numbers with no match further than ``band`` off the diagonal; 0 as soon as
    it must stay below ``least``. Bit ``j`` of ``free`` is 0 where column
    ``lo + j`` holds one aligned shingle more than the column before."""
    order = np.argsort(b, kind="stable")
    first = np.searchsorted(b[order], np.arange(int(max(a.max(), b.max())) + 2)).tolist()
    at = order.tolist()
    masks: dict[int, int] = {}
    lo, hi, done, free = 0, 0, 0, 0
    for i, x in enumerate(a.tolist()):
        if i % _LOOK == 0 and done + (hi - lo - free.bit_count()) + len(a) - i < least:
            return 0
        start, end = first[x], first[x + 1]
        if start == end:
            continue
        now = max(i - band, 0)
        if now > lo:
            # columns that no later row may match: what they hold stays
            out = min(now, hi) - lo
            done += out - (free & ((1 << out) - 1)).bit_count()
            free >>= out
            lo, hi = now, max(hi, now)
        reach = min(i + band + 1, len(b))
        if reach > hi:
            free |= ((1 << (reach - hi)) - 1) << (hi - lo)
            hi = reach
        if end - start <= _FEW:
            match = 0
            for j in at[start:end]:
                if lo <= j < hi:
                    match |= 1 << (j - lo)
        else:
            if x not in masks:
                if len(masks) * len(b) > 8 * _MASK_BYTES:
                    masks.clear()
                bits = np.zeros(len(b), np.uint8)
                bits[order[start:end]] = 1
                masks[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            match = (masks[x] >> lo) & ((1 << (hi - lo)) - 1)
        if match:
            both = free & match
            free = ((free + both) | (free ^ both)) & ((1 << (hi - lo)) - 1)
    return done + hi - lo - free.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two shingle sequences by banded alignment; 0.0 as soon as
    it must stay below ``least``."""
    total = len(a) + len(b)
    need = least / (1 + least) * total
    if not len(a) or not len(b) or min(len(a), len(b)) < need - 1e-9:
        return 0.0
    # an alignment of m leaves total - 2 m unmatched, and no match lies further off the diagonal
    band = total - 2 * need + 1e-9
    known, na = np.unique(a, return_counts=True)
    other, nb = np.unique(b, return_counts=True)
    shared, ka, kb = np.intersect1d(known, other, assume_unique=True, return_indices=True)
    if np.minimum(na[ka], nb[kb]).sum() < need - 1e-9:
        return 0.0
    if (na[ka] == 1).all() and (nb[kb] == 1).all():
        _, ia, ib = np.intersect1d(a, b, return_indices=True)
        near = np.abs(ia - ib) <= band
        if near.sum() < need - 1e-9:
            return 0.0
        m = _risen(ia[near], ib[near])
    else:
        # equal ends belong to a best alignment
        short = min(len(a), len(b))
        differ = np.flatnonzero(a[:short] != b[:short])
        head = int(differ[0]) if len(differ) else short
        differ = np.flatnonzero(a[::-1][:short - head] != b[::-1][:short - head])
        tail = int(differ[0]) if len(differ) else short - head
        m, a, b = head + tail, a[head:len(a) - tail], b[head:len(b) - tail]
        if len(a) and len(b):
            names = np.unique(np.concatenate([a, b]), return_inverse=True)[1].ravel()
            m += _common(names[:len(a)], names[len(a):], int(band), need - m - 1e-9)
    return m / (total - m)


def _sketches(batches):
    hashes = WordHashes()
    for batch in slices(batches):
        ids, texts = batch.column(0), batch.column(1)
        digests, found = [], []
        for text in texts.to_pylist():
            digests.append(None if text is None else hashlib.md5(text.encode(), usedforsecurity=False).digest())
            s = labelled_shingles(text, hashes) if text else ()
            found.append(bands(s).view(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays([ids, pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "digest", "bands"])


def _verify(batches):
    hashes = WordHashes()
    last: tuple = (None, None)
    for batch in slices(batches):
        a, b, ta, tb = (c.to_pylist() for c in batch.columns)
        yes = []
        for x, tx, ty in zip(a, ta, tb):
            if last[0] != x:
                last = (x, shingles(tx, hashes))
            yes.append(aligned(last[1], shingles(ty, hashes)) >= SIMILARITY - 1e-9)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(yes)), batch.column(1).filter(pa.array(yes))], ["a", "b"])


def _signed(batches):
    hashes = WordHashes()
    for batch in slices(batches):
        signs = [signature(labelled_shingles(t, hashes)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signs, pa.list_(pa.int64()))], ["rep", "text", "sign"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a b`` whose texts are similar."""
    ta = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    # merge joins at every size, so that the work follows the input
    joined = pairs.hint("merge").join(ta, "a").hint("merge").join(tb, "b").select("a", "b", "ta", "tb")
    kinds = dict(pairs.dtypes)
    return joined.mapInArrow(_verify, f"a {kinds['a']}, b {kinds['b']}")


def _digest(text: Column) -> Column:
    """As ``_sketches`` computes it."""
    return F.unhex(F.md5(text.cast("binary")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id class_id kept`` per row: the least id of the group of linked
    documents, and whether the row is it."""
    return _grouped(docs, id_col, text_col).drop("digest")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same with the text's ``digest``."""
    kind = dict(docs.dtypes)[id_col]
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                 .mapInArrow(_sketches, f"doc_id {kind}, digest binary, bands array<bigint>"), "omh-rows")
    # one class for each text, known by a number that is written down; its least
    # id names it, and another text of that id is another class
    classes = stage(rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "bands")).alias("r"))
                    .select("digest", F.col("r.doc_id").alias("least"), "r.bands", F.monotonically_increasing_id().alias("rep")), "omh-classes")
    exploded = classes.where("bands is not null").select("rep", F.explode("bands").alias("band"))
    crowded = stage(exploded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "omh-bands")
    members = stage(exploded.join(crowded.select("band"), "band"), "omh-members")

    # by a sort-merge join at every size: the documents are shuffled once
    wanted = members.select("rep").distinct().join(classes.select("rep", "least", "digest"), "rep").hint("merge")
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("least"), F.col(text_col).alias("text"))
    texts = texts.withColumn("digest", _digest(F.col("text")))
    texts = texts.join(wanted, ["least", "digest"]).select("rep", "text").dropDuplicates(["rep"])
    texts = stage(texts.mapInArrow(_signed, "rep long, text string, sign array<bigint>"), "omh-texts")
    signed = stage(members.join(texts.select("rep", "sign"), "rep"), "omh-signed")
    unstage(members)

    comp, tested = None, None
    for k in range(LEADER_ROUNDS + 1):
        now = signed.withColumn("c", F.col("rep"))
        if comp is not None:
            now = signed.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
        # only bands with members of different components stay, each with a leader
        lead = F.min(F.struct(F.xxhash64("rep", F.lit(k)).alias("h"), F.col("rep").alias("lead"), F.col("c").alias("lead_c"), F.col("sign").alias("lead_sign"))).alias("l")
        led = now.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), lead).where("lo < hi").select("band", "l.lead", "l.lead_c", "l.lead_sign")
        led = stage(led, "omh-leaders")
        still = stage(now.join(led, "band"), "omh-open")
        unstage(signed)
        unstage(led)
        if k < LEADER_ROUNDS:
            met = still.where((F.col("c") != F.col("lead_c")) & (agreeing(F.col("sign"), F.col("lead_sign")) >= LEAST_AGREEING))
            met = met.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b"))
        else:
            # a pair is met in the least of the bands it shares, all of which are open
            full = stage(still.join(classes.select("rep", "bands"), "rep"), "omh-full")
            left = full.select(F.col("band").alias("band_a"), F.col("rep").alias("a"), F.col("c").alias("ca"), F.col("sign").alias("sa"), F.col("bands").alias("ba"))
            right = full.select("band", F.col("rep").alias("b"), F.col("c").alias("cb"), F.col("sign").alias("sb"), F.col("bands").alias("bb"))
            near = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (agreeing(F.col("sa"), F.col("sb")) >= LEAST_AGREEING)
            near = near & (F.array_min(F.array_intersect("ba", "bb")) == F.col("band"))
            met = left.join(right, (F.col("band_a") == F.col("band")) & near).select("a", "b")
        signed = still.select("band", "rep", "sign")
        signed._staged_path = still._staged_path
        met = met.distinct()
        met = stage(met if tested is None else met.join(tested, ["a", "b"], "left_anti"), "omh-pairs")
        tested = met if tested is None else tested.union(met)
        links = stage(_links(met, texts), "omh-links")
        edges = links if comp is None else links.union(comp.select(F.col("component").alias("a"), F.col("node").alias("b")))
        comp = stage(connected_components(edges, "a", "b"), "omh-components")

    parts = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "least", F.coalesce("component", "rep").alias("part"))
    parts = stage(parts, "omh-parts")
    # a group's rows are added up before they are shuffled
    named = parts.select("digest", "part").join(parts.groupBy("part").agg(F.min("least").alias("class")), "part").select("digest", "class")
    out = rows.select("doc_id", "digest").join(stage(named, "omh-named"), "digest", "left")
    cls = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("class", "doc_id"))
    return out.select("doc_id", "digest", cls.alias("class_id"), F.coalesce(cls == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those that another document of their class
    stands for; rows with a null id or text stay."""
    gone = stage(_grouped(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct(), "omh-gone")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    rows = rows.join(gone, (F.col("row")[id_col] == F.col("gone_id")) & (_digest(F.col("row")[text_col]) == F.col("gone_digest")), "left_anti")
    return rows.select("row.*")
