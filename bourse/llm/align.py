"""Alignment of the tokens that two tokenizers make of the same texts.

A is a byte-level BPE (a tokenizers file) that encodes a space and the text, B
a sentencepiece model, which adds the space itself. Both tokenizations cut the
same bytes, so they are compared by the byte offsets at which tokens end:
offsets where both end cut the tokens into groups, and an A and a B token are
linked where their bytes overlap. The count of a pair of ids is the number of
documents in which it is linked.

A chunk is a run of documents that one task reads, up to CHUNK_BYTES of text or
one document. The whole of a chunk goes through Arrow: token lists are
flattened, their parent indices name the document of every token, a cumulative
sum of piece lengths, less what came before the document, gives its end, and an
Acero full outer hash join of the two tables of ends on document and end gives
one row for each stretch of bytes between ends, which is one link. Group-bys
leave each document's distinct pairs, then the number of documents of the chunk
that hold a pair.

A chunk's documents are written down with their groups and with their distinct
pairs as numbers among the chunk's pairs, and the chunk's pairs with these
partial counts. Spark adds the counts up over the corpus, finds the highest of
every A id, and joins them back to the chunks' pairs; a cogroup brings each
chunk's documents the corpus-wide counts of its pairs, which they add up over
their links. What is shuffled is a chunk's distinct pairs, not its links, and a
task holds one chunk. No pair table is broadcast or collected: it grows with the
corpus.

Results for odd rows: a null or empty text has no tokens, nor has one whose
joined pieces differ from its bytes (a piece's mark for a space inside the text,
a normalization): all numbers are 0 and the digest ''; a null id stays; rows
that repeat an id are documents each; strings of special tokens inside a text
are plain text; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _byte_of, pieces, split_words
from .common import release_memory, slices, stage

#: Bytes of text that a task aligns at a time.
CHUNK_BYTES = 2_000_000
#: Pairs in a row of the written table; bits of a byte offset in a key.
PAIRS, END_BITS = 256, 40
#: Words that are encoded at a time; bytes that are remembered of either
#: tokenizer's words, and the longest word that is.
ENCODED, KNOWN_BYTES, KNOWN_LENGTH = 1024, 40_000_000, 100


def byte_pieces(path: str) -> pa.Array:
    """The bytes of every id of the byte-level tokenizer file."""
    return pa.array(pieces(path), pa.binary())


def piece_bytes(path: str) -> pa.Array:
    """The bytes of every id of the sentencepiece model: a byte piece its byte,
    any other its characters, the mark of a space as a space."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [(model.id_to_piece(i), model.is_byte(i)) for i in range(model.get_piece_size())]
    return pa.array([bytes([int(name[3:5], 16)]) if byte else name.replace("▁", " ").encode() for name, byte in names], pa.binary())


def _data(a: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Offsets and bytes of a string or binary array without nulls."""
    if not len(a):
        return np.zeros(1, np.int64), memoryview(b"")
    offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    return offsets - offsets[0], memoryview(a.buffers()[2] or b"")[offsets[0]:offsets[-1]]


def _offsets(lists: pa.ListArray) -> np.ndarray:
    """Where each list starts among the flattened values, and the last ends."""
    return np.concatenate(([0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy()))).astype(np.int64)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


class Known:
    """Token lists of words, each encoded once while it is remembered."""

    def __init__(self, encode):
        self.encode, self.ids, self.held = encode, {}, 0

    def __call__(self, words: list[str]) -> pa.ListArray:
        if self.held > KNOWN_BYTES:
            self.ids, self.held = {}, 0
        ids, rare = self.ids, {}
        new = [w for w in words if w not in ids]
        for k in range(0, len(new), ENCODED):
            some = new[k:k + ENCODED]
            found = self.encode(some)
            ends = list(accumulate(map(len, found), initial=0))
            flat = np.fromiter(chain.from_iterable(found), np.int32, ends[-1]).tobytes()
            # two strings and their entry take about 200 bytes besides the characters
            self.held += sum(map(len, some)) + len(flat) + 200 * len(some)
            (ids if max(map(len, some)) <= KNOWN_LENGTH else rare).update(zip(some, [flat[4 * x:4 * y] for x, y in pairwise(ends)]))
        lists = [ids[w] if w in ids else rare[w] for w in words] if rare else list(map(ids.__getitem__, words))
        at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)) // 4)))
        return _lists(at, pa.array(np.frombuffer(b"".join(lists), np.int32)))


class Encoder:
    """Token lists of texts that come as lists of their pre-tokens, the space
    in front included.

    B's texts are encoded word by word where they have single spaces only, a
    word being what stands between two: no piece of the model may hold a space
    after another character, so no merge crosses the end of a word. Other texts
    are encoded whole, and all texts where the model has such pieces."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        model, other = Tokenizer.from_file(path_a).model, SentencePieceProcessor(model_file=path_b)
        # the characters that stand for bytes; byte 255, which no text has, parts the words
        alphabet = {b: c for c, b in _byte_of().items()} | {255: "\n"}

        def encode(words: list[str]):
            mapped = "\xff".join(w.encode().decode("latin1") for w in words).translate(alphabet)
            return [[t.id for t in tokens] for tokens in map(model.tokenize, mapped.split("\n"))]

        self.a = Known(encode)
        self.b = Known(lambda words: other.encode(words, num_threads=1))
        self.words_apart = not any("▁" in other.id_to_piece(i).lstrip("▁") for i in range(other.get_piece_size()))
        self.bytes_a, self.bytes_b = byte_pieces(path_a), piece_bytes(path_b)

    def _words(self, text: str) -> list[str]:
        words = text.split(" ")
        return words if self.words_apart and "" not in words else [text]

    def __call__(self, words: pa.ListArray) -> tuple[pa.ListArray, pa.ListArray]:
        """The tokens of both sides; of neither where the pieces do not join to
        the text."""
        flat, at = words.flatten(), _offsets(words)
        a = self._tokens(self.a, flat, at)
        where, data = _data(flat)
        texts = [bytes(data[x:y]) for x, y in zip(where[at[:-1]], where[at[1:]])]
        split = [self._words(t[1:].decode()) for t in texts]
        b = self._tokens(self.b, pa.array([w for ws in split for w in ws], pa.string()), np.concatenate(([0], np.cumsum([len(ws) for ws in split]))).astype(np.int64))
        same = pa.array([len(t) > 1 and t == x == y for t, x, y in zip(texts, self._joined(a, self.bytes_a), self._joined(b, self.bytes_b))], pa.bool_())
        none = pa.scalar([], pa.list_(pa.int32()))
        return pc.if_else(same, a, none), pc.if_else(same, b, none)

    @staticmethod
    def _tokens(known: Known, words: pa.Array, at: np.ndarray) -> pa.ListArray:
        """Each distinct word's tokens, joined back to the words by position."""
        distinct = words.dictionary_encode()
        lists = known(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()).take(distinct.indices)
        return _lists(_offsets(lists)[at], lists.flatten())

    @staticmethod
    def _joined(tokens: pa.ListArray, table: pa.Array):
        at = _offsets(tokens)
        where, data = _data(table.take(tokens.flatten()))
        return (bytes(data[x:y]) for x, y in zip(where[at[:-1]], where[at[1:]]))


def ends(tokens: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """For every token its document-end key: the document's place and the byte
    offset of the token's end in it, a running sum of lengths less what was
    there before the document."""
    ids, doc = tokens.flatten(), pc.list_parent_indices(tokens).cast(pa.int64())
    total = pc.cumulative_sum(lengths.take(ids))
    before = pa.array(np.concatenate(([0], total.to_numpy()))[_offsets(tokens)[:-1]])
    end = pc.subtract(total, before.take(doc))
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(doc, pa.scalar(END_BITS, pa.int64())), end), "id": ids})


class Links:
    """The links of a chunk's documents in order: the document's place ``doc``,
    the tokens' places ``at_a`` and ``at_b`` among all of the chunk, their ids,
    and ``cut`` where both tokens end."""

    def __init__(self, a: pa.ListArray, b: pa.ListArray, lengths_a: pa.Array, lengths_b: pa.Array):
        left, right = ends(a, lengths_a), ends(b, lengths_b)
        self.starts, self.docs = _offsets(a) + _offsets(b), len(a)
        self.ids_a, self.ids_b = left.column("id").combine_chunks(), right.column("id").combine_chunks()
        left = pa.table({"key": left.column("key"), "a": pa.repeat(True, len(left))})
        right = pa.table({"key": right.column("key"), "b": pa.repeat(True, len(right))})
        both = left.join(right, "key", join_type="full outer", use_threads=False)
        key = both.column("key").to_numpy()
        order = np.argsort(key)
        self.ends_a, self.ends_b = (both.column(c).is_valid().to_numpy()[order] for c in ("a", "b"))
        self.doc, self.cut = key[order] >> END_BITS, self.ends_a & self.ends_b
        # a token covers every stretch after the end before it, up to its own
        self.at_a, self.at_b = np.cumsum(self.ends_a) - self.ends_a, np.cumsum(self.ends_b) - self.ends_b

    def pairs(self) -> pa.Table:
        """``doc a b links``: each document's distinct pairs."""
        pairs = pa.table({"doc": self.doc, "a": self.ids_a.take(pa.array(self.at_a)), "b": self.ids_b.take(pa.array(self.at_b))})
        return pairs.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "a", "b", "links"])

    def per_doc(self, weight=None) -> pa.Array:
        return pa.array(np.bincount(self.doc, weight, minlength=self.docs).astype(np.int64))

    def written(self, words: pa.Array) -> list[str]:
        """Each document's groups ``a1,a2|b1;a3|b2``; ``words`` has every id
        three times, followed by a comma, a bar and a semicolon."""
        group = np.cumsum(self.cut) - self.cut
        n = int(self.cut.sum())
        group_a, group_b = group[self.ends_a], group[self.ends_b]
        before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=n))))
        upto_a = np.cumsum(np.bincount(group_a, minlength=n))
        place_a, place_b = np.arange(len(group_a)) + before_b[group_a], np.arange(len(group_b)) + upto_a[group_b]
        code = np.empty(len(group_a) + len(group_b), np.int64)
        code[place_a] = 3 * self.ids_a.to_numpy().astype(np.int64) + self.cut[self.ends_a]
        code[place_b] = 3 * self.ids_b.to_numpy().astype(np.int64) + 2 * self.cut[self.ends_b]
        where, data = _data(words.take(pa.array(code)))
        first = where[self.starts]
        return [bytes(data[x:max(x, y - 1)]).decode() for x, y in zip(first[:-1], first[1:])]


def id_words(size: int) -> pa.Array:
    return pa.array([f"{i}{c}".encode() for i in range(size) for c in ",|;"], pa.binary())


def _packed(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint32)


_DOC = "n_a long, n_b long, n_groups long, n_links long, groups string"


def _chunks(path_a: str, path_b: str, digest: bool):
    """For each chunk a row for each document, with its groups and its distinct
    pairs as numbers among the chunk's, and rows of up to PAIRS of the chunk's
    pairs with the number of documents that hold them."""
    def encode(batches):
        encoder = Encoder(path_a, path_b)
        lengths = [pc.binary_length(x).cast(pa.int64()) for x in (encoder.bytes_a, encoder.bytes_b)]
        words = id_words(max(len(x) for x in lengths))
        part, n = TaskContext.get().partitionId(), 0
        for some in slices(batches, CHUNK_BYTES):
            a, b = encoder(some.column(1))
            links = Links(a, b, *lengths)
            groups = links.written(words)
            if digest:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            pairs = links.pairs()
            counts = pairs.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
            numbered = pa.table({"a": counts.column("a"), "b": counts.column("b"), "number": pa.array(np.arange(len(counts), dtype=np.uint32))})
            pairs = pairs.join(numbered, ["a", "b"], use_threads=False)
            of = pairs.column("doc").to_numpy()
            order = np.argsort(of, kind="stable")
            number, times = pairs.column("number").to_numpy()[order], pairs.column("links").to_numpy()[order].astype(np.uint32)
            at = np.searchsorted(of[order], np.arange(links.docs + 1))
            held = [_packed(np.concatenate((number[x:y], times[x:y]))) for x, y in zip(at[:-1], at[1:])]
            chunk = part << 32 | n
            docs = {"doc_id": some.column(0), "n_a": pc.list_value_length(a).cast(pa.int64()), "n_b": pc.list_value_length(b).cast(pa.int64()), "n_groups": links.per_doc(links.cut),
                    "n_links": links.per_doc(), "groups": pa.array(groups, pa.string()), "held": pa.array(held, pa.binary())}
            lists = {"a": pa.list_(pa.int32()), "b": pa.list_(pa.int32()), "n": pa.list_(pa.int64())}
            yield _rows(chunk, docs, {c: pa.nulls(links.docs, t) for c, t in lists.items()}, pa.nulls(links.docs, pa.int32()))
            if len(counts):
                first = np.arange(0, len(counts), PAIRS)
                cut = np.append(first, len(counts))
                found = {"a": counts.column("a"), "b": counts.column("b"), "n": counts.column("count_all")}
                yield _rows(chunk, {c: pa.nulls(len(first), x.type) for c, x in docs.items()}, {c: _lists(cut, x.combine_chunks().cast(lists[c].value_type)) for c, x in found.items()}, pa.array(first.astype(np.int32)))
            n += 1
            links = pairs = numbered = docs = groups = held = None
        release_memory()
    return encode


def _rows(chunk: int, docs: dict, pairs: dict, first: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk] * len(first), pa.int64()), *docs.values(), *pairs.values(), first],
                                      ["chunk", *docs, *(f"pair_{c}" for c in pairs), "pair_first"])


def _sums(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the sums over their links."""
    number = counts.column("number").to_numpy()
    total, best = np.zeros((2, len(number)), np.int64)
    if not np.array_equal(np.sort(number), np.arange(len(number))):
        raise RuntimeError("a chunk's pairs came back incomplete")
    total[number], best[number] = counts.column("total").to_numpy(), counts.column("best").to_numpy()
    sums = []
    for held in docs.column("held").to_pylist():
        which, times = _unpacked(held).reshape(2, -1).astype(np.int64)
        sums.append((int(best[which] @ times), int(total[which] @ times)))
    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    out |= {"n_best": pa.array([x for x, _ in sums], pa.int64()), "count_sum": pa.array([x for _, x in sums], pa.int64()), "groups": docs.column("groups")}
    release_memory()
    return pa.table(out)


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id n_a n_b n_groups n_links n_best count_sum`` and ``groups`` per
    row, or the groups' digest ``groups_sha256``. The tokenizer files lie at
    places that every executor has."""
    kind = dict(df.dtypes)[id_col]
    text = F.col(text_col)
    words = F.when(F.length(text) > 0, split_words(F.concat(F.lit(" "), text), [])).otherwise(F.array().cast("array<string>"))
    found = df.select(F.col(id_col).alias("doc_id"), words.alias("words")).mapInArrow(
        _chunks(path_a, path_b, digest), f"chunk long, doc_id {kind}, {_DOC}, held binary, pair_a array<int>, pair_b array<int>, pair_n array<long>, pair_first int")
    found = stage(found, "align-chunks")
    pairs = found.where("pair_first is not null").select(F.col("chunk").alias("of"), "pair_first", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("place", "pair"))
    pairs = pairs.select("of", (F.col("pair_first") + F.col("place")).alias("number"), "pair.*")
    counts = stage(pairs.groupBy("pair_a", "pair_b").agg(F.sum("pair_n").alias("total")), "align-counts")
    highest = counts.groupBy("pair_a").agg(F.max("total").alias("highest"))
    counts = counts.join(highest, "pair_a").select("pair_a", "pair_b", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))
    counts = pairs.join(counts, ["pair_a", "pair_b"]).select("of", "number", "total", "best")
    docs = found.where("held is not null").select("chunk", "doc_id", *(c.split()[0] for c in _DOC.split(", ")), "held")
    out = docs.groupBy("chunk").cogroup(counts.groupBy("of")).applyInArrow(
        _sums, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return out.withColumnRenamed("groups", "groups_sha256") if digest else out
