"""BPE encoding and decoding through a table of distinct words.

Encoding. Texts are split into pre-tokens by a Spark expression. A run of
documents that one task reads is a chunk; its distinct words are sorted and
each document becomes the positions of its words in that list. The distinct
words of all chunks are dealt into buckets by their hash, so that every word
belongs to one bucket, where it is encoded by the tokenizer once however many
chunks hold it. The ids go back to the chunks, which join them to the documents
by position. Only a chunk's distinct words, packed by bucket, and the positions
are shuffled, never the texts or one row per word of a document.

The chunks are read twice, for their words and for their positions, so the
input must give the same rows in the same tasks each time, as files do;
``encode`` writes an input that is anything else to a staged table first, and
a chunk is known by a digest of its words, so that a difference fails the join.

Decoding joins every id with the table of pieces, whose size is that of the
vocabulary, in Arrow batches, and reads the joined bytes as UTF-8.

Results for odd rows: a null or empty text has no ids and decodes to ''; null
ids stay; rows that repeat an id are encoded each; an empty table gives an
empty table; only the id and text columns are read. Strings of special tokens
in a text become their ids, as the tokenizers library does by default.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, stage

_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The byte-level pre-tokenizer's pattern, a fixed value.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}++| ?\p{{N}}++| ?[^{_SPACE}\p{{L}}\p{{N}}]++|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
#: Bytes of split words in a chunk: what one task holds at a time.
CHUNK_BYTES = 12_000_000
#: Bytes of input for each bucket, at most; one is encoded by a worker at a time.
BUCKET_BYTES = 64_000_000
#: Rows decoded, and words encoded, at a time.
DECODED_ROWS, ENCODED_WORDS = 256, 4096


def tokenizer_json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def split_words(text: Column, special: list[str]) -> Column:
    """The pre-tokens of a text; strings of special tokens stand alone."""
    words = lambda t: F.regexp_extract_all(t, F.lit(SPLIT), F.lit(0))
    text = F.coalesce(text, F.lit(""))
    if not special:
        return words(text)
    if len(special) == 1:
        there, pattern = F.instr(text, special[0]) > 0, F.lit(r"\Q" + special[0] + r"\E")
    else:
        regex = "|".join(r"\Q" + s + r"\E" for s in sorted(special, key=lambda s: -len(s)))
        there, pattern = text.rlike(regex), F.lit(regex)
    marks = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.zip_with(F.split(text, pattern, -1), marks, lambda t, m: F.concat(words(t), F.when(m.isNull(), F.array().cast("array<string>")).otherwise(F.array(m))))
    return F.when(there, F.flatten(pieces)).otherwise(words(text))


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def _strings(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary array without nulls."""
    if not len(a):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], data


def _dictionary(words: pa.ListArray, buckets: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words in the order of their bucket, then their bytes; the
    bucket of each; and the position of every word of the texts among them."""
    d = words.flatten().dictionary_encode()
    of = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in d.dictionary.to_pylist()), np.int64, len(d.dictionary))
    by_word = pc.sort_indices(d.dictionary).to_numpy().astype(np.int64)
    order = by_word[np.argsort(of[by_word], kind="stable")]
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return d.dictionary.take(pa.array(order)), of[order], rank[d.indices.to_numpy()]


def _slices(batches, rows):
    """Slices of ``rows(batch)`` rows. A batch is let go before the next one is
    read, and at the end the pool's memory goes back, so that a task holds one
    batch and an idle worker none."""
    batches = iter(batches)
    while (batch := next(batches, None)) is not None:
        step = max(1, rows(batch))
        for start in range(0, len(batch), step):
            yield batch.slice(start, step)
        batch = None
    release_memory()


def _chunks(batches, buckets: int):
    """Runs of a task's rows: chunk id, doc ids, their words' numbers, and what
    ``_dictionary`` says of them. The id is a digest of the words and the place
    of the run, so that a run that is read with other words has another id."""
    part, n = TaskContext.get().partitionId(), 0
    for some in _slices(batches, lambda b: int(len(b) * CHUNK_BYTES / max(b.column(1).nbytes, 1))):
        lengths = pc.list_value_length(some.column(1)).to_numpy()
        found, of, at = _dictionary(some.column(1), buckets)
        ids = pa.concat_arrays([some.column(0)])
        some = None
        h = xxhash.xxh64(f"{part}:{n}")
        for x in _strings(found):
            h.update(x.tobytes())
        yield h.intdigest() >> 1, ids, lengths, found, of, at
        n += 1


def _distinct(buckets: int):
    """One row for each bucket of a chunk: its words, packed."""
    def distinct(batches):
        for chunk, _, _, found, of, _ in _chunks(batches, buckets):
            offsets, data = _strings(found)
            edges = np.flatnonzero(np.diff(of, prepend=-1, append=buckets))
            rows = []
            for a, b in zip(edges[:-1], edges[1:]):
                lengths = np.diff(offsets[a:b + 1]).astype(np.uint32)
                rows.append((int(of[a]), b - a, _pack(np.concatenate((lengths.view(np.uint8), data[offsets[a]:offsets[b]])))))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
                                             ["bucket", "chunk", "n", "words"])
    return distinct


def _positions(buckets: int):
    """One row for each document: its chunk and its words' positions, packed."""
    def positions(batches):
        for chunk, ids, lengths, found, _, at in _chunks(batches, buckets):
            packed = [_pack(at[e - k:e].view(np.uint8).reshape(-1, 4).T) for e, k in zip(np.cumsum(lengths), lengths)]
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(ids), pa.int64()), pa.array(np.full(len(ids), len(found), np.int32)), ids, pa.array(packed, pa.binary())],
                                             ["chunk", "size", "doc_id", "at"])
    return positions


def _encoder(path: str):
    """Encodes a bucket's distinct words once and gives every chunk its ids."""
    def encode(batches):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()

        def done(bucket, held):
            lists = []
            for _, n, blob in held:
                raw = _unpack(blob, np.uint8)
                ends = np.concatenate(([0], np.cumsum(raw[:4 * n].view(np.uint32)))).astype(np.int32)
                lists.append(pa.StringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[4 * n:].tobytes())))
            d = pa.concat_arrays(lists).dictionary_encode()
            known = d.dictionary.to_pylist()
            coded = [np.asarray(e.ids, np.uint32) for b in range(0, len(known), ENCODED_WORDS) for e in tok.encode_batch(known[b:b + ENCODED_WORDS], add_special_tokens=False)]
            place, out = 0, []
            for chunk, n, _ in held:
                ids = [coded[i] for i in d.indices.slice(place, n).to_pylist()]
                place += n
                out.append(_pack(np.concatenate((np.fromiter(map(len, ids), np.uint32, n), *ids))))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array([bucket] * len(held), pa.int32()), pa.array([x[1] for x in held], pa.int32()), pa.array(out, pa.binary())],
                                              ["chunk", "bucket", "n", "ids"])

        now, held = None, []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and bucket != now:
                    yield done(now, held)
                    held = []
                now = bucket
                held.append(row)
        if held:
            yield done(now, held)
        held = tok = None
        release_memory()
    return encode


def _joiner(path: str | None):
    """Joins one chunk: the documents' positions with the ids of the chunk's
    words; with a tokenizer's path the ids are decoded in the same pass."""
    table: list[pa.Array] = []

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        counts, flat = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
        for _, n, blob in sorted(zip(*(right.column(c).to_pylist() for c in ("bucket", "n", "ids")))):
            raw = _unpack(blob, np.uint32)
            counts.append(raw[:n])
            flat.append(raw[n:])
        counts, flat = np.concatenate(counts).astype(np.int64), np.concatenate(flat).astype(np.int32)
        if set(left.column("size").to_pylist()) - {len(counts)}:
            raise RuntimeError("a chunk was read twice with different words; stage the input")
        offsets = np.cumsum(counts) - counts
        out = []
        for packed in left.column("at").to_pylist():
            at = np.ascontiguousarray(_unpack(packed, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
            k = counts[at]
            ends = np.cumsum(k)
            out.append(flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[at] - ends + k, k)])
        cols = {"doc_id": left.column("doc_id"), "ids": pa.array(out, pa.list_(pa.int32()))}
        if path:
            if not table:
                table.append(pa.array(pieces(path), pa.binary()))
            cols["text"] = pa.chunked_array([_text(cols["ids"].slice(b, DECODED_ROWS), table[0]) for b in range(0, len(out), DECODED_ROWS)], pa.string())
        release_memory()
        return pa.table(cols)
    return join


def _buckets(rows: DataFrame) -> int:
    """As many as the session's shuffles have, more where the input is larger:
    a bucket's share of all chunks' words stays the same however many there are."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def _plain_files(df: DataFrame) -> bool:
    return bool(df.inputFiles()) and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id ids`` per row, as the tokenizer file at ``path`` (a place that
    every executor has) encodes the text without adding special tokens. With
    ``decoded`` also ``text``: what ``decode`` makes of the ids."""
    special = [t["content"] for t in tokenizer_json(path).get("added_tokens", [])]
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if not _plain_files(rows):
        rows = stage(rows, "bpe-input")
    kind = dict(rows.dtypes)["doc_id"]
    words = rows.select("doc_id", split_words(F.col("text"), special).alias("words"))
    buckets = _buckets(rows)
    distinct = words.mapInArrow(_distinct(buckets), "bucket int, chunk bigint, n int, words binary")
    ids = distinct.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encoder(path), "chunk bigint, bucket int, n int, ids binary")
    docs = words.mapInArrow(_positions(buckets), f"chunk bigint, size int, doc_id {kind}, at binary")
    return docs.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(
        _joiner(path if decoded else None), f"doc_id {kind}, ids array<int>" + ", text string" * decoded)


def _byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(path: str) -> list[bytes]:
    """The bytes of every id."""
    data, byte = tokenizer_json(path), _byte_of()
    vocab = {i: bytes(byte[c] for c in piece) for piece, i in data["model"]["vocab"].items()}
    vocab |= {t["id"]: t["content"].encode() for t in data.get("added_tokens", [])}
    return [vocab.get(i, b"") for i in range(max(vocab) + 1)]


def _text(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    """The join of ids with their pieces, each row's bytes read as UTF-8."""
    joined = pc.binary_join(pa.ListArray.from_arrays(_offsets(ids), table.take(ids.flatten())), b"")
    return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.string())


def _decoder(path: str):
    def decode(batches):
        table = pa.array(pieces(path), pa.binary())
        for part in _slices(batches, lambda _: DECODED_ROWS):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _text(part.column(1), table)], ["doc_id", "ids", "text"])
            part = None
    return decode


def _offsets(lists: pa.ListArray) -> pa.Array:
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy()
    return pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))


def decode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id ids text``: the text of every row's ids."""
    return df.select("doc_id", "ids").mapInArrow(_decoder(path), f"doc_id {dict(df.dtypes)['doc_id']}, ids array<int>, text string")


def bpe_digest(df: DataFrame, path: str) -> DataFrame:
    back = encode(df, path, decoded=True)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
