"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Blocks of about ``block_bytes`` of text are cut into pre-tokens. A block
   keeps its positions (the number of each pre-token's word in the block's own
   list, packed) and sends its distinct words, a packed list for each shard.
2. The lists of all blocks pass through their shards, which encode a word they
   know only once and answer each block with the ids of its words.
3. Answers and positions meet at the block, which puts the ids of each
   document together by position, and decodes them by joining the ids with
   the table of token bytes.

Distinct words travel, not occurrences: the shuffled lists grow with the
vocabulary of a block. A block's name is a hash of its texts, so a task that
runs again makes the same block; a missing answer is an error, never a gap.

Defined results: a null text is empty and has no ids; rows of equal number
and text are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import vectors as V

BLOCK_BYTES = 8 << 20
ROW_DOCS = 64
ROW_LISTS = 64
KNOWN_WORDS = 1 << 18
KNOWN_BYTES = 16 << 20
_LOADED: dict = {}


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _encoder(path: str, pattern: str):
    if path not in _LOADED:
        import tiktoken
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
    return _LOADED[path]


def _pack(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed."""
    import zstandard
    planes = np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _zip(b: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(b)


def _unzip(b: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(b)


class _Numbers(dict):
    """Numbers words in order of their first use."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class _Block:
    def __init__(self):
        self.words, self.ids, self.docs, self.size = _Numbers(), [], [], 0
        self.name = hashlib.blake2b(digest_size=8)

    def add(self, doc_id, text: str, find) -> None:
        raw = text.encode()
        self.name.update(len(raw).to_bytes(8, "little") + raw)
        found = find(text)
        self.docs.append(doc_id)
        self.ids.append(np.fromiter(map(self.words.__getitem__, found), np.uint32, len(found)))
        self.size += len(raw)

    def key(self) -> int:
        return int.from_bytes(self.name.digest(), "little", signed=True)


def _blocks(batches, pattern: str, block_bytes: int):
    import regex
    find = regex.compile(pattern).findall
    block = _Block()
    for b in batches:
        ids, texts = b.column("doc_id").to_pylist(), b.column("text")
        for i in range(0, b.num_rows, 256):
            for doc_id, text in zip(ids[i:i + 256], texts.slice(i, 256).to_pylist()):
                block.add(doc_id, text or "", find)
                if block.size >= block_bytes:
                    yield block
                    block = _Block()
    if block.docs:
        yield block


def _shards(block: _Block, shards: int):
    """Words (UTF-8) of the block and their shards, in the block's order."""
    words = [w.encode() for w in block.words]
    return words, np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))


def word_lists(docs: DataFrame, pattern: str, block_bytes: int, shards: int) -> DataFrame:
    """Each block's distinct words: block, shard, lens, words."""
    def work(batches):
        for block in _blocks(batches, pattern, block_bytes):
            words, shard = _shards(block, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = []
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                own = [words[k] for k in order[cuts[s]:cuts[s + 1]].tolist()]
                rows.append((block.key(), s, _pack(np.array([len(w) for w in own])), _zip(b"".join(own))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    ["block", "shard", "lens", "words"])
    return docs.mapInArrow(work, "block long, shard int, lens binary, words binary")


def positions(docs: DataFrame, pattern: str, block_bytes: int, shards: int) -> DataFrame:
    """Each block's documents, up to ``ROW_DOCS`` a row: for each pre-token the
    place of its word in the block's words in order of shard."""
    def work(batches):
        for block in _blocks(batches, pattern, block_bytes):
            _, shard = _shards(block, shards)
            place = np.empty(len(shard), np.uint32)
            place[np.argsort(shard, kind="stable")] = np.arange(len(shard))
            rows = []
            for i in range(0, len(block.docs), ROW_DOCS):
                part = block.ids[i:i + ROW_DOCS]
                rows.append((block.key(), len(shard), block.docs[i:i + ROW_DOCS], [len(x) for x in part],
                             _pack(np.concatenate(part))))
            # First use order keeps small numbers frequent, so it is packed
            # and the order by shard travels once.
            rows.append((block.key(), len(shard), None, None, _pack(place)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.list_(pa.int64()),
                                                             pa.list_(pa.int32()), pa.binary()))],
                ["block", "n_words", "docs", "counts", "numbers"])
    return docs.mapInArrow(work, "block long, n_words int, docs array<long>, counts array<int>, numbers binary")


def _encode_shards(path: str, pattern: str):
    """Lists in order of shard, one at a time: what is held is a batch and the
    words known in the shard, ``KNOWN_WORDS`` of ``KNOWN_BYTES`` at most
    (others are encoded again)."""
    def work(batches):
        encode = _encoder(path, pattern)._encode_single_piece
        known: dict[bytes, list[int]] = {}
        held, last = 0, None
        for b in batches:
            for i in range(0, b.num_rows, ROW_LISTS):
                t = b.slice(i, ROW_LISTS)
                counts, ids = [], []
                for shard, lens, words in zip(*(t.column(c).to_pylist() for c in ("shard", "lens", "words"))):
                    if shard != last:
                        known, held, last = {}, 0, shard
                    raw, at, own = _unzip(words), 0, []
                    for n in _unpack(lens).tolist():
                        word = raw[at:at + n]
                        at += n
                        got = known.get(word)
                        if got is None:
                            if len(known) >= KNOWN_WORDS or held + n > KNOWN_BYTES:
                                known, held = {}, 0
                            got = known[word] = encode(word)
                            held += n
                        own.append(got)
                    counts.append(_pack(np.array([len(x) for x in own])))
                    ids.append(_pack(np.array([y for x in own for y in x])))
                yield pa.RecordBatch.from_arrays(
                    [t.column("block"), t.column("shard"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
                    ["block", "shard", "counts", "ids"])
    return work


def _decode_table(path: str):
    """Token bytes end to end, with bounds, by id."""
    key = ("bytes", path)
    if key not in _LOADED:
        ranks = _ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in table])])
        _LOADED[key] = np.frombuffer(b"".join(table), np.uint8), bounds
    return _LOADED[key]


def _reassemble(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def work(places: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("shard")
        # Equal blocks (equal texts in equal order) send equal lists.
        shard = answers.column("shard").to_numpy()
        once = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
        counts = [_unpack(answers.column("counts")[int(k)].as_py()) for k in once]
        ids = [_unpack(answers.column("ids")[int(k)].as_py()) for k in once]
        counts = np.concatenate([*counts, np.zeros(0, np.uint32)]).astype(np.int64)
        ids = np.concatenate([*ids, np.zeros(0, np.uint32)])
        first = np.cumsum(counts) - counts
        token_bytes, bounds = _decode_table(path)
        size = np.diff(bounds)
        rows = places.to_pylist()
        place = next((_unpack(r["numbers"]) for r in rows if r["docs"] is None), np.zeros(0, np.uint32))
        if rows and len(counts) != rows[0]["n_words"]:
            raise ValueError("a block's words came back incomplete")
        out = []
        for r in rows:
            if r["docs"] is None:
                continue
            words = place[_unpack(r["numbers"])]
            at = 0
            for doc_id, n in zip(r["docs"], r["counts"]):
                w = words[at:at + n]
                at += n
                own = ids[V.ranges(first[w], counts[w])]
                raw = token_bytes[V.ranges(bounds[own], size[own])]
                out.append((doc_id, len(own), own.astype("<u4").tobytes(), raw.tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out
                                    else [pa.array([], f.type) for f in schema], schema=schema)
    return work


def encode(docs: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES,
           shards: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) and the
    bytes that the ids decode to, for each document.

    ``path``: file of ranks, present on each executor; ``shards``: parts of
    the vocabulary (the session's shuffle partitions, 64 at least).
    """
    spark = docs.sparkSession
    shards = shards or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Each block sends its common words, so a shard's lists grow with the
    # corpus: they pass in order of shard and are never held together.
    lists = word_lists(docs, pattern, block_bytes, shards).repartition(shards, "shard").sortWithinPartitions("shard")
    answers = lists.mapInArrow(_encode_shards(path, pattern), "block long, shard int, counts binary, ids binary")
    places = positions(docs, pattern, block_bytes, shards)
    return places.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _reassemble(path), "doc_id long, n_tokens long, ids binary, decoded binary")


def digest(encoded: DataFrame) -> DataFrame:
    """The query's columns: ids and decoded bytes as their SHA-256."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
