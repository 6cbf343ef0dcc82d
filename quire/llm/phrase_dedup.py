"""Repeated-phrase removal with sharded Aho-Corasick automata.

1. *Confirm.* Passages that may recur are found through the anchors of
   :mod:`quire.llm.repeats`. Among the different contexts of an anchor, word
   windows of ``length`` that occur in documents of different numbers are
   confirmed, and windows in a row whose first document is the same are merged
   to one maximal *phrase* (its words, and that first document).
2. *Compile.* The phrases of a shard (some anchors) become one Aho-Corasick
   automaton over words, one symbol for each word.
3. *Stream.* Every document's passages go through the automata of their
   shards, and its hits, compared word by word with the phrase, are the
   occurrences. An occurrence in a document of larger number than the phrase's
   first is removed. Nothing else removes a word, apart from whole copies of a
   text.

A passage only streams through the shard of its anchor (the prefilter), and
equal passages stream once, so work grows with the repeated text, not with
documents times shards. An anchor of more than ``group_limit`` contexts would
make one shard of a size without bound: its windows are confirmed by a
shuffle, and its phrases are dealt to shards by their own words, each with the
passages that hold it.

Defined results: a null text has no words; a null number counts as larger
than all others; documents of equal number are no copies of one another; rows
of equal number and text get equal results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import repeats as R
from quire.llm import vectors as V

LENGTH = 50
SEED = 8
_MAX = (1 << 63) - 1
#: Words become code points outside the surrogates; hits are confirmed by word.
_SYMBOLS = 0x10FFFF - 0xE000
_PHRASE = "anchor long, deal long, phrase binary, least long"


def symbols(parts: list[bytes]) -> list[str]:
    """Each part as a string of one code point for each word."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
    s, e, bounds = V.words(data, off)
    codes = (V.byte_prefix(data).span(s, e) % V.U(_SYMBOLS)).astype(np.uint32) + np.uint32(0xE000)
    text = codes.tobytes().decode("utf-32-le")
    return [text[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def automaton(phrases: list[tuple[bytes, int]]):
    """Compile phrases (their words, joined by a blank) with the number of
    their first document. Equal symbols of different words share an entry."""
    import ahocorasick
    a = ahocorasick.Automaton()
    for text, (phrase, least) in zip(symbols([p for p, _ in phrases]), phrases):
        held = a.get(text, None)
        if held is None:
            a.add_word(text, [(len(text), phrase, least)])
        else:
            held.append((len(text), phrase, least))
    a.make_automaton()
    return a


def occurrences(machine, part: bytes):
    """(first word, number of words, first document) of each phrase found."""
    words = None
    for end, held in machine.iter(symbols([part])[0]):
        for n, phrase, least in held:
            words = words or part.split()
            at = end - n + 1
            if b" ".join(words[at:at + n]) == phrase:
                yield at, n, least


def _merged(part: bytes, starts, leasts, length: int):
    """Windows of one part that recur to maximal phrases."""
    words = part.split()
    at = 0
    for k in range(1, len(starts) + 1):
        if k == len(starts) or starts[k] != starts[k - 1] + 1 or leasts[k] != leasts[k - 1]:
            yield b" ".join(words[starts[at]:starts[k - 1] + length]), int(leasts[at])
            at = k


def _phrases(rows: list[tuple[int, bytes, int]], split: bool) -> pa.RecordBatch:
    """``split``: deal phrases out by their words."""
    import zlib
    a, p, m = zip(*rows)
    deal = [zlib.crc32(x) if split else 0 for x in p]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(deal, pa.int64()), pa.array(p, pa.binary()),
                                       pa.array(m, pa.int64())], ["anchor", "deal", "phrase", "least"])


def _confirm(length: int):
    """Phrases of whole anchors out of their contexts."""
    def work(batches):
        for t in R.grouped(batches, "anchor", 1000):
            parts, anchor = t.column("part").to_pylist(), t.column("anchor").to_numpy()
            h, bounds = R.window_hashes(parts, "word", length)
            h2, _ = R.window_hashes(parts, "word", length, 1)
            item = V.rows_of(bounds)
            _, group = np.unique(np.stack([anchor[item], h, h2]), axis=1, return_inverse=True)
            group = group.ravel()
            least, most = np.full(len(h), _MAX), np.full(len(h), -_MAX - 1)
            np.minimum.at(least, group, t.column("did").to_numpy()[item])
            np.maximum.at(most, group, t.column("most").to_numpy()[item])
            recurs = np.flatnonzero((least < most)[group])
            cut = np.searchsorted(recurs, bounds)
            found = set()
            for k in np.flatnonzero(np.diff(cut)).tolist():
                own = recurs[cut[k]:cut[k + 1]]
                found.update((int(anchor[k]), *x) for x in _merged(
                    parts[k], (own - bounds[k]).tolist(), least[group[own]].tolist(), length))
            if found:
                yield _phrases(list(found), False)
    return work


def _confirm_listed(length: int):
    """Phrases of contexts whose recurring windows were found by a shuffle."""
    def work(batches):
        for b in batches:
            rows = [(a, *x) for a, part, windows in zip(*(b.column(k).to_pylist() for k in ("anchor", "part", "windows")))
                    for x in _merged(part, [w["w"] for w in windows], [w["least"] for w in windows], length)]
            if rows:
                yield _phrases(rows, True)
    return work


def _stream(length: int):
    """Sorted rows of whole shards, phrases first, to the occurrences in the
    passages: anchor, context, first window, windows and first document."""
    def work(batches):
        for t in R.grouped(batches, "shard", 500):
            phrase = t.column("phrase").combine_chunks()
            compiled = t.filter(phrase.is_valid())
            if not compiled.num_rows:
                continue
            machine = automaton(list(dict.fromkeys(zip(compiled.column("phrase").to_pylist(), compiled.column("least").to_pylist()))))
            out = []
            docs = t.filter(phrase.is_null())
            for a, c, part in zip(*(docs.column(k).to_pylist() for k in ("anchor", "context", "part"))):
                out += [(a, c, at, n - length + 1, least) for at, n, least in occurrences(machine, part)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))],
                    ["anchor", "context", "at", "windows", "least"])
    return work


def confirmed_phrases(parts: DataFrame, length: int) -> DataFrame:
    """anchor, deal, phrase, least: the recurring phrases of all contexts."""
    cold = parts.where("not hot").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_confirm(length), _PHRASE)
    hot = parts.where("hot")
    windows = R.hot_windows(hot, "word", length).select("anchor", "context", "h", "h2", "w", "did")
    windows = R.write_once(windows.join(hot.select("anchor", "context", "most"), ["anchor", "context"]))
    same = ["anchor", "h", "h2"]
    least = windows.groupBy(*same).agg(F.min("did").alias("least"), F.max("most").alias("last")).where("least < last")
    # A list is as long as its context has windows at most.
    lists = windows.join(least, same).groupBy("anchor", "context").agg(
        F.array_sort(F.collect_list(F.struct("w", "least"))).alias("windows"))
    listed = hot.join(lists, ["anchor", "context"]).select("anchor", "part", "windows").mapInArrow(
        _confirm_listed(length), _PHRASE).distinct()
    return R.write_once(cold.unionByName(listed))


def located(parts: DataFrame, phrases: DataFrame, length: int) -> DataFrame:
    """Every occurrence of the phrases in the passages, by the automata."""
    none = F.lit(None)
    shard = F.xxhash64("anchor", "deal")
    patterns = phrases.select(shard.alias("shard"), F.lit(0).alias("kind"), "anchor", none.cast("long").alias("context"),
                              none.cast("binary").alias("part"), "phrase", "least").dropDuplicates(["shard", "phrase", "least"])
    streams = parts.where("not hot").withColumn("deal", F.lit(0).cast("long"))
    crowded = parts.where("hot")
    # A passage of a crowded anchor goes to the shards of the phrases that start
    # with a window of its own.
    heads = phrases.where("deal <> 0").select("anchor", "deal", F.col("phrase").alias("part"), F.lit(0).cast("long").alias("context"),
                                              F.lit(0).cast("long").alias("did"), F.lit(b"").alias("cls"), F.lit(0).alias("first"),
                                              F.lit(True).alias("open"))
    heads = heads.withColumn("context", F.col("deal"))
    first = R.hot_windows(heads, "word", length).where("w = 0").select("anchor", F.col("context").alias("deal"), "h", "h2").distinct()
    own = R.hot_windows(crowded, "word", length).select("anchor", "context", "h", "h2")
    dealt = own.join(first, ["anchor", "h", "h2"]).select("anchor", "context", "deal").distinct()
    streams = streams.unionByName(crowded.join(dealt, ["anchor", "context"]).select(*streams.columns))
    streams = streams.select(shard.alias("shard"), F.lit(1).alias("kind"), "anchor", "context", "part",
                             none.cast("binary").alias("phrase"), none.cast("long").alias("least"))
    return patterns.unionByName(streams).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
        _stream(length), "anchor long, context long, at int, windows int, least long")


def copied_windows(docs: DataFrame, length: int, seed: int, group_limit: int) -> DataFrame:
    """(cls, first, n): runs of windows with a copy in a document of smaller
    number, for the lowest-numbered document of each class of text."""
    texts = R.keyed(docs)
    found = R.repeated_runs(R.runs(texts, "word", length, seed), R.write_once, ["cls"])
    kinds = R.write_once(found.groupBy("anchor", "context").agg(
        F.min(F.struct("did", "cls", "first", "n")).alias("place"), F.max("did").alias("most")))
    crowd = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("place.did").alias("lo"),
                                        F.max("most").alias("hi")).where("lo < hi")
    # Each different context once, from its first document.
    wanted = kinds.join(R.write_once(crowd), "anchor").select(
        "anchor", "context", "place.cls", "place.did", "place.first", "place.n", F.lit(True).alias("open"),
        (F.col("kinds") > group_limit).alias("hot"))
    parts = R.contexts(texts, wanted, "word", length).dropDuplicates(["anchor", "context"])
    parts = R.write_once(parts.join(kinds.select("anchor", "context", "most"), ["anchor", "context"]))
    hits = R.write_once(located(parts, confirmed_phrases(parts, length), length))
    return found.join(hits, ["anchor", "context"]).where("did > least").select(
        "cls", (F.col("first") + F.col("at")).alias("first"), F.col("windows").alias("n"))


def _apply(length: int):
    def work(batches):
        for b in batches:
            whole, marks = b.column("whole").to_pylist(), b.column("windows").to_pylist()
            data, off = V.utf8(b.column("text"))
            out = []
            for k in range(b.num_rows):
                words = data[off[k]:off[k + 1]].tobytes().split()  # bytes: blank and \x09-\x0D
                n = len(words)
                if n >= length and whole[k]:
                    out.append((n, n, b""))
                elif marks[k]:
                    gone = R.covered(marks[k], n, length)
                    out.append((n, int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g)))
                else:
                    out.append((n, 0, b" ".join(words)))
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:2]), pa.array(cols[2], pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"])
    return work


def remove_phrases(docs: DataFrame, length: int = LENGTH, seed: int = SEED,
                   group_limit: int = R.GROUP_LIMIT) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (joined by a blank,
    UTF-8) of each document. A word goes if a window that covers it also
    starts in a document of smaller number, judged on the input."""
    sizes = R.keyed(docs).groupBy("cls").agg(F.min("did").alias("owner"), F.max("did").alias("last"))
    lists = R.to_ranges(copied_windows(docs, length, seed, group_limit))
    marks = R.write_once(sizes.join(lists, "cls", "left").where("owner < last or windows is not null"))
    rows = docs.select("doc_id", R.text_class().alias("cls"), "text").join(marks, "cls", "left")
    whole = F.coalesce(F.col("doc_id").cast("long"), F.lit(_MAX)) > F.col("owner")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(whole, F.lit(False)).alias("whole"), "windows").mapInArrow(
        _apply(length), "doc_id long, n_words long, n_removed long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    """The query's columns: kept words as their SHA-256."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
