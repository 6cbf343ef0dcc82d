"""Prefix trie, line dedup and Merkle manifest against brute-force versions:
edge rows (null, empty, long, repeated, clashing columns) and all of sf0.001."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quire.llm import line_dedup, merkle, prefix_trie
from quire.session import materialize


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def crc(i):
    return zlib.crc32(str(i).encode())


def same(df, names, want):
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=key)
    want = sorted(want, key=key)
    assert [(a, b) for a, b in zip(got, want) if a != b][:3] == []
    assert len(got) == len(want)


@pytest.fixture(scope="module")
def rows(spark, small):
    got = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select(
        "doc_id", "source", "lang", "n_chars", "text").collect()]
    common = "\n".join(["  Shared LINE é ", "shared line É", f"own {0}"])
    more = [(900000 + k, "src1", "en", 3, common.replace("own 0", f"own {k}")) for k in range(12)]
    more += [(900001, "src1", "en", 3, common), (900001, "src1", "en", 3, common), (None, None, None, None, None),
             (None, "src1", None, 0, ""), (900020, None, "en", None, "\n\n \t\n"), (900021, "alone", None, 1, "one\ntwo"),
             (900022, "", "de", 1, "é😀\nß"), (900023, "src1", "en", 9, "x\n" * 3000), (900024, "zé", "en", 1, "shared line é"),
             (900025, "z", "en", 1, "\n"), (5, "src0", "en", 1, "a\nb"), (5, "src0", "en", 1, "a\nb")]
    return got + more


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    extra = {c: F.lit(1) for c in ("cls", "did", "h", "g", "i", "n", "digest", "gone", "at", "left", "right", "level", "root")}
    return materialize(df.withColumns(extra))


# --- lines ---------------------------------------------------------------------

def brute_lines(rows, least, documents):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    split = [(i, (t or "").split("\n")) for i, _, _, _, t in rows]
    key = lambda x: x.strip(" \t\n\v\f\r").translate(low)
    seen = collections.defaultdict(set)
    for i, lines in split:
        for x in lines:
            seen[key(x)].add(i)
    gone = {k for k, v in seen.items() if len(v) >= documents and len(k) >= least}
    out = []
    for i, lines in split:
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


@pytest.mark.parametrize("least,documents", [(1, 10), (6, 3)])
def test_lines(docs, rows, least, documents):
    same(line_dedup.digest(line_dedup.drop_lines(docs, least, documents)),
         ["doc_id", "n_lines", "n_dropped", "kept_sha256"], brute_lines(rows, least, documents))


def test_a_document_counts_once(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, "x"), (None, "x"), (None, "x")], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.drop_lines(df, documents=4).collect()} == {0}
    assert {r.n_dropped for r in line_dedup.drop_lines(df, documents=3).collect()} == {1}


# --- manifest ------------------------------------------------------------------

def brute_manifest(rows, fan):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(nodes):
        """Digests to (top, path of each: [(left, right), …])."""
        path, of = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k in range(len(path)):
                lo = of[k] // fan * fan
                path[k].append(("".join(nodes[lo:of[k]]), "".join(nodes[of[k] + 1:lo + fan])))
                of[k] //= fan
            nodes = [sha("".join(nodes[k:k + fan])) for k in range(0, len(nodes), fan)]
        return nodes[0], path

    by = collections.defaultdict(list)
    for i, s, lang, n, t in rows:
        leaf = sha("".join(map(field, (i, s, lang, n, t))))
        even = i is not None and crc(i) % 2 == 0
        t2 = t.replace("\n", "") if even and t is not None else t
        by[s].append(((i is not None, i or 0), leaf, i, sha("".join(map(field, (i, s, lang, n, t2))))))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, paths = [], {}
    for s in names:
        by[s].sort()
        top, paths[s] = climb([x[1] for x in by[s]])
        tops.append(top)
    root, upper = climb(tops)
    out = []
    for s, top, up in zip(names, tops, upper):
        for (_, leaf, i, leaf2), path in zip(by[s], paths[s]):
            acc = leaf2
            for left, right in path + up:
                acc = sha(left + acc + right)
            out.append((i, leaf, top, root, sha("".join(a + b for a, b in path + up)), acc, acc == root))
    return out


MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("fan", [3, 2])
def test_manifest(docs, rows, fan):
    want = brute_manifest(rows, fan)
    assert {x[-1] for x in want} == {True, False}
    same(merkle.digest(merkle.manifest(docs, fan)), MERKLE, want)


@pytest.mark.parametrize("count", [1, 4, 10])
def test_small_manifests(spark, count):
    rows = [(k, "only", None, k, f"a\n{k}") for k in range(count)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same(merkle.digest(merkle.manifest(df)), MERKLE, brute_manifest(rows, 3))


# --- trie ----------------------------------------------------------------------

def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    new = {}
    for c, turns in own.items():
        h = crc(c) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        new[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c in sorted(new):
        for d in range(len(new[c]) + 1):
            members[new[c][:d]].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
    return [(m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
             sha(",".join(str(c) for c in m if len(new[c]) == len(p)))) for p, m in members.items()]


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def made_up(seed, convs, words, longest):
    """Conversations over few texts, so that prefixes are shared at all depths."""
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        rows += [(c * r.choice([1, 1, 7]), t, r.choice(["user", None]), r.choice(words)) for t in range(r.randrange(1, longest))]
    return rows


def trie_rows(spark, rows):
    return materialize(spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("d", "i", "n", "x", "e", "p1", "t", "len")}))


EDGES = [(None, 0, "user", "lost"), (100, None, None, None), (100, 1, "user", ""), (101, 0, "user", "é😀"), (101, 0, "user", "é😀"),
         (102, 5, "user", "b"), (102, 3, "user", "a"), (-5, 0, "user", "x"), (0, 0, "user", "y" * 5000), (199, 0, None, "only"),
         (300, 0, "ab", "c"), (301, 0, "a", "bc"), (1 << 40, 0, "user", "far")]


@pytest.mark.parametrize("seed,batches,growth,block", [(2, 2, 4, 1024), (3, 3, 3, 3)])
def test_trie(spark, monkeypatch, seed, batches, growth, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = EDGES + made_up(seed, 70, ["a", "b", ""], 9) + [(2000 + k, t, "user", "same") for k in range(6) for t in range(9 * k)]
    same(prefix_trie.trie(trie_rows(spark, rows), batches, growth), TRIE, brute_trie(rows))


def test_turnless(spark):
    """A conversation whose turns all belong to an absent first one ends at the root."""
    c = next(c for c in range(501, 600) if crc(c) % 6 >= 2)
    rows = [(c, 0, "user", "gone")]
    assert brute_trie(rows) == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]
    same(prefix_trie.trie(trie_rows(spark, rows)), TRIE, brute_trie(rows))


def test_the_two_fattest_depth(spark):
    pairs = [(a, b) for b in range(1, 40) for a in range(b)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.expr(prefix_trie.fattest("a", "b")).alias("f")).collect()
    assert all(r.f == max(range(r.a + 1, r.b + 1), key=lambda d: d & -d) for r in got)


def test_a_search_ends_at_the_deepest_extent(spark):
    """Fat binary search against a scan of all extents, for sequences that are
    not in the trie."""
    rows = made_up(5, 60, ["a", "b"], 14)
    convs, turns = prefix_trie.rebuilt(trie_rows(spark, rows))
    table = prefix_trie.prefixes(turns)
    ends = convs.where("n > 0").join(table, "conv_id").where("d = n").groupBy("p1", "p2").agg(
        F.min("conv_id").alias("x"), F.max("n").alias("n"))
    inside, outside = ends.where("x % 3 <> 0"), ends.where("x % 3 = 0")
    nodes = prefix_trie.build(materialize(inside.select("x", "n", "p1", "p2")), table, 14, 1, 2)
    got = {r.x: r.a for r in prefix_trie.locate(outside.select("x", "n"), nodes, table, 4).collect()}
    extents = {(r.v1, r.v2) for r in nodes.collect()}
    names = collections.defaultdict(dict)
    for r in table.collect():
        names[r.conv_id][r.d] = (r.p1, r.p2)
    assert len(got) > 5
    assert got == {x: max([d for d, v in names[x].items() if v in extents], default=0) for x in got}


def test_empty_tables(spark, docs):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []
    none = docs.limit(0)
    assert merkle.digest(merkle.manifest(none)).collect() == []
    assert line_dedup.digest(line_dedup.drop_lines(none)).collect() == []
