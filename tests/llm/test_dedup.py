from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from cases import frame, odd_documents, prose
from casecurve.llm import line_dedup as ld
from casecurve.llm import simhash as sh
from casecurve.llm import suffixes as sx
from casecurve.llm.components import components

SPACES = " \t\n\x0b\x0c\r"


def counted(rows):
    return Counter(map(tuple, rows))


def ascii_lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# -- lines ------------------------------------------------------------------------------------------


def lines_by_hand(rows, min_chars=10, min_docs=2):
    holders = defaultdict(set)
    key = lambda line: ascii_lower(line.strip(SPACES))
    for doc, text, *_ in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if doc is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or min(holders[key(x)]) == doc
        ]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("min_docs", [2, 4])
def test_line_dedup(spark, clash, min_docs):
    rows = odd_documents()
    got = ld.line_dedup(frame(spark, rows, clash), min_docs=min_docs).collect()
    assert counted(got) == counted(lines_by_hand(rows, min_docs=min_docs))


def test_line_dedup_runs_no_python(spark):
    plan = ld.line_dedup(frame(spark, odd_documents()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- SimHash ----------------------------------------------------------------------------------------


def simhash_by_hand(text, shingle=3):
    words = [w for w in ascii_lower(text or "").replace("\t", " ").translate({ord(c): " " for c in SPACES}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] if len(words) >= shingle else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids_fps, radius):
    """Ids by component; pairs by brute force."""
    n = len(ids_fps)
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if (ids_fps[i][1] ^ ids_fps[j][1]).bit_count() <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(n):
        groups[root(i)].append(ids_fps[i][0])
    return groups, [root(i) for i in range(n)]


def reached(ids_fps, radius):
    """Least id over all rows a row reaches."""
    groups, of = classes(ids_fps, radius)
    return [min((x for x in groups[g] if x is not None), default=None) for g in of]


@pytest.mark.parametrize("clash,radius,tree_size", [(False, 2, 16384), (True, 2, 3), (False, 3, 16384), (False, 0, 4)])
def test_near_duplicates(spark, clash, radius, tree_size):
    rng = random.Random(8)
    rows = odd_documents()
    base = prose(rng, 400)
    rows += [(5000 + i, base[: 1500 - 7 * i] + prose(rng, 3) + base[1500:], "en", "src0", 1) for i in range(25)]
    got = sh.near_duplicates(frame(spark, rows, clash), radius=radius, tree_size=tree_size).collect()
    fps = [(r[0], simhash_by_hand(r[1])) for r in rows]
    signed = [f - (1 << 64) if f >> 63 else f for _, f in fps]
    want = Counter(zip((r[0] for r in rows), signed, reached(fps, radius)))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got) == want
    assert len({r.component_id for r in got}) < len(rows)


@pytest.mark.parametrize("clash", [False, True])
def test_one_document_of_each_component_stays(spark, clash):
    rows = odd_documents()
    df = frame(spark, rows, clash)
    left = sh.without_near_duplicates(df)
    assert left.columns == df.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    groups, _ = classes([(r[0], simhash_by_hand(r[1])) for r in rows], 2)
    least = Counter(min((x for x in g if x is not None), default=None) for g in groups.values())
    assert Counter(d for d, _ in kept) == least
    assert set(kept) <= {(r[0], r[1]) for r in rows}


@pytest.mark.parametrize("radius,tree_size", [(2, 50), (2, 10000), (4, 64), (0, 7)])
def test_links_reach_what_all_pairs_reach(spark, radius, tree_size):
    rng = np.random.default_rng(radius)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [seeds[rng.integers(0, 40, 300)] for _ in range(4)]
    fps = np.unique(np.concatenate([seeds, *(f ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for f in flips)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.component for r in components(sh.links(df, radius, tree_size)).collect()}
    signed = [int(x) for x in fps.view(np.int64)]
    want = reached([(s, int(f)) for s, f in zip(signed, fps)], radius)
    assert [got.get(s, s) for s in signed] == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3), (200, 300), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- suffixes ---------------------------------------------------------------------------------------


def removed_by_hand(rows, length):
    seen = Counter()
    texts = [(r[1] or "").encode() for r in rows]
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    out = []
    for row, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((row[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("clash,length,shard_bytes", [(False, 200, 4 << 20), (True, 64, 4 << 20), (False, 64, 600), (False, 200, 2000)])
def test_remove_repeats(spark, clash, length, shard_bytes):
    rng = random.Random(4)
    rows = odd_documents()
    base = prose(rng, 200)
    cuts = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(30)]
    rows += [(9000 + i, prose(rng, 4) + base[a : len(base) - b] + prose(rng, 9), "en", "src1", 1) for i, (a, b) in enumerate(cuts)]
    got = sx.remove_repeats(frame(spark, rows, clash), length=length, shard_bytes=shard_bytes)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert counted(got.select(columns).collect()) == counted(removed_by_hand(rows, length))


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(30):
        texts = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
        array, rank, ends, data = sx.suffix_array(texts)
        suffixes = [(data[i : ends[i]].tobytes(), i) for i in range(len(data))]
        assert [i for _, i in sorted(suffixes)] == array.tolist()
        assert rank[array].tolist() == list(range(len(data)))
        shared = sx.common_prefixes(texts, array, rank, ends, data, 1000)
        for x, y in zip(array[:-1], array[1:]):
            a, b = suffixes[x][0], suffixes[y][0]
            assert shared[y] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_runs_hold_every_string_once():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 3000))) for _ in range(20)] + [b"z" * 1_200_000]
    found = Counter()
    for number, start, size, _, (first, data) in sx.runs(texts, 200):
        for n, s, z, f in zip(number.tolist(), start.tolist(), size.tolist(), first.tolist()):
            assert texts[n][s : s + z] == data[f : f + z]
            found.update((n, i) for i in range(s, s + z - 199))
    assert found == Counter((n, i) for n, t in enumerate(texts) for i in range(len(t) - 199))


def test_kept_text_stays_text(spark):
    shared = "é" * 150
    rows = [(1, "aa" + shared + "b", "", "", 0), (2, "c" + shared + "dd", "", "", 0), (3, "é" * 40, "", "", 0)]
    got = {r.doc_id: r.text for r in sx.remove_repeats(frame(spark, rows)).collect()}
    assert got == {1: "aab", 2: "cdd", 3: "é" * 40}


def test_empty_tables(spark):
    empty = frame(spark, [], partitions=1)
    assert ld.line_dedup(empty).count() == sh.near_duplicates(empty).count() == sx.remove_repeats(empty).count() == 0
