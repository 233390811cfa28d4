"""The registered queries without SQL, all columns against the brute-force versions."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import frame, odd_documents
from casecurve.llm import pieces as pc
from casecurve.llm import sharding
from casecurve.llm.queries import QUERIES
from test_dedup import reached, simhash_by_hand
from test_texts import ids_by_hand as pieces_by_hand
from test_tokens import library_ids, named_documents

ROWS = [*odd_documents(), *named_documents()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    frame(spark, ROWS).write.parquet(str(path / "documents.parquet"))
    return str(path)


def data(ids):
    return np.array(ids, "<u4").tobytes()


def test_op4(spark, folder):
    docs = defaultdict(list)
    for doc, text, _, source, _ in ROWS:
        ids = [*library_ids(text), 1]
        docs[doc, len(ids), source].append(ids)
    covered, sequences = Counter(), defaultdict(list)
    for r in QUERIES["op4_packing"](spark, folder).collect():
        key = r.doc_id, r.doc_tokens, r.source
        assert r.ids_crc32 in {zlib.crc32(data(ids[r.start : r.start + r.length])) for ids in docs[key]}
        covered.update((*key, r.start + i) for i in range(r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert covered == {(*key, i): len(same) for key, same in docs.items() for i in range(key[1])}
    last = max(sequences)
    for number in range(last + 1):
        end = 0
        for offset, length in sorted(sequences[number]):
            assert offset == end
            end += length
        assert end == 2048 or number == last


def test_op5(spark, folder):
    got = sorted(QUERIES["op5_plane_files"](spark, folder).collect(), key=lambda r: r.start)
    texts = [(r[0], data([*library_ids(r[1]), 0])) for r in ROWS]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x) // 4, zlib.crc32(x)) for d, x in texts)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)


def test_op6(spark, folder):
    fps = [(r[0], simhash_by_hand(r[1])) for r in ROWS]
    want = Counter((d, f"{f:016x}", c) for (d, f), c in zip(fps, reached(fps, 2)))
    assert Counter(map(tuple, QUERIES["op6_simhash_near_dedup"](spark, folder).collect())) == want


def test_op9(spark, folder):
    got = QUERIES["op9_sharding"](spark, folder).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard, r.map_version) for r in got} == {("bytes", None, 2)}
    load, of_id, shards = Counter(), defaultdict(set), defaultdict(list)
    for r in got:
        load[r.virtual_slot] += r["size"]
        of_id[r.doc_id].add(r.virtual_slot)
        shards[r.shard].append(r)
    assert all(len(x) == 1 for d, x in of_id.items() if d is not None)
    placed = sharding.rebalanced(sharding.first_map(8), load)
    assert all(placed.shard[r.virtual_slot] == r.shard for r in got)
    for rows in shards.values():
        rows.sort(key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(rows)))
        order = [(r.virtual_slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in rows]
        assert order == sorted(order)


def test_op2(spark, folder, monkeypatch):
    monkeypatch.setattr(pc.Vocabulary, "longest", pc.Vocabulary.of(pc.piece_bpe_path()).longest)
    want = Counter()
    for doc, text, *_ in ROWS:
        ids, text = pieces_by_hand(text or ""), text or ""
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))
        want[doc, len(ids), *digests, True] += 1
    assert Counter(map(tuple, QUERIES["op2_sentencepiece"](spark, folder).collect())) == want
