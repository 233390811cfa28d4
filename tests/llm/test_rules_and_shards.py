from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import frame, odd_documents
from casecurve.llm import quality as q
from casecurve.llm import queries
from casecurve.llm import sharding as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(1 for i, x in enumerate(lines) if x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x1f#é\x0b ", max_size=200))
def test_measures(text):
    assert q.measure(text)[:5] == measures_by_hand(text)


@pytest.mark.parametrize("clash", [False, True])
def test_ledger(spark, clash):
    rows = odd_documents()
    got = q.ledger(frame(spark, rows, clash))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter((r[0], *measures_by_hand(r[1])) for r in rows)
    few = {r.doc_id for r in got.filter(q.rejected(q.Policy(9, q.BIT["few_words"]))).collect()}
    assert few == {r[0] for r in rows if measures_by_hand(r[1])[0] < 20}


def test_policies_and_ablation(spark):
    rows = q.ledger(frame(spark, odd_documents())).select("doc_id", "failed").collect()
    df = spark.createDataFrame(rows)
    policies = [q.BASE, q.FULL, q.Policy(3, q.BIT["symbols"])]
    got = {(r.version, r.rule): (r.n_failed, r.n_alone, r.n_rejected) for r in q.ablation(df, policies).collect()}
    for p in policies:
        hits = [r.failed & p.mask for r in rows]
        for name, bit in q.BIT.items():
            if p.mask & bit:
                want = (sum(h & bit != 0 for h in hits), sum(h == bit for h in hits), sum(h != 0 for h in hits))
                assert got.pop((p.version, name)) == want
    assert not got


def test_stored_policies(spark, tmp_path):
    path = str(tmp_path / "policies")
    q.store_policies(spark, path, [q.FULL, q.BASE])
    q.store_policies(spark, path, [q.Policy(7, 4), q.BASE])
    assert q.load_policies(spark, path) == [q.BASE, q.FULL, q.Policy(7, 4)]
    q.store_policies(spark, path, [q.Policy(7, 8)])
    with pytest.raises(ValueError, match="two masks"):
        q.load_policies(spark, path)


@pytest.mark.parametrize("clash", [False, True])
def test_shards(spark, clash, tmp_path):
    rows = odd_documents()
    got = s.shard_documents(frame(spark, rows, clash), 3, map_path=str(tmp_path / "map")).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    places, load = defaultdict(list), Counter()
    for r in got:
        places[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    stored = s.load_map(spark, str(tmp_path / "map"))
    assert stored.version == 2 and s.load_map(spark, str(tmp_path / "map"), 1) == s.first_map(3)
    assert all(stored.shard[r.virtual_slot] == r.shard for r in got)
    again = s.shard_documents(frame(spark, rows, partitions=5), slot_map=stored).select("doc_id", "shard", "slot", "text_crc32")
    assert Counter(map(tuple, again.collect())) == Counter((r.doc_id, r.shard, r.slot, r.text_crc32) for r in got)


def test_a_new_shard_takes_slots_and_gives_none():
    load = {i: 50 + i * 37 % 101 for i in range(s.N_SLOTS)}
    eight = s.rebalanced(s.first_map(8), load)
    nine = s.rebalanced(eight, load, 9)
    totals = [sum(load[i] for i, x in enumerate(nine.shard) if x == k) for k in range(9)]
    assert max(totals) - min(totals) <= max(load.values())
    moved = [(a, b) for a, b in zip(eight.shard, nine.shard) if a != b]
    assert nine.moved == len(moved) and sum(b == 8 for _, b in moved) >= 0.95 * len(moved)


def test_written_shards(spark, tmp_path):
    rows = odd_documents()
    s.write_shards(frame(spark, rows), str(tmp_path / "out"), n_shards=3)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.id, r.text) for r in got.collect()) == Counter((r[0], r[1] or "") for r in rows)


def test_query_reads_the_stored_ledger(spark, tmp_path, monkeypatch):
    rows = odd_documents()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    saved, save = {}, queries.saved_table

    def kept(df, name="stage"):
        saved[name] = save(df, name)
        return saved[name]

    monkeypatch.setattr(queries, "saved_table", kept)
    got = queries.QUERIES["op3_quality_rules"](spark, str(tmp_path))
    ledger = saved["ledger"]
    assert "text" not in ledger.columns and set(got.inputFiles()) == set(ledger.inputFiles())
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter((r[0], *measures_by_hand(r[1])) for r in rows)
    for r in got.collect():
        assert (r.base_failed, r.kept) == (r.failed & q.BASE.mask != 0, r.failed == 0)


def test_query_places_records_by_a_stored_map(spark, tmp_path, monkeypatch):
    frame(spark, odd_documents()).write.parquet(str(tmp_path / "documents.parquet"))
    path = str(tmp_path / "map")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: path)
    got = queries.QUERIES["op9_sharding"](spark, str(tmp_path)).collect()
    assert {r.map_version for r in got} == {2} and s.load_map(spark, path, 1) == s.first_map(8)
    stored = s.load_map(spark, path, 2)
    assert all(stored.shard[r.virtual_slot] == r.shard for r in got)
    with pytest.raises(ValueError):
        s.shard_documents(frame(spark, odd_documents(n=8)), map_path=path)


def test_empty(spark):
    empty = frame(spark, [], partitions=1)
    assert q.ledger(empty).count() == s.shard_documents(empty).count() == 0
    assert q.ablation(q.ledger(empty), [q.BASE]).count() == 0
