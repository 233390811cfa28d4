from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import frame, odd_documents
from casecurve.llm import packing, planes, tokens

PLAIN = Tokenizer.from_file(tokens.byte_bpe_path())
PLAIN.encode_special_tokens = True


def ids_by_hand(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t\r\0.,'\"-#é中Ünï", "ab", "It's", "'ll", "x1", "²", "´", "́", "\xa0", " ", "\x1c", "<|endoftext|>", "  "]), max_size=30).map("".join))
def test_words_lose_no_token(text):
    small = tokens.Encoder(tokens.byte_bpe_path(), remembered=3)
    for _ in range(2):
        assert np.frombuffer(small.encode(text), "<u4").tolist() == ids_by_hand(text)


def check_packed(rows, got, sequence):
    want = Counter((r[0], tuple([*ids_by_hand(r[1]), 1])) for r in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc[r.doc_id, r.doc_tokens].append((r.start, ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    # Rows of one id and length lie over each other: as many pieces at a place as there are such rows.
    places, texts = Counter(), Counter()
    for (doc, size), pieces in by_doc.items():
        for start, ids in pieces:
            places.update((doc, size, start + i, x) for i, x in enumerate(ids))
    for (doc, ids), n in want.items():
        for i, x in enumerate(ids):
            texts[doc, len(ids), i, x] += n
    assert places == texts
    last = max(by_sequence)
    assert sorted(by_sequence) == list(range(last + 1))
    for number, pieces in by_sequence.items():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == sequence or number == last


@pytest.mark.parametrize("clash,sequence,grain", [(False, 2048, 128), (True, 256, 16), (False, 64, 64)])
def test_packed(spark, clash, sequence, grain, monkeypatch):
    monkeypatch.setattr(packing, "_ROUNDS_PER_BLOCK", 8)
    rows = odd_documents()
    got = packing.packed(frame(spark, rows, clash), sequence=sequence, grain=grain).collect()
    check_packed(rows, got, sequence)


def test_proportions_hold_in_every_prefix(spark):
    rows = [(i, "word " * (50 + i % 90), "en", "abc"[i % 3 if i % 4 else 0], 1) for i in range(400)]
    got = packing.packed(frame(spark, rows), sequence=512, grain=32).collect()
    total, sent = Counter(), Counter()
    for r in got:
        total[r.source] += r.length
    whole, done = sum(total.values()), 0
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        sent[r.source] += r.length
        done += r.length
        if r.offset + r.length == 512:
            assert all(abs(sent[s] - done * total[s] / whole) <= 512 * total[s] / whole + 2 * 32 for s in total)


def test_given_shares(spark):
    rows = [(i, "word " * 60, "en", "ab"[i % 2], 1) for i in range(200)]
    got = packing.packed(frame(spark, rows), shares={"a": 3, "b": 1}, sequence=256, grain=16).collect()
    first = Counter()
    for r in got:
        if r.sequence_id < 20:
            first[r.source] += r.length
    assert abs(first["a"] / (20 * 256) - 0.75) < 0.02
    with pytest.raises(ValueError):
        packing.packed(frame(spark, rows), shares={"a": 1}).collect()


def test_empty(spark):
    assert packing.packed(frame(spark, [], partitions=1)).count() == 0


# -- added tokens, against the library as it comes ---------------------------------------------------

UNMODIFIED = Tokenizer.from_file(tokens.byte_bpe_path())
NAME = "<|endoftext|>"


def library_ids(text):
    return UNMODIFIED.encode(text or "", add_special_tokens=False).ids


def named_documents():
    texts = ["a <|endoftext|> b", NAME, NAME * 3, f"{NAME} \n  x", f"don't{NAME}'ll  ", "<|endoftext|", f"<|{NAME}|>", ("word " * 40 + NAME) * 9]
    return [(5000 + i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t\0.'-<|>é中", "ab", "'ll", "x1", "\xa0", NAME, NAME, "<|endof", "text|>", "  "]), max_size=30).map("".join))
def test_added_tokens_are_those_of_the_library(text):
    small = tokens.TextEncoder(tokens.byte_bpe_path(), remembered=3)
    for _ in range(2):
        assert np.frombuffer(small.encode(text), "<u4").tolist() == library_ids(text)


def test_packed_with_added_tokens(spark):
    assert library_ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    rows = [*odd_documents(n=8), *named_documents()]
    by_doc = defaultdict(dict)
    for r in packing.packed(frame(spark, rows), sequence=64, grain=16).collect():
        by_doc[r.doc_id][r.start] = np.frombuffer(bytes(r.ids), "<u4").tolist()
    for doc, text, *_ in named_documents():
        assert sum((ids for _, ids in sorted(by_doc[doc].items())), []) == [*library_ids(text), 1]


def test_plane_files_with_added_tokens(spark, tmp_path):
    rows = named_documents()
    files = planes.write_ids(frame(spark, rows), str(tmp_path / "p"), chunk=100)
    end = 0
    for r, (doc, text, *_) in zip(sorted(planes.read_ids(files, "bigint").collect(), key=lambda r: r.start), rows, strict=True):
        assert (r.id, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) == (doc, end, [*library_ids(text), 0])
        end += r.n_tokens
