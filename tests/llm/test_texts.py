from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from cases import frame, odd_documents, prose
from casecurve.llm import fingerprints as fp
from casecurve.llm import pieces as pc

# -- fingerprints -----------------------------------------------------------------------------------


def phrases_by_hand(text):
    seen, at = set(), 0
    while at < len(text):
        end = at + 1
        while text[at:end] in seen and end <= len(text):
            end += 1
        seen.add(text[at:end])
        at = end
    return seen


def test_phrases_and_likeness():
    rng = random.Random(3)
    for _ in range(40):
        text = "".join(rng.choice("abé𝄞 ") for _ in range(rng.randint(0, 400)))
        phrases = {}
        held = fp.parse(text, phrases)
        assert set(phrases) == phrases_by_hand(text) and "".join(phrases) + held == text
        values = fp.hashes(text, phrases)
        assert len(set(values.tolist())) == len(phrases)
        # The same phrase has the same hash wherever it stands.
        again = {p: h for p, h in zip(phrases, values.tolist())}
        other = {}
        fp.parse("zz" + text, other)
        for p, h in zip(other, fp.hashes("zz" + text, other).tolist()):
            assert again.get(p, h) == h
    a, b = prose(rng, 4000), prose(rng, 4000)
    mixed = a[: len(a) // 2] + b[: len(a) // 2]
    close, far = (fp.likeness(fp.fingerprint(a), fp.fingerprint(x)) for x in (mixed, b))
    assert fp.likeness(fp.fingerprint(a), fp.fingerprint(a)) == 1.0 and close > far
    pa_, pm = set(phrases_by_hand(a)), set(phrases_by_hand(mixed))
    assert abs(close - len(pa_ & pm) / len(pa_ | pm)) < 0.2
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("")) == 1.0 and fp.likeness(fp.fingerprint(""), fp.fingerprint("x")) == 0.0


@pytest.mark.parametrize("clash", [False, True])
def test_compared_with_edits(spark, clash):
    rows = [r for r in odd_documents() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    rows.append((None, "the last one has no id", None, None, None))
    got = {r.doc_id: r for r in fp.compared_with_edits(frame(spark, rows, clash)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    assert len(got) == len(rows)
    for here, after in zip(order, [*order[1:], order[0]]):
        text, other = here[1] or "", after[1] or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        its, own, nexts = (fp.fingerprint(t) for t in (edited, text, other))
        r = got[here[0]]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fp.as_text(own) and r.edited_fingerprint == fp.as_text(its)
        assert r.near_edited == fp.likeness(own, its) and r.near_next == fp.likeness(own, nexts)


def test_rows_without_an_id_are_spread(spark):
    """Half of the rows lack an id: they get parts of their own, in the order of their hashes."""
    rows = [(i if i % 2 else None, f"text {i} " * (1 + i % 5), "", "", 0) for i in range(3000)]
    ordered = fp.in_order(frame(spark, rows, partitions=8), "doc_id", "text")
    parts = Counter(r.part for r in ordered.filter("NOT guest").select("part").collect())
    assert sum(parts.values()) == 3000 and max(parts.values()) < 2 * 3000 / 8
    unnamed = [(r.part, -r.row) for r in ordered.filter("id IS NULL AND NOT guest").select("part", "row").collect()]
    assert len({p for p, _ in unnamed}) >= 4
    by_hash = sorted(unnamed, key=lambda x: x[1])
    assert [p for p, _ in by_hash] == sorted(p for p, _ in unnamed)
    got = Counter((r.doc_id, r.fingerprint) for r in fp.compared_with_edits(frame(spark, rows)).collect())
    assert got == Counter((r[0], fp.as_text(fp.fingerprint(r[1]))) for r in rows)


def test_every_row_is_compared_once(spark):
    rows = odd_documents()
    got = fp.compared_with_edits(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((r[0], fp.as_text(fp.fingerprint(r[1] or ""))) for r in rows)
    one = fp.compared_with_edits(frame(spark, [(5, "abcd", "", "", 1)])).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(5, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    assert fp.compared_with_edits(frame(spark, [], partitions=1)).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_fingerprints_alone(spark, clash):
    rows = odd_documents()
    got = Counter(map(tuple, fp.fingerprints(frame(spark, rows, clash)).collect()))
    assert got == Counter((r[0], fp.as_text(fp.fingerprint(r[1] or ""))) for r in rows)


# -- pieces -----------------------------------------------------------------------------------------

VOCABULARY = pc.Vocabulary.of(pc.piece_bpe_path())
TABLE = {text: (i, score) for i, text, score in VOCABULARY.pieces}


def word_by_hand(word):
    best = [(0.0, 0, [])]
    for end in range(1, len(word) + 1):
        edges = []
        for start in range(max(0, end - VOCABULARY.longest), end):
            sub = word[start:end]
            if sub in TABLE:
                edges.append((best[start][0] + TABLE[sub][1], -start, [TABLE[sub][0]]))
            elif end - start == 1:
                edges.append((best[start][0] + VOCABULARY.unknown_score, -start, [3 + b for b in sub.encode()]))
        best.append(max(edges))
    out, at = [], len(word)
    while at:
        out = best[at][2] + out
        at = -best[at][1]
    return out


def ids_by_hand(text):
    if not text:
        return []
    out, word, marked = [], "", "▁" + text.replace(" ", "▁")
    for i, c in enumerate(marked):
        if word and (c == "\n" or word == "\n" or (c == "▁" and word[-1] != "▁")):
            out += word_by_hand(word)
            word = ""
        word += c
    return out + word_by_hand(word)


@pytest.mark.parametrize("clash,common", [(False, 1 << 18), (True, 5)])
def test_encoded(spark, clash, common):
    rows = [r if len(r[1] or "") < 20000 else (*r[:1], r[1][:9000], *r[2:]) for r in odd_documents(n=25)]
    rows.append((800, "y" * 700 + "𝄞" * 300 + " " * 40 + "▁a", "en", "", 1))
    out = pc.encoded(frame(spark, rows, clash), pc.piece_bpe_path(), common=common)
    got = out.select("doc_id", "text", "ids", pc.decoded(out["ids"], VOCABULARY).alias("back")).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((r[0], tuple(ids_by_hand(r[1] or ""))) for r in rows)
    assert all(r.back == r.text.replace("▁", " ") for r in got)


def test_words_go_no_further_than_their_substrings(spark):
    rows = spark.createDataFrame([(i, "▁" + "ab" * 2000) for i in range(2)], "number int, word string")
    pieces = VOCABULARY.table(spark)
    plan = pc.lattice(rows, ["number"], VOCABULARY, pieces)
    assert plan.columns == ["number", "place", "edges"]
    assert plan.count() == 2 * 4001


def test_encoded_long_texts(spark, monkeypatch):
    # Found once: the version by hand asks for it at every place.
    monkeypatch.setattr(pc.Vocabulary, "longest", VOCABULARY.longest)
    rng = random.Random(4)
    long_word = "".join(rng.choice(["the", "an", "é", "zx", "ing", "中", "q\t"]) for _ in range(60000))[:100000]
    texts = [long_word, "a " + "x" * 100000 + " b", prose(rng, 9000)]
    assert len(texts[0]) == 100000 and len(texts[2]) > 40000
    rows = [(i, t, "en", "", len(t)) for i, t in enumerate(texts)]
    out = pc.encoded(frame(spark, rows), pc.piece_bpe_path())
    got = out.select("doc_id", "ids", pc.decoded(out["ids"], VOCABULARY).alias("back")).collect()
    assert {r.doc_id: r.ids for r in got} == {d: ids_by_hand(t) for d, t, *_ in rows}
    assert {r.doc_id: r.back for r in got} == {d: t for d, t, *_ in rows}


def test_common_words_are_short(spark, monkeypatch):
    saved, save = {}, pc.saved_table

    def kept(df, name="stage"):
        saved[name] = save(df, name)
        return saved[name]

    monkeypatch.setattr(pc, "saved_table", kept)
    texts = ["w" * 900 + " short"] * 2 + [" ".join(["v" * 61] * 3), " ".join(["u" * 62] * 3)]
    got = pc.encoded(frame(spark, [(i, t, "en", "", 1) for i, t in enumerate(texts)]), pc.piece_bpe_path()).collect()
    assert {r.word for r in saved["known"].collect()} == {"▁short", "▁" + "v" * 61}
    assert {r.doc_id: r.ids for r in got} == {i: ids_by_hand(t) for i, t in enumerate(texts)}


def test_no_text_is_shuffled(spark):
    rows = [(i, f"one two three {i}", "en", "", 1) for i in range(20)]
    out = pc.encoded(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string"), pc.piece_bpe_path())
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.ids for r in out.collect()} == {d: ids_by_hand(t) for d, t, *_ in rows}


def test_word_encoder(monkeypatch):
    monkeypatch.setattr(pc, "_REMEMBERED", 3)
    encoder = pc.WordEncoder(VOCABULARY, {"▁the": np.int32([7]).tobytes()})
    rng = random.Random(12)
    texts = ["".join(rng.choice(["an", "é", "zx", " ", "  ", "▁", "\n", "\t", "ing", "中", "𝄞", "\u200b"]) for _ in range(30)) for _ in range(200)]
    for text in ["", " ", "\n", "a\n", "\n\n a", "a  \n", *texts]:
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == ids_by_hand(text)
    assert np.frombuffer(encoder.encode("a the"), np.int32).tolist() == [*ids_by_hand("a"), 7] and len(encoder.ids.remembered) <= 3


def test_no_segmentation_of_the_library_scores_higher():
    score = {i: s for i, _, s in VOCABULARY.pieces}
    with open(pc.piece_bpe_path(), "rb") as f:
        # The model's own table read as one of summed scores: its type, the last field given, becomes 1.
        model = sentencepiece.SentencePieceProcessor(model_proto=f.read() + b"\x12\x02\x18\x01")
    rng = random.Random(9)
    for _ in range(200):
        text = " ".join("".join(rng.choice(["the", "an", "é", "zx", "q", "ing", "W", "中"]) for _ in range(rng.randint(1, 4))) for _ in range(5))
        ours, theirs = ids_by_hand(text), model.encode(text)
        assert model.decode(ours) == model.decode(theirs) == text
        assert sum(score[i] for i in ours) >= sum(score[i] for i in theirs)


def test_no_documents(spark):
    assert pc.encoded(frame(spark, [], partitions=1), pc.piece_bpe_path()).count() == 0


def test_signature_keeps_the_smallest():
    values = np.array([5, 5, 5, 9, 1, 7, 7, 2] * 40, np.uint32)
    assert fp.signature(values, 3).tolist() == [1, 2, 5] and fp.signature(values, 90).tolist() == [1, 2, 5, 7, 9]
