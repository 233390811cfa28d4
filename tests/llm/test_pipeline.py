"""The pipeline against the same stages done by hand, and the guard of the entry."""

from __future__ import annotations

import random
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from cases import SCHEMA, frame, odd_documents, prose
from casecurve.llm import quality
from test_dedup import classes, lines_by_hand, simhash_by_hand
from test_rules_and_shards import measures_by_hand
from test_tokens import ids_by_hand


def without_repeats(texts, length=200):
    seen, out = {}, []
    data = [t.encode() for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    for text, d in zip(texts, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept, at = [], 0
        for c in text:
            size = len(c.encode())
            if not all(gone[at : at + size]):
                kept.append(c)
            at += size
        out.append("".join(kept))
    return out


def good(text):
    n_words, word_chars, n_symbols, n_dup, n_repeat = measures_by_hand(text)
    letters = [c for c in text or "" if c.isupper() or c.islower()]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return not (
        n_words < 20
        or 100 * n_repeat > 30 * n_words
        or 10 * n_symbols > n_words
        or 2 * n_dup > len(lines)
        or word_chars < 2 * n_words
        or word_chars > 20 * n_words
        or 2 * sum(c.isupper() for c in letters) > max(1, len(letters))
    )


def by_hand(rows):
    rows = [(r[0], r[1]) for r in rows if good(r[1])]
    rows = [(d, t) for d, t, *_ in lines_by_hand(rows)]
    groups, of = classes([(d, simhash_by_hand(t)) for d, t in rows], 2)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    rows = [r for r, g in zip(rows, of) if r[0] == least[g]]
    return list(zip((d for d, _ in rows), without_repeats([t for _, t in rows])))


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    rows = list({r[0]: r for r in odd_documents(n=30)}.values())
    shared, copied = prose(rng, 90).replace("\n", " "), prose(rng, 150)
    for i in range(6):
        rows.append((2000 + i, prose(rng, 60) + "\n" + prose(rng, 20).replace("\n", " ") + shared + " tail " + prose(rng, 40), "en", "src0", 1))
        rows.append((3000 + i, copied, "en", "src1", 1))
    rows.append((4000, "JUNK!! " * 60, "en", "src1", 1))
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = by_hand(rows)
    assert len(want) > 30 and len({t for _, t in want}) < len(rows)
    ids = {}
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == ids.get(r.doc_id, 0)
        ids[r.doc_id] = r.start + r.length
    assert ids == {d: len(ids_by_hand(t)) + 1 for d, t in want}


def test_stages_return_documents(spark):
    df = frame(spark, odd_documents(n=8))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
    assert len(quality.RULES) == 7


def test_the_rest_works_without_this_subpackage(tmp_path):
    home = Path(corpus_pipeline.__file__).parent
    shutil.copytree(home / "casecurve", tmp_path / "casecurve", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(home / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 100 and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300)
