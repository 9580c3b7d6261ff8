"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

import pytest
from test_decontaminate import words
from test_near_dedup import brute as components
from test_suffix_dedup import brute as repeats

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    from panelloom.llm.registry import importable, table
    from panelloom.llm.shared import written

    importable(spark)
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF_DIR), "stage")
        if name != "packing":
            assert after.dtypes == docs.dtypes
        out[name] = [r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]
        docs = after
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_language_stage_keeps_what_it_can_tell(stages):
    before, after = stages["language_id"]
    gone = set(ids(before)) - set(ids(after))
    assert len(gone) <= 0.02 * len(before) and all(len(r["text"]) < 60 for r in before if r["doc_id"] in gone)
    assert all(r in before for r in after)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    found = components([(r["doc_id"], r["text"]) for r in before], width=5)
    assert ids(after) == sorted(i for i, (_, low) in found.items() if i == low)
    assert all(r in before for r in after)


def test_repeated_passages_go(stages):
    before, after = stages["suffix_dedup"]
    left = {i: kept.decode("utf-8", "ignore") for i, _, _, kept in repeats([(r["doc_id"], r["text"]) for r in before])}
    assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, t in left.items() if t.strip(" ")}
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_no_benchmark_passage_is_left(spark, stages):
    from panelloom.llm.registry import table

    before, after = stages["decontamination"]
    windows = set()
    for item in table(spark, SF_DIR, "benchmark").collect():
        w = words(item.text)
        n = min(10, len(w))
        windows |= {tuple(w[s : s + n]) for s in range(len(w) - n + 1)} if w else set()
    hit = lambda t: any(tuple(t[s : s + n]) in windows for n in {len(w) for w in windows} for s in range(len(t) - n + 1))
    clean = {r["doc_id"]: r for r in before if not hit(words(r["text"]))}
    by_id = {r["doc_id"]: r for r in after}
    assert all(by_id[i] == r for i, r in clean.items())
    dirty = [r for r in before if r["doc_id"] not in clean]
    assert dirty and all(len(by_id[r["doc_id"]]["text"]) < len(r["text"]) for r in dirty if r["doc_id"] in by_id)


def test_every_token_is_packed(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after} == set(ids(before))
    assert all(len(r["ids"]) == 4 * r["length"] and r["offset"] + r["length"] <= 1024 for r in after)


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"])
    assert sorted(map(key, rows)) == sorted(map(key, stages["packing"][1]))


ODD = [
    (1, "The first text has some words in it, as one would say.", "en"), (1, "The first text has some words in it, as one would say.", "en"),
    (2, None, "de"), (3, "", None), (4, "   ", "en"), (5, "und die der mit von für ist im den ein eine einer " * 400, "de"), (None, "no id but words of its own", "fr"),
    (6, "x", "en"), (7, "The first text has some words in it, as one would say!", "en"),
]
CLASHING = "score string, margin int, rejected string, lang_pred string, text_key string, n_bytes int, spans string, kept string, row string, `a.b` int, n_chars int"


@pytest.mark.parametrize("rows", [ODD, ODD[:1] * 40, []])
def test_odd_rows_and_clashing_columns(spark, rows):
    """Columns that stages use for themselves come back as they were, on the rows that stay; nothing crashes."""
    from panelloom.llm.registry import table
    from panelloom.llm.shared import written

    own = ("s", -5, "no", "me", "k", 7, "sp", "ke", "ro", 3, 1)
    docs = spark.createDataFrame([(*r, *own) for r in rows], f"doc_id long, text string, lang string, {CLASHING}")
    train = table(spark, SF_DIR, "documents").select("doc_id", "text", "lang")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = docs.select("*")
        if name == "language_id" and rows:  # so that there are languages to tell
            given = docs.unionByName(train.select((train.doc_id + 1000).alias("doc_id"), "text", "lang"), allowMissingColumns=True)
        after = written(stage(spark, given, SF_DIR), "odd")
        assert after.columns == docs.columns
        kept = [r for r in after.collect() if r["doc_id"] is None or r["doc_id"] < 1000]
        assert all(tuple(r)[3:-1] == own[:-1] for r in kept), name
        if name in ("language_id", "near_dedup"):
            assert all((r["doc_id"], r["text"], r["lang"]) in rows for r in kept)
        if name == "near_dedup" and rows:
            assert len(kept) == len({(r[0], r[1]) for r in rows})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert len(packed) >= len(rows) and all(r["offset"] + r["length"] <= 1024 for r in packed)


def test_a_run_leaves_its_result_alone(spark):
    from pathlib import Path

    from panelloom.session import scratch_folder

    folder = Path(scratch_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    corpus_pipeline.run(spark, SF_DIR)
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["result"]
