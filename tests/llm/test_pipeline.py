"""Each stage of the pipeline against brute force on what the one before kept."""

from __future__ import annotations

import random

from test_dedup import brute_components, brute_lines, brute_sets
from test_tokens import reference  # noqa: F401
from text_fixtures import ROWS

import corpus_pipeline


def test_stages_match_brute_force(spark, tmp_path, reference):  # noqa: F811
    rng = random.Random(12)
    line = lambda: " ".join(f"{rng.choice('klmnr')}{rng.choice('aeiou')}{rng.randrange(40)}x" for _ in range(12))
    texts, shared = [], [line() for _ in range(9)]
    for i in range(90):
        own = [line() for _ in range(6)]
        if i % 6 == 0:
            texts.append(" ".join(w.upper() + "!!" for w in " ".join(own).split()))
        elif i % 6 == 1:
            texts.append("\n".join([*own, *shared]))
        elif i % 6 == 2:
            texts.append("\n".join([*own, "write to a.b@mail.example.com"]))
        else:
            texts.append("\n".join(own))
    texts += [texts[3].replace("x", "x", 1) + " more", ""]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame([*rows, (None, None, None, None, None)], ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(i % 6 != 0), 0) for i in range(90)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert out.columns == docs.columns
            seen[name] = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
        docs = out
    good = {i: t for i, t in enumerate(texts) if i >= 90 or i % 6 != 0}
    assert {i for i in good if i < 90} <= set(seen["quality"]) <= set(good)
    lines = brute_lines(list(seen["quality"].items()))
    assert seen["line_dedup"] == {i: t for i, (t, _, _) in lines.items()}
    groups = brute_components(brute_sets(list(seen["line_dedup"].items()), 5), 80)
    assert set(seen["near_dedup"]) == {i for i, (_, _, kept) in groups.items() if kept}
    assert seen["pii"] == {i: t.replace("a.b@mail.example.com", "<email>") for i, t in seen["near_dedup"].items()}
    pieces = [r for r in docs.collect() if r.doc_id is not None]
    ids = {i: [*reference(t), 0] for i, t in seen["pii"].items()}
    assert {r.doc_id for r in pieces} == set(ids)
    assert all(r.doc_tokens == len(ids[r.doc_id]) for r in pieces)
    assert sum(r.length for r in pieces) == sum(map(len, ids.values()))


def test_stages_take_empty_tables_repeated_rows_long_texts_and_clashing_columns(spark, tmp_path):
    long = "\n".join(f"long line number {i} of this text" for i in range(20_000))
    rows = [(1, "first line here\nsecond line here\nmail x.y@mail.example.com now", "en", "s", 0)] * 2
    rows += [(2, long, "en", None, 0), (3, None, None, None, None), (None, "some text of nobody", "en", "s", 1)]
    rows += [(i, f"word {i} one.\nand number {i * 7} more.", "en", "s", 2) for i in range(10, 40)]
    clash = [f"'mine' AS `{c}`" for c in ("n_lines", "n_removed", "row", "key", "tie", "gone", "kept", "pair")]
    documents = spark.createDataFrame(rows, ROWS).selectExpr("*", *clash)
    marks = [(i, i % 2, 0) for i in range(10, 40)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for at, docs in enumerate((documents, documents.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            stage_rows = out.collect()
            if name == "packing":
                assert bool(stage_rows) == (at == 0)
                continue
            assert out.dtypes == docs.dtypes, name
            assert all(r.n_lines == r.row == r.gone == r.kept == "mine" for r in stage_rows)
            if at == 0 and name != "quality":
                assert {1, 2, 3, None} <= {r.doc_id for r in stage_rows}
            if name in ("line_dedup", "pii"):
                assert all(r.n_chars == len(r.text) for r in stage_rows)
