"""The pipeline's stages in a row against brute force, on documents of one block each."""

import random

import corpus_pipeline
from tidemark.llm import mixing

from .conftest import SCHEMA, rows, words


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def linked(a, b):
    return 4 * len(a & b) >= 3 * len(a | b)


def test_run(spark, tmp_path):
    rng = random.Random(7)
    texts = [words(rng, mixing.BLOCK, 5000) for _ in range(30)]
    item = words(rng, 30, 5000)
    near = texts[3].split()
    near[60] = "other"
    leak = words(rng, mixing.BLOCK - 30, 5000) + " " + item
    texts += [" ".join(near), texts[5], leak, words(rng, 20, 5000), "same again " * 64, None, ""]
    spark.createDataFrame(rows(texts, source=lambda i: "s"), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    left: dict[int, set] = {}
    for i, t in enumerate(texts):
        w = (t or "").split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
        if len(w) < 50 or 100 * len(covered) > 50 * len(w):
            continue
        if not any(linked(shingles(t), s) for s in left.values()):
            left[i] = shingles(t)
    want = {i for i in left if item not in texts[i]}
    assert want == set(range(30))

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == want
    # One source: its blocks are taken one and a half times, each document once whole and then again or not.
    assert sum(len(r.text.split()) for r in got) == 45 * mixing.BLOCK
    assert all(r.text == texts[r.doc_id] and r.lang == "en" for r in got)
    sizes = [sum(r.shard == s for r in got) for s in range(corpus_pipeline.SHARDS)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 45
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in enumerate(sizes))


def test_run_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    """Nulls in every column, repeated rows, long texts, clashing names, no rows at all."""
    spark.createDataFrame([(None, None), (1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for stage_docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, stage_docs, str(tmp_path)).columns == stage_docs.columns, name
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_hot_group_of_copies(spark, frame, tmp_path):
    """A third of all rows are one text, in two sources: one row of it stays and the mix takes it at most twice."""
    rng = random.Random(9)
    texts = [words(rng, 150, 5000) for _ in range(40)] + [words(rng, 150, 5000)] * 20
    frame(texts, source=lambda i: f"s{i % 2}").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= set(range(41)) and len({r.doc_id for r in got}) >= 39
    taken: dict[int, int] = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert max(taken.values()) <= 300
