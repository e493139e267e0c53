"""The pipeline as a whole, with cases planted for each stage."""

import os
from urllib.parse import urlparse

import numpy as np

import corpus_pipeline
from marlstone.llm import common
from marlstone.llm.common import settled, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
SOUNDS = {"xx": ["ba", "ro", "ki", "lu", "men"], "yy": ["ést", "öna", "çi", "wyr", "üth"]}


def prose(seed, n, lang="xx"):
    dice = np.random.default_rng(seed)
    return " ".join("".join(dice.choice(SOUNDS[lang], 3)) for _ in range(n))


def test_planted_cases(spark, tmp_path):
    docs = {i: (prose(i, 120, lang := "xx" if i % 2 else "yy"), lang) for i in range(1, 61)}
    leak, passage = prose(901, 30), prose(902, 80)
    docs[70] = (docs[1][0], "xx")
    docs[71] = (docs[3][0].replace(docs[3][0].split()[60], "other", 1), "xx")
    docs[72] = (f"{prose(903, 60)} {passage} {prose(904, 60)}", "xx")
    docs[73] = (f"{prose(905, 60)} {passage} {prose(906, 60)}", "xx")
    docs[74] = (f"{prose(907, 40)} {leak} {prose(908, 40)}", "xx")
    docs[75] = ("1234 5678 !!", "xx")
    rows = [(i, t, lang, "s", len(t)) for i, (t, lang) in docs.items()] + [(None, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    kept = {}
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, str(tmp_path)), f"test_{name}")
        if name != "packing":
            assert now.schema.names == frame.schema.names
            kept[name] = {r.doc_id: r.text for r in now.collect()}
    judged = kept["language_id"]
    assert 75 not in judged and set(range(1, 61)) <= set(judged)
    assert set(judged) - set(kept["near_duplicates"]) == {70, 71}
    texts = kept["suffix_dedup"]
    assert passage not in texts[72] + texts[73]
    assert all(texts[i] == docs[i][0] for i in (*range(1, 61), 74))
    assert set(texts) - set(kept["decontamination"]) == {74}
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in whole.collect()} == set(kept["decontamination"])
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == sorted(
        map(str, now.drop("sequence_id", "offset").collect())
    )


def test_settled_keeps_its_result_only(spark, monkeypatch):
    made = []
    real = common.shared_dir

    def recorded(spark, purpose):
        made.append((purpose, real(spark, purpose)))
        return made[-1][1]

    monkeypatch.setattr(common, "shared_dir", recorded)

    def inner():
        return stored(spark.range(3), "a").unionByName(settled(lambda: stored(spark.range(4), "b"), "c"))

    result = settled(inner, "d")
    there = {purpose: os.path.exists(urlparse(path).path) for purpose, path in made}
    assert there == {"a": False, "b": False, "c": False, "d": True}
    assert result.count() == 7
