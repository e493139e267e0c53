"""Operators on small tables, against brute force, with all kinds of odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlstone.llm import (
    common,
    decontamination,
    language_id,
    license_scan,
    near_duplicates,
    packing,
    quality_rules,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from marlstone.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, seed long"


def prose(seed: int, n: int) -> str:
    random_ = np.random.default_rng(seed)
    parts = np.array(["an", "er", "ti", "on", "sha", "le", "mo", "ki"])
    words = ["".join(random_.choice(parts, random_.integers(1, 5))) for _ in range(n)]
    return " ".join(words)


PASSAGE = prose(1, 150)
BASE = prose(2, 300)
ITEM = prose(3, 30)


def changed(text: str, *places: int) -> str:
    words = text.split()
    for p in places:
        words[p] = f"changed{p}"
    return " ".join(words)


TEXTS = [
    None,
    None,
    "",
    " \n\t",
    "12 345 !!",
    "one two",
    "one two",
    "One, two!",
    BASE,
    BASE,
    BASE,
    changed(BASE, 10),
    changed(BASE, 10, 200),
    changed(BASE, *range(0, 300, 8)),
    prose(4, 80) + " " + PASSAGE + " " + prose(5, 60),
    PASSAGE + " " + prose(6, 90),
    prose(7, 90) + "\n" + PASSAGE,
    prose(8, 40) + " " + ITEM + " " + prose(9, 40),
    prose(10, 40) + " " + changed(ITEM, 7, 19) + " tail",
    prose(11, 12_000),
    "ha " * 900,
    "é\n\n  ü\t" * 300,
    "x" * 3000,
    "Licensed under the Apache License, Version 2.0. MIT License; MIT LICENSE, CC BY",
    "word <|endoftext|> more " * 60,
    "a # b\n a # b\na # b\n" + "one two three four five six " * 3,
]


@pytest.fixture(scope="module")
def rows():
    made = [(n if n % 9 else None, t, "en", "s", len(t or ""), n) for n, t in enumerate(TEXTS)]
    return made + [made[8], made[8], made[14], (8, "another text of id eight", None, None, None, 0)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # A column whose name some operators could want for themselves.
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_components(spark):
    random_ = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in random_.integers(0, 300, (220, 2))]
    pairs += [(1000, n) for n in range(1001, 1100)] + [(n, n + 1) for n in range(2000, 2060)]
    found = dict(
        tuples(components(spark.createDataFrame(pairs, "a long, b long")), "node", "root")
    )
    root = {x: x for p in pairs for x in p}

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((of(a), of(b)))
        root[b] = a
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert found == {x: of(x) for x in linked}


# -- near duplicates ------------------------------------------------------------


def shingle_set(text):
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def links_by_force(rows):
    sets = [shingle_set(r[1]) for r in rows]
    n = len(rows)
    linked = [
        [j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        for i in range(n)
    ]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(n)]
    classes = collections.defaultdict(list)
    for i in range(n):
        classes[root[i] if sets[i] else (i,)].append(i)
    return sets, linked, classes


def test_near_duplicates(docs, rows):
    sets, linked, classes = links_by_force(rows)
    expected = []
    for members in classes.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            expected.append(
                (rows[i][0], min(ids) if ids else None, len(linked[i]), sum(sets[i] == sets[j] for j in members))
            )
    found = near_duplicates.near_duplicates(docs)
    assert tuples(found, "doc_id", "class_id", "n_links", "copies") == sorted(expected, key=repr)


def test_one_of_each(docs, rows):
    sets, _, classes = links_by_force(rows)
    kept = near_duplicates.one_of_each(docs).collect()
    assert set(kept[0].asDict()) == set(docs.columns)
    with_words = [r for r in kept if shingle_set(r["text"])]
    wanted = []
    for members in classes.values():
        if sets[members[0]]:
            ids = [rows[i][0] for i in members if rows[i][0] is not None]
            wanted.append(min(ids) if ids else None)
    assert sorted(map(repr, (r["doc_id"] for r in with_words))) == sorted(map(repr, wanted))
    bare = {(r[0], r[1]) for r in rows if not shingle_set(r[1])}
    assert {(r["doc_id"], r["text"]) for r in kept if not shingle_set(r["text"])} == bare


def test_blocks_of_a_large_cluster_give_the_same(spark, monkeypatch):
    texts = [changed(BASE, n, n + 100) for n in range(40)]
    rows = [(n, t, "", "", 0, 0) for n, t in enumerate(texts)]
    _, linked, _ = links_by_force(rows)
    # The driver deals blocks; workers only take what they are given.
    monkeypatch.setattr(near_duplicates, "BLOCK_CLASSES", 8)
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert tuples(found, "doc_id", "class_id", "n_links") == sorted(
        ((n, 0, len(linked[n])) for n in range(40)), key=repr
    )


def test_nearly_equal_classes_do_not_hide_a_pair_at_the_threshold(spark):
    trees, depth = near_duplicates.TREES, near_duplicates.DEPTH
    random_ = np.random.default_rng(8)

    def sig():
        return random_.integers(0, 1 << 16, (trees, depth)).astype("<u2")

    rows = []
    for n in range(300):
        one = sig()
        other = one.copy()
        other[:2, 0] += 1  # 18 of 20 trees
        rows += [(f"a{n}", one), (f"b{n}", other)]
    one, other = sig(), sig()
    other[3, :5] = one[3, :5]
    rows += [("x", one), ("y", other)]
    assert near_duplicates.recall(0.8, 5) >= near_duplicates.TARGET_RECALL
    classes = spark.createDataFrame(
        [(k.encode(), s.tobytes()) for k, s in rows], "key binary, sig binary"
    )
    clusters = dict(tuples(near_duplicates.candidate_clusters(classes), "key", "cluster"))
    assert len(clusters) == 602 and clusters[b"x"] == clusters[b"y"] == b"x"


# -- repeated strings -----------------------------------------------------------


def removed_by_force(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    counts = collections.Counter(
        raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1)
    )
    flags = []
    for raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        flags.append(gone)
    return raws, flags


def test_remove_repeats(docs, rows):
    raws, flags = removed_by_force([r[1] for r in rows])
    expected = []
    for row, raw, gone in zip(rows, raws, flags):
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        digest = hashlib.sha256(kept).hexdigest()
        expected.append((row[0], len(raw), int(gone.sum()), spans, digest))
    found = suffix_dedup.remove_repeats(docs)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert tuples(found, *names) == sorted(expected, key=repr)


def test_without_repeats_keeps_characters_whole(spark, docs, rows):
    found = suffix_dedup.without_repeats(docs).collect()
    assert set(found[0].asDict()) == set(docs.columns)
    raws, flags = removed_by_force([r[1] for r in rows])
    expected = []
    for row, raw, gone in zip(rows, raws, flags):
        text, at = [], 0
        for c in row[1] or "":
            n = len(c.encode())
            if not gone[at : at + n].any():
                text.append(c)
            at += n
        if text or not row[1]:
            expected.append((row[0], None if row[1] is None else "".join(text)))
    assert sorted(((r["doc_id"], r["text"]) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in found if r["text"] and r["n_chars"] is not None)


def test_stage_takes_out_a_passage_of_51_short_words(spark):
    passage = " ".join("abcdefghij"[n % 10] + "klmno"[n // 11] * (n % 2) for n in range(51))
    line = " ".join(f"w{n}" for n in range(49))  # fewer words: stays
    one_word = "q" * 420
    rows = []
    for n in range(3):
        own = [prose(200 + 10 * n + k, 60) for k in range(4)]
        text = f"{own[0]} | {passage} | {own[1]} | {line} | {own[2]} | {one_word} | {own[3]}"
        rows.append((n, text, "", "", len(text), 0))
    assert len(passage) < 130
    found = suffix_dedup.stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert len(found) == 3
    for r in found:
        assert passage not in r["text"] and "b" + "k" not in r["text"].split()
        assert line in r["text"] and "qqq" not in r["text"]
        assert all(prose(200 + 10 * r["doc_id"] + k, 60)[9:-9] in r["text"] for k in range(4))
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("length, anchor", [(100, 32), (150, 96)])
def test_remove_repeats_of_other_lengths(docs, rows, length, anchor):
    _, flags = removed_by_force([r[1] for r in rows], length)
    found = suffix_dedup.remove_repeats(docs, length, anchor)
    expected = [(r[0], int(gone.sum())) for r, gone in zip(rows, flags)]
    assert tuples(found, "doc_id", "n_removed") == sorted(expected, key=repr)


def test_groups_of_a_hot_anchor_are_divided(spark, monkeypatch):
    passage = prose(400, 120)
    texts = [f"{prose(410 + n, 50 + n)} {passage} {prose(450 + n, 40)}" for n in range(24)]
    texts += [f"{prose(480 + n, 60)} {passage[n:]}" for n in range(0, 60, 7)] + ["ha " * 700, "ha " * 501]
    rows = [(n, t, "", "", 0, 0) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 3000)
    calls, divide = [], suffix_dedup.divided

    def kept(*args):
        calls.append(divide(*args))
        return calls[-1]

    monkeypatch.setattr(suffix_dedup, "divided", kept)
    found = suffix_dedup.remove_repeats(docs)
    _, flags = removed_by_force(texts)
    expected = sorted(((n, int(g.sum())) for n, g in enumerate(flags)), key=repr)
    assert tuples(found, "doc_id", "n_removed") == expected
    (_, bounded), = calls
    for frame in bounded:
        sizes = collections.Counter()
        for r in frame.collect():
            sizes[r["key"]] += len(r["content"])
        assert all(n <= 3000 for n in sizes.values())
    assert len(bounded) > 1


# -- benchmark ------------------------------------------------------------------


def test_leaks(spark, docs, rows):
    items = [(1, ITEM), (1, ITEM), (2, prose(77, 40)), (3, "an er ti"), (4, None), (5, "one two three four five six")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = tuples(
        decontamination.leaks(docs, benchmark), "doc_id", "item_id", "start_word", "end_word", "matched"
    )
    last = rows[25][0]
    expected = [(17, "1", 40, 70, 30), (rows[18][0], "1", 40, 70, 28), (last, "5", 6, 12, 6)]
    assert found == sorted(expected, key=repr)


def test_leaks_of_short_items_with_replaced_words(spark):
    short, long = prose(301, 9), prose(302, 13)
    texts = [changed(short, 4), changed(long, 3, 8), changed(long, 2, 5, 9), changed(long, 2, 5, 8, 11)]
    rows = [(n, f"{prose(310 + n, 30)} {t} {prose(320 + n, 30)}") for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, short), (2, long)], "item_id int, text string")
    found = decontamination.leaks(docs, benchmark)
    expected = [(0, "1", 30, 39, 8), (1, "2", 30, 43, 11), (2, "2", 30, 43, 10)]
    assert tuples(found, "doc_id", "item_id", "start_word", "end_word", "matched") == expected


# -- tokens ---------------------------------------------------------------------


def test_packing_is_whole(docs, rows):
    encoder = packing.word_end_encoder
    library = encoder().library
    found = packing.pack(docs, encoder, capacity=256, shard_documents=7).collect()
    expected = []
    for row in rows:
        ids = [*library.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at : at + 256], "<u4")
            expected.append((row[0], k, at, part.size, zlib.crc32(part.tobytes())))
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[c] for c in names) for r in found), key=repr) == sorted(expected, key=repr)
    by_sequence = collections.defaultdict(list)
    for r in found:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 256


@pytest.mark.parametrize("chunk_chars, overlap", [(32_768, 256), (500, 16), (64, 4)])
def test_token_counts(docs, rows, chunk_chars, overlap):
    encoder = token_counts.byte_level_encoder
    library = encoder().library
    expected = []
    for row in rows:
        text = row[1] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        expected.append((row[0], len(text.encode()), n, n > 512))
    found = token_counts.count_tokens(docs, encoder, chunk_chars=chunk_chars, overlap=overlap)
    assert tuples(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


# -- labels and rules -----------------------------------------------------------


def test_licenses(docs, rows):
    phrases = [(p.split(), label) for p, label in license_scan.BASE_PHRASES]
    expected = []
    for row in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), row[1] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for p, label in phrases for i in range(len(words)) if words[i : i + len(p)] == p]
        starts = [i for i, _ in places]
        expected.append(
            (row[0], len(words), len(places), min(starts, default=None), max(starts, default=None),
             ",".join(sorted({x for _, x in places})))
        )
    found = license_scan.scan_licenses(docs)
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert tuples(found, *names) == sorted(expected, key=repr)


def test_notice_with_a_word_left_out(spark):
    notice = license_scan.NOTICES[0][0].replace("hereby ", "").replace(" restriction", " limits")
    rows = [(1, f"before it: {notice}. after"), (2, "permission is hereby granted"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = tuples(license_scan.scan_licenses(docs), "doc_id", "labels", "n_base")
    assert found == [(1, "mit", 0), (2, "", 0), (3, "", 0)]
    assert "Python" not in license_scan.scan_licenses(docs)._jdf.queryExecution().toString()


def test_base_counts(docs, rows):
    found = quality_rules.judge_quality(docs).collect()
    assert len(found) == len(rows)
    text = TEXTS[25]
    (made,) = [r for r in found if r["doc_id"] == 25]
    assert (made["n_words"], made["n_symbols"], made["n_dup_lines"]) == (27, 3, 1)
    assert made["n_repeat_words"] == 27 and made["base_failed"] and not made["kept"]
    assert made["word_chars"] == sum(map(len, text.split()))
    assert all(r["base_failed"] for r in found if r["n_words"] < 10)


def test_bands_keep_the_usual_and_reject_the_odd(spark):
    rows = [(n, prose(100 + n, 200), "xx") for n in range(60)]
    rows += [(100, "zq@@ " * 30 + "qz~" * 300 + " 1 2 3 4 5 6 7 8 9 10 11 12", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge_quality(docs).collect()}
    assert not kept.pop(100) and all(kept.values())


def test_languages(spark, docs, rows):
    content = language_id.learn(docs)
    assert set(content) == {"en"}
    found = language_id.identify(docs, content).collect()
    assert len(found) == len(rows) and set(docs.columns) < set(found[0].asDict())
    for r in found:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] == ("en" if has_letter else "und")
        assert 0 <= r["lang_score"] <= 1
    assert language_id.identify(docs, {}).where("lang_pred <> 'und'").isEmpty()


def test_toxicity(spark, docs, rows):
    labels = spark.createDataFrame(
        [(n, 1, n % 2) for n in range(30)] + [(None, 1, 1), (3, 1, None), (5, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    machine = toxicity.learn(docs, labels, sample_rows=20)
    found = toxicity.score_toxicity(docs, machine).collect()
    assert len(found) == len(rows) and all(0 <= r["toxicity"] <= 1 for r in found)


def test_urls(spark):
    urls = [
        None, "", "nothing", "://", "http://", "http://ORG/", "https://a.org", "https://a.org/x?y#z",
        "http://example.org/es/1", "http://b.EXAMPLE.org/en/15", "http://example.org/en/2", "x://k.com/fr/",
        "http://com/de/9", "http://badexample.org.com/de", "http://m.casino-win.example.net?q",
        "http://ÄB.example.org/en/1", "http://a.org/\nb://c.com/de/",
    ]
    rows = [(n, u) for n, u in enumerate(urls)] + [(None, urls[8]), (8, urls[8])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    by_verdict = {
        v: url_filter.keys_frame(spark, [k for k, x in url_filter.RULES if x == v]) for v in ("allow", "block")
    }
    sites = url_filter.keys_frame(spark, url_filter.BLOCKED_SITES)
    found = url_filter.judge_urls(pages, by_verdict["allow"], by_verdict["block"], sites)

    def force(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = []
        for key, verdict in url_filter.RULES:
            h, p = url_filter.split_key(key)
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((len(key), key, verdict))
        bad = any(host == s or host.endswith("." + s) for s in url_filter.BLOCKED_SITES)
        _, key, verdict = max(fits, default=(0, None, "block" if bad else "allow"))
        return host, path, key, verdict

    names = ("page_id", "host", "path", "rule", "verdict")
    assert tuples(found, *names) == sorted(((i, *force(u)) for i, u in rows), key=repr)


def test_cascade_is_exact(spark):
    hosts = [(f"h{n}.t{n % 50}.com", f"/p{n}") for n in range(4000)]
    urls = spark.createDataFrame(hosts, "host string, path string")
    listed = [f"{h}{p}" for h, p in hosts[:900]] + ["never.seen/x"]
    lengths = sorted({len(p) for _, p in hosts})
    cascade = url_filter.build_cascade(url_filter.keys_frame(spark, listed), urls, lengths)
    assert len(cascade.levels) > 1
    keys = sorted({k for h, p in hosts for k in url_filter.matching_keys(h, p, lengths)})
    assert cascade.contains(keys).tolist() == [k in set(listed) for k in keys]


# -- empty tables ---------------------------------------------------------------


@pytest.mark.parametrize(
    "operator",
    [
        near_duplicates.near_duplicates,
        near_duplicates.one_of_each,
        suffix_dedup.remove_repeats,
        suffix_dedup.without_repeats,
        quality_rules.judge_quality,
        license_scan.scan_licenses,
        lambda d: packing.pack(d, packing.word_end_encoder),
        lambda d: token_counts.count_tokens(d, token_counts.byte_level_encoder),
        lambda d: language_id.identify(d, language_id.learn(d)),
        lambda d: toxicity.score_toxicity(d, toxicity.learn(d, d.selectExpr("doc_id", "0 AS toxic"))),
        lambda d: decontamination.leaks(d, d.selectExpr("doc_id AS item_id", "text")),
    ],
)
def test_empty(empty, operator):
    assert operator(empty).count() == 0


def test_benchmark_without_items(docs, empty):
    none = empty.selectExpr("doc_id AS item_id", "text")
    assert decontamination.leaks(docs, none).count() == 0


# -- columns and ids ------------------------------------------------------------

NAMES = "_id id _h1 h1 h2 f1 f2 r1 r2 repeats may stripped judged _judged lang_rejected no_id first".split()


@pytest.mark.parametrize(
    "stage", [near_duplicates.stage, suffix_dedup.stage, decontamination.stage, language_id.stage]
)
def test_stages_keep_columns_of_any_name(spark, docs, tmp_path, stage):
    own = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("lang").cast("string"))
    wide = docs.withColumns({name: F.concat(F.lit(name), own) for name in NAMES})
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id int, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    wide = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = stage(spark, wide, str(tmp_path))
    assert kept.columns == wide.columns
    changed_ = " OR ".join(f"`{name}` <> concat('{name}', own)" for name in NAMES)
    assert not kept.isEmpty() and kept.withColumn("own", own).where(changed_).isEmpty()


@pytest.mark.parametrize(
    "operator",
    [
        near_duplicates.near_duplicates,
        near_duplicates.one_of_each,
        suffix_dedup.remove_repeats,
        lambda d: decontamination.leaks(d, d.limit(1).selectExpr("'a' AS item_id", f"'{ITEM}' AS text")),
    ],
)
def test_ids_may_be_text(docs, operator):
    named = docs.withColumn("doc_id", F.concat(F.lit("id-"), F.lpad("doc_id", 2, "0")))
    ids = {r["doc_id"] for r in operator(named).collect()}
    plain = {r["doc_id"] for r in operator(docs).collect()}
    assert "id-17" in ids and ids == {n if n is None else f"id-{n:02}" for n in plain}


def test_long_texts_go_to_workers_in_small_batches(spark):
    """A batch is bounded in bytes; a session's own setting stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert common.BATCH_BYTES <= 4 << 20
    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(frames):
        for frame in frames:
            yield pd.DataFrame({"bytes": [int(frame["text"].str.len().sum())]})

    before = spark.conf.get(setting, None)
    try:
        spark.conf.unset(setting)
        found = common.stored(texts.mapInPandas(sizes, "bytes long"), "batches").collect()
        assert sum(r.bytes for r in found) == 20_000_000
        assert max(r.bytes for r in found) <= 2 * common.BATCH_BYTES
        spark.conf.set(setting, "1000000")
        common.bounded_batches(spark)
        assert spark.conf.get(setting) == "1000000"
    finally:
        spark.conf.set(setting, before or str(common.BATCH_BYTES))

def test_a_filter_of_single_hashes_takes_one_python_step(spark, monkeypatch):
    """Chained Python steps hold two workers for each task; the filter is the same."""
    keys = np.random.default_rng(3).integers(-(2**63), 2**63, 500, dtype=np.int64)
    df = spark.createDataFrame([(int(k),) for k in keys], "anchor long")
    steps, plain = [], type(df).mapInPandas

    def counted(self, *args, **kwargs):
        steps.append(args[1])
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(type(df), "mapInPandas", counted)
    bits = common.bits_for(keys.size, 0.01)
    words = common.bloom_words(df, bits, 7, single="anchor")
    assert len(steps) == 1
    low, high = common.mixed_pair(keys.view("uint64"))
    assert common.passes(words, low, high, 7).all()
    at = np.unique(common.positions(low, high, bits, 7))
    assert int(np.bitwise_count(words).sum()) == at.size
