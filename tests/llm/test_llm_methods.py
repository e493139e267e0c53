"""The methods below the operators, without Spark."""

import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest

from marlstone.llm import (
    decontamination,
    induced_sorting,
    language_id,
    near_duplicates,
    packing,
    quality_rules,
    suffix_dedup,
    toxicity,
    url_filter,
    word_cache,
)
from marlstone.llm.decontamination import overlap
from marlstone.llm.shingles import WordHashes, shingles


def sorted_suffixes(text, cap):
    text = list(text)
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < cap and text[a + n : a + n + 1] == text[b + n : b + n + 1] != []:
            n += 1
        shared.append(n)
    return order, shared


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_induced_sorting(monkeypatch, block):
    monkeypatch.setattr(induced_sorting, "BLOCK", block)
    monkeypatch.setattr(induced_sorting, "LEAST_BLOCK", min(block, 128))
    monkeypatch.setattr(induced_sorting, "RESIDENT_ENTRIES", 16)  # runs go to files
    random_ = np.random.default_rng(block)
    for trial in range(150):
        n, letters = int(random_.integers(1, 150)), int(random_.integers(1, 6))
        body = random_.integers(1, letters + 1, n)
        if trial % 3 == 0:
            body = np.tile(body[: int(random_.integers(1, 8))], 40)[:n]
        text = np.r_[body, 0].astype(np.int64)
        with induced_sorting.Scratch() as scratch:
            order, shared = induced_sorting.suffixes(
                text, int(text.max()) + 1, 7, scratch
            )
        assert (list(order), list(shared)) == sorted_suffixes(text, 7)


def test_blocks_hold_what_they_receive(monkeypatch):
    takes, head = [], induced_sorting.Queue.head

    def counted(self, block):
        takes.append(block)
        return head(self, block)

    monkeypatch.setattr(induced_sorting.Queue, "head", counted)
    random_ = np.random.default_rng(5)
    phrase = random_.integers(1, 200, 37)
    text = np.r_[random_.integers(1, 200, 9000), np.tile(phrase, 120), [7] * 2000, 0]
    with induced_sorting.Scratch() as scratch:
        order = induced_sorting.suffix_order(text.astype(np.int64), 200, scratch)
    text = text.tolist()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert len(takes) < 60  # not one for each link of a run or name


def test_repeated_windows():
    random_ = random.Random(3)
    shared = random_.randbytes(900)
    contents = [shared[100:700], random_.randbytes(500), shared[250:900], b"x" * 405]
    seen = {}
    for k, content in enumerate(contents):
        for i in range(len(content) - suffix_dedup.LENGTH + 1):
            seen.setdefault(content[i : i + suffix_dedup.LENGTH], []).append((k, i))
    expected = {at for places in seen.values() if len(places) > 1 for at in places}
    found = {
        (k, int(i))
        for k, flags in enumerate(suffix_dedup.repeated_in(contents))
        for i in np.nonzero(flags)[0]
    }
    assert found == expected


def test_fragments_cover_each_window_once_and_follow_content():
    random_ = np.random.default_rng(5)
    part = random_.integers(0, 256, 3000).astype(np.uint8)
    texts = [part, np.r_[random_.integers(0, 256, 777).astype(np.uint8), part]]
    names = []
    for text in texts:
        ((first, count, anchor),) = suffix_dedup.Fragments().of(text)
        assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all()
        assert first[-1] + count[-1] == text.size - suffix_dedup.LENGTH + 1
        names.append(set(anchor.tolist()))
    assert names[0] <= names[1]


def test_sum_of_squares_rule():
    gaps = packing.Gaps(10)
    assert gaps.place(6) == (0, 0)
    # Another gap of 4 would cost 2 ** 2; filling the one there costs nothing.
    assert gaps.place(4) == (0, 6)
    assert gaps.place(7) == (1, 0)
    # A gap of 3 exists once, so a second sequence with it is worse than a gap of 1.
    assert gaps.place(2) == (1, 7)


def test_packing_is_close_to_the_bound():
    random_ = np.random.default_rng(1)
    sizes = np.minimum(random_.lognormal(6, 1, 4000).astype(int) + 1, 4096)
    sequence, offset = packing.placed(sizes, 4096)
    for k in np.unique(sequence):
        own = np.argsort(offset[sequence == k])
        n, at = sizes[sequence == k][own], offset[sequence == k][own]
        assert (at == np.r_[0, np.cumsum(n)[:-1]]).all() and n.sum() <= 4096
    assert len(np.unique(sequence)) <= 1.01 * np.ceil(sizes.sum() / 4096) + 1


def test_kneser_ney_sums_to_one():
    texts = ["the cat sat on the mat", "the dog sat on a log", "cats and dogs", "é" * 9]
    grams = np.concatenate([quality_rules.grams_of(t) for t in texts])
    model = quality_rules.estimate(*np.unique(grams, return_counts=True))
    contexts = [int(grams[3]) >> 6, int(grams[12]) >> 6, 0x3FFFF, 12345]
    for context in contexts:
        every = np.arange(64, dtype=np.uint32) | np.uint32(context << 6)
        assert np.exp(model.log_probability(every)).sum() == pytest.approx(1)


def test_repeated_words():
    def slow(words):
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        return len(
            {
                i + k
                for i, w in enumerate(windows)
                if windows.count(w) > 1
                for k in range(5)
            }
        )

    random_ = random.Random(2)
    for _ in range(200):
        words = [random_.choice("abc") for _ in range(random_.randrange(60))]
        assert quality_rules.repeated_words(words) == slow(words)


def test_machine_learns_a_pair_that_is_worse_than_its_parts():
    random_ = random.Random(4)
    terms, rows, labels = toxicity.Terms(), [], []
    for _ in range(4000):
        words = [f"w{random_.randrange(40)}" for _ in range(8)]
        insult, group = random_.random() < 0.5, random_.random() < 0.5
        words += ["fools"] * insult + ["martians"] * group
        rows.append(terms.of_text(" ".join(words)))
        labels.append(int(insult and group))
    made = toxicity.fit(rows, np.array(labels))
    usual = " ".join(f"w{n}" for n in range(3, 11))
    score = lambda text: made.score(terms.of_text(f"{usual} {text}"))
    assert score("fools martians") > 0.7
    assert score("fools") < 0.5 and score("martians") < 0.5 and score("") < 0.5


def test_machine_without_labels():
    made = toxicity.fit([], np.array([]))
    assert 0 <= made.score(toxicity.Terms().of_text("anything")) <= 1


def test_compression_tells_languages_and_rejects_ties():
    content = {
        "aa": b"lorem ipsum dolor sit amet consectetur adipiscing elit " * 20,
        "bb": b"zwei kleine woerter stehen hier neben anderen woertern " * 20,
    }
    judge = language_id.Compressors(content).judge
    assert judge("dolor ipsum amet lorem")[0] == "aa"
    assert judge("neben kleine hier")[0] == "bb"
    assert judge("12 $$ ...") == ("und", 0.0, True)
    assert judge(None) == ("und", 0.0, True)
    assert judge("qqq")[2]


def test_depth_gets_shorter_with_the_similarity():
    depth = near_duplicates.sufficient_depth
    assert depth({20: 1000}) == near_duplicates.DEPTH
    assert depth({}) == depth({2: 1000}) < near_duplicates.DEPTH
    least = near_duplicates.THRESHOLD[0] / near_duplicates.THRESHOLD[1]
    assert near_duplicates.recall(least, depth({})) >= near_duplicates.TARGET_RECALL


def test_overlap_bears_replaced_words():
    left = np.arange(100, dtype=np.uint64)
    right = np.arange(40, 70, dtype=np.uint64)
    right[[5, 12, 20]] = 999
    assert overlap(left, right, 40) == (40, 70, 27)
    assert overlap(left, right, 200) == (0, 0, 0)


def accepted(equal):
    """Whether copies of an item with these words left are leaks."""
    item = np.arange(1, len(equal) + 1, dtype=np.uint64)
    words = np.where(equal, item, item + np.uint64(1000))
    start, end, matched = overlap(words, item, 0)
    return decontamination.is_leak(matched, end - start, item.size)


def has_seed(equal):
    masks = [decontamination.MASKS[m] for m in decontamination.masks_of(len(equal))]
    return any(
        all(equal[at + x] for x in m) for m in masks for at in range(len(equal) - max(m))
    )


@pytest.mark.parametrize("n", range(5, 17))
def test_every_accepted_pattern_of_replaced_words_has_a_seed(n):
    found = 0
    for replaced in range(n // 4 + 3):
        for places in itertools.combinations(range(n), replaced):
            equal = [i not in places for i in range(n)]
            if accepted(equal):
                found += 1
                assert has_seed(equal), places
    assert found


def test_accepted_patterns_of_longer_items_have_seeds():
    random_ = random.Random(6)
    found = 0
    for _ in range(20_000):
        n = random_.randrange(17, 60)
        equal = [True] * n
        if random_.random() < 0.5:  # nearly every fourth word
            for i in range(random_.randrange(4), n, 4):
                equal[min(n - 1, max(0, i + random_.randrange(-1, 2)))] = False
        else:
            for i in random_.sample(range(n), n // 4):
                equal[i] = False
        if accepted(equal):
            found += 1
            assert has_seed(equal), equal
    assert found > 1000


def test_shingles():
    hashes = WordHashes()
    assert shingles(hashes.of(None), 5).size == shingles(hashes.of("..."), 5).size == 0
    assert shingles(hashes.of("One two"), 5).size == 1
    assert shingles(hashes.of("a b c d e f a b c d e"), 5).size == 6


def test_word_end_pieces_of_ordinary_characters_need_no_unicode_classes():
    """The pieces of the file's own pattern, by the faster module."""
    import regex

    own = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    assert isinstance(word_cache.WORD_END_PATTERN, re.Pattern)
    ordinary = [chr(c) for c in range(0x110000) if word_cache.ORDINARY.fullmatch(chr(c))]
    odd = ["'", "s", "re", "ve", "ll", "'d", "'T", "--", " ", "\n", "é", "²", "12"]
    texts = ["".join(ordinary), *(f"a{c}b{c}{c} {c}'s" for c in ordinary)]
    texts += ["".join(p) for p in itertools.product(odd, repeat=3)]
    for text in texts:
        for read in (text, text.lower()):
            assert word_cache.WORD_END_PATTERN.findall(read) == own.findall(read)


@pytest.mark.parametrize(
    "name, pattern, lowers",
    [
        ("word_bpe_49k.json", word_cache.WORD_END_PATTERN, True),
        ("byte_bpe_50k.json", word_cache.BYTE_LEVEL_PATTERN, False),
    ],
)
def test_word_cache_equals_the_library(monkeypatch, name, pattern, lowers):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(word_cache, "CACHED_PIECES", 7)
    encoder = word_cache.Encoder(public_tokenizers.path(name), pattern, lowers=lowers)
    texts = [
        None,
        "",
        "Don't stop, it's  12 345 o'clock\n\n\t end ",
        "É́ ﬁ Σας ½ ª º µ ß ÿ İ",
        "x\x1cy\x85z\xa0w",
        "a" * 300 + " b",
        "a <|endoftext|> b <|startoftext|>",
        "Ciónñ façade $$$ '' !'s",
    ]
    for text, ids in zip(texts, encoder.ids(texts)):
        library = encoder.library.encode(text or "", add_special_tokens=False)
        assert np.frombuffer(ids, "<u4").tolist() == library.ids


def test_matching_keys():
    keys = url_filter.matching_keys("a.example.org", "/es/x", [0, 1, 4])
    assert keys[0] == "a.example.org/es/" and keys[-1] == "org"
    assert "example.org/" in keys and len(keys) == 9
    assert url_filter.matching_keys("", "", [0, 1]) == []


def test_a_shard_is_sorted_in_bounded_parts_of_whole_keys(monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for key in range(12):
        core = rng.bytes(60)
        for k in range(int(rng.integers(1, 5))):
            content = rng.bytes(30) + core + rng.bytes(30)
            rows.append((key, 10 * key + k, 1 + k % 2, 0, key, content))
    columns = [*suffix_dedup.FRAGMENT_COLUMNS, "n", "first", "key", "content"]
    frame = pd.DataFrame(rows, columns=columns).sample(frac=1, random_state=1)
    whole = suffix_dedup._sort_shard(frame, 40)
    sizes, sort = [], suffix_dedup.repeated_in

    def kept(contents, length):
        sizes.append(sum(map(len, contents)))
        return sort(contents, length)

    monkeypatch.setattr(suffix_dedup, "repeated_in", kept)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 600)
    parts = suffix_dedup._sort_shard(frame, 40)
    assert len(whole) and len(sizes) > 3 and max(sizes) <= 600
    order = ["anchor", "name", "begin", "end"]
    assert sorted(whole[order].itertuples(index=False)) == sorted(
        parts[order].itertuples(index=False)
    )
