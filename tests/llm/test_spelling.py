"""Spelling variants against comparing all pairs."""

import collections
import itertools
import random
import re
import zlib

import pytest

from marlstone.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, m long, left string"


def counted(rows):
    found = collections.Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(n):
    near = collections.defaultdict(list)
    by = collections.defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    for size, words in by.items():
        for a, b in itertools.chain(
            itertools.combinations(words, 2), itertools.product(words, by.get(size + 1, []))
        ):
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def test_op11_on_odd_rows(spark, tmp_path):
    text = "Spelling spelling SPELLING " * 3 + "speling spellings " + "çàéèêë ÇÀÉÈÊË short abcde"
    rows = [(i, text, "x", 1, "y") for i in range(150)]
    rows += [(None, "speling spelling", "", 0, "")] * 6 + [(1, None, "", 0, ""), (2, "", "", 0, "")]
    rows += [(9, "word" * 800 + " 1 " + "word" * 800 + "s", "", 0, "")] * 5
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(S.op11_spelling_variants(spark, str(tmp_path)))
    want = sorted(expected(counted(rows)), key=repr)
    assert got == want
    assert any(r[1] for r in got) and len({r[0] for r in got}) > 5


def test_no_words(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert S.op11_spelling_variants(spark, str(tmp_path)).count() == 0


def test_whole_table_as_registered(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r.values()) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = rows_of(S.op11_spelling_variants(spark, sf))
    assert got == sorted(expected(counted(rows)), key=repr)


@pytest.mark.parametrize("group_words", [3, 20_000])
def test_dense_vocabulary(spark, group_words):
    """Many words with a common half, chains of forms, and runs of one letter."""
    dice = random.Random(3)
    words = {"stem" + "".join(dice.choices("abc", k=dice.randint(2, 5))) for _ in range(250)}
    words |= {"a" * k for k in range(6, 12)} | {"aaaaba", "abaaaa", "ababab", "bababa", "aababab"}
    n = {w: 5 ** dice.randint(1, 7) for w in sorted(words)}
    frame = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = rows_of(S.spelling_variants(frame, group_words))
    assert got == sorted(expected(n), key=repr)
    assert max(len(list(chain(n, r[0], got))) for r in got) > 2
    if group_words == 3:
        most = S.partitions(frame, 3).where("hi - lo > 2").groupBy(*S.PLACE).count()
        assert most.where("count > 3").count() == 0


def chain(n, word, rows):
    form = {r[0]: r[1] for r in rows}
    while word:
        yield word
        word = form[word]


def test_piecewise_reading(monkeypatch):
    text = "abcdefg hijklmnop " * 40
    whole = [w for runs in S._runs(text) for w in runs]
    monkeypatch.setattr(S, "PIECE_CHARS", 7)
    assert [w for runs in S._runs(text) for w in runs] == whole == text.split()


def test_acceptor_is_minimal():
    words = sorted({a + m + z for a in "abc" for m in ("x", "xy") for z in ("end", "ing")})
    states, first = S.acceptor(words)

    def language(p):
        final, arcs = states[p]
        return frozenset(([""] if final else []) + [c + r for c, q in arcs.items() for r in language(q)])

    languages = [language(p) for p in range(len(states))]
    assert language(first) == set(words) and len(set(languages)) == len(languages)
