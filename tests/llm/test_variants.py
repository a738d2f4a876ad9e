import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import re

from chronoset.llm import catalog, variants


def plain_groups(docs):
    """The contract, word for word: counts, all pairs by wildcard and deletion, forms, chains."""
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({ord(a): ord(b) for a, b in zip(variants.UPPER, variants.LOWER, strict=True)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(((-n[x], x) for x in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(rows)


def plain_near(words):
    near, alike = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            alike[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in alike.values():
        for w in group:
            near[w] |= group - {w}
    return near


def got(spark, path):
    return sorted(tuple(r) for r in catalog.QUERIES["op13_spelling_variants"](spark, path).collect())


def test_given_table_against_plain_rows(spark):
    path = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    rows = got(spark, path)
    assert rows == plain_groups(docs)
    assert any(r[1] for r in rows) and any(r[2] not in (r[0], r[1]) for r in rows)


def test_sql_says_the_same(spark, sql, make, odd):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abéß") for _ in range(rnd.randint(6, 8))) for _ in range(80)]
    text = lambda: " ".join(rnd.choice(base) for _ in range(300))
    for path in (odd, make([(i, text(), "en", "s", 0) for i in range(40)])):
        want = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in sql(catalog.ORACLE["op13_spelling_variants"], path)]
        assert got(spark, path) == sorted(want)


@pytest.mark.parametrize("letters,size", [("ab", 7), ("abc", 6), ("aàb", 9)])
def test_all_near_pairs_of_words_full_of_ties(spark, letters, size):
    rnd = random.Random(letters)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(6, size))) for _ in range(400)}
    vocab = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n long")
    pairs = variants.near_pairs(vocab).collect()
    near = plain_near(words)
    assert sorted((r["a"], r["b"]) for r in pairs) == sorted((a, b) for a in near for b in near[a] if a < b)
    assert {(r["a_n"], r["b_n"]) for r in pairs} == {(5, 5)}


def test_pivots_are_the_cheapest_disjoint_pair_of_the_prefix():
    rnd = random.Random(2)
    for _ in range(300):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(6, 12)))
        places = defaultdict(lambda: rnd.randint(1, 9))
        prefix, last = variants.prefix_of(word, places)
        pivots = variants.pivots_of(word, prefix, places)
        cost = lambda ps: sum(places[word[p : p + 2]] for p in ps)
        choices = [(p, q) for p in prefix for q in prefix if q >= p + 2]
        assert tuple(pivots) in choices and cost(pivots) == min(map(cost, choices))
        assert len(prefix) >= 3 and all((places[word[p : p + 2]], word[p : p + 2]) <= last for p in prefix)


def test_chains_of_forms_are_followed_to_the_end(spark):
    chain = [("w%02d" % i, "w%02d" % (i + 1)) for i in range(23)] + [("x", "y"), ("a", "w05")]
    roots = dict(variants.rooted(spark.createDataFrame(chain, "word string, form string")).collect())
    assert roots == {**{w: "w23" for w, _ in chain}, "x": "y"}
    assert math.log(10**13, 5) < 23


def test_hot_word_ties_nulls_and_empty_tables(spark, make, empty):
    rows = [(1, "letters " * 20000 + "lettars " * 5, "en", "s", 0), (None, "letterz " * 7, None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0),
            (4, "ÀÉÎÕÜß Àéîõüß àéîõüß " * 6 + "Abcdef abcdef ABCDEF " * 2, "fr", "s", 0)]
    path = make([*rows, rows[4]])
    assert got(spark, path) == plain_groups([r[:2] for r in [*rows, rows[4]]])
    assert got(spark, empty) == []
