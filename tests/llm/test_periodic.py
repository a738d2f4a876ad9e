import hashlib
import random
import zlib

import numpy as np
import pytest

from chronoset.llm import catalog, periodic


def plain_runs(words):
    """Runs by the definition: every period, every maximal stretch, smallest period by trial."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n, s = j + q - i, words[i : j + q]
            if j > i and n >= max(6, 4 * q) and not any(s[r:] == s[: n - r] for r in range(1, q)):
                found.append((i, n, q))
            i = j + 1
    return sorted(found, key=lambda x: (x[0], x[2]))


def plain_planted(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def plain_row(doc_id, text):
    words = plain_planted(doc_id, text)
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def _texts(seed, count):
    rnd = random.Random(seed)
    for i in range(count):
        words = [rnd.choice("abcdefgh"[: rnd.choice([1, 2, 3, 8])]) for _ in range(rnd.randint(0, 90))]
        if rnd.random() < 0.7 and words:
            at, p = rnd.randrange(len(words)), rnd.randint(1, 19)
            words[at:at] = (words[at : at + p] * 12)[: rnd.randint(1, 100)]
        yield rnd.choice([" ", "\n", "\t "]).join(words)


@pytest.mark.parametrize("seed", range(5))
def test_runs_of_a_batch_are_those_of_each_text(seed):
    texts = list(_texts(seed, 60))
    runs, words, kept = periodic._indexed(texts)
    for text, r, k in zip(texts, runs, kept, strict=True):
        want = plain_runs(text.split())
        assert [(x["start"], x["length"], x["period"]) for x in r] == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert [w.decode() for w in k] == [w for i, w in enumerate(text.split()) if i not in gone]


def test_wavelet_tree_counts_and_selects():
    rng = np.random.default_rng(3)
    values = rng.permutation(200).astype(np.int32)
    tree = periodic.WaveletTree(values)
    left = rng.integers(0, 199, 300)
    right = left + 1 + rng.integers(0, 200 - left)
    x = rng.integers(0, 200, 300)
    k = rng.integers(0, right - left)
    assert tree.below(left, right, x).tolist() == [(values[a:b] < v).sum() for a, b, v in zip(left, right, x)]
    assert tree.nth(left, right, k).tolist() == [sorted(values[a:b])[c] for a, b, c in zip(left, right, k)]


def test_names_of_factors_follow_suffix_order():
    ids = np.array([0, 1, 0, 1, 0, 5, 0, 1, 6])
    names = periodic.factor_names(ids)
    place = sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
    assert [place.index(i) for i in range(len(ids))] == names[-1].tolist()
    assert names[1][0] == names[1][2] == names[1][6]


def test_long_repeats_and_one_word_texts():
    texts = ["x " * 5000, "a b c " * 3000 + "d " * 6, "one", "", None, "p q r s t " * 4]
    runs, _, kept = periodic._indexed(texts)
    assert [[tuple(x.values()) for x in r] for r in runs] == [[(0, 5000, 1)], [(0, 9000, 3), (9000, 6, 1)], [], [], [], [(0, 20, 5)]]
    assert [len(k) for k in kept] == [1, 4, 1, 0, 0, 5]


def test_query_on_odd_rows(spark, odd, empty):
    rows = [tuple(r) for r in catalog.QUERIES["op12_periodic_runs"](spark, odd).collect()]
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect()
    # the long text of one phrase is checked by its closed form above
    want = [plain_row(r["doc_id"], r["text"]) if len(r["text"] or "") < 10000 or " " not in r["text"] else None for r in docs]
    by_text = sorted((x for x in want if x), key=repr)
    got = sorted((x for x in rows if x[0] != 8), key=repr)
    assert got == by_text
    assert len(rows) == len(docs)
    assert catalog.QUERIES["op12_periodic_runs"](spark, empty).count() == 0


def test_query_against_plain_rows(spark, make):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*_texts(11, 400), *["lorem ipsum dolor " * 20] * 3])]
    got = {r["doc_id"]: tuple(r) for r in catalog.QUERIES["op12_periodic_runs"](spark, make(rows)).collect()}
    assert got == {r[0]: plain_row(r[0], r[1]) for r in rows}
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_given_table_against_plain_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in catalog.QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    small = [r for r in docs if len(r["text"] or "") < 12000]
    assert len(got) == len(docs) and len(small) > 150
    for r in small:
        assert got[r["doc_id"]] == plain_row(r["doc_id"], r["text"])


def test_columns_of_the_input_stay(spark):
    df = spark.createDataFrame([(1, "a a a a a a b", 7, "kept")], "id long, body string, runs int, extra string")
    r = periodic.collapsed(df, "body").collect()[0]
    assert (r["extra"], r["collapsed"], r["n_words"], len(r["runs"])) == ("kept", "a b", 7, 1)
