import itertools
import random
import zlib

import numpy as np
import pytest

from chronoset.llm import catalog, crf, toxicity

SF = "/root/testdata/sf0.1"


def test_marginals_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes = rng.integers(1, 8, rng.integers(1, 5))
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        u, moves, begin = rng.normal(0, 2, sizes.sum()), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
        node, edge = crf.forward_backward(u, first, moves, begin)
        want_node, want_edge = [], []
        for k, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True):
            total, one, two = 0.0, np.zeros(n), np.zeros((n, 2, 2))
            for tags in itertools.product((0, 1), repeat=int(n)):
                w = np.exp(begin[tags[0]] + sum(u[k + i] * t for i, t in enumerate(tags)) + sum(moves[a, b] for a, b in itertools.pairwise(tags)))
                total += w
                one += w * np.array(tags)
                for i, (a, b) in enumerate(itertools.pairwise(tags)):
                    two[i + 1, a, b] += w
            want_node += list(one / total)
            want_edge += list(two[1:] / total)
        assert np.allclose(node, want_node)
        assert np.allclose(edge, np.array(want_edge).reshape(-1, 2, 2).transpose(1, 2, 0))


def test_descent_follows_the_gradient_of_the_likelihood():
    """The pulls of one round against finite differences of the log likelihood by enumeration."""
    rng = np.random.default_rng(1)
    first = np.array([0, 0, 0, 3, 3])
    types, tags = np.array([0, 1, 2, 1, 0]), np.array([0, 1, 1, 0, 0])
    table = np.array([[0, 1, 2, 6, 9], [3, 1, 2, 7, 10], [4, 5, 2, 8, 11]])
    tagger = crf.Tagger(12)
    tagger.weights, tagger.moves, tagger.begin = rng.normal(0, 1, 12), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)

    def loss(weights, moves):
        t = crf.Tagger(12)
        t.weights, t.moves, t.begin = weights, moves, tagger.begin
        u = t.unary(table, types, first)
        out = 0.0
        for k, n in ((0, 3), (3, 2)):
            score = lambda y: t.begin[y[0]] + sum(u[k + i] * v for i, v in enumerate(y)) + sum(moves[a, b] for a, b in itertools.pairwise(y))  # noqa: E731, B023
            out += np.log(sum(np.exp(score(y)) for y in itertools.product((0, 1), repeat=n))) - score(tuple(tags[k : k + n]))
        return out / 5

    before, moves = tagger.weights.copy(), tagger.moves.copy()
    tagger.fit(table, types, first, tags, np.ones(5), rounds=1, rate=1e-4, decay=0)
    # the first step of this descent is the sign of the gradient, times the rate
    for k in range(12):
        e = np.zeros(12)
        e[k] = 1e-5
        g = (loss(before + e, moves) - loss(before - e, moves)) / 2e-5
        assert abs(g) < 1e-6 or np.sign(before[k] - tagger.weights[k]) == np.sign(g)
    for a, b in itertools.product((0, 1), repeat=2):
        e = np.zeros((2, 2))
        e[a, b] = 1e-5
        g = (loss(before, moves + e) - loss(before, moves - e)) / 2e-5
        assert abs(g) < 1e-6 or np.sign(moves[a, b] - tagger.moves[a, b]) == np.sign(g)


def _corpus(n, seed=4):
    rnd = random.Random(seed)
    plain, bad = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)], ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) + ("." if rnd.random() < 0.1 else "") for _ in range(rnd.randint(20, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad) + rnd.choice(["", ",", "!!"]))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def planted(make):
    rows, labels = _corpus(600)
    return make(rows, labels=labels), rows, {i: t for i, _, t in labels}


def test_planted_words_decide_and_are_the_spans(spark, planted):
    path, rows, toxic = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.fitted(docs, spark.read.parquet(f"{path}/labels.parquet"))
    got = toxicity.scored(docs, model).collect()
    assert len(got) == len(rows)
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in got) >= 0.99 * len(rows)
    for r in got:
        said = [r["text"][s["start"] : s["end"]] for s in r["spans"]]
        assert all(w.strip(",!. ") in ("vile", "nasty", "awful") or " " in w for w in said)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_labels_of_held_out_rows_teach_nothing(spark, make, planted):
    _, rows, toxic = planted
    out = {i for i in toxic if zlib.crc32(str(i).encode()) % 4 == 2}
    turned = make(rows, labels=[(i, 1, 1 - t if i in out else t) for i, t in toxic.items()])
    query = catalog.QUERIES["op11_toxicity"]
    one, two = (sorted(tuple(r) for r in query(spark, p).collect()) for p in (planted[0], turned))
    assert one == two
    assert {r[0] for r in one if r[1]} == out


def test_held_out_documents_of_the_given_table(spark):
    toxic = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    got = [r for r in catalog.QUERIES["op11_toxicity"](spark, SF).collect() if r["held_out"] and r["doc_id"] in toxic]
    hit = sum(r["predicted"] and toxic[r["doc_id"]] for r in got)
    assert hit >= 0.9 * sum(toxic[r["doc_id"]] for r in got)
    assert sum(r["predicted"] and not toxic[r["doc_id"]] for r in got) <= 0.03 * len(got)


def test_odd_rows_and_nothing_to_learn_from(spark, make, odd, empty):
    query = catalog.QUERIES["op11_toxicity"]
    n = spark.read.parquet(f"{odd}/documents.parquet").count()
    got = query(spark, odd).collect()
    assert len(got) == n and {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert query(spark, empty).count() == 0
    rows, labels = _corpus(300, 9)
    extra = [(None, None, None, None, None), (1000, "", "en", "s", 0), (1001, "vile " * 30000, "en", "s", 0), (1002, None, "en", "s", 0)]
    got = {r["doc_id"]: r for r in query(spark, make([*rows, *extra], labels=[*labels, (None, 1, 1), (5, 0, None), (7777, 1, 1)])).collect()}
    assert got[1001]["predicted"] == 1 and got[1000]["predicted"] == got[1002]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_columns_of_the_input_stay(spark):
    df = spark.createDataFrame([(1, "a b", "kept", 7)], "id long, body string, extra string, score int")
    r = toxicity.scored(df, toxicity.Model(None, None), "body").collect()[0]
    assert (r["extra"], r["score"], r["spans"]) == ("kept", 0.0, [])
