"""Operators against brute force, the library, exact round trips or held-out labels, on the smallest given table."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoset.llm import components, exact_dedup, language_id, licenses, line_dedup, minhash, mixing, pii, quality, sentencepieces, sharding
from chronoset.llm.catalog import QUERIES, piece_model
from chronoset.llm.common import documents

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_mix_is_near_its_targets(spark):
    rows = QUERIES["op1_mix_sources"](spark, SF01).collect()
    assert rows == sorted(rows, key=rows.index) and sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op1_mix_sources"](spark, SF01).collect()))
    source = dict(duckdb.sql(f"select doc_id, source from '{SF01}/documents.parquet'").fetchall())
    by = collections.defaultdict(list)
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by[source[r["doc_id"]]].append(r)
    total = sum(r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * total, rel=0.02)
    for own in by.values():
        (target,), (size,) = {r["target"] for r in own}, {r["source_size"] for r in own}
        assert size == sum(r["size"] for r in own) and target <= 2 * size
        # taken in the order of size, a source is off by about its largest document at most
        assert abs(sum(r["taken"] for r in own) - target) <= 1.5 * max(r["size"] for r in own)
    assert len(by) > 10


def test_targets_are_water_filled(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 500), ("d", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    weight = {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    caps = {"a": 200, "b": 2000, "c": 20, "d": 0, None: 1000}
    left, want = 1.5 * 1610, {}
    free = set(caps)
    while True:  # the excess reshared until none is above
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > caps[s]]
        if not over:
            want |= {s: weight[s] * level for s in free}
            break
        for s in over:
            want[s] = caps[s]
            left -= caps[s]
            free.remove(s)
    assert got == pytest.approx(want)


def test_mixed_rows_are_the_planned_copies(spark):
    docs = documents(spark, SF)
    n = collections.Counter(r["doc_id"] for r in mixing.mixed(docs).collect())
    plan = {r["doc_id"]: r["copies"] for r in mixing.planned(docs, mixing.word_count(docs["text"])).collect()}
    assert n == {k: v for k, v in plan.items() if v}


def test_line_dedup_equals_brute_force(spark, texts):
    occurrences = collections.defaultdict(list)
    for i, t in texts.items():
        _, s, e, _, _ = line_dedup.chunks([t])
        for x, y in zip(s.tolist(), e.tolist()):
            occurrences["\n".join(t.split("\n")[x:y])].append((i, x, y))
    gone = collections.defaultdict(set)
    for found in occurrences.values():
        for i, x, y in sorted(found)[1:]:
            gone[i].update(range(x, y))
    assert gone
    for r in QUERIES["op4_line_dedup"](spark, SF).collect():
        left = "\n".join(x for k, x in enumerate(texts[r["doc_id"]].split("\n")) if k not in gone[r["doc_id"]])
        assert r["removed"] == ",".join(map(str, sorted(gone[r["doc_id"]]))) and r["text_sha256"] == sha(left)


def test_chunk_cuts_follow_a_shifted_passage(make, spark):
    rnd = random.Random(1)
    line = lambda: " ".join(rnd.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=12))
    passage = [line() for _ in range(6)]
    rows = [(i, "\n".join([line() for _ in range(i)] + passage + [line()]), "en", "s", 1) for i in range(1, 8)]
    out = {r["doc_id"]: r for r in line_dedup.line_deduped(documents(spark, make(rows))).collect()}
    assert out[1]["removed"] == []
    assert sum(len(out[i]["removed"]) >= 5 for i in range(2, 8)) >= 5
    assert all(i <= k < i + 6 for i in range(2, 8) for k in out[i]["removed"])


def brute_measures(t):
    w = WORD.findall(t)
    at = collections.defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_lines_seen_before_are_removed_by_an_independent_finder(spark):
    """Pairs of neighbouring lines with ten words that stand anywhere before, found without chunks."""
    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()
    seen, want = set(), set()
    for i, t in rows:
        lines = (t or "").split("\n")
        for k, pair in enumerate(itertools.pairwise(lines)):
            if all(map(str.strip, pair)) and len(" ".join(pair).split()) >= 10:
                if pair in seen:
                    want |= {(i, k), (i, k + 1)}
                seen.add(pair)
        # the first two of a run of equal lines stay
        want -= {(i, k) for k in range(1, len(lines)) if lines[k] == lines[k - 1] and (k == 1 or lines[k - 2] != lines[k])}
    got = {(r["doc_id"], int(k)) for r in QUERIES["op4_line_dedup"](spark, sf).collect() for k in r["removed"].split(",") if k}
    assert len(want) > 5000 and len(want & got) >= 0.99 * len(want)
    # what is removed was there before: every removed line has an equal one that stays
    text = dict(rows)
    stay = {x for i, t in rows for k, x in enumerate((t or "").split("\n")) if (i, k) not in got}
    assert all(text[i].split("\n")[k] in stay for i, k in got)


def test_a_line_repeated_in_a_row_stays_twice(spark, make):
    line = "one two three four five six seven"
    rows = [(1, "\n".join(["head of it", *[line] * 7, "tail"]), "en", "s", 0), (2, "\n".join([line] * 4), "en", "s", 0)]
    got = {r["doc_id"]: r["removed"] for r in QUERIES["op4_line_dedup"](spark, make(rows)).collect()}
    assert got == {1: "3,4,5,6", 2: "0,1,2,3"}


def test_cuts_of_a_passage_do_not_depend_on_what_surrounds_it():
    rnd = random.Random(4)
    passage = [f"passage line {rnd.random()} with some more words in it" for _ in range(8)]
    spans = []
    for n in range(6):
        around = [[f"other {rnd.random()} words"] * 1 for _ in range(n)]
        text = "\n".join([x for a in around for x in a] + passage + ["end of it all"] * n)
        of, s, e, a, b = line_dedup.chunks([text])
        spans.append({(x - n, y - n) for x, y in zip(s, e, strict=True) if x >= n + 3 and y <= n + 5})
    assert all(x == spans[0] for x in spans)


def test_quality_measures_equal_brute_force(spark, texts):
    for r in QUERIES["op5_quality_rules"](spark, SF).collect():
        assert tuple(r)[1:6] == brute_measures(texts[r["doc_id"]])


def test_compression_bands():
    import base64
    import zstandard

    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    rnd = random.Random(2)
    prose = " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(4000)).encode()
    noise = rnd.randbytes(9000)
    assert quality.compression(prose, compress)[2] is None
    assert quality.compression(b"spam and eggs " * 700, compress)[2] == "repetitive"
    assert quality.compression(noise, compress)[2] == "incompressible"
    assert quality.compression(base64.b64encode(noise), compress)[0] < 1.4
    assert quality.compression(prose[:9000] + (b"x" * 4096) * 4, compress)[2] in ("chunks", "repetitive")


def test_encoded_text_is_incompressible():
    import base64
    import zstandard

    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    rnd = random.Random(10)
    for n in (128, 255, 300, 511, 700, 1023, 1500, 2047, 3000, 4095, 5000, 8191, 12000, 16383, 60000):
        plain = base64.b64encode(rnd.randbytes(n)).decode()
        for width, gap in ((76, "\n"), (20, " ")):
            data = gap.join(plain[k : k + width] for k in range(0, len(plain), width))[:n].encode()
            assert quality.compression(data, compress)[2] == "incompressible", (n, width)
    # the last chunk counts, by the band of its own length
    prose = " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(800)).encode()[:4096]
    last = base64.b64encode(rnd.randbytes(1500))
    assert quality.compression(prose + last, compress)[1] == len(last) / (4096 + len(last))


def _plain_verdicts(texts):
    """kept of every text by sorted lists: limits from distinct (length, ratio) of texts that pass the base rules."""
    import statistics
    import zstandard

    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    size = lambda b: len(b) / len(compress(b)) if b else None
    rows = {}
    for i, t in texts.items():
        data, m = (t or "").encode(), quality.base_measures(t)
        chunks = [c for k in range(0, len(data), 4096) if len(c := data[k : k + 4096]) >= 128]
        chunks = [(len(c), size(c)) for c in chunks] if len(chunks) > 1 else []
        rows[i] = (m[0] < 50 or 100 * m[4] > 50 * m[0], len(data), size(data), chunks)
    half = lambda n: math.floor(math.log2(n) * 2 + 1e-9)
    fixed = lambda n, k: [b[k] for b in quality.BANDS if b[0] <= n][-1]

    def limits(pairs):
        out = {}
        for band in {half(n) for n, _ in pairs if n >= 128}:
            steps = sorted(math.floor(r * 256) for n, r in {p for p in pairs if p[0] >= 128} if half(n) == band)
            if len(steps) >= 30:
                mid = steps[math.ceil(len(steps) / 2) - 1]
                away = sorted(abs(s - mid) for s in steps)[math.ceil(len(steps) / 2) - 1]
                out[band] = (mid + 4 * max(away, 0.02 * mid) + 1) / 256
        return out

    good = [r for r in rows.values() if not r[0]]
    whole, chunk = limits([(r[1], r[2]) for r in good]), limits([c for r in good for c in r[3]])
    assert statistics.mean(whole.values()) > 1
    bad = lambda n, r, own: n >= 128 and (r < fixed(n, 1) or r > min(own.get(half(n), 99), fixed(n, 2)))
    out = {}
    for i, (failed, n, r, chunks) in rows.items():
        share = sum(c for c, x in chunks if bad(c, x, chunk)) / sum(c for c, _ in chunks) if chunks else 0
        out[i] = not (failed or bad(n, r, whole) or share > 0.5)
    return out


def test_bands_of_the_corpus_decide_as_plain_lists_say(spark):
    sf = "/root/testdata/sf0.1"
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    got = {r["doc_id"]: r for r in QUERIES["op5_quality_rules"](spark, sf).collect()}
    assert {i: r["kept"] for i, r in got.items()} == _plain_verdicts(texts)
    # the bands find most of the junk that the base rules leave, and hardly any good text
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    left = [(q, got[i]["kept"]) for i, q in labels if not got[i]["base_failed"]]
    assert sum(not k for q, k in left if q == 0) >= 200
    assert sum(not k for q, k in left if q == 1) <= 0.01 * sum(q == 1 for q, _ in left)


def test_limits_ignore_copies_and_small_bands_keep_the_fixed_ones(spark, make):
    rnd = random.Random(3)
    prose = lambda n: " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(n))
    rows = [prose(330) for _ in range(60)]
    one = prose(330)
    path = make([(i, t, "en", "s", 0) for i, t in enumerate([*rows, *[one] * 200, prose(20000)])])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    measured = quality.measured(docs, keep_columns=False)
    limits = quality.corpus_limits(measured)
    alone = quality.corpus_limits(quality.measured(docs.where("doc_id <= 60"), keep_columns=False))
    assert limits.whole == alone.whole and len(limits.whole) >= 1
    assert quality.band_of(len(prose(20000))) not in limits.whole
    assert all(r["kept"] for r in quality.judged(docs).collect())
    assert [r["kept"] for r in quality.judged(docs, limits=quality.FIXED).collect()] == [True] * 261


def test_kept_prose_stays_in_its_band(texts):
    import zstandard

    compress = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    rows = [t for t in texts.values() if t and (m := quality.base_measures(t))[0] >= quality.MIN_WORDS and 100 * m[4] <= quality.MAX_REPEAT_PERCENT * m[0]]
    assert len(rows) > 50 and all(quality.compression(t.encode(), compress)[2] != "incompressible" for t in rows)


def test_near_groups_equal_brute_force(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall())
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, holders = {}, collections.defaultdict(list)
    for i, t in texts.items():
        w = WORD.findall(t.translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for s in sets[i]:
            holders[s].append(i)
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for v in holders.values():
        for b in v[1:]:
            for a in v:
                if a < b and root(a) != root(b) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    up[max(root(a), root(b))] = min(root(a), root(b))
    rows = QUERIES["op6_minhash_near_dedup"](spark, SF01).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def test_hidden_links_are_found(spark, make):
    """A chain of copies: ends are far from each other, every neighbour is near, and no star's centre is near all."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for step in range(24):
        rows.append((100 - step, " ".join(words), "en", "s", 1))
        for k in rnd.sample(range(400), 8):
            words[k] = f"x{step}-{k}"
    far = [(200 + i, " ".join(f"y{i}-{k}" if k % 3 == 0 else f"w{k}" for k in range(400)), "en", "s", 1) for i in range(6)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(documents(spark, make(rows + far))).collect()}
    assert {got[r[0]] for r in rows} == {77} and all(got[r[0]] == r[0] for r in far)


def edited(rnd, n, kept, of=400):
    return [" ".join(f"w{k}" if rnd.random() < kept else f"x{i}-{k}" for k in range(of)) for i in range(n)]


def seen_groups(monkeypatch):
    """Rows of the largest group that a task of the block comparison loads, as they are made."""
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin

    seen, apply = [], PandasGroupedOpsMixin.applyInArrow

    def spy(self, func, schema):
        key = [c for c in self._df.columns if c == "bucket" or "block" in c]
        seen.append(self._df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0)
        return apply(self, func, schema)

    for kind in (PandasGroupedOpsMixin, *PandasGroupedOpsMixin.__subclasses__()):
        monkeypatch.setattr(kind, "applyInArrow", spy)
    return seen


def test_groups_of_open_classes_are_bounded(spark, make, monkeypatch):
    """A hundred classes that share their shingles with others but are near none: without star rounds, blocks alone bound the groups."""
    seen = seen_groups(monkeypatch)
    monkeypatch.setattr(minhash, "BLOCK", 12)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 0, raising=False)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(edited(random.Random(8), 100, 0.95))]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(documents(spark, make(rows))).collect()}
    assert len(set(got.values())) == 100
    assert seen and 12 < max(seen) <= 24


def test_star_rounds_close_a_hot_group(spark, make, monkeypatch):
    """Copies near their base only, which has the largest id: the first star is a copy's, the next round finds the base."""
    seen = seen_groups(monkeypatch)
    monkeypatch.setattr(minhash, "BLOCK", 12)
    copies = edited(random.Random(9), 100, 0.974)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*copies, " ".join(f"w{k}" for k in range(400))])]
    sets = [set(minhash.shingle_sets([r[1]])[0].tolist()) for r in rows]
    near = [i for i in range(100) if 100 * len(sets[i] & sets[100]) >= 75 * len(sets[i] | sets[100])]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(documents(spark, make(rows))).collect()}
    assert len(near) > 60 and len({got[i] for i in [*near, 100]}) == 1
    assert seen and max(seen) <= 24


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 400)] + [(500, 500)] + [(rnd.randint(600, 700), rnd.randint(600, 700)) for _ in range(60)]
    rnd.shuffle(edges)
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: root(x) for x in linked}


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.loaded(piece_model())


def test_pieces_equal_the_library(spark, texts, pieces):
    for r in QUERIES["op7_sentencepieces"](spark, SF).collect():
        ids = pieces.lib.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(pieces.lib.decode(ids)))


def test_pieces_of_odd_texts_and_any_ids(pieces):
    rnd = random.Random(6)
    parts = [" ", "  ", "▁", "\n", "\t", "a", "the", "é", "日本", "😀", "\0", "<0x41>", "</s>", "ﬁ", "　", "1234", "----", "ing", "\r", "x" * 90]
    odd = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)]
    ids, decoded = pieces.encode_batch(odd)
    assert [x.tolist() for x in ids] == pieces.lib.encode(odd) and decoded == pieces.lib.decode(pieces.lib.encode(odd))
    for top in (300, 32000):
        for _ in range(2000):
            some = [rnd.randrange(top) for _ in range(rnd.randint(0, 8))]
            assert pieces.decode(some) == pieces.lib.decode(some)


def test_short_and_long_agendas_agree(pieces):
    rnd = random.Random(7)
    for _ in range(500):
        chunk = "▁" + "".join(rnd.choices("aeioutnsrhldé", k=rnd.randint(1, 120)))
        assert pieces.merged_short(chunk) == pieces.merged_long(chunk)


def test_whole_texts_can_be_checked_too(spark):
    assert sentencepieces.encoded(documents(spark, SF), piece_model(), check="texts").count() == 200


def test_shards_are_near_equal_and_slots_gapless(spark):
    rows = QUERIES["op8_kd_sharding"](spark, SF01).collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    mean = sum(size.values()) / 24
    assert sorted(size) == list(range(24)) and max(size.values()) < 1.1 * mean and min(size.values()) > 0.9 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_hot_value_is_split(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "'same' as source", "100L as size")
    got = collections.Counter(r["shard"] for r in sharding.kd_assigned(rows, ["source"], shards=5).collect())
    assert len(got) == 5 and max(got.values()) < 1.15 * 800


def brute_spans(t):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0
            if {"ip": lambda: all(int(x) < 256 for x in m[0].split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn, "phone": lambda: 8 <= len(digits) <= 15}.get(kind, lambda: True)():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_reliabilities_equal_a_plain_expectation_maximisation(spark):
    """Candidate by candidate, in probabilities; and planted reliabilities are found again."""
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    hits, false = np.linspace(0.95, 0.6, pii.LABELERS), np.linspace(0.05, 0.4, pii.LABELERS)
    votes = np.where(rng.random((4000, pii.LABELERS)) < np.where(truth[:, None], hits, false), 1, 0)
    votes[rng.random(votes.shape) < 0.2] = -1
    prior, yes, no = 0.3, np.full(pii.LABELERS, 0.8), np.full(pii.LABELERS, 0.2)
    for turn in range(pii.ROUNDS + 1):
        a = prior * np.prod(np.where(votes == 1, yes, np.where(votes == 0, 1 - yes, 1)), 1)
        b = (1 - prior) * np.prod(np.where(votes == 1, no, np.where(votes == 0, 1 - no, 1)), 1)
        p = a / (a + b)
        if turn == pii.ROUNDS:
            break
        said = votes >= 0
        prior = (p.sum() + 1) / (len(p) + 3)
        yes = ((p[:, None] * (votes == 1)).sum(0) + 2) / ((p[:, None] * said).sum(0) + 3)
        no = (((1 - p)[:, None] * (votes == 1)).sum(0) + 1) / (((1 - p)[:, None] * said).sum(0) + 3)
    counts = collections.Counter(map(tuple, votes.tolist()))
    df = spark.createDataFrame([("name", list(v), ["f"], n) for v, n in counts.items()], "kind string, votes array<int>, features array<string>, n long")
    scored, model = pii.reliabilities(df)
    want = {tuple(v): x for v, x in zip(votes.tolist(), p.tolist(), strict=True)}
    assert all(abs(r["p"] - want[tuple(r["votes"])]) < 1e-9 for r in scored.collect())
    m = model["name"]
    assert abs(m["prior"] - prior) < 1e-9 and np.allclose(m["yes"], yes) and np.allclose(m["no"], no)
    assert abs(prior - 0.4) < 0.03 and np.abs(yes - hits).max() < 0.05 and np.abs(no - false).max() < 0.05
    assert pii.reliabilities(df.limit(0))[0].count() == 0


def test_classifier_equals_plain_naive_bayes(spark):
    rows = [("name", ["a", "b"], 5, 0.9), ("name", ["a"], 7, 0.2), ("name", ["c", "b"], 2, 0.6), ("secret", ["a", "c"], 4, 0.5)]
    df = spark.createDataFrame(rows, "kind string, features array<string>, n long, p double")
    got = {(r["kind"], tuple(r["features"])): r["odds"] for r in df.withColumn("odds", pii.classifier(df)(F.struct("kind", "features"))).collect()}
    for kind, features, _, _ in rows:
        own = [r for r in rows if r[0] == kind]
        y, n = sum(r[2] * r[3] for r in own), sum(r[2] * (1 - r[3]) for r in own)
        odds = math.log((y + 0.5) / (n + 0.5))
        for f in features:
            fy, fn = sum(r[2] * r[3] for r in own if f in r[1]), sum(r[2] * (1 - r[3]) for r in own if f in r[1])
            odds += math.log((fy + 0.5) / (y + 1)) - math.log((fn + 0.5) / (n + 1))
        assert abs(got[kind, tuple(features)] - odds) < 1e-9


def test_personal_data_equals_brute_force(spark, make):
    rnd = random.Random(3)
    parts = ["a", "b.c", "@", "@x", "x.y", ".", "..", "-", "1", "12", "255", "256", "192.168.1.1", "4532015112830366", "4532 0151 1283 0366", " ", "+", "+1 (", "555", "é", "日😀", "(", ")", "\n", "a@b.c", "_d@e.f", "%", 'token = "a1b2c3d4e5f6a7b8c9d0e1f2"', "Dr. Peter Martin", "call 555-123-4567"]
    texts = {i: "".join(rnd.choices(parts, k=rnd.randint(0, 30))) for i in range(1500)}
    texts |= {2000: "1 " * 20000, 2001: "a@" + "b." * 900 + "c", 2002: "a" * 3000, 2003: "9" * 3000, 2004: "1." * 6000, 2005: "+1" + " 2" * 9000, 2006: "a@b.c " * 900}
    kinds = collections.Counter()
    for r in QUERIES["op9_personal_data"](spark, make([(i, t, "en", "s", len(t)) for i, t in texts.items()])).collect():
        base = brute_spans(texts[r["doc_id"]])
        spans = [x for x in r["spans"].split(",") if x]
        assert r["base_sha256"] == sha(",".join(base)) and spans[: len(base)] == base
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x.startswith(k) for x in base) for k in pii.BASE]
        assert r["n_spans"] == len(spans)
        kinds.update(x.split(":")[0] for x in spans[len(base) :])
    assert min(kinds[k] for k in pii.MORE) > 100


def test_masked_text(spark, make):
    docs = documents(spark, make([(1, "mail a@b.c or 10.0.0.1!", "en", "s", 1), (2, None, "en", "s", 1)]))
    assert {r["doc_id"]: r["text"] for r in pii.masked(docs, pii.detected(docs)).collect()} == {1: "mail <email> or <ip>!", 2: None}


def test_language_of_held_out_rows(spark):
    want = dict(duckdb.sql(f"select doc_id, lang from '{SF01}/documents.parquet'").fetchall())
    held = [r for r in QUERIES["op10_language_id"](spark, SF01).collect() if r["held_out"]]
    assert len(held) > 100 and sum(r["lang_pred"] == want[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held) and sum(r["rejected"] for r in held) <= 0.02 * len(held)


def test_language_ignores_labels_of_held_out_rows(spark, make):
    """Other languages, sources and ids of nothing but held-out rows: no prediction changes."""
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    held = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0}
    turned = [(i, t, "xx" if i in held else lang, "other", n) for i, t, lang, _, n in rows]
    one, two = (sorted(tuple(r) for r in QUERIES["op10_language_id"](spark, make(x)).collect()) for x in (rows, turned))
    assert one == two and len(held) > 20 and {r[2] for r in one} == {"de", "en", "es", "fr"}
    model = language_id.fitted(documents(spark, SF))
    text = documents(spark, SF).where("lang = 'de'").first()["text"]
    assert model.predict(text)[0] == "de" and model.predict("123 456")[:2] == ("und", 0.0) and model.predict(None)[0] == "und"


def test_clusters_of_two_varieties_and_no_centroid_for_odd_rows():
    rng = np.random.default_rng(1)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    one, two = np.zeros(40), np.zeros(40)
    one[:20], two[20:] = 1, 1
    x = unit(np.concatenate([one + rng.normal(0, 0.2, (150, 40)), two + rng.normal(0, 0.2, (150, 40)), rng.normal(0, 1, (4, 40))]))
    c = language_id.clustered(x)
    to = np.argmax(x @ c.T, 1)
    assert len(c) >= 2 and np.bincount(to, minlength=len(c)).min() >= 0.04 * len(x)
    # no centroid mixes the two varieties
    assert not set(to[:150].tolist()) & set(to[150:300].tolist())
    assert len(language_id.clustered(unit(np.ones((30, 40))))) == 1


def test_language_of_two_scripts_and_more_languages_than_a_block(spark, make, monkeypatch):
    rnd = random.Random(8)
    latin, cyrillic = "abcdefghij", "бвгджзиклм"
    word = lambda letters: "".join(rnd.choices(letters, k=rnd.randint(3, 8)))
    say = lambda letters: " ".join(word(letters) for _ in range(40))
    rows = [(i, say(cyrillic if i % 2 else latin) if i % 3 else say("nopqrstuvw"), "sr" if i % 3 else "zz", "s", 0) for i in range(300)]
    rows += [(1000 + 60 * k + i, say("αβγδεζηθικλμνξοπρστυ"[4 * k : 4 * k + 4]), f"l{k}", "s", 0) for k in range(5) for i in range(60)]
    path = make(rows)
    docs = documents(spark, path)
    want = {r[0]: r[2] for r in rows}
    whole = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op10_language_id"](spark, path).collect()}
    held = [i for i, r in whole.items() if r[0]]
    assert sum(whole[i][1] == want[i] for i in held) >= 0.95 * len(held)
    assert all(whole[i][1] == "sr" for i in held if want[i] == "sr" and i % 2)
    monkeypatch.setattr(language_id, "BLOCK", 2)
    model = language_id.fitted(docs)
    assert len(model.blocks) == 4 and model.languages == sorted(set(want.values()))
    parts = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in language_id.identified(docs, model).collect()}
    # sums of 32-bit products differ in their last digits with the number of centroids
    assert all(p[:2] == whole[i][:2] and abs(p[2] - whole[i][2]) < 1e-4 for i, p in parts.items())
    # against plain cosines with every centroid
    for i, text in ((r[0], r[1]) for r in rows[::17]):
        at, v = language_id.vector(text, model.idf)
        best = max(((float(x), lang) for b in model.blocks for x, lang in zip(v @ b.value.centroids[at], [b.value.languages[o] for o in b.value.owner], strict=True)), key=lambda t: t[0])
        assert parts[i][1] == best[1] and abs(parts[i][2] - min(1.0, best[0])) < 1e-6


def test_drop_copies_keeps_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, "a  b", "y"), (3, "c", "z"), (None, "c", "z"), (None, None, None)], "doc_id long, text string, extra string")
    got = sorted(map(str, exact_dedup.drop_copies(df).collect()))
    assert got == sorted(map(str, [df.collect()[0], df.collect()[3], df.collect()[5]]))


def _plain_tree(rows, dims, shards):
    """Shard of each row by recursion over lists: the rule of the operator, coordinates and hashes given."""
    lo = [min((r[d] for r in rows if r[d] is not None), default=None) for d in dims]
    hi = [max((r[d] for r in rows if r[d] is not None), default=None) for d in dims]

    def unit(v, k):
        if v is None:
            return 0.0
        return ((v - lo[k]) / (hi[k] - lo[k]) if hi[k] > lo[k] else 0.0) * 0.999 + 0.001

    points = [(r["__id"], r["__w"], r["__h"], [unit(r[d], k) for k, d in enumerate(dims)]) for r in rows]
    out = {}

    def split(points, at, k):
        if k <= 1:
            out.update((p[0], at) for p in points)
            return
        goal = sum(p[1] for p in points) * (k // 2) / k
        ends = [(min(p[3][d] for p in points), max(p[3][d] for p in points)) for d in range(len(dims))]
        d = max(range(len(dims)), key=lambda d: (ends[d][1] - ends[d][0], -d))
        width = ends[d][1] - ends[d][0]
        scale = (sharding.SLICES - 1) / width if width > 0 else 0.0
        slice_of = lambda p: math.floor((p[3][d] - ends[d][0]) * scale)
        sums = collections.Counter()
        for p in points:
            sums[slice_of(p)] += p[1]
        upto = 0
        for s in sorted(sums):
            if upto + sums[s] >= goal > upto:
                break
            upto += sums[s]
        fine = collections.Counter()
        for p in points:
            if slice_of(p) == s:
                fine[p[2]] += p[1]
        best, run = (abs(upto - goal), 0), upto
        for h in sorted(fine):
            run += fine[h]
            best = min(best, (abs(run - goal), h + 1))
        low = [p for p in points if slice_of(p) < s or (slice_of(p) == s and p[2] < best[1])]
        high = [p for p in points if not (slice_of(p) < s or (slice_of(p) == s and p[2] < best[1]))]
        split(low, at, k // 2)
        split(high, at + k // 2, k - k // 2)

    split(points, 0, shards)
    return out


@pytest.mark.parametrize("dims,shards", [(["lang", "source", "size", "n_chars"], 24), (["source"], 5), (["size", "doc_id"], 7)])
def test_tree_equals_plain_recursion(spark, dims, shards):
    docs = documents(spark, SF01)
    rows = docs.select("doc_id", "lang", "source", "n_chars", sharding.text_bytes(F.col("text")).alias("size"))
    names = [f"__d{i}" for i in range(len(dims))]
    given = rows.select("*", *sharding.dimensions(rows, dims), F.col("doc_id").alias("__id"), F.col("size").alias("__w"),
                        F.pmod(F.xxhash64(*[sharding.key_text(c) for c in rows.columns]), F.lit(sharding.SLICES)).cast("int").alias("__h")).collect()
    got = {r["doc_id"]: r["shard"] for r in sharding.kd_assigned(rows, dims, shards=shards).collect()}
    assert got == _plain_tree([r.asDict() for r in given], names, shards)


def test_texts_of_one_prefix_have_many_coordinates(spark):
    rows = spark.range(30000).select(F.col("id").alias("doc_id"), F.format_string("https://site%06d.example/", F.pmod(F.hash("id"), F.lit(20000))).alias("url"), F.lit(100).alias("size"))
    place = rows.select("url", sharding.dimensions(rows, ["url"])[0].alias("d")).distinct().orderBy("url").collect()
    d = [r["d"] for r in place]
    assert d == sorted(d) and len(set(d)) >= 4000
    steps = collections.Counter(d)
    assert max(steps.values()) <= 2 * len(d) / sharding.SLICES + 1
    got = collections.Counter(r["shard"] for r in sharding.kd_assigned(rows, ["url"], shards=6).collect())
    assert len(got) == 6 and max(got.values()) < 1.05 * 5000
    few = spark.createDataFrame([("b",), (None,), ("é",), ("a",), ("a",)], "t string")
    assert sorted(r[0] or 0 for r in few.select(sharding.dimensions(few, ["t"])[0]).collect()) == [0, 1, 1, 2, 3]


def test_licenses_are_found_and_look_alikes_are_not(spark, make):
    notices = [t for own in licenses.TEMPLATES.values() for t in own]
    assert all(any(a in t.lower() for a in licenses.ANCHORS) for t in notices)
    want = {f"Some text.\n{t}\nMore text.": f for f, own in licenses.TEMPLATES.items() for t in own}
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*want, *licenses.LOOK_ALIKES, "no notice at all"])]
    got = {r["doc_id"]: [h["family"] for h in r["hits"] if h["family"] != licenses.UNKNOWN] for r in licenses.scanned(documents(spark, make(rows))).collect()}
    right = sum(got[i] == [f] for i, f in enumerate(want.values()))
    assert right >= 0.95 * len(want) and all(got[i] == [] for i in range(len(want), len(rows)))


#: Sentences from outside the module: family, or None where nothing is granted.
SAID = {
    "This file may be used under the terms of the GNU General Public License version 2.": ["gpl"],
    "Dual licensed under MIT or Apache-2.0": ["apache", "mit"], "MIT licensed.": ["mit"], "License: GPLv3+": ["gpl"], "The MIT Licence applies to this code.": ["mit"],
    "Made available under the Eclipse Public License v2.0 by the project.": ["epl"], "Distributed under the Boost Software License, Version 1.0.": ["boost"],
    "Released into the wild under the Unlicense.": ["unlicense"], "The decompressor is licensed under the zlib license.": ["zlib"], "Illustrations are licensed under CC BY-ND 4.0": ["cc-by-nd"],
    "licensed under LGPL-2.1, not under the GPL's terms as such": ["lgpl"], "Code is published under AGPLv3.": ["agpl"], "This package is available under a 3-clause BSD licence.": ["bsd"],
    "He got his licence at MIT in 1999.": [], "The museum is licensed to sell wine.": [], "A general public licence hearing was held.": [], "Boost your sales with our software license today.": [],
    "The zlib author gave a talk about warranty law.": [], "An eclipse is seen by the public under licence of the park.": [], "Her license was under review by the state of Oregon.": [],
}


def test_notices_in_words_of_their_own(spark, make):
    path = make([(i, f"First line.\n{t}\nLast line.", "en", "s", 0) for i, t in enumerate(SAID)])
    got = {r["doc_id"]: sorted({h["family"] for h in r["hits"]} - {licenses.UNKNOWN}) for r in licenses.scanned(documents(spark, path)).collect()}
    wrong = {t: got[i] for i, (t, want) in enumerate(SAID.items()) if got[i] != want}
    assert len(wrong) <= 1, wrong
    assert not any(got[i] for i, want in enumerate(SAID.values()) if not want)


def test_prose_with_anchors_names_no_family(spark, make):
    """Precision: random sentences around license words, without the grant of a name."""
    rnd = random.Random(12)
    nouns, verbs = "the court,her lawyer,a driver,the firm,MIT students,the Apache tribe,a public domain,the licence office,copyright holders,the warranty".split(","), "discussed,refused,renewed,paid for,read about,lost,granted,reviewed".split(",")
    tails = "the license,a licence fee,its copyright,the warranty claim,fishing licences,the license plate,a software license key,licensing rules,public domain books".split(",")
    say = lambda: f"{rnd.choice(nouns)} {rnd.choice(verbs)} {rnd.choice(tails)} {rnd.choice(['yesterday', 'in June', 'by mistake', 'under pressure', 'for ten years'])}.".capitalize()
    path = make([(i, "\n".join(say() for _ in range(5)), "en", "s", 0) for i in range(300)])
    rows = licenses.scanned(documents(spark, path)).collect()
    named = [h["family"] for r in rows for h in r["hits"] if h["family"] != licenses.UNKNOWN]
    assert len(named) <= 0.002 * 1500 and sum(r["n_candidates"] for r in rows) > 1000


def test_a_text_of_very_many_anchor_lines(spark, make):
    line = ["The license office is open.", "Released under the MIT License."]
    text = "\n".join(line[i % 40 == 7] for i in range(2000))
    (r,) = licenses.scanned(documents(spark, make([(1, text, "en", "s", 0)]))).collect()
    assert r["n_candidates"] == 2000
    assert [h["line"] for h in r["hits"] if h["family"] == "mit"] == list(range(7, 2000, 40))


def test_license_lines_of_the_table(spark, texts):
    lines = {"This work is licensed under the GNU General Public License, version 3.": "gpl", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under the Apache License, Version 2.0.": "apache"}
    for r in QUERIES["op3_license_scan"](spark, SF).collect():
        assert r["lines"] == ",".join(f"{k}:{lines[x]}" for k, x in enumerate(texts[r["doc_id"]].split("\n")) if x in lines)


def test_wrapped_notices_are_found(spark, make):
    import textwrap

    rows, want = [], {}
    for family, own in licenses.TEMPLATES.items():
        for t in own:
            for width, mark in ((70, "# "), (78, " * "), (74, "// "), (40, "")):
                lines = textwrap.wrap(t, width)
                if len(lines) > 1:
                    want[len(rows)] = family
                    rows.append((len(rows), "\n".join(["int x;", "", *[mark + x for x in lines], "", "int y;"]), "en", "s", 1))
    got = {r["doc_id"]: [(h["line"], h["family"]) for h in r["hits"] if h["family"] != licenses.UNKNOWN] for r in licenses.scanned(documents(spark, make(rows))).collect()}
    right = sum(len(got[i]) == 1 and got[i][0][1] == f for i, f in want.items())
    assert len(want) > 20 and right >= 0.95 * len(want), [(rows[i][1], f, got[i]) for i, f in want.items() if [x[1] for x in got[i]] != [f]]


def test_lines_with_several_notices_keep_all(spark, make):
    prose = "The harbour was quiet and the boats lay still. " * 30
    want = {
        "Licensed under the Apache License, Version 2.0. Released under the MIT License.": ["apache", "mit"],
        f"{prose}Released under the BSD License. {prose}Licensed under CC BY-SA 4.0. {prose}Released under the ISC License. {prose}": ["bsd", "cc-by-sa", "isc"],
        "Released under Apache 2.0": ["apache"],
        "It is distributed under the terms of the MIT": ["mit"],
        "This project is licensed under the MIT License and licensed under the Apache License, Version 2.0.": ["apache", "mit"],
        "Licensed under CC BY-NC 4.0.": ["cc-by-nc"],
    }
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(want)]
    got = {r["doc_id"]: sorted(h["family"] for h in r["hits"] if h["family"] != licenses.UNKNOWN) for r in licenses.scanned(documents(spark, make(rows))).collect()}
    assert got == dict(enumerate(want.values()))
