"""The pipeline's stages, each against what its operator says of the stage's own input."""

import collections
import hashlib

import corpus_pipeline
from chronoset.llm import language_id, line_dedup, minhash, mixing, sentencepieces
from chronoset.llm.catalog import piece_model
from chronoset.llm.common import documents, staged

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, SF)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF), f"test-{name}"))
    for d in kept[:-1]:
        assert d.columns == docs.columns and d.dtypes == docs.dtypes
    rows = [d.collect() for d in kept]

    model = language_id.fitted(kept[0])
    near = {r["doc_id"] for r in rows[0] if model.predict(r["text"])[2]}
    assert {r["doc_id"] for r in rows[1]} == near and len(near) >= 0.97 * len(rows[0])

    text = {r["doc_id"]: r["text"] for r in rows[1]}
    cut = {r["doc_id"]: r["removed"] for r in line_dedup.line_deduped(kept[1]).collect()}
    left = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(cut[i])) for i, t in text.items()}
    want = {i: t for i, t in left.items() if t.strip() or not cut[i]}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows[2]} == {i: (t, len(t)) for i, t in want.items()}

    groups = collections.defaultdict(list)
    for r in minhash.near_groups(kept[2]).collect():
        groups[r["component_id"]].append(r["doc_id"])
    assert {r["doc_id"] for r in rows[3]} == {min(g) for g in groups.values()}

    copies = {r["doc_id"]: r["copies"] for r in mixing.planned(kept[3], mixing.word_count(kept[3]["text"])).collect()}
    assert collections.Counter(r["doc_id"] for r in rows[4]) == {i: c for i, c in copies.items() if c}

    lib = sentencepieces.loaded(piece_model()).lib
    text = {r["doc_id"]: r["text"] for r in rows[4]}
    for r in rows[5]:
        ids = lib.encode(text[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_gives_the_last_stage(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 200


def test_odd_rows_pass_every_stage(spark, odd, empty):
    """NULLs in every column, empty, blank and very long texts, repeated rows, and a table without rows, stage by stage."""
    for path in (odd, empty):
        first = documents(spark, path)
        for name, stage in corpus_pipeline.STAGES:
            # every stage on the odd rows themselves, not only on what the stages before left of them
            out = stage(spark, first, path)
            rows = out.collect()
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == first.columns
            assert rows or path == empty or name == "language_id"
            if name in ("language_id", "line_dedup", "minhash_near_dedup"):
                assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in first.collect()}
            if name == "sentencepieces" and path == odd:
                assert len(rows) == first.count()
        last = corpus_pipeline.run(spark, path).collect()
        assert path == odd or not last
