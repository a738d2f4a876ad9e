"""Every operator on odd rows, an empty table, and a table with clashing columns."""

import pytest
from pyspark.sql import functions as F

from chronoset.llm import exact_dedup, language_id, licenses, line_dedup, minhash, mixing, pii, quality, sentencepieces, sharding
from chronoset.llm.catalog import ORACLE, QUERIES, piece_model
from chronoset.llm.common import documents

from conftest_rows import ODD

CLASHES = "shard slot target copies source_size kept score ids decoded d t s e spans n node root bucket rid words size removed n_lines lang_pred held_out rejected ratio reason hits base candidates __none".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows_give_one_row_each(spark, odd, name):
    out = QUERIES[name](spark, odd)
    rows = out.collect()
    assert len(rows) == len(ODD)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(x[0]) for x in ODD)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_on_odd_rows(spark, odd, sql, name):
    out = QUERIES[name](spark, odd)
    mine = sorted([{c: r[c] for c in r.asDict()} for r in out.collect()], key=repr)
    theirs = [{c: r[c] for c in out.columns} for r in sql(ORACLE[name], odd)]
    assert mine == sorted(theirs, key=repr)


@pytest.fixture(scope="module")
def clashing(spark, odd):
    docs = documents(spark, odd)
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


@pytest.mark.parametrize(
    "call, gone",
    [
        (lambda d: exact_dedup.drop_copies(d.where("doc_id is not null").dropDuplicates(["doc_id"])), ()),
        (lambda d: mixing.planned(d, mixing.word_count(F.col("text"))), ("source_size", "target", "copies")),
        (lambda d: mixing.mixed(d), ()),
        (lambda d: sharding.with_slots(sharding.kd_assigned(d, ["lang", "n_chars"], "n_chars", shards=3), ["doc_id"]), ("shard", "slot")),
        (lambda d: quality.judged(d), ("kept", "ratio", "reason")),
        (lambda d: line_dedup.line_deduped(d), ("removed", "n_lines")),
        (lambda d: minhash.drop_near_copies(d), ()),
        (lambda d: sentencepieces.encoded(d, piece_model()), ("ids", "decoded")),
        (lambda d: language_id.identified(d, language_id.fitted(d)), ("held_out", "lang_pred", "score", "rejected")),
    ],
    ids=["exact", "planned", "mixed", "shards", "quality", "lines", "near", "pieces", "language"],
)
def test_clashing_columns_pass_or_are_replaced(clashing, call, gone):
    out = call(clashing)
    assert len(set(out.columns)) == len(out.columns)
    for r in out.collect():
        for c in CLASHES:
            if c not in gone:
                assert r[c] == f"own {c}"


@pytest.mark.parametrize("call", [exact_dedup.exact_groups, minhash.near_groups, pii.detected, licenses.scanned], ids=["exact", "near", "personal", "license"])
def test_reports_ignore_other_columns(clashing, call):
    assert call(clashing).count() == len(ODD)
