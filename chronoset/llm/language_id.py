"""Language ID by nearest centroid.

A text is a vector of hashed letter n-grams, log term counts times inverse
document frequency, normalised. Each language has several centroids, found by
spherical k-means, and a text takes the language of the centroid with the
largest cosine. A text far from all centroids is rejected. Languages beyond
the first 500 are compared in further blocks, a pass each.

Document frequencies count all learnable rows (sums per task, then a sum over
at most `DIMS` keys). Centroids are fitted on at most `SAMPLE` rows of each
language, those with the smallest id hashes. Prediction reads whole texts and
nothing but texts.

Defined results: NULL text, and text without a letter, is `und` with score 0
and rejected; rows with NULL language teach nothing; with nothing to learn
from all rows are `und`; a NULL id counts as held out; equal cosines go to the
first language by name; repeated rows count one by one; columns named like the
results are replaced; a very long text is one vector of its whole; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from chronoset.llm.common import staged

DIMS = 1 << 13
#: Rows of each language that centroids are fitted on.
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 12
#: Languages of one block: bounds what is sent to an executor's worker at once (128 KB each).
BLOCK = 500
#: A cluster with a smaller share of its language's rows is seeded anew.
LEAST_SHARE = 0.05
#: A text is too far away below this share of the least cosine that sample rows of its length reach.
NEAR = 0.5
UNKNOWN = "und"
ROWS = 1024

_letter = re.compile(r"[^\W\d_]").search
_blank = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bigrams and trigrams of the bytes of the lower-cased letters: places and counts."""
    data = b" %s " % b" ".join(text.lower().encode().translate(_blank).split())
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    two = a[:-1] * np.uint32(257) + a[1:]
    three = two[:-1] * np.uint32(65537) + a[2:] * np.uint32(40503)
    h = np.concatenate([two * np.uint32(2654435761), three * np.uint32(2246822519)])
    counts = np.bincount((h >> np.uint32(15)) % DIMS, minlength=DIMS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = ngrams(text)
    v = np.log1p(n) * idf[at]
    norm = np.sqrt((v * v).sum())
    return at, (v / norm if norm > 0 else v).astype(np.float32)


@dataclass
class Block:
    """Centroids of some languages, in the order of their names."""

    languages: list[str]
    owner: np.ndarray  # of each centroid, its language
    centroids: np.ndarray  # DIMS x centroids

    def nearest(self, at: np.ndarray, v: np.ndarray) -> tuple[str, float]:
        cosines = v @ self.centroids[at]
        best = int(np.argmax(cosines))
        return self.languages[self.owner[best]], min(1.0, max(0.0, float(cosines[best])))


@dataclass
class Model:
    """Broadcast blocks of at most `BLOCK` languages, one after the other by name."""

    blocks: list
    idf: np.ndarray
    floor: float

    @property
    def languages(self) -> list[str]:
        return [x for b in self.blocks for x in b.value.languages]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine, and whether the text is near enough, of one text."""
        if not text or not self.blocks or not _letter(text):
            return UNKNOWN, 0.0, False
        at, v = vector(text, self.idf)
        # the first of equal cosines is the first by name
        lang, score = max((b.value.nearest(at, v) for b in self.blocks), key=lambda x: x[1])
        return lang, score, score >= self.floor * reach(len(at))


def reach(grams: int) -> float:
    """How far the cosine of a text of so many different n-grams can come: short texts hold few of a centroid's."""
    return min(1.0, (grams / 400) ** 0.5)


def learnable(id_col: str = "doc_id") -> tuple[Column, Column]:
    """Held out, and may be learned from: by the CRC-32 of the id's text modulo 5."""
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0
    return held, ~held & F.col(id_col).isNotNull()


def frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """Inverse document frequency over all rows of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and _letter(text):
                    seen[ngrams(text)[0]] += 1
                    seen[DIMS] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], names=["at", "n"])

    rows = docs.select(text_col).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(DIMS + 1)
    for r in rows:
        n[r["at"]] = r["n"]
    return np.log((1 + n[DIMS]) / (1 + n[:DIMS])) + 1


def clustered(x: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means over rows of unit length.

    Seeded by k-means++: a row is a seed with a chance by its distance from
    the seeds before, drawn from fixed random numbers. A cluster left with less
    than `LEAST_SHARE` of the rows is seeded anew from the rows of the largest
    cluster, so odd rows hold no centroid of their own; one that is small in
    the end goes.
    """
    rng = np.random.default_rng(len(x))
    k = min(k, len(x))
    c = x[[int(rng.integers(len(x)))]]
    while len(c) < k:
        far = np.maximum(1 - (x @ c.T).max(1), 0).astype(np.float64)
        pick = int(rng.choice(len(x), p=far / far.sum())) if far.sum() > 0 else int(rng.integers(len(x)))
        c = np.concatenate([c, x[[pick]]])
    least = LEAST_SHARE * len(x)
    for step in range(rounds):
        to = np.argmax(x @ c.T, 1)
        size = np.bincount(to, minlength=len(c))
        for j in range(len(c)):
            if size[j] >= least or step == rounds - 1:
                s = x[to == j].sum(0)
            else:
                inside = np.flatnonzero(to == int(np.argmax(size)))
                s = x[int(rng.choice(inside))]
            c[j] = s / max(np.linalg.norm(s), 1e-9)
    stays = (size >= least) & (np.linalg.norm(c, axis=1) > 0.5)
    return c[stays if stays.any() else size == size.max()].astype(np.float32)


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from the learnable rows of `docs` with a language.

    Of each language the `sample` ids with the smallest hashes are fitted on,
    one text of each. A threshold on the hash, from the language's count,
    leaves some two samples of rows before they are ranked.
    """
    spark = docs.sparkSession
    _, may = learnable(id_col)
    taught = docs.where(may & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    idf = frequencies(taught, "text")
    h = F.xxhash64("id")
    counts = taught.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    # languages with a thousandth of the rows or more: a thousand at most; the others have few rows to rank
    large = {r["lang"]: min(1.0, 2.0 * sample / r["n"]) for r in counts.where(F.col("n") * 1000 >= F.lit(total)).collect()}
    share = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in large.items() for x in pair]), F.col("lang")), F.lit(1.0)) if large else F.lit(1.0)
    # hashes are spread over -2^63 to 2^63
    few = taught.select("id", "lang", h.alias("h")).where(F.col("h") < (share * 2 - 1) * 9.223372036854776e18).distinct()
    by_hash = Window.partitionBy("lang").orderBy("h", "id")
    chosen = staged(few.withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= sample).select("id", "lang"), "language-sample")

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(t for t in rows["text"] if t and _letter(t))
        if not texts:
            return pd.DataFrame({"lang": [], "centroid": [], "low": []})
        x = np.zeros((len(texts), DIMS), np.float32)
        room = np.ones(len(texts))
        for i, t in enumerate(texts):
            at, v = vector(t, idf)
            x[i, at] = v
            room[i] = reach(len(at))
        c = clustered(x)
        low = float(((x @ c.T).max(1) / room).min())
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [r.tobytes() for r in c], "low": low})

    # a text for each chosen id: at most `sample` rows of a language
    texts = taught.join(chosen, ["id", "lang"], "left_semi").groupBy("lang", "id").agg(F.min("text").alias("text"))
    found = staged(texts.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, low double"), "language-centroids")
    languages = sorted(r[0] for r in found.select("lang").distinct().collect())
    low = found.agg(F.min("low")).first()[0] or 0.0
    blocks = []
    for first in range(0, len(languages), BLOCK):
        names = languages[first : first + BLOCK]
        rows = sorted((r["lang"], r["centroid"]) for r in found.where(F.col("lang").isin(names)).collect())
        owner = np.array([names.index(lang) for lang, _ in rows], np.int32)
        centroids = np.ascontiguousarray(np.stack([np.frombuffer(c, np.float32) for _, c in rows], 1))
        blocks.append(spark.sparkContext.broadcast(Block(names, owner, centroids)))
    return Model(blocks, idf, NEAR * low)


RESULTS = [StructField("held_out", BooleanType()), StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns of `docs` (the text only if kept) and held_out, lang_pred, score, rejected."""
    new = [f.name for f in RESULTS]
    rows = docs.drop(*new).withColumn("held_out", learnable(id_col)[0]).withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    # a pass for each block, as a rule one; the workers of a pass hold its block only
    for block in model.blocks:
        rows = _pass(rows, block, model.idf, model.floor, text_col)
    return rows if keep_text else rows.drop(text_col)


def _pass(rows: DataFrame, sent, idf: np.ndarray, floor: float, text_col: str) -> DataFrame:
    """Rows with the nearer of what they have and what a block offers; of equals, what they have."""
    arrow = to_arrow_schema(rows.schema)
    at = {c: rows.columns.index(c) for c in (text_col, "lang_pred", "score", "rejected")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                said = []
                for text, *had in zip(*[batch.column(k).to_pylist() for k in at.values()], strict=True):
                    if text and _letter(text):
                        grams, v = vector(text, idf)
                        lang, score = block.nearest(grams, v)
                        if had[0] == UNKNOWN or score > had[1]:
                            had = lang, score, score < floor * reach(len(grams))
                    said.append(had)
                columns = [c.cast(arrow.field(k).type) for k, c in enumerate(batch.columns)]
                for k, values in zip([at["lang_pred"], at["score"], at["rejected"]], zip(*said, strict=True), strict=True):
                    columns[k] = pa.array(values, arrow.field(k).type)
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, rows.schema)
