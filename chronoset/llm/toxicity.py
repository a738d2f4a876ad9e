"""Toxicity: a linear-chain conditional random field tags toxic words.

Labels are given for documents, so words are labelled first: in a toxic
document of the sample, a word is tagged toxic when its form stands in toxic
documents far more often than in clean ones (G statistic over documents, and
a log ratio); all other words are clean. The field is fitted on these tags with
hashed features of the word, its affixes and its neighbours. Forward-backward
marginals of all words of a text give its score: a logistic regression of the
largest and the summed marginals, fitted on marginals of documents that the
field has not seen (two halves) and weighted to the classes' true shares.
Words with a marginal of 0.5 or more are the offending spans.

The fit reads a bounded sample of labelled rows: at most about `SAMPLE` rows of
each class (a threshold on a hash of the id, from the class's count), joined
to their texts by broadcast, in one task. Every row and whole text is scored,
batch by batch, without a shuffle; batches are cut by size, a very long text
is a batch of its own.

Defined results: NULL, empty and blank texts have no words and get the score
of no evidence; a NULL id counts as held out; rows without a label, and NULL
labels, teach nothing; with nothing to learn from, or one class only, all
scores are 0; a label given twice counts twice; repeated rows are scored one by
one; columns named like the results are replaced; an empty table gives an empty
result.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from chronoset.llm.crf import Tagger

#: Rows of each class that the models are fitted on.
SAMPLE = {1: 2000, 0: 4000}
DIMS = 1 << 18
#: Least G statistic and log ratio of a word tagged toxic in toxic documents.
LEAST_G, LEAST_RATIO = 16.0, 2.0
#: One in so many sentences without a word tagged in any document is fitted on, with that weight.
BACKGROUND = 8
TOXIC = 0.3
OFFENDING = 0.5
#: Characters of text scored together.
BATCH_CHARS = 1 << 20

_token = re.compile(r"[^\x20\x09-\x0D]+|\n").findall
_placed = re.compile(r"[^\x20\x09-\x0D]+|\n").finditer
_strip = re.compile(r"[\W\d_]+").sub

SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("probability", DoubleType())])
RESULT = [StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("spans", ArrayType(SPAN))]


def form_of(token: str) -> str:
    return _strip("", token.lower())


class Tokens:
    """Words of many texts: their types, sentences and documents, as arrays."""

    def __init__(self, texts: list[str | None]):
        self.number: dict[str, int] = {}
        each = [_token(t) if t else [] for t in texts]
        self.sizes = np.fromiter(map(len, each), np.int64, len(each))
        self.document = np.repeat(np.arange(len(each)), self.sizes)
        number = self.number
        types = np.fromiter((number.setdefault(w, len(number)) for ws in each for w in ws), np.int64, int(self.sizes.sum()))
        forms: dict[str, int] = {}
        token_form = np.fromiter((forms.setdefault(form_of(w), len(forms)) for w in number), np.int64, len(number))
        ends = np.fromiter((w[-1] in ".!?\n" for w in number), bool, len(number))
        self.forms = list(forms)
        self.types = token_form[types]
        n = len(types)
        opens = np.ones(n, bool)
        opens[1:] = ends[types[:-1]] | (self.document[1:] != self.document[:-1])
        self.first = np.maximum.accumulate(np.where(opens, np.arange(n), 0))

    def table(self) -> np.ndarray:
        """Feature numbers of every form: itself, its first and last letters; beside it, the two neighbours' roles."""
        h = lambda tag, w: zlib.crc32((tag + w).encode()) % DIMS
        rows = [(h("w", w), h("p", w[:4]), h("s", w[-4:]), h("<", w), h(">", w)) for w in self.forms]
        return np.array(rows, np.int64).reshape(len(rows), 5)


def evidence(tokens: Tokens, marginal: np.ndarray) -> np.ndarray:
    """Per text: 1, its largest marginal, and the log of its summed marginals."""
    n = len(tokens.sizes)
    total = np.bincount(tokens.document, marginal, n)
    top = np.zeros(n)
    np.maximum.at(top, tokens.document, marginal)
    return np.stack([np.ones(n), top, np.log1p(total)], 1)


def _toxic_forms(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Which forms stand in toxic documents far more often than in clean ones."""
    n_forms = len(tokens.forms)
    pairs = np.unique(tokens.document * np.int64(max(n_forms, 1)) + tokens.types)
    of, form = pairs // max(n_forms, 1), pairs % max(n_forms, 1)
    t, c = (np.bincount(form[toxic[of] == k], minlength=n_forms).astype(float) for k in (1, 0))
    nt, nc = float((toxic == 1).sum()), float((toxic == 0).sum())
    ratio = np.log((t + 0.5) / (nt + 1)) - np.log((c + 0.5) / (nc + 1))
    share = nt / max(nt + nc, 1)
    safe = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    g = 2 * (safe(t, (t + c) * share) + safe(c, (t + c) * (1 - share)))
    letters = np.fromiter((len(f) > 0 for f in tokens.forms), bool, n_forms)
    return (ratio >= LEAST_RATIO) & (g >= LEAST_G) & letters


def _tagger(texts: list[str], toxic: np.ndarray) -> Tagger:
    tokens = Tokens(texts)
    tagger = Tagger(DIMS)
    if not len(tokens.types):
        return tagger
    marked = _toxic_forms(tokens, toxic)
    hit = marked[tokens.types]
    tags = (hit & (toxic[tokens.document] == 1)).astype(np.int64)
    # sentences with a marked word all count; of the others, one in BACKGROUND by place, with that weight
    busy = np.zeros(len(hit), bool)
    busy[tokens.first[hit]] = True
    chosen = (np.cumsum(tokens.first == np.arange(len(hit))) % BACKGROUND == 0)
    keep = busy[tokens.first] | chosen
    weight = np.where(busy[tokens.first], 1.0, BACKGROUND)[keep]
    place = np.cumsum(keep) - 1
    return tagger.fit(tokens.table(), tokens.types[keep], place[tokens.first[keep]], tags[keep], weight)


def _calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge."""
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, 1e-2, 1e-2]) * weight.sum() / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge @ b
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    return b


@dataclass
class Model:
    tagger: Tagger | None
    calibration: np.ndarray | None

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, Tokens | None, np.ndarray]:
        if self.tagger is None:
            return np.zeros(len(texts)), None, np.empty(0)
        tokens = Tokens(texts)
        marginal = self.tagger.marginals(tokens.table(), tokens.types, tokens.first)
        x = evidence(tokens, marginal) @ self.calibration
        return 1 / (1 + np.exp(-np.clip(x, -30, 30))), tokens, marginal


def fit_rows(texts: list[str], toxic: np.ndarray, fold: np.ndarray, weight: np.ndarray) -> Model:
    """The field and the calibration of scores, from labelled texts; fold 0 or 1 and the weight of each."""
    x = np.zeros((len(texts), 3))
    for k in (0, 1):
        seen, other = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        tagger = _tagger([texts[i] for i in seen], toxic[seen])
        tokens = Tokens([texts[i] for i in other])
        x[other] = evidence(tokens, tagger.marginals(tokens.table(), tokens.types, tokens.first))
    return Model(_tagger(texts, toxic), _calibrated(x, toxic.astype(float), weight))


def learnable(id_col="doc_id") -> Column:
    """Rows that labels may be learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows that may teach; two jobs and a task on a bounded sample."""
    given = labels.where(learnable(id_col) & F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("__y"))
    count = {r["__y"]: r["count"] for r in given.groupBy("__y").count().collect()}
    if len(count) < 2:
        return Model(None, None)
    h = F.crc32(F.concat(F.lit("toxic-"), F.col(id_col).cast("string")).cast("binary"))
    share = {y: min(1.0, SAMPLE[y] / n) for y, n in count.items()}
    taken = given.where(h < F.when(F.col("__y") == 1, share[1] * 2**32).otherwise(share[0] * 2**32))
    # some SAMPLE rows, so small enough to send to every executor
    rows = docs.select(id_col, F.col(text_col).alias("__t")).join(F.broadcast(taken), id_col)
    rows = rows.select(F.lit(0).alias("__one"), F.col(id_col).cast("string").alias("__id"), "__t", "__y")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["__id", "__t"], na_position="first", kind="stable")
        y = part["__y"].to_numpy().astype(np.int64)
        if len(set(y.tolist())) < 2:
            return pd.DataFrame({"model": [pickle.dumps(Model(None, None))]})
        fold = np.array([zlib.crc32(b"fold-" + i.encode()) % 2 for i in part["__id"]])
        texts = [t or "" for t in part["__t"]]
        weight = np.where(y == 1, 1 / share[1], 1 / share[0])
        model = fit_rows(texts, y, fold, weight)
        model.tagger.weights = model.tagger.weights.astype(np.float32)
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    got = rows.groupBy("__one").applyInPandas(fit, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else Model(None, None)


def _spans(text: str, marginal: np.ndarray) -> list[dict]:
    """Offending words by code points, neighbours joined."""
    spans: list[dict] = []
    joined = False
    for m, p in zip(_placed(text), marginal.tolist(), strict=True):
        if p >= OFFENDING:
            if joined:
                spans[-1]["end"], spans[-1]["probability"] = m.end(), max(spans[-1]["probability"], p)
            else:
                spans.append({"start": m.start(), "end": m.end(), "probability": p})
        joined = p >= OFFENDING
    return spans


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns of `docs` (without the text, if asked), the score, the decision and the offending spans."""
    source = docs.drop(*[f.name for f in RESULT])
    out = [f for f in source.schema.fields if keep_text or f.name != text_col]
    schema = StructType([*out, *RESULT])
    arrow = to_arrow_schema(schema)
    text_at, carried, at = source.columns.index(text_col), [source.columns.index(f.name) for f in out], len(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def put(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        score, tokens, marginal = sent.value.scores(texts)
        spans: list[list] = [[] for _ in texts]
        if tokens is not None and len(marginal):
            ends = np.cumsum(tokens.sizes)
            for d in np.unique(tokens.document[marginal >= OFFENDING]).tolist():
                spans[d] = _spans(texts[d], marginal[ends[d] - tokens.sizes[d] : ends[d]])
        new = [score, (score >= TOXIC).astype(np.int32), spans]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).cast(arrow.field(k).type) for k, c in enumerate(carried)],
             *[pa.array(x, arrow.field(at + k).type) for k, x in enumerate(new)]], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column(text_at).to_pylist()
            begin = size = 0
            for i, text in enumerate(texts):
                more = len(text or "") + 1
                if i > begin and size + more > BATCH_CHARS:
                    yield put(whole.slice(begin, i - begin), texts[begin:i])
                    begin, size = i, 0
                size += more
            if texts:
                yield put(whole.slice(begin), texts[begin:])

    return source.mapInArrow(run, schema)
