"""Periodic runs of words, by internal pattern matching.

A run is a maximal stretch of words with smallest period q, at least
`MIN_LENGTH` words and `MIN_EXPONENT` periods long. The words of many documents
are laid one after the other, a unique mark after each document, and indexed at
once:

1. prefix doubling names every factor of 2^k words by its place in suffix
   order; the last names are the suffix array;
2. a wavelet tree over the suffix array counts and selects the text positions
   of any suffix range;
3. for each level k the text is cut into dyadic blocks of B = 2^k words. The
   occurrences of a block in the windows beside it form a progression: its
   next occurrence on either side (a range successor and predecessor in the
   tree) lies one period away. Distances in (B/2, B] are candidate periods.
   A run with q in that interval is at least 4q > 2B words long, so it holds
   a whole block and, on one side of it, q more words: no run is missed;
4. a candidate is extended both ways by comparing names, longest first, and
   kept if it is long enough. Its distance is its smallest period, as a
   smaller one would be a nearer occurrence.

Work is n log n of a document, all in numpy over batches of documents; memory
is some 8 n log n bytes of the longest document or `BATCH_WORDS`. Documents
need no shuffle.

Defined results: words are runs of anything but space and tab to carriage
return, compared as bytes; NULL, empty and blank texts have no words and no
runs, their collapsed text is empty; repeated rows are judged one by one; a
very long text is one document in one batch; runs that overlap are all listed,
by start and then period; columns named like the results are replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from chronoset.llm.common import WORD

MIN_LENGTH = 6
#: At least 4: the blocks of step 3 rely on it.
MIN_EXPONENT = 4
#: Words indexed together; a longer document is indexed alone.
BATCH_WORDS = 1 << 17
ROWS = 4096

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
RESULT = [
    StructField("n_words", LongType()),
    StructField("runs", ArrayType(RUN)),
    StructField("collapsed", StringType()),
]


def factor_names(ids: np.ndarray) -> list[np.ndarray]:
    """Per level k, the name of the factor of 2^k words at each position; the last level's names are all different.

    A name is the place in suffix order of the first suffix that starts with
    the factor. The last word must be unique. Only factors that recur are
    sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = ids[order[1:]] != ids[order[:-1]]
    name = np.empty(n, np.int32)
    name[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    names, h = [name], 1
    while True:
        again = np.flatnonzero(np.bincount(name, minlength=n)[name] > 1)
        if not len(again):
            return names
        # a factor that recurs holds no mark, so another word follows it
        key = name[again].astype(np.int64) * n + name[again + h]
        order = np.argsort(key)
        key, again = key[order], again[order]
        old = name[again]
        at = np.arange(len(key))
        first = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, at, 0))
        group = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, at, 0))
        name = name.copy()
        name[again] = old + (group - first)
        names.append(name)
        h *= 2


class WaveletTree:
    """Counts and order statistics of the values in any range of an array, one level a bit, highest first."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in reversed(range(max(1, int(len(values) - 1).bit_length()))):
            one = (values >> bit) & 1 == 1
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are less than x."""
        count = np.zeros(len(x), np.int32)
        for bit, zeros, base in self.levels:
            zl, zr = zeros[left], zeros[right]
            one = (x >> bit) & 1 == 1
            count += np.where(one, zr - zl, 0)
            left, right = np.where(one, base + left - zl, zl), np.where(one, base + right - zr, zr)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank k, from 0, in [left, right)."""
        value = np.zeros(len(k), np.int32)
        for bit, zeros, base in self.levels:
            zl, zr = zeros[left], zeros[right]
            one = k >= zr - zl
            k = k - np.where(one, zr - zl, 0)
            value |= one.astype(np.int32) << bit
            left, right = np.where(one, base + left - zl, zl), np.where(one, base + right - zr, zr)
        return value


def _extended(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from a on equal those from b on, and how many before a those before b."""
    right, left = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in reversed(range(len(names))):
        name, width = names[k], 1 << k
        right += np.where(name[a + right] == name[b + right], width, 0)
        x = a - left - width
        inside, x = x >= 0, np.maximum(x, 0)
        left += np.where(inside & (name[x] == name[x + b - a]), width, 0)
    return right, left


def runs_of(ids: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start and period; `ids` ends each document with a unique mark."""
    names = factor_names(ids)
    n = len(ids)
    suffixes = np.empty(n, np.int32)
    suffixes[names[-1]] = np.arange(n, dtype=np.int32)
    tree = WaveletTree(suffixes)
    found = []
    # factors of the last level occur once
    for k in range(len(names) - 1):
        width, name = 1 << k, names[k]
        size = np.bincount(name, minlength=n)
        p = np.arange(0, n - width, width)
        p = p[size[name[p]] > 1]
        if not len(p):
            break
        left = name[p].astype(np.int64)
        right = left + size[left]
        nth = tree.below(left, right, p)
        after, before = np.flatnonzero(nth + 1 < right - left), np.flatnonzero(nth > 0)
        other = tree.nth(left[np.r_[after, before]], right[np.r_[after, before]], np.r_[nth[after] + 1, nth[before] - 1])
        a = np.r_[p[after], other[len(after):]].astype(np.int64)
        b = np.r_[other[: len(after)], p[before]].astype(np.int64)
        near = (b - a <= width) & (2 * (b - a) > width)
        a, b = a[near], b[near]
        same = document[a] == document[b]
        a, b = a[same], b[same]
        if not len(a):
            continue
        q = b - a
        ahead, behind = _extended(names, a, b)
        length = q + ahead + behind
        good = (length >= MIN_LENGTH) & (length >= MIN_EXPONENT * q)
        found.append(np.stack([a - behind, q, length])[:, good])
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    start, period, length = np.unique(np.concatenate(found, axis=1), axis=1)
    return start, length, period


def _indexed(texts: list[str | None]) -> tuple[list[list], list[list[bytes]], list[list[bytes]]]:
    """Runs, words and kept words of each text."""
    words = [(t or "").encode().split() for t in texts]
    number: dict = {}
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    first = np.concatenate([[0], np.cumsum(sizes)])
    total = int(first[-1])
    ids = np.empty(total, np.int64)
    body = np.ones(total, bool)
    body[first[1:] - 1] = False
    ids[body] = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, total - len(words))
    ids[~body] = len(number) + np.arange(len(words))
    start, length, period = runs_of(ids, np.repeat(np.arange(len(words)), sizes))
    gone = np.zeros(total + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    gone = np.cumsum(gone) > 0
    of = np.searchsorted(first, start, "right") - 1
    runs: list[list] = [[] for _ in words]
    for d, s, ln, q in zip(of.tolist(), (start - first[of]).tolist(), length.tolist(), period.tolist(), strict=True):
        runs[d].append({"start": s, "length": ln, "period": q})
    kept = [[w for w, g in zip(ws, gone[first[d]:].tolist(), strict=False) if not g] if runs[d] else ws for d, ws in enumerate(words)]
    return runs, words, kept


def collapsed(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns of `docs` (without the text, if asked), the number of words, the runs, and the text without repeats.

    In the collapsed text a run keeps its first period; words are joined by
    single spaces.
    """
    source = docs.drop(*[f.name for f in RESULT])
    out = [f for f in source.schema.fields if keep_text or f.name != text_col]
    schema = StructType([*out, *RESULT])
    arrow = to_arrow_schema(schema)
    text_at, carried = source.columns.index(text_col), [source.columns.index(f.name) for f in out]
    at = len(out)

    def put(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        runs, words, kept = _indexed(texts)
        new = [[len(w) for w in words], runs, [b" ".join(w).decode() for w in kept]]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).cast(arrow.field(k).type) for k, c in enumerate(carried)],
             *[pa.array(x, arrow.field(at + k).type) for k, x in enumerate(new)]], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column(text_at).to_pylist()
            begin = size = 0
            for i, text in enumerate(texts):
                # a word takes two bytes at least, with the space after it
                more = len(text or "") // 2 + 1
                if i > begin and (size + more > 3 * BATCH_WORDS or i - begin == ROWS):
                    yield put(whole.slice(begin, i - begin), texts[begin:i])
                    begin, size = i, 0
                size += more
            if texts:
                yield put(whole.slice(begin), texts[begin:])

    return source.mapInArrow(run, schema)


def planted(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`docs` where every tenth text, by the checksum of its id, turns periodic from some word on.

    With h the crc32 of the decimal id and g = h // 10, texts with h % 10 = 0
    and n > 0 words repeat, from word a = g % n on, the p = 1 + (n - a) //
    (3 + g % 8) words that start there. A NULL id changes nothing.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    hit = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.withColumn("__g", F.floor(h / 10)).withColumn(
        "__w", F.when(hit, F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))))
    n = F.size("__w")
    rows = rows.withColumn("__n", n).withColumn("__a", F.when(n > 0, F.col("__g") % n).cast("int"))
    rows = rows.withColumn("__p", (1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8))).cast("int"))
    times = F.ceil((F.col("__n") - F.col("__a")) / F.col("__p")).cast("int")
    root = F.slice("__w", F.col("__a") + 1, F.col("__p"))
    tail = F.slice(F.flatten(F.array_repeat(root, times)), F.lit(1), F.col("__n") - F.col("__a"))
    text = F.array_join(F.concat(F.slice("__w", F.lit(1), F.col("__a")), tail), " ")
    return rows.withColumn(text_col, F.when(F.col("__a").isNotNull(), text).otherwise(F.col(text_col))).select(*docs.columns)


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    best: Column = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("s"), (-x["period"]).alias("p"))))
    listed = F.concat_ws("", F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))))
    rows = rows.withColumn("__b", best)
    start, period, length = -F.col("__b.s"), -F.col("__b.p"), F.col("__b.length")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
