"""Line dedup by content-defined chunks of lines.

A rolling hash over the line hashes decides where a document is cut: a cut
lies before line i if the hash of the window of w lines from i on says
"starts", or that of the w lines before i says "ends". Cuts inside a passage
are thus the same wherever it stands, whatever stands around it. Windows of
three widths are rolled, as short passages hold few wide windows, and each is
read for several independent cuttings, a bit of the hash each: `SCALES` gives
width and bits. Equal spans count once. In a run of equal lines all windows
are alike, so a run is cut off from its surroundings and in twos.

A chunk's key is a polynomial over its line hashes. Chunks of two lines or more
whose key occurs again anywhere are compared byte by byte with the first
occurrence, the smallest (id, place), and every later one is removed.

A removed line always has an equal line in an earlier place, so each line
stays somewhere. Only keys of chunks are shuffled by key; texts move twice, to
fetch the first occurrences' bytes and to cut the documents.

Defined results: NULL text stays NULL and has no lines; chunks of fewer than
two lines with a word or of fewer than `MIN_WORDS` words stay; NULL ids come
last; rows repeated with the same id and text share one verdict, so none
removes lines of the other; columns named like the results are replaced; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from chronoset.llm.common import staged

#: Lines of a window, and how many cuttings its hash decides.
SCALES = ((1, 16), (2, 10), (3, 6))
MIN_LINES = 2
MIN_WORDS = 10
LAST = 2**63 - 1
ROWS = 512

_U = np.uint64
_BASE = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5  # odd


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, _U)
    p[0] = 1
    return np.cumprod(p, dtype=_U)


def cut_bits(h: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """A bit per cutting for the place before each line; windows end at the text's first and last line."""
    n = len(h)
    cut, free = np.zeros(n, _U), 0
    for width, bits in SCALES:
        ahead, behind = np.zeros(n, _U), np.zeros(n, _U)
        for k in range(width):
            # line i + k, and line i - 1 - k, where they belong to the text of line i
            turn = mixed(h + _U((k + 1) * _BASE[0] % 2**64))
            same = text_of[k:] == text_of[: n - k]
            ahead[: n - k] += np.where(same, turn[k:], _U(0))
            same = text_of[k + 1 :] == text_of[: n - 1 - k]
            behind[k + 1 :] += np.where(same, mixed(h + _U((k + 1) * _BASE[1] % 2**64))[: n - 1 - k], _U(0))
        says = mixed(ahead) | mixed(behind)
        cut |= (says & _U((1 << bits) - 1)) << _U(free)
        free += bits
    again = np.zeros(n, bool)
    again[1:] = (h[1:] == h[:-1]) & (text_of[1:] == text_of[:-1])
    place = np.arange(n) - np.maximum.accumulate(np.where(again, 0, np.arange(n)))
    whole = _U((1 << free) - 1)
    run = again.copy()
    run[:-1] |= again[1:]
    cut[run] = np.where(place[run] % 2 == 0, whole, _U(0))
    # what follows a run starts anew
    cut[1:][run[:-1] & ~again[1:]] = whole
    cut[np.flatnonzero(np.diff(text_of, prepend=-1))] = whole
    return cut


def chunks(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Multi-line chunks of texts: text number, first line, line behind the last, and two keys."""
    import xxhash

    lines: list[bytes] = []
    sizes = []
    for t in texts:
        own = t.encode().split(b"\n") if t else []
        sizes.append(len(own))
        lines += own
    n = len(lines)
    if n < MIN_LINES:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), _U, n)
    words = np.fromiter((len(x.split()) for x in lines), np.int64, n)
    word_sum = np.concatenate([[0], np.cumsum(words)])
    full_sum = np.concatenate([[0], np.cumsum(words > 0)])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    text_of = np.repeat(np.arange(len(texts)), sizes)
    cut = cut_bits(h, text_of)
    spans = []
    for f in range(sum(bits for _, bits in SCALES)):
        at = np.flatnonzero((cut >> _U(f)) & _U(1))
        end = np.append(at[1:], n)
        several = end - at >= MIN_LINES
        spans.append(at[several] * np.int64(n + 1) + end[several])
    span = np.unique(np.concatenate(spans))
    s, e = span // (n + 1), span % (n + 1)
    worth = (word_sum[e] - word_sum[s] >= MIN_WORDS) & (full_sum[e] - full_sum[s] >= MIN_LINES)
    s, e = s[worth], e[worth]
    keys = []
    for k, base in enumerate(_BASE):
        up, down = _powers(base, n), _powers(pow(base, -1, 2**64), n)
        rolled = np.concatenate([np.zeros(1, _U), np.cumsum(mixed(h ^ _U(k)) * up[:n], dtype=_U)])
        keys.append(mixed((rolled[e] - rolled[s]) * down[s] + (e - s).astype(_U)).view(np.int64))
    of = text_of[s]
    return of, s - begins[of], e - begins[of], keys[0], keys[1]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with __d and __t, which name a row up to repetition."""
    return docs.withColumn("__d", F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))).withColumn("__t", F.xxhash64(text_col))


def _found(keyed: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, s, e, a, b = chunks(batch.column(2).to_pylist())
            of = pa.array(of)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(s, pa.int32()), pa.array(e, pa.int32()), pa.array(a), pa.array(b)], names=["d", "t", "s", "e", "k1", "k2"])

    return keyed.select("__d", "__t", text_col).mapInArrow(run, "d long, t long, s int, e int, k1 long, k2 long")


def _first_bytes(keyed: DataFrame, firsts: DataFrame, text_col: str) -> DataFrame:
    """k1, k2 and the bytes of first occurrences (k1, k2, d, t, s, e)."""
    wanted = firsts.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.struct("s", "e", "k1", "k2").alias("span")).groupBy("__d", "__t").agg(F.collect_list("span").alias("__spans"))
    owners = keyed.select("__d", "__t", text_col).join(wanted, ["__d", "__t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                k1, k2, data = [], [], []
                for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    lines = text.encode().split(b"\n")
                    for x in spans:
                        k1.append(x["k1"])
                        k2.append(x["k2"])
                        data.append(b"\n".join(lines[x["s"] : x["e"]]))
                yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(data, pa.binary())], names=["k1", "k2", "data"])

    rows = owners.select(text_col, "__spans").mapInArrow(run, "k1 long, k2 long, data binary")
    # repeated rows of one document give the same bytes again
    return rows.groupBy("k1", "k2").agg(F.min("data").alias("data"))


RESULTS = [StructField("n_lines", LongType()), StructField("removed", ArrayType(IntegerType(), False))]


def line_deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs`, the text without its repeated chunks, and n_lines and removed (numbers of the lines taken out, from 0)."""
    docs = docs.drop(*[f.name for f in RESULTS])
    keyed = _keyed(docs, id_col, text_col)
    spans = staged(_found(keyed, text_col), "chunks")
    place = F.struct("d", "t", "s", "e")
    again = spans.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2", "first")
    repeated = staged(spans.join(again, ["k1", "k2"]).where(place != F.col("first")), "repeated-chunks")
    firsts = repeated.select("k1", "k2", "first.*").distinct()
    data = staged(_first_bytes(keyed, firsts, text_col), "first-chunks")
    cuts = repeated.join(data, ["k1", "k2"]).select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.struct("s", "e", "data").alias("span")).groupBy("__d", "__t").agg(F.collect_set("span").alias("__spans"))
    rows = keyed.join(cuts, ["__d", "__t"], "left").select(*docs.columns, "__spans")
    schema = StructType([*docs.schema.fields, *RESULTS])
    arrow = to_arrow_schema(schema)
    text_at, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts, sizes, gone = [], [], []
                for text, cut in zip(batch.column(text_at).to_pylist(), batch.column(width).to_pylist(), strict=True):
                    out: set[int] = set()
                    lines = text.encode().split(b"\n") if text else []
                    for x in cut or ():
                        if b"\n".join(lines[x["s"] : x["e"]]) == x["data"]:
                            out.update(range(x["s"], x["e"]))
                    texts.append(b"\n".join([x for i, x in enumerate(lines) if i not in out]).decode() if out else text)
                    sizes.append(len(lines))
                    gone.append(sorted(out))
                columns = [batch.column(k).cast(arrow.field(k).type) for k in range(width)]
                columns[text_at] = pa.array(texts, arrow.field(text_at).type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(gone, arrow.field(width + 1).type)], schema=arrow)

    return rows.mapInArrow(run, schema)
