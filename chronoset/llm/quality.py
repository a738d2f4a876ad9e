"""Quality rules: compression bands.

Repetitive text compresses far better than prose of its length and encoded or
random text hardly at all, so zstandard ratios are held against limits. The
ratio of good prose rises with its length (short inputs have nothing to refer
back to) and differs from corpus to corpus, so the upper limits are taken from
the corpus: in every band of length, half an octave wide, the median ratio of
the texts that pass the base rules plus `SPREAD` median absolute deviations.
Equal texts count once there, so a group of copies sets no limit. The limits
come from one histogram over all rows, exact but for a 256th of a unit of the
ratio, and are the same on every run; a band with fewer than `LEAST` texts, and
a corpus whose ratios exceed them, keeps the fixed limits of `BANDS`. The same
is done for the fixed chunks of `CHUNK_BYTES`.

Lower limits are fixed: they lie between random base64 (1.07 to 1.33 by length)
and the least prose of the band's length. Hexadecimal digits come out at 1.4 to
1.96, so they are not told from prose. A document is rejected when its own
ratio leaves its band, or when more than half of it, by bytes, lies in chunks
that leave theirs.

Defined results: NULL text has no words and fails the base rules; texts below
the first band's length are judged by the base rules alone; a very long text is
read whole, chunk by chunk; repeated rows are judged one by one, and alike;
columns named like the results are replaced; an empty table gives an empty
result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from chronoset.llm.common import staged

#: Least bytes, least ratio (below: incompressible), largest ratio (above: repetitive).
BANDS = (
    (128, 1.10, 3.0),
    (256, 1.27, 3.2),
    (512, 1.36, 3.5),
    (1024, 1.48, 4.0),
    (2048, 1.60, 4.5),
    (4096, 1.65, 5.0),
    (8192, 1.70, 5.5),
    (16384, 1.75, 6.0),
)
CHUNK_BYTES = 4096
BAD_CHUNKS = 0.5
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
ROWS = 512
#: Upper limits from the corpus: deviations above the median, least texts of a band, least deviation as a share of the median.
SPREAD, LEAST, LEAST_SPREAD = 4.0, 30, 0.02
#: Steps of a unit of the ratio, and the largest ratio told apart, in the histogram.
STEPS, TOP = 256, 32
#: Bands of length start at half octaves, from the first fixed band up.
STARTS = [int(np.ceil(2 ** (k / 2))) for k in range(14, 80)]

#: What a text is judged by: its band (0: too short), and bands and ratios of its chunks where it has more than one.
PARTS = [
    StructField("n_bytes", LongType()),
    StructField("band", IntegerType()),
    StructField("chunk_bytes", ArrayType(IntegerType())),
    StructField("chunk_bands", ArrayType(IntegerType())),
    StructField("chunk_ratios", ArrayType(DoubleType())),
]

MEASURES = [
    StructField("n_words", LongType()),
    StructField("word_chars", LongType()),
    StructField("n_symbols", LongType()),
    StructField("n_dup_lines", LongType()),
    StructField("n_repeat_words", LongType()),
    StructField("base_failed", BooleanType()),
    StructField("kept", BooleanType()),
    StructField("ratio", DoubleType()),
    StructField("bad_chunks", DoubleType()),
    StructField("reason", StringType()),
]


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict = {}
    at = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # pairs are numbered first, so the key stays below n squared however many words there are
    _, pair = np.unique(at[:-1] * len(number) + at[1:], return_inverse=True)
    _, window, found = np.unique(pair[:-1] * len(number) + at[2:], return_inverse=True, return_counts=True)
    twice = found[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def base_measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    words = text.encode().split()  # on bytes: space, and tab to carriage return
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANK)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


_starts = [b[0] for b in BANDS]


def outside(n_bytes: int, ratio: float) -> str | None:
    k = bisect_right(_starts, n_bytes) - 1
    if k < 0:
        return None
    return "incompressible" if ratio < BANDS[k][1] else "repetitive" if ratio > BANDS[k][2] else None


def compression(data: bytes, compress) -> tuple[float | None, float, str | None]:
    """Ratio of the whole, share of bytes in chunks outside their band, and the verdict."""
    if not data:
        return None, 0.0, None
    ratio = len(data) / len(compress(data))
    view = memoryview(data)
    chunks = [c for i in range(0, len(data), CHUNK_BYTES) if len(c := view[i : i + CHUNK_BYTES]) >= _starts[0]]
    share = 0.0
    if len(chunks) > 1:
        share = sum(len(c) for c in chunks if outside(len(c), len(c) / len(compress(c)))) / sum(map(len, chunks))
    return ratio, share, outside(len(data), ratio) or ("chunks" if share > BAD_CHUNKS else None)


def band_of(n_bytes: int) -> int:
    return bisect_right(STARTS, n_bytes)


def _fixed(band: int, column: int) -> float:
    """The fixed limit of a half-octave band; each lies within one of `BANDS`."""
    k = bisect_right(_starts, STARTS[band - 1]) - 1 if band else -1
    return BANDS[k][column] if k >= 0 else (0.0, 0.0, float("inf"))[column]


@dataclass
class Limits:
    """Upper limits by band, of whole texts and of chunks, where they are not the fixed ones."""

    whole: dict[int, float] = field(default_factory=dict)
    chunk: dict[int, float] = field(default_factory=dict)


FIXED = Limits()


def measured(docs: DataFrame, text_col: str = "text", keep_columns: bool = True) -> DataFrame:
    """Columns of `docs` (without the text, if asked), the base measures, the ratio and `PARTS`; whole texts, no shuffle."""
    made = [f for f in MEASURES if f.name not in ("kept", "bad_chunks", "reason")] + PARTS
    kept = docs.drop(*[f.name for f in [*MEASURES, *PARTS]])
    out = [f for f in kept.schema.fields if keep_columns or f.name != text_col]
    schema = StructType([*out, *made])
    arrow = to_arrow_schema(schema)
    text_at, carried = kept.columns.index(text_col), [kept.columns.index(f.name) for f in out]
    at = len(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                rows = []
                for text in batch.column(text_at).to_pylist():
                    m = base_measures(text)
                    failed = m[0] < MIN_WORDS or 100 * m[4] > MAX_REPEAT_PERCENT * m[0]
                    data = (text or "").encode()
                    view = memoryview(data)
                    chunks = [c for i in range(0, len(data), CHUNK_BYTES) if len(c := view[i : i + CHUNK_BYTES]) >= _starts[0]]
                    chunks = chunks if len(chunks) > 1 else []
                    rows.append((*m, failed, len(data) / len(compress(data)) if data else None, len(data), band_of(len(data)),
                                 [len(c) for c in chunks], [band_of(len(c)) for c in chunks], [len(c) / len(compress(c)) for c in chunks]))
                new_columns = [pa.array(x, arrow.field(at + k).type) for k, x in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).cast(arrow.field(k).type) for k, c in enumerate(carried)], *new_columns], schema=arrow)

    return kept.mapInArrow(run, schema)


def _upper(pairs: DataFrame) -> dict[int, float]:
    """Limits by band from distinct (band, n_bytes, ratio): median and deviations of a histogram of some 4,000 steps a band."""
    step = F.least(F.floor(F.col("ratio") * STEPS), F.lit(TOP * STEPS)).cast("int")
    cells = pairs.distinct().groupBy("band", step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    limits: dict[int, float] = {}
    for band in sorted({c["band"] for c in cells}):
        at, n = (np.array(x) for x in zip(*sorted((c["step"], c["n"]) for c in cells if c["band"] == band), strict=True))
        if n.sum() < LEAST:
            continue
        middle = at[np.searchsorted(np.cumsum(n), n.sum() / 2)]
        away = np.abs(at - middle)
        order = np.argsort(away, kind="stable")
        spread = away[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]
        limits[int(band)] = float(middle + SPREAD * max(spread, LEAST_SPREAD * middle) + 1) / STEPS
    return {b: min(x, _fixed(b, 2)) for b, x in limits.items()}


def corpus_limits(rows: DataFrame) -> Limits:
    """Limits of measured rows, from those that pass the base rules; the driver gets the histograms, some 4,000 steps for each of 66 bands at most."""
    good = rows.where("not base_failed and band > 0")
    pair = F.explode(F.arrays_zip("chunk_bands", "chunk_bytes", "chunk_ratios"))
    chunks = good.select(pair.alias("c")).select(F.col("c.chunk_bands").alias("band"), F.col("c.chunk_bytes").alias("n_bytes"), F.col("c.chunk_ratios").alias("ratio"))
    return Limits(_upper(good.select("band", "n_bytes", "ratio")), _upper(chunks))


def _limit(band: Column, column: int, own: dict[int, float]) -> Column:
    values = [own.get(b, _fixed(b, column)) for b in range(len(STARTS) + 1)]
    return F.element_at(F.lit(values), band + 1)


def judged(docs: DataFrame, text_col: str = "text", keep_columns: bool = True, limits: Limits | None = None) -> DataFrame:
    """All columns of `docs` (or all but the text), the base measures and the verdict, by limits of this corpus unless some are given.

    The corpus's limits need all rows measured first, so these are written to
    the shared folder and read twice. `limits=FIXED` judges in one pass.
    """
    rows = measured(docs, text_col, keep_columns)
    if limits is None:
        rows = staged(rows, "quality")
        limits = corpus_limits(rows)
    low = lambda band: _limit(band, 1, {})
    high = lambda band, own: _limit(band, 2, own)
    each = F.arrays_zip("chunk_bands", "chunk_bytes", "chunk_ratios")
    odd = F.filter(each, lambda c: (c["chunk_ratios"] < low(c["chunk_bands"])) | (c["chunk_ratios"] > high(c["chunk_bands"], limits.chunk)))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, c: s + c["chunk_bytes"])
    share = F.when(F.size("chunk_bytes") > 0, total(odd) / total(each)).otherwise(F.lit(0.0))
    why = F.when(F.col("ratio") < low(F.col("band")), "incompressible").when(F.col("ratio") > high(F.col("band"), limits.whole), "repetitive")
    rows = rows.withColumn("bad_chunks", share)
    why = F.when(F.col("base_failed"), "base").otherwise(F.coalesce(why, F.when(F.col("bad_chunks") > BAD_CHUNKS, "chunks")))
    rows = rows.withColumn("reason", why).withColumn("kept", F.col("reason").isNull())
    result = [f.name for f in MEASURES]
    return rows.select(*[c for c in rows.columns if c not in result and c not in [f.name for f in PARTS]], *result)
