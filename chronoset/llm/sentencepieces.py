"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut into chunks that no vocabulary piece crosses: a run of spaces
with the word behind it, and a line break where no longer piece holds one.
Each chunk is merged on its own by a score-ordered agenda of adjacent symbol
pairs: the best scored pair first, the leftmost of equals, entries that an
earlier merge outdated are skipped, and a merge puts the two new neighbour
pairs on the agenda. Symbols outside the vocabulary fall back to bytes. The
agenda of a short chunk is a list of scores, that of a long one a heap, so n
symbols take n log n steps.

Chunks repeat, so a task keeps a bounded table of short ones; each chunk is
checked against the sentencepiece library, in one call per Arrow batch, when
it enters the table, and `check="texts"` checks whole texts as well. A
difference fails the task.

Defined results: NULL text counts as empty, an empty text has no ids and
decodes to an empty text; other columns pass through, NULL or not; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

SPACE = "▁"
TABLE_SIZE = 800_000
TABLE_CHARS = 48
#: Chunks of so many symbols or fewer are merged by scans.
SHORT = 40
NONE = float("-inf")
#: Rows of one output batch.
ROWS = 512


class Pieces:
    """The vocabulary of a merge-type model, its agenda encoder and its decoder."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = range(self.lib.get_piece_size())
        if any(self.lib.is_unused(i) for i in n):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.piece = [self.lib.id_to_piece(i) for i in n]
        self.byte = {i: int(self.piece[i][1:-1], 16) for i in n if self.lib.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        self.silent = {i for i in n if self.lib.is_control(i)}
        self.unknown = self.lib.unk_id()
        self.ids = {self.piece[i]: i for i in n if i not in self.byte and i not in self.silent and i != self.unknown}
        self.score = {p: self.lib.get_score(i) for p, i in self.ids.items()}
        self.plain = {i: p.replace(SPACE, " ") for p, i in self.ids.items()}
        self.spaced = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        longer = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("a piece goes on behind a space: texts cannot be cut at spaces")
        joined = set().union(*longer)
        word = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        self.chunks = re.compile(word if "\n" in joined else f"\n|{word.replace('[^', '[^' + chr(10))}").findall
        #: Chunks with the bytes of their ids, and the surface of those that decode to something else.
        self.table: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk (spaces already written as the space sign)."""
        symbols = self.merged_long(chunk) if len(chunk) > SHORT else self.merged_short(chunk)
        out: list[int] = []
        ids = self.ids
        for x in symbols:
            if (k := ids.get(x)) is None:
                out += self.spelled(x)
            else:
                out.append(k)
        return out

    def merged_short(self, chunk: str) -> list[str]:
        """The agenda as one list, a score for each adjacent pair: the best is found by a scan."""
        symbols = list(chunk)
        get = self.score.get
        agenda = [get(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := max(agenda)) != NONE:
            i = agenda.index(best)  # the leftmost
            symbols[i : i + 2] = [both := symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i:
                agenda[i - 1] = get(symbols[i - 1] + both, NONE)
            if i < len(agenda):
                agenda[i] = get(both + symbols[i + 1], NONE)
        return symbols

    def merged_long(self, chunk: str) -> list[str]:
        """The agenda as a heap: n log n steps for n symbols."""
        symbols: list[str] = list(chunk)
        n = len(symbols)
        before, behind = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, int]] = []
        score = self.score

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (s := score.get(both := symbols[i] + symbols[j])) is not None:
                heapq.heappush(agenda, (-s, i, j, len(both)))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the two has been merged since
            symbols[i] += symbols[j]
            symbols[j] = ""
            behind[i] = behind[j]
            if behind[j] >= 0:
                before[behind[j]] = i
            offer(before[i], i)
            offer(i, behind[i])
        return [x for x in symbols if x]

    def spelled(self, symbol: str) -> list[int]:
        return [self.byte_id[b] for b in symbol.encode()] if self.byte_id else [self.unknown]

    def surface(self, ids) -> str:
        """The text of ids, the leading space included."""
        try:
            return "".join([self.plain[i] for i in ids])
        except KeyError:
            pass  # bytes, control or unknown pieces
        out: list[str] = []
        run = bytearray()

        def close() -> None:
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + width].decode())
                    except UnicodeDecodeError:
                        continue
                    at += width
                    break
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if (b := self.byte.get(i)) is not None:
                run.append(b)
                continue
            if run:
                close()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.plain[i])
        if run:
            close()
        return "".join(out)

    def decode(self, ids) -> str:
        first = next((i for i in ids if i not in self.silent), None)
        text = self.surface(ids)
        return text[1:] if first in self.spaced else text

    def cut(self, text: str) -> list[str]:
        return self.chunks(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Encode chunks, hold all of them against the library, and keep the short ones."""
        spaced = [c for c in chunks if c[0] == SPACE and c != SPACE]
        other = [c for c in chunks if c[0] != SPACE]  # they stand behind a character that joins nothing
        extra = [self.ids[SPACE]] if SPACE in self.ids else self.spelled(SPACE)
        # the library writes a space sign of its own before each text, and an empty text has no ids
        right = dict(zip(spaced, self.lib.encode([c[1:] for c in spaced]), strict=True)) if spaced else {}
        if other:
            right |= {c: ids[len(extra) + 1 :] for c, ids in zip(other, self.lib.encode(["\n" + c for c in other]), strict=True)}
        if SPACE in chunks:
            right[SPACE] = extra
        got = {}
        for c, lib in right.items():
            ids = self.merge(c)
            if ids != lib:
                raise ValueError(f"chunk {c!r}: {ids} here, {lib} by the library")
            if (text := self.surface(ids)) != c.replace(SPACE, " "):
                self.odd[c] = text
            got[c] = array("i", ids).tobytes()
        self.table.update((c, v) for c, v in got.items() if len(c) <= TABLE_CHARS)
        return got

    def encode_batch(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """For each text its ids and its decoded form."""
        cut = [self.cut(t) for t in texts]
        if len(self.table) > TABLE_SIZE:
            self.table.clear()
            self.odd.clear()
        table = self.table
        new = set(chain.from_iterable(cut)).difference(table)
        got = self.learn(new) if new else {}
        ids, decoded = [], []
        for text, chunks in zip(texts, cut, strict=True):
            try:
                found = [table[c] for c in chunks]
            except KeyError:  # a long chunk
                found = [table.get(c) or got[c] for c in chunks]
            ids.append(np.frombuffer(b"".join(found), np.int32))
            # every chunk's ids were decoded when it was learned
            decoded.append("".join([self.odd.get(c) or c.replace(SPACE, " ") for c in chunks])[1:] if self.odd else text.replace(SPACE, " "))
        return ids, decoded


_loaded: dict[str, Pieces] = {}


def loaded(model_path: str) -> Pieces:
    """The vocabulary of this process."""
    if model_path not in _loaded:
        _loaded[model_path] = Pieces(model_path)
    return _loaded[model_path]


def encoded(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded", check: str = "chunks", keep_text: bool = True) -> DataFrame:
    """All columns of `docs` (the text only if kept), ids array<int>, and the text that decoding them gives.

    `model_path` must exist on every executor. Columns named like the new ones are replaced.
    """
    kept = docs.drop(ids_col, decoded_col)
    passed = [f for f in kept.schema.fields if keep_text or f.name != text_col]
    carried = [kept.columns.index(f.name) for f in passed]
    schema = StructType([*passed, StructField(ids_col, ArrayType(IntegerType(), False)), StructField(decoded_col, StringType())])
    arrow = to_arrow_schema(schema)
    text_at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model_path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [t or "" for t in batch.column(text_at).to_pylist()]
                flat, decoded = pieces.encode_batch(texts)
                if check == "texts":
                    for t, mine, lib, back, text in zip(texts, flat, pieces.lib.encode(texts), decoded, pieces.lib.decode([x.tolist() for x in flat]), strict=True):
                        if mine.tolist() != lib or back != text:
                            raise ValueError(f"text {t[:80]!r} differs from the library")
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
                values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32))
                column = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_arrays([*[batch.column(c).cast(arrow.field(k).type) for k, c in enumerate(carried)], column.cast(arrow.field(ids_col).type), pa.array(decoded, arrow.field(decoded_col).type)], schema=arrow)

    return kept.mapInArrow(run, schema)


def digests(rows: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded rows."""
    ids = F.col(ids_col)
    return rows.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256).alias("ids_sha256"), F.sha2(F.col(decoded_col), 256).alias("decoded_sha256"))
