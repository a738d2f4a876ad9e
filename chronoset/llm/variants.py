"""Spelling variants of the words of a corpus, by pivotal bigrams.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. All near pairs of the vocabulary are found without comparing
all pairs:

1. bigrams are ordered by the number of places they have in the vocabulary,
   rarest first. One edit destroys at most two bigrams of a word, so of its
   three first in that order one survives: they are its prefix (with all
   bigrams that tie with the third);
2. one edit destroys at most one of two bigrams that share no letter. A
   word's two pivots are such a pair from its prefix, the one with the fewest
   places together, chosen by dynamic programming;
3. of two near words let s be the one whose prefix ends first. A pivot of s
   survives in the other word, and, no later in the order than the end of
   that word's prefix, lies in that prefix. So pivots are joined to prefixes;
4. position limits: a surviving pivot keeps its distance from the word's
   start if the edit lies behind it, with all letters before it, or from the
   word's end if the edit lies before it. Either side, up to and with the
   bigram, is a join key, with the length, which differs by one at most;
5. what the join finds is verified by edit distance, in the join itself.

A word's form is its near word of largest count if that is `RATIO` times its
own; the root follows the forms to the last. Counts grow at each step, so a
chain has at most log(count)/log(RATIO) words; links are doubled until none
changes.

Words are counted by a grouped count with a partial step, so a word that makes
up a third of all runs is one row a task. The vocabulary, its keys and its
pairs stay in tables; a hot key's rows are streamed by the join, not gathered.
Only the counts of bigrams reach the driver: at most 90 letters squared.

Defined results: NULL and empty texts have no words, a very long text is read
whole; a NULL id counts as an empty one; repeated rows count one by one; ties
for the form go to the smallest word by code points; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoset.llm.common import staged

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
#: One in so many runs loses a letter (the query's own misspellings).
SLIP = 199
EDITS = 1
GRAM = 2


def runs_of(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row for each run of letters of `MIN_LETTERS` or more: id and run, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS})"), F.lit(1))
    runs = docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run"))
    return runs.where(F.char_length("run") >= MIN_LETTERS).select("id", F.translate("run", UPPER, LOWER).alias("run"))


def slipped(runs: DataFrame) -> Column:
    """The run, without one letter where the checksum of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return F.when(h % SLIP == 0, cut).otherwise(F.col("run"))


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT, min_letters: int = MIN_LETTERS) -> DataFrame:
    """word and n of all words with enough letters and places."""
    long = words.where(F.char_length("word") >= min_letters)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def gram_places(vocab: DataFrame) -> dict[str, int]:
    """Places of each bigram in the vocabulary; as many rows as pairs of letters at most."""
    grams = vocab.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substr(F.col("word"), i, F.lit(GRAM)))).alias("gram"))
    return {r["gram"]: r["count"] for r in grams.groupBy("gram").count().collect()}


def prefix_of(word: str, places: dict[str, int]) -> tuple[list[int], tuple[int, str]]:
    """Positions of a word's prefix bigrams, and where the prefix ends in the order of bigrams."""
    order = [(places[word[i : i + GRAM]], word[i : i + GRAM]) for i in range(len(word) - GRAM + 1)]
    last = sorted(order)[GRAM * EDITS]
    return [i for i, x in enumerate(order) if x <= last], last


def pivots_of(word: str, prefix: list[int], places: dict[str, int]) -> list[int]:
    """Positions of `EDITS` + 1 bigrams of the prefix without a common letter and with the fewest places together.

    best[j] is, over the bigrams seen so far, the cheapest choice of j of them;
    a bigram extends the best choices among those that end before it starts.
    """
    best: list[list] = [[(0, ())] + [None] * (EDITS + 1)]
    for k, p in enumerate(prefix):
        free = max(i for i in range(k + 1) if i == 0 or prefix[i - 1] + GRAM <= p)
        row = list(best[k])
        for j in range(1, EDITS + 2):
            before = best[free][j - 1]
            if before is not None:
                more = (before[0] + places[word[p : p + GRAM]], (*before[1], p))
                row[j] = more if row[j] is None else min(row[j], more)
        best.append(row)
    return list(best[-1][EDITS + 1][1])


KEYS = "key string, size int, end_places long, end_gram string, word string, n long"


def _keys(vocab: DataFrame, places: dict[str, int], pivots: bool) -> DataFrame:
    """Join keys of the words: of their pivots, for each length a near word may have, or of their prefixes."""
    lengths = (-EDITS, 0, EDITS) if pivots else (0,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                prefix, last = prefix_of(word, places)
                for p in pivots_of(word, prefix, places) if pivots else prefix:
                    for key in (word[: p + GRAM] + "-", "-" + word[p:]):
                        rows += [(key, len(word) + d, *last, word, n) for d in lengths]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["key", "size", "end_places", "end_gram", "word", "n"])

    return vocab.select("word", "n").mapInArrow(run, KEYS)


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Every pair of words one edit apart, once: a, b with a < b, and their counts."""
    places = gram_places(vocab)
    s, r = _keys(vocab, places, True).alias("s"), _keys(vocab, places, False).alias("r")
    ends = (F.col("s.end_places") < F.col("r.end_places")) | (
        (F.col("s.end_places") == F.col("r.end_places")) & (F.col("s.end_gram") <= F.col("r.end_gram")))
    near = F.levenshtein(F.col("s.word"), F.col("r.word"), EDITS) == EDITS
    met = s.join(r, (F.col("s.key") == F.col("r.key")) & (F.col("s.size") == F.col("r.size")) & ends & near)
    one, two = F.struct(F.col("s.word").alias("w"), F.col("s.n").alias("n")), F.struct(F.col("r.word").alias("w"), F.col("r.n").alias("n"))
    both = met.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y"))
    return both.distinct().select(F.col("x.w").alias("a"), F.col("x.n").alias("a_n"), F.col("y.w").alias("b"), F.col("y.n").alias("b_n"))


def rooted(links: DataFrame) -> DataFrame:
    """word and root of a table of word and form: each form is followed by its own, twice as far each round."""
    reach = staged(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = staged(reach.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        reach = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            return reach


def grouped(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of a vocabulary (word, n)."""
    vocab = staged(vocab, "variant-words")
    pairs = staged(near_pairs(vocab), "variant-pairs")
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("p")).select("p.*")
    # largest count, then smallest word: min over (-count, word)
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best"))
    rows = vocab.join(best, "word", "left")
    far = -F.col("best.m") >= ratio * F.col("n")
    rows = rows.select("word", F.when(far, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(far, -F.col("best.m")).alias("form_n"))
    rows = staged(rows, "variant-forms")
    roots = rooted(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """The groups of a table of documents, misspellings planted."""
    runs = runs_of(docs)
    return grouped(vocabulary(runs.select(slipped(runs).alias("word"))))
