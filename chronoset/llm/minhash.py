"""MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates.

A document is the set of its distinct 5-word shingles. Documents with equal
sets form a class, named by its smallest id, and only classes go on. One hash
of each shingle fills 128 bins (one permutation); an empty bin takes the value
of the first filled bin in a random order of its own (optimal densification).
32 bands of 4 bins make buckets: a pair of similarity 0.75 shares none with
probability (1 - 0.75^4)^32, five in a million, and a more similar pair still
less often.

In a bucket each class is paired with the bucket's first one only, so pairs are
at most classes times bands. Pairs are confirmed on full shingle sets, links
are joined to components. A bucket whose classes then lie in several
components may hide links between them. Only shingles found in several
components can make such a link; counting them rules out nearly all classes.
Buckets with more than a block of classes left repeat the star round with new
centres, as long as that closes classes. What is left outside a bucket's
largest component is held against the bucket's classes on full sets, in blocks
of both sides, so a task holds two blocks at most. No link within a bucket is
lost. Rounds cost a few pairs a class; classes that share their shingles but
are near none still cost the square of their number over the block size.

Defined results: NULL and blank texts have an empty set and are linked with
nothing; rows with one id count as one document and share its verdict; a row
with NULL id is part of its class but names none; a class of such rows alone
stays by itself, component NULL; a very long text is one set of all its shingles; of
other columns `near_groups` reads none and `drop_near_copies` keeps all; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoset.llm.common import staged
from chronoset.llm.components import components

SHINGLE = 5
#: Least similarity in percent.
PERCENT = 75
BINS, BAND_ROWS = 128, 4
#: Classes of a bucket that a task holds of either side.
BLOCK = 1000
#: Most star rounds over open classes, and the rounds in a row that may close less than a twentieth of them.
STAR_ROUNDS, IDLE_ROUNDS = 12, 2
HASHED_WORDS = 500_000
KEPT_SETS = 64
ROWS = 1024

_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


class _Words(dict):
    """64-bit hashes of words, bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > HASHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _MIX[1]
    h = (h ^ (h >> _U(27))) * _MIX[2]
    return h ^ (h >> _U(31))


def words_of(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased; on bytes, so white space is the space, and tab to carriage return."""
    return (text or "").encode().lower().split()


def rolled(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of `size` word hashes."""
    n = len(w) - size + 1
    h = np.full(n, size, _U)
    for k in range(size):
        h = mixed((h ^ w[k : n + k]) + _MIX[0])
    return h


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """For each whole text the sorted distinct 64-bit hashes of its shingles."""
    words = [words_of(t) for t in texts]
    sizes = [len(x) for x in words]
    flat = np.fromiter(map(_words.__getitem__, chain.from_iterable(words)), _U, sum(sizes))
    windows = rolled(flat, size) if len(flat) >= size else None
    out, at = [], 0
    for n in sizes:
        if n >= size:
            out.append(np.unique(windows[at : at + n - size + 1]))
        elif n:
            out.append(rolled(flat[at : at + n], n))
        else:
            out.append(np.zeros(0, _U))
        at += n
    return out


def _orders() -> np.ndarray:
    """For each bin, a random order of all bins."""
    rng = np.random.Generator(np.random.PCG64(5))
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


ORDERS = _orders()
_SHIFT = _U(64 - BINS.bit_length() + 1)
_edges = np.arange(BINS, dtype=_U) << _SHIFT
_bins = np.arange(BINS, dtype=_U)
_turns = mixed(np.arange(1, BINS // BAND_ROWS + 1, dtype=_U) * _MIX[0])


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin of a sorted non-empty set, empty bins densified."""
    first = np.minimum(np.searchsorted(hashes, _edges), len(hashes) - 1)
    value = hashes[first]
    full = (value >> _SHIFT) == _bins
    if not full.all():
        empty = np.flatnonzero(~full)
        orders = ORDERS[empty]
        value[empty] = value[orders[np.arange(len(empty)), full[orders].argmax(1)]]
    return value


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket numbers of non-empty sets, a row for each set and a column for each band."""
    rows = np.stack([signature(s) for s in sets]).reshape(len(sets), -1, BAND_ROWS)
    h = np.broadcast_to(_turns, rows.shape[:2])
    for k in range(BAND_ROWS):
        h = mixed((h ^ rows[:, :, k]) + _MIX[0])
    return h.view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest of the set (NULL if empty) and its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sets = shingle_sets(batch.column(1).to_pylist())
                filled = [s for s in sets if len(s)]
                digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                flat = bands(filled).ravel() if filled else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum([BINS // BAND_ROWS if len(s) else 0 for s in sets])]).astype(np.int32)
                buckets = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), buckets], names=["doc_id", "n_shingles", "digest", "buckets"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, n_shingles long, digest binary, buckets array<long>")


def similar(n_a, n_b, common) -> bool:
    return 100 * common >= PERCENT * (n_a + n_b - common)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. `texts`: node, text."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[str, np.ndarray] = OrderedDict()

        def of(text: str) -> np.ndarray:
            if (s := kept.get(text)) is None:
                kept[text] = s = shingle_sets([text])[0]
                if len(kept) > KEPT_SETS:
                    kept.popitem(last=False)
            else:
                kept.move_to_end(text)
            return s

        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = of(x), of(y)
                ok.append(similar(len(s), len(t), len(np.intersect1d(s, t, assume_unique=True))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # the members' texts first, then the centres', which may be hot: that join comes out sorted by centre and can be split
    return pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _shingled(texts: DataFrame) -> DataFrame:
    """One row for each shingle of each node: texts' columns but the text, and shingle."""
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sets = shingle_sets(batch.column(0).to_pylist())
                of = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
                flat = np.concatenate([np.zeros(0, _U), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), *[batch.column(k + 1).take(of) for k in range(len(kept))]], names=["shingle", *kept])

    return texts.select("text", *kept).mapInArrow(run, "shingle long, " + ", ".join(f"{c} long" for c in kept))


def _open_places(shared: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Places (bucket, node, n, root, used, most) of buckets over several components, without nodes that no link can leave.

    Only shingles found in several components can make a link between
    components, and `most` counts them for each node outside its bucket's
    largest component (NULL within it). Of a link's two sets that is at least
    3/7 of both sizes together, so at least 3/4 of one's own.
    """
    at = shared.join(labels, "node", "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("root"), "used")
    several = at.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    at = staged(at.join(several, "bucket", "left_semi"), "open-buckets")
    largest = at.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("bucket").agg(F.max(F.struct("size", "root")).alias("m")).select("bucket", F.col("m.root").alias("main"))
    at = at.join(largest, "bucket").withColumn("outside", F.col("root") != F.col("main")).drop("main")
    nodes = staged(at.groupBy("node").agg(F.min("root").alias("root"), F.max("outside").alias("outside")), "open-nodes")
    own = texts.join(nodes, "node")
    common = _shingled(own.select("text", "root")).groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle")
    most = _shingled(own.where("outside").select("text", "node")).join(common, "shingle", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("most"))
    at = at.join(staged(most, "open-shingles"), "node", "left").withColumn("most", F.when(F.col("outside"), F.coalesce("most", F.lit(0))))
    return staged(at.where("not outside or 100 * most >= 75 * n").drop("outside"), "open-places")


def _with_sets(texts: DataFrame) -> DataFrame:
    """node and the bytes of its set, for texts (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sets = [x.tobytes() for x in shingle_sets(batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def _linked_to(seekers: list[tuple], members: list[tuple]) -> tuple[list[int], list[int]]:
    """Links between seekers and members (node, root, set) of other components."""
    a: list[int] = []
    b: list[int] = []
    roots = np.array([m[1] for m in members])
    nodes = np.array([m[0] for m in members])
    sizes = np.array([len(m[2]) for m in members])
    known, place = np.unique(np.concatenate([m[2] for m in members]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for node, root, own in seekers:
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        mine = np.zeros(len(known), np.int32)
        mine[at[known[at] == own]] = 1
        common = np.add.reduceat(mine[place], starts)
        for other in nodes[(roots != root) & (100 * common >= PERCENT * (len(own) + sizes - common))].tolist():
            a.append(min(node, other))
            b.append(max(node, other))
    return a, b


def _parts(places: DataFrame) -> DataFrame:
    """Components within buckets: size, places that are not used (a used place was a centre, so it has met its whole bucket), and of these the one with the most shared shingles."""
    share = F.coalesce(F.col("most") / F.col("n"), F.lit(1.0))
    best = F.max(F.when(~F.col("used"), F.struct(share.alias("share"), F.xxhash64("node").alias("tie"), "node", "n")))
    return places.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"), F.count(F.when(~F.col("used"), 1)).alias("free"), best.alias("best"))


def _seeking(parts: DataFrame) -> DataFrame:
    """Buckets with links left to look for: the component `main`, outside which all unused places seek; `members` and `open` count the unused places and those that seek."""
    buckets = parts.groupBy("bucket").agg(F.max(F.struct("free", "size", "root")).alias("m"), F.sum("free").alias("members"))
    return buckets.select("bucket", F.col("m.root").alias("main"), "members", (F.col("members") - F.col("m.free")).alias("open")).where("open > 0")


def _centres(parts: DataFrame, buckets: DataFrame) -> DataFrame:
    """New centres of each bucket: of its main component, of the largest one outside, and the outside class with the most shared shingles."""
    at = parts.where("free > 0").join(buckets.select("bucket", "main"), "bucket")
    inside, node = F.col("root") == F.col("main"), (F.col("best.node").alias("centre"), F.col("best.n").alias("centre_n"), F.col("root").alias("centre_root"))
    by_size, by_share = F.struct("size", "best", F.struct(*node).alias("c")), F.struct("best", "size", F.struct(*node).alias("c"))
    picked = at.groupBy("bucket").agg(F.max(F.when(inside, by_size)).alias("x"), F.max(F.when(~inside, by_size)).alias("y"), F.max(F.when(~inside, by_share)).alias("z"))
    return picked.select("bucket", F.inline(F.array("x.c", "y.c", "z.c"))).distinct()


def _starred(places: DataFrame, texts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Star rounds over buckets with more than a block of classes: the places left with their new roots, and the links found."""
    links: list[DataFrame] = []
    idle, before = 0, None
    for _ in range(STAR_ROUNDS):
        parts = staged(_parts(places), "star-parts")
        buckets = staged(_seeking(parts).where(F.col("members") > BLOCK), "star-buckets")
        left = buckets.agg(F.sum("open")).first()[0] or 0
        idle = idle + 1 if before is not None and 20 * left > 19 * before else 0
        if not left or idle >= IDLE_ROUNDS:
            break
        before = left
        centres = staged(_centres(parts, buckets), "star-centres")
        fits = f"100 * least(n, centre_n) >= {PERCENT} * greatest(n, centre_n)"
        met = places.where("not used").join(centres, "bucket").where(f"root <> centre_root and {fits}")
        pairs = staged(met.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "star-pairs")
        found = staged(confirmed(pairs, texts), "star-links")
        links.append(found)
        root = places.select("node", "root").distinct()
        joined = found.join(root.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(root.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        to = components(joined.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("upper"))
        was = centres.select("bucket", F.col("centre").alias("node"), F.lit(True).alias("now"))
        moved = places.join(to, "root", "left").join(was, ["bucket", "node"], "left")
        places = staged(moved.select("bucket", "node", "n", F.coalesce("upper", "root").alias("root"), (F.col("used") | F.coalesce("now", F.lit(False))).alias("used"), "most"), "open-places")
    return places, links


def _in_blocks(rows: DataFrame, total: str, name: str) -> DataFrame:
    """Add the block of each row of a bucket, `BLOCK` rows at most, none numbered over the whole bucket."""
    blocks = F.ceil(F.col(total) / BLOCK)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), blocks)).withColumn("blocks", blocks)
    place = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("node")) - 1
    return rows.withColumn(name, (F.col("part") + F.col("blocks") * F.floor(place / BLOCK)).cast("long")).drop("part", "blocks")


def _hidden_links(shared: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components within a bucket that the first stars have not compared.

    After the star rounds every class that still seeks is held against the
    bucket's classes, on full sets. Both sides are cut into blocks of at most
    `BLOCK` classes, a group for each pair of blocks, so only found links leave
    a task and no pair is ever a row.
    """
    used = (F.col("node") == F.col("centre")).alias("used")
    places, links = _starred(_open_places(shared.where("members > 2").select("bucket", "node", "n", used), labels, texts), texts)
    left = places.where("not used").join(_seeking(_parts(places)), "bucket").withColumn("seeks", F.col("root") != F.col("main"))
    cut = staged(_in_blocks(left, "members", "block"), "open-blocks")
    seekers = staged(_in_blocks(cut.where("seeks").drop("block"), "open", "seeker_block"), "open-seekers")
    key = ["bucket", "seeker_block", "block"]
    members = cut.select("bucket", "block", "node", "root").join(seekers.select("bucket", "seeker_block").distinct(), "bucket").select(*key, "node", "root", F.lit(False).alias("seeks"))
    seekers = seekers.select("bucket", "seeker_block", "node", "root").join(cut.select("bucket", "block").distinct(), "bucket").select(*key, "node", "root", F.lit(True).alias("seeks"))
    sets = staged(_with_sets(texts.join(cut.select("node").distinct(), "node", "left_semi")), "open-sets")

    def compare(group: pa.Table) -> pa.Table:
        rows = zip(*[group.column(c).to_pylist() for c in ("seeks", "node", "root", "shingles")], strict=True)
        sides: dict[bool, list[tuple]] = {True: [], False: []}
        for seeks, node, root, data in rows:
            sides[seeks].append((node, root, np.frombuffer(data, _U)))
        a, b = _linked_to(sides[True], sides[False]) if sides[True] and sides[False] else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = members.unionByName(seekers).join(sets, "node")
    found = rows.groupBy(*key).applyInArrow(compare, "a long, b long")
    for more in links:
        found = found.unionByName(more)
    return found.distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    signed = staged(signatures(docs, id_col, text_col), "signatures")
    filled = signed.where("digest is not null")
    classes = staged(filled.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")), "classes")
    places = classes.where("node is not null").select("node", "n", F.explode("buckets").alias("bucket"))
    stars = places.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = staged(places.join(stars, "bucket").select("bucket", "node", "n", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n"), "members"), "shared-buckets")
    fits = f"100 * least(n, centre_n) >= {PERCENT} * greatest(n, centre_n)"
    pairs = staged(shared.where(f"node <> centre and {fits}").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "pairs")

    ends = shared.select("node").distinct()
    wanted = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).where("text is not null").join(ends, "node", "left_semi")
    # repeated rows give one text
    texts = staged(wanted.groupBy("node", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).drop("h"), "candidate-texts")

    links = staged(confirmed(pairs, texts), "links")
    labels = staged(components(links), "labels")
    hidden = staged(_hidden_links(shared, labels, texts), "hidden-links")
    if not hidden.isEmpty():
        labels = staged(components(links.unionByName(hidden)), "labels")

    named = classes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("root", "node").alias("component"))
    out = signed.drop("buckets").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns: one document of each group. Rows without an id stay."""
    gone = near_groups(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__id"), "left_anti")
