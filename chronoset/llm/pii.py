"""Personal data: fixed patterns, and weak supervision for spans that no pattern settles.

Base spans (email, ip, card, phone) come from their patterns and checks. For
further kinds (secret, number, name) a loose pattern proposes candidates;
regex, gazetteer and context labelers vote yes, no or nothing on each; expectation-
maximisation estimates how reliable each labeler is, from the counts of vote
patterns over all documents, and so how likely each candidate is; and a naive
Bayes classifier of the span's own features is trained on these likelihoods.
It decides which candidates become spans. Base spans always stay, and a
candidate that overlaps one is left out.

The text is read once: matches go to a staged table. The estimation runs on the
counts of vote patterns, the classifier's training on one row per vote and
feature pattern; both numbers are bounded by labelers and features, not by the
data. All of it is column expressions.

The patterns are written so that a match takes linear time and no deep
recursion: a run is entered at its start only, and taken whole.

Defined results: NULL text counts as empty and has no spans; places are code
points; rows are judged one by one, repeated or not; columns other than id and
text are ignored; without candidates only base spans are returned; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoset.llm.common import staged

BASE = ("email", "ip", "card", "phone")
MORE = ("name", "number", "secret")

_label = "[A-Za-z0-9-]"
#: Equal in effect to the plain patterns, leftmost and not overlapping.
PATTERNS = {
    "email": rf"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@(?={_label}++\.{_label}){_label}(?:[A-Za-z0-9.-](?<={_label}|{_label}\.(?={_label})))*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}+",
    "number": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?[0-9]{3}|[0-9]{3}[ .-][0-9]{3}|[0-9]{3}-[0-9]{2})[ .-][0-9]{4}(?![0-9])",
    "name": r"(?<!\p{L})\p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++){1,2}(?!\p{L})",
}
FIRST_NAMES = (
    "Alice Andrew Anna Anne Antonio Barbara Carlos Carmen Charles Christine Claire Daniel David Elena Elizabeth Emma "
    "Francisco François George Hans Helen Isabelle James Jean Jennifer Jessica Johann John José Juan Julia Karen Karl "
    "Klaus Laura Linda Lucía Luis Manuel Margaret Maria María Marie Mark Martin Mary Michael Michel Monika Nicolas "
    "Patricia Paul Peter Petra Philippe Pierre Richard Robert Sarah Sophie Stefan Susan Thomas Ursula William Wolfgang"
).split()
STOP_WORDS = "A An And Are As At By De Der Des Die Das De El En Est Et For From He In Is It La Las Le Les Los Of On Or Para Por Que The That This To Un Una Une Und Was With".split()
YES_BEFORE = {
    "secret": r"(?i)(?:token|secret|key|passw(?:or)?d|pwd|auth|bearer|credential)[\w\"']{0,8}\s*[=:]?\s*[\"']?$",
    "number": r"(?i)(?:tel|phone|call|fax|mobile|cell|ssn|social security)\b[^\n]{0,12}$",
    "name": r"(?i)\b(?:mr|mrs|ms|dr|prof|herr|frau|señora?|madame|monsieur|dear|contact|name|by)\b\.?:?\s*$",
}
NO_BEFORE = {
    "secret": r"(?i)(?:sha-?[0-9]*|md5|commit|checksum|digest|uuid|version)\W{0,4}$",
    "number": r"(?i)(?:order|invoice|isbn|issn|page|version|no)\W{0,4}$",
    "name": r"[.!?]\s*$",
}
KEY_PREFIX = r"^(?:sk-|pk_|ghp_|gho_|AKIA|ASIA|xox[bp]-|AIza|eyJ)"
LABELERS = 5
BEFORE, AFTER = 24, 8
ROUNDS = 20


def matches(kind: str, hits: Column, text: Column, pattern: str) -> Column:
    """All matches in order: kind, number, length of the gap before, text, and what stands before and after."""
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"), F.slice(gaps, 2, F.size(hits)).alias("next"))

    def one(x: Column, i: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["gap"]).alias("gap"), x["hit"].alias("t"), F.right(x["gap"], F.lit(BEFORE)).alias("b"), F.left(x["next"], F.lit(AFTER)).alias("a"))

    none = F.array().cast("array<struct<kind:string,i:int,gap:int,t:string,b:string,a:string>>")
    return F.when(F.size(hits) > 0, F.transform(zipped, one)).otherwise(none)


def digits_of(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    d = digits_of(t)

    def digit(i: Column) -> Column:
        x = F.substr(d, F.length(d) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d) - 1), digit), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        return t.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return luhn(t)
    if kind == "phone":
        return F.length(digits_of(t)).between(8, 15)
    return F.lit(True)


def votes(kind: str, x: dict[str, Column]) -> Column:
    """1 yes, 0 no, -1 nothing: shape, gazetteer, context before, context around, variety."""
    t, b, a = x["t"], x["b"], x["a"]
    yes, no, nothing = F.lit(1), F.lit(0), F.lit(-1)
    first = F.substring_index(t, " ", 1)
    different = F.size(F.array_distinct(F.split(t, "")))
    shape, known, around, variety = {
        "secret": (
            F.when(t.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$") | t.rlike("^(?=[^a-z]*+[a-z])(?=[^A-Z]*+[A-Z])[^0-9]*+[0-9][^0-9]*+[0-9]"), yes).when(t.rlike("^[^-_]*+[-_][^-_]*+[-_]"), no).otherwise(nothing),
            F.when(t.rlike(KEY_PREFIX), yes).otherwise(nothing),
            F.when(b.rlike("[\"'=:]\\s?$") & a.rlike("^[\"']"), yes).when(a.rlike(r"^\.[a-z]"), no).otherwise(nothing),
            F.when(different >= 9, yes).otherwise(no),
        ),
        "number": (
            F.when(t.rlike(r"^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), yes).otherwise(no),
            F.when(t.rlike(r"^\(?[2-9]"), yes).otherwise(no),
            F.when(a.rlike("^[/%.-]?[0-9]"), no).otherwise(nothing),
            F.when(different >= 6, yes).otherwise(no),
        ),
        "name": (
            F.when(t.rlike(r"^\p{L}{3,} \p{L}{3,}$"), yes).otherwise(nothing),
            F.when(first.isin(FIRST_NAMES), yes).when(first.isin(STOP_WORDS), no).otherwise(nothing),
            F.when(a.rlike("^(?:, | said| told| wrote)"), yes).otherwise(nothing),
            F.when(F.substring_index(t, " ", -1).isin(STOP_WORDS), no).otherwise(nothing),
        ),
    }[kind]
    before = F.when(b.rlike(YES_BEFORE[kind]), yes).when(b.rlike(NO_BEFORE[kind]), no).otherwise(nothing)
    return F.array(shape, known, before, around, variety)


def features(kind: str, x: dict[str, Column]) -> Column:
    """What the span classifier sees: a few categories of the span and its neighbours."""
    t, b, a = x["t"], x["b"], x["a"]
    share = lambda cls: F.round(4 * F.length(F.regexp_replace(t, f"[^{cls}]", "")) / F.length(t)).cast("int").cast("string")
    last = F.regexp_extract(b, r"(\p{L}{2,12})[^\p{L}]*$", 1)
    return F.array(
        F.concat(F.lit("length "), F.least(F.length(t) / 8, F.lit(9)).cast("int").cast("string")),
        F.concat(F.lit("digits "), share("0-9")),
        F.concat(F.lit("capitals "), share("A-Z")),
        F.concat(F.lit("left "), F.when(b == "", "edge").when(b.rlike("[\"'=:(]\\s?$"), "mark").when(b.rlike("[.!?]\\s*$"), "stop").when(b.rlike("\\n$"), "line").otherwise("plain")),
        F.concat(F.lit("right "), F.when(a == "", "edge").when(a.rlike("^[\"')]"), "mark").when(a.rlike("^[.!?,;]"), "stop").when(a.rlike("^\\n"), "line").otherwise("plain")),
        F.concat(F.lit("word "), F.when(b.rlike(YES_BEFORE[kind]), "yes").when(b.rlike(NO_BEFORE[kind]), "no").when(last == "", "none").otherwise("other")),
        F.concat(F.lit("first "), F.when(t.rlike("^[0-9(]"), "digit").when(F.substring_index(t, " ", 1).isin(FIRST_NAMES), "name").when(F.substring_index(t, " ", 1).isin(STOP_WORDS), "stop word").otherwise("letter")),
    )


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (kind, s, e) and candidates (kind, s, e, votes, features), staged.

    Places are running sums over the matches of a text, taken by a window over
    matches (few, and without the text), so they stay linear in their number.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hint = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "name": F.lit(True)}
    rows = rows.withColumn("digit", text.rlike("[0-9]"))
    rows = rows.select("doc_id", "text", *[F.when(hint.get(k, F.col("digit")), F.regexp_extract_all(text, F.lit(p), 0)).alias(k) for k, p in PATTERNS.items()])
    each = [matches(k, F.coalesce(F.col(k), F.array().cast("array<string>")), text, p) for k, p in PATTERNS.items()]
    rows = staged(rows.select("doc_id", F.monotonically_increasing_id().alias("rid"), F.concat(*each).alias("found")), "matches")

    one = rows.where(F.size("found") > 0).select("rid", F.inline("found")).repartition("rid")
    size = F.char_length("t")
    run = Window.partitionBy("rid", "kind").orderBy("i")
    one = one.withColumn("e", F.sum(F.col("gap") + size).over(run).cast("int")).withColumn("s", F.col("e") - size)
    kept = F.lit(False)
    for k in BASE:
        kept = kept | ((F.col("kind") == k) & valid(k, F.col("t")))
    one = one.withColumn("base", kept).where(F.col("base") | F.col("kind").isin(*MORE))
    # base spans that begin at or before this one and reach into it, and those that begin at or behind it
    reach = F.max(F.when(F.col("base"), F.col("e"))).over(Window.partitionBy("rid").orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    begin = F.min(F.when(F.col("base"), F.col("s"))).over(Window.partitionBy("rid").orderBy(F.col("s").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    one = one.withColumn("reach", reach).withColumn("begin", begin)
    one = one.where("base or (coalesce(reach, 0) <= s and coalesce(begin, e) >= e)")

    said = lambda of: F.coalesce(*[F.when(F.col("kind") == k, of(k, {x: F.col(x) for x in "tba"})) for k in MORE])
    order = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate((*BASE, *MORE))])
    candidate = F.struct(order.alias("k"), "s", "kind", "e", said(votes).alias("votes"), said(features).alias("features"))
    gathered = one.groupBy("rid").agg(F.sort_array(F.collect_list(F.when(F.col("base"), F.struct(order.alias("k"), "s", "kind", "e")))).alias("base"), F.sort_array(F.collect_list(F.when(~F.col("base"), candidate))).alias("candidates"))
    span = lambda x: [x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")]
    base = F.coalesce(F.transform("base", lambda x: F.struct(*span(x))), F.array().cast("array<struct<kind:string,s:int,e:int>>"))
    more = F.coalesce(F.transform("candidates", lambda x: F.struct(*span(x), x["votes"].alias("votes"), x["features"].alias("features"))), F.array().cast("array<struct<kind:string,s:int,e:int,votes:array<int>,features:array<string>>>"))
    return staged(rows.select("doc_id", "rid").join(gathered, "rid", "left").select("doc_id", base.alias("base"), more.alias("candidates")), "spans")


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(v) for kv in values.items() for v in kv])


def _vote_key(j: int) -> Column:
    return F.concat("kind", F.lit(f" {j} "), F.element_at("votes", j + 1).cast("string"))


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, dict]:
    """Expectation-maximisation over vote patterns (kind, votes, n): the patterns with p, and per kind the prior and each labeler's yes rates given yes and no.

    A round needs the number of candidates of each kind and votes only: at most
    3 kinds of 3 ** LABELERS votes, collected once.
    """
    counts: dict[str, list] = {}
    for r in patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r["kind"], []).append((r["votes"], r["n"]))
    model = {k: estimated(sorted(counts[k]), rounds) for k in sorted(counts)}
    prior = {k: math.log(m["prior"] / (1 - m["prior"])) for k, m in model.items()}
    weight = {f"{k} {j} {v}": math.log((m["yes"][j] if v else 1 - m["yes"][j]) / (m["no"][j] if v else 1 - m["no"][j])) for k, m in model.items() for j in range(LABELERS) for v in (0, 1)}
    if not model:
        return patterns.withColumn("p", F.lit(0.0)), model
    logit = F.element_at(_map(prior), F.col("kind"))
    for j in range(LABELERS):
        logit = logit + F.coalesce(F.try_element_at(_map(weight), _vote_key(j)), F.lit(0.0))
    return patterns.withColumn("p", 1 / (1 + F.exp(-logit))), model


def estimated(counts: list[tuple[list[int], int]], rounds: int = ROUNDS) -> dict:
    """Prior and yes rates of one kind from the number of candidates of each vote pattern (1 yes, 0 no, -1 nothing)."""
    prior, yes, no = 0.3, [0.8] * LABELERS, [0.2] * LABELERS
    for _ in range(rounds):
        # two counts each way keep every rate inside (0, 1), and labelers better than chance at the start
        t, n = 1.0, 3.0
        y, y_of, x, x_of = [2.0] * LABELERS, [3.0] * LABELERS, [1.0] * LABELERS, [3.0] * LABELERS
        for votes, times in counts:
            logit = math.log(prior / (1 - prior))
            for j, v in enumerate(votes):
                if v >= 0:
                    logit += math.log((yes[j] if v else 1 - yes[j]) / (no[j] if v else 1 - no[j]))
            p = 1 / (1 + math.exp(-logit))
            t, n = t + times * p, n + times
            for j, v in enumerate(votes):
                if v >= 0:
                    y_of[j], x_of[j] = y_of[j] + times * p, x_of[j] + times * (1 - p)
                    if v:
                        y[j], x[j] = y[j] + times * p, x[j] + times * (1 - p)
        prior, yes, no = t / n, [a / b for a, b in zip(y, y_of, strict=True)], [a / b for a, b in zip(x, x_of, strict=True)]
    return {"prior": prior, "yes": yes, "no": no}


def classifier(scored: DataFrame) -> Column:
    """Naive Bayes log odds of (kind, features), trained on the likelihoods p of the patterns."""
    yes, no = F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")
    total = {r["kind"]: (r["yes"], r["no"]) for r in scored.groupBy("kind").agg(yes, no).collect()}
    # categories are few by construction, so is what is collected
    each = scored.select("kind", "n", "p", F.explode("features").alias("feature")).groupBy("kind", "feature").agg(yes, no).collect()
    prior = {k: math.log((y + 0.5) / (n + 0.5)) for k, (y, n) in total.items()}
    weight = {f"{r['kind']} {r['feature']}": math.log((r["yes"] + 0.5) / (total[r["kind"]][0] + 1)) - math.log((r["no"] + 0.5) / (total[r["kind"]][1] + 1)) for r in each}
    if not prior:
        return lambda x: F.lit(-1.0)
    return lambda x: F.aggregate(x["features"], F.element_at(_map(prior), x["kind"]), lambda s, f: s + F.coalesce(F.try_element_at(_map(weight), F.concat(x["kind"], F.lit(" "), f)), F.lit(0.0)))


def detected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, base and spans, arrays of (kind, s, e) in order of kind and start."""
    rows = found(docs, id_col, text_col)
    patterns = rows.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n"))
    scored, _ = reliabilities(staged(patterns, "vote-patterns"))
    odds = classifier(scored)
    added = F.transform(F.filter("candidates", lambda x: odds(x) > 0), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return rows.select("doc_id", "base", F.concat("base", added).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def masked(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with each span of `detected` replaced by <kind>; overlapping spans are cut at the first. Ids must be unique."""
    listed = spans.select(F.col("doc_id").alias("__id"), F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))).alias("__spans"))
    t = F.col(text_col)

    def step(acc: Column, x: Column) -> Column:
        gap = F.substr(t, acc["at"] + 1, x["s"] - acc["at"])
        later = F.struct(x["e"].alias("at"), F.concat(acc["out"], gap, F.lit("<"), x["kind"], F.lit(">")).alias("out"))
        return F.when(x["s"] >= acc["at"], later).otherwise(acc)

    whole = F.aggregate("__spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(t, acc["at"] + 1, F.char_length(t))))
    out = F.when(F.size("__spans") > 0, whole).otherwise(t)
    return docs.join(listed, F.col(id_col).eqNullSafe(F.col("__id")), "left").select(*[out.alias(c) if c == text_col else F.col(c) for c in docs.columns])
