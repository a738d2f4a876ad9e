"""License scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line, a sentence of one, or a window of 2 to 6 neighbouring
short lines with their comment marks stripped, for notices wrapped over lines.
One that holds an anchor (a word or phrase that license notices cannot do
without) is a candidate; every other is unknown by definition. Candidates are
sparse vectors of word 1- to 3-grams. A multinomial logistic regression with an
L1 share, trained on notices and on look-alikes, names a family or the unknown
class; a second logistic regression, fitted on notices and prose that none of
the training texts was made from, turns the margin over the unknown class into
a calibrated probability.

Every family that scores enough counts if a template confirms it, in one of two
ways. By wording: enough word trigrams of one of the family's notices are found
in the paragraph, not used up by a better notice on these lines. Or slot by
slot: the paragraph holds one of the family's names (the version is part of
it, or free) where a grant needs one, behind "licensed under", "License:" and
the like, or before "licensed" or "licence applies". A hit names the first line
of its paragraph.

All of it is column expressions and Spark's own feature and regression stages.
Texts are read once; only candidates go on, a row each. Notices that share no
line are settled apart, in pieces of at most `PIECE` lines, so a text of very
many candidates is many small groups. (Across the border of two pieces of one
dense block a wrapped notice may be named twice.)

Defined results: NULL and empty texts have no paragraphs; a very long text is
cut into its lines, a notice wrapped over more than 6 lines, or over lines of
more than 160 characters, counts by those of its sentences that name a family;
rows are judged one by one, repeated or not; columns other than id and text
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoset.llm.common import staged

UNKNOWN = "unknown"
#: Phrases, lower case: a paragraph without any of them is no candidate.
ANCHORS = ("licen", "copyright", "spdx", "warrant", "public domain", "creative commons", "redistribut", "permission is hereby", "cc by", "cc-by", "cc0", "gpl", "apache 2", "apache-2", "apache v", "the apache", "the mit", "under mit", "the bsd", "under bsd", "the isc", "under isc", "mozilla public", "the mpl", "under mpl", "mpl-2", "mpl 2", "eclipse public", "epl", "zlib", "boost software")
#: Fixed wording of common notices.
TEMPLATES = {
    "agpl": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"),
    "apache": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: Apache-2.0", "Released under Apache 2.0."),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Released under the BSD License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "boost": ("Distributed under the Boost Software License, Version 1.0.", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "SPDX-License-Identifier: BSL-1.0"),
    "cc-by-nd": ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "Licensed under CC BY-ND 4.0.", "SPDX-License-Identifier: CC-BY-ND-4.0"),
    "epl": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the Eclipse Public License, version 1.0.", "SPDX-License-Identifier: EPL-2.0"),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense"),
    "zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Released under the zlib License.", "SPDX-License-Identifier: Zlib"),
    "cc0": ("To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain under CC0.", "This work is released under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "Released under the GNU GPL version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "lgpl": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only"),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT", "Distributed under the terms of the MIT License."),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
}
#: Names of the families, as patterns over lower-case text, and forms of them to train on.
NAMES = {
    "agpl": (r"gnu affero general public licen[cs]e|affero gpl|\bagpl(?:[- ]?v?[0-9])?", "GNU Affero General Public License version 3|the AGPL|AGPLv3"),
    "apache": (r"apache(?:[- ]software)?[- ]licen[cs]e|apache[- ]?v?2(?:\.0)?", "the Apache License 2.0|Apache-2.0|Apache 2"),
    "boost": (r"boost software licen[cs]e|\bbsl-1\.0", "the Boost Software License|BSL-1.0"),
    "bsd": (r"\bbsd\b", "the BSD license|a 3-clause BSD license|BSD-2-Clause"),
    "cc-by": (r"cc[- ]by(?![- ]?(?:n[cd]|sa))\b|creative commons attribution(?![- ](?:non|no|share))", "CC BY 4.0|a Creative Commons Attribution license"),
    "cc-by-nc": (r"cc[- ]by[- ]nc(?![- ]?(?:nd|sa))\b|creative commons attribution[- ]non[- ]?commercial(?![- ](?:no|share))", "CC BY-NC 3.0|a Creative Commons Attribution-NonCommercial license"),
    "cc-by-nd": (r"cc[- ]by[- ]nd\b|creative commons attribution[- ]no[- ]?deriv", "CC BY-ND 3.0|a Creative Commons Attribution-NoDerivatives license"),
    "cc-by-sa": (r"cc[- ]by[- ]sa\b|creative commons attribution[- ]share[- ]?alike", "CC BY-SA 3.0|a Creative Commons Attribution-ShareAlike license"),
    "cc0": (r"\bcc0\b", "CC0|CC0 1.0"),
    "epl": (r"eclipse public licen[cs]e|\bepl(?:[- ]?v?[0-9])", "the Eclipse Public License|EPL-1.0"),
    "gpl": (r"(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e|(?<![a-z])gpl(?:[- ]?v?[0-9]|\b)", "the GNU General Public License version 2|the GNU GPL|GPLv3+|GPL-2.0"),
    "isc": (r"\bisc\b", "the ISC license|ISC"),
    "lgpl": (r"(?:lesser|library) general public licen[cs]e|\blgpl(?:[- ]?v?[0-9]|\b)", "the GNU Lesser General Public License|LGPLv3|LGPL-2.1"),
    "mit": (r"\bmit\b", "the MIT license|the MIT licence|MIT"),
    "mpl": (r"mozilla public licen[cs]e|\bmpl(?:[- ]?v?[0-9])", "the Mozilla Public License 2.0|MPL-2.0"),
    "unlicense": (r"\bunlicense\b", "the Unlicense|Unlicense"),
    "zlib": (r"\bzlib\b", "the zlib license|zlib"),
}
#: Where a grant has its name: `@` stands for the name.
_GAP = r"(?:(?!\. ).)"
SLOTS = (
    r"\b(?:licen[cs]ed|released|distributed|(?:made )?available|provided|published|covered|governed|redistributed|used|offered|shared|dual[- ]licen[cs]ed|copied)\b"
    + _GAP + r"{0,40}?\b(?:under|by|via|per)\b" + _GAP + "{0,60}?@",
    r"\b(?:terms|conditions|text|copy|version) of (?:the |either the |a )?" + _GAP + "{0,30}?@", r"\blicen[cs]es?(?:[- ]identifier)?\s*[:=]" + _GAP + "{0,40}?@",
    r"@(?:[- ]style)?[- ]licen[cs]ed\b", r"\bthe @(?: licen[cs]e)?(?:,? version [0-9.]+,?)? (?:applies|governs|covers)\b",
)
#: Grants to train on: `@` stands for a form of the name.
GRANTS = ("Licensed under @.", "This file may be used under the terms of @.", "Released under @", "License: @", "Distributed under @, see the file COPYING.", "The code is available under @.", "@ licensed.", "Dual licensed under @ or another license.")
#: Calibration: sentences that neither templates nor grants were made into, with their family.
CALIBRATION = (
    ("apache", "You can redistribute the sources, which the Apache License 2.0 governs, with this note."), ("apache", "Covered by Apache-2.0 unless stated otherwise."),
    ("mit", "MIT-licensed, see the COPYING file for the text."), ("mit", "Everything here is offered under MIT terms."), ("mit", "The MIT licence covers all files in this directory."),
    ("gpl", "The kernel module is GPL-2.0 code and may be copied under the GPL only."), ("gpl", "See the GNU General Public License for more details."), ("gpl", "License: GPL-3"),
    ("lgpl", "Linked against this library, which is available under LGPL-2.1 or later."), ("lgpl", "Consult the GNU Lesser General Public License for your rights."), ("agpl", "Our server code is published under the AGPL."),
    ("bsd", "Use and copying are governed by a 2-clause BSD license."), ("bsd", "BSD-licensed code from the university."), ("isc", "The daemon is shared under the ISC license, like its siblings."),
    ("mpl", "Files in this folder are covered by the Mozilla Public License 2.0."), ("epl", "The plug-in is distributed under the Eclipse Public License."), ("boost", "Header files are provided under the Boost Software License."),
    ("cc-by", "Photos: shared under CC BY 2.0 by their authors."), ("cc-by-sa", "Text is available under the Creative Commons Attribution-ShareAlike License."), ("cc-by-nc", "Slides may be copied under CC BY-NC."),
    ("cc-by-nd", "The report is published under CC BY-ND 4.0."), ("cc0", "The data are released under CC0."), ("zlib", "The image loader is used under the zlib license."), ("unlicense", "Dedicated to the public and covered by the Unlicense."),
    ("unknown", "A license is not required for fishing from the pier."), ("unknown", "The software license costs fifty euros a year."), ("unknown", "He studied at MIT and licensed his invention in 1987."),
    ("unknown", "The Apache helicopter's export licence was refused."), ("unknown", "Copyright law in the EU was reformed under the last commission."), ("unknown", "The bar lost its liquor license under the new owner."),
    ("unknown", "Her warranty claim was rejected by the dealer."), ("unknown", "This license key is valid for one seat."), ("unknown", "Terms of the licence between the firms are secret."), ("unknown", "The general public was invited to the licensing hearing."),
    ("unknown", "Licensees must renew their permits under section four."), ("unknown", "Redistribution of wealth was debated under the old regime."), ("unknown", "The eclipse was watched by the public from the roof."),
    ("unknown", "All rights reserved by the publisher."), ("unknown", "A driving licence from any member state is accepted."), ("unknown", "The public domain of the crown covers these woods."),
    ("unknown", "No part may be copied without a licence from the agency."), ("unknown", "The warrant was issued under the terms of the act."), ("unknown", "Broadcasters pay a licence fee: it funds the news."),
)
#: Sentences with an anchor that grant nothing.
LOOK_ALIKES = (
    "All rights reserved. No part of this book may be copied without permission of the copyright holder.",
    "Copyright 2019 by the author.", "He lost his driving license on the way to the office.", "The restaurant has a license to sell wine.",
    "The warranty covers parts and labour for two years.", "A search warrant was issued by the court.", "The song has been in the public domain since 1950.",
    "You need a license key to start the product.", "Please read the license terms before you buy.", "Licensing fees rose by ten percent this year.",
    "The company licensed its patents to a rival.", "Taxes redistribute income from the rich to the poor.", "The film is protected by copyright law.",
    "Fishing without a licence is an offence in this county.", "Creative commons of ideas were discussed at the meeting.", "His licence plate was covered with mud.",
    "No warranty is given by the seller.", "The public license office opens at nine.", "A license agreement was signed by both parties in June.",
    "General questions about licenses should go to the legal team.", "Copyright infringement may lead to prosecution.", "The doctor is licensed in three states.",
)
BLANK = "\t\x0b\x0c\r"
#: Comment marks and blanks around a line.
MARKS, END_MARKS = r"^[\s/*#;%!<>|-]+", r"[\s*/#>|-]+$"
#: Between sentences of a line.
SENTENCE = r"(?<=[.!?;])\s+"
#: Most lines of a wrapped notice, and most characters of each.
WINDOW, WRAPPED = 6, 160
#: Most lines of a block of candidates settled together.
PIECE = 50
CONFIRMED = 0.6
LEAST = 0.6
SMOOTH = {"regParam": 0.002, "elasticNetParam": 0.3, "maxIter": 60}


def words(c: Column) -> Column:
    """Lower-case words and numbers, punctuation dropped but for the dots within numbers."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}.]+|\.(?!\p{N})"), lambda w: w != "")


def has_anchor(c: Column) -> Column:
    low = F.lower(c)
    found = F.contains(low, F.lit(ANCHORS[0]))
    for a in ANCHORS[1:]:
        found = found | F.contains(low, F.lit(a))
    return found


def variants(text: str) -> list[tuple[str, bool]]:
    """Ways a notice is met, and whether each is held out from training."""
    w = text.split()
    third = len(w) // 4
    out = [(text, False), (f"Note: {text}", False), (f"{text} See the file for details.", False), (f"The code in this folder. {text} Thanks.", True)]
    if third:
        out += [(" ".join(w[third:]), False), (" ".join(w[:-third]), True)]
    return out


def slots_of(text: Column) -> Column:
    """The families that a paragraph names where a grant needs a name."""
    low = F.lower(text)
    each = [F.when(low.rlike("|".join(x.replace("@", f"(?:{name})") for x in SLOTS)), F.lit(f)) for f, (name, _) in NAMES.items()]
    return F.array_compact(F.array(*each))


def lessons(spark: SparkSession) -> DataFrame:
    """Training paragraphs, and those of the calibration (held): text, family, held."""
    rows = [(t, family, False) for family, own in TEMPLATES.items() for text in own for t, _ in variants(text)]
    rows += [(g.replace("@", form), family, False) for family, (_, forms) in NAMES.items() for form in forms.split("|") for g in GRANTS]
    for text in LOOK_ALIKES:
        rows += [(text, UNKNOWN, False), (f"In other news, {text}", UNKNOWN, False), (f"{text} So it was said.", UNKNOWN, False)]
    rows += [(t, family, True) for family, t in CALIBRATION]
    return spark.createDataFrame(rows, "text string, family string, held boolean")


def grams(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add `grams`: the word 1-, 2- and 3-grams of a paragraph."""
    df = df.withColumn("__1", words(F.col(text_col)))
    for n in (2, 3):
        df = NGram(n=n, inputCol="__1", outputCol=f"__{n}").transform(df)
    return df.withColumn("grams", F.concat("__1", "__2", "__3")).withColumnRenamed("__3", "trigrams").drop("__1", "__2")


class Scanner:
    """The fitted classifier, its calibration, and the templates' trigrams."""

    def __init__(self, spark: SparkSession):
        self.families = [*sorted(TEMPLATES), UNKNOWN]
        number = F.array_position(F.array(*[F.lit(f) for f in self.families]), F.col("family")) - 1
        taught = staged(grams(lessons(spark)).withColumn("label", number.cast("double")).coalesce(1), "license-lessons")
        vector = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0).fit(taught)
        regression = LogisticRegression(family="multinomial", **SMOOTH).fit(vector.transform(taught.where("not held")))
        self.model = PipelineModel([vector, regression])
        held = self._scored(taught.where("held"))
        known = held.select((F.col("family") != UNKNOWN).cast("double").alias("label"), "margin")
        assembled = VectorAssembler(inputCols=["margin"], outputCol="features")
        fit: LogisticRegressionModel = LogisticRegression(regParam=0.01).fit(assembled.transform(known.coalesce(1)))
        self.slope, self.offset = float(fit.coefficients[0]), float(fit.intercept)
        own = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
        listed = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in own])
        cut = grams(spark.range(1).select(F.inline(listed)))
        pieces = F.when(F.size("trigrams") > 0, F.col("trigrams")).otherwise(F.col("grams"))
        # one row per family, fixed above
        self.templates = staged(cut.groupBy(F.col("family").alias("named")).agg(F.collect_list(pieces).alias("templates")), "license-templates")

    def _scored(self, rows: DataFrame) -> DataFrame:
        raw = vector_to_array("rawPrediction")
        k = len(self.families)
        best = F.array_max(F.slice(raw, 1, k - 1))
        name = F.element_at(F.array(*[F.lit(f) for f in self.families]), F.array_position(F.slice(raw, 1, k - 1), best).cast("int"))
        margins = F.transform(F.slice(raw, 1, k - 1), lambda m: m - F.element_at(raw, k))
        return self.model.transform(rows).withColumn("margin", best - F.element_at(raw, k)).withColumn("margins", margins).withColumn("named", name).drop("features", "rawPrediction", "probability", "prediction")

    def classified(self, units: DataFrame) -> DataFrame:
        """Units (rid, line, n_lines, text) with a row for each family that scores enough and for the best one: score, similarity, the template's trigrams found (`matched`) and their number in the template (`wanted`)."""
        scored = self._scored(grams(units.withColumn("slots", slots_of(F.col("text"))))).drop("text", "margin").withColumnRenamed("named", "best")
        scores = F.transform("margins", lambda m, i: F.struct(F.element_at(F.array(*[F.lit(f) for f in self.families]), i + 1).alias("named"), (1 / (1 + F.exp(-(F.lit(self.slope) * m + F.lit(self.offset))))).alias("score")))
        each = scored.withColumn("scores", scores).select("rid", "line", "n_lines", "best", "slots", F.concat("trigrams", "grams").alias("mine"), F.inline(F.filter("scores", lambda x: (x["score"] >= LEAST) | (x["named"] == F.col("best")))))
        joined = each.join(F.broadcast(self.templates), "named")
        found = F.transform("templates", lambda t: F.struct((F.size(F.array_intersect(t, F.col("mine"))) / F.size(F.array_distinct(t))).alias("similarity"), F.size(F.array_distinct(t)).alias("wanted"), F.array_intersect(t, F.col("mine")).alias("matched")))
        # a name in its place is a template found whole
        named = F.struct(F.lit(1.0).alias("similarity"), F.lit(1).alias("wanted"), F.array(F.concat(F.lit("@"), F.col("named"))).alias("matched"))
        best = F.array_max(found)
        best = F.when(F.array_contains("slots", F.col("named")) & (best["similarity"] < CONFIRMED), named).otherwise(best)
        return joined.withColumn("m", best).select("rid", "line", "n_lines", "named", "best", "score", "m.similarity", "m.wanted", "m.matched")


def _near_anchors(rows: DataFrame) -> DataFrame:
    """rid and, for each line with an anchor (its own, or broken over its end), the line, the one before it with an anchor, and the lines around.

    `rows` has rid and `bare`, the lines without comment marks, as stored
    columns, so each is computed once and not again for every element.
    """
    one = F.transform("bare", lambda x, i: F.struct(i.alias("at"), F.concat_ws(" ", x, F.get("bare", i + 1)).alias("text")))
    anchors = F.transform(F.filter(one, lambda x: has_anchor(x["text"])), lambda x: x["at"])
    each = rows.select("rid", "bare", F.posexplode(anchors).alias("i", "at"))
    before = F.lag("at").over(Window.partitionBy("rid").orderBy("i"))
    around = F.slice("bare", F.greatest(F.col("at") - WINDOW + 2, F.lit(1)), 2 * WINDOW - 1)
    return each.select("rid", "i", "at", around.alias("lines")).withColumn("before", F.coalesce(before, F.lit(-1)))


def _windows(at: Column, before: Column, lines: Column) -> Column:
    """Windows (line, n_lines, text) of 2 to `WINDOW` short lines that hold an anchor and none before it, so each window comes once."""
    first = F.greatest(at - WINDOW + 1, F.lit(0))
    starts = F.sequence(F.greatest(first, F.least(before + 1, at)), at)
    cut = F.flatten(F.transform(starts, lambda s: F.transform(F.sequence(F.greatest(at - s + 1, F.lit(2)), F.lit(WINDOW)), lambda w: F.struct(s.alias("line"), w.alias("n_lines"), F.slice(lines, s - first + 1, w).alias("lines")))))
    whole = F.filter(cut, lambda c: (F.size(c["lines"]) == c["n_lines"]) & F.forall(c["lines"], lambda x: (F.length(x) > 0) & (F.length(x) <= WRAPPED)))
    return F.filter(F.transform(whole, lambda c: F.struct(c["line"].alias("line"), c["n_lines"].alias("n_lines"), F.array_join(c["lines"], " ").alias("text"))), lambda c: has_anchor(c["text"]))


def _pieces(found: DataFrame) -> DataFrame:
    """Add `piece`: hits that share lines are in one, cut every `PIECE` lines."""
    by_line = Window.partitionBy("rid").orderBy("line", "n_lines")
    upto = F.max(F.col("line") + F.greatest("n_lines", F.lit(1))).over(by_line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("line") < upto, F.lit(None)).otherwise(F.col("line"))
    start = F.last("opens", ignorenulls=True).over(by_line.rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("opens", opens).withColumn("start", start).withColumn("piece", F.col("start") + F.floor((F.col("line") - F.col("start")) / PIECE) * PIECE).drop("opens", "start")


def _accepted(found: Column) -> Column:
    """Confirmed notices of a document, best first, that share no line with one of the same family, nor the evidence of another."""
    order = F.transform(F.filter(found, lambda h: (h["score"] >= LEAST) & (h["similarity"] >= CONFIRMED)), lambda h: F.struct((-h["similarity"]).alias("a"), (-h["wanted"]).alias("b"), h["n_lines"].alias("c"), h["line"].alias("d"), h["named"].alias("e"), h.alias("h")))
    ranked = F.transform(F.array_sort(order), lambda x: x["h"])

    def add(taken: Column, h: Column) -> Column:
        end = lambda x: x["line"] + F.greatest(x["n_lines"], F.lit(1))
        near = F.filter(taken, lambda t: (t["line"] < end(h)) & (h["line"] < end(t)))
        left = F.size(F.array_except(h["matched"], F.flatten(F.transform(near, lambda t: t["matched"]))))
        new = ~F.exists(near, lambda t: t["named"] == h["named"]) & (left >= CONFIRMED * h["wanted"])
        return F.when(new, F.concat(taken, F.array(h))).otherwise(taken)

    return F.aggregate(ranked, F.filter(ranked, lambda _: F.lit(False)), add)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_paragraphs, n_candidates, hits array<struct<line, family, named, score, similarity>> by first line from 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<line:int,n_lines:int,text:string>>")

    def sentences(x: Column) -> Column:
        cut = F.split(x["text"], SENTENCE)
        # a sentence that is the whole line is there already
        own = F.filter(F.transform(cut, lambda t: F.struct(x["line"].alias("line"), F.lit(0).alias("n_lines"), t.alias("text"))), lambda y: has_anchor(y["text"]))
        return F.when(F.size(cut) > 1, own).otherwise(none)

    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), F.lit(1).alias("n_lines"), x.alias("text")))
    candidates = F.filter(numbered, lambda x: has_anchor(x["text"]))
    some = has_anchor(F.translate(text, "\n", " "))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("rid"),
        F.size(F.filter(F.split(text, "\n"), lambda x: F.ltrim(F.translate(x, BLANK, " " * len(BLANK))) != "")).alias("n_paragraphs"),
        F.when(some, candidates).otherwise(none).alias("candidates"),
        F.when(some, F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, MARKS, ""), END_MARKS, ""))).alias("bare"),
    )
    rows = staged(rows, "license-candidates")
    lines = F.concat("candidates", F.flatten(F.transform("candidates", sentences)))
    units = rows.where(F.size("candidates") > 0).select("rid", F.inline(lines))
    near = _near_anchors(rows.where("bare is not null").select("rid", "bare"))
    units = units.unionByName(near.select("rid", F.inline(_windows(F.col("at"), F.col("before"), F.col("lines")))))
    found = _pieces(Scanner(docs.sparkSession).classified(units))
    every = F.collect_list(F.struct("line", "n_lines", "named", "best", "score", "similarity", "wanted", "matched"))
    found = found.groupBy("rid", "piece").agg(every.alias("found")).withColumn("taken", _accepted(F.col("found")))
    sure = F.transform("taken", lambda h: F.struct(h["line"].alias("line"), h["named"].alias("family"), h["named"].alias("named"), h["score"].alias("score"), h["similarity"].alias("similarity")))
    lone = F.filter("found", lambda h: (h["n_lines"] == 1) & (h["named"] == h["best"]) & ~F.exists("taken", lambda t: (t["line"] <= h["line"]) & (h["line"] < t["line"] + F.greatest(t["n_lines"], F.lit(1)))))
    other = F.transform(lone, lambda h: F.struct(h["line"].alias("line"), F.lit(UNKNOWN).alias("family"), h["named"].alias("named"), h["score"].alias("score"), h["similarity"].alias("similarity")))
    hits = found.select("rid", F.concat(sure, other).alias("hits")).groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    empty = F.array().cast("array<struct<line:int,family:string,named:string,score:double,similarity:double>>")
    return rows.join(hits, "rid", "left").select("doc_id", F.col("n_paragraphs").cast("long").alias("n_paragraphs"), F.size("candidates").cast("long").alias("n_candidates"), F.coalesce("hits", empty).alias("hits"))
