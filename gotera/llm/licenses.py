"""License scanning by diagonal voting of word k-grams."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gotera.llm.common import LOWER, UPPER, ascii_lower, fresh, quoted
from gotera.operators.skew import broadcast_if_small

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Whole texts and notices of public licenses, with labels of our own.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""
GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
received a copy of the GNU General Public License along with this program. If not, see"""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at"""
TEMPLATES = {
    MIT: "mit-text", f"{BSD_TERMS} {BSD_DISCLAIMER}": "bsd-2-text", f"{BSD_TERMS} {BSD_THIRD} {BSD_DISCLAIMER}": "bsd-3-text",
    ISC: "isc-text", ZLIB: "zlib-text", APACHE_NOTICE: "apache-notice", GPL_NOTICE: "gpl-notice", MPL_NOTICE: "mpl-notice",
    "all rights reserved": "reserved",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE = 0.8
NEIGHBOURS = 3
#: How far the diagonals of one place may lie apart, as a share of the template's words, and at least.
DRIFT, LEAST_DRIFT = 0.25, 4
GRAM = 2
CONTEXT = 2
#: Template positions (some 200 bytes each) up to which they are broadcast.
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    """Words of letters, digits and everything outside ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def template_words(text: str) -> list[str]:
    """The words of a phrase or template, as ``words_of`` cuts them."""
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    return [w for w in re.split(SEPARATORS, lowered) if w]


def template_positions(spark: SparkSession, phrases: Mapping[str, str], templates: Mapping[str, str]) -> DataFrame:
    """(gram, mark, places): each two-word gram of phrases and templates with the places where it stands.

    A place is (template, label, exact, tpos, more, n_words). Templates of four words or more are voted on by four-word
    grams, of which ``more`` is the second half. One row per gram, so a text's gram meets one row.
    """
    rows = []
    for exact, given in ((True, phrases), (False, templates)):
        for number, (text, label) in enumerate(given.items()):
            words = template_words(text)
            if len(words) < GRAM:
                raise ValueError(f"a phrase needs {GRAM} words: {text!r}")
            more = CONTEXT if not exact and len(words) >= GRAM + CONTEXT else 0
            rows += [(number, label, exact, i, " ".join(words[i:i + GRAM]), " ".join(words[i + GRAM:i + GRAM + more]), len(words))
                     for i in range(len(words) - GRAM - more + 1)]
    made = spark.createDataFrame(
        rows, "template int, label string, exact boolean, tpos int, gram string, more string, n_words int")
    return made.groupBy("gram").agg(F.collect_list(F.struct(
        "template", "label", "exact", "tpos", "more", "n_words")).alias("places")).withColumn("mark", F.xxhash64("gram"))


def aligned(pairs: Column) -> Column:
    """(words, first, last) of the longest chain of (pos, tpos) that rises in both: the alignment of a place's words.

    Patience: pairs come by pos, of equal pos the largest tpos first; the chains' last template positions are kept for
    each length, each the smallest there is, with the text positions where its chain starts and ends.
    """
    order = F.array_sort(F.transform(pairs, lambda p: F.struct(p["pos"].alias("pos"), (-p["tpos"]).alias("back"))))

    def add(tails: Column, p: Column) -> Column:
        at = -p["back"]
        shorter = F.size(F.filter(tails, lambda t: t["tpos"] < at))
        first = F.when(shorter > 0, F.get(tails, shorter - 1)["first"]).otherwise(p["pos"])
        tail = F.struct(at.alias("tpos"), first.alias("first"), p["pos"].alias("last"))
        return F.concat(F.slice(tails, F.lit(1), shorter), F.array(tail), F.slice(tails, shorter + 2, F.size(tails)))

    none = F.array().cast("array<struct<tpos:int,first:int,last:int>>")
    return F.aggregate(order, none, add, lambda tails: F.struct(
        F.size(tails).alias("words"), F.element_at(tails, -1)["first"].alias("first"), F.element_at(tails, -1)["last"].alias("last")))


def license_places(df: DataFrame, text: str = "text", phrases: Mapping[str, str] | None = None,
                   templates: Mapping[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(content, label, exact, first_word, end_word, score) of every license place; content is the md5 of the text.

    All rolling two-word grams are hashed and joined with the template positions; every hit votes for the diagonal
    (text position - template position), four-word grams being checked in full for templates. A phrase stands where one
    diagonal has all its grams. Diagonals of a template at most three words apart are merged (words put in or left
    out); merged diagonals that drift by more than a quarter of the template are cut, once from their first diagonal on
    and once half a cut later, so that no place is lost at a cut. A merged place is verified: its words are aligned with
    the template's (the longest chain of met words that rises in both), and it counts when the aligned words are at least
    ``coverage`` of the template and of the stretch that they span, which is the score. Hits are compared as words, not
    only as hashes. Of places of a template that overlap, the best is kept.

    Equal texts are voted on once, since hits are made distinct by content before they are grouped. A place holds at
    most a template's words times its diagonals, whatever the text.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    known = broadcast_if_small(template_positions(df.sparkSession, phrases, templates), BROADCAST_ROWS)
    body = F.coalesce(quoted(text), F.lit(""))
    split = df.select(F.md5(body).alias("content"), words_of(body).alias("words"))
    n = F.size("words")
    slices = [F.col("words"), *[F.slice("words", i + 1, n) for i in range(1, GRAM + CONTEXT)]]
    rolled = split.where(n >= GRAM).select("content", F.posexplode(F.arrays_zip(*slices)).alias("pos", "w"))
    field = rolled.schema["w"].dataType.fieldNames()
    w = [F.col("w").getField(f) for f in field]
    grams = rolled.where(w[1].isNotNull()).select("content", "pos", F.concat_ws(" ", w[0], w[1]).alias("said"),
                                                  F.concat_ws(" ", w[2], w[3]).alias("next"))
    met = F.filter("places", lambda p: (p["more"] == "") | (p["more"] == F.col("next")))
    hits = grams.withColumn("mark", F.xxhash64("said")).join(known, "mark").where(F.col("said") == F.col("gram")).select(
        "content", "pos", F.explode(met).alias("p"))
    votes = hits.select("content", "pos", "p.template", "p.label", "p.exact", "p.tpos", "p.n_words",
                        F.when(F.col("p.more") == "", GRAM).otherwise(GRAM + CONTEXT).alias("wide"),
                        (F.col("pos") - F.col("p.tpos")).alias("diagonal")).distinct()
    along = Window.partitionBy("content", "exact", "template").orderBy("diagonal", "pos")
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    apart = F.when(F.col("exact"), step != 0).otherwise(step > NEIGHBOURS)
    merged = votes.withColumn("new", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("place", F.sum("new").over(along))
    whole = Window.partitionBy("content", "exact", "template", "place")
    room = F.greatest(F.ceil(F.col("n_words") * DRIFT), F.lit(LEAST_DRIFT)).cast("int")
    gone = F.col("diagonal") - F.min("diagonal").over(whole)
    cut = merged.withColumn("gone", gone).withColumn("far", F.max("gone").over(whole) > room).withColumn("cut", F.explode(
        F.when(F.col("far"), F.array(2 * F.floor(F.col("gone") / room), 2 * F.floor((F.col("gone") + room / 2) / room) + 1))
        .otherwise(F.array(F.lit(0).cast("bigint")))))
    said = F.flatten(F.collect_set(F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda i: F.struct(
        (F.col("pos") + i).alias("pos"), (F.col("tpos") + i).alias("tpos")))))
    placed = cut.groupBy("content", "exact", "template", "place", "cut").agg(
        F.first("label").alias("label"), F.first("n_words").alias("n_words"), F.array_distinct(said).alias("said"))
    # too few words to cover the template are not aligned
    full = placed.where(F.size("said") >= F.when(F.col("exact"), F.col("n_words")).otherwise(F.ceil(F.col("n_words") * coverage)))
    spans = full.withColumn("chain", aligned(F.col("said"))).select(
        "content", "exact", "template", "label", F.col("chain.first").alias("first_word"), (F.col("chain.last") + 1).alias("end_word"),
        (F.col("chain.words") / F.greatest("n_words", F.col("chain.last") + 1 - F.col("chain.first"))).alias("score"))
    good = spans.where(F.when(F.col("exact"), F.col("score") == 1).otherwise(F.col("score") >= coverage)).distinct()
    return unbeaten(good).select("content", "label", "exact", "first_word", "end_word", "score")


def unbeaten(spans: DataFrame) -> DataFrame:
    """Spans of templates without those that overlap a better one of the same template next to them; phrases all stay."""
    along = Window.partitionBy("content", "exact", "template").orderBy("first_word", "end_word")
    beaten = F.lit(False)
    for other in (F.lag, F.lead):
        meets = (F.col("first_word") < other("end_word").over(along)) & (other("first_word").over(along) < F.col("end_word"))
        better = (other("score").over(along) > F.col("score")) if other is F.lag else (other("score").over(along) >= F.col("score"))
        beaten = beaten | F.coalesce(meets & better, F.lit(False))
    return spans.withColumn("beaten", beaten).where(F.col("exact") | ~F.col("beaten"))


def scan_licenses(df: DataFrame, text: str = "text", phrases: Mapping[str, str] | None = None,
                  templates: Mapping[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Every row with n_words, n_base, first_word, last_word, base_labels, labels and score (0 to 1).

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are their smallest and largest start (words
    from 0, else null); labels are distinct, sorted and joined by commas; ``score`` is the best coverage found, 0 without
    any. Null and empty texts have no words and empty labels. Rows keep their number; columns of these names are
    replaced. Rows meet their text's places in a join by content, whose hot contents AQE splits.
    """
    made = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept = [c for c in df.columns if c.lower() not in made]
    (content,) = fresh([*df.columns, *made], "content")
    body = F.coalesce(quoted(text), F.lit(""))
    base = F.col("exact")
    found = license_places(df.select(quoted(text).alias("text")), "text", phrases, templates, coverage).groupBy("content").agg(
        F.sum(base.cast("bigint")).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"),
    ).withColumnRenamed("content", content)
    words = df.select(*[quoted(c) for c in kept], F.md5(body).alias(content),
                      F.size(words_of(body)).cast("bigint").alias("n_words"))
    return words.join(found, content, "left").select(
        *[quoted(c) for c in kept], "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word",
        "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
