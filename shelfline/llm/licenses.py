"""License scans by diagonal voting, with DataFrame functions only.

Every rolling word k-gram of a text is hashed and joined with the positions of
the same k-gram in license templates; the words are compared inside the join. A
hit votes for its diagonal (position in the text minus position in the
template). Neighbouring diagonals of one template merge, so that an inserted or a
missing word does not end a match.

What merged is then verified on its words. A span's diagonals may drift apart by
:func:`drift` words in all, however many neighbours chain; a chain that drifts
farther is judged diagonal by diagonal. Of its votes those count that stand in
the template's order as well, and their share of the template's k-grams must
reach :data:`COVERAGE`. Short templates have few k-grams, of which one missing
word takes ``k``: in them it may end the match. Templates of kind "phrase" must
match on one diagonal without a gap.

Texts are cut into words once. A text's own row takes part in the join as one
more k-gram, so that what is written to the shared folder has a row for each
text, with its number of words, and a row for each hit; all else works on that.
The template table is a constant of this module, so broadcasting it is bounded.

Defined results
    null or empty text   no words, no labels, score 0
    repeated rows        the same result for each; they don't vote twice
    null ids             scanned like others
    texts of one id      each has its own result; the key is id and text hash
    ties                 spans are in order of first, then last word, then label
    empty table          no rows
Only the columns named are read, so other columns may have any names.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, materialize, text_hashes

#: The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Opening notices of licenses, and the labels that this method adds.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "mozilla public license version 2 0": "mpl-2.0",
}
#: Whole texts of licenses and of notices at the head of files, without titles and copyright lines.
TEXTS = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.": "mit-full",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.": "isc-full",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.": "bsd-2-full",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
    "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
    "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
    "the specific language governing permissions and limitations under the License.": "apache-2.0-full",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
    "License for more details. You should have received a copy of the GNU General Public License along with this program.": "gpl-3.0-full",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
    "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
    "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
    "required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may "
    "not be removed or altered from any source distribution.": "zlib-full",
}
#: Words of a gram: in phrases and notices, and in whole texts, whose word pairs are too common to vote.
K, K_TEXT = 2, 4
#: Diagonals at most so far apart are neighbours, and a span needs this share of its template's grams.
MERGE_GAP, COVERAGE = 2, 0.8
#: Characters that part words; everything else belongs to one.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Number of the template that every text's own row meets.
OWN_ROW = -1


def drift(words: int) -> int:
    """How far apart the diagonals of a template of so many words may lie in all."""
    return max(2, words // 16)


def words_of(text: Column) -> Column:
    """Lower-cased words; an empty array for null."""
    trimmed = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), f"^{SEPARATORS}", "")
    return F.filter(F.split(trimmed, SEPARATORS), lambda x: x != "")


def template_rows(phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None, texts: dict[str, str] | None = None) -> list[tuple]:
    """(t, label, phrase?, k, words of the gram, tpos, grams, drift) of every gram."""
    kinds = ((PHRASES if phrases is None else phrases, K, True), (NOTICES if notices is None else notices, K, False), (TEXTS if texts is None else texts, K_TEXT, False))
    rows, t = [], 0
    for templates, k, phrase in kinds:
        for text, label in templates.items():
            words = [w for w in re.split(SEPARATORS, text.lower()) if w]
            if len(words) < k:
                raise ValueError(f"template shorter than {k} words: {text}")
            n = len(words) - k + 1
            rows += [(t, label, phrase, k, words[i : i + k], i, n, drift(len(words))) for i in range(n)]
            t += 1
    return rows


def hits(docs: DataFrame, text: str, key: str, templates: list[tuple]) -> DataFrame:
    """In one pass over the texts: for each row, one of template :data:`OWN_ROW` with
    its number of words, and one for each place whose k-gram a template has."""
    spark = docs.sparkSession
    width = max(len(x[4]) for x in templates)
    table = spark.createDataFrame([*templates, (OWN_ROW, None, None, 0, None, None, None, None)], "t int, label string, phrase boolean, k int, gram array<string>, tpos int, grams int, drift int")
    # a gram is looked up by its first K words, an own row by no words at all
    table = table.withColumn("h", F.xxhash64(*[F.col("gram")[i] for i in range(K)]))
    x, y = text_hashes(F.col(text))
    rows = docs.select(F.col(key).alias("__key"), x, y, words_of(F.col(text)).alias("__words"))
    shifted = [F.col("__words"), *(F.expr(f"slice(__words, {i + 1}, greatest(size(__words) - {i}, 0))") for i in range(1, width))]
    zipped = F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(shifted)])
    nothing = F.struct(*[F.lit(None).cast("string").alias(f"w{i}") for i in range(width)])
    side = rows.select("__key", "hash_x", "hash_y", F.size("__words").cast("bigint").alias("n_words"), F.posexplode(F.concat(F.array(nothing), zipped)).alias("pos", "g"))
    side = side.select("__key", "hash_x", "hash_y", "n_words", (F.col("pos") - 1).alias("pos"), *[F.col(f"g.w{i}").alias(f"w{i}") for i in range(width)])
    side = side.withColumn("h", F.xxhash64(*[f"w{i}" for i in range(K)]))
    same = reduce(lambda a, b: a & b, [(F.col("k") <= i) | (F.col(f"w{i}") == F.col("gram")[i]) for i in range(width)])
    own = (F.col("pos") < 0) & (F.col("t") == OWN_ROW)
    joined = side.join(F.broadcast(table), "h").where(own | ((F.col("pos") >= 0) & (F.col("t") != OWN_ROW) & same))
    return joined.select("__key", "hash_x", "hash_y", "n_words", "t", "label", "phrase", "k", "grams", "drift", "tpos", "pos")


def spans(found: DataFrame, gap: int = MERGE_GAP, coverage: float = COVERAGE) -> DataFrame:
    """Verified matches: key and hashes, label, phrase, first, last (words) and share."""
    row = ["__key", "hash_x", "hash_y"]
    place = [*row, "t", "label", "phrase", "k", "grams", "drift"]
    votes = found.where(F.col("t") != OWN_ROW).select(*place, "tpos", "pos", (F.col("pos") - F.col("tpos")).alias("diag")).distinct()
    voted = votes.groupBy(*place, "diag").agg(F.collect_list(F.struct("pos", "tpos")).alias("votes"))  # a template's grams at most
    # neighbouring diagonals form a run; one that drifts too far falls apart into its diagonals
    order = Window.partitionBy(*row, "t").orderBy("diag")
    runs = voted.withColumn("new", (F.col("phrase") | (F.col("diag") - F.lag("diag").over(order) > gap)).cast("int"))
    runs = runs.withColumn("run", F.sum(F.coalesce("new", F.lit(0))).over(order))
    whole = Window.partitionBy(*row, "t", "run")
    alone = F.max("diag").over(whole) - F.min("diag").over(whole) > F.col("drift")
    runs = runs.withColumn("alone", F.when(alone, F.col("diag")))
    merged = runs.groupBy(*place, "run", "alone").agg(F.array_sort(F.flatten(F.collect_list("votes"))).alias("votes"))
    # a vote is in order if it stands behind all earlier ones in the template too
    start = F.struct(F.lit(-1).alias("top"), F.lit(0).alias("n"))
    count = F.aggregate("votes", start, lambda s, v: F.when(v["tpos"] > s["top"], F.struct(v["tpos"].alias("top"), (s["n"] + 1).alias("n"))).otherwise(s), lambda s: s["n"])
    judged = merged.withColumn("share", count / F.col("grams"))
    judged = judged.where((F.col("share") == 1) | (~F.col("phrase") & (F.col("share") >= coverage)))
    first, last = F.array_min("votes.pos"), F.array_max("votes.pos") + F.col("k") - 1
    return judged.select(*row, "label", "phrase", first.alias("first"), last.alias("last"), "share")


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: list[tuple] | None = None) -> DataFrame:
    """For each row: key, n_words, spans (label, phrase, first, last, share) in
    order of their place, and ``score``, the greatest share."""
    found = materialize(hits(docs, text, key, templates or template_rows()), "license-hits")
    matched = spans(found).groupBy("__key", "hash_x", "hash_y").agg(F.array_sort(F.collect_list(F.struct("first", "last", "label", "phrase", "share"))).alias("spans"))
    matched = matched.toDF("__k", "__x", "__y", "spans")
    rows = found.where(F.col("t") == OWN_ROW).select("__key", "hash_x", "hash_y", "n_words")
    joined = rows.join(matched, F.col("__key").eqNullSafe(F.col("__k")) & (F.col("hash_x") == F.col("__x")) & (F.col("hash_y") == F.col("__y")), "left")
    none = F.expr("cast(array() as array<struct<first: int, last: int, label: string, phrase: boolean, share: double>>)")
    out = joined.select(F.col("__key").alias(key), "n_words", F.coalesce("spans", none).alias("spans"))
    return out.withColumn("score", F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)))
