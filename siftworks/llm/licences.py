"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams (DataFrame operations only).

Text is lower-cased and everything but a-z and 0-9 parts words, so comment marks, line breaks and punctuation don't count. A unit
is a run of words; its set of word bigrams A is compared with a template's, B: 2 |A and B| / (|A| + |B|). That can reach the
threshold t only if |A| is from t / (2 - t) to (2 - t) / t times |B|, and only if A has t / (2 - t) of B: so of any |B| -
ceil(|B| t / (2 - t)) + 1 bigrams of the template a unit that reaches it has one. The longest bigrams are taken for these anchors, as
they are rare in other texts. Words of all documents are joined with the anchors where they are read, and only what matches goes on.

Units are all runs that begin and end with a bigram of the template (others score higher without their ends) and have (2 - t) / t times
the template's words at most. So a licence is found wherever it stands, with words put in, left out or changed: alone, wrapped into
comment lines above other text, or within a line. Starts are dealt into blocks of that many words; an anchor opens the one or two
blocks in which runs that hold it start. A block's words and the next one's have all its units, so long texts are never moved whole. A
block that has too few of the template's bigrams is left out; of the others each start is extended word by word, with running counts of
the bigrams that are new since the start and of those that are the template's.

Defined cases: null and empty texts have no units; texts of one word have no bigrams and match nothing; templates of one word are
left out; per document and template the best unit counts (ties: the first, then the shortest); rows that repeat a doc_id are one
document, as are those without one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import listed, text_or_empty

THRESHOLD = 0.8
SLACK = 1e-9

# Notices, headers and short licence texts, as published (without copyright lines). Longer texts are handed to
# scan() by their user.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-licensed": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the Software.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>",
}


def plain_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def pairs(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def anchors(templates: dict[str, str], threshold: float) -> list[tuple[str, str]]:
    """licence, bigram: as many bigrams of each template as any unit that reaches the threshold has one of, the longest (ties: in order of
    the alphabet)."""
    rows = []
    for name, text in templates.items():
        grams = sorted(set(pairs(plain_words(text))), key=lambda g: (-len(g), g))
        rows += [(name, g) for g in grams[: len(grams) - fewest(len(grams), threshold) + 1] if grams]
    return rows


def fewest(grams: int, threshold: float) -> int:
    """How many of a template's bigrams a unit has at least."""
    return math.ceil(grams * threshold / (2 - threshold) - SLACK)


def most_words(words: int, threshold: float) -> int:
    """How many words a unit has at most."""
    return max(2, math.floor(words * (2 - threshold) / threshold + SLACK))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def best_unit(words: Column, grams: Column, most: Column) -> Column:
    """Of the units that start among the first `most` of the words: struct of score, start and end (both negative, so that the greatest is
    the best). Each variable of a lambda is computed once."""

    def marked(b: Column) -> Column:  # of each bigram: is it the template's, and where did it stand before
        return F.transform(b, lambda x, i: F.struct(F.array_contains(grams, x).alias("hit"), (i - F.array_position(F.reverse(F.slice(b, 1, i)), x)).alias("back"), F.array_contains(F.slice(b, 1, i), x).alias("again")))

    def extended(items: Column, s: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            new = (~x["again"] | (x["back"] < s)).cast("int")
            have, hits = a["have"] + new, a["hits"] + F.when(x["hit"], new).otherwise(0)
            score = F.lit(2.0) * hits / (have + F.size(grams))
            better = x["hit"] & (score > a["score"])
            return F.struct((a["at"] + 1).alias("at"), have.alias("have"), hits.alias("hits"), F.when(better, score).otherwise(a["score"]).alias("score"), F.when(better, a["at"]).otherwise(a["end"]).alias("end"))

        zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("have"), F.lit(0).alias("hits"), F.lit(0.0).alias("score"), F.lit(0).alias("end"))
        return F.aggregate(F.slice(items, s + 1, most - 1), zero, step, lambda a: F.struct(a["score"].alias("score"), (-s).alias("start"), (-s - a["end"] - 2).alias("end")))

    def of_all(items: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.least(F.size(items), most) - 1), lambda s: F.get(items, s)["hit"])
        return F.array_max(F.transform(starts, lambda s: extended(items, s)))

    return F.element_at(F.transform(F.transform(F.array(bigrams(words)), marked), of_all), 1)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per document and template reached: doc_id, licence, score (the best unit's Dice coefficient), and where that unit starts and
    ends (words)."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    words_of = {name: plain_words(text) for name, text in templates.items()}
    facts = [(name, sorted(set(pairs(w))), most_words(len(w), threshold), fewest(len(set(pairs(w))), threshold)) for name, w in words_of.items() if len(w) > 1]
    known = listed(spark, facts, {"licence": pa.string(), "grams": pa.list_(pa.string()), "most": pa.int32(), "need": pa.int32()})
    entered = listed(spark, [(gram, name) for name, gram in anchors(templates, threshold)], {"gram": pa.string(), "licence": pa.string()}).join(F.broadcast(known), "licence")
    words = docs.select("doc_id", F.split(normalised(text_or_empty()), " ").alias("words"), F.md5(text_or_empty()).alias("row"))
    # the words ride along, but only rows that match an anchor are made
    each = words.select("doc_id", "row", "words", F.posexplode("words").alias("at", "word"))
    gram = F.concat("word", F.lit(" "), F.try_element_at("words", F.col("at") + 2))
    met = each.withColumn("gram", gram).join(F.broadcast(entered), "gram")  # bounded by the templates
    first, last = (F.floor(x / F.col("most")).cast("int") for x in (F.greatest(F.col("at") - F.col("most") + 2, F.lit(0)), F.col("at")))
    blocks = met.select("doc_id", "row", "words", "licence", "grams", "most", "need", F.explode(F.array_distinct(F.array(first, last))).alias("block"))
    blocks = blocks.withColumn("piece", F.slice("words", F.col("block") * F.col("most") + 1, 2 * F.col("most")))
    blocks = blocks.where(F.size(F.array_intersect(bigrams(F.col("piece")), "grams")) >= F.col("need"))
    blocks = blocks.groupBy("doc_id", "row", "licence", "block").agg(F.first("piece").alias("piece")).join(F.broadcast(known), "licence")  # each block once
    found = blocks.select("doc_id", "licence", (F.col("block") * F.col("most")).alias("shift"), best_unit(F.col("piece"), F.col("grams"), F.col("most")).alias("u")).where(F.col("u.score") >= threshold - SLACK)
    best = found.groupBy("doc_id", "licence").agg(F.max(F.struct(F.col("u.score").alias("score"), (F.col("u.start") - F.col("shift")).alias("start"), (F.col("u.end") - F.col("shift")).alias("end"))).alias("b"))
    return best.select("doc_id", "licence", "b.score", (-F.col("b.start")).alias("start"), (-F.col("b.end")).alias("end"))
