"""Licence scans in Spark expressions only: normalised texts against templates by Dice coefficient over word bigrams.

Each sentence, line, paragraph and the whole text is a unit, so a notice inside a longer line or paragraph is found too.
2|A&B| / (|A|+|B|) >= t needs t/(2-t) <= |A|/|B| <= (2-t)/t, so templates out of these bounds aren't compared with a
unit, and at least t/(2-t) of a template's bigrams are in the unit: a unit without any of the template's anchors (words
in so many of its bigrams that too few are left without one) can't reach t. Units are dropped by words and
anchors before their bigrams are made. Versions and relatives of a licence differ by a word or two, so those words must agree. A document's texts stay in one row: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Licence texts and notices as their publishers word them.
_AS_IS_ISC = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_AS_IS_MIT = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_AS_IS_BSD = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: (id, text, words that a unit must have: what tells it from its other versions). Full texts of the longer licences are found by their
#: titles.
TEMPLATES = [
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _AS_IS_ISC, ""),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "3"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "2"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "2"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "2"),
    ("BSD-2-Clause", f"{_BSD} {_AS_IS_BSD}", ""),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License.", "2"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_AS_IS_BSD}", ""),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", ""),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License.", "3"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)", ""),
    ("CC-BY-3.0", "Licensed under CC BY 3.0.", "3"),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "3"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "4"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "4"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "4"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "4"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0.", "4"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "4"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "4"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "4"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "4"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "4"),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0.", "3"),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "3"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "4"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "4"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "2"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "3"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "3"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _AS_IS_ISC, ""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ""),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1.", "2 1"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "2 1"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "2 1"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "3"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "3"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "3"),
    ("MIT", "Released under the MIT License.", ""),
    ("MIT", _MIT, ""),
    ("MIT", f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS_MIT}", ""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "2"),
    ("MPL-2.0", "Mozilla Public License Version 2.0", "2"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ""),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.", ""),
]
#: Words that tell the licences of a family apart: a unit must have those of the template, and no other.
TELLING = {"CC-": ["commercial", "nc", "nd", "noderivatives", "noderivs", "noncommercial", "sa", "sharealike"], "GPL": ["affero", "lesser", "library"]}


def words(text: Column) -> Column:
    """Normalised words: lower case, letters and digits only."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "), " "), lambda w: w != "")


def bigrams(w: Column) -> Column:
    """Distinct pairs of neighbouring words, as hashes; none for fewer than two words."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))
    return F.array_distinct(F.when(F.size(w) >= 2, pairs).otherwise(F.array().cast("array<long>")))


def anchors(w: list[str], t: float) -> list[str]:
    """Words of a template, the longest first, until fewer than t/(2-t) of its bigrams are without one."""
    left, out = set(zip(w, w[1:])), []
    least = t / (2 - t) * len(left)
    for word in sorted(set(w), key=lambda x: (-len(x), x)):
        if len(left) < least:
            break
        if any(word in pair for pair in left):
            out.append(word)
            left = {pair for pair in left if word not in pair}
    return out


def told_apart(name: str, words_of_it: list[str], must: str) -> tuple[list[str], list[str]]:
    """(words that a unit must have, words that it must not have) to be a template's."""
    telling = next((v for k, v in TELLING.items() if k in name), [])
    own = [w for w in telling if w in words_of_it]
    return sorted({*must.split(), *own}), [w for w in telling if w not in own]


def _templates(spark: SparkSession, templates: list[tuple[str, str, str]], t: float) -> tuple[Column, Column, Column, float, float]:
    """The templates as one literal (name, bigrams, bounds of a unit's size, words a unit must and must not have), all anchors,
    all words that tell templates apart, and the least and the largest bound."""
    rows = spark.createDataFrame(templates, "name string, text string, must string").select("name", "must", words(F.col("text")).alias("w")).select("name", "must", "w", bigrams(F.col("w")).alias("b")).collect()
    told = [told_apart(r.name, r.w, r.must) for r in rows]
    texts = lambda x: F.array(*map(F.lit, x)).cast("array<string>")
    made = [
        F.struct(F.lit(r.name).alias("name"), F.array(*map(F.lit, r.b)).alias("b"), F.lit(t / (2 - t) * len(r.b)).alias("lo"), F.lit((2 - t) / t * len(r.b)).alias("hi"), texts(yes).alias("yes"), texts(no).alias("no"))
        for r, (yes, no) in zip(rows, told, strict=True)
    ]
    known = sorted({word for r in rows for word in anchors(r.w, t)})
    marks = sorted({x for yes, no in told for x in (*yes, *no)})
    sizes = [len(r.b) for r in rows]
    return F.array(*made), F.array(*map(F.lit, known)), texts(marks), t / (2 - t) * min(sizes), (2 - t) / t * max(sizes)


def scan(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license_id, dice and n_matches of each row of docs (doc_id, text; other columns are ignored).

    n_matches counts units of distinct words that reach the threshold with some template and have the words that tell
    it from its versions and relatives; license_id is the best one's
    (ties: the greater name) and dice its coefficient, both null if there is none. A null or empty text has none; an empty
    table gives no rows, and repeated rows count each. A sentence ends at . ! ? ; and a space, or with its line; an
    empty line ends a paragraph."""
    known, anchored, marks, least, most = _templates(docs.sparkSession, templates, threshold)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sentences = lambda line: F.transform(F.split(line, "(?<=[.!?;])[ \\t]+"), words)
    nested = F.transform(F.split(text, "\n[ \\t\\r]*\n"), lambda paragraph: F.transform(F.split(paragraph, "\n"), sentences))
    one = docs.select("doc_id", nested.alias("n"))
    two = one.select("doc_id", F.flatten("n").alias("lines"), F.transform("n", lambda x: F.flatten(F.flatten(x))).alias("paragraphs"))
    three = two.select("doc_id", F.concat(F.flatten("lines"), F.transform("lines", F.flatten), "paragraphs", F.array(F.flatten("paragraphs"))).alias("u"))
    may = lambda w: (F.size(w) - 1 >= F.lit(least)) & F.arrays_overlap(w, anchored)
    # the last unit is the whole text: one without any anchor has no unit with one
    some = three.select("doc_id", F.when(F.arrays_overlap(F.element_at("u", -1), anchored), F.col("u")).otherwise(F.slice("u", 1, 0)).alias("u"))
    # equal units stand side by side once they are sorted by their hash
    four = some.select("doc_id", F.array_sort(F.transform(F.filter("u", may), lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))).alias("s"))
    new = F.filter("s", lambda x, i: (i == 0) | (x != F.get(F.col("s"), i - 1)))
    five = four.select("doc_id", F.transform(new, lambda x: F.struct(bigrams(x["w"]).alias("b"), F.array_intersect(x["w"], marks).alias("m"))).alias("u"))
    sized = F.filter("u", lambda x: (F.size(x["b"]) > 0) & (F.size(x["b"]) <= most))

    def best(u: Column) -> Column:
        b, n = u["b"], F.size(u["b"])
        near = F.filter(known, lambda t: (n >= t["lo"]) & (n <= t["hi"]) & (F.size(F.array_except(t["yes"], u["m"])) == 0) & ~F.arrays_overlap(t["no"], u["m"]))
        return F.array_max(F.transform(near, lambda t: F.struct((2.0 * F.size(F.array_intersect(b, t["b"])) / (n + F.size(t["b"]))).alias("dice"), t["name"].alias("name"))))

    found = five.select("doc_id", F.filter(F.transform(sized, best), lambda x: x["dice"] >= threshold).alias("m"))
    top = F.array_max("m")
    return found.select("doc_id", top["name"].alias("license_id"), top["dice"].alias("dice"), F.size("m").cast("long").alias("n_matches"))
