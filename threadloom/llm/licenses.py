"""Licence statements anywhere in texts: Dice coefficient over word bigrams of windows against templates. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DICE = 0.8

# Statements and notices of common licences, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}


# Whole texts of short licences.
WHOLE: dict[str, str] = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}
for _name, _text in WHOLE.items():
    TEMPLATES.setdefault(_name, []).append(_text)


def template_rows(spark: SparkSession, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(license, template, text); the list is a parameter of the job, not data that grows."""
    given = TEMPLATES if templates is None else templates
    rows = [F.struct(F.lit(name).alias("license"), F.lit(i).alias("template"), F.lit(text).alias("text")) for name, texts in given.items() for i, text in enumerate(texts)]
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("t")) if rows else None
    return table.select("t.*") if rows else spark.createDataFrame([], "license string, template int, text string")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def bigrams(of: Column) -> Column:
    n = F.size(of)
    return F.when(n > 1, F.zip_with(F.slice(of, 1, n - 1), F.slice(of, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(
        F.array().cast("array<string>")
    )


def scan(docs: DataFrame, templates: DataFrame, least: float = DICE) -> DataFrame:
    """(doc_id, license, dice, statements): licences found in ``docs(doc_id, text)``, with the best coefficient and the number
    of statements, which are stretches of overlapping windows at or above ``least`` for any template of the licence.

    A text is one sequence of words, whatever its lines. A template of m bigrams is compared with the windows of m bigrams
    that begin with one of its own; at the end of the text they are shorter. No other window of that size is better: moved to
    its first bigram of the template it keeps all it shares. The coefficient is 2 * common / (bigrams of the window + m),
    repeats counted. Only sizes whose quotient is at least ``least / (2 - least)`` can reach ``least``: shorter texts never
    meet the template, and a window is looked at only if so many of the template's bigrams lie in it. The templates' bigrams
    are the one thing that is broadcast; just the places where they occur leave their task.

    Null texts and texts of fewer than two words give nothing; rows under one id, alike or not, are scanned apart. Long texts
    are read whole. Templates that are equally near count once. Extra columns are not read. No documents or no templates give
    no rows.
    """
    low = least / (2 - least)
    known = templates.select("license", "template", bigrams(words(F.col("text"))).alias("_b")).withColumn("_size", F.size("_b"))
    known = known.select("license", "template", "_size", "_b", F.posexplode(F.array_distinct("_b")).alias("_gram", "_bigram")).select(
        "license", "template", "_size", F.ceil(F.col("_size") * low - 1e-9).cast("int").alias("_need"), "_gram", "_bigram",
        F.size(F.filter("_b", lambda b: b == F.col("_bigram"))).alias("_theirs"),
    )
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), words(F.col("text")).alias("_words"))
    parts = numbered.select("doc_id", "_row", (F.size("_words") - 1).alias("_n"), F.posexplode(bigrams(F.col("_words"))).alias("_at", "_bigram"))
    met = parts.join(F.broadcast(known), "_bigram").filter(F.col("_n") >= F.col("_need"))
    template = ["license", "template", "_size"]
    keys = ["doc_id", "_row", "_n", *template, "_need"]
    # A hit is one number: its place in the upper half, the template's bigram in the lower one.
    hit = F.shiftleft(F.col("_at").cast("long"), 32) + F.col("_gram")
    place = lambda h: F.shiftright(h, 32)
    hits = met.groupBy(*keys).agg(F.sort_array(F.collect_list(hit)).alias("_hits")).filter(F.size("_hits") >= F.col("_need"))
    dense = lambda i: place(F.get("_hits", i + F.col("_need") - 1)) - place(F.get("_hits", i)) < F.col("_size")
    begun = hits.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.size("_hits") - F.col("_need")), dense)).alias("_i"))
    begun = begun.withColumn("_start", place(F.get("_hits", F.col("_i")))).withColumn("_length", F.least("_size", F.col("_n") - F.col("_start")))
    inside = F.filter(F.slice("_hits", F.col("_i") + 1, F.col("_size")), lambda h: place(h) < F.col("_start") + F.col("_length"))
    windows = begun.select("doc_id", "_row", *template, "_start", "_length", inside.alias("_inside"))
    windows = windows.filter(2 * F.size("_inside") >= least * (F.col("_size") + F.col("_length")) - 1e-9)
    window = ["doc_id", "_row", "_start", "_length", *template]
    counted = windows.select(*window, F.explode("_inside").alias("_hit")).groupBy(*window, F.col("_hit").bitwiseAND(0xFFFFFFFF).alias("_gram"))
    ours = counted.agg(F.count(F.lit(1)).alias("_ours")).join(F.broadcast(known.select("license", "template", "_gram", "_theirs")), ["license", "template", "_gram"])
    common = ours.groupBy(*window).agg(F.sum(F.least("_ours", "_theirs")).alias("_common"))
    found = common.withColumn("_dice", 2.0 * F.col("_common") / (F.col("_length") + F.col("_size"))).filter(F.col("_dice") >= least)
    before = Window.partitionBy("doc_id", "_row", "license").orderBy("_start").rangeBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("_reach", F.max(F.col("_start") + F.col("_length")).over(before))
    fresh = F.when(F.col("_reach").isNull() | (F.col("_reach") <= F.col("_start")), F.col("_start"))
    return found.groupBy("doc_id", "_row", "license").agg(F.max("_dice").alias("dice"), F.count_distinct(fresh).alias("statements")).drop("_row")
