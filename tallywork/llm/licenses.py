"""License scan: canonical digests of texts, joined with the digests of known licences.

A text is made canonical: lower case, copyright lines taken out, punctuation and
runs of blanks to one blank, equivalent spellings to one. Then whole documents,
their paragraphs and their lines are looked up by SHA-256, each as an entire
text. The list of known texts is the caller's; it is broadcast while it is
measured to be under `BROADCAST_BYTES`, and joined by a shuffle beyond that.

Null and empty texts hold no licence. Documents with equal doc_id and text have
one result, and each of them gets a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.wording import computed

BROADCAST_BYTES = 64 << 20
#: Spellings that count as the same, applied in this order.
SAME = [
    ("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"),
    ("merchantibility", "merchantability"), ("non commercial", "noncommercial"), ("http www", "https www"),
    ("creative commons", "cc"), ("by nc", "bync"), ("version ", "v"), ("and or", "or"),
]
#: A line that is a notice: copyright with (c), a year, "the" or "by" after it; not a sentence that starts with the word.
COPYRIGHT = (
    r"(?m)^[^\p{L}\n(©]*(?:copyright[^\p{L}\n]*(?:\(c\)|©|[0-9]|the |by )|\(c\)[^\p{L}\n]*[0-9]|©|all rights reserved)[^\n]*$"
)

# Short licences and the notices that stand for longer ones.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version."""
NOTICES = [
    ("MIT", MIT), ("MIT", f"MIT License {MIT}"), ("MIT", f"The MIT License (MIT) {MIT}"), ("ISC", f"ISC License {ISC}"),
    ("MIT", MIT[: MIT.index("The above")]), ("MIT", "MIT License"), ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."), ("MIT", "The MIT License (MIT)"),
    ("MIT", "SPDX-License-Identifier: MIT"), ("ISC", ISC), ("ISC", "Licensed under the ISC License."),
    ("ISC", "SPDX-License-Identifier: ISC"), ("Apache-2.0", APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("GPL-3.0-or-later", GPL3),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def notices(spark: SparkSession) -> DataFrame:
    """The known texts that come with this module: `license`, `text`."""
    rows = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in NOTICES]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _lines_kept(text: Column) -> Column:
    """Canonical but for line ends."""
    text = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT, "")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")
    for other, one in SAME:
        text = F.replace(text, F.lit(other), F.lit(one))
    return text


def _joined(text: Column) -> Column:
    """Without line ends and outer blanks."""
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def canonical(text: Column) -> Column:
    """The form in which texts are compared.

    Spellings are replaced before and after lines are joined: one may be cut by a line end.
    """
    text = _joined(_lines_kept(text))
    for other, one in SAME:
        text = F.replace(text, F.lit(other), F.lit(one))
    return text


def known_digests(known: DataFrame) -> DataFrame:
    """One row per canonical text: `digest` and the names of its licences."""
    rows = known.select("license", canonical(F.col("text")).alias("_text")).filter("_text <> ''")
    return rows.groupBy(F.sha2("_text", 256).alias("digest")).agg(F.sort_array(F.collect_set("license")).alias("names"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per document: the licence of the whole text, and those of any paragraph or line."""
    digests = known_digests(known)
    if (digests.agg(F.sum(F.lit(256) + F.size("names") * 64)).first()[0] or 0) <= BROADCAST_BYTES:
        digests = F.broadcast(digests)
    docs = computed(docs.select("doc_id", F.xxhash64("text").alias("_hash"), "text"), "_text", _lines_kept(F.col("text")))
    pieces = F.concat(F.split("_text", "\n"), F.split("_text", r"\n *\n"))
    units = F.array_distinct(F.transform(pieces, canonical_piece))
    rows = docs.select(
        "doc_id", "_hash",
        F.inline(F.concat(
            F.array(F.struct(F.lit(True).alias("whole"), canonical_piece(F.col("_text")).alias("unit"))),
            F.transform(F.filter(units, lambda unit: unit != ""),
                        lambda unit: F.struct(F.lit(False).alias("whole"), unit.alias("unit"))),
        )),
    ).withColumn("digest", F.sha2("unit", 256))
    rows = rows.join(digests, "digest", "left").filter("whole OR names IS NOT NULL")
    per_doc = rows.groupBy("doc_id", "_hash").agg(
        F.count_if("whole").alias("_copies"),
        F.min(F.when(F.col("whole"), F.array_join("names", ","))).alias("whole_license"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("names")))), ",").alias("licenses"),
    )
    return per_doc.select(
        "doc_id", "whole_license", "licenses",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")


def canonical_piece(text: Column) -> Column:
    """The canonical form of a piece of a text whose lines are canonical already."""
    text = _joined(text)
    for other, one in SAME:
        text = F.replace(text, F.lit(other), F.lit(one))
    return text
