"""Licence scans by canonical digest: entire texts, and entire lines, hash-joined to known licences and notices.

The canonical form lowers case, drops copyright lines, writes equivalent spellings one way and turns punctuation and white
space into single spaces. Two texts that differ in those respects only have one digest. All of it runs in SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

# Equivalent spellings, as (pattern of whole words, one way to write them).
SPELLINGS = (
    ("licen[cs]e(d|s|e|es|r|rs|ing)?", "license$1"),
    ("sub[ -]license", "sublicense"),
    ("copyright (owner|holder)", "copyright holder"),
    ("acknowledgement", "acknowledgment"),
    ("authori[sz]ed", "authorized"),
    ("organi[sz]ation", "organization"),
    ("favour", "favor"),
    ("non[ -]commercial", "noncommercial"),
    ("v(ersion|er)?[. ]*([0-9]+)([.]0)?", "version $2"),
    ("https", "http"),
)
# Lines that name a holder and say nothing about the terms; and lines that only reserve all rights.
COPYRIGHT = "(^|\n)[ \t]*(copyright[ \t]+([(]c[)]|©|[0-9]{4}|<year>|\\[yyyy\\])|[(]c[)]|©)[^\n]*"
RESERVED = "^[ \t]*all rights reserved[.]?[ \t\r]*$"
PUNCTUATION = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F“”‘’–—«»]+"

# Licences (SPDX id, names in use), the texts of short licences, and the wordings of notices.
NAMES = (
    ("MIT", ("MIT License", "MIT Licence", "MIT")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0", "GPLv2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0", "GPLv3")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "MPL-2.0", "MPL 2.0")),
    ("ISC", ("ISC License", "ISC")),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD")),
    ("Zlib", ("zlib License", "Zlib")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License - Version 1.0", "BSL-1.0")),
    ("Unlicense", ("Unlicense", "The Unlicense")),
    ("CC0-1.0", ("CC0 1.0", "CC0-1.0", "CC0 1.0 Universal")),
    ("CC-BY-4.0", ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License")),
)
WORDINGS = ("{}", "Released under the {}.", "Released under {}.", "Licensed under the {}.", "Licensed under {}.", "Distributed under the {}.", "This work is licensed under the {}.", "This work is licensed under a {}.", "This project is licensed under the {}.", "SPDX-License-Identifier: {}")
TEXTS = (
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org/>'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
)


def known() -> list[tuple[str, str]]:
    """(licence, text) of every licence text, with and without its name as a title, and of every notice: built by rule."""
    names = dict(NAMES)
    titled = [(lic, f"{title}\n\n{t}") for lic, t in TEXTS for title in ("", *names[lic], *(f"The {n}" for n in names[lic]))]
    return [*titled, *((lic, w.format(name)) for lic, names in NAMES for name in names for w in WORDINGS)]


def canonical_lines(text: Column) -> Column:
    """The canonical form with its lines kept apart; null is empty."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT, "$1")
    out = F.regexp_replace(out, f"(?md){RESERVED}", "")  # in its own line only: the next line stays
    for pattern, one_way in SPELLINGS:
        out = F.regexp_replace(out, rf"\b{pattern}", one_way)
    return F.regexp_replace(out, PUNCTUATION, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.md5(F.trim(F.regexp_replace(text, "[ \n]+", " "))))


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license): one row per digest; a fixed table of a few hundred rows."""
    rows = spark.createDataFrame(known(), "license string, text string")
    return rows.groupBy(digest(canonical_lines(F.col("text"))).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, licenses: DataFrame | None = None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, license, notices) for every row: the licence that the entire text is, and those that entire lines are.

    ``license`` is null unless the whole text's digest is known; ``notices`` holds distinct licences in order. Null, empty and
    unlicensed texts have null and an empty list. Repeated rows each have their row; no rows, no rows; other columns are ignored.
    """
    licenses = known_digests(docs.sparkSession) if licenses is None else licenses
    lines = canonical_lines(F.col(text))
    digests = F.array_distinct(F.transform(F.filter(F.split("lines", "\n"), lambda x: F.trim(x) != ""), digest))
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), lines.alias("lines")).select("doc_id", digest(F.col("lines")).alias("digest"), digests.alias("parts")))
    hits = rows.select("doc_id", F.col("digest").alias("of"), F.explode("parts").alias("digest")).join(licenses, "digest")
    hits = hits.groupBy(F.col("doc_id").alias("_id"), "of").agg(F.array_sort(F.collect_set("license")).alias("notices"))
    whole = rows.select("doc_id", "digest").join(licenses, "digest", "left")
    return whole.join(hits, F.expr("doc_id <=> _id AND digest = of"), "left").select("doc_id", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "license", F.size("notices").cast("long").alias("n_notices"), F.array_join("notices", ",").alias("notices"))


def oracle() -> str:
    """The report as SQL: the same steps over the same fixed tables."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    value = "lower(coalesce(t, ''))"
    value = f"regexp_replace({value}, {quote(COPYRIGHT)}, {quote(chr(92) + '1')}, 'g')"
    value = f"regexp_replace({value}, {quote('(?m)' + RESERVED)}, '', 'g')"
    for pattern, one_way in SPELLINGS:
        to = one_way.replace("$", "\\")
        value = f"regexp_replace({value}, {quote(chr(92) + 'b' + pattern)}, {quote(to)}, 'g')"
    value = f"regexp_replace({value}, {quote(PUNCTUATION)}, ' ', 'g')"
    one = lambda x: f"md5(trim(regexp_replace({x}, '[ ' || chr(10) || ']+', ' ', 'g'), ' '))"
    values = ", ".join(f"({quote(lic)}, {quote(t)})" for lic, t in known())
    return f"""
WITH raw(license, t) AS (VALUES {values}),
known AS (SELECT {one('x')} AS digest, min(license) AS license FROM (SELECT license, {value} AS x FROM raw) GROUP BY 1),
docs AS (SELECT doc_id, x, {one('x')} AS digest FROM (SELECT doc_id, {value} AS x FROM (SELECT doc_id, text AS t FROM documents))),
parts AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS part FROM docs),
notices AS (SELECT doc_id, list_sort(list(DISTINCT license)) AS found FROM parts JOIN known ON {one('part')} = known.digest WHERE trim(part, ' ') <> '' GROUP BY doc_id)
SELECT docs.doc_id, known.license, CAST(coalesce(len(found), 0) AS BIGINT) AS n_notices, coalesce(array_to_string(found, ','), '') AS notices
FROM docs LEFT JOIN known ON docs.digest = known.digest LEFT JOIN notices ON docs.doc_id = notices.doc_id
"""
