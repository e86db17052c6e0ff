"""Licence scan: whole texts and their single lines are looked up by canonical digest.

*Canonical form.* Letters are lower-cased; equivalent spellings become one (licence / license, "sub-license" / "sublicense",
http / https, copyright owner / holder); lines that state a copyright, with a year or without, title lines and "all rights
reserved" go; everything that is neither letter nor digit becomes one space; and whoever the conditions name (the holder, the
author, the regents, a company) becomes one word. The digest is SHA-256 of what is left.

*Lookup.* A table of known licences, notices and their names is brought to the same form. Texts are joined to it by
digest: a hash join, as the table is small and of fixed size. Single lines are looked up in the row they stand in,
through a map of the same digests.

A null text is the empty one; texts without letters or digits have the digest of nothing and no licence. Repeated rows
get the same result; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm.common import whole_texts

# Names and texts of licences and of the notices by which files name them.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. * Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org/>"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MIT", "This work is licensed under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]

# Spellings that mean the same, in this order; then lines that say nothing about the terms.
_REPLACED = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("non-commercial", "noncommercial"),
    ("https://", "http://"),
    ("copyright notice", "notice"),
    ("copyright owner", "holder"),
    ("copyright holder", "holder"),
    ("copyright law", "law"),
    ("copyright interest", "interest"),
    ("copyright license", "right"),
    ("\n", "\n\n"),
]
_TITLES = (
    "mit|expat|isc|zlib|apache|unlicense|(?:(?:new|modified|simplified|revised) )?bsd(?:[ -][0-4][ -]clause)?|[0-4][ -]clause bsd"
    "|mit/x11|bsd license 2[.]0|the bsd"
)
_DROPPED = [
    r"(?:all[ \t\r\n]+)?rights[ \t\r\n]+reserved\.?",
    r"(?:^|\n)[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*",
    rf"(?:^|\n)[^a-z0-9\n]*(?:the )?(?:{_TITLES})(?: license)?(?: \([^)\n]*\))?[ \t\r:.=*-]*(?:\n|$)",
]
_NAMED = [
    ("copyright (notice|holder|law|interest)", r"\1"),
    ("copyright owner", "holder"),
    (r"the name of .{1,150}? may not be used to endorse", "neither the name of holder nor the names of its contributors may be used to endorse"),
    (r"neither the names? of .{1,150}? nor the names of (?:(?:its|their|any|other) )?contributors", "neither the name of holder nor the names of its contributors"),
    (r"software is provided by .{1,150}? as is and any", "software is provided by holder as is and any"),
    (r"in no event shall .{1,150}? be liable", "in no event shall holder be liable"),
]

MENTIONS = "licen[sc]e|permission"


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    form = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for other, one in _REPLACED:
        form = F.replace(form, F.lit(other), F.lit(one))
    for pattern in _DROPPED:
        form = F.regexp_replace(form, pattern, "\n")
    form = F.trim(F.regexp_replace(form, r"[^\p{L}\p{Nd}]+", " "))
    for pattern, one in _NAMED:
        form = F.regexp_replace(form, pattern, one.replace("\\1", "$1"))
    return form


def known_digests(spark: SparkSession) -> DataFrame:
    """digest -> license; one row per known text, a fixed number of them."""
    rows = spark.createDataFrame(KNOWN, "license string, text string")
    digest = F.sha2(canonical(F.col("text")), 256)
    return rows.groupBy(digest.alias("digest")).agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, canonical_sha256, license (of the whole text, else null), line_licenses (distinct, sorted, joined by commas).

    The lines of a text are looked up in the row they stand in, through a map of the known digests: no row is
    exploded or shuffled for them.
    """
    spark = docs.sparkSession
    known = known_digests(spark)
    lookup = {row["digest"]: row["license"] for row in known.collect()}  # the fixed table, not the documents
    table = F.create_map(*[F.lit(x) for pair in sorted(lookup.items()) for x in pair])
    texts = whole_texts(docs).withColumn("canonical_sha256", F.sha2(canonical(F.col("text")), 256))
    wordy = F.filter(F.split("text", "\n"), lambda line: F.lower(line).rlike(MENTIONS))
    found = F.transform(wordy, lambda line: F.try_element_at(table, F.sha2(canonical(line), 256)))
    names = F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",")
    lined = F.when(F.lower("text").rlike(MENTIONS), names).otherwise(F.lit(""))
    scanned = texts.withColumn("line_licenses", lined)
    joined = scanned.join(F.broadcast(known), scanned["canonical_sha256"] == known["digest"], "left")
    return joined.select("doc_id", "canonical_sha256", "license", "line_licenses")


def license_scan_sql() -> str:
    """The same scan of ``documents`` in SQL."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def form(text: str) -> str:
        made = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        for other, one in _REPLACED:
            made = f"replace({made}, {quoted(other)}, {quoted(one)})"
        for pattern in _DROPPED:
            made = f"regexp_replace({made}, {quoted(pattern)}, chr(10), 'g')"
        made = f"trim(regexp_replace({made}, '[^\\p{{L}}\\p{{Nd}}]+', ' ', 'g'))"
        for pattern, one in _NAMED:
            made = f"regexp_replace({made}, {quoted(pattern)}, {quoted(one)}, 'g')"
        return made

    rows = ", ".join(f"({quoted(license)}, {quoted(text)})" for license, text in KNOWN)
    return f"""
WITH listed(license, text) AS (VALUES {rows}),
known AS (SELECT sha256({form("text")}) AS digest, min(license) AS license FROM listed GROUP BY 1),
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts WHERE regexp_matches(lower(text), '{MENTIONS}')),
named AS (
  SELECT doc_id, license FROM lines JOIN known ON sha256({form("line")}) = digest
  WHERE regexp_matches(lower(line), '{MENTIONS}')),
joined AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses FROM named GROUP BY doc_id),
digests AS (SELECT doc_id, sha256({form("text")}) AS canonical_sha256 FROM texts)
SELECT doc_id, canonical_sha256, license, coalesce(line_licenses, '') AS line_licenses
FROM digests LEFT JOIN known ON canonical_sha256 = digest LEFT JOIN joined USING (doc_id)
"""
