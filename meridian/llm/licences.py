"""Licence scans by canonical digests.

A text is brought to a canonical form (letter case, copyright lines, equivalent spellings, punctuation, line breaks and
spacing) and its digest is joined to the digests of known licences. The units are the entire text and, for the notices
that close a document, each of its lines; one hash join with one known table serves both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import table

#: Letters in upper case to lower case; punctuation, and dashes and quotes beyond ASCII, to blanks. One translation does both.
SIGNS = "!\"#$%'()*+,-./:;<=>?@[\\]^_`{|}~\u2018\u2019\u201c\u201d\u2013\u2014\u2026\u00a0"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDED, PLAIN = UPPER + SIGNS, LOWER + " " * len(SIGNS)
#: Lines that name the holders, which canonical texts don't have: "copyright" with a year, its placeholder, (c) or the sign;
#: (c) with a year; the sign; "all rights reserved" by itself.
HOLDERS = r"^[^a-zA-Z0-9\n(©]*((?i:copyright)[^\n]*([0-9]{4}|\([cC]\)|©|[<\[]((?i:year|yyyy)))[^\n]*|\([cC]\)[^\n]*[0-9]{4}[^\n]*|©[^\n]*|(?i:all rights reserved)[^a-zA-Z0-9\n]*)$"
#: Holder lines can be there only if one of these is.
HOLDING = r"(?i)copyright|\(c\)|©|all rights reserved"
BLANKS = r"[\x00-\x20\x7f]+"
#: Spellings that count as the same, after translation.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("https", "http"),
    ("&", "and"),
)
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_BSD_FOURTH = """
3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization.

4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE_MORE = "\n\nFor more information, please refer to <http://unlicense.org/>"
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_WTFPL = """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO."""
_FSFAP = """Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty."""


def _gnu_notice(name: str, version: str, what: str = "program") -> str:
    """The notice that the GNU licences ask for at the head of a file."""
    return f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

You should have received a copy of the {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."""


#: Known texts and their identifiers. Texts that name holders stand without those lines.
TEXTS = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT-0", _MIT.replace(", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ".")),
    ("X11", _MIT + "\n\nExcept as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium."),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-4-Clause", _BSD_HEAD + _BSD_FOURTH + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + _UNLICENSE_MORE),
    ("BSL-1.0", _BOOST),
    ("MPL-2.0", _MPL_NOTICE),
    ("WTFPL", _WTFPL),
    ("FSFAP", _FSFAP),
    ("GPL-2.0", _gnu_notice("GNU General Public License", "2")),
    ("GPL-3.0", _gnu_notice("GNU General Public License", "3")),
    ("LGPL-2.1", _gnu_notice("GNU Lesser General Public License", "2.1", "library")),
    ("LGPL-3.0", _gnu_notice("GNU Lesser General Public License", "3", "library")),
    ("AGPL-3.0", _gnu_notice("GNU Affero General Public License", "3")),
)
#: Digests of the canonical forms of long licences' full texts.
DIGESTS = (
    ("Apache-2.0", "e32aea965561f41a8390221b29af2726"),
    ("Apache-2.0", "907c90224903199ffe6fc357841e86c5"),
    ("Artistic-1.0", "01297679267ad921516667ccd889865e"),
    ("CC0-1.0", "d2a76f70ce19809695b7fb93c6241c23"),
    ("GFDL-1.2", "49ffacd2fea52c0c124f0d16bc990c74"),
    ("GFDL-1.3", "2d7ce083c264cf7f093acc742260e501"),
    ("GPL-1.0", "738cc3b112640d95d4cd79a58967ecea"),
    ("GPL-2.0", "5e39ace6e62f5a7fe9c17b4da986ad8c"),
    ("GPL-3.0", "b79359b5e391fd47146ff34ae3db7ec0"),
    ("LGPL-2.0", "74cf7fcef3b29a39165a795b2cad3a3a"),
    ("LGPL-2.1", "f998bc436710cfece156aaa84fd26dd4"),
    ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "4ed6600fcf5321eb9dcd2181cde18632"),
    ("MPL-2.0", "b5b7a0cf4994910cd0204fba4637d6ec"),
)
#: Names of licences as one-line notices write them.
NAMES = (
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache 2.0"),
    ("MIT", "the MIT License"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("ISC", "the ISC License"),
    ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
)
LEADS = ("Licensed under", "Released under", "This work is licensed under", "This software is licensed under", "Distributed under", "Available under")
NOTICES = tuple((name, f"{lead} {text}.") for name, text in NAMES for lead in LEADS)
#: Lines that may be notices hold one of these, as each of NOTICES does.
SAID = "(?i)licen|released|distributed|available"


def canonical(text: Column) -> Column:
    """The canonical form: a null text counts as empty."""
    raw = F.coalesce(text.cast("string"), F.lit(""))
    free = F.when(raw.rlike(HOLDING), F.regexp_replace(raw, f"(?md){HOLDERS}", "")).otherwise(raw)
    out = F.regexp_replace(F.translate(free, FOLDED, PLAIN), BLANKS, " ")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.md5(canonical(text).cast("binary"))


def known(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """(whole boolean, digest, licence), one row a digest: entire texts, and one-line notices.

    ``texts`` (licence, text) are further entire texts; where a digest has several licences, the least name stands.
    """
    kind = "licence string, text string"
    plain = spark.createDataFrame(list(TEXTS), kind)
    plain = plain if texts is None else plain.unionByName(texts.select("licence", "text"))
    rows = plain.select(F.lit(True).alias("whole"), digest(F.col("text")).alias("digest"), "licence")
    long = spark.createDataFrame(list(DIGESTS), "licence string, digest string").select(F.lit(True).alias("whole"), "digest", "licence")
    lines = spark.createDataFrame(list(NOTICES), kind).select(F.lit(False).alias("whole"), digest(F.col("text")).alias("digest"), "licence")
    return rows.unionByName(long).unionByName(lines).groupBy("whole", "digest").agg(F.min("licence").alias("licence"))


def scanned(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, digest, licence, notices): a row for every row, repeated and null ids too.

    licence: of the entire text, null if it isn't a known one. notices: sorted distinct licences of its one-line notices,
    comma-joined, empty if there are none. Null texts count as empty; other columns are ignored. ``texts``: as in ``known``;
    without it the known table is a constant of about a hundred rows and is broadcast.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(SAID)), lambda x: F.struct(F.lit(False).alias("whole"), digest(x).alias("digest")))
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), digest(text).alias("digest"))), F.when(text.rlike(SAID), lines).otherwise(F.array_repeat(F.struct(F.lit(True).alias("whole"), F.lit("").alias("digest")), 0)))
    rows = docs.select(F.col("doc_id"), units.alias("units")).withColumn("row", F.monotonically_increasing_id())
    told = known(docs.sparkSession, texts)
    told = F.broadcast(told) if texts is None else told
    joined = rows.select("row", "doc_id", F.explode("units").alias("u")).select("row", "doc_id", "u.whole", "u.digest").join(told, ["whole", "digest"], "left").where("whole OR licence IS NOT NULL")
    found = joined.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("licence")))), ",").alias("notices"),
    )
    return found.select("doc_id", "digest", "licence", "notices")


def op7_licences(spark, sf_dir: str) -> DataFrame:
    """All documents' whole texts and lines against the known table, as ``scanned`` states it."""
    return scanned(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _digest_sql(text: str) -> str:
    out = f"regexp_replace(coalesce({text}, ''), {_quoted('(?m)' + HOLDERS)}, '', 'g')"
    out = f"regexp_replace(translate({out}, {_quoted(FOLDED)}, {_quoted(PLAIN)}), {_quoted(BLANKS)}, ' ', 'g')"
    for a, b in SPELLINGS:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return f"md5(trim({out}))"


def _values(pairs: tuple) -> str:
    return ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in pairs)


ORACLE = f"""
WITH known AS (
  SELECT whole, digest, min(l) AS licence FROM (
    SELECT true AS whole, {_digest_sql("t")} AS digest, l FROM (VALUES {_values(TEXTS)}) v(l, t)
    UNION ALL SELECT true, d, l FROM (VALUES {_values(DIGESTS)}) v(l, d)
    UNION ALL SELECT false, {_digest_sql("t")}, l FROM (VALUES {_values(NOTICES)}) v(l, t)) x GROUP BY 1, 2),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
          FROM (SELECT doc_id, {_digest_sql("line")} AS digest FROM lines) x JOIN known k ON NOT k.whole AND k.digest = x.digest GROUP BY doc_id),
texts AS (SELECT doc_id, {_digest_sql("text")} AS digest FROM documents)
SELECT d.doc_id, d.digest, k.licence, coalesce(f.notices, '') AS notices
FROM texts d LEFT JOIN known k ON k.whole AND k.digest = d.digest LEFT JOIN found f ON f.doc_id = d.doc_id
"""
