"""Whole-text licence scan by canonical digests. Native.

A text is made canonical (case, copyright lines, punctuation and white space, equivalent
spellings), its digest is joined to the digests of known licences. Only entire texts match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence matching guidelines treat as the same word.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("owner", "holder"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("sublicence", "sublicense"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("percent", "per cent"), ("https", "http"),
)

# Texts of short public licences and the notices that stand for longer ones.
_MIT = """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """ISC License
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_ZLIB = """zlib License
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <http://unlicense.org/>"""
KNOWN = (
    ("MIT", _MIT), ("ISC", _ISC), ("BSD-2-Clause", _BSD.format(third="")), ("BSD-3-Clause", _BSD.format(third=_THIRD)),
    ("Zlib", _ZLIB), ("Unlicense", _UNLICENSE),
    ("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that only claims rights, with the line break before it.
COPYRIGHT_LINE = r"(^|\n)[ \t]*((copyright|\(c\)|©)[^\n]*(\(c\)|©|[0-9]{4}|<year>|\[year\])|(copyright )?(\(c\)|©) [^\n]*|all rights reserved)[^\n]*"
OTHER_SIGNS = r"[^a-z0-9\x{0080}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """Null is empty. Letters beyond ASCII stay as they are."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    bare = F.regexp_replace(lowered, COPYRIGHT_LINE, "\n")
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.replace(bare, F.lit("&"), F.lit(" and ")), OTHER_SIGNS, " "), F.lit(" "))
    for word, same in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {word} "), F.lit(f" {same} "))
    return F.trim(spaced)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license_id); one row per digest, the first licence that has it."""
    texts = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(known)], "place int, name string, body string")
    return (texts.select(F.sha2(canonical(F.col("body")), 256).alias("digest"), "name", "place")
            .groupBy("digest").agg(F.min_by("name", "place").alias("license_id")))


def scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, digest, license_id) for every row; null where the whole text is no known licence.

    The join is by digest; Spark broadcasts the known side if its measured size allows.
    Null and empty texts have the digest of the empty text and match nothing; rows that
    repeat match each.
    """
    digests = docs.select(F.col(id_column).alias("doc_id"), F.sha2(canonical(F.col(text_column)), 256).alias("digest"))
    return digests.join(known, "digest", "left").select("doc_id", "digest", "license_id")


def _sql_canonical(column: str) -> str:
    inner = f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"
    inner = f"regexp_replace({inner}, '{COPYRIGHT_LINE}', chr(10), 'g')"
    inner = f"' ' || regexp_replace(replace({inner}, '&', ' and '), '{OTHER_SIGNS}', ' ', 'g') || ' '"
    for word, same in SPELLINGS:
        inner = f"replace({inner}, ' {word} ', ' {same} ')"
    return f"trim({inner}, ' ')"


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL = f"""
WITH known(place, name, body) AS (VALUES {", ".join(f"({k}, '{n}', {_sql_text(t)})" for k, (n, t) in enumerate(KNOWN))}),
digests AS (SELECT sha256({_sql_canonical('body')}) AS digest, arg_min(name, place) AS license_id FROM known GROUP BY 1),
d AS (SELECT doc_id, sha256({_sql_canonical('text')}) AS digest FROM documents)
SELECT d.doc_id, d.digest, digests.license_id FROM d LEFT JOIN digests USING (digest)
"""
