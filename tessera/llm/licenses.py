"""License scan by canonical digests: texts are normalised (case, punctuation,
copyright lines, equivalent spellings) and whole texts are hash-joined to the
digests of known licences.  DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence matching treats as equal, applied to
# lower-cased words with single spaces between them.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("favour", "favor"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("redistributor s", "redistributors"),
    ("copyright owner", "copyright holder"),
    ("whilst", "while"),
    ("https", "http"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_TERMS = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_1 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3RD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Fixed values: (SPDX name, text) of known licences and of the usual notices
# that stand for one; titles are optional, so some stand here with and without.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("ISC", _ISC_TERMS + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END),
    ("ISC", "ISC License\n" + _ISC_TERMS + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END),
    ("0BSD", _ISC_TERMS + ".\n" + _ISC_END),
    ("BSD-2-Clause", _BSD_1 + "\n" + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_1 + "\n" + _BSD_END),
    ("BSD-3-Clause", _BSD_1 + "\n" + _BSD_3RD + "\n" + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_1 + "\n" + _BSD_3RD + "\n" + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
)

# SHA-256 digests of the canonical forms of whole licence texts, as their stewards
# publish them, that are too long to stand here; where two stand for a name, the
# second is that of the terms alone, to "END OF TERMS AND CONDITIONS".
DIGESTS = (
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
)

#: Words that "Copyright" goes on with inside a licence's sentences, also where a
#: line is broken before it: such are lower-cased first, so that no line of terms goes.
TERMS = ("License", "Licence", "Holder", "Owner", "Notice", "Act", "Law", "Interest", "Right", "Status", "And", "Or")
#: A line that says whose the copyright is: after comment marks, the word or sign, then the sign
#: again, a year, a name in brackets or ``by``; or "Copyright" and any holder's name,
#: which does not begin with a small letter.
COPYRIGHT_LINE = (r"(?m)^[ \t*#/;!-]*((?i:copyright|\(c\)|©)[ \t]*(?i:\(c\)|©|copyright|by\b|[0-9]{4}|<|\[)"
                  r"|Copyright:?[ \t]+[^a-z \t\n])[^\n]*$")
#: Digits and letters of any script; everything else is a space.
OTHER = r"[^\p{L}\p{N}]+"
RESERVED = "all rights reserved"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Lower-cased words with single spaces between them: copyright lines and "all rights
    reserved" go, then all but letters and digits; equivalent spellings become one."""
    out = text
    for word in TERMS:
        out = F.replace(out, F.lit("Copyright " + word), F.lit("copyright " + word))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "")
    out = F.regexp_replace(F.translate(out, UPPER, LOWER), OTHER, " ")
    out = F.trim(F.replace(F.replace(out, F.lit(RESERVED), F.lit("")), F.lit("  "), F.lit(" ")))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def known_digests(spark: SparkSession, known=KNOWN, digests=DIGESTS) -> DataFrame:
    """(digest, license_id): one row per known text.  ``known``: (name, text) pairs, or a
    DataFrame (license_id, body) of any number; ``digests``: (name, digest) pairs beside."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame([(a, b) for a, b in known], "license_id string, body string")
    rows = rows.select(F.sha2(canonical(F.col("body")), 256).alias("digest"), "license_id")
    if digests:
        rows = rows.unionByName(spark.createDataFrame(list(digests), "license_id string, digest string"))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known=KNOWN, digests=DIGESTS) -> DataFrame:
    """(doc_id, n_canonical, digest, license_id) for every row of ``docs``:
    length and SHA-256 of the canonical text, and the licence whose whole text
    has it, else null.  The module's own short list is broadcast; a table that the
    caller passes as ``known`` is joined as Spark sees fit.

    A null text has a null digest and no licence; an empty one, or one with
    nothing left, matches nothing; repeated rows stay; an empty table gives an
    empty result; other columns are not looked at."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical(F.col("text").cast("string")).alias("body"))
    rows = rows.select("doc_id", F.length("body").cast("long").alias("n_canonical"), F.sha2("body", 256).alias("digest"))
    table = known_digests(docs.sparkSession, known, digests)
    return rows.join(table if isinstance(known, DataFrame) else F.broadcast(table), "digest", "left").select("doc_id", "n_canonical", "digest", "license_id")


def oracle(known=KNOWN, digests=DIGESTS) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def sql(text):
        out = text
        for word in TERMS:
            out = f"replace({out}, 'Copyright {word}', 'copyright {word}')"
        out = f"regexp_replace({out}, {quote(COPYRIGHT_LINE)}, '', 'g')"
        out = f"regexp_replace(translate({out}, '{UPPER}', '{LOWER}'), {quote(OTHER)}, ' ', 'g')"
        out = f"trim(replace(replace({out}, '{RESERVED}', ''), '  ', ' '))"
        for old, new in SPELLINGS:
            out = f"replace({out}, {quote(old)}, {quote(new)})"
        return out

    values = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in known)
    ready = "".join(f" UNION ALL SELECT '{digest}', '{name}'" for name, digest in digests)
    return f"""
    WITH k AS (SELECT digest, min(license_id) AS license_id FROM (
      SELECT sha256({sql('body')}) AS digest, license_id FROM (VALUES {values}) v(license_id, body){ready}) a GROUP BY 1),
    d AS (SELECT doc_id, {sql('text')} AS body FROM documents)
    SELECT doc_id, length(body) AS n_canonical, sha256(body) AS digest, license_id FROM d LEFT JOIN k ON sha256(d.body) = k.digest"""
