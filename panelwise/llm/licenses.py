"""Licence scans by canonical digest lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence texts and notices, and words that count as equal spellings.
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
    'merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is '
    'furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included '
    'in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
    'IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN '
    'NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF '
    'CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
)
_ISC = (
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided '
    'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
    'DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT '
    'SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM '
    'LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN '
    'CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
)
_NO_NOTICE = (
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.'
)
_BSD = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following '
    'conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the '
    'following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the '
    'following disclaimer in the documentation and/or other materials provided with the distribution.'
)
_BSD_NAMES = (
    '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived '
    'from this software without specific prior written permission.'
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    'NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL '
    'THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES '
    '(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
    'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE '
    'OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
)
_UNLICENSE = (
    'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, '
    'sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non- '
    'commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any '
    'and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large '
    'and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of '
    'all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
    'KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
    'NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF '
    'CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. '
    'For more information, please refer to <https://unlicense.org/>'
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
    'damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including '
    'commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this '
    'software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a '
    'product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must '
    'be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or '
    'altered from any source distribution.'
)
_BOOST = (
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying '
    'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
    'and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all '
    'subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this '
    'restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative '
    'works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated '
    'by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    'NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL '
    'THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT '
    'OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to '
    'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
    'KIND, either express or implied. See the License for the specific language governing permissions and limitations under the '
    'License.'
)
_GNU_NOTICE = (
    'This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free '
    'Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed '
    'in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR '
    'A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this program. If '
    'not, see <https://www.gnu.org/licenses/>.'
)
_MPL_NOTICE = (
    'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with '
    'this file, You can obtain one at https://mozilla.org/MPL/2.0/.'
)
_ISC_DISCLAIMER = _ISC[_ISC.index("THE SOFTWARE IS") :]
#: Whole texts.
TEXTS = {
    "0BSD": f"{_NO_NOTICE} {_ISC_DISCLAIMER}", "BSD-2-Clause": f"{_BSD} {_BSD_DISCLAIMER}", "BSD-3-Clause": f"{_BSD} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "BSL-1.0": _BOOST, "ISC": _ISC, "MIT": _MIT, "Unlicense": _UNLICENSE, "Zlib": _ZLIB,
}
#: Notices that stand in a file in place of the text.
NOTICES = {
    "AGPL-3.0": [_GNU_NOTICE.format(name="GNU Affero General Public License", version=3)],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", _APACHE_NOTICE],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "GPL-2.0": [_GNU_NOTICE.format(name="GNU General Public License", version=2)],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _GNU_NOTICE.format(name="GNU General Public License", version=3)],
    "LGPL-3.0": [_GNU_NOTICE.format(name="GNU Lesser General Public License", version=3)],
    "MIT": ["Released under the MIT License."],
    "MPL-2.0": [_MPL_NOTICE],
    "all-rights-reserved": ["All rights reserved."],
}
#: Identifiers of the SPDX line, where they differ from the licence's name.
SPDX = {"AGPL-3.0": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "GPL-2.0": ["GPL-2.0-only", "GPL-2.0-or-later"], "GPL-3.0": ["GPL-3.0-only", "GPL-3.0-or-later"], "LGPL-3.0": ["LGPL-3.0-only", "LGPL-3.0-or-later"], "all-rights-reserved": []}
#: Titles that files of the whole texts open with.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"], "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"], "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"], "ISC": ["ISC License", "The ISC License"], "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Unlicense": ["The Unlicense"], "Zlib": ["zlib License", "The zlib License"],
}
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
    ("recognised", "recognized"), ("utilisation", "utilization"), ("merchantibility", "merchantability"), ("v2", "version 2"), ("v3", "version 3"), ("https", "http"),
]
#: A copyright line names a year, a sign or a holder; "copyright notice", "copyright holders" and the bare word are words of a licence.
_SIGNED = r"^[ \t]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]|©)"
_NAMED, _NOT_NAMED = r"^[ \t]*copyright[ \t]+[^ \t\r]", r"^[ \t]*copyright[ \t]+(notices?|holders?|owners?)([^a-z]|$)"
_PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f‘’“”–—…]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What may be broadcast: the digests of a caller's licence list.
MOST_KNOWN = 100_000


def known_texts() -> list[tuple[str, str]]:
    """(license, body) of all notices, SPDX lines and whole texts, these with and without their titles."""
    names = [*TEXTS, *(n for n in NOTICES if n not in TEXTS)]
    notices = [(name, body) for name in names for body in NOTICES.get(name, [])]
    spdx = [(name, f"SPDX-License-Identifier: {one}") for name in names for one in SPDX.get(name, [name])]
    return notices + spdx + [(name, body) for name, text in TEXTS.items() for body in (text, *(f"{title}\n{text}" for title in TITLES[name]))]


def canonical(line: Column) -> Column:
    """A line in lower case, punctuation as one blank, equal spellings made one; empty for a copyright line."""
    low = F.translate(line, _UPPER, _LOWER)
    # Two blanks between words while spellings are replaced, so that each word has its own.
    plain = F.concat(F.lit(" "), F.replace(F.trim(F.regexp_replace(low, _PUNCTUATION, " ")), F.lit(" "), F.lit("  ")), F.lit(" "))
    for found, put in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {found} "), F.lit(f" {put} "))
    copyright_line = low.rlike(_SIGNED) | (low.rlike(_NAMED) & ~low.rlike(_NOT_NAMED))
    return F.when(copyright_line, "").otherwise(F.trim(F.replace(plain, F.lit("  "), F.lit(" "))))


def _texts(rows: DataFrame, name: str, text: Column) -> DataFrame:
    """name, line, body: the canonical form of the entire text as line 0 and of every line from 1, empty ones left out."""
    lines = rows.select(name, F.transform(F.split(text, "\n"), canonical).alias("lines"))  # computed once, used twice
    whole = F.struct(F.lit(0).alias("line"), F.array_join(F.filter("lines", lambda x: x != ""), " ").alias("body"))
    each = F.transform("lines", lambda x, i: F.struct((i + 1).alias("line"), x.alias("body")))
    return lines.select(name, F.explode(F.concat(F.array(whole), each)).alias("t")).where("t.body <> ''").select(
        name, F.col("t.line").cast("long").alias("line"), F.col("t.body").alias("body")
    )


def license_scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line, license: every entire text (line 0) or single line (from 1) that is a known licence text.

    known has license, body. Texts are compared whole, by digests of their
    canonical forms; copyright lines do not count, and what is empty then matches
    nothing. Null texts have no lines; repeated rows match each by itself.
    """
    if known.count() > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    table = _texts(known, "license", F.col("body")).where("line = 0").select("license", F.md5("body").alias("digest")).distinct()
    rows = _texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", F.col("text"))
    return rows.select("doc_id", "line", F.md5("body").alias("digest")).join(F.broadcast(table), "digest").select("doc_id", "line", "license")


def known_licenses(spark) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license string, body string")


def scan_sql() -> str:
    """The same scan of documents in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    spelt = "CASE w " + " ".join(f"WHEN '{found}' THEN '{put}'" for found, put in SPELLINGS) + " ELSE w END"
    form = f"array_to_string(list_transform(string_split(trim(regexp_replace(low, {quote(_PUNCTUATION)}, ' ', 'g')), ' '), lambda w: {spelt}), ' ')"
    match = lambda pattern: f"regexp_matches(low, {quote(pattern)})"
    body = f"CASE WHEN {match(_SIGNED)} OR ({match(_NAMED)} AND NOT {match(_NOT_NAMED)}) THEN '' ELSE {form} END"
    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in known_texts())
    return f"""
WITH known_raw(license, raw) AS (VALUES {values}),
known_low AS (SELECT license, translate(raw, '{_UPPER}', '{_LOWER}') AS low FROM known_raw),
known AS (SELECT DISTINCT license, {body} AS body FROM known_low),
split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS line FROM split),
lowered AS (SELECT doc_id, line, translate(part, '{_UPPER}', '{_LOWER}') AS low FROM numbered),
lines AS (SELECT doc_id, line, {body} AS body FROM lowered),
texts AS (SELECT doc_id, line, body FROM lines UNION ALL
          SELECT doc_id, 0 AS line, string_agg(body, ' ' ORDER BY line) AS body FROM lines WHERE body <> '' GROUP BY doc_id)
SELECT t.doc_id, CAST(t.line AS BIGINT) AS line, k.license FROM texts t JOIN known k ON t.body = k.body WHERE t.body <> ''"""
