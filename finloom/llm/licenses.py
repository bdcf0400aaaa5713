"""License scans: canonical digests of entire texts, hash-joined to the digests of known licences. Native expressions only.

Each document is looked up as one text, and each of its lines as a text of its own, so that a notice inside a longer document is
found. All units take the same road: lower case, copyright lines dropped, spellings unified, punctuation and white space to one
space, SHA-256, equi-join.

The known texts here are the short licences, the notices that stand at the head of files under long ones, and one-line notices;
digests_of_folder() makes the table from any collection of whole texts.

Defined results: a null or empty text, and one that is empty once canonical, matches nothing; a line ends at a line feed, and a
carriage return is white space; rows that repeat a doc_id make one row, whose line counts add up, and so do all rows without one;
texts are read whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines that only name a holder. A line ends at a line feed; {m} is how an engine says so (m, and d for Java).
COPYRIGHT_LINE = r"(?{m})^[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*$"
RIGHTS_LINE = r"(?{m})^[ \t#*/;-]*all rights reserved\.?[ \t\r]*$"
#: Spellings that licence texts use for the same thing.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("https://", "http://"),
    ("organisation", "organization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("judgement", "judgment"),
    ("per cent", "percent"),
    ("owner", "holder"),
    ("&", " and "),
]
PUNCTUATION = r"[\x09-\x0D\x20-/:-@\[-`{-~“”‘’–—•·…]+"
#: Below this many rows the licence table is broadcast (a row is a digest and an id: 100,000 of them are about 12 MB).
BROADCAST_ROWS = 100_000

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def gnu_notice(name: str, version: str, later: bool = True) -> str:
    """What a program under a licence of this family says at its head."""
    which = f"either version {version} of the License, or (at your option) any later version." if later else f"version {version} of the License."
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, {which}

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""


GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
GNU_VERSIONS = [("GPL", "2"), ("GPL", "3"), ("LGPL", "2.1"), ("LGPL", "3"), ("AGPL", "3")]
#: Names by which one-line notices call a licence.
NAMED = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "Unlicense": ["Unlicense"],
    **{f"{a}-{v if '.' in v else v + '.0'}": [f"{GNU[a]}, version {v}", f"{GNU[a]} v{v}", f"{a} v{v}", f"{a}-{v if '.' in v else v + '.0'}"] for a, v in GNU_VERSIONS},
    **{f"CC-{kind}-{v}": [f"CC {kind} {v}"] for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")},
}
OPENINGS = ["Licensed under the", "Licensed under", "Released under the", "Released under", "This work is licensed under the", "This work is licensed under"]
#: (licence, known text). Several texts may stand for one licence.
KNOWN = [
    *((name, text) for name, title, body in (("MIT", "MIT License", MIT), ("ISC", "ISC License", ISC), ("BSD-2-Clause", "BSD 2-Clause License", BSD_2 + BSD_END), ("BSD-3-Clause", "BSD 3-Clause License", BSD_2 + BSD_3 + BSD_END), ("Zlib", "zlib License", ZLIB), ("Unlicense", "The Unlicense", UNLICENSE), ("0BSD", "BSD Zero Clause License", ZERO_BSD)) for text in (body, f"{title}\n\n{body}", f"The {title}\n\n{body}")),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("Apache-2.0", APACHE_NOTICE),
    ("MPL-2.0", MPL_NOTICE),
    *((f"{a}-{v if '.' in v else v + '.0'}", gnu_notice(GNU[a], v, later)) for a, v in GNU_VERSIONS for later in (True, False)),
    *((licence, f"{opening} {name}.") for licence, names in NAMED.items() for name in names for opening in OPENINGS),
    *((licence, f"SPDX-License-Identifier: {licence}{end}") for licence in [*NAMED, "Zlib", "0BSD"] for end in (["", "-only", "-or-later"] if "GPL" in licence else [""])),
]


def canonical(text: Column) -> Column:
    out = F.lower(F.coalesce(text, F.lit("")))
    for line in (COPYRIGHT_LINE, RIGHTS_LINE):
        out = F.regexp_replace(out, line.format(m="dm"), "")
    for given, used in SPELLINGS:
        out = F.replace(out, F.lit(given), F.lit(used))
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """digest, licence: one row per canonical text; of licences with the same text the smallest name."""
    rows = spark.createDataFrame(known, "licence string, text string").select("licence", canonical(F.col("text")).alias("c"))
    return rows.where("c <> ''").groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("licence").alias("licence"))


def digests_of_folder(spark: SparkSession, path: str) -> DataFrame:
    """The same from a folder of text files, each the whole text of the licence that its name without ending names."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[a-z]+)?$", 1).alias("licence"), canonical(F.col("value")).alias("c"))
    return files.where("c <> ''").groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, digests: DataFrame, known_rows: int, text: str = "text") -> DataFrame:
    """doc_id, text_licence (of the whole text), line_licences (comma list, sorted), n_licence_lines, n_lines.

    known_rows is the row count of digests, which decides whether it may be broadcast.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.transform(F.split(t, "\n"), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("piece")))
    units = docs.select("doc_id", F.inline(F.concat(F.array(F.struct(F.lit(True).alias("whole"), t.alias("piece"))), lines)))
    units = units.select("doc_id", "whole", F.sha2(canonical(F.col("piece")), 256).alias("digest"))
    found = units.join(F.broadcast(digests) if known_rows <= BROADCAST_ROWS else digests, "digest", "left")
    line = F.when(~F.col("whole"), F.col("licence"))
    return found.groupBy("doc_id").agg(
        F.min(F.when(F.col("whole"), F.col("licence"))).alias("text_licence"),
        F.array_join(F.sort_array(F.collect_set(line)), ",").alias("line_licences"),
        F.count(line).alias("n_licence_lines"),
        F.count_if(~F.col("whole")).alias("n_lines"),
    )


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for line in (COPYRIGHT_LINE, RIGHTS_LINE):
        out = f"regexp_replace({out}, {_literal(line.format(m='m'))}, '', 'g')"
    for given, used in SPELLINGS:
        out = f"replace({out}, {_literal(given)}, {_literal(used)})"
    return f"trim(regexp_replace({out}, {_literal(PUNCTUATION)}, ' ', 'g'))"


def oracle_sql() -> str:
    known = ", ".join(f"({_literal(a)}, {_literal(b)})" for a, b in KNOWN)
    return f"""
    with known as (
        select sha256(c) as digest, min(licence) as licence
        from (select licence, {canonical_sql('t')} as c from (values {known}) as k(licence, t)) where c <> '' group by c
    ), lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as piece from documents),
    units as (
        select doc_id, true as whole, sha256({canonical_sql('text')}) as digest from documents
        union all select doc_id, false, sha256({canonical_sql('piece')}) from lines
    )
    select doc_id,
        min(licence) filter (whole) as text_licence,
        coalesce(array_to_string(list_sort(list(distinct licence) filter (not whole and licence is not null)), ','), '') as line_licences,
        count(licence) filter (not whole) as n_licence_lines,
        count(*) filter (not whole) as n_lines
    from units left join known using (digest) group by doc_id
    """
