"""Licence scan by digests of canonical texts.

A text is brought to a canonical form (lines of copyright notices left out,
lower case, every run of other characters than letters and digits one space,
equivalent spellings made one) and its SHA-256 is joined with the digests of
known licences. Only entire texts match. Everything is built-in SQL functions;
the scan is one pass and an equality join on the digest.

Defined cases: a null text has a null digest and no licence; an empty text has
the digest of the empty string; rows are kept as often as they come; of two
known licences with one canonical text the smaller name is reported. Other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Steps of the canonical form, as (pattern, replacement). $1 and $2 are groups.
STEPS = [
    (r"(?i)\A[^\p{L}\p{N}]*([^\n.;]{0,60}(licen[cs]e|no attribution)[^\n.;:]{0,40}|[^\n.;]{0,60}licen[cs]e - version [^\n]{0,40})\n", ""),
    (r"(?i)\A\s*((copyright|\(c\)|©|all rights reserved)[^\n]*(\n|\z)\s*){1,30}", ""),
    (r"(?im)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©)([^\p{L}\p{N}\n]+(\(c\)|©|\d|copyright|<year>)[^\n]*|[^\p{L}\p{N}\n]*)$", ""),
    (r"(?im)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$", ""),
    (r"[^\p{L}\p{N}]+", " "),
    (r"licenc(e|ing)", "licens$1"),
    (r"(authori|organi|recogni|utili|initiali|capitali|summari|minimi|finali)s(e|ing|ation)", "$1z$2"),
    (r"(col|fav|hon|behavi|lab)our", "$1or"),
    (r"(sub|non) (licens|commercial|infring|exclusive)", "$1$2"),
    (r"copyright holder", "copyright owner"),
    (r"(judg|acknowledg)ement", "$1ment"),
    (r"whilst", "while"),
    (r"wilful", "willful"),
    (r"per cent", "percent"),
    (r"neither the names? of .{1,100}? nor the names of (its|the) contributors", "neither the name of the copyright owner nor the names of its contributors"),
]
AS_WRITTEN = 4  # how many steps look at the text before it is lower-cased

# The texts of well-known short licences.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
KNOWN = {
    "Unlicense": _UNLICENSE,
    "Zlib": f"zlib License\n\nCopyright (c) <year> <holder>\n\n{_ZLIB}",
    "BSL-1.0": f"Boost Software License - Version 1.0 - August 17th, 2003\n\n{_BOOST}",
    "MIT": f"MIT License\n\nCopyright (c) <year> <holder>\n\n{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_MIT_WARRANTY}",
    "MIT-0": f"MIT No Attribution\n\nCopyright <year> <holder>\n\n{_MIT_GRANT}.\n\n{_MIT_WARRANTY}",
    "ISC": f"ISC License\n\nCopyright <year> <holder>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}",
    "0BSD": f"BSD Zero Clause License\n\nCopyright (c) <year> <holder>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_WARRANTY}",
    "BSD-2-Clause": f"BSD 2-Clause License\n\nCopyright (c) <year>, <holder>\n\n{_BSD_TERMS}\n\n{_BSD_WARRANTY}",
    "BSD-3-Clause": f"BSD 3-Clause License\n\nCopyright (c) <year>, <holder>\n\n{_BSD_TERMS}\n{_BSD_THIRD}\n\n{_BSD_WARRANTY}",
}


def canonical(text: Column) -> Column:
    """The canonical form of a licence text."""
    out = text
    for k, step in enumerate(STEPS):
        out = F.regexp_replace(F.lower(out) if k == AS_WRITTEN else out, *step)
    return F.trim(out)


def canonical_sql(text: str) -> str:
    """The same form as DuckDB SQL."""
    quoted = [(p.replace("'", "''"), r.replace("$", "\\")) for p, r in STEPS]
    wrap = lambda inner, step: f"regexp_replace({inner}, '{step[0]}', '{step[1]}', 'g')"
    out = text
    for k, step in enumerate(quoted):
        out = wrap(f"lower({out})" if k == AS_WRITTEN else out, step)
    return f"trim({out}, ' ')"


def known_digests(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """Digest and name of each known licence; ``texts`` defaults to the built-in ones."""
    rows = list((KNOWN if texts is None else texts).items())
    frame = spark.createDataFrame(rows, "licence string, text string")
    return frame.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per document: doc_id, digest of its canonical text, and the licence it is (null: none known)."""
    digests = docs.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest"))
    return digests.join(known, "digest", "left").select("doc_id", "digest", "licence")
