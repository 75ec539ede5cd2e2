"""License scans in DataFrame operations: canonical digests of entire texts, looked up among digests of known licences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines that name an owner, not a licence; numbers and letters that begin the items of a list; a title above a licence.
OWNER_LINE = r"^[^\n]*(?:copyright\s+(?:\(c\)|©|[0-9]{4}|by\b)|\(c\)\s+[0-9]{4}|©|all rights reserved)[^\n]*$"
LIST_MARK = r"^[^\p{L}\p{N}\n]*(?:[0-9]{1,2}|[a-z])[.)][ \t]"
TITLE = r"^(?:[^ \n]+ ){0,7}license(?: [^ \n]+){0,7}\n(?:version [^\n]{0,40}\n)?(?:https? [^\n]{0,60}\n)?"
#: Spellings that count as one, whole words each.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sublicence", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("whilst", "while"), ("copyright owner", "copyright holder"), ("favour", "favor"), ("merchantibility", "merchantability"))
#: Largest registry (rows) that is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000

#: Notices and full texts by licence.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("Zlib", 'This software is provided \'as-is\', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>'),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
)
#: Canonical digests of longer texts (known_digests of the files that Debian ships as common licences).
DIGESTS = (
    ("Apache-2.0", "9bc1b6c56a159abb84187bc1bd09de291155bd788d92524fe492390d42b77cc6"),
    ("GPL-1.0", "fc66d66f601c31e13395566deb10c57c251f4049dbeac73765bd8ebbffec6bff"),
    ("GPL-2.0", "93ed66d961c2b0921337a6078c0d65c785f989fc1868695bb8862b13d1bd2e60"),
    ("GPL-3.0", "3efdfe2d24bc6f6e3956b178ea702826e2625da9be690ee4c69f1598d76c4763"),
    ("LGPL-2.0", "673fabf12e0a0a178a38dcf8e5b3c217e7794793c74d71b2a3e9734845c15fca"),
    ("LGPL-2.1", "2004a1e3bc8d4a290087156649dd6b8864ab90a121d96d75ad8a9f13c9fb9dbe"),
    ("LGPL-3.0", "599e236ddcb69302837061770c9ad5f7b2e9908bdde58f1d38401c54304f7934"),
    ("MPL-1.1", "a38796a4b8f31f1f3dad43f679898e26c5e5794bc4ffd98b2e6cf02eebb3ea71"),
    ("MPL-2.0", "f01e89585ca9993f1590569122b28a274599068f1853884399a5acffa8bf9035"),
    ("CC0-1.0", "51c4bf27767d074bdefc84db7420b4c55e27827dac6d8de3ef0d37b2042fb6fa"),
    ("GFDL-1.2", "6ee5c7436b68b2fd9c4270529706acde2c5b5d8015e6f55757c05e19db521d2e"),
    ("GFDL-1.3", "b7fbd02be3e56ab765c5f2f51439664d932e049632b76e26d7a648c26aa911ad"),
    ("Artistic-1.0", "538e2e59281ba267abc1d1844748259521b4d2f0e90e9cca0ee2b8a86ffbe6fa"),
)


def _flags(pattern: str) -> str:
    return f"(?md){pattern}"  # lines end at \n alone


def canonical_lines(text: Column) -> Column:
    """The lines of a text that hold words, in canonical form: lower case, owners' lines and list marks gone, words joined by one blank, one spelling each."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _flags(OWNER_LINE), ""), _flags(LIST_MARK), "")
    flat = F.regexp_replace(flat, r"[^\p{L}\p{N}\n]+", " ")
    flat = F.concat(F.lit(" "), F.replace(F.replace(flat, F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n ")), F.lit(" "))  # each word between blanks of its own
    flat = reduce(lambda t, s: F.replace(t, F.lit(_apart(s[0])), F.lit(_apart(s[1]))), SPELLINGS, flat)
    return F.filter(F.transform(F.split(flat, "\n"), lambda line: F.trim(F.replace(line, F.lit("  "), F.lit(" ")))), lambda line: line != "")


def _apart(words: str) -> str:
    return f" {words.replace(' ', '  ')} "


def canonical_digest(lines: Column) -> Column:
    """Digest of an entire text from its canonical lines; a title of up to 15 words with the word license above the text does not count."""
    return F.sha2(F.translate(F.regexp_replace(F.array_join(lines, "\n"), TITLE, ""), "\n", " "), 256)


def known_digests(spark: SparkSession, known=KNOWN, digests=DIGESTS) -> DataFrame:
    """(digest, license) of a registry of (license, text) and of (license, digest); if two licences share a digest, the first by name."""
    table = spark.createDataFrame([tuple(x) for x in known], "license string, text string")
    texts = table.select("license", canonical_digest(canonical_lines(F.col("text"))).alias("digest"))
    return texts.unionByName(spark.createDataFrame([tuple(x) for x in digests], "license string, digest string")).groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, digest, license, notices, n_notices.

    digest is that of the entire canonical text without a title, license what it is known as, else null. A notice is a line that is an
    entire known text by itself: notices lists their licences, sorted and distinct, n_notices counts the lines. A null or
    empty text has the digest of "". Repeated rows give repeated results; null ids are kept. known has (digest, license).
    """
    hint = F.broadcast if known.count() <= BROADCAST_ROWS else (lambda df: df)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    lines = base.select("id", F.xxhash64("text").alias("own"), canonical_lines(F.col("text")).alias("lines"))
    whole = F.struct(F.lit(True).alias("whole"), canonical_digest(F.col("lines")).alias("digest"))
    units = lines.select("id", "own", F.explode(F.concat(F.array(whole), F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("digest"))))).alias("u")).select("id", "own", "u.*")
    found = units.join(hint(known.select("digest", "license")), "digest", "left").where("whole or license is not null")
    out = found.groupBy("id", "own").agg(
        F.count(F.when(F.col("whole"), 1)).alias("copies"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("notices"),
        F.count(F.when(~F.col("whole"), 1)).alias("n"),
    )
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(F.col("id").alias(id_col), "digest", "license", "notices", F.expr("n div copies").alias("n_notices"))


def _sql_lines(text: str) -> str:
    flat = f"regexp_replace(regexp_replace(lower(coalesce({text}, '')), '(?m){OWNER_LINE}', '', 'g'), '(?m){LIST_MARK}', '', 'g')"
    flat = f"' ' || replace(replace(regexp_replace({flat}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), ' ', '  '), chr(10), ' ' || chr(10) || ' ') || ' '"
    for a, b in SPELLINGS:
        flat = f"replace({flat}, '{_apart(a)}', '{_apart(b)}')"
    return f"list_filter(list_transform(string_split({flat}, chr(10)), lambda x: trim(replace(x, '  ', ' '))), lambda x: x <> '')"


def _sql_digest(lines: str) -> str:
    return f"sha256(translate(regexp_replace(array_to_string({lines}, chr(10)), '{TITLE}', ''), chr(10), ' '))"


_QUOTE = "'"
ORACLE = f"""
WITH texts AS (SELECT {_sql_digest(_sql_lines('t'))} AS digest, license FROM (VALUES {", ".join("('" + a + "', '" + b.replace(_QUOTE, _QUOTE * 2) + "')" for a, b in KNOWN)}) AS k(license, t)
UNION ALL VALUES {", ".join(f"('{d}', '{a}')" for a, d in DIGESTS)}),
known AS (SELECT digest, min(license) AS license FROM texts GROUP BY digest),
d AS (SELECT row_number() OVER () AS r, doc_id, {_sql_lines('text')} AS l FROM documents),
n AS (SELECT r, license FROM (SELECT r, sha256(unnest(l)) AS digest FROM d) JOIN known USING (digest)),
g AS (SELECT r, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM n GROUP BY r),
w AS (SELECT *, {_sql_digest('l')} AS digest FROM d)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices, coalesce(n_notices, 0)::BIGINT AS n_notices FROM w LEFT JOIN known USING (digest) LEFT JOIN g USING (r)
"""
