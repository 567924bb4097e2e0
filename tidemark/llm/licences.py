"""Known licences by the digest of a canonical text.

A text is put into canonical form line by line: A-Z in lower case, lines that state a
copyright dropped, everything but letters and digits (and characters beyond ASCII other than
quotes, dashes and the copyright sign) turned into single blanks, equivalent spellings made
one. The SHA-256 of the whole canonical text is joined with the digests of the known texts, a
table that may be given; each line is looked up by the same digest, so a notice of one line
inside a longer document is found too. Only digests are joined.

Nulls: a null text is an empty one, and an empty canonical text is no licence. Every row of
the table gives one row, repeated ones too; a text is read whole, however long; an empty table
gives an empty one. Other columns stay behind, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import text as T

#: Spellings that count as one, the texts and the notices of known licences.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "behaviour": "behavior", "centre": "center", "colour": "color", "favour": "favor",
    "fulfil": "fulfill", "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses",
    "merchantibility": "merchantability", "organisation": "organization", "programme": "program",
    "recognised": "recognized", "sublicence": "sublicense", "unauthorised": "unauthorized", "whilst": "while", "wilful": "willful",
}
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{notice}.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("BSD-2-Clause", _BSD.format(third="")),
    ("BSD-3-Clause", _BSD.format(third="3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n")),
    ("ISC", _GRANT.format(notice=", provided that the above copyright notice and this permission notice appear in all copies")),
    ("0BSD", _GRANT.format(notice="")),
)
#: Names that notices give to licences.
SPOKEN = (
    ("MIT", "the MIT License"), ("ISC", "the ISC License"), ("0BSD", "the Zero-Clause BSD License"),
    ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("Apache-2.0", "the Apache License, Version 2.0"), ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("GPL-2.0", "the GNU General Public License, version 2"), ("GPL-3.0", "the GNU General Public License, version 3"),
    ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"), ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3"), ("EPL-2.0", "the Eclipse Public License, version 2.0"),
    ("CC0-1.0", "CC0 1.0"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"), ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
    ("BSL-1.0", "the Boost Software License 1.0"), ("Zlib", "the zlib License"), ("Unlicense", "the Unlicense"),
)
NOTICES = ("Released under {}.", "Licensed under {}.", "Distributed under {}.", "This work is licensed under {}.", "This file is licensed under {}.")
#: Digests of the canonical form of full texts too long to stand here, by :func:`known_digests`.
FULL_TEXTS = (
    ("Apache-2.0", "4bc3c949c895ead14c0dc8c6e33fd6ed118359acaad7c084c4d563cd526a878d"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)


def notices() -> list[tuple[str, str]]:
    """``(licence, notice)``: every name in every wording, and the identifier lines of source files."""
    worded = [(licence, form.format(name)) for licence, name in SPOKEN for form in NOTICES]
    gnu = [licence for licence, name in SPOKEN if "GNU" in name]
    ids = [(licence, licence) for licence, _ in SPOKEN] + [(g, g + end) for g in gnu for end in ("-only", "-or-later")]
    return worded + [(licence, f"SPDX-License-Identifier: {name}") for licence, name in ids]


#: Regular expressions that mean the same to Java and RE2.
COPYRIGHT_LINE = r"^[^a-z0-9]*(?:copyright (?:\(c\)|\x{00A9}|[0-9])|\(c\)|\x{00A9}|all rights reserved)"
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{00A9}\x{2010}-\x{2015}\x{2018}-\x{201F}]+"


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without those that came out empty."""
    same = F.create_map(*[F.lit(w) for pair in EQUIVALENT.items() for w in pair])
    lines = F.filter(F.split(T.lower_ascii(T.whole(text)), "\n"), lambda l: ~l.rlike(COPYRIGHT_LINE))

    def canonical(line: Column) -> Column:
        known = lambda w: F.coalesce(F.element_at(same, w), w)
        return F.array_join(F.transform(F.split(F.trim(F.regexp_replace(line, NOT_A_WORD, " ")), " "), known), " ")

    return F.array_remove(F.transform(lines, canonical), "")


def known_digests(texts: DataFrame) -> DataFrame:
    """``(digest, licence)`` of a table ``(licence, text)``, one row per digest; empty texts are none."""
    digest = F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256)
    found = texts.select("licence", digest.alias("digest")).filter(F.col("digest") != F.sha2(F.lit(""), 256))
    return found.groupBy("digest").agg(F.min("licence").alias("licence"))


def default_digests(spark: SparkSession) -> DataFrame:
    """Those of KNOWN, the notices and FULL_TEXTS."""
    given = spark.createDataFrame([*KNOWN, *notices()], "licence string, text string")
    full = spark.createDataFrame([(digest, licence) for licence, digest in FULL_TEXTS], "digest string, licence string")
    return known_digests(given).unionByName(full).groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, spark: SparkSession, doc_id: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """``(doc_id, canonical_sha256, licence, n_licence_lines, line_licences)`` per row.

    ``known`` holds ``(digest, licence)``, one row per digest, as :func:`known_digests` makes them.
    ``line_licences`` names the licences of single lines, sorted, with commas.
    """
    known = default_digests(spark) if known is None else known
    listed = sorted((r["digest"], r["licence"]) for r in known.select("digest", "licence").collect())  # as many as known texts
    table = spark.createDataFrame(listed, "_digest string, licence string")
    none = F.array().cast("array<string>")
    digests = F.array(*[F.lit(d) for d, _ in listed]) if listed else none
    name = F.create_map(*[F.lit(v) for pair in listed for v in pair]) if listed else F.create_map().cast("map<string,string>")
    canonical = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("_lines"))

    # The intersection is by hash; only what it finds is looked up one by one.
    def matched(lines: Column) -> Column:
        def of_common(common: Column) -> Column:
            n = F.when(F.size(common) == 0, 0).otherwise(F.size(F.filter(lines, lambda d: F.array_contains(common, d))))
            names = F.array_distinct(F.transform(common, lambda d: F.element_at(name, d)))
            return F.struct(n.cast("bigint").alias("n"), F.array_join(F.array_sort(names), ",").alias("names"))

        return T.let(F.array_intersect(lines, digests), of_common)

    found = canonical.select(
        "doc_id",
        F.sha2(F.array_join("_lines", " "), 256).alias("canonical_sha256"),
        T.let(F.transform("_lines", lambda l: F.sha2(l, 256)), matched).alias("_hits"),
    )
    return found.join(F.broadcast(table), F.col("canonical_sha256") == F.col("_digest"), "left").select(
        "doc_id", "canonical_sha256", "licence", F.col("_hits.n").alias("n_licence_lines"), F.col("_hits.names").alias("line_licences")
    )
