"""License scans: digests of canonical texts.

A text is brought to a canonical form (A-Z to lower case, copyright lines out, punctuation to single blanks, equivalent
spellings to one) and its SHA-256 is joined with the digests of known licence texts: a whole text is a licence or not. A licence
quoted within other text, or a line that only names one, is not a hit.

Defined cases: a null text has no digest and no licence; an empty text, or one of copyright lines only, has the digest of
the empty text, which is no licence; known texts with a null id or text are ignored, of known texts with one canonical form
the smallest id counts; repeated rows are treated row by row; columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.llm.common import quoted, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
QUOTES = "“”„‘’–—©«»•"
COPYRIGHT = r"(?m)^[ \t/*#;-]*(?:copyright[ ]*(?:\(c\)|©|[0-9<\[])|\(c\)|©|all rights reserved)[^\n]*$"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Equivalent spellings, a fixed list: pattern and replacement.
SPELLINGS = (
    (r"\b(sub)?licen[cs](e|es|ed|ing|ee|or)\b", r"\1licens\2"), (r"\backnowledgement", "acknowledgment"),
    (r"\b(organi|authori|utili|recogni|reali|normali|emphasi|initiali)s(e|es|ed|ing|ation)\b", r"\1z\2"),
    (r"\b(fav|hon|behavi|col)our", r"\1or"), (r"\bwhilst\b", "while"), (r"\bper cent\b", "percent"), (r"\bhttps\b", "http"),
)

_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

#: Short public licence texts. Fixed values; more can be given as a table.
KNOWN = {
    "MIT": "MIT License\n\n" + _PERMISSION,
    "MIT-untitled": _PERMISSION,
    "ISC": "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
    " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_DISCLAIMER,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted.\n\n" + _ISC_DISCLAIMER,
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + _BSD_THIRD + _BSD_TAIL,
}

#: Digests of canonical texts, fixed values: the short texts above, and the full texts of common licences as the Debian
#: distribution ships them (Apache-2.0 with and without its appendix).
KNOWN_DIGESTS = (
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("Apache-2.0", "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847"),
    ("Apache-2.0", "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("ISC", "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MPL-1.1", "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)


def canonical(text: Column) -> Column:
    out = F.translate(text, UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT, " ")
    out = F.regexp_replace(F.translate(out, QUOTES, " " * len(QUOTES)), SEPARATORS, " ")
    for pattern, to in SPELLINGS:
        out = F.regexp_replace(out, pattern, to.replace("\\", "$"))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """The digests of common licences: license_id, digest."""
    return spark.createDataFrame(list(KNOWN_DIGESTS), "license_id string, digest string")


def digested(texts: DataFrame, license_id: str = "license_id", text: str = "text") -> DataFrame:
    """A table of licence texts as one of digests, to be added to the known ones."""
    own = texts.where(quoted(license_id).isNotNull() & quoted(text).isNotNull())
    return own.select(quoted(license_id).cast("string").alias("license_id"), digest(quoted(text)).alias("digest"))


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """Add digest and license_id (null: not a known licence text). `known` (license_id, digest) may have any size."""
    table = (
        known.where(F.col("license_id").isNotNull() & F.col("digest").isNotNull())
        .select("license_id", F.col("digest").alias("__digest"))
        .where(F.col("__digest") != F.sha2(F.lit(""), 256)).groupBy("__digest").agg(F.min("license_id").alias("license_id"))
    )
    # all digests are computed before the join, next to the scan
    own = without(docs, ["digest", "license_id"]) if text not in ("digest", "license_id") else docs
    return own.withColumn("digest", digest(quoted(text))).join(table, F.col("digest") == F.col("__digest"), "left").drop("__digest")


def canonical_sql(text: str) -> str:
    """The same canonical form in DuckDB's SQL."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"translate({text}, {lit(UPPER)}, {lit(LOWER)})"
    out = f"regexp_replace({out}, {lit(COPYRIGHT)}, ' ', 'g')"
    out = f"regexp_replace(translate({out}, {lit(QUOTES)}, {lit(' ' * len(QUOTES))}), {lit(SEPARATORS)}, ' ', 'g')"
    for pattern, to in SPELLINGS:
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(to)}, 'g')"
    return f"trim({out})"
