"""Licence scan: a whole text is a known licence if its canonical form has a known digest.

The canonical form is lower case; copyright notices go; everything but letters and digits becomes one
space; and spellings that licence matching treats as equal become one.  Texts of licences with notices of their own are
known with them too, so that it does not matter how a text is wrapped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.llm.common import require

# Spellings that the public guidelines for matching licences treat as equal.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "wilfull",
}
# Equal forms of more than one word, or of a word that punctuation cuts.
PHRASES = {"copyright owner": "copyright holder", "sub license": "sublicense", "sub licence": "sublicense", "non infringement": "noninfringement", "per cent": "percent", "https": "http"}

# A line that begins as a notice does: with a sign, or with the word and neither a placeholder, nor the end of a body line, nor what bodies go on with;
# or the line that follows notices.  Texts are in lower case here.
NOTICE = (
    r"(?m)^[ \t#*/;%-]*(?:©|\(c\)(?=[ \t]*(?:copyright\b|(?:19|20)\d\d))|copyright\b(?![ \t]*(?:$|[,.;)\"'\[<{]|"
    r"(?:holders?|owners?|notices?|laws?|licen[cs]es?|statements?|interests?|and[ \t]+(?:this|permission|related)|or|in|of|is|to)\b))|all rights reserved\.?[ \t\r]*$)[^\n]*$"
)
OTHER = r"[^\p{L}\p{N}]+"

# Texts and notices of public licences.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_TAIL = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
LICENSES = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("ISC", _ISC_GRANT + _ISC_KEEP + _ISC_TAIL), ("ISC", "ISC License\n\n" + _ISC_GRANT + _ISC_KEEP + _ISC_TAIL),
    ("0BSD", _ISC_GRANT + "." + _ISC_TAIL), ("0BSD", "BSD Zero Clause License\n\n" + _ISC_GRANT + "." + _ISC_TAIL),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
]


# Digests of the canonical forms of public licences, as Debian ships their texts: with notices, and without them and
# their placeholders where that differs.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "ef36af97727268b60fb709836c24580bed9887f649dba6f0fd9ef4b18232fd25"),
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "ede163f2edeebd1d089aa16b5c070d0cb609da9e4b54694c28813a0d4b3cbb7a"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "292b028a70f5d02d8af35de86bccfece18261230f118b98e599872b0762a48a4"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "9c5ce247c584edabcc67759e6b66e362b9edb8815ce8209f9106e3a0c9a05581"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "d408d9dad6e4560274412e743ec3ba01007197655029f60544c308bc54f80499"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "0bfb659bf7eeb9921df1446a6a93beba70e0dc947eec10a42d26bb310dccd498"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "0472008b2e64866eb1db6471e76fc0cc3cf742180a15ea30a01655e5d9952441"),
    ("GPL-3.0", "5fc5b48e8eeed6e5e77c32ad8641a6bc04d25011d6b500aa7dc7f3183ab812ea"),
    ("LGPL-2.0", "9ccbf81e2fd78db81966e466a22ed39318d0a4b4550cd69d1144dcf09722ff10"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "a9cc8dda4023821e198a2e1bee36afc3e68fce90828780c7bac37ffe33565e15"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "ab1202917a49a52eb4671fc091c00933076c119053fff6e8b5849ca93d6b53b3"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]
#: Known digests that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def _canonical(lowered: Column) -> Column:
    bare = F.trim(F.regexp_replace(lowered, OTHER, " "))
    any_spelling = r"\b(?:" + "|".join([*SPELLINGS, *PHRASES]) + r")\b"

    def equal(t: Column) -> Column:
        padded = F.concat(F.lit(" "), F.replace(t, F.lit(" "), F.lit("  ")), F.lit(" "))  # neighbours don't share a space
        for a, b in [*PHRASES.items(), *SPELLINGS.items()]:
            wide = lambda s: " " + s.replace(" ", "  ") + " "
            padded = F.replace(padded, F.lit(wide(a)), F.lit(wide(b)))
        return F.trim(F.replace(padded, F.lit("  "), F.lit(" ")))

    # let-bound; few texts have any of the spellings
    return F.element_at(F.transform(F.array(bare), lambda t: F.when(t.rlike(any_spelling), equal(t)).otherwise(t)), 1)


def _lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def canonical(text: Column) -> Column:
    """The canonical form without notices; null gives an empty string."""
    return _canonical(F.regexp_replace(_lowered(text), NOTICE, ""))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def digest_with_notices(text: Column) -> Column:
    """The digest of a text that has notices, with them; null for others."""
    return F.when(_lowered(text).rlike(NOTICE), F.sha2(_canonical(_lowered(text)), 256))


def known_digests(spark, licenses: list[tuple[str, str]] = LICENSES, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """``digest, license_id``, one row per digest (the id that sorts first)."""
    rows = spark.createDataFrame(licenses, "license_id string, text string")
    made = rows.select("license_id", F.explode(F.array_compact(F.array(digest(F.col("text")), digest_with_notices(F.col("text"))))).alias("digest"))
    if digests:
        made = made.unionByName(spark.createDataFrame(digests, "license_id string, digest string"))
    return made.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, ``digest`` and ``license_id``, null for a text that is no known licence.

    A text is looked up without its notices, whose holders differ, and with them, as some licences have notices of their own.  A
    notice ends with its line.  ``known(digest, license_id)`` has one row per digest and is broadcast if it is small.
    Null and empty texts, and those of punctuation only, share the digest of the empty string, which
    is no licence; repeated rows all stay; other columns are ignored; an empty table gives no rows.
    """
    require(docs, "doc_id", "text")
    own = docs.select("doc_id", digest(F.col("text")).alias("digest"), digest_with_notices(F.col("text")).alias("whole"))
    small = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def found(column: str, name: str) -> tuple[DataFrame, str]:
        rows = known.select(F.col("digest").alias(column), F.col("license_id").alias(name))
        return (F.broadcast(rows) if small else rows), column

    met = own.join(*found("digest", "bare_id"), "left").join(*found("whole", "whole_id"), "left")
    return met.select("doc_id", "digest", F.coalesce("bare_id", "whole_id").alias("license_id"))
