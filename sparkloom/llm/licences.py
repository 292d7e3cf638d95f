"""Licence scans: the canonical digest of an entire text, looked up among digests of known licences.

Native: DataFrame functions only. A text is brought to one canonical form (case, punctuation,
copyright lines, list marks and equivalent spellings), hashed, and hash-joined with the known digests.

Defined results: null, blank and punctuation-only texts have a null digest and match nothing; a very
long text is hashed whole; repeated rows each get their result; known texts that share a canonical
form yield the first name by code point; an empty table gives an empty result. Input columns named
like a result are replaced, all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULTS = ("licence_digest", "licence", "is_licence")

# Pairs of spellings that count as the same word.
SPELLINGS = (
    ("acknowledgment", "acknowledgement"), ("analog", "analogue"), ("analyze", "analyse"), ("artifact", "artefact"),
    ("authorization", "authorisation"), ("authorized", "authorised"), ("caliber", "calibre"), ("canceled", "cancelled"),
    ("capitalizations", "capitalisations"), ("catalog", "catalogue"), ("categorize", "categorise"), ("center", "centre"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("emphasized", "emphasised"),
    ("favor", "favour"), ("favorite", "favourite"), ("fulfill", "fulfil"), ("fulfillment", "fulfilment"),
    ("initialize", "initialise"), ("judgment", "judgement"), ("labeling", "labelling"), ("labor", "labour"),
    ("license", "licence"), ("licensed", "licenced"), ("licenses", "licences"), ("maximize", "maximise"),
    ("modeled", "modelled"), ("modeling", "modelling"), ("noncommercial", "non commercial"), ("offense", "offence"),
    ("optimize", "optimise"), ("organization", "organisation"), ("organize", "organise"), ("percent", "per cent"),
    ("practice", "practise"), ("program", "programme"), ("realize", "realise"), ("recognize", "recognise"),
    ("signaling", "signalling"), ("sub licence", "sublicence"), ("sublicense", "sublicence"), ("utilization", "utilisation"),
    ("while", "whilst"), ("willful", "wilful"),
)

# Short public licence texts and notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense-summary": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-short": "Apache License, Version 2.0",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

#: Digests of canonical whole licences, of /usr/share/common-licenses (with `https` and with `http`; if there are
#: closing notes also without them), and of BSD-3-Clause, Zlib (with and without a title line) and the Unlicense.
DIGESTS = {
    "Apache-2.0": ("5dcf409b493bcc863aac914e50181c83", "8a203a7c960bf7f4c056bd4bfb799c1b", "ff47171097e653c3768d59bdff31b564",),
    "Artistic-1.0-Perl": ("dcc7042040059f5983a875b6dc9cb088",),
    "BSD-3-Clause": ("669fb5c886d64c4af4448ac0f6641673", "caa02835bfe95008b3e71072e3cf5f4c", "cd0c2ba0064534d9261d91dbb5560d23", "d2db5a244befebd6cce98fc11a4c84e0", "e82046f0b7f72505ecac75064a0d3ab0",),
    "CC0-1.0": ("644c89e0c06fbef0b7a84b6e81a6698a",),
    "GFDL-1.2": ("a26c73d9ec3718e1b5e590a6214931da", "ed3dc704383d98613acc209c602b0f02",),
    "GFDL-1.3": ("32fbbcb7d7afe86d702b715f077959ef", "fc8bb9fbfeff35e93b415fa58b0357ba",),
    "GPL-1.0": ("f1ff299dcb8458c407e412e3b96e0cbe", "f289263ece8794506f3901b463205673", "f302fdd477034cacf038654c0db5385f",),
    "GPL-2.0": ("48e4f84e5126d8cc86b64d70e79fa08e", "6c6fcffe0f1c89e2c6d68c04cfb2225a", "c5d367fdaede388a029d53d70349c769",),
    "GPL-3.0": ("175c5a7dceabdda60d205ee355bd2860", "4a0c0b620814d3441a0d4d72f2f52085", "bfa0a8279c0d0280d5c63ef4703e086f", "d330399b2b3aa15eadf197b68044150d",),
    "LGPL-2.0": ("2e8af3dc8c5ffcfc44282533c0db156d", "40732185c7a47e7e3b647b9d84e5e8d8", "7293540b1622cee750549d3e2d9954ef",),
    "LGPL-2.1": ("149d60c1b5b0276abe2c94c2fccd2cca", "8ede87b1658c2e5dfa503b4027c4adb4", "f6f8c59dbb26a57bed7e651738207260",),
    "LGPL-3.0": ("eba4e086d13ca02981f01216f555a2c6",),
    "MPL-1.1": ("20a085ad20113fa8f352bff6e7b96ee3", "c020859dce4df4c936757b8280bcfa12",),
    "MPL-2.0": ("daf6f0873ac6fd33455be8fa94f26d82",),
    "Unlicense": ("915ca6c16aab88074acfabcff3aac396", "f6f7dd9a1c29d5d47b7232b87c041c31",),
    "Zlib": ("b6599da2e717b4d2ebdac5f938dfc154", "ebebcfe94666e093c3bc075909b61563", "ffdd36583ee9f9f6dae0314394b142d1",),
}

#: A line that states a copyright, or only reserves rights, and the title line of a licence. `(c)` alone may be a clause.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright( \(c\)| ©|,?:? [0-9]|:)|\(c\) ?(copyright|©|[0-9]{4})|©|portions copyright)[^\n]*$|^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"
TITLE_LINE = r"^[^a-z0-9]*(the )?(mit|isc|simplified bsd|bsd 2-clause|bsd-2-clause) licen[sc]e( \(mit\)| \(isc\))?[^a-z0-9\n]*\n"
LIST_MARK = r"(?m)^[ \t]*(\(?[0-9a-h][.)]|[*•-])[ \t]+"


def canonical(text: Column) -> Column:
    """The canonical form: lower case, no copyright or title line or list mark, one spelling, words joined by one space."""
    t = F.regexp_replace(F.lower(text), r"\r\n?", "\n")
    t = F.regexp_replace(t, COPYRIGHT_LINE, "")
    t = F.regexp_replace(t, TITLE_LINE, "")
    t = F.regexp_replace(t, LIST_MARK, "")
    t = F.concat(F.lit(" "), F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    t = F.trim(t)
    return F.when(t != "", t)


def known_licences(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(licence, licence_digest), one row per canonical form; the built-in texts and digests, or the texts given."""
    rows = spark.createDataFrame(sorted((texts or KNOWN).items()), "licence string, text string")
    rows = rows.select("licence", F.md5(canonical(F.col("text"))).alias("licence_digest"))
    if not texts:
        rows = rows.unionByName(spark.createDataFrame([(name, d) for name, digests in DIGESTS.items() for d in digests], "licence string, licence_digest string"))
    return rows.groupBy("licence_digest").agg(F.min("licence").alias("licence")).filter("licence_digest IS NOT NULL")


def licence_scan(docs: DataFrame, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """docs with licence_digest, licence and is_licence.

    The built-in table has a fixed handful of rows and is broadcast. A table of the caller's own gets
    no hint: Spark broadcasts it only under its size threshold and shuffles beyond; each digest has
    one row there, so a hot digest on the documents' side is left to AQE's skew join.
    """
    known_rows = F.broadcast(known_licences(docs.sparkSession)) if known is None else known.groupBy("licence_digest").agg(F.min("licence").alias("licence"))
    out = docs.drop(*[c for c in docs.columns if c in RESULTS and c != text]).withColumn("licence_digest", F.md5(canonical(F.col(text))))
    return out.join(known_rows, "licence_digest", "left").withColumn("is_licence", F.col("licence").isNotNull())
