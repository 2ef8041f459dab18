"""Known licences by a canonical digest of the whole text.

A text is brought to a canonical form: line ends united, copyright lines and
SPDX identifiers dropped, A-Z lowered, punctuation and white space (a
byte-order mark, too) folded to single blanks, equivalent spellings united.  The SHA-256 digest of that form is hash-joined to the digests of
known licence texts, which go through the same expressions.  Known are
``LICENSES`` and the files of ``licenses/`` (named by their SPDX identifier),
each with and without its title lines and with and without what follows its
terms.

Defined cases: a null text counts as empty; an empty canonical form matches no
licence; two names of one canonical text give the first by name; repeated rows
each get a row; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines of a text may end in any of these ways; a byte-order mark stands before one.
LINE_ENDS = "\r\n?|\ufeff"
#: Copyright is a right, not a notice, where one of these words follows it.
NO_NOTICE = "Copyright([ \t]+(Act|Disclaimer|Holder|Interest|Law|Licen[cs]e|Notice|Office|Owner|Permission|Right|Statement|Treaty))"
#: A notice goes on with a sign, a year, "by" or a capital letter; a wrapped line of a licence may begin with "copyright" too.
COPYRIGHT_LINE = ("(^|\n)[ \t*#/;-]*([Cc]opyright[ \t:,]+(\\([Cc]\\)|©|[0-9<\\[{]|[Bb]y )|COPYRIGHT[ \t:,]+(\\([Cc]\\)|©|[0-9<\\[{]|BY )"
                  "|Copyright[ \t:,]+[A-Z]|\\([Cc]\\)|©|[Aa]ll [Rr]ights [Rr]eserved|ALL RIGHTS RESERVED|[Ss][Pp][Dd][Xx]-License-Identifier:)[^\n]*")
#: ASCII characters that are no letters or digits, and typographic marks.
MARKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F\\x{2018}\\x{2019}\\x{201C}\\x{201D}\\x{2013}\\x{2014}\\x{2022}\\x{A9}\\x{A0}]+"
# Spellings that licence texts use for one another.
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("behaviour", "behavior"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"),
    ("copyright holder", "copyright owner"), ("favour", "favor"), ("fulfil ", "fulfill "), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), 
    ("non infringement", "noninfringement"), ("organisation", "organization"), ("per cent", "percent"),
    ("practise", "practice"), ("programme", "program"), ("recognise", "recognize"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)

# Public licence texts and the notices that stand for them.
LICENSES = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT notice": "Released under the MIT License.",
}

#: Further wordings of known licences: (name, what it has, what the wording has instead).
WORDINGS = (
    ("ISC", "modify, and/or distribute", "modify, and distribute"), ("0BSD", "modify, and/or distribute", "modify, and distribute"),
    ("Unlicense", "https://unlicense.org", "http://unlicense.org/"), ("Unlicense", "https://unlicense.org", "http://unlicense.org"),
)

FILES = Path(__file__).with_name("licenses")
#: Title lines at the top of a file.
HEADS = {"Apache-2.0": 3, "Artistic-1.0-Perl": 1, "CC-BY-SA-4.0": 2, "CC0-1.0": 2, "GFDL-1.2": 2, "GFDL-1.3": 2, "GPL-1.0": 2,
         "GPL-2.0": 2, "GPL-3.0": 2, "LGPL-2.0": 2, "LGPL-2.1": 2, "LGPL-3.0": 2, "MPL-1.1": 3, "MPL-2.0": 2, "OFL-1.1": 2}
#: Where the terms end; an appendix may follow.
TAILS = ("END OF TERMS AND CONDITIONS", "ADDENDUM: How to use this License", "Creative Commons is not a party to its public")
# Titles that texts without one of their own are given (besides their name).
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD 0-Clause License"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The 2-Clause BSD License", "Simplified BSD License",
                     "FreeBSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The 3-Clause BSD License", "New BSD License",
                     "Revised BSD License", "Modified BSD License", "BSD License"),
    "BSD-3-Clause-UC": ("BSD 3-Clause License", "BSD License"),
    "ISC": ("ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "MIT License (MIT)", "(MIT License)", "Expat License", "MIT/Expat License", "License (MIT)"),
    "Unlicense": ("The Unlicense", "Unlicense", "Public Domain"),
    "Zlib": ("zlib License", "zlib/libpng License"),
}


def known_texts() -> list[tuple[str, str]]:
    """(name, text) of every form of the known licences."""
    bodies = dict(LICENSES) | {f.stem: f.read_text(encoding="utf-8") for f in sorted(FILES.glob("*.txt"))}
    out = []
    for name, body in bodies.items():
        forms = [body]
        for mark in TAILS:
            if mark in body:
                before = body[:body.rindex(mark)]
                forms += [before, before + mark] if mark.startswith("END") else [before]
        for form in forms:
            lines = form.splitlines()
            titled = [i for i, line in enumerate(lines) if line.strip()][:HEADS.get(name, 0)]
            out += [(name, form), *((name, "\n".join(lines[i + 1:])) for i in titled)]
        bodies_of = [body, *(body.replace(one, other) for known, one, other in WORDINGS if known == name and one in body)]
        out += [(name, other) for other in bodies_of[1:]]
        for title in TITLES.get(name, ()):
            for other in bodies_of:
                out += [(name, f"{title}\n\n{other}"), (name, f"The {title}\n\n{other}"), (name, f"{name}\n\n{other}")]
    return out


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), LINE_ENDS, "\n")
    out = F.regexp_replace(F.regexp_replace(out, NO_NOTICE, "copyright$1"), COPYRIGHT_LINE, "\n")
    out = F.regexp_replace(F.translate(out, UPPER, LOWER), MARKS, " ")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.trim(out)


def known_digests() -> dict[str, str]:
    """The digest of every form of the known licences with the first name, for the SQL: by the same steps, in Python."""
    marks = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: chr(int(m[1], 16)), MARKS)
    out: dict[str, str] = {}
    for name, text in known_texts():
        text = re.sub(COPYRIGHT_LINE, "\n", re.sub(NO_NOTICE, r"copyright\1", re.sub(LINE_ENDS, "\n", text)))
        text = re.sub(marks, " ", text.translate(str.maketrans(UPPER, LOWER)))
        for one, other in SPELLINGS:
            text = text.replace(one, other)
        if text := text.strip(" "):
            code = hashlib.sha256(text.encode()).hexdigest()
            out[code] = min(name, out.get(code, name))
    return out


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def license_matches(docs: DataFrame, licenses: dict[str, str] | None = None) -> DataFrame:
    """doc_id, canonical_sha256, license (null where the text is none of the known ones)."""
    names = known_texts() if licenses is None else list(licenses.items())
    known = docs.sparkSession.createDataFrame(names, "license string, body string")
    known = known.groupBy(digest(F.col("body")).alias("known_sha256")).agg(F.min("license").alias("license"))
    # A configuration list: as many rows as known licences.
    shown = docs.select("doc_id", digest(F.col("text")).alias("canonical_sha256"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return shown.join(F.broadcast(known.where(F.col("known_sha256") != empty)),
                      F.col("canonical_sha256") == F.col("known_sha256"), "left").select(
        "doc_id", "canonical_sha256", "license")
