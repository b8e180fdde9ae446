"""Licence scan by sentences and rules; column functions only.

Texts are cut into sentences, whatever their line breaks; a normalised sentence is looked up in a map from known licence
sentences to identifiers, and names of licences after words of granting ("licensed under the ...", one or several joined by "or" and "and") or in
an SPDX line, exceptions included, are looked up in a map of names. A grant that is denied ("not licensed under") names nothing, and short names
that are words of their own (MIT, ISC) count only where the grant ends with them or calls them a licence. Everything else is a gap. Ordered rules over the sequence of identifiers name the licences: at each place
the first rule that fits wins, so a whole notice comes before its opening sentence, and what it takes is gone.

Sentences end at a full stop, a colon, an exclamation or question mark that white space or the end follows, and at lines
without letters and digits; all other line breaks are blanks, and so are comment marks. Normalising: lower case (A-Z), runs of
characters other than a-z, 0-9, ``.`` and ``+`` become one blank, names of holders, programs and authors become ``x``. A known
sentence may have words before it in its sentence, as where a title has no full stop.

Defined results: a null or empty text has no licences (empty string, 0); repeated rows give repeated rows; an empty table
gives an empty table; texts are read whole, of any length; other columns are ignored; a text may name several licences, each
listed once, by first appearance, joined by commas.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed_text

# Known sentences of public licence notices, by identifier; several forms are separated by a line.
NOTICES: dict[str, str] = {
    "MIT_PERMISSION": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "MIT_NOTICE": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software\nThe above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software",
    "MIT_AS_IS": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "MIT_NO_EVENT": "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    "APACHE_YOU_MAY": "You may not use this file except in compliance with the License",
    "APACHE_COPY": "You may obtain a copy of the License at\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "APACHE_AS_IS": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, express or implied",
    "APACHE_SEE": "See the License for the specific language governing permissions and limitations under the License",
    "BSD_USE": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD_SOURCE": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BSD_BINARY": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSD_NEITHER": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD_AS_IS": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "BSD_NO_EVENT": "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage",
    "ISC_PERMISSION": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\nPermission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "ISC_AS_IS": "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "ISC_NO_EVENT": "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software",
    "MPL_COPY": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "FSF_HOPE": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "FSF_SEE": "See the GNU General Public License for more details\nSee the GNU Lesser General Public License for more details\nSee the GNU Affero General Public License for more details",
    "FSF_COPY": "You should have received a copy of the GNU General Public License along with this program\nYou should have received a copy of the GNU Lesser General Public License along with this program\nYou should have received a copy of the GNU Affero General Public License along with this program",
    "APACHE_TEXT": "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document\n\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License\nSubject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form\nYou must give any other recipients of the Work or Derivative Works a copy of this License\nThis License does not grant permission to use the trade names, trademarks, service marks, or product names of the Licensor, except as required for reasonable and customary use in describing the origin of the Work and reproducing the content of the NOTICE file",
    "GPL2_TEXT": "The licenses for most software are designed to take away your freedom to share and change it\nBy contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users\nThis License applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this General Public License",
    "GPL3_TEXT": "The GNU General Public License is a free, copyleft license for software and other kinds of works\nThe licenses for most software and other practical works are designed to take away your freedom to share and change the works\nBy contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its users\n\"This License\" refers to version 3 of the GNU General Public License",
    "AGPL3_TEXT": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software\n\"This License\" refers to version 3 of the GNU Affero General Public License",
    "LGPL3_TEXT": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below",
    "ZLIB_PERMISSION": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "ZLIB_AS_IS": "This software is provided 'as-is', without any express or implied warranty",
    "ZLIB_NO_EVENT": "In no event will the authors be held liable for any damages arising from the use of this software",
    "BOOST_PERMISSION": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    "WTFPL_TEXT": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed",
    "EPL_TEXT": "The accompanying program is provided under the terms of this Eclipse Public License (\"Agreement\")",
    "MPL_TEXT": "\"License\" means this document\nEach Contributor hereby grants You a world-wide, royalty-free, non-exclusive license",
    "CC0_TEXT": "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")",
    "UNLICENSE": "This is free and unencumbered software released into the public domain",
    "RESERVED": "All rights reserved",
}

# Names of licences, by identifier.
NAMES: dict[str, list[str]] = {
    "Apache-2.0": ["apache license version 2.0", "apache license version 2", "apache license 2.0", "apache license v2.0", "apache license v2", "apache 2.0 license", "apache 2 license", "apache 2.0", "apache software license version 2.0"],
    "Apache": ["apache license", "apache software license"],
    "MIT": ["mit license", "mit licence", "mit", "expat license"],
    "ISC": ["isc license", "isc"],
    "BSD-2-Clause": ["bsd 2 clause license", "bsd 2 clause", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "bsd 3 clause", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"],
    "BSD": ["bsd license", "bsd style license"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mozilla public license v2.0", "mpl 2.0", "mpl v2.0"],
    "Unlicense": ["unlicense"],
    "EPL-1.0": ["eclipse public license version 1.0", "eclipse public license 1.0", "eclipse public license v1.0", "eclipse public license v 1.0", "epl 1.0"],
    "EPL-2.0": ["eclipse public license version 2.0", "eclipse public license 2.0", "eclipse public license v2.0", "eclipse public license v 2.0", "epl 2.0"],
    "BSL-1.0": ["boost software license version 1.0", "boost software license 1.0", "boost software license", "bsl 1.0"],
    "Zlib": ["zlib license", "zlib libpng license", "zlib"],
    "WTFPL": ["wtfpl", "do what the fuck you want to public license"],
    "0BSD": ["0bsd", "bsd zero clause license", "zero clause bsd license"],
    "MIT-0": ["mit no attribution license", "mit 0"],
    "Artistic-2.0": ["artistic license 2.0", "artistic 2.0"],
    "CDDL-1.0": ["common development and distribution license version 1.0", "common development and distribution license 1.0", "cddl 1.0"],
    "EUPL-1.2": ["european union public license 1.2", "european union public license version 1.2", "eupl 1.2", "eupl v1.2"],
    "CC0-1.0": ["cc0 1.0 universal", "cc0 1.0", "cc0"],
}

# Rules for the names of two families: GNU licences and their versions, Creative Commons flavours and theirs.
_GNU = {
    "GPL": (("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1", "2", "3")),
    "LGPL": (("gnu lesser general public license", "lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("2", "2.1", "3")),
    "AGPL": (("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("1", "3")),
}
_CC = {"BY": ("by", "attribution"), "NC": ("nc", "noncommercial"), "SA": ("sa", "sharealike"), "ND": ("nd", "noderivatives")}
_FLAVOURS = ("BY-NC-SA", "BY-NC-ND", "BY-NC", "BY-SA", "BY-ND", "BY")

for _family, (_titles, _versions) in _GNU.items():
    for _v in _versions:
        _full = _v if "." in _v else _v + ".0"
        NAMES[f"{_family}-{_full}"] = [f"{t} {mark}{n}" for t, mark, n in product(_titles, ("version ", "v", ""), dict.fromkeys((_v, _full)))]
    NAMES[_family] = list(_titles)
for _flavour, _v in product(_FLAVOURS, ("1.0", "2.0", "2.5", "3.0", "4.0")):
    _words = _flavour.split("-")
    NAMES[f"CC-{_flavour}-{_v}"] = [f"{head} {' '.join(_CC[w][k] for w in _words)} {_v}" for head, k in (("cc", 0), ("creative commons", 0), ("creative commons", 1))]
NAMES = {ident: [n for name in names for n in dict.fromkeys((name, name.replace("license", "licence")))] for ident, names in NAMES.items()}

# Exceptions that SPDX lines add to a licence.
EXCEPTIONS = ("Classpath-exception-2.0", "GCC-exception-2.0", "GCC-exception-3.1", "LLVM-exception", "Linux-syscall-note", "Autoconf-exception-3.0", "Bison-exception-2.2", "Font-exception-2.0", "OpenSSL-exception", "Qt-GPL-exception-1.0")
#: Names that are words of their own.
AMBIGUOUS = ("mit", "isc", "zlib")

#: Raw text, before it is cut: an SPDX line is a sentence of its own, and the point of "v. 2.0" ends none.
SEPARATOR = "\x01"
RAW = ((r"spdx-license-identifier:[ \t]*([^\n\r]*)", SEPARATOR + "spdx license identifier $1" + SEPARATOR), (r"\bv\.[^a-z0-9]*(?=[0-9])", "v"))
CUT = SEPARATOR + r"|[.:!?][\"')\]>]*(?=\s|$)|\n(?=[^a-z0-9\n]*(\n|$))"
NOT_WORD = r"[^a-z0-9.+]+"
#: What differs between copies of one sentence.
BLANKED = (
    (r"\bhttps\b", "http"),
    (r"\bneither the name of .+ nor the names of\b", "neither the name of x nor the names of"),
    (r"\bprovided by .+ as is and\b", "provided by x as is and"),
    (r"\bin no event shall .+ be liable\b", "in no event shall x be liable"),
    (r"\bthe author(s)? disclaim(s)? all\b", "the author disclaims all"),
    (r"\bthis [a-z0-9]+ is distributed in the hope\b", "this x is distributed in the hope"),
    (r"\balong with (this|the) [a-z0-9]+\b.*", "along with x"),
    (r" +\.|\.+$", ""),
)


def normal(sentence: str) -> str:
    """What the columns do to a sentence, for the keys of the maps."""
    out = re.sub(NOT_WORD, " ", sentence.lower()).strip()
    for pattern, by in BLANKED:
        out = re.sub(pattern, by, out)
    return out.strip()


def _gnu_terms() -> dict[str, str]:
    """The sentence that puts a program under a GNU licence, in its usual forms."""
    out = {}
    for family, (titles, versions) in _GNU.items():
        for title, v in product(titles[:2], versions):
            full, by = v if "." in v else v + ".0", "as published by the Free Software Foundation"
            head = "you can redistribute it and/or modify it under the terms of"
            for form in (f"{head} the {title} {by}, either version {v} of the License", f"{head} the {title} {by}, version {v}", f"{head} the {title} {by}, version {v} of the License", f"{head} version {v} of the {title} {by}"):
                out[normal(form)] = f"{family}-{full}"
                for later in ("or (at your option) any later version", "or any later version"):
                    out[normal(f"{form}, {later}")] = f"{family}-{full}-or-later"
    return out


KNOWN: dict[str, str] = {normal(form): ident for ident, forms in NOTICES.items() for form in forms.split("\n")} | _gnu_terms()
NAME_IDS: dict[str, str] = {name: ident for ident, names in NAMES.items() for name in names}
#: SPDX identifiers, normalised, and the older ones.
SPDX_IDS: dict[str, str] = {normal(ident.replace("-", " ")): ident for ident in NAMES} | {
    normal(f"{ident} {tail}"): f"{ident}{kind}" for ident in NAMES if "GPL-" in ident for tail, kind in (("only", ""), ("or later", "-or-later"))
} | {normal(f"{ident}+"): f"{ident}-or-later" for ident in NAMES if "GPL-" in ident}


def _any(words) -> str:
    return "|".join(re.escape(w).replace("\\ ", " ") for w in sorted(words, key=lambda w: (-len(w), w)))


#: Words that begin known sentences: their first three words.
OPENING = f"(?:^| )((?:{_any({' '.join(k.split()[:3]) for k in KNOWN})})(?: .*)?)$"
_VERB = r"(?:licen[cs]ed|licen[cs]es this (?:file|work|software) to you|released|distributed|available|published|provided|covered|subject)"
_CALLED = r"(?: (?:international|unported|license|licence))?"
LATER = r"(?: only| or (?:at your option )?(?:any )?later(?: version)?)?"
_PLAIN, _SHORT = (_any(n for n in NAME_IDS if (n in AMBIGUOUS) is short) for short in (False, True))
#: A short name is one if "licence", another name, a choice or the end comes next.
_NAME = rf"(?:an? |the )?(?:(?:{_PLAIN}){_CALLED}{LATER}|(?:{_SHORT})(?= licen[cs]e| or | and | at your option|$){_CALLED})"
_TERMS = r"(?:(?:the )?terms (?:and conditions )?of )?(?:either (?:of )?|both )?"
_LIST = rf"{_NAME}(?: (?:or|and) (?:under )?{_TERMS}{_NAME})*(?= |$)"
#: The names of a grant; what is provided by someone, or subject to something, must be called a licence.
GRANT = rf"{_VERB} (?:under {_TERMS}({_LIST})|(?:by|to) {_TERMS}((?:an? |the )?(?:{_any(n for n in NAME_IDS if n not in AMBIGUOUS)}){_CALLED}{LATER}(?: (?:or|and) {_NAME})*|(?:an? |the )?(?:{_SHORT}) licen[cs]e)(?= |$))"
#: A grant that is denied.
DENIED = rf"(?:^| )(?:not|never|no longer|cannot|nor)(?: [a-z]+)? {_VERB} "
GRANTED = rf"({_any(NAME_IDS)})(?: (?:international|unported|license|licence))?({LATER})(?= |$)"
_MONTH = "(?:january|february|march|april|may|june|july|august|september|october|november|december)"
#: A sentence that is nothing but a licence's name, with its date and address.
TITLE = rf"^(?:the )?({_any(n for n in NAME_IDS if 'licen' in n)})(?: mit)?(?: [0-9]{{0,2}} ?{_MONTH} [0-9]{{4}})?(?: http [^ ]*(?: .*)?)?$"
SPDX = rf"(?<= )(?:{_any(SPDX_IDS)})(?: with (?:{_any(normal(x.replace('-', ' ')) for x in EXCEPTIONS)}))?(?= |$)"
#: Every known sentence, grant, title and SPDX line holds one of these words (the tests check them all).
HINT = r"(?i)licen[cs]e|permi|redistribut|warrant|reserved|liable|released|distributed|available|published|provided|covered|subject|mpl|jurisdiction"
GAP = "-"

# Ordered rules, licence and the sequence of sentences that names it; between two sentences gaps may stand.
RULES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Apache-2.0( -)* APACHE_YOU_MAY(( -)* APACHE_(COPY|AS_IS|SEE))*"),
    ("MIT", "MIT_PERMISSION(( -)* MIT_(NOTICE|AS_IS|NO_EVENT))*"),
    ("BSD-3-Clause", "BSD_USE( -)* BSD_SOURCE( -)* BSD_BINARY( -)* BSD_NEITHER(( -)* BSD_(AS_IS|NO_EVENT))*"),
    ("BSD-2-Clause", "BSD_USE( -)* BSD_SOURCE( -)* BSD_BINARY(( -)* BSD_(AS_IS|NO_EVENT))+"),
    ("BSD", "BSD_USE"),
    ("ISC", "ISC_PERMISSION(( -)* ISC_(AS_IS|NO_EVENT))*"),
    ("MPL-2.0", "MPL-2\\.0(( -)* MPL_COPY)?"),
    ("Apache-2.0", "APACHE_TEXT(( -)* APACHE_TEXT)*"),
    ("AGPL-3.0", "AGPL3_TEXT(( -)* A?GPL3_TEXT)*"),
    ("LGPL-3.0", "LGPL3_TEXT"),
    ("GPL-3.0", "GPL3_TEXT(( -)* GPL3_TEXT)*"),
    ("GPL-2.0", "GPL2_TEXT(( -)* GPL2_TEXT)*"),
    ("Zlib", "(ZLIB_AS_IS( -)* )?(ZLIB_NO_EVENT( -)* )?ZLIB_PERMISSION"),
    ("BSL-1.0", "BOOST_PERMISSION(( -)* MIT_AS_IS)?"),
    ("WTFPL", "WTFPL_TEXT"),
    ("EPL", "EPL_TEXT"),
    ("MPL-2.0", "MPL_TEXT( -)* MPL_TEXT"),
    ("CC0-1.0", "CC0_TEXT"),
    ("Unlicense", "UNLICENSE"),
    ("All-rights-reserved", "RESERVED"),
)
#: After these: a GNU licence with what its notices say, and any other name, each the licence of its own identifier.
NAMED = rf"A?L?GPL(?:-[0-9.]+)?(?:-or-later)?(?:-WITH-(?:{_any(EXCEPTIONS)}))?(( -)* FSF_(HOPE|SEE|COPY))*|(?:" + _any(i for i in NAMES if "GPL" not in i) + rf")(?:-WITH-(?:{_any(EXCEPTIONS)}))?"


def _map(entries: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))


def sentences(text: Column) -> Column:
    """Normalised sentences, in order, without empty ones."""
    out = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for pattern, by in RAW:
        out = F.regexp_replace(out, pattern, by)

    def one(s: Column) -> Column:
        s = F.trim(F.regexp_replace(s, NOT_WORD, " "))
        for pattern, by in BLANKED:
            s = F.regexp_replace(s, pattern, by)
        return F.trim(s)

    return F.filter(F.transform(F.split(out, CUT), one), lambda s: s.rlike("[a-z]"))


def identifiers(sentence: Column) -> Column:
    """Identifiers of a normalised sentence, joined by blanks; a dash if it has none."""
    keys, names = _map(KNOWN), _map(NAME_IDS)
    opened = F.regexp_extract(sentence, OPENING, 1)
    known = F.when(opened.isin(*KNOWN), F.element_at(keys, opened))
    granted = F.concat(F.regexp_extract(sentence, GRANT, 1), F.regexp_extract(sentence, GRANT, 2))
    later = lambda x: F.when(F.contains(F.regexp_extract(x, GRANTED, 2), F.lit("later")), "-or-later").otherwise("")
    each = F.transform(F.regexp_extract_all(granted, F.lit(GRANTED), F.lit(0)), lambda x: F.concat(F.element_at(names, F.regexp_extract(x, GRANTED, 1)), later(x)))
    named = F.when((granted != "") & ~sentence.rlike(DENIED), F.array_join(each, " "))
    title = F.when(sentence.rlike(TITLE), F.element_at(names, F.regexp_extract(sentence, TITLE, 1)))
    added = _map({normal(x.replace("-", " ")): x for x in EXCEPTIONS})
    licence = lambda x: F.element_at(_map(SPDX_IDS), F.element_at(F.split(x, " with "), 1))
    exception = lambda x: F.when(F.contains(x, F.lit(" with ")), F.concat(F.lit("-WITH-"), F.element_at(added, F.element_at(F.split(x, " with "), -1)))).otherwise("")
    spdx = F.array_join(F.transform(F.regexp_extract_all(sentence, F.lit(SPDX), F.lit(0)), lambda x: F.concat(licence(x), exception(x))), " ")
    found = F.when(sentence.startswith("spdx license identifier "), spdx).otherwise(F.concat_ws(" ", named, known, title))
    return F.when(found == "", GAP).otherwise(found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_license_sentences, sentence_ids (known ones), licenses, n_licenses. One row for each input row, no shuffle."""
    sequence = F.array_join(F.transform(sentences(F.col("text")), identifiers), " ")
    rows = keyed_text(docs, id_col, text_col).select("doc_id", F.when(F.col("text").rlike(HINT), sequence).otherwise(F.lit("")).alias("sequence"))
    rules = "|".join(rule for _, rule in RULES)
    stretches = F.regexp_extract_all(F.concat(F.lit(" "), F.col("sequence"), F.lit(" ")), F.lit(f"(?<= )(?:{rules}|{NAMED})(?= )"), F.lit(0))

    def licence(stretch: Column) -> Column:
        out = F.element_at(F.split(stretch, " "), 1)
        for name, rule in reversed(RULES):
            out = F.when(stretch.rlike(f"^(?:{rule})$"), F.lit(name)).otherwise(out)
        return out

    found = F.array_distinct(F.transform(stretches, licence))
    known = F.filter(F.split("sequence", " "), lambda x: (x != GAP) & (x != ""))
    return rows.select(
        "doc_id", F.size(known).cast("long").alias("n_license_sentences"), F.array_join(known, " ").alias("sentence_ids"), F.array_join(found, ",").alias("licenses"), F.size(found).cast("long").alias("n_licenses")
    )
