import re
import textwrap

import pytest

from deltafolio.llm import licenses

AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
BSD = [
    "Copyright (c) 2019, Jane Doe. All rights reserved.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD_END = [
    'THIS SOFTWARE IS PROVIDED BY JANE DOE AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL JANE DOE BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
]


def gnu(title, version, sep=":", later=", or (at your option) any later version", thing="program", comma=","):
    return [
        f"This {thing} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {title} as published by the Free Software Foundation{comma} either version {version} of the License{later}.",
        f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {title} for more details.",
        f"You should have received a copy of the GNU {title} along with this {thing}. If not, see <https://www.gnu.org/licenses/>.",
    ]


NOTICES = {
    "MIT": [
        "Copyright (c) 2020 Jane Doe",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        AS_IS + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Copyright 2020 Jane Doe",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "    http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "All-rights-reserved,BSD-2-Clause": BSD + BSD_END,
    "All-rights-reserved,BSD-3-Clause": BSD + ["3. Neither the name of Jane Doe nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."] + BSD_END,
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "GPL-3.0-or-later": gnu("General Public License", 3),
    "GPL-2.0-or-later": gnu("General Public License", 2, sep=";", comma=";"),
    "GPL-3.0": gnu("General Public License", 3, later=""),
    "LGPL-2.1-or-later": gnu("Lesser General Public License", "2.1", sep=";", thing="library", comma=";"),
    "AGPL-3.0-or-later": gnu("Affero General Public License", 3),
}
SHORT = {
    "Prose here. Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "x y\nLicensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU General\n# Public License, version 3 or later.": "GPL-3.0-or-later",
    "Released under the MIT License.\nReleased under the MIT License.": "MIT",
    "A title without a stop\nReleased under CC BY-SA 4.0": "CC-BY-SA-4.0",
    "Released under CC BY 4.0.": "CC-BY-4.0",
    "Distributed under the terms of the Creative Commons Attribution-NonCommercial 4.0 International license.": "CC-BY-NC-4.0",
    "SPDX-License-Identifier: MIT": "MIT",
    "/* SPDX-License-Identifier: (GPL-2.0-or-later OR Apache-2.0) */\nint main;": "GPL-2.0-or-later,Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0+\n# SPDX-License-Identifier: BSD-3-Clause": "GPL-2.0-or-later,BSD-3-Clause",
    "The MIT License (MIT)\n\nThe rest": "MIT",
    "The licence of poets is permitted.": "",
    "We speak of the MIT License in passing. All rights reserved.": "All-rights-reserved",
    "licensed under the apache licence": "Apache",
    "This is not licensed under the MIT license.": "",
    "It was never released under the GPL 3.0.": "",
    "A talk subject to MIT students' wishes.": "",
    "The data were provided by MIT in 1999.": "",
    "Provided under MIT.": "MIT",
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": "Apache-2.0,MIT",
    "Dual licensed under the MIT and GPL v2 licenses.": "MIT,GPL-2.0",
    "Licensed under the Mozilla Public License 2.0 or the GNU GPL version 2 or later.": "MPL-2.0,GPL-2.0-or-later",
    "SPDX-License-Identifier: EPL-2.0": "EPL-2.0",
    "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": "GPL-2.0-WITH-Classpath-exception-2.0",
    "SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception": "Apache-2.0-WITH-LLVM-exception",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0": "EPL-2.0",
    "GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991\n\n Copyright (C) 1989\n\n  Preamble\n\n  The licenses for most software are designed to take away your\nfreedom to share and change it.  By contrast, the GNU General Public\nLicense is intended to guarantee your freedom to share and change free\nsoftware--to make sure the software is free for all its users.": "GPL-2.0",
    "Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\nTERMS": "Apache-2.0",
    "2. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.": "Apache-2.0",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:": "Zlib",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:": "BSL-1.0",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
}


def plain(text):
    """Sentence by sentence and rule by rule, with another matcher."""
    text = text or ""
    if not re.search(licenses.HINT, text):
        return "", ""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    for pattern, by in licenses.RAW:
        lower = re.sub(pattern, by.replace("$1", r"\1"), lower)
    ids = []
    for s in re.split(licenses.CUT, lower, flags=re.ASCII):
        s = licenses.normal(s or "")
        if not re.search("[a-z]", s):
            continue
        own = []
        if s.startswith("spdx license identifier "):
            for m in re.finditer(licenses.SPDX, s):
                name, _, more = m[0].partition(" with ")
                own.append(licenses.SPDX_IDS[name] + (f"-WITH-{next(x for x in licenses.EXCEPTIONS if licenses.normal(x.replace('-', ' ')) == more)}" if more else ""))
        else:
            m = re.search(licenses.GRANT, s)
            if m and not re.search(licenses.DENIED, s):
                own += [licenses.NAME_IDS[x[1]] + ("-or-later" if "later" in x[2] else "") for x in re.finditer(licenses.GRANTED, (m[1] or "") + (m[2] or ""))]
            if m := re.search(licenses.OPENING, s):
                own += [licenses.KNOWN[m[1]]] if m[1] in licenses.KNOWN else []
            if m := re.search(licenses.TITLE, s):
                own.append(licenses.NAME_IDS[m[1]])
        ids += own or ["-"]
    found, rest = [], " " + " ".join(ids) + " "
    while rest.strip():
        rest = " " + rest.lstrip()
        for name, rule in [*licenses.RULES, (None, licenses.NAMED)]:
            if m := re.match(f" ((?:{rule})) ", rest):
                found.append(name or m[1].split(" ")[0])
                rest = rest[m.end() - 1 :]
                break
        else:
            rest = rest[rest.index(" ", 1) :]
    return " ".join(x for x in ids if x != "-"), ",".join(dict.fromkeys(found))


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_whole_notices_at_any_width(spark, mark):
    rows, wanted = [], {}
    for name, paragraphs in NOTICES.items():
        for width in (60, 80, 1_000_000):
            lines = [line for p in paragraphs for line in [*textwrap.wrap(p, width, initial_indent=" " * (len(p) - len(p.lstrip()))), ""]]
            wanted[len(rows)] = name
            rows.append((len(rows), "\n".join((mark + line).rstrip() for line in lines)))
            wanted[len(rows)] = name
            rows.append((len(rows), "Some title\r\n\r\n" + "\r\n".join(mark + line for line in lines) + "\r\nAnd more."))
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, text in rows:
        assert found[k]["licenses"] == wanted[k], (text, found[k])
        assert (found[k]["sentence_ids"], found[k]["licenses"]) == plain(text)


def test_short_notices(spark):
    rows = list(enumerate(SHORT))
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, text in rows:
        assert found[k]["licenses"] == SHORT[text], (text, found[k])
        assert (found[k]["sentence_ids"], found[k]["licenses"]) == plain(text)
        assert found[k]["n_licenses"] == len([x for x in SHORT[text].split(",") if x])


def test_every_known_sentence_name_and_identifier_is_found(spark):
    forms = [(k, ident) for k, ident in licenses.KNOWN.items()] + [(f"licensed under the {n}", ident) for n, ident in licenses.NAME_IDS.items()]
    forms += [(f"spdx-license-identifier: {i}", i) for i in licenses.NAMES]
    # Anything but letters, digits, full stops and plus signs may stand between the words, line ends included.
    forms += [(s.replace(" ", "\n * "), ident) for s, ident in forms if not s.startswith("spdx")]
    assert all(re.search(licenses.HINT, s) for s, _ in forms)
    rows = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame([(k, s) for k, (s, _) in enumerate(forms)], "doc_id bigint, text string")).collect()}
    for k, (s, ident) in enumerate(forms):
        assert rows[k]["sentence_ids"] == ident, (s, rows[k])


def test_documents_and_odd_rows(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = licenses.scan(docs).collect()
        assert len(rows) == docs.count()
        assert all((r["sentence_ids"], r["licenses"]) == plain(texts[r["doc_id"]]) for r in rows)
    assert licenses.scan(no_docs).collect() == []


def test_no_python_in_the_plan(documents):
    plan = licenses.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
