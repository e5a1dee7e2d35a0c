"""License scans of the standard headers, however they are wrapped, indented or commented."""

import textwrap
import time

import pytest

from voxtable.llm import license_scan

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This {program} is free software{colon} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{comma} either version {version} of the License, or
(at your option) any later version.

This {program} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.

You should have received a copy of the GNU {kind}General Public License
along with this {program}.  If not, see <https://www.gnu.org/licenses/>.
"""


def gpl(version, kind="", program="program", colon=":", comma=","):
    return GPL.format(version=version, kind=kind, program=program, colon=colon, comma=comma)


BSD2 = """Copyright (c) 2020, A Person.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
ENDORSE = """3. Neither the name of the Example Organisation nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
BSD_ASIS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
MIT = """MIT License

Copyright (c) 2020 A Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
CC0 = """To the extent possible under law, the person who associated CC0 with
this work has waived all copyright and related or neighboring rights
to this work.
"""
HEADERS = [
    (APACHE, "Apache-2.0"),
    (gpl(3), "GPL-3.0-or-later"),
    (gpl(2, colon=";", comma=";"), "GPL-2.0-or-later"),
    (gpl("2.1", "Lesser ", "library", ";", ";"), "LGPL-2.1-or-later"),
    (gpl(3, "Lesser "), "LGPL-3.0-or-later"),
    (gpl(3, "Affero "), "AGPL-3.0-or-later"),
    (BSD2 + BSD_ASIS, "BSD-2-Clause,all-rights-reserved"),
    (BSD2 + ENDORSE + BSD_ASIS, "BSD-3-Clause,all-rights-reserved"),
    (MIT, "MIT"),
    (ISC, "ISC"),
    (MPL, "MPL-2.0"),
    (CC0, "CC0-1.0"),
    ("SPDX-License-Identifier: MIT\n", "MIT"),
    ("SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0) OR Zlib\n", "GPL-2.0-or-later,Zlib"),
]


def _rewrapped(text, width):
    parts = text.split("\n\n")
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in parts) + "\n"


FORMS = {
    "flush": lambda t: t,
    "indented": lambda t: textwrap.indent(t, "    "),
    "hash": lambda t: "#!/bin/sh\n" + textwrap.indent(t, "# ", lambda line: True),
    "dashes": lambda t: textwrap.indent(t, "-- ", lambda line: True),
    "slashes": lambda t: textwrap.indent(t, "// ", lambda line: True) + "int x;\n",
    "stars": lambda t: "/*\n" + textwrap.indent(t, " * ", lambda line: True) + " */\nint x;\n",
    "boxed": lambda t: "/* " + t.strip() + " */\nint x;\n",
    "crlf": lambda t: t.replace("\n", "\r\n"),
    "narrow": lambda t: textwrap.indent(_rewrapped(t, 34), " * ", lambda line: True),
    "words": lambda t: t if "SPDX" in t else _rewrapped(t, 1),
}


@pytest.mark.parametrize("form", FORMS)
def test_standard_headers(spark, form):
    texts = [(i, FORMS[form](t)) for i, (t, _) in enumerate(HEADERS) if form != "narrow" or "SPDX" not in t]
    docs = spark.createDataFrame(texts, "i int, text string")
    found = {r.i: (r.licenses, r.unmatched) for r in license_scan.scan_licenses(docs).collect()}
    assert found == {i: (HEADERS[i][1], 0) for i, _ in texts}


def test_prose_around_a_notice(spark):
    texts = [
        "A heading without a stop\nLicensed under the Apache\nLicense, Version 2.0\nA next heading",
        "the king said that\nall rights reserved\nto him are licensed",
        "It is said that this is licensed under the mit license. Or not.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = license_scan.scan_licenses(docs).orderBy("i").collect()
    assert [r.licenses for r in rows] == ["Apache-2.0", "", ""]


NOTICE = "Licensed under the Apache License, Version 2.0"


@pytest.mark.parametrize(
    "stretch",
    [" ", "\t", "\n", "# ", "*", "-", "#", "/", "<!-- ", "-->", " \n", "\n# ", "\n - ", ".", ". ", "!", ";", "; ", "(", ")", "| ", "1. ", "\n1. ", "\r\n", "dnl ", "\ndnl "],
)
def test_long_stretches_of_marks_and_blanks(spark, stretch):
    """Linear in the length of a stretch: in the middle of a line, at its start, at its end, and alone."""
    long = stretch * (100_000 // len(stretch))
    texts = [f"A license{long}here", f"{long}{NOTICE}.\n", f"{NOTICE}.\n{long}", f"{NOTICE}{long}\n\nx", long + " license"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    start = time.monotonic()
    rows = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert time.monotonic() - start < 30
    assert len(rows) == len(texts)
    assert rows[2].licenses == "Apache-2.0"


def test_a_long_holder_name(spark):
    name = "The " + "Very " * 200 + "Long Foundation"
    text = f"Neither the name of {name} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    docs = spark.createDataFrame([(text,)], "text string")
    assert license_scan.scan_licenses(docs).first().sentence_ids == "BSDendorse"
