"""op5 on canonical licence texts as files carry them: wrapped, in comments, listed."""

from __future__ import annotations

import re
import textwrap

import pytest

from verdant.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Some Body

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
BSD2 = """Copyright (c) 2020, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAME = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
ADVERTISING = """
3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement: This product includes software
   developed by the organization.
"""
APACHE = """Copyright 2020 Some Body

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
TEXTS = {
    "mit": (MIT, "MIT"),
    "the mit license": (MIT.replace("MIT License", "The MIT License (MIT)"), "MIT"),
    "bsd 2": (BSD2 + DISCLAIMER, "BSD-2-Clause"),
    "bsd 3": (BSD2 + NAME + DISCLAIMER, "BSD-3-Clause"),
    "bsd 3 of a firm": (BSD2 + NAME.replace("the copyright holder", "Firm Inc.") + DISCLAIMER, "BSD-3-Clause"),
    "bsd 3 in bullets": (re.sub(r"(?m)^\d\.", " *", BSD2 + NAME) + DISCLAIMER, "BSD-3-Clause"),
    "bsd 3 in brackets": (re.sub(r"(?m)^(\d)\.", r"(\1)", BSD2 + NAME) + DISCLAIMER, "BSD-3-Clause"),
    "bsd 4": (BSD2 + ADVERTISING + NAME.replace("3.", "4.") + DISCLAIMER, "BSD-4-Clause"),
    "apache": (APACHE, "Apache-2.0"),
    "gpl 3 or later": (GPL3, "GPL-3.0-or-later"),
    "gpl 3": (GPL3.replace("either ", "").replace(", or\n(at your option) any later version", ""), "GPL-3.0-only"),
    "gpl 2 or later": (GPL2, "GPL-2.0-or-later"),
}
SHAPES = {
    "as it is": lambda t: t,
    "crlf": lambda t: t.replace("\n", "\r\n"),
    "block comment": lambda t: "/*\n" + textwrap.indent(t, " * ", lambda _: True) + " */\nint main() {}\n",
    "hash": lambda t: "#!/bin/sh\n" + textwrap.indent(t, "# ", lambda _: True) + "set -e\n",
    "rem": lambda t: textwrap.indent(t, "REM ", lambda _: True),
    "narrow": lambda t: "\n\n".join(textwrap.fill(p, 33) for p in t.split("\n\n")),
    "one line": lambda t: " ".join(t.split()),
    "within code": lambda t: f"x = 1\n\n{t}\ny = 2. Done\n",
}


@pytest.fixture(scope="module")
def found(spark):
    cases = [(n, s) for n in TEXTS for s in SHAPES]
    docs = spark.createDataFrame([(k, SHAPES[s](TEXTS[n][0])) for k, (n, s) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.op5_license_scan(docs).collect()}
    return {case: got[k] for k, case in enumerate(cases)}


@pytest.mark.parametrize("name", list(TEXTS))
def test_canonical_texts_are_found_in_every_shape(found, name):
    # Without paragraphs a title or an address runs into the next sentence; the rest is found.
    shapes = [s for s in SHAPES if s != "one line"]
    assert {s: found[name, s].licenses for s in shapes} == dict.fromkeys(shapes, TEXTS[name][1])
    assert {found[name, s].n_matches for s in shapes} == {1}
    assert name not in ("gpl 3", "gpl 3 or later", "gpl 2 or later") or found[name, "one line"].licenses == TEXTS[name][1]


def test_breaks_still_separate(spark):
    texts = ["Released under\n\nthe MIT License.", "Released under. The MIT License", "It was released under the MIT License.",
             "and so\nreleased under\nthe MIT License\nand others", "Some words |\nLicensed under CC BY 4.0.\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.sentence_ids for r in licenses.op5_license_scan(docs).collect()}
    assert got == {0: "mit-title", 1: "mit-title", 2: "", 3: "mit-notice", 4: "cc-by-4.0-notice"}
