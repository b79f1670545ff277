"""Published notices as they stand in files: wrapped, in comments, on one line, between other text."""

import re

import pytest

from tillsight.llm import licences

NOTICES = {
    "MIT": """MIT License

Copyright (c) 2024 Some Body

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
SOFTWARE.""",
    "Apache-2.0": """Copyright 2024 Some Body

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "BSD-2-Clause": """Copyright (c) 2024, Some Body
All rights reserve.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.""",
    "GPL-3.0": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "LGPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all
copyright and related and neighboring rights to this software to the
public domain worldwide. This software is distributed without any
warranty.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
}
NOTICES["BSD-3-Clause"] = NOTICES["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED", """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED""")

SHAPES = {
    "as published": lambda t: t,
    "windows line ends": lambda t: t.replace("\n", "\r\n"),
    "slashes": lambda t: "\n".join(f"// {x}".rstrip() for x in t.split("\n")),
    "hashes": lambda t: "\n".join(f"# {x}".rstrip() for x in t.split("\n")) + "\n\nimport os\n",
    "stars": lambda t: "/*\n" + "\n".join(f" * {x}".rstrip() for x in t.split("\n")) + "\n */\nint main() {}\n",
    "bullets": lambda t: re.sub(r"(?m)^\d\. ", "* ", t),
    "one line": lambda t: re.sub(r"\s+", " ", t),
    "between prose": lambda t: f"Some words before it.\n\n{t}\n\nAnd some after.",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_published_notices(spark, shape):
    rows = [(name, SHAPES[shape](text)) for name, text in NOTICES.items()]
    out = {r.doc_id: r.licences for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    missed = {name: found for name, found in out.items() if name not in found}
    assert not missed
    # One notice is one licence, but for the shorter of two that begin alike.
    assert all(found == [name] for name, found in out.items())


def test_a_notice_on_a_line_of_its_own(spark):
    rows = [(1, "a title without a stop\nLicensed under CC BY-NC 4.0\nand more words"), (2, "x\n\nAll rights reserved.\ny"),
            (3, "We talk about the MIT license and permission to use software. Nothing is licensed here."),
            (4, "the software is provided to all. permission granted")]
    out = {r.doc_id: r.licences for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: ["CC-BY-NC-4.0"], 2: ["Proprietary"], 3: [], 4: []}


def test_every_known_sentence_can_be_met(spark):
    """Each listed sentence, alone in a paragraph, gives its identifier: none is cut by the splitter or left out by the hint."""
    named = [(f"{ident} {i}", t, ident) for ident, texts in licences.SENTENCES.items() for i, t in enumerate(texts) if ident != "mpl2-version"]
    out = licences.scan(spark.createDataFrame([r[:2] for r in named], "doc_id string, text string")).collect()
    found = {r.doc_id: r.sentence_ids for r in out}
    assert {k: [ident] for k, _, ident in named} == found
    assert len({t for t, _ in licences.known_sentences()}) == len(licences.known_sentences())
