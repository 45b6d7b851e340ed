"""Licence recognition on unabridged texts, wrapped as their publishers wrap them."""

import re
import textwrap

import pytest

from lakeward.llm import license_scan as ls

MIT = """MIT License

Copyright (c) 2019 Example Authors

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
BSD2 = """Copyright (c) 2011, Example
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{more}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
BSD3 = BSD2.format(
    more="""3. Neither the name of Example, Inc nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission.
"""
)
BSD2 = BSD2.format(more="")
ISC = """Copyright (c) 2015, Example <me@example.org>
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
APACHE = """# Copyright 2020 Example
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GNU = """This program is free software{stop} you can redistribute it and/or modify
it under the terms of the GNU {kind} Public License as published by
the Free Software Foundation{comma} either version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
CASES = [
    (MIT, ["MIT"]),
    (MIT.replace("\n", "\r\n"), ["MIT"]),
    (textwrap.fill(MIT.split("\n\n")[2], 40) + "\n\n" + "\n\n".join(MIT.split("\n\n")[3:]), ["MIT"]),
    (textwrap.indent(MIT, " * ", lambda _: True), ["MIT"]),
    (BSD2, ["BSD-2-Clause"]),
    (BSD3, ["BSD-3-Clause"]),
    (BSD3 + BSD2, ["BSD-3-Clause", "BSD-2-Clause"]),
    (BSD2 + BSD3 + BSD3, ["BSD-3-Clause", "BSD-2-Clause"]),
    (ISC, ["ISC"]),
    (APACHE, ["Apache-2.0"]),
    (GNU.format(stop=";", kind="General", comma=";", version=2), ["GPL-2.0-or-later"]),
    (GNU.format(stop=":", kind="General", comma=",", version=3), ["GPL-3.0-or-later"]),
    (GNU.format(stop=";", kind="Lesser General", comma=";", version=2.1), ["LGPL-2.1-or-later"]),
    (GNU.format(stop=":", kind="Affero General", comma=", ", version=3), ["AGPL-3.0-or-later"]),
    (MPL, ["MPL-2.0"]),
    ("To the extent possible under law, Example has waived all copyright and\nrelated or "
     "neighboring rights to Example Data.", ["CC0-1.0"]),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International "
     "License.", ["CC-BY-SA-4.0"]),
    ("This work is licensed under the Creative Commons Attribution 3.0 Unported License.", ["CC-BY-3.0"]),
    ("Some text.\nReleased under CC BY 4.0.\nMore", ["CC-BY-4.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    ("The code is distributed under the terms of the 3-clause BSD license.", ["BSD-3-Clause"]),
    ("A licence was granted under the old law. The software is provided by us.", []),
]


def test_unabridged_texts(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id int, text string")
    found = {r["doc_id"]: r["licenses"] for r in ls.scan_licenses(docs).collect()}
    assert [found[i] for i in range(len(CASES))] == [names for _, names in CASES]


@pytest.mark.parametrize("sentences", [ls._KNOWN, ls.NAMED])
def test_tables_are_normalised(sentences):
    assert all(re.fullmatch("[a-z0-9]+(?: [a-z0-9]+)*", s) for s in sentences)
    assert all(len(s) <= ls.LONGEST for s in sentences)
    assert sentences is ls.NAMED or all(re.search(ls.HINT, s) for s in sentences)
