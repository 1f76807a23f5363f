"""Licence rules on notices as they are published, also as comments of source files."""

import pytest

from termloom.llm.licenses import RULES, SENTENCES, recognise_licences

GPL3 = """Copyright (C) 2021  Jo Doe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301, USA.
"""
LGPL21 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""
AGPL3 = GPL3.replace("GNU General Public License", "GNU Affero General Public License").replace("GNU\nGeneral", "GNU\nAffero General")
MPL2 = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE2 = """Copyright 2020 Jo Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Jo Doe

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
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
NOTICES = {
    "GPL-3.0-or-later": GPL3, "GPL-2.0-or-later": GPL2, "LGPL-2.1-or-later": LGPL21, "AGPL-3.0-or-later": AGPL3, "MPL-2.0": MPL2,
    "Apache-2.0": APACHE2, "MIT": MIT, "BSD-3-Clause": BSD3, "BSD-2-Clause": BSD3[: BSD3.index("3. Neither")], "ISC": ISC,
    "Unlicense": UNLICENSE,
}


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: (r["licences"], r["unmatched"]) for r in recognise_licences(docs).collect()}
    return [rows[i] for i in range(len(texts))]


def commented(text, sign):
    return "\n".join(f"{sign} {line}".rstrip() for line in text.splitlines()) + "\n\ncode follows\n"


@pytest.mark.parametrize("sign", ["", "#", "//", " *", ";;", "--"])
def test_published_notices(spark, sign):
    texts = [commented(t, sign) if sign else t for t in NOTICES.values()]
    assert found(spark, texts) == [(name, "") for name in NOTICES]


def test_other_versions_are_not_taken_for_these(spark):
    texts = [
        MPL2.replace("v. 2.0", "v. 1.1"), GPL3.replace("version 3", "version 4"), LGPL21.replace("2.1", "9"), APACHE2.replace("Version 2.0", "Version 9"),
        GPL2.replace("Foundation; either version 2\nof the License, or (at your option) any later version.", "Foundation."),
    ]
    assert [licences for licences, _ in found(spark, texts)] == [""] * 5


def test_a_notice_that_breaks_off(spark):
    assert found(spark, [GPL3[: GPL3.index("You should")], GPL3[: GPL3.index("This program is distributed")], GPL2 + "\n" + MIT]) == [
        ("GPL-3.0-or-later", ""), ("GPL-3.0-or-later", ""), ("GPL-2.0-or-later,MIT", "")
    ]


def test_every_rule_can_fire(spark):
    """What the cutter leaves of the sentences of a rule, one after the other, is that rule's licence."""
    sentences = dict(reversed(SENTENCES))
    assert all(name in sentences for _, sequence in RULES for name in sequence)
    texts = [". ".join(sentences[name] for name in sequence) + "." for _, sequence in RULES]
    assert found(spark, texts) == [(licence, "") for licence, _ in RULES]
