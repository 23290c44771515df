"""Texts by which licences are known: fixed values, in the wording of the licences' publishers.

A licence has statements of one line, the notice for the head of a file, its title, and for short
licences the whole text. The tags of the public licence list follow from the identifiers.
"""

from __future__ import annotations

WARRANTY_MIT = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GRANT_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:"""
NOTICE_MIT = """
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""
BSD_OPENING = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:"""
BSD_FIRST_TWO = """
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC_TEXT = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at"""
APACHE_WARRANTY = """
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
MPL_NOTICE = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
UNLICENSE_OPENING = "This is free and unencumbered software released into the public domain."


def _gnu(name: str, version: str) -> list[str]:
    grant = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{name} as published by the Free Software Foundation, either version {version} of the License, or (at your "
        "option) any later version."
    )
    rest = (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
        f"You should have received a copy of the GNU {name} along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    )
    return [
        f"This work is licensed under the GNU {name}, version {version}", f"GNU {name} Version {version}", grant, f"{grant} {rest}",
    ]


TEXTS: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004", APACHE_NOTICE,
        f"{APACHE_NOTICE} http://www.apache.org/licenses/LICENSE-2.0 {APACHE_WARRANTY}",
    ],
    "MIT": [
        "Released under the MIT License", "The MIT License (MIT)", "MIT License", GRANT_MIT,
        f"MIT License Copyright (c) {GRANT_MIT} {NOTICE_MIT} {WARRANTY_MIT}",
    ],
    "GPL-3.0": _gnu("General Public License", "3"),
    "GPL-2.0": _gnu("General Public License", "2"),
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", *_gnu("Lesser General Public License", "3")],
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1"),
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "MPL-2.0": [
        "Subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0", MPL_NOTICE,
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license", "BSD 3-Clause License",
        f"BSD 3-Clause License Copyright (c) {BSD_OPENING} {BSD_FIRST_TWO} {BSD_THIRD} {BSD_WARRANTY}",
    ],
    "BSD-2-Clause": [
        "BSD 2-Clause License", f"BSD 2-Clause License Copyright (c) {BSD_OPENING} {BSD_FIRST_TWO} {BSD_WARRANTY}",
    ],
    "ISC": ["ISC License", f"ISC License Copyright (c) {ISC_TEXT}"],
    "Unlicense": [UNLICENSE_OPENING],
    "CC-BY-4.0": ["Licensed under CC BY 4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0"],
}
RESERVED = "Proprietary"


def templates() -> list[tuple[str, str]]:
    """(licence, text) of every template: the texts, the tags, and the reservation of all rights."""
    out = [(name, " ".join(text.split())) for name, texts in TEXTS.items() for text in texts]
    for name in TEXTS:
        ends = ["", "-only", "-or-later"] if "GPL" in name else [""]
        out += [(name, f"SPDX-License-Identifier: {name}{end}") for end in ends]
    return [*out, (RESERVED, "All rights reserved")]
