"""Whole standard licence headers, short licence files and the openings of
long ones, as (SPDX id, text).  A blank line parts paragraphs."""

from __future__ import annotations

_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_BSD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
"""

_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_UNLICENSE = """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.
"""

_APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.
"""

_ASF = """
Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file
distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the
Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a
copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.
"""

_MPL = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""


def _gnu(name: str, version: str, program: str = "program") -> str:
    return f"""
This {program} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the
Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This {program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.

You should have received a copy of the GNU {name} along with this {program}. If not, see <https://www.gnu.org/licenses/>.
"""


def _gnu_opening(name: str, version: str, year: str) -> str:
    return f"""
GNU {name} Version {version}

Copyright (C) {year} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license
document, but changing it is not allowed.
"""


_GNU = [("AGPL-3.0", "Affero General Public License", "3", "19 November 2007", "2007", "program"),
        ("GPL-2.0", "General Public License", "2", "June 1991", "1989, 1991", "program"),
        ("GPL-3.0", "General Public License", "3", "29 June 2007", "2007", "program"),
        ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999", "1991, 1999", "library"),
        ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007", "2007", "library")]

_WHOLE = [
    ("Apache-2.0", _APACHE), ("Apache-2.0", _ASF),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
    ("BSD-2-Clause", _BSD + _DISCLAIMER), ("BSD-3-Clause", _BSD + _NAME + _DISCLAIMER),
    ("CC0-1.0", "Creative Commons Legal Code\n\nCC0 1.0 Universal"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("ISC", _ISC), ("MIT", _MIT), ("MPL-2.0", _MPL), ("MPL-2.0", "Mozilla Public License Version 2.0"), ("Unlicense", _UNLICENSE),
    ("Artistic-1.0-Perl", 'The "Artistic License"\n\nPreamble'), ("GFDL-1.2", _gnu_opening("Free Documentation License", "1.2, November 2002", "2000, 2001, 2002")),
    ("GFDL-1.3", _gnu_opening("Free Documentation License", "1.3, 3 November 2008", "2000, 2001, 2002, 2007, 2008")),
    ("GPL-1.0", _gnu_opening("General Public License", "1, February 1989", "1989")),
    ("LGPL-2.0", _gnu_opening("Library General Public License", "2, June 1991", "1991")), ("MPL-1.1", "Mozilla Public License Version 1.1"),
    *[(k, _gnu(name, version, program)) for k, name, version, _, _, program in _GNU],
    *[(k, _gnu_opening(name, f"{version}, {day}", year)) for k, name, version, day, year, _ in _GNU],
]

# Each text whole, and the first paragraph alone, which names the licence.
TEXTS = sorted({(k, " ".join(part.split())) for k, text in _WHOLE
                for part in ([text, text.strip().split("\n\n")[0]] if k.startswith(("AGPL", "Apache", "GFDL", "GPL", "LGPL")) else [text])})
