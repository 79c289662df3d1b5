"""Notices and short full texts of common licences, the default table of the license scan.

Families whose notices differ in a name and a version are written by rule.
"""

from __future__ import annotations

from itertools import product

# Standard wordings. Parts in braces are filled in below.
_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_REST = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE."
)
_TEXTS = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", _MIT_GRANT),
    ("MIT", f"{_MIT_GRANT} {_MIT_REST}"),
    ("ISC", "Released under the ISC License."),
    ("ISC", _ISC_GRANT + _ISC_KEEP),
    ("ISC", _ISC_GRANT + _ISC_KEEP + _ISC_REST),
    ("0BSD", f"{_ISC_GRANT}."),
    ("0BSD", f"{_ISC_GRANT}.{_ISC_REST}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
                   "See the License for the specific language governing permissions and limitations under the License."),
    # The grant alone does not tell the clauses that follow it.
    ("BSD", _BSD_GRANT),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_TWO} {_DISCLAIMER}"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_THIRD} {_DISCLAIMER}"),
    ("BSD-3-Clause", _BSD_THIRD),
    ("MPL-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not '
                "use this file except in compliance with the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the "
                "Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
             "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
             "following restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
                  "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("WTFPL", "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can "
              "redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
_GNU = [
    ("GPL", "program", "General", ("2", "3")),
    ("LGPL", "library", "Lesser General", ("2.1", "3")),
    ("AGPL", "program", "Affero General", ("3",)),
]
_GNU_NOTICES = [
    "This work is licensed under the GNU {kind} Public License, version {version}.",
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of version {version} of the GNU "
    "{kind} Public License as published by the Free Software Foundation.",
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public "
    "License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
    "later version.",
]
_CC_TERMS = [
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]
_CC_VERSIONS = [("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]


def _gnu() -> list[tuple[str, str]]:
    out = []
    for name, thing, kind, versions in _GNU:
        for version, notice in product(versions, _GNU_NOTICES):
            spdx = f"{name}-{version if '.' in version else version + '.0'}"
            out.append((spdx, notice.format(thing=thing, kind=kind, version=version)))
    return out


def _creative_commons() -> list[tuple[str, str]]:
    out = []
    for (code, terms), (version, port) in product(_CC_TERMS, _CC_VERSIONS):
        name = f"CC-{code}-{version}"
        out.append((name, f"Licensed under CC {code} {version}."))
        out.append((name, f"This work is licensed under a Creative Commons {terms} {version} {port} License."))
    return out


TEMPLATES: list[tuple[str, str]] = [*_TEXTS, *_gnu(), *_creative_commons()]
