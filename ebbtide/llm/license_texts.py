"""Licence notices and texts that documents are compared with."""

# The wording of public licences and of their usual notices.
WARRANTY = """
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
    BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
    NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
    DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
    OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_WARRANTY = """
    THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
    IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
    AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
    CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
    SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
    THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
    OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE."""
BSD_NAMES = """
    3. Neither the name of the copyright holder nor the names of its contributors may be used to
    endorse or promote products derived from this software without specific prior written
    permission."""
TEXTS = {
    "0BSD-permission": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted.""",
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed
        to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License.""",
    "Artistic-2.0-line": "Licensed under the Artistic License 2.0.",
    "BSD-conditions": """
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "BSD-warranty": BSD_WARRANTY,
    "BSL-1.0-line": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0-permission": """
        Permission is hereby granted, free of charge, to any person or organization obtaining a
        copy of the software and accompanying documentation covered by this license (the
        "Software") to use, reproduce, display, distribute, execute, and transmit the Software,
        and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following:""",
    "CC0-1.0-notice": "This work is marked with CC0 1.0 Universal.",
    "CDDL-1.0-notice": """
        The contents of this file are subject to the terms of the Common Development and
        Distribution License (the "License"). You may not use this file except in compliance with
        the License.""",
    "EPL-1.0-notice": """
        This program and the accompanying materials are made available under the terms of the
        Eclipse Public License v1.0 which accompanies this distribution, and is available at
        http://www.eclipse.org/legal/epl-v10.html""",
    "EPL-2.0-notice": """
        This program and the accompanying materials are made available under the terms of the
        Eclipse Public License 2.0 which is available at
        https://www.eclipse.org/legal/epl-2.0/""",
    "CC0-line": "To the extent possible under law, the author has waived all copyright and "
                "related or neighboring rights to this work.",
    "ISC-permission": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
    "MIT-line": "Released under the MIT License.",
    "MIT-permission": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "MIT-warranty": WARRANTY,
    "MPL-1.1-notice": """
        The contents of this file are subject to the Mozilla Public License Version 1.1 (the
        "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.mozilla.org/MPL/""",
    "MPL-2.0-notice": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free
        to copy, modify, publish, use, compile, sell, or distribute this software, either in
        source code form or as a compiled binary, for any purpose, commercial or non-commercial,
        and by any means.""",
    "WTFPL-terms": """
        Everyone is permitted to copy and distribute verbatim or modified copies of this license
        document, and changing it is allowed as long as the name is changed.""",
    "Zlib-text": """
        This software is provided 'as-is', without any express or implied warranty. In no event
        will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: 1. The origin of this software must not be misrepresented; you
        must not claim that you wrote the original software. If you use this software in a
        product, an acknowledgment in the product documentation would be appreciated but is not
        required. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. 3. This notice may not be removed or
        altered from any source distribution.""",
}
# Parts of the names of the Creative Commons licences, and their versions.
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CREATIVE_VERSIONS = {"4.0": "International", "3.0": "Unported"}
# Label, name, version and what a notice calls the work.
GNU = (
    ("GPL", "GNU General Public License", "2", "program"),
    ("GPL", "GNU General Public License", "3", "program"),
    ("LGPL", "GNU Lesser General Public License", "2.1", "library"),
    ("LGPL", "GNU Lesser General Public License", "3", "library"),
    ("AGPL", "GNU Affero General Public License", "3", "program"))
DOCUMENTATION_VERSIONS = ("1.2", "1.3")
# Short identifiers as they stand in the head of a source file.
IDENTIFIERS = """
    0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause
    BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-4.0
    CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 GFDL-1.3-or-later GPL-2.0-only GPL-2.0-or-later
    GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only
    LGPL-3.0-or-later MIT MPL-1.1 MPL-2.0 Unlicense WTFPL Zlib""".split()


def creative_commons() -> dict[str, str]:
    out = {}
    for part, name in CREATIVE_COMMONS.items():
        for version, kind in CREATIVE_VERSIONS.items():
            out[f"CC-{part}-{version}-line"] = f"Licensed under CC {part} {version}."
            out[f"CC-{part}-{version}-notice"] = (
                f"This work is licensed under a Creative Commons {name} {version} {kind} License.")
    return out


def gnu() -> dict[str, str]:
    out = {}
    for label, name, version, work in GNU:
        full = version if "." in version else f"{version}.0"
        terms = (f"This {work} is free software: you can redistribute it and/or modify it under "
                 f"the terms of the {name} as published by the Free Software Foundation, ")
        later = f"either version {version} of the License, or (at your option) any later version. "
        hope = (f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY "
                "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
                f"PARTICULAR PURPOSE. See the {name} for more details.")
        out[f"{label}-{full}-line"] = f"This work is licensed under the {name}, version {version}."
        out[f"{label}-{full}-notice"] = terms + later + hope
        out[f"{label}-{full}-terms"] = terms + later
        out[f"{label}-{full}-only-notice"] = terms + f"version {version} of the License. " + hope
    for version in DOCUMENTATION_VERSIONS:
        out[f"GFDL-{version}-notice"] = (
            "Permission is granted to copy, distribute and/or modify this document under the "
            f"terms of the GNU Free Documentation License, Version {version} or any later version "
            "published by the Free Software Foundation; with no Invariant Sections, no "
            "Front-Cover Texts, and no Back-Cover Texts.")
    return out


TEMPLATES = {
    **TEXTS, **creative_commons(), **gnu(),
    **{f"{name}-identifier": f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS},
    "BSD-2-Clause-text": TEXTS["BSD-conditions"] + BSD_WARRANTY,
    "BSD-3-Clause-conditions": TEXTS["BSD-conditions"] + BSD_NAMES,
    "BSD-3-Clause-text": TEXTS["BSD-conditions"] + BSD_NAMES + BSD_WARRANTY,
    "MIT-text": TEXTS["MIT-permission"] + WARRANTY,
}
