"""Known licence texts and notices.

Fixed values: identifiers, families, names and texts as their publishers word them.
Notices are built by rule from sentence forms and names.
"""

from __future__ import annotations

# Fixed values: (identifier, family, names used in notices).
LICENSES = [
    ("MIT", "permissive", ["MIT License", "MIT"]),
    ("Apache-2.0", "permissive", ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"]),
    ("BSD-2-Clause", "permissive", ["BSD 2-Clause License", "Simplified BSD License"]),
    ("BSD-3-Clause", "permissive", ["BSD 3-Clause License", "New BSD License", "Modified BSD License"]),
    ("ISC", "permissive", ["ISC License"]),
    ("Zlib", "permissive", ["zlib License"]),
    ("Unlicense", "permissive", ["Unlicense"]),
    ("BSL-1.0", "permissive", ["Boost Software License, Version 1.0", "Boost Software License 1.0"]),
    ("MPL-2.0", "weak copyleft", ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"]),
    ("EPL-2.0", "weak copyleft", ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"]),
    ("LGPL-2.1", "weak copyleft", ["GNU Lesser General Public License, version 2.1", "LGPL 2.1"]),
    ("LGPL-3.0", "weak copyleft", ["GNU Lesser General Public License, version 3", "LGPL 3.0"]),
    ("GPL-2.0", "copyleft", ["GNU General Public License, version 2", "GPL 2.0", "GPLv2"]),
    ("GPL-3.0", "copyleft", ["GNU General Public License, version 3", "GPL 3.0", "GPLv3"]),
    ("AGPL-3.0", "copyleft", ["GNU Affero General Public License, version 3", "AGPL 3.0", "AGPLv3"]),
    ("CC0-1.0", "permissive", ["CC0 1.0", "CC0 1.0 Universal"]),
    ("CC-BY-4.0", "permissive", ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]),
    ("CC-BY-SA-4.0", "copyleft", ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("CC-BY-ND-4.0", "no derivatives", ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"]),
    ("CC-BY-NC-4.0", "non-commercial", ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]),
    ("CC-BY-NC-SA-4.0", "non-commercial", [
        "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"]),
    ("CC-BY-NC-ND-4.0", "non-commercial", [
        "CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"]),
]

# Sentences that state a licence.
NOTICES = [
    "Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.",
    "Distributed under the {}.", "This work is licensed under the {}.", "This work is licensed under {}.",
    "This work is licensed under a {}.", "This project is licensed under the {}.", "This software is licensed under the {}.",
    "This program is licensed under the {}.", "License: {}", "SPDX-License-Identifier: {}",
]

_NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n")
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# Whole licence texts.
TEXTS = [
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
     "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software.\n\n" + _NO_WARRANTY),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without "
     "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
     'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
     "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
     "PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_TAIL),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software "
     "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
     "following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote "
     "the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
     "appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be "
     "misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source "
     "distribution."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\n"
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License."),
]


# Further whole texts and the file headers of licences whose full text is a document of its own.
FURTHER_TEXTS = [
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\n"
     "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
     "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
     "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
     "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
     "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity "
     "of all present and future rights to this software under copyright law.\n\n"
     + _NO_WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
     + "\n\nFor more information, please refer to <https://unlicense.org/>"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any "
     "person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
     '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works '
     "of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
     "following:\n\n"
     "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and "
     "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works "
     "of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
     "generated by a source language processor.\n\n"
     'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
     "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
     "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, "
     "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
# Identifier, licence, version and what the header calls the software, for the headers of the GNU licences.
_GNU = [
    ("GPL-2.0", "General", "2", "program"), ("GPL-3.0", "General", "3", "program"), ("AGPL-3.0", "Affero General", "3", "program"),
    ("LGPL-2.1", "Lesser General", "2.1", "library"), ("LGPL-2.1", "Lesser General", "2.1", "program"),
    ("LGPL-3.0", "Lesser General", "3", "library"), ("LGPL-3.0", "Lesser General", "3", "program"),
]
_VERSIONS = [
    "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.",
    "as published by the Free Software Foundation, either version {} of the License, or any later version.",
    "as published by the Free Software Foundation, version {} of the License.",
    "as published by the Free Software Foundation, version {}.",
    "version {} as published by the Free Software Foundation.",
]
_COPIES = [
    "If not, see <https://www.gnu.org/licenses/>.",
    "if not, see <https://www.gnu.org/licenses/>.",
    "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "if not, write to the Free Software Foundation, Inc., 51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "if not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
]


def _gnu_headers() -> list[tuple[str, str]]:
    return [(ident, f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
             f"Public License {form.format(version)}\n\nThis {work} is distributed in the hope that it will be useful, but WITHOUT "
             "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
             f"{kind} Public License for more details.\n\nYou should have received a copy of the GNU {kind} Public License along "
             f"with this {work}; {copy}") for ident, kind, version, work in _GNU for form in _VERSIONS for copy in _COPIES]


def known() -> list[tuple[str, str, str]]:
    """(identifier, family, text) of every whole licence and of every notice form with every name."""
    family = {name: kind for name, kind, _ in LICENSES}
    whole = [(name, family[name], text) for name, text in TEXTS]
    return whole + [(ident, kind, form.format(name)) for ident, kind, names in LICENSES
                    for name in dict.fromkeys([*names, ident]) for form in NOTICES]


def bodies() -> list[tuple[str, str, str]]:
    """(identifier, family, text) of the whole licences that begin with a title, without it."""
    family = {name: kind for name, kind, _ in LICENSES}
    split = [(name, *text.split("\n\n", 1)) for name, text in TEXTS]
    return [(name, family[name], body) for name, title, body in split if title.endswith(" License")]


def further() -> list[tuple[str, str, str]]:
    """(identifier, family, text) of the whole texts and file headers that the SQL does not hold."""
    family = {name: kind for name, kind, _ in LICENSES}
    return [(name, family[name], text) for name, text in dict.fromkeys([*FURTHER_TEXTS, *_gnu_headers()])]
