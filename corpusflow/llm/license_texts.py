"""Licence templates: notices and mentions in several phrasings, identifier lines, standard headers, opening grants, whole
short licences and the beginnings of long ones, as they are put into files.

Fixed values: the public texts of the licences, by (SPDX name, form).
"""

from __future__ import annotations

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
    "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: "
)
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_APACHE_GRANT = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
)
_APACHE_REST = (
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions and limitations under the License."
)


def _gnu(name: str, version: str, thing: str = "program") -> str:
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
        f"Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        f"FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
    )


def _gnu_grant(name: str, version: str, thing: str = "program") -> str:
    return _gnu(name, version, thing).split(" This ")[0]


def _creative(kind: str) -> str:
    return f"This work is licensed under a Creative Commons {kind} 4.0 International License."


TEMPLATES: dict[tuple[str, str], str] = {
    ("0BSD", "body"): "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ("AGPL-3.0", "grant"): _gnu_grant("Affero General Public License", "3"),
    ("AGPL-3.0", "header"): _gnu("Affero General Public License", "3"),
    ("AGPL-3.0", "notice"): "Licensed under the GNU Affero General Public License, version 3.",
    ("Apache-2.0", "grant"): _APACHE_GRANT,
    ("Apache-2.0", "header"): _APACHE_GRANT + _APACHE_REST,
    ("Apache-2.0", "notice"): "Licensed under the Apache License, Version 2.0.",
    ("BSD-2-Clause", "body"): _BSD_HEAD + _BSD_TWO + _BSD_TAIL,
    ("BSD-2-Clause", "notice"): "Released under the BSD 2-Clause License.",
    ("BSD-3-Clause", "body"): _BSD_HEAD + _BSD_TWO + _BSD_THREE + _BSD_TAIL,
    ("BSD-3-Clause", "notice"): "Released under the BSD 3-Clause License.",
    ("BSL-1.0", "notice"): "Distributed under the Boost Software License, Version 1.0.",
    ("CC-BY-4.0", "header"): _creative("Attribution"),
    ("CC-BY-4.0", "notice"): "Licensed under CC BY 4.0.",
    ("CC-BY-NC-4.0", "header"): _creative("Attribution-NonCommercial"),
    ("CC-BY-NC-4.0", "notice"): "Licensed under CC BY-NC 4.0.",
    ("CC-BY-NC-ND-4.0", "header"): _creative("Attribution-NonCommercial-NoDerivatives"),
    ("CC-BY-NC-ND-4.0", "notice"): "Licensed under CC BY-NC-ND 4.0.",
    ("CC-BY-NC-SA-4.0", "header"): _creative("Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-NC-SA-4.0", "notice"): "Licensed under CC BY-NC-SA 4.0.",
    ("CC-BY-ND-4.0", "header"): _creative("Attribution-NoDerivatives"),
    ("CC-BY-ND-4.0", "notice"): "Licensed under CC BY-ND 4.0.",
    ("CC-BY-SA-4.0", "header"): _creative("Attribution-ShareAlike"),
    ("CC-BY-SA-4.0", "notice"): "Licensed under CC BY-SA 4.0.",
    ("CC0-1.0", "header"): "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ("CC0-1.0", "notice"): "Released under the CC0 1.0 Universal public domain dedication.",
    ("GPL-2.0", "grant"): _gnu_grant("General Public License", "2"),
    ("GPL-2.0", "header"): _gnu("General Public License", "2"),
    ("GPL-2.0", "notice"): "This work is licensed under the GNU General Public License, version 2.",
    ("GPL-3.0", "grant"): _gnu_grant("General Public License", "3"),
    ("GPL-3.0", "header"): _gnu("General Public License", "3"),
    ("GPL-3.0", "notice"): "This work is licensed under the GNU General Public License, version 3.",
    ("ISC", "body"): (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    ("LGPL-2.1", "header"): _gnu("Lesser General Public License", "2.1", "library"),
    ("LGPL-2.1", "notice"): "Licensed under the GNU Lesser General Public License, version 2.1.",
    ("LGPL-3.0", "header"): _gnu("Lesser General Public License", "3"),
    ("LGPL-3.0", "notice"): "Licensed under the GNU Lesser General Public License, version 3.",
    ("MIT", "body"): _MIT_GRANT + _MIT_REST,
    ("MIT", "grant"): _MIT_GRANT,
    ("MIT", "notice"): "Released under the MIT License.",
    ("MPL-2.0", "header"): (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    ("MPL-2.0", "notice"): "Licensed under the Mozilla Public License, Version 2.0.",
    ("Unlicense", "body"): (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
        "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means."
    ),
    ("Zlib", "body"): (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must "
        "not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment "
        "in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and "
        "must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
}


#: What licences are called in running text, the shorter names first where one is part of another's usual phrase.
NAMES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("GNU Affero General Public License version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPL-3.0 license"),
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0 license"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0 license"),
    "GPL-2.0": ("GNU General Public License version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2 license"),
    "GPL-3.0": ("GNU General Public License version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3 license"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3"),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0"),
    "Zlib": ("zlib License",),
}
#: "This project is MIT licensed."
SHORT_NAMES = {"Apache-2.0": ("Apache 2.0",), "BSD-3-Clause": ("BSD 3-Clause",), "BSD-2-Clause": ("BSD 2-Clause",), "ISC": ("ISC",), "MIT": ("MIT",), "GPL-3.0": ("GPLv3", "GPL-3.0"), "GPL-2.0": ("GPLv2", "GPL-2.0"), "MPL-2.0": ("MPL 2.0",), "Zlib": ("zlib",)}
#: Licences that their line in source files names.
LINES = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib")
#: How the long licences begin, which are known by that.
_GNU_OPENING = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
OPENINGS = {
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> " + _GNU_OPENING,
    "Apache-2.0": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA " + _GNU_OPENING,
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> " + _GNU_OPENING,
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> " + _GNU_OPENING,
    "MPL-2.0": 'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.',
}
for _license, _names in NAMES.items():
    for _k, _name in enumerate(_names):
        TEMPLATES[_license, f"mention {2 * _k}"] = f"under the {_name}"
        TEMPLATES[_license, f"mention {2 * _k + 1}"] = f"terms of the {_name}"
for _license, _names in SHORT_NAMES.items():
    for _k, _name in enumerate(_names):
        TEMPLATES[_license, f"short {_k}"] = f"is {_name} licensed"
for _license in LINES:
    TEMPLATES[_license, "line"] = f"SPDX-License-Identifier: {_license}"
for _license, _text in OPENINGS.items():
    TEMPLATES[_license, "opening"] = _text
