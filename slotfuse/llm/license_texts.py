"""Phrases and license texts that the license scan looks for."""

from __future__ import annotations

from dataclasses import dataclass

# Phrases that name a license wherever they stand.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Template:
    """A passage with its label; `needs` are words of it without which a copy is another license."""

    label: str
    text: str
    needs: str = ""


_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
)
_GNU_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_GNU_COPY = "You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
_GNU_NAMES = {"gpl": "GNU General Public License", "lgpl": "GNU Lesser General Public License", "agpl": "GNU Affero General Public License"}

# Notices, and the passages of license texts one by one, so that a copy of one is found.
TEMPLATES: tuple[Template, ...] = (
    Template("mit", "released under the MIT License"),
    Template("mit", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and '
        'to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
    )),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("mit", (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR '
        'COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR '
        'OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
    )),
    Template("apache", "licensed under the Apache License, Version 2.0"),
    Template("apache", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        'the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
    )),
    Template("apache", (
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on '
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        'specific language governing permissions and limitations under the License.'
    )),
    Template("apache", (
        'Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, '
        'non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, '
        'publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.'
    )),
    Template("gpl", "licensed under the GNU General Public License, version 3", "GNU General Public License"),
    *(Template(label, _GNU.format(name=name), name) for label, name in _GNU_NAMES.items()),
    *(Template(label, _GNU_WARRANTY.format(name=name), name) for label, name in _GNU_NAMES.items()),
    *(Template(label, _GNU_COPY.format(name=name), name) for label, name in _GNU_NAMES.items()),
    Template("bsd", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    )),
    Template("bsd", (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    )),
    Template("bsd", (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    )),
    Template("bsd", (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    )),
    Template("bsd", (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
        'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, '
        'SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR '
        'SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, '
        'WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE '
        'OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
    )),
    Template("isc", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    )),
    Template("isc", (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        'IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, '
        'INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN '
        'AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR '
        'PERFORMANCE OF THIS SOFTWARE.'
    )),
    Template("zlib", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software."
    )),
    Template("zlib", (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
        "it and redistribute it freely, subject to the following restrictions:"
    )),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
    Template("unlicense", (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    )),
    Template("boost", (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software"
    )),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("mpl", (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    )),
    Template("cc-by", "licensed under CC BY 4.0"),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0"),
    Template("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    Template("all-rights-reserved", "all rights reserved"),
    *(Template(label, f"SPDX-License-Identifier: {name}", f"License-Identifier: {name}") for label, name in (
        ("mit", "MIT"), ("apache", "Apache-2.0"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"), ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"),
        ("agpl", "AGPL-3.0"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("isc", "ISC"), ("mpl", "MPL-2.0"), ("zlib", "Zlib"),
        ("boost", "BSL-1.0"), ("unlicense", "Unlicense"), ("cc0", "CC0-1.0"), ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"),
        ("cc-by-nc", "CC-BY-NC-4.0"),
    )),
)
