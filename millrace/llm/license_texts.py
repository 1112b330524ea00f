"""How common licences and their notices read. (licence, text)"""

from __future__ import annotations

_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions:"""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(name: str, what: str, version: str) -> str:
    """The notice that GNU licences ask for."""
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, "
        f"either version {version} of the License, or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
        f"You should have received a copy of the GNU {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."
    )


_GNU = (
    ("GPL-2.0", "General Public License", "program", "2", "June 1991"), ("GPL-3.0", "General Public License", "program", "3", "29 June 2007"),
    ("LGPL-2.1", "Lesser General Public License", "library", "2.1", "February 1999"), ("LGPL-3.0", "Lesser General Public License", "library", "3", "29 June 2007"),
    ("AGPL-3.0", "Affero General Public License", "program", "3", "19 November 2007"),
)
_IDS = ("Apache-2.0", "MIT", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "MPL-1.1", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense", "BSL-1.0", "EPL-2.0", "GFDL-1.3", "Artistic-2.0")

TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Distributed under the terms of the Apache License 2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    ("MIT", "Released under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", _GRANT),
    ("MIT", f"{_GRANT} {_NOTICE} {_AS_IS}"),
    ("ISC", "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSD-2-Clause", _BSD),
    ("BSD-2-Clause", f"{_BSD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3} {_BSD_AS_IS}"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("Artistic-2.0", "The Artistic License 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("proprietary", "All rights reserved"),
    *((i, _gnu(name, what, version)) for i, name, what, version, _ in _GNU),
    *((i, f"This {what} is licensed under the GNU {name}, version {version}") for i, name, what, version, _ in _GNU),
    *((i, f"This work is licensed under the GNU {name}, version {version}") for i, name, _, version, _ in _GNU),
    *((i, f"GNU {name} Version {version}, {date}") for i, name, _, version, date in _GNU),
    *((i, f"Distributed under the terms of the GNU {name} v{version}") for i, name, _, version, _ in _GNU),
    *((i, f"Distributed under the terms of the {i.split('-')[0]} v{version}") for i, _, _, version, _ in _GNU),
    *((i, f"SPDX-License-Identifier: {i}") for i in _IDS),
)
