"""Public licence texts and one-line notices, each under its SPDX name.

Long texts are the files in ``known_licences``, named by licence; they are read by the driver.
"""

from __future__ import annotations

import re
from importlib import resources

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

BSD_BODY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.

""" + BSD_BODY

BSD_3 = BSD_2.replace(BSD_BODY, """3. Neither the name of the copyright holder nor the names of its contributors may
be used to endorse or promote products derived from this software without
specific prior written permission.

""" + BSD_BODY)

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In
no event will the authors be held liable for any damages arising from the use of
this software.

Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim
that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this
software dedicate any and all copyright interest in the software to the public
domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an
overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

FILES = {
    file.name.removesuffix(".txt"): file.read_text(encoding="utf-8")
    for file in sorted((resources.files("evenhand.llm") / "known_licences").iterdir(), key=lambda f: f.name) if file.name.endswith(".txt")
}
END = "END OF TERMS AND CONDITIONS"
ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor, Boston,? MA\s+02110-1301,?\s+USA")
OLD_ADDRESSES = ["59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA", "675 Mass Ave, Cambridge, MA 02139, USA"]

#: The header for source files that stands in the text of a licence, and the licence that it grants.
HEADERS = {
    "Apache-2.0": (r"Licensed under the Apache License.*limitations under the License\.", ""),
    "GPL-1.0": (r"This program is free software;.*?USA", "-or-later"), "GPL-2.0": (r"This program is free software;.*?USA", "-or-later"),
    "GPL-3.0": (r"This program is free software:.*?licenses/>\.", "-or-later"),
    "LGPL-2.0": (r"This library is free software;.*?USA", "-or-later"), "LGPL-2.1": (r"This library is free software;.*?USA", "-or-later"),
    "MPL-2.0": (r"This Source Code Form is subject to.*?MPL/2\.0/\.", ""),
}


def forms(name: str, text: str) -> list[tuple[str, str]]:
    """(licence, text) of a whole text, without what follows its terms, without what goes before them, and its header;
    each with the addresses that older copies carry."""
    out = [(name, text)]
    if END in text:
        terms = text[: text.index(END)]
        out += [(name, terms), (name, terms + END)]
    if name == "CC0-1.0":
        body = text[text.index("Statement of Purpose") :]
        out += [(name, body), (name, "CC0 1.0 Universal\n\n" + body)]
    if name == "MPL-2.0":
        out.append((name, text[: text.index("Exhibit A - ")]))
    if name in HEADERS:
        pattern, suffix = HEADERS[name]
        out.append((name + suffix, re.search(pattern, text, re.DOTALL).group()))
    return out + [(licence, ADDRESS.sub(old, form)) for licence, form in out if ADDRESS.search(form) for old in OLD_ADDRESSES]


#: Whole licence texts, with and without the title line that many copies carry.
TEXTS = [
    ("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC), ("ISC", "ISC License\n\n" + ISC),
    ("BSD-2-Clause", BSD_2), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_2),
    ("BSD-3-Clause", BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_3),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n\n" + ZLIB), ("Unlicense", UNLICENSE),
    *[form for name, text in FILES.items() for form in forms(name, text)],
]

#: Names in running text.
NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"], "Zlib": ["zlib License"], "Unlicense": ["Unlicense"],
    "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MPL-1.1": ["Mozilla Public License, version 1.1"], "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    **{
        f"{short}-{number}": [f"GNU {long} Public License, version {shown}", f"GNU {long} Public License v{shown}", f"GNU {short} v{shown} License"]
        for short, long, number, shown in [
            ("GPL", "General", "1.0", "1"), ("GPL", "General", "2.0", "2"), ("GPL", "General", "3.0", "3"),
            ("LGPL", "Library General", "2.0", "2"), ("LGPL", "Lesser General", "2.1", "2.1"), ("LGPL", "Lesser General", "3.0", "3"),
        ]
    },
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License"],
}
OPENINGS = ["Licensed under the", "Released under the", "Distributed under the", "This work is licensed under the", "This work is licensed under a", "This project is licensed under the"]
SPDX = [*NAMES, "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "Artistic-1.0-Perl"]
SPDX += [name + end for name in SPDX if name.startswith(("GPL", "LGPL", "GFDL")) for end in ("-only", "-or-later")]

#: Notices that stand on one line. Each contains the letters "licen".
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    *[(name, f"SPDX-License-Identifier: {name}") for name in SPDX if name not in ("MIT", "Apache-2.0")],
    *[(name, f"{opening} {title}.") for name, titles in NAMES.items() for title in titles for opening in OPENINGS],
]
