"""Templates of licence notices and texts: short forms by rule, headers and whole texts."""

from __future__ import annotations

import re
from typing import NamedTuple

# Words with their numbers: "2.0" is one.
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"


def words_of(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


class Template(NamedTuple):
    """``named``: words that a window must have, beside its cosine, to be this licence."""

    licence: str
    words: list[str]
    named: list[str]


# How licences are called, with their SPDX names.
CALLED = {
    "0BSD": ["the Zero-Clause BSD License", "the BSD Zero Clause License", "the 0BSD License"],
    "AGPL-3.0": [
        "the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPL version 3",
        "the GNU AGPLv3", "the AGPLv3 license",
    ],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "the Apache-2.0 license"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License", "the FreeBSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "the Creative Commons Zero 1.0 license"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, Version 2.0", "the Eclipse Public License v2.0"],
    "GPL-2.0": [
        "the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL version 2", "the GNU GPLv2",
        "the GPLv2 license",
    ],
    "GPL-3.0": [
        "the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL version 3", "the GNU GPLv3",
        "the GPLv3 license",
    ],
    "ISC": ["the ISC License"],
    "LGPL-2.1": [
        "the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the GNU LGPL version 2.1",
        "the GNU LGPLv2.1",
    ],
    "LGPL-3.0": [
        "the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the GNU LGPL version 3",
        "the GNU LGPLv3",
    ],
    "MIT": ["the MIT License", "the MIT/X11 License"],
    "MPL-2.0": ["the Mozilla Public License, v. 2.0", "the Mozilla Public License, Version 2.0", "the MPL 2.0"],
    "Unlicense": ["the Unlicense"],
    "Zlib": ["the zlib License", "the zlib/libpng License"],
}
# What stands before the name of a licence, and words that do not tell it.
FORMS = ["Released under", "Licensed under", "Distributed under", "Available under", "under the terms of"]
GENERIC = {"the", "a", "license", "licence", "version", "v", "international"}
# A name of so many words is a notice by itself.
BARE_WORDS = 4

FREE_SOFTWARE = (
    "{} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
    "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
)
GNU = [
    ("GPL-2.0", "", "2", []), ("GPL-3.0", "", "3", []), ("LGPL-2.1", "Lesser ", "2.1", ["lesser"]),
    ("LGPL-3.0", "Lesser ", "3", ["lesser"]), ("AGPL-3.0", "Affero ", "3", ["affero"]),
]

PERMIT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions:"
)
REST_MIT = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
PERMIT_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
REST_ISC = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
REDISTRIBUTE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
ENDORSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
UNENCUMBERED = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
    "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means."
)

# Headers, openings and texts of licences, with words that each must have.
TEXTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ["apache", "2.0", "compliance"]),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
     "REPRODUCTION, AND DISTRIBUTION", ["apache", "2.0", "2004"]),
    ("MIT", PERMIT_MIT, ["permission", "sublicense", "furnished"]),
    ("MIT", PERMIT_MIT + " " + REST_MIT, ["permission", "sublicense", "noninfringement"]),
    ("ISC", PERMIT_ISC, ["permission", "fee", "appear"]),
    ("ISC", PERMIT_ISC + " " + REST_ISC, ["permission", "fee", "appear", "tortious"]),
    ("0BSD", PERMIT_ISC.split(", provided")[0] + ". " + REST_ISC, ["permission", "fee", "tortious"]),
    ("BSD-2-Clause", REDISTRIBUTE, ["redistribution", "redistributions", "binary", "retain"]),
    ("BSD-3-Clause", REDISTRIBUTE + " " + ENDORSE, ["redistribution", "redistributions", "endorse"]),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", ["mozilla", "2.0"]),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at https://www.eclipse.org/legal/epl-2.0/", ["eclipse", "2.0", "accompanying"]),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
     "work.", ["waived", "neighboring"]),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal", ["cc0", "1.0"]),
    ("Unlicense", UNENCUMBERED, ["unencumbered", "domain"]),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ["gnu", "general", "2", "1991"]),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["gnu", "general", "3", "2007"]),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", ["gnu", "lesser", "2.1", "1999"]),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["gnu", "lesser", "3", "2007"]),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ["gnu", "affero", "3", "2007"]),
]


def templates() -> list[Template]:
    """All templates; of the same words for one licence only one."""
    found: dict[tuple, Template] = {}

    def add(licence: str, text: str, named: list[str]) -> None:
        own = words_of(text)
        found.setdefault((licence, *own), Template(licence, own, sorted(set(named))))

    for licence, names in CALLED.items():
        add(licence, f"SPDX-License-Identifier: {licence}", ["spdx", *words_of(licence)])
        for name in names:
            telling = [w for w in words_of(name) if w not in GENERIC]
            for form in FORMS:
                add(licence, f"{form} {name}", telling + words_of(form)[:1])
            if len(words_of(name)) >= BARE_WORDS and "license" in words_of(name) and len(telling) > 1:
                add(licence, name, [*telling, "license"])
    for licence, kind, version, extra in GNU:
        named = ["gnu", "general", "redistribute", "foundation", version, *extra]
        add(licence, FREE_SOFTWARE.format("This program", ":", kind, ",", version), named)
    for licence, text, named in TEXTS:
        add(licence, text, named)
    return list(found.values())
