"""Known licence texts and declarations. Public texts, without their copyright lines.

The long texts are files of ``license_bodies``, in the line breaks in which they are published.
"""

from importlib import resources

TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
}

#: Declarations of one line.
DECLARATIONS = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}

#: Titles that files put above the texts.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT License (Expat)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License", "BSD License"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}

#: Names in declarations; the first one is the SPDX name. Case and punctuation don't count.
NAMES = {
    "MIT": ["MIT", "MIT License", "Expat License", "MIT/X11 License"],
    "ISC": ["ISC", "ISC License"],
    "0BSD": ["0BSD", "0BSD License", "BSD Zero Clause License", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD-3-Clause", "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["BSL-1.0", "Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "Zlib": ["Zlib", "zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "Apache-2.0": ["Apache-2.0", "Apache 2.0 License", "Apache License 2.0", "Apache License v2.0", "Apache License, Version 2.0", "Apache Software License 2.0"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPLv2", "GNU GPLv2", "GNU GPL v2", "GNU General Public License v2.0", "GNU General Public License, version 2"],
    "GPL-2.0-or-later": ["GPL-2.0-or-later", "GNU General Public License, version 2 or later", "GNU General Public License v2.0 or later"],
    "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPLv3", "GNU GPLv3", "GNU GPL v3", "GNU General Public License v3.0", "GNU General Public License, version 3"],
    "GPL-3.0-or-later": ["GPL-3.0-or-later", "GNU General Public License, version 3 or later", "GNU General Public License v3.0 or later"],
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPLv3", "GNU AGPLv3", "GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3"],
    "AGPL-3.0-or-later": ["AGPL-3.0-or-later", "GNU Affero General Public License, version 3 or later"],
    "LGPL-2.1": ["LGPL-2.1", "LGPL-2.1-only", "LGPLv2.1", "GNU LGPLv2.1", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1"],
    "LGPL-2.1-or-later": ["LGPL-2.1-or-later", "GNU Lesser General Public License, version 2.1 or later"],
    "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPLv3", "GNU LGPLv3", "GNU Lesser General Public License v3.0", "GNU Lesser General Public License, version 3"],
    "LGPL-3.0-or-later": ["LGPL-3.0-or-later", "GNU Lesser General Public License, version 3 or later"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "Mozilla Public License, version 2.0"],
    "EPL-2.0": ["EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "CC0-1.0": ["CC0-1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
}
for _code, _words in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _version, _area in (("4.0", "International"), ("3.0", "Unported")):
        _long = f"Creative Commons {_words} {_version}"
        NAMES[f"CC-{_code}-{_version}"] = [f"CC-{_code}-{_version}", f"CC-{_code}-{_version} License", _long, f"{_long} License", f"{_long} {_area} License"]

#: What stands before a name in a line that declares a licence.
_SUBJECTS = ["", "This project is ", "This software is ", "This work is ", "This code is ", "This program is ", "This library is "]
_WORDINGS = [f"{s}{verb} under {under}" for s in _SUBJECTS for verb in ("licensed", "released", "distributed") for under in ("", "the ", "the terms of the ")]
_WORDINGS += ["License: ", "Licensed under a ", "This work is licensed under a "]


def _long_forms(text: str) -> list[str]:
    """The text, the text without its instructions for use, and without its title of the first paragraph."""
    terms = text.split("END OF TERMS AND CONDITIONS")[0]
    untitled = text.strip().partition("\n\n")[2]
    return [text, *([terms, f"{terms}END OF TERMS AND CONDITIONS"] if terms != text else []), untitled]


def _forms() -> dict[str, str]:
    """Declarations of one line, texts below their titles, lists without numbers, and the long texts."""
    out = {f"{wording}{name}.": code for code, names in NAMES.items() for name in names for wording in _WORDINGS}
    out |= {f"SPDX-License-Identifier: {name}": code for code, names in NAMES.items() for name in names if " " not in name}
    # lines of the usual notices that name the licence without a break
    out['Licensed under the Apache License, Version 2.0 (the "License");'] = "Apache-2.0"
    out['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'] = "Apache-2.0"
    out["License, v. 2.0. If a copy of the MPL was not distributed with this"] = "MPL-2.0"
    for code, titles in TITLES.items():
        bullets = TEXTS[code]
        for number in "123":
            bullets = bullets.replace(f"\n{number}. ", "\n* ")
        for text in dict.fromkeys([TEXTS[code], bullets]):
            out |= {text: code} if text != TEXTS[code] else {}
            out |= {f"{title}\n\n{text}": code for title in titles}
    for file in sorted((resources.files(__package__) / "license_bodies").iterdir(), key=lambda f: f.name):
        out |= {form: file.name.removesuffix(".txt") for form in _long_forms(file.read_text(encoding="utf-8"))}
    return out


#: Other forms of known licences.
DECLARATIONS = DECLARATIONS | _forms()

#: Words that mean the same in a licence, each with the spelling it is replaced by.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "http": "https",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
