"""Names, notices and texts of public licences."""

# The names by which statements call a licence.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License version 3"],
    "Apache-2.0": ["Apache License version 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0",
                        "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0",
                        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "GPL-2.0": ["GNU General Public License version 2"],
    "GPL-3.0": ["GNU General Public License version 3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License version 3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License version 2.0"],
    "Unlicense": ["Unlicense"],
}

# The forms of statements.
FORMS = ["licensed under the {}", "released under the {}", "subject to the terms of the {}"]
SPDX = "SPDX-License-Identifier: {}"

_GNU_NOTICE = ("{} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as "
               "published by the Free Software Foundation{} either version {} of the License, or (at your option) any "
               "later version.")
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Standard notices, whole short texts, and the opening of the long ones.
TEXTS = {
    "AGPL-3.0": [_GNU_NOTICE.format("This program", ":", "Affero General Public License", ",", "3"),
                 "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": ["""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
                   """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR
USE, REPRODUCTION, AND DISTRIBUTION"""],
    "BSD-2-Clause": [_BSD.format("")],
    "BSD-3-Clause": [_BSD.format("""3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission. """)],
    "GPL-2.0": [_GNU_NOTICE.format("This program", ";", "General Public License", ";", "2"),
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": [_GNU_NOTICE.format("This program", ":", "General Public License", ",", "3"),
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "ISC": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""],
    "LGPL-2.1": [_GNU_NOTICE.format("This library", ";", "Lesser General Public License", ";", "2.1"),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": [_GNU_NOTICE.format("This program", ":", "Lesser General Public License", ",", "3"),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""],
    "MPL-2.0": ["""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
                """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity
that creates, contributes to the creation of, or owns Covered Software."""],
    "Unlicense": ["""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""],
}

#: what holds where no licence is granted: counts only in texts without one
RESERVED = {"Proprietary": ["All rights reserved."]}


def templates() -> dict[str, list[str]]:
    """Licence -> its texts, its statements in every form, its SPDX line and, for
    texts without any licence, the reservation of rights."""
    out = {name: [form.format(call) for call in calls for form in FORMS] + [SPDX.format(name)] + TEXTS.get(name, [])
           for name, calls in NAMES.items()}
    return out | RESERVED
