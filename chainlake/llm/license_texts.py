"""License notices that scans look for. The wording of public license notices."""

TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

#: What op8_license_scans looks for besides.
MORE = {
    # further one-line notices; at 0.8 of the shingles a short line allows no other wording, so each wording is a template
    "mit-licensed-line": "Licensed under the MIT License.",
    "mit-distributed-line": "Distributed under the MIT License.",
    "mit-project-line": "This project is licensed under the MIT License.",
    "apache-2.0-short-line": "Licensed under the Apache License 2.0.",
    "gpl-3.0-short-line": "Licensed under the GPL v3.",
    "gpl-2.0-short-line": "Licensed under the GPL v2.",
    "lgpl-line": "Licensed under the GNU Lesser General Public License.",
    "agpl-line": "Licensed under the GNU Affero General Public License.",
    "bsd-line": "Licensed under the BSD License.",
    "bsd-3-clause-line": "Licensed under the BSD 3-Clause License.",
    "bsd-2-clause-line": "Licensed under the BSD 2-Clause License.",
    "bsd-style-line": "This source code is governed by a BSD-style license that can be found",
    # the number is one shingle in four, so another version is another notice
    "gpl-2.0-line": "GNU General Public License, version 2",
    "gpl-3.0-short-phrase": "GNU General Public License, version 3",
    "gpl-2.0-v2-line": "GNU General Public License v2",
    "gpl-3.0-v3-line": "GNU General Public License v3",
    "isc-line": "Licensed under the ISC License.",
    "cc0-line": "Released under CC0 1.0 Universal.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-sa-4.0": "Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4.0": "Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-sa-4.0": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nd-4.0": "Attribution-NoDerivatives 4.0 International License",
    # longer notices and disclaimers
    "mit-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}
#: SPDX ids as source files name them; "-only" and "-or-later" are found by the id without them.
MORE |= {
    f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}"
    for x in (
        "MIT Apache-2.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 EPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 Unlicense"
    ).split()
}
ALL = TEMPLATES | MORE
