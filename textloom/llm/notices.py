"""Whole licence notices and texts, for license_scan: names that its short notices lack, and texts of any layout."""

from __future__ import annotations

_PERMIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."


def _gnu(thing: str, name: str, version: str) -> str:
    return f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


def _only(name: str, version: str) -> str:
    return f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} version {version} as published by the Free Software Foundation."


_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."

#: Texts compared with windows of their own size, however they are wrapped, commented or punctuated.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    ],
    "MIT": [_PERMIT, f"{_PERMIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"],
    "BSD-2-Clause": [f"{_BSD} {_BSD_AS_IS}"],
    "BSD-3-Clause": [f"{_BSD} {_BSD_3} {_BSD_AS_IS}", f"{_BSD} {_BSD_3}"],
    "GPL-2.0": [_gnu("program", "General Public License", "2"), _only("General Public License", "2"), f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA {_VERBATIM}"],
    "GPL-3.0": [_gnu("program", "General Public License", "3"), _only("General Public License", "3"), f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ {_VERBATIM}"],
    "LGPL-2.1": [_gnu("library", "Lesser General Public License", "2.1"), f"GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA {_VERBATIM}"],
    "LGPL-3.0": [_gnu("library", "Lesser General Public License", "3"), f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ {_VERBATIM}"],
    "AGPL-3.0": [_gnu("program", "Affero General Public License", "3"), f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ {_VERBATIM}"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}
#: One sentence each: what licenses without a short notice are called; a sentence nearer to one of these is not of another license.
RIVALS = {
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3"],
    "LGPL-2.1": ["This library is licensed under the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3"],
    "ISC": ["Released under the ISC License", "Licensed under the ISC License"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License", "Licensed under the BSD 2-Clause License"],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1"],
    "MPL-1.1": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1"],
    "CC-BY-3.0": ["Licensed under CC BY 3.0", "This work is licensed under a Creative Commons Attribution 3.0 International License"],
    "CC-BY-SA-3.0": ["Licensed under CC BY-SA 3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 International License"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
