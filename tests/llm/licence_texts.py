"""Standard licence notices, and the one licence that each is."""

from __future__ import annotations

MIT = '''MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE.
'''
APACHE = '''Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
BSD_TAIL = '''
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
'''
BSD2 = '''BSD 2-Clause License

Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
''' + BSD_TAIL
BSD3 = BSD2.replace("BSD 2-Clause License", "").replace(BSD_TAIL, '''
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
''' + BSD_TAIL)
BSD4 = BSD2.replace("BSD 2-Clause License", "").replace(BSD_TAIL, '''
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the organization.

4. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
''' + BSD_TAIL)
ISC = '''ISC License

Copyright (c) 2020, Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
'''
ZLIB = '''zlib License

(C) 2020 Jane Doe

This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
'''
BOOST = '''Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:

The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and
all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT
SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE
FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
'''
UNLICENSE = '''This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM.

For more information, please refer to <https://unlicense.org>
'''
GPL3 = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
'''
GPL2ONLY = '''This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; version 2 of the License.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
'''
LGPL = GPL3.replace("This program", "This library").replace("General Public", "Lesser General Public").replace("version 3 of", "version 2.1 of")
AGPL = GPL3.replace("General Public", "Affero General Public")
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''
EPL = '''All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v2.0
which accompanies this distribution, and is available at
https://www.eclipse.org/legal/epl-2.0/
'''
CDDL = '''The contents of this file are subject to the terms of the Common Development
and Distribution License (the "License"). You may not use this file except in compliance
with the License.
'''
PERL = "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself.\n"
CCBYSA = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.\n"
POSTGRES = '''Permission to use, copy, modify, and distribute this software and its
documentation for any purpose, without fee, and without a written agreement is
hereby granted, provided that the above copyright notice and this paragraph and
the following two paragraphs appear in all copies.

IN NO EVENT SHALL THE UNIVERSITY BE LIABLE TO ANY PARTY FOR DIRECT DAMAGES.
'''
OFL = 'This Font Software is licensed under the SIL Open Font License, Version 1.1.\n'
ZEROBSD = ISC.replace("ISC License", "").replace(''', provided that the above
copyright notice and this permission notice appear in all copies.''', ".")
#: The text, and the licences found in it.
EXPECTED = {
    "MIT": (MIT, "MIT"),
    "APACHE": (APACHE, "Apache-2.0"),
    "BSD2": (BSD2, "BSD-2-Clause"),
    "BSD3": (BSD3, "BSD-3-Clause"),
    "BSD4": (BSD4, "BSD-4-Clause"),
    "ISC": (ISC, "ISC"),
    "ZLIB": (ZLIB, "Zlib"),
    "BOOST": (BOOST, "BSL-1.0"),
    "UNLICENSE": (UNLICENSE, "Unlicense"),
    "GPL3": (GPL3, "GPL-3.0-or-later"),
    "GPL2ONLY": (GPL2ONLY, "GPL-2.0-only"),
    "LGPL": (LGPL, "LGPL-2.1-or-later"),
    "AGPL": (AGPL, "AGPL-3.0-or-later"),
    "MPL": (MPL, "MPL-2.0"),
    "EPL": (EPL, "EPL-2.0"),
    "CDDL": (CDDL, "CDDL-1.0"),
    "PERL": (PERL, "Artistic-1.0-Perl,GPL-1.0-or-later"),
    "CCBYSA": (CCBYSA, "CC-BY-SA-4.0"),
    "POSTGRES": (POSTGRES, "PostgreSQL"),
    "OFL": (OFL, "OFL-1.1"),
    "ZEROBSD": (ZEROBSD, "0BSD"),
}
REFERENCES = {
    'Licensed under the MIT License and comes with no support.': 'MIT',
    'Released under the MIT License.': 'MIT',
    'This code is dual-licensed under the MIT License or the Apache License, Version 2.0.': "Apache-2.0,MIT",
    'SPDX-License-Identifier: MIT': 'MIT',
    '// SPDX-License-Identifier: (GPL-2.0-only OR bsd-3-clause)': 'GPL-2.0-only,BSD-3-Clause',
    '# SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0': 'GPL-2.0-or-later,Classpath-exception-2.0',
    'Distributed under the BSD 3-Clause license.': 'BSD-3-Clause',
    'Released under the GNU General Public License, version 3 or later.': 'GPL-3.0-or-later',
    'Distributed under the Boost Software License, Version 1.0.': 'BSL-1.0',
    'License: MIT': 'MIT',
    'Licensed under the EUPL, Version 1.2.': 'EUPL-1.2',
    'This file is released under the GPLv2.': 'GPL-2.0-only',
    'Available under the terms of the Artistic License 2.0.': 'Artistic-2.0',
    'Licensed under CC BY-NC 4.0.': 'CC-BY-NC-4.0',
    'Licensed under the zlib license.': 'Zlib',
    'The software is licensed under the LGPL v2.1+': 'LGPL-2.1-or-later',
    'I like a licence plate.': '',
    'This work is licensed under the GNU General Public License, version 3.': 'GPL-3.0-only',
    'released under the academic free license version 3.0': 'AFL-3.0',
    'Provided under the WTFPL.': 'WTFPL',
    'Licensed under the Microsoft Public License (MS-PL).': 'MS-PL',
}
