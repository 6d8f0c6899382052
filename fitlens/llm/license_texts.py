"""Known licences: whole texts, short notices and identifiers."""

from __future__ import annotations

# Licence, category, full name as notices spell it (with common variants).
NAMES = (
    ("MIT", "permissive", ("MIT License", "Expat License")),
    ("Apache-2.0", "permissive", ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License", "Apache 2.0 License")),
    ("BSD-2-Clause", "permissive", ("BSD 2-Clause License", "Simplified BSD License")),
    ("BSD-3-Clause", "permissive", ("BSD 3-Clause License", "New BSD License", "BSD License")),
    ("ISC", "permissive", ("ISC License",)),
    ("Zlib", "permissive", ("zlib License",)),
    ("BSL-1.0", "permissive", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("CC0-1.0", "public domain", ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0")),
    ("Unlicense", "public domain", ("Unlicense",)),
    ("CC-BY-4.0", "attribution", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-SA-4.0", "share alike", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-NC-4.0", "non-commercial", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-ND-4.0", "no derivatives", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License")),
    ("MPL-2.0", "weak copyleft", ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0")),
    ("LGPL-3.0", "weak copyleft", ("GNU Lesser General Public License, version 3", "GNU LGPL v3")),
    ("GPL-2.0", "copyleft", ("GNU General Public License, version 2", "GNU GPL v2")),
    ("GPL-3.0", "copyleft", ("GNU General Public License, version 3", "GNU GPL v3", "GNU General Public License v3.0")),
    ("AGPL-3.0", "network copyleft", ("GNU Affero General Public License, version 3", "GNU AGPL v3")),
)

# Sentences around a name.
NOTICES = (
    "{}",
    "The {}",
    "Released under {}",
    "Released under the {}",
    "Licensed under {}",
    "Licensed under the {}",
    "Distributed under the {}",
    "Available under the {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This work is licensed under a {}",
    "This software is licensed under the {}",
    "This project is licensed under the {}",
    "This file is licensed under the {}",
    "This program is free software, released under the {}",
)

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

BSD_3_CLAUSE = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
"""


def _licenses() -> list[tuple[str, str, str, str]]:
    """``(license, category, form, text)``; form: full, notice or identifier."""
    rows = [
        ("MIT", "permissive", "full", MIT),
        ("MIT", "permissive", "full", "MIT License\n\n" + MIT),
        ("MIT", "permissive", "full", "The MIT License (MIT)\n\n" + MIT),
        ("ISC", "permissive", "full", ISC),
        ("ISC", "permissive", "full", "ISC License\n\n" + ISC),
        ("BSD-2-Clause", "permissive", "full", BSD_2.format("")),
        ("BSD-2-Clause", "permissive", "full", "BSD 2-Clause License\n\n" + BSD_2.format("")),
        ("BSD-3-Clause", "permissive", "full", BSD_2.format(BSD_3_CLAUSE)),
        ("BSD-3-Clause", "permissive", "full", "BSD 3-Clause License\n\n" + BSD_2.format(BSD_3_CLAUSE)),
    ]
    for license, category, names in NAMES:
        rows += [(license, category, "notice", notice.format(name)) for name in names for notice in NOTICES]
        rows += [(license, category, "identifier", f"SPDX-License-Identifier: {license}{end}") for end in ("", "-only", "-or-later")]
    return rows


LICENSES = _licenses()

# Digests of the canonical form of longer whole texts (``licenses.digest``), licence, category and form.
DIGESTS = (
    ("93651fc3b3c9c21033cf07999bdb593e0138192678d4743ddf7ee126fefab052", "Apache-2.0", "permissive", "full"),  # whole
    ("f92c423b6d6da66caa78abd6f49f73f5bc8715dca82e1a73f62d1e6eec41986c", "Apache-2.0", "permissive", "full"),  # whole, owner filled in
    ("09ad3868555dada25cbf24199409a8c1e39fe8ef08d164adc6e98c1d02767793", "Apache-2.0", "permissive", "full"),  # without appendix
    ("0c625737207ff21211498d94941901de5bca68c965547007c169a1e718b97f16", "Apache-2.0", "permissive", "full"),  # without appendix and its last line
    ("ae2be2aaa68f5e52ef402874fc8c7c691879b445cb12e49d84f88168cc2d7dd6", "GPL-2.0", "copyleft", "full"),  # whole
    ("a76cc6ce70778ba70e43b9b1838f9e3f88b3fc7c5acbb3b8a9847918003b63e0", "GPL-2.0", "copyleft", "full"),  # without appendix
    ("42b67f6c2a10d2b6cb4c48a2c1a454953ad6d664174e0493c9d92e45feb4b408", "GPL-3.0", "copyleft", "full"),  # whole
    ("158302bba42ffffd9ebd468b95aca480c990d662430ac44bb2edba378ebeb545", "GPL-3.0", "copyleft", "full"),  # without appendix
    ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "LGPL-3.0", "weak copyleft", "full"),  # whole
    ("383594bdce0c728972216e9a2472728e1ce0ac4e0e983e80b237c67270d2ef1f", "MPL-2.0", "weak copyleft", "full"),  # whole
    ("ddc30b039f06049de7ab47bfa10e7fd5d6018abf24dfe5616ddc0274b0710943", "MPL-2.0", "weak copyleft", "full"),  # without exhibits
    ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "CC0-1.0", "public domain", "full"),  # whole
    ("a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32", "CC0-1.0", "public domain", "full"),  # without first line
    ("e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229", "Unlicense", "public domain", "full"),  # whole
    ("1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7", "Zlib", "permissive", "full"),  # whole
    ("99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a", "Zlib", "permissive", "full"),  # with its name
)
