"""The registered license templates: (license, text). Templates with one license are alternatives.

``TEMPLATES`` holds notices and the telling part of the standard headers, ``SHORT`` the notices of
one to four words, ``license_texts`` the licenses in full (one file each, named by its SPDX id).
Where wordings differ in one word (a version, "Lesser", "NonCommercial"), the template is kept so
short that this word is in more than a fifth of its five-word shingles.
"""

from __future__ import annotations

from importlib.resources import files
from itertools import product

#: Notices of five words and more.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "under the terms of the MIT License"),
    ("Apache-2.0", "under the Apache License, Version 2.0"),
    ("Apache-2.0", "under the terms of the Apache License 2.0"),
    ("Apache-2.0", "www.apache.org/licenses/LICENSE-2.0"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial "
             "applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("EPL-1.0", "Eclipse Public License v1.0"),
    ("EPL-1.0", "under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License v. 2.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("EUPL-1.2", "European Union Public Licence v. 1.2"),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2"),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("Artistic-2.0", "under the terms of the Artistic License 2.0"),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
    ("GFDL", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
             "Documentation License"),
    ("CC0-1.0", "creativecommons.org/publicdomain/zero/1.0"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work"),
    ("Public-domain", "This work is in the public domain"),
    ("Public-domain", "released into the public domain by"),
    ("Public-domain", "has been placed in the public domain"),
]

#: Notices of one to four words, found as whole sequences.
SHORT = [
    ("All-rights-reserved", "All rights reserved."),
    ("MIT", "MIT License"), ("MIT", "MIT licensed"), ("MIT", "License: MIT"),
    ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache-2.0 License"), ("Apache-2.0", "License: Apache-2.0"),
    ("BSD", "BSD License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-2-Clause", "2-Clause BSD License"),
    ("BSD-2-Clause", "Simplified BSD License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "3-Clause BSD License"), ("BSD-3-Clause", "New BSD License"),
    ("ISC", "ISC License"), ("Zlib", "zlib License"), ("Unlicense", "The Unlicense"), ("Unlicense", "unlicense.org"),
    ("BSL-1.0", "Boost Software License"), ("0BSD", "Zero-Clause BSD"), ("WTFPL", "under the WTFPL"),
    ("CC0-1.0", "CC0 1.0 Universal"), ("CC0-1.0", "under CC0 1.0"), ("OFL-1.1", "SIL Open Font License"),
]

#: SPDX ids looked for behind "SPDX-License-Identifier:".
_SPDX = [
    "MIT", "ISC", "Zlib", "Unlicense", "0BSD", "WTFPL", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
    "BSL-1.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-1.1", "MPL-2.0",
    "CC0-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "Artistic-1.0", "Artistic-2.0", "OFL-1.1", "CDDL-1.0", "CDDL-1.1",
    "PSF-2.0", "Python-2.0", "GFDL-1.2", "GFDL-1.3",
]
_GNU = {"GPL": ("", ["1", "2", "3"]), "LGPL": ("Lesser ", ["2.1", "3"]), "AGPL": ("Affero ", ["3"])}
_CC_KINDS = {
    "BY": "Attribution", "BY-SA": "Attribution ShareAlike", "BY-NC": "Attribution NonCommercial",
    "BY-ND": "Attribution NoDerivatives", "BY-NC-SA": "Attribution NonCommercial ShareAlike",
    "BY-NC-ND": "Attribution NonCommercial NoDerivatives",
}
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def _gnu() -> list[tuple[str, str]]:
    made = []
    for name, (kind, versions) in _GNU.items():
        own = f"GNU {kind}General Public License"
        for v in versions:
            spdx = f"{name}-{v}" if "." in v else f"{name}-{v}.0"
            made += [(spdx, t) for t in (
                f"under the terms of the {own} as published by the Free Software Foundation; either version {v} of the "
                "License",
                f"under the terms of the {own} as published by the Free Software Foundation; version {v} of the License",
                f"{own} version {v}", f"{own} v{v}", f"www.gnu.org/licenses/{spdx}.html",
                f"{name}v{v}", f"{name} v{v}", f"{name} version {v}", f"License: {spdx}", f"{spdx} License")]
    library = "GNU Library General Public License as published by the Free Software Foundation"
    return [*made, ("LGPL-2.0", f"under the terms of the {library}; either version 2 of the License")]


def _creative_commons() -> list[tuple[str, str]]:
    made = []
    for (short, full), v in product(_CC_KINDS.items(), _CC_VERSIONS):
        spaced = full.replace("ShareAlike", "Share Alike").replace("NonCommercial", "Non Commercial").replace(
            "NoDerivatives", "No Derivatives")
        older = full.replace("NoDerivatives", "NoDerivs")
        texts = {f"Creative Commons {full} {v}", f"Creative Commons {spaced} {v}", f"Creative Commons {older} {v}",
                 f"CC {short} {v}", f"creativecommons.org/licenses/{short}/{v}",
                 f"SPDX-License-Identifier: CC-{short}-{v}"}
        made += [(f"CC-{short}-{v}", t) for t in sorted(texts)]
    return made


def _spdx() -> list[tuple[str, str]]:
    made = [(name, f"SPDX-License-Identifier: {name}") for name in _SPDX]
    for pair in ("MIT OR Apache-2.0", "Apache-2.0 OR MIT"):  # the common choice of two
        made += [(name, f"SPDX-License-Identifier: {pair}") for name in ("MIT", "Apache-2.0")]
    return made


def _words(text: str) -> int:
    from .common import alnum_words

    return len(alnum_words(text))


_MADE = [*_gnu(), *_creative_commons(), *_spdx()]
TEMPLATES += [(n, t) for n, t in _MADE if _words(t) >= 5]
SHORT += [(n, t) for n, t in _MADE if _words(t) < 5]


def full_texts() -> list[tuple[str, str]]:
    """The licenses in full."""
    folder = files(__package__).joinpath("license_texts")
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir())


def registered() -> list[tuple[str, str]]:
    return [*TEMPLATES, *SHORT, *full_texts()]
