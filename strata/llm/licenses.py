"""Catalogue of the license scan: usual notices of each license and version.

Every notice has at least five words, the width of a shingle.  Names with a
version are granted by any of ``GRANTS``; ``TEXTS`` are sentences of license
texts and file headers.
"""

from __future__ import annotations

GRANTS = ("licensed under the", "released under the", "distributed under the", "available under the",
          "under the terms of the", "covered by the", "governed by the", "subject to the")

_NAMES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("MIT License", "MIT/X11 License", "Expat License")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License",
                    "Apache Software License, Version 2.0", "Apache-2.0 License")),
    ("Apache-1.1", ("Apache License, Version 1.1", "Apache License 1.1", "Apache Software License, Version 1.1")),
    ("Apache-1.0", ("Apache License, Version 1.0", "Apache License 1.0", "Apache Software License, Version 1.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause License", "Simplified BSD License",
                      "FreeBSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause License", "New BSD License",
                      "Modified BSD License", "Revised BSD License")),
    ("BSD-4-Clause", ("BSD 4-Clause License", "4-Clause BSD License", "Original BSD License")),
    ("BSD", ("BSD License",)),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License")),
    ("ISC", ("ISC License",)),
    ("Zlib", ("zlib License", "zlib/libpng License")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost License 1.0")),
    ("Unlicense", ("Unlicense License", "The Unlicense")),
    ("WTFPL", ("WTFPL License", "Do What The Fuck You Want To Public License")),
    ("PostgreSQL", ("PostgreSQL License",)),
    ("PSF-2.0", ("Python Software Foundation License", "Python Software Foundation License Version 2")),
    ("OFL-1.1", ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "Open Font License 1.1")),
    ("ODbL-1.0", ("Open Database License", "Open Data Commons Open Database License")),
    ("Artistic-1.0", ("Artistic License 1.0", "Artistic License, Version 1.0")),
    ("Artistic-2.0", ("Artistic License 2.0", "Artistic License, Version 2.0")),
    ("MS-PL", ("Microsoft Public License",)),
    ("MS-RL", ("Microsoft Reciprocal License",)),
    ("CC0-1.0", ("CC0 1.0 Universal", "CC0 1.0 License", "Creative Commons Zero v1.0 Universal",
                 "Creative Commons CC0 1.0 Universal", "CC0 Public Domain Dedication")),
]
for _v in ("1.0", "1.1", "2.0"):
    _NAMES.append((f"MPL-{_v}", tuple(x.format(_v) for x in (
        "Mozilla Public License, version {}", "Mozilla Public License {}", "Mozilla Public License, v. {}",
        "Mozilla Public License v{}", "MPL {}", "MPL version {}"))))
for _v in ("1.0", "2.0"):
    _NAMES.append((f"EPL-{_v}", tuple(x.format(_v) for x in (
        "Eclipse Public License, version {}", "Eclipse Public License {}", "Eclipse Public License - v {}",
        "Eclipse Public License v{}", "EPL {}"))))
for _v in ("1.0", "1.1"):
    _NAMES.append((f"CDDL-{_v}", tuple(x.format(_v) for x in (
        "Common Development and Distribution License, version {}", "Common Development and Distribution License {}",
        "Common Development and Distribution License (CDDL) version {}", "CDDL {}"))))
for _v in ("1.1", "1.2"):
    _NAMES.append((f"EUPL-{_v}", tuple(x.format(_v) for x in (
        "European Union Public Licence, version {}", "European Union Public Licence {}",
        "European Union Public License, version {}", "European Union Public License {}", "EUPL {}"))))
_GNU = (("GPL", "General", ("1", "2", "3")), ("LGPL", "Lesser General", ("2.1", "3")),
        ("LGPL", "Library General", ("2",)), ("AGPL", "Affero General", ("3",)))
for _short, _middle, _versions in _GNU:
    for _v in _versions:
        _full = _v if "." in _v else f"{_v}.0"
        _forms = [f"GNU {_middle} Public License{x}" for x in (
            f", version {_v}", f" v{_v}", f" {_v}", f", version {_full}", f" v{_full}", f" {_full}")]
        _forms += [f"{a}{_short}{x}" for a in ("", "GNU ") for x in (
            f" version {_v}", f" v{_v}", f" {_v}", f" {_full}", f"v{_v} license", f"-{_full} license")]
        _NAMES.append((f"{_short}-{_full}", tuple(dict.fromkeys(_forms))))

_CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))

TEXTS: list[tuple[str, str]] = [
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior "
                     "written permission"),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the "
                     "following acknowledgement"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software"),
    ("BSL-1.0", "obtaining a copy of the software and accompanying documentation covered by this license (the "
                "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("GPL-2.0", "GNU General Public License version 2 or version 3"),
    ("GPL-3.0", "GNU General Public License version 2 or version 3"),
]
for _short, _middle, _versions in _GNU:
    for _v in _versions:
        _full = _v if "." in _v else f"{_v}.0"
        _head = f"under the terms of the GNU {_middle} Public License as published by the Free Software Foundation"
        TEXTS += [(f"{_short}-{_full}", f"{_head}, {x}") for x in (
            f"either version {_v} of the License", f"version {_v} of the License", f"version {_v}")]


def _cc() -> list[tuple[str, str]]:
    out = []
    for code, name in _CC:
        for version, port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
            own = f"CC-{code}-{version}"
            names = (f"CC {code} {version}", f"CC-{code} {version} license", f"CC-{code}-{version} license",
                     f"Creative Commons {name} {version}")
            grants = ("licensed under", "released under", "distributed under", "available under", "shared under")
            out += [(own, f"{g} {a}{n}") for g in grants for a in ("", "a ", "the ") for n in names]
            out.append((own, f"Creative Commons {name} {version} {port} License"))
    return out


def notices() -> list[tuple[str, str]]:
    """(license, notice); notices under five words, which have no shingle, are left out."""
    named = [(own, f"{grant} {name}") for own, names in _NAMES for name in names for grant in GRANTS]
    return [(own, text) for own, text in TEXTS + named + _cc() if len(text.replace(" - ", " ").split()) >= 5]


#: Identifiers that may follow ``SPDX-License-Identifier:``, beside those of the notices.
SPDX = (
    "AFL-3.0", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "APSL-2.0", "BlueOak-1.0.0", "BUSL-1.1", "CC-PDDC",
    "CECILL-2.1", "CPL-1.0", "ECL-2.0", "GFDL-1.3", "GFDL-1.3-only", "GFDL-1.3-or-later", "GPL-1.0-only",
    "GPL-1.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "HPND", "IPL-1.0",
    "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "LPPL-1.3c", "MIT-0", "MulanPSL-2.0", "NCSA", "ODC-By-1.0", "OpenSSL", "OSL-3.0", "PDDL-1.0", "PHP-3.01",
    "Python-2.0", "QPL-1.0", "Ruby", "SSPL-1.0", "UPL-1.0", "Vim", "W3C", "X11", "Zend-2.0", "ZPL-2.1")
