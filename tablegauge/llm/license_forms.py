"""Titles, SPDX identifiers, standard headers and full texts of licences, as
rows ``license, kind, text``: kind ``text`` for a full text, else ``notice``.

Names without a version (``GPL``, ``BSD``, ...) are what a notice says that
gives none.  The full texts lie in ``license_texts``; that of AGPL-3.0 is
derived from the GPL's, and those of the CC BY licences are not held.
"""

from __future__ import annotations

import re
from pathlib import Path

_TEXTS = Path(__file__).with_name("license_texts")
_GNU = {"GPL": ("GNU General Public License", ["1.0", "2.0", "3.0"]), "LGPL": ("GNU Lesser General Public License", ["2.1", "3.0"]),
        "AGPL": ("GNU Affero General Public License", ["3.0"])}
_CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike"}


def _notices() -> list[tuple[str, str]]:
    out = [("MIT", x) for x in ("MIT License", "The MIT License", "The MIT License (MIT)", "Licensed under the MIT license", "License: MIT")]
    out += [("BSD-3-Clause", x) for x in ("BSD 3-Clause License", "The BSD 3-Clause License", '3-Clause BSD License', 'BSD 3-Clause "New" or "Revised" License')]
    out += [("BSD-2-Clause", x) for x in ("BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License", 'BSD 2-Clause "Simplified" License')]
    out += [("BSD", "BSD License"), ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.")]
    out += [("Apache", "Apache License"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache License Version 2.0, January 2004"),
            ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
                           "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
            ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
                           "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You "
                           'under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                           "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")]
    for v in ("1.1", "2.0"):
        out += [(f"MPL-{v}", x) for x in (f"Mozilla Public License Version {v}", f"Mozilla Public License, v. {v}")]
    out += [("MPL", "Mozilla Public License"),
            ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")]
    out += [("CC0-1.0", x) for x in ("CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal",
                                     "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication")]
    for short, long in _CC.items():
        out += [(f"CC-{short}-4.0", x) for x in (f"{long} 4.0 International", f"Creative Commons {long} 4.0 International Public License",
                                                f"This work is licensed under a Creative Commons {long} 4.0 International License.")]
    for short, (long, versions) in _GNU.items():
        out.append((short, long))
        for v in versions + (["2.0"] if short == "LGPL" else []):
            name, n = f"{short}-{v}", v.removesuffix(".0")
            full = "GNU Library General Public License" if name == "LGPL-2.0" else long
            out += [(name, f"{full} version {n}"), (name, f"{full} v{n}"), (name, f"{short}v{n} license"), (name, f"License: {short}-{v}"),
                    (name, f"This program is free software; you can redistribute it and/or modify it under the terms of the {full} as published by "
                           f"the Free Software Foundation; either version {n} of the License, or (at your option) any later version."),
                    (name, f"under the terms of the {full} as published by the Free Software Foundation, version {n}")]
            out += [(name, f"SPDX-License-Identifier: {name}-{x}") for x in ("only", "or-later")]
    texts = {p.stem: p.read_text("utf-8") for p in _TEXTS.glob("*.txt")}
    parts = lambda name: re.split(r"\n\s*\n", texts[name])
    out += [("MIT", x) for x in parts("MIT") if x.startswith("Permission is hereby granted")]
    out += [("BSD-3-Clause", x[x.index("3. Neither"):]) for x in parts("BSD-3-Clause") if "3. Neither" in x]
    names = {n for n, _ in out} - {"BSD", "Apache", "MPL", "GPL", "LGPL", "AGPL"}
    return out + [(n, f"SPDX-License-Identifier: {n}") for n in sorted(names)]


def forms() -> list[tuple[str, str, str]]:
    texts = {p.stem: p.read_text("utf-8") for p in sorted(_TEXTS.glob("*.txt"))}
    long = re.compile(r"GNU(\s+)General(\s+)Public", re.I)
    texts["AGPL-3.0"] = long.sub(r"GNU Affero\1General\2Public", texts["GPL-3.0"])
    return [(n, "notice", t) for n, t in _notices()] + [(n, "text", t) for n, t in texts.items()]
