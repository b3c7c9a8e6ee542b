"""Hand-written license signatures over normalised words (lower case, one space between words).

A rule is (label, kind, pattern). The kind gives priority and confidence. Patterns see
only words of letters and digits, so ``Apache-2.0`` reads ``apache 2 0``.
"""

from __future__ import annotations

#: kind: (priority, confidence). Lower priority numbers win.
KINDS = {"tag": (1, 1.0), "grant": (2, 0.95), "url": (3, 0.9), "clause": (4, 0.85), "name": (5, 0.7), "base": (6, 0.5),
         "hint": (7, 0.3)}

#: The four phrases whose every place is counted, and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: label | words of the short identifier | name as people write it | words of its address ("" if none)
FAMILIES = """
apache-1.0 | apache 1 0 | apache (?:software )?license (?:version )?1 0 | apache org licenses license 1 0
apache-1.1 | apache 1 1 | apache (?:software )?license (?:version )?1 1 | apache org licenses license 1 1
apache-2.0 | apache 2 0 | apache (?:software )?license (?:version |v)?2(?: 0)? | apache org licenses license 2 0
mit | mit | (?:the )?(?:mit|expat) license | opensource org licenses mit
mit-0 | mit 0 | mit no attribution(?: license)? | opensource org licenses mit 0
bsd-1-clause | bsd 1 clause | (?:1|one) clause bsd(?: license)? | opensource org licenses bsd 1 clause
bsd-2-clause | bsd 2 clause | (?:simplified|2 clause|two clause|freebsd) bsd(?: license)? | opensource org licenses bsd 2 clause
bsd-3-clause | bsd 3 clause | (?:new|modified|revised|3 clause|three clause) bsd(?: license)? | opensource org licenses bsd 3 clause
bsd-4-clause | bsd 4 clause | (?:original|4 clause|four clause) bsd(?: license)? | spdx org licenses bsd 4 clause
0bsd | 0bsd | zero clause bsd(?: license)? | opensource org licenses 0bsd
isc | isc | isc license | opensource org licenses isc
gpl-1.0 | gpl 1 0(?: only| or later)? | gnu general public license (?:version |v)1(?: 0)? | gnu org licenses (?:old licenses )?gpl 1 0
gpl-2.0 | gpl 2 0(?: only| or later)? | gnu general public license (?:version |v)2(?: 0)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | gpl 3 0(?: only| or later)? | gnu general public license (?:version |v)3(?: 0)? | gnu org licenses gpl 3 0
lgpl-2.0 | lgpl 2 0(?: only| or later)? | gnu library general public license (?:version |v)2(?: 0)? | gnu org licenses (?:old licenses )?lgpl 2 0
lgpl-2.1 | lgpl 2 1(?: only| or later)? | gnu lesser general public license (?:version |v)2 1 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | lgpl 3 0(?: only| or later)? | gnu lesser general public license (?:version |v)3(?: 0)? | gnu org licenses lgpl 3 0
agpl-3.0 | agpl 3 0(?: only| or later)? | gnu affero general public license(?: (?:version |v)3(?: 0)?)? | gnu org licenses agpl 3 0
gfdl-1.2 | gfdl 1 2(?: only| or later)? | gnu free documentation license (?:version |v)1 2 | gnu org licenses (?:old licenses )?fdl 1 2
gfdl-1.3 | gfdl 1 3(?: only| or later)? | gnu free documentation license (?:version |v)1 3 | gnu org licenses fdl 1 3
mpl-1.0 | mpl 1 0 | mozilla public license (?:version |v)?1 0 | mozilla org mpl 1 0
mpl-1.1 | mpl 1 1 | mozilla public license (?:version |v)?1 1 | mozilla org mpl 1 1
mpl-2.0 | mpl 2 0 | mozilla public license (?:version |v)?2(?: 0)? | mozilla org mpl 2 0
epl-1.0 | epl 1 0 | eclipse public license (?:version |v)?1 0 | eclipse org legal epl v10
epl-2.0 | epl 2 0 | eclipse public license (?:version |v)?2 0 | eclipse org legal epl 2 0
edl-1.0 | edl 1 0 | eclipse distribution license (?:version |v)?1 0 | eclipse org org documents edl v10
cddl-1.0 | cddl 1 0 | common development and distribution license(?: (?:version |v)?1 0)? | opensource org licenses cddl 1 0
cddl-1.1 | cddl 1 1 | common development and distribution license (?:version |v)?1 1 | spdx org licenses cddl 1 1
cpl-1.0 | cpl 1 0 | common public license(?: (?:version |v)?1 0)? | opensource org licenses cpl1 0
ipl-1.0 | ipl 1 0 | ibm public license(?: (?:version |v)?1 0)? | opensource org licenses ipl 1 0
artistic-1.0 | artistic 1 0(?: perl)? | artistic license (?:version |v)?1 0 | opensource org licenses artistic license 1 0
artistic-2.0 | artistic 2 0 | artistic license (?:version |v)?2 0 | opensource org licenses artistic license 2 0
bsl-1.0 | bsl 1 0 | boost software license(?: (?:version |v)?1 0)? | boost org license 1 0
busl-1.1 | busl 1 1 | business source license(?: (?:version |v)?1 1)? | mariadb com bsl11
zlib | zlib | zlib(?: libpng)? license | opensource org licenses zlib
libpng | libpng(?: 2 0)? | libpng license | libpng org pub png src libpng license
ncsa | ncsa | university of illinois ncsa open source license | opensource org licenses ncsa
unlicense | unlicense | (?:the )?unlicense | unlicense org
wtfpl | wtfpl | do what the f[a-z]{0,3} you want to public license | wtfpl net
cc0-1.0 | cc0 1 0 | creative commons zero(?: (?:version |v)?1 0)?(?: universal)? | creativecommons org publicdomain zero 1 0
cc-by-2.0 | cc by 2 0 | creative commons attribution 2 0(?: generic)? | creativecommons org licenses by 2 0
cc-by-2.5 | cc by 2 5 | creative commons attribution 2 5(?: generic)? | creativecommons org licenses by 2 5
cc-by-3.0 | cc by 3 0 | creative commons attribution 3 0(?: unported)? | creativecommons org licenses by 3 0
cc-by-4.0 | cc by 4 0 | creative commons attribution 4 0(?: international)? | creativecommons org licenses by 4 0
cc-by-sa-2.5 | cc by sa 2 5 | creative commons attribution share ?alike 2 5 | creativecommons org licenses by sa 2 5
cc-by-sa-3.0 | cc by sa 3 0 | creative commons attribution share ?alike 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | cc by sa 4 0 | creative commons attribution share ?alike 4 0 | creativecommons org licenses by sa 4 0
cc-by-nc-3.0 | cc by nc 3 0 | creative commons attribution non ?commercial 3 0 | creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | cc by nc 4 0 | creative commons attribution non ?commercial 4 0 | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | cc by nd 4 0 | creative commons attribution no ?deriv(?:ative)?s 4 0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | creative commons attribution non ?commercial share ?alike 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0 | creativecommons org licenses by nc nd 4 0
eupl-1.1 | eupl 1 1 | european union public licen[cs]e (?:version |v)?1 1 | joinup ec europa eu eupl 1 1
eupl-1.2 | eupl 1 2 | european union public licen[cs]e (?:version |v)?1 2 | joinup ec europa eu eupl 1 2
cecill-2.1 | cecill 2 1 | cecill(?: free software license agreement)? (?:version |v)?2 1 | cecill info licences licence cecill v2 1
cecill-b | cecill b | cecill b(?: free software license agreement)? | cecill info licences licence cecill b
cecill-c | cecill c | cecill c(?: free software license agreement)? | cecill info licences licence cecill c
ofl-1.1 | ofl 1 1 | sil open font license(?: (?:version |v)?1 1)? | scripts sil org ofl
psf-2.0 | psf 2 0 | python software foundation license(?: (?:version |v)?2)? | docs python org license
python-2.0 | python 2 0 | python license(?: (?:version |v)?2 0)? | opensource org licenses python 2 0
php-3.01 | php 3 01 | php license(?: (?:version |v)?3 01)? | php net license 3 01
ruby | ruby | ruby license | ruby lang org license
openssl | openssl | openssl license | openssl org source license
curl | curl | curl license | curl se docs copyright
postgresql | postgresql | postgresql licen[cs]e | postgresql org about licence
ms-pl | ms pl | microsoft public license | opensource org licenses ms pl
ms-rl | ms rl | microsoft reciprocal license | opensource org licenses ms rl
osl-3.0 | osl 3 0 | open software license(?: (?:version |v)?3 0)? | opensource org licenses osl 3 0
afl-3.0 | afl 3 0 | academic free license(?: (?:version |v)?3 0)? | opensource org licenses afl 3 0
upl-1.0 | upl 1 0 | universal permissive license(?: (?:version |v)?1 0)? | opensource org licenses upl
ecl-2.0 | ecl 2 0 | educational community license(?: (?:version |v)?2 0)? | opensource org licenses ecl 2 0
odbl-1.0 | odbl 1 0 | open database license(?: (?:version |v)?1 0)? | opendatacommons org licenses odbl
odc-by-1.0 | odc by 1 0 | open data commons attribution license(?: (?:version |v)?1 0)? | opendatacommons org licenses by
pddl-1.0 | pddl 1 0 | (?:open data commons )?public domain dedication and license | opendatacommons org licenses pddl
sspl-1.0 | sspl 1 0 | server side public license(?: (?:version |v)?1)? | mongodb com licensing server side public license
elastic-2.0 | elastic 2 0 | elastic license(?: (?:version |v)?2 0)? | elastic co licensing elastic license
vim | vim | vim license | vimhelp org uganda
x11 | x11 | x11 license | spdx org licenses x11
"""

#: Sentences of license texts: label | pattern
CLAUSES = """
mit | permission is hereby granted free of charge to any person obtaining a copy
mit | the above copyright notice and this permission notice shall be included in all
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions of source code must retain the above copyright notice
bsd | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | neither the name of .{1,120}? nor the names of its contributors may be used to endorse
bsd-4-clause | all advertising materials mentioning features or use of this software must display
apache-2.0 | licensed under the apache license version 2 0 the license
apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license
gpl | this program is free software you can redistribute it and or modify it
gpl | you should have received a copy of the gnu general public license
gpl | under the terms of the gnu general public license as published by the free software foundation
gpl-or-later | either version [23] of the license or at your option any later version
lgpl | you should have received a copy of the gnu lesser general public license
lgpl | you should have received a copy of the gnu library general public license
agpl-3.0 | you should have received a copy of the gnu affero general public license
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
epl-1.0 | all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
cddl | the contents of this file are subject to the terms of the common development and distribution license
zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | altered source versions must be plainly marked as such
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
bsl-1.0 | distributed under the boost software license version 1 0
unlicense | this is free and unencumbered software released into the public domain
cc0-1.0 | to the extent possible under law .{1,120}? has waived all copyright
public-domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
ofl-1.1 | this font software is licensed under the sil open font license
psf-2.0 | this license agreement is between the python software foundation
artistic | the intent of this document is to state the conditions under which a package may be copied
proprietary | all rights reserved (?:unauthorized|no part of this)
proprietary | unauthorized (?:copying|reproduction|use) of this (?:file|software|work)
proprietary | confidential and proprietary
proprietary | proprietary and confidential
proprietary | no part of this (?:publication|book|work) may be reproduced
warranty | without warranty of any kind express or implied
warranty | provided as is without warranty
warranty | without even the implied warranty of merchantability or fitness for a particular purpose
"""

#: Weak signs: label | pattern
HINTS = """
creative-commons | creative commons
gpl | gnu gpl
lgpl | gnu lgpl
agpl-3.0 | gnu agpl
bsd | bsd license
bsd | bsd style license
mpl | mozilla public license
epl | eclipse public license
artistic | artistic license
copyright | copyright (?:c )?(?:19|20)[0-9]{2}
cc-by-sa | cc by sa
cc-by-nc | cc by nc
cc-by-nd | cc by nd
cc0 | cc0
spdx | spdx license identifier
"""


def _rows(text: str, n: int) -> list[list[str]]:
    return [[x.strip() for x in line.split(" | ")] + [""] * (n - line.count(" | ") - 1) for line in text.strip().splitlines()]


def rules() -> list[tuple[str, str, str]]:
    """(label, kind, pattern), in rule order: tags, grants, addresses and names of each family, clauses, base, hints."""
    out = []
    for label, tag, name, url in _rows(FAMILIES, 4):
        out.append((label, "tag", f"spdx license identifier {tag}"))
        out.append((label, "grant", "(?:licensed|released|distributed|published|available|provided) (?:under|with) "
                                    f"(?:the terms of )?(?:the |an? )?{name}"))
        out.append((label, "name", name))
        if url:
            out.append((label, "url", url))
    out += [(label, "clause", p) for label, p in _rows(CLAUSES, 2)]
    out += [(label, "base", phrase) for phrase, label in BASE]
    out += [(label, "hint", p) for label, p in _rows(HINTS, 2)]
    return out
