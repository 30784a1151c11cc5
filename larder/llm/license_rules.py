"""Licence signatures: hand-written regular expressions over normalised words, in order of priority."""

from __future__ import annotations

from re import _constants, _parser
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    level: int  # smaller wins: 0 SPDX tags, 1 notices, 2 full names with version, 3 names, 4 bare references
    gate: str  # a coarse keyword, one of GATES
    keyword: str  # what the text must hold before the expression is tried; a part of every match
    regex: str  # over words of [0-9a-z] and non-ASCII characters with one space between


#: The contract's phrases. They count wherever their words stand together, and no suppression removes their labels.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Coarse keywords. A rule whose matches need hold none of them has its keyword as its gate.
COARSE = ("licen", "copyright", "permission", "redistribut", "public domain", "warranty", "cc by", "creative commons", "copyleft", "unlicense")

#: What stands between a name and a version: "version 2", "v 2", "v2" or nothing.
V = r" (?:version |v ?)?"

#: label | level | keyword | regex. Where a match need not hold the keyword, the nearest text that it must hold takes its place (see ``_keyword``).
SIGNATURES = rf"""
mit | 1 | hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 1 | associated documentation files | this software and associated documentation files(?: the software)?
mit | 2 | mit license | licensed under the (?:terms of the )?mit license
mit | 2 | mit license | released under the (?:terms of the )?mit license
mit | 2 | mit license | distributed under the (?:terms of the )?mit license
mit | 3 | mit license | (?:the )?mit license
mit | 3 | expat license | (?:the )?expat license
mit | 3 | x11 license | (?:the )?(?:mit )?x11 license
mit | 4 | mit | licen[sc]ed? (?:under )?mit
mit-0 | 2 | mit no attribution | mit no attribution(?: license)?
mit-0 | 2 | mit 0 | mit 0 license
mit-cmu | 2 | cmu license | (?:mit )?cmu license
apache-2.0 | 1 | apache license | licensed under the apache license{V}2 0 the license
apache-2.0 | 1 | apache org licenses license 2 0 | www apache org licenses license 2 0
apache-2.0 | 1 | you may not use this file except in compliance | you may not use this file except in compliance with the license
apache-2.0 | 2 | apache license | apache license{V}2(?: 0)?
apache-2.0 | 2 | apache 2 | licensed under (?:the )?apache{V}2(?: 0)?
apache-2.0 | 3 | apache 2 0 license | apache 2 0 license
apache-1.1 | 2 | apache software license | apache software license{V}1 1
apache-1.0 | 2 | apache software license | apache software license{V}1 0
apache-1.1 | 2 | apache license | apache license{V}1 1
apache-1.0 | 2 | apache license | apache license{V}1 0
apache | 3 | apache software license | apache software license
apache | 3 | apache license | (?:the )?apache license
apache | 4 | apache | licen[sc]ed under (?:the )?apache
gpl-1.0 | 2 | general public license | gnu general public license{V}1(?: 0)?
gpl-2.0 | 2 | general public license | (?:gnu )?general public license{V}2(?: 0)?
gpl-2.0-or-later | 1 | general public license | general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-2.0-only | 2 | general public license | general public license{V}2(?: 0)? only
gpl-3.0 | 2 | general public license | (?:gnu )?general public license{V}3(?: 0)?
gpl-3.0-or-later | 1 | general public license | general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl-3.0-only | 2 | general public license | general public license{V}3(?: 0)? only
gpl | 3 | general public license | (?:the )?(?:gnu )?general public license
gpl | 3 | gnu gpl | (?:the )?gnu gpl
gpl-2.0 | 2 | gpl | licen[sc]ed under (?:the )?(?:gnu )?gpl ?(?:version |v)?2(?: 0)?
gpl-3.0 | 2 | gpl | licen[sc]ed under (?:the )?(?:gnu )?gpl ?(?:version |v)?3(?: 0)?
gpl | 4 | gpl | licen[sc]ed under (?:the )?gpl
gpl | 4 | gpl license | gpl license
gpl-2.0 | 3 | gplv2 license | gplv2 license
gpl-3.0 | 3 | gplv3 license | gplv3 license
classpath-exception | 2 | classpath | classpath exception
lgpl-2.0 | 2 | library general public license | (?:gnu )?library general public license{V}2(?: 0)?
lgpl-2.1 | 2 | lesser general public license | (?:gnu )?lesser general public license{V}2 1
lgpl-3.0 | 2 | lesser general public license | (?:gnu )?lesser general public license{V}3(?: 0)?
lgpl-2.1-or-later | 1 | lesser general public license | lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
lgpl-3.0-or-later | 1 | lesser general public license | lesser general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
lgpl | 3 | lesser general public license | (?:gnu )?lesser general public license
lgpl | 3 | library general public license | (?:gnu )?library general public license
lgpl | 4 | lgpl | licen[sc]ed under (?:the )?(?:gnu )?lgpl
agpl-3.0 | 2 | affero general public license | (?:gnu )?affero general public license{V}3(?: 0)?
agpl-3.0-or-later | 1 | affero general public license | affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
agpl-1.0 | 2 | affero general public license | affero general public license{V}1(?: 0)?
agpl | 3 | affero general public license | (?:gnu )?affero general public license
agpl | 4 | agpl | licen[sc]ed under (?:the )?(?:gnu )?agpl
gfdl-1.1 | 2 | free documentation license | (?:gnu )?free documentation license{V}1 1
gfdl-1.2 | 2 | free documentation license | (?:gnu )?free documentation license{V}1 2
gfdl-1.3 | 2 | free documentation license | (?:gnu )?free documentation license{V}1 3
gfdl | 3 | free documentation license | (?:gnu )?free documentation license
bsd-2-clause | 2 | bsd 2 clause | bsd 2 clause(?: simplified)?(?: license)?
bsd-2-clause | 2 | simplified bsd license | simplified bsd license
bsd-2-clause | 2 | freebsd license | freebsd license
bsd-2-clause | 2 | two clause bsd | two clause bsd(?: license)?
bsd-3-clause | 1 | may be used to endorse | neither the name of (?:\S+ ){{1,12}}nor the names of its contributors may be used to endorse
bsd-3-clause | 2 | bsd 3 clause | bsd 3 clause(?: new| revised| modified)?(?: license)?
bsd-3-clause | 2 | new bsd license | new bsd license
bsd-3-clause | 2 | modified bsd license | modified bsd license
bsd-3-clause | 2 | revised bsd license | revised bsd license
bsd-3-clause | 2 | three clause bsd | three clause bsd(?: license)?
bsd-4-clause | 1 | advertising materials | all advertising materials mentioning features or use of this software must display
bsd-4-clause | 2 | bsd 4 clause | bsd 4 clause(?: original)?(?: license)?
bsd-4-clause | 2 | original bsd license | original bsd license
bsd | 1 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | bsd license | (?:the )?bsd license
bsd | 3 | bsd style license | bsd style license
bsd | 4 | bsd | licen[sc]ed under (?:the )?bsd
0bsd | 2 | zero clause bsd | zero clause bsd(?: license)?
0bsd | 2 | 0bsd license | 0bsd license
isc | 1 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 3 | isc license | (?:the )?isc license
isc | 3 | internet systems consortium license | internet systems consortium license
mpl-1.0 | 2 | mozilla public license | mozilla public license{V}1 0
mpl-1.1 | 2 | mozilla public license | mozilla public license{V}1 1
mpl-2.0 | 1 | source code form is subject to the terms | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 2 | mozilla public license | mozilla public license{V}2(?: 0)?
mpl | 3 | mozilla public license | mozilla public license
mpl | 4 | mpl | licen[sc]ed under (?:the )?mpl
epl-1.0 | 2 | eclipse public license | eclipse public license{V}1(?: 0)?
epl-2.0 | 2 | eclipse public license | eclipse public license{V}2(?: 0)?
epl | 3 | eclipse public license | eclipse public license
edl-1.0 | 2 | eclipse distribution license | eclipse distribution license(?:{V}1 0)?
cddl-1.0 | 2 | common development and distribution license | common development and distribution license{V}1 0
cddl-1.1 | 2 | common development and distribution license | common development and distribution license{V}1 1
cddl | 3 | common development and distribution license | common development and distribution license
cpl-1.0 | 2 | common public license | common public license(?:{V}1 0)?
cpal-1.0 | 2 | common public attribution license | common public attribution license(?:{V}1 0)?
epl | 4 | epl | licen[sc]ed under (?:the )?epl
eupl-1.0 | 2 | european union public licen | european union public licen[sc]e{V}1 0
eupl-1.1 | 2 | european union public licen | european union public licen[sc]e{V}1 1
eupl-1.2 | 2 | european union public licen | european union public licen[sc]e{V}1 2
eupl | 3 | european union public licen | european union public licen[sc]e
cecill-2.1 | 2 | cecill | cecill free software license agreement{V}2 1
cecill-b | 3 | cecill b | cecill b license
cecill-c | 3 | cecill c | cecill c license
cecill | 3 | cecill license | cecill license
artistic-1.0 | 2 | artistic license | artistic license{V}1 0
artistic-2.0 | 2 | artistic license | artistic license{V}2(?: 0)?
artistic | 3 | artistic license | artistic license
artistic | 2 | clarified artistic license | clarified artistic license
perl | 3 | same terms as perl | (?:licensed )?under the same terms as perl(?: itself)?
bsl-1.0 | 2 | boost software license | boost software license(?:{V}1 0)?
bsl-1.0 | 3 | boost license | boost license
busl-1.1 | 2 | business source license | business source license(?:{V}1 1)?
zlib | 1 | as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 3 | zlib license | zlib license
zlib | 3 | zlib libpng license | zlib libpng license
libpng | 3 | libpng license | libpng license
libtiff | 3 | libtiff license | libtiff license
ijg | 3 | independent jpeg group | independent jpeg group licen[sc]e
unlicense | 1 | free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 3 | unlicense | (?:the )?unlicense
wtfpl | 3 | you want to public license | do what the \S+ you want to public license
wtfpl | 3 | wtfpl license | wtfpl license
beerware | 3 | beerware license | beerware license
beerware | 3 | beer ware license | beer ware license
postgresql | 3 | postgresql license | postgresql licen[sc]e
python-2.0 | 2 | python software foundation license | python software foundation license(?:{V}2)?
python-2.0 | 3 | psf license | psf license
ruby | 3 | ruby license | ruby license
php-3.01 | 2 | php license | php license{V}3 01
php-3.0 | 2 | php license | php license{V}3 0
php | 3 | php license | php license
zend-2.0 | 2 | zend engine license | zend engine license
vim | 3 | vim license | vim license
curl | 3 | curl license | curl license
openssl | 3 | openssl license | openssl license
ssleay | 3 | ssleay license | (?:original )?ssleay license
w3c | 2 | w3c software notice and license | w3c software notice and license
w3c | 3 | w3c license | w3c(?: software)? license
unicode | 2 | unicode license agreement | unicode license agreement data files and software
unicode | 3 | unicode license | unicode license
ofl-1.0 | 2 | sil open font license | (?:sil )?open font license{V}1 0
ofl-1.1 | 2 | open font license | (?:sil )?open font license{V}1 1
ofl | 3 | open font license | (?:sil )?open font license
lppl-1.2 | 2 | latex project public license | latex project public license{V}1 2
lppl-1.3c | 2 | latex project public license | latex project public license{V}1 3c?
lppl | 3 | latex project public license | latex project public license
ms-pl | 2 | microsoft public license | microsoft public license(?: ms pl)?
ms-rl | 2 | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
ncsa | 2 | illinois ncsa open source license | university of illinois ncsa open source license
ncsa | 3 | ncsa open source license | ncsa open source license
afl-2.1 | 2 | academic free license | academic free license{V}2 1
afl-3.0 | 2 | academic free license | academic free license{V}3 0
afl | 3 | academic free license | academic free license
osl-2.1 | 2 | open software license | open software license{V}2 1
osl-3.0 | 2 | open software license | open software license{V}3 0
osl | 3 | open software license | open software license
ecl-2.0 | 2 | educational community license | educational community license(?:{V}2 0)?
upl-1.0 | 2 | universal permissive license | universal permissive license(?:{V}1 0)?
qpl-1.0 | 2 | q public license | q public license(?:{V}1 0)?
ipl-1.0 | 2 | ibm public license | ibm public license(?:{V}1 0)?
spl-1.0 | 2 | sun public license | sun public license(?:{V}1 0)?
npl-1.1 | 2 | netscape public license | netscape public license(?:{V}1 1)?
apsl-2.0 | 2 | apple public source license | apple public source license(?:{V}2 0)?
rpl-1.5 | 2 | reciprocal public license | reciprocal public license(?:{V}1 5)?
sspl-1.0 | 2 | server side public license | server side public license(?:{V}1)?
elastic-2.0 | 2 | elastic license | elastic license{V}2(?: 0)?
elastic | 3 | elastic license | elastic license
polyform-nc | 2 | polyform noncommercial license | polyform noncommercial license(?: 1 0 0)?
mulan-psl-2.0 | 2 | mulan permissive software license | mulan permissive software license(?:{V}2)?
blueoak-1.0.0 | 2 | blue oak model license | blue oak model license(?: 1 0 0)?
odbl-1.0 | 2 | open database license | (?:odc )?open database license(?:{V}1 0)?
odc-by-1.0 | 2 | open data commons attribution license | open data commons attribution license(?:{V}1 0)?
pddl-1.0 | 2 | public domain dedication and license | (?:odc )?public domain dedication and license(?:{V}1 0)?
openrail | 2 | responsible ai license | (?:open )?responsible ai license
openrail-m | 2 | openrail m license | (?:creativeml |bigscience )?openrail m license
intel | 3 | intel open source license | intel open source license
naist | 3 | naist license | naist license
ntp | 3 | ntp license | ntp license
hpnd | 2 | historical permission notice | historical permission notice and disclaimer
sleepycat | 3 | sleepycat license | sleepycat license
watcom | 3 | sybase open watcom public license | sybase open watcom public license
xfree86 | 3 | xfree86 license | xfree86 license
tcl | 3 | tcl tk license | tcl tk license
json | 1 | shall be used for good not evil | the software shall be used for good not evil
json | 3 | json license | (?:the )?json license
free-art | 2 | free art license | free art license(?: 1 3)?
opl-1.0 | 2 | open publication license | open publication license(?:{V}1 0)?
ogl-3.0 | 2 | open government licen | open government licen[sc]e{V}3 0
ogl | 3 | open government licen | open government licen[sc]e
etalab-2.0 | 2 | licence ouverte | licence ouverte(?: open licence)?(?:{V}2 0)?
dl-de-by-2.0 | 2 | datenlizenz deutschland | datenlizenz deutschland namensnennung(?:{V}2 0)?
cc0-1.0 | 1 | creative commons zero | creative commons zero(?:{V}1 0)?(?: universal)?
cc0-1.0 | 2 | cc0 | licen[sc]ed under cc0(?: 1 0)?
cc0-1.0 | 3 | cc0 license | cc0(?: 1 0)? license
cc-by-nc-nd | 2 | cc by nc nd | (?:licen[sc]ed under )?cc by nc nd(?: [1-4] 0)?
cc-by-nc-sa | 2 | cc by nc sa | (?:licen[sc]ed under )?cc by nc sa(?: [1-4] 0)?
cc-by-nc | 3 | cc by nc | (?:licen[sc]ed under )?cc by nc(?: [1-4] 0)?
cc-by-nd | 2 | cc by nd | (?:licen[sc]ed under )?cc by nd(?: [1-4] 0)?
cc-by-sa | 2 | cc by sa | (?:licen[sc]ed under )?cc by sa(?: [1-4] 0)?
cc-by | 4 | cc by | (?:licen[sc]ed under )?cc by(?: [1-4] 0)?
cc-by-nc-nd | 1 | noncommercial no | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] 0)?(?: international)?
cc-by-nc-sa | 1 | share | creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?(?: international)?
cc-by-nc | 2 | creative commons attribution | creative commons attribution non ?commercial(?: [1-4] 0)?(?: international)?
cc-by-nd | 2 | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s(?: [1-4] 0)?(?: international)?
cc-by-sa | 2 | creative commons attribution | creative commons attribution share ?alike(?: [1-4] 0)?(?: international)?
cc-by | 3 | creative commons attribution | creative commons attribution(?: [1-4] 0)?(?: international)?
cc | 4 | creative commons | creative commons(?: licen[sc]e)?
cc | 1 | creativecommons org licenses | creativecommons org licenses \S+(?: [1-4] 0)?
public-domain | 2 | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 4 | public domain | public domain
all-rights-reserved | 3 | all rights reserved | (?:copyright (?:\S+ ){{0,8}})?all rights reserved
proprietary | 3 | proprietary license | proprietary license
proprietary | 3 | commercial license | commercial license
proprietary | 2 | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
dual | 4 | dual licensed | dual licensed(?: under)?
copyleft | 4 | copyleft | copyleft licen[sc]e
"""

#: Labels whose SPDX tag ("SPDX-License-Identifier: x") is a rule of its own.
TAGGED = sorted({line.split(" | ")[0].strip() for line in SIGNATURES.strip().splitlines()})


def _fixed(regex: str) -> list[str]:
    """The runs of characters that every match of an expression holds: what is optional, repeated or one of several ends a run."""
    runs = [""]

    def walk(items) -> None:
        for kind, value in items:
            if kind is _constants.LITERAL:
                runs[-1] += chr(value)
            elif kind is _constants.SUBPATTERN:
                walk(value[-1])
            else:
                runs.append("")

    walk(_parser.parse(regex))
    return [r for r in runs if r.strip()]


def _keyword(keyword: str, regex: str) -> str:
    """``keyword`` if every match holds it; else the longest text that every match holds, of those with a word of it if there are any."""
    runs = _fixed(regex)
    if any(keyword in r for r in runs):
        return keyword
    near = [r for r in runs if set(r.split()) & set(keyword.split())]
    return max(near or runs, key=len)


def _gate(keyword: str, regex: str) -> str:
    """The first coarse keyword that every match holds, or else the rule's own keyword."""
    for text in (keyword, *_fixed(regex)):
        for gate in COARSE:
            if gate in text:
                return gate
    return keyword


def rules() -> list[Rule]:
    """All signatures, the contract's phrases first, then by priority as written."""
    out = [Rule(label, 3, "licen", phrase, phrase) for label, phrase in BASE]
    for label in TAGGED:
        words = label.replace("-", " ").replace(".", " ")
        out.append(Rule(label, 0, "licen", "spdx license identifier", f"spdx license identifier {words}"))
    for line in SIGNATURES.strip().splitlines():
        label, level, keyword, regex = (x.strip() for x in line.split(" | "))
        keyword = _keyword(keyword, regex)
        out.append(Rule(label, int(level), _gate(keyword, regex), keyword, regex))
    return out


#: All gates: a text with none of them is not looked at any further.
GATES = tuple(dict.fromkeys([*COARSE, *(r.gate for r in rules())]))
