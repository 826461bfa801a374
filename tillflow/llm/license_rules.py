"""Signatures of licences: ordered, hand-written rules over lower-case words with one blank between.

A line is ``label priority expression``. ``{l}`` is "license" or "licence"; ``@2.1`` is a version, with
or without "version" or "v", and ``@2.0`` also stands for a bare 2. Priorities: 4 the wording of a grant,
3 an identifier tag or an address, 2 a licence with its version, 1 a licence by name. Among equals the
earlier line wins. Words outside groups that are spelled out must occur in every match; the two longest
are the rule's keywords, by which texts are filtered before any expression runs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Labels of the phrases that always count.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

WORDING = r"""
mit 4 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit 4 the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit-0 4 to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11 4 except as contained in this notice the name of the x consortium shall not be used in advertising
isc 4 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
isc 4 permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd 4 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
hpnd 4 permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
bsd 4 redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause 4 neither the name of (?:the )?(?:[^ ]+ ){1,12}?nor the names of its contributors may be used to endorse or promote products
bsd-4-clause 4 all advertising materials mentioning features or use of this software must display the following acknowledg?e?ment
bsd-2-clause 4 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
apache-1.1 4 products derived from this software may not be called apache nor may apache appear in their name
apache-2.0 4 you may not use this file except in compliance with the {l} you may obtain a copy of the {l} at
apache-2.0 4 unless required by applicable law or agreed to in writing software distributed under the {l} is distributed on an as is basis
gpl 4 is free software you can redistribute it and or modify it under the terms of the gnu general public {l}
gpl-2.0-or-later 4 gnu general public {l} as published by the free software foundation either version 2 of the {l} or at your option any later version
gpl-3.0-or-later 4 gnu general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
gpl-2.0-only 4 gnu general public {l} as published by the free software foundation version 2
gpl-2.0-only 4 gnu general public {l} version 2 as published by the free software foundation
gpl-3.0-only 4 gnu general public {l} as published by the free software foundation version 3
lgpl 4 it under the terms of the gnu (?:lesser|library) general public {l} as published by the free software foundation
lgpl-2.0-or-later 4 gnu library general public {l} as published by the free software foundation either version 2 of the {l} or at your option any later version
lgpl-2.1-or-later 4 gnu lesser general public {l} as published by the free software foundation either version 2 1 of the {l} or at your option any later version
lgpl-3.0-or-later 4 gnu lesser general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
agpl-3.0-or-later 4 gnu affero general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
agpl 4 it under the terms of the gnu affero general public {l} as published by the free software foundation
gpl 4 without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public {l} for more details
gfdl 4 permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {l}
mpl-2.0 4 this source code form is subject to the terms of the mozilla public {l} v 2 0
mpl-1.1 4 the contents of this file are subject to the mozilla public {l} version 1 1
mpl-2.0 4 if a copy of the mpl was not distributed with this file you can obtain one at
cddl 4 the contents of this file are subject to the terms of the common development and distribution {l}
epl-1.0 4 this program and the accompanying materials are made available under the terms of the eclipse public {l} v1 0
epl-2.0 4 this program and the accompanying materials are made available under the terms of the eclipse public {l} (?:v )?2 0
boost-1.0 4 to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software
zlib 4 altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib 4 this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
unlicense 4 this is free and unencumbered software released into the public domain
unlicense 4 anyone is free to copy modify publish use compile sell or distribute this software
wtfpl 4 everyone is permitted to copy and distribute verbatim or modified copies of this {l} document and changing it is allowed as long as the name is changed
beerware 4 as long as you retain this notice you can do whatever you want with this stuff
cc0-1.0 4 to the extent possible under law (?:[^ ]+ ){1,12}?has waived all copyright and related or neighbou?ring rights
cc-by 4 this work is licensed under (?:a|the) creative commons attribution(?: \d 0)?(?: [^ ]+)? {l}
cc-by-sa 4 this work is licensed under (?:a|the) creative commons attribution share(?: )?alike(?: \d 0)?(?: [^ ]+)? {l}
cc-by-nc 4 this work is licensed under (?:a|the) creative commons attribution non(?: )?commercial(?: \d 0)?(?: [^ ]+)? {l}
cc-by-nc-sa 4 this work is licensed under (?:a|the) creative commons attribution non(?: )?commercial share(?: )?alike(?: \d 0)?(?: [^ ]+)? {l}
cc-by-nc-nd 4 this work is licensed under (?:a|the) creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s(?: \d 0)?(?: [^ ]+)? {l}
ofl-1.1 4 this font software is licensed under the sil open font {l}
openssl 4 this product includes software developed by the openssl project for use in the openssl toolkit
artistic 4 the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
public-domain 4 (?:is|are) (?:hereby )?(?:dedicated to|released into|placed in) the public domain
all-rights-reserved 4 no part of this (?:publication|book|document|work) may be reproduced (?:distributed|stored|or transmitted)
vim 4 there are no restrictions on distributing unmodified copies of vim except that they must include this {l} text
"""

TAGS = r"""
gpl-2.0-only 3 spdx {l} identifier gpl 2 0(?: only)?
gpl-2.0-or-later 3 spdx {l} identifier gpl 2 0 or later
gpl-3.0-only 3 spdx {l} identifier gpl 3 0(?: only)?
gpl-3.0-or-later 3 spdx {l} identifier gpl 3 0 or later
lgpl-2.1-only 3 spdx {l} identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later 3 spdx {l} identifier lgpl 2 1 or later
lgpl-3.0-only 3 spdx {l} identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later 3 spdx {l} identifier lgpl 3 0 or later
agpl-3.0-only 3 spdx {l} identifier agpl 3 0(?: only)?
agpl-3.0-or-later 3 spdx {l} identifier agpl 3 0 or later
apache-2.0 3 spdx {l} identifier apache 2 0
apache-1.1 3 spdx {l} identifier apache 1 1
mit 3 spdx {l} identifier mit
mit-0 3 spdx {l} identifier mit 0
isc 3 spdx {l} identifier isc
0bsd 3 spdx {l} identifier 0bsd
bsd-2-clause 3 spdx {l} identifier bsd 2 clause
bsd-3-clause 3 spdx {l} identifier bsd 3 clause
bsd-4-clause 3 spdx {l} identifier bsd 4 clause
mpl-2.0 3 spdx {l} identifier mpl 2 0
mpl-1.1 3 spdx {l} identifier mpl 1 1
epl-1.0 3 spdx {l} identifier epl 1 0
epl-2.0 3 spdx {l} identifier epl 2 0
cddl-1.0 3 spdx {l} identifier cddl 1 0
eupl-1.2 3 spdx {l} identifier eupl 1 2
boost-1.0 3 spdx {l} identifier bsl 1 0
busl-1.1 3 spdx {l} identifier busl 1 1
zlib 3 spdx {l} identifier zlib
unlicense 3 spdx {l} identifier unlicense
wtfpl 3 spdx {l} identifier wtfpl
cc0-1.0 3 spdx {l} identifier cc0 1 0
cc-by-3.0 3 spdx {l} identifier cc by 3 0
cc-by-4.0 3 spdx {l} identifier cc by 4 0
cc-by-sa-3.0 3 spdx {l} identifier cc by sa 3 0
cc-by-sa-4.0 3 spdx {l} identifier cc by sa 4 0
cc-by-nc-4.0 3 spdx {l} identifier cc by nc 4 0
cc-by-nc-sa-4.0 3 spdx {l} identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 3 spdx {l} identifier cc by nc nd 4 0
cc-by-nd-4.0 3 spdx {l} identifier cc by nd 4 0
odbl-1.0 3 spdx {l} identifier odbl 1 0
ofl-1.1 3 spdx {l} identifier ofl 1 1
artistic-2.0 3 spdx {l} identifier artistic 2 0
postgresql 3 spdx {l} identifier postgresql
psf-2.0 3 spdx {l} identifier (?:psf|python) 2 0
ms-pl 3 spdx {l} identifier ms pl
upl-1.0 3 spdx {l} identifier upl 1 0
gpl-2.0 3 gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 3 gnu org licenses gpl 3 0
gpl 3 gnu org (?:licenses|copyleft) gpl
lgpl-2.1 3 gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 3 gnu org licenses lgpl 3 0
lgpl 3 gnu org (?:licenses|copyleft) lgpl
agpl-3.0 3 gnu org licenses agpl 3 0
agpl 3 gnu org licenses agpl
gfdl 3 gnu org (?:licenses|copyleft) fdl
apache-2.0 3 apache org licenses license 2 0
apache-1.1 3 apache org licenses license 1 1
mit 3 opensource org licenses mit
isc 3 opensource org licenses isc
bsd-2-clause 3 opensource org licenses bsd 2 clause
bsd-3-clause 3 opensource org licenses bsd 3 clause
apache-2.0 3 opensource org licenses apache 2 0
zlib 3 opensource org licenses zlib
artistic-2.0 3 opensource org licenses artistic 2 0
mpl-2.0 3 mozilla org (?:en us )?mpl 2 0
mpl-1.1 3 mozilla org (?:en us )?mpl(?: mpl)? 1 1
epl-2.0 3 eclipse org legal epl 2 0
epl-1.0 3 eclipse org legal epl v10
boost-1.0 3 boost org license 1 0
unlicense 3 unlicense org
wtfpl 3 wtfpl net
cc0-1.0 3 creativecommons org publicdomain zero 1 0
public-domain 3 creativecommons org publicdomain mark 1 0
cc-by-2.0 3 creativecommons org licenses by 2 0
cc-by-2.5 3 creativecommons org licenses by 2 5
cc-by-3.0 3 creativecommons org licenses by 3 0
cc-by-4.0 3 creativecommons org licenses by 4 0
cc-by-sa-2.0 3 creativecommons org licenses by sa 2 0
cc-by-sa-2.5 3 creativecommons org licenses by sa 2 5
cc-by-sa-3.0 3 creativecommons org licenses by sa 3 0
cc-by-sa-4.0 3 creativecommons org licenses by sa 4 0
cc-by-nc-2.0 3 creativecommons org licenses by nc 2 0
cc-by-nc-3.0 3 creativecommons org licenses by nc 3 0
cc-by-nc-4.0 3 creativecommons org licenses by nc 4 0
cc-by-nc-sa-3.0 3 creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 3 creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-3.0 3 creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 3 creativecommons org licenses by nc nd 4 0
cc-by-nd-3.0 3 creativecommons org licenses by nd 3 0
cc-by-nd-4.0 3 creativecommons org licenses by nd 4 0
odbl-1.0 3 opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 3 opendatacommons org licenses by(?: 1 0)?
pddl-1.0 3 opendatacommons org licenses pddl(?: 1 0)?
ofl-1.1 3 scripts sil org ofl
eupl 3 joinup ec europa eu (?:[^ ]+ ){0,6}?eupl
"""

VERSIONS = r"""
gpl-1.0 2 gnu general public {l}@1.0
gpl-2.0 2 gnu general public {l}@2.0
gpl-3.0 2 gnu general public {l}@3.0
gpl-2.0 2 gnu gpl@2.0
gpl-3.0 2 gnu gpl@3.0
gpl-2.0 2 gplv2
gpl-2.0-or-later 2 gplv2 or (?:any )?(?:later|newer)
gpl-3.0 2 gplv3
gpl-3.0-or-later 2 gplv3 or (?:any )?(?:later|newer)
gpl-2.0-or-later 2 gpl version 2 or (?:at your option )?(?:any )?later
gpl-3.0-or-later 2 gpl version 3 or (?:any )?later
lgpl-2.0 2 gnu library general public {l}@2.0
lgpl-2.1 2 gnu lesser general public {l}@2.1
lgpl-3.0 2 gnu lesser general public {l}@3.0
lgpl-2.1 2 lgpl(?: version)? v?2 1
lgpl-2.1 2 lgplv2 1
lgpl-3.0 2 lgplv3
agpl-3.0 2 gnu affero general public {l}@3.0
agpl-3.0 2 agpl(?: version)? v?3(?: 0)?
agpl-3.0 2 agplv3
gfdl-1.1 2 gnu free documentation {l}@1.1
gfdl-1.2 2 gnu free documentation {l}@1.2
gfdl-1.3 2 gnu free documentation {l}@1.3
apache-1.0 2 apache(?: software)? {l}@1.0
apache-1.1 2 apache(?: software)? {l}@1.1
apache-2.0 2 apache(?: software)? {l}@2.0
apache-2.0 2 apache 2 0 {l}
apache-2.0 2 asl 2 0
mpl-1.0 2 mozilla public {l}@1.0
mpl-1.1 2 mozilla public {l}@1.1
mpl-2.0 2 mozilla public {l}@2.0
mpl-1.1 2 mpl 1 1
mpl-2.0 2 mpl 2 0
epl-1.0 2 eclipse public {l}@1.0
epl-2.0 2 eclipse public {l}@2.0
edl-1.0 2 eclipse distribution {l}@1.0
cddl-1.0 2 common development and distribution {l}(?: cddl)?@1.0
cddl-1.1 2 common development and distribution {l}(?: cddl)?@1.1
cpl-1.0 2 common public {l}@1.0
ipl-1.0 2 ibm public {l}@1.0
eupl-1.1 2 european union public {l}(?: eupl)?@1.1
eupl-1.2 2 european union public {l}(?: eupl)?@1.2
osl-3.0 2 open software {l}@3.0
afl-2.1 2 academic free {l}@2.1
afl-3.0 2 academic free {l}@3.0
artistic-1.0 2 artistic {l}@1.0
artistic-2.0 2 artistic {l}@2.0
boost-1.0 2 boost software {l}@1.0
busl-1.1 2 business source {l}@1.1
elastic-2.0 2 elastic {l}@2.0
sspl-1.0 2 server side public {l}@1.0
ofl-1.0 2 sil open font {l}@1.0
ofl-1.1 2 sil open font {l}@1.1
upl-1.0 2 universal permissive {l}@1.0
zpl-2.1 2 zope public {l}@2.1
php-3.0 2 php {l}@3.0
php-3.01 2 php {l}(?: version)? v?3 01
psf-2.0 2 python software foundation {l}(?: version)? v?2
cecill-2.0 2 cecill(?: free software)? {l}@2.0
cecill-2.1 2 cecill(?: free software)? {l}@2.1
mulan-2.0 2 mulan (?:psl|permissive software {l})@2.0
bsd-2-clause 2 (?:2|two) clause (?:simplified )?bsd(?: {l})?
bsd-2-clause 2 bsd 2 clause(?: {l})?
bsd-3-clause 2 (?:3|three) clause (?:new |revised |modified )?bsd(?: {l})?
bsd-3-clause 2 bsd 3 clause(?: {l})?
bsd-4-clause 2 (?:4|four) clause (?:original )?bsd(?: {l})?
bsd-4-clause 2 bsd 4 clause(?: {l})?
bsd-3-clause 2 (?:new|revised|modified) bsd {l}
bsd-2-clause 2 simplified bsd {l}
cc0-1.0 2 cc0 1 0
cc-by-1.0 2 cc by 1 0
cc-by-2.0 2 cc by 2 0
cc-by-2.5 2 cc by 2 5
cc-by-3.0 2 cc by 3 0
cc-by-4.0 2 cc by 4 0
cc-by-sa-2.0 2 cc by sa 2 0
cc-by-sa-2.5 2 cc by sa 2 5
cc-by-sa-3.0 2 cc by sa 3 0
cc-by-sa-4.0 2 cc by sa 4 0
cc-by-nc-2.0 2 cc by nc 2 0
cc-by-nc-2.5 2 cc by nc 2 5
cc-by-nc-3.0 2 cc by nc 3 0
cc-by-nc-4.0 2 cc by nc 4 0
cc-by-nc-sa-2.0 2 cc by nc sa 2 0
cc-by-nc-sa-3.0 2 cc by nc sa 3 0
cc-by-nc-sa-4.0 2 cc by nc sa 4 0
cc-by-nc-nd-3.0 2 cc by nc nd 3 0
cc-by-nc-nd-4.0 2 cc by nc nd 4 0
cc-by-nd-3.0 2 cc by nd 3 0
cc-by-nd-4.0 2 cc by nd 4 0
cc-by-3.0 2 creative commons attribution@3.0
cc-by-4.0 2 creative commons attribution@4.0
cc-by-sa-3.0 2 creative commons attribution share(?: )?alike@3.0
cc-by-sa-4.0 2 creative commons attribution share(?: )?alike@4.0
cc-by-nc-3.0 2 creative commons attribution non(?: )?commercial@3.0
cc-by-nc-4.0 2 creative commons attribution non(?: )?commercial@4.0
cc-by-nc-sa-4.0 2 creative commons attribution non(?: )?commercial share(?: )?alike@4.0
cc-by-nc-nd-4.0 2 creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s@4.0
cc-by-nd-4.0 2 creative commons attribution no(?: )?deriv(?:ative)?s@4.0
odbl-1.0 2 open (?:data commons open )?database {l}@1.0
odc-by-1.0 2 open data commons attribution {l}@1.0
ogl-3.0 2 open government {l}@3.0
w3c-20150513 2 w3c software and document notice and {l}
"""

NAMES = r"""
gpl 1 gnu gpl
gpl 1 gnu public {l}
gpl 1 under the gpl
lgpl 1 gnu (?:lesser|library) general public {l}
lgpl 1 gnu lgpl
agpl 1 gnu affero general public {l}
agpl 1 gnu agpl
gfdl 1 gnu free documentation {l}
gpl-classpath 1 gpl(?: [^ ]+){0,3} with classpath exception
apache 1 apache software {l}
mit 1 mit licen[cs]ed
mit 1 (?:released|licensed|available) under (?:the )?mit
x11 1 x11 {l}
expat 1 expat {l}
isc 1 isc {l}
bsd 1 bsd {l}
bsd 1 bsd style {l}
bsd 1 berkeley software distribution {l}
mpl 1 mozilla public {l}
epl 1 eclipse public {l}
cddl 1 common development and distribution {l}
cpl 1 common public {l}
eupl 1 european union public {l}
osl 1 open software {l}
afl 1 academic free {l}
artistic 1 artistic {l}
boost 1 boost software {l}
busl 1 business source {l}
commons-clause 1 commons clause(?: {l})? condition
elastic 1 elastic {l}
sspl 1 server side public {l}
ofl 1 sil open font {l}
ofl 1 open font {l}
zlib 1 zlib(?: libpng)? {l}
libpng 1 libpng {l}
ijg 1 independent jpeg group
curl 1 curl {l}
openssl 1 openssl {l}
ruby 1 ruby {l}
python 1 python(?: software foundation)? {l}
php 1 php {l}
perl 1 under the same terms as perl itself
tcl 1 tcl tk {l}
vim 1 vim {l}
zope 1 zope public {l}
qpl 1 q public {l}
sleepycat 1 sleepycat {l}
postgresql 1 postgresql {l}
ncsa 1 university of illinois (?:ncsa )?open source {l}
ms-pl 1 microsoft public {l}
ms-rl 1 microsoft reciprocal {l}
json 1 the software shall be used for good not evil
wtfpl 1 do what the fuck you want to public {l}
unlicense 1 under the unlicense
cecill 1 cecill {l}
mulan 1 mulan permissive software {l}
upl 1 universal permissive {l}
ecl 1 educational community {l}
lppl 1 latex project public {l}
naist 1 naist {l}
odbl 1 open database {l}
odc-by 1 open data commons attribution {l}
ogl 1 open government {l}
openrail 1 openrail(?: m)?
llama-community 1 llama(?: \d)? community {l}
bigscience-rail 1 bigscience (?:open )?rail
cc0 1 cc0
cc-by-sa 1 cc by sa
cc-by-nc 1 cc by nc
cc-by-nd 1 cc by nd
cc-by-nc-sa 1 cc by nc sa
cc-by-nc-nd 1 cc by nc nd
cc 1 creative commons {l}
cc-by 1 creative commons attribution
cc-by-sa 1 creative commons attribution share(?: )?alike
cc-by-nc 1 creative commons attribution non(?: )?commercial
cc-by-nd 1 creative commons attribution no(?: )?deriv(?:ative)?s
public-domain 1 public domain dedication
proprietary 1 proprietary and confidential
proprietary 1 commercial {l} agreement
all-rights-reserved 1 all rights reserved
"""

_PLAIN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    expression: str
    keywords: tuple[str, str]
    base: bool


def expanded(expression: str) -> str:
    """The expression with ``{l}`` and ``@`` versions written out."""

    def version(found: re.Match) -> str:
        major, minor = found[1], found[2]
        return f"(?: version| ver)? v?{major}" + ("(?: 0)?" if minor == "0" else f" {minor}")

    return re.sub(r"@(\d)\.(\d)", version, expression.replace("{l}", "licen[cs]e"))


def keywords(expression: str) -> tuple[str, str]:
    """The two longest words that every match has (one word twice if there is no other).

    A group that begins or ends with a blank leaves the word beside it whole, so it is put aside.
    """
    aside = re.sub(r"\(\?:(?: [^()]+|[^()]+ )\)(?:\?|\{\d+,\d+\}\?)", "", expression)
    tokens, depth, start = [], 0, 0
    for place, letter in enumerate(aside + " "):
        depth += {"(": 1, ")": -1}.get(letter, 0)
        if letter == " " and depth == 0 and aside[place - 1] != "^":
            tokens.append(aside[start:place])
            start = place + 1
    sure = sorted({t for t in tokens if _PLAIN.fullmatch(t)}, key=lambda t: (-len(t), t))
    if not sure:
        raise ValueError(f"no keyword in {expression}")
    return sure[0], sure[min(1, len(sure) - 1)]


def rules() -> list[Rule]:
    """All rules in order; the phrases that always count come first."""
    lines = [f"{label} 1 {phrase}" for phrase, label in BASE.items()]
    for block in (WORDING, TAGS, VERSIONS, NAMES):
        lines += block.strip().splitlines()
    out = []
    for number, line in enumerate(lines):
        label, priority, expression = line.split(" ", 2)
        expression = expanded(expression)
        out.append(Rule(number, label, int(priority), expression, keywords(expression), number < len(BASE)))
    return out
