"""Signature rules of the license scan (operator 11), in their order.

A line is `label; priority; weight; keyword; lead; pattern`. The pattern is a
regular expression over lower-case words with one space between them and starts
`lead` words before the keyword. The keyword is a word that the pattern has at
that place; a rule is tried only where its keyword stands. Of two detections
that overlap the one of the smaller priority number is better: 1 names one
license with its version or by its identifier, 2 is a sentence of a license's
own text, 3 names a license, 4 is a notice that names none. The rules of one
line of `_FAMILIES` are made from it by filling in the parts in braces."""

from __future__ import annotations

from typing import NamedTuple

#: No pattern matches more words than this.
MAX_WORDS = 24


class Rule(NamedTuple):
    order: int
    label: str
    priority: int
    weight: float
    keyword: str
    lead: int
    pattern: str
    base: bool = False


#: Phrases and labels that hold wherever they stand; no other detection suppresses them.
BASE = (("cc by", "cc-by", "cc", 0), ("general public license", "gpl", "general", 0), ("all rights reserved", "reserved", "reserved", 2))

# Creative Commons: elements of a license, by code.
_CC = {
    "by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s?(?: works)?", "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_GNU = {"gpl": ("gnu general public licen[sc]e", "gpl", ("1", "2", "3")), "lgpl": ("gnu (?:lesser|library) general public licen[sc]e", "lgpl", ("2", "2 1", "3")), "agpl": ("gnu affero general public licen[sc]e", "agpl", ("1", "3")), "gfdl": ("gnu free documentation licen[sc]e", "gfdl", ("1 1", "1 2", "1 3"))}

_FAMILIES = """
apache-{v}; 1; 0.95; apache; 0; apache (?:software )?licen[sc]e(?: version)? v?{v};; 1 0, 1 1, 2 0
apache-{v}; 1; 0.9; apache; 0; apache v?{v};; 1 0, 1 1, 2 0
mpl-{v}; 1; 0.95; mozilla; 0; mozilla public licen[sc]e(?: version)? v?{v};; 1 0, 1 1, 2 0
mpl-{v}; 1; 0.9; mpl; 0; mpl v?{v};; 1 0, 1 1, 2 0
epl-{v}; 1; 0.95; eclipse; 0; eclipse public licen[sc]e(?: version)? v?{v};; 1 0, 2 0
epl-{v}; 1; 0.9; epl; 0; epl v?{v};; 1 0, 2 0
eupl-{v}; 1; 0.95; european; 0; european union public licen[sc]e(?: version)? v?{v};; 1 0, 1 1, 1 2
eupl-{v}; 1; 0.9; eupl; 0; eupl v?{v};; 1 0, 1 1, 1 2
cddl-{v}; 1; 0.95; cddl; 0; cddl(?: version)? v?{v};; 1 0, 1 1
osl-{v}; 1; 0.95; osl; 0; osl(?: version)? v?{v};; 1 0, 1 1, 2 0, 2 1, 3 0
afl-{v}; 1; 0.95; academic; 0; academic free licen[sc]e(?: version)? v?{v};; 1 1, 1 2, 2 0, 2 1, 3 0
artistic-{v}; 1; 0.95; artistic; 0; artistic licen[sc]e(?: version)? v?{v};; 1 0, 2 0
ofl-{v}; 1; 0.95; ofl; 0; ofl(?: version)? v?{v};; 1 0, 1 1
ofl-{v}; 1; 0.95; font; 2; sil open font licen[sc]e(?: version)? v?{v};; 1 0, 1 1
lppl-{v}; 1; 0.95; lppl; 0; lppl(?: version)? v?{v};; 1 0, 1 1, 1 2, 1 3a, 1 3c
zpl-{v}; 1; 0.95; zope; 0; zope public licen[sc]e(?: version)? v?{v};; 1 1, 2 0, 2 1
php-{v}; 1; 0.95; php; 0; php licen[sc]e(?: version)? v?{v};; 3 0, 3 01
python-{v}; 1; 0.95; python; 0; python software foundation licen[sc]e(?: version)? v?{v};; 2, 2 0
cpl-{v}; 1; 0.95; cpl; 0; cpl(?: version)? v?{v};; 1 0
apsl-{v}; 1; 0.95; apsl; 0; apsl(?: version)? v?{v};; 1 0, 1 1, 1 2, 2 0
rpl-{v}; 1; 0.9; reciprocal; 0; reciprocal public licen[sc]e(?: version)? v?{v};; 1 1, 1 5
bsl-{v}; 1; 0.95; boost; 0; boost software licen[sc]e(?: version)? v?{v};; 1 0
ecl-{v}; 1; 0.9; educational; 0; educational community licen[sc]e(?: version)? v?{v};; 1 0, 2 0
wtfpl-{v}; 1; 0.9; wtfpl; 0; wtfpl(?: version)? v?{v};; 1, 2
odbl-{v}; 1; 0.9; odbl; 0; odbl(?: version)? v?{v};; 1 0
cecill-{v}; 1; 0.9; cecill; 0; cecill(?: version)? v?{v};; 1 0, 1 1, 2 0, 2 1
openldap-{v}; 1; 0.9; openldap; 0; openldap public licen[sc]e(?: version)? v?{v};; 2 7, 2 8
unicode-{v}; 1; 0.9; unicode; 0; unicode licen[sc]e v?{v};; 3
mulan-{v}; 1; 0.9; mulan; 0; mulan (?:psl|permissive software licen[sc]e)(?: version)? v?{v};; 1, 2
bsd-{v}-clause; 1; 0.95; bsd; 0; bsd {v} clause(?: licen[sc]e)?;; 0, 1, 2, 3, 4
bsd-{v}-clause; 1; 0.9; clause; 1; {v} clause bsd(?: licen[sc]e)?;; 0, 1, 2, 3, 4
rail-{v}; 1; 0.8; rail; 0; rail licen[sc]e (?:version )?{v};; 1 0
cc-{v}; 1; 0.95; commons; 1; creative commons {v} licen[sc]e;; sampling, sampling plus, zero
"""

_RULES = """
mit; 3; 0.9; license; 1; mit license
mit; 3; 0.9; licence; 1; mit licence
mit; 1; 0.95; identifier; 2; spdx license identifier mit
mit; 2; 1.0; permission; 0; permission is hereby granted free of charge to any person obtaining a copy
mit; 2; 0.8; copyright; 1; above copyright notice and this permission notice shall be included in all copies
mit; 2; 0.7; noninfringement; 3; particular purpose and noninfringement
mit-0; 3; 0.9; attribution; 2; mit no attribution(?: license)?
x11; 3; 0.8; license; 1; x11 license
expat; 3; 0.8; license; 1; expat license
isc; 3; 0.8; license; 1; isc license
isc; 2; 1.0; copy; 3; permission to use copy modify and(?: or)? distribute this software for any purpose
apache; 3; 0.8; apache; 0; apache (?:software )?licen[sc]e
apache-2 0; 2; 1.0; apache; 3; licensed under the apache licen[sc]e version 2 0 the license
apache-2 0; 2; 0.9; compliance; 8; you may not use this file except in compliance with the license
apache-2 0; 1; 1.0; apache; 0; apache org licenses license 2 0
apache-2 0; 1; 1.0; apache; 3; spdx license identifier apache 2 0
apache-2 0; 2; 0.6; distributed; 1; software distributed under the license is distributed on an as is basis
bsd; 3; 0.8; bsd; 0; bsd(?: style)? licen[sc]e
bsd-3-clause; 3; 0.9; bsd; 0; bsd new licen[sc]e
bsd-2-clause; 3; 0.9; bsd; 0; bsd simplified licen[sc]e
bsd-3-clause; 3; 0.9; bsd; 1; (?:new|modified|revised) bsd licen[sc]e
bsd-2-clause; 3; 0.9; bsd; 1; (?:simplified|freebsd) bsd licen[sc]e
bsd-4-clause; 3; 0.9; bsd; 1; (?:original|old) bsd licen[sc]e
bsd; 2; 1.0; redistribution; 0; redistribution and use in source and binary forms
bsd; 2; 0.8; redistributions; 0; redistributions of source code must retain the above copyright notice
bsd; 2; 0.8; redistributions; 0; redistributions in binary form must reproduce the above copyright notice
bsd-3-clause; 2; 1.0; endorse; 0; endorse or promote products derived from this software without specific prior written permission
bsd-4-clause; 2; 1.0; advertising; 1; all advertising materials mentioning features or use of this software must display
gpl; 3; 0.9; gnu; 0; gnu general public licen[sc]e
gpl; 3; 0.8; gnu; 0; gnu gpl
gpl; 3; 0.7; licensed; 0; licensed under (?:the )?gpl
gpl-2; 1; 0.9; gplv2; 0; gplv2
gpl-3; 1; 0.9; gplv3; 0; gplv3
gpl-2; 2; 0.9; gnu; 4; under the terms of gnu general public license version 2
gpl-3; 2; 0.9; gnu; 5; under the terms of the gnu general public license version 3
gpl; 2; 1.0; redistribute; 2; you can redistribute it and or modify it under the terms of the gnu general public license
gpl; 2; 0.9; redistribute; 2; you may redistribute it and or modify it under the terms of the gnu general public license
gpl; 2; 0.6; merchantability; 3; implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
lgpl; 3; 0.9; lesser; 0; lesser general public licen[sc]e
lgpl; 3; 0.9; library; 0; library general public licen[sc]e
lgpl; 3; 0.9; gnu; 0; gnu (?:lesser|library) general public licen[sc]e
lgpl; 3; 0.8; gnu; 0; gnu lgpl
lgpl; 3; 0.7; lgpl; 0; lgpl
agpl; 3; 0.9; affero; 0; affero general public licen[sc]e
agpl; 3; 0.9; gnu; 0; gnu affero general public licen[sc]e
agpl; 3; 0.8; gnu; 0; gnu agpl
agpl; 3; 0.7; agpl; 0; agpl
agpl-3; 1; 0.9; agplv3; 0; agplv3
gfdl; 3; 0.9; documentation; 2; gnu free documentation licen[sc]e
gfdl; 3; 0.7; gfdl; 0; gfdl
gfdl; 2; 0.9; invariant; 1; no invariant sections(?: no)? (?:with no )?front cover texts
mpl; 3; 0.9; mozilla; 0; mozilla public licen[sc]e
mpl-2 0; 2; 1.0; mozilla; 6; subject to the terms of the mozilla public license v 2 0
epl; 3; 0.9; eclipse; 0; eclipse public licen[sc]e
edl; 3; 0.9; eclipse; 0; eclipse distribution licen[sc]e
eupl; 3; 0.9; european; 0; european union public licen[sc]e
cddl; 3; 0.9; distribution; 3; common development and distribution licen[sc]e
cpl; 3; 0.8; common; 0; common public licen[sc]e
osl; 3; 0.8; open; 0; open software licen[sc]e
afl; 3; 0.8; academic; 0; academic free licen[sc]e
artistic; 3; 0.8; artistic; 0; artistic licen[sc]e
perl; 2; 0.9; perl; 5; under the same terms as perl itself
ofl; 3; 0.9; font; 1; open font licen[sc]e
lppl; 3; 0.9; latex; 0; latex project public licen[sc]e
zpl; 3; 0.9; zope; 0; zope public licen[sc]e
zlib; 3; 0.8; zlib; 0; zlib(?: libpng)? licen[sc]e
zlib; 2; 0.9; misrepresented; 7; origin of this software must not be misrepresented
libpng; 3; 0.8; libpng; 0; libpng licen[sc]e
openssl; 3; 0.8; openssl; 0; openssl licen[sc]e
openssl; 2; 0.9; openssl; 4; software developed by the openssl project
curl; 3; 0.7; curl; 0; curl licen[sc]e
php; 3; 0.8; php; 0; php licen[sc]e
python; 3; 0.9; python; 0; python software foundation licen[sc]e
python; 3; 0.8; psf; 0; psf licen[sc]e
ruby; 3; 0.7; ruby; 0; ruby licen[sc]e
unlicense; 3; 0.9; unlicense; 0; unlicense
unlicense; 2; 1.0; unencumbered; 1; and unencumbered software released into the public domain
unlicense; 2; 0.9; unencumbered; 2; free and unencumbered software released into the public domain
wtfpl; 3; 0.8; wtfpl; 0; wtfpl
boost; 3; 0.9; boost; 0; boost software licen[sc]e
beerware; 3; 0.8; beerware; 0; beerware(?: licen[sc]e)?
beerware; 3; 0.8; beer; 0; beer ware licen[sc]e
json; 3; 0.7; json; 0; json licen[sc]e
json; 2; 0.9; evil; 7; software shall be used for good not evil
ms-pl; 3; 0.9; microsoft; 0; microsoft public licen[sc]e
ms-rl; 3; 0.9; microsoft; 0; microsoft reciprocal licen[sc]e
ms-pl; 1; 0.8; pl; 1; ms pl
apsl; 3; 0.9; apple; 0; apple public source licen[sc]e
ncsa; 3; 0.9; ncsa; 0; ncsa(?: open source)? licen[sc]e
ncsa; 3; 0.9; illinois; 2; university of illinois (?:ncsa )?open source licen[sc]e
intel; 3; 0.8; intel; 0; intel open source licen[sc]e
ibm; 3; 0.8; ibm; 0; ibm public licen[sc]e
nasa; 3; 0.8; nasa; 0; nasa open source agreement
w3c; 3; 0.8; w3c; 0; w3c (?:software (?:notice and )?)?licen[sc]e
cecill; 3; 0.8; cecill; 0; cecill(?: licen[sc]e)?
postgresql; 3; 0.8; postgresql; 0; postgresql licen[sc]e
vim; 3; 0.7; vim; 0; vim licen[sc]e
qpl; 3; 0.8; public; 1; q public licen[sc]e
sleepycat; 3; 0.8; sleepycat; 0; sleepycat licen[sc]e
tcl; 3; 0.7; tcl; 0; tcl tk licen[sc]e
unicode; 3; 0.8; unicode; 0; unicode (?:license agreement|terms of use)
naist; 3; 0.7; naist; 0; naist licen[sc]e
freetype; 3; 0.8; freetype; 0; freetype (?:project )?licen[sc]e
ijg; 3; 0.8; jpeg; 1; independent jpeg group(?:s)? licen[sc]e
upl; 3; 0.8; universal; 0; universal permissive licen[sc]e
blueoak; 3; 0.8; oak; 1; blue oak model licen[sc]e
elastic; 3; 0.9; elastic; 0; elastic licen[sc]e(?: 2 0)?
sspl; 3; 0.9; server; 0; server side public licen[sc]e
sspl; 3; 0.8; sspl; 0; sspl
bsl; 3; 0.9; business; 0; business source licen[sc]e(?: 1 1)?
commons-clause; 3; 0.8; clause; 1; commons clause
llama; 3; 0.9; llama; 0; llama(?: 2| 3)? community licen[sc]e(?: agreement)?
openrail; 3; 0.9; openrail; 0; openrail(?: m)?
odbl; 3; 0.9; database; 1; open database licen[sc]e
odc-by; 3; 0.9; odc; 0; odc by
odc-by; 3; 0.9; commons; 2; open data commons attribution licen[sc]e
pddl; 3; 0.9; pddl; 0; pddl
pddl; 3; 0.9; dedication; 2; public domain dedication and licen[sc]e
ogl; 3; 0.9; government; 1; open government licen[sc]e
etalab; 3; 0.8; etalab; 0; etalab
dl-de; 3; 0.8; datenlizenz; 0; datenlizenz deutschland
cc; 3; 0.7; commons; 1; creative commons
cc; 3; 0.8; commons; 1; creative commons licen[sc]e
cc; 3; 0.8; commons; 2; licencia creative commons
cc; 3; 0.8; commons; 3; licence de creative commons
cc; 1; 0.9; creativecommons; 0; creativecommons org licenses
cc0; 1; 0.9; cc0; 0; cc0(?: 1 0)?(?: universal)?
cc0; 3; 0.9; commons; 1; creative commons (?:zero|cc0)
publicdomain; 4; 0.6; domain; 1; public domain
publicdomain; 4; 0.6; gemeinfrei; 0; gemeinfrei(?:e|es|er)?
publicdomain; 4; 0.6; público; 1; dominio público
publicdomain; 4; 0.6; public; 1; domaine public
publicdomain; 4; 0.9; domain; 4; dedicated to the public domain
copyright; 4; 0.5; copyright; 0; copyright (?:c )?(?:19|20)[0-9][0-9]
copyright; 4; 0.4; copyright; 0; copyright (?:c|©)
copyright; 4; 0.4; copyrighted; 0; copyrighted (?:material|work|content)
copyright; 4; 0.5; urheberrechtlich; 0; urheberrechtlich geschützt
reserved-de; 4; 0.6; vorbehalten; 2; alle rechte vorbehalten
reserved-es; 4; 0.6; reservados; 3; todos los derechos reservados
reserved-fr; 4; 0.6; réservés; 2; tous droits réservés
reserved-fr; 4; 0.6; réservés; 3; tous les droits réservés
reserved; 4; 0.5; reserved; 1; rights reserved
some-reserved; 4; 0.5; reserved; 2; some rights reserved
noreuse; 4; 0.7; permission; 1; without permission
noreuse; 4; 0.7; permission; 3; without prior written permission
noreuse; 4; 0.7; reproduced; 3; may not be reproduced
noreuse; 4; 0.7; reproduction; 0; reproduction (?:is )?(?:strictly )?prohibited
noreuse; 4; 0.7; redistribution; 1; no redistribution
noreuse; 4; 0.7; scraping; 0; scraping (?:is )?(?:strictly )?prohibited
notraining; 4; 0.9; training; 5; may not be used for training
notraining; 4; 0.9; mining; 3; text and data mining (?:is |are )?(?:not permitted|prohibited|reserved)
proprietary; 4; 0.6; proprietary; 0; proprietary and confidential
proprietary; 4; 0.6; proprietary; 2; confidential and proprietary
proprietary; 4; 0.6; license; 1; proprietary license
noncommercial; 4; 0.5; commercial; 2; for non commercial (?:use|purposes)(?: only)?
noncommercial; 4; 0.5; noncommercial; 1; for noncommercial (?:use|purposes)(?: only)?
personal-use; 4; 0.5; personal; 1; for personal use only
research-only; 4; 0.6; research; 1; for research (?:use|purposes) only
eula; 4; 0.6; eula; 0; eula
eula; 4; 0.7; end; 0; end user licen[sc]e agreement
terms; 4; 0.3; terms; 0; terms (?:of|and) (?:use|service|conditions)
license; 4; 0.3; licensed; 0; licensed (?:under|to|by)
license; 4; 0.3; released; 0; released under
license; 4; 0.3; license; 2; under the license
license; 4; 0.3; distributed; 0; distributed under
license; 4; 0.3; lizenziert; 0; lizenziert unter
license; 4; 0.3; licencia; 1; bajo licencia
license; 4; 0.3; licence; 1; sous licence
spdx; 4; 0.7; identifier; 2; spdx license identifier
"""


def rules() -> list[Rule]:
    """All rules in order: the base phrases, the versions, the rest."""
    found: list[tuple] = [(label, 3, 0.8, keyword, lead, phrase) for phrase, label, keyword, lead in BASE]
    for version in _CC_VERSIONS:
        for code, name in _CC.items():
            spaced, number = code.replace("-", " "), version.replace(" ", ".")
            found.append((f"cc-{code}-{number}", 1, 0.95, "cc", 0, f"cc {spaced}(?: sa)?(?: licen[sc]e)? {version}" if code == "by" else f"cc {spaced} {version}"))
            found.append((f"cc-{code}-{number}", 1, 0.95, "commons", 1, f"creative commons {name}(?: international| unported)?(?: public)?(?: licen[sc]e)? {version}"))
            found.append((f"cc-{code}-{number}", 1, 0.95, "creativecommons", 0, f"creativecommons org licenses {spaced} {version}"))
    for code, name in _CC.items():
        if code != "by":  # a base phrase
            found.append((f"cc-{code}", 3, 0.9, "cc", 0, "cc " + code.replace("-", " ")))
        found.append((f"cc-{code}", 3, 0.9, "commons", 1, f"creative commons {name}"))
    for label, (name, short, versions) in _GNU.items():
        for v in versions:
            number = v.replace(" ", ".")
            found.append((f"{label}-{number}", 1, 0.95, "gnu", 0, f"{name}(?: {short})? (?:version |v ?){v}(?: or (?:any )?later)?"))
            found.append((f"{label}-{number}", 1, 0.9, short, 0, f"{short} (?:version |v ?)?{v}(?: 0)?(?: only| or later)?"))
            found.append((f"{label}-{number}", 1, 0.95, "identifier", 2, f"spdx license identifier {short} {v}(?: 0)?(?: only| or later)?"))
    for line in _FAMILIES.strip().split("\n"):
        rule, versions = line.split(";; ")
        for v in versions.split(", "):
            label, priority, weight, keyword, lead, pattern = rule.split("; ")
            found.append((label.replace("{v}", v.replace(" ", ".")), int(priority), float(weight), keyword, int(lead), pattern.replace("{v}", v)))
    for line in _RULES.strip().split("\n"):
        label, priority, weight, keyword, lead, pattern = line.split("; ")
        found.append((label.replace(" ", "."), int(priority), float(weight), keyword, int(lead), pattern))
    return [Rule(i, *r, base=i < len(BASE)) for i, r in enumerate(found)]
