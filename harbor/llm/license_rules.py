"""Signatures of licenses, best kind first within a family.

One rule a line: label, kind, keyword, pattern.  Patterns are met by words in
small letters with single spaces between them, whatever stood there in the text
(``GPL-2.0+`` reads ``gpl 2 0``).  The keyword is a string every match contains;
it decides whether the pattern is tried at all.  Kinds, best first: ``tag``
(identifiers and addresses), ``text`` (sentences of the license or its notice),
``title`` (a name with its version), ``name`` (without), ``hint``.
"""

from __future__ import annotations

from dataclasses import dataclass

KINDS = ("tag", "text", "title", "name", "hint")


@dataclass(frozen=True)
class Signature:
    label: str
    kind: str
    keyword: str
    pattern: str


_RULES = r"""
mit | tag | spdx | spdx license identifiers? mit
mit | tag | opensource | opensource org licenses? mit(?: license)?(?: php)?
mit | text | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | text | copyright | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | text | mit | (?:released|distributed|licensed|available) under the (?:terms of the )?mit licen[sc]e
mit | title | expat | expat licen[sc]e
mit | title | x11 | mit x11 licen[sc]e
mit | name | mit | (?:the )?mit licen[sc]ed?
mit-0 | tag | spdx | spdx license identifier mit 0
mit-0 | title | attribution | mit no attribution(?: licen[sc]e)?
x11 | tag | spdx | spdx license identifier x11
x11 | text | consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
x11 | title | x11 | x11 licen[sc]e
apache-2.0 | tag | spdx | spdx license identifiers? apache 2 0
apache-2.0 | tag | apache | (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-2.0 | tag | opensource | opensource org licenses apache 2 0
apache-2.0 | text | apache | licensed under the apache licen[sc]e version 2 0
apache-2.0 | text | contributor | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2.0 | text | compliance | you may not use this file except in compliance with the license
apache-2.0 | text | applicable | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | title | apache | apache (?:software )?licen[sc]e v?(?:ersion )?2(?: 0)?
apache-2.0 | title | apache | apache 2(?: 0)? licen[sc]e
apache-2.0 | title | apache | licensed under apache 2(?: 0)?
apache-2.0 | title | asl | asl 2 0
apache-1.1 | tag | spdx | spdx license identifier apache 1 1
apache-1.1 | text | apache | this product includes software developed by the apache software foundation
apache-1.1 | title | apache | apache (?:software )?licen[sc]e v?(?:ersion )?1 1
apache-1.0 | tag | spdx | spdx license identifier apache 1 0
apache-1.0 | text | apache | this product includes software developed by the apache group
apache-1.0 | title | apache | apache (?:software )?licen[sc]e v?(?:ersion )?1 0
apache | name | apache | (?:the )?apache licen[sc]e
gpl-1.0 | tag | spdx | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | title | general | gnu general public licen[sc]e v?(?:ersion )?1(?: 0)?
gpl-2.0 | tag | spdx | spdx license identifiers? gpl 2 0(?: only| or later)?
gpl-2.0 | tag | gnu | gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
gpl-2.0 | tag | opensource | opensource org licenses gpl 2 0
gpl-2.0 | text | general | under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2.0 | text | general | under the terms of the gnu general public license version 2
gpl-2.0 | text | general | licensed under the gnu general public licen[sc]e version 2(?: 0)?
gpl-2.0 | text | boston | you should have received a copy of the gnu general public license along with this program if not write to the free software foundation inc (?:51|59) (?:\S+ ){1,4}boston
gpl-2.0 | title | general | gnu general public licen[sc]e v?(?:ersion )?2(?: 0)?
gpl-2.0 | title | gpl | gpl ?v(?:ersion )?2(?: 0)?
gpl-2.0 | title | gplv2 | gplv2(?: only| or later)?
gpl-2.0 | title | gpl | gpl 2 0(?: only| or later)?
gpl-3.0 | tag | spdx | spdx license identifiers? gpl 3 0(?: only| or later)?
gpl-3.0 | tag | gnu | gnu org licenses gpl(?: 3 0)?(?: en)?(?: html| txt)?
gpl-3.0 | tag | opensource | opensource org licenses gpl 3 0
gpl-3.0 | text | general | under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0 | text | general | under the terms of the gnu general public license version 3
gpl-3.0 | text | general | licensed under the gnu general public licen[sc]e version 3(?: 0)?
gpl-3.0 | text | tivoization | tivoization
gpl-3.0 | title | general | gnu general public licen[sc]e v?(?:ersion )?3(?: 0)?
gpl-3.0 | title | gpl | gpl ?v(?:ersion )?3(?: 0)?
gpl-3.0 | title | gplv3 | gplv3(?: only| or later)?
gpl-3.0 | title | gpl | gpl 3 0(?: only| or later)?
gpl | text | general | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | text | general | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details
gpl | name | general | (?:the )?(?:gnu )?general public licen[sc]e
gpl | name | gpl | (?:gnu gpl|gpl licen[sc]ed?|licensed under the gpl)
gpl-classpath-exception | tag | classpath | with classpath exception 2 0
gpl-classpath-exception | text | modules | as a special exception the copyright holders of this library give you permission to link this library with independent modules
gpl-classpath-exception | name | classpath | classpath exception
lgpl-2.0 | tag | spdx | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | text | library | under the terms of the gnu library general public license
lgpl-2.0 | title | library | gnu library general public licen[sc]e(?: v?(?:ersion )?2(?: 0)?)?
lgpl-2.1 | tag | spdx | spdx license identifiers? lgpl 2 1(?: only| or later)?
lgpl-2.1 | tag | gnu | gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
lgpl-2.1 | text | lesser | gnu lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-2.1 | title | lesser | gnu lesser general public licen[sc]e v?(?:ersion )?2 1
lgpl-2.1 | title | lgpl | lgpl ?v?(?:ersion )?2 1(?: only| or later)?
lgpl-3.0 | tag | spdx | spdx license identifiers? lgpl 3 0(?: only| or later)?
lgpl-3.0 | tag | gnu | gnu org licenses lgpl(?: 3 0)?(?: en)?(?: html| txt)?
lgpl-3.0 | text | lesser | gnu lesser general public license as published by the free software foundation either version 3 of the license
lgpl-3.0 | title | lesser | gnu lesser general public licen[sc]e v?(?:ersion )?3(?: 0)?
lgpl-3.0 | title | lgpl | lgpl ?v?(?:ersion )?3(?: 0)?(?: only| or later)?
lgpl-3.0 | title | lgplv3 | lgplv3
lgpl | name | lesser | (?:the )?(?:gnu )?lesser general public licen[sc]e
lgpl | name | lgpl | lgpl(?: licen[sc]ed?)?
agpl-3.0 | tag | spdx | spdx license identifiers? agpl 3 0(?: only| or later)?
agpl-3.0 | tag | gnu | gnu org licenses agpl(?: 3 0)?(?: en)?(?: html| txt)?
agpl-3.0 | text | affero | under the terms of the gnu affero general public license
agpl-3.0 | title | affero | (?:gnu )?affero general public licen[sc]e v?(?:ersion )?3(?: 0)?
agpl-3.0 | title | agpl | agpl ?v?(?:ersion )?3(?: 0)?(?: only| or later)?
agpl-3.0 | title | agplv3 | agplv3
agpl | name | affero | (?:gnu )?affero general public licen[sc]e
agpl | name | agpl | agpl(?: licen[sc]ed?)?
gfdl-1.3 | tag | spdx | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.3 | title | documentation | gnu free documentation licen[sc]e v?(?:ersion )?1 3
gfdl-1.2 | title | documentation | gnu free documentation licen[sc]e v?(?:ersion )?1 2
gfdl | text | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | name | documentation | (?:gnu )?free documentation licen[sc]e
bsd-2-clause | tag | spdx | spdx license identifiers? bsd 2 clause
bsd-2-clause | tag | opensource | opensource org licenses bsd 2 clause
bsd-2-clause | title | bsd | (?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)(?: licen[sc]e)?
bsd-3-clause | tag | spdx | spdx license identifiers? bsd 3 clause
bsd-3-clause | tag | opensource | opensource org licenses bsd 3 clause
bsd-3-clause | text | endorse | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause | title | bsd | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?
bsd-4-clause | tag | spdx | spdx license identifier bsd 4 clause
bsd-4-clause | text | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-4-clause | title | bsd | (?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?
bsd-0-clause | tag | spdx | spdx license identifier 0bsd
bsd-0-clause | title | bsd | (?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?
bsd | text | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | text | redistributions | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | text | redistributions | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd | name | bsd | (?:the )?bsd(?: style)? licen[sc]ed?
isc | tag | spdx | spdx license identifier isc
isc | tag | opensource | opensource org licenses isc
isc | text | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | name | isc | (?:the )?isc licen[sc]e
mpl-1.0 | tag | spdx | spdx license identifier mpl 1 0
mpl-1.0 | title | mozilla | mozilla public licen[sc]e v?(?:ersion )?1 0
mpl-1.1 | tag | spdx | spdx license identifier mpl 1 1
mpl-1.1 | tag | mozilla | mozilla org mpl mpl 1 1(?: html| txt)?
mpl-1.1 | text | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.1 | title | mozilla | mozilla public licen[sc]e v?(?:ersion )?1 1
mpl-1.1 | title | mpl | mpl 1 1
mpl-2.0 | tag | spdx | spdx license identifiers? mpl 2 0
mpl-2.0 | tag | mozilla | mozilla org (?:en us )?mpl 2 0
mpl-2.0 | text | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | title | mozilla | mozilla public licen[sc]e v?(?:ersion )?2(?: 0)?
mpl-2.0 | title | mpl | mpl 2 0
mpl | name | mozilla | mozilla public licen[sc]e
epl-1.0 | tag | spdx | spdx license identifier epl 1 0
epl-1.0 | tag | eclipse | eclipse org legal epl v10(?: html)?
epl-1.0 | title | eclipse | eclipse public licen[sc]e v?(?:ersion )?1(?: 0)?
epl-2.0 | tag | spdx | spdx license identifiers? epl 2 0
epl-2.0 | tag | eclipse | eclipse org legal epl (?:v20|2 0)(?: html)?
epl-2.0 | title | eclipse | eclipse public licen[sc]e v?(?:ersion )?2(?: 0)?
epl | name | eclipse | eclipse public licen[sc]e
edl-1.0 | title | eclipse | eclipse distribution licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
cpl-1.0 | tag | spdx | spdx license identifier cpl 1 0
cpl-1.0 | title | common | common public licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
cddl-1.0 | tag | spdx | spdx license identifier cddl 1 0
cddl-1.0 | title | common | common development and distribution licen[sc]e v?(?:ersion )?1(?: 0)?
cddl-1.1 | tag | spdx | spdx license identifier cddl 1 1
cddl-1.1 | title | common | common development and distribution licen[sc]e v?(?:ersion )?1 1
cddl | name | common | common development and distribution licen[sc]e
cddl | name | cddl | cddl(?: licen[sc]ed?)?
cpal-1.0 | title | common | common public attribution licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
ms-pl | tag | spdx | spdx license identifier ms pl
ms-pl | title | microsoft | microsoft public licen[sc]e
ms-rl | tag | spdx | spdx license identifier ms rl
ms-rl | title | microsoft | microsoft reciprocal licen[sc]e
artistic-1.0 | tag | spdx | spdx license identifier artistic 1 0
artistic-1.0 | title | artistic | artistic licen[sc]e v?(?:ersion )?1(?: 0)?
artistic-2.0 | tag | spdx | spdx license identifier artistic 2 0
artistic-2.0 | title | artistic | artistic licen[sc]e v?(?:ersion )?2(?: 0)?
artistic | text | perl | under the same terms as perl itself
artistic | name | artistic | (?:the )?artistic licen[sc]e
bsl-1.0 | tag | spdx | spdx license identifiers? bsl 1 0
bsl-1.0 | tag | boost | boost org license 1 0(?: txt)?
bsl-1.0 | text | boost | distributed under the boost software licen[sc]e(?: version 1 0)?
bsl-1.0 | title | boost | boost software licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
busl-1.1 | tag | spdx | spdx license identifier busl 1 1
busl-1.1 | title | business | business source licen[sc]e(?: v?(?:ersion )?1 1)?
sspl-1.0 | tag | spdx | spdx license identifier sspl 1 0
sspl-1.0 | title | server | server side public licen[sc]e(?: v?(?:ersion )?1)?
elastic-2.0 | tag | spdx | spdx license identifier elastic 2 0
elastic-2.0 | title | elastic | elastic licen[sc]e v?(?:ersion )?2(?: 0)?
commons-clause | title | commons | commons clause(?: licen[sc]e)?(?: condition)?
zlib | tag | spdx | spdx license identifier zlib
zlib | text | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | text | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | name | zlib | zlib(?: libpng)? licen[sc]e
libpng | tag | spdx | spdx license identifier libpng(?: 2 0)?
libpng | name | libpng | libpng licen[sc]e
openssl | tag | spdx | spdx license identifier openssl
openssl | text | openssl | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | name | openssl | openssl licen[sc]e
curl | tag | spdx | spdx license identifier curl
python-2.0 | tag | spdx | spdx license identifier (?:psf|python) 2 0
python-2.0 | text | python | python software foundation license version 2
python | name | python | python software foundation licen[sc]e
php-3.01 | tag | spdx | spdx license identifier php 3 01
php-3.01 | title | php | php licen[sc]e v?(?:ersion )?3 01
php | name | php | php licen[sc]e
ruby | tag | spdx | spdx license identifier ruby
ruby | name | ruby | ruby licen[sc]e
unlicense | tag | spdx | spdx license identifiers? unlicense
unlicense | tag | unlicense | unlicense org
unlicense | text | unencumbered | this is free and unencumbered software released into the public domain
unlicense | name | unlicense | the unlicense
wtfpl | tag | spdx | spdx license identifier wtfpl
wtfpl | title | wtfpl | wtfpl(?: v?(?:ersion )?2)?
wtfpl | name | want | do what the \S+ you want to public licen[sc]e
cc0-1.0 | tag | spdx | spdx license identifiers? cc0 1 0
cc0-1.0 | tag | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | title | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-nc-nd | tag | creativecommons | creativecommons org licenses by nc nd (?:[1-4] [05])
cc-by-nc-nd | title | nc | cc by nc nd(?: [1-4](?: [05])?)?
cc-by-nc-nd | title | deriv | attribution non ?commercial no ?deriv\S*(?: works)?(?: [1-4](?: [05])?)?
cc-by-nc-sa | tag | creativecommons | creativecommons org licenses by nc sa (?:[1-4] [05])
cc-by-nc-sa | title | nc | cc by nc sa(?: [1-4](?: [05])?)?
cc-by-nc-sa | title | attribution | attribution non ?commercial share ?alike(?: [1-4](?: [05])?)?
cc-by-nc | tag | creativecommons | creativecommons org licenses by nc (?:[1-4] [05])
cc-by-nc | text | licensed | licensed under (?:a |the )?cc by nc(?: [1-4](?: [05])?)?
cc-by-nc | title | nc | cc by nc(?: [1-4](?: [05])?)?
cc-by-nc | title | attribution | attribution non ?commercial(?: [1-4](?: [05])?)?(?: international)?
cc-by-nd | tag | creativecommons | creativecommons org licenses by nd (?:[1-4] [05])
cc-by-nd | title | nd | cc by nd(?: [1-4](?: [05])?)?
cc-by-sa | tag | creativecommons | creativecommons org licenses by sa (?:[1-4] [05])
cc-by-sa | title | sa | cc by sa(?: [1-4](?: [05])?)?
cc-by-sa | title | attribution | attribution share ?alike(?: [1-4](?: [05])?)?(?: international)?
cc-by | tag | creativecommons | creativecommons org licenses by (?:[1-4] [05])
cc-by | title | by | cc by(?: [1-4](?: [05])?)?
cc-by | title | attribution | creative commons attribution(?: [1-4](?: [05])?)?(?: international)?(?: licen[sc]e)?
cc | name | commons | creative commons(?: licen[sc]e)?
odbl-1.0 | tag | spdx | spdx license identifier odbl 1 0
odbl-1.0 | title | database | open (?:data commons open )?database licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
odc-by-1.0 | title | commons | open data commons attribution licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
pddl-1.0 | title | domain | (?:open data commons )?public domain dedication and licen[sc]e
cdla-permissive | title | data | community data licen[sc]e agreement permissive(?: v?(?:ersion )?[12](?: 0)?)?
ofl-1.1 | tag | spdx | spdx license identifier ofl 1 1
ofl-1.1 | tag | ofl | scripts sil org ofl
ofl-1.1 | text | font | this font software is licensed under the sil open font licen[sc]e version 1 1
ofl-1.1 | title | font | (?:sil )?open font licen[sc]e(?: v?(?:ersion )?1 1)?
openrail | title | rail | (?:bigscience |creativeml )?open ?rail(?: m)?(?: licen[sc]e)?
llama | title | llama | llama [234](?: [123])? community licen[sc]e(?: agreement)?
eupl-1.2 | tag | spdx | spdx license identifier eupl 1 2
eupl-1.2 | title | european | european union public licen[sc]e v?(?:ersion )?1 2
eupl | name | european | european union public licen[sc]e
cecill-2.1 | tag | spdx | spdx license identifier cecill 2 1
cecill | name | cecill | (?:licence )?cecill(?: b| c)?(?: licen[sc]e)?
osl-3.0 | tag | spdx | spdx license identifier osl 3 0
osl-3.0 | title | open | open software licen[sc]e v?(?:ersion )?3(?: 0)?
afl-3.0 | title | academic | academic free licen[sc]e v?(?:ersion )?3(?: 0)?
ncsa | name | ncsa | (?:university of illinois )?ncsa open source licen[sc]e
postgresql | name | postgresql | postgresql licen[sc]e
upl-1.0 | title | universal | universal permissive licen[sc]e(?: v?(?:ersion )?1(?: 0)?)?
w3c | name | w3c | w3c (?:software notice and |software and document )?licen[sc]e
unicode | name | unicode | unicode (?:inc )?licen[sc]e agreement
public-domain | text | domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | name | domain | public domain
proprietary | text | proprietary | (?:this (?:software|document|work) is )?proprietary and confidential
proprietary | text | unauthorized | unauthorized (?:copying|reproduction|distribution|use) (?:\S+ ){0,8}(?:is )?(?:strictly )?prohibited
all-rights-reserved | hint | rights | all rights reserved
unknown-license | hint | licen | (?:licensed|released|distributed) under (?:the terms of )?(?:the |an? )?(?:\S+ ){0,3}licen[sc]e
"""


def _signature(line: str) -> Signature:
    return Signature(*[field.strip() for field in line.split(" | ")])


SIGNATURES: tuple[Signature, ...] = tuple(_signature(x) for x in _RULES.strip().splitlines())
