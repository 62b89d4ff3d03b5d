"""Signature rules of the license scan, as text: label | priority | pattern, in the order in which ties are settled.

Blanks in a pattern stand for any white space or marks.  Each line was written for one sentence, title, address or tag of
one license; labels are families.  Priority 1 is a license's own text or a tag, 2 an address or a full title with its
version, 3 a title, 4 a short name, 5 a hint.
"""

from __future__ import annotations

#: SPDX identifiers by label; each gives one rule for the tag "SPDX-License-Identifier: id".
SPDX = """
0bsd: 0bsd
afl: afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0
agpl: agpl-1.0 agpl-1.0-only agpl-1.0-or-later agpl-3.0 agpl-3.0-only agpl-3.0-or-later
apache: apache-1.0 apache-1.1 apache-2.0
apsl: apsl-1.0 apsl-2.0
artistic: artistic-1.0 artistic-1.0-perl artistic-2.0
beerware: beerware
blueoak: blueoak-1.0.0
bsd: bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause
bsl: bsl-1.0
busl: busl-1.1
cc-by: cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0
cc-by-nc: cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-2.5 cc-by-nc-3.0 cc-by-nc-4.0
cc-by-nc-nd: cc-by-nc-nd-3.0 cc-by-nc-nd-4.0
cc-by-nc-sa: cc-by-nc-sa-2.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0
cc-by-nd: cc-by-nd-3.0 cc-by-nd-4.0
cc-by-sa: cc-by-sa-1.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0
cc0: cc0-1.0
cddl: cddl-1.0 cddl-1.1
cecill: cecill-1.1 cecill-2.0 cecill-2.1 cecill-b cecill-c
cpl: cpl-1.0
curl: curl
ecl: ecl-1.0 ecl-2.0
elastic: elastic-2.0
epl: epl-1.0 epl-2.0
eupl: eupl-1.0 eupl-1.1 eupl-1.2
fdl: gfdl-1.1 gfdl-1.2 gfdl-1.3 gfdl-1.3-only gfdl-1.3-or-later
ftl: ftl
gpl: gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later
hpnd: hpnd
icu: icu
ijg: ijg
isc: isc
json: json
lgpl: lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later
libpng: libpng libpng-2.0
lppl: lppl-1.3a lppl-1.3c
mit: mit mit-0 mit-cmu mit-modern-variant
mpl: mpl-1.0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception
ms-pl: ms-pl ms-rl
mulan: mulanpsl-1.0 mulanpsl-2.0
ncsa: ncsa
odbl: odbl-1.0
odc-by: odc-by-1.0
ofl: ofl-1.0 ofl-1.1
openssl: openssl
osl: osl-1.0 osl-2.0 osl-2.1 osl-3.0
pddl: pddl-1.0
php: php-3.0 php-3.01
postgresql: postgresql
python: python-2.0 psf-2.0
qpl: qpl-1.0
ruby: ruby
sspl: sspl-1.0
unicode: unicode-dfs-2016 unicode-3.0
unlicense: unlicense
upl: upl-1.0
vim: vim
w3c: w3c w3c-20150513
wtfpl: wtfpl
x11: x11
zlib: zlib zlib-acknowledgement
zpl: zpl-1.1 zpl-2.0 zpl-2.1
"""

#: Sentences of the licenses' own texts.
SENTENCES = """
mit|1|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit|1|to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
mit|1|shall be included in all copies or substantial portions of the software
mit|1|in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit|2|the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit|2|whether in an action of contract tort or otherwise arising from out of or in connection with the software
x11|1|shall not be used in advertising or otherwise to promote the sale use or other dealings in this software
isc|1|permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
isc|1|the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
0bsd|1|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
hpnd|1|permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
apache|1|you may not use this file except in compliance with the license
apache|1|unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache|1|licensed to the apache software foundation asf under one or more contributor license agreements
apache|1|each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache|1|see the license for the specific language governing permissions and limitations under the license
apache|1|this product includes software developed by the apache software foundation
apache|1|you must cause any modified files to carry prominent notices stating that you changed the files
gpl|1|you can redistribute it and or modify it under the terms of the gnu general public license
gpl|1|either version \\d(?:\\.\\d)? of the license or at your option any later version
gpl|1|you should have received a copy of the gnu general public license
gpl|2|but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
gpl|1|everyone is permitted to copy and distribute verbatim copies of this license document
gpl|1|the licenses for most software are designed to take away your freedom to share and change it
gpl|1|the gnu general public license is a free copyleft license for software and other kinds of works
gpl|1|this general public license applies to most of the free software foundation s software
gpl|1|when we speak of free software we are referring to freedom not price
gpl|1|if you convey an object code work under this section in or with or specifically for use in a user product
gpl|1|you may not propagate or modify a covered work except as expressly provided under this license
lgpl|1|it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl|1|you should have received a copy of the gnu (?:lesser|library) general public license
lgpl|1|this version of the gnu lesser general public license incorporates the terms and conditions
lgpl|1|a program that contains no derivative of any portion of the library but is designed to work with the library
agpl|1|it and or modify it under the terms of the gnu affero general public license
agpl|1|you should have received a copy of the gnu affero general public license
agpl|1|all users interacting with it remotely through a computer network
fdl|1|permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
fdl|1|with no invariant sections no front cover texts and no back cover texts
bsd|1|redistributions of source code must retain the above copyright notice
bsd|1|redistributions in binary form must reproduce the above copyright notice
bsd|1|redistribution and use in source and binary forms with or without modification are permitted
bsd|1|may be used to endorse or promote products derived from this software
bsd|1|all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd|2|even if advised of the possibility of such damage
bsd|2|procurement of substitute goods or services loss of use data or profits or business interruption
mpl|1|this source code form is subject to the terms of the mozilla public license
mpl|1|the contents of this file are subject to the mozilla public license version
mpl|1|if a copy of the mpl was not distributed with this file
mpl|1|this source code form is incompatible with secondary licenses
mpl|1|you may distribute such executable form under the terms of this license or sublicense it under different terms
epl|1|this program and the accompanying materials are made available under the terms of the eclipse public license
epl|1|the accompanying program is provided under the terms of this eclipse public license
cpl|1|the accompanying program is provided under the terms of this common public license
cddl|1|the contents of this file are subject to the terms of the common development and distribution license
cddl|1|you can obtain a copy of the license at usr src opensolaris license
apsl|1|this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license
artistic|1|the intent of this document is to state the conditions under which a package may be copied
artistic|1|this license establishes the terms under which a given free software package may be copied modified distributed
artistic|1|you can redistribute it and or modify it under the same terms as perl itself
bsl|1|must be included in all copies of the software in whole or in part and all derivative works of the software
bsl|1|machine executable object code generated by a source language processor
busl|1|the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
busl|1|effective on the change date or the fourth anniversary of the first publicly available distribution
sspl|1|if you make the functionality of the program or a modified version available to third parties as a service
elastic|1|you may not provide the software to third parties as a hosted or managed service
zlib|1|altered source versions must be plainly marked as such
zlib|1|the origin of this software must not be misrepresented
zlib|1|this notice may not be removed or altered from any source distribution
libpng|1|the contributing authors and group 42 inc disclaim all warranties
openssl|1|this product includes software developed by the openssl project for use in the openssl toolkit
ssleay|1|this product includes cryptographic software written by eric young
ijg|1|this software is based in part on the work of the independent jpeg group
ftl|1|portions of this software are copyright (?:c )?\\d{4} the freetype project
curl|1|permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
python|1|psf hereby grants licensee a nonexclusive royalty free world wide license
python|1|this license agreement is between the python software foundation
php|1|this product includes php software freely available from
postgresql|1|permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ruby|1|you may make and give away verbatim copies of the source form of the software without restriction
ncsa|1|to deal with the software without restriction including without limitation the rights to use
w3c|1|by obtaining using and or copying this work you the licensee agree that you have read understood and will comply
ofl|1|this font software is licensed under the sil open font license
ofl|1|neither the font software nor any of its individual components in original or modified versions may be sold by itself
ofl|1|with reserved font name
unicode|1|free of charge to any person obtaining a copy of data files and any associated documentation
json|1|the software shall be used for good not evil
unlicense|1|this is free and unencumbered software released into the public domain
unlicense|1|anyone is free to copy modify publish use compile sell or distribute this software
unlicense|1|we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors
cc0|1|affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders
cc0|1|has waived all copyright and related or neighboring rights to this work
cc0|1|to the extent possible under law the (?:author|person|affirmer)
wtfpl|1|you just do what the fuck you want to
beerware|1|if we meet some day and you think this stuff is worth it you can buy me a beer
eupl|1|this european union public licen[cs]e the eupl applies to the work
lppl|1|this work may be distributed and or modified under the conditions of the latex project public license
lppl|1|this work has the lppl maintenance status
cecill|1|this software is governed by the cecill(?: [bc])? license under french law and abiding by the rules of distribution of free software
ms-pl|1|if you use the software you accept this license if you do not accept the license do not use the software
ms-pl|1|each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution
upl|1|any patent rights freely licensable by each licensor now or hereafter covering either i the unmodified software
zpl|1|names of the copyright holders must not be used to endorse or promote products
vim|1|there are no restrictions on distributing unmodified copies of vim except that they must include this license text
qpl|1|the intent of this license is to establish freedom to share and change the software regulated by this license under the open source model
mulan|1|is licensed under mulan psl v\\d
blueoak|1|this license gives everyone as much permission to work with this software as possible
odbl|1|is made available under the open database license
odbl|1|any rights in individual contents of the database are licensed under the database contents license
odc-by|1|is made available under the open data commons attribution license
pddl|1|is made available under the public domain dedication and license
cc|1|creative commons corporation is not a law firm and does not provide legal services
cc|1|by exercising the licensed rights you accept and agree to be bound by the terms and conditions of this creative commons
cc-by-nc|1|you may not exercise any of the rights granted to you in any manner that is primarily intended for or directed toward commercial advantage
cc-by-sa|1|you may distribute publicly display publicly perform or publicly digitally perform a derivative work only under the terms of this license
cc-by-sa|1|text is available under the creative commons attribution share ?alike license
ogl|1|contains public sector information licensed under the open government licen[cs]e
rail|1|use based restrictions as referenced in paragraph 5 must be included as an enforceable provision
llama|1|is licensed under the llama \\d(?:\\.\\d)? community license copyright
gemma|1|gemma is provided under and subject to the gemma terms of use
proprietary|1|unauthorized copying of this file via any medium is strictly prohibited
proprietary|1|no part of this publication may be reproduced distributed or transmitted in any form
proprietary|2|this software is the confidential and proprietary information of
proprietary|2|reproduction in whole or in part without (?:written )?permission is prohibited
"""

#: Addresses under which licenses stand.
ADDRESSES = """
apache|2|apache org licenses license 2 0
apache|2|apache org licenses license 1 1
apache|2|opensource org licenses apache 2 0
mit|2|opensource org licenses? mit
mit|2|mit license org
bsd|2|opensource org licenses? bsd [23] clause
bsd|3|opensource org licenses? bsd license
gpl|2|gnu org licenses gpl(?: [23] 0)?
gpl|2|gnu org licenses old licenses gpl 2 0
gpl|2|gnu org copyleft gpl
gpl|2|opensource org licenses? gpl [23] 0
lgpl|2|gnu org licenses lgpl(?: [23] [01])?
lgpl|2|gnu org licenses old licenses lgpl 2 1
lgpl|2|gnu org copyleft lesser
agpl|2|gnu org licenses agpl(?: 3 0)?
fdl|2|gnu org (?:licenses|copyleft) fdl
mpl|2|mozilla org mpl(?: [12] [01])?
epl|2|eclipse org legal epl(?: v?[12]0)?
epl|2|eclipse org org documents edl v10
cddl|2|opensource org licenses? cddl(?: 1 0| php)?
artistic|2|perlfoundation org artistic license 2 0
bsl|2|boost org license 1 0
zlib|2|zlib net zlib license
openssl|2|openssl org source license
php|2|php net license 3 0?1
python|2|docs python org 3 license
postgresql|2|postgresql org about licen[cs]e
unlicense|2|unlicense org
wtfpl|2|wtfpl net
ofl|2|scripts sil org ofl
eupl|2|joinup ec europa eu (?:software page|collection) eupl
cecill|2|cecill info licences
lppl|2|latex project org lppl
cc0|2|creativecommons org publicdomain zero 1 0
cc-pdm|2|creativecommons org publicdomain mark 1 0
cc-by|2|creativecommons org licenses by [1-4] [05]
cc-by-sa|2|creativecommons org licenses by sa [1-4] [05]
cc-by-nd|2|creativecommons org licenses by nd [1-4] [05]
cc-by-nc|2|creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa|2|creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd|2|creativecommons org licenses by nc nd [1-4] [05]
odbl|2|opendatacommons org licenses odbl
odc-by|2|opendatacommons org licenses by
pddl|2|opendatacommons org licenses pddl
ogl|2|nationalarchives gov uk doc open government licence
elastic|2|elastic co licensing elastic license
sspl|2|mongodb com licensing server side public license
busl|2|mariadb com bsl11
mulan|2|license coscl org cn mulanpsl2?
"""

#: Titles and short names.
NAMES = """
mit|3|the mit license
mit|3|mit license
mit|3|mit no attribution
mit|3|expat license
x11|3|x11 license
x11|3|mit x11 license
x11|3|x consortium license
apache|2|apache license,? version \\d(?:\\.\\d)?
apache|3|apache license
apache|3|apache software license
apache|4|apache 2\\.0
apache|4|apache 2 license
apache|4|asl 2\\.0
gpl|2|gnu general public license,? version \\d(?:\\.\\d)?
gpl|2|gnu general public license v\\d
gpl|3|gnu general public license
gpl|3|general public license
gpl|3|gnu gpl
gpl|4|gplv[123]
gpl|4|gpl v[123]
gpl|4|gpl version [123]
gpl|4|gpl license
gpl|4|gpl compatible
lgpl|2|gnu lesser general public license,? version \\d(?:\\.\\d)?
lgpl|3|lesser general public license
lgpl|3|library general public license
lgpl|4|lgplv[23](?:\\.1)?
lgpl|4|lgpl version [23](?:\\.1)?
lgpl|4|gnu lgpl
agpl|2|gnu affero general public license,? version \\d(?:\\.\\d)?
agpl|3|affero general public license
agpl|4|agplv3
agpl|4|gnu agpl
fdl|3|gnu free documentation license
fdl|4|gnu fdl
fdl|4|gfdl
bsd|3|(?:the )?(?:new|modified|revised) bsd license
bsd|3|(?:the )?(?:simplified|freebsd) bsd license
bsd|3|bsd license
bsd|3|bsd style license
bsd|4|bsd [1234] clause
bsd|4|[234] clause bsd
bsd|4|(?:two|three|four) clause bsd
0bsd|3|zero clause bsd
isc|3|isc license
isc|3|internet systems consortium license
mpl|2|mozilla public license,? (?:version|v) ?\\d(?:\\.\\d)?
mpl|3|mozilla public license
mpl|4|mpl [12]\\.[01]
mpl|4|mplv[12](?:\\.[01])?
epl|2|eclipse public license,? (?:version|v) ?\\d(?:\\.\\d)?
epl|3|eclipse public license
epl|3|eclipse distribution license
cpl|3|common public license
ipl|3|ibm public license
cddl|3|common development and distribution license
apsl|3|apple public source license
npl|3|netscape public license
spl|3|sun public license
eupl|3|european union public licen[cs]e
eupl|4|eupl v ?1\\.[012]
artistic|3|(?:the )?(?:perl |clarified |modified )?artistic license
bsl|3|boost software license
busl|3|business source license
sspl|3|server side public license
elastic|3|elastic license
commons-clause|3|commons clause license condition
unlicense|3|the unlicense
unlicense|4|unlicense
wtfpl|2|do what the fuck you want to public license
wtfpl|4|wtfpl
zlib|3|zlib license
zlib|3|zlib libpng license
libpng|3|libpng license
openssl|3|openssl license
python|3|python software foundation license
python|3|psf license agreement
php|3|php license
postgresql|3|postgresql licen[cs]e
ruby|3|ruby license
ncsa|3|university of illinois ncsa open source license
w3c|3|w3c software (?:and document )?(?:notice and )?license
afl|3|academic free license
osl|3|open software license
ecl|3|educational community license
ms-pl|3|microsoft public license
ms-pl|3|microsoft reciprocal license
qpl|3|q public license
ofl|3|sil open font license
ofl|3|open font license
ubuntu-font|3|ubuntu font licen[cs]e
upl|3|universal permissive license
vim|3|vim license
xfree86|3|xfree86 license
zpl|3|zope public license
beerware|3|beer ?ware license
lppl|3|latex project public license
cecill|3|cecill(?: [bc])? (?:free software )?license
mulan|3|mulan permissive software license
blueoak|3|blue oak model license
hpnd|3|historical permission notice and disclaimer
intel|3|intel simplified software license
nvidia|3|nvidia software license
cc0|2|cc0 1\\.0 universal
cc0|3|creative commons zero
cc0|4|cc0
cc-by-nc-sa|2|creative commons attribution non ?commercial share ?alike
cc-by-nc-sa|4|cc by nc sa(?: \\d(?:\\.\\d)?)?
cc-by-nc-nd|2|creative commons attribution non ?commercial no ?deriv(?:atives|s)
cc-by-nc-nd|4|cc by nc nd(?: \\d(?:\\.\\d)?)?
cc-by-nc|2|creative commons attribution non ?commercial
cc-by-nc|4|cc by nc(?: \\d(?:\\.\\d)?)?
cc-by-sa|2|creative commons attribution share ?alike
cc-by-sa|4|cc by sa(?: \\d(?:\\.\\d)?)?
cc-by-nd|2|creative commons attribution no ?deriv(?:atives|s)
cc-by-nd|4|cc by nd(?: \\d(?:\\.\\d)?)?
cc-by|3|creative commons attribution
cc-by|4|cc by(?: \\d(?:\\.\\d)?)?
cc|3|creative commons license
cc|4|creative commons
odbl|3|open data ?base license
odbl|4|odbl
odc-by|3|open data commons attribution license
pddl|3|public domain dedication and license
ogl|3|open government licen[cs]e
dbcl|3|database contents license
rail|3|(?:bigscience |creativeml )?open ?rail(?: m)? license
rail|3|responsible ai license
llama|3|llama (?:\\d(?:\\.\\d)? )?community license
gemma|3|gemma terms of use
falcon|3|falcon llm license
"""

#: Hints that a text has terms at all.
HINTS = """
gpl|4|licensed under (?:the )?(?:terms of (?:the )?)?gpl
bsd|4|(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?bsd
public-domain|3|(?:released (?:in)?to|dedicated to|placed in) the public domain
public-domain|4|is in the public domain
warranty|5|provided as is without (?:any )?warrant(?:y|ies)
warranty|5|without warranties or conditions of any kind
proprietary|4|proprietary and confidential
proprietary|5|commercial use (?:is )?(?:strictly )?prohibited
eula|3|end user license agreement
cla|3|contributor license agreement
copyright|5|all rights reserved
copyright|5|some rights reserved
copyright|5|copyright (?:c )?(?:19|20)\\d\\d
copyright|5|copyrighted material
copyleft|5|copyleft
"""


def listed() -> list[tuple[str, int, str]]:
    """(label, priority, pattern in words) of every rule, in order."""
    found = []
    for line in SPDX.strip().splitlines():
        label, ids = line.split(": ")
        found += [(label, 1, "spdx license identifier " + x.replace("-", " ").replace(".", "\\.")) for x in ids.split()]
    for section in (SENTENCES, ADDRESSES, NAMES, HINTS):
        for line in section.strip().splitlines():
            label, priority, pattern = line.split("|", 2)
            found.append((label, int(priority), pattern))
    return found
