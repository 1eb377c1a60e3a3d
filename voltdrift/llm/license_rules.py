"""Signatures of licences: hand-written patterns, in order of priority.

A line is ``label; keyword; pattern``. Patterns are regular expressions over
lower-case text in which a space stands for whatever separates two words. The
keyword is a word of every text that the pattern matches. Of two detections one
inside the other, the one of the higher tier (the earlier table) stands.
"""

#: Identifiers that stand in tags; the label is the identifier in lower case.
IDENTIFIERS = """
0BSD AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0
Artistic-1.0 Artistic-2.0 Beerware BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear
BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0
CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5
CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CPAL-1.0 CPL-1.0 ECL-2.0
EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0
GPL-3.0-only GPL-3.0-or-later HPND ICU IJG ImageMagick IPL-1.0 ISC JSON LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later
LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later Libpng LPPL-1.3c MirOS MIT MIT-0
MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA NPL-1.1 ODbL-1.0 ODC-By-1.0 OFL-1.0 OFL-1.1 OpenSSL OSL-1.0
OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unicode-DFS-2016
Unlicense UPL-1.0 Vim W3C WTFPL X11 XFree86-1.1 Zlib ZPL-2.0 ZPL-2.1
"""

#: Wording of grants and conditions, which names its licence beyond doubt, and addresses of licence texts.
WORDING = """
apache-2.0; apache; licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0; apache; www apache org licenses license 2 0
apache-2.0; perpetual; a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce
apache-1.1; redistribution; the end user documentation included with the redistribution if any must include the following acknowledg(?:e)?ment
apache-2.0; contributor; each contributor hereby grants to you a perpetual worldwide non exclusive no charge
mit; hereby; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit; sublicense; without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
mit; substantial; the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit; opensource; opensource org licenses mit(?: license)?
isc; purpose; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc; opensource; opensource org licenses isc
0bsd; purpose; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-2-clause; redistributions; redistributions of source code must retain the above copyright notice this list of conditions
bsd-2-clause; redistributions; redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd-3-clause; endorse; may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause; advertising; all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd; opensource; opensource org licenses bsd(?: license)?
bsd-2-clause; opensource; opensource org licenses bsd 2 clause
bsd-3-clause; opensource; opensource org licenses bsd 3 clause
gpl-2.0-or-later; redistribute; you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0-or-later; redistribute; you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl; redistribute; you can redistribute it and or modify it under the (?:same )?terms of the gnu general public license
lgpl-2.1-or-later; redistribute; you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3.0-or-later; redistribute; you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3
lgpl-2.0-or-later; redistribute; you can redistribute it and or modify it under the terms of the gnu library general public license
lgpl; redistribute; you can redistribute it and or modify it under the terms of the gnu lesser general public license
agpl-3.0-or-later; redistribute; you can redistribute it and or modify it under the terms of the gnu affero general public license
gfdl; permission; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl; invariant; with no invariant sections no front cover texts and no back cover texts
gpl; gnu; www gnu org licenses gpl(?: html| txt)?
gpl-2.0; gnu; www gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0; gnu; www gnu org licenses gpl 3 0
lgpl; gnu; www gnu org licenses lgpl(?: html| txt)?
agpl; gnu; www gnu org licenses agpl(?: html| txt| 3 0)?
gfdl; gnu; www gnu org (?:licenses|copyleft) fdl
gnu; gnu; www gnu org licenses
mpl-2.0; mozilla; this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0; mozilla; (?:www )?mozilla org mpl 2 0
mpl-1.1; mozilla; (?:www )?mozilla org mpl mpl 1 1
mpl-1.1; mozilla; subject to the mozilla public license version 1 1
mpl; mozilla; (?:www )?mozilla org mpl
epl-2.0; eclipse; made available under the terms of the eclipse public license (?:v )?2 0
epl-1.0; eclipse; made available under the terms of the eclipse public license v1 0
epl; eclipse; www eclipse org (?:legal|org documents) epl
cddl; distribution; subject to the terms of the common development and distribution license
cddl; cddl; opensource org licenses cddl1
cddl; distribution; the contents of this file are subject to the terms of the common development and distribution license
bsl-1.0; boost; distributed under the boost software license version 1 0
bsl-1.0; boost; www boost org license 1 0 txt
zlib; misrepresented; the origin of this software must not be misrepresented
zlib; altered; altered source versions must be plainly marked as such and must not be misrepresented
unlicense; unencumbered; this is free and unencumbered software released into the public domain
unlicense; unlicense; (?:www )?unlicense org
wtfpl; wtfpl; (?:www|sam) (?:wtfpl net|zoy org wtfpl)
beerware; beer; the beer ware license revision 42
json; evil; the software shall be used for good not evil
openssl; openssl; this product includes software developed by the openssl project
ofl-1.1; scripts; scripts sil org ofl
ofl-1.1; font; this font software is licensed under the sil open font license version 1 1
ofl; font; reserved font name
ncsa; illinois; university of illinois ncsa open source license
postgresql; written; permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
python-2.0; python; psf license agreement for python
php; php; this product includes php software
w3c; w3c; w3c software notice and (?:document )?license
x11; consortium; except as contained in this notice the name of the x consortium
cc0-1.0; creativecommons; creativecommons org publicdomain zero 1 0
cc-pdm; creativecommons; creativecommons org publicdomain mark 1 0
cc-by-4.0; creativecommons; creativecommons org licenses by 4 0
cc-by-3.0; creativecommons; creativecommons org licenses by 3 0
cc-by-2.0; creativecommons; creativecommons org licenses by 2 0
cc-by-sa-4.0; creativecommons; creativecommons org licenses by sa 4 0
cc-by-sa-3.0; creativecommons; creativecommons org licenses by sa 3 0
cc-by-nc-4.0; creativecommons; creativecommons org licenses by nc 4 0
cc-by-nc-3.0; creativecommons; creativecommons org licenses by nc 3 0
cc-by-nd-4.0; creativecommons; creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0; creativecommons; creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0; creativecommons; creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0; creativecommons; creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0; creativecommons; creativecommons org licenses by nc nd 3 0
odbl-1.0; opendatacommons; opendatacommons org licenses odbl
odc-by-1.0; opendatacommons; opendatacommons org licenses by
pddl-1.0; opendatacommons; opendatacommons org licenses pddl
cc0-1.0; waived; to the extent possible under law .{0,200}?waived all copyright and related or neighboring rights
proprietary; confidential; this (?:document|software|file) (?:is|contains) (?:proprietary and confidential|confidential and proprietary)
proprietary; unauthorized; unauthorized (?:copying|use|reproduction|distribution) (?:of|or) .{0,80}?(?:is )?strictly prohibited
proprietary; reproduced; no part of this (?:publication|book|document|work) may be reproduced
"""

#: Full names with their version.
VERSIONED = """
apache-1.1; apache; apache (?:software )?license (?:version )?(?:v )?1 1
apache-2.0; apache; apache (?:software )?license (?:version )?(?:v )?2(?: 0)?
apache-2.0; apache; apache license v2(?: 0)?
apache-2.0; apache; apache 2(?: 0)? licen[sc]e
apache-2.0; asl; asl 2 0
gpl-1.0; gnu; gnu general public licen[sc]e (?:version|v) 1
gpl-2.0; gnu; gnu general public licen[sc]e (?:version|v) 2(?: 0)?
gpl-2.0; gnu; gnu general public licen[sc]e v2(?: 0)?
gpl-2.0-or-later; gnu; gnu general public licen[sc]e (?:version|v) 2(?: 0)? or (?:any )?later
gpl-3.0; gnu; gnu general public licen[sc]e (?:version|v) 3(?: 0)?
gpl-3.0; gnu; gnu general public licen[sc]e v3(?: 0)?
gpl-3.0-or-later; gnu; gnu general public licen[sc]e (?:version|v) 3(?: 0)? or (?:any )?later
lgpl-2.0; gnu; gnu library general public licen[sc]e (?:version|v) 2(?: 0)?
lgpl-2.1; gnu; gnu lesser general public licen[sc]e (?:version|v) 2 1
lgpl-2.1; gnu; gnu lesser general public licen[sc]e v2 1
lgpl-3.0; gnu; gnu lesser general public licen[sc]e (?:version|v) 3(?: 0)?
lgpl-3.0; gnu; gnu lesser general public licen[sc]e v3(?: 0)?
agpl-3.0; gnu; gnu affero general public licen[sc]e (?:version|v) 3(?: 0)?
agpl-3.0; gnu; gnu affero general public licen[sc]e v3(?: 0)?
gfdl-1.1; documentation; gnu free documentation licen[sc]e (?:version|v) 1 1
gfdl-1.2; documentation; gnu free documentation licen[sc]e (?:version|v) 1 2
gfdl-1.3; documentation; gnu free documentation licen[sc]e (?:version|v) 1 3
mpl-1.0; mozilla; mozilla public licen[sc]e (?:version|v) 1 0
mpl-1.1; mozilla; mozilla public licen[sc]e (?:version|v) 1 1
mpl-2.0; mozilla; mozilla public licen[sc]e (?:version |v )?2 0
mpl-2.0; mozilla; mozilla public licen[sc]e v2(?: 0)?
epl-1.0; eclipse; eclipse public licen[sc]e (?:version |v )?(?:v)?1 0
epl-2.0; eclipse; eclipse public licen[sc]e (?:version |v )?(?:v)?2 0
eupl-1.1; european; european union public licen[sc]e (?:version |v )?(?:v)?1 1
eupl-1.2; european; european union public licen[sc]e (?:version |v )?(?:v)?1 2
cddl-1.0; distribution; common development and distribution licen[sc]e (?:version |v )?(?:v)?1 0
cddl-1.1; distribution; common development and distribution licen[sc]e (?:version |v )?(?:v)?1 1
cpl-1.0; common; common public licen[sc]e (?:version |v )?(?:v)?1 0
bsl-1.0; boost; boost software licen[sc]e (?:version |v )?(?:v)?1 0
busl-1.1; business; business source licen[sc]e (?:version |v )?1 1
sspl-1.0; server; server side public licen[sc]e (?:version |v )?(?:v)?1
artistic-1.0; artistic; artistic licen[sc]e (?:version |v )?1 0
artistic-2.0; artistic; artistic licen[sc]e (?:version |v )?2 0
afl-2.1; academic; academic free licen[sc]e (?:version |v )?2 1
afl-3.0; academic; academic free licen[sc]e (?:version |v )?3 0
osl-3.0; open; open software licen[sc]e (?:version |v )?3 0
ofl-1.1; font; (?:sil )?open font licen[sc]e (?:version |v )?1 1
python-2.0; python; python software foundation licen[sc]e version 2
php-3.01; php; php licen[sc]e (?:version |v )?3 01
php-3.0; php; php licen[sc]e (?:version |v )?3 0
zpl-2.1; zope; zope public licen[sc]e (?:version |v )?2 1
zpl-2.0; zope; zope public licen[sc]e (?:version |v )?2 0
lppl-1.3c; latex; latex project public licen[sc]e (?:version |v )?1 3c?
qpl-1.0; public; q public licen[sc]e (?:version |v )?1 0
apsl-2.0; apple; apple public source licen[sc]e (?:version |v )?2 0
npl-1.1; netscape; netscape public licen[sc]e (?:version |v )?1 1
mulanpsl-2.0; mulan; mulan permissive software licen[sc]e v2
bsd-2-clause; clause; (?:2|two) clause bsd(?: licen[sc]e)?
bsd-2-clause; clause; bsd (?:2|two) clause(?: licen[sc]e)?
bsd-2-clause; simplified; simplified bsd(?: licen[sc]e)?
bsd-2-clause; freebsd; freebsd licen[sc]e
bsd-3-clause; clause; (?:3|three) clause bsd(?: licen[sc]e)?
bsd-3-clause; clause; bsd (?:3|three) clause(?: licen[sc]e)?
bsd-3-clause; revised; revised bsd(?: licen[sc]e)?
bsd-3-clause; modified; modified bsd(?: licen[sc]e)?
bsd-3-clause; new; new bsd licen[sc]e
bsd-4-clause; clause; (?:4|four) clause bsd(?: licen[sc]e)?
bsd-4-clause; clause; bsd (?:4|four) clause(?: licen[sc]e)?
bsd-4-clause; original; original bsd licen[sc]e
cc-by-4.0; attribution; creative commons attribution 4 0(?: international)?
cc-by-3.0; attribution; creative commons attribution 3 0(?: unported)?
cc-by-2.5; attribution; creative commons attribution 2 5
cc-by-2.0; attribution; creative commons attribution 2 0(?: generic)?
cc-by-sa-4.0; attribution; creative commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0; attribution; creative commons attribution share ?alike 3 0(?: unported)?
cc-by-nc-4.0; attribution; creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nc-3.0; attribution; creative commons attribution non ?commercial 3 0(?: unported)?
cc-by-nd-4.0; attribution; creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-nc-sa-4.0; attribution; creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-sa-3.0; attribution; creative commons attribution non ?commercial share ?alike 3 0(?: unported)?
cc-by-nc-nd-4.0; attribution; creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-nc-nd-3.0; attribution; creative commons attribution non ?commercial no ?deriv(?:ative)?s 3 0(?: unported)?
cc-by-nc-nd-4.0; cc; cc by nc nd 4 0
cc-by-nc-nd-3.0; cc; cc by nc nd 3 0
cc-by-nc-sa-4.0; cc; cc by nc sa 4 0
cc-by-nc-sa-3.0; cc; cc by nc sa 3 0
cc-by-nc-4.0; cc; cc by nc 4 0
cc-by-nc-3.0; cc; cc by nc 3 0
cc-by-nd-4.0; cc; cc by nd 4 0
cc-by-sa-4.0; cc; cc by sa 4 0
cc-by-sa-3.0; cc; cc by sa 3 0
cc-by-4.0; cc; cc by 4 0
cc-by-3.0; cc; cc by 3 0
cc0-1.0; cc0; cc0 1 0(?: universal)?
gpl-2.0; gpl; gpl (?:version |v )?2(?: 0)?
gpl-2.0; gplv2; gplv2
gpl-2.0-or-later; gplv2; gplv2 or later
gpl-2.0-or-later; gpl; gpl (?:version |v )?2(?: 0)? or later
gpl-3.0; gpl; gpl (?:version |v )?3(?: 0)?
gpl-3.0; gplv3; gplv3
gpl-3.0-or-later; gplv3; gplv3 or later
lgpl-2.1; lgpl; lgpl (?:version |v )?2 1
lgpl-2.1; lgplv2; lgplv2 1
lgpl-3.0; lgpl; lgpl (?:version |v )?3(?: 0)?
lgpl-3.0; lgplv3; lgplv3
agpl-3.0; agpl; agpl (?:version |v )?3(?: 0)?
agpl-3.0; agplv3; agplv3
mpl-1.1; mpl; mpl (?:version |v )?1 1
mpl-2.0; mpl; mpl (?:version |v )?2 0
epl-1.0; epl; epl (?:version |v )?1 0
epl-2.0; epl; epl (?:version |v )?2 0
"""

#: Names without a version.
NAMES = """
agpl; affero; (?:gnu )?affero general public licen[sc]e
lgpl; lesser; (?:gnu )?lesser general public licen[sc]e
lgpl; library; (?:gnu )?library general public licen[sc]e
gfdl; documentation; (?:gnu )?free documentation licen[sc]e
gpl; gnu; gnu general public licen[sc]e
gpl; gnu; gnu public licen[sc]e
gpl; gnu; gnu gpl
lgpl; gnu; gnu lgpl
apache; apache; apache (?:software )?licen[sc]e
mit; mit; (?:the )?mit licen[sc]e
mit; mit; mit licen[sc]ed
mit; mit; licen[sc]ed under (?:the )?mit
mit; expat; expat licen[sc]e
mit; mit; mit x11 licen[sc]e
x11; x11; x11 licen[sc]e
isc; isc; isc licen[sc]e
bsd; bsd; bsd licen[sc]e
bsd; bsd; bsd style licen[sc]e
bsd; bsd; licen[sc]ed under (?:the )?bsd
mpl; mozilla; mozilla public licen[sc]e
epl; eclipse; eclipse public licen[sc]e
eupl; european; european union public licen[sc]e
cddl; distribution; common development and distribution licen[sc]e
cpl; common; common public licen[sc]e
cpal; attribution; common public attribution licen[sc]e
bsl; boost; boost software licen[sc]e
busl; business; business source licen[sc]e
sspl; server; server side public licen[sc]e
commons-clause; commons; commons clause
elastic; elastic; elastic licen[sc]e
polyform; polyform; polyform (?:noncommercial|small business|shield|strict|perimeter|internal use) licen[sc]e
artistic; artistic; (?:the )?artistic licen[sc]e
perl; perl; same terms as perl(?: itself)?
ruby; ruby; ruby licen[sc]e
python; python; python (?:software foundation )?licen[sc]e
psf; psf; psf licen[sc]e
php; php; php licen[sc]e
postgresql; postgresql; postgresql licen[sc]e
zlib; zlib; zlib(?: libpng)? licen[sc]e
libpng; libpng; libpng licen[sc]e
openssl; openssl; openssl licen[sc]e
ssleay; ssleay; (?:original )?ssleay licen[sc]e
vim; vim; vim licen[sc]e
icu; icu; icu licen[sc]e
unicode; unicode; unicode (?:terms of use|data files and software licen[sc]e|licen[sc]e agreement)
imagemagick; imagemagick; imagemagick licen[sc]e
ijg; jpeg; independent jpeg group
freetype; freetype; freetype (?:project )?licen[sc]e
ofl; font; (?:sil )?open font licen[sc]e
lppl; latex; latex project public licen[sc]e
qpl; public; q public licen[sc]e
zpl; zope; zope public licen[sc]e
npl; netscape; netscape public licen[sc]e
apsl; apple; apple public source licen[sc]e
ipl; ibm; ibm public licen[sc]e
ms-pl; microsoft; microsoft public licen[sc]e
ms-rl; microsoft; microsoft reciprocal licen[sc]e
cecill; cecill; cecill(?: b| c)?(?: licen[sc]e)?
ncsa; ncsa; (?:uiuc )?ncsa (?:open source )?licen[sc]e
afl; academic; academic free licen[sc]e
osl; open; open software licen[sc]e
ecl; educational; educational community licen[sc]e
upl; universal; universal permissive licen[sc]e
hpnd; historical; historical permission notice and disclaimer
w3c; w3c; w3c licen[sc]e
mulan; mulan; mulan (?:permissive software|public) licen[sc]e
beerware; beerware; beerware licen[sc]e
wtfpl; fuck; do what the fuck you want to public licen[sc]e
unlicense; unlicense; (?:the )?unlicense
odbl; database; open database licen[sc]e
odc-by; commons; open data commons attribution licen[sc]e
pddl; public; public domain dedication and licen[sc]e
ogl; government; open government licen[sc]e
dl-de; datenlizenz; datenlizenz deutschland
etalab; ouverte; licence ouverte
rail; responsible; responsible ai licen[sc]e
rail; rail; (?:creativeml |bigscience )?open ?rail(?: m| d)?
llama; llama; llama (?:[234] )?community licen[sc]e
gemma; gemma; gemma terms of use
cc-by-nc-nd; cc; cc by nc nd
cc-by-nc-sa; cc; cc by nc sa
cc-by-nc; cc; cc by nc
cc-by-nd; cc; cc by nd
cc-by-sa; cc; cc by sa
cc0; cc0; cc0
cc-by-nc-nd; attribution; attribution non ?commercial no ?deriv(?:ative)?s
cc-by-nc-sa; attribution; attribution non ?commercial share ?alike
cc-by-nc; attribution; attribution non ?commercial
cc-by-nd; attribution; attribution no ?deriv(?:ative)?s
cc-by-sa; attribution; attribution share ?alike
cc-by; attribution; creative commons attribution
cc; creative; creative commons(?: licen[sc]e)?
cc; creative; licence creative commons
cc; creative; creative commons lizenz
cc; creative; licencia creative commons
public-domain; domain; (?:in|into) the public domain
public-domain; domain; public domain (?:work|dedication|mark)
public-domain; domaine; (?:dans le )?domaine public
public-domain; gemeinfrei; gemeinfrei
public-domain; dominio; dominio p\xc3\xbablico
"""

#: Abbreviations and wording that says a licence applies, without naming it.
MENTIONS = """
agpl; agpl; agpl
lgpl; lgpl; lgpl
gpl; gpl; gpl
gfdl; gfdl; gfdl
mpl; mpl; mpl
wtfpl; wtfpl; wtfpl
copyleft; copyleft; copyleft
copyright; copyright; copyright (?:c )?(?:19|20)[0-9][0-9]
copyright; copyright; copyright \xc2\xa9 (?:19|20)[0-9][0-9]
copyright; copyright; copyright (?:by|of|held by)
copyright; urheberrecht; urheberrechtlich gesch\xc3\xbctzt
reserved; droits; tous droits r\xc3\xa9serv\xc3\xa9s
reserved; vorbehalten; alle rechte vorbehalten
reserved; derechos; todos los derechos reservados
reserved; diritti; tutti i diritti riservati
licensed; licensed; (?:is |are )?licensed under
licensed; released; (?:is |are )?released under (?:the|an?)
licensed; distributed; (?:is |are )?distributed under (?:the|an?)
licensed; terms; under the terms of the [a-z0-9]{1,40} licen[sc]e
licensed; license; see (?:the )?(?:file )?license (?:file )?for (?:details|more information)
licensed; license; license (?:file )?(?:for|in) the (?:root|top level)
licensed; lizenz; lizenziert unter
licensed; licence; sous licence
licensed; licencia; bajo (?:la )?licencia
eula; agreement; end user licen[sc]e agreement
eula; agreement; software licen[sc]e agreement
royalty-free; royalty; royalty free
no-derivatives; derivative; no derivative works
non-commercial; commercial; (?:for )?non commercial (?:use|purposes)
non-commercial; noncommercial; noncommercial (?:use|purposes)
attribution; attribution; with(?:out)? attribution
"""

#: Phrases whose places are counted, whatever else covers them.
BASE = """
cc-by; cc; cc by
gpl; general; general public license
reserved; reserved; all rights reserved
"""

#: Tiers from the highest, each with how sure a detection of it is.
TIERS = (("tags", 0.99), ("wording", 0.95), ("versioned", 0.8), ("names", 0.6), ("mentions", 0.3), ("base", 0.5))
