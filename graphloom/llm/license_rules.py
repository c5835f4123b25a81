"""Signature rules for licence texts, in order of priority (earlier rules win).

One line per rule: ``label | keyword | pattern``.  The keyword is a lower-case
string that every match of the pattern contains; a rule is tried only on texts
that hold its keyword.  Patterns are Java regexes, matched without regard to
ASCII case; a blank stands for any run of white space, comment marks or quotes.
``#n`` starts a section whose rules share the confidence n / 100.
"""

from __future__ import annotations

_TEXT = r"""
#100
mit | spdx | SPDX-License-Identifier: MIT\b(?!-)
mit-0 | spdx | SPDX-License-Identifier: MIT-0\b
apache-2.0 | spdx | SPDX-License-Identifier: Apache-2\.0
apache-1.1 | spdx | SPDX-License-Identifier: Apache-1\.1
gpl-1.0 | spdx | SPDX-License-Identifier: GPL-1\.0
gpl-2.0-or-later | spdx | SPDX-License-Identifier: GPL-2\.0(?:\+|-or-later)
gpl-2.0 | spdx | SPDX-License-Identifier: GPL-2\.0(?:-only)?
gpl-3.0-or-later | spdx | SPDX-License-Identifier: GPL-3\.0(?:\+|-or-later)
gpl-3.0 | spdx | SPDX-License-Identifier: GPL-3\.0(?:-only)?
lgpl-2.0 | spdx | SPDX-License-Identifier: LGPL-2\.0(?:\+|-or-later|-only)?
lgpl-2.1-or-later | spdx | SPDX-License-Identifier: LGPL-2\.1(?:\+|-or-later)
lgpl-2.1 | spdx | SPDX-License-Identifier: LGPL-2\.1(?:-only)?
lgpl-3.0-or-later | spdx | SPDX-License-Identifier: LGPL-3\.0(?:\+|-or-later)
lgpl-3.0 | spdx | SPDX-License-Identifier: LGPL-3\.0(?:-only)?
agpl-3.0-or-later | spdx | SPDX-License-Identifier: AGPL-3\.0(?:\+|-or-later)
agpl-3.0 | spdx | SPDX-License-Identifier: AGPL-3\.0(?:-only)?
bsd-2-clause | spdx | SPDX-License-Identifier: BSD-2-Clause
bsd-3-clause | spdx | SPDX-License-Identifier: BSD-3-Clause
bsd-4-clause | spdx | SPDX-License-Identifier: BSD-4-Clause
0bsd | spdx | SPDX-License-Identifier: 0BSD
isc | spdx | SPDX-License-Identifier: ISC\b
zlib | spdx | SPDX-License-Identifier: Zlib\b
mpl-1.1 | spdx | SPDX-License-Identifier: MPL-1\.1
mpl-2.0 | spdx | SPDX-License-Identifier: MPL-2\.0
epl-1.0 | spdx | SPDX-License-Identifier: EPL-1\.0
epl-2.0 | spdx | SPDX-License-Identifier: EPL-2\.0
cddl-1.0 | spdx | SPDX-License-Identifier: CDDL-1\.0
eupl-1.1 | spdx | SPDX-License-Identifier: EUPL-1\.1
eupl-1.2 | spdx | SPDX-License-Identifier: EUPL-1\.2
unlicense | spdx | SPDX-License-Identifier: Unlicense
wtfpl | spdx | SPDX-License-Identifier: WTFPL
cc0-1.0 | spdx | SPDX-License-Identifier: CC0-1\.0
cc-by-nc-nd-4.0 | spdx | SPDX-License-Identifier: CC-BY-NC-ND-4\.0
cc-by-nc-sa-4.0 | spdx | SPDX-License-Identifier: CC-BY-NC-SA-4\.0
cc-by-nc-4.0 | spdx | SPDX-License-Identifier: CC-BY-NC-4\.0
cc-by-nd-4.0 | spdx | SPDX-License-Identifier: CC-BY-ND-4\.0
cc-by-sa-4.0 | spdx | SPDX-License-Identifier: CC-BY-SA-4\.0
cc-by-sa-3.0 | spdx | SPDX-License-Identifier: CC-BY-SA-3\.0
cc-by-4.0 | spdx | SPDX-License-Identifier: CC-BY-4\.0
cc-by-3.0 | spdx | SPDX-License-Identifier: CC-BY-3\.0
bsl-1.0 | spdx | SPDX-License-Identifier: BSL-1\.0
busl-1.1 | spdx | SPDX-License-Identifier: BUSL-1\.1
sspl-1.0 | spdx | SPDX-License-Identifier: SSPL-1\.0
artistic-1.0 | spdx | SPDX-License-Identifier: Artistic-1\.0
artistic-2.0 | spdx | SPDX-License-Identifier: Artistic-2\.0
python-2.0 | spdx | SPDX-License-Identifier: (?:Python|PSF)-2\.0
postgresql | spdx | SPDX-License-Identifier: PostgreSQL
ncsa | spdx | SPDX-License-Identifier: NCSA
openssl | spdx | SPDX-License-Identifier: OpenSSL
ofl-1.1 | spdx | SPDX-License-Identifier: OFL-1\.1
odbl-1.0 | spdx | SPDX-License-Identifier: ODbL-1\.0
pddl-1.0 | spdx | SPDX-License-Identifier: PDDL-1\.0
ms-pl | spdx | SPDX-License-Identifier: MS-PL
ms-rl | spdx | SPDX-License-Identifier: MS-RL
unknown-spdx | spdx | SPDX-License-Identifier: [A-Za-z0-9.+-]{2,60}
#98
mit | permission is hereby granted | Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the Software\), to deal in the Software without restriction
x11 | permission is hereby granted | Permission is hereby granted, free of charge, to any person obtaining a copy .{0,600} Except as contained in this notice, the name
hpnd | permission to use, copy, modify | Permission to use, copy, modify and distribute this software and its documentation for any purpose and without fee is hereby granted
isc | permission to use, copy, modify | Permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided
0bsd | permission to use, copy, modify | Permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted\.
postgresql | permission to use, copy, modify | Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted
apache-2.0 | apache license | Licensed under the Apache License,? Version 2\.0 \(the License\); you may not use this file except in compliance with the License
apache-2.0 | apache license | Apache License Version 2\.0, January 2004
apache-1.1 | apache software license | The Apache Software License, Version 1\.1
apache-1.0 | apache group | This product includes software developed by the Apache Group
gpl-3.0-or-later | free software foundation | under the terms of the GNU General Public License as published by the Free Software Foundation,? either version 3 of the License, or \(at your option\) any later version
gpl-2.0-or-later | free software foundation | under the terms of the GNU General Public License as published by the Free Software Foundation;? either version 2 of the License, or \(at your option\) any later version
gpl-1.0-or-later | free software foundation | under the terms of the GNU General Public License as published by the Free Software Foundation;? either version 1,? or \(at your option\) any later version
gpl-2.0 | free software foundation | under the terms of the GNU General Public License version 2 as published by the Free Software Foundation
gpl-3.0 | free software foundation | under the terms of the GNU General Public License version 3 as published by the Free Software Foundation
lgpl-3.0-or-later | free software foundation | under the terms of the GNU Lesser General Public License as published by the Free Software Foundation,? either version 3 of the License, or \(at your option\) any later version
lgpl-2.1-or-later | free software foundation | under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;? either version 2\.1 of the License, or \(at your option\) any later version
lgpl-2.0-or-later | free software foundation | under the terms of the GNU Library General Public License as published by the Free Software Foundation;? either version 2 of the License, or \(at your option\) any later version
agpl-3.0-or-later | free software foundation | under the terms of the GNU Affero General Public License as published by the Free Software Foundation,? either version 3 of the License, or \(at your option\) any later version
gfdl-1.3 | free documentation license | GNU Free Documentation License,? Version 1\.3
gfdl-1.2 | free documentation license | GNU Free Documentation License,? Version 1\.2
gfdl-1.1 | free documentation license | GNU Free Documentation License,? Version 1\.1
mpl-2.0 | mozilla public license | This Source Code Form is subject to the terms of the Mozilla Public License, v\. 2\.0
mpl-1.1 | mozilla public license | subject to the Mozilla Public License Version 1\.1
mpl-1.0 | mozilla public license | subject to the Mozilla Public License Version 1\.0
npl-1.1 | netscape public license | subject to the Netscape Public License Version 1\.1
epl-2.0 | eclipse public license | made available under the terms of the Eclipse Public License (?:v|version )?2\.0
epl-1.0 | eclipse public license | made available under the terms of the Eclipse Public License v1\.0
cpl-1.0 | common public license | made available under the terms of the Common Public License v1\.0
edl-1.0 | eclipse distribution license | Eclipse Distribution License v\. ?1\.0
cddl-1.1 | common development and distribution | Common Development and Distribution License \(CDDL\) Version 1\.1
cddl-1.0 | common development and distribution | Common Development and Distribution License,? \(?(?:the License|CDDL)?\)?,? ?Version 1\.0
bsd-4-clause | redistribution and use | Redistribution and use in source and binary forms, with or without modification, are permitted .{0,900} All advertising materials mentioning features
bsd-3-clause | redistribution and use | Redistribution and use in source and binary forms, with or without modification, are permitted .{0,1200} Neither the name of
bsd-2-clause | redistribution and use | Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met
zlib | provided 'as-is' | This software is provided 'as-is', without any express or implied warranty\. In no event will the authors be held liable
bsl-1.0 | boost software license | Boost Software License - Version 1\.0
unlicense | unencumbered software | This is free and unencumbered software released into the public domain
wtfpl | what the fuck you want | Do What The Fuck You Want To Public License
artistic-2.0 | artistic license | The Artistic License 2\.0
artistic-1.0 | artistic license | The Artistic License Preamble
python-2.0 | python software foundation | Python Software Foundation License Version 2
psf-2.0 | psf license | PSF License Agreement
openssl | openssl toolkit | This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit
ssleay | eric young | This product includes cryptographic software written by Eric Young
ncsa | illinois | University of Illinois/?NCSA Open Source License
w3c | w3c software | W3C Software (?:and Document )?Notice and License
ofl-1.1 | open font license | SIL Open Font License,? Version 1\.1
ofl-1.0 | open font license | SIL Open Font License,? Version 1\.0
odbl-1.0 | open database license | Open Database License \(ODbL\)
odc-by-1.0 | open data commons | Open Data Commons Attribution License
pddl-1.0 | public domain dedication | Open Data Commons Public Domain Dedication and License
sspl-1.0 | server side public license | Server Side Public License,? (?:VERSION|v) ?1
busl-1.1 | business source license | Business Source License 1\.1
elastic-2.0 | elastic license | Elastic License 2\.0
eupl-1.2 | european union public | European Union Public Licen[cs]e,? (?:V\.|version )? ?1\.2
eupl-1.1 | european union public | European Union Public Licen[cs]e,? (?:V\.|version )? ?1\.1
cecill-2.1 | cecill | CeCILL FREE SOFTWARE LICENSE AGREEMENT Version 2\.1
cecill-c | cecill | CeCILL-C license
cecill-b | cecill | CeCILL-B license
qpl-1.0 | q public license | The Q Public License Version 1\.0
ms-pl | microsoft public license | Microsoft Public License \(Ms-PL\)
ms-rl | microsoft reciprocal license | Microsoft Reciprocal License \(Ms-RL\)
afl-3.0 | academic free license | Academic Free License (?:version |v\. ?)?3\.0
osl-3.0 | open software license | Open Software License (?:version |v\. ?)?3\.0
ecl-2.0 | educational community license | Educational Community License,? Version 2\.0
apsl-2.0 | apple public source | Apple Public Source License,? (?:Version )?2\.0
ipl-1.0 | ibm public license | IBM Public License,? Version 1\.0
sissl | sun industry standards | Sun Industry Standards Source License
ogl-uk-3.0 | open government licence | Open Government Licence v3\.0
ogl-uk-2.0 | open government licence | Open Government Licence v2\.0
beerware | beer-ware | THE BEER-WARE LICENSE
json | used for good | The Software shall be used for Good, not Evil
vim | vim license | Vim License
ruby | ruby license | (?:under the|same terms as) Ruby License
php-3.01 | php license | The PHP License, version 3\.01
zpl-2.1 | zope public license | Zope Public License \(ZPL\) Version 2\.1
unicode-dfs | unicode, inc | Unicode, Inc\. License Agreement
libpng | png reference library | PNG Reference Library License
curl | curl license | curl license
#95
cc-by-nc-nd-4.0 | creativecommons.org | creativecommons\.org/licenses/by-nc-nd/4\.0
cc-by-nc-nd-3.0 | creativecommons.org | creativecommons\.org/licenses/by-nc-nd/3\.0
cc-by-nc-sa-4.0 | creativecommons.org | creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-sa-3.0 | creativecommons.org | creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-4.0 | creativecommons.org | creativecommons\.org/licenses/by-nc/4\.0
cc-by-nc-3.0 | creativecommons.org | creativecommons\.org/licenses/by-nc/3\.0
cc-by-nd-4.0 | creativecommons.org | creativecommons\.org/licenses/by-nd/4\.0
cc-by-nd-3.0 | creativecommons.org | creativecommons\.org/licenses/by-nd/3\.0
cc-by-sa-4.0 | creativecommons.org | creativecommons\.org/licenses/by-sa/4\.0
cc-by-sa-3.0 | creativecommons.org | creativecommons\.org/licenses/by-sa/3\.0
cc-by-sa-2.5 | creativecommons.org | creativecommons\.org/licenses/by-sa/2\.5
cc-by-sa-2.0 | creativecommons.org | creativecommons\.org/licenses/by-sa/2\.0
cc-by-4.0 | creativecommons.org | creativecommons\.org/licenses/by/4\.0
cc-by-3.0 | creativecommons.org | creativecommons\.org/licenses/by/3\.0
cc-by-2.5 | creativecommons.org | creativecommons\.org/licenses/by/2\.5
cc-by-2.0 | creativecommons.org | creativecommons\.org/licenses/by/2\.0
cc0-1.0 | creativecommons.org | creativecommons\.org/publicdomain/zero/1\.0
cc-pdm-1.0 | creativecommons.org | creativecommons\.org/publicdomain/mark/1\.0
mit | opensource.org | opensource\.org/licenses/mit
bsd-3-clause | opensource.org | opensource\.org/licenses/bsd-3-clause
bsd-2-clause | opensource.org | opensource\.org/licenses/bsd-2-clause
isc | opensource.org | opensource\.org/licenses/isc
artistic-2.0 | opensource.org | opensource\.org/licenses/artistic-2\.0
apache-2.0 | apache.org | apache\.org/licenses/LICENSE-2\.0
gpl-3.0 | gnu.org | gnu\.org/licenses/gpl-3\.0
gpl-2.0 | gnu.org | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
lgpl-3.0 | gnu.org | gnu\.org/licenses/lgpl-3\.0
lgpl-2.1 | gnu.org | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
agpl-3.0 | gnu.org | gnu\.org/licenses/agpl-3\.0
gnu-unversioned | gnu.org | gnu\.org/licenses/
mpl-2.0 | mozilla.org | mozilla\.org/(?:en-US/)?MPL/2\.0
epl-2.0 | eclipse.org | eclipse\.org/legal/epl-(?:v|)20?\b
epl-1.0 | eclipse.org | eclipse\.org/legal/epl-v10
unlicense | unlicense.org | unlicense\.org
wtfpl | wtfpl.net | wtfpl\.net
bsl-1.0 | boost.org | boost\.org/LICENSE_1_0
ofl-1.1 | scripts.sil.org | scripts\.sil\.org/OFL
odbl-1.0 | opendatacommons.org | opendatacommons\.org/licenses/odbl
odc-by-1.0 | opendatacommons.org | opendatacommons\.org/licenses/by
pddl-1.0 | opendatacommons.org | opendatacommons\.org/licenses/pddl
#92
cc-by-nc-nd-4.0 | cc by | \bCC BY-?NC-?ND (?:International )?4\.0
cc-by-nc-nd-3.0 | cc by | \bCC BY-?NC-?ND 3\.0
cc-by-nc-sa-4.0 | cc by | \bCC BY-?NC-?SA 4\.0
cc-by-nc-sa-3.0 | cc by | \bCC BY-?NC-?SA 3\.0
cc-by-nc-4.0 | cc by | \bCC BY-?NC 4\.0
cc-by-nc-3.0 | cc by | \bCC BY-?NC 3\.0
cc-by-nd-4.0 | cc by | \bCC BY-?ND 4\.0
cc-by-nd-3.0 | cc by | \bCC BY-?ND 3\.0
cc-by-sa-4.0 | cc by | \bCC BY-?SA 4\.0
cc-by-sa-3.0 | cc by | \bCC BY-?SA 3\.0
cc-by-4.0 | cc by | \bCC BY 4\.0
cc-by-3.0 | cc by | \bCC BY 3\.0
cc-by-2.0 | cc by | \bCC BY 2\.0
cc-by-nc-nd-4.0 | cc-by | \bCC-BY-NC-ND-4\.0
cc-by-nc-sa-4.0 | cc-by | \bCC-BY-NC-SA-4\.0
cc-by-nc-4.0 | cc-by | \bCC-BY-NC-4\.0
cc-by-nd-4.0 | cc-by | \bCC-BY-ND-4\.0
cc-by-sa-4.0 | cc-by | \bCC-BY-SA-4\.0
cc-by-4.0 | cc-by | \bCC-BY-4\.0
cc-by-nc-nd-4.0 | creative commons | Creative Commons Attribution-NonCommercial-NoDerivatives 4\.0
cc-by-nc-sa-4.0 | creative commons | Creative Commons Attribution-NonCommercial-ShareAlike 4\.0
cc-by-nc-4.0 | creative commons | Creative Commons Attribution-NonCommercial 4\.0
cc-by-nd-4.0 | creative commons | Creative Commons Attribution-NoDerivatives 4\.0
cc-by-sa-4.0 | creative commons | Creative Commons Attribution-ShareAlike 4\.0
cc-by-sa-3.0 | creative commons | Creative Commons Attribution-ShareAlike 3\.0
cc-by-4.0 | creative commons | Creative Commons Attribution 4\.0
cc-by-3.0 | creative commons | Creative Commons Attribution 3\.0
cc0-1.0 | cc0 | \bCC0 1\.0
cc0-1.0 | cc0 | \bCC0\b
apache-2.0 | apache | (?:under the )?Apache (?:Software )?License,? (?:Version |v)?2(?:\.0)?
apache-2.0 | apache-2 | \bApache-2\.0\b
apache-1.1 | apache | Apache (?:Software )?License,? (?:Version |v)?1\.1
apache-1.0 | apache | Apache (?:Software )?License,? (?:Version |v)?1\.0
agpl-3.0 | affero | GNU Affero General Public License,? (?:version |v)?3
agpl-3.0 | agpl | \bAGPL(?:-|v| v)?3
lgpl-3.0 | lesser general public license | GNU Lesser General Public License,? (?:version |v)?3
lgpl-2.1 | lesser general public license | GNU Lesser General Public License,? (?:version |v)?2\.1
lgpl-2.0 | library general public license | GNU Library General Public License,? (?:version |v)?2
lgpl-3.0 | lgpl | \bLGPL(?:-|v| v)?3
lgpl-2.1 | lgpl | \bLGPL(?:-|v| v)?2\.1
gpl-3.0-or-later | general public license | General Public License,? (?:version |v)?3(?:\.0)?,? or (?:\(at your option\) )?(?:any )?later
gpl-2.0-or-later | general public license | General Public License,? (?:version |v)?2(?:\.0)?,? or (?:\(at your option\) )?(?:any )?later
gpl-3.0 | general public license | (?:GNU )?General Public License,? (?:version |v)?3
gpl-2.0 | general public license | (?:GNU )?General Public License,? (?:version |v)?2
gpl-1.0 | general public license | (?:GNU )?General Public License,? (?:version |v)?1\b
gpl-3.0-or-later | gpl | \bGPL(?:-|v| v)?3(?:\.0)?(?:\+| or later)
gpl-2.0-or-later | gpl | \bGPL(?:-|v| v)?2(?:\.0)?(?:\+| or later)
gpl-3.0 | gpl | (?<![A-Za-z])GPL(?:-|v| v)?3
gpl-2.0 | gpl | (?<![A-Za-z])GPL(?:-|v| v)?2
mpl-2.0 | mozilla public license | Mozilla Public License,? (?:version |v\.? ?)?2
mpl-1.1 | mozilla public license | Mozilla Public License,? (?:version |v\.? ?)?1\.1
epl-2.0 | eclipse public license | Eclipse Public License,? -? ?(?:version |v\.? ?)?2
epl-1.0 | eclipse public license | Eclipse Public License,? -? ?(?:version |v\.? ?)?1
bsd-4-clause | bsd | \b(?:4-clause|original|four-clause) BSD\b
bsd-3-clause | bsd | \b(?:3-clause|new|modified|revised|three-clause) BSD\b
bsd-2-clause | bsd | \b(?:2-clause|simplified|FreeBSD|two-clause) BSD\b
bsd-3-clause | bsd | \bBSD(?: |-)3(?: |-)Clause
bsd-2-clause | bsd | \bBSD(?: |-)2(?: |-)Clause
#85
mit | mit license | (?:under|released under|licensed under|covered by) the (?:terms of the )?MIT License
mit | mit license | \bThe MIT License(?: \(MIT\))?
mit | mit licence | \bMIT Licence\b
mit | mit license | \bMIT License\b
mit | expat license | \bExpat License\b
apache | apache license | \bApache License\b
isc | isc license | \bISC License\b
zlib | zlib | \bzlib(?:/libpng)? License\b
unlicense | the unlicense | \bThe Unlicense\b
wtfpl | wtfpl | \bWTFPL\b
bsl-1.0 | boost software license | \bBoost Software License\b
artistic | artistic license | \bArtistic License\b
bsd | bsd | \bBSD(?:-style)? License\b
bsd | bsd | \bBSD(?:-style)? Licence\b
agpl | affero | \bAffero General Public License\b
lgpl | lesser general public license | \bLesser General Public License\b
lgpl | library general public license | \bLibrary General Public License\b
gpl | general public license | \bGNU General Public License\b
gpl | general public license | \bGeneral Public License\b
gpl | general public licence | \bGeneral Public Licence\b
gpl | gnu gpl | \bGNU GPL\b
lgpl | gnu lgpl | \bGNU LGPL\b
agpl | gnu agpl | \bGNU AGPL\b
mpl | mozilla public license | \bMozilla Public License\b
epl | eclipse public license | \bEclipse Public License\b
cddl | common development and distribution | \bCommon Development and Distribution License\b
eupl | european union public | \bEuropean Union Public Licen[cs]e\b
gfdl | free documentation license | \bGNU Free Documentation License\b
ofl | open font license | \bOpen Font License\b
cc-by-nc-nd | creative commons | Creative Commons Attribution-NonCommercial-NoDerivatives
cc-by-nc-sa | creative commons | Creative Commons Attribution-NonCommercial-ShareAlike
cc-by-nc | creative commons | Creative Commons Attribution-NonCommercial
cc-by-nd | creative commons | Creative Commons Attribution-NoDerivatives
cc-by-sa | creative commons | Creative Commons Attribution-ShareAlike
cc-by | creative commons | Creative Commons Attribution
cc-by-nc-nd | cc by | \bCC BY-?NC-?ND\b
cc-by-nc-sa | cc by | \bCC BY-?NC-?SA\b
cc-by-nc | cc by | \bCC BY-?NC\b
cc-by-nd | cc by | \bCC BY-?ND\b
cc-by-sa | cc by | \bCC BY-?SA\b
#70
creative-commons | creative commons | \bCreative Commons(?: License| Licence)?\b
public-domain | public domain | (?:released|dedicated|placed) (?:in|into|to) the public domain
public-domain | public domain | \bin the public domain\b
proprietary | proprietary and confidential | \bProprietary and Confidential\b
proprietary | unauthorized copying | Unauthorized copying of this (?:file|software)[^.]{0,60} is strictly prohibited
proprietary | no part of this | No part of this (?:publication|work|book) may be reproduced
reserved | all rights reserved | \bAll Rights Reserved\b
reserved | tous droits | \bTous droits r[eé]serv[eé]s\b
reserved | alle rechte vorbehalten | \bAlle Rechte vorbehalten\b
reserved | todos los derechos | \bTodos los derechos reservados\b
#50
copyright-notice | copyright | \bCopyright (?:\(c\)|©)? ?(?:19|20)[0-9]{2}(?:-(?:19|20)[0-9]{2})?
copyright-notice | copyright | \bCopyright (?:\(c\)|©) [A-Z][A-Za-z]+
licensed | licensed under | \blicensed under (?:the )?(?:terms of )?[A-Za-z0-9.-]+ licen[sc]e
licence-file | license | \bSee (?:the )?LICENSE(?:\.txt|\.md)? file
"""


def _parse() -> list[tuple[int, str, str, str, int]]:
    rules, confidence = [], 100
    for line in _TEXT.strip().splitlines():
        if line.startswith("#"):
            confidence = int(line[1:])
            continue
        label, keyword, pattern = (x.strip() for x in line.split(" | ", 2))
        loose = pattern.replace(" ", r"""[\s*#/"'“”-]{1,12}""")
        rules.append((len(rules), label, keyword, f"(?is){loose}", confidence))
    return rules


#: (priority, label, keyword, Java regex, confidence in percent)
RULES = _parse()
