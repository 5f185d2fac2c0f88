"""Signatures of licenses, written by hand, over texts whose words are lower case and joined by one space.

A line is ``priority keywords: pattern``. Keywords are groups parted by commas, a group is words parted by bars:
every text that a pattern matches holds a word of each group, the rarest first, and at most REACH words (both
tested). Patterns begin and end with whole words. Priorities: 4 wording of a grant or clause, 3 name with
version, identifier or address, 2 name alone, 1 hint.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

REACH = 64

# Fixed values of the operator's contract: phrases that count wherever they stand.
BASE = (("gnu general public license", "gpl", "gnu"), ("apache license", "apache", "apache"),
        ("cc by", "cc-by", "cc"), ("mit license", "mit", "license"))

SIGNATURES = {
    "gpl": """
        2 gpl: (?:gnu )?gpl
        2 gplv: gplv
        2 gnu: gnu public license
        2 license|licence,public: general public licen[cs]e
        4 redistribute: you can redistribute it and or modify it under the terms of the gnu general public license
        4 licenses,freedom: the licenses for most software are designed to take away your freedom to share and change it
        3 gnu: gnu org licenses gpl(?: html| txt)?
        4 warranty: this program comes with absolutely no warranty
        4 copyleft: this license is a free copyleft license
    """,
    "gpl-1.0": """
        3 gpl: gpl (?:v|version )?1(?: 0)?(?: only| or later)?
        3 gnu: gnu general public license (?:v|version )1(?: 0)?
        3 gplv1: gplv1
    """,
    "gpl-2.0": """
        3 gpl: gpl (?:v ?|version )?2(?: 0)?(?: only)?
        3 gnu: gnu general public license(?: gpl)? (?:v ?|version )2(?: 0)?(?: only)?
        3 gplv2: (?:gnu )?gplv2(?: only)?
        3 gnu: gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
        4 franklin: free software foundation inc 51 franklin (?:street|st) fifth floor boston ma
        4 copyleft: version 2 of the gnu gpl copyleft
    """,
    "gpl-2.0-or-later": """
        3 gpl: gpl 2 0 or later
        3 gplv2: gplv2 or (?:any )?later
        4 gnu: gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
        3 gnu: gnu general public license (?:v|version )2 or (?:[^ ]+ ){0,3}later(?: version)?
    """,
    "gpl-3.0": """
        3 gpl: gpl (?:v ?|version )?3(?: 0)?(?: only)?
        3 gnu: gnu general public license(?: gpl)? (?:v ?|version )3(?: 0)?(?: only)?
        3 gplv3: (?:gnu )?gplv3(?: only)?
        3 gnu: gnu org licenses gpl 3 0(?: html| txt| en html)?
        4 gnu: gnu general public license version 3 29 june 2007
    """,
    "gpl-3.0-or-later": """
        3 gpl: gpl 3 0 or later
        3 gplv3: gplv3 or (?:any )?later
        4 gnu: gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
        3 gnu: gnu general public license (?:v|version )3 or (?:[^ ]+ ){0,3}later(?: version)?
    """,
    "lgpl": """
        2 lgpl: (?:gnu )?lgpl
        2 license|licence,lesser: gnu lesser (?:general )?public licen[cs]e
        2 license|licence,library: gnu library (?:general )?public licen[cs]e
        3 gnu: gnu org licenses lgpl(?: html| txt)?
        4 license,lesser: under the terms of the gnu lesser general public license
    """,
    "lgpl-2.0": """
        3 lgpl: lgpl (?:v|version )?2(?: 0)?(?: only| or later)?
        3 license,library: gnu library general public license (?:v|version )2(?: 0)?
    """,
    "lgpl-2.1": """
        3 lgpl: lgpl (?:v ?|version )?2 1(?: only| or later)?
        3 lgplv2: lgplv2 1(?: only| or later)?
        3 license,lesser: gnu lesser general public license(?: lgpl)? (?:v ?|version )2 1
        4 license,lesser: gnu lesser general public license as published by the free software foundation either version 2 1 of the license
    """,
    "lgpl-3.0": """
        3 lgpl: lgpl (?:v ?|version )?3(?: 0)?(?: only| or later)?
        3 lgplv3: lgplv3(?: only| or later)?
        3 license,lesser: gnu lesser general public license(?: lgpl)? (?:v ?|version )3(?: 0)?
        4 license,lesser: gnu lesser general public license as published by the free software foundation either version 3 of the license
    """,
    "agpl": """
        2 agpl: (?:gnu )?agpl
        2 affero: (?:gnu )?affero (?:general )?public licen[cs]e
    """,
    "agpl-3.0": """
        3 agpl: agpl (?:v ?|version )?3(?: 0)?(?: only| or later)?
        3 agplv3: (?:gnu )?agplv3(?: only| or later)?
        3 affero: gnu affero general public license(?: agpl)? (?:v ?|version )3(?: 0)?
        4 affero: gnu affero general public license as published by the free software foundation
    """,
    "gfdl": """
        2 gfdl: (?:gnu )?gfdl
        2 license|licence,documentation: gnu free documentation licen[cs]e
        3 gfdl: gfdl 1 [123](?: only| or later)?
        4 license,documentation: gnu free documentation license version 1 [123] or any later version published by the free software foundation
    """,
    "classpath-exception": """
        3 classpath: (?:gnu )?classpath exception(?: 2 0)?
        4 linking: linking this library statically or dynamically with other modules is making a combined work
    """,
    "apache": """
        2 apache: apache (?:software )?licen[cs]e
        2 asf: licensed to the apache software foundation asf under one or more contributor license agreements
    """,
    "apache-1.1": """
        3 apache: apache 1 [01]
        3 apache: apache (?:software )?license (?:v|version )?1 [01]
        4 apache: this product includes software developed by the apache software foundation http www apache org
    """,
    "apache-2.0": """
        3 apache: apache (?:v ?)?2(?: 0)?
        3 apache: apache (?:software )?licen[cs]e (?:v ?|version )?2(?: 0)?
        3 apache: apache org licenses license 2 0(?: html| txt)?
        4 apache: licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
        4 perpetual: a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of
    """,
    "mit": """
        2 license|licence|licensed|licenced,mit: mit licen[cs]ed?
        2 licensed|released|distributed|available,mit: (?:licensed|released|distributed|available) under (?:the )?mit
        3 spdx,mit: spdx license identifier mit
        3 opensource,mit: opensource org licenses? mit(?: license)?(?: php| html)?
        2 expat: expat licen[cs]e
        4 permission: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        4 substantial: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
    """,
    "mit-0": """
        3 spdx,mit: spdx license identifier mit 0
        3 attribution,mit: mit no attribution(?: license)?
    """,
    "x11": """
        3 license|licence,x11: x11 licen[cs]e
        4 consortium: except as contained in this notice the name of the x consortium shall not be used in advertising
    """,
    "bsd": """
        2 bsd: bsd(?: style)? licen[cs]ed?
        2 bsd: under (?:a |the )?bsd
        4 redistribution: redistribution and use in source and binary forms with or without modification are permitted
    """,
    "bsd-2-clause": """
        3 bsd: bsd 2(?: clause)?(?: licen[cs]e)?
        3 bsd: (?:2|two) clause (?:simplified )?bsd(?: licen[cs]e)?
        3 bsd: (?:simplified|freebsd) bsd(?: licen[cs]e)?
        3 freebsd: freebsd licen[cs]e
    """,
    "bsd-3-clause": """
        3 bsd: bsd 3(?: clause)?(?: licen[cs]e)?
        3 bsd: (?:3|three) clause bsd(?: licen[cs]e)?
        3 bsd: (?:new|modified|revised) bsd(?: licen[cs]e)?
        4 endorse: neither the name of (?:[^ ]+ ){1,10}nor the names of (?:its|their) contributors may be used to endorse or promote products
    """,
    "bsd-4-clause": """
        3 bsd: bsd 4(?: clause)?(?: licen[cs]e)?
        3 bsd: (?:4|four) clause bsd(?: licen[cs]e)?
        3 bsd: original bsd(?: licen[cs]e)?
        4 advertising: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
    """,
    "0bsd": """
        3 0bsd: 0bsd
        3 bsd: (?:zero|0) clause bsd(?: licen[cs]e)?
    """,
    "isc": """
        2 isc: isc licen[cs]e
        3 isc: spdx license identifier isc
        4 permission: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
    """,
    "cc-by": """
        2 cc: cc by(?: [1-4] [05])?
        2 creative: creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by [1-4] [05]
    """,
    "cc-by-4.0": """
        3 cc: cc by (?:v)?4(?: 0)?
        3 creative: creative commons attribution 4 0(?: international)?(?: public)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by 4 0(?: legalcode| deed)?
    """,
    "cc-by-3.0": """
        3 cc: cc by (?:v)?3(?: 0)?
        3 creative: creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by 3 0(?: legalcode| deed)?
    """,
    "cc-by-sa": """
        3 cc: cc by sa(?: [1-4] [05])?
        3 creative: creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by sa [1-4] [05]
    """,
    "cc-by-nc": """
        3 cc: cc by nc(?: [1-4] [05])?
        3 creative: creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by nc [1-4] [05]
    """,
    "cc-by-nd": """
        3 cc: cc by nd(?: [1-4] [05])?
        3 creative: creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by nd [1-4] [05]
    """,
    "cc-by-nc-sa": """
        3 cc: cc by nc sa(?: [1-4] [05])?
        3 creative: creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by nc sa [1-4] [05]
    """,
    "cc-by-nc-nd": """
        3 cc: cc by nc nd(?: [1-4] [05])?
        3 creative: creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?(?: international| unported)?(?: licen[cs]e)?
        3 creativecommons: creativecommons org licenses by nc nd [1-4] [05]
    """,
    "cc0": """
        3 cc0: cc0(?: 1 0)?(?: universal)?
        3 creative: creative commons zero(?: v?1 0)?(?: universal)?
        3 creativecommons: creativecommons org publicdomain zero 1 0
        4 waiving,deed: the person who associated a work with this deed has dedicated the work to the public domain by waiving
    """,
    "cc": """
        1 creative: creative commons(?: licen[cs]ed?)?
    """,
    "odbl": """
        3 odbl: odbl(?: 1 0)?
        2 license|licence,database: open database licen[cs]e
    """,
    "odc-by": """
        3 odc: odc by(?: 1 0)?
        2 license|licence,commons: open data commons attribution licen[cs]e
    """,
    "pddl": """
        3 pddl: pddl(?: 1 0)?
        2 license|licence,commons: open data commons public domain dedication and licen[cs]e
    """,
    "cdla-permissive": """
        3 cdla: cdla permissive(?: [12] 0)?
        2 license,community: community data license agreement permissive(?: version [12] 0)?
    """,
    "cdla-sharing": """
        3 cdla: cdla sharing(?: 1 0)?
        2 license,community: community data license agreement sharing(?: version 1 0)?
    """,
    "mpl": """
        2 mpl: mpl
        2 mozilla: mozilla public licen[cs]e
    """,
    "mpl-1.1": """
        3 mpl: mpl 1 [01]
        3 mozilla: mozilla public license (?:v|version )1 [01]
    """,
    "mpl-2.0": """
        3 mpl: mpl (?:v ?)?2(?: 0)?
        3 mozilla: mozilla public license (?:v ?|version )2(?: 0)?
        3 mozilla: mozilla org mpl 2 0
        4 mozilla: this source code form is subject to the terms of the mozilla public license v 2 0
    """,
    "epl": """
        2 license|licence,eclipse: eclipse public licen[cs]e
        3 eclipse: eclipse org legal epl
    """,
    "epl-1.0": """
        3 epl: epl (?:v ?)?1(?: 0)?
        3 license,eclipse: eclipse public license (?:v ?|version )?1(?: 0)?
    """,
    "epl-2.0": """
        3 epl: epl (?:v ?)?2(?: 0)?
        3 license,eclipse: eclipse public license (?:v ?|version )?2(?: 0)?
    """,
    "edl": """
        2 license|licence,eclipse: eclipse distribution licen[cs]e(?: v?1 0)?
    """,
    "cddl": """
        2 cddl: cddl
        3 cddl: cddl (?:v|version )?1 [01]
        2 license|licence,development: common development and distribution licen[cs]e(?: (?:version )?1 [01])?
    """,
    "cpl": """
        2 license|licence,common: common public licen[cs]e(?: (?:version )?1 0)?
        3 cpl: cpl 1 0
    """,
    "ipl": """
        2 license|licence,ibm: ibm public licen[cs]e(?: (?:version )?1 0)?
        3 ipl: ipl 1 0
    """,
    "eupl": """
        2 eupl: eupl
        3 eupl: eupl (?:v ?|version )?1 [012]
        2 license|licence,european: european union public licen[cs]e(?: (?:v ?|version )?1 [012])?
    """,
    "cecill": """
        2 cecill: cecill(?: [bc])?
        3 cecill: cecill (?:v|version )?[12](?: [01])?
        4 cecill: governed by the cecill (?:[bc] )?license under french law
    """,
    "zlib": """
        2 zlib: zlib(?: libpng)? licen[cs]e
        4 misrepresented: the origin of this software must not be misrepresented you must not claim that you wrote the original software
    """,
    "libpng": """
        2 libpng: libpng licen[cs]e(?: version 2)?
        4 png: the png reference library is supplied as is
    """,
    "bsl-1.0": """
        3 bsl: bsl 1 0
        2 license|licence,boost: boost software licen[cs]e(?: (?:version )?1 0)?
        3 license,boost: boost org license 1 0 txt
    """,
    "unlicense": """
        2 unlicense: (?:the )?unlicense
        3 unlicense: unlicense org
        4 unencumbered: this is free and unencumbered software released into the public domain
    """,
    "wtfpl": """
        2 wtfpl: wtfpl(?: (?:v|version )?2)?
        4 fuck: do what the fuck you want to public licen[cs]e
    """,
    "artistic": """
        2 license|licence,artistic: artistic licen[cs]e
        2 perl: (?:under )?the same terms as perl(?: itself)?
    """,
    "artistic-1.0": """
        3 artistic: artistic (?:license )?(?:v|version )?1 0(?: perl)?
    """,
    "artistic-2.0": """
        3 artistic: artistic (?:license )?(?:v|version )?2(?: 0)?
    """,
    "psf-2.0": """
        2 psf: psf(?: licen[cs]e)?(?: agreement)?(?: 2 0)?
        2 license|licence,python: python software foundation licen[cs]e(?: (?:version )?2)?
        3 license|licence,python: python (?:licen[cs]e )?2 0 licen[cs]e
    """,
    "ruby": """
        2 license|licence,ruby: ruby licen[cs]e
        2 ruby: (?:under )?the same terms as ruby(?: itself)?
    """,
    "php": """
        2 license|licence,php: php licen[cs]e
        3 php: php (?:license )?(?:v|version )?3 0?[01]
    """,
    "openssl": """
        2 openssl: openssl licen[cs]e
        4 openssl: this product includes software developed by the openssl project for use in the openssl toolkit
    """,
    "postgresql": """
        2 postgresql: postgresql licen[cs]e
        4 california: in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages
    """,
    "curl": """
        2 license|licence,curl: curl licen[cs]e
    """,
    "ncsa": """
        3 ncsa: (?:university of illinois )?ncsa(?: open source)?(?: licen[cs]e)
        2 license|licence,illinois: university of illinois open source licen[cs]e
    """,
    "afl-3.0": """
        3 afl: afl [123] [01]
        2 license|licence,academic: academic free licen[cs]e(?: (?:v ?|version )?[123] [01])?
    """,
    "osl-3.0": """
        3 osl: osl [123] [01]
        2 osl: licensed under (?:the )?osl
        2 license|licence,open: open software licen[cs]e(?: (?:v ?|version )?[123] [01])?
    """,
    "ms-pl": """
        3 ms: ms pl
        2 license|licence,microsoft: microsoft public licen[cs]e
    """,
    "ms-rl": """
        3 ms: ms rl
        2 license|licence,microsoft: microsoft reciprocal licen[cs]e
    """,
    "apsl": """
        3 apsl: apsl(?: [12] [012])?
        2 license|licence,apple: apple public source licen[cs]e(?: (?:version )?[12] [012])?
    """,
    "qpl": """
        2 license|licence,q: the q public licen[cs]e(?: (?:version )?1 0)?
        3 qpl: qpl 1 0
    """,
    "ofl-1.1": """
        3 ofl: (?:sil )?ofl(?: 1 [01])?
        2 sil: sil open font licen[cs]e(?: (?:version )?1 [01])?
        4 reserved: this font software is licensed under the sil open font license version 1 1 reserved font name
    """,
    "vim": """
        2 license|licence,vim: vim licen[cs]e
    """,
    "w3c": """
        2 w3c: w3c (?:software )?(?:notice and )?(?:document )?licen[cs]e
        4 w3c: this work is being provided by the copyright holders under the following license w3c
    """,
    "unicode": """
        3 dfs,unicode: unicode dfs 201[56]
        2 license|licence,unicode: unicode licen[cs]e(?: v3| agreement)?
        3 unicode: unicode org copyright html
    """,
    "icu": """
        2 license|licence,icu: icu licen[cs]e
    """,
    "ijg": """
        2 license|licence,ijg: ijg licen[cs]e
        4 jpeg: this software is based in part on the work of the independent jpeg group
    """,
    "tcl": """
        2 license|licence,tcl: tcl(?: tk)? licen[cs]e
    """,
    "json": """
        2 license|licence,json: json licen[cs]e
        4 evil: the software shall be used for good not evil
    """,
    "beerware": """
        2 beerware|ware,beerware|beer: (?:beerware|beer ware)(?: licen[cs]e)?
        4 beer: as long as you retain this notice you can do whatever you want with this stuff if we meet some day .{0,60}buy me a beer
    """,
    "intel": """
        2 license|licence,intel: intel (?:simplified software|open source) licen[cs]e
    """,
    "nasa": """
        2 nasa: nasa open source agreement(?: (?:version )?1 3)?
    """,
    "sleepycat": """
        2 sleepycat: sleepycat (?:software )?(?:public )?licen[cs]e
    """,
    "upl": """
        2 license|licence,universal: universal permissive licen[cs]e(?: (?:v ?|version )?1 0)?
        3 upl: upl 1 0
    """,
    "zpl": """
        2 zope: zope public licen[cs]e(?: (?:version )?[12] [01])?
        3 zpl: zpl [12] [01]
    """,
    "blueoak-1.0": """
        2 license|licence,oak: blue oak model licen[cs]e(?: 1 0 0)?
        3 blueoak: blueoak 1 0 0
    """,
    "mulan": """
        3 mulan: mulan(?: permissive software license| psl)(?: v ?[12])?
        3 mulanpsl: mulanpsl [12] 0
    """,
    "busl-1.1": """
        3 busl: busl 1 1
        2 license|licence,business: business source licen[cs]e(?: (?:version )?1 1)?
    """,
    "sspl": """
        3 sspl: sspl(?: (?:v ?)?1(?: 0)?)?
        2 license|licence,server: server side public licen[cs]e(?: (?:v ?|version )?1)?
    """,
    "elastic-2.0": """
        2 license|licence,elastic: elastic licen[cs]e(?: (?:v ?|version )?2(?: 0)?)?
    """,
    "commons-clause": """
        2 commons: commons clause(?: licen[cs]e condition)?(?: v1 0)?
    """,
    "polyform": """
        2 polyform: polyform (?:noncommercial|small business|strict|shield|perimeter|free trial)(?: licen[cs]e)?(?: 1 0 0)?
    """,
    "prosperity": """
        2 license|licence,prosperity: prosperity public licen[cs]e(?: (?:version )?[23] 0 0)?
    """,
    "openrail": """
        2 openrail: (?:creativeml |bigscience |bigcode )?openrail(?: [ms]){0,2}(?: licen[cs]e)?
        2 rail: (?:creativeml |bigscience |bigcode )?open rail(?: [ms]){0,2}(?: licen[cs]e)?
        2 license|licence|licenses|licences,responsible: responsible ai licen[cs]es?
    """,
    "llama-community": """
        2 llama: llama [234](?: [0-9])? community licen[cs]e(?: agreement)?
    """,
    "ogl-uk": """
        2 ogl: ogl uk(?: [123] 0)?
        2 license|licence,government: open government licen[cs]e(?: (?:v ?|version )?[123](?: 0)?)?
    """,
    "etalab": """
        2 etalab: etalab(?: [12] 0)?
        2 ouverte: licence ouverte(?: (?:v|version )?[12](?: 0)?)?
    """,
    "dl-de": """
        3 dl: dl de (?:by|zero) 2 0
        2 datenlizenz: datenlizenz deutschland(?: (?:namensnennung|zero))?(?: version 2 0)?
    """,
    "public-domain": """
        2 domain: (?:released |placed |dedicated )?(?:in|into|to) the public domain
        2 domain: public domain (?:dedication|mark|work)
        2 gemeinfrei: gemeinfrei
        2 domaine: (?:dans )?le domaine public
        2 dominio: (?:de |en el )dominio público
    """,
    "all-rights-reserved": """
        1 rights: all rights reserved
        1 rechte: alle rechte vorbehalten
        1 droits: tous droits réservés
        1 derechos: todos los derechos reservados
    """,
    "proprietary": """
        2 proprietary: (?:this (?:software|work|document) is )?proprietary and confidential
        2 unauthorized: unauthorized copying of this (?:file|work|software|document)(?: via any medium)? is strictly prohibited
        1 license|licence,proprietary: proprietary licen[cs]e
        2 reproduced: no part of this (?:publication|book|work) may be reproduced
    """,
    "non-commercial": """
        1 noncommercial: (?:for )?noncommercial use only
        1 commercial,only: (?:for )?non commercial use only
        1 research,only: (?:for )?research (?:purposes|use) only
    """,
    "commercial": """
        1 license|licence,commercial: commercial licen[cs]e(?: agreement)?
        1 license|licence,user: end user licen[cs]e agreement
        1 eula: eula
    """,
    "freeware": """
        1 freeware: (?:this (?:software|program) is )?freeware
    """,
    "shareware": """
        1 shareware: (?:this (?:software|program) is )?shareware
    """,
    "unstated": """
        1 licensed: (?:is |are )?licensed under(?: the(?: terms of)?)?
        1 released: (?:is |are )?released under the(?: terms of the)?
        1 spdx: spdx license identifier
        1 lizenziert: lizenziert unter(?: der)?
        1 licence: sous licence
        1 licencia: bajo (?:la )?licencia
    """,
}


@dataclass(frozen=True)
class Rule:
    """One signature; ``base`` marks the phrases of the contract."""

    label: str
    priority: int
    keywords: tuple[frozenset[str], ...]
    pattern: re.Pattern
    base: bool = False


def _whole(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")


def _read() -> tuple[Rule, ...]:
    rules = [Rule(label, 2, (frozenset([keyword]),), _whole(phrase), True) for phrase, label, keyword in BASE]
    for label, lines in SIGNATURES.items():
        for line in lines.strip().splitlines():
            head, pattern = line.strip().split(": ", 1)
            priority, keywords = head.split(" ")
            groups = tuple(frozenset(g.split("|")) for g in keywords.split(","))
            rules.append(Rule(label, int(priority), groups, _whole(pattern)))
    return tuple(rules)


RULES = _read()
# What a signature says of its text alone, by priority.
WEIGHT = {4: 0.97, 3: 0.95, 2: 0.85, 1: 0.3}
