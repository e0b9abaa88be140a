"""The ordered signature rules of the license scan.

A rule is a label, a weight and a regular expression over *words* (lower case, digits and
letters; everything else separates). Tokens are set apart by spaces: a plain token is one
word, a token may be an alternation or hold classes, ``?`` behind a token makes it optional,
``..3`` stands for up to three words of any kind. Rules stand in the order of priority.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    weight: float
    pattern: str
    keyword: str
    base: bool = False


#: Phrases that always count, with the labels they give. Fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: label | identifier in files and manifests | names | addresses. Alternatives by ";".
LICENSES = """
agpl-3.0-or-later | agpl 3 0 or later; agplv3 or later; agpl 3 0 plus | gnu? affero general public licen[cs]e v(?:ersion)?|version? 3 or at? your? option? any? later ; affero gpl version|v 3 or later | gnu org licenses agpl 3 0 en? html
agpl-3.0 | agpl 3 0; agplv3; agpl 3 0 only | gnu? affero general public licen[cs]e ; affero gpl ; gnu agpl | gnu org licenses agpl html ; fsf org licensing licenses agpl 3 0
lgpl-3.0 | lgpl 3 0; lgplv3; lgpl 3 0 only; lgpl 3 0 or later | gnu? lesser general public licen[cs]e version|v 3 ; gnu? lesser gpl version|v 3 | gnu org licenses lgpl 3 0 en? html
lgpl-2.1 | lgpl 2 1; lgplv2 1; lgpl 2 1 only; lgpl 2 1 or later | gnu? lesser general public licen[cs]e version|v 2 1 ; gnu? lesser gpl version|v 2 1 | gnu org licenses old licenses lgpl 2 1
lgpl-2.0 | lgpl 2 0; lgplv2; lgpl 2 0 only; lgpl 2 0 or later | gnu? library general public licen[cs]e version|v 2 ; gnu? library general public licen[cs]e | gnu org licenses old licenses lgpl 2 0
lgpl | lgpl | gnu? lesser general public licen[cs]e ; gnu lgpl | gnu org licenses lgpl html ; gnu org copyleft lesser html
gpl-3.0-or-later | gpl 3 0 or later; gplv3 or later; gpl 3 0 plus | gnu? general public licen[cs]e version|v 3 or ..4 later version? ; either version 3 of the licen[cs]e or ..4 later version | gnu org licenses gpl 3 0 or later
gpl-3.0 | gpl 3 0; gplv3; gpl 3 0 only; gpl v3 | gnu? general public licen[cs]e version|v 3 ; gnu? general public licen[cs]e v3 ; gnu gpl version|v 3 | gnu org licenses gpl 3 0 en? html|txt
gpl-2.0-or-later | gpl 2 0 or later; gplv2 or later; gpl 2 0 plus | gnu? general public licen[cs]e version|v 2 or ..4 later version? ; either version 2 of the licen[cs]e or ..4 later version | gnu org licenses gpl 2 0 or later
gpl-2.0 | gpl 2 0; gplv2; gpl 2 0 only; gpl v2 | gnu? general public licen[cs]e version|v 2 ; gnu? general public licen[cs]e v2 ; gnu gpl version|v 2 | gnu org licenses old licenses gpl 2 0 en? html|txt
gfdl-1.3 | gfdl 1 3; gfdl 1 3 only; gfdl 1 3 or later | gnu? free documentation licen[cs]e version 1 3 ; gfdl version 1 3 | gnu org licenses fdl 1 3 html
gfdl | gfdl; gfdl 1 2; gfdl 1 1 | gnu? free documentation licen[cs]e | gnu org licenses fdl html ; gnu org copyleft fdl html
apache-2.0 | apache 2 0; apache2; apache 2; asl 2 0 | apache licen[cs]e version|v? 2 0? ; apache software licen[cs]e version|v? 2 0? | apache org licenses licen[cs]e 2 0 html|txt?
apache-1.1 | apache 1 1; asl 1 1 | apache software? licen[cs]e version|v? 1 1 | apache org licenses licen[cs]e 1 1
apache-1.0 | apache 1 0; asl 1 0 | apache software? licen[cs]e version|v? 1 0 | apache org licenses licen[cs]e 1 0
mit-0 | mit 0 | mit no attribution licen[cs]e | opensource org licenses mit 0 ; spdx org licenses mit 0
mit | mit; expat | the? mit x11? licen[cs]e ; mit style licen[cs]e ; expat licen[cs]e ; mit expat licen[cs]e | opensource org licenses? mit licen[cs]e? ; mit licen[cs]e org
bsd-4-clause | bsd 4 clause; bsd4 | original bsd licen[cs]e ; four|4 clause bsd licen[cs]e? ; bsd four|4 clause licen[cs]e? | spdx org licenses bsd 4 clause
bsd-3-clause | bsd 3 clause; bsd3; new bsd; modified bsd | three|3 clause bsd licen[cs]e? ; new|modified|revised bsd licen[cs]e ; bsd three|3 clause licen[cs]e? | opensource org licenses? bsd 3 clause
bsd-2-clause | bsd 2 clause; bsd2; simplified bsd; freebsd | two|2 clause bsd licen[cs]e? ; simplified bsd licen[cs]e ; freebsd licen[cs]e ; bsd two|2 clause licen[cs]e? | opensource org licenses? bsd 2 clause
0bsd | 0bsd | zero clause bsd licen[cs]e? ; bsd zero clause licen[cs]e? ; 0 clause bsd licen[cs]e? | opensource org licenses? 0bsd
bsd | bsd; bsd like | bsd licen[cs]e ; bsd style licen[cs]e ; berkeley software distribution licen[cs]e | opensource org licenses? bsd licen[cs]e
isc | isc | isc licen[cs]e ; internet systems consortium licen[cs]e | opensource org licenses? isc licen[cs]e?
mpl-2.0 | mpl 2 0; mplv2; mpl 2 | mozilla public licen[cs]e version|v? 2 0 | mozilla org mpl 2 0 ; mozilla org en us mpl 2 0
mpl-1.1 | mpl 1 1 | mozilla public licen[cs]e version|v? 1 1 | mozilla org mpl mpl 1 1 ; mozilla org mpl 1 1
mpl | mpl | mozilla public licen[cs]e | mozilla org mpl
epl-2.0 | epl 2 0; epl v2 | eclipse public licen[cs]e version|v? 2 0 | eclipse org legal epl 2 0 ; eclipse org legal epl v20 html
epl-1.0 | epl 1 0; epl v1 | eclipse public licen[cs]e version|v? 1 0 | eclipse org legal epl v10 html
epl | epl | eclipse public licen[cs]e ; eclipse distribution licen[cs]e | eclipse org legal epl
cddl-1.1 | cddl 1 1 | common development and distribution licen[cs]e version|v? 1 1 | glassfish java net public cddl gpl 1 1
cddl-1.0 | cddl 1 0; cddl | common development and distribution licen[cs]e version|v? 1? 0? | opensource org licenses? cddl 1 0 ; sun com cddl
cpl-1.0 | cpl 1 0; cpl | common public licen[cs]e version|v? 1? 0? | opensource org licenses? cpl 1 0
eupl-1.2 | eupl 1 2 | european union public licen[cs]e version|v? 1 2 ; eupl version|v? 1 2 | joinup ec europa eu ..6 eupl ..3
eupl | eupl; eupl 1 1 | european union public licen[cs]e | ec europa eu idabc eupl
artistic-2.0 | artistic 2 0 | artistic licen[cs]e version|v? 2 0 | perlfoundation org artistic licen[cs]e 2 0 ; opensource org licenses? artistic 2 0
artistic-1.0 | artistic 1 0; artistic 1 0 perl | artistic licen[cs]e version|v? 1 0 ; perl artistic licen[cs]e ; same terms as perl itself | dev perl org licenses artistic html
zlib | zlib; zlib libpng | zlib licen[cs]e ; zlib libpng licen[cs]e | zlib net zlib licen[cs]e html ; opensource org licenses? zlib
libpng | libpng; libpng 2 0 | libpng licen[cs]e ; png reference library licen[cs]e | libpng org pub png src libpng licen[cs]e txt
bsl-1.0 | bsl 1 0; boost | boost software licen[cs]e version|v? 1? 0? | boost org licen[cs]e 1 0 txt
busl-1.1 | busl 1 1 | business source licen[cs]e version|v? 1? 1? | mariadb com bsl11
unlicense | unlicense | the unlicense ; unlicense yourself | unlicense org
wtfpl | wtfpl | do what the fuck you want to public licen[cs]e ; wtfpl version|v? 2? | wtfpl net ; sam zoy org wtfpl
cc0-1.0 | cc0 1 0; cc0 | cc0 1 0 universal ; creative commons zero version|v? 1? 0? ; cc0 public domain dedication | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | cc pdm 1 0 | creative commons public domain mark 1? 0? | creativecommons org publicdomain mark 1 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | creative commons attribution non commercial no derivatives 4 0 ; cc by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd | cc by nc nd 3 0; cc by nc nd 2 0; cc by nc nd | creative commons attribution non? commercial|noncommercial no? derivs|derivatives|noderivs|noderivatives | creativecommons org licenses by nc nd
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | creative commons attribution non? commercial|noncommercial share? alike|sharealike 4 0 ; cc by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa | cc by nc sa 3 0; cc by nc sa 2 0; cc by nc sa | creative commons attribution non? commercial|noncommercial share? alike|sharealike | creativecommons org licenses by nc sa
cc-by-nc-4.0 | cc by nc 4 0 | creative commons attribution non? commercial|noncommercial 4 0 ; cc by nc 4 0 | creativecommons org licenses by nc 4 0
cc-by-nc | cc by nc 3 0; cc by nc 2 0; cc by nc | creative commons attribution non? commercial|noncommercial | creativecommons org licenses by nc
cc-by-nd-4.0 | cc by nd 4 0 | creative commons attribution no? derivs|derivatives|noderivs|noderivatives 4 0 ; cc by nd 4 0 | creativecommons org licenses by nd 4 0
cc-by-nd | cc by nd 3 0; cc by nd 2 0; cc by nd | creative commons attribution no? derivs|derivatives|noderivs|noderivatives | creativecommons org licenses by nd
cc-by-sa-4.0 | cc by sa 4 0 | creative commons attribution share? alike|sharealike 4 0 ; cc by sa 4 0 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | cc by sa 3 0 | creative commons attribution share? alike|sharealike 3 0 ; cc by sa 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa | cc by sa 2 0; cc by sa 2 5; cc by sa | creative commons attribution share? alike|sharealike | creativecommons org licenses by sa
cc-by-4.0 | cc by 4 0 | creative commons attribution 4 0 international? ; cc by 4 0 | creativecommons org licenses by 4 0
cc-by-3.0 | cc by 3 0 | creative commons attribution 3 0 unported? ; cc by 3 0 | creativecommons org licenses by 3 0
cc-by-2.0 | cc by 2 0; cc by 2 5 | creative commons attribution 2 0|5 | creativecommons org licenses by 2 0|5
creative-commons | cc by | creative commons attribution licen[cs]e? ; creative commons licen[cs]e | creativecommons org licenses
odbl-1.0 | odbl 1 0; odbl | open database licen[cs]e version|v? 1? 0? ; odc open database licen[cs]e | opendatacommons org licenses odbl
odc-by-1.0 | odc by 1 0; odc by | open data commons attribution licen[cs]e | opendatacommons org licenses by
pddl-1.0 | pddl 1 0; pddl | public domain dedication and licen[cs]e ; open data commons public domain dedication | opendatacommons org licenses pddl
ofl-1.1 | ofl 1 1; ofl | sil open font licen[cs]e version|v? 1? 1? ; open font licen[cs]e version|v? 1? 1? | openfontlicense org ofl ; openfontlicense org
psf-2.0 | psf 2 0; python 2 0; psfl | python software foundation licen[cs]e version|v? 2? ; psf licen[cs]e | docs python org ..3 licen[cs]e html
ruby | ruby | ruby licen[cs]e ; same terms as ruby | ruby lang org en about licen[cs]e txt
php-3.01 | php 3 01; php 3 0 | php licen[cs]e version|v? 3? 01|0? | php net licen[cs]e 3 01 txt
postgresql | postgresql | postgresql licen[cs]e | postgresql org about licence
openssl | openssl | openssl licen[cs]e ; openssl and ssleay licen[cs]e | openssl org source licen[cs]e html
ms-pl | ms pl | microsoft public licen[cs]e ; ms pl licen[cs]e | opensource org licenses? ms pl
ms-rl | ms rl | microsoft reciprocal licen[cs]e | opensource org licenses? ms rl
sspl-1.0 | sspl 1 0; sspl | server side public licen[cs]e version|v? 1? | mongodb com licensing server side public licen[cs]e
elastic-2.0 | elastic 2 0 | elastic licen[cs]e version|v? 2? 0? | elastic co licensing elastic licen[cs]e
polyform-noncommercial | polyform noncommercial 1 0 0 | polyform noncommercial licen[cs]e | polyformproject org licenses noncommercial
openrail | openrail; bigscience openrail m; creativeml openrail m | open rail m? licen[cs]e ; openrail m? licen[cs]e ; responsible ai licen[cs]e | huggingface co spaces bigscience licen[cs]e
beerware | beerware | beer ware licen[cs]e ; beerware licen[cs]e | people freebsd org phk
"""

#: label | weight | pattern: sentences that occur in one family of texts only.
CLAUSES = """
gpl-3.0 | 0.95 | the gnu general public licen[cs]e is a free copyleft licen[cs]e for software
gpl | 0.9 | gnu general public licen[cs]e as published by the free software foundation
gpl | 0.8 | you should have received a copy of the gnu general public licen[cs]e
lgpl | 0.8 | you should have received a copy of the gnu lesser general public licen[cs]e
agpl-3.0 | 0.8 | you should have received a copy of the gnu affero general public licen[cs]e
gpl | 0.7 | gnu gpl
gpl | 0.7 | gnu public licen[cs]e
gpl | 0.75 | under the gpl licen[cs]e
apache-2.0 | 0.9 | you may not use this file except in compliance with the licen[cs]e
apache-2.0 | 0.8 | unless required by applicable law or agreed to in writing software ..4 under the licen[cs]e
apache | 0.8 | licensed to the apache software foundation asf? under one or more contributor licen[cs]e agreements
mit | 0.95 | permission is hereby granted free of charge to any person obtaining a copy ..6 software ..20 without restriction
mit | 0.8 | the above copyright notice and this permission notice shall be included in all copies
isc | 0.9 | permission to use copy modify and or distribute this software for any purpose with or without fee
bsd | 0.9 | redistribution and use in source and binary forms with or without modification are permitted
bsd | 0.8 | redistributions of source code must retain the above copyright notice
bsd-3-clause | 0.85 | neither the names? of ..8 nor the names of its contributors may be used to endorse or promote
bsd-4-clause | 0.9 | all advertising materials mentioning features or use of this software must display
zlib | 0.85 | this software is provided as is without any express or implied warranty ..20 permission is granted to anyone to use
zlib | 0.9 | altered source versions must be plainly marked as such
mpl-2.0 | 0.95 | this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0
mpl-1.1 | 0.9 | the contents of this file are subject to the mozilla public licen[cs]e
epl | 0.9 | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e
bsl-1.0 | 0.9 | permission is hereby granted free of charge to any person or organization obtaining a copy
unlicense | 0.95 | this is free and unencumbered software released into the public domain
public-domain | 0.7 | released|placed|dedicated into|in|to the public domain
public-domain | 0.6 | in the public domain ..6 copyright
public-domain | 0.7 | waives? all copyright and related
ofl-1.1 | 0.9 | this font software is licensed under the sil open font licen[cs]e
cc0-1.0 | 0.85 | to the extent possible under law ..12 waived all copyright
creative-commons | 0.8 | this work is licensed under a creative commons
creative-commons | 0.8 | diese[sr]? werk|inhalt ist lizenziert unter einer creative commons ..4 lizenz
creative-commons | 0.8 | cette oeuvre est mise a|à disposition ..3 licen[cs]e creative commons
creative-commons | 0.8 | esta obra est[aá] bajo una licencia ..3 creative commons
beerware | 0.9 | as long as you retain this notice you can do whatever you want with this stuff
proprietary | 0.6 | all rights reserved ..6 copyright
proprietary | 0.6 | copyright ..8 all rights reserved
proprietary | 0.75 | this software is proprietary and confidential ..12 licen[cs]e
proprietary | 0.7 | unauthorized copying of this file ..10 strictly prohibited ..20 copyright
proprietary | 0.7 | end user licen[cs]e agreement
proprietary | 0.6 | no part of this publication may be reproduced ..30 copyright
source-available | 0.6 | commons clause licen[cs]e condition
non-commercial | 0.6 | for non? commercial|noncommercial use only ..8 licen[cs]e
research-only | 0.6 | for research purposes only ..8 licen[cs]e
dual | 0.6 | dual licensed under
unstated | 0.4 | see the? licen[cs]e file for details
unstated | 0.4 | licensed under the terms of
unstated | 0.3 | released under an? open source licen[cs]e
unstated | 0.3 | freely redistributable ..4 licen[cs]e
"""

_GIVEN = "licensed|released|distributed|available|published|provided|covered|governed|offered|shared"
_PLAIN = re.compile(r"[0-9a-z]+$")
_MANY = re.compile(r"\.\.([0-9]+)$")

#: Every pattern demands one of these, so a text without any is not looked at further.
GATE = (
    "licen", "lizen", "copyright", "spdx", "gnu", "commons", "opensource", "gpl", "bsd", "mozilla",
    "eclipse", "domain", "permission", "permitted", "contributors", "advertising", "altered",
    "retain", "cddl", "eupl", "bsl11", "wtfpl", "gfdl", "terms", "cc0", "openfont", "cc",
)


def words_pattern(signature: str) -> str:
    """The regular expression of a signature, over a text with every word between two spaces of its own."""
    out = []
    for token in signature.split():
        many = _MANY.match(token)
        if many:
            out.append(f"(?: [^ ]+ ){{0,{many[1]}}}")
        elif token.endswith("?") and not token.endswith(")?"):
            out.append(f"(?: (?:{token[:-1]}) )?")
        else:
            out.append(f" (?:{token}) " if "|" in token else f" {token} ")
    return "".join(out)


def demanded(signature: str) -> list[str]:
    """The runs of plain words that each match must hold, rendered as the text has them."""
    runs, run = [], ""
    for token in [*signature.split(), "?"]:
        if _PLAIN.match(token):
            run += f" {token} "
        elif run:
            runs.append(run)
            run = ""
    return runs


def keyword_of(signature: str) -> str:
    """The longest of the demanded runs: the keyword that gates the rule."""
    runs = demanded(signature)
    if not runs:
        raise ValueError(f"no plain word in {signature!r}")
    return max(runs, key=len)


def _rules() -> list[Rule]:
    base, spdx, given, clauses, names, places, fields = [], [], [], [], [], [], []

    def add(into: list[Rule], label: str, weight: float, signature: str, own: bool = False) -> None:
        into.append(Rule(label, weight, words_pattern(signature), keyword_of(signature), own))

    for phrase, label in BASE.items():
        add(base, label, 0.9, phrase, True)
    for line in LICENSES.strip().splitlines():
        label, ids, titles, urls = (x.strip() for x in line.split(" | "))
        for one in ids.split(";"):
            add(spdx, label, 1.0, f"spdx license identifier {one}")
            add(fields, label, 0.9, f"license {one}")
        for one in titles.split(";"):
            add(given, label, 0.97, f"{_GIVEN} under|by|as the? terms? of? the? {one}")
            add(names, label, 0.85, one)
        for one in urls.split(";"):
            add(places, label, 0.9, one)
    for line in CLAUSES.strip().splitlines():
        label, weight, signature = (x.strip() for x in line.split(" | "))
        add(clauses, label, float(weight), signature)
    return [*spdx, *given, *clauses, *places, *names, *fields, *base]


#: All rules, by priority.
RULES = _rules()
