"""License scans: ordered signature rules behind a keyword prefilter.

A rule is a regular expression over the normalised text (words in lower case, one space
between), with a keyword that must occur before the expression is tried, a priority and a
label. Of detections whose word intervals lie inside one another the one of the better
priority stays, then the longer, then the one of the earlier rule; an interval that is
contained in a surviving one, and has no better priority, is suppressed.

Defined results for odd input: a null or empty text has no words, no labels and score 0; a text of any
length is scanned whole; rows that repeat an id are scanned each; an empty table gives an empty result; other columns
pass through, one that has the name of the added column as name + ``_input``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.names import clear_of

#: Everything that is not a letter, a digit or a byte of a longer code point becomes a space.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_FOLD = _FOLD.translate(bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)))

#: Base phrases and their labels: fixed values.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
_BASE = [(label, re.compile(rb"(?<![^ ])" + phrase.encode() + rb"(?![^ ])")) for phrase, label in BASE]
#: Bytes of text in which detections are held against one another.
STRETCH = 256


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int  # smaller is better
    keyword: bytes
    pattern: re.Pattern[bytes]
    weight: float


# Written by hand: label | names, as expressions over normalised words | identifiers in tag form | words of the licence's own text.
FAMILIES = r"""
mit | mit (?:x11 )?licen[cs]e ; x11 mit licen[cs]e ; expat licen[cs]e | mit ; mit 0 ; x11 | permission is hereby granted free of charge to any person obtaining a copy ; the software is provided as is without warranty of any kind
apache-2.0 | apache (?:software )?licen[cs]e (?:version )?2(?: 0)? ; apache 2(?: 0)? licen[cs]e ; asl 2 0 | apache 2 0 | licensed to the apache software foundation ; unless required by applicable law or agreed to in writing
apache-1.1 | apache (?:software )?licen[cs]e (?:version )?1 1 | apache 1 1 | this product includes software developed by the apache software foundation
apache-1.0 | apache (?:software )?licen[cs]e (?:version )?1 0 | apache 1 0 |
gpl-3.0 | (?:gnu )?general public licen[cs]e (?:version |v)?3(?: 0)? ; gpl ?v?3(?: 0)? ; gplv3 | gpl 3 0(?: only| or later)? | either version 3 of the licen[cs]e
gpl-2.0 | (?:gnu )?general public licen[cs]e (?:version |v)?2(?: 0)? ; gpl ?v?2(?: 0)? ; gplv2 | gpl 2 0(?: only| or later)? | either version 2 of the licen[cs]e ; you should have received a copy of the gnu general public licen[cs]e
gpl-1.0 | (?:gnu )?general public licen[cs]e (?:version |v)?1(?: 0)? | gpl 1 0(?: only| or later)? |
agpl-3.0 | (?:gnu )?affero general public licen[cs]e(?: (?:version |v)?3(?: 0)?)? ; agpl ?v?3(?: 0)? | agpl 3 0(?: only| or later)? |
lgpl-3.0 | (?:gnu )?lesser general public licen[cs]e (?:version |v)?3(?: 0)? ; lgpl ?v?3(?: 0)? | lgpl 3 0(?: only| or later)? |
lgpl-2.1 | (?:gnu )?lesser general public licen[cs]e(?: (?:version |v)?2 1)? ; lgpl ?v?2 1 | lgpl 2 1(?: only| or later)? |
lgpl-2.0 | (?:gnu )?library general public licen[cs]e(?: (?:version |v)?2(?: 0)?)? | lgpl 2 0(?: only| or later)? |
gfdl | (?:gnu )?free documentation licen[cs]e(?: (?:version |v)?1 [123])? | gfdl 1 [123](?: only| or later)? | permission is granted to copy distribute and or modify this document
bsd-3-clause | (?:new|modified|revised|3 clause) bsd licen[cs]e ; bsd 3 clause(?: licen[cs]e)? | bsd 3 clause(?: clear)? | neither the name of .{1,80}? may be used to endorse or promote products
bsd-2-clause | (?:simplified|freebsd|2 clause) bsd licen[cs]e ; bsd 2 clause(?: licen[cs]e)? | bsd 2 clause(?: patent)? |
bsd-4-clause | (?:original|old|4 clause) bsd licen[cs]e ; bsd 4 clause(?: licen[cs]e)? | bsd 4 clause | all advertising materials mentioning features or use of this software
bsd | bsd (?:style )?licen[cs]e ; bsd licensed | 0bsd | redistribution and use in source and binary forms with or without modification
isc | isc licen[cs]e | isc | permission to use copy modify and or distribute this software for any purpose
zlib | zlib(?: libpng)? licen[cs]e | zlib | altered source versions must be plainly marked as such
libpng | libpng licen[cs]e | libpng 2 0 |
mpl-2.0 | mozilla public licen[cs]e (?:version |v)?2(?: 0)? ; mpl ?v?2(?: 0)? | mpl 2 0 | this source code form is subject to the terms of the mozilla public licen[cs]e
mpl-1.1 | mozilla public licen[cs]e (?:version |v)?1 1 ; mpl ?v?1 1 | mpl 1 1 |
mpl | mozilla public licen[cs]e | mpl 1 0 |
epl-2.0 | eclipse public licen[cs]e (?:version |v)?2(?: 0)? | epl 2 0 |
epl-1.0 | eclipse public licen[cs]e(?: (?:version |v)?1(?: 0)?)? | epl 1 0 |
eupl | european union public licen[cs]e(?: (?:version |v)?1 [012])? | eupl 1 [012] |
cddl | common development and distribution licen[cs]e(?: (?:version |v)?1 [01])? | cddl 1 [01] |
cpl | common public licen[cs]e(?: (?:version |v)?1 0)? | cpl 1 0 |
ms-pl | microsoft public licen[cs]e | ms pl |
ms-rl | microsoft reciprocal licen[cs]e | ms rl |
artistic-2.0 | artistic licen[cs]e (?:version |v)?2(?: 0)? | artistic 2 0 |
artistic-1.0 | artistic licen[cs]e(?: (?:version |v)?1(?: 0)?)? ; perl artistic licen[cs]e | artistic 1 0 |
bsl-1.0 | boost software licen[cs]e(?: (?:version |v)?1 0)? | bsl 1 0 |
unlicense | the unlicense ; unlicensed into the public domain | unlicense | this is free and unencumbered software released into the public domain
cc0-1.0 | cc0(?: 1 0)?(?: universal)? ; creative commons zero | cc0 1 0 | no copyright public domain dedication
cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(?:ative)?s? ; cc by nc nd(?: \d 0)? | cc by nc nd \d 0 |
cc-by-nc-sa | creative commons attribution non ?commercial share ?alike ; cc by nc sa(?: \d 0)? | cc by nc sa \d 0 |
cc-by-nc | creative commons attribution non ?commercial ; cc by nc(?: \d 0)? | cc by nc \d 0 |
cc-by-nd | creative commons attribution no ?deriv(?:ative)?s? ; cc by nd(?: \d 0)? | cc by nd \d 0 |
cc-by-sa | creative commons attribution share ?alike ; cc by sa(?: \d 0)? | cc by sa \d 0 |
cc-by | creative commons attribution ; cc by(?: \d 0)? | cc by \d 0 |
odbl | open (?:data commons open )?database licen[cs]e ; odbl | odbl 1 0 |
odc-by | open data commons attribution licen[cs]e | odc by 1 0 |
pddl | public domain dedication and licen[cs]e | pddl 1 0 |
cdla | community data licen[cs]e agreement(?: permissive| sharing)? | cdla (?:permissive|sharing) [12] 0 |
ofl | sil open font licen[cs]e(?: (?:version |v)?1 [01])? | ofl 1 [01] |
psf-2.0 | python software foundation licen[cs]e ; psf licen[cs]e | psf 2 0 ; python 2 0 |
php | php licen[cs]e(?: (?:version |v)?3 01?)? | php 3 01? |
ruby | ruby licen[cs]e | ruby |
postgresql | postgresql licen[cs]e | postgresql |
openssl | openssl licen[cs]e | openssl | this product includes software developed by the openssl project
wtfpl | do what the fuck you want to public licen[cs]e ; wtfpl | wtfpl |
ncsa | (?:university of illinois )?ncsa open source licen[cs]e | ncsa |
afl | academic free licen[cs]e(?: (?:version |v)?[123] [012])? | afl [123] [012] |
osl | open software licen[cs]e(?: (?:version |v)?[123] [012])? | osl [123] [012] |
sspl | server side public licen[cs]e | sspl 1 0 |
busl | business source licen[cs]e(?: 1 1)? | busl 1 1 |
elastic | elastic licen[cs]e(?: 2 0)? | elastic 2 0 |
rail | (?:open )?rail m? ?licen[cs]e ; responsible ai licen[cs]e | openrail |
vim | vim licen[cs]e | vim |
tcl | tcl tk licen[cs]e | tcl |
zpl | zope public licen[cs]e(?: (?:version |v)?[12] [01])? | zpl [12] [01] |
lppl | latex project public licen[cs]e(?: (?:version |v)?1 [0-3]c?)? | lppl 1 [0-3]c? |
qpl | q public licen[cs]e | qpl 1 0 |
ipl | ibm public licen[cs]e | ipl 1 0 |
npl | netscape public licen[cs]e | npl 1 [01] |
apsl | apple public source licen[cs]e | apsl [12] [012] |
beerware | beer ware licen[cs]e | beerware |
curl | curl licen[cs]e | curl |
json | json licen[cs]e | json | the software shall be used for good not evil
ecl | educational community licen[cs]e | ecl [12] 0 |
cecill | cecill(?: [abc])?(?: free software)? licen[cs]e(?: agreement)? | cecill [12] [01] ; cecill [bc] |
mulan | mulan permissive software licen[cs]e | mulanpsl [12] 0 |
upl | universal permissive licen[cs]e | upl 1 0 |
proprietary | all rights reserved ; proprietary and confidential ; proprietary licen[cs]e | licenseref \w+ | unauthorized copying of this file via any medium is strictly prohibited
public-domain | released (?:in|into|to) the public domain ; public domain work | |
"""


# Written by hand: label | sentences of the licence's own text or of its notice, as expressions over normalised words.
SIGNATURES = r"""
mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit | in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit | this (?:project|package|library|software) is (?:released|licensed|distributed) under (?:the )?(?:terms of the )?mit
apache-2.0 | you may not use this file except in compliance with the licen[cs]e you may obtain a copy of the licen[cs]e at
apache-2.0 | distributed on an as is basis without warranties or conditions of any kind either express or implied
apache-2.0 | see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e
apache-2.0 | www apache org licenses licen[cs]e 2 0
apache-2.0 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e
apache-1.1 | the names apache and apache software foundation must not be used to endorse or promote products
gpl-3.0 | you should have received a copy of the gnu general public licen[cs]e along with this program if not see
gpl-3.0 | gnu general public licen[cs]e as published by the free software foundation either version 3
gpl-3.0 | this is free software and you are welcome to redistribute it under certain conditions
gpl-3.0 | you may convey verbatim copies of the program s source code as you receive it
gpl-2.0 | gnu general public licen[cs]e as published by the free software foundation either version 2
gpl-2.0 | if not write to the free software foundation inc .{1,60}? (?:fifth floor boston|temple place)
gpl-2.0 | the licenses for most software are designed to take away your freedom to share and change it
gpl-2.0 | you may copy and distribute verbatim copies of the program s source code as you receive it
gpl-1.0 | gnu general public licen[cs]e as published by the free software foundation either version 1
lgpl-3.0 | gnu lesser general public licen[cs]e as published by the free software foundation either version 3
lgpl-2.1 | gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1
lgpl-2.0 | gnu library general public licen[cs]e as published by the free software foundation either version 2
lgpl-2.1 | you should have received a copy of the gnu lesser general public licen[cs]e along with this library
agpl-3.0 | gnu affero general public licen[cs]e as published by the free software foundation either version 3
agpl-3.0 | must prominently offer all users interacting with it remotely through a computer network
gfdl | with no invariant sections no front cover texts and no back cover texts
bsd-3-clause | neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
bsd-3-clause | the name of the author may not be used to endorse or promote products derived from this software
bsd | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd | this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is and any express or implied warranties
bsd-4-clause | must display the following acknowledgement this product includes software developed by
bsd-2-clause | the views and conclusions contained in the software and documentation are those of the authors
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | the software is provided as is and the author disclaims all warranties with regard to this software
zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | this notice may not be removed or altered from any source distribution
libpng | the png reference library is supplied as is
mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-2.0 | mozilla org mpl 2 0
mpl-1.1 | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v )?2 0
epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0
cddl | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
cpl | the accompanying program is provided under the terms of this common public licen[cs]e
eupl | licensed under the eupl
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e
unlicense | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
unlicense | for more information please refer to (?:http|https) unlicense org
cc0-1.0 | the person who associated a work with this deed has dedicated the work to the public domain
cc0-1.0 | to the extent possible under law .{1,80}? has waived all copyright and related or neighboring rights
cc-by-sa | this work is licensed under (?:a|the) creative commons attribution share ?alike
cc-by-nc-sa | this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike
cc-by-nc-nd | this work is licensed under (?:a|the) creative commons attribution non ?commercial no ?deriv
cc-by-nc | creativecommons org licenses by nc \d 0
cc-by-sa | creativecommons org licenses by sa \d 0
cc-by-nd | creativecommons org licenses by nd \d 0
cc-by-nc-sa | creativecommons org licenses by nc sa \d 0
cc-by-nc-nd | creativecommons org licenses by nc nd \d 0
cc-by | creativecommons org licenses by \d 0
cc0-1.0 | creativecommons org publicdomain zero 1 0
odbl | is made available under the open database licen[cs]e
ofl | this font software is licensed under the sil open font licen[cs]e
ofl | reserved font name refers to any names specified as such after the copyright statement
psf-2.0 | psf is making python available to licensee on an as is basis
php | this product includes php software freely available from
ruby | you may make and give away verbatim copies of the source form of the software without restriction
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
openssl | for use in the openssl toolkit
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document and changing it is allowed as long as the name is changed
ncsa | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers
artistic-1.0 | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
ms-pl | if you use the software you accept this licen[cs]e if you do not accept the licen[cs]e do not use the software
beerware | you can buy me a beer in return
vim | there are no restrictions on distributing unmodified copies of vim
lppl | this work may be distributed and or modified under the conditions of the latex project public licen[cs]e
sspl | offering the service source code
busl | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic | you may not provide the software to third parties as a hosted or managed service
rail | use based restrictions as referenced in paragraph 5
proprietary | no part of this (?:publication|work|document) may be reproduced (?:or transmitted )?in any form
proprietary | this (?:file|software|document) contains confidential and proprietary information
public-domain | the authors? (?:hereby )?(?:disclaims?|dedicates?) .{0,40}?copyright to this source code
"""


def _literal(pattern: str) -> bytes:
    """The longest run of plain words of a pattern: what a text must hold before the pattern can match."""
    plain = re.sub(r"\(\?:(?:[^()]|\([^()]*\))*\)\??|\[[^\]]*\][?+*]?|\\\w[?+*]?|.\{[^}]*\}\??|[a-z0-9 ]\?", "\0", pattern)
    words = max((w.strip() for w in plain.split("\0")), key=len)
    return words.encode()


def build_rules() -> tuple[Rule, ...]:
    """All rules in order: own text and tags first, then grants, links and plain names."""
    rules: list[Rule] = []

    def add(label: str, priority: int, pattern: str, weight: float) -> None:
        rules.append(Rule(label, priority, _literal(pattern), re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])", re.DOTALL), weight))

    split = lambda cell: [x.strip() for x in cell.split(" ; ") if x.strip()]
    for line in FAMILIES.strip().splitlines():
        label, names, tags, own = [*map(str.strip, line.split(" | ")), "", ""][:4] if line.count(" | ") >= 2 else (line, "", "", "")
        names, tags, own = split(names), split(tags.removesuffix("|").strip()), split(own.removesuffix("|").strip())
        for p in own:
            add(label, 1, p, 1.0)
        for p in tags:
            add(label, 0, "spdx licen[cs]e identifier " + p, 1.0)
            add(label, 2, "(?:opensource|spdx) org licenses " + p, 0.9)
        for p in names:
            add(label, 2, "(?:licensed|released|distributed|available|published|provided) under (?:the (?:terms of the )?)?" + p, 0.9)
            add(label, 3, p, 0.6)
    for line in SIGNATURES.strip().splitlines():
        label, own = map(str.strip, line.split(" | ", 1))
        add(label, 1, own, 1.0)
    return tuple(rules)


RULES = build_rules()


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").encode().translate(_FOLD).split())


def detections(norm: bytes, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, Rule]]:
    """Surviving detections (first word, end word, rule) of a normalised text, in order of place."""
    found = []
    for order, rule in enumerate(rules):
        if rule.keyword in norm:
            for m in rule.pattern.finditer(norm):
                found.append((m.start(), m.end(), rule.priority, order))
    if not found:
        return []
    # best first; a detection goes if one that is at least as good already holds all of it
    found.sort(key=lambda x: (x[2], x[0] - x[1], x[3], x[0]))
    kept: list[tuple[int, int, int, int]] = []
    near: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # by stretch of text, for long lists
    for one in found:
        if not any(k[0] <= one[0] and one[1] <= k[1] for k in near[one[0] // STRETCH]):
            kept.append(one)
            for at in range(one[0] // STRETCH, one[1] // STRETCH + 1):
                near[at].append(one)
    # and a plain name that holds a better one inside says no more than that one
    inside = lambda one, k: k is not one and one[0] <= k[0] and k[1] <= one[1] and k[2] < one[2]
    kept = [one for one in kept if not any(inside(one, k) for at in range(one[0] // STRETCH, one[1] // STRETCH + 1) for k in near[at])]
    kept.sort()
    first = word_numbers(norm, [k[0] for k in kept])
    last = dict(zip(ends := sorted({k[1] for k in kept}), word_numbers(norm, ends), strict=True))
    return [(a, last[k[1]] + 1, rules[k[3]]) for a, k in zip(first, kept, strict=True)]


def word_numbers(norm: bytes, places: list[int]) -> list[int]:
    """The number of the word at each of the ascending byte places, in one pass over the text."""
    out, word, at = [], 0, 0
    for place in places:
        word += norm.count(b" ", at, place)
        at = place
        out.append(word)
    return out


def base_places(norm: bytes) -> list[tuple[int, str]]:
    """Places (first word, label) where the words of a base phrase stand consecutively."""
    found = sorted((m.start(), label) for label, pattern in _BASE for m in pattern.finditer(norm))
    return [*zip(word_numbers(norm, [a for a, _ in found]), (label for _, label in found), strict=True)]


def scan_text(text: str | None) -> tuple:
    norm = normalised(text)
    n_words = norm.count(b" ") + 1 if norm else 0
    base = base_places(norm) if b"license" in norm else []
    found = detections(norm)
    labels = {label for _, label in base}
    base_labels = ",".join(sorted(labels))
    spans = [f"{r.label}:{a}-{b}" for a, b, r in found]
    labels |= {r.label for _, _, r in found}
    # the share of detections that err is taken as independent; a base phrase counts like a plain name
    miss = 1.0
    for _, _, r in found:
        miss *= 1 - r.weight
    for _ in base:
        miss *= 0.5
    first, last = (base[0][0], base[-1][0]) if base else (None, None)
    return n_words, len(base), first, last, base_labels, ",".join(sorted(labels)), 1 - miss, spans


KIND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"
FIELDS = [x.split()[0] for x in KIND.split(", ")]


def scan(text: Column) -> Column:
    """A struct of what the rules find in a whole text."""

    @F.pandas_udf(KIND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            got = pd.DataFrame([scan_text(t) for t in texts], columns=FIELDS)
            yield got.astype({c: "Int64" for c in FIELDS[:4]})

    return run(text)


def license_scan(docs: DataFrame, text_col: str = "text", out_col: str = "licenses") -> DataFrame:
    """Add a struct column with words, base places, labels, score and surviving spans."""
    named = clear_of(docs, out_col)
    return named.withColumn(out_col, scan(named[named.columns[docs.columns.index(text_col)]]))
