"""Signature rules of license notices: label | priority | words that must all occur | pattern.

Patterns are written over a text's words in lower case with one blank between them ("Apache License, Version 2.0" reads
`apache license version 2 0`), and match from the begin of a word to the end of one. {l} is the word license in its
spellings, {v} what may stand before a version's number, {0} a minor version of zero, {w:n} up to n words of any kind.
Among overlapping detections a higher priority wins: 9 grants and texts, 8 names with version and option, 7 names with
version, 5 abbreviations with version, 4 names and tags, 2 hints.
"""

from __future__ import annotations

import re
from typing import NamedTuple

MACROS = {"{l}": "(?:license|licence|licenses|licences)", "{v}": "(?:version |ver |v ?)?", "{0}": "(?: 0)?"}

#: Phrases and labels of the base scan.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

TABLE = r"""
# the GNU licenses
gpl-1.0 | 7 | general public | (?:gnu )?general public {l}(?: gpl)? {v}1{0}
gpl-2.0 | 7 | general public | (?:gnu )?general public {l}(?: gpl)? {v}2{0}
gpl-3.0 | 7 | general public | (?:gnu )?general public {l}(?: gpl)? {v}3{0}
gpl-2.0-only | 8 | general public only | (?:gnu )?general public {l}(?: gpl)? {v}2{0} only
gpl-3.0-only | 8 | general public only | (?:gnu )?general public {l}(?: gpl)? {v}3{0} only
gpl-1.0-or-later | 8 | general public later | (?:gnu )?general public {l}(?: gpl)? {v}1{0} or(?: at your option)?(?: any)? later(?: version)?
gpl-2.0-or-later | 8 | general public later | (?:gnu )?general public {l}(?: gpl)? {v}2{0} or(?: at your option)?(?: any)? later(?: version)?
gpl-3.0-or-later | 8 | general public later | (?:gnu )?general public {l}(?: gpl)? {v}3{0} or(?: at your option)?(?: any)? later(?: version)?
gpl-2.0-or-later | 9 | general public later | general public {l} as published by the free software foundation either version 2 of the {l} or at your option any later version
gpl-3.0-or-later | 9 | general public later | general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
gpl-2.0-only | 9 | general public foundation | general public {l} version 2 as published by the free software foundation
gpl-3.0-only | 9 | general public foundation | general public {l} version 3 as published by the free software foundation
gpl-1.0 | 5 | gpl | gpl {v}1{0}
gpl-1.0 | 5 | gplv1 | gplv1(?: 0)?
gpl-2.0 | 5 | gpl | gpl {v}2{0}
gpl-2.0 | 5 | gplv2 | gplv2(?: 0)?
gpl-2.0 | 5 | gpl2 | gpl2
gpl-3.0 | 5 | gpl | gpl {v}3{0}
gpl-3.0 | 5 | gplv3 | gplv3(?: 0)?
gpl-3.0 | 5 | gpl3 | gpl3
gpl-2.0-only | 6 | gpl only | gpl {v}2{0} only
gpl-3.0-only | 6 | gpl only | gpl {v}3{0} only
gpl-2.0-or-later | 6 | gpl later | gpl {v}2{0} or(?: any)? later
gpl-3.0-or-later | 6 | gpl later | gpl {v}3{0} or(?: any)? later
gpl-2.0-or-later | 6 | gplv2 later | gplv2 or(?: any)? later
gpl-3.0-or-later | 6 | gplv3 later | gplv3 or(?: any)? later
gpl-unversioned | 4 | gpl | (?:gnu )?gpl {l}
gpl-unversioned | 4 | gpl under | (?:released|licensed|distributed) under (?:the )?(?:terms of the )?(?:gnu )?gpl
gpl-classpath-exception | 7 | classpath exception | (?:with )?(?:the )?classpath (?:linking )?exception
gpl-font-exception | 7 | font exception | (?:with )?(?:the )?font (?:embedding )?exception
gpl-gcc-exception | 7 | gcc exception | gcc runtime library exception
gpl-linking-exception | 7 | linking exception | (?:with )?(?:a |the )?(?:special )?linking exception
gpl-bison-exception | 7 | bison exception | (?:with )?(?:the )?bison (?:parser )?exception
gpl-autoconf-exception | 7 | autoconf exception | (?:with )?(?:the )?autoconf (?:configure )?(?:script )?exception
gpl-compatible | 2 | gpl compatible | gpl compatible
lgpl-2.0 | 7 | library public | (?:gnu )?library general public {l}(?: lgpl)? {v}2{0}
lgpl-2.1 | 7 | lesser public | (?:gnu )?lesser general public {l}(?: lgpl)? {v}2 1
lgpl-3.0 | 7 | lesser public | (?:gnu )?lesser general public {l}(?: lgpl)? {v}3{0}
lgpl-2.1-or-later | 8 | lesser public later | (?:gnu )?lesser general public {l}(?: lgpl)? {v}2 1 or(?: at your option)?(?: any)? later(?: version)?
lgpl-3.0-or-later | 8 | lesser public later | (?:gnu )?lesser general public {l}(?: lgpl)? {v}3{0} or(?: at your option)?(?: any)? later(?: version)?
lgpl-2.0-or-later | 9 | library public later | library general public {l} as published by the free software foundation either version 2 of the {l} or at your option any later version
lgpl-2.1-or-later | 9 | lesser public later | lesser general public {l} as published by the free software foundation either version 2 1 of the {l} or at your option any later version
lgpl-3.0-or-later | 9 | lesser public later | lesser general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
lgpl-2.0 | 5 | lgpl | lgpl {v}2 0
lgpl-2.1 | 5 | lgpl | lgpl {v}2 1
lgpl-3.0 | 5 | lgpl | lgpl {v}3{0}
lgpl-2.1 | 5 | lgplv2 | lgplv2(?: 1)?
lgpl-3.0 | 5 | lgplv3 | lgplv3(?: 0)?
lgpl-2.1-or-later | 6 | lgpl later | lgpl {v}2 1 or(?: any)? later
lgpl-3.0-or-later | 6 | lgpl later | lgpl {v}3{0} or(?: any)? later
lgpl-unversioned | 4 | lgpl | (?:gnu )?lgpl {l}
lgpl-unversioned | 4 | lesser public | (?:gnu )?lesser general public {l}
lgpl-unversioned | 4 | library public | gnu library general public {l}
agpl-1.0 | 7 | affero public | affero general public {l} {v}1{0}
agpl-3.0 | 7 | affero public | (?:gnu )?affero general public {l}(?: agpl)? {v}3{0}
agpl-3.0-or-later | 8 | affero public later | (?:gnu )?affero general public {l}(?: agpl)? {v}3{0} or(?: at your option)?(?: any)? later(?: version)?
agpl-3.0-or-later | 9 | affero public later | affero general public {l} as published by the free software foundation either version 3 of the {l} or at your option any later version
agpl-3.0 | 5 | agpl | agpl {v}3{0}
agpl-3.0 | 5 | agplv3 | agplv3(?: 0)?
agpl-3.0-or-later | 6 | agpl later | agpl {v}3{0} or(?: any)? later
agpl-unversioned | 4 | affero public | (?:gnu )?affero general public {l}
agpl-unversioned | 4 | agpl | agpl {l}
gfdl-1.1 | 7 | documentation gnu | gnu free documentation {l} {v}1 1
gfdl-1.2 | 7 | documentation gnu | gnu free documentation {l} {v}1 2
gfdl-1.3 | 7 | documentation gnu | gnu free documentation {l} {v}1 3
gfdl-1.3 | 5 | gfdl | gfdl {v}1 3
gfdl-1.2 | 5 | gfdl | gfdl {v}1 2
gfdl-unversioned | 4 | documentation gnu | gnu free documentation {l}
gfdl-no-invariants | 8 | invariant sections | with no invariant sections
gnu-all-permissive | 9 | copying modification medium | copying and distribution of this file with or without modification are permitted in any medium
gnu-free-software | 9 | redistribute gnu modify | (?:is )?free software you can redistribute it and or modify it under the terms of the gnu (?:lesser |library |affero )?general public {l}
gnu-no-warranty | 8 | hope useful warranty | distributed in the hope that it will be useful but without any warranty
# Apache, MIT, BSD, ISC and their kin
apache-1.0 | 7 | apache | apache(?: software)? {l} {v}1 0
apache-1.1 | 7 | apache | apache(?: software)? {l} {v}1 1
apache-2.0 | 7 | apache | apache(?: software)? {l} {v}2{0}
apache-2.0 | 5 | apache | apache {v}2 0
apache-2.0 | 5 | asl | asl {v}2 0
apache-2.0 | 9 | apache compliance | licensed under the apache {l} version 2 0 the {l} you may not use this file except in compliance
apache-2.0 | 9 | apache www | (?:http|https) www apache org {l} {l} 2 0
apache-2.0-llvm-exception | 8 | apache llvm | apache {l} {v}2{0} with llvm exceptions?
apache-unversioned | 4 | apache | (?:the )?apache software {l}
mit | 7 | mit under | (?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit {l}
mit | 5 | mit | mit (?:x11|expat) {l}
mit | 9 | hereby permission obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 8 | substantial portions | shall be included in all copies or substantial portions of the software
mit-0 | 8 | mit attribution | mit no attribution(?: {l})?
mit-0 | 5 | mit | mit 0
mit-x11 | 5 | x11 | x11 {l}
expat | 5 | expat | expat {l}
mit-modern | 5 | mit modern | mit {l} modern variant
bsd-2-clause | 7 | bsd clause | (?:simplified )?bsd 2 clause(?: {l})?
bsd-2-clause | 7 | bsd clause | (?:2|two) clause bsd(?: {l})?
bsd-2-clause | 7 | bsd simplified | simplified bsd {l}
bsd-2-clause | 7 | freebsd | freebsd {l}
bsd-3-clause | 7 | bsd clause | bsd 3 clause(?: {l})?
bsd-3-clause | 7 | bsd clause | (?:3|three) clause bsd(?: {l})?
bsd-3-clause | 7 | bsd | (?:new|modified|revised) bsd {l}
bsd-3-clause | 8 | neither endorse promote | neither the name of {w:12} nor the names of its contributors may be used to endorse or promote products
bsd-3-clause-clear | 8 | bsd clear | bsd 3 clause clear(?: {l})?
bsd-4-clause | 7 | bsd clause | bsd 4 clause(?: {l})?
bsd-4-clause | 7 | bsd clause | (?:4|four) clause bsd(?: {l})?
bsd-4-clause | 7 | bsd | (?:original|old) bsd {l}
bsd-4-clause | 8 | advertising acknowledgement | advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-0-clause | 7 | bsd clause | bsd (?:0|zero) clause(?: {l})?
bsd-0-clause | 7 | bsd clause | (?:0|zero) clause bsd(?: {l})?
bsd-0-clause | 5 | 0bsd | 0bsd
bsd-1-clause | 7 | bsd clause | bsd (?:1|one) clause(?: {l})?
bsd-protection | 7 | bsd protection | bsd protection {l}
bsd-patent | 7 | bsd patent | bsd 2 clause plus patent(?: {l})?
bsd-source-code | 7 | bsd source attribution | bsd source code attribution
bsd-unversioned | 4 | bsd | bsd(?: style| type| like)? {l}
bsd | 9 | redistribution binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that
bsd-disclaimer | 8 | copyright holders contributors | provided by the copyright holders and contributors as is
isc | 7 | isc | isc {l}
isc | 9 | copy modify hereby fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd | 7 | historical notice disclaimer | historical permission notice and disclaimer
hpnd | 8 | copy modify documentation | permission to use copy modify and distribute this software and its documentation for any purpose
ntp | 7 | ntp | ntp {l}
zlib | 7 | zlib | zlib(?: libpng)? {l}
zlib | 9 | liable arising | in no event will the authors be held liable for any damages arising from the use of this software
zlib-acknowledgement | 7 | zlib acknowledgement | zlib libpng {l} with acknowledgement
libpng | 7 | libpng | libpng {l}(?: version 2)?
boost-1.0 | 7 | boost software | boost software {l}(?: {v}1 0)?
boost-1.0 | 5 | bsl | bsl 1 0
unlicense | 7 | unlicense | (?:the )?unlicense
unlicense | 9 | unencumbered domain | free and unencumbered software released into the public domain
wtfpl | 7 | wtfpl | (?:the )?wtfpl(?: {v}2)?
wtfpl | 8 | fuck public | do what the fuck you want to public {l}
beerware | 7 | beerware | beerware(?: {l})?
beerware | 7 | beer ware | beer ware {l}
postgresql | 7 | postgresql | postgresql {l}
python-2.0 | 7 | python foundation | python software foundation {l}(?: {v}2)?
python-2.0 | 5 | psf | psf {l}(?: {v}2)?
python-2.0 | 5 | python | python {l} 2 0
cnri-python | 7 | cnri python | cnri python {l}
php-3.0 | 7 | php | php {l} {v}3 0
php-3.01 | 7 | php | php {l} {v}3 01
php-unversioned | 4 | php | php {l}
ruby | 4 | ruby | ruby {l}
perl-artistic | 7 | perl same terms | (?:under )?the same terms as perl itself
artistic-1.0 | 7 | artistic | artistic {l} {v}1{0}
artistic-2.0 | 7 | artistic | artistic {l} {v}2{0}
artistic-unversioned | 4 | artistic | artistic {l}
clarified-artistic | 7 | clarified artistic | clarified artistic {l}
openssl | 7 | openssl | openssl {l}
ssleay | 7 | ssleay | ssleay {l}
openldap-2.8 | 7 | openldap | openldap public {l}(?: {v}2 8)?
curl | 7 | curl | curl {l}
icu | 7 | icu | icu {l}
unicode-dfs | 7 | unicode | unicode(?: inc)? {l} agreement
unicode-3.0 | 7 | unicode | unicode {l} v3
json | 8 | evil good | the software shall be used for good not evil
ncsa | 7 | illinois ncsa | (?:university of )?illinois ncsa open source {l}
ncsa | 5 | ncsa | ncsa {l}
blueoak-1.0 | 7 | blue oak | blue oak model {l}(?: 1 0 0)?
upl-1.0 | 7 | universal permissive | universal permissive {l}(?: {v}1 0)?
mulan-1.0 | 7 | mulan | mulan (?:psl|permissive software {l}) {v}1
mulan-2.0 | 7 | mulan | mulan (?:psl|permissive software {l}) {v}2
mulan-2.0 | 5 | mulanpsl | mulanpsl(?: 2 0)?
afl-2.1 | 7 | academic free | academic free {l} {v}2 1
afl-3.0 | 7 | academic free | academic free {l} {v}3 0
afl-unversioned | 4 | academic free | academic free {l}
ecl-2.0 | 7 | educational community | educational community {l} {v}2 0
ms-pl | 7 | microsoft public | microsoft public {l}
ms-pl | 5 | ms pl | ms pl
ms-rl | 7 | microsoft reciprocal | microsoft reciprocal {l}
x-consortium | 7 | consortium | x consortium {l}
w3c | 7 | w3c | w3c software(?: notice)?(?: and)?(?: document)? {l}
xfree86-1.1 | 7 | xfree86 | xfree86 {l}(?: {v}1 1)?
tcl | 7 | tcl | tcl tk {l}
vim | 7 | vim | vim {l}
zope-2.1 | 7 | zope | zope public {l}(?: {v}2 1)?
latex-1.3c | 7 | latex | latex project public {l}(?: {v}1 3c?)?
intel-bsd | 7 | intel bsd | intel bsd(?: export)? {l}
naist | 7 | nara institute | nara institute of science and technology {l}
sleepycat | 7 | sleepycat | sleepycat {l}
info-zip | 7 | zip | info zip {l}
freetype | 7 | freetype | freetype(?: project)? {l}
imagemagick | 7 | imagemagick | imagemagick {l}
jasper | 7 | jasper | jasper {l} {v}2 0
libtiff | 7 | libtiff | libtiff {l}
ijg | 7 | jpeg independent | independent jpeg group {l}
sqlite-blessing | 8 | good evil | may you do good and not evil
# file-level and network copyleft
mpl-1.0 | 7 | mozilla public | mozilla public {l}(?: mpl)? {v}1 0
mpl-1.1 | 7 | mozilla public | mozilla public {l}(?: mpl)? {v}1 1
mpl-2.0 | 7 | mozilla public | mozilla public {l}(?: mpl)? {v}2{0}
mpl-1.1 | 5 | mpl | mpl {v}1 1
mpl-2.0 | 5 | mpl | mpl {v}2{0}
mpl-2.0 | 9 | mozilla subject form | this source code form is subject to the terms of the mozilla public {l} v ?2 0
mpl-unversioned | 4 | mozilla public | mozilla public {l}
mpl-2.0-no-copyleft-exception | 8 | incompatible secondary | incompatible with secondary {l}
epl-1.0 | 7 | eclipse public | eclipse public {l}(?: epl)? {v}1{0}
epl-2.0 | 7 | eclipse public | eclipse public {l}(?: epl)? {v}2{0}
epl-1.0 | 5 | epl | epl {v}1{0}
epl-2.0 | 5 | epl | epl {v}2{0}
epl-unversioned | 4 | eclipse public | eclipse public {l}
edl-1.0 | 7 | eclipse distribution | eclipse distribution {l}(?: {v}1{0})?
cddl-1.0 | 7 | cddl | cddl {v}1 0
cddl-1.1 | 7 | cddl | cddl {v}1 1
cddl-1.0 | 7 | common development distribution | common development and distribution {l}(?: cddl)? {v}1 0
cddl-unversioned | 4 | common development distribution | common development and distribution {l}
cpl-1.0 | 7 | common public | common public {l}(?: {v}1 0)?
ipl-1.0 | 7 | ibm public | ibm public {l}(?: {v}1 0)?
eupl-1.1 | 7 | european union public | european union public {l}(?: eupl)? {v}1 1
eupl-1.2 | 7 | european union public | european union public {l}(?: eupl)? {v}1 2
eupl-1.1 | 5 | eupl | eupl {v}1 1
eupl-1.2 | 5 | eupl | eupl {v}1 2
eupl-unversioned | 4 | european union public | european union public {l}
osl-3.0 | 7 | open software | open software {l} {v}3 0
osl-unversioned | 4 | open software | open software {l}
qpl-1.0 | 7 | q public | q public {l}(?: {v}1 0)?
npl-1.1 | 7 | netscape public | netscape public {l}(?: {v}1 [01])?
apsl-2.0 | 7 | apple source | apple public source {l}(?: {v}2 0)?
cpal-1.0 | 7 | common attribution | common public attribution {l}(?: {v}1 0)?
sspl-1.0 | 7 | server side public | server side public {l}(?: {v}1)?
sspl-1.0 | 5 | sspl | sspl(?: {v}1)?
sissl | 7 | sun standards | sun industry standards source {l}
spl-1.0 | 7 | sun public | sun public {l}(?: {v}1 0)?
watcom-1.0 | 7 | watcom | sybase open watcom public {l}
rpl-1.5 | 7 | reciprocal public | reciprocal public {l}(?: {v}1 [15])?
oclc-2.0 | 7 | oclc | oclc research public {l}(?: {v}2 0)?
cecill-2.1 | 7 | cecill | cecill(?: free software)?(?: {l})?(?: agreement)? {v}2 1
cecill-b | 7 | cecill | cecill b(?: {l})?
cecill-c | 7 | cecill | cecill c(?: {l})?
cecill-unversioned | 4 | cecill | cecill {l}
licence-libre-fr | 7 | licence ouverte | licence ouverte(?: open licence)?(?: {v}\d 0)?
elastic-2.0 | 7 | elastic | elastic {l}(?: {v}2(?: 0)?)?
busl-1.1 | 7 | business source | business source {l}(?: {v}1 1)?
commons-clause | 7 | commons clause | commons clause {l}(?: condition)?(?: {v}1 0)?
polyform-noncommercial | 7 | polyform | polyform noncommercial {l}(?: 1 0 0)?
polyform-small-business | 7 | polyform | polyform small business {l}(?: 1 0 0)?
parity-7.0 | 7 | parity public | parity public {l}(?: 7 0 0)?
confluent-1.0 | 7 | confluent community | confluent community {l}(?: agreement)?
timescale | 7 | timescale | timescale {l}(?: agreement)?
redis-rsal | 7 | redis source available | redis source available {l}(?: agreement)?
openrail | 7 | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: {l})?
rail-bigscience | 7 | rail bigscience | bigscience rail {l}(?: v1 0)?
llama-community | 7 | llama community | llama(?: \d)?(?: \d)? community {l}(?: agreement)?
# content, data and fonts
cc-by-1.0 | 7 | cc by | cc by 1 0
cc-by-2.0 | 7 | cc by | cc by 2 0
cc-by-2.5 | 7 | cc by | cc by 2 5
cc-by-3.0 | 7 | cc by | cc by 3 0
cc-by-4.0 | 7 | cc by | cc by 4 0
cc-by-sa-2.0 | 7 | cc sa | cc by sa 2 0
cc-by-sa-3.0 | 7 | cc sa | cc by sa 3 0
cc-by-sa-4.0 | 7 | cc sa | cc by sa 4 0
cc-by-sa | 5 | cc sa | cc by sa
cc-by-nd-3.0 | 7 | cc nd | cc by nd 3 0
cc-by-nd-4.0 | 7 | cc nd | cc by nd 4 0
cc-by-nd | 5 | cc nd | cc by nd
cc-by-nc-3.0 | 7 | cc nc | cc by nc 3 0
cc-by-nc-4.0 | 7 | cc nc | cc by nc 4 0
cc-by-nc | 5 | cc nc | cc by nc
cc-by-nc-sa-3.0 | 8 | cc nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 8 | cc nc sa | cc by nc sa 4 0
cc-by-nc-sa | 6 | cc nc sa | cc by nc sa
cc-by-nc-nd-3.0 | 8 | cc nc nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 8 | cc nc nd | cc by nc nd 4 0
cc-by-nc-nd | 6 | cc nc nd | cc by nc nd
cc-by-4.0 | 7 | creative commons attribution | creative commons attribution 4 0(?: international)?(?: {l})?
cc-by-3.0 | 7 | creative commons attribution | creative commons attribution 3 0(?: unported)?(?: {l})?
cc-by-sa-4.0 | 8 | creative commons attribution sharealike | creative commons attribution sharealike 4 0(?: international)?(?: {l})?
cc-by-sa-3.0 | 8 | creative commons attribution sharealike | creative commons attribution sharealike 3 0(?: unported)?(?: {l})?
cc-by-sa | 6 | creative commons alike | creative commons attribution share alike(?: {l})?
cc-by-nc | 6 | creative commons noncommercial | creative commons attribution noncommercial(?: \d 0)?(?: international| unported)?(?: {l})?
cc-by-nc-sa | 8 | creative commons noncommercial sharealike | creative commons attribution noncommercial sharealike(?: \d 0)?(?: international| unported)?(?: {l})?
cc-by-nc-nd | 8 | creative commons noncommercial | creative commons attribution noncommercial no ?derivatives(?: \d 0)?(?: international| unported)?(?: {l})?
cc-by-nd | 7 | creative commons attribution | creative commons attribution no ?derivatives(?: \d 0)?(?: international| unported)?(?: {l})?
cc-unversioned | 4 | creative commons | creative commons(?: attribution)? {l}
cc-by-url | 8 | creativecommons | creativecommons org {l} by(?: \d \d)?
cc-by-sa-url | 9 | creativecommons sa | creativecommons org {l} by sa(?: \d \d)?
cc-by-nc-url | 9 | creativecommons nc | creativecommons org {l} by nc(?: sa| nd)?(?: \d \d)?
cc0-1.0 | 7 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 8 | creativecommons zero | creativecommons org publicdomain zero(?: 1 0)?
cc0-1.0 | 7 | creative commons zero | creative commons zero(?: v1 0| 1 0)?(?: universal)?
cc-public-domain-mark | 8 | creativecommons mark | creativecommons org publicdomain mark(?: 1 0)?
pddl-1.0 | 7 | domain dedication | (?:open data commons )?public domain dedication(?: and)?(?: {l})?
odbl-1.0 | 7 | odbl | odbl(?: 1 0)?
odbl-1.0 | 7 | open database | open database {l}(?: odbl)?
odc-by-1.0 | 7 | odc by | odc by(?: 1 0)?
odc-by-1.0 | 7 | open data commons | open data commons attribution {l}(?: v1 0)?
cdla-permissive-2.0 | 7 | community data agreement permissive | community data {l} agreement permissive(?: {v}2 0)?
cdla-sharing-1.0 | 7 | community data agreement sharing | community data {l} agreement sharing(?: {v}1 0)?
ogl-uk-3.0 | 7 | open government | open government {l} v3(?: 0)?
ogl-unversioned | 4 | open government | open government {l}
nlod | 7 | nlod | (?:norwegian {l} for open government data )?nlod(?: \d 0)?
ofl-1.1 | 7 | sil font | sil open font {l}(?: {v}1 1)?
ofl-1.1 | 5 | ofl | ofl {v}1 1
ubuntu-font-1.0 | 7 | ubuntu font | ubuntu font {l}(?: {v}1 0)?
bitstream-vera | 7 | bitstream vera | bitstream vera (?:fonts? )?(?:{l}|copyright)
free-art-1.3 | 7 | free art | free art {l}(?: {v}1 [23])?
opl-1.0 | 7 | open publication | open publication {l}(?: {v}1 0)?
ogc | 7 | open game | open game {l}(?: {v}1 0a?)?
gutenberg | 8 | gutenberg project | (?:full )?project gutenberg (?:tm )?{l}
wikimedia-terms | 7 | wikimedia foundation terms | wikimedia foundation terms of use
public-domain | 4 | public domain | (?:is |are |was |dedicated to |placed in |released into |in )?the public domain
public-domain | 7 | dedicated public domain | (?:has |have )?(?:been )?dedicated to the public domain
# proprietary and unknown
proprietary | 7 | proprietary confidential | proprietary and confidential
proprietary | 7 | unauthorized copying prohibited | unauthorized copying of this file via any medium is strictly prohibited
proprietary | 4 | end user agreement | end user {l} agreement(?: eula)?
proprietary | 4 | commercial | commercial {l} agreement
evaluation-only | 4 | evaluation | for evaluation (?:purposes )?only
non-commercial | 4 | non commercial | for non commercial (?:use|purposes|research)(?: only)?
non-commercial | 4 | noncommercial | for noncommercial (?:use|purposes|research)(?: only)?
research-only | 4 | research only | for research (?:use|purposes) only
oracle-bcl | 7 | oracle binary | oracle binary code {l}(?: agreement)?
oracle-otn | 7 | oracle technology network | oracle technology network {l}(?: agreement)?
nvidia-eula | 7 | nvidia | nvidia (?:software |cuda )?{l} agreement
microsoft-terms | 7 | microsoft terms | microsoft software {l} terms
apple-sla | 7 | apple | apple(?: inc)? software {l} agreement
spdx-tag | 2 | spdx identifier | spdx {l} identifier {w:4}
dual-licensed | 4 | dual | dual licen[cs]ed under {w:6}
rights-reserved | 2 | rights reserved | all rights reserved
notice | 2 | licensed | licensed under (?:the )?{w:5}{l}
notice | 2 | terms conditions | subject to the terms and conditions of (?:the |this )?{w:4}{l}
notice | 2 | released | released under (?:the |an? )?{w:4}{l}
notice | 2 | governed | governed by (?:the |an? )?{w:4}{l}
see-license-file | 2 | see for | see (?:the )?(?:file )?{l}(?: file)?(?: txt| md)? for (?:details|more|the)
"""


class Rule(NamedTuple):
    label: str
    priority: int
    words: frozenset[bytes]
    pattern: str


def expanded(pattern: str) -> str:
    for name, text in MACROS.items():
        pattern = pattern.replace(name, text)
    return re.sub(r"\{w:(\d+)\} ?", lambda m: rf"(?:[^ ]+ ){{1,{m[1]}}}?" if pattern[m.end() :].strip() else rf"[^ ]+(?: [^ ]+){{0,{int(m[1]) - 1}}}", pattern)


def rules_of(table: str = TABLE) -> list[Rule]:
    """The rules of a table, in its order; lines that are empty or begin with # are left out."""
    rows = [[x.strip() for x in line.split(" | ")] for line in table.splitlines() if line.strip() and not line.startswith("#")]
    return [Rule(label, int(priority), frozenset(words.encode().split()), expanded(pattern)) for label, priority, words, pattern in rows]
