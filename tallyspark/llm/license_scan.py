"""License scan: ordered signature rules over the words of a text.

A text becomes its lower-cased words, one blank apart, so that punctuation, comment signs and line breaks don't matter. One
automaton finds all keywords in one pass; a rule's pattern runs only where its keyword occurs. Rules stand in an order of
priority: a license tag, a name with its version, an address, a notice's own words, a plain name, general remarks. A
detection whose words lie within those of a detection of a higher priority, or of the same one and longer, is suppressed.

Base phrases are counted at all their places, and their labels stay whatever is suppressed.

Defined cases: a null text is an empty one: no words, no labels, score 0. Rows that repeat are scanned each. An empty table
gives an empty result. Very long texts are brought to words in pieces of about PIECE bytes; patterns see the whole text.
Of columns only the text is read; where a name clashes, the operator's column replaces the caller's.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tallyspark.llm.common import bounded_batches, need, plain, table

PIECE = 4_000_000
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
LIC = "licen[cs]e"

#: (label, words of its tag, keyword, pattern of its name with a version).
NAMES = [
    ("gpl-1.0", "gpl 1 0", "general public", f"(?:gnu )?general public {LIC}(?: gpl)? (?:v|version ?)?1(?: 0)?(?: or (?:at your option )?(?:any )?later(?: version)?)?"),
    ("gpl-2.0", "gpl 2 0", "general public", f"(?:gnu )?general public {LIC}(?: gpl)?(?: as published by the free software foundation)?(?: either)? (?:v|version ?)?2(?: 0)?(?: or (?:at your option )?(?:any )?later(?: version)?)?"),
    ("gpl-3.0", "gpl 3 0", "general public", f"(?:gnu )?general public {LIC}(?: gpl)?(?: as published by the free software foundation)?(?: either)? (?:v|version ?)?3(?: 0)?(?: or (?:at your option )?(?:any )?later(?: version)?)?"),
    ("lgpl-2.0", "lgpl 2 0", "general public", f"(?:gnu )?library general public {LIC}(?: (?:v|version ?)?2(?: 0)?)?(?: or (?:any )?later(?: version)?)?"),
    ("lgpl-2.1", "lgpl 2 1", "general public", f"(?:gnu )?lesser general public {LIC}(?: as published by the free software foundation)?(?: either)? (?:v|version ?)?2 1(?: or (?:any )?later(?: version)?)?"),
    ("lgpl-3.0", "lgpl 3 0", "general public", f"(?:gnu )?lesser general public {LIC}(?: as published by the free software foundation)?(?: either)? (?:v|version ?)?3(?: 0)?(?: or (?:any )?later(?: version)?)?"),
    ("agpl-3.0", "agpl 3 0", "general public", f"(?:gnu )?affero general public {LIC}(?: as published by the free software foundation)?(?: either)?(?: (?:v|version ?)?3(?: 0)?)?(?: or (?:any )?later(?: version)?)?"),
    ("agpl-1.0", "agpl 1 0", "general public", f"affero general public {LIC} (?:v|version ?)?1(?: 0)?"),
    ("gfdl-1.1", "gfdl 1 1", "free documentation", f"(?:gnu )?free documentation {LIC} (?:v|version ?)?1 1(?: or (?:any )?later(?: version)?)?"),
    ("gfdl-1.2", "gfdl 1 2", "free documentation", f"(?:gnu )?free documentation {LIC} (?:v|version ?)?1 2(?: or (?:any )?later(?: version)?)?"),
    ("gfdl-1.3", "gfdl 1 3", "free documentation", f"(?:gnu )?free documentation {LIC} (?:v|version ?)?1 3(?: or (?:any )?later(?: version)?)?"),
    ("apache-1.0", "apache 1 0", " apache ", f"apache(?: software)? {LIC} (?:v|version ?)?1 0"),
    ("apache-1.1", "apache 1 1", " apache ", f"apache(?: software)? {LIC} (?:v|version ?)?1 1"),
    ("apache-2.0", "apache 2 0", " apache ", f"apache(?: software)? {LIC} (?:v|version ?)?2(?: 0)?(?: the {LIC})?"),
    ("mit", "mit", " mit ", f"(?:the )?mit {LIC}(?: mit)?(?: terms)?"),
    ("mit-0", "mit 0", " mit ", f"mit no attribution(?: {LIC})?"),
    ("x11", "x11", " x11", f"(?:mit )?x11(?: style)? {LIC}"),
    ("isc", "isc", " isc ", f"isc {LIC}"),
    ("bsd-2-clause", "bsd 2 clause", "bsd", f"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd|two clause bsd)(?: {LIC})?"),
    ("bsd-3-clause", "bsd 3 clause", " bsd ", f"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd|three clause bsd)(?: {LIC})?"),
    ("bsd-4-clause", "bsd 4 clause", " bsd ", f"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd|four clause bsd)(?: {LIC})?"),
    ("0bsd", "0bsd", "bsd", f"(?:0bsd|zero clause bsd|bsd 0 clause|bsd zero clause)(?: {LIC})?"),
    ("bsd-3-clause-clear", "bsd 3 clause clear", " bsd ", f"(?:clear bsd|bsd 3 clause clear)(?: {LIC})?"),
    ("mpl-1.0", "mpl 1 0", "mozilla", f"mozilla public {LIC}(?: mpl)? (?:v|version ?)?1 0"),
    ("mpl-1.1", "mpl 1 1", "mozilla", f"mozilla public {LIC}(?: mpl)? (?:v|version ?)?1 1"),
    ("mpl-2.0", "mpl 2 0", "mozilla", f"mozilla public {LIC}(?: mpl)? (?:v|version ?)?2(?: 0)?"),
    ("epl-1.0", "epl 1 0", "eclipse", f"eclipse public {LIC}(?: epl)? (?:v|version ?)?1(?: 0)?"),
    ("epl-2.0", "epl 2 0", "eclipse", f"eclipse public {LIC}(?: epl)? (?:v|version ?)?2(?: 0)?"),
    ("edl-1.0", "edl 1 0", "eclipse", f"eclipse distribution {LIC}(?: (?:v|version ?)?1(?: 0)?)?"),
    ("cpl-1.0", "cpl 1 0", "common public", f"common public {LIC}(?: (?:v|version ?)?1(?: 0)?)?"),
    ("ipl-1.0", "ipl 1 0", "ibm public", f"ibm public {LIC}(?: (?:v|version ?)?1(?: 0)?)?"),
    ("cddl-1.0", "cddl 1 0", "common development", f"common development and distribution {LIC}(?: cddl)? (?:v|version ?)?1 0"),
    ("cddl-1.1", "cddl 1 1", "common development", f"common development and distribution {LIC}(?: cddl)? (?:v|version ?)?1 1"),
    ("eupl-1.1", "eupl 1 1", "european union public", f"european union public {LIC}(?: eupl)? (?:v|version ?)?1 1"),
    ("eupl-1.2", "eupl 1 2", "european union public", f"european union public {LIC}(?: eupl)? (?:v|version ?)?1 2"),
    ("artistic-1.0", "artistic 1 0", "artistic", f"artistic {LIC} (?:v|version ?)?1(?: 0)?"),
    ("artistic-2.0", "artistic 2 0", "artistic", f"artistic {LIC} (?:v|version ?)?2(?: 0)?"),
    ("clartistic", "clartistic", "artistic", f"clarified artistic {LIC}"),
    ("bsl-1.0", "bsl 1 0", "boost", f"boost software {LIC}(?: (?:v|version ?)?1(?: 0)?)?"),
    ("busl-1.1", "busl 1 1", "business source", f"business source {LIC}(?: (?:v|version ?)?1 1)?"),
    ("sspl-1.0", "sspl 1 0", "server side public", f"server side public {LIC}(?: (?:v|version ?)?1)?"),
    ("elastic-2.0", "elastic 2 0", "elastic", f"elastic {LIC}(?: (?:v|version ?)?2(?: 0)?)?"),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "public", f"do what the f[a-z]+ you want to public {LIC}"),
    ("zlib", "zlib", " zlib ", f"zlib(?: libpng)? {LIC}"),
    ("libpng", "libpng", "png", f"(?:libpng|png reference library) {LIC}"),
    ("openssl", "openssl", "openssl", f"openssl {LIC}"),
    ("ssleay", "ssleay", "ssleay", f"(?:original )?ssleay {LIC}"),
    ("psf-2.0", "psf 2 0", "python software", f"python software foundation {LIC}(?: (?:v|version ?)?2)?"),
    ("php-3.01", "php 3 01", " php ", f"php {LIC} (?:v|version ?)?3 0?1"),
    ("php-3.0", "php 3 0", " php ", f"php {LIC} (?:v|version ?)?3 0"),
    ("ruby", "ruby", " ruby ", f"ruby(?: s)? {LIC}"),
    ("postgresql", "postgresql", "postgresql", f"postgresql {LIC}"),
    ("ncsa", "ncsa", "ncsa", f"(?:university of illinois )?ncsa open source {LIC}"),
    ("ofl-1.1", "ofl 1 1", "open font", f"(?:sil )?open font {LIC}(?: ofl)?(?: (?:v|version ?)?1 1)?"),
    ("ofl-1.0", "ofl 1 0", "open font", f"(?:sil )?open font {LIC}(?: ofl)? (?:v|version ?)?1 0"),
    ("odbl-1.0", "odbl 1 0", "open database", f"open(?: data commons open)? database {LIC}(?: odbl)?(?: (?:v|version ?)?1 0)?"),
    ("odc-by-1.0", "odc by 1 0", "open data commons", f"open data commons attribution {LIC}(?: (?:v|version ?)?1 0)?"),
    ("pddl-1.0", "pddl 1 0", "public domain dedication", f"(?:open data commons )?public domain dedication and {LIC}"),
    ("ms-pl", "ms pl", "microsoft", f"microsoft public {LIC}"),
    ("ms-rl", "ms rl", "microsoft", f"microsoft reciprocal {LIC}"),
    ("apsl-2.0", "apsl 2 0", "apple public", f"apple public source {LIC}(?: (?:v|version ?)?2(?: 0)?)?"),
    ("osl-3.0", "osl 3 0", "open software", f"open software {LIC}(?: (?:v|version ?)?3(?: 0)?)?"),
    ("afl-3.0", "afl 3 0", "academic free", f"academic free {LIC}(?: (?:v|version ?)?3(?: 0)?)?"),
    ("qpl-1.0", "qpl 1 0", "q public", f"q public {LIC}(?: (?:v|version ?)?1(?: 0)?)?"),
    ("zpl-2.1", "zpl 2 1", "zope", f"zope public {LIC}(?: (?:v|version ?)?2 1)?"),
    ("w3c", "w3c", " w3c ", f"w3c software(?: notice and)? {LIC}"),
    ("upl-1.0", "upl 1 0", "universal permissive", f"universal permissive {LIC}(?: (?:v|version ?)?1(?: 0)?)?"),
    ("vim", "vim", " vim ", f"vim {LIC}"),
    ("tcl", "tcl", " tcl ", f"tcl(?: tk)? {LIC}"),
    ("lppl-1.3c", "lppl 1 3c", "latex project", f"latex project public {LIC}(?: (?:v|version ?)?1 3c?)?"),
    ("mulanpsl-2.0", "mulanpsl 2 0", "mulan", f"mulan (?:permissive software {LIC}|psl)(?: (?:v|version ?)?2)?"),
    ("blueoak-1.0.0", "blueoak 1 0 0", "blue oak", f"blue oak model {LIC}(?: 1 0 0)?"),
    ("cecill-2.1", "cecill 2 1", "cecill", f"cecill(?: free software)?(?: {LIC})?(?: (?:agreement )?(?:v|version ?)?2 1)"),
    ("beerware", "beerware", "beer", f"(?:the )?beer ?ware {LIC}"),
    ("json", "json", " json ", f"json {LIC}"),
    ("naist-2003", "naist 2003", "naist", f"naist {LIC}"),
    ("icu", "icu", " icu ", f"icu {LIC}"),
    ("unicode-3.0", "unicode 3 0", "unicode", f"unicode {LIC}(?: (?:v|version ?)?3)?"),
    ("openrail-m", "openrail m", "rail", f"(?:creativeml |bigscience )?open ?rail m(?: {LIC})?"),
    ("llama-2", "llama 2", "llama", f"llama 2 community {LIC}(?: agreement)?"),
    ("llama-3", "llama 3", "llama", f"llama 3(?: \\d)? community {LIC}(?: agreement)?"),
]
#: Creative Commons: the signs of a deed, in words, and the long name. Each with each of VERSIONS makes a rule.
DEEDS = [
    ("cc-by", "attribution"),
    ("cc-by-sa", "attribution share ?alike"),
    ("cc-by-nd", "attribution no ?deriv(?:ative|ativ)?s?(?: works)?"),
    ("cc-by-nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(?:ative|ativ)?s?(?: works)?"),
]
VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: (label, keyword, pattern) of addresses.
ADDRESSES = [
    ("gpl-2.0", "gnu org", "gnu org (?:licenses|copyleft) (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu org", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu org", "gnu org (?:licenses|copyleft) gpl"),
    ("lgpl-2.1", "gnu org", "gnu org (?:licenses|copyleft) (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu org", "gnu org licenses lgpl 3 0"),
    ("lgpl", "gnu org", "gnu org (?:licenses|copyleft) (?:lgpl|lesser)"),
    ("agpl-3.0", "gnu org", "gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "gnu org", "gnu org (?:licenses|copyleft) fdl"),
    ("gpl-or-later", "gnu org", "see (?:the file copying or )?(?:https? )?(?:www )?gnu org licenses"),
    ("apache-2.0", "apache org", "apache org licenses license 2 0"),
    ("apache-1.1", "apache org", "apache org licenses license 1 1"),
    ("mit", "opensource org", "opensource org licen[cs]es?(?: php)? mit"),
    ("bsd-2-clause", "opensource org", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "opensource org", "opensource org licenses bsd 3 clause"),
    ("bsd", "opensource org", "opensource org licenses bsd license"),
    ("isc", "opensource org", "opensource org licenses isc"),
    ("artistic-2.0", "opensource org", "opensource org licenses artistic(?: license)? 2 0"),
    ("osl-3.0", "opensource org", "opensource org licenses osl 3 0"),
    ("mpl-2.0", "mozilla org", "mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1.1", "mozilla org", "mozilla org mpl(?: mpl)? 1 1"),
    ("epl-2.0", "eclipse org", "eclipse org legal epl(?: v)? ?2 0"),
    ("epl-1.0", "eclipse org", "eclipse org legal epl v10"),
    ("bsl-1.0", "boost org", "boost org license 1 0"),
    ("cddl-1.0", "opensolaris", "opensolaris org os licensing"),
    ("unlicense", "unlicense org", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl net"),
    ("cc0-1.0", "creativecommons org", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons org", "creativecommons org publicdomain mark 1 0"),
    ("ofl-1.1", "scripts sil org", "scripts sil org ofl"),
    ("odbl-1.0", "opendatacommons", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "opendatacommons", "opendatacommons org licenses by"),
    ("pddl-1.0", "opendatacommons", "opendatacommons org licenses pddl"),
    ("blueoak-1.0.0", "blueoak", "blueoakcouncil org license 1 0 0"),
    ("postgresql", "postgresql org", "postgresql org about licence"),
    ("php-3.01", "php net", "php net license 3 01"),
    ("cecill-2.1", "cecill", "cecill info licences"),
]
#: (label, keyword, pattern) of words that stand in a license itself.
NOTICES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("x11", "x consortium", "the name of the x consortium shall not be used in advertising"),
    ("json", "used for good", "the software shall be used for good not evil"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice)?"),
    ("0bsd", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", "neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|their|any) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-2-clause", "redistributions of source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form"),
    ("apache-2.0", "you may not use this file", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "derivative works", "reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work"),
    ("apache-1.1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl", "free software you can", "is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "free software you can", "is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    ("agpl-3.0", "free software you can", "is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("gpl", "copy of the gnu general", "you should have received a copy of the gnu general public licen[cs]e"),
    ("lgpl", "copy of the gnu lesser", "you should have received a copy of the gnu lesser general public licen[cs]e"),
    ("gpl", "freedom to share", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("agpl-3.0", "remote network interaction", "remote network interaction use with the gnu general public licen[cs]e"),
    ("gfdl", "invariant sections", "with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0"),
    ("mpl-1.1", "contents of this file", "the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("cddl-1.0", "contents of this file", "the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("epl-1.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0"),
    ("epl-2.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2 0"),
    ("bsl-1.0", "boost software", "distributed under the boost software licen[cs]e version 1 0"),
    ("zlib", "as is without any express", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "origin of this software", "the origin of this software must not be misrepresented"),
    ("unlicense", "free and unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just do what", "you just do what the f[a-z]+ you want to"),
    ("beerware", "buy me a beer", "you can buy me a beer in return"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project"),
    ("ssleay", "cryptographic software", "this product includes cryptographic software written by eric young"),
    ("ncsa", "deal with the software", "to deal with the software without restriction including without limitation"),
    ("psf-2.0", "psf is making python", "psf is making python available to licensee on an as is basis"),
    ("ruby", "copyrighted free software", "ruby is copyrighted free software"),
    ("postgresql", "without a written agreement", "without fee and without a written agreement is hereby granted"),
    ("artistic-1.0", "standard version", "you may make and give away verbatim copies of the source form of the standard version of this package"),
    ("ofl-1.1", "font software", "this font software is licensed under the sil open font licen[cs]e"),
    ("ms-pl", "license governs use", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("busl-1.1", "change date", "on the change date or the fourth anniversary of the first publicly available distribution"),
    ("elastic-2.0", "hosted or managed", "you may not provide the software to third parties as a hosted or managed service"),
    ("sspl-1.0", "service source code", "make the service source code available via network download to everyone at no charge"),
    ("commons-clause", "commons clause", "(?:the )?commons clause(?: license condition)?"),
    ("cc0-1.0", "affirmer", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("unicode-3.0", "unicode data files", "any person obtaining a copy of the unicode data files"),
    ("openrail-m", "use based restrictions", "use based restrictions as referenced in (?:paragraph|attachment)"),
]
#: (label, keyword, pattern) of short names without a version.
SHORT = [
    ("gpl", "general public", f"(?:gnu )?general public {LIC}"),
    ("lgpl", "general public", f"(?:gnu )?(?:lesser|library) general public {LIC}"),
    ("gpl", " gpl", "(?:gnu )?gpl"),
    ("gpl-2.0", " gpl", "gpl ?v ?2(?: 0)?(?: only| or later)?|gpl 2 0(?: only| or later)?|gpl version 2"),
    ("gpl-3.0", " gpl", "gpl ?v ?3(?: 0)?(?: only| or later)?|gpl 3 0(?: only| or later)?|gpl version 3"),
    ("lgpl", " lgpl", "(?:gnu )?lgpl"),
    ("lgpl-2.1", " lgpl", "lgpl ?v? ?2 1(?: only| or later)?"),
    ("lgpl-3.0", " lgpl", "lgpl ?v? ?3(?: 0)?(?: only| or later)?"),
    ("agpl-3.0", " agpl", "(?:gnu )?agpl(?: ?v? ?3(?: 0)?)?(?: only| or later)?"),
    ("gfdl", "free documentation", f"(?:gnu )?free documentation {LIC}"),
    ("apache", " apache ", f"apache(?: software)? {LIC}"),
    ("apache-2.0", " apache", "(?:under|using|with) apache(?: v)? ?2(?: 0)?"),
    ("asl-2.0", " asl ", "asl 2 0"),
    ("bsd", " bsd ", f"bsd(?: style| type)? {LIC}"),
    ("mit", " mit ", f"(?:mit style|mit type|mit expat|mit x11) {LIC}"),
    ("mit", "expat", f"expat {LIC}"),
    ("mpl", "mozilla", f"mozilla public {LIC}"),
    ("mpl-2.0", " mpl", "mpl ?v? ?2 0"),
    ("epl", "eclipse", f"eclipse public {LIC}"),
    ("cddl", "common development", f"common development and distribution {LIC}"),
    ("eupl", "european union public", f"european union public {LIC}"),
    ("artistic", "artistic", f"artistic {LIC}"),
    ("php", " php ", f"php {LIC}"),
    ("cc0-1.0", " cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", " cc zero", "cc zero(?: 1 0)?"),
    ("creative-commons", "creative commons", f"creative commons(?: public)? {LIC}"),
    ("wtfpl", " wtfpl ", "wtfpl"),
]
#: (label, keyword, pattern) of remarks that name no license.
GENERAL = [
    ("public-domain", "public domain", "(?:released|placed|dedicated|is) (?:in|in to|into|to) the public domain"),
    ("public-domain", "public domain", "no known copyright restrictions public domain"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary and confidential"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this (?:file|software|document|work)"),
    ("proprietary", "without the prior written", "may not be (?:reproduced|copied|distributed)[^.]{0,60} without the prior written (?:permission|consent)"),
    ("unknown", f"licen", f"(?:licensed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?(?:following )?{LIC}"),
    ("unknown", "end user", f"end user {LIC} agreement"),
    ("unknown", "licen", f"see (?:the )?(?:file )?{LIC}(?: file| txt| md)?(?: for (?:details|terms|more information))"),
    ("royalty-free", "royalty free", f"(?:perpetual |worldwide |world wide |non exclusive |no charge ){{1,4}}royalty free (?:irrevocable )?(?:copyright |patent )?{LIC}"),
]
#: How sure a detection is, by its kind, in the order of priority.
KINDS = {"tag": 1.0, "name": 0.95, "address": 0.9, "notice": 0.85, "short": 0.6, "general": 0.3}


class Rule(NamedTuple):
    priority: int
    kind: str
    label: str
    keyword: bytes
    pattern: re.Pattern


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in their order."""
    tag = "spdx license identifier "
    after = "(?: only| or later)?"
    rows = [("tag", label, tag + words.split()[0], f"{tag}{words}{after}") for label, words, _, _ in NAMES]
    rows += [("tag", "cc0-1.0", tag, f"{tag}cc0 1 0")]
    deeds = [(d, d.replace("-", " "), name, v, v.replace(".", " ")) for d, name in DEEDS for v in VERSIONS]
    rows += [("tag", f"{d}-{v}", tag + "cc", f"{tag}{words} {n}") for d, words, _, v, n in deeds]
    rows += [("name", label, key, name) for label, _, key, name in NAMES]
    rows += [("name", f"{d}-{v}", " cc by ", f"{words} (?:v|version ?)?{n}(?: international| unported| generic)?") for d, words, _, v, n in deeds]
    rows += [("name", f"{d}-{v}", "creative commons", f"creative commons {name} (?:v|version ?)?{n}(?: international| unported| generic)?(?: {LIC})?") for d, _, name, v, n in deeds]
    rows += [("address", f"{d}-{v}", "creativecommons org", f"creativecommons org licenses {words[3:]} {n}") for d, words, _, v, n in deeds]
    rows += [("address", *x) for x in ADDRESSES] + [("notice", *x) for x in NOTICES]
    rows += [("short", d, " cc by ", words) for d, words in ((d, d.replace("-", " ")) for d, _ in DEEDS)]
    rows += [("short", d, "creative commons", f"creative commons {name}(?: {LIC})?") for d, name in DEEDS]
    rows += [("short", *x) for x in SHORT] + [("general", *x) for x in GENERAL]
    kinds = list(KINDS)
    return tuple(Rule(kinds.index(k), k, label, key.encode(), re.compile(f"(?<= )(?:{p})(?= )".encode())) for k, label, key, p in rows)


@cache
def _keywords() -> ahocorasick.Automaton:
    """Of each keyword the numbers of its rules; base phrases have negative ones."""
    by: dict[str, list[int]] = {}
    for k, r in enumerate(rules()):
        by.setdefault(r.keyword.decode(), []).append(k)
    for k, phrase in enumerate(BASE):
        by.setdefault(f" {phrase} ", []).append(-1 - k)
    out = ahocorasick.Automaton()
    for key, own in by.items():
        out.add_word(key, own)
    out.make_automaton()
    return out


#: Bytes of UTF-8: A-Z lowered, all ASCII signs but letters and digits as blanks.
TO_WORDS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def as_words(text: str) -> bytes:
    """A text's words in UTF-8, A-Z lowered, a blank before and after each."""
    signs = text.encode().translate(TO_WORDS)
    parts, at = [], 0
    while at < len(signs):
        end = signs.find(b" ", at + PIECE)
        end = len(signs) if end < 0 else end
        if own := signs[at:end].split():
            parts.append(b" ".join(own))
        at = end
    return b" " + b" ".join(parts) + b" " if parts else b" "


class Detection(NamedTuple):
    label: str
    kind: str
    start: int
    end: int
    confidence: float


def unsuppressed(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, rule) without those within another one of a higher priority, or of the same and longer, or equal and
    of an earlier rule."""
    order = rules()
    found = sorted(set(found), key=lambda x: (x[0], -x[1], order[x[2]].priority, x[2]))
    reach, kept = [-1] * len(KINDS), []
    for start, end, rule in found:
        p = order[rule].priority
        # All before in this order begin no later; those that reach as far contain this one.
        if max(reach[: p + 1]) < end:
            kept.append((start, end, rule))
        reach[p] = max(reach[p], end)
    return kept


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of a text."""
    words = as_words(text or "")
    n = words.count(b" ") - 1
    if n <= 0:
        return 0, 0, None, None, "", "", 0.0, []
    hit: set[int] = set()
    for _, own in _keywords().iter(words.decode("latin-1")):
        hit.update(own)
    if not hit:
        return n, 0, None, None, "", "", 0.0, []
    places, labels = [], set()
    for k, (phrase, label) in enumerate(BASE.items()):
        if -1 - k in hit:
            at = words.find(b" %s " % phrase.encode())
            while at >= 0:
                places.append(at + 1)
                labels.add(label)
                at = words.find(b" %s " % phrase.encode(), at + 1)
    order = rules()
    found = [(*m.span(), k) for k in sorted(x for x in hit if x >= 0) for m in order[k].pattern.finditer(words)]
    kept, at, before = [], 0, -1
    for start, end, k in unsuppressed(found):
        before += words.count(b" ", at, start)
        at = start
        r = order[k]
        kept.append(Detection(r.label, r.kind, before, before + words.count(b" ", start, end) + 1, KINDS[r.kind]))
    base = sorted(labels)
    named = sorted(labels | {x.label for x in kept})
    word = [words.count(b" ", 0, p) - 1 for p in ((min(places), max(places)) if places else ())]
    score = max([x.confidence for x in kept] + [KINDS["short"]] * bool(base), default=0.0)
    return n, len(places), *(word or (None, None)), ",".join(base), ",".join(named), score, kept


DETECTION = pa.struct([("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])
FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("detections", pa.list_(DETECTION))]

_SPARK = {pa.int64(): LongType(), pa.float64(): DoubleType(), pa.string(): StringType()}
TYPE = StructType([StructField(n, _SPARK[t]) for n, t in FIELDS[:-1]] + [StructField("detections", ArrayType(StructType([StructField(f.name, _SPARK[f.type]) for f in DETECTION])))])


@arrow_udf(TYPE)
def _scan_udf(texts: pa.Array) -> pa.Array:
    columns = list(zip(*(scan(t.as_py()) for t in texts), strict=True)) or [()] * len(FIELDS)
    columns[-1] = [[x._asdict() for x in own] for own in columns[-1]]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)], [name for name, _ in FIELDS])


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with counts of words and base phrases, labels, score, and detections: label, kind, the words from start to before end."""
    need(docs, text_col)
    names = [name for name, _ in FIELDS]
    if text_col in names:
        raise ValueError(f"the text column can't be named {text_col}")
    docs = plain(docs, *names)
    bounded_batches(docs.sparkSession)
    return docs.withColumn("__scan", _scan_udf(F.col(text_col).cast("string"))).select(*docs.columns, *[F.col(f"__scan.{n}").alias(n) for n in names])


def op11_license_scan(spark, sf_dir):
    """Every document's license labels."""
    out = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.drop("text", "detections").select("doc_id", *[n for n, _ in FIELDS[:-1]])


QUERIES = {"op11_license_scan": op11_license_scan}
ORACLES = {}
