"""The signature rules of the license scan, in order.

A rule is written over a text's words: lower case, joined by single blanks, so that ``2.0`` reads
``2 0``. Where rules match overlapping words, the order of the classes decides first.
"""

from __future__ import annotations

from typing import NamedTuple

IDENTIFIER, NOTICE, TITLE, MENTION = 0, 1, 2, 3
#: How sure a detection of each class is.
WEIGHT = (1.0, 0.9, 0.7, 0.4)


class Rule(NamedTuple):
    keyword: str
    rank: int
    label: str
    pattern: str


V = "(?:version |v )?"
GNU = "(?:gnu )?"

#: label, keyword, name, identifier, address; patterns over words. No address where there is none.
LICENSES = [
    ("0bsd", "bsd", "(?:zero clause bsd|bsd zero clause|0bsd)(?: license)?", "0bsd", "opensource org licen[cs]es 0bsd"),
    ("afl-3.0", "academic", f"academic free license(?: {V}3 0)?", "afl 3 0", "opensource org licen[cs]es afl 3 0"),
    ("agpl-3.0", "affero", f"{GNU}affero general public licen[cs]e(?: {V}3(?: 0)?)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl(?: 3 0)?"),
    ("apache-1.1", "apache", f"apache (?:software )?licen[cs]e {V}1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache", f"apache (?:software )?licen[cs]e(?: {V}2(?: 0)?)?", "apache 2 0", "apache org licenses license 2 0"),
    ("artistic-1.0", "artistic", f"artistic licen[cs]e {V}1 0", "artistic 1 0", "opensource org licen[cs]es artistic license 1 0"),
    ("artistic-2.0", "artistic", f"artistic licen[cs]e(?: {V}2 0)?", "artistic 2 0", "opensource org licen[cs]es artistic license 2 0"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?", "bsd 2 clause", "opensource org licen[cs]es bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?", "bsd 3 clause", "opensource org licen[cs]es bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[cs]e)?", "bsd 4 clause", ""),
    ("bsl-1.0", "boost", f"boost software licen[cs]e(?: {V}1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("busl-1.1", "business", f"business source licen[cs]e(?: {V}1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("cc0-1.0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-2.0", " cc by ", f"cc by (?:licen[cs]e )?{V}2 0", "cc by 2 0", "creativecommons org licenses by 2 0"),
    ("cc-by-2.5", " cc by ", f"cc by (?:licen[cs]e )?{V}2 5", "cc by 2 5", "creativecommons org licenses by 2 5"),
    ("cc-by-3.0", " cc by ", f"cc by (?:licen[cs]e )?{V}3 0", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-4.0", " cc by ", f"cc by (?:licen[cs]e )?{V}4 0", "cc by 4 0", "creativecommons org licenses by 4 0"),
    ("cc-by-nc-2.0", " cc by ", "cc by nc 2 0", "cc by nc 2 0", "creativecommons org licenses by nc 2 0"),
    ("cc-by-nc-3.0", " cc by ", "cc by nc 3 0", "cc by nc 3 0", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nc-4.0", " cc by ", "cc by nc(?: 4 0)?", "cc by nc 4 0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-nd-4.0", " cc by ", "cc by nc nd(?: 4 0)?", "cc by nc nd 4 0", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-nc-sa-4.0", " cc by ", "cc by nc sa(?: 4 0)?", "cc by nc sa 4 0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nd-4.0", " cc by ", "cc by nd(?: 4 0)?", "cc by nd 4 0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-sa-3.0", " cc by ", "cc by sa 3 0", "cc by sa 3 0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-sa-4.0", " cc by ", "cc by sa(?: 4 0)?", "cc by sa 4 0", "creativecommons org licenses by sa 4 0"),
    ("cddl-1.0", "distribution", f"common development and distribution licen[cs]e(?: {V}1 0)?", "cddl 1 0", "opensource org licen[cs]es cddl 1 0"),
    ("cecill-2.1", "cecill", f"cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?(?: {V}2 1)?", "cecill 2 1", "cecill info licen[cs]es"),
    ("cpl-1.0", "common", f"common public licen[cs]e(?: {V}1 0)?", "cpl 1 0", "opensource org licen[cs]es cpl 1 0"),
    ("ecl-2.0", "educational", f"educational community licen[cs]e(?: {V}2 0)?", "ecl 2 0", "opensource org licen[cs]es ecl 2 0"),
    ("epl-1.0", "eclipse", f"eclipse public licen[cs]e {V}1 0", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", f"eclipse public licen[cs]e(?: {V}2 0)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("eupl-1.2", "european", f"european union public licen[cs]e(?: {V}1 2)?", "eupl 1 2", "joinup ec europa eu software page eupl"),
    ("gfdl-1.3", "documentation", f"{GNU}free documentation licen[cs]e(?: {V}1 3)?", "gfdl 1 3", "gnu org licenses fdl 1 3"),
    ("gpl-1.0", "public", f"{GNU}general public licen[cs]e {V}1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu org licenses gpl 1 0"),
    ("gpl-2.0", "public", f"{GNU}general public licen[cs]e {V}2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses gpl 2 0"),
    ("gpl-3.0", "public", f"{GNU}general public licen[cs]e {V}3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("hpnd", "historical", "historical permission notice and disclaimer", "hpnd", "opensource org licen[cs]es hpnd"),
    ("isc", "isc", "(?:the )?isc licen[cs]e", "isc", "opensource org licen[cs]es isc"),
    ("lgpl-2.0", "library", f"{GNU}library general public licen[cs]e(?: {V}2(?: 0)?)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "lesser", f"{GNU}lesser general public licen[cs]e {V}2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses lgpl 2 1"),
    ("lgpl-3.0", "lesser", f"{GNU}lesser general public licen[cs]e(?: {V}3(?: 0)?)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lppl-1.3c", "latex", f"latex project public licen[cs]e(?: {V}1 3c?)?", "lppl 1 3c", "latex project org lppl"),
    ("mit", " mit ", "(?:the )?mit(?: x11| expat)? licen[cs]e", "mit", "opensource org licen[cs]es mit"),
    ("mit-0", " mit ", "mit no attribution(?: licen[cs]e)?", "mit 0", "opensource org licen[cs]es mit 0"),
    ("mpl-1.1", "mozilla", f"mozilla public licen[cs]e {V}1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla", f"mozilla public licen[cs]e(?: {V}2(?: 0)?)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", "ms pl", "opensource org licen[cs]es ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", "ms rl", "opensource org licen[cs]es ms rl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source licen[cs]e", "ncsa", "opensource org licen[cs]es ncsa"),
    ("odbl-1.0", "database", f"open (?:data commons open )?database licen[cs]e(?: {V}1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "open data", f"open data commons attribution licen[cs]e(?: {V}1 0)?", "odc by 1 0", "opendatacommons org licenses by"),
    ("ofl-1.1", "font", f"(?:sil )?open font licen[cs]e(?: {V}1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("openssl", "openssl", "openssl licen[cs]e", "openssl", "openssl org source license"),
    ("osl-3.0", "open software", f"open software licen[cs]e(?: {V}3 0)?", "osl 3 0", "opensource org licen[cs]es osl 3 0"),
    ("pddl-1.0", "dedication", f"public domain dedication and licen[cs]e(?: {V}1 0)?", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("php-3.01", "php", f"php licen[cs]e(?: {V}3 0?1)?", "php 3 01", "php net license 3 01"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql", "postgresql org about licence"),
    ("psf-2.0", "python", f"python software foundation licen[cs]e(?: {V}2)?", "python 2 0", "docs python org 3 license"),
    ("qpl-1.0", " q public ", f"q public licen[cs]e(?: {V}1 0)?", "qpl 1 0", "opensource org licen[cs]es qpl 1 0"),
    ("ruby", "ruby", "ruby licen[cs]e", "ruby", "ruby lang org en about license"),
    ("sspl-1.0", "side", f"server side public licen[cs]e(?: {V}1)?", "sspl 1 0", "mongodb com licensing server side public license"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense org"),
    ("upl-1.0", "universal", f"universal permissive licen[cs]e(?: {V}1 0)?", "upl 1 0", "oss oracle com licenses upl"),
    ("w3c", "w3c", "w3c software(?: notice)? and(?: document)? licen[cs]e", "w3c", "w3 org consortium legal 2015"),
    ("wtfpl", "wtfpl", "wtfpl(?: licen[cs]e)?", "wtfpl", "wtfpl net"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", "zlib", "opensource org licen[cs]es zlib"),
    ("zpl-2.1", "zope", f"zope public licen[cs]e(?: {V}2 1)?", "zpl 2 1", "opensource org licen[cs]es zpl 2 0"),
]

GRANTED = (
    "(?:released|licen[cs]ed|distributed|published|provided|offered|available|shared|covered|redistributed)"
    "(?: to you)? (?:under|by|subject to|in accordance with)(?: the)?(?: terms of)?(?: the| an?)?"
)

#: Rules without a license of the list above: keyword, class, label, pattern.
OTHERS = [
    ("reserved", NOTICE, "reserved", "(?:copyright|c)(?: c)? (?:\\d{4} )(?:\\S+ ){0,6}all rights reserved"),
    ("reserved", TITLE, "reserved", "all (?:other )?rights(?: are)? reserved"),
    ("reserved", TITLE, "some-rights", "some rights reserved"),
    ("copyright", MENTION, "copyright", "copyright (?:c )?\\d{4}(?: \\d{4})?"),
    ("prohibited", TITLE, "reserved", "unauthori[sz]ed (?:copying|reproduction|use)(?: of \\S+(?: \\S+)?)? is (?:strictly )?prohibited"),
    ("public", TITLE, "public-domain", "(?:dedicated|released|placed) (?:to|into|in) the public domain"),
    ("public", TITLE, "public-domain", "this work is in the public domain"),
    ("public", MENTION, "public-domain", "public domain"),
    ("gpl", TITLE, "gpl", "(?:gnu )?gpl(?: ?v ?| version )?[123](?: 0)?(?: or (?:later|any later version))?"),
    ("gpl", MENTION, "gpl", "gnu gpl"),
    ("gplv2", TITLE, "gpl-2.0", "(?:gnu )?gplv2(?: 0)?"),
    ("gplv3", TITLE, "gpl-3.0", "(?:gnu )?gplv3(?: 0)?"),
    ("lgpl", MENTION, "lgpl", "(?:gnu )?lgpl(?:v[23])?"),
    ("agpl", MENTION, "agpl", "(?:gnu )?agpl(?:v3)?"),
    ("public", MENTION, "gpl", "general public licen[cs]e"),
    ("creative", MENTION, "creative-commons", "creative commons(?: licen[cs]e)?"),
    ("creative", NOTICE, "creative-commons", f"{GRANTED} creative commons(?: licen[cs]e)?"),
    ("attribution", TITLE, "cc-by-2.0", f"creative commons attribution (?:licen[cs]e )?{V}2 0"),
    ("attribution", TITLE, "cc-by-2.5", f"creative commons attribution (?:licen[cs]e )?{V}2 5"),
    ("attribution", TITLE, "cc-by-3.0", f"creative commons attribution (?:licen[cs]e )?{V}3 0"),
    ("attribution", TITLE, "cc-by-4.0", f"creative commons attribution (?:licen[cs]e )?{V}4 0"),
    ("sharealike", TITLE, "cc-by-sa", "creative commons attribution sharealike"),
    ("noncommercial", TITLE, "cc-by-nc", "creative commons attribution noncommercial"),
    ("noderiv", TITLE, "cc-by-nd", "creative commons attribution noderiv(?:ative)?s"),
    ("noncommercial", MENTION, "non-commercial", "for noncommercial (?:use|purposes)(?: only)?"),
    ("commercial", MENTION, "non-commercial", "(?:for )?non commercial (?:use|purposes)(?: only)?"),
    ("warrant", MENTION, "no-warranty", "without warrant(?:y|ies) of any kind"),
    ("warranty", TITLE, "mit", "the software is provided as is without warranty of any kind express or implied"),
    ("permission", TITLE, "mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("permission", TITLE, "isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("redistribution", TITLE, "bsd", "redistribution and use in source and binary forms with or without modification"),
    ("redistribute", TITLE, "gpl", "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("proprietary", MENTION, "proprietary", "proprietary and confidential"),
    ("proprietary", TITLE, "proprietary", "this (?:software|document|work) is proprietary"),
    ("licensor", MENTION, "agreement", "the licensor grants(?: to)? you"),
    ("end user", MENTION, "agreement", "end user licen[cs]e agreement"),
    ("eula", MENTION, "agreement", "eula"),
    ("bsd", MENTION, "bsd", "bsd (?:style )?licen[cs]e"),
    ("apache", MENTION, "apache", "apache licen[cs]ed?"),
]


def all_rules() -> list[Rule]:
    """Every rule, four for a license with an address and three for one without."""
    rules = []
    for label, keyword, name, identifier, address in LICENSES:
        first = identifier.split(" ")[0]
        rules += [
            Rule("spdx", IDENTIFIER, label, f"spdx licen[cs]e identifier {identifier}"),
            Rule(keyword, NOTICE, label, f"{GRANTED} {name}"),
            Rule(keyword, TITLE, label, name),
        ]
        if address:
            rules.append(Rule(address.split(" ")[0], TITLE, label, f"(?:https? )?(?:www )?{address}"))
        if first in ("bsd", "cc", "gpl", "lgpl", "agpl") and " " in identifier:
            rules.append(Rule(f" {first} ", TITLE, label, identifier))
    return rules + [Rule(k, r, label, pattern) for k, r, label, pattern in OTHERS]
