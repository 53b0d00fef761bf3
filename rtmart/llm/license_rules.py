"""License signature rules.

A rule is (tier, label, keyword, pattern). Patterns run over normalised text:
lower-case words with one space around each. A lower tier has priority. Rules
of versioned families are built from the family's patterns and versions.
"""

from __future__ import annotations

TAG, TITLE, NAME, HINT = 1, 2, 3, 4

#: How sure a detection of each tier is.
CONFIDENCE = {TAG: 1.0, TITLE: 0.95, NAME: 0.8, HINT: 0.6}

_V = "(?:version |v )?"

#: family: (keyword, title patterns with {v} for the version, versions)
VERSIONED = {
    "gpl": ("gpl", ["(?:gnu )?gpl (?:license )?" + _V + "{v}", "gplv{v}"], ["1", "2", "3"]),
    "gpl-text": ("general", ["(?:gnu )?general public licen[cs]e " + _V + "{v}",
                             "{v} of the (?:gnu )?general public licen[cs]e"], ["1", "2", "3"]),
    "lgpl": ("lgpl", ["(?:gnu )?lgpl " + _V + "{v}", "lgplv{v}"], ["2", "2 1", "3"]),
    "lgpl-text": ("lesser", ["(?:gnu )?lesser general public licen[cs]e " + _V + "{v}"],
                  ["2 1", "3"]),
    "lgpl-library": ("library", ["(?:gnu )?library general public licen[cs]e " + _V + "{v}"], ["2"]),
    "agpl": ("agpl", ["(?:gnu )?agpl " + _V + "{v}", "agplv{v}"], ["1", "3"]),
    "agpl-text": ("affero", ["(?:gnu )?affero general public licen[cs]e " + _V + "{v}"], ["1", "3"]),
    "gfdl": ("documentation", ["(?:gnu )?free documentation licen[cs]e " + _V + "{v}"],
             ["1 1", "1 2", "1 3"]),
    "apache": ("apache", ["apache (?:software )?(?:licen[cs]e )?" + _V + "{v}",
                          "apache org licenses license {v}"], ["1 0", "1 1", "2 0"]),
    "mpl": ("mozilla", ["mozilla public licen[cs]e " + _V + "{v}"], ["1 0", "1 1", "2 0"]),
    "mpl-short": ("mpl", ["mpl " + _V + "{v}"], ["1 0", "1 1", "2 0"]),
    "epl": ("eclipse", ["eclipse public licen[cs]e " + _V + "{v}"], ["1 0", "2 0"]),
    "cpl": ("common", ["common public licen[cs]e " + _V + "{v}"], ["0 5", "1 0"]),
    "cddl": ("cddl", ["cddl " + _V + "{v}"], ["1 0", "1 1"]),
    "cddl-text": ("distribution", ["common development and distribution licen[cs]e " + _V + "{v}"],
                  ["1 0", "1 1"]),
    "eupl": ("eupl", ["eupl " + _V + "{v}"], ["1 0", "1 1", "1 2"]),
    "eupl-text": ("european", ["european union public licen[cs]e " + _V + "{v}"], ["1 0", "1 1", "1 2"]),
    "artistic": ("artistic", ["artistic licen[cs]e " + _V + "{v}"], ["1 0", "2 0"]),
    "osl": ("open", ["open software licen[cs]e " + _V + "{v}"], ["1 0", "2 0", "2 1", "3 0"]),
    "afl": ("academic", ["academic free licen[cs]e " + _V + "{v}"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    "python": ("psf", ["psf licen[cs]e " + _V + "{v}"], ["2"]),
    "boost": ("boost", ["boost software licen[cs]e " + _V + "{v}"], ["1 0"]),
    "ofl": ("sil", ["sil open font licen[cs]e " + _V + "{v}"], ["1 0", "1 1"]),
    "zpl": ("zope", ["zope public licen[cs]e " + _V + "{v}"], ["1 1", "2 0", "2 1"]),
    "lppl": ("latex", ["latex project public licen[cs]e " + _V + "{v}"], ["1 0", "1 2", "1 3"]),
    "ms-pl": ("microsoft", ["microsoft public licen[cs]e " + _V + "{v}"], ["1 0"]),
    "odbl": ("database", ["open database licen[cs]e " + _V + "{v}"], ["1 0"]),
    "bsd": ("bsd", ["bsd {v} clause", "{v} clause bsd"], ["0", "1", "2", "3", "4"]),
}

CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
#: variant: the short form and the long form
CC_VARIANTS = {
    "cc-by": ("cc by", "attribution"),
    "cc-by-sa": ("cc by sa", "attribution share ?alike"),
    "cc-by-nd": ("cc by nd", "attribution no ?deriv(?:s|atives)"),
    "cc-by-nc": ("cc by nc", "attribution non ?commercial"),
    "cc-by-nc-sa": ("cc by nc sa", "attribution non ?commercial share ?alike"),
    "cc-by-nc-nd": ("cc by nc nd", "attribution non ?commercial no ?deriv(?:s|atives)"),
}

#: SPDX identifiers, as words
SPDX = """mit|mit 0|apache 1 0|apache 1 1|apache 2 0|bsd 2 clause|bsd 3 clause|bsd 4 clause|0bsd|isc|zlib
gpl 1 0|gpl 2 0|gpl 3 0|lgpl 2 0|lgpl 2 1|lgpl 3 0|agpl 1 0|agpl 3 0|mpl 1 0|mpl 1 1|mpl 2 0|epl 1 0|epl 2 0
cddl 1 0|cddl 1 1|eupl 1 1|eupl 1 2|artistic 1 0|artistic 2 0|osl 3 0|afl 3 0|bsl 1 0|unlicense|wtfpl
cc0 1 0|cc by 3 0|cc by 4 0|cc by sa 3 0|cc by sa 4 0|cc by nc 4 0|cc by nd 4 0|cc by nc sa 4 0|cc by nc nd 4 0
ofl 1 1|python 2 0|psf 2 0|postgresql|ncsa|x11|curl|openssl|ruby|php 3 01|vim|w3c|zpl 2 1|lppl 1 3c|ms pl|ms rl
upl 1 0|unicode 3 0|beerware|hpnd|icu|libpng 2 0|naist 2003|ntp|odbl 1 0|sleepycat|tcl|blueoak 1 0 0|cecill 2 1"""

#: (tier, label, keyword, pattern)
PLAIN = [
    (TITLE, "mit", "licen", "(?:the )?mit licen[cs]e"),
    (NAME, "mit", "licen", "mit licen[cs]ed"),
    (TITLE, "mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    (HINT, "mit", "merchantability", "the software is provided as is without warranty of any kind"),
    (TITLE, "x11", "x11", "x11 licen[cs]e"),
    (TITLE, "isc", "licen", "isc licen[cs]e"),
    (TITLE, "isc", "permission", "permission to use copy modify and or distribute this software"),
    (TITLE, "zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    (HINT, "zlib", "altered", "altered source versions must be plainly marked as such"),
    (NAME, "bsd", "bsd", "bsd(?: style)? licen[cs]ed?"),
    (NAME, "bsd", "redistribution",
     "redistribution and use in source and binary forms with or without modification are permitted"),
    (HINT, "bsd-3-clause", "endorse", "used to endorse or promote products derived from this software"),
    (HINT, "bsd-4-clause", "advertising", "all advertising materials mentioning features"),
    (NAME, "gpl", "general", "(?:gnu )?general public licen[cs]e"),
    (NAME, "gpl", "gpl", "(?:gnu )?gpl"),
    (HINT, "gpl", "free", "free software you can redistribute it and or modify it under the terms"),
    (NAME, "lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e"),
    (NAME, "lgpl", "lgpl", "(?:gnu )?lgpl"),
    (NAME, "agpl", "affero", "(?:gnu )?affero general public licen[cs]e"),
    (NAME, "agpl", "agpl", "(?:gnu )?agpl"),
    (NAME, "gfdl", "documentation", "(?:gnu )?free documentation licen[cs]e"),
    (NAME, "apache", "apache", "apache(?: software)? licen[cs]e"),
    (NAME, "mpl", "mozilla", "mozilla public licen[cs]e"),
    (NAME, "epl", "eclipse", "eclipse public licen[cs]e"),
    (NAME, "cddl", "distribution", "common development and distribution licen[cs]e"),
    (NAME, "artistic", "artistic", "artistic licen[cs]e"),
    (TITLE, "unlicense", "unlicense", "(?:the )?unlicense"),
    (HINT, "unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    (TITLE, "wtfpl", "wtfpl", "wtfpl"),
    (TITLE, "wtfpl", "fuck", "do what the fuck you want to public licen[cs]e"),
    (TITLE, "cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    (NAME, "cc0", "creative", "creative commons zero"),
    (NAME, "cc", "creative", "creative commons(?: licen[cs]e)?"),
    (HINT, "public-domain", "domain", "(?:in|into|to) the public domain"),
    (NAME, "public-domain", "domain", "dedicated to the public domain"),
    (TITLE, "postgresql", "postgresql", "postgresql licen[cs]e"),
    (TITLE, "openssl", "openssl", "openssl licen[cs]e"),
    (TITLE, "php", "licen", "php licen[cs]e"),
    (TITLE, "ruby", "ruby", "ruby licen[cs]e"),
    (TITLE, "python", "python", "python software foundation licen[cs]e"),
    (TITLE, "ncsa", "ncsa", "(?:university of illinois )?ncsa open source licen[cs]e"),
    (TITLE, "beerware", "licen", "beer ware licen[cs]e"),
    (TITLE, "ofl", "font", "open font licen[cs]e"),
    (TITLE, "vim", "licen", "vim licen[cs]e"),
    (TITLE, "upl", "permissive", "universal permissive licen[cs]e"),
    (TITLE, "ms-pl", "microsoft", "microsoft public licen[cs]e"),
    (TITLE, "ms-rl", "microsoft", "microsoft reciprocal licen[cs]e"),
    (TITLE, "odbl", "database", "open database licen[cs]e"),
    (TITLE, "elastic", "elastic", "elastic licen[cs]e(?: 2 0)?"),
    (TITLE, "sspl", "server", "server side public licen[cs]e"),
    (TITLE, "busl", "business", "business source licen[cs]e(?: 1 1)?"),
    (TITLE, "commons-clause", "clause", "commons clause"),
    (TITLE, "openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?"),
    (NAME, "proprietary", "proprietary", "proprietary and confidential"),
    (NAME, "proprietary", "unauthorized", "unauthorized (?:copying|reproduction|distribution)"),
    (HINT, "proprietary", "permission", "(?:may )?not be reproduced without(?: prior)?(?: written)? permission"),
    (NAME, "reserved", "reserved", "all rights reserved"),
    (HINT, "reserved", "reserved", "some rights reserved"),
    (HINT, "copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    (HINT, "copyright", "copyright", "copyright (?:c )?by"),
    (HINT, "licensed", "licensed", "(?:is |are )?licensed under(?: the)?"),
    (HINT, "licensed", "released", "released under(?: the)?"),
    (HINT, "see-license", "license", "see (?:the )?license(?: file| txt| md)?(?: for details)?"),
]


def _versioned() -> list[tuple]:
    rules = []
    for family, (keyword, patterns, versions) in VERSIONED.items():
        name = family.removesuffix("-text").removesuffix("-library").removesuffix("-short")
        for v in versions:
            for p in patterns:
                label = f"bsd-{v}-clause" if name == "bsd" else f"{name}-{v.replace(' ', '.')}"
                rules.append((TITLE, label, keyword, p.format(v=v)))
                if name in ("gpl", "lgpl", "agpl"):
                    rules.append((TAG, label + "-or-later", keyword,
                                  p.format(v=v) + " or(?: at your option)?(?: any)? later(?: version)?"))
                    rules.append((TAG, label + "-only", keyword, p.format(v=v) + " only"))
    return rules


def _creative_commons() -> list[tuple]:
    rules = []
    for label, (short, long) in CC_VARIANTS.items():
        rules.append((NAME, label, "cc", short))
        rules.append((NAME, label, "creative", "creative commons " + long))
        for v in CC_VERSIONS:
            version = v.replace(" ", ".")
            rules.append((TITLE, f"{label}-{version}", "cc", f"{short} {v}"))
            rules.append((TITLE, f"{label}-{version}", "creative",
                          f"creative commons {long}(?: international)? {v}"))
    return rules


def _spdx() -> list[tuple]:
    names = [x.strip() for x in SPDX.replace("\n", "|").split("|")]
    return [(TAG, n.replace(" ", "-"), "spdx", f"spdx license identifier {n}") for n in names]


def license_rules() -> list[tuple[int, str, str, str]]:
    """(tier, label, keyword, pattern) of every rule, in order of priority."""
    return sorted(_spdx() + _versioned() + _creative_commons() + PLAIN, key=lambda r: r[0])
