"""Licence signatures: ordered regex rules over normalised words.

A rule is a regex over a text's words joined by single blanks, with a priority, a label, a
confidence and two lists of keywords. The regex is tried only where one keyword of each list occurs,
so every match must hold one of each. The second lists of all rules are the gates: a text without
any of them has no detection. The names below are written by hand; each is put into the phrases in
which licences are declared.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

# The base phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Hand-written names: label, regex of the name in words, keyword or keywords, identifier in words.
NAMES = (
    ("mit", r"(?:mit|expat)(?: x11)?", ("mit", "expat"), r"mit"),
    ("mit-0", r"mit (?:0|no attribution)", "mit", r"mit 0"),
    ("apache-1.1", r"apache(?: software)?(?: license)?(?: version| v)? ?1 1", "apache", r"apache 1 1"),
    ("apache-2.0", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", "apache", r"apache 2 0"),
    ("gpl-1.0", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?1(?: 0)?", "g", r"gpl 1 0"),
    ("gpl-2.0", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?2(?: 0)?", "g", r"gpl 2 0(?: only)?"),
    ("gpl-2.0-or-later", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?2(?: 0)? or(?: at your option)?(?: any)? later", "later", r"gpl 2 0 or later"),
    ("gpl-3.0", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?3(?: 0)?", "g", r"gpl 3 0(?: only)?"),
    ("gpl-3.0-or-later", r"(?:gnu )?(?:gpl|general public license)(?: version| v)? ?3(?: 0)? or(?: at your option)?(?: any)? later", "later", r"gpl 3 0 or later"),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)", "l", r"lgpl"),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)(?: version| v)? ?2 1", "2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?3(?: 0)?", "3", r"lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", r"(?:gnu )?(?:agpl|affero general public license)(?: version| v)?(?: ?3(?: 0)?)?", "a", r"agpl 3 0(?: only| or later)?"),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation license)", ("gfdl", "free"), r"gfdl 1 [123]"),
    ("bsd-0", r"(?:0bsd|zero clause bsd|bsd zero clause)", "bsd", r"0bsd"),
    ("bsd-2", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd", r"bsd 2 clause"),
    ("bsd-3", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)", "bsd", r"bsd 3 clause"),
    ("bsd-4", r"(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd", r"bsd 4 clause"),
    ("isc", r"isc|internet systems consortium", "i", r"isc"),
    ("mpl-1.1", r"(?:mpl|mozilla public license)(?: version| v)? ?1 1", "m", r"mpl 1 1"),
    ("mpl-2.0", r"(?:mpl|mozilla public license)(?: version| v)? ?2(?: 0)?", "m", r"mpl 2 0"),
    ("epl-1.0", r"(?:epl|eclipse public license)(?: version| v)? ?1(?: 0)?", "e", r"epl 1 0"),
    ("epl-2.0", r"(?:epl|eclipse public license)(?: version| v)? ?2(?: 0)?", "e", r"epl 2 0"),
    ("edl-1.0", r"eclipse distribution license", "eclipse", r"edl 1 0"),
    ("cddl-1.0", r"(?:cddl|common development and distribution license)(?: version| v)?(?: ?1(?: 0)?)?", "d", r"cddl 1 0"),
    ("cpl-1.0", r"common public license", "common", r"cpl 1 0"),
    ("ipl-1.0", r"ibm public license", "ibm", r"ipl 1 0"),
    ("eupl", r"european union public licen[cs]e", "european", r"eupl 1 [12]"),
    ("artistic-1.0", r"artistic license(?: version| v)? ?1(?: 0)?", "artistic", r"artistic 1 0"),
    ("artistic-2.0", r"artistic license(?: version| v)? ?2(?: 0)?", "artistic", r"artistic 2 0"),
    ("perl", r"(?:same terms as perl itself|perl 5)", "perl", r"perl 5"),
    ("python-2.0", r"(?:python software foundation|psf)", "p", r"(?:python|psf) 2 0"),
    ("php-3.01", r"php license(?: version| v)? ?3 0?1", "php", r"php 3 01"),
    ("ruby", r"ruby", "ruby", r"ruby"),
    ("postgresql", r"postgresql", "postgresql", r"postgresql"),
    ("openssl", r"openssl", "openssl", r"openssl"),
    ("zlib", r"zlib(?: libpng)?", "zlib", r"zlib"),
    ("libpng", r"libpng", "libpng", r"libpng(?: 2 0)?"),
    ("curl", r"curl", "curl", r"curl"),
    ("bzip2", r"bzip2", "bzip2", r"bzip2 1 0 6"),
    ("boost-1.0", r"boost software license", "boost", r"bsl 1 0"),
    ("unlicense", r"unlicense", "unlicense", r"unlicense"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public license)", "w", r"wtfpl"),
    ("beerware", r"beer ?ware", "beer", r"beerware"),
    ("cc0-1.0", r"(?:cc0|creative commons zero)(?: 1 0)?", "c", r"cc0 1 0"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1-4] 0)?", "c", r"cc by [1-4] 0"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] 0)?", "c", r"cc by sa [1-4] 0"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?derivatives)(?: [1-4] 0)?", "c", r"cc by nd [1-4] 0"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] 0)?", "c", r"cc by nc [1-4] 0"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] 0)?", "c", r"cc by nc sa [1-4] 0"),
    ("odbl", r"open database license", "database", r"odbl 1 0"),
    ("ofl-1.1", r"(?:sil )?open font license", "font", r"ofl 1 1"),
    ("osl-3.0", r"open software license", "software", r"osl 3 0"),
    ("afl-3.0", r"academic free license", "academic", r"afl 3 0"),
    ("ms-pl", r"microsoft public license", "microsoft", r"ms pl"),
    ("ms-rl", r"microsoft reciprocal license", "microsoft", r"ms rl"),
    ("ncsa", r"university of illinois ncsa(?: open source)?", "ncsa", r"ncsa"),
    ("upl-1.0", r"universal permissive license", "universal", r"upl 1 0"),
    ("elastic-2.0", r"elastic license(?: 2 0)?", "elastic", r"elastic 2 0"),
    ("sspl-1.0", r"server side public license", "server", r"sspl 1 0"),
    ("busl-1.1", r"business source license(?: 1 1)?", "business", r"busl 1 1"),
    ("mulan-2.0", r"mulan (?:psl|permissive software license)(?: v2| 2)?", "mulan", r"mulanpsl 2 0"),
    ("cecill", r"cecill(?: b| c)?", "cecill", r"cecill 2 [01]"),
    ("w3c", r"w3c software(?: notice)?", "w3c", r"w3c"),
    ("vim", r"vim", "vim", r"vim"),
    ("jpl-image", r"jpl image use", "jpl", r"jpl image"),
    ("proprietary", r"(?:proprietary|commercial|end user)", "r", r"licenseref proprietary"),
)

# Hand-written phrases around a name: regex, second keywords, priority, confidence.
PHRASES = (
    (r"spdx license identifier {spdx}", ("spdx license identifier",), 4, 1.0),
    (r"(?:opensource|spdx) org licenses? {spdx}", (" org license",), 4, 0.95),
    (r"(?:licensed|distributed|released|available) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{name})(?: licen[cs]e)?", ("licensed under ", "distributed under ", "released under ", "available under "), 3, 0.9),
    (r"(?:{name}) licen[cs]e(?: version \d+(?: \d+)?)?", (" licen",), 2, 0.75),
    (r"(?=\S+(?: \S+){0,3} licen[cs]e)(?:{name})(?<=\d)", (" licen",), 2, 0.75),
    (r"licen[cs]e (?:is )?(?:the )?(?:{name})", ("licen",), 1, 0.5),
)

# Hand-written notices without a name: label, regex, keyword, second keyword, priority, confidence.
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby", "permission", 3, 0.95),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", "distribute", "permission", 3, 0.95),
    ("bsd-3", r"neither the name of (?:\S+ ){1,8}nor the names of its contributors", "contributors", "neither", 3, 0.9),
    ("bsd-2", r"redistributions of source code must retain the above copyright notice", "retain", "redistributions", 2, 0.8),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "compliance", "license", 3, 0.9),
    ("gpl", r"(?:gnu )?general public license", "general", "license", 1, 0.75),
    ("gpl", r"either version (?:\d+ )of the license or at your option any later version", "option", "license", 2, 0.8),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "mozilla", "license", 3, 0.95),
    ("apache", r"apache license", "apache", "license", 1, 0.75),
    ("all-rights-reserved", r"all rights reserved", "reserved", "rights", 1, 0.4),
    ("copyright", r"copyright(?: c)? (?:19|20)\d\d", "copyright", "copyright", 1, 0.3),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain", "public domain", 2, 0.8),
    ("no-warranty", r"without warrant(?:y|ies) of any kind", "without", "warrant", 1, 0.4),
)


def first_words(spdx: str) -> tuple[str, ...]:
    """First word of an identifier, or those of its alternatives."""
    choice = re.match(r"\(\?:([^)]*)\)", spdx)
    return tuple(choice[1].split("|")) if choice else (re.match(r"\w+", spdx)[0],)


@lru_cache
def rules() -> tuple[dict, ...]:
    """All rules in order; `base` rules are never suppressed."""
    found = [
        {"regex": phrase, "label": label, "keys": (phrase.split()[0],), "keys2": ("license",), "priority": 2,
         "confidence": 0.75, "base": True}
        for phrase, label in BASE_PHRASES
    ]
    for label, name, keys, spdx in NAMES:
        keys = (keys,) if isinstance(keys, str) else keys
        for phrase, keys2, priority, confidence in PHRASES:
            regex = phrase.replace("{name}", name).replace("{spdx}", spdx)
            own = first_words(spdx) if "{spdx}" in phrase else keys
            found.append({"regex": regex, "label": label, "keys": own, "keys2": keys2, "priority": priority,
                          "confidence": confidence, "base": False})
    for label, regex, key, key2, priority, confidence in NOTICES:
        found.append({"regex": regex, "label": label, "keys": (key,), "keys2": (key2,), "priority": priority,
                      "confidence": confidence, "base": False})
    return tuple({"rule": i, **rule} for i, rule in enumerate(found))


def rules_json() -> str:
    return json.dumps([{**r, "regex": f"(?<= )(?:{r['regex']})(?= )"} for r in rules()])


@lru_cache
def gates() -> tuple[str, ...]:
    """A text without any of these holds no rule's keywords."""
    words = {word for rule in rules() for word in rule["keys2"]}
    return tuple(sorted(w for w in words if not any(other != w and other in w for other in words)))
