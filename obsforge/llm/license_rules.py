"""Signature rules for license texts, over words in lower case joined by single spaces.

A rule has a keyword that is part of every match of its pattern (the pattern is tried only on texts that hold it), a label, a priority (a smaller number wins where
detections overlap) and a confidence. Patterns are written for each license; the notice forms that all licenses share are
applied to every license name.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    keyword: str
    pattern: str
    label: str
    priority: int
    confidence: float


# Phrases whose places are always reported, with their labels (fixed values).
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# label, how the name is written, how its SPDX identifier is written.
NAMES = [
    ("mit", "mit|expat|x11", "mit"),
    ("apache-2", "apache(?: software)?(?: license)?(?: version)? (?:v)?2(?: 0)?|asl 2(?: 0)?|al2", "apache 2 0"),
    ("apache-1.1", "apache(?: software)?(?: license)?(?: version)? (?:v)?1 1", "apache 1 1"),
    ("gpl-1", "gpl ?v?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gpl ?v?2(?: 0)?|gplv2", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gpl ?v?3(?: 0)?|gplv3", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2", "lgpl ?v?2(?: 0)?|lgplv2", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl ?v?2 1|lgplv2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl ?v?3(?: 0)?|lgplv3", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "agpl ?v?3(?: 0)?|agplv3", "agpl 3 0(?: only| or later)?"),
    ("gpl-1", "gnu general public license(?: version| v)? 1(?: 0)?", "gpl 1 0"),
    ("gpl-2", "gnu general public license(?: version| v)? 2(?: 0)?", "gpl 2 0"),
    ("gpl-3", "gnu general public license(?: version| v)? 3(?: 0)?", "gpl 3 0"),
    ("lgpl-2.1", "gnu lesser general public license(?: version| v)? 2 1", "lgpl 2 1"),
    ("lgpl-3", "gnu lesser general public license(?: version| v)? 3(?: 0)?", "lgpl 3 0"),
    ("lgpl-2", "gnu library general public license(?: version| v)? 2(?: 0)?", "lgpl 2 0"),
    ("agpl-3", "gnu affero general public license(?: version| v)? 3(?: 0)?", "agpl 3 0"),
    ("gfdl-1.3", "gnu free documentation license(?: version| v)? 1 3", "gfdl 1 3(?: only| or later)?"),
    ("gfdl-1.2", "gnu free documentation license(?: version| v)? 1 2", "gfdl 1 2(?: only| or later)?"),
    ("bsd-2-clause", "simplified bsd|freebsd|2 clause bsd|bsd 2 clause|two clause bsd", "bsd 2 clause"),
    ("bsd-3-clause", "new bsd|modified bsd|revised bsd|3 clause bsd|bsd 3 clause|three clause bsd", "bsd 3 clause"),
    ("bsd-4-clause", "original bsd|old bsd|4 clause bsd|bsd 4 clause|four clause bsd", "bsd 4 clause"),
    ("0bsd", "zero clause bsd|0bsd|bsd zero clause", "0bsd"),
    ("isc", "isc", "isc"),
    ("mpl-1.1", "mozilla public license(?: version| v)? 1 1", "mpl 1 1"),
    ("mpl-2", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    ("mpl-2", "mpl ?v?2(?: 0)?", "mpl 2 0"),
    ("epl-1", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0"),
    ("cddl-1", "common development and distribution license(?: version| v)? ?1?(?: 0)?", "cddl 1 0"),
    ("cpl-1", "common public license(?: version| v)? ?1?(?: 0)?", "cpl 1 0"),
    ("eupl-1.2", "eupl(?: version| v)? ?1 2", "eupl 1 2"),
    ("eupl-1.2", "european union public licen[cs]e(?: version| v)? ?1 2", "eupl 1 2"),
    ("artistic-1", "artistic license(?: version| v)? ?1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic license(?: version| v)? ?2(?: 0)?", "artistic 2 0"),
    ("boost-1", "boost software license(?: version| v)? ?1?(?: 0)?", "bsl 1 0"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("openssl", "openssl", "openssl"),
    ("php-3.01", "php license(?: version| v)? 3 01", "php 3 01"),
    ("python-2", "python software foundation license(?: version| v)? ?2?(?: 0)?", "python 2 0|psf 2 0"),
    ("postgresql", "postgresql", "postgresql"),
    ("ofl-1.1", "sil open font license(?: version| v)? ?1?(?: 1)?", "ofl 1 1"),
    ("ms-pl", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "ms rl"),
    ("odbl-1", "open database license(?: version| v)? ?1?(?: 0)?", "odbl 1 0"),
    ("mulan-2", "mulan permissive software license(?: version| v)? ?2", "mulanpsl 2 0"),
    ("upl-1", "universal permissive license(?: version| v)? ?1?(?: 0)?", "upl 1 0"),
    ("afl-3", "academic free license(?: version| v)? ?3(?: 0)?", "afl 3 0"),
    ("osl-3", "open software license(?: version| v)? ?3(?: 0)?", "osl 3 0"),
    ("cc0-1", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
]

# How a notice names its license; {name} is the license's name. With the words that any text with such a notice holds.
NOTICES = [
    ("licensed under", "licensed under(?: the)?(?: terms of)?(?: the)? (?:{name})(?: licen[cs]e)?", 20, 0.9),
    ("released under", "released under(?: the)?(?: terms of)?(?: the)? (?:{name})(?: licen[cs]e)?", 20, 0.9),
    ("distributed under", "distributed under(?: the)?(?: terms of)?(?: the)? (?:{name})(?: licen[cs]e)?", 20, 0.9),
    ("governed by", "governed by(?: the)? (?:{name})(?: licen[cs]e)?", 30, 0.8),
    (" licen", "licen[cs]e (?:{name})", 40, 0.7),
    (" licen", "(?:{name}) licen[cs]ed?", 40, 0.7),
]

# Creative Commons: element, words of its name.
_COMMONS = [
    ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:s|atives)"),
    ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:s|atives)"),
]

# Sentences of license texts and notices of their own.
TEXTS = [
    Rule("permission", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 10, 0.95),
    Rule("warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "mit", 15, 0.8),
    Rule("permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc", 10, 0.95),
    Rule("redistribution", "redistribution and use in source and binary forms with or without modification are permitted", "bsd", 35, 0.8),
    Rule("neither the name", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived", "bsd-3-clause", 10, 0.95),
    Rule("advertising", "all advertising materials mentioning features or use of this software must display", "bsd-4-clause", 10, 0.95),
    Rule("apache", "www apache org licenses license 2 0", "apache-2", 5, 1.0),
    Rule("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org", "apache-2", 5, 1.0),
    Rule("gnu", "www gnu org licenses gpl 3 0", "gpl-3", 5, 1.0),
    Rule("gnu", "www gnu org licenses (?:old licenses )?gpl 2 0", "gpl-2", 5, 1.0),
    Rule("gnu", "www gnu org licenses lgpl 3 0", "lgpl-3", 5, 1.0),
    Rule("gnu", "www gnu org licenses agpl 3 0", "agpl-3", 5, 1.0),
    Rule("gnu", "gnu general public license as published by the free software foundation either version 2", "gpl-2", 8, 1.0),
    Rule("gnu", "gnu general public license as published by the free software foundation either version 3", "gpl-3", 8, 1.0),
    Rule("gnu", "gnu general public license", "gpl", 60, 0.6),
    Rule("gnu", "gnu lesser general public license", "lgpl", 60, 0.6),
    Rule("gnu", "gnu affero general public license", "agpl", 60, 0.6),
    Rule("gnu", "gnu free documentation license", "gfdl", 60, 0.6),
    Rule("apache", "apache license", "apache", 60, 0.6),
    Rule("bsd", "bsd (?:style )?licen[cs]e", "bsd", 60, 0.6),
    Rule("mozilla", "mozilla public license", "mpl", 60, 0.6),
    Rule("mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2", 5, 1.0),
    Rule("eclipse", "eclipse public license", "epl", 60, 0.6),
    Rule("unencumbered", "this is free and unencumbered software released into the public domain", "unlicense", 5, 1.0),
    Rule("public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public-domain", 30, 0.8),
    Rule("all rights reserved", "all rights reserved", "proprietary", 80, 0.4),
    Rule("proprietary", "proprietary and confidential", "proprietary", 50, 0.7),
    Rule("held liable", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "zlib", 10, 0.9),
    Rule("altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original", "zlib", 10, 0.95),
    Rule("permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "boost-1", 5, 1.0),
    Rule("creative commons", "creative commons(?: licen[cs]e)?", "cc", 70, 0.5),
    Rule("creative commons", "creative commons (?:cc0|zero)(?: 1 0)?", "cc0-1", 20, 0.9),
]


def rules() -> list[Rule]:
    """All rules, best first."""
    out = list(TEXTS)
    for label, name, spdx in NAMES:
        out.append(Rule("spdx", f"spdx license identifier (?:{spdx})", label, 1, 1.0))
        out += [Rule(keyword, form.replace("{name}", name), label, priority, confidence) for keyword, form, priority, confidence in NOTICES]
    for element, words in _COMMONS:
        short, label = element.replace("-", " "), f"cc-{element}"
        out += [
            Rule("cc by", f"cc {short}(?: [1-4] [05])?", label, 20, 0.9),
            Rule("spdx", f"spdx license identifier cc {short} [1-4] [05]", label, 1, 1.0),
            Rule("creativecommons", f"creativecommons org licenses {short}(?: [1-4] [05])?", label, 5, 1.0),
            Rule("creative commons", f"creative commons {words}(?: [1-4] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?", label, 20, 0.9),
        ]
    return sorted(out, key=lambda r: (r.priority, r.label, r.pattern))
