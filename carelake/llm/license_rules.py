"""Signature rules of the licence scan, built from families of names, versions and forms.

Rules are matched against normalised text: lower-case words with one blank between, so a dot or a dash is a blank
(``2.0`` reads ``2 0``). Rules are ordered: a lower ``rank`` is the stronger evidence.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    rank: int  # 1 full text or tag, 2 grant or address, 3 name with version, 4 bare name, 5 notice
    label: str
    keyword: str  # stands in every normalised text that the pattern can match
    pattern: str
    weight: float


@dataclass(frozen=True)
class Family:
    """A licence: how its name is written, a word that stands in every way of writing it, and its versions."""

    label: str
    name: str
    keyword: str
    versions: tuple[str, ...] = ()
    address: str = ""


FAMILIES = (
    Family("mit", "mit(?: style)? licen[sc]e", " mit ", address="opensource org licenses mit"),
    Family("mit", "expat(?: style)? licen[sc]e", " expat "),
    Family("mit-0", "mit no attribution(?: licen[sc]e)?", "attribution"),
    Family("apache", "apache(?: software)? licen[sc]e", "apache", ("1.0", "1.1", "2.0"), "apache org licenses license"),
    Family("gpl", "gnu gpl", "gpl", ("1.0", "2.0", "3.0")),
    Family("gpl", "(?:gnu )?general public licen[sc]e", " general public ", ("1.0", "2.0", "3.0"), "gnu org licenses gpl"),
    Family("lgpl", "gnu lgpl", "lgpl", ("2.0", "2.1", "3.0")),
    Family("lgpl", "(?:gnu )?(?:lesser|library) general public licen[sc]e", " general public ", ("2.0", "2.1", "3.0"), "gnu org licenses lgpl"),
    Family("agpl", "gnu agpl", "agpl", ("1.0", "3.0")),
    Family("agpl", "(?:gnu )?affero general public licen[sc]e", "affero", ("1.0", "3.0"), "gnu org licenses agpl"),
    Family("gfdl", "(?:gnu )?free documentation licen[sc]e", "documentation", ("1.1", "1.2", "1.3"), "gnu org licenses fdl"),
    Family("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd", address="opensource org licenses bsd 2 clause"),
    Family("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?", "bsd", address="opensource org licenses bsd 3 clause"),
    Family("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", "bsd"),
    Family("0bsd", "(?:0bsd|zero clause bsd|bsd zero clause)(?: licen[sc]e)?", "bsd"),
    Family("bsd", "bsd(?: style)? licen[sc]e", "bsd"),
    Family("mpl", "mozilla public licen[sc]e", "mozilla", ("1.0", "1.1", "2.0"), "mozilla org mpl"),
    Family("epl", "eclipse public licen[sc]e", "eclipse", ("1.0", "2.0"), "eclipse org legal epl"),
    Family("cddl", "common development and distribution licen[sc]e", " common development ", ("1.0", "1.1")),
    Family("cpl", "common public licen[sc]e", " common public ", ("1.0",)),
    Family("eupl", "european union public licen[sc]e", "european", ("1.0", "1.1", "1.2")),
    Family("osl", "open software licen[sc]e", " open software ", ("1.0", "2.0", "2.1", "3.0")),
    Family("afl", "academic free licen[sc]e", "academic", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    Family("artistic", "artistic licen[sc]e", "artistic", ("1.0", "2.0")),
    Family("isc", "isc licen[sc]e", " isc ", address="opensource org licenses isc"),
    Family("isc", "internet systems consortium licen[sc]e", "consortium"),
    Family("zlib", "zlib(?: libpng)? licen[sc]e", "zlib"),
    Family("libpng", "libpng licen[sc]e", "libpng", ("1.0", "2.0")),
    Family("boost", "boost software licen[sc]e", "boost", ("1.0",), "boost org license"),
    Family("unlicense", "(?:the )?unlicense", "unlicense", address="unlicense org"),
    Family("wtfpl", "wtfpl", "wtfpl", ("1.0", "2.0")),
    Family("wtfpl", "do what the f\\w* you want to public licen[sc]e", " do what the ", ("1.0", "2.0")),
    Family("python", "python software foundation licen[sc]e", " python ", ("2.0",)),
    Family("python", "psf licen[sc]e", " psf ", ("2.0",)),
    Family("php", "php licen[sc]e", "php", ("3.0", "3.01")),
    Family("ruby", "ruby licen[sc]e", "ruby"),
    Family("perl", "same terms as perl itself", "perl"),
    Family("postgresql", "postgresql licen[sc]e", "postgresql"),
    Family("openssl", "openssl licen[sc]e", "openssl"),
    Family("curl", "curl licen[sc]e", "curl"),
    Family("w3c", "w3c software(?: notice)?(?: and)? licen[sc]e", "w3c"),
    Family("zpl", "zope public licen[sc]e", "zope", ("1.1", "2.0", "2.1")),
    Family("ncsa", "university of illinois(?: ncsa)? open source licen[sc]e", "illinois"),
    Family("upl", "universal permissive licen[sc]e", " universal permissive ", ("1.0",)),
    Family("ms-pl", "microsoft public licen[sc]e", "microsoft"),
    Family("ms-rl", "microsoft reciprocal licen[sc]e", "microsoft"),
    Family("ofl", "(?:sil )?open font licen[sc]e", " open font ", ("1.0", "1.1"), "scripts sil org ofl"),
    Family("bsl", "business source licen[sc]e", " business source ", ("1.0", "1.1")),
    Family("sspl", "server side public licen[sc]e", " server side ", ("1.0",)),
    Family("odbl", "open (?:data commons open )?database licen[sc]e", "database licen", ("1.0",), "opendatacommons org licenses odbl"),
    Family("odbl", "odbl", "odbl", ("1.0",)),
    Family("odc-by", "open data commons attribution licen[sc]e", "commons", ("1.0",), "opendatacommons org licenses by"),
    Family("pddl", "public domain dedication and licen[sc]e", "dedication", ("1.0",), "opendatacommons org licenses pddl"),
    Family("pddl", "pddl", "pddl", ("1.0",)),
    Family("cc0", "creative commons zero", "commons", ("1.0",)),
    Family("cc0", "cc0", "cc0", ("1.0",), "creativecommons org publicdomain zero"),
    Family("cecill", "cecill(?: free software)?(?: licen[sc]e)?", "cecill", ("1.0", "2.0", "2.1")),
    Family("mulan", "mulan permissive software licen[sc]e", "mulan", ("1.0", "2.0")),
    Family("blueoak", "blue oak model licen[sc]e", "oak", ("1.0.0",)),
    Family("elastic", "elastic licen[sc]e", "elastic", ("1.0", "2.0")),
    Family("polyform", "polyform (?:noncommercial|small business|strict) licen[sc]e", "polyform", ("1.0.0",)),
    Family("commons-clause", "commons clause", "clause"),
    Family("rail", "open ?rail licen[sc]e", "rail "),
    Family("rail", "responsible ai licen[sc]e", " responsible ai "),
)

# The attribution licences of one publisher: parts of the name and their words.
CC_PARTS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv\\w*", "sa": "share ?alike"}
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Sentences of the licences themselves.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("boost-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("cc0", "has waived all copyright and related or neighboring rights"),
    ("ofl", "this font software is licensed under the sil open font license"),
)

NOTICES = (
    ("all-rights-reserved", "rights reserved", "all rights reserved"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)\\d\\d"),
    ("public-domain", "public domain", "(?:in|into|to) the public domain"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("no-redistribution", "prohibited", "(?:redistribution|reproduction|copying) (?:\\w+ ){0,4}(?:is )?(?:strictly )?prohibited"),
    ("non-commercial", "commercial use", "(?:for )?non ?commercial use only"),
    ("fair-use", "fair use", "fair use"),
    ("license-mention", "ed under ", "licen[sc]ed under"),
)

GRANT = "(?:licen[sc]ed|released|distributed|available|provided|published|redistributed|governed)(?: \\w+)? (?:under|by)(?: the)?(?: terms of)?(?: the)? "


def spaced(version: str) -> str:
    return version.replace(".", " ")


def versioned(name: str, version: str) -> str:
    """The name and a version; a trailing ``.0`` may be left out."""
    number = spaced(version)
    if version.count(".") == 1 and version.endswith(".0"):
        number = f"{version[:-2]}(?: 0)?"
    return f"(?:{name})(?: v| version| ver)? ?{number}(?! \\d)"


def family_rules(family: Family) -> list[Rule]:
    label, name, keyword = family.label, f"(?:{family.name})", family.keyword
    tag = spaced(label.replace("-", " "))
    found = [
        Rule(1, label, "spdx", f"spdx licen[sc]e identifier {tag}(?! \\d)", 1.0),
        Rule(2, label, keyword, f"{GRANT}{name}", 0.9),
        Rule(4, label, keyword, name, 0.6),
    ]
    if family.address:
        found.append(Rule(2, label, family.address, family.address, 0.9))
    for version in family.versions:
        own = f"{label}-{version}"
        found += [
            Rule(1, own, "spdx", f"spdx licen[sc]e identifier {tag} {spaced(version)}", 1.0),
            Rule(2, own, keyword, GRANT + versioned(family.name, version), 0.95),
            Rule(3, own, keyword, versioned(family.name, version), 0.8),
        ]
    return found


def cc_rules() -> list[Rule]:
    found = []
    for kind in CC_KINDS:
        parts = kind.split("-")
        end = "(?! (?:nc|nd|sa|non|no|share))"
        written = ((f"cc {' '.join(parts)}{end}", " cc by"), (f"creative commons {' '.join(CC_PARTS[p] for p in parts)}{end}", " creative commons "))
        for name, keyword in written:
            found += [Rule(2, f"cc-{kind}", keyword, GRANT + name, 0.9), Rule(4, f"cc-{kind}", keyword, name, 0.6)]
        for version in CC_VERSIONS:
            own, number = f"cc-{kind}-{version}", spaced(version)
            tail = f"(?: international| unported| generic| licen[sc]e)? {number}"
            address = f"creativecommons org licenses {' '.join(parts)} {number}"
            found.append(Rule(2, own, "creativecommons", address, 0.95))
            for name, keyword in written:
                found += [Rule(2, own, keyword, GRANT + name + tail, 0.95), Rule(3, own, keyword, name + tail, 0.8)]
    return found


def rules() -> list[Rule]:
    """All rules, strongest first."""
    found = [r for family in FAMILIES for r in family_rules(family)] + cc_rules()
    found += [Rule(1, label, " ".join(text.split(" ")[:4]), text, 1.0) for label, text in SENTENCES]
    found += [Rule(5, label, keyword, text, 0.3) for label, keyword, text in NOTICES]
    return sorted(found, key=lambda r: (r.rank, r.label, r.pattern))
