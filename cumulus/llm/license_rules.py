"""Signature rules of the licence scan.

A rule is (label, priority, confidence, keyword, pattern). Patterns are
word patterns: words of a normalised text (A-Z lower-cased, anything but
digits, letters and non-ASCII characters a separator), where

* ``word`` is a regular expression for one whole word,
* ``word?`` may be missing, ``..3`` stands for up to three words.

The keyword is a plain string that starts a word of every match; rules whose
keyword a text lacks are not run on it. ROOTS are few strings of which every
match contains one: texts without any of them are not normalised at all. Priorities: 4 a
full licence text or notice, 3 a name with its version, 2 a name, 1 a hint.
"""

from __future__ import annotations

#: Signatures that don't come in families.
PLAIN = [
    ("reserved", 1, .5, "reserved", "all rights reserved"),
    ("reserved", 2, .6, "reserved", "copyright ..6 all rights reserved"),
    ("copyright", 1, .3, "copyright", "copyright c? [0-9]{4} ..3"),
    ("copyright", 1, .3, "copyright", "copyrighted (?:by|material|work)"),
    ("mit", 3, .9, "mit", "the? mit licen[cs]e"),
    ("mit", 4, .95, "mit", "(?:released|licensed|distributed|available) under the? mit licen[cs]e"),
    ("mit", 2, .7, "mit", "mit licen[cs]ed"),
    ("mit", 4, 1., "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 4, .9, "substantial", "shall be included in all copies or substantial portions of the software"),
    ("mit-0", 3, .9, "mit", "mit no attribution"),
    ("mit-modern", 4, .9, "permission", "permission is hereby granted without written agreement and without licen[cs]e or royalty fees"),
    ("isc", 3, .9, "isc", "isc licen[cs]e"),
    ("isc", 4, 1., "permission", "permission to use copy modify and or? distribute this software for any purpose with or without fee"),
    ("bsd", 2, .6, "bsd", "bsd licen[cs]e"),
    ("bsd", 2, .6, "bsd", "bsd style licen[cs]e"),
    ("bsd", 4, .9, "redistribut", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 4, .95, "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 4, .95, "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("bsd-2-clause", 3, .9, "simplified", "simplified bsd licen[cs]e"),
    ("bsd-3-clause", 3, .9, "bsd", "(?:new|revised|modified) bsd licen[cs]e"),
    ("bsd-4-clause", 3, .9, "bsd", "original bsd licen[cs]e"),
    ("0bsd", 3, .9, "bsd", "(?:zero clause|0) bsd"),
    ("bsd-patent", 3, .9, "patent", "bsd 2 clause plus patent licen[cs]e"),
    ("apache", 2, .6, "apache", "apache licen[cs]e"),
    ("apache", 2, .5, "apache", "apache software licen[cs]e"),
    ("apache-2.0", 4, 1., "apache", "licensed under the apache licen[cs]e version 2 0"),
    ("apache-2.0", 4, .95, "apache", "www apache org licenses license 2 0"),
    ("gpl", 1, .5, "general", "general public license"),
    ("gpl", 2, .6, "gnu", "gnu general public licen[cs]e"),
    ("gpl", 2, .5, "gnu", "gnu gpl"),
    ("gpl", 4, .9, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", 2, .6, "gnu", "gnu (?:lesser|library) general public licen[cs]e"),
    ("lgpl", 2, .5, "lgpl", "gnu lgpl"),
    ("agpl", 2, .6, "affero", "gnu? affero general public licen[cs]e"),
    ("gfdl", 2, .7, "documentation", "gnu free documentation licen[cs]e"),
    ("gpl-classpath-exception", 3, .8, "exception", "classpath exception"),
    ("gpl-font-exception", 3, .8, "exception", "gpl font exception"),
    ("gpl-linking-exception", 3, .8, "exception", "(?:linking|runtime library|bison|autoconf) exception"),
    ("copyleft", 1, .4, "copyleft", "copyleft"),
    ("cc-by", 1, .5, "cc", "cc by"),
    ("cc-by", 2, .6, "commons", "creative commons attribution licen[cs]e"),
    ("cc", 1, .4, "commons", "creative commons"),
    ("cc0-1.0", 3, .9, "cc0", "cc0 1 0"),
    ("cc0-1.0", 2, .7, "cc0", "cc0"),
    ("cc0-1.0", 3, .9, "commons", "creative commons zero"),
    ("cc0-1.0", 4, .95, "domain", "cc0 1 0 universal public domain dedication"),
    ("cc-pd", 3, .8, "domain", "creative commons public domain mark"),
    ("cc-by", 3, .8, "creativecommons", "creativecommons org licenses by"),
    ("cc0-1.0", 3, .9, "creativecommons", "creativecommons org publicdomain zero"),
    ("public-domain", 2, .6, "domain", "(?:in|into|to) the public domain"),
    ("public-domain", 3, .8, "domain", "released into the public domain"),
    ("public-domain", 3, .8, "domain", "dedicated to the public domain"),
    ("unlicense", 3, .9, "unlicense", "the? unlicense"),
    ("unlicense", 4, 1., "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 3, .9, "wtfpl", "wtfpl"),
    ("wtfpl", 4, .95, "public", "do what the [a-z]+ you want to public license"),
    ("mpl", 2, .6, "mozilla", "mozilla public licen[cs]e"),
    ("mpl-2.0", 4, 1., "mozilla", "subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("epl", 2, .6, "eclipse", "eclipse public licen[cs]e"),
    ("edl-1.0", 3, .8, "eclipse", "eclipse distribution licen[cs]e"),
    ("cddl", 2, .6, "distribution", "common development and distribution licen[cs]e"),
    ("cpl-1.0", 3, .8, "common", "common public licen[cs]e"),
    ("ibmpl-1.0", 3, .8, "ibm", "ibm public licen[cs]e"),
    ("eupl", 2, .6, "european", "european union public licen[cs]e"),
    ("osl", 2, .6, "software", "open software licen[cs]e"),
    ("afl", 2, .6, "academic", "academic free licen[cs]e"),
    ("artistic", 2, .6, "artistic", "artistic licen[cs]e"),
    ("perl", 3, .8, "perl", "same terms as perl itself"),
    ("python", 3, .8, "python", "python software foundation licen[cs]e"),
    ("python", 2, .6, "psf", "psf licen[cs]e"),
    ("php-3.01", 3, .9, "php", "php licen[cs]e version 3 01"),
    ("php", 2, .6, "php", "php licen[cs]e"),
    ("ruby", 2, .6, "ruby", "ruby licen[cs]e"),
    ("zlib", 3, .9, "zlib", "zlib libpng? licen[cs]e"),
    ("zlib", 4, .95, "provided", "provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("libpng", 3, .9, "libpng", "libpng licen[cs]e"),
    ("bsl-1.0", 3, .9, "boost", "boost software licen[cs]e"),
    ("busl-1.1", 3, .9, "business", "business source licen[cs]e"),
    ("sspl-1.0", 3, .9, "server", "server side public licen[cs]e"),
    ("elastic", 2, .7, "elastic", "elastic licen[cs]e"),
    ("ofl-1.1", 3, .9, "font", "sil open font licen[cs]e"),
    ("ofl-1.1", 2, .7, "font", "open font licen[cs]e"),
    ("ncsa", 3, .9, "illinois", "university of illinois ncsa open source licen[cs]e"),
    ("ncsa", 2, .7, "ncsa", "ncsa licen[cs]e"),
    ("ms-pl", 3, .8, "microsoft", "microsoft public licen[cs]e"),
    ("ms-rl", 3, .8, "microsoft", "microsoft reciprocal licen[cs]e"),
    ("apsl-2.0", 3, .8, "apple", "apple public source licen[cs]e"),
    ("nposl-3.0", 3, .8, "profit", "non profit open software licen[cs]e"),
    ("qpl-1.0", 3, .8, "public", "q public licen[cs]e"),
    ("sleepycat", 3, .8, "sleepycat", "sleepycat licen[cs]e"),
    ("openssl", 3, .9, "openssl", "openssl licen[cs]e"),
    ("ssleay", 3, .8, "ssleay", "ssleay licen[cs]e"),
    ("x11", 3, .8, "x11", "x11 licen[cs]e"),
    ("curl", 2, .7, "curl", "curl licen[cs]e"),
    ("icu", 2, .7, "icu", "icu licen[cs]e"),
    ("unicode", 2, .7, "unicode", "unicode licen[cs]e"),
    ("w3c", 3, .8, "w3c", "w3c software notice? and? licen[cs]e"),
    ("vim", 3, .8, "vim", "vim licen[cs]e"),
    ("beerware", 3, .8, "beer", "beer ware licen[cs]e"),
    ("beerware", 4, .9, "beer", "you can buy me a beer in return"),
    ("json", 4, .95, "evil", "shall be used for good not evil"),
    ("upl-1.0", 3, .8, "universal", "universal permissive licen[cs]e"),
    ("postgresql", 3, .9, "postgresql", "postgresql licen[cs]e"),
    ("naist", 3, .8, "naist", "naist licen[cs]e"),
    ("tcl", 3, .7, "tcl", "tcl tk licen[cs]e"),
    ("hpnd", 3, .8, "historical", "historical permission notice and disclaimer"),
    ("odbl-1.0", 3, .9, "database", "open database licen[cs]e"),
    ("odc-by-1.0", 3, .9, "commons", "open data commons attribution licen[cs]e"),
    ("pddl-1.0", 3, .9, "commons", "open data commons public domain dedication"),
    ("ogl", 2, .7, "government", "open government licen[cs]e"),
    ("cecill", 2, .7, "cecill", "cecill [bc]?"),
    ("ecl-2.0", 3, .8, "educational", "educational community licen[cs]e"),
    ("mulan-2", 3, .8, "mulan", "mulan (?:psl|permissive software licen[cs]e)"),
    ("blueoak-1.0.0", 3, .9, "oak", "blue oak model licen[cs]e"),
    ("polyform", 2, .7, "polyform", "polyform (?:noncommercial|shield|strict|small|free)"),
    ("commons-clause", 3, .8, "clause", "commons clause"),
    ("openrail", 2, .7, "openrail", "openrail m?"),
    ("openrail", 2, .7, "open", "open rail m?"),
    ("llama", 2, .7, "community", "llama [0-9]? community licen[cs]e"),
    ("proprietary", 1, .4, "proprietary", "proprietary and confidential"),
    ("proprietary", 1, .4, "unauthorized", "unauthorized copying of this file"),
    ("proprietary", 2, .5, "agreement", "end user licen[cs]e agreement"),
    ("proprietary", 1, .4, "reproduc", "no part of this (?:publication|book|work) may be reproduced"),
    ("proprietary", 1, .4, "permission", "used with permission"),
    ("as-is", 1, .3, "provided", "provided as is without warrant(?:y|ies)"),
    ("noncommercial", 1, .4, "non", "for non ?commercial use only"),
    ("noncommercial", 1, .4, "noncommercial", "noncommercial use only"),
    ("attribution", 1, .3, "attribution", "attribution required"),
    ("royalty-free", 1, .3, "royalty", "royalty free licen[cs]e"),
    ("dual", 1, .3, "dual", "dual licensed under"),
    ("spdx", 1, .4, "spdx", "spdx license identifier [^ ]+"),
]

#: Names and versions from which families are built.
GNU = [("gpl", "", ("1", "2", "3")), ("lgpl", "(?:lesser|library)", ("2", "2 1", "3")), ("agpl", "affero", ("1", "3")),
       ("gfdl", None, ("1 1", "1 2", "1 3"))]
CREATIVE = [("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"),
            ("by-nd", "attribution no ?deriv[a-z]+"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
            ("by-nc-nd", "attribution non ?commercial no ?deriv[a-z]+")]
CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
VERSIONED = [("apache", "apache", "apache software? licen[cs]e", ("1 0", "1 1", "2 0")),
             ("mpl", "mozilla", "mozilla public licen[cs]e", ("1 0", "1 1", "2 0")),
             ("epl", "eclipse", "eclipse public licen[cs]e", ("1 0", "2 0")),
             ("eupl", "european", "european union public licen[cs]e", ("1 0", "1 1", "1 2")),
             ("osl", "software", "open software licen[cs]e", ("1 0", "2 0", "2 1", "3 0")),
             ("afl", "academic", "academic free licen[cs]e", ("1 1", "1 2", "2 0", "2 1", "3 0")),
             ("artistic", "artistic", "artistic licen[cs]e", ("1 0", "2 0")),
             ("cddl", "distribution", "common development and distribution licen[cs]e", ("1 0", "1 1")),
             ("ogl", "government", "open government licen[cs]e", ("1 0", "2 0", "3 0"))]
SHORT = [("gpl", ("1", "2", "3")), ("lgpl", ("2", "2 1", "3")), ("agpl", ("1", "3")), ("mpl", ("1 1", "2 0")),
         ("epl", ("1 0", "2 0")), ("eupl", ("1 1", "1 2")), ("apache", ("1 1", "2 0")), ("osl", ("3 0",)), ("afl", ("3 0",))]


#: The first prefilter.
ROOTS = ("licen", "copy", "copies", "reserved", "permission", "redistribut", "commons", "domain", "general", "public", "cc",
         "gpl", "bsd", "mpl", "epl", "eupl", "apache", "osl", "afl", "unlicense", "wtfpl", "exception", "polyform",
         "commercial", "proprietary", "cecill", "rail", "agreement", "advertising", "endorse", "evil", "beer", "perl",
         "attribution", "provided", "reproduced", "psl", "historical", "mulan")


def _dotted(version: str) -> str:
    return version.replace(" ", ".") if " " in version else version + ".0"


def rules() -> list[tuple[str, int, float, str, str]]:
    """All rules in order: of two equal detections the earlier rule stays."""
    out = list(PLAIN)
    for name, kind, versions in GNU:
        for v in versions:
            title = "gnu? free documentation licen[cs]e" if kind is None else f"gnu? {kind + ' ' if kind else ''}general public licen[cs]e"
            keyword = "documentation" if kind is None else "general"
            out.append((f"{name}-{_dotted(v)}", 3, .9, keyword, f"{title} (?:version|v) {v}"))
            out.append((f"{name}-{_dotted(v)}-or-later", 4, .95, keyword,
                        f"{title} ..12 (?:version|v) {v} ..4 (?:or|any) (?:at your option|any)? later"))
    for name, title in CREATIVE:
        short = name.replace("-", " ")
        if name != "by":
            out.append((f"cc-{name}", 2, .7, "cc", f"cc {short}"))
            out.append((f"cc-{name}", 2, .7, "commons", f"creative commons {title}"))
        for v in CREATIVE_VERSIONS:
            out.append((f"cc-{name}-{_dotted(v)}", 3, .9, "cc", f"cc {short} {v}"))
            out.append((f"cc-{name}-{_dotted(v)}", 4, .95, "commons", f"creative commons {title} {v}"))
            out.append((f"cc-{name}-{_dotted(v)}", 4, .95, "creativecommons", f"creativecommons org licenses {short} {v}"))
    for name, keyword, title, versions in VERSIONED:
        for v in versions:
            out.append((f"{name}-{_dotted(v)}", 3, .9, keyword, f"{title} (?:version|v)? {v}"))
    for name, versions in SHORT:
        for v in versions:
            out.append((f"{name}-{_dotted(v)}", 3, .8, name, f"{name} (?:version|v)? {v}"))
            out.append((f"{name}-{_dotted(v)}", 3, .8, name, f"{name}v{v}"))
            out.append((f"{name}-{_dotted(v)}", 3, .8, "spdx", f"spdx license identifier {name} {_dotted(v).replace('.', ' ')}"))
    for n in (2, 3, 4):
        out.append((f"bsd-{n}-clause", 3, .9, "bsd", f"bsd {n} clause"))
        out.append((f"bsd-{n}-clause", 3, .9, "clause", f"{n} clause bsd"))
    return out


def regex(pattern: str) -> str:
    """The regular expression of a word pattern over words wrapped in single spaces (" a  b ")."""
    out, part = [], ""
    for piece in pattern.split(" "):
        part = f"{part} {piece}" if part else piece
        if part.count("(") > part.count(")"):
            continue  # a blank inside a group
        if part.startswith(".."):
            out.append(f"(?: [^ ]+ ){{0,{int(part[2:])}}}")
        elif part.endswith("?"):
            out.append(f"(?: {_word(part[:-1])} )?")
        elif part.startswith("?"):  # "share ?alike": together or apart
            last = out.pop()
            out.append(f"(?:{last[:-1]}{part[1:]} |{last} {part[1:]} )")
        else:
            out.append(f" {_word(part)} ")
        part = ""
    return "".join(out)


def _word(w: str) -> str:
    return w.replace(" ", "  ")
