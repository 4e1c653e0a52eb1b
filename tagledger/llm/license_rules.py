"""License signatures: names and grant texts, and the ordered rules made of them."""

from __future__ import annotations

import re
from dataclasses import dataclass

# The phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_L = "licen[cs]e"
_V = "(version|v)?"
# Signatures over words; a trailing ? marks a word that may be missing.  Longer names come first.
NAMES: list[tuple[str, str]] = [
    ("agpl-3.0", f"gnu? affero general public {_L} {_V} 3|v3 0?"),
    ("agpl-3.0", "agpl 3|v3|3\\.0 0?"),
    ("agpl-3.0", "agplv3"),
    ("agpl", f"gnu? affero general public {_L}"),
    ("lgpl-3.0", f"gnu? lesser general public {_L} {_V} 3|v3 0?"),
    ("lgpl-2.1", f"gnu? lesser general public {_L} {_V} 2|v2 1"),
    ("lgpl-2.0", f"gnu? library general public {_L} {_V} 2|v2 0?"),
    ("lgpl-3.0", "lgpl 3|v3 0?"),
    ("lgpl-3.0", "lgplv3"),
    ("lgpl-2.1", "lgpl 2|v2 1"),
    ("lgpl-2.1", "lgplv2 1?"),
    ("lgpl", f"gnu? lesser general public {_L}"),
    ("lgpl", f"gnu? library general public {_L}"),
    ("gpl-3.0", f"gnu? general public {_L} {_V} 3|v3 0?"),
    ("gpl-2.0", f"gnu? general public {_L} {_V} 2|v2 0?"),
    ("gpl-1.0", f"gnu? general public {_L} {_V} 1|v1 0?"),
    ("gpl-3.0", "gpl 3|v3 0?"),
    ("gpl-3.0", "gplv3"),
    ("gpl-2.0", "gpl 2|v2 0?"),
    ("gpl-2.0", "gplv2"),
    ("gpl", f"gnu? general public {_L}"),
    ("gpl", "gnu gpl"),
    ("gfdl", f"gnu? free documentation {_L}"),
    ("apache-2.0", f"apache software? {_L}? {_V} 2|v2 0?"),
    ("apache-1.1", f"apache software? {_L}? {_V} 1|v1 1"),
    ("apache-2.0", "apache2"),
    ("apache", f"apache software? {_L}"),
    ("mit-0", f"mit no attribution {_L}?"),
    ("mit", f"mit x11? {_L}"),
    ("mit", f"expat {_L}"),
    ("x11", f"x11 {_L}"),
    ("bsd-4-clause", f"bsd 4|four clause {_L}?"),
    ("bsd-3-clause", f"bsd 3|three clause {_L}?"),
    ("bsd-2-clause", f"bsd 2|two clause {_L}?"),
    ("bsd-3-clause", f"(new|modified|revised) bsd {_L}?"),
    ("bsd-2-clause", f"(simplified|freebsd) bsd {_L}?"),
    ("0bsd", f"zero clause bsd {_L}?"),
    ("0bsd", "0bsd"),
    ("bsd", f"bsd style? {_L}"),
    ("isc", f"isc {_L}"),
    ("zlib", f"zlib libpng? {_L}"),
    ("boost-1.0", f"boost software {_L} {_V} 1? 0?"),
    ("mpl-2.0", f"mozilla public {_L} {_V} 2|v2 0?"),
    ("mpl-1.1", f"mozilla public {_L} {_V} 1|v1 1"),
    ("mpl", f"mozilla public {_L}"),
    ("epl-2.0", f"eclipse public {_L} {_V} 2|v2 0?"),
    ("epl-1.0", f"eclipse public {_L} {_V} 1|v1 0?"),
    ("epl", f"eclipse public {_L}"),
    ("eupl", f"european union public {_L}"),
    ("cddl", f"common development and distribution {_L}"),
    ("cpl-1.0", f"common public {_L}"),
    ("artistic-2.0", f"artistic {_L} {_V} 2 0?"),
    ("artistic", f"artistic {_L}"),
    ("postgresql", f"postgresql {_L}"),
    ("python-2.0", f"python software foundation {_L}"),
    ("php", f"php {_L}"),
    ("ruby", f"ruby {_L}"),
    ("unlicense", "unlicense"),
    ("wtfpl", "wtfpl"),
    ("ofl-1.1", f"sil? open font {_L}"),
    ("odbl", f"open database {_L}"),
    ("odc-by", f"open data commons attribution {_L}"),
    ("pddl", "public domain dedication and"),
    ("cc0-1.0", "creative commons zero"),
    ("cc0-1.0", "cc0"),
    ("cc-by-nc-sa", "cc by nc sa 1|2|3|4? 0|5?"),
    ("cc-by-nc-nd", "cc by nc nd 1|2|3|4? 0|5?"),
    ("cc-by-nc", "cc by nc 1|2|3|4? 0|5?"),
    ("cc-by-sa", "cc by sa 1|2|3|4? 0|5?"),
    ("cc-by-nd", "cc by nd 1|2|3|4? 0|5?"),
    ("cc-by", "cc by 1|2|3|4? 0|5?"),
    ("cc-by-nc-sa", "creative commons attribution non? (commercial|noncommercial) share? (alike|sharealike)"),
    ("cc-by-nc-nd", "creative commons attribution non? (commercial|noncommercial) no? (derivatives|noderivatives|derivs)"),
    ("cc-by-nc", "creative commons attribution non? (commercial|noncommercial)"),
    ("cc-by-sa", "creative commons attribution share? (alike|sharealike)"),
    ("cc-by-nd", "creative commons attribution no? (derivatives|noderivatives|derivs)"),
    ("cc-by", "creative commons attribution"),
    ("cc", "creative commons"),
    ("public-domain", "public domain"),
    ("proprietary", f"proprietary {_L}"),
    ("commercial", f"commercial {_L}"),
    ("ms-pl", f"microsoft public {_L}"),
    ("openssl", f"openssl {_L}"),
]
_GRANT = "(licensed|released|distributed|published|available|provided|covered|used) under the? (terms|conditions)? of? the?"
_SPDX = f"spdx {_L} identifier"
# A name counts for more where the words around it grant something, and for nothing where they deny it.
CONTEXTS: list[tuple[float, str]] = [
    (1.0, f"{_SPDX} {{}}"),
    (0.95, f"{_GRANT} {{}}"),
    (0.8, "{}"),
]
DENIED: list[str] = [f"not {_GRANT} {{}}", "not the? {}"]
# Short names, which mean a license only behind words that say so.
SHORT: list[tuple[str, str]] = [
    ("mit-0", "mit 0"),
    ("mit", "mit"),
    ("isc", "isc"),
    ("zlib", "zlib"),
    ("x11", "x11"),
    ("ncsa", "ncsa"),
    ("mpl-2.0", "mpl 2|v2 0?"),
    ("mpl-1.1", "mpl 1|v1 1"),
    ("mpl", "mpl"),
    ("mpl", "mozilla"),
    ("epl-2.0", "epl 2|v2 0?"),
    ("epl-1.0", "epl 1|v1 0?"),
    ("epl", "epl"),
    ("epl", "eclipse"),
    ("eupl", "eupl 1? 1|2?"),
    ("cddl", "cddl 1? 0|1?"),
    ("cpl-1.0", "cpl 1 0"),
    ("bsl-1.0", "bsl 1 0"),
    ("boost-1.0", "boost 1 0"),
    ("apache-2.0", "apache 2|v2 0?"),
    ("apache-1.1", "apache 1|v1 1"),
    ("apache", "apache"),
    ("asl-2.0", "asl 2|v2 0?"),
    ("agpl", "agpl"),
    ("lgpl", "lgpl"),
    ("gpl", "gpl"),
    ("gpl", "gnu"),
    ("bsd-3-clause", "bsd 3"),
    ("bsd-2-clause", "bsd 2"),
    ("bsd", "bsd"),
    ("artistic-2.0", "artistic 2|v2 0?"),
    ("artistic", "artistic"),
    ("ofl-1.1", "ofl 1 1"),
    ("ms-pl", "ms pl"),
    ("ms-rl", "ms rl"),
    ("postgresql", "postgresql"),
    ("python-2.0", "psf 2? 0?"),
    ("afl-3.0", "afl 3 0"),
    ("osl-3.0", "osl 3 0"),
    ("upl-1.0", "upl 1 0"),
    ("vim", "vim"),
    ("w3c", "w3c"),
    ("icu", "icu"),
    ("ijg", "ijg"),
    ("libpng", "libpng 2? 0?"),
    ("curl", "curl"),
    ("openssl", "openssl"),
    ("odbl", "odbl 1? 0?"),
]
# Words of the licenses' own texts and of notices.
TEXTS: list[tuple[float, str, str]] = [
    (0.9, "mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    (0.9, "isc", "permission to use copy modify and or? distribute this software for any purpose"),
    (0.9, "bsd", "redistribution and use in source and binary forms with or without modification"),
    (0.9, "bsd-4-clause", "all advertising materials mentioning features or use of this software"),
    (0.9, "bsd-3-clause", "neither the name of .{0,80} nor the names of its contributors"),
    (0.9, "zlib", "this software is provided as is without any express or implied warranty"),
    (0.9, "boost-1.0", "permission is hereby granted free of charge to any person or organization"),
    (0.9, "unlicense", "this is free and unencumbered software released into the public domain"),
    (0.9, "wtfpl", "do what the fuck you want to public license"),
    (0.9, "gpl", "this program is free software you can redistribute it and or? modify it"),
    (0.7, "warranty", "without warranty of any kind"),
    (0.7, "warranty", "without warranties or conditions of any kind"),
    (0.7, "notice", "see the license for the specific language governing permissions"),
    (0.7, "notice", "you may not use this file except in compliance with"),
    (0.6, "reserved", "all rights reserved"),
    (0.6, "reserved", "alle rechte vorbehalten"),
    (0.6, "reserved", "tous droits réservés"),
    (0.6, "reserved", "todos los derechos reservados"),
    (0.5, "copyright", "copyright c? (19|20)[0-9][0-9]"),
    (0.5, "copyright", "copyrighted by"),
]


def words_pattern(spec: str) -> str:
    """Regular expression of a signature, over text that has a blank on both sides of every word."""
    out = []
    for word in spec.split(" "):
        if word.startswith(".{"):
            out.append(word.replace(".", "[^\\x01]"))
            continue
        single = f" (?:{word.removesuffix('?')}) "
        out.append(f"(?:{single})?" if word.endswith("?") else single)
    return "".join(out)


def keyword(spec: str) -> str:
    """The longest word that every match holds."""
    return max((w for w in spec.split(" ") if re.fullmatch(r"[^\W_]+", w)), key=len)


@dataclass(frozen=True)
class Rule:
    """A signature; it is looked for in texts that hold ``keyword`` and, if there is one, ``also``."""

    label: str
    keyword: str
    pattern: str
    score: float
    priority: float
    also: str = ""


def ordered_rules() -> list[Rule]:
    """All rules, the one with the highest priority first."""
    rules = [
        Rule(label, keyword(name), words_pattern(context.format(name)), score, score)
        for score, context in CONTEXTS
        for label, name in NAMES
    ]
    rules += [
        Rule("denied", keyword(name), words_pattern(context.format(name)), 0.2, 1.1, "not")
        for context in DENIED
        for _, name in NAMES
    ]
    # Behind the full names of the same context, so that these find what they can first.
    rules += [
        Rule(label, name.split(" ")[0], words_pattern(f"{context} {name}"), score, score - 0.01, also)
        for score, context, also in ((1.0, _SPDX, "spdx"), (0.95, _GRANT, "under"))
        for label, name in SHORT
    ]
    rules += [Rule(label, keyword(text), words_pattern(text), score, score) for score, label, text in TEXTS]
    return sorted(rules, key=lambda r: -r.priority)
