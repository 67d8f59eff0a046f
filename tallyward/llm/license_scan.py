"""License scan by sentence rules.

A text is cut into sentences; each is normalised (comment marks and list numbers off, lower case,
quotes and gaps made plain) and looked up among known licence sentences, which
gives its identifier.  Sentences that refer to licences by name, in prose or by
their short identifiers, give a ``=NAME`` identifier for each licence named.  The
sequence of identifiers is then matched against an ordered table of licence
rules: a rule names the identifiers it needs, in that order and next to each other, and
takes them away, so that a text under several licences yields all of them.  What
is left of known identifiers is reported as ``UNKNOWN`` once, so an incomplete
licence text is not lost.

Every sentence is normalised and looked up by its first words, so that cost does not grow with the table.

Defined results: a null or empty text has no sentences and no licences.  A licence
is named once per document, in order of its first sentence and then by name.  Repeated rows repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ._shared import lacking, mapped

# Licence sentences in normalised form, as patterns that a sentence must begin
# with, by the identifier each stands for; "(v)" is where a version stands.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("MITgrant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MITnotice", r"the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all"),
    ("X11names", r"except as contained in this notice, the names? of"),
    ("JSONgood", r"the software shall be used for good, not evil"),
    ("BSLgrant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("BSLnotice", r"the copyright notices in the software and this entire statement"),
    ("ASIS", r"(?:the|this) (?:software|work|font software) is provided (?:by .*)?[\"']{0,2}as[ -]is\b"),
    ("NOLIABILITY", r"in no event (?:shall|will) .*\bliable\b"),
    ("APACHEuse", r"you may not use this file except in compliance with the licen[sc]e"),
    ("APACHEcopy", r"you may obtain a copy of the licen[sc]e at"),
    ("APACHEwarranty", r"unless required by applicable law or agreed to in writing, (?:software|licensor)"),
    ("APACHEsee", r"see the licen[sc]e for the specific language governing permissions"),
    ("APACHEtitle(v)", r"apache license,? version (?P<v>[0-9.]+[0-9]),? january 2004"),
    ("GNUgrant", r"(?:this|the) [\w ]+ is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu "),
    ("GNUwarranty", r"(?:this|the) [\w ]+ is distributed in the hope that it will be useful"),
    ("GNUsee", r"see the gnu (?:lesser |library |affero )?general public licen[sc]e for more details"),
    ("GNUcopy", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[sc]e"),
    ("GNUifnot", r"if not, (?:see|write to)\b.*(?:gnu\.org|free software foundation)"),
    ("GPLtitle(v)", r"gnu general public licen[sc]e version (?P<v>[0-9.]*[0-9]),? (?:29 june 2007|june 1991)"),
    ("LGPLtitle(v)", r"gnu (?:lesser|library) general public licen[sc]e version (?P<v>[0-9.]*[0-9]),? (?:29 june 2007|february 1999|june 1991)"),
    ("AGPLtitle(v)", r"gnu affero general public licen[sc]e version (?P<v>[0-9.]*[0-9]),? 19 november 2007"),
    ("PERLterms", r"this [\w ]+ is free software[:;,] you can redistribute it and/or modify it under the same terms as (?:the )?perl"),
    ("MPLcopy", r"if a copy of the mpl was not distributed with this file, you can obtain one at"),
    ("MPLtitle(v)", r"mozilla public licen[sc]e version (?P<v>[0-9.]+[0-9])$"),
    ("EPLtitle(v)", r"eclipse public licen[sc]e -? ?v ?(?P<v>[0-9.]+[0-9])$"),
    ("CDDLtitle(v)", r"common development and distribution licen[sc]e \(cddl\) version (?P<v>[0-9.]+[0-9])"),
    ("BSDgrant", r"redistribution and use in source and binary forms,? with or without modification, are permitted"),
    ("BSDsource", r"redistributions? of source code must retain the above copyright"),
    ("BSDbinary", r"redistributions? in binary form must reproduce the above copyright"),
    ("BSDads", r"all advertising materials mentioning features or use of this software must display"),
    ("BSDnames", r"(?:neither the names? of|the names? of) .*may (?:not )?be used to endorse or promote products derived from this software"),
    ("ISCgrant", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that"),
    ("0BSDgrant", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted$"),
    ("PGgrant", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("HPNDgrant", r"permission to use, copy, modify,? (?:and )?distribute(?:,? and sell)? this software and its documentation for any purpose .*is hereby granted"),
    ("ZLIBgrant", r"permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("ZLIBorigin", r"the origin of this software must not be misrepresented"),
    ("ZLIBaltered", r"altered source versions must be plainly marked as such"),
    ("ZLIBnotice", r"this notice may not be removed or altered from any source distribution"),
    ("UNLICENSE", r"this is free and unencumbered software released into the public domain"),
    ("UNLanyone", r"anyone is free to copy, modify, publish, use, compile, sell,? or distribute this software"),
    ("WTFPLtitle", r"do what the fuck you want to public licen[sc]e"),
    ("WTFPLcopy", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed"),
    ("BEERWARE", r"[\"']?the beer-?ware licen[sc]e[\"']? \(revision 42\)"),
    ("OFLterms", r"this font software is licensed under the sil open font licen[sc]e"),
    ("OPENSSL", r"this product includes (?:software|cryptographic software) (?:developed|written) by (?:the openssl project|eric young)"),
    ("CC0terms", r"(?:to the extent possible under law, .*has waived all copyright|the person who associated a work with this deed has dedicated)"),
    ("PSFgrant", r"this license agreement is between the python software foundation"),
)

# Names by which texts refer to licences, and the licence; "{v}" takes the version.  The first that matches counts.
NAMES: tuple[tuple[str, str], ...] = (
    ("{gnu}", r"(?:the )?(?:gnu )?(?P<gnu>affero general public licen[sc]e|(?:lesser|library) general public licen[sc]e|general public licen[sc]e|agpl|lgpl|gpl)"
              r"(?: \((?:gnu )?[al]?gpl\))?(?: as published by the free software foundation)?"
              r"(?:(?:[;, -]+(?:either )?(?:version |v\.? ?)?|v|, version )(?P<v>[0-9](?:\.[0-9])?)(?:\.0)?(?: of the licen[sc]e)?)?(?P<later>\+|-or-later|,? or (?:\(at your option\) )?any later|,? or (?:newer|later))?"),
    ("Apache-{v}", r"apache(?: software)?(?:[ -]licen[sc]e)?(?:[, -]*(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]|[0-9]))(?: licen[sc]e)?"),
    ("BSD-3-Clause", r"(?:bsd[ -]3[ -]clause|3[ -]clause bsd|three[ -]clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?"),
    ("BSD-2-Clause", r"(?:bsd[ -]2[ -]clause|2[ -]clause bsd|two[ -]clause bsd|simplified bsd|freebsd licen[sc]e)(?: licen[sc]e)?"),
    ("BSD-4-Clause", r"(?:bsd[ -]4[ -]clause|4[ -]clause bsd|original bsd)(?: licen[sc]e)?"),
    ("0BSD", r"(?:0bsd|zero[ -]clause bsd)(?: licen[sc]e)?"),
    ("MIT-0", r"mit(?: no attribution|-0)(?: licen[sc]e)?"),
    ("MIT", r"(?:mit|expat)(?: licen[sc]e|/x11)?\b(?!-)"),
    ("ISC", r"isc licen[sc]e"),
    ("MPL-{v}", r"(?:mozilla public licen[sc]e|mpl)(?:[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]))"),
    ("EPL-{v}", r"(?:eclipse public licen[sc]e|epl)(?:[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]))"),
    ("EUPL-{v}", r"(?:european union public licen[sc]e|eupl)(?: \(eupl\))?(?:[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]))"),
    ("CDDL-{v}", r"(?:common development and distribution licen[sc]e|cddl)(?:,? \(?(?:the )?[\"']?(?:license|cddl)[\"']?\)?)?(?:[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]))?"),
    ("Artistic-{v}", r"artistic(?: licen[sc]e)?[, -]*(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9])"),
    ("Artistic-1.0", r"artistic licen[sc]e"),
    ("BSL-1.0", r"(?:boost software licen[sc]e(?:[, -]+(?:version |v\.? ?)?1\.0)?|bsl-1\.0)"),
    ("Zlib", r"(?:zlib(?:/libpng)? licen[sc]e|zlib)"),
    ("OFL-{v}", r"(?:sil open font licen[sc]e|ofl)(?:[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]))?"),
    ("ZPL-{v}", r"(?:zope public licen[sc]e|zpl)(?: \(zpl\))?[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9])"),
    ("PSF-2.0", r"(?:python software foundation licen[sc]e|psf licen[sc]e|psf-2\.0)(?:[, -]+(?:version |v\.? ?)?2(?:\.0)?)?"),
    ("AFL-{v}", r"(?:academic free licen[sc]e|afl)(?: \(afl\))?[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9])"),
    ("OSL-{v}", r"(?:open software licen[sc]e|osl)(?: \(osl\))?[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9])"),
    ("MS-PL", r"(?:microsoft public licen[sc]e|ms-pl)"),
    ("MS-RL", r"(?:microsoft reciprocal licen[sc]e|ms-rl)"),
    ("PostgreSQL", r"postgresql licen[sc]e"),
    ("X11", r"x11 licen[sc]e"),
    ("CECILL-{v}", r"cecill(?: licen[sc]e)?[, -]+(?:version |v\.? ?)?(?P<v>[0-9]\.[0-9]|b\b|c\b)"),
    ("SSPL-1.0", r"(?:server side public licen[sc]e|sspl)(?: \(sspl\))?(?:[, -]+(?:version |v\.? ?)?1(?:\.0)?)?"),
    ("BUSL-1.1", r"(?:business source licen[sc]e|busl)(?: \(b[u]?sl\))?(?:[, -]+(?:version |v\.? ?)?1\.1)?"),
    ("Elastic-2.0", r"elastic licen[sc]e(?:[, -]+(?:version |v\.? ?)?2(?:\.0)?)?|elastic-2\.0"),
    ("UPL-1.0", r"(?:universal permissive licen[sc]e|upl)(?: \(upl\))?(?:[, -]+(?:version |v\.? ?)?1(?:\.0)?)?"),
    ("Unlicense", r"unlicense"),
    ("WTFPL", r"wtfpl"),
    ("CC0-1.0", r"(?:cc0|creative commons (?:zero|cc0))(?:[ -]1\.0)?(?: universal)?"),
    ("CC-{cc}-{v}", r"(?:cc|creative commons)[ -](?P<cc>by(?:-nc)?(?:-sa|-nd)?|attribution(?:[ -]?non-?commercial)?(?:[ -]?(?:share-?alike|no ?-?derivatives|noderivs))?)(?: licen[sc]e)?[ ,-]+(?:version |v)?(?P<v>[0-9]\.[0-9])"),
)

#: Rules in order: the licence ("{v}" takes the first sentence's version) and the identifiers that make it up; one
#: that ends in "?" may be missing, "|" stands between alternatives.  Longer sequences come before their beginnings.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("JSON", ("MITgrant", "MITnotice", "JSONgood", "ASIS?", "NOLIABILITY?")),
    ("X11", ("MITgrant", "MITnotice", "ASIS?", "NOLIABILITY?", "X11names")),
    ("MIT", ("=MIT?", "MITgrant", "MITnotice", "ASIS?", "NOLIABILITY?")),
    ("MIT-0", ("=MIT-0?", "MITgrant", "ASIS", "NOLIABILITY?")),
    ("BSL-1.0", ("=BSL-1.0?", "BSLgrant", "BSLnotice?", "ASIS?", "NOLIABILITY?")),
    ("Apache-{v}", ("APACHEtitle(v)", "APACHEwarranty?", "=Apache?", "APACHEuse?", "APACHEcopy?", "APACHEwarranty?", "APACHEsee?")),
    ("{n}", ("=Apache", "APACHEuse?", "APACHEcopy?", "APACHEwarranty?", "APACHEsee?")),
    ("GPL-{v}", ("GPLtitle(v)", "=GNU?", "GNUgrant?", "GNUwarranty?", "GNUsee?", "GNUcopy?", "GNUifnot?")),
    ("LGPL-{v}", ("LGPLtitle(v)", "=GNU?", "GNUgrant?", "GNUwarranty?", "GNUsee?", "GNUcopy?", "GNUifnot?")),
    ("AGPL-{v}", ("AGPLtitle(v)", "=GNU?", "GNUgrant?", "GNUwarranty?", "GNUsee?", "GNUcopy?", "GNUifnot?")),
    ("{n}", ("=GNU", "GNUwarranty?", "GNUsee?", "GNUcopy?", "GNUifnot?")),
    ("Artistic-1.0-Perl,GPL-1.0-or-later", ("PERLterms", "GNUwarranty?")),
    ("MPL-{v}", ("MPLtitle(v)", "=MPL?", "MPLcopy?")),
    ("{n}", ("=MPL", "MPLcopy?", "APACHEuse?", "APACHEcopy?")),
    ("{n}", ("=CDDL|=EUPL|=EPL", "APACHEuse?", "APACHEcopy?", "APACHEwarranty?", "APACHEsee?")),
    ("EPL-{v}", ("EPLtitle(v)", "=EPL?")),
    ("CDDL-{v}", ("CDDLtitle(v)",)),
    ("BSD-4-Clause", ("=BSD?", "BSDgrant", "BSDsource", "BSDbinary", "BSDads", "BSDnames?", "ASIS?", "NOLIABILITY?")),
    ("BSD-3-Clause", ("=BSD?", "BSDgrant", "BSDsource", "BSDbinary", "BSDnames", "ASIS?", "NOLIABILITY?")),
    ("BSD-2-Clause", ("=BSD?", "BSDgrant", "BSDsource", "BSDbinary", "ASIS?", "NOLIABILITY?")),
    ("ISC", ("=ISC?", "ISCgrant", "ASIS?", "NOLIABILITY?")),
    ("0BSD", ("=0BSD?", "0BSDgrant", "ASIS?", "NOLIABILITY?")),
    ("PostgreSQL", ("=PostgreSQL?", "PGgrant", "NOLIABILITY?")),
    ("HPND", ("HPNDgrant", "ASIS?", "NOLIABILITY?")),
    ("Zlib", ("=Zlib?", "ASIS?", "NOLIABILITY?", "ZLIBgrant", "ZLIBorigin?", "ZLIBaltered?", "ZLIBnotice?")),
    ("Unlicense", ("UNLICENSE", "UNLanyone?", "ASIS?", "NOLIABILITY?")),
    ("WTFPL", ("WTFPLtitle", "WTFPLcopy?", "WTFPLtitle?")),
    ("Beerware", ("BEERWARE",)),
    ("OFL-1.1", ("OFLterms|=OFL", "OFLterms?", "ASIS?", "NOLIABILITY?")),
    ("OpenSSL", ("OPENSSL",)),
    ("CC0-1.0", ("CC0terms",)),
    ("PSF-2.0", ("PSFgrant",)),
)

_GNU = {"affero general public": "AGPL", "lesser general public": "LGPL", "library general public": "LGPL", "general public": "GPL", "agpl": "AGPL", "lgpl": "LGPL", "gpl": "GPL"}
_KNOWN = tuple((name, re.compile(pattern, re.DOTALL)) for name, pattern in SENTENCES)
_NAMED = tuple((name, re.compile(pattern)) for name, pattern in NAMES)
#: Beginnings of sentences that may stand behind a heading, or behind another sentence without a mark.
_INNER = re.compile(r"(?<= )(?:permission (?:is (?:hereby )?granted|to use)|redistribution and use in|(?:this|the) [\w ]{3,40} is free software|the above copyright notice and this permission)")
#: Words before a licence's name that make it a reference: the verb, or a field of metadata.
_UNDER = re.compile(
    r"\b(?:(?:dual-?|re-?)?licen[sc]ed|released|distributed|redistributed|available|provided|published|covered|(?:re)?distribute (?:it|this|them)|modify it|use is subject|subject|dedicated|governed|permitted|offered|shared)"
    r" (?:under|to|by) (?:either )?(?:both )?(?:of )?(?:the )?(?:terms (?:and conditions )?of )?(?:either )?(?:the |a |an )?(?:permissive |standard )?"
    r"|^licen[sc]e(?: ?:+ ?(?:osi approved ?:+ ?)?| )(?:under )?(?:the )?")
#: What follows a licence's name of one word without a version; "the MIT dome" names none.
_ALONE = re.compile(r" ?(?:$|[,.;:()/\]\"']|\n)| (?:licen[sc]es?|or|and|terms)\b|-(?:style|like|type)\b")
_WORDS = frozenset({"mit", "expat", "zlib"})
_LICENCE, _VERSION, _HEADING_END = re.compile(r"licen[sc]e"), re.compile(r"[0-9]"), re.compile(r"(?: licen[sc]e)?$")
#: Words before a name that make it a reference only if the name says that it is a licence.
_USES = re.compile(r"\b(?:uses?|using|with|has|have|is|adopts?|under) (?:the |an? )")
_SO_ON = re.compile(r" ?(?:\(the [\"'](?:licen[sc]e|[a-z0-9]+)[\"']\)|\([^()]{2,40}\)|licen[sc]e|international|unported)* ?(?:,|/|,? ?\bor\b|,? ?\band\b)(?: (?:the|under|terms|of|either|an?)\b)* ?")
_SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]+)", re.IGNORECASE)
_SPDX_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")
_SPDX_JOINTS = frozenset({"AND", "OR", "WITH"})
#: The case in which short identifiers are written.
_SHORT_NAMES = {x.lower(): x for x in (
    "0BSD", "AFL-3.0", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-1.0", "Artistic-1.0-Perl", "Artistic-2.0", "Beerware", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-4-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "CDDL-1.1", "CECILL-2.1", "EPL-1.0", "EPL-2.0",
    "EUPL-1.2", "GPL-1.0-or-later", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "HPND", "ISC", "JSON", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "MS-RL", "NCSA", "OFL-1.1", "OpenSSL", "OSL-3.0", "PHP-3.01",
    "PostgreSQL", "PSF-2.0", "Python-2.0", "Ruby", "Unlicense", "Vim", "W3C", "WTFPL", "X11", "Zlib", "ZPL-2.1")}

#: Sentences end at a stop, question or exclamation mark before a gap, at a colon before a line's end, at a blank line, or before a list's item.
_ENDS = re.compile(r"[.!?](?=[\s\"')\]]*(?:\s|$))|:(?=[ \t]*\n)|\n[ \t]*\n|\n(?=[ \t]*(?:\(?[0-9a-z]{1,2}[.)]|[-*•])\s)")
#: Stops that end no sentence; nor does one after a number with which a sentence begins, as in lists.
_SHORT = re.compile(r"(?:^|\s)(?:v|e\.g|i\.e|inc|ltd|no)$", re.IGNORECASE)
_NUMBER = re.compile(r"\s*[0-9]+")
_LISTED = re.compile(r"^(?:\(?[0-9a-z]{1,2}[.)]|[-*•]) ")
#: What begins a line of a comment.
_COMMENT = re.compile(r"^[ \t]*(?://+!?|/\*+!?|\*+/?|#+!?|--+|;+|%+|<!--|>+|dnl\b|rem\b|'(?= ))", re.MULTILINE | re.IGNORECASE)
#: The first word of a further line.
_LATER_LINE = re.compile(r"\n[^\S\n]*([^\s\"',]+)")
_QUOTES = str.maketrans({"“": '"', "”": '"', "„": '"', "‘": "'", "’": "'", "`": "'"})


def plain(text: str) -> str:
    """Lower case, plain quotes, and spaces for comment marks; every character keeps its place."""
    lowered = text.translate(_QUOTES).lower()
    if len(lowered) != len(text):
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text.translate(_QUOTES))
    return _COMMENT.sub(lambda m: " " * len(m[0]), lowered)


def normalise(sentence: str) -> str:
    """The form in which sentences are known."""
    bare = " ".join(sentence.split())
    return _LISTED.sub("", bare).strip(" .!?:;,*/#-\"'")


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Spans of sentences of a whole text."""
    start = 0
    for m in _ENDS.finditer(text):
        if m[0] == "." and (_SHORT.search(text, max(start, m.start() - 8), m.start()) or _NUMBER.fullmatch(text, start, m.start())):
            continue
        if m.end() - start > 1 or not text[start : m.end()].isspace():
            yield start, m.end()
        start = m.end()
    if start < len(text):
        yield start, len(text)


def _first_words() -> dict[str, tuple]:
    """Known sentences by each first word with which they can begin."""
    out: dict[str, list] = {}
    for name, pattern in _KNOWN:
        head = pattern.pattern
        words = head[3 : head.index(")")].split("|") if head.startswith("(?:") else [head]
        for word in words:
            first = re.split(r"[ ,\\\[?\"(]", word.removeprefix("[\"']?"))[0]
            out.setdefault(first, []).append((name, pattern))
    return {k: tuple(v) for k, v in out.items()}


_BY_WORD = _first_words()


def _written_out(name: str, m: re.Match) -> tuple[str, str]:
    """A licence named by a match of its pattern: (family, name)."""
    version = (m.groupdict().get("v") or "").strip(".").upper()
    if version.isdigit():
        version += ".0"
    if name == "{gnu}":
        family = _GNU[re.sub(r" licen[sc]e$", "", m["gnu"])]
        end = ("-or-later" if m["later"] else "-only") if version else ""
        return "=GNU", f"{family}-{version}{end}".rstrip("-")
    if name.startswith("CC-{cc}"):
        kind = m["cc"].upper()
        if kind.startswith("ATTRIBUTION"):
            rest = re.sub(r"[ -]", "", kind[11:])
            kind = "BY" + "-NC" * ("NONCOMMERCIAL" in rest) + "-SA" * ("SHAREALIKE" in rest) + "-ND" * ("NODERIV" in rest)
        return "=CC", f"CC-{kind}-{version}"
    full = name.replace("{v}", version or {"CDDL-{v}": "1.0", "OFL-{v}": "1.1"}.get(name, ""))
    return _family(full), full


def _family(name: str) -> str:
    """What rules call a licence's name: the first part of it, or all for names that rules tell apart."""
    if name in {"MIT", "MIT-0", "ISC", "0BSD", "PostgreSQL", "Zlib", "BSL-1.0"}:
        return f"={name}"
    head = name.split("-")[0]
    return "=GNU" if head in {"GPL", "LGPL", "AGPL"} else f"={head}"


def _named_at(sentence: str, at: int) -> tuple[str, str, int] | None:
    """``family, licence, end`` of the licence named at a place."""
    for name, pattern in _NAMED:
        m = pattern.match(sentence, at)
        if m and not (m.end() < len(sentence) and sentence[m.end() - 1].isalnum() and sentence[m.end()].isalnum()):
            if m[0] in _WORDS and not _ALONE.match(sentence, m.end()) and not _LICENCE.search(sentence, max(0, at - 25), at):
                return None
            return *_written_out(name, m), m.end()
    return None


def references(sentence: str) -> list[tuple[str, str]]:
    """``family, licence`` of all licences to which a normalised sentence refers, each once."""
    found: dict[tuple[str, str], None] = {}
    for m in _UNDER.finditer(sentence):
        at = m.end()
        while (hit := _named_at(sentence, at)) is not None:
            found[hit[:2]] = None
            more = _SO_ON.match(sentence, hit[2])
            if not more:
                break
            at = more.end()
    for m in _USES.finditer(sentence):
        if (hit := _named_at(sentence, m.end())) and _says_licence(sentence, m.end(), hit[2]):
            found[hit[:2]] = None
    at = 4 if sentence.startswith("the ") else 0
    if (hit := _named_at(sentence, at)) and _HEADING_END.match(sentence, hit[2]) and (_says_licence(sentence, at, hit[2]) or _VERSION.search(sentence, at, hit[2])):
        found[hit[:2]] = None
    return list(found)


def _says_licence(sentence: str, start: int, end: int) -> bool:
    """Whether the name at a place has the word licence in it, or right after it."""
    return bool(_LICENCE.search(sentence, start, end) or _LICENCE.match(sentence, end + sentence.startswith(" ", end)))


def _known_at(sentence: str, at: int = 0, until: int | None = None) -> list[tuple[str, str]]:
    """What is known of the sentence that begins at a place of ``sentence``, and goes no further than ``until``."""
    until = len(sentence) if until is None else until
    gap = sentence.find(" ", at, until)
    first = sentence[at : gap if gap >= 0 else until].strip("\"',")
    for name, pattern in _BY_WORD.get(first, ()):
        if m := pattern.match(sentence, at, until):
            if name == "GNUgrant":
                return references(sentence[at:until]) or [("GNUgrant", "")]
            return [(name, m["v"] if "(v)" in name else "")]
    return []


def look_up(sentence: str) -> list[tuple[str, str]]:
    """``identifier, version or licence`` of a normalised sentence, empty if it isn't known."""
    found, later, inner = _known_at(sentence), {}, []
    for m in reversed(list(_INNER.finditer(sentence))):  # no known sentence has its own beginning in it again
        inner.append((m.start(), later.get(m[0])))
        later[m[0]] = m.start()
    for at, until in reversed(inner):
        found += [x for x in _known_at(sentence, at, until) if x not in found]
    return found or references(sentence)


def identify(text: str) -> list[tuple[str, str, int, int]]:
    """``(identifier, version or licence, start, end)`` of the known sentences, in order."""
    found, tagged = [], []
    for m in _SPDX.finditer(text):
        tagged.append(m.span())
        for name in _SPDX_NAME.finditer(m[1]):
            if name[0].upper() not in _SPDX_JOINTS:
                full = _SHORT_NAMES.get(name[0].lower(), name[0])
                found.append((_family(full), full, m.start(1) + name.start(), m.start(1) + name.end()))
    low, done, parts = plain(text), 0, []
    for a, b in tagged:
        parts += [low[done:a], "\n" * (b - a)]
        done = b
    low = "".join([*parts, low[done:]])
    for start, end in sentences(low):
        known = look_up(normalise(low[start:end]))
        found += [(*k, start, end) for k in known]
        whole, read, place = None, start, 0
        for m in _LATER_LINE.finditer(low, start, end):  # headings and code lines end without a mark
            if m[1] in _BY_WORD:
                whole = " ".join(low[start:end].split()) if whole is None else whole
                place += sum(len(w) + 1 for w in low[read : m.start(1)].split())
                read = m.start(1)
                hits = _known_at(whole, place)
                found += [(*k, m.start(1), end) for k in hits if k not in known]
    return sorted(found, key=lambda x: x[2])


def _taken(left: list, at: int, needs: tuple[str, ...]) -> list[int] | None:
    """Places of the identifiers that a rule takes from ``at`` on, None if it doesn't hold there."""
    places = []
    for need in needs:
        here = left[at] if at < len(left) else None
        if here is not None and here[0] in need.removesuffix("?").split("|"):
            places.append(at)
            at += 1
        elif not need.endswith("?"):
            return None
    return places


def recognise(identified: list[tuple[str, str, int, int]]) -> list[tuple[str, int, int]]:
    """Licences ``(name, start, end)`` of a sequence of identified sentences."""
    left: list[tuple[str, str, int, int] | None] = list(identified)
    found: list[tuple[str, int, int]] = []
    for licence, needs in RULES:
        for i in range(len(left)):
            places = _taken(left, i, needs) if left[i] is not None else None
            if not places:
                continue
            part = [left[p] for p in places]
            version = next((x[1] for x in part if "(v)" in x[0]), "")
            if version.isdigit():
                version += ".0"
            for name in licence.replace("{n}", part[0][1]).replace("{v}", version).split(","):
                found.append((name, part[0][2], part[-1][3]))
            for p in places:
                left[p] = None
    for x in left:  # references stand for themselves
        if x is not None and x[0].startswith("="):
            found.append((x[1], x[2], x[3]))
    unknown = [x for x in left if x is not None and not x[0].startswith("=")]
    if unknown:
        found.append(("UNKNOWN", unknown[0][2], unknown[0][3]))
    return sorted(found, key=lambda x: (x[1], x[0]))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, licenses, sentence_ids, spans`` per row, in one pass without a shuffle.

    licenses: distinct names by first appearance, comma-joined.  sentence_ids: the
    identified sentences in order, comma-joined.  spans: ``name:start:end`` of each
    licence found, in code points, comma-joined.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids, spans = [], [], []
            for value in batch.column(1):
                known = identify(value.as_py() or "")
                found = recognise(known)
                names.append(",".join(dict.fromkeys(n for n, _, _ in found)))
                ids.append(",".join(k if not k.startswith("=") else "=" + n for k, n, _, _ in known))
                spans.append(",".join(f"{n}:{a}:{b}" for n, a, b in found))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in (names, ids, spans))], ["doc_id", "licenses", "sentence_ids", "spans"])

    return mapped(
        lacking(docs, [("doc_id", "long"), ("text", "string")]),
        run, "doc_id long, licenses string, sentence_ids string, spans string")
