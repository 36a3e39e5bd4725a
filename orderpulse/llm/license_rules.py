"""Signature rules for licences, in the order of their priority.

A rule is (keyword, pattern, label, confidence, gate). Texts are matched as lower-case words joined by one space, so
`CC BY-NC 4.0` reads `cc by nc 4 0`. A rule's pattern is tried only on texts that hold its keyword's words, and only
texts that hold one of `gates_of` the rules are looked at. Rules come first: gates are taken from them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple


class Rule(NamedTuple):
    """What `pattern` matches always holds the words of `keyword` and, if given, `gate`: a word or a part of one."""

    keyword: str
    pattern: str
    label: str
    confidence: float
    gate: str = ""


def _gate(words: str) -> str:
    """The longest word; spaces around it say that it must be a word, as short ones stand inside many others."""
    longest = max(words.split(), key=len)
    return longest if len(longest) > 3 and longest.isalpha() else f" {longest} "


def gates_of(rules: Sequence[Rule], phrases: Iterable[str] = ()) -> list[str]:
    """Few words so that whatever a rule or phrase matches holds one of them; looking for them is all that most
    documents cost."""
    wanted = dict.fromkeys([rule.gate or _gate(rule.keyword) for rule in rules])
    wanted |= dict.fromkeys(_gate(p) for p in phrases if not any(g in f" {p} " for g in wanted))
    return [g for g in wanted if not any(other != g and other in f" {g.strip()} " for other in wanted)]


_UNDER = r"(?:licensed|released|distributed|available|provided|published|made available|offered|covered|usable)"
_TERMS = r"(?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
_LICENCE = r"licen[sc]e"
_VERSION = r"(?: version)? v?"

#: Licences by name: label, keyword, pattern of the name (without the word licence), SPDX identifier as words.
_NAMED = (
    ("mit", "mit", r"mit(?: x11)?", r"mit"),
    ("mit", "expat", r"expat", r"expat"),
    ("mit-0", "mit", r"mit no attribution", r"mit 0"),
    ("isc", "isc", r"isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?", r"zlib"),
    ("bsd", "bsd", r"(?:new |simplified |modified |revised )?bsd", r"bsd"),
    ("bsd-2-clause", "clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd)", r"bsd 2 clause"),
    ("bsd-2-clause", "freebsd", r"freebsd", r"bsd 2 clause freebsd"),
    ("bsd-3-clause", "clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd)", r"bsd 3 clause"),
    ("bsd-4-clause", "clause", r"(?:bsd 4 clause|4 clause bsd|four clause bsd)", r"bsd 4 clause"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause)", r"0bsd"),
    ("boost-1", "boost", r"boost software", r"bsl 1 0"),
    ("unlicense", "unlicense", r"unlicense", r"unlicense"),
    ("wtfpl", "what the", r"do what the \w+ you want to public", r"wtfpl"),
    ("apache", "apache", r"apache(?: software)?", r"apache"),
    ("mpl", "mozilla", r"mozilla public", r"mpl"),
    ("epl", "eclipse", r"eclipse public", r"epl"),
    ("edl", "eclipse", r"eclipse distribution", r"edl"),
    ("cddl", "common development", r"common development and distribution", r"cddl"),
    ("cpl", "common public", r"common public", r"cpl"),
    ("ipl", "ibm", r"ibm public", r"ipl"),
    ("gpl", "general public", r"(?:gnu )?general public", r"gpl"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public", r"lgpl"),
    ("lgpl", "library general", r"(?:gnu )?library general public", r"lgpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public", r"agpl"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation", r"gfdl"),
    ("artistic", "artistic", r"(?:perl )?artistic", r"artistic"),
    ("python", "python", r"python(?: software foundation)?", r"python"),
    ("psf", "psf", r"psf", r"psf"),
    ("php", "php", r"php", r"php"),
    ("ruby", "ruby", r"ruby", r"ruby"),
    ("openssl", "openssl", r"openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql"),
    ("ncsa", "ncsa", r"(?:university of illinois )?(?:open source )?ncsa(?: open source)?", r"ncsa"),
    ("ms-pl", "microsoft", r"microsoft public", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal", r"ms rl"),
    ("eupl", "european union", r"european union public", r"eupl"),
    ("osl", "open software", r"open software", r"osl"),
    ("afl", "academic free", r"academic free", r"afl"),
    ("upl", "universal permissive", r"universal permissive", r"upl"),
    ("ofl", "open font", r"(?:sil )?open font", r"ofl"),
    ("odbl", "open database", r"open (?:data commons open )?database", r"odbl"),
    ("odc-by", "attribution", r"open data commons attribution", r"odc by"),
    ("pddl", "public domain dedication", r"public domain dedication(?: and)?", r"pddl"),
    ("json", "json", r"json", r"json"),
    ("beerware", "beerware", r"beerware", r"beerware"),
    ("beerware", "beer ware", r"beer ware", r"beerware"),
    ("vim", "vim", r"vim", r"vim"),
    ("w3c", "w3c", r"w3c(?: software)?", r"w3c"),
    ("x11", "x11", r"x11", r"x11"),
    ("curl", "curl", r"curl", r"curl"),
    ("sspl", "server side", r"server side public", r"sspl"),
    ("busl", "business source", r"business source", r"busl"),
    ("elastic", "elastic", r"elastic", r"elastic"),
    ("commons-clause", "commons clause", r"commons clause", r"commons clause"),
    ("openrail", "openrail", r"(?:creativeml )?(?:bigscience )?openrail(?: m)?", r"openrail"),
    ("openrail", "open rail", r"(?:creativeml )?(?:bigscience )?open rail(?: m)?", r"creativeml openrail m"),
    ("llama", "community", r"llama \d community", r"llama"),
)

#: Versions that get a label of their own; the version's words are those between dots.
_VERSIONED = {
    "apache": ("1 0", "1 1", "2 0", "2"), "mpl": ("1 0", "1 1", "2 0"), "epl": ("1 0", "2 0"),
    "gpl": ("1", "2", "2 0", "3", "3 0"), "lgpl": ("2", "2 0", "2 1", "3", "3 0"), "agpl": ("1", "3", "3 0"),
    "gfdl": ("1 1", "1 2", "1 3"), "cddl": ("1 0", "1 1"), "artistic": ("1 0", "2 0"), "eupl": ("1 1", "1 2"),
    "osl": ("1 0", "2 0", "2 1", "3 0"), "afl": ("1 2", "2 0", "2 1", "3 0"), "php": ("3 0", "3 01"),
    "ofl": ("1 0", "1 1"), "odbl": ("1 0",), "busl": ("1 1",), "elastic": ("2 0",),
}

#: Names that are also everyday words; alone behind the word licence they say nothing.
_EVERYDAY = {"python", "php", "ruby", "json", "vim", "curl", "elastic", "artistic", "llama", "psf", "apache", "boost"}

_CC_PARTS = (("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
             ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nc", "attribution non ?commercial"),
             ("by-nd", "attribution no ?deriv(?:ative)?s"), ("by-sa", "attribution share ?alike"),
             ("by", "attribution"))
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Abbreviations that name a licence if a version follows, by the label in _VERSIONED whose versions they have.
_SHORT = (
    ("gpl", r"(?:gnu )?", "gpl"), ("lgpl", r"(?:gnu )?", "lgpl"), ("agpl", r"(?:gnu )?", "agpl"), ("gfdl", r"(?:gnu )?", "gfdl"),
    ("apache", "", "apache"), ("mpl", "", "mpl"), ("epl", "", "epl"), ("cddl", "", "cddl"), ("eupl", "", "eupl"),
    ("osl", "", "osl"), ("afl", "", "afl"), ("ofl", r"(?:sil )?", "ofl"), ("odbl", "", "odbl"), ("busl", "", "busl"),
    ("artistic", "", "artistic"),
)
#: Abbreviations that stand for nothing else, with or without a version.
_ALONE = ("gpl", "lgpl", "agpl", "wtfpl", "gfdl", "cddl", "eupl", "odbl", "sspl")

_ANY = r"(?: [^ ]+)"
#: Sentences that stand in licence texts themselves, and notices without a named licence: label, keyword, pattern, gate.
_SENTENCES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy "
     rf"of this software(?:{_ANY}{{0,60}}? without limitation the rights to use copy modify merge publish distribute"
     r"(?: sublicense)?(?: and or sell copies of the software)?)?", ""),
    ("isc", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with "
     r"or without fee is hereby granted provided that the above copyright notice", ""),
    ("0bsd", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with "
     r"or without fee is hereby granted(?! provided )", ""),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification "
     rf"(?:are|is) permitted(?:{_ANY}{{0,40}}? copyright notice)?", ""),
    ("zlib", "implied warranty", r"this software is provided [^ ]?as is[^ ]? without any express or implied warranty"
     rf"{_ANY}{{0,40}}? permission is granted to anyone to use this software for any purpose{_ANY}{{0,120}}? "
     r"this notice may not be removed or altered from any(?: source)? distribution", ""),
    ("zlib", "permission is granted", r"permission is granted to anyone to use this software for any purpose including "
     r"commercial applications and to alter it and redistribute it freely", ""),
    ("gpl", "free software", r"this program is free software(?: you can| \w+){0,12}? redistribute it and or modify it under "
     r"the terms of the gnu general public license", "licen"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", ""),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is|are) (?:in|to|into)(?: the)? public domain", ""),
    ("public-domain", "public domain", r"public domain", ""),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", ""),
    ("cc0", "creative commons", r"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?", ""),
    ("all-rights-reserved", "all rights reserved", rf"(?:copyright{_ANY}{{0,12}}? )?all rights reserved", ""),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary|proprietary licen[sc]e)", ""),
    ("commercial", "commercial", r"commercial licen[sc]e(?: agreement)?", "licen"),
    ("eula", "end user", r"end user licen[sc]e agreement", "licen"),
    ("eula", "eula", r"eula", ""),
    ("copyleft", "copyleft", r"(?:strong |weak )?copyleft(?: licen[sc]e)?", ""),
    ("copyright", "copyright", r"copyright (?:c |\u00a9 ?)?(?:19|20)\d\d(?: (?:19|20)\d\d)*", ""),
    ("license-file", "see", r"see (?:the )?licen[sc]e(?: (?:txt|md))?(?: file)?(?: \w+){0,6}? (?:details|information)", "licen"),
)


_GNU = (("gpl", "general public", r"general public", ("1", "2", "3")),
        ("lgpl", "lesser general", r"lesser general public", ("2 1", "3")),
        ("lgpl", "library general", r"library general public", ("2",)),
        ("agpl", "affero", r"affero general public", ("3",)))

_BSD_TERMS = rf"redistribution and use in source and binary forms{_ANY}{{0,90}}? provided with the distribution"
#: Notices as the licences' own texts have them, which tell the version: label, keyword, pattern, gate.
_NOTICES = (
    ("bsd-2-clause", "redistribution and use", rf"{_BSD_TERMS} this software is provided", ""),
    ("bsd-3-clause", "redistribution and use", rf"{_BSD_TERMS}(?: 3)? (?:neither the names?|the names?) of{_ANY}{{0,30}}? "
     r"(?:endorse or promote|promote or endorse) products derived", ""),
    ("bsd-4-clause", "redistribution and use", rf"{_BSD_TERMS}(?: 3)? all advertising materials mentioning features", ""),
    ("bsd-3-clause", "endorse or promote", rf"neither the names? of{_ANY}{{0,30}}? endorse or promote products derived", ""),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software", ""),
    ("boost-1", "person or organization", r"permission is hereby granted free of charge to any person or organization obtaining "
     r"a copy of the software and accompanying documentation covered by this licen[sc]e", "licen"),
    ("wtfpl", "permitted to copy", r"everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e "
     r"document and changing it is allowed as long as the name is changed", "licen"),
    ("postgresql", "written agreement", r"permission to use copy modify and distribute this software and its documentation for any "
     r"purpose without fee and without a written agreement is hereby granted", "hereby"),
    ("json", "good not evil", r"the software shall be used for good not evil", " evil "),
    ("beerware", "retain this notice", r"as long as you retain this notice you can do whatever you want with this stuff", "whatever"),
    ("mpl-2", "source code form", r"this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0", "licen"),
    ("mpl-2", "incompatible with", r"incompatible with secondary licen[sc]es as defined by the mozilla public licen[sc]e v 2 0", "licen"),
    ("apache-2", "limitations under", r"see the licen[sc]e for the specific language governing permissions and limitations under the "
     r"licen[sc]e", "licen"),
    ("ofl-1.1", "font software", r"this font software is licensed under the sil open font licen[sc]e version 1 1", "licen"),
    ("gfdl", "modify this document", r"copy distribute and or modify this document under the terms of the gnu free documentation "
     r"licen[sc]e", "licen"),
    ("cc0", "deed", r"(?:has|have) dedicated the work to the public domain by waiving", "waiving"),
    ("artistic", "artistic", r"under the same terms as perl itself", "perl itself"),
    ("public-domain", "domain", r"(?:hereby )?(?:disclaims?|waives?) (?:all )?copyright(?: and related rights)?", "copyright"),
)

#: Addresses of licence texts, in words: label, keyword, pattern, gate.
_ADDRESSES = (
    ("apache-2", "apache org", r"apache org licen[sc]es licen[sc]e 2 0", "licen"),
    ("apache-1.1", "apache org", r"apache org licen[sc]es licen[sc]e 1 1", "licen"),
    ("gpl-3", "gnu org", r"gnu org licen[sc]es gpl 3 0", "licen"),
    ("gpl-2", "gnu org", r"gnu org licen[sc]es(?: old licen[sc]es)? gpl 2 0", "licen"),
    ("lgpl-3", "gnu org", r"gnu org licen[sc]es lgpl 3 0", "licen"),
    ("lgpl-2.1", "gnu org", r"gnu org licen[sc]es(?: old licen[sc]es)? lgpl 2 1", "licen"),
    ("agpl-3", "gnu org", r"gnu org licen[sc]es agpl 3 0", "licen"),
    ("gfdl-1.3", "gnu org", r"gnu org licen[sc]es fdl 1 3", "licen"),
    ("gpl", "gnu org", r"gnu org (?:licen[sc]es|copyleft) gpl", " gnu "),
    ("lgpl", "gnu org", r"gnu org (?:licen[sc]es|copyleft) lesser", " gnu "),
    ("agpl", "gnu org", r"gnu org licen[sc]es agpl", "licen"),
    ("mpl-2", "mozilla org", r"mozilla org(?: en us)? mpl 2 0", " mpl "),
    ("mpl-1.1", "mozilla org", r"mozilla org(?: en us)? mpl (?:mpl )?1 1", " mpl "),
    ("epl-2", "eclipse org", r"eclipse org (?:legal|org documents) epl (?:2 0|v20)", " epl "),
    ("epl-1", "eclipse org", r"eclipse org (?:legal|org documents) epl (?:1 0|v10)", " epl "),
    ("boost-1", "boost org", r"boost org licen[sc]e 1 0", "licen"),
    ("unlicense", "unlicense org", r"unlicense org", ""),
    ("wtfpl", "wtfpl net", r"wtfpl net", ""),
    ("cc0", "creativecommons org", r"creativecommons org publicdomain zero 1 0", "creativecommons"),
    ("public-domain", "creativecommons org", r"creativecommons org publicdomain mark 1 0", "creativecommons"),
    ("odbl-1", "opendatacommons org", r"opendatacommons org licen[sc]es odbl(?: 1 0)?", "licen"),
    ("odc-by", "opendatacommons org", r"opendatacommons org licen[sc]es by", "licen"),
    ("pddl", "opendatacommons org", r"opendatacommons org licen[sc]es pddl", "licen"),
    ("ofl", "sil org", r"scripts sil org ofl", " sil "),
    ("php-3.01", "php net", r"php net licen[sc]e 3 01", "licen"),
    ("cddl", "opensolaris", r"opensolaris org os licensing", "licen"),
)

#: Short names that only a partner makes a licence, as in `MIT or Apache-2.0`; the partners have rules of their own.
_WEAK = (("mit", "mit"), ("isc", "isc"), ("zlib", "zlib"), ("bsd", "bsd"), ("x11", "x11"))
_PARTNERS = ("apache", "gpl", "gplv2", "gplv3", "lgpl", "agpl", "mpl", "unlicense", "cc0", "epl", "wtfpl")
#: What may stand between a partner and the `or` behind it.
_ENDINGS = ("", " 2", " 3", " 2 0", " 2 1", " 3 0", " v2", " v3", " license", " license 2 0", " license version 2 0", " 2 0 only", " 3 0 only",
            " 2 0 or later", " 3 0 or later")

#: What a text says it is not: such an interval hides what stands in it and is no detection itself.
DENIED = ""
_WITHIN = r"(?:(?!but |and |or |under |is |are |it )[^ ]+ ){0,5}?"
_DENIALS = tuple((word, rf"(?:not|never|no longer)(?: be| been| being| yet| itself)?(?: {_UNDER})? under {_TERMS}(?:an? |any )?{_WITHIN}{name}"
                        rf"(?: {_LICENCE})?(?:{_VERSION} ?\d(?: \d)?)?", gate)
                 for word, name, gate in (("under", _LICENCE, "licen"), ("gpl", "gpl", ""), ("lgpl", "lgpl", ""), ("agpl", "agpl", ""),
                                          ("apache", "apache", ""), ("bsd", "bsd", " bsd ")))


def _choices() -> list[Rule]:
    """The weak name on either side of `or` (or a slash, which is no word) and a partner."""
    found = []
    for label, weak in _WEAK:
        for partner in _PARTNERS:
            behind = "|".join(f"(?<= {partner}{ending} )" for ending in _ENDINGS)  # each of a fixed length
            found.append(Rule(f"{weak} or {partner}", rf"{weak} or(?= {partner} )", label, 0.85, _gate(partner)))
            found.append(Rule(f"or {weak}", rf"(?:{behind})or {weak}", label, 0.85, _gate(partner)))
    return found


def rules() -> list[Rule]:
    """All rules, strongest first: denials, identifiers, notices and addresses, named versions, sentences, names, loose ones."""
    denials = [Rule(keyword, pattern, DENIED, 0.0, gate) for keyword, pattern, gate in _DENIALS]
    notices = [Rule(keyword, pattern, label, 0.97, gate) for label, keyword, pattern, gate in _NOTICES + _ADDRESSES]
    for label, keyword, name, versions_of in _GNU:
        for version in versions_of:
            notices.append(Rule(
                keyword, rf"{_TERMS}(?:gnu )?{name} licen[sc]e as published by(?! [^ ]+ licen){_ANY}{{0,6}}? (?:either )?version {version}"
                rf" of the licen[sc]e(?: or(?: \w+){{0,4}}? later version)?(?! \d)", f"{label}-{version.replace(' ', '.')}", 0.97, "licen"))
    identifiers, versions, names, loose = [], [], [], []
    for label, keyword, name, spdx in _NAMED:
        for version in _VERSIONED.get(label, ()):
            own = f"{label}-{version.replace(' ', '.')}".removesuffix(".0")
            identifiers.append(Rule("spdx", rf"spdx licen[sc]e identifier {spdx} {version}(?: only| or later)?", own, 1.0))
            versions.append(Rule(
                keyword, rf"{name} {_LICENCE}{_VERSION} ?{version}(?: or(?: \w+){{0,4}}? later(?: version)?)?", own, 0.95,
                "licen"))
            versions.append(Rule(
                keyword, rf"{_UNDER} under {_TERMS}{name} {_LICENCE}{_VERSION} ?{version}", own, 0.98, "licen"))
            notices.append(Rule("org", rf"(?:opensource|spdx) org licen[sc]es? {spdx} {version}", own, 0.95, "licen"))
            names.append(Rule(spdx.split()[0], rf"licen[sc]es? (?:is )?{spdx} {version}(?: only| or later)?", own, 0.9, "licen"))
        identifiers.append(Rule("spdx", rf"spdx licen[sc]e identifier {spdx}", label, 0.98))
        notices.append(Rule("org", rf"(?:opensource|spdx) org licen[sc]es? {spdx}(?: licen[sc]e)?", label, 0.95, "licen"))
        if spdx not in _EVERYDAY:
            names.append(Rule(spdx.split()[0], rf"licen[sc]es?(?: osi approved)? {spdx}(?: {_LICENCE})?", label, 0.75, "licen"))
        names.append(Rule(keyword, rf"{_UNDER} under {_TERMS}{name} {_LICENCE}", label, 0.9, "licen"))
        names.append(Rule(keyword, rf"under {_TERMS}{name} {_LICENCE}", label, 0.85, "licen"))
        loose.append(Rule(keyword, rf"{name} {_LICENCE}", label, 0.7, "licen"))
    for part, long in _CC_PARTS:
        short = part.replace("-", " ")
        for version in _CC_VERSIONS:
            own = f"cc-{part}-{version.replace(' ', '.')}"
            identifiers.append(Rule("spdx", rf"spdx licen[sc]e identifier cc {short} {version}", own, 1.0))
            versions.append(Rule("cc by", rf"cc {short} {version}(?: international)?", own, 0.95))
            versions.append(Rule("creative commons", rf"creative commons {long}(?: {_LICENCE})? {version}"
                                 rf"(?: (?:international|unported)(?: {_LICENCE})?)?", own, 0.95))
            notices.append(Rule("creativecommons org", rf"creativecommons org licen[sc]es {short} {version}", own, 0.95, "licen"))
        names.append(Rule("cc by", rf"cc {short}", f"cc-{part}", 0.85))
        names.append(Rule("creative commons", rf"creative commons {long}(?: {_LICENCE})?", f"cc-{part}", 0.85))
    for short, before, label in _SHORT:
        for version in _VERSIONED[label]:
            own, first = f"{label}-{version.replace(' ', '.')}".removesuffix(".0"), version.split()[0]
            # A further number is the version of something else, such as a server.
            later = r"(?! \d{1,2} )(?: only| or(?: \w+){0,4}? later(?: version)?)?"
            versions.append(Rule(short, rf"{before}{short}{_VERSION} ?{version}{later}", own, 0.85))
            versions.append(Rule(f"{short}v{first}", rf"{before}{short}v{version}{later}", own, 0.85))
            if short != "apache":  # apache2 is a server
                versions.append(Rule(f"{short}{first}", rf"{before}{short}{version}{later}", own, 0.85))
    loose += [Rule(short, rf"(?:gnu )?{short}", short, 0.6) for short in _ALONE]
    for n, word in (("2", "two"), ("3", "three"), ("4", "four")):
        for name in (f"bsd {n} clause", f"{n} clause bsd", f"{word} clause bsd"):
            loose.append(Rule(name, name, f"bsd-{n}-clause", 0.7, " bsd "))
    sentences = [Rule(keyword, pattern, label, 0.8, gate) for label, keyword, pattern, gate in _SENTENCES]
    loose.append(Rule("creative commons", rf"creative commons(?: {_LICENCE})?", "cc", 0.6))
    return denials + identifiers + notices + versions + sentences + _choices() + names + loose
