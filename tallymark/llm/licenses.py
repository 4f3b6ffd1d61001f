"""License scan by ordered signature rules, gated by keywords, with overlaps resolved by priority and containment.

A text is folded to lower-case words joined by single spaces. Each rule has a
keyword that all its matches hold, and runs only where that is; the shortest
keywords, one of which every rule needs, rule most texts out at once. Detections are ordered
by priority, then length, then place: a detection inside one that came before
it is suppressed. What is left gives the labels. The four base phrases are
counted everywhere and their labels always stay.

The scan is a projection: nothing is shuffled, and rules are constants.
Defined results: a null or empty text has no words, no labels and score 0;
repeated rows and other columns have no influence on each other.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bytes_of, text_of

#: Phrases that are always looked for, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_VERSION = r"(?: (?:version|v))? ?"
#: Short names that mean other things too: label, and the versions with a point that tell them apart.
_SHORT = [("apache", "asl", ["1 0", "1 1", "2 0"]), ("mpl", "mpl", ["1 0", "1 1", "2 0"]), ("epl", "epl", ["1 0", "2 0"])]
#: Licenses as label, names as regular expressions over folded text, versions as they are written when folded.
_NAMED = [
    ("gpl", ["gnu general public licen[sc]e", "gnu gpl", "gpl"], ["1 0", "2 0", "3 0", "1", "2", "3"]),
    ("lgpl", ["gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e", "lgpl"], ["2 0", "2 1", "3 0", "2", "3"]),
    ("agpl", ["gnu affero general public licen[sc]e", "affero general public licen[sc]e", "agpl"], ["1 0", "3 0", "1", "3"]),
    ("gfdl", ["gnu free documentation licen[sc]e", "gfdl"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache software licen[sc]e", "apache licen[sc]e"], ["1 0", "1 1", "2 0", "2"]),
    ("mpl", ["mozilla public licen[sc]e"], ["1 0", "1 1", "2 0", "2"]),
    ("epl", ["eclipse public licen[sc]e"], ["1 0", "2 0"]),
    ("cddl", ["common development and distribution licen[sc]e", "cddl"], ["1 0", "1 1"]),
    ("cpl", ["common public licen[sc]e"], ["0 5", "1 0"]),
    ("eupl", ["european union public licen[sc]e", "eupl"], ["1 0", "1 1", "1 2"]),
    ("artistic", ["artistic licen[sc]e"], ["1 0", "2 0"]),
    ("afl", ["academic free licen[sc]e"], ["1 1", "2 1", "3 0"]),
    ("osl", ["open software licen[sc]e"], ["1 0", "2 1", "3 0"]),
    ("psf", ["python software foundation licen[sc]e", "psf licen[sc]e"], ["2", "2 0"]),
    ("zpl", ["zope public licen[sc]e"], ["1 1", "2 0", "2 1"]),
    ("php", ["php licen[sc]e"], ["3 0", "3 01"]),
    ("ms-pl", ["microsoft public licen[sc]e"], []),
    ("ms-rl", ["microsoft reciprocal licen[sc]e"], []),
    ("bsl", ["boost software licen[sc]e"], ["1 0"]),
    ("busl", ["business source licen[sc]e"], ["1 1"]),
    ("sspl", ["server side public licen[sc]e"], ["1"]),
    ("elastic", ["elastic licen[sc]e"], ["2 0"]),
    ("ofl", ["sil open font licen[sc]e", "open font licen[sc]e"], ["1 0", "1 1"]),
    ("odbl", ["open database licen[sc]e", "odbl"], ["1 0"]),
    ("odc-by", ["open data commons attribution licen[sc]e"], ["1 0"]),
    ("pddl", ["public domain dedication and licen[sc]e"], ["1 0"]),
    ("cecill", ["cecill(?: [bc])? licen[sc]e", "cecill licen[sc]e agreement"], ["1 0", "2 0", "2 1"]),
    ("ecl", ["educational community licen[sc]e"], ["1 0", "2 0"]),
    ("ncsa", ["university of illinois ncsa open source licen[sc]e"], []),
    ("openssl", ["openssl licen[sc]e", "openssl toolkit licen[sc]e"], []),
    ("wtfpl", ["do what the fuck you want to public licen[sc]e"], ["1", "2"]),
    ("beerware", ["beer ware licen[sc]e"], []),
    ("isc", ["isc licen[sc]e"], []),
    ("mit", ["mit licen[sc]e", "expat licen[sc]e", "x11 licen[sc]e", "mit x11 licen[sc]e"], []),
    ("bsd", ["bsd licen[sc]e", "berkeley software distribution licen[sc]e"], []),
    ("bsd-2-clause", ["(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) licen[sc]e"], []),
    ("bsd-3-clause", ["(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[sc]e"], []),
    ("bsd-4-clause", ["(?:bsd 4 clause|4 clause bsd|original bsd) licen[sc]e"], []),
    ("0bsd", ["(?:zero clause bsd|bsd zero clause|free public) licen[sc]e"], []),
    ("zlib", ["zlib licen[sc]e", "zlib libpng licen[sc]e"], []),
    ("unlicense", ["the unlicense", "unlicense org"], []),
    ("curl", ["curl licen[sc]e"], []),
    ("ruby", ["ruby licen[sc]e"], []),
    ("perl", ["same terms as perl itself"], []),
    ("postgresql", ["postgresql licen[sc]e"], []),
    ("unicode", ["unicode licen[sc]e agreement"], ["3", "3 0"]),
    ("w3c", ["w3c software(?: and document)? (?:notice and )?licen[sc]e"], []),
    ("vim", ["vim licen[sc]e"], []),
    ("tcl", ["tcl tk licen[sc]e"], []),
    ("json", ["json licen[sc]e"], []),
    ("llama-community", ["llama (?:2 |3 )?community licen[sc]e"], []),
    ("openrail", ["(?:creativeml |bigscience )?open ?rail(?: m| pp m)? licen[sc]e"], []),
]
#: Sentences and phrases of license texts as label, signature, keyword that every match holds.
_FREE = [
    ("mit", "subject to the following conditions the above copyright notice and this permission notice", "permission"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use", "without restriction"),
    ("mit", "use copy modify merge publish distribute sublicense and or sell copies of the software", "sublicense"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistribut"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "redistribut"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising"),
    ("bsd", "this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is", "is provided by"),
    ("gpl", "this program is distributed in the hope that it will be useful", "hope that it will be useful"),
    ("gpl", "either version [123](?: of the licen[sc]e)? or at your option any later version", "any later version"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document", "verbatim copies"),
    ("gpl", "the licen[sc]es for most software are designed to take away your freedom", "take away your freedom"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "this library is free"),
    ("lgpl", "this licen[sc]e the lesser general public licen[sc]e applies to some specially designated software", "specially designated"),
    ("agpl", "your modified version must prominently offer all users interacting with it remotely", "interacting with it remotely"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", "permission"),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts", "invariant sections"),
    ("apache", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "irrevocable"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e", "applicable law"),
    ("apache", "this product includes software developed by the apache software foundation", "apache software foundation"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at", "was not distributed with this file"),
    ("mpl", "the contents of this file are subject to the mozilla public licen[sc]e", "mozilla"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse", "accompanying materials"),
    ("epl", "the accompanying program is provided under the terms of this eclipse public licen[sc]e", "eclipse"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution", "common development"),
    ("cpl", "the accompanying program is provided under the terms of this common public licen[sc]e", "common public"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", "package may be copied"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", "permission"),
    ("boost", "boost software licen[sc]e version 1 0", "boost"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", "permission"),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented"),
    ("zlib", "altered source versions must be plainly marked as such", "plainly marked"),
    ("openssl", "this product includes software developed by the openssl project", "openssl project"),
    ("php", "this product includes php software freely available from", "php software"),
    ("psf", "python software foundation licen[sc]e version 2", "python software foundation"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free to"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies", "verbatim or modified"),
    ("ofl", "this font software is licen[sc]ed under the sil open font licen[sc]e", "font software"),
    ("ofl", "the fonts and derivatives however cannot be released under any other type of licen[sc]e", "fonts and derivatives"),
    ("odbl", "this database is made available under the open database licen[sc]e", "database"),
    ("pddl", "this data is made available under the public domain dedication and licen[sc]e", "public domain dedication"),
    ("unicode", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files", "unicode data files"),
    ("json", "the software shall be used for good not evil", "good not evil"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "buy me a beer"),
    ("x11", "except as contained in this notice the name of the x consortium shall not be used", "x consortium"),
    ("elastic", "you may not provide the software to third parties as a hosted or managed service", "hosted or managed service"),
    ("sspl", "if you make the functionality of the program or a modified version available to third parties as a service", "available to third parties as a service"),
    ("busl", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "non production use"),
    ("llama-community", "llama (?:2|3) is licen[sc]ed under the llama", "llama"),
    ("openrail", "use based restrictions as referenced in paragraph 5", "use based restrictions"),
    ("cc", "some rights reserved", "reserved"),
    ("cc", "to view a copy of this licen[sc]e visit (?:https? )?(?:www )?creativecommons org", "creativecommons"),
    ("cc-by-nc", "you may not use (?:the|this) (?:material|work) for commercial purposes", "commercial purposes"),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", "remix transform"),
    ("cc-by-sa", "you must distribute your contributions under the same licen[sc]e as the original", "contributions under the same"),
    ("cc0", "to the extent possible under law .{1,80}? has waived all copyright", "waived all copyright"),
    ("cc0", "no rights reserved", "reserved"),
    ("public-domain", "works of the united states government are in the public domain", "public domain"),
    ("public-domain", "the author disclaims copyright to this source code", "disclaims copyright"),
    ("proprietary", "unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document|material)", "unauthorized"),
    ("proprietary", "no part of this (?:publication|book|document|work) may be reproduced", "no part of this"),
    ("proprietary", "this (?:file|document|software) contains proprietary(?: and confidential)? information", "proprietary"),
    ("proprietary", "trade secrets? of", "trade secret"),
    ("proprietary", "for internal use only", "internal use only"),
    ("proprietary", "not for (?:re ?distribution|resale|public release)", " not for"),
    ("eula", "by installing copying or otherwise using (?:the|this) software you agree", "otherwise using"),
    ("eula", "you may not reverse engineer decompile or disassemble", "reverse engineer"),
    ("eula", "the software is licen[sc]ed not sold", "not sold"),
    ("editorial", "reprinted (?:with|by) permission", "reprinted"),
    ("editorial", "may be reproduced for (?:personal|educational|non ?commercial) use", "may be reproduced for"),
    ("fair-use", "fair use (?:under|pursuant to) section 107", "section 107"),
    ("no-warranty", "the authors? (?:or copyright holders )?(?:shall not|be) liable for any claim damages or other liability", "liab"),
    ("no-warranty", "in no event (?:shall|will) the (?:authors?|copyright holders?|regents)(?: or contributors)? be (?:held )?liable", "in no event"),
    ("no-warranty", "merchantability fitness for a particular purpose and non ?infringement", "merchantability"),
    ("no-warranty", "even the implied warranty of merchantability or fitness for a particular purpose", "merchantability"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribut"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse", "endorse"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warrant"),
    ("gpl", "is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", "gnu"),
    ("lgpl", "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e", "gnu"),
    ("gpl", "you should have received a copy of the gnu general public licen[sc]e", "gnu"),
    ("lgpl", "you should have received a copy of the gnu lesser general public licen[sc]e", "gnu"),
    ("agpl", "you should have received a copy of the gnu affero general public licen[sc]e", "gnu"),
    ("apache", "you may not use this file except in compliance with the licen[sc]e", "licen"),
    ("apache", "www apache org licenses license 2 0", "licen"),
    ("mpl", "this source code form is subject to the terms of the mozilla public licen[sc]e", "licen"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "public domain"),
    ("wtfpl", "you just do what the fuck you want to", "fuck you want to"),
    ("public-domain", "(?:released|dedicated|placed|donated) (?:in|to|into) the public domain", "public domain"),
    ("public-domain", "this work is in the public domain", "public domain"),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0"),
    ("cc0", "creative commons (?:zero|public domain dedication)", "creative commons"),
    ("proprietary", "all rights reserved", "reserved"),
    ("proprietary", "may not be (?:reproduced|copied|distributed|published)[a-z ]{0,60}? without (?:prior |express )?(?:written )?permission", "permission"),
    ("proprietary", "confidential and proprietary", "proprietary"),
    ("eula", "end user licen[sc]e agreement", "licen"),
    ("no-warranty", "without warranty of any kind", "warrant"),
    ("no-warranty", "as is basis without warranties or conditions of any kind", "warrant"),
]
_CC_PARTS = [("by", ""), ("by-sa", " sa"), ("by-nc", " nc"), ("by-nd", " nd"), ("by-nc-sa", " nc sa"), ("by-nc-nd", " nc nd")]
_CC_WORDS = {"sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}


def _rules() -> list[tuple[int, str, bytes, re.Pattern]]:
    """priority (lower goes first), label, keyword (which every match holds, the space before it included), signature."""
    rows = [(10, label, keyword, text) for label, text, keyword in _FREE]
    for label, names, versions in _NAMED:
        for name in names:
            keyword = "licen" if "licen[sc]e" in name else "unlicense" if "unlicense" in name else " " + name.split()[0]
            keyword = {" same": " same terms"}.get(keyword, keyword)
            rows += [(20, f"{label}-{v.replace(' ', '.')}", keyword, f"{name}{_VERSION}{v}") for v in versions]
            rows.append((40, label, keyword, name))
    for label, name, versions in _SHORT:
        for v in versions:
            rows.append((20, f"{label}-{v.replace(' ', '.')}", f" {name}", f"{name}{_VERSION}{v}"))
        # Without a full version only beside words that speak of a license.
        rows.append((30, label, f" {name}", f"(?:licen[sc]ed under|released under|covered by|distributed under|terms of)(?: the)? {name}(?: ?v?[123])?"))
        rows.append((30, label, f" {name}", f"{name}(?: ?v?[123])? (?:licen[sc]ed?|or later|compatible licen[sc]e)"))
    for part, tail in _CC_PARTS:
        words = "".join(f" {_CC_WORDS[w]}" for w in tail.split())
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            rows.append((20, f"cc-{part}-{version.replace(' ', '.')}", "cc by", f"cc by{tail} {version}"))
            rows.append((20, f"cc-{part}-{version.replace(' ', '.')}", "creative commons", f"creative commons attribution{words} {version}"))
        rows.append((40, f"cc-{part}", "cc by", f"cc by{tail}"))
        rows.append((40, f"cc-{part}", "creative commons", f"creative commons attribution{words}"))
        rows.append((20, f"cc-{part}", "creativecommons", f"creativecommons org licenses {part.replace('-', ' ')}"))
    for label in sorted({r[1] for r in rows if r[0] >= 20}):
        rows.append((5, label, "spdx", f"spdx license identifier {re.escape(label.replace('-', ' ').replace('.', ' '))}"))
    rows.append((15, "gpl-or-later", "gnu", "gnu general public licen[sc]e[a-z0-9 ]{0,40}? or (?:at your option )?any later version"))
    return [(p, label, k.encode(), re.compile(rf"(?<= ){text}(?= )".encode())) for p, label, k, text in rows]


RULES = _rules()
_NEEDED = {keyword for _, _, keyword, _ in RULES} | {f" {phrase} ".encode() for phrase in BASE}
#: A text without any of these holds no keyword and no base phrase.
ANCHORS = tuple(sorted(k for k in _NEEDED if not any(other != k and other in k for other in _NEEDED)))
#: Bytes that make up words once A-Z are folded; all others separate them.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def detections(folded: bytes) -> list[tuple[str, int, int]]:
    """label, first byte and byte after the last, of the rules' detections that are left after suppression."""
    keywords: dict[bytes, bool] = {}
    found = []
    for order, (priority, label, keyword, signature) in enumerate(RULES):
        if keyword not in keywords:
            keywords[keyword] = keyword in folded
        if keywords[keyword]:
            found += [(priority, m.start() - m.end(), m.start(), m.end(), order, label) for m in signature.finditer(folded)]
    left: list[tuple[str, int, int]] = []
    # The intervals kept so far but those inside another: starts and ends rise together, so of
    # all that start at or before a place the last reaches furthest.
    starts: list[int] = []
    ends: list[int] = []
    for _, _, low, high, _, label in sorted(found):
        at = bisect_right(starts, low)
        if at and ends[at - 1] >= high:
            continue
        past = bisect_right(ends, high)
        first = bisect_left(starts, low)
        del starts[first:past], ends[first:past]
        starts.insert(first, low)
        ends.insert(first, high)
        left.append((label, low, high))
    return left


def base_places(folded: bytes) -> list[tuple[int, str]]:
    """First word (from 0) and label of every place of a base phrase; ``folded`` starts and ends with a space."""
    places = []
    for phrase, label in BASE.items():
        needle, at = f" {phrase} ".encode(), -1
        while (at := folded.find(needle, at + 1)) >= 0:
            places.append((at, label))
    if not places:
        return []
    spaces = np.flatnonzero(np.frombuffer(folded, dtype=np.uint8) == 32)
    return [(int(np.searchsorted(spaces, at)), label) for at, label in places]


def scanned(text: bytes) -> tuple:
    words = text.translate(_FOLD).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0
    folded = b" " + b" ".join(words) + b" "
    if not any(anchor in folded for anchor in ANCHORS):
        return len(words), 0, None, None, "", "", 0.0
    base, own = base_places(folded), detections(folded)
    first = [w for w, _ in base]
    base_labels = {label for _, label in base}
    labels = base_labels | {label for label, _, _ in own}
    told = sum(high - low for _, low, high in own)
    score = 0.0 if not labels else 1 - 0.5 ** (len(base) + len(own) + min(told / 100, 3))
    return len(words), len(base), min(first, default=None), max(first, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""

    def batches(stream):
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for batch in stream:
            columns = list(zip(*map(scanned, bytes_of(batch, "text")), strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
