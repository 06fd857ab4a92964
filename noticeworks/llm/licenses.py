"""Licence scans by sentence rules, in DataFrame functions alone.

A text is cut in sentences and normalised (A-Z lower-cased, everything but letters a-z and digits one space). Known
sentences become identifiers; the others are left out. Rules, tried in their order, are sequences of identifiers: where a
rule stands in a document's sequence its licence is found and the identifiers are used up, so a longer rule hides a
shorter one within it.

A sentence that is not known as a whole may still be a notice that names a licence: an SPDX tag, "(This file is) licensed
under NAME (see ...)" and its kin, "NAME, see LICENSE". The frame is cut off by a regular expression and the name looked
up among ``NAMES``.

Sentences are read twice: with every line end as the end of a sentence (notices on lines of their own) and with blank
lines alone (texts wrapped over lines). A licence counts if either reading has it.

Defined cases. Null and empty texts have no licence. Repeated rows are scanned alike. Work is linear in the text. An empty
table gives an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.words import add_fields

#: Normalised sentences of licence texts and notices, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2-notice",
    "licensed under the apache license version 2 0 the license": "apache2-header",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache2-header",
    "apache license": "apache-title",
    "version 2 0 january 2004": "apache2-date",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this work is licensed under the gnu general public license version 2": "gpl2-notice",
    "gnu general public license": "gpl-title",
    "version 3 29 june 2007": "gpl3-date",
    "version 2 june 1991": "gpl2-date",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4-notice",
    "licensed under cc by 4 0": "cc-by-4-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-4-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit-condition",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "isc license": "isc-title",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    # "v. 2.0" is cut behind its first mark.
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-notice",
    "mozilla public license version 2 0": "mpl2-title",
    "gnu lesser general public license": "lgpl-title",
    "gnu affero general public license": "agpl-title",
    "version 2 1 february 1999": "lgpl21-date",
    "version 3 19 november 2007": "agpl3-date",
    "cc0 1 0 universal": "cc0-title",
}
#: GNU licences: the word that tells them apart, identifiers' prefix, versions and the licence of each.
_GNU = [
    ("", "gpl", {"2": "GPL-2.0", "3": "GPL-3.0"}),
    ("lesser ", "lgpl", {"2 1": "LGPL-2.1", "3": "LGPL-3.0"}),
    ("affero ", "agpl", {"3": "AGPL-3.0"}),
]
_LATER = " or at your option any later version"
for _kind, _id, _versions in _GNU:
    for _may in ("can", "may"):
        _terms = f"you {_may} redistribute it and or modify it under the terms of the gnu {_kind}general public license"
        SENTENCES[f"{_terms} as published by the free software foundation"] = f"{_id}-terms"
        for _version in _versions:
            _header = f"{_id}{_version.replace(' ', '')}-header"
            for _middle in ("", "either "):
                for _end in ("", " of the license"):
                    for _later in ("", _LATER):
                        _tail = f"{_middle}version {_version}{_end}{_later}"
                        SENTENCES[f"{_terms} as published by the free software foundation {_tail}"] = _header
            SENTENCES[f"{_terms} version {_version} as published by the free software foundation"] = _header
            SENTENCES[f"{_terms.replace('the terms of', 'the terms and conditions of')} version {_version} as published by the free software foundation"] = _header
for _version in ("2", "2 1", "3"):
    for _middle in ("", "either "):
        for _later in ("", _LATER):
            SENTENCES[f"{_middle}version {_version} of the license{_later}"] = f"version-{_version.replace(' ', '.')}"
for _version, _site in (("2 0", "https www eclipse org legal epl 2 0"), ("1 0", "http www eclipse org legal epl v10 html")):
    for _v in ("", "v", "version "):
        for _which in ("", "which is available at ", "which accompanies this distribution and is available at "):
            SENTENCES[
                "this program and the accompanying materials are made available under the terms of the eclipse public license "
                f"{_v}{_version}{' ' + _which + _site if _which else ''}"
            ] = f"epl{_version[0]}-notice"
#: Names of licences as notices and SPDX tags give them, normalised, without a last "license".
NAMES = {
    "Apache-2.0": ["apache 2 0", "apache 2", "apache version 2 0", "apache v2", "apache v2 0", "apache license 2 0",
                   "apache license version 2 0", "apache license v2 0", "apache software license 2 0",
                   "apache software license version 2 0"],
    "MIT": ["mit", "expat", "mit expat", "x11"],
    "MIT OR Apache-2.0": ["mit or apache 2 0", "apache 2 0 or mit", "mit apache 2 0"],
    "BSD": ["bsd", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd", "new bsd", "modified bsd",
            "revised bsd", "simplified bsd", "bsd 2 clause simplified", "bsd 3 clause new or revised"],
    "ISC": ["isc"],
    "0BSD": ["0bsd"],
    "MPL-2.0": ["mpl 2 0", "mpl v2 0", "mozilla public license 2 0", "mozilla public license version 2 0",
                "mozilla public license v2 0", "mpl version 2 0"],
    "EPL-2.0": ["epl 2 0", "epl v2 0", "eclipse public license 2 0", "eclipse public license v2 0",
                "eclipse public license version 2 0"],
    "EPL-1.0": ["epl 1 0", "epl v1 0", "eclipse public license 1 0", "eclipse public license v1 0",
                "eclipse public license version 1 0"],
    "CC0-1.0": ["cc0", "cc0 1 0", "cc0 1 0 universal", "creative commons zero", "creative commons zero v1 0 universal",
                "creative commons cc0", "creative commons cc0 1 0 universal"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0", "creative commons attribution 4 0 international"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0",
                     "creative commons attribution sharealike 4 0 international"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0",
                     "creative commons attribution noncommercial 4 0 international"],
    "Unlicense": ["unlicense"],
    "Zlib": ["zlib"],
    "BSL-1.0": ["bsl 1 0", "boost software license 1 0", "boost software license version 1 0"],
}
for _kind, _id, _versions in _GNU:
    for _version, _licence in _versions.items():
        for _v in ("", "v", "version "):
            for _name in (_id, f"gnu {_id}", f"{_kind}general public license", f"gnu {_kind}general public license"):
                NAMES.setdefault(_licence, []).append(f"{_name} {_v}{_version}")
        if len(_version) == 1:
            NAMES[_licence] += [f"{_id}{_version}", f"{_id} {_version} 0", f"{_id} v{_version} 0"]
_NAMED = {name: f"{licence.lower().replace(' ', '-')}-named" for licence, names in NAMES.items() for name in names}
#: Rules in the order in which they are tried: licence and its sequence of identifiers.
RULES = [
    ("Apache-2.0", "apache-title|apache2-date"),
    ("Apache-2.0", "apache2-header|apache2-comply"),
    ("Apache-2.0", "apache2-header"),
    ("Apache-2.0", "apache2-notice"),
    ("MIT", "mit-title|mit-grant|mit-condition"),
    ("MIT", "mit-grant|mit-condition"),
    ("MIT", "mit-title|mit-condition"),
    ("MIT", "mit-condition"),
    ("MIT", "mit-grant"),
    ("MIT", "mit-notice"),
    ("MIT", "mit-title"),
    ("BSD", "all-rights-reserved|bsd-grant|bsd-source|bsd-binary|bsd-endorse"),
    ("BSD", "all-rights-reserved|bsd-grant|bsd-source|bsd-binary"),
    ("BSD", "bsd-grant|bsd-source|bsd-binary|bsd-endorse"),
    ("BSD", "bsd-grant|bsd-source|bsd-binary"),
    ("GPL-3.0", "gpl-title|gpl3-date"),
    ("GPL-3.0", "gpl3-notice"),
    ("GPL-2.0", "gpl-title|gpl2-date"),
    ("GPL-2.0", "gpl2-notice"),
    ("MPL-2.0", "mpl2-notice"),
    ("CC-BY-NC-4.0", "cc-by-nc-4-notice"),
    ("CC-BY-SA-4.0", "cc-by-sa-4-notice"),
    ("CC-BY-4.0", "cc-by-4-notice"),
    ("Unlicense", "unlicense-notice"),
    ("ISC", "isc-title|isc-grant"),
    ("ISC", "isc-grant"),
    ("MPL-2.0", "mpl2-title"),
    ("LGPL-3.0", "lgpl-title|gpl3-date"),
    ("LGPL-2.1", "lgpl-title|lgpl21-date"),
    ("AGPL-3.0", "agpl-title|agpl3-date"),
    ("CC0-1.0", "cc0-title"),
    ("EPL-2.0", "epl2-notice"),
    ("EPL-1.0", "epl1-notice"),
    *[
        (licence, rule)
        for _, kind, versions in _GNU
        for version, licence in versions.items()
        for rule in (f"{kind}-terms|version-{version.replace(' ', '.')}", f"{kind}{version.replace(' ', '')}-header")
    ],
    *[(licence, f"{licence.lower().replace(' ', '-')}-named") for licence in NAMES],
    ("all rights reserved", "all-rights-reserved"),
]
_END = "\x01"
#: Ends of sentences: marks before white space; and every line end, or an empty line.
_LINES = r"[.!?;:]+[\x20\x09-\x0D]|[\x0A\x0D]"
_FLOW = r"[.!?;:]+[\x20\x09-\x0D]|[\x0A\x0D][\x20\x09]*[\x0A\x0D]"
#: Notices that name a licence: what stands before the name and behind it.
_BEHIND = (
    r"(?: licen[sc]es?)?(?: only| or (?:at your option )?(?:any )?later(?: versions?)?)?"
    r"(?: (?:see|refer to|which|a copy of which|as found in|for (?:more )?details)\b.*)?$"
)
_FRAME = (
    r"^(?:spdx license identifier |(?:(?:this|these|the|all|our|it|its) (?:[a-z0-9]+ ){0,4}?(?:is|are) )?"
    r"(?:free software |open source |also |made |now ){0,2}"
    r"(?:licensed|released|distributed|available|published|provided|offered|covered|governed) (?:under|by) (?:an? |the )?"
    r"(?:terms (?:and conditions )?of (?:the )?)?)(.+?)" + _BEHIND
)
_SEE = r"^(?:the )?(.+?)(?: licen[sc]ed?)? (?:see|refer to) (?:the )?(?:accompanying |included )?(?:licen[sc]e|copying)\b.*$"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ["sentence_ids", "licenses"]


def identifiers(text: Column, ends: str) -> Column:
    """The identifiers of the known sentences, in the order of the text, each between bars."""
    # Capitals outside A-Z, which lower() changes too, are no part of a known sentence.
    whole = F.concat(F.coalesce(text, F.lit("")), F.lit("\n"))
    small = F.translate(whole, _CAPITALS + _END, _SMALL + " ")
    # The colon of an SPDX tag does not end a sentence.
    marked = F.regexp_replace(F.replace(small, F.lit("spdx-license-identifier:"), F.lit("spdx-license-identifier ")), ends, _END)
    sentences = F.split(F.regexp_replace(marked, rf"[^a-z0-9{_END}]+", " "), _END)
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    named = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])

    def identifier(sentence: Column) -> Column:
        own = F.trim(sentence)
        framed = F.when(own.contains("licen") | own.contains(" under "), named[F.regexp_extract(own, _FRAME, 1)])
        seen = F.when(own.contains("licen"), named[F.regexp_extract(own, _SEE, 1)])
        return F.coalesce(known[own], framed, seen)

    return F.filter(F.transform(sentences, identifier), lambda x: x.isNotNull())


def licences(ids: Column) -> Column:
    """The licences of a sequence, by rule order; what a rule has matched no later rule sees."""
    # A bar between two identifiers belongs to both, so each is doubled in the sequence and in the rule.
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(f"|{own.replace('|', '||')}|").alias("ids")) for name, own in RULES]
    )
    sequence = F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|"))
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state, rule):
        there = F.contains(state.rest, rule.ids)
        return F.struct(
            F.replace(state.rest, rule.ids, F.lit("|")).alias("rest"),
            F.when(there, F.array_append(state.found, rule["name"])).otherwise(state.found).alias("found"),
        )

    return F.array_distinct(F.aggregate(rules, start, step).found)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids`` (of the reading by lines) and ``licenses``, by rule order."""
    read = add_fields(
        docs,
        F.struct(identifiers(F.col(text), _LINES).alias("sentence_ids"), identifiers(F.col(text), _FLOW).alias("_flow_ids")),
        ["sentence_ids", "_flow_ids"],
    )
    none = F.array().cast("array<string>")
    by_lines = F.when(F.size("sentence_ids") > 0, licences(F.col("sentence_ids"))).otherwise(none)
    by_flow = F.when(F.size("_flow_ids") > 0, licences(F.col("_flow_ids"))).otherwise(none)
    both = F.array_union(by_lines, by_flow)
    order = F.array(*[F.lit(x) for x in dict.fromkeys(name for name, _ in RULES)])
    found = F.struct(F.filter(order, lambda x: F.array_contains(both, x)).alias("licenses"))
    return add_fields(read, found, ["licenses"]).drop("_flow_ids")
