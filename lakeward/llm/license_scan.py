"""Licence recognition: sentences become identifiers, identifier sequences match ordered rules."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.scratch import prepare

# Normalised sentences by identifier.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the software",
    "mit-0-grant": "permission is hereby granted free of charge to any person obtaining a copy of "
    "this software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so",
    "as-is": "the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular "
    "purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with "
    "or without fee is hereby granted provided that the above copyright notice and this permission "
    "notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with "
    "or without fee is hereby granted",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list "
    "of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this "
    "list of conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution",
    "bsd-advertising": "all advertising materials mentioning features or use of this software must "
    "display the following acknowledgement",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may "
    "be used to endorse or promote products derived from this software without specific prior "
    "written permission",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-title": "apache license version 2 0 january 2004",
    "apache-grant": "subject to the terms and conditions of this license each contributor hereby "
    "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright "
    "license to reproduce prepare derivative works of publicly display publicly perform sublicense "
    "and distribute the work and such derivative works in source or object form",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-2-title": "gnu general public license version 2 june 1991",
    "gpl-3-title": "gnu general public license version 3 29 june 2007",
    "lgpl-2-title": "gnu library general public license version 2 june 1991",
    "lgpl-2.1-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl-3-title": "gnu lesser general public license version 3 29 june 2007",
    "agpl-3-title": "gnu affero general public license version 3 19 november 2007",
    "mpl-1.1-form": "the contents of this file are subject to the mozilla public license version 1 1 "
    "the license",
    "mpl-2-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-2-title": "mozilla public license version 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0-waiver": "to the extent possible under law the author has waived all copyright and related "
    "or neighboring rights to this work",
    "cc0-title": "cc0 1 0 universal",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
}
# Other wordings of sentences above.
VARIANTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files": "mit-grant",
    SENTENCES["mit-keep"].replace("notice shall", "notice including the next paragraph shall"): "mit-keep",
    "the software is provided as is without warranty of any kind": "as-is",
    SENTENCES["as-is"].replace("noninfringement", "non infringement"): "as-is",
    SENTENCES["isc-grant"].replace("and or", "and"): "isc-grant",
    SENTENCES["0bsd-grant"].replace("and or", "and"): "0bsd-grant",
    SENTENCES["bsd-source"].replace("notice this", "notice unmodified this"): "bsd-source",
    SENTENCES["bsd-advertising"].replace("acknowledgement", "acknowledgment"): "bsd-advertising",
    "licensed under the apache license version 2 0 the license": "apache-notice",
    "you may not use this work except in compliance with the license": "apache-use",
    "you may not use this software except in compliance with the license": "apache-use",
    "you may not use these files except in compliance with the license": "apache-use",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "mpl-2-form",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-form",
    "creative commons legal code cc0 1 0 universal": "cc0-title",
    "creative commons cc0 1 0 universal": "cc0-title",
}
# Rules in order of precedence, each an ordered sequence of identifiers.
RULES = [
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-grant", "as-is")),
    ("MIT-0", ("mit-0-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("BSD-4-Clause", ("bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-notice", "apache-use")),
    ("Apache-2.0", ("apache-title",)),
    ("Apache-2.0", ("apache-grant",)),
    ("MPL-1.1", ("mpl-1.1-form",)),
    ("MPL-2.0", ("mpl-2-form",)),
    ("MPL-2.0", ("mpl-2-title",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("CC0-1.0", ("cc0-title",)),
]
# What a notice may name a licence, by the licence.
NAMES = {
    "MIT": ["mit", "mit license", "mit licence", "expat license", "mit expat license"],
    "ISC": ["isc", "isc license"],
    "0BSD": ["0bsd", "bsd zero clause license"],
    "MPL-1.1": ["mpl 1 1", "mozilla public license 1 1", "mozilla public license version 1 1"],
    "MPL-2.0": ["mpl 2 0", "mplv2", "mpl v2 0", "mozilla public license 2 0"]
    + [f"mozilla public license{v} 2 0" for v in (" version", " v")],
    "Unlicense": ["unlicense"],
    "CC0-1.0": ["cc0", "cc0 1 0", "cc0 1 0 universal", "cc0 license", "cc0 1 0 universal license"]
    + ["creative commons cc0 1 0 universal public domain dedication", "creative commons zero"]
    + ["cc0 1 0 universal public domain dedication", "creative commons cc0 1 0 universal license"],
    "Apache-2.0": ["apache 2 0", "apache 2", "apache license", "apache 2 0 license", "apache license v2"]
    + [f"apache {w} 2 0" for w in ("license", "license v", "license version", "software license version")]
    + ["apache license v2 0", "apache license 2", "apache license version 2", "apache 2 license"],
}
for _n, _word in ((2, "two"), (3, "three"), (4, "four")):
    NAMES[f"BSD-{_n}-Clause"] = [
        f"{x}{end}"
        for x in (f"bsd {_n} clause", f"{_n} clause bsd", f"{_word} clause bsd", f"bsd {_word} clause")
        for end in ("", " license", " licence")
    ]
NAMES["BSD-3-Clause"] += ["new bsd license", "modified bsd license", "revised bsd license"]
NAMES["BSD-2-Clause"] += ["simplified bsd license", "freebsd license"]
NAMES["BSD"] = ["bsd", "bsd license", "bsd style license"]

# The licences of the GNU project: family, its full names, its versions.
_GNU = [
    ("GPL", ("general",), ("1", "2", "3")),
    ("LGPL", ("lesser general", "library general", "library or lesser general"), ("2", "2.1", "3")),
    ("AGPL", ("affero general",), ("3",)),
]
_LATER = ("or later", "or any later version", "or at your option any later version")
for _family, _kinds, _versions in _GNU:
    _low = _family.lower()
    _terms = [
        ("you can redistribute it and or modify it under the terms of", f"the gnu {_k} public license")
        for _k in _kinds
    ]
    _by = "as published by the free software foundation"
    SENTENCES[f"{_low}-terms"] = f"{_terms[0][0]} {_terms[0][1]} {_by}"
    VARIANTS.update({f"{_a} {_b} {_by}": f"{_low}-terms" for _a, _b in _terms[1:]})
    for _v in _versions:
        _name = f"{_family}-{_v}" + ("" if "." in _v else ".0")
        for _w in dict.fromkeys((_v.replace(".", " "), f"{_v} 0") if "." not in _v else (_v.replace(".", " "),)):
            SENTENCES.setdefault(f"version-{_v}", f"version {_w} of the license")
            SENTENCES.setdefault(
                f"version-{_v}-or-later",
                f"either version {_w} of the license or at your option any later version",
            )
            VARIANTS[f"version {_w} of the license or at your option any later version"] = (
                f"version-{_v}-or-later"
            )
            VARIANTS[f"either version {_w} or at your option any later version"] = f"version-{_v}-or-later"
            VARIANTS[f"version {_w}"] = f"version-{_v}"
            for _a, _b in _terms:
                for _later, _texts in (
                    (
                        "-or-later",
                        [
                            f"{_b} {_by} either version {_w} of the license or at your option any later version",
                            f"{_b} {_by} version {_w} of the license or at your option any later version",
                            f"{_b} {_by} either version {_w} or at your option any later version",
                        ],
                    ),
                    (
                        "",
                        [
                            f"{_b} version {_w} {_by}",
                            f"version {_w} of {_b} {_by}",
                            f"{_b} {_by} version {_w} of the license",
                            f"{_b} {_by} version {_w}",
                        ],
                    ),
                ):
                    for _t in _texts:
                        _id = f"{_low}-{_v}{_later}-terms"
                        if _id in SENTENCES:
                            VARIANTS[f"{_a} {_t}"] = _id
                        else:
                            SENTENCES[_id] = f"{_a} {_t}"
            _own = [f"gnu {_k} public license" for _k in _kinds] + [f"gnu {_low}", _low]
            _said = [f"{_o} {_p}{_w}" for _o in _own for _p in ("version ", "v", "")] + [f"{_low}v{_w}"]
            NAMES.setdefault(_name, []).extend([*_said, *(f"{_x} only" for _x in _said)])
            NAMES.setdefault(f"{_name}-or-later", []).extend(
                [f"{_x} {_y}" for _x in _said for _y in _LATER]
            )
        RULES += [
            (f"{_name}-or-later", (f"{_low}-{_v}-or-later-terms",)),
            (_name, (f"{_low}-{_v}-terms",)),
            (f"{_name}-or-later", (f"{_low}-terms", f"version-{_v}-or-later")),
            (_name, (f"{_low}-terms", f"version-{_v}")),
        ]
        if f"{_low}-{_v}-title" in SENTENCES:
            RULES.append((_name, (f"{_low}-{_v}-title",)))

# Creative Commons: the kinds in their short and full names, all versions.
for _code, _words in {
    "by": "attribution",
    "by-sa": "attribution sharealike",
    "by-nd": "attribution noderivatives",
    "by-nc": "attribution noncommercial",
    "by-nc-sa": "attribution noncommercial sharealike",
    "by-nc-nd": "attribution noncommercial noderivatives",
}.items():
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _w, _name = _v.replace(".", " "), f"CC-{_code.upper()}-{_v}"
        _forms = {_words, _words.replace("sharealike", "share alike")}
        _forms |= {f.replace("noderivatives", "noderivs") for f in _forms}
        _forms |= {f.replace("noncommercial", "non commercial") for f in _forms}
        _full = [
            f"creative commons {f} {_w}{kind}"
            for f in sorted(_forms)
            for kind in ("", " international", " unported", " generic")
        ]
        _short = [f"{c} {_code.replace('-', ' ')} {_w}" for c in ("cc", "creative commons")]
        NAMES[_name] = [f"{x}{e}" for x in [*_full, *_short] for e in ("", " license", " public license")]
        SENTENCES[f"cc-{_code}-{_v}-title"] = f"creative commons {_words} {_w} international public license"
        RULES.append((_name, (f"cc-{_code}-{_v}-title",)))
        if _v < "4.0":
            SENTENCES[f"cc-{_code}-{_v}-title"] = f"creative commons {_words} {_w} unported license"

_NOTICE_IDS = {
    "MIT": "mit-notice",
    "Apache-2.0": "apache-notice",
    "GPL-3.0": "gpl3-notice",
    "CC-BY-NC-4.0": "cc-by-nc-notice",
}
NAMED = {}
for _name, _all in NAMES.items():
    _id = _NOTICE_IDS.get(_name, f"{_name.lower()}-notice")
    NAMED.update({_x: _id for _x in _all})
    RULES.append((_name, (_id,)))

# A notice is a sentence of its own that says what it is about, or not, and names a licence.
NOTICE = (
    r"^(?:spdx license identifier |(?:(?:and|it|this|the|all|our|these)(?: [a-z0-9]+){0,4}? (?:is|are|may be) )?"
    r"(?:(?:dual|free|freely|open|and|also|made) )*"
    r"(?:licensed|licenced|released|distributed|published|available|provided|shared|redistributed) "
    r"(?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?)"
    r"([a-z0-9 ]+?)(?: the license| for details)?$"
)
# Sentences that name their holder.
HOLDERS = [
    (
        "bsd-endorse",
        r"^.{3,400} may (?:not )?be used to endorse or promote products derived from this software "
        r"without (?:specific )?prior written permission(?: .{1,200})?$",
    ),
    (
        "cc0-waiver",
        r"^to the extent possible under law .{1,200} (?:has|have) (?:waived|dedicated) all copyright and "
        r"related (?:or|and) neighboring rights to .{1,200}$",
    ),
]
# Every sentence, notice or sentence with a holder has one of these stems.
HINT = (
    r"licen|permission|redistribut|copyright|public\W+domain|version|software|cc0|advertis"
    r"|(?:released|distributed|published|available|provided|shared)\W+(?:to\W+you\W+)?under"
)
# A full stop ends a sentence unless a digit follows, as in a version number; a blank line, also
# one of comment signs, ends one too.  A line end alone need not.
END = r"[!?;]|(?<!identifier):|\.(?![0-9])|(?:\r\n|\n|\r(?!\n))[^\n\ra-z0-9]*[\n\r]"
LINE = r"[\n\r]+"
_KNOWN = {**{s: i for i, s in SENTENCES.items()}, **VARIANTS}
# No known sentence is longer; sentences with a holder have room for it.
LONGEST = 1000


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _table(words: dict[str, str]) -> Column:
    """A constant map, made from one literal."""
    pairs = ",".join(f"{a}={b}" for a, b in words.items())
    return F.str_to_map(F.lit(pairs), F.lit(","), F.lit("="))


def _identifier(sentence: Column) -> Column:
    """Identifier of a normalised sentence; null if it is not known."""
    name = F.regexp_extract(sentence, NOTICE, 1)
    named = _let(name, lambda n: F.when(n != "", F.element_at(_table(NAMED), n)))
    with_holder = [F.when(sentence.rlike(p), F.lit(identifier)) for identifier, p in HOLDERS]
    return F.coalesce(F.element_at(_table(_KNOWN), sentence), *with_holder, named)


def _of_piece(piece: Column) -> Column:
    """Identifiers in what lies between two sentence ends, in order.

    A sentence is any whole number of lines of it: titles above and lines below may lack a full
    stop.  The longest known one counts, and what it covers is not read again.
    """
    lines = F.filter(
        F.transform(
            F.split(piece, LINE), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))
        ),
        lambda s: s != "",
    )

    def longest_from(all_lines: Column, at: Column) -> Column:
        start = F.struct(
            F.lit("").alias("text"), F.lit(0).alias("n"),
            F.lit(None).cast("string").alias("id"), F.lit(0).alias("lines"),
        )

        def longer(acc: Column, line: Column) -> Column:
            return _let(
                F.when(
                    F.length(acc["text"]) + F.length(line) <= LONGEST,
                    F.when(acc["n"] == 0, line).otherwise(F.concat(acc["text"], F.lit(" "), line)),
                ),
                lambda text: _let(
                    _identifier(text),
                    lambda found: F.struct(
                        text.alias("text"),
                        (acc["n"] + 1).alias("n"),
                        F.coalesce(found, acc["id"]).alias("id"),
                        F.when(found.isNotNull(), acc["n"] + 1).otherwise(acc["lines"]).alias("lines"),
                    ),
                ),
            )

        # Every line has a character and a space, so this many lines reach the longest sentence.
        return F.aggregate(F.slice(all_lines, at + 1, F.lit(LONGEST // 2)), start, longer)

    def several(all_lines: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("next"), F.array().cast("array<string>").alias("ids")
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(all_lines) - 1),
            start,
            lambda acc, i: F.when(i < acc["next"], acc).otherwise(
                _let(
                    longest_from(all_lines, i),
                    lambda found: F.struct(
                        F.when(found["id"].isNull(), i + 1).otherwise(i + found["lines"]).alias("next"),
                        F.when(found["id"].isNull(), acc["ids"])
                        .otherwise(F.concat(acc["ids"], F.array(found["id"])))
                        .alias("ids"),
                    ),
                )
            ),
            lambda acc: acc["ids"],
        )

    none = F.array().cast("array<string>")
    return _let(lines, lambda x: F.when(F.size(x) > 0, several(x)).otherwise(none))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    found = _let(
        F.lower(text),
        lambda low: F.when(
            low.rlike(HINT),
            F.flatten(F.transform(F.filter(F.split(low, END), lambda s: s.rlike(HINT)), _of_piece)),
        ),
    )
    return F.coalesce(found, F.array().cast("array<string>"))


def _tight(sequence: tuple[str, ...]) -> str:
    """The identifiers in order, the first of them not again between them; gaps are groups."""
    first = re.escape(f",{sequence[0]},")
    return f"((?:(?!{first}).)*?)".join(re.escape(f",{i},") for i in sequence)


def licenses(ids: Column) -> Column:
    """Licences with a rule whose identifiers occur in its order, other sentences between or not.

    Rules take their sentences away from later ones, so that a licence with more conditions
    is not also reported as the one with fewer.
    """
    rules = [
        "\t".join(
            [
                name,
                _tight(sequence),
                "".join(f"${g}" for g in range(1, len(sequence))),
                ".*".join(re.escape(f",{i},") for i in sequence),
            ]
        )
        for name, sequence in RULES
    ]
    line = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))
    start = F.struct(line.alias("line"), F.array().cast("array<string>").alias("names"))

    def applied(acc: Column, rule: Column) -> Column:
        name, tight, gaps, loose = (F.get(rule, F.lit(i)) for i in range(4))
        taken = F.struct(
            F.regexp_replace(acc["line"], tight, gaps).alias("line"),
            F.concat(acc["names"], F.array(name)).alias("names"),
        )
        return F.when(F.rlike(acc["line"], loose), taken).otherwise(acc)

    found = F.aggregate(
        F.split(F.lit("\n".join(rules)), "\n"),
        start,
        lambda acc, rule: _let(F.split(rule, "\t"), lambda parts: applied(acc, parts)),
        lambda acc: F.array_distinct(acc["names"]),
    )
    return F.when(F.size(ids) > 0, found).otherwise(F.array().cast("array<string>"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licenses) per row; a null or empty text has neither.

    A narrow pass of column functions: no row meets another, so copies and hot sources cost
    what they weigh.  A sentence ends at a blank line, ``!``, ``?``, ``;``, ``:`` or a full stop
    that no digit follows, and may also begin or end with a line; other line ends are spaces.
    It is compared in lower case with other characters than letters and digits as one space.
    """
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", sentence_ids(text).alias("sentence_ids"))
    return found.withColumn("licenses", licenses(F.col("sentence_ids")))
