"""License scans by sentence rules: sentences become identifiers, sequences of these licenses.

Comment marks and indentation are taken off, and a text is cut at full stops and blank lines. What is
left between two cuts is lines: the longest run of them that is a known sentence, once normalised, is
taken, wherever it was wrapped. Only known sentences are kept, as a sequence of identifiers for each
text, and ordered rules are matched against that sequence: the first rule that matches takes its
sentences out, then the next is tried. All of it is expressions on one row, so nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.llm.frames import nested, restored, text_of

# Sentences of well-known licenses and notices, normalised as ``normalised`` does,
# and the identifiers they stand for. Versions in a sentence are part of its identifier.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    " and associated documentation files (the software), to deal in the software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and or sell copies of the software, and to permit persons to whom the"
    " software is furnished to do so, subject to the following conditions:": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the software": "MITnotice",
    "licensed under the apache license, version 2 0": "Apache2ref",
    "licensed under the apache license, version 2 0 (the license)": "Apache2ref",
    "you may not use this file except in compliance with the license": "Apache2use",
    "you may obtain a copy of the license at": "LicenseAt",
    "this work is licensed under the gnu general public license, version 3": "GPL3ref",
    "licensed under the gnu general public license, version 3": "GPL3ref",
    "licensed under the gnu general public license, version 2": "GPL2ref",
    "this program is free software: you can redistribute it and or modify it under the terms of the"
    " gnu general public license as published by the free software foundation, either version 3 of"
    " the license, or (at your option) any later version": "GPL3plus",
    "this program is free software; you can redistribute it and or modify it under the terms of the"
    " gnu general public license as published by the free software foundation; either version 2 of"
    " the license, or (at your option) any later version": "GPL2plus",
    "licensed under cc by-nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "licensed under cc by-sa 4 0": "CCBYSA4ref",
    "redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:": "BSDgrant",
    "redistributions of source code must retain the above copyright notice, this list of conditions"
    " and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and or other materials provided"
    " with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission": "BSDendorse",
    "all rights reserved": "AllRights",
    "this file is public domain": "PublicDomain",
    "this work is in the public domain": "PublicDomain",
}
#: License, and the identifiers that follow each other for it, the most specific rule first.
RULES = (
    ("MIT", "<MITgrant><MITnotice>"),
    ("BSD-3-Clause", "<BSDgrant><BSDsource><BSDbinary><BSDendorse>"),
    ("BSD-2-Clause", "<BSDgrant><BSDsource><BSDbinary>"),
    ("Apache-2.0", "<Apache2ref><Apache2use>(?:<LicenseAt>)?"),
    ("GPL-3.0-or-later", "<GPL3plus>"),
    ("GPL-2.0-or-later", "<GPL2plus>"),
    ("GPL-3.0-only", "<GPL3ref>"),
    ("GPL-2.0-only", "<GPL2ref>"),
    ("Apache-2.0", "<Apache2ref>"),
    ("MIT", "<MITref>"),
    ("CC-BY-NC-4.0", "<CCBYNC4ref>"),
    ("CC-BY-SA-4.0", "<CCBYSA4ref>"),
    ("CC-BY-4.0", "<CCBY4ref>"),
    ("public-domain", "<PublicDomain>"),
    ("all-rights-reserved", "<AllRights>"),
)
# More sentences and rules. The SQL reads the two tables above and knows none of these; where a name
# is in both, the rule here goes first.
MORE_SENTENCES = {
    "MITref": ("mit license", "the mit license", "the mit license (mit)", "this software is released under the mit license", "this code is licensed under the mit license"),
    "MITasis": ("the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",),
    "MITliable": ("in no event shall the holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",),
    "BSDasis": ("this software is provided by the holders as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "BSDliable": ("in no event shall the holders be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage",),
    "BSDsource": ("redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",),
    "BSDbinary": (
        "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution; and",
        "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution, and",
    ),
    "BSDendorse": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "Apache2ref": ("licensed under the apache license, version 2 0 (the license), with modifications", "apache license version 2 0 january 2004", "this project is licensed under the apache license, version 2 0", "this file is licensed to you under the apache license, version 2 0 (the license)", "the asf licenses this file to you under the apache license, version 2 0 (the license)"),
    "LicenseAt": tuple(f"you may obtain a copy of the license at {h} www apache org licenses license-2 0" for h in ("http:", "https:")),
    "Apache2asis": ("unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind, either express or implied",),
    "Apache2see": ("see the license for the specific language governing permissions and limitations under the license",),
    "GPLwarranty": tuple(f"this {w} is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose" for w in ("program", "library", "software", "file")),
    "GPLsee": tuple(f"see the gnu {k}general public license for more details" for k in ("", "lesser ", "library ", "affero ")),
    "GPLcopy": tuple(f"you should have received a copy of the gnu {k}general public license along with this {w}{x}" for k in ("", "lesser ", "affero ") for w in ("program", "library", "software", "file") for x in ("", "; if not, see https: www gnu org licenses", "; if not, see http: www gnu org licenses")),
    "GPLurl": tuple(f"if not, see <{h} www gnu org licenses>" for h in ("http:", "https:")),
    "GPL3ref": ("gnu general public license version 3, 29 june 2007", "this project is licensed under the gnu general public license, version 3"),
    "GPL2ref": ("gnu general public license version 2, june 1991", "this work is licensed under the gnu general public license, version 2"),
    "LGPL3ref": ("gnu lesser general public license version 3, 29 june 2007", "licensed under the gnu lesser general public license, version 3"),
    "LGPL21ref": ("gnu lesser general public license version 2 1, february 1999", "licensed under the gnu lesser general public license, version 2 1"),
    "AGPL3ref": ("gnu affero general public license version 3, 19 november 2007", "licensed under the gnu affero general public license, version 3"),
    "ISCgrant": tuple(f"permission to use, copy, modify, {a} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies" for a in ("and or", "and")),
    "ISCasis": ("the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",),
    "ISCliable": ("in no event shall the holders be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software",),
    "MPL2ref": ("this source code form is subject to the terms of the mozilla public license, v 2 0", "mozilla public license version 2 0", "licensed under the mozilla public license, version 2 0"),
    "MPL2copy": tuple(f"if a copy of the mpl was not distributed with this file, you can obtain one at {h} mozilla org mpl 2 0" for h in ("http:", "https:")),
    "CC0": ("to the extent possible under law, the holders have waived all copyright and related or neighboring rights to this work", "licensed under cc0 1 0", "cc0 1 0 universal", "this work is licensed under cc0 1 0"),
    "CCBY4ref": ("this work is licensed under a creative commons attribution 4 0 international license", "this work is licensed under cc by 4 0"),
    "CCBYSA4ref": ("this work is licensed under a creative commons attribution-sharealike 4 0 international license", "this work is licensed under cc by-sa 4 0"),
    "CCBYNC4ref": ("this work is licensed under a creative commons attribution-noncommercial 4 0 international license", "this work is licensed under cc by-nc 4 0"),
    "Unlicense": ("this is free and unencumbered software released into the public domain",),
}
for _id, _words, _version, _kind in (
    ("GPL3plus", "program", "3", ""), ("GPL2plus", "program", "2", ""), ("LGPL3plus", "program", "3", "lesser "),
    ("LGPL3plus", "library", "3", "lesser "), ("LGPL21plus", "library", "2 1", "lesser "), ("LGPL21plus", "program", "2 1", "lesser "),
    ("AGPL3plus", "program", "3", "affero "), ("GPL3plus", "file", "3", ""), ("GPL2plus", "file", "2", ""),
):
    MORE_SENTENCES[_id] = (*MORE_SENTENCES.get(_id, ()), f"this {_words} is free software: you can redistribute it and or modify it under the terms of the gnu {_kind}general public license as published by the free software foundation, either version {_version} of the license, or (at your option) any later version")
GPL_REST = "(?:<GPLwarranty>)?(?:<GPLsee>)?(?:<GPLcopy>)?(?:<GPLurl>)?"
MORE_RULES = (
    ("MIT", "<MITgrant><MITnotice>(?:<MITasis>)?(?:<MITliable>)?"),
    ("BSD-3-Clause", "<BSDgrant><BSDsource><BSDbinary><BSDendorse>(?:<BSDasis>)?(?:<BSDliable>)?"),
    ("BSD-2-Clause", "<BSDgrant><BSDsource><BSDbinary>(?:<BSDasis>)?(?:<BSDliable>)?"),
    ("Apache-2.0", "<Apache2ref><Apache2use>(?:<LicenseAt>)?(?:<Apache2asis>)?(?:<Apache2see>)?"),
    ("GPL-3.0-or-later", "<GPL3plus>" + GPL_REST),
    ("GPL-2.0-or-later", "<GPL2plus>" + GPL_REST),
    ("LGPL-3.0-or-later", "<LGPL3plus>" + GPL_REST),
    ("LGPL-2.1-or-later", "<LGPL21plus>" + GPL_REST),
    ("AGPL-3.0-or-later", "<AGPL3plus>" + GPL_REST),
    ("LGPL-3.0-only", "<LGPL3ref>"),
    ("LGPL-2.1-only", "<LGPL21ref>"),
    ("AGPL-3.0-only", "<AGPL3ref>"),
    ("ISC", "<ISCgrant>(?:<ISCasis>)?(?:<ISCliable>)?"),
    ("MPL-2.0", "<MPL2ref>(?:<MPL2copy>)?"),
    ("CC0-1.0", "<CC0>"),
    ("Unlicense", "<Unlicense>"),
)
# Every known sentence and tag holds one of these, so texts without any are left alone.
HINTS = ("licens", "copyright", "permission", "redistribut", "reserved", "domain", "noninfringement",
         "warrant", "liab", "mpl", "cc0")
# How the SQL cuts and normalises.
MARK_ENDS = r"[.!?]+([\x20\x09-\x0D]|$)"
LINE_ENDS = r"\n([^a-z])"
END = "\x01"
QUOTES = r"[\"'`]+"
FILLERS = r"[*#/\\.\x20\x09-\x0D]+"
# Comment marks, indentation and numbers of list items at the start of a line, comment ends at its end.
# All of these run over a stretch of a class once, without a way back: a pattern that may give back
# what it has taken is slow, or out of stack, on long stretches of blanks and marks.
MARKS = r"[\x20\t*#/;%>!|{}-]*+"
OPENING = r"<!-++|\(\*|(?:dnl|DNL|REM|rem|@rem)(?=[\x20\t])"
ITEM = r"(?:\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[.)]|[*•·-])[\x20\t]++"
LINE_STARTS = rf"(?md)^{MARKS}(?:(?:{OPENING}){MARKS})?(?:{ITEM})?"
ENDING = r"[\x20\t\r*#/|>)-]"
LINE_STOPS = rf"(?md)(?<!{ENDING}){ENDING}++$"
# A sentence ends at a full stop, question or exclamation mark before white space or the end (but
# for "v. 2.0"), and at a blank line.
CUTS = r"(?<![.!?])(?<!\b[vV])[.!?]++(?=[\x20\x09-\x0D]|$)|\n[\x20\t\r]*+\n[\x20\t\r\n]*+"
# Between two cuts lines and semicolons end pieces. A sentence starts at a piece that is the first,
# comes after a semicolon or has no small letter at its start, and ends before one.
SEMICOLON = ";"
PIECES = r"\n|(?<=;)(?=[\x20\t])"
GOES_ON = r"^(?!https?:)[a-z]"
DROPPED = r"[\"'`“”‘’,;:()<>\[\]]+"
# Names that differ from text to text.
HOLDERS = (
    (r"^neither the names? of .+? nor the names? of (?:its|their|any|the|other) ?(?:other )?contributors",
     "neither the name of the copyright holder nor the names of its contributors"),
    (r"^this software is provided by .+? as is and any", "this software is provided by the holders as is and any"),
    (r"^in no event shall .+? be liable", "in no event shall the holders be liable"),
    (r"^to the extent possible under law .+? (?:has|have) waived", "to the extent possible under law the holders have waived"),
)
HOLDER_WORDS = 60  # in pieces of a word each, so many more may make up a sentence with a name
SPDX_ID = r"\(*[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?\)*"
SPDX = rf"[Ss][Pp][Dd][Xx]-[Ll]icense-[Ii]dentifier:[\x20\t]*({SPDX_ID}(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+{SPDX_ID})*)"
SPDX_MARK = "SPDX-"
# Older names of the same licenses.
SPDX_OLD = {
    f"{kind}-{version}{old}": f"{kind}-{version}-{new}"
    for kind, version in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))
    for old, new in (("", "only"), ("+", "or-later"))
}


def normalised(piece: Column) -> Column:
    """A piece in lower case, with single spaces for white space, comment marks, slashes and dots,
    and without quotes, brackets and punctuation."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(piece), DROPPED, ""), FILLERS, " ")
    return F.trim(F.regexp_replace(plain, r"\x20{2,}", " "))


def _known() -> dict[str, str]:
    """All known sentences, normalised as ``normalised`` does, and their identifiers."""
    pairs = [*SENTENCES.items(), *((s, i) for i, many in MORE_SENTENCES.items() for s in many)]
    return {" ".join(re.sub(FILLERS, " ", re.sub(DROPPED, "", s)).split()): i for s, i in pairs}


KNOWN = _known()
MOST_PIECES = max(len(s.split()) for s in KNOWN) + HOLDER_WORDS
#: How known sentences start, in a piece of one word or more.
STARTS = "^(?:" + "|".join(
    sorted({rf"{s.split()[0]}(?:\x20{re.escape(s.split()[1])}\b|$)" for s in KNOWN})
) + ")"


def pieces(sentence: Column) -> Column:
    """Pieces of what lies between two cuts, as ``(key, opens, tags)``, without empty ones."""

    def piece(parts: Column, raw: Column, at: Column) -> Column:
        before = F.try_element_at(parts, at)  # positions count from 1
        opens = (at == 0) | ~raw.rlike(GOES_ON) | F.endswith(before, F.lit(SEMICOLON))
        said = F.regexp_replace(F.regexp_extract(raw, SPDX, 1), r"[\x20\t]WITH[\x20\t]+[^\x20\t]+", "")
        tags = F.filter(F.split(said, r"[()\x20\t]+"), lambda t: ~t.isin("", "AND", "OR"))
        return F.struct(normalised(raw).alias("key"), opens.alias("opens"), tags.alias("tags"))

    def all_of(parts: Column) -> Column:
        found = F.transform(parts, lambda raw, at: piece(parts, raw, at))
        return F.filter(found, lambda p: p["key"] != "")

    trimmed = F.transform(F.split(sentence, PIECES), lambda raw: F.trim(raw))
    return F.transform(F.array(trimmed), all_of)[0]


def ids_of(found: Column) -> Column:
    """Identifiers in the pieces of a sentence: of tags, and of the longest runs of pieces that are
    known, from left to right."""
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    old = F.create_map(*[F.lit(x) for pair in SPDX_OLD.items() for x in pair])

    def looked_up(run: Column) -> Column:
        for pattern, name in HOLDERS:
            run = F.regexp_replace(run, pattern, name)
        return F.try_element_at(known, run)

    def runs(piece: Column, at: Column) -> Column:
        lengths = F.sequence(F.lit(1), F.least(F.lit(MOST_PIECES), F.size(found) - at))
        ends = F.filter(
            lengths, lambda n: F.coalesce(F.try_element_at(found, at + n + 1)["opens"], F.lit(True))
        )
        each = F.transform(
            ends,
            lambda n: F.struct(
                n.alias("n"),
                looked_up(
                    F.array_join(F.transform(F.slice(found, at + 1, n), lambda p: p["key"]), " ")
                ).alias("id"),
            ),
        )
        longest = F.try_element_at(F.filter(each, lambda r: r["id"].isNotNull()), F.lit(-1))
        named = F.transform(
            piece["tags"], lambda t: F.concat(F.lit(SPDX_MARK), F.coalesce(F.try_element_at(old, t), t))
        )
        tagged = F.struct(F.lit(1).alias("n"), named.alias("ids"))
        starts = piece["opens"] & piece["key"].rlike(STARTS)
        run = F.transform(
            F.array(longest), lambda r: F.struct(r["n"].alias("n"), F.array(r["id"]).alias("ids"))
        )[0]
        return F.struct(
            at.alias("at"), F.when(F.size(piece["tags"]) > 0, tagged).when(starts, run).alias("run")
        )

    def step(state: Column, x: Column) -> Column:
        taken = x["run"]["n"].isNotNull() & (x["at"] >= state["next"])
        return F.struct(
            F.when(taken, x["at"] + x["run"]["n"]).otherwise(state["next"]).alias("next"),
            F.when(taken, F.concat(state["ids"], x["run"]["ids"])).otherwise(state["ids"]).alias("ids"),
        )

    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(F.transform(found, runs), start, step)["ids"]


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences and tags, in order."""
    bare = F.regexp_replace(F.regexp_replace(text, LINE_STARTS, ""), LINE_STOPS, "")
    cut = F.transform(F.split(bare, CUTS), pieces)
    ids = F.flatten(F.transform(cut, ids_of))
    hinted = F.lower(text).contains(HINTS[0])
    for hint in HINTS[1:]:
        hinted = hinted | F.lower(text).contains(hint)
    return F.when(hinted, ids).otherwise(F.array().cast("array<string>"))


def licenses_of(sequence: Column) -> tuple[Column, Column]:
    """Licenses in a sequence ``<id><id>...`` and what is left of it: tags name theirs, and each
    rule in its turn finds all its places and takes them out."""
    tag = rf"<{SPDX_MARK}([^>]*)>"
    tags = F.regexp_extract_all(sequence, F.lit(tag), F.lit(1))
    found, rest = [], F.regexp_replace(sequence, tag, "|")
    for name, pattern in MORE_RULES + RULES:
        found.append(F.when(rest.rlike(pattern), F.lit(name)))
        rest = F.regexp_replace(rest, pattern, "|")
    names = F.concat(tags, F.array_compact(F.array(*found)))
    return F.array_sort(F.array_distinct(names)), rest


def scan_licenses(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with ``n_sentences``, ``sentence_ids``, ``licenses`` and ``unmatched``.

    ``sentence_ids`` are the identifiers of the known license sentences in the order of the text,
    ``licenses`` the names that rules have found in that order of identifiers, sorted and each
    once, separated by commas; ``unmatched`` counts the identifiers that no rule has taken. All are
    empty or 0 where there is nothing, as for null and empty texts. Rows are independent of each
    other, repeated rows included; an input column with the name of a result gives way; an empty
    table gives an empty table.
    """
    rows = nested(df, df.columns, ids=sentence_ids(text_of(text_col)))
    sequence = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    names, rest = licenses_of(F.col("sequence"))
    rows = rows.withColumn("sequence", sequence)
    unmatched = F.length(rest) - F.length(F.replace(rest, F.lit("<"), F.lit("")))
    return restored(
        rows,
        df.columns,
        n_sentences=F.size("ids").cast("bigint"),
        sentence_ids=F.array_join("ids", ","),
        licenses=F.when(F.size("ids") > 0, F.array_join(names, ",")).otherwise(""),
        unmatched=F.when(F.size("ids") > 0, unmatched).otherwise(0).cast("bigint"),
    )
