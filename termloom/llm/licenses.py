"""Licences of documents by sentence rules, in DataFrame functions only.

Texts are cut into sentences, each normalised and looked up among known licence sentences. The identifiers of a
document, in order, are then matched against ordered rules: a rule is a sequence of identifiers that must stand next
to each other, the first rule that fits claims its identifiers, and what no rule claims is reported as unmatched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences and notices as the cutter below leaves them, so a clause up to a colon
# or semicolon is one of its own; normalised as by `normalised` (lower case, letters, digits and dots inside numbers
# only, single blanks), with the identifier each stands for.
SENTENCES = (
    ("mit.name", "released under the mit license"),
    ("mit.name", "licensed under the mit license"),
    ("mit.name", "distributed under the mit license"),
    ("mit.name", "this project is licensed under the mit license"),
    ("mit.title", "the mit license"),
    ("mit.title", "mit license"),
    ("mit.grant",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit.notice",
     "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     "the software"),
    ("mit.warranty",
     "the software is provided as is without warranty of any kind express or implied including but not limited to the "
     "warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit.liability",
     "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
     "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
     "other dealings in the software"),
    ("apache2.name", "licensed under the apache license version 2.0"),
    ("apache2.name", "licensed under the apache license version 2.0 the license"),
    ("apache2.name", "released under the apache license version 2.0"),
    ("apache2.comply", "you may not use this file except in compliance with the license"),
    ("apache2.obtain", "you may obtain a copy of the license at"),
    ("apache2.url", "http www apache org licenses license 2.0"),
    ("apache2.url", "https www apache org licenses license 2.0"),
    ("apache2.where", "you may obtain a copy of the license at http www apache org licenses license 2.0"),
    ("apache2.where", "you may obtain a copy of the license at https www apache org licenses license 2.0"),
    ("apache2.basis",
     "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache2.see",
     "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl3.name", "this work is licensed under the gnu general public license version 3"),
    ("gpl3.name", "licensed under the gnu general public license version 3"),
    ("gpl3.name", "this program is licensed under the gnu general public license version 3"),
    ("gpl2.name", "this work is licensed under the gnu general public license version 2"),
    ("gpl2.name", "licensed under the gnu general public license version 2"),
    ("gpl.program", "this program is free software"),
    ("gpl.library", "this library is free software"),
    ("gpl.terms",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation"),
    ("gpl2.terms",
     "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published "
     "by the free software foundation"),
    ("gpl3.terms",
     "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published "
     "by the free software foundation"),
    ("lgpl.terms",
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
     "the free software foundation"),
    ("agpl.terms",
     "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
     "the free software foundation"),
    ("any.later.2", "either version 2 of the license or at your option any later version"),
    ("any.later.2.1", "either version 2.1 of the license or at your option any later version"),
    ("any.later.3", "either version 3 of the license or at your option any later version"),
    ("gpl2+.terms",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 2 of the license or at your option any later version"),
    ("gpl3+.terms",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl2.1+.terms",
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
     "the free software foundation either version 2.1 of the license or at your option any later version"),
    ("lgpl3+.terms",
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
     "the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3+.terms",
     "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
     "the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl.hope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl.hope", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("gpl.implied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl.see", "see the gnu general public license for more details"),
    ("gpl.see", "see the gnu lesser general public license for more details"),
    ("gpl.see", "see the gnu affero general public license for more details"),
    ("gpl.received", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl.received", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("gpl.received", "you should have received a copy of the gnu lesser general public license along with this program"),
    ("gpl.received", "you should have received a copy of the gnu affero general public license along with this program"),
    ("gpl.if.not", "if not see http www gnu org licenses"),
    ("gpl.if.not", "if not see https www gnu org licenses"),
    ("gpl.if.not",
     "if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa"),
    ("gpl.if.not",
     "if not write to the free software foundation inc 59 temple place suite 330 boston ma 02111 1307 usa"),
    ("lgpl3.name", "licensed under the gnu lesser general public license version 3"),
    ("agpl3.name", "licensed under the gnu affero general public license version 3"),
    ("bsd.redistribution",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("bsd.source",
     "redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer"),
    ("bsd.binary",
     "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
     "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd.endorse",
     "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission"),
    ("bsd2.name", "licensed under the bsd 2 clause license"),
    ("bsd3.name", "licensed under the bsd 3 clause license"),
    ("mpl2.form",
     "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("mpl2.copy",
     "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0"),
    ("mpl2.copy",
     "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2.0"),
    ("mpl2.name", "licensed under the mozilla public license version 2.0"),
    ("isc.grant",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc.as.is",
     "the software is provided as is and the author disclaims all warranties with regard to this software including all "
     "implied warranties of merchantability and fitness"),
    ("ccby4.name", "licensed under cc by 4.0"),
    ("ccby4.name", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("ccbysa4.name", "licensed under cc by sa 4.0"),
    ("ccbync4.name", "licensed under cc by nc 4.0"),
    ("ccbyncsa4.name", "licensed under cc by nc sa 4.0"),
    ("ccbynd4.name", "licensed under cc by nd 4.0"),
    ("cc0.name", "licensed under cc0 1.0"),
    ("cc0.name", "this work is dedicated to the public domain under cc0 1.0"),
    ("unlicense.free", "this is free and unencumbered software released into the public domain"),
    ("unlicense.anyone",
     "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
     "as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("reserved", "all rights reserved"),
)

# How a notice of the GNU licences begins, and how it may go on after that, up to any of these.
_GNU_HEADS = (
    ("GPL-3.0-or-later", ("gpl.program", "gpl3+.terms")),
    ("GPL-3.0-or-later", ("gpl.program", "gpl.terms", "any.later.3")),
    ("GPL-2.0-or-later", ("gpl.program", "gpl2+.terms")),
    ("GPL-2.0-or-later", ("gpl.program", "gpl.terms", "any.later.2")),
    ("GPL-3.0-only", ("gpl.program", "gpl3.terms")),
    ("GPL-2.0-only", ("gpl.program", "gpl2.terms")),
    ("LGPL-3.0-or-later", ("gpl.library", "lgpl3+.terms")),
    ("LGPL-3.0-or-later", ("gpl.program", "lgpl3+.terms")),
    ("LGPL-3.0-or-later", ("gpl.library", "lgpl.terms", "any.later.3")),
    ("LGPL-2.1-or-later", ("gpl.library", "lgpl2.1+.terms")),
    ("LGPL-2.1-or-later", ("gpl.library", "lgpl.terms", "any.later.2.1")),
    ("AGPL-3.0-or-later", ("gpl.program", "agpl3+.terms")),
    ("AGPL-3.0-or-later", ("gpl.program", "agpl.terms", "any.later.3")),
)
_GNU_TAIL = ("gpl.hope", "gpl.implied", "gpl.see", "gpl.received", "gpl.if.not")

# Rules in the order in which they are tried; longer sequences first.
RULES = (
    ("MIT", ("mit.title", "mit.grant", "mit.notice", "mit.warranty", "mit.liability")),
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty", "mit.liability")),
    ("Apache-2.0", ("apache2.name", "apache2.comply", "apache2.obtain", "apache2.url", "apache2.basis", "apache2.see")),
    ("Apache-2.0", ("apache2.name", "apache2.comply", "apache2.where", "apache2.basis", "apache2.see")),
    *((name, head + _GNU_TAIL[:n]) for n in range(len(_GNU_TAIL), -1, -1) for name, head in _GNU_HEADS),
    ("BSD-3-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary", "bsd.endorse")),
    ("BSD-2-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary")),
    ("MPL-2.0", ("mpl2.form", "mpl2.copy")),
    ("ISC", ("isc.grant", "isc.as.is")),
    ("Unlicense", ("unlicense.free", "unlicense.anyone")),
    ("MIT", ("mit.name",)),
    ("MIT", ("mit.title",)),
    ("Apache-2.0", ("apache2.name",)),
    ("GPL-3.0-or-later", ("gpl3+.terms",)),
    ("GPL-2.0-or-later", ("gpl2+.terms",)),
    ("GPL-3.0-only", ("gpl3.name",)),
    ("GPL-2.0-only", ("gpl2.name",)),
    ("LGPL-3.0-only", ("lgpl3.name",)),
    ("AGPL-3.0-only", ("agpl3.name",)),
    ("BSD-3-Clause", ("bsd3.name",)),
    ("BSD-2-Clause", ("bsd2.name",)),
    ("MPL-2.0", ("mpl2.form",)),
    ("MPL-2.0", ("mpl2.name",)),
    ("ISC", ("isc.grant",)),
    ("CC-BY-4.0", ("ccby4.name",)),
    ("CC-BY-SA-4.0", ("ccbysa4.name",)),
    ("CC-BY-NC-4.0", ("ccbync4.name",)),
    ("CC-BY-NC-SA-4.0", ("ccbyncsa4.name",)),
    ("CC-BY-ND-4.0", ("ccbynd4.name",)),
    ("CC0-1.0", ("cc0.name",)),
    ("Unlicense", ("unlicense.free",)),
    ("LicenseRef-all-rights-reserved", ("reserved",)),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = "\u0001"
# Replacements that put CUT where a sentence ends: after an end mark with white space behind it, but not in "v. 2.0" nor
# where semicolons begin a line as comment signs, and at lines that are empty or hold comment signs only.
SENTENCE_CUTS = (
    (r"\n[ \t\r]*;+[ \t]", "\n "),
    (r"\bv\.([ \t\r\n]+[0-9])", "v$1"),
    (r"[.!?:;]+([ \t\r\n])", CUT + "$1"),
    (r"\n[ \t\r#*/;%-]*\n", CUT),
)
# Replacements that normalise a lower-case sentence; dots between digits survive as underscores at first.
NORMALISATION = (("_", " "), (r"([0-9])\.([0-9])", "$1_$2"), (r"([0-9])\.([0-9])", "$1_$2"), (r"[^a-z0-9_]+", " "))
IGNORED = r"^([0-9]*|[a-z]|copyright .*)$"
OTHER = "."


def anchors() -> list[str]:
    """A few words of letters such that every known sentence holds at least one of them."""
    left = [set(w for w in text.split() if w.isalpha()) for _, text in SENTENCES]
    chosen: list[str] = []
    while left:
        words = sorted(set().union(*left), key=lambda w: (-sum(w in s for s in left) * (len(w) > 6), -len(w), w))
        chosen.append(words[0])
        left = [s for s in left if words[0] not in s]
    return chosen


def _replaced(text: Column, steps: tuple[tuple[str, str], ...]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def sentence_ids(text: Column) -> Column:
    """Array of identifiers of the known sentences in order; ``.`` for each other sentence or line.

    A sentence over several lines is looked up as a whole first, then line by line, since a notice on a line of its
    own often follows a line without an end mark. Numbers, single letters and copyright lines are passed over.
    """
    known = F.create_map(*[F.lit(x) for name, sentence in SENTENCES for x in (sentence, name)])
    low = F.translate(text, UPPER, LOWER)

    def normalised(sentence: Column) -> Column:
        return F.replace(F.trim(_replaced(sentence, NORMALISATION)), F.lit("_"), F.lit("."))

    def looked_up(sentence: Column) -> Column:
        plain = normalised(sentence)
        return F.when(plain.rlike(IGNORED), F.lit("")).otherwise(F.coalesce(known[plain], F.lit(OTHER)))

    def of_sentence(sentence: Column) -> Column:
        whole = looked_up(sentence)
        return F.when(whole != OTHER, F.array(whole)).otherwise(F.transform(F.split(sentence, "\n"), looked_up))

    sentences = F.split(_replaced(low, SENTENCE_CUTS), CUT)
    found = F.filter(F.flatten(F.transform(sentences, of_sentence)), lambda name: name != "")
    worth_it = F.lit(False)
    for word in anchors():
        worth_it |= F.contains(low, F.lit(word))
    return F.when(worth_it, found).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column) -> Column:
    """The identifiers as one string in which every sequence that a rule fits is replaced by ``{licence}``."""
    line = F.array_join(F.transform(ids, lambda name: F.concat(F.lit("|"), name, F.lit("|"))), "")
    for licence, sequence in RULES:
        line = F.replace(line, F.lit("".join(f"|{name}|" for name in sequence)), F.lit("{" + licence + "}"))
    return line


def recognise_licences(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licences, unmatched`` for every row of ``docs(doc_id, text, ...)``.

    Each of the three is a list joined by commas, in order of the text (``licences`` without repeats); empty strings
    when there is nothing, also for null and empty texts. Null ids and repeated rows are kept row by row. Texts
    without any word that all known sentences share are not cut. Nothing is shuffled.
    """
    ids = docs.select(
        F.col("doc_id").cast("bigint"), sentence_ids(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("ids")
    )
    matched = ids.withColumn("line", match_rules(F.col("ids")))
    licences = F.array_distinct(F.regexp_extract_all("line", F.lit(r"\{([^}]*)\}"), F.lit(1)))
    unmatched = F.regexp_extract_all("line", F.lit(r"\|([a-z0-9+.]*[a-z0-9+])\|"), F.lit(1))
    return matched.select(
        "doc_id",
        F.array_join(F.filter("ids", lambda name: name != OTHER), ",").alias("sentence_ids"),
        F.array_join(licences, ",").alias("licences"),
        F.array_join(unmatched, ",").alias("unmatched"),
    )
