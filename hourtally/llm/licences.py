"""Licences by their sentences.

Sentences end with a full stop, question or exclamation mark or semicolon and white space, or
with a line that is blank but for comment signs. A line's end, a colon, or the full stop of
"v. 2.0" may end a sentence too, or stand inside it, so that notices are found in lines of any
width, with the signs of comments before them. Written
plainly (lower case, one blank for each run of anything but letters and digits), a
sentence that is known has a number; a document becomes the sequence of its numbers. A
rule is an ordered list of numbers: it holds if they occur in this order, with anything in
between. Nulls and empty texts have no sentences, so no licence. Repeated rows and sentences are
taken as they come; of known sentences that begin at one place the shorter is first. Extra columns stay. No row meets another, so nothing is shuffled.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence notices and texts, written plainly.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the apache license version 2 0",
    3: "licensed under cc by nc 4 0",
    4: "this work is licensed under the gnu general public license version 3",
    12: "the mit license mit",
    13: "mit license",
    14: "mit no attribution",
    15: "licensed under cc by 4 0",
    16: "licensed under cc by sa 4 0",
    20: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions",
    21: "the above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the software",
    22: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so",
    23: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal with the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions",
    24: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    25: "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    26: "bsd zero clause license",
    27: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    28: "permission to use copy modify and distribute this software and its documentation for any purpose without fee and "
    "without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the "
    "following two paragraphs appear in all copies",
    30: "licensed under the apache license version 2 0 the license",
    31: "you may not use this file except in compliance with the license",
    32: "you may obtain a copy of the license at",
    40: "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    41: "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer",
    42: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution",
    43: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission",
    44: "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    50: "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
    "the free software foundation either version 3 of the license or at your option any later version",
    51: "this program is free software",
    52: "this library is free software",
    53: "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
    "the free software foundation",
    54: "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
    "by the free software foundation",
    55: "either version 2 of the license or at your option any later version",
    56: "either version 2 1 of the license or at your option any later version",
    57: "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
    "by the free software foundation either version 3 of the license or at your option any later version",
    58: "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
    "by the free software foundation either version 3 of the license or at your option any later version",
    59: "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as "
    "published by the free software foundation",
    60: "this source code form is subject to the terms of the mozilla public license v 2 0",
    61: "the contents of this file are subject to the mozilla public license version 1 1 the license",
    62: "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
    "which is available at",
    63: "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
    "which is available at https",
    64: "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 "
    "which accompanies this distribution and is available at",
    65: "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 "
    "which accompanies this distribution and is available at http",
    66: "the contents of this file are subject to the terms of the common development and distribution license the license",
    67: "licensed under the eupl version 1 2",
    70: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    71: "this work is licensed under a creative commons attribution 4 0 international license",
    72: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    73: "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
    74: "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
    75: "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
    76: "this work is licensed under a creative commons attribution sharealike 3 0 unported license",
    80: "this is free and unencumbered software released into the public domain",
    81: "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to "
    "this software to the public domain worldwide",
    82: "distributed under the boost software license version 1 0",
    83: "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
    "transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
    "software is furnished to do so all subject to the following",
    84: "this software is provided as is without any express or implied warranty",
    85: "permission is granted to anyone to use this software for any purpose including commercial applications and to "
    "alter it and redistribute it freely subject to the following restrictions",
    86: "do what the fuck you want to public license",
    87: "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it "
    "is allowed as long as the name is changed",
    88: "this font software is licensed under the sil open font license version 1 1",
    89: "the artistic license 2 0",
    90: "this license governs use of the accompanying software",
    91: "if you use the software you accept this license",
}

# Licence, and the sentences that show it, in order.
RULES = (
    ("0BSD", (26, 27)),
    ("AGPL-3.0", (51, 58)),
    ("Apache-2.0", (2,)),
    ("Apache-2.0", (30, 31, 32)),
    ("Artistic-2.0", (89,)),
    ("BSD-2-Clause", (40, 41, 42)),
    ("BSD-3-Clause", (40, 41, 42, 43)),
    ("BSD-4-Clause", (40, 41, 42, 44)),
    ("BSL-1.0", (82,)),
    ("BSL-1.0", (83,)),
    ("CC-BY-4.0", (15,)),
    ("CC-BY-4.0", (71,)),
    ("CC-BY-NC-4.0", (3,)),
    ("CC-BY-NC-4.0", (70,)),
    ("CC-BY-NC-ND-4.0", (75,)),
    ("CC-BY-NC-SA-4.0", (74,)),
    ("CC-BY-ND-4.0", (73,)),
    ("CC-BY-SA-3.0", (76,)),
    ("CC-BY-SA-4.0", (16,)),
    ("CC-BY-SA-4.0", (72,)),
    ("CC0-1.0", (81,)),
    ("CDDL-1.0", (66, 31)),
    ("EPL-1.0", (64,)),
    ("EPL-1.0", (65,)),
    ("EPL-2.0", (62,)),
    ("EPL-2.0", (63,)),
    ("EUPL-1.2", (67,)),
    ("GPL-2.0", (51, 53, 55)),
    ("GPL-2.0", (51, 59)),
    ("GPL-3.0", (4,)),
    ("GPL-3.0", (51, 50)),
    ("ISC", (24,)),
    ("ISC", (25,)),
    ("LGPL-2.1", (52, 54, 56)),
    ("LGPL-3.0", (51, 57)),
    ("LGPL-3.0", (52, 57)),
    ("MIT", (1,)),
    ("MIT", (20, 21)),
    ("MIT", (12, 20, 21)),
    ("MIT", (13, 20, 21)),
    ("MIT-0", (14, 22)),
    ("MPL-1.1", (61,)),
    ("MPL-2.0", (60,)),
    ("MS-PL", (90, 91)),
    ("NCSA", (23,)),
    ("OFL-1.1", (88,)),
    ("PostgreSQL", (28,)),
    ("Unlicense", (80,)),
    ("WTFPL", (86, 87)),
    ("Zlib", (84, 85)),
)

# A licence is also shown by its identifier, "SPDX-License-Identifier: <name>"; those of the GNU licences end with one of
# two words. The numbers that the first ones have.
_NUMBERS = {
    "MIT": 5, "Apache-2.0": 6, "GPL-3.0-only": 7, "GPL-3.0-or-later": 8, "BSD-3-Clause": 9, "BSD-2-Clause": 10, "MPL-2.0": 11,
}


def _identifiers() -> tuple[dict[int, str], list[tuple[str, tuple[int, ...]]]]:
    sentences, rules = {}, []
    names = [(n, f"{n}{end}") for n in sorted({n for n, _ in RULES}) for end in (("-only", "-or-later") if "GPL" in n else ("",))]
    for place, (name, shown) in enumerate(names):
        number = _NUMBERS.get(shown, 200 + place)
        sentences[number] = "spdx license identifier " + re.sub("[^a-z0-9]+", " ", shown.lower())
        rules.append((name, (number,)))
    return sentences, rules


SENTENCES |= _identifiers()[0]
RULES += tuple(_identifiers()[1])

# Most known sentences hold one of these; texts without any mark are not written plainly.
MARKS = ("licen", "software", "copyright", "redistribut", "attribution")

# Steps from a text in lower case to plain words between S, where a sentence ends, and L,
# where one may end: pattern, what comes in its place, and whether the first group comes before that.
# Capital letters do not occur otherwise.
STEPS = (
    ("\r\n?", "\n", False),
    ("(^|\n)[ \t]*(?:rem|dnl)[ \t]+", "", True),
    # a line without words ends what is before it
    ("\n(?:[^a-z0-9\n]*\n)+", "; ", False),
    ("(^|[^a-z0-9])v[.][ \t\n]+", "v:", True),
    ("[.!?;]+[ \t\n]+", "S", False),
    ("[\n:]+", "L", False),
    ("[^a-z0-9SL]+", " ", False),
    ("[ L]*S[ SL]*", "S", False),
    (" *L[ L]*", "L", False),
)


def marks_of(sentences: dict[int, str]) -> list[str]:
    """Words one of which is in every sentence: the usual ones, and the longest of sentences without those."""
    marks = {mark for mark in MARKS if any(mark in plain for plain in sentences.values())}
    return sorted(marks | {max(plain.split(), key=len) for plain in sentences.values() if not any(mark in plain for mark in MARKS)})


def sentence_ids(text: Column, sentences: dict[int, str]) -> Column:
    """The numbers of the known sentences of a text, in order."""
    nothing = F.array().cast("array<int>")
    usable = {number: plain for number, plain in sorted(sentences.items()) if re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", plain)}
    if not usable:
        return nothing
    known = F.create_map(*(F.lit(x) for number, plain in usable.items() for x in (plain, number)))
    sizes: dict[str, set[int]] = {}
    for plain in usable.values():
        sizes.setdefault(plain.split()[0], set()).add(len(plain.split()))
    # How many words a sentence that begins with a word may have.
    by_first = F.create_map(*(x for w, n in sizes.items() for x in (F.lit(w), F.array(*map(F.lit, sorted(n))))))
    most = max(n for some in sizes.values() for n in some)
    lowered = F.lower(F.coalesce(text, F.lit("")))
    plainly = lowered
    for pattern, by, group in STEPS:
        plainly = F.regexp_replace(plainly, pattern, "$1" + by if group else by)

    def met(pieces: Column, j: Column) -> Column:
        """Numbers of the known sentences that begin with a piece and end with this or a later one."""
        counts = F.try_element_at(by_first, F.substring_index(F.get(pieces, j), " ", 1))

        def looked_up(there: Column) -> Column:
            words = F.translate(there, "L", " ")

            def number(count: Column) -> Column:
                plain = F.call_function("substring_index", words, F.lit(" "), count)
                ends = F.substring(there, F.length(plain) + 1, F.lit(1)).isin("L", "")
                return F.when(ends, F.try_element_at(known, plain))

            # A text of fewer words is looked up more than once.
            return F.array_distinct(F.transform(counts, number))

        after = F.array_join(F.slice(pieces, j + 1, F.lit(most)), "L")
        return F.when(counts.isNotNull(), F.flatten(F.transform(F.array(after), looked_up))).otherwise(nothing)

    def within(sentence: Column) -> Column:
        def each(pieces: Column) -> Column:
            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), lambda j: met(pieces, j)))

        return F.flatten(F.transform(F.array(F.split(sentence, "L")), each))

    numbers = F.flatten(F.transform(F.split(F.trim(plainly), "S"), within))
    marked = reduce(or_, (lowered.contains(mark) for mark in marks_of(usable)))
    return F.when(marked, F.filter(numbers, lambda x: x.isNotNull())).otherwise(nothing)


def recognised(docs: DataFrame, sentences: dict[int, str] | None = None, rules=RULES) -> DataFrame:
    """The rows with ``licences`` (distinct, sorted) and ``sentences`` (numbers in order).

    Columns that had these names are replaced.
    """
    numbers = sentence_ids(F.col("row.text"), SENTENCES if sentences is None else sentences)
    found = docs.select(F.struct("*").alias("row")).withColumn("ids", numbers)
    found = found.withColumn("line", F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))), ""))
    hits = [F.when(F.col("line").like("%" + "%".join(f"<{i}>" for i in ids) + "%"), name) for name, ids in rules]
    named = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))) if hits else F.array().cast("array<string>")
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("licences", "sentences")]
    return found.select(*kept, F.when(F.col("line") != "", named).otherwise(F.array().cast("array<string>")).alias("licences"), F.col("ids").alias("sentences"))
