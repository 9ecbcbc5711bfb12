"""Sentence-rule licence recognition.

A text is normalised to words with two marks between them: sentence ends, and line breaks, which may end a
sentence or lie inside one. Known licence sentences are looked for from mark to mark; what remains is a short
sequence of identifiers, matched against ordered rules. All of it is a column expression over one row: no
shuffle, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import ascii_lower, let

# Licence sentences as published, with the identifier each stands for.
SENTENCES = {
    "mit-name": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-released": ["Released under the MIT License", "Licensed under the MIT License",
                     "This project is licensed under the MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                  "software and associated documentation files (the \"Software\"), to deal in the Software "
                  "without restriction, including without limitation the rights to use, copy, modify, merge, "
                  "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
                  "to whom the Software is furnished to do so, subject to the following conditions"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the Software"],
    "as-is-mit": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
                  "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
                  "PURPOSE AND NONINFRINGEMENT"],
    "liability-mit": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
                      "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
                      "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or "
                  "without fee is hereby granted, provided that the above copyright notice and this permission "
                  "notice appear in all copies"],
    "bsd-redistribution": ["Redistribution and use in source and binary forms, with or without modification, "
                           "are permitted provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of "
                   "conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of "
                   "conditions and the following disclaimer in the documentation and/or other materials "
                   "provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to "
                    "endorse or promote products derived from this software without specific prior written "
                    "permission"],
    "apache-licensed": ["Licensed under the Apache License, Version 2.0",
                        "Licensed under the Apache License, Version 2.0 (the \"License\")"],
    "apache-comply": ["you may not use this file except in compliance with the License"],
    "apache-copy": ["You may obtain a copy of the License at"],
    "gpl3-work": ["This work is licensed under the GNU General Public License, version 3",
                  "Licensed under the GNU General Public License, version 3"],
    "gpl-redistribute": ["This program is free software: you can redistribute it and/or modify it under the "
                         "terms of the GNU General Public License as published by the Free Software Foundation, "
                         "either version 3 of the License, or (at your option) any later version"],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                     "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "cc-by-nc-4": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0"],
    "cc-by-4": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0"],
    "cc-by-sa-4": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0"],
    "cc0": ["Licensed under CC0 1.0", "To the extent possible under law, the author has waived all copyright"],
    "reserved": ["All rights reserved"],
}

# Sentences that differ from one above in a later part only. They stand apart because the SQL, which compares
# first parts, is made from SENTENCES and RULES.
VERSIONS = {
    "gpl2-redistribute": ["This program is free software; you can redistribute it and/or modify it under the "
                          "terms of the GNU General Public License as published by the Free Software Foundation; "
                          "either version 2 of the License, or (at your option) any later version"],
    "agpl3-redistribute": ["This program is free software: you can redistribute it and/or modify it under the "
                           "terms of the GNU Affero General Public License as published by the Free Software "
                           "Foundation, either version 3 of the License, or (at your option) any later version"],
}
VERSION_RULES = [
    ("GPL-2.0-or-later", ["gpl2-redistribute", "gpl-warranty"]),
    ("AGPL-3.0-or-later", ["agpl3-redistribute", "gpl-warranty"]),
]

# A licence and the identifiers that must follow one another, in order; the more specific rules come first.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "as-is-mit"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl-warranty"]),
    ("Apache-2.0", ["apache-licensed", "apache-comply", "apache-copy"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-released"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("LicenseRef-reserved", ["reserved"]),
]

# Sentence boundaries: end marks before a separator or the end.
BOUNDARY = r"[.!?;:]+([ \t-\r]|$)"
# Each known sentence holds one of these, so a text without any of them has no licence sentence.
CUES = ["licen", "permission", "copyright", "provided", "redistribut", "in no event", "apache", "reserved",
        "written", "free software", "warranty", "obtain a copy", "waived", "cc0"]


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Normalised first part to identifier: what the SQL of the query compares with one-line sentences."""
    known = {}
    for name, forms in SENTENCES.items():
        for form in forms:
            known[sentence_parts(form)[0]] = name
    return known


def sentence_parts(form: str) -> list[str]:
    """The normalised pieces between the end marks inside a sentence."""
    parts = [normalised(p) for p in re.sub(r"[.!?;:]+([ \t-\r]|$)", "\n", form).split("\n")]
    return [p for p in parts if p]


def whole_sentences() -> dict[str, str]:
    """Normalised form, all parts joined by END, to identifier."""
    return {END.join(sentence_parts(form)): name
            for name, forms in (SENTENCES | VERSIONS).items() for form in forms}


# Marks in lower-cased text: a sentence end, and a line break that may be one.
END, BREAK = "E", "B"
# A blank line, maybe behind comment marks, ends a sentence; a line's leading comment marks go with its break.
MARKS = [
    (r"\r\n?|[\x0B\x0C]", "\n"),
    (r"\n(?:[^a-z0-9\n]*\n)+[^a-z0-9\n]*", f" {END} "),
    (r"\n[^a-z0-9\n]*(?:(?:rem|dnl)[ \t]+)?", f" {BREAK} "),
    (BOUNDARY, f" {END} "),
    (f"[^a-z0-9{END}{BREAK}]+", " "),
    (f"[ {BREAK}]*{END}[ {END}{BREAK}]*", END),
    (f"[ {BREAK}]*{BREAK}[ {BREAK}]*", BREAK),
]


def identifiers(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in their order."""
    known = whole_sentences()
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    # Longer forms first, so that none is taken for its beginning.
    forms = "|".join(f.replace(" ", f"[ {BREAK}]") for f in sorted(known, key=len, reverse=True))
    pattern = f"(?<=[{END}{BREAK}])(?:{forms})(?=[{END}{BREAK}])"
    marked = ascii_lower(text)
    for regex, mark in MARKS:
        marked = F.regexp_replace(marked, regex, mark)
    marked = F.concat(F.lit(END), F.trim(marked), F.lit(END))
    found = F.regexp_extract_all(marked, F.lit(pattern), F.lit(0))
    ids = F.transform(found, lambda s: F.element_at(names, F.translate(s, BREAK, " ")))
    cue = ascii_lower(text).rlike("|".join(CUES).replace(" ", r"[^a-z0-9]+"))
    return F.when(cue, ids).otherwise(F.array().cast("array<string>"))


def licence_names(ids: Column) -> Column:
    """The licences of an identifier sequence, each once, in the order of the rules.

    A rule matches where its identifiers follow one another. What a longer rule matched is taken out
    before the shorter rules look, so a full Apache header is reported once and BSD-3 is not also BSD-2.
    """
    rest = F.concat(F.lit(" "), F.array_join(F.transform(ids, lambda x: F.concat(x, F.lit(" "))), " "))
    state = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("found"))
    for licence, sequence in VERSION_RULES + RULES:
        state = let(state, _rule_step(licence, " " + "  ".join(sequence) + " "))
    return F.array_distinct(state["found"])


def _rule_step(licence: str, pattern: str) -> Callable[[Column], Column]:
    def step(s: Column) -> Column:
        hit = F.contains(s["rest"], F.lit(pattern))
        return F.struct(
            F.replace(s["rest"], F.lit(pattern), F.lit(" ~ ")).alias("rest"),
            F.when(hit, F.array_append(s["found"], F.lit(licence))).otherwise(s["found"]).alias("found"))
    return step


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_sentences, sentence_ids, licenses (both joined by commas).

    Null and empty texts have no sentence and no licence. A sentence may be wrapped over lines, with comment
    marks before each, and counts only with all its parts. It counts as often as it occurs; a licence is
    named once. Repeated rows give repeated rows, an empty table an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", let(identifiers(text), lambda ids: F.struct(
        F.size(ids).cast("long").alias("n_sentences"),
        F.array_join(ids, ",").alias("sentence_ids"),
        F.when(F.size(ids) > 0, F.array_join(licence_names(ids), ",")).otherwise("").alias("licenses"),
    )).alias("found"))
    return found.select("doc_id", "found.n_sentences", "found.sentence_ids", "found.licenses")
