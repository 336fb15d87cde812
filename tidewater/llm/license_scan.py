"""Licence scan (operator 10), DataFrame functions only.

Units of a text (each line, each paragraph of several lines, and the whole
text) are normalised to lower-case words of letters and digits. A unit is
compared with a licence template by the Dice coefficient over their sets of
word bigrams. Two sets can reach a coefficient t only if neither has more than
(2 - t) / t times the bigrams of the other, which rules most templates out
before any bigram is compared."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import let

LEAST = 0.8


@dataclass(frozen=True)
class Template:
    license_id: str
    text: str


# Public licence notices.
TEMPLATES = [
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "Licensed under the MIT License."),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
             "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
             "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
             "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
             "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
             "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
             "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
             "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
             "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
             "governing permissions and limitations under the License."),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
             "later version."),
    Template("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    Template("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
             "later version."),
    Template("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    Template("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
             "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    Template("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    Template("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
             "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
             "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
             "distribution."),
    Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0."),
    Template("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    Template("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
             "this work."),
    Template("Unlicense", "This is free and unencumbered software released into the public domain."),
    # bodies whose usual layout has several paragraphs, by paragraph
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
             "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    Template("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
             "the Software."),
    Template("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
             "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
             "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
             "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at"),
    Template("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
             "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
             "License for the specific language governing permissions and limitations under the License."),
    Template("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission."),
    Template("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
             "option) any later version."),
    Template("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
             "option) any later version."),
]


def normalised(text: str) -> list[str]:
    """Lower-case words of ASCII letters and digits."""
    import re

    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams(words: list[str]) -> list[str]:
    """The set of neighbouring pairs; a single word is its own pair."""
    return sorted({" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))}) if words else []


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(words)


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, least: float = LEAST, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``doc_id, unit, unit_no, template, license_id, dice`` for every unit
    (``line``, ``paragraph`` of two lines and more between blank lines, ``text``
    of two lines and more) and template that reach ``least``; unit_no counts
    from 0, template is its place in the list.

    Null and empty texts and units without a word match nothing; null and
    repeated ids stay; an empty table, or no templates, gives no rows; other
    columns are not read. The templates are a fixed list in the plan, and all
    work stays in the row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__tw_text"))
    as_units = lambda kind, texts: F.transform(texts, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.alias("unit_no"), x.alias("t")))
    paragraphs = F.split("__tw_text", "\n[ \t\r]*\n")
    none = F.array().cast("array<struct<unit:string,unit_no:int,t:string>>")
    units = F.concat(
        as_units("line", F.split("__tw_text", "\n")),
        F.filter(as_units("paragraph", paragraphs), lambda u: F.contains(u["t"], F.lit("\n"))),
        F.when(F.contains(F.col("__tw_text"), F.lit("\n")), as_units("text", F.array("__tw_text"))).otherwise(none))
    prepared = [(n, t.license_id, bigrams(normalised(t.text))) for n, t in enumerate(templates)]
    prepared = [p for p in prepared if p[2]]
    result = "array<struct<template:int,license_id:string,dice:double>>"
    if not prepared:
        return rows.select("doc_id", F.lit("").alias("unit"), F.lit(0).alias("unit_no"), F.lit(0).alias("template"),
                           F.lit("").alias("license_id"), F.lit(0.0).alias("dice")).where(F.lit(False))
    low = min(len(b) for *_, b in prepared) * least / (2 - least)
    high = max(len(b) for *_, b in prepared) * (2 - least) / least

    def compared(grams: Column) -> Column:
        size, out = F.size(grams), []
        for n, license_id, wanted in prepared:
            near = size.between(len(wanted) * least / (2 - least), len(wanted) * (2 - least) / least)
            shared = F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in wanted])))
            out.append(F.struct(F.lit(n).alias("template"), F.lit(license_id).alias("license_id"),
                                F.when(near, 2.0 * shared / (size + len(wanted))).otherwise(0.0).alias("dice")))
        return F.filter(F.array(*out), lambda x: x["dice"] >= least)

    def matched(unit: Column) -> Column:
        words = F.array_remove(F.split(F.regexp_replace(F.lower(unit["t"]), "[^a-z0-9]+", " "), " "), "")
        grams = let(words, _bigrams)
        some = let(grams, lambda g: F.when(F.size(g).between(low, high), compared(g)).otherwise(F.array().cast(result)))
        # so many bigrams need as many characters at least
        found = F.when(F.length(unit["t"]) >= int(2 * low), some).otherwise(F.array().cast(result))
        return F.transform(found, lambda f: F.struct(unit["unit"], unit["unit_no"], f["template"], f["license_id"], f["dice"]))

    return (rows.select("doc_id", F.explode_outer(F.flatten(F.transform(units, matched))).alias("f"))
            .where("f is not null").select("doc_id", "f.*"))
