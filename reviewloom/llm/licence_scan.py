"""Licence scan by sentence-rule recognition.

A text is cut into sentences, which are normalised (lower case, letters and digits
only) and mapped to identifiers of known licence sentences. The identifiers of a
document, in the order of the text, are then held against ordered rules: the first
rule that matches names the licence, is taken out of the sequence, and the rules go
on with what is left. Identifiers that no rule takes are reported as unmatched.

Sentences are read twice: line by line, and with the lines of a paragraph joined, so
that wrapped notices and one-line notices inside other text are both found. A stop
inside a known sentence ("v. 2.0") ends no sentence.

Main path: DataFrame functions only, one projection per row without a shuffle. The
sentence table is a fixed list, so its size is proven.

Defined cases: a null or empty text has no sentence and no licence (null); repeated
rows are read one by one; other columns may have any name.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of the usual notices, and their identifiers.
SENTENCES = (
    ("MIT_NOTE", "Released under the MIT License"),
    ("MIT_NOTE", "Licensed under the MIT License"),
    ("MIT_NOTE", "This project is licensed under the MIT License"),
    ("MIT_TITLE", "The MIT License"),
    ("MIT_TITLE", "MIT License"),
    ("MIT_GRANT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MIT_CONDITION", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("AS_IS_SOFTWARE", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("APACHE2_NOTE", "Licensed under the Apache License, Version 2.0"),
    ("APACHE2_NOTE", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("APACHE2_NOTE", "Released under the Apache License, Version 2.0"),
    ("APACHE2_USE", "you may not use this file except in compliance with the License"),
    ("APACHE2_USE", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("APACHE2_COPY", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("APACHE2_AS_IS", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("APACHE2_SEE", "See the License for the specific language governing permissions and limitations under the License"),
    ("GPL3_NOTE", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL3_NOTE", "Licensed under the GNU General Public License, version 3"),
    ("GPL2_NOTE", "Licensed under the GNU General Public License, version 2"),
    ("GPL_FREE", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL2_FREE", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL_HOPE", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("GPL_SEE", "See the GNU General Public License for more details"),
    ("BSD_GRANT", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD_SOURCE", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSD_BINARY", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BSD_ENDORSE", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC_BY_NC4_NOTE", "Licensed under CC BY-NC 4.0"),
    ("CC_BY_SA4_NOTE", "Licensed under CC BY-SA 4.0"),
    ("CC_BY4_NOTE", "Licensed under CC BY 4.0"),
    ("CC0_NOTE", "Licensed under CC0 1.0"),
    ("CC_BY_NC4_NOTE", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC_BY_SA4_NOTE", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC_BY4_NOTE", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("MPL2_NOTE", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("PUBLIC_DOMAIN", "This work is dedicated to the public domain"),
    ("RIGHTS_RESERVED", "All rights reserved"),
)
# Rules over identifier sequences, tried in this order; "*" may be there or not.
RULES = (
    ("BSD-3-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY BSD_ENDORSE"),
    ("BSD-2-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY"),
    ("MIT", "MIT_TITLE* MIT_GRANT MIT_CONDITION* AS_IS_SOFTWARE*"),
    ("MIT", "MIT_NOTE"),
    ("MIT", "MIT_TITLE"),
    ("Apache-2.0", "APACHE2_NOTE* APACHE2_USE APACHE2_COPY* APACHE2_AS_IS* APACHE2_SEE*"),
    ("Apache-2.0", "APACHE2_NOTE APACHE2_COPY* APACHE2_AS_IS* APACHE2_SEE*"),
    ("GPL-3.0-or-later", "GPL_FREE GPL_HOPE* GPL_SEE*"),
    ("GPL-2.0-or-later", "GPL2_FREE GPL_HOPE* GPL_SEE*"),
    ("GPL-3.0-only", "GPL3_NOTE GPL_SEE*"),
    ("GPL-2.0-only", "GPL2_NOTE GPL_SEE*"),
    ("MPL-2.0", "MPL2_NOTE"),
    ("CC-BY-NC-4.0", "CC_BY_NC4_NOTE"),
    ("CC-BY-SA-4.0", "CC_BY_SA4_NOTE"),
    ("CC-BY-4.0", "CC_BY4_NOTE"),
    ("CC0-1.0", "CC0_NOTE"),
    ("Public-Domain", "PUBLIC_DOMAIN"),
    ("All-Rights-Reserved", "RIGHTS_RESERVED"),
)


def normal(sentence: str) -> str:
    """Python twin of ``_normal``, for the fixed tables."""
    return re.sub(r"[^\w]+|_", " ", sentence.lower(), flags=re.ASCII).strip()


def _normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def _inner_stops(sentences) -> list[str]:
    """Pieces of the known sentences that end in a stop before white space, as patterns: whatever was known up to there."""
    return sorted({r"[^a-z0-9]+".join(normal(s[: m.start()]).split()) for _, s in sentences for m in re.finditer(r"[.](?=\s+\S)", s)})


def _sentences(text: Column, inner: list[str]) -> Column:
    """Pieces between line ends and sentence ends (a stop before white space), where no known sentence has its stop."""
    for start in inner:
        text = F.regexp_replace(text, rf"(?i)(?<![a-z0-9])({start})[.](?=[^\S\n]+\S)", "$1 ")
    return F.split(text, r"[.](?=\s|$)|\n")


def _known(sentences: Column, ids: Column) -> Column:
    """Identifiers of the sentences that are known, in their order."""
    return F.filter(F.transform(sentences, lambda s: F.when(F.length(s) >= 9, F.element_at(ids, _normal(s)))), lambda x: x.isNotNull())


def _rule_pattern(rule: str) -> str:
    """A rule as a pattern over a text in which every identifier stands as `` <ID>``."""
    return "".join(f"(?: <{x[:-1]}>)?" if x.endswith("*") else f" <{x}>" for x in rule.split())


def scan_licences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sentences=SENTENCES, rules=RULES) -> DataFrame:
    """One row per document: id, sentence_ids, licences, licence (the first rule that matched) and unmatched identifiers."""
    ids = F.from_json(F.lit(json.dumps({normal(s): i for i, s in sentences})), "map<string,string>")
    inner = _inner_stops(sentences)
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    joined = F.regexp_replace(F.regexp_replace("text", r"\n[ \t]*\n", ".\n\n"), r"(?<!\n)\n[ \t]*(?:[*#]|//)?[ \t]*(?!\n)", " ")
    rows = rows.select("id", _known(_sentences(F.col("text"), inner), ids).alias("by_line"), _known(_sentences(joined, inner), ids).alias("by_paragraph"))
    # what only one reading sees goes behind what the other one sees
    longer = F.when(F.size("by_paragraph") > F.size("by_line"), F.col("by_paragraph")).otherwise(F.col("by_line"))
    shorter = F.when(F.size("by_paragraph") > F.size("by_line"), F.col("by_line")).otherwise(F.col("by_paragraph"))
    rows = rows.select("id", F.concat(longer, F.array_except(shorter, longer)).alias("sentence_ids"))
    rest = F.concat(F.array_join(F.transform("sentence_ids", lambda x: F.concat(F.lit(" <"), x, F.lit(">"))), ""), F.lit(""))
    rows = rows.withColumn("rest", rest).withColumn("found", F.array().cast("array<string>"))
    for name, rule in rules:
        pattern = _rule_pattern(rule)
        rows = rows.select(
            "id", "sentence_ids", F.regexp_replace("rest", pattern, "").alias("rest"),
            F.when(F.col("rest").rlike(pattern), F.array_union("found", F.array(F.lit(name)))).otherwise(F.col("found")).alias("found"))
    return rows.select(
        F.col("id").alias(id_col), "sentence_ids", F.col("found").alias("licences"), F.get("found", F.lit(0)).alias("licence"),
        F.filter(F.split(F.regexp_replace("rest", "[<>]", ""), " "), lambda x: x != "").alias("unmatched"))
