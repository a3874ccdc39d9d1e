"""License scans by sentence rules.

A text is cut into sentences at full stops, semicolons and blank lines; a
sentence may be wrapped over lines, with comment leaders (any signs but letters
and digits) before them.  Its lines are normalised (words of letters and
digits, lower-cased), and each line, and each run of lines, of a sentence is
looked up among known license sentences, of which each has an identifier; of
those that begin at a line the longest counts, and none that begins inside
another.  The identifiers of a document, in order, are then matched with the
license rules in theirs: a rule names identifiers that must follow each other,
other known sentences may stand between.  A rule that matches uses its
sentences up, so the rules that come first, the more specific ones, win.  Sentences
are found with DataFrame functions; a document's identifiers meet the rules in one
pass for each rule, inside Arrow batches.

Defined results: nulls, empty texts and texts without a known sentence give no
row; known sentences that no rule uses are listed under ``rest``; repeated rows
count as one document; a null id is a document of its own; texts are read
whole; an empty table gives an empty table; only the id and text columns are
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sentences of public licenses and notices.
SENTENCES = {
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-only": "you may not use this file except in compliance with the License",
    "apache-asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit-line": "Released under the MIT License",
    "mit-under": "Licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                 "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the Software",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "ccbync-line": "Licensed under CC BY-NC 4.0",
    "ccby-line": "Licensed under CC BY 4.0",
    "ccbysa-line": "Licensed under CC BY-SA 4.0",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                          "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                 "(at your option) any later version",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                 "your option) any later version",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
}
# Identifiers of the public license list.
SPDX = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
        "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later",
        "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
        "MIT", "MIT-0", "MPL-2.0", "Unlicense", "WTFPL", "Zlib")
SENTENCES |= {f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}" for x in SPDX}
#: (license, identifiers in order), the more specific rules first
RULES = [
    ("Apache-2.0", ("apache-grant", "apache-only", "apache-asis")),
    ("Apache-2.0", ("apache-grant",)),
    ("Apache-2.0", ("apache-line",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-under",)),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-line",)),
    ("CC-BY-NC-4.0", ("ccbync-line",)),
    ("CC-BY-SA-4.0", ("ccbysa-line",)),
    ("CC-BY-4.0", ("ccby-line",)),
    ("CC0-1.0", ("cc0-line",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl2-form",)),
    ("LGPL-2.1-or-later", ("lgpl-free",)),
    ("AGPL-3.0-or-later", ("agpl-free",)),
    ("Unlicense", ("unlicense-free",)),
    *((x, (f"spdx-{x.lower()}",)) for x in SPDX),
]
#: what stands before the first letter or digit of a line: blanks, comment leaders
LEADERS = r"(?dm)^[^\p{L}\p{N}\n]+"
#: ends of sentences, once lines without words are empty
SPLIT = r"[.;][^\p{L}\p{N}\s]*\s+|\n\n+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def known_sentences(spark, sentences: dict[str, str]) -> DataFrame:
    """(sentence, sentence_id): the bounded table of literals."""
    rows = [F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for k, t in sentences.items()]
    return (spark.range(1).select(F.inline(F.array(*rows)))
            .select(normalised(F.col("t")).alias("sentence"), F.col("k").alias("sentence_id"))
            .groupBy("sentence").agg(F.min("sentence_id").alias("sentence_id")))


def beginnings(known: DataFrame) -> DataFrame:
    """(start, sentence, sentence_id, most): every sentence by each of its leading
    runs of words; ``most`` lines may hold it."""
    w = F.split("sentence", " ")
    return (known.where("sentence <> ''").withColumn("n", F.explode(F.sequence(F.lit(1), F.size(w))))
            .select(F.array_join(F.slice(w, F.lit(1), F.col("n")), " ").alias("start"), "sentence", "sentence_id",
                    (F.size(w) - F.col("n") + 1).alias("most")))


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
         sentences: dict[str, str] = SENTENCES, rules=tuple(RULES)) -> DataFrame:
    """(doc_id, sentences, licenses, rest): documents with known sentences;
    space-joined identifiers, comma-joined licenses, identifiers left over."""
    known = known_sentences(df.sparkSession, sentences)
    cut = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("key"), F.posexplode(
        F.split(F.regexp_replace(F.col(text), LEADERS, ""), SPLIT)).alias("position", "raw"))
    lines = (cut.select("doc_id", "key", "position", F.split("raw", "\n").alias("lines"))
             .select("doc_id", "key", "position", "lines", F.posexplode("lines").alias("line", "raw"))
             .select("doc_id", "key", "position", "lines", "line", normalised(F.col("raw")).alias("start")))
    # a line that begins a known sentence, then the lines that complete it
    runs = lines.join(F.broadcast(beginnings(known)), "start")
    runs = runs.withColumn("next", F.transform(F.slice("lines", F.col("line") + 1, F.col("most")), normalised))
    runs = runs.withColumn("ends", F.filter(F.sequence(F.lit(1), F.size("next")),
                                            lambda m: F.array_join(F.slice("next", F.lit(1), m), " ") == F.col("sentence")))
    runs = runs.where("size(ends) > 0").withColumn("last", F.col("line") + F.element_at("ends", 1) - 1)
    # of each line, the longest run that begins there, and whether it lies inside another
    held = runs.select("doc_id", "key", "position", "line", "last", "sentence_id", F.explode(F.sequence("line", "last")).alias("at"))
    hits = (held.groupBy("doc_id", "key", "position", "at").agg(
        F.max(F.when(F.col("at") == F.col("line"), F.struct("last", "sentence_id"))).alias("s"),
        F.max(F.col("at") != F.col("line")).alias("inside")).where("s is not null and not inside"))
    found = hits.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("position", "at", "s.sentence_id"))).alias("ids"))
    ids = found.select("doc_id", F.transform("ids", lambda x: x["sentence_id"]).alias("ids"))
    schema = T.StructType([ids.schema["doc_id"], *[T.StructField(c, T.StringType()) for c in ("sentences", "licenses", "rest")]])
    rules = [(name, tuple(steps)) for name, steps in rules]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(" ".join(i), ",".join(found), " ".join(rest))
                   for i in b.column(1).to_pylist() for found, rest in (matched(i, rules),)]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.string()) for c in columns]], names=schema.names)

    return ids.mapInArrow(apply, schema)


def matched(ids: Sequence[str], rules) -> tuple[list[str], list[str]]:
    """(licenses, identifiers left over): each rule takes its identifiers in
    order, from the left and as often as they are there (its matches do not
    interleave: the next one begins behind the last)."""
    found, rest = [], list(ids)
    for name, steps in rules:
        used, taken = [], []
        for at, sentence in enumerate(rest):
            if sentence == steps[len(taken)]:
                taken.append(at)
                if len(taken) == len(steps):
                    used += taken
                    taken = []
        if used:
            gone = set(used)
            rest = [x for at, x in enumerate(rest) if at not in gone]
            if name not in found:
                found.append(name)
    return found, rest
