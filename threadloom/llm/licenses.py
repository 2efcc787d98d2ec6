"""Operator 8: licences of files, by built-in column functions alone.

Sparse TF-IDF vectors are compared with templates by their cosine; terms outside the templates weigh as the rarest of
these. First a whole file's vector, with the full texts of short licences (FILES). Then, unless that is similar, blocks
of its text (between blank lines) and their pieces (lines and sentences, at most PIECE_WORDS words each) that speak of
licences, with licence headers, notices, titles and SPDX tags (TEMPLATES). In a block that is similar to a template as a
whole, pieces count only for the same licence, so a wrapped header isn't judged by one of its lines. A file's licence is
that of its most similar block or piece. A licence file - by its name, by its whole text, or because at least half its
words stand in such pieces - gives its licence to its directory; a file without a licence takes that of the nearest
directory above it which has one, by joins of directories, each directory once.

Defined cases: a null or empty text has no licence of its own; a null path has no directory and inherits nothing; of
several licence files in a directory the most similar counts, then the one with the first path; of templates that tie,
the first by name; repeated rows are treated alike; an empty table gives an empty table; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

THRESHOLD = 0.6

# Names of licences and their usual notices.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("EPL-2.0", "Made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_TITLES = {
    "AGPL-3.0": "GNU Affero General Public License Version 3", "Apache-2.0": "Apache License Version 2.0", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
    "EPL-2.0": "Eclipse Public License Version 2.0", "GPL-2.0": "GNU General Public License Version 2", "GPL-3.0": "GNU General Public License Version 3", "ISC": "ISC License",
    "LGPL-2.1": "GNU Lesser General Public License Version 2.1", "LGPL-3.0": "GNU Lesser General Public License Version 3", "MIT": "MIT License", "MPL-2.0": "Mozilla Public License Version 2.0",
}
_SPDX = sorted({name for name, _ in TEMPLATES})
_GNU = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
TEMPLATES += [(name, f"SPDX-License-Identifier: {tag}") for name in _SPDX for tag in ([name, f"{name}-only", f"{name}-or-later"] if "GPL" in name else [name])]
TEMPLATES += list(_TITLES.items())
TEMPLATES += [(name, f"Licensed under {name}") for name in _SPDX]
TEMPLATES += [(name, _GNU.format(what, kind, version)) for name, kind, version in (("AGPL-3.0", "Affero ", 3), ("GPL-2.0", "", 2), ("GPL-3.0", "", 3), ("LGPL-2.1", "Lesser ", 2.1), ("LGPL-3.0", "Lesser ", 3)) for what in ("program", "library")]
# The full texts of short licences, without their titles and copyright lines.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NO_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
FILES = [
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format(_NO_NAME)),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
     ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
     " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
FILE_THRESHOLD = 0.75
#: A text of more words is more than such a licence and is judged by its blocks.
FILE_WORDS = 1000
FILE_SPEAKS = r"(?i)redistribution and use|permission (is hereby|to use)|unencumbered"
#: Longer pieces are compared in parts, so that counting their terms takes bounded time; longer blocks by their pieces.
PIECE_WORDS = 300
SPEAKS = r"(?i)licen[cs]e|spdx|public domain|permission (is hereby|to use)|redistribut|unencumbered"
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
_SPLIT = r"[^a-z0-9.+]+"


def terms(text: str) -> list[str]:
    import re

    return [t for t in (x.strip(".") for x in re.split(_SPLIT, text.lower())) if t]


def _terms(piece: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(piece), _SPLIT), lambda t: F.regexp_replace(t, r"^\.+|\.+$", "")), lambda t: t != "")


def template_model(templates=None):
    """(idf by term, idf of unknown terms, [(name, {term: weight}, norm)])."""
    counted = [(name, Counter(terms(text))) for name, text in templates or TEMPLATES]
    n, df = len(counted), Counter(t for _, c in counted for t in c)
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in df.items()}
    out = []
    for name, c in sorted(counted, key=lambda x: x[0]):
        w = {t: k * idf[t] for t, k in c.items()}
        out.append((name, w, math.sqrt(sum(x * x for x in w.values()))))
    return idf, math.log(1 + n) + 1, out


def _literal_map(values: dict[str, float]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*map(F.lit, values.values())))


def best_template(piece: Column, templates=None) -> Column:
    """struct(score, name) of the template most similar to a piece."""
    idf, unknown, model = template_model(templates)
    weights = _literal_map(idf)
    tf = lambda t, all_: F.size(F.filter(all_, lambda x: x == t)).cast("double")
    own = F.transform(F.array(_terms(piece)), lambda all_: F.transform(F.array_distinct(all_), lambda t: F.struct(t.alias("t"), (tf(t, all_) * F.coalesce(F.try_element_at(weights, t), F.lit(unknown))).alias("w"))))[0]
    table_ = F.array(*(F.struct(F.lit(name).alias("name"), _literal_map(w).alias("w"), F.lit(norm).alias("norm")) for name, w, norm in model))

    def scored(vector):
        length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))

        def one(m, k):
            dot = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x["w"] * F.coalesce(F.try_element_at(m["w"], x["t"]), F.lit(0.0)))
            return F.struct(F.when(length > 0, F.round(dot / (length * m["norm"]), 9)).otherwise(F.lit(0.0)).alias("score"), (-k).alias("turn"), m["name"].alias("name"))

        return F.array_max(F.transform(table_, one))

    return F.transform(F.array(own), scored)[0]


def scan_licenses(files: DataFrame, threshold: float = THRESHOLD, templates=None, file_templates=None) -> DataFrame:
    """`files` (doc_id, path, text): doc_id, path, license, score, origin (header, inherited, none), given_by."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = files.select("doc_id", F.col("path").cast("string").alias("path"), text.alias("text"))
    n_words = lambda c: F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+"))
    speaks = F.col("text").rlike(SPEAKS)
    nothing = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("turn"), F.lit("").alias("name"))
    blocks = F.filter(F.split("text", r"\r?\n[ \t*/#;!%<>-]*\r?\n"), lambda b: b.rlike(SPEAKS))
    rows = rows.withColumn("words", n_words("text"))
    whole = F.when(speaks & F.col("text").rlike(FILE_SPEAKS) & (F.col("words") <= FILE_WORDS), best_template(F.col("text"), file_templates or FILES)).otherwise(nothing)
    rows = rows.withColumn("file", whole).withColumn("is_file", F.col("file.score") >= FILE_THRESHOLD)
    rows = rows.select("doc_id", "path", "file", "is_file", F.when(speaks & ~F.col("is_file"), blocks).otherwise(F.array().cast("array<string>")).alias("blocks"), "words")
    hit = lambda p: F.struct(best_template(p, templates).alias("best"), n_words(p).alias("words"))
    none = F.struct(nothing.alias("best"), F.lit(0).alias("words"))
    parts = rf"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){{1,{PIECE_WORDS}}}+"
    pieces = lambda b: F.filter(F.flatten(F.transform(F.split(b, "\n|(?<=\\.) "), lambda p: F.regexp_extract_all(p, F.lit(parts), 0))), lambda p: p.rlike(SPEAKS))
    judged = F.transform("blocks", lambda b: F.struct(F.when(n_words(b) <= PIECE_WORDS, hit(b)).otherwise(none).alias("whole"), F.filter(F.transform(pieces(b), hit), lambda h: h["best"]["score"] >= threshold).alias("parts")))
    rows = rows.withColumn("judged", judged)

    def hits(j):
        alike = j["whole"]["best"]["score"] >= threshold
        same = F.filter(j["parts"], lambda h: h["best"]["name"] == j["whole"]["best"]["name"])
        return F.when(alike, F.concat(F.array(j["whole"]), F.transform(same, lambda h: F.struct(h["best"].alias("best"), F.lit(0).alias("words"))))).otherwise(j["parts"])

    rows = rows.withColumn("hits", F.flatten(F.transform("judged", hits)))
    best = F.when(F.col("is_file"), F.col("file")).otherwise(F.array_max(F.transform("hits", lambda h: h["best"])))
    spoken = F.aggregate("hits", F.lit(0), lambda a, h: a + h["words"])
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    named = F.coalesce(F.regexp_replace("path", "^.*/", "").rlike(LICENSE_NAME), F.lit(False))
    gives = named | F.col("is_file") | (2 * spoken >= F.col("words")) & (F.col("words") > 0)
    found = rows.select("doc_id", "path", folder.alias("folder"), best["name"].alias("own"), best["score"].alias("own_score"), gives.alias("gives"))

    given = _folders(found)
    folders = found.where("own is null and folder is not null").select("folder").distinct()
    levels = F.filter(F.split("folder", "/"), lambda x: x.isNotNull())
    above = F.transform(F.sequence(F.lit(0), F.size(levels)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(levels, F.lit(1), k), "/").alias("at")))
    spread = folders.withColumn("up", F.explode(above)).select("folder", "up.depth", F.col("up.at").alias("at"))
    nearest = spread.join(given, spread["at"] == given["giver_folder"]).groupBy("folder").agg(F.max_by(F.struct("license", "score", "giver"), "depth").alias("i"))
    out = found.join(nearest.withColumnRenamed("folder", "_folder"), F.col("folder") == F.col("_folder"), "left")
    inherited = F.col("own").isNull() & F.col("i").isNotNull()
    return out.select(
        "doc_id",
        "path",
        F.coalesce("own", F.col("i")["license"]).alias("license"),
        F.coalesce("own_score", F.col("i")["score"]).alias("score"),
        F.when(F.col("own").isNotNull(), F.lit("header")).when(inherited, F.lit("inherited")).otherwise(F.lit("none")).alias("origin"),
        F.when(inherited, F.col("i")["giver"]).alias("given_by"),
    )


def _folders(found: DataFrame) -> DataFrame:
    """Of each directory with a licence file: giver_folder, license, score, giver (path)."""
    rank = F.struct((-F.col("own_score")).alias("s"), "path", "own")
    best = found.where("gives and own is not null and folder is not null").groupBy("folder").agg(F.min(rank).alias("g"))
    return best.select(F.col("folder").alias("giver_folder"), F.col("g.own").alias("license"), (-F.col("g.s")).alias("score"), F.col("g.path").alias("giver"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """Documents as files <source>/<lang>/<doc_id>.txt, a null source or lang as "-"."""
    docs = table(spark, sf_dir, "documents")
    level = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    path = F.concat_ws("/", level("source"), level("lang"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"))
