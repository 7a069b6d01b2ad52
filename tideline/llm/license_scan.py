"""License scans: MinHash bands over overlapping text windows find templates; exact containment confirms them.

All in DataFrame functions. Words are lower-cased and freed of punctuation at their ends; shingles are word
pairs. A text is cut into blocks of BLOCK words that overlap by the longest template, so one very long text
is many rows. Inside a block, windows of WINDOW words begin at every STRIDE-th word. Templates are cut into
pieces of at most WINDOW - STRIDE + 1 words, one at every word, so a whole piece lies in some window:

    similarity of that window and a piece of m words >= (m - 1) / (WINDOW - 1)

BANDS bands of one row each then meet with probability 1 - (1 - s) ** BANDS: above 0.9999 for pieces of
5 words, the shortest template here. The band keys of the templates are few and are broadcast.
A window that meets a band is only a candidate: it counts if the words around it contain LIMIT of the
template's shingles, and all that the template must have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: the notices and clauses of common licenses, as they are written. Each row is found by itself, so any clause
# of a license shows it. A third value, where there is one, are words that must be among those found: they tell a
# notice from the like ones of a sister license.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT or Unlicense", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Attribution-NonCommercial 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Attribution 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Attribution-ShareAlike 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "version 3"),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version", "version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "version 2"),
    ("GPL-2.0", "either version 2 of the License, or (at your option) any later version", "version 2"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "GNU General"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "GNU Lesser"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "GNU Affero"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "person or organization"),
)
WINDOW, STRIDE = 8, 4
PIECE = WINDOW - STRIDE + 1
BANDS = 12
BLOCK = 2048
LIMIT = 0.8
GAPS = " \t\n\x0b\x0c\r,.;:!?()\"'*#"
#: The i-th band orders shingle hashes by their bits from bit TURN * i on, so bands depend on different bits.
TURN = 5


def words_of(text: Column) -> Column:
    # an empty word may begin or end the list; it only adds a shingle that no template has
    return F.split(F.lower(F.coalesce(text, F.lit(""))), "[" + GAPS.replace("\"", "\\\"") + "]+")


def _turned(h: Column, band: int) -> Column:
    """The hash rotated for a band."""
    return h if band == 0 else F.shiftleft(h, TURN * band).bitwiseOR(F.shiftrightunsigned(h, 64 - TURN * band))


def _pair_hashes(words: str) -> Column:
    """A hash for each pair of neighbouring words, in order."""
    return F.when(F.size(words) > 1, F.zip_with(
        F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.xxhash64(a, b))
    ).otherwise(F.array().cast("array<bigint>"))


def templates(spark: SparkSession, rows=TEMPLATES) -> DataFrame:
    table = spark.createDataFrame([(i, name, text, *(must or ("",))) for i, (name, text, *must) in enumerate(rows)],
                                  "template int, license string, text string, must string")
    for name in ("text", "must"):
        table = table.withColumn(f"{name}_words", F.filter(words_of(F.col(name)), lambda w: w != ""))
    return table.select("template", "license", F.size("text_words").alias("length"), _pair_hashes("text_words").alias("own"),
                        _pair_hashes("must_words").alias("must"))


def _keys(table: DataFrame) -> list[list[tuple[int, int]]]:
    """Per band the (key, template) pairs of all pieces. Templates are a parameter: a short list."""
    n = PIECE - 1
    piece = F.transform(F.sequence(F.lit(1), F.greatest(F.size("own") - (n - 1), F.lit(1))), lambda at: F.slice("own", at, n))
    cut = table.select("template", F.explode(piece).alias("piece"))
    keys = cut.select("template", *[F.array_min(F.transform("piece", lambda h: _turned(h, i))).alias(f"k{i}") for i in range(BANDS)]).collect()
    return [sorted({(row[f"k{i}"], row["template"]) for row in keys}) for i in range(BANDS)]


def found(docs: DataFrame, rows=TEMPLATES, limit: float = LIMIT) -> DataFrame:
    """(doc_id, license, containment): the best containment of any template of the license in a document.
    Documents without a license give no row.

    Null and empty texts hold none. Repeated rows of one doc_id are taken together; a null doc_id is one
    document. Templates need two words; rows are (license, text) or (license, text, words that must be found). Other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    table = templates(spark, rows)
    longest = table.agg(F.max("length")).first()[0]
    keys = _keys(table)
    size = F.size("words")  # an empty text is one empty word
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text").cast("string")).alias("words"))
    reach = longest + WINDOW
    # every window lies in the block that its first word belongs to; blocks take ``reach`` words more on both sides
    blocks = words.select("doc_id", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int")),
        lambda b: F.struct((F.greatest(b * BLOCK - reach, F.lit(0))).alias("from"), (b * BLOCK).alias("base"),
                           F.slice("words", F.greatest(b * BLOCK - reach, F.lit(0)) + 1, BLOCK + 2 * reach).alias("words")))).alias("b"))
    blocks = blocks.select("doc_id", (F.col("b.base") - F.col("b.from")).alias("skip"), F.col("b.words").alias("words"))
    hashed = blocks.select("doc_id", "skip", _pair_hashes("words").alias("h"))
    # a row for each window; the block's hashes are only copied into rows that pass the test
    last = F.least(F.col("skip") + BLOCK, F.size("h")) - 1
    at = F.sequence(F.col("skip"), F.greatest(last, F.col("skip")), F.lit(STRIDE))
    value = lambda a, j: F.get("h", a + j)
    windows = hashed.select("doc_id", "h", F.inline(F.transform(at, lambda a: F.struct(
        a.alias("at"), *[value(a, j).alias(f"x{j}") for j in range(WINDOW - 1)]))))
    turned = [F.expr(f"shiftleft(x{j}, {TURN} * band) | shiftrightunsigned(x{j}, 64 - {TURN} * band)") for j in range(WINDOW - 1)]
    banded = (windows.select("*", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
              .select("doc_id", "h", "at", "band", F.least(*turned).alias("key")))
    known = spark.createDataFrame([(i, k, t) for i in range(BANDS) for k, t in keys[i]], "on_band int, key long, template int")
    around = F.slice("h", F.greatest(F.col("at") + 2 - longest, F.lit(1)), longest + F.least(F.col("at") + 1, F.lit(longest - 1)) + WINDOW)
    # the join's table is bounded by the templates
    candidates = (banded.join(F.broadcast(known.join(F.broadcast(table), "template")), "key").where("band = on_band")
                  .select("doc_id", "license", "own", "must", around.alias("around")))
    share = F.size(F.array_intersect("own", "around")) / F.size(F.array_distinct("own"))
    return (candidates.where(F.size(F.array_except("must", "around")) == 0)
            .select("doc_id", "license", share.alias("share")).where(F.col("share") >= limit)
            .groupBy("doc_id", "license").agg(F.max("share").alias("containment")))
