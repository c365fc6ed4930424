"""License scans by diagonal voting.

Templates are word sequences: short phrases and license notices. The hashes of all
rolling two-word windows of a document are joined to template positions; a match at
document word p and template word t votes for the diagonal p - t. A phrase stands
where its diagonal has all its votes. For notices, neighbouring diagonals are merged,
so that inserted or dropped words do not break a span, and a span is verified: its
votes must cover at least half of the template, all of a short identifier, and it may not be
much longer than the part of the template it covers. Templates that differ in a few words
compete: of spans that overlap, those with the best cover stay, the longest of them, so
that the words in which variants differ decide. A template without a label takes
a span away from the others: a license that is named as not being the one.

The template table is a fixed list and is broadcast. Windows that match nothing
never leave their task; one sentinel row keeps each document.

Defined results: null, empty and one-word texts have no places and no labels, score
0; repeated rows are scanned alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlark.llm.common import ALNUM, as_long, grams, hashed_words, slices, text_bytes

GRAM = 2
#: Diagonals of one span lie at most this far apart.
REACH = 6
#: Votes a diagonal needs to count for a notice.
LEAST_VOTES = 3
COVER = 0.5

# Phrases with their labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Usual wording of license notices with their labels.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of "
        "the license at http www apache org licenses license 2 0",
    ),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation",
    ),
    (
        "agpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu affero general public license as published by the free software foundation",
    ),
    (
        "lgpl-notice",
        "this library is free software you can redistribute it and or modify it under the terms of "
        "the gnu lesser general public license as published by the free software foundation",
    ),
    (
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
    ),
    (
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    (
        "isc-notice",
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    (
        "cc-by-4.0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    (
        "cc-by-sa-4.0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ),
    (
        "cc-by-nc-4.0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ),
    (
        "cc-by-nd-4.0",
        "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
    ),
    (
        "cc-by-nc-sa-4.0",
        "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
    ),
    (
        "cc-by-nc-nd-4.0",
        "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
    ),
    ("", "not licensed under the apache license version 2 0"),
    ("", "not licensed under a creative commons attribution 4 0 international license"),
    (
        "warranty-disclaimer",
        "the software is provided as is without warranty of any kind express or implied",
    ),
]
# License identifiers after "SPDX-License-Identifier:".
IDENTIFIERS = (
    "MIT Apache-2.0 ISC 0BSD BSD-2-Clause BSD-3-Clause MPL-2.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later "
    "LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later"
).split()

SENTINEL = 0


def _scan(batches):
    for batch in batches:
        for part in slices(batch, 1):
            words, firsts = hashed_words(*text_bytes(part.column(1)), ALNUM)
            found, bounds = grams(words, firsts, GRAM)
            counts = np.diff(bounds) + 1  # with the sentinel at the end
            cuts = np.concatenate([[0], np.cumsum(counts)])
            values = np.zeros(cuts[-1], np.uint64)
            inner = np.ones(cuts[-1], bool)
            inner[cuts[1:] - 1] = False
            values[inner] = found
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(firsts)),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), as_long(values)),
                ],
                names=["id", "n_words", "grams"],
            )


def template_positions(spark: SparkSession, phrases=None, notices=None) -> DataFrame:
    """Rows (gram, template, t, size, label, phrase, least): all windows of all templates."""
    rows = [(SENTINEL, -1, 0, 0, "", True, 1.0)]
    listed = [(*x, True, 1.0) for x in phrases or PHRASES] + [(*x, False, COVER) for x in notices or NOTICES]
    if notices is None:
        listed += [(f"spdx:{x.lower()}", f"SPDX-License-Identifier: {x}", False, 1.0) for x in IDENTIFIERS]
    for number, (label, text, phrase, least) in enumerate(listed):
        words, firsts = hashed_words(*text_bytes(pa.array([text])), ALNUM)
        found = grams(words, firsts, GRAM)[0].view(np.int64).tolist()
        rows += [(g, number, t, len(found), label, phrase, least) for t, g in enumerate(found)]
    return spark.createDataFrame(
        rows, "gram long, template int, t int, size int, label string, phrase boolean, least double"
    )


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=None, notices=None
) -> DataFrame:
    """Per document its spans: id, n_words, places (starts and labels of phrases) and spans."""
    kind = docs.schema[key].dataType.simpleString()
    scanned = docs.select(key, text).mapInArrow(_scan, f"id {kind}, n_words long, grams array<long>")
    windows = scanned.withColumn("rid", F.monotonically_increasing_id()).select(
        "rid", "id", "n_words", F.posexplode("grams").alias("p", "gram")
    )
    templates = F.broadcast(template_positions(docs.sparkSession, phrases, notices))  # fixed list
    doc = ["rid", "id", "n_words"]
    about = ["template", "size", "label", "phrase", "least"]
    votes = (
        windows.join(templates, "gram")
        .withColumn("diagonal", F.when(F.col("template") >= 0, F.col("p") - F.col("t")))
        .groupBy(*doc, *about, "diagonal")
        .agg(F.count("*").alias("votes"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    )
    needed = F.when(F.col("phrase"), F.col("votes") >= F.col("size")).otherwise(
        F.col("votes") >= F.least(F.lit(LEAST_VOTES), F.col("size"))
    )
    votes = votes.filter((F.col("template") < 0) | needed)
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    far = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(order) > REACH)
    spans = votes.withColumn("fresh", F.coalesce(far, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("fresh").over(order))
    merged = spans.groupBy(*doc, *about, "span").agg(
        F.sum("votes").alias("votes"),
        F.min(F.col("diagonal") + F.col("t0")).alias("first_word"),
        F.max(F.col("diagonal") + F.col("t1") + 1).alias("last_word"),
        (F.max("t1") - F.min("t0") + 1).alias("part"),
    )
    cover = F.least(F.lit(1.0), F.col("votes") / F.greatest("size", F.lit(1)))
    stretched = (F.col("last_word") - F.col("first_word")) > 1.5 * F.col("part") + REACH
    verified = F.col("phrase") | ((cover >= F.col("least")) & ~stretched)
    rival = (F.col("template") >= 0) & ~F.col("phrase") & verified
    merged = merged.withColumns({"cover": cover, "rival": rival})
    # Spans that overlap are one island; the spans of a document come in the order of its words.
    before = Window.partitionBy("rid").orderBy("first_word", "last_word", "template")
    reached = F.max(F.when(F.col("rival"), F.col("last_word"))).over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("rival") & F.coalesce(F.col("first_word") >= reached, F.lit(True))
    merged = merged.withColumn("opens", opens.cast("int"))
    merged = merged.withColumn("island", F.sum("opens").over(before))
    merit = F.when(F.col("rival"), F.struct("cover", "size"))
    best = F.max(merit).over(Window.partitionBy("rid", "island"))
    stays = (F.col("phrase") & (F.col("template") >= 0)) | (F.col("rival") & (merit == best) & (F.col("label") != ""))
    merged = merged.withColumn("stays", F.coalesce(stays, F.lit(False)))
    found = F.when(F.col("stays"), F.struct("label", "first_word", "last_word", "cover"))
    return merged.groupBy(*doc).agg(        F.collect_list(F.when(F.col("phrase"), found)).alias("places"),
        F.collect_list(F.when(~F.col("phrase"), found)).alias("spans"),
    ).drop("rid")
