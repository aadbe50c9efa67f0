"""License scan by diagonal voting.

1. Spark joins the hashes of all rolling word k-grams of the documents to the
   positions of the templates' k-grams.
2. Hits vote for their offset diagonal (document place less template place):
   an unchanged copy of a template is one diagonal with all its votes.
3. Neighbouring diagonals that continue each other are merged and their votes
   added up; inserted or deleted words shift the diagonal.
4. A merged span goes on with as many votes as a copy keeps whose changed
   words are the share that may differ, k votes lost for each of them.
5. It is verified in the document's own text by its longest common
   subsequence of words with the template, over the template's whole extent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playstream.llm.common import as_bytes, row_key, slices, table
from playstream.llm.decontaminate import shingle_hashes, word_list

K = 3                # words of a k-gram
DRIFT = 4            # largest shift between neighbouring diagonals that are merged
FEW_PLACES = 1 << 18 # positions of the templates' k-grams that are broadcast at most (4 MB)
COVER = 0.8          # least share of a template's words that a verified span holds

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed notices by label.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
                   "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "cc-by-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "mit": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
            "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "If a copy of the MPL was not distributed with this file, You can obtain one at"],
}


def _grams(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            grams = [shingle_hashes(word_list(t), k) for t in as_bytes(b.column("text"))]
            offsets = np.cumsum([0, *map(len, grams)])
            values = pa.array(np.concatenate([*grams, np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], ["key", "grams"])

    key = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {key}, grams array<long>")


def least_votes(size: int, k: int = K) -> int:
    """Votes that a copy of a template of ``size`` words keeps at least, if
    ``COVER`` of its words are unchanged and each other takes ``k`` votes."""
    changed = size - math.ceil(COVER * size - 1e-9)
    return max(1, size - k + 1 - k * changed)


def spans(docs: DataFrame, templates: list[tuple[str, list[bytes]]], k: int = K) -> DataFrame:
    """Candidate spans ``(key, template, votes, start, stop)`` of ``docs(key, text)``:
    the words of the template's whole extent along the merged diagonals."""
    spark = docs.sparkSession
    places = [(int(h), n, at) for n, (_, words) in enumerate(templates)
              for at, h in enumerate(shingle_hashes(words, k).view(np.int64))]
    positions = spark.createDataFrame(places, "gram long, template int, at int")
    if len(places) <= FEW_PLACES:   # 16 bytes each; more are joined by shuffle
        positions = F.broadcast(positions)
    hits = _grams(docs, k).select("key", F.posexplode("grams").alias("place", "gram")).join(positions, "gram")
    diagonals = (hits.withColumn("diagonal", F.col("place") - F.col("at")).groupBy("key", "template", "diagonal")
                 .agg(F.count("*").alias("votes"), F.min("place").alias("first"), F.max("place").alias("last")))
    # a repeated template word run votes for other diagonals too; long gaps end a span
    rules = spark.createDataFrame([(n, len(words), least_votes(len(words), k)) for n, (_, words) in enumerate(templates)], "template int, size int, least int")
    if len(templates) <= FEW_PLACES:
        rules = F.broadcast(rules)
    # diagonals of one copy lie within its changes of each other, and begin within its length of the end of the one before
    w = Window.partitionBy("key", "template").orderBy("first", "diagonal")
    near = (F.abs(F.col("diagonal") - F.lag("diagonal").over(w)) <= DRIFT) & (F.col("first") - F.lag("last").over(w) <= F.col("size"))
    runs = (diagonals.join(rules, "template").withColumn("turn", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
            .withColumn("run", F.sum("turn").over(w)))
    merged = runs.groupBy("key", "template", "run", "size", "least").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("from"), F.max("diagonal").alias("to"))
    start = F.greatest(F.least(F.col("first") - k, F.col("from") - DRIFT), F.lit(0))
    return merged.where(F.col("votes") >= F.col("least")).select("key", "template", "votes", start.alias("start"),
                                                                 F.greatest(F.col("last") + 2 * k, F.col("to") + F.col("size") + DRIFT).alias("stop"))


def common_words(words: list, template: list) -> int:
    """Length of the longest common subsequence, by a bit per word of the template."""
    places: dict = {}
    for i, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << i
    row, full = (1 << len(template)) - 1, (1 << len(template)) - 1   # a bit is clear where the length goes up
    for w in words:
        if at := row & places.get(w, 0):
            row = ((row + at) | (row - at)) & full
    return len(template) - row.bit_count()


def licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per row of ``docs``.

    * places of the fixed phrases, by word; first_word and last_word are null
      without one;
    * labels: of fixed phrases, and of templates of which a span with enough
      votes (``least_votes``) holds ``COVER`` of the words in order;
    * score: 1 with a fixed phrase, else the best such share, else 0;
    * null and empty texts have no words; repeated rows get equal rows; other
      columns are ignored; an empty table gives an empty table."""
    known = [(label, word_list(t.encode())) for label, texts in (templates or TEMPLATES).items() for t in texts]
    phrases = [(p.encode().split(), label) for p, label in PHRASES.items()]
    rows = docs.select(row_key().alias("key"), "text")
    found = spans(rows, known).groupBy("key").agg(F.sort_array(F.collect_set(F.struct("template", "start", "stop"))).alias("spans")).withColumnRenamed("key", "found")
    joined = rows.join(found, rows["key"] == found["found"], "left").select(F.col("key.doc_id").alias("doc_id"), "text", "spans")
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def one(text: bytes, mine: list[dict]) -> tuple:
        words = word_list(text)
        flat = b" " + b" ".join(words) + b" "
        starts, labels = [], set()
        for phrase, label in phrases:
            if b" " + b" ".join(phrase) + b" " in flat:
                n = len(phrase)
                at = [i for i, w in enumerate(words) if w == phrase[0] and words[i:i + n] == phrase]
                starts += at
                labels.add(label)
        more, score = set(labels), float(bool(starts))
        for s in mine:
            label, template = known[s["template"]]
            share = common_words(words[s["start"]:s["stop"]], template) / len(template)
            if share >= COVER:
                more.add(label)
                score = max(score, share)
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(more)), score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = [one(t, s or []) for t, s in zip(as_bytes(b.column("text")), b.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id")] + [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))
