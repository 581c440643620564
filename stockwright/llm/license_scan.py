"""License scans: diagonal voting of word k-grams against license templates.

Words of all templates are numbered; a text's words get these numbers (others none), and the rolling code of ``k``
numbers is exact, so equal codes are equal words. Codes that no template has cannot join, so the task that rolls them
drops them; the rest is joined by Spark to the template positions. A hit at word ``w`` of the text and ``t`` of the
template votes for the diagonal ``w - t``. Votes are summed per diagonal, neighbouring diagonals (words put in or left
out) are merged, and a merged span counts when enough of the template stands in it, a phrase only when all of it does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwright.llm.common import share, slices, strings, table, text_of, word_table
from stockwright.sources.tables import stage

# Phrases and the labels they give.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Beginnings of public license notices and the labels they give.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2.0 the license you may not use this file except in "
    "compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights "
    "to this work",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

PHRASE_GRAM, NOTICE_GRAM = 2, 4
SLACK = 3  # words put in or left out between neighbouring diagonals
LEAST_COVERAGE = 0.6  # of a notice's k-grams


class Templates:
    """Numbered words and the positions ``(code, template, position)`` of all k-grams."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str]):
        to_words = word_table()
        texts = [(label, phrase, True) for phrase, label in phrases.items()]
        texts += [(label, notice, False) for label, notice in notices.items()]
        self.numbers: dict[bytes, int] = {}
        self.rows: list[tuple[int, int, int]] = []
        self.described: list[tuple[int, str, bool, int, int]] = []  # template, label, phrase?, k, k-grams
        split = [text.encode().translate(to_words).split() for _, text, _ in texts]
        for words in split:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers))
        self.base = len(self.numbers) + 1
        for n, ((label, _, phrase), words) in enumerate(zip(texts, split)):
            k = PHRASE_GRAM if phrase else NOTICE_GRAM
            ids = np.array([self.numbers[w] for w in words], np.int64)
            codes = self.codes(ids, k)
            self.rows += [(int(code), n, at) for at, code in enumerate(codes)]
            self.described.append((n, label, phrase, k, len(codes)))
        self.known = np.unique(np.array([r[0] for r in self.rows], np.int64))

    def codes(self, ids: np.ndarray, k: int) -> np.ndarray:
        """Rolling codes of ``k`` word numbers; -1 where a word has no number. The last digit tells ``k``."""
        size = len(ids) - k + 1
        if size <= 0:
            return np.empty(0, np.int64)
        code, gap = np.zeros(size, np.int64), np.zeros(size, bool)
        for i in range(k):
            part = ids[i : i + size]
            code = code * self.base + part + 1
            gap |= part < 0
        return np.where(gap, -1, code * 10 + k)


def votes(docs: DataFrame, templates: Templates, keep: tuple[str, ...]) -> DataFrame:
    """Kept columns, ``n_words`` and ``hits`` (word position, code) of every row; the k-grams of whole texts."""
    shared = share(docs.sparkSession, templates)
    kept = docs.select(*[docs[c] for c in keep], text_of(docs).alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name != "_text")
    pairs = pa.list_(pa.struct([("at", pa.int32()), ("code", pa.int64())]))

    def roll(batches):
        known = shared()
        get = known.numbers.get
        to_words = word_table()
        for batch in slices(batches):
            counts, hits = [], []
            for text in strings(batch.column(batch.num_columns - 1)):
                words = text.encode("utf-8", "surrogatepass").translate(to_words).split()
                ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                row = []
                for k in (PHRASE_GRAM, NOTICE_GRAM):
                    codes = known.codes(ids, k)
                    places = np.flatnonzero(codes >= 0)
                    places = places[np.isin(codes[places], known.known)]
                    row += [{"at": int(p), "code": int(codes[p])} for p in places]
                counts.append(len(words))
                hits.append(row)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(hits, pairs)],
                names=[*batch.schema.names[:-1], "n_words", "hits"],
            )

    return kept.mapInArrow(roll, f"{fields}n_words long, hits array<struct<at:int,code:long>>")


def spans(voted: DataFrame, templates: Templates, slack: int = SLACK, least: float = LEAST_COVERAGE) -> DataFrame:
    """Verified spans ``_id, label, phrase, first_word, last_word, coverage`` of rows with ``_id`` and ``hits``.

    The table of template positions has a fixed size, so it is broadcast. Two diagonals are neighbours when they
    differ by at most ``slack``; a phrase has no neighbours.
    """
    spark = voted.sparkSession
    positions = spark.createDataFrame(templates.rows, "code long, template int, position int")
    described = spark.createDataFrame(templates.described, "template int, label string, phrase boolean, k int, grams int")
    hits = voted.where(F.size("hits") > 0).select("_id", F.explode("hits").alias("hit"))
    hits = hits.select("_id", F.col("hit.at").alias("at"), F.col("hit.code").alias("code"))
    joined = hits.join(F.broadcast(positions), "code").join(F.broadcast(described), "template")
    diagonals = joined.groupBy("_id", "template", "label", "phrase", "k", "grams", (F.col("at") - F.col("position")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    along = Window.partitionBy("_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("phrase"), 0).otherwise(slack)
    groups = diagonals.withColumn("begins", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "group", F.sum("begins").over(along)
    )
    merged = groups.groupBy("_id", "template", "label", "phrase", "k", "grams", "group").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    merged = merged.withColumn("coverage", F.least(F.col("votes") / F.col("grams"), F.lit(1.0)))
    whole = F.col("phrase") & (F.col("votes") == F.col("grams"))
    close = F.col("last") - F.col("first") < 2 * F.col("grams")
    partly = ~F.col("phrase") & (F.col("coverage") >= least) & close
    return merged.where(whole | partly).select(
        "_id",
        "label",
        "phrase",
        F.col("first").cast("long").alias("first_word"),
        (F.col("last") + F.col("k") - 1).cast("long").alias("last_word"),
        "coverage",
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document.

    A null text is empty, repeated rows are scanned each, no documents give no rows. ``score`` is the largest share
    of a template found in one verified span, 0 without one.
    """
    templates = Templates(PHRASES, NOTICES)
    docs = table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("_id"), "doc_id", "text")
    voted = stage(votes(docs, templates, ("_id", "doc_id")), "votes")
    base = F.when(F.col("phrase"), F.col("first_word"))

    def joined(labels):
        return F.array_join(F.array_sort(labels), ",")

    found = spans(voted, templates).groupBy("_id").agg(
        F.count_if("phrase").alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        joined(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    return voted.select("_id", "doc_id", "n_words").join(found, "_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
