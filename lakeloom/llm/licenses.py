"""License scans: MinHash bands over text windows find templates, shingle containment confirms them.

Texts and templates are compared as words: A-Z in lower case, punctuation and
comment marks as white space. Shingles are five words in a row. A template is
found in a document where a window holds at least ``contained`` of the template's
distinct shingles; the window is as long as the template, plus a margin of a
quarter (two shingles at least) on either side.

Windows of the template's length begin at every eighth of it. Those without any
shingle of a template hold none, so only the others get a MinHash signature. At
the least similarity a window at the nearest step can have (0.8 of the shingles,
one sixteenth out of step: Jaccard 0.58), ``BANDS`` bands of ``ROWS`` hashes meet
with a chance of more than 0.9999. Whatever meets is verified on the words
themselves, so nothing wrong is reported.

Templates of fewer than five words are one shingle of all their words and are
looked for as that. Defined results: null or empty texts hold nothing; several
occurrences in a document give one row, with the best containment and the first
place that has it; repeated rows are one document if their keys are equal (null
keys too); an empty table gives an empty result; extra columns are not read.
Texts are scanned whole, and everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import ascii_lower, filled, query, table

SHINGLE, BANDS, ROWS = 5, 28, 2
CUT = ".,;:!?()[]{}<>\"'`*#/\\|=_\t\n\x0b\x0c\r"

#: Sentences by which well-known licenses are named or opened.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
                  " the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Released under the MIT License.",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
                  " \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(ascii_lower(text), CUT, " " * len(CUT)), " +"), lambda w: w != "")


def shingles(words: Column, n: int) -> Column:
    """Hashes of every ``n`` words in a row."""
    last = F.size(words) - n
    hashed = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(n))))
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<long>"))


def bands(hashes: Column) -> Column:
    """The band keys of a set of shingles."""
    def least(k: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))

    return F.array(*(F.xxhash64(F.lit(b), *(least(b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)))


def prepared(spark, templates: dict[str, str]) -> DataFrame:
    """Per template: name, n (words of a shingle), length (shingles), exact (its distinct shingles as text), hashes."""
    rows = spark.createDataFrame(sorted(templates.items()), "template string, wording string")
    words = words_of(F.col("wording"))
    rows = rows.select("template", words.alias("words")).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(SHINGLE))
    sizes = rows.withColumn("n", n).withColumn("length", F.size("words") - F.col("n") + 1)
    exact = F.transform(F.sequence(F.lit(1), F.col("length")), lambda i: F.array_join(F.slice("words", i, F.col("n")), " "))
    hashes = F.coalesce(*(F.when(F.col("n") == k, shingles(F.col("words"), k)) for k in range(1, SHINGLE + 1)))
    return sizes.select("template", "n", "length", F.array_distinct(exact).alias("exact"), hashes.alias("hashes"))


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text", contained: float = 0.8) -> DataFrame:
    """Per document and template found in it: key, template, containment, first_word (from 0), n_words (of the window)."""
    spark = docs.sparkSession
    known = prepared(spark, templates or TEMPLATES)
    plan = known.select("n", "length", "hashes").collect()  # the caller's list of templates
    worded = docs.select(key, words_of(filled(text)).alias("words"))
    found = []
    for n in sorted({r["n"] for r in plan}):
        ours = sorted({h for r in plan if r["n"] == n for h in r["hashes"]})
        hashed = worded.withColumn("hashes", shingles(F.col("words"), n))
        # places of template shingles; most documents have none and so no window. A filter on their number would be
        # moved below the splitting of the text and repeat that for every word, so rows end after the explode
        at = F.filter(F.transform("hashes", lambda h, i: F.when(h.isin(ours), i)), lambda i: i.isNotNull())
        met = hashed.withColumn("met", at)
        lengths = sorted({r["length"] for r in plan if r["n"] == n})
        each = [_windows(F.col("met"), length) for length in lengths]
        windows = met.select(key, "words", "hashes", F.explode_outer(F.concat(*each)).alias("w")).where("w IS NOT NULL").select(
            key, "w.length", "w.start", F.slice("hashes", F.col("w.start") + 1, F.col("w.length")).alias("part"),
            F.greatest(F.lit(0), F.col("w.start") - _margin(F.col("w.length"))).alias("low"), "words")
        reach = F.col("start") + F.col("length") + _margin(F.col("length")) + (n - 1) - F.col("low")
        windows = windows.select(key, "length", "low", F.slice("words", F.col("low") + 1, reach).alias("words"), bands(F.col("part")).alias("bands"))
        signed = windows.select("*", F.posexplode("bands").alias("band", "value")).drop("bands")
        lists = known.where(F.col("n") == n).select(
            "template", "length", "exact", F.posexplode(bands(F.col("hashes"))).alias("band", "value"))
        # a window that meets in several bands is verified once; windows of other words stay apart, whatever their key
        # BANDS rows for each of the templates, whose list the caller holds in memory: they go to the windows, not the windows to them
        pairs = signed.join(F.broadcast(lists), ["length", "band", "value"]).dropDuplicates([key, "template", "low", "words"])
        here = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - n + 1)), lambda i: F.array_join(F.slice("words", i, n), " "))
        share = F.size(F.array_intersect("exact", here)) / F.size("exact")
        found.append(pairs.select(key, "template", share.alias("containment"), F.col("low").alias("first_word"), F.size("words").alias("n_words")))
    matches = found[0]
    for more in found[1:]:
        matches = matches.unionByName(more)
    best = F.min(F.struct((-F.col("containment")).alias("worst_first"), "first_word", "n_words")).alias("best")
    return matches.where(F.col("containment") >= contained).groupBy(key, "template").agg(best).select(
        key, "template", (-F.col("best.worst_first")).alias("containment"), "best.first_word", "best.n_words")


def _margin(length: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(length / 4)).cast("int")


def _windows(places: Column, length: int) -> Column:
    """The windows of a length, at every step, that cover one of the places."""
    step = max(1, length // 8)
    back = F.sequence(F.lit(0), F.lit(length // step))
    starts = F.transform(places, lambda p: F.filter(
        F.transform(back, lambda k: F.floor(p / step) * step - k * step), lambda s: (s >= 0) & (s + length > p)))
    return F.transform(F.array_distinct(F.flatten(starts)), lambda s: F.struct(F.lit(length).alias("length"), s.cast("int").alias("start")))


@query("op2_license_scan")
def op2_license_scan(spark, sf):
    return find_licenses(table(spark, sf, "documents"))
