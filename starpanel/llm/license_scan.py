"""License scans (operator 10): diagonal voting, with DataFrame functions only.

Every rolling word k-gram of every text is joined to the positions of the same k-gram in a library of license
templates. A hit at word p of the text and word t of the template votes for the diagonal p - t; hits are compared
word by word, so hashes only find them. Votes are summed by diagonal, neighbouring diagonals (words put in or left
out) are merged, and a merged span is kept if it covers enough of its template without being stretched.
Base phrases are templates as well: a phrase stands where its diagonal has every vote.

Null and empty texts have no words; a null id is kept; repeated rows each get their own result (rows are told
apart by place, not by id); an empty table gives an empty table; other columns are not looked at. The library is
the only table that is broadcast; its size is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starpanel.llm.common import table

K = 3
#: Most template k-grams that are broadcast.
MOST_GRAMS = 100_000

# Base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Well-known sentences of public licenses, as words.
LIBRARY = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _templates(spark: SparkSession, base, library) -> DataFrame:
    """(t, tpos, gram, shown, label, is_base, grams): each template's k-grams."""
    rows = [(i, words.split(" "), label, i < len(base)) for i, (words, label) in enumerate([*base, *library])]
    short = [r for r in rows if len(r[1]) < K]
    grams = sum(len(r[1]) - K + 1 for r in rows)
    if short or grams > MOST_GRAMS:
        raise ValueError(f"templates of under {K} words: {short}" if short else f"{grams} template k-grams; at most {MOST_GRAMS} are broadcast")
    t = spark.createDataFrame(rows, "t int, words array<string>, label string, is_base boolean")
    w = F.col("words")
    t = t.select("t", "label", "is_base", (F.size(w) - (K - 1)).alias("grams"), F.posexplode(w).alias("tpos", "word"), w)
    at = [F.get(w, F.col("tpos") + i) for i in range(K)]
    return t.where(F.col("tpos") < F.col("grams")).select("t", "tpos", "label", "is_base", "grams", F.xxhash64(*at).alias("gram"), F.concat_ws(" ", *at).alias("shown"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, library=LIBRARY,
    near: int = 3, coverage: float = 0.6, stretch: float = 1.5,
) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``near``: diagonals so close are merged. ``coverage``: least share of a template's k-grams in a kept span.
    ``stretch``: most words of a span for each word of its template.
    """
    spark = docs.sparkSession
    # Two characters outside ASCII have ASCII letters as lower case; any other letter stands in for them.
    plain = F.replace(F.replace(F.coalesce(docs[text_col].cast("string"), F.lit("")), F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ĸ"))
    d = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"), F.split(F.lower(plain), _SEPARATORS).alias("words"))
    w, size = F.col("words"), F.size("words")
    lead = (F.get(w, F.lit(0)) == "").cast("int")
    tail = ((F.get(w, size - 1) == "") & (size > 1)).cast("int")
    d = d.select("row", "doc_id", "words", lead.alias("lead"), (size - lead - tail).cast("long").alias("n_words"), F.posexplode("words").alias("pos", "word"))
    at = [F.get(w, F.col("pos") + i) for i in range(K)]
    d = d.select("row", "doc_id", "n_words", (F.col("pos") - F.col("lead")).alias("p"), F.col("pos").alias("place"), F.xxhash64(*at).alias("gram"), F.concat_ws(" ", *at).alias("said"))
    hits = d.join(F.broadcast(_templates(spark, base, library)), "gram", "left")
    real = F.col("shown").isNotNull() & (F.col("shown") == F.col("said"))
    hits = hits.where(real | (F.col("place") == 0)).select(
        "row", "doc_id", "n_words", "p", *(F.when(real, F.col(c)).alias(c) for c in ("t", "label", "is_base", "grams")), F.when(real, F.col("p") - F.col("tpos")).alias("diagonal")
    )
    hits = hits.repartition("row")
    votes = hits.groupBy("row", "t", "diagonal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("grams").alias("grams"),
        F.count("t").alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"),
    )
    along = Window.partitionBy("row", "t").orderBy("diagonal", "low")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > near) | (F.col("low") - F.lag("high").over(along) > near + K) | (F.lag("low").over(along) - F.col("high") > near + K)
    votes = votes.withColumn("__new", F.coalesce(apart, F.lit(False)).cast("int"))
    votes = votes.withColumn("chain", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = votes.groupBy("row", "t", "chain").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("grams").alias("grams"),
        F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.count_if(F.col("votes") == F.col("grams")).alias("whole"),
        F.min(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("first_whole"), F.max(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("last_whole"),
    )
    share = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    verified = F.col("t").isNotNull() & (share >= coverage) & (F.col("high") - F.col("low") + K <= stretch * (F.col("grams") + K - 1))
    is_base, found = F.coalesce("is_base", F.lit(False)), F.col("whole") > 0
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    return spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(is_base, F.col("whole"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(is_base, F.col("first_whole"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("last_whole"))).cast("long").alias("last_word"),
        labels(is_base & found).alias("base_labels"),
        labels((is_base & found) | (~is_base & verified)).alias("labels"),
        F.coalesce(F.max(F.when(is_base & found, F.lit(1.0)).when(~is_base & verified, share)), F.lit(0.0)).alias("score"),
    ).drop("row")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
