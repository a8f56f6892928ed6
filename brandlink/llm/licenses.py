"""License scans by a positional rare-token index.

Templates are licence notices and phrases.  The document frequency of every
template word is counted over all documents; each template is indexed under
its rarest (highest-IDF) words with their positions: as many as it may miss by
``MIN_COVER`` and ``MIN_SUPPORT`` more, so that enough of them stand in every
place that the comparison accepts.  Every file looks up the index words that it
holds; a hit at word i of a template word at position p proposes the template
at offset i - p.  Proposals that agree are intersected, and the words at the
proposed place are compared with the template and its mandatory key phrases.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, staged

#: Java expressions: what stands between words; A-Z are lower-cased before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_SUPPORT = 2     # index words that must agree on a place
MIN_COVER = 0.8     # share of the template's words found in their places


@dataclass(frozen=True)
class Template:
    """``exact``: a phrase whose words must stand consecutively.  Else a
    notice: its words at their places, and every key phrase among them."""
    label: str
    text: str
    keys: tuple[str, ...] = ()
    exact: bool = False
    words: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self):
        object.__setattr__(self, "words", tuple(re.findall(r"[0-9a-z]+", self.text.lower())))

    def misses(self) -> int:
        """Words that may differ in a place that is still accepted."""
        n = len(self.words)
        return 0 if self.exact else max(m for m in range(n) if (n - m) / n >= MIN_COVER)


#: The contract's phrases and labels.
BASE = (Template("mit", "mit license", exact=True), Template("apache", "apache license", exact=True),
        Template("gpl", "general public license", exact=True))
#: The method's own notices (short public licence texts, SPDX labels).
NOTICES = (
    Template("MIT", "released under the MIT License", ("mit license",)),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
             "this software and associated documentation files", ("permission is hereby granted",)),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0",
             ("apache license version 2 0",)),
    Template("GPL-3.0", "licensed under the GNU General Public License, version 3",
             ("general public license version 3",)),
    Template("GPL-2.0", "licensed under the GNU General Public License, version 2",
             ("general public license version 2",)),
    Template("GPL", "This program is free software: you can redistribute it and/or modify it under the "
             "terms of the GNU General Public License", ("gnu general public license",)),
    Template("LGPL", "under the terms of the GNU Lesser General Public License",
             ("lesser general public license",)),
    Template("AGPL-3.0", "under the GNU Affero General Public License version 3",
             ("affero general public license",)),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("BSD", "Redistribution and use in source and binary forms, with or without modification, "
             "are permitted", ("redistribution and use in source and binary forms",)),
    Template("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license",)),
    Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose",
             ("permission to use copy modify",)),
    Template("Unlicense", "This is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)


def license_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z lower-cased text."""
    w = F.split(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), "^" + BETWEEN, ""), BETWEEN)
    return F.filter(w, lambda x: x != "")


def scan_licenses(docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """Per input row ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans``.

    Base columns: the places of the base phrases (null positions and empty
    labels where there are none).  ``labels`` adds the notices found; ``score``
    is the best share of a template's words found in place, 1 for a base
    phrase, 0 without a match; ``spans``: (label, first word, words) of every
    match.  Null texts count as empty.  Rows equal in doc_id and text are
    scanned once and give equal rows; an empty table gives no rows.
    """
    spark = docs.sparkSession
    templates = [*base, *notices]
    vocabulary = sorted({w for t in templates for w in t.words})
    longest = max(len(t.words) for t in templates)
    d = docs.select("doc_id", "text").withColumn("_x", F.xxhash64("text"))

    found = F.array_distinct(F.filter("_w", lambda x: x.isin(vocabulary)))
    df = (d.select(license_words(F.col("text")).alias("_w")).select(F.explode(found).alias("word"))
          .groupBy("word").count())
    # one row per template word, however large the corpus
    count = {r["word"]: r["count"] for r in df.collect()}
    postings = []
    for i, t in enumerate(templates):
        rare = sorted(set(t.words), key=lambda w: (count.get(w, 0), w))[:1 if t.exact else t.misses() + MIN_SUPPORT]
        # a template of fewer different words is indexed under all of them: one always stands
        need = max(1, min(MIN_SUPPORT, len(rare) - t.misses()))
        postings += [(i, t.label, t.exact, list(t.words), list(t.keys), need, w, p)
                     for p, w in enumerate(t.words) if w in rare]
    index = spark.createDataFrame(postings, "t int, label string, exact boolean, words array<string>, "
                                  "keys array<string>, need int, word string, pos int")
    index_words = sorted({p[6] for p in postings})

    d = d.withColumn("_w", license_words(F.col("text"))).select(
        "doc_id", "_x", F.size("_w").cast("long").alias("n_words"),
        F.expr(f"""transform(filter(transform(_w, (w, i) -> named_struct('w', w, 'i', i)),
                     x -> x.w in ({', '.join(repr(w) for w in index_words)})),
                   x -> named_struct('word', x.w, 'i', x.i, 'at', greatest(0, x.i - {longest}),
                     'near', slice(_w, greatest(0, x.i - {longest}) + 1, {2 * longest})))""").alias("hits"))
    d = staged(d)
    hits = (d.select("doc_id", "_x", F.explode("hits").alias("h")).select("doc_id", "_x", "h.*")
            .dropDuplicates(["doc_id", "_x", "i"]))
    # as many rows as the given templates hold index words
    cand = hits.join(F.broadcast(index), "word").withColumn("off", F.col("i") - F.col("pos")).where("off >= 0")
    cand = cand.withColumn("_there", F.expr("slice(near, off - at + 1, size(words))"))
    cover = F.expr("""aggregate(zip_with(words, _there, (a, b) -> if(a = b, 1, 0)), 0,
                      (s, x) -> s + coalesce(x, 0)) / cast(size(words) as double)""")
    keyed = F.expr("""forall(keys, k -> contains(concat(' ', array_join(_there, ' '), ' '),
                                                 concat(' ', k, ' ')))""")
    cand = cand.withColumn("cover", cover).withColumn("keyed", keyed)
    place = (cand.groupBy("doc_id", "_x", "t", "off")
             .agg(F.countDistinct("word").alias("support"), F.first("need").alias("need"),
                  F.first("label").alias("label"), F.first("exact").alias("exact"),
                  F.first("cover").alias("cover"), F.first("keyed").alias("keyed"),
                  F.first(F.size("words")).alias("n")))
    match = place.where("support >= need and keyed and cover >= if(exact, 1.0D, "
                        f"{MIN_COVER})")
    out = match.groupBy("doc_id", "_x").agg(
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("off"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("off"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
        F.sort_array(F.collect_set(F.struct("off", "label", "n"))).alias("spans"))
    j = d.select("doc_id", "_x", "n_words").alias("d").join(
        out.alias("o"), F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("d._x") == F.col("o._x")), "left")
    return j.select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<off:int,label:string,n:int>>)")).alias("spans"))
