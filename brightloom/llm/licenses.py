"""License scans: MinHash bands of overlapping windows retrieve templates, exact shingles verify them.

A window is four neighbouring word shingles; windows begin at every second shingle. Each of the bands holds one
minimum, so a template of one shingle in a window meets it in a band with a probability of
1 - (3/4) ** 32 = 0.9999, one of two or more shingles almost surely, and one with five intact shingles in
a row for certain. A band key is the masked hash of one shingle of a template, so texts without any such shingle
meet no key and their windows are not worked out. Only native expressions are used; nothing is shuffled before
the matches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import let

SHINGLE, WIDTH, STRIDE, BANDS = 5, 4, 2, 32

# Well-known license statements and notices.
TEMPLATES = {
    "apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "mit line": "Released under the MIT License",
    "gpl-3.0 line": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0 line": "Licensed under CC BY-NC 4.0",
    "mit notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "apache-2.0 notice": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "gpl notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation"),
    "bsd notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met"),
}


def _masks() -> list[int]:
    """One 64-bit mask for each band, from a multiplicative rule."""
    out, x = [], 1
    for _ in range(BANDS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((x ^ (x >> 29)) % (1 << 64) - (1 << 63))
    return out


MASKS = _masks()


def license_words(text: Column) -> Column:
    """Words in lower case; all but ASCII letters and digits part words."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def _shingle_hashes(words: Column) -> Column:
    """Hashes of the shingles; every word is hashed once."""
    def of_hashes(hashes: Column) -> Column:
        return F.slice(
            F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, SHINGLE)])),
            F.lit(1), F.greatest(F.size(hashes) - (SHINGLE - 1), F.lit(0)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _shingles(words: Column) -> Column:
    """The shingles themselves, for the exact check."""
    return F.slice(
        F.transform(words, lambda _, i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE)])),
        F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0)))


def _minimum(hashes: Column, start: Column, mask: int) -> Column:
    """The band's minimum over the window that begins at ``start``; what lies past the end is left out."""
    return F.least(*[F.get(hashes, start + k).bitwiseXOR(F.lit(mask)) for k in range(WIDTH)])


def _starts(hashes: Column, stride: int) -> Column:
    last = F.greatest((F.size(hashes) - 1), F.lit(0))
    return F.when(F.size(hashes) > 0, F.sequence(F.lit(0), last, F.lit(stride))).otherwise(F.array().cast("array<int>"))


def template_table(spark, templates: Mapping[str, str]) -> DataFrame:
    """``template, shingles, bands``: the distinct shingles, and for each band the minima of the template's windows."""
    rows = spark.createDataFrame([(name, text) for name, text in templates.items()], "template string, text string")

    def of_words(words: Column) -> Column:
        def of_hashes(hashes: Column) -> Column:
            whole = F.size(hashes) - WIDTH  # windows that lie inside, or the one of a short template
            starts = F.filter(_starts(hashes, 1), lambda s: s <= F.greatest(whole, F.lit(0)))
            return F.array(*[F.array_distinct(F.transform(starts, lambda s: _minimum(hashes, s, mask))) for mask in MASKS])

        return F.struct(F.array_distinct(_shingles(words)).alias("shingles"), let(_shingle_hashes(words), of_hashes).alias("bands"))

    found = rows.select("template", let(license_words(F.col("text")), of_words).alias("t"))
    return found.select("template", F.col("t.shingles").alias("shingles"), F.col("t.bands").alias("bands")).filter(F.size("shingles") > 0)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES, percent: int = 80) -> DataFrame:
    """One row per document and template that it holds: ``doc_id, template, n_shingles, n_found, first_word``.

    A document holds a template if it has ``percent`` of its distinct shingles of five words or more;
    ``first_word`` is the place of the first of them, from 0. Templates of fewer than five words match nothing;
    neither does a null or empty text. Repeated rows are scanned one by one, a null id stays null, an
    empty table gives an empty one. The templates are a parameter, so their keys are part of the plan.
    """
    table = template_table(docs.sparkSession, templates)
    known = table.collect()  # bounded by the templates given
    keys = [sorted({k for row in known for k in row["bands"][b]}) for b in range(BANDS)]
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if not known:
        keys = [[0] for _ in range(BANDS)]

    def hits(hashes: Column) -> Column:
        def met(start: Column) -> Column:
            out = _minimum(hashes, start, MASKS[0]).isin(*keys[0])
            for mask, some in zip(MASKS[1:], keys[1:]):
                out = out | _minimum(hashes, start, mask).isin(*some)
            return out

        minima = F.filter(_starts(hashes, STRIDE), met)
        # For the few windows met: which band met which key.
        return F.flatten(F.transform(minima, lambda s: F.filter(
            F.array(*[F.struct(F.lit(b).alias("band"), _minimum(hashes, s, mask).alias("key")) for b, mask in enumerate(MASKS)]),
            lambda x: x["key"].isNotNull())))

    shingles = sorted({key ^ mask for mask, some in zip(MASKS, keys) for key in some}) if known else [0]

    def hits_of_words(hashes: Column) -> Column:
        return F.when(F.exists(hashes, lambda h: h.isin(*shingles)), hits(hashes))

    words = license_words(F.col("text"))
    found = base.withColumn("hits", let(words, lambda w: let(_shingle_hashes(w), hits_of_words))).filter(F.size("hits") > 0)
    lookup = table.select("template", F.posexplode("bands").alias("band", "keys")).select("template", "band", F.explode("keys").alias("key"))
    by_key = F.map_from_entries(F.collect_list(F.struct("at", "names")))
    names = lookup.groupBy(F.struct("band", "key").alias("at")).agg(F.collect_set("template").alias("names")).agg(by_key.alias("by_key"))
    # One row: the map from band and key to the templates, bounded by the templates given.
    met = found.join(F.broadcast(names)).withColumn(
        "candidates", F.array_distinct(F.flatten(F.filter(F.transform("hits", lambda x: F.try_element_at("by_key", x)), lambda x: x.isNotNull()))))
    met = met.select("doc_id", let(words, _shingles).alias("own"), F.explode("candidates").alias("template"))
    pairs = met.join(F.broadcast(table.select("template", "shingles")), "template")
    shared = pairs.withColumn("shared", F.array_intersect("shingles", "own"))
    places = F.array_min(F.transform("shared", lambda x: F.array_position("own", x)))
    out = shared.filter(100 * F.size("shared") >= percent * F.size("shingles"))
    return out.select("doc_id", "template", F.size("shingles").cast("long").alias("n_shingles"), F.size("shared").cast("long").alias("n_found"),
                      (places - 1).alias("first_word"))


def check_sql(templates: Mapping[str, str] = TEMPLATES, percent: int = 80) -> str:
    """The DuckDB statement: every template against every document, without windows."""
    rows = ", ".join("('{}', '{}')".format(name.replace("'", "''"), text.replace("'", "''")) for name, text in templates.items())

    def shingles(words: str) -> str:
        return f"list_transform(range(1, len({words}) - {SHINGLE - 2}), lambda i: array_to_string({words}[i:i+{SHINGLE - 1}], ' '))"

    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) AS v(template, text)),
tw AS (SELECT template, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM t),
ts AS (SELECT DISTINCT template, unnest({shingles('words')}) AS shingle FROM tw),
tn AS (SELECT template, count(*) AS n_shingles FROM ts GROUP BY template),
dw AS (SELECT row_number() OVER () AS rowid_, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS words FROM documents),
ds AS (SELECT rowid_, doc_id, unnest(range(0, len(words) - {SHINGLE - 1})) AS place, unnest({shingles('words')}) AS shingle FROM dw),
m AS (SELECT rowid_, doc_id, template, count(DISTINCT shingle) AS n_found, min(place) AS first_word
      FROM ds JOIN ts USING (shingle) GROUP BY rowid_, doc_id, template)
SELECT doc_id, template, n_shingles::BIGINT AS n_shingles, n_found::BIGINT AS n_found, first_word::BIGINT AS first_word
FROM m JOIN tn USING (template) WHERE 100 * n_found >= {percent} * n_shingles"""
