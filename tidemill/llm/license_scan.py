"""License scan: Dice coefficient over word bigrams, DataFrame functions only.

A text is compared as a whole and line by line. Texts and templates are
normalised alike: lower-cased, everything but ASCII letters and digits and
non-ASCII characters a separator. With the sets of word bigrams A and B, the
coefficient is 2 |A and B| / (|A| + |B|). It can only reach a threshold t if
|A| is between t / (2 - t) and (2 - t) / t times |B|, so a template is looked
up by the set sizes that it admits, and only those candidates are compared.

The least size also bounds how many bigrams a match may lack, so a match has one
of any larger choice of the template's bigrams, and a word of each. Texts with
none of these words are left out before their lines are looked at.

Null texts are empty and match nothing, like lines of one word. Among equally
good licenses the smaller name counts. Repeated rows get the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import besides, identity, unused
from tidemill.llm.common import col as named

#: Usual notices by license.
NOTICES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Everything that separates words, but for the line feed.
SEPARATORS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), SEPARATORS, " ")


def words(line: Column) -> Column:
    return F.split(F.trim(line), " ")


def bigrams(found: Column) -> Column:
    """The set of neighbouring words, joined by a space."""
    rest = F.greatest(F.size(found) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(found, 1, rest), F.slice(found, 2, rest), lambda a, b: F.concat_ws(" ", a, b)))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """``license, grams, size``."""
    rows = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("template")) for n, t in templates])
    table = spark.range(1).select(F.inline(rows))
    grams = bigrams(words(F.regexp_replace(normalised(F.col("template")), " *\n *", " ")))
    return table.select("license", grams.alias("grams")).withColumn("size", F.size("grams")).filter("size > 0")


def candidates(table: DataFrame, percent: int) -> DataFrame:
    """One row for every set size that can reach ``percent`` with a template."""
    size = F.col("size")
    low = F.expr(f"cast((size * {percent} + {200 - percent} - 1) div {200 - percent} as int)")
    high = F.expr(f"cast((size * {200 - percent}) div {percent} as int)")
    return table.select("license", F.col("grams").alias("template_grams"), size.alias("template_size"), F.explode(F.sequence(low, high)).alias("size"))


def needed_words(table: DataFrame, percent: int) -> list[str]:
    """Words of which every text that matches has one. The long words are chosen, as they are rare."""
    chosen = set()
    for row in table.select("grams").collect():  # the templates, a parameter
        least = -(-len(row.grams) * percent // (200 - percent))
        longest = sorted((max(g.split(" "), key=len) for g in row.grams), key=len)
        chosen.update(longest[max(0, least - 1) :])  # all but least - 1: a match cannot lack them all
    return sorted(chosen)


def matches(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, sig, line, license, dice``: all that reach ``percent``; line -1 is the whole text."""
    table = template_table(docs.sparkSession, NOTICES if templates is None else templates)
    needed = F.array(*[F.lit(w) for w in needed_words(table, percent)]).cast("array<string>")
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    plain = docs.select(identity(docs, id_col).alias("doc"), F.xxhash64(text).alias("sig"), normalised(text).alias("plain"))
    plain = plain.filter(F.arrays_overlap(F.split("plain", "[ \n]"), needed))
    lines, whole = F.split("plain", "\n"), F.regexp_replace("plain", " *\n *", " ")
    units = F.when(F.size(lines) > 1, F.concat(lines, F.array(whole))).otherwise(lines)
    each = plain.select("doc", "sig", F.size(lines).alias("n"), F.posexplode(units).alias("at", "unit"))
    line = F.when(F.col("at") < F.col("n"), F.col("at")).otherwise(-1).alias("line")
    compared = each.select("doc", "sig", line, words(F.col("unit")).alias("words")).filter(F.arrays_overlap("words", needed))
    compared = compared.select("doc", "sig", "line", bigrams(F.col("words")).alias("grams")).withColumn("size", F.size("grams"))
    found = compared.join(candidates(table, percent), "size").withColumn("common", F.size(F.array_intersect("grams", "template_grams")))
    return found.filter(F.col("common") * 200 >= (F.col("size") + F.col("template_size")) * percent).select(
        "doc", "sig", "line", "license", (F.col("common") * 2 / (F.col("size") + F.col("template_size"))).alias("dice")
    )


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", result: str = "license") -> DataFrame:
    """``docs`` with a struct column ``result``: ``best``, ``dice``, ``n_matches``, ``names`` (sorted)."""
    per_doc = matches(docs, templates, percent, id_col, text_col).groupBy("doc", "sig").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), F.col("license").alias("best"))).alias("first"),
        F.countDistinct("line", "license").alias("n"),
        F.array_sort(F.collect_set("license")).alias("names"),
    )
    doc, sig, out = unused(docs, "doc_key", "text_sig", result)
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    value = F.struct(F.col("first.best").alias("best"), (-F.col("first.d")).alias("dice"), F.col("n").alias("n_matches"), "names")
    right = per_doc.select(F.col("doc").alias(doc), F.col("sig").alias(sig), value.alias(out))
    joined = docs.withColumns({doc: identity(docs, id_col), sig: F.xxhash64(text)}).join(right, [doc, sig], "left")
    return joined.select(*besides(docs, result), F.col(out).alias(result))
