"""Licence scans: an exact set-similarity join of text blocks with licence wordings, in DataFrame operations only.

A block is a line (for notices; with ``wrapped``, as the query asks, also two neighbouring lines) or
a paragraph, which blank lines end (for grants). A block contains a template when it has at least ``threshold`` of its distinct words. All
(block, template) pairs of that kind are found:

1. Words of the templates are counted over all documents and numbered from rare to frequent.
2. A template's prefix are its rarest words, so many that a block that has none of them lacks
   too many others. Documents without a prefix word go at once; the words of the other
   documents' blocks, as sorted numbers, are joined to the prefixes.
3. A pair goes on if the block has enough template words (length) and if after the places of the
   common word enough are left in both (position). Pairs that pass are verified.

Of the templates that a block contains the one with most common words counts (ties: the higher
containment, then the label). Base phrases are looked up in the words of the whole text, at any place.

Defined results: a null or empty text has no word, no label and score 0; repeated rows are judged
alike; an empty table gives an empty result; other columns are ignored. The score is 1 where
a base phrase stands, else the highest containment found, else 0.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .license_texts import GRANTS, NOTICES

THRESHOLD = 0.85

# The words, and the base phrases with their labels.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
PHRASES = [("mit", ("mit", "license")), ("apache", ("apache", "license")), ("gpl", ("general", "public", "license"))]


def _words(column: str | F.Column) -> F.Column:
    return F.regexp_extract_all(column, F.lit(WORD), F.lit(0))


def _templates() -> list[tuple[str, str, list[str]]]:
    """(kind, label, distinct words)."""
    return [(kind, label, sorted(set(re.findall(WORD, text.lower()))))
            for kind, of in (("line", NOTICES), ("paragraph", GRANTS)) for label, text in of]


def _strings(values) -> F.Column:
    return F.array(*(F.lit(v) for v in values))


def _places() -> str:
    """SQL of the base places in ``words``: an array of (start, label)."""
    cases = " ".join(
        "WHEN w = '{}' AND {} THEN named_struct('at', i - {}, 'label', '{}')".format(
            words[-1], " AND ".join(f"get(words, i - {len(words) - 1 - k}) = '{x}'" for k, x in enumerate(words[:-1])),
            len(words) - 1, label) for label, words in PHRASES)
    return f"filter(transform(words, (w, i) -> CASE {cases} END), x -> x IS NOT NULL)"


def word_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary from the rarest to the most frequent word, by the number of all documents that have it."""
    counts = (words.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
              .groupBy("word").count().collect())  # one row per template word
    found = {r["word"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def find_licenses(docs: DataFrame, threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """n_words, base places and labels, all labels and score of every row of (doc_id, text)."""
    spark = docs.sparkSession
    # lower() makes no a to z out of other characters but k, from the Kelvin sign, which no base phrase has.
    words = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.lower(F.col("text").cast("string")), F.lit("")).alias("t"))
             .withColumn("words", _words("t")))
    templates = _templates()
    order = word_order(words, sorted({w for _, _, ws in templates for w in ws}))
    number = {w: k for k, w in enumerate(order)}
    entries, prefixes = [], set()
    for k, (kind, label, ws) in enumerate(templates):
        ranks = sorted(number[w] for w in ws)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        prefix = ranks[:len(ranks) - need + 1]
        prefixes.update(prefix)
        all_ranks = "array({})".format(",".join(map(str, ranks)))
        entries += [f"({r}, {k}, '{kind}', '{label}', {p}, {len(ranks)}, {need}, {all_ranks})" for p, r in enumerate(prefix)]
    index = spark.sql("SELECT * FROM VALUES " + ", ".join(entries)
                      + " AS t(rank, template, kind, label, place, size, need, ranks)")

    found = cut(words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.when(F.col("t").contains("license"), F.expr(_places())).alias("places"),
        F.when(F.arrays_overlap("words", _strings(order[r] for r in sorted(prefixes))), F.col("t")).alias("t"))
        .withColumn("row", F.monotonically_increasing_id()), "license_words")

    some = found.where("t IS NOT NULL").select("row", "t")
    vocabulary = _strings(order)

    def own(text):
        return F.array_sort(F.transform(F.array_intersect(_words(text), vocabulary),
                                        lambda w: F.array_position(vocabulary, w).cast("int") - 1))
    lines = some.select("row", F.transform(F.split("t", "\n"), own).alias("lines"))
    two = F.expr("zip_with(slice(lines, 1, size(lines) - 1), slice(lines, 2, size(lines) - 1), "
                 "(a, b) -> array_sort(array_union(a, b)))")  # a line and the next
    numbered = (lines.select("row", F.lit("line").alias("kind"), F.posexplode(F.concat("lines", two) if wrapped else F.col("lines")).alias("block", "own"))
                .unionByName(some.select("row", F.lit("paragraph").alias("kind"),
                                         F.posexplode(F.split("t", "\n[ \t\r]*\n")).alias("block", "t"))
                             .select("row", "kind", "block", own(F.col("t")).alias("own"))))
    least = min(math.ceil(threshold * len(ws) - 1e-9) for _, _, ws in templates)
    numbered = numbered.where(F.size("own") >= least)
    tokens = numbered.select("row", "kind", "block", "own", F.posexplode("own").alias("at", "rank"))
    candidates = (tokens.join(F.broadcast(index), ["rank", "kind"])  # one row per prefix word of a template
                  .where(F.size("own") >= F.col("need"))
                  .where(F.least(F.col("size") - F.col("place"), F.size("own") - F.col("at")) >= F.col("need"))
                  .select("row", "kind", "block", "template", "label", "size", "need",
                          F.size(F.array_intersect("own", "ranks")).alias("common")))
    best = (candidates.where("common >= need")
            .groupBy("row", "kind", "block")
            .agg(F.max(F.struct("common", (F.col("common") / F.col("size")).alias("containment"), "label")).alias("top")))
    judged = best.groupBy("row").agg(F.collect_set("top.label").alias("more"), F.max("top.containment").alias("containment"))

    places = F.coalesce("places", F.expr("array()").cast("array<struct<at:int,label:string>>"))
    base = F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label)))
    more = F.coalesce("more", F.expr("array()").cast("array<string>"))
    return (found.join(judged, "row", "left").select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["at"])).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score")))
