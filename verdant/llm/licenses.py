"""Licence recognition from sentences.

Texts are normalised to lower-case words between breaks, and known licence
sentences that stand between two breaks are mapped to identifiers. A sentence
mark, an empty line or a list mark is a break that no sentence crosses; a
single line end, with any comment mark around it, may end a sentence or be a
blank inside it, so wrapped texts and notices on a line of their own are both
found. Of sentences that begin at one place the longest counts.

The identifiers of a document, in their order, are matched against ordered
licence rules: longer sequences come first and take their identifiers, so a
notice inside a full licence text isn't reported again. Sentences that aren't
known don't break a sequence (a copyright line between two clauses, say).

Everything happens inside the row with SQL functions: one scan, no shuffle,
so neither a hot source nor a frequent licence line can crowd a task. The
two tables are parameters of bounded size; they become literals of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences on a line of their own, normalised: (identifier, sentence). Fixed values.
LINE_SENTENCES: tuple[tuple[str, str], ...] = (
    ("apache-2.0-notice", "licensed under the apache license version 2 0"),
    ("apache-2.0-may-not", "you may not use this file except in compliance with the license"),
    ("apache-2.0-copy", "you may obtain a copy of the license at"),
    ("gpl-3.0-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-free-software", "this program is free software"),
    ("gpl-no-warranty", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("mit-notice", "released under the mit license"),
    ("mit-title", "the mit license mit"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or "
                      "substantial portions of the software"),
    ("as-is", "the software is provided as is without warranty of any kind"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-name", "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                 "or promote products derived from this software without specific prior written permission"),
    ("cc-by-nc-4.0-notice", "licensed under cc by nc 4 0"),
    ("cc-by-4.0-notice", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0-notice", "licensed under cc by sa 4 0"),
)

_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
_FSF = "as published by the free software foundation"

# All known sentences: those above and the full sentences of the canonical texts, which are wrapped as a rule.
SENTENCES: tuple[tuple[str, str], ...] = (
    *LINE_SENTENCES,
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license"),
    ("apache-2.0-header", "licensed under the apache license version 2 0 the license you may not use this file except in "
                          "compliance with the license"),
    *(("apache-2.0-copy", f"you may obtain a copy of the license at {scheme} www apache org licenses license 2 0")
      for scheme in ("http", "https")),
    ("mit-title", "mit license"),
    ("mit-title", "the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files the software to deal in the software without restriction including without limitation "
                  "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
                  "permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-condition", "the above copyright notice and this permission notice including the next paragraph shall be included in "
                      "all copies or substantial portions of the software"),
    ("as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the "
              "warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that "
                  "the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the "
                   "following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                   "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-advertising", "all advertising materials mentioning features or use of this software must display the following "
                        "acknowledgement"),
    ("bsd-name", "the name of the author may not be used to endorse or promote products derived from this software without "
                 "specific prior written permission"),
    *((f"gpl-{v}.0-or-later-notice", f"{_GPL}{_FSF} either version {v} of the license or at your option any later version")
      for v in (2, 3)),
    *((f"gpl-{v}.0-only-notice", _GPL + end) for v in (2, 3)
      for end in (f"{_FSF} version {v} of the license", f"{_FSF} version {v}", f"version {v} {_FSF}")),
    ("gpl-no-warranty", "this program is distributed in the hope that it will be useful but without any warranty without even "
                        "the implied warranty of merchantability or fitness for a particular purpose"),
)

# Ordered rules over the first table: (licence, identifiers in their order). Fixed values.
LINE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-title", "mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("Apache-2.0", ("apache-2.0-notice", "apache-2.0-may-not", "apache-2.0-copy")),
    ("GPL-3.0-only", ("gpl-free-software", "gpl-3.0-notice", "gpl-no-warranty")),
    ("Apache-2.0", ("apache-2.0-notice",)),
    ("GPL-3.0-only", ("gpl-3.0-notice",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-title",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-notice",)),
    ("CC-BY-4.0", ("cc-by-4.0-notice",)),
)

# All ordered rules.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name")),
    ("Apache-2.0", ("apache-2.0-header", "apache-2.0-copy")),
    ("Apache-2.0", ("apache-2.0-header",)),
    *((f"GPL-{v}.0-{kind}", (f"gpl-{v}.0-{kind}-notice", *more))
      for more in (("gpl-no-warranty",), ()) for v in (3, 2) for kind in ("or-later", "only")),
    *LINE_RULES,
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# In this order, over lower-case text. One line end is left for a single line end, two or more for a break.
STEPS = (
    ("\\r\\n?", "\n"),
    ("(^|\\n)[ \\t]*(?:rem|dnl)(?=\\s)", "$1"),    # comment marks that are words
    ("[.!?]+(?:[ \\t]+|(?=\\n))", "\n\n"),
    ("(?:[:;,][ \\t]+|\\n[^a-z0-9\\n]*)\\(?(?:[0-9]{1,2}|[a-z]|i{2,3})\\)[ \\t]+|:[ \\t]+[0-9]{1,2}[.][ \\t]+", "\n\n"),    # list marks
    ("(following [a-z]+(?: are met)?):[ \\t]+", "$1\n\n"),    # what the sentence announces on its own line
    ("[^a-z0-9\\n]+", " "),
    ("^ | $| ?\\n ?", "\n"),
)
#: Any holder's name in the BSD clause that names one.
HOLDER = ("neither the name of (?:[a-z0-9]+ ){1,20}?nor the names of (?:its|any|their) contributors".replace(" ", "[ \\n]+"),
          "neither the name of the copyright holder nor the names of its contributors")
FIRST_LETTER = 0x4E00                # identifiers are written as letters from here on while matching


def _cue(sentences: Sequence[tuple[str, str]]) -> str:
    """A pattern that every text with a known sentence contains: one long word of each."""
    return "(?i)" + "|".join(sorted({max(s.split(), key=lambda w: (len(w), w)) for _, s in sentences}))


def sentence_ids(text: Column, sentences: Sequence[tuple[str, str]] = SENTENCES) -> Column:
    """Identifiers of a text's known sentences, in their order."""
    whole = F.coalesce(text, F.lit(""))
    plain = F.translate(whole, UPPER, LOWER)
    for pattern, with_ in (*STEPS, HOLDER):
        plain = F.regexp_replace(plain, pattern, with_)
    known = F.create_map(*[F.lit(v) for name, s in sentences for v in (s, name)])
    longest = sorted((s for _, s in sentences), key=len, reverse=True)
    between = "(?<![^\\n])(?:" + "|".join(longest).replace(" ", "[ \\n]") + ")(?![^\\n])"
    found = F.transform(F.regexp_extract_all(plain, F.lit(between), 0),
                        lambda s: F.element_at(known, F.translate(s, "\n", " ")))
    return F.when(whole.rlike(_cue(sentences)), found).otherwise(F.array().cast("array<string>"))


def licenses(docs: DataFrame, sentences: Sequence[tuple[str, str]] = SENTENCES,
             rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> DataFrame:
    """(doc_id, ids array, found array of (rule, licence, times)) of every row.

    Null and empty texts and texts without a known sentence have empty arrays.
    A rule matches where its identifiers follow each other in the document's
    identifiers; identifiers that a rule has taken are gone for later rules.
    Repeated rows are judged alike; other columns are not read."""
    letter = {name: chr(FIRST_LETTER + k) for k, (name, _) in enumerate(sentences)}
    letters = F.create_map(*[F.lit(v) for pair in letter.items() for v in pair])
    rows = docs.select("doc_id", sentence_ids(F.col("text"), sentences).alias("ids"))
    rows = rows.withColumn("left", F.concat_ws("", F.transform("ids", lambda i: F.element_at(letters, i))))
    for k, (_, sequence) in enumerate(rules):
        pattern = "".join(letter[i] for i in sequence)
        rows = rows.withColumn(f"times{k}", F.regexp_count("left", F.lit(pattern))) \
            .withColumn("left", F.replace(F.col("left"), F.lit(pattern), F.lit("-")))
    hits = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(licence).alias("licence"), F.col(f"times{k}").alias("times"))
                     for k, (licence, _) in enumerate(rules)])
    return rows.select("doc_id", "ids", F.filter(hits, lambda h: h["times"] > 0).alias("found"))


def op5_license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: its sentence identifiers and licences as text, in
    rule order, each licence once, and the number of rule matches."""
    out = licenses(docs)
    return out.select(
        "doc_id", F.size("ids").alias("n_sentences"), F.concat_ws(",", "ids").alias("sentence_ids"),
        F.concat_ws(",", F.array_distinct(F.transform("found", lambda h: h["licence"]))).alias("licenses"),
        F.aggregate("found", F.lit(0), lambda n, h: n + h["times"]).alias("n_matches"))


def _oracle() -> str:
    """The same over DuckDB, with the matching unrolled into one column per rule, for texts
    whose known sentences stand on one line; tests hold the wrapped ones."""
    values = ", ".join(f"('{s}', '{n}', '{chr(FIRST_LETTER + k)}')" for k, (n, s) in enumerate(LINE_SENTENCES))
    letter = {n: chr(FIRST_LETTER + k) for k, (n, _) in enumerate(LINE_SENTENCES)}
    steps, last = [], "r"
    for k, (_, sequence) in enumerate(LINE_RULES):
        p = "".join(letter[i] for i in sequence)
        steps.append(f"m{k} AS (SELECT * EXCLUDE (rest), len(regexp_extract_all(rest, '{p}')) AS t{k}, "
                     f"replace(rest, '{p}', '-') AS rest FROM {last})")
        last = f"m{k}"
    names = ", ".join(f"CASE WHEN t{k} > 0 THEN '{licence}' END" for k, (licence, _) in enumerate(LINE_RULES))
    once = ("list_filter([" + names + "], lambda x: x IS NOT NULL)")
    return f"""
WITH known(sentence, name, letter) AS (VALUES {values}),
cut AS (SELECT doc_id, row_number() OVER () AS r, string_split(regexp_replace(regexp_replace(
          translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.!?]+[ \\t]+|[\\r\\n]+', chr(10), 'g'),
          '[^a-z0-9\\n]+', ' ', 'g'), chr(10)) AS s FROM documents),
each AS (SELECT r, unnest(s) AS s, generate_subscripts(s, 1) AS pos FROM cut),
hit AS (SELECT r, string_agg(name, ',' ORDER BY pos) AS ids, string_agg(letter, '' ORDER BY pos) AS rest, count(*) AS n
        FROM each JOIN known ON trim(each.s) = known.sentence GROUP BY r),
r AS (SELECT cut.doc_id, coalesce(hit.ids, '') AS ids, coalesce(hit.rest, '') AS rest, coalesce(n, 0) AS n FROM cut LEFT JOIN hit USING (r)),
{", ".join(steps)},
f AS (SELECT *, {once} AS names FROM {last})
SELECT doc_id, n::INTEGER AS n_sentences, ids AS sentence_ids,
       array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licenses,
       ({" + ".join(f"t{k}" for k in range(len(LINE_RULES)))})::INTEGER AS n_matches
FROM f"""


ORACLE = _oracle()
