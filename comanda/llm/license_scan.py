"""Licences in texts by sentence rules, in DataFrame functions only.

A text is cut into sentences and lines, each is brought to a normal form and looked up in a table of known licence
sentences. What stays is a short sequence of sentence identifiers for each document, in text order, and a licence is
recognised where its ordered rule is found in that sequence: all its identifiers, in order, with nothing but a bounded
number of other known sentences between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm.text import let, small

# Known sentences, in normal form (lower case, letters and digits, one space). Fixed values.
SENTENCES = {
    "apache2-short": ["licensed under the apache license version 2 0"],
    "apache2-grant": ["licensed under the apache license version 2 0 the license"],
    "apache2-comply": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at"],
    "apache2-asis": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
        "as is basis without warranties or conditions of any kind either express or implied"],
    "apache2-limits": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit-short": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions"],
    "mit-notice": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "asis-software": [
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
        "of merchantability fitness for a particular purpose and noninfringement"],
    "bsd-grant": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met"],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution"],
    "gpl3-short": [
        "this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"],
    "gpl-grant": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose"],
    "gpl-copy": [
        "you should have received a copy of the gnu general public license along with this program"],
    "mpl2-grant": [
        "this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl2-copy": [
        "if a copy of the mpl was not distributed with this file you can obtain one at"],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies"],
    "ccby4-short": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "ccbync4-short": [
        "licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "ccbysa4-short": [
        "licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc0-short": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "all-rights": ["all rights reserved"],
}

# Ordered rules: licence, identifiers in order. A licence may have several.
RULES = [
    ("Apache-2.0", ["apache2-short"]),
    ("Apache-2.0", ["apache2-grant", "apache2-comply"]),
    ("Apache-2.0", ["apache2-asis", "apache2-limits"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-grant", "mit-notice", "asis-software"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-3.0", ["gpl3-short"]),
    ("GPL-3.0", ["gpl-grant", "gpl-warranty"]),
    ("GPL-3.0", ["gpl-grant", "gpl-copy"]),
    ("MPL-2.0", ["mpl2-grant"]),
    ("ISC", ["isc-grant"]),
    ("CC-BY-4.0", ["ccby4-short"]),
    ("CC-BY-NC-4.0", ["ccbync4-short"]),
    ("CC-BY-SA-4.0", ["ccbysa4-short"]),
    ("CC0-1.0", ["cc0-short"]),
    ("Proprietary", ["all-rights"]),
]
MAX_GAP = 3  # other known sentences between two of a rule

# Sentences and rules that the SQL does not have: parts of the long sentences above, as texts are cut inside them, and more.
MORE_SENTENCES = {
    "gpl-terms": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either version 3 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty"],
    "gpl-implied": ["without even the implied warranty of merchantability or fitness for a particular purpose"],
    "bsd-endorse": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission"],
}
MORE_RULES = [
    ("GPL-3.0", ["gpl-terms", "gpl-hope", "gpl-implied"]),
    ("GPL-3.0", ["gpl-terms", "gpl-copy"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
]
UNLESS_NEXT = {"BSD-2-Clause": "bsd-endorse"}  # with this sentence next, a rule's end is that of a longer licence

# A sentence ends with its line, or with one of these marks before a space (so that "Version 2.0" stays whole).
MARK = r"([.!?;:])\x20+"
# Licences are wrapped at will: a line that goes on with a small letter, perhaps behind comment signs, continues one.
WRAP = r"[\x20\t]*\r?\n[\x20\t#*/;-]*(\p{Ll})"
NOT_ALPHANUMERIC = r"[^\p{L}\p{N}]+"
# In a paragraph every line goes on, whatever its first character, unless a known sentence starts there; "v. 2.0" stays whole.
PARAGRAPH_MARK = r"((?<!\b[vV])\.|[!?;:])\x20+"
PARAGRAPH_WRAP = r"[\x20\t]*\r?\n(?!{starts})[^\p{{L}}\p{{N}}\r\n]*(?=[\p{{L}}\p{{N}}])"
START_WORDS = 3


def normal(sentence: Column) -> Column:
    """Lower case, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_ALPHANUMERIC, " "))


def _sentences(text: Column, mark: str = MARK) -> Column:
    return F.split(F.regexp_replace(text, mark, "$1\n"), r"\n+")


def _paragraph_wrap(sentences: list[str]) -> str:
    """Line ends inside a paragraph, but for those before a capital that starts a known sentence."""
    starts = sorted({tuple(s.split()[:START_WORDS]) for s in sentences if len(s.split()) >= START_WORDS})
    first = "|".join(
        w[0][0].upper() + r"(?i:" + r"[^\p{L}\p{N}\r\n]+".join([w[0][1:], *w[1:]]) + r")\b" for w in starts)
    return PARAGRAPH_WRAP.format(starts=rf"[^\p{{L}}\p{{N}}\r\n]*(?:{first or '(?!)'})")


def sentence_ids(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, unwrapped, ids): the identifiers of the known sentences of each text, in order.

    Texts are read line by line (``unwrapped`` 0), with lines that go on with a small letter joined (1), and paragraph by
    paragraph (2). The sentences are looked up where they are; only those that are known are dealt by document.
    """
    listed = [r[0] for r in known.select("sentence").distinct().collect()]  # a few dozen
    text = F.coalesce(F.col(text_col), F.lit(""))
    wrapped = text.rlike(WRAP)
    none = F.array().cast("array<string>")
    readings = F.array(
        F.struct(F.lit(0).alias("unwrapped"), _sentences(text).alias("parts")),
        F.struct(F.lit(1).alias("unwrapped"), F.when(wrapped, _sentences(F.regexp_replace(text, WRAP, " $1"))).otherwise(none).alias("parts")),
        F.struct(F.lit(2).alias("unwrapped"), _sentences(
            F.regexp_replace(text, _paragraph_wrap(listed), " "), PARAGRAPH_MARK).alias("parts")))
    parts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.explode(readings).alias("r")).select(
        "id", "text_hash", "r.unwrapped", F.posexplode("r.parts").alias("place", "part"))
    # nothing shorter than the shortest known sentence is brought to normal form
    shortest = min(map(len, listed), default=0)
    parts = parts.filter(F.length("part") >= shortest).select(
        "id", "text_hash", "unwrapped", "place", normal(F.col("part")).alias("sentence"))
    found = parts.join(small(known, known.count()), "sentence").select(
        "id", "text_hash", "unwrapped", "place", "sentence_id").distinct()
    return found.groupBy("id", "text_hash", "unwrapped").agg(F.sort_array(F.collect_list(
        F.struct("place", "sentence_id"))).alias("s")).select(
        "id", "text_hash", "unwrapped", F.transform("s", lambda x: x["sentence_id"]).alias("ids"))


def _follows(ids: Column, rule: list[str], max_gap: int, unless_next: str | None = None) -> Column:
    """Whether the rule's identifiers are in ``ids``, in order, each within ``max_gap`` others of the one before.

    An end with ``unless_next`` next to it does not count.
    """
    def places(name: str) -> Column:
        return F.filter(F.transform(ids, lambda x, i: F.when(x == name, i)), lambda i: i.isNotNull())

    def after(reached: Column, name: str) -> Column:
        return let(reached, lambda r: F.filter(
            places(name), lambda i: F.exists(r, lambda j: (j < i) & (i <= j + 1 + max_gap))))

    ends = reduce(after, rule[1:], places(rule[0]))
    if unless_next is not None:
        ends = F.filter(ends, lambda i: ~F.coalesce(F.get(ids, i + 1) == unless_next, F.lit(False)))
    return F.size(ends) > 0


def recognise(docs: DataFrame, known: DataFrame, rules: list[tuple[str, list[str]]] | None = None, id_col: str = "doc_id",
              text_col: str = "text", max_gap: int = MAX_GAP) -> DataFrame:
    """(id, licence, rules): every licence found in a document, with the rules (places in the list) that say so.

    Null and empty texts have no sentences. Rows that share an id are one document: their licences are put together,
    repeated rows change nothing; rows with a null id are put together too. Other columns don't matter; documents
    without a licence are not in the result. ``known`` has sentences in normal form; without any, nothing is found.
    """
    listed = RULES + MORE_RULES if rules is None else rules
    unless = UNLESS_NEXT if rules is None else {}
    matches = F.filter(F.array(*(F.when(_follows(F.col("ids"), ids, max_gap, unless.get(licence)), F.struct(
        F.lit(licence).alias("licence"), F.lit(i).alias("rule"))) for i, (licence, ids) in enumerate(listed))),
        lambda x: x.isNotNull())
    found = sentence_ids(docs, known, id_col, text_col).select("id", F.explode(matches).alias("m"))
    return found.groupBy(F.col("id").alias(id_col), F.col("m.licence").alias("licence")).agg(
        F.sort_array(F.collect_set("m.rule")).alias("rules"))


def known_sentences(spark: SparkSession) -> DataFrame:
    """(sentence, sentence_id): a few dozen rows."""
    return spark.createDataFrame(
        [(text, name) for name, texts in (SENTENCES | MORE_SENTENCES).items() for text in texts], "sentence string, sentence_id string")


def oracle_sql() -> str:
    """The query over ``documents`` in DuckDB's SQL: one chain of joins for each rule."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(t)}, {quote(n)})" for n, texts in SENTENCES.items() for t in texts)
    chains = []
    for i, (licence, ids) in enumerate(RULES):
        joins = "".join(
            f" JOIN seq s{j} ON s{j}.doc_id IS NOT DISTINCT FROM s0.doc_id AND s{j}.row = s0.row AND s{j}.unwrapped = s0.unwrapped"
            f" AND s{j}.sentence_id = {quote(name)} AND s{j}.rn > s{j - 1}.rn AND s{j}.rn <= s{j - 1}.rn + 1 + {MAX_GAP}"
            for j, name in enumerate(ids) if j)
        chains.append(f"SELECT s0.doc_id, {quote(licence)} AS licence, {i} AS rule FROM seq s0{joins} WHERE s0.sentence_id = {quote(ids[0])}")
    mark, wrap, other = (quote(x) for x in (MARK, WRAP, NOT_ALPHANUMERIC))
    return f"""
WITH known(sentence, sentence_id) AS (VALUES {known}),
docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
readings AS (
  SELECT doc_id, row, false AS unwrapped, text FROM docs
  UNION ALL
  SELECT doc_id, row, true, regexp_replace(text, {wrap}, ' \1', 'g') FROM docs WHERE regexp_matches(text, {wrap})),
lists AS (
  SELECT doc_id, row, unwrapped, regexp_split_to_array(regexp_replace(text, {mark}, '\1' || chr(10), 'g'), '\n+') AS parts
  FROM readings),
parts AS (
  SELECT doc_id, row, unwrapped, unnest(parts) AS part, unnest(range(len(parts))) AS place FROM lists),
seq AS (
  SELECT doc_id, row, unwrapped, sentence_id,
         row_number() OVER (PARTITION BY row, unwrapped ORDER BY place, sentence_id) AS rn
  FROM parts JOIN known ON sentence = trim(regexp_replace(lower(part), {other}, ' ', 'g'))),
matches AS ({" UNION ALL ".join(chains)})
SELECT doc_id, licence, string_agg(DISTINCT rule::VARCHAR, ',' ORDER BY rule::VARCHAR) AS rules
FROM matches GROUP BY doc_id, licence"""
