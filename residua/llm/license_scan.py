"""License scans: a positional index of rare licence words, in DataFrame operations only.

The words of a few licence notices, with their positions, are the index. A word's rarity is measured
over all documents. The rarest words of each template are looked up; each place in the file and place in
the template give a relative position, and a template is a candidate where several different words agree
on one. A candidate counts if most of the template's words stand at that position and the file holds its
mandatory key phrases. Of each template so many words are looked up that no placement that counts can
lack the agreement.

No word is too common for the index: the ones looked up are the rarest of their template, however many
documents hold them. A document without any key phrase can't have a label, and its words are never laid out one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and labels of the base, which the method only adds to.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices to find: label, words of the notice, and phrases of which one must stand in the file.
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted",),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2", "apache license 2")),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("in compliance with the license",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        ("attribution noncommercial",),
    ),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("attribution 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("general public license version 3",)),
    ("gpl-2", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
]
#: How many different words must agree on a position.
AGREE = 2
#: Share of a template's words that must stand where the template has them.
MATCHED = 0.7

#: How a vote is packed: words before a text's start, positions, and licence words that it has room for.
_SHIFT, _TEMPLATE, _ANCHOR = 1024, 1 << 32, 512

_WORD_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(text: Column) -> Column:
    """A-Z lower-cased, words single-spaced with a blank at either end; one blank for a text without words."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), _WORD_GAPS, " ")


def _count(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / len(what)


def _vocabulary() -> list[str]:
    return sorted({w for _, words, _ in TEMPLATES for w in words.split()})


def rarity(docs: DataFrame) -> dict[str, float]:
    """ln((N + 1) / (n + 1)) of every licence word found, over all N documents; at most the vocabulary."""
    vocabulary = F.array(*[F.lit(w) for w in _vocabulary()])
    words = docs.select(F.array_intersect(F.split(normal(F.col("text")), " "), vocabulary).alias("words"))
    # An extra null a row counts the documents in the same pass.
    each = words.select(F.explode(F.concat(F.col("words"), F.array(F.lit(None).cast("string")))).alias("word"))
    counted = {r.word: r.n for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counted.pop(None, 0)
    return {w: math.log((total + 1) / (n + 1)) for w, n in sorted(counted.items())}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _anchors(rare: dict[str, float]) -> list[list[str]]:
    """The rarest words of each template: AGREE more than a placement that counts may have out of place."""
    found = []
    for _, text, _ in TEMPLATES:
        words = text.split()
        least = next(k for k in range(len(words) + 1) if k / len(words) >= MATCHED)
        rarest = sorted(set(words), key=lambda w: (-rare.get(w, math.inf), w))
        found.append(rarest[: len(words) - least + AGREE])
    return found


def _index_sql(rare: dict[str, float]) -> str | None:
    """map(word -> array of (template, position, number of the word)) for the anchors found, as a SQL literal."""
    places: dict[str, list[tuple[int, int, int]]] = {}
    numbers = {w: k for k, w in enumerate(_vocabulary())}
    for k, (anchors, (_, words, _)) in enumerate(zip(_anchors(rare), TEMPLATES, strict=True)):
        for at, word in enumerate(words.split()):
            if word in anchors and word in rare:
                places.setdefault(word, []).append((k, at, numbers[word]))
    if not places:
        return None
    entries = ", ".join(
        f"{_text(w)}, array({', '.join(f'named_struct({_text("t")}, {t}, {_text("p")}, {p}, {_text("a")}, {a})' for t, p, a in found)})"
        for w, found in sorted(places.items())
    )
    return f"map({entries})"


def scan(docs: DataFrame) -> DataFrame:
    """Scan every row of docs (doc_id, text) for licences.

    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: places of the base
    phrases with their smallest and largest start (null without any), the labels that they give, those
    and the method's, and the best share of a template's words found in place (1 where a base phrase
    stands, 0 without a label).

    Null and empty texts have no words; texts of any length are scanned whole; null and repeated doc_ids are
    scanned row by row; words that tie in rarity are looked up in the order of the alphabet, which no result
    depends on; an empty table gives no rows; other columns are ignored. The words' rarity is counted over
    all rows first.
    """
    rare = rarity(docs)
    text = normal(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("norm"))
    rows = _base(rows)
    if index := _index_sql(rare):
        rows = rows.withColumn("found", _matches(index))
    else:
        rows = rows.withColumn("found", F.expr("cast(array() as array<struct<label:string,share:double>>)"))
    own = F.transform("found", lambda x: x["label"])
    labels = F.array_sort(F.array_union("base", own))
    share = F.greatest(
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)),
    )
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        share.alias("score"),
    )


def _base(rows: DataFrame) -> DataFrame:
    """Word count, and count, extent and labels of the base phrases.

    Neighbouring places of one phrase share the blank between them, so blanks are doubled to count them.
    """
    norm = F.col("norm")
    doubled = F.replace(norm, F.lit(" "), F.lit("  "))
    backwards = F.reverse(norm)
    counts, firsts, lasts, labels = [], [], [], []
    words = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) - 1
    for phrase, label in BASE_PHRASES.items():
        has = norm.contains(f" {phrase} ")
        wide = " " + phrase.replace(" ", "  ") + " "
        counts.append(F.when(has, _count(doubled, wide).cast("long")).otherwise(F.lit(0).cast("long")))
        before = F.substring(norm, F.lit(1), F.instr(norm, f" {phrase} "))
        firsts.append(F.when(has, _count(before, " ").cast("long") - 1))
        after = F.substring(backwards, F.lit(1), F.instr(backwards, f" {phrase} "[::-1]))
        lasts.append(F.when(has, words - _count(after, " ").cast("long") + 1 - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    n_base = counts[0] + counts[1] + counts[2]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    return rows.select(
        "doc_id",
        "norm",
        F.when(norm == " ", F.lit(0)).otherwise(words).cast("long").alias("n_words"),
        n_base.alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        base.alias("base"),
    )


def _matches(index: str) -> Column:
    """The method's labels of a row with `norm`, as an array of (label, share)."""
    nothing = "cast(array() as array<struct<label:string,share:double>>)"
    # The file's words, numbered from 0.
    words = "filter(split(norm, ' '), w -> w <> '')"
    templates = "array(" + ", ".join(
        f"named_struct('label', {_text(label)}, 'words', split({_text(text)}, ' '), 'keys', array({', '.join(_text(f' {k} ') for k in keys)}))"
        for label, text, keys in TEMPLATES
    ) + ")"
    # Every place of an anchor against every place of its word in a template, as one number: template and
    # relative position, then the anchor. Sorted, the anchors that agree on a position stand side by side.
    votes = f"""array_sort(array_distinct(flatten(transform(
        filter(transform(words, (w, i) -> struct(w, i)), x -> map_contains_key({index}, x.w)),
        x -> transform(element_at({index}, x.w), y ->
            ((y.t * {_TEMPLATE}L) + x.i - y.p + {_SHIFT}) * {_ANCHOR} + y.a)))))"""
    agreed = f"""transform(array_distinct(transform(filter(votes, (v, i) ->
            get(votes, i + {AGREE - 1}) div {_ANCHOR} = v div {_ANCHOR}),
        v -> v div {_ANCHOR})),
        c -> named_struct('t', int(c div {_TEMPLATE}L), 'at', int(c % {_TEMPLATE}L) - {_SHIFT}))"""
    judged = f"""transform(agreed, c -> named_struct(
        'label', element_at({templates}, c.t + 1).label,
        'key', exists(element_at({templates}, c.t + 1).keys, k -> contains(norm, k)),
        'share', aggregate(element_at({templates}, c.t + 1).words,
            named_struct('i', 0, 'n', 0),
            (a, w) -> named_struct('i', a.i + 1, 'n', a.n + if(get(words, c.at + a.i) = w, 1, 0)),
            a -> cast(a.n as double) / a.i)))"""
    kept = f"filter(judged, j -> j.key and j.share >= {MATCHED}D)"
    said = "transform(kept, j -> named_struct('label', j.label, 'share', j.share))"

    def let(name: str, value: str, body: str) -> str:
        """body with name bound to value, evaluated once."""
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    body = let("words", words, let("votes", votes, let("agreed", agreed, let("judged", judged, let("kept", kept, said)))))
    keyed = " or ".join(f"contains(norm, {_text(f' {k} ')})" for k in sorted({k for _, _, keys in TEMPLATES for k in keys}))
    return F.expr(f"if({keyed}, {body}, {nothing})")


def _templates_values() -> str:
    return ", ".join(
        f"({k}, {_text(label)}, {_text(words)}, [{', '.join(_text(f' {x} ') for x in keys)}])"
        for k, (label, words, keys) in enumerate(TEMPLATES)
    )


def oracle_sql() -> str:
    """scan(documents) in DuckDB: every template at every position that any of its words gives it, without rarity or anchors."""
    bases = ", ".join(f"({_text(p)}, {_text(x)})" for p, x in BASE_PHRASES.items())
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), tpl(t, label, phrase, keys) AS (VALUES {_templates_values()}),
posting AS (SELECT t, u.w, CAST(u.p AS BIGINT) - 1 AS p FROM tpl, unnest(string_split(phrase, ' ')) WITH ORDINALITY AS u(w, p)),
word AS (SELECT rid, u.w, CAST(u.i AS BIGINT) - 1 AS i FROM d, unnest(words) WITH ORDINALITY AS u(w, i)),
lic AS MATERIALIZED (SELECT * FROM word WHERE w IN (SELECT w FROM posting)),
cand AS (SELECT DISTINCT l.rid, p.t, l.i - p.p AS pos FROM lic l JOIN posting p ON p.w = l.w),
place AS (
  SELECT c.rid, c.t, c.pos, count(*) FILTER (WHERE l.rid IS NOT NULL) / CAST(count(*) AS DOUBLE) AS share
  FROM cand c JOIN posting p ON p.t = c.t LEFT JOIN lic l ON l.rid = c.rid AND l.w = p.w AND l.i = c.pos + p.p
  GROUP BY ALL
),
own AS (
  SELECT rid, label, share FROM place JOIN tpl USING (t) JOIN d USING (rid)
  WHERE share >= {MATCHED} AND list_bool_or(list_transform(keys, lambda k: contains(' ' || array_to_string(words, ' ') || ' ', k)))
),
phrase(phrase, label) AS (VALUES {bases}),
base AS (
  SELECT l.rid, b.label, l.i FROM lic l, phrase b, d
  WHERE d.rid = l.rid AND l.w = string_split(b.phrase, ' ')[1]
    AND list_slice(d.words, l.i + 1, l.i + len(string_split(b.phrase, ' '))) = string_split(b.phrase, ' ')
),
b AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY rid),
a AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM own) GROUP BY rid),
s AS (SELECT rid, max(share) AS share FROM own GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid) LEFT JOIN s USING (rid)"""
