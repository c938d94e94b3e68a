"""Licence scans by a positional index of licence words, with DataFrame functions only.

The templates are licence texts, their notices and phrases. How many documents hold each of
their words gives the words' IDF. The index holds every template word with its places. A file
looks up the ``RARE_WORDS`` licence words of highest IDF that it holds, and the rarest word of
each key phrase: where one of these stands, its place in a template gives the place where the
template would begin. A beginning is kept if the template's key phrase stands there whole; the
file's words are then intersected with the template's by relative position. A template is
found if the matched words hold the share ``LEAST_SHARE`` of its IDF; a base phrase must stand
there whole itself. A key phrase brings its rarest word with it, so no template that would be
found is missed, whatever words the file or the corpus makes rare.

Everything about a file happens within its row, in time linear in its length; only the word
counts are shuffled, and they have as many rows as the templates have words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import blank_text, quoted

#: How many of its licence words of highest IDF a file looks up, besides the keys' rarest words.
RARE_WORDS = 3
LEAST_SHARE = 0.6
#: A beginning is kept as template * 2**32 + first word + the longest template, which may begin before the file.
_TEMPLATE = 1 << 32
#: What lies between words: ASCII but for digits and (lower-case) letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence text in lower-case words; ``key`` must stand in it, or is all of it (base)."""

    label: str
    text: str
    key: str = ""

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_places(self) -> range:
        words, key = self.words, (self.key or self.text).split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        return range(at, at + len(key))


# The base phrases and their labels, then wordings of well-known licences.
BASE = (
    Template("cc-by", "cc by"),
    Template("gpl", "general public license"),
    Template("reserved", "all rights reserved"),
)
LICENCES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    # Whole texts and notices, in lower-case words.
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no "
        "event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
        "an action of contract tort or otherwise arising from out of or in connection with the software or the use "
        "or other dealings in the software",
        "to deal in the software without restriction",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the "
        "software is provided as is and the author disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness",
        "with or without fee is hereby granted",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met 1 redistributions of source code must retain the above copyright notice "
        "this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the "
        "above copyright notice this list of conditions and the following disclaimer in the documentation and or "
        "other materials provided with the distribution",
        "redistributions of source code must retain",
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
        "required by applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied see the license for "
        "the specific language governing permissions and limitations under the license",
        "except in compliance with the license",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version this program is distributed in the hope that it will be useful but without any "
        "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the "
        "gnu general public license for more details",
        "under the terms of the gnu general public license",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely",
        "alter it and redistribute it freely",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means",
        "free and unencumbered software",
    ),
    Template("public-domain", "this work has been released into the public domain", "public domain"),
)


def _lowered(text: Column) -> Column:
    """Lower case in which no other character becomes an ASCII letter, as two signs would."""
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ĸ")))


def _words(text: str) -> Column:
    return F.array_remove(F.split(_lowered(blank_text(text)), BETWEEN_WORDS), "")


def word_idf(docs: DataFrame, text: str, templates: tuple[Template, ...]) -> dict[str, float]:
    """The IDF over all of ``docs`` of every template word; as many rows reach the driver."""
    vocabulary = sorted({w for t in templates for w in t.words})
    known = F.array_distinct(F.filter(_words(text), lambda w: w.isin(vocabulary)))
    words = docs.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("word"))
    held = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}
    n = held.pop("", 0)  # the empty word stands for the document
    return {w: math.log(1 + n / (1 + held.get(w, 0))) for w in vocabulary}


def key_words(templates: tuple[Template, ...], idf: dict[str, float]) -> list[str]:
    """The rarest word of each template's key phrase."""
    keys = [{t.words[at] for at in t.key_places} for t in templates]
    return sorted({min(key, key=lambda w: (-idf[w], w)) for key in keys})


def _map(entries: dict[str, Column]) -> Column:
    return F.create_map(*[part for word, value in entries.items() for part in (F.lit(word), value)])


def with_licences(docs: DataFrame, text: str = "text", licences: tuple[Template, ...] = LICENCES) -> DataFrame:
    """``docs`` with the licences found in each text; columns of the same names are replaced.

    ``n_words``; ``n_base``, ``first_word`` and ``last_word`` for the places of base phrases
    (null without any); ``base_labels`` and ``labels``, distinct, sorted and comma-joined
    (empty without any); ``score``, the largest share of a found template's IDF, 0 without
    any; and ``found``, an array of (label, start, share). Null texts are empty. Each row is
    judged by itself and whole.
    """
    templates = BASE + tuple(licences)
    idf = word_idf(docs, text, templates)
    before = max(len(t.words) for t in templates)
    postings: dict[str, list[int]] = {}
    for number, t in enumerate(templates):
        for at, word in enumerate(t.words):
            postings.setdefault(word, []).append(number * _TEMPLATE + before - at)
    index = _map({w: F.array(*[F.lit(p).cast("long") for p in places]) for w, places in postings.items()})
    ranks = _map({w: F.lit(n) for n, w in enumerate(sorted(idf, key=lambda w: (-idf[w], w)))})
    by_rank = F.array(*map(F.lit, sorted(idf, key=lambda w: (-idf[w], w))))
    shapes = F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"),
                F.array(*map(F.lit, t.words)).alias("words"),
                F.array(*[F.lit(idf[w]) for w in t.words]).alias("weights"),
                F.lit(math.fsum(idf[w] for w in t.words)).alias("total"),
                F.lit(t.key_places.start).alias("key"),
                F.array(*[F.lit(t.words[at]) for at in t.key_places]).alias("key_words"),
            )
            for t in templates
        ]
    )
    rows = docs.withColumn("\u0001words", _words(text))
    held = F.array_distinct(F.filter("\u0001words", lambda w: w.isin(list(idf))))
    held = F.transform(held, lambda w: F.element_at(ranks, w))
    rare = F.transform(F.slice(F.array_sort(held), 1, RARE_WORDS), lambda n: F.get(by_rank, n))
    sought = F.array_union(rare, F.array(*map(F.lit, key_words(templates, idf))))

    def start(begin: Column) -> Column:
        return F.pmod(begin, F.lit(_TEMPLATE)) - F.lit(before)

    def shape(begin: Column) -> Column:
        return F.get(shapes, F.shiftright(begin, 32).cast("int"))

    def stands(begin: Column, word: Column, at: Column) -> Column:
        # One element at a time: a slice of a long array copies all of it.
        return F.coalesce(F.get("\u0001words", (start(begin) + at).cast("int")) == word, F.lit(False))

    def has_key(begin: Column) -> Column:
        key = F.transform(shape(begin)["key_words"], lambda w, q: stands(begin, w, shape(begin)["key"] + q))
        return F.forall(key, lambda here: here)

    def begins_of(sought: Column) -> Column:
        places = F.transform("\u0001words", lambda w, i: F.when(F.array_contains(sought, w), i))
        return F.flatten(
            F.transform(
                F.filter(places, lambda place: place.isNotNull()),
                lambda place: F.filter(
                    F.transform(F.element_at(index, F.get("\u0001words", place)), lambda p: p + place), has_key
                ),
            )
        )

    # Named by a function, the sought words are found once; a column of their own would be made anew at each word.
    begins = F.get(F.transform(F.array(sought), begins_of), 0)

    def aligned(begin: Column) -> Column:
        share = F.aggregate(
            F.transform(
                shape(begin)["words"],
                lambda w, q: F.when(stands(begin, w, q), F.get(shape(begin)["weights"], q)).otherwise(0.0),
            ),
            F.lit(0.0),
            lambda sum, weight: sum + weight,
        )
        return F.struct(
            shape(begin)["label"].alias("label"),
            start(begin).alias("start"),
            F.least(share / shape(begin)["total"], F.lit(1.0)).alias("share"),
        )

    # Base phrases stand whole where their key does. They stay numbers: a text may hold a million.
    base = F.filter("\u0001begins", lambda begin: begin < len(BASE) * _TEMPLATE)
    other = F.filter("\u0001begins", lambda begin: begin >= len(BASE) * _TEMPLATE)
    licence = F.filter(F.transform(other, aligned), lambda x: x["share"] >= LEAST_SHARE)
    rows = rows.withColumn("\u0001begins", F.array_distinct(begins))
    rows = rows.withColumns({"\u0001base": base, "\u0001licence": licence})
    base_numbers = F.array_distinct(F.transform("\u0001base", lambda begin: F.shiftright(begin, 32)))
    base_labels = F.transform(base_numbers, lambda t: F.get(shapes, t.cast("int"))["label"])
    labels = F.transform("\u0001licence", lambda x: x["label"])

    def joined(names: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    def place(label: Column, start: Column, share: Column) -> Column:
        return F.struct(label.alias("label"), start.alias("start"), share.alias("share"))

    results = {
        "n_words": F.size("\u0001words").cast("long"),
        "n_base": F.size("\u0001base").cast("long"),
        "first_word": F.array_min(F.transform("\u0001base", start)),
        "last_word": F.array_max(F.transform("\u0001base", start)),
        "base_labels": joined(base_labels),
        "labels": joined(F.concat(base_labels, labels)),
        "score": F.when(F.size("\u0001base") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("\u0001licence", lambda x: x["share"])), F.lit(0.0))
        ),
        "found": F.concat(
            F.transform("\u0001base", lambda begin: place(shape(begin)["label"], start(begin), F.lit(1.0))),
            F.transform("\u0001licence", lambda x: place(x["label"], x["start"], x["share"])),
        ),
    }
    return rows.withColumns(results).drop(*[f"\u0001{c}" for c in ("words", "begins", "base", "licence")])
