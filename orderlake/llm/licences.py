"""Licence scan by a positional index of rare words.

The licence texts are templates: word sequences, some of whose phrases are mandatory. Every template
word has an inverse document frequency (IDF) over all documents scanned. The index has postings
(template, place) of each template's own places of highest IDF, those of its mandatory phrases always,
so that no template's words are crowded out by another's. A hit at word i of the file and place j of a
template means the template might start at i - j. A start on which several rare words agree is an
alignment; it counts if the mandatory phrases stand where the template has them, and as AGREEING places of
these are posted, no such start is missed. Its score is the IDF share of template words that stand in
their places.

All of this is array functions within a row: files are not shuffled, and the only aggregate has one
row per template word.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of ASCII digits, a-z after lower-casing, and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a licence by themselves.
BASE_PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Fixed values: (label, template, mandatory phrases), each as its licence words it.
TEMPLATES = [
    ("mit", "released under the mit license", ["the mit license"]),
    ("mit", "licensed under the mit license", ["the mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ["permission is hereby granted free of charge", "to deal in the software without restriction"],
    ),
    ("apache-2", "licensed under the apache license version 2 0", ["the apache license version 2"]),
    (
        "apache-2",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ["unless required by applicable law or agreed to in writing", "on an as is basis"],
    ),
    (
        "gpl-3",
        "this work is licensed under the gnu general public license version 3",
        ["gnu general public license version 3"],
    ),
    (
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license",
        ["gnu general public license", "either version 3 of the license"],
    ),
    (
        "gpl-2",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 2 of the license",
        ["gnu general public license", "either version 2 of the license"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    (
        "cc-by-nc",
        "licensed under the creative commons attribution noncommercial 4 0 international license",
        ["creative commons attribution noncommercial"],
    ),
    (
        "cc-by",
        "licensed under the creative commons attribution 4 0 international license",
        ["creative commons attribution 4 0"],
    ),
    (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software",
        ["this permission notice shall be included in all copies"],
    ),
    ("apache-2", "apache license version 2 0 january 2004", ["apache license version 2 0 january 2004"]),
    (
        "gpl-2",
        "this work is licensed under the gnu general public license version 2",
        ["gnu general public license version 2"],
    ),
    (
        "lgpl-3",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 3 of the license",
        ["gnu lesser general public license", "either version 3 of the license"],
    ),
    (
        "lgpl-3",
        "this work is licensed under the gnu lesser general public license version 3",
        ["gnu lesser general public license version 3"],
    ),
    (
        "lgpl-2.1",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 2 1 of the license",
        ["gnu lesser general public license", "either version 2 1 of the license"],
    ),
    (
        "lgpl-2.1",
        "this work is licensed under the gnu lesser general public license version 2 1",
        ["gnu lesser general public license version 2 1"],
    ),
    (
        "agpl-3",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
        "by the free software foundation either version 3 of the license",
        ["gnu affero general public license", "either version 3 of the license"],
    ),
    (
        "agpl-3",
        "this work is licensed under the gnu affero general public license version 3",
        ["gnu affero general public license version 3"],
    ),
    (
        "bsd-3",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
        ["may be used to endorse or promote products derived from this software without specific prior written permission"],
    ),
    ("bsd-3", "licensed under the bsd 3 clause license", ["bsd 3 clause license"]),
    ("bsd-2", "licensed under the bsd 2 clause license", ["bsd 2 clause license"]),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ["for any purpose with or without fee is hereby granted", "this permission notice appear in all copies"],
    ),
    ("isc", "licensed under the isc license", ["the isc license"]),
    (
        "mpl-2",
        "licensed under the mozilla public license version 2 0",
        ["mozilla public license version 2 0"],
    ),
    (
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the eclipse public license "
        "2 0 which is available at",
        ["eclipse public license 2 0"],
    ),
    ("epl-2", "licensed under the eclipse public license version 2 0", ["eclipse public license version 2 0"]),
    (
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        ["waived all copyright and related or neighboring rights to"],
    ),
    ("cc0", "released under the creative commons zero v1 0 universal license", ["creative commons zero v1 0 universal"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["free and unencumbered software released into the public domain"],
    ),
    (
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
        "as a compiled binary for any purpose commercial or non commercial and by any means",
        ["in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"],
    ),
]

# Words of the identifiers that files name their licence by, and the labels.
IDENTIFIERS = {
    "mit": "mit",
    "apache 2 0": "apache-2",
    "gpl 2 0": "gpl-2",
    "gpl 3 0": "gpl-3",
    "lgpl 2 1": "lgpl-2.1",
    "lgpl 3 0": "lgpl-3",
    "agpl 3 0": "agpl-3",
    "bsd 2 clause": "bsd-2",
    "bsd 3 clause": "bsd-3",
    "isc": "isc",
    "mpl 2 0": "mpl-2",
    "epl 2 0": "epl-2",
    "cc0 1 0": "cc0",
    "unlicense": "unlicense",
}
TEMPLATES += [
    (label, line, [line]) for line, label in ((f"spdx license identifier {words}", label) for words, label in IDENTIFIERS.items())
]

#: Places of rare words that have to agree on a start. A mandatory phrase has more.
AGREEING = 2
#: IDF share of the template that has to stand in its place.
LEAST_SCORE = 0.6

VOCABULARY = sorted({w for _, text, _ in TEMPLATES for w in text.split()})
# Every base phrase, and a mandatory phrase of every template, has one of these in it: a text without
# any of them can have no label, is not searched and has score 0.
TELLTALES = (
    "license", "hereby", "applicable", "redistribut", "commons", "cc", "permission", "waived", "unencumbered", "binary",
)


def lowered(text: Column) -> Column:
    """A-Z to a-z, nothing else; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(low: Column) -> Column:
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def document_frequencies(docs: DataFrame, text_column: str = "text") -> tuple[int, dict[str, int]]:
    """How many rows there are, and in how many each template word is."""
    present = F.array_intersect(F.split(lowered(F.col(text_column)), NOT_WORD), F.array(*map(F.lit, VOCABULARY)))
    rows = docs.select(F.explode(F.array_append(present, F.lit(""))).alias("word")).groupBy("word").count().collect()
    found = {r["word"]: r["count"] for r in rows}
    return found.pop("", 0), found


def posted(text: str, phrases: list[str], idf: dict[str, float]) -> list[int]:
    """A template's places in the index: the AGREEING rarest of its mandatory phrases."""
    words = text.split()
    inside = {at + k for phrase, at in zip(phrases, _stands(words, phrases), strict=True) for k in range(len(phrase.split()))}
    return sorted(sorted(inside, key=lambda j: (-idf[words[j]], j))[:AGREEING])


def scan(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with n_words, base_places, alignments, base_labels, labels and score added.

    base_places has (label, first) for each place of a base phrase; alignments has (label, first,
    last, score) for each verified alignment, places in words from 0. Labels are arrays, distinct
    and sorted. The score is 1 where a base phrase stands, else the share of the best start with all its
    mandatory phrases, else 0.
    Null and empty texts have no words and score 0. Columns of these names in `docs` are replaced.
    """
    n, frequency = document_frequencies(docs, text_column)
    idf = {w: log((n + 1) / (frequency.get(w, 0) + 1)) + 1e-3 for w in VOCABULARY}
    index: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, phrases) in enumerate(TEMPLATES):
        for j in posted(text, phrases, idf):
            index.setdefault(text.split()[j], []).append((t, j))
    postings = F.create_map(
        *[
            column
            for w, places in index.items()
            for column in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(j).alias("j")) for t, j in places]))
        ]
    )
    templates = F.array(*[_template(*entry, idf) for entry in TEMPLATES])

    low = F.col("low")
    suspect = F.lit(False)
    for sign in TELLTALES:
        suspect = suspect | F.contains(low, F.lit(sign))
    none = F.array().cast("array<string>")
    added = ["n_words", "base_places", "alignments", "base_labels", "labels", "score"]
    rows = docs.select(
        F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"), lowered(F.col(_quoted(text_column))).alias("low")
    ).select(
        "row",
        F.regexp_count(low, F.lit(WORD)).cast("long").alias("n_words"),
        F.when(suspect, words_of(low)).otherwise(none).alias("words"),
    )
    words = F.col("words")
    present = F.array_intersect(F.array(*map(F.lit, index)), words)
    rows = rows.withColumn("rare", present).withColumn("base_places", _base_places(words))
    hits = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda h: F.array_contains(F.col("rare"), h["w"]),
    )
    # A start is one number, template and place, so that sorting brings those together on which
    # several rare words agree, in n log n steps.
    starts = F.sort_array(
        F.flatten(
            F.transform(
                hits,
                lambda h: F.transform(postings[h["w"]], lambda p: F.shiftleft(p["t"].cast("long"), 33) + h["i"] - p["j"] + 1000),
            )
        )
    )
    # Asking for the size first keeps the optimizer from moving the words' intersection into the
    # function over words, where it would be computed for each of them.
    rows = rows.withColumn("starts", F.when(F.size("rare") >= AGREEING, starts).otherwise(F.array().cast("array<bigint>")))
    agreeing = F.array_distinct(
        F.filter("starts", lambda s, k: F.coalesce(F.get(F.col("starts"), k + (AGREEING - 1)) == s, F.lit(False)))
    )
    rows = rows.withColumn("agreeing", agreeing).withColumn(
        "aligned",
        F.transform(
            F.filter("agreeing", lambda s: _has_phrases(s, templates, words)), lambda s: _alignment(s, templates, words)
        ),
    )
    verified = F.filter("aligned", lambda a: a["score"] >= LEAST_SCORE)
    base_labels = F.array_sort(F.array_distinct(F.transform("base_places", lambda p: p["label"])))
    labels = F.array_union(base_labels, F.transform(verified, lambda a: a["label"]))
    score = F.when(F.size("base_places") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform("aligned", lambda a: a["score"])), F.lit(0.0))
    )
    placed = lambda a: F.struct(*[a[n].alias(n) for n in ("label", "first", "last", "score")])
    done = rows.select(
        "row",
        "n_words",
        "base_places",
        F.transform(verified, placed).alias("alignments"),
        base_labels.alias("base_labels"),
        F.array_sort(labels).alias("labels"),
        score.alias("score"),
    )
    return done.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


def _template(label: str, text: str, phrases: list[str], idf: dict[str, float]) -> Column:
    words = text.split()
    total = sum(idf[w] for w in words)
    mandatory = _stands(words, phrases)
    return F.struct(
        F.lit(label).alias("label"),
        F.array(*[F.struct(F.lit(w).alias("w"), F.lit(idf[w] / total).alias("share")) for w in words]).alias("words"),
        F.array(
            *[
                F.struct(F.lit(j).alias("j"), F.array(*map(F.lit, phrase.split())).alias("words"))
                for j, phrase in zip(mandatory, phrases, strict=True)
            ]
        ).alias("phrases"),
    )


def _stands(words: list[str], phrases: list[str]) -> list[int]:
    """Where the template has each phrase."""
    owns = [phrase.split() for phrase in phrases]
    return [next(j for j in range(len(words)) if words[j : j + len(own)] == own) for own in owns]


def _parts(start: Column, templates: Column) -> tuple[Column, Column]:
    template = templates[F.shiftright(start, 33).cast("int")]
    return template, (start.bitwiseAND(F.lit((1 << 33) - 1)) - 1000).cast("int")


def _has_phrases(start: Column, templates: Column, words: Column) -> Column:
    """Whether every mandatory phrase stands where a template at `start` has it."""
    template, first = _parts(start, templates)
    return F.forall(
        template["phrases"],
        lambda p: F.forall(  # word by word, as a slice would copy the whole text
            F.transform(p["words"], lambda w, k: F.coalesce(F.get(words, first + p["j"] + k) == w, F.lit(False))),
            lambda stands: stands,
        ),
    )


def _alignment(start: Column, templates: Column, words: Column) -> Column:
    """What stands in its place of a template at `start`."""
    template, first = _parts(start, templates)
    shares = F.transform(
        template["words"],
        lambda w, j: F.when(F.coalesce(F.get(words, first + j) == w["w"], F.lit(False)), w["share"]).otherwise(0.0),
    )
    return F.struct(
        template["label"].alias("label"),
        first.alias("first"),
        (first + F.size(template["words"]) - 1).alias("last"),
        F.least(F.lit(1.0), F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)).alias("score"),
    )


def _base_places(words: Column) -> Column:
    return F.concat(*[_places(words, label, phrase.split()) for label, phrase in BASE_PHRASES.items()])


def _places(words: Column, label: str, phrase: list[str]) -> Column:
    def start_or_less(word: Column, i: Column) -> Column:
        here = word == phrase[0]
        for k in range(1, len(phrase)):
            here = here & F.coalesce(F.get(words, i + k) == phrase[k], F.lit(False))
        return F.when(here, i).otherwise(F.lit(-1))

    starts = F.filter(F.transform(words, start_or_less), lambda i: i >= 0)
    return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("first")))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
