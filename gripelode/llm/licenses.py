"""Licence scans by a positional rare-token index, in DataFrame functions only.

Templates are licence notices as word sequences. A word's IDF counts the templates that hold it, so a file's result never
depends on other files. Of each template the words of highest IDF are its anchors, and the index maps an anchor word to its
postings (template, position). A file's words are looked up in the index; each hit at word i for a posting at position q
proposes the template at offset i - q. A proposed offset is checked by relative position: the anchors that stand where the
template has them must make up ``share`` of its anchors' IDF, and every mandatory key phrase must stand within ``slack``
words of its place. Exact templates are phrases: all their words must stand consecutively, so each of their places is found
through its anchor, and none is missed.

Everything happens inside a row: one scan, no shuffle, no Python; a long file costs in proportion to its words and hits.

Null and empty texts have no words and no labels, score 0. Rows that repeat an id, and rows with a null id, are scored each
by its own text. The index is a literal of the plan; its size depends on the templates only.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything of ASCII that is neither a digit nor a letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANCHORS = 6  # highest-IDF words of a template that the index holds
SHARE = 60  # per cent of its anchors' weight that a notice must have at one offset
SLACK = 8  # words by which a key phrase may be off its place in a notice


@dataclass(frozen=True)
class Template:
    """A notice with its key phrases, or, without key phrases, an exact phrase. ``base`` marks the phrases whose places are reported."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Phrases whose places are reported, then public licence notices and the phrases that each must hold.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("for any purpose with or without fee", "appear in all copies")),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("use this file except in compliance", "apache org licenses license 2 0")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "the following conditions are met")),
    Template("bsd-3", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from", "specific prior written permission")),
    Template("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license as published", "version 3 of the license")),
    Template("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license as published", "version 2 of the license")),
    Template("lgpl-3", "under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu lesser general public license as published", "version 3 of the license")),
    Template("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu affero general public license as published", "version 3 of the license")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license v 2 0", "mpl was not distributed with this file")),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software", "into the public domain")),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by-nc", "creative commons attribution non commercial"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by", "cc by 4 0"),
    Template("cc0", "cc0 1 0"),
    Template("mit", "spdx license identifier mit"),
    Template("isc", "spdx license identifier isc"),
    Template("apache-2", "spdx license identifier apache 2 0"),
    Template("bsd-3", "spdx license identifier bsd 3 clause"),
    Template("gpl-3", "spdx license identifier gpl 3 0"),
    Template("gpl-2", "spdx license identifier gpl 2 0"),
    Template("mpl-2", "spdx license identifier mpl 2 0"),
)
# End of the fixed values.


@dataclass(frozen=True)
class Index:
    """Postings of the anchor words and what a proposed template is checked against; weights are whole thousandths of an IDF."""

    postings: dict[str, list[tuple[int, int]]]
    checks: list[dict]


def _position(words: list[str], phrase: list[str]) -> int:
    for i in range(len(words) - len(phrase) + 1):
        if words[i : i + len(phrase)] == phrase:
            return i
    raise ValueError(f"the key phrase {' '.join(phrase)!r} is not in its template")


def build_index(templates: tuple[Template, ...] = BASE + NOTICES, anchors: int = ANCHORS) -> Index:
    held: dict[str, int] = {}
    for t in templates:
        for word in set(t.words):
            held[word] = held.get(word, 0) + 1
    weight = {word: round(1000 * math.log((len(templates) + 1) / n)) for word, n in held.items()}
    postings: dict[str, list[tuple[int, int]]] = {}
    checks = []
    for number, t in enumerate(templates):
        words = t.words
        # Of words of one IDF the longer ones come first. A phrase needs one anchor: where all its words stand, so does that one.
        rare = sorted(range(len(words)), key=lambda i: (-weight[words[i]], -len(words[i]), i))[: anchors if t.phrases else 1]
        for i in rare:
            postings.setdefault(words[i], []).append((number, i))
        phrases = t.phrases or (t.text,)
        checks.append({
            "label": t.label, "base": t.base, "exact": not t.phrases, "total": sum(weight[words[i]] for i in rare),
            "anchors": [{"at": i, "word": words[i], "weight": weight[words[i]]} for i in sorted(rare)],
            "phrases": [{"at": _position(words, p.split()), "n": len(p.split()), "text": f" {p} "} for p in phrases],
        })
    return Index(postings, checks)


CHECKS = "array<struct<label:string,base:boolean,exact:boolean,total:long,anchors:array<struct<at:int,word:string,weight:long>>,phrases:array<struct<at:int,n:int,text:string>>>>"
_SHIFT = 1 << 40  # a proposal is template * 2^40 + offset + 2^20 in one long, so that duplicates go by hash
_ZERO = 1 << 20


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; lower() does the same for texts of single-byte characters and is faster."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(folded, SEPARATORS, -1), lambda w: w != "")


def _proposals(words: Column, index: Index) -> Column:
    """Every distinct (template, offset) that a rare word of the file proposes."""
    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*index.postings), F.struct(i.alias("i"), w.alias("w")))), lambda h: h.isNotNull())
    postings = F.from_json(F.lit(json.dumps({w: [t * _SHIFT + _ZERO - at for t, at in found] for w, found in index.postings.items()})), "map<string,array<long>>")
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(postings, h["w"]), lambda p: p + h["i"]))))


def _window(words: Column, start: Column, end: Column) -> Column:
    """The words from start up to end as text between blanks; what lies outside the file is left out."""
    first = F.greatest(start, F.lit(0))
    return F.concat(F.lit(" "), F.array_join(F.slice(words, first + 1, F.greatest(end - first, F.lit(0))), " "), F.lit(" "))


def _verified(words: Column, proposals: Column, index: Index, share: int, slack: int) -> Column:
    """Proposals that hold as structs (label, base, start, part): part is the share of the anchors' weight that stands in place."""
    checks = F.from_json(F.lit(json.dumps(index.checks)), CHECKS)

    def judged(code: Column) -> Column:
        t = F.element_at(checks, (F.floor(code / _SHIFT) + 1).cast("int"))
        start = (code % _SHIFT - _ZERO).cast("int")
        found = F.aggregate(t["anchors"], F.lit(0).cast("long"), lambda s, a: s + F.when(F.get(words, start + a["at"]) == a["word"], a["weight"]).otherwise(0))
        room = F.when(t["exact"], 0).otherwise(slack)
        phrases = F.forall(t["phrases"], lambda p: F.contains(_window(words, start + p["at"] - room, start + p["at"] + p["n"] + room), p["text"]))
        holds = phrases & (100 * found >= share * t["total"])
        return F.when(holds, F.struct(t["label"].alias("label"), t["base"].alias("base"), start.cast("long").alias("start"), (found / t["total"]).alias("part")))

    return F.filter(F.transform(proposals, judged), lambda x: x.isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = BASE + NOTICES, anchors: int = ANCHORS, share: int = SHARE, slack: int = SLACK) -> DataFrame:
    """(doc_id, n_words, found): one row per row of docs; found holds every verified template with its label and first word."""
    index = build_index(templates, anchors)
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    # Each step names its input twice, so that Catalyst keeps it as a step instead of repeating it inside the next one's lambdas.
    rows = rows.select("doc_id", "words", _proposals(F.col("words"), index).alias("proposals"))
    some = F.when(F.size("proposals") > 0, _verified(F.col("words"), F.col("proposals"), index, share, slack))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), some.alias("found"))


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Places of base phrases are counted, all others only give labels. The score is the greatest part of a verified template.
    """
    found = scan(docs, id_col, text_col, **options)
    found = found.select("doc_id", "n_words", "found", F.filter("found", lambda x: x["base"]).alias("base"))
    starts = F.transform("base", lambda x: x["start"])
    return found.select(
        "doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.coalesce(_labels(F.col("base")), F.lit("")).alias("base_labels"), F.coalesce(_labels(F.col("found")), F.lit("")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["part"])), F.lit(0.0)).alias("score"),
    )
