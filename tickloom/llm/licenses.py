"""Licence scan: a positional index of rare licence words, aligned with templates by relative position.

1. The words of all templates form the licence vocabulary. The *positional index* posts every place of a word in a template:
   word → ``(template, position)``. One pass over all documents counts in how many of them each vocabulary word occurs; only
   these counts, as many as there are vocabulary words, reach the driver.
2. A match must hold all key phrases of its template in full, so each word of a key phrase is bound to stand in its place. Of
   these the one of highest inverse document frequency *opens* the template: wherever a file holds it, its posting says
   where the template would begin. Which word opens a template changes how many places are looked at, never what is found.
3. The postings of the template's other key words are intersected by relative position, the rarest first, which leaves few
   places. There the whole template is compared word by word; a share of ``min_share`` must agree.

Places are looked up by word, not by template, so a slice costs as much as there are openings in it, whatever the number of
templates. Words are runs of ASCII letters, digits and non-ASCII characters, ASCII letters in lower case.

Defined results: a missing or empty text has no words, no labels and score 0; rows that repeat an id are scanned
each; missing ids stay; equal scores and repeated places are all reported; a template may begin before a text or end behind it,
the words that lie outside do not agree; an empty table gives an empty result. Templates without a word, or with a key phrase
that they do not hold, are an error.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import vec
from tickloom.llm.common import over_texts

MIN_SHARE = 0.6

# Label, text and key phrases of the templates; whole licence texts sentence by sentence, and the notices by
# which files name a licence.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
TEMPLATES = [
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the"
             " software is provided as is", ["permission to use copy modify", "granted the software is provided"]),
    ("agpl-3.0", "gnu affero general public license", ["affero general public license"]),
    ("agpl-3.0", "it under the terms of the gnu affero general public license as published by the free software foundation either"
                 " version 3 of the license or at your option any later version", ["affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license", ["apache license", "version 2 0"]),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an"
                   " as is basis without warranties or conditions of any kind either express or implied",
     ["unless required by applicable law or agreed to in writing software"]),
    ("artistic-2.0", "this package is licensed under the artistic license 2 0", ["artistic license 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met", ["redistribution and use", "binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
     ["redistributions of source code must retain"]),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"
            " in the documentation and or other materials provided with the distribution", ["redistributions in binary form must reproduce"]),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
                     " derived from this software without specific prior written permission", ["used to endorse or promote products derived"]),
    ("bsl-1.0", "boost software license version 1 0", ["boost software license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights",
     ["waived all copyright"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     ["eclipse public license 2 0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["general public license version 2"]),
    ("gpl-2.0", "it under the terms of the gnu general public license as published by the free software foundation either version 2 of the"
                " license or at your option any later version", ["gnu general public license as published", "either version 2 of the license"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["general public license version 3"]),
    ("gpl-3.0", "it under the terms of the gnu general public license as published by the free software foundation either version 3 of the"
                " license or at your option any later version", ["gnu general public license as published", "either version 3 of the license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted provided that the above copyright notice and this permission notice appear in all copies",
     ["permission to use copy modify", "this permission notice appear in all copies"]),
    ("lgpl", "gnu lesser general public license", ["lesser general public license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files", ["permission is hereby granted", "free of charge"]),
    ("mit", "the software to deal in the software without restriction including without limitation the rights to use copy modify merge"
            " publish distribute sublicense and or sell copies of the software", ["deal in the software without restriction"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and"
             " redistribute it freely subject to the following restrictions", ["to alter it and redistribute it freely"]),
]


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """``(hash of every word, number of each text's first word)``."""
    low = vec.LOWER[data]
    start, end, first = vec.words(low, offsets, vec.ALNUM)
    return vec.span_hashes(low, start, end), first


def _hash_words(words: list) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    joined = np.frombuffer(b"".join(data), np.uint8)
    return vec.span_hashes(joined, np.concatenate([[0], ends[:-1]]), ends)


class Index:
    """The positional index of a list of templates ``(label, text, key phrases)``.

    ``place`` numbers the words of documents, -1 for those of no template. Postings are kept as arrays by word: those of
    word w are ``begin[w] : begin[w + 1]`` of ``template`` and ``position``.
    """

    def __init__(self, templates: list):
        texts = [text.split() for _, text, _ in templates]
        if not all(texts):
            raise ValueError("a template without words")
        self.words = sorted({w for t in texts for w in t})
        number = {w: i for i, w in enumerate(self.words)}
        hashes = _hash_words(self.words)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.length = np.array([len(t) for t in texts])
        self.start = np.cumsum(self.length) - self.length
        self.text = np.array([number[w] for t in texts for w in t], np.int32)
        self.keys = [sorted({p for phrase in phrases for p in _places(t, phrase.split())}) for t, (_, _, phrases) in zip(texts, templates)]

    def place(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1).astype(np.int32)

    def open_by(self, held: np.ndarray) -> "Index":
        """Choose the openings: ``held`` counts the documents with each word, the fewer the higher its inverse frequency."""
        ranked = [sorted(keys, key=lambda p: (held[self.text[s + p]], self.words[self.text[s + p]], p)) for s, keys in zip(self.start, self.keys)]
        openings = np.array([r[0] for r in ranked])
        word = self.text[self.start + openings]
        order = np.argsort(word, kind="stable")
        self.template, self.position = order, openings[order]
        self.begin = np.searchsorted(word[order], np.arange(len(self.words) + 1))
        self.others = [np.array(r[1:], np.int64) for r in ranked]
        self.rounds = max(map(len, self.others), default=0)
        self.other_count = np.array([len(r) for r in self.others])
        self.other_start = np.cumsum(self.other_count) - self.other_count
        self.other_position = np.concatenate([*self.others, np.zeros(1, np.int64)])
        return self

    def matches(self, number: np.ndarray, first: np.ndarray, min_share: float):
        """``(template, start, text, share)`` of all matches in a slice of numbered words; starts count in the slice."""
        at = np.flatnonzero(number >= 0)
        word = number[at]
        many = self.begin[word + 1] - self.begin[word]
        posting = np.repeat(self.begin[word] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        template, opened = self.template[posting], np.repeat(at, many)
        text = np.searchsorted(first, opened, "right") - 1
        start = opened - self.position[posting]
        for k in range(self.rounds):  # intersect by relative position, a key word at a time
            more = self.other_count[template] > k
            if not more.any():
                break
            place = start + np.where(more, self.other_position[self.other_start[template] + np.where(more, k, 0)], 0)
            inside = (place >= first[text]) & (place < first[text + 1])
            expected = self.text[self.start[template] + place - start]
            good = ~more | inside & (number[np.where(inside, place, 0)] == expected)
            template, start, text = template[good], start[good], text[good]
        size = self.length[template]
        along = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        place, of = np.repeat(start, size) + along, np.repeat(np.arange(len(size)), size)
        inside = (place >= first[text[of]]) & (place < first[text[of] + 1])
        agrees = inside & (number[np.where(inside, place, 0)] == self.text[np.repeat(self.start[template], size) + along])
        share = np.bincount(of, agrees, len(size)) / np.maximum(size, 1)
        good = share >= min_share
        return template[good], start[good], text[good], share[good]


def _places(words: list, phrase: list) -> list:
    """The places of the words of ``phrase`` where it first stands in a template."""
    at = next((i for i in range(len(words)) if words[i:i + len(phrase)] == phrase), None)
    if at is None or not phrase:
        raise ValueError(f"the key phrase {' '.join(phrase)!r} is not in its template")
    return list(range(at, at + len(phrase)))


def document_frequencies(docs: DataFrame, index: Index, text_col: str = "text") -> np.ndarray:
    """Documents that hold each vocabulary word."""
    size = len(index.words)

    def count(batches):
        for batch in batches:
            held = np.zeros(size, np.int64)
            for _, data, offsets in vec.slices(batch.column(0)):
                hashes, first = word_hashes(data, offsets)
                number = index.place(hashes)
                doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[number >= 0]
                held += np.bincount(np.unique(doc * size + number[number >= 0]) % size, minlength=size)
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["word", "n"])

    rows = over_texts(docs.select(F.col(f"`{text_col}`")), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r.word] = r.n
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
         min_share: float = MIN_SHARE) -> DataFrame:
    """Per row: ``id, n_words, matches``, matches being ``(label, start, words, share, phrase)`` by start and label;
    ``phrase`` marks those of ``phrases``. Starts count words from 0; share is the part of the template that stands
    there word by word. ``templates`` lists ``(label, text, key phrases)``."""
    whole = [(label, text, [text]) for label, text in phrases] + list(templates)
    index = Index(whole)
    index.open_by(document_frequencies(docs, index, text_col))
    labels, is_phrase = np.array([label for label, _, _ in whole]), np.arange(len(whole)) < len(phrases)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in vec.slices(batch.column("text")):
                hashes, first = word_hashes(data, offsets)
                template, start, text, share = index.matches(index.place(hashes), first, min_share)
                order = np.lexsort((template, labels[template], start, text))
                template, start, text, share = template[order], start[order], text[order], share[order]
                found = pa.StructArray.from_arrays(
                    [pa.array(labels[template].tolist(), pa.string()), pa.array(start - first[text]), pa.array(index.length[template].astype(np.int32)),
                     pa.array(share), pa.array(is_phrase[template])], names=["label", "start", "words", "share", "phrase"])
                bounds = np.searchsorted(text, np.arange(len(first))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(first) - 1), pa.array(np.diff(first)),
                                                  pa.ListArray.from_arrays(pa.array(bounds), found)], names=["id", "n_words", "matches"])

    return over_texts(rows, run, f"id {id_type}, n_words long, matches array<struct<label:string,start:long,words:int,share:double,phrase:boolean>>")


def summary(scanned: DataFrame) -> DataFrame:
    """Per row: counts, first and last place of the phrases, and the labels as strings."""
    base = F.filter("matches", lambda m: m["phrase"])
    starts = F.transform(base, lambda m: m["start"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")

    return scanned.select(
        "id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"))
