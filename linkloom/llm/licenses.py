"""Licence scans by a trained paragraph classifier, as DataFrame functions only.

A paragraph is a run of lines with words. As a notice may be one line of it or several, lines are scored alone and neighbouring lines
together (see `_windows`). Of findings that share a line the one with most of its template counts, of equal ones that of fewest lines,
at its first line; findings of one family that are close together are one notice. A paragraph's features are its word n-grams (one to three words), hashed to BUCKETS. A softmax
regression over them, with a class for what is no licence, is fitted on the driver: on paragraphs of licence texts, on sentences
that name a licence, made of NAMES and CARRIERS, on altered copies of both (words dropped, other text around), and on
text that only sounds like a licence. The scale of its scores is calibrated on altered copies that it wasn't fitted on. The
training set is these fixed texts alone, so the model has the same size for any corpus. `held_out_report` fits without a
part of the templates, and without HELD_CARRIERS and HELD_OTHERS, and counts what is found of these.

A predicted family counts if its probability is at least LEAST_P and one of the family's templates is found: all n-grams of
a short one, LEAST_FOUND of those of one with more than SHORT. Otherwise it is `unknown`. A line is looked at if it or a line beside it has one of the words of
`anchors`, which are chosen so that what a template holds without any of them is too little: nothing is lost by it.

Cases: a null text counts as empty; every line of a text of any length is looked at; repeated rows stay; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from functools import cache
from math import ceil

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import text_or_empty

BUCKETS, LONGEST = 4096, 3
LEAST_P, LEAST_FOUND, SHORT = 0.5, 0.6, 9
UNKNOWN = "unknown"
#: Lines that are scored together, the most words of those between the first and the last, and the words of these two.
TOGETHER, BETWEEN, EDGE = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 48), 80, 24
#: Findings of a family that are at most so many lines apart are one notice.
NEAR = 3
WORD = "[a-z0-9.+]*[a-z0-9+]"

#: What licences are called.
NAMES = {
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0", "Apache Software License 2.0"),
    "mit": ("MIT License", "MIT", "MIT/X11 license", "Expat license"),
    "gpl-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GPL version 3", "GPL v3", "GPLv3", "GPL-3.0", "GPL-3.0-or-later", "GPL-3.0-only"),
    "gpl-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GPL version 2", "GPL v2", "GPLv2", "GPL-2.0", "GPL-2.0-or-later", "GPL-2.0-only"),
    "lgpl": ("GNU Lesser General Public License", "GNU Library General Public License", "LGPL version 2.1", "LGPL v3", "LGPLv2.1", "LGPLv3", "LGPL-2.1", "LGPL-3.0", "LGPL-2.1-or-later"),
    "agpl-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License", "AGPL v3", "AGPLv3", "AGPL-3.0", "AGPL-3.0-or-later"),
    "bsd": ("BSD License", "BSD 3-Clause License", "3-Clause BSD License", "2-Clause BSD License", "New BSD License", "Simplified BSD License", "BSD-3-Clause", "BSD-2-Clause", "BSD-style license"),
    "mpl-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
    "cc-by": ("CC BY 4.0", "CC-BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "Creative Commons BY 4.0"),
    "cc-by-sa": ("CC BY-SA 4.0", "CC-BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License", "Creative Commons BY-SA 4.0"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC-BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License", "Creative Commons BY-NC 4.0"),
    "cc0": ("CC0 1.0 Universal", "CC0 1.0", "CC0", "Creative Commons Zero", "CC0-1.0"),
    "isc": ("ISC License", "ISC license terms", "ISC"),
    "unlicense": ("The Unlicense", "Unlicense"),
    "proprietary": (),
}
#: Sentences that name a licence.
CARRIERS = (
    "Licensed under {}.", "Licensed under the {}", "This project is licensed under the {}.", "Released under {}", "Distributed under the terms of the {}.", "SPDX-License-Identifier: {}",
    "License: {}", "Available under the {}", "This file is made available under the {}.", "The code is covered by the {}.", "You may use it under the {}, see the file.", "published under {} license", "Copying is subject to {}",
)
#: The same, never learned from.
HELD_CARRIERS = ("This work is licensed under the {}.", "Released by its authors under the {}.", "Use of this source is subject to the terms of the {}", "It is licensed to you under {}", 'license = "{}"', "Documentation: licensed under the {}, like all else here.")
#: Paragraphs of licence texts and of the notices that they ask for.
TEXTS = {
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "gpl-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "gpl-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    "agpl-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/",),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/",),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. This work is published from:",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "proprietary": (
        "Copyright by the company, all rights reserved, worldwide",
        "All rights reserved",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
#: Text that is no notice.
OTHERS = (
    "He renewed his driver license last week and drove home.", "The restaurant lost its license to sell wine.", "A license fee is due each year for the television.", "The doctors are licensed in two states.",
    "Copyright law differs between countries.", "She wrote a book about copyright and patents.", "Please ask the office for a fishing license.", "The license plate was hard to read.",
    "Poetic license lets a writer bend the rules.", "The company sells licenses and support.", "Licensed premises must close at midnight.", "There is no license here.", "The terms of the contract are secret.",
    "A new license was discussed at the meeting.", "The warranty covers parts and labour for two years.", "Permission was given to enter the building.",
    "All seats are reserved for guests.", "The rights of all people are the same.", "Sie kam mit dem Zug und mit Freunden.", "The software is in version 2.0 of the program.", "The public has a general interest in it.",
    "He studied at MIT in Boston.", "Apache helicopters flew over the valley.", "The Apache people lived in the south west.", "The Mozilla foundation builds a browser.", "BSD systems and GNU tools run on many machines.",
    "Version 3 of the program came out in May.", "Version 2 is older than version 3.", "The general public may visit the library on Sundays.", "The commons were open to all, and creative people met there.",
    "Attribution of the painting is disputed.", "The domain of the function is the real line.", "The work is published in four volumes.", "Redistribution of income is a matter of politics.", "Any person obtaining a ticket may enter.",
    "Er hat mit der Lizenz nichts zu tun.", "Le permis est libre pour tous.", "La obra tiene derechos de autor.", "The file is distributed to all members free of charge.", "The terms of use changed under the new owner.",
    "The above notice hangs in the hall.", "Use of the pool is subject to the following conditions.", "The library is distributed over three floors.", "Neither the name nor the address was written down.",
)
#: The same, never learned from.
HELD_OTHERS = (
    "She lost her pilot license after the accident.", "Students at MIT built a robot.", "The council will license twelve taxis.", "The Apache river flooded the road in spring.", "General elections are public in this country.",
    "A copy of the agreement was given to any person who asked.", "Version 2.0 of the report is on the table.", "They released the birds under a clear sky.", "The rights to the film were sold to a studio.", "The hall is reserved for all members.",
    "Software is written in many languages.", "Das Kind lief mit dem Hund in den Wald.", "The binary star has two sources of light.", "Creative writing is taught on Mondays.", "The license of the hunter expired.", "Two clauses of the contract were dropped.",
    "Mozilla released a new browser version 3.", "The library is open to the public in general.", "Copyright was the subject of the talk.", "No part of the road is closed.",
)
FILLER = "the of and that on in was with for by it is as to are this from a lorem text page here more note see also below".split()


def templates() -> dict[str, list[str]]:
    """What a predicted family is held against. A name of one word that is a word elsewhere too needs one beside it."""
    alone = {"MIT": ("under MIT", "under the MIT", "terms of the MIT", "identifier MIT", "license MIT"), "ISC": ("under ISC", "under the ISC", "terms of the ISC", "identifier ISC", "license ISC")}
    return {f: [t for n in names for t in alone.get(n, (n,))] + list(TEXTS[f]) for f, names in NAMES.items()}


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def n_grams(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + n]) for n in range(1, LONGEST + 1) for i in range(len(words) - n + 1)]


def needed(grams: int) -> int:
    """How many of a template's n-grams must be found."""
    return grams if grams <= SHORT else ceil(LEAST_FOUND * grams)


@cache
def anchors() -> tuple[str, ...]:
    """Words, one of which is in any text that holds enough of a template: of each template the longest (of FILLER last), as many as that takes."""
    found: set[str] = set()
    for text in (t for texts in templates().values() for t in texts):
        grams = {tuple(g.split()) for g in n_grams(words_of(text))}
        for word in sorted({w for g in grams for w in g}, key=lambda w: (w not in found, w in FILLER, -len(w), w)):
            if sum(found.isdisjoint(g) for g in grams) < needed(len(grams)):
                break
            found.add(word)
    return tuple(sorted(found))


def anchored(paragraph: Column) -> Column:
    """Whether a paragraph has an anchor, as WORD cuts words."""
    return F.lower(paragraph).rlike(rf"(?<![a-z0-9.+])(?:{'|'.join(map(re.escape, anchors()))})(?![a-z0-9+])")


def bucket(gram: str) -> int:
    """As Spark's xxhash64."""
    found = xxhash.xxh64_intdigest(gram.encode(), seed=42)
    return (found - 2**64 if found >= 2**63 else found) % BUCKETS


def _altered(text: str, random: np.random.Generator, n: int) -> list[str]:
    found = [text]
    for _ in range(n):
        words = text.split()
        kept = [w for w in words if random.random() > 0.08] or words
        around = [list(random.choice(FILLER, int(random.integers(0, 12)))) for _ in range(2)]
        found.append(" ".join([*around[0], *kept, *around[1]]))
    return found


def training_set(names: dict[str, tuple[str, ...]], texts: dict[str, tuple[str, ...]], random: np.random.Generator) -> list[tuple[str, int]]:
    """(text, class) of the families, in their order from 1 on, and of no licence, 0."""
    rows = []
    for k, family in enumerate(NAMES, 1):
        said = [c.format(n) for n in names[family] for c in CARRIERS] + [n for n in names[family] if n not in ("MIT", "ISC")]
        rows += [(t, k) for text in said for t in _altered(text, random, 1 if len(text.split()) > 1 else 24)]
        rows += [(t, k) for text in texts[family] for t in _altered(text, random, 24)]
    rows += [(t, 0) for text in OTHERS for t in _altered(text, random, 12)]
    rows += [(" ".join(random.choice([*FILLER, "license", "licensed", "copyright", "rights", "terms", "under", "version", "software", "public", "general", "mit"], int(random.integers(3, 30)))), 0) for _ in range(300)]
    return rows


def fit(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(weights by bucket and class, bias), the scores' scale calibrated on every fifth row, which isn't learned from."""
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (text, _) in enumerate(rows):
        for g in n_grams(words_of(text)):
            x[i, bucket(g)] = 1
    used = np.flatnonzero(x.any(axis=0))
    x = x[:, used]
    y = np.eye(len(NAMES) + 1, dtype=np.float32)[[k for _, k in rows]]
    held = np.arange(len(rows)) % 5 == 4
    own, asked, gold = x[~held], x[held], y[~held]
    w, b = np.zeros((len(used), y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)

    def p(x, scale=1.0):
        s = (x @ w + b) * scale
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    for _ in range(250):
        error = (p(own) - gold) / len(own)
        w -= 2.0 * (own.T @ error + 2e-4 * w)
        b -= 2.0 * error.sum(axis=0)
    scale = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0), key=lambda s: -np.log(np.maximum((p(asked, s) * y[held]).sum(axis=1), 1e-12)).mean())
    weights = np.zeros((BUCKETS, y.shape[1]), np.float32)
    weights[used] = w * scale
    # as they are sent
    return np.where(np.abs(weights).max(axis=1, keepdims=True) > 1e-4, np.round(weights.astype(float), 5), 0.0), np.round((b * scale).astype(float), 5)


@cache
def model() -> tuple[list[str], np.ndarray, np.ndarray]:
    """(classes, weights by bucket and class, bias)"""
    return [UNKNOWN, *NAMES], *fit(training_set(NAMES, TEXTS, np.random.Generator(np.random.PCG64(9))))


def judge(words: list[str], fitted: tuple[list[str], np.ndarray, np.ndarray]) -> tuple[str, float, float]:
    """What `classify` says of one paragraph, on the driver: (family, p, share)."""
    classes, weights, bias = fitted
    grams = set(n_grams(words))
    scores = bias + weights[sorted({bucket(g) for g in grams})].sum(axis=0)
    family = classes[int(scores.argmax())]
    p = float(1 / np.exp(scores - scores.max()).sum())
    held = [(len(own & grams), len(own)) for t in templates().get(family, []) for own in [set(n_grams(words_of(t)))]]
    share = max((n / of for n, of in held), default=0.0)
    return family if p >= LEAST_P and any(n >= needed(of) for n, of in held) else UNKNOWN, p, share


def held_out_report(folds: int = 3) -> dict[str, tuple[int, int, int]]:
    """Of each family and of unknown: (asked, found right, wrongly found) among what wasn't learned from.

    In each fold a part of the names and paragraphs isn't learned from; asked are these, names in HELD_CARRIERS, and HELD_OTHERS.
    """
    found = {c: [0, 0, 0] for c in (UNKNOWN, *NAMES)}
    for fold in range(folds):
        out = lambda xs: {x for i, x in enumerate(xs) if len(xs) > 1 and i % folds == fold}  # noqa: B023, E731
        less = lambda sets: {f: tuple(x for x in xs if x not in out(xs)) for f, xs in sets.items()}  # noqa: E731, B023
        fitted = [UNKNOWN, *NAMES], *fit(training_set(less(NAMES), less(TEXTS), np.random.Generator(np.random.PCG64(fold))))
        asked = [(c.format(n), f) for f, names in NAMES.items() for n in out(names) for c in HELD_CARRIERS] + [(t, f) for f, texts in TEXTS.items() for t in out(texts)] + [(t, UNKNOWN) for t in HELD_OTHERS]
        for text, family in asked:
            said = judge(words_of(text), fitted)[0]
            found[family][0] += 1
            found[family][1] += said == family
            found[said][2] += said != family
    return {k: tuple(v) for k, v in found.items()}


def _literal(value, kind: str) -> Column:
    """A constant, worked out once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _grams(words: Column, n: int) -> Column:
    last = F.size(words) - n + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def classify(words: Column) -> Column:
    """struct(family, p, share): of one paragraph's words; share: how much of a template of the family was found."""
    classes, weights, bias = model()
    table = _literal([row.tolist() if row.any() else [] for row in weights], "array<array<double>>")
    start = _literal(bias.tolist(), "array<double>")
    grams = F.array_distinct(F.concat(*(_grams(words, n) for n in range(1, LONGEST + 1))))
    rows = F.array_distinct(F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int") + 1))
    used = F.filter(F.transform(rows, lambda r: F.element_at(table, r)), lambda v: F.size(v) > 0)
    scores = F.aggregate(used, start, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))

    def decided(s: Column) -> Column:
        top = F.array_max(s)
        p = 1 / F.aggregate(s, F.lit(0.0), lambda a, v: a + F.exp(v - top))
        family = F.element_at(_literal(classes, "array<string>"), F.array_position(s, top).cast("int"))
        asked = lambda t: {"grams": sorted(set(n_grams(words_of(t)))), "least": needed(len(set(n_grams(words_of(t)))))}
        known = _literal({f: list(map(asked, texts)) for f, texts in templates().items()}, "map<string,array<struct<grams:array<string>,least:int>>>")
        counted = lambda t: F.transform(F.array(F.size(F.array_intersect(t["grams"], grams))), lambda n: F.struct((n / F.size(t["grams"])).alias("share"), (n >= t["least"]).alias("found")))

        def held(f: Column) -> Column:
            return F.flatten(F.transform(F.element_at(known, f), counted))

        def said(f: Column, of: Column) -> Column:
            found = F.coalesce(F.exists(of, lambda x: x["found"]), F.lit(False))
            share = F.array_max(F.transform(of, lambda x: x["share"]))
            return F.struct(F.when((p >= LEAST_P) & found, f).otherwise(F.lit(UNKNOWN)).alias("family"), F.round(p, 6).alias("p"), F.coalesce(share, F.lit(0.0)).alias("share"))

        return F.element_at(F.transform(F.array(family), lambda f: F.element_at(F.transform(F.array(held(f)), lambda of: said(f, of)), 1)), 1)

    return F.element_at(F.transform(F.array(scores), decided), 1)


def _windows() -> Column:
    """array<struct<from, to, words>>: lines with an anchor, and neighbouring lines with one together.

    Lines without words end a notice. Long lines at the edges count with the words next to the others only. The numbers of lines grow by
    steps: a notice of any number up to the last one fits the next step with few lines of other text.
    """
    of = lambda i: F.element_at("words", i + 1)
    alone = F.transform(F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.element_at("hit", i + 1)), lambda i: F.struct(i.alias("from"), i.alias("to"), of(i).alias("words")))

    def fits(i: Column, m: Column) -> Column:
        sizes = F.slice("sizes", i + 1, m)
        between = F.aggregate(F.slice("sizes", i + 2, m - 2), F.lit(0), lambda a, n: a + n)
        return F.when(i + m > F.size("words"), False).otherwise((between <= BETWEEN) & F.exists(F.slice("hit", i + 1, m), lambda h: h) & (F.array_min(sizes) > 0))

    def joined(i: Column, m: Column) -> Column:
        first, last = of(i), of(i + m - 1)
        tail = F.slice(first, F.greatest(F.lit(1), F.size(first) - EDGE + 1), F.lit(EDGE))
        words = F.concat(tail, F.flatten(F.slice("words", i + 2, m - 2)), F.slice(last, 1, EDGE))
        return F.struct(i.alias("from"), (i + m - 1).alias("to"), words.alias("words"))

    steps = F.array(*map(F.lit, TOGETHER))
    together = F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.transform(F.filter(steps, lambda m: fits(i, m)), lambda m: joined(i, m)))
    none = F.array().cast("array<struct<from:int,to:int,words:array<string>>>")
    return F.when(F.exists("hit", lambda h: h), F.concat(alone, F.flatten(together))).otherwise(none)


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, found: array<struct<at, family, p>> of lines with an anchor word and of notices over several lines, counted from 0."""
    once = lambda df, name, c, *keep: df.select("doc_id", *keep, F.explode(F.array(c)).alias(name))  # noqa: E731  worked out once
    docs = documents.select("doc_id", F.split(text_or_empty(), "\n").alias("lines"))
    hits = once(docs, "hit", F.transform("lines", anchored), "lines")
    any_ = F.exists("hit", lambda h: h)
    worded = F.when(any_, F.transform("lines", lambda s: F.regexp_extract_all(F.lower(s), F.lit(WORD), F.lit(0)))).otherwise(F.array().cast("array<array<string>>"))
    words = once(hits.withColumn("n_paragraphs", F.size("lines").cast("long")), "words", worded, "n_paragraphs", "hit")
    asked = once(words.withColumn("sizes", F.transform("words", lambda w: F.size(w))), "asked", _windows(), "n_paragraphs")

    def one(x: Column) -> Column:
        c = classify(x["words"])
        return F.struct((-c["share"]).alias("rank"), (x["to"] - x["from"]).alias("more"), x["from"].alias("at"), c["family"].alias("family"), c["p"].alias("p"))

    judged = once(asked, "judged", F.transform("asked", one), "n_paragraphs")
    sure = F.array_sort(F.filter("judged", lambda x: x["family"] != UNKNOWN))
    start = F.struct(F.array_repeat(F.lit(""), F.col("n_paragraphs").cast("int")).alias("lines"), F.array().cast("array<struct<at:int,family:string,p:double>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        """lines: the family found in each."""
        lines, at, n = acc["lines"], x["at"], x["more"] + 1
        own = F.array_repeat(x["family"], n)
        marked = F.concat(F.slice(lines, 1, at), own, F.slice(lines, at + n + 1, F.size(lines)))
        around = F.concat(F.slice(lines, F.greatest(F.lit(1), at - NEAR + 1), F.least(at, F.lit(NEAR))), F.slice(lines, at + n + 1, F.lit(NEAR)))
        rest = F.array_contains(around, x["family"])  # of a notice beside it
        out = F.when(rest, acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(at.alias("at"), x["family"].alias("family"), x["p"].alias("p")))))
        return F.when(F.exists(F.slice(lines, at + 1, n), lambda f: f != ""), acc).otherwise(F.struct(marked.alias("lines"), out.alias("out")))

    taken = once(judged, "taken", F.when(F.size(sure) > 0, F.aggregate(sure, start, step)).otherwise(start), "n_paragraphs", "judged")
    unknown = F.filter("judged", lambda x: (x["more"] == 0) & (x["family"] == UNKNOWN) & (F.get(F.col("taken.lines"), x["at"]) == ""))
    found = F.concat("taken.out", F.transform(unknown, lambda x: F.struct(x["at"].alias("at"), x["family"].alias("family"), x["p"].alias("p"))))
    return taken.select("doc_id", "n_paragraphs", F.array_sort(found).alias("found"))


def summary(documents: DataFrame) -> DataFrame:
    """Per document: n_paragraphs, n_candidates, n_licences, licences (place:family, joined by commas), p (the least sure one's)."""
    sure = F.filter("found", lambda x: x["family"] != UNKNOWN)
    return scan(documents).select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_candidates"), F.size(sure).cast("long").alias("n_licences"),
        F.array_join(F.transform(sure, lambda x: F.concat_ws(":", x["at"], x["family"])), ",").alias("licences"),
        F.array_min(F.transform(sure, lambda x: x["p"])).alias("p"),
    )
