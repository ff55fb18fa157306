"""Licence scans: paragraphs, a trained classifier of sparse word n-grams, and template comparison.

Training texts are made from the notices below: whole notices and their sentences, with words dropped
or replaced and foreign text around them, by a seeded generator; the unknown class is taught with
prose and legal-sounding text without a licence. A multinomial logistic regression over hashed word
1-, 2- and 3-grams names a family; its temperature and the bound under which a paragraph is unknown
are calibrated on made texts that the fit hasn't seen. A named family is confirmed when enough of a
template of that family, as word trigrams, stands in the paragraph. Lines are paragraphs; lines in a
row that aren't confirmed alone are scanned joined as well, and a confirmed run takes their place.

Only n-grams of the notices carry weight; a paragraph without any gets what the bias alone says, as any
other gets its sum. Every paragraph of every text is read whole. The model has a fixed size and is
fitted on the driver from the notices alone. ``evaluate`` gives its accuracy on made rows that neither
the fit nor the calibration has seen.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Notices and telling passages of public licences, by family.
NOTICES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: Apache-2.0"],
    "Artistic-2.0": ["Licensed under the Artistic License 2.0.", "This program is free software, you can redistribute it and/or modify it under the terms of the Artistic License version 2.0.", "SPDX-License-Identifier: Artistic-2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD-4-Clause": ["Licensed under the BSD 4-Clause License.", "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization.", "SPDX-License-Identifier: BSD-4-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "https://creativecommons.org/licenses/by/4.0/"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "https://creativecommons.org/licenses/by-nc/4.0/"],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "https://creativecommons.org/licenses/by-nc-nd/4.0/"],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "https://creativecommons.org/licenses/by-nc-sa/4.0/"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "https://creativecommons.org/licenses/by-nd/4.0/"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "https://creativecommons.org/licenses/by-sa/4.0/"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under the CC0 1.0 Universal Public Domain Dedication."],
    "EPL-2.0": ["Licensed under the Eclipse Public License 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "ISC": ["Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["Licensed under the Mozilla Public License 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Proprietary": ["All rights reserved.", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.", "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
    "Unlicense": ["Released under the Unlicense.", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": ["Licensed under the zlib License.", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely", "SPDX-License-Identifier: Zlib"],
}
# Text of the unknown class that shares words with licences.
OTHERS = [
    "The driver must carry a license at all times and show it on request.", "The city council granted a permission to use the software for the public library.", "A copy of the report is available under the terms agreed in the last meeting.",
    "The general public was free to attend; the foundation published the list of conditions.", "Users must read the source and keep a copy of the notice on the door.", "The Creative writing course takes place in the Commons building, version two of the plan.", "Apache helicopters and Mozilla developers were mentioned in the same article.",
    "The MIT campus opened a new building for the study of law.", "His work is known under many names and has been published in four languages.", "The rights of the author were discussed, and all seats were reserved.", "Eclipse of the sun: the public can see it free of charge from the hill.",
]
FAMILIES = ["unknown", *sorted(NOTICES)]
TOKEN = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_COMMENT = re.compile(r"^[\s*#/;>|%-]+")
WIDTH = 1 << 14
CONFIRM = 0.5
SEED = 5


def paragraphs(text: str | None) -> list[tuple[int, str]]:
    """(place, paragraph): lines of a text that aren't blank, with the code point at which each begins; a line is a paragraph here, as notices often end a block."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        if line.strip():
            out.append((at, line))
        at += len(line) + 1
    return out


def wrapped(lines: list[tuple[int, str]], confirmed: set[int]) -> list[list[int]]:
    """Runs of two lines or more (their numbers) between blank lines and lines that are confirmed alone: notices wrapped over lines."""
    runs: list[list[int]] = []
    for k, (at, _) in enumerate(lines):
        if k in confirmed:
            continue
        if runs and runs[-1][-1] == k - 1 and lines[k - 1][0] + len(lines[k - 1][1]) + 1 == at:
            runs[-1].append(k)
        else:
            runs.append([k])
    return [r for r in runs if len(r) > 1]


def unwrapped(lines: list[str]) -> str:
    """Lines joined, without the marks of comments that begin them; a word cut at a hyphen is one again."""
    out = ""
    for line in lines:
        line = _COMMENT.sub("", line).rstrip()
        out += line if out.endswith("-") else f" {line}"
    return out


def words_of(paragraph: str) -> list[str]:
    return TOKEN.findall(paragraph.lower())


def grams(words: list[str], n: int) -> list[str]:
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


@lru_cache(maxsize=100_000)
def _slot(gram: str) -> int:
    return int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=4).digest(), "little") % WIDTH


class Classifier:
    """Weights over hashed n-grams of the notices' vocabulary; one row a family, the unknown class first."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, vocabulary: frozenset[str], temperature: float, bound: float):
        self.weights, self.bias, self.vocabulary, self.temperature, self.bound = weights, bias, vocabulary, temperature, bound

    def features(self, words: list[str]) -> dict[int, float]:
        counts = Counter(g for n in (1, 2, 3) for g in grams(words, n) if g in self.vocabulary)
        norm = math.sqrt(sum(c * c for c in counts.values())) or 1.0
        out: dict[int, float] = {}
        for g, c in counts.items():
            out[_slot(g)] = out.get(_slot(g), 0.0) + c / norm
        return out

    def probabilities(self, words: list[str]) -> np.ndarray:
        z = self.bias.copy()
        for k, x in self.features(words).items():
            z += self.weights[:, k] * x
        z /= self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def predict(self, words: list[str]) -> tuple[str, float]:
        p = self.probabilities(words)
        k = 1 + int(p[1:].argmax())
        return (FAMILIES[k], float(p[k])) if 1 - p[0] >= self.bound else ("unknown", float(p[0]))


def compared(words: list[str], family: str) -> float:
    """The greatest share of a template of the family, in word trigrams (or its words, if fewer), found in the paragraph."""
    best = 0.0
    for template in _templates()[family]:
        n = min(3, len(template))
        want = Counter(grams(template, n))
        have = Counter(grams(words, n))
        best = max(best, sum((want & have).values()) / sum(want.values()))
    return best


@lru_cache(maxsize=1)
def _templates() -> dict[str, list[list[str]]]:
    return {f: [words_of(t) for t in texts] for f, texts in NOTICES.items()}


def _made(rng: random.Random, count: int) -> list[tuple[int, list[str]]]:
    """Seeded training rows: notices damaged and embedded; prose, damaged legal talk and shuffled notices as unknown."""
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "ve", "zo", "the", "an", "er", "ing", "tion", "de", "que", "ung"]
    prose = lambda n: ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    common = ["the", "of", "and", "to", "in", "is", "for", "this", "by", "or", "use", "all", "not", "work", "free", "public", "software", "license", "version", "under", "any", "copy", "2.0", "4.0", "3"]
    rows = []
    for k, family in enumerate(FAMILIES[1:], 1):
        for _ in range(count):
            w = list(rng.choice(_templates()[family]))
            w = [x for x in w if rng.random() > 0.06] if len(w) > 8 else w
            rows.append((k, prose(rng.choice((0, 0, 3, 12))) + w + prose(rng.choice((0, 0, 4, 15)))))
    for _ in range(count * 8):
        kind = rng.random()
        if kind < 0.4:
            w = [rng.choice(common) if rng.random() < 0.4 else x for x in prose(rng.randint(3, 60))]
        elif kind < 0.7:
            w = words_of(rng.choice(OTHERS)) + prose(rng.randint(0, 20))
        else:
            # Words of a notice, out of order: no licence.
            w = list(rng.choice(_templates()[rng.choice(FAMILIES[1:])]))
            rng.shuffle(w)
            w = w[: rng.randint(2, 12)] + prose(rng.randint(2, 20))
        rows.append((0, w))
    return rows


def train(seed: int = SEED, count: int = 40, rounds: int = 150) -> Classifier:
    """Fits and calibrates a classifier from the notices; the same seed gives the same one."""
    vocabulary = frozenset(g for ts in _templates().values() for t in ts for n in (1, 2, 3) for g in grams(t, n)) | frozenset(g for t in OTHERS for n in (1, 2, 3) for g in grams(words_of(t), n))
    model = Classifier(np.zeros((len(FAMILIES), WIDTH)), np.zeros(len(FAMILIES)), vocabulary, 1.0, 0.5)
    rng = random.Random(seed)
    rows = _made(rng, count)
    feats = [model.features(w) for _, w in rows]
    at = np.array([i for i, f in enumerate(feats) for _ in f])
    col = np.array([k for f in feats for k in f])
    val = np.array([x for f in feats for x in f.values()])
    y = np.zeros((len(rows), len(FAMILIES)))
    y[np.arange(len(rows)), [k for k, _ in rows]] = 1
    used, inverse = np.unique(col, return_inverse=True)
    x = np.zeros((len(rows), len(used)))
    np.add.at(x, (at, inverse), val)
    w, b = np.zeros((len(FAMILIES), len(used))), np.zeros(len(FAMILIES))
    v, vb = w.copy(), b.copy()
    for _ in range(rounds):
        z = x @ w.T + b
        p = np.exp(z - z.max(1, keepdims=True))
        e = p / p.sum(1, keepdims=True) - y
        v = 0.9 * v - 4.0 * (e.T @ x / len(rows) * len(FAMILIES) / 4 + 1e-5 * w)
        vb = 0.9 * vb - 1.0 * e.mean(0)
        w, b = w + v, b + vb
    model.weights[:, used] = w
    model.bias = b
    # Calibration on rows that the fit hasn't seen: temperature by likelihood, then the least bound under which 1 % of unknown rows pass at most.
    fresh = _made(random.Random(seed + 1), max(10, count // 2))
    raw = np.array([b + sum((model.weights[:, k] * xx for k, xx in model.features(ws).items()), np.zeros(len(FAMILIES))) for _, ws in fresh])
    truth = np.array([k for k, _ in fresh])

    def loss(t: float) -> float:
        z = raw / t
        return float(-(z - z.max(1, keepdims=True) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)))[np.arange(len(truth)), truth].mean())

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    z = raw / model.temperature
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    model.bound = float(min(0.95, max(0.5, np.quantile(1 - p[truth == 0, 0], 0.99))))
    return model


def evaluate(seed: int = SEED) -> dict[str, float]:
    """Shares named right of damaged and embedded rows of another seed: licences, and rows without one."""
    model, rows = train(seed), _made(random.Random(seed + 99), 20)
    named = [(FAMILIES[y], model.predict(w)[0]) for y, w in rows]
    licences, others = [x for x in named if x[0] != "unknown"], [x for x in named if x[0] == "unknown"]
    return {"licences": sum(a == b for a, b in licences) / len(licences), "unknown": sum(a == b for a, b in others) / len(others)}


FOUND = "n_paragraphs long, found array<struct<start: long, length: long, family: string, probability: double, overlap: double, confirmed: boolean>>"


def scan(df: DataFrame, text: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """The rows with n_paragraphs and ``found``: for each paragraph that a licence family was predicted for, its place, family, probability, the share of a template found, and whether that confirms it.

    Nulls: a null text has no paragraphs; other columns stay as they are, null or not. Texts are read
    whole. Ties between families go to the first by name. Repeated rows repeat. An empty table gives
    no rows. Columns named n_paragraphs or found are replaced.
    """
    small_batches(df.sparkSession)
    df = df.select(*[c for c in df.columns if c not in ("n_paragraphs", "found")])
    model = df.sparkSession.sparkContext.broadcast(train())
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)
    struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64()), ("confirmed", pa.bool_())]))

    def one(value: str | None) -> tuple[int, list[dict]]:
        m, lines = model.value, paragraphs(value)
        words = [words_of(x) for _, x in lines]
        found: dict[int, dict] = {}
        for k, (at, paragraph) in enumerate(lines):
            family, p = m.predict(words[k])
            if family != "unknown":
                share = compared(words[k], family)
                found[k] = {"start": at, "length": len(paragraph), "family": family, "probability": p, "overlap": share, "confirmed": share >= confirm}
        for run in wrapped(lines, {k for k, x in found.items() if x["confirmed"]}):
            joined = words_of(unwrapped([lines[k][1] for k in run]))
            family, p = m.predict(joined)
            # Long foreign text around a notice hides it from the classifier, not from its lines' families.
            named = {x["family"]: x["probability"] for x in (found[k] for k in run if k in found)} | ({family: p} if family != "unknown" else {})
            share, _, family = max(((compared(joined, f), f == family, f) for f in sorted(named)), default=(0.0, False, ""))
            if named and share >= confirm:
                start, (last, paragraph) = lines[run[0]][0], lines[run[-1]]
                for k in run:
                    found.pop(k, None)
                found[run[0]] = {"start": start, "length": last + len(paragraph) - start, "family": family, "probability": named[family], "overlap": share, "confirmed": True}
        return len(lines), [found[k] for k in sorted(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], struct)], names=[*batch.schema.names, "n_paragraphs", "found"])

    return df.mapInArrow(run, kinds + FOUND)


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_predicted, n_confirmed, families (confirmed ones, sorted), best probability."""
    sure = F.filter("found", lambda x: x["confirmed"])
    return scanned.select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_predicted"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"), F.array_max(F.transform(sure, lambda x: x["probability"])).alias("probability"),
    )
