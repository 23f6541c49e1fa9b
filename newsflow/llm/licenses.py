"""Licence notices by a trained paragraph classifier, confirmed by templates.

Paragraphs are bags of word 1- and 2-grams in a sparse hashed space. A softmax
regression gives each licence family and ``unknown`` a probability; a temperature
fitted on held-out paragraphs calibrates it. A prediction counts if it is
probable enough and a template of its family is close.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm import words as W
from newsflow.llm.tables import rest
from newsflow.llm.texthash import WindowHash, chunks, mix, utf8, word_hashes

UNKNOWN = "unknown"
#: How notices of each family read.
TEMPLATES = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the 3-clause BSD license.",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under CC BY-NC-SA 4.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Released under CC BY-SA 4.0.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "AGPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC license.",
        "SPDX-License-Identifier: ISC",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable",
        "Released under the zlib license.",
        "SPDX-License-Identifier: Zlib",
    ),
}
#: What each family is called, as runs of whole words.
NAMES = {
    "Apache": ("apache license", "apache licence", "apache 2 0", "apache software license"),
    "MIT": ("mit license", "mit licence", "mit licensed", "identifier mit", "license mit", "licence mit"),
    "GPL": ("gnu general public license", "gnu general public licence", "gnu gpl", "gplv2", "gplv3", "gpl 2 0", "gpl 3 0", "gpl version", "gpl v2", "gpl v3", "gpl license"),
    "LGPL": ("lesser general public license", "lesser general public licence", "library general public license", "gnu lgpl", "lgplv2", "lgplv3", "lgpl 2 1", "lgpl 3 0", "lgpl version", "lgpl license"),
    "AGPL": ("affero general public license", "affero general public licence", "gnu agpl", "agplv3", "agpl 3 0", "agpl version", "agpl license"),
    "BSD": ("bsd license", "bsd licence", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd"),
    "MPL": ("mozilla public license", "mozilla public licence", "mpl 1 1", "mpl 2 0", "mplv2"),
    "EPL": ("eclipse public license", "eclipse public licence", "epl 1 0", "epl 2 0"),
    "ISC": ("isc license", "isc licence", "identifier isc"),
    "Unlicense": ("the unlicense", "identifier unlicense"),
    "zlib": ("zlib license", "zlib licence", "identifier zlib"),
    "CC-BY-NC": ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    "CC-BY": ("cc by", "creative commons attribution"),
    "CC0": ("cc0 1 0", "cc0 license", "creative commons zero"),
}
#: A name inside a longer one of another family does not count.
WIDER = {"CC-BY": ("CC-BY-NC",)}
CONTEXT = 8  # words on either side of a notice that the classifier sees
REACH = 9  # lines before and after an anchor that may belong to its notice
#: Sentences on licences that grant none.
PLAIN = (
    "You need a license to drive a car in this country.", "The licence fee was paid in full last year.",
    "All rights reserved.", "Copyright 2020 the authors.", "The software was written at a public university.",
    "He lost his fishing license in version two of the story.", "Read the terms of use before you continue.",
    "The general public was not admitted to the library.", "Creative people share common ideas.",
)
BITS = 14
_OUTSIDE = np.ones(256, bool)  # bytes outside words: ASCII but letters and digits
_OUTSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]
    weights: np.ndarray  # features + 1 by families, unknown last
    temperature: float
    least: float  # probability from which a family is believed


def features(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word pairs of paragraphs, one after another, and where each begins."""
    data = [p.encode() for p in paragraphs]
    offsets = np.cumsum([0, *map(len, data)])
    return _features(WindowHash(4), np.frombuffer(b"".join(data), np.uint8), offsets)


def _features(roll, data, offsets):
    """Each paragraph has the constant feature, its words, and its pairs of words."""
    words, first = word_hashes(roll, data, offsets, _OUTSIDE)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])[owner[1:] == owner[:-1]] if len(words) else words
    flat = np.concatenate([np.full(n, 1 << BITS), *((x >> np.uint64(64 - BITS)).astype(np.int64) for x in (words, pairs))])
    owner = np.concatenate([np.arange(n), owner, owner[1:][owner[1:] == owner[:-1]]])
    order = np.argsort(owner, kind="stable")
    return flat[order], np.searchsorted(owner[order], np.arange(n + 1))


def _words(paragraph: str) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", paragraph.lower())


def training_paragraphs(docs: DataFrame, sample: int, seed: int) -> list[tuple[str, str]]:
    """Labelled paragraphs: varied templates, and paragraphs of ``sample`` documents that name no licence.

    The bound ``sample`` holds for the training texts only; all documents are scored.
    """
    hint = "(?i)licen[cs]e|copyright|spdx|creative commons|public domain|gnu|apache|\\bcc[ -]by"
    text = W.text_of("text")
    drawn = docs.select(text.alias("text")).where(~F.rlike(F.col("text"), F.lit(hint))).withColumn("at", F.xxhash64("text", F.lit(seed)))
    # the smallest hashes come alone; their texts follow, each once, so that few texts pass through the driver
    times = Counter(r["at"] for r in drawn.select("at").orderBy("at").limit(sample).collect())
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(a,) for a in times], "at long"))
    texts = drawn.join(chosen, "at", "left_semi").groupBy("at").agg(F.min("text").alias("text")).orderBy("at").collect()
    rows = [r for r in texts for _ in range(times[r["at"]])]
    random = np.random.RandomState(seed)
    plain = [p for r in rows for p in r.text.split("\n") if p.strip()]
    words = [w for p in plain for w in p.split()][:20_000] or ["text"]

    def some(n: int) -> str:
        return " ".join(words[i] for i in random.randint(0, len(words), n))

    out = [(UNKNOWN, p) for p in plain]
    for family, texts in TEMPLATES.items():
        for t in (*texts, *NAMES[family]):
            out += [(family, t)] * 10
            for _ in range(30):
                own = t.split()
                own = [w for w in own if len(own) < 6 or random.rand() > 0.05]
                around = some(random.randint(0, 12)), some(random.randint(0, 12))
                out.append((family, " ".join(x for x in (around[0], " ".join(own), around[1]) if x)))
    for t in PLAIN:
        out += [(UNKNOWN, t)] * 5 + [(UNKNOWN, f"{some(5)} {t} {some(5)}") for _ in range(10)]
    return [out[i] for i in random.permutation(len(out))]


def train(labelled: list[tuple[str, str]], steps: int = 120, rate: float = 0.5, decay: float = 1e-5) -> Model:
    """Softmax regression on three quarters of the paragraphs; the rest calibrates it."""
    families = (*sorted({f for f, _ in labelled} - {UNKNOWN}), UNKNOWN)
    target = np.array([families.index(f) for f, _ in labelled])
    held = np.arange(len(labelled)) % 4 == 3
    flat, ends = features([p for _, p in labelled])
    used, flat = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(labelled)), np.diff(ends))
    scale = 1 / np.sqrt(np.diff(ends))
    weights = np.zeros((len(used), len(families)))
    squares = np.full_like(weights, 1e-8)
    balance = 1 / np.maximum(np.bincount(target[~held], minlength=len(families)), 1)
    weight = np.where(held, 0, np.sqrt(balance[target]))
    weight /= weight.sum()

    def scores():
        return np.add.reduceat(weights[flat], ends[:-1], axis=0) * scale[:, None]

    by_feature = np.argsort(flat, kind="stable")
    first = np.searchsorted(flat[by_feature], np.arange(len(used)))
    wanted = np.eye(len(families))[target]
    for _ in range(steps):
        slope = (_softmax(scores()) - wanted) * (weight * scale)[:, None]
        change = np.add.reduceat(slope[owner[by_feature]], first, axis=0) + decay * weights
        squares += change**2
        weights -= rate * change / np.sqrt(squares)
    logits = scores()[held]
    losses = {t: -np.log(_softmax(logits / t)[np.arange(held.sum()), target[held]] + 1e-12).mean() for t in (0.25, 0.5, 0.75, 1, 1.5, 2, 3)}
    temperature = min(losses, key=losses.get)
    sure = _softmax(logits / temperature)
    best, right = sure.argmax(axis=1), sure.argmax(axis=1) == target[held]
    said = best < len(families) - 1
    least = 0.5  # the lowest probability that is right in 99 % of the held-out predictions
    for p in np.arange(0.5, 0.96, 0.05):
        least = float(p)
        if right[said & (sure.max(axis=1) >= p)].mean() >= 0.99:
            break
    full = np.zeros(((1 << BITS) + 1, len(families)), np.float32)
    full[used] = weights
    return Model(families, full, float(temperature), least)


def _softmax(x):
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def closeness(words: list[str], family: str) -> float:
    """Largest share of a template's word pairs that a paragraph has."""
    own = set(zip(words, words[1:], strict=False))
    best = 0.0
    for t in TEMPLATES[family]:
        pairs = _words(t)
        pairs = set(zip(pairs, pairs[1:], strict=False))
        best = max(best, len(pairs & own) / len(pairs))
    return best


def confirmed(words: list[str], family: str, close: float) -> bool:
    """Whether a paragraph holds a name of the family or, naming no other, ``close`` of a template."""
    says = named(words)
    return family in says if says else closeness(words, family) >= close


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def _forms() -> list[tuple[str, frozenset, float]]:
    """Family, word pairs and the share of them that a notice needs; all pairs of a name."""
    out = [(f, frozenset(_pairs(_words(t))), False) for f, texts in TEMPLATES.items() for t in texts]
    out += [(f, tuple(n.split()), True) for f, names in NAMES.items() for n in names]
    return out


def anchors(close: float) -> dict[str, list]:
    """Rarely met words, one of which every notice holds, with the forms they lead to.

    A notice misses at most a share of 1 - ``close`` of its template's pairs; so it holds one of any
    larger set of them, here of those with the longest words. Of a name it holds all words.
    """
    out: dict[str, list] = {}
    for form in _forms():
        family, parts, name = form
        if name:
            out.setdefault(max(parts, key=len) if len(parts) > 1 else parts[0], []).append(form)
            continue
        n = len(parts) - int(np.ceil(close * len(parts) - 1e-9)) + 1
        longest = sorted(parts, key=lambda p: (-max(map(len, p)), p))[:n]
        for p in longest:
            held = out.setdefault(max(p, key=len), [])
            if form not in held:
                held.append(form)
    return out


def named(words: list[str]) -> set[str]:
    """The families whose names are in a run of words."""
    text = f" {' '.join(words)} "
    found = {f for f, names in NAMES.items() if any(f" {n} " in text for n in names)}
    return {f for f in found if not found & set(WIDER.get(f, ()))}


def notices_at(run: list[list[str]], at: int, forms: list, close: float) -> set[tuple[int, int, str, int, int, int]]:
    """Notices around line ``at`` of a run of lines, each the words of one line.

    First and last line of each, its family, and its first and last word in the run's lines from
    ``at - REACH`` on. The fewest lines are taken that hold as much of a form as all lines in reach do.
    """
    low = max(0, at - REACH)
    lines = run[low : at + REACH + 1]
    flat = [w for x in lines for w in x]
    line_of = [low + i for i, x in enumerate(lines) for _ in x]
    text = list(zip(flat, flat[1:], strict=False))
    out = set()
    for family, parts, name in forms:
        if name:
            k = len(parts)
            spans = [(i, i + k - 1) for i in range(len(flat) - k + 1) if tuple(flat[i : i + k]) == parts and line_of[i] <= at <= line_of[i + k - 1]]
        else:
            met = [i for i, p in enumerate(text) if p in parts]
            if len({text[i] for i in met}) < close * len(parts):
                continue
            spans = [(lo, hi + 1) for lo, hi in _tightest(text, met, parts)]
        for lo, hi in spans:
            out.add((line_of[lo], line_of[hi], family, max(0, lo - CONTEXT), hi + CONTEXT + 1, low))
    return out


def _tightest(text, met, parts):
    """The shortest stretch that holds as many different pairs of ``parts`` as all of ``met``."""
    whole, count, left, best = len({text[i] for i in met}), {}, 0, None
    for i in met:
        count[text[i]] = count.get(text[i], 0) + 1
        while len(count) == whole:
            j = met[left]
            if best is None or i - j < best[1] - best[0]:
                best = (j, i)
            count[text[j]] -= 1
            if not count[text[j]]:
                del count[text[j]]
            left += 1
    return [best]


def joined_notices(lines: list[str], model: Model, leads: dict[str, list], close: float) -> list[tuple[int, int, str, float]]:
    """First and last line, family and probability of the notices of a text, also across line ends.

    Lines without a word part the runs that are joined. A notice counts if it holds a name of its family or
    ``close`` of a template, and the classifier, shown it with ``CONTEXT`` words around it, believes
    in a licence. Where names are held, only the named families count.
    """
    held = [_words(x) for x in lines]
    found, run, start = set(), [], 0
    for i, words in enumerate([*held, []]):
        if words:
            run.append(words)
            continue
        for at, x in enumerate(run):
            forms = {id(f): f for w in set(x) & leads.keys() for f in leads[w]}
            if forms:
                low = max(0, at - REACH)
                flat = [w for y in run[low : at + REACH + 1] for w in y]
                for a, b, family, lo, hi, _ in notices_at(run, at, list(forms.values()), close):
                    found.add((start + a, start + b, family, " ".join(flat[lo:hi])))
        run, start = [], i + 1
    if not found:
        return []
    found = sorted(found)
    score = _probabilities(*features([x[3] for x in found]), model)
    unknown = model.families.index(UNKNOWN)
    best: list[tuple[int, int, str, float]] = []
    for (a, b, family, words), p in zip(found, score, strict=True):
        says = named(words.split())
        if 1 - p[unknown] >= model.least and (not says or family in says):
            best.append((a, b, family, float(1 - p[unknown])))
    # one notice per family and stretch of lines: the longest, then the most probable
    out: list[tuple[int, int, str, float]] = []
    for x in sorted(best, key=lambda x: (x[0] - x[1], -x[3], x)):
        if not any(x[2] == y[2] and x[0] <= y[1] and y[0] <= x[1] for y in out):
            out.append(x)
    return sorted(out)


def predict(paragraphs: list[str], model: Model, close: float = 0.6) -> list[tuple[str, float]]:
    """Family and probability of each paragraph; ``unknown`` unless believed and confirmed."""
    best, sure = _classify(*features(paragraphs), model)
    out = []
    for p, b, s in zip(paragraphs, best.tolist(), sure.tolist(), strict=True):
        known = model.families[b] != UNKNOWN and s >= model.least and confirmed(_words(p), model.families[b], close)
        out.append((model.families[b] if known else UNKNOWN, s))
    return out


def _classify(flat, ends, model):
    if len(ends) < 2:
        return np.zeros(0, np.int64), np.zeros(0)
    sure = _probabilities(flat, ends, model)
    return sure.argmax(axis=1), sure.max(axis=1)


def _probabilities(flat, ends, model):
    score = np.add.reduceat(model.weights[flat], ends[:-1], axis=0) / np.sqrt(np.diff(ends))[:, None]
    return _softmax(score / model.temperature)


def scan_licenses(docs: DataFrame, model: Model | None = None, sample: int = 100, seed: int = 7, close: float = 0.6) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``n_paragraphs``, ``licenses`` and ``license_paragraphs``.

    Paragraphs are the lines with a letter, digit or non-ASCII character. ``licenses`` lists the families found,
    sorted; ``license_paragraphs`` each notice with its family and probability. Without
    ``model`` one is trained on ``sample`` documents and the templates (all documents
    are scored). A null text counts as empty and has no paragraphs. Repeated rows are
    scanned alike, columns of the three names replaced, and an empty table gives an
    empty table. A text is held by one task.
    """
    if model is None:
        model = train(training_paragraphs(docs, sample, seed))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^14 + 1 rows by families, whatever the input
    new = ("n_paragraphs", "licenses", "license_paragraphs")
    held = docs.select(F.struct(*rest(docs, *new)).alias("row"))
    found = "array<struct<place:int,family:string,probability:double,paragraph:string>>"
    schema = f"row {held.schema['row'].dataType.simpleString()}, n_paragraphs long, license_paragraphs {found}"
    rows = held.mapInArrow(_scan(shared, close), schema)
    families = F.array_sort(F.array_distinct(F.transform("license_paragraphs", lambda x: x["family"])))
    return rows.select("row.*", "n_paragraphs", families.alias("licenses"), "license_paragraphs")


# -- inside tasks ----------------------------------------------------------------------------


def _scan(shared, close):
    kind = pa.list_(pa.struct([("place", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("paragraph", pa.string())]))

    def run(batches):
        model, roll, leads = shared.value, WindowHash(4), anchors(close)
        hint = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(re.escape(w.encode()) for w in sorted(leads)) + rb")(?![0-9a-z\x80-\xff])")
        for batch in batches:
            offsets, data = utf8(batch.column(0).field("text"))
            n, found = [], []
            for lo, hi in chunks(offsets, 1_000_000):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                cuts = np.unique(np.concatenate([at, np.flatnonzero(part == 10) + 1]))
                flat, ends = _features(roll, part, cuts)
                some = np.diff(ends) > 1  # a paragraph without a word has the constant only
                best, sure = _classify(flat, ends, model)
                text = np.searchsorted(at, cuts[:-1], "right") - 1
                first = np.searchsorted(cuts, at[:-1])
                n.extend(np.bincount(text[some], minlength=hi - lo).tolist())
                notices = [[] for _ in range(hi - lo)]
                for i in np.flatnonzero(some & (best < len(model.families) - 1) & (sure >= model.least)).tolist():
                    paragraph, family = part[cuts[i] : cuts[i + 1]].tobytes().decode().rstrip("\n"), model.families[best[i]]
                    if confirmed(_words(paragraph), family, close):
                        place = int(i - first[text[i]])
                        notices[text[i]].append({"place": place, "family": family, "probability": float(sure[i]), "paragraph": paragraph})
                for t in range(hi - lo):
                    raw = part[at[t] : at[t + 1]].tobytes()
                    if hint.search(raw.lower()):
                        _add_joined(notices[t], raw.decode().split("\n"), model, leads, close)
                found.extend(notices)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, kind)], ["row", "n_paragraphs", "license_paragraphs"])

    return run


def _add_joined(notices, lines, model, leads, close):
    """Add notices across lines; one that a longer one of its family covers goes."""
    for a, b, family, sure in joined_notices(lines, model, leads, close):
        same = [x for x in notices if x["family"] == family and a <= x["place"] <= b]
        if a == b and same:
            continue
        for x in same:
            notices.remove(x)
        notices.append({"place": a, "family": family, "probability": sure, "paragraph": "\n".join(lines[a : b + 1])})
    notices.sort(key=lambda x: (x["place"], x["family"]))
