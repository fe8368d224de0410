"""Licence scans by a trained paragraph classifier. DataFrame functions on the scan.

Paragraphs end at blank lines; line breaks within them count as blanks, so wrapped
notices hang together. A paragraph over `SPAN` words is read in windows of that many,
each half over the one before it, so that a notice inside long prose is not lost in
it. Every window is scored; neither a word list nor a cheaper test decides what is looked
at. A sparse multinomial logistic regression over hashed word 1- and 2-grams names the family.
It sums weights without regard to length, so prose around a notice, whose weights are near
zero, does not dilute it. It is trained here, in numpy on the driver, by proximal gradient steps
that keep the weights sparse and end once they settle, on pieces of notices of the families among
prose; the unknown class is prose, talk of licences that names none, and notices of licences that
are not listed. fitted() trains; saved() and loaded() keep a model, so that it is trained once.
Other pieces and other talk, none of them seen in training, fit the softmax temperature. The
acceptance threshold rests on unlisted licences that were not trained on, and on them alone:
prose and talk, which are easy, have no say in it. The promise is for such licences, and for
the classifier by itself: a form (whole or worn, among prose) of one that was never seen is
accepted by a chance of `FALSE_ACCEPTANCE` at most, over draws of licences like these. A family is accepted above the threshold, and confirmed if the window shares at least `CONFIRM` of the 2-grams of a piece of
one of its notices, by weight: 2-grams that several families use weigh less. Only confirmed
ones count as found.

The scan neither shuffles nor joins: weights and notices travel as literals whose
sizes are fixed by BUCKETS and NOTICES. Null and empty texts have no paragraphs. Very long
texts take time in proportion to their words. Repeated rows agree, an empty table gives an
empty one; ties go to the family first in alphabetical order. Columns beyond `keep` are not
looked at; kept ones must not be named like the results.
"""

from __future__ import annotations

import functools
import json
import re
from dataclasses import asdict, dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound

BUCKETS, SEED = 2048, 42
SPAN = 64
UNKNOWN = "unknown"
#: Notices of the families, as their licences word them; "|" parts pieces that stand alone.
NOTICES = {
    "agpl": "this work is licensed under the gnu affero general public license version 3|licensed under the agpl|you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation|you should have received a copy of the gnu affero general public license along with this program|spdx license identifier agpl 3 0",
    "apache": "licensed under the apache license version 2 0|you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0|unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind|apache license version 2 0 january 2004|spdx license identifier apache 2 0",
    "bsd": "released under the bsd license|licensed under the bsd 3 clause license|redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met|redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer|redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution|neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission|spdx license identifier bsd 3 clause",
    "cc_by": "licensed under cc by 4 0|this work is licensed under a creative commons attribution 4 0 international license|creativecommons org licenses by 4 0",
    "cc_by_nc": "licensed under cc by nc 4 0|this work is licensed under a creative commons attribution noncommercial 4 0 international license|creativecommons org licenses by nc 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0|this work is licensed under a creative commons attribution sharealike 4 0 international license|creativecommons org licenses by sa 4 0",
    "gpl": "this work is licensed under the gnu general public license version 3|licensed under the gnu general public license version 2|you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version|you should have received a copy of the gnu general public license along with this program|spdx license identifier gpl 3 0",
    "lgpl": "this library is licensed under the gnu lesser general public license version 3|licensed under the lgpl|you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation|you should have received a copy of the gnu lesser general public license along with this library|spdx license identifier lgpl 2 1",
    "mit": "released under the mit license|licensed under the mit license|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction|including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software|the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software|spdx license identifier mit",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0|licensed under the mozilla public license version 2 0|if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0|spdx license identifier mpl 2 0",
    "proprietary": "all rights reserved|copyright all rights reserved|no part of this publication may be reproduced without permission all rights reserved|confidential and proprietary unauthorized copying of this file via any medium is strictly prohibited",
    "public_domain": "this work is in the public domain|dedicated to the public domain under cc0 1 0 universal|released into the public domain|this is free and unencumbered software released into the public domain|to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
}
#: Notices of licences that are not listed. Odd ones train, even ones calibrate.
UNLISTED = [
    "the artistic license 2 0", "eclipse public license v 2 0",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software",
    "licensed under the european union public licence version 1 2", "boost software license version 1 0",
    "this font software is licensed under the sil open font license version 1 1", "common development and distribution license version 1 1",
    "do what the fuck you want to public license version 2", "microsoft public license ms pl",
    "granted under the python software foundation license version 2", "the postgresql license is a liberal open source license",
    "this is licensed under the ruby license", "gnu free documentation license version 1 3 or any later version",
    "licensed under the server side public license version 1", "this program is made available under the ibm public license version 1 0",
    "licensed under the elastic license 2 0 you may not provide the software to third parties as a hosted service", "use of this software is governed by the business source license included in the license file",
    "licensed under the watcom open source license version 1 0", "licensed under the open software license version 3 0",
    "this file is covered by the common public license version 1 0", "the contents of this file are subject to the netscape public license version 1 1",
    "the contents of this file are subject to the sun public license version 1 0", "licensed under the zope public license version 2 1",
    "this software is released under the php license version 3 01", "released under the w3c software notice and license",
    "licensed under the apple public source license version 2 0", "redistribution is allowed under the terms of the xfree86 license",
    "licensed under the cecill free software license agreement version 2 1", "licensed under the mulan permissive software license version 2",
    "licensed under the ecos license version 2 0", "released under the university of illinois ncsa open source license",
    "distributed under the terms of the qt public license version 1 0", "made available under the norwegian licence for open government data",
    "any rights in individual contents of the database are licensed under the database contents license", "licensed under the open government licence version 3 0",
    "this data is published under the data licence germany attribution version 2 0", "licensed under the etalab open licence version 2 0",
    "licensed under the community data license agreement permissive version 2 0", "this model is licensed under the responsible artificial intelligence license",
    "use of the model is subject to the community license agreement and the acceptable use policy", "the latex project public license either version 1 3 of this license or any later version",
    "licensed under the vim license", "licensed under the x11 license of the consortium",
    "licensed under the beerware license revision 42 if we meet some day you can buy me a beer in return", "this code is licensed under the code project open license",
    "licensed under the microsoft reciprocal license", "licensed under the reciprocal public license version 1 5",
    "licensed under the common public attribution license version 1 0", "licensed under the open cascade technology public license",
    "the intel open source license applies to this file", "licensed under the nokia open source license version 1 0",
    "licensed under the nasa open source agreement version 1 3", "licensed under the lucent public license version 1 02",
    "licensed under the ricoh source code public license", "licensed under the historical permission notice and disclaimer",
    "licensed under the isc license", "licensed under the multics license",
    "licensed under the blue oak model license 1 0 0", "licensed under the polyform noncommercial license 1 0 0",
    "licensed under the commons clause license condition version 1 0", "licensed under the functional source license version 1 1",
    "licensed under the confluent community license version 1 0", "this source is available under the timescale license agreement",
    "licensed under the redis source available license 2 0", "licensed under the parity public license 7 0 0",
    "licensed under the fair license", "usage of the works is permitted provided that this instrument is retained with the works so that any entity that uses the works is notified of this instrument",
    "licensed under the cern open hardware licence version 2 strongly reciprocal", "licensed under the solderpad hardware licence version 2 1",
    "licensed under the tapr open hardware license", "licensed under the against drm license version 2 0",
    "licensed under the free art license 1 3", "licensed under the design science license",
    "licensed under the open publication license version 1 0", "licensed under the open audio license",
    "changed versions must carry another name and must say who changed them and when", "this notice may not be removed or altered from any source distribution",
    "you may use this software only for evaluation and must delete all copies after thirty days", "free for personal and academic use commercial users must obtain a paid license from the vendor",
    "this material may be quoted freely as long as the author is named", "the software is licensed not sold and the licensor reserves every other right",
    "licensor grants you a non exclusive worldwide royalty free licence to use reproduce and adapt the work", "each contributor hereby grants recipient a non exclusive worldwide royalty free copyright license to reproduce prepare derivative works of and distribute the contribution",
    "any derivative work must be distributed under the same conditions and the source must be offered to every recipient", "this package may be distributed under the same terms as perl itself",
    "the user may install the program on a single computer and make one backup copy", "this dataset may be used for research only and must not be given to third parties",
    "the end user licence agreement forbids reverse engineering decompiling and disassembling", "this documentation may be copied in whole or in part provided that the source is acknowledged",
    "licensed under the unicode license agreement for data files and software", "licensed under the icu license",
    "licensed under the openssl license and the original ssleay license", "licensed under the info zip license",
    "licensed under the freetype project license", "licensed under the independent jpeg group license",
    "licensed under the bitstream vera fonts copyright", "licensed under the ubuntu font licence version 1 0",
    "licensed under the eiffel forum license version 2", "licensed under the cnri python license",
    "licensed under the jython license", "licensed under the motosoto open source license",
    "licensed under the naumen public license", "licensed under the frameworx open license 1 0",
    "licensed under the entessa public license", "licensed under the attribution assurance license",
    "licensed under the adaptive public license 1 0", "licensed under the upstream compatibility license version 1 0",
    "licensed under the universal permissive license version 1 0", "licensed under the non profit open software license 3 0",
]
#: Talk that names no licence. Odd ones train; even ones fit the temperature.
TALK = [
    "see the license file for details", "please read the licence agreement before use",
    "the driver lost his license last year", "a fishing licence costs ten euros",
    "licensed professionals only", "license plate numbers are hidden",
    "copyright belongs to the authors", "a copy of the license is included",
    "the company licensed its technology to others", "the copyright office was closed on monday",
    "they redistributed the land among farmers", "creative commons is an organisation",
    "all rights of the buyer are listed below", "the public domain was discussed at the conference",
]
#: The share of unlisted licences that the classifier accepts at most: the threshold is the rank that
#: conformal calibration asks for over the calibrating ones, which must be 49 at least for 0.02.
CONFIRM, FALSE_ACCEPTANCE, PENALTY = 0.6, 0.02, 3e-4
SETTLED = 1e-3


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def pairs_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def grams_of(words: list[str]) -> list[str]:
    return words + pairs_of(words)


def hashed(gram: str) -> int:
    h = xxhash.xxh64_intdigest(gram.encode(), SEED)
    return h - (1 << 64) if h >= 1 << 63 else h


@functools.lru_cache(1 << 16)
def bucket(gram: str) -> int:
    return hashed(gram) % BUCKETS


def vector(words: list[str]) -> np.ndarray:
    """Which buckets the grams fall into."""
    out = np.zeros(BUCKETS)
    out[[bucket(g) for g in grams_of(words)]] = 1.0
    return out


def word_vector(words: list[str]) -> np.ndarray:
    """How many words fall into each bucket."""
    return np.bincount([bucket(w) for w in words], minlength=BUCKETS).astype(float) if words else np.zeros(BUCKETS)


@dataclass
class Model:
    families: list[str]
    weights: np.ndarray  # BUCKETS x families
    bias: np.ndarray
    temperature: float
    threshold: float
    least = 0.0

    @property
    def gate(self) -> np.ndarray:
        """Weights of single words whose sum must reach `least` for a window to be scored: none, so all are."""
        return np.zeros(BUCKETS)

    def probabilities(self, words: list[str]) -> np.ndarray:
        z = (vector(words) @ self.weights + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def units_of(text: str) -> list[tuple[int, list[str]]]:
    """(paragraph, words) of each window, as the scan reads them."""
    out = []
    for i, p in enumerate(re.split(r"\n[\t\r ]*\n", text)):
        w = words_of(p)
        out += [(i, w[k * SPAN // 2 : k * SPAN // 2 + SPAN]) for k in range(max(1, -(-len(w) * 2 // SPAN) - 1))] if w else []
    return out


def among(rng: np.random.Generator, prose: list[list[str]], words: list[str]) -> list[str]:
    """The words with prose before and behind them, up to `SPAN` words."""
    text = prose[int(rng.integers(len(prose)))] if prose else []
    n = max(0, SPAN - len(words))
    a, b = int(rng.integers(0, n + 1)) * int(rng.integers(0, 2)), int(rng.integers(0, n + 1)) * int(rng.integers(0, 2))
    return [*text[:a], *words, *text[max(len(text) - b, 0) :]][:SPAN]


def worn(rng: np.random.Generator, words: list[str]) -> list[str]:
    """The words cut at both ends, or with some of them lost."""
    if len(words) > 12 and rng.random() < 0.5:
        a = int(rng.integers(0, len(words) // 3))
        return words[a : a + max(8, int(len(words) * 0.7))]
    return [w for w in words if rng.random() > 0.08] or words


def forms_of(rng: np.random.Generator, rounds: int, prose: list[list[str]], notice: str) -> list[list[str]]:
    """The notice, whole and worn, among prose, `rounds` times each."""
    words = notice.split()
    return [form for _ in range(rounds) for form in (among(rng, prose, words), among(rng, prose, worn(rng, words)))]


def examples(rng: np.random.Generator, rounds: int, prose: list[list[str]], others: list[str]) -> list[tuple[list[str], str]]:
    """Forms of pieces of the families' notices and of others, and prose by itself, with their classes."""
    known = [(piece, family) for family, notice in NOTICES.items() for piece in notice.split("|")]
    out = [(form, c) for notice, c in [*known, *((t, UNKNOWN) for t in others)] for form in forms_of(rng, rounds, prose, notice)]
    return out + [(p[: int(rng.integers(3, SPAN))], UNKNOWN) for p in prose]


def descended(x: np.ndarray, y: np.ndarray, k: int, steps: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of a multinomial logistic regression, by accelerated proximal
    gradient steps that end once no weight moves by `SETTLED`; classes weigh alike and the L1
    penalty keeps weights at zero."""
    width = x.shape[1]
    w, b = np.zeros((width, k)), np.zeros(k)
    per = (1 / (k * np.maximum(np.bincount(y, minlength=k), 1)))[y]
    rate = 4.0 / max(1.0, float((x**2).sum(1).max()) / 8)
    ahead, ahead_b, t = w, b, 1.0
    used = np.flatnonzero(x.any(0))
    x, w, ahead = x[:, used].astype(np.float32), w[used], w[used]
    for _ in range(steps):
        z = x @ ahead.astype(np.float32) + ahead_b
        e = np.exp(z - z.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= per[:, None]
        new = ahead - rate * (x.T @ p.astype(np.float32))
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = ahead_b - rate * p.sum(0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, ahead_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        moved = max(float(np.abs(new - w).max(initial=0)), float(np.abs(new_b - b).max()))
        w, b, t = new, new_b, t_new
        if moved < SETTLED:
            break
    whole = np.zeros((width, k))
    whole[used] = w
    return np.round(whole, 4), np.round(b, 4)


def fitted(prose: list[str], seed: int = 4, rounds: int = 8, steps: int = 300) -> Model:
    """Train on some examples and calibrate on others, of licences and talk not trained on."""
    rng = np.random.default_rng(seed)
    texts = [w for p in prose for _, w in units_of(p)]
    families = [*sorted(NOTICES), UNKNOWN]
    place = {f: i for i, f in enumerate(families)}
    train = examples(rng, rounds, texts[::2], UNLISTED[::2] + TALK[::2])
    held = examples(rng, rounds, texts[1::2], TALK[1::2])

    def arrays(some: list) -> tuple[np.ndarray, np.ndarray]:
        return np.stack([vector(w) for w, _ in some]), np.array([place[f] for _, f in some])

    x, y = arrays(train)
    w, b = descended(x, y, len(families), steps, PENALTY)
    cx, cy = arrays(held)
    z = cx @ w + b

    def soft(z: np.ndarray, t: float) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    t = float(min(np.geomspace(0.2, 10, 40), key=lambda t: -np.log(np.maximum(soft(z, t)[np.arange(len(cy)), cy], 1e-12)).mean()))
    # one form of each calibrating licence, drawn at random: the scores are exchangeable with a new licence's
    forms = [some[int(rng.integers(len(some)))] for some in (forms_of(rng, 1, texts[1::2], licence) for licence in UNLISTED[1::2])]
    scores = np.sort(soft(np.stack([vector(f) for f in forms]) @ w + b, t)[:, :-1].max(1))
    rank = int(np.ceil((1 - FALSE_ACCEPTANCE) * (len(scores) + 1)))
    threshold = max(0.5, float(scores[rank - 1])) if rank <= len(scores) else 1.0
    return Model(families, w, b, t, threshold)


def saved(model: Model) -> str:
    """The model as JSON, to be kept wherever a text can be."""
    return json.dumps(asdict(model), default=lambda a: a.tolist())


def loaded(kept: str) -> Model:
    """The model that saved() wrote."""
    fields = json.loads(kept)
    return Model(**fields | {n: np.array(fields[n]) for n in ("weights", "bias")})


def weighted_pieces() -> dict[str, list[dict[str, float]]]:
    """By family, the 2-grams of each piece of its notice with their weights, which add up to 1:
    a 2-gram that n families use weighs 1 / n of one that tells the family."""
    used: dict[str, set[str]] = {}
    for f, notice in NOTICES.items():
        for g in pairs_of(notice.replace("|", " | ").split()):
            used.setdefault(g, set()).add(f)
    out: dict[str, list[dict[str, float]]] = {}
    for f, notice in NOTICES.items():
        for piece in notice.split("|"):
            raw = {g: 1 / len(used[g]) for g in sorted(set(pairs_of(piece.split())))}
            out.setdefault(f, []).append({g: x / sum(raw.values()) for g, x in raw.items()})
    return out


def prose_sample(docs: DataFrame, text: str = "text", rows: int = 200, size: int = 2000) -> list[str]:
    """`size` characters from somewhere in each of at most `rows` documents, those of least
    hash; those that hold a piece of a notice are left out."""
    h = F.xxhash64(text)
    # thinned by a hash and freed of copies before the limit, so that few rows reach the driver
    most = int(min(1.0, 4.0 * rows / max(docs.count(), 1)) * (1 << 30))
    some = docs.where(F.col(text).isNotNull() & (F.pmod(h, F.lit(1 << 30)) <= most))
    begin = (F.pmod(F.xxhash64(F.lit("at"), text), F.greatest(F.length(text) - size, F.lit(1))) + 1).cast("int")
    some = some.select(h.alias("h"), F.substring(F.col(text).cast("string"), begin, F.lit(size)).alias("part")).distinct()
    pieces = [set(pairs_of(p.split())) for n in NOTICES.values() for p in n.split("|")]

    def clean(part: str) -> bool:
        pairs = set(pairs_of(words_of(part)))
        return all(len(p & pairs) < 0.5 * len(p) for p in pieces)

    return [r["part"] for r in some.orderBy("h", "part").limit(rows).collect() if clean(r["part"])]


def literal(values: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def scored(window: Column, model: Model) -> Column:
    """(family, probability, overlap) of a window's words and buckets, by array functions alone; the
    overlap is looked up for accepted families."""
    k = len(model.families)
    weights, bias = literal([*model.weights.tolist(), [0.0] * k], "array<array<double>>"), literal(model.bias.tolist(), "array<double>")
    known = weighted_pieces()
    pieces = [[[{"h": hashed(g), "w": round(x, 6)} for g, x in p.items()] for p in known.get(f, [])] for f in model.families]
    notices = literal(pieces, "array<array<array<struct<h:bigint,w:double>>>>")
    names = F.array(*[F.lit(f) for f in model.families])

    def rated(g: Column) -> Column:
        total = F.aggregate(F.array_distinct(g["ids"]), F.array_repeat(F.lit(0.0), k), lambda s, i: F.zip_with(s, F.get(weights, i), lambda a, b: a + b))
        logits = F.zip_with(total, bias, lambda a, b: (a + b) / model.temperature)
        return bound(logits, lambda z: bound(F.transform(z, lambda v: F.exp(v - F.array_max(z))), lambda e: chosen(e, g["words"])))

    def chosen(e: Column, words: Column) -> Column:
        best = F.array_position(e, F.array_max(e)).cast("int")
        p = F.array_max(e) / F.aggregate(e, F.lit(0.0), lambda s, v: s + v)
        shared = lambda pairs: lambda t: F.aggregate(t, F.lit(0.0), lambda s, x: s + F.when(F.array_contains(pairs, x["h"]), x["w"]).otherwise(0.0))
        overlap = bound(pair_hashes(words), lambda pairs: F.array_max(F.transform(F.get(notices, best - 1), shared(pairs))))

        def named(p: Column) -> Column:
            accepted = (p > model.threshold) & (best < k)  # the last one is the unknown class
            return F.struct(F.when(accepted, F.get(names, best - 1)).otherwise(UNKNOWN).alias("family"), p.alias("probability"), F.when(accepted, overlap).otherwise(0.0).alias("overlap"))

        return bound(p, named)

    return bound(window, rated)


def pair_hashes(words: Column) -> Column:
    """Hashes of the 2-grams of words, one fewer than these."""
    n = F.size(words) - 1
    return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(F.concat_ws(" ", a, b))))


def windows(text: Column, model: Model) -> Column:
    """array of (paragraph, words, ids) of all windows; ids are the buckets of their grams, repeats
    included, and `BUCKETS` for those that weigh nothing."""
    half = SPAN // 2
    place = literal([i if any(w) else BUCKETS for i, w in enumerate((model.weights != 0).tolist())], "array<int>")
    none = F.array().cast("array<struct<paragraph:int,words:array<string>,ids:array<int>>>")
    buckets = lambda hashes: F.transform(hashes, lambda h: F.get(place, F.pmod(h, F.lit(BUCKETS)).cast("int")))

    def paragraph(p: Column, number: Column) -> Column:
        words = F.filter(F.split(p, "[^a-z0-9]+", -1), lambda w: w != "")
        return bound(words, lambda w: F.when(F.size(w) == 0, none).otherwise(read(w, number)))

    def read(w: Column, number: Column) -> Column:
        grams = F.struct(buckets(F.transform(w, lambda x: F.xxhash64(x))).alias("single"), buckets(pair_hashes(w)).alias("double"))

        def cut(g: Column) -> Column:
            of = lambda a, k, n: F.slice(a, k * half + 1, n)
            ks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / half).cast("int") - 2, F.lit(0)))
            return F.transform(ks, lambda k: F.struct(number.alias("paragraph"), of(w, k, SPAN).alias("words"), F.concat(of(g["single"], k, SPAN), of(g["double"], k, SPAN - 1)).alias("ids")))

        return bound(grams, cut)

    return F.flatten(F.transform(F.split(F.lower(text), r"\n[\t\r ]*\n", -1), paragraph))


def scan(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and `paragraphs`: (paragraph number, family, probability, overlap,
    confirmed) of every window of the text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*keep, windows(t, model).alias("windows"))

    def finished(p: Column) -> Column:
        return bound(
            scored(p, model),
            lambda s: F.struct(
                p["paragraph"].alias("number"),
                s["family"].alias("family"),
                s["probability"].alias("probability"),
                s["overlap"].alias("overlap"),
                ((s["family"] != UNKNOWN) & (s["overlap"] >= CONFIRM)).alias("confirmed"),
            ),
        )

    return rows.select(*keep, F.transform("windows", finished).alias("paragraphs"))


def families(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """doc_id, n_paragraphs (windows of the text), n_unknown of them, and the confirmed
    families, sorted and comma-joined. Without a model, one is trained first."""
    found = scan(docs, model or fitted(prose_sample(docs, text)), text)
    confirmed = F.filter("paragraphs", lambda p: p["confirmed"])
    return found.select(
        "doc_id",
        F.size("paragraphs").cast("long").alias("n_paragraphs"),
        F.size(F.filter("paragraphs", lambda p: ~p["confirmed"])).cast("long").alias("n_unknown"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda p: p["family"]))), ",").alias("families"),
    )
