"""License scan: TF-IDF cosine with license templates, then inheritance by directory.

A text is a stream of tokens. Wherever it has a token that a template cannot do without,
the window of the template's length that puts the token in the template's place is
compared with the template by the cosine of their TF-IDF vectors. A file without
a license of its own takes that of the licence file in the nearest directory above it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Notices by SPDX name, as projects put them into headers and licence files,
# with titles and openings of licence texts. Of equal cosines the first one wins, so a clause
# that only one of two texts has comes before the opening that both have.
_NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-2.0", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
TEMPLATES = _NOTICES + tuple((name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in _NOTICES}))
LICENCE_FILE = r"(?i)^(?:licen[cs]e|copying|notice|unlicense)(?:[-._].*)?$"

THRESHOLD = 0.85
_TOKEN = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


@dataclass
class Matcher:
    """Templates weighted by how rare their tokens are in the documents."""

    frequency: dict[str, int]
    documents: int
    threshold: float = THRESHOLD
    _templates: list[tuple] = field(default_factory=list)
    _anchors: dict[str, list[tuple[int, int]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name, text in TEMPLATES:
            found = tokens(text)
            vector = self._vector(found)
            self._templates.append((name, vector, len(found)))
            for token in self._needed(vector):
                places = [i for i, t in enumerate(found) if t == token]
                self._anchors.setdefault(token, []).extend((len(self._templates) - 1, i) for i in places)

    def _weight(self, token: str) -> float:
        """Smoothed IDF. A token that no template has counts as one that no document has."""
        return float(np.log((1 + self.documents) / (1 + self.frequency.get(token, 0))) + 1)

    def _vector(self, found: list[str]) -> dict[str, float]:
        raw = {t: n * self._weight(t) for t, n in Counter(found).items()}
        norm = sum(w * w for w in raw.values()) ** 0.5
        return {t: w / norm for t, w in raw.items()}

    def _needed(self, vector: dict[str, float]) -> list[str]:
        """The heaviest tokens such that a text with none of them stays below the threshold."""
        ordered = sorted(vector, key=lambda t: (-vector[t], t))
        rest, needed = 1.0, []
        for token in ordered:
            if rest < self.threshold**2:
                break
            needed.append(token)
            rest -= vector[token] ** 2
        return needed

    def best(self, text: str | None) -> tuple[str | None, float | None]:
        """The license whose template some window resembles most, and the cosine; else nulls.

        Of equal cosines the first template wins.
        """
        lower = (text or "").lower()
        if not any(a in lower for a in self._anchors):
            return None, None
        found = _TOKEN.findall(lower)
        spots = {(k, i - at) for i, t in enumerate(found) for k, at in self._anchors.get(t, ())}
        top, winner = 0.0, None
        for k, start in sorted(spots):
            name, vector, length = self._templates[k]
            window = self._vector(found[max(0, start) : max(0, start + length)])
            cosine = sum(w * vector.get(t, 0.0) for t, w in window.items())
            if cosine > top + 1e-12:
                top, winner = cosine, name
        return (winner, round(top, 6)) if top >= self.threshold else (None, None)


def fit(files: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> Matcher:
    """Counts in how many of all texts each token of the templates is."""
    vocabulary = frozenset(t for _, template in TEMPLATES for t in tokens(template))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, rows = Counter(), 0
        for batch in batches:
            rows += len(batch)
            for value in batch["text"]:
                seen.update(vocabulary.intersection(_TOKEN.findall((value or "").lower())))
        yield pd.DataFrame({"token": ["", *seen], "n": [rows, *seen.values()]})

    partial = files.select(F.col(text).alias("text")).mapInPandas(counts, "token string, n bigint")
    total = {r.token: r.n for r in partial.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    rows = total.pop("", 0)
    return Matcher(total, rows, threshold)


def _folder(path: Column) -> Column:
    """Everything before the last slash; the top folder is the empty text."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(row, license, similarity, effective_license, inherited_from) per file.

    license and similarity are the file's own, or null. A file without one takes the
    license of the nearest folder, its own included, that has a licence file (by name)
    with a recognised license; of several in one folder the most similar counts, then the
    one with the first name in order. inherited_from is that folder (the top one is an empty text),
    null where nothing is inherited. Null paths inherit nothing, null and empty texts
    have no license, repeated rows are scanned each on its own, texts are read whole.
    """
    matcher = fit(files, text, threshold)

    def own(batches: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([matcher.best(t) for t in batches], columns=["license", "similarity"], dtype=object)

    found = F.pandas_udf(own, "license string, similarity double").asNondeterministic()  # so that it runs once
    scanned = files.select(F.struct("*").alias("row"), F.col(path).alias("path"), found(F.col(text)).alias("own"))
    scanned = scanned.select("row", "path", "own.license", "own.similarity", _folder(F.col("path")).alias("folder"))

    names = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    named = names.filter(F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENCE_FILE))
    stated = named.select(_folder(F.col("path")).alias("above"), "path", found("text").alias("own"))
    rank = F.struct((-F.col("own.similarity")).alias("order"), "path", F.col("own.license").alias("license"))
    licensed = stated.filter("own.license is not null").groupBy("above").agg(F.min(rank)["license"].alias("given"))

    folders = names.filter("path is not null").select(_folder(F.col("path")).alias("folder")).distinct()
    steps = F.split("folder", "/")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")
    )
    above = folders.select("folder", F.posexplode(F.array_distinct(prefixes)).alias("depth", "above"))
    nearest = above.join(licensed, "above").groupBy("folder", F.length("folder").alias("width"))
    resolved = nearest.agg(F.max(F.struct("depth", "above", "given")).alias("near")).drop("width")
    lacks = F.col("license").isNull()
    return scanned.join(resolved, "folder", "left").select(
        "row",
        "license",
        "similarity",
        F.coalesce("license", "near.given").alias("effective_license"),
        F.when(lacks, F.col("near.above")).alias("inherited_from"),
    )
