"""Licence notices in texts.

Method: shingles of three words are hashed; every text is cut into overlapping windows of eight
shingles, one starting at every fourth. For each of ``bands`` permutations of the hashes (exclusive
or with a constant) the smallest value of the window is its MinHash; a band is one of them. Notices
are cut into windows at every shingle, so a text window inside a notice has all bands in common with
one of its windows. A notice of m < 8 shingles shares a band with probability 1 - (1 - m/8)^bands in
each text window around it: 0.9964 for m = 3 and 12 bands. A window that shares a band retrieves
the notice; then the share of the notice's shingles that stand in the text around the window is
counted exactly, and ``containment`` or more of them is a match.

A notice with changed words matches as well, if ``changed`` or more of its shingles are left (each
changed word costs three), among them all with a number in them, which tell versions apart, and one
that no notice of another licence has. Short notices are listed without the words that lead to
them ("this program is licensed under"), so those may be any.

Defined results: words are runs of letters and digits, in lower case; a text of fewer than three words
(or NULL) has no shingles and no matches; notices of fewer than three words are not searched; of
matches of one notice in a document the first with the highest containment is given; repeated
documents are one result per id and text; an empty table gives an empty result. Other columns are
ignored.

At scale: one pass over the texts; notices are a short list (``max_shingles`` in all is checked), so
their bands are constants of the query and a window without a shared band costs no exchange. Only
matches are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import let

BANDS = 12
WINDOW, STRIDE = 8, 4
CONTAINMENT = 0.95
CHANGED = 0.6
MAX_SHINGLES = 5000

# Customary notices of licences, as projects print them.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "licensed under CC0 1.0"),
    ("CC-BY-4.0", "licensed under CC BY 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0"),
    ("CC-BY-SA-4.0", "licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    ("CC-BY-NC-4.0", "licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    ("CC-BY-ND-4.0", "licensed under CC BY-ND 4.0"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0"),
    ("CC-BY-NC-SA-4.0", "licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"),
    ("CC-BY-NC-ND-4.0", "licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"),
    ("Apache-2.0", "under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License 2.0"),
    ("MIT", "under the MIT License"),
    ("GPL-2.0", "under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-3-Clause", "under the BSD 3-Clause License"),
    ("BSD-2-Clause", "under the BSD 2-Clause License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_WORDS = r"split(trim(BOTH ' ' FROM regexp_replace(lower(coalesce(text, '')), r'[^\p{L}\p{N}]+', ' ')), ' ')"
_SHINGLES = let(
    "ws", _WORDS, "if(size(ws) < 3, cast(array() as array<bigint>), transform(sequence(0, size(ws) - 3), i -> xxhash64(ws[i], ws[i + 1], ws[i + 2])))"
)

# Shingles with a word that begins with a digit.
_NUMBERED = let(
    "ws",
    _WORDS,
    "if(size(ws) < 3, cast(array() as array<bigint>), transform(filter(sequence(0, size(ws) - 3), i -> exists(slice(ws, i + 1, 3), w -> w rlike '^[0-9]')),"
    " i -> xxhash64(ws[i], ws[i + 1], ws[i + 2])))",
)


def _permutations(bands: int) -> list[int]:
    """Constants of the permutations: multiples of the golden ratio, as signed 64-bit numbers."""
    values = [(n * 0x9E3779B97F4A7C15) % (1 << 64) for n in range(1, bands + 1)]
    return [value - (1 << 64) if value >= 1 << 63 else value for value in values]


def notice_windows(notices: DataFrame, bands: int = BANDS, max_shingles: int = MAX_SHINGLES):
    """Notices as (number, license_id, shingles), and per band the MinHash values of their windows."""
    named = notices.selectExpr("license_id", "text").filter("text is not null").distinct().orderBy("license_id", "text")
    shingled = named.selectExpr("license_id", f"{_SHINGLES} as hs", f"{_NUMBERED} as numbered")
    found = [row for row in shingled.limit(max_shingles + 1).collect() if row.hs]
    if sum(len(row.hs) for row in found) > max_shingles:
        raise ValueError(f"notices have more than {max_shingles} shingles; search them in parts")
    values: list[dict[int, set[int]]] = []
    for constant in _permutations(bands):
        of: dict[int, set[int]] = {}
        for number, row in enumerate(found):
            for start in range(max(1, len(row.hs) - WINDOW + 1)):
                of.setdefault(min(h ^ constant for h in row.hs[start : start + WINDOW]), set()).add(number)
        values.append(of)
    return found, values


def _long(value: int) -> str:
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"


def license_matches(
    docs: DataFrame,
    notices: DataFrame,
    bands: int = BANDS,
    containment: float = CONTAINMENT,
    changed: float = CHANGED,
    max_shingles: int = MAX_SHINGLES,
) -> DataFrame:
    """One row per document and licence: best containment, and the word at which that notice starts."""
    found, values = notice_windows(notices, bands, max_shingles)
    constants = _permutations(bands)
    if not found:
        return docs.selectExpr("doc_id", "cast(null as string) as license_id", "0D as containment", "0 as first_word").filter("false")
    listed = [f"{_least('v', constant)} in ({', '.join(map(_long, sorted(of)))})" for constant, of in zip(constants, values)]
    # Start of every window that shares a band, then the notices that its bands retrieve.
    starts = f"filter(sequence(0, greatest(0, size(hs) - 1), {STRIDE}), i -> {let('v', f'slice(hs, i + 1, {WINDOW})', ' or '.join(listed))})"
    reach = max(len(row.hs) for row in found)
    around = f"struct(i, slice(hs, i + 1, {WINDOW}) as v, greatest(0, i - {reach}) as low, slice(hs, greatest(0, i - {reach}) + 1, i - greatest(0, i - {reach}) + {reach + WINDOW}) as near)"
    windows = let("hs", _SHINGLES, f"if(size(hs) = 0, null, transform({starts}, i -> {around}))")
    hits = docs.selectExpr("doc_id", "xxhash64(text) as row_hash", f"inline({windows})")
    minima = ", ".join(f"struct({band} as band, {_least('v', constant)} as value)" for band, constant in enumerate(constants))
    keyed = hits.selectExpr("doc_id", "row_hash", "low", "near", f"inline(array({minima}))")
    spark = docs.sparkSession
    rows = [(band, value, number) for band, of in enumerate(values) for value, numbers in of.items() for number in sorted(numbers)]
    index = spark.createDataFrame(rows, "band int, value bigint, number int")
    licences: dict[int, set[str]] = {}
    for row in found:
        for h in row.hs:
            licences.setdefault(h, set()).add(row.license_id)
    listed = [(n, row.license_id, row.hs, row.numbered, [h for h in row.hs if len(licences[h]) == 1]) for n, row in enumerate(found)]
    texts = spark.createDataFrame(listed, "number int, license_id string, hs array<bigint>, numbered array<bigint>, own array<bigint>")
    # Both lists are bounded by ``max_shingles``.
    pairs = keyed.join(F.broadcast(index), ["band", "value"]).select("doc_id", "row_hash", "low", "near", "number")
    pairs = pairs.join(F.broadcast(texts), "number")
    share = "size(array_intersect(near, hs)) / double(size(array_distinct(hs)))"
    first = "low + array_min(transform(array_intersect(near, hs), h -> int(array_position(near, h)))) - 1"
    told = "size(array_except(numbered, near)) = 0 and arrays_overlap(own, near)"
    matched = pairs.selectExpr("doc_id", "row_hash", "license_id", f"{share} as containment", f"int({first}) as first_word", f"{told} as told")
    kept = matched.filter(f"containment >= {containment}D or (containment >= {changed}D and told)")
    best = kept.groupBy("doc_id", "row_hash", "license_id").agg(F.expr("max(struct(containment, -first_word as back)) as best"))
    return best.selectExpr("doc_id", "license_id", "best.containment", "-best.back as first_word")


def _least(values: str, constant: int) -> str:
    return f"array_min(transform({values}, h -> h ^ {_long(constant)}))"


def known_notices(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(NOTICES, "license_id string, text string")
