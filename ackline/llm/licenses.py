"""License notices found by MinHash bands over overlapping windows.

Windows have the size of a template and start at every quarter of it. MinHash
bands of a window's word shingles retrieve templates; the window, widened by
half its size on both sides, must then contain at least the wanted share of the
template's shingles exactly. Once a template is retrieved, all its windows in the
document are compared, so its place and share do not depend on which of them
met a band. A window without any template shingle contains
none of them, so windows are laid only around such shingles: nothing is lost.
A template of less than five words is one shingle of its own length, and is
compared to the document's runs of that length.

A complete notice and the best window overlap with a Jaccard similarity of 0.77
at least, a notice of which 0.8 remains with 0.6. With 24 bands of 2 rows the
chance of a common band is 0.99997 and above at 0.6, 0.999 at 0.5.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, prepare, with_once
from ackline.plans.joins import lookup_join

SHINGLE = 5
BANDS, ROWS = 24, 2
CONTAINMENT = 0.8

# Notices by which works name their license. A notice of a family
# (GNU, Creative Commons, BSD) is cut to the words that tell it from its relatives.
_HEADERS: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, without warranties or conditions of any kind, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("MIT", "under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "opensource.org/licenses/MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT-0", "under the MIT No Attribution License"),
    ("ISC", "under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "with or without fee is hereby granted. THE SOFTWARE IS PROVIDED"),
    ("BSD", "under the BSD License"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "under the BSD 2-Clause License"),
    ("BSD-2-Clause", "under the Simplified BSD License"),
    ("BSD-3-Clause", "under the BSD 3-Clause License"),
    ("BSD-3-Clause", "under the New BSD License"),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("Apache-2.0", "under the Apache License 2.0"),
    ("Apache-2.0", "under the Apache 2.0 License"),
    ("Apache-2.0", "under the Apache License, Version 2.0"),
    ("Apache-2.0", "www.apache.org/licenses/LICENSE-2.0"),
    ("MPL-2.0", "under the Mozilla Public License 2.0"),
    ("MPL-2.0", "under the Mozilla Public License, Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("EPL-1.0", "under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License v2.0"),
    ("EPL-2.0", "under the terms of the Eclipse Public License v. 2.0"),
    ("CDDL-1.0", "subject to the terms of the Common Development and Distribution License"),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2"),
    ("EUPL-1.2", "European Union Public Licence v. 1.2"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "under the zlib License"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Artistic-2.0", "under the Artistic License 2.0"),
    ("Perl", "under the same terms as Perl itself"),
    ("PSF-2.0", "under the Python Software Foundation License"),
    ("PostgreSQL", "under the PostgreSQL License"),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
    ("Unlicense", "under the Unlicense"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("OFL-1.1", "licensed under the SIL Open Font License, Version 1.1"),
    ("ODbL-1.0", "under the Open Database License"),
    ("ODbL-1.0", "opendatacommons.org/licenses/odbl/1.0"),
    ("ODC-By-1.0", "under the Open Data Commons Attribution License"),
    ("GFDL-1.1", "GNU Free Documentation License, Version 1.1"),
    ("GFDL-1.2", "GNU Free Documentation License, Version 1.2"),
    ("GFDL-1.3", "GNU Free Documentation License, Version 1.3"),
    ("OGL-UK-3.0", "under the Open Government Licence v3.0"),
    ("Public-Domain", "released into the public domain"),
    ("Public-Domain", "dedicated to the public domain"),
    ("Public-Domain", "This work is in the public domain."),
    ("CC0-1.0", "under CC0 1.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "under the CC0 License"),
    ("CC0-1.0", "Creative Commons Zero v1.0 Universal"),
    ("CC0-1.0", "creativecommons.org/publicdomain/zero/1.0"),
    ("CC-PDM-1.0", "creativecommons.org/publicdomain/mark/1.0"),
    ("All-Rights-Reserved", "All rights reserved."),
    ("All-Rights-Reserved", "All right reserved."),
    ("All-Rights-Reserved", "Alle Rechte vorbehalten."),
    ("All-Rights-Reserved", "Tous droits réservés."),
    ("All-Rights-Reserved", "Todos los derechos reservados."),
    ("All-Rights-Reserved", "Tutti i diritti riservati."),
    ("All-Rights-Reserved", "Todos os direitos reservados."),
    ("All-Rights-Reserved", "Alle rechten voorbehouden."),
    ("Some-Rights-Reserved", "Some rights reserved."),
    ("No-Rights-Reserved", "No rights reserved."),
)

# GNU licenses by name, identifier and versions.
_GNU = (
    ("General Public License", "GPL", ("1", "2", "3")),
    ("Lesser General Public License", "LGPL", ("2.1", "3")),
    ("Library General Public License", "LGPL", ("2",)),
    ("Affero General Public License", "AGPL", ("3",)),
)
# Creative Commons licenses by identifier and name.
_CC = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# Other SPDX identifiers.
_SPDX = (
    "0BSD AFL-3.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0"
    " BUSL-1.1 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2"
    " GFDL-1.1 GFDL-1.2 GFDL-1.3 ISC LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0"
    " PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()


def _families() -> list[tuple[str, str]]:
    """The notices that follow a pattern."""
    made = []
    for name, short, versions in _GNU:
        for version in versions:
            whole = version if "." in version else f"{version}.0"
            license = f"{short}-{whole}"
            brief = whole if license == "LGPL-2.0" else version
            published = f"the terms of the GNU {name} as published by the Free Software Foundation"
            if license != "GPL-3.0":  # its whole notice is above
                made.append((license, f"{published}, either version {version} of the License"))
            made += [
                (license, f"{published}; version {version} of the License"),
                (license, f"terms of the GNU {name} version {version} as published"),
                (license, f"under the terms of version {version} of the GNU {name}"),
                (license, f"GNU {name}, version {version}"),
                (license, f"GNU {name} v{version}"),
                (license, f"GNU {short} version {brief}"),
                (license, f"GNU {short} v{brief}"),
                (license, f"under the {short} v{brief}"),
                (license, f"under the {short}v{brief}"),
                (license, f"gnu.org/licenses/{short}-{whole}"),
                (license, f"gnu.org/licenses/old-licenses/{short}-{whole}"),
                (license, f"SPDX-License-Identifier: {license}"),
            ]
    for short, name in _CC:
        for version in _CC_VERSIONS:
            license = f"CC-{short}-{version}"
            made += [
                (license, f"under CC {short} {version}"),
                (license, f"under a CC {short} {version} license"),
                (license, f"under the CC {short} {version} license"),
                (license, f"Creative Commons {name} {version}"),
                (license, f"creativecommons.org/licenses/{short}/{version}"),
                (license, f"License-Identifier: {license}"),
            ]
    return made + [(name, f"SPDX-License-Identifier: {name}") for name in _SPDX]


TEMPLATES: tuple[tuple[str, str], ...] = tuple(dict.fromkeys([*_HEADERS, *_families()]))


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased."""
    ascii_lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(ascii_lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def shingle_hashes(parts: str, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words of the array column ``parts``, in order."""
    n = F.size(parts) - size + 1
    at = lambda i, k: F.get(F.col(parts), i + k)
    return F.when(
        n > 0,
        F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.xxhash64(*[at(i, k) for k in range(size)])),
    ).otherwise(F.array().cast("array<long>"))


def _rehashed(hashes: Column, seed: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed)))


def band_keys(hashes: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """One hash per band of the MinHash signature of ``hashes``."""
    lows = [F.array_min(_rehashed(hashes, k)) for k in range(bands * rows)]
    return F.array(*[F.xxhash64(F.lit(b), *lows[b * rows : (b + 1) * rows]) for b in range(bands)])


def template_table(spark, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``(template, license, wanted, n, size, keys)``; ``size`` words make a shingle, fewer than ``SHINGLE`` in short templates."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    raw = spark.createDataFrame(rows, "template int, license string, text string").coalesce(1)
    cut = raw.select("template", "license", words(F.col("text")).alias("parts")).filter(F.size("parts") > 0)
    cut = cut.withColumn("size", F.least(F.size("parts"), F.lit(SHINGLE)))
    runs = F.coalesce(*[F.when(F.col("size") == k, shingle_hashes("parts", k)) for k in range(1, SHINGLE + 1)])
    hashed = cut.select("template", "license", "size", F.array_distinct(runs).alias("wanted")).withColumn("n", F.size("wanted"))
    return keep(hashed.withColumn("keys", band_keys(F.col("wanted"))), "license-templates")


def _longs(values: Sequence[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _windows(hashes: Column, had: Column, spans: Sequence[tuple[int, int]], size: int) -> Column:
    """Windows around the template shingles ``had`` of ``hashes``, as ``start * 2^23 + n * 2^3 + size``.

    For each place of a shingle all windows on the grid of quarters that cover
    it, for every ``n`` (shingles in a template) that ``spans`` gives for it.
    """
    keys, counts = _longs([h for h, _ in spans]), _longs([n for _, n in spans])
    used = F.filter(F.sequence(F.lit(0), F.lit(len(spans) - 1)), lambda i: F.array_contains(had, F.get(keys, i)))

    def grid(place: Column, n: Column) -> Column:
        step = F.greatest(F.lit(1), F.floor(n / 4))
        first = F.ceil(F.greatest(place - (n - 1), F.lit(0)) / step)
        return F.transform(F.sequence(first, F.floor(place / step)), lambda k: k * step * (1 << 23) + n * 8 + size)

    def near(place: Column, own: Column) -> Column:
        fitting = F.filter(own, lambda i: F.get(keys, i) == F.get(hashes, place))
        return F.flatten(F.transform(fitting, lambda i: grid(place, F.get(counts, i))))

    places = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(had, F.get(hashes, i)))
    # One-element arrays name what all places share.
    found = F.transform(F.array(used), lambda own: F.flatten(F.transform(places, lambda i: near(i, own))))
    return F.when(F.size(had) > 0, F.flatten(found)).otherwise(F.array().cast("array<long>"))


def _starts(row: Column, wanted: Column, n: Column) -> Column:
    """Starts on the grid of quarters whose windows of ``n`` hold one of ``wanted`` at least."""
    step = F.greatest(F.lit(1), F.floor(n / 4))

    def covering(place: Column) -> Column:
        first = F.ceil(F.greatest(place - (n - 1), F.lit(0)) / step)
        return F.transform(F.sequence(first, F.floor(place / step)), lambda k: k * step)

    places = F.filter(F.sequence(F.lit(0), F.size(row) - 1), lambda i: F.array_contains(wanted, F.get(row, i)))
    return F.array_distinct(F.flatten(F.transform(places, covering)))


def _shared(start: Column) -> Column:
    """How many of ``wanted`` stand in the window at ``start`` of ``row``, widened by half its size on both sides."""
    first = F.greatest(start - F.floor(F.col("n") / 2), F.lit(0)).cast("int")
    return F.size(F.array_intersect("wanted", F.slice("row", first + 1, (F.col("n") * 2).cast("int"))))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    *,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document and license found: best template, share, and place.

    Columns: ``doc_id, license, template, containment, first_word`` (the word at
    which the window of the best match starts; ties: the earliest, then the first
    template). Notices of one family may share most words: the one meant has the
    larger containment. The templates are a parameter of bounded size. A null text has no
    words; repeated rows of one id are one document.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = template_table(spark, templates)
    listed = known.collect()  # as many rows as templates
    if not listed:
        return spark.createDataFrame([], "doc_id long, license string, template int, containment double, first_word int")
    lengths = sorted({row["size"] for row in listed})
    # Of every shingle the numbers of shingles of the templates that have it.
    spans = {k: sorted({(h, row["n"]) for row in listed if row["size"] == k for h in row["wanted"]}) for k in lengths}
    wanted = {k: _longs(sorted({h for h, _ in spans[k]})) for k in lengths}

    parts = with_once(docs.select("doc_id", "text"), "parts", words(F.col("text")))
    runs = F.array(*[shingle_hashes("parts", k) for k in lengths])
    hashed = with_once(parts.select("doc_id", "parts"), "hashes", runs).select("doc_id", "hashes")
    row = lambda j: F.get(F.col("hashes"), F.lit(j))
    hashed = hashed.filter(reduce(or_, [F.arrays_overlap(row(j), wanted[k]) for j, k in enumerate(lengths)]))
    had = F.array(*[F.array_intersect(row(j), wanted[k]) for j, k in enumerate(lengths)])
    marked = with_once(hashed, "had", had).withColumn("entry", F.monotonically_increasing_id())
    marked = keep(marked, "license-documents")
    of_size = lambda size: F.get(F.col("hashes"), F.array_position(F.lit(lengths), size).cast("int") - 1)
    around = F.concat(*[_windows(row(j), F.get(F.col("had"), F.lit(j)), spans[k], k) for j, k in enumerate(lengths)])
    windows = marked.select("entry", "hashes", F.explode(F.array_distinct(around)).alias("at")).select(
        "entry",
        of_size(F.col("at").bitwiseAND(7).cast("int")).alias("row"),
        F.col("at").bitwiseAND(7).cast("int").alias("size"),
        F.shiftright("at", 3).bitwiseAND((1 << 20) - 1).cast("int").alias("n"),
        F.shiftright("at", 23).cast("int").alias("start"),
    )
    windows = windows.select("entry", "size", "n", F.slice("row", F.col("start") + 1, F.col("n")).alias("inner"))
    windows = with_once(windows, "keys", band_keys(F.col("inner")))
    keyed = windows.select("entry", "size", "n", F.explode(F.array_distinct("keys")).alias("key"))
    index = known.select("template", "size", "n", F.explode("keys").alias("key"))
    met = lookup_join(keyed, keep(index, "license-index"), ["size", "n", "key"], spread=["entry"])
    retrieved = met.select("entry", "template").distinct()

    # Every window of a retrieved template is compared, also those no band has met.
    named = lookup_join(retrieved, known.drop("keys"), ["template"], spread=["entry"])
    tried = marked.select("entry", "doc_id", "hashes").join(named, "entry")
    tried = tried.select("doc_id", "license", "template", "wanted", "n", of_size(F.col("size")).alias("row"))
    tried = with_once(tried, "starts", _starts(F.col("row"), F.col("wanted"), F.col("n")))
    tried = with_once(tried, "top", F.array_max(F.transform("starts", lambda at: F.struct(_shared(at).alias("held"), (-at).alias("before")))))
    found = tried.select(
        "doc_id",
        "license",
        "template",
        (F.col("top.held") / F.col("n")).alias("containment"),
        (-F.col("top.before")).cast("int").alias("first_word"),
    )
    best = F.max_by(
        F.struct("template", "containment", "first_word"),
        F.struct("containment", -F.col("first_word"), -F.col("template")),
    )
    return (
        found.filter(F.col("containment") >= containment)
        .groupBy("doc_id", "license")
        .agg(best.alias("best"))
        .select("doc_id", "license", "best.template", "best.containment", "best.first_word")
    )
