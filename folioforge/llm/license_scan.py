"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates are read as 5-word shingles (64-bit hashes of lower-case letter and digit runs).  A template is cut
into segments of at most SEGMENT shingles; the bands of a segment are MinHashes of its shingles, and those of a text are
MinHashes of every window (one starts at each shingle) of a segment's length.  A window that equals a segment collides
in every band.  A text that holds at least 80 % of a template's T shingles misses at most T / 5 of them, which is less
than the number of segments for every T, so one segment's shingles are all in the text; where they stand in one place, as
they do unless the text is taken apart, they collide with certainty.  Other windows collide in a band with the Jaccard
similarity of window and segment to the power BAND_ROWS, as each MinHash is the least value of a mixing hash.

A window can only collide if it holds a segment's least shingle, so only texts with one of those have their windows
banded.  The templates of the keys found are looked up by binary search; their shingles come from a table of a row a template,
broadcast if its counted size allows; templates are verified by the exact share of their distinct shingles in the text.
All of it is expressions on a row and that join: no Python, and no shuffle unless the templates are too large for a broadcast.

Defined cases: null or short texts (under five words) have no matches; a license found in several places is one row;
rows that repeat a doc_id have their own rows; a very long text is scanned whole, in memory with eight bytes a word; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, literal_array, own_columns
from .sharding import position

SHINGLE, SEGMENT, BANDS, BAND_ROWS = 5, 4, 2, 2
#: Seeds of the MinHashes: the least hash of (seed, shingle) is a MinHash's choice.
SEEDS = tuple(range(101, 101 + BANDS * BAND_ROWS))

# Whole texts (in licenses/), notices and short wordings. Templates of different licenses stay below the
# containment of 0.8 in each other's texts: where whole texts or notices share more (BSD, ISC, MIT and MIT-0, GPL-3.0 and AGPL-3.0,
# the LGPLs, the versions and kinds of GNU notices), the template is the passage that tells them apart, which every such text has.
_GNU, _FSF = "terms of the GNU {} as published by the Free Software Foundation", "{} version {} of the License"
_GPL, _LGPL, _AGPL = (f"{kind}General Public License" for kind in ("", "Lesser ", "Affero "))
_OTHER = "other materials provided with the distribution. "
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_SHORT = {"MIT": "the MIT License", "Apache-2.0": "the Apache License, Version 2.0", "ISC": "the ISC License", "Unlicense": "the Unlicense license", "BSD-2-Clause": "the BSD 2-Clause License", "BSD-3-Clause": "the BSD 3-Clause License"}

TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "under the GNU General Public License, version 3.",
    "GPL-2.0": "under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    **{f"{name} ({how})": f"{how} under {text}" for name, text in _SHORT.items() for how in ("licensed", "released", "distributed", "available") if (name, how) not in {("MIT", "released"), ("Apache-2.0", "licensed")}},
    **{f"CC-{k}-4.0": f"Licensed under CC {k} 4.0." for k in _CC if k != "BY-NC"},
    **{f"CC-{k}-4.0 (named)": f"Creative Commons {v} 4.0 International" for k, v in _CC.items()},
    "Apache-2.0 (header)": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MPL-2.0 (header)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    **{
        f"{name}-{v}-or-later (notice)": f"{_GNU.format(kind)}, {_FSF.format('either', v)}"
        for name, kind, v in (("GPL", _GPL, "2"), ("GPL", _GPL, "3"), ("LGPL", _LGPL, "2.1"))
    },
    **{
        f"{name}-{v}-only (notice)": f"{_GNU.format(kind)}, {_FSF.format('', v)}"
        for name, kind, v in (("GPL", _GPL, "2"), ("GPL", _GPL, "3"), ("LGPL", _LGPL, "2.1"))
    },
    **{f"GPL-{v}-only (version first)": f"terms of the GNU {_GPL} version {v} as published by the Free Software Foundation" for v in "23"},
    # Without the version: with it, the texts of GPL-3.0 and MPL-2.0, which name both, would hold 0.8 of them.
    "LGPL (notice)": f"terms of the GNU {_LGPL} as published by",
    "AGPL (notice)": f"terms of the GNU {_AGPL} as published by",
    "LGPL (named)": f"under the GNU {_LGPL}",
    "AGPL (named)": f"under the GNU {_AGPL}",
    "MPL-2.0": "under the Mozilla Public License, version 2.0",
    "BSD-2-Clause (text)": f"{_OTHER} THIS SOFTWARE IS PROVIDED BY THE",
    "BSD-3-Clause (text)": f"{_OTHER} Neither the name",
    "BSD-3-Clause (numbered text)": f"{_OTHER} 3. Neither the name",
    "BSD-4-Clause (text)": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "ISC (text)": "distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD (text)": "for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS",
    "MIT (text)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-0 (text)": "to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\"",
    "LGPL-2.0 (text)": "This license, the Library General Public License, applies to some specially designated Free Software Foundation software, and to any other libraries whose authors decide to use it.",
    "LGPL-2.1 (text)": "We call this license the \"Lesser\" General Public License because it does Less to protect the user's freedom than the ordinary General Public License. It also provides other free software developers Less of an advantage over competing non-free programs.",
    "GPL-3.0 (text)": "you have permission to link or combine any covered work with a work licensed under version 3 of the GNU Affero General Public License into a single combined work, and to convey the resulting work. The terms of this License will continue to apply to the part which is the covered work, but the special requirements of the GNU Affero General Public License, section 13, concerning interaction through a network will apply to the combination as such.",
    "AGPL-3.0 (text)": "if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge",
    **{f"{f.stem} (text)": f.read_text() for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))},
}
NOT_WORD = r"[^\p{L}\p{N}]+"


def shingles(text: Column) -> Column:
    """Hashes of the 5-word shingles of a text, in order."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")
    # The words are bound once, as the argument of a lambda, not evaluated for each use.
    return F.get(
        F.transform(
            F.array(tokens),
            lambda w: F.when(
                F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))
            ).otherwise(F.array().cast("array<bigint>")),
        ),
        F.lit(0),
    )


def _band(window: Column, length: int, band: int) -> Column:
    """A band's key: its MinHashes of a window, with the band and the window's length."""
    least = [_least(window, s) for s in SEEDS[band * BAND_ROWS : (band + 1) * BAND_ROWS]]
    return F.xxhash64(F.lit(length), F.lit(band), *least)


def _least(window: Column, seed: int) -> Column:
    return F.array_min(F.transform(window, lambda h: F.xxhash64(F.lit(seed), h)))


def _window_keys(hashes: Column, length: int) -> Column:
    """The keys of all windows of a length, in all bands."""
    starts = F.when(F.size(hashes) >= length, F.sequence(F.lit(1), F.size(hashes) - (length - 1))).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(starts, lambda i: F.array(*(_band(F.slice(hashes, i, F.lit(length)), length, b) for b in range(BANDS)))))


def template_shingles(spark: SparkSession, templates: Mapping[str, str]) -> dict[str, list[int]]:
    """The shingles of each template that has one, in order."""
    rows = F.explode(F.from_json(F.lit(json.dumps(list(templates.items()))), "array<array<string>>")).alias("row")
    found = spark.range(1).select(rows).select(F.get("row", F.lit(0)).alias("license"), shingles(F.get("row", F.lit(1))).alias("all")).collect()
    return {r["license"]: r["all"] for r in found if r["all"]}


def template_bands(spark: SparkSession, wanted: Mapping[str, list[int]]) -> DataFrame:
    """license, segment, and its key for each band."""
    segments = [{"license": k, "segment": all_[i : i + SEGMENT]} for k, all_ in wanted.items() for i in range(0, len(all_), SEGMENT)]
    rows = F.inline(F.from_json(F.lit(json.dumps(segments)), "array<struct<license:string,segment:array<bigint>>>"))
    key = F.lit(None).cast("array<bigint>")
    for n in range(1, SEGMENT + 1):
        key = F.when(F.size("segment") == n, F.array(*(_band(F.col("segment"), n, b) for b in range(BANDS)))).otherwise(key)
    chosen = F.array(*(F.array_min(F.transform("segment", lambda h: F.struct(F.xxhash64(F.lit(s), h).alias("hash"), h.alias("h"))))["h"] for s in SEEDS))  # noqa: B023
    return spark.range(1).select(rows).withColumn("keys", key).withColumn("least", chosen)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = 0.8) -> DataFrame:
    """One row per document and license found in it: doc_id, license, n_found (shingles), containment."""
    spark = docs.sparkSession
    shingled = template_shingles(spark, templates)
    found = template_bands(spark, shingled).collect()  # a row for every SEGMENT shingles of a template
    least = sorted({x for r in found for x in r["least"]})
    # Every (key, template) in order of the keys, so that a key's templates stand together.
    numbers = {name: i for i, name in enumerate(shingled)}
    of_key = sorted({(k, numbers[r["license"]]) for r in found for k in r["keys"]})
    keys, owners = literal_array([k for k, _ in of_key], "bigint"), literal_array([i for _, i in of_key], "int")
    lengths = sorted({len(r["segment"]) for r in found})

    rows = own_columns(docs, "doc_id", "text").select("doc_id", shingles(F.col("text")).alias("all"))
    # A set of constants: the work of a text goes with its own shingles, not with the templates'.
    rows = rows.filter(F.expr(f"exists(all, h -> h in ({', '.join(f'{x}L' for x in least)}))") if least else F.lit(False))
    banded = rows.withColumn("keys", F.array_distinct(F.flatten(F.array(*(_window_keys(F.col("all"), n) for n in lengths)))) if lengths else F.array().cast("array<bigint>"))

    def templates_of(key: Column) -> Column:
        end = position(key, keys, len(of_key))
        begin = position(key - 1, keys, len(of_key))
        return F.slice(owners, begin + 1, end - begin)

    each = banded.select("doc_id", "all", F.explode(F.array_distinct(F.flatten(F.transform("keys", templates_of)))).alias("number"))
    wanted = [{"of": i, "license": name, "wanted": list(dict.fromkeys(shingled[name]))} for name, i in numbers.items()]
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(wanted)), "array<struct<of:int,license:string,wanted:array<bigint>>>")))
    table = F.broadcast(table) if sum(64 + 8 * len(w["wanted"]) for w in wanted) <= BROADCAST_BYTES else table
    n_found = F.size(F.array_intersect("wanted", "all"))
    return (
        each.join(table, F.col("number") == F.col("of")).select("doc_id", "license", n_found.cast("long").alias("n_found"), (n_found / F.size("wanted")).alias("containment"))
        .filter(F.col("containment") >= containment)
    )
