"""The license catalogue: usual wordings are found, and licenses that share most of their text are told apart."""

import re

from folioforge.llm import license_scan

OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
BSD_2 = OPENING + "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
CLAUSE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, {}version {} of the License{}."
LATER = ", or (at your option) any later version"
CASES = [
    ("This project is licensed under the MIT License", {"MIT"}),
    (MIT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", {"MIT"}),
    (MIT + ". THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND", {"MIT-0"}),
    (BSD_2 + END, {"BSD-2-Clause"}),
    (BSD_2 + "3. " + CLAUSE + END, {"BSD-3-Clause"}),
    (BSD_2.replace("1. ", "* ").replace("2. ", "* ") + "* " + CLAUSE + END, {"BSD-3-Clause"}),
    (GNU.format("", "either ", "2", LATER), {"GPL-2-or-later"}),
    (GNU.format("", "either ", "3", LATER), {"GPL-3-or-later"}),
    (GNU.format("", "", "2", ""), {"GPL-2-only"}),
    (GNU.format("Lesser ", "either ", "2.1", LATER), {"LGPL", "LGPL-2.1-or-later"}),
    (GNU.format("Lesser ", "either ", "3", LATER), {"LGPL"}),
    (GNU.format("Affero ", "either ", "3", LATER), {"AGPL"}),
    ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", {"MPL-2.0"}),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", {"ISC"}),
    (license_scan.TEMPLATES.get("Unlicense (text)", ""), {"Unlicense"}),
    (license_scan.TEMPLATES.get("Apache-2.0 (text)", ""), {"Apache-2.0"}),
    ("Licensed under CC BY-NC-SA 4.0.", {"CC-BY-NC-SA-4.0"}),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
    ("This licensed plumber released a record under the terms of the city.", set()),
]


def test_each_text_has_its_own_license_only(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {i: set() for i in range(len(CASES))}
    for r in license_scan.scan(df).collect():
        got[r["doc_id"]].add(r["license"].split(" (")[0])
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]


def test_templates_are_not_found_in_those_of_other_licenses():
    def shingled(t):
        w = [x for x in re.split(r"[\W_]+", t.lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    kind = lambda name: re.sub(r"-(2|3|2\.1)(\.0)?(-only|-or-later)?$", r"-\1", name.split(" (")[0])
    sets = {k: shingled(t) for k, t in license_scan.TEMPLATES.items()}
    assert all(sets.values())
    wrong = [(a, b) for a in sets for b in sets if kind(a) != kind(b) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a])]
    assert [(a, b) for a, b in wrong if not (kind(a) == "LGPL" and kind(b).startswith("LGPL"))] == []
