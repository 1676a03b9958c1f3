"""Recall and precision of the licence scan on labelled notices, wrapped and embedded, and on texts that only sound like them."""

import random

from corpusflow.llm import license_scan
from corpusflow.llm.license_texts import OPENINGS, TEMPLATES

#: (text, licence), written by hand.
NOTICES = [
    ("Copyright 2020 Acme. This file is licensed under the MIT License; see LICENSE.", "MIT"),
    ("This project is MIT licensed.", "MIT"),
    ("Distributed under the terms of the Apache License 2.0", "Apache-2.0"),
    ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("Licensed under the MIT license", "MIT"),
    ("Released under the MIT License. Enjoy!", "MIT"),
    ("# SPDX-License-Identifier: BSD-3-Clause\n# Copyright Acme", "BSD-3-Clause"),
    ("/* SPDX-License-Identifier: GPL-2.0 */", "GPL-2.0"),
    ("The code is available under the Apache License, Version 2.0.", "Apache-2.0"),
    ("All sources are under the 3-clause BSD license, see COPYING", "BSD-3-Clause"),
    ("You may use it under the BSD 2-Clause License or not at all", "BSD-2-Clause"),
    ("redistributed under the terms of the GNU General Public License version 3 as published", "GPL-3.0"),
    ("This library is offered under the GNU Lesser General Public License v2.1", "LGPL-2.1"),
    ("subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
    ("is subject to the terms of the\n * Mozilla Public License 2.0\n", "MPL-2.0"),
    ("Text is available under the Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    ("images under the CC BY 4.0 license by their authors", "CC-BY-4.0"),
    ("published under the ISC License", "ISC"),
    ("dual: under the GNU AGPL v3 or commercial", "AGPL-3.0"),
    ("is released under the Boost Software License 1.0", "BSL-1.0"),
    ("This package is GPLv3 licensed", "GPL-3.0"),
    ("shipped under the zlib license", "Zlib"),
]
ORDINARY = [
    "The driver's license was issued under the old rules of the state.",
    "He licensed the song under the terms of an agreement with the studio.",
    "A license to kill is the title of a film.",
    "The fishing license is free of charge to any person over sixty.",
    "You must obtain a license from the city before you open a shop.",
    "Students at MIT wrote the first version of the program.",
    "The Apache helicopter flew over the boost stage of the rocket.",
    "Creative people share what is common to them under the sun.",
    "The public library is free and open to all; no license is needed.",
    "Mozilla published version 2.0 of the browser last week.",
    "the terms of the contract were published under the supervision of the court",
    "general public admitted under the conditions of the foundation",
]


def labelled(rng):
    """The notices, openings and long templates: alone, and wrapped anew as comments inside other text."""
    filler = lambda n: " ".join(rng.choices("river stone window garden letter morning quiet table number seven".split(), k=n))
    whole = [(TEMPLATES[k], k[0]) for k in TEMPLATES if k[1] in ("header", "body", "grant")]
    rows = []
    for text, name in [*NOTICES, *((t, n) for n, t in OPENINGS.items()), *whole]:
        words = text.split()
        wrapped, at = [], 0
        while at < len(words):
            n = rng.randint(4, 9)
            wrapped.append(rng.choice(["# ", " * ", "// "]) + " ".join(words[at : at + n]))
            at += n
        rows += [(text, name), (filler(60) + "\n" + "\n".join(wrapped) + "\n" + filler(40), name)]
    return rows


def test_recall_and_precision(spark):
    rows = labelled(random.Random(3))
    plain = [*ORDINARY, *(x + " " + y for x, y in zip(ORDINARY, ORDINARY[1:], strict=False))]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([t for t, _ in rows] + plain)], "doc_id long, text string")
    got = {r.doc_id: [m.license for m in r.matches] for r in license_scan.scan(d).collect()}
    found = sum(name in got[i] for i, (_, name) in enumerate(rows))
    told = [(m, name) for i, (_, name) in enumerate(rows) for m in got[i]] + [(m, None) for i in range(len(rows), len(rows) + len(plain)) for m in got[i]]
    missed = [(t[:60], n, got[i]) for i, (t, n) in enumerate(rows) if n not in got[i]]
    assert all(name in got[2 * k] for k, (_, name) in enumerate(NOTICES)), missed
    assert found >= 0.9 * len(rows), missed
    assert sum(m == name for m, name in told) >= 0.9 * len(told), [x for x in told if x[0] != x[1]]
    assert not any(got[i] for i in range(len(rows), len(rows) + len(plain)))
