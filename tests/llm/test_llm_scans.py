"""Secret and license scans."""

import random
import string

import llm_brute as brute
from llm_fixtures import corpus, make, nothing, odd  # noqa: F401
from revlens.llm import license_scan, secret_scan

COLUMNS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"]


def found(df):
    return {r.doc_id: tuple(r[c] for c in COLUMNS) for r in secret_scan.secret_scan(df).collect()}


def test_secrets_against_plain_python(make, corpus):
    rnd = random.Random(5)
    b64 = string.ascii_letters + string.digits + "+/"
    rows = corpus[:60] + [
        (1000, "password=abc token: 'abcdef' Secret = zz_____ apikey:\"1234567\" é token=é secret==aaaa"),
        (1001, "AKIA" + "A" * 16 + " AKIAB AKIAAKIA" + "B" * 11), (1002, "token=" * 9 + "abcdefghi"),
        (1003, "é😀" + "deadbeef" * 5 + " q " + "".join(rnd.choices(b64, k=70)) + "a" * 60 + "".join(rnd.choices(b64, k=50))),
        (1004, "0123456789abcdef0123456789abcdef /usr/share/dict/words/and/more_of_them_here"),
        (1005, "123e4567-e89b-12d3-a456-426614174000 " + "".join(rnd.choices("0123456789abcdef", k=64))),
        (1006, "PassWord\"  :  'x" + "y" * 5 + "' api_key=secret=abcdef")]
    got = found(make(rows))
    assert got == {i: brute.secrets(t, secret_scan) for i, t in rows}
    assert got[1003][5] >= 2 and got[1004][5] == 0 and "entropy_hex" in got[1005][4]


def test_a_secret_beside_a_sample_word(make):
    rnd = random.Random(8)
    key = "".join(rnd.sample(string.ascii_letters + string.digits, 60))
    rows = [(1, key), (2, f"{key}/xxxx/{key}"), (3, f"EXAMPLE{key}"), (4, "example" * 20), (5, "exampleXXXXplaceholder0123456789ABCDEF" * 3)]
    got = found(make(rows))
    assert got == {i: brute.secrets(t, secret_scan) for i, t in rows}
    assert [got[i][5] for i in range(1, 6)] == [1, 2, 1, 0, 0]


def test_one_very_long_candidate(make):
    import time

    rnd = random.Random(4)
    b64 = string.ascii_letters + string.digits + "+/"
    long, start = "".join(rnd.choices(b64, k=400_000)), time.time()
    rows = [(1, long), (2, "a" * 300_000 + long[:30]), (3, " ".join("".join(rnd.choices("0123456789abcdef", k=32)) for _ in range(4000)))]
    got = found(make(rows))
    assert time.time() - start < 60
    assert got[1][5] >= 1 and got[2] == brute.secrets(rows[1][1], secret_scan) and got[3] == brute.secrets(rows[2][1], secret_scan)


def test_secrets_edges(odd, nothing):
    rows = secret_scan.secret_scan(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.spans == "" and r.base_sha256 == brute.sha("") for r in rows if r.doc_id in (1, 2, 3))
    assert [r.spans for r in rows if r.doc_id == 9] == ["assign:0:19"]
    assert secret_scan.secret_scan(nothing).count() == 0


def test_incremental_windows_equal_counting_each(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(9)
    rows = [("".join(rnd.choices("abcdef0123456789", k=n)),) for n in (24, 25, 60, 200)] + [("a" * 100 + "0f1e2d3c4b5a69788796a5b4",)]
    df = spark.createDataFrame(rows, "s string").select("s", secret_scan.hot_windows(F.col("s"), 24, 3.4).alias("w"))
    class Only:
        ENTROPY, WINDOW, ALLOWED, SAMPLES, ASSIGN = (("k", "0-9a-f", 3.4),), 24, (), (), "(?!)"
    for r in df.collect():
        expected = brute.secrets(r.s, Only)[4].split(",")
        assert [f"k:{w.low}:{w.high}" for w in r.w] == [e for e in expected if e.startswith("k:")]


def test_licenses(make):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software. "
           "The above copyright notice and this permission notice shall be included in all copies or substantial "
           "portions of the Software. The software is provided \"as is\", without warranty of any kind, express or implied.")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:\nRedistributions of source code must retain the above copyright notice, this list "
           "of conditions and the following disclaimer.\nRedistributions in binary form must reproduce the above copyright notice")
    rows = [(1, "x\nLicensed under CC BY-NC 4.0.\ny. Released under the MIT License."), (2, mit), (3, bsd), (4, "licensed to kill"),
            (5, "Copyright (c) 2020 Someone. All rights reserved."), (6, "All Rights  Reserved! All rights reserved."),
            (7, bsd + ". Neither the name of X nor Y may be used to endorse or promote products"),
            (8, "You may obtain a copy of the License at: nowhere"), (9, None),
            (10, "Licensed under the Apache License, Version 2.0. Released under the MIT License. All rights reserved.")]
    got = {r.doc_id: (r.licenses, r.n_sentences, r.n_unmatched) for r in license_scan.license_scan(make(rows)).collect()}
    assert got == {1: ("MIT,CC-BY-NC-4.0", 2, 0), 2: ("MIT", 3, 0), 3: ("BSD-2-Clause", 3, 0), 4: ("", 0, 0),
                   5: ("LicenseRef-Proprietary", 2, 0), 6: ("LicenseRef-Proprietary", 2, 0), 7: ("BSD-3-Clause", 4, 0),
                   8: ("", 1, 1), 9: ("", 0, 0), 10: ("MIT,Apache-2.0,LicenseRef-Proprietary", 3, 0)}


def test_license_tables_and_edges(odd, nothing):
    import re

    ids = {*license_scan.SENTENCES.values(), *(n for _, n in license_scan.PATTERNS)}
    assert all(set(seq) <= ids for _, seq in license_scan.RULES)
    hint = re.compile(license_scan.HINT)
    assert all(hint.search(s) for s in license_scan.SENTENCES)
    assert all(re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s) for s in license_scan.SENTENCES)
    rows = license_scan.license_scan(odd).collect()
    assert len(rows) == odd.count() and [r.licenses for r in rows if r.doc_id == 15] == ["MIT"]
    assert license_scan.license_scan(nothing).count() == 0


GPL2 = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.")
GPL3 = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.")
COPY = " You should have received a copy of the GNU General Public License along with this program; if not, see elsewhere."


def licenses(df):
    return {r.doc_id: (r.licenses, r.n_sentences, r.n_unmatched) for r in license_scan.license_scan(df).collect()}


def test_gpl_notices_and_spdx_tags(make):
    tags = {"MIT": "MIT", "GPL-2.0+": "GPL-2.0-or-later", "GPL-2.0": "GPL-2.0-only", "(MIT OR Apache-2.0) */": "MIT,Apache-2.0",
            "GPL-3.0-or-later AND BSD-2-Clause": "BSD-2-Clause,GPL-3.0-or-later", "Apache-2.0 WITH LLVM-exception": "Apache-2.0"}
    rows = [(1, GPL2), (2, GPL3), (3, GPL2 + COPY), (4, GPL3 + COPY), (5, GPL3.replace("GNU General", "GNU Lesser General")),
            (6, "// SPDX-License-Identifier: MIT-0"), (7, "x. SPDX-License-Identifier:MIT\nmit\nlicense"),
            (8, GPL2.replace("2 of", "3 of")), *((100 + i, f"# SPDX-License-Identifier: {v}\ncode") for i, v in enumerate(tags)),
            *((200 + i, f"/* SPDX-License-Identifier: {v} */") for i, v in enumerate(license_scan.SPDX))]
    got = licenses(make(rows))
    assert {i: got[i] for i in range(1, 9)} == {
        1: ("GPL-2.0-or-later", 2, 0), 2: ("GPL-3.0-or-later", 1, 0), 3: ("GPL-2.0-or-later", 3, 0),
        4: ("GPL-3.0-or-later", 2, 0), 5: ("LGPL-3.0-or-later", 1, 0), 6: ("", 1, 1), 7: ("MIT", 1, 0), 8: ("GPL-3.0-or-later", 2, 0)}
    for i, want in enumerate(tags.values()):
        assert set(got[100 + i][0].split(",")) == set(want.split(",")) and got[100 + i][2] == 0
    assert [got[200 + i] for i in range(len(license_scan.SPDX))] == [(v, 1, 0) for v in license_scan.SPDX.values()]


MIT = ("MIT License\n\nCopyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of "
       "this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, subject "
       "to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
       "substantial portions of the Software.\n\nThe software is provided \"as is\", without warranty of any kind, express or implied.")
BSD = ("Copyright (c) 2020, Someone\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without "
       "modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must "
       "retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in "
       "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
       "documentation and/or other materials provided with the distribution.")
BSD3 = BSD + ("\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
          "the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0")


LGPL21 = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
          "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
          "version.")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
       "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
       "provided that the above copyright notice and this permission notice appear in all copies.\n\nThe software is provided "
       "\"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of "
       "merchantability and fitness.")
ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:")
EPL = ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
       "available at https://www.eclipse.org/legal/epl-2.0/")
CC0 = ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
       "software to the public domain worldwide. This software is distributed without any warranty.")
BSL = "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)"


def test_wrapped_notices(make):
    import textwrap

    def wrapped(text, width, mark="", end="\n"):
        lines = [x for p in text.split("\n") for x in textwrap.wrap(p, width) or [""]]
        return "code\n\n" + end.join((mark + x).rstrip() for x in lines) + end

    notices = [(MIT, "MIT", 4, 1), (BSD, "BSD-2-Clause,LicenseRef-Proprietary", 5, 0), (BSD3, "BSD-3-Clause,LicenseRef-Proprietary", 6, 0),
               (GPL2 + COPY, "GPL-2.0-or-later", 3, 0), (GPL3 + COPY, "GPL-3.0-or-later", 2, 0), (APACHE, "Apache-2.0", 3, 0),
               (LGPL21, "LGPL-2.1-or-later", 2, 0), (GPL3.replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later", 1, 0),
               (MPL, "MPL-2.0", 2, 0), (ISC, "ISC", 2, 0), (ZLIB, "Zlib", 2, 0), (EPL, "EPL-2.0", 1, 0), (CC0, "CC0-1.0", 1, 0),
               (BSL, "BSL-1.0", 1, 0), (ISC.replace(", provided that the above copyright notice and this permission notice appear "
                                                    "in all copies", ""), "0BSD", 2, 0)]
    styles = [(w, m, e) for w in (25, 60, 76, 400) for m, e in (("", "\n"), ("# ", "\n"), ("// ", "\r\n"), (" * ", "\n"), (";; ", "\n"),
                                                               ("! ", "\n"), ("| ", "\n"))]
    rows = [(100 * k + j, wrapped(n[0], *style)) for k, n in enumerate(notices) for j, style in enumerate(styles)]
    assert licenses(make(rows)) == {100 * k + j: n[1:] for k, n in enumerate(notices) for j in range(len(styles))}


def test_lines_and_cuts_still_end_sentences(make):
    rows = [(1, "Released under\n\nthe MIT License"), (2, "Released under. the MIT License"), (3, "Released under\n//\n// the MIT License"),
            (4, "a\nReleased under the MIT License\nb"), (5, "x Released under\nthe MIT License"), (6, "Released under\nthe MIT License b"),
            (7, "Licensed under CC BY 4.0\nAll rights reserved"), (8, "Released under\r\n\tthe MIT\nLicense\nAll rights reserved"),
            (9, "Neither the name of X. may be used to endorse or promote products"), (10, "license" + "\n" * 20000 + "\n \n" * 20000)]
    assert licenses(make(rows)) == {
        1: ("", 0, 0), 2: ("", 0, 0), 3: ("", 0, 0), 4: ("MIT", 1, 0), 5: ("", 0, 0), 6: ("", 0, 0),
        7: ("CC-BY-4.0,LicenseRef-Proprietary", 2, 0), 8: ("MIT,LicenseRef-Proprietary", 2, 0), 9: ("", 0, 0), 10: ("", 0, 0)}
