"""License scans: sentences become known identifiers, ordered rules match sequences of identifiers.

A text is cut after ``. ! ? ; :`` before white space and at blank lines (lines without ASCII letters and digits, so
a bare comment mark is one); marks that open a line cut nothing.  A sentence is a line or several consecutive lines
between cuts.  It is normalised (A-Z lower-cased, runs of other than ASCII letters and digits one blank) and looked
up: first as a whole among ``SENTENCES``, then by ``PATTERNS`` for sentences that hold a version, a year or a name;
of the sentences that start at a line the longest whole one counts.  The identifiers of
a text, in order, are matched against ``RULES`` in their order; what a rule matches is used up.  Identifiers
that no rule uses are counted as unmatched.  The value of an SPDX tag belongs to the tag's sentence; each licence
of its expression (``A OR B``, ``A AND B``) is one identifier.

A null text counts as empty; a text without known sentences has no identifiers; rows keep their ids, null or
repeated; an empty table gives an empty result.  Everything happens inside the row: no shuffle.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import id_text

#: Normalised sentence -> identifier.
SENTENCES = {
    "licensed under the apache license version 2 0": "Apache-2.0-ref",
    "licensed under the apache license version 2 0 the license": "Apache-2.0-ref",
    "you may not use this file except in compliance with the license": "Apache-use",
    "you may obtain a copy of the license at": "Apache-copy",
    "this work is licensed under the gnu general public license version 3": "GPL-3-ref",
    "this program is licensed under the gnu general public license version 2": "GPL-2-ref",
    "you should have received a copy of the gnu general public license along with this program": "GPL-copy",
    "released under the mit license": "MIT-ref",
    "licensed under the mit license": "MIT-ref",
    "this project is licensed under the mit license": "MIT-ref",
    "licensed under cc by nc 4 0": "CC-BY-NC-4.0-ref",
    "licensed under cc by 4 0": "CC-BY-4.0-ref",
    "licensed under cc by sa 4 0": "CC-BY-SA-4.0-ref",
    "released into the public domain": "PublicDomain",
    "this is free and unencumbered software released into the public domain": "Unlicense-start",
    "all rights reserved": "AllRightsReserved",
    "the software is provided as is without warranty of any kind express or implied": "AsIs",
    "the above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the software": "MIT-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met": "BSD-start",
    "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer": "BSD-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "BSD-binary",
    "redistributions in binary form must reproduce the above copyright notice": "BSD-binary",
    "this source code form is subject to the terms of the mozilla public license v": "MPL-2.0-start",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "ISC-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "ISC-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "0BSD-grant",
    "this software is provided as is without any express or implied warranty": "Zlib-asis",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
    "it and redistribute it freely subject to the following restrictions": "Zlib-grant",
    "distributed under the boost software license version 1 0": "BSL-1.0-ref",
}
#: Licences that an SPDX tag may name; GNU names without ``-only`` or ``-or-later`` are the older names of ``-only``.
SPDX = {name: name for name in (
    "MIT", "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0-or-later", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-2.0-only", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC-BY-4.0", "Unlicense", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "ISC", "EPL-2.0", "CC0-1.0",
    "Zlib", "BSL-1.0", "0BSD")} | {
    name: f"{name}-only" for name in ("GPL-3.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")}
TAG = "spdx license identifier"
_GPL = ("^(this program is free software )?you can redistribute it and or modify it under the terms of the gnu "
        "general public license")
_LGPL = ("^(this (program|library) is free software )?you can redistribute it and or modify it under the terms of the gnu "
         "lesser general public license")
_AGPL = ("^(this program is free software )?you can redistribute it and or modify it under the terms of the gnu "
         "affero general public license")
#: Sentences with a part that varies: (pattern over the normalised sentence, identifier).
PATTERNS = (
    ("^permission is hereby granted free of charge to any person obtaining a copy", "MIT-grant"),
    ("^neither the names? of .* may be used to endorse or promote products", "BSD-endorse"),
    (_GPL + " .*version 2 .*any later version$", "GPL-2-or-later"),
    (_GPL + " .*version 3 .*any later version$", "GPL-3-or-later"),
    (_GPL + "( as published by the free software foundation)?$", "GPL-grant"),
    (_LGPL + " .*version 2 1 .*any later version$", "LGPL-2.1-or-later"),
    (_LGPL + " .*version 3 .*any later version$", "LGPL-3-or-later"),
    (_LGPL + "( as published by the free software foundation)?$", "LGPL-grant"),
    (_AGPL + " .*version 3 .*any later version$", "AGPL-3-or-later"),
    (_AGPL + "( as published by the free software foundation)?$", "AGPL-grant"),
    ("^either version 2 1 .*any later version$", "LGPL-2.1-later"),
    ("^either version 2 .*any later version$", "GPL-2-later"),
    ("^either version 3 .*any later version$", "GPL-3-later"),
    ("^if a copy of the mpl was not distributed with this file", "MPL-copy"),
    ("^this program and the accompanying materials are made available under the terms of the eclipse public license "
     "(version |v )?2 0", "EPL-2.0-ref"),
    ("^to the extent possible under law .*dedicated all copyright and related and neighboring rights to this (work|software) "
     "to the public domain worldwide", "CC0-ref"),
    ("^the software is provided as is and .*disclaims all warranties with regard to this software", "ISC-asis"),
    ("^(copyright|c copyright)( c)? ([0-9]{4} )+", "Copyright"),
    *((f"^{TAG} " + re.sub("[^a-z0-9]+", " ", value.lower()) + "( with .*)?$", f"SPDX-{name}") for value, name in SPDX.items()),
    (f"^{TAG}", "SPDX"),
)
#: Rules in order: (licence, sequence of identifiers; the later ones may be missing from the optional part on).
RULES = (
    ("BSD-3-Clause", ("BSD-start", "BSD-source", "BSD-binary", "BSD-endorse")),
    ("BSD-2-Clause", ("BSD-start", "BSD-source", "BSD-binary")),
    ("MIT", ("MIT-grant", "MIT-notice", "AsIs")),
    ("MIT", ("MIT-grant", "MIT-notice")),
    ("MIT", ("MIT-ref",)),
    ("Apache-2.0", ("Apache-2.0-ref", "Apache-use", "Apache-copy")),
    ("Apache-2.0", ("Apache-2.0-ref",)),
    ("GPL-3.0-or-later", ("GPL-3-or-later", "GPL-copy")),
    ("GPL-3.0-or-later", ("GPL-3-or-later",)),
    ("GPL-3.0-or-later", ("GPL-grant", "GPL-3-later", "GPL-copy")),
    ("GPL-3.0-or-later", ("GPL-grant", "GPL-3-later")),
    ("GPL-2.0-or-later", ("GPL-2-or-later", "GPL-copy")),
    ("GPL-2.0-or-later", ("GPL-2-or-later",)),
    ("GPL-2.0-or-later", ("GPL-grant", "GPL-2-later", "GPL-copy")),
    ("GPL-2.0-or-later", ("GPL-grant", "GPL-2-later")),
    ("GPL-3.0-only", ("GPL-3-ref", "GPL-copy")),
    ("GPL-3.0-only", ("GPL-3-ref",)),
    ("GPL-2.0-only", ("GPL-2-ref",)),
    ("LGPL-2.1-or-later", ("LGPL-2.1-or-later",)),
    ("LGPL-2.1-or-later", ("LGPL-grant", "LGPL-2.1-later")),
    ("LGPL-3.0-or-later", ("LGPL-3-or-later",)),
    ("LGPL-3.0-or-later", ("LGPL-grant", "GPL-3-later")),
    ("AGPL-3.0-or-later", ("AGPL-3-or-later",)),
    ("AGPL-3.0-or-later", ("AGPL-grant", "GPL-3-later")),
    ("MPL-2.0", ("MPL-2.0-start", "MPL-copy")),
    ("MPL-2.0", ("MPL-2.0-start",)),
    ("ISC", ("ISC-grant", "ISC-asis")),
    ("ISC", ("ISC-grant",)),
    ("0BSD", ("0BSD-grant", "ISC-asis")),
    ("0BSD", ("0BSD-grant",)),
    ("EPL-2.0", ("EPL-2.0-ref",)),
    ("CC0-1.0", ("CC0-ref",)),
    ("Zlib", ("Zlib-asis", "Zlib-grant")),
    ("Zlib", ("Zlib-grant",)),
    ("BSL-1.0", ("BSL-1.0-ref",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-4.0-ref",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-4.0-ref",)),
    ("CC-BY-4.0", ("CC-BY-4.0-ref",)),
    ("Unlicense", ("Unlicense-start",)),
    ("LicenseRef-PublicDomain", ("PublicDomain",)),
    ("LicenseRef-Proprietary", ("Copyright", "AllRightsReserved")),
    ("LicenseRef-Proprietary", ("AllRightsReserved",)),
    *((name, (f"SPDX-{name}",)) for name in dict.fromkeys(SPDX.values())),
)
#: Every known sentence has one of these words, so other texts need not be cut.
HINT = "(?i:licen|copyright|reserved|permission|redistribut|domain|warrant|neither)"
BREAK = r"[.!?;:]+[\x20\t\n\x0B\f\r]+"
#: Breaks that only open a line are comment marks.
MARK = r"(?md)^[\x20\t]*[!;:]+(?=[\x20\t]|$)"
OTHER = "[^a-z0-9|\n]+"


def _known() -> str:
    """Pattern of all known sentences over a normalised text, where ``|`` is a cut and a newline a line end; the
    longest sentences first."""
    varying = [p.removeprefix("^").replace(".*", "[^|]*?").replace("(", "(?:").replace("$", "(?![^|\n])").replace(" ", "[ \n]")
               for p, i in PATTERNS if not i.startswith("SPDX")]
    whole = [s.replace(" ", "[ \n]") + "(?![^|\n])" for s in sorted(SENTENCES, key=lambda s: (-len(s), s))]
    return "(?<![^|\n])(?:" + "|".join([*whole, *varying, f"{TAG}(?![a-z0-9])[a-z0-9 ]*"]) + ")"


def tagged(text: Column) -> Column:
    """A text, A-Z lower-cased and without ``|``, in which an SPDX tag starts a sentence that its value belongs to."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ|", "abcdefghijklmnopqrstuvwxyz ")
    later = F.regexp_replace(lower, r"(gpl-[0-9.]+)\+", "$1-or-later")
    return F.regexp_replace(later, r"spdx-license-identifier[\x20\t]*:[\x20\t]*", f"|{TAG} ")


def normalised(text: Column) -> Column:
    """A text, normalised: ``|`` at cuts, newlines at other line ends."""
    cut = F.regexp_replace(F.regexp_replace(tagged(text), MARK, " "), BREAK, "|")
    cut = F.regexp_replace(cut, "\n[^a-z0-9|\n]*+(?=\n)", "|")
    return F.regexp_replace(F.regexp_replace(cut, OTHER, " "), "^ | $| (?=[|\n])|(?<=[|\n]) ", "")


def sentences(text: Column) -> Column:
    """The known sentences of a text, in order, each on one line."""
    return F.transform(F.regexp_extract_all(normalised(text), F.lit(_known()), F.lit(0)), lambda s: F.translate(s, "\n", " "))


def operands(sentence: Column) -> Column:
    """The tag before each licence of its expression; any other sentence alone."""
    each = F.transform(F.split(F.substr(sentence, F.lit(len(TAG) + 2)), " (?:or(?! later(?![a-z0-9]))|and) "),
                       lambda v: F.concat(F.lit(f"{TAG} "), v))
    return F.when(F.startswith(sentence, F.lit(f"{TAG} ")), each).otherwise(F.array(sentence))


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.create_map(*(F.lit(x) for x in chain.from_iterable(SENTENCES.items())))

    def one(sentence: Column) -> Column:
        found = F.try_element_at(known, sentence)
        return F.coalesce(found, *(F.when(sentence.rlike(pattern), F.lit(name)) for pattern, name in PATTERNS))

    each = F.flatten(F.transform(sentences(text), operands))
    ids = F.filter(F.transform(each, one), lambda i: i.isNotNull())
    return F.when(text.rlike(HINT), ids).otherwise(F.array().cast("array<string>"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``sentences`` (identifiers in order), ``licenses`` (in the order of the rules,
    each once), ``n_sentences``, ``n_unmatched``."""
    rows = id_text(docs, id_col, text_col).select("doc_id", identifiers(F.col("text")).alias("ids"))
    # an identifier stands between bars, so a rule is a literal; what is used up leaves a mark that no rule has
    rows = rows.withColumn("left", F.concat(F.lit("|"), F.array_join(F.transform("ids", lambda i: F.concat(i, F.lit("|"))), "|")))
    licenses = F.array().cast("array<string>")
    left = F.col("left")
    found = []
    for name, sequence in RULES:
        literal = "|" + "||".join(sequence) + "|"
        found.append(F.when(F.contains(left, F.lit(literal)), F.lit(name)))
        left = F.replace(left, F.lit(literal), F.lit("#"))
    licenses = F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull()))
    empty = F.size("ids") == 0
    unmatched = F.size(F.filter(F.split(left, "[|#]+"), lambda x: x != ""))
    return rows.select(
        "doc_id", F.array_join("ids", ",").alias("sentences"),
        F.when(empty, F.lit("")).otherwise(F.array_join(licenses, ",")).alias("licenses"),
        F.size("ids").cast("long").alias("n_sentences"),
        F.when(empty, F.lit(0)).otherwise(unmatched).cast("long").alias("n_unmatched"))
