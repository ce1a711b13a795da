"""License scan by sentence rules.

Sentences are normalised (lower case, runs of other characters than letters and
digits become one blank, the usual lead-ins of a grant and the word "version" go) and mapped to the numbers of known license sentences;
a license is found where a rule's ordered sentence numbers stand side by side.
DataFrame operations only, one projection without a shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: license sentences in normal form, by name
SENTENCES = {
    "apache_grant": "licensed under apache license 2 0 the license",
    "apache_not_use": "you may not use this file except in compliance with the license",
    "apache_copy_at": "you may obtain a copy of the license at",
    "mit_permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "isc_permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl_free": "this program is free software",
    "lgpl_free": "this library is free software",
    "gpl_redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "agpl_redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "lgpl_redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "later2": "either 2 of the license or at your option any later version",
    "later21": "either 2 1 of the license or at your option any later version",
    "later3": "either 3 of the license or at your option any later version",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "mpl_terms": "this source code form is subject to the terms of the mozilla public license v",
    "mpl_whole": "this source code form is subject to the terms of the mozilla public license 2 0",
    "mpl_two": "2 0",
    "boost_permission": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "spdx": "spdx license identifier",
}
# fixed values: names under which licenses are granted, in normal form (a sentence "licensed under" each of them, and each as a title)
NAMES = {
    "Apache-2.0": ("apache license 2 0", "apache 2 0 license", "apache 2 0", "apache software license 2 0"),
    "MIT": ("mit license", "mit", "mit x11 license", "expat license"),
    "ISC": ("isc license",), "Zlib": ("zlib license",), "BSL-1.0": ("boost software license 1 0",), "EPL-2.0": ("eclipse public license 2 0", "epl 2 0"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    "GPL-2.0": ("gnu general public license 2", "gnu general public license 2 0", "gnu gpl 2", "gpl 2", "gplv2"),
    "GPL-3.0": ("gnu general public license 3", "gnu general public license 3 0", "gnu gpl 3", "gpl 3", "gplv3"),
    "LGPL-2.1": ("gnu lesser general public license 2 1", "gnu lgpl 2 1", "lgpl 2 1"), "LGPL-3.0": ("gnu lesser general public license 3", "gnu lgpl 3", "lgpl 3"),
    "AGPL-3.0": ("gnu affero general public license 3", "gnu agpl 3", "agpl 3"), "MPL-2.0": ("mozilla public license 2 0", "mpl 2 0"),
    "CC0-1.0": ("cc0 1 0", "cc0 1 0 universal", "cc0"), "Unlicense": ("unlicense",),
}
# fixed values: the whole sentences that grant a license by themselves
ALONE = {"CC0-1.0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",),
         "Unlicense": ("this is free and unencumbered software released into the public domain",)}
_CC = {"by": "attribution", "by sa": "attribution sharealike", "by nc": "attribution noncommercial", "by nd": "attribution noderivatives",
       "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives"}
for _short, _long in _CC.items():
    for _version in ("2 0", "2 5", "3 0", "4 0"):
        NAMES[f"CC-{_short.replace(' ', '-').upper()}-{_version.replace(' ', '.')}"] = tuple(
            form.format(v=_version) for form in (f"cc {_short} {{v}}", f"cc {_short} {{v}} license", f"creative commons {_long} {{v}}",
                                                 f"creative commons {_long} {{v}} license", f"creative commons {_long} {{v}} international license"))
# fixed values: (license, ordered sentence names)
RULES = (
    ("Apache-2.0", ("apache_grant", "apache_not_use")), ("Apache-2.0", ("apache_not_use", "apache_copy_at")),
    ("MIT", ("mit_permission",)), ("MIT", ("mit_notice", "mit_as_is")), ("ISC", ("isc_permission",)), ("BSL-1.0", ("boost_permission",)),
    ("GPL-2.0", ("gpl_free", "gpl_redistribute", "later2")), ("GPL-3.0", ("gpl_free", "gpl_redistribute", "later3")),
    ("AGPL-3.0", ("gpl_free", "agpl_redistribute", "later3")), ("LGPL-2.1", ("lgpl_free", "lgpl_redistribute", "later21")),
    ("LGPL-3.0", ("lgpl_free", "lgpl_redistribute", "later3")),
    ("BSD", ("bsd_source", "bsd_binary")), ("BSD", ("bsd_redistribution",)), ("MPL-2.0", ("mpl_terms", "mpl_two")), ("MPL-2.0", ("mpl_whole",)),
)
# a sentence ends at one of .!?;: before white space or the end, at an empty line (or one of comment marks), and before a numbered item;
# any other line break is a blank. Titles stand on lines of their own, so the lines are looked up too.
SENTENCE_END = r"[.!?;:]+(?=[\x20\x09-\x0D]|$)|\r?\n[\x20\x09*#/;>-]*(?=\r?\n)|\r?\n[\x20\x09*#/;>-]*(?=\(?[0-9]{1,2}[.)][\x20\x09])"
LINE_END = r"[.!?;:]*(?:\r?\n)+|:[\x20\x09]+"
# fixed values: what may stand before a grant, and the words of a grant
LEAD = (r"^(?:(?:this|the|our) )?(?:source code|file|program|work|software|project|code|library|package|module|document|content|repository|data|text|image|it) "
        r"(?:is|are) (?:also |hereby |made |being )*")
GRANT = r"^(?:licensed|released|distributed|available|provided|published|shared) under (?:the terms of )?(?:the )?"


def normal(sentence: Column) -> Column:
    """Lower case, one blank for every other run than letters and digits, the lead-in of a grant left out, "version" left out."""
    s = F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))
    s = F.when(s.rlike(r"licensed|released|distributed|available|provided|published|shared"),
               F.regexp_replace(F.when(s.rlike(LEAD + r"(?:licensed|released|distributed|available|provided|published|shared) under "), F.regexp_replace(s, LEAD, "")).otherwise(s),
                                GRANT, "licensed under ")).otherwise(s)
    return F.regexp_replace(F.regexp_replace(s, r"\bversion (?=[0-9])", ""), r"\bv(?=[0-9])", "")


def sentence_table(sentences: dict[str, str] = SENTENCES, names: dict[str, tuple[str, ...]] = NAMES, alone: dict[str, tuple[str, ...]] = ALONE):
    """([sentence], {sentence name: number}, {number: license}, [(license, numbers)]): numbers count from 1."""
    texts = list(sentences.values())
    number = {name: i + 1 for i, name in enumerate(sentences)}
    grants: dict[int, str] = {}
    titles = []

    def add(text: str) -> int:
        if text not in texts:
            texts.append(text)
        return texts.index(text) + 1

    for license, forms in names.items():
        for form in forms:
            grants[add(f"licensed under {form}")] = license
            if form.endswith("license"):
                grants[add(form)] = grants[add(f"the {form}")] = license
            titles.append((license, (number["spdx"], add(form))))
        for suffix in ("", " only", " or later"):
            titles.append((license, (number["spdx"], add(license.lower().replace("-", " ").replace(".", " ") + suffix))))
    for license, forms in alone.items():
        for form in forms:
            grants[add(form)] = license
    return texts, number, grants, titles


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sentences: dict[str, str] = SENTENCES, rules=RULES, names: dict[str, tuple[str, ...]] = NAMES) -> DataFrame:
    """One row per row of ``docs``: doc_id, known_sentences, licenses (sorted, comma-joined; empty: none).

    Sentences are looked up by their hash in the set of known ones (some hundreds, literals of the plan) and get their numbers; the
    sequence of numbers is held against the rules: a grant by itself, an SPDX line (its lead and an identifier), or ordered
    sentences. A rule's sentences must follow one another; empty sentences and item numbers do not count as
    breaks, any other unknown sentence does. Line breaks are blanks in one reading and ends in another. A license found more than once is
    named once. Null and empty texts have no license; whole texts are read; repeated rows repeat; equal texts have equal licenses; other
    columns are ignored; an empty table gives an empty table.
    """
    texts, number, grants, pairs = sentence_table(sentences, names)
    spark = docs.sparkSession
    hashes = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]      # of the fixed sentences
    known = F.create_map(*(x for i, t in enumerate(texts) for x in (F.lit(t), F.lit(i + 1))))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def numbers(end: str) -> Column:
        parts = F.filter(F.transform(F.split(text, end), normal), lambda s: ~s.rlike(r"^[0-9]{0,2}$"))          # an item's number is no sentence
        return F.transform(parts, lambda s: F.when(F.xxhash64(s).isin(hashes), F.coalesce(F.try_element_at(known, s), F.lit(0))).otherwise(F.lit(0)))

    rows = docs.select(F.col(id_col).alias("doc_id"), numbers(SENTENCE_END).alias("numbers"), numbers(LINE_END).alias("lines"))
    listed = lambda c: F.concat(F.lit(","), F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit(","))
    count = lambda c: F.size(F.filter(c, lambda x: x > 0)).cast("long")
    rows = rows.select("doc_id", F.greatest(count("numbers"), count("lines")).alias("known_sentences"),
                       F.array_distinct(F.filter(F.concat("numbers", "lines"), lambda x: x > 0)).alias("seen"),
                       F.concat(listed("numbers"), listed("lines")).alias("sequence"))
    granted = F.create_map(*(x for n, license in grants.items() for x in (F.lit(n), F.lit(license))))
    ordered = [(license, tuple(number[s] for s in parts)) for license, parts in rules] + pairs
    by_first: dict[int, list] = {}
    for license, parts in ordered:
        by_first.setdefault(parts[0], []).append((license, parts))
    hits = [F.when(F.array_contains("seen", first), F.array_compact(F.array(*[
        F.when(F.col("sequence").contains("," + ",".join(map(str, parts)) + ","), F.lit(license)) for license, parts in group]))) for first, group in by_first.items()]
    found = F.concat(F.array_compact(F.transform("seen", lambda n: F.try_element_at(granted, n))), *(F.coalesce(h, F.array().cast("array<string>")) for h in hits))
    empty = F.lit("")
    return rows.select("doc_id", "known_sentences", F.when(F.size("seen") == 0, empty).otherwise(F.array_join(F.array_sort(F.array_distinct(found)), ",")).alias("licenses"))
