"""DuckDB SQL for the queries that SQL can express."""
from __future__ import annotations


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x20\x09-\x0D]+')" % (_UPPER, _LOWER)


def _near_duplicates(k: int, num: int, den: int = 100) -> str:
    return f"""
WITH RECURSIVE words AS (SELECT DISTINCT doc_id, {_WORDS} AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(list_slice(w, i, i + {k} - 1), ' ')) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d JOIN sets s ON s.doc_id = d.doc_id JOIN root r ON r.a = d.doc_id"""


_MIXING = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(CAST(doc_id AS VARCHAR)) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
  [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source),
l AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS cut FROM s),
f AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER w, 0))
  / ((SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER w, 0)) AS level, row_number() OVER (ORDER BY cut, source NULLS LAST) AS k
  FROM l WINDOW w AS (ORDER BY cut, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT arg_min(level, k) AS level FROM f WHERE level < cut),
t AS (SELECT source, source_size, CASE WHEN g.level IS NULL OR l.cut <= g.level THEN l.cap ELSE l.weight * g.level END AS target
  FROM l LEFT JOIN g ON true),
w AS (SELECT *, least(round(target)::BIGINT, 2 * source_size) AS want FROM t),
b AS (SELECT greatest(16, ceil(sum(want) / 1048576))::BIGINT AS words, sum(want)::BIGINT AS budget FROM w),
e AS (SELECT w.source, w.source_size, w.target, w.want, b.words, floor((sum(want) OVER o - want)::HUGEINT * 2147483648 // greatest(1, b.budget))::BIGINT AS lo,
  floor((sum(want) OVER o)::HUGEINT * 2147483648 // greatest(1, b.budget))::BIGINT AS hi,
  ceil(least(want, source_size) / b.words)::BIGINT AS blocks, ceil(greatest(0, want - source_size) / b.words)::BIGINT AS again
  FROM w, b WINDOW o AS (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING)),
drawn AS (SELECT i AS slot, (i * 1327217885) % 2147483648 AS point FROM range(0, (SELECT ceil(budget / words)::BIGINT FROM b)) r(i)),
slots AS (SELECT e.source, slot, row_number() OVER (PARTITION BY e.source ORDER BY slot) - 1 AS rank FROM drawn JOIN e ON point >= lo AND point < hi),
reached AS (SELECT e.source, count(s.slot) AS n FROM e LEFT JOIN slots s ON s.source IS NOT DISTINCT FROM e.source GROUP BY e.source),
upto AS (SELECT e.*, least(n * words, least(want, source_size)) AS once, least(greatest(0, n - blocks) * words, greatest(0, want - source_size)) AS twice
  FROM e JOIN reached r ON r.source IS NOT DISTINCT FROM e.source),
p AS (SELECT d.doc_id, d.size, u.*, (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN upto u ON d.source IS NOT DISTINCT FROM u.source),
f1 AS (SELECT doc_id, min(s.slot) AS first_slot FROM p JOIN slots s ON s.source IS NOT DISTINCT FROM p.source
  AND p.size > 0 AND ((s.rank = p.start // p.words AND p.start < p.once AND s.rank < p.blocks)
    OR (s.rank > p.start // p.words AND s.rank <= (p.start + p.size - 1) // p.words AND s.rank * p.words < p.once AND s.rank < p.blocks)
    OR (s.rank - p.blocks BETWEEN p.start // p.words AND (p.start + p.size - 1) // p.words AND greatest(p.start, (s.rank - p.blocks) * p.words) < p.twice AND s.rank >= p.blocks))
  GROUP BY doc_id)
SELECT p.doc_id, size, source_size, target,
  (greatest(0, least(start + size, once) - start) + greatest(0, least(start + size, twice) - start))::BIGINT AS taken, coalesce(first_slot, -1)::BIGINT AS first_slot
FROM p LEFT JOIN f1 ON f1.doc_id = p.doc_id"""

_EXACT = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k"""


def _url_rules() -> str:
    # the stated rules and the method's words, apart from the operator's own
    ordered = [("block", "example.org", "/en/1"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("allow", "org", "/")]
    words = "spam|adult|casino|free-bets|cheap-pills|ads-track"
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ordered]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ordered))
    listed = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ordered))
    return rf"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {listed} WHEN regexp_matches(host, '(^|[^a-z0-9])({words})([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END AS verdict FROM u"""


# the licenses' names and sentences once more, apart from the operator's own
_GRANTS = """
names(license, name) AS (
  SELECT 'CC-' || upper(replace(k.short, ' ', '-')) || '-' || replace(v.v, ' ', '.'), replace(replace(replace(f.f, '%s', k.short), '%l', k.long), '%v', v.v)
  FROM (VALUES ('by', 'attribution'), ('by sa', 'attribution sharealike'), ('by nc', 'attribution noncommercial'), ('by nd', 'attribution noderivatives'),
    ('by nc sa', 'attribution noncommercial sharealike'), ('by nc nd', 'attribution noncommercial noderivatives')) k(short, long),
    (VALUES ('2 0'), ('2 5'), ('3 0'), ('4 0')) v(v),
    (VALUES ('cc %s %v'), ('cc %s %v license'), ('creative commons %l %v'), ('creative commons %l %v license'), ('creative commons %l %v international license')) f(f)
  UNION ALL VALUES ('Apache-2.0', 'apache license 2 0'), ('Apache-2.0', 'apache 2 0 license'), ('Apache-2.0', 'apache 2 0'), ('Apache-2.0', 'apache software license 2 0'),
    ('MIT', 'mit license'), ('MIT', 'mit'), ('MIT', 'mit x11 license'), ('MIT', 'expat license'), ('ISC', 'isc license'), ('Zlib', 'zlib license'),
    ('BSL-1.0', 'boost software license 1 0'), ('EPL-2.0', 'eclipse public license 2 0'), ('EPL-2.0', 'epl 2 0'),
    ('BSD-2-Clause', 'bsd 2 clause license'), ('BSD-2-Clause', '2 clause bsd license'), ('BSD-2-Clause', 'simplified bsd license'),
    ('BSD-3-Clause', 'bsd 3 clause license'), ('BSD-3-Clause', '3 clause bsd license'), ('BSD-3-Clause', 'new bsd license'), ('BSD-3-Clause', 'modified bsd license'),
    ('GPL-2.0', 'gnu general public license 2'), ('GPL-2.0', 'gnu general public license 2 0'), ('GPL-2.0', 'gnu gpl 2'), ('GPL-2.0', 'gpl 2'), ('GPL-2.0', 'gplv2'),
    ('GPL-3.0', 'gnu general public license 3'), ('GPL-3.0', 'gnu general public license 3 0'), ('GPL-3.0', 'gnu gpl 3'), ('GPL-3.0', 'gpl 3'), ('GPL-3.0', 'gplv3'),
    ('LGPL-2.1', 'gnu lesser general public license 2 1'), ('LGPL-2.1', 'gnu lgpl 2 1'), ('LGPL-2.1', 'lgpl 2 1'),
    ('LGPL-3.0', 'gnu lesser general public license 3'), ('LGPL-3.0', 'gnu lgpl 3'), ('LGPL-3.0', 'lgpl 3'),
    ('AGPL-3.0', 'gnu affero general public license 3'), ('AGPL-3.0', 'gnu agpl 3'), ('AGPL-3.0', 'agpl 3'), ('MPL-2.0', 'mozilla public license 2 0'), ('MPL-2.0', 'mpl 2 0'),
    ('CC0-1.0', 'cc0 1 0'), ('CC0-1.0', 'cc0 1 0 universal'), ('CC0-1.0', 'cc0'), ('Unlicense', 'unlicense')),
grants(license, sentence) AS (SELECT license, 'licensed under ' || name FROM names UNION ALL SELECT license, name FROM names WHERE ends_with(name, 'license')
  UNION ALL SELECT license, 'the ' || name FROM names WHERE ends_with(name, 'license')
  UNION ALL VALUES ('CC0-1.0', 'to the extent possible under law the author has waived all copyright and related or neighboring rights to this work'),
    ('Unlicense', 'this is free and unencumbered software released into the public domain')),
ids(license, sentence) AS (SELECT license, name FROM names UNION SELECT license, replace(replace(lower(license), '-', ' '), '.', ' ') || e
  FROM names, (VALUES (''), (' only'), (' or later')) x(e)),
texts(number, sentence) AS (VALUES (1, 'licensed under apache license 2 0 the license'), (2, 'you may not use this file except in compliance with the license'),
  (3, 'you may obtain a copy of the license at'),
  (4, 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions'),
  (5, 'the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software'),
  (6, 'the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement'),
  (7, 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies'),
  (8, 'permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following'),
  (9, 'this program is free software'), (10, 'this library is free software'),
  (11, 'you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
  (12, 'you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation'),
  (13, 'you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation'),
  (14, 'either 2 of the license or at your option any later version'), (15, 'either 2 1 of the license or at your option any later version'),
  (16, 'either 3 of the license or at your option any later version'),
  (17, 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
  (18, 'redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer'),
  (19, 'redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution'),
  (20, 'this source code form is subject to the terms of the mozilla public license v'), (21, 'this source code form is subject to the terms of the mozilla public license 2 0'),
  (22, '2 0'), (23, 'spdx license identifier')),
chains(license, chain) AS (VALUES ('Apache-2.0', [1, 2]), ('Apache-2.0', [2, 3]), ('MIT', [4]), ('MIT', [5, 6]), ('ISC', [7]), ('BSL-1.0', [8]), ('GPL-2.0', [9, 11, 14]),
  ('GPL-3.0', [9, 11, 16]), ('AGPL-3.0', [9, 12, 16]), ('LGPL-2.1', [10, 13, 15]), ('LGPL-3.0', [10, 13, 16]), ('BSD', [18, 19]), ('BSD', [17]), ('MPL-2.0', [20, 22]), ('MPL-2.0', [21]))"""


def _licenses() -> str:
    verbs = "licensed|released|distributed|available|provided|published|shared"
    lead = (r"^(?:(?:this|the|our) )?(?:source code|file|program|work|software|project|code|library|package|module|document|content|repository|data|text|image|it) "
            r"(?:is|are) (?:also |hereby |made |being )*")
    clean = r"trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g'))"
    bare = f"CASE WHEN regexp_matches(s, '{lead}(?:{verbs}) under ') THEN regexp_replace(s, '{lead}', '') ELSE s END"
    grant = f"regexp_replace({bare}, '^(?:{verbs}) under (?:the terms of )?(?:the )?', 'licensed under ')"
    plain = rf"regexp_replace(regexp_replace({grant}, '\bversion ([0-9])', '\1', 'g'), '\bv([0-9])', '\1', 'g')"
    # DuckDB's patterns have no lookahead: ends are marked first, then split at the mark
    mark = (r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[.!?;:]+([\x20\x09-\x0D]|$)', chr(1) || '\1', 'g'), "
            r"'(\r?\n[\x20\x09*#/;>-]*)+(\r?\n)', chr(1) || '\2', 'g'), '[.!?;:]+([\x20\x09-\x0D]|$)', chr(1) || '\1', 'g'), "
            r"'\r?\n[\x20\x09*#/;>-]*(\(?[0-9]{1,2}[.)][\x20\x09])', chr(1) || '\1', 'g')")
    return rf"""
WITH {_GRANTS},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
pieces AS (SELECT r, 0 AS reading, string_split({mark}, chr(1)) AS parts FROM d
  UNION ALL SELECT r, 1, regexp_split_to_array(t, '[.!?;:]*(\r?\n)+|:[\x20\x09]+') FROM d),
each AS (SELECT r, reading, unnest(parts) AS x, generate_subscripts(parts, 1) AS pos FROM pieces),
cleaned AS (SELECT r, reading, pos, {clean} AS s FROM each),
normal AS (SELECT r, reading, row_number() OVER (PARTITION BY r, reading ORDER BY pos) AS pos, {plain} AS s FROM cleaned WHERE NOT regexp_matches(s, '^[0-9]{{0,2}}$')),
known AS (SELECT n.*, t.number FROM normal n LEFT JOIN texts t ON t.sentence = n.s),
hits AS (SELECT r, g.license FROM known k JOIN grants g ON g.sentence = k.s
  UNION SELECT a.r, i.license FROM known a JOIN known b ON a.number = 23 AND b.r = a.r AND b.reading = a.reading AND b.pos = a.pos + 1 JOIN ids i ON i.sentence = b.s
  UNION SELECT a.r, c.license FROM chains c JOIN known a ON a.number = c.chain[1] LEFT JOIN known b ON b.r = a.r AND b.reading = a.reading AND b.pos = a.pos + 1
    LEFT JOIN known e ON e.r = a.r AND e.reading = a.reading AND e.pos = a.pos + 2
    WHERE (len(c.chain) < 2 OR b.number = c.chain[2]) AND (len(c.chain) < 3 OR e.number = c.chain[3])),
counted AS (SELECT r, max(n) AS n FROM (SELECT r, reading, count(*) AS n FROM known k WHERE number IS NOT NULL OR s IN (SELECT sentence FROM grants)
  OR s IN (SELECT sentence FROM ids) GROUP BY r, reading) q GROUP BY r)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS known_sentences, coalesce((SELECT string_agg(license, ',' ORDER BY license) FROM hits h WHERE h.r = d.r), '') AS licenses
FROM d LEFT JOIN counted c ON c.r = d.r"""


_HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> p.own
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 3"""


ORACLE: dict[str, str] = {
    "op2_near_duplicates": _near_duplicates(3, 85),
    "op4_mixing": _MIXING,
    "op5_exact_duplicates": _EXACT,
    "op6_url_rules": _url_rules(),
    "op7_license_scan": _licenses(),
    "op12_hard_negatives": _HARD_NEGATIVES,
}
