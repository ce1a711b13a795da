"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is whatever a name that contains a key word is set to (quoted: any
characters; from three on), the password of a connection string, a private key block, or an
unbroken run of at least ``_SHORTEST`` letters, digits and ``+/_=-`` that holds a
digit. The forest sees its length, character classes and transitions, coverage
by dictionary words, path-like surroundings and neighbouring words. It is
trained on labelled findings (same columns, with a label).
"""
from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwise.llm.common import table_text
from keepwise.session import ship_package

_SHORTEST = 12
_RUN = re.compile(rf"[A-Za-z0-9+/_=\-]{{{_SHORTEST},}}")
# fixed values: words that name a secret, forms that providers define, and values that stand for none
KEY_WORDS = frozenset("password passwd passphrase pwd secret token key apikey api_key access_key auth bearer credential credentials private pass pin".split())
PROVIDER = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_\-]{35}")
PLACEHOLDER = re.compile(r"(?i)x{3,}|\*{3,}|\.{3,}|<.*>|\$\{?.*|\{\{.*|%.*%|(?:your|my|the|some|new|old)[_ -].*|change.?me|example.*|none|null|nil|true|false|todo|tbd|redacted|string|required|optional")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NAME = r"(?<![A-Za-z0-9_])([A-Za-z_][A-Za-z0-9_.\-]{0,60})[\"']?[ \t]{0,3}(?:=>|:=|[=:])[ \t]{0,3}"
_ASSIGNED = re.compile(_NAME + r"[\"']?$")
_SET = re.compile(_NAME + r"(?:\"([^\"\n]{3,200})\"|'([^'\n]{3,200})'|([^\s\"'`,;(){}\[\]<>]{4,200}))")
_CONNECTION = re.compile(r"(?<![A-Za-z0-9+.\-])[A-Za-z][A-Za-z0-9+.\-]{1,20}://[^\s/:@\"']{0,80}:([^\s/@\"']{1,200})@")
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----(?:[^-]{0,8000}-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----)?")
_HARMLESS = re.compile(r"(?i)[0-9]+|[0-9]{1,4}(?:[-_/][0-9]{1,4}){2,}.*|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
_NAMED_NUMBERS = re.compile(r"(?:[A-Za-z]?[a-z]*[0-9]*|[A-Z]+[0-9]*)(?:[-_/=+]+(?:[A-Za-z]?[a-z]*[0-9]*|[A-Z]+[0-9]*))*")   # build-20240101-000123
_WORD = re.compile(r"[^\W\d_]+")
_KINDS = ("lower", "upper", "digit", "other")
FEATURES = (["length", "entropy", "dictionary", "path", "assigned", "named", "key_before", "key_after", "before_length", "after_length", "quoted"]
            + [f"{k}_share" for k in _KINDS] + [f"{a}_{b}" for a in _KINDS for b in _KINDS])
_AROUND = 64


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(value: str, before: str, after: str, dictionary: frozenset[str]) -> list[float]:
    """Feature vector of a candidate and the text around it, in the order of ``FEATURES``."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    moves = np.bincount([4 * a + b for a, b in zip(kinds, kinds[1:])], minlength=16) / max(1, n - 1)
    shares = np.bincount(kinds, minlength=4) / n
    known = sum(len(w) for w in _WORD.findall(value.lower()) if w in dictionary) / n
    left, right = _WORD.findall(before.lower()), _WORD.findall(after.lower())
    named = _ASSIGNED.search(before)
    path = ("://" in before[-16:]) + (before[-1:] in "/.\\" and before != "") + (after[:1] in "/.\\" and after != "") + value.count("/") / n
    return [math.log2(n), _entropy(value), known, float(path), float(named is not None), float(named is not None and names_secret(named[1])),
            float(any(w in KEY_WORDS for w in left[-2:])), float(any(w in KEY_WORDS for w in right[:1])),
            float(len(left[-1]) if left else 0), float(len(right[0]) if right else 0), float(before[-1:] in "\"'" and before != ""),
            *shares.tolist(), *moves.tolist()]


def _entropy(value: str) -> float:
    return -sum(c / len(value) * math.log2(c / len(value)) for c in (value.count(x) for x in set(value)))


def names_secret(name: str) -> bool:
    """A part of the name, or its last two run together, is a key word: db_password, apiKey, AWS_SECRET_ACCESS_KEY."""
    parts = [p.lower() for p in _PART.findall(name)]
    return any(p in KEY_WORDS for p in [*parts, "".join(parts[-2:])])


def label_of(kind: str, value: str, before: str, dictionary: frozenset[str] = frozenset()) -> int | None:
    """A finding's label where no person has labelled it; None where there is no evidence either way.

    1: private keys, passwords of connection strings, providers' forms, and values of some variety that a
    secret's name is set to, of any alphabet or case. 0: placeholders and dictionary words, numbers, dates, identifiers of fixed
    form, paths, and values made of dictionary words. None: what is set to a secret's name but plain, and
    random-looking runs without a name."""
    if kind in ("key", "connection") or PROVIDER.fullmatch(value):
        return 0 if kind == "connection" and PLACEHOLDER.fullmatch(value) else 1
    letters = [w for w in _WORD.findall(value.lower())]
    plain = sum(len(w) for w in letters if w in dictionary) / len(value)
    if kind == "set":
        if PLACEHOLDER.fullmatch(value) or plain > 0.5 or value.count(" ") > 2:
            return 0
        varied = len({_kind(c) for c in value}) > 1 or len(value) >= 16
        return 1 if varied and _entropy(value) * len(value) >= 14 else None
    if _HARMLESS.fullmatch(value) or _NAMED_NUMBERS.fullmatch(value) or plain > 0.3 or "://" in before[-16:] or before[-1:] in ("/", ".", "\\") or _entropy(value) < 3:
        return 0
    return None if sum(c.isdigit() for c in value) / len(value) > 0.15 else 0


def _found(text: str):
    """(kind, start, value, before, after) of every candidate, in order, none inside another."""
    spans = [("key", m.start(), m.end()) for m in _PEM.finditer(text)] if "PRIVATE KEY-----" in text else []
    if "://" in text:
        spans += [("connection", *m.span(1)) for m in _CONNECTION.finditer(text)]
    if "=" in text or ":" in text:
        spans += [("set", *m.span(m.lastindex)) for m in _SET.finditer(text) if names_secret(m[1])]
    for m in _RUN.finditer(text):
        start = m.start()
        if name := re.match(r"([A-Za-z_][A-Za-z_\-]*)=(?=.)", m[0]):  # the run swallowed "name="
            start += name.end()
        if any(c.isdigit() for c in text[start:m.end()]):
            spans.append(("run", start, m.end()))
    order = {"key": 0, "connection": 1, "set": 2, "run": 3}
    taken: list[tuple[int, int]] = []
    out = []
    for kind, start, end in sorted(spans, key=lambda s: (order[s[0]], s[1])):
        at = bisect.bisect(taken, (start, end))
        if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (start, end))
        out.append((kind, start, text[start:end], text[max(0, start - _AROUND):start], text[end:end + _AROUND]))
    return sorted(out, key=lambda c: c[1])


def _candidates(dictionary: frozenset[str]):
    def run(batches):
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, start, value, before, after in _found(text or ""):
                    for column, x in zip(rows, (doc_id, start, value, kind, features(value, before, after, dictionary), label_of(kind, value, before, dictionary))):
                        column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)],
                                             names=["doc_id", "start", "value", "kind", "features", "label"])
    return run


def find_candidates(docs: DataFrame, dictionary: frozenset[str] = frozenset(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every candidate of every whole text: doc_id, start (code point), value, kind, features, label.

    ``label`` is ``label_of`` (null: unknown); replace it where people have labelled findings.
    Null and empty texts have none; long texts are read whole, in batches of bounded bytes; where candidates overlap, a
    private key goes before a connection string's password, a set value and a run, else the first; repeated rows
    repeat; a null doc_id keeps its findings; other columns are ignored; an empty table has none."""
    ship_package(docs.sparkSession)
    return table_text(docs, id_col, text_col).mapInArrow(
        _candidates(dictionary), "doc_id long, start long, value string, kind string, features array<double>, label int")


def common_words(texts: DataFrame, text_col: str = "text", most: int = 2000, shortest: int = 3) -> frozenset[str]:
    """The dictionary: the ``most`` most frequent words of a bounded table such as the benchmark."""
    words = F.explode(F.split(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"[^\p{L}]+")).alias("w")
    top = texts.select(words).filter(F.length("w") >= shortest).groupBy("w").count().orderBy(F.desc("count"), "w").limit(most)
    return frozenset(r.w for r in top.collect())


def scan_secrets(findings: DataFrame, labelled: DataFrame, sample_rows: int = 20_000, trees: int = 30, depth: int = 6,
                 cut: float = 0.5) -> DataFrame:
    """findings without ``label`` and ``features``, + score and secret (score >= ``cut``).

    The forest is fitted on at most ``sample_rows`` labelled findings, in the order
    of a hash of the value and place, so that reruns agree. Null labels are left
    out. With labels of one class only, the score is that class; without labels,
    0.5. No finding gives an empty table.
    """
    sample = (labelled.filter("label is not null").select("features", F.col("label").cast("double").alias("label"),
                                                          F.xxhash64("value", "doc_id", "start").alias("order"))
              .orderBy("order", "label").limit(sample_rows).select(array_to_vector("features").alias("features"), "label"))
    classes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    plain = findings.drop("label")
    if len(classes) < 2:
        scored = plain.withColumn("score", F.lit(float(next(iter(classes), 0.5))))
    else:
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt").fit(sample)
        scored = (forest.transform(plain.withColumn("features", array_to_vector("features")))
                  .withColumn("score", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction"))
    return scored.drop("features").withColumn("secret", F.col("score") >= cut)
