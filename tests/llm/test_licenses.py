from __future__ import annotations

import re
import time

from carelake.llm import licenses
from carelake.llm.license_rules import rules
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
RULES = [(r, re.compile(f"(?<= )(?:{r.pattern})(?= )")) for r in rules()]


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    norm = f" {' '.join(words)} "
    spans = [(m.start(), m.end(), r.rank, r.label, r.weight) for r, p in RULES for m in p.finditer(norm)]
    kept = [
        x for x in spans
        if not any(y[0] <= x[0] and x[1] <= y[1] and (y[2] < x[2] or (y[2] == x[2] and y[1] - y[0] > x[1] - x[0])) for y in spans)
    ]
    labels = {label for _, label in places} | {x[3] for x in kept}
    starts = [i for i, _ in places]
    score = max([x[4] for x in kept] + [licenses.BASE_WEIGHT] * bool(places), default=0.0)
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        sorted({label for _, label in places}), sorted(labels), score,
    )


def check(df):
    own = F.col("licenses")
    rows = licenses.scanned(df).select(
        "text", own["n_words"], F.size(own["base"]), F.array_min(own["base"]["place"]), F.array_max(own["base"]["place"]),
        own["base_labels"], own["labels"], own["score"],
    ).collect()
    for text, *found in rows:
        assert tuple(found) == brute(text), text
    return len(rows)


def test_driver_documents(documents):
    assert check(documents.select("doc_id", "text")) == documents.count()


def test_made_up_texts(spark):
    texts = [
        "MIT License mit license", "Licensed under the Apache License, Version 2.0.", "licensed under CC BY-NC-SA 4.0 International",
        None, "", "   ", ".x.", "x", "the GNU General Public License version 3 or General Public License", "All rights reserved. Copyright (c) 2020 X",
        "SPDX-License-Identifier: GPL-2.0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
        "É ÉÉ kK mIT LİCENSE", "mit license " * 200, "released under the Creative Commons Attribution-ShareAlike license 3.0",
        "a general public license; the lesser general public license v2.1", "see https://opensource.org/licenses/MIT for the text",
    ]
    assert check(spark.createDataFrame([(t, 1) for t in texts], "text string, licenses int")) == len(texts)


def test_suppression():
    assert brute("Licensed under the Apache License, Version 2.0")[5] == ["apache", "apache-2.0"]
    assert brute("CC BY-NC 4.0")[5] == ["cc-by-nc-4.0"]


def test_every_rule_is_gated():
    found = rules()
    assert len(found) > 300
    for rule in found:
        assert rule.keyword.strip() in rule.pattern
        assert any(word in rule.pattern for word in licenses.GATE), rule


def test_odd_rows(odd, nothing):
    assert licenses.scanned(odd).where("licenses.score > 0").count() == 0
    assert licenses.scanned(odd).count() == 12 and licenses.scanned(nothing).count() == 0


def test_time_grows_with_the_length_only(spark):
    line = "released under the mit license, apache license version 2.0 or gnu general public license v3. "
    spent = []
    for times in (3000, 6000):
        df = spark.createDataFrame([(line * times,)], "text string")
        start = time.perf_counter()
        row = licenses.scanned(df).select(F.size("licenses.detections").alias("n"), F.size("licenses.base").alias("b"), "licenses.labels").first()
        spent.append(time.perf_counter() - start)
        assert row.n >= 3 * times and row.b == 3 * times
    assert spent[1] < 3 * spent[0] + 5 and spent[1] < 60
    assert check(spark.createDataFrame([(line * 40,)], "text string")) == 1
