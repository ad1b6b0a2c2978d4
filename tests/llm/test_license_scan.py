"""License scan: alignment against its definition, planted licenses, defined cases."""

import random
import re

from pyspark.sql import functions as F

from mercato.llm.license_scan import TEMPLATES, Scanner, _disjoint, license_scan, patience
from mercato.llm.queries import op4_license_scan


def test_patience_is_an_increasing_alignment_and_whole_on_equal_texts():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(25))] for _ in "xy")
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(patience(a, a)) == len(a)
        once = [w for w in a if a.count(w) == 1 and b.count(w) == 1]
        assert len(pairs) >= (1 if once else 0)


def test_damaged_notices_are_found_where_they_stand():
    rng, scan = random.Random(2), Scanner(TEMPLATES)
    for name, text in TEMPLATES.items():
        words = text.split()
        if len(words) > 14:
            words[len(words) // 2] = "changed"
        before, after = (" ".join(f"{rng.choice('xyz')}{rng.randrange(900)} the of" for _ in range(60)) for _ in "ab")
        body = f"{before}\n{' '.join(words)}\n{after} {' '.join(words).upper()}"
        hits = [h for h in scan.scan(body) if h[1] == name]
        assert len(hits) == 2
        got = body[hits[0][0] : hits[0][2]]
        assert re.sub(r"[\W_]+", " ", got).strip() == re.sub(r"[\W_]+", " ", " ".join(words)).strip()


def test_query_finds_planted_lines(spark):
    here = "/root/testdata/sf0.01"
    rows = op4_license_scan(spark, here).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{here}/documents.parquet").collect()}
    assert len(rows) == len(text)
    short = {k: v for k, v in TEMPLATES.items() if v in ("Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.")}
    for r in rows:
        for name, line in short.items():
            assert (name in r.licenses.split(",")) == (line in text[r.doc_id])
    assert any(r.n_licenses for r in rows)


def test_defined_cases(spark):
    df = spark.createDataFrame([(1, None), (None, ""), (2, "Released under the MIT License. " * 300), (2, "word " * 100000)], "doc_id long, text string").withColumn("_ROW", F.lit(1))
    rows = license_scan(df).collect()
    assert [len(r.licenses) for r in rows] == [0, 0, 300, 0]
    assert license_scan(df.limit(0)).count() == 0


def test_disjoint_hits_match_the_definition():
    rng = random.Random(3)
    for _ in range(200):
        hits = [(a := rng.randrange(60), a + rng.randrange(8), k) for k in range(40)]
        want = []
        for hit in hits:
            if all(hit[1] < a or hit[0] > b for a, b, _ in want):
                want.append(hit)
        assert _disjoint(hits) == sorted(want)


def test_many_licenses_in_one_text():
    line = "Released under the MIT License. "
    assert len(Scanner(TEMPLATES).scan(line * 20000)) == 20000


def names(text):
    return [h[1] for h in Scanner(TEMPLATES).scan(text)]


def test_kin_are_told_apart_and_short_lines_may_lack_a_word():
    for name, text in TEMPLATES.items():
        assert [(h[1], h[3]) for h in Scanner(TEMPLATES).scan(f"x y {text} z")] == [(name, 1.0)]
    notice = TEMPLATES["MIT-notice"]
    assert names(notice[: notice.index(", including")]) == []
    assert names(TEMPLATES["LGPL-2.1-notice"].replace("Lesser ", "Other ")) == []
    assert names("This work is licensed under a Creative Commons Attribution-Other 4.0 International License.") == []
    assert names("Released under MIT License.") == ["MIT"]
    assert names("Licensed under CC BY 4.0.") == []
