"""Mixing, syncmers, URL filters, licence scans and quality rules."""

import hashlib
import random
import re

import pytest
from brandlink.llm import licenses, mixing, quality, syncmers, urls
from cases import SCHEMA, SPACE_WORD, awkward_rows, frame, lower
from pyspark.sql import functions as F


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_mix_meets_targets(spark):
    rows = mixing.mix(frame(spark)).collect()
    assert len(rows) == len(awkward_rows())
    per = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        t = per.setdefault(r.source, [0, r.target, r.source_size, 0])
        t[0] += r.taken
        t[3] += r["size"]
    total = sum(t[2] for t in per.values())
    assert all(abs(t[0] - t[1]) <= 0.5 and t[1] <= 3 * t[2] + 1e-6 and t[3] == t[2] for t in per.values())
    assert abs(sum(t[1] for t in per.values()) - total) < 1e-6
    # water level: sources below their cap share by weight
    order = sorted((s for s in per if s is not None)) + [s for s in per if s is None]
    level = {per[s][1] / (5, 2, 1)[i % 3] for i, s in enumerate(order) if per[s][1] < 3 * per[s][2] - 1e-6}
    assert max(level) - min(level) < 1e-6
    again = sorted((r.doc_id or -1, r.taken) for r in mixing.mix(frame(spark)).collect())
    assert again == sorted((r.doc_id or -1, r.taken) for r in rows)


def test_mixed_documents_repeat_rows(spark):
    d = frame(spark, clashing=False)
    out = mixing.mixed_documents(d)
    assert out.columns == d.columns and out.count() > 0


def test_syncmers_edited_text(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    got = by_id(syncmers.fingerprint_documents(frame(spark, rows)))
    uniq = sorted({(r[0], r[1] or "") for r in rows}, reverse=True)
    for k, (i, t) in enumerate(uniq):
        head = uniq[(k + 1) % len(uniq)][1][:len(t) // 3]
        g = got[i][0]
        edited = t[:len(t) - len(t) // 3] + head
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
    assert got[1][0].fingerprint == got[2][0].fingerprint
    assert got[2][0].near_next == 1.0
    assert len(got[14]) == 2


def test_syncmers_are_context_free(spark):
    """An anchor of a passage is an anchor wherever the passage stands."""
    passage = " ".join(f"w{i * i}" for i in range(60))
    df = spark.createDataFrame([(1, passage), (2, "other words before " + passage + " and after")], "doc_id int, text string")
    got = (df.withColumn("u", syncmers.unit_hashes("text")).withColumn("a", syncmers.anchors("u"))
           .orderBy("doc_id").collect())
    a, b = got[0].a, got[1].a
    assert len(a) >= 60 // (syncmers.K - syncmers.S + 1) - 2
    assert any(b[i:i + len(a)] == a for i in range(len(b)))


def test_syncmers_of_short_texts(spark):
    """Every text with units has an anchor, so texts that share nothing are not alike."""
    rows = [(n * 100 + k, " ".join(f"w{n}x{k}x{j}" for j in range(n))) for n in range(9) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = df.withColumn("u", syncmers.unit_hashes("text")).withColumn("a", syncmers.anchors("u")).collect()
    assert all((len(r.a) > 0) == (len(r.u) > 0) for r in got)
    d = syncmers.with_sketch(df, "text", "f").where("doc_id between 500 and 699")
    pairs = d.selectExpr("doc_id i", "f a").crossJoin(d.selectExpr("doc_id k", "f b"))
    like = pairs.select("i", "k", syncmers.likeness("a", "b").alias("l")).collect()
    assert all(r.l == (1.0 if r.i == r.k else 0.0) for r in like)


def test_licences(spark):
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    import re
    rows = awkward_rows() + [
        (50, "X mit license MIT LICENSE, apache license general public license", "en", "a", 1),
        (51, "Licensed under the Apache License, Version 2.0.", "en", "a", 1),
        (52, "This work is licensed under the GNU General Public License, version 3.", "en", "a", 1),
        (53, "Licensed under the Apache Licence of nothing", "en", "a", 1)]
    got = by_id(licenses.scan_licenses(frame(spark, rows)))
    for i, text, *_ in rows:
        w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        at = [(k, n) for n, p in phrases.items() for k in range(len(w)) if w[k:k + len(p)] == p]
        for g in got[i]:
            assert (g.n_words, g.n_base) == (len(w), len(at)), i
            assert (g.first_word, g.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
            assert g.base_labels == ",".join(sorted({n for _, n in at}))
            assert 0 <= g.score <= 1
    assert got[51][0].labels == "Apache-2.0,apache" and got[52][0].labels == "GPL-3.0,gpl"
    assert got[13][0].labels == "MIT,mit" and got[53][0].labels == ""


def accepted_notices(text):
    """Labels of the notices that the comparison accepts at some place of a text."""
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    out = set()
    for t in licenses.NOTICES:
        for off in range(len(w)):
            there = w[off:off + len(t.words)]
            cover = sum(a == b for a, b in zip(t.words, there)) / len(t.words)
            if cover >= licenses.MIN_COVER and all(f" {k} " in f" {' '.join(there)} " for k in t.keys):
                out.add(t.label)
    return out


def test_edited_licences(spark):
    """A notice with as many other words as the comparison accepts is found,
    whichever words they are and however rare the others."""
    rng = random.Random(4)
    texts = ["Permission is hereby granted, free of charge, to every person obtaining a copy of this software "
             "and related documentation files"]
    for t in licenses.NOTICES:
        n = len(t.words)
        for m in range(max(k for k in range(n) if (n - k) / n >= licenses.MIN_COVER) + 2):
            for _ in range(4):
                w = list(t.words)
                for k in rng.sample(range(len(w)), m):
                    w[k] = f"other{k}"
                texts.append("before " * rng.randrange(3) + " ".join(w) + " after")
    # words of the notices that are frequent alone
    texts += ["this software is free and any person can copy or use the files"] * 9
    got = by_id(licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"),
                                       base=()))
    assert accepted_notices(texts[0]) == {"MIT"}
    for i, text in enumerate(texts):
        assert got[i][0].labels == ",".join(sorted(accepted_notices(text))), text


def test_quality_counts_and_verdicts(spark):
    rows = awkward_rows()
    got = by_id(quality.judge_quality(frame(spark, rows)))
    for i, text, *_ in rows:
        if i is None:
            continue
        t = text or ""
        w = SPACE_WORD.findall(t)
        windows = {}
        for k in range(len(w) - 4):
            windows.setdefault(tuple(w[k:k + 5]), []).append(k)
        covered = {x for v in windows.values() if len(v) > 1 for k in v for x in range(k, k + 5)}
        lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
        for g in got[i]:
            assert g.n_words == len(w) and g.word_chars == sum(map(len, w))
            assert g.n_symbols == sum(c in "#*$%&|<>" for c in t)
            assert g.n_dup_lines == len(lines) - len(set(lines)) and g.n_repeat_words == len(covered)
            assert g.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
            assert not (g.kept and g.base_failed)


def test_label_model_finds_accurate_rules():
    import random
    rng = random.Random(3)
    counts = {}
    for _ in range(4000):
        good = rng.random() < 0.8
        v = tuple((1 if good else -1) if rng.random() < acc else (-1 if good else 1) for acc in (0.95, 0.9, 0.6))
        counts[v] = counts.get(v, 0) + 1
    prior, tables = quality.fit_label_model(list(counts.items()))
    strength = [t[1][0] / t[1][1] for t in tables]
    assert 0.6 < prior < 0.95 and strength[0] > strength[1] > strength[2] >= 1
    assert quality.fit_label_model([])[0] == 0.5


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"), ("nothing", "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://Www.Example.com/en/a?x=1#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://blog.example.com/en/", "blog.example.com", "/en/", "example.com/en/", "block"),
    ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("https://a.net/es", "a.net", "/es", None, "allow"),
    ("https://com", "com", "", None, "allow"),
    ("https://a.org/casino/x", "a.org", "/casino/x", None, "block"),
    ("https://a.org/x?u=http://b.com/en/", "a.org", "/x", None, "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "clash")], "page_id int, url string, token string")
    r = urls.judge_urls(df.union(df)).collect()
    assert len(r) == 2 and (r[0].host, r[0].path, r[0].rule, r[0].verdict) == (host, path, rule, verdict)


def test_empty_tables(spark):
    d = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(d).count() == 0 and syncmers.fingerprint_documents(d).count() == 0
    assert licenses.scan_licenses(d).count() == 0 and quality.judge_quality(d).count() == 0
    assert urls.judge_urls(spark.createDataFrame([], "page_id int, url string")).count() == 0


def test_mixed_documents_without_ids_meet_their_targets(spark):
    """Null and repeated ids: rows are taken one by one, not by id."""
    rng = random.Random(4)
    rows = [(None if i % 3 else 7, " ".join(f"w{rng.randint(0, 99)}" for _ in range(10)), "en", "a" if i < 300 else "b", 1)
            for i in range(400)]
    d = frame(spark, rows).withColumn("_id", F.lit(1))
    got = {r.source: r.n for r in mixing.mixed_documents(d).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    want = {r.source: r.t for r in mixing.mix(d).groupBy("source").agg(F.max("target").alias("t")).collect()}
    assert all(abs(got[k] - want[k]) <= 10 for k in want)
    assert mixing.mixed_documents(d).columns == d.columns
