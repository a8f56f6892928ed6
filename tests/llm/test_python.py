"""MinHash, suffix arrays, language model, SentencePiece, toxicity, pipeline."""

import hashlib
import math
import os
import random
import tempfile
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from brandlink.llm import minhash, ngrams, pieces, suffixes, toxicity
from brandlink.llm.components import components
from brandlink.llm.eliasfano import EliasFano, Siblings, Writer
from brandlink.llm.packing import pack, unpack
from brandlink.session import ensure_checkpoint_dir
from cases import SCHEMA, SF, awkward_rows, frame, words
from pyspark.sql import functions as F


def near_model(rows, width, num, den):
    """Sets and components by brute force; rows with distinct ids."""
    sets = {}
    for i, text, *_ in rows:
        w = words(text)
        sets[i] = ({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width
                   else {tuple(w)} if w else set())
    par = {i: i for i in sets}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    par[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width, num", [(3, 85), (5, 80)])
def test_near_duplicates(spark, width, num):
    rng = random.Random(width)
    rows = [r for r in awkward_rows() if r[0] not in (None, 14)]
    base = [f"w{rng.randint(0, 500)}" for _ in range(200)]
    for i in range(60):  # chains: each copy changes a few words of another
        src = list(rng.choice([r[1].split() for r in rows if r[0] >= 200] or [base]))
        for _ in range(rng.randint(1, 5)):
            src[rng.randrange(len(src))] = f"n{rng.random()}"
        rows.append((200 + i, " ".join(src), "en", "a", 1))
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, rows), width, num, 100).collect()}
    want = near_model(rows, width, num, 100)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicates_ties_and_nulls(spark):
    rows = minhash.near_duplicates(frame(spark)).collect()
    assert len(rows) == len(awkward_rows())
    assert all(r.component_id == 14 and r.kept for r in rows if r.doc_id == 14)
    assert all(not r.kept for r in rows if r.doc_id is None)
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    v = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    sig = minhash.signatures([v[:2000], v[500:2500]], 256)
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(300)}}


@pytest.mark.parametrize("seed", range(8))
def test_collection_order(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("ab") for _ in range(300)).encode()
    segs = list({base[a:a + rng.randint(50, 120)] for a in [rng.randint(0, 180) for _ in range(40)]}
                | {bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(5)})
    docs = np.array([rng.randint(0, 50) for _ in segs])
    own, start, least = suffixes.window_least(segs, docs, tempfile.mkdtemp())
    low = {}
    for s, d in zip(segs, docs):
        for i in range(len(s) - 49):
            low[s[i:i + 50]] = min(low.get(s[i:i + 50], 10**9), int(d))
    assert list(zip(own.tolist(), start.tolist(), least.tolist())) == [
        (k, i, low[s[i:i + 50]]) for k, s in enumerate(segs) for i in range(len(s) - 49)]


def repeats_model(rows):
    first = {}
    for i, text, *_ in rows:
        b = (text or "").encode()
        for k in range(len(b) - 49) if i is not None else ():
            first[b[k:k + 50]] = min(first.get(b[k:k + 50], i), i)
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        cov = bytearray(len(b))
        for k in range(len(b) - 49) if i is not None else ():
            if first[b[k:k + 50]] < i:
                cov[k:k + 50] = b"\1" * 50
        kept = bytes(c for c, z in zip(b, cov) if not z)
        n = sum(1 for k in range(len(b)) if cov[k] and (k == 0 or not cov[k - 1]))
        out.append((i, len(b), sum(cov), n, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [False, True])
def test_repeats(spark, heavy, monkeypatch):
    """``heavy``: every anchor counts as one with very many segments."""
    if heavy:
        monkeypatch.setattr(suffixes, "GROUP", 1)
    rows = awkward_rows()
    got = suffixes.drop_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == repeats_model(rows)
    assert suffixes.drop_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_segments_without_a_common_window_stay_out_of_the_collection(monkeypatch):
    """An anchor alone does not bring a segment there; its own least doc_id is the answer."""
    rng = random.Random(7)
    noise = lambda n: bytes(rng.randrange(33, 127) for _ in range(n))
    anchor, same = noise(32), noise(18)
    segs = [noise(18) + anchor + noise(18) for _ in range(60)] + [noise(18) + anchor + same for _ in range(3)]
    pdf = pd.DataFrame({"anchor": range(63), "digest": 0, "segment": segs, "least": range(63), "most": 62})
    sizes, order = [], suffixes.collection_order
    monkeypatch.setattr(suffixes, "collection_order", lambda s, f: sizes.append(len(s)) or order(s, f))
    got = suffixes._collection(pdf).set_index("anchor")
    assert sizes == [3] and got.docs.loc[5].tolist() == [5] and got.lasts.loc[5].tolist() == [18]
    assert [got.docs.loc[k].tolist() for k in (60, 61)] == [[60], [61, 60]] and got.docs.loc[62].tolist() == [60]


def test_repeats_leave_one_table(spark):
    """Segments and their runs leave the disk before the documents move."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {x for x in os.listdir(folder) if x.startswith("llm-")}
    passage = "one passage of more than fifty bytes that two of the documents share "
    rows = [(1, "a " + passage + "b"), (2, "c " + passage + "d"), (3, "a " + passage + "b")]
    got = suffixes.removed_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {x for x in os.listdir(folder) if x.startswith("llm-")} - before
    assert {r.doc_id for r in got.collect()} == {2, 3} and len(left) == 1


def test_chance_meetings_leave_the_join():
    """Twenty equal bytes cannot hold a shared window: their texts share no anchor."""
    rng = random.Random(5)
    noise = lambda: bytes(rng.randrange(33, 127) for _ in range(40))
    texts = []
    for _ in range(2):
        texts.append(b"".join(noise() + b"twenty equal bytes__" for _ in range(50)).decode())
    t = suffixes._Texts(texts)
    h, owner, _, _ = suffixes.anchor_places(t.data, t.starts, t.lengths)
    assert not set(h[owner == 0].tolist()) & set(h[owner == 1].tolist())


def test_elias_fano(tmp_path):
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 5), (50, 60), (1000, 10**9), (5000, 5000), (3000, 40000)):
        v = np.sort(rng.integers(0, top, n))
        e = EliasFano(v, Writer(str(tmp_path / f"{n}-{top}")))
        assert not n or (e.get(np.arange(n)) == v).all()
        q = rng.integers(0, top + 10, 2000)
        at, same = e.successor(q)
        assert (at == np.searchsorted(v, q)).all() and (same == np.isin(q, v)).all()
    pairs = np.unique(rng.integers(0, 200, (500, 2)), axis=0)
    s = Siblings(pairs[:, 0], pairs[:, 1], 200, Writer(str(tmp_path / "s")))
    q = rng.integers(0, 200, (3000, 2))
    known = {tuple(p): k for k, p in enumerate(pairs)}
    assert s.find(q[:, 0], q[:, 1]).tolist() == [known.get(tuple(p), -1) for p in q]


def test_pack():
    for t in (np.uint8, np.int32, np.int64, np.uint64):
        a = np.arange(1000).astype(t)
        assert (unpack(pack(a), t) == a).all() and len(unpack(pack(a[:0]), t)) == 0


def test_scores(spark):
    rows = awkward_rows()
    got = {}
    for r in ngrams.score_documents(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    start = "<start>"
    trained = lambda i: zlib.crc32((str(i) if i is not None else "").encode()) % 7 != 2
    c, c2, c3 = Counter(), Counter(), Counter()
    for i, text, *_ in rows:
        if trained(i):
            t = [start, *words(text), ""]
            c.update(t[1:])
            c2.update(zip(t, t[1:]))
            c3.update(zip(t, t[1:], t[2:]))
    n, v = sum(c.values()), len(c)
    m2, m3 = ngrams.MU
    for i, text, *_ in rows:
        t = [start, *words(text), ""]
        base = score = 0.0
        for k in range(1, len(t)):
            p = (c[t[k]] + 1) / (n + v + 1)
            base += math.log10(p)
            p = (c2[t[k - 1], t[k]] + m2 * p) / ((c[""] if k == 1 else c[t[k - 1]]) + m2)
            if k > 1:
                p = (c3[t[k - 2], t[k - 1], t[k]] + m3 * p) / (c2[t[k - 2], t[k - 1]] + m3)
            score += math.log10(p)
        for r in got[i]:
            assert r.held_out == (not trained(i)) and r.train_tokens == n and r.n_tokens == len(t) - 1
            assert r.n_known == sum(c[x] > 0 for x in t[1:])
            assert abs(r.base_score - base) < 1e-6
            # two steps of the grid for each token, always down
            assert -2 * ngrams.STEP * (len(t) - 1) - 1e-6 <= r.score - score <= 1e-6
    assert ngrams.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    none = ngrams.score_documents(frame(spark, rows[:3]), F.lit(False)).collect()
    assert all(r.score == r.base_score == 0 and r.n_known == 0 for r in none)


def test_scores_of_unknown_words_in_known_contexts(spark):
    """The context's weight is paid whether its next word is known or not."""
    train = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 != 2][:1000]
    held = next(i for i in range(2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(i, "alpha beta gamma", "en", "a", 1) for i in train]
    rows += [(held, "alpha beta zzz", "en", "a", 1)]
    got = {r.doc_id: r.score for r in ngrams.score_documents(frame(spark, rows)).collect()}
    n, v, (m2, m3) = 4000, 4, ngrams.MU
    one = lambda c: (c + 1) / (n + v + 1)
    two = lambda c, h, p: (c + m2 * p) / (h + m2)
    three = lambda c, h, p: (c + m3 * p) / (h + m3)
    want = [two(1000, 1000, one(1000)), three(1000, 1000, two(1000, 1000, one(1000))),
            three(0, 1000, two(0, 1000, one(0))),            # zzz after alpha beta
            two(0, 0, one(1000))]                             # the end after zzz
    assert -2 * ngrams.STEP * 3 - 1e-9 <= got[held] - sum(map(math.log10, want)) <= 1e-9


def test_quantised_probabilities_are_never_above():
    p = 10.0 ** -np.random.default_rng(0).uniform(0, 40, 5000)
    v = ngrams.value(ngrams.quantise(p))
    assert (v <= p * (1 + 1e-12)).all() and (np.log10(p / v) <= ngrams.STEP + 1e-9).all()
    assert ngrams.quantise(np.array([0.0, 1.0])).tolist() == [0, 1]


def viterbi(word, table, best):
    k = word.replace(pieces.SPACE, "￿").replace(" ", pieces.SPACE)
    a = [(0.0, 0, 0)]
    for e in range(1, len(word) + 1):
        top = None
        for s in range(max(0, e - table.longest), e):
            x = best.get(k[s:e])
            if x is None and s != e - 1:
                continue
            v = a[s][0] + (x[1] if x else table.fallback)
            if top is None or v > top[0]:
                top = (v, s, x[0] if x else -1 - ord(word[s]))
        a.append(top)
    out, e = [], len(word)
    while e:
        out.append(a[e][2])
        e = a[e][1]
    return [i for v in out[::-1] for i in ([v] if v >= 0 else [table.bytes[b] for b in chr(-1 - v).encode()])]


def test_pieces(spark):
    rows = awkward_rows()
    out = pieces.encode_documents(frame(spark, rows))
    got = out.collect()
    table = pieces.PieceTable()
    best = {p: (i, s) for p, i, s in table.pieces}
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    for r in got:
        assert r.ids == [x for w in pieces._WORDS.findall(texts[r.doc_id]) for x in viterbi(w, table, best)]
        assert r.n_chars == len(texts[r.doc_id]) and r.n_pieces == len(r.ids)
    back = pieces.decode_pieces(out).select("doc_id", "decoded").collect()
    assert len(back) == len(rows) and all(r.decoded == texts[r.doc_id] for r in back)
    assert pieces.encode_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pieces_of_whole_texts(spark):
    """The best path of a text is that of a Viterbi over all of it: indentation,
    long runs without a space and unspaced scripts included."""
    rng = random.Random(9)
    some = "".join(chr(rng.choice((rng.randrange(0x3041, 0x30ff), rng.randrange(0x4e00, 0x5000)))) for _ in range(300))
    letters = "".join(rng.choice("abcdefghijklmnoprstuvwxyzABCDE0123456789+/") for _ in range(2000))
    words = ["function", "return", "value", "length", "prototype", "international", "(", ");", "{", "=>", "."]
    texts = ["x\n" + " " * 16 + "return value\n" + " " * 37 + "if (a):  \n" + " " * 100 + "end   ", letters,
             "see http://example.org/" + letters[:300] + "?q=" + letters[300:400] + ", then  " + some,
             "".join(rng.choice(words) for _ in range(400)), "#" * 75 + "=" * 130 + "\n\n   \n▁▁ ▁" + "-" * 60,
             "a" * 47 + "nd" + "international" * 30]
    got = {r.doc_id: r for r in pieces.encode_documents(
        spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    table = pieces.PieceTable()
    best = {p: (i, s) for p, i, s in table.pieces}
    for i, text in enumerate(texts):
        assert got[i].ids == viterbi(text, table, best), i
        assert got[i].round_trip


def test_pieces_fold_words_in_batches(spark):
    """Words of a batch are folded at once, as one by one; Spark joins and groups
    neither edges nor words (which spilled)."""
    rng = random.Random(4)
    words = {"".join(rng.choice("ab ehtén▁日\U0001f600") for _ in range(rng.randint(1, 60))) for _ in range(500)}
    words = sorted(w.encode() for w in words)
    table = pieces.PieceTable()
    best = {p: (i, s) for p, i, s in table.useful}
    rows = [(b, i, bytearray(w)) for b in (3, 7) for i, w in enumerate(words) if i % b]
    d = pieces.encode_words(spark.createDataFrame(rows, "block long, i int, word binary"), table)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    got = set()
    for r in d.collect():
        i, size, about, ids = (unpack(x, np.int32) for x in (r.words, r.sizes, r.about, r.ids))
        i, ends = np.cumsum(i), np.cumsum(size)
        for k, e, n, x in zip(i, ends, size, about):
            w = words[k].decode()
            path = pieces._best_path(w, best, table.longest, table.fallback)
            assert ids[e - n:e].tolist() == [x for v in path for x in (
                [v] if v >= 0 else [table.bytes[b] for b in chr(-1 - v).encode()])]
            assert x == 2 * len(w) + 1
            got.add((r.of, int(k)))
    assert got == {(b, i) for b, i, _ in rows}


def toxic_rows(n, seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            w[rng.randrange(30)] = rng.choice(["vilename", "Slurword."])
        rows.append((seed * 100_000 + i, " ".join(w), "en", "a", int(bad)))
    return rows


def test_toxicity_held_out(spark):
    train, test = toxic_rows(400, 1), toxic_rows(200, 2)
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in train] + [(-5, None, None), (1, 1, None)],
                                   "doc_id long, quality int, toxic int")
    d = frame(spark, train + test + awkward_rows())
    out = toxicity.judge_toxicity(d, labels)
    assert out.columns[:len(d.columns)] == d.columns
    got = {r.doc_id: r for r in out.collect()}
    right = sum(got[r[0]].is_toxic == bool(r[4]) for r in test)
    assert right >= 0.97 * len(test)
    assert not got[4].is_toxic and not got[5].is_toxic
    none = toxicity.judge_toxicity(d, labels.limit(0))
    assert none.where("is_toxic").count() == 0 and none.count() == d.count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(tempfile.mkdtemp(), name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns and 0 < docs.count() <= (3 * n)
    assert docs.where("not round_trip").count() == 0


def test_near_duplicate_stage_with_null_and_repeated_ids(spark):
    def near(name, k):
        return " ".join([f"{name}{j}" for j in range(80)] + [f"end{name}{k}"])
    texts = [(None, near("a", 0)), (None, near("a", 1)), (7, near("b", 0)), (7, near("b", 1)), (7, near("b", 1)),
             (1, near("c", 0)), (8, near("c", 1)), (8, "alone in its id"), (None, near("c", 2)),
             (9, None), (None, ""), (None, "  "), (3, near("d", 0)), (2, near("d", 1))]
    rows = [(i, t, "en", "a", 1) for i, t in texts]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(
        spark, spark.createDataFrame(rows, SCHEMA), SF).collect()]
    groups = [(i, t.split()[0]) for i, t in got if (t or "").strip()]
    assert sorted(groups, key=str) == sorted(
        [(None, "a0"), (7, "b0"), (1, "c0"), (8, "alone"), (2, "d0")], key=str)
    assert sorted((t for _, t in got if not (t or "").strip()), key=str) == ["", "  ", None]


def test_repeated_passage_stage_keeps_characters(spark):
    passage = "größere Übung für alle Schüler heißt Fußball und Käse "
    rows = [(1, passage * 2, "de", "a", 1), (2, "ä" + passage * 2 + "ü", "de", "a", 1), (3, "é kurz", "fr", "a", 1),
            (4, None, None, None, None)]
    out = {r.doc_id: r for r in corpus_pipeline.repeated_passage_stage(
        spark, spark.createDataFrame(rows, SCHEMA), SF).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "äü" and out[3].text == "é kurz" and out[4].text is None
    assert out[2].n_chars == 2


def test_toxicity_without_evidence(spark):
    """Labels that have nothing to do with the words, most of them toxic: the chain abstains."""
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(40)), "en", "a", 1) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(rng.random() < .6)) for i in range(200)], "doc_id long, quality int, toxic int")
    got = toxicity.judge_toxicity(frame(spark, rows), labels)
    assert got.where("is_toxic").count() == 0 and got.where("p_toxic is not null").count() == 0


def test_toxicity_leaves_the_documents_columns(spark):
    train = toxic_rows(200, 1)
    d = frame(spark, [r[:2] + ("en", "a", 1) for r in train]).withColumn("is_toxic", F.lit("mine"))
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in train], "doc_id long, quality int, toxic int")
    twice = labels.unionByName(labels.withColumn("toxic", F.lit(0)))  # the larger label counts
    got = toxicity.judge_toxicity(d, twice, prefix="out_")
    assert got.where("is_toxic = 'mine'").count() == len(train) and got.where("out_is_toxic").count() > 0


def test_near_duplicates_of_short_ids(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (None, "x y z w")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (None, None, False)}
