"""Phrase mining, conversation repair, n-gram Jaccard join: brute-force models."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brandlink.llm import overlap, phrases, repair
from cases import CLASHING, SCHEMA, awkward_rows, frame, lower
from pyspark.sql import functions as F
from test_python import near_model

# ------------------------------------------------------------------ phrases


def phrase_model(rows, least, longest, top, share=100):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = {q for p, a in frequent.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                   for q in [p[i:i + k]] if 100 * a >= share * frequent[q]}
        kept = []
        for p, a in frequent.items():
            if p not in covered:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def talk(rng, n):
    vocab = ["the", "of", "New", "york", "naïve", "日本", "a", "b", "c", "new"]
    return [(i, "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "\x0b", "  "])
                        for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", None, "und", "fr"]), "s", 1)
            for i in range(n)]


@pytest.mark.parametrize("least, top, share", [(3, 2000, 100), (5, 7, 60)])
def test_phrases(spark, least, top, share):
    rows = awkward_rows() + talk(random.Random(least), 150)
    got = phrases.mine_phrases(frame(spark, rows), least=least, top=top, share=share)
    assert dict(got.dtypes) == dict(lang="string", phrase="string", **{k: "bigint" for k in "a l r n rank score".split()})
    assert sorted(tuple(r) for r in got.collect()) == phrase_model(rows, least, 5, top, share)


def test_phrases_of_nothing(spark):
    for rows in ([], [(1, None, None, None, None), (2, "", "en", "a", 1), (3, "one", "en", "a", 1), (4, "...", "en", "a", 1)]):
        assert phrases.mine_phrases(spark.createDataFrame(rows, SCHEMA), least=1).count() == 0


def test_very_long_text_of_one_phrase(spark):
    rows = [(1, "to be or " * 400_000, "en", "a", 1)]
    got = phrases.mine_phrases(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.phrase, r.a) for r in got if len(r.phrase.split()) == 5} == {
        ("to be or to be", 399_999), ("be or to be or", 399_999), ("or to be or to", 399_998)}
    assert all(r.n == 1_200_000 for r in got)


def test_tiles_dense_and_sorted_agree():
    rng = np.random.default_rng(1)
    codes, counts = rng.integers(0, 500, 4000), rng.integers(1, 9, 4000)
    dense, sparse = phrases.tile_counts(codes, counts, 500), phrases.tile_counts(codes, counts, 1 << 40)
    assert all((x == y).all() for x, y in zip(dense, sparse)) and dense[1].sum() == counts.sum()
    tiles = phrases._Tiles([0, 3, 40], 1000)
    a, b = rng.integers(0, 1000, 5000), rng.integers(0, 1000, 5000)
    tile, code = tiles.locate(a, b)
    for t in range(9):
        x, y = tiles.members(t, code[tile == t])
        assert (x == a[tile == t]).all() and (y == b[tile == t]).all() and (code[tile == t] < tiles.area(t)).all()


# ------------------------------------------------------------------- repair

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(turns):
    """(cost, audit, repaired) by Dijkstra over (cost, audit): turns of (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, audit, "\n".join(out)
        nxt = NEXT[state]
        name = {"u": "user", "a": "assistant"}[nxt]
        heapq.heappush(heap, (cost + 5, audit + "I", i, nxt, (*out, f"{name}:")))
        if i < len(turns):
            role, text, fault = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                if role[:1] == nxt or role[:1] == "s" and state == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, nxt, (*out, f"{name}:{text}")))


def repair_model(rows):
    shown = lambda x: " " if x is None else str(x)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text, mine = shown(role), shown(text), convs[conv]
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, judged, n = set(), [], Counter()
        for _, role, text in turns:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
            judged.append((role, text, fault))
            n[fault] += 1
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, text = cheapest(judged)
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


TURNS = "conv_id long, turn long, role string, text string"


def talks(rng):
    said = ["Yes.", "no", "Why? ", " ", "", "End!\n", "naïve 日本.", "tail. x", None, "...", "a.b\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
    rows = [(c, None if rng.random() < .05 else t, rng.choice(roles) if rng.random() < .3 else roles[t % 2],
             rng.choice(said) if rng.random() < .4 else f"Turn {c} {t}.")
            for c in range(150) for t in range(rng.randint(1, 11))]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (7, 2, "user", "Again."), (7, 2, "user", "Again.")]
    rows += [(900, t, "user" if t % 2 else "system", "word " * (t % 7) + ".") for t in range(300)]
    return rows + [(901, None, "user", "x."), (901, None, "assistant", "y.")]


def test_repair(spark):
    rows = talks(random.Random(3))
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("clash") for c in (*CLASHING, "pos", "conv", "rn", "at", "code")})
    got = repair.repaired(df)
    assert dict(got.dtypes) == dict(conv_id="bigint", audit="string", repaired_sha256="string", **{
        k: "bigint" for k in "gaps blank duplicate truncated illegal cost".split()})
    rows_got = got.collect()
    want = repair_model(rows)
    assert len(rows_got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in rows_got} == want


def test_repair_gives_a_legal_conversation(spark):
    rows = talks(random.Random(5))
    _, lines = repair.repair_conversations(repair.damage(spark.createDataFrame(rows, TURNS)))
    convs = defaultdict(str)
    for r in lines.orderBy("conv", "pos", "at").collect():
        convs[r.conv] += r.role[0]
    assert convs and all(re.fullmatch("(s?(ua)+)?", v) for v in convs.values())


def test_repair_of_nothing(spark):
    assert repair.repaired(spark.createDataFrame([], TURNS)).count() == 0


def test_search_is_optimal_and_linear_on_long_conversations():
    rng = random.Random(0)
    kinds = [None, "truncated", "blank"]
    for _ in range(2000):
        codes = bytes(rng.choice(range(12)) for _ in range(rng.randint(0, 8)))
        turns = [("?sua"[c & 3], "x", kinds[c >> 2]) for c in codes]
        assert repair.search(codes) == cheapest(turns)[:2]
    codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 4, 6, 7, 8]) for _ in range(100_000))
    cost, audit = repair.search(codes)
    assert cost == repair.suffix_bounds(codes)[0][0] and len(audit) >= len(codes)


# ------------------------------------------------------------------ overlap


def near_rows(rng):
    rows = [r for r in awkward_rows() if r[0] not in (None, 14)]
    base = [[f"w{rng.randint(0, 500)}" for _ in range(n)] for n in (8, 40, 200, 900)]
    for i in range(160):
        src = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(src) // 30))):
            src[rng.randrange(len(src))] = f"n{rng.random()}"
        rows.append((200 + i, " ".join(src[:len(src) - rng.randint(0, len(src) // 20)]), "en", "a", 1))
    shared = " ".join(base[2][:90])  # a passage that many unlike documents hold
    return rows + [(500 + i, shared + " " + " ".join(f"u{rng.random()}" for _ in range(60)), "en", "a", 1) for i in range(120)]


@pytest.mark.parametrize("width, num", [(4, 85), (2, 50)])
def test_jaccard_groups(spark, width, num):
    rows = near_rows(random.Random(width))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           overlap.jaccard_groups(frame(spark, rows), width, num, 100).collect()}
    assert got == near_model(rows, width, num, 100)


def test_jaccard_groups_ties_and_nulls(spark):
    rows = overlap.jaccard_groups(frame(spark)).collect()
    assert len(rows) == len(awkward_rows())
    assert all(r.component_id == 14 for r in rows if r.doc_id == 14)
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert overlap.jaccard_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    small = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id int, text string")
    assert {r.component_id for r in overlap.jaccard_groups(small).collect()} == {1}


def test_likely_keeps_all_partners(spark):
    keys = spark.range(0, 5000, 7).selectExpr("cast(id as string) as k")
    got = {int(r.k) for r in overlap.likely(spark.range(5000).selectExpr("cast(id as string) as k"), "k", keys).collect()}
    assert set(range(0, 5000, 7)) <= got and len(got) < 5000 / 7 + 20
    assert overlap.likely(keys, "k", keys.limit(0)).count() == 0


@pytest.mark.parametrize("num", [50, 85, 95])
def test_linked_sets_share_a_key(num):
    """Also where all differences fall where they hurt most: the first groups."""
    rng = np.random.default_rng(num)
    classes = overlap.SizeClasses(num, 100)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        most = (100 - num) * 2 * len(a) // (100 + num)
        cut = int(rng.integers(0, most + 1))
        b = a[cut:] if rng.random() < .5 else np.sort(rng.permutation(a)[cut:])
        b = np.unique(np.append(b, rng.integers(0, 2**62 if rng.random() < .5 else 2**64, most - cut, dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if len(b) and both * (100 + num) >= num * (len(a) + len(b)) and not np.array_equal(a, b):
            assert np.intersect1d(overlap.group_keys(a, classes), overlap.group_keys(b, classes)).size


def test_tree_meets_every_pair_that_can_link(spark):
    """One family of 700 sets in many labels, small boxes on several levels."""
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (60, 100, 300)]
    sets = []
    for i in range(700):
        s = base[i % 3]
        sets.append(np.unique(np.append(s[rng.random(len(s)) > rng.random() * .3], rng.integers(0, 2**64, 4, dtype=np.uint64))))
    label = [bytes([i % 5]) for i in range(700)]
    name = [i.to_bytes(16, "big") for i in range(700)]
    points = np.array([overlap.point(s) for s in sets])
    df = spark.createDataFrame(
        [(b"f", n, v, len(s), overlap.coarse(p).tolist(), overlap._shut(p)) for n, v, s, p in zip(name, label, sets, points)],
        "comp binary, cls binary, label binary, n int, box array<int>, point binary")
    levels = overlap.build_tree(df)
    need = {}
    for r in overlap.tree_members(levels, 85, 100).collect():
        need.setdefault((r.x, r.y), set()).add(bytes(r.cls))
    at = {bytes(s.cls): r.id for r in levels[0].collect() for s in r.sets}
    want = set()
    for i in range(700):
        bound = np.minimum(points[i], points).sum(axis=1)
        for j in range(i + 1, 700):
            x, y = len(sets[i]), len(sets[j])
            if label[i] != label[j] and bound[j] * 185 >= 85 * (x + y) and min(x, y) * 100 >= max(x, y) * 85:
                want.add((name[i], name[j]))
    # every pair that can link meets in its pair of leaves, and nothing else is asked for
    assert want and all({a, b} <= need[tuple(sorted((at[a], at[b])))] for a, b in want)
    assert {c for v in need.values() for c in v} == {c for p in want for c in p}
    # the links join the labels exactly as all links do
    items = spark.createDataFrame([(n, overlap._zip(s)) for n, s in zip(name, sets)], "cls binary, items binary")
    links = [(bytes(r.a), bytes(r.b)) for r in overlap.tree_links(levels, items, 85, 100).collect()]
    of = dict(zip(name, label))
    linked = {(of[a], of[b]) for a, b in want for x, y in [(sets[name.index(a)], sets[name.index(b)])]
              if len(np.intersect1d(x, y)) * 185 >= 85 * (len(x) + len(y))}

    def parts(edges):
        top = {x: x for x in set(label)}
        for a, b in edges:
            a, b = top[a], top[b]
            top = {k: min(a, b) if v in (a, b) else v for k, v in top.items()}
        return top
    assert parts((of[a], of[b]) for a, b in links) == parts(linked) and len(links) < 200
