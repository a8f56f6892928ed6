"""LM scoring with Elias-Fano n-gram tries.

A trigram model with Dirichlet smoothing: p(w | h) = (c(hw) + mu p(w | h')) /
(c(h) + mu), down to the additive unigram.  It is stored in interpolated form:
every bigram and trigram keeps c(hw) / (c(h) + mu), every trigram context its
weight mu / (c(h) + mu), as a step of a fixed grid in two bytes.

Documents are coded in blocks.  Each block counts its n-grams and sends them to
buckets by context (a frequent context is split further by the next word, and
its total goes to all its parts).  A bucket adds the counts up, writes the
bucket's trie into a memory-mapped file and answers the n-grams of every block
from it.  The last word of a trigram is stored relative to its context, as its
rank among the successors of the middle word (context-relative ids).  Nothing
of the model passes through the driver but the numbers of tokens and words.
"""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import block_words, code_blocks
from .common import release, shuffle_parts, staged
from .eliasfano import Siblings, Writer
from .packing import mix64, pack, pack_small, runs, unpack, unpack_small

MU = (200.0, 20.0)     # smoothing of bigrams and trigrams
STEP = 0.03            # log10 step of a quantised probability
TOTAL = -1             # stands for the word in the row of a split context's total


def quantise(p: np.ndarray) -> np.ndarray:
    """0 for nothing, else 1 + the steps below 1 (rounded down to a smaller
    probability, so quantised distributions never sum to more than one).  Two
    bytes reach down to 10^-1966, below what any count can give."""
    with np.errstate(divide="ignore"):
        k = np.ceil(np.round(-np.log10(p) / STEP, 9))
    return np.where(p > 0, k + 1, 0).astype(np.uint16)


def value(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-STEP * (code.astype(float) - 1)), 0.0)


def _tokens():
    def tokens(text):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        words.append(b"")  # the end of the text
        return words
    return tokens


class _Coded:
    """A block's tokens with their corpus counts and word numbers."""

    def __init__(self, lengths: bytes, codes: bytes, flags, gid: np.ndarray, count: np.ndarray,
                 words: int):
        self.lengths = unpack(lengths, np.int32).astype(np.int64)
        # words are renumbered in the order of their corpus numbers, so sorted
        # n-grams have small steps
        order = np.argsort(gid)
        number = np.empty(len(gid), np.int64)
        number[order] = np.arange(len(gid))
        self.w = number[unpack(codes, np.int32)]
        self.trained = np.repeat(np.asarray(flags, bool), self.lengths)
        gid, count = gid[order], count[order]
        self.gid, self.count = gid, count                # by the new number
        self.size = len(gid)
        at = runs(self.lengths)
        start = self.size                                # number of the start mark
        self.b = np.concatenate([[start], self.w[:-1]])
        self.b[at == 0] = start
        self.a = np.concatenate([[start], self.b[:-1]])
        self.a[at == 0] = -1                             # no word before the start mark
        # the start mark counts once for each training text, like the end
        end = count[self.w[-1]] if len(self.w) else 0
        # the start mark comes after all words; then one mark for all unknown words
        self.gid2 = np.concatenate([gid, [words, words + 1]])
        self.count2 = np.concatenate([count, [end, 0]])

    def _unique(self, key: np.ndarray):
        order = np.argsort(key)
        s = key[order]
        first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.empty(0, bool)
        return order, first

    def grams(self, order: int):
        """Distinct n-grams: (a, b, w) by block number, the training count, and
        for each token its n-gram (-1: none).  Words of the context are known
        ones; an unknown last word asks for a trigram context's weight."""
        known = self.count2[self.w] > 0
        ok = self.count2[self.b] > 0
        if order == 3:
            ok &= self.a >= 0
            ok[ok] = self.count2[self.a[ok]] > 0
        else:
            ok &= known
        last = np.where(known, self.w, self.size + 1)
        tok = np.flatnonzero(ok)
        n = self.size + 2
        key = self.b[tok] * n + last[tok]
        if order == 3:
            o, first = self._unique(self.b[tok] * n + self.a[tok])
            ctx = np.empty(len(tok), np.int64)
            ctx[o] = np.cumsum(first) - 1
            key = ctx * n + last[tok]
        o, first = self._unique(key)
        which = np.cumsum(first) - 1
        count = np.bincount(which, self.trained[tok][o], minlength=int(first.sum())).astype(np.int64)
        rep = tok[o[first]]
        gram = np.full(len(self.w), -1, np.int64)
        gram[tok[o]] = which
        a = self.a[rep] if order == 3 else np.full(len(rep), -1, np.int64)
        return a, self.b[rep], last[rep], count, gram

    def route(self, order: int, a, b, w, buckets: int, total: int):
        """Bucket of each n-gram, parts of its context and part number."""
        most = self.count2[b] if order == 2 else np.minimum(self.count2[b], self.count2[a])
        parts = np.maximum(1, -(-(most * buckets) // max(total, 1)))
        h = mix64((self.gid2[b] + 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if order == 3:
            h = mix64(h + (self.gid2[a] + 3).astype(np.uint64))
        hw = mix64((self.gid2[w] + 3).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        return h, parts, (hw % parts.astype(np.uint64)).astype(np.int64)


def _bucket(h: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
    return ((h + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)


_ASKS = "family int, bucket int, block long, n int, a binary, b binary, w binary, c binary, cb binary"


def _coded(row: dict, words: int) -> _Coded:
    return _Coded(row["lengths"], row["codes"], row["flags"], unpack_small(row["gid"]),
                  unpack_small(row["count"]), words)


def _ordered(c: _Coded, order: int, buckets: int, total: int):
    """The n-grams of a block in the order in which its buckets get them."""
    a, b, w, count, gram = c.grams(order)
    h, parts, part = c.route(order, a, b, w, buckets, total)
    to = _bucket(h, part, buckets)
    perm = np.argsort(to, kind="stable")
    return a, b, w, count, gram, h, parts, to, perm


def _ask(order: int, buckets: int, total: int, words: int):
    names = [c.split()[0] for c in _ASKS.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _coded(row, words)
                a, b, w, count, _, h, parts, to, perm = _ordered(c, order, buckets, total)
                ga = np.where(a >= 0, c.gid2[a], 0)
                cols = [ga, c.gid2[b], c.gid2[w], count, c.count2[b]]
                cols = [x[perm] for x in cols]
                sent = to[perm]
                n_real = np.bincount(sent, minlength=buckets)
                if order == 3 and (parts > 1).any():
                    # the block's total of a split context, to each of its parts
                    split = np.flatnonzero(parts > 1)
                    key = np.stack([b[split], a[split]])
                    u, first, inv = np.unique(key, axis=1, return_index=True, return_inverse=True)
                    tot = np.bincount(inv.ravel(), count[split]).astype(np.int64)
                    k = parts[split][first]
                    rep = np.repeat(np.arange(len(k)), k)
                    p = runs(k)
                    dest = _bucket(h[split][first][rep], p, buckets)
                    more = [c.gid2[u[1]][rep], c.gid2[u[0]][rep], np.full(len(rep), TOTAL), tot[rep],
                            c.count2[u[0]][rep]]
                    cols = [np.concatenate([x, y]) for x, y in zip(cols, more)]
                    sent = np.concatenate([sent, dest])
                    o = np.argsort(sent, kind="stable")
                    cols, sent = [x[o] for x in cols], sent[o]
                cut = np.searchsorted(sent, np.arange(buckets + 1))
                out = []
                for i in range(buckets):
                    x, y = cut[i], cut[i + 1]
                    if y > x:
                        part = [v[x:y] for v in cols]
                        out.append((order, i, row["block"], int(n_real[i]),
                                    pack_small(part[0]) if order == 3 else b"",
                                    pack_small(np.diff(part[1], prepend=0)),
                                    pack_small(part[2]), pack_small(part[3]),
                                    pack_small(part[4]) if order == 2 else b""))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(zip(*out), _ASK_TYPES)], names)
    return run


_ASK_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 5


def _numbered(a: np.ndarray):
    """Distinct values of an array in order, and each item's number."""
    new = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
    at = np.zeros(len(a), np.int64)
    at[new[1:]] = 1
    return a[new], np.cumsum(at)


class Trie:
    """Bigrams or trigrams of a bucket: middle words, their successors, and for
    order 3 the contexts (middle, first word) with successors by rank.  The
    n-grams come in the order (b, a, w)."""

    def __init__(self, order: int, b, a, w, p, weight, path: str):
        self.file = Writer(path)
        self.order = order
        self.middle, mid = _numbered(b)               # b is in order
        self.words = np.unique(w)
        wid = np.searchsorted(self.words, w)
        n = max(len(self.words), 1)
        pair = mid * n + wid
        pair = np.unique(pair) if order == 3 else pair  # in order, each once
        self.next = Siblings(pair // n, pair % n, len(self.middle), self.file)
        if order == 3:
            self.firsts = np.unique(a)
            f = max(len(self.firsts), 1)
            ctx, at = _numbered(mid * f + np.searchsorted(self.firsts, a))
            self.contexts = Siblings(ctx // f, ctx % f, len(self.middle), self.file)
            # ranks among the middle word's successors, in the order of the words
            rank = self.next.rank(mid, wid)
            self.third = Siblings(at, rank, len(ctx), self.file)
            first = np.flatnonzero(np.diff(at, prepend=-1))
            self.weights = self.file.add(quantise(weight[first]))
        self.codes = self.file.add(quantise(p))

    @staticmethod
    def _place(known: np.ndarray, x: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, x)
        at[at == len(known)] = 0
        return np.where(known[at] == x, at, -1) if len(known) else np.full(len(x), -1)

    def search(self, b, a, w):
        """(probability code, context weight code) of each n-gram; 0: absent."""
        code, weight = np.zeros(len(b), np.uint16), np.zeros(len(b), np.uint16)
        mid, wid = self._place(self.middle, b), self._place(self.words, w)
        if self.order == 2:
            ok = np.flatnonzero((mid >= 0) & (wid >= 0))
            at = self.next.find(mid[ok], wid[ok])
            code[ok[at >= 0]] = self.file.map(self.codes)[at[at >= 0]]
            return code, weight
        ok = np.flatnonzero(mid >= 0)
        fid = self._place(self.firsts, a[ok])
        ok, fid = ok[fid >= 0], fid[fid >= 0]
        ctx = self.contexts.find(mid[ok], fid)
        ok, ctx = ok[ctx >= 0], ctx[ctx >= 0]
        weight[ok] = self.file.map(self.weights)[ctx]
        has = wid[ok] >= 0
        ok, ctx = ok[has], ctx[has]
        rank = self.next.rank(mid[ok], wid[ok])
        ok, ctx, rank = ok[rank >= 0], ctx[rank >= 0], rank[rank >= 0]
        at = self.third.find(ctx, rank)
        code[ok[at >= 0]] = self.file.map(self.codes)[at[at >= 0]]
        return code, weight


def _merge_order(b: np.ndarray, a: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Order by (b, a, w): numbers below 2^31 go into one key in two steps, the
    context and then the context's rank with the word."""
    if len(b) and max(int(x.max()) for x in (a, b, w)) >= 1 << 31:
        return np.lexsort((w, a, b))
    context = (b << 32) + a + 1
    known = np.unique(context)
    return np.argsort((np.searchsorted(known, context) << 32) + w + 1, kind="stable")


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    order = int(pdf["family"].iloc[0])
    n = pdf["n"].to_numpy()
    parts = []
    for a, b, w, c, cb in zip(pdf["a"], pdf["b"], pdf["w"], pdf["c"], pdf["cb"]):
        b = np.cumsum(unpack_small(b))
        parts.append((unpack_small(a) if order == 3 else np.zeros(len(b), np.int64), b, unpack_small(w),
                      unpack_small(c), unpack_small(cb) if order == 2 else np.zeros(len(b), np.int64)))
    a, b, w, c, cb = (np.concatenate(x) for x in zip(*parts))
    size = np.array([len(p[1]) for p in parts])
    del parts
    real = runs(size) < np.repeat(n, size)
    # contexts, then n-grams, numbered in the order (b, a, w); each block's part
    # is a sorted run, which a stable sort of one key merges
    o = _merge_order(b, a, w)
    a, b, w, c, cb, real = a[o], b[o], w[o], c[o], cb[o], real[o]
    new_ctx = np.concatenate([[True], (b[1:] != b[:-1]) | (a[1:] != a[:-1])])
    new = new_ctx | np.concatenate([[True], w[1:] != w[:-1]])
    gram = np.cumsum(new) - 1
    ctx = np.cumsum(new_ctx) - 1
    count = np.bincount(gram, c)
    at = np.flatnonzero(new)
    ua, ub, uw, uctx = a[at], b[at], w[at], ctx[at]
    if order == 2:
        whole, mu = cb[at].astype(float), MU[0]
    else:
        told = np.bincount(ctx, np.where(w == TOTAL, c, 0))
        split = np.bincount(ctx, w == TOTAL) > 0
        whole = np.where(split, told, np.bincount(ctx, c))[uctx]
        mu = MU[1]
    p, weight = count / (whole + mu), mu / (whole + mu)
    folder = tempfile.mkdtemp(prefix="trie-")
    try:
        # a known context without a known successor here still has its weight
        kept = np.flatnonzero((uw != TOTAL) & (count > 0))
        lone = np.flatnonzero((uw == TOTAL) & (whole > 0)) if order == 3 else kept[:0]
        lone_w = np.zeros(len(ub), np.uint16)
        trie = Trie(order, ub[kept], ua[kept], uw[kept], p[kept], weight[kept], os.path.join(folder, "levels"))
        code, wcode = trie.search(ub, ua, uw)
        if len(lone):  # weights of split contexts, for n-grams that this part hasn't seen
            by_ctx = np.zeros(int(ctx[-1]) + 1, np.uint16)
            by_ctx[uctx[lone]] = quantise(weight[lone])
            lone_w = by_ctx[uctx]
        wcode = np.maximum(wcode, lone_w)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    back = np.empty(len(o), np.int64)
    back[o] = gram
    out, end = [], np.cumsum(size)
    for block, e, s, k in zip(pdf["block"], end, size, n):
        g = back[e - s:e - s + k]
        out.append((order, block, int(pdf["bucket"].iloc[0]), pack(code[g]), pack(wcode[g]) if order == 3 else b""))
    return pd.DataFrame(out, columns=["family", "block", "bucket", "code", "weight"])


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(buckets: int, total: int, words: int):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in left.to_dict("records"):
            c = _coded(row, words)
            p1 = (c.count + 1.0) / (total + (words + 1.0))
            base = np.log10(p1)[c.w]
            p = p1[c.w]
            # bigrams, for every token whose word before is known
            for order in (2, 3):
                a, b, w, _, gram, h, parts, to, perm = _ordered(c, order, buckets, total)
                code, weight = np.zeros(len(b), np.uint16), np.zeros(len(b), np.uint16)
                cut = np.searchsorted(to[perm], np.arange(buckets + 1))
                mine = right[right["family"] == order]
                for i, x, y in zip(mine["bucket"], mine["code"], mine["weight"]):
                    at = perm[cut[i]:cut[i + 1]]
                    code[at] = unpack(x, np.uint16)
                    if order == 3:
                        weight[at] = unpack(y, np.uint16)
                if order == 2:
                    whole = c.count2[c.b].astype(float)
                    p = p * (MU[0] / (whole + MU[0]))
                    ok = gram >= 0
                    p[ok] += value(code[gram[ok]])
                else:
                    ok = np.flatnonzero(gram >= 0)
                    g = gram[ok]
                    p[ok] = value(code[g]) + np.where(weight[g] > 0, value(weight[g]), 1.0) * p[ok]
            starts = np.cumsum(c.lengths) - c.lengths
            sums = [np.add.reduceat(v, starts) for v in
                    (base, np.log10(p), (c.count[c.w] > 0).astype(np.int64))]
            rows.append(pd.DataFrame({
                "doc_id": pd.array([None if i is None or i != i else int(i) for i in row["ids"]], "Int64"),
                "held_out": ~np.asarray(row["flags"], bool), "n_tokens": c.lengths,
                "n_known": sums[2], "base_score": sums[0], "score": sums[1]}))
        return pd.concat(rows) if rows else pd.DataFrame(columns=[x.split()[0] for x in _SCORES.split(", ")])
    return run


def _joined(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Block rows with the numbers and counts of their words."""
    if left.empty:
        return pd.DataFrame(columns=["block", "ids", "flags", "lengths", "codes", "gid", "count"])
    n = int(left["n"].iloc[0])
    gid, count = np.full(n, -2, np.int64), np.zeros(n, np.int64)
    i = right["i"].to_numpy()
    gid[i], count[i] = right["gid"].to_numpy(), right["count"].to_numpy()
    out = left[["block", "ids", "flags", "lengths", "codes"]].copy()
    out["gid"], out["count"] = [pack_small(gid)], [pack_small(count)]
    return out


def _train_counts(batches):
    """``block, i, word, c`` rows: training occurrences of a block's words."""
    for batch in batches:
        for row in batch.to_pylist():
            lengths = unpack(row["lengths"], np.int32)
            keep = np.repeat(np.asarray(row["flags"], bool), lengths)
            c = np.bincount(unpack(row["codes"], np.int32)[keep], minlength=len(row["words"]))
            n = len(c)
            for at in range(0, n, 50_000):
                k = min(50_000, n - at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, row["block"])), pa.array(np.arange(at, at + k, dtype=np.int32)),
                     pa.array(row["words"][at:at + k], pa.binary()), pa.array(c[at:at + k].astype(np.int64))],
                    ["block", "i", "word", "c"])


def score_documents(docs: DataFrame, trained=None) -> DataFrame:
    """Per input row ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``.

    ``trained``: boolean column, by default crc32 of the id modulo 7 is not 2.
    Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end.
    ``base_score`` sums log10 of the additive unigram, ``score`` of the model.
    A null or blank text is its end alone.  A null doc_id is hashed as an empty
    text.  Without training texts every probability is that of the empty
    unigram.  Repeated rows count and are scored each; an empty table gives no
    rows.
    """
    buckets = shuffle_parts(docs.sparkSession)
    if trained is None:
        trained = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
    blocks = code_blocks(docs, _tokens, trained)
    local = blocks.select("block", "flags", "lengths", "codes", "words").mapInArrow(
        _train_counts, "block long, i int, word binary, c long")
    vocabulary = staged(local.where("c > 0").groupBy("word").agg(F.sum("c").alias("count"))
                        .withColumn("_n", F.monotonically_increasing_id()))
    words, total = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    # dense numbers: the rows of the partitions before, one row per partition
    part = F.shiftright("_n", 33)
    sizes = vocabulary.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_k"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_b"))
    numbered = vocabulary.join(F.broadcast(sizes), part == F.col("_p")).select(
        "word", "count", (F.col("_b") + F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))).alias("gid"))
    known = block_words(blocks).join(numbered, "word").select(
        F.col("block").alias("of"), "i", "gid", "count")
    head = blocks.select("block", "ids", "flags", "lengths", "codes", F.size("words").alias("n"))
    coded = staged(head.groupBy("block").cogroup(known.groupBy("of")).applyInPandas(
        _joined, "block long, ids array<bigint>, flags array<boolean>, lengths binary, codes binary, "
                 "gid binary, count binary"))
    release(blocks, vocabulary)
    # one order after the other: their n-grams are not on disk at the same time
    answers = [staged(coded.select("block", "flags", "lengths", "codes", "gid", "count")
                      .mapInArrow(_ask(order, buckets, total, words), _ASKS)
                      .groupBy("family", "bucket").applyInPandas(
        _answer, "family int, block long, bucket int, code binary, weight binary")) for order in (2, 3)]
    answers = answers[0].unionByName(answers[1])
    out = coded.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _score(buckets, total, words), _SCORES)
    return out.select("doc_id", "held_out", "n_tokens", "n_known",
                      F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
