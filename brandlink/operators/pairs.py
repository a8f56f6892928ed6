"""Similarity pairs from long-form unit vectors.

``cosine_pairs`` is an exact thresholded self-join.  Candidates come from a
prefix-filtered join on shared terms (Bayardo, Ma, Srikant, "Scaling up all
pairs similarity search", WWW 2007): terms of every name are ordered rare to
common, and a term is indexed only while the norm of it and all more common
terms of the name is at least the threshold.  Two unit vectors with cosine
>= t always share a term that is indexed on both sides, so the candidate set
is complete.  The names are dealt into stripes (:mod:`.grid`): candidates are
found and verified where two stripes meet, so neither they nor a vector for each
pair is shuffled.  Given pairs (``pair_dots``) meet vector rows, one for each name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..llm.packing import pack, unpack
from ..session import cut_lineage, free_shuffles
from .grid import (name_column, name_ranks, pair_table, parts_by_stripe, sides, stripe_count, stripe_pairs,
                   stripe_rounds, striped)

EPS = 1e-9
# similarities are compared with the threshold at this precision, so exact
# ties (rational cosines such as 0.5) do not depend on summation order
CMP_DIGITS = 9


def at_least(c, t: float):
    return F.round(c, CMP_DIGITS) >= t


def _with_df(weights: DataFrame) -> DataFrame:
    if "df" in weights.columns:  # carried from TF-IDF: no second shuffle by term
        return weights
    return weights.join(weights.groupBy("term").agg(F.count("*").alias("df")), "term")


def _with_suffix_norm(weights: DataFrame) -> DataFrame:
    """Add ``df`` (document frequency) and ``suffix`` = norm of the name's
    weights on this term and all more common ones.  A growing running sum in
    reverse order (common to rare), so the window is linear per name."""
    w = _with_df(weights)
    win = (Window.partitionBy("name").orderBy(F.col("df").desc(), F.col("term").desc())
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return w.withColumn("suffix", F.sqrt(F.sum(F.col("w") * F.col("w")).over(win)))


def candidate_pairs(weights: DataFrame, min_similarity: float, lefts: DataFrame | None = None) -> DataFrame:
    """Distinct ``(left_side, right_side)`` pairs that may reach the threshold:
    ``left_side < right_side``, or, with ``lefts`` (``name``), both orders of the
    pairs whose left side is one of these names."""
    t = float(min_similarity)
    idx = _with_suffix_norm(weights).where(F.col("suffix") >= t - EPS)
    first = idx if lefts is None else idx.join(lefts.select("name"), "name", "left_semi")
    a = first.select(F.col("name").alias("left_side"), "term", F.col("suffix").alias("sa"))
    b = idx.select(F.col("name").alias("right_side"), "term", F.col("suffix").alias("sb"))
    order = a.left_side < b.right_side if lefts is None else a.left_side != b.right_side
    return a.join(b, [a.term == b.term, order, a.sa * b.sb >= t - EPS]).select("left_side", "right_side").distinct()


def vector_rows(weights: DataFrame) -> DataFrame:
    """``name, vec``: a name's entries ``(kind, term, w)`` in one row.  ``kind``
    (0 without such a column) keeps several encodings apart."""
    kind = F.col("kind") if "kind" in weights.columns else F.lit(0).alias("kind")
    return weights.groupBy("name").agg(F.collect_list(F.struct(kind, "term", "w")).alias("vec"))


def _dots(kinds: int, columns: list[str]):
    """Dot products of the vector rows of a batch of pairs, all pairs at once:
    entries of the left and right sides meet by (pair, kind, term)."""
    def entries(v):
        n = np.diff(v.offsets.to_numpy())
        e = v.flatten()
        return np.repeat(np.arange(len(n)), n), e.field("kind").to_numpy(), e.field("term"), e.field("w").to_numpy()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                lr, lk, lt, lw = entries(part.column(2))
                rr, rk, rt, rw = entries(part.column(3))
                code = pa.concat_arrays([lt, rt]).dictionary_encode()
                size, code = len(code.dictionary) + 1, code.indices.to_numpy().astype(np.int64)
                left = (lr * kinds + lk) * size + code[:len(lr)]
                right = (rr * kinds + rk) * size + code[len(lr):]
                order = np.argsort(right)
                right, rw = right[order], rw[order]
                hit = np.searchsorted(right, left)
                hit[hit == len(right)] = 0
                ok = np.flatnonzero(right[hit] == left) if len(right) else np.empty(0, np.int64)
                total = np.bincount(lr[ok] * kinds + lk[ok], lw[ok] * rw[hit[ok]], minlength=part.num_rows * kinds)
                total = total.reshape(-1, kinds)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(total[:, k]) for k in range(kinds)]],
                    ["left_side", "right_side", *columns])
    return run


def pair_dots(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """``left_side, right_side`` and one dot product for each kind of the vector
    rows (kind i in the i-th column); 0.0 where no term is shared."""
    left = rows.select(F.col("name").alias("left_side"), F.col("vec").alias("lv"))
    right = rows.select(F.col("name").alias("right_side"), F.col("vec").alias("rv"))
    j = pairs.select("left_side", "right_side").join(left, "left_side", "left").join(right, "right_side", "left")
    none = F.array().cast(rows.schema["vec"].dataType)
    j = j.select("left_side", "right_side", F.coalesce("lv", none).alias("lv"), F.coalesce("rv", none).alias("rv"))
    schema = ", ".join(["left_side string, right_side string", *[f"`{c}` double" for c in columns]])
    return j.mapInArrow(_dots(len(columns), columns), schema)


def pair_cosine(pairs: DataFrame, weights: DataFrame, column: str = "similarity") -> DataFrame:
    """Exact dot product for given distinct pairs; 0.0 when no term is shared."""
    return pair_dots(pairs, vector_rows(weights), [column])


_PACKED = "s int, names array<string>, n binary, size binary, terms binary, df binary, code binary, w binary"
_PACKED_SCHEMA = pa.schema([("s", pa.int32()), ("names", pa.list_(pa.string())), *[(c, pa.binary()) for c in (
    "n", "size", "terms", "df", "code", "w")]])


def _common_first(terms: pa.Array, df: np.ndarray) -> np.ndarray:
    """Places of the terms from common to rare, ties from the last of the alphabet."""
    alphabet = pc.sort_indices(terms, sort_keys=[("", "descending")]).to_numpy()
    return alphabet[np.argsort(-df[alphabet], kind="stable")]


def _pack(batches):
    """Vector rows (name, vec of (df, term, w)), some batches together, to one row
    for each stripe: its terms once, common to rare, and each name's entries in that order."""
    def packed(held):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        for s, part in parts_by_stripe(rows):
            vec = part.column("vec")
            e = vec.flatten()
            n = np.diff(vec.offsets.to_numpy()).astype(np.int32)
            term = e.field("term").dictionary_encode()
            terms, code = term.dictionary, term.indices.to_numpy()
            df = np.zeros(len(terms), np.int64)
            df[code] = e.field("df").to_numpy()
            order = _common_first(terms, df)
            rank = np.empty(len(terms), np.int32)
            rank[order] = np.arange(len(terms), dtype=np.int32)
            terms, code = terms.take(pa.array(order)), rank[code]
            by = np.lexsort((code, np.repeat(np.arange(len(n)), n)))
            text = b"".join(x.encode("utf-8", "surrogatepass") for x in terms.to_pylist())
            names = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("name"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), names, *[pa.array([x], pa.binary()) for x in (
                    pack(n), pack(pc.binary_length(terms).to_numpy().astype(np.int32)), pack(np.frombuffer(text, np.uint8)),
                    pack(df[order]), pack(np.diff(code[by], prepend=np.int32(0))), pack(e.field("w").to_numpy()[by]))]], schema=_PACKED_SCHEMA)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column(batch.schema.get_field_index("vec")).flatten())
        if size > _HELD:
            yield from packed(held)
            held, size = [], 0
    if held:
        yield from packed(held)


def _terms(x: pa.Table) -> list[pa.Array]:
    """The terms of each packed row."""
    out = []
    for size, text in zip(x.column("size"), x.column("terms")):
        ends = np.cumsum(unpack(size.as_py(), np.int32), dtype=np.int32)
        offset = np.concatenate([np.zeros(1, np.int32), ends])
        out.append(pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offset), pa.py_buffer(
            unpack(text.as_py(), np.uint8))]))
    return out


_STEP = 1 << 21     # shared entries at a time
_LEVELS = 64        # ranks at which the norms of the more common terms are kept
_ENTRIES = 2 << 20  # entries of a stripe, about
_HELD = 2 << 20     # entries that are packed together
_CELLS = 8 << 20    # pairs of names that are looked at together


def _running(n: np.ndarray, start: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Running sums inside each name (``n`` values from ``start``), names of like
    length together: a sum over all names would lose the digits of a short one."""
    out, like = np.empty(len(v)), np.frexp(n)[1]
    for k in np.unique(like):
        names = np.flatnonzero(like == k)
        wide = np.arange(n[names].max())
        step = max(1, _STEP // len(wide))
        for x in range(0, len(names), step):
            at = start[names[x:x + step], None] + wide
            inside = wide < n[names[x:x + step], None]
            out[at[inside]] = np.where(inside, v[np.minimum(at, len(v) - 1)], 0).cumsum(axis=1)[inside]
    return out


def _stripe_join(t: float):
    """Pairs at or above ``t`` of a group of two stripes: indexed entries meet by
    term and give a part of the dot product; where it may reach ``t`` with the
    terms that are not indexed on both sides, it is taken over whole vectors.

    Both names index what is at least as rare as the rarer of their two cuts, so
    the rest is at most the product of their norms on the terms before that cut."""
    def entries(x: pa.Table, number: list[np.ndarray]):
        """Of a stripe's names: entries of each, first one; codes and weights; the
        indexed ones, their owners; first code indexed, norm of those before."""
        n = [unpack(v.as_py(), np.int32).astype(np.int64) for v in x.column("n")]
        code = [k[np.cumsum(unpack(v.as_py(), np.int32), dtype=np.int32)] for k, v in zip(number, x.column("code"))]
        w = [unpack(v.as_py(), float) for v in x.column("w")]
        n, code, w = np.concatenate(n), np.concatenate(code), np.concatenate(w)
        start = np.cumsum(n) - n
        suffix = np.sqrt(_running(n, start, w * w))   # of it and all more common ones
        owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
        at = np.flatnonzero(suffix >= t - EPS)
        out = n - np.bincount(owner[at], minlength=len(n))   # the first ones are not indexed
        cut = np.append(code, np.iinfo(np.int32).max)[start + np.minimum(out, n)]
        cut[out == n] = np.iinfo(np.int32).max
        rest = np.where(out > 0, suffix[np.maximum(start + out - 1, 0)], 0.0)
        return n, start, code, w, at, owner, cut, rest

    def norms(n, code, w, owner, levels):
        """Norm of each name's entries before each level, a row for a level."""
        at = np.searchsorted(levels, code, "right")
        square = np.bincount(owner.astype(np.int64) * (len(levels) + 1) + at, w * w, minlength=len(n) * (len(levels) + 1))
        return np.ascontiguousarray(np.sqrt(np.cumsum(square.reshape(len(n), -1)[:, :-1], axis=1)).T)

    def run(table: pa.Table) -> pa.Table:
        both = sides(table)
        if both is None:
            return pair_table(*[pa.array([], pa.string())] * 2, [], "s")
        a, b, same = both
        na, nb = name_column(a), name_column(b)
        ra, rb = name_ranks(na, nb, same)
        terms = _terms(a) + ([] if same else _terms(b))
        both = pa.concat_arrays(terms).dictionary_encode()
        size, index = len(both.dictionary), both.indices.to_numpy()
        df = np.zeros(size, np.int64)
        df[index] = np.concatenate([unpack(v.as_py(), np.int64) for x in ([a] if same else [a, b]) for v in x.column("df")])
        rank = np.empty(size, np.int32)
        rank[_common_first(both.dictionary, df)] = np.arange(size, dtype=np.int32)
        number = np.split(rank[index], np.cumsum([len(x) for x in terms])[:-1])
        an, astart, ac, aw, ai, ao, acut, arest = mine = entries(a, number)
        bn, bstart, bc, bw, bi, bo, bcut, brest = mine if same else entries(b, number[a.num_rows:])
        levels = np.unique(np.concatenate([acut, bcut]))
        levels = levels[np.unique(np.linspace(len(levels) - 1, 0, _LEVELS).astype(np.int64))]
        alevel, blevel = np.searchsorted(levels, acut), np.searchsorted(levels, bcut)
        anorm = norms(an, ac, aw, ao, levels)
        bnorm = anorm if same else norms(bn, bc, bw, bo, levels)
        # indexed entries of the two sides that share a term
        aown, acode, aval = ao[ai], ac[ai], aw[ai]
        bi = bi[np.argsort(bc[bi], kind="stable")]
        bown, bval = bo[bi], bw[bi]
        begin = np.searchsorted(bc[bi], np.arange(size + 1))
        lo, k = begin[acode], begin[acode + 1] - begin[acode]
        weight, parts = np.zeros(size), []
        step = max(1, _CELLS // len(bn))
        for top in range(0, len(an), step):       # some names of the left
            x, y = np.searchsorted(aown, [top, top + step])
            part = np.zeros((min(step, len(an) - top), len(bn)))
            cut = x + np.flatnonzero(np.diff(np.cumsum(k[x:y]) // _STEP, prepend=0))
            for p, q in zip([x, *cut], [*cut, y]):
                m = k[p:q]
                at = np.repeat(lo[p:q] - (np.cumsum(m) - m), m)
                at += np.arange(len(at))
                cell = np.repeat((aown[p:q] - top).astype(np.int64) * len(bn), m) + bown[at]
                np.add.at(part.ravel(), cell, np.repeat(aval[p:q], m) * bval[at])
            # one name at a time: its weights by term, and all its candidates
            for i in range(top, top + len(part)):
                rest = np.where(bcut <= acut[i], arest[i] * bnorm[alevel[i]], brest * anorm[blevel, i])
                js = np.flatnonzero(part[i - top] + rest >= t - EPS)
                js = js[ra[i] < rb[js]] if same else js[ra[i] != rb[js]]
                if not len(js):
                    continue
                own = slice(astart[i], astart[i] + an[i])
                weight[ac[own]] = aw[own]
                for x in range(0, len(js), 4096):
                    j = js[x:x + 4096]
                    m = bn[j]
                    first = np.cumsum(m) - m
                    at = np.repeat(bstart[j] - first, m) + np.arange(m.sum())
                    dot = np.add.reduceat(weight[bc[at]] * bw[at], first)
                    hit = np.flatnonzero(np.round(dot, CMP_DIGITS) >= t)
                    parts.append((np.full(len(hit), i), j[hit], dot[hit], ra[i] < rb[j[hit]]))
                weight[ac[own]] = 0
        return pair_table(na, nb, parts, "s")
    return run


def _pairs_at_least(weights: DataFrame, t: float) -> DataFrame:
    """``left_side < right_side, s``: the pairs with cosine ``s`` >= ``t``."""
    idx = _with_df(weights).groupBy("name").agg(F.collect_list(F.struct("df", "term", "w")).alias("vec"))
    size = weights.agg(F.countDistinct("name").alias("names"), F.count(F.lit(1)).alias("entries")).first()
    n = max(stripe_count(size["names"], least=256, most=32768), -(-size["entries"] // _ENTRIES))
    packed = striped(idx, n).mapInArrow(_pack, _PACKED)
    rounds = stripe_rounds(n)
    if len(rounds) > 1:
        packed = cut_lineage(packed)
    out = None
    for near in rounds:
        found = stripe_pairs(packed, n, near).applyInArrow(
            _stripe_join(t), "left_side string, right_side string, s double")
        if len(rounds) > 1:
            found = cut_lineage(found)
            free_shuffles(found.sparkSession)  # the copies of the vectors go before the next ones are made
        out = found if out is None else out.unionByName(found)
    return out


def cosine_pairs(weights: DataFrame, min_similarity: float, symmetric: bool = False,
                 include_self: bool = False, column: str = "similarity",
                 round_to: int | None = None) -> DataFrame:
    """All pairs of names whose cosine is >= ``min_similarity`` (> 0).

    Output ``left_side, right_side, <column>``; ``left < right`` unless
    ``symmetric`` (both directions); the diagonal only with ``include_self``.
    """
    if min_similarity <= 0:
        raise ValueError("a positive threshold is required (all pairs would be n^2)")
    # read for the vectors, their number and the diagonal: materialise once
    keep = ["name", "term", "w"] + (["df"] if "df" in weights.columns else [])
    weights = cut_lineage(weights.select(*keep))
    sims = _pairs_at_least(weights, float(min_similarity))
    if symmetric:
        sims = cut_lineage(sims)  # thresholded pairs, read twice (both directions)
    out = sims
    if symmetric:
        out = out.unionByName(sims.select(F.col("right_side").alias("left_side"),
                                          F.col("left_side").alias("right_side"), "s"))
    if include_self:
        diag = weights.groupBy("name").agg(F.sum(F.col("w") * F.col("w")).alias("s"))
        out = out.unionByName(diag.select(F.col("name").alias("left_side"),
                                          F.col("name").alias("right_side"), "s")
                              .where(at_least(F.col("s"), min_similarity)))
    val = F.round("s", round_to) if round_to is not None else F.col("s")
    return out.select("left_side", "right_side", val.alias(column))


#: Cosines at which the search for the best partners tries again with the names
#: that have too few; below the last, any shared term makes a candidate.
LADDER = (0.9, 0.7, 0.5, 0.35, 0.2, 0.1, 0.05, 0.0)


def top_k_pairs(weights: DataFrame, k: int, column: str = "similarity") -> DataFrame:
    """O3 as a join: the ``k`` best partners (fewer where fewer share a term) of
    every name, ties by name; at most k rows for each name.

    A name with k partners at or above a cosine is done: none below can matter.
    So the threshold steps down, and only names still short of k look again;
    no table of all similar pairs is made.
    """
    keep = ["name", "term", "w"] + (["df"] if "df" in weights.columns else [])
    weights = cut_lineage(weights.select(*keep))
    rows = cut_lineage(vector_rows(weights))
    open_, out = weights.select("name").distinct(), None
    for t in LADDER:
        t = t or EPS
        found = pair_dots(candidate_pairs(weights, t, open_), rows, [column])
        found = cut_lineage(top_k_per_name(found.where(F.round(column, CMP_DIGITS) >= (t if t > EPS else 0))
                                           .where(F.col(column) > 0), k, column))
        full = found.groupBy("left_side").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        done = full.select(F.col("left_side").alias("name")) if t > EPS else open_
        part = found.join(done.select(F.col("name").alias("left_side")), "left_side", "left_semi")
        out = part if out is None else out.unionByName(part)
        open_ = cut_lineage(open_.join(done, "name", "left_anti"))
        if not open_.head(1):
            break
    return out


def top_k_per_name(pairs: DataFrame, k: int, column: str = "similarity") -> DataFrame:
    """O3: the ``k`` most similar partners of every left name (ties by name).
    The ``row_number <= k`` filter is planned as a window group limit, so
    each map task keeps only k rows per name before the shuffle."""
    w = Window.partitionBy("left_side").orderBy(F.round(column, CMP_DIGITS).desc(), F.col("right_side"))
    return pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def top_n(pairs: DataFrame, n: int, column: str = "similarity") -> DataFrame:
    """Global ranking, best first; per-partition top-n then merge."""
    return pairs.orderBy(F.col(column).desc(), "left_side", "right_side").limit(n)


def top_distinct_pairs(pairs: DataFrame, n: int = 10, below: float = 0.999999,
                       column: str = "similarity") -> DataFrame:
    """Best unordered pairs ``left < right`` excluding near-identical ones."""
    p = pairs.where((F.col("left_side") < F.col("right_side")) & (F.col(column) < below))
    return top_n(p, n, column)
