"""Near-duplicate detection with circulant MinHash.

Two permutations of the 32-bit universe serve all signature coordinates: the
first scatters a shingle, the second is read at the scattered place shifted
circularly by the coordinate's number.  Coordinates are banded; documents that
share a band are candidates, and every link is confirmed on the full sets.

Documents with the same set are one class.  Within a bucket of many classes
the links are not listed pair by pair: classes are first compared with a
leader of the bucket, twice; then only what is still in different components
is compared exhaustively, in blocks of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components
from .packing import mix64

BLOCK = 256          # classes of a block in the exhaustive comparison
MISS = 1e-6          # chance to miss a link that is just at the threshold
_CHUNK = 1 << 15     # shingles of a signature step


def band_plan(threshold: float) -> tuple[int, int]:
    """(bands, rows): the bands make the chance to miss a link of exactly
    ``threshold`` at most ``MISS``."""
    rows = max(1, round(math.log(0.3) / math.log(threshold))) if threshold < 1 else 8
    hit = threshold ** rows
    return (1 if hit >= 1 else math.ceil(math.log(MISS) / math.log(1 - hit))), rows


class Shingler:
    """Texts to sorted arrays of 64-bit shingle hashes.  Words are hashed once
    each (the memory of words is cleared when it is large)."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > 1_000_000:
            known.clear()
        ids = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            ids.append(h)
        h = np.array(ids, np.uint64)
        n = min(self.width, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = mix64((out + h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15))
        return np.unique(out)


def _permute(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit integers (in place)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """(documents, size) uint32 signatures of non-empty sets."""
    out = np.empty((len(sets), size), np.uint32)
    first = 0
    while first < len(sets):
        last, n = first, 0
        while last < len(sets) and (n == 0 or n + len(sets[last]) <= _CHUNK):
            n += len(sets[last])
            last += 1
        v = np.concatenate(sets[first:last])
        scattered = _permute((v ^ (v >> np.uint64(32))).astype(np.uint32) ^ np.uint32(0x5BD1E995))
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[first:last]])[:-1]])
        buf = np.empty_like(scattered)
        for k in range(size):
            np.subtract(scattered, np.uint32(k), out=buf)  # the circular shift
            out[first:last, k] = np.minimum.reduceat(_permute(buf), starts)
        first = last
    return out


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


_CLASSES = "doc_id long, x long, n_shingles long, cls binary, bands array<bigint>"


def _classify(width: int, bands: int, rows: int):
    def run(batches):
        shingle = Shingler(width)
        for batch in batches:
            ids, texts, x = batch.column(0), batch.column(1), batch.column(2)
            for at in range(0, len(texts), 512):
                part = [shingle(t) for t in texts.slice(at, 512).to_pylist()]
                full = [i for i, s in enumerate(part) if len(s)]
                cls, keys = [None] * len(part), [None] * len(part)
                if full:
                    sig = signatures([part[i] for i in full], bands * rows)
                    b = np.zeros((len(full), bands), np.uint64)
                    for k in range(rows):
                        b = mix64((b + sig[:, k::rows][:, :bands].astype(np.uint64))
                                  * np.uint64(0x9E3779B97F4A7C15))
                    b = mix64(b + np.arange(bands, dtype=np.uint64)).view(np.int64)
                    for j, i in enumerate(full):
                        cls[i], keys[i] = _digest(part[i]), b[j]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 512), x.slice(at, 512), pa.array([len(s) for s in part], pa.int64()),
                     pa.array(cls, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "x", "n_shingles", "cls", "bands"])
    return run


def _sets(width: int):
    def run(batches):
        shingle = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = [shingle(t) for t in batch.column(0).slice(at, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in part], pa.binary()),
                     pa.array([s.tobytes() for s in part], pa.binary())], ["cls", "items"])
    return run


def linked(a: int, b: int, both, num: int, den: int):
    """Exact test of intersection / union >= num / den."""
    return both * (num + den) >= num * (a + b)


def _verify(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if den * len(x) < num * len(y):
                    keep.append(False)
                    continue
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                keep.append(bool(linked(len(x), len(y), int((y[at] == x).sum()), num, den)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough.  A leader of many
    pairs is a skewed join key that the adaptive plan splits."""
    j = (pairs.join(sets.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
         .join(sets.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a"))
    return j.select("a", "b", "x", "y").mapInArrow(_verify(num, den), "a binary, b binary")


def _block_links(num: int, den: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf.side <= 1], pdf[pdf.side >= 1]
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": []})
        sets = [np.frombuffer(x, np.uint64) for x in right["items"]]
        size = np.array([len(s) for s in sets])
        flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(size)[:-1]])
        labels = right["label"].to_numpy()
        out = []
        for cls, label, items in zip(left["cls"], left["label"], left["items"]):
            x = np.frombuffer(items, np.uint64)
            at = np.searchsorted(x, flat)
            at[at == len(x)] = 0
            both = np.add.reduceat((x[at] == flat).astype(np.int64), starts)
            ok = linked(len(x), size, both, num, den) & (labels != label)
            seen = set()
            for i in np.flatnonzero(ok):  # one link for each other component
                if labels[i] not in seen:
                    seen.add(labels[i])
                    out.append((cls, right["cls"].iloc[i]))
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _exhaustive(open_members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between classes of one bucket that are in different components.

    ``open_members``: ``key, cls, label`` of the buckets with several
    components.  The largest component of a bucket is cut into blocks, the rest
    too; every block of the rest meets every block, but no two blocks of the
    largest component meet.
    """
    per = open_members.groupBy("key", "label").count()
    big = per.groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("big"),
                                 F.max("count").alias("n_big"), F.sum("count").alias("n"))
    m = open_members.join(big, "key")
    rest = F.col("label") != F.col("big")
    m = m.select(
        "key", "cls", "label", rest.alias("rest"),
        F.ceil((F.col("n") - F.col("n_big")) / BLOCK).cast("int").alias("nr"),
        F.ceil(F.col("n_big") / BLOCK).cast("int").alias("ng"))
    at = F.pmod(F.xxhash64("cls"), F.when(F.col("rest"), F.col("nr")).otherwise(F.col("ng"))).cast("int")
    m = m.withColumn("at", at)
    # (i, j): block i of the rest against block j: 0 .. nr-1 of the rest, nr .. of the largest
    meets = F.expr("""case when rest then concat(
        transform(sequence(0, nr + ng - 1), j -> named_struct(
            'i', if(j < at, j, at), 'j', if(j < at, at, j), 'side', if(j = at, 1, if(j < at, 2, 0)))),
        array())
      else transform(sequence(0, nr - 1), i -> named_struct('i', i, 'j', nr + at, 'side', 2)) end""")
    m = m.select("key", "cls", "label", F.explode(meets).alias("m")).select("key", "cls", "label", "m.*")
    # a block of the rest that meets itself gives both sides (side 1)
    m = m.join(sets, "cls")
    return m.groupBy("key", "i", "j").applyInPandas(_block_links(num, den), "a binary, b binary")


def near_duplicates(docs: DataFrame, width: int = 3, num: int = 85, den: int = 100) -> DataFrame:
    """Per input row ``doc_id, n_shingles, component_id, kept``.

    A document's set: its distinct ``width``-word shingles, or its whole word
    sequence when it is shorter.  Documents are linked when den * intersection
    >= num * union.  ``component_id``: the smallest doc_id reachable, itself
    included; ``kept``: it is its own.  A text without words (null, empty,
    blank) has an empty set and is linked with nothing.  Rows that repeat a
    doc_id belong to all of that id's links; a null doc_id counts in its
    component only when no id is known there (it is then null and not kept).
    An empty table gives no rows.
    """
    # from classes to documents: the smallest id of all classes of a component
    j = grouped(docs, width, num, den)
    least = j.where(F.col("g").isNotNull()).groupBy("g").agg(F.min("doc_id").alias("least"))
    out = j.join(least, "g", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def grouped(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Per input row ``doc_id, x, n_shingles, g``: the hash of its text, and the
    component of its text (null for a text without words)."""
    bands, rows = band_plan(num / den)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    d = staged(docs.select("doc_id", "text", F.xxhash64("text").alias("x")).mapInArrow(_classify(width, bands, rows), _CLASSES))
    classes = d.where(F.col("cls").isNotNull())
    # one row per class and band; a class repeats its bands in every copy
    member = classes.select("cls", F.explode("bands").alias("key")).distinct()
    shared = member.groupBy("key").agg(F.min("cls").alias("leader"), F.max("cls").alias("_max"))
    shared = shared.where(F.col("leader") != F.col("_max")).drop("_max")
    member = staged(member.join(shared, "key"))
    wanted = member.select("cls").distinct()
    reps = (classes.groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(wanted, "cls", "left_semi")
            .select(F.col("doc_id").alias("_id")).distinct())
    sets = (docs.select("doc_id", "text").join(reps, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
            .select("text").mapInArrow(_sets(width), "cls binary, items binary")
            .join(wanted, "cls", "left_semi").dropDuplicates(["cls"]))
    sets = staged(sets)

    pairs = member.where("cls <> leader").select(F.col("leader").alias("a"), F.col("cls").alias("b")).distinct()
    links = staged(_confirmed(pairs, sets, num, den))
    for exhaustive in (False, True):
        labels = components(links).withColumnsRenamed({"node": "cls"})
        now = member.select("key", "cls").join(labels, "cls", "left").withColumn(
            "label", F.coalesce("label", "cls"))
        unsettled = (now.groupBy("key").agg(F.min("label").alias("_a"), F.max("label").alias("_b"))
                     .where("_a <> _b").select("key"))
        now = staged(now.join(unsettled, "key", "left_semi"))
        if exhaustive:
            more = _exhaustive(now, sets, num, den)
        else:
            # the class with most links leads; only other components are compared with it
            degree = (links.select("a").unionByName(links.select(F.col("b").alias("a")))
                      .groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("deg")))
            ranked = now.join(degree, "cls", "left")
            lead = ranked.groupBy("key").agg(F.max_by(
                F.struct("cls", "label"), F.struct(F.coalesce("deg", F.lit(0)), "cls")).alias("l"))
            more = (now.join(lead, "key").where(F.col("label") != F.col("l.label"))
                    .select(F.col("l.cls").alias("a"), F.col("cls").alias("b")).distinct())
            more = _confirmed(more, sets, num, den)
        links = staged(links.unionByName(more))
    labels = components(links)

    return d.join(labels, d.cls == labels.node, "left").select(
        "doc_id", "x", "n_shingles", F.coalesce("label", "cls").alias("g"))
