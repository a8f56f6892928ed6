"""N-gram Jaccard join by a count-vector R-tree.

Tokens (shingles) are hashed into groups.  The groups serve twice:

* Routing.  Two sets that link differ in at most D tokens, and D follows from
  their sizes.  With more than D non-empty groups, one group holds the same
  tokens in both, so sets meet under (size class, group, hash of its tokens).
  This loses no link whatever the tokens are.  Random sets of equal size lie at
  about equal distance, and boxes alone could not part them.
* Index.  A set's counts by group are a point.  A leader and the sets that
  hold its keys are packed into an R-tree; the overlap of two boxes, or of two sets, is at
  most the sum of the smaller of their largest coordinates.  Pairs whose bound
  falls short are cut at every level, and the rest are verified on full sets.

Equal sets are one class.  Classes first meet the leader of each key; only what
is still in different components enters the tree, and boxes that lie in one
component are not compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import range_numbered, release, staged
from .components import components
from .minhash import Shingler
from .packing import mix64, pack, unpack

GROUPS = 64            # coordinates of a box
FINE = 512             # coordinates of a point; a box sums FINE / GROUPS of them
LEAF, FANOUT = 512, 16  # sets of a leaf, boxes of a node
BITS = 1 << 26          # bits of the map that keeps rows without a partner out of a shuffle
BUCKET_KEYS = 4_000_000
_TASK_KEYS = 1_000_000  # keys that a task holds before it sends them


class SizeClasses:
    """Geometric size classes and the number of groups that each needs.

    A pair is compared in the class of its larger set; a set whose partners may
    lie in the next class is keyed there too.  Three steps of den / num make a
    class, so that a third of the sets have keys twice.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.ratio = (den / num) ** 3 if num < den else 2.0

    def at(self, n: int) -> int:
        return int(math.log(n) / math.log(self.ratio) + 1e-9)

    def last(self, c: int) -> int:
        """Upper bound on the sizes of a class."""
        return math.ceil(self.ratio ** (c + 1)) + 1

    def differ(self, a: int, b: int) -> int:
        """The most tokens in which linked sets of these sizes differ."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def groups(self, c: int) -> int:
        most = self.differ(self.last(c), self.last(c))
        return most + 3 + most // 8

    def of(self, n: int) -> list[tuple[int, int]]:
        """(class, most different tokens there) for a set of ``n`` tokens."""
        top = n * self.den // self.num
        c, up = self.at(n), self.at(max(n, top))
        own = (c, self.differ(n, min(top, self.last(c))))
        return [own] if up == c else [own, (up, self.differ(n, top))]


def group_keys(s: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """Keys of a sorted set of spread 64-bit tokens.

    A set is the list of its groups with what each holds, the empty ones last.
    Linked sets agree in all but D of these, so by prefix filtering their first
    D + 1 share one.  With D = 0 only equal sets link, and no key is needed.
    """
    out = [np.empty(0, np.uint64)]
    spread = mix64(s.copy())
    for c, most in classes.of(len(s)):
        if not most:
            continue
        groups = classes.groups(c)
        # a group is a range of the token space, so the sorted set is cut in place
        at = (s >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        content, group = np.add.reduceat(spread, first), at[first]
        if len(group) <= most:
            none = np.setdiff1d(np.arange(groups, dtype=np.uint64), group)
            content, group = np.append(content, np.zeros(len(none), np.uint64)), np.append(group, none)
        content, group = content[:most + 1], group[:most + 1]
        out.append(mix64(content + mix64((group << np.uint64(16)) + np.uint64(c + 1))))
    return np.concatenate(out)


def point(s: np.ndarray) -> np.ndarray:
    """Counts of a set's tokens in FINE groups."""
    return np.bincount((s & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE).astype(np.int32)


def coarse(p: np.ndarray) -> np.ndarray:
    return p.reshape(-1, GROUPS).sum(axis=0, dtype=np.int32)


def _zip(s: np.ndarray) -> bytes:
    """Sorted numbers as their steps."""
    return pack(np.diff(s, prepend=np.uint64(0)))


def _unzip(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def _shut(p: np.ndarray) -> bytes:
    return p.astype(np.uint8 if p.max() < 256 else np.int32).tobytes()


def _opened(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8 if len(b) == FINE else np.int32)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


_CLASSES = "doc_id long, x long, n_shingles long, cls binary, keys binary"


def _classify(width: int, num: int, den: int):
    """Documents to classes; keys once for each class of a task."""
    def run(batches):
        shingle, classes, seen = Shingler(width), SizeClasses(num, den), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, cls, keys = [], [], []
                for text in part.column(2).to_pylist():
                    s = shingle(text)
                    n.append(len(s))
                    d = _digest(s) if len(s) else None
                    cls.append(d)
                    new = d is not None and d not in seen
                    if new:
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(d)
                    keys.append(group_keys(s, classes).tobytes() if new else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                     pa.array(keys, pa.binary())], ["doc_id", "x", "n_shingles", "cls", "keys"])
    return run


_SENT = "bucket int, keys binary, owner binary, held binary, cls binary"


def _meet(keys: np.ndarray, owner: np.ndarray, held: np.ndarray):
    """Keys with several holders: (leader, member, whether there are three or
    more holders) of each.  The leader is the holder with the smallest number."""
    order = np.lexsort((owner, keys))
    keys, owner, held = keys[order], owner[order], held[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    lead = np.repeat(owner[first], sizes)
    many = np.repeat(np.add.reduceat(held, first) if len(first) else held, sizes) > 2
    rest = lead != owner
    pairs = np.unique((lead[rest].astype(np.int64) << 32 | owner[rest].astype(np.int64)) << 1 | many[rest])
    return pairs >> 33, pairs >> 1 & 0xFFFFFFFF, (pairs & 1).astype(bool)


def _send(buckets: int):
    """Keys to their buckets.  Where three or more classes of a task share a key
    only their leader is sent, with their number, so a frequent key is one entry
    of a task; the others are linked to it here (a row without keys)."""
    def flush(batch, place):
        names, back = np.unique(np.frombuffer(b"".join(c for c, _ in batch), "V16"), return_inverse=True)
        keys = np.frombuffer(b"".join(k for _, k in batch), np.uint64)
        owner = np.repeat(back, [len(k) // 8 for _, k in batch])
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(first, len(keys)))
        full = np.repeat(sizes > 2, sizes)
        a, b, _ = _meet(keys[full], owner[full], np.ones(int(full.sum()), np.int64))
        out = [(place % buckets, None, names[a].tobytes(), None, names[b].tobytes())]
        sent = ~full
        sent[first] = True
        held = np.repeat(np.where(sizes > 2, sizes, 1), sizes)[sent]
        keys, owner = keys[sent], owner[sent]
        at = (mix64(keys.copy()) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        keys, owner, held = keys[order], owner[order], held[order]
        ends = np.searchsorted(at[order], np.arange(buckets + 1))
        for k in range(buckets):
            x, y = ends[k], ends[k + 1]
            if x < y:
                mine, local = np.unique(owner[x:y], return_inverse=True)
                out.append((k, _zip(keys[x:y]), pack(local.astype(np.int32)), pack(held[x:y]),
                            names[mine].tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), *[pa.array([r[i] for r in out], pa.binary()) for i in range(1, 5)]],
            ["bucket", "keys", "owner", "held", "cls"])

    def run(batches):
        from pyspark import TaskContext

        held, n, place = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            for c, k in zip(batch.column(0), batch.column(1)):
                k = k.as_py()
                if not k:
                    continue
                held.append((c.as_py(), k))
                n += len(k) // 8
                if n >= _TASK_KEYS:
                    yield flush(held, place)
                    held, n, place = [], 0, place + 1
        if held:
            yield flush(held, place)
    return run


_PAIRS = "a binary, b binary"
_MET = "a binary, b binary, many boolean, sent boolean"


def _pair_table(a: np.ndarray, b: np.ndarray, many: np.ndarray, sent: bool) -> pa.Table:
    names = [pa.array([x.tobytes() for x in v], pa.binary()) for v in (a, b)]
    return pa.table([*names, pa.array(many, pa.bool_()), pa.array(np.full(len(a), sent))], ["a", "b", "many", "sent"])


def _match(t: pa.Table) -> pa.Table:
    """One bucket: the classes that share a key with its leader, and the pairs
    that were linked where the keys were sent."""
    rows = t.to_pylist()
    made = [(np.frombuffer(r["owner"], "V16"), np.frombuffer(r["cls"], "V16")) for r in rows if r["keys"] is None]
    out = [_pair_table(a, b, np.ones(len(a), bool), False) for a, b in made]
    rows = [r for r in rows if r["keys"] is not None]
    if rows:
        names, back = np.unique(np.frombuffer(b"".join(r["cls"] for r in rows), "V16"), return_inverse=True)
        starts = np.cumsum([0, *[len(r["cls"]) // 16 for r in rows[:-1]]])
        owner = np.concatenate([back[unpack(r["owner"], np.int32) + s] for r, s in zip(rows, starts)])
        held = np.concatenate([unpack(r["held"], np.int64) for r in rows])
        a, b, many = _meet(np.concatenate([_unzip(r["keys"]) for r in rows]), owner, held)
        out.append(_pair_table(names[a], names[b], many, True))
    return pa.concat_tables(out)


_SETS = "cls binary, n int, box array<int>, point binary, items binary"


def _sets(width: int):
    """The sets of texts, each once for a task."""
    def run(batches):
        shingle, seen = Shingler(width), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = {}
                for t in batch.column(0).slice(at, 512).to_pylist():
                    s = shingle(t)
                    if len(s) and (d := _digest(s)) not in seen:
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(d)
                        part[d] = s
                names, part = list(part), list(part.values())
                points = [point(s) for s in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array([len(s) for s in part], pa.int32()),
                     pa.array([coarse(p) for p in points], pa.list_(pa.int32())),
                     pa.array([_shut(p) for p in points], pa.binary()),
                     pa.array([_zip(s) for s in part], pa.binary())], ["cls", "n", "box", "point", "items"])
    return run


def likely(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the only column of ``keys``: all
    that are, and a few that are not.  A bitmap of ``BITS`` bits is all that is
    broadcast, whatever the number of keys; a join decides afterwards."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    page = 1 << 15  # bits that Spark's bitmap aggregate holds
    at = keys.select(place(F.col(keys.columns[0])).alias("_at"))
    bits = at.groupBy((F.col("_at") / page).cast("int").alias("_page")).agg(
        F.bitmap_construct_agg(F.col("_at") % page).alias("_bits"))
    at = place(F.col(key))
    byte = F.conv(F.hex(F.substr(F.col("_bits"), ((at % page) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    j = df.join(F.broadcast(bits), (at / page).cast("int") == F.col("_page"))
    return j.where(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0).select(*df.columns)


def reaches(bound: Column, a: Column, b: Column, num: int, den: int) -> Column:
    """Whether an overlap of ``bound`` is enough for sizes a and b."""
    return bound * F.lit(num + den) >= (a + b) * F.lit(num)


def overlap_bound(a: str, b: str) -> Column:
    """Sum of the smaller coordinates of two points or boxes."""
    return F.aggregate(F.zip_with(F.col(a), F.col(b), lambda x, y: F.least(x, y).cast("long")),
                       F.lit(0).cast("long"), lambda s, x: s + x)


def _verify(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = _unzip(x.as_py()), _unzip(y.as_py())
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep.append(both * (num + den) >= num * (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _bounded(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that their points do not rule out."""
    def bound(batches):
        for batch in batches:
            ok = [int(np.minimum(_opened(x.as_py()), _opened(y.as_py())).sum(dtype=np.int64)) * (num + den) >= num * n.as_py()
                  for x, y, n in zip(*(batch.column(k) for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda k: sets.select(F.col("cls").alias(k), F.col("n").alias(f"n{k}"), F.col("point").alias(f"p{k}"))
    j = pairs.join(side("b").hint("merge"), "b").join(side("a").hint("merge"), "a")
    least, most = F.least("na", "nb"), F.greatest("na", "nb")
    return (j.where(least * den >= most * num).select("a", "b", "pa", "pb", (F.col("na") + F.col("nb")).cast("long").alias("n"))
            .mapInArrow(bound, _PAIRS))


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that link on their full sets."""
    pairs = staged(pairs)
    side = lambda k, to: likely(sets, "cls", pairs.select(k)).select(F.col("cls").alias(k), F.col("items").alias(to))
    return (pairs.join(side("b", "y").hint("merge"), "b").join(side("a", "x").hint("merge"), "a").select("a", "b", "x", "y")
            .mapInArrow(_verify(num, den), _PAIRS))


# ------------------------------------------------------------------- R-tree

def build_tree(members: DataFrame) -> list[DataFrame]:
    """R-trees over ``comp, cls, label, n, box, point``, one for each ``comp``, packed
    bottom up in the order of label, size and coordinates.

    Returns the levels from the leaves up.  Leaves: ``comp, id, sets`` (the
    members).  Boxes over leaves and above: ``comp, id, parent, label, low, n,
    box``: ``box`` the largest coordinates below, ``low`` and ``n`` the smallest
    and largest size, ``label`` null where several labels lie below."""
    order = [F.col("comp"), F.col("label"), F.col("n"), *[F.col("box")[k] for k in range(2)], F.col("cls")]
    d = staged(range_numbered(members, order, "rn"))
    first = staged(d.groupBy("comp").agg(F.min("rn").alias("start"), F.count(F.lit(1)).alias("size")))
    d = d.join(first.select("comp", "start"), "comp")
    d = d.withColumn("id", F.floor((F.col("rn") - F.col("start")) / LEAF))
    leaves = staged(d.groupBy("comp", "id").agg(F.collect_list(F.struct("cls", "label", "n", "point")).alias("sets")))
    below = d.select("comp", F.col("id").alias("parent"), "label", F.col("n").alias("low"), "n", "box")
    levels, count, fan = [leaves], first.agg(F.max("size")).first()[0] or 0, LEAF
    while True:
        boxes = below.groupBy("comp", F.col("parent").alias("id")).agg(
            F.min("low").alias("low"), F.max("n").alias("n"),
            F.when((F.count("label") == F.count(F.lit(1))) & (F.min("label") == F.max("label")),
                   F.min("label")).alias("label"),
            F.array(*[F.max(F.col("box")[k]) for k in range(GROUPS)]).alias("box"))
        below = staged(boxes.withColumn("parent", F.floor(F.col("id") / FANOUT)))
        levels.append(below)
        count, fan = math.ceil(count / fan), FANOUT
        if count <= 1:
            return levels


_MEMBERS = "x long, y long, cls binary, label binary"


def _compare(num: int, den: int):
    """Pairs of two leaves: the members with a pair of different labels that the
    points do not rule out."""
    def unfold(sets):
        v = sets.values
        labels = np.array([x.as_py() for x in v.field("label")], object)
        points = [_opened(x.as_py()) for x in v.field("point")]
        points = np.array(points, np.uint8 if all(p.dtype == np.uint8 for p in points) else np.int32)
        return [x.as_py() for x in v.field("cls")], labels, v.field("n").to_numpy().astype(np.int64), points

    def run(batches):
        for batch in batches:
            for comp, x, y, left, right in zip(*(batch.column(k) for k in range(5))):
                ca, la, na, pa_ = unfold(left)
                cb, lb, nb, pb = unfold(right)
                bound = np.array([np.minimum(p, pb).sum(axis=1, dtype=np.int64) for p in pa_])
                ok = (bound * (num + den) >= num * np.add.outer(na, nb)) & (la[:, None] != lb[None, :])
                ok &= np.minimum.outer(na, nb) * den >= np.maximum.outer(na, nb) * num
                need = dict(zip([ca[i] for i in np.flatnonzero(ok.any(axis=1))], la[ok.any(axis=1)]))
                need |= dict(zip([cb[i] for i in np.flatnonzero(ok.any(axis=0))], lb[ok.any(axis=0)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([comp.as_py()] * len(need), pa.binary()), pa.array([x.as_py()] * len(need), pa.int64()),
                     pa.array([y.as_py()] * len(need), pa.int64()), pa.array(list(need), pa.binary()),
                     pa.array(list(need.values()), pa.binary())], ["comp", "x", "y", "cls", "label"])
    return run


def _settle(num: int, den: int):
    """Members of two leaves: links on their full sets, one for each two labels
    that are not yet joined here."""
    def run(t: pa.Table) -> pa.Table:
        rows = sorted(t.select(["cls", "label", "items"]).to_pylist(), key=lambda r: (r["label"], r["cls"]))
        sets = [_unzip(r["items"]) for r in rows]
        top = {r["label"]: r["label"] for r in rows}

        def root(x):
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        size = np.array([len(s) for s in sets])
        out = []
        for i, r in enumerate(rows):
            mine = root(r["label"])
            near = [j for j in range(i + 1, len(rows)) if root(rows[j]["label"]) != mine
                    and min(size[i], size[j]) * den >= max(size[i], size[j]) * num]
            if not near:
                continue
            flat = np.concatenate([sets[j] for j in near])
            at = np.searchsorted(sets[i], flat)
            at[at == size[i]] = 0
            hit = (sets[i][at] == flat).astype(np.int64)
            both = np.add.reduceat(hit, np.cumsum([0, *size[near][:-1]]))
            for j, n in zip(near, both):
                if n * (num + den) >= num * (size[i] + size[j]) and root(rows[j]["label"]) != root(r["label"]):
                    top[root(rows[j]["label"])] = root(r["label"])
                    out.append((r["cls"], rows[j]["cls"]))
        return pa.table([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], ["a", "b"])
    return run


def tree_members(levels: list[DataFrame], num: int, den: int) -> DataFrame:
    """``comp, x, y, cls, label``: for each pair of leaves, the members with a
    partner of a different label there that no bound rules out.  From the root
    down, a pair of nodes is followed only if their boxes may hold a linked pair
    of different labels."""
    pairs = levels[-1].where("label is null").select("comp", F.col("id").alias("x"), F.col("id").alias("y"))
    for level in levels[-2:0:-1]:
        left = level.select("comp", F.col("parent").alias("x"), F.col("id").alias("a"), F.col("label").alias("la"),
                            F.col("low").alias("lowa"), F.col("n").alias("na"), F.col("box").alias("pa"))
        right = level.select("comp", F.col("parent").alias("y"), F.col("id").alias("b"), F.col("label").alias("lb"),
                             F.col("low").alias("lowb"), F.col("n").alias("nb"), F.col("box").alias("pb"))
        j = pairs.join(left, ["comp", "x"]).join(right, ["comp", "y"])
        # within one node each pair of children once (a node with itself too)
        once = (F.col("x") < F.col("y")) | (F.col("a") <= F.col("b"))
        apart = F.coalesce(F.col("la") != F.col("lb"), F.lit(True))
        sizes = (F.col("na") * den >= F.col("lowb") * num) & (F.col("nb") * den >= F.col("lowa") * num)
        leasta = F.greatest(F.col("lowa").cast("long"), F.ceil(F.col("lowb") * F.lit(num) / den))
        leastb = F.greatest(F.col("lowb").cast("long"), F.ceil(F.col("lowa") * F.lit(num) / den))
        j = j.where(once & apart & sizes & reaches(overlap_bound("pa", "pb"), leasta, leastb, num, den))
        pairs = staged(j.select("comp", F.col("a").alias("x"), F.col("b").alias("y")))
    leaves = levels[0]
    j = (pairs.join(leaves.select("comp", F.col("id").alias("x"), F.col("sets").alias("left")), ["comp", "x"])
         .join(leaves.select("comp", F.col("id").alias("y"), F.col("sets").alias("right")), ["comp", "y"]))
    return j.select("comp", "x", "y", "left", "right").mapInArrow(_compare(num, den), f"comp binary, {_MEMBERS}")


def tree_links(levels: list[DataFrame], sets: DataFrame, num: int, den: int) -> DataFrame:
    """Verified links ``a, b`` that join the labels of every tree."""
    m = staged(tree_members(levels, num, den))
    m = m.join(likely(sets, "cls", m.select("cls")).select("cls", "items").hint("merge"), "cls")
    return m.groupBy("comp", "x", "y").applyInArrow(_settle(num, den), _PAIRS)


def _families(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``comp, cls, label``: what may belong to one component beyond its links.

    A family is a component (its label) and all that hold a key of three or more
    holders which one of its members leads (of two holders one leads, and that
    pair is settled).  A member that its own task linked to a leader there
    belongs to that one's leaders too.  Families of one label are left out."""
    of = lambda k: labels.select(F.col("cls").alias(k), F.col("label").alias(f"l{k}"))
    led = pairs.where("many").join(of("a"), "a", "left").withColumn("comp", F.coalesce("la", "a"))
    near = led.select("comp", F.col("b").alias("cls")).unionByName(led.select("comp", F.col("a").alias("cls"))).distinct()
    over = led.where("sent").select("comp", F.col("b").alias("l")).distinct()
    far = pairs.where("made").select(F.col("a").alias("l"), F.col("b").alias("cls")).join(over, "l").select("comp", "cls")
    f = near.unionByName(far).distinct().join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    f = staged(f.select("comp", "cls", "label"))
    apart = f.groupBy("comp").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("comp")
    return staged(f.join(apart, "comp", "left_semi"))


def jaccard_groups(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Per input row ``doc_id, n_shingles, component_id``.

    A document's set: its distinct ``width``-word shingles, or its whole word
    sequence when it is shorter.  Two documents link when den * intersection >=
    num * union.  ``component_id``: the smallest doc_id reachable by links, itself
    included.  A text without words (null, empty, blank) has an empty set and
    links with nothing.  Rows that repeat a doc_id belong to all of that id's
    links' components by their own text; a null doc_id counts only where no id is
    known in its component (null then).  An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("x"), "text")
    d = staged(docs.mapInArrow(_classify(width, num, den), _CLASSES))
    total = d.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    buckets = max(1, math.ceil(total / 8 / BUCKET_KEYS))
    rows = staged(d.select("doc_id", "x", "n_shingles", "cls"))
    sent = d.where("keys is not null").select("cls", "keys").mapInArrow(_send(buckets), _SENT)
    pairs = staged(sent.groupBy("bucket").applyInArrow(_match, _MET).groupBy("a", "b").agg(
        F.max("many").alias("many"), F.max("sent").alias("sent"), F.max(~F.col("sent")).alias("made"),
        F.count(F.lit(1)).alias("k")))
    release(d)

    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    # one row of each wanted class; a few more come along, and a class that comes
    # twice is only compared twice.  No table here has a bound on its size, so
    # none is broadcast.
    chosen = (rows.join(wanted.hint("merge"), "cls", "left_semi").groupBy("cls")
              .agg(F.min(F.struct("doc_id", "x")).alias("r")).select(F.xxhash64("r.doc_id", "r.x").alias("row")))
    sets = staged(likely(docs.select(F.xxhash64("doc_id", "x").alias("row"), "text"), "row", chosen).select("text")
                  .mapInArrow(_sets(width), _SETS))
    points = sets.select("cls", "n", "box", "point")

    # each class with one of its leaders, then only what that has not joined
    first = staged(pairs.groupBy("b").agg(F.max_by("a", F.struct("k", "a")).alias("a")).select("a", "b"))
    links = staged(_confirmed(_bounded(first, points, num, den), sets, num, den))
    labels = staged(components(links).withColumnsRenamed({"node": "cls"}))
    of = lambda k: labels.select(F.col("cls").alias(k), F.col("label").alias(f"l{k}"))
    rest = (pairs.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
            .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b").join(first, ["a", "b"], "left_anti"))
    links = staged(links.unionByName(_confirmed(_bounded(rest, points, num, den), sets, num, den)))
    labels = staged(components(links).withColumnsRenamed({"node": "cls"}))
    now = _families(pairs, labels)
    release(pairs)
    levels = build_tree(now.join(points, "cls"))
    joined = staged(tree_links(levels, sets, num, den))
    # labels that the trees have joined, as components of labels
    of = now.select("cls", "label").distinct()
    joined = (joined.join(of.select(F.col("cls").alias("a"), F.col("label").alias("x")), "a")
              .join(of.select(F.col("cls").alias("b"), F.col("label").alias("y")), "b")
              .select(F.col("x").alias("a"), F.col("y").alias("b")))
    over = components(joined).withColumnsRenamed({"node": "g", "label": "top"})
    named = rows.join(labels, "cls", "left").select("doc_id", "n_shingles", F.coalesce("label", "cls").alias("g"))
    named = staged(named.join(over, "g", "left").select("doc_id", "n_shingles", F.coalesce("top", "g").alias("g")))
    release(sets, now, *levels)
    least = named.where("g is not null").groupBy("g").agg(F.min("doc_id").alias("least"))
    return named.join(least, "g", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
