"""Conversation structure repair by depth-first branch-and-bound.

A conversation's turns are kept, given another role, deleted, or joined by
inserted ones until the roles read ``(s?(ua)+)?``.  The search runs over nodes
(turns consumed, state of the pattern) with an explicit stack.  A suffix lower
bound for every node, the incumbent (cost, audit), and a dominance table of the
cheapest prefix that reached each node cut the tree until no open prefix can
beat the incumbent.  Children are visited in ASCII order of their edits, so of
equal costs the first audit found is the least.

Only a byte per turn enters the search; texts stay in their rows.  A repaired
conversation's hash is made from a sorted stream of its rows, never from a
conversation held as a whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, range_numbered, staged

#: Costs fixed by the task.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: Fixed by the task: what counts as white space in a turn.
BLANKS = r"\x20\x09-\x0D"

# states of the pattern: nothing yet, after s, after u, after a
_START, _S, _U, _A = range(4)
_NEXT = (_U, _U, _A, _U)          # the state after the role that must come
_ROLE = ("user", "user", "assistant", "user")
_END = (0, 2 * INSERT, INSERT, 0)  # cheapest way to end in each state
_FAR = 1 << 60

# a turn's code: initial (0 other, 1 s, 2 u, 3 a) + 4 * fault (0 none, 1 truncated, 2 blank or duplicate)


def _edits(code: int, state: int):
    """Edits of a turn in a state, in ASCII order: initial, cost, next state
    (an insertion is put among them by the caller)."""
    out = [("D", DELETE, state)]
    fault, initial = code >> 2, code & 3
    if fault < 2:
        more = CUT_OFF if fault else 0
        if initial == 1 and state == _START:
            out.append(("K", more, _S))
        elif initial > 1 and _NEXT[state] == (_U if initial == 2 else _A):
            out.append(("K", more, _NEXT[state]))
        out.append(("R", REROLE + more, _NEXT[state]))
    return out


def suffix_bounds(codes: bytes) -> list[list[int]]:
    """Least cost from each node to an accepted end, ties left open."""
    bounds = [list(_END)]
    for code in reversed(codes):
        after, here = bounds[-1], []
        for state in range(4):
            here.append(min(cost + after[to] for _, cost, to in _edits(code, state)))
        # insertions lead from state to state before the same turn
        for _ in range(3):
            here = [min(here[q], INSERT + here[_NEXT[q]]) for q in range(4)]
        bounds.append(here)
    return bounds[::-1]


def search(codes: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least audit of that cost."""
    n, bounds = len(codes), suffix_bounds(codes)
    path = bytearray()
    best_cost, best = _FAR, ""
    table = [[_FAR] * 4 for _ in range(n + 1)]
    stack = [(0, _START, 0, 0, "")]
    limit = bounds[0][_START]
    while stack:
        at, state, cost, depth, edit = stack.pop()
        if edit:
            del path[depth - 1:]
            path.append(ord(edit))
        # a later prefix is larger in ASCII: it must be cheaper to matter
        if cost >= table[at][state] or cost + bounds[at][state] >= best_cost or cost + bounds[at][state] > limit:
            continue
        table[at][state] = cost
        if at == n and state in (_START, _A):
            best_cost, best = cost, path.decode("ascii")
            continue
        children = [(at, _NEXT[state], cost + INSERT, depth + 1, "I")]
        if at < n:
            children += [(at + 1, to, cost + c, depth + 1, e) for e, c, to in _edits(codes[at], state)]
        stack += sorted(children, key=lambda x: x[4], reverse=True)
    return best_cost, best


def replay(codes: bytes, audit: str):
    """The audit's edits by turn: for each turn (and the end, n) the initials of
    the insertions before it, its own edit, and the new role of each."""
    state, at, inserts, out = _START, 0, [], []
    for e in audit:
        if e == "I":
            inserts.append(_ROLE[state])
            state = _NEXT[state]
            continue
        role = None
        if e == "R":
            role, state = _ROLE[state], _NEXT[state]
        elif e == "K":
            state = _S if codes[at] & 3 == 1 else _NEXT[state]
        out.append((at, e, role, inserts))
        inserts, at = [], at + 1
    return out + [(at, "E", None, inserts)]


_EDITS = "conv long, cost long, audit string, edits array<struct<pos:long,edit:string,role:string,before:array<string>>>"


def _search_all(batches):
    kind = pa.list_(pa.struct([("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                               ("before", pa.list_(pa.string()))]))
    known = {}  # short conversations repeat
    for batch in batches:
        for x in range(0, batch.num_rows, 1000):
            part = batch.slice(x, 1000)
            cost, audit, edits = [], [], []
            for codes in part.column(1):
                codes = bytes(codes.as_py())
                if codes not in known:
                    if len(known) > 20_000:
                        known.clear()
                    known[codes] = search(codes)
                c, a = known[codes]
                cost.append(c)
                audit.append(a)
                edits.append([dict(zip(("pos", "edit", "role", "before"), r)) for r in replay(codes, a)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(edits, kind)],
                ["conv", "cost", "audit", "edits"])


def _digest(batches):
    """One hash for each conversation of the sorted lines; a conversation may
    span batches, and only its running hash is held."""
    conv, h = None, None
    for batch in batches:
        ids, out = [], []
        for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if h is None or c != conv:
                if h is not None:
                    ids.append(conv)
                    out.append(h.hexdigest())
                conv, h = c, hashlib.sha256()
                h.update(line.encode("utf-8", "surrogatepass"))
            else:
                h.update(b"\n" + line.encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())],
                                         ["conv", "repaired_sha256"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([h.hexdigest()], pa.string())],
                                         ["conv", "repaired_sha256"])


def _shown(c: str) -> Column:
    """A column as text; null is one space."""
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that crc32(conv_id:turn) %
    20 asks for: 0 the turn is gone, 1 its text is empty, 2 its ``.!?`` are gone,
    3 it stands twice, 4 its role is user."""
    kind = F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn")).cast("binary")) % 20
    d = rows.select("conv_id", "turn", _shown("role").alias("role"), _shown("text").alias("text"),
                    kind.alias("kind")).where("kind <> 0")
    d = d.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                 F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                 .otherwise(F.col("text")).alias("text"),
                 F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return d.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def _faults(turns: DataFrame) -> DataFrame:
    """Adds ``pos`` (0 ... in the conversation ``conv``), ``fault`` and the
    search's ``code`` to turns with a number ``rn`` in the order of all."""
    first = turns.groupBy("conv").agg(F.min("rn").alias("start"))
    d = turns.join(first, "conv").withColumn("pos", F.col("rn") - F.col("start")).drop("rn", "start")
    # the same role and text earlier: by a hash, so that no text is a shuffle key
    d = d.withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    early = d.groupBy("conv", "same").agg(F.min("pos").alias("first"))
    d = d.join(early, ["conv", "same"])
    last = F.right(F.rtrim("text", F.lit(SPACE_CHARS)), F.lit(1))
    blank = ~F.col("text").rlike(f"[^{BLANKS}]")
    d = d.withColumn("fault", F.when(blank, "blank").when(F.col("first") < F.col("pos"), "duplicate")
                     .when(~last.isin(".", "!", "?"), "truncated").otherwise("none"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    weight = F.when(F.col("fault") == "truncated", 1).when(F.col("fault") == "none", 0).otherwise(2)
    return d.select("conv", "pos", "turn", "role", "text", "fault", initial.alias("initial"),
                    (letter + 4 * weight).cast("int").alias("code"))


def repair_conversations(rows: DataFrame):
    """The turns' repair: (summary, lines).

    ``rows``: ``conv_id, turn, role, text`` (other columns are left aside); a
    null text, role or conv_id counts as one space, a null turn comes first and
    has no number.  Turns of one number stand by role, then text.  The null
    conv_id is a conversation of its own.

    summary, one row for each conv_id: ``gaps, blank, duplicate, truncated,
    illegal, cost, audit``.  lines: ``conv_id, conv, pos, at, role, text``, the repaired
    turns in the order of (pos, at).  A role without a first letter s, u or a
    (an empty one too) cannot be kept.
    """
    # rows equal in all else are told apart, so that many of them are dealt to several ranges
    d = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"))
    turns = staged(range_numbered(
        d, [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "tie"], "rn").drop("tie"))
    # a conversation's number: the least row number, so null is a conversation too
    convs = turns.groupBy("conv_id").agg(F.min("rn").alias("conv"))
    convs = staged(convs.select("conv_id", "conv"))
    turns = turns.join(convs.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")))
    turns = staged(_faults(turns.drop("_id", "conv_id")))

    prior = turns.select("conv", (F.col("pos") + 1).alias("pos"), F.col("initial").alias("prior"))
    legal = F.concat("prior", "initial").isin("su", "ua", "au")
    broken = (turns.select("conv", "pos", "initial").join(prior, ["conv", "pos"])
              .groupBy("conv").agg(F.sum((~legal).cast("long")).alias("illegal")))
    number = F.col("turn").cast("decimal(38,0)")
    counts = turns.groupBy("conv").agg(
        F.coalesce((F.max(number) - F.min(number) + 1 - F.countDistinct("turn")).try_cast("long"), F.lit(0)).alias("gaps"),
        *[F.sum((F.col("fault") == k).cast("long")).alias(k) for k in ("blank", "duplicate", "truncated")])
    codes = turns.groupBy("conv").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]).alias("codes"))
    found = staged(codes.mapInArrow(_search_all, _EDITS))
    summary = (convs.join(counts, "conv").join(found.select("conv", "cost", "audit"), "conv")
               .join(broken, "conv", "left").withColumn("illegal", F.coalesce("illegal", F.lit(0))))

    edits = found.select("conv", F.explode("edits").alias("e")).select("conv", "e.*")
    kept = (turns.join(edits.where(F.col("edit").isin("K", "R")), ["conv", "pos"])
            .select("conv", "pos", F.lit(1 << 30).alias("at"),
                    F.coalesce(edits.role, turns.role).alias("role"), "text"))
    added = (edits.where(F.size("before") > 0).select("conv", "pos", F.posexplode("before").alias("at", "role"))
             .withColumn("text", F.lit("")))
    return summary, kept.unionByName(added)


def hashed(lines: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of the ``role:text`` lines.  A hash has to see
    its conversation in order; rows are sorted by Spark (which spills) and
    streamed through the hash."""
    line = lines.select("conv", F.concat("role", F.lit(":"), "text").alias("line"), "pos", "at")
    return (line.repartition("conv").sortWithinPartitions("conv", "pos", "at").select("conv", "line")
            .mapInArrow(_digest, "conv long, repaired_sha256 string"))


def repaired(rows: DataFrame) -> DataFrame:
    """Damages ``rows`` and repairs them; one row for each original conv_id:
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``.  A conversation without turns after the damage has
    zeros, an empty audit and the hash of nothing.  An empty table gives no rows."""
    summary, lines = repair_conversations(damage(rows))
    out = summary.join(hashed(lines), "conv", "left").drop("conv").withColumnRenamed("conv_id", "_id")
    every = rows.select("conv_id").distinct()
    j = every.join(out, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    zero = [F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return j.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
