"""Document fingerprints from closed syncmers.

A text is cut into units (pieces of at most 16 code points of its words).  A
window of ``K`` units is a closed syncmer when the smallest hash among its
inner windows of ``S`` units lies at its first or last place.  The choice
depends on the window alone, so equal passages choose equal anchors wherever
they stand, and at least one anchor starts in every ``K - S`` + 1 places.

The fingerprint keeps, for each of ``SLOTS`` classes of anchor hashes, the
smallest hash of the whole text (one-permutation minhash).  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import range_numbered, staged

K, S, SLOTS = 5, 2, 64
UNIT = r"[^\\x20\\x09-\\x0D]{1,16}"


def unit_hashes(text: str) -> Column:
    return F.expr(f"transform(regexp_extract_all({text}, '{UNIT}', 0), x -> hash(x))")


def anchors(units: str) -> Column:
    """Array of anchor hashes of the unit-hash array column ``units``.

    A text of fewer than ``K`` units, or of so few more that no window is a
    closed syncmer, has one anchor, its whole unit sequence; a text without
    units has none.
    """
    inner = K - S + 1
    at = [f"get(s, i + {k})" for k in range(inner)]
    edge = f"least({at[0]}, {at[-1]})"
    mid = f"least({', '.join(at[1:-1])})"
    return F.expr(f"""
      case when size({units}) = 0 then array()
      when size({units}) < {K} then array(xxhash64({units}))
      else transform(array(filter(transform(
        array(transform(sequence(0, size({units}) - {S}),
              i -> hash({', '.join(f'get({units}, i + {k})' for k in range(S))}))),
        s -> transform(sequence(0, size(s) - {inner}),
             i -> case when {edge} <= {mid}
                  then xxhash64({', '.join(f'get({units}, i + {k})' for k in range(K))}) end))[0],
        h -> h is not null)), a -> if(size(a) = 0, array(xxhash64({units})), a))[0] end""")


def sketch(hashes: str) -> Column:
    """The smallest hash of each slot, slot number in the top bits, in slot
    order; an empty slot is left out."""
    return F.expr(f"""transform(array(sort_array(transform(array_distinct({hashes}), h ->
          shiftleft(h & {SLOTS - 1}L, 57) | shiftrightunsigned(h, 7)))),
        s -> filter(s, (x, i) -> i = 0 or shiftright(x, 57) <> shiftright(get(s, i - 1), 57)))[0]""")


def likeness(a: str, b: str) -> Column:
    """Share of the slots filled in either sketch that hold the same hash."""
    slots = (f"size(array_union(transform({a}, x -> shiftright(x, 57)), "
             f"transform({b}, x -> shiftright(x, 57))))")
    return F.expr(f"""case when size({a}) = 0 and size({b}) = 0 then 1.0D
        else size(array_intersect({a}, {b})) / cast({slots} as double) end""")


def shown(a: str) -> Column:
    return F.expr(f"concat_ws('', transform({a}, x -> lpad(hex(x), 16, '0')))")


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the sketch array ``out`` of a text column."""
    return (df.withColumn("_u", unit_hashes(text)).withColumn("_a", anchors("_u"))
            .withColumn(out, sketch("_a")).drop("_u", "_a"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per input row ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text: the last floor(n_chars / 3) code points give way to the
    first as many (or all) of the next document, in descending doc_id; the
    first document follows the last.  Only ids are put in order; the next
    document's head and sketch then travel to the row that asks for them.

    Null texts count as empty; null ids come last.  Rows that share a doc_id
    follow each other in the order of their texts' hashes; rows equal in both
    are one document and give equal rows.  Two texts without words are alike
    (1.0).  One document is its own next.  An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("_text"))
    d = d.withColumn("_x", F.xxhash64("_text"))
    ids = (d.select("doc_id", "_x", (F.length("_text") / 3).cast("int").alias("_ask"))
           .dropDuplicates(["doc_id", "_x"]))
    ids = staged(range_numbered(ids, [F.col("doc_id").desc_nulls_last(), F.col("_x")], "rn"))
    total = max(ids.count(), 1)
    gives = ids.select(F.col("doc_id").alias("_gid"), F.col("_x").alias("_gx"),
                       ((F.col("rn") + total - 1) % total).alias("rn"))
    links = gives.join(ids, "rn").select(
        "_gid", "_gx", F.col("doc_id").alias("_rid"), F.col("_x").alias("_rx"), "_ask")
    heads = (d.join(links, F.col("doc_id").eqNullSafe(F.col("_gid")) & (F.col("_x") == F.col("_gx")))
             .select("_rid", "_rx", F.expr("substring(_text, 1, _ask)").alias("_head"), "_text"))
    heads = with_sketch(heads, "_text", "_fn").drop("_text").dropDuplicates(["_rid", "_rx"])
    j = d.join(heads, F.col("doc_id").eqNullSafe(F.col("_rid")) & (F.col("_x") == F.col("_rx")))
    j = j.withColumn("n_chars", F.length("_text").cast("long"))
    j = j.withColumn("_edited", F.expr(
        "concat(substring(_text, 1, cast(n_chars - int(n_chars / 3) as int)), _head)"))
    j = with_sketch(with_sketch(j, "_text", "_f"), "_edited", "_e")
    return j.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        shown("_f").alias("fingerprint"), shown("_e").alias("edited_fingerprint"),
        likeness("_f", "_e").alias("near_edited"), likeness("_f", "_fn").alias("near_next"))
