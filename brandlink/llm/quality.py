"""Quality rules combined by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0).  The documents are counted
by vote pattern (one small aggregate); expectation-maximisation over the
pattern counts estimates how each rule votes on good and on bad documents, and
a document is kept when its posterior quality probability is high enough.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import space_words, staged

#: Frequent function words of the corpus' languages (a fixed list).
FUNCTION_WORDS = (
    "the of and to in is that for on with a as was by it from be are this at or an "
    "le la les de des et un une du que qui dans est pour en "
    "der die das und ein eine nicht mit von zu den ist auf für "
    "el los las y que en por con para una del se no").split()


def _window_hashes(width: int = 5) -> Column:
    """64-bit hashes of the ``width``-word windows of the word array ``_w``."""
    hashes = F.expr(f"""transform(sequence(0, size(_w) - {width}), i ->
        xxhash64({', '.join(f'get(_w, i + {k})' for k in range(width))}))""")
    return F.when(F.size("_w") >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(width: int = 5) -> Column:
    """Number of words that lie in a window found twice or more.

    ``_s``: (hash, start) in order.  The starts of repeated windows, in order,
    each cover ``width`` words less the overlap with what the earlier ones
    cover; nothing is quadratic in the text's length.
    """
    return F.expr(f"""
      case when size(_h) = 0 or size(array_distinct(_h)) = size(_h) then 0L
      else aggregate(
        array_sort(transform(filter(_s, (x, i) -> x.h = get(_s, i - 1).h or x.h = get(_s, i + 1).h),
                             x -> x.i)),
        named_struct('n', 0L, 'end', 0),
        (a, p) -> named_struct('n', a.n + {width} - greatest(0, a.end - p), 'end', p + {width}),
        a -> a.n) end""")


def quality_signals(docs: DataFrame, *keep: str) -> DataFrame:
    """The contract's base counts and the signals the rules read, per row.

    Null text counts as no text: every count is 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(*keep, text.alias("_t"))
    d = d.withColumn("_w", space_words(F.col("_t")))
    d = d.withColumn("_h", _window_hashes())
    d = d.withColumn("_s", F.expr(
        """case when size(array_distinct(_h)) < size(_h)
           then array_sort(transform(_h, (x, i) -> named_struct('h', x, 'i', i)))
           else array() end"""))
    d = d.withColumn("_l", F.expr(r"filter(split(_t, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    words = F.size("_w").cast("long")
    chars = F.length(F.regexp_replace("_t", r"[\x20\x09-\x0D]+", "")).cast("long")
    sym = F.expr(r"regexp_count(_t, '[#*$%&|<>]')").cast("long")
    dup = (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long")
    common = F.size(F.array_intersect(
        "_w", F.array(*[F.lit(x) for x in FUNCTION_WORDS]))).cast("long")
    return d.select(*keep, words.alias("n_words"), chars.alias("word_chars"),
                    sym.alias("n_symbols"), dup.alias("n_dup_lines"),
                    F.size("_l").cast("long").alias("n_lines"),
                    _covered().cast("long").alias("n_repeat_words"),
                    common.alias("n_function_words"),
                    F.expr(r"regexp_count(_t, '[.!?]([\\x20\\x09-\\x0D]|$)')").cast("long").alias("n_sentences"))


def votes() -> dict[str, Column]:
    """Rule name -> vote (1 good, -1 bad, 0 abstain) over the signals."""
    c = F.col
    mean = c("word_chars") / F.greatest(c("n_words"), F.lit(1))

    def bad(when: Column) -> Column:
        return F.when(when, -1).otherwise(0)

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    enough = c("n_words") >= 10
    return {
        "length": vote(c("n_words") >= 40, ~enough),
        "word_length": bad(enough & ~mean.between(2.2, 14)),
        "symbols": bad(c("n_symbols") * 10 > c("n_words")),
        "dup_lines": bad(c("n_dup_lines") * 10 > c("n_lines") * 3),
        "repeat_words": bad(c("n_repeat_words") * 5 > c("n_words")),
        "function_words": vote(c("n_function_words") >= 3,
                               (c("n_words") >= 30) & (c("n_function_words") <= 1)),
        "sentences": vote(enough & (c("n_sentences") * 50 >= c("n_words")),
                          (c("n_words") >= 30) & (c("n_sentences") == 0)),
    }


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100,
                    smooth: float = 1.0) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """EM over (vote pattern, count): prior of good, and for each rule and vote
    the smoothed P(vote | good), P(vote | bad).

    There are at most 3 ** rules patterns, whatever the corpus.  It starts from
    the votes' sum in which a bad vote counts three times: bad texts fail in
    different ways, so most rules abstain on each of them.  No documents: a prior of one half and rules
    that say nothing.
    """
    m = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    post = [1 / (1 + math.exp(-2.0 * sum(x if x > 0 else 3 * x for x in v))) for v, _ in patterns]
    prior, tables = 0.5, [dict.fromkeys((-1, 0, 1), (1 / 3, 1 / 3)) for _ in range(m)]
    for _ in range(rounds):
        good = sum(p * n for p, (_, n) in zip(post, patterns))
        prior = (good + smooth) / (total + 2 * smooth)
        for j in range(m):
            t = {}
            for v in (-1, 0, 1):
                g = sum(p * n for p, (x, n) in zip(post, patterns) if x[j] == v)
                a = sum(n for x, n in patterns if x[j] == v)
                t[v] = ((g + smooth) / (good + 3 * smooth), (a - g + smooth) / (total - good + 3 * smooth))
            # a rule is no worse than chance: good votes never speak against quality
            for v, best in ((1, max), (-1, min)):
                pg, pb = t[v]
                if best(pg, pb) != pg:
                    t[v] = ((pg + pb) / 2,) * 2
            t[0] = ((t[0][0] + t[0][1]) / 2,) * 2  # abstaining says nothing
            tables[j] = t
        new = []
        for x, _ in patterns:
            z = math.log(prior / (1 - prior)) + sum(math.log(t[v][0] / t[v][1]) for t, v in zip(tables, x))
            new.append(1 / (1 + math.exp(-max(-50.0, min(50.0, z)))))
        if max((abs(a - b) for a, b in zip(new, post)), default=0) < 1e-9:
            break
        post = new
    return prior, tables


def judge_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per input row: ``doc_id``, the base counts, ``base_failed``, ``quality``
    (posterior probability) and ``kept``.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in
    repeated windows.  Null and empty texts fail.  An empty table gives no rows;
    repeated rows are judged each on its own, alike.
    """
    rules = votes()
    names = [f"v_{k}" for k in rules]
    d = staged(quality_signals(docs, "doc_id").withColumns(
        {f"v_{k}": v for k, v in rules.items()}))
    counted = d.groupBy(*names).count().collect()  # at most 3 ** len(rules) rows
    prior, tables = fit_label_model([(tuple(r[n] for n in names), r["count"]) for r in counted])
    z = F.lit(math.log(prior / (1 - prior)))
    for n, t in zip(names, tables):
        for v in (-1, 1):
            z = z + F.when(F.col(n) == v, math.log(t[v][0] / t[v][1])).otherwise(0.0)
    d = d.withColumn("quality", F.round(1 / (1 + F.exp(-z)), 9))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", failed.alias("base_failed"), "quality",
                    (~failed & (F.col("quality") >= threshold)).alias("kept"))
