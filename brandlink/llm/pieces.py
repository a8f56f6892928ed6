"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into words, only between two characters that no piece on a best
path holds side by side, so the best paths of the words make up the text's (a
run of spaces goes with the word after it; marks that end a word are cut off
after a letter that no piece holds before them; runs of more than ``WORD`` code
points are cut wherever they can be).  Spark deals the distinct words of each
block of documents by their text and sorts them, so equal words stand together;
in a batch of distinct words every place is joined with the rows (prefix,
character) of the piece table, character by character, less the pieces that
cannot be on a best path.  The joined edges are folded by their ends, all words
of the batch at once: the path with the highest sum of piece scores (Viterbi).
A word that is still longer than ``WORD`` is folded place by place, which takes
time in proportion to its length.  The ids go
back to the blocks, whose documents take the pieces of their words.  A code point that no piece covers falls
back to its UTF-8 byte pieces, so decoding gives the text back exactly.
"""

from __future__ import annotations

import hashlib
import re
import string
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_words, code_blocks
from .common import release, staged
from .packing import pack, runs, unpack

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD = 48                     # code points of a word that is folded with others
BATCH = 4096                  # words that are folded together
MEET = 200_000                # words of all blocks that are answered together
BLOCK = 6_000_000             # words of a block: the larger, the fewer times a word is asked for
SPACE = "▁"              # stands for a space in pieces
_WORDS = re.compile(r" *[^ \n]+| +|\n")
#: A mark that is itself in the text must not match the pieces' space.
_KEYS = str.maketrans(SPACE + " ", "\uffff" + SPACE)


class PieceTable:
    """A SentencePiece model's pieces: surfaces, scores and byte pieces."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces, self.bytes, self.surface = [], [sp.unk_id()] * 256, [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:5], 16)
                self.bytes[b], self.surface[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = sp.id_to_piece(i)
                self.pieces.append((piece, i, float(sp.get_score(i))))
                self.surface[i] = piece.replace(SPACE, " ").encode()
        self.fallback = min((p[2] for p in self.pieces), default=0.0) - 10.0
        self.useful = self._useful()
        self.longest = max((len(p[0]) for p in self.pieces), default=1)
        self.marks = dict.fromkeys(string.punctuation, "")
        self.pairs = {a + b for p in self.useful for a, b in zip(p[0], p[0][1:])}
        for a, b in sorted(self.pairs):
            if b in self.marks and a.isalpha():
                self.marks[b] += a
        # whether texts may be cut before spaces and around newlines
        self.spaced = not any("\n" in x or x[1] == SPACE != x[0] for x in self.pairs)

    def _useful(self) -> list[tuple[str, int, float]]:
        """The pieces that can be on a best path.  A piece whose own text has a
        strictly better path of shorter pieces is on none, in any word."""
        known, out = {}, []
        for piece, i, score in sorted(self.pieces, key=lambda p: len(p[0])):
            best = [0.0]
            for e in range(1, len(piece) + 1):
                starts = range(1 if e == len(piece) and e > 1 else 0, e)
                best.append(max(best[s] + known.get(piece[s:e], self.fallback if e - s == 1 else -np.inf)
                                for s in starts))
            if len(piece) == 1 or score >= best[-1]:
                known[piece] = score
                out.append((piece, i, score))
        return out


def _make_tokens(marks: dict[str, str], pairs: set[str], spaced: bool):
    """Lattice words of a text.  ``marks``: marks, and the letters before them
    in pieces.  No edge crosses the place between another letter and the mark,
    so the marks that end a word are cut off there.  ``pairs``: the characters
    that pieces hold side by side; long words are cut between all others.
    ``spaced``: no piece crosses the places where ``_WORDS`` cuts."""
    ends = "".join(marks)

    def tokens(text):
        out = []
        for w in _WORDS.findall(text or "") if spaced else filter(None, [text]):
            if len(w) > WORD:
                k = w.translate(_KEYS)
                cuts = [0, *(i for i in range(1, len(w)) if k[i - 1:i + 1] not in pairs), len(w)]
                out += [w[a:b].encode() for a, b in zip(cuts, cuts[1:])]
                continue
            core = w.rstrip(ends)
            n = len(core)
            if 0 < n < len(w) and core[-1].isalpha() and core[-1] not in marks[w[n]]:
                out += (core.encode(), w[n:].encode())
            else:
                out.append(w.encode())
        return out
    return tokens


class Lattice:
    """The useful pieces as rows (prefix, character) -> prefix, sorted by both,
    and the id (-1: none) and score of the piece that a prefix is."""

    def __init__(self, table: PieceTable):
        prefix = {"": 0}
        for piece, _, _ in table.useful:
            for e in range(1, len(piece) + 1):
                prefix.setdefault(piece[:e], len(prefix))
        self.chars = np.unique(np.array([ord(x[-1]) for x in prefix if x], np.int64))
        self.ids, self.scores = np.full(len(prefix), -1, np.int32), np.zeros(len(prefix))
        for piece, i, score in table.useful:
            self.ids[prefix[piece]], self.scores[prefix[piece]] = i, score
        rank = {c: k for k, c in enumerate(self.chars.tolist())}
        rows = sorted((prefix[x[:-1]] * len(rank) + rank[ord(x[-1])], n) for x, n in prefix.items() if x)
        self.keys, self.to = np.array(rows, np.int64).reshape(-1, 2).T.copy()
        self.longest, self.fallback = table.longest, table.fallback

    @staticmethod
    def _found(known: np.ndarray, x: np.ndarray):
        """Place of each item among the sorted ones, and whether it is there."""
        at = np.searchsorted(known, x)
        at[at == len(known)] = 0
        return at, known[at] == x if len(known) else np.zeros(len(x), bool)

    def _edges(self, code: np.ndarray, end: np.ndarray):
        """(start, length, id, score) of all pieces in words of the code points
        ``code``; ``end``: the end of each place's word.  Each place has an edge
        of length 1: without a piece, its id is -1 - code point."""
        k = np.where(code == ord(SPACE), 0xFFFF, np.where(code == 32, ord(SPACE), code))  # as _KEYS
        rank, known = self._found(self.chars, k)
        at, state, out = np.arange(len(code)), np.zeros(len(code), np.int64), []
        for n in range(1, self.longest + 1):
            ok = at + n <= end[at]
            at, state = at[ok], state[ok]
            row, ok = self._found(self.keys, state * len(self.chars) + rank[at + n - 1])
            ok &= known[at + n - 1]
            at, state = at[ok], self.to[row[ok]]
            hit = np.flatnonzero(self.ids[state] >= 0)
            out.append((at[hit], n, self.ids[state[hit]], self.scores[state[hit]]))
            if not len(at):
                break
        none = np.ones(len(code), bool)
        if out:
            none[out[0][0]] = False
        none = np.flatnonzero(none)
        out.append((none, 1, (-1 - code[none]).astype(np.int32), np.full(len(none), self.fallback)))
        start, _, ids, scores = zip(*out)
        n = np.repeat([x[1] for x in out], [len(x) for x in start])
        return np.concatenate(start), n, np.concatenate(ids), np.concatenate(scores)

    def paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces of each word, and the ids of all words.  Of equal
        sums the piece that starts first wins."""
        text = b"".join(words).decode()
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(w.decode()) for w in words], np.int64)
        first = np.cumsum(size) - size
        word = np.repeat(np.arange(len(size)), size)
        start, n, ids, scores = self._edges(code, (first + size)[word])
        # a word of n code points has n + 1 nodes
        source = start + word[start]
        target, place = source + n, start - first[word[start]] + n
        nodes = len(code) + len(size)
        order = np.argsort((place * nodes + target) * (self.longest + 1) + self.longest - n)
        source, target, ids, scores = source[order], target[order], ids[order], scores[order]
        value, back, via = np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int32)
        cut = np.searchsorted(place[order], np.arange(1, int(size.max(initial=0)) + 2))
        for a, b in zip(cut, cut[1:]):
            t, v = target[a:b], value[source[a:b]] + scores[a:b]
            new = np.flatnonzero(np.diff(t, prepend=-1))
            top = np.maximum.reduceat(v, new)
            best = np.flatnonzero(v == np.repeat(top, np.diff(np.append(new, b - a))))
            best = best[np.diff(t[best], prepend=-1) > 0]   # the first of equal ones
            value[t[new]], back[t[new]], via[t[new]] = top, source[a:b][best], ids[a:b][best]
        zero = first + np.arange(len(size))
        live, at, steps = np.arange(len(size)), zero + size, []
        while len(live):
            steps.append((live, via[at]))
            at = back[at]
            go = at > zero[live]
            live, at = live[go], at[go]
        live = np.concatenate([x for x, _ in steps]) if steps else np.empty(0, np.int64)
        count = np.bincount(live, minlength=len(size))
        out = np.empty(len(live), np.int32)
        step = np.repeat(np.arange(len(steps)), [len(x) for x, _ in steps])
        if steps:
            out[np.cumsum(count)[live] - 1 - step] = np.concatenate([x for _, x in steps])
        return count, out


def _best_path(text: str, best: dict[str, tuple[int, float]], longest: int, fallback: float) -> list[int]:
    """As :meth:`Lattice.paths`; only the last ``longest`` places' scores are carried on."""
    k = text.translate(_KEYS)
    last, starts, ids = [0.0], [0], [0]
    for e in range(1, len(k) + 1):
        first = e - len(last)
        top = start = i = None
        for s in range(first, e):
            x = best.get(k[s:e])
            if x is None:
                if s < e - 1:
                    continue
                x = -1 - ord(text[s]), fallback
            v = last[s - first] + x[1]
            if top is None or v > top:
                top, start, i = v, s, x[0]
        starts.append(start)
        ids.append(i)
        last = [*last[-longest + 1:], top] if longest > 1 else [top]
    path, e = [], len(k)
    while e:
        path.append(ids[e])
        e = starts[e]
    return path[::-1]


def _lists(values: np.ndarray, size: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                                    pa.array(values, pa.int32()))


def _with_bytes(flat: np.ndarray, size: np.ndarray, byte_ids: np.ndarray):
    """Ids and their number in each word, code points without a piece as bytes."""
    none = flat < 0
    if not none.any():
        return flat, size
    raw = [chr(-1 - v).encode("utf-8", "surrogatepass") for v in flat[none].tolist()]
    width = np.ones(len(flat), np.int64)
    width[none] = [len(x) for x in raw]
    out = np.repeat(flat, width)
    out[np.repeat(none, width)] = byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    end = np.concatenate([[0], np.cumsum(width)])[np.cumsum(size)]
    return out, np.diff(end, prepend=0)


def _decoded(ids: np.ndarray, size: np.ndarray, words: list[bytes], surface: np.ndarray) -> np.ndarray:
    """Whether the surfaces of a word's ids give the word back."""
    end = np.cumsum(size)
    return np.array([b"".join(surface[ids[e - n:e]]) == w for e, n, w in zip(end, size, words)], bool)


class Encoder:
    """The ids of words; code points without a piece as bytes."""

    def __init__(self, table: PieceTable):
        self.lattice, self.best = Lattice(table), {p: (i, v) for p, i, v in table.useful}
        self.byte_ids = np.array(table.bytes, np.int32)
        self.surface = np.array([*table.surface, b""], object)[:-1]

    def _apart(self, words: list[bytes]):
        for a in range(0, len(words), BATCH):
            part = words[a:a + BATCH]
            short = [w for w in part if len(w) <= WORD or len(w.decode()) <= WORD]
            size, ids = self.lattice.paths(short)
            if len(short) == len(part):
                yield size, ids
                continue
            ends, at = np.cumsum(size), 0
            for w in part:
                if at < len(short) and w == short[at]:
                    yield size[at:at + 1], ids[ends[at] - size[at]:ends[at]]
                    at += 1
                else:
                    path = _best_path(w.decode(), self.best, self.lattice.longest, self.lattice.fallback)
                    yield np.array([len(path)]), np.array(path, np.int32)

    def encode(self, words: list[bytes]):
        """For distinct words: the number of ids, the code points, whether the
        ids' surfaces give the word back, and the ids of all words."""
        size, ids = (np.concatenate(x) for x in zip(*self._apart(words)))
        ids, size = _with_bytes(ids, size, self.byte_ids)
        return (size, np.array([len(w.decode()) for w in words], np.int64),
                _decoded(ids, size, words, self.surface), ids)


_ANSWERS = "of long, words binary, sizes binary, about binary, ids binary"


def _answer(encoder: Encoder):
    """``block, i, word`` rows, equal words together, to the ids of each block's
    words: for a block the words' numbers (differences), how many ids each has,
    its code points * 2 + whether it comes back, and the ids."""
    names = [c.split()[0] for c in _ANSWERS.split(", ")]

    def answers(table: pa.Table):
        word = table.column("word").combine_chunks().dictionary_encode()
        known = word.dictionary.to_pylist()
        size, chars, same, flat = encoder.encode(known)
        start = np.cumsum(size) - size
        block, i = (table.column(c).to_numpy() for c in ("block", "i"))
        order = np.lexsort((i, block))
        block, i, w = block[order], i[order], word.indices.to_numpy()[order]
        first = np.flatnonzero(np.diff(block, prepend=-1))
        rows = []
        for a, b in zip(first, np.append(first[1:], len(block))):
            k = w[a:b]
            rows.append((block[a], pack(np.diff(i[a:b], prepend=0).astype(np.int32)), pack(size[k].astype(np.int32)),
                         pack(chars[k].astype(np.int32) * 2 + same[k]),
                         pack(flat[np.repeat(start[k], size[k]) + runs(size[k])])))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] + [pa.binary()] * 4)], names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= MEET:
                yield answers(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield answers(pa.Table.from_batches(held))
    return run


def encode_words(words: DataFrame, table: PieceTable) -> DataFrame:
    """``block, i, word`` -> ``_ANSWERS``, as :func:`_answer`."""
    dealt = words.select("block", "i", "word").repartition("word").sortWithinPartitions("word")
    return dealt.mapInArrow(_answer(Encoder(table)), _ANSWERS)


_OUT = "doc_id long, n_chars long, n_words long, n_pieces long, ids array<int>, ids_sha256 string, round_trip boolean"


def _documents(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block (``left``), by the ids of its words (``right``)."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    if not left.num_rows:
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.string(), pa.bool_()]
        return pa.table([pa.array([], k) for k in kinds], names)
    by_word, flat, at = np.zeros((4, left.column("n")[0].as_py()), np.int64), [np.empty(0, np.int32)], 0
    for i, size, about, ids in zip(*(right.column(c) for c in ("words", "sizes", "about", "ids"))):
        i, size, about, ids = (unpack(x.as_py(), np.int32) for x in (i, size, about, ids))
        by_word[:, np.cumsum(i)] = at + np.cumsum(size) - size, size, about >> 1, about & 1
        flat.append(ids)
        at += len(ids)
    flat = np.concatenate(flat)
    start, size, chars, same = by_word
    lengths = unpack(left.column("lengths")[0].as_py(), np.int32).astype(np.int64)
    codes = unpack(left.column("codes")[0].as_py(), np.int32)
    of_doc = np.concatenate([[0], np.cumsum(lengths)])
    total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[codes])])[of_doc])
    pieces = total(size)
    ids, digests, at = np.empty(int(pieces.sum()), np.int32), [], 0
    for a, b, n in zip(of_doc, of_doc[1:], pieces):
        c = codes[a:b]
        mine = ids[at:at + n]
        mine[:] = flat[np.repeat(start[c], size[c]) + runs(size[c])]
        at += n
        digests.append(hashlib.sha256(mine.astype("<i4").tobytes()).hexdigest())
    return pa.table([left.column("ids")[0].values, pa.array(total(chars)), pa.array(lengths), pa.array(pieces),
                     _lists(ids, pieces), pa.array(digests, pa.string()), pa.array(total(same) == lengths)], names)


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per input row ``doc_id, n_chars, n_words, n_pieces, ids, ids_sha256,
    round_trip`` (whether decoding the ids gives the text back).

    ``n_words`` counts the lattice's words.  ``ids_sha256``: of the ids as little-endian 32-bit integers.  Null and empty
    texts have no pieces.  Repeated rows are encoded each; an empty table gives
    no rows.  Equal scores prefer the piece that starts first.
    """
    table = PieceTable(model)
    blocks = code_blocks(docs, partial(_make_tokens, table.marks, table.pairs, table.spaced), most=BLOCK)
    known = staged(encode_words(block_words(blocks), table))
    # the words go before the documents move
    head = staged(blocks.select("block", "ids", "lengths", "codes", F.size("words").alias("n")))
    release(blocks)
    return head.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_documents, _OUT)


def decode_pieces(encoded: DataFrame, model: str = MODEL, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of an array of piece ids, by a join with the
    piece table's surfaces.  An empty array gives an empty text."""
    table = PieceTable(model)
    surface = encoded.sparkSession.createDataFrame(
        [(i, bytearray(s)) for i, s in enumerate(table.surface)], "_id int, _surface binary")
    e = encoded.withColumn("_row", F.monotonically_increasing_id())
    e = staged(e)
    p = e.select("_row", F.posexplode(ids).alias("_at", "_id")).join(F.broadcast(surface), "_id")
    t = (p.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "_surface"))).alias("_p"))
         .select("_row", F.expr("decode(unhex(array_join(transform(_p, x -> hex(x._surface)), '')), 'UTF-8')")
                 .alias("decoded")))
    return (e.join(t, "_row", "left").withColumn("decoded", F.coalesce("decoded", F.lit(""))).drop("_row"))
