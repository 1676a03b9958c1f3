"""SentencePiece encoding and decoding by weighted finite-state transduction.

A model is compiled into one transducer, from bytes to piece ids (``Transducer``):

* the normaliser N: a dummy prefix (an arc that reads nothing and writes U+2581), space to U+2581, all else
  to itself;
* the pieces L: a prefix tree of their UTF-8 bytes from one root, with an arc back to the root at each piece's
  end that writes its id;
* the byte fallback B: a character that no piece spells goes back to the root with the ids of its bytes;
* N is composed with L and B when the model is compiled: a space is an arc to where U+2581 leads;
* for BPE the context machine C, one state for each piece: it reads ids, and the arc for a piece weighs 0
  where merging the two pieces' joined text by score gives the two back, and infinity elsewhere.  A BPE model
  does not maximise a sum of scores, but a row of pieces all of whose neighbours stand side by side is the row
  that merging gives, so its one finite path is the model's own.  C has as many arcs as there are pairs of pieces,
  so it is composed as the lattice needs it, from each piece's outer merges (``spine``).  For a unigram model
  there is no C, and a piece's arc weighs minus its score.

Texts are composed with it in batches: the lattice's arcs are found by walking the tree from all places at once,
and the shortest paths in the tropical semiring (sums along a path, the least over paths) are relaxed for all
units of a batch, place by place.  A text is cut into units before, at spaces and at line ends, if no piece runs
over one; units are remembered in a table of bounded size.  One unit needs some 100 bytes of memory a byte.

Only models whose normaliser is the identity, with byte fallback and without user-defined pieces, are compiled.
Defined results: a null or empty text has no ids; texts are encoded whole; of paths of equal weight the one whose
last piece is the longest is taken; repeated rows get equal results; an empty table gives no row; extra columns
are ignored.  Decoding gives the text back, but for U+2581, which reads as a space.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusflow.llm.arrow import scored
from corpusflow.llm.tokens import CACHE_BYTES, CACHE_WORDS

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITY = float("inf")
#: Arcs of the context machine that are remembered (9 bytes each).
PAIR_SLOTS = 1 << 20
#: Bytes of units that are composed together, and places that are relaxed for all of them at once; what is longer follows one by one.
TOGETHER = 1 << 20
PLACES = 192
#: No UTF-8 text has this byte: it stands between units.
STOP = 0xFF
_SPACED = re.compile(rb" +[^ ]*")
_LENGTH = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10, np.int64)


class Transducer:
    """A compiled model.  ``step[state, byte]`` is the composed tree (0: no arc); ``made[state]`` the piece that ends there, or -1."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix or kind not in (UNIGRAM, BPE):
            raise ValueError("only identity normalisers with a dummy prefix, and unigram or BPE models, are compiled")
        types = [p.type for p in proto.pieces]
        if types.count(BYTE) != 256 or USER in types:
            raise ValueError("only models with byte fallback and without user-defined pieces are compiled")
        self.bpe = kind == BPE
        self.byte_id = np.zeros(256, np.int64)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
        self.text = [p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        if SPACE not in self.score:
            raise ValueError("the model has no piece for a space")
        #: Pieces by id; after them, under ids of their own, characters that only longer pieces spell; last, any other character.
        self.name = [p.piece if p.type == NORMAL else None for p in proto.pieces]
        self.first_other = len(self.name)
        self.name += sorted({c for p in self.score for c in p} - set(self.score)) if self.bpe else []
        self.other = len(self.name)
        self.start = self.other + 1
        rare = 10 - min(self.score.values())  # what a character without a piece weighs in a unigram model
        self.weight = np.zeros(self.start) if self.bpe else np.array([-self.score.get(n, 0.0) if n else 0.0 for n in self.name] + [rare])
        self._compile()
        self.spines: dict[int, tuple | None] = {}
        self.pair_key, self.pair_ok = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, bool)
        inner = re.compile(f"{SPACE}*[^{SPACE}]*")
        self.by_word, self.by_line = all(map(inner.fullmatch, self.score)), not any("\n" in p for p in self.score)
        self.known: tuple[dict[bytes, bytes], dict[bytes, bytes]] = ({}, {})  # after a space, and not

    def _compile(self) -> None:
        """The tree of the pieces' bytes, with the normaliser composed into it."""
        arcs: list[dict[int, int]] = [{}]
        made = [-1]
        for i, name in enumerate(self.name):
            if name:
                at = 0
                for b in name.encode():
                    if b not in arcs[at]:
                        arcs[at][b] = len(arcs)
                        arcs.append({})
                        made.append(-1)
                    at = arcs[at][b]
                made[at] = i
        self.step, self.made = np.zeros((len(arcs), 256), np.int32), np.array(made, np.int64)
        for s, out in enumerate(arcs):
            self.step[s, list(out)] = list(out.values())
        written = np.arange(len(arcs))
        for b in SPACE.encode():
            written = np.where(written >= 0, self.step[written, b], 0)
            written = np.where(written > 0, written, -1)
        self.step[:, ord(" ")] = np.maximum(written, 0)

    # The context machine

    def merge(self, text: str) -> tuple[list[str], list[tuple[str, bool, bool]]]:
        """BPE by score, the leftmost of equals first: the symbols, and the merges in order (result, at the left end, at the right end)."""
        symbols, done = list(text), []
        while True:
            best, at = -INFINITY, -1
            for k in range(len(symbols) - 1):
                s = self.score.get(symbols[k] + symbols[k + 1])
                if s is not None and s > best:
                    best, at = s, k
            if at < 0:
                return symbols, done
            done.append((symbols[at] + symbols[at + 1], at == 0, at + 2 == len(symbols)))
            symbols[at : at + 2] = [done[-1][0]]

    def spine(self, piece: int) -> tuple | None:
        """(left symbols, right symbols, in order): what stands at either end while the piece is merged, each with the score that ends it.

        None if merging does not make the piece; not in order if a later merge has a higher score.
        """
        if piece not in self.spines:
            name = self.name[piece]
            symbols, done = self.merge(name)
            if len(symbols) > 1:
                self.spines[piece] = None
            else:
                scores = [self.score[r] for r, _, _ in done]
                ends = []
                for first, side in ((name[0], 1), (name[-1], 2)):
                    names = [first, *(d[0] for d in done if d[side])]
                    ends.append([(n, self.score[m]) for n, m in zip(names, names[1:], strict=False)] + [(names[-1], -INFINITY)])
                self.spines[piece] = (*ends, all(a > b for a, b in zip(scores, scores[1:], strict=False)))
        return self.spines[piece]

    def stands(self, before: int, piece: int) -> bool:
        """Whether C's arc for ``piece`` from the state ``before`` has finite weight: no merge joins the two while they are made."""
        if piece == self.other:
            return True
        here = self.spine(piece)
        if here is None or before >= self.other:
            return here is not None
        there = self.spine(before)
        if not (here[2] and there[2]):
            return self.merge(self.name[before] + self.name[piece])[0] == [self.name[before], self.name[piece]]
        left, right = iter(there[1]), iter(here[0])
        a, b = next(left), next(right)
        while True:
            joined = self.score.get(a[0] + b[0])
            if joined is not None and joined > a[1] and joined >= b[1]:
                return False
            if a[1] == b[1] == -INFINITY:
                return True
            if a[1] >= b[1]:
                a = next(left)
            else:
                b = next(right)

    def _finite(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """``stands`` of many pairs, through a table of those asked for lately."""
        key = before * (self.start + 1) + piece
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64) & (PAIR_SLOTS - 1)
        ok = self.pair_ok[slot]
        miss = np.flatnonzero(self.pair_key[slot] != key)
        if len(miss):
            new, at, back = np.unique(key[miss], return_index=True, return_inverse=True)
            made = np.array([self.stands(int(b), int(p)) for b, p in zip(before[miss][at], piece[miss][at], strict=True)], bool)
            ok[miss] = made[back]
            self.pair_key[slot[miss][at]], self.pair_ok[slot[miss][at]] = new, made
        return ok

    # Composition with texts, and shortest paths

    def lattice(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of the arcs over places of ``flat``, whose units end with ``STOP``."""
        place = np.flatnonzero(((flat & 0xC0) != 0x80) & (flat != STOP))
        start, state, end = place, self.step[0, flat[place]], place + 1
        starts, ends, pieces = [], [], []
        while len(start):
            alive = state > 0
            start, state, end = start[alive], state[alive], end[alive]
            made = self.made[state]
            hit = made >= 0
            starts.append(start[hit])
            ends.append(end[hit])
            pieces.append(made[hit])
            state = self.step[state, flat[end]]
            end = end + 1
        start, end, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends, pieces))
        size = _LENGTH[flat]
        spelled = np.zeros(len(flat), bool)
        spelled[start[(end - start == size[start])]] = True
        other = place[~spelled[place]]
        return np.concatenate((start, other)), np.concatenate((end, other + size[other])), np.concatenate((piece, np.full(len(other), self.other)))

    def paths(self, units: list[bytes]) -> list[bytes]:
        """The ids of each unit, as bytes: labels of its shortest path."""
        flat = np.frombuffer(b"".join([u + b"\xff" for u in units]), np.uint8)
        stop = np.flatnonzero(flat == STOP)
        first = np.concatenate(([0], stop[:-1] + 1))
        start, end, piece = self.lattice(flat)
        reach = end - first[np.searchsorted(stop, start)]
        order = np.lexsort((-start, reach))  # of arcs to one place the longest is last, and wins a tie
        start, end, piece, reach = start[order], end[order], piece[order], reach[order]
        total, last, back = np.full(len(flat), INFINITY), np.full(len(flat), self.start), np.zeros(len(flat), np.int64)
        total[first] = 0
        bounds = np.searchsorted(reach, np.arange(1, PLACES + 2))
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a < b:
                s, e, p = start[a:b], end[a:b], piece[a:b]
                cost = total[s] + self.weight[p]
                if self.bpe:
                    live = np.flatnonzero(cost < INFINITY)
                    live = live[self._finite(last[s[live]], p[live])]
                    s, e, p, cost = s[live], e[live], p[live], cost[live]
                np.minimum.at(total, e, cost)
                best = cost == total[e]
                last[e[best]], back[e[best]] = p[best], s[best]
        if bounds[-1] < len(start):
            self._one_by_one(start[bounds[-1] :], end[bounds[-1] :], piece[bounds[-1] :], total, last, back)
        return self._labels(flat, first, stop, last, back)

    def _one_by_one(self, start, end, piece, total: np.ndarray, last: np.ndarray, back: np.ndarray) -> None:
        """The same for the arcs beyond ``PLACES``, of few and long units."""
        memory: dict[tuple[int, int], bool] = {}
        cost, before = {}, {}
        for s, e, p in zip(start.tolist(), end.tolist(), piece.tolist(), strict=True):
            base = cost.get(s, INFINITY) if s in cost else float(total[s])
            whole = base + float(self.weight[p])
            if whole > cost.get(e, INFINITY) or whole == INFINITY:
                continue
            if self.bpe:
                key = (before[s] if s in before else int(last[s]), p)
                if key not in memory:
                    memory[key] = self.stands(*key)
                if not memory[key]:
                    continue
            cost[e], before[e] = whole, p
            back[e] = s
        at = np.fromiter(cost, np.int64, len(cost))
        total[at], last[at] = list(cost.values()), list(before.values())

    def _labels(self, flat: np.ndarray, first: np.ndarray, stop: np.ndarray, last: np.ndarray, back: np.ndarray) -> list[bytes]:
        """Pieces from the ends of the units back to their beginnings, turned round; characters without a piece by their bytes."""
        at, unit = stop.copy(), np.arange(len(stop))
        units, places = [], []
        while len(unit):
            live = at > first[unit]
            at, unit = at[live], unit[live]
            units.append(unit)
            places.append(at)
            at = back[at]
        unit, at = np.concatenate(units)[::-1], np.concatenate(places)[::-1]
        order = np.argsort(unit, kind="stable")
        unit, at = unit[order], at[order]
        piece, begin = last[at], back[at]
        byte = piece >= self.first_other
        count = np.where(byte, at - begin, 1)
        which = np.repeat(np.arange(len(piece)), count)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        ids = np.where(byte[which], self.byte_id[flat[begin[which] + offset]], piece[which]).astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(unit, count, len(stop)).astype(np.int64)).tolist()
        return [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]

    # Whole texts

    def encode(self, raw: list) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        cut = [self._units(b) if b else [] for b in raw]
        wanted = [set().union(*[line[spaced] for lines in cut for line in lines]) for spaced in (0, 1)]
        for spaced in (0, 1):
            self._learn(spaced, wanted[spaced])
        after, plain = self.known[1].__getitem__, self.known[0].__getitem__
        newline = self.byte_id[ord("\n")].astype("<u4").tobytes()
        out = [newline.join([b"".join(map(plain, head)) + b"".join(map(after, words)) for head, words in lines]) for lines in cut]
        for known, words in zip(self.known, wanted, strict=True):
            if len(known) > CACHE_WORDS // 2:
                known.clear()
            else:
                for w in words:
                    if len(w) > CACHE_BYTES:
                        del known[w]
        return out

    def _learn(self, spaced: int, wanted: set[bytes]) -> None:
        known = self.known[spaced]
        miss = sorted(wanted.difference(known), key=len)
        part, size = [], 0
        for k, w in enumerate(miss):
            part.append(b" " + w if spaced else w)
            size += len(w) + 2
            if size > TOGETHER or k + 1 == len(miss):
                known.update(zip(miss[k + 1 - len(part) : k + 1], self.paths(part), strict=True))
                part, size = [], 0

    def _units(self, b: bytes) -> list[tuple[list[bytes], list[bytes]]]:
        """For each line: the unit before its first space, if any, and those after a space (without it, and without what is part of the word)."""
        b = b" " + (b.replace(SPACE.encode(), b" ") if SPACE.encode() in b else b)
        lines = b.split(b"\n") if self.by_line else [b]
        if not self.by_word:
            return [([x] if x[:1] != b" " and x else [], [x[1:]] if x[:1] == b" " else []) for x in lines]
        out = []
        for x in lines:
            if b"  " in x:
                words, head = [u[1:] for u in _SPACED.findall(x)], x[: x.index(b" ")]
            else:
                head, *words = x.split(b" ")
            out.append(([head] if head else [], words))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The inverse: what the ids spell, without the dummy prefix."""
        out = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out[1:] if out[:1] == b" " else out


@lru_cache(4)
def transducer(model_file: str) -> Transducer:
    with open(model_file, "rb") as f:
        return Transducer(f.read())


FIELDS = [("n_tokens", T.LongType()), ("n_byte_tokens", T.LongType()), ("ids_crc32", T.LongType()), ("decoded_sha256", T.StringType()), ("round_trip", T.BooleanType())]


def digests(model_file: str, raw: list) -> list[list]:
    t = transducer(model_file)
    low, high = int(t.byte_id.min()), int(t.byte_id.max())
    rows = []
    for b, ids in zip(raw, t.encode(raw), strict=True):
        b = b or b""
        numbers = np.frombuffer(ids, "<u4")
        back = t.decode(ids)
        rows.append((len(numbers), int(((numbers >= low) & (numbers <= high)).sum()), zlib.crc32(ids), hashlib.sha256(back).hexdigest(), back == b))
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in FIELDS]


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int)."""
    return scored(docs, lambda raw: [[np.frombuffer(x, "<u4").astype(np.int32) for x in transducer(model_file).encode(raw)]], [("ids", T.ArrayType(T.IntegerType()))], (key,), text)


def op7_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), lambda raw: digests(path, raw), FIELDS)
