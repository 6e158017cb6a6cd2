"""SentencePiece encoding and decoding: Gumbel top-k segmentations without replacement.

The vocabulary file is read, never trained. Its pieces get Zipf-Mandelbrot probabilities by rank,
and the segmentations of a text are distributed as products of piece probabilities over its lattice.
No piece crosses a word boundary (blanks only lead a piece; line feeds are byte pieces), so the
lattice is a chain of small ones, and equal words of a batch share theirs.

Search (Kool et al., 2019): the first segmentation is the perturbed maximum, drawn word by word from
its lattice. What is left falls into cells: equal to it before word w, different at w. Each cell's
perturbed maximum is a Gumbel of its mass, truncated at the sample's own. A heap always opens the
cell with the largest value, whose winner is drawn inside it and splits it again: perturbed A-star
search, top down, with exact bounds. k samples and the next value, which is the threshold of the
inclusion scores log(1 - exp(-exp(log p - threshold))), come from k rounds. All draws are hashes of
the row's key, sample, word and step, so a row's samples do not depend on its batch.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrove.llm.common import arrow_bounded, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = re.compile(r"\n| *[^ \n]+| +")
BLANK, LITERAL = 0x2581, 0x110000
ZIPF = 2.7
SAMPLES = 2
TEXT_PER_STEP = 1_000_000
#: Lattices are kept for the next texts until they have more nodes than this; results do not depend on it.
NODES_KEPT = 500_000
#: Nodes that are set up at once: few enough for their arrays to stay in a core's cache.
NODES_AT_ONCE = 30_000
#: Ids whose bytes are looked up at once.
IDS_AT_ONCE = 50_000
#: Where less than this is left of a word's mass beside a segmentation, it is summed over the others, if the cell matters at all.
SUMMED = 1e-6
#: More than rounding adds to what is left.
ROUNDING = 1e-9
_M = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS, _START_BITS = 18, 16


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser."""
    x = np.atleast_1d(x)
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniforms(seed: np.ndarray, *counters) -> np.ndarray:
    """Numbers in (0, 1) from a row's seed and counters."""
    x = np.atleast_1d(np.asarray(seed, np.uint64))
    for c in counters:
        x = mixed(x + _M * (np.atleast_1d(c).astype(np.uint64) + np.uint64(1)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _step(n: int) -> np.uint64:
    """_M times n + 1, wrapped."""
    return np.uint64((n + 1) * int(_M) & 0xFFFFFFFFFFFFFFFF)


def scalar_uniforms(seed: int, *counters: int) -> Iterator[float]:
    """The same numbers for one seed, the last counter running from 0."""
    full, m = 0xFFFFFFFFFFFFFFFF, int(_M)

    def mix(x: int) -> int:
        x &= full
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & full
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & full
        return x ^ x >> 31

    for c in counters:
        seed = mix(seed + m * (c + 1))
    for i in count():
        yield ((mix(seed + m * (i + 1)) >> 11) + 0.5) / (1 << 53)


def seed_of(key) -> int:
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little")


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, -1, np.int64)
        normal = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and p:
                normal.append((i, p))
        for _, p in normal:
            if "\n" in p or " " in p or "▁" in p.lstrip("▁"):
                raise ValueError("a piece crosses a word boundary")
        self.longest = max((len(p) for _, p in normal), default=1)
        rank = np.arange(n, dtype=np.float64)
        self.logp = -np.log(rank + ZIPF)
        self.logp -= np.log(np.exp(self.logp).sum())
        self.byte_logp = float(self.logp[-1])
        self.logs = self.logp.tolist()
        self.bytes_of = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.steps = np.multiply.accumulate(np.full(self.longest, _M, np.uint64))
        self.tables = []
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.n_bytes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.after = np.cumsum(self.n_bytes)
        #: hash of each beginning of each piece, by length
        begun = [np.cumsum((np.array([ord(c) for c in p], np.uint64) + np.uint64(1)) * self.steps[: len(p)]) for _, p in normal]
        for size in range(1, self.longest + 1):
            h = np.array([x[-1] for x in begun if len(x) == size], np.uint64)
            order = np.argsort(h)
            h, ids = h[order], np.array([i for i, p in normal if len(p) == size], np.int32)[order]
            first = np.searchsorted(h, np.arange(1 << _START_BITS, dtype=np.uint64) << np.uint64(64 - _START_BITS)).astype(np.int32)
            # beginnings of longer pieces: a node goes on to the next length only if one fits so far
            longer = np.array([x[size - 1] for x in begun if len(x) > size], np.uint64)
            maybe = np.zeros(1 << _FILTER_BITS, np.uint8)
            for bit, x in ((1, h), (2, longer)):
                maybe[(x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] |= bit
            self.tables.append((maybe, first, np.r_[h, np.uint64(0xFFFFFFFFFFFFFFFF)], np.r_[ids, np.int32(-1)]))

    def find(self, size: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of strings of one size, by hash: those that are pieces, ids of these, and those that longer pieces may begin with."""
        maybe, first, hashes, ids = self.tables[size - 1]
        kind = maybe[(h >> np.uint64(64 - _FILTER_BITS)).view(np.int64)]
        at = np.flatnonzero(kind & 1)
        h = h[at]
        where = first[(h >> np.uint64(64 - _START_BITS)).view(np.int64)]
        on = np.flatnonzero(hashes[where] < h)
        while len(on):
            where[on] += 1
            on = on[hashes[where[on]] < h[on]]
        hit = np.flatnonzero((hashes[where] == h) & (ids[where] >= 0))
        return at[hit], ids[where[hit]], np.flatnonzero(kind & 2)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def points(text: str) -> np.ndarray:
    """Code points with blanks as the blank sign and that sign, where it is meant, out of its way."""
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(cps == BLANK, LITERAL, np.where(cps == 32, BLANK, cps)).astype(np.uint64)


class Lattices:
    """The lattices of distinct words. Node of word w at character i: node[w] + i; edges by length."""

    def __init__(self, voc: Vocabulary, words: list[str] = ()):
        self.voc = voc
        self.sizes, self.node, self.single = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        # edges of node i are those from edge[i] to edge[i + 1], by length; cum: shares of a node's edges up to each
        self.edge, self.beta = np.zeros(1, np.int64), np.zeros(0)
        self.code, self.length, self.cum = np.zeros(0, np.int32), np.zeros(0, np.uint8), np.zeros(0)
        self._shares: dict[int, list[tuple[int, float]]] = {}
        if words:
            self.add(words)

    def add(self, words: list[str]) -> None:
        """Set up more words, some NODES_AT_ONCE characters at a time; those set up before keep their numbers."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        cuts = np.unique(np.r_[np.searchsorted(ends, np.arange(0, int(ends[-1]), NODES_AT_ONCE)), len(words)]).tolist()
        parts = [self._set_up(words[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        sizes, single, beta, each, code, cum, length = (np.concatenate(x) for x in zip(*parts))
        self.node = np.r_[self.node, len(self.beta) + np.cumsum(sizes) - sizes]
        self.sizes, self.single = np.r_[self.sizes, sizes], np.r_[self.single, single]
        self.edge, self.beta = np.r_[self.edge, self.edge[-1] + np.cumsum(each)], np.r_[self.beta, beta]
        self.code, self.cum, self.length = np.r_[self.code, code], np.r_[self.cum, cum], np.r_[self.length, length]
        self.total = self.beta[self.node]  # log mass of each word

    def _set_up(self, words: list[str]) -> tuple[np.ndarray, ...]:
        voc, sizes = self.voc, np.array([len(w) for w in words], np.int64)
        cps = points("".join(words))
        n = len(cps)
        ends = np.cumsum(sizes)
        rem = np.repeat(ends, sizes) - np.arange(n)  # characters to the word's end
        each = np.zeros(n, np.int64)  # edges of a node
        found = []  # (nodes, places among the node's edges, length, codes)
        live, h = np.arange(n), (cps + np.uint64(1)) * _M
        for size in range(1, voc.longest + 1):
            at, ids, on = voc.find(size, h)
            at = live[at]
            found.append((at, each[at], size, ids))
            each[at] += 1
            if size == 1:  # characters without a piece are spelled in bytes: coded as -2 - code point
                at = np.flatnonzero(each == 0)
                found.append((at, 0, 1, -2 - np.where(cps[at] == LITERAL, BLANK, cps[at]).astype(np.int32)))
                each[at] = 1
            if size == voc.longest:
                break
            on = on[rem[live[on]] > size]
            if not len(on):
                break
            live = live[on]
            h = h[on] + (cps[live + size] + np.uint64(1)) * voc.steps[size]
        # nodes by their distance from the word's end, so that what lies ahead is known; edges likewise
        order = np.argsort(rem.astype(np.uint16) if sizes.max() < 1 << 16 else rem, kind="stable")
        many = each[order]
        stops = np.cumsum(many)
        starts = stops - many
        begin = np.empty(n, np.int64)
        begin[order] = starts
        code, length = np.empty(int(stops[-1]), np.int32), np.empty(int(stops[-1]), np.uint8)
        for at, nth, size, ids in found:
            place = begin[at] + nth
            code[place], length[place] = ids, size
        node = np.repeat(order, many)
        ahead = node + length
        ahead[length == rem[node]] = n
        v = self.log_weights(code)
        beta = np.zeros(n + 1)  # log mass from a node to its word's end
        mass = np.empty(n)
        cut = np.searchsorted(rem[order], np.arange(1, int(rem.max(initial=0)) + 2)).tolist()
        for a, b in zip(cut[:-1], cut[1:]):
            i, j = int(starts[a]), int(stops[b - 1])
            own, from_ = v[i:j], starts[a:b] - i
            own += beta[ahead[i:j]]
            top = np.maximum.reduceat(own, from_)
            own -= np.repeat(top, many[a:b])
            np.exp(own, out=own)
            mass[a:b] = np.add.reduceat(own, from_)
            beta[order[a:b]] = top + np.log(mass[a:b])
        # v: masses of a node's edges, relative to the greatest; now summed up to each edge
        last = stops - 1
        none = np.flatnonzero(v[last] == 0)
        while len(none):
            last[none] -= 1
            none = none[v[last[none]] == 0]
        more = starts[many > 1] + 1
        end = stops[many > 1]
        while len(more):
            v[more] += v[more - 1]
            on = more + 1 < end
            more, end = more[on] + 1, end[on]
        v /= np.repeat(mass, many)
        v[last] = 1  # the last edge takes what rounding leaves
        back = np.repeat(begin - np.cumsum(each) + each, each) + np.arange(len(v))
        #: Words of one segmentation: every node has one edge.
        single = np.add.reduceat(each, ends - sizes) == sizes
        return sizes, single, beta[:n], each, code[back], v[back], length[back]

    def log_weights(self, codes: np.ndarray) -> np.ndarray:
        out = self.voc.logp[np.maximum(codes, 0)]
        bare = np.flatnonzero(codes < 0)
        if len(bare):
            out[bare] = self.voc.byte_logp * _utf8_sizes(-2 - codes[bare].astype(np.int64))
        return out

    def _log_weight(self, code: int) -> float:
        return self.voc.logs[code] if code >= 0 else self.voc.byte_logp * len(chr(-2 - code).encode())

    def shares(self, at: int, end: int) -> list[tuple[int, float]]:
        """(length, probability) of each edge of a node of a word that ends at `end`."""
        out = self._shares.get(at)
        if out is None:
            here = float(self.beta[at])
            a, b = int(self.edge[at]), int(self.edge[at + 1])
            own = list(zip(self.length[a:b].tolist(), self.code[a:b].tolist()))
            ahead = [0.0 if at + n >= end else float(self.beta[at + n]) for n, _ in own]
            out = self._shares[at] = [(n, math.exp(self._log_weight(c) + x - here)) for (n, c), x in zip(own, ahead)]
        return out

    def draw(self, word: np.ndarray, base: np.ndarray):
        """Independent segmentations: (piece codes, pieces of each occurrence, log probability of each).

        base: a well-mixed number of each occurrence's own.
        """
        at = self.node[word]
        end = at + self.sizes[word]
        count = np.zeros(len(word), np.int64)
        live = np.arange(len(word))
        own = base  # that of the live ones
        rounds = []
        step = 0
        while len(live):
            u = ((mixed(own + _step(step)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            edge = self.edge[at]
            on = np.flatnonzero(self.cum[edge] <= u)
            while len(on):
                edge[on] += 1
                on = on[self.cum[edge[on]] <= u[on]]
            rounds.append((live, self.code[edge]))
            step += 1
            at = at + self.length[edge]
            on = np.flatnonzero(at < end)
            if len(on) < len(live):
                count[live[at >= end]] = step
                live, at, end, own = live[on], at[on], end[on], own[on]
        first = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for k, (who, code) in enumerate(rounds):
            out[first[who] + k] = code
        score = np.add.reduceat(self.log_weights(out), first) if len(word) else np.zeros(0)
        return out, count, np.minimum(score - self.total[word], 0)

    def others(self, word: int, paths: list[tuple[int, ...]]) -> list[list]:
        """Trie of distinct segmentations of a word (edge lengths): [node, child by edge, share that is on none of them].

        Shares are sums of what the other edges have, so they are right however little is left.
        """
        end = int(self.node[word] + self.sizes[word])
        trie: list[list] = [[int(self.node[word]), {}, 0.0]]
        for path in paths:
            here = 0
            for edge in path:
                if edge not in trie[here][1]:
                    trie[here][1][edge] = len(trie)
                    trie.append([trie[here][0] + edge, {}, 0.0])
                here = trie[here][1][edge]
        for node in reversed(trie):
            if node[0] < end:
                node[2] = sum(p * (trie[node[1][edge]][2] if edge in node[1] else 1.0) for edge, p in self.shares(node[0], end))
        return trie

    def draw_other(self, word: int, taken: list[tuple[int, ...]], us: Iterator[float]) -> tuple[tuple[int, ...], float]:
        """One segmentation of a word other than those taken (edge lengths), and its log probability."""
        at, end = int(self.node[word]), int(self.node[word] + self.sizes[word])
        trie = self.others(word, taken)
        here: int | None = 0
        path: list[int] = []
        total = 0.0
        while at < end:
            kids = {} if here is None else trie[here][1]
            edges = [(edge, p, p * trie[kids[edge]][2] if edge in kids else p) for edge, p in self.shares(at, end)]
            left = next(us) * sum(w for _, _, w in edges)
            for edge, p, w in edges:
                if w > 0:
                    chosen, share = edge, p
                    left -= w
                    if left < 0:
                        break
            here = kids.get(chosen)
            path.append(chosen)
            total += float(np.log(share))
            at += chosen
        return tuple(path), total

    def codes(self, word: int, path: tuple[int, ...]) -> list[int]:
        at, out = int(self.node[word]), []
        for size in path:
            a, b = int(self.edge[at]), int(self.edge[at + 1])
            out.append(int(self.code[a + int(np.searchsorted(self.length[a:b], size))]))
            at += size
        return out


def _utf8_sizes(points_: np.ndarray) -> np.ndarray:
    return 1 + (points_ > 0x7F) + (points_ > 0x7FF) + (points_ > 0xFFFF)


def spelled(voc: Vocabulary, codes: np.ndarray, counts: np.ndarray | None = None):
    """Piece ids of codes; characters without a piece become byte pieces. With counts also those of the ids."""
    sizes = np.ones(len(codes), np.int64)
    bare = np.flatnonzero(codes < 0)
    out = codes
    if len(bare):
        real = -2 - codes[bare].astype(np.int64)
        own = _utf8_sizes(real)
        sizes[bare] = own
        out = np.repeat(codes, sizes)
        first = (np.cumsum(sizes) - sizes)[bare]
        for j in range(int(own.max())):
            some = own > j
            value = real[some] >> 6 * (own[some] - 1 - j)
            lead = np.where(own[some] == 1, 0, 0xF00 >> own[some] & 0xFF) if j == 0 else 0x80
            out[first[some] + j] = voc.byte_ids[value | lead if j == 0 else value & 0x3F | lead]
    if counts is None:
        return out
    return out, np.add.reduceat(sizes, np.cumsum(counts) - counts) if len(counts) else counts


def truncated(phi, bound, u):
    """Gumbels of location phi below bound."""
    return -np.logaddexp(-bound, np.log(-np.log(u)) - phi)


class Sample:
    """One segmentation of a text: codes and pieces by word, log probability by word."""

    def __init__(self, codes, counts, scores, value):
        self.codes, self.counts, self.scores, self.value = codes, counts, scores, value
        self.first = np.cumsum(counts) - counts

    def before(self) -> np.ndarray:
        """Log probability of all words before each."""
        out = np.zeros(len(self.scores))
        np.cumsum(self.scores[:-1], out=out[1:])
        return out

    def path(self, w: int, voc_len) -> tuple[int, ...]:
        return tuple(voc_len(c) for c in self.codes[self.first[w] : self.first[w] + self.counts[w]].tolist())


class _Text:
    """A text on its way: word numbers, samples found and a heap of open cells."""

    def __init__(self, place: int, seed: int, word: np.ndarray):
        self.place, self.seed, self.word = place, seed, word
        self.found: list[Sample] = []
        self.heap: list[tuple] = []
        self.begin, self.taken, self.parent, self.value, self.nth = 0, [], None, 0.0, 0


class Encoder:
    def __init__(self, path: str, k: int):
        self.voc, self.k = vocabulary(path), k
        self.lat: Lattices | None = None  # kept from call to call
        self.size_of = np.ones(len(self.voc.bytes_of), np.int64)
        for i, b in enumerate(self.voc.bytes_of):
            self.size_of[i] = max(1, len(b.decode("utf-8", "replace")))

    def _length(self, code: int) -> int:
        return 1 if code < 0 else int(self.size_of[code])

    def encode(self, keys: list, texts: list[str]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Per text up to k of (ids, log probability, perturbed value, log inclusion), best first."""
        if self.lat is None or len(self.lat.beta) > NODES_KEPT:
            self.lat, self.known = Lattices(self.voc), defaultdict()
            self.known.default_factory = self.known.__len__
        lat, number, before = self.lat, self.known.__getitem__, len(self.known)
        words = [np.fromiter(map(number, CHUNK.findall(" " + t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        out: list = [[(np.zeros(0, np.int32), 0.0, 0.0, 0.0)] for _ in texts]
        open_ = [_Text(i, seed_of(k), w) for i, (k, w) in enumerate(zip(keys, words)) if len(w)]
        if not open_:
            return out
        if len(self.known) > before:
            lat.add(list(islice(self.known, before, None)))
        every = open_
        for n in range(self.k):
            self._sample(lat, open_, n)
            self._cells(lat, open_, n)
            open_ = [t for t in open_ if t.heap]
        samples = [x for t in every for x in t.found]
        ids, sizes = spelled(self.voc, np.concatenate([x.codes for x in samples]), np.array([len(x.codes) for x in samples]))
        ids = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        for t in every:
            threshold = -t.heap[0][0] if t.heap else -np.inf
            rows = []
            for x in t.found:
                logp = float(x.scores.sum())
                lift = logp - threshold
                inclusion = lift if lift < -30 else float(np.log(-np.expm1(-np.exp(min(lift, 700)))))
                rows.append((next(ids), logp, float(x.value), inclusion))
            out[t.place] = rows
        return out

    def _sample(self, lat: Lattices, texts: list[_Text], n: int) -> None:
        """The n-th sample of each text: the perturbed maximum, then the best open cell's."""
        if not texts:
            return
        for t in texts:
            t.begin, t.taken, t.parent, t.value = 0, [], None, 0.0
            if n:
                value, s, t.begin, old = heapq.heappop(t.heap)
                t.parent, t.value = t.found[s], -value
                t.taken = [*old, t.parent.path(t.begin, self._length)]
        skip = 1 if n else 0
        tails = [t.word[t.begin + skip :] for t in texts]
        sizes = [len(w) for w in tails]
        raw = np.array([t.seed for t in texts], np.uint64)
        if not n:
            tops = -np.log(-np.log(uniforms(raw, 0, 0xFFFFFFFF)))
            for i, t in enumerate(texts):
                t.nth = i
        seeds = mixed(raw + _step(n))
        place = np.concatenate([np.arange(t.begin + skip, len(t.word)) for t in texts])
        base = mixed(np.repeat(seeds, sizes) + _M * (place.astype(np.uint64) + np.uint64(1)))
        codes, pieces, scores = lat.draw(np.concatenate(tails), base)
        ends = np.cumsum(sizes)
        stops = np.r_[0, np.cumsum(pieces)]
        for t, a, b in zip(texts, (ends - sizes).tolist(), ends.tolist()):
            own = codes[stops[a] : stops[b]], pieces[a:b], scores[a:b]
            if n:
                w, up = t.begin, t.parent
                us = scalar_uniforms(t.seed, n, 0xFFFFFFFD)
                other, score = lat.draw_other(int(t.word[w]), t.taken, us)
                own = (
                    np.concatenate([up.codes[: int(up.first[w])], np.array(lat.codes(int(t.word[w]), other), np.int32), own[0]]),
                    np.concatenate([up.counts[:w], [len(other)], own[1]]),
                    np.concatenate([up.scores[:w], [score], own[2]]),
                )
            else:
                t.value = float(tops[t.nth])
            t.found.append(Sample(*own, t.value))

    def _cells(self, lat: Lattices, texts: list[_Text], n: int) -> None:
        """What the n-th sample of each text leaves goes to its heap: the best (-value, sample, word, taken paths)."""
        if not texts:
            return
        sizes = [len(t.word) - t.begin for t in texts]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        before = np.concatenate([t.found[-1].before()[t.begin :] for t in texts])
        scores = np.concatenate([t.found[-1].scores[t.begin :] for t in texts])
        word = np.concatenate([t.word[t.begin :] for t in texts])
        # where little is left a bound stands for it until the cell comes out among the best
        bound = (scores > -SUMMED) & ~lat.single[word]
        if n:
            bound[starts] = True
        left = np.where(lat.single[word], 0.0, -np.expm1(scores) + ROUNDING * bound)
        some = np.flatnonzero(left > 0)
        seeds = np.array([t.seed for t in texts], np.uint64)
        for c in (n, 0xFFFFFFFE):
            seeds = mixed(seeds + _step(c))
        owner = np.searchsorted(ends, some, side="right")
        begin = np.array([t.begin for t in texts])
        place = some - starts[owner] + begin[owner]
        u = ((mixed(seeds[owner] + _M * (place.astype(np.uint64) + np.uint64(1))) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        before, bound = before[some], bound[some]
        own = np.array([t.found[-1].value for t in texts])
        values = truncated(before + np.log(left[some]), own[owner], u)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        known: dict[tuple, float] = {}
        for i, t in enumerate(texts):
            a, b = cuts[i], cuts[i + 1]
            part = values[a:b]
            while True:
                best = np.argpartition(-part, self.k)[: self.k + 1] if len(part) > self.k + 1 else np.arange(len(part))
                loose = best[bound[a:b][best]]
                if not len(loose):
                    break
                for j in (loose + a).tolist():
                    w = int(place[j])
                    paths = (*(t.taken if w == t.begin else ()), t.found[-1].path(w, self._length))
                    key = (int(t.word[w]), paths)
                    if key not in known:
                        known[key] = lat.others(key[0], list(paths))[0][2]
                    values[j] = truncated(before[j] + math.log(known[key]), t.found[-1].value, u[j]) if known[key] > 0 else -np.inf
                    bound[j] = False
            for j in best.tolist():
                if part[j] > -np.inf:
                    w = int(place[a + j])
                    heapq.heappush(t.heap, (-float(part[j]), n, w, t.taken if w == t.begin else []))

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        raw = b"".join(self._bytes(ids[a : a + IDS_AT_ONCE]) for a in range(0, len(ids), IDS_AT_ONCE))
        return raw[1:].decode()  # without the blank set before each text

    def _bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.voc.n_bytes[ids]
        where = np.repeat(self.voc.after[ids] - np.cumsum(sizes), sizes)
        where += np.arange(len(where))
        return self.voc.flat[where].tobytes()


ENCODED = "rank int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


def _encoded(model: str, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list]]:
    """(source batch, row in it, samples of the row). Columns: ..., key as text, text."""
    enc = Encoder(model, k)
    for batch in batches:
        keys, texts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        at = 0
        while at < len(batch):
            begin, size, part = at, 0, []
            while at < len(batch) and (size < TEXT_PER_STEP or not part):
                part.append(texts[at].as_py() or "")
                size += len(part[-1])
                at += 1
            names = [keys[i].as_py() for i in range(begin, at)]
            for i, samples in enumerate(enc.encode(names, part)):
                yield batch, begin + i, samples, part[i], enc


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str = MODEL, k: int = SAMPLES) -> DataFrame:
    """key, rank (from 1), ids, log_prob, perturbed, log_inclusion: up to k distinct segmentations a row.

    Seeded by the row's key: equal keys and texts get equal samples. Null and empty texts have one
    empty segmentation (probability 1). A text with fewer than k segmentations returns all it has;
    the inclusion score is then 0. Repeated rows are encoded each; an empty table gives an empty
    result; other columns are ignored.
    """
    arrow_bounded(docs.sparkSession)
    rows = docs.select(F.col(key).alias("_k"), F.col(key).cast("string").alias("_s"), F.col(text).cast("string").alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        held, size = [], 0

        def out() -> pa.RecordBatch:
            cols = list(zip(*held))
            types = (kind, pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["k", "rank", "ids", "log_prob", "perturbed", "log_inclusion"])

        for batch, i, samples, _, _ in _encoded(model, k, batches):
            kind = batch.schema.field(0).type
            own = batch.column(0)[i].as_py()
            for r, (ids, *scores) in enumerate(samples):
                held.append((own, r + 1, ids, *scores))
                size += len(ids)
            if size > 500_000:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    kind = dict(rows.dtypes)["_k"]
    return rows.mapInArrow(run, f"k {kind}, {ENCODED}").withColumnRenamed("k", key)


def decode(encoded: DataFrame, *, ids: str = "ids", model: str = MODEL, into: str = "text") -> DataFrame:
    """encoded with the text that each row's ids spell, exactly the one that was encoded (null: empty)."""
    kept = [c for c in encoded.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(model, 1)
        at = kept.index(ids)
        for b in batches:
            texts = [enc.decode(x.as_py() or ()) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*kept, into])

    return encoded.select(*kept).mapInArrow(run, encoded.select(*kept).schema.add(into, "string"))


def digests(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str = MODEL, k: int = SAMPLES) -> DataFrame:
    """encode() and decode() in one pass: figures and digests of every sample instead of its ids."""
    arrow_bounded(docs.sparkSession)
    rows = docs.select(F.col(key).alias("_k"), F.col(key).cast("string").alias("_s"), F.col(text).cast("string").alias("_t"))
    kind = dict(rows.dtypes)["_k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, form = [], None
        types = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.float64(), pa.float64())
        names = ["k", "rank", "n_pieces", "ids_sha256", "decoded_sha256", "exact", "log_prob", "log_inclusion"]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), (form, *types))], names=names)

        for batch, i, samples, source, enc in _encoded(model, k, batches):
            form = batch.schema.field(0).type
            own = batch.column(0)[i].as_py()
            for r, (ids, logp, _, inclusion) in enumerate(samples):
                spelt = enc.decode(ids)
                sha = hashlib.sha256(np.ascontiguousarray(ids, "<i4").tobytes()).hexdigest()
                held.append((own, r + 1, len(ids), sha, hashlib.sha256(spelt.encode()).hexdigest(), spelt == source, logp, inclusion))
            if len(held) >= 5000:
                yield out()
                held = []
        if held:
            yield out()

    schema = f"k {kind}, rank int, n_pieces long, ids_sha256 string, decoded_sha256 string, exact boolean, log_prob double, log_inclusion double"
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)


def op6_sentencepiece(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
