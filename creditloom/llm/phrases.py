"""Phrase mining: word sequences that stand together more often than their parts would by chance, from weighted acyclic automata.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line breaks, and the pieces into words. Phrases have up to `longest`
words and stay inside a piece; everything is counted per language.

1. Bound. Word pairs, then runs of three words whose pairs passed, are counted by 64-bit hashes (one count per shard, summed after a shuffle).
   Those that reach `least`, and the words that stand in such pairs, set bits in bitmaps of bounded size. A phrase that reaches `least`
   has only such pairs and triples, so other windows can be passed over. Hash and bitmap can only let too much through, never too little.
2. Shards. The remaining windows of a shard (a bounded number of words) are counted exactly, sorted, and added in that order to count
   automata: a word of the path per arc, the language first, the count at the state where the phrase ends.
3. Ranges. Cut points between phrases (language and first two words) come from a bounded sample of pairs and only balance the work. A shard
   builds one automaton per range; those of a range meet, are united and their weights summed; sums below `least` go.
4. Parts. A range knows the counts of the beginnings of its phrases that lie in it. What else it needs, it asks: the parts that another
   range holds are sent there as an automaton, composed with that range's counts, and come back with weights.
5. Score of each cut, the weakest cut counts; phrases that nearly always stand inside a longer one go; the best of each language stay.

Memory of a task: a shard of `shard_words` words, or the automata of one range. Nothing but cut points and the bitmaps (at most
2^28 bits each) passes through the driver.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.automata import Automaton, build, compose, union
from creditloom.llm.common import stored
from creditloom.session import small_side

LONGEST, LEAST, TOP = 5, 100, 2000
SHARD_WORDS, WORD_BYTES, CHUNK_BYTES = 1 << 21, 16, 1 << 20
SOME_WORDS = 1 << 16
RANGE_PAIRS, MOST_CUTS, SAMPLED = 100_000, 20_000, 64
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
UNITE_BYTES = 16 << 20
_BREAK = 0xFF  # never part of UTF-8 text
_GAP = re.compile(rb"[ \t\xff]")


def _letters() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in b".,;:!?\n\v\f\r":
        table[c] = _BREAK
    return bytes(table)


_LETTERS = _letters()
_WORD_BYTE = np.array([c not in (32, 9, _BREAK) for c in range(256)])
# A random number for each byte at each of 64 places; a word's hash is the sum over its bytes.
_HASH_OF = np.random.default_rng(13).integers(0, 2**64, 64 * 256, np.uint64)
_TURN, _TRIPLE, _MARK = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and hash of each word."""
    inside = _WORD_BYTE[data]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    first = np.r_[0, np.cumsum(ends - starts)[:-1]]
    place = np.arange(first[-1] + ends[-1] - starts[-1], dtype=np.int32) - np.repeat(first.astype(np.int32), ends - starts)
    return starts, ends, np.add.reduceat(_HASH_OF[((place & 63) << 8) | data[inside]], first)


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Shard:
    """Words of some texts: where they stand, their hashes, and their language. About 35 bytes a word, and the texts."""

    def __init__(self) -> None:
        self.langs = _Numbers()
        self.waiting: list[bytes] = []
        self.owners: list[tuple[int, int]] = []
        self.bytes: list[bytes] = []
        self.arrays: list[list[np.ndarray]] = [[], [], [], [], []]
        self.length = self.pieces = self.size = self.held = 0

    def add(self, part: bytes, lang: str) -> None:
        self.waiting.append(part)
        self.owners.append((self.langs[lang], len(part)))
        self.held += len(part)
        if self.held >= CHUNK_BYTES:
            self.scan()

    def scan(self) -> None:
        joined = b"".join(self.waiting)
        data = np.frombuffer(joined, np.uint8)
        starts, ends, h = words_of(data)
        breaks = np.cumsum(data == _BREAK, dtype=np.int32)
        owner = np.searchsorted(np.cumsum([n for _, n in self.owners]), starts, side="right")
        lang = np.array([a for a, _ in self.owners], np.int32)[owner]
        small = np.int32 if self.length + len(joined) < 2**31 else np.int64
        for held, found in zip(self.arrays, ((starts + self.length).astype(small), (ends + self.length).astype(small), h, breaks[starts].astype(small) + small(self.pieces), lang), strict=True):
            held.append(found)
        self.bytes.append(joined)
        self.length, self.pieces, self.size = self.length + len(joined), self.pieces + int(breaks[-1]), self.size + len(starts)
        self.waiting, self.owners, self.held = [], [], 0

    def close(self) -> Shard:
        if self.waiting:
            self.scan()
        self.starts, self.ends, self.word, piece, self.lang = (self._whole(i) for i in range(5))
        self.data, self.bytes = b"".join(self.bytes), []
        with np.errstate(over="ignore"):
            two = self.one
            two[:-1] += self.word[1:] * _TURN
            self.two = _mixed(two)
        # Where a word and the next one stand in one piece.
        self.paired = np.r_[piece[1:] == piece[:-1], False][:len(piece)]
        return self

    def _whole(self, i: int) -> np.ndarray:
        """One of the arrays; its pieces are let go before the next is put together."""
        pieces, self.arrays[i] = self.arrays[i], []
        return np.concatenate(pieces)

    @property
    def one(self) -> np.ndarray:
        """Hash of each word with its language, made anew."""
        names = np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs), np.uint64, len(self.langs))
        with np.errstate(over="ignore"):
            return _mixed(names[self.lang] + self.word)

    def triples(self, at: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed(self.two[at] * _TRIPLE + self.word[at + 2])

    def marks(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed(self.one + _MARK)

    def pairs(self, bits: np.ndarray) -> np.ndarray:
        """Where pairs begin that the bitmap lets through."""
        out, at = np.zeros(len(self.word), bool), np.flatnonzero(self.paired)
        out[at[_seen(self.two[at], bits)]] = True
        return out

    def text(self, at: int) -> str:
        return self.data[self.starts[at]:self.ends[at]].decode()


def _mixed(h: np.ndarray) -> np.ndarray:
    """Hashes mixed in place."""
    for _ in range(2):
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def shards(batches: Iterator[pd.DataFrame], shard_words: int) -> Iterator[Shard]:
    """Closed shards of about `shard_words` words, fewer where words or gaps are long. Long texts are taken in parts; a shard ends where a piece does.

    No shard is held here once it is handed out, so that it can go before the next is filled.
    """
    shard = Shard()
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            data, lang, start = (text or "").encode().translate(_LETTERS) + b"\xff", "und" if lang is None else lang, 0
            while start < len(data):
                gap = _GAP.search(data, start + CHUNK_BYTES) if len(data) - start > CHUNK_BYTES else None
                stop = gap.end() if gap else len(data)
                shard.add(data[start:stop], lang)
                start = stop
                if (shard.size >= shard_words or shard.length >= WORD_BYTES * shard_words) and data[stop - 1] == _BREAK:
                    full, shard = [shard], Shard()
                    yield full.pop().close()
    if shard.size or shard.waiting:
        full, shard = [shard], None
        yield full.pop().close()


def _pair_counts(shard_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in shards(batches, shard_words):
            h, n = np.unique(shard.two[shard.paired], return_counts=True)
            del shard
            yield pd.DataFrame({"h": h.view(np.int64), "n": n})
            del h, n
    return run


_BOUNDS = "h bigint, n bigint, pair array<string>, lang string"


def _triple_counts(bits, shard_words: int, longest: int, least: int):
    """Rows of three kinds: hashes with counts (triples, and marked words as if they had reached `least`), sampled pairs, and words per language."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in shards(batches, shard_words):
            pair = shard.pairs(bits.value)
            at = np.flatnonzero(pair[:-1] & pair[1:]) if longest > 2 else np.zeros(0, np.int64)
            h, n = np.unique(shard.triples(at), return_counts=True)
            marked = np.unique(shard.marks()[pair | np.r_[False, pair[:-1]]])
            yield pd.DataFrame({"h": np.r_[h, marked].view(np.int64), "n": np.r_[n, np.full(len(marked), least)], "pair": None, "lang": None})
            some = np.flatnonzero(pair & (shard.two < np.uint64(2**64 // SAMPLED)))
            some = some[np.unique(shard.two[some], return_index=True)[1]].tolist()
            names, words = list(shard.langs), np.bincount(shard.lang, minlength=len(shard.langs)).tolist()
            last = pd.DataFrame({"h": [None] * (len(some) + len(names)), "n": [0] * len(some) + words,
                                 "pair": [[names[shard.lang[i]], shard.text(i), shard.text(i + 1)] for i in some] + [None] * len(names), "lang": [None] * len(some) + names})
            del shard, pair, at, h, n, marked
            yield last
    return run


def bitmap(counts: DataFrame, least: int) -> np.ndarray:
    """Bits of the hashes (h, n) that reach `least` in all; the number of bits is a power of two.

    Counts are combined per shard, so a pair that a third of the corpus consists of is one row per shard. The bitmap has 64 bits for every
    hash in it, between 2^20 and 2^28 bits; beyond that it lets more through, and nothing is lost.
    """
    frequent = stored(counts.repartition("h").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h"), "phrase-hashes")
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(64 * frequent.count() + 1))))
    place = F.col("h").bitwiseAND(bits - 1)
    cells = frequent.groupBy(F.shiftright(place, 5).cast("int").alias("cell")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((h & {bits - 1}) % 32 as int))")).alias("mask"))
    found = cells.toPandas()  # at most bits / 32 rows
    out = np.zeros(bits // 32, np.uint32)
    out[found["cell"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).astype(np.uint32)
    return out


def _seen(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.empty(len(h), bool)
    for i in range(0, len(h), SOME_WORDS):
        place = h[i:i + SOME_WORDS] & np.uint64(len(bits) * 32 - 1)
        out[i:i + SOME_WORDS] = (bits[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & 1 == 1
    return out


def counted_windows(shard: Shard, pair_bits: np.ndarray, triple_bits: np.ndarray, longest: int) -> Iterator[tuple[tuple[str, ...], int]]:
    """The phrases of a shard that the bitmaps let through, with their counts, sorted; the language is the first word of a key.

    They are counted at once, and wait as rows of small numbers. Strings are made of them one by one, when the shard can be gone.
    """
    windows, found, langs, names = _window_rows(shard, pair_bits, triple_bits, longest)
    order = np.lexsort(windows.T[::-1])

    def items() -> Iterator[tuple[tuple[str, ...], int]]:
        for i in range(0, len(order), SOME_WORDS):
            some = order[i:i + SOME_WORDS]
            for (lang, *words), n in zip(windows[some].tolist(), found[some].tolist(), strict=True):
                yield (langs[lang], *[names[t] for t in words if t]), n
    return items()


def _window_rows(shard: Shard, pair_bits: np.ndarray, triple_bits: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, list[str], list[str]]:
    """One row of numbers per phrase (language, words, 0 after the last), its counts, and the sorted names of languages and words."""
    pair = shard.pairs(pair_bits)
    triple, triples_at = np.zeros(len(pair), bool), np.flatnonzero(pair[:-1] & pair[1:])
    triple[triples_at[_seen(shard.triples(triples_at), triple_bits)]] = True
    at = np.flatnonzero(_seen(shard.marks(), triple_bits))
    del triples_at
    # Words are told apart by their bytes; only those that stand in some pair need a number.
    numbers, data = _Numbers({b"": 0}), shard.data
    tokens = np.zeros(len(pair), np.int32)
    for i in range(0, len(at), SOME_WORDS):
        some = at[i:i + SOME_WORDS]
        tokens[some] = [numbers[data[a:z]] for a, z in zip(shard.starts[some].tolist(), shard.ends[some].tolist(), strict=True)]
    (names, words), (langs, lang) = _in_order([w.decode() for w in numbers]), _in_order(list(shard.langs))
    tokens, lang, width = words[tokens], lang[shard.lang], len(names)
    rows, found, rank = [], [], np.zeros(len(tokens), np.int32)
    for k in range(1, longest + 1):
        if k > 1:
            at = at[at + k - 1 < len(tokens)]
            at = at[pair[at]] if k == 2 else at[triple[at + k - 3]]
        if not len(at):
            break
        key = (lang if k == 1 else rank)[at].astype(np.int64) * width
        key += tokens[at + k - 1]
        kinds, n = np.unique(key, return_counts=True)
        group = np.searchsorted(kinds, key)
        rank[at] = group
        one = np.empty(len(kinds), np.int64)
        one[group] = at
        del key, kinds, group
        row = np.zeros((len(one), longest + 1), np.int32)
        row[:, 0] = lang[one]
        for j in range(k):
            row[:, j + 1] = tokens[one + j]
        rows.append(row)
        found.append(n)
    return np.concatenate(rows or [np.zeros((0, longest + 1), np.int32)]), np.concatenate(found or [np.zeros(0, np.int64)]), langs, names


def _in_order(names: list[str]) -> tuple[list[str], np.ndarray]:
    """The names sorted, and the place of each there."""
    order = sorted(range(len(names)), key=names.__getitem__)
    place = np.empty(len(names), np.int32)
    place[order] = np.arange(len(names), dtype=np.int32)
    return [names[i] for i in order], place


def _place(key: tuple[str, ...]) -> tuple[str, str, str]:
    """What decides the range of a key: language and first two words."""
    return key[0], key[1], key[2] if len(key) > 2 else ""


def cut_points(pairs: DataFrame, range_pairs: int) -> list[tuple[str, str, str]]:
    """Ends of ranges in which shards have about `range_pairs` pairs, from at most `MOST_CUTS` of the sampled pairs."""
    number = pairs.count() * SAMPLED
    found = sorted({tuple(r["pair"]) for r in pairs.orderBy(F.xxhash64("pair"), "pair").limit(MOST_CUTS).collect()})
    ranges = min(len(found), -(-number // range_pairs))
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)})


def _shard_automata(pair_bits, triple_bits, longest: int, shard_words: int, cuts: list[tuple[str, str, str]]):
    """One automaton per shard and range."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in shards(batches, shard_words):
            items = counted_windows(shard, pair_bits.value, triple_bits.value, longest)
            del shard
            rows, size = [], 0
            for place, some in groupby(items, key=lambda item: bisect_right(cuts, _place(item[0]))):
                rows.append((place, build(some).to_bytes()))
                size += len(rows[-1][1])
                if size > CHUNK_BYTES:
                    yield pd.DataFrame(rows, columns=["range", "automaton"])
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=["range", "automaton"])
    return run


def _grouped(batches: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows sorted by range to (range, its rows), one range at a time."""
    rows = (row for batch in batches for row in zip(*[batch[c].tolist() for c in ("range", *columns)], strict=True))
    return groupby(rows, key=lambda row: row[0])


def _unite(least: int):
    """Parts of each range to one automaton with summed weights, without those below `least`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for place, rows in _grouped(batches, "automaton"):
            whole, held, size, whole_size = [], [], 0, 0
            for _, data in rows:
                held.append(Automaton.from_bytes(data))
                size += len(data)
                if size > max(UNITE_BYTES, whole_size):
                    whole, held, whole_size, size = [union(whole + held)], [], whole_size + size, 0
            yield pd.DataFrame({"range": [place], "automaton": [union(whole + held, least).to_bytes()]})
    return run


def _ask(cuts: list[tuple[str, str, str]]):
    """Ranges to the parts they need to know, as one automaton per range that holds them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for place, rows in _grouped(batches, "automaton"):
            for _, data in rows:
                wanted: dict[int, set] = {}
                for (lang, *words), _ in Automaton.from_bytes(data).items():
                    if len(words) > 1:
                        for part in [words[:1], *[words[k:] for k in range(1, len(words))]]:
                            key = (lang, *part)
                            wanted.setdefault(bisect_right(cuts, _place(key)), set()).add(key)
                found = [(to, place, build((k, 1) for k in sorted(keys)).to_bytes()) for to, keys in sorted(wanted.items())]
                yield pd.DataFrame(found, columns=["range", "source", "automaton"])
    return run


def _answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per range its own automaton (source -1), then the questions of other ranges: each composed with the counts."""
    for _, rows in _grouped(batches, "source", "automaton"):
        own = None
        for _, source, data in rows:
            if source < 0:
                own = Automaton.from_bytes(data)
            else:
                yield pd.DataFrame({"range": [source], "source": [0], "automaton": [compose(Automaton.from_bytes(data), own).to_bytes()]})


_CANDIDATES = "lang string, words array<string>, a bigint, cuts array<struct<l:bigint,r:bigint>>"


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per range its own automaton and the answers: phrases of two words or more with the counts of both parts of every cut."""
    for _, rows in _grouped(batches, "source", "automaton"):
        (_, _, data), own, part = next(rows), [], {}
        whole = Automaton.from_bytes(data)
        for _, _, answer in rows:
            part.update(Automaton.from_bytes(answer).items())
        for key, a in whole.items():
            lang, *words = key
            if len(words) > 1:
                cuts = [{"l": part[lang, words[0]] if k == 1 else whole.weight(key[:k + 1]), "r": part[lang, *words[k:]]} for k in range(1, len(words))]
                own.append((lang, words, a, cuts))
        for i in range(0, len(own), 10_000):
            yield pd.DataFrame(own[i:i + 10_000], columns=["lang", "words", "a", "cuts"])


def counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, shard_words: int = SHARD_WORDS,
           range_pairs: int = RANGE_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Phrases of two words or more that stand at least `least` times (lang, words, a, cuts), and the word totals (lang, n)."""
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    pair_bits = context.broadcast(bitmap(texts.mapInPandas(_pair_counts(shard_words), "h bigint, n bigint"), least))
    bounds = stored(texts.mapInPandas(_triple_counts(pair_bits, shard_words, longest, least), _BOUNDS), "phrase-bounds")
    triple_bits = context.broadcast(bitmap(bounds.where("h is not null").select("h", "n"), least))
    totals = bounds.where("lang is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = cut_points(bounds.where("pair is not null").select("pair"), range_pairs)
    parts = texts.mapInPandas(_shard_automata(pair_bits, triple_bits, longest, shard_words, cuts), "range int, automaton binary")
    ranges = stored(parts.repartition("range").sortWithinPartitions("range").mapInPandas(_unite(least), "range int, automaton binary"), "phrase-ranges")
    row = "range int, source int, automaton binary"
    own = ranges.select("range", F.lit(-1).alias("source"), "automaton")

    def met(other: DataFrame) -> DataFrame:
        return own.unionByName(other).repartition("range").sortWithinPartitions("range", "source")

    answers = met(ranges.mapInPandas(_ask(cuts), row)).mapInPandas(_answer, row)
    return met(answers).mapInPandas(_candidates, _CANDIDATES), totals


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, inside: int = 100, shard_words: int = SHARD_WORDS,
         range_pairs: int = RANGE_PAIRS) -> DataFrame:
    """(lang, rank, phrase, words, a, l, r, n, score): the best `top` phrases of each language by collocation score.

    With n words in all, a occurrences of the phrase and l and r of its parts, a cut scores floor(1000 a n / (l r)); the cut with the lowest
    score counts, of equal ones the earliest. A phrase goes if its words stand inside a longer candidate with 100 f >= `inside` a.
    Order: score, then a, both falling, then the phrase by its bytes. Arithmetic is exact (38 digits).

    `docs` needs text and lang; other columns play no part. Null and empty texts have no words; a null lang is `und`. Repeated
    rows count each time. An empty table gives an empty result. Of the longer candidates only those one word longer need a look: if any
    longer one has enough occurrences, so has the phrase between, which is a candidate as well.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur at least once")
    found, totals = counts(docs, longest, least, shard_words, range_pairs)
    found = stored(found.withColumn("phrase", F.array_join("words", " ")), "phrase-candidates")
    # The first cut's right part and the last cut's left part are the phrases one word shorter.
    shorter = found.where(F.size("words") > 2).select("lang", F.inline(F.array(
        F.struct(F.array_join(F.expr("slice(words, 1, size(words) - 1)"), " ").alias("phrase"), F.element_at("cuts", -1)["l"].alias("f"), F.col("a")),
        F.struct(F.array_join(F.expr("slice(words, 2, size(words) - 1)"), " ").alias("phrase"), F.element_at("cuts", 1)["r"].alias("f"), F.col("a")))))
    swallowed = shorter.where(F.lit(100) * F.col("a") >= F.lit(inside) * F.col("f")).select("lang", "phrase").distinct()
    left = found.join(swallowed, ["lang", "phrase"], "left_anti").join(small_side(totals), "lang")
    score = ("transform(cuts, (c, i) -> named_struct('score', cast(1000 as decimal(38, 0)) * a * n div (cast(c.l as decimal(38, 0)) * c.r), 'k', i, 'l', c.l, 'r', c.r))")
    scored = left.withColumn("best", F.array_min(F.expr(score))).select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "words", "a", "l", "r", "n", "score"))
