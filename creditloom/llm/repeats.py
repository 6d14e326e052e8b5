"""Removal of repeated passages by longest previous factors.

LPF[i] is the length of the longest string that starts at byte i and also starts at an earlier byte of the corpus (a smaller
document, or the same one further left). In suffix order it is the larger common prefix of a suffix with its previous and its
next neighbour of smaller position. A start with LPF >= LENGTH repeats; the bytes of its string go, the first copy stays.

A suffix array of the whole corpus can't be cut into tasks, so only suffixes that can repeat are sorted, and those together
that can be equal:

1. Anchors. Every window of LENGTH bytes names the smallest hash among its K-byte strings, rightmost on ties. Equal windows name
   equal anchors. A maximal run of starts with one anchor is the unit: about one in 35 bytes. Units move as (anchor hash,
   hash of the unit's bytes, document, place).
2. Rows of an anchor come sorted. A unit equal to an earlier one repeats as a whole. An anchor with only one kind of unit
   has nothing else; where there are several kinds, the first unit of each needs its bytes compared. Copies inside a
   batch are settled before the shuffle, so a hot passage costs a row per batch. An anchor that shows several kinds in one batch
   (a footer between different neighbours) needs comparing whatever comes: its units are dealt out by their content, and one
   mark per batch tells the units of other batches. So no task gets more than two rows of an anchor from a batch, whatever repeats.
3. The bytes of those units are sorted in suffix order, anchor by anchor, cut at LENGTH; common prefixes of neighbours and previous and next
   smaller positions give LPF, cut at LENGTH. An anchor with more than GROUP units is not gathered in one task: its windows move one by one
   under their own hash, again after the copies inside a task are settled, and equal ones, byte by byte, meet there. LENGTH bytes
   are all that a window has, so an equal earlier one is its previous factor. Which way is taken changes memory, not the result.
4. The spans meet their documents, and the bytes outside them are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stored
from creditloom.llm.winnowing import _POWERS, rolling_hashes
from creditloom.session import small_side

LENGTH, K = 100, 32
GROUP = 8192
_LEN_BITS = 8
_HALF = np.uint64(32)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefix:
    """Hashes of any substrings of one byte string, from prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, down = _POWERS.upto(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[:len(data)], dtype=np.uint64)]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[ends] - self.sums[starts]) * self.up[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def units(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per unit: anchor hash, first start, number of starts, hash of its bytes with the anchor's place in it."""
    h = rolling_hashes(data, k)
    w = length - k + 1
    # Minimum of each window of w hashes, rightmost on ties, by joining spans.
    low, at, span = (h >> _HALF).astype(np.uint32), np.arange(len(h), dtype=np.int32), 1
    while span < w:
        step = min(span, w - span)
        left, right = low[:len(low) - step], low[step:]
        at = np.where(right <= left, at[step:], at[:len(at) - step])
        low, span = np.minimum(left, right), span + step
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[first, len(at)])
    anchor = at[first]
    content = Prefix(data).of(first, first + count - 1 + length)
    return h[anchor].view(np.int64), first, count, _mixed(content + (anchor - first).astype(np.uint64)).view(np.int64)


def _packed(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 32) | count.astype(np.int64)


def _settle(keys: tuple[np.ndarray, ...], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by keys and place, and which of the sorted rows have an equal earlier one."""
    order = np.lexsort((at, doc, *keys[::-1]))
    again = np.ones(len(order), bool)
    if len(order):
        again[0] = False
        again[1:] = np.logical_and.reduce([key[order][1:] == key[order][:-1] for key in keys])
    return order, again


# `dealt` is 0, or the content hash of a unit that is dealt out by it; `kind` one of the following.
_UNITS = "h bigint, dealt bigint, kind tinyint, c bigint, doc bigint, at bigint"
_MARK, _UNIT, _SETTLED = np.int8(0), np.int8(1), np.int8(2)


def _emit_units(length: int, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for doc, text in zip(batch["doc"].to_numpy(), batch["text"], strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                if len(data) >= length:
                    h, start, count, c = units(data, length, k)
                    parts.append((h, c, np.full(len(h), doc, np.int64), _packed(start, count)))
            if not parts:
                continue
            h, c, doc, at = (np.concatenate(p) for p in zip(*parts, strict=True))
            order, again = _settle((h, c), doc, at)
            h, c, doc, at = h[order], c[order], doc[order], at[order]
            left = np.flatnonzero(~again)
            new = np.r_[True, h[left][1:] != h[left][:-1]]
            kinds = np.bincount(np.cumsum(new) - 1)
            several = np.repeat(kinds > 1, kinds)
            yield pd.DataFrame({"h": h[left], "dealt": np.where(several, c[left] | 1, 0), "kind": _UNIT, "c": c[left], "doc": doc[left], "at": at[left]})
            marked = h[left][new & several]
            if len(marked):
                yield pd.DataFrame({"h": marked, "dealt": 0, "kind": _MARK, "c": 0, "doc": 0, "at": 0})
            if again.any():
                # Settled copies ride along, joined to spans of their document.
                yield _spans_frame(doc[again], at[again] >> 32, (at[again] >> 32) + (at[again] & 0xFFFFFFFF) - 1 + length)
    return run


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of one document joined."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # The running maximum is taken over document number and end together, so that it starts anew with each document.
    number = np.cumsum(np.r_[False, doc[1:] != doc[:-1]]).astype(np.int64)
    reach = np.maximum.accumulate((number << 32) | end)
    new = np.r_[True, (number[1:] << 32 | start[1:]) > reach[:-1]]
    first = np.flatnonzero(new)
    return doc[first], start[first], np.maximum.reduceat(end, first)


def _spans_frame(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    doc, start, end = merged(doc, start, end)
    with np.errstate(over="ignore"):
        spread = _mixed(doc.view(np.uint64) + start.astype(np.uint64)).view(np.int64)
    return pd.DataFrame({"h": spread, "dealt": np.int64(0), "kind": _SETTLED, "c": np.int64(0), "doc": doc, "at": _packed(start, end - start)})


_FINDINGS = "doc bigint, at bigint, h bigint, span boolean"


def _find(length: int):
    """Rows sorted by h, dealt, kind, c, doc, at: spans of repeated units, and (with their anchor) first units that need their bytes compared.

    The rows of one (h, dealt) are a group. A dealt group and one that starts with a mark need comparing from the first unit on.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = last_c = None  # the open group, and its last kind of unit
        sure = False  # whether the open group is known to need comparing
        pending = None  # its only kind of unit so far, where it is not
        for batch in batches:
            settled = batch["kind"].to_numpy() == _SETTLED
            done = batch[settled]
            if len(done):
                yield pd.DataFrame({"doc": done["doc"], "at": done["at"], "h": np.int64(0), "span": True})
            rest = batch[~settled]
            if not len(rest):
                continue
            h, dealt, kind, c, doc, at = (rest[n].to_numpy() for n in ("h", "dealt", "kind", "c", "doc", "at"))
            unit = kind == _UNIT
            goes_on = last == (h[0], dealt[0])
            new = np.r_[not goes_on, (h[1:] != h[:-1]) | (dealt[1:] != dealt[:-1])]
            group = np.cumsum(new) - new[0]
            # The row before a unit may be a mark, which is no unit of any kind.
            again = unit & ~new & np.r_[goes_on and last_c == c[0], unit[:-1] & (c[1:] == c[:-1])]
            if again.any():
                start, count = at[again] >> 32, at[again] & 0xFFFFFFFF
                d, s, e = merged(doc[again], start, start + count - 1 + length)
                yield pd.DataFrame({"doc": d, "at": _packed(s, e - s), "h": np.int64(0), "span": True})
            first = unit & ~again
            kinds = np.bincount(group, weights=first).astype(np.int64)
            compare = (kinds > 1) | (np.bincount(group, weights=~unit | (dealt != 0)) > 0)
            if goes_on:
                # A new kind joins the one that came before.
                compare[0] |= sure or (pending is not None and kinds[0] > 0)
            firsts = np.flatnonzero(first & compare[group])
            out = [(doc[firsts], at[firsts], h[firsts])]
            if goes_on and compare[0] and pending is not None:
                out.append(tuple(np.array([x]) for x in pending))
            if not goes_on or len(kinds) > 1 or compare[0]:
                pending = None
            sure = bool(compare[-1])
            only = np.flatnonzero(first & (group == group[-1]))
            if len(only) and not sure:
                pending = (doc[only[0]], at[only[0]], h[only[0]])
            d, a, g = (np.concatenate(x) for x in zip(*out, strict=True))
            if len(d):
                yield pd.DataFrame({"doc": d, "at": a, "h": g, "span": False})
            last, last_c = (h[-1], dealt[-1]), c[-1] if unit[-1] else None
    return run


_SUFFIXES = "h bigint, doc bigint, start bigint, n int, data binary"


def _emit_suffixes(length: int):
    """Bytes of the units to compare. `hot` units are cut to windows, each under its own hash."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, hot = [], []
            for doc, text, found in zip(batch["doc"].to_numpy(), batch["text"], batch["units"], strict=True):
                if found is None or not len(found):
                    continue
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                prefix = None
                for unit in found:
                    start, count = unit["at"] >> 32, unit["at"] & 0xFFFFFFFF
                    if not unit["hot"]:
                        rows.append((unit["h"], doc, start, count, raw[start:start + count - 1 + length]))
                        continue
                    prefix = prefix or Prefix(data)
                    starts = np.arange(start, start + count)
                    one = prefix.of(starts, starts + length)
                    windows = np.lib.stride_tricks.sliding_window_view(data, length)[start:start + count]
                    hot.append((one.view(np.int64), windows, np.full(count, doc, np.int64), starts))
            if rows:
                yield pd.DataFrame(rows, columns=["h", "doc", "start", "n", "data"]).astype({"h": "int64", "doc": "int64", "start": "int64", "n": "int32"})
            if hot:
                one, windows, doc, start = (np.concatenate(x) for x in zip(*hot, strict=True))
                order, again = _settle((one,), doc, start)
                # Equal hashes are equal windows only if their bytes are.
                again[1:] &= (windows[order[1:]] == windows[order[:-1]]).all(axis=1)
                kept = order[~again]
                yield pd.DataFrame({"h": one[kept], "doc": doc[kept], "start": start[kept], "n": np.int32(0), "data": [x.tobytes() for x in windows[kept]]})
                if again.any():
                    d, s, e = merged(doc[order[again]], start[order[again]], start[order[again]] + length)
                    yield pd.DataFrame({"h": _mixed(d.view(np.uint64)).view(np.int64), "doc": d, "start": s, "n": (s - e).astype(np.int32), "data": [b""] * len(d)})
    return run


def common_prefixes(rows: np.ndarray, lead: int) -> np.ndarray:
    """Of each row but the first: how many bytes after the `lead` ones it shares with the row before; none if those differ."""
    same = rows[1:] == rows[:-1]
    shared = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return np.maximum(shared - lead, 0)


def previous_factors(suffixes: np.ndarray, place: np.ndarray, lead: int = 0) -> np.ndarray:
    """LPF of the suffixes, given by their first bytes (rows, after `lead` bytes that name a group): the longest common prefix with
    a suffix of smaller place. `place` orders the suffixes in the corpus.

    In suffix order the longest match of smaller place is the previous or the next neighbour of smaller place. One pass holds the suffixes that
    still wait for a next smaller place; each knows the prefix it shares with its previous smaller place.
    """
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{suffixes.shape[1]}").ravel(), kind="stable")
    shared = [0, *common_prefixes(suffixes[order], lead).tolist()]
    out = np.zeros(len(place), np.int64)
    waiting: list[tuple[int, int, int]] = []  # suffix, its place, prefix shared with its previous smaller place
    for i, p, common in zip(order.tolist(), place[order].tolist(), shared, strict=True):
        while waiting and waiting[-1][1] > p:
            j, _, before = waiting.pop()
            out[j] = max(before, common)
            common = min(common, before)
        waiting.append((i, p, common))
    for j, _, before in waiting:
        out[j] = before
    return out


_SPANS = "doc bigint, start bigint, stop bigint"


def _compare(length: int, chunk: int = 1 << 17):
    """Rows sorted by h, doc, start to repeated spans. Memory: a chunk of windows, or the one bounded anchor that is larger."""
    def lpf(group: list[tuple]) -> pd.DataFrame:
        counts = np.array([g[3] for g in group], np.int64)
        total = int(counts.sum())
        data = np.frombuffer(b"".join(g[4] for g in group), np.uint8)
        begin = np.r_[0, np.cumsum(counts + length - 1)[:-1]]
        inside = np.arange(total) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
        at = np.repeat(begin, counts) + inside
        rows = np.empty((total, 8 + length + 1), np.uint8)
        rows[:, :8] = np.repeat(np.array([g[0] for g in group], ">i8").view(np.uint8).reshape(-1, 8), counts, axis=0)
        rows[:, 8:8 + length] = np.lib.stride_tricks.sliding_window_view(data, length)[at]
        rows[:, -1] = 1  # so that a zero byte at the end counts
        doc = np.repeat(np.array([g[1] for g in group], np.int64), counts)
        start = np.repeat(np.array([g[2] for g in group], np.int64), counts) + inside
        place = np.empty(total, np.int64)
        place[np.lexsort((start, doc))] = np.arange(total)
        found = np.minimum(previous_factors(rows, place, 8), length) == length
        d, s, e = merged(doc[found], start[found], start[found] + length) if found.any() else (doc[:0], start[:0], start[:0])
        return pd.DataFrame({"doc": d, "start": s, "stop": e})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size, seen, open_hash = 0, {}, None
        for batch in batches:
            spans = []
            for row in zip(batch["h"].tolist(), batch["doc"].tolist(), batch["start"].tolist(), batch["n"].tolist(), batch["data"], strict=True):
                h, doc, start, n, data = row
                if n < 0:
                    spans.append((doc, start, start - n))
                elif n == 0:
                    if open_hash != h:
                        open_hash, seen = h, {}
                    if data in seen:
                        spans.append((doc, start, start + length))
                    seen[data] = True
                else:
                    if size >= chunk and held[-1][0] != h:
                        yield lpf(held)
                        held, size = [], 0
                    held.append(row)
                    size += n
            if spans:
                d, s, e = (np.array(x, np.int64) for x in zip(*spans, strict=True))
                d, s, e = merged(d, s, e)
                yield pd.DataFrame({"doc": d, "start": s, "stop": e})
        if held:
            yield lpf(held)
    return run


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): `doc` orders the rows by doc_id. Where ids repeat or are null, rows are sorted and numbered once:
    by doc_id (null last), then text."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    facts = docs.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d")).first()
    kind = docs.schema["doc_id"].dataType.simpleString()
    if facts["n"] == facts["d"] and kind in ("tinyint", "smallint", "int", "bigint"):
        return texts.select(F.col("doc_id").cast("bigint").alias("doc"), "doc_id", "text")
    return stored(texts.orderBy(F.asc_nulls_last("doc_id"), "text").select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"), "repeat-rows")


def repeated_spans(rows: DataFrame, length: int = LENGTH, k: int = K, group: int = GROUP) -> DataFrame:
    """`rows` (doc, text) to (doc, start, stop): byte spans covered by strings of `length` bytes that also start earlier."""
    if not 1 <= k <= length:
        raise ValueError("the anchor fits into the matched length")
    texts = rows.select("doc", "text")
    sorted_units = texts.mapInPandas(_emit_units(length, k), _UNITS).repartition("h", "dealt").sortWithinPartitions("h", "dealt", "kind", "c", "doc", "at")
    findings = stored(sorted_units.mapInPandas(_find(length), _FINDINGS), "repeat-findings")
    compared = findings.where("not span")
    # Few by nature, one per `group` units at most; counted before they are broadcast, and joined by shuffle beyond that.
    hot = small_side(compared.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > group).select("h", F.lit(True).alias("hot")))
    units_of = (compared.join(hot, "h", "left").groupBy("doc")
                .agg(F.collect_list(F.struct("h", "at", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("units")))
    suffixes = texts.join(units_of, "doc", "left").mapInPandas(_emit_suffixes(length), _SUFFIXES)
    spans = suffixes.repartition("h").sortWithinPartitions("h", "doc", "start").mapInPandas(_compare(length), _SPANS)
    whole = findings.where("span").select("doc", F.shiftright("at", 32).alias("start"), (F.shiftright("at", 32) + F.col("at").bitwiseAND(0xFFFFFFFF)).alias("stop"))
    return whole.union(spans)


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, group: int = GROUP) -> DataFrame:
    """Per row of `docs` (doc_id, text): `n_bytes`, `spans` (start, stop of maximal removed runs), `kept` (the other bytes), `kept_sha256`.

    Texts are judged as UTF-8 bytes on the input, not on what is left; matches never cross documents. Null is empty. Of rows that
    share a doc_id, or have none, the smaller text counts as earlier; of equal rows one is the first. `kept` is
    binary, since a cut may split a character. Other columns are not carried.
    """
    rows = _numbered(docs)
    spans = repeated_spans(rows, length, k, group).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                raw = text.encode()
                runs: list[tuple[int, int]] = []
                if found is not None and len(found):
                    start, stop = (np.array([s[n] for s in found], np.int64) for n in ("start", "stop"))
                    _, start, stop = merged(np.zeros(len(start), np.int64), start, stop)
                    runs = list(zip(start.tolist(), stop.tolist(), strict=True))
                edges = [0, *[e for r in runs for e in r], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((doc_id, len(raw), [{"start": a, "stop": b} for a, b in runs], kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept", "kept_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(spans, "doc", "left").select("doc_id", "text", "spans").mapInPandas(
        cut, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary, kept_sha256 string")
