"""Removal of repeated byte strings by suffix arrays, built by linear grouping.

Every 200-byte window of a text is assigned to the smallest hash of a 32-byte string in it; equal windows share that
hash wherever they stand. Windows in a row with one hash form a context. Contexts whose hash occurs once are left out;
the others of one hash meet in one task, equal ones merged, and the suffixes of each such set are sorted. Suffixes of
equal 200 bytes are neighbours in the sorted order, so comparing neighbours finds every repeated window.

The sort is by groups. First, groups of suffixes with one Lyndon prefix are taken in descending order; each suffix of
a group lengthens the prefix of the nearest smaller suffix on its left (the previous-smaller pointer), which splits off
a larger group. Then groups are taken in ascending order and each is put in order by the ranks of what follows its
prefix, which lie in smaller groups. No name is given twice and nothing recurs. Many small sets are sorted in step.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage
from carestrata.llm.decontam import key_filter

LENGTH = 200
GRAM = 32
#: window starts looked at together, and window starts of a context
CHUNK = 1 << 16
LONGEST_RUN = 512
#: a hash with more different contexts is not sorted in one task: they are cut again by other hashes, ...
MAX_CONTEXTS = 4096
#: ... and after so many cuts their windows are compared by digest, wherever they are
LEVELS = 2
#: bytes of contexts sorted in step
BATCH_BYTES = 3 << 20

_BASE = 0xD6E8FEB86659FD93


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = CHUNK + 4096
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        power = np.full(n, base, dtype=np.uint64)
        power[0] = 1
        out.append(np.cumprod(power, dtype=np.uint64))
    return out[0], out[1]


def _sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any string of ``data`` follows."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(data)], out=total[1:])
    return total


def _hashes(total: np.ndarray, width: int, level: int) -> np.ndarray:
    """Hash of the string of ``width`` bytes at each place; every level has other hashes."""
    h = (total[width:] - total[:-width]) * _powers()[1][: max(len(total) - width, 0)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9 + 2 * level)
    h ^= h >> np.uint64(32)
    return h


def _window_keys(data: np.ndarray, length: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all short strings, and the smallest in each window of ``length`` bytes."""
    h = _hashes(_sums(data), GRAM, level)
    width, m = length - GRAM + 1, len(h)
    padded = np.concatenate((h, np.full((-m) % width, 2**64 - 1, dtype=np.uint64))).reshape(-1, width)
    to_right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    to_left = np.minimum.accumulate(padded, axis=1).ravel()
    least = np.minimum(to_right[: m - width + 1], to_left[width - 1 : m])
    return h, least


def contexts(text: bytes, length: int = LENGTH, level: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(key, first, last, twice)`` of each run of window starts with one key.

    ``twice`` is true wherever the key's string may stand twice in the run, so that the run may repeat itself.
    """
    width = length - GRAM + 1
    parts: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(text) - length + 1, CHUNK):
        data = np.frombuffer(text, dtype=np.uint8)[begin : begin + CHUNK + length - 1]
        h, least = _window_keys(data, length, level)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate((np.zeros(1, np.int64), cut))
        end = np.append(cut, len(least))
        # places that are the smallest of some window; equal ones of one run are neighbours among them
        edged = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
        padded = np.concatenate((edged, np.zeros((-len(edged)) % width, np.uint64))).reshape(-1, width)
        to_right = np.maximum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        to_left = np.maximum.accumulate(padded, axis=1).ravel()
        at = np.flatnonzero(h == np.maximum(to_right[: len(h)], to_left[width - 1 : width - 1 + len(h)]))
        equal = np.concatenate((np.zeros(1, np.int64), np.cumsum(h[at[1:]] == h[at[:-1]])))
        low, high = np.searchsorted(at, first), np.searchsorted(at, end + width - 1)
        twice = (high - low >= 2) & (equal[np.maximum(high - 1, 0)] > equal[np.minimum(low, len(at) - 1)])
        pieces = -(-(end - first) // LONGEST_RUN)
        if pieces.max() > 1:
            twice |= pieces > 1
            starts = np.repeat(first, pieces) + LONGEST_RUN * _ranges(np.zeros(len(pieces), np.int64), pieces)
            end = np.minimum(np.repeat(end, pieces), starts + LONGEST_RUN)
            first, twice = starts, np.repeat(twice, pieces)
        parts.append((least[first].astype(np.int64), begin + first, begin + end - 1, twice))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, ``counts`` long."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def lyndon_groups(text: np.ndarray, string: np.ndarray, problem: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group the suffixes of many strings by their Lyndon prefixes.

    ``text`` holds the strings one after another, ``string`` and ``problem`` the string and the sorted set that a place
    belongs to (both ascending). Returns for each place its group (groups of a problem ascend with their prefixes) and
    the length of its prefix, the order of places by group, and the size of each group at its number.
    """
    n = len(text)
    place = np.arange(n)
    slot = np.argsort(problem * 256 + text, kind="stable")
    where = np.empty(n, dtype=np.int64)
    where[slot] = place
    label = (problem * 256 + text)[slot]
    new = np.concatenate(([True], label[1:] != label[:-1]))
    group = np.empty(n, dtype=np.int64)
    group[slot] = np.maximum.accumulate(np.where(new, place, 0))
    size = np.bincount(group, minlength=n)
    length = np.ones(n, dtype=np.int64)
    edge = np.concatenate(([True], string[1:] != string[:-1]))
    left = np.where(edge, -1, place - 1)
    right = np.where(np.append(edge[1:], True), -1, place + 1)
    inside = np.zeros(n, dtype=bool)
    chosen = np.zeros(n, dtype=bool)
    bottom = np.flatnonzero(np.concatenate(([True], problem[1:] != problem[:-1])))
    end = np.append(bottom[1:], n)
    while len(end):
        # the highest group of each problem that is not done; its prefixes are final
        top = group[slot[end - 1]]
        members = slot[_ranges(top, end - top)]
        inside[members] = True
        before, after = left[members], right[members]
        for near, link in ((before, left), (after, right)):
            within = np.flatnonzero(near >= 0)
            while len(within := within[inside[near[within]]]):
                near[within] = link[near[within]]
                link[members[within]] = near[within]
                within = within[near[within] >= 0]
        inside[members] = False
        there = after >= 0
        left[after[there]] = before[there]
        there = before >= 0
        right[before[there]] = after[there]
        smaller, times = np.unique(before[there], return_counts=True)
        if len(smaller):
            np.add.at(length, before[there], length[members[there]])
            old = group[smaller]
            order = np.lexsort((times, old))
            smaller, times, old = smaller[order], times[order], old[order]
            fresh = np.concatenate(([True], old[1:] != old[:-1]))
            heads = old[fresh]
            moved = np.diff(np.append(np.flatnonzero(fresh), len(old)))
            tail = heads + size[heads] - moved
            target = _ranges(tail, moved)
            chosen[smaller] = True
            standing = slot[target]
            standing = standing[~chosen[standing]]
            chosen[smaller] = False
            at = where[smaller]
            freed = at[at < np.repeat(tail, moved)]
            slot[freed] = standing
            where[standing] = freed
            slot[target] = smaller
            where[smaller] = target
            split = fresh | np.concatenate(([True], times[1:] != times[:-1]))
            begins = np.flatnonzero(split)
            size[heads] -= moved
            number = target[begins]
            counts = np.diff(np.append(begins, len(old)))
            size[number] = counts
            group[smaller] = np.repeat(number, counts)
        going = top > bottom
        end, bottom = top[going], bottom[going]
    return group, length, slot, size


def suffix_ranks(text: np.ndarray, string: np.ndarray, problem: np.ndarray) -> np.ndarray:
    """Rank of every suffix among those of its problem; equal suffixes have equal ranks. Arguments as for the groups."""
    group, length, slot, size = lyndon_groups(text, string, problem)
    n = len(text)
    last = np.searchsorted(string, string, side="right")  # end of each place's string
    rank = np.full(n + 1, -1, dtype=np.int64)
    bottom = np.flatnonzero(np.concatenate(([True], problem[1:] != problem[:-1])))
    end = np.append(bottom[1:], n)
    now = bottom
    while len(now):
        members = slot[_ranges(now, size[now])]
        owner = np.repeat(now, size[now])
        follow = members + length[members]
        copies = np.ones(len(members), dtype=np.int64)
        # the same prefix again: more copies of it before something smaller make a larger suffix
        same = np.flatnonzero(follow < last[members])
        while len(same := same[group[follow[same]] == group[members[same]]]):
            follow[same] += length[members[same]]
            copies[same] += 1
            same = same[follow[same] < last[members[same]]]
        rest = np.where(follow < last[members], rank[np.minimum(follow, n)], -1)
        order = np.lexsort((rest, copies, owner))
        members, copies, rest, owner = members[order], copies[order], rest[order], owner[order]
        differs = np.ones(len(members), dtype=bool)
        differs[1:] = (owner[1:] != owner[:-1]) | (copies[1:] != copies[:-1]) | (rest[1:] != rest[:-1])
        slots = _ranges(now, size[now])
        rank[members] = np.maximum.accumulate(np.where(differs, slots, 0))
        slot[slots] = members
        now = now + size[now]
        going = now < end
        now, end = now[going], end[going]
    return rank[:n]


def repeated_windows(problems: list[list[bytes]], length: int = LENGTH) -> list[list[np.ndarray]]:
    """For each set of strings and each string the starts of its windows that stand anywhere else in the set."""
    strings = [s for p in problems for s in p]
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    text = np.frombuffer(b"".join(strings), dtype=np.uint8)
    string = np.repeat(np.arange(len(strings)), sizes)
    of_string = np.repeat(np.arange(len(problems)), [len(p) for p in problems])
    problem = of_string[string]
    rank = suffix_ranks(text.astype(np.int64), string, problem)
    begins = np.cumsum(sizes) - sizes
    windows = _ranges(begins, np.maximum(sizes - length + 1, 0))
    windows = windows[np.lexsort((rank[windows], problem[windows]))]
    flags = np.zeros(len(text), dtype=bool)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eights = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(text), 1), (1, 1), writeable=False)[:, 0]
    for begin in range(0, len(windows) - 1, 1 << 15):
        a, b = windows[begin : begin + (1 << 15)], windows[begin + 1 : begin + 1 + (1 << 15)]
        a = a[: len(b)]
        same = problem[a] == problem[b]
        for k in [*range(0, length - 7, 8), length - 8]:
            at = np.flatnonzero(same)
            if not len(at):
                break
            same[at] = eights[a[at] + k] == eights[b[at] + k]
        flags[a[same]] = True
        flags[b[same]] = True
    out, k = [], 0
    for p in problems:
        out.append([np.flatnonzero(flags[begins[i] : begins[i] + sizes[i]]) for i in range(k, k + len(p))])
        k += len(p)
    return out


def possible_repeats(keys: list[int], problems: list[list[bytes]], length: int = LENGTH, level: int = 0) -> list[list[bool]]:
    """For each string of each set whether a window of it may stand anywhere else in the set; ``False`` is certain.

    Every window of a set holds the short string its key is the hash of, with ``length - GRAM`` bytes around it. Of two
    equal windows the half of those bytes that stand before it, or the half that stand after it, are therefore equal.
    """
    half = -(-(length - GRAM) // 2)
    strings = [s for p in problems for s in p]
    of_string = np.repeat(np.arange(len(problems), dtype=np.uint64), [len(p) for p in problems])
    wanted = np.array(keys, dtype=np.int64).astype(np.uint64)[of_string.astype(np.int64)]
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    marks, owners = [], []
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(strings):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CHUNK, side="right")))
        part = np.arange(begin, end)
        total = _sums(np.frombuffer(b"".join(strings[begin:end]), dtype=np.uint8))
        last = np.cumsum(sizes[part])
        owner = np.repeat(np.arange(len(part)), sizes[part])
        at = np.flatnonzero(_hashes(total, GRAM, level) == wanted[part][owner[: max(len(owner) - GRAM + 1, 0)]])
        at = at[at + GRAM <= last[owner[at]]]
        sides = _hashes(total, half, level)
        for side, first in enumerate((at - half, at + GRAM)):
            mine = owner[at]
            inside = (first >= (last - sizes[part])[mine]) & (first + half <= last[mine])
            mine = part[mine[inside]]
            own = (np.uint64(2) * of_string[mine] + np.uint64(side + 1)) * np.uint64(0x9E3779B97F4A7C15)
            marks.append(sides[first[inside]] ^ own)
            owners.append(mine)
        begin = end
    flags = np.zeros(len(strings), dtype=bool)
    if marks:
        _, which, times = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
        flags[np.concatenate(owners)[times[which] > 1]] = True
    found = iter(flags.tolist())
    return [[next(found) for _ in p] for p in problems]


def merged(starts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Byte spans that windows at ascending ``starts`` cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    return list(zip(starts[np.append(0, cut)].tolist(), (starts[np.append(cut, len(starts)) - 1] + length).tolist()))


_SPANS = "array<struct<a: long, b: long>>"
_SPAN_TYPE = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _spans(spans) -> list[dict[str, int]]:
    return [{"a": a, "b": b} for a, b in spans]


def _key_counts(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            met = []
            for text in batch.column(0):
                key, _, _, twice = contexts(text.as_py().encode("utf-8", "surrogatepass"), length)
                met += [key, key[twice]]  # a run that may repeat itself counts twice
            keys, n = np.unique(np.concatenate(met) if met else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.minimum(n, 2), pa.int64())], ["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long")


def _candidates(docs: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """``(text_key, first, key, context_key, context, twice)`` of contexts whose key may be repeated."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(key_filter(spark, repeated, repeated.count()))

    def run(batches):
        bloom = shared.value
        bits = np.uint64(len(bloom) * 32 - 1)

        def there(bit: np.ndarray) -> np.ndarray:
            word = bloom[(bit >> np.uint64(5)).astype(np.int64)]
            return (word >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1

        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                rows = []
                for name, text in zip(*(batch.column(i)[begin : begin + 128].to_pylist() for i in (0, 1))):
                    data = text.encode("utf-8", "surrogatepass")
                    found = contexts(data, length)
                    unsigned = found[0].astype(np.uint64)
                    hit = there(unsigned & bits) & there((unsigned >> np.uint64(32)) & bits)
                    for key, first, last, twice in zip(*(x[hit].tolist() for x in found)):
                        context = data[first : last + length]
                        rows.append((name, first, key, hashlib.blake2b(context, digest_size=16).digest(), context, twice))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["text_key", "first", "key", "context_key", "context", "twice"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
    return docs.select("text_key", "text").mapInArrow(
        run, "text_key binary, first long, key long, context_key binary, context binary, twice boolean"
    )


def _sorted_sets(sets: DataFrame, length: int, level: int = 0) -> DataFrame:
    """``(context_key, spans)`` of contexts of ``sets (key, context_key, context)``, rows of one key in a row.

    Contexts that cannot hold a repeated window (:func:`possible_repeats`) give no row and are not sorted.
    """

    def solve(names, problems):
        found = repeated_windows(problems, length)
        ids = [k for p in names for k in p]
        spans = [_spans(merged(s, length)) for p in found for s in p]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(spans, _SPAN_TYPE)], ["context_key", "spans"])

    def read(batches):
        """Lists of sets of about ``BATCH_BYTES``: their keys, the names of their contexts, and the contexts."""
        keys, names, problems, size = [], [], [], 0
        for batch in batches:
            for key, name, context in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not keys or key != keys[-1]:
                    if size >= BATCH_BYTES:
                        yield keys, names, problems
                        keys, names, problems, size = [], [], [], 0
                    keys.append(key)
                    names.append([])
                    problems.append([])
                names[-1].append(name)
                problems[-1].append(context)
                size += len(context)
        if keys:
            yield keys, names, problems

    def run(batches):
        chosen, problems, size = [], [], 0
        for keys, names, contexts_of in read(batches):
            for name, strings, may in zip(names, contexts_of, possible_repeats(keys, contexts_of, length, level)):
                if any(may):
                    chosen.append([n for n, m in zip(name, may) if m])
                    problems.append([s for s, m in zip(strings, may) if m])
                    size += sum(map(len, problems[-1]))
            if size >= BATCH_BYTES:
                yield solve(chosen, problems)
                chosen, problems, size = [], [], 0
        if problems:
            yield solve(chosen, problems)

    return sets.select("key", "context_key", "context").mapInArrow(run, f"context_key binary, spans {_SPANS}")


def _large_sets(sets: DataFrame, length: int) -> DataFrame:
    """As ``_sorted_sets`` for keys of any number of contexts: windows are compared by 128-bit digests in a shuffle."""

    def digests(batches):
        for batch in batches:
            for name, context, m in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = len(context) - length + 1
                windows = [hashlib.blake2b(context[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.binary()), pa.array(range(n), pa.int64()), pa.array(windows, pa.binary()), pa.array([m] * n, pa.int64())],
                    ["context_key", "at", "window", "m"],
                )

    windows = sets.select("context_key", "context", "m").mapInArrow(digests, "context_key binary, at long, window binary, m long")
    windows = stage(windows, "repeat-windows")
    twice = windows.groupBy("window").agg(F.sum("m").alias("n")).where("n > 1").select("window")
    hits = windows.join(twice, "window").groupBy("context_key").agg(F.sort_array(F.collect_list("at")).alias("at"))

    def spans(batches):
        for batch in batches:
            found = [_spans(merged(np.array(x, dtype=np.int64), length)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN_TYPE)], ["context_key", "spans"])

    return hits.mapInArrow(spans, f"context_key binary, spans {_SPANS}")


def _cut_again(sets: DataFrame, length: int, level: int) -> DataFrame:
    """The contexts of crowded hashes cut by other hashes; what many of them share becomes equal contexts."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = []
                for name, data, m in zip(*(batch.column(i)[begin : begin + 256].to_pylist() for i in range(3))):
                    for key, first, last, twice in zip(*(x.tolist() for x in contexts(data, length, level))):
                        part = data[first : last + length]
                        rows.append((name, first, key, hashlib.blake2b(part, digest_size=16).digest(), part, twice, m))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["text_key", "first", "key", "context_key", "context", "twice", "m"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.int64()]
    return sets.select("context_key", "context", "m").mapInArrow(
        run, "text_key binary, first long, key long, context_key binary, context binary, twice boolean, m long"
    )


def _spans_of(found: DataFrame, length: int, level: int = 0) -> DataFrame:
    """``(text_key, spans)`` from staged contexts ``(text_key, first, key, context_key, context, twice, m)``."""
    distinct = found.groupBy("key", "context_key").agg(
        F.first("context").alias("context"), F.sum("m").alias("m"), F.max("twice").alias("twice")
    )
    distinct = stage(distinct, "repeat-distinct")
    sizes = distinct.groupBy("key").agg(F.count("*").alias("d"))
    sized = stage(distinct.join(sizes.hint("merge"), "key"), "repeat-sized")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.length("context").cast("long").alias("b")))
    copied = sized.where("m > 1").select("context_key", whole.alias("spans"))
    small = sized.where((F.col("d") <= MAX_CONTEXTS) & ((F.col("d") > 1) | ((F.col("m") == 1) & F.col("twice"))))
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_sort = _sorted_sets(small.repartition(parts, "key").sortWithinPartitions("key"), length, level)
    results = copied.union(by_sort)
    large = sized.where(F.col("d") > MAX_CONTEXTS)
    if not large.isEmpty():
        if level < LEVELS:
            again = stage(_cut_again(large, length, level + 1), "repeat-contexts")
            results = results.union(_spans_of(again, length, level + 1))
        else:
            results = results.union(_large_sets(large, length))
    results = stage(results, "repeat-spans").where(F.size("spans") > 0)
    merged_results = results.groupBy("context_key").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    placed = found.select("text_key", "first", "context_key").join(merged_results, "context_key")
    moved = F.transform("spans", lambda s: F.struct((s["a"] + F.col("first")).alias("a"), (s["b"] + F.col("first")).alias("b")))
    each = placed.select("text_key", F.explode(moved).alias("s"))
    return each.groupBy("text_key").agg(F.collect_set("s").alias("spans"))


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(text_key, spans)``: the byte spans of each text of ``texts (text_key, text)`` that repeated windows cover.

    ``text_key`` must be equal for equal texts. The spans of a text are in no order and may overlap.
    """
    counts = _key_counts(texts, length).groupBy("key").agg(F.sum("n").alias("n"))
    repeated = stage(counts.where("n > 1").select("key"), "repeat-keys")
    found = stage(_candidates(texts, repeated, length).withColumn("m", F.lit(1).cast("long")), "repeat-contexts")
    return _spans_of(found, length)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans)`` of every row of ``docs (doc_id, text, ...)``.

    Every byte covered by a ``length``-byte string that also starts anywhere else, in this or another row, is removed;
    ``kept`` is what is left. Null texts count as empty; texts below ``length`` bytes stay whole. Rows are kept apart
    even where a doc_id is null or repeated, and a repeated row is a repeat of its text; other columns are ignored; an
    empty table gives an empty result.
    """
    if length < GRAM + 8:
        raise ValueError(f"repeats below {GRAM + 8} bytes are not looked for")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("text_key"))
    long_enough = keyed.where(F.octet_length("text") >= length)
    spans = stage(repeated_spans(long_enough, length), "repeat-texts")

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                rows = []
                for doc, text, found in zip(*(part.column(i).to_pylist() for i in range(3))):
                    data = text.encode("utf-8", "surrogatepass")
                    runs: list[list[int]] = []
                    for s in sorted(found or [], key=lambda s: (s["a"], s["b"])):
                        if runs and s["a"] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], s["b"])
                        else:
                            runs.append([s["a"], s["b"]])
                    ends = [0, *(x for r in runs for x in r), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))
                    rows.append((doc, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, _spans(runs)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
    number = pa.int64()
    types = [number, number, number, number, pa.string(), pa.binary(), _SPAN_TYPE]
    joined = keyed.join(spans, "text_key", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        run, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans {_SPANS}"
    )
