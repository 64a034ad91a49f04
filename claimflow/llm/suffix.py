"""Removal of long repeated strings by a distributed merge sort of suffixes.

Every window of ``length`` bytes has one anchor, the leftmost smallest hash among its
short strings, so equal windows have equal anchors at equal places. Windows in a row
that share an anchor make one stretch. Suffixes are sorted from anchors only: one for
about every half window of text instead of one for every byte, and none for anchors
whose short string starts nowhere else.

1. Stretches of all texts are counted by anchor string and by content. An anchor
   string met once repeats nothing. Stretches with equal content repeat whole.
2. What is left, one stretch for each different content, is sorted: key is the text
   from the anchor on, then the text before it, backwards. Each task sorts runs,
   codes each key as the length it shares with the one before and the rest, and
   sends it to the range of keys it belongs to; ranges are cut by sampled keys of
   full length, so one very common string spreads over many of them. A range merges
   its runs in a loser tree that compares keys only behind the prefix they are known
   to share, which also yields the common prefixes of sorted neighbours.
3. Keys in order give, for every group of one anchor string, how far its members
   agree in both directions, hence which windows of a stretch occur elsewhere. A
   group too large to be matched member by member, or one that a range border cuts,
   names the windows that the common prefixes leave possible, and these are counted
   by content.
4. A text's repeated windows, listed once for all its copies, are joined to each copy
   and cut out.

Defined cases: a null text is empty; texts shorter than ``length`` keep all; repeated
rows and equal texts are occurrences like any others, so nothing of them is kept;
rows are never matched by id, and null or repeated ids do no harm; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_if_small
from claimflow.session import materialise

LENGTH = 400
#: Bytes of the short strings that anchors are chosen among.
SHORT = 16
#: Stretches sorted as one run, and held by one range of keys.
RUN_ROWS = 20_000
RANGE_ROWS = 20_000
SAMPLES_PER_RANGE = 20
#: Ranges that a group of one anchor string may fill before it is cut.
WHOLE_GROUP_RANGES = 3
#: Members of a group that are matched one with another.
GROUP_ROWS = 128
#: Never part of UTF-8.
PAD = 0xFF

KEY = ["k1", "k2"]
STRETCHES = "anchor long, content long, k1 long, k2 long, start int, windows int, back int"


# --- anchors -----------------------------------------------------------------


def short_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``SHORT`` bytes from every position on."""
    n = len(data) - SHORT + 1
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    h = (words[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, from block-wise running minima."""
    n = len(h)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """Anchor hash, first window, windows and distance back from anchor to first window."""
    if len(data) < length:
        return
    width = length - SHORT + 1
    h = short_hashes(np.frombuffer(data, "u1"))
    least = sliding_min(h, width)
    cuts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]])
    values = least[cuts[:-1]]
    for s, e, v in zip(cuts[:-1].tolist(), cuts[1:].tolist(), values.tolist(), strict=True):
        # the same short string may stand in one run of windows several times
        for a in (s + np.flatnonzero(h[s : e - 1 + width] == np.uint64(v))).tolist():
            end = min(e, a + 1)
            if s < end:
                yield v, s, end - s, a - s
                s = end


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The texts of a batch as bytes, one at a time and never decoded."""
    column = batch.column(batch.schema.get_field_index("text"))
    for i in range(len(column)):
        yield column[i].as_buffer().to_pybytes()


def _stretched(length: int):
    kinds = dict(c.split() for c in STRETCHES.split(", "))
    names = list(kinds)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = np.array(rows, "i8").reshape(-1, len(names)).T
        return pa.RecordBatch.from_arrays([pa.array(c.astype("i4" if kinds[n] == "int" else "i8")) for n, c in zip(names, columns, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
            for data, (k1, k2) in zip(_texts(batch), keys, strict=True):
                for v, s, n, back in stretches(data, length):
                    content = xxhash.xxh64_intdigest(data[s : s + n - 1 + length])
                    rows.append((_signed(v), _signed(content), k1, k2, s, n, back))
                if len(rows) >= RUN_ROWS:
                    yield table(rows)
                    rows = []
        yield table(rows)

    return run


# --- runs, front coding and merging --------------------------------------------


def key_width(length: int) -> int:
    """Bytes of a sort key: the text from the anchor on, then the text before it."""
    return 2 * length - SHORT


def keys_of(pieces: list[tuple[bytes, int]], length: int) -> np.ndarray:
    """Sort keys, one row each, of stretches given as text and place of the anchor."""
    out = np.full((len(pieces), key_width(length)), PAD, "u1")
    for i, (text, back) in enumerate(pieces):
        row = np.frombuffer(text, "u1")
        out[i, : len(row) - back] = row[back:]
        out[i, length : length + back] = row[:back][::-1]
    return out


def sort_rows(keys: np.ndarray) -> np.ndarray:
    """The order of the rows by their bytes."""
    return np.argsort(np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").ravel(), kind="stable")


def shared_prefixes(keys: np.ndarray) -> np.ndarray:
    """How many bytes each row of sorted keys shares with the row before."""
    out = np.zeros(len(keys), "i4")
    for at in range(1, len(keys), 4096):
        a, b = keys[at : at + 4096], keys[at - 1 : at - 1 + min(4096, len(keys) - at)]
        differs = a != b
        out[at : at + len(a)] = np.where(differs.any(axis=1), differs.argmax(axis=1), keys.shape[1])
    return out


def front_code(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as shared lengths and the bytes behind them."""
    shared = shared_prefixes(keys)
    rest = keys[np.arange(keys.shape[1]) >= shared[:, None]]
    return shared.astype("<i4").tobytes(), rest.tobytes()


def front_decode(shared: bytes, rest: bytes, width: int) -> list[bytes]:
    """The keys that ``front_code`` was given."""
    out, last, at = [], b"", 0
    for n in np.frombuffer(shared, "<i4").tolist():
        last = last[:n] + rest[at : at + width - n]
        at += width - n
        out.append(last)
    return out


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which the first ``known`` bytes are not looked at."""
    n, at = len(a), known
    while at < n and a[at : at + 32] == b[at : at + 32]:
        at += 32
    while at < n and a[at] == b[at]:
        at += 1
    return min(at, n)


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs of keys with known shared prefixes.

    Yields run, place in the run, and the prefix shared with the key before. A loser
    keeps the prefix it shares with the winner it lost to, so two keys whose shared
    prefixes with the last winner differ are ordered without looking at them, and
    equal prefixes are compared only behind that length.
    """
    k = 1
    while k < len(runs):
        k *= 2
    at = [0] * k
    shared = [0] * k  # of each run's head with the last winner
    live = [i < len(runs) and bool(runs[i][0]) for i in range(k)]
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        if not live[a] or not live[b]:
            return (a, b) if live[a] else (b, a)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = runs[a][0][at[a]], runs[b][0][at[b]]
        n = common_prefix(x, y, shared[a])
        first, second = (a, b) if n == len(x) or x[n] < y[n] else (b, a)
        shared[second] = n
        return first, second

    winners = list(range(k))
    spots = list(range(k))
    level = k
    while level > 1:
        nxt = []
        for j in range(0, level, 2):
            won, lost = play(winners[j], winners[j + 1])
            loser[(level + j) // 2] = lost
            nxt.append(won)
        winners, level = nxt, level // 2
    best = winners[0]
    while live[best]:
        yield best, at[best], shared[best]
        keys, known = runs[best]
        at[best] += 1
        if at[best] < len(keys):
            shared[best] = known[at[best]]
        else:
            live[best] = False
        node = (k + spots[best]) // 2
        while node >= 1:
            won, lost = play(best, loser[node])
            loser[node], best = lost, won
            node //= 2


# --- windows that occur elsewhere ------------------------------------------------


def mutual(keys: np.ndarray, windows: np.ndarray, backs: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each member of one group the (first, last) distances back of repeated windows."""
    out = []
    front, rear = keys[:, :length], keys[:, length:]
    for i in range(len(keys)):
        differs = front != front[i]
        ahead = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
        differs = rear != rear[i]
        behind = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
        low = np.maximum(backs[i] - windows[i] + 1, length - ahead)
        high = np.minimum(backs[i], behind)
        low[i], high[i] = 1, 0
        out.append(sorted({(int(a), int(b)) for a, b in zip(low, high, strict=True) if a <= b}))
    return out


SPANS = "k1 long, k2 long, first int, last int"
PIECES = "k1 long, k2 long, start int, windows int, back int, text binary, alone boolean"
BLOBS = "range int, shared binary, rest binary, k1 binary, k2 binary, start binary, windows binary, back binary, alone binary"
OWN = {"k1": "i8", "k2": "i8", "start": "i4", "windows": "i4", "back": "i4", "alone": "?"}
FOUND = "k1 long, k2 long, first int, last int, digest binary, alone boolean"


def _names(shape: str) -> list[str]:
    return [c.split()[0] for c in shape.split(", ")]


def _cut_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            keys = zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "pieces")], strict=True)
            for data, (k1, k2, pieces) in zip(_texts(batch), keys, strict=True):
                for p in pieces:
                    start, windows, back = p >> 32, p >> 17 & 0x7FFF, p >> 1 & 0xFFFF
                    rows.append((k1, k2, start, windows, back, data[start : start + windows - 1 + length], bool(p & 1)))
                if len(rows) >= RUN_ROWS:
                    yield pd.DataFrame(rows, columns=_names(PIECES))
                    rows = []
            yield pd.DataFrame(rows, columns=_names(PIECES))

    return run


def _as_arrow(frames: Iterator[pd.DataFrame], shape: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in shape.split(", "))])
    for frame in frames:
        yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)


def _sorted_runs(length: int, splitters):
    def blobs(rows: pd.DataFrame) -> Iterator[dict]:
        keys = keys_of(list(zip(rows["text"], rows["back"], strict=True)), length)
        order = sort_rows(keys)
        keys, rows = keys[order], rows.iloc[order]
        listed = keys.view(f"S{keys.shape[1]}").ravel()
        cuts = [0, *np.searchsorted(listed, splitters.value, side="left").tolist(), len(keys)]
        for i, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if s < e:
                shared, rest = front_code(keys[s:e])
                own = {c: rows[c].to_numpy(t)[s:e].tobytes() for c, t in OWN.items()}
                yield {"range": i, "shared": shared, "rest": rest, **own}

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= RUN_ROWS:
                yield pd.DataFrame(list(blobs(pd.concat(held))), columns=_names(BLOBS))
                held = []
        if held and sum(map(len, held)):
            yield pd.DataFrame(list(blobs(pd.concat(held))), columns=_names(BLOBS))

    # cutting and sorting in one step: two would keep twice as many Python workers
    return lambda batches: _as_arrow(runs(_cut_pieces(length)(batches)), BLOBS)


def _merged(length: int, splitters):
    width = key_width(length)

    def is_cut(edge: int, prefix: bytes) -> bool:
        """Whether a border of ranges lies inside the group of that short string."""
        if not 0 <= edge < len(splitters.value):
            return False
        key = splitters.value[edge].ljust(width, b"\0")
        return key[:SHORT] == prefix and any(key[SHORT:])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        runs, own = [], []
        for row in frame.itertuples(index=False):
            runs.append((front_decode(row.shared, row.rest, width), np.frombuffer(row.shared, "<i4").tolist()))
            own.append({c: np.frombuffer(getattr(row, c), t) for c, t in OWN.items()})
        order = list(merge(runs))
        keys = np.frombuffer(b"".join([runs[r][0][i] for r, i, _ in order]), "u1").reshape(-1, width)
        shared = np.array([n for _, _, n in order])
        bases = np.cumsum([0, *[len(r[0]) for r in runs]])
        at = np.array([bases[r] + i for r, i, _ in order])
        of = {c: np.concatenate([o[c] for o in own])[at] for c in OWN}
        out: list[pd.DataFrame] = []
        edges = np.concatenate([np.flatnonzero(shared < SHORT), [len(keys)]])
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            mine = {c: v[s:e] for c, v in of.items()}
            prefix, at = keys[s, :SHORT].tobytes(), int(frame["range"].iloc[0])
            before, behind = s == 0 and is_cut(at - 1, prefix), e == len(keys) and is_cut(at, prefix)
            if e - s > GROUP_ROWS or before or behind:
                # neighbours beyond a border may share everything
                ahead = np.maximum(
                    np.append(length if before else 0, shared[s + 1 : e]), np.append(shared[s + 1 : e], length if behind else 0)
                )
                out.append(_windows(keys[s:e], mine, np.minimum(ahead, length), length, before or behind))
            elif mine["alone"].any():
                out.append(_matched(keys[s:e], mine, length))
        return pd.concat(out) if out else pd.DataFrame(columns=_names(FOUND))

    return run


def _matched(keys: np.ndarray, of: dict, length: int) -> pd.DataFrame:
    """The windows that members of a group have in common with others."""
    spans = mutual(keys, of["windows"], of["back"], length)
    at = np.array([i for i, s in enumerate(spans) for _ in s if of["alone"][i]], int)
    back = np.array([p for i, s in enumerate(spans) for p in s if of["alone"][i]], int).reshape(-1, 2)
    anchor = of["start"][at] + of["back"][at]
    return pd.DataFrame(
        {"k1": of["k1"][at], "k2": of["k2"][at], "first": anchor - back[:, 1], "last": anchor - back[:, 0], "digest": None, "alone": True}
    )


def _windows(keys: np.ndarray, of: dict, ahead: np.ndarray, length: int, cut: bool) -> pd.DataFrame:
    """Count the windows of a large group, as far as common prefixes leave them possible.

    Windows at different distances from the anchor are never equal, so they are
    counted distance by distance. Of a group that goes on in other ranges, windows met
    once, and one of each met more often, are named for the count over all ranges.
    """
    texts = [
        np.concatenate([keys[i, length : length + b][::-1], keys[i, : length - b + n - 1]]).tobytes()
        for i, (b, n) in enumerate(zip(of["back"].tolist(), of["windows"].tolist(), strict=True))
    ]
    least = np.maximum(of["back"] - of["windows"] + 1, length - ahead)
    met_at, met_back, named_at, named_back, digests, counts = [], [], [], [], [], []
    for o in range(max(0, int(least.min())), int(of["back"].max()) + 1):
        members = np.flatnonzero((least <= o) & (o <= of["back"])).tolist()
        starts = (of["back"][members] - o).tolist()
        seen: dict[bytes, list[int]] = {}
        for i, p in zip(members, starts, strict=True):
            seen.setdefault(xxhash.xxh3_128_digest(texts[i][p : p + length]), []).append(i)
        for digest, who in seen.items():
            if len(who) > 1:
                met_at += who
                met_back += [o] * len(who)
            if cut:
                named_at.append(who[0])
                named_back.append(o)
                digests.append(digest)
                counts.append(len(who) == 1)
    found = [_runs_of_windows(of, np.array(met_at, int), np.array(met_back, int))]
    if named_at:
        at = np.array(named_at)
        first = of["start"][at] + of["back"][at] - np.array(named_back)
        alone = of["alone"][at] & np.array(counts)
        found.append(pd.DataFrame({"k1": of["k1"][at], "k2": of["k2"][at], "first": first, "last": first, "digest": digests, "alone": alone}))
    return pd.concat(found)


def _runs_of_windows(of: dict, at: np.ndarray, back: np.ndarray) -> pd.DataFrame:
    """Repeated windows of members that stand for themselves, neighbours joined."""
    own = of["alone"][at]
    at, back = at[own], back[own]
    order = np.lexsort((-back, at))
    at, first = at[order], (of["start"][at] + of["back"][at] - back)[order]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)])) if len(at) else np.zeros(0, int)
    ends = np.append(new[1:], len(at)) - 1 if len(at) else new
    at = at[new]
    return pd.DataFrame(
        {"k1": of["k1"][at], "k2": of["k2"][at], "first": first[new], "last": first[ends], "digest": None, "alone": True}
    )


# --- the operator -------------------------------------------------------------


def keyed(docs: DataFrame) -> DataFrame:
    """Texts with two hashes that stand for the text from here on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")
    )


def _pieces(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts with the stretches of theirs that ``wanted`` names, each packed in a long."""
    # four small numbers in one long: lists of longs become arrays, not objects
    place = F.shiftleft(F.col("start").cast("long"), 32) + F.shiftleft(F.col("windows").cast("long"), 17)
    place = place + F.col("back") * 2 + F.col("alone").cast("long")
    lists = wanted.groupBy(*KEY).agg(F.collect_list(place).alias("pieces"))
    # one text stands for all its copies
    some = texts.join(broadcast_if_small(wanted.select(*KEY).distinct()), KEY, "left_semi").select(*KEY, "text")
    one = some.groupBy(*KEY).agg(F.first("text").alias("text"))
    return one.join(lists, KEY).select(*KEY, "text", "pieces")


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of windows that occur elsewhere, once each: k1, k2, first, last (start bytes in the text)."""
    spark = docs.sparkSession
    found = docs.filter(F.octet_length("text") >= length).select("text", *KEY)
    found = materialise(found.mapInArrow(_stretched(length), STRETCHES))
    met = found.groupBy("anchor").agg(F.min("content").alias("_low"), F.max("content").alias("_high"), F.count(F.lit(1)).alias("_n"))
    # written first, so that the join stands by itself and its hot anchors can be split
    met = materialise(met.filter(F.col("_n") > 1).select("anchor", (F.col("_low") == F.col("_high")).alias("_same")))
    met = materialise(found.join(met, "anchor"))
    span = [*KEY, F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last")]
    same, mixed = met.filter("_same"), met.filter("NOT _same")
    place = F.min(F.struct(*KEY, "start", "windows", "back"))
    classes = mixed.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("_n"), place.alias("_at"))
    classes = materialise(classes)
    several = classes.filter("_n > 1").select("anchor", "content")
    whole = same.select(*span).unionByName(mixed.join(several, ["anchor", "content"]).select(*span))
    wanted = classes.select("_at.*", (F.col("_n") == 1).alias("alone"))

    n = classes.count()
    ranges = max(1, math.ceil(n / RANGE_ROWS))
    splitters = _splitters(docs, wanted, n, ranges, length)
    shared = spark.sparkContext.broadcast(splitters)
    runs = _pieces(docs, wanted).mapInArrow(_sorted_runs(length, shared), BLOBS)
    settled = materialise(runs.groupBy("range").applyInPandas(_merged(length, shared), FOUND))
    named = settled.filter(F.col("digest").isNotNull())
    twice = named.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("digest")
    counted = named.filter("alone").join(twice, "digest")
    matched = settled.filter(F.col("digest").isNull()).unionByName(counted.select(*settled.columns))
    # copies of a text name the same windows: one row each, whatever the number of copies
    return materialise(whole.unionByName(matched.select(*KEY, "first", "last")).distinct())


def _splitters(docs: DataFrame, wanted: DataFrame, n: int, ranges: int, length: int) -> np.ndarray:
    """Keys that cut the sorted order in ranges of about equal size."""
    kind = f"S{key_width(length)}"
    if ranges < 2:
        return np.zeros(0, kind)
    share = min(1.0, SAMPLES_PER_RANGE * ranges / n)
    drawn = F.pmod(F.xxhash64(*KEY, "start"), F.lit(1_000_003)) < int(share * 1_000_003)
    cut = lambda batches: _as_arrow(_cut_pieces(length)(batches), PIECES)
    rows = _pieces(docs, wanted.filter(drawn)).mapInArrow(cut, PIECES).select("text", "back").toPandas()
    keys = np.sort(keys_of(list(zip(rows["text"], rows["back"], strict=True)), length).view(kind).ravel())
    if not len(keys):
        return np.zeros(0, kind)
    # a border moves to the start of the group it falls in, unless the group would
    # fill too many ranges
    cuts, moved = keys[[len(keys) * i // ranges for i in range(1, ranges)]], []
    prefixes = [bytes(c)[:SHORT] for c in cuts]
    for c, p in zip(cuts, prefixes, strict=True):
        moved.append(p if prefixes.count(p) <= WHOLE_GROUP_RANGES else bytes(c))
    return np.unique(np.array(moved, kind))


def _joined_spans(firsts: np.ndarray, lasts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Removed bytes as maximal runs (from, to)."""
    order = np.argsort(firsts, kind="stable")
    starts, ends = firsts[order], np.maximum.accumulate(lasts[order] + length)
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return list(zip(starts[np.concatenate([[0], cut])].tolist(), ends[np.concatenate([cut - 1, [len(ends) - 1]])].tolist(), strict=True))


def _kept(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, packed in zip(_texts(batch), batch.column("spans"), strict=True):
                at, kept = 0, []
                packed = packed.values.to_numpy()
                spans = _joined_spans(packed >> 32, packed & 0xFFFFFFFF, length)
                for s, e in spans:
                    kept.append(data[at:s])
                    at = e
                left = b"".join([*kept, data[at:]])
                digest = hashlib.sha256(left).hexdigest()
                rows.append((len(data), len(data) - len(left), len(spans), digest, left if with_text else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], KEPT)

    return run


KEPT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """Every document with what is left of it: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` holds the remaining bytes, which need not be valid text where a cut falls
    inside a character; it is null unless asked for.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    texts = keyed(docs)
    spans = repeated_windows(texts, length)
    span = F.shiftleft(F.col("first").cast("long"), 32) + F.col("last")
    # written first, so that the join stands by itself and texts with many copies can be split
    listed = materialise(spans.groupBy(*KEY).agg(F.collect_list(span).alias("spans")))
    touched = broadcast_if_small(spans.select(*KEY).distinct())
    cut = texts.join(touched, KEY, "left_semi").join(listed, KEY)
    shape = f"doc_id {ids}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    cut = cut.select("doc_id", "text", "spans").mapInArrow(_kept(length, with_text), shape)
    nothing = F.lit(0).cast("long")
    untouched = texts.join(touched, KEY, "left_anti").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        nothing.alias("n_removed"),
        nothing.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        (F.col("text").cast("binary") if with_text else F.lit(None).cast("binary")).alias("kept"),
    )
    return cut.unionByName(untouched)
