"""Long repeated passages by run-length indexes: every byte that a string of LEAST bytes covers which also starts elsewhere.

Which strings can be equal. Every string of LEAST bytes has an anchor, its smallest-hashed GRAM bytes (the first of equals),
which depends on nothing but the string. Consecutive strings of a document share their anchor; they make a slice of the text.
Equal strings have equal anchor hashes, so only slices of one anchor hash need be compared, wherever their documents lie. Most
anchors of a corpus occur once and go no further; equal slices (128-bit digests of their bytes) are one row with a count.

How they are compared. Slices that share an anchor but differ are gathered, whole anchor groups at a time, into texts of about
INDEX_BYTES, and each gets an index: suffix order by prefix doubling, its Burrows-Wheeler transform as runs, and suffix
positions sampled at both ends of every run. With the match length measured at the samples alone, the matching statistics of
all positions stream off: between samples the neighbour in suffix order moves along with the position, so the length falls by
one a byte. Where the longer match of the two neighbours reaches LEAST, the string is repeated.

An anchor group of more than GROUP_SLICES different slices is not gathered but refined: each slice is cut into ranges of its
starts, first of 256 by place before the anchor, then halves of those, down to one. The strings of a range have more than the
anchor in common, its core, so the group falls apart by core; ranges whose core is alone are done, equal ranges are one row,
groups that are small by now are indexed, the others are refined again. Whatever the size of a group, it never meets in one
task, none is cut, and a slice keeps a row or two a level.

Defined results: null counts as empty; texts shorter than LEAST bytes keep every byte; rows equal in ``doc_id`` and text are
documents of their own and repeat each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import slices, small_batches, text_of
from flowlens.session import stored

LEAST, GRAM = 400, 128
#: Starts handled at a time; slices end with a block.
BLOCK = 1 << 16
INDEX_BYTES, GROUP_SLICES = 1 << 19, 512
#: Suffix pairs compared at a time.
PAIRS = 1 << 14

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(400).integers(0, 1 << 64, 256, "u8")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class GramHash:
    """Hashes of all substrings of GRAM bytes by prefix sums of powers, modulo 2^64.

    Equal grams have equal hashes. Different ones may collide on some periodic texts, so a hash only says which slices may
    hold equal strings; that they do is decided by their bytes.
    """

    def __init__(self, most: int):
        self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(most, b, "u8")]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))

    def of(self, data: np.ndarray) -> np.ndarray:
        sums = np.r_[np.uint64(0), np.cumsum(_BYTES[data] * self.up[: len(data)])]
        return _mix((sums[GRAM:] - sums[:-GRAM]) * self.down[: len(data) - GRAM + 1])


_GRAMS: list[GramHash] = []


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchored_slices(data: bytes, starts: np.ndarray, least: int = LEAST) -> Iterator[tuple]:
    """Slices of a run of bytes: anchor hash, first start, number of starts, place of the anchor in the slice; as arrays.

    ``starts`` tells the positions at which a string may start (those whose string lies in one document).
    """
    if not _GRAMS or len(_GRAMS[0].up) < BLOCK + least:
        _GRAMS[:] = [GramHash(BLOCK + least)]
    low = np.uint64((1 << 17) - 1)
    whole = np.frombuffer(data, "u1")
    with np.errstate(over="ignore"):
        for at in range(0, len(data) - least + 1, BLOCK):
            part = whole[at : at + BLOCK + least - 1]
            n = len(part) - least + 1
            allowed = starts[at : at + n]
            if not allowed.any():
                continue
            gram = _GRAMS[0].of(part)
            g = np.arange(len(gram))
            anchor = (_sliding_min(gram & ~low | g.astype("u8"), least - GRAM + 1) & low).astype("i8")
            edge = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (allowed[1:] != allowed[:-1])])
            size = np.diff(np.r_[edge, n])
            edge, size = edge[allowed[edge]], size[allowed[edge]]
            yield gram[anchor[edge]].view("i8"), edge + at, size, anchor[edge] - edge


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array of slices laid end to end, slice i ending before the separator at ``ends[i]``.

    Separators (zero in ``text``, bytes are 1 to 256) differ from each other and sort by place, before all bytes. Prefix
    doubling; only suffixes that still tie are sorted again.
    """
    n, width = len(text), 7
    padded = np.r_[text, np.zeros(width, text.dtype)].astype("i8")
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # bytes before the separator
    key = np.zeros(n, "i8")
    for i in range(width):
        key = key << 9 | np.where(left > i, padded[i : n + i], 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.r_[True, (key[1:] != key[:-1]) | (left[order][1:] < width) | (left[order][:-1] < width)]
    slot = np.arange(n)
    rank = np.empty(n, "i8")
    rank[order] = np.maximum.accumulate(np.where(head, slot, 0))
    h = width
    while True:
        tied = slot[~head | ~np.r_[head[1:], True]]
        if not len(tied):
            return order
        at = order[tied]
        key = rank[at] * n + rank[at + h]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        new = np.r_[True, key[1:] != key[:-1]]
        head[tied] = new
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        h *= 2


def _common(text: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to the end of either slice; some pairs at a time."""
    step = np.arange(32)
    padded = np.r_[text, np.zeros(len(step), text.dtype)]
    length = np.zeros(len(a), "i8")
    most = np.minimum(left[a], left[b])
    for first in range(0, len(a), PAIRS):
        going = first + np.flatnonzero(most[first : first + PAIRS] > 0)
        while len(going):
            i, j = a[going] + length[going], b[going] + length[going]
            differ = padded[i[:, None] + step] != padded[j[:, None] + step]
            same = np.where(differ.any(1), differ.argmax(1), len(step))
            length[going] = np.minimum(length[going] + same, most[going])
            going = going[(same == len(step)) & (length[going] < most[going])]
    return length


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of slices, with sampled run ends."""

    def __init__(self, parts: list[bytes]):
        self.ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        self.text = np.frombuffer(b"\0".join(parts) + b"\0", "u1").astype("i2") + 1
        self.text[self.ends] = 0
        order = suffix_order(self.text, self.ends)
        before = self.text[order - 1].astype("i8")
        before[before == 0] = -1 - order[before == 0]  # separators differ
        edge = np.flatnonzero(before[1:] != before[:-1])
        #: Letter and length of every run.
        self.letters, self.lengths = before[np.r_[0, edge + 1]], np.diff(np.r_[0, edge + 1, len(order)])
        #: Suffixes at the first place of every run but the first, and at the last place of the run before.
        self.run_starts, self.run_ends = order[edge + 1], order[edge]

    def matching_statistics(self) -> np.ndarray:
        """For every position, the length of the longest string that starts there and also starts elsewhere.

        Longest common prefix with either neighbour in suffix order: measured at the run ends, streamed in between.
        """
        n = len(self.text)
        left = self.ends[np.searchsorted(self.ends, np.arange(n))] - np.arange(n)
        measured = _common(self.text, left, self.run_starts, self.run_ends)
        best = np.zeros(n, "i8")
        for samples in (self.run_starts, self.run_ends):
            by = np.argsort(samples)
            at, length = samples[by], measured[by]
            last = np.searchsorted(at, np.arange(n), "right") - 1
            here = np.where(last >= 0, length[last] - (np.arange(n) - at[last]), 0)
            best = np.maximum(best, here)
        return best


def repeated_starts(parts: list[bytes], least: int = LEAST) -> list[list[int]]:
    """For every slice, the offsets at which a string of ``least`` bytes starts that also starts elsewhere in the slices,
    as a flat list of runs: first, last, first, last, ..."""
    index = RunLengthIndex(parts)
    hit = index.matching_statistics() >= least
    begin, out = 0, []
    for end in index.ends:
        out.append(_runs(hit[begin:end]))
        begin = end + 1
    return out


def _runs(hit: np.ndarray) -> list[int]:
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype("i1")))
    return (edge.reshape(-1, 2) - [0, 1]).ravel().tolist()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("text")).withColumn("tkey", F.xxhash64("text"))


def _same_text(rows: DataFrame, other: DataFrame):
    return (rows["tkey"] == other["__key"]) & rows["doc_id"].eqNullSafe(other["__id"])


def _slices_of(rows: DataFrame, least: int) -> DataFrame:
    names = ["h", "d", "doc_id", "tkey", "start", "n", "place"]

    def run(batches):
        for part, texts in slices(batches):
            raw = [t.encode() for t in texts]
            data = b"".join(raw)
            ends = np.cumsum([len(r) for r in raw])
            begins = ends - [len(r) for r in raw]
            starts = np.zeros(len(data) + 1, "i4")
            for b, e in zip(begins, ends):
                if e - b >= least:
                    starts[b] += 1
                    starts[e - least + 1] -= 1
            ids, keys = part.column(0), part.column(2)
            for h, at, size, place in anchored_slices(data, np.cumsum(starts[:-1]) > 0, least):
                # strings of two documents are never in one slice: between them lie starts that are not allowed
                doc = np.searchsorted(ends, at, "right")
                d = [digest(data[b:e]) for b, e in zip(at.tolist(), (at + size + least - 1).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(d, pa.binary()), ids.take(pa.array(doc)), keys.take(pa.array(doc)),
                     pa.array((at - begins[doc]).astype("i8")), pa.array(size.astype("i2")), pa.array(place.astype("i2"))], names)

    return rows.mapInArrow(run, "h long, d binary, doc_id long, tkey long, start long, n short, place short")


def _contents(texts: DataFrame, least: int) -> DataFrame:
    """The bytes of the wanted slices of every text."""

    def run(batches):
        for part, each in slices(batches):
            out: list[tuple] = []
            for text, wanted in zip(each, part.column(1).to_pylist()):
                raw = text.encode()
                out += [(w["h"], w["d"], w["copies"], w["hot"], w["place"], raw[w["start"] : w["start"] + w["n"] + least - 1]) for w in wanted]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
            for k in range(0, len(out), 2000):
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out[k : k + 2000]), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "d", "copies", "hot", "place", "data"])

    return texts.select("text", "wanted").mapInArrow(run, "h long, d binary, copies long, hot boolean, place int, data binary")


def _indexed(slices_: DataFrame, least: int) -> DataFrame:
    """(h, d, runs) of slices (g, h, d, at, data) that differ inside their group g; ``at`` is added to the runs."""

    def run(batches):
        rows: list[tuple] = []
        size = 0

        def judged():
            found = repeated_starts([r[4] for r in rows], least)
            hit = [(r[1], r[2], [r[3] + i for i in runs]) for r, runs in zip(rows, found) if runs]
            if hit:
                h, d, runs = zip(*hit)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(d, pa.binary()), pa.array(runs, pa.list_(pa.int32()))],
                                                 ["h", "d", "runs"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size >= INDEX_BYTES and row[0] != rows[-1][0]:
                    yield from judged()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield from judged()

    ordered = slices_.select("g", "h", "d", "at", "data").repartition("g").sortWithinPartitions("g")
    return ordered.mapInArrow(run, "h long, d binary, runs array<int>")


def ranges_of(data: bytes, place: int, width: int, least: int = LEAST) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Cuts the starts of a slice into ranges by their distance before the anchor: (first start, starts, core, bytes)."""
    n, first = len(data) - least + 1, 0
    while first < n:
        nearest = (place - first) // width * width
        last = min(n - 1, place - nearest)
        farthest = min(nearest + width - 1, least - GRAM)
        yield first, last - first + 1, data[max(0, place - nearest) : place - farthest + least], data[first : last + least]
        first = last + 1


def _refined(slices_: DataFrame, width: int, least: int) -> DataFrame:
    """The ranges of slices (h, d, at, place, copies, data) with 128-bit hashes of their core (c) and of their bytes (s)."""
    names = ["h", "d", "at", "place", "copies", "n", "c", "s", "data"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches):
        for batch in batches:
            out = []
            for h, d, at, place, copies, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                for first, n, core, part in ranges_of(data, place, width, least):
                    out.append((h, d, at + first, place - first, copies, n, digest(b"%d " % ((place - first) // width) + core), digest(part), part))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    ordered = slices_.select("h", "d", "at", "place", "copies", "data")
    return ordered.mapInArrow(run, "h long, d binary, at int, place int, copies long, n int, c binary, s binary, data binary")


def _marks(contents: DataFrame, least: int) -> DataFrame:
    """(h, d, runs): starts in different slices of an anchor group whose strings are equal; several rows for a slice."""
    start = F.lit(0).alias("at")
    parts = [_indexed(contents.where("NOT hot").select(F.col("h").alias("g"), "h", "d", start, "data"), least)]
    large, width = contents.where("hot").select("h", "d", start, "place", "copies", "data"), 256
    while width and not large.isEmpty():
        ranges = stored(_refined(large, width, least), "ranges")
        equal = stored(ranges.groupBy("c", "s").agg(F.sum("copies").alias("copies"), F.min(F.struct("h", "d", "at")).alias("x")), "equal-ranges")
        more = ranges.join(equal.where("copies > 1").select("c", "s"), ["c", "s"], "left_semi")
        parts.append(more.select("h", "d", F.array("at", F.col("at") + F.col("n") - 1).alias("runs")))
        cores = stored(equal.groupBy("c").agg(F.count(F.lit(1)).alias("differ")).where("differ > 1"), "cores")
        left = equal.join(cores, "c").select("c", "differ", "copies", "x.*")
        left = stored(left.join(ranges.drop("copies", "c", "s", "n"), ["h", "d", "at"]), "open-ranges")
        small = left.where(F.col("differ") <= GROUP_SLICES)
        parts.append(_indexed(small.select(F.xxhash64("c").alias("g"), "h", "d", "at", "data"), least))
        large, width = left.where(F.col("differ") > GROUP_SLICES).select("h", "d", "at", "place", "copies", "data"), width // 2
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _runs_by_slice(marks: DataFrame) -> DataFrame:
    """One row per slice with all its runs of repeated starts. A slice has fewer starts than its least string has bytes, and a
    run or two for each of them and level at most; they may overlap."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)), lambda i: F.struct(
        F.get("runs", i).alias("a"), F.get("runs", i + 1).alias("b")))
    return marks.groupBy("h", "d").agg(F.array_distinct(F.flatten(F.collect_list(pairs))).alias("runs"))


def _spans(docs: DataFrame, least: int) -> DataFrame:
    """(__id, __key, spans) of the texts with repeated strings: runs of their starts, unsorted and overlapping."""
    small_batches(docs.sparkSession)
    rows = _keyed(docs)
    every = stored(_slices_of(rows, least), "slices")
    # stored, so that both sides of the joins are plain shuffles, which Spark splits where an anchor is hot
    often = stored(every.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "shared-anchors")
    shared = stored(every.join(often, "h"), "shared-slices")
    distinct = shared.groupBy("h", "d").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "tkey", "start", "n", "place")).alias("x"))
    distinct = stored(distinct, "distinct-slices")
    groups = stored(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("differ")).where("differ > 1"), "anchor-groups")
    wanted = distinct.join(groups, "h").select(
        F.col("x.doc_id").alias("__id"), F.col("x.tkey").alias("__key"),
        F.struct("h", "d", "copies", (F.col("differ") > GROUP_SLICES).alias("hot"), "x.place", "x.start", "x.n").alias("w"))
    by_text = wanted.groupBy("__id", "__key").agg(F.collect_list("w").alias("wanted"))  # bounded by the text's own slices
    contents = stored(_contents(rows.join(by_text, _same_text(rows, by_text)), least), "slice-texts")
    # a slice with copies is repeated from end to end, so what the index found of it adds nothing
    copied = distinct.where("copies > 1").select("h", "d", F.array(F.struct(F.lit(0).alias("a"), (F.col("x.n") - 1).cast("int").alias("b"))).alias("runs"))
    partly = _runs_by_slice(_marks(contents, least)).join(copied.select("h", "d"), ["h", "d"], "left_anti")
    repeated = stored(copied.unionByName(partly), "repeated-slices")
    found = shared.join(repeated, ["h", "d"]).select("doc_id", "tkey", F.transform("runs", lambda r: F.struct(
        (F.col("start") + r["a"]).alias("start"), (F.col("start") + r["b"]).alias("last"))).alias("runs"))
    return found.groupBy(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).agg(
        F.array_distinct(F.flatten(F.collect_list("runs"))).alias("spans"))


def covered_spans(spans: list[dict] | None, least: int = LEAST) -> list[tuple[int, int]]:
    """Maximal byte ranges [begin, end) covered by the strings that start at the given runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["last"] + least) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in spans)]
    return b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(raw)]))


def remove_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches):
        for part, texts in slices(batches):
            columns: list[list] = [[] for _ in names[1:]]
            for text, found in zip(texts, part.column(2).to_pylist()):
                raw, spans = text.encode(), covered_spans(found, least)
                kept = kept_bytes(raw, spans)
                for column, value in zip(columns, (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    rows, spans = _keyed(docs), _spans(docs, least)
    return rows.join(spans, _same_text(rows, spans), "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def strip_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with what stays of every text, all columns kept; ``n_chars``, if there is one, is counted again.

    The bytes of a character that a span cut in two are left out.
    """

    def run(batches):
        for batch in batches:
            texts = [kept_bytes(t.encode(), covered_spans(s, least)).decode(errors="ignore") if s else t
                     for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["__row", "__kept"])

    rows, spans = docs.withColumns({"__row": F.struct(*docs.columns), "tkey": F.xxhash64(text_of())}), _spans(docs, least)
    row = rows.schema["__row"].dataType.simpleString()
    stripped = rows.join(spans, _same_text(rows, spans), "left").select("__row", text_of().alias("text"), "spans").mapInArrow(
        run, f"__row {row}, __kept string")
    kept = F.when(F.col("__row.text").isNotNull(), F.col("__kept"))
    new = {"text": kept, "n_chars": F.length(kept).cast("long")}
    return stripped.select(*((new[c] if c in new else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns))
