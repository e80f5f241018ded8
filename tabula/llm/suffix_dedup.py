"""Removal of repeated byte strings by induced suffix sorting.

A byte goes if it lies in a string of LENGTH bytes that also starts anywhere else, in the same text or another.

Which suffixes are sorted. As induced sorting sorts a sparse set of suffixes and derives the others from it, the
suffixes sorted here start at anchors: in each window of LENGTH bytes the start of the GRAM-byte string with the least
hash. The choice depends on the window's bytes only, so equal windows have equal anchors at equal offsets, and
a window occurs twice only if its anchor's gram does. Ties (periodic text) go to the first of them where the
window begins before the tied stretch, else to the last; windows that occur twice among the tied ones of one text are
settled there, and only the first of each keeps its anchor.

Sorting and induction. Anchors whose gram occurs once drop out; of those with equal surroundings (everything a
window around the anchor can reach) one stays. The others form suffix tuples (gram, bytes to the right, bytes to
the left) that Spark sorts by gram and right side; its sorter spills sorted runs to disk and merges them with a
priority queue, so a shard may exceed memory. From the order and the common-prefix lengths at the anchors the
order and common-prefix lengths one byte further left follow by a stable sort on that byte: neighbours with the
same byte share one more than the least common prefix between them. This is repeated up to LENGTH - GRAM times; a
window is repeated where a neighbour shares LENGTH bytes. Gram groups above HOT_GROUP tuples, which one task should
not hold, are settled by counting hashes of their windows instead.

Cases: null text is empty; texts below LENGTH bytes lose nothing; equal texts of LENGTH bytes or more lose all;
very long texts are cut into overlapping segments; an empty table gives no rows; rows that repeat a doc_id are
rows of their own; rows with a null doc_id count as any other and have a result row with a null doc_id. Inside, such
a row goes by a hash of its text, so that no key holds all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep
from .shingles import POWERS, mix64

LENGTH, GRAM = 400, 64
WINDOW = LENGTH - GRAM + 1
LEFT = LENGTH - GRAM
SEGMENT = 1 << 21
HOT_GROUP = 100_000
#: Rows of small lists (positions or spans) that are broadcast; longer lists are joined by shuffle.
BROADCAST_ROWS = 1_000_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
LOW = np.uint64((1 << 24) - 1)


def _sums(b: np.ndarray) -> np.ndarray:
    up, _ = POWERS.get(len(b) + 1)
    out = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    _, down = POWERS.get(len(sums))
    return mix64((sums[hi] - sums[lo]) * down[lo])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each run of w values: of the rest of its block and of the head of the next."""
    blocks = -(-len(x) // w)
    pad = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    pad[: len(x)] = x
    grid = pad.reshape(blocks, w)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    rest = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - w + 1
    return np.minimum(rest[:n], head[w - 1 : w - 1 + n])


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Union of [s, s + length) for ascending starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    first = np.r_[starts[0], starts[cut + 1]]
    last = np.r_[starts[cut], starts[-1]]
    return list(zip(first.tolist(), (last + length).tolist()))


def anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Positions and gram hashes of the anchors of one segment, and spans settled within it."""
    n = len(b)
    if n < LENGTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), []
    sums = _sums(b)
    at = np.arange(n - GRAM + 1)
    gram = _hashes(sums, at, at + GRAM)
    high, pos = gram & ~LOW, at.astype(np.uint64)
    first = (_window_min(high | pos, WINDOW) & LOW).astype(np.int64)
    last = (LOW - (_window_min(high | (LOW - pos), WINDOW) & LOW)).astype(np.int64)
    tied = np.flatnonzero(first != last)
    spans: list[tuple[int, int]] = []
    pick = first
    if len(tied):
        among = np.flatnonzero(np.isin(high, np.unique(high[first[tied]])))
        order = among[np.argsort(high[among], kind="stable")]
        after = np.full(len(gram), n, dtype=np.int64)
        same = high[order[1:]] == high[order[:-1]]
        after[order[:-1][same]] = order[1:][same]
        f = first[tied]
        choice = np.where(f - tied >= after[f] - f, f, last[tied])
        pick = first.copy()
        pick[tied] = choice
        whole = _hashes(sums, tied, tied + LENGTH)
        _, lead, back, times = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
        spans = _runs(tied[times[back] > 1], LENGTH)
        use = np.ones(len(first), dtype=bool)
        use[tied] = False
        use[tied[lead]] = True
        pick = pick[use]
    chosen = np.unique(pick)
    return chosen, gram[chosen], spans


def _profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """kind 0: text (n_bytes, 1 if the id is null, sha256); kind 1: anchor (position, gram, surroundings); kind 2: span (start, end)."""
    seen: set[bytes] = set()
    for pdf in batches:
        ids, tids, kinds, a, b_, c, shas = [], [], [], [], [], [], []

        def put(doc_id, tid, kind, x, y, z, sha=None):
            k = len(x)
            ids.append(np.repeat(doc_id, k))
            tids.extend([tid] * k)
            kinds.append(np.repeat(kind, k))
            a.append(x)
            b_.append(y)
            c.append(z)
            shas.extend([sha] * k)

        zero = np.zeros(1, dtype=np.int64)
        for doc_id, no_id, text in zip(pdf["doc_id"], pdf["no_id"], pdf["text"]):
            raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
            digest = hashlib.sha256(raw)
            tid = digest.digest()[:16]
            put(doc_id, tid, 0, np.array([len(raw)]), zero + int(no_id), zero, digest.hexdigest())
            if len(raw) < LENGTH or tid in seen:
                continue
            if len(seen) < 1 << 20:  # only spares rows: copies in other tasks meet in the shuffle
                seen.add(tid)
            whole = np.frombuffer(raw, dtype=np.uint8)
            sums = _sums(whole)
            for start in range(0, len(raw) - LENGTH + 1, SEGMENT):
                pos, gram, spans = anchors(whole[start : start + SEGMENT + LENGTH - 1])
                pos = pos + start
                lo, hi = np.maximum(pos - LEFT, 0), np.minimum(pos + LENGTH, len(raw))
                around = _hashes(sums, lo, hi) ^ mix64(((pos - lo) * 1024 + (hi - pos)).astype(np.uint64))
                put(doc_id, tid, 1, pos, gram.astype(np.int64), around.astype(np.int64))
                if spans:
                    s = np.array(spans) + start
                    put(doc_id, tid, 2, s[:, 0], s[:, 1], np.zeros(len(s), dtype=np.int64))
        if ids:
            yield pd.DataFrame(
                {
                    "doc_id": np.concatenate(ids),
                    "tid": tids,
                    "kind": np.concatenate(kinds).astype(np.int32),
                    "a": np.concatenate(a),
                    "b": np.concatenate(b_),
                    "c": np.concatenate(c),
                    "sha": shas,
                }
            )


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffix tuples at the wanted positions of texts."""
    for pdf in batches:
        out = []
        for doc_id, text, tid, at in zip(pdf["doc_id"], pdf["text"], pdf["tid"], pdf["at"]):
            raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
            if hashlib.sha256(raw).digest()[:16] != tid:
                continue
            for x in at:
                p = x["a"]
                out.append((doc_id, tid, p, x["b"], raw[max(0, p - LEFT) : p], raw[p : p + LENGTH]))
        if out:
            yield pd.DataFrame(out, columns=["doc_id", "tid", "pos", "gram", "left", "right"])


def _common(right: list[bytes], gram: np.ndarray) -> np.ndarray:
    """Common-prefix length of each right side and the one before it (0 across grams)."""
    m = len(right)
    size = np.array([len(r) for r in right])
    grid = np.frombuffer(b"".join(r.ljust(LENGTH, b"\0") for r in right), dtype=np.uint8).reshape(m, LENGTH)
    out = np.zeros(m, dtype=np.int32)
    for lo in range(1, m, 8192):
        hi = min(m, lo + 8192)
        unlike = grid[lo:hi] != grid[lo - 1 : hi - 1]
        same = np.where(unlike.any(axis=1), unlike.argmax(axis=1), LENGTH)
        out[lo:hi] = np.minimum(same, np.minimum(size[lo:hi], size[lo - 1 : hi - 1]))
    out[1:][gram[1:] != gram[:-1]] = 0
    return out


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo:hi] for each pair (hi > lo), by doubling runs."""
    out = np.empty(len(lo), dtype=values.dtype)
    span = hi - lo
    level, table = 0, values
    todo = np.arange(len(lo))
    while len(todo):
        here = span[todo] < (2 << level)
        at = todo[here]
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << level)])
        todo = todo[~here]
        step = 1 << level
        if len(todo):
            table = np.minimum(table[:-step], table[step:])
            level += 1
    return out


def induce(gram: np.ndarray, left: list[bytes], right: list[bytes]) -> np.ndarray:
    """For tuples sorted by (gram, right): whether the window that starts l bytes before the anchor is repeated,
    for l = 0 .. LEFT."""
    m = len(gram)
    group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]])
    size = np.array([len(x) for x in left])
    before = np.frombuffer(b"".join(x[::-1].ljust(LEFT, b"\0") for x in left), dtype=np.uint8).reshape(m, LEFT)
    order, lcp = np.arange(m), _common(right, gram)
    repeated = np.zeros((m, LEFT + 1), dtype=bool)
    for back in range(LEFT + 1):
        best = np.maximum(lcp, np.r_[lcp[1:], 0])
        repeated[order[best >= LENGTH], back] = True
        if back == LEFT:
            break
        # on: tuples that have one more byte to the left and can still reach a common prefix of LENGTH
        on = np.flatnonzero((size[order] > back) & (best + (LEFT - back) >= LENGTH))
        if len(on) < 2:
            break
        key = group[order[on]] * 256 + before[order[on], back]
        turn = np.argsort(key, kind="stable")
        new, old, key = order[on][turn], on[turn], key[turn]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        fresh = np.zeros(len(new), dtype=np.int32)
        if len(same):
            fresh[same] = np.minimum(_least(lcp, old[same - 1] + 1, old[same] + 1) + 1, LENGTH)
        order, lcp = new, fresh
    return repeated


def _spans_of(repeated: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the union of the repeated windows around each anchor."""
    edge = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, lo = np.nonzero(edge == 1)
    _, hi = np.nonzero(edge == -1)
    return row, pos[row] - (hi - 1), pos[row] - lo + LENGTH


def _sorted_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans from tuples that arrive sorted by (gram, right); whole groups are induced together."""

    def done(pdf: pd.DataFrame) -> pd.DataFrame:
        gram, pos = pdf["gram"].to_numpy(), pdf["pos"].to_numpy()
        row, lo, hi = _spans_of(induce(gram, pdf["left"].tolist(), pdf["right"].tolist()), pos)
        return pd.DataFrame(
            {"doc_id": pdf["doc_id"].to_numpy()[row], "tid": pdf["tid"].to_numpy()[row], "start": lo, "end": hi}
        )

    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        gram = pdf["gram"].to_numpy()
        edge = np.flatnonzero(gram[1:] != gram[:-1])
        if len(pdf) < 4096 or not len(edge):
            rest = pdf
            continue
        cut = int(edge[-1]) + 1
        yield done(pdf.iloc[:cut])
        rest = pdf.iloc[cut:]
    if rest is not None and len(rest):
        yield done(rest)


def _window_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every window around the anchors of hot groups, by two hashes."""
    for pdf in batches:
        for doc_id, tid, pos, gram, left, right in pdf[["doc_id", "tid", "pos", "gram", "left", "right"]].itertuples(index=False):
            b = np.frombuffer(left + right, dtype=np.uint8)
            lo = np.arange(max(len(b) - LENGTH + 1, 0))
            lo = lo[lo <= len(left)]
            if len(lo):
                h = _hashes(_sums(b), lo, lo + LENGTH)
                yield pd.DataFrame(
                    {"doc_id": doc_id, "tid": tid, "start": pos - len(left) + lo, "gram": gram, "off": len(left) - lo, "h": h.astype(np.int64)}
                )


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for doc_id, text, tid, spans in zip(pdf["doc_id"], pdf["text"], pdf["tid"], pdf["spans"]):
            raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
            if hashlib.sha256(raw).digest()[:16] != tid:
                continue
            kept, at, n = [], 0, 0
            for s, e in sorted((x["start"], x["end"]) for x in spans):
                if s > at or n == 0:
                    kept.append(raw[at:s])
                    n += 1
                at = max(at, e)
            kept.append(raw[at:])
            rest = b"".join(kept)
            out.append((doc_id, tid, len(raw) - len(rest), n, hashlib.sha256(rest).hexdigest(), rest))
        if out:
            yield pd.DataFrame(out, columns=["doc_id", "tid", "n_removed", "n_spans", "kept_sha256", "kept"])


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, no_id, text) of every row; for a null doc_id (no_id) a hash of the text stands in.

    What is found is kept by doc_id and tid, so a stand-in may equal a real id.
    """
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.xxhash64("text")).alias("doc_id"), doc_id.isNull().alias("no_id"), "text")


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts (doc_id, no_id, tid, n_bytes, sha, copies) and, for texts without a copy, spans (doc_id, tid, start,
    end); doc_id as in ``_rows``."""
    src = _rows(docs)
    schema = "doc_id long, tid binary, kind int, a long, b long, c long, sha string"
    profile = keep(src.mapInPandas(_profile, schema), "suffix-profile")
    texts = profile.where("kind = 0").select(
        "doc_id", (F.col("b") == 1).alias("no_id"), "tid", F.col("a").alias("n_bytes"), "sha"
    )
    copies = keep(texts.groupBy("tid").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "suffix-copies")
    texts = texts.join(copies, "tid", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    # a copied text is gone as a whole; one of it stays among the anchors, for the windows that others share with it
    marks = profile.where("kind = 1").groupBy("b", "tid", "a").agg(F.min("doc_id").alias("doc_id"), F.first("c").alias("c"))
    often = profile.where("kind = 1").select("b", "tid", "a").distinct().groupBy("b").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    marks = keep(marks.join(often.select("b"), "b"), "suffix-anchors")
    alike = marks.groupBy("b", "c").agg(F.count(F.lit(1)).alias("same"), F.min(F.struct("tid", "a")).alias("lead"))
    known = alike.where("same > 1").select("b", "c")
    size = texts.where("copies = 1").select("tid", "doc_id", "n_bytes")
    whole = marks.join(known, ["b", "c"]).join(size, ["tid", "doc_id"]).select(
        "doc_id",
        "tid",
        F.greatest(F.col("a") - LEFT, F.lit(0)).alias("start"),
        F.least(F.col("a") + LENGTH, F.col("n_bytes")).alias("end"),
    ).where(F.col("end") - F.col("start") >= LENGTH)
    lead = alike.select("b", F.col("lead.tid").alias("tid"), F.col("lead.a").alias("a"))
    # a gram with one kind of surroundings only is settled
    several = alike.groupBy("b").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    lead = keep(lead.join(several, "b").join(marks.select("b", "tid", "a", "doc_id"), ["b", "tid", "a"]), "suffix-wanted")
    wanted = lead.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("a", "b")).alias("at"))
    few = lead.count() <= BROADCAST_ROWS
    long = src.where(F.octet_length("text") >= LENGTH).select("doc_id", "text")
    found = long.join(F.broadcast(wanted) if few else wanted, "doc_id")
    # equal texts under one id (or without ids) are cut out once
    again = texts.where("copies > 1").join(wanted.select("doc_id", "tid"), ["doc_id", "tid"])
    again = keep(again.groupBy("doc_id", "tid").count().where("count > 1").drop("count"), "suffix-again")
    if not again.isEmpty():
        digest = F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32))
        found = found.where(digest == F.col("tid"))
        once = found.join(again, ["doc_id", "tid"], "left_semi").dropDuplicates(["doc_id", "tid"])
        found = found.join(again, ["doc_id", "tid"], "left_anti").unionByName(once)
    tuples = found.mapInPandas(
        _cut_out, "doc_id long, tid binary, pos long, gram long, left binary, right binary"
    )
    hot = keep(several.where(F.col("m") > HOT_GROUP).select(F.col("b").alias("gram")), "suffix-hot")
    n_hot = hot.count()
    near = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    calm = tuples.join(near, "gram", "left_anti") if n_hot else tuples
    parts = calm.repartition("gram").sortWithinPartitions("gram", "right")
    spans = parts.mapInPandas(_sorted_groups, "doc_id long, tid binary, start long, end long")
    if n_hot:
        windows = tuples.join(near, "gram").mapInPandas(
            _window_hashes, "doc_id long, tid binary, start long, gram long, off int, h long"
        )
        twice = windows.groupBy("gram", "off", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
        spans = spans.unionByName(
            windows.join(twice, ["gram", "off", "h"]).select("doc_id", "tid", "start", (F.col("start") + LENGTH).alias("end"))
        )
    local = profile.where("kind = 2").select("doc_id", "tid", F.col("a").alias("start"), F.col("b").alias("end"))
    spans = spans.unionByName(whole).unionByName(local).join(copies.select("tid"), "tid", "left_anti")
    return texts, spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes left; null: the text as it is) of every row."""
    texts, spans = repeated_spans(docs)
    lists = keep(spans.groupBy("doc_id", "tid").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "suffix-spans")
    few = lists.count() <= BROADCAST_ROWS // 4
    src = _rows(docs).where(F.octet_length("text") >= LENGTH).select("doc_id", "text")
    cut = src.join(F.broadcast(lists) if few else lists, "doc_id").mapInPandas(
        _remove, "doc_id long, tid binary, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return texts.join(cut, ["doc_id", "tid"], "left").select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
