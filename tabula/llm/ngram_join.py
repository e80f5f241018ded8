"""N-gram Jaccard join with parity sketches.

A document is the set of its five-word shingles. Hashing each shingle to a position and XOR-ing one bit there
gives a parity sketch; the Hamming distance of two sketches is at most the size of the symmetric difference of
the sets. Jaccard >= 3/4 of sets of a and b shingles means a symmetric difference of at most (a + b) / 7.

Candidates (pigeonhole). In a size band all sets are cut by hash into the same m chunks; a chunk is known by
the XOR of its shingles' hashes, that is by its stretch of an arbitrarily wide parity sketch. Two sets that
differ in D shingles agree in at least m - D chunks, so in any order of chunks fixed for all documents the
first D + 1 chunks of both have one in common. The order puts chunks of rare shingles first (counters of a
fixed size, summed over all documents, tell common from rare), then chunks of more shingles; so a passage
shared by many documents rarely serves as a key. A document takes part in its own band and, if a partner could
be that large, in the next one.

Decisions. Rows of a key are ordered, not gathered: each document is paired with the first and the previous one
of its key. A key of a chunk whose rarest shingle is common is cut into parts by the documents' hashes, each ordered by
itself, and the parts' first documents are ordered once more, so no task holds a whole common key. Equal sets are one
document before that. For each document the pair that shares most keys is verified first, then the other neighbours;
pairs within one component need no verification. What remains, pairs across components that share a key, is compared
by sketch in blocks of a key's documents: each document of a block that has a partner of another component within the
bound proposes the closest one; of these documents, those that still have such a partner with the components that these
links leave meet with their shingle sets, and a block's exact links leave the task as a forest of its components. Near
copies share most of their keys, so of keys and blocks with the same documents one is compared. So no
link between components is lost, and what a task emits is at most a row for each row it reads. A pair
is verified by its size bound, then the Hamming distance of band-sized sketches (folded to the smaller), then the exact
intersection of the shingle sets.

Cases: null, empty and blank texts have no shingles and no links; rows that repeat a doc_id are one document with one
component, linked where any of its texts is (blank rows of a linked document included); a null doc_id has no component and
links no others; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, keep, whole_groups
from .shingles import BASE, WORDS, mix64, shingle_sets

#: Counters of shingle hashes (a fixed table), kept in slices.
COUNTERS, SLICES = 1 << 18, 16
#: Sets of a key that one task compares with as many others.
BLOCK_ROWS = 1024
#: What names a pair of blocks of a key.
BLOCK = ["sig", "bx", "by"]
#: Shingles of the sets that one task compares exactly with as many others.
BLOCK_SHINGLES = 1 << 19
#: Columns of a block's incidence matrix that are multiplied at once.
MATRIX_COLUMNS = 4096
#: Up to this many documents of candidate pairs are marked by a broadcast list, more by a shuffle join.
BROADCAST_IDS = 1_000_000
#: Stands for a null doc_id where pandas would turn longs to doubles.
NO_ID = -(2**63) + 1
SEED = np.uint64(0x5851F42D4C957F2D)


def _partners(a: int) -> int:
    """Largest size of a partner of a set of size a."""
    return 4 * a // 3


def _band(n: int) -> int:
    return n.bit_length() - 1


def _chunks(band: int) -> int:
    """Chunks of a band of sizes 2**band to 2**(band+1) - 1: half as many again as its largest difference."""
    return -(-(3 << (band + 2)) // 14) + 24


def _sketch(u: np.ndarray) -> bytes:
    """Parity sketch of two to four bits a shingle; halves fold onto each other by XOR."""
    bits = max(64, 1 << (_band(len(u)) + 2))
    odd = np.bincount((u >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _set_name(u: np.ndarray) -> int:
    """A 64-bit hash of the set."""
    if not len(u):
        return 0
    parts = np.array([np.bitwise_xor.reduce(u), u.sum(dtype=np.uint64), len(u)], dtype=np.uint64)
    parts = mix64(parts) * np.array([3, 5, 7], dtype=np.uint64)
    return int(mix64(parts.sum(keepdims=True, dtype=np.uint64)).astype(np.int64)[0])


def _slot(u: np.ndarray) -> np.ndarray:
    return (u & np.uint64(COUNTERS - 1)).astype(np.int64)


def _profile(words: int):
    """doc_id, n, sid (name of the set) and sketch of every text; then this task's shingle counters, in slices."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, any_row = np.zeros(COUNTERS, dtype=np.int64), False
        for pdf in batches:
            n, sid, sk, pending, held = [], [], [], [], 0
            for u in shingle_sets(pdf["text"], words):
                n.append(len(u))
                sid.append(_set_name(u))
                sk.append(_sketch(u) if len(u) else None)
                pending.append(_slot(u))
                held += len(u)
                if held > 1 << 20:
                    counts += np.bincount(np.concatenate(pending), minlength=COUNTERS)
                    pending, held = [], 0
            if pending:
                counts += np.bincount(np.concatenate(pending), minlength=COUNTERS)
            any_row = any_row or len(pdf) > 0
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": n, "sid": sid, "sketch": sk, "slice": None, "counts": None})
        if any_row:
            parts = [zlib.compress(p.tobytes(), 1) for p in counts.reshape(SLICES, -1)]
            yield pd.DataFrame({"doc_id": 0, "n": 0, "sid": 0, "sketch": None, "slice": range(SLICES), "counts": parts})

    return run


def _add_counts(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(COUNTERS // SLICES, dtype=np.int64)
    for pdf in batches:
        for c in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(c), dtype=np.int64)
    yield pd.DataFrame({"slice": [key[0]], "counts": [total.tobytes()]})


def _summed(profile: DataFrame) -> np.ndarray:
    """Shingle counters over all documents: COUNTERS numbers, whatever the input."""
    parts = profile.where("slice is not null").select("slice", "counts")
    rows = parts.groupBy("slice").applyInPandas(_add_counts, "slice int, counts binary").collect()
    out = np.zeros(COUNTERS, dtype=np.int64)
    for r in rows:
        out.reshape(SLICES, -1)[r["slice"]] = np.frombuffer(r["counts"], dtype=np.int64)
    return out


def _leading(
    u: np.ndarray, hashed: np.ndarray, hot: np.ndarray, counts: np.ndarray, sets: int, band: int
) -> tuple[np.ndarray, np.ndarray]:
    """Names of the first D + 1 chunks of a set in a band, and the most sets that can share each: the least counter of
    the chunk's shingles, or all ``sets`` for an empty one. ``u`` is sorted, so chunk numbers ascend."""
    a, m = len(u), _chunks(band)
    need = (a + min(_partners(a), (2 << band) - 1)) // 7 + 1
    chunk = ((u >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    at = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
    weight = np.minimum(np.diff(np.r_[at, a]), 7).astype(np.uint64)
    inside = np.bitwise_xor.reduceat(hashed, at)
    rank = np.minimum.reduceat(hot, at) << np.uint64(58)
    rank |= ((np.uint64(7) - weight) << np.uint64(55)) | (inside >> np.uint64(9))
    place = chunk + np.uint64(band << 40)
    name = mix64(inside ^ (place[at] * np.uint64(BASE)))
    most = np.minimum.reduceat(counts, at)
    if need < len(name):
        taken = np.argpartition(rank, need - 1)[:need]
        return name[taken], most[taken]
    # the empty chunks come last in the order, by number
    empty = np.setdiff1d(np.arange(m, dtype=np.uint64), chunk[at])[: need - len(name)]
    blank = mix64((empty + np.uint64((band << 40) + (1 << 60))) * np.uint64(BASE))
    return np.concatenate([name, blank]), np.concatenate([most, np.full(len(blank), sets)])


def _keys(words: int, common, sets: int):
    """(sig, part, sid) of the leading chunks of every distinct set of the task. ``common``: broadcast counters. A key
    that many sets may share has parts by the sets' names; others have the part -1."""

    def rows(found: list, sids: list, most: int) -> pd.DataFrame:
        names = np.repeat(np.array(sids, dtype=np.int64), [len(x) for x, _ in found])
        parts = -(-np.concatenate([m for _, m in found]) // most)
        part = np.where(parts > 1, (names & 0x7FFFFFFF) % np.maximum(parts, 1), -1)
        sigs = np.concatenate([x for x, _ in found]).astype(np.int64)
        return pd.DataFrame({"sig": sigs, "part": part.astype(np.int32), "sid": names})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = common.value
        usual = max(4.0 * counts.mean(), 16.0)
        # a counter holds many rare shingles where there are many documents: what is usual is no common key
        most = max(BLOCK_ROWS, int(usual))
        heat = np.minimum(np.floor(np.log2(np.maximum(counts / usual, 1.0))), 31).astype(np.uint64)
        seen: set[int] = set()
        sigs, sids = [], []
        for pdf in batches:
            for u in shingle_sets(pdf["text"], words):
                sid = _set_name(u)
                if not len(u) or sid in seen:
                    continue
                if len(seen) < 1 << 20:  # only spares rows: copies in other tasks meet in the shuffle
                    seen.add(sid)
                slot = _slot(u)
                hashed, hot, many = mix64(u ^ SEED), heat[slot], counts[slot]
                for band in range(_band(len(u)), _band(_partners(len(u))) + 1):
                    sigs.append(_leading(u, hashed, hot, many, sets, band))
                    sids.append(sid)
                if len(sigs) >= 1000:
                    yield rows(sigs, sids, most)
                    sigs, sids = [], []
        if sigs:
            yield rows(sigs, sids, most)

    return run


def _hamming(x: bytes, y: bytes) -> int:
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidates within the bound by sketch."""
    for pdf in batches:
        ok = [_hamming(x, y) <= (n + m) // 7 for x, y, n, m in zip(pdf["sk_a"], pdf["sk_b"], pdf["n_a"], pdf["n_b"])]
        yield pdf.loc[np.array(ok, dtype=bool), ["a", "b"]]


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to the shortest of them."""
    width = min(map(len, sketches))
    out = np.empty((len(sketches), width), dtype=np.uint8)
    for i, s in enumerate(sketches):
        a = np.frombuffer(s, dtype=np.uint8)
        while len(a) > width:
            a = a[: len(a) // 2] ^ a[len(a) // 2 :]
        out[i] = a
    return out.view(np.uint64)


def _close(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of two blocks of a key's sets (row numbers of ``g``), of different components, within the bound by size and
    sketch, and how much of both sets differs by sketch."""
    bx, by = g["bx"].iloc[0], g["by"].iloc[0]
    blk = g["blk"].to_numpy()
    x, y = np.flatnonzero(blk == bx), np.flatnonzero(blk == by)
    out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
    if len(x) and len(y):
        n, comp, sid, sk = g["n"].to_numpy(), g["comp"].to_numpy(), g["sid"].to_numpy(), _folded(g["sketch"].tolist())
        step = max(1, (1 << 21) // (len(y) * sk.shape[1]))
        for at in range(0, len(x), step):
            i = x[at : at + step]
            total = n[i][:, None] + n[y][None, :]
            ok = (comp[i][:, None] != comp[y][None, :]) & (7 * np.minimum(n[i][:, None], n[y][None, :]) >= 3 * total)
            if bx == by:
                ok &= sid[i][:, None] < sid[y][None, :]
            p, q = np.nonzero(ok)
            if len(p):
                apart = np.bitwise_count(sk[i[p]] ^ sk[y[q]]).sum(axis=1, dtype=np.int64)
                near = apart <= total[p, q] // 7
                out.append((i[p[near]], y[q[near]], apart[near] / total[p[near], q[near]]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of sets that have close ones of other components in their block, with the closest (``other``)."""
    for groups in whole_groups(batches, BLOCK):
        found = []
        for g in groups:
            i, j, apart = _close(g)
            if len(i):
                sid = g["sid"].to_numpy()
                one, other, apart = np.r_[i, j], np.r_[j, i], np.r_[apart, apart]
                order = np.lexsort([sid[other], apart, one])
                best = order[np.r_[True, np.diff(one[order]) != 0]]
                found.append(g.iloc[one[best]].assign(other=sid[other[best]]))
        if found:
            yield pd.concat(found).drop(columns=["sketch", "comp", "n"])


def _doubtful(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of sets that have a close one of another component in their block."""
    for groups in whole_groups(batches, BLOCK):
        found = [g.iloc[np.unique(np.r_[i, j])] for g in groups for i, j, _ in [_close(g)] if len(i)]
        if found:
            yield pd.concat(found).drop(columns="sketch")


def _in_common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``x`` with sets ``y``, by products of slices of their incidence matrix."""
    of = np.repeat(np.arange(len(sets)), [len(u) for u in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    width = int(shared.sum())
    place = np.cumsum(shared) - 1
    used = shared[column]
    of, column = of[used], place[column[used]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    out = np.zeros((len(x), len(y)), dtype=np.int64)
    for at in range(0, width, MATRIX_COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + MATRIX_COLUMNS])
        has = np.zeros((len(sets), min(MATRIX_COLUMNS, width - at)), dtype=np.float32)
        has[of[lo:hi], column[lo:hi] - at] = 1
        out += (has[x] @ has[y].T).astype(np.int64)
    return out


def _forest(percent: int):
    """Exact links of two parts of a block, as pairs (a, b) of components that span the components they join."""

    def one(g: pd.DataFrame) -> list[tuple[int, int]]:
        sub, blk, comp, n = (g[c].to_numpy() for c in ("sub", "blk", "comp", "n"))
        x, y = np.flatnonzero(sub == g["sx"].iloc[0]), np.flatnonzero(sub == g["sy"].iloc[0])
        if not len(x) or not len(y):
            return []
        both = _in_common([np.frombuffer(u, dtype=np.uint64) for u in g["shingles"]], x, y)
        ok = (comp[x][:, None] != comp[y][None, :]) & (both > 0)
        if g["bx"].iloc[0] != g["by"].iloc[0]:
            ok &= blk[x][:, None] != blk[y][None, :]
        ok &= 100 * both >= percent * (n[x][:, None] + n[y][None, :] - both)
        p, q = np.nonzero(ok)
        low: dict[int, int] = {}

        def root(c: int) -> int:
            while low.get(c, c) != c:
                low[c] = low.get(low[c], low[c])
                c = low[c]
            return c

        out = []
        for a, b in np.unique(np.stack([comp[x[p]], comp[y[q]]], axis=1), axis=0).tolist():
            ra, rb = root(a), root(b)
            if ra != rb:
                low[max(ra, rb)] = min(ra, rb)
                out.append((a, b))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in whole_groups(batches, [*BLOCK, "sx", "sy"]):
            found = [e for g in groups for e in one(g)]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"]).drop_duplicates()

    return run


def _hashes(words: int):
    """(sid, shingles): the set of every text as the bytes of its sorted hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [u for u in shingle_sets(pdf["text"], words) if len(u)]
            yield pd.DataFrame({"sid": [_set_name(u) for u in sets], "shingles": [u.tobytes() for u in sets]})

    return run


def _verify(words: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            left: dict = {}
            for i, t in zip(pdf["a"], pdf["text_a"]):
                left.setdefault((i, t), None)
            for k, u in zip(left, shingle_sets([t for _, t in left], words)):
                left[k] = u
            ok = []
            for i, t, v in zip(pdf["a"], pdf["text_a"], shingle_sets(pdf["text_b"], words)):
                u = left[(i, t)]
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(both > 0 and 100 * both >= percent * (len(u) + len(v) - both))
            yield pdf.loc[np.array(ok, dtype=bool), ["a", "b"]]

    return run


def _same_rows(*cols: str) -> list:
    """Aggregates that are alike where groups have the same rows: two hashes over ``cols``."""
    return [F.bit_xor(F.xxhash64(*cols)).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), *cols)).alias("x2")]


class _Join:
    def __init__(self, docs: DataFrame, words: int):
        self.docs, self.words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words
        schema = "doc_id long, n long, sid long, sketch binary, slice int, counts binary"
        filled = self.docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
        raw = keep(filled.mapInPandas(_profile(words), schema), "jaccard-profile")
        self.profile = raw.where("slice is null").select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n", "sid")
        self.sets = keep(
            raw.where(f"slice is null and n > 0 and doc_id <> {NO_ID}")
            .groupBy("sid")
            .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.max("sketch").alias("sketch")),
            "jaccard-sets",
        )
        self.counts = _summed(raw)
        # documents with several texts
        several = self.profile.where("doc_id is not null").groupBy("doc_id").agg(
            F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.count(F.lit(1)).alias("k")
        ).where("k > 1")
        self.repeated = keep(several.select("doc_id", (F.col("lo") != F.col("hi")).alias("differ")), "jaccard-repeated")
        self.any_repeated = not self.repeated.isEmpty()
        self.texts = self.docs.dropDuplicates(["doc_id", "text"]) if self.any_repeated else self.docs

    def same_document(self) -> DataFrame:
        """Links (a, b) of the sets that a repeated doc_id has: the doc_id and the smallest one of each set."""
        own = self.profile.where("n > 0").join(self.repeated.where("differ").select("doc_id"), "doc_id")
        own = own.select("doc_id", "sid").join(self.sets.select("sid", "rep"), "sid")
        return own.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()

    def keyed(self) -> DataFrame:
        """Rows (sig, sid, first, prev, cut) of the keys that more than one set has; cut: the key has parts."""
        spark = self.docs.sparkSession
        common = spark.sparkContext.broadcast(self.counts)
        # sets are named again from the texts, so the texts need not be joined to the profile
        named = self.docs.where("text is not null and doc_id is not null").select("text")
        named = named.mapInPandas(_keys(self.words, common, self.sets.count()), "sig long, part int, sid long")

        def neighbours(rows: DataFrame, *key: str) -> DataFrame:
            by = Window.partitionBy(*key).orderBy("sid")
            return rows.select("sig", "part", "sid", F.lag("sid").over(by).alias("prev"), F.first("sid").over(by).alias("first"))

        rows = neighbours(named, "sig", "part").where("prev <> sid or (prev is null and part >= 0)")
        rows = keep(rows, "jaccard-keys")
        heads = neighbours(rows.where("prev is null"), "sig")
        both = rows.where("prev is not null").unionByName(heads.where("prev is not null"))
        return both.select("sig", "sid", "first", "prev", (F.col("part") >= 0).alias("cut"))

    def rivals(self, keyed: DataFrame, node: DataFrame) -> DataFrame:
        """The sets of keys with several components, in pairs of blocks (sig, bx, by), each pair's rows together."""
        member = keyed.select("sig", "sid", "cut").unionByName(
            keyed.select("sig", F.col("first").alias("sid"), "cut")
        ).distinct()
        member = member.join(node, "sid")
        mixed = member.groupBy("sig").agg(
            F.count(F.lit(1)).alias("k"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("cut").alias("any_cut"),
            *_same_rows("sid"),
        ).where("(k > 3 or (k > 2 and any_cut)) and lo <> hi")
        mixed = mixed.groupBy("k", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("k") / float(BLOCK_ROWS)).cast("int").alias("blocks"))
        member = member.drop("cut").join(mixed, "sig")
        member = member.withColumn("blk", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        member = member.select(
            "sig", F.least("blk", "other").alias("bx"), F.greatest("blk", "other").alias("by"), "blk", "sid", "comp"
        )
        return self.dealt(member)

    def dealt(self, member: DataFrame) -> DataFrame:
        """Rows (sig, bx, by, blk, sid, comp) with their sizes and sketches, each pair of blocks together."""
        member = member.join(self.sets.select("sid", "n", "sketch"), "sid")
        member = member.select(*BLOCK, "blk", "sid", "comp", "n", "sketch")
        return member.repartition(*BLOCK).sortWithinPartitions(*BLOCK)

    def still_rivals(self, close: DataFrame, node: DataFrame) -> DataFrame:
        """As ``rivals``, from the rows that had a close one. Components only grow, so no other rows have one now."""
        member = close.join(node, "sid")
        mixed = member.groupBy(*BLOCK).agg(
            F.count(F.lit(1)).alias("k"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), *_same_rows("sid", "blk")
        ).where("lo <> hi")
        mixed = mixed.groupBy("bx", "by", "k", "x1", "x2").agg(F.min("sig").alias("sig")).select(*BLOCK)
        return self.dealt(member.join(mixed, BLOCK))

    def forest(self, rivals: DataFrame) -> DataFrame:
        """Links (a, b) between components, enough to join all that have linked sets in a block of ``rivals``."""
        schema = "sig long, bx int, by int, blk int, sid long, comp long, n long"
        doubt = keep(rivals.mapInPandas(_doubtful, schema), "jaccard-doubtful")
        ids = doubt.select("sid").distinct().join(self.sets.select("sid", F.col("rep").alias("doc_id")), "sid")
        few = ids.count() <= BROADCAST_IDS
        ids = ids.select("doc_id").distinct()
        texts = self.texts.join(F.broadcast(ids) if few else ids, "doc_id").select("text")
        hashes = texts.mapInPandas(_hashes(self.words), "sid long, shingles binary")
        if self.any_repeated:
            hashes = hashes.groupBy("sid").agg(F.min("shingles").alias("shingles"))
        # blocks of long sets are cut further, by their shingles
        cells = doubt.groupBy(*BLOCK).agg(F.ceil(F.sum("n") / float(BLOCK_SHINGLES)).cast("int").alias("cells"))
        rows = doubt.join(cells, BLOCK).withColumn("sub", F.pmod(F.xxhash64("sid", F.lit(1)), F.col("cells")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        rows = rows.withColumn("sx", F.least("sub", "other")).withColumn("sy", F.greatest("sub", "other"))
        rows = rows.drop("other", "cells").join(hashes, "sid")
        parts = [*BLOCK, "sx", "sy"]
        dealt = rows.repartition(*parts).sortWithinPartitions(*parts)
        return keep(dealt.mapInPandas(_forest(75), "a long, b long").distinct(), "jaccard-forest")

    def nodes(self, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(sid, comp): every set with the smallest doc_id of its component; and as few links as join what ``edges`` join."""
        comps = keep(components(edges), "jaccard-components")
        found = self.sets.select("sid", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        node = keep(found.select("sid", F.coalesce("component", "rep").alias("comp")), "jaccard-nodes")
        return node, comps.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The linked pairs (a, b) among pairs (a, b) of set names, as smallest doc_ids of their sets."""
        s = self.sets
        x = s.select(F.col("sid").alias("a"), F.col("rep").alias("rep_a"), F.col("n").alias("n_a"), F.col("sketch").alias("sk_a"))
        y = s.select(F.col("sid").alias("b"), F.col("rep").alias("rep_b"), F.col("n").alias("n_b"), F.col("sketch").alias("sk_b"))
        full = pairs.join(x, "a").join(y, "b").where("3 * n_a <= 4 * n_b and 3 * n_b <= 4 * n_a")
        full = full.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "n_a", "n_b", "sk_a", "sk_b")
        near = keep(full.mapInPandas(_near, "a long, b long"), "jaccard-near")
        ids = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        few = ids.count() <= BROADCAST_IDS
        texts = self.texts.join(F.broadcast(ids) if few else ids, "doc_id")
        full = near.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        full = full.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        return keep(full.mapInPandas(_verify(self.words, 75), "a long, b long"), "jaccard-links")


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    join = _Join(docs, words)
    keyed = join.keyed()
    pairs = keyed.select("sid", F.explode(F.array_distinct(F.array("first", "prev"))).alias("other"))
    pairs = keep(pairs.groupBy("sid", "other").agg(F.count(F.lit(1)).alias("shared")), "jaccard-pairs")
    best = pairs.groupBy("sid").agg(F.max(F.struct("shared", F.col("other"))).alias("m")).select(
        F.col("sid").alias("a"), F.col("m.other").alias("b")
    )
    edges = join.verified(best)
    if join.any_repeated:
        edges = edges.unionByName(join.same_document())
    node, edges = join.nodes(edges)
    # neighbours in a key that were not the best, across components
    na, nb = (node.select(F.col("sid").alias(c), F.col("comp").alias(f"comp_{c}")) for c in "ab")
    rest = pairs.select(F.col("sid").alias("a"), F.col("other").alias("b")).join(best, ["a", "b"], "left_anti")
    rest = rest.join(na, "a").join(nb, "b").where("comp_a <> comp_b")
    more = join.verified(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not more.isEmpty():
        node, edges = join.nodes(edges.unionByName(more))
    # all other pairs of a key, across the components that are left: the closest of each set, then all
    schema = "sig long, bx int, by int, blk int, sid long, other long"
    close = keep(join.rivals(keyed, node).mapInPandas(_nearest, schema), "jaccard-close")
    more = join.verified(close.select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct())
    if not more.isEmpty():
        node, edges = join.nodes(edges.unionByName(more))
    more = join.forest(join.still_rivals(close, node))
    if not more.isEmpty():
        node, _ = join.nodes(edges.unionByName(more))
    named = node.select("sid", F.col("comp").alias("component_id"))
    out = join.profile.join(named, "sid", "left")
    alone = F.col("n") == 0
    if join.any_repeated:
        # blank rows of a document that has other texts
        own = out.where("n > 0").join(join.repeated.where("differ").select("doc_id"), "doc_id")
        own = own.groupBy("doc_id").agg(F.min("component_id").alias("own"))
        out = out.join(own, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "own"))
        alone = alone & F.col("component_id").isNull()
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
