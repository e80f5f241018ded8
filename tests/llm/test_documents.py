"""Operators on documents against brute force, with nulls, empty and long texts, ties, copies and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from . import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text: str | None) -> int:
    return len(WORD.findall(text or ""))


@pytest.fixture(scope="module")
def rows():
    return data.texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return data.frame(spark, rows).cache()


@pytest.fixture(scope="module")
def by_id(docs):
    return {r["doc_id"]: r for r in docs.collect()}


# -- mixing


def water_fill(sizes: dict, cap: float = 3.0) -> dict:
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
        open_ -= over
    return target


def test_mixing_meets_targets(docs, by_id):
    from tabula.llm.mixing import mix, mix_report

    got = mix_report(docs).collect()
    assert got == sorted(mix_report(docs).collect(), key=lambda r: [x["doc_id"] for x in got].index(r["doc_id"]))
    sizes = Counter()
    for r in by_id.values():
        sizes[r["source"]] += size(r["text"])
    want, taken = water_fill(sizes), Counter()
    for r in got:
        s = by_id[r["doc_id"]]["source"]
        assert r["size"] == size(by_id[r["doc_id"]]["text"]) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    out = mix(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r["source"]] += size(r["text"])
    assert words == +taken


def test_mixing_caps_and_empty(spark):
    from tabula.llm.mixing import mix, mix_report

    few = data.frame(spark, ["a b c", "d " * 1000, None, ""], sources=["c", "a", "b", None])
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mix_report(few).collect()}
    assert got[1] == (9.0, 9) and got[7] == (0.0, 0) and got[4] == (994.0, 994)
    assert mix_report(data.none(spark)).count() == 0 and mix(data.none(spark)).count() == 0


# -- n-gram join


def shingles(text: str | None) -> set:
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(sets: dict) -> dict:
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                low[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_finds_all_links(spark, seed):
    from tabula.llm.ngram_join import jaccard_components

    df = data.frame(spark, data.texts(seed))
    sets = {r["doc_id"]: shingles(r["text"]) for r in df.collect()}
    want = linked(sets)
    got = {r["doc_id"]: r for r in jaccard_components(df).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) < len(want) - 20


def test_ngram_join_near_the_threshold(spark):
    """Sets that share exactly 3/4 or just less, of sizes around the edges of bands, in a chain of neighbours."""
    from tabula.llm.ngram_join import jaccard_components

    rows = []
    for n in (3, 4, 6, 7, 8, 15, 16, 31, 33, 63, 64, 120):
        base = [f"w{n}x{i}" for i in range(n + 4)]
        rows.append(" ".join(base))
        rows += [" ".join(base + [f"v{n}y{i}" for i in range(k)]) for k in (n // 3, n // 3 + 1)]
        rows += [" ".join(base[k:] + [f"u{n}z{i}" for i in range(k)]) for k in (n // 7, n // 7 + 1)]
    df = data.frame(spark, rows)
    want = linked({r["doc_id"]: shingles(r["text"]) for r in df.collect()})
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(df).collect()} == want


def test_ngram_join_odd_rows(spark):
    from tabula.llm.ngram_join import jaccard_components

    df = data.frame(spark, ["a b c d e f", "a b c d e f", None, "", "a b c d e f"], ids=[5, 5, 7, None, None])
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in jaccard_components(df).collect())
    assert got == [(0, 0, 0), (0, 2, 0), (5, 2, 5), (5, 2, 5), (7, 0, 7)]
    assert jaccard_components(data.none(spark)).count() == 0


def test_parity_sketch_bounds_the_difference():
    import numpy as np

    from tabula.llm.ngram_join import _hamming, _sketch

    rng = np.random.default_rng(3)
    for n in (1, 5, 64, 500):
        u = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        v = np.unique(np.concatenate([u[: n // 2], rng.integers(0, 2**63, n, dtype=np.uint64)]))
        assert _hamming(_sketch(u), _sketch(v)) <= len(np.setxor1d(u, v))


def test_ngram_join_repeated_ids(spark):
    """A doc_id with several texts is one document: it has one component, and links the texts' other documents."""
    from tabula.llm.ngram_join import jaccard_components

    one, two = "a b c d e f g h", "k l m n o p q r"
    df = data.frame(spark, [one, two, two, one, None, "  "], ids=[5, 5, 3, 9, 5, 3])
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect())
    assert got == [(3, 0, 3), (3, 4, 3), (5, 0, 3), (5, 4, 3), (5, 4, 3), (9, 4, 3)]


@pytest.mark.parametrize("rows,shingles_,columns", [(1024, 1 << 19, 4096), (3, 200, 16)])
def test_ngram_join_of_many_near_copies(spark, monkeypatch, rows, shingles_, columns):
    """A large group of near copies at all distances, whose members are linked only through some others."""
    import random

    from tabula.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles_)
    monkeypatch.setattr(ngram_join, "MATRIX_COLUMNS", columns)
    rng = random.Random(3)
    base = data.words(rng, 70)
    texts = [" ".join(base)]
    for _ in range(160):
        share = rng.choice((0.01, 0.02, 0.03, 0.04, 0.05))
        texts.append(" ".join(w if rng.random() >= share else rng.choice("uvwxyz") * 3 for w in base))
    ids = [None if i % 9 == 4 else i for i in range(len(texts))]
    df = data.frame(spark, texts, ids=ids)
    sets = {i: shingles(t) for i, t in zip(ids, texts) if i is not None}
    want = linked(sets)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(df).collect() if r["doc_id"] is not None}
    assert got == want
    assert 3 < len(set(want.values())) < len(want) - 20


# -- sharding


def test_sharding_keeps_law_and_groups(spark, docs, by_id):
    from tabula.llm.sharding import shard_documents

    got = shard_documents(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(by_id.keys())
    check_law(got, 24)
    for r in got:
        b = (by_id[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 8, zlib.crc32(b), "rows", None)
    shards = defaultdict(set)
    for r in got:
        if (t := by_id[r["doc_id"]]["text"]) is not None:
            shards[t].add(r["shard"])
    copies = Counter(r["text"] for r in by_id.values() if r["text"] is not None)
    assert sum(len(shards[t]) == 1 for t, n in copies.items() if n > 1) >= 0.7 * sum(n > 1 for n in copies.values())


def check_law(got, shards: int):
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_sharding_hot_group_fills_shards_in_turn(spark):
    from tabula.llm.sharding import shard_documents

    df = data.frame(spark, ["same text"] * 200 + [f"t{i}" for i in range(400)] + [None, None, ""])
    got = shard_documents(df, shards=12).collect()
    check_law(got, 12)
    hot = {r["doc_id"] for r in df.collect() if r["text"] == "same text"}
    full = Counter(r["shard"] for r in got if r["doc_id"] in hot)
    assert sum(n >= 40 for n in full.values()) >= 2
    assert shard_documents(data.none(spark)).count() == 0
    check_law(shard_documents(data.frame(spark, ["a", "a", "a"])).collect(), 24)


def test_sharding_swaps_between_full_shards(spark):
    """Where every row has a copy no shard has room, so documents can only change places."""
    from tabula.llm.sharding import shard_documents

    df = data.frame(spark, [f"text {i // 2}" for i in range(1200)])
    got = shard_documents(df, shards=8).collect()
    check_law(got, 8)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    shards = defaultdict(set)
    for r in got:
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(x) == 1 for x in shards.values()) >= 0.9 * len(shards)


def test_sharding_group_of_many_shards(spark):
    """A group larger than a shard fills as many shards as it can."""
    from tabula.llm.sharding import shard_documents

    df = data.frame(spark, ["same text"] * 1600 + [f"t{i}" for i in range(800)])
    got = shard_documents(df, shards=24).collect()
    check_law(got, 24)
    hot = {r["doc_id"] for r in df.collect() if r["text"] == "same text"}
    full = Counter(r["shard"] for r in got if r["doc_id"] in hot)
    assert sum(n >= 95 for n in full.values()) >= 15


# -- repeated strings


def test_suffix_dedup_by_brute_force(spark, docs, by_id):
    from tabula.llm.suffix_dedup import remove_repeats

    check_repeats(remove_repeats(docs).collect(), {i: r["text"] for i, r in by_id.items()})


def check_repeats(got, texts: dict, length: int = 400):
    seen = Counter()
    raw = {i: (t or "").encode() for i, t in texts.items()}
    for b in raw.values():
        seen.update(b[x : x + length] for x in range(len(b) - length + 1))
    assert len(got) == len(texts)
    for r in got:
        b = raw[r["doc_id"]]
        gone = bytearray(len(b))
        for x in range(len(b) - length + 1):
            if seen[b[x : x + length]] > 1:
                gone[x : x + length] = b"\1" * length
        rest = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        want = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, r["doc_id"]
        if r["kept"] is not None:
            assert bytes(r["kept"]) == rest


@pytest.mark.parametrize("hot", [1, 100_000])
def test_suffix_dedup_both_ways(spark, hot, monkeypatch):
    """Large gram groups by window counts give what induction gives."""
    from tabula.llm import suffix_dedup as S

    monkeypatch.setattr(S, "HOT_GROUP", hot)
    monkeypatch.setattr(S, "SEGMENT", 1500)
    rng = data.random.Random(5)
    passage = " ".join(data.words(rng, 120))
    rows = [" ".join(data.words(rng, 60)) + passage[k : k + 600] + " ".join(data.words(rng, 30)) for k in range(0, 200, 9)]
    rows += ["ab" * 700, "zab" + "ab" * 400 + "q", "x" * 399, "y" * 400, "y" * 401, None, ""]
    df = data.frame(spark, rows)
    check_repeats(S.remove_repeats(df).collect(), {r["doc_id"]: r["text"] for r in df.collect()})
    assert S.remove_repeats(data.none(spark)).count() == 0


@pytest.mark.parametrize("listed", [0, 1_000_000])
def test_suffix_dedup_null_ids(spark, listed, monkeypatch):
    """Rows without an id have results, and their texts are partners, of rows with and without ids."""
    from tabula.llm import suffix_dedup as S

    monkeypatch.setattr(S, "BROADCAST_ROWS", listed)
    rng = data.random.Random(11)
    prose = [" ".join(data.words(rng, 150)) for _ in range(12)]
    passage = " ".join(data.words(rng, 120))
    rows = [(i, t) for i, t in enumerate(prose[:6])] + [(None, t) for t in prose[6:]]
    rows += [(None, prose[0]), (None, prose[7]), (None, prose[7]), (None, prose[7]), (40, prose[8])]  # copies
    rows += [(50, prose[9][:500] + " tail"), (None, prose[1][100:700]), (None, "head " + prose[7][30:600])]
    rows += [(60, "one " + passage), (None, "two " + passage), (None, passage + " three"), (None, None), (None, ""), (None, "short")]
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[x : x + 400] for b in raw for x in range(len(b) - 399))
    want = Counter()
    for (i, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for x in range(len(b) - 399):
            if seen[b[x : x + 400]] > 1:
                gone[x : x + 400] = b"\1" * 400
        rest = bytes(c for c, g in zip(b, gone) if not g)
        want[i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest()] += 1
    df = data.frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = S.remove_repeats(df).drop("kept").collect()
    assert Counter(tuple(r) for r in got) == want


# -- packing


def test_packing_is_best_fit_under_conflicts(docs, by_id):
    from tabula.llm.packing import pack

    got = pack(docs, capacity=300).collect()
    words, fill, held = Counter(), defaultdict(list), defaultdict(list)
    for r in got:
        words[r["doc_id"]] += r["n_words"]
        fill[r["shard"], r["bin"]].append((r["start"], r["n_words"]))
        held[r["shard"], r["bin"]].append(by_id[r["doc_id"]])
    assert {i: words[i] for i in by_id} == {i: size(r["text"]) for i, r in by_id.items()}
    for k, pieces in fill.items():
        at = 0
        for start, n in sorted(pieces):
            assert start >= at
            at = start + n
        assert at <= 300 and sum(n for _, n in pieces) == at
        assert len({r["source"] for r in held[k]}) == len(held[k])
        texts = [r["text"] for r in held[k] if r["text"] is not None]
        assert len(set(texts)) == len(texts)


def test_best_fit_takes_the_tightest_compatible_bin():
    from tabula.llm.packing import best_fit

    rng = data.random.Random(7)
    items = sorted(((rng.randint(0, 90), rng.randint(0, 5), rng.choice([-1, -1, 0, 1, 2])) for _ in range(400)), reverse=True)
    bins, _ = best_fit(*zip(*items), 100)
    free, sources, clusters = [], [], []
    for (n, s, c), got in zip(items, bins):
        fits = [b for b in range(len(free)) if free[b] >= n and s not in sources[b] and (c < 0 or c not in clusters[b])]
        if fits:
            assert free[got] == min(free[b] for b in fits) and got in fits
        else:
            assert got == len(free)
            free.append(100)
            sources.append(set())
            clusters.append(set())
        free[got] -= n
        sources[got].add(s)
        clusters[got].add(c)


def test_packing_odd_rows(spark):
    from tabula.llm.packing import pack

    df = data.frame(spark, ["w " * 2500, None, "", "a b", "a b"], sources=["s"] * 5, ids=[1, 2, None, 4, 4])
    got = Counter((r["doc_id"], r["n_words"]) for r in pack(df).collect())
    assert got == Counter({(1, 1024): 2, (1, 452): 1, (2, 0): 1, (None, 0): 1, (4, 2): 2})
    assert pack(data.none(spark)).count() == 0


# -- pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    rng = data.random.Random(9)
    prose = [" ".join(data.words(rng, rng.randint(40, 120))) for _ in range(160)]
    toxic = {i for i in range(0, 160, 4)}
    rows = [t + (" you stupid loser, what a clown" if i in toxic else " mail me: jo@mail.example.com") for i, t in enumerate(prose)]
    rows += [rows[i] for i in (1, 2, 3)] + [rows[5] + " ende"]
    df = data.frame(spark, rows)
    ids = {r["doc_id"]: r["text"] for r in df.collect()}
    labels = [(i, 1, int("stupid" in t)) for i, t in ids.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    clean = P.toxicity_stage(spark, df, str(tmp_path))
    assert clean.columns == df.columns
    left = {r["doc_id"] for r in clean.collect()}
    assert left == {i for i, t in ids.items() if "stupid" not in t}
    once = P.near_duplicate_stage(spark, clean, str(tmp_path))
    comp = linked({i: shingles(ids[i]) for i in left})
    assert once.columns == df.columns and sorted(r["doc_id"] for r in once.collect()) == sorted(set(comp.values()))
    safe = P.pii_stage(spark, once, str(tmp_path)).collect()
    assert all("jo@mail" not in r["text"] and "[EMAIL]" in r["text"] and r["n_chars"] == len(r["text"]) for r in safe)
    out = P.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "part", "n_words", "shard", "bin", "start"] and out.where(F.col("n_words") > 0).count() > 0
    assert {r["doc_id"] for r in out.collect()} <= set(comp.values())
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_join", "pii", "mixing", "packing"]
